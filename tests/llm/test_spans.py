import hashlib
import math
import random
import re
import string
import time
from collections import Counter

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidewire.llm import pii, queries, secrets
from tidewire.llm.spans import Taken, mask_text

SF = "/root/testdata/sf0.001"


def luhn(digits):
    total = 0
    for place, digit in enumerate(digits[::-1]):
        value = int(digit) * (2 if place % 2 else 1)
        total += value if value < 10 else value - 9
    return total % 10 == 0


def plain_pii(text):
    """The base kinds, straight from their definition."""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def plain_secrets(text):
    out = []
    pattern = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
    for m in re.finditer(f"(?i:{pattern})([A-Za-z0-9+/_.=-]+)", text):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 20:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 24:
            out.append((m.start(), 2, "hex", m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


bits = st.sampled_from(
    ["a", "b.c", "@", "x@y.z", ".", "-", "+1", "12", "255", "256", " ", "(", ")", "4111111111111111", "4111 1111", "é", "\n",
     "1.2.3.4", "9", "AKIA", "ABCDEFGH1234567890", "password", "=", ":", "'", "TOKEN", "deadbeef", "0123456789abcdef", "apikey",
     "api_key", "abcdef", "/", "%", "x", "Ａ", "one two three four ", "at", "dot"]
)


@settings(max_examples=400, deadline=None)
@given(st.lists(bits, max_size=25).map("".join))
def test_base_spans_follow_their_definition(text):
    assert pii.plain_spans(text) == plain_pii(text)
    assert [(k, s, e) for k, s, e, base in pii.private_spans(text) if base] == plain_pii(text)
    assert [(k, s, e) for k, s, e, base in secrets.secret_spans(text) if base] == plain_secrets(text)


@pytest.mark.parametrize(
    "text, kind, found",
    [
        ("write to jane.doe [at] example [dot] org soon", "email", "jane.doe [at] example [dot] org"),
        ("jane at example dot org", "email", "jane at example dot org"),
        ("jane (AT) example (DOT) org", "email", "jane (AT) example (DOT) org"),
        ("see j.42 at mail.example.com please", "email", "j.42 at mail.example.com"),
        ("ｊａｎｅ＠ｅｘａｍｐｌｅ．ｏｒｇ", "email", "ｊａｎｅ＠ｅｘａｍｐｌｅ．ｏｒｇ"),
        ("from jаne@exаmple.org", "email", "jаne@exаmple.org"),
        ("ja​ne@exam​ple.org", "email", "ja​ne@exam​ple.org"),
        ("call plus one two one two five five five one two three four now", "phone",
         "plus one two one two five five five one two three four"),
        ("appelez zéro un deux trois quatre cinq six sept huit neuf", "phone",
         "zéro un deux trois quatre cinq six sept huit neuf"),
        ("tel +1 (555) 0l2-3O45", "phone", "+1 (555) 0l2-3O45"),
        ("host one nine two dot one six eight dot one dot double two", "ip",
         "one nine two dot one six eight dot one dot double two"),
        ("pay four one one one one one one one one one one one one one one one", "card",
         "four one one one one one one one one one one one one one one one"),
        ("id ４111 1111 1111 1111", "card", "４111 1111 1111 1111"),
        ("id 4111\u20111111\u20111111\u20111111.", "card", "4111\u20111111\u20111111\u20111111"),
        ("tel +1\u00a0(555)\u00a0010\u20130199", "phone", "+1\u00a0(555)\u00a0010\u20130199"),
        ("host 192\u3002168\u30021\u300220", "ip", "192\u3002168\u30021\u300220"),
        ("host 192[.]168[.]1[.]20", "ip", "192[.]168[.]1[.]20"),
        ("mail jane&#64;example&#46;org", "email", "jane&#64;example&#46;org"),
        ("jane dot doe at example dot com", "email", "jane dot doe at example dot com"),
        ("jane (at) example.com", "email", "jane (at) example.com"),
        ("jane.doe AT mail DOT example DOT com", "email", "jane.doe AT mail DOT example DOT com"),
        ("j\u043ehn\uff20ex\u0430mple\u2024com", "email", "j\u043ehn\uff20ex\u0430mple\u2024com"),
    ],
)
def test_disguises_are_found_at_their_source(text, kind, found):
    spans = pii.private_spans(text)
    assert (kind, text.index(found), text.index(found) + len(found), False) in spans


@pytest.mark.parametrize(
    "text, found",
    [
        ("ask anna at posta dot it now", "anna at posta dot it"),
        ("anna at posta dot in", "anna at posta dot in"),
        ("joe at mail dot me", "joe at mail dot me"),
        ("anna at posta punkt de", "anna at posta punkt de"),
        ("jane punkt doe at mail point posta point fr", "jane punkt doe at mail point posta point fr"),
        ("jane.smith at host.com", "jane.smith at host.com"),
        ("see follow-up at example.com", "follow-up at example.com"),
    ],
)
def test_bare_words_tell_any_host(text, found):
    assert ("email", text.index(found), text.index(found) + len(found), False) in pii.private_spans(text)


@pytest.mark.parametrize(
    "text",
    ["we are at this point in time", "it was at boiling point it seems", "we met at home . then we left", "see e.g. at example.com",
     "looked at noon dot then left"],
)
def test_sentences_are_no_hosts(text):
    assert pii.private_spans(text) == []


def test_every_folded_character_is_folded_alone():
    _, folds = pii._folding()
    assert all(pii._fold_edits(f"a{char}b") == [(1, 2, plain)] for char, plain in folds.items())
    assert ("email", 0, 12, False) in pii.private_spans("ann@mail\u2024com")


@pytest.mark.parametrize(
    "text, kind",
    [
        ("+1 two one two 555 0199", "phone"),
        ("+49 one 7 two 3 four 5 six 8", "phone"),
        ("+1 (two one two) 555, zero one nine nine", "phone"),
        ("4111 one one one one 1111 1111", "card"),
        ("192 dot one six eight dot 1 dot one", "ip"),
        ("\u00a0".join("one two three four five six seven eight nine zero".split()), "phone"),
    ],
)
def test_words_and_figures_mixed(text, kind):
    for around in ("{}", "call \u201c{}\u201d now"):
        whole = around.format(text)
        spells = bool(pii.spells_numbers(pa.array([whole]))[0])
        assert spells and (kind, whole.index(text), whole.index(text) + len(text), False) in pii.private_spans(whole, spells)


@pytest.mark.parametrize(
    "text",
    ["we met at noon", "look at the dot on the i", "at one point two or three of us left", "one, two, three, go", "p. 12 @ home",
     "meet me at example.com", "the error at line 12.5.3", "two at a time dot com boom"],
)
def test_clean_texts_are_left_alone(text):
    assert [s for s in pii.private_spans(text) if s[0] != "email" or "dot com" not in text] == []


def test_very_long_runs_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 2_000_000, "+1" + "(" * 1_000_000, "1." * 500_000, "a@" * 300_000, "f" * 1_000_000):
        pii.private_spans(text), secrets.secret_spans(text)


@given(st.text(alphabet="abcd12", min_size=20, max_size=60))
def test_sliding_entropy_is_that_of_each_window(run):
    def entropy(window):
        return -sum(n / len(window) * math.log2(n / len(window)) for n in Counter(window).values())

    got = list(secrets.sliding_entropy(run, 20))
    assert got == pytest.approx([entropy(run[i : i + 20]) for i in range(len(run) - 19)], abs=1e-9)


def test_entropy_and_allow_list():
    found = [(k, b) for k, _, _, b in secrets.secret_spans("key ghp_aB3dE5fG7hJ9kL1mN3pQ5rS7tU9vW1xY3z end")]
    assert found == [("entropy", False)]
    for text in ("thethethethethethethethethe", "550e8400-e29b-41d4-a716-446655440000", "12345678901234567890123", "x" * 50,
                 "example_aB3dE5fG7hJ9kL1mN3pQ5rS7tU9", "path/to/some/long/directory/name"):
        assert secrets.secret_spans(text) == []


BASE62 = string.ascii_letters + string.digits


def random_keys(letters, size, seed=5):
    rnd = random.Random(seed)
    return ["".join(rnd.choices(letters, k=size)) for _ in range(200)]


@pytest.mark.parametrize(
    "around",
    ["api.example.com/v1/{}", "sample_{}", "example_{}", "https_proxy={}", "www.site.com/{}", "{}00000000", "{}xxxxxxxx",
     "550e8400-e29b-41d4-a716-446655440000_{}", "changeme.{}.dummy"],
)
def test_filler_hides_no_key_beside_it(around):
    """A key's first or last windows may miss the threshold, so one in fifty may be found in part only."""
    whole = 0
    for key in random_keys(BASE62, 40):
        text = around.format(key)
        at = text.index(key)
        spans = [(s, e) for k, s, e, _ in secrets.secret_spans(text) if k == "entropy"]
        assert any(s < at + 40 and at < e for s, e in spans), text
        whole += any(s <= at and at + 40 <= e for s, e in spans)
    assert whole >= 190


@pytest.mark.parametrize(
    "letters, size, least",
    [(string.ascii_letters, 20, 180), (string.ascii_letters, 40, 198), (BASE62, 20, 190), (BASE62, 24, 196),
     (BASE62[26:52] + "234567", 20, 186), (BASE62[:26] + "234567", 24, 190), (BASE62 + "+/", 20, 186), (BASE62 + "-_", 20, 186)],
)
def test_random_keys_are_found_without_many_digits(letters, size, least):
    found = [any(k == "entropy" for k, *_ in secrets.secret_spans(f"see {key} end")) for key in random_keys(letters, size)]
    assert sum(found) >= least


@pytest.mark.parametrize(
    "text",
    ["getElementByIdAndClassName", "internationalizationSupport", "/Users/JohnSmith/Documents/MyProject",
     "www.site.com/some-Long-path-2024-13/Article99", "AbstractSingletonProxyFactoryBean", "MAX_CONNECTION_POOL_SIZE_LIMIT",
     "/usr/lib/x86_64-linux-gnu/libfoo.so.1", "org.apache.spark.sql.catalyst.expressions.codegen.CodegenContext",
     "id=550e8400-e29b-41d4-a716-446655440000/page", "2024-01-01/2024-01-02_12.30.45"],
)
def test_words_names_and_paths_are_no_secrets(text):
    assert secrets.secret_spans(text) == []


def test_masking_joins_overlaps():
    assert mask_text("abcdefgh", [(1, 3, "x"), (2, 5, "y"), (6, 7, "z")]) == "a[X]f[Z]h"
    assert mask_text("abc", []) == "abc"


def digest(spans):
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for k, s, e in spans).encode()).hexdigest()


def test_queries_against_definitions(spark, documents):
    for query, plain, kinds in (
        (queries.op2_pii, plain_pii, pii.KINDS),
        (queries.op6_secrets, plain_secrets, ("assign", "access", "hex")),
    ):
        rows = query(spark, SF).collect()
        assert len(rows) == len(documents)
        texts = dict(documents)
        for row in rows:
            want = plain(texts[row.doc_id] or "")
            assert row.base_sha256 == digest(want)
            assert [row[f"n_{k}"] for k in kinds] == [sum(x[0] == k for x in want) for k in kinds]
            assert {f"{k}:{s}:{e}" for k, s, e in want} <= set(row.spans.split(",")) | {""}


def test_odd_rows(odd_docs, no_docs):
    for found, column in (
        (pii.find_private(odd_docs, out_col="spans"), "spans"),
        (secrets.scan_secrets(odd_docs, out_col="spans"), "spans"),
    ):
        assert sorted(found.columns) == sorted(odd_docs.columns)
        assert [len(r[column]) for r in found.collect()] == [0] * 9
    assert pii.find_private(no_docs).count() == 0
    assert secrets.redact_secrets(no_docs).count() == 0


def test_redaction_keeps_rows_and_columns(spark):
    text = "set password=hunter2hunter2 now"
    docs = spark.createDataFrame([(1, text, len(text)), (2, None, None), (3, "clean", 5)], "doc_id int, text string, n_chars int")
    got = secrets.redact_secrets(docs, "text", "n_chars").collect()
    assert [tuple(r) for r in got] == [(1, "set [ASSIGN] now", 16), (2, None, None), (3, "clean", 5)]


@pytest.mark.parametrize("kind", ["private", "secret"])
def test_very_many_spans_in_one_text(kind):
    """Twenty thousand base spans and more, and as many added ones, in one text: the work grows with the text."""
    if kind == "private":
        text, spans = "und.34@mail7.example.com and ann_smith [at] posta [dot] org 10.0.0.1 " * 20_000, pii.private_spans
    else:
        text, spans = "api_key=abcdef123456 ordinary Zk3Vb8Qw1Xy7Rt5Ns0Lp words " * 20_000, secrets.secret_spans
    began = time.time()
    found = spans(text)
    assert time.time() - began < 60
    base = [x for x in found if x[3]]
    assert len(base) >= 20_000 and len(found) - len(base) >= 20_000


def test_taken_stretches_against_brute_force():
    rnd = random.Random(3)
    for _ in range(300):
        spans = [(a, a + rnd.randint(1, 6)) for a in (rnd.randint(0, 40) for _ in range(rnd.randint(0, 8)))]
        taken = Taken(spans)
        for _ in range(30):
            start = rnd.randint(0, 45)
            end = start + rnd.randint(1, 5)
            assert taken.meets(start, end) == any(s < end and start < e for s, e in spans)
