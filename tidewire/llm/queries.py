"""The queries of the text operators, each over its whole table, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewire.functions.once import with_once
from tidewire.llm.bpe import decode_ids, encode_texts
from tidewire.llm.common import remainder, table
from tidewire.llm.decontaminate import find_leaks
from tidewire.llm.jaccard import jaccard_components
from tidewire.llm.language import detect_languages, learn_languages
from tidewire.llm.mixture import mix_sources
from tidewire.llm.pii import KINDS as PRIVATE, find_private
from tidewire.llm.ppm import score_texts
from tidewire.llm.quality import learn_quality, score_quality
from tidewire.llm.runs import find_runs
from tidewire.llm.secrets import scan_secrets
from tidewire.llm.topk import exact_top_k
from tidewire.llm.token_files import read_token_files, write_token_files
from tidewire.llm.spans import base_only, count_of, joined
from tidewire.llm.trie import build_trie, digest_ends, turn_paths
from tidewire.workspace import materialise, new_path


def _digest(docs: DataFrame, spans: str, kinds: tuple[str, ...]) -> DataFrame:
    """The counts per base kind, the hash of the base spans, and all spans."""
    found = F.col(spans)
    return docs.select(
        "doc_id",
        *[count_of(found, k).alias(f"n_{k}") for k in kinds],
        F.size(found).cast("bigint").alias("n_spans"),
        F.sha2(joined(base_only(found)), 256).alias("base_sha256"),
        joined(found).alias("spans"),
    )


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    labels = table(spark, sf_dir, "labels").filter(~held_out).select("doc_id", "quality")
    model = learn_quality(docs, labels)
    scored = score_quality(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return scored.select(
        "doc_id", "held_out", "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted")
    )


def op2_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _digest(find_private(docs), "private", PRIVATE)


def op3_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return exact_top_k(rows, rows.filter(F.col("vec_id") % 50 == 0), 5)


OP3_SQL = """
with whole as (
  select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::double) as v
  from embeddings
  where vec_id is not null and embedding is not null
    and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
scored as (
  select q.vec_id as query_id, c.vec_id, list_inner_product(q.v, c.v)::bigint as score
  from whole q join whole c on q.vec_id <> c.vec_id
  where q.vec_id % 50 = 0),
ranked as (
  select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from scored)
select query_id, rank, vec_id, score from ranked where rank <= 5
"""


def op4_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs, size=4, percent=85).select("doc_id", "n_shingles", "component_id")


OP4_SQL = r"""
with recursive words as materialized (
  select doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') as w
  from documents),
shingles as materialized (
  select distinct doc_id, case when len(w) < 4 then array_to_string(w, ' ')
    else array_to_string(w[i : i + 3], ' ') end as s
  from (select doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) as i from words where len(w) > 0)),
sizes as materialized (select doc_id, count(*) as n from shingles group by doc_id),
common as (
  select x.doc_id as a, y.doc_id as b, count(*) as c
  from shingles x join shingles y on x.s = y.s and x.doc_id < y.doc_id group by all),
links as materialized (
  select a, b from common join sizes p on p.doc_id = a join sizes q on q.doc_id = b
  where 100 * c >= 85 * (p.n + q.n - c)),
edges as materialized (select a, b from links union all select b, a from links),
reach(doc_id, other) as (
  select doc_id, doc_id from documents
  union
  select r.doc_id, e.b from reach r join edges e on r.other = e.a)
select d.doc_id, coalesce(any_value(n), 0)::bigint as n_shingles, min(other) as component_id
from documents d join reach using (doc_id) left join sizes using (doc_id) group by d.doc_id
"""


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = find_leaks(docs, table(spark, sf_dir, "benchmark")).select("doc_id", F.explode("leaks").alias("leak"))
    return found.select(
        "doc_id", F.col("leak.item").cast("bigint").alias("item_id"), "leak.distance", "leak.start", "leak.end"
    )


def op6_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return _digest(scan_secrets(docs), "secrets", ("assign", "access", "hex"))


def op7_ppm(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = remainder(F.col("doc_id"), 7) == 2
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", (~held_out).alias("learn"))
    scored = score_texts(docs, "learn")
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score"
    )


def op8_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "token-files")
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    write_token_files(docs, path, public_tokenizers.path("word_bpe_49k.json"), end_id=1)
    return read_token_files(spark, path).select(
        F.col("id").alias("doc_id"),
        "start",
        F.col("n_ids").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    encoded = encode_texts(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary).drop("text")
    decoded = decode_ids(encoded, vocabulary)
    return decoded.select(
        "doc_id",
        F.size("ids").cast("bigint").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), ","), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    model = learn_languages(docs.filter(~held_out).select("text", "lang"))
    judged = detect_languages(docs.select("doc_id", held_out.alias("held_out"), "text"), model)
    return judged.select("doc_id", "held_out", "lang_pred", "score", "languages")


def _planted(docs: DataFrame) -> DataFrame:
    """doc_id and text, which is made periodic from some word on if the row's id says so."""
    crc, g, n = F.crc32(F.col("doc_id").cast("string")), F.col("g"), F.size("words")
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    marked = docs.select("doc_id", "text", F.floor(crc / 10).alias("g"), (crc % 10 == 0).alias("marked"))
    # each step is worked out once per row, not once per word
    split = with_once(marked, {"words": F.when(F.col("marked"), words)})
    placed = with_once(split, {"a": F.when(n > 0, g % n)})
    placed = with_once(placed, {"p": 1 + F.floor((n - F.col("a")) / (3 + g % 8))})

    def source(i: Column) -> Column:
        return F.get("words", F.when(i < F.col("a"), i).otherwise(F.col("a") + (i - F.col("a")) % F.col("p")).cast("int"))

    rebuilt = F.array_join(F.transform(F.sequence(F.lit(0), n - 1), source), " ")
    return placed.select("doc_id", F.when(F.col("a").isNotNull(), rebuilt).otherwise(F.col("text")).alias("text"))


def op11_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    planted = _planted(table(spark, sf_dir, "documents"))
    found = find_runs(planted).select("doc_id", "runs", F.sha2("collapsed", 256).alias("collapsed_sha256"))

    def better(best: Column, run: Column) -> Column:
        """The run of the greater length / period; the earlier one of equals, as they come in order."""
        ahead = run["length"] * best["period"] > best["length"] * run["period"]
        return F.when(best.isNull() | ahead, run).otherwise(best)

    kind = "struct<start: bigint, length: bigint, period: bigint>"
    best = F.aggregate("runs", F.lit(None).cast(kind), better)
    line = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("bigint").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000 div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(line, ""), 256).alias("runs_sha256"),
        "collapsed_sha256",
    )


def op12_mixture(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    mixed = mix_sources(docs, weights=(3, 1, 2), share=Fraction(3, 2), max_epochs=2)
    taken = F.col("epochs") * F.col("size") + F.col("part")
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"))


OP12_SQL = r"""
with sized as (
  select doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::hugeint as size,
    left(md5(concat_ws('|', 'mix', coalesce(doc_id::varchar, ''), coalesce(text, ''))), 16) as drawn
  from documents),
named as (
  select source, sum(size)::hugeint as s,
    ([3, 1, 2])[(row_number() over (order by source is null, source) - 1) % 3 + 1]::hugeint as w
  from sized group by source),
-- by the level at which they are clamped: with the first ones clamped, the others share what is left
poured as (
  select *, 3 * sum(s) over () - 4 * (sum(s) over (order by s::double / w, w, source) - s) as p,
    2 * sum(w) over (order by s::double / w desc, w desc, source desc) as q
  from named),
level as (select p, q from poured where 2 * s * q >= p * w order by s::double / w, w, source limit 1),
targets as (
  select source, s, case when 2 * s * q < p * w then (2 * s)::double else (p * w)::double / q::double end as target,
    (case when 2 * s * q < p * w then 2 * s else (2 * p * w + q) // (2 * q) end)::hugeint as words
  from named, level),
quotas as (select *, case when s > 0 then words // s else 0 end as epochs, case when s > 0 then words % s else 0 end as rest
  from targets),
drawn as (select source, drawn, sum(size)::hugeint as held from sized where size > 0 group by all),
upto as (select *, sum(held) over (partition by source order by drawn)::hugeint as upto from drawn)
select doc_id, d.size::bigint as size, s::bigint as source_size, target,
  (epochs * d.size + case when d.size = 0 or rest = 0 then 0 when upto <= rest then d.size
    when upto - held <= rest then (2 * d.size * (rest - upto + held) + held) // (2 * held) else 0 end)::bigint as taken
from sized d join quotas q on d.source is not distinct from q.source
  left join upto u on d.source is not distinct from u.source and d.drawn = u.drawn and d.size > 0
"""


def op13_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = materialise(turn_paths(table(spark, sf_dir, "conversations")), "turn-paths")
    head = (F.crc32(F.col("conv").cast("string")) % 6).cast("int")
    openings = own.filter("conv % 100 = 0").select(
        F.col("conv").alias("base"), F.slice("path", 1, 5).alias("opening")
    )
    joined = own.join(openings, F.col("conv") - F.col("conv") % 100 == F.col("base"), "left")
    opening = F.when(F.col("opening").isNotNull() & (head > 0), F.slice("opening", F.lit(1), head))
    rest = F.slice("path", head + 1, F.size("path"))
    rebuilt = F.concat(F.coalesce(opening, F.slice("path", 1, 0)), rest)
    trie = build_trie(joined.select("conv", rebuilt.alias("path")))
    nodes = trie.nodes.join(digest_ends(trie.ends), "key", "left")
    return nodes.select(
        F.col("conv").alias("conv_id"),
        "depth",
        F.col("parent_conv").alias("parent_conv_id"),
        "n_convs",
        "n_children",
        "n_leaves",
        F.col("saved").alias("saved_tokens"),
        F.coalesce("ends_sha256", F.sha2(F.lit(""), 256)).alias("ends_sha256"),
    )


OP13_SQL = """
with recursive ids as (select distinct conv_id, conv_id::varchar as s from conversations where conv_id is not null),
-- the CRC-32 of the number's digits, a bit at a time
crc(conv_id, s, bit, v) as (
  select conv_id, s, 0, 4294967295::ubigint from ids
  union all
  select conv_id, s, bit + 1, case when x & 1 = 1 then xor(x >> 1, 3988292384::ubigint) else x >> 1 end
  from (select *, case when bit % 8 = 0 then xor(v, ascii(s[bit // 8 + 1])::ubigint) else v end as x
    from crc where bit < 8 * length(s))),
heads as (select conv_id, (xor(v, 4294967295::ubigint) % 6)::bigint as h from crc where bit = 8 * length(s)),
own as (
  select conv_id, list({'r': coalesce(role, ''), 't': coalesce(text, '')} order by turn nulls first, role, text) as path
  from conversations where conv_id is not null group by conv_id),
rebuilt as materialized (
  select o.conv_id, list_concat(coalesce(b.path[1 : h], []), o.path[h + 1 :]) as path
  from own o join heads using (conv_id) left join own b on b.conv_id = o.conv_id - o.conv_id % 100),
members as materialized (
  select conv_id, d, md5(path[1 : d]::varchar) as k, case when d > 0 then md5(path[1 : d - 1]::varchar) end as pk,
    len(path) = d as ends, case when d > 0 then length(path[d].t) else 0 end as chars
  from (select conv_id, path, unnest(range(len(path) + 1)) as d from rebuilt)),
nodes as materialized (
  select k, d, any_value(pk) as pk, min(conv_id) as conv_id, count(*) as n, any_value(chars) as chars,
    coalesce(string_agg(conv_id::varchar, ',' order by conv_id) filter (ends), '') as ends
  from members group by k, d),
children as (select pk as k, d - 1 as d, count(*) as c from nodes where d > 0 group by all),
own_values as materialized (
  select n.*, coalesce(c, 0) as c from nodes n left join children using (k, d)),
-- every node and the nodes above it, through its least member
above as (
  select v.c, v.n, v.chars, m.k, m.d from own_values v join members m on m.conv_id = v.conv_id and m.d <= v.d),
subtrees as (
  select k, d, sum(case when c = 0 then 1 else 0 end) as leaves, sum((n - 1) * chars) as saved from above group by k, d)
select v.conv_id, v.d::bigint as depth, p.conv_id as parent_conv_id, v.n::bigint as n_convs, v.c::bigint as n_children,
  leaves::bigint as n_leaves, saved::bigint as saved_tokens, sha256(v.ends) as ends_sha256
from own_values v join subtrees using (k, d) left join nodes p on p.k = v.pk and p.d = v.d - 1
"""


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "op1_quality": op1_quality,
        "op2_pii": op2_pii,
        "op3_topk": op3_topk,
        "op4_jaccard": op4_jaccard,
        "op5_decontaminate": op5_decontaminate,
        "op6_secrets": op6_secrets,
        "op7_ppm": op7_ppm,
        "op8_token_files": op8_token_files,
        "op9_bpe": op9_bpe,
        "op10_language": op10_language,
        "op11_runs": op11_runs,
        "op12_mixture": op12_mixture,
        "op13_trie": op13_trie,
    }


def oracle_sql() -> dict[str, str]:
    return {"op3_topk": OP3_SQL, "op4_jaccard": OP4_SQL, "op12_mixture": OP12_SQL, "op13_trie": OP13_SQL}
