"""Near copies by the Jaccard similarity of word shingles, joined through several token orders.

A document is the set of its distinct shingles of ``size`` words (ASCII capitals folded); with fewer words, the
whole sequence is one shingle. Two sets link when 100 * common >= ``percent`` * union, and the operator
gives each document the least id reachable over links.

If two sets link, they share a token among the first few of each - its *prefix* - under any order of all
tokens. Several orders are used. The first goes by rising frequency, from a table of fixed size that all
documents are counted into, and so keeps common passages out of the prefixes; it finds the candidates. The
place of the first shared token bounds the overlap too. The others go by hashes; a candidate must share
prefix tokens under each of them as well before the sets are compared.

Nothing is paired off within a group. Equal sets are one class from the start. Then, for every shared
prefix token, each class is compared with one *centre* only, the class that has it earliest. Links make
components; tokens whose classes are in one component by then are done. For the rest, classes of different
components are compared, in blocks of bounded size, which leaves out no pair that could link. A component
is found by alternating star contractions over tables, never on the driver.

Shingles, and classes, are told apart by 64-bit hashes. Null texts, and texts without words, have no
shingle and are linked with nothing: n_shingles 0, their own id as component. Documents with a null id take
part and get the least id of their component, null if there is none. Repeated rows are a row each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import bytes_of, map_batches, mix, pieces, texts_of, word_hashes, words_of
from tidewire.workspace import materialise

#: Counters of token frequency, and how many go together.
COUNTERS, PART = 1 << 20, 1 << 14
#: Orders by hash that a candidate must pass, besides the order by frequency.
SEEDS = (0x51ED270B, 0x2545F491)
#: Classes of one token that are compared in one group.
BLOCK = 1024
#: Classes whose texts are looked up by broadcast, at most; more are joined by a shuffle.
BROADCAST = 1_000_000


# ---- shingles -----------------------------------------------------------------------------------


def shingles_of(texts: pa.Array, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the shingles of all texts on end, repeats included, and where each text's begin."""
    data, offsets = bytes_of(texts)
    starts, ends, firsts = words_of(data, offsets)
    words = word_hashes(data, starts, ends)
    counts = np.diff(firsts)
    many = np.where(counts >= size, counts - size + 1, np.minimum(counts, 1))
    bounds = np.zeros(len(texts) + 1, np.int64)
    np.cumsum(many, out=bounds[1:])
    weights = mix(np.arange(1, size + 1, dtype=np.uint64)) | np.uint64(1)
    at = np.repeat(firsts[:-1] - bounds[:-1], many) + np.arange(bounds[-1])
    out = np.zeros(bounds[-1], np.uint64)
    padded = np.concatenate([words, np.zeros(size, np.uint64)])
    with np.errstate(over="ignore"):
        for step in range(size):
            out += padded[at + step] * weights[step]
        for row in np.flatnonzero((counts > 0) & (counts < size)):
            own = words[firsts[row] : firsts[row + 1]]
            out[bounds[row]] = (own * weights[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))
    return mix(out), bounds


def set_id(tokens: np.ndarray) -> int:
    """A hash of a set of tokens, whatever their order."""
    with np.errstate(over="ignore"):
        total = mix(tokens ^ np.uint64(0xA5A5A5A5)).sum(dtype=np.uint64) + np.uint64(len(tokens))
    return int(mix(np.array([total], np.uint64)).view(np.int64)[0])


@dataclass(frozen=True)
class Rule:
    """When sets link, in whole numbers."""

    size: int
    percent: int

    def prefix(self, n: int) -> int:
        """How many first tokens a set of n must look at: the rest is less than any overlap that links."""
        return n * (100 - self.percent) // 100 + 1

    def largest(self, n: Column, place: Column) -> Column:
        """The greatest size of a partner whose first shared token is at ``place`` of a set of ``n``."""
        return F.floor(((100 + self.percent) * (n - place) - self.percent * n) / F.lit(self.percent))

    def links(self, common: int, n: int, m: int) -> bool:
        return 100 * common >= self.percent * (n + m - common)


# ---- the order by frequency ---------------------------------------------------------------------


def count_tokens(texts: DataFrame, rule: Rule) -> np.ndarray:
    """Occurrences of all tokens of all texts, in ``COUNTERS`` counters."""
    schema = "part int, counts binary"

    def send(held: dict[int, np.ndarray]) -> pa.RecordBatch:
        packer = zstandard.ZstdCompressor(level=1)
        packed = [packer.compress(c.tobytes()) for c in held.values()]
        return pa.RecordBatch.from_pydict({"part": pa.array(list(held), pa.int32()), "counts": pa.array(packed, pa.binary())})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros(COUNTERS, np.int64)
        for batch in batches:
            for some in pieces(batch, "text"):
                tokens, _ = shingles_of(texts_of(some, "text"), rule.size)
                np.add.at(sums, (tokens & np.uint64(COUNTERS - 1)).astype(np.int64), 1)
        if sums.any():
            yield send({p: sums[p * PART : (p + 1) * PART] for p in range(COUNTERS // PART)})

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpacker, held = zstandard.ZstdDecompressor(), {}
        for batch in batches:
            for part, packed in zip(*(c.to_pylist() for c in batch.columns)):
                held.setdefault(part, np.zeros(PART, np.int64))
                held[part] += np.frombuffer(unpacker.decompress(packed), np.int64)
        if held:
            yield send(held)

    added = map_batches(map_batches(texts.select("text"), count, schema).repartition("part"), add, schema)
    table = np.zeros(COUNTERS, np.int64)
    unpacker = zstandard.ZstdDecompressor()
    for row in added.collect():  # COUNTERS / PART rows
        table[row["part"] * PART :][:PART] = np.frombuffer(unpacker.decompress(row["counts"]), np.int64)
    return np.minimum(table, (1 << 31) - 1).astype(np.int32)


def signatures(texts: DataFrame, rule: Rule, keep: Sequence[str]) -> DataFrame:
    """Per row: the columns ``keep``, n, set (its id, null if empty), the prefix under the order by frequency and
    those under the other orders."""
    # COUNTERS * 4 bytes
    shared = texts.sparkSession.sparkContext.broadcast(count_tokens(texts, rule))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            for some in pieces(batch, "text"):
                tokens, bounds = shingles_of(texts_of(some, "text"), rule.size)
                sizes, sets, prefixes, orders = [], [], [], []
                for a, b in zip(bounds, bounds[1:]):
                    own = np.unique(tokens[a:b])
                    often = table[(own & np.uint64(COUNTERS - 1)).astype(np.int64)]
                    first = np.lexsort((own, often))[: rule.prefix(len(own))]
                    sizes.append(len(own))
                    sets.append(set_id(own) if len(own) else None)
                    prefixes.append(own[first].view(np.int64))
                    orders.append(b"".join(hash_prefix(own, rule, seed).tobytes() for seed in SEEDS))
                made = {"n": pa.array(sizes, pa.int64()), "set": pa.array(sets, pa.int64())}
                made["prefix"] = pa.array(prefixes, pa.list_(pa.int64()))
                made["orders"] = pa.array(orders, pa.binary())
                kept = {name: some.column(some.schema.names.index(name)) for name in keep}
                yield pa.RecordBatch.from_pydict(kept | made)

    columns = ", ".join(f"`{name}` {dict(texts.dtypes)[name]}" for name in keep)
    return map_batches(texts, sign, f"{columns}, n bigint, set bigint, prefix array<bigint>, orders binary")


# ---- candidates ---------------------------------------------------------------------------------


def shared_postings(signed: DataFrame, rule: Rule) -> DataFrame:
    """Prefix tokens that classes share, with the place in each and the centre of the token.

    ``most`` is the greatest size of a partner for which the token is the first that they share; of two
    partners the smaller one must have it early enough for one of its own size.
    """
    classes = signed.filter("n > 0").select("set", "n", "prefix").dropDuplicates(["set"])
    # dealt by token once, for the sums and for the join
    posted = classes.select("set", "n", F.posexplode("prefix").alias("place", "token")).repartition("token")
    most = rule.largest(F.col("n"), F.col("place"))
    early = F.when(most >= F.col("n"), F.col("n"))
    tokens = (
        posted.groupBy("token")
        .agg(F.count("*").alias("many"), F.min(early).alias("least"), F.min(F.struct("place", "n", "set")).alias("centre"))
        .filter("many > 1 and least is not null")
    )
    return posted.join(tokens, "token").filter((most >= F.col("n")) | (F.col("least") <= most)).drop("least")


def centre_pairs(posted: DataFrame, rule: Rule) -> DataFrame:
    """Each class with the centres of its tokens, once."""
    other = F.col("centre.set")
    fit = _fit(rule, F.col("n"), F.col("place"), F.col("centre.n"), F.col("centre.place"))
    return _ordered(posted.filter((F.col("set") != other) & fit), F.col("set"), other)


def _fit(rule: Rule, n: Column, place: Column, m: Column, spot: Column) -> Column:
    """Whether two sets can still link when their first shared token is at these places."""
    common = F.least(n - place, m - spot)
    return (100 + rule.percent) * common >= rule.percent * (n + m)


def _ordered(rows: DataFrame, a: Column, b: Column) -> DataFrame:
    return rows.select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def open_pairs(posted: DataFrame, found: DataFrame, rule: Rule) -> DataFrame:
    """Candidates of different components: all pairs of classes that share a token and may link by size and place.

    Tokens with more than ``BLOCK`` classes are cut by a hash of the class; every two parts meet in a group.
    """
    known = posted.join(found, "set", "left").withColumn("root", F.coalesce("root", "set")).drop("centre")
    still = known.groupBy("token").agg(F.min("root").alias("low"), F.max("root").alias("high"))
    rows = known.join(still.filter("low <> high").select("token"), "token")
    parts = F.ceil(F.col("many") / F.lit(BLOCK // 2)).cast("int")
    own = F.pmod(F.xxhash64("set"), parts).cast("int")
    cut = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), parts - 1)))
    cut = cut.withColumns({"low": F.least("own", "other"), "high": F.greatest("own", "other")})
    group = ["token", "low", "high"]
    dealt = cut.select(*group, "own", "set", "n", "place", "root").repartition(*group).sortWithinPartitions(*group)

    def pair(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for run in _runs(batches, 3):
            yield _pairs_of(run, rule)

    return map_batches(dealt, pair, "a bigint, b bigint").distinct()


def _runs(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[np.ndarray]:
    """Whole-number rows, many complete groups of equal keys at a time (rows are sorted by their first columns)."""
    held = None
    for batch in batches:
        rows = np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns])
        held = rows if held is None else np.concatenate([held, rows], 1)
        change = np.flatnonzero((held[:keys, 1:] != held[:keys, :-1]).any(0))
        if len(change):
            yield held[:, : change[-1] + 1]
            held = held[:, change[-1] + 1 :]
    if held is not None and held.shape[1]:
        yield held


def _pairs_of(run: np.ndarray, rule: Rule) -> pa.RecordBatch:
    """Pairs within each group of the run that pass the tests; in a group of two parts, only across them."""
    cuts = np.flatnonzero((run[:3, 1:] != run[:3, :-1]).any(0)) + 1
    firsts, seconds = [], []
    for a, b in zip([0, *cuts], [*cuts, run.shape[1]]):
        if b - a < 2:
            continue
        _, low, high, own, ids, n, place, root = run[:, a:b]
        rest = n - place
        fit = np.triu(root[:, None] != root[None, :], 1)
        if low[0] != high[0]:
            fit &= own[:, None] != own[None, :]
        fit &= (100 + rule.percent) * np.minimum(rest[:, None], rest[None, :]) >= rule.percent * (n[:, None] + n[None, :])
        x, y = np.nonzero(fit)
        firsts.append(np.minimum(ids[x], ids[y]))
        seconds.append(np.maximum(ids[x], ids[y]))
    none = np.zeros(0, np.int64)
    left, right = np.concatenate([none, *firsts]), np.concatenate([none, *seconds])
    return pa.RecordBatch.from_pydict({"a": pa.array(left), "b": pa.array(right)})


# ---- verification -------------------------------------------------------------------------------


def hash_prefix(tokens: np.ndarray, rule: Rule, seed: int) -> np.ndarray:
    """The first tokens of a set by a hash with a seed, as 16 bits of it, sorted.

    Tokens that share the bits only let a pair pass that is compared in full later.
    """
    first = rule.prefix(len(tokens))
    ranks = mix(tokens ^ np.uint64(seed))
    if first < len(ranks):
        ranks = np.partition(ranks, first - 1)[:first]
    return np.sort((mix(ranks) & np.uint64(0xFFFF)).astype(np.uint16))


def class_orders(signed: DataFrame, posted: DataFrame) -> DataFrame:
    """The prefixes of the classes with candidates under the other orders."""
    # once per class in each task, before any join: a class may have very many rows
    once = signed.filter("n > 0").select("set", "orders").dropDuplicates(["set"])
    return once.join(posted.select("set").distinct(), "set", "left_semi")


def sharing(pairs: DataFrame, orders: DataFrame) -> DataFrame:
    """The pairs that share prefix tokens under every other order too."""
    sides = pairs.join(orders.toDF("a", "left"), "a").join(orders.toDF("b", "right"), "b").select("a", "b", "left", "right")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            kept = [at for at, (left, right) in enumerate(sides) if _meet(left, right)]
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return map_batches(sides, test, "a bigint, b bigint")


def _meet(left: bytes, right: bytes) -> bool:
    """Whether two classes share a value under each order."""
    x, y = (np.frombuffer(side, np.uint16).reshape(len(SEEDS), -1) for side in (left, right))
    return all(not set(a.tolist()).isdisjoint(b.tolist()) for a, b in zip(x, y))


def sets_of_pairs(pairs: DataFrame, texts: DataFrame, signed: DataFrame, rule: Rule) -> DataFrame:
    """The sets of all classes in the pairs: set, tokens."""
    wanted = pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct()
    keys = signed.filter("n > 0").groupBy("set").agg(F.min("key").alias("key")).join(wanted, "set")
    keys = materialise(keys, "wanted")
    # a class has 16 bytes here
    few = keys.count() <= BROADCAST
    some = texts.join(F.broadcast(keys) if few else keys, "key").select("key", "set", "text").dropDuplicates(["key"])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                tokens, bounds = shingles_of(texts_of(part, "text"), rule.size)
                own = [np.unique(tokens[a:b]).tobytes() for a, b in zip(bounds, bounds[1:])]
                yield pa.RecordBatch.from_pydict({"set": part.column(0), "tokens": pa.array(own, pa.binary())})

    return map_batches(some.select("set", "text"), cut, "set bigint, tokens binary")


def _common(x: np.ndarray, y: np.ndarray) -> int:
    """How many values two sorted arrays of distinct values share."""
    both = np.concatenate([x, y])
    both.sort(kind="stable")
    return int((both[1:] == both[:-1]).sum())


def verify(pairs: DataFrame, sets: DataFrame, rule: Rule) -> DataFrame:
    """The pairs whose sets link."""
    sides = pairs.join(sets.toDF("a", "left"), "a").join(sets.toDF("b", "right"), "b").select("a", "b", "left", "right")

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = []
            for at in range(batch.num_rows):
                x, y = (np.frombuffer(batch.column(c)[at].as_buffer(), np.uint64) for c in (2, 3))
                if rule.links(_common(x, y), len(x), len(y)):
                    kept.append(at)
            yield batch.select(["a", "b"]).take(pa.array(kept, pa.int64()))

    return map_batches(sides, test, "a bigint, b bigint")


def links_among(pairs: DataFrame, orders: DataFrame, texts: DataFrame, signed: DataFrame, rule: Rule) -> DataFrame:
    """The candidates that pass all orders and whose sets link."""
    passed = materialise(sharing(pairs, orders), "passed")
    sets = materialise(sets_of_pairs(passed, texts, signed, rule), "sets")
    return materialise(verify(passed, sets, rule), "linked")


# ---- components ---------------------------------------------------------------------------------


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Each linked node with the least node of its component: set, root. Alternating star contractions."""
    edges = materialise(_down(links.select(F.col(a).alias("u"), F.col(b).alias("v"))), "links")
    before = None
    while (now := edges.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()) != before:
        before = now
        both = edges.union(edges.select("v", "u"))
        least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
        large = _down(both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")))
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u")
        edges = small.select("u", F.col("m").alias("v")).union(small.select("v", "m").toDF("u", "v"))
        edges = materialise(_down(edges), "links")
    return edges.groupBy("u").agg(F.min("v").alias("root")).withColumnRenamed("u", "set")


def _down(edges: DataFrame) -> DataFrame:
    """Edges from the greater to the lesser node, once."""
    return edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


# ---- the operator -------------------------------------------------------------------------------


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 5,
    percent: int = 80,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Per row of ``docs``: its id, n_shingles, component_id (least id of its component), component (a number for
    it, null without shingles), and the columns ``keep``."""
    if not 0 < percent <= 100 or size < 1:
        raise ValueError("a similarity of 1 to 100 percent and a size from 1 are needed")
    rule = Rule(size, percent)
    # ids may repeat or be null: texts are found again by id and text
    texts = docs.select(
        F.col(id_col).alias("id"),
        F.col(text_col).cast("string").alias("text"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("key"),
        *[F.col(c).alias(f"keep_{at}") for at, c in enumerate(keep)],
    )
    held = ["id", "key", *[f"keep_{at}" for at in range(len(keep))]]
    signed = materialise(signatures(texts, rule, held), "signatures")
    posted = materialise(shared_postings(signed, rule), "postings")
    orders, bodies = materialise(class_orders(signed, posted), "orders"), texts.select("key", "text")
    first = links_among(centre_pairs(posted, rule), orders, bodies, signed, rule)
    found = materialise(components(first), "components")
    more = links_among(open_pairs(posted, found, rule), orders, bodies, signed, rule)
    found = components(first.union(more))

    classes = signed.filter("n > 0").groupBy("set").agg(F.min("id").alias("id")).join(found, "set", "left")
    classes = materialise(classes.withColumn("root", F.coalesce("root", "set")), "classes")
    least = classes.groupBy("root").agg(F.min("id").alias("component_id"))
    named = classes.join(least, "root").select("set", "root", "component_id")
    return signed.join(named, "set", "left").select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"),
        F.col("root").alias("component"),
        *[F.col(f"keep_{at}").alias(c) for at, c in enumerate(keep)],
    )
