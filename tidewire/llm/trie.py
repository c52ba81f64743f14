"""A trie over conversations, built as burst tries are: suffix containers under a few heads, then sorted and swept.

A conversation is a path of turn ids (md5 of role and text). At first the root is the only head, and everything
hangs under it in one container per next turn id. A container with more than a bounded number of turns bursts:
its own node becomes a head, and its suffixes are dealt to new containers by their next turn id. This goes on
until all containers are small. Then each container is sorted, and swept once with a stack, which gives its nodes
from the leaves up. What the containers say of their top nodes is added up into the heads.

A node is known by its key: the md5 of its parent's key and its turn id. Equal paths are put together before
anything is dealt, so thousands of copies are one path with a count; and a container holds 2^18 turns at most (or
one path), so a first turn that a third of all conversations share spreads over many. There are as many
rounds as the deepest head lies deep; each counts what is still open with a map-side sum and stores it.

Rows: turns without a conversation id belong to none and are left out. Turns are ordered by number, null first,
then by id; a null role or text is empty. A conversation's turn ids (20 bytes each) are held together, as one array. No
conversation at all gives no node; a conversation without turns is a member of the root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidewire.llm.common import map_batches
from tidewire.workspace import materialise, small_frame

PATH = "array<struct<id: binary, chars: bigint>>"
NODES = (
    "key binary, parent binary, depth bigint, conv bigint, parent_conv bigint, chars bigint, n_convs bigint,"
    " n_children bigint, n_leaves bigint, saved bigint"
)
ROOT = hashlib.md5(b"").digest()
#: A container bursts beyond this number of turns, or beyond 1/4096 of all if that is less, but not below the least.
MOST_TURNS, LEAST_TURNS, PARTS = 1 << 18, 1 << 10, 4096
#: Heads of one depth that are broadcast, at some 100 bytes each; beyond that they are joined by a shuffle.
BROADCAST_HEADS = 200_000


@dataclass(frozen=True)
class Trie:
    """``nodes`` (``NODES``; the root has no parent) and ``ends``: the node's key at which each ``conv`` ends."""

    nodes: DataFrame
    ends: DataFrame


def turn_paths(
    turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """One row per conversation: ``conv`` and ``path``, an array of (id, chars) per turn in order."""
    said = F.coalesce(F.col(text), F.lit(""))
    who = F.coalesce(F.col(role), F.lit(""))
    # the length of the role keeps (a, bc) and (ab, c) apart
    named = F.unhex(F.md5(F.concat_ws("|", F.length(who).cast("string"), who, said)))
    number = F.col(turn)
    one = F.struct(
        number.isNotNull().alias("a"), number.alias("n"), named.alias("id"), F.length(said).cast("bigint").alias("chars")
    )
    rows = turns.filter(F.col(conv).isNotNull()).select(F.col(conv).alias("conv"), one.alias("t"))
    ordered = F.transform(F.array_sort(F.collect_list("t")), lambda t: F.struct(t["id"].alias("id"), t["chars"].alias("chars")))
    return rows.groupBy("conv").agg(ordered.alias("path"))


def _chained(path: Column) -> Column:
    return F.aggregate(path, F.lit(ROOT), lambda key, turn: _child(key, turn["id"]))


def _child(key: Column, turn: Column) -> Column:
    return F.unhex(F.md5(F.concat(key, turn)))


def build_trie(paths: DataFrame, most_turns: int | None = None) -> Trie:
    """The trie of ``paths`` (``conv`` bigint, unique, and ``path`` as from ``turn_paths``)."""
    keyed = materialise(paths.select("conv", "path", _chained(F.col("path")).alias("end")), "trie-paths")
    ends = keyed.select(F.col("end").alias("key"), "conv")
    # copies go together; of the path, which is the same in all, any
    counted = keyed.groupBy("end").agg(
        F.count("*").alias("n"), F.min("conv").alias("conv"), F.first("path").alias("path")
    )
    open_rows = materialise(
        counted.select("path", "n", "conv", F.lit(ROOT).alias("head"), F.lit(None).cast("bigint").alias("head_conv")),
        "trie-open",
    )
    turns, convs, low = open_rows.agg(F.sum(F.size("path")), F.sum("n"), F.min("conv")).first()
    if not convs:
        return Trie(small_frame(keyed.sparkSession, [], NODES), ends)
    limit = most_turns or max(LEAST_TURNS, min(MOST_TURNS, turns // PARTS))
    heads, held = _burst(open_rows, limit, convs, low)
    swept = materialise(_sweep(held), "trie-nodes")
    return Trie(_with_heads(swept, heads), ends)


def _burst(open_rows: DataFrame, limit: int, convs: int, low: int) -> tuple[DataFrame, DataFrame]:
    """The heads, each with the keys from the root to itself as ``line``; and the rows of all final containers."""
    spark = open_rows.sparkSession
    open_rows = open_rows.withColumn("head_conv", F.lit(low).cast("bigint"))
    # stored, as a key that is a literal would turn joins into products with its one row
    root = materialise(spark.range(1).select(
        F.lit(ROOT).alias("key"), F.lit(None).cast("binary").alias("parent"), F.lit(0).cast("bigint").alias("depth"),
        F.lit(low).cast("bigint").alias("conv"), F.lit(None).cast("bigint").alias("parent_conv"),
        F.lit(0).cast("bigint").alias("chars"), F.lit(convs).cast("bigint").alias("n_convs"),
        F.array(F.lit(ROOT)).alias("line"),
    ), "trie-heads")
    heads, held, latest, depth = [root], [], root, 0
    while True:
        step = F.col("path")[depth]
        # conversations that end at a head are counted there, and hang under it no more
        going = open_rows.filter(F.size("path") > depth).withColumn("box", _child(F.col("head"), step["id"]))
        boxes = going.groupBy("head", "box").agg(
            F.sum("n").alias("n_convs"),
            F.min("conv").alias("conv"),
            F.sum(F.size("path") - depth).alias("turns"),
            F.count("*").alias("paths"),
            F.first(step["chars"]).alias("chars"),
            F.first("head_conv").alias("parent_conv"),
        )
        big = boxes.filter((F.col("turns") > limit) & (F.col("paths") > 1))
        lines = latest.select(F.col("key").alias("head"), "line")
        burst = materialise(
            big.join(lines, "head").select(
                F.col("box").alias("key"), F.col("head").alias("parent"), F.lit(depth + 1).cast("bigint").alias("depth"),
                "conv", "parent_conv", "chars", "n_convs", F.concat("line", F.array("box")).alias("line"),
            ),
            "trie-heads",
        )
        many = burst.count()
        if not many:
            return reduce(DataFrame.unionByName, heads), reduce(DataFrame.unionByName, [*held, _boxed(going, depth)])
        marks = burst.select(F.col("key").alias("box"), F.col("conv").alias("box_conv"))
        if many <= BROADCAST_HEADS:
            marks = F.broadcast(marks)
        held.append(_boxed(going.join(marks.select("box"), "box", "left_anti"), depth))
        open_rows = materialise(
            going.join(marks, "box").select(
                "path", "n", "conv", F.col("box").alias("head"), F.col("box_conv").alias("head_conv")
            ),
            "trie-open",
        )
        heads.append(burst)
        latest, depth = burst, depth + 1


def _boxed(rows: DataFrame, depth: int) -> DataFrame:
    return rows.select("box", "head", "head_conv", F.lit(depth).alias("above"), "path", "n", "conv")


class _Node:
    """A node that is still open: what is known of it so far."""

    __slots__ = ("key", "turn", "chars", "conv", "n", "children", "leaves", "saved", "closed")

    def __init__(self, key: bytes, turn: bytes, chars: int):
        self.key, self.turn, self.chars = key, turn, chars
        self.conv, self.n, self.children, self.leaves, self.saved = None, 0, 0, 0, 0
        #: rows of its children, which wait for the least conversation of this node
        self.closed: list[tuple] = []


def _sweep(held: DataFrame) -> DataFrame:
    """The nodes of all containers: a container's rows lie together, in order of their paths."""
    ids = F.transform("path", lambda t: t["id"])
    # the paths of a container agree up to its top, so the order is that of what hangs under the head
    rows = held.withColumn("ids", ids).withColumn("chars", F.transform("path", lambda t: t["chars"])).drop("path")
    sorted_rows = rows.repartition("box").sortWithinPartitions("box", "ids")
    return map_batches(sorted_rows, _swept, NODES)


_SCHEMA = pa.schema(
    [("key", pa.binary()), ("parent", pa.binary())]
    + [(c, pa.int64()) for c in ("depth", "conv", "parent_conv", "chars", "n_convs", "n_children", "n_leaves", "saved")]
)


def _swept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sweep sorted rows; the stack is the path from the top of the container to the last row's end."""
    done: list[tuple] = []
    stack: list[_Node] = []
    box = head = head_conv = None
    above = 0

    def close() -> None:
        """The last node of the stack is complete."""
        node = stack.pop()
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * node.chars
        depth = above + len(stack) + 1
        done.extend((key, node.key, depth + 1, conv, node.conv, *rest) for key, conv, *rest in node.closed)
        own = (node.key, node.conv, node.chars, node.n, node.children, node.leaves, node.saved)
        if not stack:
            key, conv, *rest = own
            done.append((key, head, depth, conv, head_conv, *rest))
            return
        over = stack[-1]
        over.closed.append(own)
        over.conv = node.conv if over.conv is None else min(over.conv, node.conv)
        over.n += node.n
        over.children += 1
        over.leaves += node.leaves
        over.saved += node.saved

    for batch in batches:
        for row in batch.to_pylist():
            if row["box"] != box:
                while stack:
                    close()
                box, head, head_conv, above = row["box"], row["head"], row["head_conv"], row["above"]
            ids, chars = row["ids"][above:], row["chars"][above:]
            same = 0
            while same < len(stack) and same < len(ids) and stack[same].turn == ids[same]:
                same += 1
            while len(stack) > same:
                close()
            for place in range(same, len(ids)):
                key = stack[-1].key if stack else head
                stack.append(_Node(hashlib.md5(key + ids[place]).digest(), ids[place], chars[place]))
            # this path ends at the last node; paths that go on come later
            last = stack[-1]
            last.n += row["n"]
            last.conv = row["conv"] if last.conv is None else min(last.conv, row["conv"])
            if len(done) >= 20_000:
                yield _batch(done)
                done.clear()
    while stack:
        close()
    yield _batch(done)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [()] * len(_SCHEMA)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _SCHEMA)], schema=_SCHEMA)


def _with_heads(swept: DataFrame, heads: DataFrame) -> DataFrame:
    """The nodes of the containers and the heads, to which the top nodes and the heads below are added up."""
    lines = heads.select("key", "line")
    few = heads.count() <= BROADCAST_HEADS
    tops = swept.join(
        F.broadcast(lines.withColumnRenamed("key", "parent")) if few else lines.withColumnRenamed("key", "parent"), "parent"
    )
    below = tops.groupBy("parent").agg(
        F.count("*").alias("n_children"), F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved")
    )
    # a head is a child of its own parent, and all that it adds is for all above it
    own = heads.withColumn("saved", (F.col("n_convs") - 1) * F.col("chars"))
    parts = own.join(below.withColumnRenamed("saved", "under").withColumnRenamed("parent", "key"), "key", "left")
    upward = parts.select(
        F.explode("line").alias("key"),
        F.coalesce("n_leaves", F.lit(0)).alias("n_leaves"),
        (F.col("saved") + F.coalesce("under", F.lit(0))).alias("saved"),
    )
    sums = upward.groupBy("key").agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved").alias("saved"))
    children = (
        heads.filter("parent is not null").select("parent", F.lit(1).cast("bigint").alias("n_children"))
        .unionByName(below.select("parent", "n_children"))
        .groupBy(F.col("parent").alias("key")).agg(F.sum("n_children").alias("n_children"))
    )
    full = heads.join(sums, "key").join(children, "key", "left").select(
        "key", "parent", "depth", "conv", "parent_conv", "chars", "n_convs",
        F.coalesce("n_children", F.lit(0)).alias("n_children"),
        # only the root can be without children
        F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
        "saved",
    )
    return swept.unionByName(full)


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """SHA-256 over the ids of each key, which lie together in order; only the running hash is held."""
    key, running, keys, sums = None, None, [], []
    for batch in batches:
        for place, conv in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if place != key:
                if running is not None:
                    keys.append(key)
                    sums.append(running.hexdigest())
                key, running = place, hashlib.sha256(b"%d" % conv)
            else:
                running.update(b",%d" % conv)
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(sums, pa.string())], names=["key", "ends_sha256"])
        keys, sums = [], []
    if running is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([running.hexdigest()])], names=["key", "ends_sha256"])


def digest_ends(ends: DataFrame) -> DataFrame:
    """``key`` and ``ends_sha256``: the hash of the conversations that end at a node, in order, comma-joined.

    One hash is one sequence: the ids of a node with very many ends pass through one task, as a stream."""
    ordered = ends.select("key", "conv").repartition("key").sortWithinPartitions("key", "conv")
    return map_batches(ordered, _digested, "key binary, ends_sha256 string")
