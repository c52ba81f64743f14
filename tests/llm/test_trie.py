"""The trie of conversations against a plain dictionary of prefixes, at several sizes of containers."""

import hashlib
import random
from collections import defaultdict

import pytest
from tidewire.llm.trie import PATH, ROOT, build_trie, digest_ends, turn_paths


def brute(paths):
    """(depth, conv) -> parent conv, n_convs, n_children, n_leaves, saved, ends, by prefixes as tuples."""
    members = defaultdict(list)
    for conv, path in paths:
        for d in range(len(path) + 1):
            members[tuple(path[:d])].append(conv)
    children = defaultdict(int)
    for prefix in members:
        if prefix:
            children[prefix[:-1]] += 1
    leaves, saved = defaultdict(int), defaultdict(int)
    for prefix, convs in members.items():
        for d in range(len(prefix) + 1):
            leaves[prefix[:d]] += prefix not in children
            saved[prefix[:d]] += (len(convs) - 1) * (prefix[-1][1] if prefix else 0)
    ends = defaultdict(list)
    for conv, path in paths:
        ends[tuple(path)].append(conv)
    return sorted(
        (len(p), min(c), min(members[p[:-1]]) if p else -1, len(c), children[p], leaves[p], saved[p], sorted(ends[p]))
        for p, c in members.items()
    )


def frame(spark, paths):
    rows = [(c, [(hashlib.md5(name.encode()).digest(), n) for name, n in path]) for c, path in paths]
    return spark.createDataFrame(rows, f"conv bigint, path {PATH}")


def built(spark, paths, most=None):
    trie = build_trie(frame(spark, paths), most)
    ends = defaultdict(list)
    for r in trie.ends.collect():
        ends[bytes(r.key)].append(r.conv)
    hashes = {bytes(r.key): r.ends_sha256 for r in digest_ends(trie.ends).collect()}
    assert hashes == {k: hashlib.sha256(",".join(map(str, sorted(v))).encode()).hexdigest() for k, v in ends.items()}
    nodes = trie.nodes.collect()
    keys = {bytes(r.key) for r in nodes}
    assert len(keys) == len(nodes) and all(r.parent is None or bytes(r.parent) in keys for r in nodes)
    return sorted(
        (r.depth, r.conv, -1 if r.parent_conv is None else r.parent_conv, r.n_convs, r.n_children, r.n_leaves, r.saved,
         sorted(ends.get(bytes(r.key), [])))
        for r in nodes
    )


def some_paths(seed, n=400):
    """Shared first turns, copies, prefixes of others, no turns at all."""
    rng = random.Random(seed)
    turn = lambda d: (f"{d}:{min(int(rng.expovariate(0.6)), 9)}", rng.randint(3, 3) + d)
    paths = []
    for c in range(n):
        path = [turn(d) for d in range(rng.randint(0, 7))]
        if paths and rng.random() < 0.3:
            old = rng.choice(paths)[1]
            path = old[: rng.randint(0, len(old))] + path[len(old) :]
        paths.append((1000 - c, path))
    return paths


@pytest.mark.parametrize("most", [1, 7, 100, None])
def test_same_as_brute_force(spark, most):
    paths = some_paths(most or 5)
    assert built(spark, paths, most) == brute(paths)


@pytest.mark.parametrize("most", [2, None])
def test_copies_and_deep_paths(spark, most):
    deep = [(str(i), i % 5) for i in range(40)]
    paths = [(i, deep) for i in range(300)] + [(1000, deep[:30]), (1001, deep[:30] + [("other", 9)]), (1002, [])]
    assert built(spark, paths, most) == brute(paths)


def test_only_empty_conversations(spark):
    assert built(spark, [(5, []), (3, [])]) == [(0, 3, -1, 2, 0, 1, 0, [3, 5])]


def test_nothing(spark):
    trie = build_trie(frame(spark, []))
    assert trie.nodes.collect() == [] and trie.ends.collect() == [] and digest_ends(trie.ends).collect() == []


def test_paths_of_turns(spark):
    rows = [
        (1, 2, "user", "b", 0), (1, None, None, None, 0), (1, 1, "user", "a", 0), (None, 1, "user", "lost", 0),
        (2, 1, "us", "era", 0), (3, 1, "", "usera", 0), (4, 5, "x", "long " * 200_000, 0), (5, 1, "user", "a", 0),
        (6, 1, "user", "é€😀", 0), (7, 1, "user", "a", 0), (7, 1, "user", "a", 0),
    ]
    turns = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, path int")
    paths = {r.conv: r.path for r in turn_paths(turns).collect()}
    assert sorted(paths) == [1, 2, 3, 4, 5, 6, 7]
    assert [t.chars for t in paths[1]] == [0, 1, 1]
    assert paths[1][1].id == paths[5][0].id != paths[1][2].id
    assert len({bytes(paths[c][0].id) for c in (1, 2, 3, 5)}) == 4
    assert paths[4][0].chars == 1_000_000 and paths[6][0].chars == 3 and len(paths[7]) == 2
    trie = build_trie(turn_paths(turns))
    root = trie.nodes.filter("depth = 0").first()
    assert bytes(root.key) == ROOT and root.n_convs == 7 and root.conv == 1
