import numpy as np
import pandas as pd
import pytest
import xxhash
from pyspark.sql import functions as F

from gameflow.llm import simhash
from gameflow.llm.components import connected


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    n = max(1, len(words) - 2)
    hashes = [xxhash.xxh64_intdigest(b" ".join(words[i:i + 3]), 42) for i in range(n)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > n)


def brute_components(prints):
    """Smallest index reachable over links of at most three bits."""
    label = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= 3 and label[j] < label[i]:
                    label[i], changed = label[j], True
    return label


TEXTS = [
    None, "", " \t\n", "One", "one", "One Two", "one two three", "ONE TWO THREE", "one two three four",
    "É two three four", "a b c d e f g h i j " * 30, "a b c d e f g h i j " * 30 + "k", "x\x0by\x0cz w", "x y z w",
    "word " * 50_000, "a b c d",
]


def test_against_brute_force(spark):
    rows = [(i, t, "x", i) for i, t in enumerate(TEXTS)] + [(3, "One", "x", 3)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, fp string, root long")
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(frame).collect()}
    assert simhash.near_duplicates(frame).count() == len(rows)
    prints = [brute_fingerprint(t) for t in TEXTS]
    labels = brute_components(prints)
    assert got == {i: (f"{p:016x}", c) for i, (p, c) in enumerate(zip(prints, labels, strict=True))}


def test_links_join_all_that_are_near(spark, monkeypatch):
    rng = np.random.default_rng(5)
    prints = {int(x) for x in rng.integers(0, 1 << 63, 60)}
    for x in list(prints)[:20]:
        for _ in range(6):  # chains of near fingerprints
            for b in rng.choice(64, rng.integers(1, 5), replace=False):
                x ^= 1 << int(b)
            prints.add(x)
    prints = sorted(p - (1 << 64) if p >> 63 else p for p in prints)
    frame = spark.createDataFrame([(p,) for p in prints], "fp long")
    mask = (1 << 64) - 1
    labels = brute_components([p & mask for p in prints])
    expected = {}
    for p, c in zip(prints, labels, strict=True):
        expected.setdefault(c, set()).add(p)
    for searches, rows in ((20_000, 200_000), (8, 40), (1, 7)):  # whole shards, split ones, and dealt searches over many batches
        monkeypatch.setattr(simhash, "SHARD_SEARCHES", searches)
        monkeypatch.setattr(simhash, "TREE_ROWS", rows)
        found = {}
        for r in connected(simhash.links(frame)).collect():
            found.setdefault(r.root, set()).add(r.node)
        assert sorted(map(sorted, found.values())) == sorted(sorted(s) for s in expected.values() if len(s) > 1)


def test_tree_follows_distance(spark):
    rng = np.random.default_rng(1)
    fp = np.unique(rng.integers(0, 1 << 16, 500).astype(np.uint64))
    rng.shuffle(fp)
    trees = simhash.BKTrees(fp, np.zeros(len(fp), np.int64))
    depth_edge = trees.child_key[trees.roots:] % 128
    parents = trees.parent[trees.roots:]
    assert (np.bitwise_count(trees.fp[trees.roots:] ^ trees.fp[parents]) == depth_edge).all()
    got = sorted((int(a), int(b)) for x, y in trees.near(fp, np.zeros(len(fp), np.int64), 3) for a, b in zip(x, y, strict=True))
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 3
    assert got == [(int(a), int(b)) for a, b in zip(*np.nonzero(near), strict=True)]


@pytest.mark.parametrize("n", [2, 40])
def test_path_and_star_components(spark, n):
    path = spark.range(n).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    star = spark.range(n).select(F.lit(1000).cast("long").alias("a"), (F.col("id") + 1001).alias("b"))
    got = connected(path.union(star)).collect()
    groups = {}
    for r in got:
        groups.setdefault(r.root, set()).add(r.node)
    assert sorted(map(sorted, groups.values())) == [list(range(n + 1)), list(range(1000, 1001 + n))]


def test_keep_one(spark):
    rows = [(5, "one two three", 1), (2, "One two three", 2), (None, "ONE two three", 3), (7, "quite another text here", 4),
            (7, "quite another text here", 4)]
    got = simhash.keep_one(spark.createDataFrame(rows, "doc_id long, text string, fp int")).collect()
    assert sorted(map(tuple, got)) == [(2, "One two three", 2), (7, "quite another text here", 4)]


def test_keep_one_by_bits(spark):
    """Copies stay or go by the distance of their fingerprints, along chains too, whatever words they share."""
    rng = np.random.default_rng(11)
    texts = []
    for k in range(40):
        words = [f"w{x}" for x in rng.integers(0, 5000, int(rng.integers(64, 250)))]
        for _ in range(4):
            texts.append(" ".join(words))
            for at in rng.integers(0, len(words), 1 + k % 3):
                words[at] = "edited"
    labels = brute_components([brute_fingerprint(t) for t in texts])
    assert 60 < len(set(labels)) < 150
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert {r.doc_id for r in simhash.keep_one(frame).collect()} == set(labels)


def test_hot_shard_is_split(spark):
    """Very many fingerprints that agree on one block: each shard searched stays small, and no link is lost."""
    rng = np.random.default_rng(17)
    own = np.unique(rng.integers(0, 1 << 48, 200_000))
    near = own[:500] ^ (1 << rng.integers(0, 48, 500)) ^ (1 << rng.integers(0, 48, 500))
    prints = np.unique(np.concatenate([own, near])) | (0x5A5A << 48)
    frame = spark.createDataFrame(pd.DataFrame({"fp": prints})).repartition(8)
    shards = simhash._shards(frame).groupBy("key").agg(F.count("*").alias("n"), F.min("asks").alias("all")).agg(F.max("n"), F.min("all")).first()
    assert shards[0] <= simhash.SHARD_SEARCHES and shards[1]
    found = {frozenset((r.a, r.b)) for r in simhash.links(frame).collect()}
    assert {frozenset((int(a) | 0x5A5A << 48, int(b) | 0x5A5A << 48)) for a, b in zip(own[:500], near, strict=True) if a != b} <= found
    assert all((a ^ b).bit_count() <= 9 for a, b in map(tuple, found))  # a set's members hang under one that is a few links off


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(empty).collect() == [] == simhash.keep_one(empty).collect()
