"""Near-duplicates by SimHash fingerprints and BK-trees.

Fingerprints that differ in at most three of 64 bits agree on one of four blocks of 16 bits, so
each fingerprint goes into four shards, by the values of its blocks, and links are sought within
shards only. A shard of many fingerprints is split again: its members agree on one block, so those
that are near agree on one of four blocks of the other bits too. A shard's fingerprints form a BK-tree: the children of a node hang at their Hamming
distance to it, and a search follows the edges within the radius of the distance it finds. The
trees of all shards that a task holds are built and searched level by level as arrays.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gameflow.llm.components import connected
from gameflow.llm.store import stored
from gameflow.llm.texts import LOWER, Block, blocks

SHINGLE_WORDS = 3
SEED = 42
RADIUS = 3
BLOCKS = RADIUS + 1
#: How often the bits are cut into blocks: 16 bits, 12 of the other 48, 9 of the other 36.
LEVELS = 3
#: A shard of more fingerprints is split; on the last level its searches go to several tasks, each with the whole tree.
SHARD_SEARCHES = 20_000
#: Fingerprints whose trees a task holds at once; a larger shard is held alone.
TREE_ROWS = 200_000
#: Pairs (search, node) that are looked at in one go.
FRONTIER = 1 << 20


def _fingerprints(block: Block) -> np.ndarray:
    lowered = LOWER[block.data].tobytes()
    digest = xxhash.xxh64_intdigest
    hashes: list[int] = []
    counts = np.zeros(len(block), np.int64)
    for i in range(len(block)):
        words = lowered[block.offsets[i]:block.offsets[i + 1]].split()
        if not words:
            continue
        text = b" ".join(words)
        n = max(1, len(words) - SHINGLE_WORDS + 1)
        end = np.cumsum([len(w) + 1 for w in words]) - 1
        start = np.concatenate(([0], end[:-1] + 1))
        last = end[min(len(words), SHINGLE_WORDS) - 1:]
        hashes += [digest(text[a:b], SEED) for a, b in zip(start[:n].tolist(), last.tolist(), strict=True)]
        counts[i] = n
    result = np.zeros(len(block), np.uint64)
    filled = np.flatnonzero(counts)
    if len(filled):
        bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, 8), axis=1)
        first = np.concatenate(([0], np.cumsum(counts[filled])[:-1]))
        ones = np.add.reduceat(bits, first, axis=0, dtype=np.int64)
        majority = np.packbits(2 * ones > counts[filled][:, None], axis=1)
        result[filled] = majority.view(">u8").ravel()
    return result


def fingerprints(docs: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns of each row and ``fp``, the fingerprint's 64 bits as a long."""
    types = dict(docs.select(*keep).dtypes)
    schema = ", ".join([*(f"`{c}` {types[c]}" for c in keep), "fp bigint"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [_fingerprints(b) for b in blocks(batch.column(batch.num_columns - 1))]
            fp = np.concatenate(parts).view(np.int64) if parts else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(fp)], names=[*keep, "fp"])

    return docs.select(*keep, F.col("text").cast("string").alias("__text")).mapInArrow(run, schema)


class BKTrees:
    """BK-trees over distinct fingerprints, one for each run of equal ``shard`` values.

    Nodes are numbered by level. ``edge`` is the distance to the parent; the children of a node
    stand together in ascending ``edge``, in ``child_key`` order of ``parent * 128 + edge``.
    """

    def __init__(self, fp: np.ndarray, shard: np.ndarray):
        group = np.cumsum(np.concatenate(([0], shard[1:] != shard[:-1]))) if len(shard) else shard
        rest, parent = np.arange(len(fp)), np.full(len(fp), -1)
        edge = np.zeros(len(fp), np.int64)
        order, parents, edges, done = [], [], [], 0
        while len(rest):
            # The first of each group becomes a node; the others are dealt out by distance to it.
            lead = np.concatenate(([True], group[1:] != group[:-1]))
            order.append(rest[lead])
            parents.append(parent[lead])
            edges.append(edge[lead])
            node_of = np.cumsum(lead) - 1
            inner = ~lead
            distance = np.bitwise_count(fp[rest[inner]] ^ fp[rest[lead]][node_of[inner]]).astype(np.int64)
            key = node_of[inner] * 128 + distance
            by = np.argsort(key, kind="stable")
            rest, key = rest[inner][by], key[by]
            parent, edge = key // 128 + done, key % 128
            group = key
            done += int(lead.sum())
        self.order = np.concatenate(order) if order else np.zeros(0, np.int64)
        self.fp = fp[self.order]
        self.parent = np.concatenate(parents) if parents else np.zeros(0, np.int64)
        self.child_key = self.parent * 128 + (np.concatenate(edges) if edges else 0)
        self.roots = int((self.parent < 0).sum())
        self.shard_of_root = np.cumsum(np.concatenate(([0], shard[1:] != shard[:-1]))) if len(shard) else shard

    def near(self, fp: np.ndarray, root: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (search, place of a fingerprint within the radius), found from each search's root."""
        step = max(1, FRONTIER // 64)
        keys = self.child_key[self.roots:]
        for first in range(0, len(fp), step):
            stack = [(np.arange(first, min(first + step, len(fp))), root[first:first + step])]
            while stack:
                ask, node = stack.pop()
                distance = np.bitwise_count(fp[ask] ^ self.fp[node]).astype(np.int64)
                hit = distance <= radius
                if hit.any():
                    yield ask[hit], self.order[node[hit]]
                low = np.searchsorted(keys, node * 128 + np.maximum(distance - radius, 0))
                high = np.searchsorted(keys, node * 128 + distance + radius, side="right")
                n = high - low
                some = n > 0
                ask, low, n = ask[some], low[some], n[some]
                while len(n):  # children of many nodes at once, but of no more than fit
                    upto = int(np.searchsorted(np.cumsum(n), FRONTIER)) + 1
                    part = n[:upto]
                    offset = np.arange(part.sum()) - np.repeat(np.cumsum(part) - part, part)
                    stack.append((np.repeat(ask[:upto], part), np.repeat(low[:upto], part) + offset + self.roots))
                    ask, low, n = ask[upto:], low[upto:], n[upto:]


def _merge(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Joins the sets of a[i] and b[i]; ``label`` leads to the smallest member of each set."""
    while True:
        x, y = label[a], label[b]
        differ = x != y
        if not differ.any():
            return
        a, b, x, y = a[differ], b[differ], x[differ], y[differ]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while True:
            up = label[label]
            if np.array_equal(up, label):
                break
            label[:] = up


def _shard_links(shard: np.ndarray, fp: np.ndarray, asks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that join what lies within the radius in each shard: trees of eight children a node."""
    trees = BKTrees(fp, shard)
    searches = np.flatnonzero(asks)
    label = np.arange(len(fp))
    for ask, found in trees.near(fp[searches], trees.shard_of_root[searches], RADIUS):
        _merge(label, searches[ask], found)
    by = np.argsort(label, kind="stable")
    sets = label[by]
    first = np.flatnonzero(np.concatenate(([True], sets[1:] != sets[:-1])))
    start = np.repeat(first, np.diff(np.append(first, len(sets))))
    rank = np.arange(len(sets)) - start
    inner = rank > 0
    return fp[by[inner]], fp[by[start[inner] + (rank[inner] - 1) // 8]]


def _agreed_bits() -> list[list[int]]:
    """Masks of the bits on which a shard's members agree, by level; mask ``i`` is split into ``BLOCKS * i`` and the next."""
    levels, masks = [], [0]
    for _ in range(LEVELS):
        split = []
        for mask in masks:
            free = [b for b in range(64) if not mask >> b & 1]
            split += [mask | sum(1 << int(b) for b in block) for block in np.array_split(free, BLOCKS)]
        masks = split
        levels.append(masks)
    return levels


def _shards(prints: DataFrame) -> DataFrame:
    """``fp``, ``key`` (its shard) and ``asks`` (whether it is searched there): all that are near meet in a shard."""
    spark, rows, parts = prints.sparkSession, prints.select("fp", F.lit(0).alias("at")), []
    for level, masks in enumerate(_agreed_bits()):
        bits = F.array(*[F.lit(m - (1 << 64) if m >> 63 else m) for m in masks])
        at = F.explode(F.sequence(F.col("at") * BLOCKS, F.col("at") * BLOCKS + F.lit(BLOCKS - 1)))
        rows = rows.select("fp", at.alias("at"))
        rows = rows.withColumn("value", F.col("fp").bitwiseAND(F.element_at(bits, F.col("at") + 1)))
        large = rows.groupBy(F.col("at").alias("__at"), F.col("value").alias("__value")).count().where(F.col("count") > SHARD_SEARCHES)
        large = stored(spark, large, "large-shards")
        key = F.xxhash64(F.lit(level), "at", "value")
        if large.isEmpty():
            return _union([*parts, rows.select("fp", key.alias("key"), F.lit(True).alias("asks"))])
        found = rows.join(large, (rows["at"] == large["__at"]) & (rows["value"] == large["__value"]), "left")
        parts.append(found.where("count IS NULL").select("fp", key.alias("key"), F.lit(True).alias("asks")))
        rows = stored(spark, found.where("count IS NOT NULL").select("fp", "at", "value", "count"), "split-shards")
    deal = F.ceil(F.col("count") / SHARD_SEARCHES).cast("int")
    dealt = rows.select("fp", "at", "value", deal.alias("n"), F.explode(F.sequence(F.lit(0), deal - 1)).alias("part"))
    asks = F.pmod(F.xxhash64("fp"), F.col("n")) == F.col("part")
    return _union([*parts, dealt.select("fp", F.xxhash64(F.lit(LEVELS), "at", "value", "part").alias("key"), asks.alias("asks"))])


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def links(prints: DataFrame) -> DataFrame:
    """Links ``a``, ``b`` that connect all fingerprints ``fp`` (distinct) within the radius."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def search(rows: np.ndarray) -> pa.RecordBatch:
            # A shard of one has no links.
            edge = np.concatenate(([True], rows[0][1:] != rows[0][:-1], [True]))
            rows = rows[:, ~(edge[:-1] & edge[1:])]
            a, b = _shard_links(rows[0], rows[1].view(np.uint64), rows[2].astype(bool))
            return pa.RecordBatch.from_pydict({"a": pa.array(a.view(np.int64)), "b": pa.array(b.view(np.int64))})

        for batch in batches:
            held.append(np.stack([c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]))
            if sum(h.shape[1] for h in held) < TREE_ROWS:
                continue
            rows = np.concatenate(held, axis=1)
            last = int(np.searchsorted(rows[0], rows[0][-1]))  # the last shard may go on
            if last:
                yield search(rows[:, :last])
            held = [rows[:, last:]]
        if held:
            rows = np.concatenate(held, axis=1)
            if rows.shape[1]:
                yield search(rows)

    dealt = _shards(prints).select("key", "fp", "asks").repartition("key").sortWithinPartitions("key")
    return dealt.mapInArrow(run, "a bigint, b bigint").distinct()


def roots(prints: DataFrame) -> DataFrame:
    """``fp`` and ``root``, the same for all fingerprints of a component, for all that have links."""
    found = stored(prints.sparkSession, links(prints), "simhash-links")
    return connected(found).select(F.col("node").alias("__fp"), "root")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``fingerprint`` and ``component_id`` of each row of ``docs(doc_id, text)``.

    Texts without words (null and empty among them) have fingerprint zero and link like others.
    Equal fingerprints count once in the search, so groups of copies cost nothing there. A null
    doc_id never names a component unless its members have no other. Repeated rows give repeated
    results; an empty table gives an empty one; other columns are not used.
    """
    marked = stored(docs.sparkSession, fingerprints(docs.withColumn("doc_id", F.col("doc_id").cast("long")), "doc_id"), "fingerprints")
    prints = marked.groupBy("fp").agg(F.min("doc_id").alias("first"))
    ends = roots(prints)
    named = prints.join(ends, prints["fp"] == ends["__fp"], "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))
    named = stored(docs.sparkSession, named, "simhash-roots")
    smallest = named.groupBy("root").agg(F.min("first").alias("component_id")).withColumnRenamed("root", "__root")
    named = named.join(smallest, named["root"] == smallest["__root"]).select(F.col("fp").alias("__fp"), "component_id")
    return marked.join(named, marked["fp"] == named["__fp"]).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame) -> DataFrame:
    """Of each component of :func:`near_duplicates` the row with the smallest doc_id (nulls last), with all its columns.

    Null, empty and wordless texts share the fingerprint zero, so one of them stays. Rows are told
    apart by doc_id and a hash of the text; of equal rows one stays. An empty table gives an empty one.
    """
    spark = docs.sparkSession
    text_hash = F.xxhash64(F.coalesce(F.col("text").cast("string"), F.lit("")))
    slim = docs.select(F.col("doc_id").alias("__doc"), text_hash.alias("__hash"), "text")
    marked = stored(spark, fingerprints(slim, "__doc", "__hash"), "fingerprints")
    prints = marked.groupBy("fp").agg(F.min(F.struct(F.col("__doc").isNull(), "__doc", "__hash")).alias("best"))
    ends = roots(prints)
    named = prints.join(ends, prints["fp"] == ends["__fp"], "left").select("best", F.coalesce("root", "fp").alias("root"))
    winners = named.groupBy("root").agg(F.min("best").alias("best"))
    # One key for the join and for telling equal rows apart, so that whole rows are shuffled once.
    winners = winners.select(F.xxhash64("best.__doc", F.col("best.__doc").isNull()).alias("__k"), F.col("best.__hash").alias("__h"))
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")
    whole = docs.select(row, F.xxhash64("doc_id", F.col("doc_id").isNull()).alias("__id"), text_hash.alias("__th"))
    kept = whole.join(winners, (whole["__id"] == winners["__k"]) & (whole["__th"] == winners["__h"]), "left_semi")
    # Which of equal rows is the first does not matter.
    place = F.row_number().over(Window.partitionBy("__id", "__th").orderBy("__id"))
    return kept.withColumn("__place", place).where("__place = 1").select("__row.*")
