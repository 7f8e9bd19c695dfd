"""Katz backoff: a bigram model with Good-Turing discounts, learnt from and applied to a corpus.

Documents are cut into batches, each of which lists its distinct words and pairs once. The model
lives in tables that are partitioned by hash of word or pair: a partition adds up what all batches
counted and answers each batch in the order in which it asked. What travels are packed arrays,
one for each batch and partition, so a pair that stands in every document is one number per batch.

The probability of a token after a history is defined from the top down,

    p(w | h) = d(c(h, w)) * c(h, w) / c(h)    if the pair was seen,
               weight(h) * p(w)               otherwise (weight 1 for histories never seen),
    p(w)     = d(c(w)) * c(w) / N             if the word was seen, and what is left to all others,

and evaluated that way for each token. ``weight(h)`` is what the seen pairs leave over, divided
by what their words leave over of ``p``, so the probabilities after each history add up to one.
Every seen pair has one batch that owns it and adds it to the sums of its history.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from gameflow.llm.store import bucketed, stored, temporarily
from gameflow.llm.texts import blocks, chain, runs, word_hashes

BATCH_BYTES = 5 << 20
#: Bytes of text for each partition of the tables.
PARTITION_BYTES = 6 << 20
GT_COUNTS = 5
#: What counts above ``GT_COUNTS`` give up, so that every history keeps something for unseen pairs.
TOUCH = 0.01
#: Hashes of the end of a text as a token and of its beginning as a history.
END, BEGIN = np.uint64(0x656E64), np.uint64(0x626567696E)
WORDS, PAIRS, SUMS = 1, 2, 3


def _pack(values: np.ndarray) -> bytes:
    """Compressed bytes of an array, first bytes of all values first."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(len(values), values.dtype.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(planes.tobytes())


def _unpack(data: bytes, kind: type) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    size = np.dtype(kind).itemsize
    return np.ascontiguousarray(raw.reshape(size, -1).T).view(kind).ravel()


def _pack_sorted(values: np.ndarray) -> bytes:
    return _pack(np.diff(values, prepend=np.uint64(0)))


def _unpack_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(_unpack(data, np.uint64), dtype=np.uint64)


def _parts(hashes: np.ndarray, n: int) -> np.ndarray:
    """Bounds of the ``n`` partitions in ascending hashes."""
    partition = ((hashes >> np.uint64(32)) * np.uint64(n)) >> np.uint64(32)
    return np.searchsorted(partition, np.arange(n + 1))


@dataclass
class Discounts:
    """Discount of each count up to ``GT_COUNTS``, by Good-Turing where the counts of counts allow
    it, else half a count off every count."""

    by_count: list[float]
    turing: bool

    @classmethod
    def of(cls, n: list[int]) -> Discounts:
        """``n[r]`` entries occur r times, for r up to ``GT_COUNTS + 1``."""
        if all(n[1:]):
            cut = (GT_COUNTS + 1) * n[GT_COUNTS + 1] / n[1]
            d = [((r + 1) * n[r + 1] / (n[r] * r) - cut) / (1 - cut) if cut < 1 else 0.0 for r in range(1, GT_COUNTS + 1)]
            if all(0 < x < 1 for x in d):
                return cls([0.0, *d], True)
        return cls([0.0] + [(r - 0.5) / r for r in range(1, GT_COUNTS + 1)], False)

    def discounted(self, counts: np.ndarray) -> np.ndarray:
        """``d(c) * c``."""
        c = counts.astype(float)
        low = np.array(self.by_count)[np.minimum(counts, GT_COUNTS).astype(np.int64)]
        return np.where(counts > GT_COUNTS, c - (TOUCH if self.turing else 0.5), c * low)


@dataclass
class Totals:
    """Numbers of the training part: tokens, distinct words, what seen words leave over."""

    tokens: int
    words: int
    rest: float
    by_word: Discounts
    by_pair: Discounts


# Batches


@dataclass
class Batch:
    """Tokens of some texts, as places in the batch's words (ascending hashes)."""

    words: np.ndarray
    token: np.ndarray
    first: np.ndarray  # offsets of the texts
    trains: np.ndarray  # by text

    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct (history, word) as one number each, each token's pair, how many train tokens."""
        history = np.empty(len(self.token), np.int64)
        history[1:] = self.token[:-1]
        history[self.first[:-1]] = len(self.words)
        key = history * len(self.words) + self.token
        distinct, _ = runs(np.sort(key))
        place = np.searchsorted(distinct, key)
        return distinct, place, np.bincount(place[self.train_tokens()], minlength=len(distinct))

    def train_tokens(self) -> np.ndarray:
        return np.repeat(self.trains, np.diff(self.first))

    def pair_hashes(self, distinct: np.ndarray) -> np.ndarray:
        with_begin = np.append(self.words, BEGIN)
        return chain(with_begin[distinct // len(self.words)], self.words[distinct % len(self.words)])


def _batches(batch: pa.RecordBatch) -> Iterator[tuple[slice, Batch]]:
    """``batch`` has doc_id, held_out and text."""
    held_out = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
    hashes: list[np.ndarray] = []
    sizes: list[np.ndarray] = []
    start = size = row = 0

    def made() -> tuple[slice, Batch]:
        h, n = np.concatenate(hashes), np.concatenate(sizes)
        words, _ = runs(np.sort(h))
        return slice(start, row), Batch(words, np.searchsorted(words, h), np.concatenate(([0], np.cumsum(n))), ~held_out[start:row])

    for block in blocks(batch.column(2)):
        starts, ends, first = block.words()
        hashes.append(np.insert(word_hashes(block, starts, ends), first[1:], END))
        sizes.append(np.diff(first) + 1)
        size, row = size + len(block.data), row + len(block)
        if size >= BATCH_BYTES:
            yield made()
            hashes, sizes, start, size = [], [], row, 0
    if hashes:
        yield made()


STATE_NAMES = {"batch": pa.int64(), "words": pa.binary(), "ranks": pa.binary(), "tokens": pa.binary()}


def _learn(docs: DataFrame) -> DataFrame:
    """The batches: ``words``, ``ranks`` and ``tokens`` packed, and what is known of the texts."""
    kind = docs.schema["doc_id"].dataType
    names = STATE_NAMES | {
        "doc_id": pa.list_(to_arrow_type(kind)), "trains": pa.list_(pa.bool_()), "sizes": pa.list_(pa.int32()),
    }
    schema = ("batch bigint, words binary, ranks binary, tokens binary, "
              f"doc_id array<{kind.simpleString()}>, trains array<boolean>, sizes array<int>")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        number = TaskContext.get().partitionId() << 32
        for rows in batches:
            for where, b in _batches(rows):
                often = np.bincount(b.token, minlength=len(b.words))
                rank = np.argsort(-often, kind="stable")  # small numbers for frequent words pack well
                place = np.empty(len(rank), np.uint32)
                place[rank] = np.arange(len(rank), dtype=np.uint32)
                yield _row(names, batch=number, words=_pack_sorted(b.words), ranks=_pack(rank.astype(np.uint32)),
                           tokens=_pack(place[b.token]), doc_id=rows.column(0).slice(where.start, where.stop - where.start),
                           trains=b.trains, sizes=np.diff(b.first).astype(np.int32))
                number += 1

    return docs.select("doc_id", "held_out", "text").mapInArrow(run, schema)


def _batch_of(row: dict) -> Batch:
    first = np.concatenate(([0], np.cumsum(np.array(row["sizes"], np.int64))))
    rank = _unpack(row["ranks"], np.uint32)
    return Batch(_unpack_sorted(row["words"]), rank[_unpack(row["tokens"], np.uint32)].astype(np.int64), first,
                 np.array(row["trains"], bool))


ASK_NAMES = {"batch": pa.int64(), "kind": pa.int32(), "partition": pa.int32(), "keys": pa.binary(), "counts": pa.binary()}


def _asks(learnt: DataFrame, partitions: int) -> DataFrame:
    """What each batch asks of each partition: its words or pairs, and how often it trains them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for k in range(rows.num_rows):
                row = rows.slice(k, 1).to_pylist()[0]
                b = _batch_of(row)
                words = np.bincount(b.token[b.train_tokens()], minlength=len(b.words))
                distinct, _, pairs = b.pairs()
                hashes = b.pair_hashes(distinct)
                order = np.argsort(hashes, kind="stable")
                for kind, keys, counts in ((WORDS, b.words, words), (PAIRS, hashes[order], pairs[order])):
                    bound = _parts(keys, partitions)
                    for p in np.flatnonzero(np.diff(bound)).tolist():
                        own = slice(bound[p], bound[p + 1])
                        yield _row(ASK_NAMES, batch=row["batch"], kind=kind, partition=p, keys=_pack_sorted(keys[own]),
                                   counts=_pack(counts[own].astype(np.uint32)))

    return learnt.select("batch", "words", "ranks", "tokens", "trains", "sizes").mapInArrow(
        run, "batch bigint, kind int, partition int, keys binary, counts binary")


def _row(names: dict[str, pa.DataType], **values) -> pa.RecordBatch:
    columns = []
    for name, kind in names.items():
        value = values.get(name)
        if pa.types.is_list(kind) and value is not None:
            items = value if isinstance(value, pa.Array) else pa.array(value)
            columns.append(pa.ListArray.from_arrays(pa.array([0, len(items)], pa.int32()), items.cast(kind.value_type)))
        else:
            columns.append(pa.array([value], kind))
    return pa.RecordBatch.from_arrays(columns, names=list(names))


# Tables


def _by_partition(asked: DataFrame, partitions: int, merge, schema: str) -> DataFrame:
    """``merge`` of all rows of a partition and kind, in tasks of their own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []
        for batch in batches:
            for row in batch.to_pylist():
                if held and (row["partition"], row["kind"]) != (held[0]["partition"], held[0]["kind"]):
                    yield from merge(held)
                    held = []
                held.append(row)
        if held:
            yield from merge(held)

    dealt = asked.repartition(partitions, "partition").sortWithinPartitions("partition", "kind", "batch")
    return dealt.mapInArrow(run, schema)


COUNT_NAMES = {
    "batch": pa.int64(), "kind": pa.int32(), "partition": pa.int32(), "counts": pa.binary(), "owned": pa.binary(),
    "tokens": pa.int64(), "seen": pa.int64(), "n": pa.list_(pa.int64()),
}
COUNT_SCHEMA = "batch bigint, kind int, partition int, counts binary, owned binary, tokens bigint, seen bigint, n array<bigint>"


def _count(rows: list[dict]) -> Iterator[pa.RecordBatch]:
    """A partition's table, as the counts of what each batch asked and which of that it owns, and
    one row (``batch`` -1) of its totals and counts of counts."""
    keys = [_unpack_sorted(r["keys"]) for r in rows]
    counts = np.concatenate([_unpack(r["counts"], np.uint32) for r in rows])
    sizes = np.array([len(k) for k in keys])
    every = np.concatenate(keys)
    order = np.argsort(every, kind="stable")
    new = np.concatenate(([True], every[order][1:] != every[order][:-1]))
    first = np.flatnonzero(new)
    total = np.add.reduceat(counts[order].astype(np.int64), first)
    entry = np.empty(len(order), np.int64)
    entry[order] = np.cumsum(new) - 1
    trained = order[counts[order] > 0]
    owner = np.concatenate(([True], entry[trained][1:] != entry[trained][:-1])) if len(trained) else np.zeros(0, bool)
    owned = np.zeros(len(order), bool)
    owned[trained[owner]] = True
    seen = total > 0
    common = {"kind": rows[0]["kind"], "partition": rows[0]["partition"]}
    few = np.bincount(np.minimum(total, GT_COUNTS + 2), minlength=GT_COUNTS + 3)[:GT_COUNTS + 2]
    yield _row(COUNT_NAMES, batch=-1, tokens=int(total.sum()), seen=int(seen.sum()), n=few.astype(np.int64), **common)
    upto = np.concatenate(([0], np.cumsum(sizes)))
    for row, a, b in zip(rows, upto[:-1], upto[1:], strict=True):
        yield _row(COUNT_NAMES, batch=row["batch"], counts=_pack(total[entry[a:b]].astype(np.uint32)),
                   owned=np.packbits(owned[a:b]).tobytes(), **common)


def _totals(tables: DataFrame) -> Totals:
    sums = tables.where("batch = -1").groupBy("kind").agg(
        F.sum("tokens").alias("tokens"), F.sum("seen").alias("seen"),
        F.array(*[F.sum(F.col("n")[r]) for r in range(GT_COUNTS + 2)]).alias("n"),
    ).collect()
    found = {r.kind: r for r in sums}
    none = [0] * (GT_COUNTS + 2)
    words, pairs = found.get(WORDS), found.get(PAIRS)
    by_word, by_pair = Discounts.of(words.n if words else none), Discounts.of(pairs.n if pairs else none)
    n, v = (words.tokens, words.seen) if words else (0, 0)
    if not n:
        return Totals(0, 0, 1.0, by_word, by_pair)
    low = sum(words.n[1:GT_COUNTS + 1])
    lost = sum(words.n[r] * r * (1 - by_word.by_count[r]) for r in range(1, GT_COUNTS + 1))
    lost += (v - low) * (TOUCH if by_word.turing else 0.5)
    return Totals(n, v, lost / n, by_word, by_pair)


# Scores

SCORE_NAMES = {
    "kind": pa.int32(), "batch": pa.int64(), "doc": pa.int32(), "held_out": pa.bool_(), "n_tokens": pa.int64(), "n_known": pa.int64(),
    "base_score": pa.float64(), "score": pa.float64(), "history": pa.int64(), "n": pa.int64(), "partition": pa.int32(),
    "keys": pa.binary(), "counts": pa.binary(), "left": pa.binary(), "lower": pa.binary(),
}


def _answers(rows: list[dict], kind: int) -> tuple[np.ndarray, np.ndarray]:
    own = sorted((r for r in rows if r["kind"] == kind), key=lambda r: r["partition"])
    counts = [_unpack(r["counts"], np.uint32).astype(np.int64) for r in own]
    owned = [np.unpackbits(np.frombuffer(r["owned"], np.uint8), count=len(c)).astype(bool) for r, c in zip(own, counts, strict=True)]
    return np.concatenate(counts), np.concatenate(owned)


def _score_batch(row: dict, answers: list[dict], totals: Totals, partitions: int) -> Iterator[dict]:
    """Scores of a batch's documents as far as pairs were seen, the histories after which they
    were not (``kind`` 1), and the batch's part of the sums of histories (``kind`` 2)."""
    b = _batch_of(row)
    words, first = b.words, b.first
    texts = len(first) - 1
    text = np.repeat(np.arange(texts), np.diff(first))

    counts, _ = _answers(answers, WORDS)
    n, v = totals.tokens, totals.words
    base = np.log10((counts + 0.1) / (n + 0.1 * (v + 1)))
    lower = np.where(counts > 0, totals.by_word.discounted(counts) / max(n, 1), totals.rest)
    # A word is followed by a token each time, and a text begins as often as it ends.
    end = np.searchsorted(words, END)
    as_history = np.append(counts, counts[end])

    distinct, place, _ = b.pairs()
    order = np.argsort(b.pair_hashes(distinct), kind="stable")
    pair_counts, owned = np.empty(len(distinct), np.int64), np.empty(len(distinct), bool)
    pair_counts[order], owned[order] = _answers(answers, PAIRS)
    history, word = distinct // len(words), distinct % len(words)
    seen = pair_counts > 0
    left = totals.by_pair.discounted(pair_counts)
    p = np.where(seen, left / np.maximum(as_history[history], 1), lower[word])
    log_p = np.log10(p)
    per_text = {
        "base_score": np.bincount(text, base[b.token], minlength=texts), "score": np.bincount(text, log_p[place], minlength=texts),
        "n_known": np.bincount(text, counts[b.token] > 0, minlength=texts).astype(np.int64),
    }
    yield {"kind": 0, "batch": row["batch"], "doc": np.arange(texts), "doc_id": row["doc_id"], "held_out": ~b.trains, "n_tokens": np.diff(first)} | per_text

    backed_off = ~seen & (as_history[history] > 0)
    at = np.flatnonzero(backed_off[place])
    keys, n_keys = runs(np.sort(text[at] * (len(words) + 1) + history[place[at]]))
    hashes = np.append(words, BEGIN)
    yield {"kind": 1, "batch": row["batch"], "doc": keys // (len(words) + 1), "n": n_keys,
           "history": hashes[keys % (len(words) + 1)].view(np.int64)}

    used, _ = runs(np.sort(history[owned]))
    place_of = np.searchsorted(used, history[owned])
    sums = [np.bincount(place_of, x[owned], minlength=len(used)) for x in (left, lower[word])]
    by_hash = np.argsort(hashes[used])
    used, sums = used[by_hash], [s[by_hash] for s in sums]
    bound = _parts(hashes[used], partitions)
    for k in np.flatnonzero(np.diff(bound)).tolist():
        own = slice(bound[k], bound[k + 1])
        yield {"kind": 2, "batch": row["batch"], "partition": k, "keys": _pack_sorted(hashes[used[own]]),
               "counts": _pack(as_history[used[own]]), "left": _pack(sums[0][own]), "lower": _pack(sums[1][own])}


def _scored(learnt: DataFrame, tables: DataFrame, totals: Totals, partitions: int) -> DataFrame:
    doc_type = learnt.schema["doc_id"].dataType.elementType
    names = SCORE_NAMES | {"doc_id": to_arrow_type(doc_type)}

    def column(value, kind: pa.DataType, size: int) -> pa.Array:
        if value is None:
            return pa.nulls(size, kind)
        return pa.array(value if isinstance(value, (np.ndarray, list)) else [value] * size, kind)

    def run(state: pa.Table, answers: pa.Table) -> pa.Table:
        made = []
        answered = answers.to_pylist()
        for row in state.to_pylist():
            for part in _score_batch(row, answered, totals, partitions):
                size = len(part["doc"]) if "doc" in part else 1
                made.append(pa.Table.from_arrays([column(part.get(n), kind, size) for n, kind in names.items()], names=list(names)))
        return pa.concat_tables(made) if made else pa.table({n: pa.array([], kind) for n, kind in names.items()})

    schema = ("kind int, batch bigint, doc int, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, "
              f"history bigint, n bigint, partition int, keys binary, counts binary, left binary, lower binary, doc_id {doc_type.simpleString()}")
    answers = tables.where("batch >= 0").select("batch", "kind", "partition", "counts", "owned")
    return learnt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(run, schema)


def _weights(scored: DataFrame, partitions: int) -> DataFrame:
    """``history`` and ``log_weight`` of every history that was seen."""

    def merge(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        keys = np.concatenate([_unpack_sorted(r["keys"]) for r in rows])
        counts, left, lower = (
            np.concatenate([_unpack(r[c], kind) for r in rows]) for c, kind in (("counts", np.int64), ("left", float), ("lower", float)))
        order = np.argsort(keys, kind="stable")
        histories, n = runs(keys[order])
        first = np.cumsum(n) - n
        rest = 1 - np.add.reduceat(left[order], first) / counts[order][first]
        weight = np.log10(rest / (1 - np.add.reduceat(lower[order], first)))
        yield pa.RecordBatch.from_pydict({"history": histories.view(np.int64), "log_weight": weight})

    sums = scored.where("kind = 2").select("batch", F.lit(SUMS).alias("kind"), "partition", "keys", "counts", "left", "lower")
    return _by_partition(sums, partitions, merge, "history bigint, log_weight double")


def score_texts(docs: DataFrame) -> DataFrame:
    """Scores of each row of ``docs(doc_id, text)``, learnt from the rows that are not held out.

    Held out are rows whose crc32 of the doc_id as text is divisible by ten; a null doc_id is not.
    Tokens are the lower-cased words and the end of each text, so null and empty texts have one
    token. ``base_score`` is the additive unigram score. Repeated rows are learnt and scored one by
    one. Without training rows everything has probability one. An empty table gives an empty
    result. Other columns are not used.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 10 == 0, F.lit(False))
    slim = docs.select("doc_id", held_out.alias("held_out"), text.alias("text"))
    size = slim.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    partitions = max(12, -(-size // PARTITION_BYTES))
    with bucketed(spark, _learn(slim), "batch", partitions, "katz-batches") as learnt:
        counted = _by_partition(_asks(learnt, partitions), partitions, _count, COUNT_SCHEMA)
        with temporarily(spark, counted, "katz-tables") as tables:
            totals = _totals(tables)
            scored = stored(spark, _scored(learnt, tables, totals, partitions), "katz-scores")
    weights = stored(spark, _weights(scored, partitions), "katz-weights").withColumnRenamed("history", "__history")
    unseen = scored.where("kind = 1").select("batch", "doc", "history", "n")
    backed = unseen.join(weights, unseen["history"] == weights["__history"]).groupBy("batch", "doc").agg(
        F.sum(F.col("n") * F.col("log_weight")).alias("backed")
    ).withColumnsRenamed({"batch": "__batch", "doc": "__doc"})
    rows = scored.where("kind = 0")
    rows = rows.join(backed, (rows["batch"] == backed["__batch"]) & (rows["doc"] == backed["__doc"]), "left")
    return rows.select(
        "doc_id", "held_out", "n_tokens", "n_known", F.lit(totals.tokens).cast("long").alias("train_tokens"), "base_score",
        (F.col("score") + F.coalesce("backed", F.lit(0.0))).alias("score"),
    )
