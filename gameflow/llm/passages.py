"""Passages of a number of words that stand in the corpus more than once.

Every window of ``words`` words holds an anchor: the shorter run of words in it with the smallest
hash. Equal windows have the same anchor, so only windows around anchors that occur at least twice
are hashed (128 bits) and counted. Words are compared as they stand; the space between is not.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gameflow.llm.store import stored, temporarily
from gameflow.llm.texts import BASE, Block, blocks, mix, powers, range_hashes, u64, word_hashes


def _prefix(words: np.ndarray, seed: int) -> np.ndarray:
    out = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(mix(words + u64(seed)) * powers(BASE, len(words)), out=out[1:])
    return out


def _anchors(block: Block, words: int) -> tuple[np.ndarray, ...]:
    """gram, text, first and last window start; starts count words from the text's first."""
    starts, ends, offsets = block.words()
    gram_words = max(1, words * 2 // 5)
    places = words - gram_words + 1  # of an anchor in a window
    if len(starts) < words:
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    prefix = _prefix(word_hashes(block, starts, ends, lower=False), 0)
    at = np.arange(len(starts) - gram_words + 1)
    gram = mix(range_hashes(prefix, at, at + gram_words))
    # The place in the low half makes the minimum of a window its leftmost smallest run.
    least, size = (gram & u64(0xFFFFFFFF00000000)) | at.astype(np.uint64), 1
    while size * 2 <= places:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    rest = places - size
    least = np.minimum(least[:len(least) - rest], least[rest:])
    text_end = np.repeat(offsets[1:], np.diff(offsets))[:len(least)]
    start = np.flatnonzero(np.arange(len(least)) + words <= text_end)
    if not len(start):
        return (np.zeros(0, np.uint64),) + (np.zeros(0, np.int64),) * 3
    anchor = (least[start] & u64(0xFFFFFFFF)).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1])))
    first, last = start[new], start[np.append(new[1:], len(start)) - 1]
    text = np.searchsorted(offsets, first, side="right") - 1
    return gram[anchor[new]], text + block.first, first - offsets[text], last - offsets[text]


def _windows(block: Block, ranges: list[list[dict]], words: int) -> tuple[np.ndarray, ...]:
    """Two hashes, text, first and last byte of the windows that start in the ranges of each text."""
    starts, ends, offsets = block.words()
    hashes = word_hashes(block, starts, ends, lower=False)
    at = [np.unique(np.concatenate([np.arange(r["first"], r["last"] + 1) for r in some])) + o
          for some, o in zip(ranges, offsets[:-1].tolist(), strict=True)]
    text = np.repeat(np.arange(len(block)), [len(a) for a in at])
    at = np.concatenate(at).astype(np.int64)
    pair = [range_hashes(_prefix(hashes, seed), at, at + words) for seed in (0, 1)]
    base = block.offsets[text]
    return *pair, text + block.first, starts[at] - base, ends[at + words - 1] - base


def repeated_passages(docs: DataFrame, words: int) -> DataFrame:
    """``doc_id``, ``th`` and ``spans``, the byte ranges (they overlap) of all runs of ``words`` words
    that stand elsewhere too, in any row of ``docs(doc_id, th, text)``; ``th`` is a hash of the text."""
    spark = docs.sparkSession
    kind = dict(docs.dtypes)["doc_id"]

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2), 1 << 19):
                gram, text, first, last = _anchors(block, words)
                row = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(gram.view(np.int64)), batch.column(0).take(row), batch.column(1).take(row),
                     pa.array(first.astype(np.int32)), pa.array(last.astype(np.int32))],
                    names=["gram", "doc_id", "th", "first", "last"],
                )

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2), 1 << 19):
                ranges = batch.column(3).slice(block.first, len(block)).to_pylist()
                h1, h2, text, begin, end = _windows(block, ranges, words)
                row = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h1.view(np.int64)), pa.array(h2.view(np.int64)), batch.column(0).take(row), batch.column(1).take(row),
                     pa.array(begin.astype(np.int32)), pa.array(end.astype(np.int32))],
                    names=["h1", "h2", "doc_id", "th", "start", "end"],
                )

    slim = docs.select("doc_id", "th", "text")
    schema = f"gram bigint, doc_id {kind}, th bigint, first int, last int"
    with temporarily(spark, slim.mapInArrow(find, schema), "passage-anchors") as found:
        often = found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select(F.col("gram").alias("__gram"))
        with temporarily(spark, often, "passage-often") as often:
            again = found.join(often, found["gram"] == often["__gram"], "left_semi")
            places = again.groupBy(F.col("doc_id").alias("__doc"), F.col("th").alias("__th")).agg(
                F.collect_set(F.struct("first", "last")).alias("ranges")
            )
            places = stored(spark, places, "passage-places")
    near = slim.join(places, slim["doc_id"].eqNullSafe(places["__doc"]) & (slim["th"] == places["__th"]))
    schema = f"h1 bigint, h2 bigint, doc_id {kind}, th bigint, start int, end int"
    # The windows are by far the largest table here, so they go as soon as their runs are known.
    with temporarily(spark, near.select("doc_id", "th", "text", "ranges").mapInArrow(hashed, schema), "passage-windows") as windows:
        twice = windows.groupBy("h1", "h2").agg(F.count("*").alias("n")).where("n > 1")
        with temporarily(spark, twice.select(F.col("h1").alias("__h1"), F.col("h2").alias("__h2")), "passage-twice") as twice:
            hit = windows.join(twice, (windows["h1"] == twice["__h1"]) & (windows["h2"] == twice["__h2"]), "left_semi")
            spans = hit.groupBy("doc_id", "th").agg(F.collect_set(F.struct("start", "end")).alias("spans"))
            return stored(spark, spans, "passage-spans")
