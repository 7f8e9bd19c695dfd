"""Removal of byte strings that repeat anywhere in the corpus, by hash-compared suffix sorting.

Every window of ``LENGTH`` bytes holds an anchor: the ``GRAM``-byte string in it with the
smallest hash. Equal windows have the same anchor at the same place, so windows are compared
only around anchors whose strings occur at least twice. Around such an anchor, occurrences with
equal surroundings are folded into one by digest and count as repeats of each other; what is
left differs somewhere and is sorted:

* Suffixes that start at the anchors are put in order by mergesort. Two of them are compared by
  prefix hashes: a binary search finds their common extension, the byte after it decides.
  Neighbours in the final order are compared byte by byte; if a hash misled the sort, the order
  is made anew from the bytes.
* The same is done to the left, with the bytes reversed.
* The window that starts ``d`` bytes before the anchor repeats if another occurrence shares
  ``d`` bytes to the left and ``LENGTH - d`` to the right. Cutting either order where the common
  extension is shorter gives two class numbers, and equal pairs of them are repeats.

Anchors with very many different surroundings are split by the longer string that the windows
of a narrower range of ``d`` have in common, and then treated in the same way, so no task gets
more than ``MAX_GROUP`` occurrences of one string.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator
from contextlib import ExitStack

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gameflow.llm.passages import repeated_passages
from gameflow.llm.store import stored, temporarily
from gameflow.llm.texts import Block, as_bytes, blocks, chain, mix, prefix_hashes, range_hashes

LENGTH = 400
GRAM = 100
STARTS = LENGTH - GRAM + 1  # places of an anchor in a window
MAX_GROUP = 256
#: Widths of the ranges of ``d`` into which anchors with larger groups are split, one after the
#: other. In the last all windows of a range are one, so that folding settles every case.
SPLITS = (16, 1)
SORT_ROWS = 3000  # occurrences sorted at once
KEY = ["gram", "c1", "c2"]
KEY_SCHEMA = "gram bigint, c1 bigint, c2 bigint"


def _u(x: np.ndarray) -> np.ndarray:
    return x.astype(np.uint64)


# Anchors


def _anchors(block: Block) -> tuple[np.ndarray, ...]:
    """gram, c1, c2, text, anchor, first and last window start; places count from the text's start."""
    data, n = block.data, len(block.data)
    if n < LENGTH:
        return (np.zeros(0, np.uint64),) * 3 + (np.zeros(0, np.int64),) * 4
    prefix = prefix_hashes(data)
    at = np.arange(n - GRAM + 1)
    gram = mix(range_hashes(prefix, at, at + GRAM))
    # The place in the low half makes the minimum of a window its leftmost smallest string.
    least, size = (gram & np.uint64(0xFFFFFFFF00000000)) | _u(at), 1
    while size * 2 <= STARTS:
        least, size = np.minimum(least[:-size], least[size:]), size * 2
    rest = STARTS - size
    least = np.minimum(least[:len(least) - rest], least[rest:])
    ends = np.repeat(block.offsets[1:], np.diff(block.offsets))[:len(least)]
    start = np.flatnonzero(np.arange(len(least)) + LENGTH <= ends)
    anchor = (least[start] & np.uint64(0xFFFFFFFF)).astype(np.int64)
    new = np.concatenate(([True], anchor[1:] != anchor[:-1])) if len(start) else np.zeros(0, bool)
    first = start[new]
    last = start[np.append(np.flatnonzero(new)[1:], len(start)) - 1] if len(start) else start
    anchor = anchor[new]
    shape = chain(_u(anchor - first), _u(last - first))
    c1 = chain(range_hashes(prefix, first, last + LENGTH), shape)
    c2 = chain(range_hashes(prefix_hashes(data, seed=1), first, last + LENGTH), shape)
    text = np.searchsorted(block.offsets, first, side="right") - 1
    base = block.offsets[text]
    return gram[anchor], c1, c2, text + block.first, anchor - base, first - base, last - base


def anchors(docs: DataFrame) -> DataFrame:
    """One row per anchor of ``docs(doc_id, th, text)``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block in blocks(batch.column(2), 1 << 19):
                gram, c1, c2, text, anchor, first, last = _anchors(block)
                row = pa.array(text)
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x.view(np.int64)) for x in (gram, c1, c2)), batch.column(0).take(row), batch.column(1).take(row),
                     *(pa.array(x.astype(np.int32)) for x in (anchor, first, last))],
                    names=[*KEY, "doc_id", "th", "anchor", "first", "last"],
                )

    kind = dict(docs.dtypes)["doc_id"]
    schema = f"{KEY_SCHEMA}, doc_id {kind}, th bigint, anchor int, first int, last int"
    return docs.select("doc_id", "th", "text").mapInArrow(run, schema)


# Suffix sorting


class Suffixes:
    """Byte strings ``data[start : start + length]``, ordered within runs of equal ``group``."""

    def __init__(self, data: np.ndarray, start: np.ndarray, length: np.ndarray, group: np.ndarray):
        self.data, self.start, self.length, self.group = data, start, length, group
        self.prefix = prefix_hashes(data)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Length of the common extension of strings i and j by hash, in logarithmic steps."""
        low, high = np.zeros(len(i), np.int64), np.minimum(self.length[i], self.length[j])
        a, b = self.start[i], self.start[j]
        while (low < high).any():
            middle = (low + high + 1) // 2
            equal = range_hashes(self.prefix, a, a + middle) == range_hashes(self.prefix, b, b + middle)
            low, high = np.where(equal, middle, low), np.where(equal, high, middle - 1)
        return low

    def _byte(self, i: np.ndarray, at: np.ndarray) -> np.ndarray:
        """The byte after ``at`` bytes of string i, -1 at its end."""
        inside = at < self.length[i]
        return np.where(inside, self.data[np.where(inside, self.start[i] + at, 0)].astype(np.int64), -1)

    def less(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """Whether string i comes before string j; equal strings by number."""
        at = self.common(i, j)
        x, y = self._byte(i, at), self._byte(j, at)
        return np.where(x == y, i < j, x < y)

    def order(self) -> np.ndarray:
        """Mergesort of all groups at once, from runs of one string up."""
        n = len(self.start)
        order = np.arange(n)
        if not n:
            return order
        begin = np.flatnonzero(np.concatenate(([True], self.group[1:] != self.group[:-1])))
        size = np.diff(np.append(begin, n))
        base, total = np.repeat(begin, size), np.repeat(size, size)
        place, run = np.arange(n) - base, 1
        while run < size.max():
            mine = place // run
            other = np.minimum((mine ^ 1) * run, total)
            low, high = other.copy(), np.minimum(other + run, total)
            first_of_other = low.copy()
            while True:  # how many of the neighbouring run come before
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                middle = (low[open_] + high[open_]) // 2
                before = self.less(order[base[open_] + middle], order[open_])
                low[open_] = np.where(before, middle + 1, low[open_])
                high[open_] = np.where(before, high[open_], middle)
            pair = (mine // 2) * 2 * run
            target = base + pair + (place - mine * run) + (low - first_of_other)
            merged = np.empty_like(order)
            merged[target] = order
            order, run = merged, run * 2
        return order

    def sorted(self) -> tuple[np.ndarray, np.ndarray]:
        """The order, and the common extension of each string with the one before it (0 at a
        group's first), both confirmed by the bytes."""
        order = self.order()
        common = self._confirmed(order)
        if common is None:
            raw = self.data.tobytes()
            text = [raw[s:s + k] for s, k in zip(self.start.tolist(), self.length.tolist(), strict=True)]
            group = self.group.tolist()
            order = np.array(sorted(range(len(text)), key=lambda i: (group[i], text[i], i)), dtype=np.int64)
            common = np.zeros(len(order), np.int64)
            for k in range(1, len(order)):
                a, b = text[order[k - 1]], text[order[k]]
                if group[order[k - 1]] == group[order[k]]:
                    common[k] = next((m for m in range(min(len(a), len(b))) if a[m] != b[m]), min(len(a), len(b)))
        return order, common

    def _confirmed(self, order: np.ndarray) -> np.ndarray | None:
        common = np.zeros(len(order), np.int64)
        i, j = order[:-1], order[1:]
        same = np.flatnonzero(self.group[i] == self.group[j])
        i, j = i[same], j[same]
        length = self.common(i, j)
        offset = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        equal = self.data[np.repeat(self.start[i], length) + offset] == self.data[np.repeat(self.start[j], length) + offset]
        x, y = self._byte(i, length), self._byte(j, length)
        if not equal.all() or ((x > y) | ((x == y) & (x >= 0))).any():
            return None
        common[same + 1] = length
        return common


def _repeats(gram: np.ndarray, data: np.ndarray, offsets: np.ndarray, nearest: np.ndarray, farthest: np.ndarray) -> np.ndarray:
    """Which windows repeat: a row per occurrence, a column per ``d``.

    An occurrence's text begins ``farthest`` bytes before the anchor and holds its windows for
    ``d`` from ``nearest`` to ``farthest``. Rows are grouped by ``gram``.
    """
    n, size = len(gram), offsets[-1]
    group = np.cumsum(np.concatenate(([0], gram[1:] != gram[:-1])))
    anchor = offsets[:-1] + farthest
    right = Suffixes(data, anchor, offsets[1:] - anchor, group)
    left = Suffixes(data[::-1].copy(), size - anchor, farthest, group)
    sides = []
    for side in (right, left):
        order, common = side.sorted()
        edge = np.concatenate(([True], group[order][1:] != group[order][:-1]))
        sides.append((order, common, edge))
    found = np.zeros((n, STARTS), bool)
    for d in range(int(nearest.min()), int(farthest.max()) + 1):
        keys = []
        for (order, common, edge), least in zip(sides, (LENGTH - d, d), strict=True):
            number = np.empty(n, np.int64)
            number[order] = np.cumsum(edge | (common < least))
            keys.append(number)
        active = np.flatnonzero((nearest <= d) & (d <= farthest))
        key = keys[0][active] * (n + 1) + keys[1][active]
        by = np.argsort(key, kind="stable")
        again = np.flatnonzero(key[by][1:] == key[by][:-1])
        found[active[by[again]], d] = found[active[by[again + 1]], d] = True
    return found


def _by_sorting(groups: DataFrame) -> DataFrame:
    """Repeating windows of occurrences with ``gram``, class, range of ``d`` and ``text``."""

    def results(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(rows)
        gram, c1, c2, nearest, farthest = (table.column(k).to_numpy().astype(np.int64) for k in range(5))
        data, offsets = as_bytes(table.column(5))
        found = _repeats(gram, data, offsets, nearest, farthest)
        edge = np.diff(np.pad(found.astype(np.int8), ((0, 0), (1, 1))), axis=1)
        row, start = np.nonzero(edge == 1)
        end = np.nonzero(edge == -1)[1] - 1
        return pa.RecordBatch.from_arrays(
            [*(pa.array(x[row]) for x in (gram, c1, c2)), pa.array(start.astype(np.int32)), pa.array(end.astype(np.int32))],
            names=[*KEY, "near", "far"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for first in range(0, batch.num_rows, SORT_ROWS):
                held.append(batch.slice(first, SORT_ROWS))
                if sum(b.num_rows for b in held) < SORT_ROWS:
                    continue
                gram = np.concatenate([b.column(0).to_numpy() for b in held])
                whole = int(np.searchsorted(gram, gram[-1]))  # the last group may go on
                if whole:
                    table = pa.Table.from_batches(held)
                    yield results(table.slice(0, whole).to_batches())
                    held = table.slice(whole).to_batches()
        if sum(b.num_rows for b in held):
            yield results(held)

    return (
        groups.select(*KEY, "nearest", "farthest", "text").repartition("gram").sortWithinPartitions("gram")
        .mapInArrow(run, f"{KEY_SCHEMA}, near int, far int")
    )


# Folding and splitting


def _grams_between(classes: DataFrame, least: int, most: int | None) -> DataFrame:
    """Strings with so many different surroundings, as ``__gram``."""
    n = classes.groupBy("gram").agg(F.count("*").alias("n")).where(F.col("n") >= least)
    return (n if most is None else n.where(F.col("n") <= most)).select(F.col("gram").alias("__gram"))


def _split(occurrences: DataFrame, width: int) -> DataFrame:
    """Occurrences once for each range of ``width`` values of ``d`` that they have windows in.

    The new ``gram`` stands for the string that all windows of the range have in common, the new
    class for all bytes of those windows. ``origin`` is the class before.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, SORT_ROWS):
                batch = whole.slice(at, SORT_ROWS)
                gram, c1, c2, nearest, farthest = (batch.column(k).to_numpy().astype(np.int64) for k in range(5))
                data, offsets = as_bytes(batch.column(5))
                first_range, last_range = nearest // width, farthest // width
                row = np.repeat(np.arange(len(gram)), last_range - first_range + 1)
                part = np.arange(len(row)) - np.searchsorted(row, row) + first_range[row]
                near = np.maximum(nearest[row], part * width)
                far = np.minimum(farthest[row], part * width + width - 1)
                anchor = offsets[:-1][row] + farthest[row]
                begin, end = anchor - far, anchor - near + LENGTH
                # What every window of the whole range covers, so that ends cut short still meet.
                shared_begin, shared_end = anchor - part * width, anchor - (part * width + width - 1) + LENGTH
                shared_begin, shared_end = np.maximum(shared_begin, begin), np.minimum(shared_end, end)
                prefix, second = prefix_hashes(data), prefix_hashes(data, seed=1)
                shape = chain(_u(near), _u(far))
                shared = chain(range_hashes(prefix, shared_begin, shared_end), _u(part))
                raw = data.tobytes()
                texts = [raw[b:e] for b, e in zip(begin.tolist(), end.tolist(), strict=True)]
                columns = [
                    chain(gram.view(np.uint64)[row], shared), chain(range_hashes(prefix, begin, end), shape),
                    chain(range_hashes(second, begin, end), shape),
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(x.view(np.int64)) for x in columns), pa.array(near.astype(np.int32)),
                     pa.array(far.astype(np.int32)), pa.array(texts, pa.binary()), *(pa.array(x[row]) for x in (gram, c1, c2))],
                    names=[*KEY, "nearest", "farthest", "text", "o_gram", "o_c1", "o_c2"],
                )

    schema = f"{KEY_SCHEMA}, nearest int, farthest int, text binary, o_gram bigint, o_c1 bigint, o_c2 bigint"
    return occurrences.select(*KEY, "nearest", "farthest", "text").mapInArrow(run, schema)


def _on_key(left: DataFrame, right: DataFrame, how: str = "inner") -> DataFrame:
    right = right.withColumnsRenamed({k: f"__{k}" for k in KEY})
    match = [left[k] == right[f"__{k}"] for k in KEY]
    joined = left.join(right, match[0] & match[1] & match[2], how)
    return joined.drop(*[f"__{k}" for k in KEY])


def _solve(keep: Callable[[DataFrame, str], DataFrame], classes: DataFrame, splits: tuple[int, ...]) -> DataFrame:
    """Ranges ``near``..``far`` of repeating windows of classes that share a gram with others."""
    # Written before they are joined, so that Spark can split a string that stands in most classes.
    few = keep(_grams_between(classes, 2, MAX_GROUP), "suffix-few")
    many = keep(_grams_between(classes, MAX_GROUP + 1, None), "suffix-many")
    result = _by_sorting(classes.join(few, classes["gram"] == few["__gram"], "left_semi"))
    if not splits:
        return result
    hot = classes.join(many, classes["gram"] == many["__gram"], "left_semi")
    parts = keep(_split(hot, splits[0]), "suffix-parts")
    folded = parts.groupBy(*KEY, "nearest", "farthest").agg(F.count("*").alias("n"), F.any_value("text").alias("text"))
    folded = keep(folded, "suffix-folded")
    if folded.isEmpty():
        return result
    settled = folded.where("n > 1").select(*KEY, F.col("nearest").alias("near"), F.col("farthest").alias("far"))
    inner = settled.union(_solve(keep, folded, splits[1:]))
    back = _on_key(parts.select(*KEY, "o_gram", "o_c1", "o_c2"), inner)
    return result.union(back.select(*[F.col(f"o_{k}").alias(k) for k in KEY], "near", "far"))


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """Classes with the bytes around the anchor of one occurrence each."""
    per_doc = wanted.groupBy("doc_id", "th").agg(
        F.collect_list(F.struct(*KEY, "anchor", "first", "last")).alias("places")
    ).withColumnsRenamed({"doc_id": "__doc", "th": "__th"})
    joined = docs.join(per_doc, docs["doc_id"].eqNullSafe(per_doc["__doc"]) & (docs["th"] == per_doc["__th"]))
    part = F.col("place")
    begin, size = part["first"], part["last"] - part["first"] + LENGTH
    return joined.select(F.col("text").cast("binary").alias("bytes"), F.explode("places").alias("place")).select(
        *[part[k].alias(k) for k in KEY], (part["anchor"] - part["last"]).alias("nearest"),
        (part["anchor"] - part["first"]).alias("farthest"), F.substring("bytes", begin + 1, size).alias("text"),
    )


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``th`` and ``spans``, the byte ranges to remove (they may overlap), of the rows
    of ``docs(doc_id, th, text)`` that have any; ``th`` is a hash of the text."""
    with ExitStack() as scratch:  # tables that go once the spans are written
        spans = _spans(docs, lambda frame, name: scratch.enter_context(temporarily(docs.sparkSession, frame, name)))
        return stored(docs.sparkSession, spans, "suffix-spans")


def _spans(docs: DataFrame, keep: Callable[[DataFrame, str], DataFrame]) -> DataFrame:
    # Most anchors occur once and go here; the texts around the others are read again.
    with temporarily(docs.sparkSession, anchors(docs), "suffix-anchors") as found:
        # Written first, so that the join deals out both sides anew and Spark can split a string
        # that stands in most rows.
        often = found.groupBy("gram").agg(F.count("*").alias("n")).where("n > 1").select(F.col("gram").alias("__gram"))
        with temporarily(docs.sparkSession, often, "suffix-often") as often:
            again = keep(found.join(often, found["gram"] == often["__gram"], "left_semi"), "suffix-repeated")
    place = F.struct("doc_id", "th", "anchor", "first", "last")
    folded = again.groupBy(*KEY).agg(F.count("*").alias("n"), F.min(place).alias("place")).select(*KEY, "n", "place.*")
    folded = keep(folded, "suffix-classes")
    several = keep(_grams_between(folded, 2, None), "suffix-several")
    classes = keep(_texts_of(docs, folded.join(several, folded["gram"] == several["__gram"], "left_semi")), "suffix-texts")
    settled = folded.where("n > 1").select(
        *KEY, (F.col("anchor") - F.col("last")).alias("near"), (F.col("anchor") - F.col("first")).alias("far")
    )
    ranges = settled.union(_solve(keep, classes, SPLITS))
    span = F.struct((F.col("anchor") - F.col("far")).alias("start"), (F.col("anchor") - F.col("near") + LENGTH).alias("end"))
    return _on_key(again, ranges).groupBy("doc_id", "th").agg(F.collect_set(span).alias("spans"))


def _merged(spans: list[dict] | None) -> list[list[int]]:
    runs: list[list[int]] = []
    for s in sorted(spans or [], key=lambda s: s["start"]):
        if runs and s["start"] <= runs[-1][1]:
            runs[-1][1] = max(runs[-1][1], s["end"])
        else:
            runs.append([s["start"], s["end"]])
    return runs


def _kept(text: bytes, runs: list[list[int]]) -> bytes:
    at, parts = 0, []
    for start, end in runs:
        parts.append(text[at:start])
        at = end
    return b"".join([*parts, text[at:]])


def _whole_characters(text: bytes, runs: list[list[int]]) -> list[list[int]]:
    """Runs made smaller where they would cut a character of UTF-8 in two."""
    result = []
    for start, end in runs:
        while start < end and text[start] & 0xC0 == 0x80:
            start += 1
        while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
            end -= 1
        if start < end:
            result.append([start, end])
    return result


def _with_spans(docs: DataFrame, words: int | None = None) -> DataFrame:
    keyed = docs.withColumn("text", F.coalesce(F.col("text").cast("string"), F.lit(""))).withColumn("th", F.xxhash64("text"))
    slim = keyed.select("doc_id", "th", "text")
    spans = repeated_spans(slim)
    if words:
        both = spans.union(repeated_passages(slim, words))
        spans = both.groupBy("doc_id", "th").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    spans = spans.withColumnsRenamed({"doc_id": "__doc", "th": "__th"})
    return keyed.join(spans, keyed["doc_id"].eqNullSafe(spans["__doc"]) & (keyed["th"] == spans["__th"]), "left")


def suffix_dedup(docs: DataFrame, texts: bool = False) -> DataFrame:
    """Per row of ``docs(doc_id, text)``: ``n_bytes``, ``n_removed``, ``n_spans``, ``kept_sha256``,
    and with ``texts`` also ``text``, what is left of it.

    A byte goes if a string of ``LENGTH`` bytes over it also starts elsewhere, in any row, the
    same one included. Null counts as empty. Repeated rows repeat each other; rows that share
    both doc_id and text have equal results. Shorter texts are never touched. An empty table
    gives an empty result. Other columns are not used. ``n_bytes`` is the size before removal.
    Where a run cuts a character of UTF-8 in two, ``text`` keeps the whole character, while the
    counts and the digest go by bytes.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, left = [], []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                text, runs = text.as_buffer().to_pybytes(), _merged(spans.as_py())
                removed = sum(e - s for s, e in runs)
                rows.append((len(text), removed, len(runs), hashlib.sha256(_kept(text, runs) if runs else text).hexdigest()))
                if texts:
                    left.append(_kept(text, _whole_characters(text, runs)) if runs else text)
            columns = list(zip(*rows, strict=True)) or [()] * 4
            arrays = [batch.column(0), *(pa.array(c, pa.int64()) for c in columns[:3]), pa.array(columns[3], pa.string())]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if texts:
                arrays, names = [*arrays, pa.array(left, pa.binary()).view(pa.string())], [*names, "text"]
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    slim = docs.select("doc_id", "text")
    kind = dict(slim.dtypes)["doc_id"]
    return _with_spans(slim).select("doc_id", "text", "spans").mapInArrow(
        run, f"doc_id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string{', text string' * texts}"
    )


def remove_repeats(docs: DataFrame, length_column: str | None = None, words: int | None = None) -> DataFrame:
    """``docs`` with all columns, ``text`` without its repeats (whole characters only) and, if it
    is named, ``length_column`` as the number of characters left.

    With ``words``, runs of so many words that stand elsewhere too go as well, however short.
    """
    names = docs.columns
    types = dict(docs.dtypes)
    # The text goes through the joins once, beside the other columns.
    others = F.struct(*[F.col(f"`{c}`") for c in names if c != "text"]).alias("__row")
    whole = docs.select("doc_id", "text", F.col("text").isNull().alias("__null"), others)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for text, spans in zip(batch.column(1), batch.column(2), strict=True):
                text = text.as_buffer().to_pybytes()
                texts.append(_kept(text, _whole_characters(text, _merged(spans.as_py()))).decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.string())], names=["__row", "__text"])

    joined = _with_spans(whole, words)
    cleaned = joined.where("spans is not null").select("__row", "text", "spans").mapInArrow(
        run, f"__row {dict(whole.dtypes)['__row']}, __text string"
    )
    untouched = joined.where("spans is null").select("__row", F.when(~F.col("__null"), F.col("text")).alias("__text"))
    special = {"text": F.col("__text").cast(types["text"])}
    if length_column:
        special[length_column] = F.when(F.col("__text").isNotNull(), F.length("__text")).cast(types[length_column])
    return untouched.union(cleaned).select(*[special.get(c, F.col("__row")[c]).alias(c) for c in names])
