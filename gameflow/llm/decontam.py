"""Benchmark decontamination: BM25 retrieval of test items with block-max WAND bounds.

The index holds the test items; training passages are the queries. Items are cut into units of
at most ``UNIT_WORDS`` words and documents into passages of twice that, half overlapping, so a
unit that stands in a document lies whole in one of its passages. A unit's score for a passage is
the BM25 sum over the terms they share, as a part of the unit's score for its own text, and all
units at or above ``THRESHOLD`` are retrieved. Bounds decide what is scored at all:

1. The sum of the largest impacts of a passage's terms. Below the threshold nothing can match.
2. Of the others, terms in ascending order of largest impact that stay below the threshold in
   sum cannot bring a unit in alone; only blocks of units with one of the other terms are looked at.
3. The sum of the terms' largest impacts within a block. Only blocks that reach the threshold have
   their postings read and scored.

What is retrieved is verified in one of two ways. The document holds ``OVERLAP`` of the five-word
shingles of the item's question and of its answer, wherever they stand; or, from a place that both
share five words at, it runs along the item word by word and has ``OVERLAP`` of the words of each
part. There ``EDITS`` missing words of a part do not count, so an item with a word changed, added
or left out is found too, however short its answer.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gameflow.llm.store import stored
from gameflow.llm.texts import Block, blocks, chain, word_hashes

UNIT_WORDS = 64
PASSAGE_WORDS = 2 * UNIT_WORDS
#: Part of a unit's own BM25 score that a passage must reach.
THRESHOLD = 0.6
SHINGLE_WORDS = 5
OVERLAP = 0.8
#: Words of a part that may be missing where a document runs along an item of ten words or more.
EDITS = 1
#: By how many places a word may be off there.
SHIFT = 1
#: Part of an item's words, at its end, that stands for the answer.
ANSWER_PART = 0.25
K1, B = 1.2, 0.75
#: Units of an index that is sent to all tasks: 65,536 postings at most.
SHARD_UNITS = 1024
BLOCK_UNITS = 8
#: Terms are runs of ASCII letters and digits and of all characters beyond ASCII.
BETWEEN = np.ones(256, dtype=bool)
BETWEEN[128:] = False
for low, high in ((48, 58), (65, 91), (97, 123)):
    BETWEEN[low:high] = False


def _terms(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of a block's terms in order, and offsets by text."""
    starts, ends, first = block.words(BETWEEN)
    return word_hashes(block, starts, ends), first


def _shingles(terms: np.ndarray, k: int) -> np.ndarray:
    n = len(terms) - k + 1
    if n <= 0 or not k:
        return np.zeros(0, np.uint64)
    h = terms[:n].copy()
    for i in range(1, k):
        h = chain(h, terms[i:i + n])
    return h


# Index


def item_rows(items: DataFrame) -> DataFrame:
    """What the index needs of ``items(item_id, text)``, a row per posting or shingle.

    ``kind`` 0: ``value`` is a term of unit ``unit``, ``n`` its frequency there. ``kind`` 1 and 2:
    ``value`` is a shingle of ``n`` words of the question and of the answer. ``kind`` 3: ``value``
    is the word at place ``n``.
    """

    def rows_of(terms: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
        step = UNIT_WORDS // 2
        for unit in range(max(1, -(-(len(terms) - UNIT_WORDS) // step) + 1)):
            values, n = np.unique(terms[unit * step:unit * step + UNIT_WORDS], return_counts=True)
            yield 0, unit, values, n
        cut = len(terms) - int(np.ceil(len(terms) * ANSWER_PART))
        for kind, part in ((1, terms[:cut]), (2, terms[cut:])):
            k = min(SHINGLE_WORDS, len(part))
            values = np.unique(_shingles(part, k))
            yield kind, 0, values, np.full(len(values), k)
        yield 3, 0, terms, np.arange(len(terms))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            item = batch.column(0).to_numpy(zero_copy_only=False)
            for block in blocks(batch.column(1)):
                terms, first = _terms(block)
                for i in range(len(block)):
                    own = terms[first[i]:first[i + 1]]
                    for kind, unit, values, n in rows_of(own) if len(own) else ():
                        size = len(values)
                        yield pa.RecordBatch.from_pydict({
                            "item_id": np.full(size, item[block.first + i], np.int64), "kind": np.full(size, kind, np.int32),
                            "unit": np.full(size, unit, np.int32), "value": values.view(np.int64), "n": n.astype(np.int32),
                        })

    kept = items.where("item_id is not null").groupBy(F.col("item_id").cast("long")).agg(F.max(F.col("text").cast("string")).alias("text"))
    return kept.mapInArrow(run, "item_id bigint, kind int, unit int, value bigint, n int")


@dataclass
class Index:
    """An inverted index over units, its terms numbered by ascending largest impact.

    Postings stand in the order of term and unit; a run of one term in one block of units has an
    entry in ``block_key`` (``term * n_blocks + block``) with its first posting.
    """

    vocabulary: np.ndarray  # sorted term hashes
    number: np.ndarray  # of each of them
    largest: np.ndarray  # impact by term number
    n_blocks: int
    block_key: np.ndarray
    block_start: np.ndarray
    block_max: np.ndarray  # terms x blocks
    unit: np.ndarray
    impact: np.ndarray
    item_of_unit: np.ndarray
    shingles: dict[int, tuple[tuple[int, np.ndarray], tuple[int, np.ndarray]]]
    words: dict[int, np.ndarray]


def build_index(rows: list, n_units: int, mean_words: float) -> Index:
    """``rows``: (item_id, kind, unit, value, n, df) of one shard."""
    table = np.array([tuple(r) for r in rows], dtype=np.int64).reshape(-1, 6)
    postings = np.ascontiguousarray(table[table[:, 1] == 0])
    units, unit = np.unique(postings[:, [0, 2]], axis=0, return_inverse=True)
    unit = unit.ravel()
    tf, df = postings[:, 4].astype(float), postings[:, 5].astype(float)
    words = np.bincount(unit, tf, minlength=len(units))
    idf = np.log(1 + (n_units - df + 0.5) / (df + 0.5))
    impact = idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * words[unit] / mean_words))
    impact /= np.bincount(unit, impact, minlength=len(units))[unit]
    vocabulary, term = np.unique(postings[:, 3].view(np.uint64), return_inverse=True)
    largest = np.zeros(len(vocabulary))
    np.maximum.at(largest, term, impact)
    by_impact = np.argsort(largest, kind="stable")
    number = np.empty(len(vocabulary), np.int64)
    number[by_impact] = np.arange(len(vocabulary))
    order = np.lexsort((unit, number[term]))
    term, unit, impact = number[term][order], unit[order], impact[order]
    n_blocks = max(1, -(-len(units) // BLOCK_UNITS))
    key = term * n_blocks + unit // BLOCK_UNITS
    block_key, block_start = np.unique(key, return_index=True)
    block_max = np.zeros(len(vocabulary) * n_blocks, np.float32)
    if len(key):
        block_max[block_key] = np.maximum.reduceat(impact, block_start)
    shingles, words_of = {}, {}
    table = table[np.lexsort((table[:, 4], table[:, 1], table[:, 0]))]
    items, first = np.unique(table[:, 0], return_index=True)
    for item, rows_of in zip(items.tolist(), np.split(table, first[1:]), strict=True):
        parts = []
        for kind in (1, 2):
            own = rows_of[rows_of[:, 1] == kind]
            parts.append((int(own[0, 4]) if len(own) else 0, np.sort(np.ascontiguousarray(own[:, 3]).view(np.uint64))))
        shingles[item] = tuple(parts)
        words_of[item] = np.ascontiguousarray(rows_of[rows_of[:, 1] == 3, 3]).view(np.uint64)
    return Index(vocabulary, number, largest[by_impact], n_blocks, block_key, np.append(block_start, len(key)),
                 block_max.reshape(-1, n_blocks), unit, impact, units[:, 0], shingles, words_of)


def shards(items: DataFrame) -> Iterator[Index]:
    """Indexes over all items, one after the other; document frequencies are those of all units."""
    spark = items.sparkSession
    rows = stored(spark, item_rows(items), "decontam-items")
    postings = rows.where("kind = 0")
    units = postings.groupBy("item_id", "unit").agg(F.sum("n").alias("words"))
    n_units, words = units.agg(F.count("*"), F.sum("words")).first()
    if not n_units:
        return
    df = postings.groupBy("value").agg(F.count("*").alias("df")).withColumnRenamed("value", "__value")
    full = rows.join(df, (rows["value"] == df["__value"]) & (rows["kind"] == 0), "left").drop("__value")
    n_shards = -(-n_units // SHARD_UNITS)
    full = stored(spark, full.withColumn("shard", F.pmod(F.xxhash64("item_id"), F.lit(n_shards))), "decontam-index")
    for shard in range(n_shards):
        own = full.where(F.col("shard") == shard).select("item_id", "kind", "unit", "value", "n", F.coalesce("df", F.lit(0)))
        if found := own.collect():
            yield build_index(found, n_units, words / n_units)


# Retrieval


def _expanded(low: np.ndarray, n: np.ndarray) -> np.ndarray:
    """All places of the ranges that begin at ``low`` and hold ``n``."""
    return np.arange(n.sum()) + np.repeat(low - (np.cumsum(n) - n), n)


def retrieve(index: Index, terms: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passage, unit and score of all pairs at or above the threshold.

    ``terms`` and ``passage`` are the term hashes of all passages and the passages they stand in.
    """
    place = np.minimum(np.searchsorted(index.vocabulary, terms), len(index.vocabulary) - 1)
    known = index.vocabulary[place] == terms
    size = len(index.vocabulary)
    key = np.sort(passage[known] * size + index.number[place[known]])
    key = key[np.concatenate(([True], key[1:] != key[:-1]))] if len(key) else key
    passage, term = key // size, key % size
    least = THRESHOLD * (1 - 1e-6)
    none = (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))

    # 1. Passages whose terms cannot reach the threshold.
    numbers, first = np.unique(passage, return_index=True)
    if not len(numbers):
        return none
    count = np.diff(np.append(first, len(passage)))
    impact = index.largest[term]
    keep = np.add.reduceat(impact, first) >= least
    kept_rows = np.repeat(keep, count)
    passage, term, impact = passage[kept_rows], term[kept_rows], impact[kept_rows]
    numbers, count = numbers[keep], count[keep]
    if not len(numbers):
        return none
    first = np.cumsum(count) - count

    # 2. Blocks with a term that is needed to reach it (terms ascend by impact in each passage).
    upto = np.cumsum(impact)
    upto -= np.repeat(upto[first] - impact[first], count)
    local = np.repeat(np.arange(len(numbers)), count)
    needed = upto >= least
    from_key = np.searchsorted(index.block_key, term[needed] * index.n_blocks)
    n = np.searchsorted(index.block_key, (term[needed] + 1) * index.n_blocks) - from_key
    open_ = np.zeros((len(numbers), index.n_blocks), bool)
    open_[np.repeat(local[needed], n), index.block_key[_expanded(from_key, n)] % index.n_blocks] = True

    # 3. Block maxima over all terms of the passage.
    bound = np.add.reduceat(index.block_max[term], first, axis=0)
    row, block = np.nonzero(open_ & (bound >= least))
    if not len(row):
        return none
    pair = np.repeat(np.arange(len(row)), count[row])
    wanted = term[_expanded(first[row], count[row])] * index.n_blocks + block[pair]
    at = np.minimum(np.searchsorted(index.block_key, wanted), len(index.block_key) - 1)
    hit = index.block_key[at] == wanted
    pair, at = pair[hit], at[hit]
    n = index.block_start[at + 1] - index.block_start[at]
    posting = _expanded(index.block_start[at], n)
    score = np.bincount(np.repeat(pair, n) * BLOCK_UNITS + index.unit[posting] % BLOCK_UNITS, index.impact[posting],
                        minlength=len(row) * BLOCK_UNITS)
    found = np.flatnonzero(score >= least)
    pair = found // BLOCK_UNITS
    return numbers[row[pair]], block[pair] * BLOCK_UNITS + found % BLOCK_UNITS, score[found]


def _share(terms: np.ndarray, part: tuple[int, np.ndarray]) -> float:
    k, wanted = part
    return float(np.isin(wanted, _shingles(terms, k)).mean()) if len(wanted) else 1.0


def _along(terms: np.ndarray, words: np.ndarray) -> tuple[float, float, bool]:
    """Shares of the item's question and answer words that a text has where it runs along the item,
    at the best of all places that share a shingle with it, and whether they suffice."""
    n, k = len(words), min(SHINGLE_WORDS, len(words))
    own, wanted = _shingles(terms, k), _shingles(words, k)
    if not len(own) or not len(wanted):
        return 0.0, 0.0, False
    known, at = np.unique(wanted, return_index=True)
    place = np.minimum(np.searchsorted(known, own), len(known) - 1)
    hit = np.flatnonzero(known[place] == own)
    shifts = np.unique(hit - at[place[hit]])
    cut = n - int(np.ceil(n * ANSWER_PART))
    edits = EDITS if n >= 2 * SHINGLE_WORDS else 0
    best, result = (False, -1), (0.0, 0.0, False)
    size = max(1, (1 << 20) // n)
    for begin in range(0, len(shifts), size):
        first = shifts[begin:begin + size, None] + np.arange(n)
        has = np.zeros(first.shape, bool)
        for off in range(-SHIFT, SHIFT + 1):
            inside = (first + off >= 0) & (first + off < len(terms))
            has |= inside & (terms[np.clip(first + off, 0, len(terms) - 1)] == words)
        parts = [(part.sum(axis=1), part.shape[1]) for part in (has[:, :cut], has[:, cut:])]
        enough = np.ones(len(has), bool)
        for found, of in parts:
            enough &= (found >= OVERLAP * of) | (found >= of - edits)
        total = parts[0][0] + parts[1][0]
        top = int(np.lexsort((total, enough))[-1])
        if (bool(enough[top]), int(total[top])) > best:
            best = (bool(enough[top]), int(total[top]))
            result = (*(float(found[top] / of) if of else 1.0 for found, of in parts), best[0])
    return result


def _block_matches(index: Index, block: Block) -> list[tuple]:
    terms, first = _terms(block)
    n_terms = np.diff(first)
    step = PASSAGE_WORDS // 2
    text = np.repeat(np.arange(len(block)), n_terms)
    part = (np.arange(len(terms)) - first[text]) // step
    # A term stands in the passage that begins in its half and in the one that began before.
    offset = np.cumsum(n_terms // step + 2) - (n_terms // step + 2) + 1
    own = offset[text] + part
    numbers, units, scores = retrieve(index, np.concatenate((terms, terms)), np.concatenate((own, own - 1)))
    best: dict[tuple[int, int], tuple[float, int]] = {}
    texts = np.searchsorted(offset - 1, numbers, side="right") - 1
    for t, number, unit, score in zip(texts.tolist(), numbers.tolist(), units.tolist(), scores.tolist(), strict=True):
        key = (t, int(index.item_of_unit[unit]))
        place = max(0, number - int(offset[t])) * step
        best[key] = min(best.get(key, (0.0, 0)), (-score, place))
    rows = []
    for (t, item), (score, place) in sorted(best.items()):
        own_terms = terms[first[t]:first[t + 1]]
        question, answer = (_share(own_terms, part) for part in index.shingles[item])
        whole = question >= OVERLAP and answer >= OVERLAP
        question_words, answer_words, along = _along(own_terms, index.words[item])
        rows.append((block.first + t, item, place, -score, question, answer, question_words, answer_words, whole or along))
    return rows


def matches(docs: DataFrame, items: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns of ``docs`` with each item retrieved for the row's text: ``item_id``,
    ``passage`` (first word of the best passage), ``score``, ``question_overlap``,
    ``answer_overlap`` (shares of shingles), ``question_words``, ``answer_words`` (shares of words
    along the item) and ``contaminated``.

    Null and empty texts and items match nothing; items without an id are left out and an id with
    several texts counts once, with the largest. Repeated rows give repeated results. Empty tables
    give an empty result. A benchmark beyond ``SHARD_UNITS`` units takes a pass for each shard.
    """
    spark = docs.sparkSession
    types = dict(docs.select(*keep).dtypes)
    names = ["item_id", "passage", "score", "question_overlap", "answer_overlap", "question_words", "answer_words", "contaminated"]
    kinds = [pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.float64(), pa.bool_()]
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [
        "item_id bigint, passage bigint, score double, question_overlap double, answer_overlap double, "
        "question_words double, answer_words double, contaminated boolean"])
    slim = docs.select(*keep, F.col("text").cast("string").alias("__text"))
    result = spark.createDataFrame([], schema)
    for index in shards(items):
        sent = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [r for b in blocks(batch.column(batch.num_columns - 1), 1 << 19) for r in _block_matches(sent.value, b)]
                if rows:
                    columns = list(zip(*rows, strict=True))
                    at = pa.array(columns[0], pa.int64())
                    yield pa.RecordBatch.from_arrays(
                        [c.take(at) for c in batch.columns[:-1]] + [pa.array(c, k) for c, k in zip(columns[1:], kinds, strict=True)],
                        names=[*keep, *names],
                    )

        result = result.union(slim.mapInArrow(run, schema))
    return result


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """Rows of ``docs`` whose texts do not hold a test item, with all columns."""
    hashed = docs.select(F.xxhash64(F.col("text").cast("string")).alias("__hash"), F.octet_length("text").alias("__size"),
                         "text").withColumn("text", F.col("text").cast("string"))
    bad = matches(hashed, items, "__hash", "__size").where("contaminated").select("__hash", "__size").distinct()
    bad = stored(docs.sparkSession, bad, "contaminated")
    on_hash = F.xxhash64(docs["text"].cast("string")).eqNullSafe(bad["__hash"])
    return docs.join(bad, on_hash & F.octet_length(docs["text"]).eqNullSafe(bad["__size"]), "left_anti")
