"""Phrases whose words stand together more often than their parts make likely, by stripes.

A stripe is an associative counter under a prefix: of each word that follows the prefix within a
piece of text it holds how often it does. Each task makes the stripes of a block of text as lists
beside their prefix, stripes of one prefix meet by a shuffle, and are merged elementwise. The
stripe of the empty prefix holds the words themselves. From the merged stripes come all numbers:
extensions (the phrases), prefix totals (the counts of the parts) and subsumption maxima (the
largest count of a phrase that is one word longer).

Prefixes grow by a word per round. A phrase can only be frequent if the two phrases that are one
word shorter are, so before a round those that are go into a bit filter of fixed size, which
rules most of the others out before the shuffle. What passes by chance is dropped by its count,
so results do not depend on the filter. The stripe of a prefix with a large share of all words is
cut into segments by a hash of the next word, so no task gets much more than others.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gameflow.llm.store import stored
from gameflow.llm.texts import LOWER, as_bytes, chain, mix, prefix_hashes, range_hashes, runs, u64

LONGEST = 3
LEAST = 10
SUBSUMED_PERCENT = 50
TOP = 2000
#: Bytes that end a piece, and those that end a word.
PIECE_END = np.zeros(256, dtype=bool)
PIECE_END[[*b".,;:!?", 10, 11, 12, 13]] = True
WORD_END = PIECE_END.copy()
WORD_END[[32, 9]] = True
#: Bytes of text whose stripes are made at once; a longer piece is taken whole.
CHUNK_BYTES = 8 << 20
#: Entries of stripes that are merged at once.
MERGED = 1 << 19
#: Bits of the filter; 8 MB are broadcast, whatever the size of the tables.
FILTER_BITS = 1 << 26
#: A prefix with more than one in so many of all words is cut into segments; there are fewer such prefixes.
SHARES = 4096
#: Parts in which the candidates of a language are ranked before the last ranking.
RANKED_IN = 64


def _chunks(column: pa.Array) -> Iterator[np.ndarray]:
    """The bytes of the texts, lower-cased, a piece end between them, cut at piece ends."""
    data, offsets = as_bytes(column)
    data = LOWER[np.insert(data, offsets[1:-1], 10)]
    at = 0
    while at < len(data):
        end = at + CHUNK_BYTES
        if end < len(data):
            last = np.flatnonzero(PIECE_END[data[at:end]][::-1])[:1]
            while not len(last) and end < len(data):  # a very long piece
                found = np.flatnonzero(PIECE_END[data[end:end + CHUNK_BYTES]])[:1]
                end, last = (end + int(found[0]), np.zeros(1)) if len(found) else (end + CHUNK_BYTES, last)
            end -= int(last[0]) if len(last) else 0
        yield data[at:end]
        at = end


def _words(data: np.ndarray) -> tuple[np.ndarray, pa.Array, np.ndarray]:
    """Place of each word in the vocabulary, the vocabulary, and whether the next word follows in the same piece."""
    inside = ~WORD_END[data]
    start, end = inside.copy(), inside.copy()
    start[1:] &= ~inside[:-1]
    end[:-1] &= ~inside[1:]
    starts, ends = np.flatnonzero(start), np.flatnonzero(end) + 1
    offsets = np.zeros(len(starts) + 1, np.int32)
    np.cumsum(ends - starts, out=offsets[1:])
    words = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[inside])))
    coded = words.dictionary_encode()
    piece = np.cumsum(PIECE_END[data], dtype=np.int32)[starts]
    return coded.indices.to_numpy().astype(np.int64), coded.dictionary, piece[1:] == piece[:-1]


def _hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string."""
    data, offsets = as_bytes(words)
    return mix(range_hashes(prefix_hashes(data), offsets[:-1], offsets[1:]) + np.diff(offsets).astype(np.uint64))


def _seed(lang: str) -> np.uint64:
    return u64(xxhash.xxh64_intdigest(lang.encode()))


def _bits(hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The two places of each hash in the filter."""
    spread = mix(hashes)
    return (spread & u64(FILTER_BITS - 1)).astype(np.int64), (spread >> u64(37)).astype(np.int64) & (FILTER_BITS - 1)


def _passes(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    a, b = _bits(hashes)
    return ((bits[a >> 3] >> (a & 7)) & (bits[b >> 3] >> (b & 7)) & 1).astype(bool)


def _filter(spark: SparkSession, phrases: DataFrame):
    """A broadcast bit filter of the phrases ``lang``, ``phrase``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            seeds = np.array([_seed(x) for x in langs.dictionary.to_pylist()], np.uint64)
            hashes = None
            for words in _columns(batch.column(1)):
                hashes = _hashes(words) if hashes is None else chain(hashes, _hashes(words))
            a, b = _bits(chain(seeds[langs.indices.to_numpy()], hashes))
            at = np.unique(np.concatenate((a, b)))
            cell, first = np.unique(at >> 6, return_index=True)
            if len(cell):
                bits = np.bitwise_or.reduceat(np.left_shift(np.uint64(1), (at & 63).astype(np.uint64)), first)
                yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(bits.view(np.int64))], names=["cell", "bits"])

    cells = phrases.select("lang", "phrase").mapInArrow(run, "cell long, bits long")
    cells = cells.groupBy("cell").agg(F.bit_or("bits").alias("bits")).toArrow()
    bits = np.zeros(FILTER_BITS >> 6, np.int64)
    bits[cells.column("cell").to_numpy()] = cells.column("bits").to_numpy()
    return spark.sparkContext.broadcast(bits.view(np.uint8))


def _columns(phrases: pa.Array) -> list[pa.Array]:
    """The first, second, ... words of phrases that have equally many."""
    parts = pc.split_pattern(phrases, " ")
    n = len(parts[0]) if len(parts) else 1
    return [pc.list_element(parts, k) for k in range(n)]


def _by_lang(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[str, np.ndarray]]:
    """Chunks of the texts of each language."""
    for batch in batches:
        langs = batch.column(0).dictionary_encode()
        codes = langs.indices.to_numpy()
        for k, lang in enumerate(langs.dictionary.to_pylist()):
            for chunk in _chunks(batch.column(1).filter(pa.array(codes == k))):
                yield lang, chunk


def _word_counts(texts: DataFrame) -> DataFrame:
    """The stripe of the empty prefix: ``lang``, ``phrase`` and ``a``; under a null phrase all words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in _by_lang(batches):
            codes, vocabulary, _ = _words(chunk)
            counts = np.bincount(codes, minlength=len(vocabulary))
            words = pa.concat_arrays([vocabulary, pa.nulls(1, pa.string())])
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(words), pa.string()), words, pa.array(np.append(counts, len(codes)))], names=["lang", "phrase", "a"]
            )

    found = texts.mapInArrow(run, "lang string, phrase string, a long")
    return found.groupBy("lang", "phrase").agg(F.sum("a").alias("a"))


def _stripes(texts: DataFrame, length: int, filters: list, segments: dict[tuple[str, str], int]) -> DataFrame:
    """Stripes of prefixes of ``length - 1`` words, one per block and segment:
    ``lang``, ``prefix``, ``segment``, ``next`` and ``n``."""

    def stripes(lang: str, data: np.ndarray) -> Iterator[pa.RecordBatch]:
        codes, vocabulary, follows = _words(data)
        words, seed = _hashes(vocabulary), _seed(lang)
        # Phrases of 1, 2, ... words from each place on: their ids, hashes by id and whether they may be frequent.
        ids, hashes = codes, words
        at = np.arange(len(codes))
        keep = _passes(filters[0].value, chain(np.broadcast_to(seed, len(words)), words))[codes] if len(codes) else np.zeros(0, bool)
        for k in range(1, length):
            known = np.zeros(len(codes) + 1, bool)
            known[at[keep]] = True
            id_at = np.zeros(len(codes) + 1, np.int64)
            id_at[at] = ids
            at = at[keep]
            at = at[at + k < len(codes)]
            at = at[follows[at + k - 1] & known[at + 1]]
            key = id_at[at] * len(vocabulary) + codes[at + k]
            if k == length - 1:
                break
            unique, first, ids = np.unique(key, return_index=True, return_inverse=True)
            hashes = chain(hashes[unique // max(len(vocabulary), 1)], words[unique % max(len(vocabulary), 1)])
            keep = _passes(filters[k].value, chain(np.broadcast_to(seed, len(hashes)), hashes))[ids]
        if not len(key):
            return
        order = np.argsort(key, kind="stable")
        unique, n = runs(key[order])
        first = order[np.cumsum(n) - n]
        prefix, following = unique // len(vocabulary), unique % len(vocabulary)
        start = np.flatnonzero(np.concatenate(([True], prefix[1:] != prefix[:-1])))
        where = at[first[start]]
        names = [vocabulary.take(pa.array(codes[where + j])) for j in range(length - 1)]
        names = pc.binary_join_element_wise(*names, " ") if len(names) > 1 else names[0]
        segment = np.zeros(len(unique), np.int64)
        if segments:
            cut = np.array([segments.get((lang, x), 1) for x in names.to_pylist()], np.uint64)
            cut = np.repeat(cut, np.diff(np.append(start, len(unique))))
            if (cut > 1).any():
                segment = (words[following] % cut).astype(np.int64)
                row = np.repeat(np.arange(len(start)), np.diff(np.append(start, len(unique))))
                order = np.lexsort((segment, row))
                row, segment, following, n = row[order], segment[order], following[order], n[order]
                start = np.flatnonzero(np.concatenate(([True], (row[1:] != row[:-1]) | (segment[1:] != segment[:-1]))))
                names = names.take(pa.array(row[start]))
        offsets = pa.array(np.append(start, len(n)).astype(np.int32))
        yield pa.RecordBatch.from_arrays([
            pa.array([lang] * len(start), pa.string()), names, pa.array(segment[start].astype(np.int32)),
            pa.ListArray.from_arrays(offsets, vocabulary.take(pa.array(following))), pa.ListArray.from_arrays(offsets, pa.array(n)),
        ], names=["lang", "prefix", "segment", "next", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for lang, chunk in _by_lang(batches):
            for stripe in stripes(lang, chunk):
                for at in range(0, stripe.num_rows, 50_000):
                    yield stripe.slice(at, 50_000)

    return texts.mapInArrow(run, "lang string, prefix string, segment int, next array<string>, n array<long>")


def _merged(stripes: DataFrame, least: int) -> DataFrame:
    """Stripes added up elementwise by prefix and segment, of each the words that follow ``least`` times or more."""

    def added(table: pa.Table) -> tuple[pa.Table, np.ndarray, pa.Table]:
        """The first row of each prefix and segment, and the entries with the number of their row."""
        table = table.combine_chunks()
        key = table.select([0, 1, 2])
        changed = np.zeros(max(len(key) - 1, 0), bool)
        for column in key.columns:
            changed |= pc.not_equal(column[1:], column[:-1]).to_numpy()
        row = np.concatenate(([0], np.cumsum(changed))) if len(key) else np.zeros(0, np.int64)
        lengths = pc.list_value_length(table.column(3)).to_numpy()
        entries = pa.table({
            "row": np.repeat(row, lengths), "next": pc.list_flatten(table.column(3)), "n": pc.list_flatten(table.column(4)),
        }).group_by(["row", "next"], use_threads=False).aggregate([("n", "sum")])
        entries = entries.select(["row", "next", "n_sum"]).sort_by("row")
        return key.take(pa.array(np.concatenate(([0], np.flatnonzero(changed) + 1)) if len(key) else [])), row, entries

    def lists(key: pa.Table, entries: pa.Table) -> Iterator[pa.RecordBatch]:
        entries = entries.combine_chunks()
        rows, n = runs(entries.column("row").to_numpy())
        offsets = pa.array(np.concatenate(([0], np.cumsum(n))).astype(np.int32))
        columns = [c.combine_chunks() for c in key.take(pa.array(rows)).columns]
        values = [entries.column(k).combine_chunks() for k in ("next", "n_sum")]
        values = [v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v for v in values]
        columns += [pa.ListArray.from_arrays(offsets, v) for v in values]
        yield pa.RecordBatch.from_arrays(columns, names=["lang", "prefix", "segment", "next", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0

        def results(table: pa.Table, whole: bool) -> Iterator[pa.RecordBatch]:
            key, _, entries = added(table)
            if whole:
                entries = entries.filter(pc.greater_equal(entries.column("n_sum"), least))
            if len(entries):
                yield from lists(key, entries)

        for batch in batches:
            held.append(batch)
            size += len(pc.list_flatten(batch.column(3)))
            if size < MERGED:
                continue
            table = pa.Table.from_batches(held)
            same = np.ones(len(table), bool)
            for k in range(3):
                same &= pc.equal(table.column(k), table.column(k)[-1]).to_numpy()
            last = len(table) - int(same.sum())  # the last prefix may go on
            yield from results(table.slice(0, last), True)
            rest = pa.Table.from_batches(list(results(table.slice(last), False)), schema=table.schema)
            held = rest.to_batches()
            size = min(len(pc.list_flatten(rest.column(3))), MERGED // 2)
        if held:
            yield from results(pa.Table.from_batches(held), True)

    dealt = stripes.repartition("lang", "prefix", "segment").sortWithinPartitions("lang", "prefix", "segment")
    return dealt.mapInArrow(run, stripes.schema)


def _segments(counts: DataFrame, words: int) -> dict[tuple[str, str], int]:
    """Into how many segments the stripes of the most frequent prefixes are cut; at most ``SHARES`` prefixes."""
    share = max(words // SHARES, 1)
    frequent = counts.where((F.col("a") > share) & F.col("phrase").isNotNull())
    return {(r["lang"], r["phrase"]): -(-r["a"] // share) for r in frequent.collect()} if words >= SHARES else {}


def phrase_counts(docs: DataFrame, longest: int = LONGEST, least: int = LEAST) -> list[DataFrame]:
    """For 1, 2, ... ``longest`` words the phrases that occur ``least`` times or more in a language:
    ``lang``, ``phrase``, ``a``. The first table has under a null phrase the number of all words.

    Prefix totals and extensions of the stripes, stored in the scratch folder.
    """
    spark = docs.sparkSession
    texts = docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text"))
    counts = [stored(spark, _word_counts(texts).where(F.col("phrase").isNull() | (F.col("a") >= least)), "words")]
    words = counts[0].where("phrase is null").agg(F.sum("a")).first()[0] or 0
    filters: list = []
    for length in range(2, longest + 1):
        filters.append(_filter(spark, counts[-1].where("phrase is not null")))
        stripes = _merged(_stripes(texts, length, filters, _segments(counts[-1], words)), least)
        entries = stripes.select("lang", "prefix", F.explode(F.arrays_zip("next", "n")).alias("entry"))
        counts.append(stored(spark, entries.select(
            "lang", F.concat_ws(" ", "prefix", "entry.next").alias("phrase"), F.col("entry.n").alias("a")
        ), f"phrases-{length}"))
    for used in filters:
        used.unpersist()
    return counts


def _part(phrase: str, first: int, last: int):
    """Words ``first`` to ``last`` of a phrase, from zero, the last excluded."""
    return F.concat_ws(" ", F.slice(F.split(phrase, " "), first + 1, last - first))


def collocations(
    docs: DataFrame, longest: int = LONGEST, least: int = LEAST, subsumed_percent: int = SUBSUMED_PERCENT, top: int = TOP
) -> DataFrame:
    """The ``top`` phrases of two to ``longest`` words of each language of ``docs(lang, text)``:
    ``lang``, ``rank``, ``phrase``, ``a`` (its count), ``l`` and ``r`` (counts of the parts at the
    worst cut), ``n`` (words of the language) and ``score`` (1,000,000 a a / (l r), rounded down).

    A phrase that a longer one with ``subsumed_percent`` of its count contains is left out. Equal
    scores are ordered by count, then by bytes. Null languages count as ``und``, null and empty texts
    have no words, repeated rows count each time; an empty table gives an empty result; other columns
    are not used. Counts are exact; scores are computed in decimals of 38 digits.
    """
    spark = docs.sparkSession
    counts = phrase_counts(docs, longest, least)

    def counted(frame: DataFrame, words: int, part, name: str) -> DataFrame:
        of = counts[words - 1].select(F.col("lang").alias("__lang"), F.col("phrase").alias("__phrase"), F.col("a").alias(name))
        frame = frame.withColumn("__part", part)
        return frame.join(of, (F.col("lang") == F.col("__lang")) & (F.col("__part") == F.col("__phrase"))).drop("__part", "__lang", "__phrase")

    def exact(name: str):
        return F.col(name).cast("decimal(18,0)")

    scored = None
    for length in range(2, longest + 1):
        found = counts[length - 1]
        if length < longest:  # the largest count of a phrase that begins or ends with one more word
            longer = counts[length]
            inside = longer.select("lang", _part("phrase", 0, length).alias("phrase"), "a").union(
                longer.select("lang", _part("phrase", 1, length + 1).alias("phrase"), "a"))
            most = inside.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
            most = most.select(F.col("lang").alias("__lang"), F.col("phrase").alias("__phrase"), "most")
            found = found.join(most, (F.col("lang") == F.col("__lang")) & (F.col("phrase") == F.col("__phrase")), "left")
            found = found.where(F.coalesce(F.col("most") * 100 < F.col("a") * subsumed_percent, F.lit(True))).select("lang", "phrase", "a")
        cuts = []
        for k in range(1, length):
            found = counted(found, k, _part("phrase", 0, k), f"l{k}")
            found = counted(found, length - k, _part("phrase", k, length), f"r{k}")
            score = F.expr(f"cast(a as decimal(18,0)) * cast(a as decimal(18,0)) * cast(1000000 as decimal(7,0)) "
                           f"div (cast(l{k} as decimal(18,0)) * cast(r{k} as decimal(18,0)))")
            cuts.append(F.struct(score.alias("score"), F.lit(k).alias("k"), F.col(f"l{k}").alias("l"), F.col(f"r{k}").alias("r")))
        found = found.select("lang", "phrase", "a", (F.array_min(F.array(*cuts)) if len(cuts) > 1 else cuts[0]).alias("cut"))
        found = found.select("lang", "phrase", "a", "cut.l", "cut.r", "cut.score")
        scored = found if scored is None else scored.union(found)
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(RANKED_IN))
    first = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
    first = first.where(F.col("rank") <= top).drop("part", "rank")
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long")).where(F.col("rank") <= top)
    total = counts[0].where("phrase is null").select(F.col("lang").alias("__lang"), F.col("a").alias("n"))
    return ranked.join(total, F.col("lang") == F.col("__lang")).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
