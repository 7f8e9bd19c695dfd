"""Quality rules whose cutoffs come from the corpus itself.

Texts are measured once, inside Arrow batches. The measures of every (lang, source) group go
into a quantile sketch: a count for each value rounded down to its leading bits. Sketches of
that kind merge by adding counts, so Spark aggregates them like any sum, a group that holds a
third of all rows is combined before the shuffle, and the sketches of small groups merge into
that of their language. Cutoffs are read from the sketches and joined back to the documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gameflow.llm.store import stored
from gameflow.llm.texts import blocks, chain, mix, prefix_hashes, range_hashes, runs, word_hashes

SYMBOLS = b"#*$%&|<>"
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
#: A (lang, source) group of fewer measured documents uses its language's merged sketch.
MIN_GROUP = 200
#: Leading bits that a sketch keeps: values are at most 1/32 below the truth.
SKETCH_BITS = 6
MEASURES = ["n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words"]
#: Rates that get adaptive cutoffs, per thousand (word length in hundredths of a character).
#: An upper cutoff is ``spread`` times the (90 % - 50 %) range above the 90 % quantile, and at
#: least ``slack`` above it; a lower one likewise below the 10 % quantile.
RATES: dict[str, tuple[str, int]] = {
    "word_length": ("both", 200),
    "symbol_rate": ("upper", 100),
    "dup_line_rate": ("upper", 400),
    "repeat_rate": ("upper", 400),
}
SPREAD = 4


def _measure_block(block) -> dict[str, np.ndarray]:
    starts, ends, first = block.words()
    n, texts = len(block.data), len(block)
    n_words = np.diff(first)
    text_of_word = np.repeat(np.arange(texts), n_words)

    leading = (block.data & 0xC0) != 0x80
    points = np.concatenate(([0], np.cumsum(leading)))
    word_chars = np.bincount(text_of_word, points[ends] - points[starts], minlength=texts).astype(np.int64)
    n_symbols = block.per_text(np.flatnonzero(np.isin(block.data, np.frombuffer(SYMBOLS, np.uint8))))

    # Lines: from the start of a text or after a newline, up to a newline or the end of the text.
    newline = np.flatnonzero(block.data == 10)
    line_start = np.concatenate((block.offsets[:-1], newline + 1))
    text_of_line = np.concatenate((np.arange(texts), np.searchsorted(block.offsets, newline, side="right") - 1))
    by_place = np.lexsort((line_start, text_of_line))
    line_start, text_of_line = line_start[by_place], text_of_line[by_place]
    line_end = block.offsets[text_of_line + 1].copy()
    same = text_of_line[1:] == text_of_line[:-1]
    line_end[:-1][same] = line_start[1:][same] - 1
    filled = np.searchsorted(starts, line_end) > np.searchsorted(starts, line_start)
    line_start, line_end, text_of_line = line_start[filled], line_end[filled], text_of_line[filled]
    prefix = prefix_hashes(block.data, seed=1)
    key = mix(range_hashes(prefix, line_start, line_end) + (line_end - line_start).astype(np.uint64))
    key = chain(text_of_line.astype(np.uint64), key)
    order = np.argsort(key, kind="stable")
    again = order[1:][key[order][1:] == key[order][:-1]]
    n_lines = np.bincount(text_of_line, minlength=texts)
    n_dup_lines = np.bincount(text_of_line[again], minlength=texts)

    n_repeat_words = np.zeros(texts, np.int64)
    if len(starts) > 2:
        h = word_hashes(block, starts, ends, lower=False)
        inside = text_of_word[2:] == text_of_word[:-2]
        at = np.flatnonzero(inside)
        key = chain(chain(chain(h[at], h[at + 1]), h[at + 2]), text_of_word[at].astype(np.uint64))
        values, counts = runs(np.sort(key))
        twice = values[counts > 1]
        if len(twice):
            place = np.minimum(np.searchsorted(twice, key), len(twice) - 1)
            hit = at[twice[place] == key]
            repeated = np.zeros(len(starts), bool)
            for k in range(3):
                repeated[hit + k] = True
            n_repeat_words = np.bincount(text_of_word[repeated], minlength=texts)
    return dict(zip(MEASURES, (n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words), strict=True))


def measure(docs: DataFrame, *keep: str) -> DataFrame:
    """The ``keep`` columns and the measures of each row's ``text`` (null: empty)."""
    kept = docs.select(*[F.col(c) for c in keep], F.col("text").cast("string").alias("__text"))
    types = dict(docs.select(*keep).dtypes)
    schema = ", ".join([f"`{c}` {types[c]}" for c in keep] + [f"{m} bigint" for m in MEASURES])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            text = batch.column(batch.num_columns - 1)
            parts = [_measure_block(b) for b in blocks(text)]
            columns = batch.columns[:-1] + [
                pa.array(np.concatenate([p[m] for p in parts]) if parts else [], pa.int64()) for m in MEASURES
            ]
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *MEASURES])

    return kept.mapInArrow(run, schema)


def with_rates(measured: DataFrame) -> DataFrame:
    """Rates of the measures, and ``base_failed`` by the fixed rules every text must meet."""
    words, lines = F.greatest("n_words", F.lit(1)), F.greatest("n_lines", F.lit(1))

    def per(x: str, of: Column, scale: int) -> Column:
        return F.floor(F.col(x) * F.lit(scale) / of).cast("long")

    return measured.withColumns({
        "word_length": per("word_chars", words, 100),
        "symbol_rate": per("n_symbols", words, 1000),
        "dup_line_rate": per("n_dup_lines", lines, 1000),
        "repeat_rate": per("n_repeat_words", words, 1000),
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")),
    })


def sketch_value(x: Column) -> Column:
    """``x`` (not negative) rounded down to its ``SKETCH_BITS`` leading bits."""
    dropped = F.greatest(F.length(F.bin(x)) - SKETCH_BITS, F.lit(0))
    unit = F.pow(F.lit(2.0), dropped).cast("long")
    return F.floor(x / unit).cast("long") * unit


def sketches(rated: DataFrame) -> DataFrame:
    """One row per (lang, source, measure, value): the number ``n`` of documents there."""
    pairs = F.explode(F.array(*[
        F.struct(F.lit(r).alias("measure"), sketch_value(F.col(r)).alias("value")) for r in RATES
    ]))
    return (
        rated.where(~F.col("base_failed")).select("lang", "source", pairs.alias("p"))
        .groupBy("lang", "source", "p.measure", "p.value").agg(F.count("*").alias("n"))
    )


def quantiles(sketch: DataFrame, *group: str) -> DataFrame:
    """10 %, 50 % and 90 % quantiles and the row count of each group and measure.

    The window runs over sketch entries, of which a group has at most a few thousand.
    """
    by = [*group, "measure"]
    merged = sketch.groupBy(*by, "value").agg(F.sum("n").alias("n"))
    total = F.sum("n").over(Window.partitionBy(*by))
    upto = F.sum("n").over(Window.partitionBy(*by).orderBy("value"))
    return merged.select("*", total.alias("total"), upto.alias("upto")).groupBy(*by).agg(
        F.max("total").alias("total"),
        *[F.min(F.when(F.col("upto") * 100 >= F.col("total") * q, F.col("value"))).alias(f"q{q}") for q in (10, 50, 90)],
    )


def cutoffs(sketch: DataFrame) -> DataFrame:
    """Per (lang, source): lowest and highest accepted value of each rate, as columns."""
    own = quantiles(sketch, "lang", "source")
    wide = quantiles(sketch, "lang")
    small = F.col("o.total") < MIN_GROUP
    chosen = own.alias("o").join(
        wide.alias("w"), F.col("o.lang").eqNullSafe(F.col("w.lang")) & (F.col("o.measure") == F.col("w.measure")),
    ).select(
        "o.lang", "o.source", "o.measure",
        *[F.when(small, F.col(f"w.q{q}")).otherwise(F.col(f"o.q{q}")).alias(f"q{q}") for q in (10, 50, 90)],
    )
    bounds = []
    for rate, (side, slack) in RATES.items():
        high = F.col("q90") + F.greatest(F.lit(slack), SPREAD * (F.col("q90") - F.col("q50")))
        low = F.col("q10") - F.greatest(F.lit(slack), SPREAD * (F.col("q50") - F.col("q10")))
        is_rate = F.col("measure") == rate
        bounds.append(F.max(F.when(is_rate, high)).alias(f"{rate}_high"))
        if side == "both":
            bounds.append(F.max(F.when(is_rate, low)).alias(f"{rate}_low"))
    return chosen.groupBy("lang", "source").agg(*bounds)


def judge(rated: DataFrame, limits: DataFrame) -> DataFrame:
    """``kept``: the base rules hold and each rate lies within its group's cutoffs.

    The cutoffs have a row per (lang, source); a group that holds most rows is joined by
    broadcast or by a skew join as Spark sees fit.
    """
    limit = limits.select(
        F.col("lang").alias("__lang"), F.col("source").alias("__source"),
        *[c for c in limits.columns if c not in ("lang", "source")],
    )
    within = F.lit(True)
    for rate, (side, _) in RATES.items():
        within = within & (F.col(rate) <= F.col(f"{rate}_high"))
        if side == "both":
            within = within & (F.col(rate) >= F.col(f"{rate}_low"))
    joined = rated.join(
        limit, F.col("lang").eqNullSafe(F.col("__lang")) & F.col("source").eqNullSafe(F.col("__source")), "left",
    ).drop("__lang", "__source")
    return joined.withColumn("kept", F.coalesce(~F.col("base_failed") & within, F.lit(False)))


def quality_rules(docs: DataFrame) -> DataFrame:
    """Measures, rates, cutoffs and verdict of every row of ``docs(doc_id, text, lang, source)``.

    A null or empty text has no words and fails the base rules. Null ``lang`` or ``source``
    form groups of their own. Repeated rows are judged (and weigh in the sketches) one by one.
    An empty table gives an empty result. Other columns of ``docs`` are not used.
    """
    # Written once: the sketches and the verdict both read it, and the texts are gone by then.
    rated = stored(docs.sparkSession, with_rates(measure(docs, "doc_id", "lang", "source")), "quality")
    return judge(rated, cutoffs(sketches(rated)))


def keep_good(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that the rules keep, with all their columns, whatever their names.

    Texts are measured twice, once for the cutoffs and once beside their rows, so that no copy
    of them is stored.
    """
    spark = docs.sparkSession
    limits = stored(spark, cutoffs(sketches(with_rates(measure(docs, "lang", "source")))), "quality-cutoffs")
    whole = docs.select("lang", "source", "text", F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"))
    return judge(with_rates(measure(whole, "lang", "source", "__row")), limits).where("kept").select("__row.*")
