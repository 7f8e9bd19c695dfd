"""Token counts from an exact histogram of encoded lengths.

Texts are encoded once. What goes on is the number of documents per source and length, summed
within each Arrow batch already, so a source with most rows adds a few thousand rows per task.
Suffix sums over the histogram, which has one row per distinct length, answer how many tokens
documents hold in total or cut off at any context limit, and which length a quantile has.
"""

from __future__ import annotations

import base64
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import tiktoken
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

VOCABULARY = "/opt/tokenizers/byte_bpe_multi_50k.tiktoken"
#: Fixed value: the split pattern that belongs to the vocabulary.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


#: Blanks as the split pattern knows them, and how many in a row it is not asked to split: it would
#: go back over them one by one, each on the stack.
BLANK = "\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000"
MANY_BLANKS = 100_000
_MANY = re.compile(f"(?<![{BLANK}])[{BLANK}]{{{MANY_BLANKS},}}")


def encoded_length(encoding: tiktoken.Encoding, text: str) -> int:
    """How many tokens a text has, also where it holds very many blanks in a row.

    Such a run is one piece up to its last blank, which belongs to what follows; at the end of the
    text it is one piece as a whole. So it is cut there and encoded without splitting.
    """
    if len(text) < MANY_BLANKS:
        return len(encoding.encode_ordinary(text))
    length, at = 0, 0
    for run in _MANY.finditer(text):
        end = run.end() - (run.end() < len(text))
        length += len(encoding.encode_ordinary(text[at:run.start()]))
        length += len(encoding._encode_single_piece(text[run.start():end]))
        at = end
    return length + len(encoding.encode_ordinary(text[at:]))


@lru_cache(maxsize=2)
def _encoding(vocabulary: bytes, pattern: str) -> tiktoken.Encoding:
    ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, vocabulary.splitlines())}
    return tiktoken.Encoding("lengths", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def length_histogram(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """``source``, ``length`` and ``n``: documents of each encoded length (null text: 0).

    The vocabulary file, about a megabyte, is read by the driver and sent to all tasks.
    """
    with open(vocabulary, "rb") as file:
        sent = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = _encoding(sent.value, pattern)
        for batch in batches:
            counts: Counter = Counter()
            for source, text in zip(batch.column(0), batch.column(1), strict=True):
                counts[source.as_py(), encoded_length(encoding, text.as_py() or "")] += 1
            yield pa.RecordBatch.from_arrays([
                pa.array([s for s, _ in counts], pa.string()), pa.array([k for _, k in counts], pa.int64()),
                pa.array(counts.values(), pa.int64()),
            ], names=["source", "length", "n"])

    slim = docs.select(F.col("source").cast("string"), F.col("text").cast("string"))
    counted = slim.mapInArrow(run, "source string, length bigint, n bigint")
    return counted.groupBy("source", "length").agg(F.sum("n").alias("n"))


def suffix_sums(histogram: DataFrame) -> DataFrame:
    """Per scope (all documents, or one source) and length, what a limit of that length means.

    ``docs_within`` and ``docs_beyond`` split the documents at the limit; ``tokens`` and
    ``truncated`` are the tokens of all documents, whole and cut off at the limit; ``rank`` is
    the part of documents within, so the smallest length of rank q or more is the q-quantile.
    """
    scopes = histogram.withColumn("scope", F.lit("source")).select("scope", "source", "length", "n").union(
        histogram.groupBy("length").agg(F.sum("n").alias("n"))
        .select(F.lit("all"), F.lit(None).cast("string"), "length", "n")
    )
    by = Window.partitionBy("scope", "source")
    beyond = by.orderBy(F.col("length").desc()).rowsBetween(Window.unboundedPreceding, -1)

    def suffix(x: Column) -> Column:
        return F.coalesce(F.sum(x).over(beyond), F.lit(0))

    size = F.col("length") * F.col("n")
    return scopes.select(
        "scope", "source", "length", "n", suffix(F.col("n")).alias("docs_beyond"), suffix(size).alias("tokens_beyond"),
        F.sum("n").over(by).alias("docs"), F.sum(size).over(by).alias("tokens"),
    ).select(
        "scope", "source", "length", "n", (F.col("docs") - F.col("docs_beyond")).alias("docs_within"), "docs_beyond", "tokens",
        (F.col("tokens") - F.col("tokens_beyond") + F.col("length") * F.col("docs_beyond")).alias("truncated"),
        ((F.col("docs") - F.col("docs_beyond")) / F.col("docs")).alias("rank"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> DataFrame:
    """``truncated`` totals per scope at any limits: those of the largest length not above, plus
    the documents beyond times the rest."""
    parts = F.explode(F.array(*[F.lit(int(x)).cast("long") for x in limits])).alias("limit")
    below = F.max(F.when(F.col("length") <= F.col("limit"), F.struct("length", "truncated", "docs_beyond")))
    docs = F.max(F.col("docs_within") + F.col("docs_beyond"))
    best = sums.select("*", parts).groupBy("scope", "source", "limit").agg(below.alias("b"), docs.alias("docs"))
    return best.select(
        "scope", "source", "limit",
        F.when(F.col("b").isNull(), F.col("docs") * F.col("limit"))
        .otherwise(F.col("b.truncated") + F.col("b.docs_beyond") * (F.col("limit") - F.col("b.length"))).alias("truncated"),
    )


def token_counts(docs: DataFrame, vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """Suffix sums of the lengths of ``docs(text, source)``, per source and over all.

    Null and empty texts have length 0, the null source is a source of its own (``scope`` tells
    it from all). Repeated rows count one by one; an empty table gives an empty result. Other
    columns are not used.
    """
    return suffix_sums(length_histogram(docs, vocabulary, pattern))
