"""Product-quantiser codes of vectors, trained and assigned in exact integer arithmetic.

Vectors become integers and are cut into equal parts; each part position has a codebook. The
nearest entry needs the dot product of each part with each entry. These come from float64 matrix
products of limbs: an integer is ``high * 2**LIMB_BITS + low``, so the products of limbs stay
below ``2**53`` where float64 is exact, and are put together again in 64-bit integers. The
nearest entry is the first minimum of ``|entry|**2 - 2 part.entry``.

Each round is one pass over the stored integers: tasks add up the parts that each entry got, and
Spark adds up those sums. Only codebooks, of a fixed size, come to the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gameflow.llm.store import stored

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Bits of the lower limb. Components are below 2**27 in size, so both limbs are products of 14 bits at most.
LIMB_BITS = 14
#: Parts whose distances to all entries are looked at in one go.
ROWS = 1 << 15


def component_limit(width: int) -> int:
    """Integers below this size give exact 64-bit squared distances over ``width`` components."""
    return min(1 << 27, 1 << ((61 - max(width - 1, 1).bit_length()) // 2))


def dot_products(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """``x @ y.T`` of 64-bit integers below 2**27 in size, exactly, from one float64 matrix product."""
    n, m, width = len(x), len(y), x.shape[1]
    if width << (2 * LIMB_BITS) > 1 << 53:
        raise ValueError(f"{width} components are too many for limbs of {LIMB_BITS} bits")
    low = (1 << LIMB_BITS) - 1
    limbs = [np.concatenate((v >> LIMB_BITS, v & low)).astype(np.float64) for v in (x, y)]
    products = (limbs[0] @ limbs[1].T).astype(np.int64)
    high_high, high_low, low_high, low_low = products[:n, :m], products[:n, m:], products[n:, :m], products[n:, m:]
    return (high_high << (2 * LIMB_BITS)) + ((high_low + low_high) << LIMB_BITS) + low_low


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first nearest row of ``book`` for each row of ``x``, and the squared distance."""
    code, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    lengths = (book * book).sum(axis=1)
    for at in range(0, len(x), ROWS):
        part = x[at:at + ROWS]
        score = lengths - 2 * dot_products(part, book)
        code[at:at + ROWS] = score.argmin(axis=1)
        distance[at:at + ROWS] = score.min(axis=1) + (part * part).sum(axis=1)
    return code, distance


def integer_vectors(vectors: DataFrame, parts: int = PARTS) -> DataFrame:
    """``vec_id``, ``label`` and ``v``, the vector in integers, of the rows that are kept.

    Dropped are null vectors and those with null or non-finite components, and, since they have no
    equal parts, those whose length ``parts`` does not divide and empty ones.
    """
    exact = F.transform(F.col("embedding"), lambda x: x.cast("double"))
    whole = F.forall(exact, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    kept = vectors.where(F.coalesce(whole, F.lit(False)) & (F.size("embedding") > 0) & (F.size("embedding") % parts == 0))
    limit = F.transform(exact, lambda x: F.when(F.abs(x) < (1 << 27) / SCALE, F.floor(x * SCALE)).otherwise(
        F.raise_error(F.lit("a component is too large for exact 64-bit distances")).cast("long")))
    return kept.select(F.col("vec_id").cast("long"), "label", limit.alias("v"))


def _parts(column: pa.Array, parts: int) -> np.ndarray:
    """Components by part, row and position."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    return np.ascontiguousarray(flat.reshape(len(column), parts, -1).transpose(1, 0, 2))


def _updated(vectors: DataFrame, books: np.ndarray) -> np.ndarray:
    """The codebooks after one round: means of what each entry got, rounded down."""
    parts, entries, width = books.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((parts * entries, width), np.int64)
        counts = np.zeros(parts * entries, np.int64)
        for batch in batches:
            for p, x in enumerate(_parts(batch.column(0), parts)):
                code, _ = nearest(x, books[p])
                counts += np.bincount(p * entries + code, minlength=len(counts))
                order = np.argsort(code, kind="stable")
                got, first = np.unique(code[order], return_index=True)
                sums[p * entries + got] += np.add.reduceat(x[order], first) if len(got) else 0
        used = np.flatnonzero(counts)
        cell = (used[:, None] * width + np.arange(width)).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell), pa.array(sums[used].ravel()), pa.array(np.repeat(counts[used], width))], names=["cell", "s", "n"]
        )

    added = vectors.select("v").mapInArrow(run, "cell long, s long, n long")
    # Sums of many tasks may pass 64 bits; the mean, rounded down, does not.
    total = F.sum(F.col("s").cast("decimal(38,0)"))
    added = added.groupBy("cell").agg(total.cast("string").alias("s"), F.sum("n").alias("n"))
    flat = books.reshape(-1).copy()
    for r in added.collect():
        flat[r["cell"]] = int(r["s"]) // r["n"]
    return flat.reshape(books.shape)


def train(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> np.ndarray:
    """Codebooks by part, entry and position, of integer vectors ``vec_id``, ``v`` of one length.

    They start as the parts of the vectors with the smallest ids (of several with one id, the
    least) and are refined in ``rounds`` passes; an entry that got nothing stays. Fewer ids give
    fewer entries.
    """
    known = vectors.where("vec_id is not null")
    ids = [r[0] for r in known.select("vec_id").distinct().orderBy("vec_id").limit(entries).collect()]
    if not ids:
        return np.zeros((parts, 0, 0), np.int64)
    first = known.where(F.col("vec_id").isin(ids)).groupBy("vec_id").agg(F.min("v").alias("v")).orderBy("vec_id").collect()
    books = np.array([r["v"] for r in first], np.int64)
    books = np.ascontiguousarray(books.reshape(len(first), parts, -1).transpose(1, 0, 2))
    for _ in range(rounds):
        books = _updated(vectors, books)
    return books


def assign(vectors: DataFrame, books: np.ndarray) -> DataFrame:
    """``vec_id``, ``label``, ``code`` and ``error`` of integer vectors."""
    parts = len(books)
    label = dict(vectors.dtypes)["label"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros((batch.num_rows, parts), np.uint8)
            error = np.zeros(batch.num_rows, np.int64)
            for p, x in enumerate(_parts(batch.column(2), parts)):
                code, distance = nearest(x, books[p])
                codes[:, p] = code
                error += distance
            text = codes.tobytes().hex()
            names = [text[i:i + 2 * parts] for i in range(0, len(text), 2 * parts)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(names, pa.string()), pa.array(error)], names=["vec_id", "label", "code", "error"]
            )

    return vectors.mapInArrow(run, f"vec_id long, label {label}, code string, error long")


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(map(str, books.reshape(-1).tolist())).encode()).hexdigest()


def vector_codes(
    table: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """Per kept row of ``table(vec_id, embedding, label)``: ``vec_id``, ``code`` (two hex digits per
    part), ``error`` (squared distance to the coded vector), ``label_error`` (sum of it over equal
    labels, nulls together) and ``codebooks_sha256``.

    Dropped are rows whose vector is null, empty or of a length that ``parts`` does not divide, or
    holds null or non-finite components; and those whose length is not that of the kept vector with
    the smallest id. Components of 32,768 or more in size stop the job, since their squared
    distances may not fit 64 bits. Repeated rows are coded each; a null id is coded but starts no
    entry; an empty table gives an empty result; other columns are not used.
    """
    spark = table.sparkSession
    if entries > 256:
        raise ValueError("two hex digits name 256 entries")
    vectors = stored(spark, integer_vectors(table, parts), "integer-vectors")
    shape = vectors.select(F.col("vec_id").isNull().alias("none"), "vec_id", F.size("v").alias("width")).orderBy("none", "vec_id", "width").first()
    width = shape["width"] if shape else parts
    if component_limit(width) < 1 << 27:
        largest = vectors.agg(F.max(F.array_max(F.transform("v", F.abs)))).first()[0] or 0
        if largest >= component_limit(width):
            raise ValueError("components are too large for exact 64-bit distances over this many of them")
    vectors = vectors.where(F.size("v") == width)
    books = train(vectors, parts, entries, rounds)
    if not books.size:
        books = np.zeros((parts, 1, width // parts), np.int64)
    coded = stored(spark, assign(vectors, books), "vector-codes")
    sums = coded.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    return coded.join(sums, coded["label"].eqNullSafe(sums["__label"])).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256")
    )
