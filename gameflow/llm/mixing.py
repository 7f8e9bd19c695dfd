"""Mixing sources to target weights with a low-discrepancy schedule.

Documents of a source, in hashed order, form one sequence of words that is cut into blocks of
equally many words, smaller ones in a small source, so that each source can come near its target. Slot ``i`` of the schedule is the point ``i * golden ratio`` modulo 1; the
source whose stretch of the cumulative weights holds that point gives the slot its next block.
Every prefix of the schedule is then mixed close to the weights, and any slot can be computed
on its own, so slots are dealt to tasks like any range.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gameflow.llm.store import stored

#: Weights of the sources in order, repeating; share of all words; passes over a source at most.
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_PASSES = 2
BLOCK_WORDS = 256
#: Slots that a source's target takes at least, if it has as many words, and slots by which its
#: stretch is longer, so that it surely gets those it needs.
LEAST_SLOTS = 64
SPARE_SLOTS = 16
SEED = "mix-1"
#: The golden ratio in 31 bits: odd, so ``i * GOLDEN % 2**31`` visits every point once.
POINTS = 1 << 31
GOLDEN = 1327217885
#: Cells of the point range over which the lookup of a source is an equality join.
CELLS = 4096
CELL_POINTS = POINTS // CELLS


def sized(docs: DataFrame) -> DataFrame:
    """``doc_id``, ``source`` and ``size``: words of the whole text (null: 0)."""
    words = F.regexp_count(F.col("text").cast("string"), F.lit(r"[^\x20\x09-\x0D]+"))
    return docs.select("doc_id", F.col("source").cast("string"), F.coalesce(words, F.lit(0)).cast("long").alias("size"))


def source_targets(sizes: DataFrame) -> DataFrame:
    """One row per source: ``sid``, ``source_size`` and ``target``.

    A source is full when its weight's part would exceed ``MAX_PASSES`` times its words. The words
    that the sources give at a level (words per weight) are the least of the lines in which the
    first few sources, in the order of cap over weight, are full and the others rise; so the level
    that gives the mix is the largest of those at which the lines do. All windows here have one row
    per source. Targets are never negative and their sum is the mix.
    """
    ordered = Window.orderBy(F.col("source").asc_nulls_last())
    filling = Window.orderBy("ratio", "sid")
    everything = Window.partitionBy(F.lit(0))
    sources = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    place = F.row_number().over(ordered) - 1
    weight = F.element_at(F.array(*[F.lit(w) for w in WEIGHTS]), (F.col("sid") % len(WEIGHTS) + 1).cast("int"))
    cap = MAX_PASSES * F.col("source_size")
    return (
        sources.withColumn("sid", place).withColumn("weight", weight).withColumn("ratio", cap / F.col("weight"))
        .withColumn("mix", F.sum("source_size").over(everything) * SHARE_PERCENT / 100)
        .withColumn("level", (F.col("mix") - (F.sum(cap).over(filling) - cap))
                    / (F.sum("weight").over(everything) - (F.sum("weight").over(filling) - F.col("weight"))))
        .withColumn("level", F.max("level").over(everything))
        .select("source", "sid", "source_size",
                F.least(cap.cast("double"), F.col("level") * F.col("weight")).alias("target"))
    )


def source_blocks(targets: DataFrame) -> DataFrame:
    """``targets`` with how each source is cut and where it stands in the schedule: ``long_blocks``
    of ``block_words`` + 1 words and the rest of ``blocks`` of ``block_words``, the slots that its
    target ``needs``, all ``slots``, and its stretch of points from ``start`` to ``end``."""
    words = F.least(F.lit(BLOCK_WORDS), F.greatest(F.col("target") / LEAST_SLOTS, F.lit(1.0)))
    blocks = F.greatest(F.least(F.col("source_size"), F.ceil(F.col("source_size") / words)), F.lit(1))
    share = F.col("target") / F.greatest("source_size", F.lit(1))
    upto = F.sum(F.col("needs") + SPARE_SLOTS).over(Window.orderBy("sid"))
    total = F.sum(F.col("needs") + SPARE_SLOTS).over(Window.partitionBy(F.lit(0)))
    return (
        targets.withColumn("blocks", blocks).withColumn("needs", F.round(share * F.col("blocks")).cast("long"))
        .withColumn("block_words", F.expr("source_size div blocks")).withColumn("long_blocks", F.col("source_size") % F.col("blocks"))
        .withColumn("slots", total).withColumn("end", F.floor(upto / total * POINTS).cast("long"))
        .withColumn("start", F.coalesce(F.lag("end").over(Window.orderBy("sid")), F.lit(0)))
    )


def sequences(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Documents with ``sid``, ``source_size``, ``target`` and ``from_word``: their place in
    the hashed word sequence of their source.

    Running sums go over hash buckets first, then within each, so a source with most rows is
    still spread over many tasks.
    """
    known = targets.select(
        F.col("source").alias("__source"), "sid", "source_size", "target", "block_words", "long_blocks"
    )
    order = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit("|" + SEED)))
    placed = (
        sizes.join(known, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
        .withColumn("order", order).withColumn("bucket", F.substring("order", 1, 3))
    )
    buckets = placed.groupBy("sid", "bucket").agg(F.sum("size").alias("n"))
    before = F.sum("n").over(Window.partitionBy("sid").orderBy("bucket")) - F.col("n")
    buckets = buckets.select(F.col("sid").alias("__sid"), F.col("bucket").alias("__bucket"), before.alias("before"))
    within = Window.partitionBy("sid", "bucket").orderBy("order", "doc_id", "size")
    upto = F.sum("size").over(within.rowsBetween(Window.unboundedPreceding, 0))
    return (
        placed.withColumn("upto", upto).withColumn("row", F.row_number().over(within))
        .join(buckets, (F.col("sid") == F.col("__sid")) & (F.col("bucket") == F.col("__bucket")))
        .withColumn("from_word", F.col("before") + F.col("upto") - F.col("size"))
        .drop("__sid", "__bucket", "before", "upto")
    )


def schedule(targets: DataFrame) -> DataFrame:
    """One row per slot: ``slot``, ``sid``, ``pass`` and ``block`` of the source.

    Slots are ranked per source by counts per stretch of slots and ranks within each stretch.
    """
    spark = targets.sparkSession
    slots = targets.agg(F.max("slots")).first()[0] or 0
    stretch = max(1024, slots // 100_000)
    lookup = targets.where("end > start").withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("start") / CELL_POINTS), F.floor((F.col("end") - 1) / CELL_POINTS)))
    ).select("sid", "start", "end", "cell", "blocks", "needs")
    at = (F.col("id") % POINTS) * GOLDEN % POINTS
    drawn = (
        spark.range(slots).withColumn("at", at).withColumn("cell", F.floor(F.col("at") / CELL_POINTS))
        .join(lookup, "cell").where("at >= start and at < end")
        .select(F.col("id").alias("slot"), "sid", "blocks", "needs", F.floor(F.col("id") / stretch).alias("stretch"))
    )
    counts = drawn.groupBy("sid", "stretch").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("sid").orderBy("stretch")) - F.col("n")
    counts = counts.select(F.col("sid").alias("__sid"), F.col("stretch").alias("__stretch"), before.alias("before"))
    rank = F.row_number().over(Window.partitionBy("sid", "stretch").orderBy("slot")) - 1 + F.col("before")
    return (
        drawn.join(counts, (F.col("sid") == F.col("__sid")) & (F.col("stretch") == F.col("__stretch")))
        .withColumn("rank", rank).where(F.col("rank") < F.col("needs"))
        .select("slot", "sid", F.floor(F.col("rank") / F.col("blocks")).alias("pass"),
                (F.col("rank") % F.col("blocks")).alias("block"))
    )


def pieces(placed: DataFrame) -> DataFrame:
    """Documents cut at block borders: ``block`` and the ``words`` of the document in it.

    A document without words has one row with null ``block``.
    """
    def block_of(word: Column) -> Column:
        size, after = F.col("block_words"), word - F.col("long_blocks") * (F.col("block_words") + 1)
        return F.when(after < 0, F.floor(word / (size + 1))).otherwise(F.col("long_blocks") + F.floor(after / size))

    def start_of(block: Column) -> Column:
        return block * F.col("block_words") + F.least(block, F.col("long_blocks"))

    last = F.col("from_word") + F.col("size")
    blocks = F.sequence(block_of(F.col("from_word")), block_of(last - 1))
    cut = placed.withColumn("block", F.explode_outer(F.when(F.col("size") > 0, blocks)))
    inside = F.least(last, start_of(F.col("block") + 1)) - F.greatest(F.col("from_word"), start_of(F.col("block")))
    return cut.withColumn("words", F.coalesce(inside, F.lit(0)))


def mix_sources(docs: DataFrame) -> DataFrame:
    """Per row of ``docs(doc_id, text, source)``: ``size``, ``source_size``, ``target``, ``taken``.

    ``taken`` counts the words of the row in all blocks that the schedule plays, repeats
    included; a block is played once per pass and there are ``MAX_PASSES`` passes at most. A
    source's taken words differ from its target by half a block at most, and a block is a 64th of
    the target or less, if the source has as many words. Null texts have no words; the null source
    comes last; repeated rows are taken one by one; an empty table gives an empty result. Other
    columns are not used. Reruns agree.
    """
    spark = docs.sparkSession
    sizes = stored(spark, sized(docs), "mix-sizes")
    targets = stored(spark, source_blocks(source_targets(sizes)), "mix-targets")
    plays = schedule(targets).groupBy("sid", "block").agg(F.count("*").alias("plays"))
    plays = plays.select(F.col("sid").alias("__sid"), F.col("block").alias("__block"), "plays")
    cut = pieces(sequences(sizes, targets))
    taken = F.sum(F.col("words") * F.coalesce("plays", F.lit(0)))
    return (
        cut.join(plays, (F.col("sid") == F.col("__sid")) & (F.col("block") == F.col("__block")), "left")
        .groupBy("doc_id", "source", "size", "source_size", "target", "sid", "bucket", "row").agg(taken.alias("taken"))
        .drop("sid", "bucket", "row")
    )
