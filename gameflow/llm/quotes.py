"""Conversations without quotes: quoted passages linked to the messages they come from.

Only DataFrame functions. A message's lines are parsed into quote depth and content; each line's
normalised content is hashed. A quoted line comes from the latest earlier message of the same
conversation that wrote it as its own. A running maximum over the writers of a line finds it, so
a line that many messages write and quote makes no pairs. A message replies to the one that most
of its outermost quoted lines come from. Depths and threads follow by pointer doubling.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from gameflow.llm.store import stored

#: Quote marks at the start of a line: ">", "> >", ">>", also indented.
MARKS = r"^[ \t]*(?:>[ \t]?)+"
#: A line that introduces a quote ("On ..., ... wrote:") where a quoted line follows it.
ATTRIBUTION = r"(?i)^[ \t]*on\b.*\bwrote:[ \t\r]*$"
KEY = ["conv_id", "turn"]


def parsed_lines(text: Column) -> Column:
    """Array of ``depth`` and ``content`` by line; null text has none."""
    lines = F.split(F.coalesce(text.cast("string"), F.lit("")), "\n", -1)
    return F.transform(lines, lambda line: F.struct(
        F.length(F.regexp_replace(F.regexp_extract(line, MARKS, 0), "[^>]", "")).alias("depth"),
        F.regexp_replace(line, MARKS, "").alias("content"),
    ))


def own_text(lines: Column) -> Column:
    """The lines of depth 0 without attributions and without blank lines at either end."""
    kept = F.filter(lines, lambda line, i: (line["depth"] == 0) & ~(
        F.regexp_like(line["content"], F.lit(ATTRIBUTION)) & (F.coalesce(F.get(lines, i + 1)["depth"], F.lit(0)) > 0)
    ))
    joined = F.array_join(F.transform(kept, lambda line: line["content"]), "\n")
    return F.regexp_replace(joined, r"\A(?:[ \t\r]*\n)+|(?:\n[ \t\r]*)+\z", "")


def normalised(content: Column) -> Column:
    return F.lower(F.trim(F.regexp_replace(content, r"[ \t\r\x0b\f]+", " ")))


def _on(left: DataFrame, right: DataFrame, *pairs: tuple[str, str]) -> Column:
    match = F.lit(True)
    for a, b in pairs:
        match = match & (left[a] == right[b])
    return match


def reply_links(messages: DataFrame) -> DataFrame:
    """``conv_id``, ``turn`` and ``reply_to`` of the messages of which a quote was found.

    ``messages`` has ``lines`` as :func:`parsed_lines` gives them.
    """
    lines = messages.select(*KEY, F.explode("lines").alias("line")).select(
        *KEY, F.col("line.depth").alias("depth"), normalised(F.col("line.content")).alias("content")
    ).where("content <> ''")
    # Equal lines of one message count once as written, and by number as quoted.
    hashed = lines.groupBy(*KEY, F.xxhash64("content").alias("h1"), F.hash("content").alias("h2"), "depth").agg(F.count("*").alias("n"))
    writer = F.when(F.col("depth") == 0, F.col("turn"))
    earlier = Window.partitionBy("conv_id", "h1", "h2").orderBy("turn").rangeBetween(Window.unboundedPreceding, -1)
    origin = hashed.withColumn("origin", F.max(writer).over(earlier)).where("depth > 0 and origin is not null")
    votes = origin.groupBy(*KEY, "depth", "origin").agg(F.sum("n").alias("votes"))
    best = F.max(F.struct(-F.col("depth"), "votes", "origin"))
    return votes.groupBy(*KEY).agg(best.alias("best")).select(*KEY, F.col("best.origin").alias("reply_to"))


def threads(links: DataFrame) -> DataFrame:
    """``conv_id``, ``turn``, ``thread`` (the first message of the chain of replies) and ``level``
    (replies from it) of all messages in ``links(conv_id, turn, reply_to)``.

    Each round doubles how far up a message points. Messages that reach a first message drop out
    of the next round's lookup, so a message that everyone replies to is no hot key.
    """
    spark = links.sparkSession
    roots = links.select("conv_id", F.col("reply_to").alias("turn")).distinct().join(links.select(*KEY), KEY, "left_anti")
    state = links.select(*KEY, F.col("reply_to").alias("up"), F.lit(1).alias("level"))
    top = roots.select(F.col("conv_id").alias("__conv"), F.col("turn").alias("__turn"), F.lit(True).alias("is_top"))
    state = stored(spark, state.join(top, _on(state, top, ("conv_id", "__conv"), ("up", "__turn")), "left").select(
        *KEY, "up", "level", F.coalesce("is_top", F.lit(False)).alias("done")), "threads")
    while not state.where(~F.col("done")).isEmpty():
        going, done = state.where(~F.col("done")), state.where("done")
        ahead = state.select(F.col("conv_id").alias("__conv"), F.col("turn").alias("__turn"), F.col("up").alias("next"),
                             F.col("level").alias("more"), F.col("done").alias("there"))
        moved = going.join(ahead, _on(going, ahead, ("conv_id", "__conv"), ("up", "__turn"))).select(
            *KEY, F.col("next").alias("up"), (F.col("level") + F.col("more")).alias("level"), F.col("there").alias("done"))
        state = stored(spark, done.union(moved), "threads")
    return state.select(*KEY, F.col("up").alias("thread"), "level")


def link_quotes(messages: DataFrame) -> DataFrame:
    """Messages ``(conv_id, turn, role, text)`` without quotes, with their place in the conversation.

    Per row: ``reply_to`` (turn of the quoted message, null if none was found), ``thread``,
    ``level``, ``quote_depth`` (deepest quote) and ``text`` (own lines only). Ordered by thread,
    level and turn, every message follows the one it replies to. Votes for the source of a quote
    go by outermost depth, then by number of lines, then to the latest message. Null and empty
    texts quote nothing and have the empty text. Rows with null conv_id or turn link to nothing
    and are threads of their own (null). Rows that share conv_id and turn are taken for one message
    when linking and returned one by one. An empty table gives an empty result. Other columns are
    not used.
    """
    spark = messages.sparkSession
    parsed = messages.select(F.col("conv_id"), F.col("turn").cast("long"), F.col("role"), parsed_lines(F.col("text")).alias("lines"))
    links = stored(spark, reply_links(parsed.where("conv_id is not null and turn is not null")), "reply-links")
    placed = threads(links)
    near = links.select(F.col("conv_id").alias("__conv"), F.col("turn").alias("__turn"), "reply_to").join(
        placed.select("conv_id", "turn", "thread", "level"),
        (F.col("__conv") == F.col("conv_id")) & (F.col("__turn") == F.col("turn")),
    ).select("__conv", "__turn", "reply_to", "thread", "level")
    deepest = F.array_max(F.transform("lines", lambda line: line["depth"]))
    return parsed.join(near, _on(parsed, near, ("conv_id", "__conv"), ("turn", "__turn")), "left").select(
        *KEY, "role", "reply_to", F.coalesce("thread", "turn").alias("thread"), F.coalesce("level", F.lit(0)).alias("level"),
        deepest.alias("quote_depth"), own_text(F.col("lines")).alias("text"),
    )


def quoted(text: Column) -> Column:
    """A text with a quote mark before each line; null stays null."""
    return F.concat(F.lit("> "), F.replace(text, F.lit("\n"), F.lit("\n> ")))


def as_mail(conversations: DataFrame) -> DataFrame:
    """Conversations as an exchange of mails that quote: each turn below the turn before it, which
    itself stands below the quoted turn before that one."""
    turns = conversations.select("conv_id", F.col("turn").cast("long"), "role", F.col("text").cast("string"))

    def before(k: int) -> DataFrame:
        return turns.groupBy(F.col("conv_id").alias(f"__conv{k}"), (F.col("turn") + k).alias(f"__turn{k}")).agg(F.max("text").alias(f"before{k}"))

    one, two = before(1), before(2)
    joined = turns.join(one, _on(turns, one, ("conv_id", "__conv1"), ("turn", "__turn1")), "left")
    joined = joined.join(two, (F.col("conv_id") == F.col("__conv2")) & (F.col("turn") == F.col("__turn2")), "left")
    intro = F.when(F.col("before1").isNotNull(), F.concat(F.lit("On turn "), F.col("turn") - 1, F.lit(" someone wrote:")))
    return joined.select("conv_id", "turn", "role", F.concat_ws(
        "\n", intro, quoted(quoted(F.col("before2"))), quoted(F.col("before1")), F.col("text")).alias("text"))
