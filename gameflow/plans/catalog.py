"""Registered queries over the given tables, and the SQL that says what they must return.

Each query sends the whole table through the operator it is named after: text, CSV,
JSON and streams are really written and read back. The SQL works on the table directly.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gameflow.functions.codec import decode_payload, encode_payload
from gameflow.functions.scalars import chunk_name, dotted_date, rating
from gameflow.operators import decode, ranges
from gameflow.plans import standins
from gameflow.plans.ingest import first_games_of, games_between, ingest, load_table, numbered_games, replay, start_dumps
from gameflow.schema import TABLE_SCHEMA
from gameflow.session import scratch_folders, scratch_path
from gameflow.sinks.table import BucketedTable, ParquetTable
from gameflow.sources.csv_chunks import read_chunks, stream_chunks
from gameflow.sources.messages import encode_messages, file_topic
from gameflow.sources.pgn import read_corpus, read_games
from gameflow.streaming import jobs

Query = Callable[[SparkSession, str], DataFrame]
CHUNKS, TARGETS, BATCH_SIZE = standins.CHUNKS, 3, 500
FIRST_N, RANGE, CAP = 3000, (750, 1500), 4000

_queries: dict[str, Query] = {}
_oracle: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    def register(run: Query) -> Query:
        _queries[run.__name__] = run
        if sql is not None:
            _oracle[run.__name__] = sql
        return run

    return register


# The event game in stored form.
GAMES_SQL = """
SELECT event_id + 1 AS gameid, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S') AS "time",
       '-' AS round, CAST(user_id AS VARCHAR) AS white, 'b' || CAST(event_id AS VARCHAR) AS black,
       CASE WHEN event_type = 'click' THEN '180+0' ELSE '' END AS timecontrol, event_type AS result,
       CAST(1000 + user_id AS INTEGER) AS whiteelo, CAST(floor(value) AS INTEGER) AS blackelo,
       event_type || ' ' || json_extract_string(props, '$.k') AS moves,
       json_extract_string(props, '$.k') AS variant
FROM events
"""


# The two moves of an event's movetext.
MOVES_SQL = """'N' || chr(CAST(97 + length(event_type) % 8 AS INTEGER)) || '3 Q' || chr(97 + k % 8) || (k // 8 % 8 + 1) || '+'"""
EVENTS_K = "(SELECT *, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)"


# ---- scans -------------------------------------------------------------------


_SCAN_SQL = f"""
SELECT strftime(ts, '%Y.%m.%d') AS date_text, strftime(ts, '%H:%M:%S') AS time_text,
       CAST(user_id AS VARCHAR) AS white, 'b' || CAST(event_id AS VARCHAR) AS black,
       event_type AS result, CAST(1000 + user_id AS VARCHAR) AS whiteelo, {MOVES_SQL} AS moves
FROM {EVENTS_K}
"""


def _scan_columns(games: DataFrame) -> DataFrame:
    return games.select(
        F.col("Date").alias("date_text"), F.col("Time").alias("time_text"),
        F.col("White").alias("white"), F.col("Black").alias("black"), F.col("Result").alias("result"),
        F.col("WhiteElo").alias("whiteelo"), F.array_join("Moves", " ").alias("moves"),
    )


@query(_SCAN_SQL)
def pgn_scan(spark, sf_dir):
    return _scan_columns(read_games(spark, standins.pgn_files(spark, sf_dir)))


@query(_SCAN_SQL)
def pgn_scan_any_tag_order(spark, sf_dir):
    """Games that open with different tags, none with Event, and with tag-like lines in comments."""
    return _scan_columns(read_games(spark, standins.any_order_files(spark, sf_dir), opening=None))


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS period, event_type AS result, count(*) AS n_games,
       count(DISTINCT user_id) AS n_white
FROM events GROUP BY 1, 2
""")
def corpus_scan(spark, sf_dir):
    games = read_corpus(spark, standins.corpus_files(spark, sf_dir), period_pattern=r"day=(\d{4}-\d{2}-\d{2})")
    return games.groupBy("period", F.col("Result").alias("result")).agg(
        F.count("*").alias("n_games"), F.countDistinct("White").alias("n_white")
    )


# Small, since the given tables are: their archives then have several tasks too.
FRAME_BYTES = 4 << 10


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS period, event_type AS result, count(*) AS n_games,
       count(DISTINCT user_id) AS n_white
FROM events GROUP BY 1, 2
""")
def corpus_scan_frames(spark, sf_dir):
    games = read_corpus(spark, standins.frame_corpus_files(spark, sf_dir), period_pattern=r"day=(\d{4}-\d{2}-\d{2})", frame_bytes=FRAME_BYTES)
    return games.groupBy("period", F.col("Result").alias("result")).agg(
        F.count("*").alias("n_games"), F.countDistinct("White").alias("n_white")
    )


@query("""
SELECT 'b' || CAST(event_id AS VARCHAR) AS black, '-' AS round,
       CASE WHEN event_type = 'click' THEN '180+0' ELSE '' END AS timecontrol,
       json_extract_string(props, '$.k') AS variant
FROM events
""")
def pgn_headers_default(spark, sf_dir):
    games = read_games(spark, standins.pgn_files(spark, sf_dir))
    return games.select(*[F.col(c).alias(c.lower()) for c in ("Black", "Round", "TimeControl", "Variant")])


@query(r"""
WITH words AS (
  SELECT conv_id, turn, list_transform(regexp_extract_all(text, '[^ \n\t]+'), lambda w:
    chr(97 + ascii(w) % 8) || (length(w) % 8 + 1)) AS w FROM conversations
)
SELECT conv_id, turn, len(w) + 3 AS n_moves, 'e2e4 ' || list_aggregate(w, 'string_agg', ' ') || ' O-O-O 0000' AS moves
FROM words
""")
def pgn_moves(spark, sf_dir):
    games = read_games(spark, standins.conversation_files(spark, sf_dir))
    return games.select(
        F.col("White").cast("bigint").alias("conv_id"), F.col("Round").cast("bigint").alias("turn"),
        F.size("Moves").cast("bigint").alias("n_moves"), F.array_join("Moves", " ").alias("moves"),
    )


@query(GAMES_SQL)
def table_scan(spark, sf_dir):
    return _loaded_table(spark, sf_dir).latest(spark)


# ---- order, ranges, batches ----------------------------------------------------


@query("""
SELECT row_number() OVER (ORDER BY event_id) AS gameid, CAST(user_id AS VARCHAR) AS white,
       'b' || CAST(event_id AS VARCHAR) AS black
FROM events
""")
def game_ordinal(spark, sf_dir):
    games, _ = numbered_games(spark, standins.pgn_files(spark, sf_dir))
    return games.select(F.col("GameID").alias("gameid"), F.col("White").alias("white"), F.col("Black").alias("black"))


@query(f"""
SELECT * FROM (
  SELECT row_number() OVER (ORDER BY event_id) AS gameid, 'b' || CAST(event_id AS VARCHAR) AS black FROM events
) WHERE gameid <= {FIRST_N}
""")
def first_n_games(spark, sf_dir):
    games = first_games_of(spark, standins.pgn_files(spark, sf_dir), FIRST_N)
    return games.select(F.col("GameID").alias("gameid"), F.col("Black").alias("black"))


@query(f"""
SELECT * FROM (
  SELECT row_number() OVER (ORDER BY event_id) AS gameid, 'b' || CAST(event_id AS VARCHAR) AS black FROM events
) WHERE gameid - 1 >= {RANGE[0]} AND gameid - 1 < {RANGE[1]}
""")
def game_range_slice(spark, sf_dir):
    games = games_between(spark, standins.pgn_files(spark, sf_dir), *RANGE)
    return games.select(F.col("GameID").alias("gameid"), F.col("Black").alias("black"))


@query(f"""
SELECT * FROM (
  SELECT row_number() OVER (ORDER BY event_id) AS gameid, 'b' || CAST(event_id AS VARCHAR) AS black FROM events
) WHERE gameid - 1 >= {RANGE[0]} AND gameid - 1 < {RANGE[1]}
""")
def game_range_indexed(spark, sf_dir):
    files, index = standins.pgn_files(spark, sf_dir), scratch_path(spark, "game-index")
    games_between(spark, files, *RANGE, index=index)
    games = games_between(spark, files, *RANGE, index=index)  # counts nothing
    return games.select(F.col("GameID").alias("gameid"), F.col("Black").alias("black"))


@query(f"""
SELECT * FROM (
  SELECT row_number() OVER (ORDER BY event_id) AS gameid, 'b' || CAST(event_id AS VARCHAR) AS black FROM events
) WHERE gameid <= {FIRST_N}
""")
def first_n_any_order(spark, sf_dir):
    """The first games of files none of whose games opens with Event."""
    games = first_games_of(spark, standins.any_order_files(spark, sf_dir), FIRST_N, opening=None)
    return games.select(F.col("GameID").alias("gameid"), F.col("Black").alias("black"))


@query(f"""
SELECT * FROM (
  SELECT row_number() OVER (ORDER BY event_id) AS gameid, 'b' || CAST(event_id AS VARCHAR) AS black FROM events
) WHERE gameid - 1 >= {RANGE[0]} AND gameid - 1 < {RANGE[1]}
""")
def range_any_order(spark, sf_dir):
    games = games_between(spark, standins.any_order_files(spark, sf_dir), *RANGE, opening=None)
    return games.select(F.col("GameID").alias("gameid"), F.col("Black").alias("black"))


_RANGES_SQL = f"""
SELECT i AS chunk, i * (n // {CHUNKS}) + least(i, n % {CHUNKS}) AS range_start,
       (i + 1) * (n // {CHUNKS}) + least(i + 1, n % {CHUNKS}) AS range_end
FROM (SELECT count(*) AS n FROM events), (SELECT unnest(range({CHUNKS})) AS i)
"""


@query(f"""
SELECT *, 'games_' || CAST(range_start AS VARCHAR) || '_' || CAST(range_end AS VARCHAR) AS name
FROM ({_RANGES_SQL})
""")
def balanced_ranges(spark, sf_dir):
    bounds = ranges.game_ranges(spark, ranges.game_count(standins.events(spark, sf_dir)), CHUNKS)
    return bounds.withColumn("name", chunk_name(F.col("range_start"), F.col("range_end")))


@query(f"""
WITH r AS ({_RANGES_SQL})
SELECT event_id + 1 AS gameid, chunk FROM events JOIN r ON event_id >= range_start AND event_id < range_end
""")
def chunk_assign(spark, sf_dir):
    return standins.chunked_games(spark, sf_dir).select(F.col("GameID").alias("gameid"), "chunk")


@query(f"""
WITH r AS ({_RANGES_SQL})
SELECT event_id + 1 AS gameid, chunk % {TARGETS} AS target
FROM events JOIN r ON event_id >= range_start AND event_id < range_end
""")
def round_robin_target(spark, sf_dir):
    games = ranges.round_robin_target(standins.chunked_games(spark, sf_dir), TARGETS)
    return games.select(F.col("GameID").alias("gameid"), "target")


@query(f"""
WITH r AS ({_RANGES_SQL})
SELECT chunk, (event_id - range_start) // {BATCH_SIZE} AS batch, count(*) AS n_rows
FROM events JOIN r ON event_id >= range_start AND event_id < range_end GROUP BY 1, 2
""")
def row_batches(spark, sf_dir):
    return ranges.batch_sizes(ranges.assign_batch(standins.chunked_games(spark, sf_dir), BATCH_SIZE))


@query(f"""
SELECT event_id + 1 AS gameid, event_type AS result FROM events
WHERE event_id < least({CAP}, (SELECT count(*) FROM events))
""")
def capped_emit(spark, sf_dir):
    capped = ranges.first_games(standins.games(spark, sf_dir), CAP)
    sent = _sent(spark, encode_messages(capped))
    return decode.select_games(sent, fields=["GameID", "Result"]).select(F.col("gameid").cast("bigint"), "result")


# ---- CSV and JSON ----------------------------------------------------------------


@query(f"""
WITH r AS ({_RANGES_SQL})
SELECT event_id + 1 AS gameid, chunk, CASE WHEN event_type = 'click' THEN '180+0' ELSE '' END AS timecontrol,
       event_type || ' ' || json_extract_string(props, '$.k') AS moves, 2 AS n_moves
FROM events JOIN r ON event_id >= range_start AND event_id < range_end
""")
def csv_chunk_roundtrip(spark, sf_dir):
    return read_chunks(spark, standins.chunk_files(spark, sf_dir)).select(
        F.col("GameID").cast("bigint").alias("gameid"), "chunk", F.col("TimeControl").alias("timecontrol"),
        F.array_join("Moves", " ").alias("moves"), F.size("Moves").alias("n_moves"),
    )


def _sent(spark: SparkSession, messages: DataFrame) -> DataFrame:
    """The messages after they went through a topic."""
    topic = file_topic(scratch_path(spark, "sent"))
    topic.write(messages)
    return topic.read(spark)


@query("""
SELECT CAST(event_id + 1 AS VARCHAR) AS "GameID", strftime(ts, '%Y.%m.%d') AS "Date", event_type AS "Result",
       CAST(NULL AS VARCHAR) AS "Variant"
FROM events
""")
def emit_messages(spark, sf_dir):
    games = standins.games(spark, sf_dir).withColumn("Variant", F.lit(None).cast("string"))
    return decode_payload(_sent(spark, encode_messages(games)), ["GameID", "Date", "Result", "Variant"])


@query("SELECT doc_id, text, lang FROM documents")
def emit_text_messages(spark, sf_dir):
    """Long and non-ASCII texts through the message codec, unchanged."""
    documents = spark.read.parquet(f"{sf_dir}/documents.parquet").select(
        F.col("doc_id").alias("GameID"), F.col("text").alias("White"), F.col("lang").alias("Black")
    )
    fields = ["GameID", "White", "Black"]
    messages = documents.select(encode_payload(fields).alias("value"), F.col("GameID").alias("offset"))
    return decode_payload(_sent(spark, messages), fields).select(
        F.col("GameID").cast("bigint").alias("doc_id"), F.col("White").alias("text"), F.col("Black").alias("lang")
    )


@query("""
SELECT CAST(event_id + 1 AS VARCHAR) AS gameid, strftime(ts, '%Y.%m.%d') AS date_text,
       CAST(user_id AS VARCHAR) AS white, 2 AS n_moves, json_extract_string(props, '$.k') AS variant
FROM events
""")
def json_decode(spark, sf_dir):
    messages = standins.message_topic(spark, sf_dir).read(spark)
    return decode_payload(messages, ["GameID", "Date", "White", "Moves", "Variant"]).select(
        F.col("GameID").alias("gameid"), F.col("Date").alias("date_text"), F.col("White").alias("white"),
        F.size("Moves").alias("n_moves"), F.col("Variant").alias("variant"),
    )


@query("""
SELECT event_id,
       CASE event_type WHEN 'view' THEN CAST(event_id AS VARCHAR) WHEN 'click' THEN CAST(event_id AS VARCHAR)
                       WHEN 'signup' THEN 'x' || CAST(event_id AS VARCHAR) END AS gameid,
       CASE WHEN event_type = 'click' THEN CAST(1000 + user_id AS INTEGER) END AS whiteelo,
       CASE WHEN event_type = 'view' THEN 2 END AS n_moves, CAST(NULL AS VARCHAR) AS round
FROM events
""")
def json_decode_permissive(spark, sf_dir):
    """By event type: well formed; NaN, float rating and moves as text; extra field; wrong case; no JSON."""
    payload = (
        F.when(F.col("event_type") == "view",
               F.format_string('{"GameID":%d,"Moves":["e4","e5"]}', "event_id"))
        .when(F.col("event_type") == "click",
              F.format_string('{"GameID":%d,"WhiteElo":%d.0,"Round":NaN,"Moves":"[\'e4\']"}',
                              "event_id", F.col("user_id") + 1000))
        .when(F.col("event_type") == "signup", F.format_string('{"GameID":"x%d","Extra":1}', "event_id"))
        .when(F.col("event_type") == "purchase", F.format_string('{"gameid":%d}', "event_id"))
        .otherwise(F.concat(F.lit("not json "), F.col("props")))
    )
    messages = standins.events(spark, sf_dir).select("event_id", payload.alias("value"))
    rows = decode_payload(messages, ["GameID", "Round", "WhiteElo", "Moves"], carry=["event_id"])
    return rows.select(
        "event_id", F.col("GameID").alias("gameid"), rating(F.col("WhiteElo")).alias("whiteelo"),
        F.when(F.col("Moves").isNotNull(), F.size("Moves")).alias("n_moves"), F.col("Round").alias("round"),
    )


@query("""
SELECT event_id + 1 AS gameid, CASE WHEN event_type <> 'signup' THEN CAST(ts AS DATE) END AS date FROM events
""")
def date_normalise(spark, sf_dir):
    date = F.when(F.col("event_type") == "signup", "????.??.??").otherwise(F.col("Date"))
    games = standins.games(spark, sf_dir, "event_type")
    return games.select(F.col("GameID").alias("gameid"), dotted_date(date).alias("date"))


@query("SELECT CAST(event_id + 1 AS VARCHAR) AS gameid, event_type AS result FROM events WHERE event_type <> 'error'")
def filter_key_not_null(spark, sf_dir):
    """Payloads of error events are cut in half, so that they are no JSON."""
    text = F.col("value").cast("string")
    half = F.substring(text, F.lit(1), F.call_function("div", F.length(text), F.lit(2)))
    messages = standins.message_topic(spark, sf_dir).read(spark).select(
        F.when(F.contains(text, F.lit('"Result":"error"')), half).otherwise(text).alias("value")
    )
    return decode.select_games(messages).select("gameid", "result")


@query(GAMES_SQL)
def select_rename(spark, sf_dir):
    messages = standins.message_topic(spark, sf_dir).read(spark)
    return decode.to_table_types(decode.select_games(messages))


@query("""
SELECT event_id + 1 AS gameid, CASE WHEN event_type <> 'view' THEN CAST(1000 + user_id AS INTEGER) END AS whiteelo,
       event_type || ' ' || json_extract_string(props, '$.k') AS moves
FROM events
""")
def sink_typed_cast(spark, sf_dir):
    games = standins.games(spark, sf_dir).withColumn(
        "WhiteElo", F.when(F.col("Result") == "view", "?").otherwise(F.concat("WhiteElo", F.lit(".0")))
    )
    sent = _sent(spark, encode_messages(games))
    return decode.to_table_types(decode.select_games(sent, fields=["GameID", "WhiteElo", "Moves"])).select(
        "gameid", "whiteelo", "moves")


# ---- table -----------------------------------------------------------------------


def _loaded_table(spark, sf_dir) -> ParquetTable:
    """The message topic loaded into a keyed table by a stream, once per session."""

    def write(path: str) -> None:
        with scratch_folders(spark, "checkpoint") as [checkpoint]:
            load_table(spark, standins.message_topic(spark, sf_dir), ParquetTable(path), checkpoint)

    return ParquetTable(standins.land_once(spark, sf_dir, "table", write))


@query("SELECT count(*) AS n FROM events")
def table_count(spark, sf_dir):
    return _loaded_table(spark, sf_dir).count(spark)


@query(GAMES_SQL)
def table_create_idempotent(spark, sf_dir):
    """The table is created, loaded, and created again, which keeps its rows."""
    table = ParquetTable(scratch_path(spark, "created"))
    table.create(spark)
    with scratch_folders(spark, "checkpoint") as [checkpoint]:
        load_table(spark, standins.message_topic(spark, sf_dir), table, checkpoint)
    table.create(spark)
    return table.latest(spark)


@query("""
SELECT user_id AS gameid, max(event_id) AS last_event, arg_max(event_type, event_id) AS result
FROM events GROUP BY 1
""")
def keyed_upsert_latest(spark, sf_dir):
    """One game per user: earlier events in a first run, later ones after a restart."""
    keyed = standins.spread(standins.games(spark, sf_dir, "event_id", "ts")).withColumns(
        {"GameID": F.col("White").cast("bigint"), "Variant": F.col("event_id").cast("string")}
    )
    late = F.col("ts") >= F.lit("2024-01-16").cast("timestamp_ntz")
    table = ParquetTable(scratch_path(spark, "keyed-table"))
    with scratch_folders(spark, "keyed-topic", "checkpoint") as [messages, checkpoint]:
        topic = file_topic(messages)
        for wave in (~late, late):
            topic.write(encode_messages(keyed.filter(wave), offset="event_id"))
            load_table(spark, topic, table, checkpoint)
    return table.latest(spark).select("gameid", F.col("variant").cast("bigint").alias("last_event"), "result")


@query("""
SELECT event_id + 1 AS gameid, CASE WHEN event_type = 'click' THEN 'changed' ELSE event_type END AS result FROM events
""")
def keyed_upsert_same_batch(spark, sf_dir):
    """All games, then the clicked ones again with another result, stored by one load."""
    games = standins.games(spark, sf_dir)
    table = ParquetTable(scratch_path(spark, "same-batch"))
    with scratch_folders(spark, "topic", "checkpoint") as [messages, checkpoint]:
        topic = file_topic(messages)
        topic.write(encode_messages(games))
        topic.write(encode_messages(games.filter("Result = 'click'").withColumn("Result", F.lit("changed"))))
        load_table(spark, topic, table, checkpoint)
    return table.latest(spark).select("gameid", "result")


@query(GAMES_SQL)
def bucketed_table_latest(spark, sf_dir):
    """The table in buckets, loaded by a stream and rewritten with one version per key."""
    table = BucketedTable(scratch_path(spark, "bucketed"), CHUNKS)
    with scratch_folders(spark, "checkpoint") as [checkpoint]:
        load_table(spark, standins.message_topic(spark, sf_dir), table, checkpoint)
    return table.compact(spark, scratch_path(spark, "bucketed-compact")).latest(spark)


@query("""
WITH last AS (SELECT user_id AS gameid, arg_max(event_id, (ts, event_id)) AS last_event FROM events GROUP BY 1)
SELECT gameid, last_event, 1 AS n_written FROM last
""")
def stream_latest_changes(spark, sf_dir):
    """One game per user. The later half of the events comes first, then the earlier half, then all
    again: only users that the later half does not have are written by the second load, and none
    by the third."""
    keyed = standins.spread(standins.games(spark, sf_dir, "event_id", "ts")).withColumn("GameID", F.col("White").cast("bigint"))
    keyed = keyed.withColumn("Variant", F.col("event_id").cast("string"))
    sent = keyed.select(encode_payload().alias("value"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
                        F.col("ts").cast("timestamp").alias("timestamp"))
    late = F.col("timestamp") >= F.lit("2024-01-16").cast("timestamp")
    table = ParquetTable(scratch_path(spark, "changes"))
    with scratch_folders(spark, "changes-topic", "checkpoint") as [messages, checkpoint]:
        topic = file_topic(messages)
        for wave in (late, ~late, F.lit(True)):
            sent.filter(wave).write.mode("append").parquet(messages)
            jobs.start_changes(topic.read_stream(spark), table, checkpoint, jobs.AVAILABLE_NOW).awaitTermination()
    written = table.versions(spark).groupBy("gameid").agg(F.count("*").cast("int").alias("n_written"))
    latest = table.latest(spark).select(F.col("gameid"), F.col("variant").cast("bigint").alias("last_event"))
    return latest.join(written, "gameid").select("gameid", "last_event", "n_written")


# ---- streams -----------------------------------------------------------------------


def _files_per_trigger(landed: DataFrame, batches: int) -> str:
    """A file group size that cuts a folder into about this many batches, however large it is."""
    return str(max(1, -(-len(landed.inputFiles()) // batches)))


@query(GAMES_SQL)
def stream_game_select(spark, sf_dir):
    out, stream = scratch_path(spark, "selected"), standins.message_topic(spark, sf_dir).read_stream(spark)
    with scratch_folders(spark, "checkpoint") as [checkpoint]:
        jobs.start_selection(stream, out, checkpoint, jobs.AVAILABLE_NOW).awaitTermination()
    return spark.read.schema(TABLE_SCHEMA).parquet(out)


@query(GAMES_SQL)
def stream_resume(spark, sf_dir):
    """A stream stopped between two arrivals and started again on its checkpoint."""
    games = standins.spread(standins.games(spark, sf_dir))
    out, clicked = scratch_path(spark, "resumed"), F.col("Result") == "click"
    with scratch_folders(spark, "resume-topic", "checkpoint") as [messages, checkpoint]:
        topic = file_topic(messages)
        for wave in (clicked, ~clicked):
            topic.write(encode_messages(games.filter(wave)))
            jobs.start_selection(topic.read_stream(spark), out, checkpoint, jobs.AVAILABLE_NOW).awaitTermination()
    return spark.read.schema(TABLE_SCHEMA).parquet(out)


@query("SELECT count(*) AS n, count(*) AS n_keyed FROM events")
def stream_message_count(spark, sf_dir):
    out, stream = scratch_path(spark, "count"), standins.message_topic(spark, sf_dir).read_stream(spark)
    with scratch_folders(spark, "checkpoint") as [checkpoint]:
        jobs.start_count(stream, out, checkpoint, jobs.AVAILABLE_NOW).awaitTermination()
    return spark.read.parquet(out)


@query(GAMES_SQL)
def stream_throttled(spark, sf_dir):
    """A few file groups with a pause between them."""
    source, out = standins.message_topic(spark, sf_dir).read_options["path"], scratch_path(spark, "throttled")
    topic = file_topic(source, maxFilesPerTrigger=_files_per_trigger(spark.read.parquet(source), 3))
    with scratch_folders(spark, "checkpoint") as [checkpoint]:
        running = jobs.start_selection(topic.read_stream(spark), out, checkpoint, {"processingTime": "1 second"})
        running.processAllAvailable()
        running.stop()
    return spark.read.schema(TABLE_SCHEMA).parquet(out)


@query(GAMES_SQL)
def dead_letter_replay(spark, sf_dir):
    """Two batches are refused and saved, the rest is sent; after the replay all games are there once."""
    landing = standins.chunk_files(spark, sf_dir)
    size = _files_per_trigger(read_chunks(spark, landing), 5)
    table = ParquetTable(scratch_path(spark, "replayed"))
    with scratch_folders(spark, "sent", "letters", "sending", "loading") as [sent, letters, sending, loading]:
        topic = file_topic(sent)
        refusing = standins.RefusingTopic(topic, {1, 3})
        source = stream_chunks(spark, landing, maxFilesPerTrigger=size)
        jobs.start_delivery(source, refusing, letters, sending, jobs.AVAILABLE_NOW).awaitTermination()
        replay(spark, letters, topic)
        load_table(spark, topic, table, loading)
    return table.latest(spark)


@query(f"SELECT g.*, (SELECT count(*) FROM events) AS n_messages FROM ({GAMES_SQL}) g")
def dead_letter_stream_replay(spark, sf_dir):
    """Two batches are refused; a stream sends their letters, is started again and sends nothing more."""
    landing = standins.chunk_files(spark, sf_dir)
    size = _files_per_trigger(read_chunks(spark, landing), 5)
    table = ParquetTable(scratch_path(spark, "stream-replayed"))
    names = ("sent", "letters", "archive", "rejects", "sending", "replaying", "loading")
    with scratch_folders(spark, *names) as [sent, letters, archive, rejects, sending, replaying, loading]:
        topic = file_topic(sent)
        source = stream_chunks(spark, landing, maxFilesPerTrigger=size)
        jobs.start_delivery(source, standins.RefusingTopic(topic, {1, 3}), letters, sending, jobs.AVAILABLE_NOW).awaitTermination()
        for _ in range(2):
            jobs.start_replay(spark, letters, topic, replaying, archive, rejects, jobs.AVAILABLE_NOW).awaitTermination()
        n_messages = topic.read(spark).count()
        load_table(spark, topic, table, loading)
    return table.latest(spark).withColumn("n_messages", F.lit(n_messages))


@query(GAMES_SQL)
def stream_new_dumps(spark, sf_dir):
    """Two dumps dropped one after the other, ingested by a stream that numbers on."""
    table = ParquetTable(scratch_path(spark, "dumps-table"))
    names = ("dumps", "sent", "letters", "ledger", "taking", "loading")
    with scratch_folders(spark, *names) as [dumps, sent, letters, ledger, taking, loading]:
        topic = file_topic(sent)
        for number, upper in enumerate((False, True)):
            standins.dump_files(spark, sf_dir, f"{dumps}/{number}", upper)
            start_dumps(spark, dumps, topic, letters, ledger, taking, jobs.AVAILABLE_NOW, chunks=2).awaitTermination()
        load_table(spark, topic, table, loading)
    return table.latest(spark).withColumn("moves", F.concat_ws(" ", "result", "variant"))


@query("""
SELECT event_id + 1 AS gameid, event_type || ' ' || json_extract_string(props, '$.k') AS moves,
       CASE WHEN event_type = 'click' THEN '180+0' ELSE '' END AS timecontrol
FROM events
""")
def dead_letter_text_moves(spark, sf_dir):
    """Letters of another writer, whose moves are a list as text, next to a damaged letter."""
    table = ParquetTable(scratch_path(spark, "text-letters"))
    with scratch_folders(spark, "sent", "letters", "loading") as [sent, letters, loading]:
        games = standins.games(spark, sf_dir)
        as_text = F.concat(F.lit("['"), F.array_join("Moves", "', '"), F.lit("']"))
        games.withColumn("Moves", as_text).write.json(f"{letters}/failed_df_other.json")
        half = games.select(F.substring(F.to_json(F.struct("GameID", "Moves")), 1, 12).alias("value"))
        half.write.text(f"{letters}/failed_batch_damaged.json")
        topic = file_topic(sent)
        result = replay(spark, letters, topic)
        if result.sent != 1 or len(result.damaged) != 1:
            raise RuntimeError(f"one of two letters should be damaged: {result}")
        load_table(spark, topic, table, loading)
    return table.latest(spark).select("gameid", "moves", "timecontrol")


@query(f"""
SELECT event_id + 1 AS gameid, CAST(ts AS DATE) AS date, strftime(ts, '%H:%M:%S') AS "time",
       '-' AS round, CAST(user_id AS VARCHAR) AS white, 'b' || CAST(event_id AS VARCHAR) AS black,
       CASE WHEN event_type = 'click' THEN '180+0' ELSE '' END AS timecontrol, event_type AS result,
       CAST(1000 + user_id AS INTEGER) AS whiteelo, CAST(floor(value) AS INTEGER) AS blackelo,
       CAST(k AS VARCHAR) AS variant, {MOVES_SQL} AS moves, 2 AS n_letters
FROM {EVENTS_K}
""")
def chunk_ingest(spark, sf_dir):
    """PGN files to the table: scan, number, CSV chunks, a send of which two chunks are refused,
    replay of their letters, upsert."""
    table = ParquetTable(scratch_path(spark, "pipeline"))
    with scratch_folders(spark, "sent", "letters", "landing", "loading") as [sent, letters, landing, loading]:
        topic = file_topic(sent)
        refusing = standins.RefusingTopic(topic, {2, 5})
        ingest(spark, standins.pgn_files(spark, sf_dir), refusing, letters, chunks=CHUNKS, landing=landing)
        replayed = replay(spark, letters, topic)
        load_table(spark, topic, table, loading)
    return table.latest(spark).withColumn("n_letters", F.lit(replayed.sent))


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as messages, decoded and typed."""
    return decode.to_table_types(decode.select_games(encode_messages(standins.games(spark, sf_dir))))


def queries() -> dict[str, Query]:
    return dict(_queries)


def oracle_sql() -> dict[str, str]:
    return dict(_oracle)
