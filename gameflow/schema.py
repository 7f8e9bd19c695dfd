"""Column names and types of a game in each of its forms."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import types as T

# The message fields in order, and the PGN tag each one is read from.
MESSAGE_FIELDS = (
    "GameID", "Date", "Time", "Round", "White", "Black",
    "TimeControl", "Result", "WhiteElo", "BlackElo", "Moves", "Variant",
)
FIELD_TAGS = {
    "Date": "Date",
    "Time": "UTCTime",
    "Round": "Round",
    "White": "White",
    "Black": "Black",
    "TimeControl": "TimeControl",
    "Result": "Result",
    "WhiteElo": "WhiteElo",
    "BlackElo": "BlackElo",
    "Variant": "Variant",
}
# What the PGN standard writes for a seven-tag-roster tag nobody filled in.
ROSTER_DEFAULTS = {"Date": "????.??.??", "Round": "?", "White": "?", "Black": "?", "Result": "*"}

GAME_COLUMNS = tuple(field.lower() for field in MESSAGE_FIELDS)


def message_schema(fields: Iterable[str] = MESSAGE_FIELDS) -> T.StructType:
    """Payload schema: every field is text except the move list."""
    return T.StructType([
        T.StructField(f, T.ArrayType(T.StringType()) if f == "Moves" else T.StringType())
        for f in fields
    ])


# Stored form. The key is 64-bit: 2^31 games is less than a 100 TB corpus holds.
TABLE_SCHEMA = T.StructType([
    T.StructField("gameid", T.LongType()),
    T.StructField("date", T.DateType()),
    T.StructField("time", T.StringType()),
    T.StructField("round", T.StringType()),
    T.StructField("white", T.StringType()),
    T.StructField("black", T.StringType()),
    T.StructField("timecontrol", T.StringType()),
    T.StructField("result", T.StringType()),
    T.StructField("whiteelo", T.IntegerType()),
    T.StructField("blackelo", T.IntegerType()),
    T.StructField("moves", T.StringType()),
    T.StructField("variant", T.StringType()),
])

# What a topic gives per message, as a Kafka source names it: the payload, its place and the time
# of sending.
TOPIC_SCHEMA = T.StructType([
    T.StructField("value", T.BinaryType()),
    T.StructField("partition", T.IntegerType()),
    T.StructField("offset", T.LongType()),
    T.StructField("timestamp", T.TimestampType()),
])
TOPIC_COLUMNS = tuple(TOPIC_SCHEMA.names)
# Later writes win: by time of sending, then place in the topic.
SENT_ORDER = ("timestamp", "offset", "partition")
