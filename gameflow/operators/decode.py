"""From message envelope to typed game rows. The same functions serve batch and stream."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gameflow.functions.codec import decode_payload
from gameflow.functions.scalars import dotted_date, game_key, rating
from gameflow.schema import GAME_COLUMNS, MESSAGE_FIELDS


def rename_fields(
    payloads: DataFrame, carry: Iterable[str] = (), fields: Iterable[str] = MESSAGE_FIELDS
) -> DataFrame:
    """The fields under lower-case names, the date as a date."""
    columns = [
        dotted_date(F.col("Date")).alias("date") if field == "Date" else F.col(field).alias(field.lower())
        for field in fields
    ]
    return payloads.select(*carry, *columns)


def drop_keyless(games: DataFrame) -> DataFrame:
    return games.filter(F.col("gameid").isNotNull())


def select_games(
    messages: DataFrame, carry: Iterable[str] = (), fields: Iterable[str] = MESSAGE_FIELDS
) -> DataFrame:
    """Decode, rename and keep the games that have a key. Name the ``fields`` (``GameID`` among
    them) if not all are needed; only those are parsed."""
    carry, fields = list(carry), list(fields)
    return drop_keyless(rename_fields(decode_payload(messages, fields, carry), carry, fields))


def to_table_types(games: DataFrame, carry: Iterable[str] = ()) -> DataFrame:
    """Stored types: numeric key and ratings, moves as one text.

    A key that is no number becomes NULL here; such rows are not storable.
    """
    typed = {
        "gameid": game_key(F.col("gameid")),
        "whiteelo": rating(F.col("whiteelo")),
        "blackelo": rating(F.col("blackelo")),
        "moves": F.array_join("moves", " "),
    }
    return games.select(*carry, *[typed.get(c, F.col(c)).alias(c) for c in GAME_COLUMNS if c in games.columns])
