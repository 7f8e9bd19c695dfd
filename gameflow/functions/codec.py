"""JSON payloads and list columns as text."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from gameflow.functions.scalars import drop_nan_text
from gameflow.schema import MESSAGE_FIELDS, message_schema


def encode_payload(fields: Iterable[str] = MESSAGE_FIELDS) -> Column:
    """The row as UTF-8 JSON. Null fields are written, not left out."""
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"}).cast("binary")


def decode_payload(
    messages: DataFrame, fields: Iterable[str] = MESSAGE_FIELDS, carry: Iterable[str] = ()
) -> DataFrame:
    """Payload fields as columns; a payload that is no JSON object gives a row of NULLs.

    The struct is expanded with a generator rather than ``select("p.*")``: a filter
    on a decoded field cannot move below a generator, so each payload is parsed once
    instead of once for the filter and once for the projection. Ask for fewer
    ``fields`` when fewer are needed; a generator is not pruned by itself.
    """
    fields = list(fields)
    parsed = F.from_json(F.col("value").cast("string"), message_schema(fields))
    rows = messages.select(*carry, F.inline(F.array(parsed)))
    clean = [F.col(f) if f == "Moves" else drop_nan_text(F.col(f)).alias(f) for f in fields]
    return rows.select(*carry, *clean)


def list_to_text(items: Column) -> Column:
    return F.to_json(items)


def text_to_list(text: Column) -> Column:
    """Reads JSON arrays, and single-quoted lists such as ``['e2e4', 'e7e5']`` too."""
    return F.from_json(text, "array<string>", {"allowSingleQuotes": "true"})
