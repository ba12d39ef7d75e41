"""Wire format of the order feed: one text line = a JSON array of orders."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import WIRE_SCHEMA


def parse_wire(value: Column | str = "value", schema=WIRE_SCHEMA) -> Column:
    """JSON text -> ARRAY<STRUCT>; null for malformed, blank or null lines.

    A single object is read as a one-element array, a field of the wrong type is
    null while its record is kept, unknown fields are ignored.
    """
    v = F.col(value) if isinstance(value, str) else value
    return F.from_json(v, schema)


def wire_text(records: Column | str) -> Column:
    """ARRAY<STRUCT> -> JSON text (one wire line)."""
    r = F.col(records) if isinstance(records, str) else records
    return F.to_json(r)
