"""Event-time parsing and calendar parts.

ANSI mode is on by default in Spark 4, where ``to_timestamp`` raises on a bad
text; the feed is untrusted, so every parse here is the null-tolerant
``try_to_timestamp``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import EVENT_TIME_FORMAT, PARTITION_DATE_FORMAT


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_event_time(text: Column | str, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """wire text -> TIMESTAMP; null for a text that does not match ``fmt``."""
    return F.try_to_timestamp(_col(text), F.lit(fmt))


def time_parts(ts: Column | str = "event_date") -> dict[str, Column]:
    """F2–F8: ``partition_date`` text and six INT calendar parts of ``ts``."""
    t = _col(ts)
    return {
        "partition_date": F.date_format(t, PARTITION_DATE_FORMAT),
        "event_day": F.dayofmonth(t),
        "event_hour": F.hour(t),
        "event_minute": F.minute(t),
        "event_month": F.month(t),
        "event_second": F.second(t),
        "event_year": F.year(t),
    }


def text_to_epoch(text: Column | str, fmt: str = EVENT_TIME_FORMAT) -> Column:
    """text -> epoch seconds (BIGINT), null when the text does not parse."""
    return F.unix_timestamp(parse_event_time(text, fmt))


def epoch_to_text(epoch: Column | str, fmt: str | None = None) -> Column:
    """epoch seconds -> text, Spark's default pattern unless ``fmt`` is given."""
    return F.from_unixtime(_col(epoch)) if fmt is None else F.from_unixtime(_col(epoch), fmt)


def time_parts_by_substring(ts: Column | str = "event_date") -> dict[str, Column]:
    """calendar parts cut out of the timestamp's text form.

    The text is ``yyyy-MM-dd HH:mm:ss``; ``substr`` counts from 1 (a start of 0
    behaves like 1).
    """
    text = _col(ts).cast("string")
    spans = {"event_year": (1, 4), "event_month": (6, 2), "event_day": (9, 2),
             "event_hour": (12, 2), "event_minute": (15, 2), "event_second": (18, 2)}
    return {name: text.substr(pos, length).try_cast("int")
            for name, (pos, length) in spans.items()}
