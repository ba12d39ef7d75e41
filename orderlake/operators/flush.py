"""The count gate's threshold test (A6); the gate itself is in :mod:`orderlake.streaming.ingest`."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def flush_ready(n: Column | str, threshold: int = 50) -> Column:
    """True once the buffered row count exceeds the threshold."""
    return (F.col(n) if isinstance(n, str) else n) > threshold
