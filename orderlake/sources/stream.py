"""The unbounded order feed, one wire batch per text line."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def orders_stream(spark: SparkSession, fmt: str = "text", path: str | None = None,
                  **options: str) -> DataFrame:
    """A streaming frame with a ``value STRING`` column.

    ``fmt`` is any line source Spark offers: ``text`` (a landing folder of wire
    files), ``kafka`` (then ``value`` is cast to text) or ``socket``.
    """
    reader = spark.readStream.format(fmt)
    for key, value in options.items():
        reader = reader.option(key, value)
    lines = reader.load(path) if path is not None else reader.load()
    if fmt == "kafka":
        return lines.selectExpr("CAST(value AS STRING) AS value")
    return lines.select("value")
