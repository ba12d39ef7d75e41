"""The gate as keyed state: orders wait by lane until there are enough of them or they have waited long enough.

Every lane (a value of a key column, such as a region or a feed) buffers its own orders. More than ``threshold`` of them go out at
once, as one flush of the lane; a processing-time timer lets out what is left ``max_age`` seconds after the first of them
came, so that a lane's last rows never wait for a batch that does not come. A lane holds at most ``threshold`` rows between micro-batches, in the
state store, whose checkpoint makes it survive lost executors; a hot lane's rows pass through one task a
micro-batch, so a feed with one is given more lanes (:func:`with_lanes`).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle
from pyspark.sql.types import StringType, StructField, StructType

from ..schemas import ORDER_SCHEMA

STATE_STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
#: What the gate lets out: an order, its lane, the number of the lane's flush and what let it out.
GATED_SCHEMA = StructType([StructField("lane", StringType(), True), *ORDER_SCHEMA.fields]).add("flush_id", "long").add("reason", "string")


class Gate(StatefulProcessor):
    """One lane's buffer: its rows, how many there are, and the number of the next flush."""

    def __init__(self, threshold: int, max_age_ms: int):
        self.threshold, self.max_age_ms = threshold, max_age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.rows = handle.getListState("rows", ORDER_SCHEMA)
        self.level = handle.getValueState("level", "held long, flush long, due long")

    def _state(self) -> tuple[int, int, int]:
        return tuple(int(x) for x in self.level.get()) if self.level.exists() else (0, 1, 0)

    def _out(self, key, frame: pd.DataFrame, flush: int, reason: str) -> pd.DataFrame:
        return frame.assign(lane=key[0], flush_id=flush, reason=reason)[GATED_SCHEMA.names]

    def _held(self) -> pd.DataFrame:
        return pd.DataFrame(list(self.rows.get()), columns=ORDER_SCHEMA.names).astype(object) if self.rows.exists() else pd.DataFrame(
            columns=ORDER_SCHEMA.names, dtype=object)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        held, flush, due = self._state()
        new = [r[ORDER_SCHEMA.names].astype(object).where(r[ORDER_SCHEMA.names].notna(), None) for r in rows]
        count = sum(map(len, new))
        if held + count > self.threshold:
            yield self._out(key, pd.concat([self._held(), *new]), flush, "count")
            self.rows.clear()
            if due:
                self.handle.deleteTimer(due)
            self.level.update((0, flush + 1, 0))
            return
        for frame in new:
            self.rows.appendList([_typed(r) for r in frame.itertuples(index=False)])
        if count and not due:
            due = timerValues.getCurrentProcessingTimeInMs() + self.max_age_ms
            self.handle.registerTimer(due)
        self.level.update((held + count, flush, due))

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        held, flush, due = self._state()
        if held and due <= expiredTimerInfo.getExpiryTimeInMs():
            yield self._out(key, self._held(), flush, "age")
            self.rows.clear()
            self.level.update((0, flush + 1, 0))

    def close(self) -> None:
        pass


_TYPES = {"int": int, "double": float, "string": str}


def _typed(row) -> tuple:
    """A row of plain Python values of the record's types."""
    return tuple(None if v is None else _TYPES[f.dataType.simpleString()](v) for v, f in zip(row, ORDER_SCHEMA.fields))


def with_lanes(orders: DataFrame, lanes: int, *by: str) -> DataFrame:
    """``orders`` with a column ``lane``: the values of ``by``, each dealt over ``lanes`` lanes by the order's hash."""
    share = F.pmod(F.xxhash64(*ORDER_SCHEMA.names), F.lit(lanes)).cast("string")
    return orders.withColumn("lane", F.concat_ws("/", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by], share))


def gate_by_lane(orders: DataFrame, lane: str = "lane", threshold: int = 50, max_age: float = 1800.0) -> DataFrame:
    """Streaming orders in, gated orders out (:data:`GATED_SCHEMA`): by count, or ``max_age`` seconds after a lane's first one."""
    use_state_store(orders.sparkSession)
    named = orders.select(F.coalesce(F.col(lane).cast("string"), F.lit("")).alias("lane"), *ORDER_SCHEMA.names)
    return named.groupBy("lane").transformWithStateInPandas(
        statefulProcessor=Gate(threshold, int(max_age * 1000)), outputStructType=GATED_SCHEMA, outputMode="Append", timeMode="ProcessingTime")


def use_state_store(spark: SparkSession) -> None:
    """Timers need the RocksDB state store; set where the session names no other."""
    if not spark.conf.get("spark.sql.streaming.stateStore.providerClass", "").endswith("RocksDBStateStoreProvider"):
        spark.conf.set("spark.sql.streaming.stateStore.providerClass", STATE_STORE)
