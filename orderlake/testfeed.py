"""Order-feed inputs made from the driver's tables (FIXTURES.md §2–§3).

``events`` is the order feed; ``customer``, ``supplier`` and ``nation``/``region``
stand in for customers, employees and neighborhoods. Some keys are left
unmatched on purpose, on the feed's side (object ids 25–29, every tenth user's customer id, employee
ids past the supplier range at small scales); every row of every table takes part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .schemas import EVENT_TIME_FORMAT


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders (8-field record) derived row by row from ``events``."""
    eid = F.col("event_id")
    return table(spark, sf_dir, "events").select(
        (eid % 30).cast("int").alias("object_id"),
        (((eid * 91) % 1000).cast("double") / 100).alias("latitude"),
        (((eid * 37) % 1000).cast("double") / 100).alias("longitude"),
        F.date_format("ts", EVENT_TIME_FORMAT).alias("date"),
        F.when(F.col("user_id") % 10 == 9, -F.col("user_id")).otherwise(F.col("user_id")).cast("int").alias("customer_id"),
        (eid % 120).cast("int").alias("employee_id"),
        F.floor("value").cast("int").alias("quantity_products"),
        F.concat(F.lit("evt-"), F.lpad(eid.cast("string"), 8, "0")).alias("order_id"))


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        F.col("c_custkey").cast("int").alias("customer_id"), F.col("c_name").alias("name"),
        F.col("c_mktsegment").alias("phone"), F.concat("c_name", F.lit("@x")).alias("email"),
        F.col("c_mktsegment").alias("address"))


def employees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").select(
        F.col("s_suppkey").cast("int").alias("employee_id"), F.col("s_name").alias("name"),
        F.col("s_name").alias("phone"), F.concat("s_name", F.lit("@x")).alias("email"),
        F.col("s_name").alias("address"), F.col("s_acctbal").alias("comission"))


def neighborhoods(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation")
    region = table(spark, sf_dir, "region")
    return nation.join(region, nation["n_regionkey"] == region["r_regionkey"]).select(
        nation["n_nationkey"].alias("OBJECTID"), nation["n_name"].alias("NOMBRE"),
        region["r_name"].alias("IDENTIFICACION"))


# Fixed test polygons (FIXTURES.md §3): concave, with a hole, overlapping, boundary. Their sequence
# (``poly_seq``) is the reverse of their ids.
POLYGONS = [
    (1, "concave", [[(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (2.0, 2.0), (2.0, 4.0), (0.0, 4.0)]]),
    (2, "hole", [[(5.0, 5.0), (9.0, 5.0), (9.0, 9.0), (5.0, 9.0)],
                 [(6.0, 6.0), (8.0, 6.0), (8.0, 8.0), (6.0, 8.0)]]),
    (3, "overlap", [[(1.0, 0.0), (3.0, 0.0), (3.0, 2.0), (1.0, 2.0)]]),
]
BOUNDARY = [(0, "boundary", [[(0.0, 0.0), (10.0, 0.0), (10.0, 9.0), (0.0, 9.0)]])]


def _polygon_frame(spark: SparkSession, rows) -> DataFrame:
    """Inline polygons as a SQL literal table (built in the JVM, no Python workers)."""
    def ring(r):
        return "array(" + ", ".join(f"named_struct('x', {x!r}D, 'y', {y!r}D)" for x, y in r) + ")"
    values = ", ".join(f"({pid}, '{name}', array({', '.join(ring(r) for r in rings)}), {-pid})"
                       for pid, name, rings in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(polygon_id, name, rings, poly_seq)")


def polygons(spark: SparkSession, ids: tuple[int, ...] = (1, 2, 3)) -> DataFrame:
    return _polygon_frame(spark, [p for p in POLYGONS if p[0] in ids])


def parcels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A polygon an order: a square beside its coordinate."""
    x, y = F.col("longitude"), F.col("latitude")
    corner = lambda dx, dy: F.struct((x + dx).alias("x"), (y + dy).alias("y"))
    ring = F.array(corner(0.0, 0.0), corner(0.5, 0.0), corner(0.5, 0.25), corner(0.0, 0.25))
    return feed(spark, sf_dir).select(F.col("order_id").alias("polygon_id"), F.array(ring).alias("rings"))


def boundary(spark: SparkSession) -> DataFrame:
    return _polygon_frame(spark, BOUNDARY)


BAD_WIRE_LINES = [
    '{"object_id": 1, "latitude": 1.5, "longitude": 2.5, "date": "01/01/2024 00:00:00", '
    '"customer_id": 1, "employee_id": 2, "quantity_products": 3, "order_id": "single"}',
    'not json at all',
    '',
    '[]',
    '[{"object_id": "x", "latitude": 1.0, "longitude": 2.0, "date": "02/01/2024 10:00:00", '
    '"customer_id": 1.5, "employee_id": 99999999999, "quantity_products": 4, "order_id": "badtypes"}]',
    '[{"object_id": 2, "order_id": "missing", "extra": true}]',
    '[{"object_id": 3, "order_id": "first"}] [{"object_id": 4, "order_id": "second"}]',
]


def wire_lines(spark: SparkSession, sf_dir: str, per_batch: int = 7) -> DataFrame:
    """The feed as wire lines: orders of events ``event_id div per_batch`` share a line."""
    from .streaming.ingest import to_wire
    batch = (F.substring("order_id", 5, 8).cast("bigint") / per_batch).cast("bigint")
    return to_wire(feed(spark, sf_dir).withColumn("wire_batch", batch), "wire_batch").select("value")


def bad_lines(spark: SparkSession) -> DataFrame:
    return spark.range(1).select(F.explode(F.array(*[F.lit(v) for v in BAD_WIRE_LINES])).alias("value"))
