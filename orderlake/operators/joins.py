"""Dimension lookups.

Broadcast policy. A dimension is broadcast only when its size is known to be
small:

* bounded-by-nature dimensions (neighborhoods of one municipality, coordinate
  places, polygon cells) go through :func:`broadcast_if_bounded`, which counts at
  most ``max_rows + 1`` rows before it adds the hint; beyond the bound the join
  stays a shuffle join;
* dimensions that grow with the business (customers, employees) get no hint at
  all: Catalyst broadcasts them only while its size estimate is below
  ``spark.sql.autoBroadcastJoinThreshold`` and AQE re-checks with the real
  shuffle size at run time; otherwise it is a sort-merge join on the key, with
  AQE's skew-join split for hot keys (one customer with a third of all orders,
  or a third of the rows with a null key).

All joins are left outer: an unmatched or null key keeps the order with null
dimension columns; duplicate dimension keys multiply rows (the reference does
not deduplicate and neither do we).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from .project import neighborhood_dim

# Largest bounded dimension that may be broadcast: rows and estimated bytes.
BROADCAST_MAX_ROWS = 1_000_000
BROADCAST_MAX_BYTES = 64 * 1024 * 1024


def row_bytes(df: DataFrame) -> Column:
    """Rough in-memory size of a row: 8 bytes per fixed-width field, text by its
    length, nested values by the length of their JSON form."""
    parts = []
    for field in df.schema.fields:
        c = F.col(f"`{field.name}`")
        if isinstance(field.dataType, (StringType, BinaryType)):
            parts.append(F.coalesce(F.octet_length(c), F.lit(0)) + 8)
        elif isinstance(field.dataType, (ArrayType, MapType, StructType)):
            parts.append(F.coalesce(F.octet_length(F.to_json(c)), F.lit(0)) + 16)
        else:
            parts.append(F.lit(8))
    return reduce(lambda a, b: a + b, parts, F.lit(16)).cast("bigint")


def bounded(df: DataFrame, max_rows: int, max_bytes: int | None = None,
            size: Column | None = None) -> bool:
    """True if ``df`` has at most ``max_rows`` rows and, when ``max_bytes`` is
    given, at most that many estimated bytes. Reads at most ``max_rows + 1`` rows."""
    head = df.limit(max_rows + 1)
    if max_bytes is None:
        return head.count() <= max_rows
    n, total = head.agg(F.count(F.lit(1)),
                        F.sum(size if size is not None else row_bytes(df))).first()
    return n <= max_rows and (total or 0) <= max_bytes


def broadcast_if_bounded(df: DataFrame, max_rows: int = BROADCAST_MAX_ROWS,
                         max_bytes: int | None = BROADCAST_MAX_BYTES,
                         size: Column | None = None) -> DataFrame:
    """Hint a broadcast only after checking the bounds; otherwise leave it to the planner."""
    return F.broadcast(df) if bounded(df, max_rows, max_bytes, size) else df


def add_neighborhood(orders: DataFrame, nb: DataFrame,
                     max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """J1 + P7: left join on ``object_id`` = ``OBJECTID``; ``object_id`` is dropped.

    Output: the order columns without ``object_id``, then ``neighborhood``, ``commune``.
    """
    dim = broadcast_if_bounded(neighborhood_dim(nb), max_broadcast_rows)
    return orders.join(dim, on="object_id", how="left").drop("object_id")


def add_customer(df: DataFrame, customers: DataFrame) -> DataFrame:
    """Left join on ``customer_id``; adds ``customer_name/phone/email/address``."""
    dim = customers.select("customer_id",
                           *[F.col(c).alias(f"customer_{c}") for c in ("name", "phone", "email", "address")])
    return df.join(dim, on="customer_id", how="left")


def add_employee(df: DataFrame, employees: DataFrame) -> DataFrame:
    """Left join on ``employee_id``; adds ``employee_name/phone/email/address/commission``."""
    dim = employees.select("employee_id",
                           *[F.col(c).alias(f"employee_{c}") for c in ("name", "phone", "email", "address")],
                           F.col("comission").alias("employee_commission"))
    return df.join(dim, on="employee_id", how="left")


def lookup_by_coordinate(df: DataFrame, places: DataFrame,
                         max_broadcast_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Exact two-key left join on (latitude, longitude) for place attributes."""
    return df.join(broadcast_if_bounded(places, max_broadcast_rows),
                   on=["latitude", "longitude"], how="left")
