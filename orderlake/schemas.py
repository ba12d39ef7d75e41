"""Schemas and fixed names of the order feed and its layers."""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, DoubleType, IntegerType, StringType,
                               StructField, StructType, TimestampType)

# All of this module is fixed values: formats, the record's fields and the layers' column names must equal
# the feed's conventions.
EVENT_TIME_FORMAT = "dd/MM/yyyy HH:mm:ss"   # text of the `date` field on the wire
PARTITION_DATE_FORMAT = "ddMMyyyy"         # silver `partition_date`
REPORT_TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"  # event-time report keys

# Current order record (8 fields, all nullable).
ORDER_SCHEMA = StructType([
    StructField("object_id", IntegerType(), True),
    StructField("latitude", DoubleType(), True),
    StructField("longitude", DoubleType(), True),
    StructField("date", StringType(), True),
    StructField("customer_id", IntegerType(), True),
    StructField("employee_id", IntegerType(), True),
    StructField("quantity_products", IntegerType(), True),
    StructField("order_id", StringType(), True),
])

# Earlier 7-field version of the record, without `object_id`.
ORDER_SCHEMA_V1 = StructType([f for f in ORDER_SCHEMA.fields if f.name != "object_id"])

# One wire line = a JSON array of order records.
WIRE_SCHEMA = ArrayType(ORDER_SCHEMA)

TIME_PART_COLUMNS = ["event_date", "partition_date", "event_day", "event_hour",
                     "event_minute", "event_month", "event_second", "event_year"]

SILVER_COLUMNS = ["latitude", "longitude", "customer_id", "employee_id",
                  "quantity_products", "order_id", *TIME_PART_COLUMNS,
                  "neighborhood", "commune"]

# Silver record as to_silver produces it (neighborhood names and communes are text).
SILVER_SCHEMA = StructType(
    [f for f in ORDER_SCHEMA.fields if f.name not in ("object_id", "date")]
    + [StructField("event_date", TimestampType(), True),
       StructField("partition_date", StringType(), True)]
    + [StructField(c, IntegerType(), True) for c in TIME_PART_COLUMNS[2:]]
    + [StructField("neighborhood", StringType(), True), StructField("commune", StringType(), True)])

GOLD_COLUMNS = ["order_id", "customer_name", "employee_name", "employee_commission",
                "latitude", "longitude", "commune", "neighborhood",
                "quantity_products", "event_date"]

GOLD_SCHEMA = StructType([StructField(c, t, True) for c, t in zip(GOLD_COLUMNS, [
    StringType(), StringType(), StringType(), DoubleType(), DoubleType(), DoubleType(), StringType(), StringType(), IntegerType(), TimestampType()])])

CUSTOMER_COLUMNS = ["customer_id", "name", "phone", "email", "address"]
EMPLOYEE_COLUMNS = ["employee_id", "name", "phone", "email", "address", "comission"]
NEIGHBORHOOD_KEY = "OBJECTID"
