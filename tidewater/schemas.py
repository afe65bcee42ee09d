"""Table schemas of the source, stage, dimension and control tables.

Keys are ``LongType`` (the driver's test tables use BIGINT keys); every timestamp is
``TimestampNTZType`` — the sources carry no zone.
"""

from __future__ import annotations

from pyspark.sql import types as T

_TS = T.TimestampNTZType()

CUSTOMER = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("created_at", _TS),
        T.StructField("updated_at", _TS),
    ]
)

# Soft-delete variant of the customer source: nullable deleted_at.
CUSTOMER_SOFT_DELETE = T.StructType(CUSTOMER.fields + [T.StructField("deleted_at", _TS)])

CUSTOMER_ADDRESS = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("cust_id", T.LongType()),
        T.StructField("address", T.StringType()),
        T.StructField("created_at", _TS),
        T.StructField("updated_at", _TS),
    ]
)

CUSTOMER_PAYMENT = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("cust_id", T.LongType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("created_at", _TS),
        T.StructField("updated_at", _TS),
    ]
)

DELETED_ENTRIES = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("table_name", T.StringType()),
        T.StructField("table_id", T.LongType()),
        T.StructField("created_at", _TS),
        T.StructField("updated_at", _TS),
    ]
)

SOURCE_SCHEMAS = {
    "customer": CUSTOMER,
    "customer_address": CUSTOMER_ADDRESS,
    "customer_payment": CUSTOMER_PAYMENT,
    "deleted_entries": DELETED_ENTRIES,
}

# The type-2 dimension (temp and target share it).
DIMENSION = T.StructType(
    [
        T.StructField("etl_key", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("name", T.StringType()),
        T.StructField("address", T.StringType()),
        T.StructField("payment_method", T.StringType()),
        T.StructField("etl_start_date", T.DateType()),
        T.StructField("etl_end_date", T.DateType()),
        T.StructField("etl_current_ind", T.StringType()),
        T.StructField("etl_timestamp", _TS),
    ]
)
DIMENSION_COLUMNS = [f.name for f in DIMENSION.fields]

# High-water-mark control table.
WATERMARK = T.StructType([T.StructField("table_name", T.StringType()), T.StructField("max_updated", _TS)])

# Child rows that wait for their customer: a row of customer_address or customer_payment.
PENDING = T.StructType(
    [
        T.StructField("table_name", T.StringType()),
        T.StructField("id", T.LongType()),
        T.StructField("cust_id", T.LongType()),
        T.StructField("value", T.StringType()),
        T.StructField("created_at", _TS),
        T.StructField("updated_at", _TS),
    ]
)

# CSV sample ingest (types assumed: the reference has no DDL for it).
SAMPLE = T.StructType(
    [
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("amount", T.DoubleType()),
    ]
)

# Reference data: day name -> weekday flag and activity.
DAY_ACTIVITY = T.StructType(
    [
        T.StructField("day", T.StringType()),
        T.StructField("is_weekday", T.BooleanType()),
        T.StructField("activity", T.StringType()),
    ]
)
