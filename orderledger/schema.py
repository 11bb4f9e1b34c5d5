"""Column lists, table schemas and fixed values."""

from __future__ import annotations

from pyspark.sql import types as T

# Curated columns of the two tables.
ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
]
ITEM_COLUMNS = ["order_id", "product_id", "price", "freight_value"]

# Raw order columns holding a timestamp. The file must carry the required
# ones; the optional ones are parsed when present.
REQUIRED_TIMESTAMPS = ["order_purchase_timestamp", "order_delivered_customer_date"]
OPTIONAL_TIMESTAMPS = [
    "order_approved_at",
    "order_delivered_carrier_date",
    "order_estimated_delivery_date",
]

# Order status domain, and the part of it that earns no revenue.
ORDER_STATUSES = [
    "created",
    "approved",
    "processing",
    "shipped",
    "delivered",
    "unavailable",
    "canceled",
    "invoiced",
]
INACTIVE_STATUSES = ["canceled", "unavailable"]

# Cell texts that pandas.read_csv takes as missing. Exact,
# case-sensitive, untrimmed.
NULL_TOKENS = [
    "",
    "#N/A",
    "#N/A N/A",
    "#NA",
    "-1.#IND",
    "-1.#QNAN",
    "-NaN",
    "-nan",
    "1.#IND",
    "1.#QNAN",
    "<NA>",
    "N/A",
    "NA",
    "NULL",
    "NaN",
    "None",
    "n/a",
    "nan",
    "null",
]

# Declared text lengths.
ID_LENGTH = 50
STATUS_LENGTH = 20

# Curated amounts, and amounts as read from text: wide enough to tell what does not fit.
MONEY = T.DecimalType(10, 2)
WIDE_MONEY = T.DecimalType(18, 2)

CLEAN_ORDERS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("customer_id", T.StringType()),
        T.StructField("order_status", T.StringType()),
        T.StructField("order_purchase_timestamp", T.TimestampNTZType()),
        T.StructField("order_delivered_customer_date", T.TimestampNTZType()),
    ]
)
CURATED_ORDERS = T.StructType(
    CLEAN_ORDERS.fields
    + [
        T.StructField("created_at", T.TimestampNTZType()),
        T.StructField("updated_at", T.TimestampNTZType()),
    ]
)
CLEAN_ITEMS = T.StructType(
    [
        T.StructField("order_id", T.StringType()),
        T.StructField("product_id", T.StringType()),
        T.StructField("price", MONEY),
        T.StructField("freight_value", MONEY),
    ]
)
CURATED_ITEMS = T.StructType(
    [T.StructField("id", T.LongType())]
    + CLEAN_ITEMS.fields
    + [T.StructField("created_at", T.TimestampNTZType())]
)
