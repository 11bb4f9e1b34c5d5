"""Raw order data made from the given tables.

The given tables are clean and shaped differently, so SQL text that both engines read
turns every row of ``orders`` and ``lineitem`` into raw text and spoils some cells. The
arithmetic on keys only picks which cells are spoiled; no row is left out.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession

FIRST_RUN = datetime(2024, 1, 1)
SECOND_RUN = datetime(2025, 1, 1, 2)

RAW_ORDERS = """
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
  CASE o_orderkey % 8 WHEN 0 THEN 'created' WHEN 1 THEN 'approved' WHEN 2 THEN 'processing'
    WHEN 3 THEN 'shipped' WHEN 4 THEN 'delivered' WHEN 5 THEN 'unavailable'
    WHEN 6 THEN 'canceled' ELSE 'invoiced' END AS order_status,
  CAST(o_orderdate AS STRING) AS order_purchase_timestamp,
  CASE WHEN o_orderkey % 7 = 0 THEN NULL WHEN o_orderkey % 11 = 0 THEN 'not-a-date'
    ELSE CAST(o_orderdate + INTERVAL '10' DAY AS STRING) END AS order_delivered_customer_date
FROM {orders}
"""

RAW_ITEMS = """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(l_partkey AS STRING) AS product_id,
  CASE WHEN l_partkey % 50 = 0 THEN 'abc' WHEN l_partkey % 50 = 1 THEN '-5.00'
    WHEN l_partkey % 50 = 2 THEN ''
    ELSE CAST(CAST(l_extendedprice AS DECIMAL(10,2)) AS STRING) END AS price,
  CASE WHEN l_partkey % 50 = 3 THEN 'n/a'
    ELSE CAST(CAST(l_quantity * l_tax AS DECIMAL(10,2)) AS STRING) END AS freight_value
FROM {lineitem}
"""

# A later batch: every order again, now delivered; those invoiced before are new orders.
BATCH_ORDERS = """
SELECT CASE WHEN order_status = 'invoiced' THEN concat('new-', order_id) ELSE order_id END
    AS order_id,
  customer_id, 'delivered' AS order_status, order_purchase_timestamp,
  order_delivered_customer_date
FROM {raw_orders}
"""

# Orders whose delivery date comes in forms that are taken or refused.
VARIED_TIMESTAMPS = """
SELECT CAST(o_orderkey AS STRING) AS order_id, CAST(o_custkey AS STRING) AS customer_id,
  o_orderstatus AS order_status, CAST(o_orderdate AS STRING) AS order_purchase_timestamp,
  CASE o_orderkey % 12
    WHEN 0 THEN substr(CAST(o_orderdate AS STRING), 1, 10)
    WHEN 1 THEN substr(CAST(o_orderdate AS STRING), 1, 4)
    WHEN 2 THEN replace(CAST(o_orderdate AS STRING), ' ', 'T')
    WHEN 3 THEN concat(CAST(o_orderdate AS STRING), '.123')
    WHEN 4 THEN concat(' ', CAST(o_orderdate AS STRING), ' ')
    WHEN 5 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 10), ' 24:00:00')
    WHEN 6 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 4), '-02-30 00:00:00')
    WHEN 7 THEN concat(substr(CAST(o_orderdate AS STRING), 1, 4), '-1-2 3:4:5')
    WHEN 8 THEN '9999-12-31 23:59:59'
    WHEN 9 THEN 'not-a-date'
    WHEN 10 THEN ''
    ELSE CAST(o_orderdate AS STRING) END AS order_delivered_customer_date
FROM {orders}
"""

# Items whose price comes in number forms that are taken or refused.
VARIED_PRICES = """
SELECT CAST(l_orderkey AS STRING) AS order_id, CAST(l_partkey AS STRING) AS product_id,
  CASE l_partkey % 25
    WHEN 0 THEN ' 2.5 ' WHEN 1 THEN '+5' WHEN 2 THEN '.5' WHEN 3 THEN '5.'
    WHEN 4 THEN '1e3' WHEN 5 THEN '1,000' WHEN 6 THEN '0x10' WHEN 7 THEN '1_000'
    WHEN 8 THEN '1d' WHEN 9 THEN 'inf' WHEN 10 THEN '-inf' WHEN 11 THEN '123456789012'
    WHEN 12 THEN '-0.0' WHEN 13 THEN '-0.004' WHEN 14 THEN '99999999.994'
    WHEN 15 THEN '99999999.996' WHEN 16 THEN '-1e20' WHEN 17 THEN 'abc' WHEN 18 THEN NULL
    ELSE CAST(l_extendedprice AS STRING) END AS price,
  CASE l_partkey % 25 WHEN 20 THEN 'n/a' WHEN 21 THEN '1f' WHEN 22 THEN '-inf'
    WHEN 23 THEN '123456789012' WHEN 24 THEN '-100000000'
    ELSE CAST(CAST(l_quantity * l_tax AS DECIMAL(10,2)) AS STRING) END AS freight_value
FROM {lineitem}
"""

TOKEN_ITEMS = """
SELECT order_id,
  CASE CAST(product_id AS BIGINT) % 10 WHEN 0 THEN 'NA' WHEN 1 THEN 'NULL' WHEN 2 THEN 'n/a'
    WHEN 3 THEN 'None' WHEN 4 THEN '' WHEN 5 THEN ' NA ' WHEN 6 THEN 'none'
    ELSE product_id END AS product_id,
  price, freight_value
FROM {raw_items}
"""

# The same with two of the optional columns; the third one is absent.
OPTIONAL_TIMESTAMPS = """
SELECT order_id, customer_id, order_status, order_purchase_timestamp,
  order_delivered_customer_date, order_delivered_customer_date AS order_approved_at,
  replace(order_purchase_timestamp, '-', '/') AS order_estimated_delivery_date
FROM {varied_timestamps}
"""

# Timestamps written month first, some of them ISO or no date at all.
SLASHED_TIMESTAMPS = """
SELECT order_id, customer_id, order_status,
  concat(substr(order_purchase_timestamp, 6, 2), '/', substr(order_purchase_timestamp, 9, 2),
    '/', substr(order_purchase_timestamp, 1, 4), substr(order_purchase_timestamp, 11, 9))
    AS order_purchase_timestamp,
  CASE CAST(order_id AS BIGINT) % 4 WHEN 0 THEN order_purchase_timestamp
    WHEN 1 THEN concat('02/30/', substr(order_purchase_timestamp, 1, 4), ' 00:00:00')
    WHEN 2 THEN concat('03/25/', substr(order_purchase_timestamp, 1, 4), ' 02:30:00')
    ELSE '' END AS order_delivered_customer_date
FROM {raw_orders}
"""

# Orders and items that break every declared constraint somewhere.
BROKEN_ORDERS = """
SELECT CASE WHEN CAST(order_id AS BIGINT) % 41 = 0 THEN concat(repeat('x', 50), order_id)
    ELSE order_id END AS order_id,
  CASE WHEN CAST(order_id AS BIGINT) % 43 = 0 THEN repeat('c', 51) ELSE customer_id END
    AS customer_id,
  CASE WHEN CAST(order_id AS BIGINT) % 47 = 0 THEN repeat('s', 21) ELSE order_status END
    AS order_status,
  CASE WHEN CAST(order_id AS BIGINT) % 53 = 0 THEN 'never' ELSE order_purchase_timestamp END
    AS order_purchase_timestamp,
  order_delivered_customer_date
FROM {raw_orders}
"""
BROKEN_ITEMS = """
SELECT CASE CAST(product_id AS BIGINT) % 19 WHEN 0 THEN 'NA' WHEN 1 THEN repeat('o', 51)
    ELSE order_id END AS order_id,
  CASE CAST(product_id AS BIGINT) % 23 WHEN 0 THEN '' WHEN 1 THEN repeat('p', 51)
    ELSE product_id END AS product_id,
  CASE CAST(product_id AS BIGINT) % 29 WHEN 0 THEN '100000000' WHEN 1 THEN 'inf'
    WHEN 2 THEN '1e30' ELSE price END AS price,
  CASE CAST(product_id AS BIGINT) % 31 WHEN 0 THEN '-0.01' WHEN 1 THEN '123456789012'
    WHEN 2 THEN '-inf' ELSE freight_value END AS freight_value
FROM {raw_items}
"""

# Items of which some have no order_id.
KEYLESS_ITEMS = """
SELECT CASE WHEN CAST(order_id AS BIGINT) % 13 = 0 THEN NULL ELSE order_id END AS order_id,
  product_id, price, freight_value
FROM {raw_items}
"""

# Items of which a third are of one order and some more of a few others; some have no order.
SKEWED_ITEMS = """
SELECT CASE WHEN CAST(product_id AS BIGINT) % 3 = 0 THEN 'hot'
    WHEN CAST(product_id AS BIGINT) % 50 < 5
      THEN concat('warm ', CAST(CAST(order_id AS BIGINT) % 20 AS STRING))
    WHEN CAST(product_id AS BIGINT) % 47 = 0 THEN NULL ELSE order_id END AS order_id,
  product_id, price, freight_value
FROM {raw_items}
"""

# Items whose product is a text with line breaks, quotes and commas.
QUOTED_ITEMS = """
SELECT order_id,
  CASE CAST(product_id AS BIGINT) % 5 WHEN 0 THEN concat('two', chr(10), 'lines, ', product_id)
    WHEN 1 THEN concat('"', product_id, '"', chr(10), chr(10), 'more "quotes" ,')
    WHEN 2 THEN concat(product_id, ', a comma') ELSE product_id END AS product_id,
  price, freight_value
FROM {raw_items}
"""

# A reload in which some prices differ, some items are gone and some are there twice.
RELOADED_ITEMS = """
SELECT order_id, product_id,
  CASE WHEN CAST(product_id AS BIGINT) % 31 = 5 THEN '1.25' ELSE price END AS price, freight_value
FROM {raw_items} WHERE CAST(product_id AS BIGINT) % 37 <> 6
UNION ALL
SELECT order_id, product_id, price, freight_value FROM {raw_items}
WHERE CAST(product_id AS BIGINT) % 41 = 7
"""

# A third of the rows share one order_id; some keys, customers and statuses are missing.
FLAWED_ORDERS = """
SELECT CASE WHEN CAST(order_id AS BIGINT) % 3 = 0 THEN '0'
    WHEN CAST(order_id AS BIGINT) % 103 = 0 THEN NULL ELSE order_id END AS order_id,
  CASE WHEN CAST(order_id AS BIGINT) % 101 = 0 THEN NULL ELSE customer_id END AS customer_id,
  CASE WHEN CAST(order_id AS BIGINT) % 97 = 0 THEN 'unknown'
    WHEN CAST(order_id AS BIGINT) % 89 = 0 THEN NULL ELSE order_status END AS order_status,
  order_purchase_timestamp, order_delivered_customer_date
FROM {raw_orders}
"""


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_ORDERS, orders=table(spark, sf_dir, "orders"))


def raw_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RAW_ITEMS, lineitem=table(spark, sf_dir, "lineitem"))


def batch_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BATCH_ORDERS, raw_orders=raw_orders(spark, sf_dir))


def varied_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(VARIED_TIMESTAMPS, orders=table(spark, sf_dir, "orders"))


def varied_prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(VARIED_PRICES, lineitem=table(spark, sf_dir, "lineitem"))


def token_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(TOKEN_ITEMS, raw_items=raw_items(spark, sf_dir))


def flawed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(FLAWED_ORDERS, raw_orders=raw_orders(spark, sf_dir))


def optional_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(OPTIONAL_TIMESTAMPS, varied_timestamps=varied_timestamps(spark, sf_dir))


def slashed_timestamps(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SLASHED_TIMESTAMPS, raw_orders=raw_orders(spark, sf_dir))


def broken_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BROKEN_ORDERS, raw_orders=raw_orders(spark, sf_dir))


def broken_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(BROKEN_ITEMS, raw_items=raw_items(spark, sf_dir))


def keyless_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(KEYLESS_ITEMS, raw_items=raw_items(spark, sf_dir))


def skewed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(SKEWED_ITEMS, raw_items=raw_items(spark, sf_dir))


def quoted_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(QUOTED_ITEMS, raw_items=raw_items(spark, sf_dir))


def reloaded_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.sql(RELOADED_ITEMS, raw_items=raw_items(spark, sf_dir))
