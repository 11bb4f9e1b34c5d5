"""SQL for each query, written for DuckDB and independent of the Spark code."""

from __future__ import annotations

import proxy_inputs as inputs

_TOKENS = (
    "('', '#N/A', '#N/A N/A', '#NA', '-1.#IND', '-1.#QNAN', '-NaN', '-nan', '1.#IND', "
    "'1.#QNAN', '<NA>', 'N/A', 'NA', 'NULL', 'NaN', 'None', 'n/a', 'nan', 'null')"
)
_NUMBER = r"'\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*'"
_INFINITE = r"'\s*[+-]?(inf|infinity)\s*'"


def _known(column: str) -> str:
    return f"CASE WHEN {column} IN {_TOKENS} THEN NULL ELSE {column} END"


def _time(column: str) -> str:
    parsed = f"TRY_STRPTIME({column}, '%Y-%m-%d %H:%M:%S')"
    return (
        f"CASE WHEN {column} = TRIM({column}) AND YEAR({parsed}) BETWEEN 1678 AND 2261 "
        f"THEN {parsed} END"
    )


def _money(column: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({column}, {_NUMBER}) "
        f"THEN TRY_CAST(TRIM({column}) AS DECIMAL(18,2)) END"
    )


def _issue(column: str) -> str:
    number = f"regexp_full_match({column}, {_NUMBER})"
    infinite = f"regexp_full_match({column}, {_INFINITE}, 'i')"
    value = f"TRY_CAST(TRIM({column}) AS DOUBLE)"
    return (
        f"CASE WHEN {column} IS NULL OR NOT ({number} OR {infinite}) THEN 'unparseable' "
        f"WHEN {value} < 0 THEN 'negative' "
        f"WHEN {_money(column)} IS NULL OR {_money(column)} > 99999999.99 "
        "THEN 'out_of_range' END"
    )


def _range_issue(column: str) -> str:
    number = f"regexp_full_match({column}, {_NUMBER})"
    infinite = f"regexp_full_match({column}, {_INFINITE}, 'i')"
    return (
        f"CASE WHEN ({number} OR {infinite}) AND ({_money(column)} IS NULL "
        f"OR ABS({_money(column)}) > 99999999.99) THEN 'out_of_range' END"
    )


def _coerced(source: str) -> str:
    return (
        f"SELECT {_known('order_id')} AS order_id, {_known('product_id')} AS product_id, "
        f"{_money('price')} AS price, {_money('freight_value')} AS freight_value, "
        f"{_issue('price')} AS price_issue, {_range_issue('freight_value')} AS freight_issue "
        f"FROM {source}"
    )


def _cleaned(source: str) -> str:
    delivered = _time("order_delivered_customer_date")
    purchased = _time("order_purchase_timestamp")
    return (
        f"SELECT order_id, customer_id, order_status, {purchased} AS order_purchase_timestamp, "
        f"COALESCE({delivered}, {purchased}) AS order_delivered_customer_date FROM {source}"
    )


_VIEWS = {
    "raw_orders": inputs.RAW_ORDERS.format(orders="orders"),
    "raw_items": inputs.RAW_ITEMS.format(lineitem="lineitem"),
    "batch_orders": inputs.BATCH_ORDERS.format(raw_orders="raw_orders"),
    "varied_timestamps": inputs.VARIED_TIMESTAMPS.format(orders="orders"),
    "varied_prices": inputs.VARIED_PRICES.format(lineitem="lineitem"),
    "token_items": inputs.TOKEN_ITEMS.format(raw_items="raw_items"),
    "flawed_orders": inputs.FLAWED_ORDERS.format(raw_orders="raw_orders"),
    "optional_timestamps": inputs.OPTIONAL_TIMESTAMPS.format(
        varied_timestamps="varied_timestamps"
    ),
    "slashed_timestamps": inputs.SLASHED_TIMESTAMPS.format(raw_orders="raw_orders"),
    "broken_orders": inputs.BROKEN_ORDERS.format(raw_orders="raw_orders"),
    "broken_items": inputs.BROKEN_ITEMS.format(raw_items="raw_items"),
    "keyless_items": inputs.KEYLESS_ITEMS.format(raw_items="raw_items"),
    "skewed_items": inputs.SKEWED_ITEMS.format(raw_items="raw_items"),
    "quoted_items": inputs.QUOTED_ITEMS.format(raw_items="raw_items"),
    "reloaded_items": inputs.RELOADED_ITEMS.format(raw_items="raw_items"),
    "clean_reloaded": "SELECT order_id, product_id, price, freight_value "
    f"FROM ({_coerced('reloaded_items')}) WHERE price >= 0",
    "coerced": _coerced("raw_items"),
    "clean_items": "SELECT order_id, product_id, price, freight_value FROM coerced "
    "WHERE price >= 0",
    "clean_orders": _cleaned("raw_orders"),
    "clean_batch": _cleaned("batch_orders"),
    "active": "SELECT * FROM clean_orders WHERE order_status NOT IN ('canceled', 'unavailable')",
    # One merged table: the batch's rows, then the target's rows the batch does not name.
    "merged": """
      SELECT b.*, COALESCE(t.created_at, TIMESTAMP '2025-01-01 02:00:00') AS created_at,
        TIMESTAMP '2025-01-01 02:00:00' AS updated_at
      FROM clean_batch b LEFT JOIN
        (SELECT order_id, TIMESTAMP '2024-01-01 00:00:00' AS created_at FROM clean_orders) t
        USING (order_id)
      UNION ALL
      SELECT *, TIMESTAMP '2024-01-01 00:00:00', TIMESTAMP '2024-01-01 00:00:00'
      FROM clean_orders WHERE order_id NOT IN (SELECT order_id FROM clean_batch)
    """,
}


def _with(body: str) -> str:
    views = ", ".join(f"{name} AS ({text})" for name, text in _VIEWS.items())
    return f"WITH {views} {body}"


_ITEM_MONEY = (
    "order_id, product_id, CAST(price AS DOUBLE) AS price, "
    "CAST(freight_value AS DOUBLE) AS freight_value"
)


def _report(orders: str) -> str:
    return (
        "SELECT CAST(order_purchase_timestamp AS DATE) AS report_date, "
        "CAST(SUM(price) AS DOUBLE) AS daily_revenue, "
        "COUNT(DISTINCT order_id) AS order_count "
        f"FROM {orders} JOIN clean_items USING (order_id) GROUP BY 1"
    )


_JOINED = (
    "SELECT order_id, CAST(order_purchase_timestamp AS DATE) AS report_date, price "
    "FROM clean_orders JOIN clean_items USING (order_id)"
)


def _checks(source: str, table: str, rules: list[tuple[str, str, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{table}' AS table_name, '{name}' AS rule, '{severity}' AS severity, "
        f"CAST(COUNT(*) FILTER (WHERE {bad}) AS BIGINT) AS violations FROM {source}"
        for name, severity, bad in rules
    )


_RECONCILED = """
  SELECT check_name, CAST(value AS DOUBLE) AS reported, CAST(value AS DOUBLE) AS expected,
    TRUE AS matches
  FROM (SELECT 'report_days' AS check_name, COUNT(DISTINCT report_date) AS value FROM joined
    UNION ALL SELECT 'total_revenue', SUM(price) FROM joined
    UNION ALL SELECT 'total_orders', COUNT(DISTINCT (report_date, order_id)) FROM joined)
"""

_ITEM_CHECKS = [
    ("order_id_not_null", "hard", "order_id IS NULL"),
    ("product_id_not_null", "hard", "product_id IS NULL"),
    (
        "price_missing",
        "hard",
        "price IS NULL AND COALESCE(price_issue, '') <> 'out_of_range'",
    ),
    ("price_negative", "hard", "price < 0"),
    ("price_range", "hard", "price_issue = 'out_of_range' OR ABS(price) > 99999999.99"),
    ("freight_value_missing", "soft", "freight_value IS NULL AND freight_issue IS NULL"),
    ("freight_value_negative", "hard", "freight_value < 0"),
    ("freight_value_range", "hard", "freight_issue IS NOT NULL"),
    ("order_id_length", "hard", "LENGTH(order_id) > 50"),
    ("product_id_length", "hard", "LENGTH(product_id) > 50"),
]
_ORDER_CHECKS = [
    ("order_purchase_timestamp_not_null", "hard", "order_purchase_timestamp IS NULL"),
    ("order_id_length", "hard", "LENGTH(order_id) > 50"),
    ("customer_id_length", "hard", "LENGTH(customer_id) > 50"),
    ("order_status_length", "hard", "LENGTH(order_status) > 20"),
]

def _active_report(orders: str) -> str:
    return (
        "SELECT CAST(order_purchase_timestamp AS DATE) AS report_date, "
        "COUNT(DISTINCT order_id) AS order_count, "
        "CAST(SUM(price) AS DOUBLE) AS daily_revenue, "
        "CAST((2 * CAST(SUM(price) * 100 AS BIGINT) + COUNT(price)) // (2 * COUNT(price)) "
        "AS DOUBLE) / 100 AS avg_order_value "
        f"FROM {orders} JOIN clean_items USING (order_id) GROUP BY 1"
    )


# Of the inferred types: the form of a cell and, for timestamps, how it is read.
_FORMS = {
    "yyyy-MM-dd HH:mm:ss": (r"\d{4}-\d{2}-\d{2} \d{2}:\d{2}:\d{2}", "%Y-%m-%d %H:%M:%S"),
    "yyyy-MM-dd": (r"\d{4}-\d{2}-\d{2}", "%Y-%m-%d"),
    "yyyy-MM-dd'T'HH:mm:ss": (r"\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}", "%Y-%m-%dT%H:%M:%S"),
    "MM/dd/yyyy HH:mm:ss": (r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}", "%m/%d/%Y %H:%M:%S"),
    "dd/MM/yyyy HH:mm:ss": (r"\d{2}/\d{2}/\d{4} \d{2}:\d{2}:\d{2}", "%d/%m/%Y %H:%M:%S"),
}
_INTEGER_CELL = r"regexp_full_match(c, '\s*[+-]?\d+\s*')"
_DECIMAL_CELL = r"regexp_full_match(c, '\s*[+-]?(\d+\.?\d*|\.\d+)\s*')"
_DOUBLE_CELL = (
    r"regexp_full_match(lower(c), '\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf(inity)?)\s*')"
)


def _inferred(source: str, table: str, column: str, percent: int = 90) -> str:
    """One column's type by plain counts."""

    def count(condition: str) -> str:
        return f"COUNT(*) FILTER (WHERE {condition})"

    def longest(pattern: str) -> str:
        return (
            f"COALESCE(MAX(length(regexp_extract(c, '{pattern}', 1))) "
            f"FILTER (WHERE {_DECIMAL_CELL}), 0)"
        )

    times = ", ".join(
        count(f"regexp_full_match(c, '{form}') AND TRY_STRPTIME(c, '{parse}') IS NOT NULL")
        + f" AS t{k}"
        for k, (form, parse) in enumerate(_FORMS.values())
    )
    most = "greatest(" + ", ".join(f"t{k}" for k in range(len(_FORMS))) + ")"
    first = " ".join(
        "WHEN t{} = {} THEN '{}'".format(k, most, name.replace("'", "''"))
        for k, name in enumerate(_FORMS)
    )
    enough = f"* 100 >= present * {percent}"
    return f"""
      SELECT '{table}' AS table_name, '{column}' AS column_name, row_count, missing_count,
        kind AS inferred_type, CASE WHEN kind = 'timestamp_ntz' THEN CASE {first} END END AS pattern,
        CASE kind WHEN 'void' THEN 0 WHEN 'boolean' THEN booleans WHEN 'bigint' THEN integers
          WHEN 'double' THEN doubles WHEN 'timestamp_ntz' THEN {most} WHEN 'string' THEN present
          ELSE CASE WHEN integers {enough} THEN integers ELSE decimals END END AS fitting_count
      FROM (SELECT *,
        CASE WHEN present = 0 THEN 'void' WHEN booleans {enough} THEN 'boolean'
          WHEN integers {enough} AND before <= 18 THEN 'bigint'
          WHEN decimals {enough} THEN concat('decimal(', greatest(before + after, 1), ',', after, ')')
          WHEN doubles {enough} THEN 'double' WHEN {most} {enough} THEN 'timestamp_ntz'
          ELSE 'string' END AS kind
      FROM (SELECT COUNT(*) AS row_count, {count('c IS NULL')} AS missing_count,
        COUNT(c) AS present, {count("lower(c) IN ('true', 'false')")} AS booleans,
        {count(_INTEGER_CELL)} AS integers, {count(_DECIMAL_CELL)} AS decimals,
        {count(_DOUBLE_CELL)} AS doubles, {longest(r'^\s*[+-]?0*(\d*)')} AS before,
        {longest(r'\.(\d*)\s*$')} AS after, {times}
      FROM (SELECT {_known(column)} AS c FROM {source})))"""


_RAW_ORDER_COLUMNS = [
    "order_id",
    "customer_id",
    "order_status",
    "order_purchase_timestamp",
    "order_delivered_customer_date",
]
_RAW_ITEM_COLUMNS = ["order_id", "product_id", "price", "freight_value"]
_ITEM_ORDER = ", ".join(f"{name} NULLS FIRST" for name in _RAW_ITEM_COLUMNS)
_RELOADED_ORDERS = "(SELECT * FROM merged WHERE order_status NOT IN ('canceled', 'unavailable'))"

_BODIES = {
    "infer_column_types": " UNION ALL ".join(
        _inferred(source, table, column)
        for table, source, columns in [
            ("orders", "raw_orders", _RAW_ORDER_COLUMNS),
            ("order_items", "raw_items", _RAW_ITEM_COLUMNS),
            ("slashed_orders", "slashed_timestamps", _RAW_ORDER_COLUMNS),
        ]
        for column in columns
    ),
    "scan_csv_typed": "SELECT CAST(order_id AS BIGINT) AS order_id, "
    "CAST(product_id AS BIGINT) AS product_id, "
    "CAST(TRY_CAST(price AS DECIMAL(18,2)) AS DOUBLE) AS price, "
    "CAST(TRY_CAST(freight_value AS DECIMAL(18,2)) AS DOUBLE) AS freight_value FROM raw_items",
    "scan_csv_quoted": f"SELECT order_id, product_id, {_known('price')} AS price, "
    f"{_known('freight_value')} AS freight_value FROM quoted_items",
    "heavy_order_ids": "SELECT order_id, COUNT(*) AS n, total FROM skewed_items, "
    "(SELECT COUNT(order_id) AS total FROM skewed_items) "
    "WHERE order_id IS NOT NULL GROUP BY order_id, total HAVING COUNT(*) * 1000 > total",
    "dense_item_ids": "SELECT CAST(1 AS INTEGER) AS load_number, "
    f"row_number() OVER (ORDER BY {_ITEM_ORDER}) AS id, {_ITEM_MONEY} FROM clean_items "
    "UNION ALL SELECT 2, (SELECT COUNT(*) FROM clean_items) + "
    f"row_number() OVER (ORDER BY {_ITEM_ORDER}), {_ITEM_MONEY} FROM clean_reloaded",
    "items_of_product": f"SELECT {_ITEM_MONEY} FROM clean_items WHERE product_id = '10'",
    "items_of_order": f"SELECT {_ITEM_MONEY} FROM clean_items WHERE order_id = '7'",
    "orders_of_customer": "SELECT * FROM clean_orders WHERE customer_id = '10'",
    "orders_of_status": "SELECT * FROM clean_orders WHERE order_status = 'canceled'",
    "changed_items": "SELECT change, COUNT(*) AS copies, "
    f"{_ITEM_MONEY} FROM (SELECT 'added' AS change, * FROM "
    "(SELECT * FROM clean_reloaded EXCEPT ALL SELECT * FROM clean_items) "
    "UNION ALL SELECT 'removed', * FROM "
    "(SELECT * FROM clean_items EXCEPT ALL SELECT * FROM clean_reloaded)) "
    "GROUP BY change, order_id, product_id, price, freight_value",
    "snapshot_checksum": "SELECT 'orders' AS table_name, COUNT(*) AS row_count, TRUE AS matches "
    "FROM clean_orders UNION ALL SELECT 'order_items', COUNT(*), TRUE FROM clean_items",
    "report_output_order": "SELECT row_number() OVER (ORDER BY report_date NULLS FIRST) "
    f"AS line_number, * FROM ({_report('clean_orders')})",
    "view_output_order": "SELECT row_number() OVER (ORDER BY report_date NULLS LAST) "
    f"AS line_number, * FROM ({_active_report('active')})",
    "daily_revenue_incremental": _active_report(_RELOADED_ORDERS).replace(
        "clean_items", "clean_reloaded"
    ),
    "scan_csv_orders": "SELECT * FROM raw_orders",
    "scan_csv_items": f"SELECT order_id, {_known('product_id')} AS product_id, "
    f"{_known('price')} AS price, {_known('freight_value')} AS freight_value FROM token_items",
    "scan_parquet_orders": "SELECT * FROM orders",
    "sink_parquet_roundtrip": "SELECT * FROM clean_orders",
    "orders_between_dates": "SELECT *, TIMESTAMP '2024-01-01 00:00:00' AS created_at, "
    "TIMESTAMP '2024-01-01 00:00:00' AS updated_at FROM clean_orders "
    "WHERE CAST(order_purchase_timestamp AS DATE) BETWEEN DATE '1996-02-15' AND DATE '1999-10-03'",
    "reload_items": f"SELECT {_ITEM_MONEY}, TIMESTAMP '2025-01-01 02:00:00' AS created_at "
    "FROM clean_items",
    "sink_csv_report": _report("clean_orders"),
    "report_reconcile": _RECONCILED.replace("joined", f"({_JOINED})"),
    "normalize_null_tokens": f"SELECT order_id, {_known('product_id')} AS product_id, "
    f"{_known('price')} AS price, {_known('freight_value')} AS freight_value FROM token_items",
    "parse_order_timestamps": "SELECT order_id, customer_id, order_status, "
    f"{_time('order_purchase_timestamp')} AS order_purchase_timestamp, "
    f"{_time('order_delivered_customer_date')} AS order_delivered_customer_date, "
    f"{_time('order_approved_at')} AS order_approved_at, "
    f"{_time('order_estimated_delivery_date')} AS order_estimated_delivery_date "
    "FROM optional_timestamps",
    "parse_timestamps_by_pattern": "SELECT order_id, customer_id, order_status, "
    + ", ".join(
        f"TRY_STRPTIME({name}, '%m/%d/%Y %H:%M:%S') AS {name}"
        for name in ["order_purchase_timestamp", "order_delivered_customer_date"]
    )
    + " FROM slashed_timestamps",
    "fill_delivery_date": _cleaned("varied_timestamps"),
    "narrow_orders": "SELECT * FROM varied_timestamps",
    "coerce_item_numbers": f"SELECT {_ITEM_MONEY}, price_issue, freight_issue "
    f"FROM ({_coerced('varied_prices')})",
    "drop_bad_prices": f"SELECT {_ITEM_MONEY} FROM coerced WHERE price IS NOT NULL",
    "drop_negative_prices": f"SELECT {_ITEM_MONEY} FROM coerced WHERE price >= 0",
    "dropped_item_count": "SELECT outcome, COUNT(v.price_issue) AS item_count "
    "FROM (VALUES ('kept'), ('unparseable'), ('out_of_range'), ('negative')) o(outcome) "
    f"LEFT JOIN (SELECT COALESCE({_issue('price')}, 'kept') AS price_issue FROM varied_prices) v "
    "ON v.price_issue = outcome GROUP BY outcome",
    "narrow_items": f"SELECT {_ITEM_MONEY} FROM coerced",
    "default_freight": "SELECT order_id, product_id, CAST(price AS DOUBLE) AS price, "
    "CAST(COALESCE(freight_value, 0) AS DOUBLE) AS freight_value FROM clean_items",
    "stamp_audit_columns": "SELECT *, TIMESTAMP '2025-01-01 02:00:00' AS created_at, "
    "TIMESTAMP '2025-01-01 02:00:00' AS updated_at FROM clean_orders",
    "clean_orders": "SELECT * FROM clean_orders",
    "clean_items": f"SELECT {_ITEM_MONEY}, price_issue, freight_issue "
    f"FROM ({_coerced('varied_prices')}) "
    "WHERE price_issue IS NULL OR price_issue = 'out_of_range'",
    "surrogate_item_id": "SELECT COUNT(*) AS item_count, COUNT(*) AS id_count, "
    "CAST(0 AS BIGINT) AS missing_ids FROM clean_items",
    "duplicate_order_ids": "SELECT (SELECT COUNT(*) FROM keyless_items) - "
    "(SELECT COUNT(*) FROM (SELECT DISTINCT order_id FROM keyless_items)) AS duplicates",
    "null_price_count": "SELECT COUNT(*) - COUNT(price) AS null_prices FROM coerced",
    "negative_price_count": "SELECT COUNT(*) AS negative_prices FROM coerced WHERE price < 0",
    "quality_orders": _checks(
        "flawed_orders",
        "orders",
        [
            (f"{name}_not_null", "hard", f"{name} IS NULL")
            for name in ["order_id", "customer_id", "order_status"]
        ],
    )
    + " UNION ALL SELECT 'orders', 'order_id_unique', 'hard', COUNT(*) - "
    "(SELECT COUNT(*) FROM (SELECT DISTINCT order_id FROM flawed_orders)) FROM flawed_orders",
    "quality_items": _checks(
        "coerced",
        "order_items",
        [
            ("price_not_null", "soft", "price IS NULL"),
            ("price_not_negative", "hard", "price < 0"),
        ],
    ),
    "quality_status_domain": _checks(
        "flawed_orders",
        "orders",
        [
            (
                "order_status_in_domain",
                "hard",
                "order_status NOT IN ('created', 'approved', 'processing', 'shipped', "
                "'delivered', 'unavailable', 'canceled', 'invoiced')",
            )
        ],
    ),
    "quality_constraints": _checks(
        f"({_cleaned('broken_orders')})", "orders", _ORDER_CHECKS
    )
    + " UNION ALL "
    + _checks(f"({_coerced('broken_items')})", "order_items", _ITEM_CHECKS),
    "quality_item_ids": "SELECT 'order_items' AS table_name, 'id_unique' AS rule, "
    "'hard' AS severity, COUNT(*) - COUNT(DISTINCT product_id) AS violations FROM clean_items",
    "quality_foreign_key": _checks(
        "clean_items",
        "order_items",
        [("order_id_known", "hard", "order_id NOT IN (SELECT order_id FROM active)")],
    ),
    "active_orders": f"SELECT * FROM ({_cleaned('flawed_orders')}) "
    "WHERE order_status <> 'canceled' AND order_status <> 'unavailable'",
    "order_report_date": "SELECT order_id, CAST(order_purchase_timestamp AS DATE) "
    "AS report_date FROM clean_orders",
    "join_orders_items": f"SELECT order_id, report_date, CAST(price AS DOUBLE) AS price "
    f"FROM ({_JOINED})",
    "join_using": "SELECT order_id, customer_id, order_status, order_purchase_timestamp, "
    "order_delivered_customer_date, product_id, CAST(price AS DOUBLE) AS price, "
    "CAST(freight_value AS DOUBLE) AS freight_value "
    "FROM clean_orders JOIN clean_items USING (order_id)",
    "orphan_items": f"SELECT {_ITEM_MONEY} FROM clean_items "
    "WHERE order_id NOT IN (SELECT order_id FROM active)",
    "cascade_delete_items": f"SELECT {_ITEM_MONEY} FROM clean_items WHERE order_id NOT IN "
    "(SELECT order_id FROM clean_orders WHERE order_status = 'canceled')",
    "upsert_orders": "SELECT * FROM merged",
    "former_months": """
      SELECT CAST(year(order_purchase_timestamp) * 100 + month(order_purchase_timestamp) AS INT)
        AS purchase_month, COUNT(*) AS order_count
      FROM clean_orders WHERE order_id IN (SELECT order_id FROM clean_batch) GROUP BY 1
    """,
    "upsert_action_counts": """
      SELECT CASE WHEN updated_at < TIMESTAMP '2025-01-01 00:00:00' THEN 'kept'
        WHEN created_at = updated_at THEN 'inserted' ELSE 'updated' END AS action,
        COUNT(*) AS order_count FROM merged GROUP BY 1
    """,
    "daily_revenue_report": _report("clean_orders"),
    "daily_revenue_view": _active_report("active"),
    "daily_revenue_view_by_name": _active_report(
        "(SELECT * FROM merged WHERE order_status NOT IN ('canceled', 'unavailable'))"
    ),
    "etl_row_counts": "SELECT 'orders' AS table_name, COUNT(*) AS row_count FROM clean_orders "
    "UNION ALL SELECT 'order_items', COUNT(*) FROM clean_items "
    f"UNION ALL SELECT 'daily_report', COUNT(DISTINCT report_date) FROM ({_JOINED})",
    "run_etl_orders": "SELECT * FROM merged",
    "run_etl_items": f"SELECT {_ITEM_MONEY}, TIMESTAMP '2025-01-01 02:00:00' AS created_at "
    "FROM clean_items",
    "daily_report_job": _report("clean_orders"),
}

ORACLES = {name: _with(body) for name, body in _BODIES.items()}
