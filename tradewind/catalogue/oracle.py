"""DuckDB text of every registered query, over the given tables."""

from __future__ import annotations

from tradewind.schemas import ORDER_TIMESTAMPS, RAW_TABLES, WAREHOUSE_COLUMNS


def _shifted(seconds: str) -> str:
    return f"strftime(o_orderdate + to_seconds({seconds}), '%Y-%m-%d %H:%M:%S')"


_PURCHASE = "(o_orderkey * 7919) % 86400"
_DELIVERY = "(o_orderkey * 31) % 40 * 86400 - 86400 + (o_orderkey * 104729) % 86400"


def _parsed(name: str) -> str:
    return f"try_strptime({name}, '%Y-%m-%d %H:%M:%S') AS {name}"


_PARSED = ", ".join(_parsed(name) for name in ORDER_TIMESTAMPS)

# Named subqueries in dependency order.
CTES: dict[str, str] = {
    "raw_orders": f"""
        SELECT o_orderkey AS order_id, o_custkey AS customer_id,
          CASE o_orderstatus WHEN 'F' THEN 'delivered' WHEN 'O' THEN 'shipped'
            ELSE 'canceled' END AS order_status,
          CASE WHEN o_orderkey % 97 = 0 THEN 'not a date' ELSE {_shifted(_PURCHASE)} END
            AS order_purchase_timestamp,
          {_shifted(_PURCHASE + " + 3600")} AS order_approved_at,
          {_shifted(_PURCHASE + " + 86400")} AS order_delivered_carrier_date,
          CASE WHEN o_orderkey % 53 = 0 THEN NULL ELSE {_shifted(_DELIVERY)} END
            AS order_delivered_customer_date,
          {_shifted("20 * 86400")} AS order_estimated_delivery_date
        FROM orders""",
    "raw_customers": """
        SELECT c_custkey AS customer_id,
          CASE WHEN c_custkey % 5 = 4 THEN c_custkey - 1 ELSE c_custkey END AS customer_unique_id,
          CAST(c_nationkey * 1000 + 7 AS INTEGER) AS customer_zip_code_prefix,
          c_mktsegment AS customer_city,
          CASE WHEN c_custkey % 101 = 0 THEN NULL ELSE n_name END AS customer_state
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "raw_order_items": """
        SELECT l_orderkey AS order_id, l_linenumber AS order_item_id, l_partkey AS product_id,
          l_suppkey AS seller_id, CAST(l_extendedprice AS DECIMAL(18,4)) AS price,
          CAST(CAST(l_extendedprice AS DECIMAL(12,2)) * CAST(l_tax AS DECIMAL(4,2))
            AS DECIMAL(18,4)) AS freight_value
        FROM lineitem""",
    "raw_products": """
        SELECT p_partkey AS product_id,
          CASE WHEN p_partkey % 53 = 0 THEN NULL ELSE p_type END AS product_category_name
        FROM part""",
    "raw_category_translation": """
        SELECT * FROM (VALUES ('ECONOMY', 'economy goods'), ('LARGE', 'large goods'),
          ('MEDIUM', 'medium goods'), ('PROMO', 'promotional goods'))
          AS t(product_category_name, product_category_name_english)""",
    "raw_order_payments": """
        SELECT l_orderkey AS order_id,
          row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS payment_sequential,
          CASE l_returnflag WHEN 'A' THEN 'credit_card' WHEN 'R' THEN 'voucher' END
            AS payment_type,
          l_linenumber AS payment_installments,
          CASE WHEN l_orderkey % 41 = 0 THEN NULL
            ELSE CAST(l_extendedprice AS DECIMAL(18,4)) END AS payment_value
        FROM lineitem""",
    "clean_orders": f"""
        SELECT *, CAST(order_purchase_timestamp AS DATE) AS order_date
        FROM (SELECT * REPLACE ({_PARSED}) FROM raw_orders WHERE order_status = 'delivered')""",
    "products": """
        SELECT product_id, product_category_name,
          coalesce(product_category_name_english, product_category_name) AS category_english
        FROM raw_products LEFT JOIN raw_category_translation USING (product_category_name)""",
    "payments": """
        SELECT order_id,
          arg_min(payment_type, payment_sequential) FILTER (WHERE payment_type IS NOT NULL)
            AS payment_type,
          max(payment_installments) AS payment_installments,
          coalesce(sum(payment_value), 0) AS payment_value
        FROM raw_order_payments WHERE order_id IS NOT NULL GROUP BY order_id""",
    "master": """
        SELECT *, price + freight_value AS revenue
        FROM clean_orders
        LEFT JOIN raw_customers USING (customer_id)
        LEFT JOIN raw_order_items USING (order_id)
        LEFT JOIN products USING (product_id)
        LEFT JOIN payments USING (order_id)""",
    "delivery": """
        SELECT *, CAST(floor((epoch_us(order_delivered_customer_date)
            - epoch_us(order_purchase_timestamp)) / 86400000000.0) AS BIGINT) AS delivery_days
        FROM clean_orders""",
    "lines": """
        SELECT order_item_id, order_id, product_id, seller_id, customer_id, order_date,
          category_english, price, freight_value, price + freight_value AS revenue, order_status
        FROM raw_order_items
        LEFT JOIN (SELECT order_id, customer_id, order_date, order_status FROM clean_orders)
          USING (order_id)
        LEFT JOIN (SELECT product_id, category_english FROM products) USING (product_id)""",
    "by_date": """
        SELECT order_date, count(DISTINCT order_id) AS total_orders,
          count(order_item_id) AS total_items,
          CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS total_revenue,
          CAST(sum(payment_value) AS DOUBLE) / count(payment_value) AS avg_order_value
        FROM master WHERE order_date IS NOT NULL GROUP BY order_date""",
    "by_product": """
        SELECT product_id, category_english, count(order_item_id) AS total_items_sold,
          CAST(coalesce(sum(revenue), 0) AS DOUBLE) AS total_revenue,
          CAST(sum(price) AS DOUBLE) / count(price) AS avg_price
        FROM master WHERE product_id IS NOT NULL AND category_english IS NOT NULL
        GROUP BY product_id, category_english""",
    "by_customer": """
        SELECT customer_unique_id, customer_city, customer_state,
          count(DISTINCT order_id) AS total_orders,
          CAST(coalesce(sum(payment_value), 0) AS DOUBLE) AS total_spent,
          min(order_date) AS first_order, max(order_date) AS last_order
        FROM master
        WHERE customer_unique_id IS NOT NULL AND customer_city IS NOT NULL
          AND customer_state IS NOT NULL
        GROUP BY customer_unique_id, customer_city, customer_state""",
    "by_state": """
        SELECT customer_state, count(order_id) AS total_orders,
          CAST(sum(delivery_days) AS DOUBLE) / count(delivery_days) AS avg_delivery_days,
          min(delivery_days) AS min_delivery_days, max(delivery_days) AS max_delivery_days
        FROM delivery LEFT JOIN raw_customers USING (customer_id)
        WHERE customer_state IS NOT NULL GROUP BY customer_state""",
    "daily_revenue": """
        SELECT order_date, total_orders, total_items,
          round_even(total_revenue * 100, 0) / 100 AS total_revenue,
          round_even(avg_order_value * 100, 0) / 100 AS avg_order_value
        FROM by_date""",
    "top_products": """
        SELECT product_id, category_english, total_items_sold,
          round_even(total_revenue * 100, 0) / 100 AS total_revenue,
          round_even(avg_price * 100, 0) / 100 AS avg_price
        FROM by_product""",
    "customer_summary": """
        SELECT * REPLACE (round_even(total_spent * 100, 0) / 100 AS total_spent)
        FROM by_customer""",
    "delivery_performance": """
        SELECT * REPLACE (round_even(avg_delivery_days * 10, 0) / 10 AS avg_delivery_days)
        FROM by_state""",
    "fact_order_items": """
        SELECT * REPLACE (CAST(price AS DOUBLE) AS price,
          CAST(freight_value AS DOUBLE) AS freight_value, CAST(revenue AS DOUBLE) AS revenue)
        FROM lines""",
    "dim_customers": """
        SELECT customer_id, customer_unique_id, customer_city, customer_state,
          customer_zip_code_prefix
        FROM raw_customers
        QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_id NULLS LAST,
          customer_city NULLS LAST, customer_state NULLS LAST,
          customer_zip_code_prefix NULLS LAST) = 1""",
    "dim_products": """
        SELECT product_id, category_english FROM products
        QUALIFY row_number() OVER (PARTITION BY product_id
          ORDER BY category_english NULLS LAST) = 1""",
    "spine": """
        SELECT CAST(unnest(generate_series(min(order_purchase_timestamp),
          max(order_purchase_timestamp), INTERVAL 1 DAY)) AS DATE) AS date
        FROM clean_orders""",
    "dim_date": """
        SELECT date, CAST(day(date) AS INTEGER) AS day, CAST(month(date) AS INTEGER) AS month,
          monthname(date) AS month_name, CAST(quarter(date) AS INTEGER) AS quarter,
          CAST(year(date) AS INTEGER) AS year,
          CAST(isodow(date) - 1 AS INTEGER) AS day_of_week, dayname(date) AS day_name,
          isodow(date) >= 6 AS is_weekend
        FROM spine""",
}


def with_ctes(select: str) -> str:
    """A statement over the named subqueries."""
    named = ",\n".join(f"{name} AS ({body})" for name, body in CTES.items())
    return f"WITH {named}\n{select}"


def row_counts(tables: tuple[str, ...]) -> str:
    """Row count of each named subquery."""
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {name}" for name in tables
    )


def _duplicates(name: str, keys: str) -> str:
    return (
        f"SELECT 'unique {name}' AS check_name, count(*) AS violations"
        f" FROM (SELECT {keys} FROM {name} GROUP BY {keys} HAVING count(*) > 1)"
    )


def _orphans(column: str, dimension: str, key: str) -> str:
    return (
        f"SELECT 'fact {column} in {dimension}' AS check_name, count(DISTINCT {column})"
        f" AS violations FROM fact_order_items WHERE {column} IS NOT NULL"
        f" AND {column} NOT IN (SELECT {key} FROM {dimension} WHERE {key} IS NOT NULL)"
    )


def _duplicate_inputs(label: str, name: str, key: str) -> str:
    return (
        f"SELECT 'duplicate {label}' AS check_name, count(*) AS violations FROM"
        f" (SELECT {key} FROM {name} WHERE {key} IS NOT NULL GROUP BY {key} HAVING count(*) > 1)"
    )


_ORPHANS = [
    _orphans("product_id", "dim_products", "product_id"),
    _orphans("customer_id", "dim_customers", "customer_id"),
    _orphans("order_date", "dim_date", "date"),
]
_CHECKS = " UNION ALL ".join(
    [
        _duplicates("daily_revenue", "order_date"),
        _duplicates("top_products", "product_id, category_english"),
        _duplicates("customer_summary", "customer_unique_id, customer_city, customer_state"),
        _duplicates("delivery_performance", "customer_state"),
        _duplicates("fact_order_items", "order_id, order_item_id"),
        _duplicates("dim_customers", "customer_unique_id"),
        _duplicates("dim_products", "product_id"),
        _duplicates("dim_date", "date"),
        *_ORPHANS,
    ]
)

_ITEM_COLUMNS = (
    "order_id, order_item_id, product_id, seller_id, "
    "CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value"
)
_PAYMENT_COLUMNS = (
    "order_id, payment_type, payment_installments, CAST(payment_value AS DOUBLE) AS payment_value"
)

# Statements over the named subqueries, by registered query.
SELECTS: dict[str, str] = {
    "s1_csv_scan": """
        SELECT CAST(order_id AS VARCHAR) AS order_id, order_item_id,
          CAST(product_id AS VARCHAR) AS product_id, CAST(seller_id AS VARCHAR) AS seller_id,
          CAST(price AS DOUBLE) AS price, CAST(freight_value AS DOUBLE) AS freight_value
        FROM raw_order_items""",
    "s1_csv_inferred": "SELECT product_id, product_category_name FROM raw_products",
    "s1_quoted_breaks": """
        SELECT CAST(product_id AS VARCHAR) AS product_id,
          replace(product_category_name, ' ', chr(10)) AS product_category_name
        FROM raw_products""",
    "s1_split_breaks": """
        SELECT CAST(product_id AS VARCHAR) AS product_id,
          replace(product_category_name, ' ', chr(10)) AS product_category_name
        FROM raw_products""",
    "s1_bad_cells": " UNION ALL ".join(
        f"SELECT 'raw_order_items' AS table_name, '{column}' AS column_name,"
        f" count(*) AS bad_cells FROM raw_order_items WHERE order_id % {n} = 0"
        for column, n in (("price", 101), ("freight_value", 103), ("order_item_id", 107))
    ),
    "s2_orders": """
        SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id,
          CAST(customer_id AS VARCHAR) AS customer_id) FROM raw_orders""",
    "s2_customers": """
        SELECT * REPLACE (CAST(customer_id AS VARCHAR) AS customer_id,
          CAST(customer_unique_id AS VARCHAR) AS customer_unique_id,
          CAST(customer_zip_code_prefix AS VARCHAR) AS customer_zip_code_prefix)
        FROM raw_customers""",
    "s2_payments": f"""
        SELECT * REPLACE (CAST(order_id AS VARCHAR) AS order_id)
        FROM (SELECT {_PAYMENT_COLUMNS} FROM raw_order_payments)""",
    "s2_any_manifest": """
        SELECT s_suppkey AS seller_id, s_name AS seller_name,
          CAST(s_nationkey AS BIGINT) AS seller_nation FROM supplier""",
    "s2_ingest_manifest": row_counts(tuple(RAW_TABLES)),
    "s3_skip_missing": row_counts(tuple(t for t in RAW_TABLES if t != "raw_order_payments")),
    "s4_raw_replace": f"SELECT {_PAYMENT_COLUMNS} FROM raw_order_payments",
    "s5_orders_scan": "SELECT * FROM raw_orders",
    "s5_customers_scan": "SELECT * FROM raw_customers",
    "s5_items_scan": f"SELECT {_ITEM_COLUMNS} FROM raw_order_items",
    "s5_payments_scan": f"SELECT {_PAYMENT_COLUMNS} FROM raw_order_payments",
    "s6_products_query": "SELECT * FROM products",
    "s6_products_sql": "SELECT * FROM products",
    "s7_warehouse_replace": "SELECT * FROM delivery_performance",
    "s8_publish": row_counts(tuple(WAREHOUSE_COLUMNS)),
    "s11_extract_bundle": """
        SELECT 'orders' AS table_name, count(*) AS row_count FROM raw_orders
        UNION ALL SELECT 'customers', count(*) FROM raw_customers
        UNION ALL SELECT 'order_items', count(*) FROM raw_order_items
        UNION ALL SELECT 'products', count(*) FROM products
        UNION ALL SELECT 'payments', count(*) FROM raw_order_payments""",
    "p1_coerce_timestamps": f"SELECT order_id, {_PARSED} FROM raw_orders",
    "p2_only_delivered": "SELECT * FROM raw_orders WHERE order_status = 'delivered'",
    "p3_order_date": "SELECT order_id, order_date FROM clean_orders",
    "p4a_master_revenue": """
        SELECT order_id, order_item_id, product_id, CAST(revenue AS DOUBLE) AS revenue
        FROM master""",
    "p4b_fact_revenue": """
        SELECT order_id, order_item_id, product_id, CAST(revenue AS DOUBLE) AS revenue
        FROM lines""",
    "p5_delivery_days": "SELECT order_id, delivery_days FROM delivery",
    "p6_fact_projection": "SELECT * FROM fact_order_items",
    "p7_round_two_digits": """
        SELECT order_id, round_even(CAST(payment_value AS DOUBLE) * 100, 0) / 100 AS paid
        FROM payments""",
    "p7_round_one_digit": """
        SELECT order_id, round_even(CAST(payment_value AS DOUBLE) * 10, 0) / 10 AS paid
        FROM payments""",
    "j1_category_lookup": """
        SELECT product_id, product_category_name, product_category_name_english
        FROM raw_products LEFT JOIN raw_category_translation USING (product_category_name)""",
    "j2_orders_customers": """
        SELECT order_id, customer_id, customer_unique_id, customer_city, customer_state
        FROM clean_orders LEFT JOIN raw_customers USING (customer_id)""",
    "j3_orders_items": f"""
        SELECT customer_id, {_ITEM_COLUMNS}
        FROM clean_orders LEFT JOIN raw_order_items USING (order_id)""",
    "j4_items_products": """
        SELECT order_id, order_item_id, product_id, category_english
        FROM clean_orders LEFT JOIN raw_order_items USING (order_id)
        LEFT JOIN products USING (product_id)""",
    "j5_payments_join": f"""
        SELECT customer_id, {_PAYMENT_COLUMNS}
        FROM clean_orders LEFT JOIN payments USING (order_id)""",
    "j6_delivery_customers": """
        SELECT order_id, delivery_days, customer_state
        FROM delivery LEFT JOIN raw_customers USING (customer_id)""",
    "j7_items_orders": f"""
        SELECT {_ITEM_COLUMNS}, customer_id, order_date, order_status
        FROM raw_order_items
        LEFT JOIN (SELECT order_id, customer_id, order_date, order_status FROM clean_orders)
          USING (order_id)""",
    "j8_fact_products": """
        SELECT order_id, order_item_id, product_id, category_english FROM lines""",
    "a1_payments_per_order": f"SELECT {_PAYMENT_COLUMNS} FROM payments",
    "a2_by_date": "SELECT * FROM by_date",
    "a3_by_product": "SELECT * FROM by_product",
    "a4_by_customer": "SELECT * FROM by_customer",
    "a5_by_state": "SELECT * FROM by_state",
    "a6_timestamp_bounds": """
        SELECT min(order_purchase_timestamp) AS min_ts, max(order_purchase_timestamp) AS max_ts
        FROM clean_orders""",
    "a7_dedupe_customers": "SELECT * FROM dim_customers",
    "a7_first_by_recorded_order": """
        SELECT * FROM raw_customers
        QUALIFY row_number() OVER (PARTITION BY customer_unique_id ORDER BY customer_id DESC) = 1""",
    "a8_dedupe_products": "SELECT * FROM dim_products",
    "a8_dedupe_repeated_products": """
        SELECT product_id % 97 AS product_id, category_english FROM products
        QUALIFY row_number() OVER (PARTITION BY product_id % 97
          ORDER BY category_english NULLS LAST) = 1""",
    "a9_row_counts": row_counts(tuple(WAREHOUSE_COLUMNS)),
    "o1_sorted_by_date": "SELECT * FROM daily_revenue ORDER BY order_date",
    "o2_sorted_by_revenue": "SELECT * FROM top_products ORDER BY total_revenue DESC, product_id",
    "o3_sorted_by_spending": """
        SELECT * FROM customer_summary
        ORDER BY total_spent DESC, customer_unique_id, customer_city, customer_state""",
    "o4_sorted_by_days": """
        SELECT * FROM delivery_performance ORDER BY avg_delivery_days NULLS LAST, customer_state""",
    "o5_top5_products": """
        SELECT * FROM top_products
        ORDER BY total_revenue DESC, product_id, category_english LIMIT 5""",
    "o5_first5_days": "SELECT * FROM daily_revenue ORDER BY order_date LIMIT 5",
    "o5_first3_orders": "SELECT * FROM raw_orders ORDER BY order_id LIMIT 3",
    "g1_date_spine": "SELECT * FROM spine",
    "g2_calendar": "SELECT * FROM dim_date",
    "c1_clean_orders": "SELECT * FROM clean_orders",
    "c2_payments_per_order": f"SELECT {_PAYMENT_COLUMNS} FROM payments",
    "c3_master": """
        SELECT * REPLACE (CAST(price AS DOUBLE) AS price,
          CAST(freight_value AS DOUBLE) AS freight_value,
          CAST(payment_value AS DOUBLE) AS payment_value, CAST(revenue AS DOUBLE) AS revenue)
        FROM master""",
    "c3_master_in_buckets": """
        SELECT * REPLACE (CAST(price AS DOUBLE) AS price,
          CAST(freight_value AS DOUBLE) AS freight_value,
          CAST(payment_value AS DOUBLE) AS payment_value, CAST(revenue AS DOUBLE) AS revenue)
        FROM master""",
    "c4_products": "SELECT * FROM products",
    "t1_daily_revenue": "SELECT * FROM daily_revenue",
    "t1_daily_revenue_from_master": "SELECT * FROM daily_revenue",
    "t2_top_products": "SELECT * FROM top_products",
    "t2_top_products_from_master": "SELECT * FROM top_products",
    "t3_customer_summary": "SELECT * FROM customer_summary",
    "t3_customer_summary_from_master": "SELECT * FROM customer_summary",
    "t4_delivery_performance": "SELECT * FROM delivery_performance",
    "t1_daily_revenue_in_buckets": "SELECT * FROM daily_revenue",
    "t5_fact_order_items": "SELECT * FROM fact_order_items",
    "t5_fact_in_buckets": "SELECT * FROM fact_order_items",
    "x1_daily_revenue": "SELECT * FROM daily_revenue",
    "x1_customer_summary": "SELECT * FROM customer_summary",
    "t5_fact_of_weekends": """
        SELECT order_date, day_name, count(*) AS items,
          round_even(CAST(sum(CAST(revenue AS DECIMAL(18,4))) AS DOUBLE) * 100, 0) / 100 AS revenue
        FROM fact_order_items JOIN dim_date ON order_date = date
        WHERE year = 1995 AND quarter = 2 AND is_weekend
        GROUP BY order_date, day_name""",
    "t6_dim_customers": "SELECT * FROM dim_customers",
    "t7_dim_products": "SELECT * FROM dim_products",
    "t8_dim_date": "SELECT * FROM dim_date",
    "b1_refresh": row_counts(tuple(WAREHOUSE_COLUMNS)),
    "b2_run_report": f"""
        SELECT table_name, row_count, 'succeeded' AS status FROM ({row_counts(tuple(WAREHOUSE_COLUMNS))})""",
    "b2_run_checks": " UNION ALL ".join(
        [
            _duplicate_inputs("orders", "clean_orders", "order_id"),
            _duplicate_inputs("customers", "raw_customers", "customer_id"),
            _duplicate_inputs("products", "products", "product_id"),
            _duplicates("fact_order_items", "order_id, order_item_id"),
            *_ORPHANS,
        ]
    ),
    "q1_key_checks": _CHECKS,
} | {f"b1_{name}": f"SELECT * FROM {name}" for name in WAREHOUSE_COLUMNS}


def oracle_sql() -> dict[str, str]:
    """Complete DuckDB statement of every registered query."""
    return {name: with_ctes(select) for name, select in SELECTS.items()}
