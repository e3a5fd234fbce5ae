"""The expected result of each query, as SQL over the same test tables."""

from __future__ import annotations

import re

OPEN = "DATE '9999-12-31'"
MS_PER_DAY = "86400000"

# Inputs, the same as in recipes.py

ORDER_HEADER = """
  SELECT o_orderkey AS order_id,
    CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS customer_id,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS order_date,
    CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'failed' END AS payment_status
  FROM orders"""

PRICE = """CAST(CAST(l_extendedprice AS DECIMAL(12,2))
      + CAST(l_linenumber % 4 AS DECIMAL(9,0)) * CAST('0.00000123' AS DECIMAL(9,8)) AS DOUBLE)"""

ORDER_LINES = f"""
  SELECT concat(CAST(order_id AS VARCHAR), '_', CAST(l_partkey AS VARCHAR)) AS order_line_id,
    order_id, customer_id, order_date, payment_status, l_partkey AS product_id,
    CAST(l_quantity AS BIGINT) AS sales_quantity,
    {PRICE} AS price_per_unit
  FROM lineitem JOIN order_header ON l_orderkey = order_id"""

ACCOUNTS = """
  SELECT id, n_name, DATE '2020-01-01' + CAST(abs(id) % 1000 AS INTEGER) AS registered
  FROM (SELECT c_custkey AS id, c_nationkey AS nation_key FROM customer
        UNION ALL SELECT -1 - s_suppkey, s_nationkey FROM supplier)
  JOIN nation ON n_nationkey = nation_key"""

CUSTOMERS = f"""
  SELECT CAST(id AS BIGINT) AS customer_id, CAST(18 + abs(id) % 60 AS INTEGER) AS age,
    CASE WHEN abs(id) % 2 = 0 THEN 'F' ELSE 'M' END AS gender, n_name AS city,
    CAST(registered - DATE '1970-01-01' AS BIGINT) * {MS_PER_DAY} AS registration_date
  FROM accounts"""

PRODUCTS_FIRST = """
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_type AS category, p_brand AS sub_category,
    CASE WHEN p_size <> 13 THEN CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS product_price,
    p_name AS product_description
  FROM part
  UNION ALL
  SELECT CAST(-1 - s_suppkey AS BIGINT), 'SERVICE', 'none',
    CAST(CAST(abs(s_acctbal) AS DECIMAL(12,2)) AS VARCHAR), s_name
  FROM supplier"""

PRODUCTS_SECOND = """
  SELECT CAST(p_partkey AS BIGINT) AS product_id, p_type AS category, p_brand AS sub_category,
    CASE WHEN p_size = 17 THEN NULL
         WHEN p_size = 7 THEN CAST(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(13,3)) AS VARCHAR)
         WHEN p_brand = 'Brand#13' THEN CAST(CAST(CAST(p_retailprice AS DECIMAL(12,2)) + 1 AS DECIMAL(12,2)) AS VARCHAR)
         ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR) END AS product_price,
    CASE WHEN p_size = 21 THEN concat(p_name, ' v2') ELSE p_name END AS product_description
  FROM part
  UNION ALL
  SELECT CAST(-10000000000 - c_custkey AS BIGINT), 'OFFER', c_mktsegment,
    CAST(CAST(abs(c_acctbal) AS DECIMAL(12,2)) AS VARCHAR), c_name
  FROM customer"""

LOGISTICS = f"""
  SELECT CAST(o_orderkey AS BIGINT) AS order_id,
    CASE WHEN o_orderstatus = 'O' AND o_orderpriority = '5-LOW' THEN NULL
         ELSE base + (o_orderkey * 7919 % 15) * {MS_PER_DAY} + (o_orderkey % 24) * 3600000
    END AS actual_delivery_date,
    base + 7 * {MS_PER_DAY} AS estimated_delivery_date,
    CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS VARCHAR) AS shipping_cost,
    CAST(nullif(o_orderkey % 11, 10) AS INTEGER) AS warehouse_id
  FROM (SELECT *, CAST(CAST(o_orderdate AS DATE) - DATE '1970-01-01' AS BIGINT) * {MS_PER_DAY} AS base
        FROM orders)"""

SPOILT_LINES = """
  SELECT order_line_id, CASE WHEN order_id % 50 = 11 THEN 'unknown' ELSE order_date END AS order_date,
    CASE WHEN order_id % 50 = 13 THEN CAST('1e300' AS DOUBLE) ELSE price_per_unit END AS price_per_unit,
    order_id % 50 IN (11, 13) AS unusable
  FROM order_lines WHERE order_id % 50 <> 7"""

# Operators

RFM_BASE = """
  SELECT customer_id, max(CAST(order_date AS DATE)) AS last_purchase_date,
    count(DISTINCT order_id) AS frequency,
    sum(CAST(sales_quantity AS DECIMAL(10,0)) * CAST(price_per_unit AS DECIMAL(26,10))) AS monetary,
    CAST(DATE '2025-10-01' - max(CAST(order_date AS DATE)) AS INTEGER) AS recency
  FROM order_lines GROUP BY customer_id"""

RFM = """
  SELECT *, CAST(r_score + f_score + m_score AS INTEGER) AS RFM_Score
  FROM (SELECT customer_id, last_purchase_date, frequency, recency,
      round(CAST(monetary AS DOUBLE), 2) AS monetary,
      CAST(ntile(5) OVER (ORDER BY recency ASC NULLS FIRST, customer_id NULLS FIRST) AS INTEGER) AS r_score,
      CAST(ntile(5) OVER (ORDER BY frequency DESC NULLS LAST, customer_id NULLS FIRST) AS INTEGER) AS f_score,
      CAST(ntile(5) OVER (ORDER BY monetary DESC NULLS LAST, customer_id NULLS FIRST) AS INTEGER) AS m_score
    FROM rfm_base)"""

DIM_CUSTOMER = """
  SELECT CAST(row_number() OVER (ORDER BY c.customer_id) - 1 AS BIGINT) AS cust_key,
    c.customer_id, age, gender, city, registration_date, CAST(RFM_Score AS BIGINT) AS RFM_Score
  FROM customers c LEFT JOIN rfm r ON r.customer_id = c.customer_id"""

FACTS = f"""
  SELECT order_id, delivery_time_delta_days,
    coalesce(delivery_time_delta_days > 0, FALSE) AS is_late_delivery, shipping_cost, warehouse_id
  FROM (SELECT *, CAST(actual_delivery_date // {MS_PER_DAY}
                     - estimated_delivery_date // {MS_PER_DAY} AS INTEGER) AS delivery_time_delta_days
        FROM logistics)"""

ATTRIBUTES = "product_id, category, sub_category, product_price, product_description"


def _merge(dim: str, snapshot: str, run_date: str, policy: str) -> dict[str, str]:
    """Views for one merge; the last, `<dim>_next`, is the result with its actions."""
    day = f"DATE '{run_date}'"
    old = ", ".join(f"o.{c} AS {c}" for c in ATTRIBUTES.split(", "))
    new = ", ".join(f"n.{c} AS {c}" for c in ATTRIBUTES.split(", "))
    if policy == "safe":
        number = "CAST({}.product_price AS DECIMAL(38,18))"
        same = f"{number.format('o')} IS NOT DISTINCT FROM {number.format('n')}"
    else:
        same = "o.product_price = n.product_price"
    both = f"{dim}_open o JOIN {snapshot} n ON o.product_id = n.product_id"
    kept = [
        f"SELECT o.product_key, {old}, o.dw_start_date, o.dw_end_date, 'unchanged' AS action FROM {both} WHERE {same}",
        f"SELECT o.product_key, {old}, o.dw_start_date, {day}, 'expired' FROM {both} WHERE NOT ({same})",
    ]
    if policy == "safe":
        gone = f"WHERE NOT EXISTS (SELECT 1 FROM {snapshot} n WHERE n.product_id = o.product_id)"
        kept += [
            f"SELECT o.product_key, {old}, o.dw_start_date, {day}, 'expired' FROM {dim}_open o {gone}",
            f"SELECT product_key, {ATTRIBUTES}, dw_start_date, dw_end_date, 'history' FROM {dim} "
            f"WHERE dw_end_date <> {OPEN}",
        ]
    inserted = (
        f"SELECT {new}, 'new_version' AS action FROM {both} WHERE NOT ({same}) UNION ALL "
        f"SELECT {new}, 'new' FROM {snapshot} n "
        f"WHERE NOT EXISTS (SELECT 1 FROM {dim}_open o WHERE o.product_id = n.product_id)"
    )
    keyed = (
        f"SELECT CAST((SELECT coalesce(max(product_key), -1) FROM {dim}) "
        f"+ row_number() OVER (ORDER BY product_id) AS BIGINT) AS product_key, {ATTRIBUTES}, "
        f"{day} AS dw_start_date, {OPEN} AS dw_end_date, action FROM {dim}_inserted"
    )
    return {
        f"{dim}_open": f"SELECT * FROM {dim} WHERE dw_end_date = {OPEN}",
        f"{dim}_inserted": inserted,
        f"{dim}_next": " UNION ALL ".join([*kept, keyed]),
    }


def _versions(policy: str) -> dict[str, str]:
    """Views v1, v2, v3: the dimension after each of three runs; v2_next holds actions."""
    columns = f"product_key, {ATTRIBUTES}, dw_start_date, dw_end_date"
    first = (
        f"SELECT CAST(row_number() OVER (ORDER BY product_id) - 1 AS BIGINT) AS product_key, {ATTRIBUTES}, "
        f"DATE '2025-01-01' AS dw_start_date, {OPEN} AS dw_end_date FROM products_first"
    )
    return {
        "v1": first,
        **_merge("v1", "products_second", "2025-01-02", policy),
        "v2": f"SELECT {columns} FROM v1_next",
        **_merge("v2", "products_first", "2025-01-03", policy),
        "v3": f"SELECT {columns} FROM v2_next",
    }


VIEWS = {
    "order_header": ORDER_HEADER,
    "order_lines": ORDER_LINES,
    "accounts": ACCOUNTS,
    "customers": CUSTOMERS,
    "products_first": PRODUCTS_FIRST,
    "products_second": PRODUCTS_SECOND,
    "spoilt_lines": SPOILT_LINES,
    "logistics": LOGISTICS,
    "rfm_base": RFM_BASE,
    "rfm": RFM,
    "dim_customer": DIM_CUSTOMER,
    "facts": FACTS,
    "items": "SELECT l_orderkey AS order_id, l_partkey AS product_id, "
    f"CAST(l_quantity AS BIGINT) AS sales_quantity, {PRICE} AS price_per_unit FROM lineitem",
}


def _with(select: str, policy: str = "safe") -> str:
    """`select` preceded by the views it uses, directly or through other views."""
    views = VIEWS | _versions(policy)
    used: set[str] = set()
    texts = [select]
    while texts:
        words = set(re.findall(r"\w+", texts.pop()))
        fresh = {name for name in views if name in words} - used
        used |= fresh
        texts += [views[name] for name in fresh]
    clauses = ",\n".join(f"{name} AS ({sql})" for name, sql in views.items() if name in used)
    return f"WITH {clauses}\n{select}" if clauses else select


PAIRS = """
SELECT n.product_id AS new_id, n.product_price AS new_price, o.product_id AS old_id, o.product_price AS old_price
FROM products_second n {how} JOIN products_first o ON n.product_id = o.product_id {where}"""

PER_WAREHOUSE = """
SELECT warehouse_id, round(avg(delivery_time_delta_days), 6) AS avg_delivery_delta {more}
FROM facts GROUP BY warehouse_id"""

DOCUMENTS = """
SELECT h.order_id, customer_id, order_date, payment_status,
  CASE WHEN count(i.order_id) > 0 THEN CAST(count(i.order_id) AS BIGINT)
       WHEN payment_status <> 'pending' THEN 0 END AS n_items,
  CASE WHEN count(i.order_id) > 0 THEN string_agg(item, ',' ORDER BY item)
       WHEN payment_status <> 'pending' THEN '' END AS item_list
FROM order_header h LEFT JOIN (
  SELECT order_id, concat_ws(':', product_id, sales_quantity, CAST(price_per_unit AS DECIMAL(20,8))) AS item
  FROM order_lines) i ON i.order_id = h.order_id
GROUP BY h.order_id, customer_id, order_date, payment_status"""

SIMPLE = {
    "json_orders_scan": DOCUMENTS,
    "json_orders_inferred_scan": DOCUMENTS,
    "json_orders_multiline_scan": DOCUMENTS,
    "staged_orders_scan": DOCUMENTS,
    "customers_scan": "SELECT * FROM customers",
    "order_lines_scan": "SELECT * FROM order_lines",
    "products_scan": "SELECT * FROM products_first",
    "logistics_scan": "SELECT * FROM logistics",
    "customers_snapshot": "SELECT * FROM customers",
    "products_snapshot": "SELECT product_id, category, sub_category, product_price AS current_price, "
    "product_description AS description FROM products_first",
    "logistics_snapshot": "SELECT * FROM logistics",
    "snapshot_type_mapping": f"""
      SELECT l_orderkey, CAST(CAST(l_shipdate AS DATE) - DATE '1970-01-01' AS BIGINT) * {MS_PER_DAY} AS ship_day,
        epoch_ms(l_shipdate) + CAST(round(l_tax * 1000) AS BIGINT) AS ship_time,
        CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS VARCHAR) AS price,
        l_quantity, l_discount > 0.05 AS discounted, l_returnflag
      FROM lineitem""",
    "orders_stage_roundtrip": "SELECT * FROM order_lines",
    "order_lines_roundtrip": "SELECT * FROM order_lines",
    "dim_customer_roundtrip": "SELECT * FROM dim_customer",
    "scd2_publish_roundtrip": "SELECT * FROM v3",
    "fact_logistics_roundtrip": "SELECT * FROM facts",
    "ext_staging_orderlines": "SELECT * FROM order_lines",
    "ext_dim_customer": "SELECT * FROM dim_customer",
    "ext_dim_products": "SELECT * FROM v1",
    "ext_fact_logistics": "SELECT * FROM facts",
    "ext_drop_recreate": "SELECT * FROM customers",
    "project_columns": "SELECT order_id, product_id AS item, price_per_unit FROM order_lines",
    "computed_columns": "SELECT order_line_id, round(sales_quantity * price_per_unit, 2) AS amount, "
    "CAST(order_date AS DATE) AS order_day FROM order_lines",
    "rename_columns": "SELECT * FROM products_second",
    "nested_field_access": "SELECT order_id, product_id, sales_quantity FROM items",
    "typed_literals": f"SELECT product_id, CAST(NULL AS BIGINT) AS product_key, "
    f"DATE '2025-10-01' AS dw_start_date, {OPEN} AS dw_end_date, '_' AS separator FROM products_first",
    "scd2_current_rows": f"SELECT * FROM v2 WHERE dw_end_date = {OPEN}",
    "filter_null_checks": "SELECT * FROM logistics WHERE actual_delivery_date IS NOT NULL AND warehouse_id IS NULL",
    "filter_unmatched": PAIRS.format(how="LEFT", where="WHERE o.product_id IS NULL"),
    "filter_equal_3vl": PAIRS.format(how="", where="WHERE n.product_price = o.product_price"),
    "filter_notequal_3vl": PAIRS.format(how="", where="WHERE n.product_price <> o.product_price"),
    "join_left_outer": "SELECT c.customer_id, city, frequency, recency "
    "FROM customers c LEFT JOIN rfm_base r ON r.customer_id = c.customer_id",
    "join_left_outer_null_keys": "SELECT order_line_id, l.customer_id, sales_quantity, city "
    "FROM order_lines l LEFT JOIN customers c ON c.customer_id = l.customer_id",
    "join_full_outer": PAIRS.format(how="FULL", where=""),
    "join_matched_inner": PAIRS.format(how="INNER", where=""),
    "join_new_only_anti": "SELECT * FROM products_second n WHERE NOT EXISTS "
    "(SELECT 1 FROM products_first o WHERE o.product_id = n.product_id)",
    "agg_last_purchase": "SELECT customer_id, last_purchase_date FROM rfm_base",
    "agg_order_frequency": "SELECT customer_id, frequency FROM rfm_base",
    "agg_monetary": "SELECT customer_id, round(CAST(monetary AS DOUBLE), 2) AS monetary FROM rfm_base",
    "rfm_base": "SELECT customer_id, last_purchase_date, frequency, "
    "round(CAST(monetary AS DOUBLE), 2) AS monetary, recency FROM rfm_base",
    "avg_delay_per_warehouse": PER_WAREHOUSE.format(
        more=", row_number() OVER (ORDER BY warehouse_id NULLS FIRST) AS position"
    ),
    "scd2_history_ordered": "SELECT *, row_number() OVER (ORDER BY product_id, dw_start_date, dw_end_date) AS position FROM v3",
    "preview_top_n": "SELECT * FROM order_lines ORDER BY order_line_id, sales_quantity, price_per_unit LIMIT 10",
    "union_by_name_fill": f"SELECT * FROM v1 UNION ALL SELECT NULL, {ATTRIBUTES}, NULL, NULL FROM products_second",
    "explode_items": "SELECT * FROM items",
    "order_line_id": "SELECT order_line_id, CAST(customer_id AS VARCHAR) || '_' || CAST(product_id AS VARCHAR) "
    "AS customer_line_id FROM order_lines",
    "recency_days": "SELECT order_line_id, CAST(DATE '2025-10-01' - CAST(order_date AS DATE) AS INTEGER) AS recency "
    "FROM order_lines",
    "delivery_delta_days": "SELECT order_id, delivery_time_delta_days AS delta_days FROM facts",
    "epoch_ms_to_timestamp": "SELECT order_id, actual_delivery_date * 1000 AS micros, "
    "CAST(make_timestamp(actual_delivery_date * 1000) AS DATE) AS day FROM logistics",
    "arith_line_amount": "SELECT order_line_id, "
    "CAST(CAST(sales_quantity AS DECIMAL(10,0)) * CAST(price_per_unit AS DECIMAL(26,10)) AS DOUBLE) AS amount, "
    "sales_quantity / 1000 AS thousands, sales_quantity + product_id AS total FROM order_lines",
    "late_flag": "SELECT order_id, is_late_delivery FROM facts",
    "coalesce_key": "SELECT order_line_id, coalesce(customer_id, order_id) AS key FROM order_lines",
    "surrogate_key_dense": "SELECT customer_id, city, "
    "CAST(99 + row_number() OVER (ORDER BY customer_id) AS BIGINT) AS cust_key FROM customers",
    "order_lines": "SELECT * FROM order_lines",
    "dropped_orders": "SELECT * FROM order_header h WHERE NOT EXISTS "
    "(SELECT 1 FROM items i WHERE i.order_id = h.order_id)",
    "rfm_scores": "SELECT * FROM rfm",
    "rfm_r_score": "SELECT customer_id, r_score FROM rfm",
    "rfm_f_score": "SELECT customer_id, f_score FROM rfm",
    "rfm_m_score": "SELECT customer_id, m_score FROM rfm",
    "dim_customer": "SELECT * FROM dim_customer",
    "scd2_first_run": "SELECT *, 'new' AS action FROM v1",
    "scd2_merge_safe": "SELECT * FROM v1_next",
    "fact_logistics": "SELECT * FROM facts",
    "flow_orders": "SELECT * FROM order_lines",
    "flow_dimensions": """
      SELECT 'customer' AS dimension, cust_key AS key, customer_id AS id, CAST(RFM_Score AS VARCHAR) AS detail,
        CAST(NULL AS DATE) AS dw_start_date, CAST(NULL AS DATE) AS dw_end_date FROM dim_customer
      UNION ALL
      SELECT 'product', product_key, product_id, product_price, dw_start_date, dw_end_date FROM v2""",
    "flow_all": """
      SELECT 'line' AS kind, CAST(NULL AS BIGINT) AS key, order_id AS id, order_line_id AS detail,
        CAST(NULL AS DATE) AS until FROM order_lines
      UNION ALL SELECT 'customer', cust_key, customer_id, CAST(RFM_Score AS VARCHAR), NULL FROM dim_customer
      UNION ALL SELECT 'product', product_key, product_id, product_price, dw_end_date FROM v2
      UNION ALL SELECT 'delivery', NULL, order_id, CAST(delivery_time_delta_days AS VARCHAR), NULL FROM facts""",
    "rejected_documents": "SELECT concat('{\"order_id\": ', CAST(order_id AS VARCHAR), ', \"items\": [') AS document "
    "FROM order_header WHERE order_id % 50 = 7",
    "rejected_lines": "SELECT order_line_id, order_date, price_per_unit FROM spoilt_lines WHERE unusable",
    "scd2_quarantine": "SELECT CAST(NULL AS BIGINT) AS product_id, category, sub_category, product_price, "
    "product_description FROM products_first WHERE category = 'SERVICE'",
    "reject_counts": """
      SELECT 'documents' AS source, count(*) AS rows_read, count(*) FILTER (WHERE order_id % 50 = 7) AS rows_rejected
      FROM order_header
      UNION ALL SELECT 'order_lines', count(*), count(*) FILTER (WHERE unusable) FROM spoilt_lines
      UNION ALL SELECT 'products', count(*), count(*) FILTER (WHERE category = 'SERVICE') FROM products_first""",
    "flow_logistics": PER_WAREHOUSE.format(
        more=", CAST(count(*) FILTER (WHERE is_late_delivery) AS BIGINT) AS late, count(*) AS deliveries"
    ),
}

REFERENCE_POLICY = {
    "scd2_merge_reference": "SELECT * FROM v1_next",
    "scd2_third_reference": "SELECT * FROM v3",
    **{
        f"scd2_{action}": f"SELECT product_key, {ATTRIBUTES}, dw_start_date, dw_end_date "
        f"FROM v1_next WHERE action = '{action}'"
        for action in ("unchanged", "new", "expired", "new_version")
    },
}


def all_oracles() -> dict[str, str]:
    safe = {name: _with(select) for name, select in SIMPLE.items()}
    return safe | {name: _with(select, "reference") for name, select in REFERENCE_POLICY.items()}
