"""The retail model stated in DuckDB SQL, as named common table expressions.

``sql(body)`` prefixes ``body`` with the expressions it mentions, in dependency order.
"""

from __future__ import annotations

import re

from assaymill.functions import text
from assaymill.sources import retail, synth

DUP, ORPHAN = synth.DUPLICATE_ID_OFFSET, synth.ORPHAN_ID_OFFSET


def q(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def options(values) -> str:
    return "[" + ", ".join(q(v) for v in values) + "]"


def pick(values, key: str) -> str:
    return f"({options(values)})[CAST(({key}) % {len(values)} AS INTEGER) + 1]"


def decode(column: str, table) -> str:
    whens = " ".join(f"WHEN {q(k)} THEN {q(v)}" for k, v in table.items())
    return f"(CASE {column} {whens} END)"


def rnd(e: str, digits: int = 2) -> str:
    """Half away from zero on the shortest decimal text of a double."""
    return f"CAST(ROUND(CAST(CAST(CAST({e} AS DOUBLE) AS VARCHAR) AS DECIMAL(38,14)), {digits}) AS DOUBLE)"


def esum(e: str, digits: int = 2) -> str:
    """Exact sum of values with at most ``digits`` decimals."""
    unit = 10**digits
    return f"(CAST(SUM(CAST(ROUND(({e}) * {unit}) AS BIGINT)) AS DOUBLE) / {unit})"


def isum(e: str) -> str:
    return f"CAST(SUM({e}) AS BIGINT)"


def datekey(d: str) -> str:
    return f"CAST(strftime({d}, '%Y%m%d') AS INTEGER)"


def mixed_case(c: str, k: str, double_spaces: bool = True) -> str:
    padded = f"' ' || replace({c}, ' ', '  ') || ' '" if double_spaces else f"{c} || ' '"
    return (f"(CASE ({k}) % 4 WHEN 0 THEN upper({c}) WHEN 1 THEN lower({c}) "
            f"WHEN 2 THEN {padded} ELSE {c} END)")


def mixed_date(d: str, k: str) -> str:
    iso = f"strftime({d}, '%Y-%m-%d')"
    return (f"(CASE ({k}) % 3 WHEN 0 THEN {iso} WHEN 1 THEN strftime({d}, '%m/%d/%Y') "
            f"ELSE {iso} || ' ' || lpad(CAST(({k}) % 24 AS VARCHAR), 2, '0') || ':05:09' END)")


def mixed_boolean(flag: str, k: str) -> str:
    return (f"(CASE {flag} WHEN 1 THEN {pick(synth.TRUE_TEXTS, k)} "
            f"WHEN 0 THEN {pick(synth.FALSE_TEXTS, k)} END)")


NET = rnd("coalesce(quantity, 0) * unit_price * (1 - discount_pct)")
FIXED = "(CASE WHEN discount_pct > 1 THEN discount_pct / 100 ELSE discount_pct END)"
STATES = list(text.STATE_CODES.values())
STATE_ROWS = ", ".join(f"({q(n)}, {q(c)})" for n, c in text.STATE_CODES.items())
DOTTED_FULL = "CASE full_state " + " ".join(
    f"WHEN {q(n)} THEN {q(d)}" for n, d in synth.DOTTED_STATES.items()) + " ELSE full_state END"
SHORT_CATEGORY = "CASE category " + " ".join(
    f"WHEN {q(n)} THEN {q(d)}" for n, d in synth.CATEGORY_VARIANTS.items()) + " ELSE category END"

CTES: dict[str, str] = {
    "headers": f"""
        SELECT o_orderkey AS order_id,
               CASE WHEN o_orderkey % 100 = 0 THEN o_custkey + {ORPHAN} ELSE o_custkey END AS customer_id,
               CASE WHEN o_orderkey % 200 <> 7 THEN CAST(o_orderdate AS DATE) END AS order_date,
               {decode('o_orderpriority', retail.PAYMENT_BY_PRIORITY)} AS payment_method,
               CASE WHEN o_orderkey % 11 <> 5 THEN {decode('o_orderstatus', retail.STATUS_BY_CODE)} END AS order_status
        FROM orders""",
    "lines_feed": f"""
        SELECT l_orderkey AS order_id, l_linenumber AS order_line_id,
               CASE WHEN (l_orderkey * 10 + l_linenumber) % 97 = 0 THEN l_partkey + {ORPHAN} ELSE l_partkey END AS product_id,
               CASE WHEN l_orderkey % 10 <> 0 THEN l_suppkey END AS employee_id,
               CASE WHEN l_orderkey % 7 <> 3 THEN CAST(l_shipdate AS DATE) END AS ship_date,
               CASE (l_orderkey + l_partkey) % 60 WHEN 0 THEN NULL WHEN 1 THEN -CAST(l_quantity AS INTEGER)
                    WHEN 2 THEN 0 ELSE CAST(l_quantity AS INTEGER) END AS quantity,
               floor(l_extendedprice / l_quantity * 100 + 0.5::DOUBLE) / 100 AS unit_price,
               CASE WHEN (l_orderkey + l_linenumber) % 67 = 0 THEN CAST(CAST(floor(l_discount * 300 + 0.5::DOUBLE) AS INTEGER) AS DOUBLE)
                    ELSE CAST(floor(l_discount * 300 + 0.5::DOUBLE) AS INTEGER) / 100 END AS discount_pct,
               {decode('l_linestatus', retail.CHANNEL_BY_CODE)} AS channel
        FROM lineitem""",
    "lines": f"""
        SELECT *, {NET} AS net_amount FROM (SELECT * REPLACE ({FIXED} AS discount_pct) FROM lines_feed)""",
    "sales_feed": """
        SELECT order_id, order_line_id, customer_id, product_id, employee_id, order_date, ship_date,
               quantity, unit_price, discount_pct, payment_method, order_status, channel
        FROM lines_feed JOIN headers USING (order_id)""",
    "fact": f"""
        SELECT *, {datekey('order_date')} AS datekey, {NET} AS net_amount
        FROM (SELECT * REPLACE ({FIXED} AS discount_pct) FROM sales_feed)""",
    "flagged_fact": """
        SELECT f.*, CASE WHEN f.customer_id IN (SELECT customer_id FROM cust) THEN 0 ELSE 1 END AS is_customer_orphan,
               CASE WHEN f.product_id IN (SELECT product_id FROM prod) THEN 0 ELSE 1 END AS is_product_orphan
        FROM fact f""",
    "cust_feed": f"""
        SELECT k, is_copy, k + is_copy * {DUP} AS customer_id,
               {pick(retail.FIRST_NAMES, 'k')} AS first_name,
               {pick(retail.LAST_NAMES, 'k // 8')} AS last_name,
               CASE WHEN NOT (k % 25 = 3 OR k % 50 = 4) THEN
                   replace(lower({pick(retail.FIRST_NAMES, 'k')}), ' ', '') || '.' ||
                   replace(lower({pick(retail.LAST_NAMES, 'k // 8')}), '''', '') || k || '@example.com' END AS email,
               CAST(k % 800 + 200 AS VARCHAR) AS area, CAST(k % 900 + 100 AS VARCHAR) AS prefix,
               CAST(k % 9000 + 1000 AS VARCHAR) AS line,
               CASE WHEN k % 33 <> 5 THEN {pick(STATES, 'k')} END AS state,
               DATE '1993-01-01' + CAST(k * 37 % 3000 + is_copy * 100 AS INTEGER) AS signup_date,
               CASE WHEN k % 11 < 5 THEN 1 WHEN k % 11 < 10 THEN 0 END AS is_active,
               CASE WHEN k % 31 <> 7 THEN {decode('c_mktsegment', retail.SEGMENT_BY_MARKET)} END AS customer_segment
        FROM (SELECT *, c_custkey AS k, UNNEST(CASE WHEN c_custkey % 20 = 0 THEN [0, 1] ELSE [0] END) AS is_copy
              FROM customer)""",
    "cust": """
        SELECT customer_id, first_name, last_name, first_name || ' ' || last_name AS full_name, email,
               CASE k % 40 WHEN 9 THEN NULL WHEN 10 THEN NULL WHEN 11 THEN 'unlisted'
                    ELSE '(' || area || ') ' || prefix || '-' || line END AS phone,
               state, signup_date, is_active, customer_segment
        FROM cust_feed""",
    "prod": """
        SELECT * REPLACE (CASE WHEN product_id % 70 <> 1 THEN subcategory END AS subcategory)
        FROM prod_feed""",
    "prod_feed": f"""
        SELECT p_partkey AS product_id, p_name AS product_name,
               CASE WHEN p_partkey % 101 <> 50 THEN {decode('p_type', retail.CATEGORY_BY_TYPE)} END AS category,
               string_split(p_name, ' ')[-1] AS subcategory, p_brand AS brand,
               CASE WHEN p_partkey % 200 = 11 THEN -floor(p_retailprice * 0.6::DOUBLE * 100 + 0.5::DOUBLE) / 100
                    WHEN p_partkey % 90 <> 17 THEN floor(p_retailprice * 0.6::DOUBLE * 100 + 0.5::DOUBLE) / 100 END AS unit_cost,
               p_retailprice AS unit_price,
               CASE WHEN p_partkey % 11 < 5 THEN 1 WHEN p_partkey % 11 < 10 THEN 0 END AS is_discontinued,
               'SKU-' || CASE WHEN p_partkey % 50 = 0 THEN p_partkey + 1 ELSE p_partkey END AS sku,
               CASE WHEN p_partkey % 13 <> 5 THEN CAST(p_partkey * 7 % 250 AS DOUBLE) / 10 END AS weight_kg,
               DATE '1994-06-01' + CAST(p_partkey * 13 % 900 AS INTEGER) AS created_at
        FROM part""",
    "emp": f"""
        SELECT s_suppkey AS employee_id, {pick(retail.FIRST_NAMES, 's_suppkey + 3')} AS first_name,
               {pick(retail.LAST_NAMES, 's_suppkey')} AS last_name,
               {pick(retail.FIRST_NAMES, 's_suppkey + 3')} || ' ' || {pick(retail.LAST_NAMES, 's_suppkey')} AS full_name,
               {pick(retail.DEPARTMENT_CYCLE, 's_suppkey')} AS department,
               {decode('r_name', retail.REGION_BY_NAME)} AS region,
               DATE '1994-01-01' + CAST(s_suppkey * 53 % 1500 AS INTEGER) AS hire_date,
               CASE WHEN s_suppkey % 7 = 0 THEN DATE '1994-01-01' +
                   CAST(s_suppkey * 53 % 1500 + s_suppkey * 29 % 1500 + 200 AS INTEGER) END AS termination_date,
               CASE WHEN s_suppkey % 5 = 0 THEN 1 ELSE 0 END AS is_manager,
               CASE WHEN s_suppkey % 25 <> 3 THEN
                   replace(lower({pick(retail.FIRST_NAMES, 's_suppkey + 3')}), ' ', '') || '.' || s_suppkey || '@example.com' END AS email
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "days": """
        SELECT CAST(UNNEST(generate_series(lo, hi, INTERVAL 1 DAY)) AS DATE) AS date
        FROM (SELECT date_trunc('year', min(o_orderdate)) AS lo,
                     make_date(CAST(year(max(o_orderdate)) AS INTEGER), 12, 31)::TIMESTAMP AS hi FROM orders)""",
    "cal": f"""
        SELECT {datekey('date')} AS datekey, date, CAST(year(date) AS INTEGER) AS year,
               CAST(month(date) AS INTEGER) AS month, monthname(date) AS month_name,
               CAST(quarter(date) AS INTEGER) AS quarter, CAST(day(date) AS INTEGER) AS day_of_month,
               CAST(dayofweek(date) AS INTEGER) AS day_of_week, dayname(date) AS day_name,
               CASE WHEN dayofweek(date) IN (0, 6) THEN 1 ELSE 0 END AS is_weekend
        FROM days""",
    "window_days": """
        SELECT * FROM cal WHERE date BETWEEN (SELECT CAST(min(o_orderdate) AS DATE) FROM orders)
                                         AND (SELECT CAST(max(o_orderdate) AS DATE) FROM orders)""",
    "monthly": f"""
        SELECT year, month, month_name, category, COUNT(*) AS order_line_count,
               {isum('quantity')} AS total_quantity, {esum('net_amount')} AS total_net_amount
        FROM fact JOIN cal USING (datekey) JOIN prod USING (product_id)
        GROUP BY year, month, month_name, category""",
    "daily": f"""
        SELECT date AS order_date, year, month, day_name, is_weekend,
               COUNT(order_line_id) AS order_line_count, COALESCE({esum('net_amount')}, 0) AS total_net_amount
        FROM window_days LEFT JOIN fact USING (datekey)
        GROUP BY date, year, month, day_name, is_weekend""",
    "ltv": f"""
        SELECT c.customer_id, full_name, customer_segment, state,
               COUNT(DISTINCT order_id) AS order_count, COUNT(order_line_id) AS order_line_count,
               COALESCE({esum('net_amount')}, 0) AS lifetime_net_amount,
               MIN(order_date) AS first_order_date, MAX(order_date) AS last_order_date
        FROM cust c LEFT JOIN fact f ON f.customer_id = c.customer_id
        GROUP BY c.customer_id, full_name, customer_segment, state""",
    "month_net": """
        SELECT year, month, SUM(CAST(ROUND(total_net_amount * 100) AS BIGINT))::DOUBLE / 100 AS month_total
        FROM monthly GROUP BY year, month""",
    "category_year": """
        SELECT year, category, SUM(CAST(ROUND(total_net_amount * 100) AS BIGINT))::DOUBLE / 100 AS year_revenue
        FROM monthly GROUP BY year, category""",
    "product_revenue": f"""
        SELECT category, product_id, product_name, {esum('net_amount')} AS total_revenue
        FROM lines JOIN (SELECT product_id, category, product_name FROM prod) USING (product_id)
        GROUP BY category, product_id, product_name""",
    # Raw text.
    "bronze_customers": f"""
        SELECT customer_id,
               CASE WHEN is_copy = 1 THEN upper(first_name) || ' ' ELSE {mixed_case('first_name', 'k')} END AS first_name,
               CASE WHEN is_copy = 1 THEN upper(last_name) || ' ' ELSE {mixed_case('last_name', 'k')} END AS last_name,
               CASE WHEN k % 50 = 4 THEN '' WHEN is_copy = 1 AND k % 40 = 0 THEN upper(email)
                    WHEN is_copy = 1 THEN ' ' || email ELSE email END AS email,
               CASE k % 40 WHEN 11 THEN 'unlisted' WHEN 9 THEN '' WHEN 10 THEN NULL ELSE
                   CASE k % 5 WHEN 0 THEN '(' || area || ') ' || prefix || '-' || line
                              WHEN 1 THEN area || '-' || prefix || '-' || line
                              WHEN 2 THEN area || prefix || line
                              WHEN 3 THEN area || '.' || prefix || '.' || line
                              ELSE '+1 ' || area || ' ' || prefix || ' ' || line END END AS phone,
               CASE WHEN k % 66 = 5 THEN '' ELSE
                   CASE k % 4 WHEN 0 THEN state WHEN 1 THEN lower(state) WHEN 2 THEN full_state
                              ELSE lower({DOTTED_FULL}) END END AS state,
               {mixed_date('signup_date', 'k')} AS signup_date,
               {mixed_boolean('is_active', 'k')} AS is_active,
               {mixed_case('customer_segment', 'k + 1')} AS customer_segment
        FROM cust_feed LEFT JOIN (
            SELECT code, array_to_string(list_transform(string_split(name, ' '),
                       lambda w: upper(w[1]) || w[2:]), ' ') AS full_state
            FROM (VALUES {STATE_ROWS}) AS s(name, code)) ON code = state""",
    "bronze_products": f"""
        SELECT product_id, product_name || CASE WHEN product_id % 6 = 0 THEN ' ' ELSE '' END AS product_name,
               COALESCE({mixed_case('spelled', 'product_id')}, 'Misc ') AS category,
               CASE WHEN product_id % 70 = 1 THEN '' ELSE subcategory END AS subcategory,
               CASE WHEN product_id % 8 = 0 THEN ' ' ELSE '' END || brand AS brand, unit_cost, unit_price,
               {mixed_boolean('is_discontinued', 'product_id')} AS is_discontinued,
               sku || CASE WHEN product_id % 9 = 0 THEN ' ' ELSE '' END AS sku,
               CAST(CAST(weight_kg AS DECIMAL(5,1)) AS VARCHAR) || CASE WHEN product_id % 2 = 0 THEN ' kg' ELSE '' END AS weight_kg,
               {mixed_date('created_at', 'product_id')} AS created_at
        FROM (SELECT *, CASE WHEN product_id % 5 = 0 THEN {SHORT_CATEGORY} ELSE category END AS spelled FROM prod_feed)""",
    "bronze_employees": f"""
        SELECT employee_id, pad || upper(first_name) AS first_name, lower(last_name) || pad AS last_name,
               {mixed_case('department', 'employee_id + 2')} AS department,
               {mixed_case('region', 'employee_id + 1')} AS region,
               {mixed_date('hire_date', 'employee_id')} AS hire_date,
               {mixed_date('termination_date', 'employee_id + 1')} AS termination_date,
               {mixed_boolean('is_manager', 'employee_id')} AS is_manager,
               upper(CASE WHEN employee_id % 50 = 3 THEN '' ELSE email END) AS email
        FROM (SELECT *, CASE WHEN employee_id % 3 = 0 THEN ' ' ELSE '' END AS pad FROM emp)""",
    "sales_with_total": f"""
        SELECT * EXCLUDE (correct, stale), CASE (order_id + order_line_id) % 10 WHEN 4 THEN ' $' || correct WHEN 5 THEN stale
                   WHEN 6 THEN '$' || stale || ' ' WHEN 7 THEN 'TBD' WHEN 8 THEN 'N/A' WHEN 9 THEN NULL
                   ELSE correct END AS order_total
        FROM (SELECT sales_feed.*,
                     CAST(CAST({NET.replace('discount_pct', FIXED)} AS DECIMAL(18,2)) AS VARCHAR) AS correct,
                     CAST(CAST({rnd('coalesce(quantity, 0) * unit_price')} AS DECIMAL(18,2)) AS VARCHAR) AS stale
              FROM sales_feed)""",
    "bronze_sales": f"""
        SELECT order_id, order_line_id, customer_id, product_id, employee_id,
               {mixed_date('order_date', 'order_id')} AS order_date,
               {mixed_date('ship_date', 'order_id + order_line_id')} AS ship_date,
               quantity, unit_price, discount_pct, order_total,
               CASE WHEN payment_method = 'Credit Card' AND order_id % 6 = 0 THEN 'CC'
                    ELSE {mixed_case('payment_method', 'order_id', False)} END AS payment_method,
               {mixed_case('order_status', 'order_id + 1', False)} AS order_status,
               CASE WHEN channel = 'In-Store' AND order_line_id % 2 = 0 THEN 'in store'
                    ELSE {mixed_case('channel', 'order_line_id', False)} END AS channel
        FROM sales_with_total""",
    # The silver layer is known without cleaning: it is the model before the noise.
    "silver_products": """
        SELECT *, CASE WHEN COUNT(*) OVER (PARTITION BY sku) > 1 THEN 1 ELSE 0 END AS sku_is_duplicate FROM prod""",
    "silver_sales": f"""
        SELECT * EXCLUDE (order_total), order_total AS order_total_raw, {NET} AS net_amount,
               CASE WHEN customer_id IN (SELECT customer_id FROM cust) THEN 0 ELSE 1 END AS is_customer_orphan,
               CASE WHEN product_id IN (SELECT product_id FROM prod) THEN 0 ELSE 1 END AS is_product_orphan
        FROM (SELECT * REPLACE ({FIXED} AS discount_pct) FROM sales_with_total)""",
}


def sql(body: str, **extra: str) -> str:
    """``body`` with the model expressions it needs in front."""
    texts = {**CTES, **extra}
    ordered: list[str] = []

    def need(statement: str, seen: tuple[str, ...] = ()) -> None:
        for name in texts:
            mentioned = re.search(rf"\b(?:FROM|JOIN|,)\s+{name}\b", statement)
            if mentioned and name not in ordered and name not in seen:
                need(texts[name], (*seen, name))
                ordered.append(name)

    need(body)
    if not ordered:
        return body
    head = ",\n".join(f"{name} AS ({texts[name]})" for name in ordered)
    return f"WITH {head}\n{body}"
