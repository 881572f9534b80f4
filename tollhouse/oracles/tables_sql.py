"""The logical tables as DuckDB common table expressions over the source tables.

The lists of literal values come from the fixtures; everything computed is written again here.
"""

from __future__ import annotations

import re

from tollhouse.sources import fixtures as fx


def _list(values) -> str:
    return "[" + ", ".join(f"'{v}'" for v in values) + "]"


def _values(rows) -> str:
    def lit(v):
        return f"'{v}'" if isinstance(v, str) else str(v)

    return "(VALUES " + ", ".join("(" + ", ".join(lit(v) for v in r) + ")" for r in rows) + ")"


def _tables(service: str) -> dict[str, str]:
    usage_types = fx.USAGE_TYPES[service]
    folded = "DATE '1995-12-18' + CAST(date_diff('day', DATE '1995-01-01', CAST({} AS DATE)) % 70 AS INTEGER)"
    offering = "['607996', '607997', '615324', '615325', '729920'][CAST(substr(o_orderpriority, 1, 1) AS INTEGER)]"
    mapping = [(p + u, c) for p, c in zip(fx.REGION_PREFIXES, fx.REGION_CODES) for u in usage_types]
    plan_types = [p + u for p in fx.REGION_PREFIXES for u in usage_types]
    plans = [(i, u, p, f) for i, u in enumerate(plan_types[:-1]) for p, f in fx.PLAN_FACTORS.items()]
    matrix = [(i, f"ESInstance:{x}") for i, x in enumerate(fx.MATRIX_TYPES)] + [(len(fx.MATRIX_TYPES), "ES:GP2-Storage")]
    goals = [(y, w, 1000 + 10 * i, 1200 + 10 * i, f"{1_000_000.0 + 50_000 * i}") for i, (y, w) in enumerate(fx.WEEKS[:-1])]
    return {
        "weeks": f"SELECT * FROM {_values(fx.WEEKS)} v(year, week)",
        "week_map": """
            SELECT year, week, back, CAST(year(day - 7 * back) AS INTEGER) AS src_year,
                   CAST(strftime(day - 7 * back, '%W') AS INTEGER) AS src_week
            FROM (SELECT year, week, make_date(year, 1, 1) + CAST((8 - isodow(make_date(year, 1, 1))) % 7 + (week - 1) * 7 + 1 AS INTEGER) AS day
                  FROM weeks) CROSS JOIN (VALUES (0), (1), (2), (3)) b(back)""",
        "sunday_days": """
            SELECT m.year, m.week, m.back,
                   make_date(src_year, 1, 1) + CAST((7 - isodow(make_date(src_year, 1, 1))) % 7 + (src_week - 1) * 7 + i AS INTEGER) AS day
            FROM week_map m CROSS JOIN (VALUES (0), (1), (2), (3), (4), (5), (6)) d(i)""",
        "usage_base": f"""
            SELECT o_custkey, l_suppkey, l_partkey, l_returnflag, l_linenumber, usage_date,
                   CAST(year(usage_date) AS INTEGER) AS year, CAST(strftime(usage_date, '%W') AS INTEGER) AS week,
                   lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS account_id, is_internal_flag, region_prefix, region,
                   region_prefix || kind AS usage_type,
                   CASE WHEN l_partkey % 23 <> 0 THEN 'dom-' || o_custkey || '-' || (l_suppkey % 3) END AS usage_resource,
                   l_quantity * 8 + CAST(l_linenumber AS DOUBLE) / 10 AS usage_value,
                   CASE WHEN is_credit THEN 'CR' || (l_orderkey % 7) END AS credit_id,
                   CAST(CASE WHEN is_credit THEN round(-p * d * scale, 2) WHEN l_discount = 0 THEN 0 ELSE round(p * n * scale, 2) END AS DECIMAL(18,2)) AS billed_amount,
                   CAST(CASE WHEN l_discount = 0 THEN 0 ELSE unit END AS DECIMAL(8,4)) AS price_per_unit,
                   CASE WHEN l_linestatus = 'F' THEN 'CSDomain:001' ELSE 'CSDomain:002' END AS operation,
                   offering_id,
                   CASE WHEN is_credit THEN 'credit ' || (l_suppkey % 9) WHEN l_tax = 0.08 THEN 'Enterprise Discount' ELSE region_prefix || kind END AS charge_item_desc
            FROM (SELECT *, {folded.format("l_shipdate")} AS usage_date,
                         CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Y' ELSE 'N' END AS is_internal_flag,
                         {_list(fx.REGION_PREFIXES)}[n_regionkey + 1] AS region_prefix,
                         {_list(fx.REGION_CODES)}[n_regionkey + 1] AS region,
                         {_list(usage_types)}[l_partkey % 7 + 1] AS kind,
                         CAST({_list(fx.UNIT_PRICES)}[l_partkey % 7 + 1] AS DECIMAL(8,4)) AS unit,
                         CAST({_list(fx.SCALES)}[(o_custkey // 5) % 6 + 1] AS DECIMAL(6,5)) AS scale,
                         (l_returnflag = 'R' AND l_linenumber = 1) AS is_credit,
                         CAST(l_extendedprice AS DECIMAL(12,2)) AS p, CAST(l_discount AS DECIMAL(4,2)) AS d, CAST(1 - l_discount AS DECIMAL(4,2)) AS n,
                         {offering} AS offering_id
                  FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey)""",
        "event_usage": f"""
            SELECT usage_date, CAST(year(usage_date) AS INTEGER) AS year, CAST(strftime(usage_date, '%W') AS INTEGER) AS week, lpad(CAST(user_id AS VARCHAR), 12, '0') AS account_id,
                   CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Y' ELSE 'N' END AS is_internal_flag,
                   coalesce({_list(fx.REGION_CODES)}[n_regionkey + 1], 'IAD') AS region,
                   coalesce({_list(fx.REGION_PREFIXES)}[n_regionkey + 1], '') || {_list(usage_types)}[event_id % 7 + 1] AS usage_type,
                   'dom-' || user_id || '-e' AS usage_resource, value AS usage_value, 'CSDomain:002' AS operation
            FROM (SELECT *, {folded.format("ts")} AS usage_date FROM events) e LEFT JOIN (customer JOIN nation ON c_nationkey = n_nationkey) ON user_id = c_custkey""",
        "all_usage": "SELECT year, week, usage_date, account_id, usage_value, is_internal_flag, usage_resource, usage_type, region, operation FROM usage_base UNION ALL SELECT year, week, usage_date, account_id, usage_value, is_internal_flag, usage_resource, usage_type, region, operation FROM event_usage",
        "weekly_charges": "SELECT year, week, account_id, is_internal_flag, billed_amount, usage_type, region, operation, credit_id, charge_item_desc, offering_id, usage_value, price_per_unit FROM usage_base",
        "weekly_metering": "SELECT year, week, account_id, usage_value, is_internal_flag, usage_resource, usage_type, region, operation FROM all_usage",
        "daily_charges": "SELECT usage_date AS computation_date, charge_item_desc, account_id, CASE WHEN o_custkey % 5 <> 0 THEN lpad(CAST(o_custkey - o_custkey % 5 AS VARCHAR), 12, '0') END AS payer_account_id, usage_type, usage_value, offering_id, billed_amount, price_per_unit, region, is_internal_flag, credit_id FROM usage_base",
        "daily_metering": "SELECT usage_date AS request_day, account_id, usage_type, usage_value, usage_resource, operation FROM all_usage",
        "product_weekly_charges": f"SELECT year, week, {_list(p for p, _ in fx.PRODUCT_USAGE)}[l_suppkey % {len(fx.PRODUCT_USAGE)} + 1] AS client_product_code, account_id, region_prefix || {_list(u for _, u in fx.PRODUCT_USAGE)}[l_suppkey % {len(fx.PRODUCT_USAGE)} + 1] AS usage_type, usage_value, billed_amount FROM usage_base",
        "accounts": """
            SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS account_id,
                   CASE WHEN c_custkey % 5 <> 0 THEN lpad(CAST(c_custkey - c_custkey % 5 AS VARCHAR), 12, '0') END AS payer_account_id,
                   CASE WHEN c_custkey % 50 = 0 THEN 'MSP ' || c_name WHEN c_custkey % 37 = 0 THEN 'TrainLab ' || c_name WHEN c_custkey % 211 = 0 THEN NULL ELSE c_name END AS company,
                   CASE WHEN c_mktsegment = 'MACHINERY' THEN 'internal' ELSE 'external' END AS internal,
                   lower(c_mktsegment) || '.example' AS email_domain
            FROM customer""",
        "test_accounts": "SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS account_id FROM customer WHERE c_custkey % 97 = 0",
        "impacted_accounts": "SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS account_id FROM customer WHERE c_custkey % 7 = 0",
        "account_history": """
            SELECT lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS account_id,
                   CASE WHEN o_orderstatus = 'P' THEN 'Suspended' ELSE 'Active' END AS account_status_code,
                   CAST(o_orderdate AS DATE) AS start_effective_date,
                   CASE WHEN rn > 1 THEN CAST(o_orderdate AS DATE) + 45 END AS end_effective_date,
                   CASE WHEN rn = 1 THEN 'Y' ELSE 'N' END AS current_record_flag
            FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY CAST(o_orderdate AS DATE) DESC, o_orderkey DESC) AS rn FROM orders)""",
        "subscriptions": f"SELECT lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS account_id, {offering} AS offering_id, CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 30 END AS end_date FROM orders",
        "support_contracts": "SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS account_id, CASE WHEN c_custkey % 19 = 0 THEN 'NULL' ELSE 'Business' END AS product_name FROM customer WHERE c_acctbal > 5000 UNION ALL SELECT lpad(CAST(c_custkey AS VARCHAR), 12, '0'), 'Enterprise' FROM customer WHERE c_acctbal > 5000 AND c_custkey % 4 = 0",
        "metered_weeks": "SELECT DISTINCT year, week, account_id, is_internal_flag FROM all_usage",
        "free_weeks": "SELECT DISTINCT year, week, account_id, is_internal_flag FROM usage_base WHERE price_per_unit = 0",
        "new_active_customers": "SELECT * FROM metered_weeks m WHERE NOT EXISTS (SELECT 1 FROM week_map w JOIN metered_weeks p ON p.year = w.src_year AND p.week = w.src_week WHERE w.back = 1 AND w.year = m.year AND w.week = m.week AND p.account_id = m.account_id AND p.is_internal_flag = m.is_internal_flag)",
        "new_inactive_customers": "SELECT w.year, w.week, p.account_id, p.is_internal_flag FROM week_map w JOIN metered_weeks p ON p.year = w.src_year AND p.week = w.src_week AND w.back = 1 WHERE NOT EXISTS (SELECT 1 FROM metered_weeks m WHERE m.year = w.year AND m.week = w.week AND m.account_id = p.account_id AND m.is_internal_flag = p.is_internal_flag)",
        "free_tier": "SELECT * FROM free_weeks",
        "free_trial": "SELECT * FROM free_weeks WHERE CAST(account_id AS BIGINT) % 4 = 0",
        "free_to_pay": "SELECT w.year, w.week, p.account_id, p.is_internal_flag FROM week_map w JOIN free_weeks p ON p.year = w.src_year AND p.week = w.src_week AND w.back = 1 JOIN metered_weeks m ON m.year = w.year AND m.week = w.week AND m.account_id = p.account_id AND m.is_internal_flag = p.is_internal_flag WHERE NOT EXISTS (SELECT 1 FROM free_weeks f WHERE f.year = w.year AND f.week = w.week AND f.account_id = p.account_id AND f.is_internal_flag = p.is_internal_flag)",
        "active_date": """
            SELECT l.*, company, CAST(year(lo) AS INTEGER) AS min_request_year, CAST(strftime(lo, '%W') AS INTEGER) AS min_request_week,
                   CAST(year(hi) AS INTEGER) AS max_request_year, CAST(strftime(hi, '%W') AS INTEGER) AS max_request_week, lo AS min_request_day, hi AS max_request_day
            FROM (SELECT account_id, is_internal_flag, sum(billed_amount) AS billed_amount, min(usage_date) AS lo, max(usage_date) AS hi FROM usage_base GROUP BY ALL) l
            LEFT JOIN accounts USING (account_id)""",
        "goals": f"SELECT year, week, paying_customer_goal, active_customer_goal, CAST(revenue_goal AS DOUBLE) AS revenue_goal FROM {_values(goals)} v(year, week, paying_customer_goal, active_customer_goal, revenue_goal)",
        "revenue_fact": """
            SELECT usage_date AS computation_date, charge_item_desc, o_custkey AS account_seq_id, o_custkey - o_custkey % 5 AS payer_account_seq_id,
                   l_suppkey % 3 AS product_seq_id, usage_type, credit_id, date_trunc('month', usage_date) AS charge_period_start_date,
                   usage_date AS charge_period_end_date, 'USD' AS base_currency_code, billed_amount,
                   CAST(CASE WHEN l_returnflag = 'A' AND l_linenumber = 2 THEN billed_amount * CAST(-0.1 AS DECIMAL(2,1)) ELSE 0 END AS DECIMAL(18,3)) AS refund_amount,
                   CAST(CASE WHEN l_partkey % 2 = 0 THEN 1.0 ELSE 0.5 END AS DECIMAL(2,1)) AS amortization_factor
            FROM usage_base""",
        "dim_accounts": "SELECT c_custkey AS account_seq_id, lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS account_id, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Y' ELSE 'N' END AS is_internal_flag, CASE WHEN c_custkey % 19 = 0 THEN 'Reinstated' WHEN c_custkey % 23 = 0 THEN 'Suspended' WHEN c_custkey % 3 = 0 THEN 'OK' END AS fraud_enforcement_status FROM customer",
        "dim_products": f"SELECT * FROM {_values(fx.PRODUCTS)} v(product_seq_id, product_code)",
        "compute_fact": f"SELECT day - CAST(dayofweek(day) AS INTEGER) AS week_begin_date, activity_type_id, account_seq_id, is_compromised_flag FROM (SELECT {folded.format('o_orderdate')} AS day, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS activity_type_id, o_custkey AS account_seq_id, CASE WHEN o_orderkey % 13 = 0 THEN 'Y' ELSE 'N' END AS is_compromised_flag FROM orders)",
        "dim_activity": f"SELECT * FROM {_values(fx.ACTIVITIES)} v(activity_type_id, biz_product_group, biz_product_name)",
        "dim_compute_accounts": "SELECT c_custkey AS account_seq_id, lpad(CAST(c_custkey AS VARCHAR), 12, '0') AS account_id, CASE WHEN c_mktsegment = 'MACHINERY' THEN 'Y' ELSE 'N' END AS is_internal_flag, CASE WHEN c_custkey % 17 = 0 THEN 'Y' ELSE 'N' END AS is_fraud_flag, CASE WHEN c_custkey % 11 = 0 THEN 'Suspended' ELSE 'Active' END AS account_status_code FROM customer",
        "region_mapping": f"SELECT * FROM {_values(mapping)} v(usage_type, region)",
        "dim_usage_types": f"SELECT * FROM {_values(mapping + [('USE2-' + u, 'CMH') for u in usage_types])} v(usage_type, region)",
        "price_wide": f"""
            SELECT product, client_product_code, usage_type, CAST(round(base, 4) AS DECIMAL(12,4)) AS IAD, CAST(round(base * 1.1, 4) AS DECIMAL(12,4)) AS PDX,
                   CAST(round(base * 1.2, 4) AS DECIMAL(12,4)) AS DUB, CAST(round(base * 1.3, 4) AS DECIMAL(12,4)) AS NRT
            FROM (SELECT p_partkey % {len(fx.PRICED)} AS class, min(CAST(p_retailprice AS DECIMAL(12,2))) * CAST(class + 1 AS DECIMAL(4,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS base FROM part GROUP BY 1)
            JOIN {_values([(i, *r) for i, r in enumerate(fx.PRICED)])} v(class, product, client_product_code, usage_type) USING (class)""",
        "price_list": "SELECT * FROM (UNPIVOT price_wide ON IAD, PDX, DUB, NRT INTO NAME region VALUE price)",
        "price_plan": f"""
            SELECT plan_id, usage_type, CAST(round(least_price * CAST(class + 1 AS DECIMAL(4,0)) * CAST(0.0001 AS DECIMAL(5,4)) * CAST(factor AS DECIMAL(2,1)), 4) AS DECIMAL(12,4)) AS price_unit
            FROM (SELECT p_partkey % {len(plan_types)} AS class, min(CAST(p_retailprice AS DECIMAL(12,2))) AS least_price FROM part GROUP BY 1)
            JOIN {_values(plans)} v(class, usage_type, plan_id, factor) USING (class)""",
        "price_catalog_raw": f"""
            SELECT {_list(fx.CATALOG_TEXT)}[p_partkey % 3 + 1] AS description,
                   {_list(fx.REGION_PREFIXES)}[(p_partkey // 9) % 5 + 1] || {_list(fx.CATALOG_USAGE)}[p_partkey % 9 + 1] AS usage_type,
                   CAST(CAST(p_retailprice AS DECIMAL(12,2)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(12,4)) AS price_unit,
                   CASE WHEN p_partkey % 9 < 2 THEN 'Hrs' ELSE 'GB-Mo' END AS usage_unit
            FROM part""",
        "price_matrix_long": f"""
            SELECT name, prefix, CAST(CASE WHEN (class + i) % 4 = 0 THEN 0 ELSE round(least_price * CAST(class + 1 AS DECIMAL(4,0)) * CAST(0.0001 AS DECIMAL(5,4)), 4) END AS DECIMAL(12,4)) AS price
            FROM (SELECT p_partkey % {len(matrix)} AS class, min(CAST(p_retailprice AS DECIMAL(12,2))) AS least_price FROM part GROUP BY 1)
            JOIN {_values(matrix)} v(class, name) USING (class)
            CROSS JOIN {_values([(i, p.rstrip("-")) for i, p in enumerate(fx.REGION_PREFIXES)])} r(i, prefix)""",
        "regions": f"SELECT * FROM {_values([(p.rstrip('-'), c) for p, c in zip(fx.REGION_PREFIXES, fx.REGION_CODES)])} v(prefix, region)",
        "current_products": "SELECT DISTINCT usage_type FROM usage_base",
        "exposed_list": "SELECT DISTINCT account_id, usage_resource AS domain_name, region FROM usage_base WHERE l_partkey % 50 = 0 AND usage_resource IS NOT NULL",
        "domain_configs": f"SELECT lpad(CAST(user_id AS VARCHAR), 12, '0') AS account_id, 'conf-' || event_id AS domain, {_list(fx.NODE_TYPES)}[event_id % {len(fx.NODE_TYPES)} + 1] AS data_node_type, CAST(json_extract_string(props, '$.k') AS INTEGER) AS data_node_count FROM events",
        # -- relations most reports share ---------------------------------------------------------
        "metered_accounts": "SELECT * FROM accounts WHERE account_id IN (SELECT account_id FROM weekly_metering)",
        "directory": """
            SELECT account_id, CASE WHEN payer_account_id <> account_id THEN payer_account_id END AS payer_account_id, company,
                   CASE WHEN internal = 'external' THEN 'N' ELSE 'Y' END AS is_internal_flag FROM metered_accounts
            UNION
            SELECT m.payer_account_id, NULL, p.company, CASE WHEN p.account_id IS NULL THEN NULL WHEN p.internal = 'external' THEN 'N' ELSE 'Y' END
            FROM metered_accounts m LEFT JOIN accounts p ON p.account_id = m.payer_account_id WHERE m.payer_account_id IS NOT NULL""",
        "payers": "SELECT account_id, max(payer_account_id) AS payer_account_id, min(company) AS company, max(is_internal_flag) AS is_internal_flag FROM directory GROUP BY account_id",
        "lab_accounts": "SELECT DISTINCT account_id FROM directory WHERE company ILIKE '%TrainLab%'",
        "charges": "SELECT * FROM weekly_charges WHERE account_id NOT IN (SELECT account_id FROM test_accounts)",
        "metering": "SELECT * FROM weekly_metering WHERE account_id NOT IN (SELECT account_id FROM test_accounts)",
        "charged_accounts": "SELECT DISTINCT year, week, account_id FROM charges",
    }


def with_tables(sql: str, service: str = "A") -> str:
    """Prefix a query with the common table expressions it uses, directly or not."""
    tables = _tables(service)
    # usage is added up in decimals
    sql = sql.replace("sum(usage_value)", "CAST(sum(CAST(usage_value AS DECIMAL(18,6))) AS DOUBLE)")
    needed: set[str] = set()

    def visit(text: str) -> None:
        for name in re.findall(r"[a-z_0-9]+", text):
            if name in tables and name not in needed:
                needed.add(name)
                visit(tables[name])

    visit(sql)
    ctes = ", ".join(f"{n} AS ({tables[n]})" for n in tables if n in needed)
    if not ctes:
        return sql
    # a query may begin with a comma and common table expressions of its own
    return f"WITH {ctes} {sql.lstrip()}"
