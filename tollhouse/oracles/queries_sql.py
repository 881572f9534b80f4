"""The same questions in SQL, one text per registered query, for checking against DuckDB."""

from __future__ import annotations

from dataclasses import dataclass, field

from tollhouse.oracles.tables_sql import with_tables
from tollhouse.sources import fixtures as fx

# Tokens and rules of the services, written here a second time, so that a wrong one shows.
CUSTOMER_OFFERINGS = ("607996", "615324", "729920", "615325", "607997", "631467")
SUBSCRIPTION_OFFERINGS = ("607996", "607997", "615324", "615325", "729920")
BUILT_IN_STORAGE = {
    "m3.medium": 4, "m3.large": 32, "m3.xlarge": 80, "m3.2xlarge": 160,
    "r3.large": 32, "r3.xlarge": 80, "r3.2xlarge": 160, "r3.4xlarge": 320, "r3.8xlarge": 640,
    "i2.xlarge": 800, "i2.2xlarge": 1600, "i2.4xlarge": 3200, "i2.8xlarge": 6400,
}


@dataclass(frozen=True)
class ServiceProfile:
    product_code: str
    instance_token: str
    categories: dict = field(hash=False)
    generations: dict = field(hash=False)
    metering_instances_only: bool
    metering_by_operation: bool
    domains_per_account: bool
    default_compute_type: str
    monitor_prefix: str
    full_cost_model: bool


SERVICE_A = ServiceProfile("AmazonES", "ESInstance", {"instance": "ESInstance", "transfer": "-Out", "storage": "Storage|PIOPS"}, {}, True, False, False, "", "CW:", True)
SERVICE_B = ServiceProfile(
    "AmazonCloudSearch",
    "SearchInstance",
    {"upload": "DocumentBatchUpload", "index": "IndexDocuments", "instance": "SearchInstance", "transfer": "Out-Bytes"},
    {"2011": "CSDomain:001", "2013": "CSDomain:002"},
    False,
    True,
    True,
    "m1.small",
    "",
    False,
)

AS_OF = f"DATE '{fx.AS_OF}'"


def _in(values) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values) + ")"


def _dbl(expr: str, scale: int = 2) -> str:
    return f"CAST(round({expr}, {scale}) AS DOUBLE)"


def _sum_if(cond: str, amount: str = "billed_amount") -> str:
    return f"coalesce(sum(CASE WHEN {cond} THEN {amount} END), 0)"


def _rank(value: str) -> str:
    return (
        f"rank() OVER (PARTITION BY year, week ORDER BY {value} DESC NULLS LAST)"
        f" + (count(*) OVER (PARTITION BY year, week, {value}) - 1) / 2.0"
    )


KIND = "regexp_replace(usage_type, '^[^:]*:?', '')"
EXT, INT = "is_internal_flag = 'N'", "is_internal_flag = 'Y'"
GROSS = "is_internal_flag = 'N' AND credit_id IS NULL"

# Region prefixes and airport codes, both ways.
AIRPORT = (
    "CASE {0} WHEN '' THEN 'IAD' WHEN 'USW2' THEN 'PDX' WHEN 'USW1' THEN 'SFO' WHEN 'EU' THEN 'DUB' WHEN 'APN1' THEN 'NRT'"
    " WHEN 'APS1' THEN 'SIN' WHEN 'APS2' THEN 'SYD' WHEN 'APS3' THEN 'BOM' WHEN 'SAE1' THEN 'GRU' WHEN 'EUC1' THEN 'FRA'"
    " WHEN 'APN2' THEN 'ICN' WHEN 'USE2' THEN 'CMH' WHEN 'IAD' THEN '' WHEN 'PDX' THEN 'USW2' WHEN 'SFO' THEN 'USW1'"
    " WHEN 'DUB' THEN 'EU' WHEN 'NRT' THEN 'APN1' WHEN 'SIN' THEN 'APS1' WHEN 'SYD' THEN 'APS2' WHEN 'BOM' THEN 'APS3'"
    " WHEN 'GRU' THEN 'SAE1' WHEN 'FRA' THEN 'EUC1' WHEN 'ICN' THEN 'APN2' WHEN 'CMH' THEN 'USE2' ELSE 'IAD' END"
)

DIRECTORY = {
    "week_calendar": """
        SELECT day, CAST(year(day) AS INTEGER) AS year, CAST(strftime(day, '%W') AS INTEGER) AS week, CAST(strftime(day, '%U') AS INTEGER) AS sunday_week,
               CAST(year(tue - 7) AS INTEGER) AS previous_year, CAST(strftime(tue - 7, '%W') AS INTEGER) AS previous_week,
               CAST(year(tue + 7) AS INTEGER) AS next_year, CAST(strftime(tue + 7, '%W') AS INTEGER) AS next_week,
               sun AS range_start, sun + 6 AS range_end
        FROM (SELECT day, jan1 + CAST((8 - isodow(jan1)) % 7 + (w - 1) * 7 + 1 AS INTEGER) AS tue, jan1 + CAST((7 - isodow(jan1)) % 7 + (w - 1) * 7 AS INTEGER) AS sun
              FROM (SELECT DISTINCT CAST(l_shipdate AS DATE) AS day, make_date(year(l_shipdate), 1, 1) AS jan1, CAST(strftime(l_shipdate, '%W') AS INTEGER) AS w FROM lineitem))""",
    "customer_directory": "SELECT account_id, payer_account_id, company, is_internal_flag FROM directory",
    "customer_directory_legacy": f"""
        SELECT account_id, payer_account_id, coalesce(company, 'e-mail Domain:' || email_domain) AS company, CASE WHEN internal = 'external' THEN 'N' ELSE 'Y' END AS is_internal_flag
        FROM accounts WHERE account_id IN (SELECT account_id FROM subscriptions WHERE offering_id IN {_in(SUBSCRIPTION_OFFERINGS)} AND (end_date IS NULL OR end_date >= {AS_OF} - 9))""",
    "payer_directory": f"""
        SELECT a.account_id, coalesce(a.payer_account_id, a.account_id) AS payer_account_id, company, CASE WHEN internal = 'external' THEN 'N' ELSE 'Y' END AS is_internal_flag
        FROM accounts a WHERE coalesce(a.payer_account_id, a.account_id) IN (SELECT coalesce(b.payer_account_id, b.account_id) FROM accounts b
            WHERE b.account_id IN (SELECT account_id FROM subscriptions WHERE offering_id IN {_in(SUBSCRIPTION_OFFERINGS)} AND (end_date IS NULL OR end_date >= {AS_OF} - 9)))""",
    "offering_accounts": f"SELECT DISTINCT year, week, account_id, is_internal_flag, offering_id FROM weekly_charges WHERE offering_id IN {_in(CUSTOMER_OFFERINGS)}",
    "customer_offering": f"""
        SELECT d.account_id, d.payer_account_id, d.company, o.year, o.week, o.is_internal_flag, o.offering_id FROM directory d
        LEFT JOIN (SELECT DISTINCT year, week, account_id, is_internal_flag, offering_id FROM weekly_charges WHERE offering_id IN {_in(CUSTOMER_OFFERINGS)}) o ON o.account_id = d.account_id""",
    "excluded_accounts": "SELECT account_id, 'test' AS reason FROM test_accounts UNION SELECT account_id, 'lab' FROM lab_accounts",
    "weekly_charges": f"SELECT year, week, account_id, is_internal_flag, {_dbl('billed_amount')} AS billed_amount, usage_type, region, operation, credit_id, charge_item_desc, offering_id, usage_value, {_dbl('price_per_unit', 4)} AS price_per_unit FROM charges",
    "weekly_usage_by_domain": "SELECT year, week, account_id, is_internal_flag, usage_resource, region, sum(usage_value) AS sum_usage_value FROM weekly_metering GROUP BY ALL",
    "daily_charges": f"SELECT computation_date, charge_item_desc, account_id, payer_account_id, usage_type, usage_value, offering_id, {_dbl('billed_amount')} AS billed_amount, {_dbl('price_per_unit', 4)} AS price_per_unit, region, is_internal_flag, credit_id FROM daily_charges",
    "daily_metering": "SELECT request_day, account_id, usage_type, usage_value, usage_resource, operation FROM daily_metering",
    "price_list": f"SELECT product, client_product_code, usage_type, region, {_dbl('price', 4)} AS price FROM price_list",
    "price_plan": f"SELECT usage_type, {_dbl('price_unit', 4)} AS price FROM price_plan WHERE plan_id = 2",
}


def weekly_metering(p: ServiceProfile) -> str:
    keys = "year, week, account_id, is_internal_flag, usage_resource, usage_type, region" + (", operation" if p.metering_by_operation else "")
    like = f"WHERE usage_type LIKE '%{p.instance_token}%'" if p.metering_instances_only else ""
    return f"SELECT {keys}, sum(usage_value) AS sum_usage_value FROM metering {like} GROUP BY ALL"


def weekly_grains(p: ServiceProfile) -> str:
    """One select per grain, each over the weeks and the one before them."""
    dimensions = {"usage_type": "VARCHAR", "region": "VARCHAR", "operation": "VARCHAR", "is_credit": "BOOLEAN", "usage_resource": "VARCHAR"}
    inside = "(year, week) IN (SELECT (src_year, src_week) FROM week_map WHERE back < 2)"
    charges = f"(SELECT *, credit_id IS NOT NULL AS is_credit FROM weekly_charges WHERE {inside})"
    metering = f"(SELECT * FROM weekly_metering WHERE {inside} AND usage_type LIKE '%{p.instance_token}%')"
    amount, usage = f"{_dbl('sum(billed_amount)')} AS billed_amount, CAST(NULL AS DOUBLE) AS usage_value", "CAST(NULL AS DOUBLE) AS billed_amount, sum(usage_value) AS usage_value"
    selects = []
    for grain, source, sums, kept in (
        ("charge_account", charges, amount, ("operation", "is_credit")),
        ("charge_type", charges, amount, ("usage_type", "operation", "is_credit")),
        ("charge_region", charges, amount, ("region",)),
        ("usage_resource", metering, usage, ("usage_resource",)),
        ("usage_type", metering, usage, ("usage_type",)),
        ("usage_region", metering, usage, ("region",)),
    ):
        columns = ", ".join(d if d in kept else f"CAST(NULL AS {kind}) AS {d}" for d, kind in dimensions.items())
        keys = ", ".join(("year", "week", "account_id", "is_internal_flag", *kept))
        selects.append(f"SELECT '{grain}' AS grain, year, week, account_id, is_internal_flag, {columns}, {sums} FROM {source} GROUP BY {keys}")
    return " UNION ALL ".join(selects)


GOALS = "LEFT JOIN goals g USING (year, week)"

ACCOUNT_WEEKS = """
    SELECT year, week, account_id, is_internal_flag, round(sum(billed_amount), 2) > 0 AS pays FROM charges
    WHERE account_id NOT IN (SELECT account_id FROM lab_accounts) GROUP BY ALL"""

REVENUE_CLASSES = f"""
    (SELECT m.year, m.week, a.account_id, a.is_internal_flag, a.pays, m.back FROM ({ACCOUNT_WEEKS}) a
     JOIN week_map m ON a.year = m.src_year AND a.week = m.src_week AND m.back < 2)"""

COUNTED_NEW = "(SELECT * FROM new_active_customers WHERE account_id NOT IN (SELECT account_id FROM test_accounts) AND account_id NOT IN (SELECT account_id FROM lab_accounts))"
COUNTED_LOST = COUNTED_NEW.replace("new_active", "new_inactive")


def customer_counts() -> str:
    """Counts by joining one row per account, class and age."""
    return f"""
    , state AS {REVENUE_CLASSES},
    n AS {COUNTED_NEW}, l AS {COUNTED_LOST},
    now AS (SELECT * FROM state WHERE back = 0), was AS (SELECT * FROM state WHERE back = 1),
    c AS (SELECT year, week, count(DISTINCT CASE WHEN {EXT} THEN account_id END) AS active_count,
                 count(DISTINCT CASE WHEN {EXT} AND pays THEN account_id END) AS active_paying_count,
                 count(DISTINCT CASE WHEN {EXT} AND NOT pays THEN account_id END) AS zero_revenue_count,
                 count(DISTINCT CASE WHEN {INT} THEN account_id END) AS active_count_internal FROM now GROUP BY ALL),
    nn AS (SELECT n.year, n.week, count(DISTINCT CASE WHEN n.{EXT} AND s.{EXT} AND NOT s.pays THEN n.account_id END) AS new_zerorev_active_count,
                  count(DISTINCT CASE WHEN n.{EXT} AND s.{EXT} AND s.pays THEN n.account_id END) AS new_paying_active_count,
                  count(DISTINCT CASE WHEN n.{INT} THEN n.account_id END) AS new_active_count_internal
           FROM n LEFT JOIN now s ON s.year = n.year AND s.week = n.week AND s.account_id = n.account_id GROUP BY ALL),
    ll AS (SELECT l.year, l.week, count(DISTINCT CASE WHEN l.{EXT} AND s.{EXT} AND NOT s.pays THEN l.account_id END) AS new_zerorev_inactive_count,
                  count(DISTINCT CASE WHEN l.{EXT} AND s.{EXT} AND s.pays THEN l.account_id END) AS new_paying_inactive_count,
                  count(DISTINCT CASE WHEN l.{INT} THEN l.account_id END) AS new_inactive_count_internal
           FROM l LEFT JOIN was s ON s.year = l.year AND s.week = l.week AND s.account_id = l.account_id GROUP BY ALL),
    x AS (SELECT a.year, a.week, count(DISTINCT CASE WHEN b.pays AND NOT a.pays THEN a.account_id END) AS convert_to_zerorev_count,
                 count(DISTINCT CASE WHEN NOT b.pays AND a.pays THEN a.account_id END) AS convert_to_paying_count
          FROM now a JOIN was b ON a.year = b.year AND a.week = b.week AND a.account_id = b.account_id WHERE a.{EXT} AND b.{EXT} GROUP BY ALL)
    """


COUNT_COLUMNS = [
    "active_count", "active_paying_count", "zero_revenue_count", "active_count_internal", "new_zerorev_active_count",
    "new_paying_active_count", "new_active_count_internal", "new_zerorev_inactive_count", "new_paying_inactive_count",
    "new_inactive_count_internal", "convert_to_paying_count", "convert_to_zerorev_count",
]


def _zeroed(names) -> str:
    return ", ".join(f"coalesce({n}, 0) AS {n}" for n in names)


JOINED_COUNTS = "weeks LEFT JOIN c USING (year, week) LEFT JOIN nn USING (year, week) LEFT JOIN ll USING (year, week) LEFT JOIN x USING (year, week)"
COUNTS_SELECT = f"""
    SELECT year, week, {_zeroed(COUNT_COLUMNS)},
           coalesce(new_zerorev_active_count, 0) + coalesce(new_paying_active_count, 0) AS new_active_count,
           coalesce(new_zerorev_inactive_count, 0) + coalesce(new_paying_inactive_count, 0) AS new_inactive_count,
           g.paying_customer_goal, g.active_customer_goal FROM {JOINED_COUNTS} {GOALS}"""

TRIAL = f"""
    , now AS (SELECT DISTINCT year, week, account_id, is_internal_flag, operation FROM charges WHERE account_id NOT IN (SELECT account_id FROM lab_accounts)),
    was AS (SELECT DISTINCT m.year, m.week, account_id FROM charges a JOIN week_map m ON a.year = m.src_year AND a.week = m.src_week AND m.back = 1 WHERE {EXT}),
    trial AS (SELECT m.year, m.week, account_id, back FROM free_trial f JOIN week_map m ON f.year = m.src_year AND f.week = m.src_week AND m.back < 2 WHERE {EXT}),
    n AS (SELECT * FROM new_active_customers WHERE account_id NOT IN (SELECT account_id FROM test_accounts)),
    l AS (SELECT * FROM new_inactive_customers WHERE account_id NOT IN (SELECT account_id FROM test_accounts)),
    keys AS (SELECT year, week, account_id FROM now UNION SELECT year, week, account_id FROM was UNION SELECT year, week, account_id FROM trial
             UNION SELECT year, week, account_id FROM n UNION SELECT year, week, account_id FROM l),
    f AS (SELECT k.year, k.week, k.account_id,
            EXISTS (SELECT 1 FROM now x WHERE x.year = k.year AND x.week = k.week AND x.account_id = k.account_id AND x.{EXT}) AS act,
            EXISTS (SELECT 1 FROM now x WHERE x.year = k.year AND x.week = k.week AND x.account_id = k.account_id AND x.{EXT} AND operation = 'CSDomain:001') AS g1,
            EXISTS (SELECT 1 FROM now x WHERE x.year = k.year AND x.week = k.week AND x.account_id = k.account_id AND x.{EXT} AND operation = 'CSDomain:002') AS g2,
            EXISTS (SELECT 1 FROM now x WHERE x.year = k.year AND x.week = k.week AND x.account_id = k.account_id AND x.{INT}) AS int,
            EXISTS (SELECT 1 FROM was x WHERE x.year = k.year AND x.week = k.week AND x.account_id = k.account_id) AS was_act,
            EXISTS (SELECT 1 FROM trial x WHERE x.year = k.year AND x.week = k.week AND x.account_id = k.account_id AND back = 0) AS free,
            EXISTS (SELECT 1 FROM trial x WHERE x.year = k.year AND x.week = k.week AND x.account_id = k.account_id AND back = 1) AS was_free,
            EXISTS (SELECT 1 FROM n x WHERE x.year = k.year AND x.week = k.week AND x.account_id = k.account_id AND x.{EXT}) AS new,
            EXISTS (SELECT 1 FROM n x WHERE x.year = k.year AND x.week = k.week AND x.account_id = k.account_id AND x.{INT}) AS new_int,
            EXISTS (SELECT 1 FROM l x WHERE x.year = k.year AND x.week = k.week AND x.account_id = k.account_id AND x.{EXT}) AS lost,
            EXISTS (SELECT 1 FROM l x WHERE x.year = k.year AND x.week = k.week AND x.account_id = k.account_id AND x.{INT}) AS lost_int
          FROM keys k)
    SELECT year, week, count(CASE WHEN act THEN 1 END) AS active_count, count(CASE WHEN g1 THEN 1 END) AS customer_2011, count(CASE WHEN g2 THEN 1 END) AS customer_2013, count(CASE WHEN act AND NOT free THEN 1 END) AS active_paying_count,
           count(CASE WHEN free THEN 1 END) AS free_trial_count, count(CASE WHEN int THEN 1 END) AS active_count_internal, count(CASE WHEN new AND free THEN 1 END) AS new_free_active_count,
           count(CASE WHEN new AND act AND NOT free THEN 1 END) AS new_paying_active_count, count(CASE WHEN new_int THEN 1 END) AS new_active_count_internal,
           count(CASE WHEN lost AND was_free THEN 1 END) AS new_free_inactive_count, count(CASE WHEN lost AND was_act AND NOT was_free THEN 1 END) AS new_paying_inactive_count,
           count(CASE WHEN lost_int THEN 1 END) AS new_inactive_count_internal, count(CASE WHEN was_free AND act AND NOT free THEN 1 END) AS convert_to_paying_count,
           count(CASE WHEN new AND free THEN 1 END) + count(CASE WHEN new AND act AND NOT free THEN 1 END) AS new_active_count,
           count(CASE WHEN lost AND was_free THEN 1 END) + count(CASE WHEN lost AND was_act AND NOT was_free THEN 1 END) AS new_inactive_count,
           any_value(g.paying_customer_goal) AS paying_customer_goal, any_value(g.active_customer_goal) AS active_customer_goal
    FROM weeks JOIN f USING (year, week) {GOALS} GROUP BY year, week"""

TRIAL_COLUMNS = [
    "active_count", "customer_2011", "customer_2013", "active_paying_count", "free_trial_count", "active_count_internal", "new_free_active_count",
    "new_paying_active_count", "new_active_count_internal", "new_free_inactive_count", "new_paying_inactive_count", "new_inactive_count_internal",
    "convert_to_paying_count", "new_active_count", "new_inactive_count", "paying_customer_goal", "active_customer_goal",
]

FREETIER = f"""
    , ft AS (SELECT m.year, m.week, account_id, back FROM free_tier f JOIN week_map m ON f.year = m.src_year AND f.week = m.src_week AND m.back < 2 WHERE {EXT}),
    n AS (SELECT * FROM new_active_customers), l AS (SELECT * FROM new_inactive_customers),
    z AS (SELECT year, week, account_id FROM weekly_charges GROUP BY ALL HAVING round(sum(billed_amount), 2) = 0),
    nt AS (SELECT account_id FROM test_accounts),
    a AS (SELECT year, week, count(DISTINCT CASE WHEN {EXT} THEN account_id END) AS active_count, count(DISTINCT CASE WHEN {INT} THEN account_id END) AS active_count_internal FROM charges GROUP BY ALL),
    b AS (SELECT n.year, n.week, count(DISTINCT CASE WHEN {EXT} AND ft.account_id IS NOT NULL THEN n.account_id END) AS new_free_active_count,
                 count(DISTINCT CASE WHEN {EXT} AND ft.account_id IS NULL THEN n.account_id END) AS new_paying_active_count,
                 count(DISTINCT CASE WHEN {INT} THEN n.account_id END) AS new_active_count_internal
          FROM n LEFT JOIN ft ON ft.back = 0 AND ft.year = n.year AND ft.week = n.week AND ft.account_id = n.account_id WHERE n.account_id NOT IN (SELECT account_id FROM nt) GROUP BY ALL),
    d AS (SELECT l.year, l.week, count(DISTINCT CASE WHEN {EXT} AND ft.account_id IS NOT NULL THEN l.account_id END) AS new_free_inactive_count,
                 count(DISTINCT CASE WHEN {EXT} AND ft.account_id IS NULL THEN l.account_id END) AS new_paying_inactive_count,
                 count(DISTINCT CASE WHEN {INT} AND l.account_id NOT IN (SELECT account_id FROM nt) THEN l.account_id END) AS new_inactive_count_internal
          FROM l LEFT JOIN ft ON ft.back = 1 AND ft.year = l.year AND ft.week = l.week AND ft.account_id = l.account_id GROUP BY ALL),
    e AS (SELECT year, week, count(DISTINCT account_id) AS convert_to_paying_count FROM free_to_pay GROUP BY ALL),
    h AS (SELECT ft.year, ft.week, count(*) AS zero_revenue_free_count FROM ft JOIN z USING (year, week, account_id) WHERE back = 0 GROUP BY ALL)
    SELECT year, week, {_zeroed(["new_free_active_count", "new_paying_active_count", "new_active_count_internal", "new_free_inactive_count", "new_paying_inactive_count", "new_inactive_count_internal", "convert_to_paying_count", "zero_revenue_free_count", "active_count", "active_count_internal"])},
           coalesce(new_free_active_count, 0) + coalesce(new_paying_active_count, 0) AS new_active_count,
           coalesce(new_free_inactive_count, 0) + coalesce(new_paying_inactive_count, 0) AS new_inactive_count,
           coalesce(active_count, 0) - coalesce(zero_revenue_free_count, 0) AS active_paying_count, g.paying_customer_goal, g.active_customer_goal
    FROM weeks LEFT JOIN a USING (year, week) LEFT JOIN b USING (year, week) LEFT JOIN d USING (year, week) LEFT JOIN e USING (year, week) LEFT JOIN h USING (year, week) {GOALS}"""

RECONCILE = """
    , r AS (SELECT year, week, count(*) AS new_listed FROM n WHERE is_internal_flag = 'N' GROUP BY ALL),
    s AS (SELECT year, week, count(*) AS lost_listed FROM l WHERE is_internal_flag = 'N' GROUP BY ALL)
    SELECT year, week, coalesce(new_listed, 0) AS new_listed, coalesce(new_zerorev_active_count, 0) + coalesce(new_paying_active_count, 0) AS new_classified,
           coalesce(lost_listed, 0) AS lost_listed, coalesce(new_zerorev_inactive_count, 0) + coalesce(new_paying_inactive_count, 0) AS lost_classified,
           coalesce(new_listed, 0) = coalesce(new_zerorev_active_count, 0) + coalesce(new_paying_active_count, 0) AS new_agrees,
           coalesce(lost_listed, 0) = coalesce(new_zerorev_inactive_count, 0) + coalesce(new_paying_inactive_count, 0) AS lost_agrees
    FROM weeks LEFT JOIN nn USING (year, week) LEFT JOIN ll USING (year, week) LEFT JOIN r USING (year, week) LEFT JOIN s USING (year, week)"""

ADOPTION = """
    , used AS (SELECT DISTINCT s.year, s.week, a.account_id FROM compute_fact f JOIN dim_activity USING (activity_type_id) JOIN dim_compute_accounts a USING (account_seq_id)
               JOIN sunday_days s ON s.day = f.week_begin_date AND s.back = 1
               WHERE biz_product_group = 'EC2' AND biz_product_name IN ('EC2 Instance Usage', 'EC2 RI Leases') AND a.is_internal_flag = 'N' AND is_fraud_flag = 'N'
                 AND is_compromised_flag = 'N' AND account_status_code = 'Active')
    SELECT w.year, w.week, count(u.account_id) AS ec2_count, count(c.account_id) AS es_ec2_count
    FROM weeks w LEFT JOIN used u ON u.year = w.year AND u.week = w.week LEFT JOIN charged_accounts c ON c.year = u.year AND c.week = u.week AND c.account_id = u.account_id GROUP BY ALL"""


def goal_lookup() -> str:
    return customer_counts() + f"""
    , r AS (SELECT year, week, {_dbl("sum(billed_amount)")} AS revenue_external_gross FROM charges WHERE {GROSS} GROUP BY ALL)
    SELECT year, week, coalesce(active_paying_count, 0) AS active_paying_count, coalesce(active_count, 0) AS active_count, coalesce(r.revenue_external_gross, 0) AS revenue_external_gross,
           g.paying_customer_goal, g.active_customer_goal, g.revenue_goal
    FROM weeks LEFT JOIN c USING (year, week) LEFT JOIN r USING (year, week) {GOALS}"""


# -- resources -------------------------------------------------------------------------------------

def domain_counts(p: ServiceProfile) -> str:
    owner = (
        "SELECT DISTINCT year, week, account_id, usage_resource FROM used WHERE is_internal_flag = 'N' AND usage_resource IS NOT NULL"
        if p.domains_per_account
        else "SELECT year, week, usage_resource, min(account_id) AS account_id FROM used WHERE is_internal_flag = 'N' AND usage_resource IS NOT NULL GROUP BY ALL"
    )
    return f"""
    , used AS (SELECT * FROM metering WHERE usage_type LIKE '%{p.instance_token}%' AND account_id NOT IN (SELECT account_id FROM lab_accounts)
               AND (year, week, account_id) IN (SELECT (year, week, account_id) FROM charged_accounts)),
    c AS (SELECT year, week, count(DISTINCT CASE WHEN {EXT} THEN coalesce(usage_resource, 'none') END) AS external_domain_count, count(DISTINCT CASE WHEN {INT} THEN coalesce(usage_resource, 'none') END) AS internal_domain_count FROM used GROUP BY ALL),
    o AS (SELECT year, week, account_id, count(*) AS n FROM ({owner}) GROUP BY ALL),
    s AS (SELECT year, week, count(CASE WHEN n = 1 THEN 1 END) AS one_domain_customer_count, count(CASE WHEN n > 1 THEN 1 END) AS multi_domain_customer_count FROM o GROUP BY ALL)
    SELECT year, week, {_zeroed(["external_domain_count", "internal_domain_count", "one_domain_customer_count", "multi_domain_customer_count"])}
    FROM weeks LEFT JOIN c USING (year, week) LEFT JOIN s USING (year, week)"""


CHARGED = "(year, week, account_id) IN (SELECT (year, week, account_id) FROM charged_accounts)"


def instance_hours(p):
    return f"SELECT year, week, {KIND} AS instance_type, sum(usage_value) AS hours FROM metering WHERE usage_type LIKE '%{p.instance_token}%' AND {EXT} AND {CHARGED} GROUP BY ALL"


def instance_revenue(p):
    return f"SELECT year, week, {KIND} AS instance_type, {_dbl('sum(billed_amount)')} AS revenue FROM charges WHERE usage_type LIKE '%{p.instance_token}%' AND {EXT} GROUP BY ALL"


def region_customers(p):
    return f"SELECT year, week, region, count(DISTINCT account_id) AS customer_count FROM metering WHERE usage_type LIKE '%{p.instance_token}%' AND {EXT} AND {CHARGED} GROUP BY ALL"


REGION_REVENUE = f"SELECT year, week, region, {_dbl('sum(billed_amount)')} AS revenue FROM charges WHERE {EXT} AND region IS NOT NULL GROUP BY ALL"

DOMAIN_DIFF = """
    , seen AS (SELECT DISTINCT m.year, m.week, back, account_id, region, usage_resource FROM weekly_metering u JOIN week_map m ON u.year = m.src_year AND u.week = m.src_week AND back < 2 WHERE is_internal_flag = 'N')
    SELECT year, week, company, region, count(CASE WHEN back = 0 THEN 1 END) - count(CASE WHEN back = 1 THEN 1 END) AS diff, count(CASE WHEN back = 1 THEN 1 END) AS d1, count(CASE WHEN back = 0 THEN 1 END) AS d2
    FROM seen JOIN payers USING (account_id) WHERE company IS NOT NULL AND region IS NOT NULL GROUP BY ALL"""

CUSTOMER_DIFF = """
    , ch AS (SELECT year, week, account_id, 1 AS n FROM new_active_customers WHERE is_internal_flag = 'N' UNION ALL SELECT year, week, account_id, -1 FROM new_inactive_customers WHERE is_internal_flag = 'N')
    SELECT year, week, q.company, CAST(sum(n) AS BIGINT) AS diff FROM ch JOIN payers p USING (account_id) JOIN payers q ON q.account_id = coalesce(p.payer_account_id, p.account_id)
    WHERE q.company IS NOT NULL GROUP BY ALL"""


LIFETIMES = """
    SELECT account_id, is_internal_flag, arg_min(year, (year, week)) AS first_year, arg_min(week, (year, week)) AS first_week,
           arg_max(year, (year, week)) AS last_year, arg_max(week, (year, week)) AS last_week, count(DISTINCT (year, week)) AS weeks
    FROM weekly_metering GROUP BY account_id, is_internal_flag"""


def domain_usage(p):
    return f"SELECT year, week, usage_resource, usage_type, sum(usage_value) AS hours, {KIND} AS instance_type FROM weekly_metering WHERE usage_type LIKE '%{p.instance_token}%' GROUP BY ALL"


NEW_DOMAINS = """
    (SELECT * FROM ({0}) x WHERE (year, week, coalesce(usage_resource, 'none')) NOT IN (SELECT (w.year, w.week, coalesce(y.usage_resource, 'none')) FROM week_map w JOIN ({0}) y ON y.year = w.src_year AND y.week = w.src_week AND w.back = 1))"""


def new_domains(p):
    return "SELECT * FROM " + NEW_DOMAINS.format(weekly_metering(p))


def new_domain_mix(p, weeks):
    columns = ", ".join(
        f"max(CASE WHEN year = {y} AND week = {w} THEN n END) AS domain_count_{y}_{w:02d}, max(CASE WHEN year = {y} AND week = {w} THEN n / total END) AS pct_{y}_{w:02d}"
        for y, w in weeks
    )
    inside = " OR ".join(f"(year = {y} AND week = {w})" for y, w in weeks)
    return f"""
    , c AS (SELECT year, week, {KIND} AS instance_type, count(DISTINCT (coalesce(usage_resource, 'none'), usage_type)) AS n FROM {NEW_DOMAINS.format(weekly_metering(p))} WHERE {inside} GROUP BY ALL),
    s AS (SELECT *, CAST(sum(n) OVER (PARTITION BY year, week) AS DOUBLE) AS total FROM c)
    SELECT instance_type, {columns} FROM s GROUP BY instance_type"""


# -- revenue ---------------------------------------------------------------------------------------

def _per_week(sums: dict[str, str]) -> str:
    aggs = ", ".join(f"{_dbl(_sum_if(c))} AS {n}" for n, c in sums.items())
    return f"SELECT year, week, {aggs} FROM charges GROUP BY year, week"


AMORTISED = """
    (SELECT s.year, s.week, f.*, product_code, billed_amount * amortization_factor AS credit, refund_amount * amortization_factor AS refund
     FROM revenue_fact f JOIN dim_products USING (product_seq_id) JOIN sunday_days s ON s.day = f.computation_date AND s.back = 0 WHERE product_code = '{}')"""


def credit_totals(product: str) -> str:
    return f"""SELECT year, week, {_dbl('sum(c)', 4)} AS credit_amount, {_dbl('sum(r)', 4)} AS refund_amount
        FROM (SELECT year, week, charge_item_desc, sum(credit) AS c, sum(refund) AS r FROM {AMORTISED.format(product)} GROUP BY ALL HAVING sum(credit) < 0 OR sum(refund) < 0) GROUP BY ALL"""


def revenue_summary(p):
    return f"""SELECT year, week, revenue_external_gross, revenue_internal, credit_amount, refund_amount, revenue_goal
        FROM ({_per_week({"revenue_external_gross": GROSS, "revenue_internal": INT})}) LEFT JOIN ({credit_totals(p.product_code)}) USING (year, week)
        LEFT JOIN goals USING (year, week)"""


def revenue_by_category(p):
    def cond(pattern):
        return f"regexp_matches(usage_type, '{pattern}')"

    sums = {f"revenue_{n}": f"{GROSS} AND {cond(x)}" for n, x in p.categories.items()}
    sums |= {f"revenue_{n}_internal": f"{INT} AND {cond(x)}" for n, x in p.categories.items()}
    return _per_week(sums)


def revenue_by_generation(p):
    return _per_week({f"revenue_{n}": f"{GROSS} AND operation = '{op}'" for n, op in p.generations.items()})


PAYER_REVENUE = """
    (SELECT year, week, coalesce(payer_account_id, account_id) AS account_id, sum(billed_amount) AS billed_amount FROM charges LEFT JOIN payers USING (account_id)
     WHERE charges.is_internal_flag = 'N' OR credit_id IS NOT NULL GROUP BY ALL)"""


def size_bands() -> str:
    bounds = {"micro": (None, 100), "S": (100, 1000), "M": (1000, 10000), "L": (10000, 100000), "XL": (100000, 1000000), "above_XL": (1000000, None)}
    aggs = []
    for n, (lo, hi) in bounds.items():
        cond = " AND ".join([f"m >= {lo}"] * (lo is not None) + [f"m < {hi}"] * (hi is not None))
        aggs += [f"count(CASE WHEN {cond} THEN 1 END) AS customer_{n}_count", f"{_dbl(_sum_if(cond))} AS customer_{n}_revenue"]
    return f"""SELECT year, week, {", ".join(aggs)} FROM (SELECT *, CAST(billed_amount AS DECIMAL(20,2)) * CAST(4.345238 AS DECIMAL(7,6)) AS m FROM {PAYER_REVENUE}) GROUP BY year, week"""


def _top_five(revenue: str) -> str:
    return f"""SELECT year, week, account_id, CAST(rn AS INTEGER) AS position, company, 'X' || account_id AS label, {_dbl('billed_amount')} AS billed_amount
        FROM (SELECT *, row_number() OVER (PARTITION BY year, week ORDER BY billed_amount DESC, account_id) AS rn FROM {revenue}) LEFT JOIN payers USING (account_id) WHERE rn <= 5"""


TOP_INTERNAL = _top_five(f"(SELECT year, week, account_id, sum(billed_amount) AS billed_amount FROM charges WHERE {INT} GROUP BY ALL)")

CLIENTS = "(SELECT payer_account_id AS account_id, arg_min(company, account_id) AS client FROM directory WHERE payer_account_id IS NOT NULL AND company IS NOT NULL AND company NOT ILIKE '%MSP%' GROUP BY ALL)"

FOUR = f"""
    , pay AS (SELECT m.year, m.week, back, coalesce(payer_account_id, account_id) AS account_id, sum(billed_amount) AS v FROM charges c LEFT JOIN payers USING (account_id)
              JOIN week_map m ON c.year = m.src_year AND c.week = m.src_week WHERE c.is_internal_flag = 'N' GROUP BY ALL),
    wide AS (SELECT year, week, account_id, {", ".join(f"coalesce(sum(CASE WHEN back = {k} THEN v END), 0) AS charge_{k}" for k in range(4))} FROM pay GROUP BY ALL),
    up AS (SELECT year, week, coalesce(payer_account_id, account_id) AS account_id, company, {", ".join(f"sum(charge_{k}) AS charge_{k}" for k in range(4))}
           FROM wide JOIN payers USING (account_id) WHERE company IS NOT NULL GROUP BY year, week, coalesce(payer_account_id, account_id), company),
    four AS (SELECT year, week, account_id, CASE WHEN company ILIKE '%MSP%' AND client IS NOT NULL THEN company || ' - ' || client ELSE company END AS company,
                    charge_0, charge_1, charge_2, charge_3 FROM up LEFT JOIN {CLIENTS} USING (account_id))"""
CHARGES4 = ", ".join(f"{_dbl(f'charge_{k}')} AS charge_{k}" for k in range(4))
FOUR_WEEK = FOUR + f" SELECT year, week, account_id, company, {CHARGES4} FROM four"
RESELLERS = f"SELECT account_id, company, client, company || ' - ' || client AS label FROM payers JOIN {CLIENTS} USING (account_id) WHERE company ILIKE '%MSP%'"
TOP_CUSTOMERS = FOUR + f"""
    SELECT year, week, CAST(rn AS INTEGER) AS position, rank_0, rank_1, account_id, company, {CHARGES4}
    FROM (SELECT *, CAST({_rank('charge_0')} AS DOUBLE) AS rank_0, CAST({_rank('charge_1')} AS DOUBLE) AS rank_1,
                 row_number() OVER (PARTITION BY year, week ORDER BY charge_0 DESC, account_id, company) AS rn FROM four) WHERE rn <= 100"""
GAINERS = FOUR + f"""
    , r AS (SELECT *, charge_0 - charge_1 AS diff FROM four),
    s AS (SELECT *, CAST({_rank('diff')} AS DOUBLE) AS rank, row_number() OVER (PARTITION BY year, week ORDER BY diff DESC, account_id, company) AS up_rn,
                 row_number() OVER (PARTITION BY year, week ORDER BY diff, account_id, company) AS down_rn FROM r)
    SELECT year, week, 'gainer' AS section, CAST(up_rn AS INTEGER) AS position, rank, account_id, company, {_dbl('diff')} AS diff, {CHARGES4} FROM s WHERE up_rn <= 30
    UNION ALL SELECT year, week, 'loser', CAST(down_rn AS INTEGER), rank, account_id, company, {_dbl('diff')}, {CHARGES4} FROM s WHERE down_rn <= 30"""
CUSTOMER_LIST = f"""SELECT year, week, account_id, p.is_internal_flag, company, {_dbl('b')} AS billed_amount, payer_account_id
    FROM (SELECT year, week, account_id, sum(billed_amount) AS b FROM charges GROUP BY ALL) LEFT JOIN payers p USING (account_id)"""


def top_by_region(p):
    return f"""
    , ag AS (SELECT year, week, account_id, region, is_internal_flag, sum(billed_amount) AS b FROM charges WHERE region IS NOT NULL GROUP BY ALL),
    res AS (SELECT DISTINCT year, week, account_id, region, is_internal_flag, usage_resource FROM weekly_metering WHERE usage_type LIKE '%{p.instance_token}%')
    SELECT ag.year, ag.week, ag.region, ag.is_internal_flag, ag.account_id, company, product_name AS service_contract, usage_resource, {_dbl('b')} AS billed_amount
    FROM ag LEFT JOIN payers ON payers.account_id = ag.account_id LEFT JOIN (SELECT * FROM support_contracts WHERE product_name <> 'NULL') s ON s.account_id = ag.account_id AND ag.is_internal_flag = 'N'
    LEFT JOIN res ON res.year = ag.year AND res.week = ag.week AND res.account_id = ag.account_id AND res.region = ag.region AND res.is_internal_flag = ag.is_internal_flag"""


REAL = "account_id NOT IN (SELECT account_id FROM test_accounts)"
DROPPED = f"""
    , x AS (SELECT max_request_year AS year, max_request_week AS week, account_id, company, sum(billed_amount) AS b, min(min_request_day) AS min_request_day, max(max_request_day) AS max_request_day
            FROM active_date WHERE {EXT} AND {REAL} AND company IS NOT NULL GROUP BY ALL)
    SELECT year, week, account_id, company, {_dbl('b')} AS billed_amount, min_request_day, max_request_day, CAST({_rank('b')} AS DOUBLE) AS rank FROM x"""


def new_customers(p):
    return f"""
    , x AS (SELECT a.year, a.week, a.account_id, company, count(DISTINCT usage_resource) AS sum_domain_count, CAST(sum(CAST(v AS DECIMAL(18,2))) AS DOUBLE) AS sum_usage_value
            FROM (SELECT min_request_year AS year, min_request_week AS week, account_id, company FROM active_date WHERE {EXT} AND {REAL}) a
            JOIN (SELECT year, week, account_id, usage_resource, sum(usage_value) AS v FROM weekly_metering WHERE usage_type LIKE '%{p.instance_token}%' GROUP BY ALL) m
                 ON m.year = a.year AND m.week = a.week AND m.account_id = a.account_id GROUP BY ALL)
    SELECT year, week, account_id, company, sum_domain_count, sum_usage_value, CAST({_rank('sum_usage_value')} AS DOUBLE) AS rank FROM x"""


# -- credits ---------------------------------------------------------------------------------------

def _lines(product: str) -> str:
    return f"""(SELECT year, week, computation_date, charge_item_desc AS description, a.account_id, CAST(sum(credit) AS DECIMAL(30,4)) AS credits, CAST(sum(refund) AS DECIMAL(30,4)) AS refunds
        FROM {AMORTISED.format(product)} x JOIN dim_accounts a USING (account_seq_id)
        GROUP BY year, week, computation_date, charge_item_desc, a.account_id, charge_period_start_date, charge_period_end_date, credit_id, base_currency_code
        HAVING sum(credit) < 0 OR sum(refund) < 0)"""


def _top_and_rest(source: str, k: int, by: str, scale: int) -> str:
    return f"""
    , ranked AS (SELECT *, row_number() OVER (PARTITION BY {by} ORDER BY billed_amount, account_id, company, description) AS rn FROM {source})
    SELECT {by}, account_id, company, description, {_dbl('billed_amount', scale)} AS billed_amount, CAST(rn AS INTEGER) AS position FROM ranked WHERE rn <= {k}
    UNION ALL SELECT {by}, '', 'other', '', {_dbl(f'coalesce(sum(CASE WHEN rn > {k} THEN billed_amount END), 0)', scale)}, {k + 1} FROM ranked GROUP BY {by}"""


def credits_refunds(product: str) -> str:
    return f"""
    , lines AS (SELECT year, week, coalesce(payer_account_id, account_id) AS account_id, company, description, credits, refunds FROM {_lines(product)} LEFT JOIN payers USING (account_id) WHERE company IS NOT NULL),
    kinds AS (SELECT year, week, 'credit' AS kind, account_id, company, description, sum(credits) AS billed_amount FROM lines WHERE credits < 0 GROUP BY ALL
              UNION ALL SELECT year, week, 'refund', account_id, company, description, sum(refunds) FROM lines WHERE refunds < 0 GROUP BY ALL)
    """ + _top_and_rest("kinds", 20, "year, week, kind", 4)


CREDITS_LEGACY = """
    , paid AS (SELECT year, week, coalesce(payer_account_id, account_id) AS account_id, charge_item_desc AS description, sum(billed_amount) AS billed_amount
               FROM charges LEFT JOIN payers USING (account_id) WHERE credit_id IS NOT NULL GROUP BY ALL),
    named AS (SELECT paid.*, company FROM paid LEFT JOIN payers USING (account_id))""" + _top_and_rest("named", 15, "year, week", 2)


def credits_kpi(product: str, weeks=None) -> str:
    chosen = "weeks" if weeks is None else "(VALUES " + ", ".join(map(str, weeks)) + ") w(year, week)"
    edp = "refunds < 0 AND regexp_matches(description, 'enterprise|Enterprise') AND regexp_matches(description, 'discount|Discount')"
    return f"""
    , lines AS (SELECT year, week, coalesce(payer_account_id, account_id) AS account, description, credits, refunds FROM {_lines(product)} LEFT JOIN payers USING (account_id)),
    k AS (SELECT year, week, {_dbl(_sum_if('credits < 0', 'credits'), 4)} AS credits_amount, count(DISTINCT CASE WHEN credits < 0 THEN account END) AS credits_accounts,
           {_dbl(_sum_if('refunds < 0', 'refunds'), 4)} AS refunds_amount, count(DISTINCT CASE WHEN refunds < 0 THEN account END) AS refunds_accounts,
           {_dbl(_sum_if(edp, 'refunds'), 4)} AS edp_amount, count(DISTINCT CASE WHEN {edp} THEN account END) AS edp_accounts FROM lines GROUP BY ALL)
    SELECT year, week, {_zeroed(["credits_amount", "credits_accounts", "refunds_amount", "refunds_accounts", "edp_amount", "edp_accounts"])} FROM {chosen} LEFT JOIN k USING (year, week)"""


# -- cost ------------------------------------------------------------------------------------------

def _cost(p: ServiceProfile) -> str:
    head = "split_part(usage_type, '-', 1)"
    code = AIRPORT.format(head)
    dashed = f"CASE WHEN {code} = 'IAD' THEN usage_type ELSE regexp_replace(usage_type, '^[^-]*-?', '') END"
    place = "split_part(usage_type, ':', 1)"
    box = f"CASE WHEN regexp_replace({place}, '^[^-]*-?', '') = '' THEN '' ELSE split_part({place}, '-', 1) END"
    box_kind = f"CASE WHEN {KIND} = '' THEN '{p.default_compute_type}' ELSE {KIND} END"
    monitor = f"replace({dashed}, '{p.monitor_prefix}', '')" if p.monitor_prefix else dashed
    parts = {
        "ec2_cost": ("client_product_code = 'AmazonEC2' AND usage_type LIKE '%BoxUsage%'", AIRPORT.format(f"({box})"), box_kind),
        "ebs_cost": ("client_product_code = 'AmazonEC2' AND usage_type LIKE '%VolumeUsage%'", AIRPORT.format(f"split_part({place}, '-', 1)"), KIND),
        "elb_cost": ("client_product_code = 'AmazonEC2' AND regexp_matches(usage_type, 'LoadBalancer|DataProcessing-Bytes')", code, dashed),
        "monitor_cost": ("usage_type LIKE '%MonitorUsage%'", code, monitor),
        "s3_cost": ("client_product_code = 'AmazonS3'", code, dashed),
        "dynamo_cost": ("client_product_code = 'AmazonDynamoDB'", code, dashed),
    }
    if not p.full_cost_model:
        del parts["ebs_cost"]
    union = " UNION ALL ".join(
        f"SELECT year, week, client_product_code, '{n}' AS component, {where} AS region, {kind} AS kind, v FROM u WHERE {cond}"
        for n, (cond, where, kind) in parts.items()
    )
    sums = ", ".join(_sum_if(f"component = '{n}'", "price * v") + f" AS {n}" for n in parts)
    over = "+".join(f"CAST({n} AS DECIMAL(30,6))" for n in ("ec2_cost", "ebs_cost", "elb_cost", "monitor_cost", "s3_cost"))
    extra = ""
    if p.full_cost_model:
        extra = f""", ebs_volume, s3_volume, swf_cost, cf_cost, r53_cost, CAST({over} AS DECIMAL(30,6)) * CAST(0.11 AS DECIMAL(3,2)) AS band_cost,
            CAST(revenue AS DECIMAL(30,2)) * CAST(0.043 AS DECIMAL(4,3)) AS sales_cost"""
    volume = "CAST({} AS DECIMAL(24,2)) * CAST(4.345238 AS DECIMAL(7,6))"
    half = "CAST({} AS DECIMAL(28,2)) * CAST(0.5 AS DECIMAL(2,1))"
    return f"""
    , u AS (SELECT year, week, client_product_code, usage_type, CAST(sum(usage_value) AS DECIMAL(20,2)) AS v, sum(billed_amount) AS b FROM product_weekly_charges GROUP BY ALL),
    parts AS ({union}),
    priced AS (SELECT parts.*, price FROM parts LEFT JOIN price_list l ON l.region = parts.region AND l.usage_type = parts.kind AND l.client_product_code = parts.client_product_code),
    a AS (SELECT year, week, {sums}, count(CASE WHEN price IS NULL THEN 1 END) AS unpriced_rows FROM priced GROUP BY ALL),
    d AS (SELECT year, week, {volume.format(_sum_if("client_product_code = 'AmazonEC2' AND usage_type LIKE '%VolumeUsage%'", "v"))} AS ebs_volume,
                 {volume.format(_sum_if("client_product_code = 'AmazonS3' AND usage_type LIKE '%TimedStorage%'", "v"))} AS s3_volume,
                 {half.format(_sum_if("client_product_code = 'AmazonSWF'", "b"))} AS swf_cost, {half.format(_sum_if("client_product_code = 'AmazonCloudFront'", "b"))} AS cf_cost,
                 {half.format(_sum_if("client_product_code = 'AmazonRoute53'", "b"))} AS r53_cost FROM u GROUP BY ALL),
    r AS (SELECT year, week, sum(billed_amount) AS revenue FROM charges GROUP BY ALL),
    k AS (SELECT year, week, {", ".join(parts)}, unpriced_rows, revenue{extra} FROM a JOIN d USING (year, week) JOIN r USING (year, week))
    """


def _cost_columns(p) -> list[str]:
    if p.full_cost_model:
        return ["ec2_cost", "ebs_cost", "elb_cost", "monitor_cost", "s3_cost", "dynamo_cost", "ebs_volume", "s3_volume", "swf_cost", "cf_cost", "r53_cost", "band_cost", "sales_cost"]
    return ["ec2_cost", "elb_cost", "monitor_cost", "s3_cost", "dynamo_cost"]


def product_cost(p, weeks=None) -> str:
    chosen = "" if weeks is None else " WHERE (year, week) IN (" + ", ".join(map(str, weeks)) + ")"
    return _cost(p) + f"SELECT year, week, unpriced_rows, {', '.join(f'{_dbl(c, 4)} AS {c}' for c in _cost_columns(p))} FROM k{chosen}"


def cost_margin(p) -> str:
    total = " + ".join(f"CAST({c} AS DECIMAL(26,8))" for c in _cost_columns(p) if c.endswith("_cost"))
    return _cost(p) + f"SELECT year, week, {_dbl(total, 4)} AS overall_cost, 1 - {_dbl(total, 4)} / {_dbl('revenue')} AS overall_margin FROM k"


# -- daily -----------------------------------------------------------------------------------------

def _diff(key: str) -> str:
    return f"""(SELECT computation_date, {key}, {_sum_if('back = 1', 'v')} AS y, {_sum_if('back = 0', 'v')} AS t
        FROM (SELECT computation_date + back AS computation_date, back, {key}, sum(billed_amount) AS v FROM daily_charges CROSS JOIN (VALUES (0), (1)) b(back) WHERE {EXT} GROUP BY ALL)
        WHERE computation_date <= DATE '{fx.LAST_DAY}' GROUP BY ALL)"""


DIFF_COLUMNS = f"{_dbl('y')} AS charge_yesterday, {_dbl('t')} AS charge_today, {_dbl('t - y')} AS diff"
PLAN = "(SELECT usage_type, price_unit AS price FROM price_plan WHERE plan_id = {})"
FAMILY = """(SELECT account_id FROM support_contracts UNION SELECT p.account_id FROM payers p WHERE p.payer_account_id IN
    (SELECT coalesce(q.payer_account_id, s.account_id) FROM support_contracts s LEFT JOIN payers q ON q.account_id = s.account_id))"""
SINCE = "DATE '1995-12-18'"

DAILY = {
    "daily_gainers": f"SELECT computation_date, account_id, {DIFF_COLUMNS}, company FROM {_diff('account_id')} LEFT JOIN payers USING (account_id)",
    "daily_charge_type_diff": f"SELECT computation_date, usage_type, {DIFF_COLUMNS} FROM {_diff('usage_type')}",
    "daily_usage_diff": f"""
        SELECT request_day, account_id, usage_resource, usage_type, y AS usage_yesterday, t AS usage_today, t - y AS diff, {_dbl('price', 4)} AS price, payer_account_id, company,
               {_dbl('CAST(t - y AS DECIMAL(18,2)) * price', 4)} AS charge_diff
        FROM (SELECT request_day, account_id, usage_resource, usage_type, coalesce(sum(CASE WHEN back = 1 THEN v END), 0) AS y, coalesce(sum(CASE WHEN back = 0 THEN v END), 0) AS t
              FROM (SELECT request_day + back AS request_day, back, account_id, usage_resource, usage_type, sum(usage_value) AS v FROM daily_metering CROSS JOIN (VALUES (0), (1)) b(back) WHERE usage_resource IS NOT NULL GROUP BY ALL)
              WHERE request_day <= DATE '{fx.LAST_DAY}' GROUP BY ALL) LEFT JOIN {PLAN.format(2)} USING (usage_type) JOIN payers USING (account_id) WHERE payer_account_id IS NOT NULL""",
    "account_daily_charge": f"SELECT computation_date, account_id, {_dbl('b')} AS billed_amount, company FROM (SELECT computation_date, account_id, sum(billed_amount) AS b FROM daily_charges WHERE {EXT} GROUP BY ALL) LEFT JOIN payers USING (account_id)",
    "payer_family_charges": f"SELECT computation_date, charge_item_desc, account_id, payer_account_id, usage_type, usage_value, offering_id, {_dbl('billed_amount')} AS billed_amount, {_dbl('price_per_unit', 4)} AS price_per_unit, region, is_internal_flag, credit_id FROM daily_charges WHERE computation_date >= {SINCE} AND account_id IN {FAMILY}",
    "payer_family_usage": f", family AS MATERIALIZED {FAMILY} SELECT request_day, account_id, usage_type, usage_value, usage_resource, operation FROM daily_metering WHERE request_day >= {SINCE} AND account_id IN (SELECT account_id FROM family)",
    "reprice": f"""SELECT computation_date, account_id, usage_type, usage_value, {_dbl('billed_amount', 4)} AS billed_amount, {_dbl('price', 4)} AS price_unit_custom,
        {_dbl('price * CAST(usage_value AS DECIMAL(18,2))', 4)} AS custom_billed_amount, {_dbl('billed_amount - price * CAST(usage_value AS DECIMAL(18,2))', 4)} AS diff FROM daily_charges LEFT JOIN {PLAN.format(5)} USING (usage_type)""",
    "daily_revenue_check": f"""
        SELECT computation_date, {_dbl('sum(billed_amount * amortization_factor)', 3)} AS revenue, count(DISTINCT a.account_id) AS developer_count
        FROM revenue_fact f JOIN dim_accounts a ON a.account_seq_id = f.account_seq_id JOIN dim_accounts p ON p.account_seq_id = f.payer_account_seq_id
        JOIN dim_products USING (product_seq_id) JOIN region_mapping USING (usage_type)
        WHERE computation_date >= {SINCE} AND a.is_internal_flag = 'N' AND product_code = 'AmazonES' AND coalesce(a.fraud_enforcement_status, 'OK') IN ('OK', 'Reinstated') GROUP BY 1""",
    "recent_usage_regions": f"SELECT DISTINCT usage_type, region FROM dim_usage_types u WHERE EXISTS (SELECT 1 FROM daily_metering m WHERE m.usage_type = u.usage_type AND request_day >= DATE '{fx.LAST_DAY}' - 60)",
}

BUILT_IN = "(VALUES " + ", ".join(f"('{k}', {v})" for k, v in BUILT_IN_STORAGE.items()) + ") e(instance_type, built_in)"
CONFIG = f"""
    , ch AS (SELECT DISTINCT computation_date AS request_day, account_id, is_internal_flag FROM daily_charges),
    m AS (SELECT daily_metering.*, is_internal_flag FROM daily_metering JOIN ch USING (request_day, account_id) WHERE usage_resource IS NOT NULL),
    st AS (SELECT request_day, usage_resource, sum(usage_value) AS stored FROM m WHERE regexp_matches(usage_type, 'Storage|PIOPS') GROUP BY ALL),
    i AS (SELECT m.*, price FROM m JOIN {PLAN.format(2)} USING (usage_type) WHERE usage_type LIKE '%ESInstance%'),
    h AS (SELECT request_day, usage_resource, sum(usage_value) AS instance_hour FROM i GROUP BY ALL),
    ty AS (SELECT request_day, usage_resource, account_id, is_internal_flag, arg_max(usage_type, (price, usage_type)) AS usage_type FROM i GROUP BY ALL),
    j AS (SELECT ty.request_day, ty.usage_resource, account_id, is_internal_flag, {KIND} AS instance_type, instance_hour, stored, round_even(instance_hour / 24, 0) AS node_count
          FROM ty JOIN h USING (request_day, usage_resource) LEFT JOIN st USING (request_day, usage_resource)),
    config AS (SELECT request_day, usage_resource, account_id, is_internal_flag, instance_type, instance_hour, CASE WHEN stored IS NULL THEN built_in * node_count ELSE stored END AS storage_size,
               CASE WHEN stored IS NULL THEN 'ephemeral' ELSE 'EBS' END AS storage_type, node_count FROM j LEFT JOIN {BUILT_IN} USING (instance_type))"""
DAILY["domain_config"] = CONFIG + " SELECT * FROM config"
DAILY["ephemeral_trend"] = CONFIG + f" SELECT request_day, coalesce(sum(storage_size), 0) AS storage_size FROM config WHERE storage_type <> 'EBS' AND date_diff('day', request_day, DATE '{fx.LAST_DAY}') % 7 = 0 GROUP BY ALL"
DAILY["domain_config_cost"] = f"""
    SELECT account_id, domain, data_node_type, data_node_count, {_dbl('price', 4)} AS price, {_dbl('price * 24 * data_node_count', 4)} AS cost, price IS NULL AS unpriced, company, payer_account_id, is_internal_flag
    FROM domain_configs c JOIN payers USING (account_id) LEFT JOIN {PLAN.format(2)} p ON p.usage_type = 'ESInstance:' || data_node_type"""

# -- suspended and exposed resources ---------------------------------------------------------------

STATUS = f"""
    (SELECT account_id, account_status_code, suspended_date, CAST(date_diff('day', suspended_date, {AS_OF}) AS INTEGER) AS suspended_days
     FROM (SELECT account_id, max(CASE WHEN current_record_flag = 'Y' THEN account_status_code END) AS account_status_code,
                  max(CASE WHEN account_status_code = 'Active' THEN coalesce(end_effective_date, {AS_OF}) END) AS la,
                  min(CASE WHEN account_status_code = 'Suspended' THEN start_effective_date END) AS fs,
                  CASE WHEN fs IS NULL THEN NULL WHEN la IS NULL OR la < fs THEN fs ELSE la END AS suspended_date
           FROM account_history GROUP BY account_id))"""
SUBSCRIBED = f"(SELECT account_id, max(end_date) AS subscription_end_date, CAST(date_diff('day', max(end_date), {AS_OF}) AS INTEGER) AS unsubscribed_days FROM subscriptions WHERE end_date IS NOT NULL GROUP BY ALL)"
IDLE = f"""
    (SELECT m.* EXCLUDE (kind, usage_type), m.kind AS usage_type, price, price * CAST(sum_usage_value AS DECIMAL(18,2)) AS cost,
            account_status_code, suspended_date, suspended_days
     FROM (SELECT *, {KIND} AS kind FROM ({{}}) WHERE usage_type LIKE '%Instance%') m LEFT JOIN price_list l ON l.usage_type = m.kind AND l.region = m.region JOIN {STATUS} s ON s.account_id = m.account_id
     WHERE m.account_id NOT IN (SELECT account_id FROM lab_accounts) AND (m.year, m.week, m.account_id) NOT IN (SELECT (year, week, account_id) FROM charged_accounts) AND account_status_code = 'Suspended')"""


def suspended_domains(p):
    operation = "operation, " if p.metering_by_operation else ""
    return f"""SELECT year, week, x.account_id, is_internal_flag, usage_resource, usage_type, region, {operation}sum_usage_value, {_dbl('price', 4)} AS price, {_dbl('cost', 4)} AS cost, account_status_code,
        suspended_date, suspended_days, subscription_end_date, unsubscribed_days FROM {IDLE.format(weekly_metering(p))} x LEFT JOIN {SUBSCRIBED} b ON b.account_id = x.account_id"""


def suspended_trend(p):
    return f"""
    , x AS {IDLE.format(weekly_metering(p))}
    SELECT w.year, w.week, count(DISTINCT CASE WHEN {INT} THEN account_id || coalesce(usage_resource, 'none') END) AS internal_count, count(DISTINCT CASE WHEN {EXT} THEN account_id || coalesce(usage_resource, 'none') END) AS external_count,
           {_dbl(_sum_if(INT, 'cost'), 4)} AS internal_cost, {_dbl(_sum_if(EXT, 'cost'), 4)} AS external_cost, count(CASE WHEN x.account_id IS NOT NULL AND price IS NULL THEN 1 END) AS unpriced_rows FROM weeks w LEFT JOIN x ON x.year = w.year AND x.week = w.week GROUP BY w.year, w.week"""


EXPOSED = f"""
    (SELECT e.account_id, e.domain_name, e.region, account_status_code, f.is_internal_flag, 'arn:aws:es:' || e.region || ':' || e.account_id || ':domain/' || e.domain_name AS arn, product_name,
            CASE WHEN e.account_id IN (SELECT account_id FROM impacted_accounts) THEN 'Y' END AS impacted
     FROM exposed_list e LEFT JOIN {STATUS} s ON s.account_id = e.account_id LEFT JOIN (SELECT DISTINCT account_id, is_internal_flag FROM weekly_charges) f ON f.account_id = e.account_id
     LEFT JOIN support_contracts c ON c.account_id = e.account_id)"""
UNSUPPORTED = f"(SELECT * FROM {EXPOSED} WHERE is_internal_flag = 'N' AND account_status_code = 'Active' AND account_id NOT IN (SELECT account_id FROM support_contracts))"
STATUSES = {
    "account_status": f"SELECT * FROM {STATUS}",
    "subscription_status": f"SELECT * FROM {SUBSCRIBED}",
    "exposed_domains": f"SELECT * FROM {EXPOSED}",
    "exposed_stats": f"SELECT count(*) AS exposed, count(CASE WHEN account_status_code = 'Suspended' THEN 1 END) AS suspended, count(CASE WHEN account_status_code = 'Active' AND {EXT} THEN 1 END) AS active_external FROM {EXPOSED}",
    "exposed_unsupported": f"SELECT * FROM {UNSUPPORTED}",
    "exposed_by_account": f"SELECT account_id, arn FROM {UNSUPPORTED} WHERE impacted IS NULL",
    "exposed_joined": f"""SELECT account_id, part, CAST(coalesce(so_far, 0) // 65536 AS BIGINT) AS piece, string_agg(arn, '|' ORDER BY arn) AS arns
        FROM (SELECT account_id, arn, substr(md5(arn), 1, 1) AS part,
                     sum(strlen(arn) + 1) OVER (PARTITION BY account_id, substr(md5(arn), 1, 1) ORDER BY md5(arn), arn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS so_far
              FROM {UNSUPPORTED} WHERE impacted IS NULL) GROUP BY ALL""",
}

# -- free tier and catalogues ----------------------------------------------------------------------

MONTH = "strftime(computation_date, '%Y-%m')"
FREE_ROWS = f"(SELECT {MONTH} AS month, * FROM daily_charges WHERE {EXT} AND usage_type LIKE '%t2.micro%' AND billed_amount = 0 AND {REAL})"
MONTH_COST = f"""(SELECT month, {_dbl('coalesce(sum(CAST(h AS DECIMAL(20,2)) * price), 0)', 4)} AS cost, count(CASE WHEN price IS NULL THEN 1 END) AS unpriced_rows FROM (SELECT month, region, sum(usage_value) AS h FROM {FREE_ROWS} GROUP BY ALL)
    LEFT JOIN (SELECT region, price FROM price_list WHERE usage_type = 't2.micro') USING (region) GROUP BY month)"""
MONTHLY = f"(SELECT {MONTH} AS month, {_dbl('sum(billed_amount)')} AS revenue FROM daily_charges WHERE {EXT} GROUP BY 1)"
HOURS = "CAST(usage_value AS DECIMAL(18,2))"


def _free_cost(price: str) -> str:
    return f"CAST(round(coalesce(sum(CASE WHEN free THEN {HOURS} * {price} END), 0), 4) AS DOUBLE) / CAST(1.4 AS DOUBLE)"


def _tracked(name: str) -> str:
    here = f"regexp_matches(usage_type, '{name}')"
    key = name.replace(".", "_")
    return f"{_dbl(_sum_if(here))} AS {key}_bill, CAST(round({_sum_if(here + ' AND price_per_unit = 0', HOURS + ' * price')}, 4) AS DOUBLE) / CAST(1.4 AS DOUBLE) AS {key}_cost"


FREE = {
    "freetier_daily_cost": f"""
        SELECT computation_date, revenue, current_cost, new_cost, unpriced_rows, current_cost / nullif(revenue, 0) AS ratio FROM (
            SELECT computation_date, {_dbl('sum(billed_amount)')} AS revenue, {_free_cost('p.price')} AS current_cost, {_free_cost('q.price')} AS new_cost,
                   count(DISTINCT CASE WHEN free AND (p.price IS NULL OR q.price IS NULL) THEN d.usage_type END) AS unpriced_rows
            FROM (SELECT *, regexp_matches(usage_type, 't2.micro') AND offering_id = '607996' AND price_per_unit = 0 AS free FROM daily_charges WHERE {EXT}) d
            LEFT JOIN {PLAN.format(2)} p ON p.usage_type = d.usage_type LEFT JOIN {PLAN.format(2)} q ON q.usage_type = replace(d.usage_type, 't2.micro', 't2.small') GROUP BY computation_date)""",
    "freetier_track": f"SELECT computation_date, {_tracked('t2.small')}, {_tracked('t2.micro')}, count(DISTINCT CASE WHEN regexp_matches(usage_type, 't2.small|t2.micro') AND price_per_unit = 0 AND price IS NULL THEN usage_type END) AS unpriced_rows FROM daily_charges LEFT JOIN {PLAN.format(2)} USING (usage_type) WHERE {EXT} AND offering_id IN ('607996', '615324') GROUP BY computation_date",
    "freetier_month_rows": f"SELECT month, account_id, is_internal_flag, {_dbl('billed_amount')} AS billed_amount, usage_type, usage_value, {_dbl('price_per_unit', 4)} AS price_per_unit, region, credit_id, charge_item_desc FROM {FREE_ROWS}",
    "freetier_month_cost": f"SELECT * FROM {MONTH_COST}",
    "monthly_revenue": f"SELECT * FROM {MONTHLY}",
    "freetier_month_report": f"SELECT month, cost, unpriced_rows, revenue FROM {MONTH_COST} LEFT JOIN {MONTHLY} USING (month)",
    "freetier_members": "SELECT account_id, year, week FROM free_tier",
    "t2small_free_cost": f"""
        , f AS (SELECT DISTINCT year, week, account_id FROM free_tier),
        t AS (SELECT * FROM weekly_charges WHERE {EXT} AND usage_type LIKE '%t2.small%' AND (year, week, account_id) IN (SELECT (year, week, account_id) FROM f)),
        p AS (SELECT DISTINCT year, week, region, price_per_unit FROM t),
        u AS (SELECT year, week, account_id, region, least(sum(usage_value), 168) AS h FROM t GROUP BY ALL),
        q AS (SELECT year, week, count(CASE WHEN price_per_unit IS NULL THEN 1 END) AS unpriced_rows FROM p GROUP BY ALL),
        c AS (SELECT year, week, {_dbl('sum(CAST(h AS DECIMAL(18,2)) * price_per_unit)', 4)} AS cost, count(DISTINCT account_id) AS t2small_user_count FROM u JOIN p USING (year, week, region) GROUP BY ALL),
        n AS (SELECT year, week, count(*) AS freetier_count FROM f GROUP BY ALL)
        SELECT year, week, coalesce(cost, 0) AS cost, coalesce(freetier_count, 0) AS freetier_count, coalesce(t2small_user_count, 0) AS t2small_user_count, coalesce(unpriced_rows, 0) AS unpriced_rows FROM weeks LEFT JOIN n USING (year, week) LEFT JOIN c USING (year, week) LEFT JOIN q USING (year, week)""",
    "price_catalog": f"""
        SELECT description, usage_type, {_dbl('price_unit', 4)} AS price_unit, usage_unit, replace(replace(split_part(usage_type, ':', 1), 'BoxUsage', ''), '-', '') AS region, {KIND} AS instance_type
        FROM price_catalog_raw WHERE description LIKE '%Linux%' AND usage_type LIKE '%BoxUsage%' AND description NOT LIKE '%Dedicated%'
        UNION ALL SELECT description, usage_type, {_dbl('price_unit', 4)}, usage_unit, replace(replace(split_part(usage_type, ':', 1), 'EBS', ''), '-', ''),
               CASE {KIND} WHEN 'VolumeUsage.gp2' THEN 'GP2-Storage' WHEN 'VolumeUsage.piops' THEN 'PIOPS-Storage' WHEN 'VolumeUsage' THEN 'Magnetic-Storage' WHEN 'VolumeP-IOPS.piops' THEN 'PIOPS' END
        FROM price_catalog_raw WHERE regexp_matches(usage_type, 'VolumeUsage|VolumeP-IOPS') AND NOT regexp_matches(usage_type, 'sc1|st1')""",
    "price_matrix_new": f"""
        SELECT prefix, usage_type, {_dbl('price', 4)} AS price, region FROM (SELECT *, CASE WHEN prefix = '' THEN name ELSE prefix || '-' || name END AS usage_type FROM price_matrix_long) LEFT JOIN regions USING (prefix)
        WHERE price > 0 AND usage_type LIKE '%ESInstance%' AND usage_type NOT IN (SELECT usage_type FROM current_products)""",
}


def _flat(sql: str) -> str:
    """A text that starts with further common table expressions, as a subquery."""
    sql = sql.strip()
    return f"(WITH {sql[1:]})" if sql.startswith(",") else f"({sql})"


def _tall(sql: str, columns: list[str]) -> str:
    return " UNION ALL ".join(
        f"SELECT year, week, '{c}' AS metric, CAST({c} AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS text FROM {_flat(sql)}" for c in columns
    )


def _named(sql: str, name: str, value: str, text: str = "CAST(NULL AS VARCHAR)") -> str:
    return f"SELECT year, week, {name} AS metric, CAST({value} AS DOUBLE) AS value, {text} AS text FROM {_flat(sql)}"


def weekly_metrics(p) -> str:
    bands = [f"customer_{b}_{m}" for b in ("micro", "S", "M", "L", "XL", "above_XL") for m in ("count", "revenue")]
    categories = [f"revenue_{n}{s}" for s in ("", "_internal") for n in p.categories]
    categories += [f"revenue_{n}" for n in p.generations]
    counts_sql, counts = customer_counts() + COUNTS_SELECT, [*COUNT_COLUMNS, "new_active_count", "new_inactive_count", "paying_customer_goal", "active_customer_goal"]
    if p.domains_per_account:
        counts_sql, counts = TRIAL, TRIAL_COLUMNS
    by_usage = {f"revenue_{n}{s}": cond for n, x in p.categories.items() for s, cond in (("", f"{GROSS} AND regexp_matches(usage_type, '{x}')"), ("_internal", f"{INT} AND regexp_matches(usage_type, '{x}')"))}
    by_usage |= {f"revenue_{n}": f"{GROSS} AND operation = '{op}'" for n, op in p.generations.items()}
    return " UNION ALL ".join(
        [
            _tall(domain_counts(p), ["external_domain_count", "internal_domain_count", "one_domain_customer_count", "multi_domain_customer_count"]),
            _tall(counts_sql, counts),
            _tall(revenue_summary(p), ["revenue_external_gross", "revenue_internal", "credit_amount", "refund_amount", "revenue_goal"]),
            _tall(_per_week(by_usage), categories),
            _tall(size_bands(), bands),
            _named(_top_five(PAYER_REVENUE), "'top_external_customer_' || position", "billed_amount", "label"),
            _named(TOP_INTERNAL, "'top_internal_customer_' || position", "billed_amount", "label"),
            _named(instance_hours(p), "instance_type || '_hours'", "hours"),
            _named(instance_revenue(p), "instance_type || '_revenue'", "revenue"),
            _named(region_customers(p), "region || '_customer_count'", "customer_count"),
            _named(REGION_REVENUE, "region || '_revenue'", "revenue"),
            _tall(ADOPTION, ["ec2_count", "es_ec2_count"]),
            _tall(cost_margin(p), ["overall_cost", "overall_margin"]),
        ]
    )


def weekly_metrics_history(p, weeks) -> str:
    columns = ", ".join(f"max(CASE WHEN year = {y} AND week = {w} THEN value END) AS w{y}_{w:02d}" for y, w in weeks)
    inside = ", ".join(map(str, weeks))
    return f"SELECT metric, {columns} FROM ({weekly_metrics(p)}) WHERE (year, week) IN ({inside}) GROUP BY metric"


def report_manifest(p) -> str:
    outputs = {
        "gainer_loser": GAINERS,
        "top_customers": TOP_CUSTOMERS,
        "credits": credits_refunds(p.product_code),
        "new_customers": new_customers(p),
        "dropped_customers": DROPPED,
        "customer_list": CUSTOMER_LIST,
        "top_by_region": top_by_region(p),
        "weekly_metrics": weekly_metrics(p),
        "compute_adoption": ADOPTION,
    }
    return " UNION ALL ".join(f"SELECT '{n}' AS output, count(*) AS row_count FROM {_flat(sql)}" for n, sql in outputs.items())


def texts() -> dict[str, str]:
    a, b = SERVICE_A, SERVICE_B
    plain = {
        **DIRECTORY,
        "weekly_metering": weekly_metering(a),
        "customer_counts": customer_counts() + COUNTS_SELECT,
        "customer_counts_freetier": FREETIER,
        "count_reconcile": customer_counts() + RECONCILE,
        "goal_lookup": goal_lookup(),
        "compute_adoption": ADOPTION,
        "domain_counts": domain_counts(a),
        "instance_hours": instance_hours(a),
        "instance_revenue": instance_revenue(a),
        "region_customers": region_customers(a),
        "region_revenue": REGION_REVENUE,
        "domain_diff": DOMAIN_DIFF,
        "customer_diff": CUSTOMER_DIFF,
        "account_estimates": """SELECT w.year, w.week, is_internal_flag, count(DISTINCT account_id) AS exact, true AS within
            FROM week_map w JOIN weekly_metering m ON m.year = w.src_year AND m.week = w.src_week WHERE w.back < 4 GROUP BY ALL""",
        "presence_joined": "SELECT * FROM new_active_customers",
        "presence_left": "SELECT * FROM new_inactive_customers",
        "presence_converted": "SELECT * FROM free_to_pay",
        "presence_lifetimes": LIFETIMES,
        "presence_new_domains": new_domains(a),
        "presence_domain_diff": DOMAIN_DIFF,
        "presence_customer_diff": CUSTOMER_DIFF,
        "domain_usage": domain_usage(a),
        "new_domains": new_domains(a),
        "new_domain_mix": new_domain_mix(a, fx.WEEKS[2:]),
        "revenue_summary": revenue_summary(a),
        "revenue_by_category": revenue_by_category(a),
        "payer_revenue": f"SELECT year, week, account_id, {_dbl('billed_amount')} AS billed_amount FROM {PAYER_REVENUE}",
        "size_bands": size_bands(),
        "top_external": _top_five(PAYER_REVENUE),
        "top_internal": TOP_INTERNAL,
        "four_week_revenue": FOUR_WEEK,
        "reseller_label": RESELLERS,
        "top_customers": TOP_CUSTOMERS,
        "gainers_losers": GAINERS,
        "customer_list": CUSTOMER_LIST,
        "top_by_region": top_by_region(a),
        "dropped_customers": DROPPED,
        "new_customers": new_customers(a),
        "credits_refunds": credits_refunds(a.product_code),
        "credits_legacy": CREDITS_LEGACY,
        "credit_totals": credit_totals(a.product_code),
        "credits_kpi": credits_kpi("AmazonRDS"),
        "credits_history": credits_kpi("AmazonRDS", fx.WEEKS[:-1]),
        "product_cost": product_cost(a),
        "cost_margin": cost_margin(a),
        "cost_breakdown_history": product_cost(a, fx.WEEKS),
        **DAILY,
        **STATUSES,
        "suspended_domains": suspended_domains(a),
        "suspended_trend": suspended_trend(a),
        **FREE,
        "weekly_metrics": weekly_metrics(a),
        "weekly_grains": weekly_grains(a),
        "weekly_metrics_history": weekly_metrics_history(a, fx.WEEKS),
        "report_run": report_manifest(a),
    }
    of_b = {
        "weekly_metering_b": weekly_metering(b),
        "customer_counts_trial": TRIAL,
        "domain_counts_b": domain_counts(b),
        "instance_hours_b": instance_hours(b),
        "revenue_by_category_b": revenue_by_category(b),
        "revenue_by_generation": revenue_by_generation(b),
        "product_cost_b": product_cost(b),
        "cost_margin_b": cost_margin(b),
        "suspended_domains_b": suspended_domains(b),
        "weekly_metrics_b": weekly_metrics(b),
        "weekly_grains_b": weekly_grains(b),
        "top_customers_b": TOP_CUSTOMERS,
        "gainers_losers_b": GAINERS,
        "credits_refunds_b": credits_refunds(b.product_code),
        "size_bands_b": size_bands(),
        "instance_revenue_b": instance_revenue(b),
        "region_customers_b": region_customers(b),
        "region_revenue_b": REGION_REVENUE,
        "revenue_summary_b": revenue_summary(b),
        "report_run_b": report_manifest(b),
    }
    return {n: with_tables(s) for n, s in plain.items()} | {n: with_tables(s, "B") for n, s in of_b.items()}
