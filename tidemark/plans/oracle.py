"""SQL twins of the catalogue's queries, for an independent engine over the same Parquet tables.

Written from the meaning of each query, not from its plan: theta joins, row numbers and integrals
where the Spark side aggregates.
"""

from __future__ import annotations

from tidemark.functions import rules
from tidemark.operators.features import CATEGORICAL, NUMERIC
from tidemark.schemas import ADD_ONS

ORACLE: dict[str, str] = {}


def num(expression: str, name: str, digits: int = 6) -> str:
    """Rounded double without a negative zero."""
    return f"round(CAST({expression} AS DOUBLE), {digits}) + 0e0 AS {name}"


def text(expression: str, name: str) -> str:
    return f"CAST({expression} AS VARCHAR) AS {name}"


def _add_on(name: str, modulus: int, below: int) -> str:
    return (
        f"CASE WHEN c_nationkey % 3 = 2 THEN 'No internet service' "
        f"WHEN c_custkey % {modulus} < {below} THEN 'Yes' ELSE 'No' END AS {name}"
    )


_ADD_ON_SQL = ",\n    ".join([
    _add_on("online_security", 13, 4),
    _add_on("online_backup", 17, 6),
    _add_on("device_protection", 19, 6),
    _add_on("tech_support", 23, 7),
    _add_on("streaming_tv", 29, 11),
    _add_on("streaming_movies", 31, 12),
])

_TABLES = f"""
life AS (
  SELECT o_custkey, CAST(min(o_orderdate) AS DATE) AS first_day, CAST(max(o_orderdate) AS DATE) AS last_day
  FROM orders GROUP BY o_custkey
),
customers AS (
  SELECT c_custkey AS customer_id,
    CASE c_custkey // 4 % 2 WHEN 0 THEN 'Male' ELSE 'Female' END AS gender,
    CASE WHEN c_custkey % 6 = 0 THEN 1 ELSE 0 END AS senior_citizen,
    CAST(c_custkey // 8 % 2 AS INTEGER) AS partner,
    CASE WHEN c_custkey % 10 < 3 THEN 1 ELSE 0 END AS dependents,
    first_day AS signup_date, '' AS city, n_name AS state, r_name AS country
  FROM customer LEFT JOIN life ON o_custkey = c_custkey
  LEFT JOIN nation ON n_nationkey = c_nationkey
  LEFT JOIN region ON r_regionkey = n_regionkey
),
dated AS (
  SELECT *, CASE WHEN last_day < DATE '2000-10-01' THEN last_day END AS end_day,
    CASE WHEN last_day < DATE '2000-10-01' THEN last_day ELSE DATE '2001-08-01' END AS until_day
  FROM customer LEFT JOIN life ON o_custkey = c_custkey
),
subscriptions AS (
  SELECT c_custkey AS subscription_id, c_custkey AS customer_id,
    CASE WHEN c_mktsegment IN ('BUILDING', 'AUTOMOBILE', 'HOUSEHOLD') THEN 'Month-to-month'
         WHEN c_mktsegment = 'FURNITURE' THEN 'One year' ELSE 'Two year' END AS contract_type,
    CASE c_custkey % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
         WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS payment_method,
    CASE WHEN c_custkey % 5 < 3 THEN 1 ELSE 0 END AS paperless_billing,
    CASE c_nationkey % 3 WHEN 0 THEN 'DSL' WHEN 1 THEN 'Fiber optic' ELSE 'No' END AS internet_service,
    CASE WHEN c_custkey % 11 <> 0 THEN 1 ELSE 0 END AS phone_service,
    CASE WHEN c_custkey % 11 = 0 THEN 'No phone service'
         WHEN c_custkey % 7 < 3 THEN 'Yes' ELSE 'No' END AS multiple_lines,
    {_ADD_ON_SQL},
    CAST(CAST((CAST(round(c_acctbal * 100) AS BIGINT) + 100000) // 100 + 1800 AS DECIMAL(12, 0)) * 0.01
         AS DECIMAL(10, 2)) AS monthly_charges,
    CAST(greatest((year(until_day) - year(first_day)) * 12 + month(until_day) - month(first_day)
      - CASE WHEN day(until_day) < day(first_day) THEN 1 ELSE 0 END, 1) AS INTEGER) AS tenure_months,
    first_day AS start_date, end_day AS end_date,
    CASE WHEN end_day IS NULL THEN 1 ELSE 0 END AS is_active
  FROM dated
),
transactions AS (
  SELECT o_orderkey * 16 AS transaction_id, o_custkey AS customer_id, o_custkey AS subscription_id,
    CAST(o_orderdate AS DATE) AS transaction_date, CAST(o_totalprice AS DECIMAL(12, 2)) AS amount,
    'charge' AS transaction_type,
    CASE o_orderstatus WHEN 'F' THEN 'paid' WHEN 'O' THEN 'pending' ELSE 'failed' END AS status
  FROM orders
  UNION ALL
  SELECT l_orderkey * 16 + 1 + l_linenumber, o_custkey, o_custkey, CAST(l_shipdate AS DATE),
    CAST(-CAST(l_extendedprice AS DECIMAL(12, 2)) AS DECIMAL(12, 2)), 'refund', 'paid'
  FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
  WHERE l_returnflag = 'R'
),
support_tickets AS (
  SELECT event_id AS ticket_id, user_id AS customer_id, CAST(ts AS DATE) AS opened_date,
    CASE WHEN event_type = 'error' THEN 1 + CAST(floor(value) AS BIGINT) % 5 END AS satisfaction_score
  FROM events WHERE event_type IN ('error', 'signup')
),
churn_events AS (
  SELECT subscription_id AS churn_id, customer_id, end_date AS churn_date, 1 AS churn_flag,
    CASE customer_id % 5 WHEN 0 THEN 'Price' WHEN 1 THEN 'Better offer' WHEN 2 THEN 'Service quality'
         WHEN 3 THEN 'Moved' ELSE 'Other' END AS churn_reason
  FROM subscriptions WHERE end_date IS NOT NULL
),
features AS (
  SELECT c.customer_id, gender, senior_citizen, partner, dependents, contract_type, payment_method,
    paperless_billing, internet_service, phone_service, multiple_lines, {", ".join(ADD_ONS)},
    monthly_charges, tenure_months, is_active,
    coalesce(t.n, 0) AS ticket_count, coalesce(t.score, 3.0::DOUBLE) AS avg_satisfaction,
    1 - is_active AS churned
  FROM customers c
  JOIN subscriptions s ON s.customer_id = c.customer_id
  LEFT JOIN (SELECT customer_id, count(*) AS n, avg(satisfaction_score) AS score
             FROM support_tickets GROUP BY customer_id) t ON t.customer_id = c.customer_id
),
terms AS (
  SELECT *, CAST(tenure_months AS DOUBLE) AS x1, CAST(monthly_charges AS DOUBLE) AS x2,
    CASE WHEN contract_type = 'Month-to-month' THEN 1e0 ELSE 0e0 END AS x3,
    CASE WHEN contract_type = 'Two year' THEN 1e0 ELSE 0e0 END AS x4,
    CASE WHEN tech_support = 'No' THEN 1e0 ELSE 0e0 END AS x5,
    CASE WHEN payment_method = 'Electronic check' THEN 1e0 ELSE 0e0 END AS x6,
    CASE WHEN senior_citizen = 1 THEN 1e0 ELSE 0e0 END AS x7,
    CASE WHEN internet_service = 'Fiber optic' THEN 1e0 ELSE 0e0 END AS x8,
    CASE WHEN partner = 0 THEN 1e0 ELSE 0e0 END AS x9
  FROM features
),
card AS (
  SELECT *, 1e0 / (1e0 + exp(-(-3.15e0 - 0.02e0 * x1 + 0.032e0 * x2 + 1.35e0 * x3 - 1.1e0 * x4 + 0.55e0 * x5
    + 0.45e0 * x6 + 0.35e0 * x7 + 0.35e0 * x8 + 0.2e0 * x9))) AS probability
  FROM terms
),
planted AS (
  SELECT * EXCLUDE (churned), round_even(probability, 5) AS churn_probability,
    CASE WHEN CAST('0x' || substr(md5('7:' || CAST(customer_id AS VARCHAR)), 1, 8) AS BIGINT) / 4294967296e0
         < probability THEN 1 ELSE 0 END AS churned
  FROM card
),
valued AS (
  SELECT *, round_even(probability, 5) AS churn_probability,
    CASE WHEN round_even(probability, 5) < 0.3e0 THEN 'Low'
         WHEN round_even(probability, 5) < 0.6e0 THEN 'Medium' ELSE 'High' END AS risk_tier,
    CASE WHEN churned = 1 THEN CAST(tenure_months AS DOUBLE)
         ELSE greatest(CAST(customer_id % 97 AS DOUBLE) + 0.5e0, CAST(tenure_months AS DOUBLE)) END
      AS predicted_total_tenure_months,
    round_even(CASE WHEN churned = 1 THEN CAST(tenure_months AS DOUBLE)
         ELSE greatest(CAST(customer_id % 97 AS DOUBLE) + 0.5e0, CAST(tenure_months AS DOUBLE)) END
      * CAST(monthly_charges AS DOUBLE), 2) AS predicted_clv,
    CAST(floor(CAST(monthly_charges AS DOUBLE) / 32) AS INTEGER) % 4 AS raw_cluster
  FROM card
),
scored AS (
  SELECT v.*, o.segment_cluster,
    CASE o.segment_cluster WHEN 0 THEN 'High-Value Loyal' WHEN 1 THEN 'Growing / Mid-Value'
      WHEN 2 THEN 'Price-Sensitive' WHEN 3 THEN 'Low-Value / New' END AS segment_label
  FROM valued v
  JOIN (SELECT raw_cluster, CAST(row_number() OVER (ORDER BY avg(predicted_clv) DESC, raw_cluster) - 1 AS INTEGER)
          AS segment_cluster
        FROM valued GROUP BY raw_cluster) o ON o.raw_cluster = v.raw_cluster
)"""


def twin(name: str, sql: str) -> None:
    """Register SQL; a leading comma continues the common table expressions."""
    sql = sql.strip()
    ORACLE[name] = f"WITH {_TABLES.strip()}{'' if sql.startswith(',') else chr(10)}{sql}"


_SUBSCRIPTION_COLUMNS = f"""subscription_id, customer_id, contract_type, payment_method, paperless_billing,
  internet_service, phone_service, multiple_lines, {", ".join(ADD_ONS)}, {num("monthly_charges", "monthly_charges")},
  tenure_months, {text("start_date", "start_date")}, {text("end_date", "end_date")}, is_active"""

# --- sources and sinks

twin("csv_round_trip", f"SELECT {_SUBSCRIPTION_COLUMNS} FROM subscriptions")
twin("table_append", f"""
SELECT transaction_type, status, count(*) AS n_rows, {num("sum(amount)", "amount")}
FROM transactions GROUP BY transaction_type, status""")
twin("table_replace", f"""
SELECT contract_type, count(*) AS n_rows, {num("sum(monthly_charges)", "monthly_charges")}
FROM subscriptions WHERE is_active = 1 GROUP BY contract_type""")

_ENDED = "WHERE customer_id IN (SELECT customer_id FROM subscriptions WHERE is_active = 0)"
twin("table_set_replace", "\nUNION ALL\n".join(
    f"SELECT {number} AS set_number, '{table}' AS table_name, count(*) AS n_rows, "
    f"{num(f'coalesce(sum({amount}), 0)', 'amount')} FROM {table} {_ENDED if number == 2 and table in ('customers', 'transactions') else ''}"
    for number in (1, 2)
    for table, amount in {
        "customers": "0", "subscriptions": "monthly_charges", "transactions": "amount", "support_tickets": "0",
        "churn_events": "0",
    }.items()
))

# --- data checks

_KEYS = {
    "customers": "customer_id",
    "subscriptions": "subscription_id",
    "transactions": "transaction_id",
    "support_tickets": "ticket_id",
    "churn_events": "churn_id",
}
twin("pk_check", "\nUNION ALL\n".join(
    f"SELECT '{table}' AS table_name, 'primary_key' AS check_name, '{key}' AS column_name, "
    f"count(*) - count(DISTINCT {key}) AS n_bad FROM {table}"
    for table, key in _KEYS.items()
))
_REQUIRED = {
    "customers": ("customer_id", "signup_date"),
    "subscriptions": ("customer_id", "monthly_charges", "tenure_months"),
    "transactions": ("customer_id", "subscription_id", "amount"),
    "support_tickets": ("customer_id", "opened_date"),
    "churn_events": ("customer_id", "churn_date"),
}
twin("null_check", "\nUNION ALL\n".join(
    f"SELECT '{table}' AS table_name, 'not_null' AS check_name, '{column}' AS column_name, "
    f"count(*) - count({column}) AS n_bad FROM {table}"
    for table, columns in _REQUIRED.items()
    for column in columns
))
twin("load_checks", "\nUNION ALL\n".join([
    *[
        f"SELECT '{table}' AS table_name, 'primary_key' AS check_name, '{key}' AS column_name, "
        f"count(*) - count(DISTINCT {key}) AS n_bad, count(*) AS n_rows FROM {table}"
        for table, key in _KEYS.items()
    ],
    *[
        f"SELECT '{table}', 'not_null', '{column}', count(*) FILTER ({column} IS NULL), count(*) FROM {table}"
        for table, columns in _REQUIRED.items()
        for column in columns
    ],
    *[
        f"SELECT '{child}', 'reference', 'customer_id', "
        f"count(*) FILTER (customer_id IS NULL OR customer_id NOT IN (SELECT customer_id FROM customers)), count(*) FROM {child}"
        for child in ("subscriptions", "transactions", "churn_events")
    ],
]))
twin("fk_check", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS table_name, 'reference' AS check_name, '{column}' AS column_name, "
    f"count(*) AS n_bad FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{column} = c.{column})"
    for name, child, column, parent in (
        ("subscriptions", "subscriptions", "customer_id", "customers"),
        ("transactions", "transactions", "customer_id", "customers"),
        ("churn_events", "churn_events", "customer_id", "customers"),
        ("support_tickets", "support_tickets", "customer_id", "customers"),
        ("transactions", "transactions", "subscription_id", "subscriptions"),
        ("predictions", "scored", "customer_id", "customers"),
    )
))
twin("row_counts", "\nUNION ALL\n".join(
    f"SELECT '{table}' AS table_name, count(*) AS n_rows FROM {table}" for table in _KEYS
))

# --- metric views

_MRR = f"""
SELECT strftime(first_day, '%Y-%m-%d') AS month, {num("sum(monthly_charges)", "mrr")}
FROM (SELECT DISTINCT CAST(date_trunc('month', transaction_date) AS DATE) AS first_day FROM transactions)
JOIN subscriptions ON first_day BETWEEN start_date AND coalesce(end_date, DATE '9999-12-31')
GROUP BY first_day"""
_CHURNED_BY_MONTH = """
SELECT strftime(churn_date, '%Y-%m-01') AS month, count(*) AS churned_customers FROM churn_events GROUP BY 1"""
_RATES = f"""count(*) AS total_customers, count(*) FILTER (is_active = 0) AS churned_customers,
  {num("round(count(*) FILTER (is_active = 0) * 100e0 / count(*), 2)", "churn_rate_pct")}"""
_TENURE_BUCKETS = f"""
SELECT CASE WHEN tenure_months <= 6 THEN '0-6 mo' WHEN tenure_months <= 12 THEN '7-12 mo'
  WHEN tenure_months <= 24 THEN '13-24 mo' WHEN tenure_months <= 48 THEN '25-48 mo' ELSE '48+ mo' END AS tenure_bucket,
  {_RATES}, {num("round(avg(monthly_charges), 2)", "avg_monthly_charges")}
FROM subscriptions GROUP BY 1"""
_PAID = "coalesce(sum(amount) FILTER (transaction_type = 'charge' AND status = 'paid'), 0)"
_REFUNDED = "coalesce(sum(amount) FILTER (transaction_type = 'refund'), 0)"
_CLV = f"""
SELECT customer_id, contract_type, tenure_months, is_active,
  {num(_PAID, "lifetime_revenue")}, {num(_REFUNDED, "total_refunds")}
FROM customers JOIN subscriptions USING (customer_id) LEFT JOIN transactions USING (customer_id)
GROUP BY ALL"""
_COHORT = """
SELECT strftime(signup_date, '%Y-%m-01') AS cohort_month,
  CAST((year(u) - year(signup_date)) * 12 + month(u) - month(signup_date)
    - CASE WHEN day(u) < day(signup_date) THEN 1 ELSE 0 END AS INTEGER) AS months_since_signup,
  count(*) AS customers_active_at_month
FROM (SELECT c.signup_date, coalesce(e.churn_date, DATE '2001-08-01') AS u
      FROM customers c JOIN subscriptions s ON s.customer_id = c.customer_id
      LEFT JOIN churn_events e ON e.customer_id = c.customer_id)
GROUP BY 1, 2"""
_AT_RISK = f"""
SELECT p.risk_tier, count(*) AS customers, {num("sum(s.monthly_charges)", "monthly_revenue_at_risk")}
FROM valued p JOIN subscriptions s USING (customer_id) WHERE s.is_active = 1 GROUP BY ALL"""
_TICKETS = f"""
SELECT is_active, count(DISTINCT customer_id) AS customers,
  {num("round(count(ticket_id) / count(DISTINCT customer_id), 2)", "avg_tickets_per_customer")},
  {num("round(avg(satisfaction_score), 2)", "avg_satisfaction")}
FROM subscriptions LEFT JOIN support_tickets USING (customer_id) GROUP BY ALL"""


def _rate(column: str) -> str:
    return f"SELECT {column}, {_RATES} FROM subscriptions GROUP BY {column}"


twin("mrr_by_month", _MRR)
twin("churned_by_month", _CHURNED_BY_MONTH)
twin("churn_rate_by_contract", _rate("contract_type"))
twin("churn_rate_by_internet", _rate("internet_service"))
twin("churn_rate_by_payment", _rate("payment_method"))
twin("tenure_buckets", _TENURE_BUCKETS)
twin("customer_clv", _CLV)
twin("cohort_lifetime", _COHORT)
twin("revenue_at_risk", _AT_RISK)
twin("tickets_vs_churn", _TICKETS)
twin("named_views", "\nUNION ALL\n".join(
    f"SELECT '{name}' AS view_name, count(*) AS n_rows FROM ({sql})"
    for name, sql in {
        "vw_mrr_by_month": _MRR,
        "vw_churn_rate_by_month": _CHURNED_BY_MONTH,
        "vw_churn_rate_by_contract": _rate("contract_type"),
        "vw_churn_rate_by_internet": _rate("internet_service"),
        "vw_churn_rate_by_payment": _rate("payment_method"),
        "vw_tenure_buckets": _TENURE_BUCKETS,
        "vw_customer_clv": _CLV,
        "vw_cohort_retention": _COHORT,
        "vw_revenue_at_risk": _AT_RISK,
        "vw_tickets_vs_churn": _TICKETS,
    }.items()
))

# --- scalar functions

twin("calendar_columns", """
SELECT subscription_id, strftime(start_date, '%Y-%m-01') AS month_label,
  strftime(start_date, '%Y-%m-01') AS month_start,
  CASE WHEN day(start_date) = 1 THEN strftime(start_date, '%Y-%m-%d')
       ELSE strftime(CAST(date_trunc('month', start_date) AS DATE) + INTERVAL 1 MONTH, '%Y-%m-%d') END
    AS first_full_month,
  CAST((year(u) - year(start_date)) * 12 + month(u) - month(start_date)
    - CASE WHEN day(u) < day(start_date) THEN 1 ELSE 0 END AS INTEGER) AS whole_months,
  CAST((u - start_date) // 30 AS INTEGER) AS periods,
  strftime(start_date + 30 * tenure_months, '%Y-%m-%d') AS last_billing
FROM (SELECT *, coalesce(end_date, DATE '2001-08-01') AS u FROM subscriptions)""")
twin("value_columns", f"""
SELECT customer_id, printf('CU-%05d', customer_id + 1) AS customer_code,
  {num("least(greatest(CAST(monthly_charges AS DOUBLE), 30e0), 90e0)", "clipped_charge")},
  CASE WHEN tenure_months <= 6 THEN '0-6 mo' WHEN tenure_months <= 12 THEN '7-12 mo'
    WHEN tenure_months <= 24 THEN '13-24 mo' WHEN tenure_months <= 48 THEN '25-48 mo' ELSE '48+ mo' END AS tenure_bucket,
  CASE WHEN churn_probability >= 0.5e0 THEN 1 ELSE 0 END AS predicted,
  CASE customer_id % 5 WHEN 0 THEN 'High-Value Loyal' WHEN 1 THEN 'Growing / Mid-Value'
    WHEN 2 THEN 'Price-Sensitive' WHEN 3 THEN 'Low-Value / New' END AS segment_label,
  CAST(greatest(tenure_months, customer_id % 97) AS INTEGER) AS larger,
  {num("1e0 / (1e0 + exp(-(CAST(tenure_months AS DOUBLE) / 12 - 5)))", "logistic")},
  {num("CASE WHEN ticket_count > 0 THEN CAST(monthly_charges AS DOUBLE) / ticket_count END", "charge_per_ticket")}
FROM planted""")

# --- features, splits, evaluation

twin("feature_table", f"""
SELECT * REPLACE ({num("monthly_charges", "monthly_charges")}, {num("avg_satisfaction", "avg_satisfaction")})
FROM features""")
twin("overall_churn_rate", f"""
SELECT count(*) AS n_rows, {num("round(avg(churned) * 100, 1)", "churn_rate_pct")} FROM features""")
twin("class_weights", f"""
SELECT churned, count(*) AS n_rows,
  {num("(SELECT count(*) FROM planted) / (2e0 * count(*))", "balanced_weight")},
  {num("CASE churned WHEN 1 THEN (SELECT count(*) FROM planted WHERE churned = 0) / CAST(count(*) AS DOUBLE) ELSE 1 END",
       "positive_weight")}
FROM planted GROUP BY churned""")
twin("stratified_split", """
, classes AS (
  SELECT churned, n, total - CAST(ceil(0.2e0 * total) AS BIGINT) AS n_train,
    n * (total - CAST(ceil(0.2e0 * total) AS BIGINT)) / CAST(total AS DOUBLE) AS share
  FROM (SELECT churned, count(*) AS n, (SELECT count(*) FROM planted) AS total FROM planted GROUP BY churned)
),
quotas AS (
  SELECT churned, n - CAST(floor(share) AS BIGINT)
    - CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, churned)
             <= n_train - (SELECT sum(CAST(floor(share) AS BIGINT)) FROM classes) THEN 1 ELSE 0 END AS quota
  FROM classes
)
SELECT p.customer_id, p.churned,
  CASE WHEN row_number() OVER (PARTITION BY p.churned ORDER BY md5('42:' || CAST(p.customer_id AS VARCHAR))) <= quota
       THEN 1 ELSE 0 END AS is_test
FROM planted p JOIN quotas q ON q.churned = p.churned""")
twin("stratified_split_hot_key", """
, classes AS (
  SELECT churned, n, total - CAST(ceil(0.2e0 * total) AS BIGINT) AS n_train,
    n * (total - CAST(ceil(0.2e0 * total) AS BIGINT)) / CAST(total AS DOUBLE) AS share
  FROM (SELECT churned, count(*) AS n, (SELECT count(*) FROM planted) AS total FROM planted GROUP BY churned)
),
quotas AS (
  SELECT churned, n - CAST(floor(share) AS BIGINT)
    - CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, churned)
             <= n_train - (SELECT sum(CAST(floor(share) AS BIGINT)) FROM classes) THEN 1 ELSE 0 END AS quota
  FROM classes
),
sides AS (
  SELECT c.churned, 1 AS is_test, CAST(q.quota AS BIGINT) AS n_rows FROM classes c JOIN quotas q ON q.churned = c.churned
  UNION ALL
  SELECT c.churned, 0, CAST(c.n - q.quota AS BIGINT) FROM classes c JOIN quotas q ON q.churned = c.churned
)
SELECT churned, is_test, n_rows FROM sides WHERE n_rows > 0""")
twin("random_split", """
SELECT customer_id,
  CASE WHEN row_number() OVER (ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)))
         <= (SELECT ceil(0.2e0 * count(*)) FROM features WHERE churned = 1) THEN 1 ELSE 0 END AS is_test
FROM features WHERE churned = 1""")
_SAMPLE = "SELECT * FROM {rows} ORDER BY md5('42:' || CAST(customer_id AS VARCHAR)) LIMIT 500"
twin("sample_rows", f"SELECT customer_id, churned FROM ({_SAMPLE.format(rows='features')})")


def _metrics(score: str) -> str:
    """One row of metrics; the AUC by mean ranks."""
    return f"""
  SELECT round((sum(CASE WHEN churned = 1 THEN mid_rank END) - p * (p + 1) / 2) / (p * n), 4) AS roc_auc,
    round(coalesce(tp / nullif(tp + fp, 0), 0), 4) AS precision,
    round(tp / p, 4) AS recall,
    round(2 * tp / (tp + fp + p), 4) AS f1
  FROM (SELECT churned, rank() OVER (ORDER BY {score}) + (count(*) OVER (PARTITION BY {score}) - 1) / 2e0 AS mid_rank
        FROM planted),
       (SELECT CAST(count(*) FILTER (churned = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (churned = 0) AS DOUBLE) AS n,
          CAST(count(*) FILTER (churned = 1 AND {score} >= 0.5e0) AS DOUBLE) AS tp,
          CAST(count(*) FILTER (churned = 0 AND {score} >= 0.5e0) AS DOUBLE) AS fp
        FROM planted)
  GROUP BY p, n, tp, fp"""


twin("binary_metrics", _metrics("churn_probability"))
twin("binary_metrics_unrounded", _metrics("probability"))
_NO_CONTRACT = """round_even(1e0 / (1e0 + exp(-(-3.15e0 - 0.02e0 * x1 + 0.032e0 * x2 + 0.55e0 * x5 + 0.45e0 * x6
  + 0.35e0 * x7 + 0.35e0 * x8 + 0.2e0 * x9))), 5)"""
_CHARGE_ONLY = "round_even(1e0 / (1e0 + exp(-(-3.15e0 + 0.032e0 * x2))), 5)"
_VARIANTS = "\nUNION ALL\n".join(
    f"SELECT '{name}' AS model, * FROM ({_metrics(score)})"
    for name, score in {
        "all_drivers": "churn_probability", "no_contract": _NO_CONTRACT, "charge_only": _CHARGE_ONLY,
    }.items()
)
twin("score_comparison", _VARIANTS)
twin("best_model_pick", f"SELECT * FROM ({_VARIANTS}) ORDER BY roc_auc DESC, model LIMIT 1")
twin("roc_points", f"""
, grouped AS (
  SELECT churn_probability AS score, sum(churned) AS pos, sum(1 - churned) AS neg FROM planted GROUP BY 1
),
curve AS (
  SELECT score, pos, neg, sum(pos) OVER up AS tp, sum(neg) OVER up AS fp, lead(pos) OVER w AS next_pos,
    lead(neg) OVER w AS next_neg, row_number() OVER w AS position
  FROM grouped
  WINDOW w AS (ORDER BY score DESC), up AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING)
)
SELECT {num("score", "threshold")},
  {num("fp / CAST((SELECT sum(neg) FROM grouped) AS DOUBLE)", "fpr")},
  {num("tp / CAST((SELECT sum(pos) FROM grouped) AS DOUBLE)", "tpr")}
FROM curve WHERE position = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg
UNION ALL
SELECT 'Infinity'::DOUBLE, 0e0, 0e0""")
twin("regression_metrics", f"""
SELECT {num("avg(abs(y - g))", "mae")}, {num("1 - sum((y - g) * (y - g)) / (var_pop(y) * count(*))", "r2")}
FROM (SELECT CAST(tenure_months AS DOUBLE) AS y, 40e0 + customer_id % 31 AS g FROM features WHERE churned = 1)""")
_LEVELS = "\nUNION ALL\n".join(
    f"SELECT {i} AS column_index, '{column}' AS column_name, {column} AS level FROM features GROUP BY {column}"
    for i, column in enumerate(CATEGORICAL)
)
_NUMERIC_NAMES = "\nUNION ALL\n".join(
    f"SELECT {len(CATEGORICAL) + i}, '{column}', NULL" for i, column in enumerate(NUMERIC)
)
twin("feature_names", f"""
SELECT CAST(row_number() OVER (ORDER BY column_index, level) - 1 AS INTEGER) AS feature_index,
  CASE WHEN level IS NULL THEN 'num__' || column_name ELSE 'cat__' || column_name || '_' || level END AS feature_name
FROM ({_LEVELS}
UNION ALL
{_NUMERIC_NAMES})""")
twin("encoded_features", "\nUNION ALL\n".join([
    *[
        f"SELECT customer_id, 'cat__{column}_' || level AS feature, CASE WHEN {column} = level THEN 1e0 ELSE 0e0 END AS value "
        f"FROM features, (SELECT DISTINCT {column} AS level FROM features)"
        for column in CATEGORICAL
    ],
    *[
        f"SELECT customer_id, 'num__{column}', "
        + num(f"({column}::DOUBLE - avg({column}::DOUBLE) OVER ()) / stddev_samp({column}::DOUBLE) OVER ()", "value")
        + " FROM features"
        for column in NUMERIC
    ],
]))
_WEIGHTS = {
    "tenure_months": "-0.02e0", "monthly_charges": "0.032e0", "month_to_month": "1.35e0", "two_year": "-1.1e0",
    "no_tech_support": "0.55e0", "electronic_check": "0.45e0", "senior_citizen": "0.35e0", "fiber_optic": "0.35e0",
    "no_partner": "0.2e0",
}
_CONTRIBUTIONS = "\nUNION ALL\n".join(
    f"SELECT customer_id, '{name}' AS feature, x{i} AS value, {weight} * (x{i} - avg(x{i}) OVER ()) AS contribution "
    "FROM terms"
    for i, (name, weight) in enumerate(_WEIGHTS.items(), start=1)
)
twin("scorecard_contributions", f"""
SELECT customer_id, feature, {num("value", "value")}, {num("contribution", "contribution")} FROM ({_CONTRIBUTIONS})""")
twin("scorecard_drivers", f"""
SELECT feature, {num("avg(abs(contribution))", "mean_abs_contribution")} FROM ({_CONTRIBUTIONS}) GROUP BY feature
ORDER BY 2 DESC LIMIT 15""")

# --- value, segments, scores

twin("predicted_clv", f"""
SELECT customer_id, {num("predicted_total_tenure_months", "predicted_total_tenure_months")},
  {num("predicted_clv", "predicted_clv")} FROM valued""")
twin("segment_relabel", "SELECT customer_id, segment_cluster, segment_label FROM scored")
twin("segment_profile", f"""
SELECT segment_label, count(*) AS customers,
  {", ".join(num(f"round_even(avg(CAST({c} AS DOUBLE)), 2)", f"avg_{c}")
             for c in ("tenure_months", "monthly_charges", "predicted_clv", "churned"))}
FROM scored GROUP BY segment_label""")
twin("risk_tier", f"SELECT customer_id, {num('churn_probability', 'churn_probability')}, risk_tier FROM valued")
twin("prediction_table", f"""
SELECT customer_id, {num("churn_probability", "churn_probability")}, risk_tier, {num("predicted_clv", "predicted_clv")},
  segment_cluster, 'v1.0' AS model_version, '2001-08-01 12:00:00' AS scored_at FROM scored""")
twin("risk_total_all", f"""
SELECT {num("coalesce(sum(monthly_charges) FILTER (risk_tier = 'High'), 0)", "monthly_revenue_at_risk")} FROM valued""")
_SNAPSHOT_NUMBERS = (
    f"{num('monthly_charges', 'monthly_charges')}, tenure_months, {{tickets}}"
    f"{num('churn_probability', 'churn_probability')}, risk_tier, {num('predicted_clv', 'predicted_clv')}"
)
twin("snapshot_csv", f"""
SELECT customer_id, contract_type, internet_service, payment_method,
  {_SNAPSHOT_NUMBERS.format(tickets="ticket_count, ")}, segment_cluster, segment_label FROM scored""")
twin("snapshot_export", f"""
SELECT customer_id, contract_type, internet_service, payment_method,
  {_SNAPSHOT_NUMBERS.format(tickets="ticket_count, ")}, segment_cluster, segment_label FROM scored""")
twin("tier_counts", """
SELECT t.risk_tier, c.customers
FROM (VALUES ('Low'), ('Medium'), ('High')) t(risk_tier)
LEFT JOIN (SELECT risk_tier, count(*) AS customers FROM valued GROUP BY risk_tier) c ON c.risk_tier = t.risk_tier""")

# --- billing

twin("billing_schedule", f"""
SELECT subscription_id, customer_id, CAST(period AS INTEGER) AS period,
  strftime(start_date + 30 * CAST(period AS INTEGER), '%Y-%m-%d') AS billing_date,
  {num("monthly_charges", "monthly_charges")}
FROM (SELECT *, unnest(range(tenure_months)) AS period FROM subscriptions)""")
twin("logistic_scorecard", f"SELECT customer_id, {num('probability', 'churn_probability')} FROM card")
twin("churn_events_extract", f"""
SELECT churn_id, customer_id, {text("churn_date", "churn_date")}, churn_flag, churn_reason FROM churn_events""")
twin("capped_tenure", """
SELECT subscription_id, CAST(tenure AS INTEGER) AS tenure_months,
  strftime(least(start_date + 30 * CAST(tenure AS INTEGER), DATE '2001-07-31'), '%Y-%m-%d') AS scheduled_end
FROM (SELECT *, least(tenure_months + 5, greatest((DATE '2001-08-01' - start_date) // 30, 1)) AS tenure
      FROM subscriptions)""")

# --- statistical tests: tails by Simpson's rule, no special functions needed

_CELLS = "\nUNION ALL\n".join(
    f"SELECT '{v}' AS variable, {v} AS level, churned, count(*) AS observed FROM planted GROUP BY {v}, churned"
    for v in ("contract_type", "internet_service", "payment_method", "tech_support")
)
_CHI_SQUARE = f"""
, counted AS ({_CELLS}),
crossed AS (
  SELECT l.variable, l.level, y.churned, coalesce(c.observed, 0) AS observed,
    l.n * CAST(y.n AS DOUBLE) / (SELECT count(*) FROM planted) AS expected
  FROM (SELECT variable, level, sum(observed) AS n FROM counted GROUP BY 1, 2) l
  CROSS JOIN (SELECT churned, count(*) AS n FROM planted GROUP BY 1) y
  LEFT JOIN counted c ON c.variable = l.variable AND c.level = l.level AND c.churned = y.churned
),
crossed_tests AS (
  SELECT variable, sum((observed - expected) * (observed - expected) / expected) AS statistic,
    CAST(count(DISTINCT level) - 1 AS INTEGER) AS df
  FROM crossed GROUP BY variable
),
crossed_tails AS (
  SELECT variable, sum(CASE WHEN i IN (0, 40000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    * exp((df / 2e0 - 1) * ln(statistic + i * 0.005e0) - i * 0.0025e0)) * 0.005e0 / 3 AS integral
  FROM crossed_tests, (SELECT unnest(range(40001)) AS i) GROUP BY variable
)"""
_CHI_SQUARE_LOG10_P = "(ln(integral) - statistic / 2 - df / 2e0 * ln(2e0) - lgamma(df / 2e0)) / ln(10e0)"
twin("chi_square", f"""{_CHI_SQUARE}
SELECT variable, {num("statistic", "statistic", 4)}, df, {num(_CHI_SQUARE_LOG10_P, "log10_p", 4)}
FROM crossed_tests JOIN crossed_tails USING (variable)""")
_MOMENTS = "\nUNION ALL\n".join(
    f"SELECT '{v}' AS variable, churned, count({v}) AS n, avg(CAST({v} AS DOUBLE)) AS m, "
    f"var_samp(CAST({v} AS DOUBLE)) AS v FROM planted GROUP BY churned"
    for v in ("monthly_charges", "tenure_months", "ticket_count")
)
_WELCH = f"""
, moments AS ({_MOMENTS}),
moment_tests AS (
  SELECT a.variable, a.m AS m0, b.m AS m1, (a.m - b.m) / sqrt(a.v / a.n + b.v / b.n) AS t,
    (a.v / a.n + b.v / b.n) ** 2 / ((a.v / a.n) ** 2 / (a.n - 1) + (b.v / b.n) ** 2 / (b.n - 1)) AS df
  FROM moments a JOIN moments b ON a.variable = b.variable AND a.churned = 0 AND b.churned = 1
),
moment_tails AS (
  SELECT variable, sum(CASE WHEN i IN (0, 60000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    * exp(-(df + 1) / 2 * (ln(1 + (abs(t) + i * 0.0005e0) ** 2 / df) - ln(1 + t ** 2 / df)))) * 0.0005e0 / 3 AS integral
  FROM moment_tests, (SELECT unnest(range(60001)) AS i) GROUP BY variable
)"""
_WELCH_LOG10_P = (
    "(ln(2 * integral) - (df + 1) / 2 * ln(1 + t ** 2 / df) + lgamma((df + 1) / 2) - lgamma(df / 2) "
    "- ln(pi() * df) / 2) / ln(10e0)"
)
twin("welch_t", f"""{_WELCH}
SELECT variable, {num("m0", "mean_retained", 4)}, {num("m1", "mean_churned", 4)}, {num("t", "t", 4)},
  {num("df", "df", 4)}, {num(_WELCH_LOG10_P, "log10_p", 4)}
FROM moment_tests JOIN moment_tails USING (variable)""")
_ONE_FACTOR = """
, odds AS (
  SELECT contract_type AS level, CAST(count(*) FILTER (churned = 1) AS DOUBLE) AS ones,
    CAST(count(*) FILTER (churned = 0) AS DOUBLE) AS zeros, row_number() OVER (ORDER BY contract_type) AS position
  FROM planted GROUP BY contract_type
),
coefficients AS (
  SELECT CAST(o.position - 1 AS INTEGER) AS position,
    CASE o.position WHEN 1 THEN '(Intercept)' ELSE 'contract_type' || o.level END AS term,
    ln(o.ones / o.zeros) - CASE o.position WHEN 1 THEN 0e0 ELSE ln(b.ones / b.zeros) END AS estimate,
    sqrt(1 / o.ones + 1 / o.zeros + CASE o.position WHEN 1 THEN 0e0 ELSE 1 / b.ones + 1 / b.zeros END) AS std_error
  FROM odds o JOIN odds b ON b.position = 1
)"""
twin("glm_one_factor", f"""{_ONE_FACTOR},
tails AS (
  SELECT position, sum(CASE WHEN i IN (0, 40000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    * exp(-abs(estimate / std_error) * i * 0.0005e0 - (i * 0.0005e0) ** 2 / 2)) * 0.0005e0 / 3 AS integral
  FROM coefficients, (SELECT unnest(range(40001)) AS i) GROUP BY position
)
SELECT position, term, {num("estimate", "estimate", 4)}, {num("std_error", "std_error", 4)},
  {num("estimate / std_error", "z", 4)},
  {num("(ln(2 * integral) - (estimate / std_error) ** 2 / 2 - ln(2 * pi()) / 2) / ln(10e0)", "log10_p", 4)}
FROM coefficients JOIN tails USING (position)""")
twin("odds_ratios_one_factor", f"""{_ONE_FACTOR}
SELECT position, term, {num("exp(estimate)", "odds_ratio", 3)},
  {num("exp(estimate - 1.959963984540054e0 * std_error)", "lower", 3)},
  {num("exp(estimate + 1.959963984540054e0 * std_error)", "upper", 3)}
FROM coefficients""")
twin("glm_fit_one_factor", f"""{_ONE_FACTOR},
deviances AS (
  SELECT -2 * (sum(ones) * ln(sum(ones) / sum(ones + zeros)) + sum(zeros) * ln(sum(zeros) / sum(ones + zeros))) AS without,
    -2 * sum(ones * ln(ones / (ones + zeros)) + zeros * ln(zeros / (ones + zeros))) AS with_terms,
    CAST(sum(ones + zeros) AS BIGINT) AS n, count(*) AS p
  FROM odds
)
SELECT {num("without", "null_deviance", 4)}, n - 1 AS null_df, {num("with_terms", "residual_deviance", 4)},
  n - p AS residual_df, {num("with_terms + 2 * p", "aic", 4)}, {num("1 - with_terms / without", "mcfadden_r2", 4)}
FROM deviances""")
def _newton(steps: int) -> str:
    """Newton's method for a logit model of one factor and one number, from the counts of their combinations.

    With an intercept a per level and one slope b the matrix of second derivatives has a border of one row.
    """
    parts = ["""
, cells AS (
  SELECT contract_type AS level, CAST(tenure_months AS DOUBLE) AS x, CAST(count(*) AS DOUBLE) AS n,
    CAST(sum(churned) AS DOUBLE) AS ones
  FROM planted GROUP BY ALL
),
at0 AS (SELECT DISTINCT level, 0e0 AS a, 0e0 AS b FROM cells)"""]
    for k in range(steps):
        parts.append(f"""
sums{k} AS (
  SELECT level, any_value(a) AS a, any_value(b) AS b, sum(n * p * (1 - p)) AS w, sum(n * p * (1 - p) * x) AS t,
    sum(n * p * (1 - p) * x * x) AS q, sum(ones - n * p) AS g, sum((ones - n * p) * x) AS h
  FROM (SELECT c.*, s.a, s.b, 1 / (1 + exp(-(s.a + s.b * c.x))) AS p FROM cells c JOIN at{k} s USING (level))
  GROUP BY level
),
step{k} AS (SELECT (sum(h) - sum(t * g / w)) / (sum(q) - sum(t * t / w)) AS slope FROM sums{k}),
at{k + 1} AS (SELECT level, a + (g - t * slope) / w AS a, b + slope AS b FROM sums{k}, step{k})""")
    last = steps - 1
    parts.append(f"""
ordered AS (
  SELECT *, row_number() OVER (ORDER BY level) - 1 AS place, sum(q) OVER () - sum(t * t / w) OVER () AS d FROM sums{last}
),
coefficients AS (
  SELECT CAST(o.place AS INTEGER) AS position,
    CASE o.place WHEN 0 THEN '(Intercept)' ELSE 'contract_type' || o.level END AS term,
    o.a - CASE o.place WHEN 0 THEN 0e0 ELSE f.a END AS estimate,
    sqrt(CASE o.place WHEN 0 THEN 1 / o.w + (o.t / o.w) ** 2 / o.d
         ELSE 1 / o.w + 1 / f.w + (o.t / o.w - f.t / f.w) ** 2 / o.d END) AS std_error
  FROM ordered o JOIN ordered f ON f.place = 0
  UNION ALL
  SELECT CAST(max(place) + 1 AS INTEGER), 'tenure_months', any_value(b), sqrt(1 / any_value(d)) FROM ordered
)""")
    return ",".join(parts)


_TAILS = """tails AS (
  SELECT position, sum(CASE WHEN i IN (0, 40000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END
    * exp(-abs(estimate / std_error) * i * 0.0005e0 - (i * 0.0005e0) ** 2 / 2)) * 0.0005e0 / 3 AS integral
  FROM coefficients, (SELECT unnest(range(40001)) AS i) GROUP BY position
)"""
_LOG10_P = "(ln(2 * integral) - (estimate / std_error) ** 2 / 2 - ln(2 * pi()) / 2) / ln(10e0)"
_MIXED = _newton(9)
twin("glm_summary", f"""{_MIXED},
{_TAILS}
SELECT position, term, {num("estimate", "estimate", 4)}, {num("std_error", "std_error", 4)},
  {num("estimate / std_error", "z", 4)}, {num(_LOG10_P, "log10_p", 4)}
FROM coefficients JOIN tails USING (position)""")
twin("odds_ratios", f"""{_MIXED}
SELECT position, term, {num("exp(estimate)", "odds_ratio", 3)},
  {num("exp(estimate - 1.959963984540054e0 * std_error)", "lower", 3)},
  {num("exp(estimate + 1.959963984540054e0 * std_error)", "upper", 3)}
FROM coefficients""")
_DEVIANCES = """deviances AS (
  SELECT -2 * (sum(ones) * ln(sum(ones) / sum(n)) + sum(n - ones) * ln(1 - sum(ones) / sum(n))) AS without,
    -2 * sum(ones * ln(p) + (n - ones) * ln(1 - p)) AS with_terms, CAST(sum(n) AS BIGINT) AS n,
    count(DISTINCT level) + 1 AS terms
  FROM (SELECT c.*, 1 / (1 + exp(-(s.a + s.b * c.x))) AS p FROM cells c JOIN at9 s USING (level))
)"""
twin("mcfadden_r2", f"""{_MIXED},
{_DEVIANCES}
SELECT {num("without", "null_deviance", 4)}, n - 1 AS null_df, {num("with_terms", "residual_deviance", 4)},
  n - terms AS residual_df, {num("with_terms + 2 * terms", "aic", 4)}, {num("1 - with_terms / without", "mcfadden_r2", 4)}
FROM deviances""")


def _p_value(log10_p: str, digits: int) -> str:
    """A p-value as text; below the smallest double only the exponent is known."""
    return f"CASE WHEN 10e0 ** ({log10_p}) = 0 THEN printf('1e%.0f', {log10_p}) ELSE printf('%.{digits}g', 10e0 ** ({log10_p})) END"


twin("statistics_report", f"""{_MIXED},
{_DEVIANCES},
{_TAILS}
{_CHI_SQUARE}
{_WELCH}
SELECT unnest(['Logistic regression of churn on its drivers', 'Odds ratios with 95% intervals',
  'Chi-square tests of churn and category', 'Welch t-tests, retained minus churned']) AS value
UNION ALL
SELECT printf('  %s: %.6f (SE %.6f, z %.3f, p %s)', term, estimate, std_error, estimate / std_error, {_p_value(_LOG10_P, 3)})
FROM coefficients JOIN tails USING (position)
UNION ALL
SELECT printf('  deviance %.1f (%d df) without terms, %.1f (%d df) with terms, AIC %.1f, McFadden R2 %.4f',
  without, n - 1, with_terms, n - terms, with_terms + 2 * terms, round(1 - with_terms / without, 4))
FROM deviances
UNION ALL
SELECT printf('  %s: %.3f [%.3f, %.3f]', term, round(exp(estimate), 3),
  round(exp(estimate - 1.959963984540054e0 * std_error), 3), round(exp(estimate + 1.959963984540054e0 * std_error), 3))
FROM coefficients
UNION ALL
SELECT printf('  %s: X2 %.2f, df %d, p %s', variable, statistic, df, {_p_value(_CHI_SQUARE_LOG10_P, 6)})
FROM crossed_tests JOIN crossed_tails USING (variable)
UNION ALL
SELECT printf('  %s: means %.2f and %.2f, t %.2f, df %.1f, p %s', variable, m0, m1, t, df, {_p_value(_WELCH_LOG10_P, 6)})
FROM moment_tests JOIN moment_tails USING (variable)""")

# --- fitted models on planted rules: the right fit follows from the rule

_RULE = "CASE WHEN contract_type = 'Month-to-month' THEN 1 ELSE 0 END"
_RULED = f"SELECT * REPLACE ({_RULE} AS churned) FROM features"
twin("train_compare_rule", f"""
, ruled AS ({_RULED}),
found AS (
  SELECT CAST(count(*) FILTER (churned = 1 AND predicted = 1) AS DOUBLE) AS tp,
    CAST(count(*) FILTER (churned = 0 AND predicted = 1) AS DOUBLE) AS fp,
    CAST(count(*) FILTER (churned = 1) AS DOUBLE) AS p, CAST(count(*) FILTER (churned = 0) AS DOUBLE) AS n,
    sum(CASE WHEN churned = 1 THEN rank END) AS ranks
  FROM (SELECT *, rank() OVER (ORDER BY predicted) + (count(*) OVER (PARTITION BY predicted) - 1) / 2e0 AS rank
        FROM (SELECT churned, {_RULE} AS predicted FROM ruled))
)
SELECT model, {num("(ranks - p * (p + 1) / 2) / (p * n)", "roc_auc", 4)}, {num("tp / (tp + fp)", "precision", 4)},
  {num("tp / p", "recall", 4)}, {num("2 * tp / (tp + fp + p)", "f1", 4)}
FROM found, (VALUES ('logistic_regression'), ('random_forest'), ('boosted_trees')) m(model)""")
twin("score_customers_rule", f"""
SELECT customer_id, CASE churned WHEN 1 THEN 'High' ELSE 'Low' END AS risk_tier, churned AS predicted FROM ({_RULED})""")
_SLOTS = f"""CAST((SELECT {' + '.join(f'count(DISTINCT {c})' for c in CATEGORICAL)} + {len(NUMERIC)} FROM features) AS BIGINT)"""
for _name, _model, _scale in (
    ("score_profiles_rule", "logistic_regression", "logit"),
    ("tree_contributions_boosted", "boosted_trees", "logit"),
    ("tree_contributions_forest", "random_forest", "probability"),
):
    twin(_name, f"""
SELECT '{_model}' AS model, customer_id AS profile_id, churned AS predicted, '{_scale}' AS score_scale, 1 AS adds_up,
  {_SLOTS} AS n_parts, 'cat__contract_type_Month-to-month' AS top_driver
FROM ({_RULED})""")
twin("lifetime_rule", f"""
SELECT customer_id, {num("total", "predicted_total_tenure_months")},
  {num("round_even(total * CAST(monthly_charges AS DOUBLE), 2)", "predicted_clv")}, 0e0 AS mae, 1e0 AS r2
FROM (SELECT *, CASE contract_type WHEN 'Two year' THEN 48e0 WHEN 'One year' THEN 24e0 ELSE 9e0 END AS total FROM features)""")
twin("kmeans_bands", f"""
SELECT CASE band WHEN 3 THEN 'High-Value Loyal' WHEN 2 THEN 'Growing / Mid-Value' WHEN 1 THEN 'Price-Sensitive'
    ELSE 'Low-Value / New' END AS segment_label, count(*) AS customers,
  {num("round_even(avg(10 + 20 * band + customer_id % 3), 2)", "avg_tenure_months")},
  {num("round_even(avg((2000 + 2500 * band + customer_id % 5) / 100e0), 2)", "avg_monthly_charges")},
  {num("round_even(avg(1000 * (band + 1) * (band + 1) + customer_id % 11), 2)", "avg_predicted_clv")},
  {num("round_even(avg(CAST(churned AS DOUBLE)), 2)", "avg_churned")}
FROM (SELECT *, customer_id % 4 AS band FROM features) GROUP BY band""")
twin("model_versions", f"""
SELECT v.model_version, 'logistic_regression' AS best_model, v.is_current,
  '{','.join([*CATEGORICAL, *NUMERIC])}' AS columns,
  CASE WHEN (v.model_version = 'v1.0' AND contract_type = 'Month-to-month')
         OR (v.model_version = 'v2.0' AND internet_service = 'Fiber optic') THEN 'High' ELSE 'Low' END AS risk_tier,
  count(*) AS customers
FROM features, (VALUES ('v1.0', 0), ('v2.0', 1)) v(model_version, is_current) GROUP BY ALL""")

twin("churn_rate_pct", f"""
SELECT contract_type, {num("round(avg(churned) * 100, 1)", "churn_rate_pct")} FROM planted GROUP BY contract_type""")

# --- dashboard

_HIGH_CHARGES = "coalesce(sum(monthly_charges) FILTER (risk_tier = 'High'), 0)"
twin("kpi_row", f"""
SELECT count(*) AS customers, {num("sum(monthly_charges)", "mrr")},
  {num("count(*) FILTER (risk_tier <> 'Low') / CAST(count(*) AS DOUBLE)", "share_not_low")},
  {num("avg(churn_probability)", "avg_churn_probability")}, {num(_HIGH_CHARGES, "revenue_at_risk")},
  {num("avg(predicted_clv)", "avg_predicted_clv")}
FROM scored""")
twin("probability_by_contract", f"""
SELECT contract_type, {num("avg(churn_probability)", "avg_churn_probability")} FROM scored GROUP BY contract_type""")
_EXPLORER = f"""
SELECT customer_id, contract_type, internet_service, payment_method, {_SNAPSHOT_NUMBERS.format(tickets="")}
FROM scored"""
twin("risk_explorer", f"{_EXPLORER} WHERE risk_tier = 'High' AND predicted_clv >= 0")
twin("risk_explorer_filtered", f"""{_EXPLORER}
WHERE risk_tier IN ('Medium', 'High') AND contract_type IN ('One year', 'Month-to-month') AND predicted_clv >= 2500""")
twin("explorer_footer", f"""
SELECT count(*) AS customers, {num("coalesce(sum(monthly_charges), 0)", "monthly_revenue")}
FROM scored WHERE risk_tier = 'High' AND predicted_clv >= 0""")
twin("segment_summary", f"""
SELECT segment_label, count(customer_id) AS customers, {num("round_even(avg(predicted_clv), 2)", "avg_clv")},
  {num("round_even(avg(tenure_months), 2)", "avg_tenure")},
  {num("round_even(avg(churn_probability), 2)", "avg_churn_prob")}
FROM scored GROUP BY segment_label""")
twin("filter_domains", f"""
SELECT DISTINCT 'contract_type' AS filter, contract_type AS value FROM scored
UNION ALL
SELECT 'max_predicted_clv', {text("CAST(floor(max(predicted_clv)) AS BIGINT)", "value")} FROM scored""")

assert set(_WEIGHTS) == set(rules.SCORECARD)
