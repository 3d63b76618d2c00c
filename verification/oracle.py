"""Expected results in ANSI SQL over the supplied tables, independent of the Spark code.

``CTES`` holds each layer as a named subquery; ``with_ctes`` prepends those a query
refers to, directly or through others.
"""

from __future__ import annotations

import re

from telcolake.sources.schemas import FEATURES_DDL, SOURCES, ddl_columns

CTES: dict[str, str] = {}

# --- raw layer -------------------------------------------------------------------

CTES["bronze_customers"] = """
SELECT
  'CUST-' || lpad(CAST(k AS VARCHAR), 12, '0') AS customer_id,
  customer_type,
  CASE WHEN k % 97 <> 0 THEN region END AS region,
  plan_type,
  CASE WHEN term = 0 THEN 'month-to-month' WHEN term = 1 THEN '1-year' ELSE '2-year' END AS contract_type,
  CASE WHEN plan_type IS NOT NULL THEN CAST(30 + k * 19 % 270 AS VARCHAR) || '.50' END AS monthly_charge_aud,
  CASE WHEN k % 83 = 0 THEN '' ELSE CAST(1 + (k * 7) % 60 AS VARCHAR) END AS tenure_months,
  CASE WHEN k % 5 = 0 THEN 'True' ELSE 'False' END AS has_cybersecurity_addon,
  CASE WHEN k % 4 = 0 THEN 'True' ELSE 'False' END AS has_voip_addon,
  CAST(onboarded AS VARCHAR) AS onboarded_date,
  CASE WHEN k % 89 = 0 THEN '' WHEN churned THEN 'True' ELSE 'False' END AS churn_flag,
  CASE WHEN churned THEN CAST(onboarded + CAST(30 + (k * 17) % 700 AS INTEGER) AS VARCHAR) ELSE '' END AS churn_date
FROM (
  SELECT *,
    DATE '2020-01-01' + CAST((k * 13) % 1461 AS INTEGER) AS onboarded,
    (k * 11) % 20 < CASE WHEN term = 0 THEN 5 WHEN term = 1 THEN 3 ELSE 1 END AS churned,
    CASE customer_type
      WHEN 'residential' THEN list_extract(['NBN50', 'NBN100', 'NBN250', 'NBN1000'], CAST(k % 4 + 1 AS INTEGER))
      WHEN 'business' THEN list_extract(['NBN100', 'NBN250', 'NBN1000', 'Fibre', 'Business_VoIP'], CAST(k % 5 + 1 AS INTEGER))
      ELSE list_extract(['Wholesale_Dark_Fibre', 'Fibre', 'NBN1000'], CAST(k % 3 + 1 AS INTEGER)) END AS plan_type
  FROM (
    SELECT c_custkey AS k, r_name AS region, (c_custkey // 7) % 3 AS term,
      CASE c_mktsegment WHEN 'MACHINERY' THEN 'business' WHEN 'BUILDING' THEN 'wholesale'
        ELSE 'residential' END AS customer_type
    FROM customer
    LEFT JOIN nation ON c_nationkey = n_nationkey
    LEFT JOIN region ON n_regionkey = r_regionkey
  )
)
"""

CTES["bronze_network_telemetry"] = """
SELECT
  CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS telemetry_id,
  CASE WHEN l_orderkey % 211 = 0 THEN 'LOST-' || lpad(CAST(l_orderkey AS VARCHAR), 12, '0')
    ELSE o.customer_id END AS customer_id,
  CAST(CAST(CASE WHEN l_orderkey % 199 = 0 THEN CAST(l_shipdate AS DATE) + INTERVAL 27 YEAR
    ELSE CAST(l_shipdate AS DATE) + INTERVAL 25 YEAR END AS DATE) AS VARCHAR) AS date,
  region,
  plan_type,
  CAST(CAST(l_quantity * 2 AS DECIMAL(18, 2)) AS VARCHAR) AS daily_bandwidth_gb,
  CAST(CAST(l_quantity * 3 AS DECIMAL(18, 1)) AS VARCHAR) AS peak_hour_latency_ms,
  CAST(CAST(l_quantity * 1.5 AS DECIMAL(18, 1)) AS VARCHAR) AS off_peak_latency_ms,
  CAST(CAST(round(l_discount * 50, 2) AS DECIMAL(18, 2)) AS VARCHAR) AS packet_loss_percent,
  CAST((l_linenumber - 1) % 6 AS VARCHAR) AS connection_drops,
  CASE WHEN round(l_discount * 50, 2) > 3.0 THEN 'True'
    WHEN plan_type IN ('Business_VoIP', 'Fibre', 'Wholesale_Dark_Fibre') AND l_quantity * 3 > 80 THEN 'True'
    WHEN l_quantity * 3 > 100 THEN 'True'
    ELSE 'False' END AS sla_breach,
  CASE WHEN l_returnflag = 'R' AND l_linestatus = 'F' THEN 'True' ELSE 'False' END AS outage_flag,
  'NODE-' || lpad(CAST(l_suppkey % 20 + 1 AS VARCHAR), 2, '0') AS node_id
FROM lineitem
LEFT JOIN (
  SELECT o_orderkey, 'CUST-' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS customer_id FROM orders
) o ON l_orderkey = o.o_orderkey
LEFT JOIN bronze_customers c ON o.customer_id = c.customer_id
"""

CTES["bronze_support_tickets"] = """
SELECT
  'TKT-' || lpad(CAST(event_id AS VARCHAR), 12, '0') AS ticket_id,
  e.customer_id,
  CAST(opened AS VARCHAR) AS open_date,
  CASE WHEN is_resolved THEN CAST(opened + CAST(1 + event_id % 14 AS INTEGER) AS VARCHAR) ELSE '' END AS close_date,
  CASE event_type WHEN 'click' THEN 'slow_speed' WHEN 'view' THEN 'billing_query'
    WHEN 'signup' THEN 'provisioning_delay' WHEN 'purchase' THEN 'hardware_fault'
    ELSE CASE WHEN event_id % 3 = 0 THEN 'outage_report' ELSE 'connectivity_drop' END END AS issue_category,
  region,
  CASE event_id % 4 WHEN 0 THEN 'phone' WHEN 1 THEN 'email' WHEN 2 THEN 'chat' ELSE 'web_portal' END AS channel,
  CASE WHEN is_resolved THEN 'True' ELSE 'False' END AS resolved,
  CASE WHEN is_resolved THEN CAST(1 + event_id % 5 AS VARCHAR) || '.0' ELSE '' END AS satisfaction_score
FROM (
  SELECT *, event_id % 50 < 41 AS is_resolved,
    CASE WHEN event_id % 71 = 0 THEN DATE '2019-12-31' ELSE CAST(ts AS DATE) END AS opened,
    CASE WHEN event_id % 97 = 0 THEN NULL
      WHEN event_id % 89 = 0 THEN 'LOST-' || lpad(CAST(event_id AS VARCHAR), 12, '0')
      ELSE 'CUST-' || lpad(CAST(user_id AS VARCHAR), 12, '0') END AS customer_id
  FROM events
) e
LEFT JOIN bronze_customers c ON e.customer_id = c.customer_id
"""

CTES["bronze_billing_events"] = """
SELECT
  CAST(o_orderkey AS VARCHAR) AS billing_id,
  'CUST-' || lpad(CAST(o_custkey AS VARCHAR), 12, '0') AS customer_id,
  CAST(month AS VARCHAR) AS billing_month,
  CAST(CAST(o_totalprice AS DECIMAL(18, 2)) AS VARCHAR) AS amount_charged_aud,
  payment_status,
  CASE payment_status
    WHEN 'paid' THEN CAST(month + CAST(1 + o_orderkey % 7 AS INTEGER) AS VARCHAR)
    WHEN 'late' THEN CAST(month + CAST(8 + o_orderkey % 23 AS INTEGER) AS VARCHAR)
    ELSE '' END AS payment_date,
  CASE WHEN substr(o_orderpriority, 1, 1) IN ('1', '2') THEN 'direct_debit'
    WHEN substr(o_orderpriority, 1, 1) = '3' THEN 'credit_card' ELSE 'bank_transfer' END AS payment_method
FROM (
  SELECT *,
    CAST(date_trunc('month', CAST(o_orderdate AS DATE) + INTERVAL 25 YEAR) AS DATE) AS month,
    CASE WHEN o_orderkey % 101 = 0 THEN NULL WHEN o_orderstatus = 'O' THEN 'paid'
      WHEN o_orderstatus = 'P' THEN 'late' WHEN o_orderstatus = 'F' THEN 'failed' END AS payment_status
  FROM orders
)
"""

# --- Silver ----------------------------------------------------------------------


def dedupe_sql(table: str) -> str:
    """One row per key: the first in the order of all columns, NULL first."""
    source = SOURCES[table]
    order = ", ".join(f"{c} NULLS FIRST" for c in source.columns if c != source.key)
    columns = ", ".join(source.columns)
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {source.key} ORDER BY {order}) AS rn "
        f"FROM bronze_{table}) WHERE rn = 1"
    )


def _typed(table: str, column: str) -> str:
    source = SOURCES[table]
    if column in source.dates:
        return f"TRY_CAST({column} AS DATE) AS {column}"
    if column in source.booleans:
        return f"TRY_CAST({column} AS BOOLEAN) AS {column}"
    if column in source.doubles:
        return f"TRY_CAST({column} AS DOUBLE) AS {column}"
    if column in source.integers:
        return f"TRY_CAST(trunc(TRY_CAST({column} AS DOUBLE)) AS INTEGER) AS {column}"
    return column


for _table in SOURCES:
    _columns = ", ".join(_typed(_table, c) for c in SOURCES[_table].columns)
    CTES[f"silver_{_table}"] = (
        f"SELECT {_columns} FROM ({dedupe_sql(_table)}) WHERE customer_id IS NOT NULL"
    )

CTES["date_bounds"] = """
SELECT least(min(onboarded_date), min(churn_date)) AS low, greatest(max(onboarded_date), max(churn_date)) AS high
FROM silver_customers
UNION ALL SELECT min(date), max(date) FROM silver_network_telemetry
UNION ALL SELECT least(min(open_date), min(close_date)), greatest(max(open_date), max(close_date))
FROM silver_support_tickets
UNION ALL SELECT least(min(billing_month), min(payment_date)), greatest(max(billing_month), max(payment_date))
FROM silver_billing_events
"""

# --- Gold ------------------------------------------------------------------------


def calendar_sql(low: str, high: str, source: str = "") -> str:
    return f"""
SELECT date, CAST(year(date) * 10000 + month(date) * 100 + day(date) AS INTEGER) AS date_key,
  CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month, CAST(day(date) AS INTEGER) AS day,
  CAST(dayofweek(date) + 1 AS INTEGER) AS day_of_week, dayofweek(date) IN (0, 6) AS is_weekend
FROM (SELECT CAST(unnest(generate_series({low}, {high}, INTERVAL 1 DAY)) AS DATE) AS date {source})
"""


CTES["dimdate"] = calendar_sql("DATE '2020-01-01'", "DATE '2026-12-31'")
# The calendar that just covers the data.
CTES["data_calendar"] = calendar_sql(
    "low", "high", "FROM (SELECT min(low) AS low, max(high) AS high FROM date_bounds)"
)


def member_sql(table: str, column: str) -> str:
    return (
        f"SELECT CAST(row_number() OVER (ORDER BY {column} NULLS FIRST) AS INTEGER) AS {column}_key, {column} "
        f"FROM (SELECT DISTINCT {column} FROM silver_{table})"
    )


CTES["dimregion"] = member_sql("customers", "region")
CTES["dimissuecategory"] = member_sql("support_tickets", "issue_category")
CTES["dimpaymentstatus"] = member_sql("billing_events", "payment_status")

CTES["dimcustomer"] = """
SELECT CAST(row_number() OVER (ORDER BY customer_id) AS INTEGER) AS customer_key, customer_id, customer_type,
  customer_id AS customer_id_str, region_key, plan_type, contract_type, monthly_charge_aud, tenure_months,
  has_cybersecurity_addon, has_voip_addon, onboarded_date, churn_flag, churn_date
FROM silver_customers LEFT JOIN dimregion USING (region)
"""

CTES["facttelemetry"] = """
SELECT t.telemetry_id, t.plan_type, t.daily_bandwidth_gb, t.peak_hour_latency_ms, t.off_peak_latency_ms,
  t.packet_loss_percent, t.connection_drops, t.sla_breach, t.outage_flag, t.node_id, c.customer_key, d.date_key
FROM silver_network_telemetry t
LEFT JOIN dimcustomer c ON t.customer_id = c.customer_id
LEFT JOIN dimdate d ON t.date = d.date
"""

CTES["factbilling"] = """
SELECT b.billing_id, b.billing_month, b.amount_charged_aud, b.payment_method, c.customer_key,
  s.payment_status_key, d1.date_key AS billing_month_key, d2.date_key AS payment_date_key
FROM silver_billing_events b
LEFT JOIN dimcustomer c ON b.customer_id = c.customer_id
LEFT JOIN dimpaymentstatus s ON b.payment_status = s.payment_status
LEFT JOIN dimdate d1 ON b.billing_month = d1.date
LEFT JOIN dimdate d2 ON b.payment_date = d2.date
"""

CTES["facttickets"] = """
SELECT t.ticket_id, t.channel, t.resolved, t.satisfaction_score, c.customer_key, i.issue_category_key,
  d1.date_key AS open_date_key, d2.date_key AS close_date_key
FROM silver_support_tickets t
LEFT JOIN dimcustomer c ON t.customer_id = c.customer_id
LEFT JOIN dimissuecategory i ON t.issue_category = i.issue_category
LEFT JOIN dimdate d1 ON t.open_date = d1.date
LEFT JOIN dimdate d2 ON t.close_date = d2.date
WHERE c.customer_key IS NOT NULL AND d1.date_key IS NOT NULL
"""

# Facts with the labels that group and filter them.
CTES["customer_labels"] = """
SELECT c.*, r.region,
  CASE WHEN coalesce(tenure_months, 0) <= 6 THEN '0–6 months' WHEN tenure_months <= 12 THEN '7–12 months'
    WHEN tenure_months <= 24 THEN '13–24 months' ELSE '24+ months' END AS tenure_bucket
FROM dimcustomer c LEFT JOIN dimregion r ON c.region_key = r.region_key
"""
CTES["telemetry_labels"] = """
SELECT f.* EXCLUDE (plan_type), c.plan_type, c.region, c.customer_type, c.tenure_bucket, d.date, d.year, d.month
FROM facttelemetry f
LEFT JOIN customer_labels c ON f.customer_key = c.customer_key
LEFT JOIN dimdate d ON f.date_key = d.date_key
"""
CTES["ticket_labels"] = """
SELECT f.*, c.plan_type, c.region, c.customer_type, c.tenure_bucket, i.issue_category, d.date, d.year, d.month
FROM facttickets f
LEFT JOIN customer_labels c ON f.customer_key = c.customer_key
LEFT JOIN dimissuecategory i ON f.issue_category_key = i.issue_category_key
LEFT JOIN dimdate d ON f.open_date_key = d.date_key
"""
CTES["billing_labels"] = """
SELECT f.*, s.payment_status, c.plan_type, c.region, c.customer_type, c.tenure_bucket, d.date, d.year, d.month
FROM factbilling f
LEFT JOIN customer_labels c ON f.customer_key = c.customer_key
LEFT JOIN dimpaymentstatus s ON f.payment_status_key = s.payment_status_key
LEFT JOIN dimdate d ON f.billing_month_key = d.date_key
"""

# --- features and model ----------------------------------------------------------

CTES["telemetry_features"] = """
SELECT customer_key, avg(daily_bandwidth_gb) AS avg_daily_bandwidth_gb,
  avg(peak_hour_latency_ms) AS avg_peak_latency_ms, avg(off_peak_latency_ms) AS avg_offpeak_latency_ms,
  avg(packet_loss_percent) AS avg_packet_loss_pct, avg(connection_drops) AS avg_connection_drops,
  CAST(sum(CAST(outage_flag AS INTEGER)) AS BIGINT) AS outage_days,
  CAST(sum(CAST(sla_breach AS INTEGER)) AS BIGINT) AS sla_breach_days
FROM facttelemetry GROUP BY customer_key
"""
CTES["ticket_days"] = """
SELECT t.ticket_id, t.channel, t.resolved, t.satisfaction_score, t.customer_key, t.issue_category_key,
  t.open_date_key, t.close_date_key, o.date AS open_date, c.date AS close_date,
  CASE WHEN t.resolved AND c.date IS NOT NULL THEN CAST(c.date - o.date AS INTEGER) END AS resolution_days
FROM facttickets t
LEFT JOIN dimdate o ON t.open_date_key = o.date_key
LEFT JOIN dimdate c ON t.close_date_key = c.date_key
"""
CTES["ticket_features"] = """
SELECT customer_key, count(*) AS ticket_count, avg(CAST(resolved AS INTEGER)) AS ticket_resolved_rate,
  avg(satisfaction_score) AS avg_ticket_satisfaction, avg(resolution_days) AS avg_resolution_days
FROM ticket_days GROUP BY customer_key
"""
CTES["billing_features"] = """
SELECT customer_key, count(*) AS billing_cycles, avg(amount_charged_aud) AS avg_amount_charged,
  avg(CASE WHEN payment_status = 'late' THEN 1 ELSE 0 END) AS late_rate,
  avg(CASE WHEN payment_status = 'failed' THEN 1 ELSE 0 END) AS failed_rate
FROM factbilling LEFT JOIN dimpaymentstatus USING (payment_status_key) GROUP BY customer_key
"""
_features = ", ".join(name for name, _ in ddl_columns(FEATURES_DDL))
CTES["churn_features"] = f"""
SELECT {_features}
FROM customer_labels
LEFT JOIN telemetry_features USING (customer_key)
LEFT JOIN ticket_features USING (customer_key)
LEFT JOIN billing_features USING (customer_key)
"""
CTES["labelled"] = "SELECT *, CAST(churn_flag AS INTEGER) AS label FROM churn_features WHERE churn_flag IS NOT NULL"
CTES["model_columns"] = """
SELECT customer_type, plan_type, contract_type, region, monthly_charge_aud, tenure_months,
  CAST(has_cybersecurity_addon AS INTEGER) AS has_cybersecurity_addon_num,
  CAST(has_voip_addon AS INTEGER) AS has_voip_addon_num, avg_daily_bandwidth_gb, avg_peak_latency_ms,
  avg_offpeak_latency_ms, avg_packet_loss_pct, avg_connection_drops, outage_days, sla_breach_days, ticket_count,
  ticket_resolved_rate, avg_ticket_satisfaction, avg_resolution_days, billing_cycles, avg_amount_charged,
  late_rate, failed_rate, label, customer_id
FROM labelled
"""
# A score that SQL can compute too, with many ties: the share of late and failed bills.
CTES["given_scores"] = """
SELECT customer_id, customer_type, plan_type, contract_type, region, tenure_months, sla_breach_days, failed_rate,
  ticket_count, label, round(coalesce(late_rate, 0) * 0.5 + coalesce(failed_rate, 0) * 0.5, 6) AS churn_probability
FROM labelled
"""
CTES["churn_scores"] = """
SELECT customer_id, customer_type, plan_type, contract_type, region, tenure_months, monthly_charge_aud,
  avg_daily_bandwidth_gb, avg_peak_latency_ms, avg_offpeak_latency_ms, avg_packet_loss_pct, avg_connection_drops,
  CAST(outage_days AS DOUBLE) AS outage_days, CAST(sla_breach_days AS DOUBLE) AS sla_breach_days,
  CAST(ticket_count AS DOUBLE) AS ticket_count, ticket_resolved_rate, avg_ticket_satisfaction,
  CAST(billing_cycles AS DOUBLE) AS billing_cycles, avg_amount_charged, late_rate, failed_rate, label AS churn_flag,
  round(coalesce(late_rate, 0) * 0.5 + coalesce(failed_rate, 0) * 0.5, 6) AS churn_probability
FROM labelled
"""


def with_ctes(query: str) -> str:
    """``query`` with the CTEs it needs in front, in order of dependence."""
    needed: list[str] = []

    def visit(name: str) -> None:
        for other in CTES:
            if other != name and other not in needed and re.search(rf"\b(FROM|JOIN)\s+{other}\b", CTES[name]):
                visit(other)
        if name not in needed:
            needed.append(name)

    for name in CTES:
        if name not in needed and re.search(rf"\b(FROM|JOIN)\s+{name}\b", query):
            visit(name)
    if not needed:
        return query
    ctes = ",\n".join(f"{n} AS ({CTES[n].strip()})" for n in needed)
    return f"WITH {ctes}\n{query.strip()}"
