"""Data checks on the Silver tables, from the business rules of the source systems."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolake.functions.rules import sla_breached
from telcolake.operators.intervals import DAY, in_intervals, place

# Plans on sale per customer type.
PLANS_BY_TYPE = {
    "residential": ("NBN50", "NBN100", "NBN250", "NBN1000"),
    "business": ("NBN100", "NBN250", "NBN1000", "Fibre", "Business_VoIP"),
    "wholesale": ("Wholesale_Dark_Fibre", "Fibre", "NBN1000"),
}


def sla_breach_check(telemetry: DataFrame) -> DataFrame:
    """Stored against recomputed breach flag, per plan."""
    breached = F.coalesce(
        sla_breached(F.col("plan_type"), F.col("peak_hour_latency_ms"), F.col("packet_loss_percent")),
        F.lit(False),
    )
    return telemetry.groupBy("plan_type").agg(
        F.count("*").alias("telemetry_rows"),
        F.count_if(F.col("sla_breach")).alias("stored_breaches"),
        F.count_if(breached).alias("rule_breaches"),
        F.count_if(F.coalesce(F.col("sla_breach"), F.lit(False)) != breached).alias("mismatches"),
    )


# Bins of outage windows: longer than most of them, so most meet one or two.
WINDOW_BIN = 30 * DAY


def outage_windows(windows: DataFrame, margin_days: int = 0) -> DataFrame:
    """(region, start, end) in microseconds from windows (start, end, regions).

    Windows are of days, the last included, or of times. One without end goes on, one
    without start has always been.
    """
    kinds = dict(windows.dtypes)
    last = DAY - 1 if kinds["end"] == "date" else 0
    return windows.select(
        F.explode("regions").alias("region"),
        (place("start", kinds["start"]) - margin_days * DAY).alias("start"),
        (place("end", kinds["end"]) + last + margin_days * DAY).alias("end"),
    )


def _in_windows(rows: DataFrame, windows: DataFrame, at: str, name: str, margin_days: int = 0) -> DataFrame:
    placed = rows.withColumn("_at", place(at, dict(rows.dtypes)[at]))
    return in_intervals(placed, outage_windows(windows, margin_days), "_at", ["region"], WINDOW_BIN, name).drop("_at")


def outage_interval_join(telemetry: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows per region by "inside an outage window" and stored outage flag."""
    by_time = telemetry.groupBy("region", "date", "outage_flag").agg(F.count("*").alias("n"))
    return (
        _in_windows(by_time, windows, "date", "in_window")
        .groupBy("region", "in_window", "outage_flag")
        .agg(F.sum("n").alias("telemetry_rows"))
    )


def tickets_near_outage(tickets: DataFrame, windows: DataFrame, margin_days: int = 3) -> DataFrame:
    """Tickets per region opened within ``margin_days`` of an outage of the region, or not."""
    by_time = tickets.groupBy("region", "open_date").agg(F.count("*").alias("n"))
    return (
        _in_windows(by_time, windows, "open_date", "near_outage", margin_days)
        .groupBy("region", "near_outage")
        .agg(F.sum("n").alias("ticket_count"))
    )


def days_to_churn(telemetry: DataFrame, customers: DataFrame, horizon: int = 30) -> DataFrame:
    """Network quality by distance to the churn date, over the last ``horizon`` days."""
    days = F.date_diff("churn_date", "date")
    return (
        _with_churn_date(telemetry, customers)
        .withColumn("days_to_churn", days)
        .filter(F.col("days_to_churn").between(0, horizon))
        .groupBy("days_to_churn")
        .agg(
            F.count("*").alias("telemetry_rows"),
            F.avg("peak_hour_latency_ms").alias("avg_peak_latency_ms"),
            F.avg("packet_loss_percent").alias("avg_packet_loss_pct"),
            F.avg("connection_drops").alias("avg_connection_drops"),
        )
    )


def activity_after_churn(telemetry: DataFrame, billing: DataFrame, customers: DataFrame) -> DataFrame:
    """Rows dated after the customer's churn, per table; clean data has none."""
    late_telemetry = _with_churn_date(telemetry, customers).filter(F.col("date") > F.col("churn_date"))
    late_bills = _with_churn_date(billing, customers).filter(F.col("billing_month") > F.col("churn_date"))
    return _count_as(late_telemetry, "network_telemetry").unionByName(_count_as(late_bills, "billing_events"))


def csat_by_resolution_band(tickets: DataFrame) -> DataFrame:
    days = F.date_diff("close_date", "open_date")
    band = F.when(days <= 2, "up to 2 days").when(days <= 7, "3 to 7 days").otherwise("over 7 days")
    return (
        tickets.filter(F.col("resolved") & F.col("close_date").isNotNull())
        .groupBy(band.alias("resolution_band"))
        .agg(F.count("*").alias("ticket_count"), F.avg("satisfaction_score").alias("avg_satisfaction"))
    )


def payment_lag(billing: DataFrame) -> DataFrame:
    """Days from billing month to payment per status, and bills outside the status' range."""
    lag = F.date_diff("payment_date", "billing_month")
    # Paid after 1-7 days, late after 8-30 days, failed without payment.
    proper = (
        F.when(F.col("payment_status") == "paid", lag.between(1, 7))
        .when(F.col("payment_status") == "late", lag.between(8, 30))
        .when(F.col("payment_status") == "failed", F.col("payment_date").isNull())
    )
    return billing.groupBy("payment_status").agg(
        F.count("*").alias("bills"),
        F.min(lag).alias("min_lag_days"),
        F.max(lag).alias("max_lag_days"),
        F.avg(lag).alias("avg_lag_days"),
        F.count_if(~F.coalesce(proper, F.lit(False))).alias("violations"),
    )


def allowed_plans(customers: DataFrame) -> DataFrame:
    """The fixed (customer_type, plan_type) pairs as a DataFrame."""
    pairs = [(kind, plan) for kind, plans in PLANS_BY_TYPE.items() for plan in plans]
    return customers.sparkSession.createDataFrame(pairs, "customer_type string, plan_type string")


def plan_type_domain_check(customers: DataFrame, allowed: DataFrame | None = None) -> DataFrame:
    """Customers per type whose plan is not sold to the type."""
    allowed = allowed if allowed is not None else allowed_plans(customers)
    pairs = customers.groupBy("customer_type", "plan_type").agg(F.count("*").alias("n"))
    marked = pairs.join(
        allowed.distinct().withColumn("_allowed", F.lit(True)), ["customer_type", "plan_type"], "left"
    )
    foreign = F.when(F.col("_allowed").isNull(), F.col("n")).otherwise(0)
    return marked.groupBy("customer_type").agg(F.sum("n").alias("customers"), F.sum(foreign).alias("violations"))


def node_region_check(telemetry: DataFrame, nodes: DataFrame) -> DataFrame:
    """Telemetry rows per region sent by a node that is not of the region (node_id, region)."""
    # Rows shrink to one per (region, node) before the lookup.
    pairs = telemetry.groupBy("region", "node_id").agg(F.count("*").alias("n"))
    foreign = pairs.join(nodes.select("region", "node_id").distinct(), ["region", "node_id"], "left_anti")
    return foreign.groupBy("region").agg(F.sum("n").alias("violations"))


def ticket_lifecycle_check(tickets: DataFrame) -> DataFrame:
    """Counts of tickets that break a lifecycle rule."""
    resolved = F.coalesce(F.col("resolved"), F.lit(False))
    closed = F.col("close_date").isNotNull()
    return tickets.agg(
        F.count("*").alias("ticket_count"),
        F.count_if(resolved != closed).alias("closed_not_resolved_or_back"),
        F.count_if(~resolved & F.col("satisfaction_score").isNotNull()).alias("scored_unresolved"),
        F.count_if(F.col("close_date") < F.col("open_date")).alias("closed_before_open"),
    )


def _with_churn_date(df: DataFrame, customers: DataFrame) -> DataFrame:
    churners = customers.filter(F.col("churn_date").isNotNull()).select("customer_id", "churn_date")
    return df.join(churners, "customer_id")


def _count_as(df: DataFrame, name: str) -> DataFrame:
    return df.agg(F.count("*").alias("rows_after_churn")).select(F.lit(name).alias("table_name"), "rows_after_churn")
