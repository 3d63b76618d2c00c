"""One function per dashboard visual; each takes a star with its filter context."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolake.plans.star import Star, evaluate, evaluate_sets


def churn_by_plan(star: Star) -> DataFrame:
    by_plan = evaluate(star, ["churn_rate_pct"], by=["plan_type"])
    return by_plan.orderBy(F.desc("churn_rate_pct"), "plan_type")


def churn_by_region(star: Star) -> DataFrame:
    return evaluate(star, ["churn_rate_pct", "churned_customers"], by=["region"])


def churn_by_tenure_bucket(star: Star) -> DataFrame:
    return evaluate(star, ["churn_rate_pct"], by=["tenure_bucket"])


def sla_vs_churn(star: Star, by: str = "plan_type") -> DataFrame:
    return evaluate(star, ["sla_breach_rate_pct", "churn_rate_pct"], by=[by])


def network_health_by_month(star: Star) -> DataFrame:
    return evaluate(star, ["sla_breach_rate_pct", "avg_peak_latency"], by=["year", "month"])


def peak_latency_by_region(star: Star) -> DataFrame:
    return evaluate(star, ["avg_peak_latency"], by=["region"])


def loss_vs_bandwidth_by_plan(star: Star) -> DataFrame:
    return evaluate(star, ["avg_bandwidth_gb", "avg_packet_loss"], by=["plan_type"])


def outages_by_region(star: Star, as_of: date | None = None) -> DataFrame:
    return evaluate(star, ["outages_last_30_days"], by=["region"], as_of=as_of)


def recent_outages_over_time(star: Star, by: str | None = None) -> DataFrame:
    """Outages of the 30 days up to each day, for all customers or per label."""
    return evaluate(star, ["outages_last_30_days"], by=[*([by] if by else []), "date"])


def outages_over_time(star: Star) -> DataFrame:
    """Days with at least one outage row."""
    return evaluate(star, ["outage_rows"], by=["date"]).filter(F.col("outage_rows") > 0)


def tickets_by_issue(star: Star) -> DataFrame:
    return evaluate(star, ["ticket_count"], by=["issue_category"])


def resolved_by_issue(star: Star) -> DataFrame:
    return evaluate(star, ["resolved_ticket_count"], by=["issue_category"])


def tickets_by_region(star: Star) -> DataFrame:
    return evaluate(star, ["ticket_count", "resolved_rate_pct"], by=["region"])


def payment_failure_and_churn_by_region(star: Star) -> DataFrame:
    return evaluate(star, ["payment_failure_rate_pct", "churn_rate_pct"], by=["region"])


CARDS = (
    "total_customers",
    "churned_customers",
    "churn_rate_pct",
    "avg_tenure_months",
    "avg_peak_latency",
    "avg_packet_loss",
    "sla_breach_count",
    "total_telemetry_rows",
    "sla_breach_rate_pct",
    "outages_last_30_days",
    "ticket_count",
    "resolved_ticket_count",
    "resolved_rate_pct",
    "payment_failure_rate_pct",
    "avg_bandwidth_gb",
)


def segment_kpis(star: Star, as_of: date | None = None) -> DataFrame:
    """All card measures of the filter context in one row, with one pass per fact."""
    return evaluate(star, CARDS, as_of=as_of)


def all_segment_kpis(star: Star, segments: Sequence[Sequence[str]], as_of: date | None = None) -> DataFrame:
    """All card measures of every segment of each grouping, still with one pass per fact."""
    return evaluate_sets(star, CARDS, segments, as_of=as_of)
