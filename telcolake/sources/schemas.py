"""Column layout of every table, as DDL, and the typing rules of the Silver layer.

All table and column names, types and their order are fixed values.
"""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SourceTable:
    """A raw table: its columns (all text), its key, and the columns Silver types."""

    name: str
    key: str
    columns: tuple[str, ...]
    dates: tuple[str, ...] = ()
    booleans: tuple[str, ...] = ()
    doubles: tuple[str, ...] = ()
    integers: tuple[str, ...] = ()

    @property
    def bronze_ddl(self) -> str:
        return ", ".join(f"{c} string" for c in self.columns)

    @property
    def silver_ddl(self) -> str:
        types = dict.fromkeys(self.columns, "string")
        types |= dict.fromkeys(self.dates, "date")
        types |= dict.fromkeys(self.booleans, "boolean")
        types |= dict.fromkeys(self.doubles, "double")
        types |= dict.fromkeys(self.integers, "int")
        return ", ".join(f"{c} {t}" for c, t in types.items())


CUSTOMERS = SourceTable(
    name="customers",
    key="customer_id",
    columns=(
        "customer_id",
        "customer_type",
        "region",
        "plan_type",
        "contract_type",
        "monthly_charge_aud",
        "tenure_months",
        "has_cybersecurity_addon",
        "has_voip_addon",
        "onboarded_date",
        "churn_flag",
        "churn_date",
    ),
    dates=("onboarded_date", "churn_date"),
    booleans=("has_cybersecurity_addon", "has_voip_addon", "churn_flag"),
    doubles=("monthly_charge_aud",),
    integers=("tenure_months",),
)

NETWORK_TELEMETRY = SourceTable(
    name="network_telemetry",
    key="telemetry_id",
    columns=(
        "telemetry_id",
        "customer_id",
        "date",
        "region",
        "plan_type",
        "daily_bandwidth_gb",
        "peak_hour_latency_ms",
        "off_peak_latency_ms",
        "packet_loss_percent",
        "connection_drops",
        "sla_breach",
        "outage_flag",
        "node_id",
    ),
    dates=("date",),
    booleans=("sla_breach", "outage_flag"),
    doubles=(
        "daily_bandwidth_gb",
        "peak_hour_latency_ms",
        "off_peak_latency_ms",
        "packet_loss_percent",
    ),
    integers=("connection_drops",),
)

SUPPORT_TICKETS = SourceTable(
    name="support_tickets",
    key="ticket_id",
    columns=(
        "ticket_id",
        "customer_id",
        "open_date",
        "close_date",
        "issue_category",
        "region",
        "channel",
        "resolved",
        "satisfaction_score",
    ),
    dates=("open_date", "close_date"),
    booleans=("resolved",),
    integers=("satisfaction_score",),
)

BILLING_EVENTS = SourceTable(
    name="billing_events",
    key="billing_id",
    columns=(
        "billing_id",
        "customer_id",
        "billing_month",
        "amount_charged_aud",
        "payment_status",
        "payment_date",
        "payment_method",
    ),
    dates=("billing_month", "payment_date"),
    doubles=("amount_charged_aud",),
)

SOURCES = {t.name: t for t in (CUSTOMERS, NETWORK_TELEMETRY, SUPPORT_TICKETS, BILLING_EVENTS)}

GOLD_DDL = {
    "dimdate": (
        "date date, date_key int, year int, month int, day int, day_of_week int, is_weekend boolean"
    ),
    "dimregion": "region_key int, region string",
    "dimissuecategory": "issue_category_key int, issue_category string",
    "dimpaymentstatus": "payment_status_key int, payment_status string",
    "dimcustomer": (
        "customer_key int, customer_id string, customer_type string, customer_id_str string, "
        "region_key int, plan_type string, contract_type string, monthly_charge_aud double, "
        "tenure_months int, has_cybersecurity_addon boolean, has_voip_addon boolean, "
        "onboarded_date date, churn_flag boolean, churn_date date"
    ),
    "facttelemetry": (
        "telemetry_id string, plan_type string, daily_bandwidth_gb double, "
        "peak_hour_latency_ms double, off_peak_latency_ms double, packet_loss_percent double, "
        "connection_drops int, sla_breach boolean, outage_flag boolean, node_id string, "
        "customer_key int, date_key int"
    ),
    "factbilling": (
        "billing_id string, billing_month date, amount_charged_aud double, payment_method string, "
        "customer_key int, payment_status_key int, billing_month_key int, payment_date_key int"
    ),
    "facttickets": (
        "ticket_id string, channel string, resolved boolean, satisfaction_score int, "
        "customer_key int, issue_category_key int, open_date_key int, close_date_key int"
    ),
}

FEATURES_DDL = (
    "customer_id string, region string, customer_type string, plan_type string, "
    "contract_type string, monthly_charge_aud double, tenure_months int, "
    "has_cybersecurity_addon boolean, has_voip_addon boolean, avg_daily_bandwidth_gb double, "
    "avg_peak_latency_ms double, avg_offpeak_latency_ms double, avg_packet_loss_pct double, "
    "avg_connection_drops double, outage_days bigint, sla_breach_days bigint, "
    "ticket_count bigint, ticket_resolved_rate double, avg_ticket_satisfaction double, "
    "avg_resolution_days double, billing_cycles bigint, avg_amount_charged double, "
    "late_rate double, failed_rate double, churn_flag boolean, churn_date date"
)

SCORES_DDL = (
    "customer_id string, customer_type string, plan_type string, contract_type string, "
    "region string, tenure_months int, monthly_charge_aud double, avg_daily_bandwidth_gb double, "
    "avg_peak_latency_ms double, avg_offpeak_latency_ms double, avg_packet_loss_pct double, "
    "avg_connection_drops double, outage_days double, sla_breach_days double, "
    "ticket_count double, ticket_resolved_rate double, avg_ticket_satisfaction double, "
    "billing_cycles double, avg_amount_charged double, late_rate double, failed_rate double, "
    "churn_flag int, churn_probability double"
)


def ddl_columns(ddl: str) -> list[tuple[str, str]]:
    """(name, type) pairs of a DDL string, in order."""
    return [tuple(field.split()) for field in ddl.split(", ")]
