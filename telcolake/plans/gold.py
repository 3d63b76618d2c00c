"""The star schema: five dimensions, three facts."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telcolake.operators.dedupe import distinct_members
from telcolake.operators.keys import extend_keys, lookup_key, role_playing_date_keys, surrogate_key
from telcolake.plans.calendar import CALENDAR_END, CALENDAR_START, dim_date
from telcolake.sources.schemas import GOLD_DDL, ddl_columns
from telcolake.sources.tables import in_days
from telcolake.sources.together import together


def _columns(table: str) -> list[str]:
    return [name for name, _ in ddl_columns(GOLD_DDL[table])]


def member_dimension(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of ``column``, numbered in their order."""
    return surrogate_key(distinct_members(df, column), [column], f"{column}_key")


def dim_region(customers: DataFrame) -> DataFrame:
    return member_dimension(customers, "region")


def dim_issue_category(tickets: DataFrame) -> DataFrame:
    return member_dimension(tickets, "issue_category")


def dim_payment_status(billing: DataFrame) -> DataFrame:
    return member_dimension(billing, "payment_status")


# The key of each dimension that numbers its members: Silver table, member column and key column.
MEMBERS = {
    "dimregion": ("customers", "region", "region_key"),
    "dimissuecategory": ("support_tickets", "issue_category", "issue_category_key"),
    "dimpaymentstatus": ("billing_events", "payment_status", "payment_status_key"),
    "dimcustomer": ("customers", "customer_id", "customer_key"),
}


def key_map(silver: Mapping[str, DataFrame], dimension: str, known: DataFrame | None = None) -> DataFrame:
    """(key, member) of a dimension: members of earlier loads keep the keys in ``known``."""
    table, member, key = MEMBERS[dimension]
    members = distinct_members(silver[table], member)
    return surrogate_key(members, [member], key) if known is None else extend_keys(known, members, [member], key)


def keyed_dimensions(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    maps: Mapping[str, DataFrame],
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
) -> dict[str, DataFrame]:
    """Dimensions whose members have the keys of ``maps``; members not in Silver are left out."""

    def present(dimension: str) -> DataFrame:
        table, member, key = MEMBERS[dimension]
        here = distinct_members(silver[table], member).select(F.col(member).alias("_here"))
        return maps[dimension].join(here, F.col(member).eqNullSafe(F.col("_here")), "left_semi").select(key, member)

    regions = present("dimregion")
    customers = lookup_key(silver["customers"], maps["dimcustomer"], "customer_id", "customer_id", "customer_key")
    return {
        "dimdate": dim_date(spark, start, end),
        "dimregion": regions,
        "dimissuecategory": present("dimissuecategory"),
        "dimpaymentstatus": present("dimpaymentstatus"),
        "dimcustomer": customer_dimension(customers, regions),
    }


def dim_customer(customers: DataFrame, regions: DataFrame) -> DataFrame:
    return customer_dimension(surrogate_key(customers, ["customer_id"], "customer_key"), regions)


def customer_dimension(keyed: DataFrame, regions: DataFrame) -> DataFrame:
    """Customers that have their key, with the key of their region."""
    with_region = lookup_key(keyed, regions, "region", "region", "region_key")
    return with_region.withColumn("customer_id_str", F.col("customer_id")).select(*_columns("dimcustomer"))


def customer_region_check(customers: DataFrame, n: int = 5) -> DataFrame:
    """Preview of the region lookup: the first ``n`` customers with region and key."""
    regions = dim_region(customers)
    return (
        lookup_key(customers, regions, "region", "region", "region_key")
        .select("customer_id", "region", "region_key")
        .orderBy("customer_id")
        .limit(n)
    )


def fact_telemetry(
    telemetry: DataFrame,
    customers: DataFrame,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
) -> DataFrame:
    """All telemetry rows; customer and date keys are NULL where unknown."""
    keyed = lookup_key(telemetry, customers, "customer_id", "customer_id", "customer_key")
    return role_playing_date_keys(keyed, {"date": "date_key"}, start, end).select(*_columns("facttelemetry"))


def fact_billing(
    billing: DataFrame,
    customers: DataFrame,
    statuses: DataFrame,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
) -> DataFrame:
    """All bills; keys are NULL where unknown."""
    keyed = lookup_key(billing, customers, "customer_id", "customer_id", "customer_key")
    keyed = lookup_key(keyed, statuses, "payment_status", "payment_status", "payment_status_key")
    roles = {"billing_month": "billing_month_key", "payment_date": "payment_date_key"}
    return role_playing_date_keys(keyed, roles, start, end).select(*_columns("factbilling"))


def fact_tickets(
    tickets: DataFrame,
    customers: DataFrame,
    categories: DataFrame,
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
) -> DataFrame:
    """Tickets of known customers that were opened inside the calendar."""
    keyed = lookup_key(tickets, customers, "customer_id", "customer_id", "customer_key")
    keyed = lookup_key(keyed, categories, "issue_category", "issue_category", "issue_category_key")
    roles = {"open_date": "open_date_key", "close_date": "close_date_key"}
    return (
        role_playing_date_keys(keyed, roles, start, end)
        .filter(F.col("customer_key").isNotNull() & F.col("open_date_key").isNotNull())
        .select(*_columns("facttickets"))
    )


def dimensions(
    spark: SparkSession,
    silver: Mapping[str, DataFrame],
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
) -> dict[str, DataFrame]:
    keyed = together(
        {
            "dimregion": lambda: dim_region(silver["customers"]),
            "dimissuecategory": lambda: dim_issue_category(silver["support_tickets"]),
            "dimpaymentstatus": lambda: dim_payment_status(silver["billing_events"]),
            "customers": lambda: surrogate_key(silver["customers"], ["customer_id"], "customer_key"),
        }
    )
    customers = keyed.pop("customers")
    return {
        "dimdate": dim_date(spark, start, end),
        **keyed,
        "dimcustomer": customer_dimension(customers, keyed["dimregion"]),
    }


def facts(
    silver: Mapping[str, DataFrame],
    dims: Mapping[str, DataFrame],
    start: date = CALENDAR_START,
    end: date = CALENDAR_END,
) -> dict[str, DataFrame]:
    customers = dims["dimcustomer"]
    return {
        "facttelemetry": fact_telemetry(silver["network_telemetry"], customers, start, end),
        "factbilling": fact_billing(silver["billing_events"], customers, dims["dimpaymentstatus"], start, end),
        "facttickets": fact_tickets(silver["support_tickets"], customers, dims["dimissuecategory"], start, end),
    }


def telemetry_by_date_key_range(fact: DataFrame, low: int, high: int) -> DataFrame:
    return in_days(fact, "date_key", low, high).select(*_columns("facttelemetry"))


def scores_join_customer(scores: DataFrame, customers: DataFrame) -> DataFrame:
    """Churn probability next to the customer attributes of the star."""
    attributes = customers.select("customer_id", "customer_type", "plan_type")
    return scores.select("customer_id", "churn_probability").join(attributes, "customer_id")
