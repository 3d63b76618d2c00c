"""Measures on the star: additive components, drill-across and filter context.

A measure is a formula over additive components (counts and sums). A query aggregates
every fact it needs alone: the calendar's labels are looked up in each task, components
are summed per customer and label before the first shuffle, and the customers' labels are
joined to these partials, without a hint, so Spark picks the join by the size of the
customers. Partials of several facts are stacked and added up per group. The plan is the
same for any number of customers; facts never fan out against each other, and a customer
who owns a third of a fact is one partial row per task and label at the first shuffle.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field, replace
from datetime import date, timedelta
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telcolake.functions.dates import date_key
from telcolake.functions.rules import tenure_bucket
from telcolake.sources.tables import FACT_DAY, MONTH, in_days

CUSTOMER_AXES = ("region", "plan_type", "contract_type", "customer_type", "tenure_bucket")
DATE_AXES = ("date", "year", "month")
ISSUE_AXES = ("issue_category",)

# Days of the window of ``outages_last_30_days``.
RECENT_DAYS = 30

# The date role of each fact that date axes and date slicers use by default.
DATE_ROLE = dict(FACT_DAY)


@dataclass(frozen=True)
class Star:
    """The Gold tables under a filter context."""

    tables: Mapping[str, DataFrame]
    customers_filtered: bool = False
    date_role: Mapping[str, str] = field(default_factory=lambda: DATE_ROLE)
    # The facts before date slicers: rolling windows look back past a slicer's first day.
    undated: Mapping[str, DataFrame] | None = None

    def __getitem__(self, name: str) -> DataFrame:
        return self.tables[name]

    def customers(self, labels: Iterable[str]) -> DataFrame:
        """Customer rows with those of the label columns ``labels`` that the table lacks."""
        rows = self["dimcustomer"]
        if "region" in labels:
            rows = rows.join(self["dimregion"].select("region_key", "region"), "region_key", "left")
        if "tenure_bucket" in labels:
            rows = rows.withColumn("tenure_bucket", tenure_bucket())
        return rows

    def fact(self, name: str) -> DataFrame:
        """The rows of a fact that the filter context leaves."""
        rows = self[name]
        if not self.customers_filtered:
            return rows
        return rows.join(self["dimcustomer"].select("customer_key"), "customer_key", "left_semi")


@dataclass(frozen=True)
class Component:
    """An additive quantity: the row-level value that is summed over ``table``."""

    table: str
    value: Callable[[], Column]


@dataclass(frozen=True)
class Measure:
    components: tuple[str, ...]
    formula: Callable[[], Column]


def _flag(condition: Column) -> Column:
    return F.when(condition, 1).otherwise(0)


def _known(column: str) -> Column:
    return _flag(F.col(column).isNotNull())


COMPONENTS = {
    "customers": Component("dimcustomer", lambda: F.lit(1)),
    "churned": Component("dimcustomer", lambda: _flag(F.col("churn_flag"))),
    "tenure_sum": Component("dimcustomer", lambda: F.col("tenure_months")),
    "tenure_known": Component("dimcustomer", lambda: _known("tenure_months")),
    "telemetry_rows": Component("facttelemetry", lambda: F.lit(1)),
    "breaches": Component("facttelemetry", lambda: _flag(F.col("sla_breach"))),
    "outages": Component("facttelemetry", lambda: _flag(F.col("outage_flag"))),
    "peak_sum": Component("facttelemetry", lambda: F.col("peak_hour_latency_ms")),
    "peak_known": Component("facttelemetry", lambda: _known("peak_hour_latency_ms")),
    "loss_sum": Component("facttelemetry", lambda: F.col("packet_loss_percent")),
    "loss_known": Component("facttelemetry", lambda: _known("packet_loss_percent")),
    "bandwidth_sum": Component("facttelemetry", lambda: F.col("daily_bandwidth_gb")),
    "bandwidth_known": Component("facttelemetry", lambda: _known("daily_bandwidth_gb")),
    "off_peak_sum": Component("facttelemetry", lambda: F.col("off_peak_latency_ms")),
    "off_peak_known": Component("facttelemetry", lambda: _known("off_peak_latency_ms")),
    "drops_sum": Component("facttelemetry", lambda: F.col("connection_drops")),
    "drops_known": Component("facttelemetry", lambda: _known("connection_drops")),
    # Unlike the counts of flagged rows, NULL where no flag is known.
    "outage_sum": Component("facttelemetry", lambda: F.col("outage_flag").cast("int")),
    "breach_sum": Component("facttelemetry", lambda: F.col("sla_breach").cast("int")),
    "tickets": Component("facttickets", lambda: F.lit(1)),
    "resolved_sum": Component("facttickets", lambda: F.col("resolved").cast("int")),
    "resolved_known": Component("facttickets", lambda: _known("resolved")),
    "satisfaction_sum": Component("facttickets", lambda: F.col("satisfaction_score")),
    "satisfaction_known": Component("facttickets", lambda: _known("satisfaction_score")),
    "resolution_sum": Component("facttickets", lambda: F.col("resolution_days")),
    "resolution_known": Component("facttickets", lambda: _known("resolution_days")),
    "resolved_tickets": Component("facttickets", lambda: _flag(F.col("resolved"))),
    "payments": Component("factbilling", lambda: F.lit(1)),
    "amount_sum": Component("factbilling", lambda: F.col("amount_charged_aud")),
    "amount_known": Component("factbilling", lambda: _known("amount_charged_aud")),
    "late_bills": Component("factbilling", lambda: _flag(F.col("payment_status") == "late")),
    "failed_bills": Component("factbilling", lambda: _flag(F.col("payment_status") == "failed")),
    "failed_payments": Component("factbilling", lambda: _flag(F.lower("payment_status") == "failed")),
}


def _count(component: str) -> Measure:
    return Measure((component,), lambda: F.coalesce(F.col(component), F.lit(0)))


def total(component: str) -> Measure:
    return Measure((component,), lambda: F.col(component))


def ratio(part: str, whole: str, scale: int | None = None) -> Measure:
    """part / whole, blank when whole is 0 or missing."""

    def formula() -> Column:
        quotient = F.try_divide(F.col(part), F.col(whole))
        return quotient * scale if scale else quotient

    return Measure((part, whole), formula)


MEASURES = {
    "total_customers": _count("customers"),
    "churned_customers": _count("churned"),
    "churn_rate_pct": ratio("churned", "customers", 100),
    "avg_tenure_months": ratio("tenure_sum", "tenure_known"),
    "avg_peak_latency": ratio("peak_sum", "peak_known"),
    "avg_packet_loss": ratio("loss_sum", "loss_known"),
    "sla_breach_count": _count("breaches"),
    "total_telemetry_rows": _count("telemetry_rows"),
    "sla_breach_rate_pct": ratio("breaches", "telemetry_rows", 100),
    "outage_rows": _count("outages"),
    "outages_last_30_days": _count("recent_outages"),
    "ticket_count": _count("tickets"),
    "resolved_ticket_count": _count("resolved_tickets"),
    "resolved_rate_pct": ratio("resolved_tickets", "tickets", 100),
    "payment_failure_rate_pct": ratio("failed_payments", "payments", 100),
    "avg_bandwidth_gb": ratio("bandwidth_sum", "bandwidth_known"),
}


def evaluate(
    star: Star,
    measures: Sequence[str],
    by: Sequence[str] = (),
    as_of: date | None = None,
    filters: Mapping | None = None,
) -> DataFrame:
    """The given measures per group of the axes ``by`` (one row without axes).

    ``filters`` are slicers on top of the star's own context, as in ``apply_filters``.
    The 30-day window of ``outages_last_30_days`` ends at the group's own last calendar day in
    the filter context: on date axes each group has its own window, which reaches back into
    earlier groups and past the first day of a slicer. ``as_of`` sets one end for all groups.
    """
    totals = _totals(apply_filters(star, **(filters or {})), measures, by, as_of)
    return totals.select(*by, *[MEASURES[m].formula().alias(m) for m in measures])


def evaluate_sets(
    star: Star,
    measures: Sequence[str],
    sets: Sequence[Sequence[str]],
    as_of: date | None = None,
    filters: Mapping | None = None,
) -> DataFrame:
    """The measures of many groupings at once: one row per group of each set of axes.

    Every fact is read once, to the finest grain that the sets need; components are additive,
    so the coarser groups are sums of its few rows. ``grain`` names the axes of a row, in the
    order of the call; axes outside it are NULL.
    """
    axes = list(dict.fromkeys(a for s in sets for a in s))
    if as_of is None and "outages_last_30_days" in measures and any(a in DATE_AXES for a in axes):
        raise ValueError("windows that end on different days cannot be added up: give as_of")
    finest = _totals(apply_filters(star, **(filters or {})), measures, axes, as_of)
    needed = [c for c in finest.columns if c not in axes]
    if not axes:
        grouped = finest.withColumn("grain", F.lit(""))
    else:
        sums = [F.sum(c).alias(c) for c in needed]
        rolled = [F.grouping(a).alias(f"_no_{a}") for a in axes]
        whole = finest.groupingSets([[F.col(a) for a in s] for s in sets], *axes).agg(*sums, *rolled)
        named = F.concat_ws(",", *[F.when(F.col(f"_no_{a}") == 0, a) for a in axes])
        grouped = whole.withColumn("grain", named)
    return grouped.select("grain", *axes, *[MEASURES[m].formula().alias(m) for m in measures])


def _totals(star: Star, measures: Sequence[str], by: Sequence[str], as_of: date | None) -> DataFrame:
    """The additive components of the measures per group."""
    components = dict(COMPONENTS)
    own_windows = as_of is None and any(a in DATE_AXES for a in by)
    if "outages_last_30_days" in measures and not own_windows:
        components["recent_outages"] = _recent_outages(star, as_of)
    needed = dict.fromkeys(c for m in measures for c in MEASURES[m].components)

    per_table: dict[str, list[str]] = {}
    for name in needed:
        if name in components:
            per_table.setdefault(components[name].table, []).append(name)

    partials = [
        _partial(star, table, {n: components[n].value() for n in names}, by)
        for table, names in per_table.items()
    ]
    if "recent_outages" in needed and own_windows:
        partials.append(_rolling_outages(star, by))
    if len(partials) == 1:
        return partials[0]
    stacked = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), partials)
    return stacked.groupBy(*by).agg(*[F.sum(c).alias(c) for c in needed])


def apply_filters(
    star: Star,
    date_from: date | None = None,
    date_to: date | None = None,
    years: Iterable[int] | None = None,
    months: Iterable[int] | None = None,
    regions: Iterable[str] | None = None,
    plans: Iterable[str] | None = None,
    tenure_buckets: Iterable[str] | None = None,
    customer_types: Iterable[str] | None = None,
) -> Star:
    """The star under more slicers. ``None`` means "all".

    Date slicers cut the calendar and, through their date role, the facts; there is no
    relationship from the calendar to customers, so customer counts do not change.
    """
    star = filter_date_range(star, date_from, date_to, years, months)
    for column, values in (
        ("region", regions),
        ("plan_type", plans),
        ("tenure_bucket", tenure_buckets),
        ("customer_type", customer_types),
    ):
        if values is not None:
            star = _filter_customers(star, column, values)
    return star


def filter_date_range(
    star: Star,
    date_from: date | None = None,
    date_to: date | None = None,
    years: Iterable[int] | None = None,
    months: Iterable[int] | None = None,
) -> Star:
    # Conditions on a date key, where ``unit`` is 1, or on its month, where it is 100.
    conditions = []
    if date_from is not None:
        conditions.append(lambda key, unit: key >= _key_of(date_from) // unit)
    if date_to is not None:
        conditions.append(lambda key, unit: key <= _key_of(date_to) // unit)
    if years is not None or months is not None:
        spans = _key_spans(star, years, months)
        conditions.append(lambda key, unit: reduce(or_, [key.between(a // unit, b // unit) for a, b in spans], F.lit(False)))
    if not conditions:
        return star
    tables = dict(star.tables)
    for name, column in {"dimdate": "date_key", **star.date_role}.items():
        for condition in conditions:
            tables[name] = tables[name].filter(condition(F.col(column), 1))
            if _by_month(star, name):
                tables[name] = tables[name].filter(condition(F.col(MONTH), 100))
    return replace(star, tables=tables, undated=star.undated or star.tables)


def filter_calendar(star: Star, condition: Column) -> Star:
    """The star on the days that ``condition`` on the calendar's columns keeps, weekends say.

    Facts follow by a join with the days, and with their months: those prune the fact's
    partitions when the query runs.
    """
    days = star["dimdate"].filter(condition)
    tables = {**star.tables, "dimdate": days}
    # The calendar has one row per day.
    kept = F.broadcast(days.select(F.col("date_key").alias("_day"), F.floor(F.col("date_key") / 100).cast("int").alias("_months")))
    for name, column in star.date_role.items():
        same = F.col(column) == F.col("_day")
        if _by_month(star, name):
            same = same & (F.col(MONTH) == F.col("_months"))
        tables[name] = tables[name].join(kept, same, "left_semi")
    return replace(star, tables=tables, undated=star.undated or star.tables)


def _by_month(star: Star, name: str) -> bool:
    """Whether the fact is partitioned by the month of the date role in use."""
    return name in FACT_DAY and star.date_role[name] == FACT_DAY[name] and MONTH in star[name].columns


def _key_spans(star: Star, years: Iterable[int] | None, months: Iterable[int] | None) -> list[tuple[int, int]]:
    """Date key ranges of years and months: plain comparisons reach the file statistics.

    Without years, months are taken in every year from the calendar's first to its last.
    """
    if years is None:
        first, last = star["dimdate"].agg(F.min("date_key"), F.max("date_key")).first()
        years = range(first // 10000, last // 10000 + 1) if first else ()
    if months is None:
        return [(y * 10000 + 101, y * 10000 + 1231) for y in sorted(set(years))]
    return [(y * 10000 + m * 100 + 1, y * 10000 + m * 100 + 31) for y in sorted(set(years)) for m in sorted(set(months))]


def filter_region(star: Star, regions: Iterable[str]) -> Star:
    return _filter_customers(star, "region", regions)


def filter_plan(star: Star, plans: Iterable[str]) -> Star:
    return _filter_customers(star, "plan_type", plans)


def filter_tenure_bucket(star: Star, buckets: Iterable[str]) -> Star:
    return _filter_customers(star, "tenure_bucket", buckets)


def filter_customer_type(star: Star, types: Iterable[str]) -> Star:
    return _filter_customers(star, "customer_type", types)


def _filter_customers(star: Star, column: str, values: Iterable[str]) -> Star:
    """Keep customers whose label is among ``values``; facts follow when they are aggregated."""
    kept = star.customers([column]).filter(F.col(column).isin(*values)).select(*star["dimcustomer"].columns)
    return replace(star, tables={**star.tables, "dimcustomer": kept}, customers_filtered=True)


def _key_of(day: date) -> int:
    return day.year * 10000 + day.month * 100 + day.day


def _recent_outages(star: Star, as_of: date | None) -> Component:
    if as_of is None:
        # One value from the calendar, which has one row per day.
        as_of = star["dimdate"].agg(F.max("date")).first()[0]
    if as_of is None:
        return Component("facttelemetry", lambda: F.lit(0))
    first = _key_of(as_of - timedelta(days=RECENT_DAYS - 1))
    last = _key_of(as_of)
    day = F.col(star.date_role["facttelemetry"])
    return Component("facttelemetry", lambda: _flag(F.col("outage_flag") & day.between(first, last)))


def _rolling_outages(star: Star, by: Sequence[str]) -> DataFrame:
    """``recent_outages`` per group of the axes, each over the days that end at its own last day.

    Outages are added up per day and label first. Every label is filled up with all days of
    the calendar, so that a running sum over the last days has a row to end on; of these rows
    each date group keeps that of its last day. A window holds the days of one label.
    """
    labels, date_axes = [a for a in by if a in CUSTOMER_AXES], [a for a in by if a in DATE_AXES]
    if len(labels) + len(date_axes) < len(by):
        raise ValueError(f"facttelemetry has no axis {[a for a in by if a in ISSUE_AXES]}")
    first, last = star["dimdate"].agg(F.min("date"), F.max("date")).first()
    role = star.date_role["facttelemetry"]
    whole = replace(star, tables={**star.tables, "facttelemetry": (star.undated or star.tables)["facttelemetry"]})
    if first is None:  # an empty calendar has no group
        reach = whole["facttelemetry"].limit(0)
        first = last = date(1970, 1, 1)
    else:
        low, high = _key_of(first - timedelta(days=RECENT_DAYS - 1)), _key_of(last)
        reach = in_days(whole["facttelemetry"], role, low, high)
    whole = replace(whole, tables={**whole.tables, "facttelemetry": reach.withColumn("_key", F.col(role))})
    daily = _partial(whole, "facttelemetry", {"n": _flag(F.col("outage_flag"))}, labels, extra=["_key"])
    day = F.make_date(F.floor(F.col("_key") / 10000), F.floor(F.col("_key") / 100) % 100, F.col("_key") % 100)
    daily = daily.select(*labels, day.alias("_date"), "n", F.lit(False).alias("_filled"))
    span = F.explode(F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day")))
    if labels:
        filled = daily.select(*labels).distinct().select(*labels, span.alias("_date"))
    else:
        filled = star["dimdate"].select(F.col("date").alias("_date"))
    rows = daily.unionByName(filled.select(*labels, "_date", F.lit(0).cast("long").alias("n"), F.lit(True).alias("_filled")))
    frame = Window.partitionBy(*(labels or [F.lit(0)])).orderBy(F.datediff("_date", F.lit(first))).rangeBetween(1 - RECENT_DAYS, 0)
    rolled = rows.select(*labels, "_date", "_filled", F.sum("n").over(frame).alias("recent_outages")).filter("_filled")
    lasts = star["dimdate"].groupBy(*date_axes).agg(F.max(F.col("date")).alias("_last"))
    # The calendar has one row per day.
    return rolled.join(F.broadcast(lasts), F.col("_date") == F.col("_last")).select(*by, "recent_outages")


def _partial(star: Star, table: str, values: Mapping[str, Column], by: Sequence[str], extra: Sequence[str] = ()) -> DataFrame:
    """Components of one table summed per group, and per value of the columns ``extra``."""
    customer_axes = [a for a in by if a in CUSTOMER_AXES]
    date_axes = [a for a in by if a in DATE_AXES]
    issue_axes = [a for a in by if a in ISSUE_AXES]
    sums = [F.sum(value).alias(name) for name, value in values.items()]

    if table == "dimcustomer":
        if date_axes or issue_axes:
            raise ValueError(f"customers have no axis {date_axes + issue_axes}")
        return star.customers(by).groupBy(*by).agg(*sums)

    rows = star[table]
    if issue_axes and table != "facttickets":
        raise ValueError(f"{table} has no axis {issue_axes}")
    if "failed_payments" in values:
        statuses = star["dimpaymentstatus"].select("payment_status_key", "payment_status")
        rows = rows.join(statuses, "payment_status_key", "left")

    keys = [F.col(c) for c in extra]
    joins: list[tuple[DataFrame, str, str]] = []  # dimension, key, kind: joined to the partials
    if customer_axes or star.customers_filtered:
        kind = "inner" if star.customers_filtered else "left"
        keys.append(F.col("customer_key"))
        joins.append((star.customers(customer_axes).select("customer_key", *customer_axes), "customer_key", kind))
    if date_axes:
        # The calendar has one row per day; a fact may have columns of the same names.
        days = star["dimdate"].select(F.col("date_key").alias("_day"), *[F.col(a).alias(f"_{a}") for a in date_axes])
        rows = rows.join(F.broadcast(days), F.col(star.date_role[table]) == F.col("_day"), "left")
        keys += [F.col(f"_{a}").alias(a) for a in date_axes]
    if issue_axes:
        keys.append(F.col("issue_category_key"))
        issues = star["dimissuecategory"].select("issue_category_key", *issue_axes)
        joins.append((issues, "issue_category_key", "left"))

    partial = rows.groupBy(*keys).agg(*sums)
    if not joins:
        return partial
    for dimension, key, kind in joins:
        partial = partial.join(dimension, key, kind)
    return partial.groupBy(*extra, *by).agg(*[F.sum(n).alias(n) for n in values])
