"""Measures and filter context on a hand-made star."""

from dataclasses import replace
from datetime import date

import pytest

from telcolake.functions.rules import tenure_bucket
from telcolake.plans import star as st
from telcolake.plans.calendar import dim_date
from telcolake.sources.schemas import GOLD_DDL, ddl_columns


def table(spark, name, *rows):
    columns = [c for c, _ in ddl_columns(GOLD_DDL[name])]
    return spark.createDataFrame([tuple(r.get(c) for c in columns) for r in rows], GOLD_DDL[name])


@pytest.fixture(params=["few customers", "many customers"])
def star(spark, tables, request):
    """The star with customers that Spark broadcasts, and with too many for that."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    if request.param == "many customers":
        for name in names:
            spark.conf.set(name, "-1")
    yield st.Star(tables)
    for name in names:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def tables(spark):
    def outage(day):
        return {"outage_flag": True, "sla_breach": False, "date_key": day, "customer_key": 1}

    return (
        {
            "dimdate": dim_date(spark),
            "dimregion": table(
                spark, "dimregion", {"region_key": 1, "region": "Perth"}, {"region_key": 2, "region": "Sydney"}
            ),
            "dimissuecategory": table(spark, "dimissuecategory", {"issue_category_key": 1, "issue_category": "slow_speed"}),
            "dimpaymentstatus": table(
                spark,
                "dimpaymentstatus",
                {"payment_status_key": 1, "payment_status": "Failed"},
                {"payment_status_key": 2, "payment_status": "paid"},
            ),
            "dimcustomer": table(
                spark,
                "dimcustomer",
                {"customer_key": 1, "region_key": 1, "plan_type": "Fibre", "churn_flag": True, "tenure_months": 6},
                {"customer_key": 2, "region_key": 2, "plan_type": "NBN50", "churn_flag": False, "tenure_months": 30},
                {"customer_key": 3, "region_key": None, "plan_type": "NBN50", "churn_flag": None},
            ),
            "facttelemetry": table(
                spark,
                "facttelemetry",
                outage(20240531),  # 30 days before 30 June: outside
                outage(20240601),  # 29 days before: inside
                outage(20240630),
                outage(20240701),  # after the day: outside
                {"date_key": 20240630, "customer_key": None, "sla_breach": True, "peak_hour_latency_ms": 7.0},
            ),
            "factbilling": table(
                spark,
                "factbilling",
                {"billing_month_key": 20240601, "payment_date_key": 20240705, "customer_key": 1, "payment_status_key": 1},
                {"billing_month_key": 20240601, "customer_key": 2, "payment_status_key": 2},
                {"billing_month_key": 20240601, "customer_key": 2},
            ),
            "facttickets": table(
                spark,
                "facttickets",
                {"open_date_key": 20240601, "customer_key": 1, "issue_category_key": 1, "resolved": True},
                {"open_date_key": 20230601, "customer_key": 2, "issue_category_key": None, "resolved": False},
            ),
        }
    )


def one(df):
    rows = df.collect()
    assert len(rows) == 1
    return rows[0]


def test_tenure_buckets(spark):
    months = [6, 7, 12, 13, 24, 25, None]
    df = spark.createDataFrame([(m,) for m in months], "tenure_months int").select(tenure_bucket())
    assert [r[0] for r in df.collect()] == [
        "0–6 months",
        "7–12 months",
        "7–12 months",
        "13–24 months",
        "13–24 months",
        "24+ months",
        "0–6 months",
    ]


def test_empty_context_gives_blank_rates(star):
    empty = st.filter_plan(star, ["none"])
    row = one(st.evaluate(empty, ["total_customers", "churn_rate_pct", "ticket_count", "resolved_rate_pct"]))
    assert tuple(row) == (0, None, 0, None)


def test_outage_window(star):
    assert one(st.evaluate(star, ["outages_last_30_days"], as_of=date(2024, 6, 30)))[0] == 2
    june = st.filter_date_range(star, date_to=date(2024, 6, 30))
    assert one(st.evaluate(june, ["outages_last_30_days"]))[0] == 2
    assert one(st.evaluate(star, ["outages_last_30_days"]))[0] == 0  # calendar ends in 2026


def test_failed_status_in_any_case(star):
    assert one(st.evaluate(star, ["payment_failure_rate_pct"]))[0] == pytest.approx(100 / 3)


def test_date_slicer_leaves_customers_alone(star):
    kept = st.apply_filters(star, years=[2024], months=[6])
    row = one(st.evaluate(kept, ["total_customers", "ticket_count"]))
    assert tuple(row) == (3, 1)


def test_drill_across_keeps_unmatched_groups(star):
    df = st.evaluate(star, ["sla_breach_rate_pct", "churn_rate_pct"], by=["region"])
    got = {r.region: (r.sla_breach_rate_pct, r.churn_rate_pct) for r in df.collect()}
    # Telemetry without customer and the customer without region share the blank group.
    assert got == {"Perth": (0.0, 100.0), "Sydney": (None, 0.0), None: (100.0, 0.0)}


def test_customer_and_date_axes(star):
    df = st.evaluate(star, ["outage_rows"], by=["region", "month"])
    assert {tuple(r) for r in df.collect()} == {("Perth", 5, 1), ("Perth", 6, 2), ("Perth", 7, 1), (None, 6, 0)}
    kept = st.filter_plan(star, ["Fibre"])
    df = st.evaluate(kept, ["outage_rows"], by=["year"], filters={"months": [6]})
    assert [tuple(r) for r in df.collect()] == [(2024, 2)]


def test_other_date_role(star):
    paid = replace(star, date_role={**st.DATE_ROLE, "factbilling": "payment_date_key"})
    july = {"date_from": date(2024, 7, 1), "date_to": date(2024, 7, 31)}
    assert one(st.evaluate(star, ["payment_failure_rate_pct"], filters=july))[0] is None
    assert one(st.evaluate(paid, ["payment_failure_rate_pct"], filters=july))[0] == 100.0


def test_fact_rows_under_filter(star):
    kept = st.filter_region(star, ["Perth"])
    assert kept.fact("facttelemetry").count() == 4
    assert one(st.evaluate(kept, ["total_telemetry_rows"]))[0] == 4


def test_blank_issue_group(star):
    df = st.evaluate(star, ["ticket_count", "resolved_ticket_count"], by=["issue_category"])
    assert {tuple(r) for r in df.collect()} == {("slow_speed", 1, 1), (None, 1, 0)}


def test_axis_without_relationship(star):
    with pytest.raises(ValueError):
        st.evaluate(star, ["churn_rate_pct"], by=["issue_category"])


def test_each_day_has_its_own_window(star):
    """The running 30 days reach back past the slicer's first day; days without outages are filled up."""
    kept = st.filter_date_range(star, date(2024, 6, 29), date(2024, 7, 2))
    rows = {r.date: (r.outages_last_30_days, r.outage_rows) for r in st.evaluate(kept, ["outages_last_30_days", "outage_rows"], by=["date"]).collect()}
    # 31 May falls out of the window on 30 June, 1 June on 1 July.
    assert rows == {date(2024, 6, 29): (2, 0), date(2024, 6, 30): (2, 1), date(2024, 7, 1): (2, 1), date(2024, 7, 2): (2, 0)}


def test_month_windows_end_at_the_last_day_in_context(star):
    kept = st.filter_date_range(star, date(2024, 5, 1), date(2024, 7, 29))
    by_month = st.evaluate(kept, ["outages_last_30_days"], by=["region", "year", "month"]).collect()
    got = {(r.region, r.month): r.outages_last_30_days for r in by_month}
    # May ends on the 31st; June's 30 days leave 31 May out; July's end on the 29th and hold 30 June.
    assert {m: got["Perth", m] for m in (5, 6, 7)} == {5: 1, 6: 2, 7: 2}
    assert {m: got[None, m] for m in (5, 6, 7)} == {5: 0, 6: 0, 7: 0}


def test_windows_of_filtered_customers_and_empty_calendars(star):
    assert st.evaluate(st.filter_region(star, ["Sydney"]), ["outages_last_30_days"], by=["plan_type", "month"]).count() == 0
    nothing = st.filter_date_range(star, date(2030, 1, 1))
    assert st.evaluate(nothing, ["outages_last_30_days"], by=["region", "date"]).count() == 0
    assert st.evaluate(nothing, ["outages_last_30_days"], by=["date"]).count() == 0
    with pytest.raises(ValueError):
        st.evaluate(star, ["outages_last_30_days"], by=["issue_category", "date"])


def test_one_end_for_all_months_on_request(star):
    rows = st.evaluate(star, ["outages_last_30_days"], by=["month"], as_of=date(2024, 6, 30)).collect()
    assert {r.month: r.outages_last_30_days for r in rows} == {5: 0, 6: 2, 7: 0}


def test_many_groupings_at_once(star):
    sets = [[], ["region"], ["plan_type", "region"], ["month"]]
    cards = ["sla_breach_rate_pct", "total_telemetry_rows", "outage_rows"]
    got = st.evaluate_sets(star, cards, sets).collect()
    for axes in sets:
        mine = [r for r in got if r.grain == ",".join(a for a in ("region", "plan_type", "month") if a in axes)]
        alone = st.evaluate(star, cards, by=axes).collect()
        key = lambda r: repr([r[a] for a in axes])
        assert [[r[c] for c in (*axes, *cards)] for r in sorted(mine, key=key)] == [[r[c] for c in (*axes, *cards)] for r in sorted(alone, key=key)]
    assert st.evaluate_sets(star, ["total_customers"], [[]]).first().total_customers == 3
    with pytest.raises(ValueError):
        st.evaluate_sets(star, ["outages_last_30_days"], [["month"]])
    rows = st.evaluate_sets(star, ["outages_last_30_days"], [["month"], []], as_of=date(2024, 6, 30)).collect()
    assert {(r.grain, r.month): r.outages_last_30_days for r in rows if r.month in (6, None)} == {("month", 6): 2, ("", None): 2}


def test_many_groupings_read_each_fact_once(star):
    from telcolake.plans import visuals

    df = visuals.all_segment_kpis(star, [[], ["region"], ["plan_type"], ["region", "plan_type"]], as_of=date(2024, 6, 30))
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Expand") == 1
    # One relation of rows per table, whatever the number of groupings.
    assert plan.count("peak_hour_latency_ms#") > 0 and plan.count("LogicalRDD") + plan.count("LocalRelation") <= 12
