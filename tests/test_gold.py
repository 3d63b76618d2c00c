"""Star schema rules on hand-made Silver rows."""

from datetime import date

import pytest

from telcolake.plans import calendar, features, gold
from telcolake.sources.schemas import FEATURES_DDL, GOLD_DDL, SOURCES


def table(spark, name, *rows):
    source = SOURCES[name]
    full = [tuple(row.get(c) for c in source.columns) for row in rows]
    return spark.createDataFrame(full, source.silver_ddl)


@pytest.fixture(scope="module")
def star(spark):
    silver = {
        "customers": table(
            spark,
            "customers",
            {"customer_id": "C", "region": "Perth", "churn_flag": True},
            {"customer_id": "A", "region": None},
            {"customer_id": "B", "region": "Adelaide"},
        ),
        "network_telemetry": table(
            spark,
            "network_telemetry",
            {"telemetry_id": "1", "customer_id": "C", "date": date(2019, 12, 31), "outage_flag": True},
            {"telemetry_id": "2", "customer_id": "stranger", "date": date(2020, 1, 5)},
            {"telemetry_id": "3", "customer_id": "C", "date": date(2020, 1, 5), "sla_breach": True},
        ),
        "support_tickets": table(
            spark,
            "support_tickets",
            {"ticket_id": "1", "customer_id": "C", "open_date": date(2019, 12, 31)},
            {"ticket_id": "2", "customer_id": "stranger", "open_date": date(2020, 1, 1)},
            {
                "ticket_id": "3",
                "customer_id": "C",
                "open_date": date(2020, 1, 1),
                "close_date": date(2020, 1, 4),
                "resolved": True,
                "issue_category": "slow_speed",
            },
            {
                "ticket_id": "4",
                "customer_id": "C",
                "open_date": date(2020, 1, 1),
                "close_date": date(2020, 1, 9),
                "resolved": False,
            },
        ),
        "billing_events": table(
            spark,
            "billing_events",
            {"billing_id": "1", "customer_id": "C", "payment_status": "late", "amount_charged_aud": 10.0},
            {"billing_id": "2", "customer_id": "C", "payment_status": None, "amount_charged_aud": 20.0},
            {"billing_id": "3", "customer_id": "stranger", "payment_status": "failed"},
        ),
    }
    dims = gold.dimensions(spark, silver)
    return {**dims, **gold.facts(silver, dims)}


def test_schemas(star):
    for name, ddl in GOLD_DDL.items():
        assert ", ".join(f"{c} {t}" for c, t in star[name].dtypes) == ddl, name


def test_calendar(spark, star):
    assert star["dimdate"].count() == 2557
    sunday = star["dimdate"].filter("date = '2020-01-05'").first()
    assert (sunday.day_of_week, sunday.is_weekend, sunday.date_key) == (1, True, 20200105)
    ends = calendar.calendar_head_tail(star["dimdate"], 2).collect()
    assert [(r.part, r.date_key) for r in ends] == [
        ("head", 20200101),
        ("head", 20200102),
        ("tail", 20261231),
        ("tail", 20261230),
    ]


def test_null_region_is_a_member_but_never_matches(star, rows_of):
    assert rows_of(star["dimregion"]) == [(1, None), (2, "Adelaide"), (3, "Perth")]
    assert rows_of(star["dimcustomer"].select("customer_key", "customer_id", "region_key")) == [
        (1, "A", None),
        (2, "B", 2),
        (3, "C", 3),
    ]


def test_unknown_members_and_dates(star, rows_of):
    telemetry = star["facttelemetry"].select("telemetry_id", "customer_key", "date_key")
    assert rows_of(telemetry) == [("1", 3, None), ("2", None, 20200105), ("3", 3, 20200105)]
    assert rows_of(star["facttickets"].select("ticket_id", "customer_key")) == [("3", 3), ("4", 3)]
    assert star["factbilling"].count() == 3


def test_features(star):
    df = features.churn_features(star)
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == FEATURES_DDL
    got = {r.customer_id: r for r in df.collect()}
    assert set(got) == {"A", "B", "C"}
    assert got["A"].ticket_count is got["A"].avg_peak_latency_ms is got["A"].billing_cycles is None
    assert got["C"].region == "Perth"
    assert (got["C"].outage_days, got["C"].sla_breach_days) == (1, 1)
    assert (got["C"].ticket_count, got["C"].ticket_resolved_rate) == (2, 0.5)
    assert got["C"].avg_resolution_days == 3.0  # the unresolved ticket has none
    assert (got["C"].late_rate, got["C"].failed_rate, got["C"].avg_amount_charged) == (0.5, 0.0, 15.0)


def test_keys_are_dense(star):
    keys = [r.customer_key for r in star["dimcustomer"].collect()]
    assert sorted(keys) == list(range(1, len(keys) + 1))
