"""Cleaning rules on hand-made raw rows."""

from datetime import date

import pytest

from telcolake.plans import silver
from telcolake.sources.schemas import CUSTOMERS, NETWORK_TELEMETRY, SUPPORT_TICKETS
from telcolake.sources.tables import ingest_csv_to_bronze, read_bronze_table, read_quarantine


def raw(spark, table, *rows):
    full = [tuple(row.get(c) for c in table.columns) for row in rows]
    return spark.createDataFrame(full, table.bronze_ddl)


def test_survivor_without_customer_removes_the_key(spark):
    # NULL customer sorts first, so it survives the dedupe and is then dropped.
    df = raw(
        spark,
        NETWORK_TELEMETRY,
        {"telemetry_id": "1", "customer_id": None},
        {"telemetry_id": "1", "customer_id": "A"},
        {"telemetry_id": "2", "customer_id": "B", "date": "2024-01-02"},
        {"telemetry_id": "2", "customer_id": "B", "date": "2024-01-01"},
    )
    got = silver.silver_telemetry(df).select("telemetry_id", "customer_id", "date").collect()
    assert [tuple(r) for r in got] == [("2", "B", date(2024, 1, 1))]


def test_null_keys_fold_to_one_row(spark):
    df = raw(
        spark,
        SUPPORT_TICKETS,
        {"ticket_id": None, "customer_id": "B"},
        {"ticket_id": None, "customer_id": "A"},
    )
    assert [r.customer_id for r in silver.silver_tickets(df).collect()] == ["A"]


def test_bad_text_becomes_null(spark):
    df = raw(
        spark,
        CUSTOMERS,
        {
            "customer_id": "A",
            "monthly_charge_aud": "",
            "tenure_months": "many",
            "churn_flag": "",
            "churn_date": "",
            "onboarded_date": "2020-13-01",
            "has_voip_addon": "True",
        },
    )
    row = silver.silver_customers(df).first()
    assert row.monthly_charge_aud is row.tenure_months is row.churn_flag is row.churn_date is row.onboarded_date is None
    assert row.has_voip_addon is True


def test_integer_text_with_fraction_survives(spark):
    df = raw(
        spark,
        SUPPORT_TICKETS,
        {"ticket_id": "1", "customer_id": "A", "satisfaction_score": "3.0"},
        {"ticket_id": "2", "customer_id": "A", "satisfaction_score": "1e99"},
    )
    got = {r.ticket_id: r.satisfaction_score for r in silver.silver_tickets(df).collect()}
    assert got == {"1": 3, "2": None}


def test_types(spark):
    df = silver.silver_customers(raw(spark, CUSTOMERS, {"customer_id": "A"}))
    assert ", ".join(f"{c} {t}" for c, t in df.dtypes) == CUSTOMERS.silver_ddl


def test_csv_with_quotes_commas_and_empty_cells(spark, tmp_path):
    columns = SUPPORT_TICKETS.columns
    cells = ['"said ""slow"", twice"', '"a, b"', "", *[f"v{i}" for i in range(3, len(columns))]]
    source = tmp_path / "tickets.csv"
    source.write_text(",".join(columns) + "\n" + ",".join(cells) + "\n")
    ingest_csv_to_bronze(spark, str(source), "support_tickets", str(tmp_path / "bronze"))
    row = read_bronze_table(spark, str(tmp_path / "bronze"), "support_tickets").first()
    assert list(row) == ['said "slow", twice', "a, b", None, *cells[3:]]


def test_short_csv_row_is_reported(spark, tmp_path):
    columns = SUPPORT_TICKETS.columns
    source = tmp_path / "tickets.csv"
    source.write_text(",".join(columns) + "\nonly,two\n")
    counts = ingest_csv_to_bronze(spark, str(source), "support_tickets", str(tmp_path / "bronze"))
    assert (counts.good, counts.quarantined) == (0, 1)
    assert [r.reason for r in read_quarantine(spark, str(tmp_path / "bronze"), "support_tickets").collect()] == ["too few cells"]
