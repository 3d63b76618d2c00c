"""Cleaning: one row per key, a known customer, typed columns."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame

from telcolake.functions.casts import as_boolean, as_date, as_double, as_integer
from telcolake.operators.dedupe import dedupe_by_key, drop_null_key
from telcolake.sources.schemas import (
    BILLING_EVENTS,
    CUSTOMERS,
    NETWORK_TELEMETRY,
    SUPPORT_TICKETS,
    SourceTable,
)


def parse_dates(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: as_date(c) for c in columns})


def cast_boolean(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: as_boolean(c) for c in columns})


def cast_double(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: as_double(c) for c in columns})


def cast_integer(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    return df.withColumns({c: as_integer(c) for c in columns})


def clean(bronze: DataFrame, table: SourceTable) -> DataFrame:
    """Dedupe, then drop rows without customer, then type.

    The order matters: when the surviving row of a key has no customer, the key is gone.
    """
    df = drop_null_key(dedupe_by_key(bronze.select(*table.columns), table.key))
    df = parse_dates(df, table.dates)
    df = cast_boolean(df, table.booleans)
    df = cast_double(df, table.doubles)
    return cast_integer(df, table.integers)


def silver_customers(bronze: DataFrame) -> DataFrame:
    return clean(bronze, CUSTOMERS)


def silver_telemetry(bronze: DataFrame) -> DataFrame:
    return clean(bronze, NETWORK_TELEMETRY)


def silver_tickets(bronze: DataFrame) -> DataFrame:
    return clean(bronze, SUPPORT_TICKETS)


def silver_billing(bronze: DataFrame) -> DataFrame:
    return clean(bronze, BILLING_EVENTS)


def silver_tables(bronze: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    return {
        "customers": silver_customers(bronze["customers"]),
        "network_telemetry": silver_telemetry(bronze["network_telemetry"]),
        "support_tickets": silver_tickets(bronze["support_tickets"]),
        "billing_events": silver_billing(bronze["billing_events"]),
    }
