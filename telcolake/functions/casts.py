"""Casts from raw text that yield NULL on bad input.

Spark 4 runs in ANSI mode, where a plain cast of '' raises. Raw files are full of
empty cells, so every cast out of the raw layer goes through these helpers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def as_date(name: str) -> Column:
    return F.col(name).try_cast("date")


def as_boolean(name: str) -> Column:
    return F.col(name).try_cast("boolean")


def as_double(name: str) -> Column:
    return F.col(name).try_cast("double")


def as_integer(name: str) -> Column:
    # Integer columns with gaps are exported as '3.0', which does not cast to int
    # directly under ANSI rules; the detour over double keeps such values.
    return F.col(name).try_cast("double").try_cast("int")
