"""Column expressions shared by the plans: safe casts, calendar keys and business rules."""

from telcolake.functions.casts import as_boolean, as_date, as_double, as_integer
from telcolake.functions.dates import date_key
from telcolake.functions.rules import sla_breached, tenure_bucket

__all__ = [
    "as_boolean",
    "as_date",
    "as_double",
    "as_integer",
    "date_key",
    "sla_breached",
    "tenure_bucket",
]
