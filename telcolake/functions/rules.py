"""Business rules that are expressions over the columns of one row."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket labels (with en dash) and their upper bounds in months.
TENURE_BUCKETS = (
    (6, "0–6 months"),
    (12, "7–12 months"),
    (24, "13–24 months"),
)
TENURE_BUCKET_REST = "24+ months"

# Latency limits in ms per plan and the packet loss limit in percent.
STRICT_LATENCY_PLANS = ("Business_VoIP", "Fibre", "Wholesale_Dark_Fibre")
STRICT_LATENCY_MS = 80
NORMAL_LATENCY_MS = 100
PACKET_LOSS_LIMIT_PCT = 3.0


def tenure_bucket(tenure_months: Column | str = "tenure_months") -> Column:
    """Tenure band of a customer; a missing tenure counts as 0 months."""
    months = F.coalesce(F.col(tenure_months) if isinstance(tenure_months, str) else tenure_months, F.lit(0))
    bucket = None
    for upper, label in TENURE_BUCKETS:
        bucket = F.when(months <= upper, label) if bucket is None else bucket.when(months <= upper, label)
    return bucket.otherwise(TENURE_BUCKET_REST)


def sla_breached(plan: Column, peak_latency_ms: Column, packet_loss_pct: Column) -> Column:
    limit = F.when(plan.isin(*STRICT_LATENCY_PLANS), STRICT_LATENCY_MS).otherwise(NORMAL_LATENCY_MS)
    return (peak_latency_ms > limit) | (packet_loss_pct > PACKET_LOSS_LIMIT_PCT)
