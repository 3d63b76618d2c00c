"""Points in intervals, without spelling intervals out and without comparing all pairs.

Places are whole numbers (days, microseconds). The line is cut into bins of one width: an
interval is copied to the bins it meets, a point lies in one, so a match is an equi-join on
key and bin. Intervals are closed; without start or end they are open on that side, and are
matched by key alone, through one bound per key where only presence is asked for.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DAY = 86_400_000_000


def place(column: str, kind: str) -> Column:
    """Microseconds of a date or timestamp column of type ``kind``, without time zone where it has none."""
    if kind == "date":
        return F.unix_date(column).cast("long") * DAY
    if kind == "timestamp_ntz":
        return F.timestamp_diff("MICROSECOND", F.to_timestamp_ntz(F.lit("1970-01-01 00:00:00")), F.col(column))
    return F.unix_micros(column)


def _binned(intervals: DataFrame, width: int) -> DataFrame:
    """Closed intervals once per bin they meet, cut to it."""
    closed = intervals.filter("start <= end")
    bins = F.explode(F.sequence(F.floor(F.col("start") / width), F.floor(F.col("end") / width)))
    spread = closed.withColumn("_bin", bins)
    low, high = F.col("_bin") * width, (F.col("_bin") + 1) * width - 1
    return spread.withColumns({"_low": F.greatest("start", low), "_high": F.least("end", high)})


def in_intervals(points: DataFrame, intervals: DataFrame, at: str, keys: Sequence[str], width: int, name: str = "inside") -> DataFrame:
    """``points`` with the flag ``name``: whether ``at`` lies in an interval (keys, start, end) of the same keys.

    Overlapping intervals of a bin are united first, so a bin is one row of disjoint ranges
    and no point is repeated. A point without place, or with a NULL key, lies in none.
    """
    keys = list(keys)
    cut = _binned(intervals.select(*keys, "start", "end"), width)
    in_order = Window.partitionBy(*keys, "_bin").orderBy("_low", "_high")
    so_far = F.max("_high").over(in_order.rowsBetween(Window.unboundedPreceding, -1))
    starts = cut.withColumn("_new", F.when(F.col("_low") <= so_far, 0).otherwise(1))
    islands = starts.withColumn("_island", F.sum("_new").over(in_order.rowsBetween(Window.unboundedPreceding, 0)))
    united = islands.groupBy(*keys, "_bin", "_island").agg(F.min("_low").alias("low"), F.max("_high").alias("high"))
    of_bin = united.groupBy(*keys, "_bin").agg(F.collect_list(F.struct("low", "high")).alias("_ranges"))

    # Open intervals: of each key the earliest that never ends and the latest that never began.
    open_ = intervals.filter("start is null or end is null").groupBy(*keys).agg(
        F.min(F.when(F.col("end").isNull(), F.coalesce("start", F.lit(-(2**63))))).alias("_from"),
        F.max(F.when(F.col("start").isNull(), F.coalesce("end", F.lit(2**63 - 1)))).alias("_to"),
    )
    place_ = F.col(at)
    within = F.exists("_ranges", lambda r: (r["low"] <= place_) & (place_ <= r["high"]))
    inside = F.coalesce(within, F.lit(False)) | F.coalesce(place_ >= F.col("_from"), F.lit(False)) | F.coalesce(place_ <= F.col("_to"), F.lit(False))
    binned = points.withColumn("_bin", F.floor(place_ / width))
    joined = binned.join(of_bin, [*keys, "_bin"], "left").join(open_, keys, "left")
    return joined.select(*points.columns, inside.alias(name))


def interval_matches(points: DataFrame, intervals: DataFrame, at: str, keys: Sequence[str], width: int) -> DataFrame:
    """Every pair of a point and an interval that holds it; columns of both, keys once."""
    keys = list(keys)
    binned = points.withColumn("_bin", F.floor(F.col(at) / width))
    closed = _binned(intervals.filter("start is not null and end is not null"), width)
    near = binned.join(closed, [*keys, "_bin"]).filter(F.col(at).between(F.col("_low"), F.col("_high")))
    open_ = points.join(intervals.filter("start is null or end is null"), keys)
    held = F.coalesce(F.col(at) >= F.col("start"), F.lit(True)) & F.coalesce(F.col(at) <= F.col("end"), F.lit(True)) & F.col(at).isNotNull()
    columns = [*points.columns, *[c for c in intervals.columns if c not in keys]]
    return near.select(*columns).unionByName(open_.filter(held).select(*columns))
