"""Dense surrogate keys and the lookups that resolve them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telcolake.functions.dates import date_key
from telcolake.sources.shared import materialize

# monotonically_increasing_id() holds the partition above this bit, the row below it.
_ROW_BITS = 33


def surrogate_key(df: DataFrame, order_by: Sequence[str], name: str, kind: str = "int") -> DataFrame:
    """Number the rows 1..N in the order of ``order_by`` (NULL first), without a one-task sort.

    The rows are range-partitioned and sorted inside each partition; a row's number is
    its place in the partition plus the sizes of the partitions before it. Only those
    sizes, one row per partition, meet in a single task. Range bounds are sampled, so
    the numbered rows are written once before the sizes are taken: both sides of the
    final join see the same partitions even if executors are lost.

    ``order_by`` must be unique. Keys shift when members are added; ``extend_keys`` keeps
    them. ``kind`` is the key type: ``bigint`` for more than two billion members.
    """
    order = [F.col(c).asc_nulls_first() for c in order_by]
    ranged = materialize(
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumn("_place", F.monotonically_increasing_id())
    )
    placed = ranged.withColumn("_partition", F.shiftright("_place", _ROW_BITS)).withColumn(
        "_row", F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    )
    before = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("_partition")
        .agg(F.count("*").alias("_size"))
        .select("_partition", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    )
    key = (F.col("_offset") + F.col("_row") + 1).cast(kind).alias(name)
    # At most one row per shuffle partition is broadcast.
    return placed.join(F.broadcast(offsets), "_partition").select(key, *df.columns)


def extend_keys(known: DataFrame, df: DataFrame, members: Sequence[str], name: str) -> DataFrame:
    """The keys of earlier loads (``name``, ``members``) and, after the greatest of them, keys of new members.

    Members of ``df`` that ``known`` lacks are numbered in their order; NULL is a member like
    others, and repeated members count once. Keys never change and are never used again, so
    facts of earlier loads stay valid. Only the greatest key goes through the driver.
    """
    kind = known.schema[name].dataType.simpleString()
    earlier = known.select(*[F.col(c).alias(f"_{c}") for c in members])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in members])
    new = df.select(*members).distinct().join(earlier, same, "left_anti")
    greatest = known.agg(F.max(name)).first()[0] or 0
    numbered = surrogate_key(new, members, name, kind)
    return known.select(name, *members).unionByName(numbered.withColumn(name, (F.col(name) + greatest).cast(kind)))


def lookup_key(
    fact: DataFrame, dim: DataFrame, fact_col: str, dim_col: str, key: str, out: str | None = None
) -> DataFrame:
    """Left equi-join that adds the surrogate key of a dimension member to ``fact``.

    The join is not NULL-safe: a NULL natural key gets a NULL surrogate key. There is no
    hint: dimensions are read back from files, so Spark knows their size, broadcasts the
    small ones and sort-merges the large ones, splitting hot keys at run time.
    """
    members = dim.select(F.col(dim_col).alias("_member"), F.col(key).alias(out or key))
    return fact.join(members, F.col(fact_col) == F.col("_member"), "left").drop("_member")


def role_playing_date_keys(df: DataFrame, roles: Mapping[str, str], start: date, end: date) -> DataFrame:
    """Add a date key per role (``{date column: key column}``); NULL outside the calendar.

    The calendar holds every day from ``start`` to ``end``, so membership is a range test
    and no join is needed.
    """
    keys = {
        out: F.when(F.col(column).between(F.lit(start), F.lit(end)), date_key(column))
        for column, out in roles.items()
    }
    return df.withColumns(keys)
