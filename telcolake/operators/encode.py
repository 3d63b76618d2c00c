"""Model matrix columns: dummies, median imputation, unique column names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import OneHotEncoder
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telcolake.operators.keys import surrogate_key
from telcolake.sources.together import together


def categories(df: DataFrame, columns: Sequence[str]) -> dict[str, list[str]]:
    """Sorted distinct values of low-cardinality columns, NULL excluded, in one pass.

    Values are made distinct over all tasks; the driver gets one row per value, since each
    becomes a column. Columns of many values go through ``category_dictionaries``.
    """
    cells = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in columns]))
    found = df.select(cells.alias("cell")).select("cell.*").filter("value is not null").distinct()
    levels: dict[str, list[str]] = {c: [] for c in columns}
    for row in found.collect():
        levels[row["column"]].append(row["value"])
    return {c: sorted(values) for c, values in levels.items()}


def category_dictionaries(df: DataFrame, columns: Sequence[str]) -> dict[str, DataFrame]:
    """Per column (value, index): its distinct values numbered from 0 in their order, NULL excluded.

    Numbered over range partitions; no set of values meets in a task or on the driver.
    """

    def numbered(column: str) -> DataFrame:
        values = df.select(F.col(column).alias("value")).filter("value is not null").distinct()
        return surrogate_key(values, ["value"], "index", "bigint").select("value", (F.col("index") - 1).alias("index"))

    return together({c: lambda c=c: numbered(c) for c in columns})


def one_hot_vectors(df: DataFrame, dictionaries: Mapping[str, DataFrame]) -> DataFrame:
    """Add a sparse vector ``<column>_vector`` per dictionary: a place per value but the first.

    NULL, the first value and values outside the dictionary are the zero vector. A column
    with fewer than two values has no vector. Dictionaries are joined without hint, so large
    ones are not broadcast.
    """
    sizes = together({c: d.count for c, d in dictionaries.items()})
    kept = df.columns
    for column, values in dictionaries.items():
        n = sizes[column] - 1
        if n < 1:
            continue
        # The place after the last stands for "no value": the encoder drops it.
        place = F.when(F.col("index") > 0, F.col("index") - 1).otherwise(n)
        known = values.select(F.col("value").alias("_value"), place.cast("double").alias("_place"))
        df = df.join(known, F.col(column) == F.col("_value"), "left").withColumn("_place", F.coalesce("_place", F.lit(float(n)))).drop("_value")
        encoder = OneHotEncoder(inputCol="_place", outputCol=f"{column}_vector", dropLast=True, handleInvalid="keep")
        # The encoder learns its width from the greatest place.
        df = encoder.fit(df.sparkSession.createDataFrame([(float(n - 1),)], "_place double")).transform(df).drop("_place")
    return df.select(*kept, *[f"{c}_vector" for c in dictionaries if sizes[c] > 1])


def one_hot_drop_first(
    df: DataFrame, columns: Sequence[str], levels: Mapping[str, Sequence[str]] | None = None
) -> DataFrame:
    """Replace each column by 0/1 columns ``<column>_<value>``, without the first value.

    NULL and values outside ``levels`` yield zeros only.
    """
    levels = levels or categories(df, columns)
    dummies = [
        F.when(F.col(c) == value, 1).otherwise(0).alias(f"{c}_{value}")
        for c in columns
        for value in levels[c][1:]
    ]
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, *dummies)


def medians(df: DataFrame, columns: Sequence[str], accuracy: int = 10_000) -> dict[str, float | None]:
    """Exact medians (mean of the two middle values) of many columns.

    An exact percentile aggregate would gather every distinct value of a column in one
    task. Here a sketch brackets the median first, then one pass counts what lies below
    the bracket and only values inside it, about 4/accuracy of the rows, are put in order.
    """
    found: dict[str, float | None] = {}
    missing = list(columns)
    slack = 2.0 / accuracy
    while missing:
        low, high = max(0.0, 0.5 - slack), min(1.0, 0.5 + slack)
        probes = F.array(F.lit(low), F.lit(high))
        sketch = df.agg(
            *[F.percentile_approx(F.col(c).cast("double"), probes, accuracy).alias(c) for c in missing]
        ).first()
        found |= {c: None for c in missing if sketch[c] is None}  # no value at all
        brackets = {c: tuple(sketch[c]) for c in missing if sketch[c] is not None}
        if brackets:
            found |= _bracketed_medians(df, brackets)
        missing = [c for c in missing if c not in found]
        slack *= 4  # the sketch keeps its error bound, so this is not expected to happen
    return {c: found[c] for c in columns}


def _bracketed_medians(
    df: DataFrame, brackets: Mapping[str, tuple[float, float]]
) -> dict[str, float]:
    """Medians of those columns whose middle values lie inside their bracket."""
    names = list(brackets)
    values = {c: F.col(c).cast("double") for c in names}
    tallies = df.agg(
        *[F.count(c).alias(f"n_{i}") for i, c in enumerate(names)],
        *[F.count_if(values[c] < brackets[c][0]).alias(f"below_{i}") for i, c in enumerate(names)],
    ).first()

    inside = F.array(
        *[
            F.struct(F.lit(i).alias("id"), F.when(values[c].between(*brackets[c]), values[c]).alias("value"))
            for i, c in enumerate(names)
        ]
    )
    counted = (
        df.select(F.explode(inside).alias("cell"))
        .select("cell.id", "cell.value")
        .filter(F.col("value").isNotNull())
        .groupBy("id", "value")
        .agg(F.count("*").alias("copies"))
    )
    upto = Window.partitionBy("id").orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    middle = F.array(
        *[
            F.array(F.lit((tallies[f"n_{i}"] - 1) // 2), F.lit(tallies[f"n_{i}"] // 2))
            for i in range(len(names))
        ]
    )
    below = F.array(*[F.lit(tallies[f"below_{i}"]) for i in range(len(names))])
    last = F.get(below, F.col("id")) + F.sum("copies").over(upto)  # places of a value: first ... last - 1
    placed = counted.withColumn("last", last).withColumn("first", F.col("last") - F.col("copies"))
    wanted = F.get(middle, F.col("id"))

    def holds(place):
        return (F.col("first") <= wanted[place]) & (wanted[place] < F.col("last"))

    rows = (
        placed.groupBy("id")
        .agg(
            F.max(F.when(holds(0), F.col("value"))).alias("low"),
            F.max(F.when(holds(1), F.col("value"))).alias("high"),
        )
        .collect()  # one row per column
    )
    return {names[r["id"]]: (r["low"] + r["high"]) / 2 for r in rows if None not in (r["low"], r["high"])}


def median_impute(
    df: DataFrame,
    columns: Sequence[str],
    values: Mapping[str, float | None] | None = None,
    suffix: str = "",
) -> DataFrame:
    """NULL -> median of the column, as DOUBLE, into ``<column><suffix>``.

    ``values`` may bring medians fitted elsewhere, such as on a training part.
    """
    values = values or medians(df, columns)
    return df.withColumns(
        {f"{c}{suffix}": F.coalesce(F.col(c).cast("double"), F.lit(values[c]).cast("double")) for c in columns}
    )


def unique_columns(df: DataFrame) -> DataFrame:
    """Drop repeated column names, keeping the first occurrence."""
    names = df.columns
    positional = df.toDF(*[f"c{i}" for i in range(len(names))])
    first = {}
    for i, name in enumerate(names):
        first.setdefault(name.lower(), (i, name))
    return positional.select(*[F.col(f"c{i}").alias(name) for i, name in first.values()])
