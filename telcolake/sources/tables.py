"""Readers, writers and catalog inventories."""

from __future__ import annotations

from collections.abc import Iterable, Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from telcolake.sources import versions
from telcolake.sources.schemas import FEATURES_DDL, GOLD_DDL, SCORES_DDL, SOURCES, SourceTable
from telcolake.sources.together import together

# Catalog schema names of the analytics and scoring tables.
GOLD_SCHEMA = "isp_gold"
ML_SCHEMA = "isp_ml"

# Facts are partitioned by the month of these date roles, so date slicers open only the
# files of their months.
FACT_DAY = {
    "facttelemetry": "date_key",
    "factbilling": "billing_month_key",
    "facttickets": "open_date_key",
}
# The partition column of facts: year and month of the date role as yyyymm, NULL without date.
MONTH = "fact_month"


@dataclass(frozen=True)
class IngestCounts:
    """Rows of a file set that went on, and that were set aside."""

    good: int
    quarantined: int


def ingest_csv_to_bronze(
    spark: SparkSession, csv_path: str, name: str, bronze_path: str, multi_line: bool = False
) -> IngestCounts:
    """Copy a CSV file set with header to raw Parquet; every column stays text.

    Quotes inside a cell are doubled. A row with too few or too many cells is set aside, as it
    stands, with its file and the reason; good rows go on. Both are written in one pass over
    the files, to a partition each, which ``read_bronze`` and ``read_quarantine`` pick. A header
    other than the columns stops the job. ``multi_line`` allows line breaks inside quoted
    cells, at the cost of reading each file in one task.
    """
    source = SOURCES[name]
    # enforceSchema=False makes Spark check the header of every file against the schema.
    raw = (
        spark.read.option("header", True)
        .option("enforceSchema", False)
        .option("escape", '"')
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_record")
        .option("multiLine", multi_line)
        .schema(f"{source.bronze_ddl}, _record string")
        .csv(csv_path)
    )
    bad = F.col("_record").isNotNull()
    # Cells of a record: separators outside quotes, and one.
    cells = F.length(F.regexp_replace(F.regexp_replace("_record", '"([^"]|"")*"', ""), "[^,]", "")) + 1
    n = len(source.columns)
    reason = F.when(cells < n, "too few cells").when(cells > n, "too many cells").otherwise("not readable")
    marked = raw.select(
        *source.columns,
        F.col("_record"),
        F.when(bad, F.input_file_name()).alias("_file"),
        F.when(bad, reason).alias("_reason"),
        bad.alias(QUARANTINED),
    )
    marked.write.mode("overwrite").partitionBy(QUARANTINED).parquet(bronze_path)
    # Counted from the files' own row counts.
    counts = {r[QUARANTINED]: r["count"] for r in _read_raw(spark, bronze_path, source).groupBy(QUARANTINED).count().collect()}
    return IngestCounts(counts.get(False, 0), counts.get(True, 0))


# Partition of raw rows that were set aside.
QUARANTINED = "quarantined"


def _read_raw(spark: SparkSession, path: str, source: SourceTable) -> DataFrame:
    ddl = f"{source.bronze_ddl}, _record string, _file string, _reason string, {QUARANTINED} boolean"
    return spark.read.schema(ddl).parquet(path)


def read_bronze_table(spark: SparkSession, path: str, name: str) -> DataFrame:
    """The good rows of one raw table; a table written without quarantine has only such rows."""
    raw = _read_raw(spark, path, SOURCES[name])
    return raw.filter(F.col(QUARANTINED).isNull() | ~F.col(QUARANTINED)).select(*SOURCES[name].columns)


def read_quarantine(spark: SparkSession, path: str, name: str) -> DataFrame:
    """Rows of a raw table that were set aside: their file, the record as it stands, the reason, and the key if it was read."""
    aside = _read_raw(spark, path, SOURCES[name]).filter(F.col(QUARANTINED))
    return aside.select(F.col("_file").alias("file"), F.col("_record").alias("record"), F.col("_reason").alias("reason"), F.col(SOURCES[name].key).alias("key"))


def read_bronze(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {name: read_bronze_table(spark, f"{root}/{name}", name) for name in SOURCES}


def read_silver(spark: SparkSession, root: str) -> dict[str, DataFrame]:
    return {n: spark.read.schema(t.silver_ddl).parquet(f"{root}/{n}") for n, t in SOURCES.items()}


def write_silver(silver: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    _save_all(silver, root, fmt)


def register_views(silver: Mapping[str, DataFrame]) -> list[str]:
    """Name the Silver tables for ``spark.sql``."""
    for name, df in silver.items():
        df.createOrReplaceTempView(name)
    return list(silver)


def read_gold(
    spark: SparkSession, root: str, names: Iterable[str] = GOLD_DDL, fmt: str = "parquet"
) -> dict[str, DataFrame]:
    """The current version of the Gold tables below ``root``; facts carry their partition column ``MONTH``."""
    at = versions.current(spark, root)
    return {name: _read(spark, f"{at}/{name}", _stored_ddl(name), fmt) for name in names}


def read_gold_tables(spark: SparkSession, schema: str = GOLD_SCHEMA) -> dict[str, DataFrame]:
    return {name: spark.table(f"{schema}.{name}") for name in GOLD_DDL}


def write_gold_paths(gold: Mapping[str, DataFrame], root: str, fmt: str = "parquet") -> None:
    _save_all({name: by_month(name, df) for name, df in gold.items()}, root, fmt)


def publish_gold(
    spark: SparkSession, root: str, schema: str = GOLD_SCHEMA, fmt: str = "parquet", location: str | None = None
) -> None:
    """Point the catalog's Gold tables at the current version below ``root``; nothing is copied."""
    at = versions.current(spark, root)
    _create_schema(spark, schema, location)
    parted = {name: (MONTH,) for name in FACT_DAY}
    entries = {name: versions.Entry(f"{at}/{name}", _stored_ddl(name), parted.get(name, ())) for name in GOLD_DDL}
    versions.publish_tables(spark, schema, entries, fmt)


def by_month(name: str, df: DataFrame) -> DataFrame:
    """A fact laid out for its table; other tables as they are.

    A month's rows of one customer go to one file, so that sums per customer shrink where
    they are read. Partitions are rebalanced: a customer, or rows without one, that fill more
    than a file are split over several, small months share a task.
    """
    if name not in FACT_DAY:
        return df
    day = FACT_DAY[name]
    dated = df.drop(MONTH).withColumn(MONTH, F.floor(F.col(day) / 100).cast("int"))
    return dated.hint("rebalance", MONTH, "customer_key").sortWithinPartitions(MONTH, "customer_key", day)


def in_days(fact: DataFrame, day: str, low: int, high: int) -> DataFrame:
    """Rows of a fact whose date key ``day`` is from ``low`` to ``high``; other months' files are not opened."""
    kept = fact.filter(F.col(day).between(low, high))
    if MONTH in fact.columns and day in FACT_DAY.values():
        kept = kept.filter(F.col(MONTH).between(low // 100, high // 100))
    return kept


def write_gold_tables(
    gold: Mapping[str, DataFrame],
    schema: str = GOLD_SCHEMA,
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Create the catalog schema and overwrite one managed table per Gold table."""
    spark = next(iter(gold.values())).sparkSession
    _create_schema(spark, schema, location)

    def save(name: str):
        return lambda: _writer(name, by_month(name, gold[name]), fmt).saveAsTable(f"{schema}.{name}")

    together({name: save(name) for name in gold})


def write_features(features: DataFrame, path: str, fmt: str = "parquet") -> None:
    features.write.format(fmt).mode("overwrite").save(path)


def read_features(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, path, FEATURES_DDL, fmt)


def write_scores(
    scores: DataFrame,
    path: str,
    schema: str = ML_SCHEMA,
    fmt: str = "parquet",
    location: str | None = None,
) -> None:
    """Publish a new version of the scores below ``path``, and as the table ``<schema>.churn_scores`` over its files."""
    spark = scores.sparkSession
    version = versions.new_version(path)
    scores.write.format(fmt).save(version)
    versions.publish(spark, version)
    _create_schema(spark, schema, location)
    versions.publish_tables(spark, schema, {"churn_scores": versions.Entry(version, SCORES_DDL)}, fmt)


def read_scores(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return _read(spark, versions.current(spark, path), SCORES_DDL, fmt)


def _catalog_tables(spark: SparkSession, schemas: Iterable[str]) -> list:
    return [(schema, t) for schema in schemas for t in spark.catalog.listTables(schema) if not t.isTemporary]


def table_inventory(spark: SparkSession, schemas: Iterable[str]) -> DataFrame:
    """One row per catalog table of the given schemas, with the number of its rows."""
    catalog = spark.catalog.currentCatalog()
    found = _catalog_tables(spark, schemas)
    listed = spark.createDataFrame(
        [(catalog, schema, t.name.lower(), t.tableType, "YES", t.description) for schema, t in found],
        "table_catalog string, table_schema string, table_name string, table_type string, "
        "is_insertable_into string, comment string",
    )
    if not found:
        return listed.withColumn("row_count", F.lit(0).cast("long"))
    counts = [
        spark.table(f"{schema}.{t.name}")
        .agg(F.count("*").alias("row_count"))
        .select(F.lit(schema).alias("table_schema"), F.lit(t.name.lower()).alias("table_name"), "row_count")
        for schema, t in found
    ]
    return listed.join(reduce(DataFrame.unionByName, counts), ["table_schema", "table_name"]).select(*listed.columns, "row_count")


def column_inventory(spark: SparkSession, schemas: Iterable[str]) -> DataFrame:
    """One row per column of every catalog table of the given schemas, with its profile.

    Partition columns, which only lay files out, are left out.
    """
    found = _catalog_tables(spark, schemas)
    rows = [
        (schema, t.name.lower(), position, c.name, c.dataType.upper(), "YES" if c.nullable else "NO", c.description)
        for schema, t in found
        for position, c in enumerate(c for c in spark.catalog.listColumns(f"{schema}.{t.name}") if not c.isPartition)
    ]
    listed = spark.createDataFrame(
        rows,
        "table_schema string, table_name string, ordinal_position int, column_name string, "
        "data_type string, is_nullable string, comment string",
    )
    if not found:
        return listed.withColumns({c: F.lit(None).cast(k) for c, k in PROFILE.items()})
    profiles = [
        column_profile(spark.table(f"{schema}.{t.name}")).withColumns(
            {"table_schema": F.lit(schema), "table_name": F.lit(t.name.lower())}
        )
        for schema, t in found
    ]
    key = ["table_schema", "table_name", "column_name"]
    joined = listed.join(reduce(DataFrame.unionByName, profiles), key)
    return joined.select(*listed.columns, *PROFILE)


PROFILE = {
    "row_count": "bigint",
    "null_count": "bigint",
    "least": "string",
    "greatest": "string",
    "distinct_estimate": "bigint",
}
# Size of the distinct-count sketches: 2^12 registers, a standard error of 1.6 %.
SKETCH_BITS = 12


def column_profile(df: DataFrame) -> DataFrame:
    """Rows, NULLs, least and greatest value as text, and a distinct estimate of each column.

    One pass over the table. Distinct values go through sketches of fixed size, which are
    merged; no set of values meets anywhere. Doubles are written with six digits.
    """

    def text(value: Column, kind: str) -> Column:
        return (value.cast("decimal(38,6)") if kind == "double" else value).cast("string")

    def numbered(i: int, name: str, kind: str) -> list[Column]:
        column = F.col(f"`{name}`")
        return [
            F.count(column).alias(f"known_{i}"),
            text(F.min(column), kind).alias(f"least_{i}"),
            text(F.max(column), kind).alias(f"greatest_{i}"),
            # The sketch passes over empty strings, so each value gets a mark before it.
            F.hll_sketch_estimate(F.hll_sketch_agg(F.concat(F.lit("="), column.cast("string")), SKETCH_BITS)).alias(f"distinct_{i}"),
        ]

    measured = df.agg(F.count("*").alias("rows"), *[m for i, (n, k) in enumerate(df.dtypes) for m in numbered(i, n, k)])
    cells = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col("rows").alias("row_count"),
            (F.col("rows") - F.col(f"known_{i}")).alias("null_count"),
            F.col(f"least_{i}").alias("least"),
            F.col(f"greatest_{i}").alias("greatest"),
            F.coalesce(F.col(f"distinct_{i}"), F.lit(0)).cast("long").alias("distinct_estimate"),
        )
        for i, name in enumerate(df.columns)
    ]
    return measured.select(F.explode(F.array(*cells)).alias("c")).select("c.*")


def contents(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Per table its name, rows and a checksum of all values, whatever the order of its rows.

    Doubles count with six digits; a table's partition column is left out.
    """

    def text(name: str, kind: str) -> Column:
        value = F.col(name).cast("decimal(38,6)") if kind == "double" else F.col(name)
        return F.coalesce(value.cast("string"), F.lit("-"))

    def one(name: str, df: DataFrame) -> DataFrame:
        row = F.concat_ws("|", *[text(c, k) for c, k in df.dtypes if c != MONTH])
        number = F.conv(F.substring(F.md5(row.cast("binary")), 1, 12), 16, 10).cast("decimal(38,0)")
        sums = df.agg(F.count("*").alias("row_count"), F.coalesce(F.sum(number), F.lit(0)).alias("checksum"))
        # 48-bit digests pass a long's range after some 65000 rows: the exact sum wraps modulo 2^64.
        half, whole = F.lit(str(2**63)).cast("decimal(38,0)"), F.lit(str(2**64)).cast("decimal(38,0)")
        wrapped = F.pmod(F.col("checksum") + half, whole) - half
        return sums.select(F.lit(name).alias("table_name"), "row_count", wrapped.cast("long").alias("checksum"))

    return reduce(DataFrame.unionByName, [one(name, df) for name, df in tables.items()])


def _read(spark: SparkSession, path: str, ddl: str, fmt: str) -> DataFrame:
    reader = spark.read.format(fmt)
    # Table formats such as Delta carry their own schema.
    return (reader.schema(ddl) if fmt == "parquet" else reader).load(path)


def _stored_ddl(name: str) -> str:
    return GOLD_DDL[name] + (f", {MONTH} int" if name in FACT_DAY else "")


def _writer(name: str, df: DataFrame, fmt: str) -> DataFrameWriter:
    writer = df.write.format(fmt).mode("overwrite")
    return writer.partitionBy(MONTH) if name in FACT_DAY else writer


def _save_all(frames: Mapping[str, DataFrame], root: str, fmt: str) -> None:
    def save(name: str):
        return lambda: _writer(name, frames[name], fmt).save(f"{root}/{name}")

    together({name: save(name) for name in frames})


def _create_schema(spark: SparkSession, schema: str, location: str | None) -> None:
    at = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE SCHEMA IF NOT EXISTS {schema}{at}")

