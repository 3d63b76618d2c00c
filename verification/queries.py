"""Every operator as a query on the supplied tables, with its expected result in SQL.

Means over values that binary fractions cannot hold (money, ratios of ratios) are
rounded to six digits on both sides: their last bits depend on the order of addition.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from dataclasses import replace
from datetime import date, datetime
from functools import reduce
from itertools import chain

from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telcolake.functions.dates import date_key
from telcolake.functions.rules import tenure_bucket
from telcolake.operators import dedupe, encode, intervals, keys, split
from telcolake.plans import build, calendar, checks, features, gold, model, silver, star, visuals
from telcolake.sources import tables
from telcolake.sources.schemas import FEATURES_DDL, GOLD_DDL, NETWORK_TELEMETRY, SCORES_DDL, SOURCES, SUPPORT_TICKETS, ddl_columns
from telcolake.sources.shared import fresh_path
from telcolake.sources.together import together
from verification.oracle import dedupe_sql, with_ctes
from verification.workspace import Workspace, workspace

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(workspace)`` under ``name``; without ``sql`` only rows are checked."""

    def register(fn: Callable[[Workspace], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(workspace(spark, sf_dir))
        if sql is not None:
            ORACLE[name] = with_ctes(sql)
        return fn

    return register


def rounded(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


# --- sources and sinks -------------------------------------------------------------


def contents_sql(prefix: str, tables_ddl: Mapping[str, str], names: Mapping[str, str] | None = None) -> str:
    """Rows and a checksum over all values of each table, as ``tables.contents`` gives them."""

    def text(column: str, kind: str) -> str:
        value = f"CAST({column} AS DECIMAL(38, 6))" if kind == "double" else column
        return f"coalesce(CAST({value} AS VARCHAR), '-')"

    def one(name: str, ddl: str) -> str:
        whole = " || '|' || ".join(text(c, k) for c, k in ddl_columns(ddl))
        return (
            f"SELECT '{(names or {}).get(name, name)}' AS table_name, count(*) AS row_count, "
            f"CAST(coalesce(sum(('0x' || substr(md5({whole}), 1, 12))::BIGINT), 0) AS BIGINT) AS checksum FROM {prefix}{name}"
        )

    return " UNION ALL ".join(one(n, ddl) for n, ddl in tables_ddl.items())


SILVER_DDL = {n: t.silver_ddl for n, t in SOURCES.items()}


def _unquoted(name: str) -> str:
    """A raw table as CSV brings it back: an empty cell is NULL."""
    return "(SELECT " + ", ".join(f"nullif({c}, '') AS {c}" for c in SOURCES[name].columns) + f" FROM bronze_{name})"


def _ingested(w: Workspace) -> dict[str, str]:
    """All four sets as CSV files with planted bad rows, ingested: the folder of each raw table."""

    def ingest(name: str, df: DataFrame):
        def job():
            landing, bronze = fresh_path(w.spark, "landing"), fresh_path(w.spark, "bronze")
            df.write.option("header", True).option("escape", '"').csv(landing)
            key = F.col(SOURCES[name].key)
            short = df.filter(key.endswith("7")).select(F.concat(key, F.lit(",cut")).alias("value"))
            commas = F.lit("," * len(df.columns))
            long = df.filter(key.endswith("3")).select(F.concat(key, F.lit(',"a, ""b"" c"'), commas).alias("value"))
            header = ",".join(df.columns)
            # A file per partition of bad rows, each with its header first: no task holds them all.
            lines = short.unionByName(long).rdd.mapPartitions(lambda rows: chain([(header,)], ((r.value,) for r in rows)))
            w.spark.createDataFrame(lines, "value string").write.mode("append").text(landing)
            counts = tables.ingest_csv_to_bronze(w.spark, landing, name, bronze)
            if (counts.good, counts.quarantined) != (df.count(), short.count() + long.count()):
                raise AssertionError(f"{name}: {counts}")
            return bronze

        return job

    return together({name: ingest(name, df) for name, df in w.bronze.items()})


@query(
    "ingest_csv_to_bronze",
    contents_sql("", {f"{_unquoted(n)} AS {n}": t.bronze_ddl for n, t in SOURCES.items()}, {f"{_unquoted(n)} AS {n}": n for n in SOURCES}),
)
def _(w):
    return tables.contents({name: tables.read_bronze_table(w.spark, at, name) for name, at in _ingested(w).items()})


@query(
    "quarantined_rows",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, '{reason}' AS reason, count(*) AS rows, min({t.key}) AS first_key, max({t.key}) AS last_key "
        f"FROM bronze_{n} WHERE ends_with({t.key}, '{digit}') HAVING count(*) > 0"
        for n, t in SOURCES.items()
        for digit, reason in (("7", "too few cells"), ("3", "too many cells"))
    ),
)
def _(w):
    parts = [
        tables.read_quarantine(w.spark, at, name)
        .groupBy(F.lit(name).alias("table_name"), "reason")
        .agg(F.count("*").alias("rows"), F.min("key").alias("first_key"), F.max("key").alias("last_key"))
        for name, at in _ingested(w).items()
    ]
    return reduce(DataFrame.unionByName, parts)


@query("read_bronze", contents_sql("bronze_", {n: t.bronze_ddl for n, t in SOURCES.items()}))
def _(w):
    root = fresh_path(w.spark, "bronze")
    for name, df in w.bronze.items():
        df.write.parquet(f"{root}/{name}")
    return tables.contents(tables.read_bronze(w.spark, root))


@query("write_silver", contents_sql("silver_", SILVER_DDL))
def _(w):
    root = fresh_path(w.spark, "silver")
    tables.write_silver(silver.silver_tables(w.bronze), root)
    return tables.contents(tables.read_silver(w.spark, root))


@query("read_silver", contents_sql("silver_", SILVER_DDL))
def _(w):
    _ = w.silver
    return tables.contents(tables.read_silver(w.spark, w.layout.silver))


@query(
    "register_views",
    "SELECT region, count(*) AS customers, min(onboarded_date) AS first_onboarded FROM silver_customers GROUP BY region",
)
def _(w):
    tables.register_views(w.silver)
    return w.spark.sql(
        "SELECT region, count(*) AS customers, min(onboarded_date) AS first_onboarded FROM customers GROUP BY region"
    )


@query("write_gold_paths", contents_sql("", GOLD_DDL))
def _(w):
    root = fresh_path(w.spark, "gold")
    dims = gold.dimensions(w.spark, w.silver)
    tables.write_gold_paths(dims, root)
    tables.write_gold_paths(gold.facts(w.silver, tables.read_gold(w.spark, root, dims)), root)
    return tables.contents(tables.read_gold(w.spark, root))


def _write_gold_tables(w: Workspace) -> str:
    tables.write_gold_tables(w.gold, location=f"{w.layout.root}/warehouse/{tables.GOLD_SCHEMA}")
    return tables.GOLD_SCHEMA


@query("write_gold_tables", contents_sql("", GOLD_DDL))
def _(w):
    return tables.contents(tables.read_gold_tables(w.spark, _write_gold_tables(w)))


@query("publish_gold", contents_sql("", GOLD_DDL))
def _(w):
    """The catalog's tables over the files of the second of two builds."""
    _ = w.gold
    schema = "published_" + w.layout.root.rsplit("-", 1)[1][:12]
    layout = replace(w.layout, gold_root=fresh_path(w.spark, "gold"))
    for _ in range(2):
        build.build_gold(w.spark, layout, schema=schema, location=f"{w.layout.root}/warehouse/{schema}")
    return tables.contents(tables.read_gold_tables(w.spark, schema))


@query("read_gold", contents_sql("", GOLD_DDL))
def _(w):
    _ = w.gold
    return tables.contents(tables.read_gold(w.spark, w.layout.gold))


# Means are kept to six digits where they are compared: their last bits depend on the order of addition.
@query("write_features", contents_sql("", {"churn_features": FEATURES_DDL}))
def _(w):
    path = fresh_path(w.spark, "features")
    tables.write_features(features.churn_features(w.gold), path)
    return tables.contents({"churn_features": tables.read_features(w.spark, path)})


@query(
    "read_features",
    "SELECT region, count(*) AS customers, CAST(sum(ticket_count) AS BIGINT) AS tickets FROM churn_features GROUP BY region",
)
def _(w):
    _ = w.features
    stored = tables.read_features(w.spark, w.layout.features)
    return stored.groupBy("region").agg(F.count("*").alias("customers"), F.sum("ticket_count").alias("tickets"))


def _published_scores(w: Workspace) -> str:
    """Scores that SQL can compute too, published as the scores table."""
    scored = _given_scores(w).withColumn("churn_flag", F.col("label"))
    scores = scored.select(*[F.col(c).cast(k).alias(c) for c, k in ddl_columns(SCORES_DDL)])
    tables.write_scores(scores, fresh_path(w.spark, "scores"), location=f"{w.layout.root}/warehouse/{tables.ML_SCHEMA}")
    return tables.ML_SCHEMA


@query("write_scores", contents_sql("", {"churn_scores": SCORES_DDL}))
def _(w):
    return tables.contents({"churn_scores": w.spark.table(f"{_published_scores(w)}.churn_scores")})


# The tables of the catalog by schema.
_LISTED = {**{n: (tables.GOLD_SCHEMA, "MANAGED", ddl) for n, ddl in GOLD_DDL.items()}, "churn_scores": (tables.ML_SCHEMA, "EXTERNAL", SCORES_DDL)}


@query(
    "table_inventory",
    " UNION ALL ".join(
        f"SELECT 'spark_catalog' AS table_catalog, '{schema}' AS table_schema, '{name}' AS table_name, '{kind}' AS table_type, "
        f"'YES' AS is_insertable_into, CAST(NULL AS VARCHAR) AS comment, count(*) AS row_count FROM {name}"
        for name, (schema, kind, _) in _LISTED.items()
    ),
)
def _(w):
    return tables.table_inventory(w.spark, [_write_gold_tables(w), _published_scores(w)])


def _profile_sql(name: str, position: int, column: str, kind: str) -> str:
    schema = _LISTED[name][0]
    value = "CAST({0}({1}) AS DECIMAL(38, 6))" if kind == "double" else "{0}({1})"
    least, greatest = (f"CAST({value.format(f, column)} AS VARCHAR)" for f in ("min", "max"))
    return (
        f"SELECT '{schema}' AS table_schema, '{name}' AS table_name, {position} AS ordinal_position, '{column}' AS column_name, "
        f"'{kind.upper()}' AS data_type, 'YES' AS is_nullable, CAST(NULL AS VARCHAR) AS comment, count(*) AS row_count, "
        f"count(*) - count({column}) AS null_count, {least} AS least, {greatest} AS greatest FROM {name}"
    )


_ALL_COLUMNS = [(n, i, c, k) for n, (_, _, ddl) in _LISTED.items() for i, (c, k) in enumerate(ddl_columns(ddl))]


@query("column_inventory", " UNION ALL ".join(_profile_sql(*c) for c in _ALL_COLUMNS))
def _(w):
    return tables.column_inventory(w.spark, [_write_gold_tables(w), _published_scores(w)]).drop("distinct_estimate")


@query(
    "distinct_estimates",
    " UNION ALL ".join(
        f"SELECT '{n}' AS table_name, '{c}' AS column_name, count(DISTINCT {c}) AS distinct_values, TRUE AS estimate_is_near FROM {n}"
        for n, _, c, _ in _ALL_COLUMNS
    ),
)
def _(w):
    """Distinct counts of all columns, and whether the sketches come within four standard errors."""
    frames = {**w.gold, "churn_scores": w.spark.table(f"{_published_scores(w)}.churn_scores")}
    parts = []
    for name, df in frames.items():
        df = df.drop(tables.MONTH)
        exact = df.agg(*[F.count_distinct(c).alias(c) for c in df.columns]).unpivot([], df.columns, "column_name", "distinct_values")
        both = exact.join(tables.column_profile(df), "column_name")
        error = F.abs(F.col("distinct_estimate") - F.col("distinct_values")) / F.greatest("distinct_values", F.lit(1))
        parts.append(both.select(F.lit(name).alias("table_name"), "column_name", "distinct_values", (error <= 0.065).alias("estimate_is_near")))
    return reduce(DataFrame.unionByName, parts)


# --- Silver cleaning ---------------------------------------------------------------


@query("dedupe_by_key", dedupe_sql("network_telemetry"))
def _(w):
    return dedupe.dedupe_by_key(w.bronze["network_telemetry"], NETWORK_TELEMETRY.key)


@query("drop_null_key", "SELECT * FROM bronze_support_tickets WHERE customer_id IS NOT NULL")
def _(w):
    return dedupe.drop_null_key(w.bronze["support_tickets"])


@query(
    "parse_dates",
    "SELECT ticket_id, TRY_CAST(open_date AS DATE) AS open_date, TRY_CAST(close_date AS DATE) AS close_date "
    "FROM bronze_support_tickets",
)
def _(w):
    dates = ["open_date", "close_date"]
    return silver.parse_dates(w.bronze["support_tickets"].select("ticket_id", *dates), dates)


@query(
    "cast_boolean",
    "SELECT customer_id, TRY_CAST(churn_flag AS BOOLEAN) AS churn_flag, "
    "TRY_CAST(has_voip_addon AS BOOLEAN) AS has_voip_addon FROM bronze_customers",
)
def _(w):
    flags = ["churn_flag", "has_voip_addon"]
    return silver.cast_boolean(w.bronze["customers"].select("customer_id", *flags), flags)


@query(
    "cast_double",
    "SELECT billing_id, TRY_CAST(amount_charged_aud AS DOUBLE) AS amount_charged_aud FROM bronze_billing_events",
)
def _(w):
    amount = ["amount_charged_aud"]
    return silver.cast_double(w.bronze["billing_events"].select("billing_id", *amount), amount)


@query(
    "cast_integer",
    "SELECT ticket_id, CAST(TRY_CAST(satisfaction_score AS DOUBLE) AS INTEGER) AS satisfaction_score "
    "FROM bronze_support_tickets",
)
def _(w):
    score = ["satisfaction_score"]
    return silver.cast_integer(w.bronze["support_tickets"].select("ticket_id", *score), score)


def _inline(parts: Mapping[str, tuple[str, str]]) -> str:
    """Contents of inline tables: name -> (SQL, DDL)."""
    ddl = {f"({sql}) AS t{i}": d for i, (sql, d) in enumerate(parts.values())}
    return contents_sql("", ddl, dict(zip(ddl, parts)))


_TYPINGS = {
    "date": ("dates", silver.parse_dates, "TRY_CAST({0} AS DATE)", "date"),
    "boolean": ("booleans", silver.cast_boolean, "TRY_CAST({0} AS BOOLEAN)", "boolean"),
    "double": ("doubles", silver.cast_double, "TRY_CAST({0} AS DOUBLE)", "double"),
    "integer": ("integers", silver.cast_integer, "CAST(trunc(TRY_CAST({0} AS DOUBLE)) AS INTEGER)", "int"),
}


def _typed_parts() -> dict[str, tuple[str, str]]:
    parts = {}
    for name, source in SOURCES.items():
        for kind, (columns, _, sql, ddl) in _TYPINGS.items():
            chosen = getattr(source, columns)
            if chosen:
                select = ", ".join(f"{sql.format(c)} AS {c}" for c in chosen)
                typed = ", ".join(f"{c} {ddl}" for c in chosen)
                parts[f"{name}.{kind}"] = (f"SELECT {source.key}, {select} FROM bronze_{name}", f"{source.key} string, {typed}")
    return parts


@query("typed_columns_of_all_tables", _inline(_typed_parts()))
def _(w):
    """Every date, flag, amount and number of the raw tables, typed."""
    frames = {}
    for name, source in SOURCES.items():
        for kind, (columns, cast, _, _) in _TYPINGS.items():
            chosen = list(getattr(source, columns))
            if chosen:
                frames[f"{name}.{kind}"] = cast(w.bronze[name].select(source.key, *chosen), chosen)
    return tables.contents(frames)


@query("dedupe_all_tables", _inline({n: (dedupe_sql(n), t.bronze_ddl) for n, t in SOURCES.items()}))
def _(w):
    """All raw tables, each with a part of its rows doubled and changed, one row per key."""
    frames = {}
    for name, source in SOURCES.items():
        last = source.columns[-1]
        # Changed copies sort after their originals.
        copies = w.bronze[name].filter(F.col(source.key).endswith("4")).withColumn(last, F.concat(F.coalesce(F.col(last), F.lit("")), F.lit("~")))
        frames[name] = dedupe.dedupe_by_key(w.bronze[name].unionByName(copies).unionByName(copies), source.key).select(*source.columns)
    return tables.contents(frames)


@query(
    "drop_null_key_of_all_tables",
    _inline({n: (f"SELECT * FROM bronze_{n} WHERE customer_id IS NOT NULL", t.bronze_ddl) for n, t in SOURCES.items()}),
)
def _(w):
    return tables.contents({name: dedupe.drop_null_key(df) for name, df in w.bronze.items()})


_DATES = {n: list(t.dates) for n, t in SOURCES.items()}


@query(
    "date_keys_of_all_columns",
    _inline(
        {
            n: (
                f"SELECT {SOURCES[n].key}, "
                + ", ".join(f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER) AS {c}_key" for c in dates)
                + f" FROM silver_{n}",
                f"{SOURCES[n].key} string, " + ", ".join(f"{c}_key int" for c in dates),
            )
            for n, dates in _DATES.items()
        }
    ),
)
def _(w):
    return tables.contents(
        {n: w.silver[n].select(SOURCES[n].key, *[date_key(c).alias(f"{c}_key") for c in dates]) for n, dates in _DATES.items()}
    )


@query("silver_customers", "SELECT * FROM silver_customers")
def _(w):
    return silver.silver_customers(w.bronze["customers"])


@query("silver_telemetry", "SELECT * FROM silver_network_telemetry")
def _(w):
    return silver.silver_telemetry(w.bronze["network_telemetry"])


@query("silver_tickets", "SELECT * FROM silver_support_tickets")
def _(w):
    return silver.silver_tickets(w.bronze["support_tickets"])


@query("silver_billing", "SELECT * FROM silver_billing_events")
def _(w):
    return silver.silver_billing(w.bronze["billing_events"])


# --- calendar ----------------------------------------------------------------------


@query("earliest_date", "SELECT min(low) AS earliest_date FROM date_bounds")
def _(w):
    return calendar.earliest_date(w.silver)


@query("latest_date", "SELECT max(high) AS latest_date FROM date_bounds")
def _(w):
    return calendar.latest_date(w.silver)


def _data_days(w: Workspace) -> DataFrame:
    return calendar.days_between(calendar.date_bounds(w.silver), "earliest_date", "latest_date")


@query("date_spine", "SELECT date FROM data_calendar")
def _(w):
    return _data_days(w)


@query(
    "date_key",
    "SELECT ticket_id, CAST(year(open_date) * 10000 + month(open_date) * 100 + day(open_date) AS INTEGER) AS date_key "
    "FROM silver_support_tickets",
)
def _(w):
    return w.silver["support_tickets"].select("ticket_id", date_key("open_date").alias("date_key"))


@query("dim_date", "SELECT * FROM data_calendar")
def _(w):
    return calendar.with_calendar_columns(_data_days(w))


@query(
    "calendar_head_tail",
    "SELECT *, 'head' AS part FROM (SELECT * FROM data_calendar ORDER BY date LIMIT 5) "
    "UNION ALL SELECT *, 'tail' AS part FROM (SELECT * FROM data_calendar ORDER BY date DESC LIMIT 5)",
)
def _(w):
    return calendar.calendar_head_tail(calendar.with_calendar_columns(_data_days(w)))


# --- dimensions and keys -----------------------------------------------------------


@query("distinct_members", "SELECT DISTINCT node_id FROM silver_network_telemetry")
def _(w):
    return dedupe.distinct_members(w.silver["network_telemetry"], "node_id")


@query(
    "surrogate_key",
    "SELECT row_number() OVER (ORDER BY telemetry_id) AS telemetry_key, telemetry_id "
    "FROM silver_network_telemetry",
)
def _(w):
    ids = w.silver["network_telemetry"].select("telemetry_id")
    return keys.surrogate_key(ids, ["telemetry_id"], "telemetry_key", kind="bigint")


_EARLIER = "coalesce(onboarded_date < DATE '2022-01-01', FALSE)"


@query(
    "dim_customer_second_load",
    f"""
SELECT customer_id, CAST(CASE WHEN old THEN row_number() OVER (PARTITION BY old ORDER BY customer_id)
  ELSE (SELECT count(*) FROM silver_customers WHERE {_EARLIER}) + row_number() OVER (PARTITION BY old ORDER BY customer_id) END AS INTEGER) AS customer_key,
  region, CAST(CASE WHEN known THEN first_key ELSE (SELECT count(*) FROM (SELECT DISTINCT region FROM silver_customers WHERE {_EARLIER})) + later_key END AS INTEGER) AS region_key
FROM (SELECT *, {_EARLIER} AS old FROM silver_customers) c JOIN (
  SELECT region AS r, known, row_number() OVER (PARTITION BY known ORDER BY region NULLS FIRST) AS first_key,
    row_number() OVER (PARTITION BY known ORDER BY region NULLS FIRST) AS later_key
  FROM (SELECT region, max(CASE WHEN {_EARLIER} THEN 1 ELSE 0 END) = 1 AS known FROM silver_customers GROUP BY region)
) r ON c.region IS NOT DISTINCT FROM r.r
""",
)
def _(w):
    """Keys after a second load: customers and regions of the first keep theirs."""
    customers = w.silver["customers"]
    first = {**w.silver, "customers": customers.filter(F.col("onboarded_date") < date(2022, 1, 1))}
    maps = {n: gold.key_map(first, n) for n in ("dimcustomer", "dimregion")}
    maps = {n: gold.key_map(w.silver, n, known) for n, known in maps.items()}
    keyed = keys.lookup_key(customers.select("customer_id", "region"), maps["dimcustomer"], "customer_id", "customer_id", "customer_key")
    regions = maps["dimregion"].withColumnRenamed("region", "_region")
    return keyed.join(regions, F.col("region").eqNullSafe(F.col("_region"))).drop("_region")


@query(
    "extend_keys",
    """
SELECT telemetry_id, CASE WHEN old THEN 0 ELSE (SELECT count(*) FROM silver_network_telemetry WHERE coalesce(date < DATE '2020-06-01', FALSE)) END
  + row_number() OVER (PARTITION BY old ORDER BY telemetry_id) AS telemetry_key
FROM (SELECT telemetry_id, coalesce(date < DATE '2020-06-01', FALSE) AS old FROM silver_network_telemetry)
""",
)
def _(w):
    rows = w.silver["network_telemetry"]
    first = rows.filter(F.col("date") < date(2020, 6, 1)).select("telemetry_id")
    known = keys.surrogate_key(first, ["telemetry_id"], "telemetry_key", kind="bigint")
    return keys.extend_keys(known, rows, ["telemetry_id"], "telemetry_key")


@query("dim_region", "SELECT * FROM dimregion")
def _(w):
    return gold.dim_region(w.silver["customers"])


@query("dim_issue_category", "SELECT * FROM dimissuecategory")
def _(w):
    return gold.dim_issue_category(w.silver["support_tickets"])


@query("dim_payment_status", "SELECT * FROM dimpaymentstatus")
def _(w):
    return gold.dim_payment_status(w.silver["billing_events"])


@query("dim_customer", "SELECT * FROM dimcustomer")
def _(w):
    return gold.dim_customer(w.silver["customers"], w.gold["dimregion"])


# --- facts -------------------------------------------------------------------------


@query(
    "lookup_key",
    "SELECT billing_id, payment_status, payment_status_key FROM silver_billing_events "
    "LEFT JOIN dimpaymentstatus USING (payment_status)",
)
def _(w):
    bills = w.silver["billing_events"].select("billing_id", "payment_status")
    return keys.lookup_key(
        bills, w.gold["dimpaymentstatus"], "payment_status", "payment_status", "payment_status_key"
    )


# Every key that facts and dimensions look up: Silver table, member column, dimension, key.
_LOOKUPS = [
    ("customers", "region", "dimregion", "region_key"),
    ("network_telemetry", "customer_id", "dimcustomer", "customer_key"),
    ("billing_events", "customer_id", "dimcustomer", "customer_key"),
    ("billing_events", "payment_status", "dimpaymentstatus", "payment_status_key"),
    ("support_tickets", "customer_id", "dimcustomer", "customer_key"),
    ("support_tickets", "issue_category", "dimissuecategory", "issue_category_key"),
]


@query(
    "all_key_lookups",
    _inline(
        {
            f"{t}.{key}": (
                f"SELECT f.{SOURCES[t].key}, d.{key} FROM silver_{t} f LEFT JOIN {dim} d ON f.{member} = d.{member}",
                f"{SOURCES[t].key} string, {key} int",
            )
            for t, member, dim, key in _LOOKUPS
        }
    ),
)
def _(w):
    return tables.contents(
        {
            f"{t}.{key}": keys.lookup_key(w.silver[t].select(SOURCES[t].key, *({member} - {SOURCES[t].key})), w.gold[dim], member, member, key).select(SOURCES[t].key, key)
            for t, member, dim, key in _LOOKUPS
        }
    )


@query(
    "role_playing_date_keys",
    "SELECT ticket_id, open_date, close_date, d1.date_key AS open_date_key, d2.date_key AS close_date_key "
    "FROM silver_support_tickets t LEFT JOIN dimdate d1 ON t.open_date = d1.date "
    "LEFT JOIN dimdate d2 ON t.close_date = d2.date",
)
def _(w):
    tickets = w.silver["support_tickets"].select("ticket_id", "open_date", "close_date")
    roles = {"open_date": "open_date_key", "close_date": "close_date_key"}
    return keys.role_playing_date_keys(tickets, roles, calendar.CALENDAR_START, calendar.CALENDAR_END)


@query("fact_telemetry", "SELECT * FROM facttelemetry")
def _(w):
    return gold.fact_telemetry(w.silver["network_telemetry"], w.gold["dimcustomer"])


@query("fact_billing", "SELECT * FROM factbilling")
def _(w):
    return gold.fact_billing(w.silver["billing_events"], w.gold["dimcustomer"], w.gold["dimpaymentstatus"])


@query("fact_tickets", "SELECT * FROM facttickets")
def _(w):
    return gold.fact_tickets(w.silver["support_tickets"], w.gold["dimcustomer"], w.gold["dimissuecategory"])


@query(
    "customer_region_check",
    "SELECT customer_id, region, region_key FROM silver_customers LEFT JOIN dimregion USING (region) "
    "ORDER BY customer_id LIMIT 5",
)
def _(w):
    return gold.customer_region_check(w.silver["customers"])


@query("telemetry_by_date_key_range", "SELECT * FROM facttelemetry WHERE date_key BETWEEN 20250101 AND 20251231")
def _(w):
    return gold.telemetry_by_date_key_range(w.gold["facttelemetry"], 20250101, 20251231)


@query(
    "scores_join_customer",
    "SELECT customer_id, s.churn_probability, c.customer_type, c.plan_type FROM given_scores s "
    "JOIN dimcustomer c USING (customer_id)",
)
def _(w):
    return gold.scores_join_customer(_given_scores(w), w.gold["dimcustomer"])


# --- features ----------------------------------------------------------------------


@query(
    "customer_base_features",
    "SELECT region_key, customer_key, customer_id, customer_type, plan_type, contract_type, monthly_charge_aud, "
    "tenure_months, has_cybersecurity_addon, has_voip_addon, churn_flag, churn_date, region FROM customer_labels",
)
def _(w):
    return features.customer_base_features(w.gold["dimcustomer"], w.gold["dimregion"])


@query("telemetry_features", "SELECT * FROM telemetry_features")
def _(w):
    return features.telemetry_features(w.gold["facttelemetry"])


@query("ticket_resolution_days", "SELECT * FROM ticket_days")
def _(w):
    return features.ticket_resolution_days(w.gold["facttickets"], w.gold["dimdate"])


@query("ticket_features", "SELECT * FROM ticket_features")
def _(w):
    return features.ticket_features(features.ticket_resolution_days(w.gold["facttickets"], w.gold["dimdate"]))


@query(
    "billing_status_join",
    "SELECT f.*, s.payment_status FROM factbilling f LEFT JOIN dimpaymentstatus s "
    "ON f.payment_status_key = s.payment_status_key",
)
def _(w):
    return features.billing_status_join(w.gold["factbilling"], w.gold["dimpaymentstatus"])


@query("billing_features", "SELECT * REPLACE (round(avg_amount_charged, 6) AS avg_amount_charged) FROM billing_features")
def _(w):
    joined = features.billing_status_join(w.gold["factbilling"], w.gold["dimpaymentstatus"])
    return rounded(features.billing_features(joined), "avg_amount_charged")


@query("churn_features", "SELECT * REPLACE (round(avg_amount_charged, 6) AS avg_amount_charged) FROM churn_features")
def _(w):
    return rounded(features.churn_features(w.gold), "avg_amount_charged")


# --- model -------------------------------------------------------------------------


@query(
    "label_rows",
    "SELECT * REPLACE (round(avg_amount_charged, 6) AS avg_amount_charged) FROM labelled",
)
def _(w):
    return rounded(model.label_rows(w.features), "avg_amount_charged")


@query(
    "bool_to_num",
    "SELECT customer_id, CAST(has_cybersecurity_addon AS INTEGER) AS has_cybersecurity_addon_num, "
    "CAST(has_voip_addon AS INTEGER) AS has_voip_addon_num FROM labelled",
)
def _(w):
    return model.bool_to_num(model.label_rows(w.features)).select(
        "customer_id", "has_cybersecurity_addon_num", "has_voip_addon_num"
    )


@query(
    "select_model_columns",
    "SELECT * REPLACE (round(avg_amount_charged, 6) AS avg_amount_charged) FROM model_columns",
)
def _(w):
    return rounded(model.model_columns(w.features), "avg_amount_charged")


# Categories of the test data in their order; the first of each column gets no dummy.
_LEVELS = {
    "customer_type": ["business", "residential", "wholesale"],
    "plan_type": ["Business_VoIP", "Fibre", "NBN100", "NBN1000", "NBN250", "NBN50", "Wholesale_Dark_Fibre"],
    "contract_type": ["1-year", "2-year", "month-to-month"],
    "region": ["AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"],
}


@query(
    "one_hot_drop_first",
    "SELECT customer_id, "
    + ", ".join(
        f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END AS \"{c}_{v}\"" for c, vs in _LEVELS.items() for v in vs[1:]
    )
    + " FROM labelled",
)
def _(w):
    rows = model.label_rows(w.features).select("customer_id", *model.CATEGORICAL)
    return encode.one_hot_drop_first(rows, model.CATEGORICAL)


@query(
    "one_hot_vectors",
    "SELECT customer_id, "
    + ", ".join(
        f"(SELECT count(DISTINCT {c}) - 1 FROM labelled) AS {c}_size, CASE WHEN {c} > (SELECT min({c}) FROM labelled) "
        f"THEN (SELECT count(DISTINCT d.{c}) FROM labelled d WHERE d.{c} < l.{c}) - 1 END AS {c}_place"
        for c in _LEVELS
    )
    + " FROM labelled l",
)
def _(w):
    """The size of each vector and the place of its one, if it has any."""
    rows = model.label_rows(w.features).select("customer_id", *model.CATEGORICAL)
    encoded = encode.one_hot_vectors(rows, encode.category_dictionaries(rows, model.CATEGORICAL))
    columns = []
    for c in model.CATEGORICAL:
        values = vector_to_array(f"{c}_vector")
        place = F.array_position(values, 1.0)
        columns += [F.size(values).cast("long").alias(f"{c}_size"), F.when(place > 0, place - 1).alias(f"{c}_place")]
    return encoded.select("customer_id", *columns)


@query(
    "median_impute",
    "SELECT m.customer_id, "
    + ", ".join(
        f"round(coalesce(CAST(m.{c} AS DOUBLE), (SELECT median(CAST({c} AS DOUBLE)) FROM model_columns)), 6) AS {c}"
        for c in model.NUMERIC
    )
    + " FROM model_columns m",
)
def _(w):
    rows = model.model_columns(w.features).select("customer_id", *model.NUMERIC)
    return rounded(encode.median_impute(rows, model.NUMERIC), *model.NUMERIC)


@query(
    "stratified_split",
    "SELECT customer_id, label, row_number() OVER (PARTITION BY label ORDER BY md5(customer_id || '42'), customer_id) "
    "<= (count(*) OVER (PARTITION BY label) + 4) // 5 AS is_test FROM labelled",
)
def _(w):
    return split.mark_test_rows(model.label_rows(w.features).select("customer_id", "label"))


# Inputs of the models: the numeric columns that have values, then a dummy per category but the first.
_INPUTS_SQL = (
    "SELECT CAST(row_number() OVER (ORDER BY place, value) - 1 AS INTEGER) AS input FROM ("
    + " UNION ALL ".join(
        f"SELECT {i} AS place, '' AS value FROM model_columns HAVING count({c}) > 0" for i, c in enumerate(model.NUMERIC)
    )
    + "".join(
        f" UNION ALL SELECT {100 + i}, {c} FROM (SELECT DISTINCT {c} FROM model_columns WHERE {c} IS NOT NULL) "
        f"WHERE {c} <> (SELECT min({c}) FROM model_columns)"
        for i, c in enumerate(model.CATEGORICAL)
    )
    + ")"
)


# A weight is right where the gradient of the convex objective is 0 beside the size of its terms.
@query("train_logistic", f"SELECT *, TRUE AS is_optimal FROM ({_INPUTS_SQL} UNION ALL SELECT -1)")
def _(w):
    found = model.optimality(w.trained("Logistic Regression"), w.train)
    return found.select("input", (F.abs("gradient") <= 1e-4 * F.col("scale")).alias("is_optimal"))


def _importances(w: Workspace, learner: str) -> DataFrame:
    """The learned importance of each input: a share, and all together 1; and what shuffling it costs."""
    values = w.trained(learner).featureImportances.toArray().tolist()
    learned = w.spark.createDataFrame(list(enumerate(values)), "input int, share double")
    whole = F.sum("share").over(Window.partitionBy())
    cost = model.permutation_importance(w.trained(learner), w.test).filter("input >= 0").select("input", "auc")
    checked = learned.join(cost, "input")
    return checked.select(
        "input",
        F.col("share").between(0, 1).alias("is_share"),
        (F.abs(whole - 1) < 1e-9).alias("shares_add_up"),
        F.col("auc").between(0, 1).alias("shuffled_auc_is_valid"),
    )


_IMPORTANCES_SQL = f"SELECT *, TRUE AS is_share, TRUE AS shares_add_up, TRUE AS shuffled_auc_is_valid FROM ({_INPUTS_SQL})"


@query("train_gbt", _IMPORTANCES_SQL)
def _(w):
    return _importances(w, "Gradient Boosting")


@query("train_random_forest", _IMPORTANCES_SQL)
def _(w):
    return _importances(w, "Random Forest")


_IS_TEST = (
    "row_number() OVER (PARTITION BY label ORDER BY md5(customer_id || '42'), customer_id) "
    "<= (count(*) OVER (PARTITION BY label) + 4) // 5"
)


# At the optimum the probabilities of the training rows add up to their churners.
@query(
    "predict_probability",
    f"SELECT is_test, count(*) AS customers, CAST(sum(label) AS BIGINT) AS churners, "
    "CASE WHEN NOT is_test THEN CAST(sum(label) AS DOUBLE) END AS expected_churners, TRUE AS all_valid "
    f"FROM (SELECT label, {_IS_TEST} AS is_test FROM labelled) GROUP BY is_test",
)
def _(w):
    scored = model.predict_probability(w.trained("Logistic Regression"), w.matrix)
    p = F.col("churn_probability")
    return scored.groupBy("is_test").agg(
        F.count("*").alias("customers"),
        F.sum("label").alias("churners"),
        F.when(~F.col("is_test"), F.round(F.sum(p), 1)).alias("expected_churners"),
        F.every((p > 0) & (p < 1)).alias("all_valid"),
    )


def _given_scores(w: Workspace) -> DataFrame:
    late, failed = (F.coalesce(F.col(c), F.lit(0)) * 0.5 for c in ("late_rate", "failed_rate"))
    return model.label_rows(w.features).withColumn("churn_probability", F.round(late + failed, 6))


@query(
    "roc_auc",
    """
SELECT round((CAST(sum(CASE WHEN label = 1 THEN place END) AS DOUBLE) - CAST(p AS DOUBLE) * (p + 1) / 2)
  / (CAST(p AS DOUBLE) * n), 9) AS auc
FROM (
  SELECT label,
    rank() OVER (ORDER BY churn_probability) + (count(*) OVER (PARTITION BY churn_probability) - 1) / 2.0 AS place,
    count(*) FILTER (WHERE label = 1) OVER () AS p, count(*) FILTER (WHERE label = 0) OVER () AS n
  FROM given_scores
) GROUP BY p, n
""",
)
def _(w):
    return model.roc_auc(_given_scores(w)).withColumn("auc", F.round("auc", 9))


@query(
    "model_comparison",
    f"SELECT model, customers, churners, TRUE AS auc_equals_learners FROM (SELECT count(*) AS customers, CAST(sum(label) AS BIGINT) AS churners "
    f"FROM (SELECT label, {_IS_TEST} AS is_test FROM labelled) WHERE is_test), "
    "(VALUES ('Logistic Regression'), ('Gradient Boosting'), ('Random Forest')) m(model)",
)
def _(w):
    """The areas of all models in one pass, held against Spark's own evaluator."""
    _ = w.train  # cached once, before the learners start
    models = together({name: lambda n=name: w.trained(n) for name in model.LEARNERS})
    scored = {name: model.predict_probability(m, w.test).cache() for name, m in models.items()}
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="churn_probability", metricName="areaUnderROC", numBins=0)
    own = w.spark.createDataFrame([(n, float(evaluator.evaluate(df))) for n, df in scored.items()], "model string, own double")
    counts = w.test.agg(F.count("*").alias("customers"), F.sum("label").alias("churners")).withColumn("_k", F.lit(1))
    near = (F.abs(F.col("auc") - F.col("own")) < 1e-9).alias("auc_equals_learners")
    return model.model_comparison(scored).join(own, "model").withColumn("_k", F.lit(1)).join(counts, "_k").select("model", "customers", "churners", near)


@query(
    "leak_check",
    "SELECT label, " + ", ".join(f"round(avg({c}), 6) AS {c}" for c in model.LEAK_CHECK) + " FROM labelled GROUP BY label",
)
def _(w):
    return rounded(model.leak_check(model.label_rows(w.features)), *model.LEAK_CHECK)


@query(
    "final_fit_training_auc",
    f"SELECT count(*) AS optimal_inputs, (SELECT count(*) FROM labelled) AS customers, TRUE AS better_than_chance FROM ({_INPUTS_SQL} UNION ALL SELECT -1)",
)
def _(w):
    fitted, auc = w.final
    optimal = model.optimality(fitted, w.matrix).filter(F.abs("gradient") <= 1e-4 * F.col("scale"))
    counted = optimal.agg(F.count("*").alias("optimal_inputs")).withColumn("customers", F.lit(w.matrix.count()).cast("long"))
    better = auc.select((F.col("training_auc") > 0.5).alias("better_than_chance"), F.lit(1).alias("_k"))
    return counted.withColumn("_k", F.lit(1)).join(better, "_k").drop("_k")


@query(
    "unique_columns",
    "SELECT customer_id, label, customer_type, plan_type, region FROM model_columns",
)
def _(w):
    twice = model.model_columns(w.features).select("customer_type", "plan_type", "region", "label", "customer_id", "region")
    return encode.unique_columns(twice)


# All columns of the scores; the probability by what is known of it.
_SCORED = ", ".join(
    f"round({c}, 6) AS {c}" if c == "avg_amount_charged" else c for c, _ in ddl_columns(SCORES_DDL) if c != "churn_probability"
)


def _checked_scores(scores: DataFrame) -> DataFrame:
    p = F.col("churn_probability")
    return rounded(scores, "avg_amount_charged").withColumn("probability_is_valid", (p > 0) & (p < 1)).drop("churn_probability")


@query("churn_scores", f"SELECT {_SCORED}, TRUE AS probability_is_valid FROM churn_scores")
def _(w):
    return _checked_scores(model.churn_scores(w.matrix, w.final[0]))


@query("scores_preview", f"SELECT {_SCORED}, TRUE AS probability_is_valid FROM churn_scores ORDER BY customer_id LIMIT 5")
def _(w):
    return _checked_scores(model.scores_preview(w.scores))


# The intercept carries no penalty, so the probabilities of all rows add up to the churners.
@query("expected_churners", "SELECT count(*) AS customers, CAST(sum(label) AS DOUBLE) AS expected_churners FROM labelled")
def _(w):
    return w.scores.agg(F.count("*").alias("customers"), F.round(F.sum("churn_probability"), 1).alias("expected_churners"))


_RISK_FIELDS = "customer_id, region, plan_type, contract_type, tenure_months, churn_probability, sla_breach_days, failed_rate, ticket_count"


@query(
    "at_risk_customers",
    f"SELECT {_RISK_FIELDS} FROM given_scores WHERE contract_type IN ('month-to-month', '1-year') "
    "ORDER BY churn_probability DESC NULLS LAST, customer_id LIMIT 20",
)
def _(w):
    wanted = {"contract_type": ["month-to-month", "1-year"]}
    return model.at_risk_customers(_given_scores(w), 20, filters=wanted)


_SEGMENTS = ("plan_type", "region", "contract_type", "customer_type")


@query(
    "risk_by_segment",
    " UNION ALL ".join(
        f"SELECT '{s}' AS segment, {s} AS member, round(avg(churn_probability), 6) AS avg_probability, "
        f"count(*) AS customers FROM given_scores GROUP BY {s}"
        for s in _SEGMENTS
    ),
)
def _(w):
    return rounded(model.risk_by_segments(_given_scores(w), _SEGMENTS), "avg_probability")


# --- measures ----------------------------------------------------------------------

_PCT = "CAST(count(*) FILTER (WHERE {0}) AS DOUBLE) / nullif(count(*), 0) * 100"
_CHURN_RATE = _PCT.format("churn_flag")
_SLA_RATE = _PCT.format("sla_breach")
_RESOLVED_RATE = _PCT.format("resolved")
_FAILURE_RATE = _PCT.format("lower(payment_status) = 'failed'")

_AS_OF = date(2025, 6, 30)
_RECENT = "count(*) FILTER (WHERE outage_flag AND date > DATE '2025-06-30' - 30 AND date <= DATE '2025-06-30')"

_CARDS = {
    "total_customers": ("customer_labels", "count(*)"),
    "churned_customers": ("customer_labels", "count(*) FILTER (WHERE churn_flag)"),
    "churn_rate_pct": ("customer_labels", _CHURN_RATE),
    "avg_tenure_months": ("customer_labels", "avg(tenure_months)"),
    "avg_peak_latency": ("telemetry_labels", "avg(peak_hour_latency_ms)"),
    "avg_packet_loss": ("telemetry_labels", "avg(packet_loss_percent)"),
    "sla_breach_rate_pct": ("telemetry_labels", _SLA_RATE),
    "ticket_count": ("ticket_labels", "count(*)"),
    "resolved_ticket_count": ("ticket_labels", "count(*) FILTER (WHERE resolved)"),
    "resolved_rate_pct": ("ticket_labels", _RESOLVED_RATE),
    "payment_failure_rate_pct": ("billing_labels", _FAILURE_RATE),
    "avg_bandwidth_gb": ("telemetry_labels", "avg(daily_bandwidth_gb)"),
}

for _name, (_table, _value) in _CARDS.items():
    query(_name, f"SELECT {_value} AS {_name} FROM {_table}")(lambda w, m=_name: star.evaluate(w.star, [m]))


@query(
    "sla_breach_rate_pct",
    "SELECT count(*) FILTER (WHERE sla_breach) AS sla_breach_count, count(*) AS total_telemetry_rows, "
    f"{_SLA_RATE} AS sla_breach_rate_pct FROM telemetry_labels",
)
def _(w):
    return star.evaluate(w.star, ["sla_breach_count", "total_telemetry_rows", "sla_breach_rate_pct"])


@query("outages_last_30_days", f"SELECT {_RECENT} AS outages_last_30_days FROM telemetry_labels")
def _(w):
    # The slicer moves the last calendar day, and with it the 30-day window.
    return star.evaluate(star.apply_filters(w.star, date_to=_AS_OF), ["outages_last_30_days"])


def _rolling_sql(axes: str, days: str = "dimdate", labels: str = "") -> str:
    """Outages of the 30 days up to the last day of each date group; every label has every group."""
    names = f", {labels}" if labels else ""
    who = f", (SELECT DISTINCT {labels} FROM telemetry_labels WHERE date BETWEEN (SELECT min(date) FROM {days}) - 29 AND (SELECT max(date) FROM {days}))" if labels else ""
    mine = f"AND t.{labels} IS NOT DISTINCT FROM g.{labels}" if labels else ""
    return f"""
SELECT {axes}{names}, (SELECT count(*) FROM (SELECT date{names} FROM telemetry_labels WHERE outage_flag) t
  WHERE t.date BETWEEN g.last - 29 AND g.last {mine}) AS outages_last_30_days
FROM (SELECT * FROM (SELECT {axes}, max(d.date) AS last FROM (SELECT *, date AS day_ FROM {days}) d GROUP BY {axes}){who}) g
"""


@query("outages_last_30_days_by_date", _rolling_sql("date"))
def _(w):
    return visuals.recent_outages_over_time(w.star)


@query("outages_last_30_days_by_month", _rolling_sql("year, month"))
def _(w):
    return star.evaluate(w.star, ["outages_last_30_days"], by=["year", "month"])


_SLICED = "(SELECT * FROM dimdate WHERE date BETWEEN DATE '2024-02-10' AND DATE '2024-05-20')"


@query("outages_last_30_days_by_region_and_month", _rolling_sql("year, month", _SLICED, "region"))
def _(w):
    # The windows of the first month reach back past the slicer's first day.
    sliced = star.apply_filters(w.star, date_from=date(2024, 2, 10), date_to=date(2024, 5, 20))
    return star.evaluate(sliced, ["outages_last_30_days"], by=["region", "year", "month"])


@query(
    "outages_last_30_days_by_date_and_plan",
    _rolling_sql("date", _SLICED, "plan_type"),
)
def _(w):
    sliced = star.apply_filters(w.star, date_from=date(2024, 2, 10), date_to=date(2024, 5, 20))
    return visuals.recent_outages_over_time(sliced, "plan_type")


# --- visuals -----------------------------------------------------------------------


@query("churn_by_plan", f"SELECT plan_type, {_CHURN_RATE} AS churn_rate_pct FROM customer_labels GROUP BY plan_type")
def _(w):
    return visuals.churn_by_plan(w.star)


@query(
    "churn_by_region",
    f"SELECT region, {_CHURN_RATE} AS churn_rate_pct, count(*) FILTER (WHERE churn_flag) AS churned_customers "
    "FROM customer_labels GROUP BY region",
)
def _(w):
    return visuals.churn_by_region(w.star)


@query("tenure_bucket", "SELECT customer_id, tenure_months, tenure_bucket FROM customer_labels")
def _(w):
    return w.gold["dimcustomer"].select("customer_id", "tenure_months", tenure_bucket().alias("tenure_bucket"))


@query(
    "churn_by_tenure_bucket",
    f"SELECT tenure_bucket, {_CHURN_RATE} AS churn_rate_pct FROM customer_labels GROUP BY tenure_bucket",
)
def _(w):
    return visuals.churn_by_tenure_bucket(w.star)


def across_sql(axis: str, parts: list[tuple[str, str, str]]) -> str:
    """Measures of several tables side by side: each grouped alone, then matched by group."""
    grouped = " UNION ALL ".join(
        f"SELECT {axis}, "
        + ", ".join(f"{v if n == name else 'NULL'} AS {n}" for n, _, v in parts)
        + f" FROM {table} GROUP BY {axis}"
        for name, table, _ in parts
    )
    totals = ", ".join(f"max({n}) AS {n}" for n, _, _ in parts)
    return f"SELECT {axis}, {totals} FROM ({grouped}) GROUP BY {axis}"


@query(
    "sla_vs_churn",
    across_sql(
        "plan_type",
        [("sla_breach_rate_pct", "telemetry_labels", _SLA_RATE), ("churn_rate_pct", "customer_labels", _CHURN_RATE)],
    ),
)
def _(w):
    return visuals.sla_vs_churn(w.star)


@query(
    "sla_vs_churn_by_region",
    across_sql(
        "region",
        [("sla_breach_rate_pct", "telemetry_labels", _SLA_RATE), ("churn_rate_pct", "customer_labels", _CHURN_RATE)],
    ),
)
def _(w):
    return visuals.sla_vs_churn(w.star, by="region")


@query(
    "network_health_by_month",
    f"SELECT year, month, {_SLA_RATE} AS sla_breach_rate_pct, avg(peak_hour_latency_ms) AS avg_peak_latency "
    "FROM telemetry_labels GROUP BY year, month",
)
def _(w):
    return visuals.network_health_by_month(w.star)


@query(
    "peak_latency_by_region",
    "SELECT region, avg(peak_hour_latency_ms) AS avg_peak_latency FROM telemetry_labels GROUP BY region",
)
def _(w):
    return visuals.peak_latency_by_region(w.star)


@query(
    "loss_vs_bandwidth_by_plan",
    "SELECT plan_type, avg(daily_bandwidth_gb) AS avg_bandwidth_gb, avg(packet_loss_percent) AS avg_packet_loss "
    "FROM telemetry_labels GROUP BY plan_type",
)
def _(w):
    return visuals.loss_vs_bandwidth_by_plan(w.star)


@query("outages_by_region", f"SELECT region, {_RECENT} AS outages_last_30_days FROM telemetry_labels GROUP BY region")
def _(w):
    return visuals.outages_by_region(w.star, as_of=_AS_OF)


@query("outages_over_time", "SELECT date, count(*) AS outage_rows FROM telemetry_labels WHERE outage_flag GROUP BY date")
def _(w):
    return visuals.outages_over_time(w.star)


@query("tickets_by_issue", "SELECT issue_category, count(*) AS ticket_count FROM ticket_labels GROUP BY issue_category")
def _(w):
    return visuals.tickets_by_issue(w.star)


@query(
    "resolved_by_issue",
    "SELECT issue_category, count(*) FILTER (WHERE resolved) AS resolved_ticket_count FROM ticket_labels "
    "GROUP BY issue_category",
)
def _(w):
    return visuals.resolved_by_issue(w.star)


@query(
    "tickets_by_region",
    f"SELECT region, count(*) AS ticket_count, {_RESOLVED_RATE} AS resolved_rate_pct FROM ticket_labels GROUP BY region",
)
def _(w):
    return visuals.tickets_by_region(w.star)


@query(
    "payment_failure_and_churn_by_region",
    across_sql(
        "region",
        [
            ("payment_failure_rate_pct", "billing_labels", _FAILURE_RATE),
            ("churn_rate_pct", "customer_labels", _CHURN_RATE),
        ],
    ),
)
def _(w):
    return visuals.payment_failure_and_churn_by_region(w.star)


# --- filter context ----------------------------------------------------------------


@query(
    "filter_date_range",
    f"SELECT region, count(*) AS ticket_count, {_RESOLVED_RATE} AS resolved_rate_pct FROM ticket_labels "
    "WHERE date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20' AND year = 2024 AND month IN (1, 2) GROUP BY region",
)
def _(w):
    kept = star.filter_date_range(w.star, date(2024, 1, 5), date(2024, 1, 20), years=[2024], months=[1, 2])
    return star.evaluate(kept, ["ticket_count", "resolved_rate_pct"], by=["region"])


@query(
    "filter_region",
    f"SELECT plan_type, {_SLA_RATE} AS sla_breach_rate_pct FROM telemetry_labels WHERE region IN ('ASIA', 'EUROPE') "
    "GROUP BY plan_type",
)
def _(w):
    return star.evaluate(star.filter_region(w.star, ["ASIA", "EUROPE"]), ["sla_breach_rate_pct"], by=["plan_type"])


@query(
    "filter_plan",
    "SELECT year, month, avg(peak_hour_latency_ms) AS avg_peak_latency FROM telemetry_labels "
    "WHERE plan_type IN ('NBN100', 'Fibre') GROUP BY year, month",
)
def _(w):
    return star.evaluate(star.filter_plan(w.star, ["NBN100", "Fibre"]), ["avg_peak_latency"], by=["year", "month"])


@query(
    "filter_tenure_bucket",
    f"SELECT plan_type, {_CHURN_RATE} AS churn_rate_pct FROM customer_labels "
    "WHERE tenure_bucket IN ('0–6 months', '24+ months') GROUP BY plan_type",
)
def _(w):
    kept = star.filter_tenure_bucket(w.star, ["0–6 months", "24+ months"])
    return star.evaluate(kept, ["churn_rate_pct"], by=["plan_type"])


@query(
    "filter_customer_type",
    f"SELECT region, {_FAILURE_RATE} AS payment_failure_rate_pct FROM billing_labels "
    "WHERE customer_type IN ('business') GROUP BY region",
)
def _(w):
    kept = star.filter_customer_type(w.star, ["business"])
    return star.evaluate(kept, ["payment_failure_rate_pct"], by=["region"])


@query(
    "filter_calendar",
    f"SELECT region, count(*) AS ticket_count, {_RESOLVED_RATE} AS resolved_rate_pct FROM ticket_labels "
    "WHERE dayofweek(date) IN (0, 6) AND month IN (1, 7) GROUP BY region",
)
def _(w):
    kept = star.filter_calendar(w.star, F.col("is_weekend") & F.col("month").isin(1, 7))
    return star.evaluate(kept, ["ticket_count", "resolved_rate_pct"], by=["region"])


_SEGMENT = "region = 'ASIA' AND plan_type IN ('NBN100', 'NBN250', 'NBN1000') AND customer_type = 'business'"
_QUARTER = "date BETWEEN DATE '2024-01-01' AND DATE '2024-03-31'"


@query(
    "segment_kpis",
    f"""
SELECT * FROM
 (SELECT count(*) AS total_customers, count(*) FILTER (WHERE churn_flag) AS churned_customers,
    {_CHURN_RATE} AS churn_rate_pct, avg(tenure_months) AS avg_tenure_months
  FROM customer_labels WHERE {_SEGMENT}),
 (SELECT avg(peak_hour_latency_ms) AS avg_peak_latency, avg(packet_loss_percent) AS avg_packet_loss,
    count(*) FILTER (WHERE sla_breach) AS sla_breach_count, count(*) AS total_telemetry_rows,
    {_SLA_RATE} AS sla_breach_rate_pct,
    count(*) FILTER (WHERE outage_flag AND date > DATE '2024-03-31' - 30) AS outages_last_30_days,
    avg(daily_bandwidth_gb) AS avg_bandwidth_gb
  FROM telemetry_labels WHERE {_SEGMENT} AND {_QUARTER}),
 (SELECT count(*) AS ticket_count, count(*) FILTER (WHERE resolved) AS resolved_ticket_count,
    {_RESOLVED_RATE} AS resolved_rate_pct
  FROM ticket_labels WHERE {_SEGMENT} AND {_QUARTER}),
 (SELECT {_FAILURE_RATE} AS payment_failure_rate_pct FROM billing_labels WHERE {_SEGMENT} AND {_QUARTER})
""",
)
def _(w):
    segment = star.apply_filters(
        w.star,
        date_from=date(2024, 1, 1),
        date_to=date(2024, 3, 31),
        regions=["ASIA"],
        plans=["NBN100", "NBN250", "NBN1000"],
        customer_types=["business"],
    )
    return visuals.segment_kpis(segment)


_GROUPINGS = [[], ["region"], ["plan_type"], ["region", "plan_type"], ["customer_type", "tenure_bucket"]]
_ALL_AXES = ("region", "plan_type", "customer_type", "tenure_bucket")
_TELEMETRY_CARDS = {
    "avg_peak_latency": "avg(peak_hour_latency_ms)",
    "avg_packet_loss": "avg(packet_loss_percent)",
    "sla_breach_count": "count(*) FILTER (WHERE sla_breach)",
    "total_telemetry_rows": "count(*)",
    "sla_breach_rate_pct": _SLA_RATE,
    "outages_last_30_days": "count(*) FILTER (WHERE outage_flag AND date > DATE '2024-03-31' - 30)",
    "avg_bandwidth_gb": "avg(daily_bandwidth_gb)",
}
_CARDS_BY_TABLE = {
    "customer_labels": {n: v for n, (t, v) in _CARDS.items() if t == "customer_labels"},
    "telemetry_labels": _TELEMETRY_CARDS,
    "ticket_labels": {n: v for n, (t, v) in _CARDS.items() if t == "ticket_labels"},
    "billing_labels": {n: v for n, (t, v) in _CARDS.items() if t == "billing_labels"},
}
_COUNTS = ("total_customers", "churned_customers", "sla_breach_count", "total_telemetry_rows", "outages_last_30_days", "ticket_count", "resolved_ticket_count")


def _grouping_sql(axes: list[str]) -> str:
    """Each table grouped alone and matched by group; missing counts are 0."""
    names = [n for cards in _CARDS_BY_TABLE.values() for n in cards]
    parts = " UNION ALL ".join(
        "SELECT "
        + ", ".join([*(f"{a}" if a in axes else f"NULL AS {a}" for a in _ALL_AXES), *(f"{cards[n] if n in cards else 'NULL'} AS {n}" for n in names)])
        + f" FROM {table}"
        + ("" if table == "customer_labels" else f" WHERE {_QUARTER}")
        + (f" GROUP BY {', '.join(axes)}" if axes else "")
        for table, cards in _CARDS_BY_TABLE.items()
    )
    values = ", ".join(f"coalesce(max({n}), 0) AS {n}" if n in _COUNTS else f"max({n}) AS {n}" for n in names)
    return f"SELECT '{','.join(a for a in _ALL_AXES if a in axes)}' AS grain, {', '.join(_ALL_AXES)}, {values} FROM ({parts}) GROUP BY ALL"


@query("all_segment_kpis", " UNION ALL ".join(_grouping_sql(axes) for axes in _GROUPINGS))
def _(w):
    quarter = star.apply_filters(w.star, date_from=date(2024, 1, 1), date_to=date(2024, 3, 31))
    return visuals.all_segment_kpis(quarter, _GROUPINGS)


# --- data checks -------------------------------------------------------------------


# Rows that break a rule, planted where the check must find them.


@query(
    "sla_breach_check",
    """
SELECT plan_type, count(*) AS telemetry_rows, count(*) FILTER (WHERE sla_breach) AS stored_breaches,
  count(*) FILTER (WHERE rule) AS rule_breaches, count(*) FILTER (WHERE coalesce(sla_breach, false) <> rule) AS mismatches
FROM (
  SELECT * REPLACE (CASE WHEN ends_with(telemetry_id, '7-1') THEN NOT sla_breach WHEN ends_with(telemetry_id, '9-2') THEN NULL ELSE sla_breach END AS sla_breach),
    coalesce(packet_loss_percent > 3.0 OR peak_hour_latency_ms >
    CASE WHEN plan_type IN ('Business_VoIP', 'Fibre', 'Wholesale_Dark_Fibre') THEN 80 ELSE 100 END, false) AS rule
  FROM silver_network_telemetry
) GROUP BY plan_type
""",
)
def _(w):
    row = F.col("telemetry_id")
    stored = F.when(row.endswith("7-1"), ~F.col("sla_breach")).when(~row.endswith("9-2"), F.col("sla_breach"))
    return checks.sla_breach_check(w.silver["network_telemetry"].withColumn("sla_breach", stored))


# Outage windows of the test regions: (first day, last day, regions).
_WINDOWS = [
    (date(2023, 3, 1), date(2023, 4, 15), ["ASIA", "EUROPE"]),
    (date(2024, 1, 10), date(2024, 1, 11), ["AMERICA"]),
    (date(2024, 1, 15), date(2024, 1, 16), ["AFRICA", "EUROPE"]),
]
_WINDOWS_SQL = "(VALUES " + ", ".join(
    f"(DATE '{s}', DATE '{e}', '{r}')" for s, e, regions in _WINDOWS for r in regions
) + ") o(first_day, last_day, region)"


def _windows(w: Workspace) -> DataFrame:
    return w.spark.createDataFrame(_WINDOWS, "start date, end date, regions array<string>")


@query(
    "outage_interval_join",
    f"SELECT t.region, EXISTS (SELECT 1 FROM {_WINDOWS_SQL} WHERE o.region = t.region "
    "AND t.date BETWEEN o.first_day AND o.last_day) AS in_window, outage_flag, count(*) AS telemetry_rows "
    "FROM silver_network_telemetry t GROUP BY 1, 2, 3",
)
def _(w):
    return checks.outage_interval_join(w.silver["network_telemetry"], _windows(w))


# Windows of hours by kind of event: overlapping, meeting, without end, without start, and upside down.
_HOURS = [
    (datetime(2024, 1, 3, 5, 30), datetime(2024, 1, 3, 11, 15, 0, 250), ["click", "view"]),
    (datetime(2024, 1, 3, 9), datetime(2024, 1, 5, 2), ["click"]),
    (datetime(2024, 1, 5, 2), datetime(2024, 1, 5, 3), ["click"]),
    (datetime(2024, 1, 28, 22), None, ["signup"]),
    (datetime(2024, 1, 29, 1), None, ["signup"]),
    (None, datetime(2024, 1, 2, 7), ["error", "view"]),
    (datetime(2024, 1, 9), datetime(2024, 1, 8), ["view"]),
]
_HOURS_SQL = "(VALUES " + ", ".join(
    f"({i}, {f"TIMESTAMP '{s}'" if s else 'CAST(NULL AS TIMESTAMP)'}, {f"TIMESTAMP '{e}'" if e else 'CAST(NULL AS TIMESTAMP)'}, '{k}')"
    for i, (s, e, kinds) in enumerate(_HOURS)
    for k in kinds
) + ") o(number, low, high, kind)"
_HELD = "ts >= coalesce(o.low, ts) AND ts <= coalesce(o.high, ts)"


def _events(w: Workspace) -> DataFrame:
    return w.spark.read.parquet(f"{w.sf_dir}/events.parquet").select("event_id", F.col("event_type").alias("region"), F.col("ts").cast("timestamp_ntz").alias("date"), (F.col("value") > 10).alias("outage_flag"))


def _hours(w: Workspace) -> DataFrame:
    rows = [(i, *window) for i, window in enumerate(_HOURS)]
    return w.spark.createDataFrame(rows, "number int, start timestamp_ntz, end timestamp_ntz, regions array<string>")


@query(
    "outage_hours_join",
    f"SELECT event_type AS region, EXISTS (SELECT 1 FROM {_HOURS_SQL} WHERE o.kind = event_type AND {_HELD}) AS in_window, "
    "value > 10 AS outage_flag, count(*) AS telemetry_rows FROM events GROUP BY 1, 2, 3",
)
def _(w):
    return checks.outage_interval_join(_events(w), _hours(w))


@query(
    "interval_matches",
    f"SELECT event_id, CAST(o.number AS INTEGER) AS number FROM events JOIN {_HOURS_SQL} ON o.kind = event_type AND {_HELD}",
)
def _(w):
    points = _events(w).select("event_id", "region", intervals.place("date", "timestamp_ntz").alias("at"))
    windows = _hours(w).select("number", F.explode("regions").alias("region"), *[intervals.place(c, "timestamp_ntz").alias(c) for c in ("start", "end")])
    return intervals.interval_matches(points, windows, "at", ["region"], intervals.DAY // 4).select("event_id", "number")


@query(
    "days_to_churn",
    """
SELECT CAST(churn_date - date AS INTEGER) AS days_to_churn, count(*) AS telemetry_rows,
  avg(peak_hour_latency_ms) AS avg_peak_latency_ms, avg(packet_loss_percent) AS avg_packet_loss_pct,
  avg(connection_drops) AS avg_connection_drops
FROM silver_network_telemetry JOIN silver_customers USING (customer_id)
WHERE churn_date - date BETWEEN 0 AND 30 GROUP BY 1
""",
)
def _(w):
    return checks.days_to_churn(w.silver["network_telemetry"], w.silver["customers"])


@query(
    "activity_after_churn",
    """
SELECT 'network_telemetry' AS table_name, count(*) AS rows_after_churn
FROM silver_network_telemetry JOIN silver_customers USING (customer_id) WHERE date > churn_date
UNION ALL
SELECT 'billing_events', count(*)
FROM silver_billing_events JOIN silver_customers USING (customer_id) WHERE billing_month > churn_date
""",
)
def _(w):
    return checks.activity_after_churn(
        w.silver["network_telemetry"], w.silver["billing_events"], w.silver["customers"]
    )


@query(
    "tickets_near_outage",
    f"SELECT t.region, EXISTS (SELECT 1 FROM {_WINDOWS_SQL} WHERE o.region = t.region "
    "AND t.open_date BETWEEN o.first_day - 3 AND o.last_day + 3) AS near_outage, count(*) AS ticket_count "
    "FROM silver_support_tickets t GROUP BY 1, 2",
)
def _(w):
    return checks.tickets_near_outage(w.silver["support_tickets"], _windows(w))


@query(
    "csat_by_resolution_band",
    """
SELECT CASE WHEN close_date - open_date <= 2 THEN 'up to 2 days' WHEN close_date - open_date <= 7 THEN '3 to 7 days'
  ELSE 'over 7 days' END AS resolution_band, count(*) AS ticket_count, avg(satisfaction_score) AS avg_satisfaction
FROM silver_support_tickets WHERE resolved AND close_date IS NOT NULL GROUP BY 1
""",
)
def _(w):
    return checks.csat_by_resolution_band(w.silver["support_tickets"])


@query(
    "payment_lag",
    """
SELECT payment_status, count(*) AS bills, CAST(min(lag) AS INTEGER) AS min_lag_days,
  CAST(max(lag) AS INTEGER) AS max_lag_days, avg(lag) AS avg_lag_days,
  count(*) FILTER (WHERE NOT coalesce(CASE payment_status WHEN 'paid' THEN lag BETWEEN 1 AND 7
    WHEN 'late' THEN lag BETWEEN 8 AND 30 WHEN 'failed' THEN payment_date IS NULL END, false)) AS violations
FROM (SELECT *, payment_date - billing_month AS lag FROM silver_billing_events) GROUP BY payment_status
""",
)
def _(w):
    return checks.payment_lag(w.silver["billing_events"])


@query(
    "plan_type_domain_check",
    """
SELECT customer_type, count(*) AS customers, count(*) FILTER (WHERE NOT coalesce(CASE customer_type
    WHEN 'residential' THEN plan_type IN ('NBN50', 'NBN100', 'NBN250', 'NBN1000')
    WHEN 'business' THEN plan_type IN ('NBN100', 'NBN250', 'NBN1000', 'Fibre', 'Business_VoIP')
    WHEN 'wholesale' THEN plan_type IN ('Wholesale_Dark_Fibre', 'Fibre', 'NBN1000') END, false)) AS violations
FROM (SELECT * REPLACE (CASE WHEN ends_with(customer_id, '3') THEN 'NBN50' WHEN ends_with(customer_id, '11') THEN NULL ELSE plan_type END AS plan_type)
  FROM silver_customers) GROUP BY customer_type
""",
)
def _(w):
    row = F.col("customer_id")
    plan = F.when(row.endswith("3"), "NBN50").when(~row.endswith("11"), F.col("plan_type"))
    return checks.plan_type_domain_check(w.silver["customers"].withColumn("plan_type", plan))


# Nodes of the test regions: four numbers each, in the order of the region names.
_NODES = [(f"NODE-{i + 1:02d}", _LEVELS["region"][i // 4]) for i in range(20)]


@query(
    "node_region_check",
    "SELECT region, count(*) AS violations FROM silver_network_telemetry t WHERE NOT EXISTS (SELECT 1 FROM (VALUES "
    + ", ".join(f"('{n}', '{r}')" for n, r in _NODES)
    + ") m(node_id, region) WHERE m.node_id = t.node_id AND m.region = t.region) GROUP BY region",
)
def _(w):
    nodes = w.spark.createDataFrame(_NODES, "node_id string, region string")
    return checks.node_region_check(w.silver["network_telemetry"], nodes)


@query(
    "ticket_lifecycle_check",
    """
SELECT count(*) AS ticket_count,
  count(*) FILTER (WHERE coalesce(resolved, false) <> (close_date IS NOT NULL)) AS closed_not_resolved_or_back,
  count(*) FILTER (WHERE NOT coalesce(resolved, false) AND satisfaction_score IS NOT NULL) AS scored_unresolved,
  count(*) FILTER (WHERE close_date < open_date) AS closed_before_open
FROM (SELECT * REPLACE (
    CASE WHEN ends_with(ticket_id, '5') THEN open_date - 2 WHEN ends_with(ticket_id, '41') THEN NULL ELSE close_date END AS close_date,
    CASE WHEN ends_with(ticket_id, '8') THEN 3 ELSE satisfaction_score END AS satisfaction_score)
  FROM silver_support_tickets)
""",
)
def _(w):
    row = F.col("ticket_id")
    closed = F.when(row.endswith("5"), F.date_sub("open_date", 2)).when(~row.endswith("41"), F.col("close_date"))
    score = F.when(row.endswith("8"), 3).otherwise(F.col("satisfaction_score"))
    planted = w.silver["support_tickets"].withColumns({"close_date": closed, "satisfaction_score": score})
    return checks.ticket_lifecycle_check(planted)
