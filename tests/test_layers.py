"""Key maps over loads, facts by month, published versions, column profiles."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from telcolake.operators.keys import extend_keys, surrogate_key
from telcolake.plans import build, gold, star as st
from telcolake.sources import tables, versions
from telcolake.sources.schemas import GOLD_DDL, SOURCES
from verification.workspace import workspace

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


# --- keys ---------------------------------------------------------------------------


def members(spark, *names):
    return spark.createDataFrame([(n,) for n in names], "name string")


def test_keys_survive_loads(spark):
    first = surrogate_key(members(spark, "b", "d"), ["name"], "key")
    second = extend_keys(first, members(spark, "c", None, "d", "a", "c", "b"), ["name"], "key")
    assert rows(second) == [(1, "b"), (2, "d"), (3, None), (4, "a"), (5, "c")]
    third = extend_keys(second, members(spark, "z"), ["name"], "key")
    assert rows(third)[-1] == (6, "z") and third.count() == 6
    assert rows(extend_keys(third, members(spark), ["name"], "key")) == rows(third)
    assert [f.dataType.simpleString() for f in third.schema] == ["int", "string"]


def test_a_hot_new_member_counts_once(spark):
    known = surrogate_key(members(spark, "a"), ["name"], "key", "bigint")
    hot = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("name"))
    found = extend_keys(known, hot, ["name"], "key")
    assert found.count() == 20_002 and found.agg(F.max("key")).first()[0] == 20_002
    # Copies are folded in each task, before the shuffle.
    assert "HashAggregate" in plan(hot.distinct()).split("Exchange")[1]


def silver_of(spark, customers):
    def table(name, given=()):
        source = SOURCES[name]
        return spark.createDataFrame([tuple(r.get(c) for c in source.columns) for r in given], source.silver_ddl)

    visits = [{"telemetry_id": f"t{c['customer_id']}", "customer_id": c["customer_id"], "date": date(2024, 1, 5)} for c in customers]
    return {**{n: table(n) for n in SOURCES}, "customers": table("customers", customers), "network_telemetry": table("network_telemetry", visits)}


@pytest.fixture
def layout(tmp_path):
    return build.Layout(str(tmp_path / "lake"))


def load(spark, layout, customers, **options):
    tables.write_silver(silver_of(spark, customers), layout.silver)
    return build.build_gold(spark, layout, **options)


OLD = [{"customer_id": "C3", "region": "Perth"}, {"customer_id": "C7", "region": None}]
NEW = [{"customer_id": "C1", "region": "Adelaide"}, {"customer_id": "C7", "region": "Perth"}, {"customer_id": "C9", "region": "Sydney"}]


def test_a_second_load_keeps_keys(spark, layout):
    first = load(spark, layout, OLD)
    assert rows(first["dimcustomer"].select("customer_id", "customer_key")) == [("C3", 1), ("C7", 2)]
    second = load(spark, layout, NEW)
    # C3 left, C7 keeps its key, the others follow the greatest.
    assert rows(second["dimcustomer"].select("customer_id", "customer_key")) == [("C1", 3), ("C7", 2), ("C9", 4)]
    assert rows(second["dimregion"]) == [(2, "Perth"), (3, "Adelaide"), (4, "Sydney")]
    assert rows(second["facttelemetry"].select("telemetry_id", "customer_key")) == [("tC1", 3), ("tC7", 2), ("tC9", 4)]
    third = load(spark, layout, OLD)
    assert rows(third["dimcustomer"].select("customer_id", "customer_key", "region_key")) == [("C3", 1, 2), ("C7", 2, None)]


# --- versions ------------------------------------------------------------------------


def test_a_failed_job_leaves_the_old_version(spark, layout, monkeypatch, tmp_path):
    schema, at = "published_test", str(tmp_path / "schema")
    load(spark, layout, OLD, schema=schema, location=at)
    before = rows(tables.contents(tables.read_gold_tables(spark, schema)))

    def broken(*_, **__):
        raise RuntimeError("lost")

    monkeypatch.setattr(gold, "facts", broken)
    with pytest.raises(RuntimeError):
        load(spark, layout, NEW, schema=schema, location=at)
    assert rows(tables.contents(tables.read_gold_tables(spark, schema))) == before
    assert rows(tables.contents(tables.read_gold(spark, layout.gold))) == before
    monkeypatch.undo()

    load(spark, layout, NEW, schema=schema, location=at)
    after = rows(tables.contents(tables.read_gold_tables(spark, schema)))
    assert after != before and after == rows(tables.contents(tables.read_gold(spark, layout.gold)))
    # The members that the failed job had numbered have those keys.
    assert rows(spark.table(f"{schema}.dimcustomer").select("customer_id", "customer_key")) == [("C1", 3), ("C7", 2), ("C9", 4)]
    # Nothing is copied: the catalog's tables are the written files.
    assert {os.path.dirname(f).split("/lake/")[1].split("/")[0] for f in spark.table(f"{schema}.facttelemetry").inputFiles()} == {"gold"}


def test_old_versions_expire(spark, tmp_path):
    root = str(tmp_path / "layer")
    made = []
    for i in range(4):
        version = versions.new_version(root)
        spark.range(i).write.parquet(f"{version}/t")
        made.append(version if i == 1 else versions.publish(spark, version))
    assert versions.published(spark, root) == [made[0], made[2], made[3]]
    assert versions.current(spark, root) == made[3]
    running = versions.new_version(root)
    spark.range(9).write.parquet(f"{running}/t")
    # Published ones beyond the last two go, and the one that was never finished; a running job's stays.
    assert versions.expire(spark, root, keep=2) == [made[0], made[1]]
    assert os.path.exists(running) and versions.current(spark, root) == made[3]
    with pytest.raises(ValueError):
        versions.expire(spark, root, keep=0)
    assert versions.current(spark, str(tmp_path / "none")) == str(tmp_path / "none")


def test_scores_are_written_once(spark, tmp_path):
    from telcolake.sources.schemas import SCORES_DDL

    frame = spark.createDataFrame([], SCORES_DDL)
    for _ in range(2):
        tables.write_scores(frame, str(tmp_path / "scores"), "scores_test", location=str(tmp_path / "ml"))
    assert spark.table("scores_test.churn_scores").schema == frame.schema
    assert tables.read_scores(spark, str(tmp_path / "scores")).count() == 0
    assert not os.listdir(tmp_path / "ml") if os.path.exists(tmp_path / "ml") else True


# --- facts by month --------------------------------------------------------------------


def scans(df, fact):
    return [x for x in plan(df).split("\n") if "FileScan" in x and fact in x]


@pytest.fixture
def star(spark):
    return workspace(spark, SF_DIR).star


def test_slicers_prune_months(spark, star):
    kept = st.filter_date_range(star, date(2024, 1, 15), date(2024, 3, 2))
    scan = scans(st.evaluate(kept, ["avg_peak_latency"]), "facttelemetry")[0]
    filters = scan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    assert "fact_month" in filters and "202401" in filters and "202403" in filters
    months = st.filter_date_range(star, years=[2024], months=[2, 5])
    scan = scans(st.evaluate(months, ["ticket_count"]), "facttickets")[0]
    assert "202402" in scan.split("PushedFilters")[0] and "202405" in scan.split("PushedFilters")[0]


def test_key_ranges_prune_months(spark, star):
    scan = scans(gold.telemetry_by_date_key_range(star["facttelemetry"], 20250101, 20251231), "facttelemetry")[0]
    assert "202501" in scan.split("PushedFilters")[0] and "202512" in scan.split("PushedFilters")[0]


def test_another_date_role_does_not_prune_by_the_wrong_month(star, rows_of):
    paid = st.Star(star.tables, date_role={**st.DATE_ROLE, "factbilling": "payment_date_key"})
    kept = st.filter_date_range(paid, date(2024, 3, 1), date(2024, 3, 31))
    whole = star["factbilling"].filter("payment_date_key between 20240301 and 20240331")
    assert st.evaluate(kept, ["payment_failure_rate_pct"]).count() == 1
    assert kept["factbilling"].count() == whole.count() > 0


def test_a_joined_calendar_prunes_months_at_run_time(spark, star):
    kept = st.filter_calendar(star, F.col("is_weekend") & (F.col("year") == 2024) & (F.col("month") == 2))
    scan = scans(st.evaluate(kept, ["avg_peak_latency"]), "facttelemetry")[0]
    assert "dynamicpruning" in scan.split("PartitionFilters: [")[1].split("], PushedFilters")[0]
    plain = st.filter_date_range(star, date(2024, 2, 1), date(2024, 2, 29))
    weekends = plain["facttelemetry"].join(star["dimdate"].filter("is_weekend"), "date_key", "left_semi")
    assert kept["facttelemetry"].count() == weekends.count() > 0


def test_months_hold_their_rows(spark, star):
    for name, day in tables.FACT_DAY.items():
        fact = star[name]
        assert fact.filter(~F.floor(F.col(day) / 100).cast("int").eqNullSafe(F.col(tables.MONTH))).count() == 0
        assert [f"{c} {t}" for c, t in fact.dtypes] == [*GOLD_DDL[name].split(", "), f"{tables.MONTH} int"]
    assert star["facttelemetry"].filter("fact_month is null").count() == star["facttelemetry"].filter("date_key is null").count() > 0


def test_a_customer_with_a_third_of_a_month_is_split(spark, tmp_path):
    """Rows of one customer, or of none, that fill more than a file are written by several tasks."""
    columns = GOLD_DDL["facttelemetry"]
    base = spark.createDataFrame([], columns)
    hot = spark.range(0, 300_000, 1, 8).select(
        *[
            {
                "telemetry_id": F.sha2(F.col("id").cast("string"), 256),
                "customer_key": F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise((F.col("id") % 5000).cast("int")),
                "date_key": F.lit(20240105),
            }.get(f.name, F.lit(None).cast(f.dataType)).alias(f.name)
            for f in base.schema
        ]
    )
    settings = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1MB", "spark.sql.shuffle.partitions": "64"}
    before = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        tables.write_gold_paths({"facttelemetry": hot}, str(tmp_path))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    stored = spark.read.parquet(f"{tmp_path}/facttelemetry")
    of_none = stored.filter("customer_key is null").groupBy(F.input_file_name().alias("f")).count().collect()
    assert len(of_none) > 3 and sum(r["count"] for r in of_none) == 100_000
    # Each other customer's rows of the month are in one file.
    files = stored.filter("customer_key is not null").select("customer_key", F.input_file_name().alias("f"))
    spread = files.groupBy("customer_key").agg(F.count_distinct("f").alias("n"))
    assert spread.agg(F.avg("n")).first()[0] < 1.2


# --- profiles --------------------------------------------------------------------------


def test_column_profile(spark):
    df = spark.createDataFrame([(1, "b", 2.5, None), (None, "", 1e9, None), (3, "b", None, None)], "a int, `b c` string, d double, e date")
    got = {r.column_name: tuple(r)[1:] for r in tables.column_profile(df).collect()}
    assert got["a"] == (3, 1, "1", "3", 2)
    assert got["b c"] == (3, 0, "", "b", 2)
    assert got["d"] == (3, 1, "2.500000", "1000000000.000000", 2)
    assert got["e"] == (3, 3, None, None, 0)
    empty = {r.column_name: tuple(r)[1:] for r in tables.column_profile(df.limit(0)).collect()}
    assert empty["a"] == (0, 0, None, None, 0)


def test_a_profile_is_one_pass_and_gathers_no_set(spark, star):
    text = plan(tables.column_profile(star["facttelemetry"]))
    assert text.count("FileScan") == 1 and "collect_set" not in text and "Expand" not in text
    many = tables.column_profile(spark.range(200_000).toDF("n")).first()
    assert abs(many.distinct_estimate - 200_000) < 0.065 * 200_000


def test_inventories_of_no_schema(spark):
    spark.sql("CREATE SCHEMA IF NOT EXISTS empty_schema")
    assert tables.table_inventory(spark, ["empty_schema"]).count() == 0
    assert tables.column_inventory(spark, ["empty_schema"]).count() == 0
