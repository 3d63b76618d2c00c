"""Plans and results when one key holds a third of all rows or more."""

import re

import pytest
from pyspark.sql import functions as F

from telcolake.operators.dedupe import dedupe_by_key
from telcolake.operators.keys import lookup_key, surrogate_key
from telcolake.plans import features, star as st
from telcolake.plans.build import Layout
from telcolake.sources import shared, sizing, tables
from verification.workspace import workspace

SF_DIR = "/root/testdata/sf0.001"


def plan(df, final=False):
    if final:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def large_dimensions(spark):
    """Treat every table as too large to broadcast."""
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    for name in names:
        spark.conf.set(name, "-1")
    yield
    for name in names:
        spark.conf.unset(name)


def test_dedupe_shrinks_hot_keys_before_the_shuffle(spark):
    hot = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
        F.col("id").cast("string").alias("v"),
    )
    df = dedupe_by_key(hot, "k")
    text = plan(df)
    exchange = text.index("Exchange hashpartitioning")
    assert "WindowGroupLimit" in text[:exchange] and "WindowGroupLimit" in text[exchange:]
    assert df.count() == 20_001
    assert df.filter("k is null").first().v == "0"


def test_hot_customer_is_split(spark, large_dimensions, tmp_path):
    """The lookup of a customer with a third of the facts runs in several tasks."""
    facts = spark.range(0, 300_000, 1, 16).select(
        F.when(F.col("id") % 3 == 0, F.lit("C7")).otherwise(F.concat(F.lit("C"), F.col("id") % 5000)).alias("customer_id"),
        F.col("id").alias("v"),
    )
    dim = surrogate_key(spark.range(5000).select(F.concat(F.lit("C"), "id").alias("customer_id")), ["customer_id"], "customer_key")
    settings = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "100KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100KB",
    }
    for name, value in settings.items():
        spark.conf.set(name, value)
    try:
        keyed = lookup_key(facts, dim, "customer_id", "customer_id", "customer_key")
        assert "skew=true" in plan(keyed, final=True)
        assert keyed.count() == 300_000
        assert keyed.filter("customer_key is null").count() == 0
    finally:
        for name in settings:
            spark.conf.unset(name)


def test_keys_do_not_meet_in_one_task(spark):
    text = plan(surrogate_key(spark.range(1000).select(F.col("id").cast("string").alias("k")), ["k"], "key"))
    # Only partition sizes, after their aggregate, pass through the single task.
    single = text[text.index("Exchange SinglePartition") :]
    assert "HashAggregate" in single.split("\n")[1]


def test_measures_shuffle_only_partials(spark, large_dimensions):
    star = st.Star(workspace(spark, SF_DIR).gold)
    for axis in ("region", "plan_type"):
        df = st.evaluate(star, ["sla_breach_rate_pct", "churn_rate_pct", "ticket_count"], by=[axis])
        text = plan(df)
        assert "Cartesian" not in text and "NestedLoop" not in text
        for line in text.split("\n"):
            if "FileScan" in line and "facttelemetry" in line:
                assert re.findall(r"(\w+)#\d+", line.split("[")[1].split("]")[0]) == ["sla_breach", "customer_key", "fact_month"]  # the last is not read


def test_date_axis_and_slicer_shuffle_no_fact(spark, large_dimensions):
    """Partials are per customer and month, never per customer and day."""
    star = st.filter_plan(workspace(spark, SF_DIR).star, ["NBN100", "Fibre"])
    text = plan(st.evaluate(star, ["avg_peak_latency"], by=["year", "month"]))
    shuffles = [line for line in text.split("\n") if "Exchange hashpartitioning(" in line]
    assert shuffles and not any("date_key" in line for line in shuffles)
    assert any("customer_key" in line and "_year" in line and "_month" in line for line in shuffles)


def test_months_slicer_reaches_the_scan(spark):
    kept = st.filter_date_range(workspace(spark, SF_DIR).star, months=[2, 3])
    scan = [x for x in plan(st.evaluate(kept, ["avg_peak_latency"])).split("\n") if "FileScan" in x]
    assert "GreaterThanOrEqual(date_key,20240201)" in scan[0] or "Or(" in scan[0]


def test_date_slicer_reaches_the_scan(spark):
    star = workspace(spark, SF_DIR).star
    kept = st.filter_date_range(star, years=[2024])
    scan = [x for x in plan(st.evaluate(kept, ["avg_peak_latency"])).split("\n") if "FileScan" in x]
    assert "GreaterThanOrEqual(date_key,20240101)" in scan[0] and "LessThanOrEqual(date_key,20241231)" in scan[0]


def test_feature_joins_reuse_one_partitioning(spark, large_dimensions):
    text = plan(features.churn_features(workspace(spark, SF_DIR).gold))
    # Three aggregates and the customers are partitioned by customer_key once each.
    assert len(re.findall(r"Exchange hashpartitioning\(customer_key", text)) == 4


def test_shared_dir_comes_from_the_session(spark):
    assert shared.shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")


def test_csv_header_is_checked(spark, tmp_path):
    source = tmp_path / "customers.csv"
    source.write_text("customer_id,oops\nA,1\n")
    with pytest.raises(Exception):
        tables.ingest_csv_to_bronze(spark, str(source), "customers", str(tmp_path / "bronze"))


def test_shuffle_partitions_follow_the_input(spark, tmp_path):
    spark.range(1000).write.parquet(f"{tmp_path}/a/b")
    size = sizing.bytes_of(spark, [str(tmp_path)])
    assert size == sum(f.stat().st_size for f in tmp_path.rglob("*.parquet"))
    before = spark.conf.get(sizing._INITIAL, None)
    assert sizing.fit_tasks(spark, 1) == int(before or 8)
    try:
        assert sizing.fit_tasks(spark, 100 * sizing.PARTITION_BYTES) == 300
        wide = spark.range(10).repartition("id")
        assert "hashpartitioning(id" in plan(wide) and ", 300)" in plan(wide)
        assert sizing.fit_tasks(spark, 1) == 300
        assert sizing.fit_tasks(spark, 100 * 10**12) == sizing.MAX_SHUFFLE_PARTITIONS
        assert spark.conf.get("spark.sql.files.maxPartitionBytes") == "1000000000b"
    finally:
        spark.conf.unset(sizing._INITIAL)
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_layout():
    layout = Layout("/x")
    assert (layout.silver, layout.features) == ("/x/silver", "/x/ml/churn_feature_table")
