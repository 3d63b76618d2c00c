"""Points in intervals: against plain comparison, without nested loops."""

import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from telcolake.operators.intervals import DAY, in_intervals, interval_matches, place
from telcolake.plans import checks


def made(seed, n=300):
    draw = random.Random(seed)
    points = [(i, draw.choice(["a", "b", None]), draw.choice([None, *range(-200, 200)])) for i in range(n)]
    bounds = [None, *range(-250, 250)]
    intervals = [(draw.choice(["a", "b", "c", None]), draw.choice(bounds), draw.choice(bounds)) for _ in range(40)]
    return points, intervals


def holds(p, i):
    return p[1] is not None and p[1] == i[0] and p[2] is not None and (i[1] is None or i[1] <= p[2]) and (i[2] is None or p[2] <= i[2])


@pytest.mark.parametrize("width", [1, 7, 1000])
@pytest.mark.parametrize("seed", [1, 2])
def test_equal_to_plain_comparison(spark, width, seed):
    points, intervals = made(seed)
    p = spark.createDataFrame(points, "id int, k string, at long")
    i = spark.createDataFrame([(*x, n) for n, x in enumerate(intervals)], "k string, start long, end long, n int")
    marked = {r.id: r.inside for r in in_intervals(p, i, "at", ["k"], width).collect()}
    assert marked == {x[0]: any(holds(x, y) for y in intervals) for x in points}
    pairs = [(r.id, r.n) for r in interval_matches(p, i, "at", ["k"], width).collect()]
    assert sorted(pairs) == sorted((x[0], n) for x in points for n, y in enumerate(intervals) if holds(x, y))


def test_no_intervals_and_no_points(spark):
    none = spark.createDataFrame([], "k string, start long, end long")
    p = spark.createDataFrame([(1, "a", 5)], "id int, k string, at long")
    assert [r.inside for r in in_intervals(p, none, "at", ["k"], 10).collect()] == [False]
    assert interval_matches(p, none, "at", ["k"], 10).count() == 0
    assert in_intervals(p.limit(0), none, "at", ["k"], 10).count() == 0


def test_no_nested_loop(spark):
    names = ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold")
    p = spark.range(1000).select("id", F.lit("a").alias("k"), F.col("id").alias("at"))
    i = spark.range(50).select(F.lit("a").alias("k"), (F.col("id") * 9).alias("start"), (F.col("id") * 9 + 20).alias("end"))
    for threshold in ("-1", "10MB"):
        for name in names:
            spark.conf.set(name, threshold)
        try:
            for df in (in_intervals(p, i, "at", ["k"], 30), interval_matches(p, i, "at", ["k"], 30)):
                text = df._jdf.queryExecution().executedPlan().toString()
                assert "NestedLoop" not in text and "Cartesian" not in text
        finally:
            for name in names:
                spark.conf.unset(name)


def test_overlapping_windows_repeat_no_point(spark):
    p = spark.range(100).select("id", F.lit("a").alias("k"), F.col("id").alias("at"))
    i = spark.range(500).select(F.lit("a").alias("k"), F.lit(10).cast("long").alias("start"), (F.col("id") % 7 + 20).alias("end"))
    marked = in_intervals(p, i, "at", ["k"], 1000)
    assert marked.count() == 100 and marked.filter("inside").count() == 17


def test_places(spark):
    row = spark.sql("select date'1970-01-02' d, timestamp_ntz'1970-01-01 00:00:01.5' n, timestamp_seconds(2) t")
    got = row.select(*[place(c, k).alias(c) for c, k in row.dtypes]).first()
    assert tuple(got) == (DAY, 1_500_000, 2_000_000)


def test_windows_of_hours_and_of_days(spark):
    rows = spark.createDataFrame([("a", datetime(2024, 1, 2, h), True) for h in range(24)], "region string, date timestamp_ntz, outage_flag boolean")
    hours = spark.createDataFrame([(datetime(2024, 1, 2, 3), datetime(2024, 1, 2, 5), ["a"])], "start timestamp_ntz, end timestamp_ntz, regions array<string>")
    got = {r.in_window: r.telemetry_rows for r in checks.outage_interval_join(rows, hours).collect()}
    assert got == {True: 3, False: 21}
    # The last day of a window of days belongs to it to its end.
    days = spark.sql("select date'2024-01-01' as start, date'2024-01-02' as end, array('a') as regions")
    assert {r.in_window: r.telemetry_rows for r in checks.outage_interval_join(rows, days).collect()} == {True: 24}
    since = spark.sql("select timestamp_ntz'2024-01-02 20:00:00' as start, cast(null as timestamp_ntz) as end, array('a') as regions")
    assert {r.in_window: r.telemetry_rows for r in checks.outage_interval_join(rows, since).collect()} == {True: 4, False: 20}
