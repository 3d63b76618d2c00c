"""Distributed operators against brute force in plain Python."""

import hashlib
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from telcolake.operators.encode import medians, one_hot_drop_first, unique_columns
from telcolake.operators.keys import surrogate_key
from telcolake.operators.split import mark_test_rows
from telcolake.plans.model import roc_auc


def test_surrogate_key_is_the_rank(spark):
    names = [f"K{i * 7919 % 5003:05d}" for i in range(5000)] + [None]
    df = spark.createDataFrame([(n,) for n in names], "name string").repartition(6)
    got = {r.name: r.key for r in surrogate_key(df, ["name"], "key").collect()}
    ranked = sorted(names, key=lambda n: (n is not None, n or ""))
    assert got == {n: i + 1 for i, n in enumerate(ranked)}


def test_surrogate_key_is_stable_when_read_twice(spark):
    df = spark.range(20_000).select(F.md5(F.col("id").cast("string")).alias("name"))
    keyed = surrogate_key(df, ["name"], "key")
    assert keyed.join(keyed.withColumnRenamed("key", "again"), "name").filter("key <> again").count() == 0


@pytest.mark.parametrize("accuracy", [100, 10_000])
def test_medians(spark, accuracy):
    rng = random.Random(5)
    columns = {
        "odd": [rng.random() for _ in range(3001)],
        "even": [rng.gauss(0, 1) for _ in range(3000)] + [None],
        "hot": [5.0 if i % 3 == 0 else rng.random() * 10 for i in range(3001)],
        "two_values": [float(i % 2) for i in range(3000)] + [None],
        "empty": [None] * 3001,
        "counts": [float(rng.randint(0, 3)) for _ in range(3001)],
    }
    rows = list(zip(*columns.values()))
    df = spark.createDataFrame(rows, ", ".join(f"{c} double" for c in columns)).repartition(5)
    expected = {
        c: statistics.median([v for v in vs if v is not None]) if any(v is not None for v in vs) else None
        for c, vs in columns.items()
    }
    assert medians(df, list(columns), accuracy) == expected


def test_median_of_four(spark):
    df = spark.createDataFrame([(1,), (2,), (3,), (10,), (None,)], "x int")
    assert medians(df, ["x"]) == {"x": 2.5}


def test_split_takes_the_first_fifth_of_each_label(spark):
    # One label holds nine tenths of the rows.
    rows = [(f"C{i}", int(i % 10 == 0)) for i in range(3003)]
    df = spark.createDataFrame(rows, "customer_id string, label int").repartition(4)
    got = {r.customer_id for r in mark_test_rows(df).filter("is_test").collect()}
    expected = set()
    for label in (0, 1):
        ids = sorted(
            (c for c, x in rows if x == label), key=lambda c: (hashlib.md5(f"{c}42".encode()).hexdigest(), c)
        )
        expected |= set(ids[: math.ceil(len(ids) / 5)])
    assert got == expected


def test_auc_counts_ties_as_half(spark):
    rng = random.Random(3)
    rows = [(round(rng.random(), 1), rng.randint(0, 1)) for _ in range(400)]
    df = spark.createDataFrame(rows, "s double, label int")
    positives = [s for s, x in rows if x]
    negatives = [s for s, x in rows if not x]
    wins = sum((p > n) + 0.5 * (p == n) for p in positives for n in negatives)
    assert roc_auc(df, "s").first().auc == pytest.approx(wins / (len(positives) * len(negatives)), abs=1e-12)


def test_one_hot(spark, rows_of):
    df = spark.createDataFrame([(1, "b"), (2, "a"), (3, None), (4, "c")], "id int, kind string")
    encoded = one_hot_drop_first(df, ["kind"])
    assert encoded.columns == ["id", "kind_b", "kind_c"]
    assert rows_of(encoded) == [(1, 1, 0), (2, 0, 0), (3, 0, 0), (4, 0, 1)]


def test_unique_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int").select("a", "b", "a")
    kept = unique_columns(df)
    assert kept.columns == ["a", "b"]
    assert tuple(kept.first()) == (1, 2)


# --- categories ---------------------------------------------------------------------------


def test_one_hot_vectors(spark):
    from telcolake.operators.encode import category_dictionaries, one_hot_vectors

    df = spark.createDataFrame([(1, "b", "x"), (2, "a", "x"), (3, None, None), (4, "c", "x"), (5, "b", "x")], "id int, k string, one string")
    dictionaries = category_dictionaries(df, ["k", "one"])
    assert sorted(map(tuple, dictionaries["k"].collect())) == [("a", 0), ("b", 1), ("c", 2)]
    encoded = one_hot_vectors(df, dictionaries)
    assert encoded.columns == ["id", "k", "one", "k_vector"]  # one value alone says nothing
    assert {r.id: r.k_vector.toArray().tolist() for r in encoded.collect()} == {1: [1, 0], 2: [0, 0], 3: [0, 0], 4: [0, 1], 5: [1, 0]}
    later = one_hot_vectors(spark.createDataFrame([(9, "new")], "id int, k string"), {"k": dictionaries["k"]})
    assert later.first().k_vector.toArray().tolist() == [0, 0]


def test_a_column_of_a_million_values(spark):
    """Neither a task nor the driver holds the values; a row's vector is one place."""
    from telcolake.operators.encode import category_dictionaries, one_hot_vectors

    df = spark.range(0, 1_200_000, 1, 8).select("id", F.lpad((F.col("id") % 1_000_000).cast("string"), 7, "0").alias("k"))
    encoded = one_hot_vectors(df, category_dictionaries(df, ["k"]))
    text = encoded._jdf.queryExecution().executedPlan().toString()
    assert "collect_set" not in text
    rows = {r.id: r.k_vector for r in encoded.filter("id in (0, 1, 999999, 1000001)").collect()}
    assert {i: (v.size, v.indices.tolist()) for i, v in rows.items()} == {0: (999_999, []), 1: (999_999, [0]), 999_999: (999_999, [999_998]), 1_000_001: (999_999, [0])}


def test_categories_meet_in_no_set(spark):
    from telcolake.operators.encode import categories

    df = spark.createDataFrame([("b", None), ("a", "x"), ("b", "x"), (None, None)], "k string, l string")
    assert categories(df, ["k", "l"]) == {"k": ["a", "b"], "l": ["x"]}
    assert categories(df.limit(0), ["k"]) == {"k": []}


# --- ingestion ------------------------------------------------------------------------------


def test_bad_rows_are_set_aside(spark, tmp_path):
    from telcolake.sources import tables

    (tmp_path / "csv").mkdir()
    header = "billing_id,customer_id,billing_month,amount_charged_aud,payment_status,payment_date,payment_method\n"
    (tmp_path / "csv" / "a.csv").write_text(header + '1,C1,2024-01-01,"1,5",paid,,card\n2,C2,short\n"3","C ""3""",2024-01-01,2,,,card,"x,y",more\n')
    (tmp_path / "csv" / "b.csv").write_text(header + "4,,,,,,\n")
    at = str(tmp_path / "bronze" / "billing_events")
    assert tables.ingest_csv_to_bronze(spark, str(tmp_path / "csv"), "billing_events", at) == tables.IngestCounts(2, 2)
    good = tables.read_bronze_table(spark, at, "billing_events").orderBy("billing_id").collect()
    assert [(r.billing_id, r.customer_id, r.amount_charged_aud) for r in good] == [("1", "C1", "1,5"), ("4", None, None)]
    aside = sorted((r.file.rsplit("/", 1)[1], r.record, r.reason, r.key) for r in tables.read_quarantine(spark, at, "billing_events").collect())
    assert aside == [("a.csv", '"3","C ""3""",2024-01-01,2,,,card,"x,y",more', "too many cells", "3"), ("a.csv", "2,C2,short", "too few cells", "2")]


def test_sets_without_bad_rows_and_without_rows(spark, tmp_path):
    from telcolake.sources import tables
    from telcolake.sources.schemas import SOURCES

    header = ",".join(SOURCES["customers"].columns) + "\n"
    for name, rows, counts in (("one", "C1" + "," * 11 + "\n", (1, 0)), ("none", "", (0, 0))):
        (tmp_path / f"{name}.csv").write_text(header + rows)
        at = str(tmp_path / name)
        assert tables.ingest_csv_to_bronze(spark, str(tmp_path / f"{name}.csv"), "customers", at) == tables.IngestCounts(*counts)
        assert tables.read_bronze_table(spark, at, "customers").count() == counts[0]
        assert tables.read_quarantine(spark, at, "customers").count() == 0


def test_raw_tables_without_quarantine_are_read(spark, tmp_path):
    from telcolake.sources import tables
    from telcolake.sources.schemas import SOURCES

    spark.createDataFrame([("C1", *[None] * 11)], SOURCES["customers"].bronze_ddl).write.parquet(f"{tmp_path}/customers")
    assert [r.customer_id for r in tables.read_bronze_table(spark, f"{tmp_path}/customers", "customers").collect()] == ["C1"]
