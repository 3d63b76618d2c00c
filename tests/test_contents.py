from pyspark.sql import functions as F

from telcolake.sources import tables


def test_checksum_of_many_rows_does_not_overflow(spark):
    """48-bit row digests summed over 200000 rows pass 2^63: the checksum wraps modulo 2^64, as a long."""
    df = spark.range(200_000).select(F.col("id").cast("string").alias("key"))
    row = spark.range(200_000).select(F.col("id").cast("string").alias("v"))
    digests = row.select(F.conv(F.substring(F.md5(F.col("v").cast("binary")), 1, 12), 16, 10).cast("decimal(38,0)").alias("d"))
    exact = int(digests.agg(F.sum("d")).first()[0])
    assert exact >= 2**63
    wrapped = (exact + 2**63) % 2**64 - 2**63
    [got] = tables.contents({"t": df}).collect()
    assert (got.table_name, got.row_count, got.checksum) == ("t", 200_000, wrapped)


def test_checksum_of_few_rows_is_the_plain_sum(spark):
    df = spark.createDataFrame([("a", 1.5), (None, None)], "k string, x double")
    [got] = tables.contents({"t": df}).collect()
    expected = sum(int(__import__("hashlib").md5(s.encode()).hexdigest()[:12], 16) for s in ("a|1.500000", "-|-"))
    assert (got.row_count, got.checksum) == (2, expected)
