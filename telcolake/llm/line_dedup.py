"""Repeated lines across documents: which lines to keep, as run-length bitmaps.

Lines are hashed (128 bits), range-partitioned by hash, and sorted inside by document,
largest first, and position. The stream of one hash then starts with the lines to keep;
from the third document on the hash is known to be repeated. Hashes that very many
documents share would fill a partition: they are found first by a bounded frequency
sketch, and counted by partial aggregation instead; both ways give the same rows.

The result is one row per document with lines to drop: alternating lengths of kept and
dropped runs, starting with kept. Texts are not shuffled to find them.

A line's key is the line without ASCII white space at its ends, A-Z lower-cased.

Defined cases: a null or empty text is one empty line; rows with equal doc_id count as
one document and are treated alike; null doc_ids count as one document below all others;
an empty table gives no row; other columns are kept by ``drop_lines`` and else ignored.
Native: no Python runs in the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telcolake.llm.common import ascii_lower, cut

MIN_CHARS = 20
MIN_DOCS = 3
# The sketch names at most so many hot hashes, and finds all with over 1/2000 of the lines.
HOT_HASHES = 1000
SKETCH_ITEMS = 8192

WHITE = " \t\n\x0b\x0c\r"
_NULL_ID = -(2**63)


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(WHITE)))


def occurrences(docs: DataFrame, min_chars: int) -> DataFrame:
    """(h1, h2, doc, text_hash, pos) of every line whose key is long enough."""
    lines = docs.select(
        F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)).alias("doc"),
        F.xxhash64("text").alias("text_hash"),
        F.posexplode(F.transform(lines_of(F.col("text")), lambda line: F.when(F.length(line) >= min_chars, line_key(line)))).alias("pos", "key"),
    ).filter(F.length("key") >= min_chars)
    # A second seed gives an independent second half.
    return lines.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), "doc", "text_hash", "pos")


def dropped_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, text_hash, pos) of the lines to drop."""
    found = cut(occurrences(docs, min_chars))
    hot = found.agg(F.expr(f"approx_top_k(h1, {HOT_HASHES}, {SKETCH_ITEMS})").alias("top"), F.count("*").alias("n"))
    hot = hot.select(F.explode("top").alias("t"), "n").filter("t.count * 2000 > n").select(F.col("t.item").alias("h1"))
    hot = F.broadcast(cut(hot))  # at most HOT_HASHES rows

    # Cold hashes: every group is small, one stream per hash.
    cold = found.join(hot, "h1", "left_anti")
    ordered = cold.repartitionByRange("h1").sortWithinPartitions("h1", "h2", F.desc("doc"), "text_hash", "pos")
    stream = Window.partitionBy("h1", "h2").orderBy(F.desc("doc"))
    whole = Window.partitionBy("h1", "h2")
    ranked = ordered.withColumn("nth", F.dense_rank().over(stream)).withColumn("docs", F.max("nth").over(whole))
    cold_drops = ranked.filter((F.col("docs") >= min_docs) & (F.col("nth") > 1))

    # Hot hashes: counted over (hash, document), which spreads them, then joined back.
    warm = found.join(hot, "h1", "left_semi")
    counts = warm.select("h1", "h2", "doc").distinct().groupBy("h1", "h2").agg(F.count("*").alias("docs"), F.max("doc").alias("keeper"))
    repeated = F.broadcast(counts.filter(F.col("docs") >= min_docs))  # few keys per hot h1
    hot_drops = warm.join(repeated, ["h1", "h2"]).filter("doc <> keeper")
    columns = ["doc", "text_hash", "pos"]
    return cold_drops.select(columns).unionByName(hot_drops.select(columns))


def keep_bitmaps(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """(doc, text_hash, runs, tail_from): the compressed keep bitmap of each document that loses lines.

    ``runs`` alternates kept and dropped run lengths; lines from ``tail_from`` on are kept.
    """
    per_doc = dropped_lines(docs, min_chars, min_docs).groupBy("doc", "text_hash").agg(F.sort_array(F.collect_set("pos")).alias("p"))
    starts = F.expr("filter(p, (x, i) -> i = 0 or x <> p[i - 1] + 1)")
    ends = F.expr("filter(p, (x, i) -> i = size(p) - 1 or x <> p[i + 1] - 1)")
    bounds = per_doc.select("doc", "text_hash", starts.alias("starts"), ends.alias("ends"))
    previous = F.concat(F.array(F.lit(-1)), F.slice("ends", 1, F.size("ends") - 1))
    kept = F.zip_with("starts", previous, lambda s, e: s - e - 1)
    gone = F.zip_with("starts", "ends", lambda s, e: e - s + 1)
    runs = F.flatten(F.zip_with(kept, gone, lambda k, d: F.array(k, d)))
    return bounds.select("doc", "text_hash", runs.alias("runs"), (F.element_at("ends", -1) + 1).alias("tail_from"))


def drop_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with columns _kept (text of the kept lines), _n_lines and _n_dropped."""
    bitmaps = keep_bitmaps(docs.select("doc_id", "text"), min_chars, min_docs).toDF("_doc", "_hash", "_runs", "_tail")
    keyed = docs.withColumn("_doc", F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID))).withColumn("_hash", F.xxhash64("text"))
    joined = keyed.join(bitmaps, ["_doc", "_hash"], "left").withColumn("_n_lines", F.size(lines_of(F.col("text"))))
    flags = F.concat(
        F.flatten(F.transform("_runs", lambda n, i: F.array_repeat(i % 2 == 0, n))),
        F.array_repeat(F.lit(True), F.col("_n_lines") - F.col("_tail")),
    )
    # Joining an array leaves nulls out.
    kept = F.array_join(F.zip_with(lines_of(F.col("text")), flags, lambda line, keep: F.when(keep, line)), "\n")
    dropped = F.expr("coalesce(aggregate(transform(_runs, (n, i) -> if(i % 2 = 1, n, 0)), 0, (a, n) -> a + n), 0)")
    out = joined.withColumn("_kept", F.when(F.col("_runs").isNull(), F.coalesce("text", F.lit(""))).otherwise(kept))
    return out.withColumn("_n_dropped", dropped).drop("_doc", "_hash", "_runs", "_tail")
