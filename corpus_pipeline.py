"""From raw documents to packed training windows, in stages over the operators of ``telcolake.llm``.

Each stage takes (spark, docs, sf_dir) and returns the documents it leaves, with the
columns of documents; the last returns the pieces of packed windows with their token ids.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from telcolake.llm import decontaminate, jaccard_join, line_dedup, packing, quality
from telcolake.llm.common import cut, join_hot, ready, remove, table, written

TOKENIZER = "word_bpe_49k.json"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier and their site's record reject go."""
    ready(spark)
    judged = quality.judge(docs, table(spark, sf_dir, "labels"))
    rejected = judged.filter("not kept").select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__hash")).distinct()
    mine = F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.xxhash64("text") == F.col("__hash"))
    return docs.join(rejected, mine, "left_anti")


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines repeated in other documents go; documents stay."""
    ready(spark)
    kept = line_dedup.drop_lines(docs)
    return kept.withColumn("text", F.col("_kept")).withColumn("n_chars", F.length("_kept").cast(docs.schema["n_chars"].dataType)).select(docs.columns)


def jaccard_join_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near duplicates one document stays: the smallest doc_id, then the smallest text hash.

    Rows of one doc_id and text are one document, also without doc_id; documents without
    words are in no group and stay.
    """
    ready(spark)
    found, path = written(jaccard_join.similar_sets(docs), "groups")
    me = F.struct(F.col("doc_id").isNull().alias("without"), "doc_id", "text_hash")
    chosen = found.filter("component is not null").groupBy("component").agg(F.min(me).alias("chosen"), F.count("*").alias("size"))
    others = join_hot(found, chosen, "component", "size").filter(~me.eqNullSafe(F.col("chosen")))
    gone = cut(others.select(F.struct(F.col("doc_id").alias("id"), F.col("text_hash").alias("t")).alias("__gone")).distinct())
    remove(spark, path)
    mine = F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("t"))
    left = docs.withColumn("__mine", mine).join(gone, F.col("__mine").eqNullSafe(F.col("__gone")), "left_anti")
    return left.dropDuplicates(["__mine"]).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a passage of a benchmark item go."""
    ready(spark)
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    dirty = found.filter("n_hit > 0").select(F.col("doc").alias("__doc")).distinct()
    mine = F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("t"))
    return docs.join(dirty, mine.eqNullSafe(F.col("__doc")), "left_anti")


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of windows that hold every source in its share, with their token ids and the checksums of these."""
    ready(spark)
    return packing.pack(docs, public_tokenizers.path(TOKENIZER))


STAGES = [
    ("quality classifier", quality_classifier),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", jaccard_join_stage),
    ("benchmark decontamination", decontamination),
    ("packing", packing_stage),
]

# Neither the classifier nor the tokenizer can be put in SQL; tests/llm holds the stages against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the supplied documents; each is written and read again."""
    docs, before = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES:
        docs, path = written(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-").lower())
        if before:
            remove(spark, before)
        before = path
    return docs
