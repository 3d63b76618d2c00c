"""Mixture-controlled packing into fixed windows by deficit round-robin.

Each source is a queue of tokens. A round gives source s a quantum of ``window * share_s``
tokens; what a queue may not yet serve stays as its deficit for the next round. Served
packets are laid end to end in the order of rounds, and the line of packets is cut into
windows, so every window but the last is full and holds the target shares up to one
packet per source. A queue that has ended leaves its part of the round to the others.

Whether a packet is served in a round depends only on its place in its queue: the packet
that ends at token e is served in round ceil(e / quantum). So the schedule needs no loop
over windows: two running totals, over the queues and over the served packets, each
range-partitioned, carry deficits across windows and partitions. A source that holds a
third of all tokens is spread over many partitions.

Defined cases: a null or empty text is the end id alone; null and empty sources are one
queue each; rows with equal or null doc_ids are packed separately; an empty table gives
no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telcolake.llm.common import cut, remove, running_total, written
from telcolake.llm.tokens import batches, encoder

WINDOW = 4096
# Sources with a smaller quantum save up deficits until they can serve this many tokens.
LEAST_PACKET = 128
# Rows of texts per Arrow batch while tokenizing: Spark's 10,000 long texts, held by a
# worker as Arrow and again as Python strings, crowd an executor beside its JVM.
TEXT_BATCH_ROWS = 1000
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"


def token_table(docs: DataFrame, tokenizer: str, end_id: int = 2) -> tuple[DataFrame, str]:
    """(row_id, doc_id, source, n, ids) of all documents in the shared folder, and its path."""
    end = np.array([end_id], "<u4").tobytes()

    def encode(parts):
        own = encoder(tokenizer)
        for batch in parts:
            texts = batch.column(3).to_pylist()
            for part in batches(texts):
                ids = [raw + end for raw in own.encode(texts[part])]
                columns = [batch.column(i).slice(part.start, part.stop - part.start) for i in range(3)]
                yield pa.RecordBatch.from_arrays([*columns, pa.array([len(i) // 4 for i in ids], pa.int64()), pa.array(ids, pa.binary())], names=["row_id", "doc_id", "source", "n", "ids"])

    rows = docs.select(F.monotonically_increasing_id().alias("row_id"), F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), "text")
    conf = docs.sparkSession.conf
    before = conf.get(ARROW_ROWS, None)
    conf.set(ARROW_ROWS, str(TEXT_BATCH_ROWS))
    try:
        return written(rows.mapInArrow(encode, "row_id long, doc_id long, source string, n long, ids binary"), "tokens")
    finally:
        conf.unset(ARROW_ROWS) if before is None else conf.set(ARROW_ROWS, before)


def schedule(sizes: DataFrame, window: int = WINDOW, shares: Mapping[str, float] | None = None) -> DataFrame:
    """Pieces (row_id, start, length, sequence_id, offset) of rows (row_id, source, n).

    ``shares`` are target token proportions per source; by default those of the corpus.
    Sources not named share what is left in proportion to their tokens; if nothing is left
    they follow in the last rounds.
    """
    sizes = sizes.withColumn("source", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")))
    queue = running_total(sizes, ["source", "row_id"], "n", "g")
    sources = sizes.groupBy("source").agg(F.sum("n").alias("tokens"))
    all_sources = Window.partitionBy()  # one row per source
    if shares is None:
        share = F.col("tokens") / F.sum("tokens").over(all_sources)
    else:
        named = sizes.sparkSession.createDataFrame([(f"s{k}", float(v)) for k, v in shares.items()], "source string, named double")
        sources = sources.join(named, "source", "left")
        others = F.sum(F.expr("if(named is null, tokens, 0)")).over(all_sources)
        share = F.coalesce("named", F.lit(max(0.0, 1.0 - sum(shares.values()))) * F.col("tokens") / others)
    quanta = sources.withColumn("quantum", F.greatest(share, F.lit(1e-6)) * window)
    starts = queue.groupBy("source").agg(F.min("g").alias("base"))
    quanta = cut(quanta.select("source", "quantum").join(starts, "source"))

    # Packets end where a queue's allowance ends, or where it has saved up enough.
    grain = F.greatest(F.col("quantum"), F.lit(float(LEAST_PACKET)))
    placed = queue.join(quanta, "source").withColumn("a", F.col("g") - F.col("base")).withColumn("grain", grain)
    k = F.explode(F.sequence(F.greatest(F.floor(F.col("a") / F.col("grain")) - 1, F.lit(0)), F.floor((F.col("a") + F.col("n")) / F.col("grain")) + 1))
    packets = placed.select("*", k.alias("k"))
    low = F.greatest(F.col("a"), F.floor(F.col("k") * F.col("grain")))
    high = F.least(F.col("a") + F.col("n"), F.floor((F.col("k") + 1) * F.col("grain")))
    packets = packets.select("row_id", "source", (low - F.col("a")).alias("start"), (high - low).alias("length"), F.ceil((F.col("k") + 1) * F.col("grain") / F.col("quantum")).alias("round")).filter("length > 0")

    line = running_total(packets, ["round", "source", "row_id", "start"], "length", "at")
    w = F.lit(window)
    cuts = line.select("*", F.explode(F.sequence(F.expr(f"at div {window}"), F.expr(f"(at + length - 1) div {window}"))).alias("sequence_id"))
    left = F.greatest(F.col("at"), F.col("sequence_id") * w)
    right = F.least(F.col("at") + F.col("length"), (F.col("sequence_id") + 1) * w)
    return cuts.select("row_id", (F.col("start") + left - F.col("at")).alias("start"), (right - left).alias("length"), "sequence_id", (left - F.col("sequence_id") * w).alias("offset"))


def pack(docs: DataFrame, tokenizer: str, window: int = WINDOW, shares: Mapping[str, float] | None = None, keep_ids: bool = True) -> DataFrame:
    """Pieces of all documents: doc_id, source, start, length, doc_tokens, sequence_id, offset, ids_crc32 and, if asked for, ids.

    Piece ids are little-endian unsigned 32-bit integers. Without ids the result is small:
    it is checkpointed, and the token table goes.
    """
    tokens, path = token_table(docs, tokenizer)
    pieces = cut(schedule(tokens.select("row_id", "source", "n"), window, shares))
    joined = tokens.join(pieces, "row_id")
    ids = F.expr("substring(ids, cast(4 * start + 1 as int), cast(4 * length as int))")
    out = joined.select("doc_id", "source", "start", "length", F.col("n").alias("doc_tokens"), "sequence_id", "offset", F.crc32(ids).alias("ids_crc32"), *[ids.alias("ids")] * keep_ids)
    if keep_ids:
        return out
    out = cut(out)
    remove(docs.sparkSession, path)
    return out


def sequences(pieces: DataFrame) -> DataFrame:
    """(sequence_id, ids) of packed pieces with ids; a sequence has at most ``window`` ids."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    return pieces.groupBy("sequence_id").agg(F.aggregate(parts, F.lit(b""), lambda a, p: F.concat(a, p["ids"])).alias("ids"))
