"""Token-ID files in patched frame-of-reference blocks.

Documents are range-partitioned by id, encoded, and written in ascending id order. A file
is a row of segments; a segment holds whole documents, its own document table and its own
block index, so segments can be read alone.

Segment (little-endian): magic ``PFR1``, u32 block length, u64 documents, u64 ids, u64
blocks, u64 bytes; document ids i64, their validity u8, ids per document u64; then for each
block its minimum u32, bit width u8, exceptions u32, and start u64 within the data; then
the data. A block holds ids minus the minimum, packed at the width that covers the chosen
percentile of the block, then the positions (u16) and values (u32) of what does not fit.

Defined cases: a null or empty text is the end id alone; a null doc_id is written first
and reads back as null; repeated ids and ties are written one after the other; an empty
table gives no segment and no row; other columns of the input are ignored.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from telcolake.llm.common import BATCH_ROWS, cut
from telcolake.llm.tokens import batches, encoder

MAGIC = b"PFR1"
_HEAD = struct.Struct("<4sIQQQQ")
BLOCK = 512
PERCENTILE = 0.9
SEGMENT_IDS = 500_000
SEGMENTS_PER_FILE = 64


def _bits(values: np.ndarray) -> np.ndarray:
    """Bits that each value needs, 0 for 0."""
    return np.where(values > 0, np.floor(np.log2(np.maximum(values, 1).astype(np.float64))) + 1, 0).astype(np.uint8)


def _spread(starts: np.ndarray, width: int) -> np.ndarray:
    return starts[:, None] + np.arange(width)


def pack_blocks(ids: np.ndarray, block: int = BLOCK, percentile: float = PERCENTILE):
    """(minimums, widths, exception counts, starts, data) of the blocks of ``ids``."""
    n = -(-len(ids) // block)
    rows = np.concatenate([ids, np.full(n * block - len(ids), ids[-1] if len(ids) else 0, "<u4")]).reshape(n, block)
    least = rows.min(axis=1)
    rest = rows - least[:, None]
    widths = _bits(np.partition(rest, int(np.ceil(percentile * block)) - 1, axis=1)[:, int(np.ceil(percentile * block)) - 1])
    over = (rest.astype(np.uint64) >> widths[:, None]) > 0
    exceptions = over.sum(axis=1).astype(np.uint32)
    packed = widths.astype(np.int64) * block // 8
    sizes = packed + 6 * exceptions.astype(np.int64)
    starts = np.cumsum(sizes) - sizes
    data = np.zeros(int(sizes.sum()), np.uint8)
    for w in np.unique(widths[widths > 0]).tolist():
        mine = np.flatnonzero(widths == w)
        bits = (rest[mine][:, :, None] >> np.arange(w, dtype=np.uint32)) & np.uint32(1)
        data[_spread(starts[mine], w * block // 8)] = np.packbits(bits.astype(np.uint8).reshape(len(mine), -1), axis=1, bitorder="little")
    at, where = np.nonzero(over)
    rank = np.arange(len(at)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions).astype(np.int64)
    first = starts[at] + packed[at]
    data[_spread(first + 2 * rank, 2)] = where.astype("<u2").view(np.uint8).reshape(-1, 2)
    data[_spread(first + 2 * exceptions[at].astype(np.int64) + 4 * rank, 4)] = rest[at, where].astype("<u4").view(np.uint8).reshape(-1, 4)
    return least, widths, exceptions, starts, data


def unpack_blocks(least, widths, exceptions, starts, data, n_ids: int, block: int = BLOCK) -> np.ndarray:
    """The ids that ``pack_blocks`` was given."""
    rest = np.zeros((len(least), block), np.uint32)
    packed = widths.astype(np.int64) * block // 8
    for w in np.unique(widths[widths > 0]).tolist():
        mine = np.flatnonzero(widths == w)
        bits = np.unpackbits(data[_spread(starts[mine], w * block // 8)], axis=1, bitorder="little").reshape(len(mine), block, w)
        rest[mine] = bits.astype(np.uint32) @ (np.uint32(1) << np.arange(w, dtype=np.uint32))
    at = np.repeat(np.arange(len(least)), exceptions)
    rank = np.arange(len(at)) - np.repeat(np.cumsum(exceptions) - exceptions, exceptions).astype(np.int64)
    first = starts[at] + packed[at]
    where = data[_spread(first + 2 * rank, 2)].reshape(-1).view("<u2")
    rest[at, where] = data[_spread(first + 2 * exceptions[at].astype(np.int64) + 4 * rank, 4)].reshape(-1).view("<u4")
    return (rest + least[:, None]).reshape(-1)[:n_ids]


def write_segment(doc_ids: list, lengths: list[int], ids: np.ndarray) -> bytes:
    least, widths, exceptions, starts, data = pack_blocks(ids)
    valid = np.array([d is not None for d in doc_ids], np.uint8)
    body = b"".join(
        [
            np.array([d or 0 for d in doc_ids], "<i8").tobytes(),
            valid.tobytes(),
            np.array(lengths, "<u8").tobytes(),
            least.astype("<u4").tobytes(),
            widths.tobytes(),
            exceptions.astype("<u4").tobytes(),
            starts.astype("<u8").tobytes(),
            data.tobytes(),
        ]
    )
    return _HEAD.pack(MAGIC, BLOCK, len(doc_ids), len(ids), len(least), len(body)) + body


def read_segments(content: bytes):
    """(doc_ids, lengths, ids) of each segment of one file's bytes."""
    at = 0
    while at < len(content):
        magic, block, n_docs, n_ids, n_blocks, size = _HEAD.unpack_from(content, at)
        if magic != MAGIC:
            raise ValueError("not a token file")
        at += _HEAD.size
        parts = []
        for kind, n in (("<i8", n_docs), ("u1", n_docs), ("<u8", n_docs), ("<u4", n_blocks), ("u1", n_blocks), ("<u4", n_blocks), ("<u8", n_blocks)):
            parts.append(np.frombuffer(content, kind, n, at))
            at += parts[-1].nbytes
        doc_ids, valid, lengths, least, widths, exceptions, starts = parts
        held = n_docs * 17 + n_blocks * 17
        data = np.frombuffer(content, np.uint8, size - held, at)
        at += size - held + 1  # the sink ends each segment with one byte
        ids = unpack_blocks(least, widths, exceptions, starts.astype(np.int64), data, n_ids, block)
        yield [d if v else None for d, v in zip(doc_ids.tolist(), valid.tolist())], lengths.astype(np.int64), ids


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int = 2) -> None:
    """Encode ``docs`` (doc_id, text) and write token files below ``path`` in ascending doc_id order.

    The text is shuffled once, by range of doc_id, before it is encoded: sampling the
    bounds then costs no encoding. Spark's sink commits the files, so lost tasks are safe.
    """
    end = np.array([end_id], "<u4").tobytes()

    def segments(parts):
        own = encoder(tokenizer)
        doc_ids, pieces, held = [], [], 0

        def flush():
            raw = np.frombuffer(b"".join(pieces), "<u4")
            blob = write_segment(doc_ids, [len(p) // 4 for p in pieces], raw)
            return pa.RecordBatch.from_arrays([pa.array([blob], pa.binary())], names=["segment"])

        for batch in parts:
            names, texts = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for part in batches(texts):
                for doc_id, raw in zip(names[part], own.encode(texts[part])):
                    doc_ids.append(doc_id)
                    pieces.append(raw + end)
                    held += len(raw) // 4 + 1
                    if held >= SEGMENT_IDS:
                        yield flush()
                        doc_ids, pieces, held = [], [], 0
        if doc_ids:
            yield flush()

    ordered = docs.select(F.col("doc_id").cast("long"), "text").repartitionByRange("doc_id").sortWithinPartitions("doc_id")
    # The text sink writes the bytes of a string as they are.
    ordered.mapInArrow(segments, "segment binary").select(F.col("segment").cast("string").alias("value")).write.option("lineSep", "\n").option("maxRecordsPerFile", SEGMENTS_PER_FILE).text(path)


def read_token_files(spark: SparkSession, path: str, keep_ids: bool = True) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32 and, if asked for, ids.

    ``start`` counts the ids of all documents before it. Files are ordered by their first
    doc_id, then by name; one number per file is summed in one task.
    """
    schema = "path string, seq long, doc_id long, within long, n_tokens long, ids_crc32 long" + (", ids binary" if keep_ids else "")

    def rows(parts):
        for batch in parts:
            for name, content in zip(batch.column(0).to_pylist(), batch.column(1)):
                within = seq = 0
                for doc_ids, lengths, ids in read_segments(content.as_buffer()):
                    ends = np.cumsum(lengths)
                    raws = [ids[e - n : e].astype("<u4").tobytes() for e, n in zip(ends.tolist(), lengths.tolist())]
                    for i in range(0, len(raws), BATCH_ROWS):
                        part = slice(i, i + BATCH_ROWS)
                        n = len(raws[part])
                        columns = [
                            pa.array([name] * n),
                            pa.array(range(seq + i, seq + i + n), pa.int64()),
                            pa.array(doc_ids[part], pa.int64()),
                            pa.array(within + (ends - lengths)[part]),
                            pa.array(lengths[part]),
                            pa.array([zlib.crc32(r) for r in raws[part]], pa.int64()),
                        ]
                        yield pa.RecordBatch.from_arrays(columns + [pa.array(raws[part], pa.binary())] * keep_ids, names=[c.split()[0] for c in schema.split(", ")])
                    within += int(lengths.sum())
                    seq += len(doc_ids)

    files = spark.read.format("binaryFile").load(path).select("path", "content")
    docs = files.mapInArrow(rows, schema)
    if not keep_ids:
        docs = cut(docs)
    per_file = docs.groupBy("path").agg(F.sum("n_tokens").alias("size"), F.min(F.struct("seq", "doc_id"))["doc_id"].alias("first"))
    before = Window.orderBy(F.col("first").asc_nulls_first(), "path").rowsBetween(Window.unboundedPreceding, -1)
    starts = per_file.select("path", F.coalesce(F.sum("size").over(before), F.lit(0)).cast("long").alias("base"))
    kept = ["n_tokens", "ids_crc32"] + ["ids"] * keep_ids
    return docs.join(starts, "path").select("doc_id", (F.col("base") + F.col("within")).alias("start"), *kept)
