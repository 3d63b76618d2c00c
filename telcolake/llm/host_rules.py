"""Host-level quality rules with an empirical beta prior.

Every text gets counts and rule failures. Failures are summed per host; over all hosts a
beta prior is fitted to each rule's failure rates by the method of moments, and each
host's rate is shrunk towards it, so that a host with few documents is not judged by
them alone. A host is rejected when, for one of the rules, even the low end of the
posterior rate (two standard deviations below the mean) is over the limit; its documents
then go whatever their own counts are. Host sums are partial aggregates, so a host that
holds a third of all rows reaches the shuffle as one row per task.

Defined cases: null and empty texts have no words and fail; null hosts are one host;
equal and null doc_ids stay separate rows; an empty table gives no row; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telcolake.llm.common import cut, remove, written

MIN_WORDS = 50
MAX_REPEAT = 0.5
MAX_SYMBOLS_PER_WORD = 1.0
MAX_DUP_LINES_PER_WORD = 0.1
# A host is rejected when its rate of failing documents is over this with two deviations to spare.
HOST_LIMIT = 0.8

SYMBOLS = b"#*$%&|<>"
WHITE = " \t\n\x0b\x0c\r"
RULES = ("short", "repeats", "symbols", "lines")


def repeated_words(words: list, n: int = 3) -> int:
    """Words in windows of ``n`` words that occur twice or more, the first included."""
    if len(words) <= n:
        return 0
    known: dict = {}
    ids = np.fromiter((known.setdefault(w, len(known)) for w in words), np.int64, len(words))
    key = ids[: len(ids) - n + 1]
    for k in range(1, n):
        # Renumbering keeps the keys small, whatever the length of the text.
        if k > 1:
            key = np.unique(key, return_inverse=True)[1]
        key = key * len(known) + ids[k : len(ids) - n + 1 + k]
    _, place, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = counts[place] > 1
    hit = np.zeros(len(ids), bool)
    for k in range(n):
        hit[k : k + len(twice)] |= twice
    return int(hit.sum())


def counts(text: str | None) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of a whole text."""
    text = text or ""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()  # bytes split at ASCII white space only
    lines = [line for line in text.split("\n") if line.strip(WHITE)]
    chars = len(text) - sum(raw.count(c) for c in WHITE.encode())
    return len(words), chars, sum(raw.count(c) for c in SYMBOLS), len(lines) - len(set(lines)), repeated_words(words)


def count_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, host, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words) of docs (doc_id, source, text)."""
    names = ["doc_id", "host", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]

    def measure(parts):
        for batch in parts:
            found = [counts(t.as_py()) for t in batch.column(2)]
            values = np.array(found, np.int64).reshape(-1, 5)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *[pa.array(values[:, i]) for i in range(5)]], names=names)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("host"), "text")
    return rows.mapInArrow(measure, "doc_id long, host string, " + ", ".join(f"{n} long" for n in names[2:]))


def failures() -> dict[str, Column]:
    n = F.col("n_words")
    return {
        "short": n < MIN_WORDS,
        "repeats": F.col("n_repeat_words") > MAX_REPEAT * n,
        "symbols": F.col("n_symbols") > MAX_SYMBOLS_PER_WORD * n,
        "lines": F.col("n_dup_lines") > MAX_DUP_LINES_PER_WORD * n,
    }


def beta_prior(n_hosts: int, total: float, failed: float, squares: float, pairs: float) -> tuple[float, float]:
    """(a, b) by moments from sums over hosts of n, f, f(f-1) and n(n-1); one host gives the rate itself, weakly held."""
    mean = (failed + 0.5) / (total + 1)
    second = squares / pairs if pairs else mean * mean
    variance = max(second - mean * mean, 1e-6)
    strength = min(max(mean * (1 - mean) / variance - 1, 1.0), 1e6) if n_hosts > 1 else 1.0
    return mean * strength, (1 - mean) * strength


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """(host, n_docs, rate_<rule>..., host_rejected) with shrunk failure rates."""
    hosts = cut(rows.groupBy(F.coalesce("host", F.lit("")).alias("host")).agg(F.count("*").alias("n_docs"), *[F.sum(c.cast("long")).alias(name) for name, c in failures().items()]))
    n = F.col("n_docs").cast("double")
    sums = [F.sum(x).alias(f"{r}_{k}") for r in RULES for k, x in (("f", F.col(r)), ("ff", F.col(r).cast("double") * (F.col(r) - 1)))]
    got = hosts.agg(F.count("*").alias("hosts"), F.sum(n).alias("n"), F.sum(n * (n - 1)).alias("nn"), *sums).first()
    rejected, rates = F.lit(False), []
    for rule in RULES:
        a, b = beta_prior(got["hosts"], got["n"] or 0, got[f"{rule}_f"] or 0, got[f"{rule}_ff"] or 0, got["nn"] or 0)
        total = n + a + b
        mean = (F.col(rule) + a) / total
        low = mean - 2 * F.sqrt(mean * (1 - mean) / (total + 1))
        rates.append(mean.alias(f"rate_{rule}"))
        rejected = rejected | (low > limit)
    return hosts.select("host", "n_docs", *rates, rejected.alias("host_rejected"))


def judge(docs: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """Counts, base_failed, host rates and kept for each document."""
    rows = cut(count_rows(docs))
    # A written table has a known size and no partitioning, so Spark may broadcast it or split hot hosts.
    verdicts, path = written(host_verdicts(rows, limit), "hosts")
    failed = failures()
    out = rows.withColumn("host", F.coalesce("host", F.lit(""))).join(verdicts, "host", "left")
    out = out.withColumn("base_failed", failed["short"] | failed["repeats"])
    out = cut(out.withColumn("kept", ~F.col("base_failed") & ~F.col("host_rejected")))
    remove(docs.sparkSession, path)
    return out
