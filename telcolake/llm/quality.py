"""Quality by document evidence and the record of its site: hierarchical empirical Bayes.

A logistic classifier gives each document a probability from counts of its whole text.
These are summed per path of a host, per host, and over all. Rates shrink in two steps: a
host's towards the global rate, a path's towards its host's, each with a prior strength
fitted by moments over all hosts or paths, so that sparse sites say little. A document's
own evidence is taken out of its site's sums; what is left shifts its log-odds from the
global base rate to that of its path. Sums are partial aggregates: a host with a third of
all documents reaches the shuffle as one row per task.

The classifier is fitted on at most ``FIT_ROWS`` labelled documents, chosen by a hash of
doc_id; rates and priors cover all documents.

Defined cases: null and empty texts have zero counts; null hosts and paths are one host
and one path each; null labels are left out, contradicting ones count as bad; without
labels of both kinds the classifier gives 0.5 and every document is kept; equal and null
doc_ids stay separate rows; an empty table gives no row; other columns are kept.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolake.llm.common import cut, remove, written
from telcolake.llm.host_rules import repeated_words

FIT_ROWS = 20_000
THRESHOLD = 0.5
# A site's record moves log-odds at most this far.
MOST_SHIFT = 3.0

_MARKED = re.compile(r"[^\w\s.,;:'’)\]-]+(?=\s|$)").findall
FEATURES = ("words", "length", "marked", "bars", "upper", "digits", "marks", "distinct", "repeated", "lines", "dup_lines", "short", "long")


_LETTERS = re.compile(r"[^\W\d_]+").findall


def features(text: str | None) -> list[float]:
    """Scale-free counts of a whole text, in the order of ``FEATURES``."""
    text = text or ""
    words = text.split()
    n = max(1, len(words))
    chars = max(1, len(text))
    letters = sum(map(len, _LETTERS(text)))
    lines = [x for x in text.split("\n") if x.strip()]
    upper = sum(1 for w in words if len(w) > 2 and w.isupper())
    return [
        np.log1p(len(words)),
        np.log1p(chars / n),
        len(_MARKED(text)) / n,
        words.count("|") / n,
        upper / n,
        sum(text.count(d) for d in "0123456789") / chars,
        1 - letters / chars,
        len(set(words)) / n,
        repeated_words(words) / n,
        len(lines) / n,
        1 - len(set(lines)) / max(1, len(lines)),
        sum(1 for w in words if len(w) <= 3) / n,
        sum(1 for w in words if len(w) > 15) / n,
    ]


@dataclass
class Classifier:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray

    def probability(self, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(_expand((x - self.mean) / self.scale) @ self.weights, -12, 12)))


def _expand(z: np.ndarray) -> np.ndarray:
    z = np.clip(z, -6, 6)
    return np.c_[z, z * z, np.ones(len(z))]


def train(x: np.ndarray, y: np.ndarray, ridge: float = 1.0) -> Classifier:
    """Logistic regression on features and their squares, by Newton steps."""
    mean, scale = x.mean(axis=0), np.maximum(x.std(axis=0), 1e-6)
    z = _expand((x - mean) / scale)
    w = np.zeros(z.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (p - y) + ridge * w
        hess = (z * (p * (1 - p))[:, None]).T @ z + ridge * np.eye(len(w))
        step = np.linalg.solve(hess, grad)
        w = w - np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-6:
            break
    return Classifier(mean, scale, w)


def fit(docs: DataFrame, labels: DataFrame) -> Classifier | None:
    known = labels.filter("doc_id is not null and quality is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min("quality").alias("quality"))
    sample = cut(known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(FIT_ROWS))

    def measure(parts):
        for batch in parts:
            rows = [features(t.as_py()) for t in batch.column(0)]
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64())), batch.column(1), batch.column(2)], names=["x", "quality", "doc_id"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), "doc_id")  # FIT_ROWS pairs of numbers
    found = texts.select("text", F.col("quality").cast("int").alias("quality"), "doc_id").mapInArrow(measure, "x array<double>, quality int, doc_id long").dropDuplicates(["doc_id"]).orderBy("doc_id").collect()
    y = np.array([r["quality"] for r in found], float)
    if len(set(y.tolist())) < 2:
        return None
    return train(np.array([r["x"] for r in found]), y)


def _strength(n: float, s: float, squares: float, pairs: float) -> float:
    """Prior strength by moments from sums over groups of n, s, s^2 - (sum of squares) and n(n-1)."""
    mean = (s + 0.5) / (n + 1)
    between = max((squares / pairs if pairs else mean * mean) - mean * mean, 1e-6)
    return float(np.clip(mean * (1 - mean) / between - 1, 1.0, 1e5))


def judge(docs: DataFrame, labels: DataFrame, host: str = "source", path: str = "lang") -> DataFrame:
    """Documents have no path; their language stands for it below the host.

    doc_id, text_hash, evidence, site_rate, posterior and kept of each document."""
    model = fit(docs, labels)

    def score(parts):
        for batch in parts:
            x = np.array([features(t.as_py()) for t in batch.column(4)]).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(model.probability(x))], names=["doc_id", "host", "path", "text_hash", "evidence"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col(host).cast("string"), F.lit("")).alias("host"), F.coalesce(F.col(path).cast("string"), F.lit("")).alias("path"), F.xxhash64("text").alias("text_hash"), "text")
    if model is None:
        even = F.lit(0.5)
        return rows.select("doc_id", "text_hash", even.alias("evidence"), even.alias("site_rate"), even.alias("posterior"), F.lit(True).alias("kept"))
    rows = cut(rows.mapInArrow(score, "doc_id long, host string, path string, text_hash long, evidence double"))

    e = F.col("evidence")
    paths = rows.groupBy("host", "path").agg(F.count("*").cast("double").alias("n"), F.sum(e).alias("s"), F.sum(e * e).alias("q"))
    hosts = paths.groupBy("host").agg(F.sum("n").alias("hn"), F.sum("s").alias("hs"), F.sum("q").alias("hq"))
    paths, paths_path = written(paths, "paths")
    hosts, hosts_path = written(hosts, "hosts")
    of_hosts = hosts.agg(F.sum("hn"), F.sum("hs"), F.sum(F.col("hs") ** 2 - F.col("hq")), F.sum(F.col("hn") * (F.col("hn") - 1))).first()
    of_paths = paths.agg(F.sum("n"), F.sum("s"), F.sum(F.col("s") ** 2 - F.col("q")), F.sum(F.col("n") * (F.col("n") - 1))).first()
    k_host = _strength(*[x or 0.0 for x in of_hosts])
    k_path = _strength(*[x or 0.0 for x in of_paths])
    base = ((of_hosts[1] or 0.0) + 0.5) / ((of_hosts[0] or 0.0) + 1)

    sites, sites_path = written(paths.join(hosts, "host").select("host", "path", "n", "s", "hn", "hs"), "sites")
    joined = rows.join(sites, ["host", "path"])
    host_rate = (F.col("hs") - e + base * k_host) / (F.col("hn") - 1 + k_host)
    path_rate = (F.col("s") - e + host_rate * k_path) / (F.col("n") - 1 + k_path)
    rate = F.greatest(F.lit(1e-4), F.least(F.lit(1 - 1e-4), path_rate))
    logit = lambda p: F.log(p / (1 - p))
    shift = F.greatest(F.lit(-MOST_SHIFT), F.least(F.lit(MOST_SHIFT), logit(rate) - logit(F.lit(base))))
    posterior = 1 / (1 + F.exp(-(logit(F.greatest(F.lit(1e-6), F.least(F.lit(1 - 1e-6), e))) + shift)))
    out = cut(joined.select("doc_id", "text_hash", "evidence", rate.alias("site_rate"), posterior.alias("posterior"), (posterior >= THRESHOLD).alias("kept")))
    for each in (paths_path, hosts_path, sites_path):
        remove(docs.sparkSession, each)
    return out
