"""URL verdicts: rules first, gradient-boosted trees on lexical features for the rest.

URLs that a rule decides are the labelled ones. Trees learn from them, on features of the
URL's spelling: lengths, depth, digit ratios, entropies, parameter counts, and the blocked
share of labelled URLs with the same suffix: of the last one, two and three labels of the
host, of the file name's extension, and of the first directory. They judge the URLs that no
rule fits. Which suffix goes with which verdict is counted over all labelled URLs; a URL
the trees learn from is left out of its own counts, by folds.

Large data: a suffix falls in one of ``BUCKETS`` hash buckets per kind, so the counts have a
fixed size however many hosts there are, and are broadcast. URLs are never shuffled, except
the ``FIT_ROWS`` of each verdict, chosen by hash, that the trees learn from; a repeated URL is
learned from once. Native: features are SQL expressions and the trees are Spark's own.

Defined cases: a null URL and one without ``://`` have empty host and path, and no rule; they
are judged by their features like others; repeated and null page_ids are rows of their own;
rules that fit alike are tried longest first, then by longest host, then block before allow; where
labelled URLs have one verdict only, or there are none, that verdict, or allow, is given to
all; URLs of any length are taken whole; an empty table gives no row; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassificationModel, GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from telcolake.llm.common import ascii_lower, remove, written

# Verdict, and host and path of the rule.
RULES = (
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
)

# Labelled URLs of each verdict that the trees learn from.
FIT_ROWS = 10_000
# Hash buckets per kind of suffix.
BUCKETS = 1 << 14
FOLDS = 5
# Labelled URLs that a suffix must have to count as much as all others together.
PRIOR = 5.0
TREES, DEPTH, STEP = 20, 4, 0.3

SUFFIXES = ("host1", "host2", "host3", "extension", "directory")
LEXICAL = ("url_length", "host_length", "path_length", "depth", "host_depth", "url_digits", "host_digits", "url_entropy", "host_entropy", "n_parameters", "n_hyphens")


def parsed(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES) -> DataFrame:
    """(page_id, url, host, path, rule, verdict): the rule's verdict, or null."""
    url = F.coalesce(F.col("url").cast("string"), F.lit(""))
    part = lambda i: F.regexp_extract(url, r"^(?s).*?://([^/?#]*)([^?#]*)", i)
    split = pages.select("page_id", url.alias("url"), ascii_lower(part(1)).alias("host"), part(2).alias("path"))
    host, path = F.col("host"), F.col("path")
    rule = verdict = None
    cuts = [(v, r, r.split("/", 1)[0], "/" + r.split("/", 1)[1] if "/" in r else "") for v, r in rules]
    for decides, name, its_host, its_path in sorted(cuts, key=lambda r: (-len(r[1]), -len(r[2]), r[0] != "block")):
        fits = ((host == its_host) | host.endswith("." + its_host)) & path.startswith(its_path)
        rule = F.when(fits, name) if rule is None else rule.when(fits, name)
        verdict = F.when(fits, decides) if verdict is None else verdict.when(fits, decides)
    none = F.lit(None).cast("string")
    return split.withColumn("rule", none if rule is None else rule).withColumn("verdict", none if verdict is None else verdict)


def entropy(text: Column) -> Column:
    """Bits per character, from the runs of the sorted characters."""
    chars = F.sort_array(F.regexp_extract_all(text, F.lit("(?s)."), F.lit(0)))
    weight = lambda k: k * F.log2(F.greatest(k, F.lit(1.0)))
    start = F.struct(F.lit("").alias("c"), F.lit(0.0).alias("k"), F.lit(0.0).alias("s"))

    def step(seen, char):
        k = F.when(char == seen["c"], seen["k"] + 1).otherwise(F.lit(1.0))
        return F.struct(char.alias("c"), k.alias("k"), (seen["s"] + weight(k) - weight(k - 1)).alias("s"))

    n = F.length(text).cast("double")
    return F.when(n > 0, F.log2(n) - F.aggregate(chars, start, step)["s"] / n).otherwise(F.lit(0.0))


def lexical(urls: DataFrame) -> DataFrame:
    """``urls`` with the columns ``LEXICAL`` and, per kind of suffix, its hash bucket."""
    url, host, path = F.col("url"), F.col("host"), F.col("path")
    digits = lambda c: F.length(F.translate(c, "0123456789", "##########")) - F.length(F.translate(c, "0123456789", ""))
    count = lambda c, mark: F.length(c) - F.length(F.replace(c, F.lit(mark), F.lit("")))
    ratio = lambda c: digits(c) / F.greatest(F.length(c), F.lit(1))
    query = F.regexp_extract(url, r"^[^?#]*\?([^#]*)", 1)
    measures = {
        "url_length": F.length(url),
        "host_length": F.length(host),
        "path_length": F.length(path),
        "depth": F.regexp_count(path, F.lit("/+[^/]")),
        "host_depth": count(host, "."),
        "url_digits": ratio(url),
        "host_digits": ratio(host),
        "url_entropy": entropy(url),
        "host_entropy": entropy(host),
        "n_parameters": F.when(query == "", 0).otherwise(count(query, "&") + 1),
        "n_hyphens": count(host, "-"),
    }
    suffixes = {
        **{f"host{k}": F.substring_index(host, ".", -k) for k in (1, 2, 3)},
        "extension": F.regexp_extract(path, r"\.([^./]*)$", 1),
        "directory": F.regexp_extract(path, r"^/([^/]*)/", 1),
    }
    buckets = [F.pmod(F.xxhash64(F.lit(kind), c), F.lit(BUCKETS)).alias(f"{kind}_bucket") for kind, c in suffixes.items()]
    return urls.select("*", *[c.cast("double").alias(n) for n, c in measures.items()], *buckets)


def suffix_counts(labelled: DataFrame) -> DataFrame:
    """(kind, bucket, fold, n, blocked) over all labelled URLs; at most ``BUCKETS * FOLDS`` rows a kind."""
    keys = F.explode(F.array(*[F.struct(F.lit(k).alias("kind"), F.col(f"{k}_bucket").alias("bucket")) for k in SUFFIXES]))
    return labelled.select("fold", "label", keys.alias("key")).groupBy("key.kind", "key.bucket", "fold").agg(F.count("*").cast("double").alias("n"), F.sum("label").alias("blocked"))


def with_rates(urls: DataFrame, counts: DataFrame, base: float, leave_out: bool) -> DataFrame:
    """``urls`` with the blocked share of each kind of suffix, shrunk to ``base``; without the URL's own fold if asked for."""
    n, blocked = ({f: F.coalesce(F.sum(F.when(F.col("fold") == f, F.col(c))), F.lit(0.0)) for f in range(FOLDS)} for c in ("n", "blocked"))
    shares = {f: (sum_of(blocked, f) + PRIOR * base) / (sum_of(n, f) + PRIOR) for f in (range(FOLDS) if leave_out else [None])}
    for kind in SUFFIXES:
        mine = counts.filter(F.col("kind") == kind).groupBy(F.col("bucket").alias(f"{kind}_bucket")).agg(F.array(*shares.values()).alias("_shares"))
        urls = urls.join(F.broadcast(mine), f"{kind}_bucket", "left")  # at most BUCKETS rows
        share = F.col("_shares")[F.col("fold") if leave_out else F.lit(0)]
        urls = urls.withColumn(f"{kind}_share", F.coalesce(share, F.lit(base))).drop("_shares")
    return urls


def sum_of(counts: dict[int, Column], without: int | None) -> Column:
    total = F.lit(0.0)
    for fold, count in counts.items():
        if fold != without:
            total = total + count
    return total


FEATURES = [*LEXICAL, *(f"{k}_share" for k in SUFFIXES)]


def fit(labelled: DataFrame, fit_rows: int = FIT_ROWS, seed: int = 7) -> tuple[GBTClassificationModel | None, DataFrame, float, str]:
    """(trees, suffix counts, blocked share, folder of the counts) from labelled URLs (url, host, path, label 0.0 or 1.0)."""
    spread = F.xxhash64(F.lit("fold"), "url")
    known = lexical(labelled.select("url", "host", "path", "label")).withColumn("fold", F.pmod(spread, F.lit(FOLDS)).cast("int"))
    counts, counts_path = written(suffix_counts(known), "suffix-counts")
    sizes = {r["label"]: r["n"] for r in labelled.groupBy("label").agg(F.count("*").alias("n")).collect()}  # two rows
    total = sum(sizes.values())
    base = sizes.get(1.0, 0) / total if total else 0.0
    if len(sizes) < 2:
        return None, counts, base, counts_path

    # Of each verdict the URLs with the smallest hashes; a bound on the hash first leaves little to order.
    place = F.pmod(F.xxhash64(F.lit("fit"), "url"), F.lit(1 << 40)).cast("double") / float(1 << 40)
    chosen = None
    for label, size in sizes.items():
        near = known.filter((F.col("label") == label) & (place <= 1.5 * fit_rows / size)).dropDuplicates(["url"])
        mine = near.orderBy(place, "url").limit(fit_rows)
        chosen = mine if chosen is None else chosen.unionByName(mine)
    sample, sample_path = written(with_rates(chosen, counts, base, leave_out=True).select("label", *FEATURES), "labelled-urls")
    kept = {r["label"]: r["n"] for r in sample.groupBy("label").agg(F.count("*").alias("n")).collect()}
    weight = F.when(F.col("label") == 1.0, sizes[1.0] / kept[1.0]).otherwise(sizes[0.0] / kept[0.0]) * (sum(kept.values()) / total)
    rows = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(sample.withColumn("weight", weight)).select("features", "label", "weight")
    learner = GBTClassifier(maxIter=TREES, maxDepth=DEPTH, stepSize=STEP, weightCol="weight", seed=seed)
    model = learner.fit(rows)
    remove(labelled.sparkSession, sample_path)
    return model, counts, base, counts_path


def scored(urls: DataFrame, model: GBTClassificationModel | None, counts: DataFrame, base: float) -> DataFrame:
    """``urls`` with ``score``, the trees' probability that the URL is to be blocked."""
    if model is None:
        return urls.withColumn("score", F.lit(base))
    wide = with_rates(lexical(urls), counts, base, leave_out=False)
    judged = model.transform(VectorAssembler(inputCols=FEATURES, outputCol="features").transform(wide))
    return judged.select(*urls.columns, vector_to_array("probability")[1].alias("score"))


def judge(pages: DataFrame, rules: Sequence[tuple[str, str]] = RULES, fit_rows: int = FIT_ROWS) -> DataFrame:
    """page_id, host, path, rule, verdict and score of every row of ``pages`` (page_id, url); score where no rule fits."""
    urls = parsed(pages, rules)
    ruled = urls.filter("rule is not null")
    model, counts, base, path = fit(ruled.withColumn("label", F.when(F.col("verdict") == "block", 1.0).otherwise(0.0)), fit_rows)
    open_ = scored(urls.filter("rule is null"), model, counts, base)
    open_ = open_.withColumn("verdict", F.when(F.col("score") > 0.5, "block").otherwise("allow"))
    names = ["page_id", "host", "path", "rule", "verdict", "score"]
    result, _ = written(ruled.withColumn("score", F.lit(None).cast("double")).select(names).unionByName(open_.select(names)), "url-verdicts")
    remove(pages.sparkSession, path)
    return result
