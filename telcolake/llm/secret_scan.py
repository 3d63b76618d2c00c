"""Secrets in texts: fixed patterns, and a battery of randomness tests.

Besides the base patterns, every long run of token characters is a candidate. Its
encoding is inferred (decimal, hex, base32, letters and digits, base64), its characters
become symbol numbers, and three tests ask whether the symbols look drawn at random:
chi-squared over the alphabet, runs above and below the middle, and lag-one serial
correlation. Each test is turned into a z-score; their mean square is the distance
of the candidate from randomness. Ordinary words are far away, keys are near.

A candidate is reported if it passes for random, at a distance that one in a hundred
random strings exceeds, and cannot be a word. Ordinary words, that is candidates of
lower-case letters, alone or after one capital, show what words are like: the logarithm of
their distance grows with that of their length, with a normal spread. The model is fitted
on the distinct words of the table and on ``PRIOR_WORDS`` like the ones it was first fitted
on, so that small tables have one too. It gives each distinct candidate a probability of
being as near to randomness though a word, and Benjamini and Hochberg's procedure within
each length class keeps the share of words among those reported at ``FDR``. Distinct
candidates count, so a word that many texts repeat counts once, and one key is enough.
Probabilities are counted in steps, so all classes together are a bounded table.

Defined cases: a null or empty text has no span; texts are scanned whole; equal and null
doc_ids stay separate rows; an empty table gives no row; other columns are ignored.
Native: no Python runs in the tasks.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telcolake.llm.common import cut

# The base patterns, their least lengths, and their order in results.
ASSIGN = r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24, "random": 20}
KINDS = ("assign", "access", "hex", "random")

# A run of token characters counts from its first character on.
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
DECOY = "^[A-Z]?[a-z]+$"
FDR = 0.05
# Mean square of three z-scores of random strings: one in a hundred is farther.
RANDOM = 2.2
# What words of other tables are like: log(distance) = BASE + SLOPE * log(length), give or take SPREAD.
BASE, SLOPE, SPREAD = -1.0, 0.92, 0.3
PRIOR_WORDS = {20: 5, 30: 5, 40: 5, 60: 5}
# Probabilities in tenths of their logarithm, down to 10^-40.
STEPS = 400
LENGTH_CLASS = 8
LENGTH_CLASSES = 12

# Alphabets by inferred encoding, narrowest first.
ALPHABETS = {
    "decimal": "0123456789",
    "hex": "0123456789abcdef",
    "base32": "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567",
    "base62": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz",
    "base64": "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz+/_-",
}

_PATTERNS = {"assign": ASSIGN, "access": ACCESS, "hex": "[0-9a-f]{24,}", "random": CANDIDATE}
_SPAN = "array<struct<start:int,kind:int,end:int,text:string>>"


def _places(found: Column, gaps: Column, kind: int) -> Column:
    """Spans (start, kind, end, text) of all matches: the pieces between them give their places."""
    pairs = F.zip_with(F.slice(gaps, 1, F.size(found)), found, lambda g, m: F.struct(F.length(g).alias("gap"), m.alias("text")))
    start = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("out"))

    def step(acc, p):
        first = acc["at"] + p["gap"]
        last = first + F.length(p["text"])
        span = F.struct(first.alias("start"), F.lit(kind).alias("kind"), last.alias("end"), p["text"].alias("text"))
        return F.struct(last.alias("at"), F.concat(acc["out"], F.array(span)).alias("out"))

    return F.aggregate(pairs, start, step, lambda acc: acc["out"])


def all_spans(docs: DataFrame) -> DataFrame:
    """doc_id and one column of spans per kind; ``random`` holds all candidates.

    Matches are found first; a text is cut at them only where there are any.
    """
    text = F.coalesce("text", F.lit(""))
    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("_text"), *[F.regexp_extract_all(text, F.lit(p), F.lit(0)).alias(f"_{k}") for k, p in _PATTERNS.items()])
    columns = []
    for i, kind in enumerate(KINDS):
        places = _places(F.col(f"_{kind}"), F.split("_text", _PATTERNS[kind], -1), i)
        columns.append(F.when(F.size(f"_{kind}") > 0, places).otherwise(F.array().cast(_SPAN)).alias(kind))
    spans = found.select("doc_id", *columns)
    value = lambda m: F.regexp_extract(m["text"], ASSIGN, 2)
    return spans.withColumn("assign", F.filter("assign", lambda m: F.length(value(m)) >= LEAST["assign"])).withColumn("access", F.filter("access", lambda m: F.length(m["text"]) >= LEAST["access"]))


def with_distance(candidates: DataFrame) -> DataFrame:
    """Add encoding, decoy, length, length class and the distance to rows with ``token``.

    With n symbols of k: chi-squared has mean k-1 and variance 2(k-1)(1-1/n); runs above
    and below the middle have mean (n+1)/2 and variance (n-1)/4; the lag-one sum of
    products of centred symbols has mean 0 and variance (n-1)s^4 with s^2 = (k^2-1)/12.
    """
    encoding = F.lit("base64")
    for name in reversed([n for n in ALPHABETS if n != "base64"]):
        encoding = F.when(F.col("token").rlike(f"^[{ALPHABETS[name]}]+=*$"), name).otherwise(encoding)
    rows = candidates.withColumn("encoding", encoding).withColumn("alphabet", F.element_at(F.create_map(*[F.lit(x) for kv in ALPHABETS.items() for x in kv]), F.col("encoding")))
    rows = rows.withColumn("k", F.length("alphabet").cast("double")).withColumn("v", F.expr("transform(split(rtrim('=', token), ''), c -> cast(instr(alphabet, c) - 1 as double))"))
    rows = rows.withColumn("n", F.size("v").cast("double")).withColumn("mid", (F.col("k") - 1) / 2)
    rows = (
        rows.withColumn("same", F.expr("aggregate(array_distinct(v), 0D, (a, x) -> a + pow(size(filter(v, y -> y = x)), 2))"))
        .withColumn("pairs", F.expr("zip_with(slice(v, 1, size(v) - 1), slice(v, 2, size(v) - 1), (x, y) -> struct(x - mid as x, y - mid as y))"))
        .withColumn("runs", F.expr("1 + size(filter(pairs, p -> (p.x < 0) <> (p.y < 0)))"))
        .withColumn("lagged", F.expr("aggregate(pairs, 0D, (a, p) -> a + p.x * p.y)"))
    )
    chi = F.expr("((k / n * same - n) - (k - 1)) / sqrt(2 * (k - 1) * (1 - 1 / n))")
    runs = F.expr("(runs - (n + 1) / 2) / sqrt((n - 1) / 4)")
    serial = F.expr("lagged / ((k * k - 1) / 12 * sqrt(n - 1))")
    distance = F.sqrt((chi * chi + runs * runs + serial * serial) / 3)
    rows = rows.withColumn("distance", distance).withColumn("length", F.col("n"))
    length_class = F.least(F.floor(F.col("n") / LENGTH_CLASS), F.lit(LENGTH_CLASSES)).cast("int")
    return rows.withColumn("length_class", length_class).withColumn("decoy", F.col("token").rlike(DECOY)).drop("alphabet", "v", "same", "pairs", "runs", "lagged", "mid", "k", "n")


def word_model(tokens: DataFrame) -> tuple[float, float, float]:
    """(base, slope, spread) of log(distance) over log(length), from distinct words and the prior's; six sums."""
    words = tokens.filter("decoy").select(F.log("length").alias("x"), F.log(F.greatest("distance", F.lit(0.01))).alias("y"))
    sums = words.agg(F.count("*"), F.sum("x"), F.sum("y"), F.sum(F.col("x") ** 2), F.sum(F.col("x") * F.col("y")), F.sum(F.col("y") ** 2)).first()
    n, x, y, xx, xy, yy = (float(v or 0) for v in sums)
    for length, copies in PRIOR_WORDS.items():
        u = math.log(length)
        v = BASE + SLOPE * u
        n, x, y, xx, xy, yy = n + copies, x + copies * u, y + copies * v, xx + copies * u * u, xy + copies * u * v, yy + copies * (v * v + SPREAD**2)
    slope = (n * xy - x * y) / (n * xx - x * x)
    base = (y - slope * x) / n
    return base, slope, math.sqrt(max((yy - base * y - slope * xy) / n, 1e-4))


def with_step(tokens: DataFrame, model: tuple[float, float, float]) -> DataFrame:
    """Add ``step``: minus ten times the logarithm of the probability that a word is as near to randomness."""
    base, slope, spread = model
    z = (base + slope * F.log("length") - F.log(F.greatest("distance", F.lit(0.01)))) / spread
    # The upper tail of the normal distribution, by a known approximation.
    tail = F.when(z > 0, F.log10(F.lit(2.0)) + (0.717 * z + 0.416 * z * z) / math.log(10)).otherwise(0.0)
    return tokens.withColumn("step", F.least(F.floor(10 * tail), F.lit(STEPS)).cast("int"))


def thresholds(tokens: DataFrame, fdr: float = FDR) -> DataFrame:
    """(length_class, least): the step from which distinct candidates are reported, by Benjamini and Hochberg."""
    steps = tokens.filter("not decoy").groupBy("length_class", "step").agg(F.count("*").alias("n"))
    of_class = Window.partitionBy("length_class")  # at most STEPS + 1 rows
    found = F.sum("n").over(of_class.orderBy(F.desc("step")))
    allowed = F.lit(fdr) * found / F.sum("n").over(of_class)
    return steps.withColumn("good", F.pow(F.lit(10.0), -F.col("step") / 10) <= allowed).filter("good").groupBy("length_class").agg(F.min("step").alias("least"))


def scan(docs: DataFrame, fdr: float = FDR) -> DataFrame:
    """doc_id, base (spans of the base patterns) and spans (with those the tests add), each sorted.

    Texts are read once; the spans found are checkpointed, as candidates are judged
    against all others. Thresholds are a bounded table.
    """
    found = cut(all_spans(docs).withColumn("row_id", F.monotonically_increasing_id()))
    base = F.array_sort(F.concat("assign", "access", "hex"))
    candidates = found.select("row_id", F.concat("assign", "access", "hex").alias("base"), F.explode("random").alias("span"))
    # A base span already covers these characters.
    fresh = candidates.filter(~F.exists("base", lambda b: (b["start"] < F.col("span.end")) & (F.col("span.start") < b["end"])))
    measured = cut(with_distance(fresh.select("row_id", "span", F.col("span.text").alias("token"))))
    tokens = measured.groupBy("token").agg(*[F.first(c).alias(c) for c in ("length", "length_class", "distance", "decoy")])
    model = word_model(tokens)
    least = F.broadcast(thresholds(with_step(tokens, model), fdr))  # one row per length class
    judged = with_step(measured, model).join(least, "length_class").filter((F.col("step") >= F.col("least")) & (F.col("distance") <= RANDOM))
    random = judged.filter("not decoy").groupBy("row_id").agg(F.collect_list("span").alias("more"))
    joined = found.join(random, "row_id", "left")
    spans = F.array_sort(F.concat(base, F.coalesce("more", F.array().cast(_SPAN))))
    return joined.select("doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in KINDS[:3]], base.alias("base"), spans.alias("spans"))


def span_list(spans: Column) -> Column:
    """``kind:start:end``, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda m: F.concat_ws(":", F.element_at(names, m["kind"] + 1), m["start"].cast("string"), m["end"].cast("string"))), ",")
