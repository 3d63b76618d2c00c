"""Benchmark passages in training texts through a positional inverted index.

The index holds a posting (term, doc_id, position) for each place of a term in the
training texts. A query window is a run of terms; the lists of its rarest terms are
intersected first, each shifted by the term's offset in the window, so that postings of
one occurrence meet at the same start. What is left is compared with the window word by
word. Which terms are rare is counted over all training texts.

Texts are read three times: to count, to post, and to compare the few with candidates.
Only terms that windows look up are posted: of each window, the rarest ones. A common
term's list is never shuffled, unless a window has no rarer term. Postings are keyed by
(window, document, start) when they are intersected, so no term and no document gathers.

Defined cases: null and empty texts have no words; an item without words has no window,
one with fewer words than a window is one window; items with equal windows are all
found; rows with equal doc_id and text are alike; an empty table on either side gives no
hit; other columns are ignored. Native: no Python runs in the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telcolake.llm.common import ascii_lower, cut, remove, written

# Fixed value: what a word is made of, after lower-casing A-Z.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WINDOW_WORDS = 10
RAREST = 3


def words_of(text: Column) -> Column:
    """Words of a text; A-Z is lower-cased first, which moves no word's bounds."""
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def item_windows(items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """(item_id, window): the distinct word windows of each item."""
    words = items.select("item_id", words_of(F.col("text")).alias("w")).filter(F.size("w") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("w") - size + 1, F.lit(1)))
    return words.select("item_id", F.explode(starts).alias("i"), "w").select("item_id", F.slice("w", F.col("i"), F.lit(size)).alias("window")).distinct()


def term_counts(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, count) over all texts, for the terms asked for."""
    tokens = docs.select(F.explode(words_of(F.col("text"))).alias("term"))
    return tokens.join(terms, "term", "left_semi").groupBy("term").agg(F.count("*").alias("count"))


def postings(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, doc, pos): the positional index of the terms asked for."""
    tokens = docs.select("doc", F.posexplode(words_of(F.col("text"))).alias("pos", "term"))
    return tokens.join(terms, "term", "left_semi").select("term", "doc", "pos")


def anchors(windows: DataFrame, counts: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(window_id, offset, term, bit, needed): the places of the rarest terms of each window.

    A window with a term that no text holds occurs nowhere and has no row.
    """
    places = windows.select("window_id", F.size("window").alias("size"), F.posexplode("window").alias("offset", "term"))
    known = places.join(counts, "term")
    w = Window.partitionBy("window_id")  # at most a window's words
    ranked = known.withColumn("found", F.count("*").over(w)).filter("found = size").withColumn("nth", F.row_number().over(w.orderBy("count", "term", "offset")))
    return ranked.filter(F.col("nth") <= rarest).select("window_id", "offset", "term", F.expr("shiftleft(1L, nth)").alias("bit"), F.expr(f"shiftleft(1L, least(size, {rarest}) + 1) - 2").alias("needed"))


def phrase_matches(docs: DataFrame, windows: DataFrame, rarest: int = RAREST) -> DataFrame:
    """(doc, window_id, start, length) of every exact occurrence; docs (doc, text), windows (window_id, window)."""
    # Written tables have a known size: Spark broadcasts the terms if they are few, else joins by shuffle.
    spark = docs.sparkSession
    vocabulary, vocabulary_path = written(windows.select(F.explode("window").alias("term")).distinct(), "vocabulary")
    counts = cut(term_counts(docs, vocabulary))
    looked_up = cut(anchors(windows, counts, rarest))
    terms, terms_path = written(looked_up.select("term").distinct(), "terms")
    index = cut(postings(docs, terms))
    shifted = index.join(looked_up, "term").filter("pos >= offset").select("window_id", "bit", "needed", "doc", (F.col("pos") - F.col("offset")).alias("start"))
    met = shifted.groupBy("window_id", "doc", "start").agg(F.bit_or("bit").alias("bits"), F.max("needed").alias("needed")).filter("bits = needed")
    candidates = cut(met.select("doc", "window_id", "start"))
    # The remaining words are compared in the few documents with candidates.
    few, few_path = written(candidates.select("doc").distinct(), "candidates")
    held = docs.join(few, "doc", "left_semi").select("doc", words_of(F.col("text")).alias("w"))
    per_doc = candidates.join(windows, "window_id").groupBy("doc").agg(F.collect_list(F.struct("window_id", "start", "window")).alias("c"))
    both = held.dropDuplicates(["doc"]).join(per_doc, "doc").select("doc", "w", F.explode("c").alias("c"))
    size = F.size("c.window")
    exact = both.filter(F.slice("w", F.col("c.start") + 1, size) == F.col("c.window"))
    found = cut(exact.select("doc", "c.window_id", "c.start", size.alias("length")))
    for path in (vocabulary_path, terms_path, few_path):
        remove(spark, path)
    return found


def proximity_matches(docs: DataFrame, queries: DataFrame, width: int) -> DataFrame:
    """(doc, query_id, start) where all terms of a query stand within ``width`` words, in any order.

    docs (doc, text), queries (query_id, terms). ``start`` is the first word of such a
    stretch. Lists are walked from the rarest term: only postings near one of its places
    are looked at.
    """
    wanted = queries.select("query_id", F.explode(F.array_distinct("terms")).alias("term"))
    counts = cut(term_counts(docs, wanted.select("term").distinct()))
    w = Window.partitionBy("query_id")
    ranked = wanted.join(counts, "term", "left").withColumn("nth", F.row_number().over(w.orderBy(F.coalesce("count", F.lit(0)), "term"))).withColumn("needed", F.count("*").over(w))
    index = cut(postings(docs, wanted.select("term").distinct()))
    listed = index.join(ranked, "term")
    rare = listed.filter("nth = 1").select("query_id", "doc", F.col("pos").alias("near"))
    # Stretches around a rare place lie in one or two blocks of twice the width.
    block = 2 * width
    first = rare.select("query_id", "doc", "near", F.explode(F.array_distinct(F.array(F.floor((F.col("near") - width) / block), F.floor((F.col("near") + width) / block)))).alias("block"))
    others = listed.select("query_id", "doc", "term", "pos", "needed", F.floor(F.col("pos") / block).alias("block"))
    close = first.join(others, ["query_id", "doc", "block"]).filter(F.abs(F.col("pos") - F.col("near")) < width)
    stretches = close.select("query_id", "doc", "near", F.col("pos").alias("start")).filter("start <= near").distinct()
    inside = stretches.join(close, ["query_id", "doc", "near"]).filter((F.col("pos") >= F.col("start")) & (F.col("pos") < F.col("start") + width))
    full = inside.groupBy("query_id", "doc", "near", "start").agg(F.countDistinct("term").alias("n"), F.max("needed").alias("needed")).filter("n = needed")
    return full.select("doc", "query_id", "start").distinct()


def keyed(docs: DataFrame) -> DataFrame:
    """Documents with ``doc``: doc_id and a hash of the text, which tells rows of one doc_id apart."""
    return docs.withColumn("doc", F.struct(F.col("doc_id").cast("long").alias("id"), F.xxhash64("text").alias("t")))


def contamination(docs: DataFrame, items: DataFrame, size: int = WINDOW_WORDS) -> DataFrame:
    """doc_id, doc, n_words, n_hit, items (ids as sorted strings) of every document."""
    with_items = cut(item_windows(items, size).withColumn("window_id", F.xxhash64("window")))
    windows = with_items.select("window_id", "window").distinct()
    rows = keyed(docs.select("doc_id", "text"))
    found = phrase_matches(rows.select("doc", "text"), windows)
    # Covered words: each stretch counts from where the earlier ones end.
    before = Window.partitionBy("doc").orderBy("start", "length").rowsBetween(Window.unboundedPreceding, -1)
    ends = found.select("doc", "start", "length").distinct().withColumn("reached", F.coalesce(F.max(F.col("start") + F.col("length")).over(before), F.lit(0)))
    fresh = F.greatest(F.col("start") + F.col("length") - F.greatest("start", "reached"), F.lit(0))
    hits = ends.groupBy("doc").agg(F.sum(fresh).cast("long").alias("n_hit"))
    named = found.select("doc", "window_id").distinct().join(with_items.select("window_id", "item_id"), "window_id").select("doc", F.col("item_id").cast("string").alias("item")).distinct()
    per_doc = hits.join(named.groupBy("doc").agg(F.sort_array(F.collect_set("item")).alias("items")), "doc")
    counted = rows.select("doc_id", "doc", F.size(words_of(F.col("text"))).cast("long").alias("n_words"))
    joined = counted.join(per_doc, "doc", "left")
    return joined.select("doc_id", "doc", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.coalesce("items", F.array().cast("array<string>")).alias("items"))
