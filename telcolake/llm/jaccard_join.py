"""Exact Jaccard join of shingle sets through pivot regions.

Documents with the same shingle set are one point of the metric space. Pivots are single
shingles: against whole documents as pivots nearly all Jaccard distances are 1 and no
region separates anything, while a pivot {s} is near exactly the sets that hold s. Ties
between pivots go to the first in one global order (rare before frequent shingles, then
by hash), which puts a set into the Voronoi region of its first shingle. The triangle
inequality bounds what a set within distance r may lack, |A - B| <= r|A|, so a set is
replicated to the regions of its first floor(r|A|)+1 shingles; any two sets within r then
meet in the region of their first common shingle. Inside a region two windows follow from
the same bound: on sizes, and on the number of shingles before the region's pivot.

A region is joined recursively: a few members become pivots, are compared with the others,
and what they link needs no further comparison, since links only matter up to connected
components; members that became pivots leave the region, those with most links go first,
and the rest is joined in the next round, until every region holds one component or has
no member left to compare. So a group of thousands of near copies costs a few comparisons
per member, not one per pair. Each round takes more pivots (``PIVOTS``), as what earlier ones
linked is left out. From the second round on a member meets a pivot only if their parity bits allow it: each shingle flips one
of ``BITS`` bits of its set, so two sets differ in at least as many shingles as their bits
differ. Unlike documents that share a passage fall out there, before they are a pair; what
is left grows with the links. Members of a large region are dealt over several tasks, and
its pivots, which are few, go to each.

Frequent shingles would make large regions of unlike documents. They are counted over all
sets and moved to the end of the order; the order decides only where sets meet, so the
result stays exact.

Defined cases: null and empty texts, and texts without words, have the empty set and link
with nothing; a text with fewer words than a shingle is one shingle; rows with equal
doc_id are separate rows with the component of their set; a set that only null doc_ids
hold links with nothing but its equals and has a null component; an empty table gives no
row; other columns are ignored. Sets are told apart by 64-bit numbers.
"""

from __future__ import annotations

from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from telcolake.llm.common import cut, release, remove, written
from telcolake.llm.shingles import shingle_sets

SHINGLE_WORDS = 5
SIMILARITY = 80  # percent, exact integers
# Shingles in more sets than this go last in the order; raised so that they number at most HOT_SHINGLES.
HOT_SETS = 40
HOT_SHINGLES = 500_000
# Shingles kept beyond the replication window, so that frequent ones can be passed over.
EXTRA_SHARE, EXTRA = 0.12, 16
# Pivots of a region in the first rounds, and in all later ones: few as long as a pivot links many.
PIVOTS = (1, 16, 512)
# Members of a region in one task.
TASK_MEMBERS = 4096
# Edges in one task while components are found, and the least number of tasks.
TASK_EDGES = 500_000
LEAST_TASKS = 16
# Parity bits of a set, in words of 64.
BITS = 512


def window(n: np.ndarray | int, percent: int):
    """Regions a set of ``n`` shingles is replicated to: n - ceil(t n) + 1."""
    return n - -(-n * percent // 100) + 1


def set_number(s: np.ndarray) -> int:
    """A 64-bit number of a set of hashes."""
    with np.errstate(over="ignore"):
        total, other = np.add.reduce(s), np.bitwise_xor.reduce(s * (s | np.uint64(1)))
        return int(((total ^ (other * np.uint64(0x9E3779B97F4A7C15))) + np.uint64(len(s))).astype(np.int64)) if len(s) else 0


def _first(sets: np.ndarray, hot: np.ndarray, count: int) -> np.ndarray | None:
    """The first ``count`` shingles in the global order among a low-hash part; None if too many are hot."""
    where = np.searchsorted(hot, sets)
    frequent = hot[np.minimum(where, len(hot) - 1)] == sets if len(hot) else np.zeros(len(sets), bool)
    rare = sets[~frequent]
    return rare[:count] if len(rare) >= count else None


def parities(sets: list[np.ndarray]) -> np.ndarray:
    """``BITS`` bits of each set as 64-bit words: whether a bit's shingles are odd in number."""
    sizes = [len(s) for s in sets]
    places = np.concatenate([*sets, np.zeros(0, np.uint64)]) % np.uint64(BITS)
    owner = np.repeat(np.arange(len(sets)), sizes)
    counts = np.bincount(owner * BITS + places.astype(np.int64), minlength=len(sets) * BITS)
    return np.packbits((counts & 1).astype(np.uint8)).view(np.int64).reshape(len(sets), BITS // 64)


def _slices(texts: list):
    start = size = 0
    for i, t in enumerate(texts):
        size += len(t or "")
        if size > 1_000_000:
            yield texts[start : i + 1]
            start, size = i + 1, 0
    if start < len(texts):
        yield texts[start:]


def points(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """(doc_id, n, cls, low, bits): size, number, lowest hashes and parity bits of each document's set."""

    def sets(parts):
        for batch in parts:
            ids, texts = batch.columns[0], batch.column(1).to_pylist()
            at = 0
            for part in _slices(texts):
                found = shingle_sets(part, words)
                n = np.array([len(s) for s in found], np.int64)
                cls = np.array([set_number(s) for s in found], np.int64)
                low = [s[: window(len(s), percent) + int(EXTRA_SHARE * len(s)) + EXTRA].tobytes() for s in found]
                bits = parities(found)
                flat = pa.ListArray.from_arrays(pa.array(np.arange(len(part) + 1) * bits.shape[1], pa.int32()), pa.array(bits.reshape(-1)))
                columns = [ids.slice(at, len(part)), batch.column(2).slice(at, len(part)), pa.array(n), pa.array(cls), pa.array(low, pa.binary()), flat]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n", "cls", "low", "bits"])
                at += len(part)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("text_hash"))
    return rows.mapInArrow(sets, "doc_id long, text_hash long, n long, cls long, low binary, bits array<long>")


def regions(sets: DataFrame, whole: DataFrame, hot: np.ndarray, counts: np.ndarray, words: int, percent: int) -> DataFrame:
    """(h, rep, n, place) of every region a set belongs to.

    Sets whose low part is mostly hot are ordered from their whole text (``whole``: rep, text).
    """

    def emit(reps, sizes, lists):
        h, rep, n, place = [], [], [], []
        for r, s, k in zip(reps, sizes, lists):
            h.append(k.view(np.int64))
            rep.append(np.full(len(k), r))
            n.append(np.full(len(k), s))
            place.append(np.arange(len(k)))
        if h:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).astype(np.int64)) for x in (h, rep, n, place)], names=["h", "rep", "n", "place"])

    def enough(parts):
        for batch in parts:
            reps, sizes, lists = [], [], []
            for r, s, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                known = np.frombuffer(raw.as_py(), np.uint64)
                first = _first(known, hot, window(s, percent))
                if first is None and len(known) == s:
                    first = order_all(known, s)
                if first is None:
                    first = np.zeros(0, np.uint64)
                reps.append(r)
                sizes.append(s)
                lists.append(first)
            yield from emit(reps, sizes, lists)

    def order_all(known, size):
        if not len(hot):
            return known[: window(size, percent)]
        where = np.minimum(np.searchsorted(hot, known), len(hot) - 1)
        rank = np.where(hot[where] == known, counts[where], 0)
        return known[np.argsort(rank, kind="stable")][: window(size, percent)]

    def rest(parts):
        for batch in parts:
            for part in _slices(batch.column(0).to_pylist()):
                found = shingle_sets(part, words)
                yield from emit([set_number(s) for s in found], [len(s) for s in found], [order_all(s, len(s)) for s in found])

    def lacking(parts):
        for batch in parts:
            mask = []
            for s, raw in zip(batch.column(1).to_pylist(), batch.column(2)):
                known = np.frombuffer(raw.as_py(), np.uint64)
                mask.append(len(known) < s and _first(known, hot, window(s, percent)) is None)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(mask, pa.bool_()))], names=["doc_id"])

    schema = "h long, rep long, n long, place long"
    columns = sets.select("rep", "n", "low")
    short = cut(sets.select("doc_id", "n", "low").mapInArrow(lacking, "doc_id long"))
    # The part of these sets beyond what is stored is read from their texts again.
    again = whole.join(short, "doc_id", "left_semi").select("text").mapInArrow(rest, schema).join(sets.select("rep"), "rep", "left_semi").dropDuplicates(["h", "rep"])
    return columns.mapInArrow(enough, schema).unionByName(again.select("h", "rep", "n", "place"))


def sketch(low: np.ndarray, size: int, percent: int) -> np.ndarray:
    """High halves of the hashes in the replication window: a short prefix of a set in hash order."""
    return np.unique((low[: window(size, percent)] >> np.uint64(32)).astype(np.uint32))


def _possible(s: np.ndarray, t: np.ndarray, most: int) -> bool:
    """Whether two sets can differ in at most ``most`` hashes: those below both sketches' ends are known."""
    end = min(s[-1], t[-1])
    s, t = s[s < end], t[t < end]
    both = len(np.intersect1d(s, t, assume_unique=True))
    return len(s) + len(t) - 2 * both <= most


def _verify(pairs: DataFrame, sketches: DataFrame, sets: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are similar enough, compared exactly.

    Sketches, a thirteenth of the sets' size, rule out what cannot be similar by the same
    bound as the windows. Only the sets that are left are made whole again from their
    texts (docs: doc_id, text) and joined.
    """
    spark = pairs.sparkSession

    def rule_out(parts):
        for batch in parts:
            good = []
            sizes = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())
            for (n, m), x, y in zip(sizes, batch.column(4), batch.column(5)):
                most = n + m - 2 * -(-(n + m) * percent // (100 + percent))
                good.append(_possible(np.frombuffer(x.as_buffer(), np.uint32), np.frombuffer(y.as_buffer(), np.uint32), most))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    def compare(parts):
        for batch in parts:
            good = []
            for x, y in zip(batch.column(2), batch.column(3)):
                s, t = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                where = np.minimum(np.searchsorted(t, s), len(t) - 1)
                both = int((t[where] == s).sum())
                good.append(100 * both >= percent * (len(s) + len(t) - both))
            mask = pa.array(good, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], names=["a", "b"])

    def whole(parts):
        for batch in parts:
            for part in _slices(batch.column(0).to_pylist()):
                found = shingle_sets(part, words)
                yield pa.RecordBatch.from_arrays([pa.array([set_number(s) for s in found], pa.int64()), pa.array([s.tobytes() for s in found], pa.binary())], names=["rep", "all"])

    of = lambda df, side, *names: df.select(F.col("rep").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in names])
    shown = pairs.join(of(sketches, "a", "n", "sketch"), "a").join(of(sketches, "b", "n", "sketch"), "b")
    left, left_path = written(shown.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b").mapInArrow(rule_out, "a long, b long"), "pairs")
    wanted = left.select(F.explode(F.array("a", "b")).alias("rep")).distinct()
    owners, owners_path = written(sets.select("rep", "doc_id").join(wanted, "rep", "left_semi"), "pair-sets")
    texts = docs.join(owners.select("doc_id"), "doc_id", "left_semi").withColumn("_text", F.xxhash64("text")).dropDuplicates(["doc_id", "_text"])
    full, full_path = written(texts.select("text").mapInArrow(whole, "rep long, all binary"), "whole-sets")
    # Texts of one doc_id may have one set.
    full = full.join(owners.select("rep"), "rep", "left_semi").dropDuplicates(["rep"])
    joined = left.join(of(full, "a", "all"), "a").join(of(full, "b", "all"), "b")
    found = cut(joined.select("a", "b", "all_a", "all_b").mapInArrow(compare, "a long, b long"))
    for path in (left_path, owners_path, full_path):
        remove(spark, path)
    return found


def components(links: DataFrame) -> DataFrame:
    """(rep, comp): the smallest rep reachable, for every rep in ``links`` (a, b).

    Each round points every vertex at the smallest label around it, then follows the
    label's own label (pointer jumping), so rounds grow with the logarithm of the longest
    chain. Only changes are counted on the driver.
    """
    tasks = max(LEAST_TASKS, -(-2 * links.count() // TASK_EDGES))

    def few(df: DataFrame) -> DataFrame:
        """Small results in few files: every shuffle writes one per task."""
        return df.coalesce(tasks)

    edges = cut(few(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct()))
    labels = cut(few(edges.groupBy(F.col("a").alias("rep")).agg(F.least(F.min("b"), F.col("rep")).alias("comp"))))
    while True:
        met = few(edges.join(labels.select(F.col("rep").alias("b"), "comp"), "b"))
        around = met.groupBy(F.col("a").alias("rep")).agg(F.min("comp").alias("near"))
        hooked = few(labels.join(few(around), "rep").select("rep", "comp", F.least("comp", "near").alias("low")))
        # The old label's vertex learns the new low label as well.
        pulled = few(hooked.groupBy(F.col("comp").alias("rep")).agg(F.min("low").alias("pull")))
        stepped = few(hooked.join(pulled, "rep", "left").select("rep", "comp", F.least("low", F.coalesce("pull", "low")).alias("low")))
        jumps = stepped.select(F.col("rep").alias("low"), F.col("low").alias("jump"))
        new = cut(few(stepped.join(jumps, "low", "left").select("rep", F.col("comp").alias("old"), F.least("low", F.coalesce("jump", "low")).alias("comp"))))
        changed = new.filter("old <> comp").limit(1).count()
        labels = new.select("rep", "comp")
        if not changed:
            return labels


def similar_sets(docs: DataFrame, words: int = SHINGLE_WORDS, percent: int = SIMILARITY) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id (the smallest doc_id reachable), text_hash, component.

    ``component`` is the number of the component itself, NULL for the empty set; it tells
    components apart where rows of one doc_id have several.
    """
    spark = docs.sparkSession
    with_low, low_path = written(points(docs, words, percent), "points")
    classes = with_low.filter("n > 0").groupBy("cls", "n").agg(F.min("doc_id").alias("doc_id"), F.first("low").alias("low"), F.first("bits").alias("bits"))
    sets, sets_path = written(classes.withColumnRenamed("cls", "rep"), "sets")
    all_points, points_path = written(with_low.select("doc_id", "text_hash", "n", "cls"), "sizes")
    remove(spark, low_path)
    release(spark)

    def explode(parts):
        for batch in parts:
            raw = b"".join(x.as_py() for x in batch.column(0))
            yield pa.RecordBatch.from_arrays([pa.array(np.frombuffer(raw, np.int64))], names=["h"])

    counts = cut(sets.select("low").mapInArrow(explode, "h long").groupBy("h").agg(F.count("*").alias("c")).filter(F.col("c") > HOT_SETS))
    # Few enough by construction: the limit rises until at most HOT_SHINGLES are left.
    limit = HOT_SETS
    while counts.filter(F.col("c") > limit).count() > HOT_SHINGLES:
        limit *= 2
    frequent = sorted((r["h"] % 2**64, r["c"]) for r in counts.filter(F.col("c") > limit).toLocalIterator())
    hot, often = np.array([h for h, _ in frequent], np.uint64), np.array([c for _, c in frequent], np.int64)

    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    cells, cells_path = written(regions(sets, whole, hot, often, words, percent), "regions")
    shared = cells.groupBy("h").agg(F.count("*").alias("size")).filter("size > 1").select("h")
    active, active_path = written(cells.join(shared, "h", "left_semi"), "shared-regions")
    remove(spark, cells_path)
    release(spark)
    involved = active.select("rep").distinct()

    def sketch_of(parts):
        for batch in parts:
            shown = [sketch(np.frombuffer(x.as_py(), np.uint64), n, percent).tobytes() for n, x in zip(batch.column(1).to_pylist(), batch.column(2))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(shown, pa.binary())], names=["rep", "n", "sketch"])

    members = sets.join(involved, "rep", "left_semi")
    sketches, sketches_path = written(members.select("rep", "n", "low").mapInArrow(sketch_of, "rep long, n long, sketch binary"), "sketches")
    links = spark.createDataFrame([], "a long, b long")
    labels = spark.createDataFrame([], "rep long, comp long")
    degree = spark.createDataFrame([], "rep long, deg long")
    turns, past = 0, [active_path]
    bits = sets.select("rep", "bits")
    while True:
        state = active.join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep")).join(degree, "rep", "left").withColumn("deg", F.coalesce("deg", F.lit(0)))
        split = state.groupBy("h").agg(F.min("comp").alias("c0"), F.max("comp").alias("c1"), F.count("*").alias("size")).filter("c0 <> c1").select("h", "size")
        held = state.join(split, "h")
        first = turns == 0
        if not first and "bits" not in active.columns:
            held = held.join(bits, "rep")
        open_cells, open_path = written(held, "open-regions")
        for path in past:
            remove(spark, path)
        past = [open_path]
        if open_cells.isEmpty():
            break
        # Members with most links come first; the limit of a group is taken before the shuffle.
        turn = Window.partitionBy("h").orderBy(F.desc("deg"), F.xxhash64("rep"))
        chosen = open_cells.withColumn("turn", F.row_number().over(turn)).filter(F.col("turn") <= PIVOTS[min(turns, len(PIVOTS) - 1)])
        shown = [] if first else [F.col("bits").alias("pbits")]
        pivots, pivots_path = written(chosen.select("h", F.col("rep").alias("p"), F.col("n").alias("pn"), F.col("place").alias("pp"), F.col("comp").alias("pc"), "size", *shown), "pivots")
        past.append(pivots_path)
        tasks = F.ceil(F.col("size") / TASK_MEMBERS)
        dealt = pivots.withColumn("deal", F.explode(F.sequence(F.lit(0).cast("long"), tasks - 1))).drop("size")
        members_ = open_cells.withColumn("deal", F.pmod(F.xxhash64("rep"), tasks))
        met = members_.join(dealt, ["h", "deal"]).filter("rep <> p and comp <> pc")
        # Windows: sizes, shingles that only one of the two has before the pivot, and parity bits.
        least = F.ceil((F.col("n") + F.col("pn")) * F.lit(percent) / F.lit(100 + percent))
        most = F.col("n") + F.col("pn") - 2 * least
        near = met.filter((F.least("n", "pn") * 100 >= F.greatest("n", "pn") * percent) & (F.col("place") + F.col("pp") <= most))
        if not first:
            differ = reduce(add, [F.bit_count(F.get("bits", F.lit(i)).bitwiseXOR(F.get("pbits", F.lit(i)))) for i in range(BITS // 64)])
            near = near.filter(differ <= most)
        pairs = near.select(F.least("rep", "p").alias("a"), F.greatest("rep", "p").alias("b")).distinct()
        new = _verify(pairs, sketches, sets, whole, words, percent)
        if not new.isEmpty():
            links = cut(links.unionByName(new))
            labels = components(links)
            degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("deg"))
        active = open_cells.drop("comp", "deg", "size").join(pivots.select("h", F.col("p").alias("rep")), ["h", "rep"], "left_anti")
        turns += 1
        release(spark)

    classed = sets.select("rep", "doc_id").join(labels, "rep", "left").withColumn("comp", F.coalesce("comp", "rep"))
    named = classed.join(classed.groupBy("comp").agg(F.min("doc_id").alias("component_id")), "comp").select(F.col("rep").alias("cls"), "component_id", F.col("comp").alias("component"))
    named, named_path = written(named, "components")
    alone = all_points.filter("n = 0").withColumn("component_id", F.col("doc_id")).withColumn("component", F.lit(None).cast("long"))
    held = all_points.filter("n > 0").join(named, "cls", "left")
    columns = ["doc_id", F.col("n").alias("n_shingles"), "component_id", "text_hash", "component"]
    result = cut(held.select(*columns).unionByName(alone.select(*columns)))
    for path in (*past, points_path, sets_path, sketches_path, named_path):
        remove(spark, path)
    return result
