"""Merkle manifest of a table: leaf hashes, one tree per group, one tree over the groups.

Leaves are numbered in order within their group. Per level, lag and lead columns at fixed
offsets, masked by the slot in the run and by the run's length, give each node its
siblings, and the first child of a run hashes the parent: the first child of a node of level
l is the row whose number is a multiple of ``ARITY ** l``, so siblings lie ``ARITY ** l`` rows
apart. Windows end at blocks of ``ARITY ** HEIGHT`` rows, which no run crosses; ``HEIGHT``
levels take one shuffle, and what is left, one row per block, is the input of the next.
Paths come back down by joining each block to its own path.

Large data: texts are hashed where they are read and not shuffled. Leaves are numbered over
range partitions; only one count per partition and group meets in a window. A group that
holds a third of all rows is spread over many blocks. 10^11 leaves take five rounds.

Defined cases: a null column is hashed as ``-``, an empty one as ``0:``; rows without doc_id
come first in their group and are left untampered by ``tampered``; rows with equal doc_id are
ordered by their leaf, alike rows are leaves of their own; a null group is a group, before
all others; texts of any length are hashed whole; an empty table gives no row; other columns
are neither hashed nor kept. Native: no Python runs in the tasks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from telcolake.llm.common import cut, join_hot, remove, written

# Fixed values of the format: children per node, and the columns of a leaf in their order.
ARITY = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
# Levels per shuffle: blocks of 27 rows.
HEIGHT = 3

_NODE = "struct<left:string,right:string>"


def digest(*parts: Column) -> Column:
    """Lowercase hex SHA-256 of the parts laid end to end."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf(columns: list[Column]) -> Column:
    """Hash of a row: each value with its UTF-8 length before it."""

    def spelled(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return digest(*map(spelled, columns))


def fold(node: Column, path: Column) -> Column:
    """The root that a node and the siblings on its path give."""
    return F.aggregate(path, node, lambda h, s: digest(s["left"], h, s["right"]))


def proof(path: Column) -> Column:
    """Hash of the siblings on a path, left to right and level by level."""
    return digest(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def numbered(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """``rows`` with ``i``, the place in the group, and ``n``, the group's size; nulls first."""
    keys = [*group, *order]
    # Alike rows may fill many partitions: their place in the input parts them.
    ranged = rows.withColumn("_salt", F.monotonically_increasing_id()).repartitionByRange(*keys, "_salt").sortWithinPartitions(*keys, "_salt").drop("_salt")
    placed = cut(ranged.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", F.shiftright("_row", 33)))
    runs = placed.groupBy("_part", *group).agg(F.min("_row").alias("_first"), F.count("*").alias("_count"))
    of_group = Window.partitionBy(*group)  # one row per partition that holds the group
    before = F.sum("_count").over(of_group.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    starts = runs.select("_part", *group, "_first", F.coalesce(before, F.lit(0)).alias("_before"), F.sum("_count").over(of_group).alias("n"))
    same = F.lit(True)
    for key in ("_part", *group):
        same = same & F.col(f"a.{key}").eqNullSafe(F.col(f"b.{key}"))
    joined = placed.alias("a").join(starts.alias("b"), same)
    return joined.select("a.*", (F.col("_row") - F.col("_first") + F.col("_before")).alias("i"), "n").drop("_row", "_part")


def climb(nodes: DataFrame, group: list[str]) -> DataFrame:
    """``nodes`` (group, i, n, h) with the ``path`` of ``HEIGHT`` levels and ``top``, the node it ends in."""
    rows = nodes.withColumn("_block", F.floor(F.col("i") / ARITY**HEIGHT))
    block = Window.partitionBy(*group, "_block").orderBy("i")
    i, h = F.col("i"), F.col("_h0")
    rows = rows.withColumn("_h0", F.col("h"))
    steps = []
    for level in range(HEIGHT):
        step, size = ARITY**level, F.ceil(F.col("n") / ARITY**level)  # nodes of the group on this level
        at = F.floor(i / step)
        slot = F.pmod(at, F.lit(ARITY))
        length = F.least(F.lit(ARITY), size - at + slot)
        first, h = F.pmod(i, F.lit(step)) == 0, F.col(f"_h{level}")
        shifts = {f"_lag{k}": F.lag(h, k * step).over(block) for k in range(1, ARITY)} | {f"_lead{k}": F.lead(h, k * step).over(block) for k in range(1, ARITY)}
        rows = rows.select("*", *[c.alias(name) for name, c in shifts.items()])
        none = F.lit("")
        left = F.concat(*[F.when(slot >= k, F.col(f"_lag{k}")).otherwise(none) for k in range(ARITY - 1, 0, -1)])
        right = F.concat(*[F.when(slot + k < length, F.col(f"_lead{k}")).otherwise(none) for k in range(1, ARITY)])
        grows = first & (size > 1)
        rows = rows.withColumn(f"_s{level}", F.when(grows, F.struct(left.alias("left"), right.alias("right")).cast(_NODE)))
        parent = F.when(grows & (slot == 0), digest(h, right)).when(first & (size <= 1), h)
        rows = rows.withColumn(f"_h{level + 1}", parent).drop(*shifts)
        steps.append(f"_s{level}")
    # The rows of a node take its siblings from its first child, the last one at or before them.
    so_far = block.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = rows.select(*nodes.columns, "_block", *[F.last(s, ignorenulls=True).over(so_far).alias(s) for s in steps], F.last(f"_h{HEIGHT}", ignorenulls=True).over(so_far).alias("top"))
    return filled.select(*nodes.columns, "_block", F.filter(F.array(*steps), lambda s: s.isNotNull()).alias("path"), "top")


def trees(leaves: DataFrame, group: list[str], order: list[str]) -> tuple[DataFrame, list[str]]:
    """``leaves`` with ``path`` to and ``root`` of their group's tree; column ``h`` is the leaf.

    Also the folders of the tables it reads, for the caller to remove.
    """
    rounds = []
    nodes = numbered(leaves, group, order)
    while True:
        table, path = written(climb(nodes, group), "merkle")
        rounds.append((table, path))
        above = table.filter((F.pmod("i", F.lit(ARITY**HEIGHT)) == 0) & (F.col("n") > ARITY**HEIGHT))
        if above.isEmpty():
            break
        nodes = above.select(*group, F.col("_block").alias("i"), F.ceil(F.col("n") / ARITY**HEIGHT).alias("n"), F.col("top").alias("h"))
    folders = [path for _, path in rounds]
    found, _ = rounds.pop()
    while rounds:
        table, _ = rounds.pop()
        upper = found.select(*[F.col(g).alias(f"_g{k}") for k, g in enumerate(group)], F.col("i").alias("_up"), F.col("path").alias("_path"), F.col("top").alias("_top"))
        same = F.col("_block") == F.col("_up")
        for k, g in enumerate(group):
            same = same & F.col(g).eqNullSafe(F.col(f"_g{k}"))
        whole = F.concat("path", F.coalesce("_path", F.array().cast(f"array<{_NODE}>")))
        found = table.join(upper, same, "left").select(*[c for c in table.columns if c not in ("path", "top")], whole.alias("path"), F.coalesce("_top", "top").alias("top"))
    return found.drop("_block").withColumnRenamed("top", "root"), folders


def manifest(docs: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "source", order: str = "doc_id", also: dict[str, Column] | None = None) -> DataFrame:
    """doc_id, source, leaf, position, path, subroot and root of every row.

    ``path`` holds, level by level from the leaf to the root over the groups, the siblings
    left and right of the node. ``also`` names further columns computed from ``docs``.
    """
    extra = dict(also or {})
    rows = docs.select(F.col(order).alias("doc_id"), F.col(group).cast("string").alias("source"), leaf([F.col(c) for c in columns]).alias("h"), *[c.alias(f"x_{k}") for k, c in extra.items()])
    lower, lower_paths = trees(rows, ["source"], ["doc_id", "h"])
    lower = lower.withColumn("key", F.coalesce(F.concat(F.lit("s"), "source"), F.lit("-")))
    groups = lower.filter("i = 0").select(F.lit(0).alias("all"), "source", "key", F.col("n").alias("size"), F.col("root").alias("h"))
    upper, upper_paths = trees(groups, ["all"], ["source"])
    top = upper.select("key", "size", F.col("path").alias("_path"), F.col("root").alias("_root"))
    joined = join_hot(lower, top, "key", "size")
    columns_of = [F.col(f"x_{k}").alias(k) for k in extra]
    found, _ = written(joined.select("doc_id", "source", F.col("h").alias("leaf"), F.col("i").alias("position"), F.concat("path", "_path").alias("path"), F.col("root").alias("subroot"), F.col("_root").alias("root"), *columns_of), "merkle-manifest")
    for path in (*lower_paths, *upper_paths):
        remove(docs.sparkSession, path)
    return found


def tampered(docs: DataFrame) -> dict[str, Column]:
    """Leaf of the row where an even checksum of its doc_id makes the text lose its line feeds."""
    text = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return {"tampered_leaf": leaf([text if c == "text" else F.col(c) for c in COLUMNS])}


def verify(docs: DataFrame, stored: DataFrame, columns: tuple[str, ...] = COLUMNS, group: str = "source", order: str = "doc_id") -> DataFrame:
    """Rows of ``docs`` against a stored manifest: doc_id, source and status.

    ``same`` rows fold to the stored root, ``changed`` ones don't; ``added`` rows have no leaf of
    their doc_id and group in the manifest, ``missing`` leaves no row. Rows of one doc_id and
    group are told apart by their leaves, so each is same, or changed where leaves are left over.
    """
    mine = docs.select(F.col(order).alias("doc_id"), F.col(group).cast("string").alias("source"), leaf([F.col(c) for c in columns]).alias("h"))
    mine = mine.groupBy("doc_id", "source", "h").agg(F.count("*").alias("n"))
    kept = stored.groupBy("doc_id", "source", F.col("leaf").alias("h")).agg(F.count("*").alias("m"), F.first("path").alias("path"), F.first("root").alias("root"))
    same = F.lit(True)
    for c in ("doc_id", "source", "h"):
        same = same & F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}"))
    pairs = mine.alias("a").join(kept.alias("b"), same, "full")
    both = pairs.select(
        F.coalesce("a.doc_id", "b.doc_id").alias("doc_id"),
        F.coalesce("a.source", "b.source").alias("source"),
        F.when(fold(F.col("a.h"), F.col("b.path")) == F.col("b.root"), F.least("n", "m")).otherwise(F.lit(0)).alias("same"),
        F.coalesce("n", F.lit(0)).alias("n"),
        F.coalesce("m", F.lit(0)).alias("m"),
    )
    over, short = F.col("n") - F.col("same"), F.col("m") - F.col("same")
    sums = both.groupBy("doc_id", "source").agg(F.sum("same").alias("same"), F.sum(over).alias("over"), F.sum(short).alias("short"))
    kinds = {"same": F.col("same"), "changed": F.least("over", "short"), "added": F.col("over") - F.least("over", "short"), "missing": F.col("short") - F.least("over", "short")}
    counts = F.explode(F.array(*[F.struct(F.lit(s).alias("status"), c.alias("rows")) for s, c in kinds.items()]))
    return sums.select("doc_id", "source", counts.alias("c")).select("doc_id", "source", "c.status", "c.rows").filter("rows > 0")
