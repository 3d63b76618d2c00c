"""Toxicity by a subsequence string-kernel support vector machine with Nyström landmarks.

A text is a row of units: words with their marks stripped and look-alike digits folded,
and runs of single letters joined, so that "i.d.i.o.t", "1d10t" and "i d i o t" meet
"idiot". The kernel of two units counts common subsequences of three characters within
six, each weighted by its gaps and normalised, so inserted and dropped characters cost
little. Nyström landmarks turn the kernel into a short vector, on which a linear machine
is trained. Landmarks are spread over all insults by farthest-first choice.

Labels are given for texts only. Words and word beginnings that set toxic texts apart are
found in two thirds of the labelled texts: they must be in more toxic texts than chance
gives among so many words, and must fill a larger share of toxic texts than of clean ones.
The share counts, not the presence: a long clean text may hold any beginning once. Near copies
(half of the min-hashes of their three-word shingles agree with a group's first text)
count once, and words that share their texts with many unlike words go, as they come from
one group of copies. The machine learns the words so found against words of clean texts,
the nearest ones first.

A text is judged by its worst unit, by how many units lie on the toxic side, and by their
share of the text. A logistic curve over these, fitted on the last third of the labelled
texts, which took no part in the choice of words, gives the score.

Fitting takes at most ``FIT_TOXIC`` toxic and ``FIT_CLEAN`` clean labelled texts, chosen
by a hash of doc_id; everything else covers all texts. Scoring needs the text alone.

Defined cases: null and empty texts get the score of a text without units; labels that
contradict each other count as toxic; null labels are left out; without labels of both
kinds every score is 0; equal and null doc_ids stay separate rows; other columns are
ignored.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from telcolake.llm.common import cut

FIT_TOXIC = 4_000
FIT_CLEAN = 16_000
STEMS = (3, 4, 5, 6)
# Share of a trait's place in texts that must be that in toxic ones, texts of both kinds counting alike.
PURITY = 0.9
# Of so many labelled texts one calibrates the score, the others choose the words.
CALIBRATES = 3
# A word's frequencies must be this much less likely by chance than one in all words.
EVIDENCE = 0.0
# A trait that shares its texts with so many unlike traits belongs to a group of copies.
TWINS = 8
# Near copies: texts with this share of equal min-hashes, found through a band of them.
HASHES = 32
BAND = 2
ALIKE = 0.5
_PRIME = np.uint64(4_294_967_311)
_SALTS = [(np.uint64(zlib.crc32(b"times%d" % k) >> 1 | 1), np.uint64(zlib.crc32(b"plus%d" % k))) for k in range(HASHES)]
NEGATIVES = 4_000
# Landmarks on clean words, and on insults: one for each beginning and half as many again, within these bounds.
CLEAN_LANDMARKS = 40
LANDMARKS, MOST_LANDMARKS = 120, 600
MEMO_WORDS = 400_000
HELD_OUT_MODULUS = 3

# Before the first character of a unit: what a word begins with tells more than what it holds.
START = "^"
# Margins from which a unit counts as toxic in part, and in full.
MAYBE, SURE = 0.2, 0.6
# Added to a unit's squared length: a unit of one or two subsequences is like nothing.
SHORT = 4.0
DECAY = 0.6
SPAN = 6
_OFFSETS = [(a, b) for b in range(2, SPAN) for a in range(1, b)]
_CLASSES = 64
_FOLD = str.maketrans("013457@$", "oieastas")
_MARKS = re.compile(r"[\W_]+")
_SINGLE = re.compile(r"(?<!\S)\S(?:[ ]\S){2,}(?!\S)")


def unit(word: str) -> str:
    return _MARKS.sub("", word.translate(_FOLD))


def words_of(text: str | None) -> list[str]:
    """Words of a text, lower-cased; runs of single characters are joined as well."""
    low = (text or "").lower()
    return low.split() + [run.replace(" ", "") for run in _SINGLE.findall(low)]


def _codes(units: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, subsequence code, weight) of all subsequences, summed per unit and code; a mark stands before each unit."""
    units = [START + u for u in units]
    joined = np.frombuffer("".join(units).encode("utf-32-le"), np.uint32).astype(np.int64)
    letters = np.where((joined >= 97) & (joined <= 122), joined - 96, 27 + joined % (_CLASSES - 27))
    lengths = np.array([len(u) for u in units], np.int64)
    ends = np.cumsum(lengths)
    owner = np.repeat(np.arange(len(units)), lengths)
    last = ends[owner] if len(owner) else owner
    place = np.arange(len(letters))
    keys, weights = [], []
    for a, b in _OFFSETS:
        i = place[place + b < last]
        code = (letters[i] * _CLASSES + letters[i + a]) * _CLASSES + letters[i + b]
        keys.append(owner[i] * _CLASSES**3 + code)
        weights.append(np.full(len(i), DECAY ** (b - 2)))
    key, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    weight = np.bincount(inverse, np.concatenate(weights), len(key))
    return key // _CLASSES**3, key % _CLASSES**3, weight


class Landmarks:
    """Normalised kernel between units and fixed landmark units."""

    def __init__(self, units: list[str]):
        self.units = units
        owner, code, weight = _codes(units)
        norm = np.sqrt(np.bincount(owner, weight**2, len(units)) + SHORT)
        known = np.unique(code)
        self.row = np.full(_CLASSES**3, -1, np.int32)
        self.row[known] = np.arange(len(known))
        self.table = np.zeros((len(known), len(units)), np.float32)
        self.table[self.row[code], owner] = weight / np.maximum(norm[owner], 1e-9)

    def kernel(self, units: list[str]) -> np.ndarray:
        out = np.zeros((len(units), len(self.units)), np.float32)
        if not any(len(u) >= 3 for u in units):
            return out
        owner, code, weight = _codes(units)
        norm = np.sqrt(np.bincount(owner, weight**2, len(units)) + SHORT)
        row = self.row[code]
        hit = row >= 0
        owner, row, weight = owner[hit], row[hit], weight[hit] / np.maximum(norm[owner[hit]], 1e-9)
        for at in range(0, len(owner), 200_000):
            o = owner[at : at + 200_000]
            first = np.flatnonzero(np.r_[True, o[1:] != o[:-1]])
            part = self.table[row[at : at + 200_000]] * weight[at : at + 200_000, None]
            out[o[first]] += np.add.reduceat(part, first, axis=0)
        return out


def train_svm(x: np.ndarray, y: np.ndarray, share: np.ndarray, c: float = 300.0, rounds: int = 40) -> np.ndarray:
    """Weights (last one the bias) of a squared-hinge linear machine; classes count alike, rows of a class by ``share``."""
    x = np.c_[x, np.ones(len(x))]
    cost = np.where(y > 0, 0.5 * share / share[y > 0].sum(), 0.5 * share / share[y < 0].sum()) * c
    w = np.zeros(x.shape[1])
    # Newton steps on the points inside the margin.
    for _ in range(rounds):
        gap = 1 - y * (x @ w)
        mine = gap > 0
        grad = w - 2 * x[mine].T @ (cost[mine] * y[mine] * gap[mine])
        hess = np.eye(len(w)) + 2 * (x[mine] * cost[mine, None]).T @ x[mine]
        step = np.linalg.solve(hess, grad)
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return w


@dataclass
class Model:
    landmarks: Landmarks
    weights: np.ndarray
    bias: float
    curve: np.ndarray = field(default_factory=lambda: np.array([1.0, 1.0, 1.0, 0.0]))

    def margins(self, units: list[str]) -> np.ndarray:
        """Kernel times weights; the sum over landmarks is taken once per subsequence, not per unit."""
        if not any(len(u) >= 3 for u in units):
            return np.full(len(units), self.bias)
        owner, code, weight = _codes(units)
        norm = np.sqrt(np.bincount(owner, weight**2, len(units)) + SHORT)
        row = self.landmarks.row[code]
        worth = np.r_[self.landmarks.table @ self.weights, 0.0]  # the last for unknown subsequences
        return np.bincount(owner, weight * worth[row], len(units)) / np.maximum(norm, 1e-9) + self.bias

    def floor(self) -> float:
        return float(self.bias)

    def scores(self, evidence: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(np.c_[evidence, np.ones(len(evidence))] @ self.curve, -30, 30)))


def evidence_of(margins: list[float], floor: float) -> tuple[float, float, float]:
    """(worst margin, units on the toxic side, their share) of a text; units count in part up to the margin ``SURE``."""
    held = sum(min((m - MAYBE) / (SURE - MAYBE), 1.0) for m in margins if m > MAYBE)
    worst = min(max(margins, default=floor), 1.0)
    return worst, math.log1p(held), math.log1p(100 * held / max(1, len(margins)))


# Margins of words by model; Python workers are reused between tasks.
_memos: dict[int, dict[str, float]] = {}


def _scoring(model: Model):
    """Function from texts to their evidence, with a memo of words."""
    memo = _memos.setdefault(zlib.crc32(model.weights.tobytes()), {})

    def run(texts: list[str | None]) -> list[tuple[float, float, float]]:
        bags = [words_of(t) for t in texts]
        seen = set().union(*bags)
        new = seen.difference(memo)
        if len(memo) + len(new) > MEMO_WORDS:
            memo.clear()
            new = seen
        new = list(new)
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            memo.update(zip(part, model.margins([unit(w) for w in part]).tolist()))
        get, floor = memo.__getitem__, model.floor()
        return [evidence_of(list(map(get, bag)), floor) for bag in bags]

    return run


def evidence(docs: DataFrame, model: Model, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of docs and the evidence and score of the whole text."""
    schema = docs.select(*keep).schema
    names = [f"k{i}" for i in range(len(keep))]

    def score(parts):
        run = _scoring(model)
        for batch in parts:
            texts = batch.column(len(keep)).to_pylist()
            found = np.array([e for at in range(0, len(texts), 256) for e in run(texts[at : at + 256])]).reshape(-1, 3)
            columns = [*batch.columns[: len(keep)], pa.array(found.tolist(), pa.list_(pa.float64())), pa.array(model.scores(found))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "evidence", "score"])

    fields = ", ".join(f"{n} {f.dataType.simpleString()}" for n, f in zip(names, schema.fields))
    out = docs.select(*keep, "text").mapInArrow(score, f"{fields}, evidence array<double>, score double")
    return out.toDF(*keep, "evidence", "score")


def signatures(docs: DataFrame) -> DataFrame:
    """(doc_id, s0, s1, ...): ``HASHES`` min-hashes over the three-word shingles of each text; null without words."""
    names = [f"s{k}" for k in range(HASHES)]

    def sign(parts):
        for batch in parts:
            rows = []
            for text in batch.column(1):
                words = [unit(w) for w in (text.as_py() or "").lower().split()]
                shingles = {" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))} if words else ()
                keys = np.array([zlib.crc32(x.encode()) for x in shingles], np.uint64)
                rows.append([int(((keys * m + c) % _PRIME).min()) for m, c in _SALTS] if len(keys) else [None] * HASHES)
            columns = [pa.array([r[k] for r in rows], pa.int64()) for k in range(HASHES)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", *names])

    return docs.select("doc_id", "text").mapInArrow(sign, "doc_id long, " + ", ".join(f"{n} long" for n in names))


def _kin(rows: list[tuple]) -> dict[int, int]:
    """doc_id -> group of near copies: each text is held against the first text of a group, never against later ones.

    A pair that agrees on a band of min-hashes is compared on all of them; the share that
    agrees estimates the Jaccard similarity of their shingles.
    """
    first = np.zeros((len(rows), HASHES), np.int64)
    groups, bands, n = {}, {}, 0
    for doc_id, *signs in sorted(rows, key=lambda r: r[0]):
        if signs[0] is None:
            groups[doc_id] = n = n + 1
            continue
        mine = np.array(signs)
        keys = [(k, *signs[k : k + BAND]) for k in range(0, HASHES, BAND)]
        met = np.array(sorted({g for key in keys for g in bands.get(key, ())}), np.int64)
        alike = met[(first[met - 1] == mine).mean(axis=1) >= ALIKE]
        same = int(alike[0]) if len(alike) else None
        if same is None:
            same = n = n + 1
            first[n - 1] = mine
            for key in keys:
                bands.setdefault(key, []).append(n)
        groups[doc_id] = same
    return groups


def _independent(bags: list[set[str]], order: dict[str, float]) -> list[str]:
    """Traits, strongest first, without those of a group of copies: there, many unlike traits share the same texts."""
    traits = sorted(order, key=lambda t: (-order[t], t))
    place = {t: i for i, t in enumerate(traits)}
    held = np.zeros((len(bags), len(traits)), np.float32)
    for i, bag in enumerate(bags):
        held[i, [place[t] for t in bag]] = 1
    both = held.T @ held
    size = held.sum(axis=0)
    alike = both >= 0.8 * (size[:, None] + size[None, :] - both)
    start = np.array([zlib.crc32(t[:3].encode()) for t in traits])
    twins = (alike & (start[:, None] != start[None, :])).sum(axis=1)
    return [t for t, n in zip(traits, twins.tolist()) if n < TWINS]


def fit(docs: DataFrame, labels: DataFrame) -> Model | None:
    """A model from labelled texts whose crc32(doc_id) mod 3 is not 1."""
    known = labels.filter("doc_id is not null and toxic is not null").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    known = known.filter(F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_MODULUS != 1)
    chosen = [known.filter(f"toxic = {t}").orderBy(F.xxhash64("doc_id"), "doc_id").limit(n) for t, n in ((1, FIT_TOXIC), (0, FIT_CLEAN))]
    sample = cut(chosen[0].unionByName(chosen[1]))
    # At most FIT_TOXIC + FIT_CLEAN rows of two numbers.
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample.withColumn("doc_id", F.col("doc_id").cast("long"))), "doc_id")

    calibrates = F.pmod(F.xxhash64(F.lit("calibrates"), "doc_id"), F.lit(CALIBRATES)) == 0
    choosing = texts.filter(~calibrates)

    # One row per document of the sample; near copies count once.
    kin_of = _kin([tuple(r) for r in signatures(choosing).groupBy("doc_id").agg(*[F.min(f"s{k}") for k in range(HASHES)]).collect()])

    def bag(parts):
        for batch in parts:
            for doc_id, text, toxic in zip(*(c.to_pylist() for c in batch.columns)):
                units = [u for w in words_of(text) if len(u := unit(w)) >= 3]
                counts = Counter(units)
                n = len(counts)
                if n:
                    places = [c / len(units) for c in counts.values()]
                    yield pa.RecordBatch.from_arrays([pa.array([kin_of.get(doc_id, -1)] * n, pa.int64()), pa.array([toxic] * n, pa.int32()), pa.array(list(counts)), pa.array(places)], names=["kin", "toxic", "unit", "place"])

    rows = choosing.select("doc_id", "text", F.col("toxic").cast("int").alias("toxic")).mapInArrow(bag, "kin long, toxic int, unit string, place double")
    bags = cut(rows.groupBy("kin", "toxic", "unit").agg(F.max("place").alias("place")))
    n1, n0 = (bags.filter(f"toxic = {t}").agg(F.countDistinct("kin")).first()[0] for t in (1, 0))
    if not n1 or not n0:
        return None
    # Whole words, and beginnings written with a bar.
    stems = F.array(*[F.when(F.length("unit") > k, F.concat(F.substring("unit", 1, k), F.lit("|"))) for k in STEMS])
    spread = bags.select("kin", "toxic", "place", F.explode(F.array_compact(F.concat(F.array("unit"), stems))).alias("trait"))
    traits = spread.groupBy("kin", "toxic", "trait").agg(F.sum("place").alias("place"))
    filled = [F.sum(F.when(F.col("toxic") == t, F.col("place")).otherwise(0.0)) / n for t, n in ((1, n1), (0, n0))]
    counted = traits.groupBy("trait").agg(F.sum("toxic").cast("long").alias("df1"), F.count("*").alias("df"), (filled[0] / (filled[0] + filled[1])).alias("purity"))
    counted = cut(counted.filter("df > 1"))
    share, rate = F.lit(n1 / (n1 + n0)), F.col("df1") / F.col("df")
    rest = F.when(rate < 1, (1 - rate) * F.log((1 - rate) / (1 - share))).otherwise(0.0)
    scored = counted.withColumn("evidence", F.when(rate > share, F.col("df") * (rate * F.log(rate / share) + rest)).otherwise(0.0))
    enough = float(np.log(max(1, counted.count()))) + EVIDENCE
    # Their number is bounded by the labelled texts: each stands out in some of them.
    pure = scored.filter((F.col("purity") >= PURITY) & (F.col("evidence") >= enough))
    order = {r["trait"]: r["evidence"] for r in pure.select("trait", "evidence").collect()}
    if not order:
        return None
    telling = docs.sparkSession.createDataFrame([(t,) for t in order], "trait string")
    seen = traits.filter("toxic = 1").join(F.broadcast(telling), "trait").groupBy("kin").agg(F.collect_set("trait").alias("traits"))
    covering = _independent([set(r["traits"]) for r in seen.collect()], order)
    # Of beginnings that go on from each other the one that tells most stands for all.
    beginnings: list[str] = []
    for t in sorted((t[:-1] for t in covering if t.endswith("|")), key=lambda t: (-round(order[t + "|"], 6), len(t), t)):
        if not any(t.startswith(b) or b.startswith(t) for b in beginnings):
            beginnings.append(t)
    told = F.col("unit").isin([t for t in covering if not t.endswith("|")])
    for k in STEMS:
        told = told | F.substring("unit", 1, k).isin([t for t in beginnings if len(t) == k])
    mass = [F.sum(F.when(F.col("toxic") == t, F.col("place")).otherwise(0.0)) / n for t, n in ((1, n1), (0, n0))]
    per_unit = bags.groupBy("unit").agg(F.max("toxic").alias("in_toxic"), F.min("toxic").alias("in_toxic_only"), (mass[0] / (mass[0] + mass[1])).alias("purity"))
    per_unit = cut(per_unit.withColumn("told", told))
    positive = sorted(r["unit"] for r in per_unit.filter((F.col("in_toxic") == 1) & F.col("told") & (F.col("purity") >= 0.5)).select("unit").collect())
    if not positive:
        return None

    # Clean words that no beginning tells: those nearest to an insult, and as many others.
    spread_over = _farthest([*beginnings, *[t for t in covering if not t.endswith("|")], *positive], min(MOST_LANDMARKS, max(LANDMARKS, len(beginnings) * 3 // 2)))
    near = Landmarks(spread_over)

    def nearest(parts):
        for batch in parts:
            units = batch.column(0).to_pylist()
            sims = np.concatenate([near.kernel(units[at : at + 20_000]).max(axis=1) for at in range(0, len(units), 20_000)] or [np.zeros(0)])
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sims.astype(float))], names=["unit", "sim"])

    clean = cut(per_unit.filter("in_toxic_only = 0 and not told").select("unit").mapInArrow(nearest, "unit string, sim double"))
    hard = [r["unit"] for r in clean.orderBy(F.desc("sim"), "unit").limit(NEGATIVES).collect()]
    other = [r["unit"] for r in clean.orderBy(F.xxhash64("unit"), "unit").limit(NEGATIVES).collect()]
    negative = sorted(set(hard + other).difference(positive))

    landmarks = Landmarks([*spread_over, *[h for h in hard if h not in set(spread_over)][:CLEAN_LANDMARKS]])
    gram = landmarks.kernel(landmarks.units).astype(float)
    value, vector = np.linalg.eigh((gram + gram.T) / 2)
    good = value > 1e-3
    nystroem = vector[:, good] / np.sqrt(value[good])
    x = landmarks.kernel([*positive, *negative]) @ nystroem
    y = np.r_[np.ones(len(positive)), -np.ones(len(negative))]
    # Families of words count alike, whatever their number of forms.
    family = Counter(p[:4] for p in positive)
    share = np.r_[[1 / family[p[:4]] for p in positive], np.ones(len(negative))]
    w = train_svm(x, y, share)
    model = Model(landmarks, (nystroem @ w[:-1]).astype(np.float32), float(w[-1]))

    known = evidence(texts.filter(calibrates), model, ["toxic"]).select("toxic", "evidence").collect()
    if known:
        model.curve = _logistic(np.array([r["evidence"] for r in known]), np.array([r["toxic"] for r in known]))
    return model


def _farthest(units: list[str], most: int) -> list[str]:
    """At most ``most`` units that cover all: each next one is the least like those chosen."""
    units = list(dict.fromkeys(u for u in units if len(u) >= 3))
    chosen, likeness = [], np.zeros(len(units))
    while len(chosen) < min(most, len(units)):
        at = int(np.argmin(likeness))
        if likeness[at] >= 1.0:
            break
        chosen.append(units[at])
        likeness = np.maximum(likeness, Landmarks([units[at]]).kernel(units)[:, 0])
        likeness[at] = 1.0
    return chosen


def _logistic(x: np.ndarray, t: np.ndarray) -> np.ndarray:
    """Weights (last one the shift) of a logistic curve, both classes with one text more on the other side."""
    mean = x.mean(axis=0)
    rows = np.r_[np.c_[x, np.ones(len(x))], [[*mean, 1.0]], [[*mean, 1.0]]]
    goal = np.r_[t, 0.0, 1.0]
    w = np.zeros(rows.shape[1])
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(rows @ w, -30, 30)))
        grad = rows.T @ (p - goal) + 0.01 * w
        hess = (rows * (p * (1 - p))[:, None]).T @ rows + 0.01 * np.eye(len(w))
        step = np.clip(np.linalg.solve(hess, grad), -5, 5)
        w = w - step
        if np.abs(step).max() < 1e-9:
            break
    return w


def score(docs: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """doc_id, held_out, score and predicted of every document."""
    model = fit(docs, labels)
    held_out = (F.crc32(F.col("doc_id").cast("string").cast("binary")) % HELD_OUT_MODULUS == 1).alias("held_out")
    if model is None:
        return docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out, F.lit(0.0).alias("score"), F.lit(0).alias("predicted"))
    found = evidence(docs.withColumn("doc_id", F.col("doc_id").cast("long")), model, ["doc_id"])
    return found.select("doc_id", held_out, "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
