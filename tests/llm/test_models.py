"""Learned operators on held-out rows, the Jaccard join and the pipeline against plain Python."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

import corpus_pipeline
from telcolake.llm import jaccard_join, quality, toxicity
from telcolake.llm.queries import QUERIES
from llm.cases import ODD

SF_DIR = "/root/testdata/sf0.01"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def python_components(rows, words, percent):
    """doc_id -> (set size, smallest doc_id reachable), by comparing all pairs that share a shingle."""
    sets = {}
    for d, t in rows:
        w = WORD.findall((t or "").translate(UP))
        sets[d] = frozenset(tuple(w[i : i + words]) for i in range(len(w) - words + 1)) if len(w) >= words else frozenset([tuple(w)] if w else [])
    holders = {}
    for d, s in sets.items():
        for x in s:
            holders.setdefault(x, []).append(d)
    parent = {d: d for d in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for d, s in sets.items():
        for o, both in Counter(o for x in s for o in holders[x] if o < d).items():
            if 100 * both >= percent * (len(s) + len(sets[o]) - both):
                a, b = root(d), root(o)
                parent[max(a, b)] = min(a, b)
    return {d: (len(s), root(d)) for d, s in sets.items()}


def near_copies(seed=2):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = " ".join(rng.choice(vocabulary) for _ in range(60))
    rows = []
    for group in range(6):
        base = [rng.choice(vocabulary) for _ in range(rng.choice([5, 40, 120]))]
        for _ in range(rng.choice([1, 3, 25])):
            copy = list(base)
            for _ in range(rng.choice([0, 1, 2, 4])):
                copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
            rows.append(" ".join(copy))
    rows += [passage + " " + " ".join(rng.choice(vocabulary) for _ in range(rng.choice([3, 9, 30, 80]))) for _ in range(25)]
    rows += ["one two", "One two", "one", "", None, " \n"]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("words, percent, hot", [(4, 85, 40), (5, 80, 4)])
def test_join_is_exact(docs_of, monkeypatch, words, percent, hot):
    monkeypatch.setattr(jaccard_join, "HOT_SETS", hot)
    monkeypatch.setattr(jaccard_join, "TASK_MEMBERS", 7)
    monkeypatch.setattr(jaccard_join, "PIVOTS", (1, 3, 20))
    rows = near_copies()
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.similar_sets(docs_of(rows), words, percent).collect()}
    assert got == python_components(rows, words, percent)


def test_join_of_odd_rows(odd, docs_of):
    assert jaccard_join.similar_sets(odd).count() == len(ODD)
    assert jaccard_join.similar_sets(docs_of([])).count() == 0


def test_parity_bits_never_differ_more_than_the_sets():
    import numpy as np

    draw = np.random.default_rng(1)
    sets = [np.unique(draw.integers(0, 2**63, n).astype(np.uint64)) for n in (0, 1, 50, 700, 5000)]
    sets += [np.unique(np.r_[s[len(s) // 10 :], draw.integers(0, 2**63, 20).astype(np.uint64)]) for s in sets]
    bits = jaccard_join.parities(sets)
    for s, x in zip(sets, bits):
        for t, y in zip(sets, bits):
            differ = sum(int(v).bit_count() for v in (x ^ y).view(np.uint64))
            assert differ <= len(np.setxor1d(s, t))
    assert (jaccard_join.parities([sets[2], sets[2]])[0] == bits[2]).all()


def test_components(spark):
    n = 200
    chain = spark.createDataFrame([(i, i + 1) for i in range(n)] + [(1000, 1001)], "a long, b long")
    got = {r.rep: r.comp for r in jaccard_join.components(chain).collect()}
    assert got == {**{i: 0 for i in range(n + 1)}, 1000: 1000, 1001: 1000}


def test_quality_on_labels(spark):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = QUERIES["op6_empirical_bayes"](spark, SF_DIR).collect()
    right = [r.kept == (labels[r.doc_id] == 1) for r in rows if r.doc_id in labels]
    assert np.mean(right) > 0.97


def test_sites_shrink(spark, docs_of):
    """Equal documents: one of a bad site gets a lower posterior; a site with one document follows the rest."""
    good, bad = " ".join(f"word{i} of text." for i in range(40)), "%%% $$$ " * 40
    rows = [(i, good, "en", "a") for i in range(40)] + [(100 + i, bad, "en", "b") for i in range(40)] + [(200, good, "en", "b"), (201, good, "en", "c")]
    labels = spark.createDataFrame([(i, 1, 0) for i in range(40)] + [(100 + i, 0, 0) for i in range(40)], "doc_id long, quality int, toxic int")
    got = {r.doc_id: r for r in quality.judge(docs_of(rows, extra=False), labels).collect()}
    assert got[200].site_rate < got[201].site_rate < got[0].site_rate
    assert got[0].kept and not got[100].kept and got[201].kept


def test_quality_of_odd_rows(spark, odd, docs_of):
    labels = spark.createDataFrame([(1, 0, 0), (7, 1, 0), (7, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert quality.judge(odd, labels).count() == len(ODD)
    assert quality.judge(odd, labels.limit(0)).filter("not kept").count() == 0
    assert quality.judge(docs_of([]), labels).count() == 0


def test_toxicity_on_held_out_labels(spark):
    """About thirty toxic texts to learn from; more labels do better (README)."""
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF_DIR}/labels.parquet").collect()}
    rows = QUERIES["op8_string_kernel"](spark, SF_DIR).collect()
    known = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    right = sum(p and t for p, t in known)
    assert right >= 0.9 * sum(p for p, _ in known) and right >= 0.5 * sum(t for _, t in known)
    assert all(0 <= r.score <= 1 for r in rows)


def test_toxicity_with_more_labels(spark):
    """Of the toxic texts of this table one in sixteen holds no insult at all; the others are found."""
    folder = "/root/testdata/sf0.1"
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op8_string_kernel"](spark, folder).collect()
    known = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    right = sum(p and t for p, t in known)
    assert right >= 0.95 * sum(p for p, _ in known) and right >= 0.8 * sum(t for _, t in known)


def test_kernel_bears_gaps():
    marks = toxicity.Landmarks(["grumblefoot"])
    own, near, gapped, far = marks.kernel([toxicity.unit(w) for w in ("grumblefoot", "grum-ble.foot", "grumxblefoot", "watermelon")])[:, 0]
    assert near == own > 0.8 and gapped > 0.6 * own and far < 0.1
    # A unit of few subsequences is like nothing, not even itself.
    assert toxicity.Landmarks(["ach"]).kernel(["ach", "achlich"]).max() < 0.5


def plain_kernel(a, b):
    """Common subsequences of three characters within six, by enumeration."""

    def subsequences(unit):
        found = Counter()
        unit = toxicity.START + unit
        for i in range(len(unit)):
            for j in range(i + 1, len(unit)):
                for k in range(j + 1, min(len(unit), i + toxicity.SPAN)):
                    found[unit[i] + unit[j] + unit[k]] += toxicity.DECAY ** (k - i - 2)
        return found

    x, y = subsequences(a), subsequences(b)
    length = lambda v: (sum(w * w for w in v.values()) + toxicity.SHORT) ** 0.5
    return sum(w * y[c] for c, w in x.items()) / (length(x) * length(y))


def test_kernel_equals_enumeration():
    units = ["grumblefoot", "grmblefoot", "foot", "tofoo", "aaaa", "abc", "ab", "xyzzy"]
    got = toxicity.Landmarks(units).kernel(units)
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            assert got[i, j] == pytest.approx(plain_kernel(a, b), abs=1e-5)


def test_landmarks_cover_all_families():
    rng = random.Random(3)
    stems = ["".join(rng.choice("abcdefghijklmnoprstuvwz") for _ in range(9)) for _ in range(300)]
    chosen = toxicity._farthest([*sorted(stems), *[s + "ing" for s in stems]], 450)
    assert len(chosen) == 450
    likeness = toxicity.Landmarks(chosen).kernel(stems).max(axis=1)
    assert likeness.min() > 0.5  # the last of the alphabet too


def toxic_texts(seed, insults, n=900):
    """(doc_id, text, toxic): ordinary words, and in a third of the texts an insult every twentieth word, some written with marks."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abdeilmnorstu") for _ in range(rng.randrange(2, 9))) for _ in range(2000)]
    rows = []
    for i in range(n):
        words = [rng.choice(vocabulary) for _ in range(rng.randrange(60, 200))]
        toxic = int(i % 3 == 0)
        if toxic:
            for at in range(rng.randrange(20), len(words), 20):
                word = rng.choice(insults)
                cut = rng.randrange(2, len(word) - 2)
                words[at] = rng.choice([word, word + "s", word[:cut] + "-" + word[cut:], word[:cut] + "x" + word[cut:], " ".join(word)])
        rows.append((i, " ".join(words), toxic))
    return rows


@pytest.mark.parametrize("kinds", [12, 60])
def test_invented_insults(spark, docs_of, kinds):
    """Insults with marks, inserted letters and letters apart, on texts whose labels the model has not seen."""
    rng = random.Random(11)
    insults = ["".join(rng.choice("bcdfghjklmpqvwxyz") + rng.choice("aeiou") for _ in range(4)) for _ in range(kinds)]
    rows = toxic_texts(4, insults)
    labels = spark.createDataFrame([(i, 1, t) for i, _, t in rows], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in toxicity.score(docs_of([(i, t) for i, t, _ in rows], extra=False), labels).collect()}
    truth = [(found[i].predicted, t) for i, _, t in rows if found[i].held_out]
    right = sum(p and t for p, t in truth)
    assert right >= 0.9 * sum(t for _, t in truth) and right >= 0.9 * sum(p for p, _ in truth)


def test_only_near_copies_are_kin(docs_of):
    """10,000 unlike texts that share long words stay apart; a text with two words changed joins its original."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefghilmnorstu") for _ in range(rng.randrange(3, 12))) for _ in range(3_000)]
    texts = [[rng.choice(vocabulary) for _ in range(60)] for _ in range(10_000)]
    copies = [list(t) for t in texts[:50]]
    for t in copies:
        t[10] = t[40] = "changed"
    rows = [(i, " ".join(t)) for i, t in enumerate(texts + copies)]
    signed = toxicity.signatures(docs_of(rows, extra=False)).collect()
    kin = toxicity._kin([tuple(r) for r in signed])
    assert len(kin) == 10_050 and len(set(kin.values())) == 10_000
    assert all(kin[10_000 + i] == kin[i] for i in range(50))


def test_toxicity_of_odd_rows(spark, odd, docs_of):
    labels = spark.createDataFrame([(6, 0, 1), (7, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    assert toxicity.score(odd, labels).count() == len(ODD)
    assert toxicity.score(odd, labels.limit(0)).filter("score <> 0").count() == 0
    assert toxicity.score(docs_of([]), labels).count() == 0


def test_stages_against_python(spark):
    """Each stage on what the stage before left, by plain rules over the whole rows."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    for name, stage in corpus_pipeline.STAGES:
        before = docs.collect()
        after = stage(spark, docs, "/root/testdata/sf0.001")
        rows = after.collect()
        texts = {r.doc_id: r.text for r in before}
        if name == "line dedup":
            assert {r.doc_id for r in rows} == set(texts)
            assert all(r.n_chars == len(r.text) and set(r.text.split("\n")) <= set(texts[r.doc_id].split("\n")) for r in rows)
        elif name == "n-gram Jaccard join":
            want = {comp for _, comp in python_components(list(texts.items()), 5, 80).values()}
            assert sorted(r.doc_id for r in rows) == sorted(want)
        elif name == "packing":
            assert {r.doc_id for r in rows} == set(texts)
            continue
        assert after.columns == docs.columns
        docs = spark.createDataFrame(rows, docs.schema)


def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_pipeline_gives_the_tokens(spark):
    rows = corpus_pipeline.packing_stage(spark, spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(40), "/root/testdata/sf0.001").collect()
    assert rows and all(len(r.ids) == 4 * r.length and zlib.crc32(r.ids) == r.ids_crc32 for r in rows)


# --- the pipeline's stages on odd rows --------------------------------------------------


def test_one_of_each_group_stays(spark, docs_of):
    rng = random.Random(5)
    base = [f"w{rng.randrange(500)}" for _ in range(80)]
    near = " ".join(base[:-1] + ["changed"])
    rows = [
        (4, " ".join(base)), (3, near), (9, " ".join(base)),
        (7, "one text of its own with words enough"), (7, "another text under the same number, not alike"), (7, "another text under the same number, not alike"),
        (None, near), (None, "no number and no copy of anything else"), (None, "no number and no copy of anything else"),
        (1, ""), (2, None), (None, " "), (1, ""),
    ]
    docs = docs_of([(*r, "en", "s") for r in rows])
    kept = corpus_pipeline.jaccard_join_stage(spark, docs, None)
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(
        [(3, near), rows[3], rows[4], (None, "no number and no copy of anything else"), (1, ""), (2, None), (None, " ")], key=repr
    )
    assert corpus_pipeline.jaccard_join_stage(spark, docs_of([]), None).count() == 0


def test_stages_bear_odd_rows(spark, odd, docs_of):
    for name, stage in corpus_pipeline.STAGES:
        for docs in (odd, docs_of([])):
            out = stage(spark, docs, SF_DIR)
            if name == corpus_pipeline.STAGES[-1][0]:
                assert (out.count() > 0) == (docs.count() > 0)
            else:
                assert out.columns == docs.columns and out.count() <= docs.count()
