"""Secret scan, line bitmaps, decontamination, WARC, host rules: plain Python and odd rows."""

import collections
import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from telcolake.llm import decontaminate, host_rules, line_dedup, secret_scan, warc
from llm.cases import ODD

ASSIGN = re.compile(r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A)


def base_spans(text):
    found = [(m.start(), 0, m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(found)


def test_base_spans(docs_of):
    texts = ["😀 Token = 'abcdef1' secret:token = abcdefgh", "AKIAAKIA" + "Z" * 14 + " AKIASHORT", "x" + "0af" * 9, "passwd=abc", "API_KEY:\"" + "a1" * 5 + "\" apikey=zzzzzz", None, ""]
    rows = secret_scan.scan(docs_of(list(enumerate(texts)))).collect()
    for r in rows:
        assert [(s.start, s.kind, s.end) for s in r.base] == base_spans(texts[r.doc_id] or "")
        assert {(s.start, s.kind) for s in r.base} <= {(s.start, s.kind) for s in r.spans}


def test_random_strings_stand_out_from_long_words(docs_of):
    rng = random.Random(5)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(letters) for _ in range(40)) for _ in range(60)]
    words = ["".join(rng.choice(["the", "er", "ing", "lich", "ung", "on"]) for _ in range(18))[:40] for _ in range(60)]
    rows = secret_scan.scan(docs_of([(i, f"see {t} there") for i, t in enumerate(keys + words)])).collect()
    hit = {r.doc_id for r in rows if any(s.kind == 3 for s in r.spans)}
    assert len(hit & set(range(60))) >= 50 and not hit & set(range(60, 120))


def reported(rows):
    return {r.doc_id for r in rows if any(s.kind == 3 for s in r.spans)}


def test_one_key_is_enough(docs_of):
    """No count of candidates is needed; words in boilerplate, rulers, paths and repeated keys open or shut nothing."""
    rng = random.Random(8)
    letters = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789"
    keys = ["".join(rng.choice(letters) for _ in range(n)) for n in (24, 32, 40, 64)]
    digits = ["".join(rng.choice("0123456789") for _ in range(22))]
    boring = ["-" * 60, "=" * 5 + "_" * 40, "internationalizations", "src/main/resources/templates/index", "aaaaaaaaaaaaaaaaaaaaaaaaaaaa", "some-long-and-hyphenated-expression", "Donaudampfschifffahrtsgesellschaft", "1111111111111111111111111"]
    rows = [(i, f"see {t} there") for i, t in enumerate(keys + digits)] + [(100 + i, f"see {t} there") for i, t in enumerate(boring)]
    rows += [(1000 + i, "all uncharacteristically boilerplate texts") for i in range(500)] + [(2000 + i, f"again {keys[0]}") for i in range(30)]
    got = reported(secret_scan.scan(docs_of(rows)).collect())
    assert got == {*range(5), *range(2000, 2030)}


def test_battery_equals_plain_statistics(spark):
    import math

    rng = random.Random(9)
    tokens = ["".join(rng.choice("abcdef0123456789") for _ in range(30)), "".join(rng.choice("0123456789") for _ in range(25)), "extraordinarilylongword", "ABCDEFGHIJKLMNOPQRST234"]
    for r in secret_scan.with_distance(spark.createDataFrame([(t,) for t in tokens], "token string")).collect():
        alphabet = secret_scan.ALPHABETS[r.encoding]
        v, n, k = [alphabet.index(c) for c in r.token], len(r.token), len(alphabet)
        mid = (k - 1) / 2
        chi = (sum((v.count(x) - n / k) ** 2 / (n / k) for x in range(k)) - (k - 1)) / math.sqrt(2 * (k - 1) * (1 - 1 / n))
        runs = (1 + sum((a < mid) != (b < mid) for a, b in zip(v, v[1:])) - (n + 1) / 2) / math.sqrt((n - 1) / 4)
        serial = sum((a - mid) * (b - mid) for a, b in zip(v, v[1:])) / ((k * k - 1) / 12 * math.sqrt(n - 1))
        assert r.distance == pytest.approx(math.sqrt((chi**2 + runs**2 + serial**2) / 3)) and r.length == n


def test_procedure_equals_benjamini_and_hochberg(spark):
    """The steps kept against the procedure on each class's own list of probabilities."""
    rng = random.Random(10)
    rows = [(rng.randrange(3), min(400, int(rng.expovariate(0.08))), False) for _ in range(400)] + [(0, 400, True)] * 50
    got = {r.length_class: r.least for r in secret_scan.thresholds(spark.createDataFrame(rows, "length_class int, step int, decoy boolean")).collect()}
    for c in range(3):
        p = sorted(10 ** (-s / 10) for k, s, d in rows if k == c and not d)
        good = [x for i, x in enumerate(p, 1) if x <= secret_scan.FDR * sum(y <= x for y in p) / len(p)]
        assert got.get(c) == (round(-10 * __import__("math").log10(max(good))) if good else None)


def test_random_strings_are_seldom_taken_for_words(docs_of):
    rng = random.Random(12)
    keys = ["".join(rng.choice(secret_scan.ALPHABETS["base62"]) for _ in range(40)) for _ in range(500)]
    assert len(reported(secret_scan.scan(docs_of(list(enumerate(keys)))).collect())) >= 480


def test_secret_scan_of_odd_rows(odd, docs_of):
    assert secret_scan.scan(odd).count() == len(ODD)
    assert secret_scan.scan(docs_of([])).count() == 0


def test_lines(docs_of, monkeypatch):
    rng = random.Random(3)
    pool = [f"  Shared line number {i} of the pool\t" for i in range(12)]
    rows = [(d, "\n".join(rng.choice(pool + [f"own {rng.random()} line here, long", "short"]) for _ in range(rng.randrange(0, 12)))) for d in range(60)]
    rows += [(100 + d, pool[0].upper() + "\nx") for d in range(200)] + [(None, pool[0]), (300, None)]
    holders = collections.defaultdict(set)
    key = lambda line: line.strip(" \t\n\x0b\x0c\r").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    for d, t in rows:
        for line in (t or "").split("\n"):
            holders[key(line)].add(-1 if d is None else d)
    want = {}
    for d, t in rows:
        lines = (t or "").split("\n")
        keep = [x for x in lines if not (len(key(x)) >= 20 and len(holders[key(x)]) >= 3 and max(holders[key(x)]) != (-1 if d is None else d))]
        want[d] = (len(lines), len(lines) - len(keep), "\n".join(keep))
    for hot in (1000, 1):  # all hashes cold or hot, or one hot
        monkeypatch.setattr(line_dedup, "HOT_HASHES", hot)
        got = {r.doc_id: (r._n_lines, r._n_dropped, r._kept) for r in line_dedup.drop_lines(docs_of(rows)).collect()}
        assert got == want


def test_lines_of_odd_rows(odd, docs_of):
    out = line_dedup.drop_lines(odd)
    assert out.count() == len(ODD) and set(odd.columns) <= set(out.columns)
    assert line_dedup.drop_lines(docs_of([])).count() == 0


def test_bitmaps_are_runs(docs_of):
    line = "a line that all the documents share"
    rows = [(i, f"mine {i}\n{line}\n{line}\nmore {i}") for i in range(3)]
    maps = {r.doc: (r.runs, r.tail_from) for r in line_dedup.keep_bitmaps(docs_of(rows)).collect()}
    assert maps == {0: ([1, 2], 3), 1: ([1, 2], 3)}


def python_hits(docs, items, size=10):
    up = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(up))
    windows = collections.defaultdict(set)
    for i, t in items:
        w = words(t)
        for k in range(max(1, len(w) - size + 1) if w else 0):
            windows[tuple(w[k : k + size])].add(str(i))
    out = []
    for d, t in docs:
        w, hit, names = words(t), set(), set()
        for win, ids in windows.items():
            for k in range(len(w) - len(win) + 1):
                if tuple(w[k : k + len(win)]) == win:
                    hit |= set(range(k, k + len(win)))
                    names |= ids
        out.append((d, len(w), len(hit), sorted(names)))
    return sorted(out, key=repr)


def test_decontamination(spark, docs_of):
    rng = random.Random(1)
    text = lambda n: " ".join(rng.choice(["the", "of", "Deep", "é1", "zz", "q"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 3, 9, 10, 14]))) for i in range(12)] + [(3, "the the the the the the the the the the the"), (50, None), (51, "Deep")]
    docs = [(i, text(40) + " " + (rng.choice(items)[1] or "").upper().replace("É", "é") + "\n" + text(5)) for i in range(40)] + [(90, "the " * 60), (91, None), (92, "")]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = [(r.doc_id, r.n_words, r.n_hit, r["items"]) for r in decontaminate.contamination(docs_of(docs), bench).collect()]
    assert sorted(got, key=repr) == python_hits(docs, items)


def test_decontamination_of_odd_rows(spark, odd, docs_of):
    bench = spark.createDataFrame([(1, "twice the same text")], "item_id long, text string")
    assert decontaminate.contamination(odd, bench).filter("n_hit > 0").count() == 2
    assert decontaminate.contamination(odd, bench.limit(0)).filter("n_hit > 0").count() == 0
    assert decontaminate.contamination(docs_of([]), bench).count() == 0


def test_proximity(spark):
    docs = spark.createDataFrame([(1, "alpha x beta y gamma"), (2, "alpha x x x x x x beta gamma"), (3, "gamma beta alpha")], "doc long, text string")
    queries = spark.createDataFrame([(7, ["alpha", "beta", "gamma"]), (8, ["alpha", "nowhere"])], "query_id long, terms array<string>")
    got = sorted(tuple(r) for r in decontaminate.proximity_matches(docs, queries, 5).collect())
    assert got == [(1, 7, 0), (3, 7, 0)]


def test_warc(spark, tmp_path):
    rows = [(3, "http://a/", "same"), (1, "http://b/", "same"), (2, "http://c/\r\nd", "x\r\n\r\nWARC/1.1\r\nWARC-Type: fake"), (4, None, None), (5, "u", ""), (None, "http://n/", "same"), (6, "v", "é😀\r\n\r\n"), (6, "v", "é😀\r\n\r\n")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("n", F.lit("x")).withColumn("digest", F.lit(1))
    path = str(tmp_path / "warc")
    warc.write_archives(pages, path)
    captures = warc.assemble(warc.read_records(spark, path)).collect()
    assert all(c.n_requests >= 1 and c.n_metadata >= 1 and c.response for c in captures)
    bodies = {c.metadata.fields.get("page-id"): bytes(c.response.payload).decode() for c in captures if c.response.type == "response"}
    assert bodies == {"1": "same", "2": rows[2][2], "4": "", "6": "é😀\r\n\r\n"}
    digests = {(r.page_id, r.record_type, r.refers_to, r.payload_bytes) for r in warc.page_digests(spark, path).collect()}
    assert digests == {(1, "response", None, 4), (3, "revisit", 1, 4), (None, "revisit", 1, 4), (2, "response", None, 30), (4, "response", None, 0), (5, "revisit", 4, 0), (6, "response", None, 10)}


def test_records_from_record_wise_gzip():
    import gzip

    record = b"WARC/1.1\r\nWARC-Type: metadata\r\nContent-Length: 3\r\n\r\na:b\r\n\r\n"
    assert [b for _, b in warc.parse_records(gzip.compress(record) * 2)] == [b"a:b", b"a:b"]


def test_orphans_and_chains(spark, tmp_path):
    head = lambda kind, rid, to: f"WARC/1.1\r\nWARC-Type: {kind}\r\nWARC-Record-ID: {rid}\r\n" + (f"WARC-Concurrent-To: {to}\r\n" if to else "") + "Content-Length: 0\r\n\r\n"
    text = "\r\n\r\n".join([head("response", "r1", None), head("request", "q1", "r1"), head("metadata", "m1", "q1"), head("request", "q9", "gone")]) + "\r\n\r\n"
    (tmp_path / "a.warc").write_bytes(text.encode())
    got = {c.capture_id: (c.response and c.response.record_id, c.request and c.request.record_id, c.metadata and c.metadata.record_id) for c in warc.assemble(warc.read_records(spark, str(tmp_path))).collect()}
    assert got == {"r1": ("r1", "q1", "m1"), "gone": (None, "q9", None)}


def test_warc_of_nothing(spark, tmp_path):
    path = str(tmp_path / "none")
    warc.write_archives(spark.createDataFrame([], "page_id long, url string, html string"), path)
    assert warc.page_digests(spark, path).count() == 0


@pytest.mark.parametrize("text", ["a b c a b c d", "a a a a", "x", "", None, "the cat\nthe cat\n\nthe cat # % <"])
def test_host_rule_counts(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    grams = collections.Counter(tuple(words[i : i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) if grams[tuple(words[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if x.strip()]
    assert host_rules.counts(text) == (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(covered))


def test_host_verdicts(docs_of, odd):
    good = " ".join(f"word{i}" for i in range(60))
    rows = [(i, good, "en", "fine") for i in range(40)] + [(100 + i, good if i == 0 else "bad", "en", "spam") for i in range(60)] + [(200, "bad", "en", "tiny"), (201, good, "en", "tiny"), (202, good, None, None)]
    kept = {r.doc_id: r.kept for r in host_rules.judge(docs_of(rows, extra=False)).collect()}
    assert all(kept[i] for i in range(40)) and kept[201] and kept[202] and not kept[100] and not kept[200]
    assert host_rules.judge(odd).count() == len(ODD)
    assert host_rules.judge(docs_of([])).count() == 0


def test_hash_of_kept_text(docs_of):
    row = line_dedup.drop_lines(docs_of([(1, "a\n\nb\n")])).first()
    assert hashlib.sha256(row._kept.encode()).hexdigest() == hashlib.sha256(b"a\n\nb\n").hexdigest()
