"""URL verdicts: rules against plain Python, features by hand, trees on URLs kept out of fitting."""

import math

import pytest
from pyspark.sql import functions as F

from telcolake.llm import url_filter
from verification.compare import connect, difference

SF_DIR = "/root/testdata/sf0.1"
ODD_URLS = [None, "", "no scheme.com/en/", "http://", "HTTP://WWW.Example.COM/en/x?q=1#f", "x://a://b.net/fr/", "https://net/fr/a", "https://anet/fr/a", "https://n.net/fr", "http://e.com", "http://e.com?x=/en/", "http://é.example.com/en/ü/" + "y" * 50_000, "//x.net/es/", "http://a.example.com/en/\nb", "http://a.example.com/en/\nb"]


def plain(url):
    rest = (url or "").split("://", 1)[1] if "://" in (url or "") else ""
    cut = min([rest.find(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
    path = rest[cut:].split("?")[0].split("#")[0]
    best = None
    for verdict, rule in url_filter.RULES:
        its_host, its_path = rule.split("/", 1)
        if (host == its_host or host.endswith("." + its_host)) and path.startswith("/" + its_path) and len(rule) > len(best[1] if best else ""):
            best = verdict, rule
    return host, path, best[1] if best else None, best[0] if best else None


@pytest.fixture
def pages(spark):
    return lambda urls: spark.createDataFrame([(i, u, "x", 1, "y") for i, u in enumerate(urls)], "page_id long, url string, host string, label int, fold string")


def test_rules_of_odd_urls(pages):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.parsed(pages(ODD_URLS)).collect()}
    assert got == {i: plain(u) for i, u in enumerate(ODD_URLS)}


def test_judging_odd_urls(pages):
    rows = url_filter.judge(pages(ODD_URLS * 3)).collect()
    assert len(rows) == 3 * len(ODD_URLS)
    for r in rows:
        host, path, rule, verdict = plain((ODD_URLS * 3)[r.page_id])
        assert (r.host, r.path, r.rule) == (host, path, rule) and r.verdict in ("allow", "block")
        assert (r.verdict == verdict and r.score is None) if rule else 0 <= r.score <= 1


def test_without_labelled_urls(pages):
    assert {r.verdict for r in url_filter.judge(pages(["http://a.org/x", None])).collect()} == {"allow"}
    assert {r.verdict for r in url_filter.judge(pages(["http://a.net/fr/x", "http://b.org/"])).collect()} == {"block"}
    assert url_filter.judge(pages([])).count() == 0
    assert {r.verdict for r in url_filter.judge(pages(["http://a.com/x"]), rules=()).collect()} == {"allow"}


def test_features(pages):
    row = url_filter.lexical(url_filter.parsed(pages(["http://a-b1.x.org/en//12/f.html?p=1&q=2#top"]))).first()
    url = row.url
    assert (row.url_length, row.host_length, row.path_length) == (len(url), 10, len("/en//12/f.html"))
    assert (row.depth, row.host_depth, row.n_parameters, row.n_hyphens) == (3, 2, 2, 1)
    assert row.url_digits == pytest.approx(sum(c.isdigit() for c in url) / len(url))
    shares = [url.count(c) / len(url) for c in set(url)]
    assert row.url_entropy == pytest.approx(-sum(p * math.log2(p) for p in shares))


def test_shares_leave_out_the_own_fold(pages):
    urls = [f"http://h{i % 7}.com/x{i}" for i in range(300)] + [f"http://a.net/fr/{i}" for i in range(40)]
    labelled = url_filter.parsed(pages(urls)).withColumn("label", F.when(F.col("verdict") == "block", 1.0).otherwise(0.0))
    known = url_filter.lexical(labelled).withColumn("fold", F.col("page_id").cast("int") % url_filter.FOLDS)
    counts = url_filter.suffix_counts(known)
    rows = known.select("page_id", "host1_bucket", "fold", "label").collect()
    for left_out in (True, False):
        for r in url_filter.with_rates(known, counts, 0.25, left_out).select("page_id", "host1_share").collect():
            own = next(x for x in rows if x.page_id == r.page_id)
            others = [x.label for x in rows if x.host1_bucket == own.host1_bucket and not (left_out and x.fold == own.fold)]
            assert r.host1_share == pytest.approx((sum(others) + url_filter.PRIOR * 0.25) / (len(others) + url_filter.PRIOR))


def test_base_columns_equal_sql(spark):
    rules = ", ".join(f"('{v}', '{r}', '{r.split('/', 1)[0]}', '/{r.split('/', 1)[1]}')" for v, r in url_filter.RULES)
    sql = f"""
        WITH p AS (SELECT page_id, translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
            regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
        r(v, rule, h, s) AS (VALUES {rules})
        SELECT page_id, any_value(host) AS host, any_value(path) AS path, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS verdict
        FROM p LEFT JOIN r ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, s) GROUP BY page_id"""
    got = url_filter.parsed(spark.read.parquet(f"{SF_DIR}/pages.parquet")).drop("url")
    assert difference(got, connect(SF_DIR), sql) is None


def test_trees_judge_urls_kept_out_of_fitting(spark):
    urls = url_filter.parsed(spark.read.parquet(f"{SF_DIR}/pages.parquet")).filter("rule is not null")
    labelled = urls.withColumn("label", F.when(F.col("verdict") == "block", 1.0).otherwise(0.0))
    out = F.pmod(F.xxhash64(F.lit("held out"), "url"), F.lit(4)) == 0
    model, counts, base, _ = url_filter.fit(labelled.filter(~out), fit_rows=500)
    judged = url_filter.scored(labelled.filter(out), model, counts, base).select("label", "score").collect()
    assert len(judged) > 200
    assert sum((r.score > 0.5) == (r.label == 1.0) for r in judged) >= 0.95 * len(judged)


def test_no_python_in_the_plan(pages):
    plan = url_filter.lexical(url_filter.parsed(pages(["http://a.com/b"])))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
