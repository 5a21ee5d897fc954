"""URL filters against plain string code, and odd urls."""

import re

import pytest

from helixframe.llm import queries
from helixframe.llm import url_filter as U

SF = "/root/testdata/sf0.001"


def plain(url):
    u = (url or "")
    host = path = ""
    if "://" in u:
        rest = u.split("://", 1)[1]
        host = re.split(r"[/?#]", rest)[0]
        path = re.split(r"[?#]", rest[len(host):])[0]
        host = "".join(c.lower() if c.isascii() else c for c in host)
    fitting = [r for r in U.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    rule = max(fitting, key=lambda r: len(r.name), default=None)
    low = "".join(c.lower() if c.isascii() else c for c in u)

    def found(term):
        return re.findall(f"(?<![a-z0-9]){term}(?![a-z0-9])", low)
    soft = [w for t, w in U.VOCABULARY.soft if found(t)]
    bad = any(found(t) for t in U.VOCABULARY.strict) or len(soft) >= 2 and sum(soft) >= 1.5
    return host, path, rule and rule.name, rule.action if rule else "block" if bad else "allow"


ODD = [None, "", "no scheme", "://", "http://", "HTTP://A.Example.ORG/en/12?x", "http://org/x", "http://notorg/x",
       "http://example.org", "http://x.com/de/a#b", "http://x.net/CHEAP_pills", "http://x.net/cheapest-pills",
       "http://x.net/free/free", "http://x.net/?q=free&win", "http://x.net/?q=free&win-cash", "http://x.net/poker", "http://free-bets.net/", "http://ads.x.net/track", "http://xxx.net/", "http://exxx.net/", "a://b://c/d",
       "http://É.net/casinoé", "http://x.net/casino\n/y", "http://x.net/" + "a" * 50_000 + "/porn", "http://U@x.net:80/a?b#c"]


def test_odd_urls_and_clashing_columns(spark):
    rows = spark.createDataFrame([(i, u, "mine", 7) for i, u in enumerate(ODD + ODD[5:6])],
                                 "page_id long, url string, host string, n_soft int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in U.filter_urls(rows).collect()}
    assert got == {i: plain(u) for i, u in enumerate(ODD + ODD[5:6])}
    assert U.filter_urls(rows.limit(0)).count() == 0


def test_query_against_plain_code(spark):
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in queries.op3_url_filter(spark, SF).collect()}
    assert got == {r.page_id: plain(r.url) for r in spark.read.parquet(f"{SF}/pages.parquet").collect()}
    assert {"allow", "block"} == {v[3] for v in got.values()}


def test_weights_and_empty_vocabulary():
    heavy = U.Vocabulary(strict=(), soft=(("free", 0.5), ("win", 0.5), ("bets", 1.0)))
    assert U.count_hits("free-win", heavy) == (0, 2, 1.0)
    assert U.count_hits("free", U.Vocabulary(strict=(), soft=())) == (0, 0, 0.0)
    assert U.count_hits("free", U.Vocabulary(strict=("free",), soft=(("free", 1.0),))) == (1, 0, 0.0)


def test_weights_decide():
    def verdict(url):
        return plain(url)[3]
    assert U.VOCABULARY.soft_limit < U.VOCABULARY.min_soft
    assert [verdict(f"http://x.net/{p}") for p in ("free-win", "free-win-cash", "poker", "poker-free", "ads-track", "ads-free")] == [
        "allow", "block", "allow", "block", "block", "allow"]


def test_vocabulary_from_rows(spark):
    rows = spark.createDataFrame([("Free", 0.5), ("free", 1.0), ("xxx", None), ("win", 2.0), ("win", None), ("", 1.0), (None, 1.0)],
                                 "term string, weight double")
    found = U.vocabulary_from(rows, min_soft=1, soft_limit=1.0)
    assert found == U.Vocabulary(strict=("win", "xxx"), soft=(("free", 1.0),), min_soft=1, soft_limit=1.0)
    pages = spark.createDataFrame([("http://a.b/FREE",), ("http://a.b/freely",)], "url string")
    assert [r.verdict for r in U.filter_urls(pages, vocabulary=found).collect()] == ["block", "allow"]
    assert U.vocabulary_from(rows.limit(0)).strict == ()
    for bad in (0.0, -1.0, float("inf"), float("nan")):
        with pytest.raises(ValueError):
            U.vocabulary_from(spark.createDataFrame([("free", bad)], "term string, weight double"))
    with pytest.raises(ValueError):
        U.vocabulary_from(rows, max_terms=2)
