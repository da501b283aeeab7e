"""Golden values of the scalar rules (URL, trust, priority, similarity, scores)."""

import pytest
from pyspark.sql import functions as F

from linkledger.functions import scoring, trigram, urls


def one(spark, col, **cols):
    df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{k} {t}" for k, (v, t) in zip(cols, [(v, _t(v)) for v in cols.values()])))
    return df.select(col.alias("x")).first()["x"]


def _t(v):
    return {str: "string", float: "double", int: "int", bool: "boolean"}[type(v)]


@pytest.mark.parametrize("url,expected", [
    ("https://example.com/page?query=123", "https://example.com/page"),
    ("https://example.com/page#section", "https://example.com/page"),
    ("https://example.com/page?query=123#section", "https://example.com/page"),
    ("HTTP://Example.com:8080/a/b;p?q", "http://Example.com:8080/a/b"),
    ("https://user:pw@host.org/x/", "https://user:pw@host.org/x/"),
    ("https://h.com/a;x/b;y", "https://h.com/a;x/b"),
    ("example.com/page", "://example.com/page"),
    ("", "://"),
    ("mailto:a;b", "mailto://a;b"),
])
def test_normalize_url(spark, url, expected):
    from urllib.parse import urlparse
    p = urlparse(url)
    assert f"{p.scheme}://{p.netloc}{p.path}" == expected        # the rule being matched
    assert one(spark, urls.normalize_url("u"), u=url) == expected


@pytest.mark.parametrize("url,expected", [
    ("https://example.com", 0.5), ("https://example.org", 1.0), ("https://news.com", 1.0),
    ("https://weeklydigest.com", 0.8), ("https://blog.com", 0.5), ("https://x.gov/preview", 1.0),
])
def test_url_trust(spark, url, expected):
    assert one(spark, urls.url_trust("u"), u=url) == expected


def test_priority(spark):
    assert abs(one(spark, scoring.frontier_priority("r", "s"), r=0.9, s=0.8) - 0.865) < 1e-9
    p = one(spark, scoring.frontier_priority("r", urls.url_trust("u")), r=1.0, u="https://example.org/review")
    assert 0.9999 <= p <= 1.0001
    p = one(spark, scoring.frontier_priority("r", urls.url_trust("u")), r=0.0, u="https://unknown.com")
    assert 0.0 <= p <= 0.5


@pytest.mark.parametrize("v,expected", [(0.825, 1), (0.93, 1), (1.0, 1), (2.5, 3), (0.5, 1), (60.0, 60), (0.4, 0)])
def test_priority_int_rounds_half_away(spark, v, expected):
    assert one(spark, scoring.priority_int("p"), p=v) == expected


def test_domain_and_host(spark):
    assert one(spark, urls.url_domain(urls.normalize_url("u")), u="https://a.b.com:81/x/y") == "a.b.com:81"
    assert one(spark, urls.url_host("u"), u="a.b.com:81/x") == "a.b.com"
    assert one(spark, urls.homepage("u"), u="HTTP://www.site.com/index/page1") == "http://www.site.com/"


@pytest.mark.parametrize("a,b,expected", [
    ("word", "words", 4 / 7), ("word", "two words", 4 / 11), ("Fancy Bistro", "fancy bistro", 1.0), ("abc", "xyz", 0.0),
])
def test_trigram_similarity(spark, a, b, expected):
    import numpy as np
    got = one(spark, trigram.similarity("a", "b"), a=a, b=b)
    assert got == float(np.float32(expected))


def test_quality_step_and_decay(spark):
    assert one(spark, scoring.quality_step("q", "r"), q=0.2, r=0.7) == pytest.approx(0.22)
    assert one(spark, scoring.quality_step("q", "r"), q=0.99, r=90.0) == 1.0
    assert one(spark, scoring.quality_step("q", "r", 0.2), q=0.0, r="0.8") == pytest.approx(0.06)
    assert one(spark, scoring.decayed_priority("p"), p=80) == 60.0
    assert one(spark, scoring.rejected_priority("r"), r=0.75) == 75.0
    assert one(spark, scoring.seed_relevance("i"), i=True) == 1.0
    assert one(spark, scoring.seed_relevance("i"), i=False) == 0.99


def test_derived_priority(spark):
    df = spark.createDataFrame([("https://a.com/fancy-bistro", ["Fancy-Bistro", "Other"], 40)],
                               "u string, names array<string>, p int")
    got = df.select(scoring.derived_priority("u", "names", "p")).first()[0]
    assert got == pytest.approx(100 * (0.5 * 0.4 + 0.3 * 0.5 + 0.2 * 0.4))
    df = spark.createDataFrame([("https://a.com", [], 40)], "u string, names array<string>, p int")
    assert df.select(scoring.derived_priority("u", "names", "p")).first()[0] == pytest.approx(20.0)
