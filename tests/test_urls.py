"""Addresses against Python's own functions."""

from urllib.parse import parse_qsl, quote_plus, unquote_plus, urlencode, urljoin, urlparse, urlunparse

from pyspark.sql import functions as F

from casemill.functions import urls

BASES = ["http://h/a/b/c", "http://h/a/b/", "http://h", "http://h/", "https://h:8/a//b/c?x=1&y#f", "http://h/a?q"]
REFERENCES = [
    "", "#", "#g", "?", "?y", "?y=1#z", "g", "./g", "g/", "/g", "//o", "//o/p/../q", "../g", "../../../g", "..", ".", "./", "../", "g/../h/./i", "g;x=1/../y", "/a/../b", "/../g", "/./g", "g//h", "/a//b/..", "x/..", "https://z/q", "mailto:a@b", "javascript:void(0)", "g?y/../x", "g#s/../x", "...", "..g",
]


def test_relative_references(spark):
    pairs = [(b, r) for b in BASES for r in REFERENCES]
    got = spark.createDataFrame(pairs, "b string, r string").select("b", "r", urls.joined(F.col("b"), F.col("r")).alias("j")).collect()
    assert [(b, r, j) for b, r, j in got if j != urljoin(b, r)] == []
    none = spark.createDataFrame([(None, "x"), ("http://h", None)], "b string, r string").select(urls.joined(F.col("b"), F.col("r")).alias("j"))
    assert [r.j for r in none.collect()] == [None, None]


TEXTS = ["", " ", "a b", "é/~*", "%", "%zz%41", "+", "a=b&c", "日本", "-_.", "100%25", "%e9"]


def test_percent_encoding(spark):
    got = spark.createDataFrame([(t,) for t in TEXTS], "t string").select("t", urls.quote(F.col("t")).alias("q"), urls.unquote(F.col("t")).alias("u")).collect()
    assert [(r.t, r.q) for r in got] == [(t, quote_plus(t)) for t in TEXTS]
    assert [(r.t, r.u) for r in got] == [(t, unquote_plus(t)) for t in TEXTS]


URLS = ["http://h/p", "http://h/p?a=1&b=2&a=3#f", "http://h?a", "http://h/p?=x&&a=b=c&ViewType=7&_=9", "http://h/p?a=%41+b&é=ü", "http://h/p?_=1"]


def test_parameters(spark):
    def merged(url, extra):
        parsed = urlparse(url)
        return urlunparse(parsed._replace(query=urlencode(dict(parse_qsl(parsed.query, keep_blank_values=True)) | extra)))

    def cleaned(url):
        parsed = urlparse(url)
        return urlunparse(parsed._replace(query=urlencode([(k, v) for k, v in parse_qsl(parsed.query, keep_blank_values=True) if k not in ("_", "ViewType")])))

    df = spark.createDataFrame([(u,) for u in URLS], "u string")
    for extra in ({}, {"a": "x y", "z": "é"}):
        found = df.select("u", urls.with_query(F.col("u"), {k: F.lit(v) for k, v in extra.items()}).alias("m")).collect()
        assert [r.m for r in found] == [merged(r.u, extra) for r in found]
    found = df.select("u", urls.without_parameters(F.col("u"), ("_", "ViewType")).alias("m")).collect()
    assert [r.m for r in found] == [cleaned(r.u) for r in found]
