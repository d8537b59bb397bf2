import random
from urllib.parse import urljoin, urlparse, urlunparse

import pytest
from pyspark.sql import functions as F

from pagemill.functions import urls


def canonical(value):
    u = urlparse(value)
    return urlunparse((u.scheme.lower(), u.netloc.lower(), u.path or "/", u.params, u.query, ""))


ODD = [
    "HTTPS://Ex.COM:443/Docs;a?B=1#x", "http://a.b", "http://a.b?x", "http://a.b/p;",
    "http://a.b/p;?q", "http://a.b/x;y/z;", "foo", "", "mailto:A@b", "http://a.b/?", "//h/p",
    "  http://A/b\n", "example.com:8080", "file:///x", "a;b", "http://a/b;;c", "http://u:P@H/",
    "/just/path", "?q", "http://a/#", "http://a/b?x=1?y=2#z#w",
]


def test_canonical_equals_standard_library(column):
    assert column(ODD, urls.canonical_url) == [canonical(u) for u in ODD]


def test_resolve_equals_standard_library(spark):
    bases = ["http://a.b/c/d/e;p?q#f", "https://h", "https://h/x/", "http://a.b/c/d.html?z=1"]
    refs = [
        "", "g", "./g", "g/", "/g", "//g", "?y", "g?y", "#s", "g#s", "..", "../", "../g",
        "../../../g", ".", "./", "/./g", "/../g", "g.", "..g", "./../g", "g/./h", "http://z/../a",
        "mailto:x@y", "javascript:void(0)", "g//h", "//g/a//b", "a/b/../c?x=/../y", "/a//b",
    ]
    parts = ["a", "b", "..", ".", "c.html", ""]
    dice = random.Random(7)
    refs += ["/".join(dice.choices(parts, k=dice.randint(1, 6))) for _ in range(60)]
    rows = [(b, r, urljoin(b, r)) for b in bases for r in refs if not r.startswith("//")]
    got = spark.createDataFrame(rows, "b string, r string, e string").select(
        "b", "r", "e", urls.resolve_url(F.col("b"), F.col("r")).alias("g")
    )
    assert [row for row in got.collect() if row.e != row.g] == []


def test_domain(column):
    given = ["https://Example.COM:443/docs", "example.com/x", "http://u:p@h.:1/", "http://[::1]:8/x", ""]
    assert column(given, urls.url_domain) == ["example.com", "example.com", "h", "[::1]", None]


def test_seed(column):
    given = ["example.com/docs", "http://a/b", "ftp://a/b", "example.com:8080", "", "/x"]
    assert column(given, urls.seed_url) == [
        "https://example.com/docs", "http://a/b", None, None, None, None
    ]


def test_bad_seed_fails_when_asked(column):
    with pytest.raises(Exception, match="HTTP"):
        column(["ftp://a/b"], lambda c: urls.seed_url(c, "raise"))


def test_filters(column):
    given = ["https://example.com/docs/a", "https://example.com/about"]
    assert column(given, lambda c: urls.url_matches(c, ["/docs/", "/blog/"])) == [True, False]
    assert column(given, lambda c: urls.url_matches(c, None)) == [True, True]


def test_prefix_scope(column):
    assert urls.prefix_scope_pattern("host") == "^https?://host(/.*)?$"
    given = ["http://a.b/c", "https://a.b/c/d", "http://a.b/cd", "http://aXb/c"]
    pattern = urls.prefix_scope_pattern("https://a.b/c/?q#f")
    assert column(given, lambda c: urls.url_matches(c, pattern)) == [True, True, False, False]
    with pytest.raises(ValueError):
        urls.prefix_scope_pattern("")


def test_escape(column):
    given = ["http://a/é b?x=<1>&y=%20", "http://a/\U0001f600", "http://a/[x]|"]
    assert column(given, urls.escape_url) == [
        "http://a/%C3%A9%20b?x=%3C1%3E&y=%20", "http://a/%F0%9F%98%80", "http://a/[x]|"
    ]


def test_sitemap_seeds(spark):
    df = spark.createDataFrame([("https://Example.com/x",), ("https://example.com/y",)], ["url"])
    assert {r.sitemap_url for r in urls.sitemap_seeds(df).collect()} == {
        "https://example.com/robots.txt", "https://example.com/sitemap.xml"
    }
