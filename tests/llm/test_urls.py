"""Redirect equivalence against an HTML parser, urllib and union-find."""

import random
from html.parser import HTMLParser
from urllib.parse import urljoin, urlsplit, urlunsplit

import duckdb
import pytest

from orfloom.llm import urls
from orfloom.llm.queries import URL_RULES
from orfloom.llm.sql import OP10
from orfloom.llm.urls import judge_urls, with_url_key

PAGES = "page_id long, url string, html string, host string, verdict int"


class Links(HTMLParser):
    def __init__(self):
        super().__init__()
        self.found = []

    def handle_starttag(self, tag, attrs):
        attrs = dict(reversed(attrs))
        if tag == "link" and "canonical" in (attrs.get("rel") or "").lower().split():
            self.found.append(attrs.get("href") or "")
        if tag == "meta" and (attrs.get("http-equiv") or "").lower() == "refresh":
            content = attrs.get("content") or ""
            self.found.append(content.partition("=")[2].strip("\"' ") if "url=" in content.lower() else content.partition(";")[2].strip())

    handle_startendtag = handle_starttag


def named(url):
    parts = urlsplit(urljoin(url, urlsplit(url).path or "/"))  # urljoin folds dot segments
    return urlunsplit((parts.scheme, parts.netloc.lower(), parts.path or "/", urlsplit(url).query, ""))


def plain(rows, rules):
    parent = {}

    def root(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    def rule(url):
        host, path = urlsplit(url).netloc, urlsplit(url).path
        fits = [(len(h + p), what == "allow", what) for what, h, p in rules if (host == h or host.endswith("." + h)) and path.startswith(p)]
        return max(fits)[2] if fits else None

    for _, url, html in rows:
        parser = Links()
        parser.feed(html or "")
        for link in parser.found:
            if url and link and not link.startswith(("#", "mailto:")):
                parent[root(named(url))] = root(named(urljoin(url, link)))
    groups = {}
    for x in list(parent):
        groups.setdefault(root(x), set()).add(rule(x))
    out = {}
    for i, url, _ in rows:
        shared = groups.get(root(named(url)), set()) if url else set()
        own = rule(url.split("#")[0]) if url else None
        out[i] = own or ("allow" if "allow" in shared else "block" if "block" in shared else "allow")
    return out


def pages():
    rng = random.Random(4)
    hosts = ["http://a.test", "https://B.test", "http://bad.example.org", "http://good.example.org"]
    paths = ["/", "/x/y", "/x/z", "/es/1", "/en/1", "/x/", "/q?a=1&b=2", "/x/w?p=2", ""]
    links = ["../x/y", "./z", "?a=1&amp;b=2", "/q?a=1&amp;b=2", "//b.test/x/", "http://bad.example.org/es/1", "#top", "", "mailto:x@y.z", "../../es/1", "w?p=2", "/x/../q?a=1&#38;b=2", "http://good.example.org"]
    tags = [
        '<link rel="canonical" href="{}">', "<LINK href='{}' rel='alternate canonical' />", '<link data-href="/es/1" rel=canonical title="a>b" href="{}">', '<meta http-equiv="refresh" content="0; url={}">',
        "<meta content=\"5;URL='{}'\" http-equiv=Refresh>", '<!-- <link rel=canonical href="{}"> -->', '<script>"<link rel=canonical href={}>"</script>', '<link rel="stylesheet" href="{}">',
    ]
    rows = [(i, rng.choice(hosts) + rng.choice(paths), " ".join(rng.choice(tags).format(rng.choice(links)) for _ in range(rng.randint(0, 3)))) for i in range(60)]
    rows += [(100, "http://c.test/d/e/p", '<link rel=canonical href="../f">'), (101, "http://c.test/d/f", '<link rel=canonical href="/one"><link rel=canonical href="http://x.example.org/es/9">')]
    return [*rows, (102, None, '<link rel=canonical href="/es/">'), (103, "no scheme", None), (104, "http://d.test/", "x" * 2_000_000 + '<link rel=canonical href="http://x.example.org/es/9">')]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame([(*r, "h", 1) for r in pages()], PAGES)


def test_verdicts_follow_every_alias(frame, monkeypatch):
    rows = [r for r in pages() if r[0] != 103]
    want = plain(rows, URL_RULES) | {103: "allow"}
    assert want[100] == want[101] == want[104] == "block"
    got = {r["page_id"]: r["verdict"] for r in judge_urls(frame, URL_RULES).collect()}
    assert got == want
    monkeypatch.setattr(urls, "MOST_RULES", 2)  # rules by a join
    assert {r["page_id"]: r["verdict"] for r in judge_urls(frame, URL_RULES).collect()} == want
    con = duckdb.connect()
    pages_table = frame.where("page_id <> 104").select("page_id", "url", "html").toPandas()
    con.register("pages", pages_table)
    assert {r[0]: r[4] for r in con.execute(OP10).fetchall()} == {k: v for k, v in want.items() if k != 104}


def test_equal_rules_and_names(spark, monkeypatch):
    rules = [("block", "a.b", "/c"), ("allow", "a.b", "/c"), ("block", "b", "/")]
    df = spark.createDataFrame([(1, "http://x.a.b/cd", None, "h", 1), (2, "http://q.b/", "", "h", 1)], PAGES)
    for most in (200, 0):
        monkeypatch.setattr(urls, "MOST_RULES", most)
        assert sorted((r["page_id"], r["rule"], r["verdict"]) for r in judge_urls(df, rules).collect()) == [(1, "a.b/c", "allow"), (2, "b/", "block")]
    given = ["http://A.org", "HTTP://a.org/b/../c/./d/..?q=/../x#f", "http://a.org/../../x/.", " x y "]
    out = [r[0] for r in with_url_key(spark.createDataFrame([(g,) for g in given], "u string"), "u", "k").select("k").collect()]
    assert out == ["http://a.org/", "http://a.org/c/?q=/../x", "http://a.org/x/", "x y"]
