"""Main text of pages: what cues say, and what the tree finds where they say nothing."""

import html
import re

import pytest

from orfloom.llm.pages import _observed, blocks, extract, main_text, style_tree
from pyspark.sql import functions as F

PAGES = "page_id long, url string, html string, text string, host string, removed int"


def texts(spark, rows):
    df = spark.createDataFrame([(i, u, h, "old", "x", 3) for i, u, h in rows], PAGES)
    got = extract(df)
    assert got.columns == ["page_id", "url", "host", "removed", "text", "n_chars"]
    return [(r["page_id"], r["text"]) for r in got.orderBy("page_id").collect() if r["n_chars"] == len(r["text"])]


CUED = """<!DOCTYPE html><html><head><title>T &amp; t</title><style>p{}</style></head><body class="has-sidebar"><header><h1>Site</h1></header>
<nav><ul><li><a href=/>Home<li>About</ul></nav><div class="cookie-notice">We use cookies</div><main><article class='post with-sidebar'><header><h1>Ti&shy;tle</h1></header>
<p>One &amp; two&nbsp;three<br>four <b>five<p>Six &lt;p&gt; 7 < 8 <span class="ad">BUY</span> nine</b> ten<ul><li>a<li>b</ul><table><tr><td>c<td>d</table>
<script>var x = "</p><p>no";</script><!-- <p>no</p> --><aside>Also read</aside><form><p>Mail me</p></form><div class="share">Tweet</div><p hidden>no</p></article>
<section id="comments"><article class="comment"><p>Great!</p></article></section></main><div>Elsewhere</div><footer>&copy; us</footer></body></html>"""


def test_cues(spark):
    want = "Ti­tle\nOne & two three four five\nSix <p> 7 < 8 nine ten\na\nb\nc\nd"
    assert texts(spark, [(1, "http://a.org/1", CUED)]) == [(1, want)]


def site(k, body):
    return f'<html><body><div id="x1"><p>Welcome to the site</p></div><div class="l{k}"><a href=/>Home</a> <a href=/b>News {k}</a></div><div class="q"><h2>Story {k}</h2>{body}</div><div class="z"><p>All rights reserved</p><p>Offer {k % 3}</p></div></body></html>'


def test_tree_finds_templates_without_cues(spark):
    rows, want = [], []
    for k in range(12):
        body = "".join(f"<p>Paragraph {k} {j}</p>" for j in range(k % 4 + 1)) + ("<p>Shared by two</p>" if k < 2 else "")
        rows.append((k, f"https://Host.example.org/{k}", site(k, body)))
        want.append((k, "\n".join([f"Story {k}", *(f"Paragraph {k} {j}" for j in range(k % 4 + 1)), *(["Shared by two"] if k < 2 else [])])))
    assert texts(spark, rows) == want


def test_odd_pages(spark):
    one = "<div><p>Alone</p><p>on its site</p></div>"
    rows = [
        (1, None, one), (2, None, one), (3, "no host", "plain <text"), (4, "http://b.org/", None), (5, "http://b.org/", ""), (6, "http://c.org/", "<p>" * 3000 + "deep" + "</div>" * 3000),
        (7, "http://d.org/", "<p>same</p>"), (7, "http://d.org/", "<p>same</p>"), (8, "http://d.org/2", "<p>same</p>"), (9, "http://e.org/", "<article>" + "long word " * 100_000 + "</article>"),
        (10, "http://f.org/", "<form><article><p>in a form</p></article><input></form>"), (11, "http://g.org/", "<article><p>cut &am"), (12, "http://h.org/", '<p class="a>b">q</p><p title=\'x'),
        (13, "http://i.org/", "<article><![CDATA[a &amp; b]]> c&#8364;&#x41;&notanentity; &lt</article>"),
    ]
    got = texts(spark, rows)
    alone = "Alone\non its site"
    assert got[:2] == [(1, alone), (2, alone)] and got[2:6] == [(3, "plain"), (4, ""), (5, ""), (6, "deep")]
    assert got[6:9] == [(7, "same"), (7, "same"), (8, "same")] and got[9] == (9, ("long word " * 100_000).strip())
    assert got[10:] == [(10, "in a form"), (11, "cut &am"), (12, "q"), (13, "a &amp; b c€A¬anentity; <")]
    assert texts(spark, []) == []


def test_importance_is_entropy(spark):
    pages = [(k, "h", f'<div class="m"><p>menu</p></div><div class="b">{"<p>x</p>" * (k % 2 + 1)}</div>') for k in range(4)]
    tree = style_tree(_observed(spark.createDataFrame(pages, "page long, host string, html string")))
    rows = sorted((round(r["presentation"], 6), r["pages"], r["cue"]) for r in tree.collect())
    assert rows == [(0.0, 4, 0), (0.5, 4, 0)]  # one look on 4 pages; two looks, 2 pages each: log 2 / log 4
    assert tree.where(F.col("importance") < 0.5).count() == 0


@pytest.mark.parametrize("sf", ["sf0.001", "sf0.01"])
def test_pages_of_the_tables_against_a_plain_cut(spark, sf):
    pages = spark.read.parquet(f"/root/testdata/{sf}/pages.parquet")
    want = {}
    for r in pages.collect():
        inside = re.search(r"<article>(.*)</article>", r["html"], re.S)[1].replace("<br>", " ")
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", x)).split()) for x in re.split(r"</?(?:p|h1)>", inside)]
        want[r["page_id"]] = "\n".join(x for x in lines if x)
    assert {r["page_id"]: r["text"] for r in extract(pages).collect()} == want


def test_blocks_say_how_much_is_linked():
    found, styles = blocks("<div><a href=x>one two</a> three</div>")
    assert [(b.text, b.linked, b.cue) for b in found] == [("one two three", 6, 0)] and set(styles) == {found[0].node}
    assert main_text("", "s", set()) == ""
