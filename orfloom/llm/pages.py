"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree.  A *presentation node* is a path
of block elements from the root (tags with their classes and ids, digits
alike); a *content node* is a text that stands at a presentation node.

- Presentation importance of a node that holds text: the entropy, over the m
  pages with the node, of what its parent element holds there, to base m; 1 for
  one page.  A menu looks alike on all pages (0), articles differ (1).
- Content importance: ``1 - log k / log m`` for a text that k of the m pages have
  at the node: 1 for a text of one page, 0 for one that is everywhere.
- A node's importance is ``0.4`` of the first and ``0.6`` of the second.  What a
  page says of its elements comes first: in an article or main element
  importance is 1, in menus, footers, sidebars, notices, adverts, forms,
  comments and the like 0; nodes with other links than text have no content
  importance.

Branches of less than ``LEAST_IMPORTANCE`` are removed from each page.

Pages are parsed twice: for the tree, of which only hashes are shuffled
(counts are grouped partially first, so a host with a third of all pages is
spread), and when each page has met the keys of its own removed branches.
"""

from __future__ import annotations

import html as html_lib
import re
from dataclasses import dataclass

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orfloom.llm.storage import bounded_batches, give_back, stored
from orfloom.llm.text import free_name
from orfloom.llm.urls import host_and_path

#: Weight of the presentation, and the importance under which a branch goes.
PRESENTATION, LEAST_IMPORTANCE = 0.4, 0.5
#: A node most of whose text is links is a list of links.
MOST_LINKED = 0.8

# Fixed values of HTML: block elements, elements without content, elements whose text is raw, and those never part of a text.
_BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_RAW = frozenset("iframe noembed noframes noscript script style template textarea title xmp".split())
_NEVER = frozenset("audio button canvas datalist head map meter nav aside footer object output progress select svg video label input dialog menu search".split())
#: An open element that a start tag closes first, and where looking for it stops.
_CLOSED_BY = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr",), "td": ("td", "th"), "th": ("td", "th"), "option": ("option",), "optgroup": ("option", "optgroup"), "tbody": ("tr", "tbody", "thead"), "tfoot": ("tr", "tbody", "thead")}
_NAMED = frozenset(("article", "main", "header"))
_HEADINGS = frozenset(("h1", "h2", "h3", "h4", "h5", "h6"))
_LISTS = frozenset(("ul", "ol", "dl", "table", "select", "menu", "body", "html"))

#: Words of classes, ids and roles that name what is not main text, and those that name it.
_NOISE_WORDS = re.compile(
    r"(?:ad|ads|adv|adsense|adbox|adslot|advert\w*|alert|announcement|banner|breadcrumbs?|captcha|colophon|comments?|commentlist|complementary|consent|contentinfo|cookies?|copyright|dialog|disqus|"
    r"dropdown|foot|footer|form|gdpr|lightbox|login|masthead|menu|menubar|modal|nav|navbar|navigation|newsletter|notice|notices|notification|outbrain|overlay|pager|pagination|paywall|popup|promo|promoted|promotion|"
    r"recommend\w*|related|replies|reply|respond|rightbar|leftbar|search|searchbox|share|sharing|shares|sharebar|sidebar\w*|signin|signup|skip|skyscraper|social|sponsor\w*|subnav|subscribe|subscription|taboola|"
    r"teasers?|toc|toolbar|topbar|topnav|trending|widgets?)"
)
_HEADER_WORDS = frozenset(("header", "head", "hd", "siteheader", "pageheader"))
_MAIN_WORDS = frozenset(("article", "articlebody", "articlecontent", "articletext", "maincontent", "mainarea", "maintext", "postcontent", "postbody", "entrycontent", "storybody", "blogpost"))
#: ``has-sidebar`` and the like name a layout.
_LAYOUT_WORDS = frozenset(("has", "with", "no", "without"))
_MAIN_PAIRS = re.compile(r"(?:^| )(?:article|post|entry|story|blog|main|page) (?:body|content|text|copy|area|inner)(?: |$)")

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>|</?[A-Za-z][^>]*\Z|</[^>]*>",
    re.S,
)
_ATTRIBUTE = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden")


def _hash(*parts: int | str) -> int:
    """64 bits, signed as Spark's long."""
    x = xxhash.xxh64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return x - (1 << 64) if x >> 63 else x


def _names(value: str) -> list[str]:
    """Words of a class or an id, lower-cased: cut at marks and before capitals."""
    return re.findall(r"[a-z]+|\d+", re.sub(r"([a-z])([A-Z])", r"\1 \2", value).lower())


@dataclass(frozen=True)
class _Kind:
    """What an element's tag and attributes say: its name in paths, and whether it holds noise, main text (``sure``: whatever it stands in) or a page header."""

    name: str
    noise: bool
    main: bool
    sure: bool
    header: bool


_kinds: dict[tuple[str, str], _Kind] = {}


def _kind(tag: str, attributes: str) -> _Kind:
    if (found := _kinds.get((tag, attributes))) is None:
        if len(_kinds) > 20_000:  # names of the elements met last, not a limit on pages
            _kinds.clear()
        found = _kinds[tag, attributes] = _read_kind(tag, attributes) if attributes.strip(" /") or tag in _NEVER or tag in _NAMED else _Kind(tag, False, False, False, False)
    return found


def _read_kind(tag: str, attributes: str) -> _Kind:
    values = {}
    for name, *quoted in _ATTRIBUTE.findall(attributes):
        values.setdefault(name.lower(), html_lib.unescape("".join(quoted)))
    role = values.get("role", "").strip().lower()
    labels = [_names(values.get(k, "")) for k in ("class", "id")]
    style = " ".join(sorted({re.sub(r"\d+", "#", v) for k in ("class", "id") for v in values.get(k, "").split()}))
    words = [w for ws in labels for before, w in zip(["", *ws], ws, strict=False) if before not in _LAYOUT_WORDS]
    hidden = "hidden" in values or values.get("aria-hidden", "").lower() == "true" or bool(_HIDDEN.search(values.get("style", "").lower()))
    sure = tag == "main" or role == "main" or "articlebody" in values.get("itemprop", "").lower()
    main = sure or tag == "article" or role == "article"
    compact = {"".join(_names(v)) for k in ("class", "id") for v in values.get(k, "").split()}
    main = main or bool(compact & _MAIN_WORDS) or any(_MAIN_PAIRS.search(" ".join(ws)) for ws in labels)
    noise = tag in _NEVER or hidden or bool(role and _NOISE_WORDS.fullmatch(role) and role != "banner")
    if tag not in ("html", "body"):
        named = [w for w in words if _NOISE_WORDS.fullmatch(w)]
        if tag in ("article", "main"):  # layouts are named there too: only what such an element may be itself
            named = [w for w in named if re.fullmatch(r"comments?|reply|replies|related|teasers?|ads?|advert\w*|sponsor\w*|promo\w*|recommend\w*|widgets?", w)]
        noise = noise or bool(named)
    header = tag == "header" or role == "banner" or (tag not in ("html", "body", "article", "main") and bool(set(words) & _HEADER_WORDS))
    return _Kind(f"{tag} {style}" if style else tag, noise, main and not noise, sure and not noise, header)


_nodes: dict[tuple[int, str], int] = {}


def _child(parent: int, name: str) -> int:
    """The node of a child: a hash of the path, remembered."""
    if (found := _nodes.get((parent, name))) is None:
        if len(_nodes) > 100_000:
            _nodes.clear()
        found = _nodes[parent, name] = _hash(parent, name)
    return found


class _Element:
    __slots__ = ("block", "cue", "form", "holder", "linked", "main", "node", "noise", "tag")

    def __init__(self, tag: str, kind: _Kind, parent: _Element | None):
        self.tag, self.block = tag, parent is None or tag in _BLOCKS
        if parent is None:
            self.main = self.noise = self.form = self.linked = False
            self.node = self.holder = _child(0, kind.name)
        else:
            self.main = parent.main or kind.main
            self.noise = (parent.noise and not kind.sure) or kind.noise or (kind.header and not self.main)
            self.form = tag == "form" or (parent.form and not kind.main)
            self.linked = tag == "a" or parent.linked
            self.node, self.holder = (_child(parent.node, kind.name), parent.node) if self.block else (parent.node, parent.holder)
        self.cue = -1 if self.noise or self.form else int(self.main)


@dataclass
class Block:
    node: int  # the presentation node, its cue included
    cue: int
    text: str
    linked: int  # letters of the text in links


def blocks(page: str) -> tuple[list[Block], dict[int, int]]:
    """The texts of a page in order, and by presentation node a hash of what the elements around it hold."""
    found: list[Block] = []
    root = _Element("html", _kind("html", ""), None)
    stack, open_tags = [root], {"html": 1}
    styles: dict[int, int] = {}
    parents: dict[int, int] = {}
    runs: list[tuple[str, bool]] = []

    def around() -> _Element:
        """The innermost open block element."""
        top = stack[-1]
        return top if top.block else next(e for e in reversed(stack) if e.block)

    def flush() -> None:
        if not runs:
            return
        text = " ".join("".join([t for t, _ in runs]).split())
        if text:
            at = around()
            linked = sum([len("".join(t.split())) for t, link in runs if link])
            node = 3 * at.node + at.cue  # the cue is a part of the node
            parents[node] = at.holder
            found.append(Block(node, at.cue, text, linked))
        runs.clear()

    def say(text: str) -> None:
        """Text of an inline element that is noise, in a block that is not, is no part of the block."""
        top = stack[-1]
        if top.block or not top.noise or around().noise:
            runs.append((html_lib.unescape(text) if "&" in text else text, top.linked))

    def close(to: int) -> None:
        if any(e.block for e in stack[to:]):
            flush()
        for e in stack[to:]:
            open_tags[e.tag] -= 1
        del stack[to:]

    def leave(tags: tuple[str, ...], stops: frozenset[str]) -> None:
        if not any(open_tags.get(t) for t in tags):
            return
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag in tags:
                return close(i)
            if stack[i].tag in stops:
                return None

    def leave_inline(tag: str) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i].tag == tag:
                if any(e.block for e in stack[i:]):  # closed across blocks: they stay open
                    open_tags[tag] -= 1
                    del stack[i]
                else:
                    close(i)
                return

    at, size = 0, len(page)
    while at < size:
        token = _TOKEN.search(page, at)
        end = token.start() if token else size
        if end > at:
            say(page[at:end])
        if not token:
            break
        at = token.end()
        tag = (token[2] or token[5] or "").lower()
        if not tag:
            if page.startswith("<![CDATA[", token.start()):
                say(page[token.start() + 9 : at].removesuffix("]]>").replace("&", "&amp;"))  # no references in there
            continue
        if token[1] or token[4]:
            if tag in ("html", "body"):
                continue
            if not open_tags.get(tag):
                if tag in _BLOCKS:
                    flush()
            elif tag in _BLOCKS:
                leave((tag,), frozenset())
            else:
                leave_inline(tag)
            continue
        if tag == "br":
            runs.append((" ", False))
            continue
        if tag in _RAW:
            over = re.compile(rf"</{re.escape(tag)}(?=[\s/>])[^>]*>", re.I).search(page, at)
            at = over.end() if over else size
            continue
        if tag == "html" or (tag == "body" and open_tags.get(tag)):
            continue
        if tag in _BLOCKS:
            if open_tags.get("p"):
                leave(("p",), frozenset(("table", "button", "td", "th")))
            if tag in _CLOSED_BY:
                leave(_CLOSED_BY[tag], _LISTS)
            elif stack[-1].tag in _HEADINGS and tag in _HEADINGS:
                close(len(stack) - 1)
            flush()
        element = _Element(tag, _kind(tag, token[3] if token[2] else token[6]), stack[-1])
        if element.block:
            above = element.holder
            styles[above] = (styles.get(above, 0) * 0x9E3779B97F4A7C15 + element.node) & 0x7FFFFFFFFFFFFFFF
        if tag not in _VOID:
            stack.append(element)
            open_tags[tag] = open_tags.get(tag, 0) + 1
    flush()
    return found, {node: styles.get(holder, 0) for node, holder in parents.items()}


def _site(host: str, page: int) -> str:
    """Pages without a host are sites of their own."""
    return host or f"\x00{page}"


def node_key(site: str, node: int) -> int:
    return _hash("node", site, node)


def content_key(site: str, node: int, text: str) -> int:
    return _hash("content", site, node, text)


def main_text(page: str, site: str, removed: set[int]) -> str:
    """The page's blocks outside the removed branches.

    Beside a main element with text nothing else is main text.  Where all
    that the page leaves open is removed, its pages are copies of each other
    and the tree says nothing: all open blocks stay.
    """
    found, _ = blocks(page)
    gone = {node for node in {b.node for b in found} if node_key(site, node) in removed}
    kept = [b for b in found if b.node not in gone]
    if any(b.cue > 0 for b in kept):
        return "\n".join(b.text for b in kept if b.cue > 0)
    chosen = [b for b in kept if content_key(site, b.node, b.text) not in removed]
    return "\n".join(b.text for b in chosen or kept)


_NODES = "page long, nodes array<struct<key: long, cue: int, linked: int, letters: int, style: long>>, contents array<struct<node: long, key: long>>"


def _observed(pages: DataFrame) -> DataFrame:
    """For each page (``page, host, html``) its nodes with texts and the content nodes that its elements leave open."""

    def run(batches):
        for batch in batches:
            rows = []
            for page, host, html in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                site = _site(host, page)
                found, styles = blocks(html or "")
                nodes: dict[int, list[int]] = {}
                contents = {}
                keys = {node: node_key(site, node) for node in styles}
                for b in found:
                    key = keys[b.node]
                    total = nodes.setdefault(key, [b.cue, 0, 0, styles[b.node]])
                    total[1] += b.linked
                    total[2] += len(b.text) - b.text.count(" ")
                    if b.cue == 0:
                        contents[content_key(site, b.node, b.text)] = key
                rows.append({
                    "page": page,
                    "nodes": [{"key": k, "cue": cue, "linked": linked, "letters": letters, "style": style} for k, (cue, linked, letters, style) in nodes.items()],
                    "contents": [{"node": node, "key": key} for key, node in contents.items()],
                })
            if rows:
                yield pa.RecordBatch.from_pylist(rows, schema=arrow)
        give_back()

    node = pa.struct([("key", pa.int64()), ("cue", pa.int32()), ("linked", pa.int32()), ("letters", pa.int32()), ("style", pa.int64())])
    arrow = pa.schema([("page", pa.int64()), ("nodes", pa.list_(node)), ("contents", pa.list_(pa.struct([("node", pa.int64()), ("key", pa.int64())])))])
    return pages.mapInArrow(run, _NODES)


def style_tree(observed: DataFrame) -> DataFrame:
    """``key, pages, cue, linked, presentation, importance``: presentation nodes; ``key`` null where not.

    ``importance`` is what a node has without a content of its own; texts
    left open are rated by :func:`low_branches`.
    """
    rows = observed.select(F.explode("nodes").alias("x")).select("x.*")
    styles = rows.groupBy("key", "cue", "style").agg(F.count("*").alias("k"), F.sum("linked").alias("linked"), F.sum("letters").alias("letters"))
    k = F.col("k").cast("double")
    nodes = styles.groupBy("key", "cue").agg(
        F.sum("k").alias("pages"), F.sum(k * F.log(k)).alias("klogk"), (F.sum("linked") / F.sum("letters")).alias("linked"),
    )
    m = F.col("pages").cast("double")
    entropy = F.when(m == 1, 1.0).otherwise((F.log(m) - F.col("klogk") / m) / F.log(m))
    presentation = F.greatest(F.lit(0.0), F.least(F.lit(1.0), entropy))
    nodes = nodes.select("key", "cue", "pages", "linked", presentation.alias("presentation"))
    content = F.when(F.col("linked") > MOST_LINKED, 0.0).otherwise(1.0)
    importance = F.when(F.col("cue") < 0, 0.0).when(F.col("cue") > 0, 1.0).otherwise(PRESENTATION * F.col("presentation") + (1 - PRESENTATION) * content)
    return nodes.withColumn("importance", importance)


def low_branches(observed: DataFrame, tree: DataFrame) -> DataFrame:
    """``key``: presentation and content nodes under ``LEAST_IMPORTANCE``."""
    contents = observed.select(F.explode("contents").alias("x")).select("x.*").groupBy("node", "key").agg(F.count("*").alias("k")).where("k > 1")
    rated = contents.join(tree.select(F.col("key").alias("node"), "pages", "presentation"), "node")
    own = 1 - F.log("k") / F.log("pages")
    low = rated.where(PRESENTATION * F.col("presentation") + (1 - PRESENTATION) * own < LEAST_IMPORTANCE).select("key")
    return tree.where(F.col("importance") < LEAST_IMPORTANCE).select("key").unionByName(low)


def extract(pages: DataFrame, url: str = "url", html: str = "html", out: str = "text") -> DataFrame:
    """``pages`` without the column ``html``, with ``out`` (main text) and ``n_chars`` (its code points).

    A column of these names is replaced.  Blocks are divided by block
    elements; a line break, a table cell's edge and any white space is one
    space.  A null html gives an empty text; a page whose url is null or has no
    host is a site of its own; repeated rows are each extracted; a text of any
    length is kept whole; an empty table gives no rows.
    """
    spark = pages.sparkSession
    bounded_batches(spark)
    names = [c for c in pages.columns if c.lower() not in (html.lower(), out.lower(), "n_chars")]
    key, host, gone = (free_name(pages.columns, x) for x in ("__page", "__host", "__removed"))
    page, body = F.xxhash64(F.col(f"`{url}`"), F.col(f"`{html}`")), F.col(f"`{html}`")
    site = host_and_path(F.col(f"`{url}`"))[0]
    observed = stored(_observed(pages.select(page.alias("page"), site.alias("host"), body.alias("html"))), "page-nodes")
    low = low_branches(observed, style_tree(observed))
    met = observed.select("page", F.explode(F.concat(F.col("nodes.key"), F.col("contents.key"))).alias("key")).join(low, "key")
    removed = met.groupBy(F.col("page").alias(key)).agg(F.collect_set("key").alias(gone))  # of one page
    rows = pages.select(*[F.col(f"`{c}`") for c in names], page.alias(key), site.alias(host), body.alias(f"{key}_html"))
    rows = rows.join(removed, key, "left").select(*[F.col(f"`{c}`") for c in names], key, host, f"{key}_html", gone)
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in pages.schema if f.name in names]
    kept = len(names)

    def run(batches):
        for batch in batches:
            read = zip(*(batch.column(c).to_pylist() for c in (key, host, f"{key}_html", gone)), strict=True)
            texts = [main_text(source or "", _site(where, page), set(keys or ())) for page, where, source, keys in read]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(kept)), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*names, out, "n_chars"]
            )
        give_back()

    return rows.mapInArrow(run, ", ".join([*fields, f"`{out}` string", "n_chars long"]))
