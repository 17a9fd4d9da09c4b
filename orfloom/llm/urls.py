"""URL allow/block rules with redirect equivalence; built-in functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orfloom.llm.components import components
from orfloom.llm.storage import stored

#: So many rules become one expression; more of them are joined by host.
MOST_RULES = 200
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/ ? #`` or the end, A-Z lower-cased; path: then up to ``? #``.  Else both empty."""
    at = F.instr(url, "://")
    rest = F.coalesce(F.when(at > 0, F.substr(url, at + F.lit(3))), F.lit(""))
    host = F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def rule_of(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text ``host`` + ``path``, action) of the longest fitting rule, else null; on a tie allow wins, then the lesser text."""
    text, action = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(sorted(rules, key=lambda r: r[1] + r[2], reverse=True), key=lambda r: (len(r[1] + r[2]), r[0] == "allow")):  # the last tried wins
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, action = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(what)).otherwise(action)
    return text, action


def with_rules(df: DataFrame, rules: list[tuple[str, str, str]]) -> DataFrame:
    """``df`` (``host``, ``path``) with ``rule`` and ``own``: the fitting rule and its action.

    Beyond ``MOST_RULES`` each distinct host meets the rules of its domains in a join.
    """
    if len(rules) <= MOST_RULES:
        rule, action = rule_of(F.col("host"), F.col("path"), rules)
        return df.select("*", rule.alias("rule"), action.alias("own"))
    listed = df.sparkSession.createDataFrame(rules, "what string, domain string, start string")
    parts = F.split("host", r"\.")
    domains = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    pages = df.select("host", "path").distinct()
    met = pages.select("host", "path", F.explode(domains).alias("domain")).join(listed, "domain").where(F.col("path").startswith(F.col("start")))
    text = F.concat("domain", "start")
    order = F.struct(-F.length(text), F.col("what") != "allow", text)
    best = met.groupBy("host", "path").agg(F.min_by(F.struct(text.alias("rule"), F.col("what").alias("own")), order).alias("best"))
    return df.join(best, ["host", "path"], "left").select(*[F.col(c) for c in df.columns], "best.rule", "best.own")


def _without_dots(path: Column) -> Column:
    """A path without its ``.`` and ``..`` segments."""
    parts = F.split(path, "/")

    def step(done: Column, part: Column) -> Column:
        return F.when(part == "..", F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(1)))).when(part == ".", done).otherwise(F.concat(done, F.array(part)))

    kept = F.aggregate(F.slice(parts, 2, F.size(parts)), F.array(F.lit("")).cast("array<string>"), step)
    open_end = F.when(F.element_at(parts, -1).isin(".", ".."), "/").otherwise("")
    clean = F.concat(F.array_join(kept, "/"), open_end)
    return F.when(path.rlike(r"(?:^|/)\.\.?(?:/|$)"), F.when(clean == "", "/").otherwise(clean)).otherwise(path)


def with_url_key(df: DataFrame, url: str, out: str) -> DataFrame:
    """``df`` with the name of a page in links: no fragment, no white space around, scheme and host lower-cased, no dot segments, ``/`` for no path."""
    plain, head, rest, path = (f"{out}__{x}" for x in ("plain", "head", "rest", "path"))
    df = df.withColumn(plain, F.regexp_replace(F.trim(F.col(url)), r"(?s)#.*$", ""))
    df = df.withColumn(head, F.regexp_extract(plain, r"(?s)^([^:/?#]+://[^/?#]*)", 1))
    df = df.withColumn(rest, F.substr(plain, F.length(head) + F.lit(1)))
    df = df.withColumn(path, F.regexp_extract(rest, r"(?s)^([^?]*)", 1))
    query = F.substr(rest, F.length(path) + F.lit(1))
    key = F.concat(F.translate(head, _UPPER, _LOWER), F.when(F.col(path) == "", "/").otherwise(_without_dots(F.col(path))), query)
    return df.withColumn(out, F.when(F.col(head) == "", F.col(plain)).otherwise(key)).drop(plain, head, rest, path)


def link_target(base: Column, link: Column) -> Column:
    """``link`` as found on page ``base``: absolute, scheme-relative, from the root, a query of the page, or beside it.

    Empty links, fragments of the page and other schemes (``mailto:``) give null; dot segments are for :func:`with_url_key`.
    """
    scheme = F.regexp_extract(base, r"^([^:/?#]+:)//", 1)
    site = F.regexp_extract(base, r"(?s)^([^:/?#]+://[^/?#]*)", 1)
    page = F.regexp_extract(base, r"(?s)^([^?#]*)", 1)
    folder = F.regexp_extract(base, r"(?s)^([^:/?#]+://[^/?#]*/(?:[^?#]*/)?)", 1)
    link = F.trim(link)
    return (
        F.when(link.isNull() | (link == "") | link.startswith("#"), F.lit(None).cast("string"))
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), link)
        .when(link.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), F.lit(None).cast("string"))
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(site, link))
        .when(link.startswith("?"), F.concat(page, link))
        .otherwise(F.concat(F.when(folder == "", F.concat(site, F.lit("/"))).otherwise(folder), link))
    )


#: What a browser does not read tags in.
_NOT_READ = r"(?is)<!--.*?(?:-->|$)|<(script|style|textarea|title|noscript)\b.*?(?:</\1\s*>|$)"
#: The attributes of every tag of a name; a value is quoted either way or not.
_TAG = r"""(?is)<{}\b((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
_VALUE = r"""(?is)(?:^|[\s"'/]){}\s*=\s*(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++))"""
#: Character references that occur in addresses.
_REFERENCES = (("&quot;|&#34;|&#x22;", '"'), ("&apos;|&#39;|&#x27;", "'"), ("&#47;|&#x2f;|&sol;", "/"), ("&amp;?|&#38;|&#x26;", "&"))


def _value(attributes: Column, name: str) -> Column:
    """An attribute's value, unescaped; empty where there is none."""
    found = F.concat(*(F.regexp_extract(attributes, _VALUE.format(name), k) for k in (1, 2, 3)))
    for text, mark in _REFERENCES:
        found = F.regexp_replace(found, "(?i)" + text, mark)
    return F.trim(found)


def _values(html: Column, tag: str, kind: str, words: str, name: str) -> Column:
    """``name`` of every ``tag`` whose attribute ``kind`` has one of ``words``."""
    tags = F.filter(F.regexp_extract_all(html, F.lit(_TAG.format(tag)), F.lit(1)), lambda a: _value(a, kind).rlike(rf"(?i)(?:^|\s)(?:{words})(?:\s|$)"))
    return F.transform(tags, lambda a: _value(a, name))


def page_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """Edges ``(a, b)`` from a page to the targets of all its canonical links and refresh redirects, resolved against its address or its ``<base>``."""
    base = F.col(f"`{url}`")
    found = pages.select(base.alias("u"), F.col(f"`{html}`").alias("h")).where("u is not null and h is not null")
    found = found.where(F.col("h").rlike(r"(?i)canonical|refresh"))  # most pages are done here
    found = found.select("u", F.regexp_replace("h", _NOT_READ, " ").alias("h"))
    refresh = F.transform(_values(F.col("h"), "meta", "http-equiv", "refresh", "content"), lambda c: F.regexp_extract(c, r"""(?is)^[\s\d.]*[;,]?\s*(?:url\s*=\s*)?["']?([^"']*)""", 1))
    targets = F.concat(_values(F.col("h"), "link", "rel", "canonical", "href"), refresh)
    stated = F.get(F.filter(F.transform(F.regexp_extract_all("h", F.lit(_TAG.format("base")), F.lit(1)), lambda a: _value(a, "href")), lambda x: x != ""), F.lit(0))
    # each step is a column of its own: nested in one another they would repeat many times
    found = found.select("u", stated.alias("s"), F.explode(F.array_distinct(targets)).alias("t")).where("t <> ''")
    found = found.select("u", "t", link_target(F.col("u"), F.col("s")).alias("s")).select("u", "t", F.coalesce("s", "u").alias("base"))
    found = found.select("u", link_target(F.col("base"), F.col("t")).alias("v")).where("v is not null")
    return with_url_key(with_url_key(found, "u", "a"), "v", "b").select("a", "b").where("a <> b").distinct()


def judge_urls(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    redirects: DataFrame | None = None,
    page_id: str = "page_id",
    url: str = "url",
    html: str | None = "html",
) -> DataFrame:
    """``page_id, host, path, rule, verdict, component`` for every row of ``pages``.

    A fitting rule of the page's own address decides.  Other pages follow
    their aliases, the connected component over redirects (``redirects``:
    ``src``, ``dst``; and refresh redirects in the page) and canonical links:
    an explicitly allowed alias allows, else an explicitly blocked one blocks,
    else the page is allowed.  Link targets that are not pages themselves
    count as aliases too.  Of rules of equal length allow wins.  All tags of a
    page count, of a page of any length.  Null addresses and those without ``://`` have an
    empty host and path, no rule, and are allowed.  Repeated rows are each
    judged; an empty table gives no rows; other columns play no part.
    """
    rows = pages.select(F.col(f"`{page_id}`").alias("page_id"), F.col(f"`{url}`").alias("__url"))
    host, path = host_and_path(F.col("__url"))
    edges = []
    if html is not None:
        edges.append(page_links(pages, url, html))
    if redirects is not None:
        edges.append(with_url_key(with_url_key(redirects, "src", "a"), "dst", "b").select("a", "b").where("a <> b"))
    rows = rows.select("page_id", "__url", host.alias("host"), path.alias("path"))
    rows = with_rules(rows, rules)
    if not edges:
        return rows.select("page_id", "host", "path", "rule", F.coalesce("own", F.lit("allow")).alias("verdict"))
    links = edges[0]
    for more in edges[1:]:
        links = links.unionByName(more)
    classes = components(stored(links, "links"))
    members = classes.select("node", "component", F.col("node").alias("__url"))
    h, p = host_and_path(F.col("__url"))
    members = with_rules(members.select("node", "component", h.alias("host"), p.alias("path")), rules).select("node", "component", F.col("own").alias("what"))
    verdicts = (
        members.groupBy("component")
        .agg(F.max(F.col("what") == "allow").alias("allowed"), F.max(F.col("what") == "block").alias("blocked"))
        .select("component", F.when(F.col("allowed"), "allow").when(F.col("blocked"), "block").otherwise("allow").alias("shared"))
    )
    shared = classes.join(verdicts, "component")
    return (
        with_url_key(rows, "__url", "node")
        .join(shared, "node", "left")
        .select("page_id", "host", "path", "rule", F.coalesce("own", "shared", F.lit("allow")).alias("verdict"), "component")
    )
