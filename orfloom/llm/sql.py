"""SQL of the queries that SQL can express."""

from orfloom.llm.conversations_sql import OP11

_LOWER = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

OP1 = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0),
s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 100 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 10"""

_WORDS = r"coalesce(regexp_extract_all(" + _LOWER.format("text") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"

OP3 = f"""
WITH b AS (SELECT item_id, {_WORDS} AS ws FROM benchmark),
bw AS (SELECT DISTINCT item_id, k, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT item_id, ws, least(10, len(ws)) AS k, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS i FROM b WHERE len(ws) > 0)),
d AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
dw AS (SELECT doc_id, k, i, array_to_string(ws[i:i + k - 1], ' ') AS g FROM (SELECT doc_id, ws, k, unnest(range(1, len(ws) - k + 2)) AS i FROM d, (SELECT DISTINCT k FROM bw))),
m AS (SELECT doc_id, k, i, item_id FROM dw JOIN bw USING (k, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM m) GROUP BY 1),
x AS (SELECT doc_id, count(DISTINCT item_id) AS n_items, array_to_string(list_sort(list(DISTINCT CAST(item_id AS VARCHAR))), ',') AS names FROM m GROUP BY 1)
SELECT doc_id, len(ws) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN x USING (doc_id)"""

OP7 = f"""
WITH RECURSIVE w AS (SELECT doc_id, coalesce(regexp_extract_all({_LOWER.format("text")}, '[^\\x20\\x09-\\x0D]+'), []) AS ws FROM documents),
s AS (SELECT DISTINCT doc_id, unnest(CASE WHEN len(ws) >= 5 THEN list_transform(range(1, len(ws) - 3), lambda i: array_to_string(ws[i:i + 4], ' ')) WHEN len(ws) > 0 THEN [array_to_string(ws, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT a, b FROM c JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * k >= 75 * (x.n + y.n - k)),
e AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
r(node, root) AS (SELECT doc_id, doc_id FROM documents UNION SELECT e.b, r.root FROM r JOIN e ON e.a = r.node)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id FROM r JOIN documents ON node = doc_id LEFT JOIN n USING (doc_id) GROUP BY doc_id"""


def _folded(path: str) -> str:
    """A path without dot segments: a fold that keeps what is not taken back."""
    parts = f"string_split({path}, '/')"
    fold = f"list_reduce({parts}[2:], lambda d, x: CASE x WHEN '.' THEN d WHEN '..' THEN regexp_replace(d, '(^|/)[^/]*$', '') ELSE d || '/' || x END, '')"
    clean = f"({fold} || CASE WHEN {parts}[-1] IN ('.', '..') THEN '/' ELSE '' END)"
    return f"CASE WHEN regexp_matches({path}, '(^|/)\\.\\.?(/|$)') THEN coalesce(nullif({clean}, ''), '/') WHEN {path} = '' THEN '/' ELSE {path} END"


def _key(url: str) -> str:
    """The name of a page in links, as ``urls.with_url_key`` makes it."""
    plain = f"regexp_replace(trim({url}), '#(.|\\n)*$', '')"
    head = f"regexp_extract({plain}, '^([^:/?#]+://[^/?#]*)', 1)"
    rest = f"substr({plain}, length({head}) + 1)"
    path = f"regexp_extract({rest}, '^([^?]*)', 1)"
    return f"(CASE WHEN {head} = '' THEN {plain} ELSE {_LOWER.format(head)} || {_folded(path)} || substr({rest}, length({path}) + 1) END)"


def _rule(host: str, path: str, what: str) -> str:
    rules = [("example.org/en/1", "example.org", "/en/1", "block"), ("example.org/es/", "example.org", "/es/", "block"), ("com/de/", "com", "/de/", "block"), ("com/fr/", "com", "/fr/", "allow"), ("org/", "org", "/", "allow")]
    cases = " ".join(f"WHEN ({host} = '{h}' OR suffix({host}, '.{h}')) AND starts_with({path}, '{p}') THEN '{name if what == 'rule' else verdict}'" for name, h, p, verdict in rules)
    return f"CASE {cases} END"


_REST = "CASE WHEN strpos({0}, '://') > 0 THEN substr({0}, strpos({0}, '://') + 3) ELSE '' END"
_FOLDER = "nullif(regexp_extract(u, '^([^:/?#]+://[^/?#]*/(?:[^?#]*/)?)', 1), '')"


def _attribute(name: str) -> str:
    """Value of an attribute of ``x``, unescaped."""
    pattern = "(?is)(?:^|[\\s\"''/])" + name + "\\s*=\\s*(?:\"([^\"]*)\"|''([^'']*)''|([^\\s\"''>]+))"
    value = " || ".join(f"coalesce(regexp_extract(x, '{pattern}', {k}), '')" for k in (1, 2, 3))
    return f"trim(replace(replace({value}, '&quot;', '\"'), '&amp;', '&'))"


def _tags(name: str) -> str:
    return f"unnest(regexp_extract_all(html, '(?is)<{name}\\b((?:[^>\"'']|\"[^\"]*\"|''[^'']*'')*)>', 1))"


OP10 = f"""
WITH RECURSIVE p AS (SELECT page_id, {_key("url")} AS node, coalesce({_REST.format("url")}, '') AS rest FROM pages),
h AS (SELECT page_id, node, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM p),
y AS (SELECT url AS u, regexp_replace(html, '(?is)<!--.*?-->|<script\\b.*?</script\\s*>|<style\\b.*?</style\\s*>', ' ', 'g') AS html FROM pages WHERE url IS NOT NULL AND html IS NOT NULL),
t AS (
  SELECT u, {_attribute("href")} AS l FROM (SELECT u, {_tags("link")} AS x FROM y) WHERE regexp_matches({_attribute("rel")}, '(?i)(^|\\s)canonical(\\s|$)')
  UNION ALL
  SELECT u, regexp_extract({_attribute("content")}, '(?is)^[\\s\\d.]*[;,]?\\s*(?:url\\s*=\\s*)?[\"'']?([^\"'']*)', 1) FROM (SELECT u, {_tags("meta")} AS x FROM y) WHERE regexp_matches({_attribute("http-equiv")}, '(?i)(^|\\s)refresh(\\s|$)')),
g AS (SELECT u, CASE WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN l WHEN regexp_matches(l, '^[A-Za-z][A-Za-z0-9+.-]*:') THEN NULL WHEN starts_with(l, '//') THEN regexp_extract(u, '^([^:/?#]+:)//', 1) || l
  WHEN starts_with(l, '/') THEN regexp_extract(u, '^([^:/?#]+://[^/?#]*)', 1) || l WHEN starts_with(l, '?') THEN regexp_extract(u, '^([^?#]*)', 1) || l
  ELSE coalesce({_FOLDER}, regexp_extract(u, '^([^:/?#]+://[^/?#]*)', 1) || '/') || l END AS v FROM (SELECT u, trim(l) AS l FROM t) WHERE l <> '' AND NOT starts_with(l, '#')),
d AS (SELECT DISTINCT {_key("u")} AS a, {_key("v")} AS b FROM g WHERE v IS NOT NULL),
e AS (SELECT a, b FROM d WHERE a <> b UNION SELECT b, a FROM d WHERE a <> b),
r(node, peer) AS (SELECT a, a FROM e UNION SELECT e.b, r.peer FROM r JOIN e ON e.a = r.node),
k AS (SELECT node, peer, coalesce({_REST.format("peer")}, '') AS rest FROM r),
c AS (SELECT node, {_LOWER.format("regexp_extract(rest, '^([^/?#]*)', 1)")} AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM k),
s AS (SELECT node, CASE WHEN bool_or(w = 'allow') THEN 'allow' WHEN bool_or(w = 'block') THEN 'block' ELSE 'allow' END AS shared FROM (SELECT node, {_rule("host", "path", "verdict")} AS w FROM c) GROUP BY 1)
SELECT page_id, host, path, {_rule("host", "path", "rule")} AS rule, coalesce({_rule("host", "path", "verdict")}, shared, 'allow') AS verdict FROM h LEFT JOIN s USING (node)"""

OP12 = f"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array({_LOWER.format("coalesce(text, '')")}, '[.,;:!?\\x0A-\\x0D]')) AS piece FROM documents),
b AS (SELECT row_number() OVER () AS id, lang, list_filter(regexp_split_to_array(piece, '[ \\t]+'), lambda x: x <> '') AS ws FROM p),
w AS (SELECT id, lang, generate_subscripts(ws, 1) AS i, unnest(ws) AS w FROM b),
g AS (SELECT lang, w AS w1, lead(w, 1) OVER q AS w2, lead(w, 2) OVER q AS w3, lead(w, 3) OVER q AS w4 FROM w WINDOW q AS (PARTITION BY id ORDER BY i)),
f AS MATERIALIZED (
  SELECT lang, 1 AS size, w1 AS phrase, count(*) AS a FROM g GROUP BY ALL UNION ALL SELECT lang, 2, w1 || ' ' || w2, count(*) FROM g WHERE w2 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 3, w1 || ' ' || w2 || ' ' || w3, count(*) FROM g WHERE w3 IS NOT NULL GROUP BY ALL
  UNION ALL SELECT lang, 4, w1 || ' ' || w2 || ' ' || w3 || ' ' || w4, count(*) FROM g WHERE w4 IS NOT NULL GROUP BY ALL),
c AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE size > 1 AND a >= 30),
k AS MATERIALIZED (SELECT *, array_to_string(w[1:k], ' ') AS head, array_to_string(w[k + 1:], ' ') AS rest FROM (SELECT *, unnest(range(1, size)) AS k FROM c)),
u AS MATERIALIZED (SELECT lang, phrase, a FROM f WHERE a >= 30),
s AS (SELECT k.lang, k.phrase, k.size, k.a, k.k, h.a AS l, t.a AS r, (2000000::HUGEINT * k.a) // (h.a + t.a) AS score FROM k
  JOIN u h ON h.lang = k.lang AND h.phrase = k.head JOIN u t ON t.lang = k.lang AND t.phrase = k.rest),
m AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
i AS (SELECT DISTINCT lang, phrase FROM (SELECT c.lang, c.a, unnest(flatten(list_transform(range(2, c.size), lambda z: list_transform(range(1, c.size - z + 2), lambda j: array_to_string(c.w[j:j + z - 1], ' '))))) AS phrase
  FROM c WHERE size > 2) o JOIN c b USING (lang, phrase) WHERE 100::HUGEINT * o.a >= 80 * b.a),
n AS (SELECT lang, sum(a)::BIGINT AS n FROM f WHERE size = 1 GROUP BY lang)
SELECT lang, rank, phrase, a, l, r, n, score::BIGINT AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM m ANTI JOIN i USING (lang, phrase)) JOIN n USING (lang) WHERE rank <= 2000"""

ORACLES = {"op10_url_filter": OP10, "op11_conversation_repair": OP11, "op12_collocations": OP12, "op1_top_k": OP1, "op3_decontamination": OP3, "op7_jaccard_join": OP7}
