"""DuckDB SQL of ``op11_conversation_repair``: the cost DP row by row from the end, audits and texts carried along."""


def _edit(cost: int, letter: str, line: str, rest: str) -> str:
    """A struct (cost, audit, text) that begins with one edit; ``line``: SQL of the row that it leaves, or empty."""
    text = f"chr(10) || {line} || {rest}.t" if line else f"{rest}.t"
    return f"{{'c': {rest}.c + {cost}, 'a': '{letter}' || {rest}.a, 't': {text}}}"


def _after_row(q: int) -> str:
    """Least (cost, audit, text) from state ``q`` that begins with the row ``x``; ``s0`` to ``s3`` go on behind it."""
    to, name = ((2, "user"), (2, "user"), (3, "assistant"), (2, "user"))[q]
    kept = {0: f"WHEN x.i = 's' THEN {_edit(0, 'K', 'x.r', 's1')} WHEN x.i = 'u' THEN {_edit(0, 'K', 'x.r', 's2')}", 2: f"WHEN x.i = 'a' THEN {_edit(0, 'K', 'x.r', 's3')}"}
    keep = kept.get(q, f"WHEN x.i = 'u' THEN {_edit(0, 'K', 'x.r', 's2')}")
    gone, renamed = _edit(3, "D", "", f"s{q}"), _edit(2, "R", f"('{name}:' || x.text)", f"s{to}")
    stays = f"list_transform(list_filter([CASE {keep} END, {renamed}], lambda e: e IS NOT NULL), lambda e: {{'c': e.c + x.cut, 'a': e.a, 't': e.t}})"
    return f"CASE WHEN x.must THEN {gone} ELSE list_min(list_append({stays}, {gone})) END"


_CRC32 = (
    "xor(4294967295, list_reduce(list_transform(range(1, length({0}) + 1), lambda i: ascii(substr({0}, i, 1))::BIGINT), lambda c, b: "
    "list_reduce(range(0, 8), lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END, xor(c, b)), 4294967295::BIGINT))"
)
_SOLID = "rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

OP11 = f"""
WITH RECURSIVE k AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
d AS (SELECT *, {_CRC32.format("key")} % 20 AS kind FROM k),
e AS (
  SELECT conv_id, turn, role AS was, md5(text) AS tie, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE WHEN kind = 1 THEN '' WHEN kind = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(range(CASE WHEN kind = 3 THEN 2 ELSE 1 END)) AS copy
  FROM d WHERE kind <> 0),
f AS (
  SELECT *, left(role, 1) AS i, {_SOLID} = '' AS blank, right({_SOLID}, 1) NOT IN ('.', '!', '?') AS cut,
    row_number() OVER w AS n, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, was, tie, copy) > 1 AS again, lag(left(role, 1)) OVER w AS b4
  FROM e WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, was, tie, copy)),
x AS (SELECT coalesce(conv_id::VARCHAR, ' ') AS conv, n, i, blank OR again AS must, CASE WHEN cut THEN 1 ELSE 0 END AS cut, text, role || ':' || text AS r FROM f),
o AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS conv, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (blank) AS blank, count(*) FILTER (NOT blank AND again) AS duplicate,
    count(*) FILTER (NOT blank AND NOT again AND cut) AS truncated, count(*) FILTER (b4 IS NOT NULL AND b4 || i NOT IN ('su', 'ua', 'au')) AS illegal, max(n) AS n FROM f GROUP BY conv_id),
s(conv, n, s0, s1, s2, s3) AS (
  SELECT conv, n, {{'c': 0, 'a': '', 't': ''}}, {{'c': 4, 'a': 'II', 't': chr(10) || 'user:' || chr(10) || 'assistant:'}}, {{'c': 2, 'a': 'I', 't': chr(10) || 'assistant:'}}, {{'c': 0, 'a': '', 't': ''}} FROM o
  UNION ALL
  SELECT conv, n, list_min([r0, {_edit(2, "I", "'user:'", "q2")}]), list_min([r1, {_edit(2, "I", "'user:'", "q2")}]), q2, list_min([r3, {_edit(2, "I", "'user:'", "q2")}])
  FROM (SELECT *, list_min([r2, {_edit(2, "I", "'assistant:'", "r3")}]) AS q2
    FROM (SELECT s.conv, s.n - 1 AS n, {_after_row(0)} AS r0, {_after_row(1)} AS r1, {_after_row(2)} AS r2, {_after_row(3)} AS r3 FROM s JOIN x ON x.conv = s.conv AND x.n = s.n)))
SELECT c.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  coalesce(s0.c, 0)::BIGINT AS cost, coalesce(s0.a, '') AS audit, sha256(coalesce(substr(s0.t, 2), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN o ON o.conv_id IS NOT DISTINCT FROM c.conv_id LEFT JOIN s ON s.conv = o.conv AND s.n = 0"""
