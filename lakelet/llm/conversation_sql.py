"""DuckDB SQL for the results of the two conversation queries, written another way than the operators:
whole prefixes as lists, repaired conversations as lists of lines."""

from __future__ import annotations


def crc32(text: str) -> str:
    """The crc32 of a text that isn't empty, bit by bit."""
    bits = "lambda x, i: xor(x >> 1, (x & 1) * 3988292384)"
    byte = f"lambda a, b: list_reduce(list_concat([xor(a, b)], range(8)), {bits})"
    return (f"xor(4294967295::BIGINT, list_reduce(list_concat([4294967295::BIGINT], "
            f"[CAST(ascii(c) AS BIGINT) FOR c IN string_split({text}, '')]), {byte}))")


def edit(cost: str, letter: str, lines: str, after: str) -> str:
    """The cheapest end of a conversation that begins with this edit and goes on as ``after``."""
    return f"{{'c': {cost} + {after}.c, 'a': '{letter}' || {after}.a, 'r': list_concat({lines}, {after}.r)}}"


def before_turn() -> str:
    """Columns s0..s3 of the recursion: the cheapest end from each state, one turn further to the front."""
    nexts, roles, kept = (2, 2, 3, 2), ("user", "user", "assistant", "user"), {"s": {0: 1}, "u": {0: 2, 1: 2, 3: 2}, "a": {2: 3}}
    best = []
    for s in range(4):
        ways = [edit("2", "D", "CAST([] AS VARCHAR[])", f"g.s{s}"),
                f"CASE WHEN stays THEN {edit('1 + extra', 'R', f"['{roles[s]}:' || text]", f'g.s{nexts[s]}')} END"]
        ways += [f"CASE WHEN stays AND initial = '{i}' THEN {edit('extra', 'K', "[role || ':' || text]", f'g.s{to[s]}')} END" for i, to in kept.items() if s in to]
        best.append(f"list_min([{', '.join(ways)}]) AS b{s}")
    return ", ".join(best)


def inserted(s: int, first: str, then: str) -> str:
    return f"list_min([{first}, {edit('5', 'I', f"['{then}:']", f'b{(2, 2, 3, 2)[s]}')}])"


OP12_SQL = rf"""
WITH RECURSIVE o AS (
  SELECT CAST(conv_id AS BIGINT) AS conv_id, CAST(turn AS BIGINT) AS turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    {crc32("coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')")} % 20 AS kind
  FROM conversations
), d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN translate(text, '.!?', '') ELSE text END AS text
  FROM o CROSS JOIN range(2) copies(copy) WHERE kind <> 0 AND (copy = 0 OR kind = 3)
), a AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 AS again,
    right(rtrim(text, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 1) AS last
  FROM d
), f AS (
  SELECT conv_id, turn, role, text, left(role, 1) AS initial,
    CASE WHEN last = '' THEN 'b' WHEN again THEN 'd' WHEN last NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, again) AS i
  FROM a
), r AS (
  SELECT *, fault NOT IN ('b', 'd') AS stays, CASE fault WHEN 't' THEN 5 ELSE 0 END AS extra,
    lead(initial) OVER (PARTITION BY conv_id ORDER BY i) AS after
  FROM f
), g AS (
  SELECT conv_id, max(i) + 1 AS i, {{'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])}} AS s0, {{'c': 10, 'a': 'II', 'r': ['user:', 'assistant:']}} AS s1,
    {{'c': 5, 'a': 'I', 'r': ['assistant:']}} AS s2, {{'c': 0, 'a': '', 'r': CAST([] AS VARCHAR[])}} AS s3
  FROM f GROUP BY conv_id
  UNION ALL
  SELECT conv_id, i, {inserted(0, 'b0', 'user')}, {inserted(1, 'b1', 'user')}, b2, b3
  FROM (
    SELECT conv_id, i, b0, b1, {inserted(2, 'b2', 'assistant')} AS b2, {inserted(3, 'b3', 'user')} AS b3
    FROM (SELECT g.conv_id, r.i, {before_turn()} FROM g JOIN r ON g.conv_id IS NOT DISTINCT FROM r.conv_id AND r.i = g.i - 1)
  )
), c AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 'b') AS blank,
    count(*) FILTER (fault = 'd') AS duplicate, count(*) FILTER (fault = 't') AS truncated,
    count(*) FILTER (after IS NOT NULL AND initial || after NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id
)
SELECT o.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated,
  coalesce(illegal, 0) AS illegal, CAST(coalesce(s0.c, 0) AS BIGINT) AS cost, coalesce(s0.a, '') AS audit,
  sha256(coalesce(array_to_string(s0.r, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM o) o
LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id
LEFT JOIN g ON g.conv_id IS NOT DISTINCT FROM o.conv_id AND g.i = 1
"""

OP13_SQL = f"""
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, {crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM (SELECT DISTINCT conv_id FROM t)
), r AS (
  SELECT c.conv_id, 0 AS kind, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id - c.conv_id % 100 AND t.pos <= c.h
  UNION ALL
  SELECT c.conv_id, 1, pos, role, text FROM c JOIN t ON t.conv_id = c.conv_id AND t.pos > c.h
), s AS (
  SELECT c.conv_id, coalesce(list({{'r': r.role, 't': r.text}} ORDER BY kind, pos) FILTER (kind IS NOT NULL), []) AS turns
  FROM c LEFT JOIN r ON r.conv_id = c.conv_id GROUP BY c.conv_id
), m AS (
  SELECT conv_id, unnest(range(len(turns) + 1)) AS depth, turns FROM s
), p AS (
  SELECT conv_id, depth, list_slice(turns, 1, depth) AS path, len(turns) = depth AS ends FROM m
), n AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256
  FROM p GROUP BY depth, path
), k AS (
  SELECT p.conv_id AS member, p.depth, n.conv_id FROM p JOIN n ON n.depth = p.depth AND n.path = p.path
), v AS (
  SELECT n.*, k.conv_id AS parent_conv_id, CASE n.depth WHEN 0 THEN 0 ELSE (n_convs - 1) * length(path[-1].t) END AS saved
  FROM n LEFT JOIN k ON k.member = n.conv_id AND k.depth = n.depth - 1
), x AS (
  SELECT parent_conv_id AS conv_id, depth - 1 AS depth, count(*) AS n_children FROM v WHERE depth > 0 GROUP BY ALL
), w AS (
  SELECT v.*, coalesce(n_children, 0) AS n_children FROM v LEFT JOIN x ON x.conv_id = v.conv_id AND x.depth = v.depth
), b AS (
  SELECT k.conv_id, k.depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved) AS saved_tokens
  FROM w JOIN k ON k.member = w.conv_id AND k.depth <= w.depth GROUP BY ALL
)
SELECT w.conv_id, w.depth, parent_conv_id, n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, ends_sha256
FROM w JOIN b ON b.conv_id = w.conv_id AND b.depth = w.depth
"""
