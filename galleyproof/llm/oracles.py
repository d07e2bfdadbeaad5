"""SQL of operators that SQL can express, for comparison at small sizes."""

from __future__ import annotations


def crc32_sql(text: str) -> str:
    """The unsigned crc32 of an ASCII text, by its definition, bit by bit."""
    bits = "lambda x, _: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END"
    step = f"lambda c, b: list_reduce(list_concat([xor(c, b)], [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), {bits})"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), {step}), 4294967295::BIGINT)"


def _tree_sql(name: str, levels: int) -> str:
    """Levels 1.. of the trees in ``<name>0(tree, p, d, n)`` and the runs of siblings of each level."""
    out = []
    for k in range(levels):
        out.append(f"{name}{k + 1} AS (SELECT tree, p // 8 AS p, sha256(string_agg(d, '' ORDER BY p)) AS d,"
                   f" any_value((n + 7) // 8) AS n FROM {name}{k} WHERE n > 1 GROUP BY tree, p // 8)")
        out.append(f"{name}_run{k} AS (SELECT tree, p // 8 AS g, list(d ORDER BY p) AS run"
                   f" FROM {name}{k} WHERE n > 1 GROUP BY tree, p // 8)")
    return ",\n".join(out)


def _fold_sql(name: str, runs: str, start: str, levels: int) -> str:
    """Rows (pos, cur, proof) of ``start`` carried up through the runs."""
    out, before = [], start
    for k in range(levels):
        left = "coalesce(array_to_string(run[1:pos % 8], ''), '')"
        right = "coalesce(array_to_string(run[pos % 8 + 2:], ''), '')"
        out.append(f"""{name}{k} AS (SELECT f.* EXCLUDE (pos, cur, proof),
          CASE WHEN run IS NULL THEN pos ELSE pos // 8 END AS pos,
          CASE WHEN run IS NULL THEN cur ELSE sha256({left} || cur || {right}) END AS cur,
          CASE WHEN run IS NULL THEN proof ELSE proof || {left} || {right} END AS proof
          FROM {before} f LEFT JOIN {runs}_run{k} r ON r.tree = f.of_tree AND r.g = f.pos // 8)""")
        before = f"{name}{k}"
    return ",\n".join(out)


def merkle_sql(low: int = 7, high: int = 4) -> str:
    """Unrolled for up to 8^low leaves a language and 8^high languages."""
    fields = ["doc_id", "source", "lang", "n_chars", "text"]

    def leaf(text: str) -> str:
        told = [f"CAST({text if c == 'text' else c} AS VARCHAR)" for c in fields]
        return "sha256(" + " || ".join(f"coalesce(strlen({t}) || ':' || {t}, '-')" for t in told) + ")"

    upper = "".join(map(chr, range(65, 91)))
    changed = (f"CASE WHEN {crc32_sql('CAST(doc_id AS VARCHAR)')} % 3 = 0"
               f" THEN translate(text, '{upper}', '{upper.lower()}') ELSE text END")
    subroots = " UNION ALL ".join(f"SELECT tree, d FROM low{k} WHERE n = 1" for k in range(low + 1))
    top = " UNION ALL ".join(f"SELECT d FROM high{k} WHERE n = 1" for k in range(high + 1))
    return f"""
WITH docs AS (SELECT *, {changed} AS changed FROM documents),
leaves AS (SELECT doc_id, lang, {leaf('text')} AS leaf, {leaf('changed')} AS shown FROM docs),
ranked AS (SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
  row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS p,
  count(*) OVER (PARTITION BY lang) AS n FROM leaves),
low0 AS (SELECT tree, p, leaf AS d, n FROM ranked),
{_tree_sql('low', low)},
subroots AS ({subroots}),
high0 AS (SELECT 0 AS tree, tree AS p, d, count(*) OVER () AS n FROM subroots),
{_tree_sql('high', high)},
top AS ({top}),
start AS (SELECT doc_id, leaf, tree AS of_tree, tree, p AS pos, shown AS cur, '' AS proof FROM ranked),
{_fold_sql('f', 'low', 'start', low)},
half AS (SELECT * EXCLUDE (of_tree, pos), 0 AS of_tree, tree AS pos FROM f{low - 1}),
{_fold_sql('g', 'high', 'half', high)}
SELECT doc_id, leaf, s.d AS subroot, top.d AS root, sha256(proof) AS proof_sha256, cur AS folded_root,
  cur = top.d AS verified
FROM g{high - 1} x JOIN subroots s ON s.tree = x.tree CROSS JOIN top
"""


def dialogues_sql() -> str:
    """The least (cost, audit) of every roles' pattern carried row by row; s, u, a name the last role,
    e that there is none."""
    text = "coalesce(text, ' ')"
    key = "coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ')"

    def add(state: str, cost: str, letter: str, line: str = "''", when: str = "true") -> str:
        return (f"CASE WHEN x.{state} IS NOT NULL AND {when} THEN"
                f" {{'c': x.{state}.c + {cost}, 'a': x.{state}.a || '{letter}', 'b': x.{state}.b || {line}}} END")

    def best(*ways: str) -> str:
        return f"list_min(list_filter([{', '.join(ways)}], lambda w: w IS NOT NULL))"

    def told(role: str) -> str:
        return f"chr(10) || {role} || ':' || r.text"

    def drop(state: str) -> str:
        return add(state, "2", "D")

    def keep(state: str, first: str) -> str:
        return add(state, "r.more", "K", told("r.role"), f"r.stays AND r.role[1] = '{first}'")

    def rerole(state: str, role: str) -> str:
        return add(state, "1 + r.more", "R", told(f"'{role}'"), "r.stays")

    def insert(state: str, role: str) -> str:
        return add(state, "5", "I", f"chr(10) || '{role}:'")

    kind = "STRUCT(c BIGINT, a VARCHAR, b VARCHAR)"
    none = f"CAST(NULL AS {kind})"
    return rf"""
WITH RECURSIVE damage AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, {text} AS text,
  {crc32_sql(key)} % 20 AS kind FROM conversations),
damaged AS (SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM damage JOIN (VALUES (1), (2)) t(i) ON t.i = 1 OR kind = 3 WHERE kind <> 0),
faults AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i,
    CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) > 1 THEN 'duplicate'
      WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
    lag(role[1]) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) || role[1] AS step
  FROM damaged),
r AS (SELECT *, fault NOT IN ('blank', 'duplicate') AS stays, CASE fault WHEN 'truncated' THEN 5 ELSE 0 END AS more
  FROM faults),
ids AS (SELECT DISTINCT conv_id FROM conversations),
x(conv_id, i, e, s, u, a) AS (
  SELECT conv_id, CAST(0 AS BIGINT), CAST({{'c': 0, 'a': '', 'b': ''}} AS {kind}), {none},
    CAST({{'c': 5, 'a': 'I', 'b': chr(10) || 'user:'}} AS {kind}),
    CAST({{'c': 10, 'a': 'II', 'b': chr(10) || 'user:' || chr(10) || 'assistant:'}} AS {kind}) FROM ids
  UNION ALL
  SELECT conv_id, i, e, s, u, CAST({best('x.a', insert('u', 'assistant'))} AS {kind}) FROM (
    SELECT conv_id, i, e, s, a,
      CAST({best('x.u', insert('e', 'user'), insert('s', 'user'), insert('a', 'user'))} AS {kind}) AS u FROM (
      SELECT x.conv_id, r.i, CAST({drop('e')} AS {kind}) AS e,
        CAST({best(drop('s'), keep('e', 's'))} AS {kind}) AS s,
        CAST({best(drop('u'), *[f(k, v) for k in 'esa' for f, v in ((keep, 'u'), (rerole, 'user'))])} AS {kind}) AS u,
        CAST({best(drop('a'), keep('u', 'a'), rerole('u', 'assistant'))} AS {kind}) AS a
      FROM x JOIN r ON r.conv_id IS NOT DISTINCT FROM x.conv_id AND r.i = x.i + 1) x) x),
chosen AS (SELECT conv_id, {best('e', 'a')} AS w FROM x
  QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY i DESC) = 1),
counts AS (SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (step IS NOT NULL AND step NOT IN ('su', 'ua', 'au')) AS illegal
  FROM r GROUP BY conv_id)
SELECT w.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, w.w.c AS cost, w.w.a AS audit,
  sha256(w.w.b[2:]) AS repaired_sha256
FROM chosen w LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
"""
