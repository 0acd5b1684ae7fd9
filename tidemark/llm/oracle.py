"""DuckDB SQL for the registered queries of this package."""

SQL: dict[str, str] = {}

# Weighted sampling: the same digests, cells and half-document rule, written with plain windows.
SQL["op9_exponential_mix"] = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size
  FROM documents),
q AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 2.0 ELSE 0.5 END)::DOUBLE AS quality FROM labels GROUP BY doc_id),
k AS (
  SELECT d.*, -ln((('0x' || substr(md5('11:' || coalesce(CAST(d.doc_id AS VARCHAR), 'null')), 1, 12))::BIGINT::DOUBLE + 0.5)
    / 281474976710656.0) / coalesce(q.quality, 1.0) AS key
  FROM d LEFT JOIN q USING (doc_id)),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (
  SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
  FROM s),
o AS (
  SELECT *, (SELECT sum(source_size) FROM s)
      - coalesce(sum(3 * source_size) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS lft,
    sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS free
  FROM w),
level AS (
  SELECT arg_min(lft, source_size / weight)::BIGINT AS lft, arg_min(free, source_size / weight)::BIGINT AS free
  FROM o WHERE weight * lft <= 3 * source_size * free),
t AS (
  SELECT w.*, CASE WHEN weight * lft > 3 * source_size * free THEN (3 * source_size)::DOUBLE
    ELSE (weight * lft)::DOUBLE / free::DOUBLE END AS target
  FROM w, level),
e AS (
  SELECT *, CASE WHEN source_size > 0 THEN floor(target / source_size)::BIGINT ELSE 0 END AS epochs FROM t),
a AS (
  SELECT k.doc_id, k.size, k.key, k.source, e.source_size, e.target, e.epochs, e.target - e.epochs * e.source_size AS lft,
    row_number() OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size) AS rn
  FROM k JOIN e ON k.source IS NOT DISTINCT FROM e.source),
g AS (
  SELECT source, 0::BIGINT AS rn, floor(any_value(lft))::BIGINT AS room, 0 AS extra FROM a GROUP BY source
  UNION ALL
  SELECT a.source, a.rn, g.room - CASE WHEN a.size <= g.room THEN a.size ELSE 0 END, CASE WHEN a.size <= g.room THEN 1 ELSE 0 END
  FROM g JOIN a ON a.source IS NOT DISTINCT FROM g.source AND a.rn = g.rn + 1),
rest AS (SELECT source, min(room) AS rest FROM g GROUP BY source),
more AS (
  SELECT a.source, min(a.rn) AS rn FROM a JOIN g ON a.source IS NOT DISTINCT FROM g.source AND a.rn = g.rn
    JOIN rest ON a.source IS NOT DISTINCT FROM rest.source
  WHERE g.extra = 0 AND a.size > 0 AND a.size < 2 * (rest + lft - floor(lft)) GROUP BY a.source)
SELECT doc_id, size, source_size, target,
  ((epochs + CASE WHEN g.extra = 1 OR more.rn IS NOT NULL THEN 1 ELSE 0 END) * size)::BIGINT AS taken
FROM a JOIN g ON a.source IS NOT DISTINCT FROM g.source AND a.rn = g.rn
  LEFT JOIN more ON a.source IS NOT DISTINCT FROM more.source AND a.rn = more.rn
"""


def _print(text: str) -> str:
    """The fingerprint of an SQL text expression; list comprehensions read the same in every DuckDB version."""
    leaves = "array_to_string(['.' || substr(sha256(l), 1, 8) for l in regexp_extract_all(p, '(?s).{1,64}')], '')"
    paragraphs = "string_split(s, chr(10))"
    node = f"sha256(array_to_string([sha256(p) for p in {paragraphs}], ''))"
    branch = f"array_to_string([substr(sha256(p), 1, 8) || '=' || {leaves} for p in {paragraphs}], ';')"
    sections = f"string_split({text}, chr(10) || chr(10))"
    return (
        f"sha256(array_to_string([{node} for s in {sections}], '')) || '|' || "
        f"array_to_string([substr({node}, 1, 8) || ':' || {branch} for s in {sections}], '/')"
    )


def _like(a: str, b: str) -> str:
    leaves = [f"list_distinct(regexp_extract_all({x}, '\\.([0-9a-f]{{8}})', 1))" for x in (a, b)]
    total = f"(len({leaves[0]}) + len({leaves[1]}))"
    return (
        f"CASE WHEN split_part({a}, '|', 1) = split_part({b}, '|', 1) THEN 1.0::DOUBLE ELSE least("
        f"len(list_intersect({leaves[0]}, {leaves[1]}))::DOUBLE * 2.0::DOUBLE / greatest({total}, 1), "
        f"1 - 1.0::DOUBLE / ({total} + 2)) END"
    )


SQL["op1_merkle_fingerprints"] = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM documents),
n AS (
  SELECT *, coalesce(lead(text) OVER w, first_value(text) OVER w) AS following
  FROM d WINDOW w AS (ORDER BY doc_id DESC ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)),
e AS (
  SELECT *, substr(text, 1, (n_chars - n_chars // 2)::BIGINT) || substr(following, 1, (n_chars // 2)::BIGINT) AS edited FROM n),
p AS (
  SELECT doc_id, n_chars, sha256(edited) AS edited_sha256, {_print("text")} AS fingerprint,
    {_print("edited")} AS edited_fingerprint, {_print("following")} AS next_print
  FROM e),
b AS (
  SELECT *, string_split(split_part(fingerprint, '|', 2), '/') AS x, string_split(split_part(edited_fingerprint, '|', 2), '/') AS y
  FROM p),
f AS (
  SELECT *, CASE WHEN split_part(fingerprint, '|', 1) <> split_part(edited_fingerprint, '|', 1)
    THEN list_position([x[i] IS DISTINCT FROM y[i] for i in range(1, greatest(len(x), len(y)) + 1)], true) END AS spot
  FROM b),
g AS (SELECT *, string_split(split_part(coalesce(x[spot], ''), ':', 2), ';') AS u, string_split(split_part(coalesce(y[spot], ''), ':', 2), ';') AS v FROM f)
SELECT doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint,
  {_like("fingerprint", "edited_fingerprint")} AS near_edited, {_like("fingerprint", "next_print")} AS near_next,
  (spot - 1)::INTEGER AS edit_section,
  CASE WHEN spot IS NOT NULL THEN
    list_position([u[i] IS DISTINCT FROM v[i] for i in range(1, greatest(len(u), len(v)) + 1)], true) - 1 END::INTEGER AS edit_paragraph
FROM g
"""


# Control strings and the characters that a turn's marks add are those of the template.
SQL["op3_reply_tree_chat"] = r"""
WITH c AS (
  SELECT conv_id, turn, role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
t AS (
  SELECT *, regexp_replace(text, '(\\*)(<s>|</s>|\[INST\]|\[/INST\]|<<SYS>>|<</SYS>>|\[ANS\]|\[ROLE=|\[/ROLE\])', '\1\\\2', 'g') AS body
  FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(coalesce(role, '') || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  coalesce(sum(CASE WHEN role = 'assistant' THEN length(text) END), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (3 + sum(length(body) + CASE role WHEN 'system' THEN 17 WHEN 'user' THEN 15 WHEN 'assistant' THEN 11
    ELSE 16 + length(coalesce(CAST(to_json(role) AS VARCHAR), 'null')) END))::BIGINT AS formatted_chars
FROM t GROUP BY conv_id
"""

# All pairs that share a shingle, and the closure of their links; for small tables.
SQL["op7_vertical_jaccard"] = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 3
    THEN list_distinct([w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] for i in range(1, len(w) - 1)])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY x, y),
l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * o >= 90 * (a.n + b.n - o)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id AS d, doc_id AS c FROM w UNION SELECT e.y, r.c FROM r JOIN e ON e.x = r.d)
SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, k.c AS component_id
FROM w LEFT JOIN n USING (doc_id) JOIN (SELECT d, min(c) AS c FROM r GROUP BY d) k ON k.d = w.doc_id
"""
