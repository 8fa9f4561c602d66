"""DuckDB SQL for the queries it can express on whole tables."""

from __future__ import annotations

from tidegate.llm.license_scan import TEMPLATES, THRESHOLD, template_bigrams
from tidegate.llm.mixing import SEED
from tidegate.llm.prefix_trie import FAMILY, OPENINGS
from tidegate.llm.secret_scan import BASE_RULES, RULES

SQL: dict[str, str] = {}


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_GRAMS = ", ".join(
    f"({_quoted(name)}, {_quoted(gram)})" for name, text in TEMPLATES.items() for gram in template_bigrams(text)
)

SQL["op1_license_scan"] = rf"""
WITH template(name, gram) AS (VALUES {_GRAMS}),
sized AS (SELECT name, count(*) AS n FROM template GROUP BY name),
plain AS (SELECT doc_id, regexp_replace(lower(coalesce(text, '')), '[^\p{{L}}\p{{N}}\n]+', ' ', 'g') AS t FROM documents),
unit AS (SELECT DISTINCT doc_id, unnest(list_concat(list_concat(string_split(t, chr(10)),
    string_split_regex(t, '\n *\n')), [t])) AS u FROM plain),
word AS (SELECT doc_id, u, list_filter(string_split(replace(u, chr(10), ' '), ' '), lambda x: x <> '') AS w FROM unit),
gram AS (SELECT DISTINCT doc_id, u, w[i] || ' ' || w[i + 1] AS gram
  FROM (SELECT doc_id, u, w, unnest(range(1, len(w))) AS i FROM word)),
total AS (SELECT doc_id, u, count(*) AS n FROM gram GROUP BY ALL),
both_have AS (SELECT doc_id, u, name, count(*) AS k FROM gram JOIN template USING (gram) GROUP BY ALL),
hit AS (SELECT doc_id, name, 2.0::DOUBLE * k / (t.n + s.n) AS dice
  FROM both_have JOIN total t USING (doc_id, u) JOIN sized s USING (name)),
best AS (SELECT doc_id, min_by(name, {{'d': -dice, 'n': name}}) AS license, max(dice) AS dice, count(*) AS n_hits,
  string_agg(DISTINCT name, ',' ORDER BY name) AS licenses FROM hit WHERE dice >= {THRESHOLD} GROUP BY doc_id)
SELECT doc_id, license, dice, coalesce(n_hits, 0) AS n_hits, coalesce(licenses, '') AS licenses
FROM documents LEFT JOIN best USING (doc_id)"""

SQL["op2_mixing"] = rf"""
WITH d AS (SELECT doc_id, source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3
    WHEN 0 THEN 3.0::DOUBLE WHEN 1 THEN 1.0::DOUBLE ELSE 2.0::DOUBLE END AS weight FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(2.0::DOUBLE * source_size) OVER
      (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (ORDER BY source_size / weight, source NULLS LAST
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS height FROM w),
f AS (SELECT height FROM l WHERE 2.0::DOUBLE * source_size >= height * weight
  ORDER BY source_size / weight, source NULLS LAST LIMIT 1),
goal AS (SELECT source, source_size, least(2.0::DOUBLE * source_size,
    coalesce((SELECT height FROM f) * weight, 2.0::DOUBLE * source_size)) AS target FROM l),
placed AS (SELECT d.doc_id, d.size, g.source_size, g.target,
    CASE WHEN g.source_size > 0 THEN g.target / g.source_size ELSE 1.0::DOUBLE END AS each,
    row_number() OVER (PARTITION BY d.source ORDER BY d.size, d.doc_id) AS place,
    CAST(CAST('0x' || substr(md5('{SEED}:' || coalesce(d.source, 'null')), 1, 12) AS BIGINT) AS DOUBLE)
      / 281474976710656.0::DOUBLE AS shift
  FROM d JOIN goal g ON d.source IS NOT DISTINCT FROM g.source),
taken AS (SELECT *, CAST(floor(place * each + shift) - floor((place - 1) * each + shift) AS BIGINT) AS copies FROM placed)
SELECT doc_id, size, source_size, target, copies * size AS taken, copies FROM taken"""

SQL["op9_chat_format"] = r"""
WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-7, 0, 'user', '</s>[INST] ok [/INST]'), (-7, 1, 'assistant', '</s>[INST] ok [/INST]')),
made AS (SELECT *, 19 + length(regexp_replace(replace(role, '\', '\\'), '([<\[])(/?s>|unk>|/?INST\])', '\1\\\2', 'g'))
    + length(regexp_replace(replace(text, '\', '\\'), '([<\[])(/?s>|unk>|/?INST\])', '\1\\\2', 'g')) AS n,
  CASE WHEN role = 'assistant' THEN text ELSE '' END AS learned FROM turns)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(sum(length(learned)) AS BIGINT) AS loss_chars,
  sha256(string_agg(learned, '' ORDER BY turn, role, text)) AS loss_sha256,
  CAST(3 + sum(n) AS BIGINT) AS formatted_chars
FROM made GROUP BY conv_id"""


def _kind_sql(kind: int) -> str:
    rule = RULES[kind]
    pattern = _quoted(rule.pattern)
    own = f"length(regexp_replace(hits[i], {_quoted('^' + rule.head)}, ''))" if rule.least else "0"
    return f"""SELECT doc_id, {kind} AS k, '{rule.kind}' AS kind, s, s + length(hits[i]) AS e
  FROM (SELECT doc_id, hits, i, list_sum(list_transform(parts[1:i], lambda x: length(x)))
      + coalesce(list_sum(list_transform(hits[1:i - 1], lambda x: length(x))), 0) AS s
    FROM (SELECT doc_id, parts, hits, unnest(range(1, len(hits) + 1)) AS i
      FROM (SELECT doc_id, string_split_regex(text, {pattern}) AS parts,
        regexp_extract_all(text, {pattern}) AS hits FROM documents WHERE regexp_matches(text, {pattern}))))
  WHERE {own} >= {rule.least}"""


_BASE = len(BASE_RULES)
SQL["op10_secret_scan"] = f"""
WITH span AS ({' UNION ALL '.join(_kind_sql(k) for k in range(len(RULES)))}),
told AS (SELECT doc_id, s, k, e, kind || ':' || CAST(s AS BIGINT) || ':' || CAST(e AS BIGINT) AS said FROM span),
found AS (SELECT doc_id, count(*) FILTER (k = 0) AS n_assign, count(*) FILTER (k = 1) AS n_access,
  count(*) FILTER (k = 2) AS n_hex, string_agg(said, ',' ORDER BY s, k, e) FILTER (k < {_BASE}) AS base,
  string_agg(said, ',' ORDER BY s, k, e) AS spans FROM told GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM documents LEFT JOIN found USING (doc_id)"""

SQL["op6_jaccard_join"] = r"""
WITH RECURSIVE word AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
shingle AS (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS s
    FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM word WHERE len(w) > 0)),
size AS (SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id),
pair AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS k FROM shingle x JOIN shingle y USING (s)
  WHERE x.doc_id <> y.doc_id GROUP BY ALL),
link AS (SELECT a, b, k = p.n AND k = q.n AS same FROM pair JOIN size p ON p.doc_id = a JOIN size q ON q.doc_id = b
    WHERE 10 * k >= 8 * (p.n + q.n - k)
  UNION ALL SELECT x.doc_id, y.doc_id, true FROM word x JOIN word y ON len(x.w) = 0 AND len(y.w) = 0 AND x.doc_id <> y.doc_id),
reach(a, b) AS (SELECT doc_id, doc_id FROM documents UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a),
class AS (SELECT a AS doc_id, min(b) AS class_id FROM reach GROUP BY a),
counted AS (SELECT a AS doc_id, count(*) AS n_links, count(*) FILTER (same) AS n_same FROM link GROUP BY a)
SELECT doc_id, class_id, 1 + coalesce(n_same, 0) AS n_copies, coalesce(n_links, 0) AS n_links
FROM class LEFT JOIN counted USING (doc_id)"""

_CRC = """list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
      lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END)))"""

SQL["op12_prefix_trie"] = rf"""
WITH turns AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce("text", '') AS x FROM conversations
  WHERE conv_id IS NOT NULL),
conv AS (SELECT c, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, r, x) AS l FROM turns GROUP BY c),
opening AS (SELECT c, l, c - c % {FAMILY} AS b, xor({_CRC}, 4294967295) % {OPENINGS} AS h FROM conv),
rebuilt AS (SELECT a.c, list_concat(coalesce(b.l[1:a.h], []), a.l[a.h + 1:]) AS s
  FROM opening a LEFT JOIN conv b ON b.c = a.b),
prefix AS (SELECT c, d, md5(to_json(s[1:d])) AS k, md5(to_json(s[1:d - 1])) AS up, len(s) AS n,
    len(regexp_extract_all(s[d].x, '[^\x20\x09-\x0D]+')) AS w
  FROM (SELECT c, s, unnest(range(0, len(s) + 1)) AS d FROM rebuilt)),
node AS (SELECT k, d, min(c) AS conv_id, count(*) AS n_convs, any_value(up) AS up, coalesce(any_value(w), 0) AS w,
    string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (d = n) AS ends FROM prefix GROUP BY k, d),
kids AS (SELECT up, d - 1 AS d, count(*) AS n FROM node WHERE d > 0 GROUP BY ALL),
below AS (SELECT a.k, a.d, sum((u.n_convs - 1) * u.w) AS saved, count(*) FILTER (u.leaf) AS leaves
  FROM (SELECT node.*, kids.n IS NULL AS leaf FROM node LEFT JOIN kids ON kids.up = node.k AND kids.d = node.d) u
  JOIN prefix a ON a.c = u.conv_id AND a.d <= u.d GROUP BY ALL)
SELECT v.conv_id, v.d AS depth, p.conv_id AS parent_conv_id, v.n_convs, coalesce(kids.n, 0) AS n_children,
  below.leaves AS n_leaves, below.saved::BIGINT AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM node v JOIN below ON below.k = v.k AND below.d = v.d
LEFT JOIN kids ON kids.up = v.k AND kids.d = v.d LEFT JOIN node p ON v.d > 0 AND p.k = v.up AND p.d = v.d - 1
"""
