"""DuckDB SQL for the rows of queries whose method SQL can express by plainer means."""

from __future__ import annotations

from panelkit.llm import line_dedup, secret_scan

OP5_SQL = """
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
win AS (
  SELECT doc_id, i, list_slice(w, i, i + 19) AS v
  FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 19)) AS i FROM d WHERE len(w) >= 20)),
later AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY v ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 19)) AS i FROM later),
word AS (SELECT doc_id, unnest(generate_series(1, len(w))) AS i, unnest(w) AS x FROM d),
kept AS (
  SELECT doc_id, string_agg(x, ' ' ORDER BY i) FILTER (WHERE g.i IS NULL) AS t, count(g.i) AS n
  FROM word LEFT JOIN gone g USING (doc_id, i) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0)::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def _kind_sql(rank: int, kind: str, head: str, value: str, least: int) -> str:
    regex = f"(?s)(.*?)({head})({value})".replace("'", "''")
    part = lambda g: f"regexp_extract_all(t, '{regex}', {g})"
    return f"""
  SELECT doc_id, {rank} AS rank, '{kind}' AS kind, stop - length(head) - length(value) AS start, stop
  FROM (SELECT doc_id, i, head, value, sum(length(gap) + length(head) + length(value)) OVER (PARTITION BY doc_id ORDER BY i) AS stop
        FROM (SELECT doc_id, unnest({part(1)}) AS gap, unnest({part(2)}) AS head, unnest({part(3)}) AS value,
                     generate_subscripts({part(1)}, 1) AS i FROM d))
  WHERE length(value) >= {least}"""


# the base kinds as any run with a smallest length
_PLAIN = {"access": ("access", "", "AKIA[A-Z0-9]+", 16), "hex": ("hex", "", "[0-9a-f]+", 32)}
_SPANS = " UNION ALL ".join(_kind_sql(i, *_PLAIN.get(r[0], r)) for i, r in enumerate(secret_scan.RULES))
OP6_SQL = f"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
s AS ({_SPANS}),
w AS (
  SELECT doc_id, string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank) AS spans,
         string_agg(kind || ':' || start::BIGINT || ':' || stop::BIGINT, ',' ORDER BY start, rank) FILTER (WHERE rank < 3) AS base,
         count(*) FILTER (WHERE kind = 'assign') AS a, count(*) FILTER (WHERE kind = 'access') AS b, count(*) FILTER (WHERE kind = 'hex') AS c
  FROM s GROUP BY doc_id)
SELECT doc_id, coalesce(a, 0)::BIGINT AS n_assign, coalesce(b, 0)::BIGINT AS n_access, coalesce(c, 0)::BIGINT AS n_hex,
       sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN w USING (doc_id)
"""

_D, _DEPTH, _CONST, _COPY = line_dedup.MIN_DOCS, line_dedup.DEPTH, line_dedup.MIN_CONSTANT, line_dedup.COPY_SHARE
_SHARES, _LEAST = ", ".join(f"({x!r}::DOUBLE)" for x in line_dedup.MIN_SHARES), min(x for x in line_dedup.MIN_SHARES if x)
OP8_SQL = f"""
WITH txt AS (SELECT DISTINCT text FROM documents WHERE text IS NOT NULL),
raw AS (
  SELECT text, unnest(generate_series(0, len(l) - 1)) AS pos, unnest(l) AS line
  FROM (SELECT text, string_split(text, chr(10)) AS l FROM txt)),
toks AS (
  SELECT text, pos, length(line) AS chars,
         list_transform(string_split(trim(regexp_replace(line, '[ \\t-\\r]+', ' ', 'g'), ' '), ' '),
                        lambda x: CASE WHEN regexp_matches(x, '[0-9]') THEN '<*>' ELSE x END) AS k
  FROM raw),
ln AS (SELECT text, pos, chars, k, array_to_string(k, ' ') AS masked, len(k) AS n, array_to_string(k[1:{_DEPTH}], ' ') AS lead
       FROM toks WHERE array_to_string(k, ' ') <> ''),
per AS (SELECT n, lead, masked, any_value(k) AS k, count(DISTINCT text) AS c FROM ln GROUP BY n, lead, masked),
leaf AS (SELECT n, lead, sum(c) AS leaf_c FROM per GROUP BY n, lead HAVING sum(c) >= {_D}),
tok AS (SELECT n, lead, leaf_c, masked, c, unnest(generate_series(1, len(k))) AS p, unnest(k) AS t FROM per JOIN leaf USING (n, lead)),
held AS (
  SELECT n, lead, p, t, sum(c) / any_value(leaf_c) AS share FROM tok WHERE t <> '<*>' GROUP BY n, lead, p, t HAVING sum(c) >= any_value(leaf_c) * {_LEAST!r}),
tpl AS (
  SELECT DISTINCT masked, c, string_agg(CASE WHEN coalesce(share, 0) >= s THEN tok.t ELSE '<*>' END, ' ' ORDER BY tok.p) AS template
  FROM tok LEFT JOIN held ON held.n = tok.n AND held.lead = tok.lead AND held.p = tok.p AND held.t = tok.t CROSS JOIN (VALUES {_SHARES}) v(s)
  GROUP BY tok.n, tok.lead, masked, c, s HAVING count(*) FILTER (WHERE coalesce(share, 0) >= s AND tok.t <> '<*>') >= tok.n * {_CONST}),
cand AS (SELECT * FROM tpl WHERE template IN (SELECT template FROM tpl GROUP BY template HAVING sum(c) >= {_D})),
hit AS (SELECT text, pos, chars, masked, c FROM ln JOIN (SELECT DISTINCT masked, c FROM cand) USING (masked)),
most AS (
  SELECT text, list_sort(list(c))[(count(*) - 1) // 2 + 1] AS middle FROM hit
  JOIN (SELECT text, count(*) AS n_lines FROM raw WHERE line <> '' GROUP BY text) USING (text)
  WHERE c >= {_D} GROUP BY text, n_lines HAVING count(*) > n_lines * {_COPY} AND sum(chars) > length(text) * {_COPY}),
copies AS (
  SELECT text, arg_min(masked, substr(md5(masked), 1, 16)) AS family FROM hit JOIN most USING (text)
  WHERE c >= {_D} AND c * 2 >= middle AND c <= middle * 2 GROUP BY text),
grp AS (SELECT DISTINCT masked, family IS NOT NULL AS near, coalesce(family, text) AS id FROM hit LEFT JOIN copies USING (text)),
rec AS (
  SELECT DISTINCT masked FROM cand WHERE template IN (
    SELECT template FROM (SELECT DISTINCT template, near, id FROM cand JOIN grp USING (masked)) GROUP BY template HAVING count(*) >= {_D})),
gone AS (SELECT text, pos FROM ln WHERE masked IN (SELECT masked FROM rec)),
cut AS (SELECT text, count(*) AS n FROM gone GROUP BY text),
kept AS (
  SELECT raw.text, string_agg(line, chr(10) ORDER BY raw.pos) FILTER (WHERE g.pos IS NULL) AS t
  FROM raw JOIN cut USING (text) LEFT JOIN gone g ON g.text = raw.text AND g.pos = raw.pos GROUP BY raw.text)
SELECT doc_id, coalesce(len(string_split(d.text, chr(10))), 0)::BIGINT AS n_lines, coalesce(cut.n, 0)::BIGINT AS n_dropped,
       sha256(CASE WHEN cut.n IS NULL THEN coalesce(d.text, '') ELSE coalesce(kept.t, '') END) AS kept_sha256
FROM documents d LEFT JOIN cut ON cut.text = d.text LEFT JOIN kept ON kept.text = d.text
"""
