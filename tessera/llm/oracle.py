"""DuckDB SQL for the queries of this subpackage that SQL can state."""

from __future__ import annotations

from tessera.llm import spelling, url_rules
from tessera.llm.line_rules import CLOSING_MARKS, SEPARATORS, SYMBOLS, LineRules, phrase_pattern

WORD = "[^\\x20\\x09-\\x0D]+"
SPACE = "[\\x20\\x09-\\x0D]"


def line_rules_sql(rules: LineRules = LineRules(), source: str = "documents") -> str:
    """CTEs ending in ``judged``: one row per text, with the lines that stay."""
    sep = ", ".join(f"'{s}'" for s in SEPARATORS)
    return rf"""
    docs AS (SELECT row_number() OVER () AS rid, *, coalesce(text, '') AS t FROM {source}),
    ws AS (SELECT rid, regexp_extract_all(t, '{WORD}') AS w FROM docs),
    wins AS (SELECT rid, i, count(*) OVER (PARTITION BY rid, a, b, c) AS n
             FROM (SELECT rid, i, w[i] AS a, w[i + 1] AS b, w[i + 2] AS c
                   FROM (SELECT rid, w, unnest(range(1, len(w) - 1)) AS i FROM ws))),
    reps AS (SELECT rid, count(DISTINCT j) AS n_repeat_words
             FROM (SELECT rid, unnest([i, i + 1, i + 2]) AS j FROM wins WHERE n > 1) GROUP BY rid),
    lines AS (SELECT rid, i, l[i] AS line, regexp_extract_all(l[i], '{WORD}') AS lw,
                     regexp_replace(l[i], '{SPACE}', '', 'g') AS solid
              FROM (SELECT rid, l, unnest(range(1, len(l) + 1)) AS i
                    FROM (SELECT rid, string_split(t, chr(10)) AS l FROM docs))),
    ruled AS (SELECT rid, i, line, len(lw) AS n,
                     len(lw) > 0 AND row_number() OVER (PARTITION BY rid, line ORDER BY i) > 1 AS dup,
                     len(lw) > 0 AND (
                       (len(lw) < {rules.min_open_words}
                        AND NOT suffix_marked)
                       OR 100 * n_sym > {rules.max_symbol_pct} * length(solid)
                       OR len(list_filter(lw, lambda x: x IN ({sep}))) >= {rules.min_separators}
                       OR (len(lw) <= {rules.max_boiler_words}
                           AND regexp_matches(line, '(?i){phrase_pattern()}'))) AS bad
              FROM (SELECT *, right(solid, 1) IN ({", ".join("'" + m.replace("'", "''") + "'" for m in CLOSING_MARKS)}) AS suffix_marked,
                           length(regexp_replace(line, '[^{SYMBOLS}]', '', 'g')) AS n_sym FROM lines)),
    per_line AS (SELECT rid, sum(dup::INT) AS n_dup_lines, coalesce(sum(n) FILTER (dup OR bad), 0) AS lost,
                        count(*) FILTER (dup OR bad) AS n_failed,
                        coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT (dup OR bad)), '') AS clean_text
                 FROM ruled GROUP BY rid),
    counted AS (SELECT d.*, len(w) AS nw, length(regexp_replace(t, '{SPACE}', '', 'g')) AS word_chars,
                       length(regexp_replace(t, '[^{SYMBOLS}]', '', 'g')) AS n_symbols,
                       n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, lost, n_failed, clean_text
                FROM docs d JOIN ws USING (rid) JOIN per_line USING (rid) LEFT JOIN reps USING (rid)),
    based AS (SELECT *, nw < {rules.min_words} OR 100 * n_repeat_words > {rules.max_repeat_pct} * nw AS base_failed
              FROM counted),
    judged AS (SELECT *, NOT base_failed AND 100 * lost <= {rules.max_lost_pct} * nw
                         AND nw - lost >= {rules.min_words} AS kept FROM based)"""


OP8 = f"""
WITH {line_rules_sql()}
SELECT doc_id, nw::BIGINT AS n_words, word_chars::BIGINT AS word_chars, n_symbols::BIGINT AS n_symbols,
       n_dup_lines::BIGINT AS n_dup_lines, n_repeat_words::BIGINT AS n_repeat_words, base_failed,
       lost::BIGINT AS n_lost_words, n_failed::BIGINT AS n_failed_lines, kept
FROM judged"""


def ngram_groups_sql(words: int = 3, num: int = 90, den: int = 100, source: str = "documents") -> str:
    """CTEs ending in ``grouped``: doc_id, n_shingles, component_id."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return rf"""
    tw AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{WORD}') AS w
           FROM {source}),
    sh AS (SELECT DISTINCT doc_id, s FROM (
             SELECT doc_id, unnest(CASE WHEN len(w) = 0 THEN []
                                        WHEN len(w) < {words} THEN [array_to_string(w, ' ')]
                                        ELSE list_transform(range(1, len(w) - {words} + 2),
                                                            lambda i: array_to_string(w[i : i + {words} - 1], ' ')) END) AS s
             FROM tw)),
    sizes AS (SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id),
    links AS (SELECT p.a, p.b FROM (
                SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM sh x JOIN sh y ON x.s = y.s AND x.doc_id < y.doc_id
                GROUP BY 1, 2) p JOIN sizes u ON u.doc_id = p.a JOIN sizes v ON v.doc_id = p.b
              WHERE {den} * c >= {num} * (u.n + v.n - c)),
    edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
    reach AS (SELECT doc_id AS x, doc_id AS y FROM {source}
              UNION SELECT r.x, e.b FROM reach r JOIN edges e ON e.a = r.y),
    grouped AS (SELECT tw.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, m AS component_id
                FROM tw LEFT JOIN sizes USING (doc_id) JOIN (SELECT x, min(y) AS m FROM reach GROUP BY x) ON x = tw.doc_id)"""


OP1 = f"""
WITH RECURSIVE {ngram_groups_sql()}
SELECT doc_id, n_shingles, component_id FROM grouped"""


def _values(rows: list[tuple[str, ...]]) -> str:
    return ", ".join("(" + ", ".join("'" + x.replace("'", "''") + "'" for x in r) + ")" for r in rows)


#: every url meets every rule; patterns are rewritten by nested replacements
OP13 = f"""
WITH u AS (SELECT row_number() OVER () AS rid, page_id,
                  translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), '{url_rules.UPPER}', '{url_rules.LOWER}') AS host,
                  regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
sites AS (SELECT rule, verdict, split_part(rule, '/', 1) AS h, substr(rule, strpos(rule, '/')) AS p
          FROM (VALUES {_values(url_rules.SITES)}) AS t(rule, verdict)),
site AS (SELECT rid, rule, verdict FROM u JOIN sites ON (host = h OR ends_with(host, '.' || h)) AND starts_with(path, p)
         QUALIFY row_number() OVER (PARTITION BY rid ORDER BY length(rule) DESC, rule, verdict) = 1),
patterns AS (SELECT rule, kind, verdict,
                    replace(replace(replace(replace(replace(CASE WHEN starts_with(rule, '||') THEN '<' || substr(rule, 3)
                                                                 WHEN starts_with(rule, '|') THEN '>' || substr(rule, 2)
                                                                 ELSE rule END, '.', '[.]'), '*', '(.|\n)*'),
                                    '^', '(^|$|[^a-zA-Z0-9])'), '<', '(^|[.])'), '>', '^') AS re
             FROM (SELECT *, 'host' AS kind FROM (VALUES {_values(url_rules.HOST_PATTERNS)}) AS t(rule, verdict)
                   UNION ALL SELECT *, 'path' FROM (VALUES {_values(url_rules.PATH_PATTERNS)}) AS t(rule, verdict))),
method AS (SELECT rid, rule, verdict FROM u JOIN patterns
             ON regexp_matches(CASE kind WHEN 'host' THEN host ELSE path END, re, 'i')
           QUALIFY row_number() OVER (PARTITION BY rid ORDER BY verdict, length(rule) DESC, rule) = 1)
SELECT page_id, host, path, site.rule AS rule, coalesce(site.verdict, method.verdict, 'allow') AS verdict,
       CASE WHEN site.rule IS NULL THEN method.rule END AS pattern
FROM u LEFT JOIN site USING (rid) LEFT JOIN method USING (rid)"""


#: crc32 byte by byte (x >= 0: a byte comes in, else: one bit is shifted out); words that share what is
#: left when one code point goes are one edit apart
OP11 = f"""
WITH RECURSIVE runs AS (
  SELECT id, run, count(*) AS k FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id,
           translate(unnest(regexp_extract_all(text, '[{spelling.LETTERS}]{{5,}}')), '{spelling.UPPER}', '{spelling.LOWER}') AS run
    FROM documents) GROUP BY ALL),
hashed AS (
  SELECT run, k, xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(bytes, lambda b:
             [b, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, x: CASE WHEN x >= 0 THEN xor(c, x)
             ELSE xor(c >> 1, 3988292384 * (c & 1)) END), 4294967295::BIGINT) AS h
  FROM (SELECT run, k, flatten(list_transform(string_split(id || ':' || run, ''), lambda ch:
               CASE WHEN unicode(ch) < 128 THEN [unicode(ch)::BIGINT]
                    ELSE [192 + (unicode(ch) >> 6), 128 + (unicode(ch) & 63)]::BIGINT[] END)) AS bytes FROM runs)),
words AS (
  SELECT word, sum(k)::BIGINT AS n FROM (
    SELECT k, CASE WHEN h % 97 = 0 THEN substr(run, 1, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2)
                   ELSE run END AS word FROM hashed)
  WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3),
less AS (SELECT word, n, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, n, unnest(range(1, length(word) + 1))::INT AS i FROM words)),
longer AS (SELECT DISTINCT l.word AS a, l.n AS an, s.word AS b, s.n AS bn FROM less l JOIN words s ON l.rest = s.word),
pairs AS (SELECT x.word AS word, x.n AS n, y.word AS near, y.n AS near_n
          FROM less x JOIN less y ON x.i = y.i AND x.rest = y.rest AND x.word <> y.word
          UNION ALL SELECT a, an, b, bn FROM longer UNION ALL SELECT b, bn, a, an FROM longer),
best AS (SELECT word, n, near, near_n, count(*) OVER (PARTITION BY word) AS n_near FROM pairs
         QUALIFY row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) = 1),
formed AS (SELECT w.word, w.n, coalesce(n_near, 0)::BIGINT AS n_near,
                  CASE WHEN near_n >= 2 * w.n THEN near END AS form, CASE WHEN near_n >= 2 * w.n THEN near_n END AS form_n
           FROM words w LEFT JOIN best b ON w.word = b.word),
chain AS (SELECT word, form AS tip FROM formed WHERE form IS NOT NULL
          UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.tip = f.word WHERE f.form IS NOT NULL),
ends AS (SELECT c.word, tip FROM chain c JOIN formed f ON c.tip = f.word WHERE f.form IS NULL)
SELECT f.word, form, coalesce(tip, f.word) AS root, n, n_near, form_n FROM formed f LEFT JOIN ends e ON f.word = e.word"""


#: every anchor meets every row
OP12 = """
WITH rows AS (
  SELECT DISTINCT vec_id AS id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (SELECT a.id AS a, o.id AS o, a.label = o.label AS same, list_inner_product(a.v, o.v)::BIGINT AS s
           FROM rows a JOIN rows o ON a.id <> o.id WHERE a.id % 100 = 0),
pos AS (SELECT a, o, s FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY s DESC, o) <= 5)
SELECT p.a AS anchor_id, p.o AS positive_id,
       (row_number() OVER (PARTITION BY p.a, p.o ORDER BY n.s DESC, n.o))::INT AS rank, n.o AS negative_id,
       p.s AS positive_score, n.s AS negative_score
FROM pos p JOIN scored n ON p.a = n.a AND NOT n.same AND 80 * p.s <= 100 * n.s AND 100 * n.s <= 100 * p.s
QUALIFY rank <= 5"""
