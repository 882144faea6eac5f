"""DuckDB SQL of the operators that SQL can express, on the given tables."""

from __future__ import annotations

from snaplake.llm import license_scan, quality_rules, url_filter

_WORD = r"[^\x20\x09-\x0D]+"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


_RULES = {"short": "n_words < 10", "repeats": "100 * n_repeat_words > 20 * n_words", "symbols": "10 * n_symbols > n_words",
          "dup_lines": "10 * n_dup_lines > 3 * n_lines", "word_length": "word_chars < 2 * n_words OR word_chars > 20 * n_words"}


def _host_verdict(rule: str) -> str:
    """Whether a host's failure rate of a rule, shrunk by the beta prior fitted to all hosts, is over the limit."""
    return f"""
      CASE WHEN m_{rule} <= 0 OR m_{rule} >= 1 THEN ({rule} + m_{rule}) / (n + 1) ELSE
        ({rule} + m_{rule} * (1 / least(greatest(rho_{rule}, 1e-3), 0.999) - 1)) / (n + 1 / least(greatest(rho_{rule}, 1e-3), 0.999) - 1)
      END > {quality_rules.HOST_LIMIT}"""


def _rho(rule: str) -> str:
    m = f"m_{rule}"
    return f"""CASE WHEN {m} * (1 - {m}) * (total - squares / total - (hosts - 1)) > 0 THEN
      (s_{rule} - {m} * {m} * total - {m} * (1 - {m}) * (hosts - 1)) / ({m} * (1 - {m}) * (total - squares / total - (hosts - 1)))
      ELSE 0 END AS rho_{rule}"""


OP1 = rf"""
WITH t AS (SELECT row_number() OVER () AS r, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, regexp_extract_all(text, '{_WORD}') AS words,
             list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '{_WORD}')) AS lines FROM t),
windows AS (SELECT r, i, words[i] || ' ' || words[i+1] || ' ' || words[i+2] || ' ' || words[i+3] || ' ' || words[i+4] AS s
            FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 3, 1))) AS i FROM w)),
twice AS (SELECT r, i FROM windows QUALIFY count(*) OVER (PARTITION BY r, s) > 1),
repeated AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(5) x(k) GROUP BY r),
m AS (SELECT doc_id, source AS host, len(words)::BIGINT AS n_words, coalesce(list_sum(list_transform(words, lambda x: length(x))), 0)::BIGINT AS word_chars,
             len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(lines)::BIGINT AS n_lines, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
             coalesce(repeated.n, 0)::BIGINT AS n_repeat_words FROM w LEFT JOIN repeated USING (r)),
f AS (SELECT host, count(*) AS n, {', '.join(f'count(*) FILTER (WHERE {c}) AS {r}' for r, c in _RULES.items())}
      FROM m WHERE host IS NOT NULL GROUP BY host),
a AS (SELECT sum(n)::DOUBLE AS total, sum(n * n)::DOUBLE AS squares, count(*) AS hosts,
             {', '.join(f'sum({r}) / sum(n) AS m_{r}, sum({r} * {r} / n) AS s_{r}' for r in _RULES)} FROM f),
p AS (SELECT *, {', '.join(_rho(r) for r in _RULES)} FROM a),
bad AS (SELECT host FROM f, p WHERE {' OR '.join(_host_verdict(r) for r in _RULES)})
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       ({_RULES['short']} OR {_RULES['repeats']}) AS base_failed,
       NOT ({_RULES['short']} OR {_RULES['repeats']}) AND NOT (host IS NOT NULL AND host IN (SELECT host FROM bad)) AS kept FROM m
"""

OP3 = """
WITH p AS (SELECT page_id, octet_length(encode(coalesce(html, '')))::BIGINT AS n, sha1(coalesce(html, '')) AS h FROM pages),
b AS (SELECT *, list_aggregate(list_transform(range(1, 41), lambda i: substr(
        '0000000100100011010001010110011110001001101010111100110111101111', (instr('0123456789abcdef', substr(h, i, 1)) - 1) * 4 + 1, 4)),
        'string_agg', '') AS bits, min(page_id) OVER (PARTITION BY h, n) AS first FROM p)
SELECT page_id, n AS payload_bytes,
       list_aggregate(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         list_aggregate(list_transform(range(0, 5), lambda k: (substr(bits, i * 5 + k + 1, 1) = '1')::INT * (16 >> k)::INT), 'sum')::INT + 1, 1)),
         'string_agg', '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to FROM b
"""

OP4 = """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT vec_id, e FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
       AND list_dot_product(e, e) > 0),
links AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e)
          WHERE list_cosine_similarity(a.e, b.e) >= 0.9),
reach(node, pos) AS (SELECT vec_id, vec_id FROM v UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.pos),
c AS (SELECT node AS vec_id, min(pos) AS component_id FROM reach GROUP BY node)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = c.vec_id)::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM c
"""


def _address(url: str) -> str:
    host = rf"translate(regexp_extract({url}, '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    rest = rf"regexp_extract({url}, '(?s)\A.*?://[^/?#]*([^#]*)', 1)"
    return f"CASE WHEN {url} LIKE '%://%' THEN {host} || CASE WHEN {rest} = '' THEN '/' ELSE {rest} END END"


#: DuckDB's patterns have no look-ahead: the tag is taken first, then its link.
_CANONICAL = r"""regexp_extract(list_filter(regexp_extract_all(html, '(?is)<link\b[^>]*>'), lambda x:
    regexp_matches(x, '(?i)\brel\s*=\s*["'']?canonical\b') AND regexp_matches(x, '(?i)\bhref\s*='))[1], '(?is).*\bhref\s*=\s*["'']?([^"''\s>]+)', 1)"""
_REFRESH = r"""regexp_extract(list_filter(regexp_extract_all(html, '(?is)<meta\b[^>]*>'), lambda x:
    regexp_matches(x, '(?i)\bhttp-equiv\s*=\s*["'']?refresh\b'))[1], '(?is).*\bcontent\s*=\s*["'']?\s*[\d.]*\s*[;,]\s*url\s*=\s*["'']?([^"''\s>]+)', 1)"""

OP5 = rf"""
WITH RECURSIVE rules(r_host, r_path, verdict) AS (VALUES {', '.join(f"({_quoted(h)}, {_quoted(p)}, {_quoted(v)})" for h, p, v in url_filter.RULES)}),
p AS (SELECT row_number() OVER () AS r, page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
q AS (SELECT r, page_id, url, {_address('url')} AS address,
        translate(regexp_extract(url, '(?s)\A.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_extract(url, '(?s)\A.*?://[^/?#]*([^?#]*)', 1) AS path, replace(unnest([{_CANONICAL}, {_REFRESH}]), '&amp;', '&') AS link FROM p),
e AS (SELECT address AS a, CASE WHEN regexp_matches(link, '\A[A-Za-z][A-Za-z0-9+.-]*://') THEN {_address('link')}
        WHEN link LIKE '//%' THEN {_address("('x:' || link)")} WHEN link LIKE '/%' THEN {_address("('x://' || host || link)")} END AS b FROM q WHERE link <> ''),
l AS (SELECT a, b FROM e WHERE a <> b UNION SELECT b, a FROM e WHERE a <> b),
reach(node, pos) AS (SELECT a, a FROM l UNION SELECT reach.node, l.b FROM reach JOIN l ON l.a = reach.pos),
members AS (SELECT DISTINCT min(pos) OVER (PARTITION BY node) AS component, node FROM reach),
addresses AS (SELECT node AS url, regexp_extract(node, '(?s)\A([^/?#]*)', 1) AS host, regexp_extract(node, '(?s)\A[^/?#]*([^?#]*)', 1) AS path, component FROM members),
classes AS (SELECT component, bool_or(v = 'block') AND NOT bool_or(v = 'allow') AS blocked FROM (
  SELECT component, (SELECT arg_max(verdict, length(r_host || r_path)) FROM rules WHERE (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS v
  FROM addresses) GROUP BY component),
one AS (SELECT DISTINCT r, page_id, address, host, path FROM q),
judged AS (SELECT *, (SELECT arg_max({{'rule': r_host || r_path, 'verdict': verdict}}, length(r_host || r_path)) FROM rules
                      WHERE host <> '' AND (host = r_host OR ends_with(host, '.' || r_host)) AND starts_with(path, r_path)) AS best FROM one)
SELECT page_id, host, path, best.rule AS rule,
       coalesce(best.verdict, CASE WHEN blocked THEN 'block' ELSE 'allow' END) AS verdict
FROM judged LEFT JOIN members ON node = address LEFT JOIN classes USING (component)
"""


def _license_words(text: str) -> str:
    return (f"regexp_extract_all(translate(coalesce({text}, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), "
            f"'{license_scan.WORDS}')")


def _phrase_hits(phrase: str, label: str) -> str:
    fits = " AND ".join(f"words[i + {k}] = {_quoted(w)}" for k, w in enumerate(phrase.split()))
    return f"SELECT r, i - 1 AS pos, {_quoted(label)} AS label FROM (SELECT r, words, unnest(range(1, len(words) + 1)) AS i FROM w) WHERE {fits}"


_K, _NEAR, _SHARE = license_scan.GRAM, license_scan.NEAR, license_scan.COVERAGE
_GRAM = " || ' ' || ".join(f"words[i + {k}]" for k in range(_K))
OP6 = rf"""
WITH w AS (SELECT row_number() OVER () AS r, doc_id, {_license_words('text')} AS words FROM documents),
base AS ({' UNION ALL '.join(_phrase_hits(p, label) for p, label in license_scan.PHRASES)}),
t AS (SELECT *, {_license_words('body')} AS words FROM (VALUES {', '.join(f'({i}, {_quoted(label)}, {_quoted(body)})' for i, (label, body) in enumerate(license_scan.TEMPLATES))}) x(template, label, body)),
tg AS (SELECT template, label, len(words) AS size, i - 1 AS t_at, {_GRAM} AS gram FROM (SELECT *, unnest(range(1, len(words) - {_K - 2})) AS i FROM t)),
dg AS (SELECT r, i - 1 AS pos, {_GRAM} AS gram FROM (SELECT r, words, unnest(range(1, greatest(len(words) - {_K - 2}, 1))) AS i FROM w)),
hits AS (SELECT r, template, label, size, pos, t_at, pos - t_at AS diagonal FROM dg JOIN tg USING (gram)),
cut AS (SELECT *, coalesce((diagonal - lag(diagonal) OVER (PARTITION BY r, template ORDER BY diagonal, pos) > {_NEAR})::INT, 1) AS apart FROM hits),
grouped AS (SELECT *, sum(apart) OVER (PARTITION BY r, template ORDER BY diagonal, pos ROWS UNBOUNDED PRECEDING) AS span FROM cut),
spans AS (SELECT r, template, label, size, span, min(pos) AS first, max(pos) + {_K - 1} AS last,
                 len(list_distinct(flatten(list([t_at + k FOR k IN range({_K})])))) / size AS share FROM grouped GROUP BY r, template, label, size, span),
held AS (SELECT r, list_sort(list(DISTINCT label)) AS labels, max(share) AS score FROM spans
         WHERE share >= {_SHARE} AND last - first + 1 <= 2 * size GROUP BY r),
b AS (SELECT r, count(*) AS n, min(pos) AS first, max(pos) AS last, list(DISTINCT label) AS labels FROM base GROUP BY r)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(b.n, 0)::BIGINT AS n_base, b.first::BIGINT AS first_word, b.last::BIGINT AS last_word,
       coalesce(array_to_string(list_sort(b.labels), ','), '') AS base_labels,
       array_to_string(list_sort(list_distinct(list_concat(coalesce(b.labels, []), coalesce(held.labels, [])))), ',') AS labels,
       coalesce(score, 0.0)::DOUBLE AS score
FROM w LEFT JOIN b USING (r) LEFT JOIN held USING (r)
"""

OP9 = rf"""
WITH d AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '{_WORD}'))::BIGINT AS size,
             greatest(0.05, coalesce(length(regexp_replace(text, '\P{{L}}+', '', 'g'))
               / nullif(length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g')), 0), 0.05)) AS w,
             (('0x' || substr(md5('7:' || coalesce(doc_id::VARCHAR, '')), 1, 13))::BIGINT + 1) / 4503599627370496.0 AS u FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
r AS (SELECT *, 2.0::DOUBLE * source_size AS cap, ([3.0, 1.0, 2.0])[((row_number() OVER (ORDER BY source IS NULL, encode(source))) - 1) % 3 + 1]::DOUBLE AS w FROM s),
o AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER upto, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER upto, 0)) AS level,
             row_number() OVER (ORDER BY cap / w, source IS NULL, encode(source)) AS k FROM r
      WINDOW upto AS (ORDER BY cap / w, source IS NULL, encode(source) ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
f AS (SELECT min(k) AS k, arg_min(level, k) AS level FROM o WHERE w * level < cap),
t AS (SELECT source, source_size, CASE WHEN o.k >= f.k THEN least(cap, w * f.level) ELSE cap END AS target FROM o, f),
e AS (SELECT *, coalesce(floor(target / nullif(source_size, 0) + 1e-12), 0)::BIGINT AS epochs FROM t),
x AS (SELECT d.doc_id, d.size, e.source_size, e.target, e.epochs, greatest(0, e.target - e.epochs * e.source_size) AS rest,
             coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY -ln(d.u) / d.w, d.size, d.doc_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS ahead
      FROM d JOIN e ON d.source IS NOT DISTINCT FROM e.source)
SELECT doc_id, size, source_size, target, ((epochs + (size > 0 AND ahead + size / 2 <= rest)::INT) * size)::BIGINT AS taken FROM x
"""

SQL = {"op1_quality_rules": OP1, "op3_warc": OP3, "op4_embedding_dedup": OP4, "op5_url_filter": OP5, "op6_license_scan": OP6,
       "op9_mixing": OP9}
