"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from newsfeat.llm import line_quality as lq
from newsfeat.llm import secret_scan as ss

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"


def _q(pattern: str) -> str:
    return pattern.replace("'", "''")


def line_fails(line: str) -> str:
    size = rf"len(regexp_extract_all({line}, '[^\x20\x09-\x0D]+'))"
    lower = f"lower({line})"
    phrases = " OR ".join(f"contains({lower}, '{p}')" for p in lq.BOILERPLATE)
    return (f"(5 * len(regexp_extract_all({line}, '{_q(lq.NOISE)}')) > {size}"
            f" OR len(regexp_extract_all({line}, '{_q(lq.SEPARATORS)}')) >= 2"
            f" OR (length({line}) <= 60 AND regexp_matches({lower}, '{_q(lq.MENU)}'))"
            f" OR ({size} <= {lq.MOST_BOILERPLATE_WORDS} AND ({phrases})))")


QUALITY = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, {WORDS} AS w,
    string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
g AS (SELECT rid, i, array_to_string(w[i:i + 4], ' ') AS gram
  FROM (SELECT rid, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) >= 5)),
t AS (SELECT rid, i FROM g QUALIFY count(*) OVER (PARTITION BY rid, gram) > 1),
r AS (SELECT rid, sum(least(5, coalesce(nxt - i, 5))) AS n FROM (
  SELECT rid, i, lead(i) OVER (PARTITION BY rid ORDER BY i) AS nxt FROM t) GROUP BY rid),
c AS (SELECT d.rid, doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]+', '', 'g')) AS n_symbols,
    list_filter(l, lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS f,
    list_filter(l, lambda x: {line_fails('x')}) AS bad, l, coalesce(r.n, 0) AS n_repeat_words
  FROM d LEFT JOIN r ON d.rid = r.rid),
v AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed,
  length(array_to_string(bad, '')) AS lost, length(array_to_string(l, '')) AS total FROM c)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars,
  CAST(n_symbols AS BIGINT) AS n_symbols, CAST(len(f) - len(list_distinct(f)) AS BIGINT) AS n_dup_lines,
  CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND 100 * lost <= 30 * total AS kept
FROM v"""


def _pattern(pattern: str) -> str:
    """The same pattern without a flag that folds letters beyond ASCII."""
    if not pattern.startswith("(?i)"):
        return _q(pattern)
    out, inside = "", False
    for i, c in enumerate(pattern[4:]):
        inside = (inside or c == "[") and c != "]"
        escaped = i and pattern[4:][i - 1] == "\\"
        out += f"[{c.upper()}{c.lower()}]" if c.isascii() and c.isalpha() and not inside and not escaped else c
    return _q(out)


def secrets_ctes(rows: str) -> str:
    """CTEs ending in per_row(rid, spans, base, n0..n2, live starts) over rows(rid, text, owner, repository)."""
    kinds = " UNION ALL ".join(
        f"SELECT rid, {n} AS k, '{kind}' AS kind, {least} AS least,"
        f" regexp_extract_all(text, '{_pattern(p)}', 0) AS m, regexp_extract_all(text, '{_pattern(p)}', {g}) AS v,"
        f" string_split_regex(text, '{_pattern(p)}') AS gaps FROM {rows} WHERE regexp_matches(text, '{_pattern(p)}')"
        for n, (kind, p, g, least) in enumerate(ss.KINDS))
    return f"""
found AS ({kinds}),
flat AS (SELECT rid, k, kind, least, unnest(range(1, len(m) + 1)) AS i, m, v, gaps FROM found),
spot AS (SELECT rid, k, kind, least, i, length(m[i]) AS size, v[i] AS value,
  sum(length(gaps[i]) + length(m[i])) OVER (PARTITION BY rid, k ORDER BY i) AS e FROM flat),
hit AS (SELECT rid, k, kind, value, e - size AS s, e FROM spot WHERE length(value) >= least),
known AS (SELECT value, count(DISTINCT owner) AS owners FROM hit JOIN {rows} USING (rid) GROUP BY value),
judged AS (SELECT hit.*, owners < 3 AS live FROM hit JOIN known USING (value) WHERE k < {ss.BASE} OR owners < 3),
per_row AS (SELECT rid, count(*) FILTER (k = 0) AS n0, count(*) FILTER (k = 1) AS n1, count(*) FILTER (k = 2) AS n2,
  string_agg(concat(kind, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)), ',' ORDER BY s, k)
    FILTER (k < {ss.BASE}) AS base,
  string_agg(concat(kind, ':', CAST(s AS BIGINT), ':', CAST(e AS BIGINT)), ',' ORDER BY s, k) AS spans
  FROM judged GROUP BY rid)"""


SECRETS = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text, coalesce(source, '') AS owner
  FROM documents),
{secrets_ctes('d')}
SELECT doc_id, coalesce(n0, 0) AS n_assign, coalesce(n1, 0) AS n_access, coalesce(n2, 0) AS n_hex,
  sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN per_row USING (rid)"""

EQUAL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
h AS (SELECT doc_id, sha256(t) AS text_sha256 FROM n)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
  doc_id = min(doc_id) OVER g AS kept, text_sha256
FROM h WINDOW g AS (PARTITION BY text_sha256)"""

CAPTURES = """
WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest)
  ELSE page_id END AS first_id FROM p)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN first_id = page_id THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN first_id <> page_id THEN first_id END AS refers_to
FROM f"""

COLLOCATIONS = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
s AS (SELECT lang, unnest(string_split_regex(t, '[.,;:!?\x0A-\x0D]')) AS piece FROM d),
p AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM s),
t AS (SELECT lang, CAST(sum(len(w)) AS HUGEINT) AS n FROM p GROUP BY lang),
g AS (SELECT lang, k, unnest(list_transform(range(1, len(w) - k + 2), lambda i: array_to_string(w[i:i + k - 1], ' '))) AS phrase
  FROM p, range(1, 6) AS sizes(k) WHERE len(w) >= k),
f AS (SELECT lang, k AS words, phrase, CAST(count(*) AS HUGEINT) AS f FROM g GROUP BY ALL HAVING count(*) >= 100),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1),
inner_parts AS (SELECT lang, a, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM c, range(2, 5) AS sizes(k), range(1, 5) AS places(i) WHERE k < words AND i + k - 1 <= words),
hidden AS (SELECT DISTINCT c.lang, c.phrase FROM c JOIN inner_parts i ON c.lang = i.lang AND c.phrase = i.phrase
  WHERE 100 * i.a >= 100 * c.a),
cuts AS (SELECT c.lang, c.phrase, a, k, x.f AS l, y.f AS r, n, 1000 * a * n // (x.f * y.f) AS score
  FROM (SELECT *, unnest(range(1, words)) AS k FROM c ANTI JOIN hidden USING (lang, phrase)) c
  JOIN f x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[1:k], ' ')
  JOIN f y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[k + 1:], ' ')
  JOIN t ON t.lang = c.lang),
best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1)
SELECT lang, CAST(row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS BIGINT) AS rank, phrase,
  CAST(a AS BIGINT) AS a, CAST(l AS BIGINT) AS l, CAST(r AS BIGINT) AS r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score
FROM best QUALIFY rank <= 2000"""

AUDIT = r"""
WITH d AS (SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
u AS (SELECT rid, lang, source, unnest(w) AS term FROM d),
k AS (SELECT lang, term, count(*) AS total FROM u GROUP BY ALL HAVING count(DISTINCT rid) >= 3),
c AS (SELECT u.lang, source, term, count(*) AS c FROM u JOIN k USING (lang, term) GROUP BY ALL),
l AS (SELECT lang, sum(total) AS n, count(*) AS v FROM k GROUP BY ALL),
g AS (SELECT lang, source, CAST(coalesce(sum(c), 0) AS HUGEINT) + coalesce(any_value(v), 0) AS whole
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN c USING (lang, source) LEFT JOIN l USING (lang) GROUP BY ALL),
p AS (SELECT g.lang, g.source, k.term, total, coalesce(c, 0) AS c,
    1 + CAST(1000000000 AS HUGEINT) * (coalesce(c, 0) + 1) // whole AS p
  FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
pairs AS (SELECT a.lang, a.source, b.source AS item,
    coalesce((SELECT sum((x.p - y.p) * (x.p - y.p) // y.p) FROM p x JOIN p y USING (lang, term)
      WHERE x.lang = a.lang AND x.source = a.source AND y.source = b.source), 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source),
q AS (SELECT lang, source, term AS item, p, 1 + CAST(1000000000 AS HUGEINT) * (total + 1) // (n + v) AS q
  FROM p JOIN l USING (lang) WHERE c > 0),
r AS (SELECT 'pair' AS part, lang, source, item, value FROM pairs
  UNION ALL SELECT 'term', lang, source, item, (p - q) * (p - q) // q FROM q WHERE p > q)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
  CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
FROM r QUALIFY part = 'pair' OR rank <= 200"""

ORACLES = {"op2_refine_dedup": EQUAL, "op3_warc_captures": CAPTURES, "op4_line_quality": QUALITY, "op6_secret_scan": SECRETS,
           "op12_collocations": COLLOCATIONS, "op13_source_audit": AUDIT}
