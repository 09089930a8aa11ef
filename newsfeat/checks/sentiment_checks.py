"""Lexicon sentiment. The lexicons are made of the words of the `benchmark` table."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfeat.checks.registry import query
from newsfeat.checks.fixtures import table
from newsfeat.functions.tokens import NOT_WORD
from newsfeat.operators import sentiment as N
from newsfeat.session import stored


def words(spark, sf):
    """Distinct words of `benchmark` with a value from -3 to 3 by their length."""
    found = table(spark, sf, "benchmark").select(F.explode(F.split(F.lower("text"), NOT_WORD)).alias("term"))
    found = found.where("term <> ''").distinct().withColumn("valence", F.length("term") % 7 - 3)
    return stored(found, "lexicon")


WORDS_SQL = r"""
lexicon AS (SELECT term, length(term) % 7 - 3 AS valence FROM (
  SELECT DISTINCT unnest(regexp_extract_all(lower(text), '[\p{L}\p{Nl}\p{No}_]+')) AS term FROM benchmark))
"""


def _list(names):
    return ", ".join("'" + n.replace("'", "''") + "'" for n in names)


def _boost(k):
    lower = f"lower(p{k})"
    base = f"CASE WHEN {lower} IN ({_list(N.INCREASING)}) THEN 0.293 WHEN {lower} IN ({_list(N.DECREASING)}) THEN -0.293 END"
    loud = f"CASE WHEN p{k} = upper(p{k}) AND p{k} <> lower(p{k}) AND mixed THEN 0.733 ELSE 0.0 END"
    return (f"coalesce((CASE WHEN v < 0 THEN -({base}) ELSE {base} END) + "
            f"(CASE WHEN v > 0 THEN {loud} ELSE -({loud}) END), 0.0)")


def _negated(k):
    return f"coalesce(lower(p{k}) IN ({_list(N.NEGATIONS)}) OR contains(lower(p{k}), 'n''t'), false)"


def _so(k):
    return f"coalesce(lower(p{k}) IN ('so', 'this'), false)"


def _never(k):
    return f"coalesce(lower(p{k}) = 'never', false)"


FACTORS = {
    1: f"CASE WHEN {_negated(1)} THEN -0.74 ELSE 1.0 END",
    2: f"CASE WHEN {_never(2)} AND {_so(1)} THEN 1.5 WHEN {_negated(2)} THEN -0.74 ELSE 1.0 END",
    3: f"CASE WHEN {_never(3)} AND ({_so(2)} OR {_so(1)}) THEN 1.25 WHEN {_negated(3)} THEN -0.74 ELSE 1.0 END",
}


def rule_sql(source: str) -> str:
    """VADER rules over a relation (key, text) by windows over word rows."""
    steps = ""
    for k, weight in N.DISTANCE.items():
        steps += f"""
s{k} AS (SELECT * EXCLUDE (v), CASE WHEN p{k} IS NOT NULL AND lower(p{k}) NOT IN (SELECT term FROM lexicon)
  THEN (v + {_boost(k)} * {weight}) * CAST({FACTORS[k]} AS DOUBLE) ELSE v END AS v FROM s{k - 1}),"""
    return f"""
texts AS ({source}),
raw AS (SELECT key, text, list_filter(string_split_regex(text, '\\s+'), lambda w: length(w) > 1) AS ws FROM texts),
word_rows AS (SELECT key, unnest(ws) AS raw_word, generate_subscripts(ws, 1) AS i FROM raw),
bare AS (SELECT key, i, CASE WHEN length(b) > 1 THEN b ELSE raw_word END AS word FROM (
  SELECT *, regexp_replace(raw_word, '^[.!?,;:\\-''"]+|[.!?,;:\\-''"]+$', '', 'g') AS b FROM word_rows)),
facts AS (SELECT key, count(*) AS n, count(*) FILTER (word = upper(word) AND word <> lower(word)) AS ups,
  min(i) FILTER (lower(word) = 'but') AS but FROM bare GROUP BY key),
ctx AS (SELECT b.*, n, ups > 0 AND ups < n AS mixed, but,
  lag(word, 1) OVER w AS p1, lag(word, 2) OVER w AS p2, lag(word, 3) OVER w AS p3, lead(word, 1) OVER w AS nxt
  FROM bare b JOIN facts USING (key) WINDOW w AS (PARTITION BY key ORDER BY i)),
s0 AS (SELECT ctx.*, CAST(valence + CASE WHEN word = upper(word) AND word <> lower(word) AND mixed
  THEN CASE WHEN valence > 0 THEN 0.733 ELSE -0.733 END ELSE 0 END AS DOUBLE) AS v
  FROM ctx JOIN lexicon ON lower(word) = term),{steps}
scored AS (SELECT key, CASE
    WHEN lower(word) IN ({_list(N.INCREASING + N.DECREASING)}) OR (lower(word) = 'kind' AND lower(nxt) = 'of') THEN 0.0
    WHEN lower(p1) = 'least' AND lower(p1) NOT IN (SELECT term FROM lexicon)
      AND coalesce(lower(p2) NOT IN ('at', 'very'), true) THEN v * -0.74
    ELSE v END * CAST(CASE WHEN i < but THEN 0.5 WHEN i > but THEN 1.5 ELSE 1.0 END AS DOUBLE) AS v FROM s3),
emph AS (SELECT key, CAST(least(length(text) - length(replace(text, '!', '')), 4) * 0.292
  + CASE WHEN q <= 1 THEN 0.0 WHEN q <= 3 THEN q * 0.18 ELSE 0.96 END AS DOUBLE) AS e
  FROM (SELECT *, length(text) - length(replace(text, '?', '')) AS q FROM texts)),
sums AS (SELECT texts.key, coalesce(sum(v), 0.0) AS s, coalesce(sum(v + 1) FILTER (v > 0), 0.0) AS p,
  coalesce(sum(v - 1) FILTER (v < 0), 0.0) AS m, count(*) FILTER (v <> 0) AS nonzero
  FROM texts LEFT JOIN scored USING (key) GROUP BY texts.key),
adjusted AS (SELECT key, s + sign(s) * e AS s, p + CASE WHEN p > -m THEN e ELSE 0 END AS p,
  m - CASE WHEN p < -m THEN e ELSE 0 END AS m, coalesce(n, 0) AS n, coalesce(n, 0) - nonzero AS neutral
  FROM sums JOIN emph USING (key) LEFT JOIN facts USING (key))
SELECT key, CASE WHEN n = 0 THEN 0.0 ELSE round(p / nullif(p - m + neutral, 0), 3) END AS pos,
  CASE WHEN n = 0 THEN 0.0 ELSE round(-m / nullif(p - m + neutral, 0), 3) END AS neg,
  CASE WHEN n = 0 THEN 0.0 ELSE round(neutral / nullif(p - m + neutral, 0), 3) END AS neu,
  round(s / sqrt(s * s + 15.0), 4) AS compound FROM adjusted"""


def scores(df):
    return df.select(F.col("doc_id").alias("key"), *[F.col(c).cast("double").alias(c) for c in N.SCORES])


@query("n1_lead_sentiment", f"WITH {WORDS_SQL}, {rule_sql('SELECT doc_id AS key, text[:200] AS text FROM documents')}")
def n1(spark, sf):
    return scores(N.rule_sentiment(table(spark, sf, "documents"), "doc_id", "text", words(spark, sf), 200))


@query("n1_whole_text_sentiment", f"WITH {WORDS_SQL}, {rule_sql('SELECT doc_id AS key, text FROM documents')}")
def n1_whole(spark, sf):
    return scores(N.rule_sentiment(table(spark, sf, "documents"), "doc_id", "text", words(spark, sf), None))


@query("n2_title_sentiment",
       f"WITH {WORDS_SQL}, {rule_sql('SELECT doc_id AS key, split_part(text, chr(10), 1) AS text FROM documents')}")
def n2(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", F.substring_index("text", "\n", 1).alias("title"))
    return scores(N.rule_sentiment(rows, "doc_id", "title", words(spark, sf), None))


PLAIN = r"""
plain AS (SELECT doc_id, unnest(regexp_extract_all(lower(text[:200]), '[\p{L}\p{Nl}\p{No}_]+')) AS term FROM documents)
"""


@query("n3_word_list_sentiment", f"""WITH {WORDS_SQL}, {PLAIN},
c AS (SELECT doc_id, count(*) FILTER (valence > 0) AS p, count(*) FILTER (valence < 0) AS m, count(*) AS w
      FROM plain LEFT JOIN lexicon USING (term) GROUP BY doc_id)
SELECT doc_id, coalesce(p, 0) AS "Positive", coalesce(m, 0) AS "Negative",
  round(CAST(coalesce(p - m, 0) AS DOUBLE) / (coalesce(p + m, 0) + 1e-6), 6) AS "Polarity",
  round(CAST(coalesce(p + m, 0) AS DOUBLE) / (coalesce(w, 0) + 1e-6), 6) AS "Subjectivity"
FROM documents LEFT JOIN c USING (doc_id)""")
def n3(spark, sf):
    lists = words(spark, sf).select("term", (F.col("valence") > 0).alias("positive"),
                                    (F.col("valence") < 0).alias("negative"))
    found = N.word_list_sentiment(table(spark, sf, "documents"), "doc_id", "text", lists, 200)
    return found.withColumns({c: F.round(c, 6) for c in ("Polarity", "Subjectivity")})


@query("n4_mean_sentiment", f"""WITH {WORDS_SQL}, {PLAIN}
SELECT d.doc_id, round(coalesce(avg(valence / 3.0), 0), 6) AS polarity,
  round(coalesce(avg(abs(valence) / 3.0), 0), 6) AS subjectivity
FROM documents d LEFT JOIN (SELECT doc_id, valence FROM plain JOIN lexicon USING (term)) x USING (doc_id)
GROUP BY d.doc_id""")
def n4(spark, sf):
    lists = words(spark, sf).select("term", (F.col("valence") / 3.0).alias("polarity"),
                                    (F.abs("valence") / 3.0).alias("subjectivity"))
    found = N.mean_sentiment(table(spark, sf, "documents"), "doc_id", "text", lists, 200)
    return found.withColumns({c: F.round(c, 6) for c in ("polarity", "subjectivity")})
