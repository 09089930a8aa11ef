"""Joins of features, labels and splits, and the plans made of them."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfeat.checks.corpus_checks import DOCS, VOCAB_SQL, WEIGHT, bi_gram_term_vocabulary, stored_lists, token_vocabulary
from newsfeat.checks.feature_checks import pattern_sql
from newsfeat.checks.fixtures import (ARTICLES_SQL, DOCS_SQL, LABELLED_SQL, TEST_IDS_SQL, articles, docs, labelled,
                                      table, test_ids, token_ctes)
from newsfeat.checks.registry import query
from newsfeat.checks.sentiment_checks import WORDS_SQL, rule_sql, words
from newsfeat.checks.source_checks import label_feed
from newsfeat.functions.features import PATTERNS, TRAINING_STATS
from newsfeat.operators import corpus as C
from newsfeat.operators import joins as J
from newsfeat.operators import tfidf as W
from newsfeat.plans import exports, scoring, training
from newsfeat.session import stored
from newsfeat.sources.readers import parse_labels

N_TOKENS, N_GRAMS = C.TOKEN_CORPUS_SIZE, C.BI_GRAM_CORPUS_SIZE


@query("j3_merge_on_key", f"""WITH {LABELLED_SQL}
SELECT _guid, significance, n_chars, quality, title FROM labelled
JOIN (SELECT CAST(doc_id AS VARCHAR) AS _guid, n_chars FROM documents) USING (_guid)
JOIN (SELECT CAST(doc_id AS VARCHAR) AS _guid, quality FROM labels) USING (_guid)""")
def j3(spark, sf):
    guid = F.col("doc_id").cast("string").alias("_guid")
    return J.merge_on([
        table(spark, sf, "documents").select(guid, "n_chars"),
        labelled(spark, sf).select("_guid", "significance", "title"),
        table(spark, sf, "labels").select(guid, "quality")], "_guid")


@query("j6_stored_counts", f"""{DOCS}
SELECT source_id AS _data_source, doc_id AS _id, term, tf FROM tok_counts JOIN labels USING (doc_id)""")
def j6(spark, sf):
    rows = labelled(spark, sf).select("_data_source", "_id")
    return W.stored_counts(rows, C.nested_counts(docs(spark, sf), stem=False))


@query("j6_stored_bi_gram_counts", f"""{DOCS}
SELECT source_id AS _data_source, doc_id AS _id, g1 || '.' || g2 AS term, c AS tf FROM bg_counts
JOIN labels USING (doc_id)""")
def j6_grams(spark, sf):
    rows = labelled(spark, sf).select("_data_source", "_id")
    return W.stored_counts(rows, C.nested_counts(docs(spark, sf), stem=False), "bi_gram")


@query("f7_first_match", """SELECT user_id, event_type, event_id, value FROM events
QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY event_id) = 1""")
def f7(spark, sf):
    rows = table(spark, sf, "events").select("user_id", "event_type", "event_id", "value")
    return J.first_match(rows, ["user_id", "event_type"], F.col("event_id"))


@query("j8_attach_labels", """SELECT CAST(doc_id AS VARCHAR) AS guid,
  coalesce(CAST(quality AS VARCHAR), '') AS significance FROM documents LEFT JOIN labels USING (doc_id)""")
def j8(spark, sf):
    return J.attach_labels(articles(spark, sf).select("guid"), parse_labels(label_feed(spark, sf)))


@query("l2_label_news", f"""WITH pairs AS (
  SELECT CAST(doc_id AS VARCHAR) AS guid, toxic + 10 AS s FROM labels)
SELECT guid, coalesce(CAST(s AS VARCHAR), '') AS significance
FROM (SELECT CAST(doc_id AS VARCHAR) AS guid FROM documents) LEFT JOIN pairs USING (guid)""")
def l2(spark, sf):
    """Each guid is labelled twice in one feed; the later label wins."""
    rows = table(spark, sf, "labels")

    def item(value):
        guid = F.struct(F.col("doc_id").cast("string").alias("guid")).alias("guid")
        return F.struct(guid, value.cast("string").alias("significance"))

    feed = rows.select(F.to_json(F.array(item(F.col("quality")), item(F.col("toxic") + 10))).alias("json"))
    return exports.label_news(articles(spark, sf), parse_labels(feed))


@query("j9_join_features", """SELECT doc_id, lang, quality, toxic FROM documents LEFT JOIN labels USING (doc_id)""")
def j9(spark, sf):
    return J.join_features(table(spark, sf, "documents").select("doc_id", "lang"), table(spark, sf, "labels"), "doc_id")


@query("f8_split_by_ids", f"""WITH {LABELLED_SQL}, {TEST_IDS_SQL}
SELECT _guid, significance, CASE WHEN _guid IN (SELECT id FROM test_ids) THEN 'test' ELSE 'train' END AS split
FROM labelled""")
def f8(spark, sf):
    train, test = J.split_by_ids(labelled(spark, sf).select("_guid", "significance"), test_ids(spark, sf), "_guid")
    return train.withColumn("split", F.lit("train")).unionByName(test.withColumn("split", F.lit("test")))


@query("f10_drop_nulls", "SELECT doc_id, quality, toxic FROM documents JOIN labels USING (doc_id)")
def f10(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id").join(table(spark, sf, "labels"), "doc_id", "left")
    return J.drop_nulls(rows, ["quality", "toxic"])


@query("a11_distinct_ids", "SELECT DISTINCT user_id AS id FROM events")
def a11(spark, sf):
    return table(spark, sf, "events").select(F.col("user_id").alias("id")).distinct()


@query("u1_preview", "SELECT doc_id, source, n_chars FROM documents ORDER BY n_chars DESC, doc_id LIMIT 5")
def u1(spark, sf):
    rows = table(spark, sf, "documents").select("doc_id", "source", "n_chars")
    rows = rows.withColumn("order", -F.col("n_chars"))
    return J.preview(rows, ["order", "doc_id"], 5).drop("order")


def packed(terms):
    """The `weights` array as one text of non-zero terms per row, for comparison."""
    names = F.split(F.lit("\n".join(terms)), "\n")
    cells = F.zip_with(names, F.col("weights"), lambda t, w: F.struct(t.alias("t"), F.round(w, 3).alias("w")))
    kept = F.array_sort(F.filter(cells, lambda e: e["w"] > 0))
    return F.array_join(F.transform(kept, lambda e: F.concat(
        e["t"], F.lit(":"), F.round(e["w"] * 1000).cast("bigint"))), " ").alias("weights")


def packed_rows(wide, key, places, name="weights", only=None):
    """key and the sparse weights as one text of non-zero terms, for comparison; rows without any term are left out."""
    cells = W.long_form(wide, [key], places).withColumn("w", F.round("tfidf", 3)).where("w > 0")
    cells = cells.where(only) if only else cells
    cell = F.concat("term", F.lit(":"), F.round(F.col("w") * 1000).cast("bigint"))
    ordered = F.sort_array(F.collect_list(F.struct("term", cell.alias("cell"))))
    return cells.groupBy(key).agg(F.array_join(ordered["cell"], " ").alias(name))


def from_columns(wide, terms):
    """Named term columns as a `weights` array again."""
    return wide.selectExpr(*[f"`{c}`" for c in wide.columns if c not in terms],
                           "array(" + ", ".join(f"`{t}`" for t in terms) + ") AS weights")


def packed_sql(counts: str, vocabulary: str, n: int, key: str = "doc_id") -> str:
    weight = WEIGHT.format(n=n)
    return f"""SELECT {key}, string_agg(term || ':' || CAST(round(round({weight}, 3) * 1000) AS BIGINT), ' '
  ORDER BY term) AS weights FROM {counts} JOIN {vocabulary} USING (term) WHERE round({weight}, 3) > 0 GROUP BY {key}"""


@query("a12_pivot_wide", f"""{DOCS}, {VOCAB_SQL}, packed AS ({packed_sql('tok_counts', 'vocab', N_TOKENS)})
SELECT doc_id, coalesce(weights, '') AS weights FROM docs LEFT JOIN packed USING (doc_id)""")
def a12(spark, sf):
    d = docs(spark, sf)
    vocabulary = token_vocabulary(d)
    weights = W.tfidf_from_text(d, ["doc_id"], vocabulary, N_TOKENS, stem=False)
    terms = W.term_list(vocabulary)
    wide = W.wide_for(d.select("doc_id"), weights, "doc_id", terms)
    return wide.select("doc_id", packed(terms))


@query("w5_combined_wide", f"""{DOCS}, {VOCAB_SQL},
c AS (SELECT doc_id, g1 || '.' || g2 AS term, c AS tf FROM bg_counts)
SELECT doc_id, term, round({WEIGHT.format(n=N_TOKENS)}, 6) AS tfidf FROM tok_counts JOIN vocab USING (term)
UNION ALL SELECT doc_id, term, round({WEIGHT.format(n=N_GRAMS)}, 6) FROM c JOIN bg_vocab USING (term)
UNION ALL SELECT doc_id, NULL, NULL FROM docs""")
def w5_wide(spark, sf):
    """One sparse row per document, opened into its terms; a row without term for every document shows that none is lost."""
    d = docs(spark, sf)
    lists = stored_lists(d)
    tokens, grams = token_vocabulary(d, lists), bi_gram_term_vocabulary(d, lists)
    places = W.term_places(tokens, grams)
    weights = W.combined_weights(d, ["doc_id"], tokens, N_TOKENS, grams, N_GRAMS, stem=False, lists=lists)
    wide = stored(W.sparse_for(d.select("doc_id"), weights, "doc_id", places), "wide")
    terms = W.long_form(wide, ["doc_id"], places).withColumn("tfidf", F.round("tfidf", 6))
    return terms.unionByName(wide.select("doc_id", F.lit(None).cast("string").alias("term"),
                                         F.lit(None).cast("double").alias("tfidf")))


LABELLED_DOCS = f"WITH {DOCS_SQL}, {token_ctes()}, {VOCAB_SQL}, {LABELLED_SQL}, {TEST_IDS_SQL}"


@query("l6_token_export", f"""{LABELLED_DOCS}, packed AS ({packed_sql('tok_counts', 'vocab', N_TOKENS)})
SELECT _guid, significance, title, CASE WHEN _guid IN (SELECT id FROM test_ids) THEN 'test' ELSE 'train' END AS split,
  coalesce(weights, '') AS weights FROM labelled LEFT JOIN packed ON _id = doc_id""")
def l6(spark, sf):
    d = docs(spark, sf)
    rows, places = exports.token_weights(labelled(spark, sf), C.nested_counts(d, stem=False), token_vocabulary(d),
                                         test_ids(spark, sf))
    rows = stored(rows, "token-export")
    kept = rows.select("_guid", "significance", "title", "split").join(packed_rows(rows, "_guid", places), "_guid", "left")
    return kept.fillna("", ["weights"])


@query("l7_bi_gram_export", f"""{LABELLED_DOCS},
grams AS (SELECT doc_id, g1 || '.' || g2 AS term, c AS tf FROM bg_counts),
packed AS ({packed_sql('grams', 'bg_vocab', N_GRAMS)})
SELECT _guid, CASE WHEN _guid IN (SELECT id FROM test_ids) THEN 'test' ELSE 'train' END AS split,
  coalesce(weights, '') AS weights FROM labelled LEFT JOIN packed ON _id = doc_id""")
def l7(spark, sf):
    wide = exports.bi_gram_export(labelled(spark, sf), bi_gram_term_vocabulary(docs(spark, sf)), test_ids(spark, sf),
                                  stem=False)
    terms = [c for c in wide.columns if c not in ("_guid", "split")]
    return from_columns(wide, terms).select("_guid", "split", packed(terms))


SENTIMENT_500 = rule_sql("SELECT _guid AS key, body[:500] AS text FROM labelled")
FEATURE_COLUMNS = """is_significant, is_very_significant, hour, sentiment_pos, sentiment_neg, sentiment_neu,
  sentiment_compound"""
FEATURES_SQL = f"""
featured AS (SELECT l._guid, l.significance, CASE WHEN significance = 0 THEN 0 ELSE 1 END AS is_significant,
  CASE WHEN significance = 2 THEN 1 ELSE 0 END AS is_very_significant, CAST((_id * 3600 + 1430439473) // 3600 % 24 AS INTEGER) AS hour,
  pos AS sentiment_pos, neg AS sentiment_neg, neu AS sentiment_neu, compound AS sentiment_compound
  FROM labelled l JOIN sentiments ON l._guid = sentiments.key)"""


def with_sentiments(select: str, extra: str = "") -> str:
    """CTEs of the rule SQL with its last SELECT named `sentiments`."""
    head, last = SENTIMENT_500.rsplit("\nSELECT key, CASE", 1)
    return (f"WITH {LABELLED_SQL}, {WORDS_SQL}, {head},\nsentiments AS (SELECT key, CASE{last}), {FEATURES_SQL}"
            f"{extra}\n{select}")


@query("l5_add_features", with_sentiments(f"SELECT _guid, significance, {FEATURE_COLUMNS} FROM featured"))
def l5(spark, sf):
    featured = training.add_features(labelled(spark, sf), words(spark, sf), zone="UTC")
    return featured.select("_guid", "significance", *[c.strip() for c in FEATURE_COLUMNS.split(",")])


def topic_weights(spark, sf):
    """TF-IDF over the topics text, as the file of topic features."""
    rows = labelled(spark, sf).select("_guid", F.col("topics").alias("body"))
    counts = rows.select("_guid", F.explode(F.split("body", " ")).alias("term")).groupBy("_guid", "term") \
        .agg(F.count("*").alias("tf"))
    vocabulary = stored(C.document_frequency(counts, ["term"]), "topics")
    weights = W.tfidf(counts, vocabulary, C.corpus_size(rows))
    return W.pivot_wide(weights, ["_guid"], W.term_list(vocabulary)), W.term_list(vocabulary)


@query("l4_training_table", with_sentiments(f"""
SELECT _guid, significance, {FEATURE_COLUMNS}, org_count, story_word_count, title_word_count, n_tokens, n_grams, topic
FROM featured JOIN counts USING (_guid) JOIN tok_n USING (_guid) JOIN bg_n USING (_guid) JOIN topic USING (_guid)""",
    f""", {DOCS_SQL}, {token_ctes()},
counts AS (SELECT _guid, len(string_split(orgs, ' ')) AS org_count, len(string_split(body, ' ')) AS story_word_count,
  len(string_split(title, ' ')) AS title_word_count FROM labelled),
tok_n AS (SELECT CAST(doc_id AS VARCHAR) AS _guid, CAST(sum(tf) AS BIGINT) AS n_tokens FROM tok_counts GROUP BY doc_id),
bg_n AS (SELECT CAST(doc_id AS VARCHAR) AS _guid, CAST(sum(c) AS BIGINT) AS n_grams FROM bg_counts GROUP BY doc_id),
df AS (SELECT topics, count(*) AS df FROM labelled GROUP BY topics),
topic AS (SELECT _guid, round(ln(1 + (SELECT count(*) FROM labelled) // df), 6) AS topic
          FROM labelled JOIN df USING (topics))"""))
def l4(spark, sf):
    d, rows = docs(spark, sf), labelled(spark, sf)
    guid = F.col("doc_id").cast("string").alias("_guid")
    counts = C.token_table(d, ["doc_id"], stem=False).groupBy("doc_id").agg(F.sum("tf").alias("n_tokens"))
    tokens = rows.select("_data_source", "_id", "_guid", "significance", "title", "`date.time`").join(
        counts.select(guid, "n_tokens"), "_guid")
    grams = C.bi_gram_table(d, ["doc_id"], stem=False).groupBy(guid).agg(F.sum("c").alias("n_grams"))
    grams = grams.withColumn("source.significance", F.lit("x"))
    topics, terms = topic_weights(spark, sf)
    topics = topics.withColumn("topics", F.lit("x"))
    made = training.training_table(tokens, rows, grams, topics, words(spark, sf), zone="UTC")
    topic = F.greatest(*[F.col(f"`{t}`") for t in terms], F.lit(0.0))
    return made.withColumn("topic", F.round(topic, 6)).select(
        "_guid", "significance", *[c.strip() for c in FEATURE_COLUMNS.split(",")],
        *[F.col(c).cast("bigint").alias(c) for c in ("org_count", "story_word_count", "title_word_count")],
        "n_tokens", "n_grams", "topic")


SCORED = ["story_word_count", "topics_count", "title_word_count", "org_count", "story.length", *PATTERNS]
BODY_SQL = f"""
{ARTICLES_SQL}, body_rows AS (SELECT guid AS doc_id, '' AS source_id,
  "lead parag" || ' ' || "lead parag" || ' ' || "story body" AS body FROM articles)"""


def _score_sql() -> str:
    head, last = rule_sql("""SELECT guid AS key, ("lead parag" || ' ' || "story body")[:200] AS text
      FROM articles""").rsplit("\nSELECT key, CASE", 1)
    patterns = ", ".join(pattern_sql("body", n) for n in PATTERNS)
    scaled = {n: f'round(("{n}" - {m}) / {s}, 6) AS "{n}"' for n, (m, s) in TRAINING_STATS.items()}
    columns = ", ".join(scaled.get(c, f'"{c}"') for c in SCORED)
    story = "(\"lead parag\" || ' ' || \"story body\")"
    return f"""WITH {BODY_SQL}, {DOCS_SQL}, base AS (SELECT * FROM docs),
d0 AS (SELECT source_id, doc_id, body FROM docs), {token_ctes('d0')}, {VOCAB_SQL}, {WORDS_SQL}, {head},
sentiments AS (SELECT key, CASE{last}),
scored_tok AS (SELECT doc_id, {_tokens('body')} AS a FROM body_rows),
scored_tok_rows AS (SELECT doc_id, unnest(a) AS term FROM scored_tok),
scored_counts AS (SELECT doc_id, term, count(*) AS tf FROM scored_tok_rows GROUP BY ALL),
scored_gram_rows AS (SELECT doc_id, unnest(list_zip(a[:-2], a[2:])) AS p FROM scored_tok WHERE len(a) > 1),
scored_grams AS (SELECT doc_id, p[1] || '.' || p[2] AS term, count(*) AS tf FROM scored_gram_rows GROUP BY ALL),
weighted AS (
  SELECT doc_id, round(sum({WEIGHT.format(n=N_TOKENS)}), 4) AS token_weight FROM scored_counts
  JOIN vocab USING (term) GROUP BY doc_id),
gram_weighted AS (
  SELECT doc_id, round(sum({WEIGHT.format(n=N_GRAMS)}), 4) AS gram_weight FROM scored_grams
  JOIN bg_vocab USING (term) GROUP BY doc_id),
plain AS (SELECT guid, "journal code" AS "journal.code", "story date" AS "date.time",
  "OA perm ids" AS "organizations.codes", "RCS" AS "topics.codes", title AS "story.title",
  CASE WHEN length(body) < 1001 THEN body ELSE body[:1000] || '...' END AS "story.body",
  len(string_split({story}, ' ')) AS story_word_count, len(string_split("RCS", ' ')) AS topics_count,
  len(string_split(title, ' ')) AS title_word_count, len(string_split("OA perm ids", ' ')) AS org_count,
  length({story}) AS "story.length", {patterns}
  FROM articles JOIN body_rows ON guid = body_rows.doc_id)
SELECT guid, "journal.code", "date.time", "organizations.codes", "topics.codes", "story.title", "story.body", {columns},
  pos AS sentiment_pos, neg AS sentiment_neg, neu AS sentiment_neu, compound AS sentiment_compound,
  coalesce(token_weight, 0.0) AS token_weight, coalesce(gram_weight, 0.0) AS gram_weight,
  coalesce(token_packed.weights, '') AS token_terms, coalesce(gram_packed.weights, '') AS gram_terms
FROM plain JOIN sentiments ON guid = key LEFT JOIN weighted ON guid = weighted.doc_id
LEFT JOIN gram_weighted ON guid = gram_weighted.doc_id
LEFT JOIN ({packed_sql('scored_counts', 'vocab', N_TOKENS)}) token_packed ON guid = token_packed.doc_id
LEFT JOIN ({packed_sql('scored_grams', 'bg_vocab', N_GRAMS)}) gram_packed ON guid = gram_packed.doc_id"""


def _tokens(text: str) -> str:
    from newsfeat.checks.fixtures import tokens_sql

    return tokens_sql(text)


@query("l1_score_news", _score_sql())
def l1(spark, sf):
    """All features of new articles, with the weights per term and their sums per kind."""
    d = docs(spark, sf)
    lists = stored_lists(d)
    tokens, grams = token_vocabulary(d, lists), bi_gram_term_vocabulary(d, lists)
    scored, places = scoring.score_weights(articles(spark, sf), tokens, grams, words(spark, sf), stem=False)
    scored = stored(scored, "scored")
    fixed = ["guid", "journal.code", "date.time", "organizations.codes", "topics.codes", "story.title", "story.body",
             *SCORED, "sentiment_pos", "sentiment_neg", "sentiment_neu", "sentiment_compound"]
    cells = F.arrays_zip(F.col("weights.indices").alias("place"), F.col("weights.values").alias("value"))
    n = tokens.count()

    def total(low, high):
        part = F.filter(cells, lambda e: (e["place"] >= low) & (e["place"] < high))
        return F.round(F.aggregate(part, F.lit(0.0), lambda a, e: a + e["value"]), 4)

    rounded = [F.round(F.col(f"`{c}`"), 6).alias(c) if c in PATTERNS or c in TRAINING_STATS else
               F.col(f"`{c}`").cast("bigint").alias(c) if c in SCORED else F.col(f"`{c}`") for c in fixed]
    out = scored.select(*rounded, total(0, n).alias("token_weight"), total(n, 2**31 - 1).alias("gram_weight"))
    for name, only in (("token_terms", "term NOT LIKE '%.%'"), ("gram_terms", "term LIKE '%.%'")):
        out = out.join(packed_rows(scored, "guid", places, name, only), "guid", "left").fillna("", [name])
    return out
