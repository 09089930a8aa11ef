"""Tokens, n-grams, corpus statistics and TF-IDF."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from newsfeat.checks.fixtures import (CORPUS_SQL, DOCS_SQL, SAMPLED_CORPUS_SQL, docs, source_tables,
                                      token_ctes, tokens_sql)
from newsfeat.checks.registry import query
from newsfeat.functions.stem import stem_terms
from newsfeat.functions.tokens import ngrams, phrase_ngrams, tokenize
from newsfeat.operators import corpus as C
from newsfeat.operators import tfidf as W
from newsfeat.plans import incremental
from newsfeat.session import scratch_path, ship_package, stored

IDS = ["source_id", "doc_id"]
DOCS = f"WITH {DOCS_SQL}, {token_ctes()}"
CORPUS = f"WITH {CORPUS_SQL}, {token_ctes('corpus')}"
VOCAB_SQL = """
n AS (SELECT count(*) AS n FROM docs),
vocab AS (SELECT term, count(*) AS df FROM tok_counts GROUP BY term
          HAVING count(*) BETWEEN 0.01 * (SELECT n FROM n) AND 0.7 * (SELECT n FROM n)),
bg_vocab AS (SELECT g1 || '.' || g2 AS term, count(*) AS df FROM bg_counts GROUP BY g1, g2
          HAVING count(*) BETWEEN 0.01 * (SELECT n FROM n) AND 0.7 * (SELECT n FROM n))
"""
WEIGHT = "(1 + ln(tf)) * ln(1 + {n} // df)"


def token_vocabulary(d, lists=None):
    return stored(C.band_vocabulary(d, stem=False, lists=lists), "token-vocabulary")


def bi_gram_term_vocabulary(d, lists=None):
    return stored(C.band_vocabulary(d, n=2, stem=False, lists=lists), "bi-gram-vocabulary")


def stored_lists(d):
    return stored(C.token_lists(d, ["doc_id"], stem=False), "token-lists")


@query("t1_tokenize", f"SELECT doc_id, array_to_string({tokens_sql('text')}, ' ') AS tokens FROM documents")
def t1(spark, sf):
    d = docs(spark, sf)
    return d.select("doc_id", F.array_join(tokenize(F.col("body")), " ").alias("tokens"))


@query("t2_stem")
def t2(spark, sf):
    ship_package(spark)
    terms = C.token_table(docs(spark, sf), [], stem=False).select("term").distinct()
    return terms.withColumn("stem", stem_terms(F.col("term")))


@query("t2_stemmed_token_counts")
def t2_counts(spark, sf):
    return C.token_table(docs(spark, sf), IDS, stem=True)


@query("t3_ngrams", f"""{DOCS}
SELECT doc_id, array_to_string(list_transform(list_zip(a[:-3], a[2:-2], a[3:]),
  lambda p: p[1] || '.' || p[2] || '.' || p[3]), ' ') AS grams FROM tok WHERE len(a) > 2
UNION ALL SELECT doc_id, '' FROM tok WHERE len(a) <= 2""")
def t3(spark, sf):
    d = docs(spark, sf)
    return d.select("doc_id", F.array_join(ngrams(tokenize(F.col("body")), 3), " ").alias("grams"))


@query("t4_phrase_bi_grams", f"""WITH pieces AS (
  SELECT doc_id, i, string_split_regex('"' || text || '"', '[.,;:]')[i] AS piece, text
  FROM (SELECT doc_id, text, unnest(range(1, len(string_split_regex('"' || text || '"', '[.,;:]')) + 1)) AS i
        FROM documents)),
tok AS (SELECT doc_id, i, {tokens_sql("CASE WHEN piece = '' THEN text ELSE piece END")} AS a FROM pieces),
grams AS (SELECT doc_id, unnest(list_zip(a[:-2], a[2:])) AS p FROM tok WHERE len(a) > 1)
SELECT doc_id, p[1] || '.' || p[2] AS term, count(*) AS tf FROM grams GROUP BY ALL""")
def t4(spark, sf):
    grams = phrase_ngrams(F.col("body"), 2, "[.,;:]")
    return C.term_counts(docs(spark, sf), ["doc_id"], grams)


@query("t5_token_counts", f"{DOCS} SELECT * FROM tok_counts")
def t5(spark, sf):
    return C.token_table(docs(spark, sf), IDS, stem=False)


@query("t6_bi_gram_counts", f"{DOCS} SELECT source_id, doc_id, g1 || '.' || g2 AS term, c AS tf FROM bg_counts")
def t6(spark, sf):
    return C.ngram_table(docs(spark, sf), IDS, stem=False)


@query("f1_with_text", "SELECT conv_id, turn, text AS body FROM conversations WHERE length(text) > 0")
def f1(spark, sf):
    talks = spark.read.parquet(f"{sf}/conversations.parquet")
    return C.with_text(talks.select("conv_id", "turn", F.col("text").alias("body")))


@query("f2_in_sample", f"WITH {SAMPLED_CORPUS_SQL} SELECT source_id, doc_id, length(body) AS n FROM corpus")
def f2(spark, sf):
    t = source_tables(spark, sf)
    sampled = C.corpus_sources(t["swift"], t["swift_excel"], t["nsc"], t["nsc_excel"], sample_only=True)
    return sampled.select("source_id", "doc_id", F.length("body").cast("bigint").alias("n"))


@query("u3_tagged_union", f"WITH {CORPUS_SQL} SELECT * FROM corpus")
def u3(spark, sf):
    t = source_tables(spark, sf)
    return C.corpus_sources(t["swift"], t["swift_excel"], t["nsc"], t["nsc_excel"])


@query("j1_anti_join", """SELECT doc_id AS "ID", text AS story FROM documents
WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)""")
def j1(spark, sf):
    t = source_tables(spark, sf)
    return C.not_labelled(t["swift"], t["swift_excel"], "ID", "swiftID").select("ID", "story")


@query("j2_anti_join_concat", """SELECT conv_id * 1000 + turn AS "ID", role || ' ' || text AS body
FROM conversations WHERE role <> 'user'""")
def j2(spark, sf):
    t = source_tables(spark, sf)
    rest = C.not_labelled(t["nsc"], t["nsc_excel"], "ID", "nscID")
    return rest.select("ID", C.lead_and_body(F.col("lead_parag"), F.col("body")).alias("body"))


@query("a1_document_bi_grams", f"{DOCS} SELECT * FROM bg_counts")
def a1(spark, sf):
    return C.bi_gram_table(docs(spark, sf), IDS, stem=False)


@query("a2_nested_counts", f"""{DOCS},
t AS (SELECT source_id, doc_id, string_agg(term || ':' || tf, ' ' ORDER BY term) AS t_counts
      FROM tok_counts GROUP BY ALL),
b AS (SELECT source_id, doc_id, string_agg(g1 || '.' || g2 || ':' || c, ' ' ORDER BY g1, g2) AS bg_counts
      FROM bg_counts GROUP BY ALL)
SELECT doc_id AS sql_id, source_id AS sql_tbl_id, coalesce(t_counts, '') AS t_counts,
  coalesce(bg_counts, '') AS bg_counts
FROM docs LEFT JOIN t USING (source_id, doc_id) LEFT JOIN b USING (source_id, doc_id)""")
def a2(spark, sf):
    nested = C.nested_counts(docs(spark, sf), stem=False)
    return nested.select(
        "sql_id", "sql_tbl_id",
        F.array_join(F.transform("t_counts", lambda e: F.concat(e["t"], F.lit(":"), e["c"])), " ").alias("t_counts"),
        F.array_join(F.transform("bg_counts", lambda e: F.concat(
            e["g1"], F.lit("."), e["g2"], F.lit(":"), e["c"])), " ").alias("bg_counts"))


@query("a3_source_occurrences", f"""{DOCS}
SELECT source_id, g1, g2, CAST(sum(c) AS BIGINT) AS c FROM bg_counts GROUP BY ALL""")
def a3(spark, sf):
    return C.occurrences(C.bi_gram_table(docs(spark, sf), IDS, stem=False), ["source_id", "g1", "g2"])


@query("a4_document_frequency", f"{DOCS} SELECT source_id, g1, g2, count(*) AS df FROM bg_counts GROUP BY ALL")
def a4(spark, sf):
    return C.document_frequency(C.bi_gram_table(docs(spark, sf), IDS, stem=False), ["source_id", "g1", "g2"])


@query("a5_roll_up", f"{DOCS} SELECT g1, g2, count(*) AS count FROM bg_counts GROUP BY ALL")
def a5(spark, sf):
    grams = C.bi_gram_table(docs(spark, sf), IDS, stem=False)
    by_source = C.document_frequency(grams, ["source_id", "g1", "g2"])
    return C.merge_partials(by_source, ["g1", "g2"], "sum", "df")


PARTIALS = "partials AS (SELECT source_id, g1, g2, sum(c) AS c FROM bg_counts GROUP BY ALL)"


@query("a6_count_partials", f"{DOCS}, {PARTIALS} SELECT g1, g2, count(*) AS count FROM partials GROUP BY ALL")
def a6(spark, sf):
    partials = C.occurrences(C.bi_gram_table(docs(spark, sf), IDS, stem=False), ["source_id", "g1", "g2"])
    return C.merge_partials(partials, ["g1", "g2"], "rows")


@query("a6_sum_partials", f"""{DOCS}, {PARTIALS}
SELECT g1, g2, CAST(sum(c) AS BIGINT) AS count FROM partials GROUP BY ALL""")
def a6_sum(spark, sf):
    partials = C.occurrences(C.bi_gram_table(docs(spark, sf), IDS, stem=False), ["source_id", "g1", "g2"])
    return C.merge_partials(partials, ["g1", "g2"], "sum")


@query("a7_corpus_token_counts", f"{DOCS} SELECT term, CAST(sum(tf) AS BIGINT) AS c FROM tok_counts GROUP BY term")
def a7(spark, sf):
    return C.occurrences(C.token_table(docs(spark, sf), [], stem=False), ["term"], "tf")


DICTIONARY = """
dictionary AS (SELECT row_number() OVER (ORDER BY t) AS i, t, c
               FROM (SELECT term AS t, CAST(sum(tf) AS BIGINT) AS c FROM tok_counts GROUP BY term))
"""


@query("a8_dense_ids", f"{DOCS}, {DICTIONARY} SELECT i, t, c FROM dictionary")
def a8(spark, sf):
    return C.token_dictionary(docs(spark, sf), stem=False)


@query("a10_observed_terms", f"{DOCS} SELECT DISTINCT term FROM tok_counts")
def a10(spark, sf):
    return W.observed_terms(C.token_table(docs(spark, sf), ["doc_id"], stem=False))


@query("f3_bi_gram_band", f"{DOCS}, {VOCAB_SQL} SELECT term, df FROM bg_vocab")
def f3(spark, sf):
    return C.band_vocabulary(docs(spark, sf), n=2, stem=False)


@query("f4_token_band", f"{DOCS}, {VOCAB_SQL} SELECT term, df FROM vocab")
def f4(spark, sf):
    return C.band_vocabulary(docs(spark, sf), stem=False)


@query("f5_min_count", f"{DOCS} SELECT g1, g2, count(*) AS df FROM bg_counts GROUP BY ALL HAVING count(*) >= 5")
def f5(spark, sf):
    return C.min_count(C.document_frequency(C.bi_gram_table(docs(spark, sf), IDS, stem=False), ["g1", "g2"]))


@query("u2_top_terms", f"""{DOCS}
SELECT term, count(*) AS df FROM tok_counts GROUP BY term ORDER BY df DESC, term LIMIT 200""")
def u2(spark, sf):
    return C.top_terms(C.document_frequency(C.token_table(docs(spark, sf), [], stem=False), ["term"]), 200)


@query("u4_vocabulary_union", f"""{DOCS}, {VOCAB_SQL}
SELECT term FROM vocab UNION SELECT term FROM bg_vocab""")
def u4(spark, sf):
    d = docs(spark, sf)
    return C.vocabulary_union(
        C.vocabulary(C.token_table(d, ["doc_id"], stem=False), d),
        C.vocabulary(C.ngram_table(d, ["doc_id"], stem=False), d))


@query("j4_encode", f"""{DOCS}, {DICTIONARY}
SELECT source_id, doc_id, a.i AS g1, b.i AS g2, bg_counts.c FROM bg_counts
JOIN dictionary a ON bg_counts.g1 = a.t JOIN dictionary b ON bg_counts.g2 = b.t""")
def j4(spark, sf):
    d = docs(spark, sf)
    dictionary = stored(C.token_dictionary(d, stem=False), "dictionary")
    return C.encode(C.bi_gram_table(d, IDS, stem=False), dictionary).select(*IDS, "g1", "g2", "c")


@query("j4_not_in_dictionary", f"""{DOCS}, pages_tok AS (
  SELECT DISTINCT unnest({tokens_sql('text')}) AS t FROM benchmark)
SELECT t FROM (SELECT DISTINCT unnest([g1, g2]) AS t FROM bg_counts) WHERE t NOT IN (SELECT t FROM pages_tok)""")
def j4_missing(spark, sf):
    bench = spark.read.parquet(f"{sf}/benchmark.parquet").select(F.col("text").alias("body"))
    known = C.token_table(bench, [], stem=False).select(F.col("term").alias("t")).distinct()
    grams = C.bi_gram_table(docs(spark, sf), [], stem=False)
    return C.not_in_dictionary(grams, stored(known, "dictionary"))


@query("f6_dictionary_subset", f"""{DOCS}, {DICTIONARY},
kept AS (SELECT g1, g2 FROM bg_counts GROUP BY ALL HAVING count(*) >= 5)
SELECT i, t, c FROM dictionary WHERE t IN (SELECT g1 FROM kept UNION SELECT g2 FROM kept)""")
def f6(spark, sf):
    d = docs(spark, sf)
    dictionary = stored(C.token_dictionary(d, stem=False), "dictionary")
    kept = C.min_count(C.document_frequency(C.bi_gram_table(d, [], stem=False), ["g1", "g2"]))
    ids = stored(C.gram_ids(C.encode(kept, dictionary)), "gram-ids")
    return C.dictionary_subset(dictionary, ids)


@query("j5_decode", f"""{DOCS}
SELECT g1 || '.' || g2 AS term, count(*) AS df FROM bg_counts GROUP BY g1, g2 HAVING count(*) >= 5""")
def j5(spark, sf):
    d = docs(spark, sf)
    dictionary = stored(C.token_dictionary(d, stem=False), "dictionary")
    kept = C.min_count(C.document_frequency(C.bi_gram_table(d, [], stem=False), ["g1", "g2"]))
    return C.decode(C.encode(kept, dictionary), dictionary)


CORPUS_DICTIONARY = f"{CORPUS}, {DICTIONARY}"


@query("l8_extract_grams", f"""{CORPUS_DICTIONARY}
SELECT source_id, a.i AS g1, b.i AS g2, CAST(sum(x.c) AS BIGINT) AS c, count(*) AS df FROM bg_counts x
JOIN dictionary a ON x.g1 = a.t JOIN dictionary b ON x.g2 = b.t GROUP BY ALL""")
def l8(spark, sf):
    t = source_tables(spark, sf)
    corpus = C.corpus_sources(t["swift"], t["swift_excel"], t["nsc"], t["nsc_excel"])
    dictionary = stored(C.token_dictionary(corpus, stem=False), "dictionary")
    return C.extract_grams(corpus, dictionary, stem=False)


@query("l8_incremental_corpus", f"""{DOCS}
SELECT source_id, g1, g2, CAST(sum(c) AS BIGINT) AS c, count(*) AS df FROM bg_counts GROUP BY ALL""")
def l8_batches(spark, sf):
    """Three batches, the second overlapping the first and the third repeating it, give the counts of all documents at once."""
    d, folder = docs(spark, sf), scratch_path(spark, "corpus")
    for some in ("doc_id % 3 <> 1", "doc_id % 3 <> 2", "doc_id % 3 <> 1"):
        incremental.add_batch(spark, folder, d.where(some), stem=False)
    dictionary, counts = incremental.read_corpus(spark, folder)
    for g in ("g1", "g2"):
        terms = dictionary.select(F.col("i").alias(g), F.col("t").alias("t"))
        counts = W.lookup_join(counts, terms, g, derived=True, sieve=False).drop(g).withColumnRenamed("t", g)
    return counts.select("source_id", "g1", "g2", "c", "df")


@query("l9_bi_gram_vocabulary", f"{DOCS}, {VOCAB_SQL} SELECT term, df FROM bg_vocab")
def l9(spark, sf):
    d = docs(spark, sf)
    dictionary = stored(C.token_dictionary(d, stem=False), "dictionary")
    frequencies = C.document_frequency(C.bi_gram_table(d, [], stem=False), ["g1", "g2"])
    return C.bi_gram_vocabulary(C.encode(frequencies, dictionary), dictionary, C.corpus_size(d))


@query("w1_weight", f"""{DOCS}, n AS (SELECT count(*) AS n FROM docs),
f AS (SELECT term, count(*) AS df FROM tok_counts GROUP BY term)
SELECT doc_id, term, round({WEIGHT.format(n='(SELECT n FROM n)')}, 6) AS tfidf,
  round((1 + ln(tf)) * ln(1 + (SELECT n FROM n) / df), 6) AS exact_tfidf
FROM tok_counts JOIN f USING (term)""")
def w1(spark, sf):
    d = docs(spark, sf)
    counts = C.token_table(d, ["doc_id"], stem=False)
    frequency = stored(C.document_frequency(counts, ["term"]), "document-frequency")
    n = C.corpus_size(d)
    joined = W.lookup_join(counts, frequency, "term", derived=True, sieve=False)
    return joined.select(
        "doc_id", "term",
        F.round(W.tfidf_weight(F.col("tf"), F.col("df"), n), 6).alias("tfidf"),
        F.round(W.tfidf_weight(F.col("tf"), F.col("df"), n, exact=True), 6).alias("exact_tfidf"))


@query("w2_token_tfidf", f"""{DOCS}, {VOCAB_SQL}
SELECT doc_id, term, round({WEIGHT.format(n=C.TOKEN_CORPUS_SIZE)}, 6) AS tfidf
FROM tok_counts JOIN vocab USING (term)""")
def w2(spark, sf):
    d = docs(spark, sf)
    weights = W.tfidf_from_text(d, ["doc_id"], token_vocabulary(d), C.TOKEN_CORPUS_SIZE, stem=False)
    return weights.withColumn("tfidf", F.round("tfidf", 6))


@query("w3_bi_gram_tfidf", f"""{DOCS}, {VOCAB_SQL},
c AS (SELECT doc_id, g1 || '.' || g2 AS term, c AS tf FROM bg_counts)
SELECT doc_id, term, round({WEIGHT.format(n=C.BI_GRAM_CORPUS_SIZE)}, 6) AS tfidf
FROM c JOIN bg_vocab USING (term)""")
def w3(spark, sf):
    d = docs(spark, sf)
    weights = W.tfidf_from_text(d, ["doc_id"], bi_gram_term_vocabulary(d), C.BI_GRAM_CORPUS_SIZE,
                                grams=2, stem=False)
    return weights.withColumn("tfidf", F.round("tfidf", 6))


@query("w4_tfidf_from_counts", f"""{DOCS}, {VOCAB_SQL}
SELECT source_id AS _data_source, doc_id AS _id, term, round({WEIGHT.format(n=C.TOKEN_CORPUS_SIZE)}, 6) AS tfidf
FROM tok_counts JOIN vocab USING (term)""")
def w4(spark, sf):
    d = docs(spark, sf)
    rows = d.select(F.col("source_id").alias("_data_source"), F.col("doc_id").alias("_id"))
    records = C.nested_counts(d, stem=False)
    weights = W.tfidf_from_counts(rows, records, token_vocabulary(d), C.TOKEN_CORPUS_SIZE)
    return weights.withColumn("tfidf", F.round("tfidf", 6))


@query("w5_combined_long", f"""{DOCS}, {VOCAB_SQL},
c AS (SELECT doc_id, g1 || '.' || g2 AS term, c AS tf FROM bg_counts)
SELECT doc_id, term, round({WEIGHT.format(n=C.TOKEN_CORPUS_SIZE)}, 6) AS tfidf
FROM tok_counts JOIN vocab USING (term)
UNION ALL
SELECT doc_id, term, round({WEIGHT.format(n=C.BI_GRAM_CORPUS_SIZE)}, 6) FROM c JOIN bg_vocab USING (term)""")
def w5(spark, sf):
    d = docs(spark, sf)
    tokens = W.tfidf_from_text(d, ["doc_id"], token_vocabulary(d), C.TOKEN_CORPUS_SIZE, stem=False)
    grams = W.tfidf_from_text(d, ["doc_id"], bi_gram_term_vocabulary(d), C.BI_GRAM_CORPUS_SIZE,
                              grams=2, stem=False)
    return tokens.unionByName(grams).withColumn("tfidf", F.round("tfidf", 6))


@query("j7_term_document_frequency", f"""{DOCS}, {VOCAB_SQL}
SELECT doc_id, term, tf, df FROM tok_counts JOIN vocab USING (term)""")
def j7(spark, sf):
    d = docs(spark, sf)
    counts = C.token_table(d, ["doc_id"], stem=False)
    return W.lookup_join(counts, token_vocabulary(d), "term").select("doc_id", "term", "tf", "df")


@query("top_tokens", f"""{DOCS}, {VOCAB_SQL},
w AS (SELECT source_id, doc_id, term, round({WEIGHT.format(n='(SELECT n FROM n)')}, 6) AS tfidf
      FROM tok_counts JOIN vocab USING (term))
SELECT source_id, doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY tfidf DESC, term) AS INTEGER)
  AS rank, term, tfidf FROM w QUALIFY rank <= 10""")
def top_tokens(spark, sf):
    """For each document its ten heaviest tokens."""
    d = docs(spark, sf)
    weights = W.tfidf_from_text(d, IDS, token_vocabulary(d), C.corpus_size(d), stem=False)
    weights = weights.withColumn("tfidf", F.round("tfidf", 6))
    order = Window.partitionBy("doc_id").orderBy(F.desc("tfidf"), "term")
    return weights.withColumn("rank", F.row_number().over(order)).where("rank <= 10")
