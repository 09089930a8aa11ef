import math
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsfeat.operators import corpus as C
from newsfeat.operators import tfidf as W

TEXTS = [
    ("a", 1, "Profit rises profit falls market"), ("a", 2, "market profit rises"), ("b", 1, "profit rises fast"),
    ("b", 1, "profit rises fast"), ("b", 3, ""), ("b", 4, None), ("b", 5, "solo"),
]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(TEXTS, "source_id string, doc_id int, body string").cache()


def words(text):
    return (text or "").lower().split()


def grams(text):
    w = words(text)
    return list(zip(w, w[1:]))


def test_rows_with_one_id_are_counted_apart(docs):
    got = Counter((r["doc_id"], r["term"], r["tf"]) for r in C.token_table(docs, ["doc_id"], stem=False).collect())
    want = Counter((d, t, n) for _, d, x in TEXTS for t, n in Counter(words(x)).items())
    assert got == want


def test_document_frequency_is_exact(docs):
    got = {(r["g1"], r["g2"]): r["df"] for r in C.document_frequency(
        C.bi_gram_table(docs, [], stem=False), ["g1", "g2"]).collect()}
    want = Counter(g for _, _, x in TEXTS for g in set(grams(x)))
    assert got == want


def test_nested_records(docs):
    got = C.nested_counts(docs, stem=False).where("sql_id = 1 AND sql_tbl_id = 'a'").first()
    assert {(t["t"], t["c"]) for t in got["t_counts"]} == {("profit", 2), ("rises", 1), ("falls", 1), ("market", 1)}
    assert {(b["g1"], b["g2"], b["c"]) for b in got["bg_counts"]} == {
        (a, b, n) for (a, b), n in Counter(grams(TEXTS[0][2])).items()}


def test_partials_by_rows_and_by_sum(spark):
    partials = spark.createDataFrame([("s", "a", "b", 5), ("t", "a", "b", 2)], "s string, g1 string, g2 string, c int")
    assert C.merge_partials(partials, ["g1", "g2"]).first()["count"] == 2
    assert C.merge_partials(partials, ["g1", "g2"], "sum").first()["count"] == 7
    with pytest.raises(ValueError):
        C.merge_partials(partials, ["g1"], "max")


def test_band_includes_both_ends(spark):
    df = spark.createDataFrame([(x,) for x in (0, 1, 50, 70, 71)], "df int")
    assert sorted(r["df"] for r in C.band(df, 100).collect()) == [1, 50, 70]


def test_dense_ids_follow_the_order(spark):
    terms = [f"t{i:04d}" for i in range(500)]
    df = spark.createDataFrame([(t,) for t in reversed(terms)], "t string").repartition(7)
    got = sorted((r["i"], r["t"]) for r in C.dense_ids(df, "t").collect())
    assert got == list(enumerate(terms, 1))


@pytest.mark.parametrize("max_rows", [None, 0])
def test_encode_and_decode(docs, max_rows):
    dictionary = C.token_dictionary(docs, stem=False).cache()
    ids = {r["t"]: r["i"] for r in dictionary.collect()}
    assert sorted(ids.values()) == list(range(1, len(ids) + 1))
    table = C.bi_gram_table(docs, ["doc_id"], stem=False)
    coded = C.encode(table, dictionary, max_rows)
    want = Counter((d, ids[a], ids[b], n) for _, d, x in TEXTS for (a, b), n in Counter(grams(x)).items())
    assert Counter((r["doc_id"], r["g1"], r["g2"], r["c"]) for r in coded.collect()) == want
    back = C.decode(coded, dictionary, max_rows)
    assert Counter(r["term"] for r in back.collect()) == Counter(
        ".".join(g) for _, _, x in TEXTS for g in set(grams(x)))
    assert C.not_in_dictionary(table, dictionary.where("t <> 'market'")).collect()[0]["t"] == "market"


def test_sources_leave_labelled_articles_out(spark):
    sw = spark.createDataFrame([(1, "one", 1), (2, "two", 1), (3, "three", 0)], "ID int, story string, in_sample int")
    se = spark.createDataFrame([(9, "nine", 2), (8, "eight", None)], "ID int, story string, swiftID int")
    ns = spark.createDataFrame([(1, "l", "b", 1), (2, None, "b", 1)], "ID int, lead_parag string, body string, in_sample int")
    ne = spark.createDataFrame([(7, "seven", 5)], "ID int, body string, nscID int")
    got = {tuple(r) for r in C.corpus_sources(sw, se, ns, ne, sample_only=True).collect()}
    assert got == {("se", 9, "nine"), ("se", 8, "eight"), ("ne", 7, "seven"), ("sw", 1, "one"), ("ns", 1, "l b"), ("ns", 2, None)}


def test_weight_uses_whole_division(spark):
    df = spark.createDataFrame([(3, 7), (0, 7)], "tf bigint, df bigint")
    got = [tuple(r) for r in df.select(
        W.tfidf_weight(F.col("tf"), F.col("df"), 100), W.tfidf_weight(F.col("tf"), F.col("df"), 100, exact=True)).collect()]
    assert got[0] == pytest.approx(((1 + math.log(3)) * math.log(1 + 14), (1 + math.log(3)) * math.log(1 + 100 / 7)))
    assert got[1] == (0.0, 0.0)


@pytest.mark.parametrize("max_rows", [None, 0])
def test_weights_and_wide_form(docs, spark, max_rows):
    vocabulary = spark.createDataFrame([("profit", 4), ("market", 2), ("absent", 1)], "term string, df bigint")
    rows = docs.withColumn("row_id", F.monotonically_increasing_id()).cache()
    weights = W.tfidf_from_text(rows, ["row_id"], vocabulary, 10, stem=False, max_rows=max_rows)
    terms = W.term_list(vocabulary)
    assert terms == ["absent", "market", "profit"]
    wide = W.expand_columns(W.wide_for(rows, weights, "row_id", terms), terms)
    for r in wide.collect():
        n = Counter(words(r["body"]))
        want = [(1 + math.log(n[t])) * math.log(1 + 10 // d) if n[t] else 0.0 for t, d in
                (("absent", 1), ("market", 2), ("profit", 4))]
        assert [r[t] for t in terms] == pytest.approx(want)


def test_term_columns_may_clash_with_others(spark):
    df = spark.createDataFrame([("x", [1.0, 2.0])], "title string, weights array<double>")
    assert W.expand_columns(df, ["a.b", "title"]).columns == ["title", "a.b", "tfidf_title"]


def test_wide_weights_of_many_terms(spark):
    n = 25_000
    vocabulary = spark.range(n).selectExpr("lpad(cast(id AS string), 5, '0') AS term")
    terms = W.term_list(vocabulary)
    weights = vocabulary.selectExpr("1 AS row_id", "term", "cast(term AS double) AS tfidf").where("cast(term AS int) % 7 = 0")
    got = W.dense_weights(weights, ["row_id"], terms).first()["weights"]
    assert got == [float(i) if i % 7 == 0 else 0.0 for i in range(n)]


def test_term_list_refuses_more_than_asked(spark):
    vocabulary = spark.range(5).selectExpr("cast(id AS string) AS term")
    with pytest.raises(ValueError):
        W.term_list(vocabulary, 4)


def test_stored_counts_take_the_first_record(spark):
    docs = spark.createDataFrame([("s", 1), ("s", 2)], "_data_source string, _id int")
    records = spark.createDataFrame(
        [("s", 1, [("a", 1)], [("a", "b", 3)], 0), ("s", 1, [("z", 9)], [], 1)],
        "sql_tbl_id string, sql_id int, t_counts array<struct<t:string,c:bigint>>, "
        "bg_counts array<struct<g1:string,g2:string,c:bigint>>, seq int")
    assert [tuple(r) for r in W.stored_counts(docs, records).collect()] == [("s", 1, "a", 1)]
    assert [tuple(r) for r in W.stored_counts(docs, records, "bi_gram").collect()] == [("s", 1, "a.b", 3)]


def test_a_large_dictionary_reads_the_grams_once(spark):
    """Measuring for the shuffle join and joining do not compute the grams again."""
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    rows = [("a", "b", i) for i in range(30)] + [("b", "c", i) for i in range(30)] + [(None, "a", 1), ("a", "zz", 2)]
    grams = spark.createDataFrame(rows, "g1 string, g2 string, v long")
    dictionary = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "i long, t string")
    coded = C.encode(grams.mapInArrow(counted, grams.schema), dictionary, max_rows=0)
    back = C.decode(coded, dictionary, max_rows=0)
    assert sorted(map(tuple, back.collect())) == sorted([("a.b", i) for i in range(30)] + [("b.c", i) for i in range(30)])
    assert read.value == len(rows)
