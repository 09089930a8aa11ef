"""Sparse wide weights."""

import csv

import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import functions as F

from newsfeat.operators import tfidf as W
from newsfeat.plans import exports, scoring


@pytest.fixture(scope="module")
def weights(spark):
    rows = [(1, "b", 2.0), (1, "a", 1.0), (1, "x.y", 4.0), (2, "c", 3.0), (2, "lost", 9.0)]
    return spark.createDataFrame(rows, "row_id int, term string, tfidf double")


@pytest.fixture(scope="module")
def places(spark):
    tokens = spark.createDataFrame([("c", 1), ("a", 1), ("b", 1)], "term string, df int")
    return W.term_places(tokens, spark.createDataFrame([("x.y", 1), ("a", 2)], "term string, df int"))


def test_places_follow_the_vocabularies(places):
    assert {r.term: r.place for r in places.collect()} == {"a": 0, "b": 1, "c": 2, "x.y": 3}


def test_rows_keep_only_their_terms(spark, weights, places):
    docs = spark.createDataFrame([(1, "p"), (2, "q"), (3, None)], "row_id int, title string")
    wide = W.sparse_for(docs, weights, "row_id", places)
    got = {r.row_id: (r.title, r.weights.size, r.weights.indices, r.weights["values"]) for r in wide.collect()}
    assert got == {1: ("p", 4, [0, 1, 3], [1.0, 2.0, 4.0]), 2: ("q", 4, [2], [3.0]), 3: (None, 4, [], [])}
    back = W.long_form(wide, ["row_id"], places)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, weights.where("term <> 'lost'").collect()))


@pytest.mark.parametrize("few", [64, 0])
def test_only_named_terms_become_columns(spark, weights, places, few, monkeypatch):
    monkeypatch.setattr(W, "FEW_TERMS", few)
    docs = spark.createDataFrame([(1, "p"), (2, "q"), (3, None)], "row_id int, c string")
    wide = W.sparse_for(docs, weights, "row_id", places)
    out = exports.term_columns(wide, places, ["x.y", "c", "unknown"])
    assert out.columns == ["row_id", "c", "x.y", "tfidf_c", "unknown"]
    assert sorted((r[0], *r[2:]) for r in out.collect()) == [(1, 4.0, 0.0, 0.0), (2, 0.0, 3.0, 0.0), (3, 0.0, 0.0, 0.0)]
    assert exports.term_columns(wide, places).columns == ["row_id", "c", "a", "b", "tfidf_c", "x.y"]


def test_a_repeated_id_is_an_error(spark, weights, places):
    with pytest.raises(Exception, match="id repeats"):
        W.sparse_weights(weights.unionByName(weights), ["row_id"], places).collect()


def test_a_million_terms(spark):
    n = 1_000_000
    terms = spark.range(n).selectExpr("lpad(cast(id AS string), 7, '0') AS term")
    places = W.term_places(terms)
    weights = terms.selectExpr("cast(cast(term AS int) % 3 AS int) AS row_id", "term", "cast(term AS double) AS tfidf").where(
        "cast(term AS int) % 9973 < 3")
    wide = W.sparse_weights(weights, ["row_id"], places)
    assert places.count() == n and places.where("cast(term AS int) <> place").isEmpty()
    for r in wide.collect():
        assert r.weights.size == n and r.weights.indices == [int(v) for v in r.weights["values"]] and len(r.weights.indices) > 90
    out = exports.term_columns(wide, places, ["0009973", "0000001"])
    assert sorted(map(tuple, out.collect())) == sorted((i, 9973.0 if 9973 % 3 == i else 0.0, float(i == 1)) for i in range(3))


def test_vectors_for_models(spark, places):
    rows = [(i, "ab"[i % 2], 1.0 + i) for i in range(20)]
    weights = spark.createDataFrame(rows, "row_id int, term string, tfidf double")
    docs = spark.createDataFrame([(i, float(i % 2)) for i in range(21)], "row_id int, label double")
    made = W.with_vectors(W.sparse_for(docs, weights, "row_id", places))
    first = made.where("row_id = 4").first()
    assert first.features.size == 4 and first.features.indices.tolist() == [0] and first.features.values.tolist() == [5.0]
    model = LogisticRegression().fit(made.where("row_id < 20"))
    assert model.transform(made.where("row_id < 20")).where("prediction <> label").isEmpty()


def test_files_to_a_scored_csv(spark, tmp_path):
    import json

    source, target = tmp_path / "in", tmp_path / "out"
    source.mkdir()
    for i, text in enumerate(["profits rising, profits", "nothing \"said\"\nhere"]):
        (source / f"{i}.json").write_text(json.dumps({"scrollid": f"g{i}", "maindocdate": "2015-05-01T00:00:00", "subheadline": "T", "data": text}))
    tokens = spark.createDataFrame([("profits", 5), ("rising", 2)], "term string, df bigint")
    grams = spark.createDataFrame([("profits.rising", 3)], "term string, df bigint")
    lexicon = spark.createDataFrame([("rising", 1.9)], "term string, valence double")
    scoring.score_files(spark, str(source), str(target), tokens, grams, lexicon, sep=";", stem=False)
    rows = [r for p in target.glob("*.csv") for r in csv.DictReader(p.open(newline=""), delimiter=";")]
    got = {r["guid"]: r for r in rows}
    assert set(got) == {"g0", "g1"} and float(got["g0"]["profits"]) > float(got["g0"]["rising"]) > 0
    assert float(got["g0"]["profits.rising"]) > 0 and float(got["g1"]["profits"]) == 0
    assert got["g1"]["story.body"].strip() == "nothing \"said\"\nhere" and float(got["g0"]["sentiment_compound"]) > 0
