"""Splits, classifiers, cascade, nearest neighbours and scores."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfeat.checks.fixtures import LABELLED_SQL, labelled, table
from newsfeat.checks.registry import query
from newsfeat.functions.features import binary_labels, count_feature
from newsfeat.operators import model as M
from newsfeat.operators.knn import cosine_knn, neighbours
from newsfeat.session import stored

X_COLS = ["story_word_count", "title_word_count", "org_count", "story.length", "vowels"]


def training_rows(spark, sf):
    """Labelled articles with a few numeric features."""
    rows = labelled(spark, sf).withColumns({
        "story_word_count": count_feature(F.col("body"), " "),
        "title_word_count": count_feature(F.col("title"), " "),
        "org_count": count_feature(F.col("orgs"), " "),
        "story.length": F.length("body"),
        "vowels": F.regexp_count("body", F.lit("[aeiou]")) / F.length("body"),
    })
    rows = binary_labels(rows).select("_guid", "significance", "is_significant", "is_very_significant",
                                      *[F.col(f"`{c}`") for c in X_COLS])
    return stored(rows, "training-rows")


def single_model(name):
    def run(spark, sf):
        train, test = M.hash_split(training_rows(spark, sf), "_guid")
        _, scored = M.fit_predict(M.estimators()[name], train, test, X_COLS, "is_significant")
        return scored.select("_guid", "is_significant", F.col("prediction").cast("int").alias("prediction"))

    return run


query("m2_gradient_boosting")(single_model("gradient_boosting"))
query("m2_logistic_regression")(single_model("logistic_regression"))
query("m2_random_forest")(single_model("random_forest"))
query("m3_decision_tree")(single_model("decision_tree"))
query("m4_linear_svc")(single_model("linear_svc"))


@query("m1_hash_split", f"WITH {LABELLED_SQL} SELECT _guid, significance, true AS once FROM labelled")
def m1(spark, sf):
    """Both parts together hold every row once."""
    rows = labelled(spark, sf).select("_guid", "significance")
    train, test = M.hash_split(rows, "_guid")
    return train.unionByName(test).groupBy("_guid", "significance").agg((F.count("*") == 1).alias("once"))


@query("m1_random_split", f"WITH {LABELLED_SQL} SELECT _guid, significance, true AS once FROM labelled")
def m1_random(spark, sf):
    train, test = M.random_split(labelled(spark, sf).select("_guid", "significance"), seed=7)
    return train.unionByName(test).groupBy("_guid", "significance").agg((F.count("*") == 1).alias("once"))


@query("m5_adaboost")
def m5(spark, sf):
    train, test = M.hash_split(training_rows(spark, sf), "_guid")
    _, scored = M.fit_predict(M.AdaBoost(), train, test, X_COLS, "is_significant")
    return scored.select("_guid", "is_significant", F.col("prediction").cast("int").alias("prediction"))


SIMILAR = """
pairs AS (SELECT a.vec_id AS test_id, b.vec_id AS train_id, b.label,
  round(list_cosine_similarity(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 12) AS similarity
  FROM embeddings a, embeddings b),
nearest AS (SELECT *, row_number() OVER (PARTITION BY test_id ORDER BY similarity DESC, train_id) AS rank
            FROM pairs QUALIFY rank <= 3)
"""


def vectors(spark, sf):
    rows = table(spark, sf, "embeddings")
    return (rows.select(F.col("vec_id").alias("train_id"), F.col("embedding").alias("vector"), "label"),
            rows.select(F.col("vec_id").alias("test_id"), F.col("embedding").alias("vector")))


@query("m6_cosine_knn", f"""WITH {SIMILAR}, votes AS (SELECT test_id, label, count(*) AS n FROM nearest GROUP BY ALL)
SELECT test_id, label AS prediction FROM votes
QUALIFY row_number() OVER (PARTITION BY test_id ORDER BY n DESC, label) = 1""")
def m6(spark, sf):
    """Every vector predicted from all vectors, itself included."""
    train, test = vectors(spark, sf)
    return cosine_knn(train, test, 3)


@query("m6_neighbours", f"""WITH {SIMILAR}
SELECT test_id, CAST(rank AS INTEGER) AS rank, train_id, round(similarity, 6) AS similarity FROM nearest""")
def m6_neighbours(spark, sf):
    train, test = vectors(spark, sf)
    return neighbours(train, test, 3).select("test_id", "rank", "train_id", F.round("similarity", 6).alias("similarity"))


@query("m7_fit_and_score")
def m7(spark, sf):
    train, test = M.hash_split(training_rows(spark, sf), "_guid")
    _, scored = M.fit_predict(M.estimators()["decision_tree"], train, test, X_COLS, "is_significant")
    return M.accuracy_f1(scored, "is_significant")


GUESSES = """
guesses AS (SELECT doc_id, significance, CASE WHEN significance = 0 THEN 0 ELSE 1 END AS is_significant,
  CASE WHEN length(body) < 1000 THEN 0 WHEN length(body) < 3000 THEN 1 ELSE 2 END AS guess
  FROM (SELECT _id AS doc_id, significance, body FROM labelled))
"""


def guesses(spark, sf):
    """Labels with a guess made of the text length."""
    rows = binary_labels(labelled(spark, sf))
    length = F.length("body")
    guess = F.when(length < 1000, 0).when(length < 3000, 1).otherwise(2)
    return rows.select(F.col("_id").alias("doc_id"), "significance", "is_significant", guess.alias("guess"))


@query("m8_accuracy_f1", f"""WITH {LABELLED_SQL}, {GUESSES}, b AS (
  SELECT is_significant AS y, CASE WHEN guess > 0 THEN 1 ELSE 0 END AS p FROM guesses)
SELECT round(avg(CASE WHEN y = p THEN 1.0 ELSE 0.0 END), 6) AS accuracy,
  round(2.0 * count(*) FILTER (y = 1 AND p = 1) / (count(*) FILTER (y = 1) + count(*) FILTER (p = 1)), 6) AS f1
FROM b""")
def m8(spark, sf):
    rows = guesses(spark, sf).withColumn("prediction", (F.col("guess") > 0).cast("int"))
    scored = M.accuracy_f1(rows, "is_significant")
    return scored.select(F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))


@query("m8_weighted_f1", f"""WITH {LABELLED_SQL}, {GUESSES},
c AS (SELECT k, count(*) FILTER (significance = k) AS support, count(*) FILTER (guess = k) AS guessed,
  count(*) FILTER (significance = k AND guess = k) AS hits FROM guesses, (SELECT unnest([0, 1, 2]) AS k) GROUP BY k)
SELECT round(sum(hits) / sum(support), 6) AS accuracy,
  round(sum(support * 2.0 * hits / (support + guessed)) / sum(support), 6) AS f1 FROM c""")
def m8_weighted(spark, sf):
    scored = M.accuracy_f1(guesses(spark, sf), "significance", "guess", "weighted")
    return scored.select(F.round("accuracy", 6).alias("accuracy"), F.round("f1", 6).alias("f1"))


@query("m9_cascade")
def m9(spark, sf):
    train, test = M.hash_split(training_rows(spark, sf), "_guid")
    result = M.cascade(train, test, M.estimators()["random_forest"], X_COLS)
    return M.cascade_predictions(result).select("_guid", "significance", "stage_1", "stage_2")


@query("f9_predicted_significant", f"""WITH {LABELLED_SQL}, {GUESSES}
SELECT doc_id, significance FROM guesses WHERE guess > 0""")
def f9(spark, sf):
    rows = guesses(spark, sf).withColumn("prediction", (F.col("guess") > 0).cast("int"))
    return M.predicted_significant(rows).select("doc_id", "significance")


@query("m10_three_class")
def m10(spark, sf):
    train, test = M.hash_split(training_rows(spark, sf), "_guid")
    scored = M.three_class(train, test, M.estimators()["linear_svc"], X_COLS)
    return scored.select("_guid", "significance", F.col("prediction").cast("int").alias("prediction"))


POINTS = """CASE WHEN guess = 0 THEN CASE significance WHEN 0 THEN 10 WHEN 1 THEN 3 ELSE -3 END
  WHEN guess = 2 THEN CASE significance WHEN 2 THEN 10 WHEN 1 THEN 3 ELSE -3 END
  ELSE CASE significance WHEN 1 THEN 10 ELSE 3 END END"""


def staged(spark, sf):
    return guesses(spark, sf).withColumns({
        "stage_1": (F.col("guess") > 0).cast("int"),
        "stage_2": F.when(F.col("guess") > 0, (F.col("guess") == 2).cast("int"))})


@query("m11_points", f"WITH {LABELLED_SQL}, {GUESSES} SELECT doc_id, {POINTS} AS points FROM guesses")
def m11(spark, sf):
    return M.points(staged(spark, sf)).select("doc_id", "points")


@query("a14_total_score", f"""WITH {LABELLED_SQL}, {GUESSES}
SELECT round(avg(CAST({POINTS} AS DOUBLE)), 6) AS score FROM guesses""")
def a14(spark, sf):
    return M.total_score(M.points(staged(spark, sf))).select(F.round("score", 6).alias("score"))
