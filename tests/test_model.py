from collections import Counter

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsfeat.operators import knn
from newsfeat.operators import model as M
from newsfeat.operators.knn import cosine_knn, neighbours


def nearest(train, test, k):
    def unit(v):
        n = np.linalg.norm(v)
        return v / n if n else v
    out = {}
    for t, v in test:
        ranked = sorted(((-round(float(unit(v) @ unit(w)), 12), i, y) for i, w, y in train))[:k]
        votes = Counter(y for _, _, y in ranked)
        out[t] = ([i for _, i, _ in ranked], min(votes, key=lambda y: (-votes[y], y)))
    return out


@pytest.mark.parametrize("pivots, block_rows", [(4, 7), (8, 1000), (1, 16)])
def test_neighbours_match_brute_force(spark, pivots, block_rows):
    """A third of the train vectors are copies of one; some vectors are zero."""
    rng = np.random.default_rng(2)
    vectors = rng.normal(size=(60, 3))
    vectors[:20] = vectors[0]
    vectors[20] = 0
    train = [(i, vectors[i], i % 3) for i in range(60)]
    test = [(100 + i, v) for i, v in enumerate(np.vstack([rng.normal(size=(15, 3)), vectors[:2], np.zeros((1, 3))]))]
    train_df = spark.createDataFrame([(i, [float(x) for x in v], y) for i, v, y in train],
                                     "train_id bigint, vector array<double>, label int")
    test_df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in test], "test_id bigint, vector array<double>")
    want = nearest(train, test, 3)
    found = neighbours(train_df, test_df, 3, pivots, block_rows).orderBy("test_id", "rank").collect()
    got = {}
    for r in found:
        got.setdefault(r["test_id"], []).append(r["train_id"])
    assert got == {t: ids for t, (ids, _) in want.items()}
    votes = {r["test_id"]: r["prediction"] for r in cosine_knn(train_df, test_df, 3, pivots, block_rows).collect()}
    assert votes == {t: y for t, (_, y) in want.items()}


def test_many_blocks_are_joined_without_copies_of_vectors(spark, capsys):
    """Copies of one vector, missing labels and ids that come twice; no exchange has a vector a visit."""
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(1500, 8)).astype(np.float32)
    vectors[::9] = vectors[0]
    ids = np.arange(1500) % 1400
    label = [None if i % 7 == 0 else int(i % 4) for i in ids]
    rows = [(int(i), [float(x) for x in v], y) for i, v, y in zip(ids, vectors, label)]
    train = spark.createDataFrame(rows, "train_id bigint, vector array<float>, label int")
    test = train.select(F.col("train_id").alias("test_id"), "vector").where("test_id < 1000 AND test_id >= 100")
    found = neighbours(train, test, 3, 16, 100)
    found.explain()
    plan = capsys.readouterr().out
    assert "CartesianProduct" in plan and "CoGroup" not in plan and "Generate" not in plan
    units = vectors.astype(float) / np.linalg.norm(vectors.astype(float), axis=1, keepdims=True)
    similarity = np.round(units @ units.T, 12)
    got = {}
    for r in found.orderBy("test_id", "rank").collect():
        got.setdefault(r["test_id"], []).append((round(r["similarity"], 9), r["train_id"], r["label"]))
    assert len(got) == 900
    for i, some in got.items():
        best = np.lexsort((ids, -similarity[i]))[:3]
        assert some == [(round(similarity[i][j], 9), ids[j], label[j]) for j in best]


def test_fewer_train_rows_than_k(spark):
    train = spark.createDataFrame([(1, [1.0, 0.0], 5)], "train_id bigint, vector array<double>, label int")
    test = spark.createDataFrame([(7, [0.0, 1.0])], "test_id bigint, vector array<double>")
    assert [tuple(r) for r in cosine_knn(train, test, 3).collect()] == [(7, 5)]


@pytest.fixture(scope="module")
def rows(spark):
    data = [(str(i), float(i % 10), float(i % 7), [0, 0, 0, 0, 1, 1, 1, 2, 2, 2][i % 10]) for i in range(200)]
    df = spark.createDataFrame(data, "_guid string, `x.1` double, x2 double, significance int")
    return df.withColumns({"is_significant": (F.col("significance") > 0).cast("int"),
                           "is_very_significant": (F.col("significance") == 2).cast("int")}).cache()


X = ["x.1", "x2"]


def test_hash_split_is_repeatable(rows):
    train, test = M.hash_split(rows, "_guid")
    again, _ = M.hash_split(rows.repartition(3), "_guid")
    assert sorted(train.toPandas()["_guid"]) == sorted(again.toPandas()["_guid"])
    assert train.count() + test.count() == 200 and 130 < train.count() < 190


def test_boosting_beats_a_single_stump(rows):
    """The middle third of x is the positive class: one stump cannot tell it, many can."""
    df = rows.withColumn("mid", F.col("`x.1`").between(3, 6).cast("int"))
    _, scored = M.fit_predict(M.AdaBoost(rounds=8, store_every=3), df, df, X, "mid")
    assert M.accuracy_f1(scored, "mid").first()["accuracy"] > 0.95
    _, one = M.fit_predict(M.AdaBoost(rounds=1), df, df, X, "mid")
    assert M.accuracy_f1(one, "mid").first()["accuracy"] < 0.9


def test_cascade_scores_each_row_once(rows):
    result = M.cascade(rows, rows, M.estimators()["decision_tree"], X)
    scored = M.points(M.cascade_predictions(result))
    assert scored.count() == 200
    assert scored.where("stage_1 = 0 AND stage_2 IS NOT NULL").count() == 0
    assert M.total_score(scored).first()["score"] == pytest.approx(10.0)


@pytest.mark.parametrize("estimator", [
    lambda: M.estimators()["decision_tree"], lambda: M.GBTClassifier(maxIter=2, maxDepth=2)])
def test_three_classes(rows, estimator):
    scored = M.three_class(rows, rows, estimator(), X)
    assert scored.columns == [*rows.columns, "prediction"]
    result = M.accuracy_f1(scored, "significance", average="weighted").first()
    assert result["accuracy"] > 0.6


def test_scores_by_hand(spark):
    df = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (1, 1), (2, 0)], "y int, prediction int")
    binary = M.accuracy_f1(df.where("y < 2"), "y").first()
    assert (binary["accuracy"], binary["f1"]) == pytest.approx((0.75, 0.8))
    weighted = M.accuracy_f1(df, "y", average="weighted").first()
    assert weighted["accuracy"] == pytest.approx(0.6)
    assert weighted["f1"] == pytest.approx((2 * 0.5 + 2 * 0.8 + 0) / 5)
    none = spark.createDataFrame([(0, 0)], "y int, prediction int")
    assert M.accuracy_f1(none, "y").first()["f1"] == 0


def test_points_table(spark):
    cases = [(0, None, 0, 10), (0, None, 1, 3), (0, None, 2, -3), (1, 1, 2, 10), (1, 1, 1, 3), (1, 1, 0, -3),
             (1, 0, 1, 10), (1, 0, 0, 3), (1, 0, 2, 3)]
    df = spark.createDataFrame(cases, "stage_1 int, stage_2 int, significance int, want int")
    assert M.points(df).where("points <> want").count() == 0


def test_forest_depth_is_a_parameter(spark):
    assert M.estimators()["random_forest"].getMaxDepth() == 30
    assert M.estimators(forest_depth=4)["random_forest"].getMaxDepth() == 4
    # 12 nested steps need more than ten levels
    df = spark.createDataFrame([(float(i), float(i % 2)) for i in range(3000)], "x double, label double")
    df = M.assemble(df.select("x", F.floor(F.log2(F.col("x") + 1)).alias("y"), "label"), ["x", "y"], "label")
    deep = M.estimators()["random_forest"].copy().setMaxBins(3000).setNumTrees(1).fit(df)
    assert deep.trees[0].depth > 10


def test_visits_of_a_batch_come_in_small_frames():
    """A batch that visits many cells is not turned into one frame with a vector a visit."""
    rng = np.random.default_rng(0)
    pivots = knn.unit_rows(pd.Series(list(rng.normal(size=(50, 4)))))
    vectors = rng.normal(size=(3000, 4))
    taken = []

    class Test:
        def mapInPandas(self, visit, schema):
            taken.append(visit)

    knn._visits(Test(), pivots, np.arange(50), np.full(50, 10), np.full(50, np.pi), 3)
    frames = list(taken[0](iter([pd.DataFrame({"test_id": np.arange(3000), "vector": list(vectors)})])))
    assert max(map(len, frames)) <= 5_000
    every = pd.concat(frames)
    assert len(every) == 150_000 and not every.duplicated(["test_id", "cell"]).any()
    units = knn.unit_rows(pd.Series(list(vectors)))
    assert np.array_equal(np.stack(every["unit"].to_list()), units[every["test_id"]])
