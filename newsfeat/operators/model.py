"""Splits, classifiers, the two-stage cascade and its scores."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (DecisionTreeClassificationModel, DecisionTreeClassifier, GBTClassifier,
                                       LinearSVC, LogisticRegression, OneVsRest, RandomForestClassifier)
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfeat.session import stored

# Points of a row by stage, prediction and real significance.
STAGE_1_NEGATIVE = {0: 10, 1: 3, "other": -3}
STAGE_2_POSITIVE = {2: 10, 1: 3, "other": -3}
STAGE_2_NEGATIVE = {1: 10, "other": 3}


def hash_split(df: DataFrame, key: str, share: float = 0.8, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(train, test) by a hash of the key: repeatable, and no row order involved."""
    place = F.pmod(F.xxhash64(F.col(f"`{key}`"), F.lit(seed)), F.lit(10_000))
    cut = round(share * 10_000)
    return df.where(place < cut), df.where(place >= cut)


def random_split(df: DataFrame, share: float = 0.8, seed: int | None = None) -> tuple[DataFrame, DataFrame]:
    train, test = df.randomSplit([share, 1 - share], seed)
    return train, test


def estimators(forest_depth: int = 30) -> dict[str, Estimator]:
    """The single-model classifiers, on columns `features` and `label`.

    The original's forest has no depth limit; `forest_depth` is Spark's maximum unless the caller sets less.
    """
    return {
        "gradient_boosting": GBTClassifier(maxIter=100, maxDepth=3, stepSize=0.1, seed=0),
        "logistic_regression": LogisticRegression(),
        "decision_tree": DecisionTreeClassifier(impurity="entropy", maxDepth=8, seed=0),
        "random_forest": RandomForestClassifier(numTrees=10, maxDepth=forest_depth, seed=0),
        "linear_svc": LinearSVC(maxIter=50, regParam=0.01),
    }


def assemble(df: DataFrame, x_cols: list[str], y_col: str) -> DataFrame:
    """Add `features` and `label`. Dotted column names are escaped through plain aliases."""
    plain = {c: f"__x{i}" for i, c in enumerate(x_cols)}
    df = df.withColumns({new: F.col(f"`{c}`").cast("double") for c, new in plain.items()})
    vectors = VectorAssembler(inputCols=list(plain.values()), outputCol="features").transform(df)
    return vectors.drop(*plain.values()).withColumn("label", F.col(f"`{y_col}`").cast("double"))


def fit_predict(estimator: Estimator, train: DataFrame, test: DataFrame, x_cols: list[str],
                y_col: str) -> tuple[Model, DataFrame]:
    """Fit on `train`; `test` with a `prediction` column."""
    model = estimator.fit(assemble(train, x_cols, y_col))
    return model, predict(model, test, x_cols, y_col)


def predict(model: Model, df: DataFrame, x_cols: list[str], y_col: str) -> DataFrame:
    scored = model.transform(assemble(df, x_cols, y_col))
    return scored.select(*[F.col(f"`{c}`") for c in df.columns], "prediction")


def accuracy_f1(df: DataFrame, label: str, prediction: str = "prediction", average: str = "binary") -> DataFrame:
    """One row: accuracy and F1, of class 1 or weighted by the classes' support."""
    y, p = F.col(f"`{label}`").cast("int"), F.col(f"`{prediction}`").cast("int")
    if average == "binary":
        hits = F.count_if((y == 1) & (p == 1))
        return df.agg(
            F.avg((y == p).cast("double")).alias("accuracy"),
            F.coalesce(2 * hits / F.nullif(F.count_if(y == 1) + F.count_if(p == 1), F.lit(0)), F.lit(0.0)).alias("f1"))
    if average != "weighted":
        raise ValueError("average must be 'binary' or 'weighted'")
    cells = df.groupBy(y.alias("y"), p.alias("p")).agg(F.count("*").alias("n"))
    sides = cells.select("n", F.inline(F.array(
        F.struct(F.col("y").alias("c"), F.lit(1).alias("real"), (F.col("y") == F.col("p")).cast("int").alias("hit")),
        F.struct(F.col("p").alias("c"), F.lit(0).alias("real"), F.lit(0).alias("hit")))))
    classes = sides.groupBy("c").agg(
        F.sum(F.col("n") * F.col("real")).alias("support"), F.sum("n").alias("both"),
        F.sum(F.col("n") * F.col("hit")).alias("hits"))
    support = F.sum("support")
    return classes.agg(
        (F.sum("hits") / support).alias("accuracy"),
        (F.sum(F.col("support") * 2 * F.col("hits") / F.col("both")) / support).alias("f1"))


@dataclass
class Cascade:
    """Models and scored test rows of the two stages."""

    stage_1: Model
    stage_2: Model
    first: DataFrame
    second: DataFrame
    x_cols: list[str]


def predicted_significant(df: DataFrame) -> DataFrame:
    return df.where(F.col("prediction") == 1)


def cascade(train: DataFrame, test: DataFrame, estimator: Estimator, x_cols: list[str]) -> Cascade:
    """Stage 1 tells significant rows; stage 2 is fitted and scored on rows predicted so."""
    stage_1, first = fit_predict(estimator, train, test, x_cols, "is_significant")
    seen = predicted_significant(predict(stage_1, train, x_cols, "is_significant")).drop("prediction")
    stage_2, second = fit_predict(
        estimator, stored(seen, "cascade-train"), predicted_significant(first).drop("prediction"), x_cols,
        "is_very_significant")
    return Cascade(stage_1, stage_2, first, second, x_cols)


def cascade_predictions(result: Cascade) -> DataFrame:
    """All test rows with stage_1 and stage_2 predictions; stage_2 is null where not reached."""
    # Stage 2 judges the rows of stage 1 in place, so a key that repeats multiplies nothing.
    first = result.first.withColumn("stage_1", F.col("prediction").cast("int")).drop("prediction")
    both = predict(result.stage_2, first, result.x_cols, "is_very_significant")
    reached = F.when(F.col("stage_1") == 1, F.col("prediction").cast("int"))
    return both.withColumn("stage_2", reached).drop("prediction")


def three_class(train: DataFrame, test: DataFrame, estimator: Estimator, x_cols: list[str],
                y_col: str = "significance") -> DataFrame:
    """Predictions of a three-class model; binary-only estimators run one against the rest."""
    if isinstance(estimator, (GBTClassifier, LinearSVC)):
        estimator = OneVsRest(classifier=estimator)
    # One against the rest cannot carry dotted names, so other columns wait in a struct.
    rows = assemble(test, x_cols, y_col)
    names = [c for c in test.columns]
    packed = rows.select("features", F.struct(*[F.col(f"`{c}`").alias(c) for c in names]).alias("row"))
    model = estimator.fit(assemble(train, x_cols, y_col).select("features", "label"))
    return model.transform(packed).select("row.*", "prediction")


def _by_significance(real: Column, points: dict) -> Column:
    cases = [(k, v) for k, v in points.items() if k != "other"]
    expression = F.when(real == cases[0][0], cases[0][1])
    for value, worth in cases[1:]:
        expression = expression.when(real == value, worth)
    return expression.otherwise(points["other"])


def points(df: DataFrame, stage_1: str = "stage_1", stage_2: str = "stage_2",
           significance: str = "significance") -> DataFrame:
    """Add the points of each row; every row is scored by exactly one stage."""
    real = F.col(significance)
    second = F.when(F.col(stage_2) == 1, _by_significance(real, STAGE_2_POSITIVE)).otherwise(
        _by_significance(real, STAGE_2_NEGATIVE))
    return df.withColumn(
        "points", F.when(F.col(stage_1) == 0, _by_significance(real, STAGE_1_NEGATIVE)).otherwise(second))


def total_score(df: DataFrame) -> DataFrame:
    return df.agg(F.avg("points").alias("score"))


@dataclass
class BoostedTrees:
    """Weighted stumps; the class with the largest sum of weights is predicted."""

    trees: list[DecisionTreeClassificationModel]
    weights: list[float]
    classes: int

    def transform(self, df: DataFrame) -> DataFrame:
        names = []
        for i, tree in enumerate(self.trees):
            name = f"__vote{i}"
            votes = tree.copy()
            votes.setPredictionCol(name).setRawPredictionCol("").setProbabilityCol("")
            df = votes.transform(df)
            names.append(name)
        sums = [
            reduce(lambda a, b: a + b, [
                F.when(F.col(n) == c, w).otherwise(0.0) for n, w in zip(names, self.weights)])
            for c in range(self.classes)
        ]
        scores = F.array(*sums)
        best = (F.array_position(scores, F.array_max(scores)) - 1).cast("double")
        return df.withColumn("prediction", best).drop(*names)


class AdaBoost(Estimator):
    """SAMME boosting (Zhu et al., 2009) of depth-one trees.

    Each round is a weighted tree fit and one aggregate; the reweighted rows are written
    to the shared folder every few rounds so the plan stays short.
    """

    def __init__(self, rounds: int = 50, learning_rate: float = 1.0, max_depth: int = 1, store_every: int = 5):
        super().__init__()
        self.rounds, self.learning_rate = rounds, learning_rate
        self.max_depth, self.store_every = max_depth, store_every

    def _fit(self, dataset: DataFrame) -> BoostedTrees:
        rows = stored(dataset.select("features", "label").withColumn("w", F.lit(1.0)), "boosting")
        classes = int(rows.agg(F.max("label")).first()[0]) + 1
        trees, weights = [], []
        for i in range(self.rounds):
            learner = DecisionTreeClassifier(maxDepth=self.max_depth, weightCol="w", seed=i)
            tree = learner.fit(rows)
            missed = (F.col("prediction") != F.col("label")).cast("double")
            scored = tree.transform(rows)
            sums = scored.agg(F.sum(F.col("w") * missed).alias("miss"), F.sum("w").alias("all"), F.count("*").alias("n")).first()
            error = sums["miss"] / sums["all"]
            if error >= 1 - 1 / max(classes, 2):
                break
            if error <= 0:
                trees, weights = [*trees, tree], [*weights, 1.0]
                break
            alpha = self.learning_rate * (math.log((1 - error) / error) + math.log(max(classes, 2) - 1))
            trees, weights = [*trees, tree], [*weights, alpha]
            scale = float(sums["all"]) / sums["n"]
            rows = scored.select(
                "features", "label", (F.col("w") * F.exp(F.lit(alpha) * missed) / F.lit(scale)).alias("w"))
            if (i + 1) % self.store_every == 0:
                rows = stored(rows, "boosting")
        if not trees:
            raise ValueError("no tree is better than chance")
        return BoostedTrees(trees, weights, classes)
