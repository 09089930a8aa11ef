"""Connected components of links by contraction: each round every node joins its smallest neighbour."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.session import stored


def components(links: DataFrame) -> DataFrame:
    """Links (a, b) -> (node, label) for every linked node; equal labels, and only they, are connected.

    The first round goes by id, later ones by a hash of it that changes with the round, so
    long chains shrink by a constant share. Counts are combined before the shuffle: a node with
    very many links is one small aggregate. Each round is written to the shared folder; the labels
    are put together at the end, where the sizes of the rounds add up to a small multiple of the first.
    """
    edges = stored(links.select("a", "b").where("a <> b"), "edges")
    steps, turn = [], 0
    while not edges.isEmpty():
        rank = (lambda c: F.col(c)) if turn == 0 else (lambda c: F.xxhash64(F.lit(turn), F.col(c)))  # noqa: B023
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        near = both.groupBy("a").agg(F.min(F.struct(rank("b").alias("r"), "b")).alias("near"))
        own = F.struct(rank("a").alias("r"), F.col("a").alias("b"))
        step = stored(near.select(F.col("a").alias("node"), F.least("near", own)["b"].alias("next")), "step")
        steps.append(step)
        left, right = step.toDF("a", "na"), step.toDF("b", "nb")
        moved = edges.join(left, "a").select("na", "b").distinct().join(right, "b").where("na <> nb")
        edges = stored(moved.select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct(),
                       "edges")
        turn += 1
    if not steps:
        return links.select(F.col("a").alias("node"), F.col("b").alias("label")).limit(0)
    labels = steps.pop().toDF("node", "label")
    while steps:  # from the last and smallest step back to the first
        labels = steps.pop().join(labels.toDF("next", "label"), "next", "left").select(
            "node", F.coalesce("label", "next").alias("label"))
    return stored(labels, "labels")


def extend(labels: DataFrame, links: DataFrame) -> DataFrame:
    """Labels of earlier links and of further ones: only the ends that are still apart are contracted."""
    la, lb = labels.toDF("a", "la"), labels.toDF("b", "lb")
    apart = links.select("a", "b").join(la, "a", "left").join(lb, "b", "left").select(
        F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).where("a <> b").distinct()
    fresh = components(apart)
    moved = labels.join(fresh.toDF("label", "now"), "label", "left").select(
        "node", F.coalesce("now", "label").alias("label"))
    return stored(moved.unionByName(fresh.join(labels, "node", "left_anti")), "labels")
