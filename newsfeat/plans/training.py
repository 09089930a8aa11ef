"""The training table: feature tables joined with the labelled articles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.functions.features import add_field, binary_labels, count_feature, hour_of
from newsfeat.operators.joins import drop_nulls, merge_on
from newsfeat.operators.sentiment import rule_sentiment
from newsfeat.session import stored

# Counted columns of the labelled table, columns dropped from each feature
# table, columns dropped from the result, and the length of text scored for sentiment.
COUNTED = {"orgs": "org_count", "body": "story_word_count", "topics": "topics_count", "title": "title_word_count"}
DROP_TOKENS, DROP_BI_GRAMS, DROP_TOPICS = ["title"], ["source.significance"], ["topics"]
DROP_FINAL = [
    "_data_source", "_id", "title", "Unnamed: 0", "source.significance", "orgs", "body", "date.time",
    "journal.code", "organizations", "persons",
]
SENTIMENT_CHARACTERS = 500


def original_columns(labelled: DataFrame) -> DataFrame:
    """_guid, orgs, body, topics, title and their word counts."""
    df = labelled.select("_guid", "orgs", "body", "topics", "title")
    for field, new in COUNTED.items():
        df = add_field(df, field, new, lambda c: count_feature(c, " "))
    return df


def add_features(df: DataFrame, lexicon: DataFrame, zone: str | None = None) -> DataFrame:
    """Binary labels, hour of `date.time`, and sentiment of the body's first characters."""
    df = binary_labels(df)
    df = add_field(df, "date.time", "hour", lambda c: hour_of(c, zone))
    # An article id may repeat: rows are scored by an id of their own, fixed by writing them.
    df = stored(df.withColumn("__row", F.monotonically_increasing_id()), "features")
    scores = rule_sentiment(df.select("__row", "body"), "__row", "body", lexicon, SENTIMENT_CHARACTERS)
    scores = scores.withColumnsRenamed({c: f"sentiment_{c}" for c in ("pos", "neg", "neu", "compound")})
    # Both sides have one row per key, so the join cannot be skewed.
    return df.join(scores, "__row", "left").drop("__row")


def training_table(tokens: DataFrame, labelled: DataFrame, bi_grams: DataFrame, topics: DataFrame,
                   lexicon: DataFrame, zone: str | None = None) -> DataFrame:
    """Inner join of the feature tables on `_guid`, with derived features, ready for training."""
    frames = [
        tokens.drop(*DROP_TOKENS),
        original_columns(labelled).drop("topics"),
        bi_grams.drop(*DROP_BI_GRAMS),
        topics.drop(*DROP_TOPICS),
    ]
    return add_features(merge_on(frames, "_guid", derived=True), lexicon, zone=zone).drop(*DROP_FINAL)


def training_rows(df: DataFrame, x_cols: list[str], y_cols: list[str]) -> DataFrame:
    """Chosen columns of rows without any null."""
    columns = [*x_cols, *y_cols]
    return drop_nulls(df.select(*[F.col(f"`{c}`") for c in columns]), columns)
