"""Features of new articles, ready to be written as the scored table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.functions.cleaning import lead_and_body
from newsfeat.functions.features import count_columns, final_columns, pattern_columns, zscore_frozen
from newsfeat.functions.tokens import STOP_WORDS
from newsfeat.operators.corpus import BI_GRAM_CORPUS_SIZE, TOKEN_CORPUS_SIZE
from newsfeat.operators.sentiment import rule_sentiment
from newsfeat.operators.tfidf import combined_weights, sparse_for, term_places
from newsfeat.plans.exports import term_columns
from newsfeat.session import stored
from newsfeat.sources.readers import read_news
from newsfeat.sources.sinks import write_quoted

SENTIMENT_CHARACTERS = 200


def score_weights(articles: DataFrame, token_vocabulary: DataFrame, bi_gram_vocabulary: DataFrame,
                  lexicon: DataFrame, n_tokens: int | Column = TOKEN_CORPUS_SIZE,
                  n_bi_grams: int | Column = BI_GRAM_CORPUS_SIZE, stem: bool = True,
                  stop_words: list[str] = STOP_WORDS) -> tuple[DataFrame, DataFrame]:
    """Features of articles with sparse `weights`, and the places (term, place) of the terms, tokens first.

    The lead paragraph stands before the story twice in the text that is counted and
    weighted.

    Parsed articles are stored once with a row id: guids may repeat, row ids do not, so
    every grouping and join below is on a key that cannot be hot.
    """
    rows = articles.withColumn("row_id", F.monotonically_increasing_id())
    rows = rows.withColumn("story body", lead_and_body(F.col("lead parag"), F.col("story body")))
    rows = stored(rows, "articles").withColumn("body", lead_and_body(F.col("lead parag"), F.col("story body")))

    scores = rule_sentiment(rows, "row_id", "story body", lexicon, SENTIMENT_CHARACTERS)
    scores = scores.select("row_id", *[F.col(c).alias(f"sentiment_{c}") for c in ("pos", "neg", "neu", "compound")])

    weights = combined_weights(rows, ["row_id"], token_vocabulary, n_tokens, bi_gram_vocabulary, n_bi_grams,
                               stem=stem, stop_words=stop_words)
    places = term_places(token_vocabulary, bi_gram_vocabulary)
    # only what is shown later goes beside the weights: the long texts are cut or dropped first
    features = final_columns(pattern_columns(count_columns(rows)).join(scores, "row_id", "left"))
    return zscore_frozen(sparse_for(features, weights, "row_id", places)).drop("row_id"), places


def score_news(articles: DataFrame, token_vocabulary: DataFrame, bi_gram_vocabulary: DataFrame,
               lexicon: DataFrame, terms: list[str] | None = None, **options) -> DataFrame:
    """Article table to one row of features per article, with one column per named term; without names, per term."""
    return term_columns(*score_weights(articles, token_vocabulary, bi_gram_vocabulary, lexicon, **options), terms)


def score_files(spark: SparkSession, source: str, target: str, token_vocabulary: DataFrame, bi_gram_vocabulary: DataFrame,
                lexicon: DataFrame, sep: str = ",", terms: list[str] | None = None, **options) -> None:
    """A news file or a folder of them to the scored CSV, every cell quoted."""
    scored = score_news(read_news(spark, source), token_vocabulary, bi_gram_vocabulary, lexicon, terms, **options)
    write_quoted(scored, target, sep)
