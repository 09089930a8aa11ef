"""Label files, wide TF-IDF exports of labelled articles, and tables cleaned in place."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.functions.cleaning import clean_columns
from newsfeat.functions.tokens import STOP_WORDS
from newsfeat.operators.corpus import BI_GRAM_CORPUS_SIZE, TOKEN_CORPUS_SIZE
from newsfeat.operators.joins import attach_labels, mark_split
from newsfeat.operators.tfidf import (expand_columns, named_weights, observed_terms, sparse_for, term_list, term_places,
                                      tfidf_from_counts, tfidf_from_text)
from newsfeat.session import stored
from newsfeat.sources.sinks import replace_table


def clean_table(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """Remove tags from text columns of the table at `path`, which is replaced; the other columns and nulls stay."""
    replace_table(clean_columns(spark.read.parquet(path), columns), path)
    return spark.read.parquet(path)


def label_news(articles: DataFrame, labels: DataFrame) -> DataFrame:
    """guid, significance of every article; '' where no label is known."""
    return attach_labels(articles.select("guid"), labels, "guid", "significance").select("guid", "significance")


def with_row_id(df: DataFrame) -> DataFrame:
    """Store the rows with a unique `row_id`, since ids of articles may repeat."""
    return stored(df.withColumn("row_id", F.monotonically_increasing_id()), "rows")


def token_weights(labelled: DataFrame, records: DataFrame, vocabulary: DataFrame, test_ids: DataFrame,
                  n: int | Column = TOKEN_CORPUS_SIZE) -> tuple[DataFrame, DataFrame]:
    """Labelled rows with `split` and sparse `weights`, and the places (term, place) of the observed tokens.

    Weights come from stored counts by (_data_source, _id).
    """
    rows = with_row_id(labelled.select("_data_source", "_id", "_guid", "significance", "title"))
    keys = rows.select("_data_source", "_id", "row_id")
    weights = stored(tfidf_from_counts(keys, records, vocabulary, n), "token-weights")
    places = term_places(observed_terms(weights))
    return mark_split(sparse_for(rows, weights, "row_id", places), test_ids, "_guid").drop("row_id"), places


def token_export(labelled: DataFrame, records: DataFrame, vocabulary: DataFrame, test_ids: DataFrame,
                 n: int | Column = TOKEN_CORPUS_SIZE, terms: list[str] | None = None) -> DataFrame:
    """Labelled rows with their `split` and one column per named term; without names, per observed token."""
    rows, places = token_weights(labelled, records, vocabulary, test_ids, n)
    return term_columns(rows, places, terms)


def bi_gram_weights(labelled: DataFrame, vocabulary: DataFrame, test_ids: DataFrame,
                    n: int | Column = BI_GRAM_CORPUS_SIZE, stem: bool = True,
                    stop_words: list[str] = STOP_WORDS) -> tuple[DataFrame, DataFrame]:
    """Labelled ids with `split` and sparse `weights`, and the places of the vocabulary's bi-grams."""
    rows, places = with_row_id(labelled.select("_guid", "body")), term_places(vocabulary)
    weights = tfidf_from_text(rows, ["row_id"], vocabulary, n, "body", 2, stem=stem, stop_words=stop_words)
    wide = sparse_for(rows.select("_guid", "row_id"), weights, "row_id", places)
    return mark_split(wide, test_ids, "_guid").drop("row_id"), places


def bi_gram_export(labelled: DataFrame, vocabulary: DataFrame, test_ids: DataFrame,
                   n: int | Column = BI_GRAM_CORPUS_SIZE, stem: bool = True,
                   stop_words: list[str] = STOP_WORDS, terms: list[str] | None = None) -> DataFrame:
    """Labelled ids with their `split` and one column per named bi-gram; without names, per bi-gram of the vocabulary."""
    return term_columns(*bi_gram_weights(labelled, vocabulary, test_ids, n, stem, stop_words), terms)


def term_columns(rows: DataFrame, places: DataFrame, terms: list[str] | None = None) -> DataFrame:
    """Sparse rows with a column per named term; naming none asks for all, whose names the driver then holds."""
    terms = term_list(places) if terms is None else terms
    return expand_columns(named_weights(rows, places, terms), terms)
