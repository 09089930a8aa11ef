"""Queries with SQL agree with it on the smallest tables.

A few queries of each kind run by default, all of them with NEWSFEAT_SQL=all.
"""

import os
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as entry
from compare import TABLES, rows

SF = "/root/testdata/sf0.001"
USUAL = ["a2_nested_counts", "a4_document_frequency", "f8_split_by_ids", "j8_attach_labels", "k2_raw_csv",
         "l1_score_news", "l4_training_table", "l9_bi_gram_vocabulary", "m6_cosine_knn", "n1_lead_sentiment",
         "p13_pattern_counts", "s1_xml_files", "t1_tokenize", "top_tokens", "w4_tfidf_from_counts"]
NAMES = sorted(entry.oracle_sql()) if os.environ.get("NEWSFEAT_SQL") == "all" else USUAL
pytestmark = pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return connection


def test_entry_has_rows(spark):
    assert entry.entry(spark).count() > 0


def test_sql_only_for_known_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, db, name):
    df = entry.queries()[name](spark, SF)
    result = db.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, df.collect()) == rows(columns, result.fetchall())
