import math

import pytest
from pyspark.sql import functions as F

from newsfeat.functions.stem import stem
from newsfeat.operators import corpus as C
from newsfeat.plans import exports, scoring, training
from newsfeat.sources.readers import ARTICLE_COLUMNS


@pytest.fixture(scope="module")
def articles(spark):
    rows = [
        {"guid": "", "title": "Profits up", "lead parag": "Lead good", "story body": "profits rising 5 % profits"},
        {"guid": "", "title": "Other", "lead parag": "", "story body": "markets falling"},
        {"guid": "c", "title": "None", "lead parag": None, "story body": "lost"},
    ]
    filled = [tuple(r.get(c, "A B") for c in ARTICLE_COLUMNS) for r in rows]
    return spark.createDataFrame(filled, ", ".join(f"`{c}` string" for c in ARTICLE_COLUMNS))


def test_scoring_stems_and_keeps_repeated_guids(spark, articles):
    tokens = spark.createDataFrame([(stem("profits"), 5), ("title", 2)], "term string, df bigint")
    grams = spark.createDataFrame([("profit.rise", 3)], "term string, df bigint")
    lexicon = spark.createDataFrame([("good", 1.9)], "term string, valence double")
    scored = scoring.score_news(articles, tokens, grams, lexicon)
    rows = {r["story.title"]: r for r in scored.collect()}
    assert len(rows) == 3
    row = rows["Profits up"]
    assert row["profit"] == pytest.approx((1 + math.log(2)) * math.log(1 + 1337790 // 5))
    assert row["profit.rise"] == pytest.approx(math.log(1 + 178064 // 3))
    assert row["title"] == 0.0 and rows["Other"]["profit"] == 0.0
    assert row["story.body"] == "Lead good Lead good profits rising 5 % profits"
    assert row["sentiment_compound"] > 0 and row["story_word_count"] == 7
    assert row["numeric.percent"] == pytest.approx((0.9554014 - 8.182659) / 57.78209)
    # A missing lead makes the texts null, and its term columns 0.
    assert rows["None"]["story.body"] is None and rows["None"]["profit"] == 0.0
    assert "lead parag" not in scored.columns and "row_id" not in scored.columns


def test_label_file(spark, articles):
    labels = spark.createDataFrame([("c", "2", 0)], "guid string, significance string, pos int")
    got = sorted(tuple(r) for r in exports.label_news(articles, labels).collect())
    assert got == [("", ""), ("", ""), ("c", "2")]


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [("s", 1, "g1", 0, "T one", "o1 o2", "n1", "rates rise again", "1430439473"),
            ("s", 2, "g2", 2, "T two", "o1", "n1 n2", "rates rise", "1430443073"),
            ("t", 1, "g3", 1, "T", "", "", "nothing much", "1430443073")]
    return spark.createDataFrame(
        rows, "_data_source string, _id int, _guid string, significance int, title string, orgs string, "
              "topics string, body string, `date.time` string")


def test_exports_have_observed_columns_and_a_split(spark, labelled):
    docs = labelled.select(F.col("_data_source").alias("source_id"), F.col("_id").alias("doc_id"), "body")
    records = C.nested_counts(docs, stem=False)
    vocabulary = spark.createDataFrame([("rates", 2), ("rise", 2), ("unseen", 9)], "term string, df bigint")
    ids = spark.createDataFrame([("g2",)], "id string")
    wide = exports.token_export(labelled, records, vocabulary, ids, n=10)
    assert set(wide.columns) == {"_data_source", "_id", "_guid", "significance", "title", "split", "rates", "rise"}
    got = {r["_guid"]: (r["split"], round(r["rates"], 6)) for r in wide.collect()}
    value = round(math.log(1 + 10 // 2), 6)
    assert got == {"g1": ("train", value), "g2": ("test", value), "g3": ("train", 0.0)}
    grams = spark.createDataFrame([("rates.rise", 2)], "term string, df bigint")
    wide = exports.bi_gram_export(labelled, grams, ids, n=10, stem=False)
    assert {r["_guid"]: round(r["rates.rise"], 6) for r in wide.collect()} == {"g1": value, "g2": value, "g3": 0.0}


def test_training_table(spark, labelled):
    tokens = labelled.select("_data_source", "_id", "_guid", "significance", "title", F.col("`date.time`"),
                             F.lit(1.0).alias("rate"))
    grams = labelled.select("_guid", F.lit("x").alias("source.significance"), F.lit(2.0).alias("a.b")).where("_guid <> 'g3'")
    topics = labelled.select("_guid", "topics", F.lit(3.0).alias("n1"))
    lexicon = spark.createDataFrame([("rise", 2.0)], "term string, valence double")
    made = training.training_table(tokens, labelled, grams, topics, lexicon, zone="UTC")
    rows = {r["_guid"]: r for r in made.collect()}
    assert set(rows) == {"g1", "g2"}
    assert rows["g1"]["org_count"] == 2 and rows["g2"]["topics_count"] == 2 and rows["g2"]["hour"] == 1
    assert rows["g2"]["is_very_significant"] == 1 and rows["g1"]["is_significant"] == 0
    assert rows["g1"]["a.b"] == 2.0 and rows["g1"]["n1"] == 3.0 and rows["g1"]["sentiment_pos"] > 0
    assert not {"_data_source", "_id", "title", "orgs", "body", "topics", "date.time"} & set(made.columns)
    x = ["a.b", "rate", "hour"]
    assert training.training_rows(made, x, ["significance"]).columns == [*x, "significance"]


def test_row_features_accept_a_stream(spark, tmp_path, articles):
    """The row-wise path has no state, so a streaming frame takes it unchanged."""
    from newsfeat.functions.features import count_columns, final_columns, pattern_columns, zscore_frozen

    articles.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(articles.schema).parquet(str(tmp_path / "in"))

    def featured(df):
        return zscore_frozen(final_columns(pattern_columns(count_columns(df.withColumn("body", F.col("story body"))))))

    query = featured(stream).writeStream.format("memory").queryName("featured").outputMode("append").start()
    query.processAllAvailable()
    query.stop()
    assert sorted(map(str, spark.table("featured").collect())) == sorted(map(str, featured(articles).collect()))


def test_clean_table_in_place(spark, tmp_path):
    path = str(tmp_path / "articles")
    rows = [(1, "<P>one<BR> two", "<B>x", "<I>kept"), (2, None, "", None)]
    spark.createDataFrame(rows, "ID long, story string, `sub headline` string, other string").write.parquet(path)
    for _ in range(2):  # cleaning again changes nothing
        out = exports.clean_table(spark, path, ["story", "sub headline"])
        found = sorted(tuple(r) for r in spark.read.parquet(path).collect())
        assert found == sorted(tuple(r) for r in out.collect())
        assert [r[0] for r in found] == [1, 2] and found[1][1:] == (None, "", None) and found[0][3] == "<I>kept"
        assert found[0][1:3] == ("one two", "x")
