import random

import pytest
from pyspark.sql import functions as F

from newsfeat.operators import joins as J


@pytest.fixture(scope="module")
def sides(spark):
    """A third of the rows share one key, another third have none."""
    rng = random.Random(1)
    keys = ["hot"] * 40 + [None] * 40 + [f"k{rng.randrange(20)}" for _ in range(40)]
    big = spark.createDataFrame([(k, i) for i, k in enumerate(keys)], "k string, v int")
    small = spark.createDataFrame([(f"k{i}", i) for i in range(10)] + [("hot", 99), (None, 7)], "k string, w int")
    return big.cache(), small.cache()


def rows(df):
    return sorted(map(str, df.collect()))


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_sliced_join_equals_plain_join(sides, how):
    big, small = sides
    want = rows(big.join(small, "k", how))
    assert rows(J.lookup_join(big, small, "k", how)) == want
    sliced = J.lookup_join(big, small, "k", how, max_rows=0, hot_rows=5)
    assert rows(sliced) == want
    assert sliced.columns == big.join(small, "k", how).columns


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_key_only_frames_keep_their_repeats(sides, how):
    big, small = sides[0].select("k"), sides[1]
    want = big.join(small, "k", how)
    got = J.lookup_join(big, small, "k", how, max_rows=0, hot_rows=7)
    assert rows(got) == rows(want) and got.columns == want.columns


def test_repeats_of_a_key_are_dealt_in_slices(spark):
    big = spark.range(1000).selectExpr("'hot' AS k")
    small = spark.createDataFrame([("hot", 1)], "k string, w int")
    plan = J.lookup_join(big, small, "k", max_rows=0, hot_rows=100)
    assert plan.count() == 1000
    assert plan.withColumn("p", F.spark_partition_id()).groupBy("p").count().agg(F.max("count")).first()[0] < 1000


def test_slices_follow_the_size_of_the_key(sides):
    """40 hot rows make five slices of eight; the other keys stay whole, null keys scatter."""
    big, small = sides
    spread, (copied,) = J._spread(big, [small], ["k"], None, 8)
    assert 3 <= spread.where("k = 'hot'").select(J._SALT).distinct().count() <= 5
    assert copied.where("k = 'hot'").count() == 5
    assert spread.where("k LIKE 'k%'").select(J._SALT).distinct().count() == 1
    assert spread.where("k IS NULL").select(J._SALT).distinct().count() > 30


def test_only_measured_sides_are_broadcast(sides):
    big, small = sides
    assert J.fits(small) and not J.fits(small, max_rows=3) and not J.fits(small, max_bytes=20)


def test_merge_on_large_frames(spark, sides):
    big, small = sides
    third = small.select("k", F.col("w").alias("x"))
    want = rows(big.join(small, "k").join(third, "k"))
    assert rows(J.merge_on([big, small, third], "k")) == want
    assert rows(J.merge_on([big, small, third], "k", max_rows=0, hot_rows=5)) == want
    assert rows(J.merge_on([big, small, third], "k", max_rows=11)) == want


def test_last_label_wins_and_missing_is_empty(spark):
    articles = spark.createDataFrame([("a",), ("b",), ("c",)], "guid string")
    labels = spark.createDataFrame([("a", "1", 0), ("a", "2", 5), ("b", None, 1)], "guid string, significance string, pos int")
    got = {r["guid"]: r["significance"] for r in J.attach_labels(articles, labels).collect()}
    assert got == {"a": "2", "b": "", "c": ""}


def test_first_match(spark):
    df = spark.createDataFrame([(1, "x", 3), (1, "y", 2), (2, "z", 9)], "k int, v string, o int")
    assert {(r["k"], r["v"]) for r in J.first_match(df, ["k"], F.col("o")).collect()} == {(1, "y"), (2, "z")}


def test_split_holds_every_row_once(spark):
    df = spark.createDataFrame([(i, str(i % 4)) for i in range(20)] + [(20, None)], "v int, id string")
    ids = spark.createDataFrame([("1",), ("1",), ("3",)], "x string")
    train, test = J.split_by_ids(df, ids, "id")
    assert (train.count(), test.count()) == (11, 10)
    marked = J.mark_split(df, ids, "id").groupBy("split").count().collect()
    assert {r["split"]: r["count"] for r in marked} == {"train": 11, "test": 10}


def test_the_list_of_hot_keys_has_a_fixed_length(spark, monkeypatch):
    rows_of_key = spark.range(6000).selectExpr("cast(id % 60 AS string) AS k", "id % 2 AS part", "id")
    assert {(r["k"], r[J._SLICES]) for r in J.hot_keys(rows_of_key, ["k"], 50).collect()} == {(str(i), 2) for i in range(60)}
    assert J.hot_keys(rows_of_key, ["k"], 100) is None
    assert J.hot_keys(rows_of_key, ["k", "part"], 30).count() == 60
    assert J.hot_keys(rows_of_key.where("false"), ["k"], 1) is None
    monkeypatch.setattr(J, "HOT_KEYS", 7)
    assert J.hot_keys(rows_of_key, ["k"], 50).count() <= 7
    # a summary that cannot hold all keys still finds the one that matters, and the join is right without the others
    monkeypatch.setattr(J, "TRACKED_KEYS", 64)
    many = spark.range(40_000).selectExpr("if(id % 4 = 0, 'hot', cast(id AS string)) AS k", "id")
    assert [(r["k"], r[J._SLICES]) for r in J.hot_keys(many, ["k"], 2000).collect()] == [("hot", 5)]
    small = spark.createDataFrame([("hot", 1), ("7", 2)], "k string, w int")
    assert J.lookup_join(many, small, "k", max_rows=0, hot_rows=2000).count() == 10_001


def test_few_rows_without_a_partner_reach_the_exchange(spark):
    big = spark.range(20_000).selectExpr("id", "if(id % 100 = 7, null, id) AS k", "cast(id % 3 AS string) AS s")
    small = spark.range(0, 20_000, 40).selectExpr("id AS k", "id * 2 AS w")
    bitmap = J.key_bitmap(small, big, ["k"])
    marked = J.with_hit(big, bitmap, ["k"])
    hits = marked.where("__hit").count()
    assert 500 <= hits < 3000  # a bit may be another key's; the join takes these out
    assert marked.where("k IS NULL AND __hit").isEmpty() and marked.count() == 20_000
    for how in ("inner", "left_semi", "left_anti", "left"):
        got = J.lookup_join(big, small, "k", how, max_rows=0, hot_rows=1000)
        want = big.join(small, "k", how)
        assert rows(got) == rows(want) and got.columns == want.columns


def test_no_bitmap_where_it_could_err_or_say_nothing(spark, monkeypatch):
    big = spark.range(50).selectExpr("id AS k", "cast(id AS double) AS d", "1 AS v")
    narrow = spark.range(0, 50, 5).selectExpr("cast(id AS int) AS k", "cast(id AS double) AS d")
    assert J.key_bitmap(narrow, big, ["k"]) is None and J.key_bitmap(narrow, big, ["d"]) is None
    assert J.lookup_join(big, narrow.select("k"), "k", "left_semi", max_rows=0).count() == 10
    monkeypatch.setattr(J, "MAX_PAGES", 0)
    assert J.key_bitmap(big.select("k"), big, ["k"]) is None


def test_merge_on_measures_nothing(spark, sides, monkeypatch):
    big, small = sides
    monkeypatch.setattr(J, "fits", lambda *a, **k: pytest.fail("a frame was measured"))
    third = small.select("k", F.col("w").alias("x"))
    assert rows(J.merge_on([big, small, third], "k", hot_rows=5)) == rows(big.join(small, "k").join(third, "k"))


def test_a_derived_first_frame_is_computed_once(spark):
    rows = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            rows.add(batch.num_rows)
            yield batch

    first = spark.range(40).selectExpr("id % 8 AS k", "id AS a").mapInArrow(count, "k long, a long")
    other = spark.createDataFrame([(k, -k) for k in range(4)] + [(None, 1)], "k long, b long")
    got = J.merge_on([first, other], "k", derived=True).collect()
    assert rows.value == 40
    assert sorted(map(tuple, got)) == sorted((i % 8, i, -(i % 8)) for i in range(40) if i % 8 < 4)
