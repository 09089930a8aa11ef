import pytest
from pyspark.sql import functions as F

from newsfeat.functions import cleaning as P
from newsfeat.functions import features as X


def one(spark, value, f):
    df = spark.createDataFrame([(value,)], "c string")
    return df.select(f(F.col("c")).alias("r")).first()["r"]


@pytest.mark.parametrize("f, value, want", [
    (P.sanitise, 'a\r\n\t"b"', "\"a   'b'\""),
    (P.ascii_replace, "né à", "n? ?"),
    (P.ascii_drop, "né à", "n "),
    (P.strip_tags, "a<P>b</P><p><A B><(A|B.)>c<>", "ab</P><p><A B>c"),
    (P.strip_tags, None, None),
    (P.tags_changed, "a<P>", True),
    (P.tags_changed, "a<p>", False),
    (P.tags_changed, None, False),
    (P.unquote, ' "x" ', "x"),
    (P.unquote, '""  x ""', "x"),
    (P.unlist, "[u'House', u'B']", "Hose B"),
    (P.flatten_list_literal, "[u'A1', u'B']", "A1 B"),
    (P.flatten_list_literal, "'[u'A']'", "A"),
    (P.flatten_list_literal, "['unit', 'x']", "nit x"),
    (P.flatten_list_literal, "[unit, u'x']", "nit x"),
    (P.flatten_list_literal, "['a', upper']", "a pper"),
    (P.flatten_list_literal, "[]", ""),
    (P.flatten_list_literal, "'plain'", "plain"),
    (P.join_list, '["a", "b"]', "a b"),
    (P.join_list, "[not json", "[not json"),
    (P.join_list, "5", "5"),
    (P.with_default, None, "NULL"),
    (lambda c: P.to_unix_seconds(c, "xml"), "20150501001753", "1430439473"),
    (lambda c: P.to_unix_seconds(c, "xml"), "20150501001753.0", "1430439473"),
    (lambda c: P.to_unix_seconds(c, "json"), "2015-05-01T00:17:53.123", "1430439473"),
    (lambda c: P.to_unix_seconds(c, "json"), "yesterday", None),
    (lambda c: X.count_feature(c, " "), "", 1),
    (lambda c: X.count_feature(c, " "), None, 0),
    (lambda c: X.count_feature(c, " "), "a  b ", 4),
    (lambda c: X.count_feature(c, "."), "a.b", 2),
    (X.count_feature, "héé", 3),
    (lambda c: X.shorten(c, 3), "abc", "abc"),
    (lambda c: X.shorten(c, 3), "abcd", "abc..."),
    (lambda c: X.hour_of(c, "UTC"), "1430439473", 0),
    (lambda c: X.hour_of(c, "America/New_York"), "1430439473", 20),
    (lambda c: F.round(X.pattern_count(c, "numeric.percent"), 6), "3.5 % 4% 5.%", round(3 * 0.9554014, 6)),
    (lambda c: F.round(X.pattern_count(c, "numeric.dollar.illi"), 6), "$3 million $4\nmillion", 1.264652),
    (lambda c: F.round(X.pattern_count(c, "numeric.comma"), 6), "1,2 a3,4 $5,6", 0.858348),
])
def test_cell(spark, f, value, want):
    assert one(spark, value, f) == want


def test_unknown_feed_is_refused(spark):
    with pytest.raises(ValueError):
        P.to_unix_seconds(F.lit("x"), "csv")


def test_labels_of_missing_significance(spark):
    df = spark.createDataFrame([(0,), (1,), (2,), (None,)], "significance int")
    rows = [tuple(r) for r in X.binary_labels(df).collect()]
    assert rows == [(0, 0, 0), (1, 1, 0), (2, 1, 1), (None, 1, 0)]


def test_zscore_uses_the_sample_deviation(spark):
    df = spark.createDataFrame([(1.0,), (3.0,)], "`story.length` double")
    got = sorted(r[0] for r in X.zscore_fit(df, ["story.length"]).collect())
    assert got == pytest.approx([-0.70710678, 0.70710678])


def test_final_columns_are_renamed_and_dropped(spark):
    names = ["guid", "journal code", "source", "story date", "RICs", "person perm ids", "OA perm ids", "RCS",
             "title", "lead parag", "story body", "body"]
    df = spark.createDataFrame([tuple("x" for _ in names)], ", ".join(f"`{n}` string" for n in names))
    assert X.final_columns(df).columns == [
        "guid", "journal.code", "date.time", "organizations.codes", "topics.codes", "story.title", "story.body"]


def test_feature_selection_keeps_frame_order(spark):
    df = spark.createDataFrame([(1, 2, 3, 4)], "b int, hour int, a int, significance int")
    assert X.select_features(df, ["a", "b", "significance"]) == ["b", "hour", "a"]
    other = spark.createDataFrame([(1,)], "a int")
    assert [r[0] for r in X.schema_diff(spark, df, other).collect()] == ["b", "hour", "significance"]
