import json

import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsfeat.sources import readers as R
from newsfeat.sources import sinks as K

GOOD = """<n-document guid="g1"><n-metadata><metadata.block><md.dates><md.publisheddatetime>20150501001753</md.publisheddatetime>
</md.dates><md.descriptions><md.title>A &amp; B</md.title></md.descriptions></metadata.block></n-metadata>
<n-docbody><document><supplier-info><supplier-num nitf-regsrc="S1"/></supplier-info>
<pub-info><src-data><src-journal-code>J</src-journal-code></src-data></pub-info><indexing><extraction-terms>
<extr-company-block><a><ric norm="R1"/></a><ric norm="R2"/><norm-company oa-id="O1"/></extr-company-block>
<extr-person-block><person-perm-id>P1</person-perm-id></extr-person-block></extraction-terms>
<classification-terms><rcs-block><x><rcs>T:1</rcs></x><rcs>T:2</rcs></rcs-block></classification-terms></indexing>
<content><text type="lead-para"><p>Lead<b>bold</b>&lt;P&gt;</p></text><text type="body"><p>One</p><p>Two</p></text></content>
</document></n-docbody></n-document>"""
BAD = '<n-document guid="g2"><a>x</b></n-document>'


def test_xml_file_with_a_broken_record(spark, tmp_path):
    path = tmp_path / "news.xml"
    path.write_text(f'<?xml version="1.0"?><feed>{GOOD}\n{BAD}\n{GOOD.replace("g1", "g3")}</feed>')
    scanned = R.scan_xml(spark, str(path)).cache()
    assert R.reject_counts(scanned).first().asDict() == {"parsed": 3, "errors": 1}
    rows = R.read_xml(spark, str(path)).orderBy("guid").collect()
    assert [r["guid"] for r in rows] == ["g1", "g3"]
    assert rows[0].asDict() == {
        "guid": "g1", "journal code": "J", "source": "S1", "story date": "1430439473", "RICs": "R1 R2",
        "person perm ids": "P1", "OA perm ids": "O1", "RCS": "T:1 T:2", "title": "A & B",
        "lead parag": "Lead bold ", "story body": "One Two"}


def test_first_paragraph_is_the_first_only(spark):
    df = spark.createDataFrame([(GOOD,), (BAD,)], "xml string")
    rows = R.first_paragraph(df).orderBy("malformed").collect()
    assert [(r["malformed"], r["paragraph"]) for r in rows] == [(False, "Leadbold<P>"), (True, None)]


ARTICLE = {"scrollid": "s1", "sources": "X", "maindocdate": "2015-05-01T00:17:53.1", "hiorgid": ["A", "B"],
           "tn2": "N1", "subheadline": "T<P>", "data": "line<BR>\nend", "extra": 1}


def test_json_object_list_and_broken_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(json.dumps(ARTICLE, indent=2))
    (tmp_path / "b.json").write_text(json.dumps([{**ARTICLE, "scrollid": "s2"}, {"scrollid": "s3", "tn2": None}], indent=1))
    (tmp_path / "c.json").write_text('{"scrollid": "s4", ')
    scanned = R.scan_json(spark, str(tmp_path)).cache()
    assert R.reject_counts(scanned).first().asDict() == {"parsed": 4, "errors": 1}
    rows = {r["guid"]: r for r in R.read_json(spark, str(tmp_path)).collect()}
    assert set(rows) == {"s1", "s2", "s3"}
    assert rows["s1"].asDict() == {
        "guid": "s1", "journal code": "X", "source": "", "story date": "1430439473", "RICs": "", "person perm ids": "",
        "OA perm ids": "A B", "RCS": "N1", "title": "T", "lead parag": "", "story body": "line\nend"}
    assert rows["s3"]["RCS"] == "" and rows["s3"]["story date"] is None


def test_json_texts_match_json_files(spark):
    texts = [json.dumps(ARTICLE), json.dumps([ARTICLE, {"scrollid": "s2"}]), "{broken", None]
    df = spark.createDataFrame([(t,) for t in texts], "json string")
    rows = R.parse_json(df).collect()
    assert sorted((r["malformed"], r["guid"]) for r in rows) == [
        (False, "s1"), (False, "s1"), (False, "s2"), (True, ""), (True, "")]


def test_json_folder_ids_and_defaults(spark, tmp_path):
    (tmp_path / "doc7.en.json").write_text(json.dumps({**ARTICLE, "data": 'a\t"né"'}))
    row = R.read_json_folder(spark, str(tmp_path)).first().asDict()
    assert row["fileID"] == "doc7" and row["i2"] == "NULL" and row["hiorgid"] == "A B" and row["data"] == "a 'n?'"
    assert list(row) == ["fileID", *R.BULK_FIELDS]


def test_folder_of_all_formats(spark, tmp_path):
    (tmp_path / "a.xml").write_text(f"<feed>{GOOD}</feed>")
    (tmp_path / "b.txt").write_text(json.dumps(ARTICLE))
    (tmp_path / "NR_1.csv").write_text(
        "guid,journal code,source,story date time,RICs,person perm ids,OA perm ids,RCS,story title,story body,other\n"
        'n1,J,S,20150501001753,,,O,R,Ti<P>,"two\nlines ""q""",z\n')
    (tmp_path / "SWIFT_1.csv").write_text(
        "scrollid,sources,maindocdate,hiorgid,tn2,subheadline,data\n"
        "\"\"\" w1 \"\"\",X,2015-05-01T00:17:53,\"[u'A', u'B']\",\"[u'C']\",Sub,Body<P>\n")
    (tmp_path / "inner").mkdir()
    (tmp_path / "inner" / "c.xml").write_text(GOOD)
    rows = {r["guid"]: r for r in R.read_news(spark, str(tmp_path)).collect()}
    assert set(rows) == {"g1", "s1", "n1", "w1"}
    assert rows["n1"]["title"] == "Ti" and rows["n1"]["story body"] == 'two\nlines "q"' and rows["n1"]["lead parag"] == ""
    assert rows["w1"]["RICs"] == "A B" and rows["w1"]["RCS"] == "C" and rows["w1"]["story body"] == "Body"
    assert {r["story date"] for r in rows.values()} == {"1430439473"}
    assert R.read_news(spark, str(tmp_path / "a.xml")).count() == 1


@pytest.mark.parametrize("name", ["x.pdf", "x.xlsx", "noextension"])
def test_other_extensions_are_refused(spark, tmp_path, name):
    (tmp_path / name).write_text("x")
    with pytest.raises(ValueError):
        R.read_news(spark, str(tmp_path))


def test_sheet_exports_by_feed(spark, tmp_path):
    (tmp_path / "NR_a.csv").write_text("id,Significance Rating ,Unnamed: 2\n1,High,x\n")
    (tmp_path / "other.csv").write_text("id,Significance Rating,orgs\n2,Low,\"[u'A', u'é']\"\n")
    nsc = R.read_sheet_export(spark, str(tmp_path), "nsc")
    assert nsc.columns == ["id", "Significance"] and [tuple(r) for r in nsc.collect()] == [("1", "High")]
    swift = R.read_sheet_export(spark, str(tmp_path), "swift")
    assert [tuple(r) for r in swift.collect()] == [("2", "Low", "A ?")]


def test_feature_file_key_is_renamed(spark, tmp_path):
    (tmp_path / "t.csv").write_text("id\ttopics\tx.y\n1\ta\t0.5\n")
    df = R.read_features(spark, str(tmp_path / "t.csv"), "\t", "id")
    assert df.columns == ["_guid", "topics", "x.y"]


def test_label_feed(spark):
    feed = json.dumps([{"guid": {"guid": "a"}, "significance": 2}, {"guid": {"guid": "b"}, "significance": "x"}])
    rows = R.parse_labels(spark.createDataFrame([(feed,)], "json string")).collect()
    assert [(r["guid"], r["significance"], r["pos"]) for r in rows] == [("a", "2", 0), ("b", "x", 1)]


def test_cached_builds_once(spark, tmp_path):
    calls = []

    def build():
        calls.append(1)
        return spark.range(len(calls))

    path = str(tmp_path / "t")
    assert R.cached(spark, path, build).count() == 1
    assert R.cached(spark, path, build).count() == 1
    assert R.cached(spark, path, build, refresh=True).count() == 2


def text_of(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def test_quoted_and_tab_bytes(spark, tmp_path):
    df = spark.createDataFrame([(" a", 'q"x', None)], "a string, `b.c` string, d string").coalesce(1)
    K.write_quoted(df, str(tmp_path / "q"), ";")
    assert text_of(tmp_path / "q") == '"a";"b.c";"d"\n" a";"q""x";""\n'
    K.write_tab(df, str(tmp_path / "t"))
    assert text_of(tmp_path / "t") == 'a\tb.c\td\t\n a\t"q""x"\t\t\n'


def test_raw_cells_are_one_line_of_ascii(spark, tmp_path):
    row = {c: "x" for c in R.ARTICLE_COLUMNS} | {"story body": 'né\n"q"'}
    df = spark.createDataFrame([tuple(row.values())], ", ".join(f"`{c}` string" for c in row)).coalesce(1)
    K.write_raw(df, str(tmp_path / "r"), ",")
    lines = text_of(tmp_path / "r").splitlines()
    assert lines[0] == ",".join(f'"{c}"' for c in R.ARTICLE_COLUMNS) and lines[1].endswith("\"n 'q'\"")


def test_rolling_files(spark, tmp_path):
    df = spark.range(25).repartition(1)
    K.write_rolling(df, str(tmp_path / "r"), 10)
    sizes = sorted(len(p.read_text().splitlines()) - 1 for p in (tmp_path / "r").glob("part-*"))
    assert sizes == [5, 10, 10]
    assert all(p.read_text().startswith('"id"\t\n') for p in (tmp_path / "r").glob("part-*"))
    K.write_rolling(df, str(tmp_path / "l"), 10, file_limit=1)
    assert len(text_of(tmp_path / "l").splitlines()) == 11


def test_split_id_and_subset_sinks(spark, tmp_path):
    df = spark.createDataFrame([("a", "train"), ("b", "test")], "_guid string, split string").coalesce(1)
    K.write_split(df, str(tmp_path / "s"))
    assert text_of(tmp_path / "s_train") == '"_guid"\n"a"\n' and text_of(tmp_path / "s_test") == '"_guid"\n"b"\n'
    K.write_ids(df, str(tmp_path / "i"), "_guid")
    assert sorted(text_of(tmp_path / "i").split()) == ["a", "b"]
    wide = df.select("_guid", *[F.lit(1).alias(c) for c in K.SUBSET_COLUMNS[1:]], F.lit(2).alias("other"))
    K.write_subset(wide, str(tmp_path / "w"))
    assert text_of(tmp_path / "w").splitlines()[0] == ",".join(f'"{c}"' for c in K.SUBSET_COLUMNS)


def test_tables_are_replaced_or_appended(spark, tmp_path):
    path = str(tmp_path / "t")
    K.replace_table(spark.range(3), path)
    K.replace_table(spark.range(2), path)
    K.append_table(spark.range(2), path)
    assert spark.read.parquet(path).count() == 4


def test_replace_table_that_the_rows_come_from(spark, tmp_path):
    path = str(tmp_path / "own")
    K.replace_table(spark.range(5), path)
    K.replace_table(spark.read.parquet(path).where("id > 1"), path)
    assert spark.read.parquet(path).count() == 3


def test_wrapper_tag_that_begins_like_a_record(spark):
    lines = spark.createDataFrame(
        [("<n-documents><n-document guid='1'><a/>",), ("<n-document guid='2'>",), ("</n-documents>",)], "value string")
    got = sorted(r.xml for r in R.xml_records(lines).collect())
    assert got == ["<n-document guid='1'><a/></n-document>", "<n-document guid='2'></n-document>"]


def test_json_lists_of_bounded_size(spark, tmp_path):
    """Five times the rows, all alike, make more files and not larger ones."""
    from newsfeat.checks.source_checks import write_lists
    largest, files = {}, {}
    for n in (2000, 10_000):
        path = tmp_path / str(n)
        write_lists(spark.range(n).select(F.lit('{"data": "' + "x" * 86 + '"}').alias("json")), str(path), 10_000)
        sizes = [f.stat().st_size for f in path.glob("part-*")]
        largest[n], files[n] = max(sizes), len(sizes)
        assert sum(len(json.loads(f.read_text())) for f in path.glob("part-*")) == n
    assert max(largest.values()) < 20_000 and files[10_000] > 4 * files[2000]


def test_files_of_unlike_headers_are_put_together_by_name(spark, tmp_path):
    (tmp_path / "a.csv").write_text('k,"x y",z\n1,"",q\n2,,"two\nlines"\n')
    (tmp_path / "b.csv").write_text("﻿z,k\r\nw,3\r\n", newline="")
    (tmp_path / "c.csv").write_text('k,"x y",z\n')
    (tmp_path / "d.csv").write_text("")
    assert [len(files) for _, files in R.header_groups(spark, str(tmp_path))] == [2, 1]
    df = R._csv(spark, str(tmp_path))
    assert sorted(df.columns) == ["k", "x y", "z"]
    got = {r["k"]: (r["x y"], r["z"]) for r in df.collect()}
    assert got == {"1": ("", "q"), "2": (None, "two\nlines"), "3": (None, "w")}
    with pytest.raises(ValueError, match="no file with a header"):
        R._csv(spark, str(tmp_path / "d.csv"))


def test_only_lists_reach_the_reader_of_lists(spark, monkeypatch):
    read = spark.sparkContext.accumulator(0)

    @F.pandas_udf("array<string>")
    def counted(texts: pd.Series) -> pd.Series:
        read.add(int(texts.notna().sum()))
        return texts.map(lambda t: t and [t])

    monkeypatch.setattr(R, "objects_of_list", lambda text, fields: counted(text))
    rows = [('{"a": "x"}',), (None,), ("broken",), (' [{"a": "y"}]',)]
    got = R.json_objects(spark.createDataFrame(rows, "j string"), "j", ["a"]).collect()
    assert [(r.a, r.malformed) for r in got[:3]] == [("x", False), (None, True), (None, True)] and len(got) == 4
    assert read.value == 1
