"""Readers and writers: records built from the tables, parsed or written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfeat.checks.feature_checks import PATTERN_SQL
from newsfeat.checks.fixtures import (ARTICLES_SQL, LABELLED_SQL, ORDER_TEXTS_SQL, TEST_IDS_SQL, articles, docs,
                                      labelled, order_texts, table, test_ids)
from newsfeat.checks.registry import query
from newsfeat.functions.features import PATTERNS, pattern_columns
from newsfeat.operators.joins import mark_split
from newsfeat.session import scratch_path, stored
from newsfeat.sources import readers as R
from newsfeat.sources import sinks as K


def escaped(c):
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;"), ('"', "&quot;")):
        c = F.replace(c, F.lit(raw), F.lit(entity))
    return c


def xml_of(rows):
    """An XML record per article; paragraphs are the body's lines. French ones are broken."""
    paragraphs = F.concat(F.lit("<p>"), F.replace(escaped(F.col("story body")), F.lit("\n"), F.lit("</p><p>")),
                          F.lit("</p>"))
    seconds = F.col("story date").cast("bigint")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.floor(seconds / 86400), secs=F.pmod(seconds, F.lit(86400)))
    parts = [
        '<n-document guid="', F.col("guid"), '"><n-metadata><metadata.block><md.dates><md.publisheddatetime>',
        F.date_format(utc, "yyyyMMddHHmmss"), "</md.publisheddatetime></md.dates><md.descriptions><md.title>",
        escaped(F.col("title")), "</md.title></md.descriptions></metadata.block></n-metadata><n-docbody><document>",
        '<supplier-info><supplier-num nitf-regsrc="', F.col("journal code"), '"/></supplier-info><pub-info><src-data>',
        "<src-journal-code>", F.col("journal code"), "</src-journal-code></src-data></pub-info><indexing>",
        "<extraction-terms><extr-company-block><block>", '<ric norm="R.', F.col("RCS"), '"/><ric norm="R2"/>',
        '<norm-company oa-id="', F.col("OA perm ids"), '"/></block></extr-company-block><extr-person-block>',
        "<person-perm-id>", F.col("guid"), "</person-perm-id></extr-person-block></extraction-terms>",
        "<classification-terms><rcs-block><x><rcs>", F.col("RCS"), "</rcs><rcs>N:2</rcs></x></rcs-block>",
        '</classification-terms></indexing><content><text type="lead-para"><p>', F.col("lead parag"),
        '</p></text><text type="body">', paragraphs, "</text></content></document></n-docbody>",
    ]
    body = F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])
    end = F.when(F.col("RCS") == "fr", "</broken></n-document>").otherwise("</n-document>")
    return rows.select("RCS", F.concat(body, end).alias("xml"))


BODY_TEXT = "array_to_string(list_filter(string_split(\"story body\", chr(10)), lambda p: p <> ''), ' ')"
XML_SQL = f"""WITH {ARTICLES_SQL}
SELECT guid, "journal code", "journal code" AS source, "story date", concat('R.', "RCS", ' R2') AS "RICs",
  guid AS "person perm ids", "OA perm ids", concat("RCS", ' N:2') AS "RCS", title, "lead parag",
  {BODY_TEXT} AS "story body"
FROM articles WHERE "RCS" <> 'fr'"""


@query("s1_xml_files", XML_SQL)
def s1(spark, sf):
    """Records written as XML text files and scanned again."""
    path = scratch_path(spark, "xml")
    xml_of(articles(spark, sf)).select("xml").write.text(path)
    return R.read_xml(spark, path)


@query("s2_xml_fields", XML_SQL)
def s2(spark, sf):
    return R.accepted(R.parse_xml(xml_of(articles(spark, sf)).select("xml")))


@query("f11_rejects", f"""WITH {ARTICLES_SQL}
SELECT 'xml' AS kind, "RCS" AS lang, count(*) AS parsed, count(*) FILTER ("RCS" = 'fr') AS errors
FROM articles GROUP BY "RCS"
UNION ALL SELECT 'json', "RCS", count(*), count(*) FILTER ("RCS" = 'fr') FROM articles GROUP BY "RCS" """)
def f11(spark, sf):
    rows = xml_of(articles(spark, sf)).withColumnRenamed("RCS", "lang")
    xml = R.reject_counts(R.parse_xml(rows).select("lang", "malformed"), "lang")
    cut = F.expr("substring(json, 1, length(json) - 5)")
    broken = json_of(articles(spark, sf)).withColumn(
        "json", F.when(F.col("lang") == "fr", cut).otherwise(F.col("json")))
    js = R.reject_counts(R.json_objects(broken, "json", ["scrollid", "data"]).select("lang", "malformed"), "lang")
    return xml.select(F.lit("xml").alias("kind"), "*").unionByName(js.select(F.lit("json").alias("kind"), "*"))


@query("a13_reject_totals", f"""WITH {ARTICLES_SQL}
SELECT count(*) AS parsed, count(*) FILTER ("RCS" = 'fr') AS errors FROM articles""")
def a13(spark, sf):
    return R.reject_counts(R.parse_xml(xml_of(articles(spark, sf))))


@query("s11_first_paragraph", f"""WITH {ARTICLES_SQL}
SELECT guid, "lead parag" AS paragraph FROM articles WHERE "RCS" <> 'fr'""")
def s11(spark, sf):
    rows = articles(spark, sf)
    xml = xml_of(rows).withColumn("guid", F.regexp_extract("xml", 'guid="([^"]*)"', 1)).select("guid", "xml")
    return R.accepted(R.first_paragraph(xml))


def json_of(rows):
    """A JSON text per article: lists for ids and topics, fractions of seconds in dates."""
    seconds = F.col("story date").cast("bigint")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.floor(seconds / 86400), secs=F.pmod(seconds, F.lit(86400)))
    obj = F.struct(
        F.col("guid").alias("scrollid"), F.col("journal code").alias("sources"),
        F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".500")).alias("maindocdate"),
        F.split("OA perm ids", " ").alias("hiorgid"), F.array("RCS", "journal code").alias("tn2"),
        F.col("title").alias("subheadline"), F.col("story body").alias("data"))
    return rows.select(F.col("RCS").alias("lang"), F.to_json(obj).alias("json"))


JSON_SQL = f"""WITH {ARTICLES_SQL}
SELECT guid, "journal code", '' AS source, "story date", '' AS "RICs", '' AS "person perm ids", "OA perm ids",
  concat("RCS", ' ', "journal code") AS "RCS", title, '' AS "lead parag", "story body" FROM articles"""


@query("s3_json_texts", JSON_SQL)
def s3(spark, sf):
    """Objects, and for German articles lists of one object."""
    texts = json_of(articles(spark, sf)).withColumn("json", F.when(
        F.col("lang") == "de", F.concat(F.lit("["), "json", F.lit("]"))).otherwise(F.col("json")))
    return R.accepted(R.parse_json(texts.select("json")))


def write_lists(rows, path, group_bytes=32 * 2**20):
    """The `json` texts as files of one list each, of about `group_bytes`: more text makes more files, not larger ones."""
    rows = stored(rows.select("json"), "json-rows")
    total = rows.agg(F.sum(F.octet_length("json"))).first()[0] or 0
    # by place, not by text: equal texts are spread too
    place = F.xxhash64("_metadata.file_name", "_metadata.row_index")
    dealt = rows.select("json", F.pmod(place, F.lit(-(-total // group_bytes) or 1)).alias("file"))
    lists = dealt.groupBy("file").agg(
        F.concat(F.lit("["), F.array_join(F.collect_list("json"), ","), F.lit("]")).alias("json"))
    lists.select("json").write.option("maxRecordsPerFile", 1).text(path)


@query("s3_json_files", JSON_SQL)
def s3_files(spark, sf):
    """All articles as files of a list of objects each, read as a folder."""
    path = scratch_path(spark, "json")
    write_lists(json_of(articles(spark, sf)), path)
    return R.read_json(spark, path)


def nr_rows(spark, sf):
    rows = articles(spark, sf)
    seconds = F.col("story date").cast("bigint")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.floor(seconds / 86400), secs=F.pmod(seconds, F.lit(86400)))
    return rows.select(
        "guid", "journal code", "source", F.date_format(utc, "yyyyMMddHHmmss").alias("story date time"), "RICs",
        "person perm ids", "OA perm ids", "RCS", F.concat(F.lit("<P>"), "title").alias("story title"), "story body")


NR_SQL = f"""WITH {ARTICLES_SQL}
SELECT guid, "journal code", source, "story date", "RICs", "person perm ids", "OA perm ids", "RCS", title,
  '' AS "lead parag", "story body" FROM articles"""


@query("s4_nr_articles", NR_SQL)
def s4(spark, sf):
    return R.nr_articles(nr_rows(spark, sf))


@query("s4_nr_files", NR_SQL)
def s4_files(spark, sf):
    path = scratch_path(spark, "nr")
    K.write_quoted(nr_rows(spark, sf), path)
    return R.read_nr_csv(spark, path)


@query("s4_nr_unlike_headers", f"""WITH {ARTICLES_SQL}
SELECT guid, "journal code", source, "story date", "RICs", CASE WHEN "RCS" <> 'en' THEN "person perm ids" END AS "person perm ids",
  "OA perm ids", "RCS", title, '' AS "lead parag", "story body" FROM articles""")
def s4_unlike(spark, sf):
    """Files whose columns stand in another order, and lack one, beside files of the usual order."""
    rows, path = nr_rows(spark, sf), scratch_path(spark, "nr-unlike")
    K.write_quoted(rows.where("RCS <> 'en'"), f"{path}/usual")
    turned = rows.where("RCS = 'en'").drop("person perm ids")
    K.write_quoted(turned.select(*[f"`{c}`" for c in reversed(turned.columns)]), f"{path}/turned")
    return R.read_nr_csv(spark, [f"{path}/usual", f"{path}/turned"])


def named_files(spark, folder, target, prefix, extension):
    """Give the part files of a folder names as a feed has them, below `target`."""
    fs, goal = R._file_system(spark, target)
    fs.mkdirs(goal)
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    for i, name in enumerate(R.list_files(spark, folder)):
        if not fs.rename(path(name), path(f"{target}/{prefix}{i}.{extension}")):
            raise OSError(f"{name} could not be named")


def swift_rows(spark, sf):
    quote = F.lit('"')

    def quoted(c):
        return F.concat(quote, F.lit(" "), F.col(c), F.lit(" "), quote)

    rows = articles(spark, sf)
    seconds = F.col("story date").cast("bigint")
    utc = F.lit("1970-01-01").cast("timestamp_ntz") + F.make_dt_interval(
        F.floor(seconds / 86400), secs=F.pmod(seconds, F.lit(86400)))
    listed = F.concat(F.lit("[u'"), F.col("RCS"), F.lit("', u'"), F.col("RCS"), F.lit("']"))
    return rows.select(
        quoted("guid").alias("scrollid"), quoted("RCS").alias("sources"),
        F.concat(F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".5")).alias("maindocdate"),
        listed.alias("hiorgid"), listed.alias("tn2"), F.col("RCS").alias("subheadline"),
        F.translate("story body", "\n\t", "  ").alias("data"))


SWIFT_SQL = f"""WITH {ARTICLES_SQL}
SELECT guid, "RCS" AS "journal code", '' AS source, "story date", "RCS" || ' ' || "RCS" AS "RICs",
  '' AS "person perm ids", '' AS "OA perm ids", "RCS" || ' ' || "RCS" AS "RCS", "RCS" AS title, '' AS "lead parag",
  trim(translate("story body", chr(10) || chr(9), '  ')) AS "story body" FROM articles"""


@query("s5_swift_articles", SWIFT_SQL)
def s5(spark, sf):
    return R.swift_articles(swift_rows(spark, sf))


@query("s5_swift_files", SWIFT_SQL)
def s5_files(spark, sf):
    path = scratch_path(spark, "swift")
    K.write_quoted(swift_rows(spark, sf), path)
    return R.read_swift_csv(spark, path)


@query("s6_news_folder", f"""WITH {ARTICLES_SQL}
SELECT guid, "journal code", source, "story date", "RICs", "person perm ids", "OA perm ids",
  concat("RCS", ' ', "journal code") AS "RCS", title, '' AS "lead parag", "story body" FROM articles WHERE "RCS" = 'de'
UNION ALL SELECT guid, "journal code", source, "story date", "RICs", "person perm ids", "OA perm ids", "RCS", title,
  '', "story body" FROM articles WHERE "RCS" = 'en'
UNION ALL SELECT * FROM ({SWIFT_SQL.replace('FROM articles', """FROM articles WHERE "RCS" = 'es'""")})""")
def s6_folder(spark, sf):
    """One folder with JSON, NR and Swift files, told apart by their names, read in one call."""
    path = scratch_path(spark, "news")
    K.write_quoted(nr_rows(spark, sf).where("RCS = 'en'"), f"{path}/nr")
    K.write_quoted(swift_rows(spark, sf).where("trim(BOTH '\" ' FROM sources) = 'es'"), f"{path}/swift")
    write_lists(json_of(articles(spark, sf).where("RCS = 'de'")), f"{path}/json")
    named_files(spark, f"{path}/nr", f"{path}/all", "NR_", "csv")
    named_files(spark, f"{path}/swift", f"{path}/all", "SWIFT_", "csv")
    named_files(spark, f"{path}/json", f"{path}/all", "feed", "json")
    return R.read_news(spark, f"{path}/all")


@query("s6_folder_union", f"""WITH {ARTICLES_SQL}
SELECT 'xml' AS kind, count(*) AS n FROM articles WHERE "RCS" <> 'fr'
UNION ALL SELECT 'json', count(*) FROM articles UNION ALL SELECT 'nr', count(*) FROM articles""")
def s6(spark, sf):
    """The union of all formats, counted per format."""
    rows = articles(spark, sf)
    parts = {
        "xml": R.accepted(R.parse_xml(xml_of(rows).select("xml"))),
        "json": R.accepted(R.parse_json(json_of(rows).select("json"))),
        "nr": R.nr_articles(nr_rows(spark, sf)),
    }
    tagged = [part.select(F.lit(kind).alias("kind"), "*") for kind, part in parts.items()]
    union = tagged[0].unionByName(tagged[1]).unionByName(tagged[2])
    return union.groupBy("kind").agg(F.count("guid").alias("n"))


@query("s7_projected_table", f"""WITH {LABELLED_SQL} SELECT _guid, orgs, body, topics, title FROM labelled""")
def s7(spark, sf):
    return R.select_columns(labelled(spark, sf), ["_guid", "orgs", "body", "topics", "title"])


@query("s8_feature_file", "SELECT CAST(doc_id AS VARCHAR) AS _guid, source, n_chars FROM documents")
def s8(spark, sf):
    path = scratch_path(spark, "features")
    rows = table(spark, sf, "documents").select(F.col("doc_id").alias("id"), "source", "n_chars")
    K.write_quoted(rows, path, "\t")
    return R.read_features(spark, path, "\t", "id", "id string, source string, n_chars bigint")


@query("s9_bulk_cells", """SELECT concat('f', doc_id) AS "fileID", CAST(doc_id AS VARCHAR) AS scrollid,
  'NULL' AS if3, lang || ' ' || source AS hiorgid,
  regexp_replace(replace(translate(text, chr(13) || chr(9) || chr(10), '   '), '"', ''''), '[^\\x00-\\x7F]', '?', 'g')
    AS data FROM documents""")
def s9(spark, sf):
    rows = table(spark, sf, "documents").select(
        F.concat(F.lit("f"), "doc_id", F.lit(".en.json")).alias("name"),
        F.to_json(F.struct(F.col("doc_id").cast("string").alias("scrollid"), F.array("lang", "source").alias("hiorgid"),
                           F.col("text").alias("data"), F.col("n_chars").alias("unused"))).alias("json"))
    fields = ["scrollid", "if3", "hiorgid", "data"]
    return R.bulk_cells(R.accepted(R.json_objects(rows, "json", fields)), "name", fields)


@query("s10_sheet_export", """SELECT CAST(o_orderkey AS VARCHAR) AS id, concat(o_orderpriority, ' house') AS "RICs",
  o_orderstatus AS "Significance" FROM orders""")
def s10(spark, sf):
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("id"), F.concat(F.lit("[u'"), "o_orderpriority", F.lit("', u'house']")).alias("RICs"),
        F.col("o_orderstatus").alias("Significance Rating "), F.col("o_custkey").alias("Unnamed: 3"))
    return R.sheet_cells(rows)


@query("s10_sheet_files", """SELECT CAST(o_orderkey AS VARCHAR) AS id, concat(o_orderpriority, ' house') AS "RICs",
  o_orderstatus AS "Significance" FROM orders WHERE o_orderkey % 2 = 1""")
def s10_files(spark, sf):
    """A folder with exports of both feeds; the one whose names begin with NR_ is read."""
    rows, path = table(spark, sf, "orders"), scratch_path(spark, "sheets")
    cells = [F.col("o_orderkey").alias("id"), F.concat(F.lit("[u'"), "o_orderpriority", F.lit("', u'house']")).alias("RICs"),
             F.col("o_orderstatus").alias("Significance Rating "), F.col("o_custkey").alias("Unnamed: 3")]
    for feed, prefix in (("o_orderkey % 2 = 1", "NR_"), ("o_orderkey % 2 = 0", "export")):
        K.write_quoted(rows.where(feed).select(*cells), f"{path}/{prefix}")
        named_files(spark, f"{path}/{prefix}", f"{path}/all", prefix, "csv")
    return R.read_sheet_export(spark, f"{path}/all", "nsc")


LABEL_SQL = """SELECT CAST(doc_id AS VARCHAR) AS guid, CAST(quality AS VARCHAR) AS significance FROM labels"""


def label_feed(spark, sf):
    """One feed text per label."""
    item = F.struct(F.struct(F.col("doc_id").cast("string").alias("guid")).alias("guid"),
                    F.col("quality").cast("string").alias("significance"))
    return table(spark, sf, "labels").select(F.to_json(F.array(item)).alias("json"))


@query("s12_label_feed", LABEL_SQL)
def s12(spark, sf):
    return R.parse_labels(label_feed(spark, sf)).drop("pos")


@query("s13_cached_table", "SELECT source AS source_id, doc_id, text AS body FROM documents")
def s13(spark, sf):
    path = scratch_path(spark, "cache")
    R.cached(spark, path, lambda: docs(spark, sf), refresh=True)
    return R.cached(spark, path, lambda: docs(spark, sf))


def read_back(spark, path, sep=",", **options):
    return spark.read.options(header=True, sep=sep, quote='"', escape='"', multiLine=True, **options).csv(path)


@query("k1_quoted_csv", f"WITH {ORDER_TEXTS_SQL} SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, {PATTERN_SQL},"
                        " text FROM order_texts")
def k1(spark, sf):
    path = scratch_path(spark, "k1")
    K.write_quoted(pattern_columns(order_texts(spark, sf), "text"), path, ";")
    back = read_back(spark, path, ";")
    return back.select("o_orderkey", "text", *[
        F.round(F.col(f"`{n}`").cast("double"), 6).alias(n) for n in PATTERNS])


@query("k2_raw_csv", f"""WITH {ARTICLES_SQL}
SELECT guid, regexp_replace(translate("story body", chr(13) || chr(9) || chr(10) || '"', '   '''), '[^\\x00-\\x7F]', '', 'g')
  AS body, regexp_replace(translate(title, chr(13) || chr(9) || chr(10) || '"', '   '''), '[^\\x00-\\x7F]', '', 'g') AS title
FROM articles""")
def k2(spark, sf):
    path = scratch_path(spark, "k2")
    K.write_raw(articles(spark, sf), path, "\t")
    back = read_back(spark, path, "\t", ignoreLeadingWhiteSpace=False)
    return back.select("guid", F.coalesce("story body", F.lit("")).alias("body"),
                       F.coalesce("title", F.lit("")).alias("title"))


@query("k3_rolling_files", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority, true AS within_limit
FROM orders""")
def k3(spark, sf):
    """Every row comes back, and no file holds more rows than allowed."""
    path = scratch_path(spark, "k3")
    K.write_rolling(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), path, 1000)
    back = spark.read.options(header=True, sep="\t", lineSep="\n").csv(path)
    back = back.withColumn("file", F.col("_metadata.file_path"))
    sizes = back.groupBy("file").agg((F.count("*") <= 1000).alias("within_limit"))
    return back.join(sizes, "file").select("o_orderkey", "o_orderpriority", "within_limit")


@query("k4_id_list", "SELECT CAST(doc_id AS VARCHAR) AS value FROM documents")
def k4(spark, sf):
    path = scratch_path(spark, "k4")
    K.write_ids(articles(spark, sf).withColumnRenamed("guid", "scrollid"), path)
    return spark.read.text(path)


@query("k5_tab_file", """SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, o_orderpriority FROM orders""")
def k5(spark, sf):
    path = scratch_path(spark, "k5")
    K.write_tab(table(spark, sf, "orders").select("o_orderkey", "o_orderpriority"), path)
    return spark.read.options(header=True, sep="\t").csv(path).select("o_orderkey", "o_orderpriority")


@query("k6_split_files", f"""WITH {LABELLED_SQL}, {TEST_IDS_SQL}
SELECT CASE WHEN _guid IN (SELECT id FROM test_ids) THEN 'test' ELSE 'train' END AS split, _guid,
  CAST(significance AS VARCHAR) AS significance FROM labelled""")
def k6(spark, sf):
    path = scratch_path(spark, "k6")
    rows = labelled(spark, sf).select("_guid", "significance")
    K.write_split(mark_split(rows, test_ids(spark, sf), "_guid"), path)
    parts = [read_back(spark, f"{path}_{s}", "\t").select(F.lit(s).alias("split"), "*") for s in ("train", "test")]
    return parts[0].unionByName(parts[1])


@query("k7_feature_subset", """SELECT CAST(doc_id AS VARCHAR) AS _guid, CAST(n_chars AS VARCHAR) AS story_word_count,
'0' AS org_count FROM documents""")
def k7(spark, sf):
    path = scratch_path(spark, "k7")
    rows = table(spark, sf, "documents").select(
        F.col("doc_id").alias("_guid"), F.col("n_chars").alias("story_word_count"), F.lit("x").alias("dropped"),
        *[F.lit(0).alias(c) for c in K.SUBSET_COLUMNS if c not in ("_guid", "story_word_count")])
    K.write_subset(rows, path)
    return read_back(spark, path).select("_guid", "story_word_count", "org_count")


@query("k8_replace_table", "SELECT doc_id, quality FROM labels")
def k8(spark, sf):
    path = scratch_path(spark, "k8")
    rows = table(spark, sf, "labels").select("doc_id", "quality")
    K.replace_table(rows.where("quality = 0"), path)
    K.replace_table(rows, path)
    return spark.read.parquet(path)


@query("k9_append_table", "SELECT doc_id, quality FROM labels")
def k9(spark, sf):
    path = scratch_path(spark, "k9")
    rows = table(spark, sf, "labels").select("doc_id", "quality")
    K.append_table(rows.where("quality = 0"), path)
    K.append_table(rows.where("quality <> 0"), path)
    return spark.read.parquet(path)


@query("k10_label_csv", LABEL_SQL)
def k10(spark, sf):
    path = scratch_path(spark, "k10")
    K.write_labels(R.parse_labels(label_feed(spark, sf)), path)
    return read_back(spark, path)
