"""Cell cleaning, count, pattern, label and scaling features."""

from __future__ import annotations

from pyspark.sql import functions as F

from newsfeat.checks.fixtures import (ARTICLES_SQL, LABELLED_SQL, ORDER_TEXTS_SQL, articles, labelled,
                                      order_texts, table)
from newsfeat.checks.registry import query
from newsfeat.functions import cleaning as P
from newsfeat.functions import features as X
from newsfeat.plans import exports
from newsfeat.session import scratch_path

TAGS = P.TAG_PATTERN.replace("'", "''")
SANITISED = "replace(translate(text, chr(13) || chr(9) || chr(10), '   '), '\"', '''')"


@query("p1_sanitise", f"SELECT doc_id, '\"' || {SANITISED} || '\"' AS cell FROM documents")
def p1(spark, sf):
    return table(spark, sf, "documents").select("doc_id", P.sanitise(F.col("text")).alias("cell"))


@query("p1_sanitise_html", f"SELECT page_id, '\"' || {SANITISED.replace('text', 'html')} || '\"' AS cell FROM pages")
def p1_html(spark, sf):
    return table(spark, sf, "pages").select("page_id", P.sanitise(F.col("html")).alias("cell"))


@query("p2_ascii_replace", r"SELECT doc_id, regexp_replace(text, '[^\x00-\x7F]', '?', 'g') AS cell FROM documents")
def p2(spark, sf):
    return table(spark, sf, "documents").select("doc_id", P.ascii_replace(F.col("text")).alias("cell"))


@query("p3_strip_tags", f"WITH {ORDER_TEXTS_SQL} SELECT o_orderkey, regexp_replace(text, '{TAGS}', '', 'g') AS clean"
                        " FROM order_texts")
def p3(spark, sf):
    return order_texts(spark, sf).select("o_orderkey", P.strip_tags(F.col("text")).alias("clean"))


@query("p3_strip_tags_custom", "SELECT page_id, regexp_replace(html, '<[^>]*>', '', 'g') AS clean FROM pages")
def p3_custom(spark, sf):
    return table(spark, sf, "pages").select("page_id", P.strip_tags(F.col("html"), "<[^>]*>").alias("clean"))


@query("p4_tags_changed", f"""WITH {ORDER_TEXTS_SQL}
SELECT 'o' AS kind, o_orderkey AS id, regexp_replace(text, '{TAGS}', '', 'g') IS DISTINCT FROM text AS changed
FROM order_texts
UNION ALL SELECT 'd', doc_id, regexp_replace(text, '{TAGS}', '', 'g') IS DISTINCT FROM text FROM documents""")
def p4(spark, sf):
    orders = order_texts(spark, sf).select(F.lit("o").alias("kind"), F.col("o_orderkey").alias("id"), "text")
    documents = table(spark, sf, "documents").select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), "text")
    both = orders.unionByName(documents)
    return both.select("kind", "id", P.tags_changed(F.col("text")).alias("changed"))


@query("p5_unix_seconds", """
SELECT o_orderkey, CAST(CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400 AS VARCHAR) AS xml_seconds,
  CAST(CAST(epoch(o_orderdate) AS BIGINT) + o_orderkey % 86400 AS VARCHAR) AS json_seconds,
  CAST(NULL AS VARCHAR) AS bad_seconds
FROM orders""")
def p5(spark, sf):
    ts = F.timestamp_seconds(F.unix_seconds(F.col("o_orderdate").cast("timestamp")) + F.col("o_orderkey") % 86400)
    text = table(spark, sf, "orders").select(
        "o_orderkey",
        F.date_format(ts, "yyyyMMddHHmmss").alias("x"),
        F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".123")).alias("j"))
    return text.select(
        "o_orderkey", P.to_unix_seconds(F.col("x"), "xml").alias("xml_seconds"),
        P.to_unix_seconds(F.col("j"), "json").alias("json_seconds"),
        P.to_unix_seconds(F.col("j"), "xml").alias("bad_seconds"))


QUOTED = """concat('"" ', o_orderpriority, ' "quoted" ', o_orderstatus, '  "')"""


@query("p6_unquote", f"""SELECT o_orderkey,
trim(trim(trim({QUOTED}, '"')), '"') AS cell FROM orders""")
def p6(spark, sf):
    quoted = table(spark, sf, "orders").select("o_orderkey", F.expr(QUOTED).alias("c"))
    return quoted.select("o_orderkey", P.unquote(F.col("c")).alias("cell"))


LISTED = """concat('[u''', o_orderpriority, ''', u''house ', o_orderstatus, ''']')"""


@query("p7_unlist", f"""SELECT o_orderkey,
replace(replace(replace(trim(trim({LISTED}, '['), ']'), 'u', ''), '''', ''), ',', '') AS cell FROM orders""")
def p7(spark, sf):
    listed = table(spark, sf, "orders").select("o_orderkey", F.expr(LISTED).alias("c"))
    return listed.select("o_orderkey", P.unlist(F.col("c")).alias("cell"))


@query("p8_flatten_list_literal", """SELECT o_orderkey,
concat(o_orderpriority, ' house ', o_orderstatus) AS listed, o_orderpriority AS bare FROM orders""")
def p8(spark, sf):
    quoted = F.concat(F.lit("'"), F.col("o_orderpriority"), F.lit("'"))
    listed = table(spark, sf, "orders").select("o_orderkey", F.expr(LISTED).alias("c"), quoted.alias("b"))
    return listed.select("o_orderkey", P.flatten_list_literal(F.col("c")).alias("listed"),
                         P.flatten_list_literal(F.col("b")).alias("bare"))


@query("p9_join_list", """SELECT o_orderkey, concat(o_orderpriority, ' ', o_orderstatus) AS listed,
o_orderpriority AS scalar FROM orders""")
def p9(spark, sf):
    rows = table(spark, sf, "orders")
    listed = F.to_json(F.array("o_orderpriority", "o_orderstatus"))
    return rows.select("o_orderkey", P.join_list(listed).alias("listed"),
                       P.join_list(F.col("o_orderpriority")).alias("scalar"))


@query("p10_with_default", """SELECT doc_id, coalesce(CAST(quality AS VARCHAR), 'NULL') AS quality
FROM documents LEFT JOIN labels USING (doc_id)""")
def p10(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", P.with_default(F.col("quality").cast("string")).alias("quality"))


@query("p11_lead_and_body", """SELECT doc_id, CAST(quality AS VARCHAR) || ' ' || text AS body
FROM documents LEFT JOIN labels USING (doc_id)""")
def p11(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    return rows.select("doc_id", P.lead_and_body(F.col("quality").cast("string"), F.col("text")).alias("body"))


@query("p12_count_features", f"""WITH {ARTICLES_SQL}
SELECT guid, len(string_split("story body", ' ')) AS story_word_count, len(string_split("RCS", ' ')) AS topics_count,
  len(string_split(title, ' ')) AS title_word_count, len(string_split("OA perm ids", ' ')) AS org_count,
  length("story body") AS "story.length", 1 AS empty_count, 0 AS null_count
FROM articles""")
def p12(spark, sf):
    counted = X.count_columns(articles(spark, sf))
    counted = counted.withColumns({
        "empty_count": X.count_feature(F.col("RICs"), " "),
        "null_count": X.count_feature(F.nullif(F.col("RICs"), F.lit("")), " ")})
    names = ["story_word_count", "topics_count", "title_word_count", "org_count", "story.length",
             "empty_count", "null_count"]
    return counted.select("guid", *[F.col(f"`{n}`").cast("bigint").alias(n) for n in names])


def pattern_sql(text: str, name: str) -> str:
    pattern, idf = X.PATTERNS[name]
    return f"round(len(regexp_extract_all({text}, '{pattern}')) * CAST({idf} AS DOUBLE), 6) AS \"{name}\""


PATTERN_SQL = ", ".join(pattern_sql("text", n) for n in X.PATTERNS)


@query("p13_pattern_counts", f"""WITH {ORDER_TEXTS_SQL}
SELECT 'o' AS kind, o_orderkey AS id, {PATTERN_SQL} FROM order_texts
UNION ALL SELECT 'd', doc_id, {PATTERN_SQL} FROM documents""")
def p13(spark, sf):
    orders = order_texts(spark, sf).select(F.lit("o").alias("kind"), F.col("o_orderkey").alias("id"), "text")
    documents = table(spark, sf, "documents").select(F.lit("d").alias("kind"), F.col("doc_id").alias("id"), "text")
    counted = X.pattern_columns(orders.unionByName(documents), "text")
    return counted.select("kind", "id", *[F.round(F.col(f"`{n}`"), 6).alias(n) for n in X.PATTERNS])


@query("p14_lead_characters", "SELECT doc_id, text[:200] AS lead_200, text[:500] AS lead_500 FROM documents")
def p14(spark, sf):
    text = F.col("text")
    return table(spark, sf, "documents").select(
        "doc_id", X.prefix(text, 200).alias("lead_200"), X.prefix(text, 500).alias("lead_500"))


@query("p15_shorten", """SELECT doc_id,
CASE WHEN length(text) < 1001 THEN text ELSE text[:1000] || '...' END AS body FROM documents""")
def p15(spark, sf):
    return table(spark, sf, "documents").select("doc_id", X.shorten(F.col("text")).alias("body"))


@query("p16_final_columns", f"""WITH {ARTICLES_SQL}
SELECT guid, "journal code" AS "journal.code", "story date" AS "date.time", "OA perm ids" AS "organizations.codes",
  "RCS" AS "topics.codes", title AS "story.title",
  CASE WHEN length(b) < 1001 THEN b ELSE b[:1000] || '...' END AS "story.body"
FROM (SELECT *, "lead parag" || ' ' || "story body" AS b FROM articles)""")
def p16(spark, sf):
    rows = articles(spark, sf)
    return X.final_columns(rows.withColumn("body", P.lead_and_body(rows["lead parag"], rows["story body"])))


@query("p17_zscore_fit", """SELECT doc_id,
round((n_chars - (SELECT avg(n_chars) FROM documents)) / (SELECT stddev_samp(n_chars) FROM documents), 6) AS n_chars
FROM documents""")
def p17(spark, sf):
    scaled = X.zscore_fit(table(spark, sf, "documents").select("doc_id", "n_chars"), ["n_chars"])
    return scaled.withColumn("n_chars", F.round("n_chars", 6))


@query("p18_zscore_frozen", f"""WITH {ORDER_TEXTS_SQL}, counted AS (
  SELECT o_orderkey, length(text) AS "story.length", {PATTERN_SQL} FROM order_texts)
SELECT o_orderkey, round(("story.length" - 4645.554129) / 6796.77025, 6) AS "story.length",
  round(("numeric.percent" - 8.182659) / 57.78209, 6) AS "numeric.percent",
  round(("numeric.comma" - 4.401744) / 29.81231, 6) AS "numeric.comma" FROM counted""")
def p18(spark, sf):
    counted = X.pattern_columns(order_texts(spark, sf), "text").withColumn("story.length", F.length("text"))
    scaled = X.zscore_frozen(counted)
    return scaled.select("o_orderkey", *[F.round(F.col(f"`{n}`"), 6).alias(n) for n in X.TRAINING_STATS])


@query("p19_binary_labels", f"""WITH {LABELLED_SQL}
SELECT _guid, significance, CASE WHEN significance = 0 THEN 0 ELSE 1 END AS is_significant,
  CASE WHEN significance = 2 THEN 1 ELSE 0 END AS is_very_significant FROM labelled""")
def p19(spark, sf):
    return X.binary_labels(labelled(spark, sf).select("_guid", "significance"))


@query("p20_hour", "SELECT o_orderkey, (o_orderkey * 997 // 3600 + 23) % 24 AS hour FROM orders")
def p20(spark, sf):
    """1430439473 is 00:17:53 UTC; the shift makes every hour of the day occur."""
    rows = table(spark, sf, "orders")
    seconds = (F.col("o_orderkey") * 997 + 1430434800).cast("string")
    return rows.select("o_orderkey", X.hour_of(seconds, "UTC").cast("bigint").alias("hour"))


@query("p21_add_field", "SELECT conv_id, turn, text, upper(role) AS role_upper FROM conversations")
def p21(spark, sf):
    rows = table(spark, sf, "conversations").select("conv_id", "turn", "text", "role")
    return X.add_field(rows, "role", "role_upper", F.upper).drop("role")


@query("p22_select_features", """SELECT doc_id, n_chars, lang FROM documents""")
def p22(spark, sf):
    rows = table(spark, sf, "documents").join(table(spark, sf, "labels"), "doc_id", "left")
    chosen = X.select_features(rows, ["lang", "quality", "absent"], ["n_chars"], labels=["quality"])
    return rows.select("doc_id", *chosen)


@query("p23_schema_diff", """SELECT column_name AS column FROM (DESCRIBE documents)
WHERE column_name NOT IN (SELECT column_name FROM (DESCRIBE labels))""")
def p23(spark, sf):
    return X.schema_diff(spark, table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("a9_mean_deviation", """SELECT lang, round(avg(n_chars), 6) AS mean, round(stddev_samp(n_chars), 6) AS std
FROM documents GROUP BY lang""")
def a9(spark, sf):
    return table(spark, sf, "documents").groupBy("lang").agg(
        F.round(F.avg("n_chars"), 6).alias("mean"), F.round(F.stddev_samp("n_chars"), 6).alias("std"))


@query("l3_clean_columns", f"""WITH {ORDER_TEXTS_SQL}
SELECT o_orderkey, regexp_replace(text, '{TAGS}', '', 'g') AS story,
  regexp_replace('<A>' || text, '{TAGS}', '', 'g') AS subheadline FROM order_texts""")
def l3(spark, sf):
    rows = order_texts(spark, sf).select(
        "o_orderkey", F.col("text").alias("story"), F.concat(F.lit("<A>"), "text").alias("subheadline"))
    return P.clean_columns(rows, ["story", "subheadline"])


@query("l3_clean_table", f"""SELECT page_id, url, regexp_replace('<P>' || html, '{TAGS}', '', 'g') AS html FROM pages""")
def l3_table(spark, sf):
    path = scratch_path(spark, "l3")
    table(spark, sf, "pages").withColumn("html", F.concat(F.lit("<P>"), "html")).write.parquet(path)
    return exports.clean_table(spark, path, ["html"])
