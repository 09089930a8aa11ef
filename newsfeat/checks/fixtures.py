"""Article-shaped inputs derived from the driver's tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.functions.tokens import STOP_WORDS
from newsfeat.sources.readers import read_table


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A driver's table; `spark.newsfeat.spread`, where set, is the number of partitions it is dealt over."""
    spread = spark.conf.get("spark.newsfeat.spread", None)
    return read_table(spark, f"{sf}/{name}.parquet", int(spread) if spread else None)


def docs(spark: SparkSession, sf: str) -> DataFrame:
    """source_id, doc_id, body."""
    return table(spark, sf, "documents").select(
        F.col("source").alias("source_id"), "doc_id", F.col("text").alias("body"))


def order_text() -> str:
    """A sentence with tags, percentages, dollar amounts and comma numbers, in either SQL."""
    return (
        "concat('Order ', CAST(o_orderkey AS STRING), ' up ', CAST(o_custkey AS STRING), '.5 % to $',"
        " CAST(o_custkey AS STRING), '.3 million, ', CAST(o_orderkey AS STRING), ',500 units <P>', o_orderpriority,"
        " '</P> <B.R> by ', o_orderstatus)"
    )


def order_texts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select("o_orderkey", F.expr(order_text()).alias("text"))


ORDER_TEXTS_SQL = f"order_texts AS (SELECT o_orderkey, {order_text()} AS text FROM orders)"


def articles(spark: SparkSession, sf: str) -> DataFrame:
    """The 11-column article table."""
    documents = table(spark, sf, "documents")
    blank = F.lit("")
    return documents.select(
        F.col("doc_id").cast("string").alias("guid"),
        F.col("source").alias("journal code"),
        blank.alias("source"),
        (F.col("doc_id") * 3600 + 1430439473).cast("string").alias("story date"),
        blank.alias("RICs"),
        blank.alias("person perm ids"),
        F.concat_ws(" ", "lang", "source").alias("OA perm ids"),
        F.col("lang").alias("RCS"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat(F.col("source"), F.lit(" reports")).alias("lead parag"),
        F.col("text").alias("story body"),
    )


ARTICLES_SQL = """
articles AS (
  SELECT CAST(doc_id AS VARCHAR) AS guid, source AS "journal code", '' AS source,
    CAST(doc_id * 3600 + 1430439473 AS VARCHAR) AS "story date", '' AS "RICs", '' AS "person perm ids",
    concat(lang, ' ', source) AS "OA perm ids", lang AS "RCS", split_part(text, chr(10), 1) AS title,
    concat(source, ' reports') AS "lead parag", text AS "story body"
  FROM documents)
"""


def labelled(spark: SparkSession, sf: str) -> DataFrame:
    """Labelled articles: _data_source, _id, _guid, significance, title, orgs, topics, body, date.time."""
    labels = table(spark, sf, "labels")
    significance = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).otherwise(2)
    documents = table(spark, sf, "documents").join(labels, "doc_id")
    return documents.select(
        F.col("source").alias("_data_source"), F.col("doc_id").alias("_id"),
        F.col("doc_id").cast("string").alias("_guid"), significance.alias("significance"),
        F.substring_index("text", "\n", 1).alias("title"),
        F.concat_ws(" ", "lang", "source").alias("orgs"), F.col("lang").alias("topics"),
        F.col("text").alias("body"),
        (F.col("doc_id") * 3600 + 1430439473).cast("string").alias("date.time"),
    )


LABELLED_SQL = """
labelled AS (
  SELECT source AS _data_source, doc_id AS _id, CAST(doc_id AS VARCHAR) AS _guid,
    CAST(CASE WHEN quality = 0 THEN 0 WHEN toxic = 1 THEN 1 ELSE 2 END AS INTEGER) AS significance,
    split_part(text, chr(10), 1) AS title, concat(lang, ' ', source) AS orgs, lang AS topics, text AS body,
    CAST(doc_id * 3600 + 1430439473 AS VARCHAR) AS "date.time"
  FROM documents JOIN labels USING (doc_id))
"""


def test_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Hold-out ids: the labelled documents marked toxic."""
    return table(spark, sf, "labels").where("toxic = 1").select(F.col("doc_id").cast("string").alias("id"))


TEST_IDS_SQL = "test_ids AS (SELECT CAST(doc_id AS VARCHAR) AS id FROM labels WHERE toxic = 1)"


def source_tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The four database tables behind the corpus."""
    documents, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    talks = table(spark, sf, "conversations").withColumn("ID", F.col("conv_id") * 1000 + F.col("turn"))
    return {
        "swift": documents.select(
            F.col("doc_id").alias("ID"), F.col("text").alias("story"),
            F.when(F.col("lang") == "en", 1).otherwise(0).alias("in_sample")),
        "swift_excel": documents.join(labels.where("quality = 1"), "doc_id").select(
            F.col("doc_id").alias("ID"), F.col("text").alias("story"), F.col("doc_id").alias("swiftID")),
        "nsc": talks.select(
            "ID", F.col("role").alias("lead_parag"), F.col("text").alias("body"),
            F.when(F.col("turn") > 0, 1).otherwise(0).alias("in_sample")),
        "nsc_excel": talks.where("role = 'user'").select(
            "ID", F.col("text").alias("body"), F.col("ID").alias("nscID")),
    }


def _corpus_sql(sampled: bool) -> str:
    sw, ns = ("AND lang = 'en'", "AND turn > 0") if sampled else ("", "")
    return f"""
corpus AS (
  SELECT 'se' AS source_id, doc_id, text AS body FROM documents JOIN labels USING (doc_id) WHERE quality = 1
  UNION ALL
  SELECT 'ne', conv_id * 1000 + turn, text FROM conversations WHERE role = 'user'
  UNION ALL
  SELECT 'sw', doc_id, text FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1) {sw}
  UNION ALL
  SELECT 'ns', conv_id * 1000 + turn, role || ' ' || text FROM conversations WHERE role <> 'user' {ns})
"""


CORPUS_SQL = _corpus_sql(False)
SAMPLED_CORPUS_SQL = _corpus_sql(True)
DOCS_SQL = "docs AS (SELECT source AS source_id, doc_id, text AS body FROM documents)"

STOP_SQL = ", ".join(f"'{w}'" for w in STOP_WORDS)


def tokens_sql(text: str) -> str:
    """SQL for the token list of a text expression."""
    return (
        rf"list_filter(regexp_extract_all(lower({text}), '[\p{{L}}\p{{Nl}}\p{{No}}_]+'), "
        f"lambda t: length(t) BETWEEN 2 AND 15 AND NOT starts_with(t, '_') AND t NOT IN ({STOP_SQL}))"
    )


def token_ctes(source: str = "docs", ids: str = "source_id, doc_id") -> str:
    """CTEs tok (token lists), tok_counts and bg_counts over a (ids, body) relation."""
    return f"""
tok AS (SELECT {ids}, {tokens_sql('body')} AS a FROM {source} WHERE length(body) > 0),
tok_rows AS (SELECT {ids}, unnest(a) AS term FROM tok),
tok_counts AS (SELECT {ids}, term, count(*) AS tf FROM tok_rows GROUP BY ALL),
bg_rows AS (SELECT {ids}, unnest(list_zip(a[:-2], a[2:])) AS p FROM tok WHERE len(a) > 1),
bg_counts AS (SELECT {ids}, p[1] AS g1, p[2] AS g2, count(*) AS c FROM bg_rows GROUP BY ALL)
"""
