"""A corpus that grows batch by batch: ids that stay, and counts of documents that were not there before."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.functions.tokens import STOP_WORDS
from newsfeat.operators.corpus import dense_ids, extract_grams, packed_lists, tokens_of
from newsfeat.operators.joins import first_match, lookup_join
from newsfeat.session import stored
from newsfeat.sources.readers import path_exists

IDS = ["source_id", "doc_id"]
_TABLES = {
    "dictionary": "i bigint, t string",
    "counts": "source_id {source}, g1 bigint, g2 bigint, c bigint, df bigint",
    "seen": "source_id {source}, doc_id {doc}",
}


def _batches(spark: SparkSession, folder: str) -> list[str]:
    """Folders of the complete batches; each ends with a marker, so a batch that broke off is written again."""
    out = []
    while path_exists(spark, f"{folder}/batch-{len(out)}/done"):
        out.append(f"{folder}/batch-{len(out)}")
    return out


def _read(spark: SparkSession, batches: list[str], name: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*[f"{b}/{name}" for b in batches]) if batches else \
        spark.createDataFrame([], schema)


def extend_ids(dictionary: DataFrame, terms: DataFrame) -> DataFrame:
    """Dictionary rows (i, t) for the terms (t) that have none: the next ids, in term order; known ids stay as they are."""
    fresh = stored(lookup_join(terms.select("t").distinct(), dictionary.select("t"), "t", "left_anti"), "new-terms")
    last = dictionary.agg(F.coalesce(F.max("i"), F.lit(0)).alias("i")).first()["i"]
    return dense_ids(fresh, "t").select((F.col("i") + last).alias("i"), "t")


def add_batch(spark: SparkSession, folder: str, docs: DataFrame, stem: bool = True,
              stop_words: list[str] = STOP_WORDS, max_rows: int | None = None) -> int:
    """Add documents (source_id, doc_id, body) to the corpus below `folder`; returns how many were new.

    Of a repeated (source_id, doc_id) one text counts, the first by content, and none that an earlier batch
    had. Only what the batch adds is written, so its cost does not grow with the corpus but
    for the lookup of ids. A document without a full id cannot be known again and is always new.
    """
    done = _batches(spark, folder)
    kinds = {"source": docs.schema["source_id"].dataType.simpleString(), "doc": docs.schema["doc_id"].dataType.simpleString()}
    schema = {name: text.format(**kinds) for name, text in _TABLES.items()}
    seen, known = (_read(spark, done, name, schema[name]) for name in ("seen", "dictionary"))
    named = docs.select(*IDS, "body").where("source_id IS NOT NULL AND doc_id IS NOT NULL")
    # few ids come twice: only their texts are moved to be compared
    often = named.groupBy(*IDS).agg(F.count("*").alias("n")).where("n > 1").select(*IDS)
    often = stored(lookup_join(often, seen, IDS, "left_anti", max_rows=max_rows), "repeated")
    once = lookup_join(named, seen.unionByName(often), IDS, "left_anti", max_rows=max_rows)
    again = first_match(lookup_join(named, often, IDS, "left_semi", max_rows=max_rows), IDS, F.struct(F.xxhash64("body"), "body"))
    fresh = once.unionByName(again).unionByName(docs.select(*IDS, "body").where("source_id IS NULL OR doc_id IS NULL"))
    tokens = F.when(F.length("body") > 0, tokens_of(F.col("body"), stem, stop_words))
    fresh = stored(packed_lists(fresh.select(*IDS, tokens.alias("tokens")), IDS), "fresh")

    path = f"{folder}/batch-{len(done)}"
    extend_ids(known, fresh.select(F.explode("words").alias("t"))).write.mode("overwrite").parquet(f"{path}/dictionary")
    every = _read(spark, [*done, path], "dictionary", schema["dictionary"])
    extract_grams(docs, every, stem=stem, max_rows=max_rows, stop_words=stop_words, packed=fresh).write.mode("overwrite").parquet(f"{path}/counts")
    fresh.select(F.inline("ids")).where("source_id IS NOT NULL AND doc_id IS NOT NULL").write.mode("overwrite").parquet(f"{path}/seen")
    count = fresh.agg(F.coalesce(F.sum(F.size("ids")), F.lit(0))).first()[0]
    spark.createDataFrame([(count,)], "documents bigint").coalesce(1).write.mode("overwrite").parquet(f"{path}/done")
    return count


def read_corpus(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Dictionary (i, t) and the counts (source_id, g1, g2, c, df) of all complete batches, summed."""
    batches = _batches(spark, folder)
    if not batches:
        raise ValueError(f"{folder}: no complete batch")
    dictionary = spark.read.parquet(*[f"{b}/dictionary" for b in batches])
    counts = spark.read.parquet(*[f"{b}/counts" for b in batches])
    return dictionary, counts.groupBy("source_id", "g1", "g2").agg(F.sum("c").alias("c"), F.sum("df").alias("df"))
