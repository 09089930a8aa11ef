"""The corpus pipeline: quality rules, exact dedup, near dedup, secret redaction, packing.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept and is written
as Parquet before the next one reads it. All but the last return the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.llm import line_quality, packing, refine_dedup, secret_scan, setsketch
from newsfeat.llm.common import split_by_key, table
from newsfeat.session import stored


def _with_text(rows: DataFrame, text: Column, columns: list[str]) -> DataFrame:
    """The packed rows (column row) with another text and the character count that goes with it."""
    row = F.col("row").withField("text", text)
    if "n_chars" in columns:
        row = row.withField("n_chars", F.length(text).cast("long"))
    return rows.select(row.alias("row")).select("row.*")


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected documents go; the lines that failed go from the others."""
    judged = line_quality.judge_documents(docs.select(F.struct("*").alias("row"), "text"))
    # beside a number that depends on the task the filter is not pushed into the rules, whose expressions it would repeat
    rows = judged.select("row", "clean_text", "kept", F.monotonically_increasing_id().alias("place"))
    return _with_text(rows.where("kept AND place >= 0"), F.col("clean_text"), docs.columns)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of equal texts stays, the one with the smallest doc_id."""
    return refine_dedup.drop_equal(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest doc_id; null is the largest.

    doc_id may be null or repeat, so a row is told by doc_id and text together; equal texts went before.
    """
    sha = F.unhex(F.sha2(F.coalesce("text", F.lit("")), 256))
    rows = docs.select(F.struct("*").alias("row"), "text", F.struct(
        F.col("doc_id").isNull().alias("blank"), F.col("doc_id").alias("id"), sha.alias("sha")).alias("name"))
    gone = setsketch.near_groups(rows, "name").where("NOT kept").select("name").distinct()
    gone = stored(gone, "gone")
    spot = F.xxhash64("name").alias("spot")
    # rows that surely stay are not moved
    maybe, sure = split_by_key(rows.select("row", "name", spot), gone.select(spot), "spot")
    kept = maybe.join(gone, "name", "left_anti").select("row.*")
    return kept if sure is None else kept.unionByName(sure.select("row.*"))


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Live-looking secrets are replaced by a mark; widely copied examples stay. Sources are owners, their languages repositories."""
    rows = docs.select(F.struct("*").alias("row"), "text", "source", "lang", F.col("doc_id").alias("id"),
                       F.xxhash64("text").alias("hash"))
    found = secret_scan.scan_secrets(rows, repository=F.concat_ws("/", "source", "lang"), carry=["id", "hash"])
    live = stored(found.where("exists(secrets, s -> s.live)").dropDuplicates(["id", "hash"]), "live")
    spot = F.xxhash64("id", "hash").alias("spot")
    # only texts that may hold a live secret meet its places
    maybe, clean = split_by_key(rows.select("row", "text", "id", "hash", spot), live.select(spot), "spot")
    places = live.toDF("its_id", "its_hash", "secrets")
    met = maybe.join(places, maybe["id"].eqNullSafe(places["its_id"]) & (maybe["hash"] == places["its_hash"]), "left")
    text = F.when(F.col("secrets").isNull(), F.col("text")).otherwise(
        secret_scan.redacted(F.col("text"), F.col("secrets")))
    out = _with_text(met, text, docs.columns)
    # n_chars is told anew for every row, as in the rows that met a secret
    return out if clean is None else out.unionByName(_with_text(clean, F.col("text"), docs.columns))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of fixed-length token sequences; the ids themselves come with packing.pack(with_ids=True)."""
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


STAGES = [("quality", quality), ("exact", exact), ("near", near), ("secrets", secrets), ("pack", pack)]

#: Tokenising is not expressible in SQL; a test holds the rows against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents; every stage but the last is written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
