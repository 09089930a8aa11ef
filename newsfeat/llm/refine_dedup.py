"""Exact dedup by progressive refinement: length, then a hash of the beginning, then the full hash.

Only rows whose (length, beginning) occurs again have their whole text hashed. Which ones those
are is told by a bitmap of fixed size, so texts are never shuffled to find out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.common import SPACE_RUN
from newsfeat.session import stored

PREFIX = 64
#: Bits of the bitmap: at most 2,048 pages of 4 KB, 8 MB, whatever the corpus size.
PAGE_BITS, PAGES = 32_768, 2_048


def normalised(text: Column) -> Column:
    """Null counts as empty; every run of white space becomes one space."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE_RUN, " ")


def _slot(size: Column, beginning: Column) -> Column:
    return F.pmod(F.xxhash64(size, beginning), F.lit(PAGE_BITS * PAGES))


def repeated_slots(docs: DataFrame, text: str) -> DataFrame:
    """Bitmap pages (page, bits) with a bit for each (length, beginning) that more than one row has.

    Two refinements: rows alone in their length are out before beginnings are compared.
    """
    norm = normalised(F.col(text))
    slim = stored(docs.select(F.length(norm).alias("size"),
                              F.xxhash64(F.substring(norm, 1, PREFIX)).alias("beginning")), "lengths")
    lengths = slim.groupBy("size").agg(F.count("*").alias("n")).where("n > 1").select("size")
    same = slim.join(lengths, "size", "left_semi").groupBy("size", "beginning").count().where("count > 1")
    slot = same.select(_slot(F.col("size"), F.col("beginning")).alias("slot"))
    return slot.groupBy(F.expr(f"slot div {PAGE_BITS}").alias("page")).agg(
        F.expr(f"bitmap_construct_agg(slot % {PAGE_BITS})").alias("bits"))


def split_by_slot(docs: DataFrame, text: str, pages: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows that may have an equal, rows that surely have none), both with _size and _norm added.

    Two texts in one slot by chance only cost one hash each; the full hash decides.
    """
    norm = normalised(F.col(text))
    rows = docs.select("*", norm.alias("_norm"))
    slot = _slot(F.length("_norm"), F.xxhash64(F.substring("_norm", 1, PREFIX)))
    rows = rows.withColumns({"_size": F.length("_norm"), "_slot": slot})
    rows = rows.withColumn("_page", F.expr(f"_slot div {PAGE_BITS}"))
    rows = rows.join(F.broadcast(pages.withColumnRenamed("page", "_page")), "_page", "left")
    byte = F.conv(F.hex(F.expr(f"substring(bits, cast((_slot % {PAGE_BITS}) div 8 as int) + 1, 1)")), 16, 10)
    bit = byte.cast("int").bitwiseAND(F.expr("shiftleft(1, cast(_slot % 8 as int))")) != 0
    rows = rows.withColumn("_again", F.coalesce(bit, F.lit(False))).drop("bits", "_page", "_slot")
    return rows.where("_again").drop("_again"), rows.where("NOT _again").drop("_again")


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", hash_all: bool = False) -> DataFrame:
    """One row per input row: `key`, keep_id, group_size, kept, text_sha256.

    Rows are equal when their texts are after white-space runs become one space; null is empty.
    Of equal rows the one with the smallest key stays (nulls last); of rows that repeat that key
    exactly one stays. Rows that were never hashed have a null text_sha256 unless `hash_all`.
    """
    rows = docs.select(F.col(key).alias("key"), F.col(text).alias("text"))
    pages = stored(repeated_slots(rows, "text"), "slots")
    again, alone = split_by_slot(rows, "text", pages)
    digest = F.sha2(F.col("_norm"), 256)
    again = stored(again.select(F.monotonically_increasing_id().alias("rid"), "key", digest.alias("text_sha256")),
                   "hashed")
    first = F.min(F.struct(F.col("key").isNull().alias("blank"), "key", "rid")).alias("first")
    groups = again.groupBy("text_sha256").agg(first, F.count("*").alias("group_size"))
    met = again.join(groups, "text_sha256").select(
        "key", F.col("first.key").alias("keep_id"), "group_size", (F.col("rid") == F.col("first.rid")).alias("kept"),
        "text_sha256")
    rest = alone.select("key", F.col("key").alias("keep_id"), F.lit(1).cast("long").alias("group_size"),
                        F.lit(True).alias("kept"),
                        (digest if hash_all else F.lit(None).cast("string")).alias("text_sha256"))
    return met.unionByName(rest).withColumnRenamed("key", key)


def drop_equal(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows of `docs` that stay, with their columns. Rows that cannot have an equal are not moved.

    A null text is empty, a null key counts as the largest. Columns may have any name.
    """
    packed = docs.select(F.struct("*").alias("row"), F.col(text).alias("text"), F.col(key).alias("key"))
    pages = stored(repeated_slots(packed, "text"), "slots")
    again, alone = split_by_slot(packed, "text", pages)
    again = again.withColumn("_sha", F.sha2(F.col("_norm"), 256))
    order = F.struct(F.col("key").isNull().alias("blank"), F.col("key").alias("k"))
    winners = again.groupBy("_sha").agg(F.min(order).alias("_first"))
    kept = again.join(winners, "_sha").where(F.col("key").eqNullSafe(F.col("_first.k")))
    # rows that repeat both the key and the text: one of them
    kept = kept.dropDuplicates(["_sha"])
    return kept.select("row.*").unionByName(alone.select("row.*"))
