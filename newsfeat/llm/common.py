"""What the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.operators.joins import key_bitmap, with_hit

#: White space between words: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """A-Z only; other letters stay."""
    return F.translate(text, UPPER, LOWER)


def words_of(text: Column) -> Column:
    """The words of a text; none for null or blank text."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(F.coalesce(bare, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(bare, SPACE_RUN))


def split_by_key(rows: DataFrame, wanted: DataFrame, key: str) -> tuple[DataFrame, DataFrame | None]:
    """(rows whose `key` may be one of `wanted`, rows whose key surely is none), told by a bitmap of bounded size.

    Nothing is shuffled. With too many keys for the bitmap all rows may match, and the second part is None.
    """
    bitmap = key_bitmap(wanted, rows, [key])
    if bitmap is None:
        return rows, None
    marked = with_hit(rows, bitmap, [key])
    return marked.where("__hit").drop("__hit"), marked.where("NOT __hit").drop("__hit")


def prefix_bases(totals: Iterable[tuple[int, int]]) -> tuple[list[tuple[int, int]], int]:
    """(part, total) of every part -> (part, sum of the totals of smaller parts), and the whole sum.

    One number for each partition of a written table: the driver's share does not grow with the rows.
    """
    out, total = [], 0
    for part, size in sorted(totals):
        out.append((part, total))
        total += size
    return out, total
