"""Writers for scored, raw, rolling, split and label output."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.functions.cleaning import ascii_drop, sanitise
from newsfeat.session import stored
from newsfeat.sources.readers import ARTICLE_COLUMNS

# Data rows per rolling file, and the columns of the feature subset.
ROWS_PER_FILE = 10_000
SUBSET_COLUMNS = [
    "_guid", "sentiment_pos", "sentiment_neg", "sentiment_neu", "sentiment_compound",
    "story_word_count", "topics_count", "title_word_count", "org_count",
]


# Cells are written as they are: Spark's writer would trim them and spell out empty ones.
_AS_IS = {
    "header": True, "quote": '"', "escape": '"', "encoding": "UTF-8", "emptyValue": "",
    "ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False,
}


def _quoted(df: DataFrame, sep: str):
    return df.write.mode("overwrite").options(**_AS_IS, sep=sep, quoteAll=True)


def write_quoted(df: DataFrame, path: str, sep: str = ",") -> None:
    """CSV with a header and every cell quoted."""
    _quoted(df, sep).csv(path)


def write_raw(df: DataFrame, path: str, sep: str = ",") -> None:
    """The article table with one-line cells and without non-ASCII characters."""
    cells = [ascii_drop(sanitise(F.col(f"`{c}`"), wrap=False)).alias(c) for c in ARTICLE_COLUMNS]
    write_quoted(df.select(*cells), path, sep)


def write_rolling(df: DataFrame, path: str, rows: int = ROWS_PER_FILE, file_limit: int | None = None) -> None:
    """Tab files of at most `rows` rows; `file_limit` ends after that many files."""
    if file_limit:
        df = df.limit(rows * file_limit)
    _quoted(df, "\t").options(lineSep="\t\n", maxRecordsPerFile=rows).csv(path)


def write_ids(df: DataFrame, path: str, column: str = "scrollid") -> None:
    df.select(column).write.mode("overwrite").text(path)


def write_tab(df: DataFrame, path: str) -> None:
    """Tab-separated text whose lines end with a tab."""
    df.write.mode("overwrite").options(**_AS_IS, sep="\t", lineSep="\t\n").csv(path)


def write_split(df: DataFrame, path: str, sep: str = "\t") -> None:
    """`<path>_train` and `<path>_test` from the `split` column."""
    for name in ("train", "test"):
        _quoted(df.where(F.col("split") == name).drop("split"), sep).csv(f"{path}_{name}")


def write_subset(df: DataFrame, path: str) -> None:
    write_quoted(df.select(*SUBSET_COLUMNS), path)


def write_labels(df: DataFrame, path: str, sep: str = ",") -> None:
    write_quoted(df.select("guid", "significance"), path, sep)


def replace_table(df: DataFrame, path: str) -> None:
    """Replace the table at `path`; `df` may read that same table.

    The rows are first written into the shared folder, so nothing is lost that they come from.
    """
    stored(df, "replacement").write.mode("overwrite").parquet(path)


def append_table(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
