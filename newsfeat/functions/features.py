"""Count, pattern, label and scaling features."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Name -> (pattern, idf weight).
PATTERNS = {
    "numeric.percent": (r"\d+\.?\d* ?%", 0.9554014),
    "numeric.dollar.illi": (r"\$\d+\.?\d*[^\n]{0,6}illi", 1.2646519),
    "numeric.comma": (r"[^\$]\d+,\d+", 0.8583480),
}

# Column -> (mean, standard deviation) of the training data.
TRAINING_STATS = {
    "story.length": (4645.554129, 6796.77025),
    "numeric.percent": (8.182659, 57.78209),
    "numeric.comma": (4.401744, 29.81231),
}

# Columns scaled on training data, columns dropped and columns renamed
# in the scored output, and the named features used for training.
SCALED_COLUMNS = ["story_word_count", "topics_count", "title_word_count", "org_count", "story.length"]
DROPPED_COLUMNS = ["lead parag", "RICs", "source", "person perm ids", "story body"]
RENAMED_COLUMNS = {
    "story date": "date.time",
    "journal code": "journal.code",
    "OA perm ids": "organizations.codes",
    "RCS": "topics.codes",
    "body": "story.body",
    "title": "story.title",
}
NAMED_FEATURES = [
    "sentiment_compound", "sentiment_neg", "sentiment_neu", "sentiment_pos",
    "org_count", "story_word_count", "topics_count", "title_word_count", "hour",
]


def count_feature(c: Column, sep: str | None = None) -> Column:
    """Pieces between separators (empty ones too), or characters; null counts as 0."""
    count = F.size(F.split(c, re.escape(sep))) if sep else F.length(c)
    return F.when(c.isNull(), 0).otherwise(count)


def pattern_count(c: Column, name: str) -> Column:
    pattern, idf = PATTERNS[name]
    return F.regexp_count(c, F.lit(pattern)) * F.lit(idf)


def prefix(c: Column, n: int) -> Column:
    return F.substring(c, 1, n)


def shorten(c: Column, n: int = 1000) -> Column:
    return F.when(F.length(c) <= n, c).otherwise(F.concat(F.substring(c, 1, n), F.lit("...")))


def hour_of(c: Column, zone: str | None = None) -> Column:
    """Hour of Unix seconds held as text, in the session time zone or a named one."""
    seconds = c.cast("bigint")
    if zone is None:
        return F.hour(F.timestamp_seconds(seconds))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    utc = epoch + F.make_dt_interval(F.floor(seconds / 86400), secs=F.pmod(seconds, F.lit(86400)))
    return F.hour(F.convert_timezone(F.lit("UTC"), F.lit(zone), utc))


def binary_labels(df: DataFrame, significance: str = "significance") -> DataFrame:
    label = F.col(f"`{significance}`")
    return df.withColumns({
        "is_significant": F.when(label == 0, 0).otherwise(1),
        "is_very_significant": F.when(label == 2, 1).otherwise(0),
    })


def add_field(df: DataFrame, field: str, new: str, f: Callable[[Column], Column]) -> DataFrame:
    return df.withColumn(new, f(F.col(f"`{field}`")))


def count_columns(df: DataFrame) -> DataFrame:
    """The five count features of an article table."""
    for field, new, sep in [
        ("story body", "story_word_count", " "),
        ("RCS", "topics_count", " "),
        ("title", "title_word_count", " "),
        ("OA perm ids", "org_count", " "),
        ("story body", "story.length", None),
    ]:
        df = add_field(df, field, new, lambda c, s=sep: count_feature(c, s))
    return df


def pattern_columns(df: DataFrame, field: str = "body") -> DataFrame:
    return df.withColumns({name: pattern_count(F.col(f"`{field}`"), name) for name in PATTERNS})


def final_columns(df: DataFrame) -> DataFrame:
    """Shorten the body, drop the raw columns and give the rest their output names."""
    return (
        df.withColumn("body", shorten(F.col("body")))
        .drop(*DROPPED_COLUMNS)
        .withColumnsRenamed(RENAMED_COLUMNS)
    )


def zscore_fit(df: DataFrame, columns: Iterable[str] = SCALED_COLUMNS) -> DataFrame:
    """Scale by the mean and sample deviation of the data itself.

    The statistics are one scalar subquery, so nothing is collected or cross-joined.
    """
    columns = list(columns)
    values = [F.col(f"`{c}`").cast("double") for c in columns]
    stats = df.agg(F.struct(
        *[F.avg(v).alias(f"m{i}") for i, v in enumerate(values)],
        *[F.stddev_samp(v).alias(f"s{i}") for i, v in enumerate(values)],
    ).alias("stats")).scalar()
    return df.withColumns({
        c: (values[i] - stats[f"m{i}"]) / stats[f"s{i}"] for i, c in enumerate(columns)
    })


def zscore_frozen(df: DataFrame, stats: dict[str, tuple[float, float]] = TRAINING_STATS) -> DataFrame:
    return df.withColumns({
        c: (F.col(f"`{c}`") - F.lit(mean)) / F.lit(std) for c, (mean, std) in stats.items()
    })


def select_features(df: DataFrame, vocabulary: Iterable[str], extra: Iterable[str] = NAMED_FEATURES,
                    labels: Iterable[str] = ("significance", "is_significant", "is_very_significant"),
                    ) -> list[str]:
    """Columns of `df` that are vocabulary terms or named features, without the labels."""
    wanted = (set(vocabulary) | set(extra)) - set(labels)
    return [c for c in df.columns if c in wanted]


def schema_diff(spark: SparkSession, a: DataFrame, b: DataFrame) -> DataFrame:
    """Names of columns in `a` but not in `b`."""
    missing = sorted(set(a.columns) - set(b.columns))
    return spark.createDataFrame([(name,) for name in missing], "column string")
