"""Cell and text cleaning, as Column -> Column expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The default tag pattern, the date formats of the two feeds, and the
# white space that is trimmed from cells.
TAG_PATTERN = r"<[(A-Z)|(\.)]*>"
DATE_FORMATS = {"xml": "yyyyMMddHHmmss", "json": "yyyy-MM-dd'T'HH:mm:ss"}
WHITE_SPACE = r"[\s\p{Z}\x0b\x1c-\x1f\x85]"


def sanitise(c: Column, wrap: bool = True) -> Column:
    """Line breaks and tabs become spaces, double quotes single; `wrap` adds outer quotes."""
    clean = F.translate(c, '\r\t\n"', "   '")
    return F.concat(F.lit('"'), clean, F.lit('"')) if wrap else clean


def ascii_replace(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "?")


def ascii_drop(c: Column) -> Column:
    return F.regexp_replace(c, r"[^\x00-\x7F]", "")


def strip_tags(c: Column, pattern: str = TAG_PATTERN) -> Column:
    return F.regexp_replace(c, pattern, "")


def tags_changed(c: Column, pattern: str = TAG_PATTERN) -> Column:
    return ~F.equal_null(strip_tags(c, pattern), c)


def to_unix_seconds(c: Column, doc_type: str) -> Column:
    """Feed date to Unix seconds as text, always read as UTC; unreadable dates give null.

    Anything from the first point on is ignored: fractions in one feed, the `.0` of
    dates stored as numbers in the other.
    """
    if doc_type not in DATE_FORMATS:
        raise ValueError(f"doc_type must be one of {sorted(DATE_FORMATS)}")
    whole = F.concat(F.substring_index(c, ".", 1), F.lit("+00:00"))
    parsed = F.try_to_timestamp(whole, F.lit(DATE_FORMATS[doc_type] + "XXX"))
    return F.unix_seconds(parsed).cast("string")


def _trim(c: Column) -> Column:
    return F.regexp_replace(c, f"^{WHITE_SPACE}+|{WHITE_SPACE}+$", "")


def unquote(c: Column) -> Column:
    quote = F.lit('"')
    return F.btrim(_trim(F.btrim(c, quote)), quote)


def unlist(c: Column) -> Column:
    """Strip the list brackets, then drop every u, quote and comma (inside words too)."""
    bare = F.btrim(F.btrim(c, F.lit("[")), F.lit("]"))
    return F.translate(bare, "u',", "")


def flatten_list_literal(c: Column) -> Column:
    """`[u'A', u'B']` becomes `A B`; other cells only lose their outer single quotes."""
    quote = F.lit("'")
    bare = F.btrim(c, quote)
    inner = F.substring(bare, F.lit(3), F.greatest(F.length(bare) - 4, F.lit(0)))

    def element(e: Column) -> Column:
        return F.btrim(F.when(e.startswith("u"), F.substring(e, 2, 2**30)).otherwise(e), quote)

    flat = F.array_join(F.transform(F.split(inner, ", "), element), " ")
    return F.when(bare.startswith("[") & bare.endswith("]"), flat).otherwise(bare)


def join_list(c: Column) -> Column:
    """A JSON list of texts becomes one space-joined text; anything else stays as it is."""
    items = F.from_json(c, "array<string>")
    return F.when(c.startswith("["), F.coalesce(F.array_join(items, " "), c)).otherwise(c)


def with_default(c: Column, default: str = "NULL") -> Column:
    return F.coalesce(c, F.lit(default))


def lead_and_body(lead: Column, body: Column) -> Column:
    """Null when either part is null."""
    return F.concat(lead, F.lit(" "), body)


def clean_columns(df: DataFrame, columns: list[str], pattern: str = TAG_PATTERN) -> DataFrame:
    """Remove tags from the named columns."""
    return df.withColumns({c: strip_tags(F.col(f"`{c}`"), pattern) for c in columns})


def clean_sheet_cell(c: Column) -> Column:
    return ascii_replace(flatten_list_literal(sanitise(c, wrap=False)))
