"""Readers for news files: XML, JSON, CSV, spreadsheet exports, feature tables, labels.

Each format has a function on string columns (`parse_*`, `*_articles`) and a reader on
paths that uses it.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.functions.cleaning import (ascii_replace, clean_sheet_cell, join_list, sanitise, strip_tags,
                                         to_unix_seconds, unlist, unquote, with_default)
from newsfeat.functions.json_lists import objects_of_list

# The article table, the XPath of every XML field, the JSON field behind
# every article column, the CSV renames, and the columns of the bulk JSON conversion.
ARTICLE_COLUMNS = [
    "guid", "journal code", "source", "story date", "RICs", "person perm ids", "OA perm ids", "RCS",
    "title", "lead parag", "story body",
]
RECORD_TAG = "n-document"
XPATHS = {
    "guid": "@guid",
    "journal code": "n-docbody/document/pub-info/src-data/src-journal-code/text()",
    "source": "n-docbody/document/supplier-info/supplier-num/@nitf-regsrc",
    "story date": "n-metadata/metadata.block/md.dates/md.publisheddatetime/text()",
    "RICs": "n-docbody/document/indexing/extraction-terms/extr-company-block//ric/@norm",
    "person perm ids": "n-docbody/document/indexing/extraction-terms/extr-person-block//person-perm-id/text()",
    "OA perm ids": "n-docbody/document/indexing/extraction-terms/extr-company-block//norm-company/@oa-id",
    "RCS": "n-docbody/document/indexing/classification-terms/rcs-block//rcs/text()",
    "title": "n-metadata/metadata.block/md.descriptions/md.title/text()",
    "lead parag": 'n-docbody/document/content/text[@type="lead-para"]/descendant::*/text()',
    "story body": 'n-docbody/document/content/text[@type="body"]/descendant::*/text()',
}
FIRST_PARAGRAPH = "n-docbody/document/content/text/p"
JSON_FIELDS = {
    "guid": "scrollid", "journal code": "sources", "story date": "maindocdate",
    "OA perm ids": "hiorgid", "RCS": "tn2", "title": "subheadline", "story body": "data",
}
SWIFT_RENAMES = {
    "scrollid": "guid", "sources": "journal code", "maindocdate": "story date", "hiorgid": "RICs",
    "tn2": "RCS", "subheadline": "title", "data": "story body",
}
SWIFT_BLANK = ["source", "person perm ids", "OA perm ids", "lead parag"]
NR_RENAMES = {"story date time": "story date", "story title": "title"}
BULK_FIELDS = ["scrollid", "maindocdate", "hiorgid", "i2", "if3", "sources", "subheadline", "tn2", "data"]
RATING_NAMES = {"Significance Rating": "Significance", "Significance Rating ": "Significance"}
LABEL_SCHEMA = "array<struct<guid:struct<guid:string>,significance:string>>"

_CORRUPT = "_corrupt_record"


# --- XML -------------------------------------------------------------------------

def xml_records(lines: DataFrame, column: str = "value") -> DataFrame:
    """Whole records out of text that was split at the closing record tag."""
    # a wrapper's tag may begin alike: the name has to end there
    start = F.regexp_instr(F.col(column), F.lit(rf"<{RECORD_TAG}(?=[\s>/])"))
    record = F.concat(F.substring(F.col(column), start, F.length(column)), F.lit(f"</{RECORD_TAG}>"))
    return lines.where(start > 0).select(record.alias("xml"))


def flag_malformed_xml(df: DataFrame, xml_col: str) -> DataFrame:
    """Add `malformed`, and blank the XML of such rows so that XPath never sees it."""
    probe = F.from_xml(F.col(xml_col), f"struct<_guid string, {_CORRUPT} string>",
                       {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    flagged = df.withColumn("malformed", probe[_CORRUPT].isNotNull() | F.col(xml_col).isNull())
    return flagged.withColumn(xml_col, F.when(~F.col("malformed"), F.col(xml_col)))


def xml_field(xml: Column, path: str) -> Column:
    """All matches of an XPath below the record, joined by spaces."""
    return F.array_join(F.xpath(xml, F.lit(f"/{RECORD_TAG}/{path}")), " ")


def parse_xml(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """XML records to the article table, other columns kept; `malformed` rows have nulls."""
    rest = [c for c in df.columns if c != xml_col]
    flagged = flag_malformed_xml(df, xml_col)
    fields = flagged.select(*rest, "malformed", *[
        xml_field(F.col(xml_col), path).alias(name) for name, path in XPATHS.items()])
    return fields.withColumns({
        "lead parag": strip_tags(F.col("lead parag")),
        "story body": strip_tags(F.col("story body")),
        "story date": to_unix_seconds(F.col("story date"), "xml"),
    })


def first_paragraph(df: DataFrame, xml_col: str = "xml") -> DataFrame:
    """Text of the first body paragraph as `paragraph`."""
    flagged = flag_malformed_xml(df, xml_col)
    text = F.xpath_string(F.col(xml_col), F.lit(f"/{RECORD_TAG}/{FIRST_PARAGRAPH}"))
    return flagged.withColumn("paragraph", text).drop(xml_col)


def scan_xml(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All records of XML files with their `malformed` flag; files are split across tasks."""
    lines = spark.read.option("lineSep", f"</{RECORD_TAG}>").text(path)
    return parse_xml(xml_records(lines))


def read_xml(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return accepted(scan_xml(spark, path))


# --- JSON ------------------------------------------------------------------------

def _json_articles(df: DataFrame, rest: list[str]) -> DataFrame:
    """Raw JSON fields to the article table; absent fields are empty."""

    def column(name: str) -> Column:
        field = JSON_FIELDS.get(name)
        if field is None:
            return F.lit("")
        value = join_list(F.col(field))
        if name == "story date":
            return to_unix_seconds(value, "json")
        value = strip_tags(value) if name in ("title", "story body") else value
        return with_default(value, "")

    return df.select(*rest, *[column(name).alias(name) for name in ARTICLE_COLUMNS])


def _json_schema(fields: list[str]) -> str:
    return ", ".join(f"`{f}` string" for f in [*fields, _CORRUPT])


def json_objects(df: DataFrame, json_col: str, fields: list[str]) -> DataFrame:
    """One row per JSON object of a text holding an object or a list, with `malformed`.

    A broken object of a list is one malformed row; the others are read.
    """
    rest = [c for c in df.columns if c != json_col]
    text = F.col(json_col)
    is_list = F.ltrim(text).startswith("[")
    # a Python function gets all rows, whatever the branch, so what is no list goes as null
    items = F.when(is_list, objects_of_list(F.when(is_list, text), fields)).otherwise(F.array(text))
    rows = df.select(*rest, F.explode(F.coalesce(items, F.array(F.lit(None).cast("string")))).alias("__object"))
    parsed = F.from_json("__object", _json_schema(fields),
                         {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT})
    rows = rows.withColumn("__parsed", parsed)
    return rows.select(*rest, "__parsed.*", (F.col("__object").isNull() | F.col(f"__parsed.{_CORRUPT}").isNotNull())
                       .alias("malformed")).drop(_CORRUPT)


def parse_json(df: DataFrame, json_col: str = "json") -> DataFrame:
    """JSON texts to the article table, other columns kept, with `malformed`."""
    rest = [c for c in df.columns if c != json_col]
    rows = json_objects(df, json_col, list(JSON_FIELDS.values()))
    return _json_articles(rows, [*rest, "malformed"])


def _scan_json_fields(spark: SparkSession, path: str | list[str], fields: list[str]) -> DataFrame:
    """fields, `malformed` and the file's `__name` of every object; a file is one text, as a list cannot be cut blindly."""
    texts = spark.read.text(path, wholetext=True).select("value", F.col("_metadata.file_name").alias("__name"))
    return json_objects(texts, "value", fields)


def scan_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All objects of JSON files (one object or one list each) with their `malformed` flag."""
    return _json_articles(_scan_json_fields(spark, path, list(JSON_FIELDS.values())), ["malformed"])


def read_json(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return accepted(scan_json(spark, path))


def bulk_cells(df: DataFrame, id_col: str, fields: list[str]) -> DataFrame:
    """Clean cells of the bulk conversion: fileID, then the fields."""
    cells = [
        ascii_replace(sanitise(with_default(join_list(F.col(f))), wrap=False)).alias(f) for f in fields
    ]
    return df.select(F.split(F.col(id_col), r"\.")[0].alias("fileID"), *cells)


def read_json_folder(spark: SparkSession, path: str, fields: list[str] = BULK_FIELDS) -> DataFrame:
    """One object per file; the file name up to its first point is the id."""
    return bulk_cells(accepted(_scan_json_fields(spark, path, fields)), "__name", fields)


# --- CSV and spreadsheet exports ---------------------------------------------------

def header_groups(spark: SparkSession, path: str | list[str]) -> list[tuple[str, list[str]]]:
    """(header line, files that begin with it) of the text files at `path`, found by one job; blank files are left out."""
    lines = spark.read.text(path).select(
        F.regexp_replace("value", "^\ufeff|\r$", "").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"), F.monotonically_increasing_id().alias("row"))
    # the first line of a file's first block; of each other block only one row is compared
    first = lines.groupBy("file").agg(F.min_by("line", F.struct("start", "row")).alias("line")).where("line <> ''")
    groups = first.groupBy("line").agg(F.sort_array(F.collect_list("file")).alias("files")).orderBy("line")
    return [(r["line"], r["files"]) for r in groups.collect()]


#: Stands for a missing cell while reading, so that a quoted empty cell stays an empty text.
_MISSING = "\u0000"


def _csv(spark: SparkSession, path: str | list[str], sep: str = ",") -> DataFrame:
    """All-text CSV with quoted line breaks; files of unlike headers are one scan a header, put together by name.

    Quoted empty cells are empty texts; cells left out, and columns that a file lacks, are null.
    """
    groups = header_groups(spark, path)
    if not groups:
        raise ValueError(f"{path}: no file with a header")
    scans = [spark.read.csv(files, header=True, sep=sep, quote='"', escape='"', multiLine=True, enforceSchema=False,
                            nullValue=_MISSING, emptyValue="") for _, files in groups]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), scans)


def nr_articles(df: DataFrame) -> DataFrame:
    """Renamed and cleaned NR rows as the article table."""
    df = df.withColumnsRenamed(NR_RENAMES).withColumn("lead parag", F.lit(""))
    return df.withColumns({
        "title": strip_tags(F.col("title")),
        "story body": strip_tags(F.col("story body")),
        "story date": to_unix_seconds(F.col("story date").cast("string"), "xml"),
    }).select(*[F.col(f"`{c}`") for c in ARTICLE_COLUMNS])


def swift_articles(df: DataFrame) -> DataFrame:
    """Renamed, unquoted, unlisted and cleaned Swift rows as the article table."""
    df = df.withColumnsRenamed(SWIFT_RENAMES).withColumns({c: F.lit("") for c in SWIFT_BLANK})
    df = df.withColumns({c: unquote(F.col(f"`{c}`")) for c in ARTICLE_COLUMNS})
    return df.withColumns({
        "RICs": unlist(F.col("RICs")),
        "RCS": unlist(F.col("RCS")),
        "title": strip_tags(F.col("title")),
        "story body": strip_tags(F.col("story body")),
        "story date": to_unix_seconds(F.col("story date"), "json"),
    }).select(*[F.col(f"`{c}`") for c in ARTICLE_COLUMNS])


def read_nr_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return nr_articles(_csv(spark, path))


def read_swift_csv(spark: SparkSession, path: str | list[str]) -> DataFrame:
    return swift_articles(_csv(spark, path))


def sheet_cells(df: DataFrame) -> DataFrame:
    """Rename the rating, drop unnamed columns and clean every cell."""
    kept = [c for c in df.columns if "Unnamed:" not in c]
    return df.select(*[
        clean_sheet_cell(F.col(f"`{c}`").cast("string")).alias(RATING_NAMES.get(c, c)) for c in kept])


def read_sheet_export(spark: SparkSession, path: str, feed: str) -> DataFrame:
    """CSV exports of one feed: 'nsc' files start with NR_, all others are 'swift'."""
    if feed not in ("swift", "nsc"):
        raise ValueError("feed must be 'swift' or 'nsc'")
    names = [p for p in list_files(spark, path) if (p.rsplit("/", 1)[-1].startswith("NR_")) == (feed == "nsc")]
    return sheet_cells(_csv(spark, names))


# --- Dispatch ----------------------------------------------------------------------

def _file_system(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), target


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The file itself, or the files directly inside a folder."""
    fs, target = _file_system(spark, path)
    statuses = [s for s in fs.listStatus(target) if s.isFile()]
    names = [s.getPath().toString() for s in statuses]
    return sorted(n for n in names if not n.rsplit("/", 1)[-1].startswith(("_", ".")))


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, target = _file_system(spark, path)
    return fs.exists(target)


def _format_of(name: str) -> str:
    extension = name.rsplit(".", 1)[-1].lower()
    if extension == "xml":
        return "xml"
    if extension in ("json", "txt"):
        return "json"
    if extension == "csv":
        return "swift" if "SWIFT_" in name else "nr"
    if extension in ("xls", "xlsx"):
        raise ValueError(f"{name}: export the workbook as CSV first")
    raise ValueError(f"{name}: file does not have the appropriate extension")


READERS: dict[str, Callable[[SparkSession, list[str]], DataFrame]] = {
    "xml": read_xml, "json": read_json, "nr": read_nr_csv, "swift": read_swift_csv,
}


def read_news(spark: SparkSession, path: str) -> DataFrame:
    """A news file, or all files of a folder: one scan per format, then their union."""
    by_format: dict[str, list[str]] = {}
    for name in list_files(spark, path):
        by_format.setdefault(_format_of(name), []).append(name)
    if not by_format:
        raise ValueError(f"{path}: no files")
    return reduce(DataFrame.unionByName, [READERS[f](spark, names) for f, names in by_format.items()])


# --- Feature tables, labels, caches --------------------------------------------------

def read_features(spark: SparkSession, path: str | list[str], sep: str, key: str,
                  schema: str | None = None) -> DataFrame:
    """Delimited features with their key renamed to `_guid`; all text without a schema."""
    if schema is None:
        return _csv(spark, path, sep).withColumnRenamed(key, "_guid")
    reader = spark.read.schema(schema)
    return reader.csv(path, header=True, sep=sep, quote='"', escape='"', multiLine=True) \
        .withColumnRenamed(key, "_guid")


def parse_labels(df: DataFrame, json_col: str = "json") -> DataFrame:
    """Label feed to guid, significance, pos; pos orders labels within one feed text."""
    items = df.select(F.posexplode(F.from_json(F.col(json_col), LABEL_SCHEMA)).alias("pos", "item"))
    return items.select("item.guid.guid", "item.significance", "pos")


def read_table(spark: SparkSession, path: str, spread: int | None = None) -> DataFrame:
    """A Parquet table as it lies, or dealt over `spread` partitions when the caller asks for it."""
    df = spark.read.parquet(path)
    return df.repartition(spread) if spread else df


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Column-projected table; the projection reaches the scan."""
    return df.select(*[F.col(f"`{c}`") for c in columns])


def cached(spark: SparkSession, path: str, build: Callable[[], DataFrame], refresh: bool = False) -> DataFrame:
    """Read the table at `path`; build and write it first when absent or to be refreshed."""
    if refresh or not path_exists(spark, path):
        build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def accepted(df: DataFrame) -> DataFrame:
    """Rows that could be read."""
    return df.where(~F.col("malformed")).drop("malformed")


def reject_counts(df: DataFrame, *keys: str) -> DataFrame:
    """Numbers of rows and of malformed rows, in total or per key."""
    return df.groupBy(*keys).agg(F.count("*").alias("parsed"), F.count_if("malformed").alias("errors"))
