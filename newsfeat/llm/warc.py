"""WARC archives: write page captures, read archives back, assemble transactions.

Records end with CR LF CR LF, so Spark's text writer with that line separator writes valid
archives to any store Spark can reach, and its text reader splits large archives between
tasks at `CR LF CR LF WARC/1.`. A payload that holds such a line is put together again by the
record's declared length.
"""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.operators.joins import lookup_join
from newsfeat.session import ship_package, stored

END = "\r\n\r\n"
CUT = END + "WARC/1."
REVISIT_PROFILE = "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest"
LEAST_REVISIT = 100


def _header(*lines: tuple[str, Column]) -> Column:
    return F.concat(F.lit("WARC/1.0\r\n"), *(
        F.coalesce(F.concat(F.lit(name + ": "), value.cast("string"), F.lit("\r\n")), F.lit(""))
        for name, value in lines), F.lit("\r\n"))


def capture_records(pages: DataFrame, key: str = "page_id", url: str = "url", body: str = "html",
                    least: int = LEAST_REVISIT) -> DataFrame:
    """Three records per page, as text: a request, a response or revisit, and a metadata record.

    Of pages with equal payloads of at least `least` bytes, that with the smallest key is the
    response and others revisit it; rows that repeat the smallest key are all responses, and
    if all keys are null all rows are. A null body is empty, a null url leaves its header out.

    The id of a capture is `urn:capture:<key>:<place>`, the place being that of the row in `pages`; a revisit refers
    to the id of a response that is written. `pages` is read twice and must keep its order, as files do.
    """
    rows = pages.select(F.col(key).cast("string").alias("key"), F.col(key).alias("order"), F.col(url).alias("url"),
                        F.coalesce(F.col(body), F.lit("")).alias("body"), F.monotonically_increasing_id().alias("place"))
    rows = rows.withColumns({"size": F.octet_length("body"), "digest": F.sha2("body", 256)})
    lowest = F.min(F.when(F.col("order").isNotNull(), F.struct("order", "key", "place"))).alias("first")
    firsts = rows.where(F.col("size") >= least).groupBy("digest").agg(lowest, F.count("*").alias("n"))
    firsts = stored(firsts.where("n > 1 AND first IS NOT NULL").drop("n"), "firsts")  # payloads held more than once
    rows = rows.join(firsts, "digest", "left").withColumn(
        "revisit", F.col("first").isNotNull() & ~F.col("order").eqNullSafe(F.col("first.order")))
    named = lambda k, place: F.concat_ws(":", F.lit("urn:capture"), F.coalesce(k, F.lit("")), place.cast("string"))
    rows = rows.select("*", named(F.col("key"), F.col("place")).alias("tag"),
                       named(F.col("first.key"), F.col("first.place")).alias("origin"))
    clean_url = F.regexp_replace("url", r"[\x00-\x20\x7F]+", "%20")
    bracket = lambda x: F.concat(F.lit("<"), x, F.lit(">"))
    answer = F.concat(F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "),
                      F.col("size").cast("string"), F.lit(END))
    block = F.when(F.col("revisit"), answer).otherwise(F.concat(answer, F.col("body")))
    ask = F.concat(F.lit("GET "), F.coalesce(clean_url, F.lit("/")), F.lit(" HTTP/1.1\r\n\r\n"))
    note = F.concat(F.lit("page: "), F.coalesce("key", F.lit("")))
    shared = [("WARC-Date", F.lit("2020-01-01T00:00:00Z")), ("WARC-Target-URI", clean_url)]
    main = F.concat(_header(
        ("WARC-Type", F.when(F.col("revisit"), "revisit").otherwise("response")),
        ("WARC-Record-ID", bracket(F.col("tag"))), *shared,
        ("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        ("WARC-Profile", F.when(F.col("revisit"), REVISIT_PROFILE)),
        ("WARC-Refers-To", F.when(F.col("revisit"), bracket(F.col("origin")))),
        ("Content-Type", F.lit("application/http; msgtype=response")), ("Content-Length", F.octet_length(block))), block)
    sides = [F.concat(_header(
        ("WARC-Type", F.lit(kind)), ("WARC-Record-ID", bracket(F.concat_ws(":", "tag", F.lit(kind)))), *shared,
        ("WARC-Concurrent-To", bracket(F.col("tag"))), ("Content-Type", F.lit(mime)),
        ("Content-Length", F.octet_length(text))), text)
        for kind, mime, text in (("request", "application/http; msgtype=request", ask),
                                 ("metadata", "application/warc-fields", note))]
    return rows.select(F.explode(F.array(sides[0], main, sides[1])).alias("value"))


def write_archives(records: DataFrame, path: str) -> None:
    """One archive per partition."""
    records.select("value").write.option("lineSep", END).text(path)


def _whole(pdf: pd.DataFrame) -> pd.DataFrame:
    """The pieces of one archive that share a record with others; pieces inside a record's length are part of it."""
    pdf = pdf.sort_values(["block", "rank"], ignore_index=True)
    owner, until, at = [], -1, 0
    for size, need in zip(pdf["size"], pdf["need"]):
        if at >= until:
            record, until = len(owner), at + need
        owner.append(record)
        at += size + len(CUT)
    out = pdf[["file", "rank"]].assign(record=owner)
    return out[out.duplicated("record", keep=False)]


def _field(header: Column, name: str) -> Column:
    value = F.regexp_extract(header, rf"(?im)^{name}:[ \t]*([^\r\n]*?)[ \t]*\r?$", 1)
    return F.when(value != "", value)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Records of uncompressed WARC files: record_type, record_id, concurrent_to, refers_to, target_uri, digest,
    headers, block (binary).

    Files are split between tasks. Only files that hold a cut inside a payload go through one
    group each, of piece lengths alone; the pieces of the records that were cut are then joined, all others stay where
    they are. A record cut off by the end of its file keeps the bytes it has; an empty folder of archives has no record.
    """
    ship_package(spark)
    pieces = spark.read.option("lineSep", CUT).text(path).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"))
    pieces = pieces.withColumn("rank", F.monotonically_increasing_id()).where(F.octet_length("value") > 0)
    head = F.substring_index("value", END, 1)
    need = F.regexp_extract(head, r"(?im)^Content-Length:[ \t]*(\d+)", 1).cast("long")
    pieces = pieces.withColumns({
        "size": F.octet_length("value").cast("long"),
        "need": F.coalesce(F.octet_length(head) + len(END) + need, F.lit(0)).cast("long")})
    exact = (F.col("size") == F.col("need")) | (F.col("size") == F.col("need") + len(END))
    cut_files = stored(pieces.where(~exact).select("file").distinct(), "cut_files")
    odd = pieces.select("file", "block", "rank", "size", "need").join(cut_files, "file", "left_semi")
    shared = stored(odd.groupBy("file").applyInPandas(_whole, "file string, rank long, record long"), "shared_pieces")
    good = lookup_join(pieces, shared, ["file", "rank"], "left_anti").select(F.col("value").cast("binary").alias("raw"))
    parts = lookup_join(pieces, shared, ["file", "rank"]).groupBy("file", "record").agg(
        F.sort_array(F.collect_list(F.struct("block", "rank", F.col("value").cast("binary").alias("raw")))).alias("p"))
    glue = F.lit(CUT).cast("binary")
    mended = parts.select(F.aggregate(
        F.slice("p", 2, 2**30), F.get("p", F.lit(0))["raw"], lambda a, x: F.concat(a, glue, x["raw"])).alias("raw"))
    raw = good.unionByName(mended)
    head = F.substring_index(F.col("raw").cast("string"), END, 1)
    rows = raw.select(head.alias("headers"), "raw")
    size = F.regexp_extract("headers", r"(?im)^Content-Length:[ \t]*(\d+)", 1).cast("int")
    unbracket = lambda c: F.regexp_replace(c, "^<|>$", "")
    return rows.select(
        F.lower(_field(F.col("headers"), "WARC-Type")).alias("record_type"),
        unbracket(_field(F.col("headers"), "WARC-Record-ID")).alias("record_id"),
        unbracket(_field(F.col("headers"), "WARC-Concurrent-To")).alias("concurrent_to"),
        unbracket(_field(F.col("headers"), "WARC-Refers-To")).alias("refers_to"),
        _field(F.col("headers"), "WARC-Target-URI").alias("target_uri"),
        _field(F.col("headers"), "WARC-Payload-Digest").alias("digest"), "headers",
        F.substring("raw", F.octet_length("headers") + len(END) + 1, F.coalesce(size, F.lit(0))).alias("block"))


def http_parts(records: DataFrame) -> DataFrame:
    """Add http_headers and payload of an HTTP block."""
    head = F.substring_index(F.col("block").cast("string"), END, 1)
    rows = records.withColumn("http_headers", head)
    return rows.withColumn("payload", F.substring("block", F.octet_length("http_headers") + len(END) + 1, 2**31 - 1))


def assemble(records: DataFrame, response: Column, request: Column, metadata: Column) -> DataFrame:
    """One row per capture: capture_id and the structs response, request (null if absent), metadata (array).

    A request or metadata record joins the response or revisit that its concurrent-to names, or
    the one that a request named there belongs to. Records that name nothing known are left
    out; a response without company still gives its row. The three columns say what to keep of
    each record, so payloads travel only when asked for; what is kept is stored once, so the archives are read once.
    """
    kept = records.where("record_type IN ('response', 'revisit', 'request', 'metadata')")
    of = lambda kind, column: F.when(F.col("record_type").isin(*kind), column)
    records = stored(kept.select(
        "record_type", "record_id", "concurrent_to", of(["response", "revisit"], response).alias("response"),
        of(["request"], request).alias("request"), of(["metadata"], metadata).alias("metadata")), "records")
    main = records.where("record_type IN ('response', 'revisit')").select(
        F.col("record_id").alias("capture_id"), "response")
    requests = records.where("record_type = 'request'").select(
        F.col("concurrent_to").alias("capture_id"), "record_id", "request")
    notes = records.where("record_type = 'metadata'").select(
        F.col("concurrent_to").alias("near"), "metadata")
    hop = requests.select(F.col("record_id").alias("near"), "capture_id")
    notes = notes.join(hop, "near", "left").select(F.coalesce("capture_id", "near").alias("capture_id"), "metadata")
    company = requests.groupBy("capture_id").agg(F.first("request").alias("request"))
    notes = notes.groupBy("capture_id").agg(F.collect_list("metadata").alias("metadata"))
    return main.join(company, "capture_id", "left").join(notes, "capture_id", "left")
