"""The registered queries over the driver's tables, and their SQL where SQL can express them."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsfeat.llm import (
    collocations, line_quality, packing, phrase_parse, refine_dedup, secret_scan, setsketch, source_audit, sql, stream_bpe, token_blocks,
    trie_join, url_filter, warc)
from newsfeat.llm.common import table
from newsfeat.session import scratch_path

#: Rules of the URL query; the longest that fits wins.
URL_RULES = {"com/": "allow", "example.com/en/": "block", "www.example.com/en/": "allow", "net/es/": "block",
             "net/fr/": "block"}


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.filter_urls(pages, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op2_refine_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return refine_dedup.exact_groups(docs, hash_all=True)


def op3_warc_captures(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html")
    path = scratch_path(spark, "warc")
    warc.write_archives(warc.capture_records(pages), path)
    records = warc.http_parts(warc.read_archives(spark, path))
    whole = F.col("record_type") == "response"
    declared = F.regexp_extract("http_headers", r"(?i)Content-Length: (\d+)", 1).cast("long")
    response = F.struct(
        "record_type", F.when(whole, F.octet_length("payload").cast("long")).otherwise(declared).alias("bytes"),
        F.when(whole, F.sha2("payload", 256)).otherwise(F.substring_index("digest", ":", -1)).alias("digest"),
        F.get(F.split("refers_to", ":"), F.lit(2)).cast("long").alias("refers_to"))
    captures = warc.assemble(records, response, F.struct("record_id"), F.col("block").cast("string"))
    page = F.regexp_extract(F.get("metadata", F.lit(0)), r"^page: (\d+)$", 1)
    return captures.select(
        F.when(page != "", page).cast("long").alias("page_id"), F.col("response.bytes").alias("payload_bytes"),
        F.col("response.digest").alias("payload_digest"), F.col("response.record_type").alias("record_type"),
        F.col("response.refers_to").alias("refers_to"))


def op4_line_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_quality.judge_documents(docs, any_two_bars=True).select(  # as its SQL has it
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op5_setsketch_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return setsketch.near_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op6_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source", "lang")
    found = secret_scan.scan_secrets(docs, repository=F.concat_ws("/", "source", "lang"), carry=["doc_id"])
    count = lambda n: F.size(F.filter("secrets", lambda s: s["kind_no"] == n)).cast("long")
    return found.select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        F.sha2(secret_scan.span_digest(F.col("secrets"), True), 256).alias("base_sha256"),
        secret_scan.span_digest(F.col("secrets"), False).alias("spans"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), with_ids=False)


def op8_phrase_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_parse.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_stream_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return stream_bpe.encode_digests(docs, public_tokenizers.path("word_bpe_49k.json"))


def op10_token_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_blocks.tokens_of(docs, public_tokenizers.path("word_bpe_49k.json"))


def op11_trie_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return trie_join.similar_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents").select("lang", "text"))


def op13_source_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_audit.audit_sources(table(spark, sf_dir, "documents").select("lang", "source", "text"))


QUERIES = {
    "op1_url_filter": op1_url_filter,
    "op2_refine_dedup": op2_refine_dedup,
    "op3_warc_captures": op3_warc_captures,
    "op4_line_quality": op4_line_quality,
    "op5_setsketch_dedup": op5_setsketch_dedup,
    "op6_secret_scan": op6_secret_scan,
    "op7_packing": op7_packing,
    "op8_phrase_parse": op8_phrase_parse,
    "op9_stream_bpe": op9_stream_bpe,
    "op10_token_blocks": op10_token_blocks,
    "op11_trie_join": op11_trie_join,
    "op12_collocations": op12_collocations,
    "op13_source_audit": op13_source_audit,
}
ORACLES = {name: text for name, text in sql.ORACLES.items() if name in QUERIES}
