"""Corpus sources, n-gram statistics, vocabularies and id dictionaries."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfeat.functions.cleaning import lead_and_body
from newsfeat.functions.grams import counts_in_lists, cut, slices, word_codes
from newsfeat.functions.stem import stem_tokens
from newsfeat.functions.tokens import STOP_WORDS, count_terms, ngrams, term_counts, tokenize
from newsfeat.operators.joins import fits, lookup_join
from newsfeat.session import ship_package, stored

# Corpus sizes behind the idf of tokens and bi-grams, the document
# frequency band as shares of the corpus size, and the least kept count.
TOKEN_CORPUS_SIZE = 1337790
BI_GRAM_CORPUS_SIZE = 4255 + 42735 + 31393 + 99681
BAND_LOW, BAND_HIGH = 0.01, 0.7
MIN_COUNT = 5

# A part of a band search ends at so many documents or at so many terms, whichever comes first.
PART_DOCUMENTS, PART_TERMS = 50_000, 2_000_000

# So many tokens are counted at once where counts are made per document, and a list of wanted terms goes to the
# tasks up to this length.
SLICE_TERMS, SIEVE_TERMS = 200_000, 200_000


def not_labelled(articles: DataFrame, labelled: DataFrame, article_id: str, labelled_id: str,
                 max_rows: int | None = None) -> DataFrame:
    """Articles that have no counterpart in the labelled table."""
    ids = labelled.select(F.col(labelled_id).alias(article_id))
    return lookup_join(articles, ids, article_id, "left_anti", max_rows=max_rows)


def corpus_sources(swift: DataFrame, swift_excel: DataFrame, nsc: DataFrame, nsc_excel: DataFrame,
                   sample_only: bool = False, max_rows: int | None = None) -> DataFrame:
    """The four article tables as one: source_id, doc_id, body.

    Labelled articles come from the two spreadsheet tables; the raw tables leave those
    out. `sample_only` keeps only rows marked in_sample = 1 of the raw tables.
    """
    if sample_only:
        swift, nsc = swift.where("in_sample = 1"), nsc.where("in_sample = 1")
    swift = not_labelled(swift.select("ID", "story"), swift_excel, "ID", "swiftID", max_rows)
    nsc = not_labelled(nsc.select("ID", "lead_parag", "body"), nsc_excel, "ID", "nscID", max_rows)
    parts = {
        "se": swift_excel.select("ID", F.col("story").alias("body")),
        "ne": nsc_excel.select("ID", "body"),
        "sw": swift.select("ID", F.col("story").alias("body")),
        "ns": nsc.select("ID", lead_and_body(F.col("lead_parag"), F.col("body")).alias("body")),
    }
    tagged = [
        part.select(F.lit(source).alias("source_id"), F.col("ID").alias("doc_id"), "body")
        for source, part in parts.items()
    ]
    return reduce(DataFrame.unionByName, tagged)


def with_text(df: DataFrame, text: str = "body") -> DataFrame:
    """Rows with a text that is neither null nor empty."""
    return df.where(F.length(F.col(f"`{text}`")) > 0)


def tokens_of(text: Column, stem: bool = True, stop_words: list[str] = STOP_WORDS) -> Column:
    tokens = tokenize(text, stop_words)
    if not stem:
        return tokens
    ship_package(SparkSession.active())
    return stem_tokens(tokens)


def token_table(docs: DataFrame, id_cols: list[str], text: str = "body", stem: bool = True,
                stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """id columns, term, tf per document row."""
    docs = with_text(docs, text).select(*id_cols, tokens_of(F.col(text), stem, stop_words).alias("tokens"))
    return term_counts(docs, id_cols, F.col("tokens"))


def ngram_table(docs: DataFrame, id_cols: list[str], text: str = "body", n: int = 2, stem: bool = True,
                stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """id columns, term (`a.b`), tf per document row."""
    docs = with_text(docs, text).select(*id_cols, tokens_of(F.col(text), stem, stop_words).alias("tokens"))
    return term_counts(docs, id_cols, ngrams(F.col("tokens"), n))


def bi_gram_table(docs: DataFrame, id_cols: list[str], text: str = "body", stem: bool = True,
                  stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """id columns, g1, g2, c per document row."""
    docs = with_text(docs, text).select(*id_cols, tokens_of(F.col(text), stem, stop_words).alias("tokens"))
    # joined texts sort faster than structs; no token holds a point, so they are cut at it again
    counted = term_counts(docs, id_cols, ngrams(F.col("tokens"), 2), "__g", "c")
    g1, g2 = (F.substring_index("__g", ".", k).alias(g) for k, g in ((1, "g1"), (-1, "g2")))
    return counted.select(*id_cols, g1, g2, "c")


def nested_counts(docs: DataFrame, text: str = "body", stem: bool = True,
                  stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """One record per document row: sql_id, sql_tbl_id, t_counts, bg_counts. Map-only."""
    docs = with_text(docs, text).select(
        F.col("doc_id").alias("sql_id"), F.col("source_id").alias("sql_tbl_id"),
        tokens_of(F.col(text), stem, stop_words).alias("tokens"),
    )
    grams = count_terms(ngrams(F.col("tokens"), 2, join=False), "g", "c")
    flat = F.transform(grams, lambda e: F.struct(e["g"]["g1"].alias("g1"), e["g"]["g2"].alias("g2"), e["c"].alias("c")))
    return docs.select(
        "sql_id", "sql_tbl_id",
        count_terms(F.col("tokens"), "t", "c").alias("t_counts"), flat.alias("bg_counts"),
    )


def occurrences(counts: DataFrame, keys: list[str], count: str = "c", name: str = "c") -> DataFrame:
    """Total occurrences per key; sums are combined before the shuffle."""
    return counts.groupBy(*keys).agg(F.sum(count).alias(name))


def document_frequency(counts: DataFrame, keys: list[str]) -> DataFrame:
    """Exact number of document rows per key.

    `counts` holds each key once per document row, so counting rows is enough: no
    distinct, and only combined counts are shuffled.
    """
    return counts.groupBy(*keys).agg(F.count("*").alias("df"))


def merge_partials(partials: DataFrame, keys: list[str], mode: str = "rows", count: str = "c") -> DataFrame:
    """Roll partial counts up: number of stored partial rows, or the sum of their counts."""
    if mode not in ("rows", "sum"):
        raise ValueError("mode must be 'rows' or 'sum'")
    value = F.count("*") if mode == "rows" else F.sum(count)
    return partials.groupBy(*keys).agg(value.alias("count"))


def band(counts: DataFrame, n: int | Column, low: float = BAND_LOW, high: float = BAND_HIGH,
         count: str = "df") -> DataFrame:
    """Keep counts from low*n to high*n, both ends included."""
    n = F.lit(n) if isinstance(n, int) else n
    return counts.where((F.col(count) >= F.lit(low) * n) & (F.col(count) <= F.lit(high) * n))


def min_count(counts: DataFrame, k: int = MIN_COUNT, count: str = "df") -> DataFrame:
    return counts.where(F.col(count) >= k)


def top_terms(counts: DataFrame, k: int = 200) -> DataFrame:
    """The k most frequent terms; each task keeps only its own k."""
    return counts.orderBy(F.desc("df"), "term").limit(k)


def corpus_size(docs: DataFrame) -> Column:
    """Number of documents, as a scalar subquery."""
    return docs.agg(F.count("*").alias("n")).scalar()


def vocabulary(counts: DataFrame, docs: DataFrame | None = None, n: int | Column | None = None,
               low: float = BAND_LOW, high: float = BAND_HIGH) -> DataFrame:
    """term, df of terms inside the band.

    A document adds to df once per distinct term, so at most (mean distinct terms per
    document) / low terms can reach the band: the size does not grow with the corpus.
    """
    n = corpus_size(docs) if n is None else n
    return band(document_frequency(counts, ["term"]), n, low, high)


def distinct_terms(docs: DataFrame, text: str = "body", n: int = 1, stem: bool = True,
                   stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """`terms`: the distinct tokens (n=1) or n-grams of each document with a text."""
    tokens = tokens_of(F.col(text), stem, stop_words)
    terms = tokens if n == 1 else ngrams(tokens, n)
    return with_text(docs, text).select(F.array_distinct(terms).alias("terms"))


def token_lists(docs: DataFrame, id_cols: list[str], text: str = "body", stem: bool = True,
                stop_words: list[str] = STOP_WORDS) -> DataFrame:
    """id columns and `tokens` of each document with a text; store them where several steps read them."""
    return with_text(docs, text).select(*id_cols, tokens_of(F.col(text), stem, stop_words).alias("tokens"))


def term_sieve(terms: DataFrame) -> pa.Array | None:
    """The terms as a list for Python tasks, which need not hand on others; None where they are too many.

    It only spares rows: what the tasks hand on is still joined with the terms.
    """
    few = terms.select("term").where("term IS NOT NULL").limit(SIEVE_TERMS + 1).toArrow().column("term").combine_chunks()
    few = few if isinstance(few, pa.Array) else pa.concat_arrays(few.chunks)
    return few if len(few) <= SIEVE_TERMS else None


def part_counts(lists: DataFrame, n: int = 1, share: float = 0.0, documents: int | None = None,
                most_terms: int | None = None, wanted: pa.Array | None = None) -> DataFrame:
    """`term`, `df`: for each part of the documents the n-grams of their lists that at least `share` of the part holds.

    A part is a run of documents in one task, so nothing is shuffled and a task holds the terms of one part.
    An n-gram is in no more documents than each of its words, so words below `share` are left out before n-grams are
    made. With a list of `wanted` n-grams only these are counted.
    """
    documents, most_terms = documents or PART_DOCUMENTS, most_terms or PART_TERMS
    ship_package(lists.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size = [], 0, 0

        def counted() -> pa.RecordBatch:
            coded = word_codes(pa.concat_arrays(held))
            # the least below it, as the product may round up
            often = lambda grams, names: np.bincount(grams, minlength=len(names)) >= share * rows * (1 - 1e-9)
            masks = None
            if share > 0 and n > 1:
                _, words, _, texts = counts_in_lists(*coded)
                masks = [often(words, texts)] * n
            _, grams, _, names = counts_in_lists(*coded, n, masks, wanted)
            df = np.bincount(grams, minlength=len(names))
            keep = pa.array(often(grams, names) & (df > 0))
            return pa.RecordBatch.from_arrays([names.filter(keep), pa.array(df).filter(keep)], ["term", "df"])

        for batch in batches:
            lists = batch.column(0)
            at = 0
            while at < len(lists):
                some = cut(lists.slice(at), documents - rows, most_terms - size)
                at += len(some)
                held.append(some)
                rows, size = rows + len(some), size + (pc.sum(pc.list_value_length(some)).as_py() or 0)
                if rows >= documents or size >= most_terms:
                    yield counted()
                    held, rows, size = [], 0, 0
        if held:
            yield counted()

    return lists.mapInArrow(run, "term string, df bigint").where("term IS NOT NULL")


def local_candidates(terms: DataFrame, share: float, documents: int | None = None,
                     most_terms: int | None = None, n: int = 1) -> DataFrame:
    """`term`: n-grams of the one list column that some part of the documents holds in at least `share` of its own documents.

    A term in a share of all documents is in that share of at least one part, however they are cut.
    """
    return part_counts(terms, n, share, documents, most_terms).select("term")


def band_vocabulary(docs: DataFrame, text: str = "body", n: int = 1, stem: bool = True,
                    stop_words: list[str] = STOP_WORDS, size: int | None = None, low: float = BAND_LOW,
                    high: float = BAND_HIGH, documents: int | None = None, max_rows: int | None = None,
                    lists: DataFrame | None = None) -> DataFrame:
    """term, df of tokens (n=1) or n-grams inside the band, exact, in two passes over stored token lists.

    The first pass names the terms that reach the band in some part of the documents, the second adds up the counts that
    the parts have for these: no term below the band in every part is shuffled. `size` stands for the number of
    documents, where given, `lists` are the stored `token_lists` of `docs`, where the caller has them.
    """
    if lists is None:
        lists = stored(token_lists(docs, [], text, stem, stop_words), "token-lists")
    lists = lists.select("tokens")
    whole = docs.count() if size is None else size
    # of the documents with a text, as parts are made of these
    share = low * whole / max(1, lists.count())
    candidates = stored(local_candidates(lists, share, documents, n=n).distinct(), "candidates")
    counts = part_counts(lists, n, documents=documents, wanted=term_sieve(candidates))
    found = lookup_join(counts, candidates, "term", max_rows=max_rows, derived=True)
    return band(found.groupBy("term").agg(F.sum("df").alias("df")), whole, low, high)


def listed_counts(lists: DataFrame, id_cols: list[str], sizes: tuple[int, ...] = (1,),
                  wanted: pa.Array | None = None) -> DataFrame:
    """id columns, term, tf: the n-grams of the stated sizes in each list of `tokens`, or only the wanted ones; map-only."""
    ship_package(lists.sparkSession)
    lists = lists.select(*id_cols, "tokens")
    fields = [*lists.schema.fields[:-1], T.StructField("term", T.StringType()), T.StructField("tf", T.LongType())]
    names = [f.name for f in fields]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some in slices(batch, "tokens", SLICE_TERMS):
                coded = word_codes(some.column("tokens"))
                for n in sizes:
                    rows, grams, counts, texts = counts_in_lists(*coded, n, wanted=wanted)
                    ids = [c.take(pa.array(rows)) for c in some.columns[:-1]]
                    yield pa.RecordBatch.from_arrays([*ids, texts.take(pa.array(grams)), pa.array(counts)], names)

    return lists.mapInArrow(run, T.StructType(fields))


def vocabulary_union(*vocabularies: DataFrame) -> DataFrame:
    """Distinct terms of several vocabularies."""
    return reduce(DataFrame.union, [v.select("term") for v in vocabularies]).distinct()


def dense_ids(terms: DataFrame, order: str, name: str = "i") -> DataFrame:
    """Ids 1..n in the order of a column with distinct values.

    A range-partitioned sort is stored with each row's place in its partition; the
    offsets come from one row per partition. No task sees more than one partition.
    """
    ordered = terms.repartitionByRange(F.col(order)).sortWithinPartitions(order)
    placed = stored(ordered.withColumn("__at", F.monotonically_increasing_id()), "dense-ids")
    part = F.shiftright(F.col("__at"), 33)
    sizes = placed.groupBy(part.alias("__part")).agg(F.count("*").alias("n"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("__before"))
    inside = F.col("__at").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("__part", part).join(F.broadcast(offsets), "__part")
        .withColumn(name, F.col("__before") + inside + 1)
        .select(name, *terms.columns)
    )


def encode(grams: DataFrame, dictionary: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Replace the tokens g1, g2 by their dictionary ids (dictionary: i, t)."""
    small = fits(dictionary.select("t", "i"), max_rows)
    for g in ("g1", "g2"):
        side = dictionary.select(F.col("t").alias(g), F.col("i").alias("__id"))
        joined = lookup_join(grams, side, g, small_fits=small, derived=True, sieve=False)
        grams = joined.withColumn(g, F.col("__id")).drop("__id")
    return grams


def not_in_dictionary(grams: DataFrame, dictionary: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Tokens that cannot be encoded; callers that need every one check this is empty."""
    tokens = grams.select(F.explode(F.array("g1", "g2")).alias("t")).distinct()
    return lookup_join(tokens, dictionary.select("t"), "t", "left_anti", max_rows=max_rows)


def dictionary_subset(dictionary: DataFrame, ids: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Dictionary rows whose id is in the list."""
    return lookup_join(dictionary, ids.select("i"), "i", "left_semi", max_rows=max_rows)


def gram_ids(grams: DataFrame) -> DataFrame:
    """Distinct ids used by encoded bi-grams."""
    return grams.select(F.explode(F.array("g1", "g2")).alias("i")).distinct()


def decode(grams: DataFrame, dictionary: DataFrame, max_rows: int | None = None) -> DataFrame:
    """Ids back to one `a.b` term; the other columns stay."""
    rest = [c for c in grams.columns if c not in ("g1", "g2")]
    small = fits(dictionary.select("i", "t"), max_rows)
    for g in ("g1", "g2"):
        side = dictionary.select(F.col("i").alias(g), F.col("t").alias(f"__{g}"))
        grams = lookup_join(grams, side, g, small_fits=small, derived=True, sieve=False)
    return grams.select(F.concat_ws(".", "__g1", "__g2").alias("term"), *rest)


def token_dictionary(docs: DataFrame, text: str = "body", stem: bool = True) -> DataFrame:
    """Token dictionary i, t, c: dense ids in token order and occurrence counts."""
    tokens = token_table(docs, [], text, stem)
    totals = tokens.groupBy(F.col("term").alias("t")).agg(F.sum("tf").alias("c"))
    return dense_ids(totals, "t")


def packed_lists(lists: DataFrame, id_cols: list[str], documents: int | None = None, most_terms: int | None = None) -> DataFrame:
    """part, ids, lengths, codes, words: runs of documents with their `tokens` as places among the distinct words of the run.

    Store it where several steps read it. `ids` are the id columns of all documents, `lengths` and `codes` are numbers of 4 bytes.
    """
    documents, most_terms = documents or PART_DOCUMENTS, most_terms or PART_TERMS
    ship_package(lists.sparkSession)
    lists = lists.select(*id_cols, "tokens")
    ids_type = T.ArrayType(T.StructType(lists.schema.fields[:-1]))
    schema = T.StructType([T.StructField("part", T.LongType()), T.StructField("ids", ids_type), T.StructField("lengths", T.BinaryType()),
                           T.StructField("codes", T.BinaryType()), T.StructField("words", T.ArrayType(T.StringType()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, rows, size, part = [], 0, 0, TaskContext.get().partitionId() << 33

        def row() -> pa.RecordBatch:
            some = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            tokens = some.column(len(id_cols))
            _, codes, words = word_codes(tokens)
            lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
            ids = pa.StructArray.from_arrays(some.columns[:-1], names=id_cols)
            lists_of = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
            return pa.RecordBatch.from_arrays(
                [pa.array([part], pa.int64()), lists_of(ids), *(pa.array([x.astype(np.int32).tobytes()], pa.binary()) for x in (lengths, codes)),
                 lists_of(words.cast(pa.string()))], ["part", "ids", "lengths", "codes", "words"])

        for batch in batches:
            while len(batch):
                some = batch.slice(0, len(cut(batch.column(len(id_cols)), documents - rows, most_terms - size)))
                batch = batch.slice(len(some))
                held.append(some)
                rows, size = rows + len(some), size + (pc.sum(pc.list_value_length(some.column(len(id_cols)))).as_py() or 0)
                if rows >= documents or size >= most_terms:
                    yield row()
                    held, rows, size, part = [], 0, 0, part + 1
        if held:
            yield row()

    return lists.mapInArrow(run, schema)


def encoded_counts(packed: DataFrame, dictionary: DataFrame, max_rows: int | None = None) -> DataFrame:
    """source_id, g1, g2 (ids), c, df of stored `packed_lists`: the words of each part get their ids, bi-grams are counted as numbers."""
    words = packed.select("part", F.posexplode("words").alias("pos", "t"))
    found = lookup_join(words, dictionary.select("t", "i"), "t", max_rows=max_rows, derived=True, sieve=False)
    numbers = found.groupBy("part").agg(F.collect_list(F.struct("pos", "i")).alias("numbers"))
    source = packed.schema["ids"].dataType.elementType["source_id"]
    schema = T.StructType([source, *(T.StructField(c, T.LongType()) for c in ("g1", "g2", "c", "df"))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(len(batch)):
                sources = batch.column(0)[at].values.dictionary_encode(null_encoding="encode")
                lengths, codes = (np.frombuffer(batch.column(k)[at].as_py(), np.int32).astype(np.int64) for k in (1, 2))
                numbers = batch.column(3)[at].values
                pos, i = (numbers.field(c).to_numpy(zero_copy_only=False) for c in ("pos", "i"))
                most = int(codes.max(initial=0)) + 1
                known, ids = np.zeros(most, bool), np.zeros(most, np.int64)
                known[pos], ids[pos] = True, i
                row = np.repeat(np.arange(len(lengths)), lengths)
                first = np.flatnonzero((row[1:] == row[:-1]) & known[codes[1:]] & known[codes[:-1]])
                grams, gram = np.unique(codes[first] * most + codes[first + 1], return_inverse=True)
                base = max(1, len(grams))
                keys, many = np.unique(row[first] * base + gram, return_counts=True)  # of each document
                sums, of = np.unique(sources.indices.to_numpy(zero_copy_only=False)[keys // base] * base + keys % base, return_inverse=True)
                c, df = np.bincount(of, many, len(sums)).astype(np.int64), np.bincount(of, minlength=len(sums))
                for k in range(0, len(sums), SLICE_TERMS):
                    some = slice(k, k + SLICE_TERMS)
                    g = grams[sums[some] % base]
                    yield pa.RecordBatch.from_arrays(
                        [sources.dictionary.take(pa.array(sums[some] // base)), pa.array(ids[g // most]), pa.array(ids[g % most]),
                         pa.array(c[some]), pa.array(df[some])], ["source_id", "g1", "g2", "c", "df"])

    parts = packed.select("part", F.col("ids.source_id").alias("sources"), "lengths", "codes").join(numbers, "part")
    counts = parts.select("sources", "lengths", "codes", "numbers").mapInArrow(run, schema)
    return counts.groupBy("source_id", "g1", "g2").agg(F.sum("c").alias("c"), F.sum("df").alias("df"))


def extract_grams(docs: DataFrame, dictionary: DataFrame, text: str = "body", stem: bool = True,
                  max_rows: int | None = None, stop_words: list[str] = STOP_WORDS,
                  packed: DataFrame | None = None) -> DataFrame:
    """source_id, g1, g2 (ids), c, df: occurrences and document frequency of bi-grams.

    One pass and one shuffle give both. Counting runs on tokens and the far smaller
    result is encoded, which gives the same ids as encoding every occurrence first. With the stored `packed_lists` of
    `docs`, where the caller has them and the dictionary has each id and token once, the words of each part are encoded
    before, so the counts are not joined with the dictionary.
    """
    if packed is not None:
        return encoded_counts(packed, dictionary, max_rows)
    grams = bi_gram_table(docs, ["source_id"], text, stem, stop_words)
    counts = grams.groupBy("source_id", "g1", "g2").agg(F.sum("c").alias("c"), F.count("*").alias("df"))
    return encode(counts, dictionary, max_rows)


def bi_gram_vocabulary(counts: DataFrame, dictionary: DataFrame, n: int | Column = BI_GRAM_CORPUS_SIZE,
                       low: float = BAND_LOW, high: float = BAND_HIGH,
                       max_rows: int | None = None) -> DataFrame:
    """term, df of encoded bi-grams (g1, g2, df) inside the band."""
    kept = stored(band(counts.select("g1", "g2", "df"), n, low, high), "bi-gram-band")
    used = dictionary_subset(dictionary, gram_ids(kept), max_rows)
    return decode(kept, used, max_rows)
