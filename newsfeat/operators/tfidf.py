"""TF-IDF weights in long and wide form."""

from __future__ import annotations

from functools import reduce

from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfeat.functions.tokens import STOP_WORDS, let
from newsfeat.operators.corpus import dense_ids, listed_counts, ngram_table, term_sieve, token_lists, token_table
from newsfeat.operators.joins import first_match, fits, lookup_join
from newsfeat.session import scratch_path, stored

#: So many named terms of a sparse row are looked up one by one; more are read off the spread-out row.
FEW_TERMS = 64


def tfidf_weight(tf: Column, df: Column, n: int | Column, exact: bool = False) -> Column:
    """(1 + ln tf) * ln(1 + n/df), 0 where tf is 0. n/df is whole division unless `exact`."""
    n = F.lit(n).cast("bigint") if isinstance(n, int) else n
    ratio = n / df if exact else F.call_function("div", n, df)
    return F.when(tf == 0, 0.0).otherwise((1 + F.ln(tf)) * F.ln(1 + ratio))


def tfidf(counts: DataFrame, vocabulary: DataFrame, n: int | Column, exact: bool = False,
          max_rows: int | None = None) -> DataFrame:
    """Weights of the counted terms (…, term, tf) that are in the vocabulary (term, df).

    The vocabulary is measured and broadcast, so the counted side is not shuffled; an
    outsized one falls back to a sliced shuffle join.
    """
    joined = lookup_join(counts, vocabulary.select("term", "df"), "term", max_rows=max_rows)
    rest = [F.col(f"`{c}`") for c in counts.columns if c not in ("term", "tf")]
    return joined.select(*rest, "term", tfidf_weight(F.col("tf"), F.col("df"), n, exact).alias("tfidf"))


def tfidf_from_text(docs: DataFrame, id_cols: list[str], vocabulary: DataFrame, n: int | Column,
                    text: str = "body", grams: int = 1, exact: bool = False, stem: bool = True,
                    stop_words: list[str] = STOP_WORDS, max_rows: int | None = None) -> DataFrame:
    """Weights of tokens (grams=1) or n-grams of the raw text."""
    if grams == 1:
        counts = token_table(docs, id_cols, text, stem, stop_words)
    else:
        counts = ngram_table(docs, id_cols, text, grams, stem, stop_words)
    return tfidf(counts, vocabulary, n, exact, max_rows)


def combined_weights(docs: DataFrame, id_cols: list[str], tokens: DataFrame, n_tokens: int | Column, bi_grams: DataFrame,
                     n_bi_grams: int | Column, text: str = "body", exact: bool = False, stem: bool = True,
                     stop_words: list[str] = STOP_WORDS, max_rows: int | None = None,
                     lists: DataFrame | None = None) -> DataFrame:
    """Weights of tokens and bi-grams of the raw text, tokenised once; a bi-gram's point tells it from a token.

    `lists` are the stored `token_lists` of `docs`, where the caller has them.
    """
    lists = token_lists(docs, id_cols, text, stem, stop_words) if lists is None else lists
    # n goes into the projection and not into the looked-up table, which is measured
    both = tokens.select("term", "df", F.lit(False).alias("gram")).unionByName(
        bi_grams.select("term", "df", F.lit(True).alias("gram")))
    counts = listed_counts(lists, id_cols, (1, 2), term_sieve(both))
    joined = lookup_join(counts, both, "term", max_rows=max_rows)
    weight = lambda n: tfidf_weight(F.col("tf"), F.col("df"), n, exact)
    return joined.select(*id_cols, "term", F.when(F.col("gram"), weight(n_bi_grams)).otherwise(weight(n_tokens)).alias("tfidf"))


def stored_counts(docs: DataFrame, records: DataFrame, kind: str = "token",
                  max_rows: int | None = None) -> DataFrame:
    """Counts of labelled rows (_data_source, _id, …) out of nested records.

    The first record of a document wins; rows without one have no counts. `records` has
    sql_tbl_id, sql_id, t_counts and bg_counts; its order is that of `seq` if present,
    else a fixed one by content. Records of other documents go first, and only `docs` is
    measured: the nested counts are never computed for a measurement.
    """
    ids = ["sql_tbl_id", "sql_id"]
    small = fits(docs, max_rows)
    wanted = docs.select(F.col("_data_source").alias("sql_tbl_id"), F.col("_id").alias("sql_id")).distinct()
    records = lookup_join(records, wanted, ids, "left_semi", small_fits=small)
    array = "t_counts" if kind == "token" else "bg_counts"
    order = F.col("seq") if "seq" in records.columns else F.xxhash64(array)
    one = first_match(
        records.select("sql_tbl_id", "sql_id", order.alias("__order"), array),
        ids, F.col("__order"),
    ).select(F.col("sql_tbl_id").alias("_data_source"), F.col("sql_id").alias("_id"), array)
    keys = ["_data_source", "_id"]
    joined = one.join(F.broadcast(docs), keys) if small else lookup_join(docs, one, keys, small_fits=False)
    kept = [F.col(f"`{c}`") for c in docs.columns]
    entry = joined.select(*kept, F.explode(array).alias("e"))
    term = F.col("e.t") if kind == "token" else F.concat_ws(".", "e.g1", "e.g2")
    return entry.select(*kept, term.alias("term"), F.col("e.c").alias("tf"))


def tfidf_from_counts(docs: DataFrame, records: DataFrame, vocabulary: DataFrame, n: int | Column,
                      kind: str = "token", exact: bool = False, max_rows: int | None = None) -> DataFrame:
    """Weights from stored counts instead of the text."""
    return tfidf(stored_counts(docs, records, kind, max_rows), vocabulary, n, exact, max_rows)


def observed_terms(weights: DataFrame) -> DataFrame:
    """Terms that occur at all."""
    return weights.select("term").distinct()


def term_list(vocabulary: DataFrame, max_terms: int | None = None) -> list[str]:
    """Vocabulary terms in order, for column names; more than `max_terms`, where given, are refused.

    The names are part of the plan of a wide table, so the driver holds them; `vocabulary`
    says why their number does not grow with the corpus.
    """
    terms = [r["term"] for r in vocabulary.select("term").distinct().orderBy("term").collect()]
    if max_terms is not None and len(terms) > max_terms:
        raise ValueError(f"more than {max_terms} terms: keep the long form or narrow the band")
    return terms


def dense_weights(weights: DataFrame, id_cols: list[str], terms: list[str]) -> DataFrame:
    """id columns and `weights`, an array with one value per term of the list, 0 where absent.

    One shuffle on the ids, which have to be unique per document: then no group holds
    more entries than there are terms. Terms outside the list are left out.
    """
    spark = weights.sparkSession
    places = spark.createDataFrame([(t, i) for i, t in enumerate(terms)], "term string, place int")
    placed = lookup_join(weights, places, "term")
    entries = F.sort_array(F.collect_list(F.struct("place", "tfidf")))

    def padded(s: Column) -> Column:
        def gap(e: Column, k: Column) -> Column:
            before = F.coalesce(F.get(s, k - 1)["place"], F.lit(-1))
            return F.concat(F.array_repeat(F.lit(0.0), e["place"] - before - 1), F.array(e["tfidf"]))

        tail = F.array_repeat(F.lit(0.0), F.lit(len(terms) - 1) - F.get(s, F.size(s) - 1)["place"])
        return F.flatten(F.concat(F.transform(s, gap), F.array(tail)))

    grouped = placed.groupBy(*id_cols).agg(entries.alias("entries"))
    return grouped.select(*id_cols, let(F.col("entries"), padded).alias("weights"))


def term_places(*vocabularies: DataFrame) -> DataFrame:
    """term, place: places from 0 in term order, those of earlier vocabularies first. Stored; the driver holds no term."""
    tagged = [v.select("term", F.lit(k).alias("kind")) for k, v in enumerate(vocabularies)]
    first = reduce(DataFrame.unionByName, tagged).groupBy("term").agg(F.min("kind").alias("kind"))
    ids = dense_ids(first.select(F.struct("kind", "term").alias("at")), "at", "place")
    return stored(ids.select("at.term", (F.col("place") - 1).cast("int").alias("place")), "places")


def sparse_weights(weights: DataFrame, id_cols: list[str], places: DataFrame) -> DataFrame:
    """id columns and `weights`, a struct of size, indices and values of the terms a row has; a row is as long as its text.

    The ids have to be unique per document, which is checked: a term twice in a row is an error.
    Terms without a place are left out.
    """
    size = places.count()
    placed = lookup_join(weights, places, "term")
    entries = placed.groupBy(*id_cols).agg(F.sort_array(F.collect_list(F.struct("place", "tfidf"))).alias("__e"))
    once = F.size(F.array_distinct("__e.place")) == F.size("__e")
    indices = F.when(once, F.col("__e.place")).otherwise(F.raise_error(F.lit("a document id repeats")).cast("array<int>"))
    return entries.select(*id_cols, F.struct(
        F.lit(size).alias("size"), indices.alias("indices"), F.col("__e.tfidf").alias("values")).alias("weights"))


def sparse_for(docs: DataFrame, weights: DataFrame, key: str, places: DataFrame) -> DataFrame:
    """All rows of `docs` with their sparse `weights`; rows without any term have none. `key` is unique in `docs`."""
    sparse = sparse_weights(weights.select(key, "term", "tfidf"), [key], places)
    none = F.struct(F.lit(places.count()).alias("size"), F.array().cast("array<int>").alias("indices"),
                    F.array().cast("array<double>").alias("values"))
    return docs.join(sparse, key, "left").withColumn("weights", F.coalesce("weights", none))


def long_form(df: DataFrame, keys: list[str], places: DataFrame) -> DataFrame:
    """keys, term, tfidf: sparse rows as long ones again."""
    entries = df.select(*keys, F.inline(F.arrays_zip(
        F.col("weights.indices").alias("place"), F.col("weights.values").alias("tfidf"))))
    return lookup_join(entries.toDF(*keys, "place", "tfidf"), places, "place").select(*keys, "term", "tfidf")


def named_weights(df: DataFrame, places: DataFrame, terms: list[str]) -> DataFrame:
    """Sparse `weights` as an array of the named terms only, in their order, 0 where a row or the places lack one."""
    names = df.sparkSession.createDataFrame([(t,) for t in dict.fromkeys(terms)], "term string")
    found = {r["term"]: r["place"] for r in lookup_join(places, names, "term", "left_semi").collect()}
    wanted = [found.get(t, -1) for t in terms]
    indices, values = F.col("weights.indices"), F.col("weights.values")
    if len(terms) <= FEW_TERMS:
        cells = [F.coalesce(F.get(values, (F.array_position(indices, p) - 1).cast("int")), F.lit(0.0)) if p >= 0
                 else F.lit(0.0) for p in wanted]
        return df.withColumn("weights", F.array(*cells).cast("array<double>"))

    def spread(w: Column) -> Column:
        def gap(v: Column, k: Column) -> Column:
            before = F.coalesce(F.get(w["indices"], k - 1), F.lit(-1))
            return F.concat(F.array_repeat(F.lit(0.0), F.get(w["indices"], k) - before - 1), F.array(v))

        last = F.coalesce(F.get(w["indices"], F.size(w["indices"]) - 1), F.lit(-1))
        tail = F.array_repeat(F.lit(0.0), w["size"] - 1 - last)
        return F.flatten(F.concat(F.transform(w["values"], gap), F.array(tail)))

    chosen = F.from_json(F.lit(str(wanted)), "array<int>")  # one literal, however many terms
    pick = lambda a: F.transform(chosen, lambda p: F.when(p >= 0, F.get(a, p)).otherwise(F.lit(0.0)))
    return df.withColumn("weights", let(spread(F.col("weights")), pick))


def with_vectors(df: DataFrame, column: str = "features") -> DataFrame:
    """Sparse `weights` as a vector column for Spark ML, by writing them in the vector's own layout."""
    w = F.col("weights")
    vector = F.struct(F.lit(0).cast("tinyint").alias("type"), w["size"].alias("size"), w["indices"].alias("indices"),
                      w["values"].alias("values"))
    made = df.withColumn(column, vector).drop("weights")
    path = scratch_path(df.sparkSession, "vectors")
    made.write.parquet(path)
    fields = [T.StructField(f.name, VectorUDT() if f.name == column else f.dataType) for f in made.schema.fields]
    return df.sparkSession.read.schema(T.StructType(fields)).parquet(path)


def wide_for(docs: DataFrame, weights: DataFrame, key: str, terms: list[str]) -> DataFrame:
    """All rows of `docs` with their `weights` array; rows without any term get zeros.

    `key` has to be unique in `docs`, so both sides of the join have one row per key.
    """
    dense = dense_weights(weights.select(key, "term", "tfidf"), [key], terms)
    zeros = F.array_repeat(F.lit(0.0), len(terms))
    return docs.join(dense, key, "left").withColumn("weights", F.coalesce("weights", zeros))


def expand_columns(df: DataFrame, terms: list[str]) -> DataFrame:
    """Turn `weights` into one column per term, as the last step before writing.

    A term that is already a column name gets the prefix `tfidf_`.
    """
    rest = [c for c in df.columns if c != "weights"]
    named = [f"tfidf_{t}" if t in rest else t for t in terms]
    return df.selectExpr(*[f"`{c}`" for c in rest], *[f"weights[{i}] AS `{n}`" for i, n in enumerate(named)])


def pivot_wide(weights: DataFrame, id_cols: list[str], terms: list[str]) -> DataFrame:
    """One column per term, 0 where a document lacks it. Naming the terms saves a pass."""
    return expand_columns(dense_weights(weights, id_cols, terms), terms)
