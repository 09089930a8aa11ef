"""Counts of token lists made in Arrow batches."""

from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from newsfeat.functions import grams as G
from newsfeat.functions.tokens import count_terms, ngrams
from newsfeat.operators import corpus as C
from newsfeat.operators import tfidf as W

LISTS = [["a", "b", "a", "b", "c"], [], ["c"], None, ["b", "a", "b"], ["a", "a", "a", "a"]]


def plain(n, wanted=None):
    found = Counter((i, ".".join(t[k:k + n])) for i, t in enumerate(LISTS) if t for k in range(len(t) - n + 1))
    return {key: c for key, c in found.items() if wanted is None or key[1] in wanted}


@pytest.mark.parametrize("n", [1, 2, 3])
@pytest.mark.parametrize("wanted", [None, [], ["a", "b.a", "a.b.c", "x.y"], ["a.a", "c", "a.a.a", "b.c"]])
def test_counts_are_those_of_a_plain_count(n, wanted):
    some = None if wanted is None else pa.array(wanted, pa.string())
    for lists in (pa.array(LISTS), pa.array([["z", "a"], *LISTS]).slice(1)):
        rows, places, counts, names = G.counts_in_lists(*G.word_codes(lists), n, wanted=some)
        got = {(r, names[int(p)].as_py()): c for r, p, c in zip(rows.tolist(), places.tolist(), counts.tolist())}
        assert got == plain(n, wanted) and len(got) == len(rows)


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(7)
    words = np.array([f"word{c}" for c in "abcdefghijklmnop"])
    rows = [(i if i % 9 else None, " ".join(rng.choice(words, rng.integers(0, 30)))) for i in range(1, 120)]
    return spark.createDataFrame([*rows, (500, None), (501, ""), (502, "wordé wordé x wordé")], "doc_id int, body string").coalesce(2)


@pytest.mark.parametrize("sieve", [200_000, 3])
def test_combined_weights_equal_weights_of_in_row_counts(spark, docs, sieve, monkeypatch):
    monkeypatch.setattr(C, "SIEVE_TERMS", sieve)
    monkeypatch.setattr(C, "SLICE_TERMS", 40)
    tokens = C.vocabulary(C.token_table(docs, ["doc_id"], stem=False), docs).withColumn("df", F.col("df") * 3)
    grams = C.vocabulary(C.ngram_table(docs, ["doc_id"], stem=False), docs)
    got = W.combined_weights(docs, ["doc_id"], tokens, 1000, grams, 300, stem=False)
    want = W.tfidf_from_text(docs, ["doc_id"], tokens, 1000, stem=False).unionByName(
        W.tfidf_from_text(docs, ["doc_id"], grams, 300, grams=2, stem=False))
    shape = lambda df: Counter(map(tuple, df.withColumn("tfidf", F.round("tfidf", 9)).collect()))
    assert shape(got) == shape(want) and got.count() > 500 and got.dtypes == want.dtypes


def test_listed_counts_equal_in_row_counts(docs):
    lists = C.token_lists(docs, ["doc_id"], stem=False)
    got = C.listed_counts(lists, ["doc_id"], (1, 2, 3))
    want = lists.select("doc_id", F.inline(F.concat(*[count_terms(ngrams(F.col("tokens"), n)) for n in (1, 2, 3)])))
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.collect())) and got.dtypes == want.dtypes


def test_a_band_search_and_weights_read_the_stored_lists_and_no_text(spark, docs):
    """Both vocabularies and the weights use one stored tokenisation, and no n-gram below the band leaves a task."""
    lists = C.stored(C.token_lists(docs, ["doc_id"], stem=False), "token-lists")
    blank = docs.withColumn("body", F.raise_error(F.lit("tokenised again")))
    vocabularies = [C.band_vocabulary(blank, n=n, stem=False, lists=lists) for n in (1, 2)]
    for n, vocabulary in zip((1, 2), vocabularies):
        assert sorted(vocabulary.collect()) == sorted(C.band_vocabulary(docs, n=n, stem=False).collect()) != []
    weights = W.combined_weights(blank, ["doc_id"], vocabularies[0], 1000, vocabularies[1], 300, stem=False, lists=lists)
    assert weights.count() > 500
    wanted = pa.array(["worda.wordb"])
    assert {r.term for r in C.part_counts(lists.select("tokens"), 2, wanted=wanted).collect()} == {"worda.wordb"}
