"""The band vocabulary found part by part."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsfeat.operators import corpus as C


@pytest.fixture(scope="module")
def docs(spark):
    rng = np.random.default_rng(4)
    words = np.array([f"w{c}{d}" for c in "abcdefghij" for d in "klmnopqrst"])
    rows = [(i, " ".join(rng.choice(words, rng.integers(0, 25), p=np.arange(100, 0, -1) / 5050))) for i in range(300)]
    # one part holds all documents of a term, and a term is in a share of each part just below the band
    rows += [(300 + i, "hotpart wxx " + " ".join(rng.choice(words, 5))) for i in range(40)] + [(340, None), (341, ""), (342, "alone")]
    return spark.createDataFrame(rows, "doc_id int, body string").coalesce(3)


def plain(docs, n, low, high, size):
    counts = C.ngram_table(docs, ["doc_id"], n=n, stem=False)
    return sorted(map(tuple, C.band(C.document_frequency(counts, ["term"]), size, low, high).collect()))


@pytest.mark.parametrize("documents", [1, 7, 50_000])
@pytest.mark.parametrize("n, low, high", [(1, 0.01, 0.7), (1, 0.1, 0.2), (2, 0.01, 0.7)])
def test_parts_of_any_size_give_the_same(docs, documents, n, low, high):
    got = sorted(map(tuple, C.band_vocabulary(docs, n=n, stem=False, low=low, high=high, documents=documents).collect()))
    assert got == plain(docs, n, low, high, 343) and got


@pytest.mark.parametrize("size", [50, 343, 5000])
def test_a_stated_corpus_size(docs, size):
    got = sorted(map(tuple, C.band_vocabulary(docs, stem=False, size=size, documents=20, max_rows=0).collect()))
    assert got == plain(docs, 1, 0.01, 0.7, size)


def test_terms_below_the_band_in_every_part_are_not_handed_on(docs):
    terms = C.distinct_terms(docs, stem=False).coalesce(1)
    rows = [r.terms for r in terms.collect()]
    parts = [rows[i:i + 60] for i in range(0, len(rows), 60)]
    want = {t for part in parts for t in set(sum(part, [])) if sum(t in r for r in part) >= 0.2 * len(part)}
    found = C.local_candidates(terms, 0.2, 60).select("term").distinct()
    assert {r.term for r in found.collect()} == want
    assert len(want) < len({t for r in rows for t in r}) / 2
    # bounded by terms instead: each part then ends early
    few = C.local_candidates(terms, 0.2, most_terms=30)
    assert want <= {r.term for r in few.collect()} | want and few.count()


def test_no_documents(docs):
    assert C.band_vocabulary(docs.where(F.lit(False)), stem=False).count() == 0
