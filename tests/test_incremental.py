"""A corpus in batches is the corpus at once."""

import pytest

from newsfeat.operators import corpus as C
from newsfeat.plans import incremental as I


@pytest.fixture(scope="module")
def docs(spark):
    rows = [("s", i, f"rates rise market{'abcdefg'[i % 7]} again profit" + " word" * (i % 4)) for i in range(20)]
    rows += [("t", i, f"other words market{'abcde'[i]} rise") for i in range(5)] + [("t", 5, None), ("t", 6, "")]
    return spark.createDataFrame(rows, "source_id string, doc_id int, body string")


def decoded(spark, folder):
    dictionary, counts = I.read_corpus(spark, folder)
    names = {r.i: r.t for r in dictionary.collect()}
    assert len(set(names.values())) == len(names) and sorted(names) == list(range(1, len(names) + 1))
    return names, sorted((r.source_id, names[r.g1], names[r.g2], r.c, r.df) for r in counts.collect())


@pytest.mark.parametrize("max_rows", [None, 0])
def test_batches_give_the_same_as_one(spark, docs, tmp_path, max_rows):
    one, many = str(tmp_path / "one"), str(tmp_path / "many")
    assert I.add_batch(spark, one, docs, stem=False) == 27
    assert I.add_batch(spark, many, docs.where("doc_id < 4"), stem=False, max_rows=max_rows) == 8
    first, _ = decoded(spark, many)
    assert I.add_batch(spark, many, docs.where("doc_id > 1"), stem=False, max_rows=max_rows) == 19
    names, counts = decoded(spark, many)
    assert counts == decoded(spark, one)[1] and counts
    assert {i: names[i] for i in first} == first and len(names) > len(first)
    # the same again changes nothing
    assert I.add_batch(spark, many, docs, stem=False, max_rows=max_rows) == 0
    assert decoded(spark, many) == (names, counts)


def test_a_batch_that_broke_off_is_done_again(spark, docs, tmp_path):
    folder = str(tmp_path / "corpus")
    with pytest.raises(ValueError):
        I.read_corpus(spark, folder)
    I.add_batch(spark, folder, docs.where("doc_id < 4"), stem=False)
    # what a lost run left behind has no marker
    docs.write.parquet(f"{folder}/batch-1/counts")
    before = decoded(spark, folder)
    assert I.add_batch(spark, folder, docs.where("doc_id < 4"), stem=False) == 0
    assert decoded(spark, folder) == before


def test_repeated_and_unnamed_documents(spark, tmp_path):
    rows = [("s", 1, "one two"), ("s", 1, "three four"), ("s", 1, "one two"), (None, 1, "five six"), ("s", None, "five six")]
    df = spark.createDataFrame(rows, "source_id string, doc_id int, body string")
    folder = str(tmp_path / "corpus")
    assert I.add_batch(spark, folder, df, stem=False) == 3
    assert I.add_batch(spark, folder, df, stem=False) == 2
    _, counts = I.read_corpus(spark, folder)
    assert sorted((r.source_id or "", r.c, r.df) for r in counts.collect()) == [("", 2, 2), ("s", 1, 1), ("s", 2, 2)]


def test_new_terms_get_the_next_ids(spark):
    known = spark.createDataFrame([(1, "m"), (2, "b")], "i bigint, t string")
    terms = spark.createDataFrame([("z",), ("m",), ("a",), ("z",)], "t string")
    assert sorted(map(tuple, I.extend_ids(known, terms).collect())) == [(3, "a"), (4, "z")]
    assert C.dense_ids(terms.distinct(), "t").count() == 3


def test_packed_lists_give_the_same_counts(spark):
    """In parts of any size, with words that the dictionary has not, a missing source and documents without words."""
    rows = [("s", f"rates rise market{i % 3} again rates rise" + " word" * (i % 4)) for i in range(30)]
    rows += [(None, "rates rise unknown rise rates"), ("t", "alone"), ("t", ""), ("t", None), ("t", "rise rates")]
    docs = spark.createDataFrame(rows, "source_id string, body string").coalesce(2)
    terms = ["rates", "rise", "market0", "market1", "market2", "word", "alone"]
    dictionary = spark.createDataFrame([(10 * i, t) for i, t in enumerate(terms)], "i bigint, t string")
    lists = docs.select("source_id", C.tokens_of(C.F.col("body"), False).alias("tokens"))
    rows_of = lambda df: sorted(map(str, df.select("source_id", "g1", "g2", "c", "df").collect()))
    want = rows_of(C.extract_grams(docs, dictionary, stem=False))
    for documents, most, max_rows in ((None, None, None), (4, None, 0), (None, 1, None)):
        packed = C.packed_lists(lists, ["source_id"], documents, most)
        assert rows_of(C.extract_grams(docs, dictionary, max_rows=max_rows, packed=packed)) == want and want
