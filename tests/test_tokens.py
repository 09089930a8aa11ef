import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from newsfeat.functions import tokens as K
from newsfeat.functions.stem import stem, stem_table, stem_tokens
from newsfeat.session import ship_package


def of(spark, value, f, kind="string"):
    df = spark.createDataFrame([(value,)], f"c {kind}")
    return df.select(f(F.col("c")).alias("r")).first()["r"]


def test_tokens_are_lower_alphabetic_runs(spark):
    text = "The Café's 3rd_quarter x _hidden ab abcdefghijklmno abcdefghijklmnop 2015 don't"
    assert of(spark, text, K.tokenize) == ["café", "rd_quarter", "ab", "abcdefghijklmno"]


def test_empty_and_missing_text(spark):
    assert of(spark, "", K.tokenize) == []
    assert of(spark, None, K.tokenize) is None
    assert of(spark, [], K.ngrams, "array<string>") == []
    assert of(spark, ["a"], K.ngrams, "array<string>") == []


def test_stop_words_are_a_parameter(spark):
    assert of(spark, "the cat", lambda c: K.tokenize(c, ["cat"])) == ["the"]
    assert of(spark, "the cat", lambda c: K.tokenize(c, [])) == ["the", "cat"]


def test_default_stop_words_match_the_usual_list(spark):
    from pyspark.ml.feature import StopWordsRemover
    usual = {w for w in StopWordsRemover.loadDefaultStopWords("english") if "'" not in w}
    assert set(K.STOP_WORDS) == usual


@pytest.mark.parametrize("n, want", [(1, ["a", "b", "c"]), (2, ["a.b", "b.c"]), (3, ["a.b.c"]), (4, [])])
def test_ngrams(spark, n, want):
    assert of(spark, ["a", "b", "c"], lambda c: K.ngrams(c, n), "array<string>") == want


def test_unjoined_ngrams_are_structs(spark):
    got = of(spark, ["a", "b", "c"], lambda c: K.ngrams(c, 2, join=False), "array<string>")
    assert [(g["g1"], g["g2"]) for g in got] == [("a", "b"), ("b", "c")]


def test_phrases_split_only_at_the_literal_separator(spark):
    stop = []
    assert of(spark, "aa bb. cc", lambda c: K.phrase_ngrams(c, stop_words=stop)) == ["aa.bb", "bb.cc"]
    assert of(spark, "aa bb. , ; :cc dd", lambda c: K.phrase_ngrams(c, stop_words=stop)) == ["aa.bb", "cc.dd"]
    # Two separators in a row leave an empty phrase, which reads the whole text again.
    assert of(spark, "aax , ; :x , ; :bb cc", lambda c: K.phrase_ngrams(c, stop_words=stop)).count("bb.cc") == 2


def test_counts_match_a_counter(spark):
    rng = random.Random(3)
    rows = [(i, [rng.choice("abcdeé") for _ in range(rng.randrange(0, 40))]) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, terms array<string>")
    got = {}
    for r in K.term_counts(df, ["id"], F.col("terms")).collect():
        got.setdefault(r["id"], Counter())[r["term"]] = r["tf"]
    assert got == {i: Counter(t) for i, t in rows if t}


PUBLISHED = """
consigned consign consistently consist consolatory consolatori consolidating consolid consols consol
conspicuously conspicu conspiracy conspiraci conspirator conspir constables constabl knackeries knackeri
knavish knavish kneeling kneel knightly knight knitting knit knives knive knopp knopp generously generous
generate generat communism communism hopping hop hoping hope falling fall happy happi by by say say cry cri
ties tie gas gas this this skies sky dying die news news proceed proceed luxuriated luxuri
""".split()


@pytest.mark.parametrize("word, want", list(zip(PUBLISHED[::2], PUBLISHED[1::2])))
def test_published_stems(word, want):
    assert stem(word) == want


def test_stemming_keeps_array_shape(spark):
    ship_package(spark)
    rows = [(1, ["hopping", "cats", "hopping"]), (2, []), (3, None), (4, ["news"])]
    df = spark.createDataFrame(rows, "id int, t array<string>").select("id", stem_tokens("t").alias("s"))
    assert {r["id"]: r["s"] for r in df.collect()} == {
        1: ["hop", "cat", "hop"], 2: [], 3: None, 4: ["news"]}


def test_stem_table(spark):
    ship_package(spark)
    df = spark.createDataFrame([("ponies",), ("ponies",), ("caresses",)], "term string")
    assert {tuple(r) for r in stem_table(df).collect()} == {("ponies", "poni"), ("caresses", "caress")}
