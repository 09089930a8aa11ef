"""Collocations against a plain version in whole numbers."""

import re
import tempfile
from collections import Counter

import duckdb
import numpy as np
import pytest

from newsfeat.llm import collocations, sql

EXTRA = ["words", "phrase", "f", "kind", "range", "total", "automaton", "a", "l", "r", "n", "k", "score", "rank", "left", "right"]


def plain(rows, least, top):
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang, text = lang or "und", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", text):
            words = re.findall("[^\x20\x09]+", piece)
            n[lang] += len(words)
            f.update((lang, *words[i:i + k]) for k in range(1, 6) for i in range(len(words) - k + 1))
    often = {p: c for p, c in f.items() if len(p) > 2 and c >= least}
    hidden = {(p[0], *p[i:i + k]) for p, c in often.items() for k in range(2, len(p) - 1) for i in range(1, len(p) - k + 1)
              if 100 * c >= 100 * f[(p[0], *p[i:i + k])]}
    out = []
    for (lang, *w), a in often.items():
        if (lang, *w) in hidden:
            continue
        score, _, l, r = min((1000 * a * n[lang] // (f[(lang, *w[:k])] * f[(lang, *w[k:])]), k, f[(lang, *w[:k])], f[(lang, *w[k:])])
                             for k in range(1, len(w)))
        out.append((lang, " ".join(w), a, l, r, n[lang], score))
    ranked = []
    for lang in n:
        mine = sorted((x for x in out if x[0] == lang), key=lambda x: (-x[6], -x[2], x[1].encode()))[:top]
        ranked += [(lang, i, *x[1:]) for i, x in enumerate(mine, 1)]
    return sorted(ranked)


def frame(spark, rows):
    return spark.createDataFrame([(*r, *[1] * len(EXTRA)) for r in rows], "lang string, text string, " + ", ".join(f"`{c}` int" for c in EXTRA))


def rows_of(n=80):
    rng = np.random.default_rng(2)
    words = ["a", "B", "é", "É", "x-1", "a\x00", "ü v", "c", "d", "e"]
    rows = [(["en", None, "de"][i % 3], "".join(w + rng.choice([" ", "  ", "\t", " ", ". ", ",", "\n", "\r\n"], p=[.5, .1, .1, .1, .05, .05, .05, .05])
                                              for w in rng.choice(words, rng.integers(0, 40)))) for i in range(n)]
    return rows + [("en", None), ("en", ""), (None, " \t "), ("en", "New York City! " * 9), ("xx", "a a a a a a a")] + rows[:4]


def test_against_a_plain_version(spark):
    rows = rows_of()
    df = frame(spark, rows)
    got = sorted(tuple(r) for r in collocations.collocations(df, least=4, top=30).collect())
    assert got == plain(rows, 4, 30) and len(got) > 60
    assert collocations.collocations(df.where("false")).count() == 0
    assert collocations.collocations(df, least=10**6).count() == 0


def test_small_shards_ranges_and_slices(spark, monkeypatch):
    for name, value in (("SHARD", 23), ("RANGE", 900), ("HELD", 5), ("SLICE", 7), ("RANKED", 10)):
        monkeypatch.setattr(collocations, name, value)
    rows = rows_of(50)
    got = sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), least=3, top=20).collect())
    assert got == plain(rows, 3, 20)


def test_sql_gives_the_same(spark):
    rows = [("en", "the big red dog ran. a big red dog, sat " * 60), (None, "x y z w v u " * 120), ("en", "big red dog " * 45), ("de", None)]
    with tempfile.TemporaryDirectory() as folder:
        df = frame(spark, rows).select("lang", "text")
        df.write.parquet(f"{folder}/d")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/d/*.parquet'")
        want = sorted(con.execute(sql.COLLOCATIONS).fetchall())
    assert want == plain(rows, 100, 2000) == sorted(tuple(r) for r in collocations.collocations(df).collect())


def test_automata_keep_their_paths_and_weights():
    rng = np.random.default_rng(1)
    words = np.array([b"\xff", *(str(i).encode() for i in range(50))], object)
    paths, weights = collocations.add_up(rng.integers(0, 51, (4000, 5)).astype(np.int32) % 7, rng.integers(1, 9, 4000))
    numbers = collocations._Numbers()
    back, same = collocations.unpack(collocations.pack(paths, weights, words), numbers)
    named = np.array(list(numbers), object)
    assert (named[back] == words[paths]).all() and (same == weights).all()
    wide = paths.astype(np.int64) << 22  # beyond 21 bits the slower order is taken
    assert (collocations.add_up(wide[::-1], weights[::-1])[0] == wide).all()


def test_automata_of_one_shard_share_the_room_for_numbers():
    """With more and with fewer steps than words, and after an automaton of other words; counts of rare states stay exact."""
    words = np.array([b"\xff", *(f"w{i}".encode() for i in range(1, 40))], object)
    place = np.zeros(len(words), np.int32)
    few = np.array([[7, 3, 0], [38, 39, 2]], np.int32)
    many = np.array([[a, b, 0 if b % 3 else a] for a in range(1, 9) for b in range(1, 7)], np.int32)
    for paths in (many, few, many[::5], few[:1]):
        paths, weights = collocations.add_up(paths, np.arange(1, len(paths) + 1))
        numbers = collocations._Numbers()
        back, same = collocations.unpack(collocations.pack(paths, weights, words, place), numbers)
        named = list(numbers)
        assert [[named[i] for i in p] for p in back] == [[words[i] for i in p] for p in paths]
        assert same.tolist() == weights.tolist()


@pytest.mark.parametrize("text", ["w " * 2_000_000, "x" * 6_000_000, "a b. " * 1_000_000])
def test_very_long_texts(spark, text):
    n = len(re.findall("[^ .]+", text))
    rows = collocations.collocations(spark.createDataFrame([("en", text)], "lang string, text string")).collect()
    assert all(r.n == n and r.rank == i for i, r in enumerate(sorted(rows, key=lambda r: r["rank"]), 1))
    assert ("a b" in {r.phrase for r in rows}) == text.startswith("a b")


@pytest.mark.parametrize("known", [3, 1 << 18])
def test_few_and_all_words_known(spark, monkeypatch, known):
    """With room for few of the frequent words the others are spelled in the automata; results are the same."""
    for name, value in (("KNOWN", known), ("SHARD", 40), ("RANGE", 700)):
        monkeypatch.setattr(collocations, name, value)
    rows = rows_of(50)
    got = sorted(tuple(r) for r in collocations.collocations(frame(spark, rows), least=3, top=20).collect())
    assert got == plain(rows, 3, 20)


def test_rare_words_are_not_dealt_with_longer_runs(spark):
    """Runs of two and more words end at words too rare for a phrase, and known words are not spelled; all was spelled and dealt before."""
    rows = [("en", " ".join(f"often w{i} often also" for i in range(200)))]
    df = spark.createDataFrame(rows, "lang string, text string")
    frequent = collocations.Frequent([("en", "often"), ("en", "also"), ("de", "w7")], True)
    got = collocations.count_shards(df, 1, (2, 3), frequent).collect()
    paths = {r["kind"]: collocations.unpack(r["automaton"], collocations._Numbers(frequent.words), 3) for r in got}
    assert {r["kind"] for r in got} == {2, 3} and not any(b"w1" in r["automaton"] for r in got)
    assert paths[2][0].tolist() == [[1, 2], [2, 1]] and paths[2][1].tolist() == [200, 199]
    assert {tuple(p) for p in paths[3][0].tolist()} == {(1, 2, 1, 0, 0)}


def test_automata_with_known_words_keep_their_paths_and_weights():
    rng = np.random.default_rng(0)
    for n, width, last, known in ((0, 2, 5, 0), (1, 1, 1, 0), (1, 5, 3, 2), (900, 3, 9, 4), (3000, 5, 70_000, 60_000), (3000, 2, 70_000, 70_000)):
        paths, weights = collocations.add_up(rng.integers(0, last + 1, (n, width)).astype(np.int32), rng.integers(1, 90_000, n))
        words = np.array([b"\xff", *(b"%d" % i for i in range(1, last + 1))], object)
        numbers = collocations._Numbers(words[1:known + 1].tolist())
        back, same = collocations.unpack(collocations.pack(paths, weights, words, None, known), numbers, known)
        assert (np.array(list(numbers), object)[back] == words[paths]).all() and (same == weights).all()
