"""The source audit against a plain version in whole numbers."""

import re
import tempfile

import duckdb
import numpy as np
import pytest

from newsfeat.llm import source_audit, sql


def plain(rows, min_docs=3, top=200):
    """{(lang, source, part): [(item, value), ...]} in rank order."""
    docs = [(l or "", s or "", re.findall("[^\x00-\x40\x5b-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or "")))
            for l, s, t in rows]
    out = {}
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        seen = {}
        for _, _, words in mine:
            for w in set(words):
                seen[w] = seen.get(w, 0) + 1
        kept = sorted(w for w, n in seen.items() if n >= min_docs)
        count = lambda ds: {w: sum(d[2].count(w) for d in ds) for w in kept}
        shares = lambda c: {w: 1 + 10**9 * (c[w] + 1) // (sum(c.values()) + len(kept)) for w in kept}
        whole = shares(count(mine))
        groups = {s: count([d for d in mine if d[1] == s]) for s in {d[1] for d in mine}}
        of = {s: shares(c) for s, c in groups.items()}
        order = lambda x: (-x[1], x[0].encode())
        for s, p in of.items():
            out[lang, s, "pair"] = sorted(((o, sum((p[w] - q[w]) ** 2 // q[w] for w in kept)) for o, q in of.items() if o != s), key=order)
            out[lang, s, "term"] = sorted(((w, (p[w] - whole[w]) ** 2 // whole[w]) for w in kept
                                           if groups[s][w] and p[w] > whole[w]), key=order)[:top]
    return {k: v for k, v in out.items() if v}


def audited(df, **options):
    out = {}
    for r in sorted(source_audit.audit_sources(df, **options).collect(), key=lambda r: r["rank"]):
        out.setdefault((r.lang, r.source, r.part), []).append((r.item, r.value))
    return out


def rows_of(n=120):
    rng = np.random.default_rng(5)
    words = ["the", "The", "é", "Éa", "x-ray", "naïve", "a1b", *(f"w{c}" for c in "abcdefghij")]
    rows = [(["en", "de", None][i % 3], [None, "s1", "s2", "S1", "ß"][rng.integers(0, 5)] if i % 7 else "s1",
             " ".join(rng.choice(words, rng.integers(0, 30)))) for i in range(n)]
    return rows + [("en", "empty", None), ("en", "empty", ""), ("fr", "a", "one two"), ("fr", "b", None), ("it", "only", "x x x")] + rows[:5]


@pytest.mark.parametrize("options", [{}, {"top": 2}, {"min_docs": 1}, {"min_docs": 10**6}])
def test_against_a_plain_version(spark, options):
    rows = rows_of()
    extra = ["c", "total", "block", "tid", "head", "whole", "v", "n", "rank", "part", "item", "value"]
    df = spark.createDataFrame([(*r, *[1] * len(extra)) for r in rows],
                               "lang string, source string, text string, " + ", ".join(f"`{c}` int" for c in extra))
    got, want = audited(df, **options), plain(rows, options.get("min_docs", 3), options.get("top", 200))
    assert got == want
    assert audited(df.where("false"), **options) == {}


def test_small_blocks_tiles_and_slices(spark, monkeypatch):
    for name, value in (("BLOCK", 3), ("TILE", 1), ("SLICE", 5)):
        monkeypatch.setattr(source_audit, name, value)
    assert list(source_audit.terms_of("Ab cD  ef,gh" * 3)) and b"".join(
        b" ".join(x) + b" " for x in source_audit.terms_of("Ab cD  ef,gh " * 3)).split() == [b"ab", b"cd", b"ef", b"gh"] * 3
    rows = rows_of(60)
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    assert audited(df) == plain(rows)


def test_sql_gives_the_same(spark):
    rows = rows_of(80)
    df = spark.createDataFrame(rows, "lang string, source string, text string")
    with tempfile.TemporaryDirectory() as folder:
        df.write.parquet(f"{folder}/d")
        con = duckdb.connect()
        con.execute(f"CREATE VIEW documents AS SELECT * FROM '{folder}/d/*.parquet'")
        want = {}
        for lang, source, part, item, value, _ in sorted(con.execute(sql.AUDIT).fetchall(), key=lambda r: r[5]):
            want.setdefault((lang, source, part), []).append((item, value))
    assert audited(df) == want


def test_shares_of_huge_counts_are_exact():
    counts, whole = [0, 1, 10**14, 3 * 10**14 + 7], 4 * 10**14 + 9
    assert source_audit.share(np.array(counts), whole).tolist() == [1 + 10**9 * (c + 1) // whole for c in counts]


def test_a_very_long_text(spark):
    text = "alpha Beta, gamma " * 300_000
    rows = [("en", "long", text), ("en", "a", "alpha beta"), ("en", "b", "alpha beta delta")]
    assert audited(spark.createDataFrame(rows, "lang string, source string, text string"))["en", "long", "pair"]
