"""Tokens, n-grams and their counts inside one row.

Counting happens within the row: sort the terms, mark where a run starts, subtract
neighbouring starts. No row leaves its task, so term counts of a document cost no
shuffle and repeated document ids cannot make a hot group.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Everything that cannot be part of a word, token lengths, and the phrase
# separator (one character, then the literal text " , ; :").
NOT_WORD = r"[^\p{L}\p{Nl}\p{No}_]+"
MIN_LENGTH, MAX_LENGTH = 2, 15
PHRASE_SEPARATOR = r"[^\n] , ; :"

# Default English stop words that can be tokens (the apostrophe forms of
# the usual list never are).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his
himself she her hers herself it its itself they them their theirs themselves what which
who whom this that these those am is are was were be been being have has had having do
does did doing a an the and but if or because as until while of at by for with about
against between into through during before after above below to from up down in out on
off over under again further then once here there when where why how all any both each
few more most other some such no nor not only own same so than too very s t can will
just don should now cannot could ought would
""".split()


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluate `value` once and use it several times in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def tokenize(c: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Lower-case words of 2 to 15 letters that are not stop words, in text order."""
    stop = [w for w in stop_words if MIN_LENGTH <= len(w) <= MAX_LENGTH]

    def keep(t: Column) -> Column:
        good = F.length(t).between(MIN_LENGTH, MAX_LENGTH) & ~t.startswith("_")
        return good & ~t.isin(stop) if stop else good

    return F.filter(F.split(F.lower(c), NOT_WORD), keep)


def ngrams(tokens: Column, n: int = 2, join: bool = True) -> Column:
    """Adjacent n-tuples of an array: `a.b` texts, or structs g1..gn when not joined."""
    if n < 1:
        raise ValueError("n must be at least 1")

    def gram(a: Column) -> Column:
        def at(first: Column, i: Column) -> Column:
            parts = [first] + [F.get(a, i + k) for k in range(1, n)]
            if join:
                return F.concat_ws(".", *parts)
            return F.struct(*[p.alias(f"g{k}") for k, p in enumerate(parts, 1)])

        return F.transform(F.slice(a, F.lit(1), F.greatest(F.size(a) - (n - 1), F.lit(0))), at)

    return let(tokens, gram)


def phrase_ngrams(c: Column, n: int = 2, separator: str = PHRASE_SEPARATOR, join: bool = True,
                  stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """N-grams that do not cross a phrase separator.

    An empty phrase reads the whole text again. The text counts as quoted at both ends,
    so a separator at its very start or end leaves a phrase without words, not an empty one.
    """
    stop_words = list(stop_words)
    quoted = F.concat(F.lit('"'), c, F.lit('"'))

    def phrases(text: Column) -> Column:
        pieces = F.split(text, separator)
        return F.flatten(F.transform(
            pieces, lambda p: ngrams(tokenize(F.when(p == "", text).otherwise(p), stop_words), n, join)
        ))

    return let(quoted, phrases)


def count_terms(terms: Column, term: str = "term", count: str = "tf") -> Column:
    """Array of distinct terms with their number of occurrences, sorted by term."""

    def run_starts(s: Column) -> Column:
        indexed = F.transform(s, lambda t, i: F.struct(t.alias("t"), i.alias("i")))
        return F.filter(indexed, lambda e: F.coalesce(F.get(s, e["i"] - 1) != e["t"], F.lit(True)))

    def lengths(s: Column, starts: Column) -> Column:
        def run(e: Column, k: Column) -> Column:
            end = F.coalesce(F.get(starts, k + 1)["i"], F.size(s))
            return F.struct(e["t"].alias(term), (end - e["i"]).cast("bigint").alias(count))

        return F.transform(starts, run)

    return let(F.sort_array(terms), lambda s: let(run_starts(s), lambda st: lengths(s, st)))


def term_counts(df: DataFrame, id_cols: list[str], terms: Column, term: str = "term",
                count: str = "tf") -> DataFrame:
    """One row per document row and distinct term; map-only."""
    return df.select(*id_cols, F.inline(count_terms(terms, term, count)))


def gram_counts(df: DataFrame, id_cols: list[str], grams: Column) -> DataFrame:
    """One row per document row and distinct bi-gram struct: g1, g2, c; map-only."""
    counted = df.select(*id_cols, F.inline(count_terms(grams, "g", "c")))
    return counted.select(*id_cols, "g.*", "c")
