"""Quality rules, line first: lines that fail a rule go, then documents that lost too much.

All column expressions on one row: no shuffle, no Python.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.common import WORD, words_of

SYMBOLS = "[^#*$%&|<>]+"
#: Two or more marks in a row, as in `no!!` or `word###`.
NOISE = r"[!?#*$%&|<>~^=]{2,}"
#: Separators of menus and link bars.
SEPARATORS = "[|»›•·]"
#: A line of navigation has more separators than one in so many words.
WORDS_PER_SEPARATOR = 6
#: Pairs of quotation marks, and the dot between letters, which separate nothing.
QUOTED = ("«([^«»]*)»", "»([^«»]*)«", "‹([^‹›]*)›", "›([^‹›]*)‹")
INNER_DOT = r"(?<=\p{L})·(?=\p{L})"
MENU = r"^[^A-Za-z]*(home|menu|log ?in|sign (in|up)|search|sitemap|contact( us)?|about( us)?|next|previous|share|skip to content)[^A-Za-z]*$"
BOILERPLATE = ("privacy policy", "terms of use", "terms of service", "cookie policy", "uses cookies", "accept cookies",
               "enable javascript", "subscribe to our newsletter", "click here", "all rights reserved", "lorem ipsum")
#: Longer lines that mention a boilerplate phrase are prose.
MOST_BOILERPLATE_WORDS = 25


def _any(text: Column) -> Column:
    out = F.lit(False)
    for phrase in BOILERPLATE:
        out = out | F.contains(text, F.lit(phrase))
    return out


def _barred(line: Column, size: Column) -> Column:
    """At least two separators, and many for the line's words; quotation marks in pairs and inner dots count nothing."""
    bare = line
    for pair in QUOTED:
        bare = F.regexp_replace(bare, pair, "$1")
    bars = F.regexp_count(F.regexp_replace(bare, INNER_DOT, ""), F.lit(SEPARATORS))
    return (bars >= 2) & (WORDS_PER_SEPARATOR * bars > size)


def line_fails(line: Column, noisy: Column | bool = True, barred: Column | bool = True,
               boiler: Column | bool = True, any_two_bars: bool = False) -> Column:
    """A line fails for noise (over a fifth of its words), for navigation or for boilerplate; blank lines pass.

    The flags tell whether the document holds any mark, separator or phrase at all. With
    `any_two_bars` two separators fail a line of any length, as the SQL of op4 has it.
    """
    size = F.regexp_count(line, F.lit(WORD))
    lower = F.lower(line)
    flag = lambda x: F.lit(x) if isinstance(x, bool) else x
    return ((flag(noisy) & (5 * F.regexp_count(line, F.lit(NOISE)) > size))
            | (flag(barred) & (F.regexp_count(line, F.lit(SEPARATORS)) >= 2) & (any_two_bars or _barred(line, size)))
            | ((F.length(line) <= 60) & lower.rlike(MENU))
            | (flag(boiler) & _any(lower) & (size <= MOST_BOILERPLATE_WORDS)))


def judge_documents(docs: DataFrame, text: str = "text", width: int = 5, least_words: int = 10,
                    most_repeat_pct: int = 20, most_lost_pct: int = 30, any_two_bars: bool = False) -> DataFrame:
    """Add the counts, base_failed, kept, and clean_text (the lines that passed) to every row.

    A null or blank text has no words, fails the base rules and is not kept. A document goes
    when failing lines hold more than `most_lost_pct` percent of the characters in its lines.
    Repeated rows are judged alike. Input columns named like an added one are replaced.
    `any_two_bars` is the plain navigation rule of `line_fails`.
    """
    added = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
             "clean_text", "n_bad_lines", "lost_chars")
    given = [c for c in docs.columns if c not in added]
    names = [f"_c{i}" for i in range(len(given))]  # whatever the input's columns are called
    carried = [F.col(f"`{c}`").alias(n) for c, n in zip(given, names)]
    whole = F.coalesce(F.col(text), F.lit(""))
    df = docs.select(*carried, words_of(F.col(text)).alias("_words"), F.split(whole, "\n", -1).alias("_lines"),
                     whole.rlike(NOISE).alias("_noisy"), whole.rlike(SEPARATORS).alias("_barred"),
                     _any(F.lower(whole)).alias("_boiler"),
                     F.length(F.regexp_replace(whole, SYMBOLS, "")).cast("long").alias("n_symbols"))
    flags = [F.col("_noisy"), F.col("_barred"), F.col("_boiler")]
    df = df.select(
        *names, "n_symbols", "_lines", F.size("_words").cast("long").alias("n_words"),
        F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_hashes"),
        F.filter("_lines", lambda line: line.rlike(WORD)).alias("_full"),
        F.filter("_lines", lambda line: line_fails(line, *flags, any_two_bars)).alias("_bad"), *flags)
    grams = F.transform(F.slice("_hashes", width, 2**30),
                        lambda h, i: F.xxhash64(h, *(F.get("_hashes", i + k) for k in range(width - 1))))
    df = df.select(
        *names, "n_symbols", "n_words", "word_chars", "_lines", "_bad", *flags,
        (F.size("_full") - F.size(F.array_distinct("_full"))).cast("long").alias("n_dup_lines"),
        grams.alias("_grams"))
    # (hash, position) sorted, only where some window repeats
    spots = F.sort_array(F.transform("_grams", lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    df = df.withColumn("_spots", F.when(F.size(F.array_distinct("_grams")) < F.size("_grams"), spots))
    same = lambda x, i: F.coalesce(x["h"] == F.get("_spots", i)["h"], F.lit(False))
    twice = F.transform("_spots", lambda x, i: F.when(same(x, i - 1) | same(x, i + 1), x["i"]))
    df = df.withColumn("_starts", F.sort_array(F.filter(twice, lambda i: i.isNotNull())))
    cover = F.transform("_starts", lambda x, i: F.least(F.lit(width), F.get("_starts", i + 1) - x))
    lost, total = F.length(F.array_join("_bad", "")), F.length(F.array_join("_lines", ""))
    df = df.withColumns({
        "n_repeat_words": F.coalesce(F.aggregate(cover, F.lit(0), lambda a, x: a + x), F.lit(0)).cast("long"),
        "lost_chars": lost.cast("long"), "_total": total, "n_bad_lines": F.size("_bad").cast("long"),
        "clean_text": F.when(F.size("_bad") == 0, F.array_join("_lines", "\n")).otherwise(
            F.array_join(F.filter("_lines", lambda line: ~line_fails(line, *flags, any_two_bars)), "\n"))})
    failed = (F.col("n_words") < least_words) | (
        100 * F.col("n_repeat_words") > most_repeat_pct * F.col("n_words"))
    df = df.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (100 * F.col("lost_chars") <= most_lost_pct * F.col("_total")))
    return df.select(*[F.col(n).alias(c) for c, n in zip(given, names)], *added)
