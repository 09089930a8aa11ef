"""English (Porter2) stemming of token columns.

The stemmer itself is the published algorithm for one word. Spark hands it whole Arrow
batches, in which only the distinct tokens are stemmed and then put back by position.
"""

from __future__ import annotations

import re
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed values of the Porter2 algorithm: whole-word exceptions, words left alone (from
# the start, and after step 1a), prefixes with their own first region, doubled
# consonants, letters allowed before "li", and the suffix tables of steps 2 to 4.
EXCEPTIONS = {
    "skis": "ski", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "idly": "idl", "gently": "gentl", "ugly": "ugli", "early": "earli", "only": "onli",
    "singly": "singl",
}
INVARIANTS = {"sky", "news", "howe", "atlas", "cosmos", "bias", "andes"}
INVARIANTS_1A = {
    "inning", "outing", "canning", "herring", "earring", "proceed", "exceed", "succeed",
}
REGION_PREFIXES = ("gener", "commun", "arsen")
DOUBLES = ("bb", "dd", "ff", "gg", "mm", "nn", "pp", "rr", "tt")
LI_ENDINGS = "cdeghkmnrt"
STEP_2 = {
    "tional": "tion", "enci": "ence", "anci": "ance", "abli": "able", "entli": "ent",
    "izer": "ize", "ization": "ize", "ational": "ate", "ation": "ate", "ator": "ate",
    "alism": "al", "aliti": "al", "alli": "al", "fulness": "ful", "ousli": "ous",
    "ousness": "ous", "iveness": "ive", "iviti": "ive", "biliti": "ble", "bli": "ble",
    "ogi": "og", "fulli": "ful", "lessli": "less", "li": "",
}
STEP_3 = {
    "tional": "tion", "ational": "ate", "alize": "al", "icate": "ic", "iciti": "ic",
    "ical": "ic", "ful": "", "ness": "", "ative": "",
}
STEP_4 = (
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent",
    "ism", "ate", "iti", "ous", "ive", "ize", "ion",
)

_REGION = re.compile("[aeiouy][^aeiouy]")
_SHORT_END = re.compile("(?:^[aeiouy][^aeiouy]|[^aeiouy][aeiouy][^aeiouywxY])$")


def _longest(word: str, suffixes) -> str:
    return max((s for s in suffixes if word.endswith(s)), key=len, default="")


def _has_vowel(part: str) -> bool:
    return re.search("[aeiouy]", part) is not None


def _regions(word: str) -> tuple[int, int]:
    """Start of the first and the second region."""
    def after(start: int) -> int:
        found = _REGION.search(word, start)
        return found.end() if found else len(word)

    prefix = _longest_prefix(word)
    first = len(prefix) if prefix else after(0)
    return first, after(first)


def _longest_prefix(word: str) -> str:
    return next((p for p in REGION_PREFIXES if word.startswith(p)), "")


def _plural(word: str) -> str:
    """Step 1a."""
    if word.endswith("sses"):
        return word[:-2]
    if word.endswith(("ied", "ies")):
        return word[:-2] if len(word) > 4 else word[:-1]
    if word.endswith("s") and not word.endswith(("us", "ss")) and _has_vowel(word[:-2]):
        return word[:-1]
    return word


def _past(word: str, r1: int) -> str:
    """Step 1b."""
    suffix = _longest(word, ("eed", "eedly", "ed", "edly", "ing", "ingly"))
    base = word[: len(word) - len(suffix)]
    if suffix.startswith("eed"):
        return base + "ee" if len(base) >= r1 else word
    if not suffix or not _has_vowel(base):
        return word
    if base.endswith(("at", "bl", "iz")):
        return base + "e"
    if base.endswith(DOUBLES):
        return base[:-1]
    if len(base) <= r1 and _SHORT_END.search(base):
        return base + "e"
    return base


def _derived(word: str, r1: int, r2: int) -> str:
    """Steps 2 to 4."""
    suffix = _longest(word, STEP_2)
    base = word[: len(word) - len(suffix)]
    if suffix and len(base) >= r1:
        blocked = (suffix == "ogi" and not base.endswith("l")) or (
            suffix == "li" and not base.endswith(tuple(LI_ENDINGS)))
        if not blocked:
            word = base + STEP_2[suffix]
    suffix = _longest(word, STEP_3)
    base = word[: len(word) - len(suffix)]
    if suffix and len(base) >= (r2 if suffix == "ative" else r1):
        word = base + STEP_3[suffix]
    suffix = _longest(word, STEP_4)
    base = word[: len(word) - len(suffix)]
    if suffix and len(base) >= r2 and (suffix != "ion" or base.endswith(("s", "t"))):
        word = base
    return word


def _final(word: str, r1: int, r2: int) -> str:
    """Step 5."""
    base = word[:-1]
    if word.endswith("e"):
        if len(base) >= r2 or (len(base) >= r1 and not _SHORT_END.search(base)):
            return base
    elif word.endswith("ll") and len(base) >= r2:
        return base
    return word


@lru_cache(maxsize=200_000)
def stem(word: str) -> str:
    if len(word) <= 2 or word in INVARIANTS:
        return word
    if word in EXCEPTIONS:
        return EXCEPTIONS[word]
    marked = re.sub("(^|[aeiouy])y", lambda m: m.group(1) + "Y", word)
    r1, r2 = _regions(marked)
    marked = _plural(marked)
    if marked in INVARIANTS_1A:
        return marked
    marked = _past(marked, r1)
    if marked[-1] in "yY" and len(marked) > 2 and marked[-2] not in "aeiouy":
        marked = marked[:-1] + "i"
    marked = _derived(marked, r1, r2)
    return _final(marked, r1, r2).lower()


def _stem_batch(values: pa.Array) -> pa.Array:
    encoded = pc.dictionary_encode(values)
    stems = pa.array([None if w is None else stem(w) for w in encoded.dictionary.to_pylist()], pa.string())
    return stems.take(encoded.indices)


@F.arrow_udf(T.StringType())
def stem_terms(terms: pa.Array) -> pa.Array:
    """Stem one term per row."""
    return _stem_batch(terms)


@F.arrow_udf(T.ArrayType(T.StringType()))
def stem_tokens(tokens: pa.Array) -> pa.Array:
    """Stem every token of an array, keeping order and length."""
    lengths = pc.fill_null(pc.list_value_length(tokens), 0).to_numpy(zero_copy_only=False)
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype("int32")
    return pa.ListArray.from_arrays(
        pa.array(offsets), _stem_batch(tokens.flatten()),
        mask=tokens.is_null() if tokens.null_count else None,
    )


def stem_table(terms: DataFrame, term: str = "term") -> DataFrame:
    """Distinct terms with their stems, for a stored vocabulary."""
    return terms.select(term).distinct().withColumn("stem", stem_terms(F.col(term)))
