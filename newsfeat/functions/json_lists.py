"""The objects of a JSON list that is broken somewhere."""

from __future__ import annotations

import json
import re
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from newsfeat.session import ship_package

_GAP, _END = re.compile(r"[\s,]*"), re.compile(r"\s*(?:,|\]|$)")
_NEXT = re.compile(r",\s*(?=\{)")
_decoder = json.JSONDecoder()


def _value_end(text: str, at: int, fields: Iterable[str] | None = None) -> int | None:
    """Where the value that begins here ends, if it is whole; with `fields`, if it is an object with one of them."""
    try:
        value, end = _decoder.raw_decode(text, at)
    except (ValueError, RecursionError):
        return None
    known = fields is None or isinstance(value, dict) and any(f in value for f in fields)
    return end if known and _END.match(text, end) else None


def split_objects(text: str, fields: Iterable[str]) -> Iterator[str]:
    """The texts of a list's values; what is broken is one text, up to the next object with one of the fields."""
    at = text.find("[") + 1
    while True:
        at = _GAP.match(text, at).end()
        if at >= len(text) or text[at] == "]" and not text[at + 1:].strip():
            return
        end = _value_end(text, at)
        if end is not None:
            yield text[at:end]
            at = end
            continue
        places = (m for m in _NEXT.finditer(text, at) if _value_end(text, m.end(), fields) is not None)
        found = next(places, None)
        yield text[at:found.start() if found else len(text)]
        at = found.end() if found else len(text)


def objects_of_list(text: Column, fields: list[str]) -> Column:
    """Array of the value texts of a JSON list; only a list that is broken leaves the JVM."""
    ship_package(SparkSession.active())

    @F.pandas_udf("array<string>")
    def mended(texts: pd.Series) -> pd.Series:
        return texts.map(lambda t: None if t is None else list(split_objects(t, fields)))

    whole = F.from_json(text, "array<string>")
    return F.coalesce(whole, mended(F.when(whole.isNull(), text)))
