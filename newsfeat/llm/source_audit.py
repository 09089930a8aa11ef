"""Divergence of the sources of a language: which other source, and which terms, set a source apart.

Terms kept in a language get numbers, block by block, and each source is one array of sorted
(number, count) pairs a block. Each unordered pair of sources is a task per block that walks the
shorter array through the longer one and prices terms of both, of one only and, by a closed form,
of neither, in both directions.
"""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsfeat.operators.joins import lookup_join
from newsfeat.session import ship_package, stored

#: Shares are whole numbers of this unit.
UNIT = 1_000_000_000
#: Entries a task counts before it hands them on; terms of a block; bytes of a text split at once.
HELD, BLOCK, SLICE = 1_000_000, 1 << 17, 1 << 20
#: Sources of a language that meet in one task of pairs, about.
TILE = 8
#: Letters and everything beyond ASCII, A-Z lower-cased; all other bytes become spaces.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 97 <= b <= 122 else 32 for b in range(256))


def terms_of(text: str) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a slice at a time."""
    data = text.encode("utf-8", "surrogatepass").translate(_TERMS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


def count_terms(docs: DataFrame) -> DataFrame:
    """lang, source, term, c (occurrences), d (documents) of rows (lang, source, text), combined within a task."""
    ship_package(docs.sparkSession)

    def rows(counts: dict, documents: dict) -> Iterator[pa.RecordBatch]:
        for (lang, source), found in counts.items():
            terms, held = list(found), documents[lang, source]
            for i in range(0, len(terms), 100_000):
                some = terms[i:i + 100_000]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(some)), pa.array([source] * len(some)), pa.array(some, pa.string()),
                     pa.array([found[t] for t in some], pa.int64()), pa.array([held[t] for t in some], pa.int64())],
                    ["lang", "source", "term", "c", "d"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, documents = defaultdict(Counter), defaultdict(Counter)
        for batch in batches:
            for lang, source, text in zip(*(batch.column(i).to_pylist() for i in range(3))):
                own, seen = counts[lang, source], set()
                for words in terms_of(text):
                    own.update(words)
                    seen.update(words)
                documents[lang, source].update(seen)
                if len(seen) > HELD // 10 or sum(map(len, counts.values())) > HELD:
                    yield from rows(counts, documents)
                    counts.clear()
                    documents.clear()
        yield from rows(counts, documents)

    return docs.mapInArrow(run, "lang string, source string, term string, c long, d long")


def kept_terms(docs: DataFrame, min_docs: int) -> DataFrame:
    """lang, source, term, c, total (of the language), block, tid, head (once a term) of the terms in enough documents.

    One exchange by (lang, term) serves the counts, the language's totals and the numbering; a term
    has at most one row a source and task there.
    """
    dealt = count_terms(docs).repartition("lang", "term")
    counted = dealt.groupBy("lang", "source", "term").agg(F.sum("c").alias("c"), F.sum("d").alias("d"))
    term = Window.partitionBy("lang", "term")
    kept = counted.select("lang", "source", "term", "c", F.sum("c").over(term).alias("total"),
                          F.sum("d").over(term).alias("df")).where(F.col("df") >= min_docs)
    names = ["lang", "source", "term", "c", "total"]

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, tid, last = TaskContext.get().partitionId() << 32, -1, None
        for batch in batches:  # sorted, so the rows of a term are neighbours
            keys = list(zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist()))
            heads = np.array([k != before for k, before in zip(keys, [last, *keys])], bool)
            tids = tid + np.cumsum(heads)
            if len(keys):
                tid, last = int(tids[-1]), keys[-1]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), pa.array(part + tids // BLOCK, pa.int64()),
                 pa.array(tids % BLOCK, pa.int64()), pa.array(heads)], [*names, "block", "tid", "head"])

    rows = kept.select(*names).sortWithinPartitions("lang", "term")
    return rows.mapInArrow(number, "lang string, source string, term string, c long, total long, "
                                   "block long, tid long, head boolean")


def share(counts: np.ndarray, whole: int) -> np.ndarray:
    """1 + floor(UNIT * (count + 1) / whole), by long division in three steps that stay within 64 bits."""
    rest, out = np.asarray(counts, np.int64) + 1, 0
    for _ in range(3):
        rest = rest * 1000
        out, rest = out * 1000 + rest // whole, rest % whole
    return out + 1


def price(p: np.ndarray, q: np.ndarray) -> int:
    """Sum of floor((p - q)^2 / q)."""
    return int(((p - q) ** 2 // q).sum())


def gallop(short: np.ndarray, long: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in both sorted arrays of the numbers they share; each search of the long one starts where the last ended."""
    if not len(long):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    at = np.minimum(np.searchsorted(long, short), len(long) - 1)
    hit = np.flatnonzero(long[at] == short)
    return hit, at[hit]


def priced_pair(a: tuple, b: tuple) -> tuple[int, int, int]:
    """Price of a against b and of b against a over the terms that either has, and the number of these terms.

    Each is (sorted numbers, shares, share of an absent term).
    """
    if len(a[0]) > len(b[0]):
        ba, ab, n = priced_pair(b, a)
        return ab, ba, n
    (ids_a, pa_, none_a), (ids_b, pb, none_b) = a, b
    at_a, at_b = gallop(ids_a, ids_b)
    only_a, only_b = np.delete(pa_, at_a), np.delete(pb, at_b)
    ab = price(pa_[at_a], pb[at_b]) + price(only_a, none_b) + price(none_a, only_b)
    ba = price(pb[at_b], pa_[at_a]) + price(none_b, only_a) + price(only_b, none_a)
    return ab, ba, len(pa_) + len(only_b)


def _pack(entries: pa.Scalar) -> bytes:
    ids, counts = (entries.values.field(n).to_numpy() for n in ("tid", "c"))
    return zlib.compress(np.diff(ids, prepend=0).astype(np.uint32).tobytes() + counts.astype(np.int64).tobytes(), 1)


def _unpack(data: bytes | None, whole: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    data = zlib.decompress(data) if data else b""
    n = len(data) // 12
    ids = np.cumsum(np.frombuffer(data, np.uint32, n).astype(np.int64))
    return ids, share(np.frombuffer(data, np.int64, n, 4 * n), whole), share(np.zeros(1), whole)


def source_arrays(kept: DataFrame) -> DataFrame:
    """lang, source, block, entries: the sorted (number, count) pairs of a source in a block, packed; at most BLOCK pairs."""
    lists = kept.groupBy("lang", "source", "block").agg(F.sort_array(F.collect_list(F.struct("tid", "c"))).alias("entries"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(i) for i in range(3)), pa.array([_pack(x) for x in batch.column(3)], pa.binary())],
                ["lang", "source", "block", "entries"])

    return lists.mapInArrow(run, "lang string, source string, block long, entries binary")


def pair_prices(arrays: DataFrame, groups: DataFrame) -> DataFrame:
    """lang, source, item, value for every ordered pair of sources of a language; groups has lang, source, whole, v.

    The sources of a language are dealt into tiles of about TILE; a task takes the arrays of two tiles in one
    block and prices their unordered pairs, so an array is copied once a tile and not once a source.
    """
    spark = groups.sparkSession
    tiles = groups.groupBy("lang").agg(F.ceil(F.count("*") / TILE).cast("long").alias("tiles"))
    blocks = arrays.select("lang", "block").distinct()
    cells = lookup_join(lookup_join(groups.select("lang", "source", "whole"), tiles, "lang").join(blocks, "lang"),
                        arrays, ["lang", "source", "block"], "left", max_rows=0)
    own, other = F.pmod(F.xxhash64("source"), F.col("tiles")), F.sequence(F.lit(0).cast("long"), F.col("tiles") - 1)
    cells = cells.select("lang", "block", "source", "whole", "entries", own.alias("own"), F.explode(other).alias("other"))
    keys = ["lang", "x", "y", "block"]
    cells = cells.select("lang", F.least("own", "other").alias("x"), F.greatest("own", "other").alias("y"), "block",
                         "own", "source", "whole", "entries")
    # a stated number: the arrays are small, the work on them is not
    cells = cells.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)

    def run(table: pa.Table) -> pa.Table:
        x, y = table.column("x")[0].as_py(), table.column("y")[0].as_py()
        rows = sorted(zip(*(table.column(n).to_pylist() for n in ("source", "own", "entries", "whole"))))
        sources = [(name, tile, _unpack(data, whole)) for name, tile, data, whole in rows if whole]
        out = [(a, b, *priced_pair(own_a, own_b)) for i, (a, tile_a, own_a) in enumerate(sources)
               for b, tile_b, own_b in sources[i + 1:] if x == y or tile_a != tile_b]
        a, b, ab, ba, n = zip(*out) if out else [()] * 5
        long = lambda v: pa.array(v, pa.int64())
        return pa.table({"lang": pa.array([table.column("lang")[0].as_py()] * len(out), pa.string()),
                         "a": pa.array(a, pa.string()), "b": pa.array(b, pa.string()),
                         "ab": long(ab), "ba": long(ba), "n": long(n)})

    parts = cells.groupBy(*keys).applyInArrow(run, "lang string, a string, b string, ab long, ba long, n long")
    a, b = groups.toDF("lang", "a", "whole_a", "v"), groups.select("lang", "source", "whole").toDF("lang", "b", "whole_b")
    pairs = a.join(b, "lang").where("a < b")
    sums = parts.groupBy("lang", "a", "b").agg(F.sum("ab").alias("ab"), F.sum("ba").alias("ba"), F.sum("n").alias("n"))
    rows = pairs.join(sums, ["lang", "a", "b"], "left").fillna(0, ["ab", "ba", "n"])
    none = lambda x: _share(F.lit(0), F.col(f"whole_{x}"))
    rows = rows.select("*", none("a").alias("none_a"), none("b").alias("none_b"), (F.col("v") - F.col("n")).alias("absent"))
    both = F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item"),
                              (F.col(x + y) + F.col("absent") * _price(F.col(f"none_{x}"), F.col(f"none_{y}"))).alias("value"))
                     for x, y in ("ab", "ba")))
    return rows.select("lang", F.inline(both))


def _share(count: Column, whole: Column) -> Column:
    """As share(); 1 where nothing is kept at all."""
    part = F.call_function("div", F.lit(UNIT).cast("decimal(38,0)") * (count + 1).cast("decimal(20,0)"),
                           F.greatest(whole, F.lit(1)).cast("decimal(20,0)"))
    return F.when(whole > 0, part + 1).otherwise(F.lit(1)).cast("long")


def _price(p: Column, q: Column) -> Column:
    return F.call_function("div", (p - q) * (p - q), q)


def audit_sources(docs: DataFrame, lang: str = "lang", source: str = "source", text: str = "text", *,
                  min_docs: int = 3, top: int = 200) -> DataFrame:
    """lang, source, part, item, value, rank.

    Part `pair` ranks the other sources of the language by how far the source is from them, part
    `term` the first `top` terms that the source has oftener than its language. Nulls in any of the
    three columns are ''; a source without kept terms has its pairs and no terms; equal values rank by
    item; no rows give none. Rows may repeat and count each time; other columns are not looked at.
    """
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    slim = docs.select(blank(lang).alias("lang"), blank(source).alias("source"), blank(text).alias("text"))
    kept = stored(kept_terms(slim, min_docs), "kept")
    per_lang = kept.groupBy("lang").agg(F.sum("c").alias("n"), F.sum(F.col("head").cast("long")).alias("v"))
    sums = kept.groupBy("lang", "source").agg(F.sum("c").alias("n"))
    groups = slim.select("lang", "source").distinct().join(sums, ["lang", "source"], "left").join(
        per_lang.select("lang", "v"), "lang", "left").fillna(0, ["n", "v"])
    groups = stored(groups.select("lang", "source", (F.col("n") + F.col("v")).alias("whole"), "v"), "groups")

    pairs = pair_prices(stored(source_arrays(kept), "arrays"), groups)
    wholes = per_lang.select("lang", (F.col("n") + F.col("v")).alias("whole_lang"))
    known = lookup_join(lookup_join(kept.select("lang", "source", "term", "c", "total"),
                                    groups.select("lang", "source", "whole"), ["lang", "source"]),
                        stored(wholes, "wholes"), "lang")
    p, q = _share(F.col("c"), F.col("whole")), _share(F.col("total"), F.col("whole_lang"))
    terms = known.select("lang", "source", "term", p.alias("p"), q.alias("q")).where("p > q").select(
        "lang", "source", F.col("term").alias("item"), _price(F.col("p"), F.col("q")).alias("value"))

    place = F.row_number().over(Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item"))
    ranked = lambda df, part: df.select(
        "lang", "source", F.lit(part).alias("part"), "item", F.col("value").cast("long").alias("value"), place.alias("rank"))
    return ranked(pairs, "pair").unionByName(ranked(terms, "term").where(F.col("rank") <= top))
