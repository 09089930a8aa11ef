"""Phrases whose words stand together more often than their parts would by chance, per language.

A task numbers the words of its texts and sorts all runs of up to five words. Each sorted run of
such n-grams becomes an acyclic automaton with a weight at every final state: a path is stored
from where it leaves the path before it, so equal beginnings are stored once. Automata are cut by
the first word, the first two or the first three words of their paths and dealt by them; the union
of all automata of one range sums the weights, and the count of a phrase is the weight of all paths through it.
Words are counted first: the most frequent ones have one number everywhere, so only other words are spelled
in an automaton, and where all words that are frequent enough have one, longer runs end at any other word.
Parts of a candidate are looked up in the counted phrases, where they have to be, as they are at least as frequent.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from newsfeat.llm.setsketch import _GOLD, mix
from newsfeat.operators.joins import lookup_join
from newsfeat.session import ship_package, stored

#: Words of the longest phrase.
LONGEST = 5
#: Words of one shard; characters of text for one range; rows a union holds before it adds them up; bytes split at once.
SHARD, RANGE, HELD, SLICE = 2_000_000, 12_000_000, 2_000_000, 1 << 20
#: Candidates that one task of the ranking sorts, about.
RANKED = 200_000
#: Words with one number in all tasks; ranges of longer phrases for one range of words.
KNOWN, WORD_RANGES = 1 << 18, 8
_CUT = 0xFF  # never part of UTF-8
_BYTES = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else _CUT if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


class _Numbers(dict):
    """word -> number: the known words' first, others in order of first sight, or 0 if `closed`; 0 is the end of a piece."""

    def __init__(self, known: list[bytes] = (), closed: bool = False):
        super().__init__({bytes([_CUT]): 0} | {word: i for i, word in enumerate(known, 1)})
        self.closed = closed

    def __missing__(self, word: bytes) -> int:
        if self.closed:
            return 0
        self[word] = n = len(self)
        return n


class Frequent:
    """The most frequent words of all languages; `closed` if no other word is frequent enough for a phrase."""

    def __init__(self, rows: list[tuple[str, str]], closed: bool):
        self.words = [w.encode() for w in dict.fromkeys(word for _, word in rows)]
        self.closed = closed
        place = {w: i for i, w in enumerate(self.words, 1)}
        self.of = defaultdict(list)
        for lang, word in rows:
            self.of[lang].append(place[word.encode()])

    def in_lang(self, lang: str) -> np.ndarray:
        """Of each number whether phrases of the language may have its word."""
        out = np.zeros(len(self.words) + 1, bool)
        out[self.of.get(lang, [])] = True
        return out


_NONE = Frequent([], False)


def words_of(text: str) -> Iterator[list[bytes]]:
    """Words of a text and the marks between its pieces, a slice at a time."""
    data = text.encode("utf-8", "surrogatepass").translate(_BYTES)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + SLICE)
        end = len(data) if end < 0 else end
        yield data[at:end].replace(b"\xff", b" \xff ").split()
        at = end


def add_up(paths: np.ndarray, weights: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct paths in order, with the sums of their weights."""
    if len(paths) < 2:
        return paths, weights
    order = np.lexsort(paths.T[::-1]) if paths.max() >= 1 << 21 else _packed_order(paths)
    paths, weights = paths[order], weights[order]
    first = np.flatnonzero(np.concatenate([[True], (paths[1:] != paths[:-1]).any(axis=1)]))
    return paths[first], np.add.reduceat(weights, first)


def _packed_order(paths: np.ndarray) -> np.ndarray:
    keys = []
    for at in range(0, paths.shape[1], 3):
        key = np.zeros(len(paths), np.uint64)
        for column in range(at, min(at + 3, paths.shape[1])):
            key = (key << np.uint64(21)) | paths[:, column].astype(np.uint64)
        keys.append(key)
    return np.lexsort(keys[::-1])


def leaves(paths: np.ndarray) -> np.ndarray:
    """Of each of the sorted distinct paths how many steps it shares with the one before it."""
    same = np.cumprod(paths[1:] == paths[:-1], axis=1, dtype=np.uint8).sum(axis=1)
    return np.concatenate([np.zeros(min(1, len(paths)), np.uint8), same]).astype(np.uint8)


def _planes(values: np.ndarray) -> bytes:
    """First the lowest bytes of all values, then the next ones: the high ones are alike and pack well."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def _from_planes(data: bytes, kind: type, n: int, at: int) -> np.ndarray:
    size = np.dtype(kind).itemsize
    return np.frombuffer(data, np.uint8, n * size, at).reshape(size, n).T.copy().view(kind).ravel()


def pack(paths: np.ndarray, weights: np.ndarray, words: np.ndarray, place: np.ndarray | None = None, known: int = 0) -> bytes:
    """The automaton of sorted distinct paths: words by number, then of each path the shared steps, the own ones and the weight.

    Own steps stand by depth, the first ones as differences.
    `place` is room for a number of each word, which callers with many automata pass on. Numbers up to `known` stay as they are.
    """
    place = np.zeros(len(words), np.int32) if place is None else place
    place[:known + 1] = np.arange(known + 1)
    if len(words) == known + 1:
        used = np.zeros(0, np.int64)
    elif paths.size > len(words):
        seen = np.zeros(len(words), bool)
        seen[paths] = True
        used = np.flatnonzero(seen)
    else:
        used = np.unique(paths)
    used = used[used > known]
    place[used] = np.arange(known + 1, known + len(used) + 1)
    own = place[paths]
    shared = leaves(paths)
    steps = own.T[np.arange(paths.shape[1])[:, None] >= shared[None, :]]
    kind = np.uint16 if steps.max(initial=0) < 65_535 else np.uint32
    light = np.uint16 if weights.max(initial=0) < 65_536 else np.int64
    named = b"\xff".join(words[used])
    head = np.array([paths.shape[1], len(paths), len(steps), len(named), kind is np.uint32, light is np.int64], np.int64)
    steps, first = steps.astype(kind), np.count_nonzero(shared == 0)
    steps[1:first] = np.diff(steps[:first])
    body = b"".join([head.tobytes(), named, shared.tobytes(), _planes(steps), _planes(weights.astype(light))])
    return len(body).to_bytes(8, "little") + pa.compress(body, "zstd", asbytes=True)


def unpack(data: bytes, numbers: dict, known: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Paths, by the numbers of a common vocabulary, and weights; the first `known` numbers are common already."""
    data = pa.decompress(data[8:], int.from_bytes(data[:8], "little"), "zstd", asbytes=True)
    width, rows, steps, named, wide, heavy = np.frombuffer(data, np.int64, 6).tolist()
    at = 48 + named
    words = data[48:at].split(b"\xff") if named else []
    place = np.concatenate([np.arange(known + 1), np.array([*map(numbers.__getitem__, words)], np.int64)])
    shared = np.frombuffer(data, np.uint8, rows, at)
    own = _from_planes(data, np.uint32 if wide else np.uint16, steps, at + rows)
    weights = _from_planes(data, np.int64 if heavy else np.uint16, rows, at + rows + own.nbytes).astype(np.int64)
    first = np.count_nonzero(shared == 0)
    own[:first] = np.cumsum(own[:first], dtype=own.dtype)
    paths = np.zeros((rows, width), np.int32)
    fresh = np.arange(width)[None, :] >= shared[:, None]
    paths.T[fresh.T] = place[own]
    for column in range(width):  # a shared step is the last one stored in its column
        last = np.maximum.accumulate(np.where(fresh[:, column], np.arange(rows), 0))
        paths[:, column] = paths[last, column]
    return paths, weights


def shard_automata(ids: np.ndarray, starts: int, words: np.ndarray, hashes: np.ndarray, ranges: int,
                   kinds: tuple[int, ...] = (1, 2, 3), known: int = 0) -> Iterator[tuple[int, int, bytes]]:
    """(kind, range, automaton) of the n-grams that begin at the first `starts` of the ids; kind is the number of dealt words."""
    ids, place = np.concatenate([ids, np.zeros(LONGEST, ids.dtype)]), np.zeros(len(words), np.int32)
    paths = np.zeros((starts, LONGEST if max(kinds) == 3 else max(kinds)), np.int32)
    paths[:, 0] = ids[:starts]
    for k in range(1, paths.shape[1]):
        paths[:, k] = np.where(paths[:, k - 1] > 0, ids[k:starts + k], 0)
    for kind in kinds:
        some = paths[paths[:, kind - 1] > 0]
        some = some if kind == 3 else some[:, :kind]
        distinct, weights = add_up(some, np.ones(len(some), np.int64))
        key = np.full(len(distinct), kind, np.uint64)
        for k in range(kind):
            key = mix(key * _GOLD ^ hashes[distinct[:, k]])
        dealt = (key % np.uint64(ranges)).astype(np.int64)
        order = np.argsort(dealt, kind="stable")
        edges = np.flatnonzero(np.diff(dealt[order], prepend=-1))
        for a, b in zip(edges, [*edges[1:], len(order)]):
            rows = order[a:b]
            yield kind, int(dealt[rows[0]]), pack(distinct[rows], weights[rows], words, place, known)


def _hashes(words: list[bytes]) -> np.ndarray:
    return mix(np.fromiter((zlib.crc32(w) | len(w) << 32 for w in words), np.uint64, len(words)) + _GOLD)


def count_shards(docs: DataFrame, ranges: int, kinds: tuple[int, ...] = (1, 2, 3), frequent: Frequent = _NONE) -> DataFrame:
    """lang, kind, range, total, automaton of rows (lang, text); kind 0, there with kind 1, has the number of words of a shard."""
    ship_package(docs.sparkSession)
    known, closed = len(frequent.words), frequent.closed

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = lambda: _Numbers(frequent.words, closed)
        numbers, held, size, turn = fresh(), defaultdict(list), 0, 0
        first, may = _hashes(list(numbers)), {}

        def flush(open_lang: str | None) -> Iterator[pa.RecordBatch]:
            """Hand on what is held; of a text still being read the last words begin the next shard."""
            nonlocal numbers, held, size, turn
            words = np.array(list(numbers), object)
            hashes = np.concatenate([first, _hashes(words[len(first):].tolist())])
            kept, tail = defaultdict(list), []
            for lang, parts in held.items():
                ids = np.concatenate(parts)
                starts = max(0, len(ids) - LONGEST + 1) if lang == open_lang else len(ids)
                if lang == open_lang:
                    tail = words[ids[starts:]].tolist()
                rows = [(0, turn % ranges, int((ids[:starts] > 0).sum()), None)] if 1 in kinds else []
                turn += 1
                if closed:
                    if lang not in may:
                        may[lang] = frequent.in_lang(lang)
                    ids = np.where(may[lang][ids], ids, 0)
                rows += [(kind, at, 0, data) for kind, at, data in shard_automata(ids, starts, words, hashes, ranges, kinds, known)]
                for i in range(0, len(rows), 64):
                    kind, at, total, data = zip(*rows[i:i + 64])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([lang] * len(kind)), pa.array(kind, pa.int32()), pa.array(at, pa.int64()),
                         pa.array(total, pa.int64()), pa.array(data, pa.binary())], ["lang", "kind", "range", "total", "automaton"])
            numbers, held, size = fresh(), kept, 0
            if tail:
                kept[open_lang].append(np.array([numbers[w] for w in tail], np.int32))

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                parts = held[lang]
                for some in words_of(text.as_py()):
                    parts.append(np.array(list(map(numbers.__getitem__, some)), np.int32))
                    size += len(some)
                    if size >= SHARD:
                        yield from flush(lang)
                        parts = held[lang]
                parts.append(np.zeros(1, np.int32))
        yield from flush(None)

    return docs.mapInArrow(run, "lang string, kind int, range long, total long, automaton binary")


def unite(automata: DataFrame, least: int, frequent: Frequent = _NONE) -> DataFrame:
    """lang, words, phrase, f: the phrases that occur `least` times; words 0 has parts of the number of all words."""

    def run(table: pa.Table) -> pa.Table:
        lang, kind = table.column("lang")[0].as_py(), table.column("kind")[0].as_py()
        size, phrase, f = [], [], []
        if kind == 0:
            size, phrase, f = [0], [""], [sum(table.column("total").to_pylist())]
        else:
            numbers, parts, held = _Numbers(frequent.words), [], 0
            for cell in table.column("automaton"):
                parts.append(unpack(cell.as_py(), numbers, len(frequent.words)))
                held += len(parts[-1][0])
                if held > HELD:
                    parts = [add_up(*(np.concatenate(x) for x in zip(*parts)))]
                    held = -len(parts[0][0])  # until as much again has come
            paths, weights = add_up(*(np.concatenate(x) for x in zip(*parts)))
            shared, words = leaves(paths), list(numbers)
            for depth in range(kind, (LONGEST if kind == 3 else kind) + 1):
                begin = np.flatnonzero(shared < depth)  # a state of this depth; all paths through it follow
                through = np.add.reduceat(weights, begin)
                often = (through >= least) & (paths[begin, depth - 1] > 0)
                for path, n in zip(paths[begin[often], :depth].tolist(), through[often].tolist()):
                    size.append(depth)
                    phrase.append(b" ".join([words[i] for i in path]))
                    f.append(n)
        return pa.table({"lang": pa.array([lang] * len(size), pa.string()), "words": pa.array(size, pa.int32()),
                         "phrase": pa.array(phrase, pa.string()), "f": pa.array(f, pa.int64())})

    return automata.groupBy("lang", "kind", "range").applyInArrow(run, "lang string, words int, phrase string, f long")


def count_phrases(docs: DataFrame, least: int) -> tuple[DataFrame, DataFrame]:
    """lang, words, phrase, f of the phrases of one to five words that occur `least` times, and lang, n."""
    size = docs.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    ranges = 1 + size // RANGE
    words = stored(unite(count_shards(docs, 1 + ranges // WORD_RANGES, (1,)), least), "words")
    often = words.where("words = 1").orderBy(F.desc("f"), "lang", "phrase").limit(KNOWN + 1).select("lang", "phrase").collect()
    frequent = Frequent([(r["lang"], r["phrase"]) for r in often[:KNOWN]], len(often) <= KNOWN)
    counted = stored(unite(count_shards(docs, ranges, (2, 3), frequent), least, frequent), "phrases")
    totals = words.where("words = 0").groupBy("lang").agg(F.sum("f").alias("n"))
    return words.where("words > 0").unionByName(counted), stored(totals, "totals")


def collocations(docs: DataFrame, lang: str = "lang", text: str = "text", *, least: int = 100,
                 top: int = 2000) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score: the first `top` phrases of each language.

    Candidates are phrases of two to five words that occur a >= `least` times within the pieces between
    .,;:!? and line ends. The weakest cut into two parts of l and r occurrences gives the score,
    floor(1000 * a * n / (l * r)) for n words of the language. A candidate that never stands outside a
    longer one is dropped. Nulls: language `und`, empty text. Repeated rows count each time; other
    columns are not looked at; texts without a candidate give no rows.
    """
    slim = docs.select(F.coalesce(F.col(lang).cast("string"), F.lit("und")).alias("lang"),
                       F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    phrases, totals = count_phrases(slim, least)
    found = phrases.where("words > 1")
    split = found.select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    # f never grows with length, so equal counts with any longer phrase mean equal counts with one a word longer
    inner = split.where("words > 2").select("lang", "a", F.explode(F.array(
        F.array_join(F.slice("w", F.lit(1), F.col("words") - 1), " "),
        F.array_join(F.slice("w", F.lit(2), F.col("words") - 1), " "))).alias("phrase"))
    hidden = inner.groupBy("lang", "phrase").agg(F.max("a").alias("most"))
    alone = split.join(hidden, ["lang", "phrase"], "left").where("most IS NULL OR most < a").drop("most")

    cuts = alone.select("lang", "phrase", "a", "w", "words", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cuts = cuts.select("lang", "phrase", "a", "k", F.array_join(F.slice("w", F.lit(1), F.col("k")), " ").alias("left"),
                       F.array_join(F.slice("w", F.col("k") + 1, F.col("words") - F.col("k")), " ").alias("right"))
    for side, name in (("left", "l"), ("right", "r")):
        part = phrases.select("lang", F.col("phrase").alias(side), F.col("f").alias(name))
        cuts = lookup_join(cuts, part, ["lang", side])
    cuts = lookup_join(cuts, totals, "lang")
    whole = lambda c: F.col(c).cast("decimal(19,0)")
    # each product is below 10^38, and a <= l and a <= r keep the quotient in 64 bits
    score = F.call_function("div", (F.lit(1000).cast("decimal(4,0)") * (whole("a") * whole("n")).cast("decimal(34,0)")), whole("l") * whole("r"))
    best = cuts.select("lang", "phrase", "a", "n", F.struct(score.cast("long").alias("score"), "k", "l", "r").alias("cut"))
    best = best.groupBy("lang", "phrase").agg(F.first("a").alias("a"), F.first("n").alias("n"), F.min("cut").alias("cut"))
    best = stored(best.select("lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score"), "scored")

    # the first of each slice of a language, then the first of these
    slices = 1 + best.count() // RANKED
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    place = lambda *keys: F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    some = best.withColumn("slice", F.pmod(F.xxhash64("phrase"), F.lit(slices)))
    some = some.withColumn("rank", place("lang", "slice")).where(F.col("rank") <= top)
    return some.withColumn("rank", place("lang").cast("long")).where(F.col("rank") <= top).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score")
