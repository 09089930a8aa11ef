"""Removal of long repeated byte strings by prefix-free parsing.

A rolling hash triggers at about one position in 16, and at every position of a stretch without
such a trigger, so equal passages are cut alike wherever they stand. A window of 200 bytes belongs
to the lowest of the triggers that have their core in it, and all windows of a trigger lie in one
context. The dictionary holds each distinct context once with its count. A context met twice
repeats in all its windows; only contexts that share their core with another one are opened, into
contexts of up to 16 windows and these into single windows, by the same rule. Equality is all that
removal needs, so contexts are grouped and the dictionary and the parse are not put into suffix order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.common import split_by_key
from newsfeat.llm.setsketch import _BYTE, _GOLD, _powers, mix
from newsfeat.operators.joins import fits, lookup_join
from newsfeat.session import ship_package, stored

WINDOW = 200
#: Bytes of a trigger, of a context's core, the mean distance of triggers, and windows of an inner context.
TRIGGER, CORE, EVERY, GROUP = 8, 40, 16, 16
#: Windows of one trigger start at most so many bytes before it.
SLACK = WINDOW - CORE
#: Texts are hashed together up to about so many bytes.
CHUNK = 1 << 19
PAGE_BITS, PAGES = 32_768, 2_048


class Hashed:
    """Hashes of all substrings of some bytes."""

    def __init__(self, data: bytes):
        b = np.frombuffer(data, np.uint8)
        self.n = len(b)
        _powers.need(self.n + 1)
        self.total = np.zeros(self.n + 1, np.uint64)
        np.cumsum(_BYTE[b] * _powers.up[:self.n], out=self.total[1:])

    def rolling(self) -> np.ndarray:
        """An unmixed hash of the trigger at each position."""
        last = max(0, self.n - TRIGGER + 1)
        return (self.total[TRIGGER:] - self.total[:last]) * _powers.down[:last]

    def spans(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix((self.total[ends] - self.total[starts]) * _powers.down[starts])

    def contexts(self, at: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Hashes of windows lo..hi of the triggers."""
        shape = mix(((at - lo).astype(np.uint64) << np.uint64(32)) | (hi - lo).astype(np.uint64))
        return mix(self.spans(lo, hi + WINDOW) ^ shape)


def _next_lower(value: np.ndarray, at: np.ndarray, equal: bool) -> np.ndarray:
    """Of each position the place of the next one with a lower value, or an equal one where asked, as far as SLACK; else far off."""
    n = len(value)
    place, to = np.append(at, at[-1:] + 2 * SLACK), np.minimum(np.arange(1, n + 2), n)
    value = np.append(value, np.uint64(0))
    act = np.arange(n)
    while len(act):
        q = to[act]
        higher = (value[q] > value[act]) if equal else (value[q] >= value[act])
        act = act[higher & (q < n) & (place[q] - place[act] <= SLACK)]
        to[act] = to[to[act]]  # all between are higher than the one that is left
    return place[to[:n]]


def parse(texts: list[bytes]) -> tuple[np.ndarray, ...]:
    """Of each context the text's number, its place, and hashes of core and context.

    A place has the first window's start in its text, the trigger's distance from it, and the number of windows but one.
    """
    hashed = Hashed(b"".join(texts))
    size = np.array([len(x) for x in texts], np.int64)
    ends = np.cumsum(size)
    roll = hashed.rolling()
    at = np.flatnonzero(roll < np.uint64(2**64 // EVERY))
    edge = np.concatenate([[-1], at, [len(roll)]])
    gaps = np.flatnonzero(np.diff(edge) > SLACK)
    if len(gaps):
        at = np.sort(np.concatenate([at, *(np.arange(edge[g] + 1, edge[g + 1]) for g in gaps)]))
    value = roll[at]
    # the first of equal ones is the lowest, so windows end before a lower one and begin after one as low
    after = _next_lower(value, at, False)
    before = -_next_lower(value[::-1], -at[::-1], True)[::-1]
    text = np.minimum(np.searchsorted(ends, at, side="right"), len(texts) - 1)
    lo = np.maximum(np.maximum(before + 1, at - SLACK), (ends - size)[text])
    hi = np.minimum(np.minimum(after - SLACK - 1, at), ends[text] - WINDOW)
    fine = lo <= hi
    text, at, lo, hi = text[fine], at[fine], lo[fine], hi[fine]
    core, context = hashed.spans(at, at + CORE), hashed.contexts(at, lo, hi)
    return text, _place(at, lo, hi, (ends - size)[text]), core.view(np.int64), context.view(np.int64)


def _place(at: np.ndarray, lo: np.ndarray, hi: np.ndarray, base: np.ndarray | int = 0) -> np.ndarray:
    return ((lo - base) << 16) | ((at - lo) << 8) | (hi - lo)


def _ranges(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Trigger, first and last window of places."""
    lo = place >> 16
    return lo + ((place >> 8) & 255), lo, lo + (place & 255)


def parse_inner(texts: list[bytes], text: np.ndarray, place: np.ndarray, step: int) -> tuple[np.ndarray, ...]:
    """Of the contexts at the texts' places, cut into those of up to `step` windows: the outer one's number, place, core and context.

    Single windows have no core of their own.
    """
    hashed = Hashed(b"".join(texts))
    size = np.array([len(x) for x in texts], np.int64)
    base = (np.cumsum(size) - size)[text]
    at, lo, hi = (x + base for x in _ranges(place))
    first, last = (at - hi) // step, (at - lo) // step
    size = last - first + 1
    outer = np.repeat(np.arange(len(place)), size)
    group = first[outer] + np.arange(len(outer)) - (np.cumsum(size) - size)[outer]
    at = at[outer]
    # windows whose distance to the trigger falls into one group have these bytes in common
    shared = at - group * step
    lo, hi = np.maximum(lo[outer], shared - step + 1), np.minimum(hi[outer], shared)
    context = hashed.contexts(at, lo, hi).view(np.int64)
    if step == 1:
        return outer, _place(at, lo, hi, base[outer]), np.zeros(len(outer), np.int64), context
    core = hashed.spans(shared, shared - step + 1 + WINDOW) ^ mix(group.astype(np.uint64) + _GOLD)
    return outer, _place(at, lo, hi, base[outer]), core.view(np.int64), context


def _chunks(column: pa.Array, *others: pa.Array) -> Iterator[tuple]:
    """The texts as bytes, with the others' cells, in runs of about CHUNK bytes."""
    texts = column.cast(pa.binary()).to_pylist()
    ends = np.cumsum([len(x) for x in texts]) // CHUNK
    edges = np.flatnonzero(np.diff(ends, prepend=-1))
    for a, b in zip(edges, [*edges[1:], len(texts)]):
        yield texts[a:b], *(x.slice(a, b - a) for x in others)


def contexts(texts: DataFrame) -> DataFrame:
    """(tid, text) -> tid, place, core, context: one row per context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, tid in _chunks(batch.column("text"), batch.column("tid")):
                text, place, core, context = parse(some)
                yield pa.RecordBatch.from_arrays([tid.take(pa.array(text)), pa.array(place), pa.array(core), pa.array(context)],
                                                 ["tid", "place", "core", "context"])

    return texts.mapInArrow(run, "tid long, place long, core long, context long")


def open_contexts(texts: DataFrame, step: int) -> DataFrame:
    """(tid, text, open) -> tid, place, core, context, asks for the contexts of `step` windows within the open ones.

    open: [(place, asks)]; a context that does not ask only shows its windows to those that do, once in a task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shown = set()
        for batch in batches:
            for some, tid, spots in _chunks(batch.column("text"), batch.column("tid"), batch.column("open")):
                fresh = []
                for t in tid.to_pylist():
                    fresh.append(t not in shown)
                    shown.add(t)
                flat = spots.flatten()
                place, asks = (flat.field(name).to_numpy(zero_copy_only=False) for name in ("place", "asks"))
                text = np.repeat(np.arange(len(some)), spots.value_lengths().to_numpy())
                wanted = asks | np.array(fresh)[text]
                text, place, asks = text[wanted], place[wanted], asks[wanted]
                outer, place, core, context = parse_inner(some, text, place, step)
                yield pa.RecordBatch.from_arrays([tid.take(pa.array(text[outer])), pa.array(place), pa.array(core), pa.array(context),
                                                  pa.array(asks[outer])], ["tid", "place", "core", "context", "asks"])

    return texts.mapInArrow(run, "tid long, place long, core long, context long, asks boolean")


def _slot(core: Column) -> Column:
    return F.pmod(core, F.lit(PAGE_BITS * PAGES))


def _likely(rows: DataFrame, known: DataFrame, key: str = "core") -> DataFrame:
    """Rows whose key may be among the known ones, by a bitmap of at most 8 MB; others that pass do no harm."""
    slots = known.select(_slot(F.col(key)).alias("slot"))
    pages = stored(slots.groupBy(F.expr(f"slot div {PAGE_BITS}").alias("page")).agg(
        F.expr(f"bitmap_construct_agg(slot % {PAGE_BITS})").alias("bits")), "pages")
    rows = rows.withColumn("slot", _slot(F.col(key))).withColumn("page", F.expr(f"slot div {PAGE_BITS}"))
    byte = F.conv(F.hex(F.expr(f"substring(bits, cast((slot % {PAGE_BITS}) div 8 as int) + 1, 1)")), 16, 10)
    hit = byte.cast("int").bitwiseAND(F.expr("shiftleft(1, cast(slot % 8 as int))")) != 0
    return rows.join(F.broadcast(pages), "page").where(hit).drop("slot", "page", "bits")


def _shared(spots: DataFrame) -> DataFrame:
    """Spots whose core stands at two spots or more, and a few others; those alone with their core repeat nothing."""
    again = spots.groupBy("core").agg(F.count("*").alias("n")).where("n > 1").select("core")
    return _likely(spots, stored(again, "cores"))


def _judge(spots: DataFrame, last: bool = False) -> tuple[DataFrame, DataFrame | None]:
    """(tid, place of contexts met twice; tid, place, asks of those to be opened) of rows (tid, place, core, context, asks).

    A context met twice is opened, at one spot, only for the others of its core. The last ones are single windows.
    """
    twice = F.expr("count(*) > 1 OR NOT min(asks)").alias("twice")
    if last:
        known = stored(spots.groupBy("context").agg(twice).where("twice").select("context"), "dictionary")
        asking = _likely(spots.where("asks").select("tid", "place", "context"), known, "context")
        return lookup_join(asking, known, "context", sieve=False).select("tid", "place"), None
    known = stored(spots.groupBy("core", "context").agg(twice), "dictionary")
    cores = stored(known.groupBy("core").agg(F.expr("count(*) > 1 AND NOT min(twice)").alias("open")).where(
        "open").select("core", "open"), "open-cores")
    known = lookup_join(known, cores, "core", "left")
    known = stored(known.where("twice OR open").select("context", "twice", F.coalesce("open", F.lit(False)).alias("open")), "known")
    met = stored(lookup_join(spots.select("tid", "place", "context", "asks"), known, "context", sieve=False).select(
        "tid", "place", (F.col("twice") & F.col("asks")).alias("full"), (F.col("open") & ~F.col("twice")).alias("alone"),
        F.expr("CASE WHEN open AND twice THEN context END").alias("shows")), "met")
    one = met.where("shows IS NOT NULL").groupBy("shows").agg(F.min(F.struct("tid", "place")).alias("at"))
    opened = met.where("alone").select("tid", "place", F.lit(True).alias("asks")).unionByName(
        one.select("at.tid", "at.place", F.lit(False).alias("asks")))
    return met.where("full").select("tid", "place"), opened


def _cut(data: bytes, gone: list[dict]) -> tuple[bytes, int]:
    """The bytes that stay, and the number of removed runs; `gone` is in order and apart."""
    kept, at = [], 0
    for run in gone:
        kept.append(data[at:run["lo"]])
        at = run["hi"]
    return b"".join([*kept, data[at:]]), len(gone)


def _merged(marks: DataFrame) -> DataFrame:
    """tid, gone: the byte ranges that windows at the places cover, as [(lo, hi)] in order and apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for places in batch.column("places"):
                _, lo, hi = _ranges(np.sort(places.values.to_numpy()))
                hi = np.maximum.accumulate(hi + WINDOW)
                first = np.flatnonzero(np.append(True, lo[1:] > hi[:-1]))
                ends = hi[np.append(first[1:] - 1, len(hi) - 1)]
                out.append([{"lo": a, "hi": b} for a, b in zip(lo[first].tolist(), ends.tolist())])
            yield pa.RecordBatch.from_arrays(
                [batch.column("tid"), pa.array(out, pa.list_(pa.struct([("lo", pa.int32()), ("hi", pa.int32())])))], ["tid", "gone"])

    grouped = marks.groupBy("tid").agg(F.collect_set("place").alias("places"))
    return grouped.mapInArrow(run, "tid long, gone array<struct<lo: int, hi: int>>")


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", with_text: bool = False) -> DataFrame:
    """One row per input row: key, n_bytes, n_removed, n_spans, kept_sha256, and with `with_text` kept (binary).

    Every byte goes that a 200-byte string covers which also starts elsewhere, in the same text
    too. Null is empty; texts under 200 bytes stay. Rows with equal texts lose all windows;
    repeated rows count as texts of their own. What stays may end inside a character.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.withColumn("tid", F.xxhash64("text"))
    parts = contexts(rows.where(F.octet_length("text") >= WINDOW).select("tid", "text"))
    # cores alone in the corpus are out before anything else is kept of them
    spots = stored(_shared(parts).withColumn("asks", F.lit(True)), "spots")
    full, opened = _judge(spots)
    marks = [full]
    for step in (GROUP, 1):
        asking = stored(opened.groupBy("tid").agg(F.collect_set(F.struct("place", "asks")).alias("open")), "open")
        spots = stored(open_contexts(lookup_join(rows.select("tid", "text"), asking, "tid"), step), "spots")
        full, opened = _judge(spots if step == 1 else _shared(spots), last=step == 1)
        marks.append(full)
    found = stored(_merged(marks[0].unionByName(marks[1]).unionByName(marks[2])), "found")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, left, spans, digests, kept = [], [], [], [], []
            for data, gone in zip(batch.column("text").cast(pa.binary()).to_pylist(), batch.column("gone").to_pylist()):
                stay, n = _cut(data, gone) if gone else (data, 0)
                sizes.append(len(data))
                left.append(len(data) - len(stay))
                spans.append(n)
                digests.append(hashlib.sha256(stay).hexdigest())
                kept.append(stay)
            columns = [batch.column("key"), *(pa.array(x, pa.int64()) for x in (sizes, left, spans)),
                       pa.array(digests, pa.string())]
            names = ["key", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_text:
                columns, names = [*columns, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = (f"key {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
              + (", kept binary" if with_text else ""))
    small = fits(found)
    # texts that surely lose nothing are not moved
    some, whole = (rows, None) if small else split_by_key(rows, found, "tid")
    out = lookup_join(some, found, "tid", "left", small_fits=small)
    if whole is not None:
        out = out.unionByName(whole.withColumn("gone", F.lit(None).cast(out.schema["gone"].dataType)))
    return out.select("key", "text", "gone").mapInArrow(cut, schema).withColumnRenamed("key", key)
