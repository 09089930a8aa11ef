"""Near-dedup with SetSketch: register bands find candidates, a joint likelihood sifts them, full sets decide.

Registers hold floor(1 - log_b) of the smallest of many exponential variables of a set's
elements, cut to a range; registers of a union are the larger ones, so sketches merge. Documents
with the same shingle set are one class; only classes are compared. In each bucket of a band
members meet the bucket's first member; later only pairs that are not yet connected are looked
at, so a large group of near copies costs about one check a member.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.common import split_by_key
from newsfeat.llm.components import components, extend
from newsfeat.session import ship_package, stored

WORDS = 5
#: Links need 100 * intersection >= LINK * union.
LINK = 75
#: Register base, rate and range of the two-byte configuration.
BASE, RATE, TOP = 1.001, 20.0, 2**16 - 1
#: A pair at the limit meets in some band but for 5.5e-5 of cases, at 0.8 but for 3e-7; one at 0.2 in 0.3 percent.
BANDS, ROWS = 50, 6
REGISTERS = BANDS * ROWS
#: A pair goes when its best likelihood beats the best with a link by e^18, six standard deviations.
DOUBT = 18.0
#: Hashes and registers, counted in eight bytes, of one block of a bucket's members.
BLOCK = 65_536

_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_GOLD = np.uint64(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64) * _GOLD)
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_STEP = 0x100000001B3
_BACK = pow(_STEP, -1, 2**64)
_SHIFT = mix(np.arange(101, 101 + WORDS, dtype=np.uint64) * _GOLD) | np.uint64(1)


class _Powers:
    """Powers of the polynomial base and of its inverse, as many as the longest text so far."""

    def __init__(self):
        self.up = self.down = np.ones(1, np.uint64)

    def need(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 2 * len(self.up))
            for name, base in (("up", _STEP), ("down", _BACK)):
                table = np.full(n, base, np.uint64)
                table[0] = 1
                setattr(self, name, np.multiply.accumulate(table))


_powers = _Powers()


def shingles(text: str, words_each: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles of so many words, up to five; A-Z are lower-cased; none without words."""
    data = np.frombuffer(text.encode("utf-8", "surrogatepass").lower(), np.uint8)
    blank = np.concatenate([[True], _SPACE[data], [True]])
    edge = np.flatnonzero(blank[1:] != blank[:-1])
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return np.zeros(0, np.uint64)
    _powers.need(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE[data] * _powers.up[:len(data)], out=total[1:])
    words = mix((total[ends] - total[starts]) * _powers.down[starts] + (ends - starts).astype(np.uint64))
    k = min(words_each, len(words))
    rows = len(words) - k + 1
    out = np.full(rows, np.uint64(k))
    for i in range(k):
        out = out + words[i:i + rows] * _SHIFT[i]
    return np.unique(mix(out))


def registers(sets: list[np.ndarray]) -> np.ndarray:
    """uint16 registers, one row for each set of hashes; no set is empty.

    Each element throws points on a line at rate RATE * REGISTERS, each into a register drawn at
    random: every register then gets an exponential variable of its own from every element.
    Only points before the largest of the set's minima matter.
    """
    items, owner = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    low, at, step = np.full((len(sets), REGISTERS), np.inf), np.zeros(len(items)), 0
    while len(items):
        columns = 1 if step < 6 else 16  # small sets need many points, when few elements are left
        turn = mix(np.arange(step + 1, step + 1 + columns, dtype=np.uint64) * _GOLD)
        h = mix(items[:, None] ^ turn[None, :])
        x = -np.log(((h >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / (RATE * REGISTERS)
        x = at[:, None] + (np.cumsum(x, axis=1) if columns > 1 else x)
        where = ((h * _M1) >> np.uint64(32)) * np.uint64(REGISTERS) >> np.uint64(32)
        np.minimum.at(low.reshape(-1), (owner[:, None] * REGISTERS + where.astype(np.int64)).ravel(), x.ravel())
        alive = x[:, -1] < low.max(axis=1)[owner]
        items, owner, at, step = items[alive], owner[alive], x[alive, -1], step + columns
    return np.clip(np.floor(1 - np.log(low) / np.log(BASE)), 0, TOP).astype(np.uint16)


def sketches(sets: list[np.ndarray], most: int = 200_000) -> Iterator[np.ndarray]:
    """Registers of each set, a bounded number of elements at a time."""
    group, size = [], 0
    for s in sets:
        if group and size + len(s) > most:
            yield from registers(group)
            group, size = [], 0
        group.append(s)
        size += len(s)
    if group:
        yield from registers(group)


def band_keys(regs: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of each row of registers; the band's number is part of it."""
    rows = regs.reshape(*regs.shape[:-1], BANDS, ROWS).astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _GOLD
    for i in range(ROWS):
        key = mix(key ^ (rows[..., i] + np.uint64(i << 20)))
    return key.view(np.int64)


def sketch_documents(docs: DataFrame, key: str, text: str) -> DataFrame:
    """key, n_shingles, digest of the shingle set, registers; sketches are null for empty sets."""
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(cell.as_py()) for cell in batch.column("text")]
            sizes = [len(x) for x in sets]
            digests = [hashlib.blake2b(x.tobytes(), digest_size=16).digest() if len(x) else None for x in sets]
            first = {d: x for d, x in zip(digests, sets) if d}  # equal sets are sketched once
            known = dict(zip(first, sketches(list(first.values()))))
            regs = [known[d].tobytes() if d else None for d in digests]
            yield pa.RecordBatch.from_arrays(
                [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()),
                 pa.array(regs, pa.binary())], ["key", "n_shingles", "digest", "registers"])

    return slim.mapInArrow(run, f"key {kind}, n_shingles long, digest binary, registers binary")


def band_spots(sketched: DataFrame) -> DataFrame:
    """node, bucket: the key of every band of each (node, registers)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                regs = np.frombuffer(b"".join(batch.column("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(batch.column("node").to_numpy(), BANDS)), pa.array(band_keys(regs).ravel())],
                    ["node", "bucket"])

    return sketched.select("node", "registers").mapInArrow(run, "node long, bucket long")


def log_likelihood(more: np.ndarray, less: np.ndarray, same: np.ndarray, na: np.ndarray, nb: np.ndarray,
                   j: np.ndarray) -> np.ndarray:
    """Of similarity j, from the numbers of registers that are larger, smaller and equal, and the set sizes."""
    u, v = na / (na + nb), nb / (na + nb)
    j = np.minimum(j, np.minimum(u / v, v / u))
    p = lambda x: -np.log1p(-np.clip(x, 0, 1) * (BASE - 1) / BASE) / np.log(BASE)
    up, down = p(u - v * j), p(v - u * j)
    log = lambda n, q: np.where(n > 0, n * np.log(np.maximum(q, 1e-12)), 0.0)
    return log(more, up) + log(less, down) + log(same, 1 - up - down)


_GRID = np.linspace(0.005, 1.0, 200)


def estimate(pairs: DataFrame, classes: DataFrame) -> DataFrame:
    """Of pairs (a, b) of classes those that may be linked, with the most likely similarity `est`."""
    one = classes.select("node", "n_shingles", "registers")
    rows = pairs.join(one.toDF("a", "na", "ra"), "a").join(one.toDF("b", "nb", "rb"), "b").where(
        f"100 * least(na, nb) >= {LINK} * greatest(na, nb)")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            ra, rb = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, REGISTERS)
                      for c in ("ra", "rb"))
            counts = [x.sum(axis=1)[:, None] for x in (ra > rb, ra < rb, ra == rb)]
            na, nb = (batch.column(c).to_numpy().astype(np.float64)[:, None] for c in ("na", "nb"))
            grid = log_likelihood(*counts, na, nb, _GRID[None, :])
            linked = grid[:, _GRID >= LINK / 100 - 0.005].max(axis=1)
            fine = np.flatnonzero(grid.max(axis=1) - linked <= DOUBT)
            best = _GRID[grid.argmax(axis=1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").take(pa.array(fine)), batch.column("b").take(pa.array(fine)),
                 pa.array(best[fine])], ["a", "b", "est"])

    return rows.select("a", "b", "na", "nb", "ra", "rb").mapInArrow(run, "a long, b long, est double")


def linked_sets(x: np.ndarray, y: np.ndarray) -> bool:
    """Whether two sorted sets reach the similarity."""
    if len(x) > len(y):
        x, y = y, x
    at = np.minimum(np.searchsorted(y, x), len(y) - 1)
    both = int((y[at] == x).sum())
    return 100 * both >= LINK * (len(x) + len(y) - both)


def verify(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """Of pairs (a, b) those whose full sets reach the similarity."""
    rows = pairs.select("a", "b").join(sets.toDF("a", "sa"), "a").join(sets.toDF("b", "sb"), "b")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fine = []
            for i, (x, y) in enumerate(zip(batch.column("sa"), batch.column("sb"))):
                if linked_sets(*(np.frombuffer(c.as_py(), np.uint64) for c in (x, y))):
                    fine.append(i)
            take = pa.array(fine, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column("a").take(take), batch.column("b").take(take)], ["a", "b"])

    return rows.mapInArrow(run, "a long, b long")


def shingle_sets(docs: DataFrame, wanted: DataFrame, key: str, text: str) -> DataFrame:
    """node, set (sorted hashes) of the wanted classes (node, first, digest), from the text of one of their rows.

    A bitmap of the wanted keys leaves the other texts out of the join's exchange.
    """
    slim = docs.select(F.col(key).alias("key"), F.col(text).alias("text"), F.xxhash64(F.col(key)).alias("spot"))
    slim, _ = split_by_key(slim, wanted.select(F.xxhash64("first").alias("spot")), "spot")
    rows = slim.join(wanted, slim["key"].eqNullSafe(wanted["first"])).select("node", "digest", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, sets = [], []
            for node, digest, t in zip(batch.column("node").to_pylist(), batch.column("digest"), batch.column("text")):
                items = shingles(t.as_py() or "")
                # a key that repeats may come with other texts
                if hashlib.blake2b(items.tobytes(), digest_size=16).digest() == digest.as_py():
                    nodes.append(node)
                    sets.append(items.tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(sets, pa.binary())], ["node", "set"])

    return rows.mapInArrow(run, "node long, set binary").dropDuplicates(["node"])


def _across(pairs: DataFrame, labels: DataFrame) -> DataFrame:
    """Pairs that are not connected yet."""
    la, lb = labels.toDF("a", "la"), labels.toDF("b", "lb")
    rows = pairs.join(la, "a", "left").join(lb, "b", "left")
    return rows.where("coalesce(la, a) <> coalesce(lb, b)").drop("la", "lb")


def private_counts(nodes: DataFrame, sets: DataFrame) -> DataFrame:
    """node, private: how many shingles of its set no other of the nodes has. Counts are combined before the shuffle."""
    wanted = sets.join(nodes.select("node").distinct(), "node", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for node, cell in zip(batch.column("node").to_pylist(), batch.column("set")):
                items = np.frombuffer(cell.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(items), node, np.int64)), pa.array(items)], ["node", "item"])

    items = wanted.select("node", "set").mapInArrow(run, "node long, item long")
    alone = items.groupBy("item").agg(F.count("*").alias("n"), F.min("node").alias("node")).where("n = 1")
    return alone.groupBy("node").agg(F.count("*").alias("private"))


def _may_link(named: DataFrame, sets: DataFrame) -> DataFrame:
    """Bucket members (bucket, node, label, n_shingles) with `spare`, without those no member can be linked with.

    A link of a and b needs an intersection of LINK / (100 + LINK) * (na + nb) shingles, and neither
    set has more to share than what is not private to it. With spare = (100 + LINK) * shared -
    LINK * n that means spare(a) >= LINK * nb and spare(b) >= LINK * na. Where members have one
    passage in common and texts of their own beside it, that empties the bucket in linear time.
    """
    shared = F.col("n_shingles") - F.coalesce("private", F.lit(0))
    rows = named.join(private_counts(named, sets), "node", "left").withColumn(
        "spare", (100 + LINK) * shared - LINK * F.col("n_shingles")).drop("private")
    rows = stored(rows, "spare")
    ends = rows.groupBy("bucket").agg(F.max("spare").alias("most"), F.min("n_shingles").alias("least"))
    return stored(rows.join(ends, "bucket").where(
        f"most >= {LINK} * n_shingles AND spare >= {LINK} * least").drop("most", "least"), "able")


def links_across(able: DataFrame, classes: DataFrame, sets: DataFrame) -> DataFrame:
    """Links (a, b) between members of a bucket with different labels; `able` has bucket, node, label, n_shingles, spare.

    Of two such members one at least is outside the bucket's largest part. The outsiders and all
    members are dealt into blocks of bounded size, and each pair of blocks is compared in place, so no
    pair is written but the links. A pair that shares more buckets is looked at in its first only.
    """
    width = F.col("n_shingles") + REGISTERS // 4
    parts = able.groupBy("bucket", "label").agg(F.count("*").alias("n"), F.sum(width).alias("w"))
    sizes = parts.groupBy("bucket").agg(
        F.max_by(F.struct("label", "w"), F.struct("n", "label")).alias("main"), F.sum("w").alias("w")).select(
        "bucket", F.col("main.label").alias("main"), F.ceil((F.col("w") - F.col("main.w")) / BLOCK).alias("outs"),
        F.ceil(F.col("w") / BLOCK).alias("alls")).where("outs > 0")
    rows = able.join(sizes, "bucket")
    numbers = lambda n: F.sequence(F.lit(0).cast("long"), n - 1)
    block = lambda n: F.pmod(F.xxhash64("node"), n)
    inner = rows.select("*", block(F.col("alls")).alias("y"), F.explode(numbers(F.col("outs"))).alias("x"),
                        F.lit(False).alias("asks"))
    outer = rows.where("label <> main").select("*", F.explode(numbers(F.col("alls"))).alias("y"),
                                               block(F.col("outs")).alias("x"), F.lit(True).alias("asks"))
    slim = ["bucket", "x", "y", "asks", "node", "label", "n_shingles", "spare"]
    dealt = inner.select(*slim).unionByName(outer.select(*slim)).join(
        classes.select("node", "registers").join(sets, "node"), "node")
    groups = dealt.groupBy("bucket", "x", "y").agg(F.collect_list(F.struct(
        "asks", "node", "label", "n_shingles", "spare", "registers", "set")).alias("members"))

    def compare(bucket: int, members: pa.StructArray) -> Iterator[tuple[int, int]]:
        node, label, n, spare = (members.field(c).to_numpy() for c in ("node", "label", "n_shingles", "spare"))
        asks = members.field("asks").to_numpy(zero_copy_only=False)
        regs = np.frombuffer(b"".join(members.field("registers").to_pylist()), np.uint16).reshape(-1, REGISTERS)
        items = [np.frombuffer(c.as_py(), np.uint64) for c in members.field("set")]
        inside = np.flatnonzero(~asks)
        for o in np.flatnonzero(asks):
            m = inside[(label[inside] != label[o]) & (spare[inside] >= LINK * n[o]) & (spare[o] >= LINK * n[inside])]
            if not len(m):
                continue
            same = regs[m] == regs[o]
            first = same.reshape(-1, BANDS, ROWS).all(axis=2).argmax(axis=1)
            own = int(np.flatnonzero(band_keys(regs[o]) == bucket)[0])
            m, same = m[first == own], same[first == own]
            more, equal = (regs[m] > regs[o]).sum(axis=1), same.sum(axis=1)
            counts = [x[:, None] for x in (more, REGISTERS - more - equal, equal)]
            grid = log_likelihood(*counts, n[m][:, None].astype(float), np.float64(n[o]), _GRID[None, :])
            linked = grid[:, _GRID >= LINK / 100 - 0.005].max(axis=1, initial=-np.inf)
            for i in m[grid.max(axis=1, initial=-np.inf) - linked <= DOUBT]:
                if linked_sets(items[o], items[i]):
                    yield int(node[o]), int(node[i])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [pair for bucket, members in zip(batch.column("bucket").to_pylist(), batch.column("members"))
                     for pair in compare(bucket, members.values)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([p[i] for p in found], pa.int64()) for i in (0, 1)], ["a", "b"])

    return groups.select("bucket", "members").mapInArrow(run, "a long, b long")


def near_groups(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: key, n_shingles, component_id (smallest key connected), kept (key is that one).

    A null or blank text has no shingles and is alone. Rows with equal shingle sets are
    connected; rows that repeat the smallest key are all kept. A null key counts as larger than
    any other: a group without another key has a null component_id and keeps its rows.
    """
    sketch = stored(sketch_documents(docs, key, text).withColumn("node", F.monotonically_increasing_id()), "sketch")
    full = sketch.where("n_shingles > 0")
    # the registers stay where they were written: a class is known by its first row
    classes = stored(full.groupBy("digest").agg(
        F.min("key").alias("first"), F.first("n_shingles").alias("n_shingles"), F.min("node").alias("node"),
        F.count("*").alias("copies")), "classes")
    copies = stored(full.select("digest", F.col("node").alias("copy")).join(
        classes.where("copies > 1").select("digest", "node"), "digest").where("copy <> node").select(
        F.col("copy").alias("node")), "copies")
    maybe, sure = split_by_key(full.select("node", "registers"), copies, "node")
    firsts = maybe.join(copies, "node", "left_anti")
    spots = band_spots(firsts if sure is None else firsts.unionByName(sure))
    sizes = stored(spots.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1"), "sizes")
    # members of buckets that others share; most buckets hold one class and are left out before the exchange
    crowd = stored(split_by_key(spots, sizes, "bucket")[0].join(sizes, "bucket"), "crowd")
    # the member that shares most is closest to the centre of its group
    people = stored(crowd.groupBy("node").agg(F.sum("n").alias("shared")).join(
        classes.select("node", "first", "digest", "n_shingles"), "node"), "people")
    held = stored(split_by_key(full.select("node", "registers"), people, "node")[0].join(
        people.select("node", "n_shingles"), "node"), "held")
    sets = stored(shingle_sets(docs, people.select("node", "first", "digest"), key, text), "sets")
    member = crowd.join(people.select("node", "shared", "n_shingles"), "node").select(
        "bucket", "node", "shared", "n_shingles")

    # every member with the central one of its buckets; the likeliest of these first
    lead = member.groupBy("bucket").agg(F.max(F.struct("shared", "node"))["node"].alias("lead"))
    pairs = member.join(lead, "bucket").where("node <> lead").select(
        F.col("lead").alias("a"), F.col("node").alias("b")).distinct()
    pairs = stored(estimate(pairs, held), "pairs")
    best = pairs.groupBy("b").agg(F.max_by("a", F.struct("est", "a")).alias("a"))
    links = stored(verify(best, sets), "links")
    labels = components(links)
    tried = pairs.select("a", "b")
    more = stored(_across(tried, labels).join(best, ["a", "b"], "left_anti").select("a", "b"), "more")
    labels = extend(labels, verify(more, sets))
    # at last the different parts of a bucket, where a bucket is still in several parts
    named = member.join(labels, "node", "left").withColumn("label", F.coalesce("label", "node"))
    split = named.groupBy("bucket").agg(F.min("label").alias("x"), F.max("label").alias("y")).where("x <> y")
    named = stored(named.join(split.select("bucket"), "bucket").select("bucket", "node", "label", "n_shingles"), "split")
    rest = stored(links_across(_may_link(named, sets), held, sets), "rest")
    labels = extend(labels, rest)

    by_class = classes.join(labels, "node", "left").select(
        "digest", "first", F.coalesce("label", "node").alias("label"))
    groups = by_class.groupBy("label").agg(F.min("first").alias("component_id"))
    found = stored(by_class.join(groups, "label").select("digest", "component_id"), "found")
    out = sketch.select("key", "n_shingles", "digest").join(found, "digest", "left")
    component = F.when(F.col("digest").isNull(), F.col("key")).otherwise(F.col("component_id"))
    return out.select(F.col("key").alias(key), "n_shingles", component.alias("component_id"),
                      F.col("key").eqNullSafe(component).alias("kept"))
