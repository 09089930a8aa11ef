"""Token files of patched frame-of-reference blocks.

A segment holds whole documents in key order: the number of ids of each, then blocks of 256
ids. A block stores its minimum, ids less the minimum packed at the width that fits a chosen
share of them, and the rest as exceptions (place, high bits). Block starts are indexed, so one
document is read without unpacking the others. Segments are the rows of a Parquet table: that is
how Spark's own writers put bytes in order into any store.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.common import prefix_bases
from newsfeat.llm.packing import encode_documents, ids_of
from newsfeat.session import scratch_path, ship_package

BLOCK = 256
#: Share of a block's ids that its width must hold.
SHARE = 0.9
#: A segment closes with the document that fills it; a longer document is a segment of its own.
SEGMENT_IDS = 1 << 17
#: Blocks packed or unpacked at a time: a bit takes several bytes meanwhile.
RUN = 256
#: Row groups of the token table; readers and writers hold one each.
GROUP_BYTES = 16 << 20
MAGIC = b"PFR1"


def _widths(low: np.ndarray) -> np.ndarray:
    """Bits that hold the SHARE quantile of each row."""
    mark = np.sort(low, axis=1)[:, int(np.ceil(SHARE * low.shape[1])) - 1]
    return np.where(mark == 0, 0, np.floor(np.log2(np.maximum(mark, 1).astype(np.float64))).astype(np.int64) + 1)


def _runs(width: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """(places of blocks, their width), at most RUN blocks at a time."""
    for w in np.unique(width):
        at = np.flatnonzero(width == w)
        for i in range(0, len(at), RUN):
            yield at[i:i + RUN], int(w)


def encode_blocks(ids: np.ndarray) -> bytes:
    """uint32 ids -> block index, packed blocks, exceptions. The last block is filled with its own last id."""
    count = len(ids)
    blocks = -(-count // BLOCK)
    grid = np.resize(ids, blocks * BLOCK)
    grid[count:] = ids[-1] if count else 0
    grid = grid.reshape(blocks, BLOCK)
    least = grid.min(axis=1, initial=2**32 - 1).astype("<u4") if blocks else np.zeros(0, "<u4")
    low = grid - least[:, None]
    width = _widths(low) if blocks else np.zeros(0, np.int64)
    over = low >> np.minimum(width, 31)[:, None].astype(np.uint32)
    over[width >= 32] = 0
    where = np.argwhere(over)
    packed: list[bytes] = [b""] * blocks
    for at, w in _runs(width):
        bits = ((low[at][:, :, None] >> np.arange(w, dtype=np.uint32)) & 1).astype(np.uint8)
        for i, row in zip(at, np.packbits(bits.reshape(len(at), -1), axis=1, bitorder="little")):
            packed[i] = row.tobytes()
    sizes = np.array([len(p) for p in packed], np.int64)
    starts = np.cumsum(sizes) - sizes
    n_over = np.bincount(where[:, 0], minlength=blocks) if blocks else np.zeros(0, np.int64)
    index = np.zeros(blocks, [("start", "<u4"), ("least", "<u4"), ("width", "u1"), ("over", "<u2")])
    index["start"], index["least"], index["width"], index["over"] = starts, least, width, n_over
    body = b"".join(packed)
    head = np.array([count, blocks, len(body), len(where)], "<u4").tobytes()
    return b"".join([head, index.tobytes(), body, where[:, 1].astype("u1").tobytes(),
                     over[tuple(where.T)].astype("<u4").tobytes()])


def decode_blocks(data: bytes, first: int = 0, last: int | None = None) -> np.ndarray:
    """The ids of blocks first..last (exclusive) of encode_blocks."""
    count, blocks, size, n_over = np.frombuffer(data, "<u4", 4).astype(np.int64)
    kind = np.dtype([("start", "<u4"), ("least", "<u4"), ("width", "u1"), ("over", "<u2")])
    index = np.frombuffer(data, kind, blocks, 16)
    at = 16 + index.nbytes
    body = np.frombuffer(data, np.uint8, size, at)
    place = np.frombuffer(data, np.uint8, n_over, at + size)
    high = np.frombuffer(data, "<u4", n_over, at + size + n_over)
    last = blocks if last is None else min(last, blocks)
    some = index[first:last]
    out = np.zeros((len(some), BLOCK), np.uint32)
    for rows, w in _runs(some["width"]):
        if w:
            take = some["start"][rows].astype(np.int64)[:, None] + np.arange(BLOCK * w // 8)
            bits = np.unpackbits(body[take], axis=1, bitorder="little").reshape(len(rows), BLOCK, w)
            wide = np.zeros((len(rows), BLOCK, 32), np.uint8)
            wide[:, :, :w] = bits
            out[rows] = np.packbits(wide.reshape(len(rows), -1), axis=1, bitorder="little").view("<u4")
    skip = int(index["over"][:first].sum())
    n = int(some["over"].sum())
    row = np.repeat(np.arange(len(some)), some["over"])
    out[row, place[skip:skip + n]] |= high[skip:skip + n] << some["width"][row].astype(np.uint32)
    out += some["least"][:, None]
    return out.reshape(-1)[:max(0, min(count, last * BLOCK) - first * BLOCK)]


def segment_bytes(sizes: list[int], ids: np.ndarray) -> bytes:
    return b"".join([MAGIC, np.array([len(sizes)], "<u4").tobytes(), np.array(sizes, "<u8").tobytes(),
                     encode_blocks(ids)])


def open_segment(data: bytes) -> tuple[np.ndarray, bytes]:
    """(ids of each document, the blocks)."""
    if data[:4] != MAGIC:
        raise ValueError("not a token segment")
    count = int(np.frombuffer(data, "<u4", 1, 4)[0])
    return np.frombuffer(data, "<u8", count, 8).astype(np.int64), data[8 + 8 * count:]


def read_document(data: bytes, number: int) -> np.ndarray:
    """One document of a segment; only its blocks are unpacked."""
    sizes, blocks = open_segment(data)
    start = int(sizes[:number].sum())
    first = start // BLOCK
    ids = decode_blocks(blocks, first, -(-(start + int(sizes[number])) // BLOCK))
    return ids[start - first * BLOCK:start - first * BLOCK + int(sizes[number])]


def write_tokens(docs: DataFrame, tokenizer: str, out: str, end_id: int = 2, spaced: bool = False,
                 key: str = "doc_id", text: str = "text", parts: int | None = None) -> None:
    """Write the token table: part, segment, before, keys, n_tokens, data; parts ascend with the key.

    `before` counts the ids of earlier segments of the part, so a reader needs only one total per part. Null keys come first; rows that repeat a key follow each other in no set order. A null text
    is one end id. Range bounds come from the keys alone, so no text is encoded twice.
    """
    spark = docs.sparkSession
    ship_package(spark)
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    steps = [i / parts for i in range(1, parts)]
    bounds = docs.where(F.col(key).isNotNull()).agg(
        F.percentile_approx(key, F.array(*map(F.lit, steps)), F.lit(100 * parts))).first()[0] if steps else None
    part = F.lit(0)
    for b in sorted(set(bounds or [])):
        part = part + F.coalesce(F.col("key") > F.lit(b), F.lit(False)).cast("int")
    kind = docs.schema[key].dataType.simpleString()
    rows = encode_documents(docs, tokenizer, end_id, spaced, key, text, running=False).withColumnRenamed(key, "key")
    rows = rows.withColumn("part", part).repartition(parts, "part").sortWithinPartitions("part", "key")

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, cells, now, seg, total, before = [], [], None, 0, 0, 0

        def close() -> pa.RecordBatch:
            sizes = [len(c) for c in cells]
            data = segment_bytes(sizes, np.concatenate(cells))
            return pa.RecordBatch.from_arrays([
                pa.array([now], pa.int32()), pa.array([seg], pa.int32()), pa.array([before], pa.int64()),
                pa.array([keys], schema_type), pa.array([sum(sizes)], pa.int64()), pa.array([data], pa.binary())],
                ["part", "segment", "before", "keys", "n_tokens", "data"])

        schema_type = None
        for batch in batches:
            schema_type = schema_type or pa.list_(batch.schema.field("key").type)
            for k, p, cell in zip(batch.column("key").to_pylist(), batch.column("part").to_pylist(),
                                  batch.column("ids")):
                if cells and (p != now or total >= SEGMENT_IDS):
                    yield close()
                    seg, before = (seg + 1, before + total) if p == now else (0, 0)
                    keys, cells, total = [], [], 0
                now = p
                keys.append(k)
                cells.append(ids_of(cell.as_py()))
                total += len(cells[-1])
        if cells:
            yield close()

    schema = f"part int, segment int, before long, keys array<{kind}>, n_tokens long, data binary"
    rows.mapInArrow(fold, schema).write.option("parquet.block.size", GROUP_BYTES).parquet(out)


def read_tokens(spark, path: str, key: str = "doc_id", with_ids: bool = True) -> DataFrame:
    """One row per document from the table: key, start (ids of all documents before it), n_tokens, ids_crc32, ids.

    An empty table has no row. No segment is moved: only the totals of the parts are gathered.
    """
    ship_package(spark)
    table = spark.read.parquet(path)
    by_part = table.groupBy("part").agg(F.sum("n_tokens")).collect()  # one row per part
    bases = spark.createDataFrame(prefix_bases((r[0], r[1]) for r in by_part)[0], "part int, base long")
    placed = table.join(F.broadcast(bases), "part").select("keys", "data", (F.col("base") + F.col("before")).alias("at"))
    kind = table.schema["keys"].dataType.elementType.simpleString()

    def unfold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for keys, cell, at in zip(batch.column("keys"), batch.column("data"), batch.column("at").to_pylist()):
                sizes, blocks = open_segment(cell.as_py())
                ids = decode_blocks(blocks)
                ends = np.cumsum(sizes)
                parts = [ids[e - n:e].astype("<u4").tobytes() for e, n in zip(ends, sizes)]
                columns = [keys.values, pa.array(at + ends - sizes, pa.int64()), pa.array(sizes, pa.int64()),
                           pa.array([zlib.crc32(p) for p in parts], pa.int64())]
                names = ["key", "start", "n_tokens", "ids_crc32"]
                if with_ids:
                    columns, names = [*columns, pa.array(parts, pa.binary())], [*names, "ids"]
                yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"key {kind}, start long, n_tokens long, ids_crc32 long" + (", ids binary" if with_ids else "")
    return placed.mapInArrow(unfold, schema).withColumnRenamed("key", key)


def tokens_of(docs: DataFrame, tokenizer: str, end_id: int = 2, spaced: bool = False, key: str = "doc_id",
              text: str = "text", with_ids: bool = False) -> DataFrame:
    """Write the table into the shared folder and read it back."""
    out = scratch_path(docs.sparkSession, "tokens")
    write_tokens(docs, tokenizer, out, end_id, spaced, key, text)
    return read_tokens(docs.sparkSession, out, key, with_ids)
