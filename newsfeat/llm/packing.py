"""Packing by concatenation: prefix sums give every document its place in one stream, which is cut at fixed length.

Pass one encodes each text once and keeps a running total within its partition. Pass two adds
the totals of earlier partitions; a document that crosses a cut yields a piece on either side.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsfeat.llm.common import prefix_bases
from newsfeat.llm.pieces import encoder
from newsfeat.session import ship_package, stored

SEQUENCE = 2048


def encode_documents(docs: DataFrame, path: str, end_id: int, spaced: bool, key: str = "doc_id", text: str = "text",
                     running: bool = True) -> DataFrame:
    """key, n_tokens, ids (little-endian uint16 or uint32 bytes), and with `running` part and before.

    A null text is empty: it has the end id alone. `before` counts the ids of earlier documents of
    the partition `part`, so the rows need no order once they are written.
    """
    ship_package(docs.sparkSession)
    kind = docs.schema[key].dataType.simpleString()
    slim = docs.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task = TaskContext.get()
        enc, part, before = encoder(path, spaced), task.partitionId() if task else 0, 0
        end = np.array([end_id], "<u4")
        for batch in batches:
            sizes, blobs, befores = [], [], []
            for t in batch.column("text"):
                ids = np.concatenate([enc.ids(t.as_py()), end])
                sizes.append(len(ids))
                befores.append(before)
                before += len(ids)
                blobs.append(ids.astype("<u2").tobytes() if ids.max() < 65_536 else b"\xff" + ids.tobytes())
            columns = [batch.column("key"), pa.array(sizes, pa.int64()), pa.array(blobs, pa.binary())]
            names = ["key", "n_tokens", "ids"]
            if running:
                columns += [pa.array([part] * len(sizes), pa.int32()), pa.array(befores, pa.int64())]
                names += ["part", "before"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = f"key {kind}, n_tokens long, ids binary" + (", part int, before long" if running else "")
    return slim.mapInArrow(encode, schema).withColumnRenamed("key", key)


def ids_of(blob: bytes) -> np.ndarray:
    """uint32 ids of an `ids` cell; an odd number of bytes marks four-byte ids."""
    return np.frombuffer(blob, "<u4", offset=1) if len(blob) % 2 else np.frombuffer(blob, "<u2").astype("<u4")


def pack(docs: DataFrame, path: str, end_id: int = 1, spaced: bool = True, key: str = "doc_id", text: str = "text",
         sequence: int = SEQUENCE, with_ids: bool = True) -> DataFrame:
    """Pieces: key, start, length, ids_crc32, doc_tokens, sequence_id, offset, and ids (bytes, uint32).

    Every document's ids with its end id lie in order in one stream, cut every `sequence` ids; only
    the last sequence is short. Documents follow partition order; repeated rows and null keys
    are documents like any other, a null text is one end id. An empty table gives no piece.
    """
    spark = docs.sparkSession
    rows = stored(encode_documents(docs, path, end_id, spaced, key, text), "encoded")
    totals = rows.groupBy("part").agg(F.sum("n_tokens")).collect()  # one row per partition
    bases, _ = prefix_bases((r[0], r[1]) for r in totals)
    offsets = spark.createDataFrame(bases, "part int, base long")
    placed = rows.join(F.broadcast(offsets), "part").select(
        F.col(key).alias("key"), (F.col("base") + F.col("before")).alias("at"), "ids")
    kind = docs.schema[key].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, starts, lengths, crcs, sizes, seqs, offs, blobs, source = [], [], [], [], [], [], [], [], []
            for row, (at, cell) in enumerate(zip(batch.column("at").to_pylist(), batch.column("ids"))):
                ids = ids_of(cell.as_py())
                start = 0
                while start < len(ids):
                    seq, off = divmod(at + start, sequence)
                    piece = ids[start:start + sequence - off].tobytes()
                    source.append(row)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    crcs.append(zlib.crc32(piece))
                    sizes.append(len(ids))
                    seqs.append(seq)
                    offs.append(off)
                    if with_ids:
                        blobs.append(piece)
                    start += len(piece) // 4
            keys = batch.column("key").take(pa.array(source, pa.int64()))
            columns = [keys, *(pa.array(x, pa.int64()) for x in (starts, lengths, crcs, sizes, seqs, offs))]
            names = ["key", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]
            if with_ids:
                columns, names = [*columns, pa.array(blobs, pa.binary())], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(columns, names)

    schema = (f"key {kind}, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
              + (", ids binary" if with_ids else ""))
    return placed.mapInArrow(cut, schema).withColumnRenamed("key", key)
