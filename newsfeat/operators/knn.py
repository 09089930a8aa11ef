"""Exact k nearest neighbours by cosine similarity.

Train vectors are grouped around a bounded set of pivots. Similarity bounds from the
cells' radii tell each test vector which cells can hold one of its k neighbours, so far
cells are never multiplied, and none that matters is skipped. Both sides are packed into
blocks, each written once: a task reads the blocks of a part of the train vectors again for each
block of test vectors and returns k rows per test vector, never visits or pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsfeat.session import ship_package, stored

# Pivots to group around, rows of a block, and the slack for rounding in the bounds.
PIVOTS = 256
BLOCK_ROWS = 16_384
SLACK = 1e-9

# Cells of a matrix that a task holds at once, and rows it hands on at once, with their vectors.
TILE, ROWS_OUT = 1 << 21, 4_096

# Test vectors of a block, at most and at least; bytes of the train blocks that a task of the join holds; blocks of train
# vectors that are put in the order of their cells together.
TEST_ROWS, LEAST_ROWS, PART_BYTES, SORTED_BLOCKS = 8_192, 256, 64 << 20, 4

# A label that is missing, and what is added to the label where the id is.
_NO_LABEL, _NO_ID = 1 << 40, 1 << 41

_BLOCK_SCHEMA = ("ids array<bigint>, labels array<int>, vectors binary, places binary, "
                 "cells array<struct<cell:int,n:bigint,radius:double>>")
_TEST_SCHEMA = "test_ids array<bigint>, test_vectors binary"
_VISIT_SCHEMA = "test_id bigint, unit array<double>, cell int"
_BEST_SCHEMA = "test_id bigint, train_id bigint, label int, similarity double"


def _tiles(rows: int, columns: int) -> Iterator[slice]:
    """Runs of rows whose matrix of so many columns stays within a tile."""
    step = max(1, TILE // max(1, columns))
    return (slice(at, at + step) for at in range(0, rows, step))


def unit_rows(vectors: pd.Series) -> np.ndarray:
    """Vectors scaled to length 1; zero vectors stay zero."""
    matrix = np.stack([np.asarray(v, dtype=np.float64) for v in vectors])
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _angles(units: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(units @ pivots.T, -1.0, 1.0))


def _pivots(train: DataFrame, n: int) -> np.ndarray:
    """At most n train vectors, picked by a hash of their ids."""
    rows = train.select("train_id", "vector").orderBy(F.xxhash64("train_id"), "train_id").limit(n).collect()
    if not rows:
        raise ValueError("no train vectors")
    units = unit_rows(pd.Series([r["vector"] for r in rows]))
    kept = units[np.linalg.norm(units, axis=1) > 0]
    return kept if len(kept) else units[:1]


def _kind(df: DataFrame) -> tuple[DataFrame, type]:
    """The frame with a vector of floats or else of doubles, and numpy's name for these."""
    if df.schema["vector"].dataType == T.ArrayType(T.FloatType(), df.schema["vector"].dataType.containsNull):
        return df, np.float32
    return df.withColumn("vector", F.col("vector").cast("array<double>")), np.float64


def _matrix(vectors: pa.Array, kind: type) -> np.ndarray:
    lengths = pc.unique(pc.list_value_length(vectors)).to_pylist()
    if len(lengths) != 1 or lengths[0] is None:
        raise ValueError("vectors must have one length")
    return vectors.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(vectors), lengths[0])


def _units(body: bytes, rows: int, kind: type) -> np.ndarray:
    matrix = np.frombuffer(body, kind).reshape(rows, -1).astype(np.float64)
    norms = np.linalg.norm(matrix, axis=1, keepdims=True)
    return matrix / np.where(norms == 0, 1.0, norms)


def _runs(batches: Iterator[pa.RecordBatch], rows: int) -> Iterator[pa.Table]:
    """The rows of a task in runs of `rows`."""
    held, size = [], 0
    for batch in batches:
        while len(batch):
            some = batch.slice(0, rows - size)
            batch, size = batch.slice(len(some)), size + len(some)
            held.append(some)
            if size == rows:
                yield pa.Table.from_batches(held).combine_chunks()
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def _lists(values: pa.ChunkedArray) -> pa.Array:
    values = values.combine_chunks()
    values = values if isinstance(values, pa.Array) else pa.concat_arrays(values.chunks)
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def _assign(train: DataFrame, pivots: np.ndarray, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of train rows in the order of their ids, with the place of each row's cell among the block's cells."""
    train, kind = _kind(train)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, SORTED_BLOCKS * block_rows):
            matrix = _matrix(pa.concat_arrays(rows.column("vector").chunks), kind)
            cell, angle = np.empty(len(matrix), np.int32), np.empty(len(matrix))
            for some in _tiles(len(matrix), len(pivots)):
                angles = _angles(_units(matrix[some].tobytes(), len(matrix[some]), kind), pivots)
                cell[some], angle[some] = angles.argmin(axis=1), angles.min(axis=1)
            by_cell = np.argsort(cell, kind="stable")
            ids = rows.column("train_id").to_numpy()
            for at in range(0, len(by_cell), block_rows):
                block = by_cell[at:at + block_rows]
                block = block[np.argsort(ids[block], kind="stable")]
                cells, place, n = np.unique(cell[block], return_inverse=True, return_counts=True)
                radius = np.zeros(len(cells))
                np.maximum.at(radius, place, angle[block])
                some = rows.take(pa.array(block))
                yield pa.RecordBatch.from_arrays(
                    [_lists(some.column("train_id")), _lists(some.column("label")), pa.array([matrix[block].tobytes()], pa.binary()),
                     pa.array([place.astype(np.int32).tobytes()], pa.binary()),
                     pa.array([[{"cell": int(c), "n": int(m), "radius": float(r)} for c, m, r in zip(cells, n, radius)]],
                              pa.list_(pa.struct([("cell", pa.int32()), ("n", pa.int64()), ("radius", pa.float64())])))],
                    ["ids", "labels", "vectors", "places", "cells"])

    return train.select("train_id", "label", "vector").mapInArrow(assign, _BLOCK_SCHEMA)


def _test_blocks(test: DataFrame, block_rows: int) -> DataFrame:
    test, kind = _kind(test)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _runs(batches, block_rows):
            matrix = _matrix(pa.concat_arrays(rows.column("vector").chunks), kind)
            yield pa.RecordBatch.from_arrays(
                [_lists(rows.column("test_id")), pa.array([matrix.tobytes()], pa.binary())], ["test_ids", "test_vectors"])

    return test.select("test_id", "vector").mapInArrow(pack, _TEST_SCHEMA)


def _reached(units: np.ndarray, pivots: np.ndarray, cells: np.ndarray, sizes: np.ndarray, radii: np.ndarray,
             k: int) -> np.ndarray:
    """For each test vector which cells may hold one of its k neighbours."""
    angles = _angles(units, pivots[cells])
    least = np.cos(np.minimum(angles + radii, np.pi))
    most = np.cos(np.maximum(angles - radii, 0.0))
    order = np.argsort(-least, axis=1, kind="stable")
    enough = (np.cumsum(sizes[order], axis=1) >= k).argmax(axis=1)
    last = order[np.arange(len(order)), enough]
    bound = least[np.arange(len(order)), last]
    if sizes.sum() < k:
        bound = np.full(len(order), -2.0)
    return most >= bound[:, None] - SLACK


def _visits(test: DataFrame, pivots: np.ndarray, cells: np.ndarray, sizes: np.ndarray, radii: np.ndarray,
            k: int) -> DataFrame:
    """One row per test vector and cell that may hold one of its k neighbours."""

    def visit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if batch.empty:
                continue
            units, ids = unit_rows(batch["vector"]), batch["test_id"].to_numpy()
            for some in _tiles(len(units), len(cells)):
                row, column = np.nonzero(_reached(units[some], pivots, cells, sizes, radii, k))
                for at in range(0, len(row), ROWS_OUT):
                    at = slice(at, at + ROWS_OUT)
                    yield pd.DataFrame({"test_id": ids[some][row[at]], "unit": list(units[some][row[at]]),
                                        "cell": cells[column[at]].astype("int32")})

    return test.mapInPandas(visit, _VISIT_SCHEMA)


class _Nearest:
    """The k most similar train rows seen so far of each row of a block of test vectors."""

    def __init__(self, ids: pa.Array, units: np.ndarray, reach: np.ndarray, k: int):
        self.ids, self.units, self.reach, self.k = ids, units, reach, k
        self.rough = units.astype(np.float32)
        #: More than a product of two rough vectors can be wrong.
        self.error = (units.shape[1] + 8) * 2.0 ** -23
        self.similarity = np.full((len(units), k), -np.inf)
        self.train, self.label = (np.zeros((len(units), k), np.int64) for _ in range(2))

    def add(self, ids: np.ndarray, labels: np.ndarray, units: np.ndarray, place: np.ndarray, cells: np.ndarray) -> None:
        """Look at a block of train rows in the order of their ids; `cells` are its cells' places among all, `place` a row's among these."""
        rough = units.astype(np.float32)
        rows = np.flatnonzero(self.reach[:, cells].any(axis=1))
        for some in _tiles(len(rows), len(units)):
            some = rows[some]
            open_cells = self.reach[np.ix_(some, cells)].any(axis=0)
            if open_cells.all():
                self._look(some, ids, labels, units, rough)
            else:
                kept = open_cells[place]
                self._look(some, ids[kept], labels[kept], units[kept], rough[kept])

    def _look(self, some: np.ndarray, ids: np.ndarray, labels: np.ndarray, units: np.ndarray, rough: np.ndarray) -> None:
        least = self.similarity[some, -1:]
        row = column = None
        if np.isfinite(least).all():
            row, column = np.divmod(np.flatnonzero(self.rough[some] @ rough.T >= (least - self.error).astype(np.float32)), len(ids))
        if row is not None and len(row) <= 64 * len(some):
            similarity = np.round(np.einsum("ij,ij->i", self.units[some[row]], units[column]), 12)
        else:  # the first block, or one with very many equal vectors
            every, keep = np.round(self.units[some] @ units.T, 12), min(self.k, len(ids))
            least = -np.partition(-every, keep - 1, axis=1)[:, keep - 1:keep]
            above, tied = every > least, every == least
            # Columns are in id order, so the first ties are those with the smallest ids.
            room = keep - above.sum(axis=1, keepdims=True)
            row, column = np.nonzero(above | (tied & (np.cumsum(tied, axis=1) <= room)))
            similarity = every[row, column]
        if len(row):
            self._merge(some[row], similarity, ids[column], labels[column])

    def _merge(self, row: np.ndarray, similarity: np.ndarray, ids: np.ndarray, labels: np.ndarray) -> None:
        rows, k = np.unique(row), self.k
        row = np.concatenate([row, np.repeat(rows, k)])
        parts = [np.concatenate([new, old[rows].ravel()]) for new, old in
                 ((similarity, self.similarity), (ids, self.train), (labels, self.label))]
        order = np.lexsort((parts[1], -parts[0], row))
        row = row[order]
        first = np.searchsorted(row, rows)
        kept = order[first[:, None] + np.arange(k)]
        for old, values in zip((self.similarity, self.train, self.label), parts):
            old[rows] = values[kept]

    def found(self) -> pa.RecordBatch:
        row, rank = np.nonzero(self.similarity > -np.inf)
        train, label = self.train[row, rank], self.label[row, rank]
        no_id = label >= _NO_ID
        label = label - np.where(no_id, _NO_ID, 0)
        no_label = label >= _NO_LABEL
        return pa.RecordBatch.from_arrays(
            [self.ids.take(pa.array(row)), pa.array(train, mask=no_id), pa.array(np.where(no_label, 0, label).astype(np.int32), mask=no_label),
             pa.array(self.similarity[row, rank])], ["test_id", "train_id", "label", "similarity"])


def neighbours(train: DataFrame, test: DataFrame, k: int = 3, pivots: int | None = None,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """test_id, train_id, label, similarity, rank of the k nearest train rows.

    `train` has train_id, vector and label, `test` has test_id and vector, ids are unique.
    Equal similarities are ranked by train_id. There are about four cells per block of
    rows, at most PIVOTS, unless `pivots` says otherwise. On disk are each vector once a side and k rows for each test
    vector and part of PART_BYTES of the train vectors.
    """
    spark = train.sparkSession
    ship_package(spark)
    train = train.select(F.col("train_id").cast("bigint"), F.col("vector"), F.col("label").cast("int"))
    test = test.select(F.col("test_id").cast("bigint"), "vector")
    if pivots is None:
        pivots = min(PIVOTS, max(1, -(-4 * train.count() // block_rows)))
    centres = _pivots(train, pivots)
    blocks = stored(_assign(train, centres, block_rows), "knn-train")
    # One row per cell, so at most `pivots` rows reach the driver.
    stats = blocks.select(F.inline("cells")).groupBy("cell").agg(F.sum("n").alias("n"), F.max("radius").alias("radius")).orderBy("cell").collect()
    cells = np.array([s["cell"] for s in stats])
    sizes = np.array([s["n"] for s in stats])
    radii = np.array([s["radius"] for s in stats]) + SLACK
    size = blocks.agg(F.sum(F.octet_length("vectors") + F.octet_length("places") + 16 * F.size("ids"))).first()[0]
    count, tasks = test.count(), 2 * spark.sparkContext.defaultParallelism
    test_rows = min(TEST_ROWS, max(LEAST_ROWS, -(-count // tasks)))
    packed = _test_blocks(test, test_rows).withColumn("block", F.monotonically_increasing_id()).repartition(max(1, -(-count // test_rows)))
    # Nothing is shuffled for the join: a task holds one part of the train blocks and reads the test blocks of a partition.
    part = blocks.select("ids", "labels", "vectors", "places", F.col("cells.cell").alias("cells")).coalesce(-(-size // PART_BYTES))
    pairs = packed.crossJoin(part.hint("shuffle_replicate_nl")).select(
        "block", "test_ids", "test_vectors", "ids", "labels", "vectors", "places", "cells")
    kind, test_kind = _kind(train)[1], _kind(test)[1]

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, nearest = None, None
        for batch in batches:
            for at, now in enumerate(batch.column(0).to_pylist()):
                if now != block:
                    if nearest is not None:
                        yield nearest.found()
                    ids = batch.column(1)[at].values
                    units = _units(batch.column(2)[at].as_py(), len(ids), test_kind)
                    reach = np.concatenate([_reached(units[some], centres, cells, sizes, radii, k) for some in _tiles(len(units), 8 * len(cells))])
                    block, nearest = now, _Nearest(ids, units, reach, k)
                ids, labels = batch.column(3)[at].values, batch.column(4)[at].values
                marked = pc.fill_null(labels.cast(pa.int64()), _NO_LABEL).to_numpy(zero_copy_only=False) + \
                    np.where(pc.is_null(ids).to_numpy(zero_copy_only=False), _NO_ID, 0)
                nearest.add(pc.fill_null(ids, np.iinfo(np.int64).max).to_numpy(zero_copy_only=False), marked,
                            _units(batch.column(5)[at].as_py(), len(ids), kind), np.frombuffer(batch.column(6)[at].as_py(), np.int32),
                            np.searchsorted(cells, batch.column(7)[at].values.to_numpy(zero_copy_only=False)))
        if nearest is not None:
            yield nearest.found()

    order = Window.partitionBy("test_id").orderBy(F.desc("similarity"), "train_id")
    return pairs.mapInArrow(best, _BEST_SCHEMA).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def cosine_knn(train: DataFrame, test: DataFrame, k: int = 3, pivots: int | None = None,
               block_rows: int = BLOCK_ROWS) -> DataFrame:
    """test_id, prediction by majority of the k nearest; the smaller label wins ties."""
    votes = neighbours(train, test, k, pivots, block_rows).groupBy("test_id", "label").agg(F.count("*").alias("n"))
    return votes.groupBy("test_id").agg(
        F.min_by("label", F.struct((-F.col("n")).alias("n"), "label")).alias("prediction"))
