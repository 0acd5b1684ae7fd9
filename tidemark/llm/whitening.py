"""Whitening of embeddings by products of distributed block matrices.

Every vector's entries c become whole numbers x = floor(64 c) + 1000000. Each distinct x vector once is the fit list. Its
centred rows, and those of all vectors, are packed into blocks of rows and made ``BlockMatrix`` objects F and R of
``pyspark.mllib``. FᵀF is the scatter; its eigenvectors over the roots of their eigenvalues are W, found on the driver
from one matrix of dimension by dimension; R W are the whitened rows. (F W)ᵀ(F W) / n must be the identity.

Centring and deviations are exact: n x - S is a whole number. Blocks are multiplied where a grid or the split middle
dimension of ``BlockMatrix.multiply`` puts them; a task holds a bounded number of blocks, and the driver sees one pair of
numbers per block. Rows keep their place in a block, so results meet their ids by block number, not by value: a vector
that a third of all rows repeat is no hot key.

Nulls and edge cases: a null vector, and one with a null, NaN or infinite entry, is dropped; so is one whose length is not
the most frequent one (the larger of equally frequent ones), empty ones included; a null id stays; repeated rows are rows
of their own; an empty table gives an empty result. Without any spread (a single distinct vector, or fewer than the
dimension needs) a component without variance has ``whitened`` 0 and ``explained`` 0 and does not count in the error. An
entry beyond 64-bit numbers, or a deviation beyond them, is an error. Other columns are not read, so names may clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.mllib.linalg import DenseMatrix
from pyspark.mllib.linalg.distributed import BlockMatrix
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.bounds import stored

COMPONENTS = 16
SCALE, SHIFT = 64, 1_000_000
#: Rows of a block, and blocks that a task of a product holds.
BLOCK_ROWS, TASK_BLOCKS = 1024, 128
#: Eigenvalues at most this share of the largest are no variance.
FLAT = 1e-12

_BLOCKS = "_task bigint, _block bigint, rows int, ids array<bigint>, deviations array<bigint>, cells binary"


def whole_vectors(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x): whole-number entries of all vectors without null or non-finite entries, of the most frequent length."""
    entries = F.col("embedding")
    usable = entries.isNotNull() & F.forall(entries, lambda c: F.coalesce(F.abs(c.cast("double")) < float("inf"), F.lit(False)))
    x = F.transform(entries, lambda c: F.floor(F.lit(float(SCALE)) * c.cast("double")) + F.lit(SHIFT))
    rows = stored(embeddings.where(usable).select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("x")), "whitening_rows")
    lengths = rows.where(F.size("x") > 0).groupBy(F.size("x").alias("d")).agg(F.count(F.lit(1)).alias("n"))
    best = lengths.agg(F.max(F.struct("n", "d")).getField("d")).first()[0]
    return rows.where(F.size("x") == F.lit(best))


def totals(fit: DataFrame, d: int) -> tuple[int, list[int]]:
    """Rows of the fit list and the sums of every dimension, exact; tasks add up their rows first."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, [0] * d
        for batch in batches:
            x = _matrix(batch, d)
            n += len(x)
            total = [a + b for a, b in zip(total, x.sum(axis=0).tolist())]
        yield pa.RecordBatch.from_pydict({"at": pa.array(range(d + 1), pa.int32()), "total": pa.array([*total, n], pa.int64())})

    sums = fit.mapInArrow(add, "at int, total bigint").groupBy("at").agg(F.sum("total").alias("total")).collect()
    by_place = {r["at"]: r["total"] for r in sums}
    return by_place[d], [by_place[j] for j in range(d)]


def _matrix(batch: pa.RecordBatch, d: int) -> np.ndarray:
    return batch.column("x").flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(-1, d)


def _pack(n: int, sums: list[int], block_rows: int):
    """Tasks pack centred rows into blocks of ``block_rows``; the last one of a task has fewer, and zeros after them."""
    d = len(sums)
    total = np.array(sums, np.int64)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        task, block = TaskContext.get().partitionId(), 0
        held, ids, size = [], [], 0

        def emit(x: np.ndarray, own: list) -> pa.RecordBatch:
            off = n * x - total
            largest = float(np.abs(off.astype(np.float64)).max(initial=0.0))
            if d * largest * largest >= 2.0**63:
                raise OverflowError("a deviation does not fit in 64 bits")
            cells = np.zeros((block_rows, d))
            cells[: len(x)] = off / n
            return pa.RecordBatch.from_pydict({
                "_task": pa.array([task], pa.int64()), "_block": pa.array([block], pa.int64()), "rows": pa.array([len(x)], pa.int32()),
                "ids": pa.array([own], pa.list_(pa.int64())),
                "deviations": pa.array([(off * off).sum(axis=1).tolist()], pa.list_(pa.int64())),
                # Column by column, as a dense matrix has them.
                "cells": pa.array([cells.tobytes(order="F")], pa.binary()),
            })

        for batch in batches:
            held.append(_matrix(batch, d))
            ids += batch.column("vec_id").to_pylist()
            size += batch.num_rows
            if size >= block_rows:
                x = np.concatenate(held)
                whole = size // block_rows * block_rows
                for i in range(0, whole, block_rows):
                    yield emit(x[i : i + block_rows], ids[i : i + block_rows])
                    block += 1
                held, ids, size = [x[whole:]], ids[whole:], size - whole
        if size:
            yield emit(np.concatenate(held), ids)

    return pack


def centred_blocks(rows: DataFrame, n: int, sums: list[int], name: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Stored blocks of centred rows, numbered: (index, rows, ids, deviations, cells).

    A block is named by its task and its number there; blocks are written once, so the names hold from then on.
    """
    blocks = stored(rows.select("vec_id", "x").mapInArrow(_pack(n, sums, block_rows), _BLOCKS), name)
    # Room for the fullest task: numbers need not follow each other, missing blocks are zeros.
    room = blocks.agg(F.coalesce(F.max("_block"), F.lit(0))).first()[0] + 1
    return blocks.select((F.col("_task") * room + F.col("_block")).alias("index"), "rows", "ids", "deviations", "cells")


def block_matrix(blocks: DataFrame, d: int, block_rows: int = BLOCK_ROWS) -> tuple[BlockMatrix, int]:
    """The matrix of all blocks below each other, and their number."""
    count, last = blocks.agg(F.count(F.lit(1)), F.coalesce(F.max("index"), F.lit(0))).first()

    def dense(row):
        return (row["index"], 0), DenseMatrix(block_rows, d, np.frombuffer(row["cells"]))

    # MLlib lays products out on a grid of as many rows as the root of the number of partitions.
    least = blocks.sparkSession.sparkContext.defaultParallelism
    parts = min(count, max(least, -(-count // TASK_BLOCKS)) ** 2)
    rdd = blocks.select("index", "cells").repartition(max(1, parts), "index").rdd.map(dense)
    return BlockMatrix(rdd, block_rows, d, (last + 1) * block_rows, d), count


def _product(left: BlockMatrix, right: BlockMatrix, splits: int = 1) -> BlockMatrix:
    """``left.multiply(right)`` with the middle dimension dealt out; the Python method has no parameter for it."""
    product = left._java_matrix_wrapper.call("multiply", right._java_matrix_wrapper._java_model, splits)
    return BlockMatrix(product, left.rowsPerBlock, right.colsPerBlock)


def gram(m: BlockMatrix, count: int) -> np.ndarray:
    """mᵀm; every task multiplies at most ``TASK_BLOCKS`` blocks, only sums of columns by columns are moved on."""
    return _product(m.transpose(), m, max(1, -(-count // TASK_BLOCKS))).toLocalMatrix().toArray()


def local_matrix(spark: SparkSession, values: np.ndarray) -> BlockMatrix:
    """A small matrix as a single block."""
    rdd: RDD = spark.sparkContext.parallelize([((0, 0), DenseMatrix(*values.shape, values.flatten(order="F")))], 1)
    return BlockMatrix(rdd, *values.shape, *values.shape)


def components(scatter: np.ndarray, n: int, count: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(eigenvalues, whitening matrix, explained shares) of the first components; the largest entry of a vector is positive."""
    covariance = (scatter + scatter.T) / (2 * n)
    values, vectors = np.linalg.eigh(covariance)
    values, vectors = values[::-1][:count], vectors[:, ::-1][:, :count]
    sign = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    real = values > FLAT * max(values[0], 0.0)
    values = np.where(real, values, 0.0)
    weights = np.where(real, vectors * sign / np.sqrt(np.where(real, values, 1.0)), 0.0)
    trace = float(np.trace(covariance))
    return values, weights, values / trace if trace > 0 else np.zeros(len(values))


def _unpack(n: int, explained: list[float], error: float, block_rows: int):
    k = len(explained)

    def unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                rows = batch.column("rows")[at].as_py()
                cells = np.frombuffer(batch.column("cells")[at].as_buffer()).reshape(k, block_rows).T[:rows]
                ids = batch.column("ids")[at].values
                spread = np.repeat(np.arange(rows), k)
                yield pa.RecordBatch.from_pydict({
                    "vec_id": ids.take(pa.array(spread)),
                    "component": pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)),
                    "n": pa.array(np.full(rows * k, n, np.int64)),
                    "deviation": batch.column("deviations")[at].values.take(pa.array(spread)),
                    "whitened": pa.array(np.ascontiguousarray(cells).reshape(-1)),
                    "explained": pa.array(np.tile(np.array(explained), rows)),
                    "identity_error": pa.array(np.full(rows * k, error)),
                })

    return unpack


WHITENED = "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"


def whiten(embeddings: DataFrame, n_components: int = COMPONENTS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """One row per vector and component, up to ``n_components``."""
    spark = embeddings.sparkSession
    rows = whole_vectors(embeddings)
    first = rows.select(F.size("x")).first()
    if first is None:
        return spark.createDataFrame([], WHITENED)
    d = first[0]
    fit = stored(rows.select("x").distinct().select(F.lit(None).cast("bigint").alias("vec_id"), "x"), "whitening_fit")
    n, sums = totals(fit, d)

    fitted, fit_blocks = block_matrix(centred_blocks(fit, n, sums, "whitening_fit_blocks", block_rows), d, block_rows)
    values, weights, explained = components(gram(fitted, fit_blocks), n, n_components)
    w = local_matrix(spark, weights)
    off = gram(_product(fitted, w), fit_blocks) / n - np.diag((values > 0).astype(float))

    blocks = centred_blocks(rows, n, sums, "whitening_blocks", block_rows)
    projected = _product(block_matrix(blocks, d, block_rows)[0], w).blocks
    cells = projected.map(lambda b: (b[0][0], bytearray(b[1].toArray().tobytes(order="F"))))
    white = spark.createDataFrame(cells, "index bigint, cells binary")
    joined = blocks.drop("cells").join(white, "index").select("rows", "ids", "deviations", "cells")
    return joined.mapInArrow(_unpack(n, explained.tolist(), float(np.abs(off).max()), block_rows), WHITENED)
