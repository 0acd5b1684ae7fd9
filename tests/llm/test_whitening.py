"""Whitening against a dense eigendecomposition."""

import numpy as np
import pytest

from tidemark.llm import whitening as wh

ROW = "vec_id bigint, embedding array<float>, n int, index string, x string"


def brute(vectors, k=16):
    x = (np.floor(64 * np.array(vectors, float)) + 1_000_000).astype(np.int64)
    fit = np.unique(x, axis=0)
    n, total = len(fit), fit.sum(axis=0)
    centred = (n * fit - total) / n
    values, axes = np.linalg.eigh(centred.T @ centred / n)
    values, axes = values[::-1][:k], axes[:, ::-1][:, :k]
    white = ((n * x - total) / n) @ (axes / np.sqrt(values))
    return n, ((n * x - total) ** 2).sum(axis=1), white, values / ((centred**2).sum() / n)


def check(rows, ids, vectors, k=16):
    n, deviation, white, explained = brute(vectors, k)
    got = {}
    for r in rows:
        got.setdefault(r.vec_id, {})[r.component] = r
    assert len(rows) == len(ids) * white.shape[1]
    sign = np.sign([sum(got[i][c + 1].whitened * white[at, c] for at, i in enumerate(ids)) for c in range(white.shape[1])])
    for at, i in enumerate(ids):
        for c in range(white.shape[1]):
            r = got[i][c + 1]
            assert (r.n, r.deviation) == (n, deviation[at])
            assert r.whitened * sign[c] == pytest.approx(white[at, c], abs=1e-8)
            assert r.explained == pytest.approx(explained[c], rel=1e-8) and r.identity_error < 1e-6


@pytest.mark.parametrize("block_rows", [1024, 7])
def test_whiten(spark, block_rows):
    rng = np.random.default_rng(4)
    vectors = (rng.normal(size=(120, 20)) * np.linspace(3, 1, 20)).astype(np.float32).tolist()
    # Copies of one vector are most of the rows.
    vectors += [vectors[5]] * 200
    ids = list(range(len(vectors)))
    odd = [(1000, None), (1001, [None] * 20), (1002, [float("nan")] + [0.0] * 19), (1003, [float("-inf")] * 20), (1004, []), (1005, [1.0, 2.0])]
    rows = [(i, v, 1, "a", None) for i, v in [*zip(ids, vectors), *odd]]
    table = spark.createDataFrame(rows, ROW).repartition(5)
    check(wh.whiten(table, block_rows=block_rows).collect(), ids, vectors)
    check(wh.whiten(table, 3, block_rows=block_rows).collect(), ids, vectors, 3)


def test_edges(spark):
    empty = spark.createDataFrame([], ROW)
    assert wh.whiten(empty).collect() == []
    assert wh.whiten(spark.createDataFrame([(1, None, 1, "a", "b"), (2, [], 1, "a", "b")], ROW)).collect() == []
    same = wh.whiten(spark.createDataFrame([(None, [1.0, 2.0], 1, "a", "b")] * 3, ROW)).collect()
    assert len(same) == 6 and all((r.vec_id, r.n, r.deviation, r.whitened, r.explained, r.identity_error) == (None, 1, 0, 0, 0, 0) for r in same)
    line = wh.whiten(spark.createDataFrame([(i, [float(i), 2.0 * i], 1, "a", "b") for i in range(9)], ROW)).collect()
    assert all(r.whitened == 0 and r.explained == 0 for r in line if r.component == 2)
    assert all(abs(r.explained - 1) < 1e-9 and r.identity_error < 1e-9 for r in line if r.component == 1)


def test_query(spark, medium):
    import __spark_entry__ as entry_point

    rows = spark.read.parquet(f"{medium}/embeddings.parquet").orderBy("vec_id").collect()
    out = entry_point.queries()["op13_block_whitening"](spark, medium)
    assert out.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    check(out.collect(), [r.vec_id for r in rows], [r.embedding for r in rows])
