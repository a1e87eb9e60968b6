import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerlake.llm import whitening as wh


def table(spark, rows):
    data = [(i, None if v is None else [None if x is None else float(x) for x in v], "x", 1) for i, v in rows]
    return spark.createDataFrame(data, "vec_id long, embedding array<double>, x string, n int").repartition(3)


def brute(rows):
    x = np.array([[math.floor(1024 * c) + 100_000 for c in v] for _, v in rows], object)
    n, sums = len(x), x.sum(axis=0)
    gap = x * n - sums
    cov = (gap.T @ gap / n**3).astype(float)
    e, v = np.linalg.eigh(cov)
    return n, (gap * gap).sum(axis=1).tolist(), e[::-1], v[:, ::-1], (gap / n).astype(float), cov


def run(spark, rows, tmp_path):
    table(spark, rows).write.parquet(f"{tmp_path}/embeddings.parquet")
    return wh.op13_whitening(spark, str(tmp_path)).collect()


@pytest.mark.parametrize("kind", ["spread", "narrow", "deficient"])
def test_equals_dense_eigenvectors(spark, tmp_path, kind):
    rng = np.random.default_rng(4)
    n, d = (700, 12) if kind != "deficient" else (5, 12)
    scale = np.geomspace(3, 0.05, d) if kind != "narrow" else np.geomspace(1e-1, 6e-3, d)
    x = rng.standard_normal((n, d)) * scale @ np.linalg.qr(rng.standard_normal((d, d)))[0] + 0.3
    rows = [(k, v) for k, v in enumerate(x)]
    got = run(spark, rows, tmp_path)
    n, deviation, e, v, y, cov = brute(rows)
    k = min(8, n - 1)
    assert len(got) == n * k
    for r in got:
        c = r["component"] - 1
        assert r["n"] == n and r["deviation"] == deviation[r["vec_id"]]
        assert abs(r["explained"] / (e[c] / np.trace(cov)) - 1) < 1e-9 and r["identity_error"] < 1e-10
        assert abs(abs(r["whitened"]) - abs(y[r["vec_id"]] @ v[:, c] / math.sqrt(e[c]))) < 1e-7
    for c in range(1, k + 1):  # one sign for all rows
        mine = np.array([r["whitened"] for r in sorted(got, key=lambda r: r["vec_id"]) if r["component"] == c])
        assert abs(abs(mine @ (y @ v[:, c - 1])) / (np.linalg.norm(mine) * np.linalg.norm(y @ v[:, c - 1])) - 1) < 1e-12


def test_factor_and_rotations():
    rng = np.random.default_rng(0)
    for d, rank in ((1, 1), (5, 5), (9, 3), (40, 40)):
        b = rng.standard_normal((d, rank)) * np.geomspace(1, 1e-5, rank)
        a = b @ b.T
        l, order = wh.pivoted_cholesky(a)
        assert l.shape[1] == rank and np.allclose(l @ l.T, a[np.ix_(order, order)], atol=1e-13 * np.trace(a))
        assert np.allclose(l, np.tril(l)) and (np.diff(np.diag(l)) <= 1e-12).all()
        c = wh.jacobi(l)
        g = c.T @ c
        assert np.abs(g / np.sqrt(np.outer(np.diag(g), np.diag(g))) - np.eye(rank)).max() < 1e-12
        assert np.allclose(np.sort(np.diag(g))[::-1], np.linalg.svd(b, compute_uv=False) ** 2, rtol=1e-6)
        pairs = [tuple(p) for i, j in wh._pairs(d) for p in zip(i.tolist(), j.tolist())]
        assert len(pairs) == len(set(pairs)) == d * (d - 1) // 2


def test_rows_that_take_no_part_and_those_that_repeat(spark, tmp_path):
    good = [(1, [0.5, 1.0]), (1, [0.5, 1.0]), (None, [2.0, -1.0]), (4, [0.0, 0.0]), (7, [1.0, 2.0])]
    bad = [(8, None), (9, [None, 1.0]), (10, [float("nan"), 1.0]), (11, [float("inf"), 0.0]), (12, [1.0]), (13, []), (14, [1e30, 1.0])]
    got = run(spark, good + bad, tmp_path)
    n, deviation, *_ = brute(good)
    assert len(got) == 10 and {r["n"] for r in got} == {5}
    assert sorted(r["deviation"] for r in got if r["component"] == 1) == sorted(deviation)
    assert sum(r["vec_id"] is None for r in got) == 2 and sum(r["vec_id"] == 1 for r in got) == 4


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])]])
def test_nothing_to_whiten(spark, tmp_path, rows):
    assert run(spark, rows, tmp_path) == []


def test_large_entries_are_exact(spark, tmp_path):
    rng = np.random.default_rng(1)
    rows = [(k, rng.integers(-(1 << 29), 1 << 29, 3).tolist()) for k in range(9)]
    got = wh.whiten(table(spark, rows)).collect()
    _, deviation, *_ = brute(rows)
    assert {r["vec_id"]: int(r["deviation_exact"]) for r in got} == dict(enumerate(deviation)) and all(r["deviation"] is None for r in got)


def test_batches_and_partitions_agree(spark):
    rows = table(spark, [(k, [math.sin(k * j) for j in range(1, 6)]) for k in range(300)])
    want = sorted(map(tuple, wh.whiten(rows).select("vec_id", "deviation", "whitened").collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 7)
    got = sorted(map(tuple, wh.whiten(rows.repartition(17, F.col("vec_id"))).select("vec_id", "deviation", "whitened").collect()))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 10_000)
    assert [g[:2] for g in got] == [w[:2] for w in want] and np.allclose([g[2] for g in got], [w[2] for w in want], rtol=0, atol=1e-12)
