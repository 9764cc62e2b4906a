"""Whitening against a dense eigensolver; nulls, repeats, ties, empty tables and vectors."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from wagebook.llm import whitening

SCHEMA = "vec_id long, embedding array<float>"


def frame(spark, vectors, ids=None):
    ids = list(range(len(vectors))) if ids is None else ids
    return spark.createDataFrame([(i, None if v is None else [None if c is None else float(c) for c in v]) for i, v in zip(ids, vectors)], SCHEMA).repartition(5)


def plain(vectors, most=16):
    """Rows by id of exact deviations and |whitened|, n, explained, worked out densely."""
    x = np.floor(64 * np.array(vectors, dtype=np.float32).astype(float)).astype(np.int64) + 1_000_000
    u = np.unique(x, axis=0)
    n, s = len(u), u.sum(0)
    c = (n * u - s) / n
    val, vec = np.linalg.eigh(c.T @ c / n)
    val, vec = val[::-1], vec[:, ::-1]
    k = min(most, int((val > 1e-18 * val[0]).sum()))
    return n, ((n * x - s) ** 2).sum(1), ((n * x - s) / n) @ vec[:, :k] / np.sqrt(val[:k]), val[:k] / val.sum()


@pytest.mark.parametrize("width,rows", [(24, 300), (3, 50), (20, 9)])
def test_as_dense(spark, width, rows):
    rng = np.random.default_rng(width)
    vectors = rng.standard_normal((rows, width)) * (3.0 ** -np.arange(width) * 40 + 1)
    vectors = np.concatenate([vectors, vectors[:5], np.repeat(vectors[:1], 40, 0)]).astype(np.float32)
    got = whitening.whiten(frame(spark, vectors)).toPandas()
    n, deviation, white, explained = plain(vectors)
    k = min(16, width, n - 1)
    assert len(got) == len(vectors) * k and set(got.n) == {n}
    wide = got.pivot(index="vec_id", columns="component", values="whitened").to_numpy()
    signs = np.sign((wide * white[:, :k]).sum(0))
    assert np.abs(wide * signs - white[:, :k]).max() < 1e-9
    one = got[got.component == 1].sort_values("vec_id")
    assert one.deviation.tolist() == deviation.tolist()
    assert np.allclose(got[got.vec_id == 0].sort_values("component").explained, explained[:k], rtol=1e-9)
    assert got.identity_error.nunique() == 1 and got.identity_error.iloc[0] < 1e-9


def test_values_that_occur_several_times(spark):
    """Corners of a cross-polytope: all values are equal, so the process must go on with new vectors."""
    vectors = [[0.0] * 5] + [[s if i == j else 0.0 for j in range(5)] for i in range(5) for s in (1.0, -1.0)]
    got = whitening.whiten(frame(spark, vectors)).toPandas()
    assert len(got) == 11 * 5 and got.identity_error.iloc[0] < 1e-12
    assert np.allclose(got.explained, 0.2)


def test_cases(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [[1, 2], [3, 1], None, [1, None], [nan, 1], [inf, 1], [-inf, 0], [1, 2], [5, -4]]
    rows = frame(spark, vectors, [0, 1, 2, 3, 4, 5, 6, None, 1]).withColumns({c: F.lit("clash") for c in ("x", "component", "n", "_v", "label")})
    got = whitening.whiten(rows).toPandas()
    assert sorted(got.vec_id.fillna(-1).tolist()) == [-1, -1, 0, 0, 1, 1, 1, 1] and set(got.n) == {3}
    assert whitening.whiten(frame(spark, [[1, 2], [1, 2]])).count() == 0
    assert whitening.whiten(frame(spark, [[], []])).count() == 0
    assert whitening.whiten(frame(spark, [None])).count() == 0
    assert whitening.whiten(rows.where("false")).columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert whitening.whiten(rows.where("false")).count() == 0
    short = whitening.whiten(frame(spark, [[1, 0], [2], [3, 0], [0, 5]])).toPandas()
    padded = whitening.whiten(frame(spark, [[1, 0], [2, 0], [3, 0], [0, 5]])).toPandas()
    assert short.sort_values(["vec_id", "component"]).deviation.tolist() == padded.sort_values(["vec_id", "component"]).deviation.tolist()


def test_exact_beyond_longs():
    w = whitening.Whitening(2, np.array([0]), [1], np.zeros((1, 0)), np.zeros(0), np.zeros(0), 0.0)
    assert whitening.deviations(np.array([[3], [10**9], [2**40]]), w) == [25, (2 * 10**9 - 1) ** 2, None]


def test_string_ids(spark):
    rows = spark.createDataFrame([("a", [1.0, 0.0]), ("b", [0.0, 2.0]), ("b", [4.0, 4.0])], "vec_id string, embedding array<double>")
    assert sorted(r.vec_id for r in whitening.whiten(rows).collect()) == ["a", "a", "b", "b", "b", "b"]
