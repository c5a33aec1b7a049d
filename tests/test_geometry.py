"""Geometry and time-axis functions against numpy."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.functions import geometry as g, timeseries as ts
from kinelake.operators import alignment, quality
from kinelake.functions.timeseries import Axis


def rotations(n=40, seed=0):
    q = np.random.default_rng(seed).normal(size=(n, 4))
    q /= np.linalg.norm(q, axis=1)[:, None]
    w, x, y, z = q.T
    return q, np.stack([1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y), 2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x), 2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)], axis=1)


def column(spark, values, expression, kind="array<double>"):
    df = spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(values)], "i long, v array<double>")
    return np.array([r[1] for r in df.select("i", expression.alias("o")).orderBy("i").collect()], dtype=object if kind != "array<double>" else float)


def test_quaternions_and_matrices(spark):
    q, r = rotations()
    assert np.allclose(column(spark, q, g.wxyz_to_matrix(F.col("v"))), r)
    assert np.allclose(column(spark, q[:, [1, 2, 3, 0]], g.xyzw_to_matrix(F.col("v"))), r)
    back = column(spark, r, g.matrix_to_wxyz(F.col("v")))
    assert np.allclose(np.abs((back * q).sum(1)), 1)
    assert np.allclose(column(spark, [[0, 0, 0, 0]], g.wxyz_to_matrix(F.col("v"))), np.eye(3).ravel())


def test_euler_round_trip_and_lock(spark):
    _, r = rotations(seed=1)
    lock = np.array([[0, 0, 1, 0, 1, 0, -1, 0, 0], [0, 0, -1, 0, 1, 0, 1, 0, 0]], float)
    r = np.vstack([r, lock])
    assert np.allclose(column(spark, r, g.euler_to_matrix(g.matrix_to_euler(F.col("v")))), r, atol=1e-6)


def test_rot6d(spark):
    _, r = rotations(seed=2)
    six = column(spark, r, g.matrix_to_rot6d(F.col("v")))
    assert np.allclose(column(spark, six, g.rot6d_to_matrix(F.col("v"))), r, atol=1e-6)
    m = column(spark, six * 3 + np.array([0, 0, 0, 0.2, 0.1, 0]), g.rot6d_to_matrix_gs(F.col("v"))).reshape(-1, 3, 3)
    assert np.allclose(m @ m.transpose(0, 2, 1), np.eye(3), atol=1e-9) and np.allclose(np.linalg.det(m), 1)


def test_rigid_inverse_and_compose(spark):
    _, r = rotations(seed=3)
    t = np.random.default_rng(3).normal(size=(len(r), 3))
    p = np.zeros((len(r), 4, 4))
    p[:, :3, :3], p[:, :3, 3], p[:, 3, 3] = r.reshape(-1, 3, 3), t, 1
    inv = column(spark, p.reshape(-1, 16), g.rigid_inverse(F.col("v")))
    assert np.allclose(inv.reshape(-1, 4, 4), np.linalg.inv(p))
    assert np.allclose(column(spark, p.reshape(-1, 16), g.compose(F.col("v"), g.rigid_inverse(F.col("v")))), np.eye(4).ravel(), atol=1e-9)


def test_retarget_mirrors(spark):
    x = np.random.default_rng(4).normal(size=(30, 12))
    right = g.retarget(*[g.items(F.col("v"), 3, s) for s in (0, 3, 6, 9)], 1)
    left = g.retarget(*[g.items(F.col("v"), 3, s) for s in (0, 3, 6, 9)], -1)
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "i long, v array<double>")
    a = df.select("i", F.inline(F.array(right))).orderBy("i").collect()
    b = df.select("i", F.inline(F.array(left))).orderBy("i").collect()
    for v, p, q in zip(x, a, b):
        r, s = np.array(p["rotation"]).reshape(3, 3), np.array(q["rotation"]).reshape(3, 3)
        assert np.allclose(r @ r.T, np.eye(3), atol=1e-9) and np.isclose(np.linalg.det(r), 1) and np.allclose(r[:, 2], -s[:, 2])
        finger = 0.7 * v[3:6] + 0.3 * v[6:9]
        assert np.isclose(p["width"], np.linalg.norm(v[:3] - finger)) and np.allclose(p["position"], (v[:3] + finger) / 2)
    flat = df.limit(1).withColumn("v", F.array_repeat(F.lit(0.5), 12)).select(F.inline(F.array(right))).first()
    assert not flat["valid"]


def test_repair_and_projection(spark):
    _, r = rotations(5, 5)
    noisy = r + 0.01
    m = column(spark, noisy, g.repair_rotation(F.col("v"))).reshape(-1, 3, 3)
    assert np.allclose(m @ m.transpose(0, 2, 1), np.eye(3), atol=1e-9) and np.allclose(np.linalg.det(m), 1)
    uv = column(spark, [[1, 2, 4], [0, 0, -1]], g.project(g.items(F.col("v"), 3), 100, 100, 50, 60), "object")
    assert uv[0] == [75.0, 110.0] and uv[1] is None


def test_stage5_identity(spark):
    v = np.random.default_rng(6).uniform(-1, 1, (10, 14))
    one = F.array(*[F.lit(float(i in (0, 5, 10, 15))) for i in range(16)])
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "t long, state array<double>")
    got = np.array([r["aligned"] for r in quality.stage5_align(df, one, [0.0, 0.0, 0.0]).orderBy("t").collect()])
    assert np.allclose(got, v, atol=1e-9)


def test_confidence(spark):
    c = [[0.9, 0.8, 0.7, 0.6, 0.5, 0.9, 0.9, 0.9], [2, 2, 2, 2, 2, 2, 2, 2], [0.5, float("nan"), 0.4, 0.9, 1, 1, 1, 1], [0.3, 0.2]]
    assert np.allclose(column(spark, c, g.hand_confidence(F.col("v"))), [0.45, 1, 0.2, 0.2])


AXIS = Axis(("e",), ("f",))


def series(spark, lengths, seed=0):
    rng = np.random.default_rng(seed)
    data = {e: rng.normal(size=n) for e, n in enumerate(lengths)}
    return data, spark.createDataFrame([(e, f, float(x)) for e, v in data.items() for f, x in enumerate(v)], "e long, f long, x double")


def result(df, out="o"):
    got = {}
    for r in df.select("e", "f", out).orderBy("e", "f").collect():
        got.setdefault(r["e"], []).append(r[out])
    return got


def padded(x, k):
    return np.pad(x, k, mode="edge")


@pytest.mark.parametrize("lengths", [(1, 2, 3, 5, 10, 11, 12, 40)])
def test_filters(spark, lengths):
    data, df = series(spark, lengths)
    med = result(ts.median_filter(df, AXIS, "x", "o"))
    sg = result(ts.savgol(df, AXIS, "x", "o"))
    for e, x in data.items():
        n = len(x)
        assert np.allclose(med[e], [np.median(padded(x, 2)[i : i + 5]) for i in range(n)])
        want = np.convolve(padded(x, 5), ts.savgol_taps()[::-1], "valid") if n >= 11 else x
        assert np.allclose(sg[e], want)
    ma = result(ts.moving_average(df, AXIS, "x", "o"))
    small = result(ts.savgol_shrinking(df, AXIS, "x", "o"))
    for e, x in data.items():
        n = len(x)
        w = ts.odd_window(11, n)
        assert np.allclose(ma[e], x if n <= 2 or w <= 1 else np.convolve(padded(x, w // 2), np.ones(w) / w, "valid"))
        assert np.allclose(small[e], x if n <= 3 or w <= 3 else np.convolve(padded(x, w // 2), ts.savgol_taps(w, 2)[::-1], "valid"))


def test_savgol_keeps_cubics(spark):
    x = np.arange(40.0)
    y = 0.01 * x**3 - x
    df = spark.createDataFrame([(0, i, float(v)) for i, v in enumerate(y)], "e long, f long, x double")
    assert np.allclose(result(ts.savgol(df, AXIS, "x", "o"))[0][5:-5], y[5:-5])


def test_differences(spark):
    data, df = series(spark, (1, 2, 3, 4, 20))
    grad = result(ts.gradient(df, AXIS, "x", "o"))
    for order in (2, 3):
        d = result(ts.padded_difference(df, AXIS, "x", "o", order))
        for e, x in data.items():
            want = np.zeros(len(x))
            if len(x) > order:
                v = np.abs(np.diff(x, order))
                want = np.pad(v, (order // 2, len(x) - len(v) - order // 2), mode="edge")
            assert np.allclose(d[e], want), (order, e)
    for e, x in data.items():
        if len(x) > 1:
            assert np.allclose(grad[e], np.gradient(x))


def test_lag_of_a_shifted_copy(spark):
    x = np.cumsum(np.random.default_rng(2).normal(size=120))
    for k in (-3, 0, 4):
        s = np.roll(x, k)[10:-10]
        df = spark.createDataFrame([(0, i, float(a), float(b)) for i, (a, b) in enumerate(zip(s, x[10:-10]))], "e long, f long, s double, a double")
        d = alignment.differences(df, AXIS, "s", "a", smooth=False)
        lag = alignment.best_lag(d, AXIS)
        assert lag.first()["lag"] == k
        assert alignment.directional_agreement(d, lag, AXIS).first()["score"] == 1.0
        assert quality.alignment_scores(s, x[10:-10], 5, 1e-4, 10) == (1.0, k)
