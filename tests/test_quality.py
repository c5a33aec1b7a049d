import numpy as np
from pyspark.sql import functions as F

from kinelake.operators import quality as q
from kinelake.plans import frame_queries

from helpers import frames_table, frame, walk


def long_runs(flags, x, least, jump):
    """The reference's long-run test, written anew: the first long run with a jump, per channel."""
    out = []
    for d in range(flags.shape[1]):
        edges = np.flatnonzero(np.diff(np.concatenate([[0], flags[:, d].astype(int), [0]])))
        for a, b in zip(edges[::2], edges[1::2]):
            if b - a >= least and b - a > 1 and np.abs(np.diff(x[a:b, d])).max() >= jump:
                out.append(f"sudden_change_cluster_dim{d}_len{b - a}")
                break
    return out


def test_long_runs_of_flags_are_reasons(spark):
    rng = np.random.default_rng(5)
    rows = []
    for e in range(3):
        x, a = walk(160, e), walk(160, e + 9)
        if e < 2:
            x[20 : 60 + 40 * e], a[70:130] = x[20 : 60 + 40 * e] + rng.normal(0, 0.1, (40 + 40 * e, 20)), a[70:130] + rng.normal(0, 0.1, (60, 20))
        rows += [frame(e, t, x[t], a[t]) for t in range(160)]
    # Low thresholds, so that shaken stretches are flagged in whole runs.
    config = q.QualityConfig(k_residual=0.0, k_accel=0.0, k_jerk=0.0, percentile_floor=30.0, episode_cluster=6)
    masks = q.keep_masks(frames_table(spark, rows), config)
    got = {r["episode"]: r["discard_reasons"] for r in q.episode_results(masks, config).collect()}
    seen = {e: [] for e in range(3)}
    for r in masks.orderBy("episode", "t").collect():
        seen[r["episode"]].append((r["s1_flags"], r["state"] + r["action"]))
    want = {e: long_runs(np.array([f for f, _ in v]), np.array([x for _, x in v]), 6, config.cluster_jump) for e, v in seen.items()}
    assert {e: [r for r in v if "cluster" in r] for e, v in got.items()} == want
    assert len(want[0]) > len(want[2]) and want[1]
    for v in got.values():
        names = [r.split("=")[0] for r in v]
        assert names == sorted(names, key=lambda r: (not r.startswith("hard"), not r.startswith("sudden"), not r.startswith("stage")))


def euler(v):
    """Extrinsic xyz angles to a matrix."""
    (a, b, c), (x, y, z) = np.cos(v), np.sin(v)
    return np.array([[c, -z, 0], [z, c, 0], [0, 0, 1]]) @ np.array([[b, 0, y], [0, 1, 0], [-y, 0, b]]) @ np.array([[1, 0, 0], [0, a, -x], [0, x, a]])


def test_stage5_with_a_rotated_pose(spark):
    rng = np.random.default_rng(8)
    state, action = rng.uniform(-1, 1, (20, 14)), rng.uniform(-1, 1, (20, 14))
    rot, move, turn = euler([0.4, -0.7, 1.9]), np.array([0.3, -0.2, 0.9]), [0.0, -np.pi / 2, 0.0]
    pose = np.eye(4)
    pose[:3, :3], pose[:3, 3] = rot, move
    df = spark.createDataFrame([(0, t, state[t].tolist(), action[t].tolist()) for t in range(20)], "episode long, t long, state array<double>, action array<double>")
    rows = q.stage5_align(df, F.array(*[F.lit(float(v)) for v in pose.ravel()]), turn).orderBy("t").collect()
    c = euler(turn)
    for name, given in (("aligned", state), ("aligned_action", action)):
        for r, x in zip(rows, given):
            for h in (0, 7):
                out = np.array(r[name][h : h + 7])
                assert np.allclose(out[:3], c @ (rot @ x[h : h + 3] + move)) and out[6] == x[h + 6]
                assert np.allclose(euler(out[3:6]), c @ rot @ euler(x[h + 3 : h + 6]), atol=1e-7)
    assert np.allclose(rows[0]["reference_forward"], c @ rot[:, 0])


def test_stage5_query_has_all_numbers(spark, sf):
    cells = frame_queries.stage5_aligned(spark, sf)
    assert sorted(r["i"] for r in cells.select("i").distinct().collect()) == list(range(31))
