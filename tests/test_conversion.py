"""Conversion steps against numpy, dataset sinks as round trips, analysis of small cases."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from kinelake.functions import dense, geometry as g
from kinelake.functions.timeseries import Axis
from kinelake.operators import conversion as c, episode_filter, export, pipeline, quality
from kinelake.sources import raw, tables

from helpers import frame, frames_table, walk

AXIS = Axis(("episode",), ("frame_index",))


def quaternions(n, seed=0):
    rng = np.random.default_rng(seed)
    q = np.cumsum(rng.normal(0, 0.2, (n, 4)), axis=0) + [1, 0, 0, 0]
    q /= np.linalg.norm(q, axis=1, keepdims=True)
    return q * np.where(rng.random(n) < 0.4, -1, 1)[:, None]


def gaussian(q, sigma):
    r = max(1, round(3 * sigma))
    out = []
    for t in range(len(q)):
        near = q[max(0, t - r) : t + r + 1].copy()
        near[near @ q[t] < 0] *= -1
        w = np.exp(-0.5 * ((np.arange(max(0, t - r), min(len(q), t + r + 1)) - t) / sigma) ** 2)
        m = (near * w[:, None]).sum(0)
        out.append(m / np.linalg.norm(m))
    return np.array(out)


@pytest.mark.parametrize("sigma", [0.0, 0.3, 2.0])
def test_quaternion_smoothing(spark, sigma):
    q = quaternions(30)
    df = spark.createDataFrame([(1, t, q[t].tolist()) for t in range(30)] + [(2, 0, q[0].tolist())], "episode long, frame_index long, q array<double>")
    got = np.array([r["s"] for r in c.smooth_quaternions(df, AXIS, "q", "s", sigma).where("episode = 1").orderBy("frame_index").collect()])
    assert np.allclose(got, gaussian(q, sigma) if sigma else q, atol=1e-12)


def test_slam_pose_and_relative_camera(spark):
    q, t = quaternions(5), np.random.default_rng(1).normal(size=(5, 3))
    mount = np.array([[0, -1, 0, 0.1], [1, 0, 0, 0.2], [0, 0, 1, 0.3], [0, 0, 0, 1.0]])

    def pose(q, t):
        w, x, y, z = q
        m = np.eye(4)
        m[:3, :3] = [[1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y)], [2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x)], [2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]]
        m[:3, 3] = t
        return m

    df = spark.createDataFrame([(i, q[i].tolist(), t[i].tolist()) for i in range(5)], "i long, q array<double>, t array<double>")
    mounted = F.array(*[F.lit(float(v)) for v in mount.ravel()])
    rows = df.withColumn("c", c.slam_pose(F.col("q"), F.col("t"), mounted)).withColumn("rel", c.to_current_camera(mounted, F.col("c"))).orderBy("i").collect()
    for i, r in enumerate(rows):
        want = np.linalg.inv(mount @ pose(q[i], t[i]))
        assert np.allclose(np.array(r["c"]).reshape(4, 4), want, atol=1e-12)
        assert np.allclose(np.array(r["rel"]).reshape(4, 4), np.linalg.inv(want) @ mount, atol=1e-12)


def test_confidence_and_fill(spark):
    df = spark.createDataFrame([([0.5, None, 0.7],), (None,), ([],)], "c array<float>")
    got = [r[0] for r in df.select(c.confidence_stack(F.col("c"))).collect()]
    assert np.allclose(got[0], [0.5, 0, 0.7, 0, 0, 0, 0, 0]) and got[1] == got[2] == [0.0] * 8
    rows = [(1, 0, [float("nan"), 1.0, 2.0]), (1, 1, [1.0, 1.0, 1.0]), (1, 2, [float("inf")] * 3), (2, 0, [float("nan"), 5.0, float("inf")])]
    df = spark.createDataFrame(rows, "episode long, frame_index long, x array<double>")
    got = {(r["episode"], r["frame_index"]): r["f"] for r in c.fill_invalid(df, AXIS, "x", g.keypoints_valid(F.col("x")), "f").collect()}
    assert got == {(1, 0): [1, 1, 1], (1, 1): [1, 1, 1], (1, 2): [1, 1, 1], (2, 0): [0, 5, 0]}


def test_step1_of_bad_episodes(spark):
    rng = np.random.default_rng(0)
    hand, pose = lambda: rng.uniform(0.1, 0.5, 63).tolist(), [0.1, 0.2, 0.3, 1.0, 0.0, 0.0, 0.0]
    same = [0.25] * 63  # all joints in one place: no gripper
    rows = [(1, t, hand(), hand(), pose) for t in range(14)] + [(2, 0, hand(), same, pose), (2, 1, None, hand(), None), (3, 0, hand(), hand(), [0.0] * 7), (4, 0, hand(), hand()[:60], pose)]
    df = spark.createDataFrame(rows, "episode long, frame_index long, left_keypoints array<double>, right_keypoints array<double>, p array<double>")
    step = c.gripper_frames(df).collect()
    assert len(step) == len(rows)
    good = [r for r in step if r["episode"] == 1]
    assert all(r["keep"] and len(r["action"]) == 20 and np.isfinite(r["action"]).all() for r in good) and not any(r["keep"] for r in step if r["episode"] != 1)
    assert not np.allclose([r["action"] for r in good], [r["action_raw"] for r in good])
    gone = {r["episode"]: r for r in c.rejected_episodes(c.gripper_frames(df, smooth=False)).collect()}
    assert set(gone) == {2, 3, 4} and gone[2]["combined"] == 2 and gone[2]["right_gripper"] == 1 + 0 and gone[3]["camera_pose"] == 1 and gone[4]["right_keypoints"] == 1
    m = c.manifest(c.gripper_frames(df, smooth=False)).first()
    assert (m["episodes"], m["frames"], m["combined"], m["skipped"]) == (4, 18, 14, 3)


def test_streams(spark):
    a = spark.createDataFrame([(1, 0), (1, 5), (1, 9), (2, 0)], "episode long, frame_index long")
    b = spark.createDataFrame([(1, 1), (1, 2), (2, 7)], "episode long, frame_index long")
    assert sorted(tuple(r) for r in c.aligned_streams(a, b).select("episode", "position", "frame_index", "right_frame").collect()) == [(1, 0, 0, 1), (1, 1, 5, 2), (2, 0, 0, 7)]
    assert [r["episode"] for r in c.aligned_streams(a, b, strict=True).collect()] == [2]
    left, right = spark.createDataFrame([("b",), ("a",)], "x string"), spark.createDataFrame([(2,), (1,)], "y long")
    assert sorted(tuple(r) for r in raw.positional_join(left, right, "x", "y").collect()) == [("a", 1), ("b", 2)]


def test_sinks(spark, tmp_path):
    stats = spark.createDataFrame([(k, 0.1 * k, 1.0) for k in range(28)], "channel int, q01 double, q99 double")
    path = str(tmp_path / "stats")
    assert export.load_stats(spark, path, 28, ["q01"]) is None
    export.save_stats(stats, path)
    assert export.load_stats(spark, path, 28, ["q01", "q99"]).count() == 28
    assert export.load_stats(spark, path, 20, ["q01"]) is None and export.load_stats(spark, path, 28, ["q50"]) is None
    export.write_csv(stats, str(tmp_path / "csv"))
    assert spark.read.csv(str(tmp_path / "csv"), header=True).columns == stats.columns
    x = walk(40, 1)
    frames = frames_table(spark, [frame(e, t, x[t], x[t]) for e in (1, 2) for t in range(40)])
    results = quality.episode_results(quality.keep_masks(frames))
    export.write_report(quality.quality_report(results), results, str(tmp_path / "reports"))
    assert spark.read.json(str(tmp_path / "reports/quality_report")).first()["episodes"] == 2 and spark.read.json(str(tmp_path / "reports/exclusion_log")).count() == 2
    aligned = quality.stage5_align(quality.episode_frames(frames), F.array(*[F.lit(float(v)) for v in np.eye(4).ravel()]), [0.0, 0.0, 0.0])
    poses = export.aligned_poses(aligned, "camera_top_frame0", [0.0, 0.0, 0.0])
    assert poses.schema["state"].dataType.simpleString() == "array<float>" and poses.count() == 80
    replaced = export.action_from_state(frames).first()
    assert replaced["action"] == replaced["observation.state"]


def test_running_start_and_verification(spark):
    n = spark.createDataFrame([(k, k % 7) for k in range(300)], "e long, n long")
    got = {r["e"]: r["s"] for r in export.running_start(n, "e", "n", "s", width=16).collect()}
    assert got == {k: sum(j % 7 for j in range(k)) for k in range(300)}
    rows = [(1, i, i, i / 30) for i in range(3)] + [(2, i, 3 + i, i / 30) for i in range(2)] + [(3, 0, 9, 0.0)]
    frames = spark.createDataFrame(rows, "episode_index long, frame_index long, index long, timestamp double")
    episodes = spark.createDataFrame([(1, 3), (2, 2), (3, 1), (4, 1)], "episode_index long, length long")
    videos = spark.createDataFrame([(1, "top", 3), (2, "top", 5)], "episode_index long, video_key string, n_frames long")
    got = {tuple(r) for r in export.verify_alignment(frames, episodes, total_frames=6, total_episodes=9, videos=videos).collect()}
    assert got == {(3, "global_index"), (4, "missing_frames"), (-1, "total_episodes"), (2, "video_frames top"), (3, "missing_video top")}


def test_strict_width():
    import pyarrow as pa

    column = pa.array([[1.0, 2.0, 3.0], None])
    assert dense.matrix(column, 2).tolist()[0] == [1.0, 2.0]
    with pytest.raises(ValueError):
        dense.matrix(column, 2, strict=True)


def test_pipeline_modes(spark, tmp_path):
    x = walk(60, 3)
    frames = frames_table(spark, [frame(e, t, x[t], x[t], shard=1) for e in (1, 2, 3) for t in range(60)])
    for mode, have in (("report", (True, False)), ("filter", (False, True)), ("both", (True, True))):
        out = tmp_path / mode
        results = pipeline.run_quality(frames, str(out), quality.QualityConfig(output_mode=mode))
        assert results.count() == 3 and ((out / "reports").exists(), (out / "data_filtered").exists()) == have
    masked = spark.read.parquet(str(tmp_path / "both/data_filtered/data"))
    assert masked.count() == 180 and "step_validity_mask" in masked.columns
    with pytest.raises(Exception, match="exists"):
        pipeline.run_quality(frames, str(tmp_path / "both"), quality.QualityConfig(output_mode="both"))
    tasks = spark.createDataFrame([(0, "fold")], "task_index long, task_name string")
    config = episode_filter.FilterConfig(multiplier=50.0, alpha=5.0, stage2=True, state_dims=(0, 1), action_dims=(0, 1))
    decisions = pipeline.run_filter(frames.where("episode_index <> 2 or frame_index < 50"), tasks, str(tmp_path / "kept"), config)
    assert decisions.count() == 3 and spark.read.json(str(tmp_path / "kept/reports/episode_decisions")).count() == 3
    kept = spark.read.parquet(str(tmp_path / "kept/data"))
    n = decisions.where("keep_episode").count()
    assert n == 3 and kept.select("episode_index").distinct().count() == n and kept.count() == 170
    assert pipeline.read_canonical(spark, str(tmp_path / "kept/data"), episodes=[0]).count() == 60
    info = tables.dataset_info({"fps": 20, "features": {"observation.state": {"dtype": "float32", "shape": [[20]]}, "cam": {"dtype": "video", "shape": [3, 4, 5]}, "x": {"dtype": "int64", "shape": 1}}})
    assert info["fps"] == 20 and info["shapes"] == {"observation.state": (20,), "cam": (3, 4, 5), "x": (1,)} and info["video_keys"] == ["cam"]
