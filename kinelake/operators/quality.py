"""The frame-level quality pipeline: stages 1 to 5 over episodes of frames, to keep masks and episode results.

Plan: frames are shuffled once by episode; an Arrow kernel over whole episodes adds the smoothed features of stage 1 and
the alignment scores of stage 2; everything else is window and array expressions on that partitioning.  Statistics over
the dataset are sparse histograms (partial aggregation before the shuffle).  What comes back to the driver is a fixed
number of thresholds (28 channels x 5), which enter the plan as literals.
"""

from __future__ import annotations

from dataclasses import dataclass, fields, replace

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from kinelake.functions import geometry
from kinelake.functions.deliveries import once
from kinelake.functions.dense import longs, matrix, starts_of, whole_groups
from kinelake.functions.timeseries import savgol_taps
from kinelake.operators import statistics

DIMS = 14


@dataclass(frozen=True)
class Layout:
    """Which of the 14 dimensions are what."""

    name: str
    xyz: tuple[int, ...] = ()
    rpy: tuple[int, ...] = ()
    joints: tuple[int, ...] = ()
    grippers: tuple[int, ...] = ()


POSE = Layout("pose_gripper", (0, 1, 2, 7, 8, 9), (3, 4, 5, 10, 11, 12), (), (6, 13))
JOINT = Layout("joint_gripper", (), (), tuple(range(12)), (12, 13))
LAYOUTS = {"egodex": POSE, "humanoid": JOINT}


#: Where a configuration file has each setting (fixed values): path in the file -> field.
SETTINGS = {
    "pipeline.min_episode_length": "min_episode_length", "pipeline.action_zero_epsilon": "zero_epsilon", "pipeline.stage1_post_zero_grace_frames": "grace_frames",
    "pipeline.discard_short_prefix": "discard_short", "pipeline.output_mode": "output_mode", "preprocess.action_from_state": "action_from_state", "dataset.fps": "fps", "dataset.total_episodes": "total_episodes",
    "stage1.smoothing.median_kernel": "median_kernel", "stage1.smoothing.savgol_window": "savgol_window", "stage1.smoothing.savgol_polyorder": "savgol_order",
    "stage1.thresholds.k_residual": "k_residual", "stage1.thresholds.k_accel": "k_accel", "stage1.thresholds.k_jerk": "k_jerk", "stage1.thresholds.percentile_floor": "percentile_floor",
    "stage1.hard_limits.joint_abs_max": "joint_abs_max", "stage1.hard_limits.ee_position_max": "position_max", "stage1.hard_limits.rpy_abs_max": "rpy_max", "stage1.hard_limits.gripper_max": "gripper_max",
    "stage1.exclusion.frame_removal.min_cluster_length_for_abnormal": "abnormal_cluster", "stage1.exclusion.episode_discard.min_cluster_length": "episode_cluster", "stage1.exclusion.episode_discard.min_cluster_frame_jump": "cluster_jump",
    "stage1.exclusion.episode_discard.on_hard_limit_violation": "discard_on_hard_limit", "stage1.stats.recompute": "stage1_stats_recompute", "stage1.stats.cache_path": "stage1_stats_cache",
    "stage2.action_type": "action_type", "stage2.smoothing.median_kernel": "stage2_median_kernel", "stage2.smoothing.savgol_window": "stage2_savgol_window", "stage2.smoothing.savgol_polyorder": "stage2_savgol_order",
    "stage2.alignment.max_lag_frames": "max_lag", "stage2.alignment.diff_epsilon": "diff_epsilon", "stage2.alignment.min_active_samples": "min_active", "stage2.thresholds.da_per_dim": "da_dim", "stage2.thresholds.da_episode_mean": "da_mean",
    "stage3.alpha": "alpha", "stage3.hard_limits.joint": "joint_range", "stage3.hard_limits.ee_xyz": "xyz_range", "stage3.hard_limits.rpy": "rpy_range", "stage3.hard_limits.gripper": "gripper_range",
    "stage3.exclusion.min_episode_length": "stage3_min_length", "stage3.stats.recompute": "stats_recompute", "stage3.stats.cache_path": "stats_cache", "stage3.stats.num_histogram_bins": "bins",
    "stage4.enabled": "stage4", "stage4.max_static_steps": "static_steps", "stage4.change_epsilon": "static_epsilon",
    "stage5.enabled": "stage5", "stage5.reference_frame": "reference_frame", "stage5.rotation_correction_euler_xyz": "correction", "stage5.egodex_extrinsics_column": "extrinsics_column",
    "stage5.humanoid_calibration_relpath": "calibration_path", "stage5.humanoid_camera_extrinsic_key": "extrinsic_key",
}
#: Settings of the file (fixed values) that need no field here: what Spark decides itself, what names the dataset, and what no rule reads.
WITHOUT_EFFECT = (
    "schema.canonical_dim", "schema.state_column", "schema.action_column", "schema.raw_columns", "dataset.root", "dataset.embodiment", "dataset.robot_type", "pipeline.num_workers",
    "stage1.exclusion.mode", "stage1.exclusion.frame_removal.max_cluster_length", "stage2.exclusion.mode", "stage2.shared_dims", "stage3.exclusion.mode", "stage3.exclusion.validity_mask", "stage3.quaternion",
)
_EXEMPT = "stage3.exempt_dims"


def settings_of(given: dict, prefix: str = "") -> dict:
    """Nested settings as path -> value; lists become tuples."""
    out = {}
    for k, v in given.items():
        if isinstance(v, dict) and v:
            out |= settings_of(v, f"{prefix}{k}.")
        elif not isinstance(v, dict):
            out[f"{prefix}{k}"] = tuple(v) if isinstance(v, list) else v
    return out


@dataclass(frozen=True)
class QualityConfig:
    """Parameters with the pipeline's defaults; :meth:`from_yaml` reads a configuration file."""

    layout: Layout = POSE
    median_kernel: int = 5
    savgol_window: int = 11
    savgol_order: int = 3
    k_residual: float = 8.0
    k_accel: float = 8.0
    k_jerk: float = 8.0
    percentile_floor: float = 99.9
    joint_abs_max: float = 3.5
    position_max: float = 2.0
    rpy_max: float = 3.14159265
    gripper_max: float = 1.0
    abnormal_cluster: int = 1
    episode_cluster: int = 20
    cluster_jump: float = 0.08
    discard_on_hard_limit: bool = True
    stage2_median_kernel: int = 5
    stage2_savgol_window: int = 11
    stage2_savgol_order: int = 3
    max_lag: int = 5
    diff_epsilon: float = 1e-4
    min_active: int = 10
    da_dim: float = 0.65
    da_mean: float = 0.65
    action_type: str = "absolute"
    alpha: float = 0.15
    joint_range: tuple[float, float] = (-3.5, 3.5)
    xyz_range: tuple[float, float] = (-2.0, 2.0)
    rpy_range: tuple[float, float] = (-3.15, 3.15)
    gripper_range: tuple[float, float] = (-0.01, 1.0)
    exempt_state: tuple[int, ...] = (6, 13)
    exempt_action: tuple[int, ...] = (6, 13)
    stage4: bool = True
    static_steps: int = 5
    static_epsilon: float = 0.0
    stage5: bool = False
    reference_frame: str = "camera_top_frame0"
    correction: tuple[float, float, float] = (0.0, 0.0, 0.0)
    extrinsics_column: str = "observation.camera_extrinsics_world"
    calibration_path: str = "parameters/chunk-{chunk:03d}/episode_{episode:06d}/calibration_bundle_optimized.json"
    extrinsic_key: str = "camera_front_to_arm_left"
    min_episode_length: int = 30
    stage3_min_length: int = 30
    zero_epsilon: float = 1e-4
    grace_frames: int = 0
    discard_short: bool = False
    action_from_state: bool = False
    output_mode: str = "report"
    fps: int = 30
    total_episodes: int | None = None
    stats_recompute: bool = True
    stats_cache: str = "cache/global_stats"
    stage1_stats_recompute: bool = True
    stage1_stats_cache: str = "cache/stage1_global_stats"
    bins: int = statistics.BINS

    @classmethod
    def from_dict(cls, given: dict, **overrides) -> "QualityConfig":
        """The settings of a configuration file (nested as in ``SETTINGS``); overrides (by field name) that are not None win.
        ValueError for a setting that is not known, so that none is ignored.

        A file that names no dimensions as exempt from stage 3's percentile band exempts grippers and angles."""
        flat = settings_of(given or {})
        embodiment = flat.pop("schema.embodiment", flat.get("dataset.embodiment"))
        kind = flat.pop("schema.layout", None)
        by_layout = {y.name: y for y in (POSE, JOINT)}
        if kind is not None and kind not in by_layout or kind is None and embodiment is not None and embodiment not in LAYOUTS:
            raise ValueError(f"unknown layout {kind or embodiment!r}")
        layout = by_layout[kind] if kind else LAYOUTS.get(embodiment, POSE)
        values: dict = {"layout": layout}
        for side in ("state", "action"):
            named = [flat.pop(f"{_EXEMPT}.{part}_{side}", default) for part, default in (("gripper", layout.grippers), ("rpy", layout.rpy))]
            values[f"exempt_{side}"] = tuple(sorted({*named[0], *named[1]}))
        unknown = [k for k in flat if k not in SETTINGS and not any(k == x or k.startswith(x + ".") for x in WITHOUT_EFFECT)]
        names = {f.name for f in fields(cls)}
        unknown += [k for k in overrides if k not in names]
        if unknown:
            raise ValueError("unknown settings: " + ", ".join(sorted(unknown)))
        values |= {SETTINGS[k]: v for k, v in flat.items() if k in SETTINGS}
        out = replace(cls(), **values | {k: v for k, v in overrides.items() if v is not None})
        if out.action_type not in ("absolute", "delta") or out.output_mode not in ("report", "filter", "both"):
            raise ValueError(f"unknown action type {out.action_type!r} or output mode {out.output_mode!r}")
        return out

    @classmethod
    def from_yaml(cls, path: str, **overrides) -> "QualityConfig":
        import yaml

        with open(path) as f:
            return cls.from_dict(yaml.safe_load(f), **overrides)


def episode_frames(frames: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """(episode, frame_index, t, state, action): canonical 14 numbers each, t counting the frames present from 0.

    A frame delivered several times counts once; a null action is taken from the state (all actions are, with
    ``action_from_state``); frames without keys or state are left out."""
    rows = frames.where("episode_index is not null and frame_index is not null and `observation.state` is not null")
    rows = rows.select(F.col("episode_index").alias("episode"), "frame_index", F.col("`observation.state`").alias("s"), F.col("action").alias("a"))
    rows = once(rows, ["episode"], ["frame_index"])
    action = F.col("s") if config.action_from_state else F.coalesce("a", "s")
    convert = geometry.canonical14 if config.layout is POSE else (lambda v: F.transform(F.slice(v, 1, DIMS), lambda x: x.cast("double")))
    t = (F.row_number().over(Window.partitionBy("episode").orderBy("frame_index")) - 1).cast("long")
    return rows.select("episode", "frame_index", t.alias("t"), convert(F.col("s")).alias("state"), convert(action).alias("action"))


# -------------------------------------------------------------------- kernel


def _gather(x, offsets, first, last):
    at = np.arange(len(x))
    return [x[np.clip(at + k, first, last)] for k in offsets]


def smoothed(x: np.ndarray, first: np.ndarray, last: np.ndarray, kernel: int = 5, window: int = 11, order: int = 3) -> np.ndarray:
    """Median, then Savitzky-Golay, edges repeated within [first, last]; series shorter than the window stay as they are."""
    half = kernel // 2
    m = np.median(np.stack(_gather(x, range(-half, half + 1), first, last)), axis=0)
    out = np.zeros_like(x)
    for c, v in zip(savgol_taps(window, order), _gather(m, range(-(window // 2), window // 2 + 1), first, last)):
        out += c * v
    short = (last - first + 1) < window
    out[short] = x[short]
    return out


def gradient(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    at = np.arange(len(x))
    back, ahead = np.maximum(at - 1, first), np.minimum(at + 1, last)
    return (x[ahead] - x[back]) / np.maximum(ahead - back, 1)[:, None]


def alignment_scores(s: np.ndarray, a: np.ndarray, max_lag: int, epsilon: float, least: int) -> tuple[float, int]:
    """(directional agreement, lag) of two smoothed series; NaN where it cannot be scored."""
    ds, da = np.diff(s), np.diff(a)
    n = len(ds)
    if n < least + max_lag:
        return float("nan"), 0
    zs, za = (ds - ds.mean()) / (ds.std() + 1e-8), (da - da.mean()) / (da.std() + 1e-8)
    best, lag = -np.inf, 0
    for k in range(-max_lag, max_lag + 1):
        c = round(float(np.dot(zs[max(k, 0) : n + min(k, 0)], za[max(-k, 0) : n - max(k, 0)]) / n), 9)
        if c > best:
            best, lag = c, k
    x, y = ds[max(lag, 0) : n + min(lag, 0)], da[max(-lag, 0) : n - max(lag, 0)]
    active = (np.abs(x) > epsilon) & (np.abs(y) > epsilon)
    if active.sum() < least:
        return float("nan"), lag
    return float((np.sign(x[active]) == np.sign(y[active])).mean()), lag


FEATURES = "episode long, frame_index long, t long, n long, state array<double>, action array<double>, residual array<double>, accel array<double>, jerk array<double>, da array<double>, lags array<long>"


def _features(config: QualityConfig, batches):
    for table in whole_groups(batches, "episode", rows=5_000):
        starts = starts_of(longs(table, "episode"))
        n = table.num_rows
        length = np.diff(np.append(starts, n))
        first = np.repeat(starts, length)
        last = first + np.repeat(length, length) - 1
        state, action = matrix(table.column("state"), DIMS, strict=True), matrix(table.column("action"), DIMS, strict=True)
        x = np.concatenate([state, action], axis=1)
        smooth = smoothed(x, first, last, config.median_kernel, config.savgol_window, config.savgol_order)
        accel = gradient(gradient(x, first, last), first, last)
        jerk = gradient(accel, first, last)
        second = (config.stage2_median_kernel, config.stage2_savgol_window, config.stage2_savgol_order)
        smooth2 = smooth if second == (config.median_kernel, config.savgol_window, config.savgol_order) else smoothed(x, first, last, *second)
        aligned = smooth2[:, DIMS:]
        if config.action_type == "delta":
            total = np.concatenate([np.cumsum(action[a : a + m], axis=0) + action[a] for a, m in zip(starts, length)])
            aligned = smoothed(total, first, last, *second)
        da, lags = np.zeros((len(starts), DIMS)), np.zeros((len(starts), DIMS), np.int64)
        for i, (a, m) in enumerate(zip(starts, length)):
            for d in range(DIMS):
                da[i, d], lags[i, d] = alignment_scores(smooth2[a : a + m, d], aligned[a : a + m, d], config.max_lag, config.diff_epsilon, config.min_active)
        owner = np.repeat(np.arange(len(starts)), length)
        lists = lambda v, t=pa.float64(): pa.FixedSizeListArray.from_arrays(pa.array(v.ravel(), t), v.shape[1]).cast(pa.list_(t))
        out = pa.table(
            {"episode": table.column("episode"), "frame_index": table.column("frame_index"), "t": table.column("t"), "n": pa.array(np.repeat(length, length)), "state": lists(state), "action": lists(action), "residual": lists(np.abs(x - smooth)), "accel": lists(np.abs(accel)), "jerk": lists(np.abs(jerk)), "da": lists(da[owner]), "lags": lists(lags[owner], pa.int64())}
        )
        yield from out.combine_chunks().to_batches()


def with_features(episodes: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Adds per frame the absolute residual, acceleration and jerk of the 28 channels (state, then action) and, the same
    on every frame of an episode, the 14 alignment scores (NaN: none) and lags."""
    return episodes.mapInArrow(lambda it: _features(config, it), FEATURES)


# ---------------------------------------------------------------- statistics


def _long(rows: DataFrame, name: str, value: Column) -> DataFrame:
    return rows.select(F.lit(name).alias("metric"), F.posexplode(value).alias("channel", "v"))


def global_stats(episodes: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """(channel, q01, q99, lo, hi, n) of the 28 channels, from two-pass histograms."""
    long = _long(episodes, "x", F.concat("state", "action"))
    ranges = statistics.value_ranges(long, ["channel"], "v").collect()  # 28 rows
    q = statistics.histogram_quantiles(statistics.histogram(long, ranges, ["channel"], "v", config.bins), ["channel"], {"q01": 0.01, "q99": 0.99}, config.bins)
    known = episodes.sparkSession.createDataFrame([tuple(r) for r in ranges], "channel int, lo double, hi double, n long")
    return known.join(q, "channel", "left")


def stage1_thresholds(features: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """(channel, metric, threshold) from the features of all episodes that are as long as the smoothing window.  The
    percentile of accel and jerk is at most 99.95."""
    rows = features.where(F.col("n") >= config.savgol_window)
    metrics = ("residual", "accel", "jerk")
    every = _long(rows, metrics[0], F.col(metrics[0])).unionByName(_long(rows, metrics[1], F.col(metrics[1]))).unionByName(_long(rows, metrics[2], F.col(metrics[2])))
    ranges = statistics.value_ranges(every, ["channel", "metric"], "v").collect()  # 28 x 3 rows
    out = None
    for metric in metrics:
        long = _long(rows, metric, F.col(metric))
        counts = statistics.histogram(long, ranges, ["channel", "metric"], "v", config.bins, flat=1e-12)
        p = config.percentile_floor if metric == "residual" else min(config.percentile_floor, 99.95)
        one = statistics.hybrid_thresholds(counts, ["channel", "metric"], getattr(config, f"k_{metric}"), p, config.bins).select("channel", "metric", "threshold")
        out = one if out is None else out.unionByName(one)
    return out


def _literal(rows, name: str, missing: float, width: int = 2 * DIMS) -> Column:
    """Channel values collected from a statistics table (``width`` rows) as an array literal."""
    values = {r["channel"]: r[name] for r in rows}
    return F.array(*[F.lit(float(missing if values.get(c) is None else values[c])) for c in range(width)])


# -------------------------------------------------------------------- stages


def _any(column: str, dims, test) -> Column:
    out = F.lit(False)
    for d in dims:
        out = out | test(F.get(F.col(column), F.lit(d)))
    return out


def hard_limits(episodes: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Adds ``hard_state_joint``, ``hard_action_joint``, ``hard_state_xyz``, ``hard_state_rpy``, ``hard_state_gripper``
    and ``hard_action_gripper``.  NaN exceeds nothing."""
    over = lambda limit: (lambda v: ~F.isnan(v) & (F.abs(v) > limit))
    y = config.layout
    return episodes.withColumns(
        {
            "hard_state_joint": _any("state", y.joints, over(config.joint_abs_max)),
            "hard_action_joint": _any("action", y.joints, over(config.joint_abs_max)),
            "hard_state_xyz": _any("state", y.xyz, over(config.position_max)),
            "hard_state_rpy": _any("state", y.rpy, over(config.rpy_max)),
            "hard_state_gripper": _any("state", y.grippers, over(config.gripper_max)),
            "hard_action_gripper": _any("action", y.grippers, over(config.gripper_max)),
        }
    )


HARD = ("hard_state_joint", "hard_action_joint", "hard_state_xyz", "hard_state_rpy", "hard_state_gripper", "hard_action_gripper")


def _startup(config: QualityConfig, grace: int) -> Column:
    """array<boolean>[14]: before the dimension's action first leaves 0 (and ``grace`` frames on); never leaving: always."""
    w = Window.partitionBy("episode")
    first = [F.min(F.when(F.abs(F.get("action", F.lit(d))) > config.zero_epsilon, F.col("t"))).over(w) for d in range(DIMS)]
    return F.array(*[f.isNull() | (F.col("t") < f + grace) for f in first])


def stage1(features: DataFrame, thresholds: list, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Adds ``s1_flags`` (28 booleans), ``s1_hard``, ``s1_bad``.  A flag needs residual and one of accel and jerk above
    the channel's threshold, in an episode as long as the smoothing window, outside start-up and, with
    ``abnormal_cluster`` > 1, in a run of at least so many frames."""
    by = {m: [r for r in thresholds if r["metric"] == m] for m in ("residual", "accel", "jerk")}
    inf = float("inf")
    tr, ta, tj = (_literal(by[m], "threshold", inf) for m in ("residual", "accel", "jerk"))
    above = lambda c, t: F.zip_with(F.col(c), t, lambda x, y: ~F.isnan(x) & (x > y))
    either = F.zip_with(above("accel", ta), above("jerk", tj), lambda a, b: a | b)
    flags = F.zip_with(above("residual", tr), either, lambda a, b: a & b)
    rows = hard_limits(features, config).withColumn("_startup", _startup(config, config.grace_frames))
    rows = rows.withColumn("s1_flags", F.zip_with(flags, F.concat("_startup", "_startup"), lambda f, e: f & ~e & (F.col("n") >= config.savgol_window))).drop("_startup")
    if config.abnormal_cluster > 1:
        rows = _clustered(rows, config.abnormal_cluster)
    hard = F.lit(False)
    for h in HARD:
        hard = hard | F.col(h)
    return rows.withColumn("s1_hard", hard).withColumn("s1_bad", hard | F.exists("s1_flags", lambda f: f))


def _clustered(rows: DataFrame, least: int) -> DataFrame:
    """Keeps flags in runs of at least ``least`` frames: a flag survives if some window of that many frames around it is flagged."""
    w = Window.partitionBy("episode").orderBy("t")
    out = []
    for c in range(2 * DIMS):
        f = F.coalesce(F.get("s1_flags", F.lit(c)), F.lit(False)).cast("int")
        full = (F.sum(f).over(w.rowsBetween(-(least - 1), 0)) == least).cast("int")
        rows = rows.withColumn(f"_w{c}", full)
        out.append(F.max(f"_w{c}").over(w.rowsBetween(0, least - 1)) == 1)
    return rows.withColumn("s1_flags", F.array(*out)).drop(*[f"_w{c}" for c in range(2 * DIMS)])


def _cluster_reasons(masks: DataFrame, config: QualityConfig) -> DataFrame:
    """(episode, reasons): per channel the first run of at least ``episode_cluster`` flagged frames in which the channel
    jumps by at least ``cluster_jump`` from one frame to the next, in the order of the channels (state, then action).

    Only flagged (episode, channel, t) cells are shuffled."""
    cells = masks.select("episode", "t", F.explode(F.filter(F.transform(F.arrays_zip("s1_flags", F.concat("state", "action").alias("x")), lambda v, c: F.struct(c.alias("channel"), v["s1_flags"].alias("flag"), v["x"].alias("x"))), lambda v: v["flag"])).alias("v")).select("episode", "t", "v.channel", "v.x")
    w = Window.partitionBy("episode", "channel").orderBy("t")
    run = F.col("t") - F.row_number().over(w)
    jump = F.when(F.lag("t").over(w) == F.col("t") - 1, F.abs(F.col("x") - F.lag("x").over(w)))
    runs = cells.withColumn("_run", run).withColumn("_jump", jump).groupBy("episode", "channel", "_run").agg(F.count("*").alias("n"), F.max("_jump").alias("_jump"), F.count(F.when(F.isnan("_jump"), 1)).alias("_nan"))
    # As in numpy, a NaN makes the greatest jump NaN, which reaches nothing.
    long = runs.where((F.col("n") >= config.episode_cluster) & (F.col("_nan") == 0) & (F.col("_jump") >= config.cluster_jump))
    first = long.groupBy("episode", "channel").agg(F.min_by("n", "_run").alias("n"))
    named = first.groupBy("episode").agg(F.sort_array(F.collect_list(F.struct("channel", "n"))).alias("_c"))
    return named.select("episode", F.transform("_c", lambda v: F.format_string("sudden_change_cluster_dim%d_len%d", v["channel"], v["n"])).alias("s1_clusters"))


def stage2_decision(config: QualityConfig = QualityConfig()) -> tuple[Column, Column, Column]:
    """(mean score or null, discard, low dimensions) from the ``da`` of :func:`with_features`."""
    scored = F.filter("da", lambda x: ~F.isnan(x))
    mean = F.when(F.size(scored) > 0, F.aggregate(scored, F.lit(0.0), lambda a, x: a + x) / F.size(scored))
    low = F.filter(F.transform("da", lambda x, i: F.when(~F.isnan(x) & (x < config.da_dim), i.cast("long"))), lambda i: i.isNotNull())
    return mean, F.coalesce(mean < config.da_mean, F.lit(False)) | (F.size(low) > 0), low


def stage3(rows: DataFrame, stats: list, config: QualityConfig = QualityConfig()) -> DataFrame:
    """Adds ``s3_bad``: outside the closed ranges of the fields, or outside the widened percentile band of a dimension
    that is not exempt, past its start-up (12 dimensions for joints, all for poses)."""
    q01, q99 = {r["channel"]: r["q01"] for r in stats}, {r["channel"]: r["q99"] for r in stats}
    inf = float("inf")
    lo, hi = [], []
    for c in range(2 * DIMS):
        a, b = q01.get(c), q99.get(c)
        free = c % DIMS in (config.exempt_state if c < DIMS else config.exempt_action) or a is None
        lo.append(F.lit(-inf if free else a - config.alpha * (b - a)))
        hi.append(F.lit(inf if free else b + config.alpha * (b - a)))
    both = F.concat("state", "action")
    beyond = F.zip_with(F.zip_with(both, F.array(*lo), lambda x, y: ~F.isnan(x) & (x < y)), F.zip_with(both, F.array(*hi), lambda x, y: ~F.isnan(x) & (x > y)), lambda a, b: a | b)
    start = _startup(config, 0)
    dims = 12 if config.layout is JOINT else DIMS
    rows = rows.withColumn("_startup", F.transform(start, lambda s, i: s & (i < dims)))
    band = F.exists(F.zip_with(beyond, F.concat("_startup", "_startup"), lambda b, s: b & ~s), lambda v: v)
    out = lambda r: (lambda v: ~F.isnan(v) & ((v < r[0]) | (v > r[1])))
    y = config.layout
    hard = _any("state", y.joints, out(config.joint_range)) | _any("action", y.joints, out(config.joint_range)) | _any("state", y.xyz, out(config.xyz_range)) | _any("state", y.rpy, out(config.rpy_range)) | _any("state", y.grippers, out(config.gripper_range)) | _any("action", y.grippers, out(config.gripper_range))
    return rows.withColumn("s3_bad", hard | band).drop("_startup")


def _equal(a: Column, b: Column, epsilon: float) -> Column:
    if epsilon <= 0:
        return (a == b) & ~F.exists(a, F.isnan)
    return F.forall(F.zip_with(a, b, lambda x, y: ~F.isnan(x) & ~F.isnan(y) & (F.abs(x - y) <= epsilon)), lambda v: v)


def stage4(rows: DataFrame, config: QualityConfig = QualityConfig(), within: str | None = None) -> DataFrame:
    """Adds ``s4_remove``: frames beyond the first ``static_steps`` of a run in which neither state nor action changes
    from frame to frame; with ``within`` only frames where that column is true take part (a prefix of the episode)."""
    w = Window.partitionBy("episode").orderBy("t")
    still = F.coalesce(_equal(F.col("state"), F.lag("state").over(w), config.static_epsilon) & _equal(F.col("action"), F.lag("action").over(w), config.static_epsilon), F.lit(False))
    if within:
        still = still & F.col(within)
    rows = rows.withColumn("_still", still).withColumn("_run", F.sum((~F.col("_still")).cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    i = F.row_number().over(Window.partitionBy("episode", "_run").orderBy("t"))
    remove = i > config.static_steps if config.stage4 and config.static_steps >= 1 else F.lit(False)
    if within:
        remove = remove & F.col(within)
    return rows.withColumn("s4_remove", remove).drop("_still", "_run")


def keep_masks(frames: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """The rows of :func:`masks_and_thresholds`."""
    return masks_and_thresholds(frames, config)[0]


def masks_and_thresholds(frames: DataFrame, config: QualityConfig = QualityConfig()) -> tuple[DataFrame, list]:
    """The thresholds of stage 1 (channel, metric, threshold), and one row per frame with the stages' verdicts and ``keep`` (1 or 0): truncated at the first frame that stage 1 or 3
    finds bad (all frames, where stage 2 rejects the episode), minus static frames."""
    from kinelake.session import materialise

    episodes = episode_frames(frames, config)
    # Written once: the features are read for the statistics and for the stages.
    features, _ = materialise(with_features(episodes, config), "stage-features")
    thresholds = stage1_thresholds(features, config).collect()  # 28 x 3 rows
    stats = global_stats(features, config).collect()  # 28 rows
    mean, discard, low = stage2_decision(config)
    rows = stage3(stage1(features, thresholds, config), stats, config).withColumn("da_mean", mean).withColumn("s2_discard", discard).withColumn("da_low", low)
    w = Window.partitionBy("episode").orderBy("t")
    rows = rows.withColumn("bad", F.col("s1_bad") | F.when(F.col("s2_discard"), F.lit(True)).otherwise(F.col("s3_bad")))
    rows = rows.withColumn("in_prefix", F.max(F.col("bad").cast("int")).over(w.rowsBetween(Window.unboundedPreceding, 0)) == 0)
    rows = stage4(rows, config, "in_prefix")
    return rows.withColumn("keep", (F.col("in_prefix") & ~F.col("s4_remove")).cast("int")), thresholds


def episode_results(masks: DataFrame, config: QualityConfig = QualityConfig()) -> DataFrame:
    """One row per episode: frames, kept frames, first removed frame (-1: none), counts per stage, reasons, discard."""
    count = lambda c: F.sum(F.col(c).cast("long"))
    flagged = F.sum(F.size(F.filter("s1_flags", lambda f: f)).cast("long"))
    r = masks.groupBy("episode").agg(
        F.count("*").alias("num_frames"), F.sum(F.col("keep").cast("long")).alias("kept_frames"), F.coalesce(F.min(F.when(F.col("keep") == 0, F.col("t"))), F.lit(-1)).alias("first_abnormal_frame"),
        flagged.alias("stage1_flagged"), F.max("s1_hard").alias("stage1_hard_limit"), F.first("da_mean").alias("stage2_da_mean"), F.max("s2_discard").alias("s2_discard"), F.first("da_low").alias("da_low"),
        count("s3_bad").alias("stage3_excluded_frames"), count("s4_remove").alias("stage4_removed_frames"), *[F.max(h).alias(h) for h in HARD],
    )
    r = r.join(_cluster_reasons(masks, config), "episode", "left")
    short = F.col("kept_frames") < config.min_episode_length
    left = F.col("num_frames") - F.col("stage3_excluded_frames")
    names = {"hard_state_joint": "hard_limit_state_joint", "hard_action_joint": "hard_limit_action_joint", "hard_state_xyz": "hard_limit_state_xyz", "hard_state_rpy": "hard_limit_state_rpy", "hard_state_gripper": "hard_limit_state_gripper", "hard_action_gripper": "hard_limit_action_gripper"}
    hard = F.array_compact(F.array(*[F.when(F.col(h), n) for h, n in names.items()]))
    others = F.array_compact(
        F.array(
            F.when(F.col("s2_discard") & (F.col("stage2_da_mean") < config.da_mean), F.format_string(f"stage2:da_episode_mean=%.4f<{config.da_mean}", F.col("stage2_da_mean"))),
            F.when(F.size("da_low") > 0, F.concat(F.lit("stage2:da_low_dims=["), F.array_join(F.col("da_low").cast("array<string>"), ", "), F.lit("]"))),
            F.when(~F.col("s2_discard") & (left < config.stage3_min_length), F.concat(F.lit("stage3:remaining_frames="), left.cast("string"), F.lit(f"<{config.stage3_min_length}"))),
            F.when(F.lit(config.discard_short) & short, F.concat(F.lit("kept_frames="), F.col("kept_frames").cast("string"), F.lit(f"<{config.min_episode_length}"))),
            F.when(F.col("first_abnormal_frame") >= 0, F.concat(F.lit("first_removed_frame="), F.col("first_abnormal_frame").cast("string"))),
        )
    )
    reasons = F.concat(hard, F.coalesce("s1_clusters", F.array().cast("array<string>")), others)
    return r.withColumn("low_valid_prefix", short).withColumn("discard", F.lit(config.discard_short) & short).withColumn("discard_reasons", reasons).drop(*HARD, "s2_discard", "da_low", "s1_clusters")


def quality_report(results: DataFrame) -> DataFrame:
    """One row: episodes, discarded, kept, frame totals, rates (0 for an empty table), stage counters."""
    n, frames = F.count("*"), F.coalesce(F.sum("num_frames"), F.lit(0))
    kept, gone = F.coalesce(F.sum("kept_frames"), F.lit(0)), F.coalesce(F.sum(F.col("discard").cast("long")), F.lit(0))
    s = lambda c: F.coalesce(F.sum(F.col(c).cast("long")), F.lit(0)).alias(c)
    r = results.agg(n.alias("episodes"), gone.alias("discarded"), (n - gone).alias("kept_episodes"), frames.alias("frames"), kept.alias("kept_frames"), s("stage1_flagged"), s("stage3_excluded_frames"), s("stage4_removed_frames"), s("low_valid_prefix"), F.avg("stage2_da_mean").alias("da_mean"), F.min("stage2_da_mean").alias("da_min"), F.max("stage2_da_mean").alias("da_max"), F.count(F.when(F.col("stage2_da_mean") < 0.7, 1)).alias("da_below_07"))
    return r.withColumn("discard_rate", F.when(F.col("episodes") > 0, F.col("discarded") / F.col("episodes")).otherwise(0.0)).withColumn("frame_keep_rate", F.when(F.col("frames") > 0, F.col("kept_frames") / F.col("frames")).otherwise(0.0))


def reason_counts(results: DataFrame, only_discarded: bool = True) -> DataFrame:
    """(reason, n): reasons up to '=', counted over the discarded episodes, as in the report, or over all."""
    rows = results.where("discard") if only_discarded else results
    return rows.select(F.explode("discard_reasons").alias("r")).select(F.split("r", "=")[0].alias("reason")).groupBy("reason").agg(F.count("*").alias("n"))


def stage5_align(episodes: DataFrame, reference: Column, correction: list[float]) -> DataFrame:
    """Adds ``aligned``, ``aligned_action`` (14 numbers each; the latter where there is an action) and
    ``reference_forward`` (3): each hand's pose moved by ``reference`` (pose of 16) and turned by the correction
    (extrinsic xyz angles); grippers are copied."""
    turn = geometry.euler_to_matrix(F.array(*[F.lit(float(c)) for c in correction]))

    def hand(v, c, p, start):
        r, t = geometry.pose_parts(p)
        c = geometry.items(c, 9)
        xyz = geometry.let(geometry.vector([a + b for a, b in zip(geometry.mat_vec(r, geometry.items(v, 3, start)), t)]), lambda v: geometry.vector(geometry.mat_vec(c, geometry.items(v, 3))))
        both = geometry.let(geometry.vector(geometry.mat_mul(c, r)), lambda m: geometry.let(geometry.euler_to_matrix(v, start + 3), lambda e: geometry.vector(geometry.mat_mul(geometry.items(m, 9), geometry.items(e, 9)))))
        return F.concat(xyz, geometry.matrix_to_euler(both), F.array(geometry.item(v, start + 6)))

    def forward(c, p):
        m = geometry.mat_mul(geometry.items(c, 9), geometry.pose_parts(p)[0])
        norm = F.sqrt(m[0] * m[0] + m[3] * m[3] + m[6] * m[6])
        return geometry.let(F.when(norm > 1e-8, norm).otherwise(1.0), lambda n: geometry.vector([m[i] / n for i in (0, 3, 6)]))

    both = lambda f: geometry.let(turn, lambda c: geometry.let(reference, lambda p: f(c, p)))
    moved = lambda v: both(lambda c, p: F.concat(hand(F.col(v), c, p, 0), hand(F.col(v), c, p, 7)))
    action = {"aligned_action": moved("action")} if "action" in episodes.columns else {}
    return episodes.withColumns({"aligned": moved("state"), **action, "reference_forward": both(forward)})
