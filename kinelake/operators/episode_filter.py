"""The lighter filter that keeps or drops whole episodes: sudden changes against the episode's own mean residual, extreme
values, hand confidence and, optionally, directional agreement and the reference frame.

Its stages share names with the frame-level pipeline but not their rules.  Plan: one shuffle by episode, an Arrow kernel
for the per-episode residuals, array expressions and one aggregation for the rest.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from kinelake.functions import geometry
from kinelake.functions.deliveries import once
from kinelake.functions.dense import longs, matrix, starts_of, whole_groups
from kinelake.functions.timeseries import odd_window
from kinelake.operators import statistics
from kinelake.session import materialise

WIDTH = 20


#: Where a configuration file has each setting (fixed values): path in the file -> field.
SETTINGS = {
    "action_key": "action_key", "state_key": "state_key", "confidence_key": "confidence_key", "action_frame": "action_frame", "confidence_min": "confidence_min", "max_bad_frame_ratio": "max_bad_frame_ratio",
    "stage1.enabled": "stage1", "stage1.smooth_window": "smooth_window", "stage1.median_window": "median_window", "stage1.residual_mean_multiplier": "multiplier", "stage1.min_threshold": "min_threshold",
    "stage2.enabled": "stage2", "stage2.max_lag": "max_lag", "stage2.min_directional_agreement": "min_agreement", "stage2.state_dims": "state_dims", "stage2.action_dims": "action_dims",
    "stage3.enabled": "stage3", "stage3.lower_percentile": "lower", "stage3.upper_percentile": "upper", "stage3.alpha": "alpha", "stage3.exempt_dims": "exempt",
    "stage5.enabled": "stage5", "stage5.require_fixed_action_frame": "check_frame",
}


@dataclass(frozen=True)
class FilterConfig:
    """Parameters with the filter's defaults; :meth:`from_dict` reads a configuration file's."""

    smooth_window: int = 11
    median_window: int = 5
    multiplier: float = 5.0
    min_threshold: float = 1e-6
    stage1: bool = True
    stage3: bool = True
    lower: float = 0.01
    upper: float = 0.99
    alpha: float = 0.1
    exempt: tuple[int, ...] = ()
    confidence_min: float | None = 0.15
    max_bad_frame_ratio: float = 0.2
    stage2: bool = False
    max_lag: int = 10
    min_agreement: float = 0.6
    state_dims: tuple[int, ...] | None = None
    action_dims: tuple[int, ...] | None = None
    stage5: bool = True
    check_frame: bool = True
    action_frame: str = "first_camera"
    action_key: str = "action"
    state_key: str | None = None
    confidence_key: str | None = "observation.confidence"

    @classmethod
    def from_dict(cls, given: dict, **overrides) -> "FilterConfig":
        """The settings of a configuration file (nested as in ``SETTINGS``, percentiles from 0 to 100); overrides (by field
        name) that are not None win.  ValueError for a setting that is not known."""
        flat = {}
        for k, v in (given or {}).items():
            flat |= {f"{k}.{n}": x for n, x in v.items()} if isinstance(v, dict) else {k: v}
        unknown = [k for k in flat if k not in SETTINGS] + [k for k in overrides if k not in SETTINGS.values()]
        if unknown:
            raise ValueError("unknown settings: " + ", ".join(sorted(unknown)))
        values = {SETTINGS[k]: tuple(v) if isinstance(v, list) else v for k, v in flat.items()}
        for k in ("lower", "upper"):
            if k in values:
                values[k] = values[k] / 100
        return cls(**values | {k: v for k, v in overrides.items() if v is not None})

    @classmethod
    def from_json(cls, path: str, **overrides) -> "FilterConfig":
        with open(path) as f:
            return cls.from_dict(json.load(f), **overrides)


def _windowed(x: np.ndarray, window: int, reduce) -> np.ndarray:
    if len(x) <= 2 or (w := odd_window(window, len(x))) <= 1:
        return x
    half = w // 2
    padded = np.pad(x, [(half, half), (0, 0)], mode="edge")
    return reduce(np.stack([padded[k : k + len(x)] for k in range(w)]))


def trend(x: np.ndarray, median_window: int = 5, smooth_window: int = 11) -> np.ndarray:
    """Median, then moving average of one episode (rows x channels); windows shrink with short episodes."""
    m = _windowed(x, median_window, lambda v: np.median(v, axis=0))
    return _windowed(m, smooth_window, lambda v: v.mean(axis=0))


RESIDUALS = "episode long, frame_index long, t long, action array<double>, confidence array<double>, residual array<double>, threshold array<double>"


def _residuals(config: FilterConfig, batches):
    for table in whole_groups(batches, "episode", rows=5_000):
        starts = starts_of(longs(table, "episode"))
        ends = np.append(starts[1:], table.num_rows)
        x = matrix(table.column("action"), WIDTH, strict=True)
        residual, limit = np.empty_like(x), np.empty_like(x)
        for a, b in zip(starts, ends):
            residual[a:b] = np.round(np.abs(x[a:b] - trend(x[a:b], config.median_window, config.smooth_window)), 9)
            limit[a:b] = np.maximum(np.round(residual[a:b].mean(axis=0) * config.multiplier, 9), config.min_threshold)
        lists = lambda v: pa.FixedSizeListArray.from_arrays(pa.array(v.ravel()), WIDTH).cast(pa.list_(pa.float64()))
        out = pa.table({"episode": table.column("episode"), "frame_index": table.column("frame_index"), "t": table.column("t"), "action": lists(x), "confidence": table.column("confidence"), "residual": lists(residual), "threshold": lists(limit)})
        yield from out.combine_chunks().to_batches()


def filter_frames(frames: DataFrame, config: FilterConfig = FilterConfig()) -> DataFrame:
    """(episode, frame_index, t, action, confidence): frames once each, a null action taken from the state.  The columns are
    those that the configuration names; without confidence column there is none."""
    from pyspark.sql import Window

    action, state = F.col(f"`{config.action_key}`"), config.state_key or "observation.state"
    action = F.coalesce(action, F.col(f"`{state}`")) if state in frames.columns else action
    known = config.confidence_key and config.confidence_key in frames.columns
    confidence = F.col(f"`{config.confidence_key}`") if known else F.lit(None)
    rows = frames.where("episode_index is not null and frame_index is not null").select(F.col("episode_index").alias("episode"), "frame_index", action.cast("array<double>").alias("action"), confidence.cast("array<double>").alias("confidence"))
    rows = once(rows.where("action is not null"), ["episode"], ["frame_index"])
    return rows.withColumn("t", (F.row_number().over(Window.partitionBy("episode").orderBy("frame_index")) - 1).cast("long"))


def extreme_bounds(rows: DataFrame, config: FilterConfig = FilterConfig()) -> DataFrame:
    """(channel, lower, upper): exact percentiles over all frames, widened; one row per channel."""
    actions, _ = materialise(rows.select("action"), "filter-actions")  # read once per round
    long = actions.select(F.posexplode("action").alias("channel", "v"))
    return statistics.percentile_bounds(long, "channel", "v", config.lower, config.upper, config.alpha).select("channel", "lower", "upper")


def judged_frames(frames: DataFrame, config: FilterConfig = FilterConfig()) -> DataFrame:
    """One row per frame with ``stage1``, ``stage3``, ``low_confidence``, ``bad`` and ``hand_confidence`` (null without confidence)."""
    rows = filter_frames(frames, config)
    inf = float("inf")
    limits = {r["channel"]: r for r in extreme_bounds(rows, config).collect()} if config.stage3 else {}  # one row per channel
    pick = lambda name, free: F.array(*[F.lit(float(free if c in config.exempt or c not in limits else limits[c][name])) for c in range(WIDTH)])
    rows = rows.mapInArrow(lambda it: _residuals(config, it), RESIDUALS)
    over = F.exists(F.zip_with("residual", "threshold", lambda r, t: ~F.isnan(r) & (r > t)), lambda v: v) if config.stage1 else F.lit(False)
    low = F.zip_with(F.col("action"), pick("lower", -inf), lambda v, b: ~F.isnan(v) & (v < b))
    high = F.zip_with(F.col("action"), pick("upper", inf), lambda v, b: ~F.isnan(v) & (v > b))
    beyond = F.exists(low, lambda v: v) | F.exists(high, lambda v: v) if config.stage3 else F.lit(False)
    rows = rows.withColumn("stage1", over).withColumn("stage3", beyond).withColumn("hand_confidence", geometry.hand_confidence(F.col("confidence")))
    unsure = F.coalesce(F.col("hand_confidence") < config.confidence_min, F.lit(False)) if config.confidence_min is not None else F.lit(False)
    return rows.withColumn("low_confidence", unsure).withColumn("bad", F.col("stage1") | F.col("stage3") | F.col("low_confidence"))


def reference_frame_ok(action_frame: str) -> bool:
    """False for frames of reference that move with every frame."""
    return action_frame not in ("current_camera", "per_frame_camera")


def episode_decisions(judged: DataFrame, config: FilterConfig = FilterConfig(), agreement: DataFrame | None = None) -> DataFrame:
    """(episode, length, bad_frame_ratio, reasons, keep_episode).  ``agreement`` (episode, score) is used with stage 2;
    an episode without score passes."""
    share = lambda c: F.avg(F.col(c).cast("double"))
    d = judged.groupBy("episode").agg(F.count("*").alias("length"), share("stage1").alias("_1"), share("stage3").alias("_3"), share("low_confidence").alias("_c"), share("bad").alias("bad_frame_ratio"))
    aligned = F.lit(True)
    if config.stage2 and agreement is not None:
        d = d.join(agreement.select("episode", "score"), "episode", "left")
        aligned = F.coalesce(F.col("score") >= config.min_agreement, F.lit(True))
    limit = config.max_bad_frame_ratio
    framed = not (config.stage5 and config.check_frame) or reference_frame_ok(config.action_frame)

    def reason(test: Column, name: str) -> Column:
        return F.when(test, name)

    reasons = F.array_compact(F.array(reason(F.col("_1") > limit, "sudden_change_high"), reason(F.col("_3") > limit, "extreme_value_high"), reason(F.col("_c") > limit, "low_confidence"), reason(F.col("bad_frame_ratio") > limit, "bad_frame_ratio_high"), reason(~aligned, "state_action_misaligned"), reason(F.lit(not framed), "reference_frame_invalid")))
    return d.withColumn("reasons", reasons).withColumn("keep_episode", F.size("reasons") == 0).select("episode", "length", "bad_frame_ratio", "reasons", "keep_episode")


def flagged_frames(judged: DataFrame, most: int = 200) -> DataFrame:
    """The first ``most`` bad frames of each episode: the report's own limit."""
    from pyspark.sql import Window

    i = F.row_number().over(Window.partitionBy("episode").orderBy("t"))
    return judged.where("bad").withColumn("_i", i).where(F.col("_i") <= most).select("episode", "frame_index", "stage1", "stage3", "low_confidence")
