"""The quality pipeline and the episode filter from a dataset to their outputs, as configured."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kinelake.operators import alignment, episode_filter, export, quality
from kinelake.functions.timeseries import Axis
from kinelake.session import materialise
from kinelake.sources.tables import read_episodes


def read_canonical(spark: SparkSession, root: str, config: quality.QualityConfig = quality.QualityConfig(), episodes: list[int] | None = None) -> DataFrame:
    """The episodes of a dataset in canonical form (episode, frame_index, t, state, action); only the columns needed are read."""
    return quality.episode_frames(read_episodes(spark, root, ["episode_index", "frame_index", "observation.state", "action"], episodes), config)


def run_quality(frames: DataFrame, path: str, config: quality.QualityConfig = quality.QualityConfig(), overwrite: bool = False) -> DataFrame:
    """Writes what ``config.output_mode`` asks for under ``path``: reports (report, both), frames with their validity mask
    (filter, both).  Returns the episode results."""
    masks, _ = materialise(quality.keep_masks(frames, config), "quality-masks")
    results, _ = materialise(quality.episode_results(masks, config), "quality-results")
    if config.output_mode in ("report", "both"):
        export.write_report(quality.quality_report(results), results, f"{path}/reports", overwrite)
    if config.output_mode in ("filter", "both"):
        export.write_dataset(export.with_validity_mask(frames, masks), f"{path}/data_filtered", overwrite=overwrite)
    return results


def frame_agreement(frames: DataFrame, config: episode_filter.FilterConfig = episode_filter.FilterConfig()) -> DataFrame:
    """(episode, score) of the episode filter's stage 2 over the configured dimensions."""
    state = F.col(f"`{config.state_key or 'observation.state'}`")
    pick = lambda v, dims: v if dims is None else F.array(*[F.get(v, F.lit(d)) for d in dims])
    rows = frames.where("episode_index is not null and frame_index is not null").select(F.col("episode_index").alias("episode"), "frame_index", pick(state, config.state_dims).alias("s"), pick(F.col(f"`{config.action_key}`"), config.action_dims).alias("a"))
    rows = rows.where("s is not null and a is not null").dropDuplicates(["episode", "frame_index"])
    axis = Axis(("episode", "channel"), ("frame_index",))
    long = rows.select("episode", "frame_index", F.posexplode(F.arrays_zip("s", "a")).alias("channel", "v")).select("episode", "frame_index", "channel", F.col("v.s").cast("double").alias("state"), F.col("v.a").cast("double").alias("action"))
    return alignment.pooled_agreement(alignment.differences(long, axis, "state", "action", smooth=False), axis, ["episode"], config.max_lag)


def run_filter(frames: DataFrame, tasks: DataFrame, path: str, config: episode_filter.FilterConfig = episode_filter.FilterConfig(), fps: float = 30.0, overwrite: bool = False) -> DataFrame:
    """Writes the kept episodes, renumbered, with their metadata and the reports (decisions, and the first 200 flagged frames
    of each episode) under ``path``; returns the decisions."""
    judged, _ = materialise(episode_filter.judged_frames(frames, config), "judged-frames")
    agreement = frame_agreement(frames, config) if config.stage2 else None
    decisions, _ = materialise(episode_filter.episode_decisions(judged, config, agreement), "episode-decisions")
    kept, episodes, new_tasks = export.filtered_dataset(frames.dropDuplicates(["episode_index", "frame_index"]), decisions, tasks, fps)
    mode = "overwrite" if overwrite else "errorifexists"
    export.write_dataset(kept, path, episodes, overwrite)
    new_tasks.write.mode(mode).json(f"{path}/meta/tasks")
    decisions.write.mode(mode).json(f"{path}/reports/episode_decisions")
    episode_filter.flagged_frames(judged).write.mode(mode).json(f"{path}/reports/flagged_frames")
    return decisions


def device_seconds(frame: Column, stamp: Column, fps: Column, order) -> Column:
    """Seconds since the episode's first frame: by the device's clock in nanoseconds where there is one, else frame / fps."""
    first = F.first(stamp, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    return F.coalesce((stamp - first) / F.lit(1e9), frame / fps).cast("float")
