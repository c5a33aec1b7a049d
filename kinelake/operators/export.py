"""Writing episode datasets: filtered tables, exports with renumbered frames, meta files, and the check afterwards."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kinelake.sources.tables import chunk_of


def with_validity_mask(frames: DataFrame, masks: DataFrame) -> DataFrame:
    """Frames with ``step_validity_mask`` (a list of one byte, 1 = keep; a column of that name is replaced).  Rows are
    not removed; a frame without verdict is kept."""
    m = masks.select(F.col("episode").alias("_e"), F.col("frame_index").alias("_f"), F.col("keep").alias("_k"))
    out = frames.drop("step_validity_mask").join(m, (F.col("episode_index") == F.col("_e")) & (F.col("frame_index") == F.col("_f")), "left")
    return out.withColumn("step_validity_mask", F.array(F.coalesce("_k", F.lit(1)).cast("byte"))).drop("_e", "_f", "_k")


def exported_frames(frames: DataFrame, fps: float = 30.0, renumber_episodes: bool = False) -> DataFrame:
    """Kept frames (by ``step_validity_mask``, where there is one) with a new ``frame_index`` 0..n-1, ``timestamp`` =
    frame / fps and contiguous global ``index``.  Episodes keep their numbers or become 0..k-1; one without kept frames
    disappears.  Only ranges of episodes are ordered globally."""
    rows = frames.where("step_validity_mask[0] <> 0") if "step_validity_mask" in frames.columns else frames
    i = (F.row_number().over(Window.partitionBy("episode_index").orderBy("frame_index")) - 1).cast("long")
    rows = rows.withColumn("frame_index", i)
    n = rows.groupBy("episode_index").agg(F.count("*").alias("_n"), F.lit(1).cast("long").alias("_one"))
    rows = rows.join(running_start(n, "episode_index", "_n", "_start"), "episode_index").join(running_start(n, "episode_index", "_one", "_new"), "episode_index")
    rows = rows.withColumn("index", F.col("_start") + F.col("frame_index")).withColumn("timestamp", (F.col("frame_index") / F.lit(fps)).cast("float"))
    return (rows.withColumn("episode_index", F.col("_new")) if renumber_episodes else rows).drop("_start", "_new")


def first_appearance_index(rows: DataFrame, value: str, order: list[str], name: str) -> DataFrame:
    """(value, name): distinct values numbered from 0 by where they first appear.  Null is no value."""
    first = rows.where(F.col(value).isNotNull()).groupBy(value).agg(F.min(F.struct(*order)).alias("_o"))
    return first.withColumn(name, (F.row_number().over(Window.orderBy("_o", value)) - 1).cast("long")).drop("_o")


def kept_episodes(episodes: DataFrame, decisions: DataFrame) -> DataFrame:
    return episodes.join(decisions.where("keep_episode").select(F.col("episode").alias("episode_index")), "episode_index", "left_semi")


def episode_meta(frames: DataFrame, episodes: DataFrame) -> DataFrame:
    """(episode_index, length, tasks): from the frames, with the task of the episode table; without one the list is empty."""
    n = frames.groupBy("episode_index").agg(F.count("*").alias("length"))
    names = episodes.groupBy("episode_index").agg(F.sort_array(F.collect_set("task_name")).alias("tasks"))
    return n.join(names, "episode_index", "left").withColumn("tasks", F.coalesce("tasks", F.array().cast("array<string>")))


def write_dataset(frames: DataFrame, path: str, meta: DataFrame | None = None, overwrite: bool = False) -> None:
    """Parquet partitioned by chunk (snappy) under ``path/data`` and, if given, JSON lines under ``path/meta/episodes``;
    an existing target is an error unless ``overwrite``."""
    mode = "overwrite" if overwrite else "errorifexists"
    frames.withColumn("chunk", chunk_of(F.col("episode_index"))).repartition("chunk", F.floor(F.col("episode_index") / 50)).sortWithinPartitions("episode_index", "frame_index").write.mode(mode).partitionBy("chunk").option("compression", "snappy").parquet(f"{path}/data")
    if meta is not None:
        meta.write.mode(mode).json(f"{path}/meta/episodes")


def verify_alignment(frames: DataFrame, episodes: DataFrame, fps: float = 30.0, tolerance: float = 1e-4, total_frames: int | None = None, total_episodes: int | None = None, videos: DataFrame | None = None) -> DataFrame:
    """(episode_index, issue): missing_frames (an episode of the list without any), length, frame_index (not 0..n-1),
    global_index (``index`` not counting on over the episodes), timestamp (off frame / fps), duplicate_frame, and, where the
    totals are given, total_frames and total_episodes under episode -1.  With ``videos`` (episode_index, video_key,
    n_frames) also missing_video and video_frames per key.  Null values are not compared."""
    has_index = "index" in frames.columns
    start = F.min(F.col("index") - F.col("frame_index")) if has_index else F.lit(None).cast("long")
    end = F.max(F.col("index") - F.col("frame_index")) if has_index else F.lit(None).cast("long")
    f = frames.groupBy("episode_index").agg(
        F.count("*").alias("n"), F.countDistinct("frame_index").alias("d"), F.min("frame_index").alias("lo"), F.max("frame_index").alias("hi"), start.alias("i0"), end.alias("i1"),
        F.max(F.coalesce((F.abs(F.col("timestamp").cast("double") - F.col("frame_index") / F.lit(fps)) > tolerance).cast("int"), F.lit(0))).alias("t"),
    )
    e = episodes.where("episode_index is not null").groupBy("episode_index").agg(F.max("length").alias("length"))
    listed = f.join(e.select("episode_index"), "episode_index", "left_semi")
    j = e.join(running_start(listed, "episode_index", "n", "expected"), "episode_index", "left").join(f, "episode_index", "full")
    issue = lambda test, name: F.when(F.coalesce(test, F.lit(False)), name)
    every = F.array_compact(F.array(issue(F.col("n").isNull(), "missing_frames"), issue(F.col("length") != F.col("n"), "length"), issue((F.col("lo") != 0) | (F.col("hi") - F.col("lo") + 1 != F.col("d")), "frame_index"), issue((F.col("i0") != F.col("expected")) | (F.col("i1") != F.col("expected")), "global_index"), issue(F.col("t") == 1, "timestamp"), issue(F.col("d") < F.col("n"), "duplicate_frame")))
    out = j.select("episode_index", F.explode(every).alias("issue"))
    for name, want, got in (("total_frames", total_frames, f.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("k"))), ("total_episodes", total_episodes, e.agg(F.count("*").alias("k")))):
        if want is not None:
            out = out.unionByName(got.where(F.col("k") != want).select(F.lit(-1).cast("long").alias("episode_index"), F.lit(name).alias("issue")))
    if videos is not None:
        keys = videos.select("video_key").distinct()
        due = f.select("episode_index", "n").join(F.broadcast(keys)) if keys.count() <= 100 else f.select("episode_index", "n").join(keys)
        seen = due.join(videos, ["episode_index", "video_key"], "left")
        out = out.unionByName(seen.where("n_frames is null").select("episode_index", F.concat(F.lit("missing_video "), "video_key").alias("issue"))).unionByName(seen.where("n_frames <> n").select("episode_index", F.concat(F.lit("video_frames "), "video_key").alias("issue")))
    return out


def running_start(counts: DataFrame, key: str, n: str, name: str, width: int = 50_000) -> DataFrame:
    """(key, name): the sum of ``n`` over all smaller keys.

    Keys are cut into ranges of ``width``; ranges are summed on their own and only the table of ranges (a ``width``-th of
    the keys) is ordered in one task."""
    ranged = counts.select(key, n).withColumn("_range", F.floor(F.col(key) / width))
    inside = F.coalesce(F.sum(n).over(Window.partitionBy("_range").orderBy(key).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    before = F.coalesce(F.sum("_sum").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranged.groupBy("_range").agg(F.sum(n).alias("_sum")).select("_range", before.alias("_before"))
    return ranged.withColumn("_inside", inside).join(ranges, "_range").select(key, (F.col("_before") + F.col("_inside")).alias(name))


def write_report(report: DataFrame, results: DataFrame, path: str, overwrite: bool = False) -> None:
    """The report as one JSON line, the episode results as JSON lines."""
    mode = "overwrite" if overwrite else "errorifexists"
    report.coalesce(1).write.mode(mode).json(f"{path}/quality_report")
    results.write.mode(mode).json(f"{path}/exclusion_log")


def write_csv(rows: DataFrame, path: str, overwrite: bool = False) -> None:
    """Rows with a header line, for tables of statistics, thresholds and differences."""
    rows.write.mode("overwrite" if overwrite else "errorifexists").csv(path, header=True)


def action_from_state(frames: DataFrame) -> DataFrame:
    """``frames`` with ``action`` replaced by the state, as 4-byte floats; all other columns as they are."""
    return frames.withColumn("action", F.col("`observation.state`").cast("array<float>"))


def aligned_poses(aligned: DataFrame, frame_name: str, correction: list[float]) -> DataFrame:
    """What the aligned-pose files hold: state and action as 4-byte floats with the frame's name and the correction."""
    four = lambda c: F.col(c).cast("array<float>")
    return aligned.select("episode", "frame_index", four("aligned").alias("state"), four("aligned_action").alias("action"), F.lit(frame_name).alias("reference_frame"), F.array(*[F.lit(float(c)) for c in correction]).alias("rotation_correction"))


def save_stats(stats: DataFrame, path: str) -> None:
    """A cache of statistics per channel, replacing an older one."""
    stats.write.mode("overwrite").parquet(path)


def load_stats(spark: SparkSession, path: str, channels: int, columns: list[str]) -> DataFrame | None:
    """A cache of statistics, or None where there is none or it has another number of channels or lacks a column: then it
    must be computed again."""
    from pyspark.errors import AnalysisException

    try:
        stats = spark.read.parquet(path)
    except AnalysisException:
        return None
    if not set(columns) <= set(stats.columns) or stats.select("channel").distinct().count() != channels:
        return None
    return stats


def filtered_dataset(frames: DataFrame, decisions: DataFrame, tasks: DataFrame, fps: float = 30.0) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(frames, episodes, tasks) of the kept episodes: episodes renumbered 0..K-1, frames and global index counted on,
    tasks renumbered by first appearance.  A frame whose task is unknown keeps a null task."""
    kept = kept_episodes(frames, decisions)
    names = tasks.where("task_index is not null").groupBy("task_index").agg(F.first("task_name").alias("task"))
    out = exported_frames(kept.join(names, "task_index", "left").drop("task_index"), fps, renumber_episodes=True)
    new = first_appearance_index(out, "task", ["episode_index", "frame_index"], "task_index")
    out = out.join(new, "task", "left")
    episodes = out.groupBy("episode_index").agg(F.count("*").alias("length"), F.sort_array(F.collect_set("task")).alias("tasks"))
    return out.drop("task"), episodes, new


def segments(frames: DataFrame, valid: Column, max_invalid: float, shorter: int) -> DataFrame:
    """(episode, segment, frame_index, new_frame): runs of consecutive valid frames as episodes of their own, without
    episodes whose share of invalid frames exceeds ``max_invalid`` and without runs of at most ``shorter`` frames."""
    rows = frames.select("episode", "frame_index", F.coalesce(valid, F.lit(False)).alias("ok"))
    share = F.avg((~F.col("ok")).cast("double")).over(Window.partitionBy("episode"))
    rows = rows.withColumn("_share", share).where(F.col("_share") <= max_invalid).where("ok")
    w = Window.partitionBy("episode").orderBy("frame_index")
    rows = rows.withColumn("_run", F.col("frame_index") - F.row_number().over(w))
    run = Window.partitionBy("episode", "_run")
    rows = rows.withColumn("_n", F.count("*").over(run)).where(F.col("_n") > shorter)
    rows = rows.withColumn("segment", (F.dense_rank().over(Window.partitionBy("episode").orderBy("_run")) - 1).cast("long"))
    return rows.withColumn("new_frame", (F.row_number().over(run.orderBy("frame_index")) - 1).cast("long")).select("episode", "segment", "frame_index", "new_frame")


def first_episodes(frames: DataFrame, n: int, key: str = "episode_index") -> DataFrame:
    """The frames of the ``n`` episodes with the lowest numbers (the command line's limit)."""
    few = frames.select(key).where(F.col(key).isNotNull()).distinct().orderBy(key).limit(n)
    return frames.join(few, key, "left_semi")


def strided(frames: DataFrame, most: int) -> DataFrame:
    """At most ``most`` frames of each episode, evenly spaced: every ceil(n / most)-th."""
    w = Window.partitionBy("episode")
    rows = frames.withColumn("_n", F.count("*").over(w)).withColumn("_t", F.row_number().over(w.orderBy("frame_index")) - 1)
    return rows.where(F.col("_t") % F.greatest(F.lit(1), F.ceil(F.col("_n") / most)) == 0).drop("_n", "_t")


def array_issues(frames: DataFrame, widths: dict[str, int]) -> DataFrame:
    """(column, issue, n): required columns that are missing, and rows whose array is null or has another width."""
    spark = frames.sparkSession
    missing = [(c, "missing", 1) for c in widths if c not in frames.columns]
    out = spark.createDataFrame(missing, "column string, issue string, n long")
    for c, width in widths.items():
        if c in frames.columns:
            kind = F.when(F.col(f"`{c}`").isNull(), "null").when(F.size(F.col(f"`{c}`")) != width, "width")
            out = out.unionByName(frames.select(kind.alias("issue")).where("issue is not null").groupBy("issue").agg(F.count("*").alias("n")).select(F.lit(c).alias("column"), "issue", "n"))
    return out
