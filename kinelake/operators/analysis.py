"""Analysis of the quality pipeline's verdicts: exceedances per frame, what truncates an episode, flags per dimension.

Everything is an aggregation over the masks of :func:`kinelake.operators.quality.keep_masks` and the thresholds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinelake.operators import quality

METRICS = ("residual", "accel", "jerk")


def frame_flags(masks: DataFrame, thresholds: list, config: quality.QualityConfig = quality.QualityConfig()) -> DataFrame:
    """Adds per frame ``r_over``, ``a_over``, ``j_over`` and ``sudden``: some channel past its start-up exceeds the threshold
    of residual, acceleration, jerk, or of residual and one of the others."""
    inf = float("inf")
    by = {m: [r for r in thresholds if r["metric"] == m] for m in METRICS}
    start = quality._startup(config, config.grace_frames)
    rows = masks.withColumn("_s", F.concat(start, start))
    over = {m: F.zip_with(F.zip_with(F.col(m), quality._literal(by[m], "threshold", inf), lambda x, t: ~F.isnan(x) & (x > t)), F.col("_s"), lambda f, s: f & ~s & (F.col("n") >= config.savgol_window)) for m in METRICS}
    rows = rows.withColumns({f"_{m}": v for m, v in over.items()})
    both = F.zip_with(F.col("_residual"), F.zip_with(F.col("_accel"), F.col("_jerk"), lambda a, b: a | b), lambda r, e: r & e)
    some = lambda c: F.exists(c, lambda v: v)
    return rows.withColumns({"r_over": some(F.col("_residual")), "a_over": some(F.col("_accel")), "j_over": some(F.col("_jerk")), "sudden": some(both)}).drop("_s", "_residual", "_accel", "_jerk")


def component(a: Column, j: Column) -> Column:
    """Which of acceleration and jerk is exceeded."""
    return F.when(a & j, "both_accel_jerk").when(a, "accel").when(j, "jerk").otherwise("residual_only")


def exceed_counters(flags: DataFrame) -> DataFrame:
    """(counter, n): frames per exceedance, and the sudden ones by component."""
    part = component(F.col("a_over"), F.col("j_over"))
    tests = {"residual_exceed": F.col("r_over"), "accel_exceed": F.col("a_over"), "jerk_exceed": F.col("j_over"), "sudden_combined": F.col("sudden")} | {f"sudden_{n}": F.col("sudden") & (part == c) for n, c in (("both", "both_accel_jerk"), ("accel", "accel"), ("jerk", "jerk"))}
    one = flags.agg(*[F.coalesce(F.sum(t.cast("long")), F.lit(0)).alias(n) for n, t in tests.items()])
    return one.select(F.explode(F.array(*[F.struct(F.lit(n).alias("counter"), F.col(n).alias("n")) for n in tests])).alias("c")).select("c.*")


def truncation_causes(flags: DataFrame) -> DataFrame:
    """(cause, n_episodes): what the first bad frame of each truncated episode is: hard_limit, accel, jerk, both_accel_jerk,
    residual_only, stage3 or stage1_and_stage3."""
    cause = F.when(F.col("s1_hard"), "hard_limit").when(F.col("s1_bad") & ~F.col("s3_bad"), component(F.col("a_over"), F.col("j_over"))).when(F.col("s3_bad") & ~F.col("s1_bad"), "stage3").otherwise("stage1_and_stage3")
    bad = flags.where(F.col("s1_bad") | F.col("s3_bad")).withColumn("_cause", cause)
    return bad.groupBy("episode").agg(F.min_by("_cause", "t").alias("cause")).groupBy("cause").agg(F.count("*").alias("n_episodes"))


def position_counts(flags: DataFrame, flag: str) -> DataFrame:
    """(bin, n): where in the episode the flagged frames lie, in percent."""
    at = F.least(F.floor(F.col("t") / F.greatest(F.col("n") - 1, F.lit(1)) * 100), F.lit(99)).cast("long")
    return flags.where(flag).groupBy(at.alias("bin")).agg(F.count("*").alias("n"))


def dimension_flags(masks: DataFrame) -> DataFrame:
    """(channel, n): frames that stage 1 flags, per channel (state, then action)."""
    return masks.select(F.posexplode("s1_flags").alias("channel", "f")).where("f").groupBy(F.col("channel").cast("long").alias("channel")).agg(F.count("*").alias("n"))


def flagged_dimensions(masks: DataFrame, most: int = 6) -> DataFrame:
    """(episode, channel, n): the ``most`` channels of each episode that are flagged most often, the lower channel first among
    equals."""
    n = masks.select("episode", F.posexplode("s1_flags").alias("channel", "f")).where("f").groupBy("episode", F.col("channel").cast("long").alias("channel")).agg(F.count("*").alias("n"))
    i = F.row_number().over(Window.partitionBy("episode").orderBy(F.desc("n"), "channel"))
    return n.withColumn("_i", i).where(F.col("_i") <= most).drop("_i")


def totals(results: DataFrame) -> DataFrame:
    """One row: episodes, discarded ones, frames, and kept frames of the episodes that are not discarded."""
    kept = F.coalesce(F.sum(F.when(~F.col("discard"), F.col("kept_frames"))), F.lit(0))
    return results.agg(F.count("*").alias("processed"), F.coalesce(F.sum(F.col("discard").cast("long")), F.lit(0)).alias("discarded"), kept.alias("kept_frames"), F.coalesce(F.sum("num_frames"), F.lit(0)).alias("total_frames"))
