"""Registered queries over the event episodes: an episode is a user, a frame an event in order of time.

Channels: 0 is the event's value, 1 the number in its properties.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kinelake.functions import timeseries as ts
from kinelake.functions.timeseries import Axis
from kinelake.operators import alignment, export, statistics
from kinelake.session import materialise
from kinelake.sources import read_table

ONE = Axis(("episode",), ("frame",))
MANY = Axis(("episode", "channel"), ("frame",))
ALPHA = 0.35


def episodes(spark: SparkSession, root: str) -> DataFrame:
    """(episode, frame, value, k, event_type, ts)."""
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    k = F.regexp_extract("props", '"k": *([0-9]+)', 1).cast("double")
    return read_table(spark, root, "events").select(F.col("user_id").alias("episode"), (F.row_number().over(w) - 1).cast("long").alias("frame"), "value", k.alias("k"), "event_type", "ts")


def series(spark: SparkSession, root: str) -> DataFrame:
    """(episode, frame, channel, x)."""
    return episodes(spark, root).select("episode", "frame", F.posexplode(F.array("value", "k")).alias("channel", "x")).withColumn("channel", F.col("channel").cast("long"))


EV = """ev AS (SELECT user_id AS episode, CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) - 1 AS BIGINT) AS frame, value,
          CAST(regexp_extract(props, '"k": *([0-9]+)', 1) AS DOUBLE) AS k, event_type, ts FROM events)"""
SE = EV + """, se AS (SELECT episode, frame, CAST(0 AS BIGINT) AS channel, value AS x FROM ev UNION ALL SELECT episode, frame, CAST(1 AS BIGINT), k FROM ev)"""
W = "WINDOW w AS (PARTITION BY episode, channel ORDER BY frame), f AS (PARTITION BY episode, channel ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
WE = W.replace("episode, channel", "episode")


def sql_at(column: str, k: int) -> str:
    """Value k rows on with replicated edges."""
    if k == 0:
        return column
    return f"coalesce({'lead' if k > 0 else 'lag'}({column}, {abs(k)}) OVER w, {'last' if k > 0 else 'first'}_value({column}) OVER f)"


def sql_fir(column: str, taps) -> str:
    return "(" + " + ".join(f"{t} * {sql_at(column, k - len(taps) // 2)}" for k, t in enumerate(taps)) + ")"


SG = [-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36]
MED5 = "list_sort([" + ", ".join(sql_at("x", k) for k in range(-2, 3)) + "])[3]"
#: median, trend, gradient chain and the three stage-1 metrics, step by step.
FEATURES = f"""{SE}, m5 AS (SELECT *, {MED5} AS m, count(*) OVER (PARTITION BY episode, channel) AS n FROM se {W}),
        tr AS (SELECT *, CASE WHEN n >= 11 THEN {sql_fir('m', SG)} / 429 ELSE m END AS trend FROM m5 {W}),
        g1 AS (SELECT *, CASE WHEN frame = 0 THEN lead(x) OVER w - x WHEN frame = n - 1 THEN x - lag(x) OVER w ELSE (lead(x) OVER w - lag(x) OVER w) / 2 END AS g FROM tr {W}),
        g2 AS (SELECT *, CASE WHEN frame = 0 THEN lead(g) OVER w - g WHEN frame = n - 1 THEN g - lag(g) OVER w ELSE (lead(g) OVER w - lag(g) OVER w) / 2 END AS accel FROM g1 {W}),
        ft AS (SELECT *, CASE WHEN frame = 0 THEN lead(accel) OVER w - accel WHEN frame = n - 1 THEN accel - lag(accel) OVER w ELSE (lead(accel) OVER w - lag(accel) OVER w) / 2 END AS jerk, abs(x - trend) AS residual FROM g2 {W})"""


def features(spark, root) -> DataFrame:
    """Stage-1 features: trend, residual, accel, jerk."""
    df = ts.accel_jerk(ts.trend(series(spark, root), MANY, "x", "trend"), MANY, "x")
    return df.withColumn("residual", F.abs(F.col("x") - F.col("trend"))).withColumn("n", MANY.length())


def _rounded(df: DataFrame, *names: str, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if c in names else F.col(c) for c in df.columns])


# Global percentile band, prefix truncation -----------------------------------


def _banded(spark, root) -> DataFrame:
    s = series(spark, root)
    bounds = statistics.percentile_bounds(s, "channel", "x", 0.01, 0.99, ALPHA)
    return s.join(bounds.select("channel", "lower", "upper"), "channel").withColumn("bad", (F.col("x") < F.col("lower")) | (F.col("x") > F.col("upper")))


def s3_band_prefix(spark, root):
    """Per episode: frames, frames outside the band, frames kept before the first of them (-1: none)."""
    frames = _banded(spark, root).groupBy("episode", "frame").agg(F.max("bad").alias("bad"))
    kept = ts.prefix_keep(frames, ONE, "bad")
    return kept.groupBy("episode").agg(F.count("*").alias("n_frames"), F.sum(F.col("bad").cast("long")).alias("n_bad"), F.sum(F.col("keep").cast("long")).alias("n_kept"), F.coalesce(F.min(F.when(F.col("bad"), F.col("frame"))), F.lit(-1)).alias("first_bad"))


BAND = f"""{SE}, bo AS (SELECT channel, quantile_cont(x, 0.01) AS q1, quantile_cont(x, 0.99) AS q9 FROM se GROUP BY channel),
        ba AS (SELECT se.*, x < q1 - {ALPHA} * (q9 - q1) OR x > q9 + {ALPHA} * (q9 - q1) AS bad FROM se JOIN bo USING (channel)),
        fb AS (SELECT episode, frame, bool_or(bad) AS bad FROM ba GROUP BY ALL),
        pk AS (SELECT *, CASE WHEN bool_or(bad) OVER (PARTITION BY episode ORDER BY frame) THEN 0 ELSE 1 END AS keep FROM fb)"""


def s3_band_dims(spark, root):
    """Values outside the band per channel."""
    return _banded(spark, root).groupBy("channel").agg(F.count("*").alias("n_values"), F.sum(F.col("bad").cast("long")).alias("n_bad"), F.round(F.first("lower"), 6).alias("lower"), F.round(F.first("upper"), 6).alias("upper"))


def prefix_mask(spark, root):
    frames = _banded(spark, root).groupBy("episode", "frame").agg(F.max("bad").alias("bad"))
    return ts.prefix_keep(frames, ONE, "bad").select("episode", "frame", F.col("keep").cast("long").alias("keep"))


def violation_scores(spark, root):
    """Per frame outside the band: the greatest relative distance beyond a bound, over channels."""
    b = _banded(spark, root)
    width = F.greatest(F.col("upper") - F.col("lower"), F.lit(1e-12))
    score = F.greatest(F.col("lower") - F.col("x"), F.col("x") - F.col("upper"), F.lit(0.0)) / width
    return b.groupBy("episode", "frame").agg(F.round(F.max(score), 6).alias("score")).where("score > 0")


# Histogram statistics and thresholds ------------------------------------------


def hist_quantiles(spark, root):
    s = series(spark, root)
    ranges = statistics.value_ranges(s, ["channel"], "x").collect()  # one row per channel
    q = statistics.histogram_quantiles(statistics.histogram(s, ranges, ["channel"], "x"), ["channel"], {"q01": 0.01, "q99": 0.99})
    return _rounded(q.join(spark.createDataFrame([tuple(r) for r in ranges], "channel long, lo double, hi double, n long"), "channel").select("channel", "q01", "q99", F.col("lo").alias("vmin"), F.col("hi").alias("vmax"), F.col("n").alias("num_values")), "q01", "q99")


def _metrics(spark, root):
    f = features(spark, root).where("n >= 11")
    each = F.array(*[F.struct(F.lit(m).alias("metric"), F.abs(m).alias("v")) for m in ("residual", "accel", "jerk")])
    return f.select("episode", "frame", "channel", F.explode(each).alias("e")).select("episode", "frame", "channel", "e.metric", "e.v")


def _global_thresholds(metrics):
    ranges = statistics.value_ranges(metrics, ["channel", "metric"], "v")
    counts = statistics.histogram(metrics, ranges, ["channel", "metric"], "v", flat=1e-12)
    return statistics.hybrid_thresholds(counts, ["channel", "metric"], 8.0, 99.9)


def thr_global_hybrid(spark, root):
    return _rounded(_global_thresholds(_metrics(spark, root)), "scale", "floor", "threshold", digits=5)


METRICS = f"""{FEATURES}, me AS (SELECT episode, frame, channel, 'residual' AS metric, abs(residual) AS v FROM ft WHERE n >= 11
          UNION ALL SELECT episode, frame, channel, 'accel', abs(accel) FROM ft WHERE n >= 11 UNION ALL SELECT episode, frame, channel, 'jerk', abs(jerk) FROM ft WHERE n >= 11)"""
GLOBAL = f"""{METRICS}, ra AS (SELECT channel, metric, min(v) AS lo, greatest(max(v) - min(v), 1e-12) AS span FROM me GROUP BY ALL),
        hi AS (SELECT channel, metric, greatest(0, least(65535, floor((v - lo) / span * 65535))) AS bin, count(*) AS c, lo, span FROM me JOIN ra USING (channel, metric) GROUP BY ALL),
        hv AS (SELECT *, lo + bin / 65535 * span AS v, sum(c) OVER (PARTITION BY channel, metric ORDER BY bin) AS upto, sum(c) OVER (PARTITION BY channel, metric) AS total FROM hi),
        mn AS (SELECT channel, metric, sum(v * c) / sum(c) AS mean FROM hv GROUP BY ALL),
        sc AS (SELECT channel, metric, greatest(sum(abs(v - mean) * c) / sum(c), 0.01 * sqrt(sum((v - mean) * (v - mean) * c) / sum(c)), 1e-12) AS scale,
                 min(CASE WHEN upto >= CAST(99.9 AS DOUBLE) / 100 * total THEN v END) AS "floor" FROM hv JOIN mn USING (channel, metric) GROUP BY ALL),
        th AS (SELECT channel, metric, scale, "floor", greatest(8 * scale, "floor", 1e-12) AS threshold FROM sc)"""


def sudden_global(spark, root):
    """Frames whose residual and whose accel or jerk exceed the global thresholds."""
    t = _global_thresholds(_metrics(spark, root)).groupBy("channel").pivot("metric", ["residual", "accel", "jerk"]).agg(F.first("threshold"))
    f = features(spark, root).join(t.select("channel", F.col("residual").alias("tr"), F.col("accel").alias("ta"), F.col("jerk").alias("tj")), "channel", "left")
    hit = (F.col("n") >= 11) & (F.col("residual") > F.col("tr")) & ((F.abs("accel") > F.col("ta")) | (F.abs("jerk") > F.col("tj")))
    return f.where(hit).select("episode", "frame", "channel")


def thr_episode_hybrid(spark, root):
    f = features(spark, root).where("n >= 11")
    return _rounded(statistics.episode_thresholds(f, ["episode", "channel"], "residual", 8.0, 99.9), "threshold", digits=5)


def sudden_episode_mean(spark, root):
    """The episode filter's rule: residual to a moving average above five times its episode mean."""
    s = ts.moving_average(ts.median_filter(series(spark, root), MANY, "x", "m", shrink=True), MANY, "m", "trend")
    s = s.withColumn("residual", F.round(F.abs(F.col("x") - F.col("trend")), 9))
    limit = F.greatest(F.round(F.avg("residual").over(MANY.whole) * 5.0, 9), F.lit(1e-6))
    return s.withColumn("limit", limit).where("residual > limit").select("episode", "frame", "channel", F.round("residual", 6).alias("residual"))


# Filters -----------------------------------------------------------------------


def median5(spark, root):
    return ts.median_filter(series(spark, root), MANY, "x", "m").select("episode", "frame", "channel", F.round("m", 6).alias("m"))


def savgol11(spark, root):
    return ts.trend(series(spark, root), MANY, "x", "trend").select("episode", "frame", "channel", F.round("trend", 6).alias("trend"))


def moving_avg11(spark, root):
    s = ts.moving_average(ts.median_filter(series(spark, root), MANY, "x", "m", shrink=True), MANY, "m", "a")
    return s.select("episode", "frame", "channel", F.round("a", 6).alias("a"))


def gradient_accel_jerk(spark, root):
    return ts.accel_jerk(series(spark, root), MANY, "x").select("episode", "frame", "channel", F.round("accel", 6).alias("accel"), F.round("jerk", 6).alias("jerk"))


def ndiff_padded(spark, root):
    s = ts.padded_difference(ts.padded_difference(series(spark, root), MANY, "x", "d2", 2), MANY, "x", "d3", 3)
    return s.select("episode", "frame", "channel", F.round("d2", 6).alias("d2"), F.round("d3", 6).alias("d3"))


def plain_diffs(spark, root):
    s = ts.plain_difference(ts.plain_difference(series(spark, root), MANY, "x", "accel", 2), MANY, "x", "jerk", 3)
    return s.where("accel is not null").select("episode", "frame", "channel", F.round("accel", 6).alias("accel"), F.round("jerk", 6).alias("jerk"))


def residual_features(spark, root):
    return features(spark, root).where("n >= 11").select("episode", "frame", "channel", *[F.round(F.abs(c), 6).alias(c) for c in ("residual", "accel", "jerk")])


# Masks and runs ------------------------------------------------------------------


def startup_exclude(spark, root):
    """Frames before a channel first leaves 0 (here: exceeds 60)."""
    s = ts.startup(series(spark, root), MANY, F.abs("x") > 60.0)
    return s.groupBy("episode", "channel").agg(F.sum(F.col("startup").cast("long")).alias("n_startup"))


def startup_grace(spark, root):
    s = ts.startup(series(spark, root), MANY, F.abs("x") > 60.0, grace=7)
    return s.groupBy("episode", "channel").agg(F.sum(F.col("startup").cast("long")).alias("n_startup"))


def cluster_filter(spark, root):
    s = ts.keep_long_runs(series(spark, root).withColumn("flag", F.col("x") > 50.0), MANY, "flag", "kept", 3)
    return s.where("kept").select("episode", "frame", "channel")


def cluster_jump(spark, root):
    """Runs of at least three flagged frames with a jump of at least 10 inside."""
    s = ts.runs_of(series(spark, root).withColumn("flag", F.col("x") > 50.0), MANY, "flag").where("flag")
    inside = Window.partitionBy("episode", "channel", "run").orderBy("frame")
    s = s.withColumn("jump", F.abs(F.col("x") - F.lag("x").over(inside)))
    return s.groupBy("episode", "channel", "run").agg(F.min("frame").alias("run_start"), F.count("*").alias("run_length"), F.round(F.max("jump"), 6).alias("jump")).where("run_length >= 3 and jump >= 10").drop("run")


def longest_run(spark, root):
    s = ts.spans(series(spark, root).withColumn("flag", F.col("x") > 50.0), MANY, "flag")
    return s.groupBy("episode", "channel").agg(F.max("run_length").alias("longest"))


def mask_spans(spark, root):
    return ts.spans(series(spark, root).withColumn("flag", F.col("x") > 50.0), MANY, "flag")


RUNS = f"""{SE}, fl AS (SELECT *, x > 50 AS flag FROM se), rn AS (SELECT *, CASE WHEN flag = lag(flag) OVER w THEN 0 ELSE 1 END AS ch FROM fl {W}),
        ru AS (SELECT *, sum(ch) OVER (PARTITION BY episode, channel ORDER BY frame) AS run FROM rn),
        sp AS (SELECT episode, channel, run, min(frame) AS run_start, max(frame) AS run_end, count(*) AS run_length FROM ru WHERE flag GROUP BY ALL)"""


def renumber_frames(spark, root):
    """Purchases and clicks only, renumbered per episode, with a timestamp of frame / 30."""
    e = episodes(spark, root).where(F.col("event_type").isin("purchase", "click"))
    new = (F.row_number().over(ONE.rows) - 1).cast("long")
    return e.withColumn("new_frame", new).select("episode", "frame", "new_frame", F.round(F.col("new_frame") / 30.0, 6).alias("timestamp"))


def global_index(spark, root):
    """Contiguous index over all episodes: the episode table carries the running sum, frames only join it."""
    e = episodes(spark, root)
    n = e.groupBy("episode").agg(F.count("*").alias("n"))
    return e.join(export.running_start(n, "episode", "n", "start"), "episode").select("episode", "frame", (F.col("start") + F.col("frame")).alias("index"))


def segment_split(spark, root):
    """Every run of calm frames longer than four becomes an episode of its own, renumbered."""
    s = ts.runs_of(episodes(spark, root).withColumn("ok", F.col("value") < 40.0), ONE, "ok").where("ok")
    size = F.count("*").over(Window.partitionBy("episode", "run"))
    s = s.withColumn("size", size).where("size > 4")
    first = F.min("frame").over(Window.partitionBy("episode", "run"))
    segment = (F.dense_rank().over(Window.partitionBy("episode").orderBy("run")) - 1).cast("long")
    return s.withColumn("segment", segment).withColumn("new_frame", F.col("frame") - first).select("episode", "segment", "frame", "new_frame")


def timestamp_regrid(spark, root):
    """Times regridded from the first kept one by the distance of the first two (nanoseconds)."""
    e = episodes(spark, root).where("value < 40").withColumn("ns", F.expr("timestampdiff(MICROSECOND, timestamp_ntz'1970-01-01 00:00:00', ts)") * 1000).withColumn("i", ONE.position())
    first, second = F.first("ns").over(ONE.whole), F.nth_value("ns", 2).over(ONE.whole)
    return e.withColumn("grid", first + F.col("i") * F.coalesce(second - first, F.lit(33333333).cast("long"))).select("episode", "frame", "grid")


def forward_fill(spark, root):
    e = episodes(spark, root).withColumn("gap", F.when(F.col("k") < 50, F.col("value")))
    return ts.forward_fill(e, ONE, "gap", "filled").select("episode", "frame", F.round("filled", 6).alias("filled"))


def delta_integrate(spark, root):
    return ts.integrate(series(spark, root), MANY, "x", "total").select("episode", "frame", "channel", F.round("total", 6).alias("total"))


def flagged_cap(spark, root):
    """At most five flagged frames per episode and channel, the first ones.  The report's own limit of 200 per episode is
    in ``filter_flagged_cap``."""
    s = series(spark, root).where("x > 50")
    i = F.row_number().over(MANY.rows)
    return s.withColumn("i", i).where("i <= 5").select("episode", "channel", "frame")


# State and action alignment: the action is the value two events on ------------------


def _pairs(spark, root):
    return episodes(spark, root).withColumn("action", F.coalesce(F.lead("value", 2).over(ONE.rows), F.col("value"))).select("episode", "frame", F.col("value").alias("state"), "action")


def s2_best_lag(spark, root):
    return _rounded(alignment.best_lag(alignment.differences(_pairs(spark, root), ONE, "state", "action"), ONE), "corr")


def s2_direction_agreement(spark, root):
    d = alignment.differences(_pairs(spark, root), ONE, "state", "action")
    return _rounded(alignment.directional_agreement(d, alignment.best_lag(d, ONE), ONE), "score")


def s2_decision(spark, root):
    d = alignment.differences(_pairs(spark, root), ONE, "state", "action")
    s = alignment.directional_agreement(d, alignment.best_lag(d, ONE), ONE)
    return s.select("episode", (F.round("score", 6) < 0.65).alias("discard"))


def c_directional_agreement(spark, root):
    """The episode filter's agreement over its whole range of lags (up to 10)."""
    d = alignment.differences(_pairs(spark, root), ONE, "state", "action", smooth=False)
    return _rounded(alignment.pooled_agreement(d, ONE, ["episode"]), "score")


PAIRS = f"{EV}, pa AS (SELECT episode, frame, value AS state, coalesce(lead(value, 2) OVER (PARTITION BY episode ORDER BY frame), value) AS action FROM ev)"
_SM = f"{PAIRS}, ps AS (SELECT episode, frame, 0 AS channel, state AS x FROM pa UNION ALL SELECT episode, frame, 1, action FROM pa), pm AS (SELECT *, {MED5} AS m, count(*) OVER (PARTITION BY episode, channel) AS n FROM ps {W}), pt AS (SELECT *, CASE WHEN n >= 11 THEN {sql_fir('m', SG)} / 429 ELSE m END AS t FROM pm {W}), pd AS (SELECT episode, frame, channel, t - lag(t) OVER w AS d FROM pt {W}), df AS (SELECT a.episode, a.frame, a.d AS ds, b.d AS da FROM pd a JOIN pd b USING (episode, frame) WHERE a.channel = 0 AND b.channel = 1 AND a.d IS NOT NULL)"
_Z = f"{_SM}, zz AS (SELECT *, (ds - avg(ds) OVER p) / (stddev_pop(ds) OVER p + 1e-8) AS zs, (da - avg(da) OVER p) / (stddev_pop(da) OVER p + 1e-8) AS za FROM df WINDOW p AS (PARTITION BY episode)), lg AS (SELECT CAST(l AS BIGINT) AS lag FROM range(-5, 6) t(l)), nn AS (SELECT episode, count(*) AS n FROM df GROUP BY episode), co AS (SELECT a.episode, lg.lag, round(sum(a.zs * b.za) / any_value(n), 9) AS corr FROM zz a CROSS JOIN lg JOIN zz b ON b.episode = a.episode AND b.frame = a.frame - lg.lag JOIN nn ON nn.episode = a.episode GROUP BY ALL), bl AS (SELECT episode, any_value(n) AS n, CASE WHEN any_value(n) >= 15 THEN arg_max(lag, (corr, -lag)) ELSE 0 END AS lag, CASE WHEN any_value(n) >= 15 THEN max(corr) END AS corr FROM co JOIN nn USING (episode) GROUP BY episode), dx AS (SELECT a.episode, any_value(bl.lag) AS lag, CAST(count(*) FILTER (abs(a.ds) > 1e-4 AND abs(b.da) > 1e-4) AS BIGINT) AS n_active, avg(CASE WHEN sign(a.ds) = sign(b.da) THEN 1.0 ELSE 0.0 END) FILTER (abs(a.ds) > 1e-4 AND abs(b.da) > 1e-4) AS score FROM df a JOIN bl USING (episode) LEFT JOIN df b ON b.episode = a.episode AND b.frame = a.frame - bl.lag GROUP BY a.episode)"


# Reports -----------------------------------------------------------------------------


def feature_stats(spark, root):
    return _rounded(statistics.feature_stats(series(spark, root), ["episode", "channel"], "x"), "mean", "std")


def stats_of_stats(spark, root):
    return _rounded(statistics.stats_of_stats(statistics.feature_stats(series(spark, root), ["episode", "channel"], "x"), ["channel"]), "mean", "std")


def position_histogram(spark, root):
    """Where in the episode flagged values lie: 100 bins of the relative position."""
    s = series(spark, root).withColumn("n", MANY.length()).where("x > 50")
    at = F.least(F.floor(F.col("frame") / F.greatest(F.col("n") - 1, F.lit(1)) * 100), F.lit(99)).cast("long")
    return s.withColumn("bin", at).groupBy("channel", "bin").agg(F.count("*").alias("n_flagged"))


def first_abnormal_cause(spark, root):
    """Which channel is outside the band first, per episode, and how often over all."""
    b = _banded(spark, root).groupBy("episode", "frame").agg(F.max(F.when(F.col("bad") & (F.col("channel") == 0), 1).otherwise(0)).alias("a"), F.max(F.when(F.col("bad") & (F.col("channel") == 1), 1).otherwise(0)).alias("b")).where("a + b > 0")
    cause = F.when((F.col("a") == 1) & (F.col("b") == 1), "both").when(F.col("a") == 1, "value").otherwise("k")
    return b.groupBy("episode").agg(F.min_by(cause, F.col("frame")).alias("cause")).groupBy("cause").agg(F.count("*").alias("n_episodes"))


def exclusion_summary(spark, root):
    """Over all episodes: truncated ones, statistics of the kept ratio, frames lost."""
    e = s3_band_prefix(spark, root).withColumn("ratio", F.col("n_kept") / F.col("n_frames"))
    e, _ = materialise(e.withColumn("g", F.lit(0)), "kept-ratios")
    q = statistics.exact_quantiles(e, "g", "ratio", {"p10": 0.1, "p25": 0.25, "median": 0.5}).collect()  # one row
    p = lambda n: F.lit(q[0][n] if q else None).cast("double")
    return e.agg(F.count("*").alias("n_episodes"), F.sum((F.col("n_kept") < F.col("n_frames")).cast("long")).alias("n_truncated"), F.round(F.avg("ratio"), 6).alias("mean_ratio"), F.round(p("median"), 6).alias("median_ratio"), F.round(F.min("ratio"), 6).alias("min_ratio"), F.round(p("p10"), 6).alias("p10_ratio"), F.round(p("p25"), 6).alias("p25_ratio"), F.sum(F.col("n_frames") - F.col("n_kept")).alias("frames_lost"))


def distribution_histogram(spark, root):
    """Residuals in 40 bins between their 0.5 and 99.5 percentiles, per channel."""
    f, _ = materialise(features(spark, root).where("n >= 11").select("channel", F.round("residual", 9).alias("residual")), "residuals")
    q = statistics.exact_quantiles(f, "channel", "residual", {"lo": 0.005, "hi": 0.995}).select("channel", F.round("lo", 9).alias("lo"), F.round("hi", 9).alias("hi"))
    at = F.least(F.floor((F.col("residual") - F.col("lo")) / F.greatest(F.col("hi") - F.col("lo"), F.lit(1e-12)) * 40), F.lit(39)).cast("long")
    return f.join(q, "channel").where("residual between lo and hi").withColumn("bin", at).groupBy("channel", "bin").agg(F.count("*").alias("n"))


def exceed_counts(spark, root):
    """How many values exceed each global threshold, per channel and metric."""
    m = _metrics(spark, root)
    return m.join(_global_thresholds(m).select("channel", "metric", "threshold"), ["channel", "metric"]).groupBy("channel", "metric").agg(F.sum((F.col("v") > F.col("threshold")).cast("long")).alias("n_exceed"), F.count("*").alias("n"))


def normalize_q01_q99(spark, root):
    s = series(spark, root)
    bounds = statistics.percentile_bounds(s, "channel", "x", 0.01, 0.99, 0.0)
    return statistics.normalised(s, bounds, ["channel"], "x").select("episode", "frame", "channel", F.round("normalised", 6).alias("normalised"))


def cut_list(spark, root):
    """Spans of kept frames, the cut list a video tool would take: start inclusive, end exclusive."""
    frames = _banded(spark, root).groupBy("episode", "frame").agg(F.max("bad").alias("bad"))
    s = ts.spans(frames.withColumn("ok", ~F.col("bad")), ONE, "ok")
    return s.select("episode", F.col("run_start").alias("cut_start"), (F.col("run_end") + 1).alias("cut_end"))


QUERIES = {f.__name__: f for f in (s3_band_prefix, s3_band_dims, prefix_mask, violation_scores, hist_quantiles, thr_global_hybrid, sudden_global, thr_episode_hybrid, sudden_episode_mean, median5, savgol11, moving_avg11, gradient_accel_jerk, ndiff_padded, plain_diffs, residual_features, startup_exclude, startup_grace, cluster_filter, cluster_jump, longest_run, mask_spans, renumber_frames, global_index, segment_split, timestamp_regrid, forward_fill, delta_integrate, flagged_cap, s2_best_lag, s2_direction_agreement, s2_decision, c_directional_agreement, feature_stats, stats_of_stats, position_histogram, first_abnormal_cause, exclusion_summary, distribution_histogram, exceed_counts, normalize_q01_q99, cut_list)}

_START = f"WITH {SE}, fm AS (SELECT episode, channel, min(frame) FILTER (abs(x) > 60) AS first FROM se GROUP BY ALL) SELECT episode, channel, CAST(sum(CASE WHEN first IS NULL OR frame < first + {{}} THEN 1 ELSE 0 END) AS BIGINT) AS n_startup FROM se JOIN fm USING (episode, channel) GROUP BY ALL"
_MA = " + ".join(sql_at("m", k) for k in range(-5, 6))
_PREFIX = "SELECT episode, count(*) AS n_frames, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS n_bad, CAST(sum(keep) AS BIGINT) AS n_kept, coalesce(min(CASE WHEN bad THEN frame END), -1) AS first_bad FROM pk GROUP BY episode"
ORACLES = {
    "s3_band_prefix": f"WITH {BAND} {_PREFIX}",
    "s3_band_dims": f"WITH {BAND} SELECT channel, count(*) AS n_values, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS n_bad, round(any_value(q1 - {ALPHA} * (q9 - q1)), 6) AS lower, round(any_value(q9 + {ALPHA} * (q9 - q1)), 6) AS upper FROM ba JOIN bo USING (channel) GROUP BY channel",
    "prefix_mask": f"WITH {BAND} SELECT episode, frame, CAST(keep AS BIGINT) AS keep FROM pk",
    "violation_scores": f"WITH {BAND}, vb AS (SELECT episode, frame, x, q1 - {ALPHA} * (q9 - q1) AS lower, q9 + {ALPHA} * (q9 - q1) AS upper FROM ba JOIN bo USING (channel)) SELECT * FROM (SELECT episode, frame, round(max(greatest(lower - x, x - upper, 0) / greatest(upper - lower, 1e-12)), 6) AS score FROM vb GROUP BY ALL) WHERE score > 0",
    "hist_quantiles": f"WITH {SE}, ra AS (SELECT channel, min(x) AS lo, max(x) AS hi, CASE WHEN max(x) - min(x) < 1e-12 THEN 1 ELSE max(x) - min(x) END AS span, count(*) AS n FROM se GROUP BY channel), hi AS (SELECT channel, greatest(0, least(65535, floor((x - lo) / span * 65535))) AS bin, count(*) AS c FROM se JOIN ra USING (channel) GROUP BY ALL), cu AS (SELECT *, sum(c) OVER (PARTITION BY channel ORDER BY bin) AS upto FROM hi) SELECT channel, round(min(CASE WHEN upto >= 0.01 * n THEN lo + bin / 65535 * span END), 6) AS q01, round(min(CASE WHEN upto >= 0.99 * n THEN lo + bin / 65535 * span END), 6) AS q99, any_value(lo) AS vmin, any_value(ra.hi) AS vmax, any_value(n) AS num_values FROM cu JOIN ra USING (channel) GROUP BY channel",
    "thr_global_hybrid": f"WITH {GLOBAL} SELECT channel, metric, round(scale, 5) AS scale, round(\"floor\", 5) AS \"floor\", round(threshold, 5) AS threshold FROM th",
    "sudden_global": f"WITH {GLOBAL} SELECT ft.episode, ft.frame, ft.channel FROM ft JOIN th r ON r.channel = ft.channel AND r.metric = 'residual' JOIN th a ON a.channel = ft.channel AND a.metric = 'accel' JOIN th j ON j.channel = ft.channel AND j.metric = 'jerk' WHERE n >= 11 AND residual > r.threshold AND (abs(accel) > a.threshold OR abs(jerk) > j.threshold)",
    "thr_episode_hybrid": f"WITH {FEATURES}, md AS (SELECT episode, channel, median(residual) AS m, stddev_pop(residual) AS s, quantile_cont(residual, 0.999) AS p FROM ft WHERE n >= 11 GROUP BY ALL), ma AS (SELECT episode, channel, median(abs(residual - md.m)) + 1e-12 AS mad FROM ft JOIN md USING (episode, channel) WHERE n >= 11 GROUP BY ALL) SELECT episode, channel, round(greatest(8 * greatest(mad, 0.01 * s), p, 1e-12), 5) AS threshold FROM md JOIN ma USING (episode, channel)",
    "sudden_episode_mean": f"WITH {SE}, m5 AS (SELECT *, {MED5} AS m FROM se {W}), av AS (SELECT *, ({_MA}) / 11 AS a FROM m5 {W}), rs AS (SELECT episode, frame, channel, round(abs(x - a), 9) AS residual FROM av), li AS (SELECT *, greatest(round(avg(residual) OVER (PARTITION BY episode, channel) * 5, 9), 1e-6) AS lim FROM rs) SELECT episode, frame, channel, round(residual, 6) AS residual FROM li WHERE residual > lim",
    "median5": f"WITH {SE} SELECT episode, frame, channel, round({MED5}, 6) AS m FROM se {W}",
    "savgol11": f"WITH {FEATURES} SELECT episode, frame, channel, round(trend, 6) AS trend FROM tr",
    "moving_avg11": f"WITH {SE}, m5 AS (SELECT *, {MED5} AS m FROM se {W}) SELECT episode, frame, channel, round(({_MA}) / 11, 6) AS a FROM m5 {W}",
    "gradient_accel_jerk": f"WITH {FEATURES} SELECT episode, frame, channel, round(accel, 6) AS accel, round(jerk, 6) AS jerk FROM ft",
    "ndiff_padded": f"WITH {SE}, nd AS (SELECT *, count(*) OVER (PARTITION BY episode, channel) AS n FROM se), d2 AS (SELECT a.episode, a.channel, a.frame, abs(c.x - 2 * b.x + a.x) AS d2 FROM nd a JOIN nd b ON b.episode = a.episode AND b.channel = a.channel AND b.frame = a.frame + 1 JOIN nd c ON c.episode = a.episode AND c.channel = a.channel AND c.frame = a.frame + 2), d3 AS (SELECT a.episode, a.channel, a.frame, abs(d.x - 3 * c.x + 3 * b.x - a.x) AS d3 FROM nd a JOIN nd b ON b.episode = a.episode AND b.channel = a.channel AND b.frame = a.frame + 1 JOIN nd c ON c.episode = a.episode AND c.channel = a.channel AND c.frame = a.frame + 2 JOIN nd d ON d.episode = a.episode AND d.channel = a.channel AND d.frame = a.frame + 3) SELECT nd.episode, nd.frame, nd.channel, round(d2, 6) AS d2, round(d3, 6) AS d3 FROM nd JOIN d2 ON d2.episode = nd.episode AND d2.channel = nd.channel AND d2.frame = least(greatest(nd.frame - 1, 0), nd.n - 3) JOIN d3 ON d3.episode = nd.episode AND d3.channel = nd.channel AND d3.frame = least(greatest(nd.frame - 1, 0), nd.n - 4)",
    "plain_diffs": f"WITH {SE} SELECT * FROM (SELECT episode, frame, channel, round(x - 2 * lag(x) OVER w + lag(x, 2) OVER w, 6) AS accel, round(x - 3 * lag(x) OVER w + 3 * lag(x, 2) OVER w - lag(x, 3) OVER w, 6) AS jerk FROM se {W}) WHERE accel IS NOT NULL",
    "residual_features": f"WITH {FEATURES} SELECT episode, frame, channel, round(residual, 6) AS residual, round(abs(accel), 6) AS accel, round(abs(jerk), 6) AS jerk FROM ft WHERE n >= 11",
    "startup_exclude": _START.format(0),
    "startup_grace": _START.format(7),
    "cluster_filter": f"WITH {RUNS} SELECT ru.episode, ru.frame, ru.channel FROM ru JOIN sp USING (episode, channel, run) WHERE flag AND run_length >= 3",
    "cluster_jump": f"WITH {RUNS}, ju AS (SELECT *, abs(x - lag(x) OVER (PARTITION BY episode, channel, run ORDER BY frame)) AS j FROM ru WHERE flag) SELECT episode, channel, min(frame) AS run_start, count(*) AS run_length, round(max(j), 6) AS jump FROM ju GROUP BY episode, channel, run HAVING count(*) >= 3 AND max(j) >= 10",
    "longest_run": f"WITH {RUNS} SELECT episode, channel, max(run_length) AS longest FROM sp GROUP BY ALL",
    "mask_spans": f"WITH {RUNS} SELECT episode, channel, run_start, run_end, run_length FROM sp",
    "renumber_frames": f"WITH {EV}, kp AS (SELECT episode, frame, CAST(row_number() OVER (PARTITION BY episode ORDER BY frame) - 1 AS BIGINT) AS new_frame FROM ev WHERE event_type IN ('purchase', 'click')) SELECT *, round(new_frame / 30.0::DOUBLE, 6) AS \"timestamp\" FROM kp",
    "global_index": f"WITH {EV} SELECT episode, frame, CAST(row_number() OVER (ORDER BY episode, frame) - 1 AS BIGINT) AS index FROM ev",
    "segment_split": f"WITH {EV}, ok AS (SELECT episode, frame, frame - row_number() OVER (PARTITION BY episode ORDER BY frame) AS isle FROM ev WHERE value < 40), sz AS (SELECT *, count(*) OVER (PARTITION BY episode, isle) AS size, min(frame) OVER (PARTITION BY episode, isle) AS first FROM ok) SELECT episode, CAST(dense_rank() OVER (PARTITION BY episode ORDER BY isle) - 1 AS BIGINT) AS segment, frame, frame - first AS new_frame FROM sz WHERE size > 4",
    "timestamp_regrid": f"WITH {EV}, kp AS (SELECT episode, frame, epoch_us(ts) * 1000 AS ns, row_number() OVER (PARTITION BY episode ORDER BY frame) - 1 AS i FROM ev WHERE value < 40), fs AS (SELECT episode, max(CASE WHEN i = 0 THEN ns END) AS a, max(CASE WHEN i = 1 THEN ns END) AS b FROM kp GROUP BY episode) SELECT kp.episode, frame, CAST(a + i * coalesce(b - a, 33333333) AS BIGINT) AS grid FROM kp JOIN fs USING (episode)",
    "forward_fill": f"WITH {EV}, gp AS (SELECT episode, frame, CASE WHEN k < 50 THEN value END AS gap FROM ev) SELECT episode, frame, round(coalesce(last_value(gap IGNORE NULLS) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(gap IGNORE NULLS) OVER (PARTITION BY episode ORDER BY frame ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)), 6) AS filled FROM gp",
    "delta_integrate": f"WITH {SE} SELECT episode, frame, channel, round(sum(x) OVER (PARTITION BY episode, channel ORDER BY frame ROWS UNBOUNDED PRECEDING) + first_value(x) OVER (PARTITION BY episode, channel ORDER BY frame), 6) AS total FROM se",
    "flagged_cap": f"WITH {SE} SELECT episode, channel, frame FROM (SELECT *, row_number() OVER (PARTITION BY episode, channel ORDER BY frame) AS i FROM se WHERE x > 50) WHERE i <= 5",
    "s2_best_lag": f"WITH {_Z} SELECT episode, n, lag, round(corr, 6) AS corr FROM bl",
    "s2_direction_agreement": f"WITH {_Z} SELECT dx.episode, dx.lag, n_active, CASE WHEN n_active >= 10 AND corr IS NOT NULL THEN round(score, 6) END AS score FROM dx JOIN bl USING (episode)",
    "s2_decision": f"WITH {_Z} SELECT dx.episode, CASE WHEN n_active >= 10 AND corr IS NOT NULL THEN round(score, 6) < 0.65 END AS discard FROM dx JOIN bl USING (episode)",
    "c_directional_agreement": f"WITH {PAIRS}, df AS (SELECT episode, frame, state - lag(state) OVER p AS ds, action - lag(action) OVER p AS da FROM pa WINDOW p AS (PARTITION BY episode ORDER BY frame)), dd AS (SELECT * FROM df WHERE ds IS NOT NULL), lg AS (SELECT CAST(l AS BIGINT) AS lag FROM range(-10, 11) t(l)), sc AS (SELECT a.episode, lag, round(avg(CASE WHEN sign(a.ds) = sign(b.da) THEN 1.0 ELSE 0.0 END), 12) AS score FROM dd a CROSS JOIN lg JOIN dd b ON b.episode = a.episode AND b.frame = a.frame + lag GROUP BY ALL) SELECT episode, arg_max(lag, (score, -lag)) AS lag, round(max(score), 6) AS score FROM sc GROUP BY episode",
    "feature_stats": f"WITH {SE} SELECT episode, channel, min(x) AS min, max(x) AS max, round(avg(x), 6) AS mean, round(stddev_pop(x), 6) AS std, count(x) AS count FROM se GROUP BY ALL",
    "stats_of_stats": f"WITH {SE}, st AS (SELECT episode, channel, min(x) AS lo, max(x) AS hi, avg(x) AS m, stddev_pop(x) AS s, count(x) AS n FROM se GROUP BY ALL) SELECT channel, min(lo) AS min, max(hi) AS max, round(sum(m * n) / sum(n), 6) AS mean, round(sum(s * n) / sum(n), 6) AS std, CAST(sum(n) AS BIGINT) AS count FROM st GROUP BY channel",
    "position_histogram": f"WITH {SE}, nn AS (SELECT *, count(*) OVER (PARTITION BY episode, channel) AS n FROM se) SELECT channel, CAST(least(floor(frame / CAST(greatest(n - 1, 1) AS DOUBLE) * 100), 99) AS BIGINT) AS bin, count(*) AS n_flagged FROM nn WHERE x > 50 GROUP BY ALL",
    "first_abnormal_cause": f"WITH {BAND}, ca AS (SELECT episode, frame, bool_or(bad AND channel = 0) AS a, bool_or(bad AND channel = 1) AS b FROM ba GROUP BY ALL HAVING bool_or(bad)), fi AS (SELECT episode, arg_min(CASE WHEN a AND b THEN 'both' WHEN a THEN 'value' ELSE 'k' END, frame) AS cause FROM ca GROUP BY episode) SELECT cause, count(*) AS n_episodes FROM fi GROUP BY cause",
    "exclusion_summary": f"WITH {BAND}, ep AS ({_PREFIX}), ra AS (SELECT *, n_kept / CAST(n_frames AS DOUBLE) AS ratio FROM ep) SELECT count(*) AS n_episodes, CAST(sum(CASE WHEN n_kept < n_frames THEN 1 ELSE 0 END) AS BIGINT) AS n_truncated, round(avg(ratio), 6) AS mean_ratio, round(quantile_cont(ratio, 0.5), 6) AS median_ratio, round(min(ratio), 6) AS min_ratio, round(quantile_cont(ratio, 0.1), 6) AS p10_ratio, round(quantile_cont(ratio, 0.25), 6) AS p25_ratio, CAST(sum(n_frames - n_kept) AS BIGINT) AS frames_lost FROM ra",
    "distribution_histogram": f"WITH {FEATURES}, rs AS (SELECT channel, round(residual, 9) AS residual FROM ft WHERE n >= 11), qq AS (SELECT channel, round(quantile_cont(residual, 0.005), 9) AS lo, round(quantile_cont(residual, 0.995), 9) AS hi FROM rs GROUP BY channel) SELECT channel, CAST(least(floor((residual - lo) / greatest(hi - lo, 1e-12) * 40), 39) AS BIGINT) AS bin, count(*) AS n FROM rs JOIN qq USING (channel) WHERE residual BETWEEN lo AND hi GROUP BY ALL",
    "exceed_counts": f"WITH {GLOBAL} SELECT channel, metric, CAST(sum(CASE WHEN me.v > threshold THEN 1 ELSE 0 END) AS BIGINT) AS n_exceed, count(*) AS n FROM me JOIN th USING (channel, metric) GROUP BY ALL",
    "normalize_q01_q99": f"WITH {BAND} SELECT episode, frame, channel, round(CASE WHEN q9 - q1 > 1e-12 THEN 2 * (x - q1) / (q9 - q1) - 1 ELSE 0 END, 6) AS normalised FROM se JOIN bo USING (channel)",
    "cut_list": f"WITH {BAND}, ok AS (SELECT episode, frame, frame - row_number() OVER (PARTITION BY episode ORDER BY frame) AS isle FROM fb WHERE NOT bad) SELECT episode, min(frame) AS cut_start, max(frame) + 1 AS cut_end FROM ok GROUP BY episode, isle",
}
