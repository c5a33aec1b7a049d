"""Collapsing rests: runs of consecutive frames in which neither state nor action moves.

Boundary-only rows: a frame that stays where its predecessor was is interior; only the frame before a run of such frames
(the start) and the last one of the run (the end) are kept, ``lead`` over those boundaries pairs each start with its end,
and the positions and timestamps of the pair give count and duration.

Plan: frames are shuffled once by (episode, block of 4,096 frames with one frame of halo on either side, which makes the
comparison with both neighbours exact inside the block), so a hot episode is spread over tasks.  The array comparison is
JVM-side.  The second window sees two narrow rows per rest.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kinelake.functions.deliveries import once, with_halo

SPAN = 4096
EPSILON = 0.0005


def _close(a: Column, b: Column, epsilon: float) -> Column:
    """Every channel within ``epsilon``; false for nulls (also inside a list), NaN and lists of different length."""
    near = F.zip_with(a, b, lambda x, y: F.coalesce(~F.isnan(x) & ~F.isnan(y) & (F.abs(x.cast("double") - y.cast("double")) <= epsilon), F.lit(False)))
    return F.coalesce((F.size(a) > 0) & (F.size(a) == F.size(b)) & F.forall(near, lambda v: v), F.lit(False))


def _compared(frames: DataFrame, epsilon: float, extra: list[str]) -> DataFrame:
    """Frames once each with ``same`` (rests since the predecessor) and ``goes_on`` (the successor rests too)."""
    rows = frames.where("episode_index is not null and frame_index is not null").select("episode_index", "frame_index", F.col("`observation.state`").alias("s"), F.col("action").alias("a"), *extra)
    rows = once(with_halo(rows, SPAN, 1), ["episode_index", "block"], ["frame_index"])
    w = Window.partitionBy("episode_index", "block").orderBy("frame_index")
    before = F.lag(F.struct("frame_index", "s", "a")).over(w)
    rows = rows.withColumn("b", before)
    same = (F.col("b.frame_index") == F.col("frame_index") - 1) & _close(F.col("s"), F.col("b.s"), epsilon) & _close(F.col("a"), F.col("b.a"), epsilon)
    rows = rows.withColumn("same", F.coalesce(same, F.lit(False))).drop("b", "s", "a")
    return rows.withColumn("goes_on", F.coalesce(F.lead("same").over(w), F.lit(False))).where("own").drop("block", "own")


def rests(frames: DataFrame, epsilon: float = EPSILON, least: int = 3) -> DataFrame:
    """(episode_index, first_frame, last_frame, n_frames, duration_s): the maximal runs of at least ``least`` consecutive
    frames in which every state and action channel differs from the previous frame by at most ``epsilon``.

    A missing frame, a null list, a null or NaN element and lists of different length end a run.  Frames delivered
    several times count once; frames without episode or frame number are left out.  ``duration_s`` is the time from the
    first to the last frame by ``timestamp`` and null where one of the two is null."""
    rows = _compared(frames, epsilon, ["timestamp"])
    edges = rows.where("same <> goes_on").select("episode_index", "frame_index", "timestamp", F.col("goes_on").alias("starts"))
    w = Window.partitionBy("episode_index").orderBy("frame_index")
    ends = F.lead(F.struct("frame_index", "timestamp")).over(w)
    paired = edges.withColumn("e", ends).where("starts")
    out = paired.select("episode_index", F.col("frame_index").alias("first_frame"), F.col("e.frame_index").alias("last_frame"), (F.col("e.frame_index") - F.col("frame_index") + 1).alias("n_frames"), (F.col("e.timestamp").cast("double") - F.col("timestamp").cast("double")).alias("duration_s"))
    return out.where(F.col("n_frames") >= least)


def collapse_rests(frames: DataFrame, epsilon: float = EPSILON, least: int = 3) -> DataFrame:
    """``frames`` with each rest reduced to its first frame, plus ``rest_frames`` and ``rest_duration_s`` (1 and 0 for all
    other frames, which stay as they are, with all their columns; frames without keys too).  Of a frame delivered several
    times the delivery of the least ``ingest_ts`` and ``file_id`` stays.  A column that is named like one of the two added
    ones is replaced.

    Frames are shuffled once, with all their columns; whether a frame lies inside a rest shows within ``least`` - 1 frames
    of it.  Only the first frames of rests meet the table of rests."""
    names = [c for c in frames.columns if c not in ("rest_frames", "rest_duration_s")]
    # The columns travel in one struct, so that none of their names can clash.
    whole = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    first = [F.col(c) if c in names else F.lit(None) for c in ("ingest_ts", "file_id")]
    keyed = frames.where("episode_index is not null and frame_index is not null").select("episode_index", "frame_index", F.struct(*[f.alias(f"k{i}") for i, f in enumerate(first)]).alias("_first"), whole.alias("row"))
    s, a = f"row.c{names.index('observation.state')}", f"row.c{names.index('action')}"
    blocked = with_halo(keyed, SPAN, least)
    w = Window.partitionBy("episode_index", "block").orderBy("frame_index", "_first")
    one = blocked.withColumn("_before", F.lag("frame_index").over(w)).where("_before is null or _before <> frame_index")
    v = Window.partitionBy("episode_index", "block").orderBy("frame_index")
    near = (F.col("_before") == F.col("frame_index") - 1) & _close(F.col(s), F.lag(s).over(v), epsilon) & _close(F.col(a), F.lag(a).over(v), epsilon)
    one = one.withColumn("same", F.coalesce(near, F.lit(False)))
    # A frame that stays is inside a rest if least - 1 frames in a row around it stay.
    still, full = F.col("same").cast("int"), F.lit(False)
    for k in range(least - 1):
        full = full | (F.coalesce(F.sum(still).over(v.rowsBetween(-k, least - 2 - k)), F.lit(0)) == least - 1)
    one = one.withColumn("inside", F.col("same") & full)
    one = one.withColumn("opens", ~F.col("inside") & F.coalesce(F.lead("inside").over(v), F.lit(False))).where("own and not inside")
    found = rests(frames, epsilon, least).select(F.col("episode_index").alias("_e"), F.col("first_frame").alias("_f"), "n_frames", "duration_s")
    starts = one.where("opens").join(found, (F.col("episode_index") == F.col("_e")) & (F.col("frame_index") == F.col("_f")))
    out = one.where("not opens").select("row", F.lit(1).cast("long").alias("rest_frames"), F.lit(0.0).alias("rest_duration_s")).unionByName(starts.select("row", F.col("n_frames").alias("rest_frames"), F.col("duration_s").alias("rest_duration_s")))
    unkeyed = frames.where("episode_index is null or frame_index is null").select(whole.alias("row"), F.lit(1).cast("long").alias("rest_frames"), F.lit(0.0).alias("rest_duration_s"))
    return out.unionByName(unkeyed).select(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)], "rest_frames", "rest_duration_s")


def p4_found(spark: SparkSession, root: str) -> DataFrame:
    """Rests of ``frames``."""
    return rests(spark.read.parquet(f"{root}/frames.parquet")).select("episode_index", "first_frame", "last_frame")


def p4_rests(spark: SparkSession, root: str) -> DataFrame:
    """Rests with their frame count."""
    return rests(spark.read.parquet(f"{root}/frames.parquet")).select("episode_index", "first_frame", "n_frames", F.round("duration_s", 3).alias("duration_s"))


def p4_collapsed(spark: SparkSession, root: str) -> DataFrame:
    """All of ``frames`` with each rest reduced to its first frame; all columns."""
    return collapse_rests(spark.read.parquet(f"{root}/frames.parquet"))


_RUNS = """
        WITH d AS (SELECT DISTINCT ON (episode_index, frame_index) episode_index, frame_index, "timestamp" AS ts, "observation.state" AS s, action AS a
                   FROM frames),
        p AS (SELECT *, lag(frame_index) OVER w AS pf, lag(s) OVER w AS ps, lag(a) OVER w AS pa FROM d
              WINDOW w AS (PARTITION BY episode_index ORDER BY frame_index)),
        q AS (SELECT episode_index, frame_index, ts,
                coalesce(pf = frame_index - 1 AND len(s) = len(ps) AND len(a) = len(pa)
                  AND list_max([abs(CAST(s[i] AS DOUBLE) - CAST(ps[i] AS DOUBLE)) FOR i IN range(1, 21)]) <= 0.0005
                  AND list_max([abs(CAST(a[i] AS DOUBLE) - CAST(pa[i] AS DOUBLE)) FOR i IN range(1, 21)]) <= 0.0005, false) AS same FROM p),
        r AS (SELECT *, sum(CASE WHEN same THEN 0 ELSE 1 END) OVER (PARTITION BY episode_index ORDER BY frame_index) AS run FROM q),
        g AS (SELECT episode_index, min(frame_index) AS first_frame, max(frame_index) AS last_frame, count(*) AS n_frames,
                arg_max(ts, frame_index) AS t1, arg_min(ts, frame_index) AS t0, bool_or(ts IS NULL AND (frame_index = lo OR frame_index = hi)) AS open
              FROM (SELECT *, min(frame_index) OVER (PARTITION BY episode_index, run) AS lo, max(frame_index) OVER (PARTITION BY episode_index, run) AS hi FROM r)
              GROUP BY episode_index, run HAVING count(*) >= 3)"""
QUERIES = {"p4_found": p4_found, "p4_rests": p4_rests, "p4_collapsed": p4_collapsed}
ORACLES = {
    "p4_found": _RUNS + " SELECT episode_index, first_frame, last_frame FROM g",
    "p4_rests": _RUNS + " SELECT episode_index, first_frame, n_frames, CASE WHEN open THEN NULL ELSE round(CAST(t1 AS DOUBLE) - CAST(t0 AS DOUBLE), 3) END AS duration_s FROM g",
}
