"""Registered queries over the frames and keypoints: geometry, the quality pipeline, the episode filter, exports."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kinelake.functions import geometry as g
from kinelake.functions.deliveries import once
from kinelake.operators import alignment, episode_filter, export, quality
from kinelake.functions.timeseries import Axis
from kinelake.plans.series_queries import SG, W, sql_at, sql_fir
from kinelake.sources import read_table
from kinelake.sources.raw import DEFAULT_INTRINSICS

CONFIG = quality.QualityConfig()
FILTER = episode_filter.FilterConfig()


def _frames(spark, root) -> DataFrame:
    return read_table(spark, root, "frames")


def _states(spark, root) -> DataFrame:
    """Frames once each: (episode, frame_index, s)."""
    rows = _frames(spark, root).select(F.col("episode_index").alias("episode"), "frame_index", F.col("`observation.state`").alias("s"))
    return once(rows, ["episode"], ["frame_index"])


def _cells(df: DataFrame, value: str, keys=("episode", "frame_index"), digits: int = 5) -> DataFrame:
    """Array values in long form, rounded off the ties that binary fractions make."""
    return df.select(*keys, F.posexplode(value).alias("i", "v")).select(*keys, F.col("i").cast("long").alias("i"), F.round(F.col("v") + 1e-7, digits).alias("v"))


# Geometry --------------------------------------------------------------------------


def rot6d_matrix(spark, root):
    """Rotations of both hands: left from 0, right from 9."""
    return _cells(_states(spark, root).withColumn("m", F.concat(g.rot6d_to_matrix(F.col("s"), 3), g.rot6d_to_matrix(F.col("s"), 13))), "m")


def rot6d_matrix_gs(spark, root):
    """The same by Gram-Schmidt."""
    return _cells(_states(spark, root).withColumn("m", F.concat(g.rot6d_to_matrix_gs(F.col("s"), 3), g.rot6d_to_matrix_gs(F.col("s"), 13))), "m")


def canonical14(spark, root):
    return _cells(quality.episode_frames(_frames(spark, root)), "state", digits=4)


def rotation_checks(spark, root):
    """Orthogonality error and determinant of both hands' rotations, per episode."""
    r = _states(spark, root).select("episode", F.explode(F.array(g.rot6d_to_matrix(F.col("s"), 3), g.rot6d_to_matrix(F.col("s"), 13))).alias("m"))
    def error(m):
        p = g.mat_mul(g.items(m, 9), g.transposed(g.items(m, 9)))
        return F.greatest(*[F.abs(x - (1.0 if i in (0, 4, 8) else 0.0)) for i, x in enumerate(p)])

    check = g.let(F.col("m"), lambda m: F.struct(error(m).alias("e"), g.determinant(g.items(m, 9)).alias("d")))
    return r.withColumn("c", check).select("episode", "c.e", "c.d").groupBy("episode").agg(F.round(F.max("e"), 5).alias("max_error"), F.round(F.min("d"), 5).alias("min_det"), F.round(F.max("d"), 5).alias("max_det"))


def _poses(spark, root) -> DataFrame:
    rows = read_table(spark, root, "hand_keypoints").select(F.col("episode_index").alias("episode"), "frame_index", "joint_frame", "left_keypoints", "right_keypoints", F.col("obs_head_pose").alias("p"))
    return once(rows, ["episode"], ["frame_index"])


def quat_matrix(spark, root):
    """Head rotations where the pose is usable."""
    return _cells(_poses(spark, root).where(g.pose7_valid(F.col("p"))).withColumn("m", g.wxyz_to_matrix(F.col("p"), 3)), "m")


def matrix_quat(spark, root):
    """Quaternion of the head rotation, from its matrix (sign fixed by the largest component)."""
    r = _poses(spark, root).where(g.pose7_valid(F.col("p"))).withColumn("m", g.wxyz_to_matrix(F.col("p"), 3)).withColumn("q", g.matrix_to_wxyz(F.col("m")))
    big = F.array_max(F.transform("q", lambda x: F.struct(F.round(F.abs(x), 6).alias("a"), F.signum(x).alias("s"))))["s"]
    return _cells(r.withColumn("q", F.transform("q", lambda x: x * big)), "q")


def pose_validity(spark, root):
    r = _poses(spark, root)
    return r.select("episode", "frame_index", g.pose7_valid(F.col("p")).alias("pose_ok"), g.keypoints_valid(F.col("left_keypoints")).alias("left_ok"), g.keypoints_valid(F.col("right_keypoints")).alias("right_ok"))


def rigid_inverse(spark, root):
    r = _poses(spark, root).where(g.pose7_valid(F.col("p"))).withColumn("t", g.head_pose(F.col("p")))
    return _cells(r.withColumn("inv", g.rigid_inverse(F.col("t"))), "inv")


def first_frame_align(spark, root):
    """The wrists (left from 0, right from 3) seen from the episode's first usable head pose; world keypoints only."""
    r = _poses(spark, root).where(g.pose7_valid(F.col("p")) & (F.col("joint_frame") == "world")).withColumn("t", g.head_pose(F.col("p")))
    r = r.withColumn("t0", F.first("t").over(Window.partitionBy("episode").orderBy("frame_index"))).withColumn("inv", g.rigid_inverse(F.col("t0")))
    wrist = lambda h: _cells(r.where(g.keypoints_valid(F.slice(h, 1, 3)) & (F.size(h) >= 3)).withColumn("x", g.move_point(F.col("inv"), g.items(F.col(h), 3))), "x")
    return wrist("left_keypoints").unionByName(wrist("right_keypoints").withColumn("i", F.col("i") + 3))


def retarget_gripper(spark, root):
    """Grippers of both hands (right from 0, left from 10) from wrist, thumb, index and middle tip (joints 0, 4, 8, 12)."""
    out = None
    for base, name, side in ((0, "right_keypoints", 1), (10, "left_keypoints", -1)):
        r = _poses(spark, root).where(g.keypoints_valid(F.col(name)) & (F.size(name) == 63))
        hand = g.retarget(*[g.items(F.col(name), 3, 3 * j) for j in (4, 8, 12, 0)], side)
        # Generated, so that the fields are computed once and the struct is not copied into each use.
        rows = r.select("episode", "frame_index", F.inline(F.array(hand))).where("valid")
        one = _cells(rows.withColumn("a", g.gripper_action(F.col("position"), F.col("rotation"), F.col("width"))), "a").withColumn("i", F.col("i") + base)
        out = one if out is None else out.unionByName(one)
    return out


def project_points(spark, root):
    """Wrists in pixels (left from 0, right from 2; world keypoints, taken as camera coordinates), default intrinsics."""
    out = None
    for base, name in ((0, "left_keypoints"), (2, "right_keypoints")):
        r = _poses(spark, root).where((F.col("joint_frame") == "world") & g.keypoints_valid(F.slice(name, 1, 3)))
        uv = g.project(g.items(F.col(name), 3), *DEFAULT_INTRINSICS)
        one = _cells(r.withColumn("uv", uv).where("uv is not null"), "uv", digits=3).withColumn("i", F.col("i") + base)
        out = one if out is None else out.unionByName(one)
    return out


def confidence_pair(spark, root):
    rows = _frames(spark, root).where("`observation.confidence` is not null").select(F.col("episode_index").alias("episode"), "frame_index", F.col("`observation.confidence`").alias("c"))
    return once(rows, ["episode"], ["frame_index"]).select("episode", "frame_index", F.round(g.hand_confidence(F.col("c")), 5).alias("confidence"))


def stage5_aligned(spark, root):
    """State (i from 0) and action poses (from 14) seen from the episode's first left pose, turned by -90 degrees about
    y, and the forward vector of that pose (from 28).  Angles at the seam count as +pi."""
    e = quality.episode_frames(_frames(spark, root))
    first = F.first("state").over(Window.partitionBy("episode").orderBy("t"))
    e = e.withColumn("_s0", first).withColumn("_p0", g.let(g.euler_to_matrix(F.col("_s0"), 3), lambda m: g.pose(g.items(m, 9), g.items(F.col("_s0"), 3))))
    e = quality.stage5_align(e, g.rigid_inverse(F.col("_p0")), [0.0, -g.PI / 2, 0.0])
    cells = _cells(e.withColumn("all", F.concat("aligned", "aligned_action", "reference_forward")), "all", digits=3)
    angle = (F.col("i") < 28) & (F.col("i") % 7).isin(3, 4, 5)
    return cells.withColumn("v", F.when(angle & (F.col("v") <= -3.1415), F.lit(round(g.PI, 3))).otherwise(F.col("v")))


# Quality pipeline --------------------------------------------------------------------


def hard_limits(spark, root):
    """Frames beyond the hard limits, per kind."""
    return quality.hard_limits(quality.episode_frames(_frames(spark, root))).agg(*[F.sum(F.col(h).cast("long")).alias(h) for h in quality.HARD])


def global_frame_stats(spark, root):
    s = quality.global_stats(quality.episode_frames(_frames(spark, root)))
    return s.select(F.col("channel").cast("long").alias("channel"), *[F.round(c, 3).alias(c) for c in ("q01", "q99")], "n")


def static_removed(spark, root):
    """Static frames beyond the first five of each run, over whole episodes."""
    e = quality.stage4(quality.episode_frames(_frames(spark, root)))
    return e.groupBy("episode").agg(F.count("*").alias("n_frames"), F.sum(F.col("s4_remove").cast("long")).alias("n_removed")).where("n_removed > 0")


def _results(spark, root):
    return quality.episode_results(quality.keep_masks(_frames(spark, root)))


def quality_results(spark, root):
    r = _results(spark, root)
    return r.select("episode", "num_frames", "kept_frames", "first_abnormal_frame", "stage1_hard_limit", "stage1_flagged", F.round("stage2_da_mean", 5).alias("stage2_da_mean"), "stage3_excluded_frames", "stage4_removed_frames", F.size("discard_reasons").cast("long").alias("n_reasons"))


def quality_report(spark, root):
    r = quality.quality_report(_results(spark, root))
    return r.select(*[F.round(c, 5).alias(c) if t == "double" else F.col(c) for c, t in r.dtypes])


def discard_reason_counts(spark, root):
    """Reasons over all episodes: with the defaults none is discarded."""
    return quality.reason_counts(_results(spark, root), only_discarded=False)


#: Discards episodes whose kept prefix is short.
STRICT = quality.QualityConfig(discard_short=True, min_episode_length=60)


def discarded_reason_counts(spark, root):
    """The report's reasons: only over the episodes that are discarded (kept prefix under 60 frames)."""
    return quality.reason_counts(quality.episode_results(quality.keep_masks(_frames(spark, root), STRICT), STRICT))


# Episode filter -------------------------------------------------------------------------


def episode_decision(spark, root):
    d = episode_filter.episode_decisions(episode_filter.judged_frames(_frames(spark, root)))
    return d.select("episode", "length", F.round("bad_frame_ratio", 6).alias("bad_frame_ratio"), F.array_join("reasons", ",").alias("reasons"), "keep_episode")


def filter_flagged(spark, root):
    """Bad frames per episode and stage."""
    j = episode_filter.judged_frames(_frames(spark, root))
    return j.groupBy("episode").agg(*[F.sum(F.col(c).cast("long")).alias(c) for c in ("stage1", "stage3", "low_confidence", "bad")]).where("bad > 0")


def filter_flagged_cap(spark, root):
    """The report's flagged frames: the first 200 bad frames of each episode."""
    f = episode_filter.flagged_frames(episode_filter.judged_frames(_frames(spark, root)))
    return f.select("episode", "frame_index", "stage1", "stage3", "low_confidence")


def extreme_bounds(spark, root):
    b = episode_filter.extreme_bounds(episode_filter.filter_frames(_frames(spark, root)))
    return b.select(F.col("channel").cast("long").alias("channel"), F.round("lower", 5).alias("lower"), F.round("upper", 5).alias("upper"))


# Datasets ----------------------------------------------------------------------------------


def semi_keep_episodes(spark, root):
    kept = export.kept_episodes(read_table(spark, root, "episodes"), episode_filter.episode_decisions(episode_filter.judged_frames(_frames(spark, root))))
    return kept.groupBy("corpus").agg(F.countDistinct("episode_index").alias("n_episodes"))


def task_reindex(spark, root):
    """Tasks renumbered in order of first appearance."""
    e = read_table(spark, root, "episodes").join(read_table(spark, root, "tasks").select("task_index", F.col("task_name").alias("task")), "task_index")
    return export.first_appearance_index(e, "task", ["episode_index"], "new_index")


def episode_meta(spark, root):
    rows = _frames(spark, root).select("episode_index", "frame_index").distinct()
    m = export.episode_meta(rows, read_table(spark, root, "episodes"))
    return m.select("episode_index", "length", F.size("tasks").cast("long").alias("n_tasks"), F.array_join("tasks", "|").alias("tasks"))


def alignment_verify(spark, root):
    """Issues of the delivered frames; the totals are those of an information file that says 1,000,000 and 1,000."""
    return export.verify_alignment(_frames(spark, root), read_table(spark, root, "episodes"), total_frames=1_000_000, total_episodes=1_000)


def exported_frames(spark, root):
    """Frames once each, renumbered over all episodes."""
    rows = once(_frames(spark, root).select("episode_index", "frame_index", "task_index"), ["episode_index"], ["frame_index"])
    return export.exported_frames(rows, renumber_episodes=True).select("episode_index", "frame_index", "index", F.round(F.col("timestamp").cast("double"), 4).alias("timestamp"))


def orphan_episodes(spark, root):
    """Listed episodes without a frame."""
    return read_table(spark, root, "episodes").select("episode_index").distinct().join(_frames(spark, root).select("episode_index").distinct(), "episode_index", "left_anti")


def _pooled_agreement(spark, root, max_lag: int) -> DataFrame:
    rows = _frames(spark, root).where("action is not null").select(F.col("episode_index").alias("episode"), "frame_index", F.col("`observation.state`").alias("s"), F.col("action").alias("a"))
    rows = once(rows, ["episode"], ["frame_index"])
    axis = Axis(("episode", "channel"), ("frame_index",))
    long = rows.select("episode", "frame_index", F.posexplode(F.arrays_zip("s", "a")).alias("channel", "v")).select("episode", "frame_index", "channel", F.col("v.s").cast("double").alias("state"), F.col("v.a").cast("double").alias("action"))
    a = alignment.pooled_agreement(alignment.differences(long, axis, "state", "action", smooth=False), axis, ["episode"], max_lag)
    return a.select("episode", "lag", F.round("score", 6).alias("score"))


def pooled_frame_agreement(spark, root):
    """The episode filter's directional agreement of state and action over all 20 channels and its whole range of lags."""
    return _pooled_agreement(spark, root, FILTER.max_lag)


QUERIES = {f.__name__: f for f in (rot6d_matrix, rot6d_matrix_gs, canonical14, rotation_checks, quat_matrix, matrix_quat, pose_validity, rigid_inverse, first_frame_align, retarget_gripper, project_points, confidence_pair, stage5_aligned, hard_limits, global_frame_stats, static_removed, quality_results, quality_report, discard_reason_counts, discarded_reason_counts, episode_decision, filter_flagged, filter_flagged_cap, extreme_bounds, semi_keep_episodes, task_reindex, episode_meta, alignment_verify, exported_frames, orphan_episodes, pooled_frame_agreement)}

# SQL -------------------------------------------------------------------------------------------

_FR = """fr AS (SELECT episode_index AS episode, frame_index, CAST(row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS BIGINT) AS t,
          "observation.state" AS s, coalesce(action, "observation.state") AS a, action AS raw, "observation.confidence" AS conf
          FROM (SELECT DISTINCT ON (episode_index, frame_index) * FROM frames))"""


def _at(v: str, i: int) -> str:
    return f"CAST({v}[{i + 1}] AS DOUBLE)"


def _rotation(source: str, vec: str, out: str) -> str:
    """CTEs from six numbers ``a..f`` of ``source`` to x, y, z columns."""
    return f"""{out}1 AS (SELECT *, sqrt(a * a + b * b + c * c) + 1e-8 AS n1 FROM {source}), {out}2 AS (SELECT *, a / n1 AS x1, b / n1 AS x2, c / n1 AS x3 FROM {out}1),
        {out}3 AS (SELECT *, x2 * f - x3 * e AS r1, x3 * d - x1 * f AS r2, x1 * e - x2 * d AS r3 FROM {out}2), {out}4 AS (SELECT *, sqrt(r1 * r1 + r2 * r2 + r3 * r3) + 1e-8 AS n2 FROM {out}3),
        {out}5 AS (SELECT *, r1 / n2 AS z1, r2 / n2 AS z2, r3 / n2 AS z3 FROM {out}4), {out} AS (SELECT *, z2 * x3 - z3 * x2 AS y1, z3 * x1 - z1 * x3 AS y2, z1 * x2 - z2 * x1 AS y3 FROM {out}5)"""


def _six(v: str, start: int) -> str:
    return ", ".join(f"{_at(v, start + k)} AS {n}" for k, n in enumerate("abcdef"))


_HANDS = " UNION ALL ".join(f"SELECT episode, frame_index, t, {7 * h + 14 * k} AS base, {_at(v, o)} AS p1, {_at(v, o + 1)} AS p2, {_at(v, o + 2)} AS p3, {_six(v, o + 3)}, {_at(v, o + 9)} AS wd FROM fr" for k, v in enumerate(("s", "a")) for h, o in enumerate((0, 10)))
#: canonical channels in long form: ca(episode, frame_index, t, ch, x); 0-13 state, 14-27 action.
CANON = f"""{_FR}, hh AS ({_HANDS}), {_rotation('hh', 'v', 'ro')},
        eu AS (SELECT *, abs(greatest(-1, least(1, -x3))) > 1 - 1e-12 AS lock FROM ro),
        ca AS (SELECT episode, frame_index, t, base AS ch, p1 AS x FROM eu UNION ALL SELECT episode, frame_index, t, base + 1, p2 FROM eu UNION ALL SELECT episode, frame_index, t, base + 2, p3 FROM eu
          UNION ALL SELECT episode, frame_index, t, base + 3, CASE WHEN lock THEN atan2(-z2, y2) ELSE atan2(y3, z3) END FROM eu
          UNION ALL SELECT episode, frame_index, t, base + 4, asin(greatest(-1, least(1, -x3))) FROM eu
          UNION ALL SELECT episode, frame_index, t, base + 5, CASE WHEN lock THEN 0 ELSE atan2(x2, x1) END FROM eu UNION ALL SELECT episode, frame_index, t, base + 6, wd FROM eu)"""
_KP = """kp AS (SELECT episode_index AS episode, frame_index, joint_frame, left_keypoints AS l, right_keypoints AS r, obs_head_pose AS p FROM (SELECT DISTINCT ON (episode_index, frame_index) * FROM hand_keypoints))"""


def _valid(v: str) -> str:
    return f"coalesce(list_bool_and([isfinite(q) AND abs(q) < 1e8 AND q IS NOT NULL FOR q IN {v}]) AND list_count({v}) = len({v}) AND list_sum([abs(CAST(q AS DOUBLE)) FOR q IN {v}]) > 1e-9, false)"


_QN = f"sqrt({' + '.join(f'{_at("p", i)} * {_at("p", i)}' for i in range(3, 7))})"
_POSE_OK = f"(len(p) = 7 AND {_valid('p')} AND {_QN} > 1e-9 AND abs({_QN} - 1) < 0.2)"
_QM = f"""{_KP}, qn AS (SELECT *, {_QN} AS n FROM kp WHERE {_POSE_OK}), qq AS (SELECT *, {_at('p', 3)} / n AS w, {_at('p', 4)} / n AS x, {_at('p', 5)} / n AS y, {_at('p', 6)} / n AS z FROM qn),
        qm AS (SELECT *, [1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y), 2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x), 2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)] AS m FROM qq)"""


def _unnest(source: str, value: str, digits: int = 5, keys: str = "episode, frame_index") -> str:
    return f"SELECT {keys}, CAST(i AS BIGINT) AS i, round({value}[i + 1] + 1e-7, {digits}) AS v FROM {source}, (SELECT unnest(range(64)) AS i) WHERE i < len({value})"


_INV = "[m[1], m[4], m[7], -(m[1] * {0} + m[4] * {1} + m[7] * {2}), m[2], m[5], m[8], -(m[2] * {0} + m[5] * {1} + m[8] * {2}), m[3], m[6], m[9], -(m[3] * {0} + m[6] * {1} + m[9] * {2}), 0, 0, 0, 1]".format(*[_at("p", i) for i in range(3)])
def _gripper(v: str, side: int, tag: str) -> str:
    """CTEs up to ``{tag}re`` (episode, frame_index, act): the gripper of the hand in column ``v``."""
    j = lambda n: [_at(v, 3 * n + k) for k in range(3)]
    body = f"""ok AS (SELECT * FROM kp WHERE {_valid(v)} AND len({v}) = 63),
        fi AS (SELECT *, {', '.join(f'0.7 * {a} + 0.3 * {b} AS f{k}' for k, (a, b) in enumerate(zip(j(8), j(12))))}, {', '.join(f'{a} AS t{k}' for k, a in enumerate(j(4)))}, {', '.join(f'{a} AS w{k}' for k, a in enumerate(j(0)))} FROM ok),
        ga AS (SELECT *, sqrt((t0 - f0) ** 2 + (t1 - f1) ** 2 + (t2 - f2) ** 2) AS wd FROM fi),
        gz AS (SELECT *, {', '.join(f'{side} * (t{k} - f{k}) / greatest(wd, 1e-8) AS z{k}' for k in range(3))} FROM ga),
        gr AS (SELECT *, z1 * (f2 - w2) - z2 * (f1 - w1) AS r0, z2 * (f0 - w0) - z0 * (f2 - w2) AS r1, z0 * (f1 - w1) - z1 * (f0 - w0) AS r2 FROM gz),
        gn AS (SELECT *, sqrt(r0 * r0 + r1 * r1 + r2 * r2) AS rn FROM gr), gv AS (SELECT * FROM gn WHERE wd > 1e-6 AND rn > 1e-6),
        gx AS (SELECT *, r1 / rn * z2 - r2 / rn * z1 AS u0, r2 / rn * z0 - r0 / rn * z2 AS u1, r0 / rn * z1 - r1 / rn * z0 AS u2 FROM gv),
        gu AS (SELECT *, u0 / sqrt(u0 * u0 + u1 * u1 + u2 * u2) AS x0, u1 / sqrt(u0 * u0 + u1 * u1 + u2 * u2) AS x1, u2 / sqrt(u0 * u0 + u1 * u1 + u2 * u2) AS x2 FROM gx),
        gy AS (SELECT *, z1 * x2 - z2 * x1 AS y0, z2 * x0 - z0 * x2 AS y1, z0 * x1 - z1 * x0 AS y2 FROM gu),
        re AS (SELECT episode, frame_index, [(t0 + f0) / 2, (t1 + f1) / 2, (t2 + f2) / 2, x0, x1, x2, y0, y1, y2, wd] AS act FROM gy)"""
    for n in ("ok", "fi", "ga", "gz", "gr", "gn", "gv", "gx", "gu", "gy", "re"):
        body = body.replace(f"{n} AS (", f"{tag}{n} AS (").replace(f"FROM {n}", f"FROM {tag}{n}")
    return body


_RET = f"{_KP}, {_gripper('r', 1, 'r')}, {_gripper('l', -1, 'l')}, re AS (SELECT *, 0 AS o FROM rre UNION ALL SELECT *, 10 FROM lre)"

_ABS = "list_max([abs(x) FOR x IN {}])"
_S1HARD = "max(CASE WHEN ch IN (0, 1, 2, 7, 8, 9) AND abs(x) > 2.0 THEN 1 ELSE 0 END) AS hx, max(CASE WHEN ch IN (3, 4, 5, 10, 11, 12) AND abs(x) > 3.14159265 THEN 1 ELSE 0 END) AS hr, max(CASE WHEN ch IN (6, 13) AND abs(x) > 1.0 THEN 1 ELSE 0 END) AS hs, max(CASE WHEN ch IN (20, 27) AND abs(x) > 1.0 THEN 1 ELSE 0 END) AS ha"


def _hist(source: str, keys: str, flat: str, tag: str) -> str:
    return f"""{tag}r AS (SELECT {keys}, min(x) AS lo, CASE WHEN max(x) - min(x) < 1e-12 THEN {flat} ELSE max(x) - min(x) END AS span, count(*) AS n FROM {source} GROUP BY ALL),
        {tag}h AS (SELECT {keys}, greatest(0, least(65535, floor((x - lo) / span * 65535))) AS bin, count(*) AS c, lo, span FROM {source} JOIN {tag}r USING ({keys}) GROUP BY ALL),
        {tag}c AS (SELECT *, lo + bin / 65535 * span AS v, sum(c) OVER (PARTITION BY {keys} ORDER BY bin) AS upto, sum(c) OVER (PARTITION BY {keys}) AS total FROM {tag}h)"""


_GSTAT = f"{CANON}, {_hist('ca', 'ch', '1', 'g')}, gq AS (SELECT ch, min(CASE WHEN upto >= 0.01::DOUBLE * total THEN v END) AS q01, min(CASE WHEN upto >= 0.99::DOUBLE * total THEN v END) AS q99, any_value(total) AS n FROM gc GROUP BY ch)"
_MED = "list_sort([" + ", ".join(sql_at("x", k) for k in range(-2, 3)) + "])[3]"
_WF = W.replace("episode, channel", "episode, ch").replace("frame", "t")


def _grad(x: str) -> str:
    return f"CASE WHEN n = 1 THEN 0 WHEN t = 0 THEN lead({x}) OVER w - {x} WHEN t = n - 1 THEN {x} - lag({x}) OVER w ELSE (lead({x}) OVER w - lag({x}) OVER w) / 2 END"


_QUAL = f"""{_GSTAT}, md AS (SELECT *, {_MED} AS m, count(*) OVER (PARTITION BY episode, ch) AS n FROM ca {_WF}),
        tr AS (SELECT *, CASE WHEN n >= 11 THEN {sql_fir('m', SG)} / 429 ELSE x END AS tr FROM md {_WF}),
        g1 AS (SELECT *, {_grad('x')} AS g FROM tr {_WF}), g2 AS (SELECT *, {_grad('g')} AS ac FROM g1 {_WF}), ft AS (SELECT *, {_grad('ac')} AS je, abs(x - tr) AS re FROM g2 {_WF}),
        me AS (SELECT ch, 'r' AS me, re AS x FROM ft WHERE n >= 11 UNION ALL SELECT ch, 'a', abs(ac) FROM ft WHERE n >= 11 UNION ALL SELECT ch, 'j', abs(je) FROM ft WHERE n >= 11), {_hist('me', 'ch, me', '1e-12', 'm')},
        mm AS (SELECT ch, me, sum(v * c) / sum(c) AS mean FROM mc GROUP BY ALL),
        ms AS (SELECT ch, me, greatest(8 * greatest(sum(abs(v - mean) * c) / sum(c), 0.01 * sqrt(sum((v - mean) * (v - mean) * c) / sum(c)), 1e-12), min(CASE WHEN upto >= CAST(99.9 AS DOUBLE) / 100 * total THEN v END), 1e-12) AS th FROM mc JOIN mm USING (ch, me) GROUP BY ALL),
        tw AS (SELECT ch, max(CASE WHEN me = 'r' THEN th END) AS tr_, max(CASE WHEN me = 'a' THEN th END) AS ta_, max(CASE WHEN me = 'j' THEN th END) AS tj_ FROM ms GROUP BY ch),
        su AS (SELECT episode, ch - 14 AS d, min(CASE WHEN abs(x) > 1e-4 THEN t END) AS first FROM ca WHERE ch >= 14 GROUP BY ALL),
        fl AS (SELECT ft.*, tr_, ta_, tj_, (su.first IS NULL OR ft.t < su.first) AS start, n >= 11 AND re > tr_ AND (abs(ac) > ta_ OR abs(je) > tj_) AND NOT (su.first IS NULL OR ft.t < su.first) AS s1 FROM ft JOIN tw USING (ch) JOIN su ON su.episode = ft.episode AND su.d = ft.ch % 14),
        fb AS (SELECT fl.*, NOT start AND fl.ch % 14 NOT IN (6, 13) AND (x < q01 - 0.15 * (q99 - q01) OR x > q99 + 0.15 * (q99 - q01)) AS band,
                (fl.ch IN (0, 1, 2, 7, 8, 9) AND (x < -2 OR x > 2)) OR (fl.ch IN (3, 4, 5, 10, 11, 12) AND (x < -3.15 OR x > 3.15)) OR (fl.ch IN (6, 13, 20, 27) AND (x < -0.01 OR x > 1)) AS hard3 FROM fl JOIN gq USING (ch)),
        pf AS (SELECT episode, t, any_value(frame_index) AS frame_index, any_value(n) AS n, CAST(sum(CASE WHEN s1 THEN 1 ELSE 0 END) AS BIGINT) AS flagged, {_S1HARD}, bool_or(band OR hard3) AS s3, list(x ORDER BY ch) AS vec FROM fb GROUP BY ALL),
        df AS (SELECT episode, t, ch, tr - lag(tr) OVER w AS d FROM tr {_WF}),
        pd AS (SELECT a.episode, a.t, a.ch, a.d AS ds, b.d AS da FROM df a JOIN df b ON b.episode = a.episode AND b.t = a.t AND b.ch = a.ch + 14 WHERE a.ch < 14 AND a.d IS NOT NULL),
        zz AS (SELECT *, count(*) OVER p AS n, (ds - avg(ds) OVER p) / (stddev_pop(ds) OVER p + 1e-8) AS zs, (da - avg(da) OVER p) / (stddev_pop(da) OVER p + 1e-8) AS za FROM pd WINDOW p AS (PARTITION BY episode, ch)),
        co AS (SELECT a.episode, a.ch, CAST(l AS BIGINT) AS lag, round(sum(a.zs * b.za) / any_value(a.n), 9) AS corr FROM zz a CROSS JOIN range(-5, 6) g(l) JOIN zz b ON b.episode = a.episode AND b.ch = a.ch AND b.t = a.t - l WHERE a.n >= 15 GROUP BY ALL),
        bl AS (SELECT episode, ch, arg_max(lag, (corr, -lag)) AS lag FROM co GROUP BY ALL),
        sc AS (SELECT a.episode, a.ch, CASE WHEN count(*) >= 10 THEN avg(CASE WHEN sign(a.ds) = sign(b.da) THEN 1.0::DOUBLE ELSE 0 END) END AS score FROM pd a JOIN bl USING (episode, ch) JOIN pd b ON b.episode = a.episode AND b.ch = a.ch AND b.t = a.t - bl.lag WHERE abs(a.ds) > 1e-4 AND abs(b.da) > 1e-4 GROUP BY ALL),
        s2 AS (SELECT episode, avg(score) AS da_mean, coalesce(avg(score) < 0.65, false) AS low_mean, coalesce(bool_or(score < 0.65), false) AS low_dim FROM sc GROUP BY episode),
        bd AS (SELECT pf.*, da_mean, coalesce(low_mean, false) AS low_mean, coalesce(low_dim, false) AS low_dim, flagged > 0 OR hx + hr + hs + ha > 0 OR (CASE WHEN coalesce(low_mean OR low_dim, false) THEN true ELSE s3 END) AS bad, vec = lag(vec) OVER e AS still FROM pf LEFT JOIN s2 USING (episode) WINDOW e AS (PARTITION BY episode ORDER BY t)),
        px AS (SELECT *, NOT bool_or(bad) OVER (PARTITION BY episode ORDER BY t) AS pre FROM bd),
        rn AS (SELECT *, sum(CASE WHEN coalesce(still AND pre, false) THEN 0 ELSE 1 END) OVER (PARTITION BY episode ORDER BY t) AS run FROM px),
        kp AS (SELECT *, pre AND row_number() OVER (PARTITION BY episode, run ORDER BY t) > 5 AS s4 FROM rn),
        er AS (SELECT episode, count(*) AS num_frames, CAST(sum(CASE WHEN pre AND NOT s4 THEN 1 ELSE 0 END) AS BIGINT) AS kept_frames, coalesce(min(CASE WHEN NOT (pre AND NOT s4) THEN t END), -1) AS first_abnormal_frame,
                 max(hx + hr + hs + ha) > 0 AS stage1_hard_limit, CAST(sum(flagged) AS BIGINT) AS stage1_flagged, any_value(da_mean) AS stage2_da_mean, CAST(sum(CASE WHEN s3 THEN 1 ELSE 0 END) AS BIGINT) AS stage3_excluded_frames,
                 CAST(sum(CASE WHEN s4 THEN 1 ELSE 0 END) AS BIGINT) AS stage4_removed_frames, max(hx) AS hx, max(hr) AS hr, max(hs) AS hs, max(ha) AS ha, bool_or(low_mean) AS low_mean, bool_or(low_dim) AS low_dim FROM kp GROUP BY episode),
        cr AS (SELECT episode, ch, t, x, t - row_number() OVER (PARTITION BY episode, ch ORDER BY t) AS run FROM fl WHERE s1),
        cj AS (SELECT *, abs(x - lag(x) OVER (PARTITION BY episode, ch, run ORDER BY t)) AS jump FROM cr),
        cl AS (SELECT episode, ch, run, count(*) AS len FROM cj GROUP BY ALL HAVING count(*) >= 20 AND max(jump) >= 0.08),
        c1 AS (SELECT episode, ch, 'sudden_change_cluster_dim' || ch || '_len' || arg_min(len, run) AS reason FROM cl GROUP BY episode, ch),
        ce AS (SELECT episode, count(*) AS clusters FROM c1 GROUP BY episode),
        ez AS (SELECT er.*, coalesce(clusters, 0) AS clusters, NOT (low_mean OR low_dim) AND num_frames - stage3_excluded_frames < 30 AS s3_short FROM er LEFT JOIN ce USING (episode)),
        rs AS (SELECT episode, kept_frames, unnest([CASE WHEN hx > 0 THEN 'hard_limit_state_xyz' END, CASE WHEN hr > 0 THEN 'hard_limit_state_rpy' END, CASE WHEN hs > 0 THEN 'hard_limit_state_gripper' END, CASE WHEN ha > 0 THEN 'hard_limit_action_gripper' END,
                 CASE WHEN low_mean THEN 'stage2:da_episode_mean' END, CASE WHEN low_dim THEN 'stage2:da_low_dims' END, CASE WHEN s3_short THEN 'stage3:remaining_frames' END, CASE WHEN first_abnormal_frame >= 0 THEN 'first_removed_frame' END]) AS reason FROM ez
               UNION ALL SELECT episode, kept_frames, reason FROM c1 JOIN ez USING (episode))"""

_MEDC = "CASE WHEN n <= 2 THEN x WHEN n >= 5 THEN list_sort([" + ", ".join(sql_at("x", k) for k in range(-2, 3)) + "])[3] ELSE list_sort([" + ", ".join(sql_at("x", k) for k in range(-1, 2)) + "])[2] END"


def _avg(w: int) -> str:
    return "(" + " + ".join(sql_at("m", k) for k in range(-(w // 2), w // 2 + 1)) + f") / {w}"


_MAC = "CASE WHEN n <= 2 THEN m WHEN n >= 11 THEN " + _avg(11) + "".join(f" WHEN n >= {w} THEN {_avg(w)}" for w in (9, 7, 5, 3)) + " END"
_FILT = f"""{_FR}, lo AS (SELECT episode, frame_index, t, i AS ch, CAST(a[i + 1] AS DOUBLE) AS x, count(*) OVER (PARTITION BY episode, i) AS n FROM fr, range(20) g(i)),
        me AS (SELECT *, {_MEDC} AS m FROM lo {_WF}), av AS (SELECT *, round(abs(x - ({_MAC})), 9) AS re FROM me {_WF}),
        th AS (SELECT *, greatest(round(avg(re) OVER (PARTITION BY episode, ch) * 5, 9), 1e-6) AS lim FROM av),
        bo AS (SELECT ch, quantile_cont(x, 0.01) AS q1, quantile_cont(x, 0.99) AS q9 FROM lo GROUP BY ch),
        fl AS (SELECT episode, frame_index, bool_or(re > lim) AS s1, bool_or(x < q1 - 0.1 * (q9 - q1) OR x > q9 + 0.1 * (q9 - q1)) AS s3 FROM th JOIN bo USING (ch) GROUP BY ALL),
        cf AS (SELECT episode, frame_index, greatest(0, least(1, least({_at('conf', 0)} * least({', '.join(_at('conf', k) for k in (1, 2, 3))}), {_at('conf', 0)} * greatest({', '.join(_at('conf', k) for k in (1, 2, 3))}), {_at('conf', 4)} * least({', '.join(_at('conf', k) for k in (5, 6, 7))}), {_at('conf', 4)} * greatest({', '.join(_at('conf', k) for k in (5, 6, 7))})))) AS c, conf IS NULL AS none FROM fr),
        ju AS (SELECT episode, frame_index, s1, s3, coalesce(NOT none AND c < 0.15, false) AS cb, s1 OR s3 OR coalesce(NOT none AND c < 0.15, false) AS bad FROM fl JOIN cf USING (episode, frame_index)),
        dr AS (SELECT episode, count(*) AS length, avg(CASE WHEN s1 THEN 1.0::DOUBLE ELSE 0 END) AS a1, avg(CASE WHEN s3 THEN 1.0::DOUBLE ELSE 0 END) AS a3, avg(CASE WHEN cb THEN 1.0::DOUBLE ELSE 0 END) AS ac, avg(CASE WHEN bad THEN 1.0::DOUBLE ELSE 0 END) AS ab FROM ju GROUP BY episode),
        de AS (SELECT episode, length, round(ab, 6) AS bad_frame_ratio, concat_ws(',', CASE WHEN a1 > 0.2 THEN 'sudden_change_high' END, CASE WHEN a3 > 0.2 THEN 'extreme_value_high' END, CASE WHEN ac > 0.2 THEN 'low_confidence' END, CASE WHEN ab > 0.2 THEN 'bad_frame_ratio_high' END) AS reasons FROM dr)"""

_SIX = f"six AS (SELECT episode, frame_index, 0 AS o, {_six('s', 3)} FROM fr UNION ALL SELECT episode, frame_index, 9, {_six('s', 13)} FROM fr)"
_LEFT = f"{_FR}, {_SIX}, {_rotation('six', 's', 'ro')}"
_NINE = "SELECT episode, frame_index, CAST(i + o AS BIGINT) AS i, round(m[i + 1] + 1e-7, 5) AS v FROM mt, range(9) g(i)"
_MAT = "[x1, y1, z1, x2, y2, z2, x3, y3, z3]"
ORACLES = {
    "rot6d_matrix": f"WITH {_LEFT}, mt AS (SELECT episode, frame_index, o, {_MAT} AS m FROM ro) {_NINE}",
    "rot6d_matrix_gs": f"WITH {_FR}, {_SIX}, g1 AS (SELECT *, greatest(sqrt(a * a + b * b + c * c), 1e-8) AS n FROM six), g2 AS (SELECT *, a / n AS x1, b / n AS x2, c / n AS x3 FROM g1), g3 AS (SELECT *, x1 * d + x2 * e + x3 * f AS dp FROM g2), g4 AS (SELECT *, d - dp * x1 AS u1, e - dp * x2 AS u2, f - dp * x3 AS u3 FROM g3), g5 AS (SELECT *, greatest(sqrt(u1 * u1 + u2 * u2 + u3 * u3), 1e-8) AS k FROM g4), g6 AS (SELECT *, u1 / k AS y1, u2 / k AS y2, u3 / k AS y3 FROM g5), mt AS (SELECT episode, frame_index, o, [x1, y1, x2 * y3 - x3 * y2, x2, y2, x3 * y1 - x1 * y3, x3, y3, x1 * y2 - x2 * y1] AS m FROM g6) {_NINE}",
    "canonical14": f"WITH {CANON} SELECT episode, frame_index, CAST(ch AS BIGINT) AS i, round(x + 1e-7, 4) AS v FROM ca WHERE ch < 14",
    "rotation_checks": f"WITH {_LEFT}, ch AS (SELECT episode, greatest(abs(x1 * x1 + y1 * y1 + z1 * z1 - 1), abs(x2 * x2 + y2 * y2 + z2 * z2 - 1), abs(x3 * x3 + y3 * y3 + z3 * z3 - 1), abs(x1 * x2 + y1 * y2 + z1 * z2), abs(x1 * x3 + y1 * y3 + z1 * z3), abs(x2 * x3 + y2 * y3 + z2 * z3)) AS e, x1 * (y2 * z3 - z2 * y3) - y1 * (x2 * z3 - z2 * x3) + z1 * (x2 * y3 - y2 * x3) AS d FROM ro) SELECT episode, round(max(e), 5) AS max_error, round(min(d), 5) AS min_det, round(max(d), 5) AS max_det FROM ch GROUP BY episode",
    "quat_matrix": f"WITH {_QM} {_unnest('qm', 'm')}",
    "matrix_quat": f"WITH {_QM}, bg AS (SELECT episode, frame_index, [w, x, y, z] AS q0 FROM qm), si AS (SELECT episode, frame_index, q0, list_max([(round(abs(v), 6), sign(v)) FOR v IN q0]) AS b FROM bg), qs AS (SELECT episode, frame_index, [v * b[2] FOR v IN q0] AS q FROM si) {_unnest('qs', 'q')}",
    "pose_validity": f"WITH {_KP} SELECT episode, frame_index, coalesce({_POSE_OK}, false) AS pose_ok, {_valid('l')} AS left_ok, {_valid('r')} AS right_ok FROM kp",
    "rigid_inverse": f"WITH {_QM}, iv AS (SELECT episode, frame_index, {_INV} AS inv FROM qm) {_unnest('iv', 'inv')}",
    "first_frame_align": f"WITH {_QM}, fw AS (SELECT episode, frame_index, l, r, {_INV} AS inv FROM qm WHERE joint_frame = 'world'), f0 AS (SELECT *, first_value(inv) OVER (PARTITION BY episode ORDER BY frame_index) AS g FROM fw), " + ", ".join(f"a{v} AS (SELECT episode, frame_index, {base} AS o, [" + ", ".join(f"g[{4 * k + 1}] * {_at(v, 0)} + g[{4 * k + 2}] * {_at(v, 1)} + g[{4 * k + 3}] * {_at(v, 2)} + g[{4 * k + 4}]" for k in range(3)) + f"] AS x FROM f0 WHERE len({v}) >= 3 AND {_valid(f'{v}[1:3]')})" for v, base in (("l", 0), ("r", 3))) + " SELECT episode, frame_index, CAST(i + o AS BIGINT) AS i, round(x[i + 1] + 1e-7, 5) AS v FROM (SELECT * FROM al UNION ALL SELECT * FROM ar), range(3) h(i)",
    "retarget_gripper": f"WITH {_RET} SELECT episode, frame_index, CAST(i + o AS BIGINT) AS i, round(act[i + 1] + 1e-7, 5) AS v FROM re, range(10) g(i)",
    "project_points": f"WITH {_KP}, " + ", ".join(f"a{v} AS (SELECT episode, frame_index, {base} AS o, [736.6339::DOUBLE * {_at(v, 0)} / {_at(v, 2)} + 960, 736.6339::DOUBLE * {_at(v, 1)} / {_at(v, 2)} + 540] AS x FROM kp WHERE joint_frame = 'world' AND {_valid(f'{v}[1:3]')} AND {_at(v, 2)} > 1e-4)" for v, base in (("l", 0), ("r", 2))) + " SELECT episode, frame_index, CAST(i + o AS BIGINT) AS i, round(x[i + 1] + 1e-7, 3) AS v FROM (SELECT * FROM al UNION ALL SELECT * FROM ar), range(2) h(i)",
    "confidence_pair": f"WITH {_FILT} SELECT episode, frame_index, round(c, 5) AS confidence FROM cf WHERE NOT none",
    "hard_limits": f"WITH {CANON}, pf AS (SELECT episode, t, {_S1HARD} FROM ca GROUP BY ALL) SELECT CAST(0 AS BIGINT) AS hard_state_joint, CAST(0 AS BIGINT) AS hard_action_joint, CAST(sum(hx) AS BIGINT) AS hard_state_xyz, CAST(sum(hr) AS BIGINT) AS hard_state_rpy, CAST(sum(hs) AS BIGINT) AS hard_state_gripper, CAST(sum(ha) AS BIGINT) AS hard_action_gripper FROM pf",
    "global_frame_stats": f"WITH {_GSTAT} SELECT CAST(ch AS BIGINT) AS channel, round(q01, 3) AS q01, round(q99, 3) AS q99, CAST(n AS BIGINT) AS n FROM gq",
    "static_removed": f"WITH {_FR}, st AS (SELECT *, coalesce(s = lag(s) OVER e AND a = lag(a) OVER e, false) AS still FROM fr WINDOW e AS (PARTITION BY episode ORDER BY t)), rn AS (SELECT *, sum(CASE WHEN still THEN 0 ELSE 1 END) OVER (PARTITION BY episode ORDER BY t) AS run FROM st), rm AS (SELECT *, row_number() OVER (PARTITION BY episode, run ORDER BY t) > 5 AS rm FROM rn) SELECT * FROM (SELECT episode, count(*) AS n_frames, CAST(sum(CASE WHEN rm THEN 1 ELSE 0 END) AS BIGINT) AS n_removed FROM rm GROUP BY episode) WHERE n_removed > 0",
    "quality_results": f"WITH {_QUAL} SELECT episode, num_frames, kept_frames, first_abnormal_frame, stage1_hard_limit, stage1_flagged, round(stage2_da_mean, 5) AS stage2_da_mean, stage3_excluded_frames, stage4_removed_frames, CAST(clusters + hx + hr + hs + ha + CASE WHEN low_mean THEN 1 ELSE 0 END + CASE WHEN low_dim THEN 1 ELSE 0 END + CASE WHEN s3_short THEN 1 ELSE 0 END + CASE WHEN first_abnormal_frame >= 0 THEN 1 ELSE 0 END AS BIGINT) AS n_reasons FROM ez",
    "quality_report": f"WITH {_QUAL} SELECT count(*) AS episodes, CAST(0 AS BIGINT) AS discarded, count(*) AS kept_episodes, CAST(sum(num_frames) AS BIGINT) AS frames, CAST(sum(kept_frames) AS BIGINT) AS kept_frames, CAST(sum(stage1_flagged) AS BIGINT) AS stage1_flagged, CAST(sum(stage3_excluded_frames) AS BIGINT) AS stage3_excluded_frames, CAST(sum(stage4_removed_frames) AS BIGINT) AS stage4_removed_frames, CAST(sum(CASE WHEN kept_frames < 30 THEN 1 ELSE 0 END) AS BIGINT) AS low_valid_prefix, round(avg(stage2_da_mean), 5) AS da_mean, round(min(stage2_da_mean), 5) AS da_min, round(max(stage2_da_mean), 5) AS da_max, count(CASE WHEN stage2_da_mean < 0.7 THEN 1 END) AS da_below_07, 0.0::DOUBLE AS discard_rate, round(sum(kept_frames) / sum(num_frames)::DOUBLE, 5) AS frame_keep_rate FROM ez",
    "discard_reason_counts": f"WITH {_QUAL} SELECT reason, count(*) AS n FROM rs WHERE reason IS NOT NULL GROUP BY reason",
    "discarded_reason_counts": f"WITH {_QUAL} SELECT reason, count(*) AS n FROM (SELECT reason FROM rs WHERE reason IS NOT NULL AND kept_frames < 60 UNION ALL SELECT 'kept_frames' FROM ez WHERE kept_frames < 60) GROUP BY reason",
    "episode_decision": f"WITH {_FILT} SELECT *, reasons = '' AS keep_episode FROM de",
    "filter_flagged": f"WITH {_FILT} SELECT * FROM (SELECT episode, CAST(sum(CASE WHEN s1 THEN 1 ELSE 0 END) AS BIGINT) AS stage1, CAST(sum(CASE WHEN s3 THEN 1 ELSE 0 END) AS BIGINT) AS stage3, CAST(sum(CASE WHEN cb THEN 1 ELSE 0 END) AS BIGINT) AS low_confidence, CAST(sum(CASE WHEN bad THEN 1 ELSE 0 END) AS BIGINT) AS bad FROM ju GROUP BY episode) WHERE bad > 0",
    "extreme_bounds": f"WITH {_FILT} SELECT CAST(ch AS BIGINT) AS channel, round(q1 - 0.1 * (q9 - q1), 5) AS lower, round(q9 + 0.1 * (q9 - q1), 5) AS upper FROM bo",
    "semi_keep_episodes": f"WITH {_FILT} SELECT corpus, count(DISTINCT episode_index) AS n_episodes FROM episodes WHERE episode_index IN (SELECT episode FROM de WHERE reasons = '') GROUP BY corpus",
    "task_reindex": "WITH fa AS (SELECT t.task_name AS task, min(episode_index) AS o FROM episodes e JOIN tasks t USING (task_index) GROUP BY 1) SELECT task, CAST(row_number() OVER (ORDER BY o, task) - 1 AS BIGINT) AS new_index FROM fa",
    "episode_meta": "WITH n AS (SELECT episode_index, count(DISTINCT frame_index) AS length FROM frames GROUP BY 1), t AS (SELECT episode_index, list_sort(list(DISTINCT task_name) FILTER (task_name IS NOT NULL)) AS tasks FROM episodes GROUP BY 1) SELECT episode_index, length, CAST(coalesce(len(tasks), 0) AS BIGINT) AS n_tasks, coalesce(array_to_string(tasks, '|'), '') AS tasks FROM n LEFT JOIN t USING (episode_index)",
    "alignment_verify": """WITH f AS (SELECT episode_index, count(*) AS n, count(DISTINCT frame_index) AS d, min(frame_index) AS lo, max(frame_index) AS hi, min("index" - frame_index) AS i0, max("index" - frame_index) AS i1, max(coalesce(CASE WHEN abs(CAST("timestamp" AS DOUBLE) - frame_index / 30.0::DOUBLE) > 1e-4 THEN 1 ELSE 0 END, 0)) AS t FROM frames GROUP BY 1),
        e AS (SELECT episode_index, max(length) AS length FROM episodes GROUP BY 1), x AS (SELECT episode_index, coalesce(sum(n) OVER (ORDER BY episode_index ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS expected FROM f JOIN e USING (episode_index)),
        j AS (SELECT * FROM e FULL JOIN f USING (episode_index) LEFT JOIN x USING (episode_index))
        SELECT episode_index, 'missing_frames' AS issue FROM j WHERE n IS NULL UNION ALL SELECT episode_index, 'length' FROM j WHERE length <> n UNION ALL SELECT episode_index, 'frame_index' FROM j WHERE lo <> 0 OR hi - lo + 1 <> d
        UNION ALL SELECT episode_index, 'global_index' FROM j WHERE i0 <> expected OR i1 <> expected
        UNION ALL SELECT episode_index, 'timestamp' FROM j WHERE t = 1 UNION ALL SELECT episode_index, 'duplicate_frame' FROM j WHERE d < n
        UNION ALL SELECT -1, 'total_frames' FROM (SELECT count(*) AS n FROM frames) WHERE n <> 1000000 UNION ALL SELECT -1, 'total_episodes' FROM (SELECT count(*) AS n FROM e) WHERE n <> 1000""",

    "exported_frames": "WITH d AS (SELECT DISTINCT episode_index, frame_index FROM frames) SELECT CAST(dense_rank() OVER (ORDER BY episode_index) - 1 AS BIGINT) AS episode_index, CAST(row_number() OVER (PARTITION BY episode_index ORDER BY frame_index) - 1 AS BIGINT) AS frame_index, CAST(row_number() OVER (ORDER BY d.episode_index, d.frame_index) - 1 AS BIGINT) AS index, round(CAST(CAST((row_number() OVER (PARTITION BY d.episode_index ORDER BY d.frame_index) - 1) / 30.0::DOUBLE AS FLOAT) AS DOUBLE), 4) AS \"timestamp\" FROM d",
    "orphan_episodes": "SELECT DISTINCT episode_index FROM episodes WHERE episode_index NOT IN (SELECT episode_index FROM frames WHERE episode_index IS NOT NULL)",
    "pooled_frame_agreement": f"WITH {_FR}, fa AS (SELECT * FROM fr WHERE raw IS NOT NULL), fo AS (SELECT episode, row_number() OVER (PARTITION BY episode, i ORDER BY frame_index) AS k, i, CAST(s[i + 1] AS DOUBLE) AS x, CAST(raw[i + 1] AS DOUBLE) AS y FROM fa, range(20) g(i)), df AS (SELECT episode, i, k, x - lag(x) OVER w AS ds, y - lag(y) OVER w AS da FROM fo WINDOW w AS (PARTITION BY episode, i ORDER BY k)), dd AS (SELECT * FROM df WHERE ds IS NOT NULL), sc AS (SELECT a.episode, CAST(l AS BIGINT) AS lag, round(avg(CASE WHEN sign(a.ds) = sign(b.da) THEN 1.0::DOUBLE ELSE 0 END), 12) AS score FROM dd a CROSS JOIN range(-10, 11) h(l) JOIN dd b ON b.episode = a.episode AND b.i = a.i AND b.k = a.k + l GROUP BY ALL) SELECT episode, arg_max(lag, (score, -lag)) AS lag, round(max(score), 6) AS score FROM sc GROUP BY episode",
}
ORACLES["filter_flagged_cap"] = f"WITH {_FILT} SELECT episode, frame_index, s1 AS stage1, s3 AS stage3, cb AS low_confidence FROM (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY frame_index) AS i FROM ju WHERE bad) WHERE i <= 200"
