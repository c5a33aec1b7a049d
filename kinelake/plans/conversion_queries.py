"""Registered queries of the conversion steps, of datasets and of the analysis of verdicts."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kinelake.functions import geometry as g, text
from kinelake.functions.deliveries import once
from kinelake.functions.timeseries import Axis, savgol_taps
from kinelake.operators import analysis, conversion, episode_filter, export, pipeline, quality
from kinelake.plans.frame_queries import _FILT, _FR, _INV, _KP, _POSE_OK, _QM, _QUAL, CANON, STRICT, _at, _cells, _frames, _poses, _states, _unnest, _valid
from kinelake.sources import raw, read_table
from kinelake.session import materialise
from kinelake.sources.raw import match_manifest, without_archives

EPISODE = Axis(("episode",), ("frame_index",))
#: A camera mounted a quarter turn about z, at (0.1, 0.2, 0.3), for the queries on camera poses.
MOUNT = (0.0, -1.0, 0.0, 0.1, 1.0, 0.0, 0.0, 0.2, 0.0, 0.0, 1.0, 0.3, 0.0, 0.0, 0.0, 1.0)


def _literal(values) -> F.col:
    return F.array(*[F.lit(float(v)) for v in values])


def _usable(spark, root) -> DataFrame:
    return _poses(spark, root).where(g.pose7_valid(F.col("p")))


# Poses and smoothing ---------------------------------------------------------------


def quat_smooth(spark, root):
    """Head rotations, smoothed along the episode."""
    unit = g.let(g.norm(g.items(F.col("p"), 4, 3)), lambda n: g.vector([x / n for x in g.items(F.col("p"), 4, 3)]))
    return _cells(conversion.smooth_quaternions(_usable(spark, root).withColumn("q", unit), EPISODE, "q", "s"), "s")


def slam_pose(spark, root):
    """Camera poses of a camera mounted on the head."""
    r = _usable(spark, root)
    return _cells(r.withColumn("c", conversion.slam_pose(F.slice("p", 4, 4), F.slice("p", 1, 3), _literal(MOUNT))), "c")


def camera_relative(spark, root):
    """From the first head pose of the episode to each."""
    r = _usable(spark, root).withColumn("t", g.head_pose(F.col("p")))
    r = r.withColumn("t0", F.first("t").over(Window.partitionBy("episode").orderBy("frame_index")))
    return _cells(r.withColumn("c", conversion.to_current_camera(F.col("t0"), F.col("t"))), "c")


def end_effector_pose(spark, root):
    """Canonical poses of two end effectors: the head's, and its conjugate rotation at the mirrored place."""
    x, y, z, qw, qx, qy, qz = g.items(F.col("p"), 7)
    end = g.vector([x, y, z, qx, qy, qz, qw, -x, -y, -z, -qx, -qy, -qz, qw])
    return _cells(_usable(spark, root).withColumn("e", conversion.end_effector_pose(end, F.array(x, y))), "e", digits=4)


def camera_reference(spark, root):
    """References by camera pose (i from 0) and by calibration (from 16)."""
    r = _usable(spark, root).withColumn("t", g.head_pose(F.col("p")))
    return _cells(r.withColumn("c", F.concat(conversion.reference_from_camera(F.col("t")), conversion.reference_from_calibration(F.col("t")))), "c")


def calibrated_episodes(spark, root):
    """Episodes with the calibration of every third one."""
    e = read_table(spark, root, "episodes").select("episode_index").distinct()
    known = e.where("episode_index % 3 = 0").select("episode_index", F.lit("front").alias("extrinsic_key"), _literal(MOUNT).alias("matrix"))
    return conversion.with_calibration(e, known, "front").select("episode_index", "calibration_missing", F.coalesce(F.get("arm_in_camera", F.lit(3)), F.lit(-1.0)).alias("x"))


def confidence_columns(spark, root):
    """Eight confidences of every frame; what is missing counts 0."""
    rows = once(_frames(spark, root).select(F.col("episode_index").alias("episode"), "frame_index", F.col("`observation.confidence`").alias("c")), ["episode"], ["frame_index"])
    return _cells(rows.withColumn("v", conversion.confidence_stack(F.col("c"))), "v")


def rotation_repair(spark, root):
    """The nearest rotation of a stretched head rotation."""
    r = _usable(spark, root).withColumn("m", g.wxyz_to_matrix(F.col("p"), 3))
    # Written before and after, as a Python function can neither read lambda expressions nor run inside a generator.
    stretched, _ = materialise(r.select("episode", "frame_index", F.transform("m", lambda x: x * 1.3).alias("m")), "rotations")
    repaired, _ = materialise(stretched.select("episode", "frame_index", g.repair_rotation(F.col("m")).alias("r")), "rotations")
    return _cells(repaired, "r")


def fill_invalid_points(spark, root):
    """The left wrist with invalid points filled."""
    r = _poses(spark, root).withColumn("w", F.slice("left_keypoints", 1, 3))
    return _cells(conversion.fill_invalid(r, EPISODE, "w", g.keypoints_valid(F.col("w")), "f"), "f")


# Step 1 -----------------------------------------------------------------------------


def _world(spark, root) -> DataFrame:
    return _poses(spark, root).where("joint_frame = 'world'")


def step1_masks(spark, root):
    """The validity masks of every frame and their conjunction."""
    return conversion.gripper_frames(_world(spark, root), smooth=False).drop("action_raw")


def step1_actions(spark, root):
    """Gripper actions of both hands in the first head pose's coordinates: 20 numbers."""
    return _cells(conversion.gripper_frames(_world(spark, root), smooth=False).where("action_raw is not null"), "action_raw", digits=4)


def step1_smoothed(spark, root):
    """Smoothed positions and widths of both hands (places 0-2 and 9 of each)."""
    c = _cells(conversion.gripper_frames(_world(spark, root)).where("action is not null"), "action", digits=4)
    return c.where((F.col("i") % 10).isin(0, 1, 2, 9))


def step1_rejected(spark, root):
    return conversion.rejected_episodes(conversion.gripper_frames(_world(spark, root), smooth=False))


def step1_manifest(spark, root):
    return conversion.manifest(conversion.gripper_frames(_world(spark, root), smooth=False))


# Datasets ----------------------------------------------------------------------------


def episode_source(spark, root):
    """Episodes with their row of the source map (here: files, and the first of them)."""
    sources = read_table(spark, root, "episode_files").where("episode_index is not null").groupBy("episode_index").agg(F.countDistinct("file_id").alias("n_files"), F.min("file_path").alias("first_file"))
    return conversion.with_source(read_table(spark, root, "episodes").select("episode_index").distinct(), sources)


def stream_pairs(spark, root):
    """Frames and keypoints of an episode paired by place, cut to the shorter stream."""
    a = _states(spark, root).select("episode", "frame_index")
    b = _poses(spark, root).select("episode", "frame_index")
    return conversion.aligned_streams(a, b).select("episode", "position", "frame_index", "right_frame")


def masked_frames(spark, root):
    """Frames with the mask of static frames attached."""
    frames = once(_frames(spark, root).select("episode_index", "frame_index"), ["episode_index"], ["frame_index"])
    masks = quality.stage4(quality.episode_frames(_frames(spark, root))).select("episode", "frame_index", (~F.col("s4_remove")).cast("int").alias("keep"))
    return export.with_validity_mask(frames, masks).groupBy("episode_index").agg(F.count("*").alias("n"), F.sum(F.col("step_validity_mask")[0].cast("long")).alias("n_kept"))


def action_is_state(spark, root):
    """Frames whose action was replaced: the sum of the action per episode."""
    rows = export.action_from_state(_frames(spark, root)).select(F.col("episode_index").alias("episode"), "frame_index", "action")
    rows = once(rows, ["episode"], ["frame_index"])
    total = F.aggregate(F.transform("action", lambda x: x.cast("double")), F.lit(0.0), lambda a, x: a + x)
    return rows.groupBy("episode").agg(F.count("action").alias("n"), F.round(F.sum(total), 2).alias("total"))


def _decisions(spark, root):
    return episode_filter.episode_decisions(episode_filter.judged_frames(_frames(spark, root)))


def filtered_dataset(spark, root):
    """The episodes that the filter keeps, renumbered, with length and tasks."""
    frames = once(_frames(spark, root).select("episode_index", "frame_index", "task_index"), ["episode_index"], ["frame_index"])
    _, episodes, _ = export.filtered_dataset(frames, _decisions(spark, root), read_table(spark, root, "tasks"))
    return episodes.select("episode_index", "length", F.array_join("tasks", "|").alias("tasks"))


def filtered_tasks(spark, root):
    """The tasks of the kept episodes, numbered by first appearance."""
    frames = once(_frames(spark, root).select("episode_index", "frame_index", "task_index"), ["episode_index"], ["frame_index"])
    return export.filtered_dataset(frames, _decisions(spark, root), read_table(spark, root, "tasks"))[2]


def valid_segments(spark, root):
    """Stretches with the left hand on the positive side as episodes of their own."""
    return export.segments(_states(spark, root), F.get("s", F.lit(0)) > 0, 0.9, 4)


def limited_episodes(spark, root):
    """The ten first episodes."""
    return export.first_episodes(_frames(spark, root).select("episode_index", "frame_index").distinct(), 10).groupBy("episode_index").agg(F.count("*").alias("n"))


def strided_frames(spark, root):
    """At most 20 frames an episode."""
    return export.strided(_states(spark, root).select("episode", "frame_index"), 20)


def array_issues(spark, root):
    return export.array_issues(_frames(spark, root), {"observation.state": 20, "action": 20, "observation.confidence": 8, "observation.depth": 1})


def device_times(spark, root):
    """Seconds since the first frame by the device's clock, else by the episode's rate."""
    fps = read_table(spark, root, "episodes").groupBy(F.col("episode_index").alias("episode")).agg(F.max("fps").alias("fps"))
    rows = once(_frames(spark, root).select(F.col("episode_index").alias("episode"), "frame_index", "timestamps"), ["episode"], ["frame_index"]).join(fps, "episode")
    order = Window.partitionBy("episode").orderBy("frame_index")
    seconds = pipeline.device_seconds(F.col("frame_index"), F.col("timestamps"), F.col("fps"), order)
    return rows.select("episode", "frame_index", F.round(seconds.cast("double"), 3).alias("seconds"))


# Names and metadata --------------------------------------------------------------------


def episode_names(spark, root):
    """Path parts, numbers and safe names of episodes."""
    e = read_table(spark, root, "episodes").select("episode_index", "task_name").distinct()
    return e.select("episode_index", text.episode_name(F.col("episode_index")).alias("name"), text.chunk_name(F.col("episode_index"), 100).alias("chunk"), text.safe_name(F.coalesce("task_name", F.lit("no task"))).alias("safe"))


def natural_files(spark, root):
    """Files of an episode in natural order: by folder, then by the number in the name."""
    f = read_table(spark, root, "episode_files").where("file_path is not null").select("episode_index", "file_id", F.regexp_replace("file_path", "part-0*([0-9]+)\\.parquet$", "$1.parquet").alias("path")).distinct()
    i = F.row_number().over(Window.partitionBy("episode_index").orderBy(*text.natural_order(F.col("path")), "file_id"))
    return f.select("episode_index", "file_id", i.cast("long").alias("place"))


def decoded_names(spark, root):
    """Task names that went through bytes padded with NUL."""
    t = read_table(spark, root, "tasks")
    padded = F.encode(F.concat("task_name", F.lit("\0\0\0")), "UTF-8")
    return t.select("task_index", text.decoded(padded).alias("name"))


def task_texts(spark, root):
    """Descriptions of reversible tasks in both directions, with their fallbacks."""
    t = read_table(spark, root, "tasks").select("*", F.explode(F.array(F.lit("1"), F.lit("2"))).alias("direction"))
    kind = F.when(F.col("task_index") % 2 == 0, "Reversible").otherwise("single")
    second = F.when(F.col("task_index") % 4 == 0, F.concat(F.lit("undo "), "task"))
    first = F.when(F.col("task_index") % 3 != 0, F.col("task")).otherwise("")
    return t.select("task_index", "direction", text.task_description(kind, F.col("direction"), first, second, F.col("task_name")).alias("text"))


def intrinsics(spark, root):
    """Intrinsics of 4, 6 and 9 numbers in one layout, scaled to 640 x 480; unknown sizes as -1."""
    base = F.array(*[F.lit(v) for v in raw.DEFAULT_INTRINSICS])
    six = F.concat(base, F.array(F.lit(1920.0), F.lit(1080.0)))
    fx, fy, cx, cy = (F.lit(v) for v in raw.DEFAULT_INTRINSICS)
    nine = F.array(fx, F.lit(0.0), cx, F.lit(0.0), fy, cy, F.lit(0.0), F.lit(0.0), F.lit(1.0))
    v = F.when(F.col("episode_index") % 3 == 0, base).when(F.col("episode_index") % 3 == 1, six).otherwise(nine)
    e = read_table(spark, root, "episodes").select("episode_index").distinct().withColumn("v", text.scaled_intrinsics(text.intrinsics9(v), F.lit(640), F.lit(480)))
    return e.select("episode_index", F.posexplode("v").alias("i", "x")).select("episode_index", F.col("i").cast("long").alias("i"), F.round(F.when(F.isnan("x"), -1.0).otherwise(F.col("x")), 4).alias("x"))


def manifest_match(spark, root):
    """Files found in the manifest by id or by stem, or not at all."""
    e = read_table(spark, root, "episodes").select("episode_index").distinct()
    name = text.episode_name(F.col("episode_index"))
    files = e.select(F.when(F.col("episode_index") % 3 == 0, name).when(F.col("episode_index") % 3 == 1, F.concat(name, F.lit("_arrays"))).otherwise(F.concat(F.lit("x"), name)).alias("stem"))
    manifest = e.select(name.alias("episode_id"), F.concat(name, F.lit("_arrays")).alias("npz_stem"))
    return match_manifest(files, manifest).select("stem", F.coalesce("episode_id", F.lit("")).alias("episode_id"))


def unpacked_only(spark, root):
    """Folders that have no archive."""
    e = read_table(spark, root, "episodes").select("episode_index").distinct().withColumn("name", text.episode_name(F.col("episode_index")))
    return without_archives(e.select("name"), e.where("episode_index % 3 = 0").select("name"))


# Analysis --------------------------------------------------------------------------------


def _flags(spark, root) -> DataFrame:
    masks, thresholds = quality.masks_and_thresholds(_frames(spark, root))
    return analysis.frame_flags(masks, thresholds)


def exceed_frame_counts(spark, root):
    return analysis.exceed_counters(_flags(spark, root))


def truncation_causes(spark, root):
    return analysis.truncation_causes(_flags(spark, root))


def sudden_positions(spark, root):
    """Where sudden frames lie in their episode."""
    return analysis.position_counts(_flags(spark, root), "sudden")


def flagged_dimensions(spark, root):
    """The three channels of each episode that stage 1 flags most."""
    return analysis.flagged_dimensions(quality.keep_masks(_frames(spark, root)), 3)


def dimension_flags(spark, root):
    return analysis.dimension_flags(quality.keep_masks(_frames(spark, root)))


def pipeline_totals(spark, root):
    """What the command line prints, where short prefixes are discarded."""
    return analysis.totals(quality.episode_results(quality.keep_masks(_frames(spark, root), STRICT), STRICT))


QUERIES = {
    f.__name__: f
    for f in (
        quat_smooth, slam_pose, camera_relative, end_effector_pose, camera_reference, calibrated_episodes, confidence_columns, rotation_repair, fill_invalid_points, step1_masks, step1_actions, step1_smoothed, step1_rejected, step1_manifest,
        episode_source, stream_pairs, masked_frames, action_is_state, filtered_dataset, filtered_tasks, valid_segments, limited_episodes, strided_frames, array_issues, device_times, episode_names, natural_files, decoded_names, task_texts, intrinsics,
        manifest_match, unpacked_only, exceed_frame_counts, truncation_causes, sudden_positions, flagged_dimensions, dimension_flags, pipeline_totals,
    )
}

# SQL ---------------------------------------------------------------------------------------

_EULER = lambda m: f"[CASE WHEN abs(greatest(-1, least(1, -{m}[7]))) > 1 - 1e-12 THEN atan2(-{m}[6], {m}[5]) ELSE atan2({m}[8], {m}[9]) END, asin(greatest(-1, least(1, -{m}[7]))), CASE WHEN abs(greatest(-1, least(1, -{m}[7]))) > 1 - 1e-12 THEN 0 ELSE atan2({m}[4], {m}[1]) END]"
_T = [_at("p", k) for k in range(3)]
#: First usable head pose of each world episode: rotation g, position h.
_WORLD = f"{_KP}, wk AS (SELECT * FROM kp WHERE joint_frame = 'world'), fq AS (SELECT episode, arg_min(p, frame_index) AS p FROM wk WHERE {_POSE_OK} GROUP BY episode), fn AS (SELECT episode, p, sqrt({' + '.join(f'{_at("p", k)} * {_at("p", k)}' for k in range(3, 7))}) AS n FROM fq), fu AS (SELECT episode, p, {_at('p', 3)} / n AS w, {_at('p', 4)} / n AS x, {_at('p', 5)} / n AS y, {_at('p', 6)} / n AS z FROM fn), fm AS (SELECT episode, [{', '.join(_T)}] AS h, [1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y), 2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x), 2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)] AS g FROM fu)"
_SEEN = lambda j, c: "(" + " + ".join(f"g[{3 * r + c + 1}] * (CAST(v[{3 * j + r + 1}] AS DOUBLE) - h[{r + 1}])" for r in range(3)) + ")"
#: Both hands as virtual grippers: gy(episode, frame_index, hand, wd, rn, position c, x, y).
_GRIP = f"""{_WORLD}, hv AS (SELECT episode, frame_index, 0 AS hand, -1.0::DOUBLE AS side, l AS v FROM wk UNION ALL SELECT episode, frame_index, 1, 1.0::DOUBLE, r FROM wk),
        pt AS (SELECT hv.episode, frame_index, hand, side, {', '.join(f'{_SEEN(j, c)} AS {n}{c}' for n, j in (('t', 4), ('i', 8), ('m', 12), ('w', 0)) for c in range(3))} FROM hv JOIN fm ON fm.episode = hv.episode WHERE {_valid('v')} AND len(v) = 63),
        fi AS (SELECT *, {', '.join(f'0.7 * i{c} + 0.3 * m{c} AS f{c}' for c in range(3))} FROM pt), ga AS (SELECT *, sqrt((t0 - f0) ** 2 + (t1 - f1) ** 2 + (t2 - f2) ** 2) AS wd FROM fi),
        gz AS (SELECT *, {', '.join(f'side * (t{c} - f{c}) / greatest(wd, 1e-8) AS z{c}' for c in range(3))} FROM ga),
        gr AS (SELECT *, z1 * (f2 - w2) - z2 * (f1 - w1) AS r0, z2 * (f0 - w0) - z0 * (f2 - w2) AS r1, z0 * (f1 - w1) - z1 * (f0 - w0) AS r2 FROM gz), gn AS (SELECT *, sqrt(r0 * r0 + r1 * r1 + r2 * r2) AS rn FROM gr),
        gx AS (SELECT *, r1 / rn * z2 - r2 / rn * z1 AS u0, r2 / rn * z0 - r0 / rn * z2 AS u1, r0 / rn * z1 - r1 / rn * z0 AS u2 FROM gn WHERE wd > 1e-6 AND rn > 1e-6),
        gu AS (SELECT *, sqrt(u0 * u0 + u1 * u1 + u2 * u2) AS un FROM gx), gv AS (SELECT *, u0 / un AS x0, u1 / un AS x1, u2 / un AS x2 FROM gu),
        gy AS (SELECT *, z1 * x2 - z2 * x1 AS y0, z2 * x0 - z0 * x2 AS y1, z0 * x1 - z1 * x0 AS y2 FROM gv),
        ac AS (SELECT a.episode, a.frame_index, {', '.join(f'(a.t{c} + a.f{c}) / 2 AS a{c}' for c in range(3))}, {', '.join(f'a.x{c} AS a{3 + c}, a.y{c} AS a{6 + c}' for c in range(3))}, a.wd AS a9,
                 {', '.join(f'(b.t{c} + b.f{c}) / 2 AS b{c}' for c in range(3))}, {', '.join(f'b.x{c} AS b{3 + c}, b.y{c} AS b{6 + c}' for c in range(3))}, b.wd AS b9 FROM gy a JOIN gy b ON a.episode = b.episode AND a.frame_index = b.frame_index AND a.hand = 0 AND b.hand = 1)"""
_MASKS = f"""{_GRIP}, mk AS (SELECT wk.episode, wk.frame_index, {_valid('l')} AND coalesce(len(l) = 63, false) AS lk, {_valid('r')} AND coalesce(len(r) = 63, false) AS rk, coalesce({_POSE_OK}, false) AS cp, coalesce(a.wd > 1e-6 AND a.rn > 1e-6, false) AS lg, coalesce(b.wd > 1e-6 AND b.rn > 1e-6, false) AS rg
        FROM wk LEFT JOIN gn a ON a.episode = wk.episode AND a.frame_index = wk.frame_index AND a.hand = 0 LEFT JOIN gn b ON b.episode = wk.episode AND b.frame_index = wk.frame_index AND b.hand = 1),
        ms AS (SELECT *, lk AND rk AND cp AND lg AND rg AS keep FROM mk)"""
_GONE = ", ".join(f"CAST(sum(CASE WHEN {m} THEN 0 ELSE 1 END) AS BIGINT) AS {n}" for m, n in (("lk", "left_keypoints"), ("rk", "right_keypoints"), ("cp", "camera_pose"), ("lg", "left_gripper"), ("rg", "right_gripper"), ("keep", "combined")))


def _sql_savgol(w: int) -> str:
    """Savitzky-Golay of order 2 over ``w`` rows of x, edges repeated."""
    half = w // 2
    at = lambda k: "x" if k == 0 else f"CASE WHEN k {'>' if k < 0 else '<='} {-k if k < 0 else f'n - {k}'} THEN {'lag' if k < 0 else 'lead'}(x, {abs(k)}) OVER o ELSE {'first' if k < 0 else 'last'}_value(x) OVER f END"
    return " + ".join(f"({c!r}::DOUBLE) * ({at(k - half)})" for k, c in enumerate(savgol_taps(w, 2)))


_SMOOTHED = "CASE WHEN n <= 4 THEN x " + " ".join(f"WHEN n >= {w} THEN {_sql_savgol(w)}" for w in (11, 9, 7, 5)) + " ELSE x END"
_PLACES = [*[(f"a{k}", k) for k in (0, 1, 2, 9)], *[(f"b{k}", 10 + k) for k in (0, 1, 2, 9)]]
_RADIUS = 6
_DOT = " + ".join(f"a.{c} * b.{c}" for c in "wxyz")
_EU = "cos(e0) AS ca, sin(e0) AS sa, cos(e1) AS cb, sin(e1) AS sb, cos(e2) AS cc, sin(e2) AS sc"
_RPY = ["cc * cb", "cc * sb * sa - sc * ca", "cc * sb * ca + sc * sa", "sc * cb", "sc * sb * sa + cc * ca", "sc * sb * ca - cc * sa", "-sb", "cb * sa", "cb * ca"]
_STAGE5 = f"""{CANON}, ps AS (SELECT episode, frame_index, t, ch - ch % 7 AS base, {', '.join(f'max(CASE WHEN ch % 7 = {k} THEN x END) AS {n}' for k, n in enumerate(('p1', 'p2', 'p3', 'e0', 'e1', 'e2', 'wd')))} FROM ca GROUP BY ALL),
        pa AS (SELECT *, {_EU} FROM ps), pm AS (SELECT *, {', '.join(f'{e} AS m{k}' for k, e in enumerate(_RPY))} FROM pa),
        p0 AS (SELECT episode, p1 AS q1, p2 AS q2, p3 AS q3, {', '.join(f'm{k} AS n{k}' for k in range(9))} FROM pm WHERE base = 0 AND t = 0),
        rl AS (SELECT pm.episode, frame_index, base, wd, {', '.join(f'n{r} * (p1 - q1) + n{3 + r} * (p2 - q2) + n{6 + r} * (p3 - q3) AS d{r}' for r in range(3))}, {', '.join(f'n{r} * m{c} + n{3 + r} * m{3 + c} + n{6 + r} * m{6 + c} AS r{3 * r + c}' for r in range(3) for c in range(3))} FROM pm JOIN p0 ON p0.episode = pm.episode),
        al AS (SELECT episode, frame_index, base, wd, -d2 AS x0, d1 AS x1, d0 AS x2, [-r6, -r7, -r8, r3, r4, r5, r0, r1, r2] AS m FROM rl),
        ag AS (SELECT *, {_EULER('m')} AS e FROM al),
        ou AS (SELECT episode, frame_index, base + k AS i, CASE k WHEN 0 THEN x0 WHEN 1 THEN x1 WHEN 2 THEN x2 WHEN 6 THEN wd ELSE e[k - 2] END AS v, k BETWEEN 3 AND 5 AS angle FROM ag, range(7) g(k)
               UNION ALL SELECT fr.episode, frame_index, 28 + k, CASE k WHEN 0 THEN -n2 WHEN 1 THEN n1 ELSE n0 END / sqrt(n0 * n0 + n1 * n1 + n2 * n2), false FROM fr JOIN p0 ON p0.episode = fr.episode, range(3) g(k))"""
_FLAGS = f"""{_QUAL}, fx AS (SELECT episode, t, any_value(n) AS n, bool_or(n >= 11 AND re > tr_ AND NOT start) AS r, bool_or(n >= 11 AND abs(ac) > ta_ AND NOT start) AS a, bool_or(n >= 11 AND abs(je) > tj_ AND NOT start) AS j, bool_or(s1) AS s FROM fl GROUP BY episode, t),
        ff AS (SELECT fx.*, hx + hr + hs + ha > 0 AS hard, s OR hx + hr + hs + ha > 0 AS bad1, s3 AS bad3, CASE WHEN a AND j THEN 'both_accel_jerk' WHEN a THEN 'accel' WHEN j THEN 'jerk' ELSE 'residual_only' END AS part FROM fx JOIN pf ON pf.episode = fx.episode AND pf.t = fx.t)"""
_KEPT = f"{_FILT}, ks AS (SELECT DISTINCT f.episode_index, f.frame_index, f.task_index FROM frames f JOIN de ON de.episode = f.episode_index AND de.reasons = ''), kn AS (SELECT ks.*, task_name AS task, CAST(dense_rank() OVER (ORDER BY episode_index) - 1 AS BIGINT) AS e FROM ks LEFT JOIN tasks USING (task_index))"
_EP = "e AS (SELECT DISTINCT episode_index FROM episodes)"
_NAME = "'episode_' || lpad(CAST(episode_index AS VARCHAR), 6, '0')"
ORACLES = {
    "quat_smooth": f"WITH {_QM}, qk AS (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY frame_index) AS k FROM qq), sm AS (SELECT a.episode, a.frame_index, {', '.join(f'sum(b.{c} * exp(-0.5 * ((b.k - a.k) / 2.0::DOUBLE) ** 2) * CASE WHEN {_DOT} < 0 THEN -1 ELSE 1 END) AS {c}' for c in 'wxyz')} FROM qk a JOIN qk b ON a.episode = b.episode AND b.k BETWEEN a.k - {_RADIUS} AND a.k + {_RADIUS} GROUP BY ALL), nm AS (SELECT *, sqrt(w * w + x * x + y * y + z * z) AS n FROM sm), ou AS (SELECT episode, frame_index, [w / n, x / n, y / n, z / n] AS s FROM nm) {_unnest('ou', 's')}",
    "slam_pose": f"WITH {_QM}, cm AS (SELECT episode, frame_index, [-m[4], -m[5], -m[6], m[1], m[2], m[3], m[7], m[8], m[9]] AS r, [0.1::DOUBLE - {_T[1]}, 0.2::DOUBLE + {_T[0]}, 0.3::DOUBLE + {_T[2]}] AS t FROM qm), iv AS (SELECT episode, frame_index, [{', '.join(f'r[{c + 1}], r[{c + 4}], r[{c + 7}], -(r[{c + 1}] * t[1] + r[{c + 4}] * t[2] + r[{c + 7}] * t[3])' for c in range(3))}, 0, 0, 0, 1] AS c FROM cm) {_unnest('iv', 'c')}",
    "camera_relative": f"WITH {_QM}, bo AS (SELECT episode, frame_index, m, [{', '.join(_T)}] AS t, first_value(m) OVER w AS m0, first_value([{', '.join(_T)}]) OVER w AS t0 FROM qm WINDOW w AS (PARTITION BY episode ORDER BY frame_index)), re AS (SELECT episode, frame_index, [{', '.join(', '.join(f'm[{r + 1}] * m0[{c + 1}] + m[{r + 4}] * m0[{c + 4}] + m[{r + 7}] * m0[{c + 7}]' for c in range(3)) + f', m[{r + 1}] * (t0[1] - t[1]) + m[{r + 4}] * (t0[2] - t[2]) + m[{r + 7}] * (t0[3] - t[3])' for r in range(3))}, 0, 0, 0, 1] AS c FROM bo) {_unnest('re', 'c')}",
    "end_effector_pose": f"WITH {_QM}, tw AS (SELECT *, [m[1], m[4], m[7], m[2], m[5], m[8], m[3], m[6], m[9]] AS mt FROM qm), ee AS (SELECT episode, frame_index, list_concat([{', '.join(_T)}], {_EULER('m')}, [{_T[0]}], [{', '.join('-' + t for t in _T)}], {_EULER('mt')}, [{_T[1]}]) AS e FROM tw) {_unnest('ee', 'e', 4)}",
    "camera_reference": f"WITH {_QM}, iv AS (SELECT episode, frame_index, list_concat({_INV}, [m[1], m[2], m[3], {_T[0]}, m[4], m[5], m[6], {_T[1]}, m[7], m[8], m[9], {_T[2]}, 0, 0, 0, 1]) AS c FROM qm) {_unnest('iv', 'c')}",
    "calibrated_episodes": f"WITH {_EP} SELECT episode_index, episode_index % 3 <> 0 AS calibration_missing, CASE WHEN episode_index % 3 = 0 THEN 0.1::DOUBLE ELSE -1.0 END AS x FROM e WHERE episode_index IS NOT NULL",
    "confidence_columns": f"WITH {_FR}, cs AS (SELECT episode, frame_index, [{', '.join(f'coalesce({_at("conf", k)}, 0)' for k in range(8))}] AS v FROM fr) {_unnest('cs', 'v')}",
    "fill_invalid_points": f"WITH {_KP}, wp AS (SELECT episode, frame_index, l[1:3] AS w, CASE WHEN {_valid('l[1:3]')} THEN l[1:3] END AS ok FROM kp), fl AS (SELECT episode, frame_index, coalesce(last_value(ok IGNORE NULLS) OVER (PARTITION BY episode ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), first_value(ok IGNORE NULLS) OVER (PARTITION BY episode ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING), [CASE WHEN x IS NULL OR NOT isfinite(x) THEN 0 ELSE x END FOR x IN w]) AS f FROM wp), fd AS (SELECT episode, frame_index, [CAST(x AS DOUBLE) FOR x IN f] AS f FROM fl) {_unnest('fd', 'f')}",
    "step1_masks": f"WITH {_MASKS} SELECT episode, frame_index, lk AS left_keypoints_valid, rk AS right_keypoints_valid, cp AS camera_pose_valid, lg AS left_gripper_valid, rg AS right_gripper_valid, keep FROM ms",
    "step1_actions": f"WITH {_GRIP}, al AS (SELECT episode, frame_index, [{', '.join(f'a{k}' for k in range(10))}, {', '.join(f'b{k}' for k in range(10))}] AS a FROM ac) {_unnest('al', 'a', 4)}",
    "step1_smoothed": f"WITH {_GRIP}, lo AS ({' UNION ALL '.join(f'SELECT episode, frame_index, CAST({i} AS BIGINT) AS i, {c} AS x FROM ac' for c, i in _PLACES)}), nu AS (SELECT *, row_number() OVER (PARTITION BY episode, i ORDER BY frame_index) AS k, count(*) OVER (PARTITION BY episode, i) AS n FROM lo) SELECT episode, frame_index, i, round(({_SMOOTHED}) + 1e-7, 4) AS v FROM nu WINDOW o AS (PARTITION BY episode, i ORDER BY frame_index), f AS (PARTITION BY episode, i ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)",
    "step1_rejected": f"WITH {_MASKS} SELECT * FROM (SELECT episode, count(*) AS n_frames, {_GONE} FROM ms GROUP BY episode) WHERE combined > 0",
    "step1_manifest": f"WITH {_MASKS}, pe AS (SELECT episode, count(*) AS frames, {', '.join(f'sum(CASE WHEN {m} THEN 1 ELSE 0 END) AS {m}' for m in ('lk', 'rk', 'cp', 'keep'))} FROM ms GROUP BY episode) SELECT count(*) AS episodes, CAST(sum(frames) AS BIGINT) AS frames, CAST(sum(lk) AS BIGINT) AS left_keypoints, CAST(sum(rk) AS BIGINT) AS right_keypoints, CAST(sum(cp) AS BIGINT) AS camera_pose, CAST(sum(keep) AS BIGINT) AS combined, count(CASE WHEN keep = 0 THEN 1 END) AS skipped FROM pe",
    "episode_source": f"WITH {_EP}, s AS (SELECT episode_index, count(DISTINCT file_id) AS n_files, min(file_path) AS first_file FROM episode_files GROUP BY 1) SELECT e.episode_index, n_files, first_file FROM e LEFT JOIN s USING (episode_index)",
    "stream_pairs": f"WITH {_FR}, {_KP}, a AS (SELECT episode, frame_index, row_number() OVER (PARTITION BY episode ORDER BY frame_index) - 1 AS k FROM fr), b AS (SELECT episode, frame_index, row_number() OVER (PARTITION BY episode ORDER BY frame_index) - 1 AS k FROM kp) SELECT a.episode, a.k AS position, a.frame_index, b.frame_index AS right_frame FROM a JOIN b ON a.episode = b.episode AND a.k = b.k",
    "masked_frames": f"WITH {_FR}, st AS (SELECT *, coalesce(s = lag(s) OVER e AND a = lag(a) OVER e, false) AS still FROM fr WINDOW e AS (PARTITION BY episode ORDER BY t)), rn AS (SELECT *, sum(CASE WHEN still THEN 0 ELSE 1 END) OVER (PARTITION BY episode ORDER BY t) AS run FROM st), rm AS (SELECT *, row_number() OVER (PARTITION BY episode, run ORDER BY t) > 5 AS rm FROM rn) SELECT episode AS episode_index, count(*) AS n, CAST(sum(CASE WHEN rm THEN 0 ELSE 1 END) AS BIGINT) AS n_kept FROM rm GROUP BY episode",
    "action_is_state": f"WITH {_FR} SELECT episode, count(s) AS n, round(sum(list_sum([CAST(x AS DOUBLE) FOR x IN s])), 2) AS total FROM fr GROUP BY episode",
    "filtered_dataset": f"WITH {_KEPT} SELECT e AS episode_index, count(*) AS length, coalesce(array_to_string(list_sort(list(DISTINCT task) FILTER (task IS NOT NULL)), '|'), '') AS tasks FROM kn GROUP BY e",
    "filtered_tasks": f"WITH {_KEPT}, fa AS (SELECT task, min((e, frame_index)) AS o FROM (SELECT *, row_number() OVER (PARTITION BY e ORDER BY frame_index) AS k FROM kn) WHERE task IS NOT NULL GROUP BY task) SELECT task, CAST(row_number() OVER (ORDER BY o, task) - 1 AS BIGINT) AS task_index FROM fa",
    "valid_segments": f"WITH {_FR}, ok AS (SELECT episode, frame_index, coalesce(s[1] > 0, false) AS ok, avg(CASE WHEN coalesce(s[1] > 0, false) THEN 0.0::DOUBLE ELSE 1 END) OVER (PARTITION BY episode) AS gone FROM fr), ru AS (SELECT *, frame_index - row_number() OVER (PARTITION BY episode ORDER BY frame_index) AS run FROM ok WHERE ok AND gone <= 0.9), sz AS (SELECT *, count(*) OVER (PARTITION BY episode, run) AS size FROM ru) SELECT episode, CAST(dense_rank() OVER (PARTITION BY episode ORDER BY run) - 1 AS BIGINT) AS segment, frame_index, CAST(row_number() OVER (PARTITION BY episode, run ORDER BY frame_index) - 1 AS BIGINT) AS new_frame FROM sz WHERE size > 4",
    "limited_episodes": "WITH d AS (SELECT DISTINCT episode_index, frame_index FROM frames) SELECT episode_index, count(*) AS n FROM d WHERE episode_index IN (SELECT DISTINCT episode_index FROM frames ORDER BY 1 LIMIT 10) GROUP BY 1",
    "strided_frames": f"WITH {_FR}, nn AS (SELECT *, count(*) OVER (PARTITION BY episode) AS n FROM fr) SELECT episode, frame_index FROM nn WHERE t % greatest(1, CAST(ceil(n / 20.0::DOUBLE) AS BIGINT)) = 0",
    "array_issues": "SELECT 'observation.depth' AS \"column\", 'missing' AS issue, CAST(1 AS BIGINT) AS n UNION ALL " + " UNION ALL ".join(f"SELECT * FROM (SELECT '{c}', CASE WHEN \"{c}\" IS NULL THEN 'null' WHEN len(\"{c}\") <> {w} THEN 'width' END AS issue, count(*) FROM frames GROUP BY 2) WHERE issue IS NOT NULL" for c, w in (("observation.state", 20), ("action", 20), ("observation.confidence", 8))),
    "device_times": "WITH d AS (SELECT DISTINCT ON (episode_index, frame_index) episode_index, frame_index, timestamps FROM frames), f AS (SELECT episode_index, max(fps) AS fps FROM episodes GROUP BY 1), z AS (SELECT *, first_value(timestamps IGNORE NULLS) OVER (PARTITION BY episode_index ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS t0 FROM d) SELECT episode_index AS episode, frame_index, round(CAST(CAST(coalesce((timestamps - t0) / 1e9::DOUBLE, frame_index / CAST(fps AS DOUBLE)) AS FLOAT) AS DOUBLE), 3) AS seconds FROM z JOIN f USING (episode_index)",
    "episode_names": f"SELECT DISTINCT episode_index, {_NAME} AS name, 'chunk-' || lpad(CAST(episode_index // 100 AS VARCHAR), 3, '0') AS chunk, regexp_replace(coalesce(task_name, 'no task'), '[^A-Za-z0-9._-]+', '_', 'g') AS safe FROM episodes",
    "natural_files": r"WITH f AS (SELECT DISTINCT episode_index, file_id, regexp_replace(file_path, 'part-0*([0-9]+)\.parquet$', '\1.parquet') AS path FROM episode_files), k AS (SELECT *, regexp_extract(path, '^(.*)/[^/]*$', 1) AS folder, regexp_extract(path, '([^/]*?)(\.[^./]*)?$', 1) AS stem FROM f) SELECT episode_index, file_id, row_number() OVER (PARTITION BY episode_index ORDER BY folder, CASE WHEN regexp_full_match(stem, '[0-9]{1,18}') THEN CAST(stem AS BIGINT) ELSE 4611686018427387904 END, path, file_id) AS place FROM k",
    "decoded_names": "SELECT task_index, task_name AS name FROM tasks",
    "task_texts": "SELECT task_index, d AS direction, CASE WHEN task_index % 2 = 0 AND d = '2' AND task_index % 4 = 0 THEN 'undo ' || task WHEN task_index % 3 <> 0 THEN task ELSE task_name END AS \"text\" FROM tasks, (VALUES ('1'), ('2')) v(d)",
    "intrinsics": f"WITH {_EP} SELECT episode_index, CAST(i AS BIGINT) AS i, round(CASE WHEN i >= 6 OR (i >= 4 AND episode_index % 3 <> 1) THEN -1 ELSE [736.6339::DOUBLE, 736.6339, 960, 540, 1920, 1080][i + 1] * CASE WHEN episode_index % 3 <> 1 THEN 1 WHEN i % 2 = 0 THEN 640 / 1920.0::DOUBLE ELSE 480 / 1080.0::DOUBLE END END, 4) AS x FROM e, range(9) g(i)",
    "manifest_match": f"WITH {_EP} SELECT CASE episode_index % 3 WHEN 0 THEN {_NAME} WHEN 1 THEN {_NAME} || '_arrays' ELSE 'x' || {_NAME} END AS stem, CASE WHEN episode_index % 3 = 2 THEN '' ELSE {_NAME} END AS episode_id FROM e",
    "unpacked_only": f"WITH {_EP} SELECT {_NAME} AS name FROM e WHERE episode_index % 3 <> 0",
    "exceed_frame_counts": f"WITH {_FLAGS}, ct AS (SELECT {', '.join(f'CAST(sum(CASE WHEN {t} THEN 1 ELSE 0 END) AS BIGINT) AS {n}' for n, t in (('residual_exceed', 'r'), ('accel_exceed', 'a'), ('jerk_exceed', 'j'), ('sudden_combined', 's'), ('sudden_both', 's AND a AND j'), ('sudden_accel', 's AND a AND NOT j'), ('sudden_jerk', 's AND j AND NOT a')))} FROM fx) UNPIVOT ct ON COLUMNS(*) INTO NAME counter VALUE n",
    "truncation_causes": f"WITH {_FLAGS}, fc AS (SELECT episode, arg_min(CASE WHEN hard THEN 'hard_limit' WHEN bad1 AND NOT bad3 THEN part WHEN bad3 AND NOT bad1 THEN 'stage3' ELSE 'stage1_and_stage3' END, t) AS cause FROM ff WHERE bad1 OR bad3 GROUP BY episode) SELECT cause, count(*) AS n_episodes FROM fc GROUP BY cause",
    "sudden_positions": f"WITH {_FLAGS} SELECT CAST(least(floor(t / CAST(greatest(n - 1, 1) AS DOUBLE) * 100), 99) AS BIGINT) AS bin, count(*) AS n FROM fx WHERE s GROUP BY 1",
    "dimension_flags": f"WITH {_QUAL} SELECT CAST(ch AS BIGINT) AS channel, count(*) AS n FROM fl WHERE s1 GROUP BY ch",
    "flagged_dimensions": f"WITH {_QUAL}, fd AS (SELECT episode, CAST(ch AS BIGINT) AS channel, count(*) AS n FROM fl WHERE s1 GROUP BY ALL) SELECT episode, channel, n FROM (SELECT *, row_number() OVER (PARTITION BY episode ORDER BY n DESC, channel) AS i FROM fd) WHERE i <= 3",
    "pipeline_totals": f"WITH {_QUAL} SELECT count(*) AS processed, count(CASE WHEN kept_frames < 60 THEN 1 END) AS discarded, CAST(coalesce(sum(CASE WHEN kept_frames >= 60 THEN kept_frames END), 0) AS BIGINT) AS kept_frames, CAST(sum(num_frames) AS BIGINT) AS total_frames FROM ez",
}
#: The nearest rotation of a stretched rotation is the rotation itself.
ORACLES["rotation_repair"] = f"WITH {_QM} {_unnest('qm', 'm')}"
STAGE5_SQL = f"WITH {_STAGE5} SELECT episode, frame_index, CAST(i AS BIGINT) AS i, CASE WHEN angle AND round(v + 1e-7, 3) <= -3.1415 THEN round(pi(), 3) ELSE round(v + 1e-7, 3) END AS v FROM ou"
ORACLES["stage5_aligned"] = STAGE5_SQL
