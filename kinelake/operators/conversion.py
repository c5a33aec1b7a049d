"""Conversion of raw hand tracking to gripper actions: poses of cameras and end effectors, smoothing, validity, manifests.

Plan: all per-frame geometry is Column arithmetic; smoothing along time adds one shuffle by episode, shared by all its
windows; masks, rejections and manifests are one aggregation.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from kinelake.functions import geometry as g
from kinelake.functions import timeseries as ts
from kinelake.functions.timeseries import Axis

#: Joints of the gripper in a hand of 21: thumb, index and middle tip, wrist.
GRIPPER_JOINTS = (4, 8, 12, 0)
HANDS = (("left", -1), ("right", 1))


# ----------------------------------------------------------------------- poses


def slam_pose(quaternion: Column, translation: Column, body_to_camera: Column) -> Column:
    """The camera's pose in the world: inverse of (camera from body) x (body from world); wxyz quaternion."""
    body = g.let(g.wxyz_to_matrix(quaternion), lambda r: g.pose(g.items(r, 9), g.items(translation, 3)))
    return g.rigid_inverse(g.compose(body_to_camera, body))


def to_current_camera(first: Column, now: Column) -> Column:
    """The transform from the first camera's coordinates to the current one's."""
    return g.compose(g.rigid_inverse(now), first)


def end_effector_pose(end: Column, effector: Column) -> Column:
    """14 canonical numbers from end effectors (xyz and xyzw quaternion, twice) and two gripper openings."""
    one = lambda s, k: F.concat(g.vector(g.items(end, 3, s)), g.matrix_to_euler(g.xyzw_to_matrix(end, s + 3)), F.array(g.item(effector, k)))
    return F.concat(one(0, 0), one(7, 1))


def reference_from_camera(camera_in_world: Column) -> Column:
    """What expresses poses in the camera's coordinates: its inverse pose."""
    return g.rigid_inverse(camera_in_world)


def reference_from_calibration(arm_in_camera: Column) -> Column:
    """The same for a calibration that maps the arm's points into the camera."""
    return g.rigid_inverse(g.rigid_inverse(arm_in_camera))


def with_calibration(episodes: DataFrame, calibration: DataFrame, key: str) -> DataFrame:
    """Adds ``arm_in_camera`` (16) from calibration rows (episode_index, extrinsic_key, matrix); an episode without the key is
    an error when it is used, so it is marked in ``calibration_missing``."""
    one = calibration.where(F.col("extrinsic_key") == key).groupBy("episode_index").agg(F.first("matrix").alias("arm_in_camera"))
    return episodes.join(one, "episode_index", "left").withColumn("calibration_missing", F.col("arm_in_camera").isNull())


def with_source(episodes: DataFrame, sources: DataFrame) -> DataFrame:
    """Episodes with the row of the source map, nulls where there is none."""
    return episodes.join(sources, "episode_index", "left")


def confidence_stack(confidence: Column, width: int = 8) -> Column:
    """``width`` columns as an array; a joint that is missing counts 0."""
    return F.array(*[F.coalesce(F.get(confidence, F.lit(k)).cast("double"), F.lit(0.0)) for k in range(width)])


# ------------------------------------------------------------------- smoothing


def smooth_quaternions(df: DataFrame, axis: Axis, column: str, out: str, sigma: float = 2.0) -> DataFrame:
    """Gaussian mean of the quaternions within round(3 sigma) rows, each turned to the hemisphere of the row's own, made
    unit length; at the ends of a series the window is cut off.  ``sigma`` 0 changes nothing."""
    if sigma <= 0:
        return df.withColumn(out, F.col(column))
    radius = max(1, round(3 * sigma))
    for k in range(-radius, radius + 1):
        value = F.col(column) if k == 0 else F.lead(column, k).over(axis.rows) if k > 0 else F.lag(column, -k).over(axis.rows)
        df = df.withColumn(f"_q{k + radius}", value)

    def turned(k):
        weight = math.exp(-0.5 * (k / sigma) ** 2)
        near, own = F.col(f"_q{k + radius}"), F.col(column)
        sign = F.when(g.dot(g.items(near, 4), g.items(own, 4)) < 0, -weight).otherwise(weight)
        return F.when(near.isNotNull(), F.transform(near, lambda v: v * sign)).otherwise(F.array(*[F.lit(0.0)] * 4))

    df = df.withColumn("_parts", F.array(*[turned(k) for k in range(-radius, radius + 1)]))
    summed = F.aggregate("_parts", F.array(*[F.lit(0.0)] * 4), lambda a, v: F.zip_with(a, v, lambda x, y: x + y))
    mean = g.let(summed, lambda s: g.let(F.greatest(g.norm(g.items(s, 4)), F.lit(1e-12)), lambda n: F.transform(s, lambda x: x / n)))
    return df.withColumn(out, mean).drop("_parts", *[f"_q{k}" for k in range(2 * radius + 1)])


def smooth_gripper(df: DataFrame, axis: Axis, position: str, rotation: str, width: str, window: int = 11, order: int = 2, sigma: float = 2.0) -> DataFrame:
    """Smoothed ``position``, ``rotation`` and ``width`` in place: Savitzky-Golay (shrinking with short series) for the
    numbers, the Gaussian quaternion mean for the rotation."""
    names = [f"_p{k}" for k in range(3)]
    df = df.withColumns({n: F.get(F.col(position), F.lit(k)) for k, n in enumerate(names)} | {"_q": g.matrix_to_wxyz(F.col(rotation))})
    for n in [*names, width]:
        df = ts.savgol_shrinking(df, axis, n, n, window, order)
    df = smooth_quaternions(df, axis, "_q", "_q", sigma)
    return df.withColumn(position, F.array(*names)).withColumn(rotation, g.wxyz_to_matrix(F.col("_q"))).drop("_q", *names)


# ---------------------------------------------------------------------- step 1


def gripper_frames(keypoints: DataFrame, smooth: bool = True) -> DataFrame:
    """(episode, frame_index, left_keypoints_valid, right_keypoints_valid, camera_pose_valid, left_gripper_valid,
    right_gripper_valid, keep, action_raw, action): both hands as virtual grippers in the coordinates of the episode's first
    head pose, 20 numbers each.

    ``keypoints`` has (episode, frame_index, left_keypoints, right_keypoints, p), each frame once, world coordinates.  ``keep``
    is the conjunction of the five masks.  Where a first head pose, a joint or a gripper is not valid the action is null
    and takes no part in smoothing."""
    axis = Axis(("episode",), ("frame_index",))
    first = F.first(F.when(g.pose7_valid(F.col("p")), F.col("p"))).over(Window.partitionBy("episode").orderBy("frame_index").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    # Generators, so that what several expressions read is computed once instead of copied into each of them.
    bound = lambda df, value, name: df.select("*", F.explode_outer(F.array(value)).alias(name))
    df = keypoints.withColumn("_first", first)
    df = bound(df, F.when(F.col("_first").isNotNull(), g.rigid_inverse(g.head_pose(F.col("_first")))), "_ref")
    valid = {f"{h}_keypoints_valid": g.keypoints_valid(F.col(f"{h}_keypoints")) & F.coalesce(F.size(f"{h}_keypoints") == 63, F.lit(False)) for h, _ in HANDS}
    df = df.withColumns(valid | {"camera_pose_valid": g.pose7_valid(F.col("p"))})
    for h, side in HANDS:
        joints = F.when(F.col(f"{h}_keypoints_valid") & F.col("_ref").isNotNull(), F.array(*[g.move_point(F.col("_ref"), g.items(F.col(f"{h}_keypoints"), 3, 3 * j)) for j in GRIPPER_JOINTS]))
        df = bound(df, joints, f"_{h}")
        hand = g.retarget(*[g.items(F.get(F.col(f"_{h}"), F.lit(k)), 3) for k in range(4)], side)
        df = bound(df, F.when(F.col(f"_{h}").isNotNull(), hand), "_g")
        df = df.withColumns({f"_{h}_position": F.col("_g.position"), f"_{h}_rotation": F.col("_g.rotation"), f"_{h}_width": F.col("_g.width"), f"{h}_gripper_valid": F.coalesce(F.col("_g.valid"), F.lit(False))}).drop("_g", f"_{h}")
    keep = F.lit(True)
    for m in ("left_keypoints_valid", "right_keypoints_valid", "camera_pose_valid", "left_gripper_valid", "right_gripper_valid"):
        keep = keep & F.col(m)
    df = df.withColumn("keep", keep)
    action = lambda: F.when(F.col("left_gripper_valid") & F.col("right_gripper_valid"), F.concat(*[g.gripper_action(F.col(f"_{h}_position"), F.col(f"_{h}_rotation"), F.col(f"_{h}_width")) for h, _ in HANDS]))
    df = df.withColumn("action_raw", action())
    if smooth:
        whole = df.where("action_raw is not null")
        for h, _ in HANDS:
            whole = smooth_gripper(whole, axis, f"_{h}_position", f"_{h}_rotation", f"_{h}_width")
        rest = df.where("action_raw is null").withColumn("action", F.lit(None).cast("array<double>"))
        df = whole.withColumn("action", action()).unionByName(rest)
    return df.select("episode", "frame_index", *valid, "camera_pose_valid", "left_gripper_valid", "right_gripper_valid", "keep", "action_raw", *(["action"] if smooth else []))


def rejected_episodes(step1: DataFrame) -> DataFrame:
    """(episode, n_frames, left_keypoints, right_keypoints, camera_pose, left_gripper, right_gripper, combined): episodes with
    any invalid frame, and how many frames of each mask are."""
    gone = lambda m: F.sum((~F.col(m)).cast("long"))
    return step1.groupBy("episode").agg(F.count("*").alias("n_frames"), gone("left_keypoints_valid").alias("left_keypoints"), gone("right_keypoints_valid").alias("right_keypoints"), gone("camera_pose_valid").alias("camera_pose"), gone("left_gripper_valid").alias("left_gripper"), gone("right_gripper_valid").alias("right_gripper"), gone("keep").alias("combined")).where("combined > 0")


def manifest(step1: DataFrame) -> DataFrame:
    """One row: episodes, frames, valid frames per mask, episodes without a valid frame."""
    n = lambda m: F.coalesce(F.sum(F.col(m).cast("long")), F.lit(0))
    per = step1.groupBy("episode").agg(F.count("*").alias("frames"), *[n(m).alias(m) for m in ("left_keypoints_valid", "right_keypoints_valid", "camera_pose_valid", "keep")])
    total = lambda c: F.coalesce(F.sum(c), F.lit(0))
    return per.agg(F.count("*").alias("episodes"), total("frames").alias("frames"), total("left_keypoints_valid").alias("left_keypoints"), total("right_keypoints_valid").alias("right_keypoints"), total("camera_pose_valid").alias("camera_pose"), total("keep").alias("combined"), F.count(F.when(F.col("keep") == 0, 1)).alias("skipped"))


def aligned_streams(left: DataFrame, right: DataFrame, strict: bool = False) -> DataFrame:
    """Rows of two streams (episode, frame_index, ...) paired by their place in the episode, cut to the shorter one; with
    ``strict`` only episodes whose streams are equally long.  Columns of ``right`` must not clash, but for the keys."""
    place = lambda df: df.withColumn("_at", F.row_number().over(Window.partitionBy("episode").orderBy("frame_index"))).withColumn("_n", F.count("*").over(Window.partitionBy("episode")))
    a, b = place(left), place(right).withColumnRenamed("frame_index", "right_frame").withColumnRenamed("_n", "_m")
    rows = a.join(b, ["episode", "_at"])
    return (rows.where("_n = _m") if strict else rows).withColumn("position", F.col("_at").cast("long") - 1).drop("_at", "_n", "_m")


def fill_invalid(df: DataFrame, axis: Axis, column: str, valid: Column, out: str) -> DataFrame:
    """Invalid points take the last valid one, a leading gap the first; in a series without any valid point they stay, with 0
    for what is not finite."""
    df = df.withColumn("_v", F.when(valid, F.col(column)))
    filled = F.coalesce(F.last("_v", ignorenulls=True).over(axis.so_far), F.first("_v", ignorenulls=True).over(axis.whole))
    finite = F.transform(F.col(column), lambda x: F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x.cast("double")))
    return df.withColumn(out, F.coalesce(filled.cast("array<double>"), finite)).drop("_v")
