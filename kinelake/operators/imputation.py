"""Filling missing values from verified dependencies and from similar records, with a mark on every filled value.

1. *Mining*: for each target and each candidate determinant (a set of attributes) the complete records are grouped by the
   determinant; a dependency is verified when no group holds two values of the target and the groups repeat often enough
   to prove anything.  The verified ones are dictionaries determinant -> value.
2. *Filling*: incomplete records take the value by a left join with the dictionary of the most general verified
   determinant; what that leaves open falls back to the same episode around the same time (the line between the nearest
   measured values), then to the mean of the rig, then of the frame of reference, then of all records.
3. *Provenance*: every joint and flag that was not measured says which step filled it (``dependency``, ``episode``,
   ``rig``, ``reference``, ``overall`` or ``default``).

Plan: one shuffle of the rows by (episode, block of frames).  An episode of several blocks takes one more: what each block
measured first and last per joint is aggregated, a window over one row per block and joint finds the nearest measurement
before and after the block, and these travel with the block's rows as one more row, so a gap of any length is filled as if
the episode were whole.  Dictionaries and means are partial aggregations over small keys; the joins with them carry no
broadcast hint, so Catalyst chooses by size.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kinelake.functions.deliveries import block_of, once
from kinelake.functions.dense import longs, matrix, starts_of, whole_groups
from kinelake.session import materialise

JOINTS = 21
SPAN = 4096
#: Magnitudes from here on are placeholders, not metres.
PLACEHOLDER = 1e8
HANDS = ("left_keypoints", "right_keypoints")
MARKS = ("measured", "dependency", "episode", "rig", "reference", "overall", "default")


# --------------------------------------------------------- dependency mining


def mine_dependencies(records: DataFrame, target: str, determinants: list[list[str]], least_records: int = 20, least_support: float = 2.0) -> DataFrame:
    """(target, determinant, n_groups, n_conflicts, n_records, support, verified) for each candidate determinant.

    Only complete records (target and determinant not null) count.  ``support`` is records per group: a determinant that
    is almost a key is consistent by accident and is not verified below ``least_support``.  No complete record: not
    verified."""
    out = None
    for names in determinants:
        complete = records.where(F.col(target).isNotNull())
        for c in names:
            complete = complete.where(F.col(c).isNotNull())
        groups = complete.groupBy(*names).agg(F.count("*").alias("n"), F.min(target).alias("lo"), F.max(target).alias("hi"))
        one = groups.agg(F.count("*").alias("n_groups"), F.coalesce(F.sum((F.col("lo") != F.col("hi")).cast("long")), F.lit(0)).alias("n_conflicts"), F.coalesce(F.sum("n"), F.lit(0)).alias("n_records"))
        one = one.select(F.lit(target).alias("target"), F.lit(",".join(names)).alias("determinant"), "*")
        out = one if out is None else out.unionByName(one)
    support = F.col("n_records") / F.greatest(F.col("n_groups"), F.lit(1))
    return out.withColumn("support", support).withColumn("verified", (F.col("n_conflicts") == 0) & (F.col("n_records") >= least_records) & (support >= least_support))


def dictionary(records: DataFrame, target: str, names: list[str]) -> DataFrame:
    """determinant -> value over the complete records of a verified dependency."""
    complete = records.where(F.col(target).isNotNull())
    for c in names:
        complete = complete.where(F.col(c).isNotNull())
    return complete.groupBy(*names).agg(F.min(target).alias("_filled"))


def fill_by_dependency(records: DataFrame, target: str, determinants: list[list[str]]) -> tuple[DataFrame, list[str] | None]:
    """Adds ``_filled`` (null where nothing applies) by the most general verified determinant; that determinant is returned.

    The choice needs one row per candidate on the driver, whatever the data's size."""
    mined = [r for r in mine_dependencies(records, target, determinants).collect() if r["verified"]]
    if not mined:
        return records.withColumn("_filled", F.lit(None).cast(records.schema[target].dataType)), None
    names = min(mined, key=lambda r: (r["n_groups"], r["determinant"]))["determinant"].split(",")
    return records.join(dictionary(records, target, names), names, "left"), names


# ------------------------------------------------------------------- keypoints


def pose_usable(pose: Column) -> Column:
    """Finite, non-zero position and quaternion, quaternion close to unit length; false for null or short lists."""
    p = F.transform(pose, lambda x: x.cast("double"))
    fine = F.forall(p, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < PLACEHOLDER))
    norm = F.sqrt(F.aggregate(F.slice(p, 4, 4), F.lit(0.0), lambda a, x: a + x * x))
    return F.coalesce((F.size(pose) == 7) & fine & (F.abs(norm - 1) < 0.2), F.lit(False))


def _measured(x: np.ndarray, wrist: np.ndarray) -> np.ndarray:
    """(n, 21) from (n, 21, 3): finite, no placeholder, and not the origin unless it is the wrist's own place."""
    with np.errstate(invalid="ignore"):
        fine = np.isfinite(x).all(2) & (np.abs(x) < PLACEHOLDER).all(2)
    zero = (x == 0).all(2)
    ok = fine & ~zero
    ok[:, 0] |= fine[:, 0] & zero[:, 0] & wrist & ok[:, 1:].any(1)
    return ok


#: Slots of a block's carried measurements: the joints of the left hand, of the right hand, the flag.
SLOTS = 2 * JOINTS + 1
EDGES = "episode_index long, block long, slot int, first struct<f:long,x:double,y:double,z:double>, last struct<f:long,x:double,y:double,z:double>"


def _interpolated(x: np.ndarray, ok: np.ndarray, frame: np.ndarray, first: np.ndarray, last: np.ndarray, prev: np.ndarray, next_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Missing joints on the line between the nearest measured ones; at the ends of an episode the nearest.  ``prev`` and
    ``next_`` (rows, joints, 4) are the measurements (frame, x, y, z) nearest to the row's block outside of it, NaN where
    there is none.  Also returns which joints this filled."""
    n = len(x)
    rows = np.arange(n)[:, None]
    before = np.maximum.accumulate(np.where(ok, rows, -1), axis=0)
    after = np.minimum.accumulate(np.where(ok, rows, n)[::-1], axis=0)[::-1]
    before = np.where(before < first[:, None], -1, before)
    after = np.where(after > last[:, None], -1, after)
    i, j = np.nonzero(~ok)
    out, filled = x.copy(), np.zeros(ok.shape, bool)
    if not len(i):
        return out, filled

    def anchor(at, outside):
        inside = np.concatenate([frame[np.maximum(at, 0), None].astype(float), x[np.maximum(at, 0), j]], axis=1)
        return np.where((at >= 0)[:, None], inside, outside[i, j])

    a, b = anchor(before[i, j], prev), anchor(after[i, j], next_)
    a, b = np.where(np.isnan(a), b, a), np.where(np.isnan(b), a, b)
    t = (frame[i] - a[:, 0]) / np.maximum(b[:, 0] - a[:, 0], 1)
    have = ~np.isnan(a[:, 0])
    out[i[have], j[have]] = (a[:, 1:] + (b[:, 1:] - a[:, 1:]) * t[:, None])[have]
    filled[i[have], j[have]] = True
    return out, filled


def _nearest_flag(flag: np.ndarray, first: np.ndarray, last: np.ndarray, prev: np.ndarray, next_: np.ndarray) -> np.ndarray:
    """The last flag (0 or 1, NaN: none) before each row, else the first one after it."""
    n = len(flag)
    rows = np.arange(n)
    known = ~np.isnan(flag)
    before = np.concatenate(([-1], np.maximum.accumulate(np.where(known, rows, -1))[:-1])) if n else rows
    after = np.minimum.accumulate(np.where(known, rows, n)[::-1])[::-1]
    a = np.where(before >= first, flag[np.maximum(before, 0)], prev)
    b = np.where(after <= last, flag[np.minimum(after, n - 1)], next_)
    return np.where(np.isnan(a), b, a)


def _flags(table: pa.Table) -> np.ndarray:
    return table.column("camera_pose_valid").combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False)


def _hand(table: pa.Table, hand: str, reference: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    x = matrix(table.column(hand), JOINTS * 3).reshape(table.num_rows, JOINTS, 3)
    return x, _measured(x, reference == "wrist")


def _references(table: pa.Table) -> np.ndarray:
    return table.column("joint_frame").combine_chunks().fill_null("").to_numpy(zero_copy_only=False)


def _edges(batches):
    """The first and last measurement per block and slot of a batch."""
    point = pa.struct([("f", pa.int64()), *[(c, pa.float64()) for c in "xyz"]])
    for batch in batches:
        table = pa.Table.from_batches([batch])
        episode, block, frame = (longs(table, c) for c in ("episode_index", "block", "frame_index"))
        reference = _references(table)
        rows, slots, values = [], [], []
        for h, hand in enumerate(HANDS):
            x, ok = _hand(table, hand, reference)
            i, j = np.nonzero(ok)
            rows.append(i), slots.append(j + h * JOINTS), values.append(x[i, j])
        flag = _flags(table)
        i = np.flatnonzero(~np.isnan(flag))
        rows.append(i), slots.append(np.full(len(i), SLOTS - 1)), values.append(np.repeat(flag[i, None], 3, axis=1))
        row, slot, value = np.concatenate(rows), np.concatenate(slots), np.concatenate(values)
        if not len(row):
            continue
        order = np.lexsort((frame[row], slot, block[row], episode[row]))
        row, slot, value = row[order], slot[order], value[order]
        start = starts_of(episode[row], block[row], slot)
        end = np.append(start[1:], len(row)) - 1
        packed = lambda at: pa.StructArray.from_arrays([pa.array(frame[row[at]]), *[pa.array(value[at, k]) for k in range(3)]], fields=list(point))
        yield pa.record_batch([pa.array(episode[row[start]]), pa.array(block[row[start]]), pa.array(slot[start].astype(np.int32)), packed(start), packed(end)], names=["episode_index", "block", "slot", "first", "last"])


def _carried(rows: DataFrame) -> DataFrame | None:
    """(episode_index, block, carry) for every block of the episodes that have several: per slot the nearest measurement
    before and after the block.  None if no episode has several blocks."""
    several = rows.groupBy("episode_index").agg(F.min("block").alias("_lo"), F.max("block").alias("_hi")).where("_lo < _hi").select("episode_index")
    several, _ = materialise(several, "long-episodes")
    if several.isEmpty():
        return None
    long = rows.join(several, "episode_index", "left_semi")
    edges = long.select("episode_index", "block", "frame_index", "joint_frame", *HANDS, "camera_pose_valid").mapInArrow(_edges, EDGES)
    edges = edges.groupBy("episode_index", "block", "slot").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    every = long.select("episode_index", "block").distinct().withColumn("slot", F.explode(F.sequence(F.lit(0), F.lit(SLOTS - 1))))
    w = Window.partitionBy("episode_index", "slot").orderBy("block")
    prev = F.last("last", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    next_ = F.first("first", ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))
    near = every.join(edges, ["episode_index", "block", "slot"], "left").select("episode_index", "block", F.struct("slot", prev.alias("prev"), next_.alias("next")).alias("c"))
    return near.groupBy("episode_index", "block").agg(F.collect_list("c").alias("carry"))  # SLOTS entries


def _scan(batches):
    for table in whole_groups(batches, ["episode_index", "block"], rows=5_000):
        frame = longs(table, "frame_index")
        starts = starts_of(longs(table, "episode_index"), longs(table, "block"))
        # A block's carried measurements come as its first row.
        outside = np.full((len(starts), 2, SLOTS, 4), np.nan)
        carry = table.column("carry").combine_chunks()
        own = carry.is_null().to_numpy(zero_copy_only=False)
        opens = np.flatnonzero(~own)
        for k, at in zip(np.searchsorted(starts, opens, "right") - 1, opens):
            for c in carry[int(at)].as_py():
                for side, name in enumerate(("prev", "next")):
                    if c[name]:
                        outside[k, side, c["slot"]] = list(c[name].values())
        n = len(frame)
        seg = np.zeros(n, np.int64)
        seg[starts[1:]] = 1
        seg = np.cumsum(seg)
        first, last = starts[seg], np.append(starts[1:], n)[seg] - 1
        reference = _references(table)
        keep = np.flatnonzero(own)
        columns, names = [], []
        for h, hand in enumerate(HANDS):
            x, ok = _hand(table, hand, reference)
            here = slice(h * JOINTS, (h + 1) * JOINTS)
            y, filled = _interpolated(np.where(ok[:, :, None], x, np.nan), ok, frame, first, last, outside[seg, 0, here], outside[seg, 1, here])
            mark = np.where(ok, 0, np.where(filled, 2, -1))[keep]
            columns += [pa.FixedSizeListArray.from_arrays(pa.array(y[keep].ravel()), JOINTS * 3).cast(pa.list_(pa.float64())), pa.FixedSizeListArray.from_arrays(pa.array(mark.ravel().astype(np.int32)), JOINTS).cast(pa.list_(pa.int32()))]
            names += [hand, f"{hand}_mark"]
        near = _nearest_flag(_flags(table), first, last, outside[seg, 0, -1, 1], outside[seg, 1, -1, 1])[keep]
        columns.append(pa.array(near == 1, pa.bool_(), mask=np.isnan(near)))
        names.append("flag_near")
        rest = table.select(["episode_index", "frame_index", "rig_id", "joint_frame", "pose_ok", "camera_pose_valid"]).take(pa.array(keep)).combine_chunks()
        for batch in rest.to_batches() if len(keep) else ():
            yield pa.RecordBatch.from_arrays([*batch.columns, *columns], names=[*rest.schema.names, *names])


SCANNED = "episode_index long, frame_index long, rig_id string, joint_frame string, pose_ok boolean, camera_pose_valid boolean, left_keypoints array<double>, left_keypoints_mark array<int>, right_keypoints array<double>, right_keypoints_mark array<int>, flag_near boolean"


def scanned(keypoints: DataFrame) -> DataFrame:
    """Rows once per (episode, frame) with a mark per joint: 0 measured, 2 filled along the episode's time, -1 still open;
    ``flag_near`` is the episode's nearest other flag."""
    rows = keypoints.where("episode_index is not null and frame_index is not null").select("episode_index", "frame_index", "rig_id", "joint_frame", *HANDS, "camera_pose_valid", pose_usable(F.col("obs_head_pose")).alias("pose_ok"))
    rows = rows.withColumn("block", block_of(F.col("frame_index"), SPAN))
    carried = _carried(rows)
    none = "array<struct<slot:int,prev:struct<f:bigint,x:double,y:double,z:double>,next:struct<f:bigint,x:double,y:double,z:double>>>"
    placed = rows.withColumn("carry", F.lit(None).cast(none))
    if carried is not None:
        placed = placed.unionByName(carried.withColumn("frame_index", F.col("block") * SPAN - 1), allowMissingColumns=True)
    return once(placed, ["episode_index", "block"], ["frame_index"]).mapInArrow(_scan, SCANNED)


def _joint_rows(rows: DataFrame, hand: str) -> DataFrame:
    """Measured joints in long form: (joint_frame, rig_id, field_name, joint, x, y, z)."""
    at = F.posexplode(f"{hand}_mark").alias("joint", "mark")
    long = rows.select("joint_frame", "rig_id", hand, at).where("mark = 0")
    return long.select("joint_frame", "rig_id", F.lit(hand).alias("field_name"), "joint", *[F.get(F.col(hand), F.col("joint") * 3 + k).alias(c) for k, c in enumerate("xyz")])


def _packed(means: DataFrame, keys: list[str], name: str) -> DataFrame:
    """One row per group: a list of (at, v), at = hand * 63 + joint * 3 + axis (at most 126 entries)."""
    at = F.when(F.col("field_name") == HANDS[0], 0).otherwise(JOINTS * 3) + F.col("joint") * 3
    entry = F.array(*[F.struct((at + k).alias("at"), F.col(c).alias("v")) for k, c in enumerate("xyz")])
    packed = means.groupBy(*keys).agg(F.map_from_entries(F.flatten(F.collect_list(entry))).alias(name))
    return packed


def complete_keypoints(keypoints: DataFrame) -> DataFrame:
    """Complete ``left_keypoints`` and ``right_keypoints`` (63 doubles) and ``camera_pose_valid`` for every (episode_index,
    frame_index), with ``left_keypoints_filled`` and ``right_keypoints_filled`` (21 marks, null where measured) and
    ``camera_pose_valid_filled``.

    A joint counts as missing when its xyz is absent, incomplete, not finite or a placeholder (magnitude from 1e8 on, or
    the origin; for ``joint_frame`` wrist the origin is joint 0's place while the hand has another measured joint).  A row
    delivered several times counts once.  Rows without episode or frame number cannot be placed and are left out; a
    null ``rig_id`` or ``joint_frame`` is a group of its own.  Extra columns are ignored; an empty table gives none."""
    rows, _ = materialise(scanned(keypoints), "keypoints")
    # Joint constants are dependencies (joint_frame, field, joint) -> xyz, verified where all complete records agree.
    long = _joint_rows(rows, HANDS[0]).unionByName(_joint_rows(rows, HANDS[1]))
    stats = long.groupBy("joint_frame", "rig_id", "field_name", "joint").agg(F.count("*").alias("n"), *[f(c).alias(f"{k}_{c}") for c in "xyz" for k, f in (("sum", F.sum), ("min", F.min), ("max", F.max))])
    stats, _ = materialise(stats, "keypoint-means")
    wide = stats.groupBy("joint_frame", "field_name", "joint").agg(F.sum("n").alias("n"), *[f(f"{k}_{c}").alias(f"{k}_{c}") for c in "xyz" for k, f in (("sum", F.sum), ("min", F.min), ("max", F.max))])
    constant = (F.col("n") >= 20) & (F.col("min_x") == F.col("max_x")) & (F.col("min_y") == F.col("max_y")) & (F.col("min_z") == F.col("max_z"))
    mean = [(F.col(f"sum_{c}") / F.col("n")).alias(c) for c in "xyz"]
    key = F.concat(F.lit("="), F.coalesce("joint_frame", F.lit("")))
    rig_key = F.concat(key, F.lit("|"), F.coalesce("rig_id", F.lit("")))
    fixed = _packed(wide.where(constant).select(key.alias("k1"), "field_name", "joint", *mean), ["k1"], "m1")
    by_rig = _packed(stats.select(rig_key.alias("k2"), "field_name", "joint", *mean), ["k2"], "m2")
    by_reference = _packed(wide.select(key.alias("k3"), "field_name", "joint", *mean), ["k3"], "m3")
    overall = wide.groupBy("field_name", "joint").agg(F.sum("n").alias("n"), *[F.sum(f"sum_{c}").alias(f"sum_{c}") for c in "xyz"])
    entries = {(0 if r["field_name"] == HANDS[0] else JOINTS * 3) + r["joint"] * 3 + k: r[c] for r in overall.select("field_name", "joint", *mean).collect() for k, c in enumerate("xyz")}  # at most 126 numbers
    literal = F.map_from_arrays(F.array(*[F.lit(k) for k in entries]).cast("array<int>"), F.array(*[F.lit(float(v)) for v in entries.values()]).cast("array<double>"))
    out = rows.withColumns({"k1": key, "k2": rig_key, "k3": key, "m4": literal})
    for k, table in (("k1", fixed), ("k2", by_rig), ("k3", by_reference)):
        out = out.join(table, k, "left")
    for h, hand in enumerate(HANDS):
        out = _filled_hand(out, hand, h * JOINTS * 3)
    out = out.select("episode_index", "frame_index", "rig_id", "joint_frame", "pose_ok", "camera_pose_valid", "flag_near", *HANDS, *[f"{h}_filled" for h in HANDS])
    return _complete_flag(out, rows)


def _filled_hand(out: DataFrame, hand: str, base: int) -> DataFrame:
    """Puts the first step that has a value into each open joint of ``hand``; ``base`` is its place in the packed means."""

    def has(m, at):
        return F.coalesce(F.map_contains_key(F.col(m), at), F.lit(False))

    def chosen(mark, joint):
        at = (F.lit(base) + joint * 3).cast("int")
        return F.when(mark == 0, 0).when(has("m1", at), 1).when(mark == 2, 2).when(has("m2", at), 3).when(has("m3", at), 4).when(has("m4", at), 5).otherwise(6)

    def value(x, i):
        step = F.get(F.col(f"{hand}_step"), F.floor(i / 3).cast("int"))
        pick = lambda m: F.try_element_at(F.col(m), (F.lit(base) + i).cast("int"))
        return F.when(step.isin(0, 2), x).when(step == 1, pick("m1")).when(step == 3, pick("m2")).when(step == 4, pick("m3")).when(step == 5, pick("m4")).otherwise(F.lit(0.0))

    names = F.array(F.lit(None).cast("string"), *[F.lit(m) for m in MARKS[1:]])
    out = out.withColumn(f"{hand}_step", F.transform(f"{hand}_mark", chosen)).withColumn(hand, F.transform(hand, value))
    return out.withColumn(f"{hand}_filled", F.transform(f"{hand}_step", lambda s: F.get(names, s.cast("int"))))


def _complete_flag(out: DataFrame, rows: DataFrame) -> DataFrame:
    """``camera_pose_valid`` by the verified dependency, else the episode's nearest flag before (then after), else the
    rig's most frequent, else false."""
    complete = rows.select("rig_id", "joint_frame", "episode_index", "pose_ok", "camera_pose_valid")
    mined = [r for r in mine_dependencies(complete, "camera_pose_valid", [["pose_ok"], ["joint_frame"], ["rig_id"], ["episode_index"], ["pose_ok", "rig_id"]]).collect() if r["verified"]]
    names = min(mined, key=lambda r: (r["n_groups"], r["determinant"]))["determinant"].split(",") if mined else None
    if names:
        out = out.join(dictionary(complete, "camera_pose_valid", names), names, "left")
    else:
        out = out.withColumn("_filled", F.lit(None).cast("boolean"))
    usual = complete.where("camera_pose_valid is not null and rig_id is not null").groupBy("rig_id").agg((F.avg(F.col("camera_pose_valid").cast("double")) >= 0.5).alias("_usual"))
    out = out.withColumnRenamed("flag_near", "_near").join(usual, "rig_id", "left")
    mark = F.when(F.col("camera_pose_valid").isNotNull(), None).when(F.col("_filled").isNotNull(), "dependency").when(F.col("_near").isNotNull(), "episode").when(F.col("_usual").isNotNull(), "rig").otherwise("default")
    return out.select("episode_index", "frame_index", "rig_id", "joint_frame", *HANDS, *[f"{h}_filled" for h in HANDS], F.coalesce("camera_pose_valid", "_filled", "_near", "_usual", F.lit(False)).alias("camera_pose_valid"), mark.alias("camera_pose_valid_filled"))


def filled_cases(complete: DataFrame) -> DataFrame:
    """(episode_index, frame_index, field_name, joint) of every mark that :func:`complete_keypoints` set."""
    def marked(hand):
        return F.transform(f"{hand}_filled", lambda m, j: F.when(m.isNotNull(), F.struct(F.lit(hand).alias("field_name"), j.cast("long").alias("joint"))))

    one = [marked(h) for h in HANDS]
    flag = F.array(F.when(F.col("camera_pose_valid_filled").isNotNull(), F.struct(F.lit("camera_pose_valid").alias("field_name"), F.lit(-1).cast("long").alias("joint"))))
    cases = F.array_compact(F.concat(*one, flag))
    return complete.select("episode_index", "frame_index", F.explode(cases).alias("c")).select("episode_index", "frame_index", "c.field_name", "c.joint")


def p3_completed(spark: SparkSession, root: str) -> DataFrame:
    return complete_keypoints(spark.read.parquet(f"{root}/hand_keypoints.parquet"))


def p3_found(spark: SparkSession, root: str) -> DataFrame:
    """The missing joints and flags of ``hand_keypoints``: those the operator filled."""
    return filled_cases(p3_completed(spark, root))


def p3_filled(spark: SparkSession, root: str) -> DataFrame:
    """What was filled: joints with their value and the step that gave it; flags as ``x`` (0 or 1)."""
    done = complete_keypoints(spark.read.parquet(f"{root}/hand_keypoints.parquet"))

    def filled(hand):
        return F.transform(f"{hand}_filled", lambda m, j: F.when(m.isNotNull(), F.struct(F.lit(hand).alias("field_name"), j.cast("long").alias("joint"), m.alias("filled_by"), *[F.round(F.get(F.col(hand), j * 3 + k) + 1e-7, 4).alias(c) for k, c in enumerate("xyz")])))

    none = F.lit(None).cast("double")
    flag = F.array(F.when(F.col("camera_pose_valid_filled").isNotNull(), F.struct(F.lit("camera_pose_valid").alias("field_name"), F.lit(-1).cast("long").alias("joint"), F.col("camera_pose_valid_filled").alias("filled_by"), F.col("camera_pose_valid").cast("double").alias("x"), none.alias("y"), none.alias("z"))))
    return done.select("episode_index", "frame_index", F.explode(F.array_compact(F.concat(*[filled(h) for h in HANDS], flag))).alias("c")).select("episode_index", "frame_index", "c.*")


QUERIES = {"p3_found": p3_found, "p3_completed": p3_completed, "p3_filled": p3_filled}
_MEASURED = """k AS (SELECT DISTINCT ON (episode_index, frame_index) * FROM hand_keypoints),
        h AS (
          SELECT episode_index, frame_index, rig_id, joint_frame, 'left_keypoints' AS field_name, left_keypoints AS v FROM k
          UNION ALL
          SELECT episode_index, frame_index, rig_id, joint_frame, 'right_keypoints', right_keypoints FROM k),
        j AS (SELECT h.*, i AS joint, CAST(v[3 * i + 1] AS DOUBLE) AS x, CAST(v[3 * i + 2] AS DOUBLE) AS y, CAST(v[3 * i + 3] AS DOUBLE) AS z FROM h, range(21) t(i)),
        m AS (SELECT *, coalesce(isfinite(x) AND isfinite(y) AND isfinite(z) AND greatest(abs(x), abs(y), abs(z)) < 1e8, false) AS fine,
                     coalesce(x = 0 AND y = 0 AND z = 0, false) AS zero FROM j),
        n AS (SELECT *, sum(CASE WHEN fine AND NOT zero AND joint > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_index, frame_index, field_name) AS others FROM m),
        ok AS (SELECT *, fine AND (NOT zero OR coalesce(joint = 0 AND joint_frame = 'wrist' AND others > 0, false)) AS ok FROM n)"""
_LINE = ", ".join(f"last_value(CASE WHEN ok THEN {c} END IGNORE NULLS) OVER b AS p{c}, first_value(CASE WHEN ok THEN {c} END IGNORE NULLS) OVER a AS n{c}" for c in ("frame_index", "x", "y", "z"))
_MEANS = ", ".join(f"avg({c}) AS m{c}" for c in "xyz")
ORACLES = {
    # The flag's dependency is the one that the data verify: whether the head pose is usable.
    "p3_filled": f"""
        WITH {_MEASURED},
        li AS (SELECT *, {_LINE} FROM ok WINDOW b AS (PARTITION BY episode_index, field_name, joint ORDER BY frame_index ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
                a AS (PARTITION BY episode_index, field_name, joint ORDER BY frame_index ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)),
        fx AS (SELECT joint_frame, field_name, joint, {_MEANS}, count(*) >= 20 AND min(x) = max(x) AND min(y) = max(y) AND min(z) = max(z) AS fixed FROM ok WHERE ok GROUP BY ALL),
        rg AS (SELECT joint_frame, rig_id, field_name, joint, {_MEANS} FROM ok WHERE ok GROUP BY ALL),
        al AS (SELECT field_name, joint, {_MEANS} FROM ok WHERE ok GROUP BY ALL),
        fi AS (SELECT episode_index, frame_index, li.field_name, li.joint, CASE WHEN coalesce(fx.fixed, false) THEN 'dependency' WHEN coalesce(pframe_index, nframe_index) IS NOT NULL THEN 'episode'
                WHEN rg.mx IS NOT NULL THEN 'rig' WHEN fx.mx IS NOT NULL THEN 'reference' WHEN al.mx IS NOT NULL THEN 'overall' ELSE 'default' END AS filled_by,
                {", ".join(f"coalesce(p{c}, n{c}) + (coalesce(n{c}, p{c}) - coalesce(p{c}, n{c})) * (frame_index - coalesce(pframe_index, nframe_index)) / greatest(coalesce(nframe_index, pframe_index) - coalesce(pframe_index, nframe_index), 1) AS e{c}" for c in "xyz")},
                {", ".join(f"fx.m{c} AS f{c}, rg.m{c} AS r{c}, al.m{c} AS a{c}" for c in "xyz")}
               FROM li LEFT JOIN fx ON fx.joint_frame IS NOT DISTINCT FROM li.joint_frame AND fx.field_name = li.field_name AND fx.joint = li.joint
               LEFT JOIN rg ON rg.joint_frame IS NOT DISTINCT FROM li.joint_frame AND rg.rig_id IS NOT DISTINCT FROM li.rig_id AND rg.field_name = li.field_name AND rg.joint = li.joint
               LEFT JOIN al ON al.field_name = li.field_name AND al.joint = li.joint WHERE NOT ok)
        SELECT episode_index, frame_index, field_name, CAST(joint AS BIGINT) AS joint, filled_by,
               {", ".join(f"round(CASE filled_by WHEN 'episode' THEN e{c} WHEN 'rig' THEN r{c} WHEN 'overall' THEN a{c} WHEN 'default' THEN 0 ELSE f{c} END + 1e-7, 4) AS {c}" for c in "xyz")} FROM fi
        UNION ALL
        SELECT episode_index, frame_index, 'camera_pose_valid', CAST(-1 AS BIGINT), 'dependency',
               CASE WHEN coalesce(len(obs_head_pose) = 7 AND list_count(obs_head_pose) = 7 AND list_bool_and([isfinite(q) AND abs(q) < 1e8 FOR q IN obs_head_pose])
                 AND abs(sqrt(list_sum([CAST(q AS DOUBLE) * CAST(q AS DOUBLE) FOR q IN obs_head_pose[4:7]])) - 1) < 0.2, false) THEN 1.0::DOUBLE ELSE 0 END, NULL, NULL
        FROM k WHERE camera_pose_valid IS NULL""",
    "p3_found": """
        WITH k AS (SELECT DISTINCT ON (episode_index, frame_index) * FROM hand_keypoints),
        h AS (
          SELECT episode_index, frame_index, joint_frame, 'left_keypoints' AS field_name, left_keypoints AS v FROM k
          UNION ALL
          SELECT episode_index, frame_index, joint_frame, 'right_keypoints', right_keypoints FROM k),
        j AS (SELECT h.*, i AS joint, v[3 * i + 1] AS x, v[3 * i + 2] AS y, v[3 * i + 3] AS z FROM h, range(21) t(i)),
        m AS (SELECT *, coalesce(isfinite(x) AND isfinite(y) AND isfinite(z) AND greatest(abs(x), abs(y), abs(z)) < 1e8, false) AS fine,
                     coalesce(x = 0 AND y = 0 AND z = 0, false) AS zero FROM j),
        n AS (SELECT *, sum(CASE WHEN fine AND NOT zero AND joint > 0 THEN 1 ELSE 0 END) OVER (PARTITION BY episode_index, frame_index, field_name) AS others FROM m)
        SELECT episode_index, frame_index, field_name, CAST(joint AS BIGINT) AS joint FROM n
        WHERE NOT (fine AND (NOT zero OR (joint = 0 AND joint_frame = 'wrist' AND others > 0)))
        UNION ALL
        SELECT episode_index, frame_index, 'camera_pose_valid', CAST(-1 AS BIGINT) FROM k WHERE camera_pose_valid IS NULL"""
}
