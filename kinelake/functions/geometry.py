"""Poses, rotations and grippers as Column expressions.

A rotation is an array of 9 (row-major), a pose an array of 16 (row-major 4 x 4), a quaternion an array of 4 in the order
the function's name says.  Intermediate results are bound with :func:`let`, so expressions stay linear in size.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

EPS = 1e-8


def item(v: Column, i: int) -> Column:
    return F.get(v, F.lit(i)).cast("double")


def items(v: Column, n: int, start: int = 0) -> list[Column]:
    return [item(v, start + i) for i in range(n)]


def vector(parts: list[Column]) -> Column:
    return F.array(*parts)


def dot(a: list[Column], b: list[Column]) -> Column:
    return sum((x * y for x, y in zip(a[1:], b[1:])), a[0] * b[0])


def cross(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[1] * b[2] - a[2] * b[1], a[2] * b[0] - a[0] * b[2], a[0] * b[1] - a[1] * b[0]]


def norm(a: list[Column]) -> Column:
    return F.sqrt(dot(a, a))


def unit(a: list[Column], floor: float = EPS) -> list[Column]:
    """v / max(norm, floor)."""
    n = F.greatest(norm(a), F.lit(floor))
    return [x / n for x in a]


def mat_mul(a: list[Column], b: list[Column]) -> list[Column]:
    return [a[3 * i] * b[j] + a[3 * i + 1] * b[3 + j] + a[3 * i + 2] * b[6 + j] for i in range(3) for j in range(3)]


def mat_vec(a: list[Column], v: list[Column]) -> list[Column]:
    return [a[3 * i] * v[0] + a[3 * i + 1] * v[1] + a[3 * i + 2] * v[2] for i in range(3)]


def transposed(a: list[Column]) -> list[Column]:
    return [a[3 * j + i] for i in range(3) for j in range(3)]


def determinant(a: list[Column]) -> Column:
    return a[0] * (a[4] * a[8] - a[5] * a[7]) - a[1] * (a[3] * a[8] - a[5] * a[6]) + a[2] * (a[3] * a[7] - a[4] * a[6])


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often the body reads it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _doubles(v: Column, start: int, n: int) -> Column:
    return F.array(*items(v, n, start))


def rot6d_to_matrix(v: Column, start: int = 0) -> Column:
    """From the first two columns: x = c1 / (norm + 1e-8), z = x cross c2 normalised likewise, y = z cross x."""

    def scaled(a):
        return let(norm(items(a, 3)) + EPS, lambda n: vector([q / n for q in items(a, 3)]))

    def body(c):
        def with_x(x):
            def with_z(z):
                return let(vector(cross(items(z, 3), items(x, 3))), lambda y: vector([m for row in zip(items(x, 3), items(y, 3), items(z, 3)) for m in row]))

            return let(let(vector(cross(items(x, 3), items(c, 3, 3))), scaled), with_z)

        return let(scaled(c), with_x)

    return let(_doubles(v, start, 6), body)


def rot6d_to_matrix_gs(v: Column, start: int = 0) -> Column:
    """The Gram-Schmidt variant, norms floored at 1e-8."""

    def unit_of(a):
        return let(F.greatest(norm(items(a, 3)), F.lit(EPS)), lambda n: vector([q / n for q in items(a, 3)]))

    def body(c):
        def with_b1(b1):
            def with_d(d):
                def with_b2(b2):
                    return let(vector(cross(items(b1, 3), items(b2, 3))), lambda b3: vector([m for row in zip(items(b1, 3), items(b2, 3), items(b3, 3)) for m in row]))

                return let(let(vector([y - d * x for x, y in zip(items(b1, 3), items(c, 3, 3))]), unit_of), with_b2)

            return let(dot(items(b1, 3), items(c, 3, 3)), with_d)

        return let(unit_of(c), with_b1)

    return let(_doubles(v, start, 6), body)


def matrix_to_rot6d(r: Column) -> Column:
    return vector([item(r, i) for i in (0, 3, 6, 1, 4, 7)])


def matrix_to_euler(r: Column) -> Column:
    """Extrinsic xyz (roll, pitch, yaw); at gimbal lock yaw is 0 and roll takes the rest."""

    def body(bound):
        m = items(bound, 9)
        s = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), -m[6]))
        lock = F.abs(s) > 1 - 1e-12
        return vector([F.when(lock, F.atan2(-m[5], m[4])).otherwise(F.atan2(m[7], m[8])), F.asin(s), F.when(lock, F.lit(0.0)).otherwise(F.atan2(m[3], m[0]))])

    return let(r, body)


def euler_to_matrix(e: Column, start: int = 0) -> Column:
    """R = Rz Ry Rx for extrinsic xyz angles."""

    def body(t):
        ca, sa, cb, sb, cc, sc = items(t, 6)
        return vector([cc * cb, cc * sb * sa - sc * ca, cc * sb * ca + sc * sa, sc * cb, sc * sb * sa + cc * ca, sc * sb * ca - cc * sa, -sb, cb * sa, cb * ca])

    return let(vector([f(x) for x in items(e, 3, start) for f in (F.cos, F.sin)]), body)


def _quaternion_matrix(w, x, y, z) -> list[Column]:
    return [1 - 2 * (y * y + z * z), 2 * (x * y - w * z), 2 * (x * z + w * y), 2 * (x * y + w * z), 1 - 2 * (x * x + z * z), 2 * (y * z - w * x), 2 * (x * z - w * y), 2 * (y * z + w * x), 1 - 2 * (x * x + y * y)]


def wxyz_to_matrix(q: Column, start: int = 0, identity_below: float = 1e-12) -> Column:
    """Normalised first; a quaternion of norm at most ``identity_below`` gives the identity."""
    one = vector([F.lit(1.0 if i in (0, 4, 8) else 0.0) for i in range(9)])

    def body(v):
        def with_norm(n):
            return F.when(n <= identity_below, one).otherwise(let(vector([a / F.greatest(n, F.lit(identity_below)) for a in items(v, 4)]), lambda u: vector(_quaternion_matrix(*items(u, 4)))))

        return let(norm(items(v, 4)), with_norm)

    return let(_doubles(q, start, 4), body)


def xyzw_to_matrix(q: Column, start: int = 0) -> Column:
    x, y, z, w = items(q, 4, start)
    return wxyz_to_matrix(vector([w, x, y, z]))


def matrix_to_wxyz(r: Column) -> Column:
    """By the trace, else by the largest diagonal element; w is not negative in the first case."""

    def scaled(value, parts):
        """``parts(s)`` for s = 2 sqrt(value)."""
        return let(F.sqrt(F.greatest(value, F.lit(1e-300))) * 2, lambda s: vector(parts(s)))

    def body(bound):
        m = items(bound, 9)
        t = m[0] + m[4] + m[8]
        a = scaled(t + 1, lambda s: [s / 4, (m[7] - m[5]) / s, (m[2] - m[6]) / s, (m[3] - m[1]) / s])
        b = scaled(1 + m[0] - m[4] - m[8], lambda s: [(m[7] - m[5]) / s, s / 4, (m[1] + m[3]) / s, (m[2] + m[6]) / s])
        c = scaled(1 - m[0] + m[4] - m[8], lambda s: [(m[2] - m[6]) / s, (m[1] + m[3]) / s, s / 4, (m[5] + m[7]) / s])
        d = scaled(1 - m[0] - m[4] + m[8], lambda s: [(m[3] - m[1]) / s, (m[2] + m[6]) / s, (m[5] + m[7]) / s, s / 4])
        return F.when(t > 0, a).when((m[0] >= m[4]) & (m[0] >= m[8]), b).when(m[4] >= m[8], c).otherwise(d)

    return let(r, body)


def pose(r: list[Column], t: list[Column]) -> Column:
    return vector([*r[:3], t[0], *r[3:6], t[1], *r[6:], t[2], F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0)])


def pose_parts(p: Column) -> tuple[list[Column], list[Column]]:
    return [item(p, i) for i in (0, 1, 2, 4, 5, 6, 8, 9, 10)], [item(p, i) for i in (3, 7, 11)]


def rigid_inverse(p: Column) -> Column:
    """Transposed rotation and -R't; for rigid poses."""

    def body(bound):
        r, t = pose_parts(bound)
        rt = transposed(r)
        return pose(rt, [-x for x in mat_vec(rt, t)])

    return let(p, body)


def compose(a: Column, b: Column) -> Column:
    def body(x, y):
        ra, ta = pose_parts(x)
        rb, tb = pose_parts(y)
        return pose(mat_mul(ra, rb), [p + q for p, q in zip(mat_vec(ra, tb), ta)])

    return let(a, lambda x: let(b, lambda y: body(x, y)))


def head_pose(p: Column) -> Column:
    """xyz and wxyz quaternion (7 numbers) as a pose."""
    return let(wxyz_to_matrix(p, 3), lambda r: pose(items(r, 9), items(p, 3)))


def move_point(p: Column, v: list[Column]) -> Column:
    """The point (3 numbers) moved by the pose."""

    def body(x, y):
        r, t = pose_parts(x)
        return vector([a + b for a, b in zip(mat_vec(r, items(y, 3)), t)])

    return let(p, lambda x: let(vector(v), lambda y: body(x, y)))


def canonical14(v: Column) -> Column:
    """20 numbers (xyz, rot6d, width per hand) to 14 (xyz, roll-pitch-yaw, width per hand)."""
    one = lambda s: F.concat(vector(items(v, 3, s)), matrix_to_euler(rot6d_to_matrix(v, s + 3)), F.array(item(v, s + 9)))
    return F.concat(one(0), one(10))


def retarget(thumb: list[Column], index: list[Column], middle: list[Column], wrist: list[Column], side: int) -> Column:
    """A virtual gripper from four joints as struct(position, rotation, width, valid); ``side`` is +1 for right, -1 for left.

    Finger = 0.7 index + 0.3 middle; position halfway to the thumb, width their distance, z along thumb - finger (times
    side), y from z and the direction finger - wrist; a degenerate y falls back to [0, 1, 0] made orthogonal to z.  Take the
    fields apart with ``F.inline(F.array(...))``, which computes them once."""

    def unit_of(a, floor=EPS):
        return let(F.greatest(norm(items(a, 3)), F.lit(floor)), lambda n: vector([F.try_divide(q, n) for q in items(a, 3)]))

    def with_points(p):
        t, f, w = items(p, 3), items(p, 3, 3), items(p, 3, 6)
        gap = [a - b for a, b in zip(t, f)]
        up = [F.lit(0.0), F.lit(1.0), F.lit(0.0)]

        def with_z(z, width):
            zs = items(z, 3)

            def with_raw(raw, size):
                spare = unit_of(vector([u - zs[1] * c for u, c in zip(up, zs)]))
                y0 = F.when(size > 1e-6, vector([F.try_divide(a, F.greatest(size, F.lit(EPS))) for a in items(raw, 3)])).otherwise(spare)

                def with_x(x):
                    y = unit_of(vector(cross(zs, items(x, 3))))
                    rotation = let(y, lambda q: vector([m for row in zip(items(x, 3), items(q, 3), zs) for m in row]))
                    return F.struct(vector([(a + b) / 2 for a, b in zip(t, f)]).alias("position"), rotation.alias("rotation"), width.alias("width"), ((width > 1e-6) & (size > 1e-6)).alias("valid"))

                return let(let(y0, lambda q: let(vector(cross(items(q, 3), zs)), unit_of)), with_x)

            return let(vector(cross(zs, [a - b for a, b in zip(f, w)])), lambda raw: let(norm(items(raw, 3)), lambda size: with_raw(raw, size)))

        return let(norm(gap), lambda width: let(let(vector(gap), lambda q: let(unit_of(q), lambda u: vector([side * c for c in items(u, 3)]))), lambda z: with_z(z, width)))

    finger = [0.7 * a + 0.3 * b for a, b in zip(index, middle)]
    return let(vector([*thumb, *finger, *wrist]), with_points)


def gripper_action(position: Column, rotation: Column, width: Column) -> Column:
    """Ten numbers: position, rot6d, width."""
    return F.concat(position, matrix_to_rot6d(rotation), F.array(width))


def project(point: list[Column], fx, fy, cx, cy, least_depth: float = 1e-4) -> Column:
    """Pinhole projection (u, v); null behind or at the camera and for points that are not finite."""
    x, y, z = point
    seen = (z > least_depth) & ~F.isnan(x) & ~F.isnan(y) & ~F.isnan(z) & (F.abs(x) < float("inf")) & (F.abs(y) < float("inf"))
    return F.when(seen, vector([fx * x / z + cx, fy * y / z + cy]))


def keypoints_valid(v: Column) -> Column:
    """All finite, not all (nearly) zero, all below 1e8."""
    d = F.transform(v, lambda x: x.cast("double"))
    fine = F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < 1e8))
    return F.coalesce(fine & (F.aggregate(d, F.lit(0.0), lambda a, x: a + F.abs(x)) > 1e-9), F.lit(False))


def pose7_valid(v: Column) -> Column:
    """Keypoint rules, and a quaternion norm within 0.2 of 1."""
    q = norm(items(v, 4, 3))
    return F.coalesce((F.size(v) == 7) & keypoints_valid(v) & (q > 1e-9) & (F.abs(q - 1) < 0.2), F.lit(False))


def hand_confidence(c: Column) -> Column:
    """The smaller hand's least product wrist x fingertip, clipped to [0, 1]; fewer than 8 numbers: their least.  NaN is skipped."""
    v = F.transform(c, lambda x: F.when(~F.isnan(x), x.cast("double")))
    one = lambda s: F.array_min(F.array(*[F.get(v, F.lit(s)) * F.get(v, F.lit(s + k)) for k in (1, 2, 3)]))
    both = F.array_min(F.array(one(0), one(4)))
    return F.when(F.size(c) < 8, F.array_min(v)).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), both)))


def nearest_rotation(r):
    """Pandas UDF body: the nearest rotation by SVD (determinant +1) of each 9-vector; null stays null."""
    import numpy as np
    import pandas as pd

    known = [v is not None and len(v) == 9 and np.isfinite(v).all() for v in r]
    out = pd.Series([None] * len(r), dtype=object)
    if any(known):
        u, _, vt = np.linalg.svd(np.stack([np.asarray(v, float) for v, k in zip(r, known) if k]).reshape(-1, 3, 3))
        u[:, :, 2] *= np.where(np.linalg.det(u @ vt) < 0, -1.0, 1.0)[:, None]
        out[np.flatnonzero(known)] = list((u @ vt).reshape(-1, 9).tolist())
    return out


def repair_rotation(r: Column) -> Column:
    from pyspark.sql.functions import pandas_udf

    return pandas_udf(nearest_rotation, "array<double>")(r)


PI = math.pi
