"""Readings that do not come from the tracked motion: spikes, frozen stretches, impossible values.

Spikes are found by phase-space thresholding (Goring and Nikora 2002, with robust scales): a reading is a candidate when
its deviation from the local course u (running median of 7), the first difference of u and the second difference leave
the ellipsoid whose half axes are the universal threshold sqrt(2 ln n) times the robust scales that the *rig* shows
for that channel over all its frames.  A candidate counts when an exact look at its neighbours confirms it: a stretch of
at most ``max_frames`` readings, each at least ``factor`` of the rig's usual frame-to-frame changes off the line between
the readings before and after it, with those two close together again.  Confirmed readings are taken out and the search
repeats until nothing new is found.

Frozen stretches come from runs of zero first differences, impossible readings from the bounds of the field.

More than ``GAP`` missing frames end a course and a stretch.

Plan: frames get their rig, are shuffled once by (episode, block of 4,096 frames, with a halo) and sorted by frame.  Pass 1
reduces each task to histograms per rig and channel (48 channels x 3 quantities, logarithmic bins), which are summed by
hash aggregation; pass 2 applies the rules.  What is joined back is one row per rig; it is broadcast only if its counted
size allows it.  The size of the blocks changes no result: a block whose halo holds too few readings for the rounds that
were needed is judged again with a wider one, and a frozen stretch that leaves its block is put together from one row per
block with its length and its moving frames before it is judged.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from kinelake.functions.deliveries import once, with_halo
from kinelake.functions.dense import longs, matrix, runs, starts_of, whole_groups
from kinelake.session import materialise

FIELDS = (("observation.state", 20), ("action", 20), ("observation.confidence", 8))
WIDTH = sum(w for _, w in FIELDS)
SPAN, HALO = 4096, 64
#: A longer gap between frames is a border; ``HALO`` is several times as long.
GAP = 16
#: How many readings away one round looks: 3 for the median, 1 for the differences, 4 for the confirmation.
REACH = 8
#: Histogram of absolute values: 8 bins an octave, octaves 2**-30 .. 2**30.
BINS = 480
BROADCAST_RIGS = 50_000
REST_EPSILON = 0.0005
FOUND = "episode_index long, frame_index long, field_name string, channel long, kind string, value double"
JUDGED = FOUND + ", block long, run long, n long, moved long, from_before boolean"

_STATE_ROLE = np.array((["position"] * 3 + ["rot6d"] * 6 + ["width"]) * 2)
LOW = np.concatenate([np.select([_STATE_ROLE == "position", _STATE_ROLE == "rot6d"], [-3.0, -1.0], 0.0)] * 2 + [np.zeros(8)])
HIGH = np.concatenate([np.select([_STATE_ROLE == "position", _STATE_ROLE == "rot6d"], [3.0, 1.0], 3.0)] * 2 + [np.ones(8)])
#: Channels of the same hand and field.
HAND = np.concatenate([np.repeat([0, 1], 10), np.repeat([2, 3], 10), np.repeat([4, 5], 4)])
NAMES = np.concatenate([np.repeat(n, w) for n, w in FIELDS])
NUMBER = np.concatenate([np.arange(w) for _, w in FIELDS])


def placed(frames: DataFrame, episodes: DataFrame, halo: int = HALO, blocks: DataFrame | None = None) -> DataFrame:
    """Frames once per (episode, frame), with their rig, clustered by (episode, block) and sorted by frame; with ``blocks``
    (episode_index, block) those blocks only."""
    rigs = episodes.where("episode_index is not null").groupBy("episode_index").agg(F.max("rig_id").alias("rig_id"))
    values = frames.where("episode_index is not null and frame_index is not null").select("episode_index", "frame_index", F.col("`observation.state`").alias("f0"), F.col("action").alias("f1"), F.col("`observation.confidence`").alias("f2"))
    if blocks is not None:
        values = values.join(blocks.select("episode_index").distinct(), "episode_index", "left_semi")
    rows = with_halo(values, SPAN, halo)
    if blocks is not None:
        rows = rows.join(blocks, ["episode_index", "block"], "left_semi")
    return once(rows.join(rigs, "episode_index", "left").repartition("episode_index", "block"), ["episode_index", "block"], ["frame_index"])


class _Rows:
    """A table of whole (episode, block) groups as arrays.  ``seg`` numbers the courses: groups, cut at long gaps."""

    def __init__(self, table: pa.Table):
        self.episode, self.frame, self.block = longs(table, "episode_index"), longs(table, "frame_index"), longs(table, "block")
        self.own = table.column("own").combine_chunks().to_numpy(zero_copy_only=False).astype(bool)
        self.values = np.concatenate([matrix(table.column(f"f{k}"), w) for k, (_, w) in enumerate(FIELDS)], axis=1)
        n = len(self.frame)
        self.starts = starts_of(self.episode, self.block)
        opens = np.zeros(n, bool)
        opens[self.starts] = True
        self.group = np.cumsum(opens) - 1
        opens[1:] |= np.diff(self.frame) > GAP
        courses = np.flatnonzero(opens)
        self.seg = np.cumsum(opens) - 1
        self.first = courses[self.seg]
        self.last = np.append(courses[1:], n)[self.seg] - 1
        self.joined = np.arange(n) > self.first
        with np.errstate(invalid="ignore"):
            self.outside = (self.values < LOW) | (self.values > HIGH)


def _bridged(x: np.ndarray, good: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """``x`` with readings that are not good replaced by the line between the good ones around them in the same group."""
    n = len(x)
    rows = np.arange(n)[:, None]
    before = np.maximum.accumulate(np.where(good, rows, -1), axis=0)
    after = np.minimum.accumulate(np.where(good, rows, n)[::-1], axis=0)[::-1]
    before = np.where(before < first[:, None], -1, before)
    after = np.where(after > last[:, None], -1, after)
    i, j = np.nonzero(~good)
    a, b = before[i, j], after[i, j]
    va, vb = x[np.maximum(a, 0), j], x[np.maximum(b, 0), j]
    t = np.where((a >= 0) & (b >= 0), (i - a) / np.maximum(b - a, 1), np.where(a >= 0, 0.0, 1.0))
    va, vb = np.where(a >= 0, va, vb), np.where(b >= 0, vb, va)
    fill = np.where((a < 0) & (b < 0), np.nan, va + (vb - va) * t)
    out = x.copy()
    out[i, j] = fill
    return out


def _median7(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    at = np.arange(len(x))
    v = [x[np.clip(at + k, first, last)] for k in range(-3, 4)]
    # Bubble the four smallest of seven down; the fourth is the median.
    for top in (6, 5, 4, 3):
        for i in range(top):
            lo, hi = np.minimum(v[i], v[i + 1]), np.maximum(v[i], v[i + 1])
            v[i], v[i + 1] = lo, hi
    return v[3]


def _phase(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Deviation from the local course, its first and second central differences."""
    u = x - _median7(x, first, last)
    at = np.arange(len(x))
    back, ahead = u[np.maximum(at - 1, first)], u[np.minimum(at + 1, last)]
    d = (ahead - back) / 2
    return u, d, ahead - 2 * u + back


def _bin(x: np.ndarray) -> np.ndarray:
    """Bin of an absolute value; 0 for zero and NaN."""
    b = (np.abs(x).astype(np.float32).view(np.int32) >> 20) - ((127 - 30) << 3)
    return np.where((x == 0) | ~np.isfinite(x), 0, np.clip(b, 1, BINS - 1))


def _edges() -> np.ndarray:
    return ((np.arange(BINS + 1, dtype=np.int64) + ((127 - 30) << 3)) << 20).astype(np.int32).view(np.float32).astype(float)


def _histograms(batches):
    held: dict = {}

    def flush():
        names, q, ch, b, n = [], [], [], [], []
        for rig, h in held.items():
            i, j, k = np.nonzero(h)
            names += [rig] * len(i)
            q.append(i), ch.append(j), b.append(k), n.append(h[i, j, k])
        held.clear()
        if names:
            cat = lambda x: pa.array(np.concatenate(x), pa.int64())
            yield pa.record_batch([pa.array(names, pa.string()), cat(q), cat(ch), cat(b), cat(n)], names=["rig_id", "quantity", "channel", "bin", "n"])

    for table in whole_groups(batches, ["episode_index", "block"]):
        r = _Rows(table)
        rigs = np.asarray(table.column("rig_id").combine_chunks().fill_null("").to_numpy(zero_copy_only=False), dtype=object)
        x = np.where(r.outside, np.nan, r.values)
        d = np.full_like(x, np.nan)
        near = r.joined.copy()
        near[1:] &= r.frame[1:] == r.frame[:-1] + 1
        d[1:] = np.where(near[1:, None], x[1:] - x[:-1], np.nan)
        u, du, d2 = _phase(x, r.first, r.last)  # only where all readings that enter are usable, hence inside the halo
        bins = [_bin(v) for v in (d, u, du, d2)]
        own = r.own
        for rig in set(rigs.tolist()):
            rows = own & (rigs == rig)
            h = held.setdefault(rig or None, np.zeros((4, WIDTH, BINS), np.int64))
            for k, b in enumerate(bins):
                at = b[rows] + np.arange(WIDTH) * BINS
                h[k] += np.bincount(at.ravel(), minlength=WIDTH * BINS).reshape(WIDTH, BINS)
                h[k][:, 0] = 0
        if len(held) > 64:
            yield from flush()
    yield from flush()


def rig_histograms(rows: DataFrame) -> DataFrame:
    """(rig_id, quantity, channel, bin, n): what :func:`rig_scales` needs; those of separate days or partitions add up."""
    counts = rows.mapInArrow(_histograms, "rig_id string, quantity long, channel long, bin long, n long")
    return counts.groupBy("rig_id", "quantity", "channel", "bin").agg(F.sum("n").alias("n"))


def rig_scales(counts: DataFrame, least: int = 200) -> DataFrame:
    """(rig_id, scales array<double>[4 * 48], readings): medians of the absolute non-zero frame-to-frame change, and of
    the three phase-space quantities, per rig and channel; zeros (rests) do not count.  A channel with fewer than
    ``least`` changes takes the median over all rigs.  The medians are interpolated inside bins an eighth of an octave
    wide."""
    overall = counts.groupBy("quantity", "channel", "bin").agg(F.sum("n").alias("n")).withColumn("rig_id", F.lit("*"))
    both = counts.select(F.concat(F.lit("="), F.coalesce("rig_id", F.lit(""))).alias("rig_id"), "quantity", "channel", "bin", "n").unionByName(overall)
    key = Window.partitionBy("rig_id", "quantity", "channel")
    at = both.withColumn("below", F.sum("n").over(key.orderBy("bin")) - F.col("n")).withColumn("total", F.sum("n").over(key))
    hit = at.where("below < total / 2d and below + n >= total / 2d")
    edges = F.array(*[F.lit(float(e)) for e in _edges()])
    lo, hi = F.get(edges, F.col("bin").cast("int")), F.get(edges, (F.col("bin") + 1).cast("int"))
    median = hit.select("rig_id", (F.col("quantity") * WIDTH + F.col("channel")).alias("at"), (lo + (hi - lo) * (F.col("total") / 2 - F.col("below")) / F.col("n")).alias("median"), "total")
    shared = median.where("rig_id = '*'").select("at", F.col("median").alias("shared"))
    own = median.where("rig_id <> '*'").join(shared, "at").select(F.col("rig_id").alias("key"), F.struct("at", F.when(F.col("total") >= least, F.col("median")).otherwise(F.col("shared")).alias("v")).alias("s"), "total")
    # At most 4 * 48 entries a rig.
    return own.groupBy("key").agg(F.collect_list("s").alias("s"), F.max("total").alias("readings"))


def _with_scales(rows: DataFrame, scales: DataFrame) -> DataFrame:
    """``scales`` must be materialised."""
    keyed = rows.withColumn("key", F.concat(F.lit("="), F.coalesce("rig_id", F.lit(""))))
    if scales.limit(BROADCAST_RIGS + 1).count() <= BROADCAST_RIGS:  # under 200 MB
        return keyed.join(F.broadcast(scales), "key", "left")
    return keyed.join(scales, "key", "left").repartition("episode_index", "block").sortWithinPartitions("episode_index", "block", "frame_index")


def _confirmed(v: np.ndarray, frame: np.ndarray, seg: np.ndarray, scale: np.ndarray, candidate: np.ndarray, factor: float, longest: int) -> np.ndarray:
    """Which readings of one channel (good readings only, in order) lie in a confirmed stretch."""
    hit = np.zeros(len(v), bool)
    p = np.flatnonzero(candidate)
    n = len(v)
    for length in range(1, longest + 1):
        for off in range(length):
            s = p - off
            pre, post = s - 1, s + length
            ok = (pre >= 0) & (post < n)
            q = np.flatnonzero(ok)
            q = q[(seg[pre[q]] == seg[p[q]]) & (seg[post[q]] == seg[p[q]])]
            if not len(q):
                continue
            a, b = pre[q], post[q]
            span = (frame[b] - frame[a]).astype(float)
            least = np.full(len(q), np.inf)
            for k in range(length):
                m = s[q] + k
                line = v[a] + (v[b] - v[a]) * (frame[m] - frame[a]) / span
                least = np.minimum(least, np.abs(v[m] - line))
            good = (span <= longest + 2) & (least > factor * scale[p[q]]) & (np.abs(v[b] - v[a]) < 0.5 * least)
            for k in range(length):
                hit[s[q[good]] + k] = True
    return hit


def _spikes(r: _Rows, scale: np.ndarray, readings: np.ndarray, factor: float, longest: int) -> tuple[np.ndarray, np.ndarray]:
    """The confirmed readings, and in how many rounds each course's channels gave some.  ``scale`` is (groups, 4, WIDTH)."""
    found = np.zeros(r.values.shape, bool)
    usable = ~r.outside & ~np.isnan(r.values)
    rounds = np.zeros((int(r.seg[-1]) + 1 if len(r.seg) else 0, WIDTH), np.int64)
    width = np.sqrt(2 * np.log(np.maximum(readings, 3)))
    rows = np.arange(len(r.frame))
    while len(rows):
        first = np.searchsorted(rows, r.first[rows])
        last = np.searchsorted(rows, r.last[rows])
        good = usable[rows]
        u, d, d2 = _phase(_bridged(r.values[rows], good, first, last), first, last)
        seg, group = r.seg[rows], r.group[rows]
        axis = 1.4826 * width[group][:, None]
        with np.errstate(invalid="ignore", divide="ignore"):
            outside = sum((q / (axis * scale[group, k])) ** 2 for k, q in ((1, u), (2, d), (3, d2))) > 1
        outside &= good
        new = np.zeros(outside.shape, bool)
        for c in np.flatnonzero(outside.any(0)):
            at = np.flatnonzero(good[:, c])
            hit = _confirmed(r.values[rows[at], c], r.frame[rows[at]], seg[at], scale[group[at], 0, c], outside[at, c], factor, longest)
            new[at[hit], c] = True
            rounds[np.unique(seg[at[hit]]), c] += 1
        found[rows] |= new
        usable[rows] &= ~new
        rows = np.flatnonzero(np.isin(r.seg, np.unique(seg[new.any(1)])))
    return found, rounds


def _unsettled(r: _Rows, rounds: np.ndarray, halo: int, span: int) -> np.ndarray:
    """Groups in which an own reading may depend on readings beyond the halo: the halo on a side on which the course may
    go on holds fewer usable readings of a channel than its rounds looked at."""
    usable = ~r.outside & ~np.isnan(r.values)
    ends = np.append(r.starts[1:], len(r.frame))
    out = np.zeros(len(r.starts), bool)
    for g, (a, b) in enumerate(zip(r.starts, ends)):
        mine = np.flatnonzero(r.own[a:b]) + a
        if not len(mine):
            continue
        lo, hi = r.block[a] * span - halo, (r.block[a] + 1) * span + halo - 1
        for goes_on, edge, side in ((r.block[a] > 0 and r.frame[a] - lo <= GAP, a, slice(a, mine[0])), (hi - r.frame[b - 1] <= GAP, b - 1, slice(mine[-1] + 1, b))):
            seg = r.seg[edge]
            inside = mine[r.seg[mine] == seg]
            if goes_on and len(inside):
                judged = usable[inside].any(0)
                out[g] |= bool((judged & (usable[side][r.seg[side] == seg].sum(0) < REACH * (rounds[seg] + 1))).any())
    return out


def _at_rest(r: _Rows, least: int = 3) -> np.ndarray:
    """Frames inside a rest: at least ``least`` consecutive frames over which no state or action channel moves."""
    with np.errstate(invalid="ignore"):
        still = np.zeros(len(r.frame), bool)
        still[1:] = r.joined[1:] & (r.frame[1:] == r.frame[:-1] + 1) & (np.abs(np.diff(r.values[:, :40], axis=0)) <= REST_EPSILON).all(1)
    rest = np.zeros(len(still), bool)
    for a, b in zip(*runs(still)):
        if b - a >= least - 1:
            rest[a - 1 : b] = True
    return rest


def _frozen(r: _Rows, least: int):
    """Readings that repeat their predecessor in a stretch of at least ``least`` readings while the hand keeps moving, and
    the parts of stretches that leave the block: (channel, first and end row, length, moving frames, whether it began
    before the block)."""
    n = len(r.frame)
    same = np.zeros((n, WIDTH), bool)
    same[1:] = (r.values[1:] == r.values[:-1]) & r.joined[1:, None]
    moved = np.zeros((n, 6), np.int64)
    change = ~same & ~np.isnan(r.values)
    for h in range(6):
        moved[:, h] = change[:, HAND == h].any(1)
    moved = np.vstack([np.zeros((1, 6), np.int64), np.cumsum(moved, axis=0)])
    a, b = runs((same & r.own[:, None]).T.ravel())
    channel = a // n if n else a
    i, j = a - channel * n, b - channel * n
    # A run at a border of the block's own rows goes on where the next row beyond it repeats too.
    before = (i > 0) & ~r.own[np.maximum(i - 1, 0)] & same[np.maximum(i - 1, 0), channel] & (r.group[np.maximum(i - 1, 0)] == r.group[i]) if len(a) else np.zeros(0, bool)
    after = (j < n) & ~r.own[np.minimum(j, n - 1)] & same[np.minimum(j, n - 1), channel] & (r.group[np.minimum(j, n - 1)] == r.group[i]) if len(a) else np.zeros(0, bool)
    count = moved[j, HAND[channel]] - moved[i, HAND[channel]]
    whole = ~before & ~after
    good = whole & (j - i >= least - 1) & (count * 2 >= j - i)
    rest = _at_rest(r)
    out = np.zeros((n, WIDTH), bool)
    for c, s, e in zip(channel[good], i[good], j[good]):
        out[s:e, c] = True
    out[rest, :40] = False
    parts = [(int(c), int(s), int(e), int(e - s), int(m), bool(f)) for c, s, e, m, f in zip(channel[~whole], i[~whole], j[~whole], count[~whole], before[~whole])]
    return out, parts, rest


def _detect(factor: float, longest: int, least_frozen: int, halo: int, span: int, batches):
    for table in whole_groups(batches, ["episode_index", "block"]):
        r = _Rows(table)
        scale = np.full((len(r.starts), 4 * WIDTH), np.inf)
        readings = np.zeros(len(r.starts))
        packed, counts = table.column("s").take(pa.array(r.starts)).to_pylist(), table.column("readings").take(pa.array(r.starts)).to_pylist()
        for k, (s, n) in enumerate(zip(packed, counts)):
            for x in s or ():
                scale[k, x["at"]] = x["v"]
            readings[k] = n or 0
        spike, rounds = _spikes(r, scale.reshape(-1, 4, WIDTH), readings, factor, longest)
        frozen, parts, rest = _frozen(r, least_frozen)
        unsettled = _unsettled(r, rounds, halo, span)
        usable = r.own & ~unsettled[r.group]
        kind = np.where(r.outside, 1, np.where(spike, 2, np.where(frozen, 3, 0)))
        kind[~usable] = 0
        i, c = np.nonzero(kind)
        k, run, length, moved, before = kind[i, c], np.full(len(i), -1), np.zeros(len(i), np.int64), np.zeros(len(i), np.int64), np.zeros(len(i), bool)
        extra = []
        for channel, s, e, size, count, f in parts:
            if usable[s]:
                open_ = np.flatnonzero((kind[s:e, channel] == 0) & ~(rest[s:e] & (channel < 40))) + s
                extra.append((np.append(open_, s), channel, np.append(np.full(len(open_), 4), 5), int(r.frame[s]), size, count, f))
        for g in np.flatnonzero(unsettled):
            extra.append((r.starts[[g]], 0, np.array([6]), -1, 0, 0, False))
        for at, channel, ks, first, size, count, f in extra:
            m = len(at)
            i, c, k = np.concatenate([i, at]), np.concatenate([c, np.full(m, channel)]), np.concatenate([k, ks])
            run, length, moved, before = (np.concatenate([v, np.full(m, x)]) for v, x in ((run, first), (length, size), (moved, count), (before, f)))
        if len(i):
            names = np.array(["", "bounds", "spike", "frozen", "pending", "part", "unsettled"], object)
            yield pa.record_batch(
                [pa.array(r.episode[i]), pa.array(r.frame[i]), pa.array(NAMES[c].tolist(), pa.string()), pa.array(NUMBER[c].astype(np.int64)), pa.array(names[k], pa.string()), pa.array(r.values[i, c]), pa.array(r.block[i]), *[pa.array(v, pa.int64()) for v in (run, length, moved)], pa.array(before.astype(bool))],
                names=["episode_index", "frame_index", "field_name", "channel", "kind", "value", "block", "run", "n", "moved", "from_before"],
            )


def _judged(frames: DataFrame, episodes: DataFrame, scales: DataFrame, rules: tuple, halo: int, blocks: DataFrame | None = None) -> DataFrame:
    span = SPAN
    scaled = _with_scales(placed(frames, episodes, halo, blocks), scales)
    # The scales travel to Python once per group of frames.
    opens = F.lag("frame_index").over(Window.partitionBy("episode_index", "block").orderBy("frame_index")).isNull()
    out = scaled.withColumn("s", F.when(opens, F.col("s")))
    return out.select("episode_index", "block", "frame_index", "own", "f0", "f1", "f2", "s", "readings").mapInArrow(lambda it: _detect(*rules, halo, span, it), JUDGED)


def implausible_readings(frames: DataFrame, episodes: DataFrame, factor: float = 14.0, longest: int = 3, least_frozen: int = 8) -> DataFrame:
    """One row per implausible reading (episode_index, frame_index, field_name, channel, kind, value).

    ``kind`` is bounds, spike or frozen, the first that applies.  Frames without episode or frame number cannot be placed
    and give nothing; null lists, null elements, NaN and missing tails are no readings; infinite ones are out of bounds.
    A frame delivered several times counts once.  Episodes missing in ``episodes``, or without rig, are judged together
    as one rig.  A spike at the first or last reading of a course has no course on one side and is not reported.  Empty
    tables give no row; other columns are ignored."""
    counts, _ = materialise(rig_histograms(placed(frames, episodes)), "rig-histograms")
    scales, _ = materialise(rig_scales(counts), "rig-scales")
    rules, halo = (factor, longest, least_frozen), HALO
    judged, _ = materialise(_judged(frames, episodes, scales, rules, halo), "judged-readings")
    found = judged
    while not (again := judged.where("kind = 'unsettled'").select("episode_index", "block").distinct()).isEmpty():
        halo *= 8
        judged, _ = materialise(_judged(frames, episodes, scales, rules, halo, again), "judged-readings")
        found = found.unionByName(judged)
    names = ["episode_index", "frame_index", "field_name", "channel", "kind", "value"]
    # A stretch over several blocks: its parts follow each other, the first did not begin before its block.
    key = ["episode_index", "field_name", "channel"]
    w = Window.partitionBy(*key)
    parts = found.where("kind = 'part'").withColumn("stretch", F.sum((~F.col("from_before")).cast("long")).over(w.orderBy("run")))
    stretch = Window.partitionBy(*key, "stretch")
    frozen = parts.withColumn("all", F.sum("n").over(stretch)).withColumn("moving", F.sum("moved").over(stretch)).where((F.col("all") >= least_frozen - 1) & (F.col("moving") * 2 >= F.col("all")))
    pending = found.where("kind = 'pending'").join(frozen.select(*key, "run"), [*key, "run"], "left_semi").withColumn("kind", F.lit("frozen"))
    return found.where("kind in ('bounds', 'spike', 'frozen')").select(*names).unionByName(pending.select(*names))


def p2_found(spark: SparkSession, root: str) -> DataFrame:
    """Readings of ``frames`` that jump, freeze or lie beyond what the field can hold."""
    return implausible_readings(spark.read.parquet(f"{root}/frames.parquet"), spark.read.parquet(f"{root}/episodes.parquet")).select("episode_index", "frame_index", "field_name", "channel")


QUERIES = {"p2_found": p2_found}
ORACLES: dict[str, str] = {}
