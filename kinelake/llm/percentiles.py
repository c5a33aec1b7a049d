"""Exact percentiles of very large columns by distributed multi-select.

Values are held in *blocks*: the sorted values of all channels of one part of a shard; every shard has at least ``PARTS``
parts (by episode), larger ones a part per ``block_rows`` rows.  A wanted rank is found like this, per group and channel:

* round 1: every block proposes the order statistics at the rank's own place and at guards beside it, the weighted medians
  of the proposals become pivots, blocks count three ways (below, equal, above), the counts are summed, and the ranges
  that cannot hold the rank are cut off: only the values between the pivots around the rank are written;
* then, in one visit of those values a round: each block counts the pivot three ways and proposes the median of what lies
  below and of what lies above it; the side that cannot hold the rank is cut off at the next visit and the weighted
  median of the other side's proposals becomes the next pivot; until the pivot is the value at the rank.

No group takes another path, however small: each rank passes through proposals, pivot, count and cut.

The error bound is 0 ranks: what is returned is the value at the stated rank.  Blocks of separate partitions, shards or
days combine by union (``levels`` groups the same blocks by shard, by corpus and overall).

Plan: frames are shuffled once by (shard, part), so a hot shard is spread.  A block keeps only the values whose local rank
leaves them possible: of a group of n rows a value at rank r lies among the r + 1 least (or n - r greatest) of its block.
Counts and proposals are reduced in a tree with fan-in ``FAN_IN``.  Nothing but the number of open ranks reaches the
driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession, functions as F

from kinelake.functions.deliveries import once
from kinelake.functions.dense import longs, matrix, starts_of, whole_groups
from kinelake.session import drop_folder, materialise

CHANNELS = 20
BLOCK_ROWS = 65_536
PARTS = 4
FAN_IN = 256
#: stat name, field, quantile
STATS = (("state_q01", "state", 0.01), ("state_q99", "state", 0.99), ("action_q01", "action", 0.01), ("action_q99", "action", 0.99), ("thr_residual", "residual", 0.99))
FIELDS = ("state", "action", "residual")
#: States and actions arrive as 4-byte floats, residuals are computed as doubles.
KINDS = ("<f4", "<f4", "<f8")
ALLOWED = 0.005
#: Where the first proposals are made, beside the quantile.
GUARDS = (-0.01, -ALLOWED, 0.0, ALLOWED, 0.01)
#: Savitzky-Golay 11/3: fixed values.
SAVGOL = np.array([-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36]) / 429
WINDOW = 11
#: Place of an open rank: (stat * CHANNELS + channel) * 3 + bound.
COLUMNS = [(k, c) for k in range(len(STATS)) for c in range(CHANNELS)]
BLOCKS = "shard_id long, part long, keep long, n array<long>, proposed array<double>, body binary"


def wanted(n, q: float):
    """Ranks (0-based) of the lower bound, the percentile and the upper bound among n sorted values."""
    n = np.asarray(n)
    top = np.maximum(n - 1, 0)
    return tuple(np.clip(r, 0, top).astype(np.int64) for r in (np.floor((q - ALLOWED) * n), np.ceil(q * n) - 1, np.ceil((q + ALLOWED) * n)))


def residuals(x: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """abs(x - trend) with trend = Savitzky-Golay 11/3 of the median of 5, edges repeated within [first, last]."""
    at = np.arange(len(x))
    v = [x[np.clip(at + k, first, last)] for k in range(-2, 3)]
    for top in (4, 3, 2):  # the three smallest of five bubble down; the third is the median
        for i in range(top):
            v[i], v[i + 1] = np.minimum(v[i], v[i + 1]), np.maximum(v[i], v[i + 1])
    m = v[2]
    trend = np.zeros_like(x)
    for k, c in zip(range(-5, 6), SAVGOL):
        trend += c * m[np.clip(at + k, first, last)]
    return np.abs(x - trend)


# --------------------------------------------------------------------- blocks


def _planes(x: np.ndarray) -> bytes:
    """Bytes of equal significance side by side."""
    return x.view(np.uint8).reshape(-1, x.itemsize).T.tobytes()


def pack_values(fields: list[np.ndarray]) -> bytes:
    """The values of the three fields, each in its own width, compressed."""
    return zstandard.ZstdCompressor(level=1).compress(b"".join(_planes(x.astype(k)) for x, k in zip(fields, KINDS)))


def unpack_values(body: bytes, lengths: list[int]) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(body, max_output_size=sum(n * int(k[-1]) for n, k in zip(lengths, KINDS)) or 1)
    out, at = [], 0
    for n, k in zip(lengths, KINDS):
        size = int(k[-1])
        out.append(np.ascontiguousarray(np.frombuffer(raw, np.uint8, n * size, at).reshape(size, n).T).view(k).ravel())
        at += n * size
    return out


def _held(n: np.ndarray, keep: int, field: int) -> np.ndarray:
    """How many of n values a block keeps: the ``keep`` least and greatest; of residuals only the greatest are wanted."""
    return np.minimum(n, keep if FIELDS[field] == "residual" else 2 * keep)


def _block(field_values: list[np.ndarray], keep: int):
    n, proposed, kept = np.zeros(len(FIELDS) * CHANNELS, np.int64), np.full((len(COLUMNS), len(GUARDS)), np.nan), []
    for f, x in enumerate(field_values):
        ordered = np.sort(x, axis=0)  # NaN last
        count = (~np.isnan(ordered)).sum(0)
        n[f * CHANNELS : (f + 1) * CHANNELS] = count
        held = _held(count, keep, f)
        parts = []
        for c in range(CHANNELS):
            v = ordered[: count[c], c]
            parts += [v] if held[c] == count[c] else [v[-keep:]] if FIELDS[f] == "residual" else [v[:keep], v[-keep:]]
        kept.append(np.concatenate(parts))
        for k, (_, name, q) in enumerate(STATS):
            if name == FIELDS[f]:
                some = np.flatnonzero(count)
                for g, d in enumerate(GUARDS):
                    at = np.clip(np.ceil((q + d) * count[some]).astype(np.int64) - 1, 0, count[some] - 1)
                    proposed[k * CHANNELS + some, g] = ordered[at, some]
    return n, proposed.ravel(), pack_values(kept)


def _blocks(batches):
    for table in whole_groups(batches, ["shard_id", "part"], rows=8_000):
        shard, part, keep = longs(table, "shard_id"), longs(table, "part"), longs(table, "keep")
        state, action = matrix(table.column("s"), CHANNELS), matrix(table.column("a"), CHANNELS)
        opens = starts_of(shard, part, longs(table, "episode_index"))
        n = len(shard)
        length = np.diff(np.append(opens, n))
        first = np.repeat(opens, length)
        resid = residuals(state, first, first + np.repeat(length, length) - 1)
        resid[np.repeat(length, length) < WINDOW] = np.nan
        starts = starts_of(shard, part)
        rows = [_block([x[a:b] for x in (state, action, resid)], int(keep[a])) for a, b in zip(starts, np.append(starts[1:], n))]
        if rows:
            counts, proposed, body = zip(*rows)
            yield pa.record_batch([pa.array(shard[starts]), pa.array(part[starts]), pa.array(keep[starts]), pa.array(list(counts), pa.list_(pa.int64())), pa.array(list(proposed), pa.list_(pa.float64())), pa.array(list(body), pa.binary())], names=["shard_id", "part", "keep", "n", "proposed", "body"])


def value_blocks(frames: DataFrame, block_rows: int = BLOCK_ROWS, parts: int = PARTS, combine: bool = False) -> DataFrame:
    """Blocks of state, action and residual values per (shard_id, part): ``n`` values per field and channel, the first
    proposals, and the values that can be wanted: with ``combine`` for any group of shards, else for the shard alone.

    Frames delivered several times count once; null or NaN elements and null lists are no values; rows without shard,
    episode or frame number cannot be placed and are left out; episodes under 11 frames have no residuals."""
    rows = frames.where("shard_id is not null and episode_index is not null and frame_index is not null").select("shard_id", "episode_index", "frame_index", F.col("`observation.state`").alias("s"), F.col("action").alias("a"))
    # Written, so that the join knows the table's size: it has a row per shard.
    n = F.count("*")
    share = 1 - min(1 - q if q > 0.5 else q for _, _, q in STATS) - ALLOWED
    sizes, _ = materialise(rows.groupBy("shard_id").agg(F.greatest(F.lit(parts), F.ceil(n / F.lit(block_rows))).cast("long").alias("parts"), (F.ceil(n * F.lit(1 - share)) + 2).cast("long").alias("keep")), "shard-sizes")
    if combine:
        total = sizes.agg(F.coalesce(F.sum("keep"), F.lit(0)).alias("t")).first()["t"]  # at least what any union can ask for
        sizes = sizes.withColumn("keep", F.lit(int(total)))
    rows = rows.join(sizes, "shard_id").withColumn("part", F.pmod(F.xxhash64("episode_index"), F.col("parts"))).drop("parts").repartition("shard_id", "part")
    return once(rows, ["shard_id", "part", "episode_index"], ["frame_index"]).mapInArrow(_blocks, BLOCKS)


def _regions(n: np.ndarray, keep: int, body: bytes):
    """The sorted values a block keeps for each of ``COLUMNS``, and how many of its values lie below them."""
    held = [_held(n[f * CHANNELS : (f + 1) * CHANNELS], keep, f) for f in range(len(FIELDS))]
    flat = unpack_values(body, [int(h.sum()) for h in held])
    ends = [np.concatenate(([0], np.cumsum(h))) for h in held]
    for k, (_, name, q) in enumerate(STATS):
        f = FIELDS.index(name)
        for c in range(CHANNELS):
            v = flat[f][ends[f][c] : ends[f][c + 1]].astype(np.float64)
            v = v[-keep:] if q > 0.5 else v[:keep]
            yield v, (int(n[f * CHANNELS + c]) - len(v)) if q > 0.5 else 0


# -------------------------------------------------------------------- reduction

TALLY = "gkey string, salt long, pos array<int>, n array<long>, x array<long>, y array<long>, below array<double>, above array<double>"
_TALLY = [("pos", pa.int32()), ("n", pa.int64()), ("x", pa.int64()), ("y", pa.int64()), ("below", pa.float64()), ("above", pa.float64())]


def weighted_median(group: np.ndarray, v: np.ndarray, w: np.ndarray, groups: int) -> np.ndarray:
    """The least value of each group up to which at least half of the group's weight lies; NaN without weight."""
    out = np.full(groups, np.nan)
    some = w > 0
    group, v, w = group[some], v[some], w[some]
    if len(v):
        order = np.lexsort((v, group))
        group, v, w = group[order], v[order], w[order]
        upto = np.cumsum(w)
        start = starts_of(group)
        base = np.repeat(upto[start] - w[start], np.diff(np.append(start, len(v))))
        total = np.repeat(np.add.reduceat(w, start), np.diff(np.append(start, len(v))))
        hit = np.flatnonzero((upto - base) * 2 >= total)
        first = hit[starts_of(group[hit])]
        out[group[first]] = v[first]
    return out


def _combined(table: pa.Table) -> dict[str, np.ndarray]:
    flat = {k: table.column(k).combine_chunks().flatten().to_numpy(zero_copy_only=False) for k, _ in _TALLY}
    pos, group = np.unique(flat["pos"], return_inverse=True)
    total = lambda k: np.bincount(group, flat[k], len(pos)).astype(np.int64)
    return {"pos": pos, "n": total("n"), "x": total("x"), "y": total("y"), "below": weighted_median(group, flat["below"], flat["x"], len(pos)), "above": weighted_median(group, flat["above"], flat["n"] - flat["y"], len(pos))}


def _reduce(table: pa.Table) -> pa.Table:
    one = _combined(table)
    return pa.table({"gkey": table.column("gkey").slice(0, 1), "salt": table.column("salt").slice(0, 1), **{k: pa.array([one[k]], pa.list_(t)) for k, t in _TALLY}})


def _tree(tallies: DataFrame, most: int) -> DataFrame:
    """One row per gkey: summed counts and weighted medians, from groups of about ``FAN_IN`` blocks, then of such groups."""
    salts = -(-most // FAN_IN)
    while True:
        tallies = tallies.withColumn("salt", F.pmod(F.col("salt"), F.lit(salts)).cast("long")).groupBy("gkey", "salt").applyInArrow(_reduce, TALLY)
        if salts == 1:
            return tallies
        salts = -(-salts // FAN_IN)


# ----------------------------------------------------------------- multi-select

STATE = "gkey string, totals array<long>, pos array<int>, rank array<long>, place array<double>, lo array<double>, hi array<double>, pivot array<double>, found_pos array<int>, found array<double>"
_STATE = [("totals", pa.int64()), ("pos", pa.int32()), ("rank", pa.int64()), ("place", pa.float64()), ("lo", pa.float64()), ("hi", pa.float64()), ("pivot", pa.float64()), ("found_pos", pa.int32()), ("found", pa.float64())]
PIVOTS = len(COLUMNS) * len(GUARDS)


def _one_row(kinds, gkey, values: dict) -> pa.RecordBatch:
    return pa.record_batch([pa.array([gkey], pa.string()), *[pa.array([values[k]], pa.list_(t)) for k, t in kinds]], names=["gkey", *[k for k, _ in kinds]])


def _columns(batch: pa.RecordBatch, row: int, kinds) -> dict[str, np.ndarray]:
    return {k: batch.column(batch.schema.get_field_index(k))[row].values.to_numpy(zero_copy_only=False) for k, _ in kinds}


def _first_tallies(batches):
    """The proposals that came with the blocks, with their weights."""
    pos = np.arange(PIVOTS, dtype=np.int32)
    field = np.repeat([FIELDS.index(name) * CHANNELS + c for k, (_, name, _) in enumerate(STATS) for c in range(CHANNELS)], len(GUARDS))
    for batch in batches:
        for row in range(batch.num_rows):
            n = batch.column(2)[row].values.to_numpy(zero_copy_only=False)[field]
            v = batch.column(3)[row].values.to_numpy(zero_copy_only=False)
            yield _tally(batch.column(0)[row].as_py(), batch.column(1)[row].as_py(), {"pos": pos, "n": n, "x": n, "y": n, "below": v, "above": v})


def _tally(gkey: str, salt: int, values: dict) -> pa.RecordBatch:
    return pa.record_batch([pa.array([gkey], pa.string()), pa.array([salt], pa.int64()), *[pa.array([values[k]], pa.list_(t)) for k, t in _TALLY]], names=["gkey", "salt", *[k for k, _ in _TALLY]])


def _each(batch: pa.RecordBatch):
    """Rows one by one, as blocks are large."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _counted(batches):
    """Round 1: the three-way counts of all first pivots, per block and group; at the end of ``pos`` what lies below the
    values that the block keeps."""
    for batch in batches:
        for row in _each(batch):
            n = np.array(row["n"])
            regions = list(_regions(n, row["keep"], row["body"]))
            hidden = np.array([h for _, h in regions])
            size = np.array([n[FIELDS.index(STATS[k][1]) * CHANNELS + c] for k, c in COLUMNS])
            for g in row["states"]:
                pivots = np.array(g["pivot"]).reshape(len(COLUMNS), len(GUARDS))
                x = np.array([np.searchsorted(v, p, "left") for (v, _), p in zip(regions, pivots)]) + hidden[:, None]
                y = np.array([np.searchsorted(v, p, "right") for (v, _), p in zip(regions, pivots)]) + hidden[:, None]
                none = np.full(PIVOTS + len(COLUMNS), np.nan)
                yield _tally(g["gkey"], row["salt"], {"pos": np.arange(PIVOTS + len(COLUMNS), dtype=np.int32), "n": np.concatenate([np.repeat(size, len(GUARDS)), size]), "x": np.concatenate([x.ravel(), hidden]), "y": np.concatenate([y.ravel(), hidden]), "below": none, "above": none})


def _bracketed(batches):
    """From the summed counts of round 1: the ranks that a pivot hit, and for the others the range around them."""
    for batch in batches:
        for row in range(batch.num_rows):
            t = _columns(batch, row, _TALLY)
            pivots = batch.column(batch.schema.get_field_index("pivot"))[row].values.to_numpy(zero_copy_only=False).reshape(len(COLUMNS), len(GUARDS))
            x, y = (t[k][:PIVOTS].reshape(len(COLUMNS), len(GUARDS)) for k in "xy")
            total, hidden = t["n"][PIVOTS:], t["x"][PIVOTS:]
            out = {k: [] for k, _ in _STATE}
            for i, (k, c) in enumerate(COLUMNS):
                if not total[i]:
                    continue
                order = np.argsort(pivots[i], kind="stable")
                p, below, upto = pivots[i][order], x[i][order], y[i][order]
                for j, r in enumerate(wanted(total[i], STATS[k][2])):
                    at = i * 3 + j
                    hit = np.flatnonzero((below <= r) & (r < upto))
                    if len(hit):
                        out["found_pos"].append(at)
                        out["found"].append(p[hit[0]])
                        continue
                    under, over = np.flatnonzero(upto <= r), np.flatnonzero(below > r)
                    out["pos"].append(at)
                    least, most = int(upto[under[-1]] if len(under) else hidden[i]), int(below[over[0]] if len(over) else total[i])
                    out["rank"].append(int(r) - least)
                    out["place"].append((int(r) - least + 0.5) / (most - least))
                    out["lo"].append(p[under[-1]] if len(under) else -np.inf)
                    out["hi"].append(p[over[0]] if len(over) else np.inf)
                    out["pivot"].append(np.nan)
            yield _one_row(_STATE, batch.column(0)[row].as_py(), out | {"totals": t["n"][PIVOTS:]})


SLICES = TALLY + ", body binary"


def _slices(gkey, salt, pos, owner, v, pivot, place=0.5) -> pa.RecordBatch:
    """Counts and proposals of one block's open values ``v`` (sorted by owner, then value), and the values themselves.
    Without pivot the order statistic at ``place`` is proposed, else the medians of both sides."""
    m = len(pos)
    n = np.bincount(owner, minlength=m)
    start = np.concatenate(([0], np.cumsum(n)[:-1]))
    p = pivot[owner]
    fresh = np.isnan(pivot)  # no pivot yet: the whole range proposes
    x = np.where(fresh, n, np.bincount(owner[v < p], minlength=m))
    y = np.where(fresh, n, np.bincount(owner[v <= p], minlength=m))
    at = lambda i, some: np.where(some, v[np.clip(i, 0, max(len(v) - 1, 0))] if len(v) else np.nan, np.nan)
    values = {"pos": pos, "n": n, "x": x, "y": y, "below": at(start + np.where(fresh, np.minimum(n - 1, (place * n).astype(np.int64)), (x - 1) // 2), x > 0), "above": at(start + y + (n - y - 1) // 2, n > y)}
    row = _tally(gkey, salt, values)
    return pa.RecordBatch.from_arrays([*row.columns, pa.array([v.astype("<f8").tobytes()], pa.binary())], names=[*row.schema.names, "body"])


def _cut(batches):
    """Cuts the values between the first pivots around each open rank out of the blocks."""
    for batch in batches:
        for row in _each(batch):
            regions = [v for v, _ in _regions(np.array(row["n"]), row["keep"], row["body"])]
            for g in row["states"]:
                pos, lo, hi = np.array(g["pos"], np.int32), np.array(g["lo"]), np.array(g["hi"])
                opens = starts_of(pos // 3)
                parts = []
                for a, b in zip(opens, np.append(opens[1:], len(pos))):  # the ranks of one column together
                    v = regions[pos[a] // 3]
                    parts += [v[i:j] for i, j in zip(np.searchsorted(v, lo[a:b], "right"), np.searchsorted(v, hi[a:b], "left"))]
                owner = np.repeat(np.arange(len(pos)), [len(v) for v in parts])
                if len(owner):
                    yield _slices(g["gkey"], row["salt"], pos, owner, np.concatenate(parts), np.full(len(pos), np.nan), np.array(g["place"]))


def _narrowed(batches):
    """One visit: cuts what is ruled out off a block's open values, counts the pivot and proposes on both of its sides."""
    for batch in batches:
        for row in range(batch.num_rows):
            get = lambda k: batch.column(batch.schema.get_field_index(k))[row]
            held, n = get("held_pos").values.to_numpy(zero_copy_only=False), get("held_n").values.to_numpy(zero_copy_only=False)
            s = _columns(batch, row, [("pos", 0), ("lo", 0), ("hi", 0), ("pivot", 0)])
            v = np.frombuffer(get("body").as_py(), "<f8")
            place = np.full(len(held), -1)
            both, a, b = np.intersect1d(held, s["pos"], assume_unique=True, return_indices=True)
            place[a] = b
            owner = np.repeat(place, n)
            live = owner >= 0
            owner, v = owner[live], v[live]
            inside = (v > s["lo"][owner]) & (v < s["hi"][owner])
            owner, v = owner[inside], v[inside]
            if len(v):
                yield _slices(get("gkey").as_py(), get("salt").as_py(), s["pos"], owner, v, s["pivot"])


def _judged(batches):
    """The next state from the summed counts: pivots that are the value at their rank are found, the others choose a side."""
    for batch in batches:
        for row in range(batch.num_rows):
            t = _columns(batch, row, _TALLY)
            s = {k: batch.column(batch.schema.get_field_index(f"s_{k}"))[row].values.to_numpy(zero_copy_only=False) for k in ("pos", "rank", "lo", "hi", "pivot")}
            _, a, b = np.intersect1d(t["pos"], s["pos"], assume_unique=True, return_indices=True)
            x, y, below, above = (t[k][a] for k in ("x", "y", "below", "above"))
            pos, rank, lo, hi, pivot = (s[k][b] for k in ("pos", "rank", "lo", "hi", "pivot"))
            fresh = np.isnan(pivot)
            found = ~fresh & (x <= rank) & (rank < y)
            left = fresh | (rank < x)
            rank2 = np.where(left, rank, rank - y)
            lo2, hi2 = np.where(left, lo, pivot), np.where(left & ~fresh, pivot, hi)
            go = ~found
            yield _one_row(_STATE, batch.column(0)[row].as_py(), {"totals": [], "pos": pos[go], "rank": rank2[go], "place": [], "lo": lo2[go], "hi": hi2[go], "pivot": np.where(left, below, above)[go], "found_pos": pos[found], "found": pivot[found]})


def multi_select(blocks: DataFrame, groups: DataFrame, rounds: int = 200, log: list | None = None) -> tuple[DataFrame, DataFrame]:
    """(found, totals): (gkey, pos, value) for each group and wanted rank, and (gkey, column, n).

    ``blocks`` must be materialised; ``groups`` maps shard_id to gkey (a shard may be in several groups).  ``log`` receives
    the number of open ranks after each round."""
    spark = blocks.sparkSession
    placed = blocks.join(groups, "shard_id")
    most = placed.groupBy("gkey").count().agg(F.coalesce(F.max("count"), F.lit(0)).alias("m")).first()["m"]
    if not most:
        none = spark.createDataFrame([], STATE)
        return none.select("gkey", F.explode("found_pos").alias("pos"), F.lit(0.0).alias("value")), none.select("gkey", F.posexplode("totals").alias("column", "n"))
    pivots = _tree(placed.select("gkey", F.xxhash64("shard_id", "part").alias("salt"), "n", "proposed").mapInArrow(_first_tallies, TALLY), most)
    pivots, pivots_path = materialise(pivots.select("gkey", F.col("below").alias("pivot")), "select-pivots")

    def visited(state, names, kernel, schema):
        # A shard is in few groups (its own, its corpus, all), so the list is short.
        states = state.join(groups, "gkey").groupBy("shard_id").agg(F.collect_list(F.struct("gkey", *names)).alias("states"))
        return blocks.drop("proposed").join(states, "shard_id").select(F.xxhash64("shard_id", "part").alias("salt"), "keep", "n", "body", "states").mapInArrow(kernel, schema)

    counts = _tree(visited(pivots, ["pivot"], _counted, TALLY), most)
    state, path = materialise(counts.join(pivots, "gkey").mapInArrow(_bracketed, STATE), "select-state")
    drop_folder(spark, pivots_path)
    totals = state.select("gkey", F.posexplode("totals").alias("column", "n"))
    found = [state]
    slices, slices_path = None, None
    for turn in range(rounds):
        live = state.where(F.size("pos") > 0)
        n = live.agg(F.coalesce(F.sum(F.size("pos")), F.lit(0)).alias("n")).first()["n"]
        if log is not None:
            log.append(n)
        if not n:
            out = found[0]
            for s in found[1:]:
                out = out.unionByName(s)
            return out.select("gkey", F.explode(F.arrays_zip("found_pos", "found")).alias("f")).select("gkey", F.col("f.found_pos").alias("pos"), F.col("f.found").alias("value")), totals
        if turn == 0:
            cut = visited(live, ["pos", "place", "lo", "hi"], _cut, SLICES)
        else:
            now = live.select("gkey", "pos", "lo", "hi", "pivot")
            cut = slices.select("gkey", "salt", F.col("pos").alias("held_pos"), F.col("n").alias("held_n"), "body").join(now, "gkey").mapInArrow(_narrowed, SLICES)
        cut, cut_path = materialise(cut, "select-values")
        if slices_path:
            drop_folder(spark, slices_path)
        slices, slices_path = cut, cut_path
        tallied = _tree(slices.drop("body"), most)
        old = live.select("gkey", *[F.col(k).alias(f"s_{k}") for k in ("pos", "rank", "lo", "hi", "pivot")])
        state, path = materialise(tallied.join(old, "gkey").mapInArrow(_judged, STATE), "select-state")
        found.append(state)
    raise RuntimeError("multi-select did not end")


def bounds(selected: tuple[DataFrame, DataFrame]) -> DataFrame:
    """(gkey, stat_name, channel, n, low, value, high) from :func:`multi_select`."""
    found, totals = selected
    part = lambda k: F.max(F.when(F.col("pos") % 3 == k, F.col("value")))
    per = found.withColumn("column", F.floor(F.col("pos") / 3).cast("int")).groupBy("gkey", "column").agg(part(0).alias("low"), part(1).alias("value"), part(2).alias("high"))
    names = F.array(*[F.lit(s) for s, _, _ in STATS])
    both = per.join(totals, ["gkey", "column"])
    return both.select("gkey", F.get(names, F.floor(F.col("column") / CHANNELS).cast("int")).alias("stat_name"), (F.col("column") % CHANNELS).cast("long").alias("channel"), "n", "low", "value", "high")


def shard_groups(blocks: DataFrame) -> DataFrame:
    return blocks.select("shard_id").distinct().withColumn("gkey", F.concat(F.lit("shard:"), F.col("shard_id").cast("string")))


def percentiles(frames: DataFrame, shards: DataFrame, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Percentiles per shard, per corpus (``shards`` maps shard_id to corpus) and overall.  The rank of ``value`` is
    exact; ``low`` and ``high`` are the values 0.005 n ranks below and above it.  A shard without corpus counts overall."""
    blocks, _ = materialise(value_blocks(frames, block_rows, combine=True), "value-blocks")
    corpora = shards.where("shard_id is not null and corpus is not null").select("shard_id", F.concat(F.lit("corpus:"), F.lower(F.trim("corpus"))).alias("gkey")).distinct()
    ids = blocks.select("shard_id").distinct()
    groups = shard_groups(blocks).unionByName(corpora.join(ids, "shard_id", "left_semi")).unionByName(ids.withColumn("gkey", F.lit("overall")))
    groups, _ = materialise(groups, "shard-groups")
    return bounds(multi_select(blocks, groups))


def stale_entries(frames: DataFrame, global_stats: DataFrame, stage1_stats: DataFrame, block_rows: int = BLOCK_ROWS, log: list | None = None) -> DataFrame:
    """(shard_id, stat_name, channel): cached entries more than 0.005 n ranks off (by more than 1e-9 in value).  Null
    entries are no entries; those of a shard without frames cannot be judged and are not reported; entries of a repeated
    row count once; a NaN entry is off."""
    blocks, _ = materialise(value_blocks(frames, block_rows), "value-blocks")
    groups, _ = materialise(shard_groups(blocks), "shard-groups")
    found = bounds(multi_select(blocks, groups, log=log))
    entry = None
    for table, names in ((global_stats, ("state_q01", "state_q99", "action_q01", "action_q99")), (stage1_stats, ("thr_residual",))):
        for s in names:
            one = table.where("shard_id is not null").select("shard_id", F.lit(s).alias("stat_name"), F.posexplode(s).alias("channel", "entry")).where("entry is not null")
            entry = one if entry is None else entry.unionByName(one)
    entry = entry.withColumn("channel", F.col("channel").cast("long")).withColumn("gkey", F.concat(F.lit("shard:"), F.col("shard_id").cast("string")))
    off = (F.col("entry") < F.col("low") - 1e-9) | (F.col("entry") > F.col("high") + 1e-9)
    return entry.join(found, ["gkey", "stat_name", "channel"]).where(off).select("shard_id", "stat_name", "channel").distinct()


def p5_found(spark: SparkSession, root: str) -> DataFrame:
    """Cached percentiles that do not fit the shard's frames."""
    return stale_entries(*[spark.read.parquet(f"{root}/{t}.parquet") for t in ("frames", "global_stats", "stage1_global_stats")])


def p5_percentiles(spark: SparkSession, root: str) -> DataFrame:
    """Percentiles per shard, corpus and overall."""
    frames, episodes = (spark.read.parquet(f"{root}/{t}.parquet") for t in ("frames", "episodes"))
    out = percentiles(frames, episodes.select("shard_id", "corpus").distinct())
    return out.select("gkey", "stat_name", "channel", "n", *[F.round(c, 6).alias(c) for c in ("low", "value", "high")])


QUERIES = {"p5_found": p5_found, "p5_percentiles": p5_percentiles}
_D = """d AS (SELECT DISTINCT ON (episode_index, frame_index) shard_id, episode_index, frame_index, "observation.state" AS s, action AS a FROM frames),
        c AS (SELECT i FROM range(20) t(i)),
        o AS (SELECT shard_id, episode_index, i, row_number() OVER (PARTITION BY episode_index, i ORDER BY frame_index) AS k,
                count(*) OVER (PARTITION BY episode_index, i) AS m, CAST(s[i + 1] AS DOUBLE) AS x FROM d, c)"""
_CLAMPED = ", ".join(f"coalesce(lag(x, {k}) OVER w, first_value(x) OVER w) AS b{k}, coalesce(lead(x, {k}) OVER w, last_value(x) OVER f) AS a{k}" for k in (1, 2))
_FIR = " + ".join(f"{w} * coalesce({'lag' if k < 0 else 'lead'}(m5, {abs(k)}) OVER w, {'first_value(m5) OVER w' if k < 0 else 'last_value(m5) OVER f'})" if k else f"{w} * m5" for k, w in zip(range(-5, 6), (-36, 9, 44, 69, 84, 89, 84, 69, 44, 9, -36)))
_WINDOWS = "WINDOW w AS (PARTITION BY episode_index, i ORDER BY k), f AS (PARTITION BY episode_index, i ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING)"
_VALUES = f"""{_D},
        m AS (SELECT *, list_sort([b2, b1, x, a1, a2])[3] AS m5 FROM (SELECT *, {_CLAMPED} FROM o WHERE m >= 11 {_WINDOWS})),
        r AS (SELECT shard_id, i, abs(x - ({_FIR}) / 429) AS x FROM m {_WINDOWS}),
        v AS (SELECT shard_id, 'state' AS field, i, CAST(s[i + 1] AS DOUBLE) AS x FROM d, c
              UNION ALL SELECT shard_id, 'action', i, CAST(a[i + 1] AS DOUBLE) FROM d, c WHERE a IS NOT NULL
              UNION ALL SELECT shard_id, 'residual', i, x FROM r),
        q AS (SELECT * FROM (VALUES ('state_q01', 'state', 0.005::DOUBLE, 0.01::DOUBLE, 0.015::DOUBLE), ('state_q99', 'state', 0.985, 0.99, 0.995),
               ('action_q01', 'action', 0.005, 0.01, 0.015), ('action_q99', 'action', 0.985, 0.99, 0.995), ('thr_residual', 'residual', 0.985, 0.99, 0.995)) t(stat_name, field, lo, mid, hi))"""
ORACLES = {
    "p5_found": f"""
        WITH {_VALUES},
        l AS (SELECT shard_id, field, i, list_sort(list(x)) AS x, count(*) AS n FROM v WHERE x IS NOT NULL GROUP BY ALL),
        b AS (SELECT shard_id, stat_name, i, x[CAST(greatest(0, least(n - 1, floor(lo * n))) AS BIGINT) + 1] AS low,
                x[CAST(greatest(0, least(n - 1, ceil(hi * n))) AS BIGINT) + 1] AS high FROM l JOIN q USING (field)),
        e AS (SELECT shard_id, 'state_q01' AS stat_name, i, state_q01[i + 1] AS entry FROM global_stats, c
              UNION ALL SELECT shard_id, 'state_q99', i, state_q99[i + 1] FROM global_stats, c
              UNION ALL SELECT shard_id, 'action_q01', i, action_q01[i + 1] FROM global_stats, c
              UNION ALL SELECT shard_id, 'action_q99', i, action_q99[i + 1] FROM global_stats, c
              UNION ALL SELECT shard_id, 'thr_residual', i, thr_residual[i + 1] FROM stage1_global_stats, c)
        SELECT DISTINCT e.shard_id, e.stat_name, e.i AS channel FROM e JOIN b USING (shard_id, stat_name, i)
        WHERE entry < low - 1e-9 OR entry > high + 1e-9""",
    "p5_percentiles": f"""
        WITH {_VALUES},
        s AS (SELECT DISTINCT shard_id, lower(trim(corpus)) AS corpus FROM episodes WHERE shard_id IS NOT NULL AND corpus IS NOT NULL),
        g AS (SELECT 'shard:' || shard_id AS gkey, field, i, x FROM v UNION ALL SELECT 'overall', field, i, x FROM v
              UNION ALL SELECT 'corpus:' || corpus, field, i, x FROM v JOIN s USING (shard_id)),
        l AS (SELECT gkey, field, i, list_sort(list(x)) AS x, count(*) AS n FROM g WHERE x IS NOT NULL GROUP BY ALL)
        SELECT gkey, stat_name, i AS channel, n, round(x[CAST(greatest(0, least(n - 1, floor(lo * n))) AS BIGINT) + 1], 6) AS low,
               round(x[CAST(greatest(0, least(n - 1, ceil(mid * n) - 1)) AS BIGINT) + 1], 6) AS value, round(x[CAST(greatest(0, least(n - 1, ceil(hi * n))) AS BIGINT) + 1], 6) AS high
        FROM l JOIN q USING (field)""",
}
