import numpy as np
import pytest

from kinelake.llm import percentiles as p

from helpers import frame, frames_table, walk


def data(spark, sizes, seed=0):
    rng = np.random.default_rng(seed)
    rows, per = [], {}
    e = 0
    for shard, n in sizes.items():
        while n:
            m = min(n, int(rng.integers(5, 60)))
            x, y = walk(m, e), np.float32(rng.choice([0.0, 0.25, 0.5], (m, 20)))
            rows += [frame(e, i, x[i], y[i] if i % 9 else None, shard=shard) for i in range(m)]
            per.setdefault(shard, []).append((x, y[[i for i in range(m) if i % 9]]))
            n, e = n - m, e + 1
    return rows, per


def residual(x):
    x = x.astype(float)
    m = np.median(np.stack([np.pad(x, [(2, 2), (0, 0)], mode="edge")[k : k + len(x)] for k in range(5)]), axis=0)
    pad = np.pad(m, [(5, 5), (0, 0)], mode="edge")
    return np.abs(x - sum(c * pad[k : k + len(x)] for k, c in enumerate(p.SAVGOL)))


def truth(parts):
    out = {}
    fields = {"state": [x for x, _ in parts], "action": [y for _, y in parts], "residual": [residual(x) for x, _ in parts if len(x) >= 11]}
    for stat, field, q in p.STATS:
        for c in range(20):
            v = np.sort(np.concatenate([f[:, c] for f in fields[field]]).astype(float)) if fields[field] else []
            if len(v):
                out[stat, c] = tuple(v[int(r)] for r in p.wanted(len(v), q))
    return out


@pytest.mark.parametrize("block_rows", [100_000, 40])
def test_against_sorting(spark, block_rows):
    rows, per = data(spark, {1: 600, 2: 50, 3: 7})
    shards = spark.createDataFrame([(1, "a"), (2, "A "), (3, None)], "shard_id long, corpus string")
    got = {(r["gkey"], r["stat_name"], r["channel"]): (r["low"], r["value"], r["high"]) for r in p.percentiles(frames_table(spark, rows + rows[:30]), shards, block_rows).collect()}
    groups = {"shard:1": [1], "shard:2": [2], "shard:3": [3], "corpus:a": [1, 2], "overall": [1, 2, 3]}
    want = {(g, s, c): v for g, ids in groups.items() for (s, c), v in truth([x for i in ids for x in per[i]]).items()}
    assert set(got) == set(want)
    for k in want:
        assert np.allclose(got[k], want[k], atol=1e-12), k


@pytest.mark.parametrize("block_rows", [100_000, 64])
def test_stale_entries(spark, block_rows):
    rows, per = data(spark, {1: 400, 2: 300})
    entries, first = {s: {} for s in (1, 2)}, {}
    for s in (1, 2):
        t = truth(per[s])
        for stat, _, _ in p.STATS:
            entries[s][stat] = [float(t[stat, c][1]) for c in range(20)]
    entries[1]["state_q99"][3] += 1.0
    entries[2]["thr_residual"][7] = 0.0
    entries[2]["action_q01"][0] = None
    g = spark.createDataFrame([(s, *[entries[s][n] for n in ("state_q01", "state_q99", "action_q01", "action_q99")]) for s in (1, 2, 2)] + [(9, [0.0], [0.0], [0.0], None)], "shard_id long, state_q01 array<double>, state_q99 array<double>, action_q01 array<double>, action_q99 array<double>")
    h = spark.createDataFrame([(s, entries[s]["thr_residual"]) for s in (1, 2)], "shard_id long, thr_residual array<double>")
    got = {tuple(r) for r in p.stale_entries(frames_table(spark, rows), g, h, block_rows).collect()}
    assert got == {(1, "state_q99", 3), (2, "thr_residual", 7)}


def test_nulls_and_empty(spark):
    shards = spark.createDataFrame([], "shard_id long, corpus string")
    assert p.percentiles(frames_table(spark, []), shards).count() == 0
    rows = [frame(1, 0, None, [None] * 20), frame(1, 1, [float("nan")] * 20, []), frame(None, 2, [1.0] * 20), frame(1, 3, [2.0] * 20)]
    got = p.percentiles(frames_table(spark, rows), shards).where("gkey = 'overall'").collect()
    assert {r["stat_name"] for r in got} == {"state_q01", "state_q99"} and all(r["value"] == 2.0 and r["n"] == 1 for r in got)


def test_values_survive_packing():
    rng = np.random.default_rng(0)
    fields = [np.float32(rng.normal(size=30)), np.float32(rng.normal(size=20)), rng.normal(size=10)]
    for a, b in zip(p.unpack_values(p.pack_values(fields), [30, 20, 10]), fields):
        assert (a == b).all()


def test_every_rank_passes_through_rounds(spark):
    """Also a shard of a few dozen rows is selected by proposals, pivots, counts and cuts."""
    rows, per = data(spark, {1: 300, 2: 20})
    blocks = p.materialise(p.value_blocks(frames_table(spark, rows)), "b")[0]
    assert blocks.where("shard_id = 1").count() > 1
    log = []
    found, _ = p.multi_select(blocks, p.shard_groups(blocks), log=log)
    assert len(log) > 2 and log[0] > 0 and log[-1] == 0
    assert found.count() == 2 * 300


def test_tree_of_many_blocks(spark, monkeypatch):
    """More blocks than the fan-in: the reduction takes several levels and gives the same values."""
    rows, per = data(spark, {k: 60 for k in range(12)})
    shards = spark.createDataFrame([(k, "a") for k in range(12)], "shard_id long, corpus string")
    frames = frames_table(spark, rows)
    got = {(r["gkey"], r["stat_name"], r["channel"]): (r["low"], r["value"], r["high"]) for r in p.percentiles(frames, shards).collect()}
    monkeypatch.setattr(p, "FAN_IN", 4)
    small = {(r["gkey"], r["stat_name"], r["channel"]): (r["low"], r["value"], r["high"]) for r in p.percentiles(frames, shards).collect()}
    assert got == small
    want = truth([x for k in range(12) for x in per[k]])
    for (s, c), v in want.items():
        assert np.allclose(got["overall", s, c], v, atol=1e-12)
