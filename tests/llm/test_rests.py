import numpy as np

from kinelake.llm import rests as r

from helpers import frame, frames_table, walk


def track(n, stops, seed=0):
    x = walk(n, seed)
    for a, b in stops:
        x[a : b + 1] = x[a]
    return x


def found(spark, rows):
    return sorted(tuple(x)[:4] for x in r.rests(frames_table(spark, rows)).collect())


def test_runs_counts_and_edges(spark):
    x = track(60, [(0, 3), (20, 22), (30, 31), (50, 59)])
    rows = [frame(1, i, x[i], x[i]) for i in range(60)]
    assert found(spark, rows) == [(1, 0, 3, 4), (1, 20, 22, 3), (1, 50, 59, 10)]
    d = {x[1]: x[4] for x in (tuple(v) for v in r.rests(frames_table(spark, rows)).collect())}
    assert abs(d[50] - 9 / 30) < 1e-5


def test_gap_null_and_action_end_a_run(spark):
    x, y = track(40, [(5, 14), (20, 29)]), track(40, [(5, 14), (20, 29)], 7)
    y[25] += 0.1
    rows = [frame(1, i, x[i], None if i == 10 else y[i]) for i in range(40) if i != 12]
    assert found(spark, rows) == [(1, 5, 9, 5), (1, 20, 24, 5), (1, 26, 29, 4)]


def test_epsilon_and_nan(spark):
    x = np.full((10, 20), 0.25, np.float32)
    x[:, 3] += np.arange(10, dtype=np.float32) * 0.0004
    assert found(spark, [frame(1, i, x[i], x[i]) for i in range(10)]) == [(1, 0, 9, 10)]
    x[5, 7] = np.nan
    assert found(spark, [frame(1, i, x[i], x[i]) for i in range(10)]) == [(1, 0, 4, 5), (1, 6, 9, 4)]
    assert found(spark, [frame(1, i, [], []) for i in range(5)]) == []


def test_repeats_order_blocks(spark, monkeypatch):
    x = track(200, [(60, 70), (100, 140)])
    rows = [frame(e, i, x[i], x[i]) for e in (1, 2) for i in range(200)]
    rows += rows[50:80] + [frame(None, 1, x[0], x[0]), frame(1, None, x[0], x[0])]
    rows = [rows[i] for i in np.random.default_rng(1).permutation(len(rows))]
    want = [(e, a, b, b - a + 1) for e in (1, 2) for a, b in ((60, 70), (100, 140))]
    assert found(spark, rows) == want and found(spark, []) == []
    monkeypatch.setattr(r, "SPAN", 8)
    assert found(spark, rows) == want


def test_collapse(spark):
    x = track(30, [(10, 19)])
    rows = [frame(1, i, x[i], x[i]) for i in range(30)] + [frame(None, 5, x[0], x[0])]
    df = frames_table(spark, rows).selectExpr("*", "'keep' as note", "0 as rest_frames", "1 as first_frame")
    out = r.collapse_rests(df).where("episode_index is not null").orderBy("frame_index").collect()
    assert [v["frame_index"] for v in out] == [*range(11), *range(20, 30)]
    assert out[10]["rest_frames"] == 10 and out[9]["rest_frames"] == 1 and out[0]["note"] == "keep" and np.allclose(out[3]["action"], x[3])
    assert r.collapse_rests(df).where("episode_index is null").count() == 1
