import numpy as np

from kinelake.operators import anomalies as a

from helpers import frame, frames_table, walk

EPISODES = "episode_index long, rig_id string"


def found(spark, rows, episodes=((1, "r"), (2, "r"), (3, "r"))):
    df = a.implausible_readings(frames_table(spark, rows), spark.createDataFrame(list(episodes), EPISODES))
    return {(r["episode_index"], r["frame_index"], r["field_name"], r["channel"]): r["kind"] for r in df.collect()}


def episode(e, n=120, seed=None, confidence=False):
    x, y = walk(n, e if seed is None else seed), walk(n, 100 + e)
    c = np.clip(walk(n, 200 + e, 8) + 0.3, 0.01, 0.99) if confidence else None
    return x, y, c


def rows_of(e, x, y, c=None, skip=()):
    return [frame(e, i, x[i], y[i], None if c is None else c[i]) for i in range(len(x)) if i not in skip]


def test_clean_track_has_no_case(spark):
    rows = [r for e in (1, 2, 3) for r in rows_of(e, *episode(e, confidence=True))]
    assert found(spark, rows) == {}


def test_spikes_of_one_to_three_frames(spark):
    x, y, _ = episode(1)
    x[30, 4] += 0.4
    x[50:52, 0] -= 0.3
    y[70:73, 14] += 0.5
    x[90:95, 3] += 0.4  # five frames: an excursion, not a spike
    x[100:, 1] += 0.4  # does not come back
    got = found(spark, rows_of(1, x, y) + rows_of(2, *episode(2)))
    want = {(1, 30, "observation.state", 4), (1, 50, "observation.state", 0), (1, 51, "observation.state", 0)} | {(1, i, "action", 14) for i in (70, 71, 72)}
    assert set(got) == want and set(got.values()) == {"spike"}


def test_frozen_stretch(spark):
    x, y, _ = episode(1)
    x[20:30, 5] = x[20, 5]  # ten readings: nine cases
    x[60:67, 6] = x[60, 6]  # seven: too short
    got = found(spark, rows_of(1, x, y) + rows_of(2, *episode(2)))
    assert got == {(1, i, "observation.state", 5): "frozen" for i in range(21, 30)}


def test_rest_is_no_case(spark):
    x, y, _ = episode(1)
    x[20:40], y[20:40] = x[20], y[20]
    assert found(spark, rows_of(1, x, y) + rows_of(2, *episode(2))) == {}


def test_bounds(spark):
    x, y, c = episode(1, confidence=True)
    x[10, 0], x[11, 3], x[12, 9], y[13, 19], c[14, 0] = 9999, 1.2, -0.05, -1, 1.5
    got = found(spark, rows_of(1, x, y, c) + rows_of(2, *episode(2, confidence=True)))
    assert got == {(1, 10, "observation.state", 0): "bounds", (1, 11, "observation.state", 3): "bounds", (1, 12, "observation.state", 9): "bounds", (1, 13, "action", 19): "bounds", (1, 14, "observation.confidence", 0): "bounds"}


def test_judged_by_rig(spark):
    """The same jump is a spike on a calm rig and ordinary on a jittery one."""
    calm, jitter = walk(400, 1), 0.3 + np.float32(np.random.default_rng(5).normal(0, 0.05, (400, 20)))
    calm[50, 4] += 0.15
    y = walk(400, 9)
    got = found(spark, rows_of(1, calm, y) + rows_of(2, np.clip(jitter, 0.01, 0.9), y), [(1, "calm"), (2, "jitter")])
    assert set(got) == {(1, 50, "observation.state", 4)}


def test_repeats_nulls_unknown_rig_and_order(spark):
    x, y, _ = episode(1)
    x[30, 4] += 0.4
    rows = rows_of(1, x, y)
    rows = rows + rows[25:35] + [frame(1, None, x[0], y[0]), frame(None, 3, x[0], y[0]), frame(2, 0, None, None), frame(2, 1, [None] * 20, [float("nan")] * 20)]
    rows = [rows[i] for i in np.random.default_rng(0).permutation(len(rows))]
    assert set(found(spark, rows, [])) == {(1, 30, "observation.state", 4)}
    assert found(spark, []) == {}


def test_blocks_do_not_matter(spark, monkeypatch):
    """Spikes at borders, rounds that feed each other, gaps, null stretches and frozen stretches longer than block and halo."""
    rng = np.random.default_rng(3)
    x, y, _ = episode(1, 1500)
    for i in (31, 32, 63, 64, 127, 128, 129, 255, 256, 257, 511, 512, 1023, 1024):
        x[i, 4] += 0.4
        y[i, int(rng.integers(20))] -= 0.5
    for i in range(600, 720, 2):  # a comb: every reading that is taken out uncovers others
        x[i, 2] += 0.3 + 0.01 * (i % 7)
    x[120:140, 7] = x[120, 7]
    x[200:900, 5] = x[200, 5]
    y[60:66, 3] = y[60, 3]
    y[250:262, 11] = y[250, 11]
    x[1100:1400, 8] = x[1100, 8]
    x[1150:1400, [0, 1, 2, 3, 4, 5, 6, 7, 9]] = x[1150, [0, 1, 2, 3, 4, 5, 6, 7, 9]]  # moves for too small a part of the run
    rows = rows_of(1, x, y, skip={50, 65, 66, 192, *range(300, 310), *range(770, 830)})
    rows = [r[:9] + (None,) + r[10:] if 380 <= r[1] < 500 else r for r in rows]
    whole = found(spark, rows)
    assert len(whole) > 600 and {"spike", "frozen"} <= set(whole.values())
    for span in (64, 256):
        monkeypatch.setattr(a, "SPAN", span)
        assert found(spark, rows) == whole, span
