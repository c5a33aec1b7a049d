import numpy as np

from kinelake.operators import imputation as m

SCHEMA = "episode_index long, frame_index long, rig_id string, joint_frame string, left_keypoints array<float>, right_keypoints array<float>, obs_head_pose array<float>, camera_pose_valid boolean, ingest_ts timestamp_ntz"
GOOD, BAD = [0.1, 0.2, 0.3, 1.0, 0.0, 0.0, 0.0], [0.0] * 7


def hand(seed, wrist=False):
    x = np.float32(np.random.default_rng(seed).uniform(0.1, 0.5, 63))
    if wrist:
        x[:3] = 0
    return [float(v) for v in x]


def row(e, i, left, right, frame="world", rig="r", pose=GOOD, flag=True):
    return (e, i, rig, frame, left, right, pose, flag, None)


def run(spark, rows):
    full = m.complete_keypoints(spark.createDataFrame(rows, SCHEMA))
    full = full.cache()
    return {(r["episode_index"], r["frame_index"]): r for r in full.collect()}, {tuple(r) for r in m.filled_cases(full).collect()}


def base(n=30):
    return [row(1, i, hand(i), hand(100 + i), pose=BAD if i % 7 == 0 else GOOD, flag=i % 7 != 0) for i in range(n)]


def test_complete_rows_stay(spark):
    full, cases = run(spark, base())
    assert cases == set() and np.allclose(full[1, 4]["left_keypoints"], hand(4))


def test_missing_kinds_and_time(spark):
    rows = base()
    left = hand(5)
    left[3:6] = [0.0, 0.0, 0.0]
    left[6:9] = [1e9] * 3
    left[9:12] = [-1e10] * 3
    left[12] = float("nan")
    left[15] = None
    rows[5] = row(1, 5, left, hand(105)[:61])
    rows[6] = row(1, 6, None, [])
    full, cases = run(spark, rows)
    want = {(1, 5, "left_keypoints", j) for j in (1, 2, 3, 4, 5)} | {(1, 5, "right_keypoints", 20)} | {(1, 6, h, j) for h in m.HANDS for j in range(21)}
    assert cases == want
    r = full[1, 5]
    assert r["left_keypoints_filled"][1] == "episode" and r["left_keypoints_filled"][0] is None
    line = (2 * np.array(hand(4)) + np.array(hand(7))) / 3  # frames 4 and 7 are the nearest measured ones of joint 1
    assert np.allclose(r["left_keypoints"][3:6], line[3:6], atol=1e-6)
    assert all(len(x["left_keypoints"]) == 63 and np.isfinite(x["left_keypoints"]).all() for x in full.values())


def test_flag_by_dependency_and_fallback(spark):
    rows = base()
    rows[3], rows[7] = row(1, 3, hand(3), hand(103), flag=None), row(1, 7, hand(7), hand(107), pose=BAD, flag=None)
    full, cases = run(spark, rows)
    assert cases == {(1, 3, "camera_pose_valid", -1), (1, 7, "camera_pose_valid", -1)}
    assert full[1, 3]["camera_pose_valid"] is True and full[1, 7]["camera_pose_valid"] is False
    assert full[1, 7]["camera_pose_valid_filled"] == "dependency"
    few = [row(1, 0, hand(0), hand(1), flag=True), row(1, 1, hand(0), hand(1), flag=None), row(2, 0, hand(0), hand(1), rig="q", flag=None)]
    full, _ = run(spark, few)
    assert full[1, 1]["camera_pose_valid_filled"] == "episode" and full[2, 0]["camera_pose_valid_filled"] == "default"


def test_wrist_origin(spark):
    rows = [row(1, i, hand(i, True), hand(50 + i, True), "wrist") for i in range(30)]
    lost = hand(3, True)
    lost[3:] = [0.0] * 60
    rows[3] = row(1, 3, lost, hand(53, True), "wrist")
    gone = hand(4, True)
    gone[0] = float("nan")
    rows[4] = row(1, 4, gone, hand(54, True), "wrist")
    full, cases = run(spark, rows)
    assert cases == {(1, 3, "left_keypoints", j) for j in range(21)} | {(1, 4, "left_keypoints", 0)}
    assert full[1, 4]["left_keypoints"][:3] == [0.0, 0.0, 0.0] and full[1, 4]["left_keypoints_filled"][0] == "dependency"


def test_group_fallback_repeats_and_empty(spark):
    rows = base() + base()[:5]
    rows += [row(2, 0, None, None), row(3, 0, None, None, rig="other"), row(4, 0, None, None, rig=None, frame=None), row(None, 0, None, None), row(5, None, None, None)]
    full, cases = run(spark, rows)
    assert full[2, 0]["left_keypoints_filled"][0] == "rig" and full[3, 0]["left_keypoints_filled"][0] == "reference" and full[4, 0]["left_keypoints_filled"][0] == "overall"
    assert len(cases) == 3 * 42 and len(full) == 33
    nothing, cases = run(spark, [])
    assert nothing == {} and cases == set()
    alone, _ = run(spark, [row(1, 0, None, None)])
    assert alone[1, 0]["left_keypoints_filled"][0] == "default"


def test_mining(spark):
    df = spark.createDataFrame([("a", "x", i, 1) for i in range(20)] + [("b", "x", 100 + i, 2) for i in range(20)] + [("c", None, 7, 3)], "p string, q string, k long, v int")
    got = {r["determinant"]: r for r in m.mine_dependencies(df, "v", [["p"], ["q"], ["k"], ["p", "q"]]).collect()}
    assert got["p"]["verified"] and not got["q"]["verified"] and not got["k"]["verified"] and got["p,q"]["verified"]
    filled, names = m.fill_by_dependency(df, "v", [["q"], ["p"]])
    assert names == ["p"] and filled.where("_filled <> v").count() == 0


def test_blocks_do_not_matter(spark, monkeypatch):
    """Gaps longer than a block, at an episode's start and end, and flags far away give the same with any block size."""
    rng = np.random.default_rng(1)
    rows = []
    for e, n in ((1, 600), (2, 90), (3, 300)):
        for i in range(n):
            left = None if e == 1 and 180 <= i < 400 or e == 3 and (i < 150 or i >= 200) else hand(i)
            right = hand(i + 1000)
            for j in np.flatnonzero(rng.random(21) < 0.3):
                right[3 * j] = None
            flag = None if 200 <= i < 300 or i < 5 else bool((i // 40) % 2)
            if i % 97 != 3:
                rows.append(row(e, i, left, right, pose=GOOD if i % 2 else BAD, flag=flag))
    whole, cases = run(spark, rows)
    assert whole[1, 250]["left_keypoints_filled"][4] == "episode" and whole[1, 250]["camera_pose_valid_filled"] == "episode"
    a, b = np.array(hand(179)), np.array(hand(400))
    assert np.allclose(whole[1, 181]["left_keypoints"], a + (b - a) * 2 / 221, atol=1e-6)
    for span in (16, 64, 256):
        monkeypatch.setattr(m, "SPAN", span)
        other, others = run(spark, rows)
        assert others == cases
        for k, r in whole.items():
            assert np.allclose(other[k]["left_keypoints"], r["left_keypoints"], atol=1e-12) and np.allclose(other[k]["right_keypoints"], r["right_keypoints"], atol=1e-12)
            assert [other[k][c] for c in ("left_keypoints_filled", "right_keypoints_filled", "camera_pose_valid", "camera_pose_valid_filled")] == [r[c] for c in ("left_keypoints_filled", "right_keypoints_filled", "camera_pose_valid", "camera_pose_valid_filled")], (span, k)
