import random

import pytest

from kinelake.llm import splits as s

EPISODES = "episode_index long, episode_id string, task_name string, task_index long, corpus string, split_name string, length long, ingest_ts timestamp_ntz"
TASKS = "task_index long, task_name string"


def components(edges):
    root = {}

    def find(v):
        while root.setdefault(v, v) != v:
            v = root[v]
        return v

    for u, v in edges:
        root[find(u)] = find(v)
    groups = {}
    for v in list(root):
        groups.setdefault(find(v), set()).add(v)
    return {frozenset(g) for g in groups.values()}


@pytest.mark.parametrize("shape", ["random", "chain", "star", "two"])
def test_spanning_forest(spark, shape):
    rng = random.Random(3)
    edges = {"random": [(f"v{rng.randrange(60)}", f"v{rng.randrange(60)}") for _ in range(45)], "chain": [(f"v{i}", f"v{i + 1}") for i in range(40)], "star": [("hub", f"v{i}") for i in range(40)], "two": [("a", "b"), ("b", "a"), ("c", "d")]}[shape]
    df = spark.createDataFrame(edges + edges[:5] + [("x", "x"), (None, "y")], "u string, v string")
    label, forest = s.spanning_forest(df)
    groups = {}
    for r in label.collect():
        groups.setdefault(r["root"], set()).add(r["vertex"])
    want = components([e for e in edges if e[0] != e[1]])
    assert {frozenset(g) for g in groups.values()} == want
    tree = {frozenset(r) for r in forest.collect()}
    assert len(tree) == sum(len(g) - 1 for g in want) and components([tuple(t) for t in tree]) == want


def test_forest_of_nothing(spark):
    label, forest = s.spanning_forest(spark.createDataFrame([], "u string, v string"))
    assert label.count() == 0 and forest.count() == 0


@pytest.mark.parametrize("text,number", [("000012_seg0", "12"), ("ep-000012-S01", "12"), ("EP000012_SEG3", "12"), ("seg0_of_000012", "12"), ("12_seg1", "12"), ("000012b", "12"), ("dexlab/fold_1/000012_seg0", "12"), ("000012_seg1.hdf5", "12"), ("000_seg1", "0"), ("none", None), ("", None), (None, None)])
def test_recording_number(spark, text, number):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(s.recording_number(df["t"])).first()[0] == number


def test_torn_recordings(spark):
    rows = [(1, "000001_seg0", "Fold Towel", 0, "a", "train", 10, None), (2, "ep-000001-S01", None, 0, "a", "test", 10, None), (3, "seg2_of_000001", "fold_towel", 0, "A", "train", 10, None), (4, "000001_seg0", "fold_towel", 0, "b", "test", 10, None), (5, "000001_seg3", "foldTowel", 0, "a", None, 10, None), (6, "000002_seg0", "fold towel", 0, "a", "test", None, None), (7, None, None, None, None, "test", 5, None), (None, "000001_seg0", "x", 0, "a", "test", 1, None)]
    rows += rows[:2]
    e, t = spark.createDataFrame(rows, EPISODES), spark.createDataFrame([(0, "fold_towel")], TASKS)
    plan = spark.createDataFrame([("train", 0.5), ("test", 0.5)], "split_name string, target_share double")
    frames = spark.createDataFrame([(i, k, k) for i, n in ((1, 30), (2, 5), (4, 7), (9, 3)) for k in [*range(n), 0]] + [(1, None, 0), (None, 1, 0)], "episode_index long, frame_index long, index long")
    assigned, _ = s.assign_splits(e, t, plan, frames)
    assert {r["episode_index"]: r["n_frames"] for r in assigned.collect()} == {1: 30, 2: 5, 3: 0, 4: 7, 5: 0, 6: 0, 7: 0}
    shares = {r["split"]: r for r in s.reached_shares(assigned, plan).collect()}
    assert set(shares) == {"train", "test"} and sum(r["n_frames"] for r in shares.values()) == 42 and sum(r["n_episodes"] for r in shares.values()) == 7
    out = {r["episode_index"]: r for r in assigned.collect()}
    assert len(out) == 7 and len({out[i]["split"] for i in (1, 2, 3, 5)}) == 1
    assert {tuple(r) for r in s.torn_apart(assigned).collect()} == {(1, 2), (2, 3)}


def test_shares(spark):
    rng = random.Random(5)
    sizes = [(f"g{i}", int(rng.paretovariate(1.2) * 20)) for i in range(4000)] + [("giant", 30_000), ("none", None)]
    plan = spark.createDataFrame([("train", 0.8), ("validation", 0.1), ("test", 0.1)], "split_name string, target_share double")
    got = s.deal(spark.createDataFrame(sizes, "group string, size long"), plan).collect()
    assert len(got) == len(sizes) and len({r["group"] for r in got}) == len(sizes)
    total = sum(r["size"] for r in got)
    for name, share in (("train", 0.8), ("validation", 0.1), ("test", 0.1)):
        assert abs(sum(r["size"] for r in got if r["split"] == name) / total - share) < 0.02
    empty = spark.createDataFrame([], "group string, size long")
    assert s.deal(empty, plan).count() == 0 and s.deal(spark.createDataFrame(sizes, "group string, size long"), plan.limit(0)).where("split is not null").count() == 0


def test_shares_of_the_plan(spark):
    """On the test tables the splits are within half a percent of the plan's shares of the frames present."""
    for r in s.p6_shares(spark, "/root/testdata/sf0.01").collect():
        assert abs(r["off"]) < 0.005, r
