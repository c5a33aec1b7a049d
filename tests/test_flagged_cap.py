from kinelake.operators import episode_filter
from kinelake.plans import frame_queries

from helpers import frame, frames_table, walk


def test_first_200_bad_frames(spark, monkeypatch):
    # Without confidence in any frame of episode 0, every one of them is bad.
    rows = [frame(e, t, x, x, [0.0] * 8 if e == 0 else [1.0] * 8) for e in range(2) for t, x in enumerate(walk(230, e))]
    monkeypatch.setattr(frame_queries, "_frames", lambda spark, root: frames_table(spark, rows))
    got = frame_queries.filter_flagged_cap(spark, "")
    assert sorted(r["frame_index"] for r in got.where("episode = 0").collect()) == list(range(200))
    bad = episode_filter.judged_frames(frames_table(spark, rows)).where("episode = 1 and bad").count()
    assert got.where("episode = 1").count() == bad < 200
