"""Small frames tables and a DuckDB oracle for tests."""

import numpy as np

FRAMES = "episode_index long, frame_index long, index long, task_index long, shard_id long, file_id long, timestamp float, timestamps long, `observation.state` array<float>, action array<float>, `observation.confidence` array<float>, ingest_ts timestamp_ntz"


def frame(episode, index, state=None, action=None, confidence=None, shard=1, file=1, timestamp=None):
    f = lambda v: None if v is None else [None if x is None else float(np.float32(x)) for x in v]
    return (episode, index, None, 0, shard, file, index / 30 if timestamp is None and index is not None else timestamp, None, f(state), f(action), f(confidence), None)


def frames_table(spark, rows):
    return spark.createDataFrame(rows, FRAMES)


def walk(n, seed=0, width=20):
    """A smooth track inside the bounds of every channel."""
    rng = np.random.default_rng(seed)
    x = np.cumsum(rng.normal(0, 0.004, (n, width)), axis=0) + 0.3
    return np.float32(x)


def oracle(root, sql):
    import os

    import duckdb

    c = duckdb.connect()
    for f in os.listdir(root):
        p = f"{root}/{f}"
        c.execute(f"create view {f.split('.')[0]} as select * from '{p + '/*.parquet' if os.path.isdir(p) else p}'")
    return c.execute(sql).df()


def same_rows(spark_df, duck_df):
    """Rows as sorted strings, floats rounded; (missing, extra) for the assertion message."""
    got = spark_df.toPandas()
    cols = sorted(got.columns)
    assert sorted(duck_df.columns) == cols

    def text(v):
        if v is None or v != v:
            return "-"
        try:
            return f"{round(float(v), 5) + 0.0:.5f}"
        except (TypeError, ValueError):
            return str(v)

    a = sorted(tuple(text(x) for x in r) for r in got[cols].itertuples(index=False))
    b = sorted(tuple(text(x) for x in r) for r in duck_df[cols].astype(object).itertuples(index=False))
    in_a, in_b = set(a), set(b)
    return a == b, [x for x in a if x not in in_b][:3], [x for x in b if x not in in_a][:3]
