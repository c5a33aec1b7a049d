"""Prefix truncation on a stream: a frame is kept until its episode's first bad frame.

State is one number per episode, the least bad frame seen.  Frames may arrive late: the verdict uses what has been seen
up to the trigger.  Only episodes with a bad frame hold state, and it is kept, since a late frame may still follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

OUT = "episode long, frame long, keep int"


def _truncate(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    first = state.get[0] if state.exists else None
    frames = pd.concat(list(batches)).sort_values("frame")
    bad = frames.loc[frames["bad"].fillna(False).astype(bool), "frame"]
    if len(bad):
        first = int(bad.min()) if first is None else min(first, int(bad.min()))
        state.update((first,))
    keep = frames["frame"] < first if first is not None else pd.Series(True, index=frames.index)
    yield pd.DataFrame({"episode": key[0], "frame": frames["frame"].astype("int64"), "keep": keep.astype("int32")})


def prefix_keep_stream(frames: DataFrame) -> DataFrame:
    """(episode, frame, keep) for a streaming (episode, frame, bad); a null ``bad`` is no bad frame."""
    return frames.groupBy("episode").applyInPandasWithState(_truncate, OUT, "first long", "append", GroupStateTimeout.NoTimeout)
