"""Rows delivered more than once, and frame blocks that keep a huge episode off a single task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def block_of(frame: Column, span: int) -> Column:
    return F.floor(frame / F.lit(span)).cast("long")


def with_halo(df: DataFrame, span: int, halo: int, frame: str = "frame_index") -> DataFrame:
    """Adds ``block`` (frame div span) and repeats rows within ``halo`` frames of a block's border in the blocks beyond
    it, so that rules that look at most ``halo`` frames away are exact inside each block.  ``own`` marks a row's own
    block.  Block 0 takes nothing from negative frame numbers.  An episode shorter than ``span - halo`` frames gains no
    row."""
    f = F.col(frame)
    blocks = F.filter(F.sequence(block_of(f - halo, span), block_of(f + halo, span)), lambda b: (b >= 0) | (b == block_of(f, span)))
    return df.withColumn("block", F.explode(blocks)).withColumn("own", F.col("block") == block_of(f, span))


def once(df: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Keeps one row of each run of equal ``keys + order``; leaves the partitions clustered by ``keys`` and sorted by
    ``keys + order``.  Repeated deliveries hold equal content, so which of them stays makes no difference."""
    w = Window.partitionBy(*keys).orderBy(*order)
    last = order[-1]
    return df.withColumn("_before", F.lag(last).over(w)).where(f"_before is null or _before <> {last}").drop("_before")
