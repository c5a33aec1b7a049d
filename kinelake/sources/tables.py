"""Readers for the project's Parquet tables and metadata files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The table ``name`` under ``root`` (a Parquet file or folder)."""
    return spark.read.parquet(f"{root}/{name}.parquet")


def read_jsonl(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """Newline-delimited JSON; blank lines are skipped, a missing file gives an empty table if ``schema`` is given."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    if schema is not None and "://" not in path and not os.path.exists(path):
        return spark.createDataFrame([], schema)
    return reader.json(path)


def read_document(spark: SparkSession, path: str) -> DataFrame:
    """One JSON document (such as ``info.json`` or a calibration file) as one row."""
    return spark.read.json(path, multiLine=True)


def dataset_info(info: dict) -> dict:
    """What an information file says: fps, chunk size, totals, the shape of every feature as a tuple (a number, a list or a
    nested list are understood), and the video keys, which are the features of type video."""
    features = info.get("features") or {}

    def shape(given):
        given = given.get("shape") if isinstance(given, dict) else given
        if given is None:
            return ()
        if isinstance(given, (int, float)):
            return (int(given),)
        while len(given) == 1 and isinstance(given[0], (list, tuple)):
            given = given[0]
        return tuple(int(n) for n in given)

    return {
        "fps": float(info.get("fps") or 30), "chunk_size": int(info.get("chunks_size") or 1000), "total_frames": info.get("total_frames"), "total_episodes": info.get("total_episodes"),
        "shapes": {k: shape(v) for k, v in features.items()}, "video_keys": sorted(k for k, v in features.items() if isinstance(v, dict) and v.get("dtype") == "video"),
    }


def chunk_of(episode, size: int = 1000):
    """The partition column of an episode dataset: ``episode div size``."""
    return F.floor(episode / F.lit(size)).cast("long")


def read_episodes(spark: SparkSession, root: str, columns: list[str] | None = None, episodes: list[int] | None = None) -> DataFrame:
    """Frames of an episode dataset partitioned by ``chunk``; only columns that exist are read, and listed
    episodes prune whole chunk folders before the row filter is pushed to the files."""
    df = spark.read.parquet(root)
    if episodes is not None:
        keep = F.col("episode_index").isin(episodes)
        if "chunk" in df.columns:
            keep &= F.col("chunk").isin(sorted({e // 1000 for e in episodes}))
        df = df.where(keep)
    if columns is not None:
        df = df.select(*[f"`{c}`" for c in columns if c in df.columns])
    return df


def episode_numbers(df: DataFrame) -> DataFrame:
    """Distinct episode numbers in order."""
    return df.select("episode_index").where("episode_index is not null").distinct().orderBy("episode_index")
