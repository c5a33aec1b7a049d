"""Raw corpora: discovery of episode files and decoders for binary formats.

Discovery lists files without reading them.  The decoders for HDF5 and zarr need libraries that are optional; without
them they raise when used.  A file that cannot be decoded becomes a row with ``error`` and no frames.
"""

from __future__ import annotations

import io
import posixpath
import tarfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from kinelake.functions.text import natural_order

DEFAULT_INTRINSICS = (736.6339, 736.6339, 960.0, 540.0)


def list_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length) of the files under ``root``, in no order."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root)
    return files.select("path", "length")


def episode_files(spark: SparkSession, root: str, pattern: str) -> DataFrame:
    """Files in natural order: by folder, then by number."""
    files = list_files(spark, root, pattern)
    return files.orderBy(*natural_order(F.col("path")))


def without_archives(folders: DataFrame, archives: DataFrame) -> DataFrame:
    """Extracted folders (``name``) for which there is no archive; an archive wins over its extracted folder."""
    return folders.join(archives.select("name"), "name", "left_anti")


def safe_members(archive: bytes) -> list[str]:
    """Names in a tar archive; ValueError if one would land outside the target or is a link."""
    with tarfile.open(fileobj=io.BytesIO(archive)) as t:
        names = []
        for m in t.getmembers():
            path = posixpath.normpath(m.name)
            if path.startswith(("/", "..")) or m.issym() or m.islnk():
                raise ValueError(f"unsafe member {m.name!r}")
            names.append(m.name)
    return names


SKELETON = "path string, frame_index long, joint string, transform array<double>, confidence double, error string"


def _skeletons(frames):
    try:
        import h5py
    except ImportError as e:
        raise ImportError("reading HDF5 episodes needs h5py") from e
    for batch in frames:
        for path, content in zip(batch["path"], batch["content"]):
            rows = []
            try:
                with h5py.File(io.BytesIO(content), "r") as f:
                    for joint, values in f["transforms"].items():
                        c = f["confidences"][joint][:] if "confidences" in f and joint in f["confidences"] else [None] * len(values)
                        rows += [(path, i, joint, m.ravel().tolist(), None if k is None else float(k), None) for i, (m, k) in enumerate(zip(values[:], c))]
            except (OSError, KeyError) as e:
                rows = [(path, None, None, None, None, str(e))]
            yield pd.DataFrame(rows, columns=["path", "frame_index", "joint", "transform", "confidence", "error"])


def read_skeletons(spark: SparkSession, root: str, pattern: str = "*.hdf5") -> DataFrame:
    """One row per frame and joint of HDF5 skeleton episodes: a pose of 16 (row-major) and its confidence."""
    return spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).load(root).select("path", "content").mapInPandas(_skeletons, SKELETON)


def positional_join(left: DataFrame, right: DataFrame, order_left: str, order_right: str) -> DataFrame:
    """Pairs rows by their place in order; the numbering is global, so this suits listings, not frames."""
    from pyspark.sql import Window

    a = left.withColumn("_at", F.row_number().over(Window.orderBy(order_left)))
    b = right.withColumn("_at", F.row_number().over(Window.orderBy(order_right)))
    return a.join(b, "_at").drop("_at")


def match_manifest(files: DataFrame, manifest: DataFrame) -> DataFrame:
    """Files (``stem``, ...) with their manifest row (``episode_id``, ``npz_stem``, ...), by id or else by stem: two
    equi-joins instead of one with OR.  A file without row keeps nulls."""
    by_id = files.join(manifest, files["stem"] == manifest["episode_id"], "left")
    found = by_id.where("episode_id is not null")
    rest = by_id.where("episode_id is null").select(*files.columns)
    return found.unionByName(rest.join(manifest, rest["stem"] == manifest["npz_stem"], "left"))
