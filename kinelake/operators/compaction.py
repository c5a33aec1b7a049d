"""Consolidating far too many tiny files into few well-sized ones by joining bytes.

Two entry points share one byte layer:

* :func:`compact_files` joins newline-delimited files, or files of complete zstandard frames, as they lie in storage.
* :func:`pack_frames` does the same for tiny files that arrive as rows of a ``frames`` table (``file_id`` names the
  file).  Each tiny file becomes one zstandard frame of newline-delimited JSON, preceded by a *skippable* frame that
  carries its header: file, episode, row count, lengths, checksum and record keys.  A pack is the plain concatenation of
  such frames, hence itself a valid zstandard file that any decoder turns into newline-delimited JSON.

Records are never parsed again: what is delivered twice is found from the keys in the headers, a tiny file without
repeats is copied whole, and one with repeats loses exactly the byte ranges of the repeated lines.

Partitioning: one shuffle, by (episode, block of frames).  All deliveries of a record meet in one task, where the only
state is the set of frames of one block (at most ``SPAN`` keys), so a hot episode or a record delivered a million times
neither skews a task's memory nor is held anywhere.
"""

from __future__ import annotations

import posixpath
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from kinelake.functions.dense import longs, runs, starts_of, whole_groups
from kinelake.functions.deliveries import block_of
from kinelake.session import drop_folder, materialise, shared_folder

SPAN = 4096
TARGET_BYTES = 64 << 20
#: Records without episode or frame number are spread over so many groups.
UNKEYED = 4096
MISSING = np.iinfo(np.int64).min
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
SKIP_MAGIC = b"\x50\x2a\x4d\x18"
#: file, episode, rows of the file, rows kept, bytes of the payload raw and compressed, xxh64 of the raw payload.
HEADER = struct.Struct("<qqqqQQQ")


# ------------------------------------------------------------------ byte layer


def join_ndjson(parts: Iterator[bytes], header_lines: int = 0) -> tuple[bytes, list[tuple[int, int]]]:
    """Concatenates newline-delimited parts: a byte order mark and, from the second part on, ``header_lines`` lines are
    taken off; a missing last newline is added; nothing else is touched.  Returns the bytes and (offset, length) of each
    part; empty parts have length 0."""
    out, at, spans, started = [], 0, [], False
    for part in parts:
        if part.startswith(b"\xef\xbb\xbf"):
            part = part[3:]
        if started:
            for _ in range(header_lines):
                part = part[part.find(b"\n") + 1 :] if b"\n" in part else b""
        if part and not part.endswith(b"\n"):
            part += b"\n"
        started |= bool(part)
        out.append(part)
        spans.append((at, len(part)))
        at += len(part)
    return b"".join(out), spans


def frame_lengths(data: bytes) -> list[int]:
    """Lengths of the zstandard frames (skippable ones too) that make up ``data``; ValueError if the last is not complete."""
    lengths, view = [], memoryview(data)
    while len(view):
        if len(view) < 8:
            raise ValueError("trailing bytes are no zstandard frame")
        magic = bytes(view[:4])
        if 0x50 <= magic[0] <= 0x5F and magic[1:] == SKIP_MAGIC[1:]:
            size = 8 + struct.unpack("<I", view[4:8])[0]
            if size > len(view):
                raise ValueError("a skippable frame is cut off")
        elif magic == ZSTD_MAGIC:
            d = zstandard.ZstdDecompressor().decompressobj()
            size = 0
            while not d.eof:
                chunk = view[size : size + (1 << 20)]
                if not len(chunk):
                    raise ValueError("a zstandard frame is cut off")
                try:
                    d.decompress(chunk)
                except zstandard.ZstdError as e:
                    raise ValueError(f"a zstandard frame is damaged: {e}") from e
                size += len(chunk)
            size -= len(d.unused_data)
        else:
            raise ValueError("no zstandard frame begins here")
        lengths.append(size)
        view = view[size:]
    return lengths


def join_zstd(parts: Iterator[bytes]) -> tuple[bytes, list[tuple[int, int]]]:
    """Concatenates parts that each consist of complete zstandard frames; a damaged or cut part raises ValueError."""
    out, at, spans = [], 0, []
    for part in parts:
        frame_lengths(part)
        out.append(part)
        spans.append((at, len(part)))
        at += len(part)
    return b"".join(out), spans


def _member(packer, file: int, episode: int, keys: np.ndarray, kept: np.ndarray, owners: np.ndarray, payload: bytes) -> bytes:
    """``owners``: for each record that is left out, the file whose member has it."""
    body = packer.compress(payload) if len(payload) else b""
    head = HEADER.pack(file, episode, len(keys), int(kept.sum()), len(payload), len(body), xxhash.xxh64_intdigest(payload))
    head += keys.astype("<i8").tobytes() + np.packbits(kept).tobytes() + owners.astype("<i8").tobytes()
    return SKIP_MAGIC + struct.pack("<I", len(head)) + head + body


def walk_pack(body: bytes, verify: bool = True) -> Iterator[dict]:
    """The members of a pack, from its headers alone.  With ``verify`` every payload's length and checksum is compared
    with its header; ValueError tells the first that differs."""
    at, reader = 0, zstandard.ZstdDecompressor()
    while at < len(body):
        if body[at : at + 4] != SKIP_MAGIC:
            raise ValueError(f"no member header at byte {at}")
        size = struct.unpack("<I", body[at + 4 : at + 8])[0]
        head = body[at + 8 : at + 8 + size]
        file, episode, n, kept_n, raw, packed, digest = HEADER.unpack(head[: HEADER.size])
        keys = np.frombuffer(head, "<i8", n, HEADER.size)
        kept = np.unpackbits(np.frombuffer(head, np.uint8, -(-n // 8), HEADER.size + 8 * n), count=n).astype(bool)
        owners = np.frombuffer(head, "<i8", n - kept_n, HEADER.size + 8 * n + -(-n // 8))
        payload = body[at + 8 + size : at + 8 + size + packed]
        if verify:
            text = reader.decompress(payload, max_output_size=raw) if packed else b""
            if len(payload) != packed or len(text) != raw or xxhash.xxh64_intdigest(text) != digest or int(kept.sum()) != kept_n:
                raise ValueError(f"the member of file {file} at byte {at} does not match its header")
        yield {"file": file, "episode": episode, "keys": keys, "kept": kept, "owners": owners, "offset": at, "raw": raw, "packed": packed, "digest": digest, "start": at + 8 + size}
        at += 8 + size + packed


# ------------------------------------------------------- tiny files in a table

PACK_SCHEMA = T.StructType([T.StructField("pack_id", T.StringType()), T.StructField("n_members", T.LongType()), T.StructField("n_records", T.LongType()), T.StructField("n_bytes", T.LongType()), T.StructField("checksum", T.LongType()), T.StructField("body", T.BinaryType())])
INDEX_SCHEMA = "pack_id string, file_id long, episode_index long, frames array<long>, kept array<boolean>, left_out array<struct<frame:long,owner:long>>, byte_offset long, raw_bytes long, packed_bytes long, checksum long"


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _pack_partition(target: int, batches):
    from pyspark import TaskContext

    context = TaskContext.get()
    part = context.partitionId() if context else 0
    packer = zstandard.ZstdCompressor(level=3)
    members, held, records, count = [], 0, 0, 0
    seen: dict[int, int] = {}  # frame -> the file that has it, for one block
    group = None

    def flush():
        nonlocal members, held, records, count
        body = b"".join(members)
        out = pa.record_batch([pa.array([f"{part:06d}-{count:06d}"]), pa.array([len(members)], pa.int64()), pa.array([records], pa.int64()), pa.array([len(body)], pa.int64()), pa.array([_signed(xxhash.xxh64_intdigest(body))], pa.int64()), pa.array([body], pa.binary())], names=PACK_SCHEMA.names)
        members, held, records, count = [], 0, 0, count + 1
        return out

    for table in whole_groups(batches, ["episode_index", "block", "file_id"], rows=4_000):
        episode, block, file, frame = (longs(table, c) for c in ("episode_index", "block", "file_id", "frame_index"))
        lines = table.column("line").combine_chunks()
        if isinstance(lines, pa.ChunkedArray):
            lines = lines.chunk(0)
        ends = np.frombuffer(lines.buffers()[1], np.int32, len(lines) + 1, lines.offset * 4)
        data = memoryview(lines.buffers()[2])
        starts = starts_of(episode, block, file)
        for a, b in zip(starts, np.append(starts[1:], len(file))):
            if group != (episode[a], block[a]):
                group, seen = (episode[a], block[a]), {}
            keys = frame[a:b]
            kept, owners, this = np.ones(b - a, bool), [], int(file[a])
            if keys[0] != MISSING and episode[a] != MISSING:
                for i, k in enumerate(keys.tolist()):
                    owner = seen.setdefault(k, this)
                    if owner != this or (i and keys[i - 1] == k):
                        kept[i] = False
                        owners.append(owner)
            if kept.all():
                payload = bytes(data[ends[a] : ends[b]])
            else:
                payload = b"".join(data[ends[a + i] : ends[a + j]] for i, j in zip(*runs(kept)))
            member = _member(packer, this, int(episode[a]), keys, kept, np.array(owners, np.int64), payload)
            if members and held + len(member) > target:
                yield flush()
            members.append(member)
            held += len(member)
            records += int(kept.sum())
    if members:
        yield flush()


def pack_frames(frames: DataFrame, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Packs the tiny files of ``frames`` (columns ``file_id``, ``episode_index``, ``frame_index`` and any others) into
    rows (pack_id, n_members, n_records, n_bytes, checksum, body) of at most ``target_bytes`` (a larger single file is
    a pack of its own).  Every (episode_index, frame_index) is in the packs exactly once, from the lowest ``file_id``
    that delivers it, with all columns.

    Nulls: a record without episode or frame cannot be compared and is kept as often as it is delivered; rows without
    ``file_id`` form one file per episode.  An empty table gives no pack.  Extra columns are carried, whatever their name.
    """
    names = frames.columns
    # The columns travel through the shuffle as they are; they are rendered as text only afterwards.
    row = F.struct(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    # Records without key go anywhere, by their content, so that they do not meet in one task.
    nowhere = F.col("episode_index").isNull() | F.col("frame_index").isNull()
    block = F.when(nowhere, -1 - F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in names]), F.lit(UNKEYED))).otherwise(block_of(F.col("frame_index"), SPAN))
    keyed = frames.select("file_id", "episode_index", "frame_index", block.alias("block"), row.alias("row"))
    line = F.concat(F.to_json(F.struct(*[F.col(f"row.c{i}").alias(c) for i, c in enumerate(names)])), F.lit("\n"))
    placed = keyed.repartition("episode_index", "block").sortWithinPartitions("episode_index", "block", "file_id", "frame_index")
    return placed.select("file_id", "episode_index", "frame_index", "block", line.alias("line")).mapInArrow(lambda it: _pack_partition(target_bytes, it), PACK_SCHEMA)


def _index_partition(batches):
    for batch in batches:
        for pack, body, checksum in zip(batch.column(batch.schema.get_field_index("pack_id")).to_pylist(), batch.column(batch.schema.get_field_index("body")), batch.column(batch.schema.get_field_index("checksum")).to_pylist()):
            body = body.as_py()
            if _signed(xxhash.xxh64_intdigest(body)) != checksum:
                raise ValueError(f"pack {pack} does not match its checksum")
            found = list(walk_pack(body))
            for lo in range(0, len(found), 5_000):
                rows = found[lo : lo + 5_000]
                yield pa.record_batch(
                    [
                        pa.array([pack] * len(rows)),
                        pa.array([None if r["file"] == MISSING else r["file"] for r in rows], pa.int64()),
                        pa.array([None if r["episode"] == MISSING else r["episode"] for r in rows], pa.int64()),
                        pa.array([r["keys"] for r in rows], pa.list_(pa.int64())),
                        pa.array([r["kept"] for r in rows], pa.list_(pa.bool_())),
                        pa.array([[{"frame": int(f), "owner": None if o == MISSING else int(o)} for f, o in zip(r["keys"][~r["kept"]], r["owners"])] for r in rows], pa.list_(pa.struct([("frame", pa.int64()), ("owner", pa.int64())]))),
                        *[pa.array([r[k] for r in rows], pa.int64()) for k in ("offset", "raw", "packed")],
                        pa.array([_signed(r["digest"]) for r in rows], pa.int64()),
                    ],
                    names=["pack_id", "file_id", "episode_index", "frames", "kept", "left_out", "byte_offset", "raw_bytes", "packed_bytes", "checksum"],
                )


def pack_index(packs: DataFrame) -> DataFrame:
    """One row per tiny file and block of a pack, read back from the pack's own headers after lengths and checksums of
    pack and members were verified (a mismatch fails the job).  A missing frame number is the smallest long."""
    return packs.select("pack_id", "body", "checksum").mapInArrow(_index_partition, INDEX_SCHEMA)


def overlapping_files(index: DataFrame) -> DataFrame:
    """(file_id_a, file_id_b), a < b: different files that share at least one (episode_index, frame_index).

    Only records that the packs left out are looked at: each names the file that has it, which is one pair; files that
    both left the same record out meet in an equi-join on that record, which emits the pairs asked for and nothing else.
    A file that repeats its own record gives no pair."""
    left = index.where("file_id is not null and episode_index is not null and size(left_out) > 0").select("episode_index", "file_id", F.explode("left_out").alias("r")).select("episode_index", F.col("r.frame").alias("frame_index"), F.col("r.owner").alias("owner"), "file_id").distinct()
    pair = lambda a, b: (F.least(a, b).alias("file_id_a"), F.greatest(a, b).alias("file_id_b"))
    kept = left.where("owner <> file_id").select(*pair(F.col("owner"), F.col("file_id")))
    key = ["episode_index", "frame_index"]
    several = left.groupBy(*key).agg(F.countDistinct("file_id").alias("n")).where("n > 1")
    held = left.join(several, key, "left_semi").select(*key, "file_id").distinct()
    both = held.withColumnRenamed("file_id", "a").join(held.withColumnRenamed("file_id", "b"), key).where("a < b").select(*pair(F.col("a"), F.col("b")))
    return kept.unionByName(both).distinct()


def _system_of(uri: str):
    """The file system and path of a URI or path; Hadoop writes local URIs with one slash."""
    if uri.startswith("file:/") and not uri.startswith("file:///"):
        uri = uri.replace("file:/", "file:///", 1)
    return pafs.FileSystem.from_uri(uri) if "://" in uri else (pafs.LocalFileSystem(), uri)


def write_packs(packs: DataFrame, path: str) -> DataFrame:
    """Writes each pack to ``path/pack-<id>.ndjson.zst`` in a file system all executors share (any URI pyarrow knows) and
    returns the manifest (pack_id, file, n_members, n_records, n_bytes, checksum).  A file appears under its name only
    once complete, so a repeated task attempt overwrites it with the same bytes."""

    def put(batches):
        system, folder = _system_of(path)
        system.create_dir(folder, recursive=True)
        for batch in batches:
            out = batch.to_pylist()
            for r in out:
                name = f"pack-{r['pack_id']}.ndjson.zst"
                target, r["file"] = posixpath.join(folder, name), posixpath.join(path, name)
                part = f"{target}.{xxhash.xxh32_hexdigest(r['pack_id'])}.part"
                with system.open_output_stream(part, compression=None) as f:
                    f.write(r.pop("body"))
                system.move(part, target)
            yield pa.RecordBatch.from_pylist(out, pa.schema([("pack_id", pa.string()), ("file", pa.string()), *[(c, pa.int64()) for c in ("n_members", "n_records", "n_bytes", "checksum")]]))

    return packs.mapInArrow(put, "pack_id string, file string, n_members long, n_records long, n_bytes long, checksum long")


# ------------------------------------------------------------ files in storage

#: Files of a listing whose lengths one task sums up.
BUCKET_FILES = 1_000_000
FILE_MANIFEST = "pack_id long, file string, source string, byte_offset long, n_bytes long, checksum long, error string"


def compact_files(spark: SparkSession, listing: DataFrame, out: str, kind: str = "ndjson", target_bytes: int = TARGET_BYTES, header_lines: int = 0) -> DataFrame:
    """Joins the files of ``listing`` (``path``, ``length``) into files of about ``target_bytes`` under ``out``.

    ``kind`` is ``ndjson`` or ``zstd``.  Files are dealt to packs by their running length, largest first, so a pack holds
    ``target_bytes`` and at most one file more; long listings are cut into buckets by hash, of at least 16 packs each, so
    no task sees the whole listing.  A file of unknown length counts as ``target_bytes``.  Returns one row per source file: its pack, byte offset, length and xxh64;
    a file that cannot be read or is damaged is left out of the pack and named in ``error``, never silently dropped.  A
    path listed twice is taken once; an empty file has length 0.  The manifest is lazy: writing happens when it is used,
    and a repeated attempt writes the same bytes."""
    files = listing.select("path", "length").where("path is not null").groupBy("path").agg(F.max(F.coalesce("length", F.lit(target_bytes))).alias("length"))
    files = files.withColumn("length", F.greatest(F.lit(0), "length"))
    total = files.agg(F.count("*").alias("n"), F.coalesce(F.sum("length"), F.lit(0)).alias("bytes")).first()
    buckets = max(1, min(-(-total["n"] // BUCKET_FILES), int(total["bytes"]) // (16 * target_bytes)))
    bucket = F.pmod(F.xxhash64("path"), F.lit(buckets))
    order = Window.partitionBy("bucket").orderBy(F.desc("length"), "path")
    upto = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    filled = files.withColumn("bucket", bucket).withColumn("fill", F.floor(F.coalesce(upto, F.lit(0)) / F.lit(target_bytes)).cast("long"))
    n = max(1, -(-int(total["bytes"]) // target_bytes))
    dealt = filled.select("path", (F.col("fill") * buckets + F.col("bucket")).alias("pack_id")).repartition(min(n, 100_000), "pack_id").sortWithinPartitions("pack_id", "path")

    def join(batches):
        for table in whole_groups(batches, "pack_id", rows=1):
            ids, paths = table.column("pack_id").to_pylist(), table.column("path").to_pylist()
            at = starts_of(np.asarray(ids))
            for a, b in zip(at, np.append(at[1:], len(ids))):
                good, rows = [], []
                for p in paths[a:b]:
                    try:
                        system, name = _system_of(p)
                        with system.open_input_stream(name, compression=None) as f:
                            data = f.read()
                        if kind == "zstd":
                            frame_lengths(data)
                        good.append((p, data))
                    except (OSError, ValueError) as e:
                        rows.append({"source": p, "error": str(e)})
                body, spans = join_zstd(d for _, d in good) if kind == "zstd" else join_ndjson((d for _, d in good), header_lines)
                system, folder = _system_of(out)
                system.create_dir(folder, recursive=True)
                name = f"pack-{ids[a]:06d}." + ("ndjson.zst" if kind == "zstd" else "ndjson")
                target = posixpath.join(folder, name)
                with system.open_output_stream(target + ".part", compression=None) as f:
                    f.write(body)
                system.move(target + ".part", target)
                with system.open_input_stream(target, compression=None) as f:
                    if xxhash.xxh64_intdigest(f.read()) != xxhash.xxh64_intdigest(body):
                        raise OSError(f"{target} was not written as joined")
                rows += [{"source": p, "byte_offset": o, "n_bytes": k, "checksum": _signed(xxhash.xxh64_intdigest(body[o : o + k])), "error": None} for (p, _), (o, k) in zip(good, spans)]
                yield pa.RecordBatch.from_pylist([{"pack_id": ids[a], "file": posixpath.join(out, name), "byte_offset": None, "n_bytes": None, "checksum": None} | r for r in rows], pa.schema([("pack_id", pa.int64()), ("file", pa.string()), ("source", pa.string()), ("byte_offset", pa.int64()), ("n_bytes", pa.int64()), ("checksum", pa.int64()), ("error", pa.string())]))

    return dealt.select("pack_id", "path").mapInArrow(join, FILE_MANIFEST)


# -------------------------------------------------------------------- queries


def p1_found(spark: SparkSession, root: str) -> DataFrame:
    """Pairs of tiny files that hold the same record, from the headers of the verified packs."""
    # The index is written, as it is read twice and packing is the costly part.
    index, _ = materialise(pack_index(pack_frames(spark.read.parquet(f"{root}/frames.parquet"))), "pack-index")
    return overlapping_files(index)


def p1_packs(spark: SparkSession, root: str) -> DataFrame:
    """The compaction before anything is written: one row per pack."""
    return pack_frames(spark.read.parquet(f"{root}/frames.parquet")).drop("body")


def consolidate(frames: DataFrame, folder: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Writes the tiny files of ``frames`` as few well-sized packs under ``folder`` and returns the manifest of
    :func:`compact_files`.

    Every task writes what it has as packs of at most ``target_bytes`` (byte concatenations of members); then the packs
    are joined byte by byte, as complete zstandard frames, up to ``target_bytes``, whatever the number of tasks was."""
    spark = frames.sparkSession
    parts, parts_path = materialise(write_packs(pack_frames(frames, target_bytes), f"{folder}/parts"), "pack-parts")
    manifest, _ = materialise(compact_files(spark, parts.select(F.col("file").alias("path"), F.col("n_bytes").alias("length")), f"{folder}/packs", "zstd", target_bytes), "pack-manifest")
    drop_folder(spark, f"{folder}/parts")
    drop_folder(spark, parts_path)
    return manifest


def verified_packs(manifest: DataFrame) -> DataFrame:
    """(pack_id, n_bytes, n_members, n_records, checksum): every pack of a manifest read back from its file, with all
    lengths and checksums of members verified; a part that could not be joined fails."""

    def read(batches):
        for batch in batches:
            for row in batch.to_pylist():
                if row["error"]:
                    raise ValueError(row["error"])
                system, name = _system_of(row["file"])
                with system.open_input_stream(name, compression=None) as f:
                    body = f.read()
                members = list(walk_pack(body))
                yield pa.RecordBatch.from_pylist([{"pack_id": row["pack_id"], "n_bytes": len(body), "n_members": len(members), "n_records": int(sum(m["kept"].sum() for m in members)), "checksum": _signed(xxhash.xxh64_intdigest(body))}])

    files = manifest.groupBy("pack_id", "file").agg(F.max("error").alias("error"))
    return files.mapInArrow(read, "pack_id long, n_bytes long, n_members long, n_records long, checksum long")


def p1_written(spark: SparkSession, root: str) -> DataFrame:
    """Packs written to the shared folder, read back and verified: packs, bytes, records and the records that should be there."""
    folder = f"{shared_folder(spark)}/packs-{uuid.uuid4().hex}"
    frames = spark.read.parquet(f"{root}/frames.parquet")
    done = verified_packs(consolidate(frames, folder)).agg(F.count("*").alias("n_packs"), F.coalesce(F.sum("n_bytes"), F.lit(0)).alias("n_bytes"), F.coalesce(F.max("n_bytes"), F.lit(0)).alias("largest"), F.coalesce(F.sum("n_records"), F.lit(0)).alias("n_records"))
    keyed = frames.where("episode_index is not null and frame_index is not null")
    due = keyed.select("episode_index", "frame_index").distinct().count() + frames.count() - keyed.count()
    out, _ = materialise(done.withColumn("n_due", F.lit(due)), "packs-written")
    drop_folder(spark, folder)
    return out


QUERIES = {"p1_found": p1_found, "p1_packs": p1_packs, "p1_written": p1_written}
ORACLES = {
    "p1_found": """
        SELECT DISTINCT a.file_id AS file_id_a, b.file_id AS file_id_b
        FROM (SELECT DISTINCT episode_index, frame_index, file_id FROM frames) a
        JOIN (SELECT DISTINCT episode_index, frame_index, file_id FROM frames) b
          ON a.episode_index = b.episode_index AND a.frame_index = b.frame_index AND a.file_id < b.file_id"""
}
