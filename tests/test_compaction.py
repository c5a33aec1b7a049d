import json

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings, strategies as st

from kinelake.operators import compaction as c

from helpers import frame, frames_table, walk


def pairs(df):
    return {tuple(r) for r in c.overlapping_files(c.pack_index(c.pack_frames(df))).collect()}


def records(packs):
    out = []
    for r in packs.collect():
        text = zstandard.ZstdDecompressor().stream_reader(bytes(r["body"]), read_across_frames=True).read()
        out += [json.loads(x) for x in text.decode().splitlines()]
    return out


def test_every_record_once_and_pairs(spark):
    x = walk(30)
    rows = [frame(1, i, x[i], x[i], file=1 + i // 10) for i in range(30)]
    rows += [frame(1, i, x[i], x[i], file=9) for i in range(8, 12)]  # holds records of files 1 and 2
    rows += [rows[3], rows[3]]  # a file that repeats its own record
    packs = c.pack_frames(frames_table(spark, rows))
    assert pairs(frames_table(spark, rows)) == {(1, 9), (2, 9)}
    got = records(packs)
    assert sorted((r["episode_index"], r["frame_index"]) for r in got) == [(1, i) for i in range(30)]
    assert all(np.allclose(r["observation.state"], x[r["frame_index"]]) for r in got)


def test_three_files_hold_one_record(spark):
    rows = [frame(1, 0, [1], file=f) for f in (5, 6, 7)]
    assert pairs(frames_table(spark, rows)) == {(5, 6), (5, 7), (6, 7)}


def test_nulls_empty_and_extra_columns(spark):
    assert pairs(frames_table(spark, [])) == set()
    rows = [frame(None, 0, file=1), frame(None, 0, file=2), frame(1, None, file=1), frame(1, None, file=2), frame(1, 3, file=None), frame(1, 3, file=4)]
    df = frames_table(spark, rows).selectExpr("*", "1 as line", "2 as block", "'x' as row")
    assert pairs(df) == set()
    got = records(c.pack_frames(df))
    assert len(got) == 5 and all(r["line"] == 1 and r["row"] == "x" for r in got)


def test_small_target_gives_several_packs(spark):
    x = walk(200)
    rows = [frame(1, i, x[i], file=i // 5) for i in range(200)]
    packs = c.pack_frames(frames_table(spark, rows), target_bytes=2_000)
    assert packs.count() > 3 and len(records(packs)) == 200


def test_damage_is_found(spark):
    x = walk(20)
    packs = c.pack_frames(frames_table(spark, [frame(1, i, x[i], file=1) for i in range(20)])).collect()
    body = bytearray(packs[0]["body"])
    body[-5] ^= 255
    with pytest.raises((ValueError, zstandard.ZstdError)):
        list(c.walk_pack(bytes(body)))


def test_written_packs_read_back(spark, tmp_path):
    x = walk(20)
    packs = c.pack_frames(frames_table(spark, [frame(1, i, x[i], file=i // 4) for i in range(20)]))
    m = c.write_packs(packs, str(tmp_path / "out")).collect()
    assert sum(r["n_records"] for r in m) == 20
    for r in m:
        body = open(r["file"], "rb").read()
        assert len(body) == r["n_bytes"] and len(list(c.walk_pack(body))) == r["n_members"]


def test_join_ndjson_boundaries():
    body, spans = c.join_ndjson([b"\xef\xbb\xbfh\n1\n", b"", b"h\n2", b"h\n"], header_lines=1)
    assert body == b"h\n1\n2\n" and spans == [(0, 4), (4, 0), (4, 2), (6, 0)]


@settings(max_examples=30, deadline=None)
@given(st.lists(st.lists(st.text(alphabet="ab{}\"1", max_size=8), max_size=5), max_size=6))
def test_join_ndjson_keeps_lines(files):
    body, spans = c.join_ndjson(["\n".join(f).encode() for f in files])
    want = [line for f in files if "\n".join(f) for line in f]
    if want and all("\n".join(f) == "" or f[-1] != "" for f in files):
        assert body.decode().split("\n")[:-1] == want
    assert sum(n for _, n in spans) == len(body)


def test_join_zstd():
    z = zstandard.ZstdCompressor()
    parts = [z.compress(b"a\n" * 50), z.compress(b"b\n") + z.compress(b"c\n")]
    body, spans = c.join_zstd(parts)
    assert zstandard.ZstdDecompressor().stream_reader(body, read_across_frames=True).read() == b"a\n" * 50 + b"b\nc\n"
    assert [n for _, n in spans] == [len(p) for p in parts]
    for bad in (parts[0][:-3], b"xx" + parts[0], parts[0] + b"12345678"):
        with pytest.raises(ValueError):
            c.join_zstd([bad])


@pytest.mark.parametrize("kind", ["ndjson", "zstd"])
def test_compact_files(spark, tmp_path, kind):
    z = zstandard.ZstdCompressor()
    source = tmp_path / "in"
    source.mkdir()
    rows = []
    for i in range(40):
        data = f'{{"i": {i}}}\n'.encode()
        (source / f"f{i:03d}").write_bytes(z.compress(data) if kind == "zstd" else data)
        rows.append((str(source / f"f{i:03d}"), len(data)))
    (source / "empty").write_bytes(b"")
    rows += [(str(source / "empty"), 0), (str(source / "gone"), 5), rows[0]]
    m = c.compact_files(spark, spark.createDataFrame(rows, "path string, length long"), str(tmp_path / "out"), kind, target_bytes=150).collect()
    assert len(m) == 42 and [r["source"] for r in m if r["error"]] == [str(source / "gone")]
    got = []
    for f in {r["file"] for r in m}:
        data = open(f, "rb").read()
        got += (zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read() if kind == "zstd" else data).decode().splitlines()
    assert sorted(json.loads(x)["i"] for x in got) == list(range(40)) and len({r["file"] for r in m}) < 6
