import io
import tarfile

import pytest

from kinelake.functions import text
from kinelake.operators import episode_filter as ef, export, quality as q
from kinelake.sources import raw, tables
from kinelake.streaming.prefix import prefix_keep_stream
from pyspark.sql import functions as F

from helpers import frame, frames_table, walk


def test_listing_and_archives(spark, tmp_path):
    for n in ("b/2.h5", "b/10.h5", "a/x.h5", "a/3.h5", "a/skip.txt"):
        (tmp_path / n).parent.mkdir(exist_ok=True)
        (tmp_path / n).write_bytes(b"x")
    got = [r["path"].split(str(tmp_path))[1] for r in raw.episode_files(spark, str(tmp_path), "*.h5").collect()]
    assert got == ["/a/3.h5", "/a/x.h5", "/b/2.h5", "/b/10.h5"]
    names = spark.createDataFrame([("a",), ("b",)], "name string")
    assert [r[0] for r in raw.without_archives(names, names.where("name = 'a'")).collect()] == ["b"]


def test_unsafe_archive():
    def tar(name):
        out = io.BytesIO()
        with tarfile.open(fileobj=out, mode="w") as t:
            t.addfile(tarfile.TarInfo(name))
        return out.getvalue()

    assert raw.safe_members(tar("ok/a")) == ["ok/a"]
    for bad in ("../a", "/a", "x/../../a"):
        with pytest.raises(ValueError):
            raw.safe_members(tar(bad))


def test_manifest_match(spark):
    files = spark.createDataFrame([("e1",), ("s2",), ("none",)], "stem string")
    manifest = spark.createDataFrame([("e1", "x", 1), ("e2", "s2", 2)], "episode_id string, npz_stem string, v int")
    assert {(r["stem"], r["v"]) for r in raw.match_manifest(files, manifest).collect()} == {("e1", 1), ("s2", 2), ("none", None)}


def test_text_functions(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(text.episode_name(F.lit(7))) == "episode_000007" and one(text.chunk_name(F.lit(2345))) == "chunk-002"
    assert one(text.number_of(F.lit("/a/12.hdf5"))) == 12 and one(text.number_of(F.lit("a/x1.h5"))) is None
    assert one(text.safe_name(F.lit("a b/ç.c"))) == "a_b_.c" and one(text.decoded(F.lit(bytearray(b"ab\0\0")))) == "ab"
    assert one(text.first_present(F.lit(""), F.lit(None).cast("string"), F.lit("z"))) == "z"
    assert one(text.task_description(F.lit("Reversible"), F.lit("2"), F.lit("put"), F.lit("take"), F.lit("t"))) == "take"
    assert one(text.annotation(F.lit('{"label": "grip", "start": 1}')))["text"] == "grip" and one(text.annotation(F.lit("free text")))["text"] == "free text"
    assert one(text.intrinsics9(F.array(*[F.lit(float(x)) for x in (5, 0, 1, 0, 6, 2, 0, 0, 1)])))[:4] == [5, 6, 1, 2]
    v = text.intrinsics9(F.array(*[F.lit(float(x)) for x in (5, 6, 1, 2, 100, 50)]))
    assert one(text.scaled_intrinsics(v, F.lit(200), F.lit(100)))[:6] == [10, 12, 2, 4, 200, 100]


def test_dataset_round_trip(spark, tmp_path):
    x = walk(30)
    rows = [frame(e, i, x[i], x[i]) for e in (0, 3, 1001) for i in range(30)]
    df = frames_table(spark, rows)
    masks = spark.createDataFrame([(e, i, 1 if i < (20 if e else 0) else 0) for e in (0, 3, 1001) for i in range(30)], "episode long, frame_index long, keep int")
    out = export.exported_frames(export.with_validity_mask(df, masks))
    export.write_dataset(out, str(tmp_path / "d"), export.episode_meta(out, spark.createDataFrame([(3, "t")], "episode_index long, task_name string")))
    back = tables.read_episodes(spark, str(tmp_path / "d" / "data"), ["episode_index", "frame_index", "index", "timestamp", "gone"])
    got = back.orderBy("index").collect()
    assert [r["index"] for r in got] == list(range(40)) and [r["frame_index"] for r in got[:20]] == list(range(20))
    assert tables.read_episodes(spark, str(tmp_path / "d" / "data"), episodes=[1001]).count() == 20
    assert [r[0] for r in tables.episode_numbers(back).collect()] == [3, 1001]
    assert export.verify_alignment(back, back.groupBy("episode_index").agg(F.count("*").alias("length"))).count() == 0
    with pytest.raises(Exception):
        export.write_dataset(out, str(tmp_path / "d"))
    assert tables.read_jsonl(spark, str(tmp_path / "d" / "meta" / "episodes")).count() == 2


def test_config():
    given = {"schema": {"embodiment": "humanoid"}, "stage1": {"thresholds": {"k_residual": 60.0, "percentile_floor": 99.999}}}
    c = q.QualityConfig.from_dict(given, alpha=0.35, k_residual=None)
    assert c.layout is q.JOINT and c.k_residual == 60.0 and c.alpha == 0.35 and c.percentile_floor == 99.999
    with pytest.raises(ValueError, match="unknown"):  # no setting is ignored
        q.QualityConfig.from_dict(given | {"unknown": 1})
    assert not ef.reference_frame_ok("current_camera") and ef.reference_frame_ok("first_camera")


@pytest.mark.parametrize("n", [1, 2, 10, 11, 12])
def test_short_episodes(spark, n):
    x = walk(n, n)
    rows = [frame(1, i, x[i], x[i]) for i in range(n)] + [frame(2, 0, None, None)]
    r = q.episode_results(q.keep_masks(frames_table(spark, rows))).collect()
    assert len(r) == 1 and r[0]["num_frames"] == n and 0 <= r[0]["kept_frames"] <= n
    d = ef.episode_decisions(ef.judged_frames(frames_table(spark, rows))).collect()
    assert [v["length"] for v in d] == [n]


def test_empty_pipeline(spark):
    none = frames_table(spark, [])
    r = q.episode_results(q.keep_masks(none))
    assert r.count() == 0
    report = q.quality_report(r).first()
    assert report["episodes"] == 0 and report["discard_rate"] == 0.0
    assert ef.episode_decisions(ef.judged_frames(none)).count() == 0


def test_static_frames_twice(spark):
    """Removing static frames again removes nothing."""
    x = walk(40)
    x[10:30] = x[10]
    e = q.stage4(q.episode_frames(frames_table(spark, [frame(1, i, x[i], x[i]) for i in range(40)])))
    kept = e.where("not s4_remove")
    assert kept.count() == 25
    assert q.stage4(kept.drop("s4_remove")).where("s4_remove").count() == 0


def test_stream(spark, tmp_path):
    rows = [(e, f, f == 5 and e == 1) for e in (1, 2) for f in range(10)]
    for k in range(2):
        spark.createDataFrame(rows[k::2], "episode long, frame long, bad boolean").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema("episode long, frame long, bad boolean").parquet(str(tmp_path / "in"))
    s = prefix_keep_stream(stream).writeStream.format("memory").queryName("kept").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    assert s.awaitTermination(60)
    got = {(r["episode"], r["frame"]): r["keep"] for r in spark.table("kept").collect()}
    assert got == {(e, f): int(e == 2 or f < 5) for e in (1, 2) for f in range(10)}
