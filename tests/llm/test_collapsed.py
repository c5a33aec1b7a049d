from pyspark.sql import functions as F

from kinelake.llm import queries as q


def test_collapsed_table(spark, sf):
    """Every frame of the table once, as it is, except those of a rest after its first."""
    frames = spark.read.parquet(f"{sf}/frames.parquet")
    keys = ["episode_index", "frame_index"]
    keyed = frames.where("episode_index is not null and frame_index is not null")
    rests, got = q.QUERIES["p4_rests"](spark, sf), q.QUERIES["p4_collapsed"](spark, sf).cache()
    gone = rests.agg(F.sum(F.col("n_frames") - 1)).first()[0]
    assert gone > 0 and got.count() == keyed.select(keys).distinct().count() + frames.count() - keyed.count() - gone
    assert got.columns == [*frames.columns, "rest_frames", "rest_duration_s"]
    assert got.where("rest_frames > 1").count() == rests.join(got, (rests.episode_index == got.episode_index) & (rests.first_frame == got.frame_index) & (rests.n_frames == got.rest_frames)).count() == rests.count()
    assert got.drop("rest_frames", "rest_duration_s").exceptAll(frames).count() == 0
