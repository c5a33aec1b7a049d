"""Splits that keep related records together.

Records and the keys they share form a bipartite graph.  Borůvka contraction finds its components: in every round each
component takes its least edge to another one, the chosen edges go into the spanning forest, and the components they tie
together are contracted by pointer jumping.  A key shared by a third of all records is one vertex whose edges are spread
over tasks: minima are partially aggregated, and labels are joined by key with adaptive skew handling; no pair of records is ever formed.  Every round is written to the shared folder, which cuts the lineage; the
forest stays there as a table.

Roots are dealt to the splits by size: the few that each hold more than a thousandth of the total (hence at most 1,000)
go one by one to the split that lacks most; all others are stratified by size band and dealt systematically by a golden
ratio sequence, with the shares that remain.
"""

from __future__ import annotations


from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from kinelake.session import drop_folder, materialise

GOLDEN = 0.6180339887498949
LARGE = 1000
#: Groups that one task orders while dealing.
BUCKET_GROUPS = 100_000


def spanning_forest(edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(components, forest) of the undirected ``edges`` (u string, v string).

    components: (vertex, root), one row per vertex that has an edge; the root is the least vertex of the component's last
    contraction, the same for all of its vertices.  forest: (u, v), the edges of a spanning forest, written to the shared
    folder.  Self loops and repeated edges change nothing; edges with a null end are ignored; no edge gives two empty
    tables.  The loop ends after at most log2(vertices) rounds; the driver sees counts only."""
    spark = edges.sparkSession
    clean = edges.where("u is not null and v is not null and u <> v").select("u", "v").distinct()
    clean, _ = materialise(clean.withColumn("w", F.xxhash64("u", "v")), "boruvka-edges")
    label, label_path = materialise(clean.select(F.explode(F.array("u", "v")).alias("vertex")).distinct().withColumn("root", F.col("vertex")), "boruvka-labels")
    live, live_path = clean.select("u", "v", "w", F.col("u").alias("a"), F.col("v").alias("b")), None
    chosen = None
    while True:
        ends = live.select("a", "b", "w", "u", "v").unionByName(live.select(F.col("b").alias("a"), F.col("a").alias("b"), "w", "u", "v"))
        least = ends.groupBy("a").agg(F.min(F.struct("w", "u", "v", "b")).alias("e"))
        picked, picked_path = materialise(least.select(F.col("a").alias("x"), F.col("e.b").alias("y"), F.col("e.u").alias("u"), F.col("e.v").alias("v")), "boruvka-picked")
        if picked.isEmpty():
            drop_folder(spark, picked_path)
            break
        added = picked.select("u", "v").distinct()
        chosen = added if chosen is None else chosen.unionByName(added)
        # Two components that picked the same edge point at each other: the smaller becomes the root.
        back = picked.select(F.col("x").alias("y"), F.col("y").alias("x2"))
        point = picked.join(back, "y", "left").where("true").groupBy("x", "y").agg(F.max((F.col("x2") == F.col("x")).cast("int")).alias("mutual"))
        point = point.select("x", F.when((F.col("mutual") == 1) & (F.col("x") < F.col("y")), F.col("x")).otherwise(F.col("y")).alias("y"))
        point, point_path = materialise(point, "boruvka-pointers")
        while True:
            far = point.select(F.col("x").alias("y"), F.col("y").alias("z"))
            jumped, jumped_path = materialise(point.join(far, "y", "left").select("x", F.col("y").alias("was"), F.coalesce("z", "y").alias("y")), "boruvka-pointers")
            drop_folder(spark, point_path)
            done = jumped.where("was <> y").isEmpty()
            point, point_path = jumped.select("x", "y"), jumped_path
            if done:
                break
        moved = label.join(point, label["root"] == point["x"], "left").select("vertex", F.coalesce("y", "root").alias("root"))
        moved, moved_path = materialise(moved, "boruvka-labels")
        drop_folder(spark, label_path)
        label, label_path = moved, moved_path
        a, b = point.select(F.col("x").alias("a"), F.col("y").alias("a2")), point.select(F.col("x").alias("b"), F.col("y").alias("b2"))
        joined = live.join(a, "a", "left").join(b, "b", "left").select("u", "v", "w", F.coalesce("a2", "a").alias("a"), F.coalesce("b2", "b").alias("b")).where("a <> b")
        left, left_path = materialise(joined, "boruvka-live")
        drop_folder(spark, point_path)
        if live_path:
            drop_folder(spark, live_path)
        live, live_path = left, left_path
    if chosen is None:
        chosen = clean.select("u", "v")
    return label, chosen


def group_records(records: DataFrame, id_column: str, links: list[Column]) -> tuple[DataFrame, DataFrame]:
    """(groups, forest): groups has (``id_column``, group), one row per distinct id.  Records that share the value of a
    link, directly or through others, get the same group; a null link ties nothing, and a record without any link is its
    own group.  Null ids are left out."""
    ids = records.where(F.col(id_column).isNotNull())
    vertex = F.concat(F.lit("r"), F.col(id_column).cast("string"))
    keys = F.array(*[F.concat(F.lit(f"k{n}="), k.cast("string")) for n, k in enumerate(links)])
    edges = ids.select(vertex.alias("u"), F.explode(keys).alias("v")).where("v is not null")
    components, forest = spanning_forest(edges)
    one = ids.select(id_column).distinct()
    groups = one.join(components.withColumnRenamed("vertex", "_v"), F.concat(F.lit("r"), F.col(id_column).cast("string")) == F.col("_v"), "left")
    return groups.select(id_column, F.coalesce("root", F.concat(F.lit("r"), F.col(id_column).cast("string"))).alias("group")), forest


def deal(groups: DataFrame, plan: DataFrame) -> DataFrame:
    """Assigns each group (``group``, ``size``) to a split of ``plan`` (split_name, target_share), near the shares of the
    summed size.  Shares need not add up to 1; null sizes count 0.  Adds ``split``; an empty plan gives null."""
    spark = groups.sparkSession
    sized = groups.select("group", F.coalesce(F.col("size").cast("double"), F.lit(0.0)).alias("size"))
    shares = [(r["split_name"], float(r["target_share"])) for r in plan.where("split_name is not null and target_share > 0").orderBy("split_name").collect()]
    if not shares:
        return sized.withColumn("split", F.lit(None).cast("string"))
    whole = sum(s for _, s in shares)
    sums = sized.agg(F.coalesce(F.sum("size"), F.lit(0.0)).alias("t"), F.count("*").alias("n")).first()
    total, buckets = sums["t"], max(1, -(-sums["n"] // BUCKET_GROUPS))
    large = sized.where(F.col("size") * LARGE > total)  # fewer than LARGE rows, by their definition
    lacking = {n: s / whole * total for n, s in shares}
    dealt = []
    for r in large.orderBy(F.desc("size"), "group").collect():
        to = max(shares, key=lambda s: (lacking[s[0]], s[0]))[0]
        lacking[to] -= r["size"]
        dealt.append((r["group"], r["size"], to))
    rest = {n: max(0.0, x) for n, x in lacking.items()}
    whole = sum(rest.values()) or 1.0
    band = F.when(F.col("size") > 0, F.floor(F.log2("size"))).otherwise(-1)
    small = sized.where(~(F.col("size") * LARGE > F.lit(total))).withColumn("band", band).withColumn("bucket", F.pmod(F.xxhash64("group"), F.lit(buckets)))
    i = F.row_number().over(Window.partitionBy("band", "bucket").orderBy(F.xxhash64("group", F.lit(1)), "group")) * buckets + F.col("bucket")
    u = (i * F.lit(GOLDEN)) % 1
    split, upto = None, 0.0
    for n, _ in shares[:-1]:
        upto += rest[n] / whole
        split = F.when(u < upto, n) if split is None else split.when(u < upto, n)
    last = F.lit(shares[-1][0])
    small = small.withColumn("split", last if split is None else split.otherwise(last)).select("group", "size", "split")
    return small.unionByName(spark.createDataFrame(dealt, "group string, size double, split string"))


# ------------------------------------------------------------------- recordings


def task_key(name: Column) -> Column:
    """A task name without regard to case, separators and camel case."""
    return F.nullif(F.regexp_replace(F.lower(name), "[^a-z0-9]", ""), F.lit(""))


def recording_number(episode_id: Column) -> Column:
    """The recording's number, without leading zeros, in any spelling of ``episode_id``; null if there is none."""
    base = F.regexp_extract(F.lower(F.trim(episode_id)), r"([^/\\]*)$", 1)
    after = F.regexp_extract(base, r"seg[\W_]*\d+[\W_]*of[\W_]*(\d+)", 1)
    first = F.regexp_extract(base, r"(\d+)", 1)
    number = F.when(after != "", after).when(first != "", first)
    return F.when(number.isNotNull(), F.coalesce(F.nullif(F.regexp_replace(number, "^0+", ""), F.lit("")), F.lit("0")))


def recordings(episodes: DataFrame, tasks: DataFrame) -> DataFrame:
    """Episodes once each (the latest delivery) with ``recording``: corpus, task and number.  The task is that of
    ``task_name`` in any spelling, else of ``task_index``; without corpus, task or number the key is null."""
    latest = episodes.where("episode_index is not null").groupBy("episode_index").agg(F.max_by(F.struct("episode_id", "task_name", "task_index", "corpus", "split_name", "length"), F.struct(F.coalesce("ingest_ts", F.lit("1970-01-01").cast("timestamp")), F.coalesce("episode_id", F.lit("")))).alias("e")).select("episode_index", "e.*")
    # ``tasks`` has a fixed number of rows.
    names = tasks.where("task_name is not null").select(task_key(F.col("task_name")).alias("_k"), F.col("task_index").alias("_named")).dropDuplicates(["_k"])
    known = latest.join(names, task_key(F.col("task_name")) == F.col("_k"), "left")
    task = F.coalesce(F.col("_named").cast("string"), F.col("task_index").cast("string"), task_key(F.col("task_name")))
    recording = F.concat_ws("|", F.lower(F.trim("corpus")), task, recording_number(F.col("episode_id")))
    complete = F.col("corpus").isNotNull() & task.isNotNull() & recording_number(F.col("episode_id")).isNotNull()
    return known.withColumn("recording", F.when(complete, recording)).drop("_k", "_named")


def frame_counts(frames: DataFrame) -> DataFrame:
    """(episode_index, n_frames): the frames an episode has, each once however often it was delivered."""
    return frames.where("episode_index is not null and frame_index is not null").select("episode_index", "frame_index").distinct().groupBy("episode_index").agg(F.count("*").alias("n_frames"))


def assign_splits(episodes: DataFrame, tasks: DataFrame, plan: DataFrame, frames: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(assignment, forest): (episode_index, split_name, group, n_frames, split), ``split`` being the new one.  The shares
    are those of the frames that ``frames`` holds; an episode without any weighs 0."""
    rows = recordings(episodes, tasks).join(frame_counts(frames), "episode_index", "left").withColumn("n_frames", F.coalesce("n_frames", F.lit(0)))
    rows, _ = materialise(rows, "recordings")
    groups, forest = group_records(rows, "episode_index", [F.col("recording")])
    grouped, _ = materialise(rows.join(groups, "episode_index"), "grouped")
    roots = grouped.groupBy("group").agg(F.sum("n_frames").alias("size"))
    dealt, _ = materialise(deal(roots, plan), "dealt")
    return grouped.join(dealt.select("group", "split"), "group").select("episode_index", "split_name", "group", "n_frames", "split"), forest


def reached_shares(assigned: DataFrame, plan: DataFrame) -> DataFrame:
    """(split, target_share, n_episodes, n_groups, n_frames, share, off): what each split of the plan got of all frames."""
    got = assigned.groupBy("split").agg(F.count("*").alias("n_episodes"), F.countDistinct("group").alias("n_groups"), F.sum("n_frames").alias("n_frames"))
    # The plan has a fixed number of rows, and so has what is joined to it.
    every = plan.where("split_name is not null").groupBy(F.col("split_name").alias("split")).agg(F.max("target_share").alias("target_share")).join(got, "split", "full")
    total = F.sum("n_frames").over(Window.partitionBy())
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    share = F.coalesce(F.col("n_frames") / F.greatest(total, F.lit(1)), F.lit(0.0))
    return every.select("split", "target_share", zero("n_episodes"), zero("n_groups"), zero("n_frames"), share.alias("share"), (share - F.coalesce("target_share", F.lit(0.0))).alias("off"))


def torn_apart(grouped: DataFrame) -> DataFrame:
    """(episode_index_a, episode_index_b), a < b: episodes of one group whose given splits differ.  Groups within one
    split are dropped before the equi-join, which emits the pairs asked for and no others."""
    given = grouped.where("split_name is not null")
    torn = given.groupBy("group").agg(F.min("split_name").alias("lo"), F.max("split_name").alias("hi")).where("lo <> hi").select("group")
    held = given.join(torn, "group", "left_semi").select("group", "episode_index", "split_name")
    a, b = held.alias("a"), held.alias("b")
    return a.join(b, (F.col("a.group") == F.col("b.group")) & (F.col("a.episode_index") < F.col("b.episode_index")) & (F.col("a.split_name") != F.col("b.split_name"))).select(F.col("a.episode_index").alias("episode_index_a"), F.col("b.episode_index").alias("episode_index_b"))


def p6_found(spark: SparkSession, root: str) -> DataFrame:
    """Episodes of one recording that the present splits tear apart."""
    rows, _ = materialise(recordings(spark.read.parquet(f"{root}/episodes.parquet"), spark.read.parquet(f"{root}/tasks.parquet")), "recordings")
    groups, _ = group_records(rows, "episode_index", [F.col("recording")])
    return torn_apart(rows.join(groups, "episode_index").select("episode_index", "split_name", "group"))


def _assigned(spark: SparkSession, root: str) -> DataFrame:
    return assign_splits(*[spark.read.parquet(f"{root}/{t}.parquet") for t in ("episodes", "tasks", "split_plan", "frames")])[0]


def p6_splits(spark: SparkSession, root: str) -> DataFrame:
    """The new split of every episode."""
    return _assigned(spark, root).select("episode_index", "group", "split")


def p6_shares(spark: SparkSession, root: str) -> DataFrame:
    """The shares of frames that the new splits reach, beside those of the plan."""
    return reached_shares(_assigned(spark, root), spark.read.parquet(f"{root}/split_plan.parquet"))


QUERIES = {"p6_found": p6_found, "p6_splits": p6_splits, "p6_shares": p6_shares}
ORACLES = {
    "p6_found": r"""
        WITH e AS (SELECT DISTINCT ON (episode_index) * FROM episodes ORDER BY episode_index, ingest_ts DESC),
        b AS (SELECT e.*, regexp_extract(lower(trim(episode_id)), '([^/\\]*)$', 1) AS base FROM e),
        n AS (SELECT b.*, coalesce(nullif(regexp_extract(base, 'seg[\W_]*[0-9]+[\W_]*of[\W_]*([0-9]+)', 1), ''), nullif(regexp_extract(base, '([0-9]+)', 1), '')) AS num FROM b),
        k AS (SELECT n.*, coalesce(t.task_index, n.task_index) AS task FROM n LEFT JOIN tasks t
              ON regexp_replace(lower(n.task_name), '[^a-z0-9]', '', 'g') = regexp_replace(lower(t.task_name), '[^a-z0-9]', '', 'g'))
        SELECT a.episode_index AS episode_index_a, b.episode_index AS episode_index_b FROM k a JOIN k b
          ON lower(a.corpus) = lower(b.corpus) AND a.task = b.task AND ltrim(a.num, '0') = ltrim(b.num, '0')
         AND a.episode_index < b.episode_index AND a.split_name <> b.split_name"""
}
