"""State/action alignment: best lag and directional agreement over shifted differences.

The 2 L + 1 lags are unrolled lag/lead columns of one window, so the cost is linear and nothing is joined by range.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F

from kinelake.functions.timeseries import Axis, trend


def differences(df: DataFrame, axis: Axis, state: str, action: str, smooth: bool = True) -> DataFrame:
    """``ds`` and ``da``: first differences of the (smoothed) columns; the first row of a series is dropped."""
    if smooth:
        df = trend(trend(df, axis, state, "_s"), axis, action, "_a")
        state, action = "_s", "_a"
    df = df.withColumn("ds", F.col(state) - F.lag(state).over(axis.rows)).withColumn("da", F.col(action) - F.lag(action).over(axis.rows))
    return df.where("ds is not null and da is not null")


def best_lag(diffs: DataFrame, axis: Axis, max_lag: int = 5, least: int = 10, digits: int = 9) -> DataFrame:
    """(keys, n, lag, corr): the lag in [-max_lag, max_lag] with the greatest z-scored cross-correlation; the smallest
    lag wins ties (of correlations rounded to ``digits``).  Fewer than ``least + max_lag`` differences: lag 0, corr null.
    lag > 0: the state lags the action."""
    keys = list(axis.keys)
    w = Window.partitionBy(*keys)
    z = diffs.withColumn("_zs", (F.col("ds") - F.avg("ds").over(w)) / (F.stddev_pop("ds").over(w) + 1e-8)).withColumn("_za", (F.col("da") - F.avg("da").over(w)) / (F.stddev_pop("da").over(w) + 1e-8))

    def shifted(k):
        return F.col("_za") if k == 0 else F.lag("_za", k).over(axis.rows) if k > 0 else F.lead("_za", -k).over(axis.rows)

    lags = range(-max_lag, max_lag + 1)
    for k in lags:
        z = z.withColumn(f"_p{k + max_lag}", F.col("_zs") * shifted(k))
    n = F.count("*")
    sums = z.groupBy(*keys).agg(n.alias("n"), *[(F.coalesce(F.sum(f"_p{k + max_lag}"), F.lit(0.0)) / n).alias(f"_c{k + max_lag}") for k in lags])
    every = F.array(*[F.struct(F.round(f"_c{k + max_lag}", digits).alias("corr"), F.lit(-k).alias("order")) for k in lags])
    best = F.array_max(every)
    enough = F.col("n") >= least + max_lag
    return sums.withColumn("_b", best).select(*keys, "n", F.when(enough, -F.col("_b.order")).otherwise(0).cast("long").alias("lag"), F.when(enough, F.col("_b.corr")).alias("corr"))


def directional_agreement(diffs: DataFrame, lags: DataFrame, axis: Axis, max_lag: int = 5, epsilon: float = 1e-4, least: int = 10) -> DataFrame:
    """(keys, lag, n_active, score): the share of equal signs over lag-aligned differences that both exceed ``epsilon``;
    null with fewer than ``least`` of them, or where no lag could be searched."""
    keys = list(axis.keys)
    rows = diffs.join(lags, keys)
    partner = F.col("da")
    for k in range(1, max_lag + 1):
        rows = rows.withColumn(f"_b{k}", F.lag("da", k).over(axis.rows)).withColumn(f"_f{k}", F.lead("da", k).over(axis.rows))
    for k in range(1, max_lag + 1):
        partner = F.when(F.col("lag") == k, F.col(f"_b{k}")).when(F.col("lag") == -k, F.col(f"_f{k}")).otherwise(partner)
    rows = rows.withColumn("_a", partner)
    active = (F.abs("ds") > epsilon) & (F.abs("_a") > epsilon)
    out = rows.groupBy(*keys).agg(F.first("lag").alias("lag"), F.first("corr").alias("corr"), F.count(F.when(active, 1)).alias("n_active"), F.avg(F.when(active, (F.signum("ds") == F.signum("_a")).cast("double"))).alias("score"))
    return out.withColumn("score", F.when((F.col("n_active") >= least) & F.col("corr").isNotNull(), F.col("score"))).drop("corr")


def pooled_agreement(diffs: DataFrame, axis: Axis, episode: list[str], max_lag: int = 10) -> DataFrame:
    """(episode, lag, score): the episode filter's version: the share of equal signs (zeros agree) pooled over all
    channels, at the lag where it is greatest; the smallest lag wins ties.  lag > 0: the action lags the state."""
    lags = range(-max_lag, max_lag + 1)
    for k in lags:
        partner = F.col("da") if k == 0 else F.lead("da", k).over(axis.rows) if k > 0 else F.lag("da", -k).over(axis.rows)
        diffs = diffs.withColumn(f"_e{k + max_lag}", (F.signum("ds") == F.signum(partner)).cast("double"))
    means = diffs.groupBy(*episode).agg(*[F.avg(f"_e{k + max_lag}").alias(f"_m{k + max_lag}") for k in lags])
    best = F.array_max(F.array_compact(F.array(*[F.when(F.col(f"_m{k + max_lag}").isNotNull(), F.struct(F.round(f"_m{k + max_lag}", 12).alias("score"), F.lit(-k).alias("order"))) for k in lags])))
    return means.withColumn("_b", best).select(*episode, (-F.col("_b.order")).cast("long").alias("lag"), F.col("_b.score").alias("score"))
