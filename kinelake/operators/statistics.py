"""Dataset-wide and per-episode statistics: histograms, percentiles, hybrid thresholds, feature statistics.

Series are long: one row per (episode, frame, channel) with a value.  Histograms are sparse, so only bins that hold
something are shuffled, and those of separate partitions or days add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

BINS = 65_536


def value_ranges(series: DataFrame, keys: list[str], value: str) -> DataFrame:
    """Pass 1: (keys, lo, hi, n); NaN and null do not count."""
    x = F.nanvl(F.col(value), F.lit(None).cast("double"))
    return series.groupBy(*keys).agg(F.min(x).alias("lo"), F.max(x).alias("hi"), F.count(x).alias("n"))


def _known(ranges: list, keys: list[str], name: str) -> Column:
    """A value of ``ranges`` (one entry per group) for the row's group, as a literal; null for other groups.

    The groups are few by what they are (channels, and metrics of channels), so their ranges enter the plan as literals and
    no row is shuffled to meet them."""
    table: dict = {}
    for r in ranges:
        table.setdefault(tuple(r[k] for k in keys[1:]), {})[r[keys[0]]] = r[name]
    out = F.lit(None).cast("double")
    for others, values in table.items():
        literal = F.map_from_arrays(F.array(*[F.lit(k) for k in values]), F.array(*[F.lit(float("nan") if v is None else float(v)) for v in values.values()]))
        here = F.try_element_at(literal, F.col(keys[0]))
        test = F.lit(True)
        for k, v in zip(keys[1:], others):
            test = test & (F.col(k) == F.lit(v))
        out = F.when(test, here).otherwise(out)
    return out


def histogram(series: DataFrame, ranges: DataFrame | list, keys: list[str], value: str, bins: int = BINS, flat: float = 1.0) -> DataFrame:
    """Pass 2: (keys, bin, count, lo, span).  bin = floor((v - lo) / span * (bins - 1)) within 0 .. bins - 1; a span
    under 1e-12 becomes ``flat``.  ``ranges`` has a row per group, of which there are few; rows are binned where they are
    and only bins are shuffled."""
    known = ranges if isinstance(ranges, list) else ranges.collect()
    rows = series.where(F.col(value).isNotNull() & ~F.isnan(value)).withColumn("lo", _known(known, keys, "lo")).withColumn("hi", _known(known, keys, "hi")).where("lo is not null")
    rows = rows.withColumn("span", F.when(F.col("hi") - F.col("lo") < 1e-12, F.lit(flat)).otherwise(F.col("hi") - F.col("lo")))
    at = F.floor((F.col(value) - F.col("lo")) / F.col("span") * (bins - 1))
    return rows.withColumn("bin", F.greatest(F.lit(0), F.least(F.lit(bins - 1), at)).cast("long")).groupBy(*keys, "bin").agg(F.count("*").alias("count"), F.first("lo").alias("lo"), F.first("span").alias("span"))


def exact_quantiles(series: DataFrame, key: str, value: str, fractions: dict[str, float], bins: int = 1024) -> DataFrame:
    """(key, one column per name in ``fractions``): exact percentiles with linear interpolation, for few groups of any size.

    The range that holds a wanted rank is cut into ``bins``; the bin with the rank, bounded by the least and greatest value
    seen in it, is the next range, until that is one value.  A round is a scan with partial aggregation (at most ``bins``
    rows per open range come back); no value is shuffled.  NaN and null do not count; a group without values is missing."""
    spark = series.sparkSession
    x = F.nanvl(F.col(value).cast("double"), F.lit(None).cast("double"))
    most = 1.7976931348623157e308  # stands for infinity while ranges are cut
    rows = series.select(F.col(key).alias("_k"), x.alias("_x")).where("_x is not null").withColumn("_x", F.greatest(F.lit(-most), F.least(F.lit(most), "_x")))
    ranges = rows.groupBy("_k").agg(F.min("_x").alias("lo"), F.max("_x").alias("hi"), F.count("*").alias("n")).collect()
    open_, found = {}, {}
    for r in ranges:
        for q in fractions.values():
            at = int(q * (r["n"] - 1))
            for rank in {at, min(at + 1, r["n"] - 1)}:
                open_[r["_k"], rank] = (r["lo"], r["hi"], 0)
    while open_ := {k: s for k, s in open_.items() if s[0] < s[1] or found.__setitem__(k, s[0])}:
        asked: dict = {}
        for (k, _), (lo, hi, _) in open_.items():
            asked.setdefault(k, []).append((lo, hi)) if (lo, hi) not in asked.get(k, []) else None
        literal = F.map_from_arrays(F.array(*[F.lit(k) for k in asked]), F.array(*[F.array(*[F.struct(F.lit(i).alias("i"), F.lit(lo).alias("lo"), F.lit(hi).alias("hi")) for i, (lo, hi) in enumerate(v)]) for v in asked.values()]))
        inside = F.filter(F.try_element_at(literal, F.col("_k")), lambda s: F.col("_x").between(s["lo"], s["hi"]))
        one = rows.select("_k", "_x", F.explode(inside).alias("s"))
        bin_ = F.least(F.lit(bins - 1), F.floor((F.col("_x") / 2 - F.col("s.lo") / 2) / (F.col("s.hi") / 2 - F.col("s.lo") / 2) * bins)).cast("int")
        counts: dict = {}
        for c in one.groupBy("_k", "s.i", bin_.alias("bin")).agg(F.count("*").alias("n"), F.min("_x").alias("lo"), F.max("_x").alias("hi")).collect():
            counts.setdefault((c["_k"], c["i"]), []).append((c["bin"], c["n"], c["lo"], c["hi"]))
        for (k, rank), (lo, hi, below) in list(open_.items()):
            for _, n, a, b in sorted(counts[k, asked[k].index((lo, hi))]):
                if rank < below + n:
                    open_[k, rank] = (a, b, below)
                    break
                below += n
    out = []
    for r in ranges:
        values = []
        for q in fractions.values():
            place = q * (r["n"] - 1)
            a, b = (v if abs(v) < most else v * 2 for v in (found[r["_k"], int(place)], found[r["_k"], min(int(place) + 1, r["n"] - 1)]))
            values.append(a if a == b or place == int(place) else a + (b - a) * (place - int(place)))
        out.append((r["_k"], *values))
    kind = series.schema[key].dataType.simpleString()
    return spark.createDataFrame(out, f"`{key}` {kind}, " + ", ".join(f"`{n}` double" for n in fractions))


def histogram_quantiles(counts: DataFrame, keys: list[str], quantiles: dict[str, float], bins: int = BINS) -> DataFrame:
    """The value of the first bin whose cumulated count reaches q times the total, for each name in ``quantiles``."""
    w = Window.partitionBy(*keys)
    upto, total = F.sum("count").over(w.orderBy("bin")), F.sum("count").over(w)
    at = counts.withColumn("_upto", upto).withColumn("_total", total).withColumn("_value", F.col("lo") + F.col("bin") / F.lit(bins - 1) * F.col("span"))
    return at.groupBy(*keys).agg(*[F.min(F.when(F.col("_upto") >= q * F.col("_total"), F.col("_value"))).alias(n) for n, q in quantiles.items()])


def histogram_moments(counts: DataFrame, keys: list[str], bins: int = BINS) -> DataFrame:
    """(keys, mean, std, mad, scale) with mad the mean absolute deviation about the mean, scale = max(mad, std / 100, 1e-12)."""
    v = counts.withColumn("_v", F.col("lo") + F.col("bin") / F.lit(bins - 1) * F.col("span"))
    mean = v.groupBy(*keys).agg((F.sum(F.col("_v") * F.col("count")) / F.sum("count")).alias("mean"))
    d = F.col("_v") - F.col("mean")
    out = v.join(mean, keys).groupBy(*keys).agg(F.first("mean").alias("mean"), F.sqrt(F.sum(d * d * F.col("count")) / F.sum("count")).alias("std"), (F.sum(F.abs(d) * F.col("count")) / F.sum("count")).alias("mad"))
    return out.withColumn("scale", F.greatest("mad", F.col("std") * 0.01, F.lit(1e-12)))


def hybrid_thresholds(counts: DataFrame, keys: list[str], k: float, percentile: float, bins: int = BINS) -> DataFrame:
    """(keys, threshold): max(k * scale, percentile, 1e-12), both from the histogram."""
    scale = histogram_moments(counts, keys, bins).select(*keys, "scale")
    floor = histogram_quantiles(counts, keys, {"floor": percentile / 100}, bins)
    return scale.join(floor, keys).withColumn("threshold", F.greatest(F.lit(k) * F.col("scale"), "floor", F.lit(1e-12)))


def episode_thresholds(series: DataFrame, keys: list[str], value: str, k: float, percentile: float) -> DataFrame:
    """(keys, threshold) from each episode's own values: max(k * max(median abs deviation + 1e-12, std / 100), percentile, 1e-12)."""
    middle = series.groupBy(*keys).agg(F.median(value).alias("_m"), F.stddev_pop(value).alias("_s"), F.percentile(value, F.lit(percentile / 100)).alias("_p"))
    spread = series.join(middle.select(*keys, "_m"), keys).groupBy(*keys).agg((F.median(F.abs(F.col(value) - F.col("_m"))) + 1e-12).alias("_mad"))
    return middle.join(spread, keys).select(*keys, F.greatest(F.lit(k) * F.greatest("_mad", F.col("_s") * 0.01), "_p", F.lit(1e-12)).alias("threshold"))


def percentile_bounds(series: DataFrame, key: str, value: str, lower: float, upper: float, alpha: float) -> DataFrame:
    """(key, q_lo, q_hi, lower, upper): exact percentiles (fractions) of few groups, widened by ``alpha`` times their
    distance."""
    q = exact_quantiles(series, key, value, {"q_lo": lower, "q_hi": upper})
    d = alpha * (F.col("q_hi") - F.col("q_lo"))
    return q.withColumn("lower", F.col("q_lo") - d).withColumn("upper", F.col("q_hi") + d)


def feature_stats(series: DataFrame, keys: list[str], value: str) -> DataFrame:
    """(keys, min, max, mean, std, count) with the population standard deviation."""
    return series.groupBy(*keys).agg(F.min(value).alias("min"), F.max(value).alias("max"), F.avg(value).alias("mean"), F.stddev_pop(value).alias("std"), F.count(value).alias("count"))


def stats_of_stats(stats: DataFrame, keys: list[str]) -> DataFrame:
    """Combined statistics: least min, greatest max, count-weighted means of mean and of std (not the pooled one)."""
    n = F.sum("count")
    return stats.groupBy(*keys).agg(F.min("min").alias("min"), F.max("max").alias("max"), (F.sum(F.col("mean") * F.col("count")) / n).alias("mean"), (F.sum(F.col("std") * F.col("count")) / n).alias("std"), n.alias("count"))


def normalised(series: DataFrame, bounds: DataFrame, keys: list[str], value: str, out: str = "normalised") -> DataFrame:
    """Values mapped so that q_lo..q_hi becomes -1..1 (0 where both are equal)."""
    width = F.col("q_hi") - F.col("q_lo")
    return series.join(bounds.select(*keys, "q_lo", "q_hi"), keys).withColumn(out, F.when(width > 1e-12, 2 * (F.col(value) - F.col("q_lo")) / width - 1).otherwise(0.0)).drop("q_lo", "q_hi")
