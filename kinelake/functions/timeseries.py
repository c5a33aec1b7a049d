"""Filters, differences and run lengths along an ordered axis, as window columns.

All functions take a DataFrame and an :class:`Axis` and add a column, so a chain of them shares one exchange and one sort.
Edges are replicated where the operator says so (a window that shrinks at the edge would give other numbers).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, Window, functions as F


@dataclass(frozen=True)
class Axis:
    """Rows with equal ``keys`` form a series, ordered by ``order``."""

    keys: Sequence[str] = ("episode",)
    order: Sequence[str] = ("frame",)

    @property
    def rows(self):
        return Window.partitionBy(*self.keys).orderBy(*self.order)

    @property
    def so_far(self):
        return self.rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)

    @property
    def whole(self):
        return self.rows.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)

    def at(self, column: str, k: int) -> Column:
        """The value ``k`` rows on, the edge value beyond the edges."""
        if k == 0:
            return F.col(column)
        near = F.lead(column, k).over(self.rows) if k > 0 else F.lag(column, -k).over(self.rows)
        edge = F.last(column).over(self.whole) if k > 0 else F.first(column).over(self.whole)
        return F.when(self.inside(k), near).otherwise(edge)

    def inside(self, k: int) -> Column:
        """Whether there is a row ``k`` rows on."""
        i = F.row_number().over(self.rows)
        return i > -k if k < 0 else i <= F.count(F.lit(1)).over(self.whole) - k

    def length(self) -> Column:
        return F.count(F.lit(1)).over(self.whole)

    def position(self) -> Column:
        return (F.row_number().over(self.rows) - 1).cast("long")


def odd_window(window: int, length: int) -> int:
    """A window made odd and no longer than the series."""
    window = max(1, int(window))
    window += window % 2 == 0
    if window > length:
        window = length if length % 2 == 1 else max(1, length - 1)
    return window


def _by_length(axis: Axis, window: int, least: int, whole: Column, of_window) -> Column:
    """``of_window(w)`` for the odd window that fits the series' length; ``whole`` for series of at most ``least`` rows."""
    full = odd_window(window, 1 << 30)
    n = axis.length()
    out = F.when(n <= least, whole).when(n >= full, of_window(full))
    for w in range(full - 2, 1, -2):
        out = out.when(n >= w, of_window(w))
    return out.otherwise(whole)


def median_filter(df: DataFrame, axis: Axis, column: str, out: str, window: int = 5, shrink: bool = False) -> DataFrame:
    """Running median, edges replicated.  With ``shrink`` the window adapts to short series and series of at most two
    rows stay as they are."""

    def median(w):
        return F.get(F.sort_array(F.array(*[axis.at(column, k) for k in range(-(w // 2), w // 2 + 1)])), F.lit(w // 2))

    return df.withColumn(out, _by_length(axis, window, 2, F.col(column), median) if shrink else median(odd_window(window, 1 << 30)))


def fir(df: DataFrame, axis: Axis, column: str, out: str, taps: Sequence[float], least: int = 1) -> DataFrame:
    """Finite impulse response with replicated edges; series shorter than ``least`` stay as they are."""
    half = len(taps) // 2
    value = sum((F.lit(float(c)) * axis.at(column, k - half) for k, c in enumerate(taps)), F.lit(0.0))
    return df.withColumn(out, F.when(axis.length() >= least, value).otherwise(F.col(column)) if least > 1 else value)


def savgol_taps(window: int = 11, order: int = 3) -> list[float]:
    """Smoothing coefficients: the value at 0 of the least-squares polynomial over the window."""
    x = np.arange(window) - window // 2
    return np.linalg.pinv(np.vander(x, order + 1, increasing=True))[0].tolist()


def savgol(df: DataFrame, axis: Axis, column: str, out: str, window: int = 11, order: int = 3) -> DataFrame:
    """Savitzky-Golay with replicated edges; series shorter than the window stay as they are."""
    return fir(df, axis, column, out, savgol_taps(window, order), window)


def savgol_shrinking(df: DataFrame, axis: Axis, column: str, out: str, window: int = 11, order: int = 2) -> DataFrame:
    """The variant whose window shrinks with the series; no smoothing where length or window is at most order + 1."""

    def smooth(w):
        if w <= order + 1:
            return F.col(column)
        return sum((F.lit(c) * axis.at(column, k - w // 2) for k, c in enumerate(savgol_taps(w, order))), F.lit(0.0))

    return df.withColumn(out, _by_length(axis, window, order + 1, F.col(column), smooth))


def trend(df: DataFrame, axis: Axis, column: str, out: str, median: int = 5, window: int = 11, order: int = 3) -> DataFrame:
    """Median, then Savitzky-Golay."""
    return savgol(median_filter(df, axis, column, "_median", median), axis, "_median", out, window, order).drop("_median")


def moving_average(df: DataFrame, axis: Axis, column: str, out: str, window: int = 11) -> DataFrame:
    """Mean over a window that shrinks with short series, edges replicated; series of at most two rows stay."""
    return df.withColumn(out, _by_length(axis, window, 2, F.col(column), lambda w: sum((axis.at(column, k) for k in range(-(w // 2), w // 2 + 1)), F.lit(0.0)) / w))


def gradient(df: DataFrame, axis: Axis, column: str, out: str) -> DataFrame:
    """Central differences, one-sided at the ends; null for a series of one row."""
    x, back, ahead = F.col(column), F.lag(column).over(axis.rows), F.lead(column).over(axis.rows)
    return df.withColumn(out, F.when(~axis.inside(-1), ahead - x).when(~axis.inside(1), x - back).otherwise((ahead - back) / 2))


def accel_jerk(df: DataFrame, axis: Axis, column: str) -> DataFrame:
    """``accel`` and ``jerk``: the gradient taken twice and three times."""
    return gradient(gradient(gradient(df, axis, column, "_g"), axis, "_g", "accel"), axis, "accel", "jerk").drop("_g")


def plain_difference(df: DataFrame, axis: Axis, column: str, out: str, order: int) -> DataFrame:
    """The n-th backward difference; null for the first ``order`` rows."""
    return df.withColumn(out, sum(((-1) ** i * math.comb(order, i) * (F.lag(column, i).over(axis.rows) if i else F.col(column)) for i in range(order + 1)), F.lit(0.0)))


def padded_difference(df: DataFrame, axis: Axis, column: str, out: str, order: int) -> DataFrame:
    """abs of the n-th difference, centred and edge-padded to the series' length; 0 for series of at most ``order`` rows."""
    ahead = sum(((-1) ** (order - i) * math.comb(order, i) * (F.lead(column, i).over(axis.rows) if i else F.col(column)) for i in range(order + 1)), F.lit(0.0))
    df = df.withColumn("_d", F.when(axis.inside(order), F.abs(ahead)))
    left = order // 2
    shifted = F.lag("_d", left).over(axis.rows) if left else F.col("_d")
    value = F.when(~axis.inside(-left), F.first("_d").over(axis.whole)).otherwise(F.coalesce(shifted, F.last("_d", ignorenulls=True).over(axis.whole))) if left else F.coalesce(shifted, F.last("_d", ignorenulls=True).over(axis.whole))
    return df.withColumn(out, F.when(axis.length() <= order, F.lit(0.0)).otherwise(value)).drop("_d")


def runs_of(df: DataFrame, axis: Axis, flag: str) -> DataFrame:
    """Adds ``run`` (number of the run the row is in), counting runs of equal ``flag`` from 1."""
    change = F.coalesce((F.lag(flag).over(axis.rows) != F.col(flag)).cast("long"), F.lit(1))
    return df.withColumn("_change", change).withColumn("run", F.sum("_change").over(axis.so_far)).drop("_change")


def spans(df: DataFrame, axis: Axis, flag: str) -> DataFrame:
    """(keys, run_start, run_end, run_length): the runs of true flags, ends inclusive."""
    at = axis.order[0]
    return runs_of(df, axis, flag).where(F.col(flag)).groupBy(*axis.keys, "run").agg(F.min(at).alias("run_start"), F.max(at).alias("run_end"), F.count("*").alias("run_length")).drop("run")


def keep_long_runs(df: DataFrame, axis: Axis, flag: str, out: str, least: int) -> DataFrame:
    """Flags that lie in runs of at least ``least`` rows."""
    if least <= 1:
        return df.withColumn(out, F.col(flag))
    n = F.count("*").over(Window.partitionBy(*axis.keys, "run"))
    return runs_of(df, axis, flag).withColumn(out, F.col(flag) & (n >= least)).drop("run")


def forward_fill(df: DataFrame, axis: Axis, column: str, out: str) -> DataFrame:
    """The last value that is not null; a leading gap takes the first one; all null stays null."""
    return df.withColumn(out, F.coalesce(F.last(column, ignorenulls=True).over(axis.so_far), F.first(column, ignorenulls=True).over(axis.whole)))


def integrate(df: DataFrame, axis: Axis, column: str, out: str) -> DataFrame:
    """Cumulative sum plus the first value (which counts twice at the start)."""
    return df.withColumn(out, F.sum(column).over(axis.so_far) + F.first(column).over(axis.whole))


def prefix_keep(df: DataFrame, axis: Axis, bad: str, out: str = "keep") -> DataFrame:
    """1 until the first bad row, 0 from it on."""
    return df.withColumn(out, (1 - F.max(F.col(bad).cast("int")).over(axis.so_far)).cast("int"))


def startup(df: DataFrame, axis: Axis, moves: Column, out: str = "startup", grace: int = 0) -> DataFrame:
    """True before the series first moves (and ``grace`` rows on); a series that never moves is true throughout."""
    at = axis.order[0]
    first = F.min(F.when(moves, F.col(at))).over(axis.whole)
    return df.withColumn(out, first.isNull() | (F.col(at) < first + grace))
