"""Value counts, and what follows from them: moments and exact quantiles (linear
interpolation, as numpy/pandas/DuckDB ``quantile_cont``), computed without
gathering a group into one task.

Rows collapse to (group, value, count) with map-side combine, so one hot value
costs one row. The counts are written once to the shared folder. For quantiles
they are cut by a range partitioning into ranges of about ``rows_per_range``
values, as many as the data needs; range totals give each range its starting
rank, and only the ranges that hold a wanted rank are ordered, each by itself.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellar.functions.exprs import ROUND, rnd
from cellar.session import materialize


def value_counts(df: DataFrame, value: str, by: list[str] | None = None) -> DataFrame:
    """(by..., _v, _c): how often each value occurs per group; NULL and NaN are no values. Runs a job."""
    v = F.col(value).cast("double")
    base = df.select(*(by or []), F.when(~F.isnan(v), v).alias("_v")).where(F.col("_v").isNotNull())
    return materialize(base.groupBy(*(by or []), "_v").agg(F.count(F.lit(1)).alias("_c")), "value-counts")


def count_mean(decimals: int | None = None, value: str = "_v", count: str | None = "_c") -> tuple[Column, Column]:
    """Aggregates over value counts (without ``count``: over values): number of values, and mean rounded to 6 digits.

    With ``decimals`` the sum is taken over exact decimals, so the mean does not
    depend on summation order (see ``exprs.mean``).
    """
    v, c = F.col(value), F.col(count) if count else F.lit(1).cast("long")
    n = F.sum(c) if count else F.nullif(F.count(v), F.lit(0).cast("long"))
    if decimals is None:
        return n, rnd(F.sum(v * c) / n)
    exact = F.sum(v.cast(f"decimal(18,{decimals})") * c.cast("decimal(18,0)"))
    return n, F.round(exact.cast(f"decimal(38,{decimals + 8})") / n.cast("decimal(20,0)"), ROUND).cast("double")


def moments(counts: DataFrame, by: list[str], decimals: int | None = None) -> DataFrame:
    """(by..., count, mean, std, min, max) per group; the sample deviation sums squares around the mean."""
    n, mean = count_mean(decimals)
    rough = counts.groupBy(*by).agg((F.sum(F.col("_v") * F.col("_c")) / F.sum("_c")).alias("_m"), n.alias("count"), mean.alias("mean"), F.min("_v").alias("min"), F.max("_v").alias("max"))
    d = F.col("_v") - F.col("_m")
    squares = counts.join(rough.select(*by, "_m"), by).groupBy(*by).agg(F.sum(d * d * F.col("_c")).alias("_q"))
    std = F.when(F.col("count") > 1, rnd(F.sqrt(F.col("_q") / (F.col("count") - 1))))
    return rough.join(squares, by).select(*by, "count", "mean", std.alias("std"), "min", "max")


def exact_quantiles(
    df: DataFrame, value: str, qs: list[float], by: list[str] | None = None, names: list[str] | None = None, rows_per_range: int = 1_000_000
) -> DataFrame:
    """One row per group with one column per quantile in ``qs``.

    NULL and NaN values are ignored; a group with no value gets no row.
    """
    return quantiles_of_counts(value_counts(df, value, by), qs, by, names, rows_per_range)


def quantiles_of_counts(counts: DataFrame, qs: list[float], by: list[str] | None = None, names: list[str] | None = None, rows_per_range: int = 1_000_000) -> DataFrame:
    """Exact quantiles from (by..., _v, _c); see ``exact_quantiles``."""
    by = list(by or [])
    names = names or [f"q{int(round(q * 100))}" for q in qs]
    gcols = by if by else ["_g"]
    vc = counts if by else counts.withColumn("_g", F.lit(0))
    ranges = math.ceil(vc.count() / rows_per_range)
    if ranges > 1:
        # written once: a row's range must not change between its uses
        cut = vc.repartitionByRange(ranges, *gcols, "_v").withColumn("_k", F.spark_partition_id())
        vcb = materialize(cut, "value-ranges")
    else:
        vcb = vc.withColumn("_k", F.lit(0))
    # rank offset of every range: a prefix sum over (groups x ranges) rows
    totals = vcb.groupBy(*gcols, "_k").agg(F.sum("_c").alias("_bc"))
    wg = Window.partitionBy(*gcols).orderBy("_k").rowsBetween(Window.unboundedPreceding, 0)
    totals = totals.select(
        *gcols,
        "_k",
        "_bc",
        (F.sum("_bc").over(wg) - F.col("_bc")).alias("_off"),
        F.sum("_bc").over(Window.partitionBy(*gcols)).alias("_n"),
    )
    # only the ranges holding a wanted rank (two per quantile) are ordered
    holds = []
    for q in qs:
        h = (F.col("_n") - 1) * F.lit(float(q))
        for pos in (F.floor(h), F.ceil(h)):
            holds.append((F.col("_off") <= pos) & (pos < F.col("_off") + F.col("_bc")))
    wanted = totals.where(reduce(lambda a, b: a | b, holds)).select(*gcols, "_k", "_off", "_n")
    wb = Window.partitionBy(*gcols, "_k").orderBy("_v").rowsBetween(Window.unboundedPreceding, 0)
    cum = vcb.join(wanted, gcols + ["_k"]).select(
        *gcols, "_v", "_n", (F.col("_off") + F.sum("_c").over(wb)).alias("_cum")
    )
    aggs = [F.first("_n").alias("_n")]
    for i, q in enumerate(qs):
        h = (F.col("_n") - 1) * F.lit(float(q))
        aggs.append(F.min(F.when(F.col("_cum") > F.floor(h), F.col("_v"))).alias(f"_lo{i}"))
        aggs.append(F.min(F.when(F.col("_cum") > F.ceil(h), F.col("_v"))).alias(f"_hi{i}"))
    res = cum.groupBy(*gcols).agg(*aggs)
    out = []
    for i, q in enumerate(qs):
        h = (F.col("_n") - 1) * F.lit(float(q))
        frac = h - F.floor(h)
        out.append((F.col(f"_lo{i}") + frac * (F.col(f"_hi{i}") - F.col(f"_lo{i}"))).alias(names[i]))
    return res.select(*by, *out)
