"""Counts, top-n, summaries, histograms, dense ids.

Numeric operators take NaN for missing, as NULL (D3): every one of them passes
its input through ``nan_as_null`` first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cellar.functions.exprs import mean, nan_as_null, rnd, small_side
from cellar.functions.quantiles import count_mean, moments, quantiles_of_counts, value_counts
from cellar.session import materialize


def count_per_key(df: DataFrame, key: str, name: str = "n") -> DataFrame:
    """A1: rows per key; NULL keys are dropped first (D7). Partial + final aggregation."""
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias(name))


def top_n_by_count(df: DataFrame, key: str, n: int, name: str = "n") -> DataFrame:
    """The n keys with most rows; ties by key ascending.

    Sort + limit plans as TakeOrderedAndProject: each task keeps its own n best,
    only n rows per task reach the final merge.
    """
    return count_per_key(df, key, name).orderBy(F.desc(name), F.asc(key)).limit(n)


def value_counts_top(df: DataFrame, key: str, n: int = 10) -> DataFrame:
    """A2: pandas ``value_counts().head(n)`` — NULL skipped, count desc, key asc."""
    return top_n_by_count(df, key, n, "count")


def distinct_counts(ratings: DataFrame, user: str = "uid", item: str = "item_id", approx: float | None = None) -> DataFrame:
    """A3/A4: rows, distinct users, distinct items in one pass.

    Exact distinct counts shuffle every distinct key; with ``approx`` (relative
    standard deviation, e.g. 0.01) HyperLogLog sketches are merged instead.
    """
    if approx:
        du, di = F.approx_count_distinct(user, approx), F.approx_count_distinct(item, approx)
    else:
        du, di = F.countDistinct(user), F.countDistinct(item)
    return ratings.agg(F.count(F.lit(1)).alias("n_ratings"), du.alias("n_users"), di.alias("n_items"))


def matrix_density(ratings: DataFrame, user: str = "uid", item: str = "item_id") -> DataFrame:
    """A5: ratings / (users x items)."""
    c = distinct_counts(ratings, user, item)
    return c.select(
        "n_ratings",
        "n_users",
        "n_items",
        rnd(F.col("n_ratings") / (F.col("n_users").cast("double") * F.col("n_items"))).alias("density"),
    )


def mean_per_key(df: DataFrame, key: str, cols: list[str], suffix: str = "_mean", decimals: int | None = None) -> DataFrame:
    """Mean of every numeric column per key (text columns are not averaged, D4)."""
    return nan_as_null(df, cols).groupBy(key).agg(*[mean(c, decimals).alias(f"{c}{suffix}") for c in cols])


def means_sorted(df: DataFrame, key: str, value: str, name: str = "mean") -> DataFrame:
    """Mean per category, ordered by the mean."""
    return nan_as_null(df, [value]).groupBy(key).agg(rnd(F.avg(value)).alias(name)).orderBy(name, key)


def null_counts(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Missing cells (NULL or NaN) per column, one row per column (unpivoted)."""
    cols = cols or df.columns
    wide = nan_as_null(df, cols).agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    return wide.unpivot([], cols, "column", "n_null")


def numeric_describe(df: DataFrame, cols: list[str], decimals: int | None = None) -> DataFrame:
    """A10: count, mean, std, min, exact quartiles, max for each column (long form).

    One scan: the columns are unpivoted and reduced to value counts (a job),
    from which everything follows; quartiles are exact (not ``summary()``'s
    approximate ones). A column without a value has count 0 and else NULL.
    """
    long = df.select([F.col(c).cast("double").alias(c) for c in cols]).unpivot([], cols, "column", "value")
    counts = value_counts(long, "value", ["column"])
    qs = quantiles_of_counts(counts, [0.25, 0.5, 0.75], ["column"], ["q25", "q50", "q75"])
    qs = qs.select("column", *[rnd(c).alias(c) for c in ("q25", "q50", "q75")])
    every = df.sparkSession.createDataFrame([(c,) for c in cols], "column string")
    out = every.join(moments(counts, ["column"], decimals), "column", "left").join(qs, "column", "left")
    return out.select("column", F.coalesce("count", F.lit(0)).cast("long").alias("count"), "mean", "std", "min", "q25", "q50", "q75", "max")


def per_key_count_stats(ratings: DataFrame, key: str, value: str = "score") -> DataFrame:
    """Ratings per user (or item), counting only cells > 0 (D9), then min/max/mean."""
    c = nan_as_null(ratings, [value]).where(F.col(value) > 0).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    return c.agg(
        F.count(F.lit(1)).alias("n_keys"),
        F.min("n").alias("min_n"),
        F.max("n").alias("max_n"),
        rnd(F.avg("n")).alias("mean_n"),
    )


def histogram(df: DataFrame, value: str, bins: int = 10) -> DataFrame:
    """Equal-width histogram between min and max (pandas ``hist``): always ``bins`` rows,
    empty bins too; no rows when there is no value.

    The bounds are a scalar subquery, computed once and not joined to the rows.
    """
    df = nan_as_null(df.select(F.col(value).cast("double").alias("_v")))
    stats = df.agg(F.min("_v").alias("lo"), F.max("_v").alias("hi"))
    lo = stats.select("lo").scalar()
    hi = stats.select("hi").scalar()
    width = (hi - lo) / F.lit(bins)
    b = F.when(hi == lo, F.lit(0)).otherwise(F.least(F.floor((F.col("_v") - lo) / width), F.lit(bins - 1)))
    counts = df.where(F.col("_v").isNotNull()).groupBy(b.cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("count"))
    every = df.sparkSession.range(bins).select(F.col("id").cast("int").alias("bin"))
    return (
        every.join(counts, "bin", "left")
        .select("bin", rnd(lo + F.col("bin") * width).alias("lower"), rnd(lo + (F.col("bin") + 1) * width).alias("upper"), F.coalesce("count", F.lit(0)).cast("bigint").alias("count"))
        .where(F.col("lower").isNotNull())
    )


HEAVY_KEY = 100_000  # rows of a key that are not gathered in one group


def avg_median(df: DataFrame, key: str, cols: list[str], decimals: int | None = None) -> DataFrame:
    """Average and exact median per key of several sub-scores; empty -> NULL. Rows without a key are left out.

    A key's rows are shuffled once, whole, and its sub-scores sorted as arrays. Keys
    with more than ``HEAVY_KEY`` rows go by value counts instead. Runs a job that looks for those.
    """
    value = lambda c: F.when(~F.isnan(F.col(c).cast("double")), F.col(c).cast("double") + 0.0)  # noqa: E731  (no -0.0)
    wide = df.where(F.col(key).isNotNull()).select(key, *[value(c).alias(c) for c in cols])
    heavy = wide.groupBy(key).count().where(F.col("count") > HEAVY_KEY).select(key)
    n_heavy = heavy.count()
    light = wide.join(small_side(heavy, n_heavy), key, "left_anti") if n_heavy else wide
    rows = light.repartition(key).groupBy(key).agg(*[count_mean(decimals, c, None)[1].alias(f"{c}_avg") for c in cols], *[F.sort_array(F.collect_list(c)).alias(f"_{c}_all") for c in cols])
    out = rows.select(key, *[f"{c}_avg" for c in cols], *[rnd(_middle(F.col(f"_{c}_all"))).alias(f"{c}_med") for c in cols])
    return out.unionByName(_avg_median_of_counts(wide.join(small_side(heavy, n_heavy), key, "left_semi"), key, cols, decimals)) if n_heavy else out


def _middle(a: Column) -> Column:
    """The median of a sorted array, NULL if it is empty."""
    h = (F.size(a) - 1) * F.lit(0.5)
    lo, hi = (F.get(a, x.cast("int")) for x in (F.floor(h), F.ceil(h)))
    return F.when(F.size(a) > 0, lo + (h - F.floor(h)) * (hi - lo))


def _avg_median_of_counts(df: DataFrame, key: str, cols: list[str], decimals: int | None) -> DataFrame:
    """One scan: the sub-scores are unpivoted and reduced to value counts (a job) that averages and medians both come from."""
    # a constant beside the sub-scores keeps the keys whose sub-scores are all missing
    long = df.withColumn("_key", F.lit(0.0)).unpivot(key, [*cols, "_key"], "_col", "_val")
    counts = value_counts(long, "_val", [key, "_col"])
    avg = counts.groupBy(key, "_col").agg(count_mean(decimals)[1].alias("_avg"))
    med = quantiles_of_counts(counts, [0.5], [key, "_col"], ["_med"])
    both = avg.join(med, [key, "_col"])
    return both.groupBy(key).agg(
        *[F.max(F.when(F.col("_col") == c, F.col("_avg"))).alias(f"{c}_avg") for c in cols],
        *[F.max(F.when(F.col("_col") == c, rnd("_med"))).alias(f"{c}_med") for c in cols],
    )


def global_stats(df: DataFrame, value: str = "score") -> DataFrame:
    """Global mean and sample standard deviation."""
    return nan_as_null(df, [value]).agg(rnd(F.avg(value)).alias("mean"), rnd(F.stddev_samp(value)).alias("std"), F.count(value).alias("n"))


MAX_PIVOT = 10_000


def pivot_wide(df: DataFrame, row: str, col: str, value: str, values: list | None = None) -> DataFrame:
    """Long -> wide matrix (D11: de-duplicate before).

    The columns are the values found in the data, sorted; more than
    ``MAX_PIVOT`` of them is an error, as is a value outside of ``values``.
    """
    found = df.select(col).where(F.col(col).isNotNull()).distinct().limit(MAX_PIVOT + 1).collect()
    found = sorted(r[0] for r in found)
    if len(found) > MAX_PIVOT:
        raise ValueError(f"{col} has more than {MAX_PIVOT} values: too many columns")
    if values is not None and set(found) - set(values):
        raise ValueError(f"{col} has values without a column: {sorted(set(found) - set(values))[:5]}")
    return df.groupBy(row).pivot(col, found if values is None else values).agg(F.first(value))


def best_per_key(df: DataFrame, key: str, item: str, score: str) -> DataFrame:
    """Arg-max item per key; ties by the smaller item id."""
    return df.groupBy(key).agg(
        F.max_by(F.col(item), F.struct(F.col(score), -F.col(item))).alias(item),
        F.max(score).alias(score),
    )


def best_worst(df: DataFrame, by: str, n: int = 10, ties: list[str] | None = None) -> DataFrame:
    """T5: the n rows with the lowest and the n with the highest ``by``, tagged.

    Two TakeOrderedAndProject top-n's; ``ties`` break equal values (ascending).
    """
    tb = [F.asc(c) for c in ties or []]
    best = df.orderBy(F.asc(by), *tb).limit(n).withColumn("tag", F.lit("best"))
    worst = df.orderBy(F.desc(by), *tb).limit(n).withColumn("tag", F.lit("worst"))
    return best.unionByName(worst)


def slots(spark: SparkSession) -> int:
    """Tasks that run side by side."""
    try:
        return spark.sparkContext.defaultParallelism
    except Exception:  # sessions without a local context (Spark Connect)
        return int(spark.conf.get("spark.sql.shuffle.partitions"))


def row_positions(df: DataFrame, order: list[str], name: str = "pos") -> DataFrame:
    """0-based position of every row in the order of ``order`` (any orderable columns).

    No global window: rows are range-partitioned and sorted, a row's position
    inside its partition comes from ``monotonically_increasing_id``, and
    partition offsets are a prefix sum over one row per partition. The sorted
    rows are written to the shared folder once, since the partition of a row
    must not change between the two uses.
    """
    part = df.repartitionByRange(*order).sortWithinPartitions(*order)
    part = part.withColumn("_p", F.spark_partition_id()).withColumn("_i", F.monotonically_increasing_id() - F.shiftleft(F.col("_p").cast("long"), 33))
    part = materialize(part, "positions")
    sizes = part.groupBy("_p").agg(F.count(F.lit(1)).alias("_s"))
    w = Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)
    offs = sizes.select("_p", F.coalesce(F.sum("_s").over(w), F.lit(0)).alias("_o"))
    # one row per partition: bounded by the partition count
    return part.join(F.broadcast(offs), "_p").withColumn(name, F.col("_o") + F.col("_i")).drop("_p", "_o", "_i")


def positions_per_key(df: DataFrame, key: str, order: list[str], name: str = "pos") -> DataFrame:
    """0-based position of every row among the rows of its key, in the order of ``order``.

    A key's rows lie together in the global order, so its position there minus
    the key's first one is enough: a key with a large share of the rows is
    sorted over many tasks.
    """
    placed = row_positions(df, [key, *order], name)
    first = placed.groupBy(key).agg(F.min(name).alias("_first"))
    return placed.join(first, key).withColumn(name, F.col(name) - F.col("_first")).drop("_first")


def dense_ids(df: DataFrame, col: str, name: str = "id") -> DataFrame:
    """Dense 0-based id per distinct value in sorted order (pandas ``ngroup``).

    See ``row_positions``: no global window.
    """
    vals = df.select(col).where(F.col(col).isNotNull()).distinct()
    return row_positions(vals, [col], name).select(col, name)
