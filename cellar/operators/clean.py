"""Projections, filters and predicates over ratings, items and review texts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.functions.exprs import nan_to_null

# Fixed value: the placeholder the source data uses for an empty review text
# (two no-break spaces).
PLACEHOLDER_TEXT = "\u00a0\u00a0"


def cap_filter(df: DataFrame, col: str = "score", cap: float = 5.0) -> DataFrame:
    """Drop scores above ``cap``; a missing score (NULL or NaN) is kept (D3)."""
    v = nan_to_null(F.col(col))
    return df.withColumn(col, v).where(F.coalesce(~(v > F.lit(cap)), F.lit(True)))


def drop_incomplete(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Drop rows with any NULL (NaN counts as missing, as in pandas)."""
    cols = cols or df.columns
    dbl = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}
    out = df.select(*[nan_to_null(F.col(c)).alias(c) if c in dbl else F.col(c) for c in df.columns])
    return out.dropna("any", subset=cols)


def drop_placeholder(df: DataFrame, col: str = "text", placeholder: str = PLACEHOLDER_TEXT) -> DataFrame:
    """Drop texts that are exactly the placeholder (NULL text is kept for dropna)."""
    return df.where(F.coalesce(F.col(col) != F.lit(placeholder), F.lit(True)))


def contains(df: DataFrame, col: str, needle: str, regex: bool = False) -> DataFrame:
    """Substring or regex predicate; NULL -> false."""
    c = F.col(col).rlike(needle) if regex else F.col(col).contains(needle)
    return df.where(F.coalesce(c, F.lit(False)))


def in_set(df: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    """P5: rows whose key is in another result (left semi join)."""
    return df.join(keys.select(on), on, "left_semi")


def first_by(df: DataFrame, key: str, order: str, cols: list[str]) -> DataFrame:
    """One row per key, the one with the smallest ``order``."""
    s = F.struct(F.col(order), *[F.col(c) for c in cols])
    return df.groupBy(key).agg(F.min(s).alias("_s")).select(key, "_s.*")


def distinct_sorted(df: DataFrame, col: str) -> DataFrame:
    """Distinct non-null values, sorted."""
    return df.select(col).where(F.col(col).isNotNull()).distinct().orderBy(col)


def users_min_overlap(ratings: DataFrame, target: int, min_overlap: int = 1) -> DataFrame:
    """Users with at least ``min_overlap`` ratings on the target's items.

    The target's items arrive through a semi join; its size is checked at run
    time by AQE (a user may have rated a third of all items).
    """
    mine = ratings.where(F.col("uid") == F.lit(target)).select("item_id")
    shared = ratings.join(mine, "item_id", "left_semi")
    return (
        shared.groupBy("uid")
        .agg(F.count(F.lit(1)).alias("n_common"))
        .where(F.col("n_common") >= min_overlap)
    )
