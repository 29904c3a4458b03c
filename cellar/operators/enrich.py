"""Joins and ordered text aggregation that build enriched item rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.functions.exprs import nan_as_null, rnd, small_side
from cellar.operators.clean import cap_filter, drop_incomplete, drop_placeholder
from cellar.operators.stats import positions_per_key, top_n_by_count


def top_n_ratings(ratings: DataFrame, n: int) -> DataFrame:
    """The ratings of the n most-rated items.

    The top-n side holds exactly n rows, so it is broadcast unless n is large;
    the ratings side is then never shuffled for the join.
    """
    top = top_n_by_count(ratings, "item_id", n).select("item_id")
    return ratings.join(small_side(top, n), "item_id")


# Rows per text chunk: a key's texts are joined in chunks of consecutive rows,
# so no single value (or task) has to hold all the texts of a key that has a
# large share of all rows.
CHUNK_ROWS = 1000


def text_concat(reviews: DataFrame, key: str = "item_id", text: str = "text", order: list[str] | None = None, sep: str = ",", chunk: int = CHUNK_ROWS) -> DataFrame:
    """(key, part, text): the texts of a key joined by ``sep`` in order (D8); NULL texts are skipped.

    ``order`` may be any orderable columns (e.g. date, username); equal rows are
    ordered by their text. ``part`` is a row's position among its key's rows
    over ``chunk``, so a part holds ``chunk`` texts at most, however the order
    values are spread. The whole text of a key is its parts joined in ``part``
    order. Runs a job to find the positions.
    """
    order = [c for c in order or ["ord"] if c != text]
    rows = reviews.where(F.col(text).isNotNull()).select(key, *order, text)
    placed = positions_per_key(rows, key, [*order, text], "_pos")
    parts = placed.groupBy(key, F.floor(F.col("_pos") / chunk).cast("long").alias("part"))
    return parts.agg(F.expr(f"listagg({text}, '{sep}') WITHIN GROUP (ORDER BY _pos)").alias(text))


def text_and_mean(reviews: DataFrame, key: str = "item_id", order: list[str] | None = None, chunk: int = CHUNK_ROWS, sep: str = ",") -> DataFrame:
    """J2 + A6 + A8 (D4): one row per key: (key, score, text).

    The mean covers every row of the key; the text covers the rows whose text
    is not the placeholder; a key with only placeholder text has no row (inner
    join of the two results, as in the source). Texts are joined part by part
    first; where a key's whole text is too large for one value, use
    ``text_concat`` beside ``item_means``.
    """
    parts = text_concat(drop_placeholder(reviews), key, "text", order, sep, chunk)
    whole = parts.groupBy(key).agg(F.expr(f"listagg(text, '{sep}') WITHIN GROUP (ORDER BY part)").alias("text"))
    return item_means(reviews, key).join(whole, key)


def item_means(reviews: DataFrame, key: str = "item_id") -> DataFrame:
    """Mean score of every row of a key, before any text is filtered."""
    return nan_as_null(reviews, ["score"]).groupBy(key).agg(rnd(F.avg("score")).alias("score"))


def enrich_items(item_scores: DataFrame, items: DataFrame, producers: DataFrame) -> DataFrame:
    """Left joins with item and producer attributes; producer name renamed, ids dropped."""
    return (
        item_scores.join(items, "item_id", "left")
        .join(producers, "producer_id", "left")
        .drop("producer_id")
    )


def top_producers_named(items: DataFrame, producers: DataFrame, n: int = 10) -> DataFrame:
    """Producers with most items, decorated with their name (n rows broadcast)."""
    top = top_n_by_count(items, "producer_id", n, "n_items")
    return producers.join(small_side(top, n), "producer_id").select("producer_id", "producer_name", "n_items")


def top_ratings(reviews: DataFrame, n: int = 1000, cap: float = 5.0) -> DataFrame:
    """The ingest job: the complete ratings, none above ``cap``, of the n most-reviewed items.

    In this order: count the reviews of each item (all of them), keep the n
    items with most, join, keep (item_id, username, text, score), drop rows with
    a missing cell, drop scores above ``cap``.
    """
    kept = top_n_ratings(reviews, n).select("item_id", "username", "text", "score")
    return cap_filter(drop_incomplete(kept), "score", cap)


def merge_items(ratings: DataFrame, items: DataFrame, producers: DataFrame, order: list[str] | None = None, chunk: int = CHUNK_ROWS) -> tuple[DataFrame, DataFrame]:
    """The enrichment job: (one row per item with mean and attributes, texts in parts).

    Means cover all ratings, texts those without the placeholder; an item with
    only placeholder text is left out of both (D4). Producer names are renamed,
    ids dropped. The texts are a table of their own, (item_id, part, text), so
    an item with a large share of the reviews is no single value.
    """
    texts = text_concat(drop_placeholder(ratings), "item_id", "text", order or ["username"], chunk=chunk)
    sizes = texts.groupBy("item_id").agg(F.count(F.lit(1)).alias("n_parts"))
    merged = enrich_items(item_means(ratings).join(sizes, "item_id"), items, producers)
    return merged, texts
