"""Queries over ratings, items and producers: filters, joins, aggregates, orderings."""

from __future__ import annotations

from pyspark.sql import functions as F

from cellar.functions.exprs import rnd
from cellar.operators import clean, enrich, stats
from cellar.plans.registry import query, sql
from cellar.session import scratch_path
from cellar.sources import files
from cellar.sources.tables import Tables

TOP_N = 100  # n of the most-rated-items filter at the test scale


@query("top_n_items", sql(f"""
, c AS (SELECT item_id, count(*) AS n_ratings FROM ratings GROUP BY item_id
        ORDER BY n_ratings DESC, item_id LIMIT {TOP_N})
SELECT c.item_id, c.n_ratings, p.p_name AS name FROM c JOIN part p ON p.p_partkey = c.item_id
"""))
def top_n_items(t: Tables):
    """A1 + T1 + J5: the n most-rated items with their names (n rows broadcast)."""
    top = stats.top_n_by_count(t.ratings(), "item_id", TOP_N, "n_ratings")
    names = t.part.select(F.col("p_partkey").alias("item_id"), F.col("p_name").alias("name"))
    return names.join(F.broadcast(top), "item_id").select("item_id", "n_ratings", "name")


@query("top_n_ratings", sql(f"""
, c AS (SELECT item_id FROM ratings GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT {TOP_N})
SELECT r.uid, r.item_id, r.score FROM ratings r JOIN c ON c.item_id = r.item_id
"""))
def top_n_ratings(t: Tables):
    return enrich.top_n_ratings(t.ratings(), TOP_N).select("uid", "item_id", "score")


@query("value_counts_top10", sql("""
SELECT p.state, count(*) AS count FROM items i JOIN producers p ON p.producer_id = i.producer_id
WHERE p.state IS NOT NULL GROUP BY p.state ORDER BY count DESC, p.state LIMIT 10
"""))
def value_counts_top10(t: Tables):
    """A2: items per producer state, top 10."""
    ip = t.items().join(t.producers(), "producer_id")
    return stats.value_counts_top(ip, "state", 10)


@query("distinct_counts", sql("""
SELECT count(*) AS n_ratings, count(DISTINCT uid) AS n_users, count(DISTINCT item_id) AS n_items FROM ratings
"""))
def distinct_counts(t: Tables):
    return stats.distinct_counts(t.ratings())


@query("matrix_density", sql("""
SELECT count(*) AS n_ratings, count(DISTINCT uid) AS n_users, count(DISTINCT item_id) AS n_items,
       round(count(*) / (count(DISTINCT uid)::DOUBLE * count(DISTINCT item_id)), 6) AS density
FROM ratings
"""))
def matrix_density(t: Tables):
    return stats.matrix_density(t.ratings())


def M(c: str) -> str:  # noqa: N802
    """Oracle twin of ``mean(c, decimals=2)``: exact decimal mean, half-up at 6 places."""
    return f"CAST(round(CAST(avg(CAST({c} AS DECIMAL(18,2))) AS DECIMAL(38,10)), 6) AS DOUBLE)"


# rows with missing cells (NULL and NaN) united with the line items, so that both kinds of missing are tested
_NAN = float("nan")
_DIRTY_LINES = [(1, _NAN, None, _NAN, 0.05), (1, None, 100.0, None, _NAN), (2, 3.0, _NAN, 0.5, None), (-1, _NAN, _NAN, None, _NAN)]


def _sql_num(v) -> str:
    return "NULL::DOUBLE" if v is None else "'NaN'::DOUBLE" if v != v else f"{v}::DOUBLE"


_NUMS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_LINES = ("li0 AS (SELECT l_partkey, l_quantity, l_extendedprice, l_discount, l_tax FROM lineitem UNION ALL SELECT * FROM (VALUES "
          + ", ".join(f"({r[0]}, {', '.join(map(_sql_num, r[1:]))})" for r in _DIRTY_LINES) + ")),\n"
          + "li AS (SELECT l_partkey, " + ", ".join(f"CASE WHEN NOT isnan({c}) THEN {c} END AS {c}" for c in _NUMS) + " FROM li0)")


def _dirty_lines(t: Tables):
    extra = t.spark.createDataFrame(_DIRTY_LINES, "l_partkey long, l_quantity double, l_extendedprice double, l_discount double, l_tax double")
    return t.lineitem.select("l_partkey", *_NUMS).unionByName(extra)


_DIRTY_SCORES = [(-1, 1, _NAN), (-1, 2, None), (7, -5, _NAN), (7, -6, 4.0)]
_SCORES = ("dr AS (SELECT uid, item_id, CASE WHEN NOT isnan(score) THEN score END AS score FROM (SELECT uid, item_id, score FROM ratings UNION ALL SELECT * FROM (VALUES "
           + ", ".join(f"({a}, {b}, {_sql_num(c)})" for a, b, c in _DIRTY_SCORES) + ")))")


def _dirty_scores(t: Tables):
    return t.ratings().select("uid", "item_id", "score").unionByName(t.spark.createDataFrame(_DIRTY_SCORES, "uid long, item_id long, score double"))


@query("item_mean_scores", sql(f"""
, {_LINES}
SELECT l_partkey AS item_id, {M("l_quantity")} AS l_quantity_mean,
       {M("l_extendedprice")} AS l_extendedprice_mean,
       {M("l_discount")} AS l_discount_mean, {M("l_tax")} AS l_tax_mean
FROM li GROUP BY l_partkey
"""))
def item_mean_scores(t: Tables):
    """Mean of every numeric sub-score per item."""
    li = _dirty_lines(t).withColumnRenamed("l_partkey", "item_id")
    return stats.mean_per_key(li, "item_id", ["l_quantity", "l_extendedprice", "l_discount", "l_tax"], decimals=2)


@query("category_means_sorted", sql(f"""
, {_SCORES}
SELECT i.style, round(avg(r.score), 6) AS mean FROM dr r JOIN items i ON i.item_id = r.item_id
GROUP BY i.style
"""))
def category_means_sorted(t: Tables):
    """Mean rating per style, ordered by the mean."""
    r = _dirty_scores(t).join(t.items().select("item_id", "style"), "item_id")
    return stats.means_sorted(r, "style", "score")


@query("null_counts", sql("""
SELECT 'item_id' AS "column", CAST(count_if(item_id IS NULL) AS BIGINT) AS n_null FROM doc_reviews
UNION ALL SELECT 'ord', CAST(count_if(ord IS NULL) AS BIGINT) FROM doc_reviews
UNION ALL SELECT 'text', CAST(count_if(text IS NULL) AS BIGINT) FROM doc_reviews
UNION ALL SELECT 'score', CAST(count_if(score IS NULL) + 1 AS BIGINT) FROM doc_reviews
"""))
def null_counts(t: Tables):
    """A9 over the long reviews, whose scores come from a partial left join, and one row whose score is NaN."""
    extra = t.spark.createDataFrame([("zz/nan", -1, "x", _NAN)], "item_id string, ord long, text string, score double")
    return stats.null_counts(t.doc_reviews().unionByName(extra), ["item_id", "ord", "text", "score"])


_DESCRIBE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


@query("numeric_describe", sql(f", {_LINES}\n" + "\n UNION ALL ".join(f"""
SELECT '{c}' AS "column", count({c}) AS count, {M(c)} AS mean, round(stddev_samp({c}), 6) AS std,
       min({c}) AS min, round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS q50,
       round(quantile_cont({c}, 0.75), 6) AS q75, max({c}) AS max FROM li""" for c in _DESCRIBE_COLS)))
def numeric_describe(t: Tables):
    return stats.numeric_describe(_dirty_lines(t), _DESCRIBE_COLS, decimals=2)


@query("ratings_per_user_stats", sql(f"""
, {_SCORES}, c AS (SELECT uid, count(*) AS n FROM dr WHERE score > 0 GROUP BY uid)
SELECT count(*) AS n_keys, min(n) AS min_n, max(n) AS max_n, round(avg(n), 6) AS mean_n FROM c
"""))
def ratings_per_user_stats(t: Tables):
    return stats.per_key_count_stats(_dirty_scores(t), "uid")


@query("ratings_per_item_stats", sql(f"""
, {_SCORES}, c AS (SELECT item_id, count(*) AS n FROM dr WHERE score > 0 GROUP BY item_id)
SELECT count(*) AS n_keys, min(n) AS min_n, max(n) AS max_n, round(avg(n), 6) AS mean_n FROM c
"""))
def ratings_per_item_stats(t: Tables):
    return stats.per_key_count_stats(_dirty_scores(t), "item_id")


@query("score_histogram", sql(f"""
, {_LINES}, b AS (SELECT min(l_extendedprice) AS lo, max(l_extendedprice) AS hi FROM li),
h AS (SELECT CAST(CASE WHEN b.hi = b.lo THEN 0 ELSE least(floor((li.l_extendedprice - b.lo) / ((b.hi - b.lo) / 10)), 9) END AS INTEGER) AS bin
      FROM li, b WHERE li.l_extendedprice IS NOT NULL),
c AS (SELECT bin, count(*) AS n FROM h GROUP BY bin)
SELECT CAST(r.i AS INTEGER) AS bin, round(b.lo + r.i * ((b.hi - b.lo) / 10), 6) AS lower,
       round(b.lo + (r.i + 1) * ((b.hi - b.lo) / 10), 6) AS upper, coalesce(c.n, 0) AS count
FROM range(10) r(i) CROSS JOIN b LEFT JOIN c ON c.bin = r.i
"""))
def score_histogram(t: Tables):
    """10-bin histogram of the line price, empty bins included."""
    return stats.histogram(_dirty_lines(t), "l_extendedprice", 10)


@query("global_score_stats", sql(f"""
, {_SCORES}
SELECT round(avg(score), 6) AS mean, round(stddev_samp(score), 6) AS std, count(score) AS n FROM dr
"""))
def global_score_stats(t: Tables):
    return stats.global_stats(_dirty_scores(t))


_EVENT_TYPES = ["click", "error", "purchase", "signup", "view"]


@query("user_item_pivot", sql("""
SELECT uid,
""" + ",\n".join(f"  round(max(CASE WHEN item = '{e}' THEN score END), 6) AS {e}" for e in _EVENT_TYPES) + """
FROM user_type GROUP BY uid
"""))
def user_item_pivot(t: Tables):
    """Users x event types, a column for every type in the data."""
    ut = t.user_type().withColumn("score", rnd("score"))
    return stats.pivot_wide(ut, "uid", "item", "score")


@query("dense_user_ids", sql("""
SELECT c_name AS name, CAST(dense_rank() OVER (ORDER BY c_name) - 1 AS BIGINT) AS uid
FROM (SELECT DISTINCT c_name FROM customer)
"""))
def dense_user_ids(t: Tables):
    """0-based ids of customer names in sorted order, no global window."""
    return stats.dense_ids(t.customer.select(F.col("c_name").alias("name")), "name", "uid")


# ---- filters and look-ups ---------------------------------------------------


@query("filter_country_active", sql("""
SELECT i.item_id, i.name, p.producer_name, p.country FROM items i JOIN producers p ON p.producer_id = i.producer_id
WHERE p.country = 'EUROPE'
"""))
def filter_country_active(t: Tables):
    """Items whose producer is in one country (equality filter)."""
    ip = t.items().join(t.producers(), "producer_id")
    return ip.where(F.col("country") == "EUROPE").select("item_id", "name", "producer_name", "country")


@query("item_lookup", sql("""
, req AS (SELECT a.p_name AS name, b.p_brand AS brand FROM part a JOIN part b ON b.p_partkey = a.p_partkey + 1),
m AS (SELECT name, brand, count(*) AS n, min(item_id) AS item_id FROM items GROUP BY name, brand)
SELECT DISTINCT req.name, req.brand, coalesce(m.n, 0) AS n_matches,
       CASE WHEN m.n = 1 THEN m.item_id END AS item_id,
       CASE WHEN m.n IS NULL THEN 'none' WHEN m.n = 1 THEN 'ok' ELSE 'ambiguous' END AS status
FROM req LEFT JOIN m ON m.name = req.name AND m.brand = req.brand
"""))
def item_lookup(t: Tables):
    """M19 + P4: look up (name, brand) requests with a none / ok / ambiguous status.

    Requests pair each part's name with the next part's brand, so every outcome
    occurs; matching is one equi-join against per-(name, brand) counts.
    """
    from cellar.operators.neighbours import lookup_items

    p = t.part
    a = p.select(F.col("p_partkey").alias("k"), F.col("p_name").alias("name"))
    b = p.select((F.col("p_partkey") - 1).alias("k"), F.col("p_brand").alias("brand"))
    req = a.join(b, "k").select("name", "brand").distinct()
    return lookup_items(req, t.items(), ["name", "brand"])


@query("items_in_top_set", sql(f"""
, c AS (SELECT item_id FROM ratings GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT {TOP_N})
SELECT item_id, name, style FROM items WHERE item_id IN (SELECT item_id FROM c)
"""))
def items_in_top_set(t: Tables):
    """P5: items that belong to the top-n set (left semi join)."""
    top = stats.top_n_by_count(t.ratings(), "item_id", TOP_N)
    return clean.in_set(t.items(), F.broadcast(top), "item_id").select("item_id", "name", "style")


@query("name_contains", sql("""
SELECT item_id, name FROM items WHERE coalesce(contains(name, 'ring'), false)
"""))
def name_contains(t: Tables):
    return clean.contains(t.items(), "name", "ring").select("item_id", "name")


@query("first_match_by_name", sql("""
SELECT name, min(item_id) AS item_id, arg_min(brand, item_id) AS brand FROM items GROUP BY name
"""))
def first_match_by_name(t: Tables):
    """One item per name, the smallest id."""
    return clean.first_by(t.items(), "name", "item_id", ["brand"]).select("name", "item_id", "brand")


@query("distinct_values_sorted", sql("SELECT DISTINCT style FROM items WHERE style IS NOT NULL ORDER BY style"))
def distinct_values_sorted(t: Tables):
    return clean.distinct_sorted(t.items(), "style")


@query("items_of_producer", sql("""
SELECT DISTINCT name FROM items WHERE producer_id = 1
"""))
def items_of_producer(t: Tables):
    """The distinct item names of one producer."""
    return t.items().where(F.col("producer_id") == 1).select("name").distinct()


# ---- cleaning with hand-made dirty rows added to the real tables ------------------

_DIRTY = [(-1, -1, 7.0), (-2, -2, None), (-3, -3, float("nan")), (-4, -4, 5.0), (None, -5, 3.0), (-6, None, 2.0)]
_DIRTY_SQL = ("SELECT * FROM (VALUES (-1, -1, 7.0::DOUBLE), (-2, -2, NULL), (-3, -3, 'NaN'::DOUBLE), "
              "(-4, -4, 5.0), (NULL, -5, 3.0), (-6, NULL, 2.0)) v(uid, item_id, score)")


def _dirty_ratings(t: Tables):
    spark = t.spark
    extra = spark.createDataFrame(_DIRTY, "uid long, item_id long, score double")
    return t.ratings_raw().select("uid", "item_id", "score").unionByName(extra)


@query("ratings_cap_filter", sql(f"""
, r AS (SELECT uid, item_id, score FROM ratings_raw UNION ALL {_DIRTY_SQL}),
n AS (SELECT uid, item_id, CASE WHEN isnan(score) THEN NULL ELSE score END AS score FROM r)
SELECT * FROM n WHERE score IS NULL OR NOT (score > 5)
"""))
def ratings_cap_filter(t: Tables):
    """Scores above 5 removed, missing scores kept (D3)."""
    return clean.cap_filter(_dirty_ratings(t), "score", 5.0)


@query("ratings_clean", sql(f"""
, r AS (SELECT uid, item_id, score FROM ratings_raw UNION ALL {_DIRTY_SQL})
SELECT * FROM r WHERE uid IS NOT NULL AND item_id IS NOT NULL AND score IS NOT NULL AND NOT isnan(score)
"""))
def ratings_clean(t: Tables):
    """Rows with a missing cell removed (NaN is missing)."""
    return clean.drop_incomplete(_dirty_ratings(t))


_NBSP2 = clean.PLACEHOLDER_TEXT


def _dirty_docs(t: Tables):
    extra = t.spark.createDataFrame(
        [("zz/only", -1, _NBSP2, 4.0), ("zz/mixed", -2, _NBSP2, 1.0), ("zz/mixed", -3, "real words", 3.0)],
        "item_id string, ord long, text string, score double",
    )
    return t.doc_reviews().unionByName(extra)


_DIRTY_DOCS_SQL = ("SELECT * FROM (VALUES ('zz/only', -1, chr(160) || chr(160), 4.0::DOUBLE), "
                   "('zz/mixed', -2, chr(160) || chr(160), 1.0), ('zz/mixed', -3, 'real words', 3.0)) "
                   "v(item_id, ord, text, score)")


@query("drop_placeholder_text", sql(f"""
, d AS (SELECT item_id, ord, text, score FROM doc_reviews UNION ALL {_DIRTY_DOCS_SQL})
SELECT item_id, ord, score, length(text) AS n_chars FROM d WHERE text IS NULL OR text <> chr(160) || chr(160)
"""))
def drop_placeholder_text(t: Tables):
    """Rows whose text is exactly the placeholder are dropped."""
    d = clean.drop_placeholder(_dirty_docs(t))
    return d.select("item_id", "ord", "score", F.length("text").cast("long").alias("n_chars"))


@query("item_text_and_mean", sql(f"""
, d AS (SELECT item_id, ord, text, score FROM doc_reviews UNION ALL {_DIRTY_DOCS_SQL}),
m AS (SELECT item_id, round(avg(score), 6) AS score FROM d GROUP BY item_id),
x AS (SELECT item_id, string_agg(text, ',' ORDER BY ord, text) AS text FROM d WHERE text <> chr(160) || chr(160) GROUP BY item_id)
SELECT m.item_id, m.score, md5(x.text) AS text_md5, CAST(length(x.text) AS BIGINT) AS text_len
FROM m JOIN x ON x.item_id = m.item_id
"""))
def item_text_and_mean(t: Tables):
    """One row per item: mean over all rows, text over real texts, inner semantics."""
    r = enrich.text_and_mean(_dirty_docs(t))
    return r.select("item_id", "score", F.md5("text").alias("text_md5"), F.length("text").cast("long").alias("text_len"))


@query("item_text_concat", sql("""
, p AS (SELECT item_id, text, row_number() OVER (PARTITION BY item_id ORDER BY username, ord, text) - 1 AS pos FROM reviews WHERE text IS NOT NULL)
SELECT item_id, CAST(pos // 4 AS BIGINT) AS part, string_agg(text, ',' ORDER BY pos) AS text FROM p GROUP BY item_id, part
"""))
def item_text_concat(t: Tables):
    """The review texts of an item joined by ',' by username and turn, four to a part."""
    return enrich.text_concat(t.reviews(), order=["username", "ord"], chunk=4)


_JOB_REVIEWS = """
, r0 AS (SELECT item_id, ord, CASE WHEN ord % 11 = 3 THEN NULL ELSE username END AS username, text,
         CASE WHEN (item_id + ord) % 13 = 0 THEN NULL WHEN (item_id + ord) % 7 = 0 THEN 7.5::DOUBLE ELSE (item_id * 31 + ord) % 6 END::DOUBLE AS score FROM reviews),
c AS (SELECT item_id FROM r0 GROUP BY item_id ORDER BY count(*) DESC, item_id LIMIT 50),
top AS (SELECT r0.item_id, username, CASE WHEN ord % 5 = 1 THEN chr(160) || chr(160) ELSE text END AS text, score FROM r0 JOIN c ON c.item_id = r0.item_id
        WHERE username IS NOT NULL AND text IS NOT NULL AND score IS NOT NULL AND score <= 5)
"""


def _job_reviews(t: Tables):
    """Reviews as the ingest job gets them: with missing names and scores, scores above the scale, placeholder texts."""
    k = F.col("item_id") + F.col("ord")
    score = F.when(k % 13 == 0, F.lit(None)).when(k % 7 == 0, F.lit(7.5)).otherwise(((F.col("item_id") * 31 + F.col("ord")) % 6).cast("double"))
    return t.reviews().select(
        "item_id",
        F.when(F.col("ord") % 11 != 3, F.col("username")).alias("username"),
        F.when(F.col("ord") % 5 == 1, F.when(F.col("text").isNotNull(), F.lit(_NBSP2))).otherwise(F.col("text")).alias("text"),
        score.alias("score"),
    )


def _job_files(t: Tables):
    """The reviews written as a CSV file set, and the ingest job's result from there as parquet."""
    raw, out = scratch_path(t.spark, "job-reviews"), scratch_path(t.spark, "job-top-ratings")
    reviews = _job_reviews(t)
    files.write_csv(reviews, raw)
    files.write_parquet(enrich.top_ratings(files.read_csv_typed(t.spark, raw, reviews.schema), 50), out)
    return t.spark.read.parquet(out)


@query("pipeline_top_ratings", sql(_JOB_REVIEWS + "SELECT item_id, username, text, score FROM top"))
def pipeline_top_ratings(t: Tables):
    """The ingest job from CSV to parquet (A1 + T1 + J1 + P8 + P7)."""
    return _job_files(t)


@query("pipeline_enriched_items", sql(_JOB_REVIEWS + """
, m AS (SELECT item_id, round(avg(score), 6) AS score FROM top GROUP BY item_id),
x AS (SELECT item_id, string_agg(text, ',' ORDER BY username, text) AS text FROM top WHERE text <> chr(160) || chr(160) GROUP BY item_id)
SELECT m.item_id, m.score, i.name, i.brand, i.style, i.abv, i.price, p.producer_name, p.state, p.country, md5(x.text) AS text_md5
FROM m JOIN x ON x.item_id = m.item_id LEFT JOIN items i ON i.item_id = m.item_id LEFT JOIN producers p ON p.producer_id = i.producer_id
"""))
def pipeline_enriched_items(t: Tables):
    """The enrichment job after the ingest job (A6 + P9 + A8 + J2-J4); the texts' parts are joined here to compare them."""
    merged, texts = enrich.merge_items(_job_files(t), t.items(), t.producers(), chunk=3)
    whole = texts.groupBy("item_id").agg(F.expr("listagg(text, ',') WITHIN GROUP (ORDER BY part)").alias("text"))
    return merged.drop("n_parts").join(whole.select("item_id", F.md5("text").alias("text_md5")), "item_id")


@query("enriched_items", sql("""
, s AS (SELECT item_id, round(avg(score), 6) AS score FROM ratings GROUP BY item_id)
SELECT s.item_id, s.score, i.name, i.brand, i.style, i.abv, i.price, p.producer_name, p.state, p.country
FROM s LEFT JOIN items i ON i.item_id = s.item_id LEFT JOIN producers p ON p.producer_id = i.producer_id
"""))
def enriched_items(t: Tables):
    """Mean score per item with item and producer attributes."""
    s = t.ratings().groupBy("item_id").agg(rnd(F.avg("score")).alias("score"))
    return enrich.enrich_items(s, t.items(), t.producers())


@query("top_producers_named", sql("""
, c AS (SELECT producer_id, count(*) AS n_items FROM items WHERE producer_id IS NOT NULL
        GROUP BY producer_id ORDER BY n_items DESC, producer_id LIMIT 10)
SELECT c.producer_id, p.producer_name, c.n_items FROM c JOIN producers p ON p.producer_id = c.producer_id
"""))
def top_producers_named(t: Tables):
    return enrich.top_producers_named(t.items(), t.producers(), 10)


@query("subscore_avg_median", sql(f"""
, {_LINES}
SELECT l_partkey AS item_id,
""" + ",\n".join(f"  {M(c)} AS {c}_avg, round(median({c}), 6) AS {c}_med" for c in ["l_quantity", "l_discount", "l_tax"]) + """
FROM li GROUP BY l_partkey
"""))
def subscore_avg_median(t: Tables):
    """Average and exact median of sub-scores per item."""
    li = _dirty_lines(t).withColumnRenamed("l_partkey", "item_id")
    return stats.avg_median(li, "item_id", ["l_quantity", "l_discount", "l_tax"], decimals=2)


@query("users_min_overlap", sql("""
, mine AS (SELECT item_id FROM ratings WHERE uid = 7)
SELECT uid, count(*) AS n_common FROM ratings WHERE item_id IN (SELECT item_id FROM mine)
GROUP BY uid HAVING count(*) >= 3
"""))
def users_min_overlap(t: Tables):
    """Users sharing at least 3 rated items with user 7."""
    return clean.users_min_overlap(t.ratings(), 7, 3)
