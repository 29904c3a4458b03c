"""Queries over raw web pages: cards, links, score fractions, incremental append."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from cellar.operators import pages
from cellar.plans.registry import ORACLE, query, sql
from cellar.session import scratch_path
from cellar.sources.tables import Tables
from cellar.streaming.pages import read_sink, run_incremental

EXCLUDE_LINK = r"[.,]$"  # links ending in punctuation are not item links
RESUME_AT = "/the"

_LINKS = """
, l AS (SELECT page_id, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS ls FROM pages),
links AS (SELECT page_id, CAST(generate_subscripts(ls, 1) - 1 AS BIGINT) AS pos, unnest(ls) AS link FROM l)
"""


def _nz(e):
    return f"nullif({e}, '')"


@query("page_cards", sql(f"""
SELECT page_id, url,
  {_nz("regexp_extract(url, '^[a-z]+://([^/?#]+)', 1)")} AS host,
  {_nz("regexp_extract(url, '^[a-z]+://[^/]+/([^/?#]+)/', 1)")} AS section,
  {_nz("regexp_extract(html, '<title>([^<]*)</title>', 1)")} AS title,
  {_nz("regexp_extract(html, '<h1>([^<]*)</h1>', 1)")} AS heading,
  {_nz("regexp_extract(html, '<html lang=\"([^\"]*)\"', 1)")} AS lang,
  {_nz("regexp_extract(html, '<p><b>([^<]*)', 1)")} AS lead,
  {_nz("regexp_extract(html, '<div class=\"ad\">([^<]*)</div>', 1)")} AS ad_text,
  {_nz("regexp_extract(html, '<footer>([^<]*)</footer>', 1)")} AS footer,
  TRY_CAST({_nz("regexp_extract(url, '/([0-9]+)(\\?|$)', 1)")} AS BIGINT) AS path_no,
  TRY_CAST({_nz("regexp_extract(url, '[?&]page=([0-9]+)', 1)")} AS BIGINT) AS page_no,
  CAST(len(regexp_extract_all(html, '<a href=')) AS BIGINT) AS n_links,
  CAST(len(regexp_extract_all(html, '<p>')) AS BIGINT) AS n_paragraphs,
  CAST(length(html) AS BIGINT) AS n_chars
FROM pages
"""))
def page_cards(t: Tables):
    """X1 + X4: item card per page, missing elements as NULL."""
    return pages.page_cards(t.pages)


@query("page_links", sql(_LINKS + f"SELECT * FROM links WHERE NOT regexp_matches(link, '{EXCLUDE_LINK}')"))
def page_links(t: Tables):
    """Links of every page in order, excluded ones skipped."""
    return pages.page_links(t.pages, EXCLUDE_LINK)


@query("page_links_stride", sql(_LINKS + "SELECT * FROM links WHERE pos % 2 = 0"))
def page_links_stride(t: Tables):
    """Every second link of a page."""
    return pages.every_nth(pages.page_links(t.pages), 2)


@query("page_links_resume", sql(_LINKS + f"""
, s AS (SELECT page_id, min(pos) AS st FROM links WHERE link = '{RESUME_AT}' GROUP BY page_id)
SELECT links.* FROM links JOIN s ON s.page_id = links.page_id WHERE links.pos >= s.st
"""))
def page_links_resume(t: Tables):
    """A page's links from the resume link on."""
    return pages.links_from(t.pages, RESUME_AT)


@query("parse_fraction_scores", sql("""
, s AS (SELECT l_orderkey, l_linenumber,
               CASE WHEN l_linenumber = 7 THEN 'x/10' WHEN l_linenumber = 6 THEN ''
                    ELSE CAST(CAST(l_quantity AS BIGINT) AS VARCHAR) || '/50' END AS score_text FROM lineitem)
SELECT l_orderkey, l_linenumber, score_text,
       TRY_CAST(regexp_replace(score_text, '/(5|10|20|50)$', '') AS INTEGER) AS score FROM s
"""))
def parse_fraction_scores(t: Tables):
    """F8: '37/50'-style score texts to integers; malformed texts give NULL."""
    q = F.col("l_quantity").cast("long").cast("string")
    txt = F.when(F.col("l_linenumber") == 7, "x/10").when(F.col("l_linenumber") == 6, "").otherwise(F.concat(q, F.lit("/50")))
    s = t.lineitem.select("l_orderkey", "l_linenumber", txt.alias("score_text"))
    return s.select("*", pages.parse_fraction(F.col("score_text")).alias("score"))


# name: (numerator, denominator, line number whose text is malformed, that text)
_SUBSCORES = {
    "aroma": ("1 + pmod(CAST(l_quantity AS BIGINT), 10)", 10, 7, "x/10"),
    "appearance": ("1 + pmod(CAST(l_quantity AS BIGINT), 5)", 5, 6, ""),
    "taste": ("CAST(round(l_tax * 100) AS BIGINT)", 10, 5, "7/11"),
    "palate": ("1 + pmod(CAST(round(l_discount * 100) AS BIGINT), 5)", 5, 4, "3/10"),
    "overall": ("CAST(l_quantity AS BIGINT)", 50, 3, "?"),
}
_SUB_SQL = ", s AS (SELECT l_partkey AS item_id, " + ", ".join(
    f"CASE WHEN l_linenumber = {bad} THEN '{text}' ELSE CAST({n.replace('pmod(', 'mod(')} AS VARCHAR) || '/{d}' END AS {name}" for name, (n, d, bad, text) in _SUBSCORES.items()
) + " FROM lineitem),\np AS (SELECT item_id, " + ", ".join(f"TRY_CAST(regexp_replace({name}, '/{d}$', '') AS INTEGER) AS {name}" for name, (_, d, _, _) in _SUBSCORES.items()) + " FROM s)"
_SUB_AGG = ", ".join(f"round(avg({c}), 6) AS {c}_avg" for c in _SUBSCORES) + ", " + ", ".join(f"round(median(CAST({c} AS DOUBLE)), 6) AS {c}_med" for c in _SUBSCORES)


@query("page_subscores", sql(_SUB_SQL + f"SELECT item_id, {_SUB_AGG} FROM p GROUP BY item_id"))
def page_subscores(t: Tables):
    """X3 (F8 + A13): five sub-score texts, each with its own scale, parsed to numbers, then
    average and exact median of each per item; malformed texts are skipped, not zero."""
    from cellar.operators.stats import avg_median

    texts = t.lineitem.select(
        F.col("l_partkey").alias("item_id"),
        *[F.when(F.col("l_linenumber") == bad, text).otherwise(F.concat(F.expr(n).cast("string"), F.lit(f"/{d}"))).alias(name) for name, (n, d, bad, text) in _SUBSCORES.items()],
    )
    parsed = texts.select("item_id", *[pages.parse_fraction(F.col(name), str(d)).alias(name) for name, (_, d, _, _) in _SUBSCORES.items()])
    return avg_median(parsed, "item_id", list(_SUBSCORES))


_CARD_SQL = ORACLE["page_cards"].partition("SELECT page_id")[2]


@query("page_rows", sql(_SUB_SQL + f", sub AS (SELECT item_id AS page_id, {_SUB_AGG} FROM p GROUP BY item_id),\ncards AS (SELECT page_id{_CARD_SQL})\nSELECT cards.*, sub.* EXCLUDE (page_id) FROM cards LEFT JOIN sub ON sub.page_id = cards.page_id"))
def page_rows(t: Tables):
    """The assembled page row: card and the averages and medians of the five sub-scores of the item of the same number."""
    return pages.page_rows(pages.page_cards(t.pages), page_subscores(t).withColumnRenamed("item_id", "page_id"), "page_id")


@query("incremental_pages", sql("SELECT page_id, url, length(html) AS n_chars FROM pages"))
def incremental_pages(t: Tables):
    """ST1: pages arrive in two batches (the second repeats one url of the first);
    the stream runs once per batch on one checkpoint and appends each url once."""
    spark = t.spark
    src = t.pages
    base = scratch_path(spark, "pages-stream")
    inbox, sink, ckpt = (os.path.join(base, d) for d in ("inbox", "sink", "checkpoint"))
    cut = src.select(F.percentile_approx("page_id", 0.5)).scalar()
    first = src.where(F.col("page_id") <= cut)
    again = first.orderBy("page_id").limit(1)  # one page crawled twice
    second = src.where(F.col("page_id") > cut).unionByName(again)
    first.write.mode("append").parquet(inbox)
    run_incremental(spark, src.schema, inbox, sink, ckpt)
    second.write.mode("append").parquet(inbox)
    run_incremental(spark, src.schema, inbox, sink, ckpt)
    out = read_sink(spark, sink)
    return out.select("page_id", "url", F.length("html").cast("long").alias("n_chars"))
