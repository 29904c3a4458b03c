"""Registry of named queries: each takes the role tables of one data folder."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from cellar.sources.tables import Tables

QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register a Spark query under ``name``; ``sql`` is its DuckDB oracle (if SQL-expressible)."""

    def deco(fn):
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn

    return deco


# Role views as SQL, so an oracle query reads the driver tables the same way
# cellar.sources.tables does. Unused CTEs cost nothing in DuckDB.
VIEWS = """
WITH ratings_raw AS (
  SELECT o.o_custkey AS uid, l.l_partkey AS item_id,
         CAST(ceil(l.l_quantity / 10) AS DOUBLE) AS score, l.l_shipdate AS ts
  FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey),
ratings AS (SELECT uid, item_id, max(score) AS score FROM ratings_raw GROUP BY uid, item_id),
train AS (SELECT * FROM ratings WHERE (uid * 31 + item_id) % 5 <> 0),
test AS (SELECT * FROM ratings WHERE (uid * 31 + item_id) % 5 = 0),
items AS (
  SELECT p.p_partkey AS item_id, p.p_name AS name, p.p_brand AS brand, p.p_type AS style,
         CAST(p.p_size AS DOUBLE) AS abv, p.p_retailprice AS price, pr.producer_id
  FROM part p LEFT JOIN (SELECT l_partkey, min(l_suppkey) AS producer_id FROM lineitem GROUP BY l_partkey) pr
    ON pr.l_partkey = p.p_partkey),
producers AS (
  SELECT s.s_suppkey AS producer_id, s.s_name AS producer_name, n.n_name AS state, r.r_name AS country
  FROM supplier s LEFT JOIN nation n ON n.n_nationkey = s.s_nationkey
  LEFT JOIN region r ON r.r_regionkey = n.n_regionkey),
reviews AS (SELECT conv_id AS item_id, role AS username, turn AS ord, text FROM conversations),
doc_reviews AS (
  SELECT concat_ws('/', d.lang, d.source) AS item_id, d.doc_id AS ord, d.text,
         CAST(lb.quality AS DOUBLE) AS score
  FROM documents d LEFT JOIN labels lb ON lb.doc_id = d.doc_id),
user_type AS (SELECT user_id AS uid, event_type AS item, avg(value) AS score FROM events GROUP BY user_id, event_type)
"""


def sql(body: str) -> str:
    """Oracle SQL with the role views in front; ``body`` may start with ``, name AS (...)``."""
    return VIEWS.strip() + "\n" + body.strip()
