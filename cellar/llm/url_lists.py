"""Temporal URL lists: every capture is judged by the list entries active at its fetch time.

A list entry is dated: (pattern, action, since), action ``block``, ``allow`` or
``remove``. Per pattern, entries become validity intervals: each holds from its
date until the pattern's next entry; ``remove`` ends the one before. A pattern
is a host, which covers its subdomains, or a host with path segments, which
covers the paths that begin with them; hosts are compared without case, paths
with it. Of the intervals that hold a capture's
fetch time, the longest pattern decides; without one the capture is allowed.

As-of join: intervals are cut at ``BUCKET_DAYS`` boundaries, into the buckets
that captures have, and joined on (pattern, bucket), so a pattern that changes often meets a capture only with
the few changes near its fetch time. Captures are reduced to distinct (url,
time) first, which also folds hot URLs. The intervals are broadcast only if a
count shows at most ``MAX_BROADCAST`` of them; beyond that the join is
shuffled, and skewed patterns are split by adaptive execution.

Times are compared as they are: as dates where entries and captures both have
dates, else as timestamps (a date or a string is its first instant). An entry
of an afternoon does not judge a capture of the morning.

Null or unparsable URLs and null fetch times match nothing. Null patterns,
dates and unknown actions are no entries. Of entries with the same pattern and
date, ``block`` wins over ``allow`` over ``remove``. Repeated captures each get
a row. Empty tables give no rows, or captures that nothing blocks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cellar.llm.common import fresh

BUCKET_DAYS = 64
MAX_BROADCAST = 100_000
_SCHEME = r"^[a-zA-Z][a-zA-Z0-9+.-]*://"


def host_of(url: Column) -> Column:
    """Lower-case host without user, port and closing dots; empty if the URL has none."""
    return F.regexp_replace(F.lower(F.regexp_extract(url, _SCHEME + r"(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)", 1)), r"\.+$", "")


def segments_of(url: Column) -> Column:
    """Non-empty path segments."""
    return F.filter(F.split(F.regexp_extract(url, _SCHEME + r"[^/?#]*([^?#]*)", 1), "/"), lambda x: x != "")


def patterns_of(url: Column) -> Column:
    """All patterns that cover a URL: its host's suffixes at label borders, and the host with 1, 2, ... path segments."""
    host, labels, path = host_of(url), F.split(host_of(url), r"\."), segments_of(url)
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    prefixes = F.transform(path, lambda _, i: F.concat(host, F.lit("/"), F.array_join(F.slice(path, F.lit(1), i + 1), "/")))
    return F.when(host != "", F.array_distinct(F.concat(suffixes, prefixes)))


def _listed(pattern: Column) -> Column:
    """A pattern as ``patterns_of`` writes it: what stands before its first ``/`` in lower case."""
    host = F.regexp_extract(pattern, r"^[^/]*", 0)
    return F.concat(F.lower(host), F.substr(pattern, F.char_length(host) + 1))


def _kind(*columns) -> str:
    return "date" if all(c.typeName() == "date" for c in columns) else "timestamp"


def intervals(entries: DataFrame, kind: str | None = None) -> DataFrame:
    """(pattern, action, valid_from, valid_to) from entries (pattern, action, since); ``valid_to`` is exclusive, null while the entry is the last."""
    rank = F.when(F.col("action") == "block", 3).when(F.col("action") == "allow", 2).when(F.col("action") == "remove", 1)
    clean = entries.select(_listed(F.col("pattern")).alias("pattern"), "action", F.col("since").cast(kind or _kind(entries.schema["since"].dataType)).alias("since"), rank.alias("_rank")).where("pattern IS NOT NULL AND since IS NOT NULL AND _rank IS NOT NULL")
    one = clean.groupBy("pattern", "since").agg(F.max(F.struct("_rank", "action")).alias("a"))
    following = Window.partitionBy("pattern").orderBy("since")
    spans = one.select("pattern", F.col("a.action").alias("action"), F.col("since").alias("valid_from"), F.lead("since").over(following).alias("valid_to"))
    return spans.where("action <> 'remove'")


def _bucket(time: Column) -> Column:
    return F.floor(F.unix_date(time.cast("date")) / BUCKET_DAYS)


def judge(captures: DataFrame, entries: DataFrame, url: str = "url", fetched: str = "fetched") -> DataFrame:
    """``captures`` with blocked (boolean), and pattern, action and valid_from of the deciding entry; columns of those names are replaced."""
    new = ["blocked", "pattern", "action", "valid_from"]
    own = captures.drop(*[c for c in captures.columns if c.lower() in new])
    u, t = fresh(own, "_u"), fresh(own, "_t")
    kind = _kind(captures.schema[fetched].dataType, entries.schema["since"].dataType)
    keys = captures.select(F.col(url).alias(u), F.col(fetched).cast(kind).alias(t)).distinct()
    spans = intervals(entries, kind)
    # an interval is spread over the buckets that captures have: a far date costs one bucket, not all up to it
    found = keys.where(F.col(t).isNotNull()).select(_bucket(F.col(t)).alias("b")).distinct().collect()  # one a BUCKET_DAYS of fetch times
    used = F.array(*[F.lit(r["b"]) for r in found]).cast("array<bigint>")
    ends = F.coalesce(_bucket(F.col("valid_to")), F.lit(1 << 40))
    spans = spans.withColumn("_bucket", F.explode(F.filter(used, lambda x: (x >= _bucket(F.col("valid_from"))) & (x <= ends))))
    if spans.limit(MAX_BROADCAST + 1).count() <= MAX_BROADCAST:
        spans = F.broadcast(spans)
    asked = keys.select(u, t, F.explode(patterns_of(F.col(u))).alias("pattern"), _bucket(F.col(t)).alias("_bucket"))
    hit = asked.join(spans, ["pattern", "_bucket"]).where((F.col(t) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(t) < F.col("valid_to"))))
    best = hit.groupBy(u, t).agg(F.max(F.struct(F.length("pattern").alias("n"), "pattern", "action", "valid_from")).alias("_best"))
    joined = own.join(best, own[url].eqNullSafe(best[u]) & own[fetched].cast(kind).eqNullSafe(best[t]), "left")
    return joined.select(*[own[c] for c in own.columns], F.coalesce(F.col("_best.action") == "block", F.lit(False)).alias("blocked"), "_best.pattern", "_best.action", "_best.valid_from")
