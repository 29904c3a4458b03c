from __future__ import annotations

import datetime as dt
import random

from cellar.llm import queries
from cellar.llm import url_lists as L
from tests.llm.helpers import SMALL
from tools.oracle_check import canon

DAY = dt.date(2024, 1, 1)


def captures(spark, rows):
    return spark.createDataFrame(rows, "id int, url string, fetched date")


def entries(spark, rows):
    return spark.createDataFrame(rows, "pattern string, action string, since date")


def test_query_matches_sql(spark, duck):
    df = queries.op7_url_lists(spark, SMALL)
    cur = duck.execute(queries.ORACLE["op7_url_lists"])
    want = canon([d[0] for d in cur.description], cur.fetchall())
    assert sorted(canon(df.columns, [tuple(r) for r in df.collect()])) == sorted(want)


def brute(urls, listed):
    """Verdicts by going through all entries for every capture."""
    out = []
    rank = {"block": 3, "allow": 2, "remove": 1}
    for k, url, day in urls:
        best = None
        host = path = ""
        if url and "://" in url:
            rest = url.split("://", 1)[1]
            authority = rest.split("/")[0].split("?")[0].split("#")[0]
            host = authority.split("@")[-1].split(":")[0].lower().rstrip(".")
            path = "/".join(x for x in rest[len(authority) :].split("?")[0].split("#")[0].split("/") if x)
        for pattern in {p for p, a, s in listed if p and s and a in rank}:
            dated = sorted((s, rank[a], a) for p, a, s in listed if p == pattern and s and a in rank)
            if day is None or not host:
                continue
            name, _, prefix = pattern.lower().partition("/")
            covers = (host == name or host.endswith("." + name)) if not prefix else host == name and (path + "/").startswith(prefix + "/")
            active = [x for x in dated if x[0] <= day]
            if covers and active and active[-1][2] != "remove":
                best = max(best or (0,), (len(pattern), pattern.lower(), active[-1][2], active[-1][0]))
        out.append((k, bool(best) and best[2] == "block", *(best[1:] if best else (None, None, None))))
    return sorted(out, key=str)


def test_random_lists_match_brute_force(spark):
    rng = random.Random(7)
    hosts = ["a.com", "b.a.com", "c.b.a.com", "xa.com", "d.org", "com"]
    paths = ["", "/", "/p", "/p/q", "/pq", "//p//q/", "/p?x=/q", "#/p"]
    urls = [(i, f"http{'s' * (i % 2)}://{rng.choice(['', 'u:p@'])}{rng.choice(hosts).upper() if i % 3 else rng.choice(hosts)}{rng.choice(['', ':80', '.'])}{rng.choice(paths)}", DAY + dt.timedelta(rng.randrange(400))) for i in range(300)]
    listed = [(rng.choice([*hosts, "a.com/p", "b.a.com/p/q", "d.org/pq"]), rng.choice(["block", "allow", "remove", "other"]), DAY + dt.timedelta(rng.randrange(-50, 420))) for _ in range(120)]
    got = L.judge(captures(spark, urls), entries(spark, listed)).select("id", "blocked", "pattern", "action", "valid_from")
    assert sorted(map(tuple, got.collect()), key=str) == brute(urls, listed)


def test_edge_rows(spark, monkeypatch):
    urls = [(1, None, DAY), (2, "", DAY), (3, "no scheme", DAY), (4, "http://a.com/", None), (5, "http://A.com/" + "x/" * 3000, DAY), (5, "http://A.com/" + "x/" * 3000, DAY), (6, "http://[::1]:8/x", DAY), (7, "http://b.com", DAY)]
    listed = [("a.com", "block", DAY), ("a.com", "block", DAY), ("a.com", "allow", DAY), (None, "block", DAY), ("b.com", None, DAY), ("b.com", "block", None), ("[::1]", "block", DAY)]
    frame = captures(spark, urls).selectExpr("*", "'x' AS pattern", "'x' AS blocked", "'x' AS _u", "'x' AS _bucket")
    want = [(1, False), (2, False), (3, False), (4, False), (5, True), (5, True), (6, True), (7, False)]
    for most in (L.MAX_BROADCAST, 0):  # joined by broadcast, and by shuffle
        monkeypatch.setattr(L, "MAX_BROADCAST", most)
        got = L.judge(frame, entries(spark, listed))
        assert sorted((r["id"], r["blocked"]) for r in got.collect()) == want and "_u" in got.columns
    assert L.judge(captures(spark, []), entries(spark, listed)).count() == 0
    assert [r["blocked"] for r in L.judge(captures(spark, urls), entries(spark, [])).collect()] == [False] * len(urls)


def brute_with_case(urls, listed):
    """Verdicts by going through all entries; a pattern's host has no case, its path has."""
    rank = {"block": 3, "allow": 2, "remove": 1}
    dated = {}
    for p, a, since in listed:
        host, slash, path = p.partition("/")
        dated.setdefault(host.lower() + slash + path, []).append((since, rank[a], a))
    out = []
    for k, url, day in urls:
        host, _, path = url.split("://", 1)[1].partition("/")
        best = (0,)
        for p, entries_ in dated.items():
            name, _, prefix = p.partition("/")
            covers = host.lower() == name and (path + "/").startswith(prefix + "/") if prefix else ("." + host.lower()).endswith("." + name)
            active = max((x for x in entries_ if x[0] <= day), default=None)
            if covers and active and active[2] != "remove":
                best = max(best, (len(p), p, active[2], active[0]))
        out.append((k, best[2:3] == ("block",), *(best[1:] if best[1:] else (None, None, None))))
    return sorted(out, key=str)


def test_paths_keep_their_case_and_hosts_do_not(spark):
    rng = random.Random(11)
    hosts, paths = ["a.com", "m.a.com", "M.A.com", "D.org"], ["", "/News", "/news", "/News/Q", "/NEWS/q", "/\u00c4/x"]
    urls = [(i, f"http://{rng.choice(hosts)}{rng.choice(paths)}", DAY + dt.timedelta(rng.randrange(400))) for i in range(300)]
    listed = [(rng.choice(hosts) + rng.choice(paths), rng.choice(["block", "allow", "remove"]), DAY + dt.timedelta(rng.randrange(-50, 420))) for _ in range(60)]
    got = L.judge(captures(spark, urls), entries(spark, listed)).select("id", "blocked", "pattern", "action", "valid_from")
    want = brute_with_case(urls, listed)
    assert sorted(map(tuple, got.collect()), key=str) == want and any("/N" in (r[2] or "") for r in want)


def test_query_allows_paths_with_upper_case(spark, tmp_path):
    rows = [(i, "http://m.a.com/News/1") for i in range(730)]  # a capture for each day that the query gives
    spark.createDataFrame(rows, "page_id bigint, url string").write.parquet(f"{tmp_path}/pages.parquet")
    got = queries.op7_url_lists(spark, str(tmp_path)).where("action = 'allow'").select("pattern", "fetched").collect()
    assert {r["pattern"] for r in got} == {"m.a.com/News"} and len(got) == sum(dt.date(2023, 1, 1) + dt.timedelta(i * 37 % 730) >= dt.date(2023, 6, 1) for i in range(730))


def test_times_of_one_day_are_told_apart(spark):
    at = lambda h, y=2024: dt.datetime(y, 1, 5, h)
    entries = spark.createDataFrame([("a.com", "block", at(15)), ("a.com", "remove", at(20)), ("b.com", "block", at(0))], "pattern string, action string, since timestamp")
    captures = spark.createDataFrame([(1, "http://a.com/", at(9)), (2, "http://a.com/", at(15)), (3, "http://a.com/", at(19)), (4, "http://a.com/", at(20)), (5, "http://b.com/", at(1, 9000)), (6, "http://b.com/", None)], "id int, url string, fetched timestamp")
    got = {r["id"]: r["blocked"] for r in L.judge(captures, entries).collect()}
    assert got == {1: False, 2: True, 3: True, 4: False, 5: True, 6: False}
    days = entries.selectExpr("pattern", "action", "date_add(CAST(since AS date), 0) AS since")
    assert {r["id"]: r["blocked"] for r in L.judge(captures, days).collect()}[5] is True


def test_sql_keeps_the_case_of_paths(spark, tmp_path):
    """The query and its SQL agree on pages with upper-case paths, where lower-casing the whole pattern does not."""
    import duckdb

    from cellar.llm import queries
    from tools.oracle_check import canon

    rows = [(i, f"http://m.a.com/News/{i}", "") for i in range(40)] + [(100 + i, f"http://x.b.casino/Q{i}", "") for i in range(40)]
    spark.createDataFrame(rows, "page_id bigint, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    run = lambda sql: (lambda cur: sorted(canon([d[0] for d in cur.description], cur.fetchall())))(con.execute(sql))
    df = queries.op7_url_lists(spark, str(tmp_path))
    sql = queries.ORACLE["op7_url_lists"]
    got = sorted(canon(df.columns, [tuple(r) for r in df.collect()]))
    assert got == run(sql)
    old = sql.replace("lower(regexp_extract(pattern, '^[^/]*')) || substr(pattern, length(regexp_extract(pattern, '^[^/]*')) + 1)", "lower(pattern)")
    assert old != sql and got != run(old)
