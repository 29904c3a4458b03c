"""The registered queries of the training-data operators, and their DuckDB SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cellar.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellar.llm import quality_rules

    judged = quality_rules.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return judged.select("doc_id", "m.n_words", "m.word_chars", "m.n_symbols", "m.n_dup_lines", "m.n_repeat_words", "base_failed", "kept", F.array_join("broken", ",").alias("broken_rules"))


@query
def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    from cellar.llm import spiece

    return spiece.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op9_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellar.llm import chat

    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    fixed = spark.range(2, numPartitions=1).select(
        F.lit(-7).cast("bigint").alias("conv_id"), F.col("id").alias("turn"), F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"), F.lit("\\### Assistant: </turn> ok").alias("text")
    )
    return chat.digests(chat.format_parts(rows.unionByName(fixed)))


# the formatted text has three fixed strings a turn; an escape adds one code point for each backslash and colon, and takes 1 or 5 for each marker
ORACLE["op9_chat_format"] = r"""
WITH rows AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok' UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
sized AS (
  SELECT *, length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c'))
          + length(replace(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c')) + 14 AS n FROM rows)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(sum(CASE WHEN role = 'assistant' THEN length(text) ELSE 0 END) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '')) AS loss_sha256,
  CAST(sum(n) AS BIGINT) AS formatted_chars
FROM sized GROUP BY conv_id
"""


@query
def op8_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellar.llm import licenses

    return licenses.scan(table(spark, sf_dir, "documents"), paragraphs=True).drop("matches")


@query
def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellar.llm import decontam

    return decontam.overlaps(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellar.llm import substring_dedup

    return substring_dedup.digest(table(spark, sf_dir, "documents"))


@query
def op6_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellar.llm import jaccard_join

    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op7_url_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tables hold neither fetch times nor lists; both follow from the pages by fixed rules, so the list grows with the hosts."""
    from cellar.llm import url_lists

    pages = table(spark, sf_dir, "pages").select("page_id", "url", F.expr("date_add(DATE'2023-01-01', CAST(pmod(page_id * 37, 730) AS INT))").alias("fetched"))
    hosts = pages.select(url_lists.host_of(F.col("url")).alias("host"), F.element_at(url_lists.segments_of(F.col("url")), 1).alias("seg")).where("host <> ''").distinct()
    domain = F.regexp_extract("host", r"([^.]+\.[^.]+\.[^.]+)$", 1)
    listed = hosts.select(domain.alias("pattern")).where("pattern <> ''").distinct()
    first = F.expr("date_add(DATE'2023-01-01', pmod(length(pattern) * 17, 365))")
    spam = listed.where(F.col("pattern").rlike("casino|bets|pills|win"))
    rest = listed.where("pmod(length(pattern), 5) = 0")
    paths = hosts.where("host LIKE 'm.%' AND seg IS NOT NULL").select(F.concat_ws("/", "host", "seg").alias("pattern"), F.lit("allow").alias("action"), F.to_date(F.lit("2023-06-01")).alias("since"))
    entries = (
        spam.select("pattern", F.lit("block").alias("action"), first.alias("since"))
        .unionByName(spam.select("pattern", F.lit("remove").alias("action"), F.date_add(first, 180).alias("since")))
        .unionByName(spam.select("pattern", F.lit("block").alias("action"), F.to_date(F.lit("2024-07-01")).alias("since")))
        .unionByName(rest.select("pattern", F.lit("block").alias("action"), F.to_date(F.lit("2024-03-01")).alias("since")))
        .unionByName(rest.select("pattern", F.lit("allow").alias("action"), F.to_date(F.lit("2024-09-01")).alias("since")))
        .unionByName(paths)
    )
    return url_lists.judge(pages, entries)


ORACLE["op7_url_lists"] = r"""
WITH pages_ AS (
  SELECT page_id, url, CAST(DATE '2023-01-01' + CAST((page_id * 37) % 730 AS INTEGER) AS DATE) AS fetched,
    regexp_replace(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?(\[[^\]/?#]*\]|[^/?#:]*)', 1)), '\.+$', '') AS host,
    list_filter(string_split(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1), '/'), lambda x: x <> '') AS segs FROM pages),
hosts AS (SELECT DISTINCT host, segs[1] AS seg FROM pages_ WHERE host <> ''),
listed AS (SELECT DISTINCT regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) AS pattern FROM hosts WHERE regexp_extract(host, '([^.]+\.[^.]+\.[^.]+)$', 1) <> ''),
spam AS (SELECT pattern, CAST(DATE '2023-01-01' + CAST((length(pattern) * 17) % 365 AS INTEGER) AS DATE) AS d FROM listed WHERE regexp_matches(pattern, 'casino|bets|pills|win')),
rest AS (SELECT pattern FROM listed WHERE length(pattern) % 5 = 0),
entries AS (
  SELECT pattern, 'block' AS action, d AS since FROM spam UNION ALL SELECT pattern, 'remove', CAST(d + 180 AS DATE) FROM spam
  UNION ALL SELECT pattern, 'block', DATE '2024-07-01' FROM spam UNION ALL SELECT pattern, 'block', DATE '2024-03-01' FROM rest
  UNION ALL SELECT pattern, 'allow', DATE '2024-09-01' FROM rest
  UNION ALL SELECT host || '/' || seg, 'allow', DATE '2023-06-01' FROM hosts WHERE host LIKE 'm.%' AND seg IS NOT NULL),
ranked AS (SELECT lower(regexp_extract(pattern, '^[^/]*')) || substr(pattern, length(regexp_extract(pattern, '^[^/]*')) + 1) AS pattern, since, max(CASE action WHEN 'block' THEN 3 WHEN 'allow' THEN 2 ELSE 1 END) AS r FROM entries GROUP BY 1, 2),
spans AS (SELECT pattern, r, since AS valid_from, lead(since) OVER (PARTITION BY pattern ORDER BY since) AS valid_to FROM ranked),
keys AS (SELECT DISTINCT url, fetched, host, segs, string_split(host, '.') AS labels FROM pages_ WHERE host <> ''),
asked AS (
  SELECT DISTINCT url, fetched, unnest(list_concat(
    list_transform(range(1, len(labels) + 1), lambda i: array_to_string(labels[i:], '.')),
    list_transform(range(1, len(segs) + 1), lambda i: host || '/' || array_to_string(segs[1:i], '/')))) AS pattern FROM keys),
best AS (
  SELECT url, fetched, max({'n': length(a.pattern), 'pattern': a.pattern, 'r': r, 'valid_from': valid_from}) AS b
  FROM asked a JOIN spans s ON a.pattern = s.pattern AND r > 1 AND fetched >= valid_from AND (valid_to IS NULL OR fetched < valid_to) GROUP BY url, fetched)
SELECT p.page_id, p.url, p.fetched, coalesce(b.r = 3, false) AS blocked, b.pattern AS pattern, CASE b.r WHEN 3 THEN 'block' WHEN 2 THEN 'allow' END AS action, b.valid_from AS valid_from
FROM pages_ p LEFT JOIN best ON p.url IS NOT DISTINCT FROM best.url AND p.fetched IS NOT DISTINCT FROM best.fetched
"""


@query
def op4_compression_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellar.llm import compression_quality

    return compression_quality.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellar.llm import html_crf

    return html_crf.extract_text(table(spark, sf_dir, "pages"))


@query
def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellar.llm import lexical_search

    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


# whole numbers throughout, but for the weight of a term
ORACLE["op13_lexical_search"] = r"""
WITH words AS (
  SELECT rid, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
  FROM (SELECT row_number() OVER () AS rid, doc_id, text FROM documents)),
tf AS (SELECT rid, doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
lens AS (SELECT rid, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY rid),
tot AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS l FROM lens),
q AS (
  SELECT item_id, term, count(*) AS times FROM (
    SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark) GROUP BY ALL),
w AS (
  SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w
  FROM tf, tot WHERE term IN (SELECT term FROM q) GROUP BY term),
hits AS (
  SELECT rid, doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // l))) AS s
  FROM tf JOIN w USING (term) JOIN lens USING (rid), tot),
scored AS (SELECT item_id, rid, doc_id, CAST(sum(times * s) AS BIGINT) AS score FROM hits JOIN q USING (term) GROUP BY ALL)
SELECT item_id, rank, doc_id, score FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM scored WHERE score > 0)
WHERE rank <= 20
"""


@query
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellar.llm import conversation_repair

    rows = conversation_repair.damage(table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text"))
    return conversation_repair.digests(rows, gone="gone")


# crc32 bit by bit; then the least (cost, letters) of each state, turn by turn: 0 nothing, 1 system, 2 user, 3 assistant came last
ORACLE["op11_conversation_repair"] = r"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' '), ''), lambda x: CAST(ord(x) AS BIGINT))),
      lambda c, b: list_reduce(list_concat([xor(c, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda x, i: xor(x >> 1, (x & 1) * 3988292384))) AS crc FROM conversations),
hashed AS (SELECT *, xor(crc, 4294967295) % 20 AS h FROM keyed),
damaged AS (
  SELECT conv_id, turn, CASE WHEN h = 4 THEN 'user' ELSE role END AS role,
    CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text, unnest(CASE WHEN h = 3 THEN [0, 1] ELSE [0] END) AS copy
  FROM hashed WHERE h <> 0),
lasts AS (
  SELECT *, right(rtrim(text, chr(9) || chr(10) || chr(11) || chr(12) || chr(13) || ' '), 1) AS e, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM damaged),
turns AS (
  SELECT conv_id, turn, role, text, CASE WHEN e = '' THEN 1 WHEN nth > 1 THEN 2 WHEN e NOT IN ('.', '!', '?') THEN 3 ELSE 0 END AS fault, left(role, 1) AS c,
    row_number() OVER w AS pos, left(lag(role) OVER w, 1) AS c0 FROM lasts WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth)),
ins(q, q2, n, lines) AS (VALUES (0, 0, 0, []), (1, 1, 0, []), (2, 2, 0, []), (3, 3, 0, []), (0, 2, 1, ['user:']), (1, 2, 1, ['user:']), (3, 2, 1, ['user:']), (2, 3, 1, ['assistant:']),
  (0, 3, 2, ['user:', 'assistant:']), (1, 3, 2, ['user:', 'assistant:'])),
convs AS (SELECT DISTINCT conv_id FROM conversations),
dp(conv_id, pos, state, v) AS (
  SELECT conv_id, CAST(0 AS BIGINT), 0, {'cost': CAST(0 AS BIGINT), 'audit': '', 'lines': CAST([] AS VARCHAR[])} FROM convs
  UNION ALL
  SELECT conv_id, pos, state, min(v) FROM (
    SELECT d.conv_id, t.pos, CASE e.e WHEN 'D' THEN i.q2 WHEN 'K' THEN CASE t.c WHEN 's' THEN 1 WHEN 'u' THEN 2 ELSE 3 END ELSE CASE i.q2 WHEN 2 THEN 3 ELSE 2 END END AS state,
      {'cost': d.v.cost + 5 * i.n + CASE e.e WHEN 'D' THEN 2 WHEN 'R' THEN 1 ELSE 0 END + CASE WHEN e.e <> 'D' AND t.fault = 3 THEN 5 ELSE 0 END,
       'audit': d.v.audit || repeat('I', i.n) || e.e,
       'lines': list_concat(d.v.lines, i.lines, CASE e.e WHEN 'D' THEN [] WHEN 'K' THEN [t.role || ':' || t.text] ELSE [CASE i.q2 WHEN 2 THEN 'assistant:' ELSE 'user:' END || t.text] END)} AS v
    FROM dp d JOIN turns t ON t.conv_id IS NOT DISTINCT FROM d.conv_id AND t.pos = d.pos + 1 JOIN ins i ON i.q = d.state, (VALUES ('D'), ('K'), ('R')) e(e)
    WHERE e.e = 'D' OR t.fault NOT IN (1, 2) AND (e.e = 'R' OR (t.c = 's' AND i.q2 = 0) OR (t.c = 'u' AND i.q2 <> 2) OR (t.c = 'a' AND i.q2 = 2)))
  GROUP BY conv_id, pos, state),
facts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (fault = 1) AS blank, count(*) FILTER (fault = 2) AS duplicate,
    count(*) FILTER (fault = 3) AS truncated, count(*) FILTER (c0 IS NOT NULL AND c0 || c NOT IN ('su', 'ua', 'au')) AS illegal FROM turns GROUP BY conv_id),
ended AS (
  SELECT d.conv_id, min({'cost': v.cost + 5 * e.n, 'audit': v.audit || repeat('I', e.n), 'lines': list_concat(v.lines, e.lines)}) AS v
  FROM dp d LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM d.conv_id JOIN (VALUES (0, 0, []), (1, 2, ['user:', 'assistant:']), (2, 1, ['assistant:']), (3, 0, [])) e(q, n, lines) ON e.q = d.state
  WHERE d.pos = coalesce(f.n, 0) GROUP BY d.conv_id)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate, coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal,
  v.cost AS cost, v.audit AS audit, sha256(array_to_string(v.lines, chr(10))) AS repaired_sha256
FROM ended e LEFT JOIN facts f ON f.conv_id IS NOT DISTINCT FROM e.conv_id
"""


@query
def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    from cellar.llm import toxicity

    return toxicity.score(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
