"""Item cards and links extracted from a table of raw web pages.

Each field is one built-in regex expression over the page; a missing element
gives NULL instead of shifting the other columns (rows cannot misalign).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Patterns of the page elements a card is read from.
CARD_FIELDS = {
    "title": r"<title>([^<]*)</title>",
    "heading": r"<h1>([^<]*)</h1>",
    "lang": r"<html lang=\"([^\"]*)\"",
    "lead": r"<p><b>([^<]*)",
    "ad_text": r"<div class=\"ad\">([^<]*)</div>",
    "footer": r"<footer>([^<]*)</footer>",
}
URL_FIELDS = {
    "host": r"^[a-z]+://([^/?#]+)",
    "section": r"^[a-z]+://[^/]+/([^/?#]+)/",
}
LINK_PATTERN = r"<a href=\"([^\"]*)\""


def _field(src: str, pattern: str) -> Column:
    return F.nullif(F.regexp_extract(F.col(src), pattern, 1), F.lit(""))


def count_matches(src: str, pattern: str) -> Column:
    return F.size(F.regexp_extract_all(F.col(src), F.lit(pattern), F.lit(0)))


def page_cards(pages: DataFrame) -> DataFrame:
    """X1 + X4: one card row per page with a fixed set of nullable fields."""
    cols = [F.col("page_id"), F.col("url")]
    cols += [_field("url", p).alias(n) for n, p in URL_FIELDS.items()]
    cols += [_field("html", p).alias(n) for n, p in CARD_FIELDS.items()]
    cols.append(F.nullif(F.regexp_extract(F.col("url"), r"/([0-9]+)(\?|$)", 1), F.lit("")).try_cast("long").alias("path_no"))
    cols.append(F.nullif(F.regexp_extract(F.col("url"), r"[?&]page=([0-9]+)", 1), F.lit("")).try_cast("long").alias("page_no"))
    cols.append(count_matches("html", r"<a href=").cast("long").alias("n_links"))
    cols.append(count_matches("html", r"<p>").cast("long").alias("n_paragraphs"))
    cols.append(F.length("html").cast("long").alias("n_chars"))
    return pages.select(*cols)


def page_links(pages: DataFrame, exclude: str | None = None) -> DataFrame:
    """(page_id, pos, link) for every link of a page in page order; links
    matching ``exclude`` are skipped (positions stay those of the page)."""
    arr = F.regexp_extract_all(F.col("html"), F.lit(LINK_PATTERN), F.lit(1))
    # the _outer form keeps the optimizer from re-running the extraction in an inferred filter
    links = pages.select("page_id", F.posexplode_outer(arr).alias("pos", "link")).where(F.col("link").isNotNull())
    links = links.withColumn("pos", F.col("pos").cast("long"))
    if exclude:
        links = links.where(~F.col("link").rlike(exclude))
    return links


def every_nth(links: DataFrame, n: int = 2) -> DataFrame:
    """Every n-th element of each page's list (``[::n]``)."""
    return links.where(F.col("pos") % n == 0)


def links_from(pages: DataFrame, start: str) -> DataFrame:
    """Per page, its links from the first occurrence of ``start`` on; a page without it has none.

    The page's list is cut before it is exploded, so nothing is joined or shuffled.
    """
    arr = F.regexp_extract_all(F.col("html"), F.lit(LINK_PATTERN), F.lit(1))
    cut = pages.select("page_id", arr.alias("_all")).select("page_id", "_all", F.array_position("_all", start).alias("_at"))
    rest = F.when(F.col("_at") > 0, F.slice("_all", F.greatest(F.col("_at"), F.lit(1)).cast("int"), F.greatest(F.size("_all"), F.lit(1))))
    links = cut.select("page_id", "_at", F.posexplode_outer(rest).alias("pos", "link")).where(F.col("link").isNotNull())
    return links.select("page_id", (F.col("pos") + F.col("_at") - 1).cast("long").alias("pos"), "link")


def page_rows(cards: DataFrame, subscores: DataFrame, key: str) -> DataFrame:
    """The assembled row of a page: its card, then the average and median of each sub-score; NULL without any."""
    return cards.join(subscores, key, "left")


def parse_fraction(text: Column, denominators: str = "5|10|20|50") -> Column:
    """F8: '7/10' -> 7; anything else -> NULL (try_cast: ANSI mode would throw)."""
    return F.regexp_replace(text, rf"/({denominators})$", "").try_cast("int")
