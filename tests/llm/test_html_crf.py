from __future__ import annotations

import html
import math
import random
import re
from itertools import product

import pyarrow.dataset as ds
import pytest

from cellar.llm import html_crf as H
from cellar.llm import queries
from tests.llm.helpers import SMALL

FAR = "/root/testdata/sf0.01"


def raw_pages(sf_dir):
    return {r["page_id"]: r["html"] for r in ds.dataset(f"{sf_dir}/pages.parquet").to_table(columns=["page_id", "html"]).to_pylist()}


@pytest.fixture(scope="module")
def field():
    return H.train(H.labelled(list(raw_pages(FAR).values())[:100]))


def article(page):
    body = re.search(r"<article>(.*?)(</article>|$)", page, re.S)[1]
    parts = re.split(r"</?(?:p|h1|b|br)>", body)
    return "\n".join(x for x in (" ".join(html.unescape(q).split()) for q in parts) if x)


def test_query_gives_every_article(spark):
    got = {r["page_id"]: r for r in queries.op3_html_extraction(spark, SMALL).collect()}
    want = raw_pages(SMALL)
    assert set(got) == set(want)
    for k, page in want.items():
        assert got[k]["text"] == article(page) and got[k]["n_chars"] == len(got[k]["text"])


def test_held_out_layouts(field):
    pages = H.labelled(list(raw_pages(FAR).values())[150:200], seed=77)
    pairs = [(a, b) for blocks, labels in pages for a, b in zip(field.viterbi(blocks), labels)]
    assert sum(a == b for a, b in pairs) / len(pairs) > 0.99


PROSE = "This is a plain sentence of the article, and it is long enough to be one."


@pytest.mark.parametrize(
    "page,want",
    [
        ("", ""),
        ("   \n", ""),
        ("<script>var a = '<p>no</p>';</script><style>p{}</style><!-- <p>no</p> -->", ""),
        (f"<article><h1>A&amp;B</h1><p>{PROSE}<p>two  \n\t words</p></article>", f"A&B\n{PROSE}\ntwo words"),
        (f"<nav><a href='/'>Home</a></nav><main><p>{PROSE}</p><form><label>Name</label><input></form><p>{PROSE}</p></main><footer>&copy; x</footer>", f"{PROSE}\n{PROSE}"),
        (f"<article><p>{PROSE}</p></article><section class='comments'><div class='comment'><p>{PROSE}</p></div></section>", PROSE),
        (f"<article><p>{PROSE} &lt;b&gt; &#233;&#x1F600; &am", f"{PROSE} <b> é😀 &am"),
        (f'<article><p title="a > b">{PROSE}</p><p class="x', PROSE),
        (f"<article><p>{PROSE}<b>bold</b> and <a href=x>link</a></article>", f"{PROSE}bold and link"),
        (f"<ARTICLE><P>{PROSE}</P><DIV CLASS=ad>Buy this</DIV><P>1 < 2</P></ARTICLE>", f"{PROSE}\n1 < 2"),
    ],
)
def test_small_pages(field, page, want):
    assert H.extract(field, page) == want


def test_viterbi_is_the_best_labelling(field):
    rng = random.Random(4)
    pages = H.labelled(list(raw_pages(FAR).values())[:3], seed=5)
    for blocks, _ in pages:
        blocks = rng.sample(blocks, min(len(blocks), 7))
        x = field.scores(blocks)

        def total(y):
            return field.first[y[0]] + sum(a * b for a, b in zip(x, y)) + sum(field.steps[a][b] for a, b in zip(y, y[1:]))

        best = max(total(y) for y in product((0, 1), repeat=len(blocks)))
        assert math.isclose(total(field.viterbi(blocks)), best, rel_tol=1e-9, abs_tol=1e-9)


def test_edge_rows(spark):
    long = "<article>" + f"<p>{PROSE}</p>" * 5000 + "</article>"
    rows = [(1, None, None), (2, "u", ""), (3, "u", f"<article><p>{PROSE}</p>"), (3, "u", f"<article><p>{PROSE}</p>"), (None, "v", "<p>&nbsp;</p>"), (4, "w", long), (5, "x", "<b>" * 3000 + "deep")]
    frame = spark.createDataFrame(rows, "page_id bigint, url string, html string").selectExpr("*", "'x' AS text", "'x' AS n_chars", "'x' AS _html")
    got = [(r["page_id"], r["url"], r["text"], r["n_chars"]) for r in H.extract_text(frame).collect()]
    assert sorted(r[0] or 0 for r in got) == [0, 1, 2, 3, 3, 4, 5]
    by = {r[0]: r for r in got}
    assert by[1][1:] == (None, "", 0) and by[2][2] == "" and by[None][2] == "" and by[3][2] == PROSE and by[4][2] == "\n".join([PROSE] * 5000)
    empty = spark.createDataFrame([], "page_id bigint, url string, html string")
    assert H.extract_text(empty).count() == 0
