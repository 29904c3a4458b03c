from __future__ import annotations

import re

import pyarrow.dataset as ds

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
SMALL = "/root/testdata/sf0.001"

#: nulls in every column, empty and blank texts, one word, repeated rows, a long text, wide spaces and odd characters
LONG = " ".join(f"w{i % 997} x{i}" for i in range(15_000))
NASTY = [
    (1, None, None, None, None),
    (2, "", "en", "a", 0),
    (3, " \n\t \x0b\x0c\r ", "en", "a", 8),
    (4, "one", "de", None, 3),
    (5, "same row of a few words that is here twice", "en", "a", 1),
    (5, "same row of a few words that is here twice", "en", "a", 1),
    (6, LONG, "fr", "a", len(LONG)),
    (7, "é\u00a0ü 漢字 😀 \u2581 a\x00b ### $$ </turn> \\ß", "xx", "b", 1),
    (None, "a null id has words too, quite a few of them, more than ten in fact", "en", "a", 1),
]


def docs(spark, rows):
    return spark.createDataFrame([tuple(r) + (None,) * (5 - len(r)) for r in rows], SCHEMA)


def clashing(df):
    """The frame with extra columns whose names operators like to use themselves."""
    from pyspark.sql import functions as F

    names = "m kept n_words broken base_failed tokens stratum quality _k _text _z _gone _row class_id class_doc rep g h at labels score matches ids held_out".split()
    return df.withColumns({n: F.lit("x") for n in names})


def texts(sf_dir=SMALL):
    t = ds.dataset(f"{sf_dir}/documents.parquet").to_table(columns=["doc_id", "text"]).to_pylist()
    return {r["doc_id"]: r["text"] or "" for r in t}


def by_id(df, id="doc_id"):
    return {r[id]: r for r in df.collect()}
