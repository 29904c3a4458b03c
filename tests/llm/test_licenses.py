from __future__ import annotations

import math
import random
import re
import textwrap

from cellar.llm import licenses as L
from cellar.llm import queries
from tests.llm.helpers import NASTY, SMALL, by_id, clashing, docs, texts


def brute(text, theta=L.THETA):
    w = L.words_of(text or "")
    places = [(i, label) for p, label in L.PHRASES.items() for i in range(len(w)) if w[i : i + len(p.split())] == p.split()]
    hits = {}
    for line in (text or "").split("\n"):
        have = set(L.words_of(line))
        for label, t in L.TEMPLATES.items():
            need = set(L.words_of(t))
            if len(need & have) >= math.ceil(theta * len(need) - 1e-9):
                hits[label] = max(hits.get(label, 0), len(need & have) / len(need))
    base = {x for _, x in places}
    score = max([1.0] * bool(places) + list(hits.values()), default=0.0)
    return len(w), len(places), min(places)[0] if places else None, max(places)[0] if places else None, ",".join(sorted(base)), ",".join(sorted(base | set(hits))), score


def values(r):
    return tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"))


def test_query_matches_brute_force(spark):
    got, source = by_id(queries.op8_license_scan(spark, SMALL)), texts()
    assert {k: values(r) for k, r in got.items()} == {k: brute(t) for k, t in source.items()}


PLANTED = [
    "Cc\nBY", "cc by cc by", "cc-by: CC_BY", "ALL rights\treserved. all rights RESERVED", "the gnu general public license", "É all rightsreserved",
    "Released, under the MIT license!", "license mit the under released", "Released under the\nMIT License", "x " * 5000 + L.TEMPLATES["mit-text"].upper(),
    " ".join(w for i, w in enumerate(L.TEMPLATES["bsd"].split()) if i != 4), " ".join(L.TEMPLATES["bsd"].split()[:9]), "general public license general public license version 3 this work is licensed under the gnu",
]


def test_planted_blocks_and_edge_rows(spark):
    rows = NASTY + [(100 + i, t) for i, t in enumerate(PLANTED)]
    out = L.scan(clashing(docs(spark, rows))).collect()
    key = lambda x: (str(x[0]), str(x[1:]))
    assert sorted(((r["doc_id"], *values(r)) for r in out), key=key) == sorted(((r[0], *brute(r[1])) for r in rows), key=key)
    assert {m["label"] for r in out if r["doc_id"] == 109 for m in r["matches"]} == {"mit-text"}
    assert L.scan(docs(spark, [])).count() == 0


def test_frequencies_count_blocks_of_all_documents(spark):
    frame = docs(spark, [(1, "the the mit\nthe"), (2, "MIT\n\nx"), (3, None)])
    assert {r["token"]: r["n"] for r in L.block_frequencies(frame, ["license", "mit", "the"]).collect()} == {"license": 0, "mit": 2, "the": 2}


WRAPPED = {
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software.",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
}


def brute_matches(text):
    """(label, containment) of every line, and of every paragraph of several lines with words."""
    several = [p for p in re.split(r"\n[ \t\r\x0b\x0c]*\n", text) if sum(bool(L.words_of(x)) for x in p.split("\n")) > 1]
    out = []
    for block in [*text.split("\n"), *several]:
        have = set(L.words_of(block))
        for label, t in L.TEMPLATES.items():
            need = set(L.words_of(t))
            if len(need & have) >= math.ceil(L.THETA * len(need) - 1e-9):
                out.append((label, len(need & have) / len(need)))
    return sorted(out)


def test_wrapped_notices_are_whole_in_their_paragraph(spark):
    rng = random.Random(5)
    rows = []
    for label, t in WRAPPED.items():
        lines = textwrap.wrap(t, 80)
        assert len(lines) > 1 and label not in {x for line in lines for x, _ in brute_matches(line)}
        rows += [(len(rows), "\n".join(["Copyright", "", *lines, "", "code"])), (len(rows) + 1, "\r\n".join(f" * {x}" for x in lines))]
        rows += [(len(rows), "\n \t\n".join(lines))]  # parted by blank lines: no block holds it
    parts = [*L.TEMPLATES.values(), "other words here", ""]
    for k in range(200):
        words = " ".join(rng.choice(parts) for _ in range(3)).split(" ")
        rows.append((100 + k, "".join(w + rng.choice([" ", " ", " ", "\n", "\n\n", "\n \n"]) for w in words)))
    out = by_id(L.scan(docs(spark, rows), paragraphs=True))
    for k, t in rows:
        assert sorted((m["label"], m["containment"]) for m in out[k]["matches"]) == brute_matches(t)
    assert [out[k]["labels"] for k in range(6)] == ["mit-text", "mit-text", "", "bsd", "bsd", ""]
    counted = {r["token"]: r["n"] for r in L.block_frequencies(docs(spark, [(1, "the\nthe mit\n\nthe"), (2, "mit")]), ["mit", "the"], paragraphs=True).collect()}
    assert counted == {"mit": 3, "the": 4}


def test_query_finds_wrapped_notices(spark, tmp_path):
    docs(spark, [(k, "\n".join(textwrap.wrap(t, 80))) for k, t in enumerate(WRAPPED.values())]).write.parquet(f"{tmp_path}/documents.parquet")
    assert {k: r["labels"] for k, r in by_id(queries.op8_license_scan(spark, str(tmp_path))).items()} == dict(enumerate(WRAPPED))
