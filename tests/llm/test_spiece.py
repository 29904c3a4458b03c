from __future__ import annotations

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece

from cellar.llm import queries, spiece
from tests.llm.helpers import NASTY, SMALL, by_id, clashing, docs, texts

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


def sha(x):
    return hashlib.sha256(x.encode()).hexdigest()


def test_query_matches_the_library(spark, library):
    got, source = by_id(queries.op2_sentencepiece(spark, SMALL)), texts()
    assert set(got) == set(source)
    for k, t in source.items():
        ids = library.encode(t)
        assert (got[k]["n_tokens"], got[k]["ids_sha256"], got[k]["decoded_sha256"]) == (len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids)))
        assert got[k]["n_span_bytes"] == len(t.encode())


def test_edge_rows(spark, library):
    frame = clashing(docs(spark, NASTY))
    out = spiece.encode(frame, MODEL, into="tokens", decoded="decoded")
    assert [c for c in out.columns if c not in frame.columns] == ["decoded"]
    rows = out.collect()
    assert len(rows) == len(NASTY)
    for r in rows:
        t = r["text"] or ""
        assert r["tokens"]["ids"] == library.encode(t) and r["decoded"] == library.decode(library.encode(t))
        spans = list(zip(r["tokens"]["first"], r["tokens"]["end"]))
        assert all(a <= b for a, b in spans) and all(x[1] == y[0] for x, y in zip(spans, spans[1:]))
        if spans:
            assert spans[0][0] == 0 and spans[-1][1] == len(t.encode())
    again = spiece.decode(out.select("doc_id", "text", "tokens.ids"), MODEL)
    assert {(r["doc_id"], r["decoded"]) for r in again.collect()} == {(r["doc_id"], r["decoded"]) for r in rows}
    assert spiece.round_trip(docs(spark, []), MODEL).count() == 0


def test_random_texts(library):
    enc, rng = spiece.Encoder(MODEL), random.Random(3)
    parts = ["a", "b", " ", "  ", "th", "é", "\u2581", "\n", "😀", "<s>", "</s>", "<unk>", "<0x41>", "\ufeff", "\r", "zz", "\x00"]
    for _ in range(1500):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 30)))
        ids, first, end = enc.encode(t)
        pieces = library.encode(t, return_type="proto").pieces
        assert ids == [p.id for p in pieces]
        for p, i, j in zip(pieces, first, end):
            if p.surface and enc.lengths[p.id] > 1:
                assert t.encode()[i:j].decode() == p.surface


@pytest.mark.parametrize("rule", ["nmt_nfkc", "nfkc", "nfkc_cf"])
def test_compiled_character_maps(rule):
    """Longest-prefix normalisation with a real map gives the library's text and alignment."""
    theirs = sentencepiece.SentencePieceNormalizer(rule_name=rule)
    spec = next(v for k, v, _ in spiece.fields(theirs.serialized_model_proto()) if k == 3)
    mine, rng = spiece.Normalizer(spec), random.Random(4)
    parts = ["a", "B", " ", "ｶ", "ﾞ", "①", "é", "e\u0301", "Å", "ﬁ", "\u00a0", "\u200b", "\t", "\u3000", "㍿", "ß", "İ"]
    for _ in range(1500):
        t = "".join(rng.choice(parts) for _ in range(rng.randint(0, 14)))
        raw, origin = mine(t.encode())
        want, offsets = theirs.normalize(t, with_offsets=True)
        assert raw.decode() == want
        at, chars = 0, []
        for c in want:
            chars.append(len(t.encode()[: origin[at]].decode(errors="ignore")))
            at += len(c.encode())
        assert chars == offsets[: len(chars)]
