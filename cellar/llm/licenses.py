"""License scan: exact containment join of text blocks with license templates.

A block is a line of a text or, with ``paragraphs``, also a paragraph of several
lines (what blank lines part), so that a hard-wrapped notice is whole in one
block. Its tokens, and a template's, are sets of lower-cased words. A block matches a template when it has at least ``theta`` of
the template's tokens. Tokens are ordered by the number of blocks of the corpus
that hold them, rarest first (counted over all documents). For a template of n
tokens and the overlap o = ceil(theta * n) it needs,

* length filter: the block has at least o words,
* prefix filter: the block has one of the template's n - o + 1 rarest tokens,
* positional filter: from the first such token on, both sides still have o tokens,

and what passes is counted exactly, so every matching block is found. Templates
are a parameter of bounded size (``MAX_TOKENS``); their index goes to every
task, the documents are scanned where they lie. The scan also finds the places
of fixed phrases (``PHRASES``).

Null and empty texts: no words, no matches, score 0. Repeated rows are scanned
each by itself. Input columns other than id and text are not read.
"""

from __future__ import annotations

import math
import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import map_batches
from cellar.llm.words import ALNUM, LOWER, NOT_SPACE, Words, slices, span_hashes

#: fixed values: phrase and label
PHRASES = {"cc by": "cc-by", "general public license": "gpl", "all rights reserved": "reserved"}
#: label and text of each template
TEMPLATES = {
    "apache-2.0": "Licensed under the Apache License, Version 2.0",
    "bsd": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    "cc-by-nc-4.0": "Licensed under CC BY-NC 4.0",
    "cc-by-sa-4.0": "Licensed under CC BY-SA 4.0",
    "gpl-3.0": "This work is licensed under the GNU General Public License, version 3",
    "mit": "Released under the MIT License",
    "mit-text": "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    "mpl-2.0": "This Source Code Form is subject to the terms of the Mozilla Public License, version 2.0",
    "unlicense": "This is free and unencumbered software released into the public domain",
}
THETA = 0.9
MAX_TOKENS = 100_000

_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text: str) -> list[str]:
    return _WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


def _token_hashes(tokens: list[str]) -> np.ndarray:
    raw = [t.encode() for t in tokens]
    ends = np.cumsum([len(r) for r in raw]) if raw else np.zeros(0, np.int64)
    sizes = np.array([len(r) for r in raw], np.int64)
    return span_hashes(np.frombuffer(b"".join(raw), np.uint8), ends - sizes, ends)


class Vocabulary:
    """Word hash -> token number, in the order given."""

    def __init__(self, tokens: list[str]):
        self.tokens = tokens
        h = _token_hashes(tokens)
        self.order = np.argsort(h)
        self.sorted = h[self.order]

    def numbers(self, h: np.ndarray) -> np.ndarray:
        """The token number of each word hash, -1 for other words."""
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        return np.where(self.sorted[at] == h, self.order[at], -1)


def _lines(w: Words) -> np.ndarray:
    """The line number of each word; a text's border parts lines too."""
    line = np.searchsorted(np.flatnonzero(w.data == 10), w.starts)
    return line + w.doc


def _paragraphs(w: Words, line: np.ndarray) -> np.ndarray:
    """The paragraph number of each word, -1 where its paragraph has one line of words only and so is that line."""
    breaks = np.flatnonzero(w.data == 10)
    filled = np.cumsum(NOT_SPACE[w.data])[breaks]
    blank = breaks[1:][filled[1:] == filled[:-1]]
    block = np.searchsorted(blank, w.starts) + w.doc
    _, lead, own, size = np.unique(block, return_index=True, return_inverse=True, return_counts=True)
    several = line[lead] < line[lead + size - 1]  # words stand in order, so a block's are a run
    return np.where(several[own], block, -1)


def _blocks(w: Words, paragraphs: bool) -> list[np.ndarray]:
    """For each kind of block, the block number of each word (-1: in no block of the kind)."""
    line = _lines(w)
    return [line, _paragraphs(w, line)] if paragraphs else [line]


def block_frequencies(docs: DataFrame, tokens: list[str], text: str = "text", paragraphs: bool = False) -> DataFrame:
    """(token, n): in how many blocks of all documents each token stands. Counted per batch before the shuffle."""

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        vocabulary = Vocabulary(tokens)
        total = np.zeros(len(tokens), np.int64)
        for _, _, offsets, data in slices(b.column(0)):
            w = Words(offsets, LOWER[data], ALNUM)
            number = vocabulary.numbers(w.hashes())
            for block in _blocks(w, paragraphs):
                hit = np.flatnonzero((number >= 0) & (block >= 0))
                pairs = np.unique(block[hit] * len(tokens) + number[hit])
                total += np.bincount(pairs % len(tokens), minlength=len(tokens))
        return pa.RecordBatch.from_arrays([pa.array(tokens), pa.array(total)], names=["token", "n"])

    return map_batches(docs.select(F.col(text).cast("string")), one, "token string, n bigint").groupBy("token").agg(F.sum("n").alias("n"))


class Index:
    """Templates over globally ordered tokens, and the phrases."""

    def __init__(self, templates: dict[str, str], phrases: dict[str, str], frequency: dict[str, int], theta: float):
        sets = {label: set(words_of(t)) for label, t in templates.items()}
        extra = {t for p in phrases for t in words_of(p)}
        tokens = sorted(set().union(extra, *sets.values()), key=lambda t: (frequency.get(t, 0), t))
        self.vocabulary = Vocabulary(tokens)
        rank = {t: i for i, t in enumerate(tokens)}
        self.phrases = [(label, np.array([rank[t] for t in words_of(p)])) for p, label in phrases.items()]
        self.templates = []
        for label, s in sets.items():
            ranks = np.array(sorted(rank[t] for t in s))
            need = math.ceil(theta * len(ranks) - 1e-9)
            place = np.full(len(tokens), -1)
            place[ranks] = np.arange(len(ranks))
            self.templates.append((label, len(ranks), need, place))

    def matches(self, w: Words, number: np.ndarray, block: np.ndarray) -> list[tuple[np.ndarray, str, np.ndarray]]:
        """(texts, label, containment) for the blocks that reach a template's threshold."""
        hit = np.flatnonzero((number >= 0) & (block >= 0))
        if not len(hit):
            return []
        n_tokens = len(self.vocabulary.tokens)
        pairs, first = np.unique(block[hit] * n_tokens + number[hit], return_index=True)
        doc = w.doc[hit[first]]
        token = pairs % n_tokens
        _, lead, own = np.unique(pairs // n_tokens, return_index=True, return_inverse=True)
        size = np.diff(np.append(lead, len(pairs)))  # known tokens of each block, rarest first
        ids, words_in = np.unique(block, return_counts=True)
        n_words = words_in[np.searchsorted(ids, pairs[lead] // n_tokens)]
        out = []
        for label, n, need, place in self.templates:
            at = place[token]
            in_prefix = np.flatnonzero((at >= 0) & (at <= n - need))
            found, i = np.unique(own[in_prefix], return_index=True)  # the rarest prefix token of each block
            i = in_prefix[i]
            left = np.minimum(n - at[i], size[found] - (i - lead[found]))
            found = found[(left >= need) & (n_words[found] >= need)]
            if len(found):
                overlap = np.bincount(own[at >= 0], minlength=len(lead))[found]
                good = overlap >= need
                out.append((doc[lead[found[good]]], label, overlap[good] / n))
        return out

    def places(self, w: Words, number: np.ndarray) -> list[tuple[str, np.ndarray]]:
        """(label, first words) of each phrase's places."""
        out = []
        for label, p in self.phrases:
            k = len(p)
            if len(number) >= k:
                same = w.doc[: len(number) - k + 1] == w.doc[k - 1 :]
                for i, t in enumerate(p):
                    same &= number[i : len(number) - k + 1 + i] == t
                out.append((label, np.flatnonzero(same)))
        return out


def scan(docs: DataFrame, id: str = "doc_id", text: str = "text", templates: dict[str, str] = TEMPLATES, phrases: dict[str, str] = PHRASES, theta: float = THETA, paragraphs: bool = False) -> DataFrame:
    """Per row: id, n_words, n_base, first_word, last_word, base_labels, labels, score, matches (label and containment of each matching block).

    ``paragraphs``: paragraphs of several lines are blocks beside the lines.
    """
    tokens = sorted({t for x in (*templates.values(), *phrases) for t in words_of(x)})
    if len(tokens) > MAX_TOKENS:
        raise ValueError(f"templates have more than {MAX_TOKENS} tokens: scan them in groups")
    slim = docs.select(F.col(id), F.col(text).cast("string").alias("_text"))
    frequency = {r["token"]: r["n"] for r in block_frequencies(slim, tokens, "_text", paragraphs).collect()}  # a row per template token
    index = Index(templates, phrases, frequency, theta)
    kind = "struct<n_words:bigint,n_base:bigint,first_word:bigint,last_word:bigint,base_labels:string,labels:string,score:double,matches:array<struct<label:string,containment:double>>>"
    result = T._parse_datatype_string(kind)
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), *result.fields])

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for i, j, offsets, data in slices(b.column(1)):
            w = Words(offsets, LOWER[data], ALNUM)
            number = index.vocabulary.numbers(w.hashes())
            base: dict[int, list[tuple[int, str]]] = {}
            found: dict[int, list[tuple[str, float]]] = {}
            for label, at in index.places(w, number):
                for d, x in zip(w.doc[at].tolist(), (at - w.first[w.doc[at]]).tolist()):
                    base.setdefault(d, []).append((x, label))
            for block in _blocks(w, paragraphs):
                for texts, label, score in index.matches(w, number, block):
                    for d, s in zip(texts.tolist(), score.tolist()):
                        found.setdefault(d, []).append((label, s))
            for d in range(j - i):
                places, hits = base.get(d, ()), found.get(d, ())
                base_labels = {x for _, x in places}
                labels = base_labels | {x for x, _ in hits}
                rows.append(
                    {
                        "n_words": int(w.n[d]), "n_base": len(places), "first_word": min(places)[0] if places else None, "last_word": max(places)[0] if places else None,
                        "base_labels": ",".join(sorted(base_labels)), "labels": ",".join(sorted(labels)), "score": max([1.0] * bool(places) + [s for _, s in hits], default=0.0),
                        "matches": [{"label": x, "containment": s} for x, s in hits],
                    }
                )
        out = pa.RecordBatch.from_pylist(rows, pa.schema([(f.name, ARROW[f.name]) for f in result.fields]))
        return pa.RecordBatch.from_arrays([b.column(0), *out.columns], names=schema.names)

    return map_batches(slim, one, schema)


ARROW = {k: pa.int64() for k in ("n_words", "n_base", "first_word", "last_word")} | {"base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "matches": pa.list_(pa.struct([("label", pa.string()), ("containment", pa.float64())]))}
