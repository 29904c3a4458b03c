"""Benchmark decontamination with spaced seeds.

Words are lower-cased runs of digits, letters and characters beyond ASCII. A
seed is a fixed mask of word offsets; the words at its offsets are hashed, the
others ignored, so a seed survives substituted words between them. The seeds of
the benchmark are joined with those at every word of every document; around a
hit, document and item are laid side by side without gaps, and of the segments
in which at least three quarters of the words match, the one with most matches is
taken. A document holds an item's text when that segment has ``MIN_MATCHES``
matching words, or ``MIN_SHARE`` of the item's words.

The benchmark is the stated query set: it is cut into blocks of about
``BLOCK_WORDS`` words by a hash of its rows, each block's seeds go to every
task, and the documents are scanned where they lie; no document is shuffled.
Items of up to ``SHORT_ITEM`` words have masks of their own length: whichever
words ``MIN_SHARE`` allows to be substituted, one of them avoids all of these, so
none is missed. Items of fewer than ``MIN_ITEM`` words are no evidence and are
not searched.

Null and empty texts hold nothing. Repeated benchmark rows each report;
repeated documents are judged each by itself. Texts are scanned whole. An empty
benchmark leaves everything clean.
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import map_batches
from cellar.llm.words import ALNUM, LOWER, U, Words, buffers, mix, slices

#: offsets of the words a seed hashes, for items of more than SHORT_ITEM words; together they miss 0.4 % of 13 to 25 word passages with up to a fifth substituted
MASKS = ((0, 1, 2, 4, 5, 7), (0, 1, 2, 6, 8, 9), (0, 2, 5, 6, 9, 10), (0, 1, 3, 4, 5, 10))
MIN_MATCHES, MIN_SHARE, MIN_ITEM = 12, 0.8, 5
SHORT_ITEM = 14  # beyond it MIN_MATCHES words are enough
MISMATCH = -3  # against 1 for a match: a score of 0 is three quarters matching
BLOCK_WORDS = 500_000
_FILTER_BITS = 20
_COEFFICIENT = [int(x) | 1 for x in mix(np.arange(1, 17, dtype=U))]


def _seeds(doc: np.ndarray, h: np.ndarray, mask: tuple[int, ...], kind: int) -> tuple[np.ndarray, np.ndarray]:
    """(first word, hash) of each place where the whole mask lies in one text."""
    span = mask[-1] + 1
    n = len(h) - span + 1
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, U)
    total = np.full(n, kind + 1, U)
    for c, o in zip(_COEFFICIENT, mask):
        total += h[o : o + n] * U(c)
    at = np.flatnonzero(doc[:n] == doc[span - 1 :])
    return at, mix(total[at])


def short_masks(n: int) -> list[tuple[int, ...]]:
    """Word places of an item of n words such that every set of substitutions that ``MIN_SHARE`` allows leaves one of the masks whole.

    The item is cut into runs and each mask leaves out as many of them as words
    may differ; the runs are as few as leave 6 words, or all that must match.
    """
    need = math.ceil(MIN_SHARE * n)
    for parts in range(n - need + 1, n + 1):
        runs = np.array_split(np.arange(n), parts)
        masks = [tuple(int(x) for r in kept for x in r) for kept in combinations(runs, parts - (n - need))]
        if min(map(len, masks)) >= min(6, need):
            break
    return masks


class Index:
    """Seeds of one block of benchmark items."""

    def __init__(self, texts: list[str | None]):
        offsets, data = buffers(pa.array(texts, pa.string()))
        w = Words(offsets, LOWER[data], ALNUM)
        self.n, self.first, self.hashes, doc = w.n, w.first, w.hashes(), w.doc
        shapes: dict[tuple[int, ...], list[tuple[int, int]]] = {}  # a mask from offset 0: the lengths of its items, and its first place in them
        for k in np.unique(self.n[(self.n >= MIN_ITEM) & (self.n <= SHORT_ITEM)]).tolist():
            for places in short_masks(k):
                shapes.setdefault(tuple(x - places[0] for x in places), []).append((k, places[0]))
        self.masks = [*MASKS, *shapes]
        self.tables = []
        for kind, mask in enumerate(self.masks):
            at, seed = _seeds(doc, self.hashes, mask, kind)
            n, place = self.n[doc[at]], at - self.first[doc[at]]
            if kind < len(MASKS):
                own = n > SHORT_ITEM
            else:
                own = np.any([(n == k) & (place == x) for k, x in shapes[mask]], axis=0)
            at, seed = at[own], seed[own]
            order = np.argsort(seed, kind="stable")
            seed = seed[order]
            self.tables.append((seed, at[order], self._filter(seed)))
        self.doc = doc

    @staticmethod
    def _filter(seed: np.ndarray) -> np.ndarray:
        bits = np.zeros(1 << _FILTER_BITS, bool)
        bits[seed >> U(64 - _FILTER_BITS)] = True
        return bits

    def search(self, w: Words) -> list[tuple[int, int, int, int, int, int]]:
        """(text, item, matches, aligned words, first word in the text, first word in the item) of what is found."""
        h = w.hashes()
        found = []
        for kind, (mask, (seed, place, bits)) in enumerate(zip(self.masks, self.tables)):
            at, own = _seeds(w.doc, h, mask, kind)
            maybe = bits[own >> U(64 - _FILTER_BITS)]
            at, own = at[maybe], own[maybe]
            lo, hi = np.searchsorted(seed, own, "left"), np.searchsorted(seed, own, "right")
            times = hi - lo
            if times.any():
                k = np.repeat(lo - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
                at, q = np.repeat(at, times), place[k]
                item, text = self.doc[q], w.doc[at]
                # the diagonal: where in the text the item's first word would lie
                found.append(np.stack((text, item, (at - w.first[text]) - (q - self.first[item]))))
        best: dict[tuple[int, int], tuple[int, int, int, int]] = {}
        if found:
            for text, item, shift in np.unique(np.concatenate(found, axis=1), axis=1).T.tolist():
                got = self._align(h, w, text, item, shift)
                if got[0] >= MIN_MATCHES or got[0] >= math.ceil(MIN_SHARE * self.n[item]):
                    best[text, item] = max(best.get((text, item), got), got)
        return [(*k, v[0], v[1], -v[2], -v[3]) for k, v in best.items()]

    def _align(self, h: np.ndarray, w: Words, text: int, item: int, shift: int) -> tuple[int, int, int, int]:
        """The best segment of one diagonal: (matches, words, -first word in the text, -first word in the item)."""
        lo, hi = max(0, -shift), min(int(self.n[item]), int(w.n[text]) - shift)
        a, b = self.first[item], w.first[text] + shift
        same = self.hashes[a + lo : a + hi] == h[b + lo : b + hi]
        score = np.concatenate(([0], np.cumsum(np.where(same, 1, MISMATCH))))
        matches = np.concatenate(([0], np.cumsum(same)))
        low = np.minimum.accumulate(score)
        # for each end, the first begin from where the score is not negative
        begins = np.minimum(np.searchsorted(-low, -score, "left"), np.arange(len(score)))
        end = int(np.argmax(matches - matches[begins]))
        inner = np.flatnonzero(same[begins[end] : end]) + begins[end]  # ends on matching words
        if not len(inner):
            return 0, 0, 0, 0
        begin, n = int(inner[0]), int(inner[-1] - inner[0]) + 1
        return len(inner), n, -(shift + lo + begin), -(lo + begin)


def not_searched(benchmark: DataFrame, id: str = "item_id", text: str = "text") -> DataFrame:
    """(id, n_words) of the items that ``overlaps`` and ``drop_leaks`` do not search: those of fewer than ``MIN_ITEM`` words, which are no evidence."""
    schema = T.StructType([T.StructField(id, benchmark.schema[id].dataType), T.StructField("n_words", T.LongType())])

    def one(b: pa.RecordBatch) -> pa.Table:
        n = [Words(offsets, LOWER[data], ALNUM).n for _, _, offsets, data in slices(b.column(1))]
        return pa.Table.from_arrays([b.column(0), pa.array(np.concatenate(n or [np.zeros(0)]).astype(np.int64))], names=schema.names)

    return map_batches(benchmark.select(F.col(id), F.col(text).cast("string").alias("_text")), one, schema).where(F.col("n_words") < MIN_ITEM)


def _blocks(benchmark: DataFrame, id: str, text: str):
    """The benchmark's rows in blocks that a task can hold; a block's expected size is fixed, their number grows."""
    rows = benchmark.select(F.col(id), F.col(text).cast("string").alias("_text"))
    words = rows.agg(F.sum(F.length("_text"))).first()[0] or 0
    n = max(1, math.ceil(words / 6 / BLOCK_WORDS))
    block = F.pmod(F.xxhash64(F.col(id).cast("string"), "_text"), F.lit(n))
    for k in range(n):
        yield rows.where(block == k).collect()


def _matcher(spark, texts: list[str | None]):
    """A function that gives the index in a worker process; it is built once there."""
    sent = spark.sparkContext.broadcast(texts)

    def get() -> Index:
        if not hasattr(sent, "_index"):
            sent._index = Index(sent.value)
        return sent._index

    return get


def overlaps(docs: DataFrame, benchmark: DataFrame, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """A row per document row and benchmark item whose text it holds.

    Columns: id, ``item_id``, n_matched, n_aligned, share (of the item's
    words), first_word (in the document, from 0), item_first_word.
    """
    out = None
    schema = T.StructType(
        [
            T.StructField(id, docs.schema[id].dataType),
            T.StructField("item_id", benchmark.schema[item_id].dataType),
            *(T.StructField(x, T.LongType()) for x in ("n_matched", "n_aligned")),
            T.StructField("share", T.DoubleType()),
            *(T.StructField(x, T.LongType()) for x in ("first_word", "item_first_word")),
        ]
    )
    slim = docs.select(F.col(id), F.col(text).cast("string").alias("_text"))
    for block in _blocks(benchmark, item_id, item_text):
        get = _matcher(docs.sparkSession, [r["_text"] for r in block])
        ids = [r[item_id] for r in block]

        def one(b: pa.RecordBatch, get=get, ids=ids) -> pa.Table:
            index, rows = get(), []
            for i, _, offsets, data in slices(b.column(1)):
                rows += [(x[0] + i, *x[1:]) for x in index.search(Words(offsets, LOWER[data], ALNUM))]
            text, item, matched, aligned, first, item_first = (list(c) for c in zip(*rows)) if rows else [[]] * 6
            long = pa.int64()
            share = [m / int(index.n[k]) for m, k in zip(matched, item)]
            cols = [b.column(0).take(pa.array(text, long)), pa.array([ids[k] for k in item]), pa.array(matched, long), pa.array(aligned, long), pa.array(share, pa.float64()), pa.array(first, long), pa.array(item_first, long)]
            return pa.Table.from_arrays(cols if rows else [c.cast(t) for c, t in zip(cols, (b.schema.types[0], long, long, long, pa.float64(), long, long))], names=schema.names)

        part = map_batches(slim, one, schema)
        out = part if out is None else out.unionByName(part)
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """The documents that hold no benchmark text, with their columns."""
    out = docs
    for block in _blocks(benchmark, item_id, item_text):
        get = _matcher(docs.sparkSession, [r["_text"] for r in block])

        def one(b: pa.RecordBatch, get=get) -> pa.RecordBatch:
            index, clean = get(), np.ones(b.num_rows, bool)
            for i, _, offsets, data in slices(b.column(text).cast(pa.string())):
                clean[[x[0] + i for x in index.search(Words(offsets, LOWER[data], ALNUM))]] = False
            return b.filter(pa.array(clean))

        out = map_batches(out, one, out.schema)
    return out
