"""N-gram Jaccard join with Bayesian candidate pruning.

Two texts are linked when their sets of ``GRAM``-word shingles have a Jaccard
similarity of ``threshold`` or more.

1. Texts with the same words in the same order are one class; its smallest id
   stands for it from here on, so copies are never paired.
2. ``HASHES`` MinHash values per class, ``ROWS`` to a band: a pair at 0.8 shares
   no band with probability (1 - 0.8 ** 4) ** 32 = 5e-8. Classes that share a
   band are joined to the band's smallest class (not to each other), and
   connected components of these edges hold all candidates.
3. A component is compared in one unit, if its texts are no more than
   ``UNIT_BYTES`` and ``UNIT_DOCS`` documents. A larger one whose bands hold
   fewer pairs than itself (texts that chain together) is compared band by band,
   and a pair is judged in the first band it shares only; one whose bands hold
   more (near copies of one text) is compared as a whole, once. What is beyond
   the sizes of a unit is cut into blocks that are compared pair by pair of
   blocks, so the pairs of a task are bounded as well as its bytes.
4. In a unit, the MinHash values of a pair are compared ``STEP`` at a time. With
   k of n equal and a uniform prior, the similarity is Beta(k + 1, n - k + 1);
   the pair is dropped when the probability of reaching the threshold falls
   below ``tolerance``. The rest is verified with exact sets. What leaves a
   unit is a row per document: its number of links and one link of a spanning
   forest. No pairs are written.
5. Connected components of the forests are the near-duplicate classes.

A text of one to ``GRAM`` - 1 words is linked with its copies only; texts
without words are linked with nothing. A null id is one document. Repeated rows
count as documents; rows that share an id but not the text link what either
links. Texts are taken whole.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cellar.llm.common import NO_ID, map_batches, materialize, pack_texts, unpack_texts
from cellar.llm.components import connected_components
from cellar.llm.words import U, Words, mix, slices

GRAM = 5
HASHES, ROWS, STEP = 128, 4, 16
UNIT_BYTES, UNIT_DOCS = 8 << 20, 1024
_XOR = mix(np.arange(1, HASHES + 1, dtype=U) * U(0xA0761D6478BD642F))
_TIMES = mix(_XOR) | U(1)
_ROW = mix(np.arange(1, ROWS + 1, dtype=U)) | U(1)


# ---- shingles and MinHash values ------------------------------------------------


def _minhash(shingles: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """HASHES values for each run of shingles that begins at ``starts``."""
    out = np.empty((len(starts), HASHES), U)
    for k in range(HASHES):
        out[:, k] = np.minimum.reduceat((shingles ^ _XOR[k]) * _TIMES[k], starts)
    return out


def _bands(minhash: np.ndarray) -> np.ndarray:
    """A key for each band; keys of different bands differ."""
    parts = (minhash.reshape(len(minhash), HASHES // ROWS, ROWS) * _ROW).sum(axis=2, dtype=U)
    return mix(parts + mix(np.arange(1, HASHES // ROWS + 1, dtype=U)))


def _digests(offsets: np.ndarray, data: np.ndarray) -> np.ndarray:
    """Two numbers a text: a cryptographic digest of its words joined by one space."""
    raw = data.tobytes()
    texts = (b" ".join(raw[i:j].split()) for i, j in zip(offsets.tolist(), offsets[1:].tolist()))  # white space of bytes is that of words
    return np.frombuffer(b"".join(hashlib.blake2b(t, digest_size=16).digest() for t in texts), np.int64).reshape(-1, 2).copy()


def _signatures(docs: DataFrame) -> DataFrame:
    """(doc, s1, s2, n, size, bands): a 128-bit digest of the word sequence, its words, the text's bytes, band keys."""

    def one(b: pa.RecordBatch) -> pa.Table:
        out = []
        for i, j, offsets, data in slices(b.column("_text")):
            w = Words(offsets, data)
            h = w.hashes()
            s1, s2 = _digests(offsets, data).T
            at, g = w.ngrams(h, GRAM)
            doc = w.doc[at]
            starts = np.flatnonzero(np.diff(doc, prepend=-1))
            has = np.zeros(w.n_docs, np.int64)
            bands = np.zeros(0, np.int64)
            if len(starts):
                has[doc[starts]] = HASHES // ROWS
                bands = _bands(_minhash(g, starts)).view(np.int64).ravel()
            lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(has))), pa.int32()), pa.array(bands))
            size = np.diff(offsets)
            out.append(pa.RecordBatch.from_arrays([b.column("_k")[i:j], pa.array(s1), pa.array(s2), pa.array(w.n.astype(np.int64)), pa.array(size), lists], names=["doc", "s1", "s2", "n", "size", "bands"]))
        return pa.Table.from_batches(out)

    return map_batches(docs, one, "doc bigint, s1 bigint, s2 bigint, n bigint, size bigint, bands array<bigint>")


# ---- units ------------------------------------------------------------------------


def _units(reps: DataFrame) -> DataFrame:
    """(doc, unit, band, i, j, block): where each candidate is compared; band is -1 for a whole component."""
    rows = reps.select("doc", "size", F.posexplode("bands").alias("band", "key"))
    shared = rows.groupBy("key").agg(F.min("doc").alias("least"), F.count(F.lit(1)).alias("n")).where("n > 1").select("key", "least")
    meet = rows.join(shared, "key").select("doc", "least", "key", "band", "size")
    parts = materialize(connected_components(meet.select(F.col("doc").alias("a"), F.col("least").alias("b"))), "candidate-components")
    sized = parts.join(reps.select(F.col("doc").alias("node"), "size"), "node")
    whole = sized.groupBy("root").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"))
    whole = whole.select("root", "n", _blocks("bytes", "n").alias("blocks"))
    sized = materialize(sized.join(whole, "root").select(F.col("node").alias("doc"), "root", "n", "blocks"), "candidate-units")
    zero = F.lit(0).cast("bigint")
    units = sized.where("blocks = 1").select("doc", F.col("root").alias("unit"), F.lit(-1).alias("band"), zero.alias("i"), zero.alias("j"), zero.alias("block"))
    if sized.where("blocks > 1").limit(1).count():
        banded = meet.join(sized.where("blocks > 1").select("doc", "root", F.col("n").alias("n_root")), "doc")
        keys = banded.groupBy("root", "n_root", "key", "band").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n")).where("n > 1")
        dense = keys.groupBy("root", "n_root").agg(F.sum(F.col("n") * F.col("n")).alias("pairs")).where("pairs >= n_root * n_root").select("root")
        dense = materialize(dense, "dense-components")
        whole = sized.where("blocks > 1").join(dense, "root", "left_semi").select("doc", F.col("root").alias("unit"), F.lit(-1).alias("band"), "blocks")
        sparse = keys.join(dense, "root", "left_anti").select("key", _blocks("bytes", "n").alias("blocks"))
        bands = banded.join(sparse, "key").select("doc", F.col("key").alias("unit"), "band", "blocks")
        block = F.pmod(F.xxhash64("doc"), F.col("blocks"))
        other = F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("blocks") - 1))
        cut = whole.unionByName(bands).select("doc", "unit", "band", block.alias("block"), other.alias("other"))
        units = units.unionByName(cut.select("doc", "unit", "band", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block"))
    return units


def _blocks(size: str, n: str):
    return F.greatest(F.ceil(F.col(size) / UNIT_BYTES), F.ceil(F.col(n) / UNIT_DOCS))


# ---- pairs of a unit ---------------------------------------------------------------


def _least_equal(threshold: float, tolerance: float) -> list[int]:
    """For n = STEP, 2 * STEP, ...: the fewest equal values with P(similarity >= threshold) >= tolerance.

    P(Beta(k + 1, n - k + 1) >= t) = P(Binomial(n + 1, t) <= k).
    """
    out = []
    for n in range(STEP, HASHES + 1, STEP):
        total, k = 0.0, -1
        while total < tolerance:
            k += 1
            total += math.comb(n + 1, k) * threshold**k * (1 - threshold) ** (n + 1 - k)
        out.append(k)
    return out


class Unit:
    """Documents of one unit: ids, copies, blocks, shingle sets (sorted, flat), MinHash values."""

    def __init__(self, sets: list[np.ndarray], minhash: np.ndarray, copies: np.ndarray, block: np.ndarray):
        self.sizes = np.array([len(s) for s in sets])
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))
        known, flat = np.unique(np.concatenate(sets), return_inverse=True)
        self.flat, self.mark = flat, np.zeros(len(known), bool)
        self.minhash, self.copies, self.block = minhash, copies, block

    def _overlaps(self, i: int, others: np.ndarray) -> np.ndarray:
        own = self.flat[self.first[i] : self.first[i + 1]]
        sizes = self.sizes[others]
        begin = np.concatenate(([0], np.cumsum(sizes)[:-1]))
        at = np.arange(sizes.sum()) + np.repeat(self.first[others] - begin, sizes)
        self.mark[own] = True
        out = np.add.reduceat(self.mark[self.flat[at]].astype(np.int64), begin)
        self.mark[own] = False
        return out

    def links(self, i: int, band: int, cross: bool, threshold: Fraction, least_equal: list[int]) -> np.ndarray:
        """The later documents (of the other block, if ``cross``) that document i is linked with."""
        a, b = threshold.numerator, threshold.denominator
        others = np.arange(i + 1, len(self.sizes))
        n = self.sizes[others]
        others = others[(np.minimum(n, self.sizes[i]) * b >= np.maximum(n, self.sizes[i]) * a) & (not cross or self.block[others] != self.block[i])]
        equal = np.zeros(len(others), np.int64)
        for k, need in enumerate(least_equal):
            if not len(others):
                return others
            cols = slice(k * STEP, (k + 1) * STEP)
            equal += (self.minhash[others, cols] == self.minhash[i, cols]).sum(axis=1)
            others, equal = others[equal >= need], equal[equal >= need]
        if band >= 0 and len(others):  # shares this band, and none before it
            same = (self.minhash[others] == self.minhash[i]).reshape(len(others), -1, ROWS).all(axis=2)
            others = others[same[:, band] & ~same[:, :band].any(axis=1)]
        if not len(others):
            return others
        both = self._overlaps(i, others)
        return others[both * b >= (self.sizes[others] + self.sizes[i] - both) * a]


def _unite(label: np.ndarray, i: int, found: np.ndarray) -> None:
    """Give document i, those found and all that hang together with them the smallest of their labels."""
    roots = np.unique(label[found])
    if len(roots) > 1 or roots[0] != label[i]:
        roots = np.union1d(roots, label[i])
        label[np.isin(label, roots)] = roots[0]


def _compare(threshold: float, tolerance: float):
    """mapInArrow function over rows sorted by unit, band, i, j: (doc, links, other) of the documents with links."""
    exact, least_equal = Fraction(str(threshold)), _least_equal(threshold, tolerance)

    def finish(rows: list[pa.RecordBatch]) -> pa.RecordBatch:
        t = pa.Table.from_batches(rows)
        t = t.combine_chunks()
        texts = unpack_texts(t.column("_z").combine_chunks())
        keys = np.stack([t.column(c).to_numpy() for c in ("unit", "band", "i", "j")], axis=1)
        docs, copies, block = (t.column(c).to_numpy() for c in ("doc", "copies", "block"))
        sets, minhash = [], []
        for _, _, offsets, data in slices(texts):
            w = Words(offsets, data)
            at, g = w.ngrams(w.hashes(), GRAM)
            edge = np.searchsorted(w.doc[at], np.arange(w.n_docs + 1))
            sets += [np.unique(g[edge[d] : edge[d + 1]]) for d in range(w.n_docs)]
            values = np.zeros((w.n_docs, HASHES), U)
            full = np.flatnonzero(np.diff(edge))
            if len(full):
                values[full] = _minhash(g, edge[full])
            minhash.append(values)
        minhash = np.concatenate(minhash)
        out = []
        begin = np.flatnonzero(np.concatenate(([True], (keys[1:] != keys[:-1]).any(axis=1))))
        for lo, hi in zip(begin.tolist(), [*begin[1:].tolist(), len(keys)]):
            _, band, i, j = keys[lo].tolist()
            have = [k for k in range(lo, hi) if len(sets[k])]
            if len(have) < 2:
                continue
            unit = Unit([sets[k] for k in have], minhash[have], copies[have], block[have])
            links, label = np.zeros(len(have), np.int64), np.arange(len(have))
            for k in range(len(have) - 1):
                found = unit.links(k, band, i != j, exact, least_equal)
                if len(found):
                    links[k] += unit.copies[found].sum()
                    links[found] += unit.copies[k]
                    _unite(label, k, found)
            out += [(docs[have[k]], links[k], docs[have[label[k]]]) for k in np.flatnonzero(links).tolist()]
        cols = list(zip(*out)) if out else [[]] * 3
        return pa.RecordBatch.from_arrays([pa.array(np.array(c, np.int64)) for c in cols], names=["doc", "links", "other"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, last = [], 0, None  # whole units; cut where a new one begins, once there is enough
        for b in batches:
            if not b.num_rows:
                continue
            keys = np.stack([b.column(k).to_numpy() for k in (0, 1, 2, 3)], axis=1)
            z = np.cumsum([len(x) for x in b.column("_z").to_pylist()])
            new = np.ones(len(keys), bool)
            new[1:] = (keys[1:] != keys[:-1]).any(axis=1)
            new[0] = last is None or (keys[0] != last).any()
            done = 0
            for at in np.flatnonzero(new).tolist():
                here = size + int(z[at - 1] if at else 0) - int(z[done - 1] if done else 0)
                if here >= HELD_BYTES:
                    held.append(b.slice(done, at - done))
                    if rows := [x for x in held if x.num_rows]:
                        yield finish(rows)
                    held, size, done = [], 0, at
            held.append(b.slice(done))
            size += int(z[-1]) - int(z[done - 1] if done else 0)
            last = keys[-1]
        if rows := [x for x in held if x.num_rows]:
            yield finish(rows)

    return run


HELD_BYTES = 1 << 20  # compressed
TASK_PAIRS, MAX_TASKS = 1 << 21, 100_000  # a task compares about so many pairs; there are no more tasks than that


def near_duplicates(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = 0.8, tolerance: float = 1e-6) -> DataFrame:
    """One row per document row: id, class_id (smallest id of the near-duplicate class), n_links (other documents within the threshold, copies included), copy_of (smallest id with the same words), n_copies."""
    slim = docs.select(F.coalesce(F.col(id).cast("bigint"), F.lit(NO_ID)).alias("_k"), F.col(text).cast("string").alias("_text"))
    signed = materialize(_signatures(slim), "signatures")
    classes = signed.where("n > 0").groupBy("s1", "s2").agg(F.min("doc").alias("rep"), F.count(F.lit(1)).alias("copies"), F.first("size").alias("size"), F.first("bands").alias("bands"))
    classes = materialize(classes, "copy-classes")
    reps = classes.where(F.size("bands") > 0).select(F.col("rep").alias("doc"), "copies", "size", "bands")
    units = materialize(_units(reps), "units")
    where = units.join(reps.select("doc", "copies"), "doc").groupBy(F.col("doc").alias("_k")).agg(F.collect_list(F.struct("unit", "band", "i", "j", "block", "copies")).alias("u"))
    texts = pack_texts(slim).join(where, "_k").select(F.col("_k").alias("doc"), "_z", F.explode("u").alias("u"))
    rows = texts.select("u.unit", "u.band", "u.i", "u.j", "u.block", "u.copies", "doc", "_z")
    keys = ["unit", "band", "i", "j"]
    # dealt by the pairs to compare: coalesced by bytes, many short texts would meet in one task
    pairs = units.groupBy(*keys).count().agg(F.sum(F.col("count") * F.col("count"))).first()[0] or 0
    tasks = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(math.ceil(pairs / TASK_PAIRS), MAX_TASKS))
    compared = rows.repartition(tasks, *keys).sortWithinPartitions(*keys).mapInArrow(_compare(threshold, tolerance), "doc bigint, links bigint, other bigint")
    compared = materialize(compared, "near-links")
    links = compared.groupBy(F.col("doc").alias("rep")).agg(F.sum("links").alias("links"))
    groups = connected_components(compared.select(F.col("doc").alias("a"), F.col("other").alias("b"))).select(F.col("node").alias("rep"), "root")
    known = classes.select("s1", "s2", "rep", "copies").join(links, "rep", "left").join(groups, "rep", "left")
    own = signed.select("doc", F.when(F.col("n") > 0, F.col("s1")).alias("s1"), "s2")
    out = own.join(known, ["s1", "s2"], "left")
    real = lambda c: F.when(c != NO_ID, c).cast(docs.schema[id].dataType)
    return out.select(
        real(F.col("doc")).alias(id),
        real(F.coalesce("root", "rep", "doc")).alias("class_id"),
        (F.coalesce("links", F.lit(0)) + F.coalesce(F.col("copies") - 1, F.lit(0))).cast("bigint").alias("n_links"),
        real(F.coalesce("rep", "doc")).alias("copy_of"),
        F.coalesce("copies", F.lit(1)).cast("bigint").alias("n_copies"),
    )
