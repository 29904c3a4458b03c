"""Substring dedup: suffix automata of reference shards, matching statistics, removal of repeated spans.

A window is ``WINDOW`` consecutive words of one document. A word goes when a
window covers it whose word sequence also starts earlier (smaller document id,
or the same document further left); windows are judged on the input.

Automata of all documents, sent to every task, would cost the square of the
corpus. So equal windows are first brought together by content, and automata
are built only where texts differ in part:

1. Each window names its anchor, the smallest hash of its ``GRAM``-word runs,
   very common runs last; equal windows name the same one. Consecutive windows
   with one anchor form a segment: (anchor, hash of the segment's words,
   document, first word, windows). Segments of one anchor meet in one
   partition, without their texts.
2. In a sorted pass, of segments with the same words all but the earliest are
   removed whole. The earliest ones are kept aside as references if their
   anchor has other segments too, or occurs again inside.
3. References get their texts. Anchors are packed into shards; a shard's suffix
   automaton is built, its segments stream through it for matching statistics,
   and every match of ``WINDOW`` words names the automaton's state, which is
   the same for equal windows: all but the earliest window of a state go.
   A shard beyond ``2 * SHARD`` segments (one anchor with many texts around it) is
   cut into single windows, which a hash of their words deals to automata of
   that size, so neither memory nor time grows faster than the segments.
4. Removed windows are gathered per document and cut out of its text.

Runs that a sample of the documents shows to be very common (a line that a
third of the documents hold) are anchors only of windows that have no other run;
such windows are salted over many partitions and combined in a second, small
step. The sample decides where rows go, not what is removed. Texts move twice,
compressed.

Null text: no words. A null id is one document before all others. Rows that
share an id are versions of one document: what goes at a word position goes in
each. Texts are taken whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import NO_ID, fresh, map_batches, materialize, pack_texts, unpack_texts
from cellar.llm.words import U, Words, mix, run_hashes, slices

WINDOW, GRAM = 20, 6
MAX_RUN = 64  # windows of a segment; below 128, see _at
SHARD = 2000
SALTS = 64
SAMPLE, HOT_LEAST, MAX_HOT = 0.01, 50, 10_000  # share of documents, occurrences of a run in it, runs taken
COMMON_BIT = U(1 << 63)  # of the anchors of windows that hold common runs only


# ---- anchors and segments ----------------------------------------------------


def _sliding_min(x: np.ndarray, k: int) -> np.ndarray:
    """Minimum of each k consecutive values."""
    size = 1
    while 2 * size <= k:
        x = np.minimum(x[:-size], x[size:])
        size *= 2
    return np.minimum(x[: len(x) - (k - size)], x[k - size :]) if size < k else x


class CommonRuns:
    """Membership of run hashes in a set of at most ``MAX_HOT``."""

    def __init__(self, hashes: np.ndarray):
        self.hashes = np.sort(hashes)
        self.maybe = np.zeros(1 << 20, bool)
        self.maybe[self.hashes >> U(44)] = True

    def priority(self, gram: np.ndarray) -> np.ndarray:
        """The hashes as anchors are compared: 63 bits, with ``COMMON_BIT`` for a common run."""
        out = gram >> U(1)
        some = np.flatnonzero(self.maybe[gram >> U(44)]) if len(self.hashes) else []
        if len(some):
            out[some[np.isin(gram[some], self.hashes)]] |= COMMON_BIT
        return out


def runs_of(w: Words) -> np.ndarray:
    """Hashes of all ``GRAM``-word runs, those across a text's border too (no window holds one)."""
    h = w.hashes()
    return run_hashes(h, np.arange(len(h) - GRAM + 1), np.arange(GRAM, len(h) + 1)) if len(h) >= GRAM else np.zeros(0, U)


def segments(w: Words, common: CommonRuns) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word, windows, anchor occurs again, anchor, hash of the words) of the segments of a slice's texts.

    Only where the anchor occurs again can a segment hold a window twice.
    """
    h = w.hashes()
    at = np.flatnonzero(w.doc[: len(h) - WINDOW + 1] == w.doc[WINDOW - 1 :]) if len(h) >= WINDOW else np.zeros(0, np.int64)
    if not len(at):
        return (np.zeros(0, np.int64),) * 4 + (np.zeros(0, U),) * 2
    gram = common.priority(run_hashes(h, np.arange(len(h) - GRAM + 1), np.arange(GRAM, len(h) + 1)))
    anchor = _sliding_min(gram, WINDOW - GRAM + 1)[at]
    new = np.ones(len(at), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)
    run = np.flatnonzero(new)
    place = np.arange(len(at)) - np.repeat(run, np.diff(np.append(run, len(at))))
    begin = np.flatnonzero(place % MAX_RUN == 0)
    n = np.diff(np.append(begin, len(at)))
    first, own = at[begin], anchor[begin]
    text = w.doc[first]
    seen = np.concatenate(([0], np.cumsum(gram[at] == anchor)))
    times = seen[begin + n] - seen[begin]
    for t in range(WINDOW - GRAM):
        times += gram[first + n + t] == own
    return text, first - w.first[text], n, times > 1, own, run_hashes(h, first, first + n + WINDOW - 1, other=True)


def _at(first: np.ndarray, n: np.ndarray, again: np.ndarray | int = 0) -> np.ndarray:
    """First word, whether the anchor occurs again, and windows of a segment in one number that sorts by the first word."""
    return first << 8 | (np.asarray(again, np.int64) << 7) | n


def _long(x: np.ndarray) -> pa.Array:
    return pa.array(x.view(np.int64))


def _anchors(docs: DataFrame, hot: np.ndarray) -> DataFrame:
    """A row per segment: h (the anchor), salt (0, but for a common anchor), c (hash of the words), doc, at."""
    names = ["h", "salt", "c", "doc", "at"]
    common = CommonRuns(hot)

    def one(b: pa.RecordBatch) -> pa.Table:
        ids, out = b.column(0).to_numpy(zero_copy_only=False), []
        for i, j, offsets, data in slices(b.column(1)):
            text, first, n, again, h, c = segments(Words(offsets, data), common)
            doc = ids[i:j][text]
            salt = np.where(h >= COMMON_BIT, mix(doc.view(U)) % U(SALTS) + U(1), U(0))
            out.append(pa.RecordBatch.from_arrays([_long(h), _long(salt), _long(c), pa.array(doc), pa.array(_at(first, n, again))], names=names))
        return pa.Table.from_batches(out)

    return map_batches(docs.select("_k", "_text"), one, "h bigint, salt bigint, c bigint, doc bigint, at bigint")


def _common_runs(docs: DataFrame) -> np.ndarray:
    """The most frequent runs of a sample of the documents (``MAX_HOT`` at most)."""

    def one(b: pa.RecordBatch) -> pa.Table:
        out = []
        for _, _, offsets, data in slices(b.column(0)):
            gram, n = np.unique(runs_of(Words(offsets, data)), return_counts=True)
            out.append(pa.RecordBatch.from_arrays([_long(gram), pa.array(n.astype(np.int64))], names=["g", "n"]))
        return pa.Table.from_batches(out)

    found = map_batches(docs.select("_text").sample(SAMPLE, seed=7), one, "g bigint, n bigint").groupBy("g").agg(F.sum("n").alias("n"))
    rows = found.where(F.col("n") >= HOT_LEAST).orderBy(F.desc("n"), "g").limit(MAX_HOT).collect()
    return np.array([r["g"] for r in rows], np.int64).view(U)


# ---- equal segments ------------------------------------------------------------

REMOVED, REFERENCE, COMMON = 0, 1, 2


def _equal_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (h, salt, c, doc, at): what goes, and the references. State is one row, so no group is held."""
    carry, carry_paired = None, False  # the last reference of the rows so far, and whether its anchor has others

    def rows(kind: np.ndarray, x: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(kind), *(pa.array(np.ascontiguousarray(x[:, k])) for k in (0, 2, 3, 4))], names=["kind", "h", "c", "doc", "at"])

    def references(x: np.ndarray) -> pa.RecordBatch:
        return rows(np.where(x[:, 1] > 0, COMMON, REFERENCE).astype(np.int8), x)

    for b in batches:
        if not b.num_rows:
            continue
        x = np.stack([c.to_numpy(zero_copy_only=False) for c in b.columns], axis=1)
        if carry is not None:
            x = np.concatenate((carry, x))
        new_h = np.ones(len(x), bool)
        new_h[1:] = (x[1:, :2] != x[:-1, :2]).any(axis=1)
        new_c = new_h.copy()
        new_c[1:] |= x[1:, 2] != x[:-1, 2]
        lead = np.flatnonzero(new_c)
        own = x[lead[np.cumsum(new_c) - 1]]
        later = (x[:, 3:] != own[:, 3:]).any(axis=1)  # a repeated row is not earlier than itself
        yield rows(np.full(later.sum(), REMOVED, np.int8), x[later])
        ref = x[lead]
        with_next = np.zeros(len(ref), bool)
        with_next[:-1] = (ref[1:, :2] == ref[:-1, :2]).all(axis=1)
        paired = with_next | (ref[:, 1] > 0) | (ref[:, 4] >> 7 & 1).astype(bool)
        paired[1:] |= with_next[:-1]
        paired[0] |= carry_paired
        yield references(ref[:-1][paired[:-1]])
        carry, carry_paired = ref[-1:], bool(paired[-1])
    if carry_paired:
        yield references(carry)


def _sort_out(docs: DataFrame) -> DataFrame:
    """Rows (kind, h, c, doc, at) of what goes and of the references; the first step is written to the shared folder."""
    keys = ["h", "salt"]
    dealt = _anchors(docs, _common_runs(docs)).repartition(*keys).sortWithinPartitions(*keys, "c", "doc", "at")
    found = materialize(dealt.mapInArrow(_equal_segments, "kind tinyint, h bigint, c bigint, doc bigint, at bigint"), "segments")
    # of a common anchor's salts, the earliest segment of each text stays a reference, the others go: at most SALTS rows each
    order = Window.partitionBy("h", "c").orderBy("doc", "at")
    second = found.where(F.col("kind") == COMMON).withColumn("lead", F.first(F.struct("doc", "at")).over(order)).withColumn("i", F.row_number().over(order))
    kind = F.when(F.col("i") == 1, REFERENCE).when(F.col("lead") != F.struct("doc", "at"), REMOVED)
    second = second.withColumn("kind", kind.cast("tinyint")).where("kind IS NOT NULL").select("kind", "h", "c", "doc", "at")
    return found.where(F.col("kind") != COMMON).unionByName(second)


# ---- suffix automata -----------------------------------------------------------


class SuffixAutomaton:
    """All substrings of the sequences added."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]

    def _state(self, length: int, link: int, edges: dict[int, int]) -> int:
        self.next.append(edges)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, p: int, c: int, q: int) -> int:
        """A copy of q for the shorter strings that reach it from p by c."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(c) == q:
            self.next[p][c] = copy
            p = self.link[p]
        return copy

    def add(self, sequence: list[int]) -> None:
        nexts, link, length = self.next, self.link, self.length
        last = 0
        for c in sequence:
            q = nexts[last].get(c)
            if q is not None:
                last = q if length[q] == length[last] + 1 else self._split(last, c, q)
                continue
            p, last = last, self._state(length[last] + 1, 0, {})
            while p >= 0 and c not in nexts[p]:
                nexts[p][c] = last
                p = link[p]
            if p >= 0:
                q = nexts[p][c]
                link[last] = q if length[q] == length[p] + 1 else self._split(p, c, q)

    def matches(self, sequence: list[int], size: int) -> Iterator[tuple[int, int]]:
        """Matching statistics cut at ``size``: (start, state) of each run of that many symbols which the automaton holds.

        Equal runs give the same state, different runs different ones.
        """
        nexts, link, length = self.next, self.link, self.length
        state = matched = 0
        for i, c in enumerate(sequence):
            while state and c not in nexts[state]:
                state = link[state]
                matched = length[state]
            if c in nexts[state]:
                state = nexts[state][c]
                matched += 1
                while length[link[state]] >= size:  # keep no more than the last ``size`` symbols
                    state = link[state]
                matched = min(matched, size) if length[state] >= size else matched
                if matched >= size:
                    yield i + 1 - size, state


Segment = tuple[int, int, bytes]  # document, first word, words


def repeated_windows(shard: list[Segment], size: int = WINDOW, most: int = 2 * SHARD) -> Iterator[tuple[int, int, int]]:
    """(document, first word, windows) of the runs of windows that start earlier in another place of the shard."""
    numbers: dict[bytes, int] = {}
    coded = [[numbers.setdefault(x, len(numbers)) for x in words.split()] for _, _, words in shard]
    if len(shard) <= most:
        gone = _later_windows([(doc, first, w) for (doc, first, _), w in zip(shard, coded)], size)
    else:
        # single windows; equal ones are dealt alike, whatever else is
        places = [(k, i) for k, w in enumerate(coded) for i in range(len(w) - size + 1)]
        n_parts = -(-len(places) // most)
        part = np.fromiter((hash(tuple(coded[k][i : i + size])) % n_parts for k, i in places), np.int64, len(places))
        order = np.argsort(part, kind="stable")
        gone = []
        for own in np.split(order, np.flatnonzero(np.diff(part[order])) + 1):
            windows = [(places[x], shard[places[x][0]]) for x in own.tolist()]
            gone += _later_windows([(doc, first + i, coded[k][i : i + size]) for (k, i), (doc, first, _) in windows], size)
    begin = end = None
    for doc, at in sorted(set(gone)):
        if begin is not None and begin[0] == doc and at == end + 1 and at - begin[1] < MAX_RUN:
            end = at
            continue
        if begin is not None:
            yield *begin, end - begin[1] + 1
        begin, end = (doc, at), at
    if begin is not None:
        yield *begin, end - begin[1] + 1


def _later_windows(texts: list[tuple[int, int, list[int]]], size: int) -> list[tuple[int, int]]:
    """(document, word) of the windows whose automaton state has an earlier window."""
    automaton = SuffixAutomaton()
    for _, _, words in texts:
        automaton.add(words)
    hits = [(state, doc, first + start) for doc, first, words in texts for start, state in automaton.matches(words, size)]
    earliest: dict[int, tuple[int, int]] = {}
    for state, doc, at in hits:
        if (doc, at) < earliest.get(state, (doc + 1, 0)):
            earliest[state] = (doc, at)
    return [(doc, at) for state, doc, at in hits if earliest[state] < (doc, at)]


def _match_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (h, doc, first, words) sorted by anchor; whole anchors are packed into shards."""

    def finish(shard: list) -> pa.RecordBatch:
        out = list(repeated_windows(shard, most=2 * SHARD))  # more only if one anchor has over SHARD segments
        doc, first, n = (np.array(c, np.int64) for c in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        return pa.RecordBatch.from_arrays([pa.array(doc), pa.array(_at(first, n))], names=["doc", "at"])

    shard, last = [], None
    for b in batches:
        for h, doc, first, words in zip(*(c.to_pylist() for c in b.columns)):
            if h != last and len(shard) >= SHARD:
                yield finish(shard)
                shard = []
            shard.append((doc, first, words))
            last = h
    if shard:
        yield finish(shard)


# ---- texts ---------------------------------------------------------------------


def _reference_texts(docs: DataFrame, references: DataFrame) -> DataFrame:
    """(h, doc, first, words) of the references."""
    wanted = references.groupBy(F.col("doc").alias("_k")).agg(F.collect_list(F.struct("h", "at")).alias("_want"))

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        texts, ids, want = unpack_texts(b.column("_z")), b.column("_k").to_pylist(), b.column("_want").to_pylist()
        out = []
        for i, j, offsets, data in slices(texts):
            w, raw = Words(offsets, data), data.tobytes()
            for d in range(j - i):
                base, n_words = int(w.first[d]), int(w.n[d])
                for x in want[i + d]:
                    first, n = x["at"] >> 8, x["at"] & 127
                    if first + n + WINDOW - 1 <= n_words:
                        out.append((x["h"], ids[i + d], first, raw[w.starts[base + first] : w.ends[base + first + n + WINDOW - 2]]))
        h, doc, first, words = (list(c) for c in zip(*out)) if out else [[]] * 4
        return pa.RecordBatch.from_arrays([pa.array(h, pa.int64()), pa.array(doc, pa.int64()), pa.array(first, pa.int64()), pa.array(words, pa.binary())], names=["h", "doc", "first", "words"])

    both = pack_texts(docs.select("_k", "_text")).join(wanted, "_k").select("_k", "_z", "_want")
    return map_batches(both, one, "h bigint, doc bigint, first bigint, words binary")


def repeated(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Runs of windows that go: doc (the id; ``NO_ID`` for a null one), at (first word * 256 + windows)."""
    slim = docs.select(F.coalesce(F.col(id).cast("bigint"), F.lit(NO_ID)).alias("_k"), F.col(text).cast("string").alias("_text"))
    found = _sort_out(slim)
    texts = _reference_texts(slim, found.where(F.col("kind") == REFERENCE))
    matched = texts.repartition("h").sortWithinPartitions("h").mapInArrow(_match_shards, "doc bigint, at bigint")
    return found.where(F.col("kind") == REMOVED).select("doc", "at").unionByName(matched)


def _marked(keyed: DataFrame) -> DataFrame:
    """Rows that have ``_k`` and ``_text``, with the text compressed as ``_z`` and the list ``_gone`` of the runs of windows that go."""
    runs = repeated(keyed, "_k", "_text").groupBy(F.col("doc").alias("_k")).agg(F.collect_list("at").alias("_gone"))
    return pack_texts(keyed).join(runs, "_k", "left")


def _gone_words(w: Words, gone: list[list[int] | None]) -> np.ndarray:
    """Mark the words that the runs cover."""
    cover = np.zeros(len(w.starts) + 1, np.int64)
    lists = [np.array(g or (), np.int64) for g in gone]
    text = np.repeat(np.arange(len(lists)), [len(g) for g in lists])
    at = np.concatenate(lists) if lists else np.zeros(0, np.int64)
    end = w.first[text + 1]
    begin = w.first[text] + (at >> 8)
    np.add.at(cover, np.minimum(begin, end), 1)
    np.subtract.at(cover, np.minimum(begin + (at & 127) + WINDOW - 1, end), 1)
    return np.cumsum(cover)[:-1] > 0


def digest(docs: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, n_words, n_removed, and the sha256 of the kept words joined by a space."""
    keyed = docs.select(F.col(id), F.coalesce(F.col(id).cast("bigint"), F.lit(NO_ID)).alias("_k"), F.col(text).cast("string").alias("_text"))
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("n_words", T.LongType()), T.StructField("n_removed", T.LongType()), T.StructField("kept_sha256", T.StringType())])

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        gone, n_words, n_gone, sha = b.column("_gone").to_pylist(), [], [], []
        for i, j, offsets, data in slices(unpack_texts(b.column("_z"))):
            w, raw = Words(offsets, data), data.tobytes()
            out = _gone_words(w, gone[i:j])
            for d in range(j - i):
                mine = out[w.first[d] : w.first[d + 1]]
                words, n = raw[offsets[d] : offsets[d + 1]].split(), int(mine.sum())
                if n:
                    words = [x for x, m in zip(words, mine.tolist()) if not m]
                n_words.append(len(mine))
                n_gone.append(n)
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
        return pa.RecordBatch.from_arrays([b.column(id), pa.array(n_words, pa.int64()), pa.array(n_gone, pa.int64()), pa.array(sha, pa.string())], names=schema.names)

    return map_batches(_marked(keyed), one, schema)


def remove(docs: DataFrame, id: str = "doc_id", text: str = "text", chars: str = "n_chars") -> DataFrame:
    """The documents with the repeated words, and the white space after each, cut out of their texts.

    Other columns stay; ``chars``, where there is such a column, gets the new
    length. A document that loses every word stays, with an empty text.
    """
    whole = fresh(docs, "_row")
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text]).alias(whole), F.coalesce(F.col(id).cast("bigint"), F.lit(NO_ID)).alias("_k"), F.col(text).cast("string").alias("_text"))
    marked = _marked(keyed)
    schema = T.StructType([keyed.schema[whole], T.StructField("_text", T.StringType())])

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        gone, out = b.column("_gone").to_pylist(), []
        missing = b.column("_z").is_null().to_pylist()
        for i, j, offsets, data in slices(unpack_texts(b.column("_z"))):
            w = Words(offsets, data)
            cut = np.flatnonzero(_gone_words(w, gone[i:j]))
            edge = np.zeros(len(data) + 1, np.int64)
            following = np.minimum(np.append(w.starts[1:], len(data))[cut], offsets[w.doc[cut] + 1])
            np.add.at(edge, w.starts[cut], 1)
            np.subtract.at(edge, following, 1)
            keep = np.cumsum(edge)[:-1] == 0
            left = np.concatenate(([0], np.cumsum(keep)))[offsets]
            raw = data[keep].tobytes()
            out += [None if missing[i + d] else raw[left[d] : left[d + 1]].decode() for d in range(j - i)]
        return pa.RecordBatch.from_arrays([b.column(whole), pa.array(out, pa.string())], names=schema.names)

    done = map_batches(marked, one, schema)
    new = {text: F.col("_text").cast(docs.schema[text].dataType)}
    if chars in docs.columns:
        new[chars] = F.length("_text").cast(docs.schema[chars].dataType)
    return done.select(*[new[c].alias(c) if c in new else F.col(f"{whole}.`{c}`") for c in docs.columns])
