"""Ranked lexical search of many queries at once, with shared sums.

Terms are maximal runs of digits, letters and characters beyond ASCII, A-Z in
lower case. Scores follow the saturating term-frequency formula of the query
contract in whole numbers, so they do not depend on the order of summing.

1. One pass over the documents counts, per document, the terms that any item
   uses (``_counted``); the result is written once to the shared folder. Number
   and length of the documents and the document frequencies are aggregates of it.
2. Items share sums (``Sharing``): the pair of terms that most items have in
   common becomes a node, and so on with nodes and terms, until no pair is in
   two items. An item is a sum of few nodes, a node a sum of two others.
3. Per batch of documents every node's accumulator is made once, from the terms
   up, and the items add up theirs. A task keeps the best ``k`` per item, so what
   is shuffled is bounded by items and tasks, not by documents.

Items are dealt by hash to blocks of about ``BLOCK_TERMS`` terms; each block is
a pass of its own, and only a block's terms and nodes are sent to the tasks.

Null texts have no terms. A document without terms is not counted and never
ranked; an item without terms, or without a matching document, has no rows, and
empty tables give no rows. Rows that share an item id are one item with the
terms of all of them. Repeated document rows are documents of their own. Equal
scores go by ascending document id, null first. Texts are taken whole; other
columns are ignored.
"""

from __future__ import annotations

import heapq
import itertools
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import NO_ID, map_batches, materialize
from cellar.llm.words import ALNUM, LOWER, Words, slices, span_hashes

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
TO_LOWER = {c: c + 32 for c in range(0x41, 0x5B)}
BLOCK_TERMS = 100_000
DOCS = 256  # documents whose accumulators are held at a time
ITEMS = 256  # items that are added up at a time
MAX_SHARED = 64  # terms of an item that the search for pairs looks at; steers only how much is shared


# ---- terms of documents -------------------------------------------------------------


class Vocabulary:
    """Finds the words of a slice that are in a list; hashes find candidates, bytes confirm them."""

    def __init__(self, terms: list[str]):
        raw = [t.encode() for t in terms]
        self.sizes = np.array([len(r) for r in raw], np.int64)
        self.first = np.concatenate(([0], np.cumsum(self.sizes)))[:-1]
        self.bytes = np.frombuffer(b"".join(raw), np.uint8)
        ends = self.first + self.sizes
        h = span_hashes(self.bytes, self.first, ends)
        order = np.argsort(h, kind="stable")
        self.layers = []  # terms of one hash go to different layers
        while len(order):
            new = np.concatenate(([True], h[order[1:]] != h[order[:-1]]))
            self.layers.append((h[order[new]], order[new]))
            order = order[~new]

    def find(self, w: Words) -> tuple[np.ndarray, np.ndarray]:
        """(number of the word, number of its term) of the words in the list."""
        h, sizes = w.hashes(), w.ends - w.starts
        words, terms = [], []
        for known, term in self.layers:
            at = np.searchsorted(known, h)
            at[at == len(known)] = 0
            hit = np.flatnonzero(known[at] == h)
            t = term[at[hit]]
            same = sizes[hit] == self.sizes[t]
            hit, t = hit[same], t[same]
            ok, rest = np.ones(len(hit), bool), np.arange(len(hit))
            k = 0
            while len(rest):  # byte by byte, over the words that have that many
                ok[rest] &= w.data[w.starts[hit[rest]] + k] == self.bytes[self.first[t[rest]] + k]
                k += 1
                rest = rest[ok[rest] & (self.sizes[t[rest]] > k)]
            words.append(hit[ok])
            terms.append(t[ok])
        return np.concatenate(words or [np.zeros(0, np.int64)]), np.concatenate(terms or [np.zeros(0, np.int64)])


def _counted(docs: DataFrame, terms: list[str]) -> DataFrame:
    """(doc, n, terms, times) of the documents that have terms: all their terms counted in n, those of the list one by one."""

    def one(b: pa.RecordBatch) -> pa.Table:
        vocabulary, out = Vocabulary(terms), []
        for i, j, offsets, data in slices(b.column("_text")):
            w = Words(offsets, LOWER[data], ALNUM)
            word, term = vocabulary.find(w)
            keys, times = np.unique(w.doc[word] * len(terms) + term, return_counts=True)
            doc, term = np.divmod(keys, max(len(terms), 1))
            ends = pa.array(np.searchsorted(doc, np.arange(w.n_docs + 1)), pa.int32())
            cols = [b.column("doc")[i:j], pa.array(w.n.astype(np.int64)), pa.ListArray.from_arrays(ends, pa.array(term, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(times, pa.int32()))]
            out.append(pa.RecordBatch.from_arrays(cols, names=["doc", "n", "terms", "times"]).filter(pa.array(w.n > 0)))
        return pa.Table.from_batches(out)

    return map_batches(docs, one, "doc bigint, n bigint, terms array<int>, times array<int>")


# ---- sums that items share ----------------------------------------------------------


class Sharing:
    """A directed acyclic graph of sums: leaves (term, times), nodes that add two others, items that add a few.

    ``leaves`` come first in the numbering, nodes follow in an order in which both
    parts of a node are known before it.
    """

    def __init__(self, items: list[dict[int, int]]):
        self.leaves = sorted({x for item in items for x in item.items()})
        number = {x: i for i, x in enumerate(self.leaves)}
        self.items = [{number[x] for x in item.items()} for item in items]
        self.nodes: list[tuple[int, int]] = []
        where: dict[int, set[int]] = {}
        for i, parts in enumerate(self.items):
            for p in parts:
                where.setdefault(p, set()).add(i)
        pairs: Counter[tuple[int, int]] = Counter()
        looked: list[set[int]] = []
        for parts in self.items:
            shared = sorted((p for p in parts if len(where[p]) > 1), key=lambda p: (-len(where[p]), p))[:MAX_SHARED]
            looked.append(set(shared))
            pairs.update(itertools.combinations(sorted(shared), 2))
        heap = [(-n, pair) for pair, n in pairs.items() if n > 1]
        heapq.heapify(heap)
        del pairs
        while heap:
            n, (a, b) = heapq.heappop(heap)
            both = where[a] & where[b]
            if len(both) < 2:
                continue
            if len(both) < -n:  # earlier nodes have taken some of them
                heapq.heappush(heap, (-len(both), (a, b)))
                continue
            node = len(self.leaves) + len(self.nodes)
            self.nodes.append((a, b))
            where[node] = both
            for p in (a, b):
                where[p] = where[p] - both
            near: Counter[int] = Counter()
            for i in both:
                self.items[i] -= {a, b}
                looked[i] -= {a, b}
                near.update(looked[i])
                self.items[i].add(node)
                looked[i].add(node)
            for p, m in near.items():
                if m > 1:
                    heapq.heappush(heap, (-m, (p, node)))

    def sums(self) -> int:
        """Additions for one document: one a node, and one less than its parts an item."""
        return len(self.nodes) + sum(len(p) - 1 for p in self.items)


class Scores:
    """Scores of every item for a few documents."""

    def __init__(self, sharing: Sharing, weights: np.ndarray, n_docs: int, length: int):
        self.weights, self.n_docs, self.length = weights, n_docs, length
        self.leaf_term, self.leaf_times = (np.array(x, np.int64) for x in zip(*sharing.leaves))
        self.nodes, self.n_items = sharing.nodes, len(sharing.items)
        parts = [sorted(p) for p in sharing.items]  # no item without terms comes here
        self.parts, self.first = np.concatenate([np.array(p, np.int64) for p in parts]), np.concatenate(([0], np.cumsum([len(p) for p in parts])))

    def blocks(self, n: np.ndarray, doc: np.ndarray, term: np.ndarray, times: np.ndarray) -> Iterator[tuple[int, np.ndarray]]:
        """(first item, scores) for runs of items; ``doc`` numbers the documents of lengths ``n`` from 0."""
        m = 75 + (25 * n * self.n_docs) // self.length
        acc = np.zeros((len(self.weights), len(n)), np.int64)
        acc[term, doc] = self.weights[term] * ((1_000_000_000 * times) // (1000 * times + 12 * m[doc]))
        sums = np.empty((len(self.leaf_term) + len(self.nodes), len(n)), np.int64)
        sums[: len(self.leaf_term)] = acc[self.leaf_term] * self.leaf_times[:, None]
        for k, (a, b) in enumerate(self.nodes, len(self.leaf_term)):
            np.add(sums[a], sums[b], out=sums[k])
        for lo in range(0, self.n_items, ITEMS):
            hi = min(lo + ITEMS, self.n_items)
            at = self.first[lo : hi + 1]
            yield lo, np.add.reduceat(sums[self.parts[at[0] : at[-1]]], at[:-1] - at[0], axis=0)


class Best:
    """The k best documents of each item so far."""

    def __init__(self, n_items: int, k: int):
        self.k, self.least = k, np.ones(n_items, np.int64)  # scores below cannot enter
        self.held = np.zeros((3, 0), np.int64)  # item, score, document
        self.new: list[np.ndarray] = []
        self.size = 0

    def add(self, item: np.ndarray, score: np.ndarray, doc: np.ndarray) -> None:
        self.new.append(np.stack([item, score, doc]))
        self.size += len(item)
        if self.size > max(1 << 16, 2 * self.k * len(self.least)):
            self.cut()

    def cut(self) -> np.ndarray:
        every = np.concatenate([self.held, *self.new], axis=1)
        every = every[:, np.lexsort((every[2], -every[1], every[0]))]
        edge = np.searchsorted(every[0], np.arange(len(self.least) + 1))
        rank = np.arange(every.shape[1]) - edge[every[0]]
        full = np.flatnonzero(np.diff(edge) >= self.k)
        self.least[full] = every[1, edge[full] + self.k - 1]
        self.held, self.new, self.size = every[:, rank < self.k], [], 0
        return self.held


def _ranked(counted: DataFrame, scores: Scores, ids: list, id_type: T.DataType, item_id: str, doc_id: str, k: int) -> DataFrame:
    """(item, doc, score): each task's best k of every item."""
    schema = T.StructType([T.StructField(item_id, id_type), T.StructField(doc_id, T.LongType()), T.StructField("score", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = Best(scores.n_items, k)
        for whole in batches:
            for lo in range(0, whole.num_rows, DOCS):
                b = whole.slice(lo, DOCS)
                ids_, n = b.column("doc").to_numpy(), b.column("n").to_numpy()
                lists, times = b.column("terms"), b.column("times").flatten().to_numpy().astype(np.int64)
                doc = np.repeat(np.arange(b.num_rows), lists.value_lengths().to_numpy())
                for first, s in scores.blocks(n, doc, lists.flatten().to_numpy(), times):
                    item, at = np.nonzero(s >= best.least[first : first + len(s), None])
                    best.add(item + first, s[item, at], ids_[at])
        item, score, doc = best.cut()
        yield pa.RecordBatch.from_arrays([pa.array([ids[i] for i in item.tolist()]).cast(b_type), pa.array(doc), pa.array(score)], names=schema.names)

    b_type = pa.int64() if isinstance(id_type, T.LongType) else pa.int32() if isinstance(id_type, T.IntegerType) else pa.string()
    return counted.mapInArrow(run, schema)


# ---- the operator ---------------------------------------------------------------------


def _weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def search(docs: DataFrame, items: DataFrame, k: int = 20, id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of each item."""
    spark = docs.sparkSession
    id_type = items.schema[item_id].dataType
    if not isinstance(id_type, (T.LongType, T.IntegerType)):
        id_type = T.StringType()
    slim = docs.select(F.coalesce(F.col(id).cast("bigint"), F.lit(NO_ID)).alias("doc"), F.col(text).cast("string").alias("_text"))
    asked = items.select(F.col(item_id).cast(id_type).alias("item"), F.coalesce(F.col(item_text).cast("string"), F.lit("")).alias("_text"))
    # a term has a byte at least, so a block's bytes bound its terms
    size = asked.agg(F.coalesce(F.sum(F.octet_length("_text")), F.lit(0))).first()[0]
    n_blocks = max(1, math.ceil(size / (8 * BLOCK_TERMS)))
    found = spark.createDataFrame([], T.StructType([T.StructField(item_id, id_type), T.StructField(id, T.LongType()), T.StructField("score", T.LongType())]))
    for block in range(n_blocks):
        rows = asked.where(F.pmod(F.xxhash64("item"), F.lit(n_blocks)) == block).collect()  # about 8 * BLOCK_TERMS bytes
        wanted: dict = {}
        for r in rows:
            wanted.setdefault(r["item"], Counter()).update(TERM.findall(r["_text"].translate(TO_LOWER)))
        wanted = {i: c for i, c in wanted.items() if c}
        if not wanted:
            continue
        terms = sorted(set().union(*wanted.values()))
        counted = materialize(_counted(slim, terms), "term-counts")
        n_docs, length = counted.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            break
        df = np.zeros(len(terms), np.int64)
        for r in counted.select(F.explode("terms").alias("term")).groupBy("term").count().collect():  # a row per term of the block
            df[r["term"]] = r["count"]
        number = {t: i for i, t in enumerate(terms)}
        sharing = Sharing([{number[t]: c for t, c in wanted[i].items()} for i in wanted])
        scores = Scores(sharing, np.array([_weight(n_docs, d) for d in df.tolist()], np.int64), n_docs, length)
        part = _ranked(counted, scores, list(wanted), id_type, item_id, id, k)
        found = part if n_blocks == 1 else found.unionByName(materialize(part, "ranked-block"))
    order = Window.partitionBy(item_id).orderBy(F.col("score").desc(), F.col(id))
    top = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return top.select(item_id, F.col("rank").cast("int").alias("rank"), F.when(F.col(id) != NO_ID, F.col(id)).alias(id), "score")
