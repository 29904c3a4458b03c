"""Toxicity by a subsequence string kernel and a support vector machine on Nyström landmarks.

Two strings are similar when they share subsequences of 4 characters; an
occurrence counts ``DECAY`` to the power of the characters that it spans, so a
gap (``i.d.i.o.t``, ``i d i o t``) or an inserted character weakens a match and
does not end it. Kernel values are divided by the norms that strings of these
lengths have when no subsequence repeats.

1. The strings of a sentence are its words in lower case, without signs inside
   them, between two borders; single letters in a row are one string, longer ones
   than ``PIECE`` are cut. A sentence is as toxic as its worst string, and a
   document as its sentences.
2. Landmarks are words of the labelled training texts: up to half of them those that
   stand out in toxic documents (likelihood ratio), the others drawn by hash; from
   the second round on, a quarter are the clean words that look most toxic.
3. The Nyström map takes a string to its kernel values with the landmarks,
   whitened by their own kernel matrix. A linear machine with squared hinge loss is
   fitted by Newton steps. Labels come with whole texts, so it learns from bags:
   strings of clean texts are clean; of a toxic text, the words that stand out, those
   that the machine so far finds toxic, and else its worst one, are toxic
   (``ROUNDS`` rounds). Of the clean strings the commonest and others by hash are
   taken, ``MAX_STRINGS`` at most. The words that stand out are also given with a
   letter inserted.
4. A kernel of explicit subsequences makes the whole machine one weight per
   subsequence: the sum over landmarks is formed once, and a string is scored by
   looking its subsequences up (codes of ``BITS`` bits, in training as well).
5. A logistic regression over a document's worst string, the number of toxic ones
   and of all, on other labelled documents, gives the score.

Labels are learned from documents whose crc32(id as text) mod 5 is not 0:
remainder 4 calibrates, the others train. Per class, the ``SAMPLE[class]`` documents of
each part with the smallest hash of the id, of at most ``MAX_SAMPLE_BYTES``, are
taken; everything else covers all documents, in whole.

Null text reads as empty; a text without strings is scored like any other.
Labels that disagree about a document are left out, as are null ones. Without
labels of both classes in the training part the score is 0.5 for all. Repeated
rows are scored each by itself; equal scores stay equal. Empty tables give no
rows; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator
from functools import lru_cache
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import BATCH_ROWS, smallest_hashes

FOLDS, HELD_OUT, CALIBRATES = 5, 0, 4
SAMPLE, MAX_SAMPLE_BYTES = {1: 600, 0: 2400}, 20_000  # toxic, clean
PIECE = 32
DECAY = 0.8
REACH = 7  # characters that a subsequence of 4 may span
BITS = 20
LANDMARKS, ROUNDS, MAX_STRINGS = 512, 3, 20_000
COST, RIDGE = 1e4, 1e-2
CHANCE, TELLING = 8.0, 5.0  # a word stands out: likelihood ratio, ratio of its rates
SLICE_CHARS = 1 << 18
BLOCK = 2048  # strings that are mapped at a time in training
NONE = -1.0  # worst string of a text that has none

U = np.uint32
_TIMES = [U(x) for x in (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F)]


# ---- strings --------------------------------------------------------------------------


@lru_cache(maxsize=1)
def _letters() -> np.ndarray:
    out = np.zeros(1 << 16, bool)
    out[[c for c in range(1 << 16) if chr(c).isalnum()]] = True
    return out


class Strings:
    """Strings of a few texts: ``chars`` (a border is 32), ``first`` and ``size`` of each with its borders, its text ``doc``."""

    def __init__(self, texts: list[str]):
        raw = "".join(t.lower().replace("\x01", " ") + "\x01" for t in texts)
        c = np.frombuffer(raw.encode("utf-32-le"), U)
        at = np.flatnonzero(_letters()[np.minimum(c, 0xFFFF)] | (c > 0xFFFF))
        gap = (c <= 32) | (c == 0xA0)
        token, doc = np.cumsum(gap)[at], np.cumsum(c == 1)[at]
        n = len(at)
        new = np.ones(n, bool)
        new[1:] = token[1:] != token[:-1]
        single = new & np.append(new[1:], True)  # a token of one letter
        new[1:] &= ~(single[1:] & single[:-1] & (doc[1:] == doc[:-1]))
        begin = np.maximum.accumulate(np.where(new, np.arange(n), 0))
        new |= (np.arange(n) - begin) % PIECE == 0
        number = np.cumsum(new) - 1
        starts = np.flatnonzero(new)
        self.doc = doc[starts]
        self.size = np.diff(np.append(starts, n)) + 2
        self.first = np.concatenate(([0], np.cumsum(self.size)))[:-1]
        self.chars = np.full(n + 2 * len(starts), 32, U)
        self.chars[np.arange(n) + 2 * number + 1] = c[at]
        self.number = np.repeat(np.arange(len(starts)), self.size)

    def words(self) -> list[str]:
        all = self.chars.tobytes().decode("utf-32-le")
        return [all[i : i + k] for i, k in zip(self.first.tolist(), self.size.tolist())]


def _slices(texts: list[str]) -> Iterator[tuple[int, list[str]]]:
    """(number of the first, texts) for runs of about SLICE_CHARS; a longer text is a run of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > SLICE_CHARS:
            yield begin, texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield begin, texts[begin:]


# ---- the kernel -----------------------------------------------------------------------


def subsequences(chars: np.ndarray, number: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray], float]]:
    """For every span: where the string goes on that far, codes of the subsequences of that span, and their weight.

    A code array has one code for each position that a subsequence begins at.
    """
    r = (chars + U(1)) * U(0x01000193)
    r ^= r >> U(15)
    x = [r * t for t in _TIMES]
    shift = U(32 - BITS)
    for far in range(3, REACH):
        n = len(chars) - far
        if n <= 0:
            return
        ends = x[0][:n] + x[3][far:]
        codes = []
        for a in range(1, far - 1):
            some = ends + x[1][a : a + n]
            codes += [(some + x[2][b : b + n]) >> shift for b in range(a + 1, far)]
        yield number[:n] == number[far:], codes, DECAY ** (far + 1)


_NORM = np.sqrt([1e-12 + sum(max(size - far, 0) * math.comb(far - 1, 2) * DECAY ** (2 * far + 2) for far in range(3, REACH)) for size in range(PIECE + 3)])


class Landmarks:
    """Strings, their normalised subsequence weights by code, and the whitening of their kernel matrix."""

    def __init__(self, words: list[str]):
        s = Strings(words)  # a text each: single letters side by side would be one string
        self.n = len(s.first)
        codes, who, value = [], [], []
        for inside, each, weight in subsequences(s.chars, s.number):
            at = np.flatnonzero(inside)
            for c in each:
                codes.append(c[at].astype(np.int64))
                who.append(s.number[at])
                value.append(np.full(len(at), weight))
        key, inverse = np.unique(np.concatenate(codes) * self.n + np.concatenate(who), return_inverse=True)
        code, self.who = np.divmod(key, self.n)
        self.value = np.bincount(inverse, np.concatenate(value)) / _NORM[s.size][self.who]
        self.code, begin = np.unique(code, return_index=True)
        self.begin = np.append(begin, len(code))
        self.row = np.full(1 << BITS, -1, np.int32)
        self.row[self.code] = np.arange(len(self.code))
        dense = np.zeros((len(self.code), self.n))
        dense[np.repeat(np.arange(len(self.code)), np.diff(self.begin)), self.who] = self.value
        values, vectors = np.linalg.eigh(dense.T @ dense)
        good = values > 1e-6 * values[-1]
        self.whiten = vectors[:, good] / np.sqrt(values[good])

    def mapped(self, strings: list[str]) -> np.ndarray:
        """The Nyström map of every string: its kernel values with the landmarks, whitened."""
        parts = [self._mapped(Strings(strings[i : i + BLOCK])).astype(np.float32) for i in range(0, len(strings), BLOCK)]
        return np.concatenate([np.zeros((0, self.whiten.shape[1]), np.float32), *parts])

    def _mapped(self, s: Strings) -> np.ndarray:
        n = len(s.first)
        out = np.zeros(n * self.n)
        for inside, codes, weight in subsequences(s.chars, s.number):
            for c in codes:
                row = self.row[c]
                hit = np.flatnonzero((row >= 0) & inside)
                row, here = row[hit], s.number[hit]
                many = self.begin[row + 1] - self.begin[row]
                at = np.arange(many.sum()) + np.repeat(self.begin[row] - np.concatenate(([0], np.cumsum(many)[:-1])), many)
                out += np.bincount(np.repeat(here, many) * self.n + self.who[at], weight * self.value[at], len(out))
        return (out.reshape(n, self.n) / _NORM[s.size][:, None]) @ self.whiten

    def weights(self, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, weight of each) of the linear machine ``w`` over mapped strings."""
        beta = self.whiten @ w
        return self.code, np.add.reduceat(self.value * beta[self.who], self.begin[:-1])


class Machine:
    """Margins of strings by weights of subsequences."""

    def __init__(self, code: np.ndarray, weight: np.ndarray, bias: float):
        self.table, self.bias = np.zeros(1 << BITS, np.float32), bias
        self.table[code] = weight

    def margins(self, s: Strings) -> np.ndarray:
        total = np.zeros(len(s.chars), np.float32)
        for inside, codes, weight in subsequences(s.chars, s.number):
            part = self.table[codes[0]]
            for c in codes[1:]:
                part += self.table[c]
            part *= inside
            part *= np.float32(weight)
            total[: len(part)] += part
        return np.add.reduceat(total.astype(np.float64), s.first) / _NORM[s.size] + self.bias if len(s.first) else np.zeros(0)

    def features(self, texts: list[str]) -> np.ndarray:
        """Of every text: margin of the worst string, logarithms of the numbers of toxic strings and of all."""
        out = np.zeros((len(texts), 3))
        out[:, 0] = NONE
        for begin, run in _slices(texts):
            s = Strings(run)
            if not len(s.first):
                continue
            docs, at = np.unique(s.doc, return_index=True)
            margins = self.margins(s)
            out[begin + docs, 0] = np.maximum.reduceat(margins, at)
            out[begin + docs, 1] = np.log1p(np.add.reduceat(margins > 0, at, dtype=np.int64))
            out[begin + docs, 2] = np.log1p(np.diff(np.append(at, len(s.first))))
        return out


# ---- fitting --------------------------------------------------------------------------


def _stands_out(bad: list[set[str]], good: list[set[str]]) -> list[str]:
    """Strings of toxic texts by the likelihood ratio of their document counts, the most telling first."""
    a, b = Counter(w for d in bad for w in d), Counter(w for d in good for w in d)
    n, m = len(bad), len(good)

    def ratio(w: str) -> float:
        x, y = a[w], b[w]
        term = lambda k, total, p: k * math.log(k / (total * p)) if k else 0.0
        p = (x + y) / (n + m)
        return term(x, n, p) + term(y, m, p) + term(n - x, n, 1 - p) + term(m - y, m, 1 - p)

    over = {w: ratio(w) for w in a if a[w] > 1 and a[w] * m > TELLING * b[w] * n}
    return sorted((w for w in over if over[w] > CHANCE), key=lambda w: (-over[w], w))


def _different(sets: list[set[str]]) -> list[set[str]]:
    """The sets without near copies of earlier ones (half of 16 MinHash values equal): a copied text tells nothing new."""
    out, seen = [], {}
    salt = np.random.default_rng(7).integers(0, 2**63, 16, dtype=np.uint64)
    for words in sets:
        if not words:
            continue
        h = np.array([crc32(w.encode()) for w in words], np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        keys = list(enumerate(((h[:, None] ^ salt) * np.uint64(0xBF58476D1CE4E5B9)).min(axis=0).tolist()))
        if max(Counter(i for k in keys for i in seen.get(k, ())).values(), default=0) < 8:
            for k in keys:
                seen.setdefault(k, []).append(len(out))
            out.append(words)
    return out


def _newton(z: np.ndarray, y: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, float]:
    """Squared hinge loss, strings weighted by their documents within each class, ridge on all but the bias."""
    weight = COST * times / np.where(y > 0, times[y > 0].sum(), times[y < 0].sum())
    n = z.shape[1] + 1
    w, ridge = np.zeros(n), np.ones(n)
    ridge[-1] = 1e-6
    blocks = [slice(i, i + BLOCK) for i in range(0, len(z), BLOCK)]

    def gaps(w):
        return np.concatenate([1 - y[b] * (z[b] @ w[:-1] + w[-1]) for b in blocks])

    def loss(gap, w):
        gap = np.maximum(gap, 0)
        return (weight * gap * gap).sum() + w @ (ridge * w)

    gap = gaps(w)
    now = loss(gap, w)
    for _ in range(30):
        curve, slope = np.diag(ridge), ridge * w
        for b in blocks:
            act = np.flatnonzero(gap[b] > 0)
            x = np.column_stack([z[b][act], np.ones(len(act))])
            curve += (x * weight[b][act, None]).T @ x
            slope -= x.T @ (weight[b] * gap[b] * y[b])[act]
        step = np.linalg.solve(curve, slope)
        size = 1.0
        while (then := loss(new := gaps(w - size * step), w - size * step)) > now and size > 1e-6:
            size /= 2
        if then > now - 1e-9 * abs(now):
            break
        w, now, gap = w - size * step, then, new
    return w[:-1], w[-1]


def _inserted(word: str, others: list[str]) -> list[str]:
    """The word with one letter more at each inner place; the letter comes from other words, by hash."""
    core = word.strip()
    letter = lambda i: others[crc32(f"{core}{i}".encode()) % len(others)].strip()[:1] or "x"
    return [f" {core[:i]}{letter(i)}{core[i:]} " for i in range(2, len(core) - 1)] if 4 <= len(core) < PIECE else []


def _by_hash(words: Iterable[str]) -> list[str]:
    return sorted(words, key=lambda w: (crc32(w.encode()), w))


def fit_machine(bad: list[str], good: list[str]) -> Machine:
    """The machine from whole toxic and clean texts."""
    bags, sets = _different([set(Strings([t]).words()) for t in bad]), _different([set(Strings([t]).words()) for t in good])
    telling = _stands_out(bags, sets)
    often, bad_often = Counter(w for d in sets for w in d), Counter(w for d in bags for w in d)
    known = _by_hash(often.keys() - set(telling))
    common = sorted(known, key=lambda w: -often[w])[: MAX_STRINGS // 2]
    clean = common + _by_hash(set(known) - set(common))[: MAX_STRINGS - len(common)]
    suspect = telling + _by_hash(bad_often.keys() - set(known) - set(telling))
    number = {w: i for i, w in enumerate(suspect)}
    bags = [np.array(sorted(number[w] for w in b if w in number), np.int64) for b in bags]
    sure = np.arange(len(suspect)) < (len(telling) or len(suspect))
    y_good, n_good, n_bad = -np.ones(len(clean)), np.array([often[w] for w in clean], float), np.array([bad_often[w] for w in suspect], float)
    odd = [(w, v) for w in telling for v in _inserted(w, suspect + clean)]
    n_odd = np.array([bad_often[w] / 4 for w, _ in odd])
    chosen, hard = sure.copy(), []
    first = telling[: LANDMARKS // 2]
    all_bad, all_good = Strings(suspect), Strings(clean)
    machine = Machine(np.zeros(0, np.int64), np.zeros(0), -1.0)
    for _ in range(ROUNDS if chosen.any() and len(clean) else 0):
        rest = hard + [w for w in known if w not in set(hard) | set(first)][: LANDMARKS - len(first) - len(hard)]
        landmarks = Landmarks(first + rest)
        bad_now = np.flatnonzero(chosen)
        z = landmarks.mapped([suspect[i] for i in bad_now] + [v for _, v in odd] + clean)
        w, bias = _newton(z, np.concatenate([np.ones(len(z) - len(clean)), y_good]), np.concatenate([n_bad[bad_now], n_odd, n_good]))
        machine = Machine(*landmarks.weights(w), bias)
        margin = machine.margins(all_bad)
        chosen = (sure | (margin > 0.5)) if len(telling) else margin > 0
        for b in bags:
            if len(b) and not chosen[b].any() and margin[b].max() > 0:
                chosen[b[margin[b].argmax()]] = True
        if not chosen.any():
            break
        hard = [clean[i] for i in np.argsort(-machine.margins(all_good), kind="stable")[: LANDMARKS // 4].tolist()]
    return machine


class Calibration:
    """Ridge logistic regression by Newton steps."""

    def __init__(self, x: np.ndarray, y: np.ndarray):
        self.mean, self.scale = x.mean(axis=0), x.std(axis=0) + 1e-9
        z = self._design(x)
        self.weights = np.zeros(z.shape[1])
        for _ in range(50):
            p = self._p(z)
            step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z / len(y) + RIDGE * np.eye(z.shape[1]), z.T @ (p - y) / len(y) + RIDGE * self.weights)
            self.weights -= step
            if np.abs(step).max() < 1e-10:
                break

    def _design(self, x: np.ndarray) -> np.ndarray:
        return np.column_stack([np.ones(len(x)), (x - self.mean) / self.scale])

    def _p(self, z: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(z @ self.weights, -500, 500)))

    def __call__(self, x: np.ndarray) -> np.ndarray:
        return self._p(self._design(x))


def fold(id: str):
    return F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(FOLDS))


def _sample(docs: DataFrame, labels: DataFrame, id: str, text: str) -> list:
    """(toxic, part, text) of a bounded sample: at most 2 * (SAMPLE[0] + SAMPLE[1]) texts of MAX_SAMPLE_BYTES."""
    agreed = labels.where("toxic IN (0, 1)").groupBy(id).agg(F.min("toxic").alias("toxic"), F.max("toxic").alias("_max")).where("toxic = _max")
    agreed = agreed.where(fold(id) != HELD_OUT).select(id, "toxic", (fold(id) == CALIBRATES).alias("calibrates"))
    totals = {(r["toxic"], r["calibrates"]): r["count"] for r in agreed.groupBy("toxic", "calibrates").count().collect()}  # four rows
    picked = None
    for (toxic, part), total in sorted(totals.items()):
        some = smallest_hashes(agreed.where((F.col("toxic") == toxic) & (F.col("calibrates") == part)), SAMPLE[toxic], total, id)
        picked = some if picked is None else picked.unionByName(some)
    if picked is None:
        return []
    slim = docs.select(F.col(id), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text")).where(F.octet_length("_text") <= MAX_SAMPLE_BYTES)
    few = F.broadcast(picked)  # as many ids at most
    return slim.join(few, id).groupBy(id, "toxic", "calibrates").agg(F.min("_text").alias("_text")).orderBy(id).collect()


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[Machine, Calibration] | None:
    """Machine and calibration; None without labels of both classes."""
    rows = _sample(docs, labels, id, text)
    bad, good = ([r["_text"] for r in rows if r["toxic"] == q and not r["calibrates"] and r["_text"]] for q in (1, 0))
    if not bad or not good:
        return None
    machine = fit_machine(bad, good)
    held = [r for r in rows if r["calibrates"]]
    if len({r["toxic"] for r in held}) < 2:  # too few to set some apart
        held = rows
    return machine, Calibration(machine.features([r["_text"] for r in held]), np.array([r["toxic"] for r in held], np.float64))


def score(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, held_out, score (of being toxic), predicted."""
    model = fit(docs, labels, id, text)
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])
    sent = None
    if model is not None:  # the tasks get the weights that are not 0
        at = np.flatnonzero(model[0].table)
        sent = (at, model[0].table[at], model[0].bias), model[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        machine = Machine(*sent[0]) if sent else None
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(i, BATCH_ROWS)
                scores = np.full(b.num_rows, 0.5) if machine is None else sent[1](machine.features([t or "" for t in b.column(2).to_pylist()]))
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores, pa.float64())], names=schema.names)

    slim = docs.select(F.col(id), F.coalesce(fold(id) == HELD_OUT, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("_text"))
    return slim.mapInArrow(run, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
