"""Quality classifier by compression.

Two zstandard dictionaries are trained, from good and from bad labelled texts.
A text is compressed whole with each and with none; the difference of the two
sizes over the plain size, with the plain ratio and the length it depends on,
is calibrated by a logistic regression on other labelled texts. Scores use the
text alone.

Labels are learned from documents whose crc32(id as text) mod 3 is not 1:
remainder 0 trains the dictionaries, remainder 2 the calibration. Both take a
bounded sample: per class, the ``SAMPLE`` documents with the smallest hash of
the id (for dictionaries, of those up to ``MAX_SAMPLE_BYTES``). Everything else
covers all documents.

Null text reads as empty; an empty text is scored like any other. Labels that
disagree about a document are left out, as are null ones. Without labels of
both classes in each part the score is 0.5 for all. Repeated rows are scored
each by itself.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import map_batches, smallest_hashes

FOLDS, HELD_OUT = 3, 1
SAMPLE = 2000
MAX_SAMPLE_BYTES = 20_000
DICTIONARY_BYTES, LEVEL = 1 << 16, 3
RIDGE = 1e-3


def fold(id: str):
    return F.pmod(F.crc32(F.col(id).cast("string").cast("binary")), F.lit(FOLDS))


def _dictionary(texts: list[bytes]) -> bytes:
    """A trained dictionary; for too few texts to train on, their own content."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, texts).as_bytes()
    except zstandard.ZstdError:
        return b"".join(texts)[:DICTIONARY_BYTES]


class Sizes:
    """Compressed sizes of a text: with the good, with the bad and without a dictionary."""

    def __init__(self, dictionaries: tuple[bytes, bytes]):
        plain = {"level": LEVEL, "write_content_size": False, "write_dict_id": False}
        self.by = [zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d), **plain) if d else zstandard.ZstdCompressor(**plain) for d in dictionaries]
        self.by.append(zstandard.ZstdCompressor(**plain))

    def features(self, texts: list[bytes]) -> np.ndarray:
        rows = np.array([[len(c.compress(t)) for c in self.by] + [max(len(t), 1)] for t in texts], np.float64).reshape(len(texts), 4)
        good, bad, plain, n = rows.T
        d, r, size = (bad - good) / plain, plain / n, np.log(n)
        return np.stack([d, r, size, d * size, r * size, r * r, size * size, d * d, d * r], axis=1)


class Calibration:
    """Ridge logistic regression over standardised features, by Newton steps."""

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


def _sampled(docs: DataFrame, labels: DataFrame, id: str, text: str, remainder: int, most_bytes: int | None) -> DataFrame:
    """(quality, _text) of a bounded sample of labelled documents."""
    agreed = labels.where("quality IN (0, 1)").groupBy(id).agg(F.min("quality").alias("quality"), F.max("quality").alias("_max")).where("quality = _max").drop("_max")
    agreed = agreed.where(fold(id) == remainder)
    totals = {r["quality"]: r["count"] for r in agreed.groupBy("quality").count().collect()}  # two rows
    picked = [smallest_hashes(agreed.where(F.col("quality") == q), SAMPLE, totals.get(q, 0), id) for q in (0, 1)]
    few = F.broadcast(picked[0].unionByName(picked[1]))  # at most 2 * SAMPLE rows
    out = docs.select(F.col(id), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    out = out if most_bytes is None else out.where(F.octet_length("_text") <= most_bytes)
    # an id that repeats in the documents could exceed the bound: one text for each
    return out.join(few, id).groupBy(id, "quality").agg(F.min("_text").alias("_text"))


def fit(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> tuple[tuple[bytes, bytes], Calibration] | None:
    """Dictionaries (good, bad) and calibration; None without labels of both classes in each part."""
    rows = _sampled(docs, labels, id, text, 0, MAX_SAMPLE_BYTES).orderBy(id).collect()
    sets = [[r["_text"].encode() for r in rows if r["quality"] == q and r["_text"]] for q in (1, 0)]
    if not all(sets):
        return None
    dictionaries = (_dictionary(sets[0]), _dictionary(sets[1]))

    def features(b: pa.RecordBatch) -> pa.RecordBatch:
        x = Sizes(dictionaries).features([t.encode() for t in b.column("_text").to_pylist()])
        return pa.RecordBatch.from_arrays([b.column(id), b.column("quality").cast(pa.int32()), pa.array(list(x), pa.list_(pa.float64()))], names=["id", "y", "x"])

    kind = T.StructType([T.StructField("id", docs.schema[id].dataType), T.StructField("y", T.IntegerType()), T.StructField("x", T.ArrayType(T.DoubleType()))])
    held = map_batches(_sampled(docs, labels, id, text, 2, None).select(id, "quality", "_text"), features, kind).orderBy("id").collect()
    y = np.array([r["y"] for r in held], np.float64)
    if len(set(y.tolist())) < 2:
        return None
    return dictionaries, Calibration(np.array([r["x"] for r in held]), y)


def score(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: id, held_out, score (of being good), predicted."""
    model = fit(docs, labels, id, text)
    schema = T.StructType([T.StructField(id, docs.schema[id].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("score", T.DoubleType())])

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        scores = np.full(b.num_rows, 0.5)
        if model is not None:
            sizes = Sizes(model[0])
            scores = model[1](np.concatenate([sizes.features([(t.as_py() or "").encode()]) for t in b.column(2)]))
        return pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(scores, pa.float64())], names=schema.names)

    slim = docs.select(F.col(id), F.coalesce(fold(id) == HELD_OUT, F.lit(False)).alias("held_out"), F.col(text).cast("string").alias("_text"))
    return map_batches(slim, one, schema).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
