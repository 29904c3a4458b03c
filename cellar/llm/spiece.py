"""SentencePiece encoding with byte offsets, and decoding.

The model file is read as a protocol buffer. Normalisation is done here: at
each position the longest key of the model's compiled character map that
prefixes the text is replaced by its value (a text position without a key is
copied), white space is trimmed, escaped and prefixed as the model says, and
for every normalised byte the source byte it came from is kept. The library
then segments the normalised text with the same model whose normaliser is set
to the identity, and each piece is projected through the alignment to its span
of original bytes. Pieces tile the normalised text, so spans cover the source
in order.

Null and empty texts: no pieces, the empty text decodes. Texts are encoded
whole. Each row is encoded by itself, repeated rows too.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.llm.common import map_batches

SPACE = "▁".encode()  # the visible space of the format
_NORMALIZER_SPEC, _NORMAL, _BYTE = 3, 1, 6
FEW = 64  # texts whose pieces are held at a time


# ---- protocol buffer fields ------------------------------------------------


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        x = b[i]
        i += 1
        value |= (x & 127) << shift
        if x < 128:
            return value, i
        shift += 7


def fields(b: bytes) -> Iterator[tuple[int, int | bytes, bytes]]:
    """(number, value, raw bytes) of each field of a message."""
    i = 0
    while i < len(b):
        start = i
        key, i = _varint(b, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(b, i)
        else:
            n, i = _varint(b, i) if kind == 2 else ({1: 8, 5: 4}[kind], i)
            value, i = b[i : i + n], i + n
        yield key >> 3, value, b[start:i]


def message(number: int, value: bytes) -> bytes:
    """One length-delimited field."""
    head, out = (len(value), bytearray([number << 3 | 2]))
    while head > 127:
        out.append(head & 127 | 128)
        head >>= 7
    out.append(head)
    return bytes(out) + value


# ---- normaliser ------------------------------------------------------------


class CharMap:
    """The compiled character map: a double-array trie of keys and the replacements they point to."""

    def __init__(self, blob: bytes):
        if not blob:
            self.units, self.values = np.zeros(0, np.uint32).tolist(), b""
            self.first = None
            return
        (size,) = struct.unpack_from("<I", blob)
        self.units = np.frombuffer(blob, "<u4", size // 4, 4).tolist()
        self.values = blob[4 + size :]
        heads = bytes(c for c in range(256) if self._child(0, c) is not None)
        self.first = re.compile(b"[" + re.escape(heads) + b"]") if heads else None

    @staticmethod
    def _offset(unit: int) -> int:
        return (unit >> 10) << ((unit & 512) >> 6)

    def _child(self, node: int, c: int) -> int | None:
        """The node reached by byte c; a node is kept as the array position of its unit."""
        at = node ^ self._offset(self.units[node]) ^ c
        return at if at < len(self.units) and self.units[at] & 0x800000FF == c else None

    def longest(self, text: bytes, i: int) -> tuple[int, bytes] | None:
        """(length, replacement) of the longest key that text has at i."""
        node, found = 0, None
        for j in range(i, len(text)):
            node = self._child(node, text[j])
            if node is None:
                break
            unit = self.units[node]
            if unit >> 8 & 1:  # a key ends here; its value sits at the node's base
                value = self.units[node ^ self._offset(unit)] & 0x7FFFFFFF
                found = j + 1 - i, self.values[value : self.values.index(0, value)]
        return found


class Normalizer:
    """Normalised text and, for each of its bytes and its end, the source byte it starts from."""

    def __init__(self, spec: bytes):
        got = {k: v for k, v, _ in fields(spec)}
        self.map = CharMap(got.get(2, b""))
        self.dummy_prefix, self.trim, self.escape = (bool(got.get(k, 1)) for k in (3, 4, 5))

    def _mapped(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        """The text with its keys replaced; every byte of a replacement comes from its key's first byte."""
        if self.map.first is None:
            return raw, np.arange(len(raw) + 1)
        out, origin, done = [], [], 0
        i = 0
        while m := self.map.first.search(raw, i):
            i = m.start()
            if hit := self.map.longest(raw, i):
                n, value = hit
                out += [raw[done:i], value]
                origin += [np.arange(done, i), np.full(len(value), i)]
                done = i = i + n
            else:  # copy the whole character
                i += 1
                while i < len(raw) and raw[i] & 0xC0 == 0x80:
                    i += 1
        out.append(raw[done:])
        origin.append(np.arange(done, len(raw) + 1))
        return b"".join(out), np.concatenate(origin)

    def __call__(self, raw: bytes) -> tuple[bytes, np.ndarray]:
        text, origin = self._mapped(raw)
        if self.trim:  # no space at either end, one between words
            body = np.frombuffer(text, np.uint8)
            space = body == 32
            keep = ~space
            keep[1:] |= space[1:] & ~space[:-1]
            solid = np.flatnonzero(~space)
            if not len(solid):
                return b"", origin[:1]
            keep[: solid[0]] = keep[solid[-1] + 1 :] = False
            origin = np.concatenate((origin[:-1][keep], origin[solid[-1] + 1 : solid[-1] + 2]))
            text = body[keep].tobytes()
        if not text:
            return b"", origin[:1]
        if self.dummy_prefix:
            text, origin = b" " + text, np.concatenate((origin[:1], origin))
        if self.escape:
            wide = np.ones(len(text) + 1, np.int64)
            wide[:-1][np.frombuffer(text, np.uint8) == 32] = len(SPACE)
            text, origin = text.replace(b" ", SPACE), np.repeat(origin, wide)
        return text, origin


class Encoder:
    """One model: pieces, ids, spans and decoding."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            model = f.read()
        spec, pieces = b"", []
        for number, value, _ in fields(model):
            if number == _NORMALIZER_SPEC:
                spec = value
            elif number == 1:
                got = {k: v for k, v, _ in fields(value)}
                pieces.append((got.get(1, b""), got.get(3, _NORMAL)))
        self.normalize = Normalizer(spec)
        plain = b"\x0a\x08identity\x18\x00\x20\x00\x28\x00"  # name; no prefix, no trimming, no escaping
        inner = b"".join(raw for number, _, raw in fields(model) if number != _NORMALIZER_SPEC) + message(_NORMALIZER_SPEC, plain)
        self.segmenter = sentencepiece.SentencePieceProcessor(model_proto=inner)
        self.decoder = sentencepiece.SentencePieceProcessor(model_proto=model)
        #: normalised bytes that each id stands for; 0 where that depends on the text
        self.lengths = np.array([1 if kind == _BYTE else len(p) if kind in (_NORMAL, 4) else 0 for p, kind in pieces], np.int64)

    def encode(self, text: str) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Ids, and for each the first and the end byte in the source text."""
        normal, origin = self.normalize(text.encode())
        ids = self.segmenter.encode(normal.decode())
        sizes = self.lengths[ids] if ids else np.zeros(0, np.int64)
        if (sizes == 0).any():  # unknown characters: their surface is in the text
            sizes = np.array([len(p.encode()) for p in self.segmenter.encode(normal.decode(), out_type=str)], np.int64)
        ends = np.cumsum(sizes)
        if len(normal) != (ends[-1] if len(ends) else 0):
            raise ValueError("the pieces do not cover the normalised text")
        return ids, origin[ends - sizes], origin[ends]

    def decode(self, ids: list[int]) -> str:
        return self.decoder.decode(ids)


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process."""
    return Encoder(path)


def encode(docs: DataFrame, model: str, text: str = "text", into: str = "tokens", decoded: str | None = None) -> DataFrame:
    """``docs`` and struct ``into``: ids, first and end (byte spans of the source text) of every piece.

    With ``decoded``, a column of that name gets the text that the ids decode
    to. Columns of these names are replaced. ``model`` is a path that every
    executor has. Rows leave in small batches, so a task holds few texts' ids.
    """
    new = [into, *([decoded] if decoded else [])]
    docs = docs.drop(*[c for c in docs.columns if c.lower() in [n.lower() for n in new]])
    kind = T._parse_datatype_string("struct<ids:array<int>,first:array<bigint>,end:array<bigint>>")
    kinds = (pa.list_(pa.int32()), pa.list_(pa.int64()), pa.list_(pa.int64()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = encoder(model)
        for b in (s.slice(i, FEW) for s in batches for i in range(0, s.num_rows, FEW)):
            got = [enc.encode(t or "") for t in b.column(text).to_pylist()]
            cols = [pa.StructArray.from_arrays([pa.array([g[k] for g in got], kinds[k]) for k in range(3)], ["ids", "first", "end"])]
            if decoded:
                cols.append(pa.array([enc.decode(g[0]) if g[0] else "" for g in got], pa.string()))
            yield pa.RecordBatch.from_arrays([*b.columns, *cols], names=[*b.schema.names, *new])

    fields_ = [T.StructField(into, kind), *([T.StructField(decoded, T.StringType())] if decoded else [])]
    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, *fields_]))


def decode(df: DataFrame, model: str, ids: str = "ids", into: str = "decoded") -> DataFrame:
    """``df`` and the text that the ids in column ``ids`` decode to; null ids decode to the empty text."""
    df = df.drop(*[c for c in df.columns if c.lower() == into.lower() and c != ids])

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        enc = encoder(model)
        out = pa.array([enc.decode(x.as_py()) if x.is_valid else "" for x in b.column(ids)], pa.string())
        return pa.RecordBatch.from_arrays([*b.columns, out], names=[*b.schema.names, into])

    return map_batches(df, one, T.StructType([*df.schema.fields, T.StructField(into, T.StringType())]))


def round_trip(docs: DataFrame, model: str, id: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row: n_tokens, sha256 of the ids and of the decoded text, and how many source bytes the spans cover.

    Encoding and decoding run in one pass over a batch, text by text, so a task
    holds the ids of one text only.
    """
    schema = T.StructType(
        [
            T.StructField(id, docs.schema[id].dataType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
            T.StructField("n_span_bytes", T.LongType()),
        ]
    )

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        enc, rows = encoder(model), []
        for t in b.column(1):
            ids, first, end = enc.encode(t.as_py() or "")
            digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
            rows.append((len(ids), digest, hashlib.sha256(enc.decode(ids).encode()).hexdigest() if ids else _EMPTY, int(end[-1] - first[0]) if ids else 0))
        cols = list(zip(*rows))
        return pa.RecordBatch.from_arrays([b.column(0), pa.array(cols[0], pa.int64()), pa.array(cols[1]), pa.array(cols[2]), pa.array(cols[3], pa.int64())], names=schema.names)

    return map_batches(docs.select(F.col(id), F.col(text).cast("string").alias(f"{id}_text")), one, schema)


_EMPTY = hashlib.sha256(b"").hexdigest()
