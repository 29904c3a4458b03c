"""Small helpers of the training-data operators."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cellar.session import materialize  # noqa: F401  (one place to import it from)


BATCH_ROWS = 2048
RECORDS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: stands for a null document id where ids are keys
NO_ID = -(1 << 63)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have (case ignored)."""
    have = {c.lower() for c in df.columns}
    while name.lower() in have:
        name = "_" + name
    return name


def map_batches(df: DataFrame, fn: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table], schema: str | T.StructType) -> DataFrame:
    """``mapInArrow`` for a function of one batch of at most ``BATCH_ROWS`` rows; empty batches are passed over.

    Spark's batches hold 10,000 rows by default; cut smaller, what a function
    makes of a batch of long texts stays small too. The session's limit is lowered
    as well, or executor and worker would both hold 10,000 whole texts a task.
    """
    conf = df.sparkSession.conf
    if not 0 < int(conf.get(RECORDS)) <= BATCH_ROWS:
        conf.set(RECORDS, str(BATCH_ROWS))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, BATCH_ROWS):
                out = fn(whole.slice(i, BATCH_ROWS))
                yield from out.to_batches() if isinstance(out, pa.Table) else [out]

    return df.mapInArrow(run, schema)


def with_struct(df: DataFrame, name: str, kind: str, fn: Callable[[pa.Array], pa.StructArray], text: str = "text", keep: bool = True) -> DataFrame:
    """``df`` and one struct column ``name`` that ``fn`` makes from a batch of texts; a column of that name is replaced.

    Without ``keep`` the texts do not come back from the worker.
    """
    df = df.drop(*[c for c in df.columns if c.lower() == name.lower()])
    back = [i for i, c in enumerate(df.columns) if keep or c != text]
    schema = T.StructType([*(df.schema.fields[i] for i in back), T.StructField(name, T._parse_datatype_string(kind))])

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*(b.columns[i] for i in back), fn(b.column(text))], names=schema.names)

    return map_batches(df, one, schema)


def fill_text(df: DataFrame, column: str = "text"):
    """The text column as a string; null reads as the empty text."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def pack_texts(df: DataFrame) -> DataFrame:
    """The rows with their text ``_text`` compressed as ``_z``, for a shuffle."""
    schema = T.StructType([f if f.name != "_text" else T.StructField("_z", T.BinaryType()) for f in df.schema.fields])

    def one(b: pa.RecordBatch) -> pa.RecordBatch:
        pack = zstandard.ZstdCompressor(level=3).compress
        z = pa.array([None if t is None else pack(t.encode()) for t in b.column("_text").to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([z if n == "_text" else c for n, c in zip(b.schema.names, b.columns)], names=schema.names)

    return map_batches(df, one, schema)


def unpack_texts(z: pa.Array) -> pa.Array:
    """The texts of a ``_z`` column; null reads as empty."""
    unpack = zstandard.ZstdDecompressor().decompress
    return pa.array([b"" if x is None else unpack(x) for x in z.to_pylist()], pa.large_binary()).cast(pa.large_string())


def smallest_hashes(df: DataFrame, n: int, total: int, *columns: str) -> DataFrame:
    """The ``n`` rows of ``df`` (which has ``total``) with the smallest hashes of ``columns``.

    A hash limit that n rows pass almost surely, but few more, comes first, so
    that partitions do not each send n rows to be ordered.
    """
    h = F.xxhash64(*columns)
    enough = n + 8 * math.sqrt(n) + 32
    if total > enough:
        df = df.where(h < F.lit(round((enough / total - 0.5) * 2.0**64)))
    return df.orderBy(h, *columns).limit(n)
