"""Session helpers: a tuned local session for tests/bench and the shared scratch folder."""

from __future__ import annotations

import re
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import SparkSession

# Settings every session of this library wants. On a cluster these come from the
# cluster config; the builder below only fills them in for local runs.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
}


_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, app: str = "cellar") -> SparkSession:
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.driver.memory", "16g")
    )
    for k, v in DEFAULT_CONF.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    return spark


def ship_package(spark: SparkSession) -> str:
    """Give this package to the executors, so that grouped Python functions can import it.

    Needed where the workers do not have the package on their path; on a cluster
    ``spark-submit --py-files`` with the same zip does it too. Returns the zip's path.
    """
    import cellar

    root = Path(cellar.__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="cellar-package-")) / "cellar.zip"
    with zipfile.ZipFile(target, "w", zipfile.ZIP_DEFLATED) as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f"{root.name}/{f.relative_to(root)}")
    spark.sparkContext.addPyFile(str(target))
    return str(target)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder of the session.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is (the context picks it up at start). Only when nothing is set and the
    master is local (tests, one machine) a folder of our own is created; on any
    other master a machine-local folder would scatter the data, so that raises.
    """
    sc = spark.sparkContext
    cur = sc.getCheckpointDir()
    if cur:
        return cur
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        if not re.match(r"local(\[|$)", sc.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        d = tempfile.mkdtemp(prefix="cellar-ckpt-")
    sc.setCheckpointDir(d)
    return sc.getCheckpointDir() or d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the application's part of the shared checkpoint folder (full URI kept)."""
    return f"{_scratch_folder(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def _scratch_folder(spark: SparkSession) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/cellar-scratch/{spark.sparkContext.applicationId}"


def clean_scratch(spark: SparkSession) -> bool:
    """Remove everything this application wrote with ``scratch_path``; frames read from there cannot be used afterwards."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_folder(spark))
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df, name: str):
    """Write ``df`` once as parquet under the shared folder and read it back.

    Used where one intermediate feeds several jobs: it is computed once (an RDD
    checkpoint would compute it a second time to write it), the lineage is cut,
    a lost executor cannot lose it, and later plans see its real size.
    """
    return df.sparkSession.read.parquet(written(df, name))


def written(df, name: str) -> str:
    """The path that ``materialize`` writes ``df`` to."""
    path = scratch_path(df.sparkSession, name)
    with shuffles_end(df.sparkSession):
        df.write.mode("overwrite").parquet(path)
    return path


@contextmanager
def shuffles_end(spark: SparkSession) -> Iterator[None]:
    """A query's shuffles are deleted when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(_CLEAN, None)
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.unset(_CLEAN) if before is None else spark.conf.set(_CLEAN, before)


def forget(spark: SparkSession, path: str) -> bool:
    """Remove one path that ``written`` gave, when nothing reads it any more."""
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
