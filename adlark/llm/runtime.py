"""What every operator of this subpackage needs from the cluster: code on the workers, shared scratch tables, Arrow limits."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import functools
import os
import shutil
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from pathlib import Path

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PACKAGE = Path(__file__).resolve().parents[1]
BATCH_ROWS = 1000
BATCH_BYTES = 4 << 20


def prepare(spark: SparkSession) -> None:
    """Ship this package to the workers once per application and bound the Arrow batches they get."""
    sc = spark.sparkContext
    if getattr(sc, "_adlark_shipped", None) != sc.applicationId:
        folder = tempfile.mkdtemp(prefix="adlark-code-")
        atexit.register(shutil.rmtree, folder, ignore_errors=True)
        path = os.path.join(folder, f"{PACKAGE.name}.zip")
        with zipfile.ZipFile(path, "w") as z:
            for p in sorted(PACKAGE.rglob("*.py")):
                z.write(p, p.relative_to(PACKAGE.parent))
        sc.addPyFile(path)
        sc._adlark_shipped = sc.applicationId
    for key, value in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        spark.conf.set(f"spark.sql.execution.arrow.{key}", str(value))


@functools.cache
def frugal() -> None:
    """Once per Python worker: memory that is freed goes back to the system, since Spark keeps workers for later stages.

    By itself glibc raises the size from which it returns blocks up to 32 MB, and Arrow's own pool keeps pages.
    """
    pa.set_memory_pool(pa.system_memory_pool())
    try:
        libc = ctypes.CDLL(None)
        libc.mallopt(-3, 1 << 20)  # M_MMAP_THRESHOLD
        libc.mallopt(-1, 4 << 20)  # M_TRIM_THRESHOLD
        libc.malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


@functools.cache
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):  # another C library
        return lambda n: 0


def tidy() -> None:
    """Give memory that was freed back to the system, since Spark keeps workers for later stages."""
    pa.default_memory_pool().release_unused()
    _trim()(0)


def tidied(batches: Iterator) -> Iterator:
    """The same batches; `tidy` after the last one."""
    try:
        yield from batches
    finally:
        tidy()


def shared_dir(spark: SparkSession) -> str:
    """The folder the cluster shares (spark.checkpoint.dir); a temporary one of our own only where that is unset."""
    sc = spark.sparkContext
    base = sc.getConf().get("spark.checkpoint.dir", None)
    if base is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = getattr(sc, "_adlark_scratch", None)
        if base is None:
            base = sc._adlark_scratch = tempfile.mkdtemp(prefix="adlark-scratch-")
            atexit.register(shutil.rmtree, base, ignore_errors=True)
            sc.setCheckpointDir(base)
    return base.rstrip("/")


def stored(df: DataFrame, name: str, codec: str = "zstd", level: int = 3) -> tuple[DataFrame, str]:
    """Write df to a table in the shared folder and read it again: lineage ends there and lost executors cost nothing done before."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/adlark-{name}-{uuid.uuid4().hex}"
    _left(spark).add(path)
    df.write.option("compression", codec).option("parquet.compression.codec.zstd.level", level).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def _left(spark: SparkSession) -> set[str]:
    """Scratch tables of this application that are still there; they go when Python ends, if the session is still up."""
    sc = spark.sparkContext
    if not hasattr(sc, "_adlark_left"):
        sc._adlark_left = set()

        def clean() -> None:
            with contextlib.suppress(Exception):  # the session may have been stopped
                drop(spark, *list(sc._adlark_left))

        atexit.register(clean)
    return sc._adlark_left


def drop(spark: SparkSession, *paths: str) -> None:
    """Delete scratch tables that nothing will read again."""
    jvm = spark.sparkContext._jvm
    for path in paths:
        _left(spark).discard(path)
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def documents(df: DataFrame) -> DataFrame:
    """doc_id and text of a documents table, whatever further columns it has; a null text is empty."""
    return df.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))


def tasks(spark: SparkSession) -> int:
    """Partitions for a shuffle of this session."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
