"""Helpers that the operators of this folder share."""

from __future__ import annotations

import ctypes
import re
import tempfile
import threading
import uuid
from collections.abc import Iterator
from contextlib import contextmanager, suppress

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder in ``spark.checkpoint.dir``. Only where that is unset on one machine (tests) a temporary one is made and set."""
    if not spark.conf.get("spark.checkpoint.dir", ""):
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir is not set: on a cluster it must name a folder that all executors share")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
    return spark.conf.get("spark.checkpoint.dir").rstrip("/")


class _Written(threading.local):
    """Paths of the tables written within each open ``scratch``, by thread."""

    def __init__(self):
        self.paths: list[list[str]] = []


_written = _Written()


def materialize(df: DataFrame, name: str = "table", outlive: bool = False) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: it cuts the lineage and survives lost executors.

    Within ``scratch`` the table goes with the others at its end, unless it is to ``outlive`` it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    schema = df.schema
    df.write.parquet(path)
    holders = _written.paths[:-1] if outlive else _written.paths
    if holders:
        holders[-1].append(path)
    return spark.read.schema(schema).parquet(path)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables written inside are deleted at the end. Nothing that is lazy may read them afterwards."""
    _written.paths.append([])
    try:
        yield
    finally:
        for name in _written.paths.pop():
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def text_batches(spark: SparkSession, rows: int = 2000, size: int = 8 << 20) -> None:
    """From now on Python workers of this session get at most ``rows`` rows and ``size`` bytes at a time, for the default lets
    batches of whole texts grow with the texts. A session that has a limit of bytes of its own keeps it."""
    limit = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(limit, None) is None:
        spark.conf.set(limit, str(size))
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", rows)


def release() -> None:
    """Give memory that a task has freed back to the system, for workers outlive their tasks and several of them share an executor."""
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):
        ctypes.CDLL("libc.so.6").malloc_trim(0)


def text_or_empty(col: str = "text"):
    return F.coalesce(F.col(col), F.lit(""))


def fresh(df: DataFrame, name: str) -> str:
    """``name``, made longer until no column of ``df`` has it."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def only(df: DataFrame, columns: list[str]) -> DataFrame:
    """The named columns alone, so that extra columns can never clash with those an operator adds."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {missing}")
    return df.select(*columns)
