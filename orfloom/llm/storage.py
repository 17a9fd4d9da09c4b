"""Scratch tables in the shared folder that the cluster names.

Long plans are cut by writing a table and reading it back, so that a lost
executor costs at most the stage that was running.
"""

from __future__ import annotations

import ctypes
import re
import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession


#: Bytes and rows of a batch that goes to Python, at most: texts and packed blocks are long.
BATCH_BYTES, BATCH_ROWS = 4 << 20, 2000
_BATCH_CONF = "spark.sql.execution.arrow.max{}PerBatch"


def bounded_batches(spark: SparkSession) -> None:
    """Lowers the session's Arrow batches to ``BATCH_BYTES`` and ``BATCH_ROWS``, so that a task holds megabytes and not tens of them.

    Plans read the setting when they run, so it stays lowered; a session that has lower ones keeps them.
    """
    for what, most in (("Bytes", BATCH_BYTES), ("Records", BATCH_ROWS)):
        now = re.fullmatch(r"(\d+)b?", spark.conf.get(_BATCH_CONF.format(what)))
        if not now or not 0 < int(now[1]) <= most:
            spark.conf.set(_BATCH_CONF.format(what), str(most))


def give_back() -> None:
    """Returns a worker's free memory to the machine: allocators keep it else, and workers live long."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``; only where it is unset (tests), a folder of our own."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = "file://" + tempfile.mkdtemp(prefix="orfloom-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def scratch(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a written table: later reads never compute it again."""
    spark = df.sparkSession
    path = scratch(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
