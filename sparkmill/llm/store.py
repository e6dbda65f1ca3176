"""Tables written to the shared folder of spark.checkpoint.dir and read back.

They cut lineage like a checkpoint but as Parquet: compressed, splittable and
readable after the loss of any executor."""

from __future__ import annotations

import ctypes
import ctypes.util
import re
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from sparkmill.session import checkpoint_dir


def folder(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str) -> DataFrame:
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken or (name + "s").lower() in taken:
        name = "_" + name
    return name


BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Whole texts go to Python in batches of at most ``rows`` rows from now on in this session:
    Spark bounds a batch by rows, not bytes, and its default of 10,000 long texts is too much
    for a small executor.  A smaller setting of the session's own stays."""
    now = int(spark.conf.get(BATCH))
    if now <= 0 or now > rows:
        spark.conf.set(BATCH, str(rows))


BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def lean_batches(spark: SparkSession, most: int = 8 << 20) -> None:
    """Rows go to Python in batches of at most ``most`` bytes (or one row) from now on in this session, so that a
    batch of long texts is no larger than one of short ones.  A smaller setting of the session's own stays."""
    size = re.fullmatch(r"(-?\d+)([kmg]?)b?", spark.conf.get(BATCH_BYTES, "64m").lower())
    now = int(size[1]) << {"": 0, "k": 10, "m": 20, "g": 30}[size[2]] if size else 0
    if now <= 0 or now > most:
        spark.conf.set(BATCH_BYTES, str(most))


def give_back() -> None:
    """Return memory that this worker process freed but still holds, now and from now on: Spark uses
    Python workers again, and what they keep adds to the executor's share.  Arrays from 256 KB on go
    back to the system as soon as they are freed.  Where the C library has no such calls nothing is done."""
    pa.default_memory_pool().release_unused()
    name = ctypes.util.find_library("c")
    libc = ctypes.CDLL(name) if name else None
    if hasattr(libc, "malloc_trim") and hasattr(libc, "mallopt"):
        libc.mallopt(-3, 1 << 18)  # M_MMAP_THRESHOLD
        libc.malloc_trim(0)
