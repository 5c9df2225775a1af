"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import re
import uuid
from collections.abc import Callable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes up to which a table may be broadcast after its size was measured.
BROADCAST_BYTES = 16 << 20
#: Rows and bytes of an Arrow batch handled at once: what bounds a Python worker's memory.
#: A single row may be larger; it then is a batch by itself.
SLICE_ROWS = 1_000
BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    It is the session's ``spark.checkpoint.dir``; only where that is unset (a
    local session in tests) a folder of our own is set.
    """
    own = spark.sparkContext.getCheckpointDir()
    if own:
        return own
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        import tempfile

        at = f"{tempfile.gettempdir()}/layoutlake-checkpoints"
    spark.sparkContext.setCheckpointDir(at)
    return spark.sparkContext.getCheckpointDir()


def written(df: DataFrame, name: str, *partition_by: str) -> DataFrame:
    """Cut lineage: write ``df`` to the shared folder and read it again."""
    spark = df.sparkSession
    at = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.partitionBy(*partition_by).parquet(at) if partition_by else df.write.parquet(at)
    return spark.read.schema(df.schema).parquet(at)


def drop_written(*frames: DataFrame) -> None:
    """Delete tables that ``written`` made and no later plan reads."""
    for df in frames:
        spark = df.sparkSession
        roots = {re.sub(r"/(?:[^/]*=[^/]*/)*part-[^/]*$", "", f) for f in df.inputFiles()}
        for root in roots:
            path = spark._jvm.org.apache.hadoop.fs.Path(root)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until no column of ``df`` has that name."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def small(df: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` marked for broadcast if its rows take at most ``limit`` bytes, else as it is.

    ``df`` should be a written table of numbers and strings, so that measuring it is cheap.
    """
    kinds = dict(df.dtypes)
    wide = [c for c, kind in kinds.items() if kind in ("string", "binary")]
    if any("<" in kind for kind in kinds.values()):
        raise ValueError("a table with nested columns isn't broadcast")
    size = F.lit(16 * len(kinds) + 16)
    for c in wide:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    taken = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    return F.broadcast(df) if taken <= limit else df


def bounded(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches limited to BATCH_BYTES."""
    conf, name = df.sparkSession.conf, "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(conf.get(name).rstrip("b")) != BATCH_BYTES:
        conf.set(name, f"{BATCH_BYTES}b")
    return df


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``batches``; at the end the worker gives memory that it no longer uses back to the machine."""
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        trim = _trim()
        if trim:
            trim(0)


@lru_cache(maxsize=1)
def _trim():
    try:
        return ctypes.CDLL(None).malloc_trim
    except (OSError, AttributeError):
        return None


def map_batches(df: DataFrame, make: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]], schema: str) -> DataFrame:
    """Map Arrow batches with a function that ``make`` builds once a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        each = make()
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE_ROWS):
                yield each(batch.slice(at, SLICE_ROWS))

    return bounded(df).mapInArrow(lambda batches: released(run(batches)), schema)


def crc_fold(doc_id, folds: int = 5):
    """crc32 of the id as text, modulo ``folds``."""
    return F.crc32(doc_id.cast("string").cast("binary")) % folds
