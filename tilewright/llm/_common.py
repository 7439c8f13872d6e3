"""What the training-data operators share: tables, staged files, Arrow maps."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import gc
import os
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tilewright.shipping import ship

#: Rows and bytes of one Arrow batch: bounds a Python worker's memory whatever the texts' lengths.
BATCH_ROWS, BATCH_BYTES = 2000, 32 << 20

#: Words and white space as every operator of this package understands them.
WORD = r"[^\x20\x09-\x0D]+"


def configure(spark: SparkSession) -> None:
    """Session settings that bound the memory of Arrow exchange; sends the package to the workers."""
    ship(spark)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    configure(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_own_dir: str | None = None


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir; only where that is unset
    (single-machine tests) a temporary folder of our own."""
    global _own_dir
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if _own_dir is None or not os.path.isdir(_own_dir):
        _own_dir = tempfile.mkdtemp(prefix="tilewright-")
    return f"file://{_own_dir}"


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/tilewright/{name}-{uuid.uuid4().hex}"


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a staged folder through Hadoop's file system."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hadoop, True)


def _remove_late(spark: SparkSession, path: str) -> None:
    try:
        remove(spark, path)
    except Exception:  # the session may have ended before
        pass


#: Folders to be removed at the end of each open scratch().
_scopes: list[list[str]] = []


@contextlib.contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What is staged inside goes at the end, but for tables staged as results."""
    _scopes.append([])
    try:
        yield
    finally:
        for path in _scopes.pop():
            _remove_late(spark, path)


def staged(df: DataFrame, name: str, result: bool = False) -> DataFrame:
    """Writes df as Parquet into the shared folder and rereads it: cuts lineage, and outlives lost
    executors.  The files go at the end of the innermost scratch(), those of its result at the end of the one
    around it, and where there is none when the driver's process ends."""
    spark = df.sparkSession
    path = fresh_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    scopes = _scopes[:-1] if result else _scopes
    if scopes:
        scopes[-1].append(path)
    else:
        atexit.register(_remove_late, spark, path)
    return spark.read.schema(df.schema).parquet(path)


#: What a worker process empties when a task ends.
AT_TASK_END: list[Callable[[], None]] = []


@contextlib.contextmanager
def task_memory() -> Iterator[None]:
    """For the time of a task: no searches for cyclic garbage (kernels make none); afterwards memories are
    emptied and freed memory goes back to the system, as Spark keeps idle workers for long."""
    gc.disable()
    try:
        yield
    finally:
        for empty in AT_TASK_END:
            empty()
        gc.enable()
        gc.collect()
        try:
            ctypes.CDLL("libc.so.6").malloc_trim(0)
        except (OSError, AttributeError):  # another C library
            pass


def arrow_map(df: DataFrame, kernel: Callable[[pa.RecordBatch], pa.RecordBatch | None], schema: T.StructType | str, gather: int = 0) -> DataFrame:
    """kernel on every Arrow batch of df; with gather, on runs of batches of about so many bytes, for
    kernels whose work is shared by the rows they see together."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        with task_memory():
            for batch in batches:
                if not batch.num_rows:
                    continue
                held.append(batch)
                size += batch.nbytes
                if size >= gather:
                    yield from made(held)
                    held, size = [], 0
            if held:
                yield from made(held)

    def made(held: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        batch = held[0] if len(held) == 1 else pa.concat_batches(held)
        if (out := kernel(batch)) is not None:
            yield out

    configure(df.sparkSession)
    return df.mapInArrow(run, schema)


def free_name(columns: list[str], name: str) -> str:
    """A column name that no column has, whatever its case."""
    taken = {c.lower() for c in columns}
    while name in taken:
        name += "_"
    return name


def texts_of(column: pa.Array) -> list[str]:
    """Python strings, null as empty."""
    return ["" if x is None else x for x in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column, null as empty, without building Python strings."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def word_count(text) -> F.Column:
    """Number of words (runs outside of the ASCII white space) of a string column, null: 0.
    White space becomes spaces, runs of them one, and the spaces between words are counted."""
    space = F.translate(F.coalesce(text, F.lit("")), "\t\n\x0b\x0c\r", "     ")
    trimmed = F.trim(F.regexp_replace(space, " {2,}", " "))
    return F.when(trimmed == "", F.lit(0)).otherwise(F.length(trimmed) - F.length(F.replace(trimmed, F.lit(" "), F.lit(""))) + 1).cast("long")


def numbered(df: DataFrame, keys: list[str], order: list[str], rows: int = 20_000, out: str = "rn", few: bool = False) -> DataFrame:
    """A gapless number from 0 for each row among the rows of equal keys, without bringing the rows
    of one key together: rows are dealt into buckets by a hash of `order`, counted, and numbered
    inside their bucket; a running sum over the (few) bucket counts gives each bucket's first number.
    `order` must identify a row among those of its key, repeated rows aside (which then share the
    bucket and are interchangeable).  A key has about count/rows buckets.  few: there are so few keys that
    tables of a row for each bucket may be sent to all executors."""
    from pyspark.sql import Window

    null_safe = [F.col(k) for k in keys]
    sizes = df.groupBy(*null_safe).agg(F.count(F.lit(1)).alias("__n"))
    sizes = sizes.select(*keys, F.ceil(F.col("__n") / rows).cast("int").alias("__b"))
    dealt = df.join(F.broadcast(sizes) if few else sizes, keys).withColumn("__k", F.pmod(F.xxhash64(*order), F.col("__b")).cast("int")).drop("__b")
    counts = dealt.groupBy(*keys, "__k").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*keys).orderBy("__k").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(*keys, "__k", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__from"))
    inside = Window.partitionBy(*keys, "__k").orderBy(*order)
    ranked = dealt.withColumn("__r", F.row_number().over(inside) - 1)
    return ranked.join(F.broadcast(starts) if few else starts, [*keys, "__k"]).withColumn(out, (F.col("__from") + F.col("__r")).cast("long")).drop("__k", "__r", "__from")
