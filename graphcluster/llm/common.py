"""Helpers shared by the training-data operators."""

from __future__ import annotations

import atexit
import ctypes
import os
import shutil
import sys
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Iterator
from functools import partial

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import StructField, StructType

from graphcluster.session import ensure_checkpoint_dir, scratch_dir

#: Words are runs of anything but ASCII white space (space, tab to carriage return).
WORD = r"[^\x20\x09-\x0D]+"

#: Arrow batches are kept small, so that a task's memory doesn't follow the length
#: of texts: Spark's usual value, and ours in its place (a user's own value stays).
BATCH = {"spark.sql.execution.arrow.maxRecordsPerBatch": ("10000", "2000"),
         "spark.sql.execution.arrow.maxBytesPerBatch": ("67108864b", "8m")}

_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors (once per application), so that tasks
    can import the operators wherever the driver was started from; and bound the
    size of Arrow batches."""
    app = spark.sparkContext.applicationId
    if app in _SHIPPED:
        return
    for key, (usual, bound) in BATCH.items():
        if spark.conf.get(key, usual) == usual:
            spark.conf.set(key, bound)
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    name = os.path.basename(top)
    folder = tempfile.mkdtemp(prefix="ship-")  # the driver serves the archive from here
    atexit.register(shutil.rmtree, folder, True)
    target = os.path.join(folder, f"{name}-{uuid.uuid4().hex[:8]}.zip")
    with zipfile.ZipFile(target, "w") as z:
        for base, _, files in os.walk(top):
            for f in files:
                if f.endswith(".py"):
                    full = os.path.join(base, f)
                    z.write(full, os.path.join(name, os.path.relpath(full, top)))
    before = list(sys.path)
    spark.sparkContext.addPyFile(target)
    sys.path[:] = before  # the driver keeps importing from its own folder
    _SHIPPED.add(app)


#: What a worker process remembers between batches, by module: how to forget it.
MEMOS: dict[str, Callable[[], None]] = {}


def enter(module: str) -> None:
    """Called by a task of an operator: a worker that now serves this operator
    forgets what others remembered, so that memos of several never add up."""
    for name, forget in MEMOS.items():
        if name != module:
            forget()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
    if trim:
        trim(0)


class Table:
    """A table written under the checkpoint folder: ``df`` reads it, ``drop`` deletes it.

    A lost executor re-reads the files; nothing before the write is replayed.
    ``codec``: the files' compression, if not the session's.
    """

    def __init__(self, df: DataFrame, name: str, partition_by: list[str] | None = None, codec: str | None = None):
        spark = df.sparkSession
        ensure_checkpoint_dir(spark)
        self.path = scratch_dir(spark, name)
        writer = df.write.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        if codec:
            writer = writer.option("compression", codec)
        writer.parquet(self.path)
        self.spark = spark
        schema = df.schema
        if partition_by:
            kept = [f for f in schema.fields if f.name not in partition_by]
            schema = StructType(kept + [schema[c] for c in partition_by])
        self.df = spark.read.schema(schema).parquet(self.path)

    def drop(self) -> None:
        sc = self.spark.sparkContext
        where = sc._jvm.org.apache.hadoop.fs.Path(self.path)
        where.getFileSystem(sc._jsc.hadoopConfiguration()).delete(where, True)


def free_shuffles(spark: SparkSession) -> None:
    """Let Spark's cleaner delete the shuffle files of finished steps now.

    Spark deletes them once the driver's garbage collector has seen that no
    plan refers to them; a step that has written its table needs them no more.
    """
    import gc
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions", "200"))


def arrow_map(df: DataFrame, inputs: list[str], outputs: list[StructField],
              fn: Callable[..., list]) -> DataFrame:
    """Append columns computed per Arrow batch by ``fn(*input arrays) -> output arrays``.

    An output column replaces an input column of the same name (compared as
    Spark does, without regard to case); all other columns pass through.
    """
    ship(df.sparkSession)
    new = {f.name.lower() for f in outputs}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    schema = StructType(kept + outputs)
    names = [f.name for f in schema.fields]
    module = (fn.func if isinstance(fn, partial) else fn).__module__
    types = [to_arrow_type(f.dataType) for f in outputs]
    kept_names = [f.name for f in kept]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enter(module)
        for batch in batches:
            made = fn(*(batch.column(batch.schema.get_field_index(c)) for c in inputs))
            made = [a if isinstance(a, pa.Array) else pa.array(a, type=t)
                    for a, t in zip(made, types, strict=True)]
            old = [batch.column(batch.schema.get_field_index(c)) for c in kept_names]
            yield pa.RecordBatch.from_arrays(old + made, names=names)

    return df.mapInArrow(run, schema)


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")
