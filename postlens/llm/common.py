"""Helpers of the operators: tasks over Arrow columns, tables in the shared folder."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

ROWS = 256  # rows that a task turns into Python objects at a time


def map_columns(df: DataFrame, start: Callable[[], Callable], schema: str) -> DataFrame:
    """Apply a function of whole columns to every batch of ``df``.

    ``start()`` runs once in each task and returns a function that takes one
    list per column of ``df`` and returns one list per field of ``schema``, of
    any one length.
    """
    fields = T.StructType.fromDDL(schema)
    types = [to_arrow_type(f.dataType) for f in fields]
    names = fields.names

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apply = start()
        for batch in batches:
            for at in range(0, batch.num_rows, ROWS):
                part = batch.slice(at, ROWS)
                out = apply(*[part.column(i).to_pylist() for i in range(part.num_columns)])
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=names)

    return df.mapInArrow(run, fields)


def shared_root(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``; on one machine a temporary folder will do."""
    root = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if root:
        return root
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return _local_root()


_ROOT: list[tempfile.TemporaryDirectory] = []


def _local_root() -> str:
    if not _ROOT:
        _ROOT.append(tempfile.TemporaryDirectory(prefix="postlens-"))
        atexit.register(_ROOT[0].cleanup)
    return f"file://{_ROOT[0].name}"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as a table in the shared folder and read again.

    Cuts the lineage: lost executors cost no earlier stage, and what follows may
    read the rows several times.
    """
    path = f"{shared_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def drop_stored(df: DataFrame) -> None:
    """Delete a table that ``stored`` made and nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rpartition("/")[0] for f in df.inputFiles()}:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


class Scratch:
    """Stored tables that go together, when what is made of them is stored."""

    def __init__(self):
        self.tables: list[DataFrame] = []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        self.tables.append(stored(df, name))
        return self.tables[-1]

    def drop(self) -> None:
        for table in self.tables:
            drop_stored(table)
        self.tables.clear()


def small_or_joined(keys: DataFrame, limit: int) -> DataFrame:
    """``keys``, which are stored, with a broadcast hint if they are ``limit`` rows at most; else as they are."""
    return F.broadcast(keys) if keys.count() <= limit else keys


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
