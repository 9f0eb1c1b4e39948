"""Incremental cleaning and enrichment of arriving files.

Both stages read and write row by row, so they run in the stream as they are,
without state. Each micro-batch goes to a folder named by its number: a batch
that is replayed after a failure overwrites its own folder. Rows that fail a check
lie apart from the others in it, with the reason.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions import lookup
from postlens.operators import clean, enrich, state

STATE, OK, REJECTED = "_state", "ok", "rejected"
REASON = "_reason"

Stage = Callable[[DataFrame], DataFrame]
BATCH = "_micro_batch"


def shared_folder(spark: SparkSession) -> str:
    """A new folder on the storage all executors share, as ``spark.checkpoint.dir`` names it.

    Only a local session may do without the setting.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="postlens-")
    return f"{root.rstrip('/')}/{uuid.uuid4().hex}"


def run_stream(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    stage: Stage,
    out: str,
    checkpoint: str,
    max_files: int | None = None,
    per_batch: bool = False,
    key: str = "id_post",
) -> None:
    """Process the files under ``source`` that no earlier run has seen, then stop.

    The stage is planned once for the whole stream, or for each micro-batch if
    it is not row by row.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)

    def checked(df: DataFrame) -> DataFrame:
        missing = F.when(F.col(key).isNull(), "missing_id")
        reason = F.coalesce(F.col(REASON), missing) if REASON in df.columns else missing
        return df.withColumn(REASON, reason).withColumn(STATE, F.when(reason.isNull(), OK).otherwise(REJECTED))

    whole = lambda df: df.transform(stage).transform(checked)

    def write(batch: DataFrame, number: int) -> None:
        rows = whole(batch) if per_batch else batch
        rows.write.mode("overwrite").partitionBy(STATE).parquet(f"{out}/{BATCH}={number}")

    arriving = reader.parquet(source)
    query = (
        (arriving if per_batch else whole(arriving))
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def read_results(spark: SparkSession, out: str, key: str = "id_post", version: str | None = None) -> DataFrame:
    """The results of all batches; of rows with the same key the one of greatest ``version`` counts, then of the last batch."""
    rows = spark.read.parquet(out)
    if STATE in rows.columns:
        rows = rows.where(F.col(STATE) == OK)
    return state.latest_rows(rows, key, [*([version] if version else []), BATCH]).drop(BATCH, STATE, REASON)


def read_rejected(spark: SparkSession, out: str, key: str = "id_post") -> DataFrame:
    """``(id, reason)`` of the rows that failed a check."""
    return spark.read.parquet(out).where(F.col(STATE) == REJECTED).select(F.col(key).alias("id"), F.col(REASON).alias("reason"))


def incremental_clean(
    spark: SparkSession, source: str, schema: T.StructType, out: str, checkpoint: str, max_files: int | None = None,
    key: str = "id_post",
) -> None:
    """Clean the posts in files that arrived since the last run."""
    run_stream(spark, source, schema, clean.preprocess, out, checkpoint, max_files, key=key)


def incremental_nlp(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    out: str,
    checkpoint: str,
    terms: DataFrame,
    profiles: DataFrame | None = None,
    max_files: int | None = None,
    max_keys: int = lookup.MAX_KEYS,
    scorer: Stage | None = None,
) -> None:
    """Enrich the cleaned posts in files that arrived since the last run.

    ``terms`` and ``profiles`` are stored tables. One that is too large to be
    read inside the row is joined, which needs a plan per micro-batch. ``scorer`` is one more stage (``scorer.scoring``).
    """
    tables = [(terms, ["term"]), *([(profiles, ["gram", "lang"])] if profiles is not None else [])]
    joined = any(lookup.bounded_rows(table, keys, max_keys) is None for table, keys in tables)
    scored = scorer or (lambda df: df)
    stage = lambda df: scored(enrich.enrich(df, terms, profiles, max_keys=max_keys))
    run_stream(spark, source, schema, stage, out, checkpoint, max_files, per_batch=joined)
