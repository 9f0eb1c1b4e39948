"""Tables of vectors in blocks, and the merging of partial top lists."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import partitions

HITS = "query_id long, ids array<long>, scores array<{0}>"


def usable(vector: Column) -> Column:
    """True for vectors that are there, not empty, and hold finite numbers only."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(vector) > 0) & finite, F.lit(False))


def valid(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(id, v, dim)`` of the usable vectors; those without id can't be named in a result and stay out."""
    return df.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector_col}`").cast("array<float>").alias("v")
    ).where(F.col("id").isNotNull() & usable(F.col("v"))).withColumn("dim", F.size("v"))


def queries(rows: DataFrame, step: int) -> DataFrame:
    """The rows whose id is divisible by ``step``, one for each id (the smallest vector)."""
    return rows.where(F.col("id") % step == 0).groupBy("id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v"))


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """An array column of equal lengths as a matrix."""
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def blocks(rows: DataFrame, size: int, *keys: str) -> DataFrame:
    """``rows`` with ``block``: about ``size`` rows of equal ``dim`` (and ``keys``) share a number, by hash."""
    counts = rows.groupBy("dim", *keys).agg(F.ceil(F.count("*") / size).cast("int").alias("blocks"))
    return rows.join(F.broadcast(counts), ["dim", *keys]).withColumn(
        "block", F.pmod(F.xxhash64("id", "v"), F.col("blocks")).cast("int")
    )


def merged(hits: DataFrame, k: int, kind: str) -> DataFrame:
    """The ``k`` best of each query: ``(query_id, rank, vec_id, score)``; ties to the smaller id.

    ``hits`` are partial lists (columns as in ``HITS``). Every query has one
    task, which keeps a heap of ``k`` for each of its queries.
    """

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, list[tuple]] = {}
        for batch in batches:
            for query, ids, scores in zip(*(batch.column(i).to_pylist() for i in range(3))):
                heap = best.setdefault(query, [])
                for item in zip(scores, (-i for i in ids)):
                    if len(heap) < k:
                        heapq.heappush(heap, item)
                    elif item > heap[0]:
                        heapq.heapreplace(heap, item)
        rows = [
            (query, rank, -minus, score)
            for query, heap in best.items()
            for rank, (score, minus) in enumerate(sorted(heap, reverse=True), 1)
        ]
        kinds = (pa.int64(), pa.int32(), pa.int64(), pa.float64() if kind == "double" else pa.int64())
        columns = list(zip(*rows)) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(columns, kinds)], names=["query_id", "rank", "vec_id", "score"]
        )

    return hits.repartition(partitions(hits.sparkSession), "query_id").mapInArrow(
        merge, f"query_id long, rank int, vec_id long, score {kind}"
    )
