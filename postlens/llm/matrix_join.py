"""Nearest neighbours by a join of matrix blocks.

Vectors and queries are cut into blocks, and every pair of a query block and a
vector block is one tile. A tile first multiplies the vectors as 8-bit integers
with a scale for each vector. The part of a vector that rounding loses bounds how
far such a product can be off, so each pair has a lower and an upper bound. The
k-th largest lower bound of a query is a line that its neighbours can't be
below: only pairs whose upper bound reaches it are multiplied again in double
precision. The short lists of the tiles are merged by heaps.

The bounds hold for every pair, so nothing is missed and the recall is 1.

Nearness is the inner product in double precision, summed in the order of the
components. Defined results: vectors that are null, empty, zero, or hold null or
non-finite numbers take no part, nor do rows without id; a query doesn't meet
rows with its own id; rows that repeat an id are candidates each, and one query
(the smallest vector); vectors of different lengths don't meet; fewer candidates
than ``k``: all of them; ties go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from postlens.llm import vectors as V
from postlens.llm.common import stored

ROWS = 4096  # vectors in a block
QUERIES = 512  # queries in a block
STEP = 20
K = 20
BLOCK = "dim int, block int, ids binary, data binary"


def quantised(m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """8-bit integers, scales, and the lengths of the rounded vectors, of what rounding loses, and of the vectors."""
    wide = m.astype("f8")
    scale = np.abs(wide).max(axis=1) / 127
    codes = np.rint(wide / scale[:, None])
    rounded = codes * scale[:, None]
    length = lambda x: np.sqrt((x * x).sum(axis=1))
    return codes.astype("i1"), scale, length(rounded), length(wide - rounded), length(wide)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact integer products of 8-bit rows; single precision holds sums of up to 1,040 of them exactly."""
    out = np.zeros((len(a), len(b)), "f4" if a.shape[1] <= 1040 else "f8")
    for at in range(0, a.shape[1], 1040):
        out += a[:, at : at + 1040].astype("f4") @ b[:, at : at + 1040].astype("f4").T
    return out


def tile(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, m: np.ndarray, k: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(query, ids, scores)``: the ``k`` nearest of one block, for each query of another."""
    qc, qs, q_round, q_lost, _ = quantised(q)
    mc, ms, _, m_lost, m_len = quantised(m)
    near = products(qc, mc).astype("f8") * qs[:, None] * ms[None, :]
    off = q_round[:, None] * m_lost[None, :] + q_lost[:, None] * m_len[None, :]
    off = off * (1 + 1e-9) + 1e-12 * (1 + np.abs(near))
    own = q_ids[:, None] == ids[None, :]
    low = np.where(own, -np.inf, near - off)
    if low.shape[1] > k:
        line = np.partition(low, low.shape[1] - k, axis=1)[:, low.shape[1] - k]
    else:
        line = np.full(len(q), -np.inf)
    rows, columns = np.nonzero((near + off >= line[:, None]) & ~own)
    scores = np.zeros(len(rows))
    wide_q, wide_m = q.astype("f8"), m.astype("f8")
    for j in range(q.shape[1]):  # in order, so that equal vectors have equal scores in any block
        scores += wide_q[rows, j] * wide_m[columns, j]
    order = np.lexsort((ids[columns], -scores, rows))
    rows, columns, scores = rows[order], columns[order], scores[order]
    first = np.searchsorted(rows, np.arange(len(q)))
    last = np.minimum(np.searchsorted(rows, np.arange(len(q)), "right"), first + k)
    for i in range(len(q)):
        if last[i] > first[i]:
            yield int(q_ids[i]), ids[columns[first[i] : last[i]]], scores[first[i] : last[i]]


def packed(rows: DataFrame, size: int) -> DataFrame:
    """One row for each block of about ``size`` vectors."""

    def pack(group: pa.Table) -> pa.Table:
        return pa.table({
            "dim": pa.array([group["dim"][0].as_py()], pa.int32()),
            "block": pa.array([group["block"][0].as_py()], pa.int32()),
            "ids": pa.array([group["id"].to_numpy().astype("i8").tobytes()], pa.binary()),
            "data": pa.array([V.matrix(group["v"]).astype("f4").tobytes()], pa.binary()),
        })

    return V.blocks(rows, size).select("id", "v", "dim", "block").groupBy("dim", "block").applyInArrow(pack, BLOCK)


def nearest(df: DataFrame, k: int = K, step: int = STEP, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the queries: rows whose id is divisible by ``step``."""
    rows = V.valid(df, id_col, vector_col).where(F.exists("v", lambda x: x != 0))
    data = stored(packed(rows, ROWS), "blocks")
    asked = packed(V.queries(rows, step), QUERIES).select("dim", F.col("ids").alias("q_ids"), F.col("data").alias("q_data"))
    # Each query block goes to every vector block of its dimension.
    count = data.groupBy("dim").agg((F.max("block") + 1).alias("n"))
    tiles = (
        asked.join(F.broadcast(count), "dim")  # one row for each dimension
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.col("n") - 1)))
        .join(data, ["dim", "block"])
        .select("dim", "q_ids", "q_data", "ids", "data")
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, q_ids, q_data, ids, data in zip(*(batch.column(i) for i in range(5))):
                d = dim.as_py()
                found = list(tile(
                    np.frombuffer(q_ids.as_buffer(), "i8"), np.frombuffer(q_data.as_buffer(), "f4").reshape(-1, d),
                    np.frombuffer(ids.as_buffer(), "i8"), np.frombuffer(data.as_buffer(), "f4").reshape(-1, d), k,
                ))
                columns = list(zip(*found)) if found else [[]] * 3
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.list_(pa.int64())), pa.array(columns[2], pa.list_(pa.float64()))],
                    names=["query_id", "ids", "scores"],
                )

    return V.merged(tiles.mapInArrow(search, V.HITS.format("double")), k, "double")
