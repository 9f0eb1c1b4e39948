"""Exact top-k by inner product with a pivot-distance index.

Vectors become integers (``floor(256 * x)``), and a further coordinate gives all
of them one length. Then the largest inner product with a query is the smallest
distance to it, and distances obey the triangle inequality.

The index keys each vector by its nearest pivot and the distance to it; a block
holds vectors of one pivot sorted by that distance. A query looks into the block
of its own nearest pivot first, which gives it a radius: the distance of the
k-th best so far. A vector nearer than that lies, for every pivot, in the
annulus of distances within the radius of the query's own. So a query then
visits those pivots only whose range of distances meets the annulus, starts
there at its own distance, expands the annulus to both sides, and stops where
the bound passes the radius, which shrinks meanwhile.

Pivots are far-apart rows of a sample of ``SAMPLE`` vectors, by the hash of the
id; every vector is indexed. A pivot with many vectors has several blocks.

Scores are exact integers (as long as they are under 2**53). Defined results:
vectors that are null, empty, or hold null or non-finite numbers take no part,
nor do rows without id; a query doesn't meet rows with its own id; rows that
repeat an id are candidates each, and one query (the smallest vector); vectors
of different lengths don't meet; fewer candidates than ``k``: all of them; ties
go to the smaller id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from postlens.llm import vectors as V
from postlens.llm.common import drop_stored, stored

SAMPLE = 2000
PIVOTS = 32
ROWS = 4096  # vectors in a block
QUERIES = 256  # queries in a block
CHUNK = 512  # vectors by which an annulus grows
STEP = 50
K = 5
BLOCK = "dim int, pivot int, block int, low double, high double, ids binary, distances binary, data binary"
NO_SCORE = -(2**62)


def whole(m: np.ndarray) -> np.ndarray:
    return np.floor(256 * m.astype("f8"))


class Space:
    """The space of lengthened vectors of one dimension: its common squared length and its pivots."""

    def __init__(self, length2: float, pivots: np.ndarray):
        self.length2, self.pivots = length2, pivots
        self.last = np.sqrt(np.maximum(0, length2 - (pivots * pivots).sum(axis=1)))
        self.slack = 1e-6 * (1 + np.sqrt(length2))  # far above rounding

    def to_pivots(self, m: np.ndarray) -> np.ndarray:
        """Distances of data vectors to all pivots."""
        last = np.sqrt(np.maximum(0, self.length2 - (m * m).sum(axis=1)))
        product = m @ self.pivots.T + last[:, None] * self.last[None, :]
        return np.sqrt(np.maximum(0, 2 * (self.length2 - product)))

    def from_query(self, q: np.ndarray) -> np.ndarray:
        """Distances of queries, which have nothing in the further coordinate, to all pivots."""
        return np.sqrt(np.maximum(0, (q * q).sum(axis=1)[:, None] + self.length2 - 2 * (q @ self.pivots.T)))

    def radius(self, q: np.ndarray, score: float) -> float:
        """How far a vector of that score is from the query."""
        return float(np.sqrt(max(0.0, float(q @ q) + self.length2 - 2 * score))) + self.slack


def far_apart(m: np.ndarray, length2: float, count: int) -> np.ndarray:
    """Up to ``count`` different rows, each the farthest from those before."""
    space = Space(length2, m[:1])
    chosen, distance = [0], space.to_pivots(m)[:, 0]
    while len(chosen) < min(count, len(m)):
        i = int(distance.argmax())
        if distance[i] <= space.slack:
            break
        chosen.append(i)
        distance = np.minimum(distance, Space(length2, m[i : i + 1]).to_pivots(m)[:, 0])
    return m[chosen]


def sampled(rows: DataFrame, dim: int, count: int) -> np.ndarray:
    """The first ``SAMPLE`` of the ``count`` vectors of a dimension by the hash of the id.

    They are found on the executors, each of which would send the driver as many otherwise, among those of a low hash.
    """
    key, share = F.xxhash64("id"), 2 * SAMPLE / count
    while True:
        low = rows.where((F.col("dim") == dim) & (key <= min(2**63 - 1, int(share * 2**64) - 2**63)))
        first = stored(low.orderBy(key, "id").limit(SAMPLE).select("v"), "sample")
        found = first.collect()
        drop_stored(first)
        if len(found) == SAMPLE or share >= 1:
            return whole(np.array([r["v"] for r in found]))
        share *= 16  # ids repeat: their hashes don't spread


def spaces(rows: DataFrame) -> dict[int, Space]:
    """A space for each dimension; from a bounded sample and the largest length."""

    @pandas_udf("double")
    def length2(v):
        return v.map(lambda x: float((whole(x) ** 2).sum()))

    known = rows.groupBy("dim").agg(F.max(length2("v")).alias("l"), F.count("*").alias("n")).collect()  # one row for each dimension
    return {r["dim"]: Space(r["l"], far_apart(sampled(rows, r["dim"], r["n"]), r["l"], PIVOTS)) for r in known}


def build(rows: DataFrame, known) -> DataFrame:
    """The index: one row for each block of vectors of one pivot, sorted by distance."""

    @pandas_udf("pivot int, distance double")
    def keyed(v):
        import pandas as pd

        nearest, distance = np.zeros(len(v), "i4"), np.zeros(len(v))
        sizes = v.map(len).to_numpy()
        for dim in np.unique(sizes):
            at = np.flatnonzero(sizes == dim)
            d = known.value[int(dim)].to_pivots(whole(np.stack(v.iloc[at].to_list())))
            nearest[at], distance[at] = d.argmin(axis=1), d.min(axis=1)
        return pd.DataFrame({"pivot": nearest, "distance": distance})

    def pack(group: pa.Table) -> pa.Table:
        distance = group["distance"].to_numpy()
        order = np.argsort(distance, kind="stable")
        one = lambda v, t: pa.array([v], t)
        return pa.table({
            **{c: one(group[c][0].as_py(), pa.int32()) for c in ("dim", "pivot", "block")},
            "low": one(float(distance.min()), pa.float64()),
            "high": one(float(distance.max()), pa.float64()),
            "ids": one(group["id"].to_numpy().astype("i8")[order].tobytes(), pa.binary()),
            "distances": one(distance[order].astype("f8").tobytes(), pa.binary()),
            "data": one(whole(V.matrix(group["v"]))[order].astype("f8").tobytes(), pa.binary()),
        })

    placed = rows.select("id", "v", "dim", keyed("v").alias("k")).select("id", "v", "dim", "k.pivot", "k.distance")
    return V.blocks(placed, ROWS, "pivot").groupBy("dim", "pivot", "block").applyInArrow(pack, BLOCK)


def expand(q_id: int, q: np.ndarray, at: float, bound: int, space: Space, ids, distances, data, k: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``k`` best of one block for one query; ``bound`` is the k-th best score it knows."""
    best_ids, best = np.zeros(0, "i8"), np.zeros(0)
    radius = space.radius(q, bound) if bound > NO_SCORE else np.inf
    left = right = int(np.searchsorted(distances, at))
    while True:
        go_left = left > 0 and at - distances[left - 1] <= radius
        go_right = right < len(ids) and distances[right] - at <= radius
        if not go_left and not go_right:
            return best_ids, best
        parts = []
        if go_left:
            parts.append((max(0, left - CHUNK), left))
            left = parts[-1][0]
        if go_right:
            parts.append((right, min(len(ids), right + CHUNK)))
            right = parts[-1][1]
        for a, b in parts:
            scores, names = data[a:b] @ q, ids[a:b]
            use = (names != q_id) & (scores >= bound)
            best_ids, best = np.concatenate([best_ids, names[use]]), np.concatenate([best, scores[use]])
        order = np.lexsort((best_ids, -best))[:k]
        best_ids, best = best_ids[order], best[order]
        if len(best) == k:
            bound = max(bound, int(best[-1]))
            radius = min(radius, space.radius(q, bound))


def visited(asked: DataFrame, found: DataFrame, known, k: int) -> DataFrame:
    """Search every block for the queries that visit it (columns as in ``V.HITS``).

    Neither side is broadcast: Spark takes ``asked`` to be as small as the queries, but it has each once for every block.
    """
    tiles = asked.hint("merge").join(found, ["dim", "pivot", "block"]).select(
        "dim", "pivot", "q_ids", "q_bounds", "q_data", "ids", "distances", "data"
    )

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, pivot, q_ids, q_bounds, q_data, ids, distances, data in zip(*(batch.column(i) for i in range(8))):
                d, space = dim.as_py(), known.value[dim.as_py()]
                names, rows = np.frombuffer(ids.as_buffer(), "i8"), np.frombuffer(data.as_buffer(), "f8").reshape(-1, d)
                keys = np.frombuffer(distances.as_buffer(), "f8")
                q = np.frombuffer(q_data.as_buffer(), "f8").reshape(-1, d)
                at = space.from_query(q)[:, pivot.as_py()]
                bounds = np.frombuffer(q_bounds.as_buffer(), "i8")
                out = [[], [], []]
                for i, q_id in enumerate(np.frombuffer(q_ids.as_buffer(), "i8")):
                    hit_ids, hit = expand(int(q_id), q[i], at[i], int(bounds[i]), space, names, keys, rows, k)
                    if len(hit_ids):
                        for column, value in zip(out, (int(q_id), hit_ids, hit.astype("i8"))):
                            column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(out[0], pa.int64()), pa.array(out[1], pa.list_(pa.int64())), pa.array(out[2], pa.list_(pa.int64()))],
                    names=["query_id", "ids", "scores"],
                )

    return tiles.mapInArrow(search, V.HITS.format("long"))


def asked_blocks(asked: DataFrame, ranges, known, home: bool) -> DataFrame:
    """Queries, packed by the block that they visit: the first block of the nearest pivot, or all that the radius meets."""

    def route(group: pa.Table) -> pa.Table:
        dim, space = group["dim"][0].as_py(), known.value[group["dim"][0].as_py()]
        q = whole(V.matrix(group["v"]))
        ids, bounds = group["id"].to_numpy().astype("i8"), group["bound"].to_numpy().astype("i8")
        at = space.from_query(q)
        radius = np.array([np.inf if b == NO_SCORE else space.radius(x, b) for x, b in zip(q, bounds)])
        rows = []
        for pivot, last, low, high in ranges.value[dim]:
            if home:
                use = at.argmin(axis=1) == pivot
            else:
                use = (at[:, pivot] - radius <= high) & (at[:, pivot] + radius >= low)
            if use.any():
                sent = ids[use].tobytes(), bounds[use].tobytes(), q[use].tobytes()
                rows += [(dim, pivot, block, *sent) for block in range(1 if home else last + 1)]
        columns = list(zip(*rows)) if rows else [[]] * 6
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary())
        names = ("dim", "pivot", "block", "q_ids", "q_bounds", "q_data")
        return pa.table({n: pa.array(c, t) for n, c, t in zip(names, columns, kinds)})

    return V.blocks(asked, QUERIES).select("id", "v", "dim", "bound", "block").groupBy("dim", "block").applyInArrow(
        route, "dim int, pivot int, block int, q_ids binary, q_bounds binary, q_data binary"
    )


def top_k(df: DataFrame, k: int = K, step: int = STEP, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """``(query_id, rank, vec_id, score)`` for the queries: rows whose id is divisible by ``step``."""
    spark = df.sparkSession
    rows = V.valid(df, id_col, vector_col)
    known = spark.sparkContext.broadcast(spaces(rows))
    found = stored(build(rows, known), "index")
    # A few numbers for each pivot: the range of distances over its blocks, and how many there are.
    spans: dict[int, list] = {}
    summary = found.groupBy("dim", "pivot").agg(F.min("low").alias("low"), F.max("high").alias("high"), F.max("block").alias("last"))
    for r in summary.collect():
        spans.setdefault(r["dim"], []).append((r["pivot"], r["last"], r["low"], r["high"]))
    ranges = spark.sparkContext.broadcast(spans)
    asked = V.queries(rows, step).withColumn("bound", F.lit(NO_SCORE))
    first = V.merged(visited(asked_blocks(asked, ranges, known, True), found, known, k), k, "long")
    bounds = first.where(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").alias("_bound"))
    asked = asked.join(bounds, "id", "left").withColumn("bound", F.coalesce("_bound", "bound")).drop("_bound")
    return V.merged(visited(asked_blocks(asked, ranges, known, False), found, known, k), k, "long")
