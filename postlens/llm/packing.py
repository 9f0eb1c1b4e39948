"""Packing of token sequences: shortest pack first, over the histogram of lengths.

Every document is cut into pieces of ``size`` tokens and one rest. Only the
number of pieces of each length, at most ``size`` numbers, goes to the driver.
There the lengths are placed longest first: a length goes into the pack that is
shortest so far, if it fits, else into a new one. Equal packs are one pattern
with a count, so that a step places many pieces at once and the number of
patterns stays under twice the number of lengths. Then each piece gets its rank
among the pieces of its length and with it its place: the patterns give, for a
length, ranges of ranks.

Ranks are dealt out per length and salt, so that a length that a third of all
documents have is not numbered in one task.

Defined results: a null or empty text is one piece, the end id alone; rows that
repeat an id are packed each for themselves; an empty table gives no piece;
further columns are not read. Sequence numbers are 0, 1, ... without gap.
"""

from __future__ import annotations

import heapq
import zlib
from collections import defaultdict

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from postlens.llm import bpe
from postlens.llm.common import map_columns, partitions, stored

SIZE = 4096
END_ID = 2
SLOTS = "length int, first long, until long, packs long, sequence long, place int"


def cut(df: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents: ``id_col, start, length, ids_crc32, doc_tokens``."""
    source = bpe.vocabulary(df.sparkSession, path)
    end = end_id.to_bytes(4, "little")

    def start():
        encoder = bpe.loaded(source.value)

        def pieces(keys, texts):
            rows = []
            for key, ids in zip(keys, encoder.ids(texts)):
                data = ids + end
                for at in range(0, len(data), 4 * size):
                    part = data[at : at + 4 * size]
                    rows.append((key, at // 4, len(part) // 4, zlib.crc32(part), len(data) // 4))
            return list(zip(*rows))

        return pieces

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(
        df.select(id_col, text_col), start, f"`{id_col}` {kind}, start long, length int, ids_crc32 long, doc_tokens long"
    )


def patterns(counts: dict[int, int], size: int = SIZE) -> list[tuple[int, list[tuple[int, int]]]]:
    """Packs for ``counts[length]`` pieces of each length: ``(number of packs, [(length, times), ...])``.

    All pieces are placed and no pack is longer than ``size``.
    """
    open_packs: dict[int, list[tuple[int, list]]] = {}  # by tokens so far
    shortest: list[int] = []  # heap of the keys

    def put(used: int, number: int, parts: list) -> None:
        if used not in open_packs:
            open_packs[used] = []
            heapq.heappush(shortest, used)
        open_packs[used].append((number, parts))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            if shortest and shortest[0] + length <= size:
                used = shortest[0]
                number, parts = open_packs[used].pop()
                if not open_packs[used]:
                    del open_packs[heapq.heappop(shortest)]
                if number > left:
                    put(used, number - left, parts)
                    number = left
                times = 1
            else:
                # A new pack stays the shortest until this length fits no more.
                used, parts, times = 0, [], min(size // length, left)
                number = left // times
            if parts and parts[-1][0] == length:
                joined = [*parts[:-1], (length, parts[-1][1] + times)]
            else:
                joined = [*parts, (length, times)]
            put(used + length * times, number, joined)
            left -= number * times
    return [pack for used in sorted(open_packs, reverse=True) for pack in open_packs[used]]


def slots(packs: list[tuple[int, list[tuple[int, int]]]]) -> list[tuple]:
    """For each length the ranges of ranks and where they go (columns as in ``SLOTS``)."""
    taken: dict[int, int] = defaultdict(int)
    rows, sequence = [], 0
    for number, parts in packs:
        place = 0
        for length, times in parts:
            first = taken[length]
            taken[length] += times * number
            rows.append((length, first, taken[length], number, sequence, place))
            place += length * times
        sequence += number
    return rows


def ranked(pieces: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """``pieces`` with ``_rank``, 0, 1, ... among those of one length."""
    salts = partitions(pieces.sparkSession)
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64(id_col, "start"), F.lit(salts)).cast("int"))
    counts = salted.groupBy("length", "_salt").count()
    before = counts.select(
        "length",
        "_salt",
        (F.sum("count").over(Window.partitionBy("length").orderBy("_salt")) - F.col("count")).alias("_before"),
    )
    inside = F.row_number().over(Window.partitionBy("length", "_salt").orderBy(id_col, "start", "ids_crc32", "doc_tokens"))
    return (
        salted.withColumn("_inside", inside - 1)
        .join(before, ["length", "_salt"])
        .withColumn("_rank", F.col("_before") + F.col("_inside"))
        .drop("_salt", "_before", "_inside")
    )


def pack(df: DataFrame, path: str, size: int = SIZE, end_id: int = END_ID, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The pieces of all documents with ``sequence_id`` and ``offset`` in that sequence."""
    spark: SparkSession = df.sparkSession
    pieces = stored(cut(df, path, size, end_id, id_col, text_col), "pieces")
    counts = {r["length"]: r["count"] for r in pieces.groupBy("length").count().collect()}  # size rows at most
    places = spark.createDataFrame(slots(patterns(counts, size)), SLOTS)
    rank = F.col("_rank") - F.col("first")
    return (
        # One row for each pattern and length in it: bounded by the number of lengths, not by the input.
        ranked(pieces, id_col).join(F.broadcast(places), "length")
        .where("_rank >= first AND _rank < until")
        .select(
            id_col,
            "start",
            F.col("length").cast("long").alias("length"),
            "ids_crc32",
            "doc_tokens",
            (F.col("sequence") + rank % F.col("packs")).alias("sequence_id"),
            (F.col("place") + F.col("length") * F.floor(rank / F.col("packs"))).cast("long").alias("offset"),
        )
    )
