"""Spelling variants: words one letter apart, found by products of blocks of letter counts.

A word is a vector of letter counts. Two words that differ by one inserted or
deleted letter have squared distance 1, by one replaced letter 2. The squared
distances of a block of words to another are ``|a|^2 + |b|^2 - 2ab``, one NumPy
product; pairs at most two apart are checked letter by letter.

Which blocks meet is decided by coarse counts: letters fall into ``CLASSES``
classes, and the counts of the classes name the cell of a word (so a cell has
one word length). One letter more adds one to a class, a replaced letter moves
at most one from a class to another: a cell needs only the cells that far away,
of its own or the next length. A cell of over ``CELL_CHARS`` letters is dealt
into blocks, and every block of it meets every block of the cells near it, each
pair of blocks in a group of its own: no group grows with the vocabulary.

Defined results: a null or empty text has no words; a null id is written as
nothing in the checksum (``:word``); repeated rows count as often as they stand
there; an empty table, or no word that is frequent enough, gives no rows. Words
of any length are compared whole. Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import Scratch, drop_stored, stored

RUN = re.compile("[A-Za-zÀ-ÿ]+")
LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}
HELD = 400_000  # different words that a task counts before it hands them on
CLASSES = 6
CELL_CHARS = 1 << 16  # letters in a block
TILE = 1 << 22  # entries of a product held at a time
EXACT = 2000  # letters up to which single precision holds all products


def spelled(run: str, key: int, every: int) -> str:
    """``run``, or it without one letter if its checksum, begun with ``key``, is a multiple of ``every``."""
    h = zlib.crc32(run.encode(), key)
    return run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]


def runs(text: str) -> list[str]:
    return RUN.findall(text.lower() if text.isascii() else text.translate(LOWER))


def word_counts(docs: DataFrame, min_chars: int, min_count: int, every: int, id_col: str, text_col: str) -> DataFrame:
    """``(word, n)`` of the words of ``docs`` that are long and frequent enough."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()

        def rows():
            batch = pa.RecordBatch.from_arrays([pa.array(held.keys(), pa.string()), pa.array(held.values(), pa.int64())], names=["word", "n"])
            held.clear()
            return batch

        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if not text:
                    continue
                begun = zlib.crc32(f"{'' if key is None else key}:".encode())
                for run, n in Counter(runs(text)).items():
                    if len(word := spelled(run, begun, every)) >= min_chars:
                        held[word] += n
                if len(held) > HELD:
                    yield rows()
        yield rows()

    part = docs.select(F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).mapInArrow(count, "word string, n long")
    return part.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def cell(word: Column) -> Column:
    """How many letters of each class."""
    of_class = F.transform(F.split(word, ""), lambda c: F.pmod(F.ascii(c), F.lit(CLASSES)))
    return F.array(*[F.size(of_class) - F.size(F.array_remove(of_class, F.lit(i))) for i in range(CLASSES)])


def steps() -> Column:
    """What is added to a cell for the cells whose words its words meet: itself, one letter more, one moved forward."""
    zero = [0] * CLASSES
    out = [zero] + [[int(i == j) for j in range(CLASSES)] for i in range(CLASSES)]
    out += [[(k == j) - (k == i) for k in range(CLASSES)] for i in range(CLASSES) for j in range(i + 1, CLASSES)]
    return F.array(*[F.array(*[F.lit(x).cast("int") for x in v]) for v in out])


def blocks_of(words: DataFrame, scratch: Scratch) -> tuple[DataFrame, DataFrame]:
    """``(cell, block, words, ns)`` and ``(cell, blocks)``."""
    placed = words.withColumn("cell", cell(F.col("word")))
    chars = F.sum(F.length("word").cast("long"))
    sizes = placed.groupBy("cell").agg(F.ceil(chars / CELL_CHARS).cast("int").alias("blocks"))
    sizes = scratch.stored(sizes, "cells")
    dealt = placed.join(sizes, "cell").withColumn("block", F.pmod(F.xxhash64("word"), "blocks").cast("int"))
    blocks = dealt.groupBy("cell", "block").agg(F.collect_list(F.struct("word", "n")).alias("w"))
    return scratch.stored(blocks.select("cell", "block", F.col("w.word").alias("words"), F.col("w.n").alias("ns")), "blocks"), sizes


def meetings(blocks: DataFrame, sizes: DataFrame) -> DataFrame:
    """Rows of the groups ``(cell, block, other)``: the words of a block (``own``), and those that they meet."""
    reach = sizes.select("cell", F.explode(steps()).alias("d")).select(
        "cell", F.zip_with("cell", "d", lambda a, b: (a + b).cast("int")).alias("near")
    )
    near = sizes.select(F.col("cell").alias("near"), F.col("blocks").alias("others"))
    # Spark takes the table for as small as it was before it was exploded, so it must be told not to broadcast it.
    reach = reach.hint("merge").join(near, "near")
    most = reach.groupBy("cell").agg(F.max("others").alias("others"))  # at least one: a cell meets itself
    own = blocks.join(most, "cell").select(
        "cell", "block", F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("other"), F.lit(0).alias("kind"), "words", "ns"
    )
    # A block meets all blocks of a cell that reaches its own.
    met = (
        reach.hint("merge").join(sizes, "cell").select(F.col("cell").alias("home"), F.col("near").alias("cell"), "blocks")
        .hint("merge").join(blocks, "cell")
        .select(
            F.col("home").alias("cell"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("_b"), F.col("block").alias("other"),
            F.when(F.col("home") == F.col("cell"), 1).otherwise(2).alias("kind"), "words", "ns",
        )
        .withColumnRenamed("_b", "block")
    )
    # Of a cell with itself each two blocks meet once.
    met = met.where("kind = 2 OR other >= block")
    columns = ("cell", "block", "other", "kind", "words", "ns")
    return own.select(*columns).union(met.select(*columns))


def codes(words: list[str]) -> np.ndarray:
    """The letters of words of one length, a row for each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), "u4").reshape(len(words), -1)


def letter_counts(matrix: np.ndarray, letters: np.ndarray) -> np.ndarray:
    n, size = len(matrix), len(letters)
    at = np.searchsorted(letters, matrix) + np.arange(n)[:, None] * size
    kind = "f4" if matrix.shape[1] <= EXACT else "f8"
    return np.bincount(at.ravel(), minlength=n * size).reshape(n, size).astype(kind)


def near_pairs(a: np.ndarray, b: np.ndarray, upper: bool) -> tuple[np.ndarray, np.ndarray]:
    """Rows of ``a`` and ``b`` that are one letter apart; ``b``'s words are as long or one longer.

    ``upper``: the two are the same block, and each pair is wanted once.
    """
    letters = np.union1d(a, b)
    left, right = letter_counts(a, letters), letter_counts(b, letters).astype("f4" if b.shape[1] <= EXACT else "f8")
    norms = (right * right).sum(1)
    most = 2 if a.shape[1] == b.shape[1] else 1
    found = []
    for at in range(0, len(a), step := max(1, TILE // max(1, len(b)))):
        rows = left[at : at + step]
        gram = rows @ right.T
        gram *= -2
        gram += norms
        gram += (rows * rows).sum(1)[:, None]
        i, j = np.nonzero(gram <= most)
        i += at
        if upper:
            i, j = i[i < j], j[i < j]
        found.append(verified(a, b, i, j))
    return tuple(map(np.concatenate, zip(*found)))


def verified(a: np.ndarray, b: np.ndarray, i: np.ndarray, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Those of the pairs that differ by exactly one letter."""
    kept, step = [np.zeros(0, bool)], max(1, TILE // b.shape[1])
    for at in range(0, len(i), step):
        x, y = a[i[at : at + step]], b[j[at : at + step]]
        n = x.shape[1]
        if n == y.shape[1]:
            kept.append((x != y).sum(1) == 1)
        else:  # what they share at the front and at the back covers the shorter one
            front = np.logical_and.accumulate(x == y[:, :n], axis=1).sum(1)
            back = np.logical_and.accumulate((x == y[:, 1:])[:, ::-1], axis=1).sum(1)
            kept.append(front + back >= n)
    keep = np.concatenate(kept)
    return i[keep], j[keep]


def neighbours(meetings: DataFrame) -> DataFrame:
    """``(word, n_near, best_n, best)`` for each word and group in which it has near words; of ties the smallest best."""

    def run(table: pa.Table) -> pa.Table:
        kinds = table.column("kind").to_pylist()
        rows = list(zip(kinds, table.column("words").to_pylist(), table.column("ns").to_pylist()))
        own = next(((w, n) for k, w, n in rows if k == 0), None)
        sums: dict[str, list] = {}
        if own:
            words, ns = own
            a = codes(words)
            by_length: dict[tuple[int, bool], tuple[list, list]] = {}
            same = table.column("block")[0].as_py() == table.column("other")[0].as_py()
            for k, w, n in rows:
                if k:
                    into = by_length.setdefault((len(w[0]), k == 1 and same), ([], []))
                    into[0].extend(w)
                    into[1].extend(n)
            for (_, itself), (others, other_ns) in by_length.items():
                if itself:
                    others, other_ns = words, ns
                i, j = near_pairs(a, a if itself else codes(others), itself)
                for x, y in zip(i.tolist(), j.tolist()):
                    for w, v, n in ((words[x], others[y], other_ns[y]), (others[y], words[x], ns[x])):
                        got = sums.get(w)
                        if got is None:
                            sums[w] = [1, n, v]
                        else:
                            got[0] += 1
                            if (n, got[2]) > (got[1], v) if n == got[1] else n > got[1]:
                                got[1:] = n, v
        got = sums.values()
        return pa.table({
            "word": pa.array(sums.keys(), pa.string()), "n_near": pa.array([g[0] for g in got], pa.int64()),
            "best_n": pa.array([g[1] for g in got], pa.int64()), "best": pa.array([g[2] for g in got], pa.string()),
        })

    return meetings.groupBy("cell", "block", "other").applyInArrow(run, "word string, n_near long, best_n long, best string")


def roots(links: DataFrame) -> DataFrame:
    """``(word, root)``, stored, for the words of ``links(word, form)``, which hold no cycle: each round doubles the way gone."""
    way = stored(links.select("word", F.col("form").alias("root")), "ways")
    while True:
        further = way.select(F.col("word").alias("root"), F.col("root").alias("_next"))
        if not way.join(further, "root").limit(1).count():
            return way
        longer = stored(way.join(further, "root", "left").select("word", F.coalesce("_next", "root").alias("root")), "ways")
        drop_stored(way)
        way = longer


def variants(
    docs: DataFrame, min_chars: int = 6, min_count: int = 5, every: int = 199, ratio: int = 5,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` for each word of ``min_chars`` letters that occurs ``min_count`` times.

    Of one in ``every`` pairs of document and run one letter is left out before
    words are counted. The form of a word is the near word of largest ``n`` if
    that is ``ratio`` times the word's own; the root is where forms lead.
    """
    scratch = Scratch()
    words = scratch.stored(word_counts(docs, min_chars, min_count, every, id_col, text_col), "words")
    blocks, sizes = blocks_of(words, scratch)
    found = neighbours(meetings(blocks, sizes))
    best = found.groupBy("word").agg(
        F.sum("n_near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("n"), "best")).alias("b")
    )
    enough = -F.col("b.n") >= ratio * F.col("n")
    described = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(enough, F.col("b.best")).alias("form"), F.when(enough, -F.col("b.n")).alias("form_n"),
    )
    described = stored(described, "variants")
    scratch.drop()
    ends = roots(described.where("form IS NOT NULL"))
    return described.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )
