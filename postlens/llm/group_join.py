"""Set similarity join of documents on word shingles: a grouped prefix join.

Two documents link when the Jaccard similarity of their sets of distinct word
shingles reaches a bound. Shingles have one order in all documents: rare ones
first, those that the lossy count finds frequent after them by their frequency,
and by hash within. Similar sets must share a shingle among the first few of
each, the prefix.

1. Copies with equal sets collapse into one set.
2. Sets with equal prefix and size collapse into one group. Only groups enter
   the index from prefix shingles to groups; entries go that have no other of a fitting size.
3. Group pairs that share a shingle pass the size and position filters and are
   expanded to their members. Member pairs pass a sketch filter and are verified
   on whole texts. A sketch holds, for each of ``BITS`` classes of shingles, whether
   their number is odd: two sets differ in as many shingles as their sketches in
   bits, or more, so that no similar pair is lost.

Components need no more links than join them, so step 3 runs twice: first each
group meets only a few pivots among the groups that hold a shingle, then the pairs
that are not in one component yet are all tried. A thousand near copies of one
text are settled by a few thousand pairs, not by half a million, and no pair that
could join two components is left out.

A shingle is a 64-bit hash of the hashes of its words; words are runs without
ASCII white space, in ASCII lower case.

Defined results: null and empty texts and texts of white space have no shingles,
size 0, and link with nothing; shorter texts than a shingle are one shingle;
rows with equal texts link, also if they share an id; a row without id takes
part, and the component id is the smallest id there is, null if there is none;
no row is lost or doubled; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from postlens.llm.common import Scratch, small_or_joined, stored
from postlens.llm.components import components

WORDS = 5
PERCENT = 80
FLUSH = 2_000_000  # shingles counted together; of these, those in OFTEN documents or more are kept
OFTEN = 4
FREQUENT = 1 << 20  # frequent shingles that have their own place in the order, at most (9 MB)
BROADCAST_IDS = 500_000  # row numbers that are broadcast (8 MB) to pick rows; more are joined
BITS = 2048
SHORT = 8  # numbers of 64 bits in a short sketch
MASKS = (0, 0x2A5_5A3C_96F1_B2D5, 0x153_A6C9_6B0E_4D2B, 0x3E8_C35A_F14D_9B76)  # one for each pivot; any numbers do
CACHED = 300_000
FEATURES = "n int, digest binary, prefix_digest binary, prefix array<long>, sketch binary, short_sketch array<long>"

MIX = np.uint64(0x9E3779B97F4A7C15)
MIX2 = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """Hashes of words, remembered; cleared when there are too many."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


_HASHES = WordHashes()


def shingles(text: str | None, words: int) -> np.ndarray:
    """The distinct shingles of a text, sorted."""
    found = text.encode("utf-8", "replace").lower().split() if text else []
    if not found:
        return np.zeros(0, "u8")
    hashes = np.fromiter(map(_HASHES.__getitem__, found), "u8", len(found))
    size = min(words, len(found))
    out = np.full(len(found) - size + 1, size, "u8")
    for j in range(size):
        out = (out ^ hashes[j : len(found) - size + 1 + j]) * MIX
        out ^= out >> np.uint64(29)
        out *= MIX2
        out ^= out >> np.uint64(32)
    return np.unique(out)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def sketch(found: np.ndarray) -> bytes:
    """Whether each class of shingles has an odd number of them."""
    return np.packbits(np.bincount((found >> np.uint64(20)) % np.uint64(BITS), minlength=BITS).astype("u1") & 1).tobytes()


def shortened(long: bytes) -> np.ndarray:
    """A sketch of fewer classes, each the union of some."""
    return np.bitwise_xor.reduce(np.frombuffer(long, "i8").reshape(-1, SHORT), axis=0)


def prefix_length(n: int, percent: int) -> int:
    """So many first shingles hold one of any similar set."""
    return n - -(-percent * n // 100) + 1


def index_length(n: int, percent: int) -> int:
    """So many do if the other set is as large or larger."""
    return n - -(-2 * percent * n // (100 + percent)) + 1


# --- the order ------------------------------------------------------------------


def frequent(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Frequent shingles, sorted, and the binary logarithm of their count.

    A lossy count over all texts: every ``FLUSH`` shingles a task passes on those
    it met ``OFTEN`` times. Any answer gives a right join; a good one keeps
    shingles that many documents share out of the prefixes.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0

        def flush():
            keys, counts = np.unique(np.concatenate(held), return_counts=True)
            often = counts >= OFTEN
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[often].view("i8")), pa.array(counts[often].astype("i8"))], names=["shingle", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                found = shingles(text.as_py(), words)
                held.append(found)
                n += len(found)
                if n >= FLUSH:
                    yield flush()
                    held, n = [], 0
        if n:
            yield flush()

    rows = (
        texts.mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "shingle").limit(FREQUENT).toPandas()
    )
    keys = rows["shingle"].to_numpy("i8").view("u8")
    order = np.argsort(keys)
    return keys[order], np.log2(np.maximum(1, rows["n"].to_numpy("f8")[order])).astype("u1") + 1


def prefix(found: np.ndarray, keys: np.ndarray, classes: np.ndarray, percent: int) -> np.ndarray:
    """The first shingles in the common order."""
    length = prefix_length(len(found), percent)
    if not len(keys):
        return found[:length]
    at = np.minimum(np.searchsorted(keys, found), len(keys) - 1)
    place = np.where(keys[at] == found, classes[at], 0)
    return found[np.argsort(place, kind="stable")[:length]]


# --- tables ----------------------------------------------------------------------


def described(docs: DataFrame, words: int, percent: int, text_col: str) -> DataFrame:
    """``row``, ``doc`` with all columns, and the ``FEATURES`` of every row, stored."""
    spark: SparkSession = docs.sparkSession
    order = spark.sparkContext.broadcast(frequent(docs.select(text_col), words))

    @pandas_udf(FEATURES)
    def features(texts):
        import pandas as pd

        keys, classes = order.value
        rows = []
        for text in texts:
            found = shingles(text, words)
            first = prefix(found, keys, classes, percent) if len(found) else found
            rows.append((
                len(found), xxhash.xxh3_128_digest(found.tobytes()), xxhash.xxh3_128_digest(first.tobytes()), first.view("i8"), (bits := sketch(found)), shortened(bits)
            ))
        return pd.DataFrame(rows, columns=["n", "digest", "prefix_digest", "prefix", "sketch", "short_sketch"])

    doc = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return stored(
        docs.select(F.monotonically_increasing_id().alias("row"), doc.alias("doc"), features(F.col(f"`{text_col}`")).alias("f"))
        .select("row", "doc", "f.*"),
        "described",
    )


def indexed(n: Column, at: Column, percent: int) -> Column:
    """Whether a place is one of the first that hold a shared shingle in the smaller set of a similar pair (``index_length``)."""
    return at < n - F.ceil(2 * percent * n / (100 + percent)) + 1


def index(groups: DataFrame, percent: int) -> DataFrame:
    """``(shingle, g, n, at)`` for the prefix shingles that may pair a group with another.

    Of a pair, the smaller set has the shingle at an ``indexed`` place, the larger one anywhere in its prefix. In the order
    of sizes, the nearest entry on either side tells whether there is one that fits. Each entry is shuffled once.
    """
    entries = groups.select(F.col("set").alias("g"), "n", F.posexplode("prefix").alias("at", "shingle"))
    n, first = F.col("n"), indexed(F.col("n"), F.col("at"), percent)
    by_size = Window.partitionBy("shingle").orderBy("n", ~first, "g")
    smaller = F.max(F.when(first, n)).over(by_size.rowsBetween(Window.unboundedPreceding, -1))
    beside = entries.withColumns({"_smaller": smaller, "_larger": F.lead("n").over(by_size)})
    fits = F.coalesce(100 * F.col("_smaller") >= percent * n, F.lit(False)) | (first & F.coalesce(100 * n >= percent * F.col("_larger"), F.lit(False)))
    return beside.where(fits).select("shingle", "g", "n", "at")


def close(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs(a, b)`` whose sketches allow them to be similar."""

    @pandas_udf("boolean")
    def may(n, m, left, right):
        import pandas as pd

        if not len(n):
            return pd.Series([], dtype="bool")
        x, y = (np.frombuffer(b"".join(s), "u8").reshape(len(n), -1) for s in (left, right))
        total = (n + m).to_numpy("i8")
        most = total - np.bitwise_count(x ^ y).sum(axis=1, dtype="i8")  # twice the shingles they can share
        return pd.Series(100 * most >= percent * (2 * total - most))

    a = sets.select(F.col("set").alias("a"), F.col("n").alias("_n"), F.col("sketch").alias("_x"))
    b = sets.select(F.col("set").alias("b"), F.col("n").alias("_m"), F.col("sketch").alias("_y"))
    return pairs.join(a, "a").join(b, "b").where(may("_n", "_m", "_x", "_y")).select("a", "b")


def verified(pairs: DataFrame, rows: DataFrame, words: int, percent: int, text_col: str) -> DataFrame:
    """Those of ``pairs(a, b)`` whose texts are similar, stored. Where many pairs share an end it should be ``b``."""

    @pandas_udf("boolean")
    def check(left, right):
        import pandas as pd

        last, found, out = None, None, []
        for a, b in zip(left, right):
            if b is not last:  # rows come sorted by b
                if b != last:
                    found = shingles(b, words)
                last = b
            out.append(similar(shingles(a, words), found, percent))
        return pd.Series(out, dtype="bool")

    scratch = Scratch()
    ends = scratch.stored(pairs.select(F.col("a").alias("set")).union(pairs.select("b")).distinct(), "ends")
    texts = rows.select(F.col("row").alias("set"), F.col(f"doc.`{text_col}`").alias("text"))
    texts = scratch.stored(texts.join(small_or_joined(ends, BROADCAST_IDS), "set"), "texts")
    a = texts.select(F.col("set").alias("a"), F.col("text").alias("left"))
    b = texts.select(F.col("set").alias("b"), F.col("text").alias("right"))
    links = stored(pairs.join(a, "a").join(b, "b").where(check("left", "right")).select("a", "b"), "links")
    scratch.drop()
    return links


def star_pairs(entries: DataFrame, members: DataFrame, percent: int) -> DataFrame:
    """Each group with the pivots of a shingle and a range of sizes, and each member with the first of its group."""
    band = F.floor(F.log("n") / F.log(F.lit(100 / percent)))
    banded = entries.select("shingle", "g", band.alias("band"))
    # The smallest group after flipping some bits: another one for each mask, as if drawn at random.
    flipped = [F.min(F.col("g").bitwiseXOR(F.lit(mask))).alias(f"p{k}") for k, mask in enumerate(MASKS)]
    pivots = banded.groupBy("shingle", "band").agg(F.count("*").alias("_groups"), *flipped).where("_groups > 1").select(
        "shingle", "band", F.array_distinct(F.array(*[F.col(f"p{k}").bitwiseXOR(F.lit(mask)) for k, mask in enumerate(MASKS)])).alias("pivots")
    )
    between = banded.join(pivots, ["shingle", "band"]).select(F.col("g").alias("a"), F.explode("pivots").alias("b")).where("a <> b")
    return between.distinct().union(members.where("set <> g").select(F.col("set").alias("a"), F.col("g").alias("b"))).distinct()


def open_pairs(
    entries: DataFrame, members: DataFrame, sets: DataFrame, labels: DataFrame, percent: int, scratch: Scratch
) -> DataFrame:
    """All member pairs of different components that pass the filters, ``a < b``."""
    short = [f"s{k}" for k in range(SHORT)]
    sketches = sets.select("set", "n", *[F.element_at("short_sketch", k + 1).alias(c) for k, c in enumerate(short)])
    member = scratch.stored(
        members.join(labels, members.set == labels.node, "left").select("g", "set", F.coalesce("component", "set").alias("c"))
        .join(sketches, "set"),
        "member",
    )
    # One component in a group, or several: a number of its own then, below all others.
    whole = member.groupBy("g").agg(F.min("c").alias("c"), F.max("c").alias("_max"))
    group = whole.select("g", F.when(F.col("c") == F.col("_max"), F.col("c")).otherwise(-1 - F.col("g")).alias("c"))
    # Members of a group share the first shingles only. Bits of their sketches count where all members have the same.
    alike = [F.expr(f"~(bit_or({c}) ^ bit_and({c}))").alias(f"same_{c}") for c in short]
    common = member.groupBy("g").agg(F.max("n").alias("n"), *[F.max(c).alias(c) for c in short], *alike)
    # The shingle before, if it is here too; where two groups of different components share it, it is.
    last = Window.partitionBy("g").orderBy("at")
    before = F.when(F.lag("at").over(last) == F.col("at") - 1, F.lag("shingle").over(last))
    marked = scratch.stored(entries.drop("n").join(group, "g").withColumn("before", before), "marked")
    mixed = marked.groupBy("shingle").agg(F.min("c").alias("_a"), F.max("c").alias("_b")).where("_a <> _b").select("shingle")
    left = scratch.stored(marked.join(mixed, "shingle").join(common, "g").sortWithinPartitions("g"), "open")
    x, y = left.alias("x"), left.alias("y")
    n, m, i, j = (F.col(c) for c in ("x.n", "y.n", "x.at", "y.at"))
    differ = lambda c: F.col(f"x.{c}").bitwiseXOR(F.col(f"y.{c}"))
    # Twice the shingles that two sets can share, by the short sketches.
    most = n + m - sum(F.bit_count(differ(c).bitwiseAND(F.col(f"x.same_{c}")).bitwiseAND(F.col(f"y.same_{c}"))) for c in short)
    need = F.ceil((n + m) * percent / (100 + percent))
    groups = (
        x.join(y, F.col("x.shingle") == F.col("y.shingle"))
        .where(
            ((n < m) | ((n == m) & (F.col("x.g") < F.col("y.g"))))
            & (F.col("x.c") != F.col("y.c"))
            & (100 * n >= percent * m)
            # Both share the shingle before, too: the pair came up there.
            & ~F.coalesce(F.col("x.before") == F.col("y.before"), F.lit(False))
            & indexed(n, i, percent)
            & (F.least(n - i, m - j) >= need)
            & (100 * most >= percent * (2 * (n + m) - most))
        )
        .select(F.col("x.g").alias("g"), F.col("y.g").alias("h"))
        .distinct()
    )
    inside = whole.where("c <> _max").select("g", F.col("g").alias("h"))
    first, second = member.alias("x"), member.withColumnRenamed("g", "h").alias("y")
    a, b = F.col("x.set"), F.col("y.set")
    most = n + m - sum(F.bit_count(differ(c)) for c in short)
    return (
        groups.union(inside).join(first, "g").join(second, "h")
        .where((F.col("x.c") != F.col("y.c")) & ((F.col("g") != F.col("h")) | (a < b)) & (100 * most >= percent * (2 * (n + m) - most)))
        .select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    )


def joined(docs: DataFrame, words: int, percent: int, id_col: str, text_col: str) -> tuple[DataFrame, DataFrame]:
    """The rows as ``described``, and ``(row, id, n, component_id, first)``."""
    rows = described(docs, words, percent, text_col)
    # Equal sets: the first row stands for all. The few rows that go are looked up, not the many that stay.
    scratch = Scratch()
    copies = scratch.stored(rows.where("n > 0").groupBy("digest").agg(F.min("row").alias("set"), F.count("*").alias("_rows")), "copies")
    later = rows.select("row", "digest").join(copies.where("_rows > 1"), "digest").where("row <> set").select("row")
    sets = rows.where("n > 0").drop("doc", "digest").join(small_or_joined(scratch.stored(later, "later"), BROADCAST_IDS), "row", "left_anti")
    sets = sets.withColumnRenamed("row", "set")
    heads = sets.groupBy("n", "prefix_digest").agg(F.min("set").alias("g"))
    members = scratch.stored(sets.select("set", "n", "prefix_digest").join(heads, ["n", "prefix_digest"]).select("set", "g"), "members")
    others = scratch.stored(members.where("set <> g").select("set"), "others")
    entries = scratch.stored(index(sets.join(small_or_joined(others, BROADCAST_IDS), "set", "left_anti"), percent), "index")

    star = scratch.stored(star_pairs(entries, members, percent), "star")
    near = scratch.stored(close(star, sets, percent), "close")
    links = verified(near, rows, words, percent, text_col)
    labels = components(links)
    tried = star.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    rest = scratch.stored(open_pairs(entries, members, sets, labels, percent, scratch).distinct().join(tried, ["a", "b"], "left_anti"), "pairs")
    more = verified(scratch.stored(close(rest, sets, percent), "close"), rows, words, percent, text_col)
    scratch.tables += [links, more, labels]
    if not more.isEmpty():
        labels = components(links.union(more))
        scratch.tables.append(labels)

    placed = stored(
        rows.select("row", F.col(f"doc.`{id_col}`").alias("id"), "n", "digest").join(copies.drop("_rows"), "digest", "left")
        .join(labels, F.col("set") == F.col("node"), "left")
        .select("row", "id", "n", F.coalesce("component", "set", -1 - F.col("row")).alias("_c")),
        "placed",
    )
    scratch.drop()
    best = placed.groupBy("_c").agg(F.min("id").alias("component_id"))
    found = placed.join(best, "_c")
    firsts = found.where("id <=> component_id").groupBy("_c").agg(F.min("row").alias("_first"))
    return rows, found.join(firsts, "_c").select("row", "id", "n", "component_id", (F.col("row") == F.col("_first")).alias("first"))


def similarity_components(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, n_shingles, component_id)`` for every row of ``docs``."""
    _, found = joined(docs.select(id_col, text_col), words, percent, id_col, text_col)
    return found.select(F.col("id").alias(id_col), F.col("n").cast("long").alias("n_shingles"), "component_id")


def keep_firsts(
    docs: DataFrame, words: int = WORDS, percent: int = PERCENT, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with one row of each component, one with the smallest id; all columns stay."""
    rows, found = joined(docs, words, percent, id_col, text_col)
    return rows.select("row", "doc").join(found.where("first").select("row"), "row").select("doc.*")
