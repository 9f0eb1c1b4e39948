"""Dictionary lookup of array elements.

A dictionary of proven small size travels with the plan as a constant and is
read inside the row, so documents are never taken apart and never shuffled. A
dictionary beyond that size is joined: arrays are put together whole in buckets, the distinct words
of each bucket go to the dictionary from there, only those found come back, and the arrays of the bucket are read
against them inside the row. The join is salted, because one frequent word may be
in most buckets. Both ways give the same result for any rows: the bucket of an array
depends on what it holds, never on a key of the caller's.

A dictionary that holds a key twice is refused; a null key is no entry.
"""

from __future__ import annotations

import json
from collections import Counter
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_KEYS = 50_000
MAX_BYTES = 8 << 20
SET_TEST_KEYS = 5_000
PARTS = 256  # maps that the entries found for a bucket are dealt to
BREAK = "\x1f"  # stands between words that are shuffled as one text; words that hold it go as they are
BUCKET_BYTES = 1 << 20  # rows that share a bucket, as large as the planner takes them to be
BUCKETS = 16, 1024  # buckets for a task of a shuffle, at least and at most

Lookup = Callable[[str], str]
EntryAdder = Callable[[DataFrame, str, str], DataFrame]


class DoubledKey(ValueError):
    """A dictionary has more than one entry for a key."""


def bounded_rows(table: DataFrame, keys: Sequence[str], max_rows: int, max_bytes: int = MAX_BYTES) -> list[Row] | None:
    """The rows of ``table`` with the hash of the first of ``keys``, or None if they are too many or too large.

    Rows without that key are left out. ``keys`` together must be unique. At most ``max_rows + 1`` rows reach the driver.
    """
    rows = table.where(F.col(keys[0]).isNotNull())
    held = rows.withColumn("_hash", F.xxhash64(keys[0])).limit(max_rows + 1).collect()
    if len(held) > max_rows or sum(len(str(r)) for r in held) > max_bytes:
        doubled = rows.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1").first()
        if doubled is not None:
            raise DoubledKey(str([doubled[k] for k in keys]))
        return None
    counts = Counter(tuple(r[k] for k in keys) for r in held)
    if len(counts) < len(held):
        raise DoubledKey(str(counts.most_common(1)[0][0]))
    return held


def salts(spark: SparkSession) -> int:
    """Parts that a frequent key is dealt to: enough to keep a quarter of the tasks of a shuffle busy."""
    return max(2, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)


def digest(c: Column) -> Column:
    """What tells values apart, nulls and borders of elements included: 128 bits."""
    return F.unhex(F.substring(F.sha2(F.to_json(F.struct(c.alias("c"))), 256), 1, 32))


def literal(text: str) -> str:
    """``text`` as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def constant_lookup(
    entries: Sequence[tuple[str, int, object]], entry_type: str, mostly_misses: bool = True
) -> Lookup:
    """Lookup in a constant built from ``(key, xxhash64 of the key, entry)`` triples.

    The constant is an array of small maps, indexed by the hash of the key, so
    a lookup costs one hash and one short scan whatever the number of keys. The
    result is a function from the SQL text of a word to that of its entry.
    Where few words have an entry, a set test in front skips the others.
    """
    size = 1
    while size < len(entries):
        size *= 2
    buckets: list[dict] = [{} for _ in range(size)]
    for key, hashed, entry in entries:
        buckets[hashed % size][key] = entry
    constant = f"from_json({literal(json.dumps(buckets))}, {literal(f'array<map<string,{entry_type}>>')})"
    keys = ", ".join(literal(key) for key, _, _ in entries)
    set_test = mostly_misses and 0 < len(entries) <= SET_TEST_KEYS

    def find(word: str) -> str:
        entry = f"element_at(get({constant}, int(pmod(xxhash64({word}), {size}L))), {word})"
        return f"CASE WHEN {word} IN ({keys}) THEN {entry} END" if set_test else entry

    return find


def entry_adder(table: DataFrame, key: str, max_keys: int = MAX_KEYS) -> EntryAdder:
    """A function ``(df, elements, out)`` that looks array elements up in ``table``.

    It adds ``out``: for each element of the array ``elements`` the other
    columns of ``table`` as a struct, or null, in the order of the elements; null
    for a null array. ``table`` has one row per key.
    """
    rows = bounded_rows(table, [key], max_keys)
    if rows is None:
        return lambda df, elements, out: join_entries(df, elements, out, table, key)
    values = [f for f in table.schema.fields if f.name != key]
    entry_type = "struct<" + ",".join(f"`{f.name}`:{f.dataType.simpleString()}" for f in values) + ">"
    find = constant_lookup([(r[key], r["_hash"], {f.name: r[f.name] for f in values}) for r in rows], entry_type)
    return lambda df, elements, out: df.withColumn(out, F.expr(f"transform({elements}, w -> {find('w')})"))


def buckets(df: DataFrame) -> int:
    """How many buckets the arrays of ``df`` are dealt to; results are the same for any number."""
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    least, most = BUCKETS
    return tasks * min(most, max(least, size // (tasks * BUCKET_BYTES)))


def join_entries(df: DataFrame, elements: str, out: str, table: DataFrame, key: str) -> DataFrame:
    """:func:`entry_adder` for a dictionary of any size.

    What is grouped is the distinct words of one bucket that have an entry.
    """
    values = [c for c in table.columns if c != key]
    n = salts(df.sparkSession)
    keyed = df.withColumn("_bucket", F.pmod(F.hash(elements), F.lit(buckets(df))))
    holds = lambda w: F.contains(w, F.lit(BREAK))
    # The words leave their array only where those of a bucket lie together, so a shuffle carries them as one text, and equal ones once.
    unlike = F.array_distinct(elements)
    plain, odd = F.array_join(F.filter(unlike, lambda w: ~holds(w)), BREAK), F.filter(unlike, holds)
    texts = keyed.select("_bucket", plain.alias("_text"), F.when(F.size(odd) > 0, odd).alias("_odd"))
    arrays = texts.groupBy("_bucket").agg(F.collect_set("_text").alias("_texts"), F.collect_set("_odd").alias("_odd"))
    words = arrays.select(
        "_bucket",
        F.explode(F.array_distinct(F.concat(F.flatten(F.transform("_texts", lambda t: F.split(t, BREAK))), F.flatten("_odd")))).alias("_word"),
        F.pmod("_bucket", F.lit(n)).alias("_salt"),
    )
    salted = table.where(F.col(key).isNotNull()).select(
        F.col(key).alias("_word"), F.struct(*values).alias("_entry"), F.explode(F.sequence(F.lit(0), F.lit(n - 1))).alias("_salt")
    )
    # A map is searched from its start, so the entries are dealt to many short ones.
    part = lambda w: f"int(pmod(xxhash64({w}), {PARTS}))"
    found = words.join(salted, ["_word", "_salt"]).select("_bucket", F.expr(part("_word")).alias("_part"), F.struct("_word", "_entry").alias("_found"))
    short = found.repartition("_bucket").groupBy("_bucket", "_part").agg(F.map_from_entries(F.collect_list("_found")).alias("_map"))
    dealt = short.groupBy("_bucket").agg(F.map_from_entries(F.collect_list(F.struct("_part", "_map"))).alias("_dealt"))
    maps = dealt.select(F.col("_bucket").alias("_key"), F.expr(f"transform(sequence(0, {PARTS - 1}), i -> _dealt[i])").alias("_maps"))
    # The rows carry their array as one text, too, if it comes back as it was.
    packs = elements in [f.name for f in df.schema if f.dataType in (T.ArrayType(T.StringType()), T.ArrayType(T.StringType(), False))]
    array = F.col(elements)
    as_is = (F.size(array) == 0) | F.exists(array, lambda w: w.isNull() | holds(w))
    rows = keyed.withColumns({"_packed": F.when(~as_is, F.array_join(array, BREAK)), elements: F.when(as_is, array)}) if packs else keyed
    # Never broadcast: the planner can't tell how large they are.
    both = rows.join(maps.hint("merge"), F.col("_bucket") == F.col("_key"), "left")
    if packs:
        both = both.withColumn(elements, F.coalesce(elements, F.split("_packed", BREAK))).drop("_packed")
    return both.withColumn(out, F.expr(f"transform({elements}, w -> element_at(get(_maps, {part('w')}), w))")).drop("_bucket", "_key", "_maps")
