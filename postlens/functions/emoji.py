"""Names in the place of emoji, so that scorers read them as words."""

from __future__ import annotations

import unicodedata

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import lookup

# Blocks of pictures; what is no symbol there is left out by its category.
BLOCKS = [(0x2190, 0x2C00), (0x3030, 0x3031), (0x303D, 0x303E), (0x3297, 0x329A), (0x1F000, 0x1FB00)]
PICTURE = r"[\x{2190}-\x{2bff}\x{3030}\x{303d}\x{3297}-\x{3299}\x{1f000}-\x{1faff}]"
# What goes with a picture: a variant, a skin tone, or another picture joined to it.
SEQUENCE = rf"{PICTURE}(?:\x{{fe0f}}|[\x{{1f3fb}}-\x{{1f3ff}}]|\x{{200d}}{PICTURE})*+"
OTHER = PICTURE.replace("[", "[^", 1)
DRESS = r"[\x{fe0f}\x{200d}]"


def emoji_names(spark: SparkSession) -> DataFrame:
    """``(emoji, name)`` of single pictures by their names in Unicode; a table with sequences may be added to it."""
    rows = []
    for first, end in BLOCKS:
        for c in map(chr, range(first, end)):
            if unicodedata.category(c) in ("So", "Sk"):
                rows.append((c, unicodedata.name(c).lower().replace("-", " ")))
    return spark.createDataFrame(rows, "emoji string, name string")


def spell_emoji(df: DataFrame, names: DataFrame, text: str = "text", out: str = "text", max_keys: int = lookup.MAX_KEYS) -> DataFrame:
    """``df`` with the names of emoji in the text, between blanks.

    The longest sequence that ``names`` has is taken; of one that it does not have, the pictures one by
    one. Pictures without a name stay. Only texts with pictures are taken apart.
    """
    pieces = F.regexp_extract_all("_given", F.lit(f"{SEQUENCE}|{OTHER}++"), F.lit(0))
    has = F.col("_given").rlike(PICTURE)
    single = f"regexp_extract_all(regexp_replace(x, {lookup.literal(DRESS)}, ''), '(?s).', 0)"
    # Of a piece: itself, and if it is a sequence, its pictures as pieces of their own.
    flat = f"transform(_pieces, x -> CASE WHEN x RLIKE {lookup.literal('^' + PICTURE)} THEN concat(array(x), {single}) ELSE array(x) END)"
    spelled = (
        "array_join(transform(_pieces, (x, i) -> CASE WHEN NOT exists(get(_names, i), n -> n IS NOT NULL) THEN x "
        "WHEN get(get(_names, i), 0) IS NOT NULL THEN concat(' ', get(get(_names, i), 0).name, ' ') "
        "ELSE concat(' ', array_join(transform(get(_flat, i), (y, j) -> CASE WHEN j > 0 THEN coalesce(get(get(_names, i), j).name, y) END), ' '), ' ') END), '')"
    )
    begun = "aggregate(_flat, named_struct('at', 1, 'to', array_repeat(0, 0)), (a, f) -> named_struct('at', a.at + size(f), 'to', array_append(a.to, a.at)), a -> a.to)"
    looked = (
        df.withColumn("_given", F.col(text))
        .withColumn("_pieces", F.when(has, pieces).otherwise(F.array().cast("array<string>")))
        .withColumn("_flat", F.expr(flat))
        .withColumn("_all", F.flatten("_flat"))
        .transform(lookup.entry_adder(names, "emoji", max_keys), "_all", "_found")
        .withColumn("_names", F.expr(f"transform({begun}, (at, i) -> slice(_found, at, size(get(_flat, i))))"))
    )
    return looked.withColumn(out, F.when(has, F.trim(F.expr(spelled))).otherwise(F.col("_given"))).drop(
        "_given", "_pieces", "_flat", "_all", "_found", "_names"
    )
