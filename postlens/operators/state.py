"""Processing state: flags, pending rows, keyed updates, resets, last write wins."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.operators.clean import CLEAN_COLUMNS
from postlens.operators.enrich import NLP_COLUMNS

CLEAN_STATE = [*CLEAN_COLUMNS, "preprocessing_date"]
NLP_STATE = [*NLP_COLUMNS, "nlp_processing_date"]


def pending_clean(df: DataFrame) -> DataFrame:
    """Rows whose ``processed`` flag is false; a missing flag does not count."""
    return df.where(~F.col("processed"))


def pending_nlp(df: DataFrame) -> DataFrame:
    """Cleaned rows whose ``nlp_processed`` flag is not true; a missing flag counts."""
    return df.where(F.col("processed") & ~F.col("nlp_processed").eqNullSafe(True))


def ready_docs(df: DataFrame) -> DataFrame:
    """Rows that went through both stages."""
    return df.where(F.col("processed") & F.col("nlp_processed"))


def not_done(source: DataFrame, done: DataFrame, key: str = "id_post") -> DataFrame:
    """Rows of ``source`` whose key is not in ``done``; only the key of ``done`` is read."""
    return source.join(done.select(key), key, "left_anti")


def content_digest(text: Column) -> Column:
    """What tells whether a text changed; a null has one, too."""
    return F.sha2(F.coalesce(F.concat(F.lit("t"), text), F.lit("")), 256)


def changed(source: DataFrame, done: DataFrame, key: str = "id_post", digest: str = "content_digest") -> DataFrame:
    """Rows of ``source`` whose key is not in ``done``, or is there with another digest; rows without a key too.

    ``done`` holds each key once, as ``latest_rows`` gives it; only the two columns are read.
    """
    return matched(source, done.select(key, digest), "left_anti", key, digest)


def matched(rows: DataFrame, known: DataFrame, how: str, key: str = "id_post", digest: str = "content_digest") -> DataFrame:
    """The ``left_semi`` or ``left_anti`` join of ``rows`` with the key and digest of ``known``, its two columns."""
    known = known.toDF("_key", "_digest")
    return rows.join(known, (F.col(key) == F.col("_key")) & (F.col(digest) == F.col("_digest")), how)


def _stamp(run_ts: datetime | Column | None) -> Column:
    return (F.current_timestamp() if run_ts is None else run_ts if isinstance(run_ts, Column) else F.lit(run_ts)).cast(
        "timestamp"
    )


def mark_clean(df: DataFrame, run_ts: datetime | Column | None = None) -> DataFrame:
    return df.withColumns({"processed": F.lit(True), "preprocessing_date": _stamp(run_ts)})


def mark_nlp(df: DataFrame, run_ts: datetime | Column | None = None) -> DataFrame:
    return df.withColumns({"nlp_processed": F.lit(True), "nlp_processing_date": _stamp(run_ts)})


def upsert(base: DataFrame, updates: DataFrame, key: str = "id_post") -> DataFrame:
    """Set the columns of ``updates`` in the rows of ``base`` with the same key.

    An update overwrites, also with null. Keys unknown to ``base`` are ignored.
    ``updates`` has one row per key (see ``last_write_wins``). Spark chooses the
    join; bucket both tables by the key to keep it free of a shuffle.
    """
    changed = [c for c in updates.columns if c != key]
    new = updates.select(F.col(key).alias("_key"), F.lit(True).alias("_hit"), F.struct(*changed).alias("_new"))
    joined = base.join(new, F.col(key) == F.col("_key"), "left")
    kept = [c for c in base.columns if c not in changed]
    value = lambda c: (
        F.when(F.col("_hit"), F.col(f"_new.{c}")).otherwise(F.col(c)) if c in base.columns else F.col(f"_new.{c}")
    )
    return joined.select(*kept, *[value(c).alias(c) for c in changed])


def reset_clean(df: DataFrame) -> DataFrame:
    """Undo cleaning, and with it the enrichment that was built on it."""
    return reset_nlp(df.drop(*CLEAN_STATE).withColumn("processed", F.lit(False)))


def reset_nlp(df: DataFrame) -> DataFrame:
    """Undo enrichment."""
    return df.drop(*NLP_STATE).withColumn("nlp_processed", F.lit(False))


def last_write_wins(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """One row per key, the one that is greatest in ``order``.

    A maximum is found per task before the shuffle, so a key that holds a large
    part of the rows sends one row per task. Rows equal in ``order`` are told
    apart by their values, which keeps the result the same in every run.
    """
    values = [c for c in df.columns if c != key]
    rank = F.struct(*order, *[c for c in values if c not in order])
    return df.groupBy(key).agg(F.max(rank).alias("_row")).select(key, *[F.col(f"_row.{c}").alias(c) for c in values])


PLACE = ["_file", "_row"]
BITMAPS = 16_384  # bitmaps that are broadcast (64 MB, bits of half a billion rows); more places are joined


def placed(df: DataFrame) -> DataFrame:
    """``df``, which reads Parquet files, with the ``PLACE`` of each row."""
    return df.withColumns({"_file": F.col("_metadata.file_path"), "_row": F.col("_metadata.row_index")})


def without(rows: DataFrame, places: DataFrame, bitmaps: int = BITMAPS) -> DataFrame:
    """The rows of ``placed`` files that are at none of ``places``, which has the columns ``PLACE``.

    Places become a bit for each row of a file, so rows meet a small table and are not shuffled. Files with more rows
    than ``bitmaps`` have bits for are joined.
    """
    number = F.col("_row") + 1  # Spark counts bits from 1
    block, bit = F.bitmap_bucket_number(number), F.bitmap_bit_position(number)
    if rows.select("_file", block).distinct().count() > bitmaps:
        return rows.join(places, PLACE, "left_anti").select(rows.columns)
    maps = places.groupBy(F.col("_file").alias("_of"), block.alias("_block")).agg(F.bitmap_construct_agg(bit).alias("_bits"))
    byte = F.conv(F.hex(F.substring("_bits", (bit / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    gone = F.coalesce(F.getbit(byte, (bit % 8).cast("int")) == 1, F.lit(False))
    found = rows.join(F.broadcast(maps), (F.col("_file") == F.col("_of")) & (block == F.col("_block")), "left")
    return found.where(~gone).drop("_of", "_block", "_bits")


def replaced(rows: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The places of those ``placed`` rows that a row with the same key comes after."""
    keys = rows.where(F.col(key).isNotNull()).select(key, F.struct(*order, *PLACE).alias("_at"))
    several = keys.groupBy(key).agg(F.max("_at").alias("_last"), F.count("*").alias("_n")).where("_n > 1")
    return keys.join(several, key).where("_at <> _last").select("_at._file", "_at._row")


def latest_rows(df: DataFrame, key: str, order: Sequence[str]) -> DataFrame:
    """The rows of stored files that no row with the same key comes after.

    ``df`` reads Parquet files, unchanged. Of equal rows in ``order`` the one in the later
    file, then further down in it, counts. The winner is found from the key, ``order`` and the place of a row, so texts are
    neither sorted nor shuffled. Rows without a key are all kept.
    """
    rows = placed(df)
    return without(rows, replaced(rows, key, order)).drop(*PLACE)
