"""Raw rows to post rows."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions.text import has_words, strip_ws

SOURCE = "kaggle_dataset"
COPIES_PER_TASK = 100_000


def has_text(text: Column) -> Column:
    """True unless the text is null or blank."""
    return text.isNotNull() & has_words(text)


def clean_rows(df: DataFrame, text: str = "text") -> DataFrame:
    """Drop rows whose text is null or blank."""
    return df.where(has_text(F.col(text).cast("string")))


def make_posts(
    df: DataFrame,
    run_ts: datetime | Column | None = None,
    source: str = SOURCE,
    null_label: str = "unknown",
    id_col: str | None = None,
) -> DataFrame:
    """Post rows from a table with text, label and type.

    ``id_col`` names the source's own key; without it rows get a stable id from
    their content (``content_ids``). ``run_ts`` is the time of the run, so that
    a re-run gives the same rows.
    """
    created = F.current_timestamp() if run_ts is None else run_ts if isinstance(run_ts, Column) else F.lit(run_ts)
    label = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(null_label))
    rows = clean_rows(df).withColumns({
        "text": strip_ws(F.col("text").cast("string")),
        "label": label("label"),
        "type": label("type"),
        "source": F.lit(source),
    })
    keyed = (
        rows.withColumn("id_post", F.col(id_col).cast("string"))
        if id_col
        else content_ids(rows.select("source", "text", "label", "type"))
    )
    return keyed.select(
        "id_post", "text", "label", "type", created.cast("timestamp").alias("created_at"),
        F.lit(False).alias("processed"), "source",
    )


def content_ids(df: DataFrame, out: str = "id_post", chunk: int = COPIES_PER_TASK) -> DataFrame:
    """Add a stable unique id: a hash of the whole row and of its number among its copies.

    Copies are alike, so it is enough to count them and to write them out
    again. The count is a partial aggregate, and more than ``chunk`` copies are
    written out by several tasks: one text may make up a third of all rows.
    """
    columns = df.columns
    grouped = df.groupBy(*columns).agg(F.count("*").alias("_n"))
    few = grouped.where(F.col("_n") <= chunk).withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), "_n")))
    many = (
        grouped.where(F.col("_n") > chunk)
        .withColumn("_chunk", F.explode(F.expr(f"sequence(0L, (_n - 1) div {chunk})")))
        .repartition(F.xxhash64(*columns), F.col("_chunk"))
        .withColumn("_copy", F.explode(F.expr(f"sequence(_chunk * {chunk} + 1, least((_chunk + 1) * {chunk}, _n))")))
        .drop("_chunk")
    )
    # Each part with its length, so that no two rows are written alike.
    parts = [F.col(c).cast("string") for c in [*columns, "_copy"]]
    content = F.sha2(F.concat(*[F.coalesce(F.concat(F.length(p), F.lit(":"), p), F.lit("-")) for p in parts]), 256)
    return few.unionByName(many).select(content.alias(out), *columns)


def duplicate_ids(df: DataFrame, key: str = "id_post") -> DataFrame:
    """Keys that occur more than once, with their number; empty if the key is unique."""
    return df.groupBy(key).agg(F.count("*").alias("n")).where("n > 1")


class DuplicateIds(ValueError):
    """Posts share an id."""


def require_unique(df: DataFrame, key: str = "id_post") -> DataFrame:
    """``df`` itself if no key occurs twice; only the key is read."""
    found = duplicate_ids(df.select(key), key).limit(5).collect()
    if found:
        raise DuplicateIds(", ".join(f"{r[key]} ({r['n']})" for r in found))
    return df


def loaded_counts(text: Column) -> list[Column]:
    """What an observer of the raw rows counts."""
    c = text.cast("string")
    return [
        F.count(F.lit(1)).alias("loaded"), F.count_if(c.isNotNull()).alias("with_text"), F.count_if(has_text(c)).alias("after_cleaning"),
    ]


def ingest_accounting(raw: DataFrame, posts: DataFrame, text: str = "text") -> DataFrame:
    """One row with the number of rows loaded, with a text, with a non-blank text, and of ``posts`` made of them."""
    return raw.agg(*loaded_counts(F.col(text))).join(posts.agg(F.count("*").alias("created")))
