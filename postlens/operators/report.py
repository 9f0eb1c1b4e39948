"""Counts, statistics, previews and dashboard queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions.numbers import exact_round
from postlens.functions.text import shorten

SENTIMENTS = ["negative", "neutral", "positive"]


def total_docs(df: DataFrame) -> DataFrame:
    return df.agg(F.count("*").alias("total"))


def stage_counts(df: DataFrame) -> DataFrame:
    """Rows in all, cleaned, enriched and still to do, in one pass."""
    return df.agg(
        F.count("*").alias("total"),
        F.count_if("processed").alias("processed"),
        F.count_if("nlp_processed").alias("nlp_processed"),
    ).select(
        "*",
        (F.col("total") - F.col("processed")).alias("not_processed"),
        (F.col("processed") - F.col("nlp_processed")).alias("not_nlp_processed"),
    )


def counts(df: DataFrame, field: str | Column, name: str | None = None) -> DataFrame:
    """Rows per value of a field; a missing value is a group of its own."""
    column = F.col(field) if isinstance(field, str) else field
    return df.groupBy(column.alias(name or field)).agg(F.count("*").alias("count"))


def top_counts(df: DataFrame, field: str, n: int | None = None) -> DataFrame:
    """Counts in descending order, ties by value; the first ``n`` if given."""
    ordered = counts(df, field).orderBy(F.desc("count"), F.asc(field))
    return ordered.limit(n) if n else ordered


def terms(df: DataFrame, field: str, size: int = 10) -> DataFrame:
    """The most frequent values of a keyword field; missing values do not count."""
    return top_counts(df.where(F.col(field).isNotNull()), field, size)


def word_stats(df: DataFrame) -> DataFrame:
    """Mean, least and greatest word count of the cleaned rows; no row if there are none."""
    return (
        df.where("processed")
        .agg(
            F.avg("word_count").alias("avg_word_count"),
            F.min("word_count").alias("min_word_count"),
            F.max("word_count").alias("max_word_count"),
        )
        .where(F.col("avg_word_count").isNotNull())
        .withColumn("avg_display", F.format_string("%.2f", exact_round("avg_word_count", 2)))
    )


def preview(df: DataFrame, key: str, columns: dict[str, int | None], n: int) -> DataFrame:
    """The first ``n`` rows in key order; texts cut to the given length, missing values ``N/A``."""
    shown = lambda c, cut: shorten(F.col(c), cut) if cut else F.col(c).cast("string")
    first = df.select(key, *columns).orderBy(key).limit(n)
    return first.select(key, *[F.coalesce(shown(c, cut), F.lit("N/A")).alias(c) for c, cut in columns.items()])


def profile_fields(df: DataFrame) -> DataFrame:
    """Per column: type, values present, missing, and text lengths. One pass over the table.

    Lengths are those of the string form; nested columns have none.
    """

    def of(field: T.StructField) -> Column:
        c = F.col(f"`{field.name}`")
        nested = isinstance(field.dataType, (T.ArrayType, T.MapType, T.StructType))
        n = F.lit(None).cast("int") if nested else F.length(c.cast("string"))
        return F.struct(
            F.lit(field.name).alias("field"),
            F.lit(field.dataType.simpleString()).alias("type"),
            F.count(c).alias("present"),
            F.count_if(c.isNull()).alias("missing"),
            F.min(n).cast("bigint").alias("min_length"),
            F.max(n).cast("bigint").alias("max_length"),
            F.avg(n).alias("avg_length"),
        )

    return df.agg(F.array(*[of(f) for f in df.schema.fields]).alias("fields")).select(F.inline("fields"))


# --- dashboard --------------------------------------------------------------


def share_with_other(df: DataFrame, field: str, top: int, other: str = "other") -> DataFrame:
    """Counts and shares of the ``top`` most frequent values and of all others together."""
    grouped = counts(df, field)
    # The kept values are at most ``top`` rows, the table after relabelling one more.
    kept = F.broadcast(grouped.orderBy(F.desc("count"), F.asc(field)).limit(top).select(F.col(field).alias("_value"), F.lit(True).alias("_kept")))
    relabelled = (
        grouped.join(kept, F.col(field).eqNullSafe(F.col("_value")), "left")
        .withColumn(field, F.when(F.col("_kept"), F.col(field)).otherwise(other))
        .groupBy(field, "_kept")
        .agg(F.sum("count").alias("count"))
        .drop("_kept")
    )
    return with_share(relabelled)


def with_share(grouped: DataFrame) -> DataFrame:
    """Add each row's share of the total; for a grouped result of few rows."""
    return grouped.withColumn(
        "share", F.col("count").cast("double") / F.sum("count").over(Window.partitionBy()).cast("double")
    )


def sentiment_share(df: DataFrame, field: str = "sentiment") -> DataFrame:
    """Counts and shares of the sentiments."""
    return with_share(counts(df, field))


def negative_total(df: DataFrame, field: str = "sentiment") -> DataFrame:
    return df.agg(F.count_if(F.col(field) == "negative").alias("negative_posts"))


def language_by_sentiment(df: DataFrame) -> DataFrame:
    """One row per language with a count column for each sentiment."""
    return df.groupBy("langue").pivot("sentiment", SENTIMENTS).count().na.fill(0, SENTIMENTS)


def language_sentiment_counts(df: DataFrame) -> DataFrame:
    """The same as a long table."""
    return df.groupBy("langue", "sentiment").agg(F.count("*").alias("count"))


def dashboard(df: DataFrame) -> DataFrame:
    """All five dashboard panels from one scan: rows ``(langue, type_harcelement, sentiment, count)``.

    The panels are sums of this small cube; cache it to feed them all.
    """
    return df.groupBy("langue", "type_harcelement", "sentiment").agg(F.count("*").alias("count"))
