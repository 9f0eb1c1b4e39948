"""The relations of the job, bound to the test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.operators.sentiment import TERM_SCHEMA

SPLIT_BYTES = 128 * 1024 * 1024

# A lexicon of words that are frequent in the test tables, so that every rule
# fires. Columns as in TERM_SCHEMA: term, valence, boost, negation, role,
# polarity, subjectivity, intensity, modifier, negator.
LEXICON = [
    ("de", 1.9, None, False, None, 0.5, 0.4, 1.0, False, False),
    ("la", -2.1, None, False, None, -0.6, 0.7, 1.0, False, False),
    ("que", 3.2, None, False, None, 0.8, 0.9, 1.0, False, False),
    ("le", -1.5, None, False, None, -0.4, 0.5, 1.0, False, False),
    ("des", 0.8, None, False, None, 0.25, 0.3, 1.0, False, False),
    ("les", -2.7, None, False, None, -1.0, 1.0, 1.0, False, False),
    ("tion", 2.4, None, False, None, 0.3, 0.2, 1.0, False, False),
    ("nd", -0.9, None, False, "kind", -0.15, 0.1, 1.0, False, False),
    ("ing", -1.2, None, False, "no", None, None, None, False, True),
    ("et", 1.1, None, False, None, 0.35, 0.65, 1.0, False, False),
    ("mit", -3.1, None, False, None, -0.9, 0.8, 1.0, False, False),
    ("der", None, 0.293, False, None, 0.2, 0.3, 1.3, True, False),
    ("die", None, -0.293, False, None, 0.1, 0.2, 0.5, True, False),
    ("st", None, 0.293, False, "at", -0.125, 1.0, 1.3, True, False),
    ("ha", None, 0.293, False, "so", None, None, None, False, False),
    ("en", None, None, True, None, None, None, None, False, True),
    ("el", None, None, True, "without", None, None, None, False, True),
    ("th", None, None, True, "never", None, None, None, False, True),
    ("und", None, None, False, "but", None, None, None, False, False),
    ("qui", None, None, False, "but", None, None, None, False, False),
    ("ch", None, None, False, "least", None, None, None, False, False),
    ("ed", None, None, False, "doubt", None, None, None, False, False),
    ("du", None, None, False, "or", None, None, None, False, False),
    ("re", None, None, False, "of", None, None, None, False, False),
]


def lexicon(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(LEXICON, TERM_SCHEMA)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Give every core a share of a table too small to have a split per core.

    The test tables are single files of one row group. A table of one split per
    core or more is returned as it is.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return df.repartition(cores) if size < cores * SPLIT_BYTES else df


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """The documents with a string key; only the named further columns are read."""
    return spread(
        table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string").alias("id_post"), *columns)
    )


def posts(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    """Labelled posts with their processing flags.

    The flags come from data that covers some rows only, so all three states
    occur: ``processed`` from the quality label, ``nlp_processed`` from the
    language.
    """
    docs = spread(table(spark, sf_dir, "documents").select("doc_id", "lang", "source", *({"text"} & {*(columns or ["text"])})))
    labels = table(spark, sf_dir, "labels")
    rows = docs.join(labels, "doc_id", "left").select(
        F.col("doc_id").cast("string").alias("id_post"),
        *[c for c in docs.columns if c == "text"],
        F.when(F.col("toxic") == 1, "harassment").when(F.col("toxic") == 0, "not_harassment").otherwise("unknown").alias("label"),
        F.col("source").alias("type"),
        "lang",
        (F.col("quality") == 1).alias("processed"),
        F.when(F.col("lang") == "en", True).when(F.col("lang").isin("fr", "de"), False).alias("nlp_processed"),
    )
    return rows.select("id_post", *columns) if columns else rows


def turns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Short posts: every turn with its whole text; and each row of ``labels`` as a post without one, blank or null."""
    said = table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("id_post"), "text")
    marks = table(spark, sf_dir, "labels").select(
        F.concat(F.lit("label-"), F.col("doc_id")).alias("id_post"),
        F.when(F.col("toxic") == 1, " \t ").when(F.col("quality") == 1, "").alias("text"),
    )
    return spread(said.union(marks))


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages with the last part of the link as a score that is not always a number."""
    return spread(
        table(spark, sf_dir, "pages").select(
            F.when(F.col("url").startswith("https"), F.col("page_id")).alias("page_id"),
            "url",
            F.substring_index("url", "/", -1).alias("score"),
        )
    )


def fragments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages followed by their link, as text with markup and links."""
    return spread(
        table(spark, sf_dir, "pages").select("page_id", F.concat_ws(" ", "html", "url").alias("text"))
    )


def event_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times as texts of several forms, one of them no time at all."""
    at = lambda pattern: F.date_format("ts", pattern)
    kind = F.col("event_type")
    return table(spark, sf_dir, "events").select(
        "event_id",
        F.when(kind == "click", F.concat(at("yyyy-MM-dd'T'HH:mm:ss"), F.lit("Z")))
        .when(kind == "purchase", F.concat(at("yyyy-MM-dd'T'HH:mm:ss"), F.lit("+02:00")))
        .when(kind == "view", at("yyyy-MM-dd HH:mm:ss"))
        .when(kind == "signup", at("yyyy-MM-dd"))
        .otherwise(F.col("props"))
        .alias("date"),
    )
