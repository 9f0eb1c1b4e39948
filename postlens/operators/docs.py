"""Enriched posts to flat search documents, with a quarantine for bad rows."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import text as X
from postlens.functions.wordlists import SEARCH_STOP_WORDS

TITLE_LENGTH = 100
KEYWORD_LENGTH = 256
PREVIEW_LENGTH = 200
FAILURES_SHOWN = 5

# Flat field, its source and the default for a missing value.
FLAT_FIELDS = [
    ("label", "label", "unknown"),
    ("type_harcelement", "type", "unknown"),
    ("auteur", "author", "anonymous"),
    ("url", "url", ""),
    ("langue", "language_detection.language", "unknown"),
    ("langue_confiance", "language_detection.confidence", 0.0),
    ("sentiment", "sentiment_consensus.final_sentiment", "neutral"),
    ("score", "sentiment_consensus.final_score", 0.0),
    ("sentiment_confiance", "sentiment_consensus.confidence", 0.0),
    ("textblob_polarite", "textblob_sentiment.polarity", 0.0),
    ("textblob_subjectivite", "textblob_sentiment.subjectivity", 0.0),
    ("textblob_sentiment", "textblob_sentiment.sentiment_label", "neutral"),
    ("vader_compound", "vader_sentiment.compound", 0.0),
    ("vader_positif", "vader_sentiment.positive", 0.0),
    ("vader_neutre", "vader_sentiment.neutral", 1.0),
    ("vader_negatif", "vader_sentiment.negative", 0.0),
    ("vader_sentiment", "vader_sentiment.sentiment_label", "neutral"),
]


def doc_content(processed: Column, original: Column) -> Column:
    """The processed text, or the original one if cleaning left nothing."""
    return X.first_text(processed, original)


def doc_title(text: Column) -> Column:
    return X.shorten(text, TITLE_LENGTH)


def title_keyword(title: Column) -> Column:
    """The title as an exact keyword; longer ones are not indexed."""
    return F.when(F.length(title) <= KEYWORD_LENGTH, title)


def _has_field(df: DataFrame, path: str) -> bool:
    fields = df.schema
    for part in path.split("."):
        if part not in fields.fieldNames():
            return False
        fields = fields[part].dataType
    return True


def flatten_docs(df: DataFrame, id_col: str = "id_post") -> DataFrame:
    """The 24 flat fields of a search document; a missing or null value takes its default."""

    def value(path: str, default: str | float) -> Column:
        kind = "string" if isinstance(default, str) else "double"
        if not _has_field(df, path):
            return F.lit(default)
        return F.coalesce(F.col(path).cast(kind), F.lit(default))

    texts = (
        df.withColumn("_original", value("original_text", ""))
        .withColumn("_processed", value("processed_text", ""))
        .withColumn("_content", doc_content(F.col("_processed"), F.col("_original")))
    )
    return texts.select(
        F.col(id_col).cast("string").alias("id_post"),
        F.col("_original").alias("contenu_original"),
        F.col("_processed").alias("contenu_traite"),
        F.col("_content").alias("contenu"),
        doc_title(X.first_text(F.col("_original"), F.col("_content"))).alias("titre"),
        *[value(path, default).alias(name) for name, path, default in FLAT_FIELDS],
        F.length("_content").alias("longueur_texte"),
        X.word_count(F.col("_content")).alias("nb_mots"),
    )


def doc_lengths(df: DataFrame, text: str, id_col: str) -> DataFrame:
    """Characters and whitespace-separated words of a text."""
    c = F.coalesce(F.col(text), F.lit(""))
    return df.select(id_col, F.length(c).alias("longueur_texte"), X.word_count(c).alias("nb_mots"))


def check_docs(df: DataFrame, id_col: str, numbers: Mapping[str, str]) -> DataFrame:
    """Cast the string columns ``numbers`` to the given types and add ``reason``.

    ``reason`` is null for a valid row, else the first check that failed: a
    missing id, or a value that is not a number of its type.
    """
    checks = [F.when(F.col(id_col).isNull(), F.lit("missing_id"))]
    casts = {}
    for column, kind in numbers.items():
        casts[column] = F.col(column).try_cast(kind)
        checks.append(F.when(F.col(column).isNotNull() & casts[column].isNull(), F.lit(f"bad_number:{column}")))
    whole = F.to_json(F.struct(*[F.col(c) for c in df.columns]))
    return (
        df.withColumn("reason", F.coalesce(*checks))
        .withColumn("preview", F.when(F.col("reason").isNotNull(), F.substring(whole, 1, PREVIEW_LENGTH)))
        .withColumns(casts)
    )


def valid_docs(checked: DataFrame) -> DataFrame:
    return checked.where("reason IS NULL").drop("reason", "preview")


def quarantine(checked: DataFrame, id_col: str) -> DataFrame:
    """The rejected rows: id, reason, and the start of the row as JSON."""
    return checked.where("reason IS NOT NULL").select(F.col(id_col).alias("id"), "reason", "preview")


def index_accounting(checked: DataFrame) -> DataFrame:
    """One row with the numbers of indexed and failed documents."""
    return checked.agg(
        F.count_if(F.col("reason").isNull()).alias("indexed"),
        F.count_if(F.col("reason").isNotNull()).alias("failed"),
    )


def failure_counts(rejected: DataFrame) -> DataFrame:
    return rejected.groupBy("reason").agg(F.count("*").alias("n"))


def first_failures(rejected: DataFrame, n: int = FAILURES_SHOWN) -> DataFrame:
    """The first rejected documents in id order, those without an id before all others, with reason and kind of error."""
    return rejected.orderBy(F.asc_nulls_first("id"), "reason", "preview").limit(n).select(
        "id", "reason", F.substring_index("reason", ":", 1).alias("error_type"), "preview"
    )


def docs_to_json(df: DataFrame, id_col: str = "id_post") -> DataFrame:
    """Each row as one JSON text."""
    return df.select(F.col(id_col), F.to_json(F.struct(*df.columns)).alias("json"))


def analyze_terms(c: Column) -> Column:
    """The search terms of a text, in order."""
    return X.terms(F.coalesce(c, F.lit("")), SEARCH_STOP_WORDS)


def match_terms(df: DataFrame, field: str, wanted: list[str], how: str = "any") -> DataFrame:
    """Documents whose ``field`` holds any or all of the wanted terms."""
    found = analyze_terms(F.col(field))
    lowered = F.array(*[F.lit(w.lower()) for w in wanted])
    if how == "all":
        return df.where(F.size(F.array_except(lowered, found)) == 0)
    return df.where(F.arrays_overlap(found, lowered))
