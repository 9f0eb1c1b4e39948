"""Enrichment of cleaned posts: language, two sentiment scores, consensus."""

from __future__ import annotations

from pyspark.sql import DataFrame

from postlens.functions import lookup
from postlens.operators import language, sentiment

NLP_COLUMNS = ["language_detection", "textblob_sentiment", "vader_sentiment", "sentiment_consensus"]


def enrich(
    df: DataFrame,
    terms: DataFrame,
    profiles: DataFrame | None = None,
    max_keys: int = lookup.MAX_KEYS,
) -> DataFrame:
    """Add the four result structs to posts that went through ``preprocess``.

    Language is read from the original text, sentiment from the processed one.
    Without ``profiles`` the language comes from function words. With
    dictionaries of up to ``max_keys`` rows the stage has no shuffle.
    """
    if profiles is None:
        found = language.detect_language_words(df)
    else:
        found = language.detect_language(df, profiles, max_keys=max_keys)
    return found.transform(sentiment.score_sentiment, terms, max_keys)
