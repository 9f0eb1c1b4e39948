"""Explicit schemas of the relations the job reads and writes."""

from __future__ import annotations

from pyspark.sql import types as T

POST_SCHEMA = T.StructType([
    T.StructField("id_post", T.StringType()),
    T.StructField("text", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("type", T.StringType()),
    T.StructField("created_at", T.TimestampType()),
    T.StructField("processed", T.BooleanType()),
    T.StructField("source", T.StringType()),
])

CLEAN_FIELDS = T.StructType([
    T.StructField("original_text", T.StringType()),
    T.StructField("cleaned_text", T.StringType()),
    T.StructField("tokens", T.ArrayType(T.StringType())),
    T.StructField("processed_text", T.StringType()),
    T.StructField("word_count", T.IntegerType()),
])

LANGUAGE = T.StructType([
    T.StructField("language", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
])

POLARITY = T.StructType([
    T.StructField("polarity", T.DoubleType()),
    T.StructField("subjectivity", T.DoubleType()),
    T.StructField("sentiment_label", T.StringType()),
])

VALENCE = T.StructType([
    T.StructField("compound", T.DoubleType()),
    T.StructField("positive", T.DoubleType()),
    T.StructField("neutral", T.DoubleType()),
    T.StructField("negative", T.DoubleType()),
    T.StructField("sentiment_label", T.StringType()),
])

CONSENSUS = T.StructType([
    T.StructField("final_sentiment", T.StringType()),
    T.StructField("confidence", T.DoubleType()),
    T.StructField("final_score", T.DoubleType()),
])

NLP_FIELDS = T.StructType([
    T.StructField("language_detection", LANGUAGE),
    T.StructField("textblob_sentiment", POLARITY),
    T.StructField("vader_sentiment", VALENCE),
    T.StructField("sentiment_consensus", CONSENSUS),
])

# The flat search document. Numbers are 32-bit floats and integers in the
# stored table only; the operators before the sink keep doubles.
INDEX_SCHEMA = T.StructType([
    T.StructField("id_post", T.StringType()),
    T.StructField("contenu_original", T.StringType()),
    T.StructField("contenu_traite", T.StringType()),
    T.StructField("contenu", T.StringType()),
    T.StructField("titre", T.StringType()),
    T.StructField("label", T.StringType()),
    T.StructField("type_harcelement", T.StringType()),
    T.StructField("auteur", T.StringType()),
    T.StructField("url", T.StringType()),
    T.StructField("langue", T.StringType()),
    T.StructField("langue_confiance", T.FloatType()),
    T.StructField("sentiment", T.StringType()),
    T.StructField("score", T.FloatType()),
    T.StructField("sentiment_confiance", T.FloatType()),
    T.StructField("textblob_polarite", T.FloatType()),
    T.StructField("textblob_subjectivite", T.FloatType()),
    T.StructField("textblob_sentiment", T.StringType()),
    T.StructField("vader_compound", T.FloatType()),
    T.StructField("vader_positif", T.FloatType()),
    T.StructField("vader_neutre", T.FloatType()),
    T.StructField("vader_negatif", T.FloatType()),
    T.StructField("vader_sentiment", T.StringType()),
    T.StructField("longueur_texte", T.IntegerType()),
    T.StructField("nb_mots", T.IntegerType()),
])


def schema_differences(actual: T.StructType, expected: T.StructType) -> dict[str, list[str]]:
    """Fields added to, missing from and of another type than ``expected``."""
    have = {f.name: f.dataType for f in actual.fields}
    want = {f.name: f.dataType for f in expected.fields}
    return {
        "added": sorted(have.keys() - want.keys()),
        "missing": sorted(want.keys() - have.keys()),
        "changed": sorted(n for n in have.keys() & want.keys() if have[n] != want[n]),
    }
