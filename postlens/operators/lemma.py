"""Dictionary lemmatisation: a lemma table from the words in use and a noun table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import lookup

# Noun endings and what takes their place.
DETACHMENTS = [
    ("s", ""), ("ses", "s"), ("ves", "f"), ("xes", "x"), ("zes", "z"),
    ("ches", "ch"), ("shes", "sh"), ("men", "man"), ("ies", "y"),
]


def candidates(form: Column) -> Column:
    """The possible singulars of a form: itself and one per matching ending."""
    cut = lambda ending, end: F.when(
        form.endswith(ending), F.concat(F.substring(form, F.lit(1), F.length(form) - len(ending)), F.lit(end))
    )
    return F.array_compact(F.array(form, *[cut(ending, end) for ending, end in DETACHMENTS]))


def build_lemmas(forms: DataFrame, nouns: DataFrame, exceptions: DataFrame | None = None) -> DataFrame:
    """Table ``(form, lemma)`` of the forms whose lemma is another word.

    ``forms`` has a column ``form``, ``nouns`` a column ``noun``, ``exceptions``
    the columns ``form`` and ``lemma``. Only nouns count as candidates; the
    shortest wins, then the first in order. An exception takes precedence.
    """
    distinct = forms.select("form").where("form IS NOT NULL").distinct()
    best = (
        distinct.select("form", F.explode(candidates(F.col("form"))).alias("lemma"))
        .join(nouns.select(F.col("noun").alias("lemma")).distinct(), "lemma", "left_semi")
        .groupBy("form")
        .agg(F.min(F.struct(F.length("lemma").alias("n"), "lemma")).alias("best"))
        .select("form", F.col("best.lemma").alias("lemma"))
    )
    if exceptions is not None:
        irregular = distinct.join(exceptions.select("form", "lemma"), "form")
        best = irregular.unionByName(best.join(exceptions, "form", "left_anti"))
    return best.where("form <> lemma")


def lemmatize_dict(
    df: DataFrame,
    lemmas: DataFrame,
    tokens: str = "tokens",
    max_keys: int = lookup.MAX_KEYS,
) -> DataFrame:
    """Replace each token by its lemma; a token without one stays. ``lemmas`` has one row per form."""
    return (
        df.transform(lookup.entry_adder(lemmas, "form", max_keys), tokens, "_lemmas")
        .withColumn(tokens, F.zip_with(tokens, "_lemmas", lambda t, e: F.coalesce(e["lemma"], t)))
        .drop("_lemmas")
    )


def listed(unwanted: DataFrame) -> DataFrame:
    return unwanted.select("word", F.lit(True).alias("listed")).distinct()


def drop_listed(
    df: DataFrame,
    unwanted: DataFrame,
    tokens: str = "tokens",
    max_keys: int = lookup.MAX_KEYS,
) -> DataFrame:
    """Remove the tokens listed in ``unwanted(word)``, a stop list of any size."""
    return (
        df.transform(lookup.entry_adder(listed(unwanted), "word", max_keys), tokens, "_listed")
        # Read side by side: indexing into the entries would compute them once for each token.
        .withColumn(tokens, F.array_compact(F.zip_with(tokens, "_listed", lambda t, e: F.when(e.isNull(), t))))
        .drop("_listed")
    )


def drop_listed_and_lemmatize(
    df: DataFrame,
    unwanted: DataFrame,
    lemmas: DataFrame,
    tokens: str = "tokens",
    max_keys: int = lookup.MAX_KEYS,
) -> DataFrame:
    """:func:`drop_listed`, then :func:`lemmatize_dict`; if both tables have to be joined, they are joined as one."""
    if any(lookup.bounded_rows(t, [key], max_keys) is not None for t, key in ((listed(unwanted), "word"), (lemmas, "form"))):
        return df.transform(drop_listed, unwanted, tokens, max_keys).transform(lemmatize_dict, lemmas, tokens, max_keys)
    both = lemmas.where("form IS NOT NULL").join(listed(unwanted).withColumnRenamed("word", "form"), "form", "full")
    kept = lambda t, e: F.when(e["listed"].isNull(), F.coalesce(e["lemma"], t))
    return (
        df.transform(lookup.join_entries, tokens, "_entries", both, "form")
        .withColumn(tokens, F.array_compact(F.zip_with(tokens, "_entries", kept)))
        .drop("_entries")
    )
