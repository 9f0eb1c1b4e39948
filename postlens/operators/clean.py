"""Text cleaning: raw text to cleaned text, tokens and processed text.

The whole stage is a chain of projections. It reads a row and writes a row, so
it runs inside the scan's tasks without any shuffle and also in a stream.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import lookup, text as X
from postlens.functions.wordlists import IRREGULAR_NOUNS, SINGULAR_S, STOP_WORDS
from postlens.operators import lemma

CLEAN_COLUMNS = ["original_text", "cleaned_text", "tokens", "processed_text", "word_count"]


def clean_text(df: DataFrame, text: str = "text") -> DataFrame:
    """Add ``original_text`` (the text in lower case) and ``cleaned_text``.

    Markup and entities are looked for only in texts that can hold them.
    Special characters, punctuation and digits go in one pass: together the
    three steps leave exactly the letters and the whitespace.
    """
    original, bare = F.col("original_text"), F.col("cleaned_text")
    without_markup = F.when(F.contains(original, F.lit("<")), X.strip_markup(original)).otherwise(original)
    decoded = X.decode_entities(bare)
    return (
        df.withColumn("original_text", F.lower(F.coalesce(F.col(text), F.lit(""))))
        .withColumn("cleaned_text", without_markup)
        .withColumn("cleaned_text", X.collapse_ws(X.letters_only(X.strip_urls(decoded))))
    )


def tokenize(c: Column) -> Column:
    """Words of a cleaned text; ``cannot`` and the like become two."""
    return F.filter(F.split(X.split_contractions(c), " "), lambda t: t != "")


def lemma_rules(token: Column) -> Column:
    """Singular of a noun by suffix rules.

    An approximation of a dictionary lemmatiser: only regular plurals and listed
    irregular ones are cut, and what may be no plural stays. ``preprocess``
    takes a table of lemmas instead (``lemma.build_lemmas``).
    """
    irregular = F.create_map(*[F.lit(w) for pair in IRREGULAR_NOUNS.items() for w in pair])
    n = F.length(token)
    rules = (
        F.when((n < 4) | token.isin(SINGULAR_S), token)
        .when(token.endswith("ss") | token.endswith("us") | token.endswith("is") | token.endswith("ics"), token)
        .when(token.endswith("ies") & (n > 4), F.concat(F.substring(token, F.lit(1), n - 3), F.lit("y")))
        .when(
            token.endswith("sses") | token.endswith("xes") | token.endswith("zes")
            | token.endswith("ches") | token.endswith("shes"),
            F.substring(token, F.lit(1), n - 2),
        )
        .otherwise(F.substring(token, F.lit(1), n - 1))
    )
    return F.when(token.isin(list(IRREGULAR_NOUNS)), F.element_at(irregular, token)).when(
        token.endswith("s"), rules
    ).otherwise(token)


def lemmatize(tokens: Column) -> Column:
    return F.transform(tokens, lambda t: lemma_rules(F.lower(t)))


def keep_long(tokens: Column) -> Column:
    """Drop blank and one-character tokens."""
    return F.filter(tokens, lambda t: (F.length(t) > 1) & (X.strip_ws(t) != ""))


def unlisted_tokens(cleaned: Column, stop_words: Iterable[str]) -> Column:
    """Words of a cleaned text that are no stop words."""
    unwanted = [*stop_words, ""]
    return F.filter(F.split(X.split_contractions(cleaned), " "), lambda t: ~t.isin(unwanted))


def final_tokens(cleaned: Column, stop_words: Iterable[str] = STOP_WORDS) -> Column:
    """Tokenise, drop stop words, lemmatise, drop one-character tokens.

    The cleaned text is lower case without other blanks than single spaces, so
    the three array operators need neither ``lower`` nor a blank test here.
    """
    return F.filter(F.transform(unlisted_tokens(cleaned, stop_words), lemma_rules), lambda t: F.length(t) > 1)


def preprocess(
    df: DataFrame,
    text: str = "text",
    stop_words: Iterable[str] | DataFrame = STOP_WORDS,
    lemmas: DataFrame | None = None,
    max_keys: int = lookup.MAX_KEYS,
) -> DataFrame:
    """Add the five cleaning columns; null and empty texts give empty results.

    ``stop_words`` is a list or a table ``(word)``, ``lemmas`` a table ``(form, lemma)``
    that takes the place of the suffix rules. Tables of up to ``max_keys`` rows
    leave the stage without a shuffle.
    """
    listed = isinstance(stop_words, DataFrame)
    cleaned = df.transform(clean_text, text)
    if not listed and lemmas is None:
        found = cleaned.withColumn("tokens", final_tokens(F.col("cleaned_text"), stop_words))
    else:
        found = cleaned.withColumn("tokens", unlisted_tokens(F.col("cleaned_text"), [] if listed else stop_words))
        if listed and lemmas is not None:
            found = found.transform(lemma.drop_listed_and_lemmatize, stop_words, lemmas, "tokens", max_keys)
        elif listed:
            found = found.transform(lemma.drop_listed, stop_words, "tokens", max_keys).withColumn("tokens", F.transform("tokens", lemma_rules))
        else:
            found = found.transform(lemma.lemmatize_dict, lemmas, "tokens", max_keys)
        found = found.withColumn("tokens", F.filter("tokens", lambda t: F.length(t) > 1))
    return found.withColumn("processed_text", F.array_join("tokens", " ")).withColumn("word_count", F.size("tokens"))
