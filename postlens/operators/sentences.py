"""Sentences of texts, with abbreviations learnt from the corpus.

A period ends a sentence unless its word is an abbreviation. Whether one is shows in
the corpus: an abbreviation stands with its period nearly always, another word as often as
any word does. The log-likelihood ratio of the two, weighed by how short the
word is, how many periods it holds and how often it stands without the last one, is
its score (the public method of Kiss and Strunk).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.functions import lookup, text as X
from postlens.functions.binding import let, let_sql

# Fixed values of the method.
ALWAYS = 0.99
EDGE = 0.3

OPENING = "(\\[{\"'«“‘¿¡"
CLOSING = ")\\]}\"'»”’"
ENDS = rf"[.!?…]+[{CLOSING}]*$"


def bare(word: Column) -> Column:
    """A word in lower case without quotes, brackets and the marks at its end."""
    return F.lower(F.regexp_replace(word, rf"^[{OPENING}]+|[.!?…,;:{CLOSING}]+$", ""))


def learn_abbreviations(df: DataFrame, text: str = "text", edge: float = EDGE) -> DataFrame:
    """``(word, score)`` of the abbreviations of a corpus. Counting is a partial aggregate over words."""
    # Words are counted as they are written before they are looked at: the patterns run once for each way to write one.
    written = df.select(F.explode(X.words(F.coalesce(F.col(text), F.lit("")))).alias("w")).groupBy("w").agg(F.count("*").alias("n"))
    dotted = F.col("w").rlike(rf"\.[{CLOSING}]*[,;:]?[{CLOSING}]*$")
    words = written.select(bare(F.col("w")).alias("word"), "n", F.when(dotted, F.col("n")).otherwise(0).alias("k"))
    counts = words.groupBy("word").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    totals = counts.agg(F.sum("n").alias("all_n"), F.sum("k").alias("all_k"))  # one row
    n, k = F.col("n").cast("double"), F.col("k").cast("double")
    p = F.col("all_k") / F.col("all_n")
    likelihood = lambda q: k * F.ln(q) + (n - k) * F.ln(1 - q)
    ratio = -2 * (likelihood(F.least(F.greatest(p, F.lit(1e-9)), F.lit(ALWAYS))) - likelihood(F.lit(ALWAYS)))
    letters = F.length(F.replace("word", F.lit("."), F.lit(""))).cast("double")
    dots = F.length("word") - letters + 1
    score = ratio * F.exp(-letters) * dots * F.pow(letters, k - n)
    return (
        counts.where("k > 0").where(F.col("word").rlike(r"^\p{L}[\p{L}.]*$")).join(F.broadcast(totals))
        .select("word", score.alias("score")).where(F.col("score") >= edge)
    )


def sentence_count(
    df: DataFrame, abbreviations: DataFrame, text: str = "text", out: str = "sentences", max_keys: int = lookup.MAX_KEYS
) -> DataFrame:
    """Add the number of sentences of a text without markup.

    A sentence ends at a word that ends in ``!``, ``?`` or dots, or in a period if it is
    neither an abbreviation nor a single letter; not if the next word starts with a small letter.
    """
    ends = "get(given.ends, i)"
    loud = f"(get(given.w, i) RLIKE {lookup.literal(rf'(?:[!?…]|\.\.)[.!?…]*[{CLOSING}]*$')})"
    short = "(get(listed, i) IS NOT NULL OR length(get(given.bare, i)) = 1 AND get(given.bare, i) RLIKE '^[a-zà-ÿ]$')"
    goes_on = f"(get(given.w, i + 1) RLIKE {lookup.literal(rf'^[{OPENING}]*\p{{Ll}}')})"
    counted = f"size(filter(sequence(0, size(given.w) - 2), i -> {ends} AND ({loud} OR NOT {short}) AND NOT {goes_on})) + 1"
    listed = abbreviations.select("word", F.lit(True).alias("listed"))
    # Bound, not named: a column that is read inside the filter would be computed once for each word.
    result = let_sql("given", "_given", let_sql("listed", "_listed", f"CASE size(given.w) WHEN 0 THEN 0 WHEN 1 THEN 1 ELSE {counted} END"))
    # Only words that may end a sentence are looked up.
    given = let(X.words(F.coalesce(F.col(text), F.lit(""))), lambda w: let(F.transform(w, lambda x: x.rlike(ENDS)), lambda e: F.struct(
        w.alias("w"), e.alias("ends"), F.zip_with(w, e, lambda x, end: F.when(end, bare(x))).alias("bare")
    )))
    return (
        df.withColumn("_given", given)
        .transform(lookup.entry_adder(listed, "word", max_keys), "_given.bare", "_listed")
        .withColumn(out, F.expr(result))
        .drop("_given", "_listed")
    )
