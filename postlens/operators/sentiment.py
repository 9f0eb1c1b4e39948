"""Two lexicon scorers, their labels and the consensus between them.

A document is scored inside its row: each word is replaced by its dictionary
entry, and the rules look at the entries before and after it in the array.
Scores are summed as whole millionths.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.functions import lookup, text as X
from postlens.functions import wordlists as L
from postlens.functions.binding import let, let_sql
from postlens.functions.emoji import spell_emoji
from postlens.functions.numbers import MICRO, clamp_sql, exact_round_sql, micro_sql

# Fixed values of the valence rules.
NEGATED = -0.74
NEVER_SO = 1.25
DECAY = {1: 1.0, 2: 0.95, 3: 0.9}
CAPITALS = 0.733
BEFORE_BUT, AFTER_BUT = 0.5, 1.5
EXCLAMATION, MAX_EXCLAMATIONS = 292_000, 4
QUESTION, MAX_QUESTION = 180_000, 960_000
NORMALISER = 15.0

# Fixed values of the labels.
POLARITY_EDGE, VALENCE_EDGE = 0.1, 0.05

TERM_SCHEMA = (
    "term string, valence double, boost double, negation boolean, role string, "
    "polarity double, subjectivity double, intensity double, modifier boolean, negator boolean"
)
PUNCTUATION = r"!-/:-@\[-`{-~"


def seed_terms(spark: SparkSession) -> DataFrame:
    """The seed lexicons as one term table with the columns of ``TERM_SCHEMA``."""
    boosts = {w: L.BOOST for w in L.BOOSTERS["+"]} | {w: -L.BOOST for w in L.BOOSTERS["-"]}
    known = {*L.VALENCE, *boosts, *L.NEGATIONS, *L.VALENCE_ROLES, *L.POLARITY, *L.POLARITY_NEGATIONS}
    rows = []
    for word in sorted(known):
        polarity, subjectivity, intensity = L.POLARITY.get(word, (None, None, None))
        rows.append((
            word, L.VALENCE.get(word), boosts.get(word), word in L.NEGATIONS, L.VALENCE_ROLES.get(word),
            polarity, subjectivity, intensity, word in L.POLARITY_MODIFIERS, word in L.POLARITY_NEGATIONS,
        ))
    return spark.createDataFrame(rows, TERM_SCHEMA)


# --- labels and consensus -------------------------------------------------
#
# Expressions are SQL text here: a rule of a few hundred terms is parsed once
# instead of being built by thousands of calls.


def polarity_label(x: str) -> str:
    edge = POLARITY_EDGE
    return f"CASE WHEN {x} > {edge}D THEN 'positive' WHEN {x} < -{edge}D THEN 'negative' ELSE 'neutral' END"


def valence_label(x: str) -> str:
    edge = VALENCE_EDGE
    return f"CASE WHEN {x} >= {edge}D THEN 'positive' WHEN {x} <= -{edge}D THEN 'negative' ELSE 'neutral' END"


def consensus(polarity: str, polarity_lab: str, compound: str, valence_lab: str) -> str:
    """Agreement keeps the label with 0.8; otherwise the valence label holds with 0.6."""
    return (
        f"named_struct('final_sentiment', {valence_lab}, "
        f"'confidence', CASE WHEN {polarity_lab} = {valence_lab} THEN 0.8D ELSE 0.6D END, "
        f"'final_score', {exact_round_sql(f'({polarity} + {compound}) / 2D')})"
    )


# --- words ----------------------------------------------------------------


def valence_words(text: Column) -> Column:
    """Words of a raw text for the valence rules: outer punctuation goes, except from short tokens."""
    bare = lambda w: F.regexp_replace(w, f"^[{PUNCTUATION}]+|[{PUNCTUATION}]+$", "")
    return F.transform(X.words(text), lambda w: F.when(F.length(bare(w)) <= 2, w).otherwise(bare(w)))


def polarity_words(text: Column) -> Column:
    """Words of a raw text for the polarity rules; ``n't`` is a word of its own."""
    return F.regexp_extract_all(
        F.regexp_replace(F.lower(text), r"n't\b", " n't"), F.lit(r"n't|[\p{L}\p{N}]+(?:'[\p{L}]+)?"), F.lit(0)
    )


# --- valence --------------------------------------------------------------
#
# In the rules ``e`` is the array of entries, ``w`` that of the words, ``i`` the
# position of a word, ``c`` its entry, and ``v`` its valence so far.


def _near(d: int, field: str) -> str:
    """A field of the entry ``d`` words before."""
    return f"get(e, i - {d}).{field}"


def _role(d: int, *roles: str) -> str:
    """Test of the role of the word ``d`` before; false where there is none."""
    return f"coalesce({_near(d, 'role')} IN ({', '.join(repr(r) for r in roles)}), false)"


def _raise(v: str, amount: str) -> str:
    """``v`` moved away from zero, or towards it by a negative amount."""
    return f"{v} + CASE WHEN {v} < 0D THEN -({amount}) ELSE {amount} END"


def _look_back(d: int, capitals: str | None) -> str:
    """The effect on ``v`` of the word ``d`` before, unless that has a valence of its own."""
    so = {
        1: "false",
        2: f"{_role(2, 'never')} AND {_role(1, 'so')}",
        3: f"({_role(3, 'never')} AND {_role(2, 'so')}) OR {_role(1, 'so')}",
    }[d]
    doubt = {1: "false", 2: _role(1, "doubt"), 3: f"({_role(2, 'doubt')} OR {_role(1, 'doubt')})"}[d]
    boost = f"coalesce({_near(d, 'boost')}, 0D)"
    if capitals:
        loud = f"{_near(d, 'boost')} IS NOT NULL AND get({capitals}, i - {d})"
        boost = f"({boost} + CASE WHEN {loud} THEN {CAPITALS}D ELSE 0D END)"
    factor = (
        f"CASE WHEN {so} THEN {NEVER_SO}D WHEN {_role(d, 'without')} AND {doubt} THEN 1D "
        f"WHEN {_near(d, 'negation')} THEN {NEGATED}D ELSE 1D END"
    )
    raised = let_sql("b", f"{boost} * {DECAY[d]}D", _raise("v", "b"))
    return f"CASE WHEN i >= {d} AND {_near(d, 'valence')} IS NULL THEN ({raised}) * {factor} ELSE v END"


def _phrases() -> str:
    """The effect on ``v`` of phrases around a word that has three words before it."""
    span = lambda first, last: "concat_ws(' ', " + ", ".join(f"get(w, i + {k})" for k in range(first, last + 1)) + ")"
    idioms = "map(" + ", ".join(f"{lookup.literal(p)}, {x}D" for p, x in L.IDIOMS.items()) + ")"
    own = lambda first, last: f"element_at({idioms}, {span(first, last)})"
    spans = [(0, 2), (0, 1), (-1, 0), (-2, 0), (-2, -1), (-3, -1), (-3, -2)]
    idiom = f"coalesce({', '.join(own(*s) for s in spans)}, v)"
    lowering = ", ".join(lookup.literal(p) for p in L.LOWERING_PHRASES)
    lowered = " ".join(f"- CASE WHEN {span(*s)} IN ({lowering}) THEN {L.BOOST}D ELSE 0D END" for s in spans[-3:])
    return f"CASE WHEN i >= 3 AND {_near(3, 'valence')} IS NULL THEN {idiom} {lowered} ELSE v END"


def _token_valence(capitals: str | None) -> str:
    """Valence of one word after all rules but that of ``but``."""
    own = (
        f"CASE WHEN {_role(1, 'no')} OR {_role(2, 'no')} OR ({_role(3, 'no')} AND {_role(1, 'or')}) "
        f"THEN c.valence * {NEGATED}D WHEN c.role = 'no' AND get(e, i + 1).valence IS NOT NULL THEN 0D ELSE c.valence END"
    )
    steps = [own]
    if capitals:
        # At zero, as after a negating "no", a word in capitals counts as negative.
        steps.append(f"CASE WHEN get({capitals}, i) THEN v + CASE WHEN v > 0D THEN {CAPITALS}D ELSE -{CAPITALS}D END ELSE v END")
    steps += [*(_look_back(d, capitals) for d in DECAY), _phrases()]
    value = steps[0]
    for step in steps[1:]:
        value = let_sql("v", value, step)
    least = f"{_role(1, 'least')} AND {_near(1, 'valence')} IS NULL AND NOT {_role(2, 'at')}"
    return let_sql("v", value, f"CASE WHEN {least} THEN v * {NEGATED}D ELSE v END")


def _word_scores(capitals: str | None) -> str:
    """The scores of the words of ``e`` that are not zero, in millionths."""
    weight = f"CASE WHEN k = 0 OR i + 1 = k THEN 1D WHEN i + 1 < k THEN {BEFORE_BUT}D ELSE {AFTER_BUT}D END"
    kind_of = "coalesce(c.role = 'kind' AND get(e, i + 1).role = 'of', false)"
    score = (
        f"CASE WHEN c.valence IS NOT NULL AND c.boost IS NULL AND NOT {kind_of} "
        f"THEN {micro_sql(f'{_token_valence(capitals)} * {weight}')} END"
    )
    scores = f"filter(transform(e, (c, i) -> {score}), x -> x <> 0L)"
    return let_sql("k", "array_position(transform(e, c -> c.role), 'but')", scores)


def valence_of_entries(entries: str, words: str, text: str, capitals: str | None = None) -> str:
    """The valence struct from the dictionary entries of a text's lower-cased words.

    ``text`` is read for exclamation and question marks. ``capitals`` marks the
    words that are written in capitals where others are not.
    """
    add = lambda test: f"aggregate(s, 0L, (a, x) -> a + CASE WHEN {test} THEN abs(x) ELSE 0L END)"
    marks = lambda mark: f"(length({text}) - length(replace({text}, '{mark}', '')))"
    questions = f"CASE WHEN n > 3 THEN {MAX_QUESTION} WHEN n > 1 THEN n * {QUESTION} ELSE 0 END"
    sums = (
        f"named_struct('up', {add('x > 0')}, 'down', {add('x < 0')}, "
        "'n_up', bigint(size(filter(s, x -> x > 0))), 'n_down', bigint(size(filter(s, x -> x < 0))), "
        "'n_zero', bigint(size(e) - size(s)), "
        f"'loud', bigint(least({marks('!')}, {MAX_EXCLAMATIONS}) * {EXCLAMATION} + {let_sql('n', marks('?'), questions)}))"
    )
    up, down = f"(t.up + t.n_up * {MICRO}L)", f"(t.down + t.n_down * {MICRO}L)"
    parts = (
        f"named_struct('total', double(t.up - t.down + bigint(signum(t.up - t.down)) * t.loud) / {MICRO}D, "
        f"'up', {up} + CASE WHEN {up} > {down} THEN t.loud ELSE 0L END, "
        f"'down', {down} + CASE WHEN {down} > {up} THEN t.loud ELSE 0L END, "
        f"'zero', t.n_zero * {MICRO}L)"
    )
    compound = exact_round_sql(clamp_sql(f"p.total / sqrt(p.total * p.total + {NORMALISER}D)"), 4)
    share = lambda part: exact_round_sql(f"double(p.{part}) / double(whole)")
    struct = lambda compound, positive, neutral, negative: (
        f"named_struct('compound', {exact_round_sql(compound)}, 'positive', {positive}, 'neutral', {neutral}, "
        f"'negative', {negative}, 'sentiment_label', {valence_label(compound)})"
    )
    scored = let_sql(
        "whole", "p.up + p.down + p.zero",
        let_sql("compound", compound, struct("compound", share("up"), share("zero"), share("down"))),
    )
    # Only a blank text has no words at all.
    result = f"CASE WHEN size(e) = 0 THEN {struct('0D', '0D', '1D', '0D')} ELSE {scored} END"
    scored = let_sql("s", _word_scores(capitals), let_sql("t", sums, let_sql("p", parts, result)))
    return let_sql("w", words, let_sql("e", entries, scored))


# --- polarity -------------------------------------------------------------


def polarity_of_entries(entries: str) -> str:
    """The polarity struct from the dictionary entries of a text's words."""
    modified = f"(coalesce({_near(1, 'modifier')}, false) AND {_near(1, 'polarity')} IS NOT NULL)"
    turned_modifier = f"({modified} AND coalesce({_near(2, 'negator')}, false))"
    intensity = (
        f"CASE WHEN {turned_modifier} THEN 1D / {_near(1, 'intensity')} "
        f"WHEN {modified} THEN {_near(1, 'intensity')} ELSE 1D END"
    )
    turned = f"CASE WHEN coalesce({_near(1, 'negator')}, false) OR {turned_modifier} THEN -0.5D ELSE 1D END"
    merged = "(coalesce(c.modifier, false) AND get(e, i + 1).polarity IS NOT NULL)"
    pair = let_sql(
        "m", intensity,
        f"named_struct('p', {micro_sql(f'{clamp_sql("c.polarity * m")} * {turned}')}, "
        f"'s', {micro_sql(clamp_sql('c.subjectivity * m'))})",
    )
    found = f"filter(transform(e, (c, i) -> CASE WHEN c.polarity IS NOT NULL AND NOT {merged} THEN {pair} END), x -> x IS NOT NULL)"
    mean = lambda f: (
        f"CASE WHEN size(s) = 0 THEN 0D ELSE double(aggregate(s, 0L, (a, x) -> a + x.{f})) / {MICRO}D / double(size(s)) END"
    )
    result = (
        f"named_struct('polarity', {exact_round_sql('m.p')}, 'subjectivity', {exact_round_sql('m.s')}, "
        f"'sentiment_label', {polarity_label('m.p')})"
    )
    means = f"named_struct('p', {mean('p')}, 's', {mean('s')})"
    return let_sql("e", entries, let_sql("s", found, let_sql("m", means, result)))


# --- scorers on a text column -----------------------------------------------


def valence_scores(
    df: DataFrame,
    terms: DataFrame,
    text: str = "text",
    out: str = "vader_sentiment",
    max_keys: int = lookup.MAX_KEYS,
    emoji: DataFrame | None = None,
) -> DataFrame:
    """Add the valence struct of any text, capitals included; with a table of their names, emoji are read as words."""
    shouted = "transform(_raw, w -> upper(w) = w AND lower(w) <> w)"
    mixed = "exists(l, x -> x) AND exists(l, x -> NOT x)"
    loud = let_sql("l", shouted, f"CASE WHEN {mixed} THEN l END")
    scores = valence_of_entries("_entries", "_words", "_text", "loud")
    given = df.withColumn("_text", F.coalesce(F.col(text), F.lit("")))
    if emoji is not None:
        given = given.transform(spell_emoji, emoji, "_text", "_text", max_keys)
    return (
        given.withColumn("_raw", valence_words(F.col("_text")))
        .withColumn("_words", F.transform("_raw", F.lower))
        .transform(lookup.entry_adder(terms, "term", max_keys), "_words", "_entries")
        .withColumn(out, F.expr(let_sql("loud", loud, scores)))
        .drop("_text", "_raw", "_words", "_entries")
    )


def polarity_scores(
    df: DataFrame,
    terms: DataFrame,
    text: str = "text",
    out: str = "textblob_sentiment",
    max_keys: int = lookup.MAX_KEYS,
) -> DataFrame:
    """Add the polarity struct of any text."""
    return (
        df.withColumn("_words", polarity_words(F.coalesce(F.col(text), F.lit(""))))
        .transform(lookup.entry_adder(terms, "term", max_keys), "_words", "_entries")
        .withColumn(out, F.expr(polarity_of_entries("_entries")))
        .drop("_words", "_entries")
    )


def score_sentiment(
    df: DataFrame, terms: DataFrame, max_keys: int = lookup.MAX_KEYS
) -> DataFrame:
    """Add both scores and the consensus of cleaned posts.

    The processed text is scored, or the original one where cleaning left
    nothing. Both scorers read the same dictionary entries; only rows that
    fall back to the original text are split a second time for polarity.
    """
    add = lookup.entry_adder(terms, "term", max_keys)
    scores = sentiment_of_entries(
        "slice(found, 1, size(given.words))", "given.words",
        "CASE WHEN given.cleaned THEN found ELSE slice(found, size(given.words) + 1, size(given.other)) END", "given.text",
    )
    scored = (
        df.withColumn("_given", _given(F.col("processed_text"), F.col("original_text")))
        .transform(add, "_given.both", "_found")
        .withColumn("_sentiment", F.expr(let_sql("given", "_given", let_sql("found", "_found", scores))))
    )
    parts = ["textblob_sentiment", "vader_sentiment", "sentiment_consensus"]
    return scored.withColumns({p: F.col(f"_sentiment.{p}") for p in parts}).drop("_given", "_found", "_sentiment")


def _given(processed: Column, original: Column) -> Column:
    """The text to be scored, its words for either scorer, and both kinds of words in one array.

    Each column is named once: what a later filter pushes down must not multiply.
    """
    empty = F.array().cast("array<string>")

    def parts(p: Column, o: Column) -> Column:
        words = F.when(p != "", F.split(p, " ")).otherwise(valence_words(o))
        other = F.when(p != "", empty).otherwise(polarity_words(o))
        return let(words, lambda w: let(other, lambda x: F.struct(
            w.alias("words"), x.alias("other"), F.concat(w, x).alias("both"), (p != "").alias("cleaned"),
            F.when(p != "", p).otherwise(o).alias("text"),
        )))

    return let(F.coalesce(processed, F.lit("")), lambda p: let(F.coalesce(original, F.lit("")), lambda o: parts(p, o)))


def sentiment_of_entries(valence_entries: str, words: str, polarity_entries: str, text: str) -> str:
    """Both scores and their consensus as one struct."""
    agreed = consensus("tb.polarity", "tb.sentiment_label", "vd.compound", "vd.sentiment_label")
    # Without any text there is no opinion to agree on: confidence is zero.
    nothing = "named_struct('final_sentiment', 'neutral', 'confidence', 0D, 'final_score', 0D)"
    both = (
        f"named_struct('textblob_sentiment', tb, 'vader_sentiment', vd, "
        f"'sentiment_consensus', CASE WHEN {text} = '' THEN {nothing} ELSE {agreed} END)"
    )
    valence = valence_of_entries(valence_entries, words, text)
    return let_sql("tb", polarity_of_entries(polarity_entries), let_sql("vd", valence, both))
