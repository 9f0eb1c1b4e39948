"""Language identification: guards, confidence, trained profiles, function words."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.functions import lookup, text as X
from postlens.functions.binding import let_sql
from postlens.functions.numbers import to_micro
from postlens.functions.wordlists import LANGUAGE_WORDS

UNKNOWN = "unknown"
MIN_LETTERS = 3
CHUNK = 50_000


def langid_text(c: Column) -> Column:
    """The ASCII letters and single blanks of a text, in lower case."""
    return F.lower(X.collapse_ws(X.letters_only(F.coalesce(c, F.lit("")))))


def too_short(letters: Column) -> Column:
    """True if a text leaves fewer than three characters after ``langid_text``.

    A stripped text of fewer than three characters cannot leave three either,
    so this one test stands for the guards on the text and on its letters.
    """
    return F.length(letters) < MIN_LETTERS


def language_confidence(n_words: Column) -> Column:
    """A tenth per word, at least 0.5 and at most 0.95; whole hundredths, so exact."""
    return F.least(F.lit(95), F.greatest(F.lit(50), F.lit(10) * n_words)).cast("double") / F.lit(100.0)


def blank_words(letters: Column) -> Column:
    """Number of words of a text whose words are split by single blanks."""
    gaps = F.length(letters) - F.length(F.replace(letters, F.lit(" "), F.lit("")))
    return F.when(letters == "", 0).otherwise(gaps + 1)


def _chunks(letters: str) -> str:
    """SQL text of the padded text in overlapping parts, so that no task holds all trigrams of a huge one.

    There is a blank before the first and after the last word. Each trigram of
    the padded text is in exactly one part.
    """
    last = f"greatest(0, int((length({letters}) - 1) div {CHUNK}))"
    part = f"substring(padded, k * {CHUNK} + 1, {CHUNK + 2})"
    return let_sql("padded", f"concat(' ', {letters}, ' ')", f"transform(sequence(0, {last}), k -> {part})")


def _grams(chunk: str) -> str:
    """SQL text of the trigrams of a part: those that begin at every third place, from each of the first three."""
    return "concat(" + ", ".join(f"regexp_extract_all(substring({chunk}, {k}), '.{{3}}', 0)" for k in (1, 2, 3)) + ")"


def _with_grams(df: DataFrame, letters: str, *kept: str) -> DataFrame:
    """One row per trigram of ``letters``, with the columns ``kept``."""
    return df.select(*kept, F.expr(f"explode({_chunks(letters)})").alias("chunk")).select(
        *kept, F.expr(f"explode({_grams('chunk')})").alias("gram")
    )


HELD_LANGUAGES = 256  # languages that a task counts at once, 160 KB each
STEP = 1 << 20  # bytes of text that are counted at once


def _gram_counter() -> Callable:
    """A function over Arrow batches of languages and padded letters: the trigrams of each part of the rows, counted."""
    held, step = HELD_LANGUAGES, STEP

    def count(batches):
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        letters = " abcdefghijklmnopqrstuvwxyz"
        code = np.zeros(256, np.int32)
        code[[ord(x) for x in letters]] = range(27)
        names = pa.array([a + b + c for a in letters for b in letters for c in letters])
        sums = {}

        def add(lang, texts):
            offsets = np.frombuffer(texts.buffers()[1], np.int64, len(texts) + 1, texts.offset * 8)
            data = np.frombuffer(texts.buffers()[2], np.uint8)
            ends = offsets[1:]
            total = sums.setdefault(lang, np.zeros(27**3 + 1, np.int64))
            for at in range(int(offsets[0]), int(offsets[-1]), step):
                last = min(at + step, int(offsets[-1]))
                d = code[data[at : last + 2]]
                if last + 2 > len(data):
                    d = np.concatenate([d, np.zeros(last + 2 - len(data), np.int32)])
                grams = d[:-2] * 729 + d[1:-1] * 27 + d[2:]
                for back in (1, 2):  # the last two places of a text begin no trigram
                    no = ends[np.searchsorted(ends, at + back) : np.searchsorted(ends, last + back)] - back - at
                    grams[no] = 27**3
                total += np.bincount(grams, minlength=27**3 + 1)

        def counted():
            for lang, total in sums.items():
                found = np.flatnonzero(total[:-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found), kind), names.take(pa.array(found)), pa.array(total[found])], ["lang", "gram", "n"]
                )
            sums.clear()

        for batch in batches:
            kind = batch.schema.field(0).type
            texts = pc.cast(batch.column(1), pa.large_string())
            for lang in pc.unique(batch.column(0)).to_pylist():
                add(lang, texts.filter(pc.equal(batch.column(0), pa.scalar(lang, kind))))
                if len(sums) > held:
                    yield from counted()
        if sums:
            yield from counted()

    return count


def train_language_profiles(
    df: DataFrame, text: str = "text", lang: str = "lang", top: int = 300
) -> DataFrame:
    """Profiles ``(lang, gram, weight, floor)`` from texts of known language.

    ``weight`` is the smoothed log frequency of the gram in its language in
    millionths, ``floor`` that of a gram never seen. Each task counts its texts in one vector
    of 27**3 grams per language, so neither a frequent language nor a frequent gram makes a large group.
    """
    known = df.where(F.col(lang).isNotNull())
    padded = known.select(F.col(lang).alias("lang"), F.concat(F.lit(" "), langid_text(F.col(text)), F.lit(" ")).alias("padded"))
    kind = padded.schema["lang"]
    found = padded.mapInArrow(_gram_counter(), T.StructType([kind, T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())]))
    counts = found.groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    by_lang = Window.partitionBy("lang")
    ranked = counts.withColumn("total", F.sum("n").over(by_lang)).withColumn(
        "rank", F.row_number().over(by_lang.orderBy(F.desc("n"), "gram"))
    )
    log = lambda n: to_micro(F.ln(n / F.col("total").cast("double")))
    return ranked.where(F.col("rank") <= top).select(
        "lang", "gram", log(F.col("n") + F.lit(0.5)).alias("weight"), log(F.lit(0.5)).alias("floor")
    )


def detect_language(
    df: DataFrame,
    profiles: DataFrame,
    text: str = "original_text",
    out: str = "language_detection",
    max_keys: int = lookup.MAX_KEYS,
) -> DataFrame:
    """Add the struct ``out`` of ``language`` and ``confidence``: the profile with the highest score.

    The score of a language adds, for every trigram of the whole text, its
    weight or the floor; ties go to the first code. Profiles of up to
    ``max_keys`` rows are read inside the row, larger ones are joined. ``profiles`` holds a gram once for each language.
    """
    rows = lookup.bounded_rows(profiles, ["gram", "lang"], max_keys)
    letters = langid_text(F.col(text))
    if rows is None:
        found = _best_by_join(df.withColumn("_letters", letters), profiles)
        return found.withColumn(out, F.expr(_result("_letters", "_best"))).drop("_letters", "_best")
    result = let_sql("l", "_letters", _result("l", _best_in_row(rows, "l")))
    return df.withColumn("_letters", letters).withColumn(out, F.expr(result)).drop("_letters")


def _result(letters: str, best: str) -> str:
    """Language and confidence, after the guards, for the best language of a text."""
    known = f"b IS NOT NULL AND length({letters}) >= {MIN_LETTERS}"
    words = f"(CASE WHEN {letters} = '' THEN 0 ELSE length({letters}) - length(replace({letters}, ' ', '')) + 1 END)"
    return let_sql(
        "b", best,
        f"named_struct('language', CASE WHEN {known} THEN b ELSE '{UNKNOWN}' END, "
        f"'confidence', CASE WHEN {known} THEN double(least(95, greatest(50, 10 * {words}))) / 100D ELSE 0D END)",
    )


def _first_best(langs: list[str], scores: str) -> str:
    """The language with the highest of the scores; the first one of several."""
    names = ", ".join(lookup.literal(x) for x in langs)
    return let_sql("s", scores, f"get(array({names}), int(array_position(s, array_max(s))) - 1)")


def _best_in_row(rows: list, letters: str) -> str:
    """The language of a text by its letters, null without a known gram."""
    floors = {r["lang"]: r["floor"] for r in rows}
    langs = sorted(floors)
    if not langs:
        return "string(NULL)"
    gains: dict[str, list[int]] = {}
    hashes = {}
    for r in rows:
        gains.setdefault(r["gram"], [0] * len(langs))[langs.index(r["lang"])] = r["weight"] - r["floor"]
        hashes[r["gram"]] = r["_hash"]
    find = lookup.constant_lookup([(g, hashes[g], v) for g, v in gains.items()], "array<bigint>", mostly_misses=False)
    bigints = lambda values: "array(" + ", ".join(f"{v}L" for v in values) + ")"
    # A gram without an entry adds nothing; every gram of the text adds the
    # floor of each language, and a text has as many grams as characters.
    add = f"coalesce(zip_with(acc, {find('g')}, (a, b) -> a + b), acc)"
    added = (
        f"aggregate({_chunks(letters)}, {bigints([0] * len(langs))}, "
        f"(sums, chunk) -> aggregate({_grams('chunk')}, sums, (acc, g) -> {add}))"
    )
    scores = f"zip_with(gained, {bigints(floors[x] for x in langs)}, (g, f) -> g + f * length({letters}))"
    return let_sql("gained", added, f"CASE WHEN array_max(gained) > 0 THEN {_first_best(langs, scores)} END")


def _best_by_join(df: DataFrame, profiles: DataFrame) -> DataFrame:
    """The same scores by a salted join of the grams of each distinct text to the profiles.

    Equal texts are put together whole; where a text lies alone, its grams are taken out and counted without a shuffle.
    """
    salts = lookup.salts(df.sparkSession)
    keyed = df.withColumn("_text_key", lookup.digest(F.col("_letters")))
    texts = keyed.select("_text_key", F.col("_letters").alias("_one")).dropDuplicates(["_text_key"])
    counts = _with_grams(texts, "_one", "_text_key").groupBy("_text_key", "gram").agg(F.count("*").alias("n"))
    # At most one row for each language.
    floors = {r["lang"]: r["floor"] for r in profiles.where("gram IS NOT NULL").groupBy("lang").agg(F.max("floor").alias("floor")).collect()}
    gains = profiles.where("gram IS NOT NULL").select("gram", "lang", (F.col("weight") - F.col("floor")).alias("gain"))
    salted = gains.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    gained = (
        counts.withColumn("_salt", F.pmod(F.xxhash64("_text_key"), F.lit(salts)).cast("int"))
        .join(salted, ["gram", "_salt"])
        .groupBy("_text_key", "lang")
        .agg(F.sum(F.col("n") * F.col("gain")).alias("gain"))
        .groupBy("_text_key")
        .agg(F.map_from_entries(F.collect_list(F.struct("lang", "gain"))).alias("_gained"))
        .withColumnRenamed("_text_key", "_key")
    )
    langs = sorted(floors)
    score = lambda x: f"coalesce(_gained[{lookup.literal(x)}], 0L) + {floors[x]}L * length(_letters)"
    best = _first_best(langs, "array(" + ", ".join(map(score, langs)) + ")") if langs else "string(NULL)"
    return (
        keyed.join(gained, F.col("_text_key") == F.col("_key"), "left")
        .withColumn("_best", F.expr(f"CASE WHEN _gained IS NOT NULL THEN {best} END"))
        .drop("_text_key", "_key", "_gained")
    )


def language_accuracy(
    df: DataFrame, profiles: DataFrame, text: str = "text", lang: str = "lang", max_keys: int = lookup.MAX_KEYS
) -> DataFrame:
    """``(lang, language, n, share)``: how many texts of each known language get each verdict, and what part of the language's.

    A language's accuracy is its share where both are the same.
    """
    found = detect_language(df.where(F.col(lang).isNotNull()), profiles, text, max_keys=max_keys)
    counts = found.groupBy(F.col(lang).alias("lang"), F.col("language_detection.language").alias("language")).agg(F.count("*").alias("n"))
    # One row for each pair of languages is left.
    return counts.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("lang")))


def detect_language_words(df: DataFrame, text: str = "original_text", out: str = "language_detection") -> DataFrame:
    """Add the struct ``out`` by the share of function words; needs no profile."""
    langs = sorted(LANGUAGE_WORDS)
    listed = {x: ", ".join(lookup.literal(w) for w in LANGUAGE_WORDS[x]) for x in langs}
    hits = ", ".join(f"size(filter(words, w -> w IN ({listed[x]})))" for x in langs)
    counted = let_sql("words", "split(l, ' ')", f"array({hits})")
    best = let_sql("h", counted, f"CASE WHEN array_max(h) > 0 THEN {_first_best(langs, 'h')} END")
    result = let_sql("l", "_letters", _result("l", best))
    return df.withColumn("_letters", langid_text(F.col(text))).withColumn(out, F.expr(result)).drop("_letters")
