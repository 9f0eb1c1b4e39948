from collections import Counter
import math
import random
import re

from conftest import plan
from pyspark.sql import functions as F

from postlens.operators import language

GIVEN = [
    ("We have to go there with you and he is not late", "en", 0.95),
    ("Voici la maison de mes parents et le jardin avec les fleurs", "fr", 0.95),
    ("", "unknown", 0.0), (None, "unknown", 0.0), ("Hi", "unknown", 0.0), ("123 456 789", "unknown", 0.0),
    ("   ", "unknown", 0.0),
]


def results(df):
    return {r.id_post: (r.language, r.confidence) for r in df.select("id_post", "language_detection.*").collect()}


def test_function_words(texts):
    got = results(language.detect_language_words(texts([t for t, _, _ in GIVEN]), "text"))
    assert got == {str(i): (l, c) for i, (_, l, c) in enumerate(GIVEN)}


def test_confidence(spark):
    df = spark.createDataFrame([(n,) for n in range(0, 30)], "n int")
    for r in df.select("n", language.language_confidence(F.col("n")).alias("c")).collect():
        assert r.c == round(min(0.95, max(0.5, r.n * 0.1)), 2)


def sample(spark):
    train = [("aab abb", "x"), ("aab aab", "x"), ("bcc ccb", "y"), ("ccc", "y"), (None, "y"), ("zzz", None)]
    return spark.createDataFrame(train, "text string, lang string")


def brute_profiles(rows, top):
    counts = {}
    for text, lang in rows:
        if lang is not None and text:
            p = f" {text} "
            counts.setdefault(lang, Counter()).update(p[i:i + 3] for i in range(len(p) - 2))
    out = {}
    for lang, c in counts.items():
        total = sum(c.values())
        log = lambda n: math.floor(math.log(n / total) * 1e6 + 0.5)
        for gram, n in sorted(c.items(), key=lambda x: (-x[1], x[0]))[:top]:
            out[lang, gram] = (log(n + 0.5), log(0.5))
    return out


def test_profiles_and_detection_agree_with_brute_force(spark, texts):
    train = sample(spark)
    profiles = language.train_language_profiles(train, top=5)
    rows = [tuple(r) for r in train.collect()]
    expected = brute_profiles(rows, 5)
    assert {(r.lang, r.gram): (r.weight, r.floor) for r in profiles.collect()} == expected
    given = ["aab", "ccc bcc", "abb ccb", "qqq", "aab ccc ccc", "ab", "bbb aaa"]
    floors = {lang: f for (lang, _), (_, f) in expected.items()}
    want = {}
    for i, text in enumerate(given):
        p = f" {text} "
        grams = [p[j:j + 3] for j in range(len(p) - 2)]
        known = any((lang, g) in expected for lang in floors for g in grams)
        score = {lang: sum(expected.get((lang, g), (f, f))[0] for g in grams) for lang, f in floors.items()}
        best = min(score, key=lambda l: (-score[l], l)) if known and len(text) >= 3 else "unknown"
        want[str(i)] = best
    for max_keys in (1000, 3):
        got = results(language.detect_language(texts(given), profiles, "text", max_keys=max_keys))
        assert {k: v[0] for k, v in got.items()} == want


def test_parts_of_a_long_text_give_the_same_result(spark, texts, monkeypatch):
    profiles = language.train_language_profiles(sample(spark))
    given = ["aab abb " * n + "ccc bcc " * (n // 2) for n in range(1, 30)] + ["", "aab", "aabb"]
    whole = results(language.detect_language(texts(given), profiles, "text"))
    counts = lambda: {tuple(r) for r in language.train_language_profiles(sample(spark)).collect()}
    expected = counts()
    for size in (1, 2, 7, 64):
        monkeypatch.setattr(language, "CHUNK", size)
        assert results(language.detect_language(texts(given), profiles, "text")) == whole
        assert counts() == expected


def test_detection_in_row_has_no_shuffle(spark, texts):
    profiles = language.train_language_profiles(sample(spark))
    shown = plan(language.detect_language(texts(["aab"]), profiles, "text"))
    assert "Exchange" not in shown and "Python" not in shown


def test_empty_profiles(spark, texts):
    none = language.train_language_profiles(sample(spark).where("false"))
    assert results(language.detect_language(texts(["some text"]), none, "text")) == {"0": ("unknown", 0.0)}


def test_profiles_of_many_texts_and_languages(spark, monkeypatch):
    rng = random.Random(5)
    rows = [("".join(rng.choice("ab c\t1é") for _ in range(rng.randrange(40))), rng.choice(["x", "y", "z", None])) for _ in range(200)]
    rows += [(None, "y"), ("", "x"), ("only digits 12", "w")]
    letters = lambda t: " ".join(re.sub(r"[^a-zA-Z\s]+", "", t or "").split()).lower()
    expected = brute_profiles([(letters(t), lang) for t, lang in rows], 300)
    df = spark.createDataFrame(rows, "text string, lang string").repartition(3)
    for held, step in ((256, 1 << 20), (1, 7), (2, 1), (1, 64)):
        monkeypatch.setattr(language, "HELD_LANGUAGES", held)
        monkeypatch.setattr(language, "STEP", step)
        found = language.train_language_profiles(df).collect()
        assert len(found) == len(expected) and {(r.lang, r.gram): (r.weight, r.floor) for r in found} == expected


def test_training_makes_no_row_for_each_gram(spark):
    assert "Generate" not in plan(language.train_language_profiles(sample(spark)))
