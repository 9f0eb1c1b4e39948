import math
import random
import re
import time

import pytest
from pyspark.sql import functions as F

from postlens.operators import sentences

CLOSE = ")]}\"'»”’"


def bare(w):
    return re.sub(r"[.!?…,;:)\]}\"'»”’]+$", "", re.sub(r"^[(\[{\"'«“‘¿¡]+", "", w)).lower()


def brute_abbreviations(texts):
    n, k = {}, {}
    for t in texts:
        for w in (t or "").split():
            b = bare(w)
            n[b] = n.get(b, 0) + 1
            k[b] = k.get(b, 0) + bool(re.search(r"\.[)\]}\"'»”’]*[,;:]?[)\]}\"'»”’]*$", w))
    p = sum(k.values()) / sum(n.values())
    out = {}
    for w in n:
        if not k[w] or not re.fullmatch(r"[^\W\d_][^\W\d_.]*(?:\.[^\W\d_]*)*", w):
            continue
        like = lambda q: k[w] * math.log(q) + (n[w] - k[w]) * math.log(1 - q)  # noqa: B023, E731
        letters = len(w.replace(".", ""))
        score = -2 * (like(p) - like(0.99)) * math.exp(-letters) * (w.count(".") + 1) * letters ** (k[w] - n[w])
        if score >= 0.3:
            out[w] = score
    return out


def brute_count(text, abbreviations):
    words = (text or "").split()
    count = 0
    for w, after in zip(words, words[1:]):
        core = w.rstrip(CLOSE)
        if not core or core[-1] not in ".!?…" or re.match(r"[(\[{\"'«“‘¿¡]*[a-zà-öø-ÿ]", after):
            continue
        marks = re.search(r"[.!?…]+$", core).group()
        b = bare(w)
        count += marks != "." or not (b in abbreviations or len(b) == 1 and re.fullmatch("[a-zà-ÿ]", b))
    return count + bool(words)


def corpus():
    rng = random.Random(2)
    names = ["Smith", "Jones", "river", "Paris", "they", "walked", "said", "home", "e.g.", "Dr.", "Mr.", "etc.", "J.", "3.5", "No!", "Why?", "so...", '"Yes."', "(no)"]
    made = []
    for _ in range(120):
        words = [rng.choice(names) for _ in range(rng.randrange(1, 30))]
        made.append(" ".join(words) + rng.choice([".", "!", "", '."', " etc."]))
    return made + ["", None, "   ", "One.", "Dr. Who met Mr. Smith. He left.", "end. and more. And more."]


def test_abbreviations_and_counts_agree_with_brute_force(spark, texts):
    given = corpus()
    found = sentences.learn_abbreviations(texts(given))
    scores = {r.word: r.score for r in found.collect()}
    expected = brute_abbreviations(given)
    assert scores.keys() == expected.keys() and {"dr", "mr"} <= scores.keys()
    assert all(scores[w] == pytest.approx(expected[w], rel=1e-9) for w in expected)
    for max_keys in (1000, 0):
        rows = sentences.sentence_count(texts(given), found, max_keys=max_keys).collect()
        assert {r.id_post: r.sentences for r in rows} == {str(i): brute_count(t, expected) for i, t in enumerate(given)}


def test_corpus_without_periods(spark, texts):
    none = sentences.learn_abbreviations(texts(["no marks at all", None]))
    assert none.count() == 0
    assert [r.sentences for r in sentences.sentence_count(texts(["a b", "", None, "A. B! C"]), none).orderBy("id_post").collect()] == [1, 0, 0, 2]
    assert sentences.learn_abbreviations(texts([]).where(F.lit(False))).count() == 0


def test_a_long_text_takes_time_by_its_length(spark, texts):
    """The entries of the words are looked up once for a text: its words together, not all words for each."""
    found = sentences.learn_abbreviations(texts(corpus()))
    long = "Dr. Who met Mr. Smith at home. He left etc. and so on. " * 4000
    begun = time.monotonic()
    for max_keys in (1000, 0):
        assert [r.sentences for r in sentences.sentence_count(texts([long]), found, max_keys=max_keys).collect()] == [8000]
    assert time.monotonic() - begun < 60
