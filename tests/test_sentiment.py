import math
import random
import string
from fractions import Fraction

import pytest
from conftest import plan
from pyspark.sql import functions as F

from checks.tables import LEXICON
from postlens.functions import numbers
from postlens.operators import clean, enrich, sentiment

FIELDS = ["valence", "boost", "negation", "role", "polarity", "subjectivity", "intensity", "modifier", "negator"]
TERMS = {row[0]: dict(zip(FIELDS, row[1:], strict=True)) for row in LEXICON}


def entry(words, i, field):
    return TERMS.get(words[i], {}).get(field) if 0 <= i < len(words) else None


def brute_valence(words, raw=None, text=""):
    """The word rules, one word at a time; ``raw`` holds the words as they are written, ``text`` the marks."""
    e = lambda i, f: entry(words, i, f)
    loud = [w.upper() == w and w.lower() != w for w in raw or words]
    if all(loud) or not any(loud):
        loud = [False] * len(words)
    has = lambda i: e(i, "valence") is not None
    scores = []
    for i in range(len(words)):
        if not has(i) or e(i, "boost") is not None or (e(i, "role") == "kind" and e(i + 1, "role") == "of"):
            scores.append(0)
            continue
        v = e(i, "valence")
        if e(i, "role") == "no" and has(i + 1):
            v = 0.0
        if e(i - 1, "role") == "no" or e(i - 2, "role") == "no" or (e(i - 3, "role") == "no" and e(i - 1, "role") == "or"):
            v = e(i, "valence") * -0.74
        if loud[i]:
            v += 0.733 if v > 0 else -0.733
        for d, decay in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i < d or has(i - d):
                continue
            b = ((e(i - d, "boost") or 0.0) + (0.733 if loud[i - d] and e(i - d, "boost") is not None else 0.0)) * decay
            v = v - b if v < 0 else v + b
            r = [None, e(i - 1, "role"), e(i - 2, "role"), e(i - 3, "role")]
            if (d == 2 and r[2] == "never" and r[1] == "so") or (
                d == 3 and ((r[3] == "never" and r[2] == "so") or r[1] == "so")
            ):
                v *= 1.25
            elif r[d] == "without" and ((d == 2 and r[1] == "doubt") or (d == 3 and "doubt" in r[1:3])):
                pass
            elif e(i - d, "negation"):
                v *= -0.74
        if e(i - 1, "role") == "least" and not has(i - 1) and e(i - 2, "role") != "at":
            v *= -0.74
        scores.append(v)
    but = next((i for i, w in enumerate(words) if entry(words, i, "role") == "but"), None)
    if but is not None:
        scores = [s * (0.5 if i < but else 1.5 if i > but else 1) for i, s in enumerate(scores)]
    micro = [math.floor(s * 1e6 + 0.5) for s in scores]
    up = sum(s + 10**6 for s in micro if s > 0)
    down = sum(10**6 - s for s in micro if s < 0)
    zero = 10**6 * sum(s == 0 for s in micro)
    asked = text.count("?")
    marks = min(text.count("!"), 4) * 292_000 + (960_000 if asked > 3 else asked * 180_000 if asked > 1 else 0)
    whole_sum = sum(micro)
    total = (whole_sum + ((whole_sum > 0) - (whole_sum < 0)) * marks) / 1e6
    up, down = up + (marks if up > down else 0), down + (marks if down > up else 0)
    compound = round(total / math.sqrt(total * total + 15), 4)
    whole = up + down + zero
    label = "positive" if compound >= 0.05 else "negative" if compound <= -0.05 else "neutral"
    return round(compound, 3), round(up / whole, 3), round(zero / whole, 3), round(down / whole, 3), label


def brute_polarity(words):
    e = lambda i, f: entry(words, i, f)
    found = []
    for i in range(len(words)):
        if e(i, "polarity") is None or (e(i, "modifier") and e(i + 1, "polarity") is not None):
            continue
        modified = bool(e(i - 1, "modifier")) and e(i - 1, "polarity") is not None
        turned = modified and bool(e(i - 2, "negator"))
        k = (1 / e(i - 1, "intensity") if turned else e(i - 1, "intensity")) if modified else 1.0
        clip = lambda x: max(-1.0, min(1.0, x))
        p = clip(e(i, "polarity") * k) * (-0.5 if e(i - 1, "negator") or turned else 1)
        found.append((math.floor(p * 1e6 + 0.5), math.floor(clip(e(i, "subjectivity") * k) * 1e6 + 0.5)))
    if not found:
        return 0.0, 0.0, "neutral"
    p, s = (sum(x[j] for x in found) / 1e6 / len(found) for j in (0, 1))
    return round(p, 3), round(s, 3), "positive" if p > 0.1 else "negative" if p < -0.1 else "neutral"


@pytest.mark.parametrize("max_keys", [1000, 0])
def test_scores_agree_with_brute_force(spark, texts, max_keys):
    rng = random.Random(3)
    words = [*TERMS, "xx", "yy"]
    given = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 12))) for _ in range(400)]
    terms = spark.createDataFrame(LEXICON, sentiment.TERM_SCHEMA)
    rows = texts(given).withColumns({"processed_text": F.col("text"), "original_text": F.col("text")})
    for r in sentiment.score_sentiment(rows, terms, max_keys=max_keys).collect():
        assert tuple(r.vader_sentiment) == brute_valence(r.text.split()), r.text
        assert tuple(r.textblob_sentiment) == brute_polarity(r.text.split()), r.text


def test_scores_of_raw_texts_agree_with_brute_force(spark, texts):
    rng = random.Random(4)
    words = [w for w in TERMS if len(w) > 2] + ["xxx", "yyyy"]
    dress = lambda w: rng.choice(["", "", '"', "("]) + rng.choice([w, w, w.upper()]) + rng.choice(["", "", "!", "?", "...", ",", ")"])
    given = [" ".join(dress(rng.choice(words)) for _ in range(rng.randint(1, 12))) for _ in range(300)]
    terms = spark.createDataFrame(LEXICON, sentiment.TERM_SCHEMA)
    for r in sentiment.valence_scores(texts(given), terms).collect():
        raw = [w.strip(string.punctuation) for w in r.text.split()]
        assert tuple(r.vader_sentiment) == brute_valence([w.lower() for w in raw], raw, r.text), r.text


def test_clear_sentences(spark, texts):
    given = ["We adored the lovely old garden, a perfect and beautiful place!",
             "What an ugly, disgusting room; the worst and most awful one yet!",
             "The box stands on the shelf beside the window.", "", None, "   "]
    terms = sentiment.seed_terms(spark)
    both = sentiment.valence_scores(sentiment.polarity_scores(texts(given), terms), terms)
    labels = {r.id_post: (r.textblob_sentiment.sentiment_label, r.vader_sentiment.sentiment_label) for r in both.collect()}
    assert labels["0"] == ("positive", "positive") and labels["1"] == ("negative", "negative") and labels["2"] == ("neutral", "neutral")
    blank = both.where("id_post in ('3', '4', '5')").collect()
    assert all(tuple(r.vader_sentiment) == (0.0, 0.0, 1.0, 0.0, "neutral") for r in blank)
    assert all(tuple(r.textblob_sentiment) == (0.0, 0.0, "neutral") for r in blank)


@pytest.mark.parametrize("text,compound", [
    ("good", 0.4404), ("very good", 0.4927), ("not good", -0.3412), ("not very good", -0.3865), ("good!", 0.4926),
    ("good!!!!!!", 0.6209), ("good but bad", -0.5859), ("GOOD day", 0.5622), ("kind of day", 0.0), ("never so good", 0.5777),
    ("at least good", 0.4404), ("least good", -0.3412), ("without doubt good", 0.4404), ("no good", -0.3412),
    ("is it good??", 0.504), ("we are all bad ass", 0.3612), ("i would say to die for", -0.5994),
    ("it was just enough fun", 0.4601), ("we had just enough more fun", 0.5106), ("a bad ass", -0.5423),
])
def test_valence_rules(spark, texts, text, compound):
    terms = sentiment.seed_terms(spark)
    got = sentiment.valence_scores(texts([text]), terms).first().vader_sentiment.compound
    assert got == pytest.approx(round(compound, 3), abs=0.0011)


@pytest.mark.parametrize("text,polarity", [
    ("good", 0.7), ("very good", 0.91), ("not good", -0.35), ("not very good", -0.269), ("isn't good", -0.35), ("very", 0.2),
])
def test_polarity_rules(spark, texts, text, polarity):
    got = sentiment.polarity_scores(texts([text]), sentiment.seed_terms(spark)).first().textblob_sentiment.polarity
    assert got == polarity


def test_label_edges(spark):
    df = spark.createDataFrame([(0.1,), (0.1000001,), (-0.1,), (-0.2,), (0.05,), (-0.05,), (0.0499,)], "x double")
    p = [r[0] for r in df.select(F.expr(sentiment.polarity_label("x"))).collect()]
    v = [r[0] for r in df.select(F.expr(sentiment.valence_label("x"))).collect()]
    assert p == ["neutral", "positive", "neutral", "negative", "neutral", "neutral", "neutral"]
    assert v == ["positive", "positive", "negative", "negative", "positive", "negative", "neutral"]


def test_consensus(spark):
    df = spark.createDataFrame([(0.5, "positive", 0.6, "positive"), (0.2, "positive", -0.3, "negative")],
                               "p double, pl string, c double, cl string")
    got = [tuple(r[0]) for r in df.select(F.expr(sentiment.consensus("p", "pl", "c", "cl"))).collect()]
    assert got == [("positive", 0.8, 0.55), ("negative", 0.6, -0.05)]


def test_exact_round(spark):
    rng = random.Random(5)
    values = [rng.uniform(-3, 3) for _ in range(2000)] + [(a + b) / 2 for a in (0.123, -0.457, 0.002) for b in (k / 1000 for k in range(-500, 500))]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for r in df.select("x", numbers.exact_round("x").alias("r"), numbers.exact_round("x", 4).alias("r4")).collect():
        assert r.r == float(round(Fraction(r.x), 3)) and r.r4 == round(r.x, 4)


ROBUST = ["Good evening all!", "🎉 what a great party 🎉", "via @someone see http://a.example/x?y=1", "STOP IT!!! RIGHT THERE!!!",
          "2024 10 31", "b", "", None, "   ", "if so then because"]


def test_enrich_gives_all_results(spark, texts):
    terms = sentiment.seed_terms(spark)
    rows = {r.id_post: r for r in enrich.enrich(clean.preprocess(texts(ROBUST)), terms).collect()}
    assert len(rows) == len(ROBUST)
    for r in rows.values():
        assert all(r[c] is not None for c in enrich.NLP_COLUMNS)
    assert tuple(rows["6"].sentiment_consensus) == tuple(rows["7"].sentiment_consensus) == ("neutral", 0.0, 0.0)
    assert tuple(rows["8"].sentiment_consensus) == ("neutral", 0.8, 0.0)


def test_enrich_is_narrow_and_a_later_filter_stays_cheap(spark, texts):
    terms = sentiment.seed_terms(spark)
    done = enrich.enrich(clean.preprocess(texts(["very good"])), terms)
    assert "Exchange" not in plan(done) and "Python" not in plan(done)
    filtered = done.where("sentiment_consensus.final_sentiment = 'positive' AND word_count > 0")
    assert len(plan(filtered)) < 4 * len(plan(done)) and filtered.count() == 1
