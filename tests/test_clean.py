import random
import re
import string

import pytest
from conftest import plan
from pyspark.sql import functions as F

from postlens.functions import lookup, text as X
from postlens.functions.wordlists import STOP_WORDS
from postlens.operators import clean, lemma

CASES = [
    (X.strip_html, "<div>One <em>small</em> note here.</div>", "One small note here."),
    (X.strip_html, "<p>a</p><p>b</p>", "ab"),
    (X.strip_html, '<a title="x>y">z</a>', "z"),
    (X.strip_html, "x<!-- c > d -->y", "xy"),
    (X.strip_html, "i <3 you", "i <3 you"),
    (X.strip_html, "caf&eacute; &#65;&#x42;C &hellip;", "café ABC …"),
    (X.strip_html, "&unknown; &#xD800;&#0;&#1114112; a & b", "&unknown; ��� a & b"),
    (X.strip_html, "AT&T; R&D; &copy 2020 &copyx &#65 &#x42, &fjlig;&notin;&notin", "AT&T; R&D; © 2020 &copyx A B, fj∉&notin"),
    (X.strip_html, "<?xml version='1'?>hi <![CDATA[data]]>z", "hi dataz"),
    (X.strip_html, "<b it's>hello</b> he's <i title='a > b'>x</i>", "hello he's x"),
    (X.strip_html, "&amp;lt;", "&lt;"),
    (X.strip_html, "a&nbsp;b", "a b"),
    (X.strip_html, '<script>var t="</p>";</script>x<STYLE>p{}</STYLE>', "x"),
    (X.strip_html, "<!DOCTYPE html>text", "text"),
    (X.strip_html, "open <b", "open <b"),
    (X.strip_urls, "see https://a.example/b then http://c.example", "see  then "),
    (X.strip_urls, "http://a.b/c?d=e&f#frag", "#frag"),
    (X.strip_urls, "(http://a.b),é", "(é"),
    (X.strip_special, "Ask @ann: #news + more?", "Ask ann news  more"),
    (X.strip_punct_digits, "Room 12, floor 3: (left)!", "Room  floor  left"),
    (X.strip_ws, " \x1c a b\t ", "a b"),
]


@pytest.mark.parametrize("function,given,expected", CASES)
def test_scalar(spark, function, given, expected):
    df = spark.createDataFrame([(given,)], "t string")
    assert df.select(function(F.col("t"))).first()[0] == expected


def test_strip_every_whitespace(spark):
    blanks = [chr(i) for i in range(0x3100) if chr(i).isspace()]
    assert sorted(X.WS_CHARS) == blanks
    df = spark.createDataFrame([(b + "a" + b + "b" + b * 2,) for b in blanks] + [("".join(blanks),)], "t string")
    for r in df.select("t", X.strip_ws(F.col("t")).alias("s"), X.has_words(F.col("t")).alias("w")).collect():
        assert r.s == r.t.strip() and r.w == bool(r.s)


def test_token_operators(spark):
    df = spark.createDataFrame([(["we", "Were", "at", "the", "harbour", "harbour"],)], "t array<string>")
    assert df.select(X.drop_words(F.col("t"), STOP_WORDS)).first()[0] == ["harbour", "harbour"]
    given = "singing Cats older women class bus cities boxes lens abdomen bias thanks specimen physics gas trees"
    df = spark.createDataFrame([(given.split(),)], "t array<string>")
    assert df.select(clean.lemmatize(F.col("t"))).first()[0] == (
        "singing cat older woman class bus city box lens abdomen bias thanks specimen physics gas tree".split()
    )
    df = spark.createDataFrame([("i cannot say gonna wanna cannots",)], "t string")
    assert df.select(clean.tokenize(F.col("t"))).first()[0] == "i can not say gon na wan na cannots".split()


PIPELINE = [
    ("<p>Dear @ann! The GARDEN has 12 trees, see https://a.example and more...</p>", "dear ann garden tree see"),
    ("Call +49123 or write to ann@mail.example! Cost: $5.50", "call write annmailexample cost"),
    ("if so then because", ""), (None, ""), ("", ""), ("   ", ""),
    ("We paint small boats.", "paint small boat"),
    ("<p>Old <b>letters</b></p>", "old letter"),
    ("Letters at URL https://x.example/y, by @bob", "letter url bob"),
    ("12 houses, 3 streets!!!", "house street"),
    ("good,bad français", "goodbad franais"),
]


def test_preprocess(texts):
    rows = clean.preprocess(texts([t for t, _ in PIPELINE])).collect()
    for row, (given, expected) in zip(sorted(rows, key=lambda r: int(r.id_post)), PIPELINE, strict=True):
        assert row.processed_text == expected, given
        assert row.word_count == len(row.tokens) == len(expected.split())
        assert row.original_text == (given or "").lower()


def test_preprocess_is_narrow(texts):
    shown = plan(clean.preprocess(texts(["a"])))
    assert "Exchange" not in shown and "Python" not in shown
    assert clean.preprocess(texts([])).count() == 0


def test_preprocess_survives_hostile_markup(texts):
    hostile = ["<a " + "x='y' " * 50_000, "<" * 100_000, "<a " + "b" * 200_000, "&" * 100_000, "<script>" * 2_000]
    assert clean.preprocess(texts(hostile)).select("word_count").count() == len(hostile)
    clean.preprocess(texts(hostile)).write.format("noop").mode("overwrite").save()


def test_whitespace_and_letters_agree_with_python(spark):
    rng = random.Random(7)
    alphabet = string.printable + "  \x1c\x85éßñ٣😊　"
    given = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60))) for _ in range(500)]
    df = spark.createDataFrame([(t,) for t in given], "t string")
    got = df.select("t", X.collapse_ws(X.strip_punct_digits(X.strip_special(F.col("t")))).alias("steps"),
                    X.collapse_ws(X.letters_only(F.col("t"))).alias("fused"), X.strip_ws(F.col("t")).alias("s")).collect()
    for r in got:
        bare = re.sub(r"[^a-zA-Z0-9\s]", "", r.t).translate(str.maketrans("", "", string.punctuation))
        expected = re.sub(r"\s+", " ", re.sub(r"\d+", "", bare)).strip()
        assert r.steps == r.fused == expected
        assert r.s == r.t.strip()


def test_dictionary_lemmas_by_lookup_and_by_join(spark):
    rows = spark.createDataFrame([("1", ["dogs", "glasses", "was", "men", "dogs", "xyz"]), ("2", [])], "id_post string, tokens array<string>")
    nouns = spark.createDataFrame([("dog",), ("glass",), ("glasse",), ("man",)], "noun string")
    irregular = spark.createDataFrame([("was", "be")], "form string, lemma string")
    forms = rows.select(F.explode("tokens").alias("form"))
    lemmas = lemma.build_lemmas(forms, nouns, irregular)
    assert {tuple(r) for r in lemmas.collect()} == {("dogs", "dog"), ("glasses", "glass"), ("men", "man"), ("was", "be")}
    expected = {"1": ["dog", "glass", "be", "man", "dog", "xyz"], "2": []}
    for max_keys in (1000, 0):
        got = lemma.lemmatize_dict(rows, lemmas, max_keys=max_keys).collect()
        assert {r.id_post: r.tokens for r in got} == expected


def test_stop_list_as_table(spark):
    rows = spark.createDataFrame([("1", ["a", "b", "a", "c"]), ("2", []), ("3", ["a"])], "id_post string, tokens array<string>")
    unwanted = spark.createDataFrame([("a",), ("z",), ("a",)], "word string")
    for max_keys in (1000, 0):
        got = lemma.drop_listed(rows, unwanted, max_keys=max_keys).collect()
        assert {r.id_post: r.tokens for r in got} == {"1": ["b", "c"], "2": [], "3": []}


def test_stop_list_and_lemmas_as_tables_are_joined_as_one(spark, texts):
    rows = texts(["The dogs and the men, the dogs!", "so and the", None, "xyz dogs so men so"])
    unwanted = spark.createDataFrame([("the",), ("and",), ("men",), ("so",), ("the",), (None,)], "word string")
    lemmas = spark.createDataFrame([("dogs", "dog"), ("men", "man"), ("so", "sos"), (None, "x")], "form string, lemma string")
    for max_keys in (1000, 3, 0):
        found = clean.preprocess(rows, "text", unwanted, lemmas, max_keys)
        assert {r.id_post: r.tokens for r in found.collect()} == {"0": ["dog", "dog"], "1": [], "2": [], "3": ["xyz", "dog"]}
    # One of both tables, one with the dictionary, one with the rows.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Join ") == 3
    doubled = lemmas.union(spark.createDataFrame([("dogs", "d")], lemmas.schema))
    with pytest.raises(lookup.DoubledKey):
        clean.preprocess(rows, "text", unwanted, doubled, 0)
