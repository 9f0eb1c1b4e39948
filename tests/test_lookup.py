import random
from collections import Counter

from conftest import plan
from pyspark.sql import functions as F

from postlens.functions import lookup
from postlens.functions import text as X


def test_both_ways_agree_for_copies_nulls_and_long_arrays(spark):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)] + ["", "é", 'q"', ","]
    arrays = [[rng.choice([*words, None]) for _ in range(rng.choice([0, 1, 5, 700]))] for _ in range(40)]
    arrays += [None, [], [None], ["a,b"], ["a", "b"], *[["w1", "w2", "w1"]] * 30]
    df = spark.createDataFrame([(i % 7 if i % 5 else None, a) for i, a in enumerate(arrays)], "id int, words array<string>").repartition(3)
    entries = {w: i for i, w in enumerate(words) if i % 3}
    table = spark.createDataFrame([*entries.items(), (None, 7)], "word string, n int")
    expected = Counter(
        (r.id, None if r.words is None else tuple(r.words), None if r.words is None else tuple(entries.get(w) for w in r.words))
        for r in df.collect()
    )
    for keys in (1000, 0):
        found = df.transform(lookup.entry_adder(table, "word", keys), "words", "found").collect()
        got = Counter((r.id, None if r.words is None else tuple(r.words), None if r.found is None else tuple(e and e.n for e in r.found)) for r in found)
        assert got == expected


def test_words_of_an_array_go_through_no_shuffle_before_the_join(spark):
    df = spark.createDataFrame([(["a", "b"],)], "words array<string>")
    table = spark.createDataFrame([("a", 1)], "word string, n int")
    found = lookup.join_entries(df, "words", "found", F.broadcast(table), "word")
    assert all("_word#" not in line for line in plan(found).splitlines() if "Exchange hash" in line)


def test_arrays_with_the_break_between_words_and_empty_words(spark):
    b = lookup.BREAK
    arrays = [["a" + b + "b", "a"], [b], ["", ""], [""], [], None, [None, ""], ["a", "b"], ["b", ""], ["", "a"], [b + "a", None]] * 3
    df = spark.createDataFrame([(i, a) for i, a in enumerate(arrays)], "id int, words array<string>")
    entries = {"a": 1, "": 2, b: 3, "a" + b + "b": 4, b + "a": 5}
    table = spark.createDataFrame([*entries.items()], "word string, n int")
    for keys in (100, 0):
        found = df.transform(lookup.entry_adder(table, "word", keys), "words", "found")
        assert found.columns == ["id", "words", "found"]
        expected = [(i, a, None if a is None else [entries.get(w) for w in a]) for i, a in enumerate(arrays)]
        assert sorted((r.id, r.words, None if r.found is None else [e and e.n for e in r.found]) for r in found.collect()) == expected


def rows_of(node, name) -> int:
    """The rows that all operators of a name in an executed plan gave."""
    own = node.metrics().apply("numOutputRows").value() if node.nodeName() == name else 0
    return own + sum(rows_of(node.children().apply(i), name) for i in range(node.children().size()))


def test_a_word_goes_to_the_dictionary_once_for_a_bucket(spark, monkeypatch):
    rng = random.Random(8)
    df = spark.createDataFrame([(i, [f"w{rng.randrange(60)}" for _ in range(50)]) for i in range(500)], "id int, words array<string>")
    table = spark.createDataFrame([(f"w{i}", i) for i in range(60)], "word string, n int")
    monkeypatch.setattr(lookup, "BUCKETS", (1, 1), raising=False)
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        found = lookup.join_entries(df, "words", "found", table, "word")
        assert all([e.n for e in r.found] == [int(w[1:]) for w in r.words] for r in found.collect())
        # With the salted dictionary; for each array there are some 17,000.
        assert rows_of(found._jdf.queryExecution().executedPlan(), "Generate") <= 60 * 4 + 60 * lookup.salts(spark)
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_names_of_characters_are_not_searched_in_one_long_map(spark):
    names = sorted(X.ENTITIES)[::7] + ["AMP", "amp", "copy", "notin", "not", "nosuch", "fjlig"]
    given = [f"a &{n}; b &{n} c &{n}1 &{n}" for n in names]
    df = spark.createDataFrame([(t,) for t in given], "t string")
    decoded = df.select("t", X.decode_entities(F.col("t")).alias("d"))
    assert "str_to_map" not in decoded._jdf.queryExecution().analyzed().toString()
    for t, d in decoded.collect():
        name = t[3:].split(";")[0]
        known, bare = name in X.ENTITIES, name in X.BARE_ENTITIES
        text = X.ENTITIES.get(name, "").replace(" ", " ")
        short = text if bare else f"&{name}"
        assert d == f"a {text if known else f'&{name};'} b {short} c &{name}1 {short}"
