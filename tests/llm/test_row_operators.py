"""Similarity join, vector searches, reply trees and the pipeline against brute force."""

import random
from itertools import combinations

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from postlens.llm import chat, components, group_join, matrix_join, pivot_index
from postlens.llm import queries as Q


def words_of(text):
    return (text or "").encode().lower().split()


def shingle_set(text, k):
    w = words_of(text)
    return frozenset(tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))) if w else frozenset()


def brute_components(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    label = list(range(len(rows)))
    for i, j in combinations(range(len(rows)), 2):
        both = len(sets[i] & sets[j])
        if both and 100 * both >= percent * len(sets[i] | sets[j]):
            a, b = label[i], label[j]
            label = [min(a, b) if x in (a, b) else x for x in label]
    return sets, label


def corpus(seed):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(400)]
    make = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    passage, base, texts = make(40), make(120), []
    for i in range(40):
        w = list(base)
        for _ in range(i % 9):
            w[rng.randrange(len(w))] = rng.choice(vocabulary)
        texts.append(w)
    texts += [make(rng.randrange(1, 60)) + passage + make(rng.randrange(1, 60)) for _ in range(30)]
    texts += [make(n) for n in (1, 1, 2, 2, 3, 4, 5, 200)] + [base, base, ["w1"], ["w1"], ["W1"]]
    rows = [(i, " ".join(w)) for i, w in enumerate(texts)]
    return rows + [(900, ""), (901, None), (902, " \t"), (None, " ".join(base)), (5, rows[5][1]), (None, "lonely words here")]


@pytest.mark.parametrize(("k", "percent"), [(3, 90), (5, 80), (1, 50)])
def test_similarity_components(spark, k, percent):
    rows = corpus(k)
    docs = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, n int, digest string").repartition(3)
    found = group_join.similarity_components(docs, k, percent).collect()
    sets, label = brute_components(rows, k, percent)
    least = {}
    for (i, _), c in zip(rows, label):
        if i is not None:
            least[c] = min(i, least.get(c, i))
    expected = sorted((str(i), len(s), str(least.get(c))) for (i, _), s, c in zip(rows, sets, label))
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in found) == expected
    kept = group_join.keep_firsts(docs, k, percent)
    assert kept.columns == docs.columns and kept.count() == len(set(label))


def test_similar_sets_of_groups_whose_first_sets_differ(spark, monkeypatch):
    """Sets of a group share the first shingles only: the rest of the first set says nothing of the others."""
    monkeypatch.setattr(group_join, "OFTEN", 100)
    words = sorted((f"w{i}" for i in range(2000)), key=lambda w: group_join.shingles(w, 1)[0])
    early, late, rows = words[:120], words[120:], []
    for k in range(10):
        p, q, r = early[12 * k : 12 * k + 7], early[12 * k + 7 : 12 * k + 9], [late[90 * k + 30 * j : 90 * k + 30 * j + 23] for j in range(3)]
        # One prefix with two tails, and the second tail after another prefix; for odd k that has a first set of its own, too.
        rows += [p + r[0], p + r[1], *[p[:5] + q + r[2]] * (k % 2), p[:5] + q + r[1]]
    docs = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(rows)], "doc_id long, text string").coalesce(1)
    _, label = brute_components(list(enumerate(map(" ".join, rows))), 1, 80)
    found = {r.doc_id: r.component_id for r in group_join.similarity_components(docs, 1, 80).collect()}
    assert found == dict(enumerate(label)) and len(set(label)) == len(rows) - 10


def test_similarity_without_rows(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert group_join.similarity_components(docs).collect() == [] and group_join.keep_firsts(docs).collect() == []


def test_index_of_sizes_that_fit(spark):
    rng, percent = random.Random(4), 90
    groups = [(g, n, rng.sample(range(150), group_join.prefix_length(n, percent))) for g in range(60) for n in [rng.choice([20, 30, 60, 64, 100, 105, 110, 300])]]
    entries = [(s, g, n, at) for g, n, prefix in groups for at, s in enumerate(prefix)]
    first = lambda e: e[3] < group_join.index_length(e[2], percent)
    pair = lambda a, b: a[0] == b[0] and a[1] != b[1] and first(a) and a[2] <= b[2] and 100 * a[2] >= percent * b[2]
    expected = {e for e in entries if any(pair(e, o) or pair(o, e) for o in entries)}
    found = group_join.index(spark.createDataFrame(groups, "set long, n int, prefix array<long>"), percent)
    assert found._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") == 1
    assert {tuple(r) for r in found.collect()} == expected and 0 < len(expected) < len(entries) / 2


def test_filters_lose_nothing():
    rng = random.Random(4)
    for _ in range(300):
        n = rng.randrange(1, 120)
        a = rng.sample(range(10**6), n)
        b = [x for x in a if rng.random() < 0.93] + rng.sample(range(10**6, 2 * 10**6), rng.randrange(0, 8))
        if not b or not 100 * len(set(a) & set(b)) >= 80 * len(set(a) | set(b)):
            continue
        x, y = (np.unique(np.array(s, "u8") * group_join.MIX) for s in (a, b))
        empty = np.zeros(0, "u8"), np.zeros(0, "u1")
        small, large = sorted((x, y), key=len)
        first, second = (group_join.prefix(s, *empty, 80) for s in (small, large))
        assert set(first[: group_join.index_length(len(small), 80)].tolist()) & set(second.tolist())
        differ = np.bitwise_count(np.frombuffer(group_join.sketch(x), "u1") ^ np.frombuffer(group_join.sketch(y), "u1")).sum()
        assert differ <= len(set(a) ^ set(b))


def test_components_of_a_chain_and_a_star(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 100 + i) for i in range(1, 40)] + [(7, 7), (200, 150), (150, 200)]
    found = dict(tuple(r) for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert found == {**dict.fromkeys(range(51), 0), **dict.fromkeys(range(100, 140), 100), 150: 150, 200: 150}


# --- vectors ----------------------------------------------------------------------------


def vector_rows():
    rng = np.random.default_rng(3)
    m = rng.normal(size=(300, 16)).astype("f4")
    m[40:80] = m[40]  # ties
    rows = [(i, v.tolist()) for i, v in enumerate(m)]
    nan, inf = float("nan"), float("inf")
    return rows + [(1000, None), (1020, [nan] * 16), (1050, [0.0] * 15 + [inf]), (1100, [None] * 16), (1150, []), (None, m[3].tolist()), (40, m[5].tolist()), (1200, [1.0, 2.0])]


def brute_top(rows, step, k, change, zero):
    usable = [(i, np.array(v, "f4").astype("f8")) for i, v in rows if i is not None and v and None not in v and np.isfinite(v).all()]
    usable = [(i, v) for i, v in usable if zero or v.any()]
    queries = {}
    for i, v in usable:
        if i % step == 0 and (i not in queries or tuple(v) < tuple(queries[i])):
            queries[i] = v
    out = []
    for q, v in queries.items():
        scored = []
        for i, c in usable:
            if i != q and len(c) == len(v):
                s = 0.0
                for x, y in zip(change(v), change(c)):
                    s += float(x) * float(y)
                scored.append((-s, i))
        out += [(q, r, i, -s) for r, (s, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("search", ["pivot", "matrix"])
def test_vector_search(spark, search, monkeypatch):
    rows = vector_rows()
    df = spark.createDataFrame([(i, v, 1, "b") for i, v in rows], "vec_id long, embedding array<float>, id int, block string")
    if search == "pivot":
        for name, value in (("ROWS", 64), ("CHUNK", 16), ("PIVOTS", 5)):
            monkeypatch.setattr(pivot_index, name, value)
        found, expected = pivot_index.top_k(df), brute_top(rows, 50, 5, lambda v: np.floor(256 * v), True)
    else:
        monkeypatch.setattr(matrix_join, "ROWS", 64)
        found, expected = matrix_join.nearest(df), brute_top(rows, 20, 20, lambda v: v, False)
    assert sorted(tuple(r) for r in found.collect()) == expected


def test_no_more_than_the_sample_reaches_the_driver(spark, monkeypatch):
    monkeypatch.setattr(pivot_index, "SAMPLE", 200)
    rng = np.random.default_rng(5)
    given = [(i, rng.standard_normal(64).astype("f4").tolist()) for i in range(6000)]
    df = spark.createDataFrame(given, "id long, v array<float>").withColumn("dim", F.size("v")).repartition(30)
    order = df.select("id").orderBy(F.xxhash64("id")).limit(200).collect()
    expected = pivot_index.whole(np.array([given[r.id][1] for r in order], "f4"))
    conf = spark.sparkContext._jsc.sc().conf()
    conf.set("spark.driver.maxResultSize", "1m")
    try:
        found = pivot_index.spaces(df)[64]
        once = pivot_index.spaces(df.withColumn("id", F.lit(7).cast("long")))[64]
    finally:
        conf.remove("spark.driver.maxResultSize")
    length2 = max(float((pivot_index.whole(np.array(v, "f4")) ** 2).sum()) for _, v in given)
    assert found.length2 == length2 and once.pivots.shape == (pivot_index.PIVOTS, 64)
    assert np.array_equal(found.pivots, pivot_index.far_apart(expected, length2, pivot_index.PIVOTS))


def test_queries_of_blocks_are_not_broadcast(spark):
    one = np.ones(4)
    known = spark.sparkContext.broadcast({4: pivot_index.Space(4.0, one[None])})
    key, ids, zero = (4, 0, 0), np.array([50, 7]), np.zeros(1)
    asked = spark.createDataFrame([(*key, ids[:1].tobytes(), ids[:1].tobytes(), one.tobytes())], "dim int, pivot int, block int, q_ids binary, q_bounds binary, q_data binary")
    found = spark.createDataFrame([(*key, 0.0, 0.0, ids[1:].tobytes(), zero.tobytes(), (100 * one).tobytes())], pivot_index.BLOCK)
    # As tables, both are known to be small.
    hits = pivot_index.visited(pivot_index.stored(asked, "asked"), pivot_index.stored(found, "index"), known, 5)
    assert "Broadcast" not in hits._jdf.queryExecution().executedPlan().toString()
    assert [tuple(r) for r in hits.collect()] == [(50, [7], [400])]


def test_vector_search_without_rows(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert pivot_index.top_k(df).collect() == [] and matrix_join.nearest(df).collect() == []


# --- reply trees ------------------------------------------------------------------------

TREE = [
    ("t", "r", None, "user", "root", 1.0), ("t", "a", "r", "assistant", "</s>[INST] \\", 3.0), ("t", "b", "r", "assistant", "b", 1.0),
    ("t", "c", "a", "user", "<\\|im_end|>", 0.0), ("t", "d", "b", None, None, None), ("t", "e", "c", "assistant", "[\\\\/INST]<<SYS>>é😀", 1.0),
    ("t", "o", "gone", "user", "orphan", 9.0), ("u", "x", "y", "user", "circle", 1.0), ("u", "y", "x", "user", "circle", 1.0),
    ("u", "z", "x", "user", "under the circle", 1.0), ("u", "s", "s", "user", "self", 1.0), (None, "n", None, "a%0A\nb", "null tree", 0.0),
    ("t", None, "r", "user", "no id", 0.5), ("t", "b", "r", "assistant", "bb", 9.0),
]


def test_paths_of_trees(spark):
    df = spark.createDataFrame(
        [(*r, 1) for r in TREE], "tree string, id string, parent string, role string, text string, score double, leaf int"
    )
    found = chat.format_trees(df, best=None).withColumn("turns", chat.parsed(chat.F.col("formatted"))).withColumn(
        "learnt", chat.loss_text(chat.F.col("formatted"), chat.F.col("loss"))
    ).collect()
    text = {r[1]: (r[3] or "", r[4] or "") for r in reversed(TREE) if r[1]}
    paths = {("t", "e"): "race", ("t", "d"): "rbd", ("t", "o"): "o", (None, "n"): "n"}
    named = [r for r in found if not r.leaf.startswith("\0")]
    assert {(r.tree, r.leaf) for r in named} == set(paths) and len(found) == len(paths) + 1
    for r in named:
        expected = [text[c] for c in paths[r.tree, r.leaf]]
        assert [(t.role, t.text) for t in r.turns] == expected
        assert r.learnt == "".join(t for role, t in expected if role == "assistant")
    assert [r.leaf for r in sorted((r for r in found if r.tree == "t"), key=lambda r: r["rank"])][:2] == ["o", "e"]
    best = chat.format_trees(df, best=1).collect()
    assert sorted((str(r.tree), r.leaf) for r in best) == [("None", "n"), ("t", "o")]
    assert chat.format_trees(df.limit(0)).collect() == []


def test_long_chain(spark):
    rows = [(1, t, "assistant" if t % 2 else "user", f"turn {t} </s>") for t in range(300)]
    df = spark.createDataFrame(rows, "conv long, turn long, role string, text string")
    r = chat.format_trees(chat.chains(df, "conv", "turn", "role", "text")).withColumn("turns", chat.parsed(chat.F.col("formatted"))).first()
    assert [(t.role, t.text) for t in r.turns] == [(role, text) for _, _, role, text in rows]


# --- pipeline -----------------------------------------------------------------------------


def test_stages(spark, tmp_path):
    sf = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        after = stage(spark, docs, sf)
        assert after.columns == docs.columns, name
        after.write.parquet(f"{tmp_path}/{name}")
        before, docs = docs, spark.read.parquet(f"{tmp_path}/{name}")
        ids, kept = ({r.doc_id for r in d.select("doc_id").collect()} for d in (before, docs))
        assert kept <= ids and (name not in ("repeated_lines", "personal_data") or kept == ids)
        if name == "near_duplicates":
            rows = [tuple(r) for r in before.select("doc_id", "text").collect()]
            _, label = brute_components(rows, 5, 80)
            least = {}
            for (i, _), c in zip(rows, label):
                least[c] = min(i, least.get(c, i))
            assert kept == set(least.values())
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, sf).collect()
    assert {r.doc_id for r in packed} == {r.doc_id for r in docs.select("doc_id").collect()}
    whole = Q.QUERIES["pipeline"](spark, sf).collect()
    key = lambda r: (r.doc_id, r.start, r.length, r.ids_crc32)
    assert sorted(map(key, whole)) == sorted(map(key, packed))
