"""Token alignment, repeated strings and spelling variants against brute force."""

import hashlib
import json
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from postlens.llm import pair_alignment, spelling, suffix_dedup
from postlens.llm import queries as Q
from postlens.llm.bpe import byte_letters

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def keyed(rows):
    return sorted((str(r[0]), *r[1:]) for r in rows)


def saved(spark, tmp_path, rows):
    """A folder with a table of documents that holds columns operators use inside as well."""
    docs = spark.createDataFrame([(i, t, 7, "x", [1]) for i, t in rows], "doc_id long, text string, n long, id string, found array<int>")
    docs.repartition(4).write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


# --- alignment ---------------------------------------------------------------------


def brute_alignment(rows):
    a_lib = Tokenizer.from_file(A)
    a_lib.encode_special_tokens = True
    b_lib = sentencepiece.SentencePieceProcessor(model_file=B)
    letters = {c: k for k, c in enumerate(byte_letters())}
    with open(A, encoding="utf-8") as f:
        entries = {i: t for t, i in json.load(f)["model"]["vocab"].items()}
    a_bytes = lambda i: bytes(letters[c] for c in entries[i])
    piece = b_lib.id_to_piece
    b_bytes = lambda i: bytes([int(piece(i)[3:5], 16)]) if b_lib.is_byte(i) else piece(i).replace("▁", " ").encode()
    found, count = [], Counter()
    for key, text in rows:
        groups = []
        if text:
            a, b = a_lib.encode(" " + text, add_special_tokens=False).ids, b_lib.encode(text)
            if b"".join(map(a_bytes, a)) == (" " + text).encode() == b"".join(map(b_bytes, b)):
                ends = [0, 0]
                group = [], []
                while a or b:
                    k = int(ends[0] > ends[1])
                    i = (b if k else a).pop(0)
                    group[k].append(i)
                    ends[k] += len((b_bytes if k else a_bytes)(i))
                    if ends[0] == ends[1]:
                        groups.append(group)
                        group = [], []
        links = [(x, y) for g in groups for x in g[0] for y in g[1]]
        count.update(set(links))
        found.append((key, groups, links))
    best = defaultdict(int)
    for (x, _), n in count.items():
        best[x] = max(best[x], n)
    return [
        (
            key, sum(len(g[0]) for g in groups), sum(len(g[1]) for g in groups), len(groups), len(links),
            sum(count[p] == best[p[0]] for p in links), sum(count[p] for p in links),
            ";".join(",".join(map(str, x)) + "|" + ",".join(map(str, y)) for x, y in groups),
        )
        for key, groups, links in found
    ], count


ODD_TEXTS = [
    "", None, " ", "  ", " a", " a  b", "a\nb c\n\n d", "x▁y", "a ▁ b", "<|endoftext|> <s> </s> <unk> <0x0A>", "\t a b 　 c",
    "été à l’école “q” 日本語 テスト", "it's don't I'll 's", "x" * 5000, "🙂 🙂🙂 é \x00 \x1c z", "1234567 12 3,4.5", "foo  bar   baz",
]


@pytest.fixture(scope="module")
def mixed_texts():
    rng = random.Random(4)
    made = ["".join(rng.choice(" ab.'\n\té’ 1▁" if k % 5 == 0 else " ab.'\n\té’ 1th") for _ in range(rng.randrange(1, 60))) for k in range(150)]
    texts = ODD_TEXTS + made
    return [(None if i % 11 == 0 else i % 160, t) for i, t in enumerate(texts)] + [(3, "a b"), (3, "a b"), (None, "a b")]


@pytest.mark.parametrize("broadcast", [pair_alignment.BROADCAST, 0])
def test_alignment(spark, mixed_texts, broadcast):
    docs = spark.createDataFrame([(i, t, 1) for i, t in mixed_texts], "doc_id long, text string, bucket int").repartition(3)
    found = pair_alignment.align(docs, A, B, broadcast=broadcast).collect()
    assert keyed(found) == keyed(brute_alignment(mixed_texts)[0])


@pytest.mark.parametrize("broadcast", [pair_alignment.BROADCAST, 0])
def test_texts_are_aligned_once(spark, mixed_texts, broadcast):
    read = spark.sparkContext.accumulator(0)

    def noted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    docs = spark.createDataFrame(mixed_texts, "doc_id long, text string").repartition(3).mapInArrow(noted, "doc_id long, text string")
    found = pair_alignment.align(docs, A, B, digest=True, broadcast=broadcast).collect()
    assert len(found) == len(mixed_texts) == read.value


def test_alignment_query(spark, tmp_path, mixed_texts):
    found = Q.op11_pair_alignment(spark, saved(spark, tmp_path, mixed_texts)).collect()
    expected = [(*r[:-1], hashlib.sha256(r[-1].encode()).hexdigest() if r[-1] else "") for r in brute_alignment(mixed_texts)[0]]
    assert keyed(found) == keyed(expected)


def test_link_counts(spark, mixed_texts):
    docs = spark.createDataFrame(mixed_texts, "doc_id long, text string").repartition(20)  # more parts than a level of the tree joins
    found = {(r["a"], r["b"]): r["n_docs"] for r in pair_alignment.link_counts(docs, A, B).collect()}
    assert found == dict(brute_alignment(mixed_texts)[1])


def test_alignment_of_nothing(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert pair_alignment.align(docs, A, B).collect() == [] and pair_alignment.link_counts(docs, A, B).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.sets(st.integers(0, 2**48), max_size=300), st.sets(st.integers(0, 2**48), max_size=50))
def test_perfect_hash(keys, others):
    sorted_keys = np.array(sorted(keys), "i8")
    rows = []
    for bucket in range(pair_alignment.BUCKETS):
        own = sorted_keys[pair_alignment.bucket_of(sorted_keys) == bucket]
        sizes, bits = pair_alignment.perfect_hash(own)
        packed = np.packbits(bits).tobytes()
        number = pair_alignment.PairTable([(bucket, sizes, packed, None, None)]).numbers(own)
        assert sorted(number) == list(range(len(own)))
        placed = own.copy()
        placed[number] = own
        rows.append((bucket, sizes, packed, placed.tobytes(), (placed + 1).tobytes()))
    table = pair_alignment.PairTable(rows)
    asked = np.array(sorted(keys | others), "i8")
    assert [int(x) for x in table.count(asked)] == [k + 1 if k in keys else 0 for k in asked.tolist()]


# --- repeated strings --------------------------------------------------------------


def brute_repeats(rows, length):
    data = [(t or "").encode() for _, t in rows]
    seen = Counter(b[i : i + length] for b in data for i in range(len(b) - length + 1))
    out = []
    for (key, _), b in zip(rows, data):
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = True
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype("i1"), [0]]))).tolist()
        out.append((key, len(b), list(zip(edges[::2], edges[1::2])), bytes(np.frombuffer(b, "u1")[~gone])))
    return out


def repeating(seed):
    rng = random.Random(seed)
    base = ["".join(rng.choice("abc é\0") for _ in range(60)) for _ in range(6)]
    noise = lambda: "".join(rng.choice("abcdefgh ") for _ in range(rng.randrange(30)))
    rows = []
    for i in range(120):
        part = rng.choice(base)[rng.randrange(30) : rng.randrange(30, 60)]
        rows.append((i, noise() + part + noise()))
    return rows + [
        (500, "x" * 3000), (501, None), (502, ""), (None, base[0]), (None, base[0]), (3, rows[3][1]), (504, "q" * 12), (505, "zq" * 700),
        (506, "\0" * 50), (507, base[1] * 9),
    ]


@pytest.mark.parametrize(("length", "gram", "shard"), [(12, 5, 300), (12, 12, 1 << 22), (8, 2, 100), (20, 8, 1000)])
def test_repeats(spark, length, gram, shard):
    """Shards of few bytes, so that anchors are dealt to several and compared across them."""
    rows = repeating(length + gram)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    found = [(r[0], r[1], [tuple(s) for s in r[2]], bytes(r[3])) for r in suffix_dedup.remove_repeats(docs, length, gram, shard).collect()]
    assert keyed(found) == keyed(brute_repeats(rows, length))


def test_repeats_query(spark, tmp_path):
    rng = random.Random(2)
    make = lambda n: " ".join(rng.choice(["alpha", "béta", "gamma", "delta"]) + str(rng.randrange(99)) for _ in range(n))
    shared = [make(90), make(200)]
    rows = [(i, make(rng.randrange(1, 150)) + rng.choice(shared)[rng.randrange(90) :] + make(rng.randrange(1, 80))) for i in range(60)]
    rows += [(100, shared[0]), (101, shared[0]), (101, shared[0]), (None, shared[1]), (102, None), (103, ""), (104, make(40_000)), (105, "w " * 900)]
    found = Q.op12_suffix_dedup(spark, saved(spark, tmp_path, rows)).collect()
    expected = [
        (key, n, sum(b - a for a, b in spans), len(spans), hashlib.sha256(kept).hexdigest()) for key, n, spans, kept in brute_repeats(rows, 400)
    ]
    assert keyed(found) == keyed(expected)


def test_no_text_repeats(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove_repeats(docs).collect() == []
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    assert {r["doc_id"]: r["n_bytes"] for r in suffix_dedup.remove_repeats(docs).collect()} == {1: 1, 2: 0}


@settings(max_examples=150, deadline=None)
@given(st.text("ab\0", max_size=200), st.integers(1, 40))
def test_suffix_array(text, length):
    data = np.frombuffer(text.encode(), "u1")
    if not len(data):
        return
    order, eight = suffix_dedup.suffix_array(data)
    padded = text.encode() + bytes(len(data) + length)
    assert order.tolist() == sorted(range(len(data)), key=lambda i: (padded[i : i + len(data) + 8], -i))
    common = suffix_dedup.shared_prefixes(order, eight, np.array([0]), np.array([len(data)]), length)
    for k, (i, j) in enumerate(zip(order, order[1:])):
        n = next((x for x in range(length) if padded[i + x] != padded[j + x]), length)
        assert common[k + 1] == n


# --- spelling ----------------------------------------------------------------------


def one_apart(v, w):
    if len(v) == len(w):
        return sum(a != b for a, b in zip(v, w)) == 1
    v, w = sorted((v, w), key=len)
    return len(w) == len(v) + 1 and any(w[:k] + w[k + 1 :] == v for k in range(len(w)))


def brute_variants(rows, min_chars, min_count, every, ratio):
    n = Counter()
    for key, text in rows:
        for run in spelling.RUN.findall(text or ""):
            run = "".join(c.lower() if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            word = run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]
            n[word] += len(word) >= min_chars
    n = {w: c for w, c in n.items() if c >= min_count}
    near = {w: [v for v in n if one_apart(v, w)] for w in n}
    form = {}
    for w in n:
        best = min(near[w], key=lambda v: (-n[v], v), default=None)
        form[w] = best if best and n[best] >= ratio * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near[w]), n.get(form[w])))
    return out


def typed(seed):
    rng = random.Random(seed)
    words = ["".join(rng.choice("abÀé") for _ in range(rng.randrange(5, 9))) for _ in range(60)] + ["Straße" * 3, "ab" * 40, "y" * 3000, "y" * 2999]
    pick = lambda: words[min(int(rng.expovariate(0.12)), len(words) - 1)]
    rows = [(i, " ".join(pick() for _ in range(40)) + rng.choice(["!", " 3x ", "-"]) + pick().upper()) for i in range(90)]
    return rows + [(None, rows[0][1]), (None, rows[0][1]), (4, rows[4][1]), (300, None), (301, ""), (302, "123 ... _"), (303, "ab" * 40), (304, ("y" * 3000 + " ") * 9)]


@pytest.mark.parametrize(("chars", "every", "ratio"), [(6, 7, 2), (5, 3, 5), (6, 199, 1)])
def test_variants(spark, monkeypatch, chars, every, ratio):
    monkeypatch.setattr(spelling, "CELL_CHARS", 40)  # cells of several blocks
    rows = typed(chars + every)
    docs = spark.createDataFrame([(i, t, "x", 2) for i, t in rows], "doc_id long, text string, word string, n int").repartition(3)
    found = spelling.variants(docs, chars, 3, every, ratio).collect()
    assert keyed(found) == keyed(brute_variants(rows, chars, 3, every, ratio))


def test_variants_query(spark, tmp_path):
    rows = typed(1)
    found = Q.op13_spelling(spark, saved(spark, tmp_path, rows)).collect()
    assert keyed(found) == keyed(brute_variants(rows, 6, 5, 199, 5)) and any(r["n_near"] for r in found)


def test_no_words(spark):
    assert spelling.variants(spark.createDataFrame([], "doc_id long, text string")).collect() == []
