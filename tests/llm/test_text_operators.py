"""Secrets, personal data, line dedup, quality, packing and BPE against brute force."""

import base64
import bz2
import gzip
import lzma
import re
import urllib.parse
import zlib
from collections import defaultdict

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

import corpus_pipeline
from postlens.llm import bpe, packing, pii, quality, secret_scan, substring_dedup

TOKENIZER = corpus_pipeline.TOKENIZER
ODD = [
    (1, "password = hunter2secret"), (1, "password = hunter2secret"), (None, None), (2, ""), (3, None),
    (4, "mail a.b@example.com now"), (5, "x" * 200_000), (None, "Über +1 (499) 555-6503 é"),
]


@pytest.fixture
def odd(spark):
    """Null ids and texts, repeated rows, a very long text, and columns with names that operators use."""
    return spark.createDataFrame(
        [(i, t, "a", 1, [0]) for i, t in ODD], "doc_id long, text string, spans string, start int, ids array<int>"
    )


# --- secrets ---------------------------------------------------------------------


def base_secrets(text):
    found = []
    for m in re.finditer(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 6:
            found.append(("assign", *m.span()))
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    return set(found)


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from([
    "password", "Token", "api_key", "apikey", "=", ":", " ", "\"", "'", "abc", "deadbeef0123", "AKIA", "ABCD1234EFGH5678", "%41", "\\u0041", "ſecret", "é",
]), max_size=14).map("".join))
def test_secrets_of_the_text_itself(text):
    spans, closed = secret_scan.find(text)
    assert {s[:3] for s in spans if not s[3]} == base_secrets(text) and closed == 0


U = chr(92) + "u"  # what starts an escape


def b64(x: bytes) -> str:
    return base64.b64encode(x).decode()


@pytest.mark.parametrize(("text", "kind", "covered", "layers"), [
    ("q " + urllib.parse.quote("token = abcdefgh") + " r", "assign", "token%20%3D%20abcdefgh", "url"),
    (f"{U}0070assword=abcdefg", "assign", f"{U}0070assword=abcdefg", "unicode"),
    ("x &#65;KIAABCDEFGHIJKLMNOP", "access", "&#65;KIAABCDEFGHIJKLMNOP", "unicode"),
    ("k " + b64(b"api_key=abcdef123456"), "assign", b64(b"api_key=abcdef123456").rstrip("="), "base64"),
    ("k " + b64(gzip.compress(b"secret=zzzzzzzz", mtime=0)), "assign", b64(gzip.compress(b"secret=zzzzzzzz", mtime=0)), "base64>compressed"),
    ("k " + b64(zlib.compress(b64(b"secret=zzzzzzzz").encode())), "assign", b64(zlib.compress(b64(b"secret=zzzzzzzz").encode())), "base64>compressed>base64"),
    (urllib.parse.quote(urllib.parse.quote("token = abcdefgh")), "assign", urllib.parse.quote(urllib.parse.quote("token = abcdefgh")), "url>url"),
])
def test_secrets_in_layers(text, kind, covered, layers):
    spans, _ = secret_scan.find(text)
    hit = [s for s in spans if s[0] == kind and s[3] == layers]
    assert [text[s[1] : s[2]] for s in hit] == [covered]


def test_layers_end():
    text = "token=abcdefgh"
    for _ in range(12):
        text = b64(text.encode())
    assert len(secret_scan.find(text)[0]) == 1
    bomb = b64(gzip.compress(b"\0" * (secret_scan.LAYER_BYTES + 1)))
    assert secret_scan.find(bomb) == ([], 1)


@pytest.mark.parametrize("pack", [lambda x: x, lambda x: gzip.compress(x, mtime=0), lambda x: zlib.compress(b64(zlib.compress(x)).encode())])
def test_encoded_part_in_several_places(pack):
    part = b64(pack(b"password=hunter2secret"))
    text = f"{part} and {part}\n" * 500
    spans, closed = secret_scan.find(text)
    places = [m.start() for m in re.finditer(re.escape(part), text)]
    assert [s[1] for s in spans if s[0] == "assign"] == places and len(places) == 1000 and closed == 0


def wrapped(data: bytes, width: int, end: str = "\n") -> str:
    run = b64(data)
    return end.join(run[i : i + width] for i in range(0, len(run), width))


@pytest.mark.parametrize(("width", "end"), [(64, "\n"), (76, "\r\n"), (76, "\n> "), (61, "\n  ")])
def test_encoded_part_over_line_breaks(width, end):
    noise = np.random.default_rng(3).bytes(400).hex().encode().replace(b"a", b" ").replace(b"0", b"\n")
    for packed in (gzip.compress(noise + b" password=hunter2secret", mtime=0), bz2.compress(noise + b" password=hunter2secret")):
        part = wrapped(packed, width, end)
        text = f"AttachmentInBase64Follows\n{part}\n\nend"
        spans, closed = secret_scan.find(text)
        assert ("assign", text.index(part), text.index(part) + len(part.rstrip("=")), "base64>compressed") in spans and closed == 0
    plain = b"x" * 40 + b" password=hunter2secret " + b"y" * 40
    text = "see:\n" + wrapped(plain, width, end) + "\nend of it"
    spans, _ = secret_scan.find(text)
    assert any("".join(re.findall(r"[\w+/]+", text[a:b])) in b64(plain) and end in text[a:b] for k, a, b, _ in spans if k == "assign")


def test_all_streams_of_a_part():
    for pack in (lambda x: gzip.compress(x, mtime=0), bz2.compress, lzma.compress, zstandard.ZstdCompressor().compress, zlib.compress):
        text = b64(pack(b"nothing here") + pack(b"password=hunter2secret"))
        spans, closed = secret_scan.find(text)
        assert [s[0] for s in spans] == ["assign"] and closed == 0
    noise = np.random.default_rng(3).bytes(4000).hex().encode()
    cut = gzip.compress(b"password=hunter2secret " + noise.replace(b"1", b" "), mtime=0)[:-500]
    spans, closed = secret_scan.find(b64(cut))
    assert "assign" in [s[0] for s in spans] and closed == 1
    assert secret_scan.find(wrapped(cut, 76))[1] == 1


SAID = "password=hunter2secret"


@pytest.mark.parametrize("data", [
    SAID.encode("utf-16"), SAID.encode("utf-16-be"), f"\u0416\u0436\u0434 {SAID}\u0416".encode("utf-16-be"), f"\u0416\u0436\u0434 {SAID}\u0416".encode("utf-16-le"),
    f"é {SAID} é".encode("latin-1"), f"user\0{SAID}\0".encode(), b"\xff\x00\x01 " + f"é {SAID}".encode(), b"\x01" + SAID.encode("utf-16-le"),
])
def test_secrets_in_data_that_are_no_utf8(data):
    text = "see " + b64(data)
    spans, closed = secret_scan.find(text)
    value = SAID.encode("utf-16-le") if b"p\0" in data else SAID.encode()
    (start, end), *more = [s[1:3] for s in spans if s[0] == "assign"]
    assert not more and closed == 0
    at = base64.b64decode(text[4:]).find(b"p")
    assert start in (4 + at * 4 // 3, 4 + (at - 1) * 4 // 3) and abs(end - start - len(value) * 4 / 3) < 4
    spans, closed = secret_scan.find(b64(gzip.compress(data * 3)))
    assert [s[0] for s in spans] == ["assign"] and closed == 0


def test_secrets_in_large_layers(monkeypatch):
    monkeypatch.setattr(secret_scan, "LAYER_BYTES", 5000)
    monkeypatch.setattr(secret_scan, "PIECE", 100)
    monkeypatch.setattr(secret_scan, "WINDOW", 1000)
    monkeypatch.setattr(secret_scan, "OVERLAP", 200)
    for at in (10, 990, 4995, 5985, 8900):
        for said in (SAID, b64(SAID.encode())):
            data = b"\xe9" * at + b" " + said.encode() + b" " + b"\xe9" * (9000 - at)
            spans, closed = secret_scan.find(b64(zlib.compress(data)))
            assert [s[0] for s in spans] == ["assign"] and closed == 1


def test_secret_rows(odd):
    rows = secret_scan.scan_secrets(odd).collect()
    assert len(rows) == len(ODD) and sum(len(r.spans) for r in rows) == 2
    assert secret_scan.scan_secrets(odd.limit(0)).collect() == []


# --- personal data ---------------------------------------------------------------


def luhn_ok(digits):
    total = 0
    for i, c in enumerate(digits[::-1]):
        v = int(c) * (1 + i % 2)
        total += v - 9 if v > 9 else v
    return total % 10 == 0


def base_pii(text):
    digits = lambda t: re.sub("[^0-9]", "", t)
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    out += [("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(p) <= 255 for p in m[0].split("."))]
    out += [("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn_ok(digits(m[0]))]
    out += [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]
    return out


@settings(max_examples=500, deadline=None)
@given(st.one_of(*(st.text(alphabet=a, max_size=40) for a in ("a.@b-1", "0123. -4", "+1234567890 ().-", "25.0@+ -a٣", "4111 -"))))
def test_personal_data_of_base_kinds(text):
    assert [s for s in pii.find(text, pii.anchors()) if s[0] in pii.BASE_KINDS] == base_pii(text)


@pytest.mark.parametrize(("text", "kind", "covered"), [
    ("IBAN: DE89 3704 0044 0532 0130 00 ok", "iban", "DE89 3704 0044 0532 0130 00"),
    ("IBAN: DE88 3704 0044 0532 0130 00 ok", None, None),
    ("my account no. 1234567890 is", "account", "1234567890"),
    ("SSN 123-45-6789.", "ssn", "123-45-6789"), ("ssn 000-45-6789", None, None),
    ("ftp://joe:pw@host.org/x", "login", "joe:pw@host.org"),
    ("lives at 12 Old Mill Road now", "address", "12 Old Mill Road"),
    ("the broad street of towns and a railroad", None, None),
])
def test_announced_personal_data(text, kind, covered):
    found = [(k, text[a:b]) for k, a, b in pii.find(text, pii.anchors()) if k not in pii.BASE_KINDS]
    assert found == ([(kind, covered)] if kind else [])


@pytest.mark.parametrize(("text", "found"), [
    ("IBAN: DE89 3704 0044 0532 0130 00 BIC: COBADEFFXXX", ["iban:DE89 3704 0044 0532 0130 00"]),
    ("IBAN: DE89 3704 0044 0532 0130 00 USD 500", ["iban:DE89 3704 0044 0532 0130 00"]),
    ("IBAN: DE88 3704 0044 0532 0130 00 IBAN is DE89370400440532013000.", ["iban:DE89370400440532013000"]),
    ("IBAN: DE89 3704 0044 0532 0130 00X", []),
    ("Social security number: 123-45-6789", ["ssn:123-45-6789"]), ("Social Security No. 123-45-6789", ["ssn:123-45-6789"]),
    ("SSN is 123-45-6789, ssn=123-45-6780", ["ssn:123-45-6789", "ssn:123-45-6780"]),
    ("12 Old Mill Lane, 7 Park Place", ["address:12 Old Mill Lane", "address:7 Park Place"]),
    ("100 square feet, 5 place, lane 3, 12 Place, drive 2", []),
])
def test_announced_in_more_forms(text, found):
    assert [f"{k}:{text[a:b]}" for k, a, b in pii.find(text, pii.anchors())] == found


def test_masking(odd):
    rows = pii.mask_pii(odd)
    assert rows.columns == odd.columns
    texts = [r.text for r in rows.collect()]
    assert "mail [EMAIL] now" in texts and "Über [PHONE] é" in texts and texts.count(None) == 2 and "" in texts
    assert len(pii.find_pii(odd).collect()) == len(ODD) and pii.find_pii(odd.limit(0)).collect() == []


# --- line dedup --------------------------------------------------------------------

LONG = "one two three four five six seven eight nine"


def test_lines(spark):
    rows = [
        (3, f"a\n{LONG}\nb"), (1, f"{LONG.upper()}  \nshort"), (2, f"{LONG}\n{LONG} ten\n{LONG}"), (2, "short\nshort"),
        (None, f"c\n{LONG}"), (4, ""), (5, None), (6, f"only {LONG}\r\nonly {LONG}"),
    ]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, removed int")
    found = [(r.doc_id, r.text, [(s.start, s.end) for s in r.removed], r.owners) for r in substring_dedup.mark_repeats(docs).collect()]
    n = len(LONG)
    assert sorted(found, key=str) == sorted([
        (3, "a\nb", [(2, n + 3)], [1]), (1, f"{LONG.upper()}  \nshort", [], []), (2, f"{LONG} ten", [(0, n + 1), (2 * n + 6, 3 * n + 6)], [1]),
        (2, "short\nshort", [], [1]), (None, "c", [(2, n + 2)], [1]), (4, "", [], []), (5, None, [], []),
        (6, f"only {LONG}\r", [(n + 7, 2 * n + 12)], []),
    ], key=str)
    kept = substring_dedup.drop_repeats(docs)
    assert kept.columns == docs.columns and sorted((r.doc_id, r.text) for r in kept.where("doc_id is not null and text is not null").collect()) == sorted(
        (i, t) for i, t, _, _ in found if i is not None and t is not None
    )
    assert substring_dedup.mark_repeats(docs.limit(0)).collect() == []


def test_lines_of_rows_without_id(spark):
    """Each loses what a row with an id holds, and only that, whatever other rows without id lose."""
    other = LONG.replace("one", "eleven")
    rows = [(None, f"{LONG}\nx"), (None, f"{other}\ny"), (None, f"{LONG}\nx"), (None, f"{other} z\ny"), (None, f"{other} z\ny"), (1, LONG), (2, f"{other}\n{LONG}")]
    docs = spark.createDataFrame([(i, t, 0, 0) for i, t in rows], "doc_id long, text string, _digests int, ____digests int")
    expected = sorted([(None, "x"), (None, "y"), (None, "x"), (None, f"{other} z\ny"), (None, f"{other} z\ny"), (1, LONG), (2, other)], key=str)
    assert sorted(((r.doc_id, r.text) for r in substring_dedup.mark_repeats(docs).collect()), key=str) == expected
    assert sorted(((r.doc_id, r.text) for r in substring_dedup.drop_repeats(docs).collect()), key=str) == expected


def test_passages(spark):
    verse = [f"{a} {b} rose" for a in ("red", "white", "blue") for b in ("one", "two", "three", "four")]
    said = ["The first of them was seen here by nobody at all.", "Then came rain.", "A second one went along the river until it was dark."]
    plain = " ".join(f"w{i}" for i in range(400))
    rows = [
        (1, "title\n" + "\n".join(verse) + "\nend"), (2, "other\n\n" + "\n".join(verse).upper() + "\nlast"),
        (3, " ".join(said)), (4, "Before it. " + " ".join([said[0], said[1].replace("rain", "snow"), said[2]]) + " After it.\nNext."),
        (5, plain), (6, f"x y z {plain[:900]} changed {plain[900:]}"), (7, f"{said[0]} {said[1]}\n{said[0]} {said[1]}"), (8, "la la\n" * 20),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r.doc_id: r for r in substring_dedup.mark_repeats(docs, "passage").collect()}
    assert [found[i].text for i in (1, 3, 5)] == [rows[i - 1][1] for i in (1, 3, 5)]
    assert found[2].text == "other\n\nlast" and found[2].owners == [1]
    assert found[4].text == "Before it. Then came snow. After it.\nNext." and found[7].text == ""
    assert "changed" in found[6].text and len(found[6].text.split()) < 50
    assert found[8].text == "la la\n" * 4 and not found[8].owners
    for r in found.values():
        text = rows[r.doc_id - 1][1]
        left = "".join(text[a:b] for a, b in zip([0, *(s.end for s in r.removed)], [*(s.start for s in r.removed), len(text)]))
        assert left.removesuffix("\n") == r.text.removesuffix("\n")
    assert {r.doc_id: r.text for r in substring_dedup.drop_repeats(docs, "passage").collect()} == {i: r.text for i, r in found.items()}


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from(["a b c", "d e f g h", "i.", "one two three four five six seven eight nine.", "\n", "\n\n", " ", ". "]), max_size=30).map("".join))
def test_passages_hold_the_lines(text):
    """All that goes by whole lines goes by passages, and nothing goes that stands nowhere else."""
    lines = {d for _, _, d in substring_dedup.units(text, "line", 8) if d}
    if lines:
        held = substring_dedup.digests(text, "passage", 8)
        gone = substring_dedup.passages_gone(text, 8, held)
        for a, b, d in substring_dedup.units(text, "line", 8):
            assert d is None or any(x <= a and b <= y for x, y in gone)
    assert substring_dedup.cut(text, "passage", 8, set())[0].split() or not text.split()


# --- quality -------------------------------------------------------------------------


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    model = quality.train(docs, labels)
    import pyspark.sql.functions as F

    held = docs.join(labels, "doc_id").where(quality.fold(F.col("doc_id")) == quality.HELD_OUT)
    rows = held.select("quality", quality.score(F.col("text"), model).alias("s")).collect()
    right = sum((r.s >= 0.5) == (r.quality == 1) for r in rows)
    assert len(rows) > 100 and right / len(rows) > 0.95


def test_quality_of_odd_rows(spark, odd):
    import pyspark.sql.functions as F

    none = spark.createDataFrame([], "doc_id long, quality int")
    model = quality.train(odd, none)
    assert [r[0] for r in odd.select(quality.score(F.col("text"), model)).collect()] == [0.5] * len(ODD)
    assert quality.keep_good(odd, model).count() == len(ODD) and quality.keep_good(odd.limit(0), model).count() == 0


def test_risk_of_bad_texts_is_not_negative():
    rng = np.random.default_rng(0)
    good, bad = rng.normal(1, 1, (500, quality.N_MEASURES)), rng.normal(-1, 1, (500, quality.N_MEASURES))
    model = quality.fit(good[:200], np.vstack([good[200:], bad]), 0.375)
    assert (model.scores(good[200:]) > 0.5).mean() > 0.9 and (model.scores(bad) < 0.5).mean() > 0.9


# --- BPE and packing -----------------------------------------------------------------

LIB = Tokenizer.from_file(TOKENIZER)
ENCODER = bpe.loaded(open(TOKENIZER, encoding="utf-8").read())


@settings(max_examples=400, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=12), st.sampled_from([
    "the", " Ofİ ", "'S", "12", "<|endoftext|>", "<|startoftext|", "\x1c", "\x85", "ΟΔΟΣ", "é", "你好", "가", "½Ⅷ", "👍🏽", "Ⱥ",
])), max_size=8).map("".join))
def test_ids_and_text_as_the_library(text):
    ids = np.frombuffer(ENCODER.ids([text])[0], "<u4").tolist()
    assert ids == LIB.encode(text, add_special_tokens=False).ids
    assert ENCODER.bpe.decode(ids) == LIB.decode(ids, skip_special_tokens=False)


@pytest.mark.parametrize("word", ["a" * 5000, "thequickbrownfox" * 300, "ñ" * 700, "!?" * 400, "x" * 128, "x" * 129])
def test_long_words(word):
    assert np.frombuffer(ENCODER.ids([word])[0], "<u4").tolist() == LIB.encode(word, add_special_tokens=False).ids
    assert ENCODER.bpe.merge_short(ENCODER.bpe.merge_long([ENCODER.bpe.inner[b] for b in word.encode()])) is not None


def test_encoded_rows(odd):
    rows = bpe.decode(bpe.encode(odd, TOKENIZER), TOKENIZER).collect()
    assert sorted((str(r.doc_id), r.ids, r.decoded) for r in rows) == sorted(
        (str(i), (e := LIB.encode(t or "", add_special_tokens=False).ids), LIB.decode(e, skip_special_tokens=False)) for i, t in ODD
    )
    assert bpe.encode(odd.limit(0), TOKENIZER).collect() == []


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 500), max_size=30))
def test_patterns_hold_all_pieces(counts):
    packs = packing.patterns(counts, 64)
    placed = defaultdict(int)
    for number, parts in packs:
        assert sum(length * times for length, times in parts) <= 64
        for length, times in parts:
            placed[length] += number * times
    assert dict(placed) == counts
    assert len(packs) <= 2 * max(1, len(counts)) + 1


def test_packed_rows(odd):
    rows = packing.pack(odd, TOKENIZER, size=64).collect()
    sequences, documents = defaultdict(list), defaultdict(int)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
        documents[str(r.doc_id)] += r.length
    assert sorted(sequences) == list(range(len(sequences)))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 64
    expected = defaultdict(int)
    for i, t in ODD:
        expected[str(i)] += len(LIB.encode(t or "", add_special_tokens=False).ids) + 1
    assert documents == expected
    first = next(r for r in rows if r.doc_id == 4)
    ids = [*LIB.encode(ODD[5][1], add_special_tokens=False).ids, 2]
    assert first.ids_crc32 == zlib.crc32(np.array(ids, "<u4").tobytes()) and first.doc_tokens == len(ids)
    assert packing.pack(odd.limit(0), TOKENIZER).collect() == []
