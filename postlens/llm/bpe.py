"""Byte-pair encoding and decoding with a contiguous array of ranks.

A word is held as a short array of parts and a second array with the rank of
each adjacent pair. The smallest rank is looked for, the boundary under it is
deleted, and the ranks of the two neighbours are refreshed, until no pair has a
rank. A word of more than ``LONG`` parts is merged with a heap and linked parts
instead, in the same order, so that a text without white space takes
n log n steps. The new words of a batch are merged side by side: their arrays are
the rows of a matrix.

The vocabulary is a ``tokenizers`` file of a BPE with word ends, whose words
hold no white space. Ids equal those of that library, with its own normaliser
and word pattern; what is in the file's list of added tokens is never split.

Defined results: a null or empty text has no ids; ids decode to the strings of
their tokens joined by one space, as the library does for a file without a
decoder. Repeated rows, null ids and further columns are no special case: a row
in is a row out.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
from array import array
from itertools import filterfalse

import numpy as np
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.common import map_columns

LONG = 128
CACHED = 300_000  # words that a Python worker remembers at least, once it has met so many
BLOCK = 4096  # words merged side by side
NONE = 1 << 30
SLOT_BITS = 18  # slots of the hash table of pairs: over five for each pair
# Python splits at these, the vocabulary's pattern does not.
SEPARATORS = re.compile("[\x1c-\x1f]")
BLANKS = re.compile("(?:(?![\x1c-\x1f])\\s)+")
# Below this a character is its own normal form, and class and case are the same in all versions of Unicode.
STABLE_END = 0x250
UNSTABLE = re.compile(f"[^\0-{chr(STABLE_END - 1)}]")
SPACES = "\t\n\v\f\r \x85\xa0"  # all white space below it


class Bpe:
    """Encoder and decoder of one vocabulary; ``source`` is the content of its file."""

    def __init__(self, source: str):
        from tokenizers import Tokenizer

        spec, lib = json.loads(source), Tokenizer.from_str(source)
        model = spec["model"]
        vocab, end = model["vocab"], model["end_of_word_suffix"]
        self.normalizer, self.splitter = lib.normalizer, lib.pre_tokenizer
        self.ranks, self.merged = {}, []
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[vocab[a], vocab[b]] = rank
            self.merged.append(vocab[a + b])
        self.table = PairTable(self.ranks)
        self.merged_array = np.array(self.merged, "i4")
        letters = byte_letters()
        self.inner = [vocab[c] for c in letters]
        self.last = [vocab[c + end] for c in letters]
        self.byte_of = {c: b for b, c in enumerate(letters)}
        self.tokens = {i: t for t, i in vocab.items()}
        self.added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.tokens.update((i, t) for t, i in self.added.items())
        self.added_pattern = re.compile("(" + "|".join(map(re.escape, self.added)) + ")") if self.added else None
        self.stable_words = re.compile(stable_pattern(spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]))
        self.inner_array, self.last_array = np.array(self.inner, "i4"), np.array(self.last, "i4")

    # --- one word --------------------------------------------------------------

    def word(self, data: bytes) -> list[int]:
        """Ids of one word, given as UTF-8."""
        parts = [self.inner[b] for b in data]
        parts[-1] = self.last[data[-1]]
        return self.merge_short(parts) if len(parts) <= LONG else self.merge_long(parts)

    def words(self, many: list[bytes]) -> list[bytes]:
        """The ids of many words, as bytes."""
        out: list[bytes] = [b""] * len(many)
        order = sorted(range(len(many)), key=lambda i: len(many[i]))
        short = [i for i in order if len(many[i]) <= LONG]
        for at in range(0, len(short), BLOCK):
            block = short[at : at + BLOCK]
            for i, ids in zip(block, self.merge_block([many[i] for i in block])):
                out[i] = ids
        for i in order[len(short) :]:
            out[i] = array("I", self.word(many[i])).tobytes()
        return out

    def merge_block(self, many: list[bytes]) -> list[bytes]:
        """As ``merge_short`` does, one row of a matrix for each word."""
        sizes = np.array([len(w) for w in many])
        letters = np.frombuffer(b"".join(many), "u1")
        inside = np.arange(sizes.max()) < sizes[:, None]
        parts = np.zeros(inside.shape, "i4")
        parts[inside] = self.inner_array[letters]
        parts[np.arange(len(many)), sizes - 1] = self.last_array[letters[np.cumsum(sizes) - 1]]
        ranks = np.full((len(many), inside.shape[1]), NONE, "i4")  # one column more than pairs: never empty
        ranks[:, :-1][inside[:, 1:]] = self.table.ranks(parts[:, :-1][inside[:, 1:]], parts[:, 1:][inside[:, 1:]])
        rows, done = np.arange(len(many)), [b""] * len(many)
        while len(rows):
            i = ranks.argmin(axis=1)
            least = ranks[np.arange(len(rows)), i]
            for k in np.flatnonzero(least == NONE):
                done[rows[k]] = parts[k, : sizes[k]].tobytes()
            more = least < NONE
            if not more.all():
                rows, parts, ranks, sizes, i, least = rows[more], parts[more], ranks[more], sizes[more], i[more], least[more]
            if not len(rows):
                break
            n, at = np.arange(len(rows)), i[:, None]
            parts[n, i] = self.merged_array[least]
            columns = np.arange(parts.shape[1] - 1)
            parts = np.take_along_axis(parts, columns + (columns > at), 1)  # without boundary i + 1
            ranks = np.take_along_axis(ranks, columns + (columns >= at), 1)
            sizes = sizes - 1
            left, right = i > 0, i + 1 < sizes
            ranks[n[left], i[left] - 1] = self.table.ranks(parts[n[left], i[left] - 1], parts[n[left], i[left]])
            ranks[n[right], i[right]] = self.table.ranks(parts[n[right], i[right]], parts[n[right], i[right] + 1])
            ranks[n[~right], i[~right]] = NONE
        return done

    def merge_short(self, parts: list[int]) -> list[int]:
        rank_of, merged = self.ranks.get, self.merged
        ranks = [rank_of(pair, NONE) for pair in zip(parts, parts[1:])]
        while ranks:
            least = min(ranks)
            if least == NONE:
                break
            i = ranks.index(least)
            parts[i] = merged[least]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank_of((parts[i - 1], parts[i]), NONE)
            if i < len(ranks):
                ranks[i] = rank_of((parts[i], parts[i + 1]), NONE)
        return parts

    def merge_long(self, parts: list[int]) -> list[int]:
        n, rank_of = len(parts), self.ranks.get
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        heap = [(r, i, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank_of((parts[i], parts[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            rank, i, a, b = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue  # one of the two has been merged meanwhile
            parts[i], parts[j] = self.merged[rank], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for left, right in ((before[i], i), (i, after[i])):
                if left >= 0 and right < n and (r := rank_of((parts[left], parts[right]))) is not None:
                    heapq.heappush(heap, (r, left, parts[left], parts[right]))
        return [p for p in parts if p >= 0]

    # --- texts -----------------------------------------------------------------

    def split(self, text: str) -> list[str | int]:
        """The words of a text in normal form, and the ids of added tokens between them."""
        if self.added_pattern and "<|" in text:
            out: list[str | int] = []
            for i, part in enumerate(self.added_pattern.split(text)):
                if i % 2:
                    out.append(self.added[part])
                elif part:
                    out.extend(self.plain(part))
            return out
        return self.plain(text)

    def plain(self, text: str) -> list[str]:
        if not UNSTABLE.search(text):
            return self.stable_words.findall(text.lower())
        out: list[str] = []
        for piece in self.pieces(text):
            if UNSTABLE.search(piece):
                byte_of = self.byte_of
                for w, _ in self.splitter.pre_tokenize_str(self.normalizer.normalize_str(piece)):
                    out.append(bytes([byte_of[c] for c in w]).decode())
            else:
                out.extend(self.stable_words.findall(piece.lower()))
        return out

    def pieces(self, text: str) -> list[str]:
        """The text cut at white space, where no word goes across."""
        if SEPARATORS.search(text):
            return [p for p in BLANKS.split(text) if p]
        return text.split()

    def decode(self, ids) -> str:
        return " ".join(map(self.tokens.__getitem__, ids))


def stable_pattern(words: str) -> str:
    """The word pattern for lower-case text of stable characters, for ``re``, which is faster but lacks classes."""
    found = {c for i in range(STABLE_END) for c in chr(i).lower()}
    for name in ("L", "N"):
        members = "".join(map(re.escape, sorted(c for c in found if regex.match(rf"\p{{{name}}}", c))))
        words = words.replace(f"[\\p{{{name}}}]", f"[{members}]").replace(f"\\p{{{name}}}", members)
    return words.replace("\\s", re.escape(SPACES))


def byte_letters() -> list[str]:
    """The visible letter that byte-level vocabularies write for each byte."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    names = {b: chr(b) for b in shown} | {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(256)]


class PairTable:
    """Ranks of pairs of ids, looked up for whole arrays: one slot for each hash, a sorted list where pairs share one."""

    FACTORS = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)

    def __init__(self, ranks: dict[tuple[int, int], int]):
        pairs = np.array(list(ranks), "i8").reshape(-1, 2)
        keys, values = pairs[:, 0] << 32 | pairs[:, 1], np.array(list(ranks.values()), "i4")
        order = np.argsort(keys)
        self.sorted_keys, self.sorted_ranks = keys[order], values[order]
        slots = self.slots(pairs[:, 0], pairs[:, 1])
        self.keys, self.values = np.full(1 << SLOT_BITS, -1, "i8"), np.full(1 << SLOT_BITS, NONE, "i4")
        self.keys[slots], self.values[slots] = keys, values
        self.shared = np.bincount(slots, minlength=1 << SLOT_BITS) > 1

    def slots(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        mixed = a.astype("u8") * self.FACTORS[0] + b.astype("u8") * self.FACTORS[1]
        return (mixed >> np.uint64(64 - SLOT_BITS)).astype("i8")

    def ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slots, keys = self.slots(a, b), a.astype("i8") << 32 | b
        out = np.where(self.keys[slots] == keys, self.values[slots], np.int32(NONE))
        if len(other := np.flatnonzero(self.shared[slots])):
            at = np.minimum(np.searchsorted(self.sorted_keys, keys[other]), len(self.sorted_keys) - 1)
            out[other] = np.where(self.sorted_keys[at] == keys[other], self.sorted_ranks[at], np.int32(NONE))
        return out


class Recent:
    """Results of the last keys met; ``CACHED`` to twice as many, the older half goes as a whole."""

    def __init__(self):
        self.now: dict = {}
        self.old: dict = {}

    def missing(self, keys) -> set:
        """Those of ``keys`` that must be worked out; the others are in ``now`` afterwards."""
        new = set(filterfalse(self.now.__contains__, keys))
        for k in new & self.old.keys():
            self.now[k] = self.old[k]
            new.discard(k)
        return new

    def turn(self) -> None:
        if len(self.now) > CACHED:
            self.old, self.now = self.now, {}


class Encoder:
    """The ids of texts; remembers those of the words met so far in this Python worker."""

    def __init__(self, bpe: Bpe):
        self.bpe, self.memory = bpe, Recent()

    def ids(self, texts: list[str | None]) -> list[bytes]:
        """Ids of each text, 4 bytes each, little-endian (as the machines are that Spark runs on)."""
        self.memory.turn()
        words = [self.bpe.split(t) if t else [] for t in texts]
        known = self.memory.now
        found = [list(map(known.get, ws)) for ws in words]
        holes = [(ws, f) for ws, f in zip(words, found) if None in f]
        new = list(self.memory.missing({w for ws, f in holes for w, ids in zip(ws, f) if ids is None}))
        texts_new = [w for w in new if isinstance(w, str)]
        known.update(zip(texts_new, self.bpe.words([w.encode() for w in texts_new])))
        known.update((w, w.to_bytes(4, "little")) for w in new if isinstance(w, int))
        for ws, f in holes:
            f[:] = [known[w] if ids is None else ids for w, ids in zip(ws, f)]
        for w in texts_new:
            if len(w) > LONG:
                del known[w]
        return list(map(b"".join, found))


_LOADED: dict[str, Encoder] = {}


def loaded(source: str) -> Encoder:
    """One encoder for all tasks of a Python worker."""
    key = hashlib.sha256(source.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED.clear()
        _LOADED[key] = Encoder(Bpe(source))
    return _LOADED[key]


def vocabulary(spark: SparkSession, path: str):
    """The content of a vocabulary file (under 2 MB) as a broadcast, so that only the driver needs the file."""
    with open(path, encoding="utf-8") as f:
        return spark.sparkContext.broadcast(f.read())


def encode(df: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, ids array<int>)`` for every row of ``df``."""
    source = vocabulary(df.sparkSession, path)

    def start():
        encoder = loaded(source.value)
        return lambda keys, texts: (keys, [np.frombuffer(ids, "<i4") for ids in encoder.ids(texts)])

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df.select(id_col, text_col), start, f"`{id_col}` {kind}, ids array<int>")


def decode(df: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """``df``'s ids and ``decoded``, the text they stand for."""
    source = vocabulary(df.sparkSession, path)

    def start():
        bpe = loaded(source.value).bpe
        return lambda keys, ids: (keys, ids, [bpe.decode(i or ()) for i in ids])

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df.select(id_col, ids_col), start, f"`{id_col}` {kind}, `{ids_col}` array<int>, decoded string")


def ids_digest(ids: Column) -> Column:
    """Lowercase hex SHA-256 of the decimal ids joined by one space."""
    return F.sha2(F.array_join(ids.cast("array<string>"), " "), 256)
