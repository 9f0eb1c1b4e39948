"""Which tokens of two vocabularies stand for the same bytes, counted over a corpus.

Each text is encoded by a byte-level BPE (A) and a sentencepiece model (B). Where
a token of A and one of B end at the same byte a group ends; every A token of a
group is linked with every B token of it. The count of a pair of ids is how many
documents hold it linked.

Counting. A task sums what its documents hold and hands on sorted pairs with
their numbers, cut into ``BUCKETS`` by hash. The distinct pairs of a bucket,
united level by level ``FAN`` lists at a time, get a minimal perfect hash: each
level is a bit array in which a pair that hashes to a place alone sets the
bit, the rest go on to the next level; a pair's number is the rank of its bit. The
tasks' numbers become dense vectors indexed by that hash, which are summed as
a tree, ``FAN`` at a time. A bucket holds a fixed share of the pairs two
vocabularies can form, whatever the corpus.

Looking up. The first pass stores what the second needs of every document: its
numbers, its groups, and its links as numbers of pieces and of pairs, each piece
and pair once for a block of texts. So texts are encoded and aligned only once. If
the table (keys, counts, bits) is ``BROADCAST`` pairs at most, every task of the
second pass gets it; otherwise the tasks send the pairs of their documents to the
buckets and sums come back. A number found by hash counts only if the key stored
there is the one asked for.

Words are encoded and aligned once for many places: a text is cut at single spaces
between characters that no token of either vocabulary goes across, so a group ends
at every cut, and what a text holds is what its pieces hold.

Defined results: texts that are null, empty, or that a vocabulary does not give
back byte by byte have no tokens: zeros and an empty list of groups. Repeated rows
are documents of their own, with or without ids. Extra columns are not read. An
empty table gives no rows.
"""

from __future__ import annotations

import gc
import hashlib
import io
import json
import os
import re
import uuid
from collections.abc import Iterator
from functools import cached_property
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postlens.llm.bpe import byte_letters
from postlens.llm.common import Scratch, stored

BUCKETS = 128
FAN = 16
HELD = 1 << 21  # pairs that a task holds before it hands them on
BROADCAST = 1 << 22  # pairs of a table that is sent to every task, 26 bytes each there
BLOCK = 1 << 20  # characters of texts that are aligned together, if a text is no longer
GAMMA = 2  # bits of a level for each pair that is left
LONG = 64  # characters of a piece that is not remembered
REMEMBERED = 120_000  # pieces after which those before are let go, unless they come again
# A single space between these is a border of tokens: a token of A that holds it starts with it, as does one of B.
SOLID = "!-~À-ɏ"
BORDER = re.compile(f"(?<=[{SOLID}]) (?=[{SOLID}])")
SOLIDS = frozenset(map(chr, [*range(0x21, 0x7F), *range(0xC0, 0x250)]))
# Fixed value: how byte-level vocabularies split a text. For characters below U+0250 all versions of Unicode agree on it.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
UNSTABLE = re.compile("[^\0-\u024f]|[\x1c-\x1f\x85]")


# --- alignment ---------------------------------------------------------------------


# What a piece of a text holds: tokens of A and of B, groups, links; the groups written out, if an aligner is asked for
# them, of each link the pair in 8 bytes; whether there may be borders at its ends, and whether both vocabularies give it back.
Piece = tuple[int, int, int, int, str, bytes, bool, bool]


def solid(piece: str) -> bool:
    return piece != "" and piece[0] in SOLIDS and piece[-1] in SOLIDS


class Aligner:
    """Two vocabularies, given as the contents of their files. ``written``: groups are written out."""

    def __init__(self, a_source: str, b_source: bytes, written: bool = True):
        import sentencepiece

        self.a_source, self.b = a_source, sentencepiece.SentencePieceProcessor(model_proto=b_source)
        self.writes = written
        spec = json.loads(a_source)
        byte_of = {c: k for k, c in enumerate(byte_letters())}
        self.a_bytes = [b""] * (1 + max([*spec["model"]["vocab"].values(), *(t["id"] for t in spec["added_tokens"])]))
        for token, i in spec["model"]["vocab"].items():
            self.a_bytes[i] = bytes(byte_of[c] for c in token)
        pieces = range(self.b.vocab_size())
        self.b_bytes = [
            bytes([int(self.b.id_to_piece(i)[1:-1], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
            for i in pieces
        ]
        self.a_size, self.b_size = (np.array([len(t) for t in x]) for x in (self.a_bytes, self.b_bytes))
        # What is written for a token: A's before another of A or before B's, B's before another of B or a group.
        self.written = [str(i) + end for x, ends in ((self.a_bytes, ",|"), (self.b_bytes, ",;")) for end in ends for i in range(len(x))]
        # Borders hold for a split of A as byte-level vocabularies make it, and if no piece of B goes on after a space.
        split = spec["pre_tokenizer"] or {}
        byte_level = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not spec["normalizer"]
        self.cuts = byte_level and not any("▁" in self.b.id_to_piece(i).lstrip("▁") for i in pieces)
        self.fast = same_by_ranks(spec["model"], self.a_bytes) if byte_level else None
        self.now: dict[str, Piece] = {}
        self.old: dict[str, Piece] = {}

    @cached_property
    def a(self):
        """The library's own encoder; most texts do without it."""
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        found = Tokenizer.from_str(self.a_source)
        found.encode_special_tokens = True
        return found

    def encode_a(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of A of all pieces with a space before them, and how many each has."""
        spaced = [" " + p for p in pieces]
        if self.fast and self.cuts and all(map(solid, pieces)) and not UNSTABLE.search(joined := "".join(spaced)):
            # Borders hold between any two of them, so they can be read as one text.
            ids = np.array(self.fast.encode_ordinary(joined), "i4")
            ends = np.searchsorted(np.cumsum(self.a_size[ids]), np.cumsum([len(p.encode()) for p in spaced]), "right")
            return ids, np.diff(ends, prepend=0)
        if self.fast:
            found = [self.a.encode(p, add_special_tokens=False).ids if UNSTABLE.search(p) else self.fast.encode_ordinary(p) for p in spaced]
        else:
            found = [e.ids for e in self.a.encode_batch(spaced, add_special_tokens=False)]
        return np.fromiter(chain.from_iterable(found), "i4"), np.fromiter(map(len, found), "i8", len(found))

    def learn(self, pieces: list[str]) -> list[Piece]:
        """What each piece with a space before it holds."""
        if not pieces:
            return []
        b_ids = self.b.encode(pieces, num_threads=1)
        a, n_a = self.encode_a(pieces)
        b, n_b = np.fromiter(chain.from_iterable(b_ids), "i4"), np.fromiter(map(len, b_ids), "i8", len(b_ids))
        data = (" " + " ".join(pieces)).encode()
        size = np.array([1 + len(p.encode()) for p in pieces])
        of = np.arange(len(pieces))
        given = all(
            (np.bincount(np.repeat(of, n), sizes[ids], len(of)) == size).all() and b"".join(map(held.__getitem__, ids.tolist())) == data
            for sizes, held, ids, n in ((self.a_size, self.a_bytes, a, n_a), (self.b_size, self.b_bytes, b, n_b))
        )
        if not given:
            if len(pieces) > 1:  # one of them, at least: look at each half
                half = len(pieces) // 2
                return self.learn(pieces[:half]) + self.learn(pieces[half:])
            return [(0, 0, 0, 0, "", b"", solid(pieces[0]), False)]
        found = Aligned(self, a, b, n_a, n_b)
        numbers = [n.tolist() for n in (n_a, n_b, found.n_groups, found.n_links)]
        ends, data = (8 * np.cumsum(found.n_links)).tolist(), found.pair.tobytes()
        pairs = [data[x:y] for x, y in zip([0, *ends], ends)]
        return list(zip(*numbers, found.groups() if self.writes else repeat(""), pairs, map(solid, pieces), repeat(True)))

    def read(self, texts: list[str | None]) -> Block:
        # The many small tuples here hold no cycles; looking for some takes a third of the time.
        collects = gc.isenabled()
        gc.disable()
        try:
            return self._read(texts)
        finally:
            if collects:
                gc.enable()

    def _read(self, texts: list[str | None]) -> Block:
        if len(self.now) > REMEMBERED:
            self.old, self.now = self.now, {}
        cut = [(t.split(" ") if self.cuts else [t]) if t else [] for t in texts]
        distinct = dict.fromkeys(chain.from_iterable(cut))
        found = self.known(distinct)
        if self.cuts and (odd := {p for p, f in zip(distinct, found) if not (f[6] if f else solid(p))}):
            cut = [c if odd.isdisjoint(c) else BORDER.split(t) for c, t in zip(cut, texts)]
            distinct = dict.fromkeys(chain.from_iterable(cut))
            found = self.known(distinct)
        if new := [p for p, f in zip(distinct, found) if f is None]:
            if UNSTABLE.search(" ".join(new)) or not all(map(solid, new)):
                plain = [p for p in new if solid(p) and not UNSTABLE.search(p)]
                kept = set(plain)
                parts = plain, [p for p in new if p not in kept]
            else:
                parts = (new,)
            learnt = {p: piece for some in parts for p, piece in zip(some, self.learn(some))}
            found = [f or learnt[p] for p, f in zip(distinct, found)]
            self.now.update(learnt if max(map(len, new)) <= LONG else {p: f for p, f in learnt.items() if len(p) <= LONG})
        numbers = dict(zip(distinct, range(len(distinct))))
        sizes = [len(c) for c in cut]
        flat = np.fromiter(map(numbers.__getitem__, chain.from_iterable(cut)), "i8", sum(sizes))
        return Block(found, flat, np.array(sizes, "i8"))

    def known(self, pieces) -> list[Piece | None]:
        found = list(map(self.now.get, pieces))
        if self.old:
            old = self.old.get
            for k, (p, f) in enumerate(zip(pieces, found)):
                if f is None and (f := old(p)) is not None:
                    found[k] = self.now[p] = f
        return found


def same_by_ranks(model: dict, a_bytes: list[bytes]):
    """An encoder that merges by id, which is much faster, if ids are in the order of the merges; else None."""
    import tiktoken

    ids = sorted(model["vocab"].values())
    pairs = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
    plain = [a_bytes[i] for i in ids if a_bytes[i]]
    in_order = [model["vocab"].get(a + b) for a, b in pairs] == list(range(256, 256 + len(pairs)))
    if not in_order or sorted(a_bytes[:256]) != [bytes([k]) for k in range(256)]:
        return None
    ranks = {a_bytes[i]: i for i in range(256 + len(pairs))}
    return tiktoken.Encoding("ranks", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}) if plain else None


class Aligned:
    """The groups and links of some pieces, as flat arrays."""

    def __init__(self, aligner: Aligner, a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray):
        self.aligner, self.a, self.b, self.n_a, self.n_b, n = aligner, a, b, n_a, n_b, len(n_a)
        ends_a, ends_b = np.cumsum(aligner.a_size[a]), np.cumsum(aligner.b_size[b])
        self.last_a = ends_b[np.searchsorted(ends_b, ends_a)] == ends_a if len(a) else np.zeros(0, bool)
        self.last_b = ends_a[np.searchsorted(ends_a, ends_b)] == ends_b if len(b) else np.zeros(0, bool)
        self.group_a, self.group_b = np.cumsum(self.last_a) - self.last_a, np.cumsum(self.last_b) - self.last_b
        of_a = np.repeat(np.arange(n), n_a)
        self.n_groups = np.bincount(of_a[self.last_a], minlength=n)
        in_b = np.bincount(self.group_b, minlength=self.n_groups.sum())
        self.in_a, self.in_b = np.bincount(self.group_a, minlength=len(in_b)), in_b
        times = in_b[self.group_a]  # links of each A token
        self.n_links = np.bincount(of_a, times, n).astype("i8")
        link = np.repeat(np.arange(len(a)), times)
        at = np.arange(len(link)) - np.repeat(np.cumsum(times) - times, times)
        b_of = (np.cumsum(in_b) - in_b)[self.group_a[link]] + at
        self.pair = a[link].astype("i8") << 32 | b[b_of]

    def groups(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` for each piece."""
        x, y = len(self.aligner.a_bytes), len(self.aligner.b_bytes)
        code = np.empty(len(self.a) + len(self.b), "i8")
        code[np.arange(len(self.a)) + (np.cumsum(self.in_b) - self.in_b)[self.group_a]] = self.a + x * self.last_a
        code[np.arange(len(self.b)) + np.cumsum(self.in_a)[self.group_b]] = 2 * x + self.b + y * self.last_b
        words = list(map(self.aligner.written.__getitem__, code.tolist()))
        ends = np.cumsum(self.n_a + self.n_b).tolist()
        return ["".join(words[a:b])[:-1] for a, b in zip([0, *ends], ends)]


class Links:
    """Which pairs some texts hold: texts as the numbers of their pieces, pieces as the numbers of their links' pairs."""

    def __init__(self, sizes: np.ndarray, piece: np.ndarray, links: np.ndarray, pairs: np.ndarray, of: np.ndarray):
        self.n, self.sizes, self.piece, self.links, self.pairs, self.of = len(sizes), sizes, piece, links, pairs, of
        self.doc, self.at = np.repeat(np.arange(self.n), sizes), np.cumsum(links) - links

    def summed(self, values: np.ndarray) -> np.ndarray:
        """For each text the sum of its pieces' values; exact up to 2^53."""
        return np.bincount(self.doc, values[self.piece], self.n).astype("i8") if len(self.piece) else np.zeros(self.n, "i8")

    def linked(self, values: np.ndarray) -> np.ndarray:
        """For each text the sum of the values of its links' pairs."""
        return self.summed(np.bincount(np.repeat(np.arange(len(self.links)), self.links), values[self.of], len(self.links)))

    def distinct(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """For each document and pair in it: the document, the pair's number, its links."""
        held, often = np.unique(self.doc * max(1, len(self.links)) + self.piece, return_counts=True)
        doc, piece = held // max(1, len(self.links)), held % max(1, len(self.links))
        n = self.links[piece]
        link = np.repeat(self.at[piece], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        code = np.repeat(doc, n) * max(1, len(self.pairs)) + self.of[link]
        held, which = np.unique(code, return_inverse=True)
        times = np.bincount(which, np.repeat(often, n), len(held)).astype("i8")
        return held // max(1, len(self.pairs)), held % max(1, len(self.pairs)), times

    def packed(self) -> bytes:
        out = io.BytesIO()
        for x in (self.sizes, self.piece, self.links, self.pairs, self.of):
            np.save(out, x.astype(np.min_scalar_type(x.max(initial=0))), allow_pickle=False)
        return zstandard.compress(out.getvalue(), 1)


def unpacked(data: bytes) -> Links:
    file = io.BytesIO(zstandard.decompress(data))
    return Links(*(np.load(file, allow_pickle=False).astype("i8") for _ in range(5)))


class Block(Links):
    """Some texts, each as the numbers of its pieces."""

    def __init__(self, pieces: list[Piece], piece: np.ndarray, sizes: np.ndarray):
        *counts, self.written, data, _, given = zip(*pieces) if pieces else ((),) * 8
        if not all(given):  # a text with such a piece has no tokens
            doc = np.repeat(np.arange(len(sizes)), sizes)
            keep = np.bincount(doc, ~np.array(given)[piece], len(sizes)) == 0
            piece, sizes = piece[keep[doc]], sizes * keep
        links = np.fromiter(map(len, data), "i8", len(data)) // 8
        super().__init__(sizes, piece, links, *np.unique(np.frombuffer(b"".join(data), "i8"), return_inverse=True))
        self.n_a, self.n_b, self.n_groups, self.n_links = (self.summed(np.array(c, "i8")) for c in counts)

    def groups(self) -> list[str]:
        written = list(map(self.written.__getitem__, self.piece.tolist()))
        ends = np.cumsum(self.sizes).tolist()
        return [";".join(written[a:b]) for a, b in zip([0, *ends], ends)]


_LOADED: dict[str, Aligner] = {}


def loaded(stage: str, a_source: str, b_source: bytes, written: bool = True) -> Aligner:
    """One aligner for all tasks of a stage in a Python worker."""
    if stage not in _LOADED:
        _LOADED.clear()
        _LOADED[stage] = Aligner(a_source, b_source, written)
    return _LOADED[stage]


def vocabularies(spark: SparkSession, a_path: str, b_path: str):
    """The contents of both files (under 4 MB) as a broadcast, so that only the driver needs the files."""
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return spark.sparkContext.broadcast((a.read(), b.read()))


def in_blocks(texts: pa.Array) -> Iterator[tuple[int, list[str | None]]]:
    """Texts that are aligned together, as Python strings, and the place of the first of them."""
    sizes = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
    at = held = 0
    for k, n in enumerate(sizes):
        if held and held + n > BLOCK:
            yield at, texts.slice(at, k - at).to_pylist()
            at, held = k, 0
        held += n
    if at < len(sizes):
        yield at, texts.slice(at).to_pylist()


# --- the perfect hash --------------------------------------------------------------


def scattered(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys.astype("u8") * np.uint64(0x9E3779B97F4A7C15) + np.uint64(level * 0xC2B2AE3D27D4EB4F % (1 << 64))
    x ^= x >> np.uint64(31)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    return x


def bucket_of(keys: np.ndarray) -> np.ndarray:
    return (scattered(keys, 99) % np.uint64(BUCKETS)).astype("i8")


def perfect_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """Sizes of the levels and their bits, one after the other, for distinct ``keys``."""
    sizes, bits, level = [], [np.zeros(0, bool)], 0
    while len(keys):
        size = max(8, GAMMA * len(keys))
        place = scattered(keys, level) % np.uint64(size)
        alone = np.bincount(place.astype("i8"), minlength=size) == 1
        sizes.append(size)
        bits.append(alone)
        keys = keys[~alone[place]]
        level += 1
    return sizes, np.concatenate(bits)


class PairTable:
    """Rows ``(bucket, sizes, bits, keys, counts)`` put together for lookups."""

    def __init__(self, rows: list[tuple]):
        levels = max([len(sizes) for _, sizes, *_ in rows], default=0)
        self.size, self.at = np.zeros((BUCKETS, levels), "i8"), np.zeros((BUCKETS, levels), "i8")
        bits, end = [np.zeros(0, bool)], 0
        for bucket, sizes, packed, *_ in rows:
            self.size[bucket, : len(sizes)] = sizes
            self.at[bucket, : len(sizes)] = end + np.cumsum(sizes) - sizes
            end += sum(sizes)
            bits.append(np.unpackbits(np.frombuffer(packed, "u1"), count=sum(sizes)).astype(bool))
        self.bits = np.concatenate(bits)
        self.rank = (np.cumsum(self.bits) - self.bits).astype("i4")
        self.keys, self.counts = (
            np.concatenate([np.zeros(0, "i8"), *(np.frombuffer(r[k], "i8") for r in rows if r[k] is not None)]) for k in (3, 4)
        )

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; -1 of one that no bit stands for."""
        out, left, bucket = np.full(len(keys), -1), np.arange(len(keys)), bucket_of(keys)
        for level in range(self.size.shape[1]):
            if not len(left):
                break
            size = self.size[bucket[left], level]
            left, size = left[size > 0], size[size > 0]
            place = (scattered(keys[left], level) % size.astype("u8")).astype("i8") + self.at[bucket[left], level]
            hit = self.bits[place]
            out[left[hit]] = self.rank[place[hit]]
            left = left[~hit]
        return out

    def count(self, keys: np.ndarray) -> np.ndarray:
        """The count of each key; 0 of one that is not in the table."""
        if not len(self.keys):
            return np.zeros(len(keys), "i8")
        number = self.numbers(keys)
        found = (number >= 0) & (self.keys[number] == keys)
        return np.where(found, self.counts[number], 0)


# --- counting ----------------------------------------------------------------------

PAIRS = ["bucket", "part", "keys", "counts"]
NUMBERS = ["n_a", "n_b", "n_groups", "n_links"]
DESCRIBED = ["ids", *NUMBERS, "groups", "links"]


def merged(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    distinct, of = np.unique(keys, return_inverse=True)
    return distinct, np.bincount(of, counts, len(distinct)).astype("i8")


def observed(docs: DataFrame, files, text_col: str, id_col: str | None = None, digest: bool = False) -> DataFrame:
    """``(bucket, part, keys, counts)``: pairs of a task's documents, sorted, and how many of them hold each.

    With ``id_col`` also rows of ``(ids, n_a, n_b, n_groups, n_links, groups, links)``, a list for each column of some
    documents, and their links as ``Links`` packs them. Either kind of row has no value in the columns of the other.
    """

    stage, columns, schema = uuid.uuid4().hex, [F.col(f"`{text_col}`")], "bucket int, part int, keys binary, counts binary"
    if id_col is not None:
        columns.append(F.col(f"`{id_col}`"))
        kind = docs.schema[id_col].dataType.simpleString()
        schema += f", ids array<{kind}>, " + ", ".join(f"{c} array<long>" for c in NUMBERS) + ", groups array<string>, links binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = loaded(stage, *files.value, written=id_col is not None)
        held, size = [], 0

        def rows():
            keys, counts = merged(*(np.concatenate([np.zeros(0, "i8"), *(h[k] for h in held)]) for k in (0, 1)))
            held.clear()
            bucket = bucket_of(keys)
            order = np.argsort(bucket, kind="stable")
            edges = np.searchsorted(bucket[order], np.arange(BUCKETS + 1))
            full = [b for b in range(BUCKETS) if edges[b] < edges[b + 1]]
            cut = [order[edges[b] : edges[b + 1]] for b in full]
            return pa.RecordBatch.from_arrays(
                [pa.array(full, pa.int32()), pa.array([TaskContext.get().partitionId()] * len(full), pa.int32()),
                 pa.array([keys[c].tobytes() for c in cut], pa.binary()), pa.array([counts[c].tobytes() for c in cut], pa.binary())],
                names=PAIRS,
            )

        def described(ids: pa.Array, found: Block) -> pa.RecordBatch:
            text = found.groups()
            if digest:
                text = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in text]
            numbers = (found.n_a, found.n_b, found.n_groups, found.n_links)
            lists = [ids, *map(pa.array, numbers), pa.array(text, pa.string())]
            lists = [pa.ListArray.from_arrays(pa.array([0, found.n], pa.int32()), x) for x in lists]
            return pa.RecordBatch.from_arrays([*lists, pa.array([found.packed()], pa.binary())], names=DESCRIBED)

        def whole(batch: pa.RecordBatch) -> pa.RecordBatch:
            """With all columns of the other kind of row."""
            given = dict(zip(batch.schema.names, batch.columns))
            return pa.RecordBatch.from_arrays([given.get(n, pa.nulls(batch.num_rows, t)) for n, t in types], names=[n for n, _ in types])

        types = [(n, t) for n, t in zip(PAIRS, (pa.int32(), pa.int32(), pa.binary(), pa.binary()))]
        for batch in batches:
            if id_col is not None and len(types) == len(PAIRS):
                kinds = [batch.column(1).type, *[pa.int64()] * len(NUMBERS), pa.string()]
                types += [*((n, pa.list_(t)) for n, t in zip(DESCRIBED, kinds)), (DESCRIBED[-1], pa.binary())]
            for at, texts in in_blocks(batch.column(0)):
                found = aligner.read(texts)
                if id_col is not None:
                    yield whole(described(batch.column(1).slice(at, len(texts)), found))
                n = np.bincount(found.distinct()[1], minlength=len(found.pairs))  # none for what only texts without tokens hold
                held.append((found.pairs[n > 0], n[n > 0]))
                size += len(found.pairs)
                if size > HELD:
                    held[:] = [merged(*(np.concatenate([h[k] for h in held]) for k in (0, 1)))]
                    size = len(held[0][0])
                    if size > HELD // 2:
                        yield whole(rows())
                        size = 0
        if held:
            yield whole(rows())

    return docs.select(*columns).mapInArrow(run, schema)


def arrays(table: pa.Table, name: str) -> list[np.ndarray]:
    return [np.frombuffer(x, "i8") for x in table.column(name).to_pylist()]


def one_row(table: pa.Table, **columns) -> pa.Table:
    """A row with the group's bucket and part."""
    bucket, part = table.column("bucket")[0].as_py(), table.column("part")[0].as_py()
    return pa.table({"bucket": pa.array([bucket], pa.int32()), "part": pa.array([part], pa.int32()), **columns})


def tree(rows: DataFrame, parts: int, combine, schema: str) -> DataFrame:
    """Rows of a bucket combined ``FAN`` parts at a time until one is left."""
    while parts > 1:
        parts = -(-parts // FAN)
        rows = rows.withColumn("part", F.floor(F.col("part") / FAN).cast("int")).groupBy("bucket", "part").applyInArrow(combine, schema)
    return rows


def united(table: pa.Table) -> pa.Table:
    keys = np.unique(np.concatenate(arrays(table, "keys")))
    return one_row(table, keys=pa.array([keys.tobytes()], pa.binary()))


def summed(table: pa.Table) -> pa.Table:
    total = np.sum(arrays(table, "counts"), axis=0)
    return one_row(table, counts=pa.array([total.tobytes()], pa.binary()))


def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The perfect hash of each bucket, and its keys in the order of their numbers."""
    for batch in batches:
        out = []
        for bucket, data in zip(batch.column("bucket").to_pylist(), batch.column("keys").to_pylist()):
            keys = np.frombuffer(data, "i8")
            sizes, bits = perfect_hash(keys)
            packed = np.packbits(bits).tobytes()
            placed = np.empty_like(keys)
            placed[PairTable([(bucket, sizes, packed, None, None)]).numbers(keys)] = keys
            out.append((bucket, sizes, packed, placed.tobytes()))
        kinds = (pa.int32(), pa.list_(pa.int64()), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)], names=["bucket", "sizes", "bits", "keys"]
        )


def dense(left: pa.Table, right: pa.Table) -> pa.Table:
    """The sum of some tasks' numbers as a vector indexed by the perfect hash of the bucket."""
    if not left.num_rows:
        return pa.table({"bucket": pa.array([], pa.int32()), "part": pa.array([], pa.int32()), "counts": pa.array([], pa.binary())})
    bucket = left.column("bucket")[0].as_py()
    sizes, bits, n = (right.column(c)[0].as_py() for c in ("sizes", "bits", "n"))
    table, total = PairTable([(bucket, sizes, bits, None, None)]), np.zeros(n, "i8")
    for keys, counts in zip(arrays(left, "keys"), arrays(left, "counts")):
        np.add.at(total, table.numbers(keys), counts)
    limb = left.column("limb")[0].as_py()
    return pa.table({
        "bucket": pa.array([bucket], pa.int32()), "part": pa.array([limb], pa.int32()), "counts": pa.array([total.tobytes()], pa.binary())
    })


TABLE = "bucket int, sizes array<long>, bits binary, keys binary, counts binary"


def counted(seen: DataFrame, scratch: Scratch) -> DataFrame:
    """The table ``TABLE``, stored: how many documents hold each linked pair. ``seen``: what ``observed`` gives, stored."""
    seen = seen.where("bucket IS NOT NULL").select(*PAIRS)
    parts = 1 + (seen.agg(F.max("part")).first()[0] or 0)
    keys = tree(seen.select("bucket", "part", "keys"), max(parts, 2), united, "bucket int, part int, keys binary")
    hashes = scratch.stored(keys.select("bucket", "keys").mapInArrow(hashed, "bucket int, sizes array<long>, bits binary, keys binary"), "hashes")
    limbs = -(-parts // FAN)
    slim = hashes.select("bucket", "sizes", "bits", (F.octet_length("keys") / 8).cast("int").alias("n"))
    slim = slim.withColumn("limb", F.explode(F.sequence(F.lit(0), F.lit(limbs - 1))))
    leaves = (
        seen.withColumn("limb", F.floor(F.col("part") / FAN).cast("int")).groupBy("bucket", "limb")
        .cogroup(slim.groupBy("bucket", "limb")).applyInArrow(dense, "bucket int, part int, counts binary")
    )
    sums = tree(leaves, limbs, summed, "bucket int, part int, counts binary")
    return stored(hashes.join(sums.select("bucket", "counts"), "bucket").select("bucket", "sizes", "bits", "keys", "counts"), "table")


def table_pairs(table: DataFrame) -> DataFrame:
    """``(a, b, n_docs)`` of all pairs in the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for data, numbers in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                keys, counts = np.frombuffer(data, "i8"), np.frombuffer(numbers, "i8")
                yield pa.RecordBatch.from_arrays([pa.array(keys >> 32), pa.array(keys & 0xFFFFFFFF), pa.array(counts)], names=["a", "b", "n_docs"])

    return table.select("keys", "counts").mapInArrow(run, "a long, b long, n_docs long")


def link_counts(docs: DataFrame, a_path: str, b_path: str, text_col: str = "text") -> DataFrame:
    """``(a, b, n_docs)``: for each pair of ids that is linked, how many rows of ``docs`` hold it linked."""
    scratch = Scratch()
    files = vocabularies(docs.sparkSession, a_path, b_path)
    table = counted(scratch.stored(observed(docs, files, text_col), "pairs"), scratch)
    scratch.drop()
    return table_pairs(table)


# --- second pass -------------------------------------------------------------------

SUMS = "n_best long, count_sum long"


def align(
    docs: DataFrame, a_path: str, b_path: str, digest: bool = False, broadcast: int = BROADCAST,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(id_col, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` for every row of ``docs``.

    ``n_best`` counts the links whose count is the highest of their A id, ``count_sum`` adds the counts of all links.
    ``groups`` is text, or with ``digest`` its SHA-256 as ``groups_sha256``; of a text without tokens both are empty.
    """
    spark, scratch = docs.sparkSession, Scratch()
    # Not among the tables to be dropped: the result reads it.
    seen = stored(observed(docs, vocabularies(spark, a_path, b_path), text_col, id_col, digest), "aligned")
    table = counted(seen, scratch)
    # One number for each id of A at most.
    top = table_pairs(table).groupBy("a").agg(F.max("n_docs").alias("n")).collect()
    scratch.drop()
    best_of = np.zeros(1 + max([r["a"] for r in top], default=0), "i8")
    for r in top:
        best_of[r["a"]] = r["n"]
    best = spark.sparkContext.broadcast(best_of)
    size = table.agg(F.sum(F.octet_length("keys")) / 8).first()[0] or 0
    whole = spark.sparkContext.broadcast([tuple(r) for r in table.collect()]) if size <= broadcast else None
    kind = docs.schema[id_col].dataType.simpleString()
    last = "groups_sha256" if digest else "groups"
    names = [id_col, *NUMBERS, last]
    shown = f"`{id_col}` {kind}, n_a long, n_b long, n_groups long, n_links long, {last} string"
    rows = seen.where("links IS NOT NULL").select(*DESCRIBED)
    order = [id_col, *NUMBERS, "n_best", "count_sum", last]

    def documents(batch: pa.RecordBatch) -> Iterator[tuple[list[pa.Array], Links]]:
        """The columns ``names`` and the links of the documents of each row."""
        for k in range(batch.num_rows):
            yield [c.slice(k, 1).flatten() for c in batch.columns[:-1]], unpacked(batch.column(len(DESCRIBED) - 1)[k].as_py())

    if whole is not None:

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known, highest = PairTable(whole.value), best.value
            for batch in batches:
                for columns, found in documents(batch):
                    counts = known.count(found.pairs)
                    sums = [pa.array(found.linked(v)) for v in (counts == highest[found.pairs >> 32], counts)]
                    yield pa.RecordBatch.from_arrays(columns + sums, names=[*names, "n_best", "count_sum"])

        return rows.mapInArrow(run, f"{shown}, {SUMS}").select(*[F.col(f"`{c}`") for c in order])

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A row for each document, and for each block and bucket a row that asks."""
        at = TaskContext.get().partitionId() << 40
        asked = (pa.int32(), pa.binary(), pa.binary(), pa.binary())
        for batch in batches:
            for columns, found in documents(batch):
                (doc, of, times), n = found.distinct(), found.n
                row = np.arange(at, at + n)
                at += n
                bucket = bucket_of(found.pairs)[of]
                by = np.argsort(bucket, kind="stable")
                edges = np.searchsorted(bucket[by], np.arange(BUCKETS + 1))
                full = [(k, by[x:y]) for k, (x, y) in enumerate(zip(edges, edges[1:])) if x < y]
                questions = [[k for k, _ in full], *([v[x].tobytes() for _, x in full] for v in (row[doc], found.pairs[of], times))]
                head = columns + [pa.array(row)] + [pa.nulls(n, t) for t in asked]
                tail = [pa.nulls(len(full), c.type) for c in head[:7]] + [pa.array(q, t) for q, t in zip(questions, asked)]
                for some in (head, tail):
                    yield pa.RecordBatch.from_arrays(some, names=[*names, "_row", "bucket", "rows", "pairs", "times"])

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, known = None, None
        for batch in batches:
            for bucket, sizes, bits, keys, counts, row, pairs, times in zip(*(c.to_pylist() for c in batch.columns)):
                if key != bucket:
                    key, known = bucket, PairTable([(bucket, sizes, bits, keys, counts)])
                row, pairs, times = (np.frombuffer(x, "i8") for x in (row, pairs, times))
                ids, of = np.unique(row, return_inverse=True)
                counts = known.count(pairs)
                sums = [np.bincount(of, times * v, len(ids)).astype("i8") for v in (counts == best.value[pairs >> 32], counts)]
                yield pa.RecordBatch.from_arrays([pa.array(ids), *(pa.array(s) for s in sums)], names=["_row", "n_best", "count_sum"])

    both = stored(rows.mapInArrow(ask, f"{shown}, _row long, bucket int, rows binary, pairs binary, times binary"), "asked")
    asks = both.where("bucket IS NOT NULL").select("bucket", "rows", "pairs", "times")
    answers = (
        asks.join(table, "bucket").select("bucket", "sizes", "bits", "keys", "counts", "rows", "pairs", "times")
        .mapInArrow(answer, f"_row long, {SUMS}").groupBy("_row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    )
    given = both.where("bucket IS NULL").join(answers, "_row", "left")
    return given.withColumns({c: F.coalesce(c, F.lit(0)).cast("long") for c in ("n_best", "count_sum")}).select(*[F.col(f"`{c}`") for c in order])
