"""Removal of byte strings that occur more than once, by suffix arrays of shards.

Texts are UTF-8 bytes. Every string of ``length`` bytes that starts at two or more
places, in one text or in several, is found, and all bytes that it covers are
removed at every place. Strings are judged on the input, not on what is left.

Where to look. Each window of ``length`` bytes is named by the smallest hash of
its ``GRAM``-byte strings, its anchor. Equal windows have equal anchors, so a
window whose anchor stands once stands only once and is left out. Windows
in a row with one anchor make up a segment, the bytes from the first to the last.
Segments that are the same byte for byte are held once and weigh as many as
there are: if two or more, all their windows repeat. Sorted are the segments of
the anchors that have others besides.

Sorting. Segments are dealt to shards by their anchor, so all places of a string
meet in a shard. A shard is a suffix array: ranks by eight bytes, then by
Larsson-Sadakane doubling of the groups that are not told apart yet. Common
prefixes of neighbours are counted by Kasai's rule (one place on, a prefix is
shorter by one at most), in all segments of the shard side by side. Windows whose neighbours share ``length`` bytes form a class; a class that
weighs two or more repeats.

Merging. An anchor with very many different segments (a line that a large part
of the corpus holds) does not fit a shard and is dealt to several. The classes
of such shards are compared across them: each sends sorted digests of its
classes, cut into ranges, and a range looks up every list in all of them, merged, by
binary search. Digests are of 128 bits.

Defined results: a null or empty text has no bytes and stays; texts shorter than
``length`` stay whole; repeated rows, with or without ids, are places of their own;
a text that loses all bytes is left with none. Extra columns are not read. A text
may be cut inside a code point, so what is kept is given as binary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from postlens.llm.common import Scratch, stored

LENGTH = 400
GRAM = 128
SEGMENT = 512  # windows in a segment at most; a text of one letter has one anchor throughout
BLOCK = 1 << 20  # bytes of texts that are hashed together, if a text is no longer
SHARD = 1 << 21  # bytes of segments in a shard, about
ROWS = 256  # rows that a task turns into Python objects at a time
BASE = 0x9E3779B97F4A7C15 | 1
INVERSE = pow(BASE, -1, 1 << 64)
RANGES = "array<struct<at:int,n:int>>"

_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of ``BASE`` and of its inverse, modulo 2^64; kept for the usual sizes."""
    size = max(BLOCK, 1 << (n - 1).bit_length())
    if size in _POWERS:
        return _POWERS[size]
    out = tuple(np.cumprod(np.concatenate([np.ones(1, "u8"), np.full(size, x, "u8")])) for x in (BASE, INVERSE))
    if size <= 4 * BLOCK:
        _POWERS[size] = out
    return out


def mixed(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(32))
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def anchors(data: np.ndarray, length: int, gram: int) -> tuple[np.ndarray, np.ndarray]:
    """The smallest hash of a ``gram``-byte string in each window of ``length`` bytes, and whether it is that of its first."""
    power, inverse = powers(len(data))
    sums = np.concatenate([np.zeros(1, "u8"), np.cumsum((data.astype("u8") + np.uint64(1)) * power[: len(data)])])
    hashes = mixed((sums[gram:] - sums[:-gram]) * inverse[: len(data) - gram + 1])
    least = hashes
    width, have = length - gram + 1, 1
    while 2 * have <= width:
        least = np.minimum(least[:-have], least[have:])
        have *= 2
    if have < width:
        least = np.minimum(least[: len(least) - (width - have)], least[width - have :])
    return least, hashes[: len(least)] == least


def segments(texts: list[bytes], length: int, gram: int) -> tuple[np.ndarray, ...]:
    """``(text, anchor, start, n, times)`` of the segments: its text's number, its bytes from ``start`` on.

    ``times`` is how often the anchor stands in the segment: a text that repeats itself at short distance has it several
    times in one.
    """
    sizes = np.array([len(t) for t in texts])
    if not len(sizes) or sizes.max() < length:
        return (np.zeros(0, "i8"),) * 5
    data = np.frombuffer(b"".join(texts), "u1")
    begins = np.cumsum(sizes) - sizes
    least, first = anchors(data, length, gram)
    passed = np.cumsum(first) - first  # anchors left behind so far
    long = np.flatnonzero(sizes >= length)
    windows = sizes[long] - length + 1
    new = np.zeros(len(least), bool)
    new[1:] = least[1:] != least[:-1]
    new[begins[long]] = True
    inside = np.zeros(len(data) + 1, "i1")
    inside[begins[long]] += 1
    inside[begins[long] + windows] -= 1
    at = np.flatnonzero(new & (np.cumsum(inside[: len(least)], dtype="i1") > 0))
    text = np.searchsorted(begins, at, "right") - 1
    # Empty texts begin where the next one does; the last of such is the one that holds the window.
    end = np.minimum(np.append(at[1:], len(data)), begins[text] + sizes[text] - length + 1)
    n, parts = end - at, -(-(end - at) // SEGMENT)
    which = np.repeat(np.arange(len(at)), parts)
    part = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    start = at[which] + part * SEGMENT
    count = np.minimum(n[which] - part * SEGMENT, SEGMENT)
    times = passed[start + count - 1] - passed[start] + 1
    return text[which], least[at][which].view("i8"), start - begins[text[which]], count + length - 1, times


# --- one shard ---------------------------------------------------------------------


def suffix_array(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes in their order (of two that differ by zeros at the end the shorter first), and the eight bytes at each place."""
    n = len(data)
    padded = np.concatenate([data, np.zeros(8, "u1")]).tobytes()
    eight = np.empty(n, "u8")
    for k in range(min(8, n)):
        eight[k::8] = np.frombuffer(padded, ">u8", len(range(k, n, 8)), k)
    order = np.argsort(eight, kind="stable").astype("i4")
    ordered = eight[order]
    new = np.ones(n, bool)
    new[1:] = ordered[1:] != ordered[:-1]
    place = np.arange(n, dtype="i4")
    rank = np.empty(n, "i4")
    rank[order] = np.maximum.accumulate(np.where(new, place, 0))
    open_, have = order[~(new & np.append(new[1:], True))], 8
    while len(open_):
        held, next_ = rank[open_], open_ + have
        # Past the end the nearer place is the greater: of equal bytes the shorter suffix comes first.
        after = np.where(next_ < n, rank[np.minimum(next_, n - 1)], n - 1 - next_)
        key = held.astype("i8") << 32 | (after.astype("i8") + (1 << 31))
        by = np.argsort(key, kind="stable")
        open_, key, held = open_[by], key[by], held[by]
        new = np.ones(len(open_), bool)
        new[1:] = key[1:] != key[:-1]
        group = np.ones(len(open_), bool)
        group[1:] = held[1:] != held[:-1]
        place = np.arange(len(open_), dtype="i4")
        first = np.maximum.accumulate(np.where(group, place, 0))
        order[held + place - first] = open_
        rank[open_] = held + np.maximum.accumulate(np.where(new, place, 0)) - first
        open_ = open_[~(new & np.append(new[1:], True))]
        have *= 2
    return order, eight


def shared_prefixes(order: np.ndarray, eight: np.ndarray, begins: np.ndarray, windows: np.ndarray, length: int) -> np.ndarray:
    """How many bytes the window at each place of ``order`` shares with the one before it, ``length`` at most.

    ``order`` holds the windows of all segments: ``windows`` in a row from each of ``begins``. By Kasai's rule along
    each segment, all segments in step; where the neighbour has no next window, counting begins anew.
    """
    n = len(eight)
    before = np.full(n + 1, -1, "i4")
    before[order[1:]] = order[:-1]
    held = np.zeros(n + 1, bool)
    held[order] = True
    value = np.concatenate([eight, np.zeros(length + 8, "u8")])
    out = np.zeros(n, "i4")
    lanes = np.argsort(-windows, kind="stable")
    begins, windows = begins[lanes], windows[lanes]
    have, last = np.zeros(len(lanes), "i8"), np.full(len(lanes), -1)
    for step in range(int(windows[0]) if len(windows) else 0):
        active = np.searchsorted(-windows, -step, "left")
        i = begins[:active] + step
        j = before[i]
        h = np.where((last[:active] >= 0) & held[last[:active] + 1], np.maximum(have[:active] - 1, 0), 0)
        h[j < 0] = 0
        going = np.flatnonzero((h < length) & (j >= 0))
        while len(going):
            differ = value[i[going] + h[going]] ^ value[j[going] + h[going]]
            same = differ == 0
            rest = differ[~same]
            equal = sum((rest < np.uint64(1 << (8 * k))).astype("i8") for k in range(1, 8))
            h[going[~same]] += equal
            going = going[same]
            h[going] += 8
            going = going[h[going] < length]
        out[i] = have[:active] = np.minimum(h, length)
        last[:active] = j
    return out[order]


def classes(parts: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of each window, windows in order of the parts, and how many windows each part has.

    Windows are in one class if their bytes are the same.
    """
    sizes = np.array([len(p) for p in parts])
    data = np.frombuffer(b"".join(parts), "u1")
    begins = np.cumsum(sizes) - sizes
    windows = sizes - length + 1
    last = np.cumsum(windows)
    at = np.repeat(begins - (last - windows), windows) + np.arange(last[-1])
    order, eight = suffix_array(data)
    held = np.zeros(len(data), bool)
    held[at] = True
    order = order[held[order]]
    of = np.empty(len(data), "i4")
    of[order] = np.cumsum(shared_prefixes(order, eight, begins, windows, length) < length) - 1
    return of[at], windows


def spans_of(flags: np.ndarray) -> list[dict]:
    """Runs of set flags."""
    edges = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype("i1"), [0]])))
    return [{"at": int(a), "n": int(b - a)} for a, b in zip(edges[::2], edges[1::2])]


# --- over the corpus ---------------------------------------------------------------


def in_slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, ROWS):
            yield batch.slice(at, ROWS)


def in_blocks(texts: list, size: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about ``size`` bytes."""
    at = held = 0
    for k, t in enumerate(texts):
        if held and held + len(t) > size:
            yield at, k
            at, held = k, 0
        held += len(t)
    if at < len(texts):
        yield at, len(texts)


def places(rows: DataFrame, length: int, gram: int) -> DataFrame:
    """``(id, mark, anchor, start, n, times)`` of all segments of ``rows(id, mark, text binary)``."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            texts = batch.column(2).to_pylist()
            for a, b in in_blocks(texts):
                text, anchor, start, n, times = segments(texts[a:b], length, gram)
                took = pa.array(text + a)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).take(took), batch.column(1).take(took), pa.array(anchor), pa.array(start.astype("i4")), pa.array(n.astype("i4")),
                     pa.array(times.astype("i4"))],
                    names=["id", "mark", "anchor", "start", "n", "times"],
                )

    return rows.mapInArrow(run, f"id {kind}, mark long, anchor long, start int, n int, times int")


def packed(rows: DataFrame) -> DataFrame:
    """``rows(id, mark, text)`` with the text compressed, as it goes through shuffles."""
    kind = rows.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        press = zstandard.ZstdCompressor(level=1)
        for batch in in_slices(batches):
            texts = [press.compress(t) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.binary())], names=["id", "mark", "packed"])

    return rows.mapInArrow(run, f"id {kind}, mark long, packed binary")


def opened(data: bytes) -> bytes:
    return zstandard.ZstdDecompressor().decompress(data)


def same_row(a: str, b: str) -> Column:
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (F.col(f"{a}.mark") == F.col(f"{b}.mark"))


def named_segments(touched: DataFrame) -> DataFrame:
    """``(id, mark, start, n, times, anchor, c1, c2)`` of the segments listed in ``touched``; the digest of its bytes names a segment."""
    kind = touched.schema["id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            of, start, n, times, anchor, digest = [], [], [], [], [], []
            for k, (data, found) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).to_pylist())):
                text = opened(data)
                for s in found:
                    of.append(k)
                    start.append(s["start"])
                    n.append(s["n"])
                    times.append(s["times"])
                    anchor.append(s["anchor"])
                    digest.append(xxhash.xxh3_128_digest(text[s["start"] : s["start"] + s["n"]]))
            halves = np.frombuffer(b"".join(digest), "i8").reshape(-1, 2)
            took = pa.array(of, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(took), batch.column(1).take(took), pa.array(start, pa.int32()), pa.array(n, pa.int32()),
                 pa.array(times, pa.int32()), pa.array(anchor, pa.int64()), pa.array(halves[:, 0].copy()), pa.array(halves[:, 1].copy())],
                names=["id", "mark", "start", "n", "times", "anchor", "c1", "c2"],
            )

    return touched.select("id", "mark", "packed", "found").mapInArrow(
        run, f"id {kind}, mark long, start int, n int, times int, anchor long, c1 long, c2 long"
    )


def segment_bytes(listed: DataFrame) -> DataFrame:
    """``(shard, salt, split, anchor, c1, c2, weight, bytes)`` of the segments listed in ``listed(packed, found)``."""
    fields = "shard long, salt int, split int, anchor long, c1 long, c2 long, weight long"
    names = ["shard", "salt", "split", "anchor", "c1", "c2", "weight"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            for data, found in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                text = opened(data)
                columns = [[s[f] for s in found] for f in names]
                parts = [text[s["start"] : s["start"] + s["n"]] for s in found]
                kinds = [pa.int64()] + [pa.int32()] * 2 + [pa.int64()] * 4
                yield pa.RecordBatch.from_arrays(
                    [*(pa.array(c, t) for c, t in zip(columns, kinds)), pa.array(parts, pa.binary())], names=[*names, "bytes"]
                )

    return listed.select("packed", "found").mapInArrow(run, f"{fields}, bytes binary")


SORTED = f"kind int, shard long, salt int, split int, part int, anchor long, c1 long, c2 long, spans {RANGES}, numbers binary, digests binary"


def sort_shards(parts: DataFrame, length: int) -> DataFrame:
    """What the suffix array of each shard gives.

    Kind 0: the windows of a segment that repeat, as ``spans``. Of a shard that is
    one of several, too, kind 1: the classes of the windows of a segment as
    ``numbers`` (both only of segments that stand once, as the others repeat anyway); kind 2: the digests of the classes in range ``part``, sorted, and their numbers.
    """

    def run(table: pa.Table) -> pa.Table:
        seen: dict[tuple[int, int, int], int] = {}
        keys = list(zip(*(table.column(c).to_pylist() for c in ("anchor", "c1", "c2"))))
        took = [k for k, key in enumerate(keys) if seen.setdefault(key, k) == k]  # a repeated row sends a segment twice
        data, weight = table.column("bytes").take(took).to_pylist(), table.column("weight").take(took).to_numpy()
        shard, salt, split = (table.column(c)[0].as_py() for c in ("shard", "salt", "split"))
        of, windows = classes(data, length)
        repeated = np.bincount(of, np.repeat(weight, windows)) >= 2
        ends, out = np.cumsum(windows), []
        for k, a, b, w in zip(took, ends - windows, ends, weight):
            if w > 1:
                continue
            if spans := spans_of(repeated[of[a:b]]):
                out.append((0, shard, salt, split, 0, *keys[k], spans, None, None))
            if split > 1:
                out.append((1, shard, salt, split, 0, *keys[k], None, of[a:b].astype("u4").tobytes(), None))
        if split > 1:
            first = np.full(len(repeated), len(of))
            np.minimum.at(first, of, np.arange(len(of)))
            segment = np.searchsorted(ends, first, "right")
            at = first - (ends - windows)[segment]
            digest = [xxhash.xxh3_128_digest(data[s][a : a + length]) for s, a in zip(segment.tolist(), at.tolist())]
            names = np.frombuffer(b"".join(digest), "S16")
            by = np.argsort(names, kind="stable")
            of_range = np.frombuffer(b"".join(digest), "u1").reshape(-1, 16)[by, :4].copy().view(">u4").ravel().astype("u8") * split >> 32
            edges = np.searchsorted(of_range, np.arange(split + 1))
            for r, (a, b) in enumerate(zip(edges, edges[1:])):
                if a < b:
                    block = b"".join(digest[k] for k in by[a:b])
                    out.append((2, shard, salt, split, r, None, None, None, None, by[a:b].astype("u4").tobytes(), block))
        names = [f.split(" ")[0] for f in SORTED.replace("at:int,n:int", "").split(", ")]
        types = [pa.int32(), pa.int64()] + [pa.int32()] * 3 + [pa.int64()] * 3 + [pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())])), pa.binary(), pa.binary()]
        return pa.table({name: pa.array([r[k] for r in out], t) for k, (name, t) in enumerate(zip(names, types))})

    return parts.groupBy("split", "shard", "salt").applyInArrow(run, SORTED)


def across_shards(found: DataFrame) -> DataFrame:
    """``(anchor, c1, c2, spans)``: windows of shards that are one of several whose class is in another of them."""

    def compare(table: pa.Table) -> pa.Table:
        salts = table.column("salt").to_pylist()
        lists = [np.frombuffer(d, "S16") for d in table.column("digests").to_pylist()]
        every = np.sort(np.concatenate(lists), kind="stable")  # merges runs that are sorted
        numbers = [np.frombuffer(b, "u4") for b in table.column("numbers").to_pylist()]
        # A shard names a class once, so what is found at two places is in another shard too.
        hit = [np.searchsorted(every, x, "right") - np.searchsorted(every, x) > 1 for x in lists]
        rows = [(s, n[h].tobytes()) for s, n, h in zip(salts, numbers, hit) if h.any()]
        return pa.table({
            "split": pa.array([table.column("split")[0].as_py()] * len(rows), pa.int32()),
            "shard": pa.array([table.column("shard")[0].as_py()] * len(rows), pa.int64()),
            "salt": pa.array([r[0] for r in rows], pa.int32()), "numbers": pa.array([r[1] for r in rows], pa.binary()),
        })

    hits = found.where("kind = 2").groupBy("split", "shard", "part").applyInArrow(
        compare, "split int, shard long, salt int, numbers binary"
    )
    members = found.where("kind = 1").select("split", "shard", "salt", "anchor", "c1", "c2", "numbers")

    def mark(left: pa.Table, right: pa.Table) -> pa.Table:
        hit = np.unique(np.concatenate([np.frombuffer(b, "u4") for b in right.column("numbers").to_pylist()] or [np.zeros(0, "u4")]))
        rows = []
        for anchor, c1, c2, data in zip(*(left.column(c).to_pylist() for c in ("anchor", "c1", "c2", "numbers"))):
            if spans := spans_of(np.isin(np.frombuffer(data, "u4"), hit)):
                rows.append((anchor, c1, c2, spans))
        span = pa.list_(pa.struct([("at", pa.int32()), ("n", pa.int32())]))
        types = [pa.int64()] * 3 + [span]
        return pa.table({n: pa.array([r[k] for r in rows], t) for k, (n, t) in enumerate(zip(("anchor", "c1", "c2", "spans"), types))})

    return members.groupBy("split", "shard", "salt").cogroup(hits.groupBy("split", "shard", "salt")).applyInArrow(
        mark, f"anchor long, c1 long, c2 long, spans {RANGES}"
    )


def repeated_windows(touched: DataFrame, length: int, shard_bytes: int, scratch: Scratch) -> DataFrame:
    """``(id, mark, spans)``: runs of windows of ``touched`` that stand elsewhere too."""
    named = scratch.stored(named_segments(touched), "segments")
    kinds = named.groupBy("anchor", "c1", "c2").agg(
        F.count("*").alias("weight"), F.max("times").alias("times"), F.min(F.struct("id", "mark", "start", "n")).alias("r")
    )
    kinds = scratch.stored(kinds.select("anchor", "c1", "c2", "weight", "times", "r.*"), "kinds")
    whole = kinds.where("weight > 1").select(
        "anchor", "c1", "c2",
        F.array(F.struct(F.lit(0).alias("at"), (F.col("n") - (length - 1)).cast("int").alias("n"))).cast(RANGES).alias("spans"),
    )
    # To be sorted: anchors with a segment that stands once, and another one or a second place within it.
    size = F.sum(F.col("n").cast("long"))
    open_ = kinds.groupBy("anchor").agg(
        F.min("weight").alias("least"), F.count("*").alias("several"), F.max("times").alias("most"), size.alias("bytes")
    ).where("least = 1 AND (several > 1 OR most > 1)")
    open_ = scratch.stored(
        open_.select("anchor", "bytes", F.when(F.col("bytes") > shard_bytes, F.ceil(F.col("bytes") / shard_bytes)).otherwise(1).cast("int").alias("split")),
        "open",
    )
    total = open_.agg(F.sum("bytes")).first()[0] or 0
    shards = max(1, -(-total // shard_bytes))
    dealt = (
        kinds.join(open_, "anchor")
        # A split anchor has shards of its own.
        .withColumn("shard", F.when(F.col("split") > 1, F.col("anchor")).otherwise(F.pmod("anchor", F.lit(shards))).cast("long"))
        .withColumn("salt", F.pmod(F.xxhash64("c1", "c2"), "split").cast("int"))
        .groupBy("id", "mark")
        .agg(F.collect_list(F.struct("start", "n", "shard", "salt", "split", "anchor", "c1", "c2", "weight")).alias("found"))
    )
    once = touched.dropDuplicates(["id", "mark"])
    listed = once.alias("t").join(dealt.alias("d"), same_row("t", "d")).select("t.packed", "d.found")
    found = scratch.stored(sort_shards(segment_bytes(listed), length), "sorted")
    verdicts = whole.union(found.where("kind = 0").select("anchor", "c1", "c2", "spans")).union(across_shards(found))
    spans = named.join(verdicts, ["anchor", "c1", "c2"]).select("id", "mark", "start", "spans")
    return spans.groupBy("id", "mark").agg(F.collect_set(F.struct("start", "spans")).alias("runs"))


def removed(touched: DataFrame, length: int, id_col: str) -> DataFrame:
    """``(id_col, n_bytes, removed, kept)`` of ``touched(id, mark, packed, runs)``."""
    kind = touched.schema["id"].dataType.simpleString()
    span = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches):
            sizes, spans, kept = [], [], []
            for data, runs in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                text = opened(data)
                pairs = sorted({(r["start"] + s["at"], r["start"] + s["at"] + s["n"] + length - 1) for r in runs or () for s in r["spans"]})
                merged: list[list[int]] = []
                for a, b in pairs:
                    if merged and a <= merged[-1][1]:
                        merged[-1][1] = max(b, merged[-1][1])
                    else:
                        merged.append([a, b])
                edges = [0, *(x for m in merged for x in m), len(text)]
                sizes.append(len(text))
                spans.append([{"start": a, "end": b} for a, b in merged])
                kept.append(b"".join(text[a:b] for a, b in zip(edges[::2], edges[1::2])))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span), pa.array(kept, pa.binary())],
                names=[id_col, "n_bytes", "removed", "kept"],
            )

    return touched.select("id", "packed", "runs").mapInArrow(
        run, f"`{id_col}` {kind}, n_bytes long, removed array<struct<start:int,end:int>>, kept binary"
    )


def remove_repeats(
    docs: DataFrame, length: int = LENGTH, gram: int = GRAM, shard_bytes: int = SHARD, digest: bool = False,
    id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """``(id_col, n_bytes, removed, kept)`` for every row of ``docs``.

    ``removed`` lists the byte spans that are covered by a string of ``length`` bytes which starts anywhere else, as
    well; ``kept`` is the rest, or ``kept_sha256`` its digest. ``gram`` is ``length`` at most.
    """
    scratch = Scratch()
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    rows = docs.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("mark"), text.cast("binary").alias("text"))
    long = rows.where(F.octet_length("text") >= length)
    all_places = scratch.stored(places(long, length, gram), "places")
    common = all_places.groupBy("anchor").agg(F.sum("times").alias("_n")).where("_n > 1").select("anchor")
    lists = (
        all_places.join(common, "anchor").groupBy("id", "mark")
        .agg(F.collect_set(F.struct("start", "n", "anchor", "times")).alias("found"))
    )
    touched = packed(long).alias("t").join(lists.alias("l"), same_row("t", "l")).select("t.id", "t.mark", "t.packed", "l.found")
    touched = stored(touched, "touched")
    runs = stored(repeated_windows(touched, length, shard_bytes, scratch), "runs")
    scratch.drop()
    kept = F.sha2("text", 256).alias("kept_sha256") if digest else F.col("text").alias("kept")
    none = F.array().cast("array<struct<start:int,end:int>>")
    described = rows.select("id", "mark", F.octet_length("text").cast("long").alias("n_bytes"), none.alias("removed"), kept)
    whole = described.alias("w").join(runs.alias("r"), same_row("w", "r"), "left_anti").drop("mark").withColumnRenamed("id", id_col)
    cut = touched.alias("t").join(runs.alias("r"), same_row("t", "r")).select("t.id", "t.packed", "r.runs")
    changed = removed(cut, length, id_col)
    if digest:
        changed = changed.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")
    return changed.unionByName(whole)
