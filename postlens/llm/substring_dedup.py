"""Removal of lines, paragraphs or passages that stand in several places.

Each text is cut into units, each unit is normalised (ASCII lower case, one
space for white space) and hashed. Digests are grouped over the whole table; of
the places where a unit stands, the one that ranks first, by document id and
then by position, keeps it. The others lose it. What is left of a text is joined
as it was; the spans that were cut out are given in code points of the original.

The unit ``passage`` cuts finer: a line of fewer than ``min_words`` words is one
piece, a longer one is cut into its sentences, and a sentence of more than
``LONG`` words after words that their checksum picks, the same ones in any text.
What is hashed are windows of pieces that follow one another, over line breaks
too: from each piece on, and for a short piece also back from it, as many as make
``min_words`` words. A piece goes if it is in a window that stands in an earlier
place. So whole lines that repeat go as with ``line``, and so do lists, verse, and
the unchanged pieces of a passage that was edited. A line goes with its
separator when nothing with words is left of it.

Only digests of units that stand in two documents or more go on to the second
half, and a document sends a digest once, however often it holds the unit. A
digest that many documents hold is counted within the tasks first.

Defined results: units of fewer than ``min_words`` words are always kept (of passages:
texts of fewer); a null
or empty text stays as it is; rows that share an id rank as one document, and
each keeps the units that this document keeps; rows without an id rank last
(each loses what a row with an id holds, and none is owner of a unit);
a document that loses all its units gets an empty text. Extra columns of
``mark_repeats``' input are not read.
"""

from __future__ import annotations

import hashlib
import re
import zlib

import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from postlens.llm.common import map_columns

BLANKS = re.compile("[\t-\r ]+")
SEPARATORS = {"line": re.compile("\n"), "paragraph": re.compile("\n(?:[\t\r ]*\n)+")}
MIN_WORDS = 8
LAST = frozenset(b".!?\"')]\x99\x9d\xa6\xbb")  # bytes that a word may end with which ends a sentence
SENTENCE_END = re.compile(b"(?:[.!?]|\xe2\x80\xa6)(?:[\"')\\]]|\xe2\x80[\x99\x9d]|\xc2\xbb)*+$")
WORD = re.compile("[^\t-\r ]+")
LONG = 40  # words of a sentence that is cut no further
PICKED = 8  # one word in so many ends a piece of a longer one


def units(text: str, unit: str, min_words: int) -> list[tuple[int, int, bytes | None]]:
    """``(start, end, digest)`` of each unit; no digest if it is short. Ends are after the separator."""
    out, at = [], 0
    for m in [*SEPARATORS[unit].finditer(text), None]:
        stop, end = (len(text), len(text)) if m is None else m.span()
        out.append((at, end, digest(text[at:stop], min_words)))
        at = end
    return out


def digest(unit: str, min_words: int) -> bytes | None:
    words = unit.encode().lower().split()  # of bytes: ASCII letters and white space only
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if len(words) >= min_words else None


def pieces(words: list[bytes], min_words: int) -> list[int]:
    """Where the pieces of a line end, in words."""
    n = len(words)
    if n < min_words:
        return [n] if n else []
    ends = [k for k, w in enumerate(words, 1) if w[-1] in LAST and SENTENCE_END.search(w)]
    if not ends or ends[-1] < n:
        ends.append(n)
    if n <= LONG:
        return ends
    out, at = [], 0
    for end in ends:
        if end - at > LONG:
            out += [k for k in range(at + 1, end) if zlib.crc32(words[k - 1]) % PICKED == 0]
        out.append(end)
        at = end
    return out


def cut_up(text: str, min_words: int) -> tuple[list[list[int]], list[int], list[bytes]]:
    """The ends of the pieces of each line, and of each piece the number of its words and the words."""
    lines, counts, parts = [], [], []
    for line in text.encode().lower().split(b"\n"):
        words, at = line.split(), 0
        lines.append(pieces(words, min_words))
        for end in lines[-1]:
            counts.append(end - at)
            parts.append(b" ".join(words[at:end]))
            at = end
    return lines, counts, parts


def windows(counts: list[int], min_words: int) -> list[tuple[int, int]]:
    """``(first, end)`` of the windows of pieces, given by their numbers of words."""
    out, n = [], len(counts)
    for k, size in enumerate(counts):
        if size >= min_words:
            out.append((k, k + 1))
            continue
        total, j = size, k + 1
        while total < min_words and j < n:
            total += counts[j]
            j += 1
        if total >= min_words:
            out.append((k, j))
        total, i = size, k
        while total < min_words and i:
            i -= 1
            total += counts[i]
        if total >= min_words:
            out.append((i, k + 1))
    return out


def window_digest(parts: list[bytes], first: int, end: int) -> bytes:
    return xxhash.xxh3_128_digest(parts[first] if end == first + 1 else b" ".join(parts[first:end]))


def digests(text: str, unit: str, min_words: int) -> set[bytes]:
    if unit == "passage":
        _, counts, parts = cut_up(text, min_words)
        return {window_digest(parts, a, b) for a, b in windows(counts, min_words)}
    return {d for _, _, d in units(text, unit, min_words) if d is not None}


def passages_gone(text: str, min_words: int, elsewhere: set[bytes]) -> list[tuple[int, int]]:
    """The spans of the passages in ``elsewhere`` and of repeats inside the text that don't overlap what they repeat."""
    lines, counts, parts = cut_up(text, min_words)
    gone, ends = set(), {}
    for first, end in sorted(windows(counts, min_words)):
        key = window_digest(parts, first, end)
        if key in elsewhere or ends.setdefault(key, end) <= first:
            gone.update(range(first, end))
    if not gone:
        return []
    spans: list[tuple[int, int]] = []
    at = start = 0
    for line, found in zip(text.split("\n"), lines, strict=True):
        stop = start + len(line)
        end = min(stop + 1, len(text))
        ours = [k in gone for k in range(at, at + len(found))]
        at += len(found)
        cuts = []
        if ours and all(ours):
            cuts = [(start, end)]
        elif any(ours):
            begins = [m.start() for m in WORD.finditer(text, start, stop)] + [stop]
            edges = [start, *(begins[k] for k in found)]
            cuts = [(a, b) for a, b, g in zip(edges, edges[1:], ours) if g]
        for a, b in cuts:
            if spans and spans[-1][1] == a:
                spans[-1] = (spans[-1][0], b)
            else:
                spans.append((a, b))
        start = stop + 1
    return spans


def cut(text: str | None, unit: str, min_words: int, elsewhere: set[bytes]) -> tuple[str | None, list[tuple[int, int]]]:
    """The text without the units in ``elsewhere`` and without repeats inside itself, and the spans cut out."""
    if not text:
        return text, []
    met, spans, kept = set(elsewhere), [], []
    if unit == "passage":
        spans = passages_gone(text, min_words, met)
        edges = [0, *(p for span in spans for p in span), len(text)]
        kept = [(a, b) for a, b in zip(edges[::2], edges[1::2]) if a < b or b == len(text) and text.endswith("\n")]
        unit, whole = "line", ()
    else:
        whole = units(text, unit, min_words)
    for start, end, key in whole:
        if key is not None and key in met:
            spans.append((start, end))
        else:
            kept.append((start, end))
        if key is not None:
            met.add(key)
    if not spans:
        return text, []
    left = "".join(text[a:b] for a, b in kept)
    if kept and kept[-1][1] < len(text):  # the last unit went: what is last now has no separator after it
        m = [*SEPARATORS[unit].finditer(left)]
        left = left[: m[-1].start()] if m and m[-1].end() == len(left) else left
    return left, spans


def part_of(id_col: str, text_col: str) -> Column:
    """What tells rows without an id apart: such rows need meet only rows with the same text."""
    return F.when(F.col(f"`{id_col}`").isNull(), F.xxhash64(F.col(f"`{text_col}`")))


def repeats(docs: DataFrame, unit: str, min_words: int, id_col: str, text_col: str) -> DataFrame:
    """``(_id, _part, _digests, owners)``: the units that stand in an earlier document, and in which."""

    def start():
        def apply(keys, parts, texts):
            rows = [
                (key, part, d)
                for key, part, text in zip(keys, parts, texts)
                if text
                for d in digests(text, unit, min_words)
            ]
            return ([r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows])

        return apply

    kind = docs.schema[id_col].dataType.simpleString()
    rows = docs.select(F.col(f"`{id_col}`"), part_of(id_col, text_col), F.col(f"`{text_col}`"))
    held = map_columns(rows, start, f"_id {kind}, _part long, _digest binary")
    # The owner of a digest is the smallest id; rows without id come last and own nothing that others hold.
    shared = held.groupBy("_digest").agg(F.min("_id").alias("_owner"), F.count("*").alias("_n")).where("_n > 1")
    return (
        held.join(shared.select("_digest", "_owner"), "_digest")
        .where("_id IS NULL AND _owner IS NOT NULL OR _id > _owner")
        .groupBy("_id", "_part")
        .agg(F.collect_set("_digest").alias("_digests"), F.sort_array(F.collect_set("_owner")).alias("owners"))
    )


def mark_repeats(
    docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``(id_col, text_col, removed, owners)``: texts without repeats, spans cut out, documents that keep them.

    ``owners`` lists other documents only.
    """
    found = repeats(docs, unit, min_words, id_col, text_col)
    rows = docs.select(
        F.col(f"`{id_col}`").alias("_key"), part_of(id_col, text_col).alias("_key_part"), F.col(f"`{text_col}`").alias("_text")
    )
    same = F.col("_key").eqNullSafe(F.col("_id")) & F.col("_key_part").eqNullSafe(F.col("_part"))
    joined = rows.join(found, same, "left").select("_key", "_text", "_digests", "owners")

    def start():
        def apply(keys, texts, digests, owners):
            done = [cut(t, unit, min_words, set(d or ())) for t, d in zip(texts, digests)]
            spans = [[{"start": a, "end": b} for a, b in s] for _, s in done]
            return keys, [t for t, _ in done], spans, [o or [] for o in owners]

        return apply

    kind = docs.schema[id_col].dataType.simpleString()
    return map_columns(
        joined, start, f"`{id_col}` {kind}, `{text_col}` string, removed array<struct<start:int,end:int>>, owners array<{kind}>"
    )


def drop_repeats(
    docs: DataFrame, unit: str = "line", min_words: int = MIN_WORDS, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the repeats cut out of ``text_col``; all rows and columns stay."""
    found = repeats(docs, unit, min_words, id_col, text_col)
    extra = "_" * max(map(len, docs.columns)) + "digests"  # longer than any name there is
    keys = found.select(F.col("_id").alias(f"{extra}_id"), F.col("_part").alias(f"{extra}_part"), F.col("_digests").alias(extra))
    same = F.col(f"`{id_col}`").eqNullSafe(F.col(f"{extra}_id")) & part_of(id_col, text_col).eqNullSafe(F.col(f"{extra}_part"))
    joined = docs.join(keys, same, "left")
    cleaned = F.pandas_udf(
        lambda texts, digests: texts.combine(
            digests, lambda t, d: cut(t, unit, min_words, set() if d is None else set(map(bytes, d)))[0]
        ).astype(object),
        T.StringType(),
    )
    # Pandas gives null texts as None, so they come back as null.
    return joined.select(
        *[cleaned(F.col(f"`{c}`"), F.col(extra)).alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]
    )
