"""Text column functions. All of them are built-in expressions, no Python UDF."""

from __future__ import annotations

import json
from collections.abc import Iterable
from functools import reduce
from html.entities import html5
from operator import or_
from zlib import crc32

from pyspark.sql import Column
from pyspark.sql import functions as F

from postlens.functions.binding import let

# Body of a character class that matches the whitespace of Unicode text:
# the ASCII blanks, U+001C..U+001F, U+0085 and every Unicode separator.
WS = r"\s\x1c-\x1f\x85\p{Z}"

# Everything that is markup, in one leftmost-first pass: comments, script and
# style with their bodies, declarations, processing instructions, tags with
# quoted attributes; a quote opens a value only after an equals sign. The
# possessive group keeps matching iterative, so that one very long broken tag
# cannot exhaust the stack of an executor thread.
MARKUP = (
    r"(?is)<(?:!--.*?--"
    r"|script[^>]*>.*?</script"
    r"|style[^>]*>.*?</style"
    r"|![a-z][^>]*"
    r"|\?[^>]*"
    r"|/?[a-z](?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)>"
)

# Names of characters as the standard library lists them, and those that hold without a semicolon too.
ENTITIES = {name.rstrip(";"): text for name, text in html5.items()}
NAME_PARTS = 1024
BARE_ENTITIES = sorted(name for name in html5 if not name.endswith(";"))

# A link runs over "!", "$" to "_" and the lower-case letters.
URL = r"https?://[!$-_a-zA-Z]+"

# Contractions of two words that the tokeniser takes apart.
CONTRACTION = (
    r"\b(can(?=not\b)|gon(?=na\b)|got(?=ta\b)|wan(?=na\b)|gim(?=me\b)|lem(?=me\b))"
)


# The same characters one by one.
WS_CHARS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)


def strip_ws(c: Column) -> Column:
    """Remove leading and trailing Unicode whitespace (a plain ``trim`` takes blanks only)."""
    return F.btrim(c, F.lit(WS_CHARS))


def has_words(c: Column) -> Column:
    """True if the text holds anything but whitespace; null for a null."""
    return c.rlike(f"[^{WS}]")


def collapse_ws(c: Column) -> Column:
    """Each run of whitespace becomes one blank; none is left at either end."""
    return F.trim(F.regexp_replace(c, f"[{WS}]+", " "))


def first_text(*columns: Column) -> Column:
    """First column that is neither null nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in columns], F.lit(""))


def strip_markup(c: Column) -> Column:
    """Drop markup; the text of a CDATA section stays."""
    return F.regexp_replace(F.regexp_replace(c, r"(?s)<!\[CDATA\[(.*?)\]\]>", "$1"), MARKUP, "")


def decode_entities(c: Column) -> Column:
    """Decode numeric references and the names of characters; nothing is decoded twice.

    A number that is no character gives U+FFFD; an unknown name stays as it is;
    a no-break space becomes a blank. A number needs no semicolon, and old names
    need none where no letter or digit follows. Texts without an ampersand are not taken apart.
    """
    # Both are dealt to short maps and lists by a hash, as a long one is searched from its start.
    dealt: list[dict[str, str]] = [{} for _ in range(NAME_PARTS)]
    for name, text in sorted(ENTITIES.items()):
        dealt[crc32(name.encode()) % NAME_PARTS][name] = text
    names = F.from_json(F.lit(json.dumps(dealt)), "array<map<string,string>>")
    bare = [*BARE_ENTITIES]

    def decoded(piece: Column) -> Column:
        hexadecimal = F.conv(F.regexp_extract(piece, "^#[xX]0*([0-9a-fA-F]{1,6})(?![0-9a-fA-F])", 1), 16, 10)
        decimal = F.regexp_extract(piece, "^#0*([0-9]{1,7})(?![0-9])", 1)
        name = F.regexp_extract(piece, "^([a-zA-Z][a-zA-Z0-9]*)", 1)
        whole = F.substring(piece, F.length(name) + 1, F.lit(1)) == ";"
        of = lambda n: F.element_at(F.get(names, F.pmod(F.crc32(F.encode(n, "UTF-8")), F.lit(NAME_PARTS)).cast("int")), n)
        named = F.when((name != "") & (whole | name.isin(bare)), of(name))
        number = F.coalesce(F.nullif(hexadecimal, F.lit("")), F.nullif(decimal, F.lit(""))).cast("int")
        numbered = let(number, lambda n: F.when(n.isNotNull(), character(n)))
        rest = F.regexp_replace(piece, "^(?:#[xX][0-9a-fA-F]+|#[0-9]+|[a-zA-Z][a-zA-Z0-9]*);?", "")
        return let(F.coalesce(numbered, named), lambda t: F.when(t.isNull(), F.concat(F.lit("&"), piece)).otherwise(
            F.concat(F.replace(t, F.lit("\u00a0"), F.lit(" ")), rest)
        ))

    def character(n: Column) -> Column:
        valid = ((n > 0) & (n < 0xD800)) | ((n > 0xDFFF) & (n < 0x110000))
        code = F.when(valid, n).otherwise(0xFFFD)
        return F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")

    def joined(pieces: Column) -> Column:
        return F.array_join(F.transform(pieces, lambda p, i: F.when(i == 0, p).otherwise(decoded(p))), "")

    return let(c, lambda x: F.when(x.contains("&"), joined(F.split(x, "&", -1))).otherwise(x))


def strip_html(c: Column) -> Column:
    """Text of an HTML fragment; neighbouring blocks are joined without a blank."""
    return decode_entities(strip_markup(c))


def strip_urls(c: Column) -> Column:
    """Remove links; texts without the start of one are not searched."""
    return let(c, lambda x: F.when(x.contains("://"), F.regexp_replace(x, URL, "")).otherwise(x))


def strip_special(c: Column) -> Column:
    """Keep ASCII letters, ASCII digits and whitespace."""
    return F.regexp_replace(c, f"[^a-zA-Z0-9{WS}]+", "")


def strip_punct_digits(c: Column) -> Column:
    """Delete ASCII punctuation, then all decimal digits of Unicode."""
    return F.regexp_replace(F.regexp_replace(c, r"\p{Punct}+", ""), r"\p{Nd}+", "")


def letters_only(c: Column) -> Column:
    """Keep ASCII letters and whitespace (special characters and digits in one pass)."""
    return F.regexp_replace(c, f"[^a-zA-Z{WS}]+", "")


def split_contractions(c: Column) -> Column:
    """Take contractions apart; texts that hold none are not searched."""

    def taken_apart(x: Column) -> Column:
        held = reduce(or_, [x.contains(w) for w in ("cannot", "gonna", "gotta", "wanna", "gimme", "lemme")])
        return F.when(held, F.regexp_replace(x, CONTRACTION, "$1 ")).otherwise(x)

    return let(c, taken_apart)


def words(c: Column) -> Column:
    """Whitespace-separated words, without empty ones."""
    return F.filter(F.split(c, f"[{WS}]+"), lambda w: w != "")


def word_count(c: Column) -> Column:
    return F.size(words(c))


def shorten(c: Column, n: int) -> Column:
    """First ``n`` characters, followed by dots if something was cut."""
    return F.when(F.length(c) > n, F.concat(F.substring(c, 1, n), F.lit("..."))).otherwise(c)


def drop_words(tokens: Column, unwanted: Iterable[str]) -> Column:
    """Remove words from a token array whatever their case; duplicates stay."""
    unwanted = list(unwanted)
    return F.filter(tokens, lambda t: ~F.lower(t).isin(unwanted))


# Words by the word-break rules of Unicode, as one pattern. Marks and format characters belong to what stands before
# them. Letters are joined by an apostrophe, dot or colon between them, digits by a dot, apostrophe, comma or
# semicolon, both by underscores. An ideograph or a hiragana is a word of its own; katakana run on.
_EXTEND = r"[\p{M}\p{Cf}]"
_MID_QUOTE = "'.\u2018\u2019\u2024\ufe52\uff07\uff0e"
_MID_LETTER = "[:\u00b7\u0387\u055f\u05f4\u2027\ufe13\ufe55\uff1a" + _MID_QUOTE + "]"
_MID_NUMBER = "[,;\u037e\u0589\u060c\u060d\u066c\u07f8\u2044\ufe10\ufe14\ufe50\ufe54\uff0c\uff1b" + _MID_QUOTE + "]"
TOKEN_LENGTH = 255


def word_pattern(script: str = "Is", keep: str = "+") -> str:
    """The pattern; ``script`` goes before the names of scripts, ``keep`` after what is repeated, so that nothing is given back."""
    han, kana = rf"[\p{{{script}Han}}\p{{{script}Hiragana}}]", rf"\p{{{script}Katakana}}ー"
    some, many = "*" + keep, "+" + keep
    any_extend = _EXTEND + some
    # All letters but those of the scripts above; RE2 has no difference of classes, so both name the letters' kinds.
    letter = rf"[\p{{Lu}}\p{{Ll}}\p{{Lt}}\p{{Lm}}\p{{{script}Arabic}}\p{{{script}Hebrew}}\p{{{script}Devanagari}}\p{{{script}Hangul}}ªº]"
    letters = f"(?:{letter}{many}{any_extend}){many}"
    digits = rf"(?:\p{{Nd}}{many}{any_extend}){many}"
    words = f"{letters}(?:{_MID_LETTER}{any_extend}{letters}){some}"
    numbers = f"{digits}(?:{_MID_NUMBER}{any_extend}{digits}){some}"
    run = f"(?:(?:{words}|{numbers}){many}|(?:[{kana}]{many}{any_extend}){many})"
    joiner = rf"(?:\p{{Pc}}{many}{any_extend})"
    return f"{joiner}{some}{run}(?:{joiner}{many}{run}){some}{joiner}{some}|{han}{any_extend}"


def terms(c: Column, unwanted: Iterable[str]) -> Column:
    """Search terms of a text: its words in lower case, the longest cut, no stop words."""
    unwanted = [*unwanted]
    words = F.regexp_extract_all(F.lower(c), F.lit(word_pattern()), F.lit(0))
    cut = F.flatten(F.transform(words, lambda w: F.when(F.length(w) <= TOKEN_LENGTH, F.array(w)).otherwise(
        F.regexp_extract_all(w, F.lit(f"(?s).{{1,{TOKEN_LENGTH}}}"), F.lit(0))
    )))
    return F.filter(cut, lambda t: ~t.isin(unwanted))
