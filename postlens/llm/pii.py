"""Personal data: anchors found by one automaton, expanded by local parsers.

An Aho-Corasick automaton runs over the text once and stops at anchors only: at
signs, plus signs, digits, URL schemes, and words that announce an account or an
address. At each anchor a small deterministic parser expands to both sides,
decides where the item ends and validates it. A parser never reads past the item
it is at, so a text costs time in proportion to its length.

Kinds: ``email``, ``ip`` (each part at most 255), ``card`` (13 to 19 digits,
Luhn), ``phone`` (plus sign, 9 to 15 digits), and, announced by a word:
``iban`` (mod 97), ``account``, ``ssn`` and ``address`` (street and number), and
``login`` (a URL with a user name in it).

Defined results: a null or empty text has no spans; repeated rows and null ids
are rows like others; further columns are not read. Spans are code points, end
exclusive, leftmost and non-overlapping within a kind; a match that fails
validation is dropped and what it covers is not tried again.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import ahocorasick
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.functions import pandas_udf

from postlens.llm.common import map_columns

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = (*BASE_KINDS, "iban", "account", "ssn", "address", "login")
SPANS = "array<struct<kind:string,start:int,end:int>>"

# What stands at an anchor, by kind of anchor.
SCHEMES = ("http://", "https://", "ftp://", "ssh://")
ACCOUNT_CUES = ("account", "acct", "konto", "compte", "cuenta")
STREET_CUES = ("street", "avenue", "road", "straße", "strasse", "rue ", "calle ")
NAMED_CUES = (  # words of other uses, too: only with a name and in capitals
    "lane", "drive", "boulevard", "court", "place", "square", "terrace", "highway", "parkway", "crescent", "close", "way", "circle",
)

LOCAL = frozenset("abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
PHONE_RUN = re.compile(r"\+[0-9][\x20().0-9-]++")
SAYS = r"(?i:\x20?(?:numbers?|no|nr|num|nummer|numéro|número)\b)?(?i:\x20?\b(?:is|ist|est|es)\b)?"
IBAN = re.compile(SAYS + r"[.:=#\x20]{0,4}((?i:[A-Z]{2})[0-9]{2}(?:\x20?[A-Za-z0-9]){11,30})")
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BI": 27, "BR": 29, "BY": 28, "CH": 21,
    "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DJ": 27, "DK": 18, "DO": 28, "EE": 20, "EG": 29, "ES": 24, "FI": 18, "FK": 18, "FO": 18,
    "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28, "IE": 22, "IL": 23, "IQ": 23, "IS": 26,
    "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LC": 32, "LI": 21, "LT": 20, "LU": 20, "LV": 21, "LY": 25, "MC": 27, "MD": 24,
    "ME": 22, "MK": 19, "MN": 20, "MR": 27, "MT": 31, "MU": 30, "NI": 28, "NL": 18, "NO": 15, "OM": 23, "PK": 24, "PL": 28, "PS": 29,
    "PT": 25, "QA": 29, "RO": 24, "RS": 22, "RU": 33, "SA": 24, "SC": 31, "SD": 18, "SE": 24, "SI": 19, "SK": 24, "SM": 27, "SO": 23,
    "ST": 25, "SV": 28, "TL": 23, "TN": 24, "TR": 26, "UA": 29, "VA": 22, "VG": 24, "XK": 20, "YE": 30,
}
ACCOUNT = re.compile(r"(?i:\x20?(?:number|no|nr|num|nummer|numéro|número))?[.:#\x20]{1,4}([0-9](?:[\x20-]?[0-9]){5,16})(?![0-9])")
SSN = re.compile(SAYS + r"[.:=#\x20]{1,4}((?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}-(?!0000)[0-9]{4})(?![0-9])")
AUTHORITY = re.compile(r"([^\s/?#@<>\"']{1,256})@([A-Za-z0-9.-]+)")
NUMBER_BEFORE = re.compile(r"(?<![0-9A-Za-z])[0-9]{1,5}[a-z]?,? (?:[A-Z][a-zäöüßéè]+ ){0,3}(?:[A-Z][a-zäöüßéè]*)?$")
NUMBER_AFTER = re.compile(r" [0-9]{1,5}[a-z]?(?![0-9A-Za-z])")
NAME_NUMBER = re.compile(r"(?:[A-Za-zÄÖÜäöüßéèñáíóú]+ ){0,4}[A-Za-zÄÖÜäöüßéèñáíóú]+,? [0-9]{1,5}(?![0-9A-Za-z])")
WINDOW = 80  # of text that a street parser reads back


def automaton() -> ahocorasick.Automaton:
    found = ahocorasick.Automaton()
    needles = {"@": "at", "+": "plus"} | {d: "digit" for d in "0123456789"} | dict.fromkeys(SCHEMES, "scheme")
    words = dict.fromkeys(ACCOUNT_CUES, "account") | dict.fromkeys(STREET_CUES, "street") | dict.fromkeys(NAMED_CUES, "named") | {"iban": "iban", "ssn": "ssn", "social security": "ssn"}
    for needle, kind in needles.items():
        found.add_word(needle, (kind, len(needle)))
    for word, kind in words.items():
        found.add_word(word, (kind, len(word)))  # in a text in lower case
    found.make_automaton()
    return found


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) << (i & 1)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def is_digit(c: str) -> bool:
    return "0" <= c <= "9"


class Parser:
    """Parsers of one text. ``done[kind]`` is where the last match of a kind ended, valid or not."""

    def __init__(self, text: str):
        self.text, self.done, self.spans = text, dict.fromkeys(KINDS, 0), []

    def take(self, kind: str, start: int, end: int, valid: bool = True) -> None:
        self.done[kind] = end
        if valid:
            self.spans.append((kind, start, end))

    def at(self, i: int) -> None:
        text, first = self.text, i
        while first > self.done["email"] and text[first - 1] in LOCAL:
            first -= 1
        if first < i and (m := DOMAIN.match(text, i + 1)):
            self.take("email", first, m.end())

    def plus(self, i: int) -> None:
        if i < self.done["phone"] or not (m := PHONE_RUN.match(self.text, i)):
            return
        end = m.end()
        while not is_digit(self.text[end - 1]):
            end -= 1
        if end >= i + 4:
            self.take("phone", i, end, 9 <= len(only_digits(self.text[i:end])) <= 15)

    def digit(self, i: int) -> None:
        if i and is_digit(self.text[i - 1]):
            return
        if i >= self.done["ip"] and (m := IP.match(self.text, i)):
            self.take("ip", *m.span(), all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.groups()))
        if i >= self.done["card"] and (m := CARD.match(self.text, i)):
            digits = m[0].replace(" ", "").replace("-", "")
            self.take("card", *m.span(), 13 <= len(digits) <= 19 and luhn(digits))

    def cue(self, kind: str, start: int, end: int) -> None:
        """An announced number after a word that stands alone."""
        text = self.text
        if start < self.done[kind] or start and text[start - 1].isalpha():
            return
        m = {"iban": IBAN, "account": ACCOUNT, "ssn": SSN}[kind].match(text, end)
        if m and kind == "iban":
            first, last = m.span(1)
            if stop := iban_end(text, first, last):
                self.take(kind, first, stop)
        elif m:
            self.take(kind, *m.span(1))

    def scheme(self, end: int) -> None:
        if end >= self.done["login"] and (m := AUTHORITY.match(self.text, end)):
            self.take("login", *m.span())

    def street(self, start: int, end: int) -> None:
        text = self.text
        if start < self.done["address"]:
            return
        if text[end - 1] == " ":  # the name and number come after the word, or the number before it
            if start and text[start - 1].isalpha():
                return
            before = re.search(r"(?<![0-9A-Za-z])[0-9]{1,5},? $", text[max(0, start - 8) : start])
            if before and (m := re.compile(r"[A-ZÉÈ][\w'-]+(?: [A-ZÉÈ][\w'-]+){0,3}").match(text, end)):
                self.take("address", max(0, start - 8) + before.start(), m.end())
            elif text[start].isupper() and text[end : end + 1].isupper() and (m := NAME_NUMBER.match(text, end)):
                self.take("address", start, m.end())
            return
        if text[end : end + 1].isalpha():
            return
        window = max(self.done["address"], start - WINDOW)
        if text[end - 1] == "e" and (m := NUMBER_AFTER.match(text, end)):
            while start > window and text[start - 1].isalpha():
                start -= 1
            self.take("address", start, m.end())
        elif m := NUMBER_BEFORE.search(text[window:start]):
            self.take("address", window + m.start(), end)


    def named(self, start: int, end: int) -> None:
        """A number, a name of one word or more, and a word for a street."""
        text = self.text
        if start < self.done["address"] or not text[start].isupper() or text[start - 1 : start] != " " or text[end : end + 1].isalpha():
            return
        window = max(self.done["address"], start - WINDOW)
        if (m := NUMBER_BEFORE.search(text[window:start])) and any(c.isupper() for c in m[0]):
            self.take("address", window + m.start(), end)


def iban_end(text: str, first: int, last: int) -> int | None:
    """Where the account number that starts at ``first`` ends: by its country, or else the longest that is valid."""
    ends = [i + 1 for i in range(first, last) if text[i] != " "]  # by the number of characters
    length = IBAN_LENGTHS.get(text[first : first + 2].upper())
    for n in [length] if length else range(len(ends), 14, -1):
        if n <= len(ends) and not text[ends[n - 1] : ends[n - 1] + 1].isalnum() and iban_valid(text[first : ends[n - 1]]):
            return ends[n - 1]
    return None


def iban_valid(text: str) -> bool:
    body = text.replace(" ", "")
    return 15 <= len(body) <= 34 and int("".join(str(int(c, 36)) for c in body[4:] + body[:4])) % 97 == 1


def find(text: str | None, anchors: ahocorasick.Automaton) -> list[tuple[str, int, int]]:
    """All spans by kind as in ``KINDS``, then start."""
    if not text:
        return []
    parser = Parser(text)
    lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")  # ASCII letters only: the length stays
    for last, (kind, length) in anchors.iter(lower):
        if kind == "digit":
            parser.digit(last)
        elif kind == "at":
            parser.at(last)
        elif kind == "plus":
            parser.plus(last)
        elif kind == "scheme":
            parser.scheme(last + 1)
        elif kind == "street":
            parser.street(last + 1 - length, last + 1)
        elif kind == "named":
            parser.named(last + 1 - length, last + 1)
        else:
            parser.cue(kind, last + 1 - length, last + 1)
    return sorted(parser.spans, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


_ANCHORS: list[ahocorasick.Automaton] = []


def anchors() -> ahocorasick.Automaton:
    if not _ANCHORS:
        _ANCHORS.append(automaton())
    return _ANCHORS[0]


def masked(text: str | None) -> str | None:
    """The text with each item replaced by its kind in brackets; of overlapping items the one that starts first."""
    if not text:
        return text
    parts, at = [], 0
    for kind, start, end in sorted(find(text, anchors()), key=lambda s: (s[1], -s[2])):
        if start >= at:
            parts += [text[at:start], f"[{kind.upper()}]"]
        at = max(at, end)
    return "".join([*parts, text[at:]])


def find_pii(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(id_col, spans)`` for every row of ``df``; see ``find``."""

    def start():
        found, names = anchors(), ("kind", "start", "end")
        return lambda keys, texts: (keys, [[dict(zip(names, s)) for s in find(t, found)] for t in texts])

    kind = df.schema[id_col].dataType.simpleString()
    return map_columns(df.select(id_col, text_col), start, f"`{id_col}` {kind}, spans {SPANS}")


def mask_pii(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with personal data in ``text_col`` replaced by their kind; all columns and rows stay."""

    @pandas_udf("string")
    def mask(texts):
        return texts.map(masked, na_action="ignore").astype(object)

    return df.withColumn(text_col, mask(F.col(f"`{text_col}`")))


def joined(spans: Column) -> Column:
    """``kind:start:end`` of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
