r"""Personal data: email and IP addresses, card and phone numbers, plain or disguised, by their places in the text.

Plain ones are found in the text itself. Disguised ones are found in a normalised copy, which a chain of small
transducers makes: look-alike letters and digits of other scripts, invisible characters, spelled digits, and words for
"at" and "dot". Each transducer carries for every character the place of the source it came from, so a span found in
the copy is mapped back to the source's characters. Places are code points, ends exclusive.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import partial

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from keyedload.functions.names import col
from keyedload.llm.common import prepare, text_of
from keyedload.llm.decontam import words_of

KINDS = ("email", "ip", "card", "phone")
SPAN_TYPE = T.ArrayType(
    T.StructType().add("kind", T.StringType()).add("start", T.IntegerType()).add("end", T.IntegerType()).add("base", T.BooleanType())
)

_LOCAL = re.compile(r"[A-Za-z0-9._%+-]")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A run of digits is an address's first part as a whole or not at all, so matches begin where runs do.
_IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
_DOTTED = re.compile(r"[0-9.]{7,}+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost matches of a local part, '@' and a domain. Looked for from each '@', so long words cost nothing."""
    taken, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > taken and _LOCAL.match(text[start - 1]):
            start -= 1
        domain = _DOMAIN.match(text, at) if start < at else None
        if domain:
            yield start, domain.end()
            taken = domain.end()
        at = text.find("@", max(taken, at + 1))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 if n > 9 else n
    return total % 10 == 0


def plain_spans(text: str) -> list[tuple[str, int, int]]:
    """Kind, start and end of each find, by start, then kind as listed."""
    out = [("email", s, e) for s, e in emails(text)]
    for m in (m for run in _DOTTED.finditer(text) for m in _IP.finditer(text, run.start(), run.end())):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:  # few are; the rest costs no more than the match
            digits = _NOT_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                out.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NOT_DIGIT.sub("", m[0])) <= 15:
                out.append(("phone", m.start(), m.end()))
    out.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return out


# Letters of other scripts that look like ASCII letters.
_LOOKALIKES = dict(
    zip(
        "аеорсухіјѕԁһԛԝвнкмтАВЕКМНОРСТХІЈЅοαιρυνκτΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijsdhqwbhkmtABEKMHOPCTXIJSoaipuvktABEZHIKMNOPTYX",
        strict=True,
    )
)
# Digits as words, in the order zero to nine.
_SPELLED = {
    w: str(i)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for i, w in enumerate(words.split())
}
# Words for "at" and "dot" in disguises.
_AT_WORDS, _DOT_WORDS, _PLUS_WORDS = "at|arroba|ät", "dot|punkt|punto|point", "plus|más"

_INVISIBLE = "\u00AD\u200B\u200C\u200D\u2060\uFEFF"
_FOREIGN = re.compile(f"[{_INVISIBLE}\u0370-\u052F\u0660-\u0669\u06F0-\u06F9\u0966-\u096F\u2460-\u24FF\uFF01-\uFF5E\U0001d400-\U0001d7ff]")
_OPEN, _CLOSE = r"\s{0,3}[(\[{<]\s{0,3}", r"\s{0,3}[)\]}>]\s{0,3}"
_DOT = rf"(?:{_OPEN}(?:{_DOT_WORDS}|\.){_CLOSE}|\s{{1,3}}(?:{_DOT_WORDS})\s{{1,3}})"
_WORD_DIGIT = "|".join(sorted(_SPELLED, key=len, reverse=True))
_DIGIT = rf"(?:{_WORD_DIGIT}|[0-9])"
_RUN = re.compile(
    rf"(?<![^\W_])(?:(?:{_PLUS_WORDS})[\x20-]|\+\x20?)?{_DIGIT}(?:(?:[\x20-]|\s{{0,3}}\.\s{{0,3}}|{_DOT}){_DIGIT}){{3,}}+(?![^\W_])", re.I
)
_RUN_PARTS = re.compile(
    rf"(?P<plus>{_PLUS_WORDS}|\+)|(?P<word>{_WORD_DIGIT})|(?P<digit>[0-9])|(?P<dot>{_DOT_WORDS}|\.)", re.I
)
_AT_MARK = re.compile(rf"(?<=[A-Za-z0-9]){_OPEN}(?:{_AT_WORDS}|@){_CLOSE}(?=[A-Za-z0-9])", re.I)
_AT_SPACED = re.compile(rf"(?<=[A-Za-z0-9])\s{{1,3}}(?:{_AT_WORDS})\s{{1,3}}(?=[A-Za-z0-9-]{{1,63}}{_DOT}[A-Za-z])", re.I)
_DOT_MARK = re.compile(rf"(?<=[A-Za-z0-9]){_DOT}(?=[A-Za-z0-9])", re.I)
_SPELLED_WORDS = {w.encode() for w in _SPELLED}
_DOT_BYTES = {w.encode() for w in _DOT_WORDS.split("|")}
_BRACKETED = re.compile(rf"[(\[{{<]\s{{0,3}}(?:[@.]|{_AT_WORDS}|{_DOT_WORDS})\s{{0,3}}[)\]}}>]", re.I)


class Traced:
    """Text with, for each character, the start and the end of what it came from."""

    def __init__(self, text: str, starts: list[int] | None = None, ends: list[int] | None = None):
        self.text = text
        self.starts = list(range(len(text))) if starts is None else starts
        self.ends = list(range(1, len(text) + 1)) if ends is None else ends

    def rewritten(self, changes: Iterator[tuple[int, int, str]]) -> Traced:
        """``changes`` are places and what stands there instead; a character of it came from the whole place."""
        parts, starts, ends, at = [], [], [], 0
        for start, end, instead in changes:
            parts += [self.text[at:start], instead]
            starts += self.starts[at:start]
            ends += self.ends[at:start]
            if instead:
                starts += [self.starts[start]] * len(instead)
                ends += [self.ends[end - 1]] * len(instead)
            at = end
        if not parts:
            return self
        return Traced("".join([*parts, self.text[at:]]), starts + self.starts[at:], ends + self.ends[at:])


def _plain_letter(c: str) -> str:
    if c in _INVISIBLE:
        return ""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    return folded if len(folded) == 1 and folded.isascii() else c


def _letters(t: Traced) -> Traced:
    return t.rewritten((m.start(), m.end(), _plain_letter(m[0])) for m in _FOREIGN.finditer(t.text))


def _digits(t: Traced) -> Traced:
    def changes() -> Iterator[tuple[int, int, str]]:
        for run in _RUN.finditer(t.text):
            tokens = list(_RUN_PARTS.finditer(t.text, run.start(), run.end()))
            if sum(m.lastgroup == "word" for m in tokens) < 2:
                continue
            at = run.start()
            for m in tokens:
                if m.start() > at:
                    yield at, m.start(), ""
                sign = {"plus": "+", "dot": "."}.get(m.lastgroup) or _SPELLED.get(m[0].lower(), m[0])
                yield m.start(), m.end(), sign
                at = m.end()
            if at < run.end():
                yield at, run.end(), ""

    return t.rewritten(changes())


def _marks(t: Traced) -> Traced:
    for pattern, sign in ((_AT_MARK, "@"), (_AT_SPACED, "@"), (_DOT_MARK, ".")):
        t = t.rewritten((m.start(), m.end(), sign) for m in pattern.finditer(t.text))
    return t


def _foreign(text: str) -> bool:
    """Whether a character that a transducer replaces occurs. Most texts are in Latin letters, which is quick to see."""
    if text.isascii():
        return False
    try:
        text.encode("latin-1")
    except UnicodeEncodeError:
        return bool(_FOREIGN.search(text))
    return "\u00ad" in text


def _may_spell(text: str, words: list[bytes]) -> bool:
    """Whether a run with two spelled digits may occur. In ASCII each of them is a word by itself; the pattern sees to the rest."""
    return not text.isascii() or sum(map(_SPELLED_WORDS.__contains__, words)) > 1


def normalised(text: str) -> Traced | None:
    """The text without disguises, or None where it shows no sign of one."""
    t = Traced(text) if _foreign(text) else None
    t = t and _letters(t)
    words = words_of(t.text if t else text)
    if _may_spell(t.text if t else text, words):
        t = _digits(t or Traced(text))
    if not _DOT_BYTES.isdisjoint(words) or _BRACKETED.search(t.text if t else text):
        t = _marks(t or Traced(text))
    return None if t is None or t.text == text else t


def spans_of(text: str) -> list[tuple[str, int, int, bool]]:
    """All spans of a text: plain ones (``base``), and disguised ones that no plain one of their kind covers."""
    plain = plain_spans(text)
    out = [(*x, True) for x in plain]
    clear = normalised(text)
    if clear is not None:
        for kind, s, e in plain_spans(clear.text):
            start, end = clear.starts[s], clear.ends[e - 1]
            if text[start:end] != clear.text[s:e] and not any(k == kind and a <= start and end <= b for k, a, b in plain):
                out.append((kind, start, end, False))
        out.sort(key=lambda x: (x[1], KINDS.index(x[0]), x[2]))
    return out


@partial(F.pandas_udf, returnType=SPAN_TYPE)
def _spans(parts: pd.Series) -> pd.Series:
    return pd.Series([[dict(zip(("kind", "start", "end", "base"), x)) for x in spans_of(t)] for t in parts], dtype=object)


@partial(F.pandas_udf, returnType=T.StringType())
def _redacted(parts: pd.Series) -> pd.Series:
    return pd.Series([redact(t) for t in parts], dtype=object)


def redact(text: str | None) -> str | None:
    """The text with each span replaced by its kind in brackets; spans that overlap are replaced together."""
    if not text:
        return text
    out, at, open_ = [], 0, None
    for kind, start, end, _ in spans_of(text):
        if open_ and start < open_[1]:
            open_ = (open_[0], max(open_[1], end))
            continue
        if open_:
            at = open_[1]
        out += [text[at:start], f"[{kind.upper()}]"]
        open_ = (start, end)
    return "".join([*out, text[open_[1] if open_ else 0 :]])


def find(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, spans`` of every row: kind, start, end and whether it stands there plainly.

    A null or empty text has no spans. Repeated rows and null ids are kept; other columns are not read.
    """
    prepare(docs.sparkSession)
    return docs.select(col(doc_id), _spans(text_of(text)).alias("spans"))


def redacted(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` with personal data replaced in ``text``; null texts stay null and no row goes."""
    prepare(docs.sparkSession)
    return docs.select(*[_redacted(col(c)).alias(c) if c == text else col(c) for c in docs.columns])


def listed(spans: Column | str) -> Column:
    """Spans as ``kind:start:end``, comma-joined."""
    spans = F.col(spans) if isinstance(spans, str) else spans
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))
