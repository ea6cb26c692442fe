"""Personal data in texts, also where it is disguised, as spans of the source.

Detectors find e-mail addresses, IP addresses, card and phone numbers in a plain text. A text
then passes a chain of small transducers, each of which rewrites one kind of disguise and
keeps, for what it wrote, the place it was read from: look-alike letters and invisible
characters, digits spelled as words, and words or brackets for "at" and "dot". The same
detectors run over the last text of the chain, and what they find there is mapped back,
transducer by transducer, to characters of the source. Only finds that a transducer had a
part in are added, and none that overlaps a plain find of its kind.
"""

from __future__ import annotations

import re
import unicodedata
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from planlens.llm.text import pieces, small_batches

KINDS = ("email", "ip", "card", "phone")
SPANS = "array<struct<kind: string, first: int, past: int>>"

Span = tuple[str, int, int]

# -- detectors ---------------------------------------------------------------------
# Each finds the leftmost matches that don't overlap, and looks at a character a bounded
# number of times: the plain patterns would try every place of a long word.

_AFTER_AT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = re.compile(r"[A-Za-z0-9._%+-]+")
# A match that starts inside a run of digits fails where one from the run's start fails.
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGITS = re.compile(r"[0-9]")


def emails(text: str) -> Iterator[tuple[int, int]]:
    free = 0  # where the last address ended, or the last "@" stood
    done = 0
    at = text.find("@")
    while at >= 0:
        after = _AFTER_AT.match(text, at)
        if after:
            before = _LOCAL.match(text[max(free, done):at][::-1])
            if before:
                yield at - before.end(), after.end()
                done = after.end()
        free = at + 1
        at = text.find("@", at + 1)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m[0].split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def luhn(digits: str) -> bool:
    """The checksum of card numbers: every second digit from the right counts double, as the
    sum of its digits."""
    total = sum(map(int, digits[-1::-2]))
    return (total + sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])) % 10 == 0


def cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() <= 37:  # 19 digits and what may stand between
            digits = "".join(_DIGITS.findall(m[0]))
            if 13 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 9 <= len(_DIGITS.findall(m[0])) <= 15:
            yield m.span()


def detect(text: str) -> list[Span]:
    """(kind, start, end) by kind, then start."""
    found = []
    for kind, find in zip(KINDS, (emails, ips, cards, phones)):
        found += [(kind, a, b) for a, b in find(text)]
    return found


# -- transducers -------------------------------------------------------------------

Edit = tuple[int, int, str]  # start and end in the text read, what is written instead


class Tape:
    """A text, and where its characters were read from."""

    def __init__(self, text: str, read: Tape | None = None, edits: list[Edit] = ()) -> None:
        self.read = read
        self.edits = edits
        if read is None:
            self.text = text
            return
        parts, at, size = [], 0, 0
        self.begins, self.ends = [], []  # of what each edit wrote
        for start, end, written in edits:
            parts += [text[at:start], written]
            size += start - at
            self.begins.append(size)
            size += len(written)
            self.ends.append(size)
            at = end
        parts.append(text[at:])
        self.text = "".join(parts)

    def rewrite(self, edits: list[Edit]) -> Tape:
        return Tape(self.text, self, edits) if edits else self

    def source(self, first: int, past: int) -> tuple[int, int, bool]:
        """The span of the source that ``[first, past)`` was read from, and whether an edit had
        a part in it."""
        if self.read is None:
            return first, past, False
        left = bisect_right(self.begins, first) - 1
        right = bisect_right(self.begins, past - 1) - 1
        # Between the two: what was written in the span, or left out inside it.
        edited = left < right or (left >= 0 and first < self.ends[left])

        def place(edit: int, at: int) -> tuple[int, int]:
            if edit < 0:
                return at, at + 1
            start, end, _ = self.edits[edit]
            if at < self.ends[edit]:
                return start, end
            return end + at - self.ends[edit], end + at - self.ends[edit] + 1

        a, b, before = self.read.source(place(left, first)[0], place(right, past - 1)[1])
        return a, b, edited or before


# Letters of other scripts that look like Latin ones.
_CYRILLIC = dict(zip("аАВсСеЕНһіІјЈКМоОрРѕЅТуУхХԁԛԝӏ", "aABcCeEHhiIjJKMoOpPsSTyYxXdqwl"))
_GREEK = dict(zip("αΑΒΕΖΗιΙΚΜνΝοΟρΡΤυΥΧγ", "aABEZHiIKMvNoOpPTuYXy"))
_OTHER = dict(zip("ıɑɡ。‐‑‒–—−﹣∙⋅", "iag.-------.."))
_LOOKALIKES = {**_CYRILLIC, **_GREEK, **_OTHER}
_INVISIBLE = frozenset("­᠎​‌‍‎‏⁠﻿")
_PLAIN = frozenset("²³¹ªº")  # small letters and digits of their own meaning


@lru_cache(maxsize=4096)
def lookalike(c: str) -> str | None:
    """The ASCII character that ``c`` looks like, an empty text for an invisible one, else
    None. Wide, mathematical and enclosed forms by their compatibility form, digits of other
    scripts by their value."""
    if c in _INVISIBLE:
        return ""
    if c in _LOOKALIKES:
        return _LOOKALIKES[c]
    if c in _PLAIN:
        return None
    digit = unicodedata.decimal(c, None)
    form = str(digit) if digit is not None else unicodedata.normalize("NFKC", c)
    return form if len(form) == 1 and form.isascii() else None


def fold(text: str) -> list[Edit]:
    """Look-alikes as ASCII, invisible characters left out."""
    if text.isascii():
        return []
    known = {c: to for c in set(text) if not c.isascii() and (to := lookalike(c)) is not None}
    if not known:
        return []
    any_of = re.compile("[" + "".join(map(re.escape, known)) + "]")
    return [(m.start(), m.end(), known[m[0]]) for m in any_of.finditer(text)]


# Digits as English, German, French and Spanish words.
_SPELLED = {
    word: str(digit)
    for words in (
        "zero one two three four five six seven eight nine",
        "null eins zwei drei vier fünf sechs sieben acht neun",
        "zéro un deux trois quatre cinq six sept huit neuf",
        "cero uno dos tres cuatro cinco seis siete ocho nueve",
    )
    for digit, word in enumerate(words.split())
}
_WORD_DIGIT = "(?:" + "|".join(sorted(_SPELLED, key=len, reverse=True)) + ")"
_EDGE, _STOP = r"(?<![^\W_])", r"(?![^\W_])"
_SPELLED_RUN = re.compile(
    rf"{_EDGE}(?:{_WORD_DIGIT}|[0-9]){_STOP}(?:[\x20,()-]{{1,3}}(?:{_WORD_DIGIT}|[0-9]){_STOP})+", re.I
)
_SPELLED_ONE = re.compile(rf"{_EDGE}{_WORD_DIGIT}{_STOP}", re.I)
_PLUS = re.compile(rf"{_EDGE}(?:plus|más)\x20+(?=\(?[0-9])", re.I)
_SEPARATORS = re.compile(r"[\x20,()-]+")


def spelled_digits(text: str) -> list[Edit]:
    """Runs of single digits, at least one of them a word, as the digits; a digit word between
    words for "dot" as a digit."""
    edits = []
    for m in _SPELLED_RUN.finditer(text):
        digits = [_SPELLED.get(w.lower(), w) for w in _SEPARATORS.split(m[0])]
        if _SPELLED_ONE.search(m[0]):
            edits.append((m.start(), m.end(), "".join(digits)))
    taken = [a for a, _, _ in edits]
    if _DOT_WORD.search(text):
        for m in _SPELLED_ONE.finditer(text):
            inside = bisect_right(taken, m.start()) - 1
            if inside >= 0 and m.start() < edits[inside][1]:
                continue
            before, after = text[max(0, m.start() - 12):m.start()], text[m.end():m.end() + 12]
            if _DOT_BEFORE.search(before) or _DOT_WORD.match(after):
                edits.append((m.start(), m.end(), _SPELLED[m[0].lower()]))
    return sorted(edits)


def spelled_plus(text: str) -> list[Edit]:
    """The word "plus" before a digit."""
    return [(m.start(), m.end(), "+") for m in _PLUS.finditer(text)]


_AT_NAME, _DOT_NAME = "(?:at|arroba)", "(?:dot|punto|punkt|point)"
_SPACE = r"[\x20\t]{0,3}"
_OPEN, _SHUT = rf"{_SPACE}[\[({{<]{_SPACE}", rf"{_SPACE}[\])}}>]{_SPACE}"
_AT_IN = re.compile(rf"{_OPEN}(?:{_AT_NAME}|@){_SHUT}", re.I)
_DOT_IN = re.compile(rf"{_OPEN}(?:{_DOT_NAME}|\.){_SHUT}", re.I)
_DOT_WORD = re.compile(rf"[\x20\t]{{1,3}}{_DOT_NAME}[\x20\t]{{1,3}}", re.I)
_DOT_BEFORE = re.compile(rf"[\x20\t]{{1,3}}{_DOT_NAME}[\x20\t]{{1,3}}$", re.I)
_DOT_OF_NUMBER = re.compile(rf"(?<=[0-9])[\x20\t]{{1,3}}{_DOT_NAME}[\x20\t]{{1,3}}(?=[0-9])", re.I)
_LABEL = "[A-Za-z0-9-]+"
_DOT = rf"(?:{_DOT_IN.pattern}|[\x20\t]{{1,3}}{_DOT_NAME}[\x20\t]{{1,3}}|[\x20\t]{{1,3}}\.[\x20\t]{{1,3}}|\.)"
_DOMAIN = re.compile(rf"{_LABEL}(?:{_DOT}{_LABEL})+", re.I)
_ANY_DOT = re.compile(_DOT, re.I)
_AT_APART = re.compile(
    rf"{_AT_IN.pattern}|(?:[\x20\t]{{1,3}}|(?<=[A-Za-z0-9])[-_]){_AT_NAME}(?:[\x20\t]{{1,3}}|[-_](?=[A-Za-z0-9]))"
    r"|[\x20\t]{1,3}@[\x20\t]{0,3}|@[\x20\t]{0,3}", re.I
)
# Last labels of domains that are believed after a bare word for "dot".
_LAST_LABELS = frozenset(
    "ai app at au be biz br ca ch cloud cn co com de dev edu es eu fr gov in info int io it jp mil"
    " me mx net nl org pl pt ru se tech test tv uk us xyz example invalid".split()
)


def bracketed(text: str) -> list[Edit]:
    """"[at]", "(dot)", "{.}" and the like as the character."""
    edits = [(m.start(), m.end(), "@") for m in _AT_IN.finditer(text)]
    edits += [(m.start(), m.end(), ".") for m in _DOT_IN.finditer(text)]
    edits.sort()
    kept: list[Edit] = []
    for edit in edits:
        if not kept or edit[0] >= kept[-1][1]:
            kept.append(edit)
    return kept


def _start_of_name(text: str, past: int, least: int) -> tuple[int, list[Edit]]:
    """Where the name before an "at" at ``past`` begins, with its words for "dot"."""
    edits, at = [], past
    while True:
        size = 64
        while True:
            name = _LOCAL.match(text[max(least, at - size):at][::-1])
            if not name or name.end() < size:
                break
            size *= 2
        if not name:
            return at, edits if at < past else []
        at -= name.end()
        dot = _DOT_BEFORE.search(text, max(least, at - 12), at)
        further = dot and _LOCAL.match(text[max(least, dot.start() - 1):dot.start()])
        if not further:
            return at, edits
        edits.append((dot.start(), dot.end(), "."))
        at = dot.start()


def spelled_addresses(text: str) -> list[Edit]:
    """"name at host dot com", "name @ host . com" and mixtures of them as addresses.

    A word for "at" needs a spelled or bracketed "dot" in the domain, and a known last label:
    "look at example.com" is left alone.
    """
    edits: list[Edit] = []
    done = 0
    for m in _AT_APART.finditer(text):
        if m.start() < done:
            continue
        domain = _DOMAIN.match(text, m.end())
        if not domain:
            continue
        labels = _ANY_DOT.split(domain[0])
        dots = [(d.start() + m.end(), d.end() + m.end(), ".") for d in _ANY_DOT.finditer(domain[0])]
        # The domain ends at its last known label; words after it are the sentence's.
        while labels and labels[-1].lower() not in _LAST_LABELS:
            labels.pop()
            if dots:
                dots.pop()
        if len(labels) < 2:
            continue
        spelled = [d for d in dots if d[1] - d[0] > 1]
        if "@" not in m[0] and not spelled:
            continue
        start, before = _start_of_name(text, m.start(), done)
        if start == m.start():
            continue
        own = [(m.start(), m.end(), "@")] if len(m[0]) > 1 else []
        edits += sorted(before) + own + spelled
        done = max([m.end(), *[d[1] for d in dots]])
    return edits


def spelled_dots(text: str) -> list[Edit]:
    """Words for "dot" between digits."""
    return [(m.start(), m.end(), ".") for m in _DOT_OF_NUMBER.finditer(text)]


CHAIN = (fold, spelled_digits, spelled_plus, spelled_addresses, bracketed, spelled_dots)


def disguised(text: str, plain: list[Span]) -> list[Span]:
    """Spans of ``text`` that only show after the chain, by kind, then start."""
    tape = Tape(text)
    for step in CHAIN:
        tape = tape.rewrite(step(tape.text))
    if tape.read is None:
        return []
    # Plain finds of a kind don't overlap: the last one that begins before an end decides.
    starts = {k: [a for kind, a, _ in plain if kind == k] for k in KINDS}
    ends = {k: [b for kind, _, b in plain if kind == k] for k in KINDS}
    added = []
    for kind, first, past in detect(tape.text):
        a, b, edited = tape.source(first, past)
        last = bisect_left(starts[kind], b) - 1
        if edited and (last < 0 or ends[kind][last] <= a):
            added.append((kind, a, b))
    return added


# -- DataFrames --------------------------------------------------------------------


def find_identifiers(docs: DataFrame) -> DataFrame:
    """(doc_id, text, plain, added) of each row of ``docs`` (doc_id, text).

    ``plain`` are the spans (kind, first, past) of the detectors in the text as it is, and
    ``added`` those that the chain uncovers, both by kind in the order of ``KINDS``, then
    start, in code points. Null and empty texts have none; repeated rows each have their row,
    an empty table none; further columns are left out, whatever their names. Nothing is
    shuffled, and the time is linear in the text.
    """
    small_batches(docs)
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    span_type = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("past", pa.int32())]))

    def as_rows(spans: list[Span]) -> list[dict]:
        return [{"kind": k, "first": a, "past": b} for k, a, b in spans]

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                plain, added = [], []
                for text in part.column("text"):
                    text = text.as_py() or ""
                    spans = detect(text)
                    plain.append(as_rows(spans))
                    added.append(as_rows(disguised(text, spans)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column("text"), pa.array(plain, span_type), pa.array(added, span_type)],
                    ["doc_id", "text", "plain", "added"],
                )

    return rows.mapInArrow(over, f"doc_id {kind}, text string, plain {SPANS}, added {SPANS}")


def listed(spans: Column) -> Column:
    """``kind:start:end`` of spans, comma-joined, by kind in the order of ``KINDS``, then
    start."""
    rank = F.array(*[F.lit(k) for k in KINDS])
    keyed = F.array_sort(F.transform(spans, lambda s: F.struct(
        F.array_position(rank, s["kind"]).alias("rank"), s["first"].alias("first"),
        s["past"].alias("past"), s["kind"].alias("kind"),
    )))
    return F.array_join(
        F.transform(keyed, lambda s: F.concat_ws(":", s["kind"], s["first"], s["past"])), ","
    )


def mask(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with every span, plain or added, replaced by its kind in angle brackets;
    of spans that overlap, the one that begins first, or else the longest, stands for all. A
    text without a span, null included, is unchanged."""
    order = F.array_sort(F.transform(F.concat("plain", "added"), lambda s: F.struct(
        s["first"].alias("first"), (-s["past"]).alias("back"), s["kind"].alias("kind")
    )))
    begun = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    text = F.col("text")
    walked = F.aggregate(
        order, begun,
        lambda done, s: F.when(
            s["first"] >= done["at"],
            F.struct(
                F.concat(
                    done["out"], F.substring(text, done["at"] + 1, s["first"] - done["at"]),
                    F.lit("<"), s["kind"], F.lit(">"),
                ).alias("out"),
                (-s["back"]).alias("at"),
            ),
        ).otherwise(F.struct(
            done["out"].alias("out"), F.greatest(done["at"], -s["back"]).alias("at")
        )),
    )
    found = find_identifiers(docs).withColumn("_walked", walked)
    rest = F.substring(text, F.col("_walked.at") + 1, F.length("text"))
    whole = F.when(F.size("plain") + F.size("added") == 0, text).otherwise(F.concat("_walked.out", rest))
    return found.select("doc_id", whole.alias("text"))
