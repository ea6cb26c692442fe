import hashlib
import re
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from planlens.llm import pii
from planlens.llm.queries import op13_pii

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def good(kind, found):
    digits = re.findall("[0-9]", found)
    if kind == "ip":
        return all(int(p) <= 255 for p in found.split("."))
    if kind == "card":
        doubled = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(digits))]
        return 13 <= len(digits) <= 19 and sum(d - 9 * (d > 9) for d in doubled) % 10 == 0
    return kind == "email" or 9 <= len(digits) <= 15


def brute_force(text):
    """The patterns as they are stated."""
    return [
        (kind, *m.span()) for kind, p in PATTERNS.items() for m in re.finditer(p, text) if good(kind, m[0])
    ]


@settings(max_examples=400, deadline=None)
@given(st.one_of(
    st.text("a1.@-+ %é()", max_size=60), st.text("0123456789. -+()", max_size=80),
    st.lists(st.sampled_from(["a@b.c", "@", "1.2.3.4", "255", "256", ".", " ", "4111111111111111", "+1 (476) 555-1234", "x", "-", "😀", "0000000001"])).map("".join),
))
def test_detectors_are_the_patterns(text):
    assert pii.detect(text) == brute_force(text)


DISGUISED = [
    ("email", "mail ", "john [at] example [dot] com", " now"),
    ("email", "", "john.doe(at)example(dot)co(dot)uk", "."),
    ("email", "write to ", "john dot doe at example dot com", " today"),
    ("email", "", "JOHN AT EXAMPLE DOT COM", ""),
    ("email", "a ", "user at example (dot) com", ", ok"),
    ("email", "", "user@example[.]com", ""),
    ("email", "x, ", "john @ example . com", "; y"),
    ("email", "x, ", "john @ example.com", "; y"),
    ("email", "é ", "jоhn@exаmple.com", " ж"),
    ("email", "", "ｊｏｎ＠ｅｘ．ｃｏｍ", " b"),
    ("email", "w ", "jo​hn@exam­ple.com", ""),
    ("email", "correo ", "juan arroba ejemplo punto es", " hoy"),
    ("phone", "call ", "plus one five five five one two three four five six seven", "."),
    ("phone", "call ", "+one (five five five) one two three four five six seven", "."),
    ("phone", "", "+١ 555 123 4567", " a"),
    ("card", "card ", "four one one one one one one one one one one one one one one one", " end"),
    ("card", "Karte ", "vier eins eins eins eins eins eins eins eins eins eins eins eins eins eins eins", ""),
    ("card", "", "4１11 1111 1111 1111", ""),
    ("ip", "host ", "192[.]168[.]1[.]10", " up"),
    ("ip", "host ", "10 dot 0 dot 0 dot 1", " up"),
    ("ip", "host ", "one nine two dot one six eight dot one dot five", " up"),
]


@pytest.mark.parametrize("kind, before, hidden, after", DISGUISED)
def test_disguised_span_is_that_of_the_source(kind, before, hidden, after):
    text = before + hidden + after
    assert pii.detect(text) == []
    assert pii.disguised(text, []) == [(kind, len(before), len(before) + len(hidden))]


@pytest.mark.parametrize("text", [
    "look at example.com and at a polka dot dress", "one of two, one two three", "meet at noon dot",
    "El uno, dos y tres. Un deux trois.", "3 x² + 2² = 12", "see (a.) and [at] once", "",
    "Москва а о е", "1 2 3 4 5 6 7 8 9", "we sat at dot com parties", "plus 5 (dot)",
])
def test_clean_text_is_left_alone(text):
    assert pii.detect(text) == [] and pii.disguised(text, []) == []


def test_plain_finds_stay_and_are_not_found_twice():
    text = "4111 1111 1111 1111, а@b.com a@b.com x at y dot com +1 (476) 555-1234"
    plain = pii.detect(text)
    assert [text[a:b] for _, a, b in plain] == ["a@b.com", "4111 1111 1111 1111", "+1 (476) 555-1234"]
    assert [text[a:b] for _, a, b in pii.disguised(text, plain)] == ["а@b.com", "x at y dot com"]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=30), st.data())
def test_tapes_map_back(text, data):
    """What no edit touched maps to itself; what one wrote, to all that it read."""
    tape, source = pii.Tape(text), [(k, k + 1) for k in range(len(text))]
    for _ in range(data.draw(st.integers(0, 3))):
        edits, at, spans = [], 0, []
        while at < len(tape.text):
            if data.draw(st.booleans()):
                size = data.draw(st.integers(1, 3))
                end = min(at + size, len(tape.text))
                written = data.draw(st.text("xy", max_size=3))
                edits.append((at, end, written))
                spans += [(source[at][0], source[end - 1][1])] * len(written)
                at = end
            else:
                spans.append(source[at])
                at += 1
        tape, source = tape.rewrite(edits), spans
    assert len(source) == len(tape.text)
    for a in range(len(source)):
        for b in range(a + 1, len(source) + 1):
            assert tape.source(a, b)[:2] == (source[a][0], source[b - 1][1])


@pytest.mark.parametrize("unit", [
    "a", "1", "1.", " ", "a@", "@a.b", "one ", " at ", "a dot ", "at a dot com ", "! at a dot com ", "( ", "[at]", "+1 ",
])
def test_time_is_linear(unit):
    text = unit * (400_000 // len(unit))
    start = time.process_time()
    pii.disguised(text, pii.detect(text))
    assert time.process_time() - start < 10


ROWS = [
    (1, "write a@b.com or c at d dot com"), (1, "write a@b.com or c at d dot com"), (2, None), (3, ""),
    (None, "😀 1.2.3.4 and 1.2.3.999"), (4, "x " * 500_000 + "a@b.com"), (5, "clean"),
]


def test_query_on_odd_rows(spark, tmp_path):
    frame = spark.createDataFrame([(*r, "e", 1) for r in ROWS], "doc_id long, text string, plain string, added int")
    frame.write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op13_pii(spark, str(tmp_path)).collect()]
    expected = []
    for i, text in ROWS:
        base = brute_force(text or "")
        joined = ",".join(f"{k}:{a}:{b}" for k, a, b in base)
        more = [("email", 17, 31)] if i == 1 else []
        spans = ",".join(f"{k}:{a}:{b}" for k, a, b in sorted(base + more, key=lambda s: (list(PATTERNS).index(s[0]), s[1])))
        counts = [sum(k == kind for k, _, _ in base) for kind in PATTERNS]
        expected.append((i, *counts, hashlib.sha256(joined.encode()).hexdigest(), spans, len(more)))
    assert sorted(got, key=str) == sorted(expected, key=str)
    empty = pii.find_identifiers(frame.limit(0))
    assert empty.collect() == []


def test_query_is_the_patterns_on_the_documents(spark, tables):
    got = {r.doc_id: r.spans for r in op13_pii(spark, "/root/testdata/sf0.001").collect()}
    texts = {r.doc_id: r.text for r in tables("documents").collect()}
    assert got == {i: ",".join(f"{k}:{a}:{b}" for k, a, b in brute_force(t or "")) for i, t in texts.items()}


def test_mask(spark):
    masked = [(r.doc_id, r.text) for r in pii.mask(spark.createDataFrame(ROWS, "doc_id long, text string")).collect()]
    assert sorted(masked, key=str) == sorted([
        (1, "write <email> or <email>"), (1, "write <email> or <email>"), (2, None), (3, ""),
        (None, "😀 <ip> and 1.2.3.999"), (4, "x " * 500_000 + "<email>"), (5, "clean"),
    ], key=str)
