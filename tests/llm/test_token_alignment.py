import hashlib
from collections import Counter, defaultdict
from itertools import accumulate

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from planlens.llm import token_alignment as ta
from planlens.llm.queries import TOKENIZERS, op12_token_alignment

FILES = (f"{TOKENIZERS}/byte_bpe_50k.json", f"{TOKENIZERS}/piece_bpe_32k.model")


def tokens_of(text):
    """(id, bytes) of both tokenizers, straight from the libraries; none if they don't give the
    text back."""
    import sentencepiece
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(FILES[0])
    tokenizer.encode_special_tokens = True
    to_byte = {c: bytes([b]) for c, b in ta.byte_alphabet().items()}
    model = sentencepiece.SentencePieceProcessor(model_file=FILES[1])
    a = tokenizer.encode(f" {text}", add_special_tokens=False)
    a = [(i, b"".join(to_byte[c] for c in t)) for i, t in zip(a.ids, a.tokens)]
    b = []
    for i in model.encode(text):
        piece = model.id_to_piece(i)
        b.append((i, bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace("▁", " ").encode()))
    whole = f" {text}".encode()
    return (a, b) if b"".join(t for _, t in a) == whole == b"".join(t for _, t in b) else ([], [])


def brute_force(texts):
    """Every pair of byte ranges, every document."""
    documents, rows = defaultdict(set), []
    for k, text in enumerate(texts):
        a, b = tokens_of(text) if text else ([], [])
        a_ends, b_ends = ([*accumulate(len(t) for _, t in side)] for side in (a, b))
        links = []
        for i, e in enumerate(a_ends):
            for j, f in enumerate(b_ends):
                if max(e - len(a[i][1]), f - len(b[j][1])) < min(e, f):
                    links.append((a[i][0], b[j][0]))
        common = sorted(set(a_ends) & set(b_ends))
        groups, last = [], 0
        for end in common:
            inside = lambda side, ends: ",".join(str(t[0]) for t, e in zip(side, ends) if last < e <= end)  # noqa: B023, E731
            groups.append(f"{inside(a, a_ends)}|{inside(b, b_ends)}")
            last = end
        for pair in links:
            documents[pair].add(k)
        rows.append((len(a), len(b), len(groups), links, hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    count = {p: len(d) for p, d in documents.items()}
    best = Counter()
    for (a, _), n in count.items():
        best[a] = max(best[a], n)
    return [
        (n_a, n_b, n_g, len(ln), sum(count[p] == best[p[0]] for p in ln), sum(count[p] for p in ln), sha)
        for n_a, n_b, n_g, ln, sha in rows
    ]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 40), st.data()), min_size=1, max_size=4))
def test_alignment_is_every_pair_of_ranges(cases):
    """Random ends of several texts; either side may be the shorter."""
    a_ends, b_ends, a_bounds, b_bounds, at = [], [], [0], [0], 0
    for size, data in cases:
        for ends, bounds in ((a_ends, a_bounds), (b_ends, b_bounds)):
            inner = data.draw(st.sets(st.integers(1, size)))
            ends += sorted(at + e for e in inner | {size})
            bounds.append(len(ends))
        at += size
    found = ta.Alignment(*map(np.array, (a_ends, a_bounds, b_ends, b_bounds)))
    begin = lambda ends, k: ends[k - 1] if k else 0
    pairs = [
        (i, j) for i in range(len(a_ends)) for j in range(len(b_ends))
        if max(begin(a_ends, i), begin(b_ends, j)) < min(a_ends[i], b_ends[j])
    ]
    assert list(zip(found.a.tolist(), found.b.tolist())) == pairs
    common = sorted(set(a_ends) & set(b_ends))
    assert [a_ends[k] for k in found.a_last] == common == [b_ends[k] for k in found.b_last]


@given(st.lists(st.integers(0, 300), min_size=1, unique=True), st.data())
def test_gallop_from_anywhere(values, data):
    within = np.array(sorted(values))
    wanted = np.array(data.draw(st.lists(st.integers(-5, int(within[-1])), min_size=1)))
    start = np.array([data.draw(st.integers(0, len(within) - 1)) for _ in wanted])
    n = np.zeros(len(wanted), np.int64)
    assert ta.gallop(wanted, within, n, n + len(within), start).tolist() == np.searchsorted(within, wanted).tolist()


TEXTS = [
    "Hello, world! The unbelievable tokenization.", "Hello, world! The unbelievable tokenization.", None, "", " ",
    "naïve café — 東京 😀 é́", "a <|endoftext|> b </s> <unk>", "two  spaces\n\nand\ttabs ", "▁under", "nul \x00 in",
    "1234567890" * 9, "x" * 300, "Ünïcödé " * 20, "the the the", "int main() { return 0; }",
]


def test_query_is_brute_force(spark, tmp_path):
    rows = [(k, t) for k, t in enumerate(TEXTS)] + [(None, "the end"), (3, "the end")]
    frame = spark.createDataFrame([(*r, 1, "p") for r in rows], "doc_id long, text string, piece int, a_ids string")
    frame.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = [tuple(r) for r in op12_token_alignment(spark, str(tmp_path)).collect()]
    expected = [(i, *e) for (i, _), e in zip(rows, brute_force([t for _, t in rows]))]
    assert sorted(got, key=str) == sorted(expected, key=str)
    assert sum(e[1] == 0 for e in expected) >= 3  # null, empty, not given back


def test_result_does_not_depend_on_the_pieces(spark, tables, monkeypatch):
    docs = tables("documents").limit(60)
    whole = sorted(map(tuple, ta.align(docs, *FILES).collect()))
    monkeypatch.setattr(ta, "PIECE_BYTES", 3000)
    batch = pa.RecordBatch.from_pylist([{"text": t} for (t,) in docs.select("text").collect()])
    assert len(list(ta._pieces(iter([batch])))) > 5
    assert sorted(map(tuple, ta.align(docs.repartition(7), *FILES).collect())) == whole
    texts = {r.doc_id: r.text for r in docs.collect()}
    expected = {i: e for i, e in zip(texts, brute_force([t[:400] for t in texts.values()]))}
    short = spark.createDataFrame([(i, t[:400]) for i, t in texts.items()], "doc_id long, text string")
    assert {r[0]: tuple(r)[1:] for r in ta.align(short, *FILES).collect()} == expected


def test_long_text_empty_table_and_links(spark):
    docs = spark.createDataFrame([("a", "word und mehr, " * 100_000)], "doc_id string, text string")
    row = ta.align(docs, *FILES).first()
    assert row.doc_id == "a" and row.n_links == row.n_a + row.n_b - row.n_groups
    assert row.n_a > 300_000 and row.count_sum == row.n_links
    empty = ta.align(docs.limit(0), *FILES)
    assert empty.collect() == [] and empty.columns == [
        "doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256",
    ]
    make = ta.readers(spark, *FILES)
    one = spark.createDataFrame([(1, "x"), (2, None), (3, "Hello there")], "doc_id long, text string")
    found = {r.doc_id: (r.a, r.b) for r in ta.links(one, make).collect()}
    assert found[2] == ([], []) and found[1][0][0] == 0 and max(found[3][0]) + 1 == len(tokens_of("Hello there")[0])


@pytest.mark.parametrize("text", ["plain text", "naïve 😀", "</s><s> [INST]", " nbsp", "tabs\t\n"])
def test_entries_give_the_text_back(spark, text):
    for kind, path in zip((ta.ByteLevel, ta.Pieces), FILES):
        with open(path, "rb") as file:
            tokenizer = kind(file.read())
        assert b"".join(tokenizer.entries[i] for i in tokenizer.encode([text])[0]) == f" {text}".encode()


@pytest.fixture(scope="module")
def byte_level():
    with open(FILES[0], "rb") as file:
        return ta.ByteLevel(file.read())


def test_both_libraries_merge_alike(byte_level, tables):
    assert byte_level._merger is not None
    texts = [r.text for r in tables("documents").collect()] + [t or "" for t in TEXTS]
    assert byte_level.encode(texts) == byte_level._plainly(texts)
    every = "".join(map(chr, [9, 10, 13, *range(32, 127), *range(0xA1, 0x250), *range(0x2010, 0x205F), *range(0x20A0, 0x20C0)]))
    singles = [c for c in every] + [f"a{c}b {c}{c}1 {c}" for c in every]
    assert byte_level.encode(singles) == byte_level._plainly(singles)


@settings(max_examples=300, deadline=None)
@given(text=st.text(st.sampled_from("abz's t're1 9.,!\n\t\r\u00e9\u00df\u00b2\u00aa\u00d7\u2019\u2014\u20ac\u00a0\U0001f600<|>"), max_size=60))
def test_both_libraries_cut_alike(byte_level, text):
    assert byte_level.encode([text]) == byte_level._plainly([text])
