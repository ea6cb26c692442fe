import gzip
import hashlib
import io

import numpy as np
import pytest

from planlens.llm import warc

DATE = "2024-01-01T00:00:00Z"


def member(i, payload, **more):
    return warc.record(str(i), f"http://x/{i}", payload, hashlib.sha1(payload).hexdigest(), DATE, **more)


class Trickle(io.BytesIO):
    """Gives a few bytes at a time, whatever is asked for."""

    def read(self, n=-1):
        return super().read(min(n, 37))


@pytest.mark.parametrize("kind", [io.BytesIO, Trickle])
def test_records_round_trip(kind):
    rng = np.random.default_rng(0)
    payloads = [b"", b"x", "é漢\r\n\r\nWARC/1.1\r\n".encode(), rng.bytes(300_000), b"a" * 5_000_000]
    archive = b"".join(member(i, p) for i, p in enumerate(payloads)) + member(9, payloads[4], refers_to="4", revisit=True)
    rows = list(warc.records(kind(archive)))
    assert [r["error"] for r in rows] == [None] * 6
    assert [r["payload"] for r in rows[:5]] == payloads
    last = rows[5]
    assert (last["record_type"], last["payload"], last["payload_bytes"], last["refers_to"]) == ("revisit", None, 5_000_000, "4")
    assert last["payload_digest"] == rows[4]["payload_digest"] == hashlib.sha1(payloads[4]).hexdigest()
    assert last["refers_to_record"] == rows[4]["record_id"]


def test_one_member_per_record():
    archive = member(1, b"one") + member(2, b"two")
    assert gzip.decompress(archive).count(b"WARC/1.1\r\n") == 2
    assert gzip.decompress(member(1, b"one")).endswith(b"one\r\n\r\n")


def test_damage_costs_one_record():
    parts = [member(i, bytes([65 + i]) * 3000) for i in range(4)]
    broken = bytearray(parts[1])
    broken[len(broken) // 2] ^= 0xFF
    rows = list(warc.records(io.BytesIO(parts[0] + bytes(broken) + parts[2] + parts[3][:-20])))
    assert [r["error"] is None for r in rows if r.get("page_id") in ("0", "2")] == [True, True]
    assert {r.get("page_id") for r in rows if r["error"] is None} == {"0", "2"}
    assert "within a record" in rows[-1]["error"]
    assert list(warc.records(io.BytesIO(b""))) == []


def test_damage_up_to_the_edge_of_a_piece(monkeypatch):
    """The next member starts just where a piece of the file does."""
    parts = [member(i, bytes(np.random.default_rng(i).bytes(900))) for i in range(3)]
    broken = bytearray(parts[0])
    broken[-8] ^= 0xFF  # its checksum
    monkeypatch.setattr(warc, "PIECE", len(parts[0]))
    rows = list(warc.records(io.BytesIO(bytes(broken) + parts[1] + parts[2])))
    assert [r.get("page_id") for r in rows] == [None, "1", "2"] and rows[0]["error"]


def test_digests_and_lengths_are_verified():
    good = gzip.decompress(member(1, b"payload " * 20))
    for old, new in ((b"payload payload", b"payload PAYLOAD"), (b"Content-Length: 2", b"Content-Length: 1")):
        assert old in good
        at = good.rindex(old) if b"Length" not in old else good.index(old)
        bad = good[:at] + new + good[at + len(old):]
        (row,) = warc.records(io.BytesIO(gzip.compress(bad)))
        assert row["error"]


def test_archives_of_a_table(spark, tmp_path):
    big, url = "long text " * 200, "http://a/\r\nX: y"
    rows = [(1, url, big, "x"), (5, None, big, "x"), (3, "u", big, "x"), (7, "u", "short", "x"), (8, "u", "short", "x"),
            (9, "u", None, "x"), (None, "u", big, "x"), (10, "u", "é" * 600, "x"), (10, "u", "é" * 600, "x"), (11, "", "", "x")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string, payload string")
    archives = warc.write(pages.repartition(3), f"file://{tmp_path}/w", date=DATE)
    assert archives.selectExpr("sum(records) n").first().n == len(rows)
    got = {}
    for r in warc.read(archives).collect():
        assert r.error is None
        got.setdefault(r.page_id, []).append((r.record_type, r.refers_to, r.payload_bytes))
        html = {str(i): h for i, _, h, _ in rows}.get(r.page_id, big)
        assert r.payload_digest == hashlib.sha1((html or "").encode()).hexdigest()
        if r.record_type == "response":
            assert r.payload.decode() == (html or "")
    assert got == {
        "1": [("revisit", "5", 2000)], "3": [("revisit", "5", 2000)], None: [("revisit", "5", 2000)],
        "5": [("response", None, 2000)], "7": [("response", None, 5)], "8": [("response", None, 5)],
        "9": [("response", None, 0)], "10": [("response", None, 1200)] * 2, "11": [("response", None, 0)],
    }


def test_empty_table(spark, tmp_path):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    archives = warc.write(pages, f"file://{tmp_path}/w", date=DATE)
    assert warc.read(archives).collect() == []
