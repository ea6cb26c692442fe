import numpy as np
import pyarrow as pa

from planlens.llm import langid
from planlens.llm import text as words
from planlens.llm.queries import op3_langid


def test_windows_cover_every_byte():
    texts = ["", "Ab", "x" * langid.WINDOW, "é" * 400, None]
    data, offsets = words.buffers(pa.array(texts, pa.string()))
    batch, owner, sizes = langid.windows(data, offsets)
    for i, text in enumerate(texts):
        rows = [bytes(w[:n]) for w, o, n in zip(batch, owner, sizes) if o == i]
        ascii_lower = bytes(c + 32 if 65 <= c <= 90 else c for c in (text or "").encode())
        assert b"".join(rows) == ascii_lower


def test_network_learns_and_gives_probabilities():
    texts = ["the and of that with"] * 30 + ["der die und das ist"] * 30
    samples, owner, _ = langid.windows(*words.buffers(pa.array(texts)))
    net = langid.fit(samples, np.repeat([0, 1], 30), ["de", "en"], epochs=15)
    p = langid.predict(net, *words.buffers(pa.array(["the of and", "und die der " * 500, "", None])))
    assert p[0, 0] > 0.5 and p[1, 1] > 0.5
    np.testing.assert_allclose(p.sum(1), 1)
    np.testing.assert_allclose(p[2], [0.5, 0.5])


def test_held_out_accuracy_and_fold(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op3_langid(spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).where("held_out").collect()
    assert len(rows) > 150
    assert np.mean([r.lang_pred == r.lang for r in rows]) >= 0.97


def test_edge_texts(spark, tables):
    documents = tables("documents")
    net = langid.learn(documents, documents.selectExpr("doc_id", "lang label"))
    odd = spark.createDataFrame(
        [(1, None, 1), (2, "", 1), (3, "123 !?", 1), (None, "the and of " * 9000, 1), (4, "的", 1), (4, "的", 1)],
        "doc_id long, text string, lang_pred int",
    )
    rows = langid.identify(odd, net).collect()
    assert [(r.lang_pred, r.score) for r in rows[:3]] == [("und", 0.0)] * 3
    assert rows[3].lang_pred == "en" and rows[4] == rows[5]
    kept = langid.keep_known(odd, net)
    assert kept.schema == odd.schema and 3 not in {r.doc_id for r in kept.collect()}
    assert langid.identify(odd.limit(0), net).collect() == []
    assert langid.learn(documents, documents.selectExpr("doc_id", "cast(null as string) label")) is None
    assert {r.lang_pred for r in langid.identify(odd, None).collect()} == {"und"}
    assert langid.keep_known(odd, None).collect() == []
