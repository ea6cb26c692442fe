import numpy as np
import pyarrow as pa
import pytest

from planlens.llm import quality_rank as qr
from planlens.llm import text as words
from planlens.llm.queries import op4_quality_rank, training_labels


def of(*texts):
    return qr.features(*words.buffers(pa.array(texts, pa.string())))


def test_features_are_per_text():
    texts = ["Plain words here.", "", None, "A\nA\nB", "é漢 !!", "x" * 5000]
    together = of(*texts)
    assert together.shape == (len(texts), qr.FEATURES)
    for text, row in zip(texts, together):
        np.testing.assert_allclose(of(text)[0], row)
    assert of("A\nA\nB")[0, -2] == pytest.approx(1 / 3)  # repeated lines


def test_preferences_are_learnt_and_the_threshold_splits():
    rng = np.random.default_rng(0)
    good = [" ".join(rng.choice(["alpha", "beta", "gamma"], 20)) for _ in range(80)]
    bad = [" ".join(rng.choice(["ALPHA!!", "###", "$$$"], 20)) for _ in range(20)]
    x, y = of(*good, *bad), np.array([True] * 80 + [False] * 20)
    ranking = qr.fit(x, y, 0.8, pairs=2000)
    p = ranking.score(x)
    assert p[y].min() > p[~y].max()
    assert p[y].min() >= ranking.threshold > p[~y].max()


def test_nothing_to_prefer_scores_the_share():
    ranking = qr.fit(of("a", "b"), np.array([True, True]), 1.0)
    assert (ranking.score(of("a", "", None)) > 0.9).all()
    empty = qr.fit(np.zeros((0, qr.FEATURES)), np.zeros(0, bool), 0.5)
    assert empty.score(of("a")) == pytest.approx(0.5)


def test_quantile_is_that_of_all_rows(spark):
    rng = np.random.default_rng(3)
    scores = np.concatenate([rng.random(300) * 1e-9, rng.random(500), np.full(200, 0.25)])
    frame = spark.createDataFrame([(float(s),) for s in scores], "score double")
    ranked = np.sort(scores)
    for rejected in (1, 299, 300, 450, 999):
        assert qr.quantile(frame, rejected / 1000) == (ranked[rejected - 1] + ranked[rejected]) / 2
    assert qr.quantile(frame, 0.0) == 0.0 and qr.quantile(frame.limit(0), 0.5) == 0.0


def test_the_share_rejected_is_that_of_bad_labels(spark):
    """Also where the labelled texts aren't distributed as the documents are."""
    rng = np.random.default_rng(6)
    text = lambda bad: " ".join("##" if rng.random() < bad else "word" for _ in range(40))
    rows = [(i, text(0.05 + 0.9 * rng.random() ** 2)) for i in range(400)]
    labelled = [(i, int(i % 4 != 0)) for i in range(400, 600)]
    rows += [(i, text(0.0 if label else 1.0)) for i, label in labelled]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    ranking = qr.learn(docs, spark.createDataFrame(labelled, "doc_id long, label int"))
    other = docs.where("doc_id < 400")
    assert qr.keep_good(other, ranking).count() == pytest.approx(300, abs=8)


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op4_quality_rank(spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id"
    ).where("held_out").collect()
    assert np.mean([r.predicted == r.quality for r in rows]) >= 0.95


def test_filter_keeps_columns_and_edge_rows_have_scores(spark, tables):
    documents = tables("documents")
    ranking = qr.learn(documents, training_labels(spark, "/root/testdata/sf0.001", "quality"))
    odd = spark.createDataFrame(
        [(1, None, 5), (1, "", 5), (None, "x " * 50000, 5), (2, "Same text.", 5), (2, "Same text.", 5)],
        "doc_id long, text string, score int",
    )
    scored = qr.score(odd, ranking).collect()
    assert len(scored) == 5 and all(0 <= r.score <= 1 for r in scored)
    assert scored[3].score == scored[4].score
    kept = qr.keep_good(odd, ranking)
    assert kept.schema == odd.schema
    assert {r.doc_id for r in kept.collect()} <= {1, 2, None}
    assert qr.score(odd.limit(0), ranking).collect() == []
    none = qr.learn(documents, spark.createDataFrame([], "doc_id long, label int"))
    assert qr.score(odd, none).count() == 5
