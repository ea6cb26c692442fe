import time
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from planlens.llm import text as words
from planlens.llm import toxicity as tox
from planlens.llm.decontaminate import words as word_list
from planlens.llm.queries import op7_toxicity, training_labels


def random_vectors(n, terms, rng):
    out = []
    for _ in range(n):
        t = np.sort(rng.choice(terms, rng.integers(0, 6), replace=False))
        w = rng.random(len(t)) + 0.1
        out.append((t, w / np.sqrt((w * w).sum()) if len(t) else w))
    return out


def test_nearest_are_exact_and_blocks_are_skipped():
    rng = np.random.default_rng(4)
    examples, queries = random_vectors(900, 40, rng), random_vectors(150, 40, rng)
    index = tox.BlockMaxIndex(examples, 40)
    dense = np.zeros((900, 40))
    for i, (t, w) in enumerate(examples):
        dense[i, t] = w
    visited = asked = 0
    for t, w in queries:
        if not len(t):
            continue
        q = np.zeros(40)
        q[t] = w
        cosine = np.round(dense @ q, 12)
        expected = sorted((i for i in range(900) if cosine[i] > 0), key=lambda i: (-cosine[i], i))[:7]
        found, near, blocks = index.nearest(t, w, 7)
        assert found.tolist() == expected
        np.testing.assert_allclose(near, cosine[expected], atol=1e-9)
        visited, asked = visited + blocks, asked + 1
    assert visited < 0.8 * asked * index.blocks


def test_vectors_are_tf_idf_of_length_one():
    hashes, _ = words.word_hashes(*words.buffers(pa.array(["bad worse"])))
    vocabulary = tox.Vocabulary(hashes, np.array([1.0, 2.0]))
    idf = dict(zip(vocabulary.hashes.tolist(), vocabulary.idf))
    found = vocabulary.vectors(*words.buffers(pa.array(["Bad bad, worse x", "x", None])))
    assert len(found[1][0]) == len(found[2][0]) == 0
    raw = [(1 + np.log(2 if h == hashes[0] else 1)) * idf[h] for h in vocabulary.hashes.tolist()]
    np.testing.assert_allclose(found[0][1], np.array(raw) / np.linalg.norm(raw))


def test_planted_words_are_caught(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = op7_toxicity(spark, sf_dir).join(
        spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "lang"), "doc_id"
    ).join(spark.read.parquet(f"{sf_dir}/labels.parquet"), "doc_id").where("held_out").collect()
    toxic = [r.predicted for r in rows if r.toxic and r.lang == "en"]
    other = [r.predicted for r in rows if not r.toxic]
    assert toxic and np.mean(toxic) >= 0.9 and np.mean(other) <= 0.02


def test_edge_rows_and_nothing_to_learn(spark, tables):
    documents = tables("documents")
    odd = spark.createDataFrame(
        [(1, None, "s"), (1, "", "s"), (None, "idiot " * 30000, "s"), (2, "?", "s"), (2, "?", "s")],
        "doc_id long, text string, score string",
    )
    labels = training_labels(spark, "/root/testdata/sf0.001", "toxic")
    for labelled in (labels, labels.where("label = 0"), labels.limit(0)):
        near = tox.learn(documents, labelled)
        rows = tox.score(odd, spark.sparkContext.broadcast(near)).collect()
        assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
        assert rows[0].score == rows[1].score and rows[0].evidence == []
        assert tox.score(odd.limit(0), spark.sparkContext.broadcast(near)).collect() == []
    near = tox.learn(documents.limit(0), labels)
    assert tox.score(odd, spark.sparkContext.broadcast(near)).count() == 5


def test_ids_of_any_type(spark, tables):
    documents = tables("documents").withColumn("doc_id", F.concat(F.lit("d"), "doc_id"))
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").select(
        F.concat(F.lit("d"), "doc_id").alias("doc_id"), F.col("toxic").alias("label")
    )
    scored = tox.score(documents, spark.sparkContext.broadcast(tox.learn(documents, labels)))
    assert scored.count() == documents.count()
    assert scored.schema["evidence"].dataType.elementType["doc_id"].dataType.simpleString() == "string"


def test_neighbours_and_scores_by_brute_force(spark, tables):
    """Every labelled text is an example: counts, weights, cosines and votes by plain loops."""
    documents, labels = tables("documents"), tables("labels").select("doc_id", F.col("toxic").alias("label"))
    near = tox.learn(documents, labels)
    texts = {r.doc_id: Counter(word_list(r.text)) for r in documents.select("doc_id", "text").collect()}
    label = {r.doc_id: r.label for r in labels.collect() if r.label is not None and r.doc_id in texts}
    prior = sum(label.values()) / len(label)
    frequency = Counter(w for t in texts.values() for w in t)
    toxic = Counter(w for d, x in label.items() if x for w in texts[d])
    other = Counter(w for d, x in label.items() if not x for w in texts[d])
    n_toxic, n_other = sum(label.values()), len(label) - sum(label.values())

    def weight(w):
        a, c = toxic[w], other[w]
        ratio = 0.0
        for side, size in ((a, n_toxic), (c, n_other)):
            for seen, share in ((side, (a + c) / len(label)), (size - side, 1 - (a + c) / len(label))):
                ratio += 2 * seen * np.log(seen / (share * size)) if seen else 0.0
        gain = 1.0
        if a * n_other > c * n_toxic and ratio >= tox.LEAST_RATIO:
            n, z = a + c, tox.SURE
            low = (a / n + z * z / (2 * n) - z * np.sqrt(a * c / n**3 + z * z / (4 * n * n))) / (1 + z * z / n)
            gain += tox.GAIN * max(0.0, (low - prior) / (1 - prior))
        return (np.log((1 + len(texts)) / (1 + frequency[w])) + 1) * gain

    known = {w: weight(w) for d in label for w in texts[d]}
    assert any(tox.GAIN / 4 < g for g in near.vocabulary.idf / near.vocabulary.idf.min())

    def vector(text):
        v = {w: (1 + np.log(n)) * known[w] for w, n in text.items() if w in known}
        length = np.sqrt(sum(x * x for x in v.values()))
        return {w: x / length for w, x in v.items()}

    examples = {d: vector(texts[d]) for d in sorted(label)}
    scored = tox.score(documents, spark.sparkContext.broadcast(near)).collect()
    assert len(scored) == len(texts)
    for row in scored[::7]:
        v = vector(texts[row.doc_id])
        cosine = {d: sum(x * e.get(w, 0.0) for w, x in v.items()) for d, e in examples.items()}
        best = sorted((-round(x, 9), d) for d, x in cosine.items() if x > 0)[:tox.NEIGHBOURS]
        np.testing.assert_allclose([e.cosine for e in row.evidence], [-x for x, _ in best], atol=1e-8)
        assert all(abs(cosine[e.doc_id] - e.cosine) < 1e-8 and e.toxic == label[e.doc_id] for e in row.evidence)
        if best:  # every label is an example, so that all voices weigh alike
            voice = [1 / (1 - min(e.cosine, 1) + tox.SOFTNESS) for e in row.evidence]
            rest = 1 / (1 + tox.SOFTNESS)
            vote = (sum(x for x, e in zip(voice, row.evidence) if e.toxic) + rest * prior) / (sum(voice) + rest)
            np.testing.assert_allclose(row.score, near.calibrated(vote), atol=1e-6)


def test_a_copy_of_an_example_has_it_as_nearest(spark):
    """Also without any word that is telling, and with words that one example has alone."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{x}" for x in rng.integers(0, 900, 30)) + f" only{i}" for i in range(60)]
    docs = spark.createDataFrame(list(enumerate(texts + texts)), "doc_id long, text string")
    labels = spark.createDataFrame([(i, int(i % 3 == 0)) for i in range(60)], "doc_id long, label int")
    rows = tox.score(docs, spark.sparkContext.broadcast(tox.learn(docs, labels))).collect()
    assert len(rows) == 120
    for r in rows:
        assert r.evidence[0].doc_id == r.doc_id % 60 and abs(r.evidence[0].cosine - 1) < 1e-9
        assert r.evidence[0].toxic == (r.doc_id % 3 == 0)


def test_frequent_and_rare_words_with_copies_and_left_out_examples():
    """Cosines of many queries at once, equal ones by example number, whatever is asked along."""
    rng = np.random.default_rng(8)
    share = 1 / (1 + np.arange(2000))  # some words are in most examples, most in a few

    def vector():
        t = np.unique(np.append(rng.choice(2000, 40, p=share / share.sum()), rng.choice(2000, 3)))
        w = rng.random(len(t)) + 0.1
        return t, w / np.sqrt((w * w).sum())

    examples = [vector() for _ in range(700)]
    examples += examples[:100]
    index = tox.BlockMaxIndex(examples, 2000)
    assert 10 < len(index.rows) < 500
    dense = np.zeros((800, 2000))
    for i, (t, w) in enumerate(examples):
        dense[i, t] = w
    for skip, queries in ((False, [vector() for _ in range(90)]), (True, examples)):
        for i, ((t, w), part) in enumerate(zip(queries, index.frequent(queries))):
            cosine = np.round(dense[:, t] @ w, 10)
            expected = sorted(
                (e for e in np.flatnonzero(cosine) if not (skip and e == i)), key=lambda e: (-cosine[e], e)
            )[:25]
            found, near, _ = index.nearest(t, w, 25, i if skip else -1, part)
            assert found.tolist() == expected
            np.testing.assert_allclose(near, cosine[expected], atol=1e-9)
            alone = index.nearest(t, w, 25, i if skip else -1)
            assert alone[0].tolist() == expected and alone[1].tolist() == near.tolist()


def test_frequent_words_cost_less_than_a_pass_over_the_examples_each():
    rng = np.random.default_rng(9)
    vectors = []
    for _ in range(2000):
        t = np.sort(rng.choice(400, 200, replace=False))
        w = rng.random(200) + 0.1
        vectors.append((t, w / np.sqrt((w * w).sum())))
    near = tox.Neighbourhood(
        None, tox.BlockMaxIndex(vectors, 400), np.arange(2000) % 2.0, [], np.ones(2000), 0.5, 0.5
    )
    queries = vectors[:150]
    assert len(list(near.votes(queries[:1]))) == 1
    start = time.process_time()
    for t, w in queries:
        total = np.zeros(near.index.rows.shape[1])
        for r, f in zip(near.index.row[t], w):
            total += f * near.index.rows[r]
    plain, start = time.process_time() - start, time.process_time()
    assert len(list(near.votes(queries))) == 150
    assert time.process_time() - start < 0.7 * plain
