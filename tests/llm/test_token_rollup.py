import pytest
from pyspark.sql import functions as F

from planlens.llm import token_rollup as tr

COLUMNS = "source string, lang string, tokenizer string, tokens long"


@pytest.fixture
def rollup(spark, tmp_path):
    return tr.Rollup(spark, f"file://{tmp_path}/rollup")


def state(rollup):
    return {tuple(r)[:3]: (r.documents, r.tokens) for r in rollup.totals().collect()}


def test_signed_batches_count_once(spark, rollup):
    rows = lambda *r: spark.createDataFrame(r, COLUMNS)
    load = tr.inserts(rows(("a", "en", "v1", 10), ("a", "en", "v1", 5), (None, None, "v1", 7), ("b", "de", "v1", None)))
    assert state(rollup) == {}
    assert rollup.apply("1", load) and not rollup.apply("1", load)
    expected = {("a", "en", "v1"): (2, 15), (None, None, "v1"): (1, 7), ("b", "de", "v1"): (1, 0)}
    assert state(rollup) == expected
    revised = spark.createDataFrame([("a", "en", "v1", 10, 4)], "source string, lang string, tokenizer string, old_tokens long, tokens long")
    assert rollup.apply("2", tr.revisions(revised))
    assert rollup.apply("3", tr.deletes(rows((None, None, "v1", 7))))
    expected = {("a", "en", "v1"): (2, 9), ("b", "de", "v1"): (1, 0)}
    assert state(rollup) == expected
    rollup.compact()
    assert state(rollup) == expected
    assert not rollup.apply("2", tr.revisions(revised))
    assert rollup.apply("4", tr.inserts(rows(("b", "de", "v2", 3))))
    rollup.compact()
    assert rollup.apply("5", load.limit(0))
    assert state(rollup) == expected | {("b", "de", "v2"): (1, 3)}


def test_only_one_of_two_senders_commits(spark, rollup, monkeypatch):
    load = tr.inserts(spark.createDataFrame([("a", "en", "v1", 10)], COLUMNS))
    assert rollup.apply("1", load)
    monkeypatch.setattr(rollup, "committed", lambda batch: False)  # as seen before the other's commit
    assert not rollup.apply("1", load)
    assert state(rollup) == {("a", "en", "v1"): (1, 10)}


def test_a_batch_that_breaks_off_leaves_no_trace(spark, rollup):
    load = tr.inserts(spark.createDataFrame([("a", "en", "v1", 10)], COLUMNS))
    broken = load.withColumn("tokens", F.expr("raise_error('lost')").cast("long"))
    with pytest.raises(Exception, match="lost"):
        rollup.apply("1", broken)
    assert state(rollup) == {}
    assert rollup.apply("1", load)
    assert state(rollup) == {("a", "en", "v1"): (1, 10)}
    with pytest.raises(ValueError, match="not a batch name"):
        rollup.apply("../x", load)


def test_counts_of_edge_texts(spark):
    texts = spark.createDataFrame([(None,), ("",), (" \n",), ("a b-c é1",), ("x " * 100000,)], "text string")
    rows = texts.select(*[tr.pattern_count(F.col("text"), k).alias(k) for k in tr.PATTERNS]).collect()
    assert [tuple(r) for r in rows] == [(0, 0), (0, 0), (0, 0), (3, 5), (100000, 100000)]


def test_byte_pair_counts(spark, tables):
    public = pytest.importorskip("public_tokenizers")
    file = public.path("byte_bpe_50k.tiktoken")
    count = tr.bpe_counter(file, public.PATTERN)
    rows = tables("documents").select("text", count("text").alias("n")).collect()
    encoding = tr._encoding(file, public.PATTERN)
    assert [r.n for r in rows] == [len(encoding.encode_ordinary(r.text)) for r in rows]
    assert spark.createDataFrame([(None,)], "text string").select(count("text").alias("n")).first().n == 0


def test_a_batch_committed_during_a_compaction_counts_once(spark, rollup, monkeypatch):
    rows = lambda n: tr.inserts(spark.createDataFrame([("a", "en", "v1", n)], COLUMNS))
    rollup.apply("1", rows(5))
    whole = rollup._sum

    def late(base, commits):
        monkeypatch.undo()
        rollup.apply("2", rows(10))
        return whole(base, commits)

    monkeypatch.setattr(rollup, "_sum", late)
    rollup.compact()
    assert state(rollup) == {("a", "en", "v1"): (2, 15)}
    rollup.compact()
    assert state(rollup) == {("a", "en", "v1"): (2, 15)} and not rollup.apply("2", rows(10))
