"""One registered query per operator, over its whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from planlens.llm import (
    block_labeller, curriculum, decontaminate, langid, order_minhash, periodic_runs, pii, quality_rank,
    shingle_join, token_alignment, token_rollup, toxicity, warc,
)
from planlens.llm.oracle import ORACLE_SQL
from planlens.llm.sampling import fold
from planlens.session import delete_on_exit, settle, shared_folder

__all__ = ["QUERIES", "ORACLE_SQL"]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


ARCHIVE_DATE = "2024-01-01T00:00:00Z"


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    folder = warc.new_folder(spark)
    delete_on_exit(spark, folder)
    archives = warc.write(pages, folder, date=ARCHIVE_DATE)
    kind = pages.schema["page_id"].dataType
    return warc.read(archives, payloads=False).select(
        F.col("page_id").cast(kind).alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast(kind).alias("refers_to"),
    )


def op2_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.compare_with_edit(_table(spark, sf_dir, "documents"))


def op3_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    labelled = documents.where(fold(F.col("doc_id"), 4) != 2)
    net = langid.learn(documents, labelled.select("doc_id", F.col("lang").alias("label")))
    return langid.identify(documents, net).select(
        "doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "lang_pred", "score"
    )


def training_labels(spark: SparkSession, sf_dir: str, label: str) -> DataFrame:
    """(doc_id, label) of the rows that may be learnt from."""
    labels = _table(spark, sf_dir, "labels").select("doc_id", F.col(label).alias("label"))
    return labels.where(fold(F.col("doc_id"), 5) != 0)


def _decided(scored: DataFrame, threshold: float, *more: Column) -> DataFrame:
    return scored.select(
        "doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), *more,
    )


def op4_quality_rank(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    ranking = quality_rank.learn(documents, training_labels(spark, sf_dir, "quality"))
    return _decided(quality_rank.score(documents, ranking), 0.3)


def op5_token_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents are loaded under ``words-1``; those of less than 20 words are deleted;
    of those of several lines the first is cut off; those not in English move on to
    ``pieces-1``. Two of the batches are sent twice."""
    untitled = F.regexp_replace("text", r"^[^\n]*\n", "")
    counted = settle(_table(spark, sf_dir, "documents").select(
        "source", "lang", F.contains("text", F.lit("\n")).alias("titled"),
        token_rollup.pattern_count(F.col("text"), "words-1").alias("loaded"),
        token_rollup.pattern_count(untitled, "words-1").alias("revised"),
        token_rollup.pattern_count(untitled, "pieces-1").alias("moved"),
    ))
    kept = counted.where("loaded >= 20")
    under = lambda rows, version, tokens: rows.select(
        "source", "lang", F.lit(version).alias("tokenizer"), F.col(tokens).alias("tokens")
    )
    load = token_rollup.inserts(under(counted, "words-1", "loaded"))
    short = token_rollup.deletes(under(counted.where("loaded < 20"), "words-1", "loaded"))
    titles = token_rollup.revisions(kept.where("titled").select(
        "source", "lang", F.lit("words-1").alias("tokenizer"),
        F.col("loaded").alias("old_tokens"), F.col("revised").alias("tokens"),
    ))
    foreign = kept.where("lang is distinct from 'en'")
    upgrade = token_rollup.deletes(under(foreign, "words-1", "revised")).union(
        token_rollup.inserts(under(foreign, "pieces-1", "moved"))
    )
    folder = f"{shared_folder(spark)}/rollup/{uuid.uuid4().hex}"
    delete_on_exit(spark, folder)
    rollup = token_rollup.Rollup(spark, folder)
    for batch, changes in [
        ("load", load), ("short", short), ("load", load), ("titles", titles), ("upgrade", upgrade),
        ("titles", titles),
    ]:
        rollup.apply(batch, changes)
    return rollup.totals()


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    benchmark = _table(spark, sf_dir, "benchmark")
    return decontaminate.report(decontaminate.find_spans(documents, benchmark))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    near = toxicity.learn(documents, training_labels(spark, sf_dir, "toxic"))
    scored = toxicity.score(documents, spark.sparkContext.broadcast(near))
    nearest = F.try_element_at("evidence", F.lit(1))
    return _decided(
        scored, 0.5, nearest["doc_id"].alias("nearest_id"), nearest["cosine"].alias("nearest_cosine")
    )


def op8_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    sized = _table(spark, sf_dir, "documents").select(
        "doc_id", "source", curriculum.word_count(F.col("text")).alias("size")
    )
    placed = curriculum.place_documents(sized)
    position = lambda k: F.try_element_at("copies", F.lit(k))["position"]
    # A second copy follows a first one: the stream starts over only when it has ended.
    return placed.select(
        "doc_id", "size", "source_size", "target", "taken",
        position(1).alias("first_position"), position(2).alias("second_position"),
    )


def op9_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shingle_join.link_counts(_table(spark, sf_dir, "documents"))


def op10_block_labeller(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = _table(spark, sf_dir, "pages")
    return block_labeller.extract(pages, block_labeller.learn(pages))


def with_planted_runs(documents: DataFrame) -> DataFrame:
    """(doc_id, text): with h the CRC-32 of the id and g = h // 10, where h is a multiple of 10
    the words from number a = g % n repeat with period p = 1 + (n - a) // (3 + g % 8)."""
    h = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    words = F.regexp_extract_all("text", F.lit(r"([^\x20\x09-\x0D]+)"), F.lit(1))
    g = F.floor(F.col("_h") / 10)
    a, n = F.col("_a"), F.col("_n")
    period = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
    unit = F.slice("_words", a + 1, F.col("_p"))
    copies = F.ceil((n - a) / F.col("_p")).cast("int")
    repeated = F.slice(F.flatten(F.array_repeat(unit, copies)), F.lit(1), n - a)
    planted = F.array_join(F.concat(F.slice("_words", F.lit(1), a), repeated), " ")
    return (
        documents.select("doc_id", "text", h.alias("_h"))
        .withColumn("_words", F.when(F.col("_h") % 10 == 0, words))
        .withColumn("_n", F.size("_words"))
        .withColumn("_a", F.when(n > 0, (g % n).cast("int")))
        .withColumn("_p", period)
        .select("doc_id", F.when(n > 0, planted).otherwise(F.col("text")).alias("text"))
    )


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs.find_runs(with_planted_runs(_table(spark, sf_dir, "documents")))
    best = periodic_runs.strongest(F.col("runs"))
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    listed = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    return found.withColumn("best", best).select(
        "doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"),
        F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"),
        F.floor(F.expr("(1000 * best.length) div best.period")).alias("exponent_milli"),
        F.sha2(listed, 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


TOKENIZERS = "/opt/tokenizers"  # public vocabulary files, read by the driver


def op12_token_alignment(
    spark: SparkSession, sf_dir: str, tokenizers: str = TOKENIZERS
) -> DataFrame:
    return token_alignment.align(
        _table(spark, sf_dir, "documents"),
        f"{tokenizers}/byte_bpe_50k.json", f"{tokenizers}/piece_bpe_32k.model",
    )


def op13_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts are those of the plain spans; ``n_added`` counts the disguised ones."""
    found = pii.find_identifiers(_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("plain", lambda s: s["kind"] == kind)).cast("long")
    return found.select(
        "doc_id", *[count(kind).alias(f"n_{kind}") for kind in pii.KINDS],
        F.sha2(pii.listed(F.col("plain")), 256).alias("base_sha256"),
        pii.listed(F.concat("plain", "added")).alias("spans"),
        F.size("added").cast("long").alias("n_added"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_warc": op1_warc,
    "op2_order_minhash": op2_order_minhash,
    "op3_langid": op3_langid,
    "op4_quality_rank": op4_quality_rank,
    "op5_token_rollup": op5_token_rollup,
    "op6_decontaminate": op6_decontaminate,
    "op7_toxicity": op7_toxicity,
    "op8_mix": op8_mix,
    "op9_shingle_join": op9_shingle_join,
    "op10_block_labeller": op10_block_labeller,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_token_alignment": op12_token_alignment,
    "op13_pii": op13_pii,
}
