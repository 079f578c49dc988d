"""Registered queries of the subpackage: each applies one operator to its whole table."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    decontaminate,
    fixity,
    hard_negatives,
    lexical_search,
    licenses,
    mixing,
    near_dedup,
    quality_rules,
    substring_dedup,
    token_counts,
    toxicity,
    url_rules,
)

#: Public vocabulary of the token counts; a path on the driver.
VOCABULARY = os.environ.get("UNIGRAM_VOCABULARY", "/opt/tokenizers/piece_bpe_32k.model")
#: Public byte-level BPE model; a path on the driver.
BPE_MODEL = os.environ.get("BYTE_BPE_MODEL", "/opt/tokenizers/byte_bpe_50k.json")
URL_RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
#: Labels are learnt from rows whose crc32(doc_id) by 3 leaves another remainder.
HELD_OUT = 1
#: Pages of one archive.
ARCHIVE_PAGES = 500


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every document under the public vocabulary, searched as a unigram model."""
    pieces = token_counts.shared_vocabulary(spark, VOCABULARY)
    counted = token_counts.token_counts(table(spark, sf_dir, "documents"), pieces, keep=["doc_id"])
    return counted.select("row.doc_id", "found.n_words", "found.n_tokens")


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document; labels of the held-out remainder are not used."""
    docs = table(spark, sf_dir, "documents")
    rows = toxicity.training_rows(docs, table(spark, sf_dir, "labels"), remainder=HELD_OUT)
    scored = toxicity.toxicity(docs, toxicity.fit(rows), keep=["doc_id"])
    return scored.select(
        "row.doc_id",
        (toxicity.fold("row.doc_id") == HELD_OUT).alias("held_out"),
        "score",
        "predicted",
    )


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the page archives that a damaged replica changed or lost.

    The replica is derived from the table: one page in 97 has letters overwritten, one in 101 is lost.
    """
    pages = table(spark, sf_dir, "pages")
    archive = F.concat(F.lit("pages-"), F.floor(F.col("page_id") / ARCHIVE_PAGES).cast("string"))
    layout = ("page_id", archive, "page_id", "url", "html")
    overwritten = F.when(
        F.col("page_id") % 97 == 3, F.translate("html", "e", "3")
    ).otherwise(F.col("html"))
    replica = fixity.records(pages.withColumn("html", overwritten), *layout).where("id % 101 <> 5")
    found = fixity.audit(fixity.records(pages, *layout), replica)
    return found.select("archive", F.col("id").alias("page_id"), F.col("offset").alias("byte_offset"), "status")


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    found = url_rules.judged(table(spark, sf_dir, "pages"), URL_RULES, keep=["page_id"])
    return found.select("row.page_id", "host", "path", "rule", "verdict")


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Passages of 50 words and more that an earlier document has nearly alike."""
    spans = substring_dedup.repeated_spans(table(spark, sf_dir, "documents"))
    return spans.select(
        "doc_id",
        F.col("source").alias("source_doc_id"),
        "start_word",
        "end_word",
        (F.col("end_word") - F.col("start_word")).alias("n_words"),
    )


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digest of every canonical text, the licence it is, and the notices among its lines."""
    found = licenses.scanned(table(spark, sf_dir, "documents"))
    return found.withColumn("notices", F.concat_ws(",", "notices"))


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of every document inside occurrences of benchmark windows."""
    found = decontaminate.judged(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), keep=["doc_id"]
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", "items").cast("binary"), 256).alias("items_sha256"),
        "contaminated",
    )


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose sets of 4-word shingles are similar by 0.8."""
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"), size=4, percent=80)


def op9_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of every document the mix takes."""
    return mixing.mixed(table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken"
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals of every document, the plain rules and the verdict of the line model."""
    docs = table(spark, sf_dir, "documents")
    model = quality_rules.fit(docs, table(spark, sf_dir, "labels"))
    found = quality_rules.judged(docs, spark.sparkContext.broadcast(model), keep=["doc_id"])
    return found.select("row.doc_id", *found.columns[1:9])


def op11_bpe_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Digests of the ids of every document, and of the text that the ids spell."""
    model = bpe.shared_model(spark, BPE_MODEL)
    encoded = bpe.encode(table(spark, sf_dir, "documents"), model, keep=["doc_id"])
    decoded = bpe.decode(encoded.select("row.doc_id", "found.ids"), model)
    ids = F.col("row.ids")
    return decoded.select(
        "row.doc_id",
        F.size(ids).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(ids.cast("array<string>"), ",").cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("found.text").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of other labels that score close below the positives of every hundredth vector.

    Every seventh row carries a wrong label.
    """
    rows = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 100 == 0, label=label)


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 highest-scoring documents of every benchmark item."""
    found = lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(F.col("item").alias("item_id"), "rank", F.col("id").alias("doc_id"), "score")


QUERIES = {
    f.__name__: f
    for f in (
        op1_token_counts,
        op2_toxicity,
        op3_warc_fixity,
        op4_url_filters,
        op5_substring_dedup,
        op6_license_scan,
        op7_benchmark_decontamination,
        op8_minhash_dedup,
        op9_source_mixing,
        op10_quality_rules,
        op11_bpe_roundtrip,
        op12_hard_negatives,
        op13_ranked_search,
    )
}
