"""Training-data pipeline over ``documents``: five stages, each written and read again.

1. toxicity: documents that the model predicts as toxic go.
2. near_dedup: of each group of near duplicates the document with the smallest id stays.
3. substring_dedup: passages that an earlier document holds nearly alike are cut out of the others.
4. decontamination: documents that benchmark passages contaminate go.
5. mixing: how often each document goes into the mix; documents that it does not take go.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.llm import decontaminate, mixing, near_dedup, substring_dedup, toxicity
from cliplake.llm.queries import HELD_OUT, table
from cliplake.operators import ordered
from cliplake.runtime import Scratch, staged


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents not predicted as toxic; the model learns from the labels that are not held out."""
    rows = toxicity.training_rows(docs, table(spark, sf_dir, "labels"), remainder=HELD_OUT)
    scored = toxicity.toxicity(docs, toxicity.fit(rows))
    return scored.where("predicted = 0").select("row.*")


def _keyed(docs: DataFrame) -> DataFrame:
    """Every row as ``row`` with a number ``_key`` of its own, in the order of doc_id.

    That is the id where all rows have ids of their own.  Otherwise rows are numbered by id and
    content, those without an id last, so that no text is lost to another row's id.
    """
    rows, ids = docs.agg(F.count(F.lit(1)), F.count_distinct("doc_id")).first()
    packed = docs.select("doc_id", F.struct("*").alias("row"))
    if rows == ids:
        return packed.withColumnRenamed("doc_id", "_key")
    content = packed.withColumn("_content", F.sha2(F.to_json("row"), 256))
    order = [F.asc_nulls_last("doc_id"), "_content"]
    return ordered.with_position(content, order, "_key", Scratch(docs.sparkSession)).select("_key", "row")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per component of near duplicates (shingles of five words, similarity 0.8).

    Rows that share an id, and rows without one, are documents of their own.
    """
    keyed = _keyed(docs)
    found = near_dedup.near_duplicates(keyed.select(F.col("_key").alias("doc_id"), "row.text"))
    kept = found.where("kept").select(F.col("doc_id").alias("_key"))
    # Most rows are kept, so this join is left to Spark and its size statistics.
    return keyed.join(kept, "_key", "left_semi").select("row.*")


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that documents of smaller ids have; n_chars follows.

    A document of which no word is left goes; one that had none stays.
    """
    keyed = _keyed(docs).select("_key", "row", "row.text")
    spans = substring_dedup.repeated_spans(keyed, id="_key")
    cut = substring_dedup.without_spans(keyed, spans, id="_key")
    had = F.coalesce(F.col("row.text").rlike(mixing.WORD), F.lit(False))
    left = cut.where(~had | F.col("text").rlike(mixing.WORD))
    chars = F.length("text").cast(docs.schema["n_chars"].dataType)
    return left.select(F.col("row").withField("text", F.col("text")).withField("n_chars", chars).alias("row")).select("row.*")


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which benchmark windows cover less than a twentieth of the words."""
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    clean = (F.col("found.n_hit") == 0) | (
        decontaminate.SHARE * F.col("found.n_hit") < F.col("found.n_words")
    )
    return found.where(clean).select("row.*")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents of the mix with size, source_size, target, copies and taken; where documents
    have such a column the new one is called mix_size and so on."""
    keyed = _keyed(docs)
    mix = mixing.mixed(keyed.select(F.col("_key").alias("doc_id"), "row.source", "row.text")).where("copies > 0")
    names = [name for name in mix.columns if name not in ("doc_id", "source")]
    facts = mix.select(F.col("doc_id").alias("_key"), F.struct(*names).alias("mix"))
    new = [F.col("mix")[name].alias(f"mix_{name}" if name in docs.columns else name) for name in names]
    return keyed.join(facts, "_key").select("row.*", *new)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_dedup", drop_near_duplicates),
    ("substring_dedup", cut_repeated_passages),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
]
#: Language models, hash-based candidates and cuts of texts have no SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to the documents, each on the written result of the one before."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = staged(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
