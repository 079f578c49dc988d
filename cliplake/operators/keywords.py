"""Keywords, TF-IDF, summaries and sentiment over a table of transcripts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cliplake import schemas
from cliplake.functions import terms, text
from cliplake.params import TextParams
from cliplake.runtime import staged

# At most so many terms are broadcast.
FREQUENT = 500_000


def _ranked_list(df: DataFrame, key: str, order: list, limit: int, item, name: str) -> DataFrame:
    """One array of the first ``limit`` items per key.

    The rank filter keeps at most ``limit`` rows per key in every task before the shuffle.
    """
    rank = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    best = df.withColumn("rank", rank).where(F.col("rank") <= limit)
    listed = F.sort_array(F.collect_list(F.struct("rank", item.alias("item"))))
    return best.groupBy(key).agg(F.transform(listed, lambda entry: entry["item"]).alias(name))


def term_lists(transcripts: DataFrame) -> DataFrame:
    """Terms of each transcript, stop words kept: doc_id, length, terms.

    ``length`` is the number of tokens, ``terms`` holds each term once with its count ``n`` and the
    ``position`` of its first occurrence, the most frequent first, ties by position.  Both are null
    for placeholders and null transcripts.

    Occurrences are counted inside their row, in Arrow batches, without a shuffle.
    """
    content = F.when(~text.is_placeholder(F.col("transcript")), F.lower("transcript"))
    counts = T.StructType.fromDDL(f"length int, terms {schemas.TERMS}")
    schema = T.StructType([transcripts.schema["doc_id"], *counts])
    return transcripts.select("doc_id", content.alias("content")).mapInArrow(terms.count_terms, schema)


def keyword_list(listed: Column, params: TextParams = TextParams()) -> Column:
    """The most frequent terms of a term list without stop words; empty without any.

    Stop words can only push the last keyword back by their own number.
    """
    foremost = F.slice(listed, 1, params.keywords + len(text.STOP_WORDS))
    kept = F.filter(foremost, lambda t: ~t["term"].isin(*text.STOP_WORDS))
    found = F.transform(
        F.slice(kept, 1, params.keywords),
        lambda t: F.struct(t["term"].alias("word"), t["n"].alias("frequency")),
    )
    return F.coalesce(found, F.array()).cast(schemas.KEYWORDS)


def keywords(transcripts: DataFrame, params: TextParams = TextParams()) -> DataFrame:
    """doc_id and keywords of all transcripts."""
    listed = keyword_list(F.col("terms"), params)
    return term_lists(transcripts).select("doc_id", listed.alias("keywords"))


def document_frequencies(rows: DataFrame) -> DataFrame:
    """Number of transcripts that hold each term."""
    return rows.groupBy("term").agg(F.count(F.lit(1)).alias("df"))


def tfidf(transcripts: DataFrame) -> DataFrame:
    """Every term of every transcript with tf, idf = ln(N / (df + 1)) and their product."""
    return scored_terms(staged(term_lists(transcripts), "terms"))


def scored_terms(lists: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """TF-IDF from written term lists, which are read for N, for the terms' counts and the terms.

    N counts all transcripts but the bracketed placeholders, empty ones included.

    Terms that hold more than one in ``frequent`` of all rows, necessarily fewer than ``frequent``
    terms, are broadcast, so that most rows are not shuffled.  The other rows meet their terms in a
    shuffle, in which no term has more than that share.
    """
    documents = lists.agg(F.count("length").cast("double")).scalar()
    rows = lists.select("doc_id", "length", F.explode("terms").alias("_term")).select(
        "doc_id", "length", F.col("_term.term").alias("term"), F.col("_term.n").alias("n")
    )
    frequencies = staged(document_frequencies(rows), "frequencies")
    total = frequencies.agg(F.sum("df")).first()[0] or 0
    weights = frequencies.select("term", "df", F.ln(documents / (F.col("df") + 1)).alias("idf"))
    many = F.col("df") * frequent > total
    first, others = weights.where(many).drop("df"), weights.where(~many).drop("df")
    among_first = rows.join(F.broadcast(first), "term")
    among_others = rows.join(F.broadcast(first.select("term")), "term", "left_anti").join(
        others, "term"
    )
    tf = F.col("n") / F.col("length")
    return among_first.unionByName(among_others).select(
        "doc_id", "term", tf.alias("tf"), "idf", (tf * F.col("idf")).alias("score")
    )


def tfidf_top(scored: DataFrame, params: TextParams = TextParams()) -> DataFrame:
    """The highest-scoring terms a transcript holds, ties by term: doc_id, top_tfidf_terms."""
    item = F.struct("term", "score")
    # Rounding makes scores that differ only in the order of float operations tie.
    order = [F.floor(F.col("score") * 1e9 + 0.5).desc(), F.col("term")]
    return _ranked_list(scored, "doc_id", order, params.tfidf_terms, item, "top_tfidf_terms")


def attach_top_terms(transcripts: DataFrame, top_terms: DataFrame) -> DataFrame:
    """Add the top terms to the transcripts; null where a transcript has none."""
    return transcripts.join(top_terms, "doc_id", "left")


def with_text_facts(transcripts: DataFrame) -> DataFrame:
    """Add what later steps need of the text, so that the text itself need not be shuffled."""
    return transcripts.withColumns(
        {
            "has_content": text.has_content(F.col("transcript")),
            "num_words": F.coalesce(text.word_count(F.col("transcript")), F.lit(0)),
            "sentiment": text.sentiment(F.col("transcript")),
        }
    )


def summarize(
    transcripts: DataFrame, lists: DataFrame, params: TextParams = TextParams()
) -> DataFrame:
    """Add the columns of ``lists`` (doc_id, keywords, ...), summary sentence and sentiment."""
    facts = with_text_facts(transcripts).join(lists, "doc_id", "left")
    return facts.withColumn(
        "summary",
        text.text_summary(
            F.col("has_content"),
            F.col("keywords"),
            F.col("duration"),
            F.col("num_words"),
            params,
        ),
    )
