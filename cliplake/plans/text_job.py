"""Text job: keywords, TF-IDF terms, summaries and sentiment of all transcripts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cliplake.operators import keywords
from cliplake.params import TextParams
from cliplake.runtime import staged


def analyse(transcripts: DataFrame, params: TextParams = TextParams()) -> DataFrame:
    """Transcripts with keywords, top TF-IDF terms, summary and sentiment.

    Texts are tokenised once; the terms are written and read for keywords and TF-IDF.  Select the
    columns you need: without ``transcript`` the texts are not shuffled.
    """
    terms = staged(keywords.term_lists(transcripts), "terms")
    top_terms = keywords.tfidf_top(keywords.scored_terms(terms), params)
    listed = keywords.keyword_list(F.col("terms"), params)
    lists = terms.select("doc_id", listed.alias("keywords"))
    both = keywords.attach_top_terms(lists, top_terms)
    return keywords.summarize(transcripts, both, params).drop("has_content", "num_words")


def summaries(transcripts: DataFrame, params: TextParams = TextParams()) -> DataFrame:
    """Transcripts with keywords, summary and sentiment, without TF-IDF."""
    lists = keywords.keywords(transcripts, params)
    return keywords.summarize(transcripts, lists, params).drop("has_content", "num_words")
