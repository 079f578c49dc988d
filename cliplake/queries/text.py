"""Text queries over transcripts."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import text
from cliplake.operators import catalog, documents, keywords, report
from cliplake.plans import text_job
from cliplake.queries.oracle import STOP_LIST, with_views
from cliplake.sources import views

PROCESSED_AT = datetime(2024, 1, 30, 12, 0, 0)
KEYWORD = "la"
FIRST_ROWS = 100
SENTIMENTS = ["positive", "neutral", "negative"]


def _explode_tokens(column):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return (
            views.transcripts(spark, sf_dir)
            .select("doc_id", F.posexplode(column(F.col("transcript"))).alias("position", "token"))
            .withColumn("position", F.col("position").cast("bigint"))
        )

    return query


def keyword_text(column: str = "keywords"):
    """Keywords as one line of text, for comparison."""
    shown = F.transform(column, lambda k: F.concat(k["word"], F.lit(":"), k["frequency"]))
    return F.array_join(shown, ",")


def _keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.keywords(views.transcripts(spark, sf_dir))


def has_content(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.transcripts(spark, sf_dir).select(
        "doc_id", text.has_content(F.col("transcript")).alias("has_content")
    )


def keyword_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keywords(spark, sf_dir).select("doc_id", keyword_text().alias("keywords"))


def top_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_keywords(_keywords(spark, sf_dir))


def keyword_contains(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keywords(spark, sf_dir).where(
        F.exists("keywords", lambda k: k["word"] == KEYWORD)
    ).select("doc_id")


def _rounded(column: str):
    """Six decimals, as ``round`` gives them; that goes by decimal strings, which only ties need."""
    scaled = F.col(column) * 1e6
    tie = F.abs(scaled - F.floor(scaled) - 0.5) < 1e-3
    return F.when(tie, F.round(column, 6)).otherwise(F.floor(scaled + 0.5) / 1e6)


def tfidf(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = keywords.tfidf(views.transcripts(spark, sf_dir))
    return scored.select(
        "doc_id", "term", *[_rounded(c).alias(c) for c in ["tf", "idf", "score"]]
    )


def _top_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keywords.tfidf_top(keywords.tfidf(views.transcripts(spark, sf_dir)))


def _term_rows(df: DataFrame, explode) -> DataFrame:
    return df.select("doc_id", explode("top_tfidf_terms").alias("position", "item")).select(
        "doc_id",
        F.coalesce(F.col("position") + 1, F.lit(0)).cast("bigint").alias("rnk"),
        F.col("item.term").alias("term"),
        F.round("item.score", 6).alias("score"),
    )


def tfidf_top(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _term_rows(_top_terms(spark, sf_dir), F.posexplode)


def tfidf_attach(spark: SparkSession, sf_dir: str) -> DataFrame:
    attached = keywords.attach_top_terms(
        views.transcripts(spark, sf_dir).select("doc_id"), _top_terms(spark, sf_dir)
    )
    return _term_rows(attached, F.posexplode_outer)


def text_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_results(spark, sf_dir).select("doc_id", "summary")


def _sentiments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.transcripts(spark, sf_dir).select(
        "doc_id", text.sentiment(F.col("transcript")).alias("sentiment")
    )


def sentiment_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.count_per_category(_sentiments(spark, sf_dir), "sentiment", SENTIMENTS)


def dist_sentiment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.distribution(_sentiments(spark, sf_dir), "sentiment")


def filter_equals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sentiments(spark, sf_dir).where(F.col("sentiment") == "negative")


def global_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = report.global_stats(
        views.transcripts(spark, sf_dir), ["duration"], ["num_segments"]
    )
    return stats.withColumn("avg_duration", F.round("avg_duration", 6))


def preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.transcripts(spark, sf_dir).select(
        "doc_id", text.preview(F.col("transcript")).alias("preview")
    )


def string_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.transcripts(spark, sf_dir).select(
        "doc_id",
        F.concat(F.lit(catalog.WATCH_URL), F.col("doc_id")).alias("url"),
        F.format_string("t=%.1fs", "duration").alias("caption"),
    )


def limit_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.transcripts(spark, sf_dir).select("doc_id", "filename", "num_segments")
    return rows.orderBy("doc_id").limit(FIRST_ROWS)


def distinct_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return views.transcripts(spark, sf_dir).select("num_segments").distinct()


def lineage_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.transcripts(spark, sf_dir).select("doc_id", "filename")
    return documents.with_lineage(rows, PROCESSED_AT, "nlp_analysis")


def analysed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_job.analyse(views.transcripts(spark, sf_dir))


def text_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transcripts with keywords, summary and sentiment."""
    return text_job.summaries(views.transcripts(spark, sf_dir))


def text_job_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    terms = F.array_join(F.transform("top_tfidf_terms", lambda t: t["term"]), ",")
    return analysed(spark, sf_dir).select(
        "doc_id",
        "filename",
        "num_segments",
        keyword_text().alias("keywords"),
        F.coalesce(terms, F.lit("")).alias("top_terms"),
        "summary",
        "sentiment",
    )


QUERIES = {
    "has_content": has_content,
    "tokenize": _explode_tokens(text.tokens),
    "remove_stopwords": _explode_tokens(lambda t: text.without_stop_words(text.tokens(t))),
    "keywords": keyword_lists,
    "top_keywords": top_keywords,
    "keyword_contains": keyword_contains,
    "tfidf": tfidf,
    "tfidf_top": tfidf_top,
    "tfidf_attach": tfidf_attach,
    "text_summary": text_summary,
    "sentiment": _sentiments,
    "sentiment_counts": sentiment_counts,
    "dist_sentiment": dist_sentiment,
    "filter_equals": filter_equals,
    "global_stats": global_stats,
    "preview": preview,
    "string_format": string_format,
    "limit_rows": limit_rows,
    "distinct_values": distinct_values,
    "lineage_columns": lineage_columns,
    "text_job": text_job_rows,
}

ORACLES = {
    "has_content": with_views("select doc_id, has_content from tokens", "tokens"),
    "tokenize": with_views(
        "select doc_id, unnest(range(len(toks))) as position, unnest(toks) as token from tokens",
        "tokens",
    ),
    "remove_stopwords": with_views(
        f"""select doc_id, unnest(range(len(kept))) as position, unnest(kept) as token
        from (select doc_id, list_filter(toks, lambda t: t not in ({STOP_LIST})) as kept
          from tokens)""",
        "tokens",
    ),
    "keywords": with_views(
        """select t.doc_id, coalesce(keywords, '') as keywords
        from transcripts t left join keyword_lists k on t.doc_id = k.doc_id""",
        "keyword_lists",
    ),
    "top_keywords": with_views(
        """select *, row_number() over (order by total_frequency desc, word) - 1 as position
        from (select word, cast(sum(frequency) as bigint) as total_frequency
          from keyword_rows group by word) order by position limit 10""",
        "keyword_rows",
    ),
    "keyword_contains": with_views(
        f"select distinct doc_id from keyword_rows where word = '{KEYWORD}'", "keyword_rows"
    ),
    "tfidf": with_views(
        """select doc_id, term, round(tf, 6) as tf, round(idf, 6) + 0::double as idf,
          round(score, 6) + 0::double as score
        from tfidf""",
        "tfidf",
    ),
    "tfidf_top": with_views(
        "select doc_id, rnk, term, round(score, 6) + 0::double as score from tfidf_top", "tfidf_top"
    ),
    "tfidf_attach": with_views(
        """select t.doc_id, coalesce(rnk, 0) as rnk, term, round(score, 6) + 0::double as score
        from transcripts t left join tfidf_top k on t.doc_id = k.doc_id""",
        "tfidf_top",
    ),
    "text_summary": with_views("select doc_id, summary from text_results", "text_results"),
    "sentiment": with_views("select doc_id, sentiment from sentiments", "sentiments"),
    "sentiment_counts": with_views(
        """select c.sentiment, upper(left(c.sentiment, 1)) || substring(c.sentiment, 2) as label,
          count(s.doc_id) as count
        from (values ('positive'), ('neutral'), ('negative')) c(sentiment)
        left join sentiments s on c.sentiment = s.sentiment group by c.sentiment""",
        "sentiments",
    ),
    "dist_sentiment": with_views(
        """select sentiment, count(*) as count,
          row_number() over (order by count(*) desc, sentiment) - 1 as position
        from sentiments group by sentiment""",
        "sentiments",
    ),
    "filter_equals": with_views(
        "select doc_id, sentiment from sentiments where sentiment = 'negative'", "sentiments"
    ),
    "global_stats": with_views(
        """select round(avg(duration), 6) as avg_duration,
          cast(sum(num_segments) as bigint) as total_num_segments from transcripts""",
        "transcripts",
    ),
    "preview": with_views(
        "select doc_id, substring(transcript, 1, 100) as preview from transcripts", "transcripts"
    ),
    "string_format": with_views(
        """select doc_id, concat('https://www.youtube.com/watch?v=', doc_id) as url,
          printf('t=%.1fs', duration) as caption from transcripts""",
        "transcripts",
    ),
    "limit_rows": with_views(
        f"""select doc_id, filename, num_segments from transcripts
        order by doc_id limit {FIRST_ROWS}""",
        "transcripts",
    ),
    "distinct_values": with_views("select distinct num_segments from transcripts", "transcripts"),
    "lineage_columns": with_views(
        f"""select doc_id, filename, timestamp '{PROCESSED_AT}' as processing_timestamp,
          'nlp_analysis' as data_type from transcripts""",
        "transcripts",
    ),
    "text_job": with_views(
        """select t.doc_id, t.filename, t.num_segments, t.keywords,
          coalesce(k.top_terms, '') as top_terms, t.summary, t.sentiment
        from text_results t left join (select doc_id, string_agg(term, ',' order by rnk)
          as top_terms from tfidf_top group by doc_id) k on t.doc_id = k.doc_id""",
        "text_results",
        "tfidf_top",
    ),
}
