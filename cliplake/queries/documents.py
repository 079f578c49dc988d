"""Document queries: per-video documents, lookups, upsert, summaries and totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cliplake.functions import html
from cliplake.operators import cluster, documents, report
from cliplake.queries import text as text_queries
from cliplake.queries.oracle import with_views
from cliplake.runtime import fresh_dir
from cliplake.sinks import tables
from cliplake.sources import files, views


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.video_documents(
        views.keyframes_det(spark, sf_dir),
        text_queries.text_results(spark, sf_dir),
        text_queries.PROCESSED_AT,
    )


def video_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = documents.video_facts(
        views.keyframes_det(spark, sf_dir),
        text_queries.text_results(spark, sf_dir),
        text_queries.PROCESSED_AT,
    )
    return facts.withColumn("keywords", text_queries.keyword_text())


def _final(spark: SparkSession, sf_dir: str) -> DataFrame:
    return documents.final_summaries(
        views.keyframes_det(spark, sf_dir), text_queries.text_results(spark, sf_dir)
    )


def video_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = F.transform(
        "keyframe_details",
        lambda d: F.concat(d["frame_number"], F.lit("@"), d["timestamp"], F.lit("#"), d["cluster"]),
    )
    return _documents(spark, sf_dir).withColumns(
        {
            "keyframe_details": F.array_join(details, ","),
            "keywords": text_queries.keyword_text(),
        }
    )


def _video_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        views.keyframes_det(spark, sf_dir)
        .groupBy("video_name")
        .agg(F.count(F.lit(1)).alias("num_keyframes"))
    )


def top_videos(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_rows(_video_counts(spark, sf_dir), "num_keyframes", "video_name", 10)


def max_keyframes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.top_rows(_video_counts(spark, sf_dir), "num_keyframes", "video_name", 1)


def contains_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    videos = (
        views.frames(spark, sf_dir)
        .select("video_name", F.replace("video_name", F.lit(".mp4"), F.lit("")).alias("stem"))
        .distinct()
    )
    files = views.transcripts(spark, sf_dir).select("filename", "num_segments")
    return documents.contains_lookup(videos, "stem", files, "filename")


def upsert_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = views.table(spark, sf_dir, "documents")
    old = rows.where("doc_id % 3 <> 0").select("doc_id", "n_chars", "lang")
    new = rows.where("doc_id % 3 = 0 or doc_id % 2 = 0").select(
        "doc_id", (F.col("n_chars") * 2).alias("n_chars"), "source"
    )
    return documents.upsert(old, new, "doc_id")


def upsert_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A collection created, upserted twice, the second time with few keys, and read back."""
    rows = views.table(spark, sf_dir, "documents")
    store = tables.KeyedCollection(spark, f"{fresh_dir(spark, 'keyed')}/documents", "doc_id", rows_per_bucket=64)
    store.upsert(rows.where("doc_id % 3 <> 0").select("doc_id", "n_chars", "lang"))
    changed = rows.where("doc_id % 3 = 0 or doc_id % 2 = 0")
    store.upsert(changed.select("doc_id", (F.col("n_chars") * 2).alias("n_chars"), "source"))
    store.upsert(rows.where("doc_id % 50 = 7").select("doc_id", F.lit("late").alias("lang")))
    return store.read()


def final_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _final(spark, sf_dir).withColumn("keywords", text_queries.keyword_text())


def final_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return report.final_totals(_final(spark, sf_dir)).withColumn(
        "total_minutes", F.round("total_minutes", 6)
    )


def html_cards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.report_cards(_final(spark, sf_dir))


def html_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The lines of the whole report page, written and read back in order."""
    root = fresh_dir(spark, "report")
    tables.write_html_report(_final(spark, sf_dir), root)
    return files.numbered_lines(spark, root)


def collection_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = views.frames(spark, sf_dir)
    keyframes = views.keyframes_det(spark, sf_dir)
    facts = documents.video_facts(
        keyframes, text_queries.text_results(spark, sf_dir), text_queries.PROCESSED_AT
    )
    return report.collection_counts(
        {
            "keyframes": keyframes,
            "nlp_results": views.transcripts(spark, sf_dir),
            "summary_statistics": cluster.keyframe_figures(frames, keyframes),
            "video_summaries": facts,
        }
    )


QUERIES = {
    "video_document": video_document,
    "video_facts": video_facts,
    "top_videos": top_videos,
    "max_keyframes": max_keyframes,
    "contains_lookup": contains_lookup,
    "upsert_merge": upsert_merge,
    "upsert_stored": upsert_stored,
    "final_summary": final_summary,
    "final_totals": final_totals,
    "html_cards": html_cards,
    "html_report": html_report,
    "collection_counts": collection_counts,
}


def _escaped(text: str) -> str:
    return f"replace(replace(replace({text}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


CARDS = f"""select video_name, concat('<article><h2>', video_name, '</h2><p>Keyframes: ',
          num_keyframes, '</p><p>Duration: ', duration_seconds, 's</p><p class="',
          coalesce(sentiment, 'neutral'), '">', upper(coalesce(sentiment, 'neutral')),
          '</p><p>Summary: ', {_escaped("coalesce(text_summary, 'No summary available')")},
          '</p><p>Keywords: ', coalesce(tags, ''), '</p></article>') as card
        from final_summaries f left join (select doc_id, string_agg(concat('<span class="tag">',
            {_escaped("word")}, ' (', frequency, ')</span>'), '' order by rnk) as tags
          from keyword_rows group by doc_id) k on f.doc_id = k.doc_id"""

ORACLES = {
    "video_document": with_views(
        f"""select video_name, 0::bigint as part, num_keyframes, keyframe_details, transcript,
          summary, sentiment, keywords, duration,
          timestamp '{text_queries.PROCESSED_AT}' as processing_timestamp,
          '1.0' as summary_version, 'files -> Spark -> documents' as processing_pipeline
        from video_docs""",
        "video_docs",
    ),
    "video_facts": with_views(
        f"""select video_name, num_keyframes, transcript, summary, sentiment, keywords, duration,
          timestamp '{text_queries.PROCESSED_AT}' as processing_timestamp,
          '1.0' as summary_version, 'files -> Spark -> documents' as processing_pipeline
        from video_docs""",
        "video_docs",
    ),
    "top_videos": with_views(
        """select video_name, num_keyframes,
          row_number() over (order by num_keyframes desc, video_name) - 1 as position
        from stats order by position limit 10""",
        "stats",
    ),
    "max_keyframes": with_views(
        """select video_name, num_keyframes,
          row_number() over (order by num_keyframes desc, video_name) - 1 as position
        from stats order by position limit 1""",
        "stats",
    ),
    "contains_lookup": with_views(
        """select v.video_name, v.stem, t.filename, t.num_segments
        from (select distinct video_name, replace(video_name, '.mp4', '') as stem from frames) v
        left join (select stem, min(filename) as filename
            from (select distinct replace(video_name, '.mp4', '') as stem from frames)
            join transcripts on contains(filename, stem) group by stem) m on v.stem = m.stem
        left join transcripts t on m.filename = t.filename""",
        "frames",
        "transcripts",
    ),
    "upsert_merge": """
        select coalesce(o.doc_id, n.doc_id) as doc_id,
          case when n.doc_id is not null then n.n_chars * 2 else o.n_chars end as n_chars,
          o.lang, n.source
        from (select * from documents where doc_id % 3 <> 0) o
        full join (select * from documents where doc_id % 3 = 0 or doc_id % 2 = 0) n on o.doc_id = n.doc_id""",
    "upsert_stored": """
        select doc_id, case when doc_id % 3 = 0 or doc_id % 2 = 0 then n_chars * 2
            when doc_id % 3 <> 0 then n_chars end as n_chars,
          case when doc_id % 50 = 7 then 'late' when doc_id % 3 <> 0 then lang end as lang,
          case when doc_id % 3 = 0 or doc_id % 2 = 0 then source end as source
        from documents""",
    "final_summary": with_views(
        """select video_name, summary_video_name, hdfs_path, num_keyframes, duration_seconds,
          text_summary, sentiment, keywords from final_summaries""",
        "final_summaries",
    ),
    "final_totals": with_views(
        """select count(*) as documents, cast(sum(num_keyframes) as bigint) as total_keyframes,
          cast(sum(duration_seconds) as bigint) as total_seconds,
          round(sum(duration_seconds) / 60::double, 6) as total_minutes from final_summaries""",
        "final_summaries",
    ),
    "html_cards": with_views(CARDS, "final_summaries", "keyword_rows"),
    "html_report": with_views(
        f"""select row_number() over (order by place, video_name, k) - 1 as line_no, line
        from (select place, video_name, unnest(lines) as line, unnest(range(len(lines))) as k
          from (select 0 as place, '' as video_name, string_split({_quoted(html.HEAD)}, chr(10)) as lines
            union all select 1, video_name, [card] from ({CARDS})
            union all select 2, '', string_split({_quoted(html.FOOT)}, chr(10))))""",
        "final_summaries",
        "keyword_rows",
    ),
    "collection_counts": with_views(
        """select 'keyframes' as collection, count(*) as documents from keyframes_det
        union all select 'nlp_results', count(*) from transcripts
        union all select 'summary_statistics', count(*) from stats
        union all select 'video_summaries', count(*) from video_docs""",
        "stats",
        "video_docs",
    ),
}
