"""HTML fragments of the summary report as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

HEAD = """<!DOCTYPE html>
<html><head><meta charset="utf-8"><title>Video Summary Report</title>
<style>
 body {font-family: sans-serif; margin: 2em auto; max-width: 70em}
 article {border: 1px solid #ccc; margin: 1em 0; padding: 1em}
 .positive {color: #2e7d32} .negative {color: #c62828} .neutral {color: #616161}
 .tag {background: #e3f2fd; margin: 2px; padding: 2px 8px}
</style></head><body><h1>Video Summary Report</h1>"""
FOOT = "</body></html>"


def escape(text: Column) -> Column:
    safe = F.replace(text, F.lit("&"), F.lit("&amp;"))
    safe = F.replace(safe, F.lit("<"), F.lit("&lt;"))
    return F.replace(safe, F.lit(">"), F.lit("&gt;"))


def keyword_tags(keywords: Column, limit: int = 10) -> Column:
    """One tag per keyword, the first ``limit`` of them."""
    tags = F.transform(
        F.slice(F.coalesce(keywords, F.array()), 1, limit),
        lambda k: F.format_string(
            '<span class="tag">%s (%d)</span>',
            escape(F.coalesce(k["word"], F.lit(""))),
            F.coalesce(k["frequency"], F.lit(0)),
        ),
    )
    return F.array_join(tags, "")


def card(
    video_name: Column,
    num_keyframes: Column,
    duration_seconds: Column,
    sentiment: Column,
    text_summary: Column,
    keywords: Column,
) -> Column:
    """One report card; missing fields take a default."""
    mood = F.coalesce(sentiment, F.lit("neutral"))
    return F.format_string(
        "<article><h2>%s</h2><p>Keyframes: %d</p><p>Duration: %ds</p>"
        '<p class="%s">%s</p><p>Summary: %s</p><p>Keywords: %s</p></article>',
        escape(F.coalesce(video_name, F.lit("Unknown"))),
        F.coalesce(num_keyframes, F.lit(0)),
        F.coalesce(duration_seconds, F.lit(0)),
        mood,
        F.upper(mood),
        escape(F.coalesce(text_summary, F.lit("No summary available"))),
        keyword_tags(keywords),
    )
