"""Token, summary and sentiment expressions over transcripts."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column
from pyspark.sql import functions as F

from cliplake.params import TextParams

# Punctuation that becomes a space, stop words, sentiment words.
PUNCTUATION = ".,!?;:"
STOP_WORDS = (
    "the", "is", "at", "which", "on", "a", "an", "as", "are", "was", "were", "been", "be", "have",
    "has", "had", "do", "does", "did", "but", "if", "or", "and", "to", "of", "in", "for", "with",
)
POSITIVE_WORDS = (
    "good", "great", "excellent", "amazing", "wonderful", "fantastic", "love", "best", "perfect",
    "awesome",
)
NEGATIVE_WORDS = (
    "bad", "poor", "terrible", "horrible", "worst", "awful", "hate", "disappointing", "problem",
    "issue",
)

# Every character that Unicode counts as white space, and the four ASCII separators.
WHITE_SPACE = "".join(c for c in map(chr, range(0x10000)) if c.isspace())


def _split(text: Column, separators: str) -> Column:
    """Split on any run of the separators without empty words."""
    spaced = F.translate(text, separators, " " * len(separators))
    return F.array_remove(F.split(spaced, " "), "")


def words(text: Column) -> Column:
    return _split(text, WHITE_SPACE)


def tokens(text: Column) -> Column:
    """Lower-case words with the punctuation taken out."""
    return _split(F.lower(text), PUNCTUATION + WHITE_SPACE)


def without_stop_words(token_list: Column) -> Column:
    return F.filter(token_list, lambda token: ~token.isin(*STOP_WORDS))


def is_placeholder(transcript: Column) -> Column:
    """Transcripts in square brackets stand for audio without text."""
    return transcript.startswith("[")


def has_content(transcript: Column) -> Column:
    return F.coalesce((transcript != "") & ~is_placeholder(transcript), F.lit(False))


def word_count(text: Column) -> Column:
    return F.size(words(text))


def _hits(lowered: Column, lexicon: tuple[str, ...]) -> Column:
    """Number of lexicon words that occur anywhere in the text, each counted once."""
    return reduce(add, [lowered.contains(word).cast("int") for word in lexicon])


def sentiment(transcript: Column) -> Column:
    # The one-element array makes Spark lower the text once, not once per word.
    balance = F.transform(
        F.array(F.lower(transcript)),
        lambda t: F.signum(_hits(t, POSITIVE_WORDS) - _hits(t, NEGATIVE_WORDS)).cast("int"),
    )
    labels = F.array(F.lit("negative"), F.lit("neutral"), F.lit("positive"))
    return F.when(
        has_content(transcript), F.element_at(labels, F.element_at(balance, 1) + 2)
    ).otherwise("neutral")


def text_summary(
    content: Column,
    keywords: Column,
    duration: Column,
    num_words: Column,
    params: TextParams = TextParams(),
) -> Column:
    """One templated sentence per transcript.

    Takes the has-content flag and the word count, not the transcript, so that the text itself
    need not travel with the keywords.
    """
    listed = F.array_join(
        F.transform(F.slice(keywords, 1, params.summary_keywords), lambda k: k["word"]), ", "
    )
    opening = F.when(
        F.coalesce(F.size(keywords), F.lit(0)) > 0,
        F.format_string(
            "This %.1f second audio segment discusses topics related to: %s. ", duration, listed
        ),
    ).otherwise(F.format_string("Audio segment of %.1f seconds. ", duration))
    counted = F.format_string("Approximate word count: %d.", num_words)
    return F.when(content, F.concat(opening, counted)).otherwise("No audio content detected.")


def preview(text: Column, length: int = 100) -> Column:
    return F.substring(text, 1, length)
