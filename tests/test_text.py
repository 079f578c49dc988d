import math
from collections import Counter

import pyarrow as pa
from cliplake.functions import terms, text
from cliplake.operators import keywords
from cliplake.plans import text_job
from cliplake.queries import text as text_queries
from pyspark.sql import functions as F

TEXTS = [
    (1, "The good, the bad; and the GOOD! best-of:best? a.b\tc d e　f\x1cg"),
    (2, ""),
    (3, "[Audio contains approximately 3 speech segments]"),
    (4, None),
    (5, "the is at which"),
    (6, "zebra apple zebra apple mango bestow problem"),
    (7, "  \n .,!? "),
    (8, "problem issue hate love"),
]


def _tokens(value):
    value = value.lower()
    for mark in ".,!?;:":
        value = value.replace(mark, " ")
    return value.split()


def _has_content(value):
    return bool(value) and not value.startswith("[")


def _frame(spark):
    rows = [(i, f"f{i}.wav", t, 1, 2.6) for i, t in TEXTS]
    columns = "doc_id int, filename string, transcript string, num_segments int, duration double"
    return spark.createDataFrame(rows, columns)


def test_tokens_and_word_count(spark):
    rows = _frame(spark).select(
        "doc_id",
        text.tokens(F.col("transcript")).alias("tokens"),
        text.word_count(F.col("transcript")).alias("words"),
    )
    found = {r.doc_id: (r.tokens, r.words) for r in rows.collect()}
    for doc_id, value in TEXTS:
        if value is not None:
            assert found[doc_id] == (_tokens(value), len(value.split()))


def test_keywords_rank_by_count_then_first_occurrence(spark):
    found = {
        r.doc_id: [(k.word, k.frequency) for k in r.keywords]
        for r in keywords.keywords(_frame(spark)).collect()
    }
    assert len(found) == len(TEXTS)
    for doc_id, value in TEXTS:
        kept = []
        if _has_content(value):
            kept = [t for t in _tokens(value) if t not in text.STOP_WORDS]
        assert found[doc_id] == Counter(kept).most_common(10)


def test_tfidf_counts_empty_texts_as_documents(spark):
    rows = _frame(spark).where("transcript is not null")
    found = {(r.doc_id, r.term): r.score for r in keywords.tfidf(rows).collect()}
    documents = {i: _tokens(t) for i, t in TEXTS if t is not None and not t.startswith("[")}
    holding = Counter(term for tokens in documents.values() for term in set(tokens))
    expected = {
        (i, term): n / len(tokens) * math.log(len(documents) / (holding[term] + 1))
        for i, tokens in documents.items()
        for term, n in Counter(tokens).items()
    }
    assert found.keys() == expected.keys()
    assert all(math.isclose(found[k], expected[k], abs_tol=1e-12) for k in found)


def test_summary_and_sentiment(spark):
    rows = {r.doc_id: r for r in text_job.analyse(_frame(spark)).collect()}
    assert len(rows) == len(TEXTS)
    assert rows[2].summary == rows[3].summary == rows[4].summary == "No audio content detected."
    assert rows[5].summary == "Audio segment of 2.6 seconds. Approximate word count: 4."
    assert rows[6].summary == (
        "This 2.6 second audio segment discusses topics related to: "
        "zebra, apple, mango, bestow, problem. Approximate word count: 7."
    )
    moods = {i: rows[i].sentiment for i in rows}
    assert moods[1] == "positive"
    assert moods[2] == moods[3] == moods[4] == moods[5] == "neutral"
    assert moods[6] == "neutral"
    assert moods[8] == "negative"
    assert rows[5].keywords == [] and rows[2].top_tfidf_terms is None
    assert rows[2].keywords == []


def test_keywords_need_no_shuffle(spark, tmp_path):
    _frame(spark).write.parquet(str(tmp_path / "t"))
    job = keywords.keywords(spark.read.parquet(str(tmp_path / "t")))
    assert "Exchange" not in job._jdf.queryExecution().executedPlan().toString()


def test_texts_are_read_once_for_tfidf(spark, tmp_path):
    _frame(spark).write.parquet(str(tmp_path / "t"))
    scored = keywords.tfidf(spark.read.parquet(str(tmp_path / "t")))
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "transcript" not in plan


def _plain_terms(value):
    """Length and (term, n, position), most frequent first, ties by position."""
    tokens = _tokens(value)
    counts = Counter(tokens)
    return len(tokens), [(t, n, tokens.index(t)) for t, n in counts.most_common()]


def test_terms_are_counted_alike_in_blocks_of_any_size(monkeypatch):
    marks = "".join(f"w{i % 7}{mark}" for i, mark in enumerate(text.PUNCTUATION + text.WHITE_SPACE))
    values = [t for _, t in TEXTS] + [marks, "", "é É ß", None, "x" * 50, "-a- 'b' a\0b [c] ^ \\ ]"]
    lowered = [None if v is None else v.lower() for v in values]
    batch = pa.RecordBatch.from_arrays(
        [pa.array(range(len(values))), pa.array(lowered, pa.string())], ["doc_id", "content"]
    )
    expected = [(None, None) if v is None else _plain_terms(v) for v in lowered]
    for size in (1, 40, 1 << 22):
        monkeypatch.setattr(terms, "BLOCK", size)
        for given, first in ((batch, 0), (batch.slice(3), 3), (batch.slice(0, 0), len(values))):
            found = [row for part in terms.count_terms(iter([given])) for row in part.to_pylist()]
            assert [row["doc_id"] for row in found] == list(range(len(values)))[first:]
            listed = [
                row["terms"] if row["terms"] is None else [tuple(t.values()) for t in row["terms"]]
                for row in found
            ]
            assert list(zip([row["length"] for row in found], listed)) == expected[first:]


def test_term_lists_begin_with_the_most_frequent_term(spark):
    rows = {r.doc_id: r for r in keywords.term_lists(_frame(spark)).collect()}
    for doc_id, value in TEXTS:
        if value is None or value.startswith("["):
            assert rows[doc_id].terms is None and rows[doc_id].length is None
        else:
            found = [tuple(t) for t in rows[doc_id].terms]
            assert (rows[doc_id].length, found) == _plain_terms(value)


def test_keywords_stand_behind_all_stop_words(spark):
    value = " ".join([*text.STOP_WORDS, *text.STOP_WORDS, *"abcdefghijkl"])
    kept = [t for t in _tokens(value) if t not in text.STOP_WORDS]
    frame = _frame(spark).where("doc_id = 1").withColumn("transcript", F.lit(value))
    found = keywords.keywords(frame).first().keywords
    assert [(k.word, k.frequency) for k in found] == Counter(kept).most_common(10)


def _term_table(spark, path):
    values = [" ".join(f"t{k}" for k in range(1, 40) if i % k == 0) for i in range(60)]
    rows = [(i // 2 if i else None, v) for i, v in enumerate(values)]
    frame = spark.createDataFrame(rows, "doc_id int, transcript string")
    keywords.term_lists(frame).write.parquet(path)
    return values, spark.read.parquet(path)


def test_scores_of_frequent_and_other_terms(spark, tmp_path):
    values, lists = _term_table(spark, str(tmp_path / "t"))
    documents = [_tokens(v) for v in values]
    holding = Counter(t for tokens in documents for t in set(tokens))
    expected = sorted(
        (i // 2 if i else -1, t, round(math.log(len(values) / (holding[t] + 1)) / len(tokens), 12))
        for i, tokens in enumerate(documents)
        for t in tokens
    )
    for frequent in (1, 8, 1_000_000):
        found = keywords.scored_terms(lists, frequent).collect()
        given = [(-1 if r.doc_id is None else r.doc_id, r.term, round(r.score, 12)) for r in found]
        assert sorted(given) == expected


def test_frequent_terms_are_scored_without_a_shuffle_of_their_rows(spark, tmp_path):
    _, lists = _term_table(spark, str(tmp_path / "t"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        plan = keywords.scored_terms(lists)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan


def test_rounding_of_scores_is_that_of_round(spark):
    numbers = [n / d for d in (64, 128, 640, 1280, 3, 7, 2_000_000) for n in range(-9, 40)]
    rows = spark.createDataFrame([(x,) for x in [*numbers, -1e-9, 0.0, 12.3456785]] + [(None,)], "x double")
    found = rows.select(F.round("x", 6).alias("a"), text_queries._rounded("x").alias("b")).collect()
    assert all(r.a == r.b for r in found)
