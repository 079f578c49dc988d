"""Properties of the physical plans that matter on large tables."""

import __spark_entry__ as entry
import pytest
from cliplake import runtime
from pyspark.sql import functions as F

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def plan_of(spark):
    keys = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    before = {key: spark.conf.get(key, None) for key in keys}
    for key in keys:
        spark.conf.set(key, "-1")

    def plan(name):
        df = entry.queries()[name](spark, SF_DIR)
        return df._jdf.queryExecution().executedPlan().toString()

    yield plan
    for key, value in before.items():
        if value is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, value)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_no_query_compares_all_pairs(plan_of, name):
    plan = plan_of(name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


@pytest.mark.parametrize("name", ["cleaned_rows", "dedup_key", "tfidf_top"])
def test_ranks_are_cut_before_the_shuffle(plan_of, name):
    assert "WindowGroupLimit" in plan_of(name)


@pytest.mark.parametrize("name", ["top_keywords", "limit_rows", "dist_codec"])
def test_top_lists_need_no_full_sort(plan_of, name):
    assert "TakeOrderedAndProject" in plan_of(name)


@pytest.mark.parametrize("name", ["quality_score", "has_content", "path_category", "sentiment"])
def test_row_wise_queries_do_not_shuffle_by_a_key(plan_of, name):
    plan = plan_of(name)
    assert "ENSURE_REQUIREMENTS" not in plan and "SinglePartition" not in plan


def test_scans_read_only_the_columns_they_need(plan_of):
    assert "ReadSchema: struct<o_orderkey:bigint>" in plan_of("quality_score")
    assert "ReadSchema: struct<page_id:bigint>" in plan_of("path_category")


def test_filters_reach_the_scan(plan_of):
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts," in plan_of("recent_rows")


def _shuffle_files(spark):
    files = spark._jsc.sc().env().blockManager().diskBlockManager().getAllFiles()
    names = [files.apply(i).getName() for i in range(files.size())]
    return {name for name in names if name.startswith("shuffle_")}


def test_written_tables_leave_no_shuffle_files(spark):
    before = _shuffle_files(spark)
    counts = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    first = runtime.staged(counts, "counts")
    second = runtime.Scratch(spark).staged(counts, "counts")
    assert not _shuffle_files(spark) - before
    assert spark.conf.get(runtime.FILE_CLEANUP, None) is None
    # Neither the written tables nor the frame they came from need the files again.
    assert sorted(first.collect()) == sorted(second.collect()) == sorted(counts.collect())
