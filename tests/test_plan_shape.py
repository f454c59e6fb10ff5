"""What the physical plans must and must not hold."""

import re

import pytest

from labelweave.queries import QUERIES

SF = "/root/testdata/sf0.001"

# The only queries that may run Python: entity and encoding repair, user code, and the
# states of lines in blocks.
PYTHON = {
    "html_unescape", "text_redecode", "row_map_udf", "pipe_tec", "pipe_emotionstimulus",
    "scan_quoted_breaks",
}
# Row numbers within keys, files or listings.
RANKED = {
    "dedup_merge_by_text", "collect_nullable_arrays", "collect_arrays_in_parts", "pipe_emoint",
    "pipe_electoraltweets", "join_positional", "join_positional_delimited", "pipe_wassa22",
    "dataset_manifest", "scan_quoted_breaks",
}
# One shuffle, with partial aggregation before it.
ONE_SHUFFLE = (
    "pivot_count", "pivot_presence", "pivot_bool_and", "pivot_sum", "pivot_mean",
    "pivot_any_value", "pivot_dedup", "pivot_flag", "title_case", "pipe_crowdflower",
    "pipe_goodnewseveryone", "pipe_stockemotions", "pipe_canceremo", "pipe_hurricanes8",
    "pipe_tec", "pipe_emotionstimulus", "pipe_affectivetext", "merge_records_by_key",
)
NO_SHUFFLE = (
    "project_rename", "cast_bool", "row_mean", "one_hot_label", "multi_hot_label_list",
    "vote_sum_pairs", "map_codes", "nested_vote_count", "text_clean", "html_unescape",
    "append_by_name", "split_concat", "pipe_goemotions", "pipe_ssec", "pipe_usvsthem",
    "pipe_carer", "pipe_xed", "pipe_ren20k", "pipe_talesemotions", "pipe_hurricanes24",
    "open_vote_count", "scan_rejects", "pipe_sentimentalliar", "pipe_semeval2018classification", "pipe_fbvalencearousal",
)


def plan(spark, name):
    return QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()


def shuffles(text):
    return len(re.findall(r"Exchange (?:hash|range|RoundRobin|Single)", text))


@pytest.mark.parametrize("name", ONE_SHUFFLE)
def test_one_shuffle(spark, name):
    text = plan(spark, name)
    assert shuffles(text) == 1
    assert "partial_" in text


@pytest.mark.parametrize("name", NO_SHUFFLE)
def test_no_shuffle(spark, name):
    assert shuffles(plan(spark, name)) == 0


def test_python_and_windows(spark):
    for name in QUERIES:
        text = plan(spark, name)
        if name not in PYTHON:
            assert "Python" not in text and "InPandas" not in text, name
        if name not in RANKED:
            assert "Window" not in text, name
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


def test_pruning_and_pushdown(spark):
    text = plan(spark, "pivot_count")
    assert "ReadSchema: struct<user_id:bigint,event_type:string>" in text
    assert "In(event_type, [click,view])" in plan(spark, "join_full_outer")
    assert "StringStartsWith(c_name,Customer#)" in plan(spark, "filter_prefix")


def test_isear_is_not_sorted_before_it_is_written(spark):
    assert "rangepartitioning" not in plan(spark, "pipe_isear")


def test_lists_need_one_shuffle_of_rows(spark):
    """Where no key is large its branch falls away, and lists and sums share a shuffle."""
    df = QUERIES["collect_nullable_arrays"](spark, SF)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    assert "Window" not in final
    assert final.count("ObjectHashAggregate") + final.count("SortAggregate") == 2  # partial and final
