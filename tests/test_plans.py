"""Plan checks over the registered queries."""

import re

import pytest

import __spark_entry__ as E
from conftest import SF_SMALL


def _plan(spark, name):
    df = E.queries()[name](spark, SF_SMALL)
    df.write.format("noop").mode("overwrite").save()
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def plans(spark):
    return {name: _plan(spark, name) for name in E.catalog.QUERIES}


def test_no_python_in_batch_queries(plans):
    for name, p in plans.items():
        assert not re.search(r"BatchEvalPython|ArrowEvalPython|PythonUDF|FlatMapGroupsInPandas", p), name


def test_single_partition_only_for_summaries(plans):
    # un-partitioned windows only run over one row per arrival block (late data); no query
    # moves its rows to one task
    for name, p in plans.items():
        lines = p.splitlines()
        for i, ln in enumerate(lines):
            if "Exchange SinglePartition" in ln:
                assert name in ("late_orders", "order_counts_late", "top_urls_late"), name
                assert re.search(r"Aggregate\(keys?=\[_ab", lines[i + 1]), (name, lines[i + 1])


def test_bitmap_counts_are_hash_aggregates(plans):
    assert "SortAggregate" not in plans["unique_visitors_bitmap"]


def test_followed_by_has_one_exchange(plans):
    for name in ("order_paid", "order_timeout"):
        assert len(re.findall(r"Exchange hashpartitioning", plans[name])) == 1, name


def test_caps_cut_before_the_shuffle(plans):
    p = plans["ad_blacklist"]
    assert "WindowGroupLimit" in p and "Partial" in p


def test_filters_reach_the_scan(plans):
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plans["page_views"]
    assert "ReadSchema: struct<ts:timestamp_ntz,event_type:string>" in plans["page_views"]


def test_sliding_windows_shuffle_panes_not_windows(plans):
    p = plans["marketing_by_channel"]
    # two exchanges: pane partial aggregate, then pane spread; the window expansion is after both
    assert len(re.findall(r"Exchange hashpartitioning", p)) == 2
    assert p.index("explode(sequence") < p.index("Exchange hashpartitioning")
