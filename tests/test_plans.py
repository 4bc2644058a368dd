"""Plan-shape checks: pruning and pushdown reach the Parquet scans."""

import __spark_entry__ as entry


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_scan_prunes_columns(spark, sf_small):
    plan = _plan(entry.queries()["label_histogram"](spark, sf_small))
    # lineitem is read with only the referenced columns, never l_comment-style extras
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint" in plan
    assert "o_totalprice" not in plan and "p_retailprice" not in plan and "p_name" not in plan


def test_filter_pushed_to_scan(spark, sf_small):
    plan = _plan(entry.queries()["page_slice"](spark, sf_small).filter("event_id < 100"))
    assert "PushedFilters: [IsNotNull(event_id), LessThan(event_id,100)]" in plan


