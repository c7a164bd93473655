"""Shape of the physical plans: which source is scanned, with which columns, with how many shuffles."""

import pytest

from lidarframe import las_audit
from lidarframe.plans.catalog import queries

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name",
    [
        "las_scan", "las_format_10", "las_filter", "las_source_filter", "las_column_pruning", "records_decode",
        "las_partition_pruning", "las_where_folder", "las_write_curve", "las_vlr_roundtrip",
    ],
)
def test_row_queries_do_not_shuffle(spark, name):
    assert "Exchange" not in plan_of(queries()[name](spark, SF_DIR))


@pytest.mark.parametrize("name", [n for n in sorted(queries()) if n.startswith("hdr_")])
def test_global_aggregates_read_headers_alone(spark, name):
    plan = plan_of(queries()[name](spark, SF_DIR))
    if name.startswith("hdr_fallback"):
        assert "BatchScan las[" in plan and "las_headers" not in plan
    elif name.startswith("hdr_box"):  # headers of files inside, points of files astride
        assert "BatchScan las_headers[" in plan and "BatchScan las[" in plan and "Join" not in plan
        assert plan.count("Exchange") == 2 and "partial_" in plan
    elif name.startswith("hdr_index"):  # the kept table
        assert "Scan parquet" in plan and "BatchScan" not in plan and plan.count("Exchange") == 1
    else:
        assert "BatchScan las_headers[" in plan and "BatchScan las[" not in plan
        assert plan.count("Exchange") == 1 and "partial_" in plan


def test_grouping_shuffles_partial_results_once(spark):
    plan = plan_of(queries()["hdr_fallback_group"](spark, SF_DIR))
    assert plan.count("Exchange") == 1 and "partial_count" in plan
    assert "BatchScan las[x" in plan and "gps_time" not in plan


def test_audit_shuffles_once(spark):
    from lidarframe.plans import fixtures

    plan = plan_of(las_audit(spark, fixtures.mixed_las(spark, SF_DIR)))
    assert plan.count("Exchange") == 1 and "Join" not in plan and "BatchScan las_range_stats" in plan
    assert "HashAggregate" in plan and "Sort" not in plan


def test_nothing_is_broadcast_or_multiplied(spark):
    for name in ("las_headers", "las_header_audit", "las_partition_columns", "las_mixed_formats"):
        plan = plan_of(queries()[name](spark, SF_DIR))
        assert "Broadcast" not in plan and "Cartesian" not in plan
