"""What the physical plans must and must not contain."""

from __future__ import annotations

import pytest

from headway.operators.vehicles import with_stop_names
from headway.plans import fixtures as fix
from headway.plans.queries import QUERIES
from tests.conftest import DATA

LAZY = [name for name in QUERIES if not name.startswith(("json", "stream", "daily", "raw"))]


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_cross_joins(spark):
    for name in LAZY:
        text = plan(QUERIES[name](spark, DATA))
        assert "CartesianProduct" not in text and "NestedLoop" not in text, name


@pytest.mark.parametrize(
    "name",
    ["interpret_vehicles", "route_name", "route_name_join", "trip_parse", "vehicle_projection",
     "trip_projection", "feed_type_check", "union_feeds", "timestamp_readable"],
)
def test_row_by_row_queries_do_not_shuffle(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "Exchange hashpartitioning" not in text and "Python" not in text


def test_limits_are_applied_in_front_of_the_shuffle(spark):
    assert "TakeOrderedAndProject" in plan(QUERIES["latest20_files"](spark, DATA))
    text = plan(QUERIES["first50_per_feed"](spark, DATA))
    assert text.count("WindowGroupLimit") == 2


def test_scans_read_only_used_columns(spark):
    text = plan(QUERIES["route_name"](spark, DATA))
    assert "value" not in text.split("ReadSchema:")[1]
    text = plan(QUERIES["upload_stats"](spark, DATA))
    assert "ReadSchema: struct<event_type:string>" in text


def test_only_the_route_dimension_is_forced_to_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(QUERIES["route_name_join"](spark, DATA))
        for name in ("stop_name", "stop_time_explode", "routes_dim"):
            assert "Broadcast" not in plan(QUERIES[name](spark, DATA)), name
        lines = fix.stop_updates(fix.table(spark, DATA, "lineitem")).select("update.stop_id")
        assert "SortMergeJoin" in plan(with_stop_names(lines, fix.stops(spark, DATA)))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")


def test_decode_adds_no_shuffle(spark):
    text = plan(QUERIES["feed_header"](spark, DATA))
    # The one exchange brings the records of a message together.
    assert text.count("Exchange") == 1 and text.count("MapInArrow") == 2


def test_parsed_trip_keeps_nested_pruning(spark, tmp_path):
    raw = fix.raw_vehicles(spark, DATA)
    from headway.operators import decode as dec
    from headway.operators.vehicles import project_vehicles

    dec.decode(raw.select("feed_no", "content")).write.parquet(str(tmp_path / "snapshots"))
    stored = spark.read.parquet(str(tmp_path / "snapshots"))
    rows = project_vehicles(dec.entities(stored, "feed_no"), "feed_no").select("route_id")
    assert "stop_time_update" not in plan(rows).split("ReadSchema:")[1]


@pytest.mark.parametrize("name", ["fetch_stats", "fetch_stats_total"])
def test_counters_are_not_sorted(spark, name):
    text = plan(QUERIES[name](spark, DATA))
    assert "SortAggregate" not in text and "ObjectHashAggregate" not in text
