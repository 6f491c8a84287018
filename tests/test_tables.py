"""Dimension operators, reconciliation, sources and whole plans."""

from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import pytest
from helpers import plan_text, rows
from pyspark.sql import functions as F

from conformance.registry import AS_OF, BUSINESS, CFG, DAYS, EARLY, FIRST_HOUR, LAST_HOUR, LIMIT_DAYS, TRAFFIC
from conformance.tables import warehouse
from marginlab import Period, Warehouse
from marginlab.operators import dims, quality
from marginlab.operators.history import validity_intervals
from marginlab.plans import dataset, eligibility, health, hourly
from marginlab.plans.common import target_history
from marginlab.sources import scans, sink
from marginlab.streaming.hourly_run import hour_bounds, hourly_run

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize(
    "excluded, left",
    [([2], [(1,), (3,)]), ([2, None], []), ([], [(1,), (2,), (3,), (None,)]), ([None], [])],
)
def test_not_in_with_nulls(spark, excluded, left):
    df = spark.createDataFrame([(1,), (2,), (3,), (None,)], "k int")
    out = spark.createDataFrame([(e,) for e in excluded], "x int")
    assert rows(dims.exclude_keys(df, "k", out)) == left


def test_old_snapshots_give_no_rows(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00Z", 1), ("2024-01-02T00:00:00Z", 2)], "dt string, v int")
    assert rows(scans.latest_snapshot(df, "2024-01-03 12:00:00"), "v") == [(2,)]
    assert rows(scans.latest_snapshot(df, "2024-02-01")) == []


def test_equal_dim_rows_do_not_multiply(spark):
    df = spark.createDataFrame([(1,), (2,)], "k int")
    dim = spark.createDataFrame([(1, "a"), (1, "a"), (1, "b")], "id int, n string")
    assert rows(dims.lookup(df, dim, "k", "id", {"n": "n"})) == [(1, "a"), (1, "b"), (2, None)]


def test_reconcile(spark):
    e = spark.createDataFrame([(1, 100.0), (2, 100.0), (3, None), (4, 5.0), (5, 0.0), (6, 1.0)], "k int, r double")
    a = spark.createDataFrame([(1, 100.0), (2, 101.0), (3, 1.0), (4, 0.0), (5, 0.0)], "k int, r double")
    assert [r[0] for r in rows(quality.reconcile(e, a, ["k"], ["r"]))] == [2, 4]
    assert quality.reconcile(e, e, ["k"], ["r"]).count() == 0


def test_partition_filters_reach_the_scan(spark, tmp_path):
    path = str(tmp_path / "supply")
    supply = warehouse(spark, SF_DIR).supply_hourly
    sink.write_partitions(supply.withColumn("dt", F.concat(F.substring("dt", 1, 7), F.lit("-01T00:00:00Z"))), path)
    wh = Warehouse.from_parquet(spark, {"supply_hourly": path})
    plan = plan_text(health.group_totals(wh, CFG, Period("1996-01-01T00", "1996-06-30")))
    scan = next(line for line in plan.splitlines() if "PartitionFilters" in line)
    filters = scan.split("PartitionFilters: [")[1].split("]")[0]
    assert "1996-01-01T00" in filters and "1996-06-30" in filters
    assert "platform" not in scan.split("ReadSchema")[1]


def test_sink_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "out")
    day = lambda dt, v: spark.createDataFrame([(dt, v)], "dt string, v int")
    for dt, v in (("a", 1), ("b", 2), ("b", 3)):
        sink.write_partitions(day(dt, v), path)
    assert rows(spark.read.parquet(path), "dt", "v") == [("a", 1), ("b", 3)]


def test_an_hour_that_becomes_empty_is_emptied(spark, tmp_path):
    wh, path, hour = warehouse(spark, SF_DIR), str(tmp_path / "hourly"), "2000-07-26T22:00:00Z"
    part = sink.partition_path(path, "dt", hour)
    hourly_run(wh, CFG, hour, path, AS_OF, LIMIT_DAYS)
    first = rows(spark.read.parquet(part))
    hourly_run(wh, CFG, hour, path, AS_OF, LIMIT_DAYS)
    assert first and rows(spark.read.parquet(part)) == first
    hourly_run(wh, CFG, "2000-07-26T23:00:00Z", path, AS_OF, LIMIT_DAYS)
    none = wh.with_tables(impressions=wh.impressions.limit(0), matched_installs=wh.matched_installs.limit(0),
                          unmatched_installs=wh.unmatched_installs.limit(0), matched_app_events=wh.matched_app_events.limit(0),
                          unmatched_app_events=wh.unmatched_app_events.limit(0), app_events=wh.app_events.limit(0))
    hourly_run(none, CFG, hour, path, AS_OF, LIMIT_DAYS)
    assert rows(spark.read.parquet(part)) == []
    assert hour_bounds("2024-02-28T23:00:00Z")[1] == "2024-02-29T00:00:00Z"


def test_many_tasks_write_few_files(spark, tmp_path):
    path = str(tmp_path / "few")
    df = spark.range(0, 8000, 1, 8).selectExpr("cast(id % 20 as string) AS dt", "id AS v")
    sink.write_partitions(df, path)
    assert sum(1 for _ in Path(path).rglob("*.parquet")) <= 40
    assert spark.read.parquet(path).count() == 8000


def test_a_log_that_grows_changes_no_interval_of_an_earlier_day(spark):
    day = lambda d: f"2024-01-{d:02} 00:00:00"
    log = [(1, 1, day(1)), (2, 1, day(2))]
    df = lambda r: spark.createDataFrame(r, "change_id long, k int, t string").withColumn("t", F.to_timestamp("t"))
    then = rows(validity_intervals(df(log), ["k"], "t", "2024-01-03"), "change_id", "valid_from", "valid_to")
    now = rows(validity_intervals(df([*log, (3, 1, day(5))]), ["k"], "t", "2024-01-03"), "change_id", "valid_from", "valid_to")
    assert then == now and len(then) == 2


def test_snapshots_after_as_of_are_not_seen(spark):
    df = spark.createDataFrame([("2024-01-02T00:00:00Z", 1), ("2024-01-05T00:00:00Z", 2)], "dt string, v int")
    assert rows(scans.latest_snapshot(df, "2024-01-03"), "v") == [(1,)]


def test_slices_do_not_change_histories(spark):
    wh = warehouse(spark, SF_DIR)
    found = [rows(target_history(wh, replace(CFG, slice_by=s), AS_OF)) for s in (None, "week", "month")]
    assert found[0] and found[0] == found[1] == found[2]


def test_ages_count_to_the_day(spark):
    made = spark.createDataFrame(
        [(1, "2024-01-01 12:00:00"), (2, "2024-01-01 00:00:00")], "id long, created_at string"
    ).selectExpr("id", "to_timestamp(created_at) AS created_at", "5000D AS daily_revenue_limit", "1 AS campaign_type_id", "'enabled' AS state")
    for as_of in ("2024-02-03", "2024-02-03 15:00:00"):
        assert rows(dims.eligible_campaigns(made, as_of, CFG), "id") == [(2,)]


def test_large_plans_have_no_cross_join_and_no_python(spark):
    wh = warehouse(spark, SF_DIR)
    for df in (
        dataset.daily_dataset(wh, CFG, TRAFFIC, DAYS, BUSINESS, AS_OF, EARLY),
        hourly.hourly_dataset(wh, CFG, FIRST_HOUR, LAST_HOUR, AS_OF, LIMIT_DAYS),
    ):
        plan = plan_text(df)
        for bad in ("NestedLoop", "Cartesian", "Python", "Pandas", "SinglePartition, REPARTITION"):
            assert bad not in plan


def test_daily_dataset_reads_supply_once(spark, tmp_path):
    derived = warehouse(spark, SF_DIR)
    path = str(tmp_path / "s")
    derived.supply_hourly.write.parquet(path)
    wh = derived.with_tables(supply_hourly=spark.read.parquet(path))
    # Measured parts would store the facts first; one part leaves the whole plan in one piece.
    plan = plan_text(dataset.daily_dataset(wh, replace(CFG, key_splits=1), TRAFFIC, DAYS, BUSINESS, AS_OF, EARLY))
    scans_ = [line for line in plan.splitlines() if "FileScan" in line and "event_at#" in line]
    assert len(scans_) == 1


def test_unknown_tables_are_refused():
    with pytest.raises(ValueError):
        Warehouse({"nope": None})
    with pytest.raises(KeyError):
        Warehouse({}).margins


def test_catalog_names_and_columns(spark):
    wh = warehouse(spark, SF_DIR)
    wh.supply_hourly.withColumnRenamed("event_at", "happened").createOrReplaceTempView("supply_view")
    found = Warehouse.from_catalog(
        spark, {"supply_hourly": "supply_view"}, columns={"supply_hourly": {"happened": "event_at"}}
    )
    assert sorted(found.supply_hourly.columns) == sorted(wh.supply_hourly.columns)
    period = Period("1996-01-01T00", "1996-06-30")
    assert rows(health.group_totals(found, CFG, period)) == rows(health.group_totals(wh, CFG, period)) != []


def test_long_and_short_exclusions_agree(spark):
    wh = warehouse(spark, SF_DIR)
    ids = [r[0] for r in wh.campaigns.select("id").orderBy("id").limit(60).collect()]
    few = eligibility.install_goal_report(wh, CFG, AS_OF, exclude=ids)
    many = eligibility.install_goal_report(wh, CFG, AS_OF, exclude=spark.createDataFrame([(i,) for i in ids], "id long"))
    assert rows(few) == rows(many)
    assert few.count() <= eligibility.install_goal_report(wh, CFG, AS_OF).count()


def test_recent_days_are_bounded_as_text(spark, tmp_path):
    path = str(tmp_path / "attr")
    wh = warehouse(spark, SF_DIR)
    wh.daily_attr_d7.write.parquet(path)
    stored = wh.with_tables(daily_attr_d7=spark.read.parquet(path))
    plan = plan_text(eligibility.margin_goal_report(stored, CFG, AS_OF))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "revenue_micros_d1" in line)
    assert "GreaterThanOrEqual(dt,2001-12-17)" in scan
    assert "LeftSemi" in plan
