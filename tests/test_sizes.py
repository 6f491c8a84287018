"""Work of as-of joins and their plans: what is repeated, shuffled and written."""

from __future__ import annotations

from dataclasses import replace

from helpers import plan_text, rows

from conformance.registry import AFTER, AS_OF, BEFORE, BUSINESS, CFG, CHECKS, DAYS, EARLY, TRAFFIC
from conformance import elementary  # noqa: F401
from conformance.reports import FIRST_HOUR, HOURS, LAST_HOUR, LIMIT_DAYS
from conformance.tables import warehouse
from marginlab.operators import asof, quality
from marginlab.operators.asof import History, bucket_length, stored_history
from marginlab.plans import bi, dataset, hourly
from marginlab.settings import Period
from marginlab.sources.scans import in_either
from marginlab.streaming import hourly_run as runs
from marginlab.streaming.hourly_run import backfill, hourly_config_run, hourly_run

SMALL = "/root/testdata/sf0.001"


def recorded(monkeypatch, *modules):
    """Names of the tables that are written from now on."""
    names = []
    for m in modules:
        was = m.stored
        monkeypatch.setattr(m, "stored", lambda df, name, was=was: names.append(name) or was(df, name))
    return names


def test_buckets_are_as_long_as_intervals_are(spark):
    iv = spark.range(10).selectExpr("id AS k", "timestamp'2020-01-01' AS valid_from", "timestamp'2020-10-27' AS valid_to", "1 AS v")
    held = stored_history(History(iv, {"v": "v"}), "k", "day")
    assert bucket_length([held], 28) == 300 and bucket_length([held], 364) == 364
    none = stored_history(History(iv.limit(0), {"v": "v"}), "k", "day")
    assert bucket_length([none], 28) == 28


def test_cut_cells_and_whole_ones_give_the_same_daily_rows(spark, monkeypatch):
    """Facts are not written, and parts of heavy campaigns change no sum."""
    wh = warehouse(spark, SMALL)
    run = lambda cfg: dataset.daily_dataset(wh, cfg, TRAFFIC, DAYS, BUSINESS, AS_OF, EARLY)
    whole = rows(run(replace(CFG, key_splits=1)))
    monkeypatch.setattr(asof, "LEAST_PART", 1)
    monkeypatch.setattr(asof, "PARTS_PER_PARTITION", 400)
    names = recorded(monkeypatch, asof, dataset)
    assert rows(run(CFG)) == whole
    assert "heavy-keys" in names and "facts" not in names
    assert rows(run(replace(CFG, key_splits=3))) == whole


def test_partitions_grow_with_the_rows(spark):
    assert asof.partitions_for(spark, 10) == 8
    assert asof.partitions_for(spark, 100 * asof.ROWS_PER_PARTITION + 1) == 101


def test_a_backfill_builds_its_settings_once(spark, monkeypatch, tmp_path):
    names = recorded(monkeypatch, asof)
    backfill(hourly_config_run, warehouse(spark, SMALL), CFG, HOURS[0], HOURS[2], str(tmp_path), AS_OF, LIMIT_DAYS)
    assert names.count("history") == 4 and names.count("facts") == 2


def test_both_sides_are_compared_without_a_join_of_them(spark):
    one = spark.range(1000).selectExpr("id AS k", "id AS r")
    other = spark.range(10, 1001).selectExpr("id AS k", "if(id = 500, 1, id) AS r")
    found = quality.reconcile_both(one, other, ["k"], ["r"])
    plan = plan_text(found)
    assert "FullOuter" not in plan and "SortMergeJoin" not in plan
    kinds = [r.finding for r in found.collect()]
    assert (kinds.count("missing"), kinds.count("unexpected"), kinds.count("changed")) == (10, 1, 1)


def test_the_update_timeline_has_more_partitions_for_a_longer_log(spark, monkeypatch):
    """Its distinct rows are found in partitions sized by the rows of the log, not by the session's number."""
    wh = warehouse(spark, SMALL)
    run = lambda: dataset.update_timeline(wh, CFG, AS_OF, EARLY, AFTER, BEFORE)
    whole = rows(run())
    monkeypatch.setattr(asof, "ROWS_PER_PARTITION", 100)
    log = wh.change_log.count()
    assert log > 800 and run().rdd.getNumPartitions() == -(-log // 100)
    assert rows(run()) == whole and len(set(whole)) == len(whole)


def test_a_lag_over_a_left_join_has_more_partitions_for_more_facts(spark, monkeypatch):
    """Both sides are added up and joined in partitions sized by the rows of the facts."""
    run = lambda: CHECKS["w6_lag_over_left_join"].run(spark, SMALL)
    whole = rows(run())
    monkeypatch.setattr(asof, "ROWS_PER_PARTITION", 100)
    parts = -(-warehouse(spark, SMALL).daily_fact.count() // 100)
    assert parts > 8 and plan_text(run()).count(f", {parts}), REPARTITION_BY_NUM") == 2
    assert rows(run()) == whole


def test_long_methods_are_left_to_single_operators(spark):
    """Whole-stage methods over 8,000 bytes would run uncompiled."""
    warehouse(spark, SMALL)
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"


def test_daily_rows_of_groups_without_updates_count_in_all_business_alone(spark):
    found = dataset.supply_rows(warehouse(spark, SMALL), CFG, TRAFFIC, DAYS, BUSINESS)
    groups = {r[0] for r in found.select("test_group_name").distinct().collect()}
    assert groups == {None, CFG.holdout, *CFG.margin_types}


def test_a_key_in_either_of_two_periods(spark):
    keys = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("e",), (None,)], "k string")
    pick = lambda one, other: rows(keys.filter(in_either("k", Period(*one), Period(*other))))
    assert pick("ab", "de") == [("a",), ("b",), ("d",), ("e",)] and pick("bd", "ac") == [("a",), ("b",), ("c",), ("d",)]


def test_hourly_rows_of_groups_without_margins_are_not_moved(spark):
    found = hourly.hourly_measures(warehouse(spark, SMALL), CFG, FIRST_HOUR, LAST_HOUR)
    assert {r[0] for r in found.select("test_group_name").distinct().collect()} == set(CFG.margin_types)


def test_a_backfill_reads_the_facts_of_its_hours_in_one_pass(spark, monkeypatch, tmp_path):
    wh = warehouse(spark, SMALL)
    names = recorded(monkeypatch, runs)
    backfill(hourly_run, wh, CFG, HOURS[0], HOURS[2], str(tmp_path / "all"), AS_OF, LIMIT_DAYS)
    assert names == ["hourly-facts"]
    for h in HOURS[:2]:
        hourly_run(wh, CFG, h, str(tmp_path / "each"), AS_OF, LIMIT_DAYS)
    both = [spark.read.parquet(str(tmp_path / d)) for d in ("all", "each")]
    assert rows(both[0]) == rows(both[1])


def test_few_facts_take_the_intervals_of_their_keys_alone(spark, monkeypatch):
    iv = spark.range(100).selectExpr("id AS k", "timestamp'2020-01-01' AS valid_from", "timestamp'2020-02-01' AS valid_to", "id AS v")
    facts = spark.createDataFrame([(1,), (2,), (2,), (None,)], "k long").selectExpr("k", "timestamp'2020-01-05' AS t")
    run = lambda: asof.as_of_enrich(facts, "k", "t", [History(iv, {"v": "v"})], splits=None)
    few = run()
    assert "LeftSemi" in plan_text(few)
    monkeypatch.setattr(asof, "FEW_ROWS", 0)
    assert rows(few) == rows(run()) and "LeftSemi" not in plan_text(run())


def test_dashboard_rows_of_days_without_changes_do_not_move_to_meet_them(spark, monkeypatch):
    names = recorded(monkeypatch, bi)
    wh = warehouse(spark, SMALL)
    found = CHECKS["q26_dashboard_dataset"].build(type("C", (), {"wh": wh}))
    assert names == ["paired-days", "daily-rows"]
    plan = plan_text(found)
    assert plan.count("Union") >= 1 and found.filter("updated_date IS NULL").count() > 0
