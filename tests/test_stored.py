"""What is kept between runs: published partitions, histories, cohorts."""

from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from helpers import plan_text, rows
from pyspark.sql import functions as F

from marginlab.operators.history import validity_intervals
from marginlab.sources import sink
from marginlab.streaming.cohorts import COHORT, CohortStore
from marginlab.streaming.stored_history import StoredHistory

T0 = datetime(2024, 1, 1)
LOG = "change_id long, k int, kind string, logged_at timestamp, v string"
HOURS = "hour string, n long"


def log(seed, n=160):
    """Rows in the order of arrival; some come long after their time, some share it."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        at = T0 + timedelta(hours=i // 2) - timedelta(hours=rnd.choice([0, 0, 0, 0, 5, 300]))
        out.append((i, rnd.choice([1, 1, 1, 2, 3, 4, None]), rnd.choice("ab"), at if rnd.random() > 0.03 else None, f"v{i}"))
    return out


@pytest.mark.parametrize("seed, lead", [(1, 1), (2, 2)])
def test_history_by_increments_equals_history_in_one_go(spark, tmp_path, seed, lead):
    table = log(seed)
    history = StoredHistory(spark, f"{tmp_path}/h", ["k", "kind"], lead=lead)
    for step, upto in enumerate((60, 61, 100, 100, 160)):
        taken = spark.createDataFrame(table[:upto], LOG)
        assert history.append(taken) == (step != 3)
        if step == 2:
            history.compact()
        if step < 2:
            continue
        for as_of in (T0 + timedelta(days=9), T0 + timedelta(hours=20, minutes=30))[: 1 + (step == 4)]:
            kept = history.intervals(as_of, trunc="day" if step == 4 else None)
            want = validity_intervals(
                taken.filter("logged_at IS NOT NULL"), ["k", "kind"], "logged_at", as_of, lead, "day" if step == 4 else None
            )
            assert rows(kept, *sorted(kept.columns)) == rows(want, *sorted(want.columns)), (step, as_of)


def test_a_run_reads_open_intervals_and_those_that_late_rows_split(spark, tmp_path):
    table = [(i, i % 5, "a", T0 + timedelta(hours=i), "v") for i in range(100)]
    history = StoredHistory(spark, f"{tmp_path}/h", ["k"])
    history.append(spark.createDataFrame(table[:90], LOG))
    history.append(spark.createDataFrame(table, LOG))
    runs = history._complete()
    assert spark.read.parquet(f"{runs[1].folder}/gone").count() == 0
    assert spark.read.parquet(f"{runs[1].folder}/closed").count() == 10
    late = (100, 3, "a", T0 + timedelta(hours=40, minutes=30), "late")
    history.append(spark.createDataFrame([late], LOG))
    gone = [r[0] for r in spark.read.parquet(f"{history._complete()[2].folder}/gone").collect()]
    assert min(gone) == 38 and all(g % 5 == 3 for g in gone)
    assert spark.read.parquet(f"{history._complete()[2].folder}/still_open").count() == 4


def test_a_run_that_fails_leaves_the_history_as_it_was(spark, tmp_path):
    table = spark.createDataFrame(log(5), LOG)
    history = StoredHistory(spark, f"{tmp_path}/h", ["k"])
    history.append(table.filter("change_id < 80"))
    before = rows(history.intervals(T0 + timedelta(days=9)))
    broken = table.withColumn("v", F.when(F.col("change_id") < 150, F.col("v")).otherwise(F.raise_error(F.lit("lost"))))
    with pytest.raises(Exception, match="lost"):
        history.append(broken)
    assert rows(history.intervals(T0 + timedelta(days=9))) == before
    assert history.append(table)


def test_open_end_may_differ_from_as_of(spark, tmp_path):
    history = StoredHistory(spark, f"{tmp_path}/h", ["k"])
    history.append(spark.createDataFrame(log(3), LOG))
    as_of, end = T0 + timedelta(days=1), F.lit("2024-02-02").cast("timestamp")
    want = validity_intervals(spark.createDataFrame(log(3), LOG), ["k"], "logged_at", as_of, open_end=end)
    kept = history.intervals(as_of, open_end=end)
    assert rows(kept, *sorted(kept.columns)) == rows(want, *sorted(want.columns))


def test_a_reader_meets_the_old_hour_until_the_new_one_is_complete(spark, tmp_path):
    path = f"{tmp_path}/hours"
    read = lambda: rows(sink.read_published(spark, path, HOURS, "dt"), "dt", "hour", "n")
    first = spark.createDataFrame([("a", 1, "2024-01-01T00:00:00Z"), ("b", 2, "2024-01-01T01:00:00Z")], f"{HOURS}, dt string")
    sink.publish_partitions(first, path, ["2024-01-01T00:00:00Z", "2024-01-01T01:00:00Z"])
    old = [("2024-01-01T00:00:00Z", "a", 1), ("2024-01-01T01:00:00Z", "b", 2)]
    assert read() == old
    half = first.repartition(2).withColumn("n", F.when(F.col("n") == 1, 7).otherwise(F.raise_error(F.lit("lost")).cast("long")))
    with pytest.raises(Exception, match="lost"):
        sink.publish_partitions(half, path, ["2024-01-01T00:00:00Z", "2024-01-01T01:00:00Z"])
    assert read() == old
    sink.publish_partitions(first.filter("n = 2").withColumn("n", F.lit(3).cast("long")), path, ["2024-01-01T01:00:00Z"])
    assert read() == [old[0], ("2024-01-01T01:00:00Z", "b", 3)]
    sink.publish_partitions(first.limit(0), path, ["2024-01-01T00:00:00Z"])
    assert read() == [("2024-01-01T01:00:00Z", "b", 3)]


def events(spark, seed, n=400):
    rnd = random.Random(seed)
    made = [
        (f"2024-01-{rnd.randint(1, 9):02d}", rnd.choice(["x", "y", None]), rnd.randint(0, 30), rnd.choice([1, None]), rnd.randint(-10, 900) * 1_000_000)
        for _ in range(n)
    ]
    return spark.createDataFrame(made, f"{COHORT} string, who string, unit int, installs int, micros long")


def store(spark, path):
    return CohortStore(spark, path, {"who": "string"}, {"unit": "int"}, ["installs"], "micros", 500.0)


def numbers(df):
    return [tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in rows(df, COHORT, "who", "installs", "units", "sum_capped", "sum_squared_capped")]


def test_two_batches_equal_one(spark, tmp_path):
    first, late = events(spark, 1), events(spark, 2, 20)
    apart, whole = store(spark, f"{tmp_path}/a"), store(spark, f"{tmp_path}/b")
    apart.add("one", first)
    touched = apart.add("late", late)
    assert touched == sorted({r[0] for r in late.select(COHORT).collect()}) and len(touched) < 9.5
    whole.add("all", first.unionByName(late))
    assert numbers(apart.result()) == numbers(whole.result())


def test_a_batch_added_again_replaces_itself(spark, tmp_path):
    kept, other = store(spark, f"{tmp_path}/a"), store(spark, f"{tmp_path}/b")
    one, two = events(spark, 1), events(spark, 2)
    kept.add("one", one)
    kept.add("two", two)
    kept.add("two", two)
    both = other
    both.add("both", one.unionByName(two))
    assert numbers(kept.result()) == numbers(both.result())
    kept.add("two", two.filter(f"{COHORT} > '2024-01-05'"))
    both.add("both", one.unionByName(two.filter(f"{COHORT} > '2024-01-05'")))
    assert numbers(kept.result()) == numbers(both.result())
    kept.add("one", one.limit(0))
    kept.add("two", two.limit(0))
    assert kept.result().count() == 0


def test_days_that_a_batch_does_not_touch_are_not_read(spark, tmp_path):
    kept = store(spark, f"{tmp_path}/a")
    kept.add("one", events(spark, 1))
    plan = plan_text(kept._summed(["2024-01-03"]))
    filters = plan.split("PartitionFilters: [")[1].split("]")[0]
    assert COHORT in filters and "2024-01-03" in filters
