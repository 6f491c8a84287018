"""Nearest pairs, two-sided reconciliation, intervals of ratios."""

from __future__ import annotations

import random
import statistics
from datetime import datetime, timedelta

import pytest
from helpers import plan_text, rows
from pyspark.sql import functions as F

from marginlab.operators import moments, quality
from marginlab.operators.history import nearest_pairs
from marginlab.operators.neighbors import with_last

T0 = datetime(2024, 1, 1)


def changes(spark, name, n, seed, hours=24 * 40):
    rnd = random.Random(seed)
    made = [(rnd.choice([1, 1, 2, None]), T0 + timedelta(hours=rnd.randint(0, hours)), 2 * i + (name == "e"), rnd.choice([None, 0.1, 0.2])) for i in range(n)]
    return spark.createDataFrame(made, f"k int, ts timestamp, change_id long, {name} double")


def paired(control, experiment):
    """Brute force: for each change the last of the other side."""
    every = [(*r, "control") for r in control] + [(*r, "experiment") for r in experiment]
    out = []
    for k, ts, i, _, side in every:
        last = {}
        for s in ("control", "experiment"):
            before = [r for r in every if r[0] == k and r[4] == s and (r[1], r[2]) <= (ts, i)]
            last[s] = max(before, key=lambda r: (r[1], r[2]))[3] if before else None
        c = last["control"] if last["control"] is not None else last["experiment"]
        out.append((k, ts, i, side, c, last["experiment"]))
    return sorted(out, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("slice_by", ["week", None])
def test_nearest_pairs_equal_brute_force(spark, slice_by):
    control, experiment = changes(spark, "c", 60, 1), changes(spark, "e", 50, 2)
    found = nearest_pairs(control, experiment, ["k"], "ts", {"c": "e"}, slice_by=slice_by)
    assert rows(found, "k", "ts", "change_id", "side", "c", "e") == paired([tuple(r) for r in control.collect()], [tuple(r) for r in experiment.collect()])


def test_ten_thousand_changes_of_a_day_are_as_many_rows(spark):
    made = spark.range(10_000).selectExpr("1 AS k", "timestamp'2024-01-01' + make_dt_interval(0, 0, 0, id) AS ts", "id AS change_id", "id AS v")
    found = nearest_pairs(
        made.filter("id % 2 = 0").withColumnRenamed("v", "c"), made.filter("id % 2 = 1").withColumnRenamed("v", "e"), ["k"], "ts"
    )
    assert found.count() == 10_000
    assert found.filter("change_id > 0 AND abs(c - e) <> 1").count() == 0


def test_last_values_keep_rows_without_time_or_value(spark):
    made = [(1, None, 1, "late"), (1, T0, 2, None), (1, T0, 3, "a"), (1, T0 + timedelta(days=30), 4, None), (2, T0, 5, None), (None, T0, 6, "n"), (None, T0, 7, None)]
    df = spark.createDataFrame(made, "k int, ts timestamp, change_id int, v string")
    want = {1: "late", 2: None, 3: "a", 4: "a", 5: None, 6: "n", 7: "n"}
    for slice_by in ("week", None):
        assert {r.change_id: r.last for r in with_last(df, ["k"], "ts", {"last": "v"}, slice_by=slice_by).collect()} == want


def test_planted_differences_are_found(spark):
    rnd = random.Random(4)
    held = {(k, d): rnd.choice([None, 0, rnd.randint(1, 10_000)]) for k in (*range(300), None) for d in ("a", "b")}
    published = dict(held)
    gone = [key for key in held if rnd.random() < 0.01] + [(None, "a")]
    for key in gone:
        published.pop(key, None)
    published |= {(1_000, "a"): 5, (1_001, None): None}
    changed = [k for k in published if k in held and rnd.random() < 0.02 and held[k]]
    for k in changed:
        published[k] = None if rnd.random() < 0.3 else published[k] * 2
    table = lambda d: spark.createDataFrame([(*k, v) for k, v in d.items()], "k int, d string, r long")
    found = quality.reconcile_both(table(held), table(published), ["k", "d"], ["r"]).collect()
    by = lambda f: sorted([(r.k, r.d) for r in found if r.finding == f], key=str)
    assert by("missing") == sorted(set(gone), key=str)
    assert by("unexpected") == sorted([(1_000, "a"), (1_001, None)], key=str)
    assert by("changed") == sorted(changed, key=str) and changed
    assert quality.reconcile_both(table(held), table(held), ["k", "d"], ["r"]).count() == 0


def test_only_ranges_that_differ_are_compared(spark, tmp_path):
    spark.range(20_000).selectExpr("id AS k", "id * 10 AS r").write.parquet(f"{tmp_path}/e")
    spark.range(20_000).selectExpr("id AS k", "if(id = 77, 1, id * 10) AS r").write.parquet(f"{tmp_path}/a")
    e, a = spark.read.parquet(f"{tmp_path}/e"), spark.read.parquet(f"{tmp_path}/a")
    assert quality.differing_ranges(e, a, ["k"], ["r"]).count() == 1
    out = quality.reconcile_both(e, a, ["k"], ["r"])
    assert [(r.k, r.finding) for r in out.collect()] == [(77, "changed")]
    # Each side once more, for the rows of that range, and the list of ranges for both.
    assert plan_text(out).split("Initial Plan")[0].count("FileScan parquet") <= 4


def test_rows_that_differ_only_in_where_a_null_is(spark):
    one = spark.createDataFrame([(1, None, 5)], "k int, x int, y int")
    two = spark.createDataFrame([(1, 5, None)], "k int, x int, y int")
    assert [r.finding for r in quality.reconcile_both(one, two, ["k"], ["x", "y"]).collect()] == ["changed"]


def test_tolerance_and_zero(spark):
    table = lambda *r: spark.createDataFrame([*enumerate(r)], "k int, r double")
    found = quality.reconcile_both(table(1.0, 1.0, 5.0, 0.0, 1.0), table(1.0005, 1.002, 0.0, 0.0, 0.0), ["k"], ["r"])
    assert rows(found, "k") == [(1,), (2,), (4,)]


def test_merged_moments_give_the_interval_of_all_units(spark):
    rnd = random.Random(9)
    units = [(g, rnd.randint(0, 5), rnd.random() * 100, float(rnd.randint(0, 9))) for g in ("control", "experiment") for _ in range(80)]
    parts = moments.unit_moments(spark.createDataFrame(units, "g string, day int, x double, y double"), ["g", "day"], "x", "y")
    merged = moments.merge_moments(parts, ["g"])
    ratio, variance = {}, {}
    for r in moments.ratio_interval(merged).collect():
        x, y = ([u[i] for u in units if u[0] == r.g] for i in (2, 3))
        want = sum(x) / sum(y)
        linear = statistics.variance([a - want * b for a, b in zip(x, y)])
        ratio[r.g], variance[r.g] = want, linear / len(x) / statistics.mean(y) ** 2
        assert r.ratio == pytest.approx(want) and r.variance == pytest.approx(variance[r.g])
        assert r.high - r.low == pytest.approx(2 * moments.NORMAL_95 * variance[r.g] ** 0.5)
    [lift] = moments.ratio_lift(merged, [], "g", "control", "experiment").collect()
    c, e = ratio["control"], ratio["experiment"]
    assert lift.lift == pytest.approx(e / c - 1)
    half = moments.NORMAL_95 * (variance["experiment"] / c**2 + e**2 * variance["control"] / c**4) ** 0.5
    assert lift.high - lift.lift == pytest.approx(half)


def test_intervals_cover_the_ratio_as_often_as_they_say(spark):
    """400 samples of 200 units with a known ratio: about 95 % of the intervals hold it."""
    units = spark.range(80_000).selectExpr("id % 400 AS g", "rand(7) AS u", "rand(11) AS v").selectExpr("g", "1 + 4 * u AS y", "3 * (1 + 4 * u) + 2 * (v - 0.5) AS x")
    found = moments.ratio_interval(moments.unit_moments(units, ["g"], "x", "y"))
    assert 0.92 < found.agg(F.avg(F.expr("double(low < 3 AND high > 3)"))).first()[0] < 0.98


def test_no_units_and_no_spread(spark):
    df = spark.createDataFrame([("a", 1.0, 0.0), ("b", 2.0, 1.0), ("c", 2.0, 1.0), ("c", 2.0, 1.0), ("d", None, 2.0), ("d", 1.0, None)], "g string, x double, y double")
    found = {r.g: (r.ratio, r.variance) for r in moments.ratio_interval(moments.unit_moments(df, ["g"], "x", "y")).collect()}
    assert found["a"] == (None, None) and found["b"] == (2.0, None) and found["c"] == (2.0, 0.0) and found["d"][0] == 0.5
