from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from helpers import rows

from marginlab.operators.history import (
    any_change,
    changed_only,
    control_vs_experiment,
    validity_intervals,
    with_previous,
)
from marginlab.operators.neighbors import with_neighbors

T0 = datetime(2024, 1, 1)


def random_log(n: int, seed: int):
    """Half of the rows on one key; some NULL keys, times and values, many equal times."""
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = rnd.choice(["hot", "hot", "hot", "a", "b", None])
        ts = None if rnd.random() < 0.03 else T0 + timedelta(hours=rnd.randint(0, 900))
        out.append((i, key, ts, None if rnd.random() < 0.1 else rnd.random()))
    return out


@pytest.mark.parametrize("slice_by", ["hour", "day", "week", "month"])
@pytest.mark.parametrize("seed", [1, 2])
def test_slices_equal_plain_window(spark, slice_by, seed):
    log = spark.createDataFrame(
        random_log(400, seed), "change_id long, k string, ts timestamp, v double"
    )
    shifts = {"l1": ("v", 1), "l3": ("v", 3), "n1": ("ts", -1), "n2": ("ts", -2)}
    sliced = with_neighbors(log, ["k"], "ts", shifts, slice_by=slice_by)
    plain = with_neighbors(log, ["k"], "ts", shifts, slice_by=None)
    assert rows(sliced) == rows(plain)


def test_null_previous_value_gets_the_default(spark):
    log = spark.createDataFrame(
        [(1, "a", T0, None), (2, "a", T0 + timedelta(days=40), 0.3)],
        "change_id long, k string, ts timestamp, v double",
    )
    out = with_previous(log, {"old": "v"}, ["k"], "ts", 999999.0)
    assert rows(out, "change_id", "old") == [(1, 999999.0), (2, 999999.0)]
    assert rows(with_previous(log, {"old": "v"}, ["k"], "ts"), "change_id", "old") == [
        (1, None),
        (2, None),
    ]


def test_two_changes_in_one_hour(spark):
    log = spark.createDataFrame(
        [(i, "a", T0.replace(hour=h, minute=m)) for i, (h, m) in enumerate([(10, 5), (10, 40), (12, 0)])],
        "change_id long, k string, ts timestamp",
    )
    out = validity_intervals(log, ["k"], "ts", "2024-01-02 00:00:00", trunc="hour")
    hours = [(f.hour, t.hour, t.day) for _, f, t in rows(out, "change_id", "valid_from", "valid_to")]
    assert hours == [(10, 10, 1), (10, 12, 1), (12, 0, 2)]


def test_interleaved_types_end_at_the_second_next_change(spark):
    log = spark.createDataFrame(
        [(i, "a", T0 + timedelta(days=i)) for i in range(4)], "change_id long, k string, ts timestamp"
    )
    out = validity_intervals(log, ["k"], "ts", "2024-02-01", lead=2)
    ends = [t for _, t in rows(out, "change_id", "valid_to")]
    last = datetime(2024, 2, 1)
    assert ends == [T0 + timedelta(days=2), T0 + timedelta(days=3), last, last]


def test_null_is_no_change(spark):
    df = spark.createDataFrame(
        [(1, None, 0.2), (2, 0.2, 0.2), (3, 0.1, 0.2), (4, 0.1, None)], "i int, a double, b double"
    )
    assert rows(changed_only(df, [("a", "b")]), "i") == [(3,)]
    assert rows(df.filter(any_change([("a", "b"), ("b", "a")])), "i") == [(3,)]


def test_full_pairing_keeps_lone_rows(spark):
    c = spark.createDataFrame([(1, 0.1), (2, 0.2)], "k int, c_old double")
    e = spark.createDataFrame([(2, 0.3), (3, 0.4)], "k int, e_old double")
    out = control_vs_experiment(c, e, ["k"], "full", {"c_old": "e_old"}, {"k": "control"})
    assert rows(out) == [(1, 0.1, None), (2, 0.2, 0.3), (None, 0.4, 0.4)]
