from __future__ import annotations

from datetime import datetime, timedelta

from helpers import rows
from pyspark.sql import functions as F

from marginlab import Period, Settings
from marginlab.functions import buckets, money, nested, times
from marginlab.operators.funnel import capped, capped_moments, cohort_sum, explode_test, stack_funnel
from marginlab.sources.scans import in_period

CFG = Settings()
T0 = datetime(2024, 1, 1)


def one(spark, schema, values, expr):
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, " + schema)
    return [r[1] for r in sorted(df.select("i", expr.alias("x")).collect())]


def test_seven_day_edge(spark):
    ages = [timedelta(days=6, hours=23), timedelta(days=7), None, timedelta(days=-1)]
    values = [(T0, None if a is None else T0 - a) for a in ages]
    df = spark.createDataFrame([(i, *v) for i, v in enumerate(values)], "i int, at timestamp, inst timestamp")
    out = df.groupBy("i").agg(cohort_sum(F.lit(5), "at", "inst", 7).alias("s"))
    assert [r[1] for r in rows(out)] == [5, 0, 0, 5]
    ms = one(spark, "a long, b long", [(7 * 86400000 - 1, 0), (7 * 86400000, 0)], times.within_days_ms("a", "b", 7))
    assert ms == [True, False]


def test_cap(spark):
    assert one(spark, "v long", [(499999999,), (500000000,), (900000000,)], capped("v", 500.0)) == [
        499.999999, 500.0, 500.0,
    ]
    df = spark.createDataFrame(
        [("g", "u1", 400_000_000), ("g", "u1", 900_000_000), ("g", "u2", 1_000_000)], "g string, u string, v long"
    )
    assert rows(capped_moments(df, ["u"], ["g"], "v", 500.0)) == [("g", 901.0, 900.0**2 + 1)]


def test_network_rates(spark):
    values = [(1000, k, x) for k, x in [(1, "N"), (2, "N"), (3, "N"), (7, "N"), (None, "N"), (1, "o"), (1, None)]]
    rate = money.net_revenue_by_rate("s", "k", F.col("x") == "N", CFG.network_rates, CFG.other_network_rate)
    got = [float(v) for v in one(spark, "s long, k int, x string", values, rate)]
    assert got == [352.6, 443.7, 301.6, 331.9, 0.0, 0.0, 0.0]


def test_payout_types(spark):
    kinds = ["FLAT_CPM", "REVENUE_SHARE", "HEADER_BIDDING", "other", None]
    values = [(10000, (k, 2999, 0.25), 4000) for k in kinds]
    schema = (
        "s long, t struct<payout_type: string, publisher_flat_cpm_micros: long,"
        " publisher_revenue_share: double>, m long"
    )
    assert one(spark, schema, values, money.net_revenue_by_payout("s", F.col("t"), "m")) == [
        9998.0, 7500.0, 6000.0, 0.0, 0.0,
    ]
    off = money.net_revenue_by_payout("s", F.col("t"), "m", F.lit(False))
    assert one(spark, schema, values, off) == [0.0] * 5


ASSIGNED = "a array<struct<id: int, group: struct<id: int, name: string>>>"


def test_assignments(spark):
    mine, other = (916, (2064, "control")), (7, (1, "x"))
    values = [([],), (None,), ([other],), ([other, mine, (916, (2065, "experiment"))],)]
    assert one(spark, ASSIGNED, values, nested.ab_group("a", 916)) == [None, None, None, "control"]
    df = spark.createDataFrame(values, ASSIGNED)
    assert rows(explode_test(df, "a", 916).select("test_group.name")) == [("control",), ("experiment",)]


def test_json(spark):
    values = [('{"a":1}',), ('{"t":null}',), ('{"t":""}',), ('{"t":"NR"}',), (None,)]
    assert one(spark, "j string", values, nested.json_has("j", "t")) == [False, True, True, True, False]
    assert one(spark, "j string", values, nested.json_scalar("j", "t")) == [None, None, "", "NR", None]
    nests = [('{"t":{"a":1}}',), ('{"t":[1]}',), ('{"t":"{x"}',), ('{"t":"[1]"}',), ('{"t":1.50}',), ('{"t":tru',)]
    assert one(spark, "j string", nests, nested.json_scalar("j", "t")) == [None, None, "{x", "[1]", "1.5", None]
    raw = [(b'{"imp":[{"ext":{"pptype":3}}]}',), (b'{"imp":[]}',), (b'{"imp":[{"ext":{"pptype":"x"}}]}',), (None,)]
    assert one(spark, "b binary", raw, nested.json_int_in_bytes("b")) == [3, None, None, None]


def test_ad_format_precedence(spark):
    values = [
        ("NATIVE", "L300x250"), ("VIDEO", "L0x0"), ("VIDEO", "L300x250"), ("VIDEO", "L728x90"),
        (None, None), ("VIDEO", "UNKNOWN_LOGICAL_SIZE"), ("VIDEO", "L1x1"), ("NATIVE", None),
    ]
    assert one(spark, "c string, s string", values, buckets.ad_format("c", "s")) == [
        "native", "native", "mrec", "banner", "UNKNOWN_LOGICAL_SIZE", "UNKNOWN_LOGICAL_SIZE",
        "interstitial", "native",
    ]


def test_text_period_leaves_the_upper_day_out(spark):
    p = Period("2023-12-30T00", "2024-01-01")
    values = [("2023-12-30T00:00:00Z",), ("2023-12-31T23:00:00Z",), ("2024-01-01T00:00:00Z",)]
    assert one(spark, "dt string", values, in_period("dt", p)) == [True, True, False]


def test_full_days_and_iso_forms(spark):
    values = [(T0, T0 + timedelta(days=8, hours=23)), (T0.replace(hour=23), T0 + timedelta(days=9))]
    assert one(spark, "a timestamp, b timestamp", values, times.full_days("a", "b")) == [8, 8]
    texts = [("2024-01-01T00",), ("2024-01-01T00:00:00Z",), ("2024-01-01",)]
    assert one(spark, "s string", texts, times.iso_timestamp("s")) == [T0] * 3
    assert one(spark, "t timestamp", [(T0,)], times.iso_text("t")) == ["2024-01-01T00:00:00Z"]


def test_net_margin_at_minus_one_is_null(spark):
    assert one(spark, "g double", [(0.25,), (-1.0,), (None,)], money.net_margin("g")) == [0.2, None, None]


def test_stacked_sum_equals_sum_of_branches(spark):
    a = spark.createDataFrame([(1, 2), (1, 3), (2, 4)], "k int, x long")
    b = spark.createDataFrame([(1, 10), (3, 20)], "k int, y long")
    out = stack_funnel([a, b], {"k": "int"}, {"x": "bigint", "y": "bigint"})
    assert rows(out) == [(1, 5, 10), (2, 4, 0), (3, 0, 20)]
