"""Elementary operators: scans, predicates, joins, aggregates, windows, scalars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conformance.registry import AS_OF, CFG, TRAFFIC, Context, check
from marginlab.functions import money, nested, times
from marginlab.operators import dims, history, metrics
from marginlab.operators.asof import partitions_for
from marginlab.operators.neighbors import with_neighbors
from marginlab.plans.bi import previous_matched
from marginlab.session import new_shared_path
from marginlab.sources import scans, sink

AB = 'list_filter(ab_test_assignments, lambda a: a.id = 916)[1]."group".name'


# --- scans, sink, parameters -------------------------------------------------

@check("s1_table_scan", sql="SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders")
def _(c: Context) -> DataFrame:
    return c.raw("orders").select("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice")


@check("s2_period_scan", "supply_hourly", f"""
SELECT campaign_id, dt, impression_at, revenue_micros FROM supply_hourly
WHERE dt >= '{TRAFFIC.start}' AND dt <= '{TRAFFIC.end}'
  AND impression_at >= '{TRAFFIC.start}' AND impression_at <= '{TRAFFIC.end}'""")
def _(c):
    return scans.period_scan(c.wh.supply_hourly, TRAFFIC, "dt", "impression_at").select(
        "campaign_id", "dt", "impression_at", "revenue_micros"
    )


@check("s3_latest_snapshot_scan", "crm_campaign_daily", f"""
SELECT * FROM crm_campaign_daily WHERE dt = (
  SELECT max(dt) FROM crm_campaign_daily
  WHERE CAST(dt AS TIMESTAMP) >= TIMESTAMP '{AS_OF}' - INTERVAL 2 DAY)""")
def _(c):
    return scans.latest_snapshot(c.wh.crm_campaign_daily, AS_OF)


@check("s4_hour_scan", "impressions", """
SELECT dt, count(*) AS n, CAST(sum(spend_micros) AS BIGINT) AS spend FROM impressions
WHERE dt >= '1996-03-01T00:00:00Z' AND dt < '2000-03-01T00:00:00Z' GROUP BY dt""")
def _(c):
    found = scans.hour_scan(c.wh.impressions, "1996-03-01T00:00:00Z", "2000-03-01T00:00:00Z")
    return found.groupBy("dt").agg(F.count(F.lit(1)).alias("n"), F.sum("spend_micros").alias("spend"))


@check("s4_exact_hour_scan", "crm_campaign_daily",
       "SELECT * FROM crm_campaign_daily WHERE dt = '2001-12-30T00:00:00Z'")
def _(c):
    return scans.exact_hour_scan(c.wh.crm_campaign_daily, "2001-12-30T00:00:00Z")


@check("s5_parameters", "change_log", """
WITH para AS (SELECT TIMESTAMP '1996-04-05' AS start_dt, TIMESTAMP '2000-12-30' AS end_dt)
SELECT table_name, count(*) AS n FROM change_log, para
WHERE logged_at >= start_dt AND logged_at < end_dt GROUP BY table_name""")
def _(c):
    start, end = times.moment("1996-04-05"), times.moment("2000-12-30")
    kept = c.wh.change_log.filter((F.col("logged_at") >= start) & (F.col("logged_at") < end))
    return kept.groupBy("table_name").agg(F.count(F.lit(1)).alias("n"))


@check("s6_derived_table", sql="""
WITH per AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY o_custkey)
SELECT n, count(*) AS customers FROM (SELECT n FROM per) AS d GROUP BY n""")
def _(c):
    per = c.raw("orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    return per.groupBy("n").agg(F.count(F.lit(1)).alias("customers"))


@check("s7_partition_sink", "daily_fact", """
SELECT dt, campaign_id, CAST(sum(revenue_micros) AS BIGINT) AS revenue_micros
FROM (SELECT substr(dt, 1, 7) AS dt, campaign_id, revenue_micros FROM daily_fact) AS d
GROUP BY dt, campaign_id""")
def _(c):
    monthly = c.wh.daily_fact.groupBy(F.substring("dt", 1, 7).alias("dt"), "campaign_id").agg(
        F.sum("revenue_micros").alias("revenue_micros")
    )
    out = new_shared_path(c.spark, "marginlab-sink")
    sink.write_partitions(monthly, out)
    # Year-month text would be read back as a date, so the schema is given.
    return c.spark.read.schema("campaign_id bigint, revenue_micros bigint, dt string").parquet(out)


# --- projections, filters, predicates ----------------------------------------

@check("p1_projection", sql="SELECT c_custkey AS id, c_nationkey AS customer_id FROM customer")
def _(c):
    return c.raw("customer").select(
        F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("customer_id")
    )


@check("p2_select_all", sql="SELECT * FROM supplier")
def _(c):
    return c.raw("supplier").select("*")


@check("p3_constant_columns", sql="""
SELECT c_custkey, 0 AS zero, 'ALL' AS grp, CAST(NULL AS VARCHAR) AS nothing FROM customer""")
def _(c):
    return c.raw("customer").select(
        "c_custkey", F.lit(0).alias("zero"), F.lit("ALL").alias("grp"),
        F.lit(None).cast("string").alias("nothing"),
    )


@check("p4_comparison", "campaigns", """
SELECT id, daily_revenue_limit FROM campaigns
WHERE campaign_type_id = 1 AND daily_revenue_limit > 1000 AND id >= 10""")
def _(c):
    return c.wh.campaigns.filter(
        (F.col("campaign_type_id") == 1) & (F.col("daily_revenue_limit") > 1000) & (F.col("id") >= 10)
    ).select("id", "daily_revenue_limit")


@check("p5_inequality", "change_log", """
SELECT change_id, source FROM change_log WHERE source <> 'model'""")
def _(c):
    return c.wh.change_log.filter(F.col("source") != CFG.model_source).select("change_id", "source")


@check("p6_between", "supply_hourly", """
SELECT count(*) AS n, min(dt) AS first_dt, max(dt) AS last_dt FROM supply_hourly
WHERE dt BETWEEN '1996-12-12T00' AND '2000-01-01'""")
def _(c):
    return c.wh.supply_hourly.filter(F.col("dt").between("1996-12-12T00", "2000-01-01")).agg(
        F.count(F.lit(1)).alias("n"), F.min("dt").alias("first_dt"), F.max("dt").alias("last_dt")
    )


@check("p7_in_list", "campaigns", """
SELECT id, current_optimization_state, final_optimization_state FROM campaigns
WHERE final_optimization_state IN ('cpi', 'cpi-vt')
  AND current_optimization_state NOT IN ('cpa')""")
def _(c):
    return c.wh.campaigns.filter(
        dims.in_list("final_optimization_state", CFG.install_opt_states)
        & ~dims.in_list("current_optimization_state", ["cpa"])
    ).select("id", "current_optimization_state", "final_optimization_state")


@check("p8_is_null", "daily_analysis", """
SELECT campaign_id, count(*) AS n FROM daily_analysis
WHERE control_gross_revenue IS NOT NULL AND measured_control_rpi IS NULL GROUP BY campaign_id""")
def _(c):
    return c.wh.daily_analysis.filter(
        F.col("control_gross_revenue").isNotNull() & F.col("measured_control_rpi").isNull()
    ).groupBy("campaign_id").agg(F.count(F.lit(1)).alias("n"))


@check("p9_like", sql="SELECT doc_id, source FROM documents WHERE text LIKE '%the%'")
def _(c):
    return c.raw("documents").filter(F.col("text").contains("the")).select("doc_id", "source")


@check("p10_flags", "matched_installs", """
SELECT dt, count(*) AS n FROM matched_installs
WHERE for_reporting = TRUE AND NOT is_uncredited GROUP BY dt""")
def _(c):
    return c.wh.matched_installs.filter(F.col("for_reporting") & ~F.col("is_uncredited")).groupBy(
        "dt"
    ).agg(F.count(F.lit(1)).alias("n"))


@check("p11_and_or", sql="""
SELECT l_orderkey, l_linenumber FROM lineitem
WHERE (l_discount >= 0.09 OR l_tax > 0.07) AND l_returnflag = 'R'""")
def _(c):
    li = c.raw("lineitem")
    return li.filter(
        ((li.l_discount >= 0.09) | (li.l_tax > 0.07)) & (li.l_returnflag == "R")
    ).select("l_orderkey", "l_linenumber")


@check("p12_durations", "app_events supply_hourly", """
SELECT 'ms' AS kind, count(*) AS n FROM app_events WHERE "at" - install__at < 604800000
UNION ALL
SELECT 'interval' AS kind, count(*) AS n FROM supply_hourly
WHERE CAST(event_at AS TIMESTAMP) - CAST(install_at AS TIMESTAMP) < INTERVAL 7 DAY""")
def _(c):
    by_ms = c.wh.app_events.filter(times.within_days_ms("at", "install__at", 7))
    by_ts = c.wh.supply_hourly.filter(
        times.within_days(times.iso_timestamp("event_at"), times.iso_timestamp("install_at"), 7)
    )
    parts = [
        d.agg(F.count(F.lit(1)).alias("n")).select(F.lit(k).alias("kind"), "n")
        for k, d in (("ms", by_ms), ("interval", by_ts))
    ]
    return parts[0].unionByName(parts[1])


@check("p13_post_aggregation_filter", "margins", """
SELECT campaign_id, last_update FROM (
  SELECT campaign_id, max(updated_at) AS last_update FROM margins GROUP BY campaign_id) AS d
WHERE CAST(last_update AS DATE) < DATE '1998-01-01'""", times="last_update")
def _(c):
    last = c.wh.margins.groupBy("campaign_id").agg(F.max("updated_at").alias("last_update"))
    return last.filter(F.to_date("last_update") < F.lit("1998-01-01").cast("date"))


@check("p14_post_window_filter", sql="""
SELECT * FROM (
  SELECT o_orderkey, o_orderstatus,
         lag(o_orderstatus) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey) AS old_status
  FROM orders) AS d
WHERE old_status <> o_orderstatus""")
def _(c):
    paired = history.with_previous(
        c.raw("orders"), {"old_status": "o_orderstatus"}, ["o_custkey"], "o_orderdate",
        tie="o_orderkey",
    )
    return history.changed_only(paired, [("old_status", "o_orderstatus")]).select(
        "o_orderkey", "o_orderstatus", "old_status"
    )


# --- joins -------------------------------------------------------------------

@check("j1_inner_join", "campaigns customers", """
SELECT p.id, c.company FROM campaigns p JOIN customers c ON c.id = p.customer_id""")
def _(c):
    owners = c.wh.customers.withColumnRenamed("id", "customer_id")
    return c.wh.campaigns.join(owners, "customer_id").select("id", "company")


@check("j2_multi_key_join", "daily_fact daily_attr_d7", """
WITH a AS (SELECT campaign_id, dt, CAST(sum(installs) AS BIGINT) AS installs FROM daily_fact GROUP BY 1, 2),
b AS (SELECT campaign_id, dt, CAST(sum(target_events_d7) AS BIGINT) AS events FROM daily_attr_d7 GROUP BY 1, 2)
SELECT a.campaign_id, a.dt, installs, events FROM a JOIN b ON a.campaign_id = b.campaign_id AND a.dt = b.dt""")
def _(c):
    keys = ["campaign_id", "dt"]
    a = c.wh.daily_fact.groupBy(*keys).agg(F.sum("installs").alias("installs"))
    b = c.wh.daily_attr_d7.groupBy(*keys).agg(F.sum("target_events_d7").alias("events"))
    return a.join(b, keys)


@check("j3_left_join", "campaigns", """
SELECT p_partkey, p.state FROM part LEFT JOIN campaigns p ON p.id = p_partkey""")
def _(c):
    return dims.lookup(
        c.raw("part").select("p_partkey"), c.wh.campaigns, "p_partkey", "id", {"state": "state"}
    )


@check("j4_right_join", "campaigns", """
SELECT p_partkey, p.id, p.state FROM campaigns p RIGHT JOIN part ON p.id = p_partkey
WHERE p.state = 'enabled'""")
def _(c):
    p = c.wh.campaigns
    part = c.raw("part").select("p_partkey")
    return p.join(part, p.id == part.p_partkey, "right").filter(p.state == "enabled").select(
        "p_partkey", "id", "state"
    )


@check("j5_full_join", sql="""
WITH a AS (SELECT o_custkey, count(*) AS n_f FROM orders WHERE o_orderstatus = 'F' GROUP BY 1),
b AS (SELECT o_custkey, count(*) AS n_p FROM orders WHERE o_orderstatus = 'P' GROUP BY 1)
SELECT a.o_custkey AS left_key, b.o_custkey AS right_key, n_f, n_p
FROM a FULL OUTER JOIN b ON a.o_custkey = b.o_custkey""")
def _(c):
    def side(status, key, n):
        return c.raw("orders").filter(F.col("o_orderstatus") == status).groupBy(
            F.col("o_custkey").alias(key)
        ).agg(F.count(F.lit(1)).alias(n))

    a, b = side("F", "left_key", "n_f"), side("P", "right_key", "n_p")
    return a.join(b, F.col("left_key") == F.col("right_key"), "full")


@check("j6_log_preserving_join", "change_log margins campaign_configs", """
SELECT l.change_id, l.row_id, m.campaign_id, c.target
FROM campaign_configs c FULL OUTER JOIN margins m ON m.campaign_id = c.campaign_id
FULL OUTER JOIN change_log l ON m.id = l.row_id WHERE l.table_name = 'margins'""")
def _(c):
    configs = c.wh.campaign_configs.select("campaign_id", "target")
    base = c.wh.margins.select("id", "campaign_id").join(configs, "campaign_id", "left")
    return history.change_events(c.wh.change_log, base, CFG.log_margins).select(
        "change_id", "row_id", "campaign_id", "target"
    )


@check("j7_one_row_cross_join", "change_log", """
SELECT change_id FROM change_log CROSS JOIN (SELECT TIMESTAMP '1999-01-01' AS start_dt) AS para
WHERE logged_at >= start_dt""")
def _(c):
    return c.wh.change_log.filter(F.col("logged_at") >= times.moment("1999-01-01")).select("change_id")


@check("j9_semi_join", "campaigns change_log", """
SELECT id, state FROM campaigns WHERE id IN (
  SELECT row_id FROM change_log WHERE table_name = 'campaigns' AND operation = 'insert')""")
def _(c):
    log = c.wh.change_log.filter(
        (F.col("table_name") == "campaigns") & (F.col("operation") == "insert")
    )
    return dims.keep_keys(c.wh.campaigns, "id", log.select("row_id")).select("id", "state")


_PAUSED = """SELECT row_id FROM change_log WHERE table_name = 'campaigns'
  AND json_extract_string(new_values, '$.state') = 'paused'"""


@check("j10_null_aware_anti_join", "campaigns change_log", f"""
SELECT id, state FROM campaigns WHERE id NOT IN ({_PAUSED})""")
def _(c):
    paused = c.wh.change_log.filter(
        (F.col("table_name") == "campaigns")
        & (nested.json_scalar("new_values", "state") == "paused")
    )
    return dims.exclude_keys(c.wh.campaigns, "id", paused.select("row_id")).select("id", "state")


@check("j11_lateral_unnest", "supply_hourly", """
SELECT campaign_id, t.a.id AS test_id, count(*) AS n
FROM supply_hourly, unnest(ab_test_assignments) AS t(a) GROUP BY 1, 2""")
def _(c):
    rows = c.wh.supply_hourly.select("campaign_id", F.explode("ab_test_assignments").alias("a"))
    return rows.groupBy("campaign_id", F.col("a.id").alias("test_id")).agg(F.count(F.lit(1)).alias("n"))


@check("j12_aggregate_join_back", "daily_analysis", """
SELECT d.campaign_id, d.target, n.num_target FROM daily_analysis d LEFT JOIN (
  SELECT campaign_id, count(DISTINCT target) AS num_target FROM daily_analysis GROUP BY 1) AS n
ON n.campaign_id = d.campaign_id""")
def _(c):
    rows = c.wh.daily_analysis.select("campaign_id", "target")
    return dims.num_values_per_key(rows, "campaign_id", "target", "num_target")


@check("j13_scalar_subquery", sql="""
SELECT o_orderkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)""")
def _(c):
    orders = c.raw("orders")
    newest = orders.agg(F.max("o_orderdate")).scalar()
    return orders.filter(F.col("o_orderdate") == newest).select("o_orderkey")


@check("j14_self_split_join", "daily_analysis", """
SELECT a.campaign_id, CAST(a.updated_at AS DATE)::VARCHAR AS day, a.threshold AS nr_threshold, b.threshold AS rpi_threshold
FROM daily_analysis a JOIN daily_analysis b
  ON a.campaign_id = b.campaign_id AND CAST(a.updated_at AS DATE) = CAST(b.updated_at AS DATE)
WHERE a.target = 'NR' AND b.target = 'RPI'""")
def _(c):
    rows = c.wh.daily_analysis.withColumn("day", F.date_format("updated_at", "yyyy-MM-dd"))

    def side(target, name):
        return rows.filter(F.col("target") == target).select(
            "campaign_id", "day", F.col("threshold").alias(name)
        )

    return side("NR", "nr_threshold").join(side("RPI", "rpi_threshold"), ["campaign_id", "day"])


# --- aggregates --------------------------------------------------------------

@check("a1_group_by", sql="""
SELECT l_returnflag, l_linestatus, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2, 3""")
def _(c):
    return c.raw("lineitem").groupBy("l_returnflag", "l_linestatus", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n")
    )


@check("a2_global_aggregate", "supply_hourly", """
SELECT count(DISTINCT campaign_id) AS campaigns, CAST(sum(spend_micros) AS BIGINT) AS spend FROM supply_hourly""")
def _(c):
    return c.wh.supply_hourly.agg(
        F.countDistinct("campaign_id").alias("campaigns"), F.sum("spend_micros").alias("spend")
    )


@check("a3_sum", "supply_hourly", """
SELECT campaign_id, CAST(sum(revenue_micros) AS BIGINT) AS revenue,
       CAST(sum(customer_revenue_micros) AS BIGINT) AS customer_revenue
FROM supply_hourly GROUP BY 1""")
def _(c):
    return c.wh.supply_hourly.groupBy("campaign_id").agg(
        F.sum("revenue_micros").alias("revenue"),
        F.sum("customer_revenue_micros").alias("customer_revenue"),
    )


@check("a4_max_min", "daily_fact", """
SELECT campaign_id, max(ae_email) AS ae_email, min(dt) AS first_dt FROM daily_fact GROUP BY 1""")
def _(c):
    return c.wh.daily_fact.groupBy("campaign_id").agg(
        F.max("ae_email").alias("ae_email"), F.min("dt").alias("first_dt")
    )


@check("a5_count_distinct", "change_log", """
SELECT table_name, count(DISTINCT row_id) AS n FROM change_log GROUP BY 1""")
def _(c):
    return c.wh.change_log.groupBy("table_name").agg(F.countDistinct("row_id").alias("n"))


@check("a6_count_rows", "impressions", """
SELECT exchange, CAST(sum(1) AS BIGINT) AS impressions, CAST(sum(0) AS BIGINT) AS installs
FROM impressions GROUP BY 1""")
def _(c):
    return c.wh.impressions.groupBy("exchange").agg(
        F.count(F.lit(1)).alias("impressions"), F.lit(0).cast("bigint").alias("installs")
    )


@check("a7_conditional_aggregate", "impressions", """
SELECT bid__campaign_id AS campaign_id,
  CAST(sum(CASE WHEN exchange = 'NETWORK' THEN spend_micros END) AS BIGINT) AS network_spend,
  max(CASE WHEN exchange <> 'NETWORK' THEN bid__margin_data__base_gross_margin END) AS other_margin
FROM impressions GROUP BY 1""")
def _(c):
    on = F.col("exchange") == CFG.network_exchange
    return c.wh.impressions.groupBy(F.col("bid__campaign_id").alias("campaign_id")).agg(
        F.sum(F.when(on, F.col("spend_micros"))).alias("network_spend"),
        F.max(F.when(~on, F.col("bid__margin_data__base_gross_margin"))).alias("other_margin"),
    )


@check("a8_ratio_of_sums", "supply_hourly", """
SELECT campaign_id, CAST(sum(revenue_micros) AS DOUBLE) / nullif(CAST(sum(installs) AS DOUBLE), 0) AS ratio
FROM supply_hourly GROUP BY 1""", rounded="ratio:2")
def _(c):
    return c.wh.supply_hourly.groupBy("campaign_id").agg(
        money.safe_ratio(F.sum("revenue_micros"), F.sum("installs")).alias("ratio")
    )


@check("a9_difference_of_sums", "supply_hourly", """
SELECT exchange, CAST(sum(revenue_micros) - sum(spend_micros) AS BIGINT) AS net FROM supply_hourly GROUP BY 1""")
def _(c):
    return c.wh.supply_hourly.groupBy("exchange").agg(
        (F.sum("revenue_micros") - F.sum("spend_micros")).alias("net")
    )


@check("a10_two_level_aggregate", sql="""
SELECT l_returnflag, sum(q) AS total, max(q) AS most FROM (
  SELECT l_orderkey, l_returnflag, sum(l_quantity) AS q FROM lineitem GROUP BY 1, 2) AS d GROUP BY 1""",
       rounded="total most")
def _(c):
    per = c.raw("lineitem").groupBy("l_orderkey", "l_returnflag").agg(F.sum("l_quantity").alias("q"))
    return per.groupBy("l_returnflag").agg(F.sum("q").alias("total"), F.max("q").alias("most"))


@check("a11_sum_of_squares", sql="""
SELECT l_suppkey, sum(l_quantity) AS s1, sum(l_quantity * l_quantity) AS s2 FROM lineitem GROUP BY 1""",
       rounded="s1 s2")
def _(c):
    q = F.col("l_quantity")
    return c.raw("lineitem").groupBy("l_suppkey").agg(F.sum(q).alias("s1"), F.sum(q * q).alias("s2"))


@check("a12_distinct", "supply_hourly", "SELECT DISTINCT campaign_id, platform FROM supply_hourly")
def _(c):
    return c.wh.supply_hourly.select("campaign_id", "platform").distinct()


@check("a13_distinct_group_by", "campaign_configs", """
SELECT DISTINCT target_reasons, target, max(campaign_id) AS example FROM campaign_configs GROUP BY 1, 2""")
def _(c):
    return c.wh.campaign_configs.groupBy("target_reasons", "target").agg(
        F.max("campaign_id").alias("example")
    )


@check("a14_constant_aggregate", "supply_hourly", """
SELECT campaign_id, max(0) AS zero, max(impressions) AS impressions FROM supply_hourly GROUP BY 1""")
def _(c):
    return c.wh.supply_hourly.groupBy("campaign_id").agg(
        F.max("impressions").alias("impressions")
    ).withColumn("zero", F.lit(0))


# --- windows -----------------------------------------------------------------

_DAILY = """SELECT campaign_id, dt, CAST(sum(revenue_micros) AS BIGINT) AS revenue FROM daily_fact GROUP BY 1, 2"""


@check("w1_previous_day", "daily_fact", f"""
WITH d AS ({_DAILY})
SELECT campaign_id, dt, revenue, lag(revenue) OVER (PARTITION BY campaign_id ORDER BY dt) AS previous FROM d""")
def _(c):
    daily = c.wh.daily_fact.groupBy("campaign_id", "dt").agg(F.sum("revenue_micros").alias("revenue"))
    return metrics.previous_period(daily, ["campaign_id"], "dt", {"previous": "revenue"})


_LOG = """SELECT change_id, row_id, logged_at, table_name, json_extract_string(new_values, '$.margin_type') AS kind,
  json_extract_string(old_values, '$.margin_type') AS old_kind,
  json_extract_string(new_values, '$.network_gross_margin') AS margin FROM change_log"""


def _log(c: Context) -> DataFrame:
    return c.wh.change_log.select(
        "change_id", "row_id", "logged_at", "table_name",
        nested.json_scalar("new_values", "margin_type").alias("kind"),
        nested.json_scalar("old_values", "margin_type").alias("old_kind"),
        nested.json_scalar("new_values", "network_gross_margin").alias("margin"),
    )


@check("w2_lag_two_keys", "change_log", f"""
WITH d AS ({_LOG})
SELECT change_id, lag(margin) OVER (PARTITION BY table_name, kind ORDER BY logged_at, change_id) AS old_margin FROM d""")
def _(c):
    return history.with_previous(
        _log(c), {"old_margin": "margin"}, ["table_name", "kind"], "logged_at"
    ).select("change_id", "old_margin")


@check("w3_lag_with_default", "change_log", f"""
WITH d AS ({_LOG})
SELECT change_id, coalesce(CAST(lag(margin) OVER (PARTITION BY row_id, kind ORDER BY logged_at, change_id) AS DOUBLE), 999999) AS old_margin
FROM d WHERE table_name = 'margins'""")
def _(c):
    rows = _log(c).filter(F.col("table_name") == "margins").withColumn(
        "margin", F.col("margin").try_cast("double")
    )
    return history.with_previous(
        rows, {"old_margin": "margin"}, ["row_id", "kind"], "logged_at", CFG.no_previous_margin
    ).select("change_id", "old_margin")


@check("w4_lead_one", "change_log", f"""
WITH d AS ({_LOG})
SELECT change_id, lead(logged_at) OVER (PARTITION BY table_name, row_id ORDER BY logged_at, change_id) AS next_at FROM d""",
       times="next_at")
def _(c):
    return with_neighbors(
        _log(c), ["table_name", "row_id"], "logged_at", {"next_at": ("logged_at", -1)}
    ).select("change_id", "next_at")


@check("w5_lead_two", "change_log", f"""
WITH d AS ({_LOG})
SELECT change_id, lead(logged_at, 2) OVER (PARTITION BY table_name, old_kind ORDER BY logged_at, change_id) AS next_at FROM d""",
       times="next_at")
def _(c):
    return with_neighbors(
        _log(c), ["table_name", "old_kind"], "logged_at", {"next_at": ("logged_at", -2)}
    ).select("change_id", "next_at")


@check("w6_lag_over_left_join", "daily_fact daily_credited_d7", f"""
WITH m0 AS ({_DAILY}),
m1 AS (SELECT campaign_id, dt, CAST(sum(target_events_d7) AS BIGINT) AS events FROM daily_credited_d7 GROUP BY 1, 2),
j AS (SELECT m0.*, m1.events, m1.dt IS NOT NULL AS hit FROM m0 LEFT JOIN m1
      ON m0.campaign_id = m1.campaign_id AND m0.dt = m1.dt)
SELECT campaign_id, dt, CASE WHEN hit THEN lag(events) OVER (PARTITION BY campaign_id, hit ORDER BY dt) END AS previous FROM j""")
def _(c):
    keys = ["campaign_id", "dt"]
    # Partitions grow in number with the rows, and both sides are added up, joined and sorted in them.
    partitions = partitions_for(c.spark, max(c.wh.daily_fact.count(), c.wh.daily_credited_d7.count()))
    m0 = c.wh.daily_fact.select(*keys, "revenue_micros").repartition(partitions, *keys)
    m0 = m0.groupBy(*keys).agg(F.sum("revenue_micros").alias("revenue"))
    m1 = c.wh.daily_credited_d7.select(*keys, "target_events_d7").repartition(partitions, *keys)
    m1 = m1.groupBy(*keys).agg(
        F.sum("target_events_d7").alias("events"), F.lit(True).alias("hit")
    )
    return previous_matched(
        m0.join(m1, keys, "left"), "campaign_id", "dt", "hit", {"previous": "events"}
    ).select(*keys, "previous")


# --- sorts, set operations ---------------------------------------------------

@check("o1_order_by", sql="""
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice DESC NULLS LAST, o_orderkey ASC NULLS LAST""")
def _(c):
    return c.raw("orders").select("o_orderkey", "o_totalprice").orderBy(
        F.col("o_totalprice").desc_nulls_last(), F.col("o_orderkey").asc_nulls_last()
    )


@check("o2_inner_order_dropped", sql="""
SELECT o_orderstatus, count(*) AS n FROM (SELECT * FROM orders ORDER BY o_orderdate) AS d GROUP BY 1""")
def _(c):
    return c.raw("orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("n"))


@check("u1_union_all", "matched_installs unmatched_installs", """
SELECT exchange_group, count(*) AS n FROM (
  SELECT ad_click__impression__bid__bid_request__exchange AS exchange_group FROM matched_installs
  UNION ALL SELECT 'UNMATCHED' FROM unmatched_installs) AS d GROUP BY 1""")
def _(c):
    a = c.wh.matched_installs.select(
        F.col("ad_click__impression__bid__bid_request__exchange").alias("exchange_group")
    )
    b = c.wh.unmatched_installs.select(F.lit(CFG.unmatched_label).alias("exchange_group"))
    return a.unionByName(b).groupBy("exchange_group").agg(F.count(F.lit(1)).alias("n"))


@check("u2_union_distinct", "change_log campaign_configs", """
SELECT campaign_id, target, threshold FROM (
  SELECT campaign_id, target, CAST(NULL AS VARCHAR) AS threshold FROM campaign_configs
  UNION
  SELECT row_id, CAST(NULL AS VARCHAR), json_extract_string(new_values, '$.threshold')
  FROM change_log WHERE table_name = 'campaign_configs') AS d""")
def _(c):
    a = c.wh.campaign_configs.select(
        "campaign_id", "target", F.lit(None).cast("string").alias("threshold")
    )
    b = c.wh.change_log.filter(F.col("table_name") == CFG.log_configs).select(
        F.col("row_id").alias("campaign_id"),
        F.lit(None).cast("string").alias("target"),
        nested.json_scalar("new_values", "threshold").alias("threshold"),
    )
    return a.unionByName(b).distinct()


# --- conditional, math, casts ------------------------------------------------

@check("m1_searched_case", sql="""
SELECT o_orderkey, CASE WHEN o_orderstatus = 'F' AND o_totalprice > 200000 THEN 'big'
  WHEN o_orderstatus = 'F' THEN 'small' ELSE 'open' END AS kind FROM orders""")
def _(c):
    done = F.col("o_orderstatus") == "F"
    return c.raw("orders").select(
        "o_orderkey",
        F.when(done & (F.col("o_totalprice") > 200000), "big").when(done, "small")
        .otherwise("open").alias("kind"),
    )


@check("m2_nested_if", sql="""
SELECT p_partkey, if(p_size < 10, 'small', if(p_size < 30, 'medium', 'large')) AS kind FROM part""")
def _(c):
    size = F.col("p_size")
    return c.raw("part").select(
        "p_partkey",
        F.when(size < 10, "small").otherwise(F.when(size < 30, "medium").otherwise("large"))
        .alias("kind"),
    )


@check("m3_coalesce", "campaign_configs change_log", """
SELECT change_id, coalesce(json_extract_string(new_values, '$.threshold'), json_extract_string(old_values, '$.threshold'), '0') AS threshold
FROM change_log WHERE table_name = 'campaign_configs'""")
def _(c):
    return c.wh.change_log.filter(F.col("table_name") == CFG.log_configs).select(
        "change_id",
        F.coalesce(
            nested.json_scalar("new_values", "threshold"),
            nested.json_scalar("old_values", "threshold"),
            F.lit("0"),
        ).alias("threshold"),
    )


@check("m4_casts", "change_log", """
SELECT change_id, TRY_CAST(json_extract_string(new_values, '$.threshold') AS INTEGER) AS threshold,
  TRY_CAST(json_extract_string(new_values, '$.margin_type') AS DOUBLE) AS bad_number,
  CAST(row_id AS VARCHAR) AS row_text, CAST(row_id AS DOUBLE) AS row_double,
  strftime(CAST(logged_at AS DATE), '%Y-%m-%d') AS log_day FROM change_log""")
def _(c):
    return c.wh.change_log.select(
        "change_id",
        nested.json_scalar("new_values", "threshold").try_cast("int").alias("threshold"),
        nested.json_scalar("new_values", "margin_type").try_cast("double").alias("bad_number"),
        F.col("row_id").cast("string").alias("row_text"),
        F.col("row_id").cast("double").alias("row_double"),
        F.date_format(F.col("logged_at").cast("date"), "yyyy-MM-dd").alias("log_day"),
    )


@check("m5_arithmetic", "impressions", """
SELECT bid__campaign_id AS campaign_id, CAST(sum(spend_micros // 1000 - 2 * mediation_price_micros) AS BIGINT) AS x,
  CAST(sum(-spend_micros) AS BIGINT) AS negative FROM impressions GROUP BY 1""")
def _(c):
    return c.wh.impressions.groupBy(F.col("bid__campaign_id").alias("campaign_id")).agg(
        F.sum(F.expr("spend_micros div 1000 - 2 * mediation_price_micros")).alias("x"),
        F.sum(-F.col("spend_micros")).alias("negative"),
    )


@check("m6_power", "daily_fact", """
SELECT campaign_id, sum(CAST(revenue_micros AS DOUBLE) / power(10, 6)) AS revenue FROM daily_fact GROUP BY 1""",
       rounded="revenue")
def _(c):
    return c.wh.daily_fact.groupBy("campaign_id").agg(
        F.sum(money.micros("revenue_micros")).alias("revenue")
    )


@check("m7_round", "daily_analysis", """
SELECT campaign_id, updated_at, round(new_control_gross_margin_network / (1 + new_control_gross_margin_network), 3) AS margin
FROM daily_analysis""", times="updated_at")
def _(c):
    return c.wh.daily_analysis.select(
        "campaign_id", "updated_at",
        money.net_margin("new_control_gross_margin_network", 3).alias("margin"),
    )


@check("m8_try", "impressions", """
SELECT "at" AS at_ms, bid__campaign_id AS campaign_id,
  bid__bid_request__impressions[1].logical_size AS size,
  CAST(spend_micros AS DOUBLE) / nullif(bid__margin_data__base_gross_margin, 0) AS ratio
FROM impressions""", rounded="ratio:1")
def _(c):
    return c.wh.impressions.select(
        F.col("at").alias("at_ms"), F.col("bid__campaign_id").alias("campaign_id"),
        nested.first_item("bid__bid_request__impressions")["logical_size"].alias("size"),
        F.try_divide(F.col("spend_micros").cast("double"), "bid__margin_data__base_gross_margin")
        .alias("ratio"),
    )


@check("m9_clamp", "app_events", """
SELECT custom_event_id, CAST(sum(CASE WHEN customer_revenue_micros > -100000000000 AND customer_revenue_micros < 100000000000
  THEN customer_revenue_micros ELSE 0 END) AS BIGINT) AS revenue FROM app_events GROUP BY 1""")
def _(c):
    r, bound = F.col("customer_revenue_micros"), CFG.revenue_outlier_micros
    return c.wh.app_events.groupBy("custom_event_id").agg(
        F.sum(F.when((r > -bound) & (r < bound), r).otherwise(0)).alias("revenue")
    )


@check("m10_not_in_null", "supply_hourly", """
SELECT campaign_id, count(*) AS n, CAST(sum(CASE WHEN pptype NOT IN (1, 2, 3) THEN 1 ELSE 0 END) AS BIGINT) AS others
FROM supply_hourly GROUP BY 1""")
def _(c):
    return c.wh.supply_hourly.groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.when(~F.col("pptype").isin(1, 2, 3), 1).otherwise(0)).alias("others"),
    )


# --- dates and times ---------------------------------------------------------

@check("d1_parse_iso", "supply_hourly", """
SELECT dt, CAST(dt AS TIMESTAMP) AS parsed, CAST(substr(dt, 1, 10) AS TIMESTAMP) AS parsed_day, count(*) AS n
FROM supply_hourly GROUP BY 1, 2, 3""", times="parsed parsed_day")
def _(c):
    return c.wh.supply_hourly.groupBy("dt").agg(F.count(F.lit(1)).alias("n")).select(
        "dt", times.iso_timestamp("dt").alias("parsed"),
        times.iso_timestamp(F.substring("dt", 1, 10)).alias("parsed_day"), "n",
    )


@check("d2_from_epoch_ms", "matched_installs", """
SELECT make_timestamp(event_timestamp * 1000) AS event_time, count(*) AS n FROM matched_installs GROUP BY 1""",
       times="event_time")
def _(c):
    return c.wh.matched_installs.groupBy(times.timestamp_of_ms("event_timestamp").alias("event_time")).agg(
        F.count(F.lit(1)).alias("n")
    )


@check("d3_iso_text", "matched_installs", """
SELECT strftime(date_trunc('hour', make_timestamp(event_timestamp * 1000)), '%Y-%m-%dT%H:%M:%SZ') AS hour_text, count(*) AS n
FROM matched_installs GROUP BY 1""")
def _(c):
    return c.wh.matched_installs.groupBy(times.hour_of_ms("event_timestamp").alias("h")).agg(
        F.count(F.lit(1)).alias("n")
    ).select(times.iso_text("h").alias("hour_text"), "n")


@check("d4_date_trunc", sql="""
SELECT date_trunc('hour', ts) AS h, date_trunc('day', ts) AS d, count(*) AS n FROM events GROUP BY 1, 2""",
       times="h d")
def _(c):
    return c.raw("events").groupBy(
        F.date_trunc("hour", "ts").alias("h"), F.date_trunc("day", "ts").alias("d")
    ).agg(F.count(F.lit(1)).alias("n"))


@check("d5_to_date", sql="SELECT CAST(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1", times="day")
def _(c):
    return c.raw("events").groupBy(F.to_date("ts").alias("day")).agg(F.count(F.lit(1)).alias("n"))


@check("d6_full_days", "campaigns", f"""
SELECT id, CAST(date_sub('day', created_at, TIMESTAMP '{AS_OF}') AS BIGINT) AS age FROM campaigns""")
def _(c):
    return c.wh.campaigns.select("id", times.full_days("created_at", times.moment(AS_OF)).alias("age"))


@check("d7_as_of", "campaigns", f"""
SELECT id, coalesce(CASE WHEN id % 3 = 0 THEN created_at END, TIMESTAMP '{AS_OF}') AS open_end FROM campaigns""",
       times="open_end")
def _(c):
    known = F.when(F.col("id") % 3 == 0, F.col("created_at"))
    return c.wh.campaigns.select("id", F.coalesce(known, times.moment(AS_OF)).alias("open_end"))


@check("d8_intervals", "campaigns", f"""
SELECT id, created_at - INTERVAL 2 DAY AS earlier,
  CASE WHEN TIMESTAMP '{AS_OF}' - created_at < INTERVAL 700 DAY THEN 1 ELSE 0 END AS young FROM campaigns""", times="earlier")
def _(c):
    return c.wh.campaigns.select(
        "id", (F.col("created_at") - F.expr("INTERVAL '2' DAY")).alias("earlier"),
        times.within_days(times.moment(AS_OF), "created_at", 700).cast("int").alias("young"),
    )


@check("d9_clamp_early", "change_log", """
SELECT change_id, CASE WHEN CAST(logged_at AS DATE) < DATE '1996-12-12' THEN TIMESTAMP '1996-12-13' ELSE logged_at END AS logged_at
FROM change_log""", times="logged_at")
def _(c):
    return c.wh.change_log.select(
        "change_id", times.clamp_early("logged_at", "1996-12-12", "1996-12-13").alias("logged_at")
    )


# --- strings, JSON, arrays, structs ------------------------------------------

@check("x1_concat_substr", sql="""
SELECT c_custkey, concat(substr(c_name, 1, 8), ':', c_mktsegment) AS label FROM customer""")
def _(c):
    return c.raw("customer").select(
        "c_custkey", F.concat(F.substring("c_name", 1, 8), F.lit(":"), "c_mktsegment").alias("label")
    )


@check("x2_json_scalar", sql="SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def _(c):
    return c.raw("events").select("event_id", nested.json_scalar("props", "k").alias("k"))


@check("x3_json_key_present", "change_log", """
SELECT change_id, CASE WHEN json_extract(new_values, '$.target') IS NOT NULL THEN 1 ELSE 0 END AS has_target,
  json_extract_string(new_values, '$.target') AS target
FROM change_log WHERE table_name = 'campaign_configs'""")
def _(c):
    return c.wh.change_log.filter(F.col("table_name") == CFG.log_configs).select(
        "change_id", nested.json_has("new_values", "target").cast("int").alias("has_target"),
        nested.json_scalar("new_values", "target").alias("target"),
    )


@check("x4_json_in_bytes", "impressions", """
SELECT bid__campaign_id AS campaign_id,
  TRY_CAST(json_extract_string(decode(bid__bid_request__raw), '$.imp[0].ext.pptype') AS INTEGER) AS pptype, count(*) AS n
FROM impressions GROUP BY 1, 2""")
def _(c):
    return c.wh.impressions.groupBy(
        F.col("bid__campaign_id").alias("campaign_id"),
        nested.json_int_in_bytes("bid__bid_request__raw").alias("pptype"),
    ).agg(F.count(F.lit(1)).alias("n"))


@check("x5_json_text_compare", "change_log", """
SELECT change_id FROM change_log
WHERE json_extract_string(new_values, '$.state_last_changed_at') > '1998-01-01'""")
def _(c):
    return c.wh.change_log.filter(
        nested.json_scalar("new_values", "state_last_changed_at") > "1998-01-01"
    ).select("change_id")


@check("x6_max_of_numeric_text", "campaign_configs", """
SELECT target, max(threshold) AS text_max, max(CAST(threshold AS DOUBLE)) AS number_max FROM campaign_configs GROUP BY 1""")
def _(c):
    return c.wh.campaign_configs.groupBy("target").agg(
        F.max("threshold").alias("text_max"),
        F.max(F.col("threshold").try_cast("double")).alias("number_max"),
    )


@check("x7_array_filter", "supply_hourly", f"""
SELECT {AB} AS test_group_name, count(*) AS n FROM supply_hourly GROUP BY 1""")
def _(c):
    return c.wh.supply_hourly.groupBy(
        nested.ab_group("ab_test_assignments", CFG.test_id).alias("test_group_name")
    ).agg(F.count(F.lit(1)).alias("n"))


@check("x8_array_subscript", "impressions", """
SELECT bid__bid_request__impressions[1].network_revenue.payout_type AS payout_type, count(*) AS n
FROM impressions GROUP BY 1""")
def _(c):
    first = nested.first_item("bid__bid_request__impressions")
    return c.wh.impressions.groupBy(first["network_revenue"]["payout_type"].alias("payout_type")).agg(
        F.count(F.lit(1)).alias("n")
    )


@check("x9_struct_fields", "supply_hourly", """
SELECT ab_test_assignments[1].id AS id, ab_test_assignments[1]."group".name AS name, count(*) AS n
FROM supply_hourly GROUP BY 1, 2""")
def _(c):
    first = nested.first_item("ab_test_assignments")
    return c.wh.supply_hourly.groupBy(
        first["id"].alias("id"), first["group"]["name"].alias("name")
    ).agg(F.count(F.lit(1)).alias("n"))


@check("x10_group_guard", "supply_hourly", f"""
SELECT campaign_id, count(*) AS n FROM supply_hourly WHERE {AB} IS NOT NULL GROUP BY 1""")
def _(c):
    group = nested.ab_group("ab_test_assignments", CFG.test_id)
    return c.wh.supply_hourly.filter(group.isNotNull()).groupBy("campaign_id").agg(
        F.count(F.lit(1)).alias("n")
    )
