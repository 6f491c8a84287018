"""Composite operators: the library's own API."""

from __future__ import annotations

from pyspark.sql import functions as F

from conformance.registry import AFTER, AS_OF, BEFORE, CFG, check
from conformance.snippets import (
    AB,
    COUNTRY,
    CRM_NEWEST,
    EVENT_TABLES,
    IN_TYPES,
    LOG_DAYS,
    MARGIN_EVENTS,
    TARGETS,
    first_of,
    first_size,
    margin_history,
    old_new,
    payout,
    rate,
    side,
)
from marginlab import Period
from marginlab.functions import buckets, money, nested, times
from marginlab.operators import dims, funnel, history, metrics, moments, quality
from marginlab.operators.asof import History, as_of_enrich
from marginlab.plans import common, dataset, track, updates
from marginlab.session import new_shared_path
from marginlab.sources import sink
from marginlab.streaming.cohorts import CohortStore
from marginlab.streaming.stored_history import StoredHistory


@check("c1_change_events", EVENT_TABLES, f"""
WITH {MARGIN_EVENTS}
SELECT change_id, logged_at, source, margin_type, campaign_id, net_m AS network_gross_margin, target, threshold
FROM mev WHERE {IN_TYPES}""", times="logged_at")
def _(c):
    return common.margin_events(c.wh, CFG).select(
        "change_id", "logged_at", "source", "margin_type", "campaign_id", "network_gross_margin",
        "target", "threshold",
    )


@check("c2_validity_intervals", EVENT_TABLES, f"""
WITH {MARGIN_EVENTS}
SELECT change_id, campaign_id, date_trunc('hour', logged_at) AS valid_from,
  date_trunc('hour', coalesce(lead(logged_at, 2) OVER (
    PARTITION BY campaign_id, previous_margin_type ORDER BY logged_at, change_id), TIMESTAMP '{AS_OF}')) AS valid_to
FROM mev WHERE {IN_TYPES}""", times="valid_from valid_to")
def _(c):
    return history.validity_intervals(
        common.margin_events(c.wh, CFG), ["campaign_id", "previous_margin_type"], "logged_at",
        AS_OF, lead=2, trunc="hour",
    ).select("change_id", "campaign_id", "valid_from", "valid_to")


# Log rows are numbered by order key, so each third of the numbers holds rows of all years: most are late.
_THIRDS = (1, 2, 3)


@check("c2_incremental_history", EVENT_TABLES, f"""
WITH {TARGETS} SELECT campaign_id, valid_from, valid_to, val AS target FROM thist""", times="valid_from valid_to")
def _(c):
    events = common.setting_events(c.wh, c.wh.campaign_configs, CFG.log_configs, "target", "campaign_id")
    kept = StoredHistory(c.spark, new_shared_path(c.spark, "target-history"), ["campaign_id"], slice_by="year")
    greatest = c.wh.change_log.agg(F.max("change_id")).first()[0]
    for k in _THIRDS:
        kept.append(events.filter(F.col("change_id") <= greatest * k // len(_THIRDS)))
    return kept.intervals(AS_OF, trunc="hour").select("campaign_id", "valid_from", "valid_to", "target")


@check("c2_incremental_margins", EVENT_TABLES, f"""
WITH {MARGIN_EVENTS}, {margin_history('hour')}
SELECT campaign_id, valid_from, valid_to, margin_type, count(*) AS changes FROM mhist WHERE campaign_id IS NOT NULL
GROUP BY ALL""", times="valid_from valid_to")
def _(c):
    events = common.margin_events(c.wh, CFG).filter(F.col("campaign_id").isNotNull())
    kept = StoredHistory(
        c.spark, new_shared_path(c.spark, "margin-history"), ["campaign_id", "previous_margin_type"], lead=2, slice_by="year"
    )
    greatest = c.wh.change_log.agg(F.max("change_id")).first()[0]
    for k in _THIRDS[:2]:
        kept.append(events.filter(F.col("change_id") <= greatest * k // 2))
    kept.compact()
    rows = kept.intervals(AS_OF, trunc="hour")
    return rows.groupBy("campaign_id", "valid_from", "valid_to", "margin_type").agg(F.count(F.lit(1)).alias("changes"))


@check("c3_with_previous", EVENT_TABLES, f"""
WITH {MARGIN_EVENTS}
SELECT change_id, campaign_id, margin_type, {old_new('999999')} FROM mev WHERE {IN_TYPES}""")
def _(c):
    return common.with_old_and_new(
        common.margin_events(c.wh, CFG), CFG.no_previous_margin
    ).select("change_id", "campaign_id", "margin_type", *common.OLD, *common.NEW)


@check("c3_with_previous_logged_values", EVENT_TABLES, f"""
WITH {MARGIN_EVENTS}, logged AS (
  SELECT change_id, campaign_id, margin_type, logged_at, CAST(logged_network AS DOUBLE) AS net_m,
    CAST(logged_other AS DOUBLE) AS oth_m FROM mev WHERE {IN_TYPES})
SELECT change_id, campaign_id, margin_type, {old_new('999999')} FROM logged""")
def _(c):
    return common.with_old_and_new(
        common.margin_events(c.wh, CFG), CFG.no_previous_margin, "log"
    ).select("change_id", "campaign_id", "margin_type", *common.OLD, *common.NEW)


@check("c4_changed_only", EVENT_TABLES, f"""
WITH {MARGIN_EVENTS}
SELECT * FROM (SELECT change_id, campaign_id, margin_type, {old_new('NULL')} FROM mev WHERE {IN_TYPES}) AS d
WHERE old_network_gross_margin <> new_network_gross_margin OR old_other_gross_margin <> new_other_gross_margin""")
def _(c):
    paired = common.with_old_and_new(common.margin_events(c.wh, CFG), None)
    return history.changed_only(paired, common.PAIRS).select(
        "change_id", "campaign_id", "margin_type", *common.OLD, *common.NEW
    )


def _daily_facts(c):
    return c.wh.daily_fact.groupBy("campaign_id", times.day_of_iso("dt").alias("dt")).agg(
        F.sum("revenue_micros").alias("revenue_micros")
    )


_DAILY = """daily AS (
  SELECT campaign_id, CAST(dt AS TIMESTAMP) AS dt, CAST(sum(revenue_micros) AS BIGINT) AS revenue_micros
  FROM daily_fact GROUP BY 1, 2)"""


@check("c5_as_of_enrich", f"daily_fact {EVENT_TABLES}", f"""
WITH {_DAILY}, {TARGETS}
SELECT d.campaign_id, d.dt, d.revenue_micros, max(t.val) AS target
FROM daily d LEFT JOIN thist t
  ON t.campaign_id = d.campaign_id AND d.dt >= t.valid_from AND d.dt < t.valid_to
GROUP BY ALL""", times="dt")
def _(c):
    return as_of_enrich(
        _daily_facts(c), "campaign_id", "dt",
        [History(common.target_history(c.wh, CFG, AS_OF), {"target": "target"})], grain="day",
    )


# A third of all campaigns' facts are one campaign's, so its buckets are cut into parts.
_HOT = "CASE WHEN campaign_id % 3 = 0 THEN 6 ELSE campaign_id END"


@check("c5_as_of_enrich_measured", f"supply_hourly {EVENT_TABLES}", f"""
WITH hourly AS (SELECT {_HOT} AS campaign_id, date_trunc('day', CAST(dt AS TIMESTAMP)) AS dt, revenue_micros FROM supply_hourly), {TARGETS},
held AS (SELECT DISTINCT campaign_id, valid_from, valid_to, val FROM thist)
SELECT h.campaign_id, h.dt, t.val AS target, count(*) AS facts, CAST(sum(h.revenue_micros) AS BIGINT) AS revenue_micros
FROM hourly h LEFT JOIN held t ON t.campaign_id = h.campaign_id AND h.dt >= t.valid_from AND h.dt < t.valid_to
GROUP BY ALL""", times="dt")
def _(c):
    facts = c.wh.supply_hourly.select(F.expr(_HOT).alias("campaign_id"), times.day_of_iso("dt").alias("dt"), "revenue_micros")
    held = common.target_history(c.wh, CFG, AS_OF).select("campaign_id", "valid_from", "valid_to", "target").distinct()
    joined = as_of_enrich(
        facts, "campaign_id", "dt", [History(held, {"target": "target"})], grain="day", bucket_days=364, splits=None
    )
    return joined.groupBy("campaign_id", "dt", "target").agg(
        F.count(F.lit(1)).alias("facts"), F.sum("revenue_micros").alias("revenue_micros")
    )


_AS_OF_INNER = f"""
WITH {_DAILY}, {MARGIN_EVENTS}, {margin_history('hour')}
SELECT d.campaign_id, d.dt, d.revenue_micros, m.valid_from, m.valid_to, m.margin_type,
  max(m.new_network_gross_margin) AS margin
FROM daily d JOIN mhist m
  ON m.campaign_id = d.campaign_id AND d.dt >= m.valid_from AND d.dt < m.valid_to
GROUP BY ALL"""


def _as_of_inner(c, **how):
    return as_of_enrich(
        _daily_facts(c), "campaign_id", "dt",
        [
            History(
                common.margin_history(c.wh, CFG, AS_OF),
                {"valid_from": "valid_from", "valid_to": "valid_to", "margin_type": "margin_type",
                 "margin": "new_network_gross_margin"},
                how="inner", collapse=True, by=("margin_type",),
            )
        ],
        **how,
    )


@check("j8_interval_join", f"daily_fact {EVENT_TABLES}", _AS_OF_INNER, times="dt valid_from valid_to")
def _(c):
    return _as_of_inner(c)


@check("c5_as_of_enrich_split_keys", f"daily_fact {EVENT_TABLES}", _AS_OF_INNER,
       times="dt valid_from valid_to")
def _(c):
    return _as_of_inner(c, grain="day", splits=4)


@check("c6_ab_group", "supply_hourly", f"""
SELECT campaign_id, platform, {AB} AS test_group_name, CAST(sum(spend_micros) AS BIGINT) AS spend
FROM supply_hourly GROUP BY 1, 2, 3""")
def _(c):
    group = nested.ab_group("ab_test_assignments", CFG.test_id).alias("test_group_name")
    return c.wh.supply_hourly.groupBy("campaign_id", "platform", group).agg(
        F.sum("spend_micros").alias("spend")
    )


@check("c7_explode_test", "impressions", """
SELECT bid__campaign_id AS campaign_id, t.a."group".id AS group_id, t.a."group".name AS group_name, count(*) AS n
FROM impressions, unnest(bid__bid_request__ab_test_assignments) AS t(a) WHERE t.a.id = 916 GROUP BY 1, 2, 3""")
def _(c):
    rows = funnel.explode_test(
        c.wh.impressions, "bid__bid_request__ab_test_assignments", CFG.test_id
    )
    return rows.groupBy(
        F.col("bid__campaign_id").alias("campaign_id"), F.col("test_group.id").alias("group_id"),
        F.col("test_group.name").alias("group_name"),
    ).agg(F.count(F.lit(1)).alias("n"))


@check("c8_first_path", "app_events", f"""
SELECT {first_of('bid__campaign_id')} AS campaign_id, {COUNTRY} AS country, {first_size()} AS size, count(*) AS n
FROM app_events GROUP BY 1, 2, 3""")
def _(c):
    named = dataset.event_columns(CFG)
    return c.wh.app_events.groupBy(
        named["campaign_id"].alias("campaign_id"), named["country"].alias("country"),
        named["logical_size"].alias("size"),
    ).agg(F.count(F.lit(1)).alias("n"))


@check("c9_buckets", "supply_hourly", """
SELECT CASE WHEN exchange = 'NETWORK' THEN 'Network' ELSE 'Non-Network' END AS exchange_group,
  CASE WHEN country = 'US' THEN 'US' ELSE 'Non-US' END AS country_group,
  CASE WHEN current_optimization_state IN ('cpr', 'cpr-vt', 'cprv3', 'cprv3-vt') THEN 'CPR'
       WHEN current_optimization_state IN ('cpa', 'cpa-vt') THEN 'CPA'
       WHEN current_optimization_state IN ('cpi', 'cpi-vt') THEN 'CPI' ELSE 'others' END AS opt_state,
  count(*) AS n FROM supply_hourly GROUP BY 1, 2, 3""")
def _(c):
    return c.wh.supply_hourly.groupBy(
        buckets.bucket_exchange("exchange", CFG).alias("exchange_group"),
        buckets.bucket_country("country", CFG).alias("country_group"),
        buckets.bucket_opt_state("current_optimization_state", CFG).alias("opt_state"),
    ).agg(F.count(F.lit(1)).alias("n"))


AD_FORMAT = """CASE WHEN creative = 'NATIVE' OR size = 'L0x0' THEN 'native' WHEN size = 'L300x250' THEN 'mrec'
  WHEN size IN ('L320x50', 'L728x90') THEN 'banner'
  WHEN size IS NULL OR size = 'UNKNOWN_LOGICAL_SIZE' THEN 'UNKNOWN_LOGICAL_SIZE' ELSE 'interstitial' END"""


@check("c10_ad_format", "app_events", f"""
WITH e AS (SELECT {first_of('bid__creative__type')} AS creative, {first_size()} AS size FROM app_events)
SELECT creative, size, {AD_FORMAT} AS ad_format, count(*) AS n FROM e GROUP BY 1, 2, 3""")
def _(c):
    named = dataset.event_columns(CFG)
    rows = c.wh.app_events.select(
        named["creative_type"].alias("creative"), named["logical_size"].alias("size")
    )
    return rows.groupBy("creative", "size", buckets.ad_format("creative", "size").alias("ad_format")).agg(
        F.count(F.lit(1)).alias("n")
    )


@check("c11_experiment_group", "impressions", """
WITH g AS (SELECT t.a."group".id AS group_id FROM impressions, unnest(bid__bid_request__ab_test_assignments) AS t(a))
SELECT group_id, CASE group_id WHEN 2063 THEN 'holdout' WHEN 2064 THEN 'control' WHEN 2065 THEN 'experiment' END AS name,
  CASE group_id WHEN 2064 THEN 'control' WHEN 2065 THEN 'experiment' END AS tested_name, count(*) AS n
FROM g GROUP BY 1, 2, 3""")
def _(c):
    rows = c.wh.impressions.select(
        F.explode("bid__bid_request__ab_test_assignments").alias("a")
    ).select(F.col("a.group.id").alias("group_id"))
    return rows.groupBy(
        "group_id", buckets.experiment_group("group_id", CFG).alias("name"),
        buckets.experiment_group("group_id", CFG, False).alias("tested_name"),
    ).agg(F.count(F.lit(1)).alias("n"))


@check("c12_cohort_sum", "supply_hourly", """
SELECT campaign_id, CAST(sum(CASE WHEN CAST(event_at AS TIMESTAMP) - CAST(install_at AS TIMESTAMP) < INTERVAL 7 DAY
    THEN customer_revenue_micros ELSE 0 END) AS BIGINT) AS revenue_7d FROM supply_hourly GROUP BY 1""")
def _(c):
    return c.wh.supply_hourly.groupBy("campaign_id").agg(
        funnel.cohort_sum(
            "customer_revenue_micros", times.iso_timestamp("event_at"),
            times.iso_timestamp("install_at"), CFG.cohort_days,
        ).alias("revenue_7d")
    )


@check("c13_capped_moments", "app_events", """
WITH u AS (
  SELECT custom_event_id, install__ad_click__impression__auction_id AS a, install__ad_click__impression__channel_id AS ch,
    sum(least(customer_revenue_micros, 500000000) / 1e6) AS x FROM app_events GROUP BY 1, 2, 3)
SELECT custom_event_id, sum(x) AS sum_capped, sum(x * x) AS sum_squared_capped FROM u GROUP BY 1""",
       rounded="sum_capped sum_squared_capped:2")
def _(c):
    return funnel.capped_moments(
        c.wh.app_events,
        ["install__ad_click__impression__auction_id", "install__ad_click__impression__channel_id"],
        ["custom_event_id"], "customer_revenue_micros", CFG.revenue_cap,
    )


_UNIT = ("install__ad_click__impression__auction_id", "install__ad_click__impression__channel_id")


@check("c13_late_events", "app_events", f"""
WITH u AS (
  SELECT strftime(make_timestamp(install__at * 1000), '%Y') AS cohort, custom_event_id, {', '.join(_UNIT)}, count(*) AS events,
    sum(least(customer_revenue_micros, 500000000) / 1e6) AS x FROM app_events GROUP BY ALL)
SELECT cohort, custom_event_id, CAST(sum(events) AS BIGINT) AS events, count(*) AS units, sum(x) AS sum_capped,
  sum(x * x) AS sum_squared_capped FROM u GROUP BY ALL""", rounded="sum_capped:4 sum_squared_capped:2")
def _(c):
    rows = c.wh.app_events.select(
        F.date_format(F.timestamp_millis("install__at"), "yyyy").alias("cohort"), "custom_event_id", *_UNIT,
        F.lit(1).alias("events"), "customer_revenue_micros", "dt",
    )
    kept = CohortStore(
        c.spark, new_shared_path(c.spark, "cohorts"), {"custom_event_id": "bigint"}, dict.fromkeys(_UNIT, "string"), ["events"],
        "customer_revenue_micros", CFG.revenue_cap,
    )
    # The second batch has the later events of installs that the first has seen, and corrects their cohorts alone.
    kept.add("until 1996", rows.filter(F.col("dt") < "1996-01-10"))
    kept.add("since 1996", rows.filter(F.col("dt") >= "1996-01-10"))
    return kept.result()


# A unit is a campaign's day in a test group: its revenue and its installs.
_UNITS = f"""
units AS (SELECT platform, {AB} AS test_group, campaign_id, substr(dt, 1, 10) AS day, sum(revenue_micros / 1e6) AS x,
    CAST(sum(installs) AS DOUBLE) AS y FROM supply_hourly WHERE {AB} IS NOT NULL GROUP BY ALL),
intervals AS (
  SELECT platform, test_group, count(*) AS units, sum(x) / nullif(sum(y), 0) AS ratio,
    (var_samp(x) - 2 * ratio * covar_samp(x, y) + ratio * ratio * var_samp(y)) / (count(*) * avg(y) * avg(y)) AS variance
  FROM units GROUP BY ALL)"""


def _merged_moments(c):
    units = c.wh.supply_hourly.withColumn("test_group", nested.ab_group("ab_test_assignments", CFG.test_id))
    units = units.filter(F.col("test_group").isNotNull()).groupBy(
        "platform", "test_group", "campaign_id", F.substring("dt", 1, 10).alias("day")
    ).agg(F.sum(money.micros("revenue_micros")).alias("x"), F.sum("installs").alias("y"))
    by_year = moments.unit_moments(units, ["platform", "test_group", F.substring("day", 1, 4).alias("year")], "x", "y")
    return moments.merge_moments(by_year, ["platform", "test_group"])


@check("a11_ratio_interval", "supply_hourly", f"""
WITH {_UNITS}
SELECT platform, test_group, units, ratio, variance, ratio - 1.959963984540054 * sqrt(variance) AS low,
  ratio + 1.959963984540054 * sqrt(variance) AS high FROM intervals""", rounded="ratio:4 variance:3 low:3 high:3")
def _(c):
    return moments.ratio_interval(_merged_moments(c)).select("platform", "test_group", "units", "ratio", "variance", "low", "high")


@check("a11_ratio_lift", "supply_hourly", f"""
WITH {_UNITS}
SELECT platform, c.ratio AS control_ratio, e.ratio AS experiment_ratio, e.ratio / c.ratio - 1 AS lift,
  lift - 1.959963984540054 * sqrt(e.variance / pow(c.ratio, 2) + pow(e.ratio, 2) * c.variance / pow(c.ratio, 4)) AS low,
  lift + 1.959963984540054 * sqrt(e.variance / pow(c.ratio, 2) + pow(e.ratio, 2) * c.variance / pow(c.ratio, 4)) AS high
FROM intervals AS c JOIN intervals AS e USING (platform) WHERE c.test_group = 'control' AND e.test_group = 'experiment'""",
       rounded="control_ratio:4 experiment_ratio:4 lift low high")
def _(c):
    return moments.ratio_lift(_merged_moments(c), ["platform"], "test_group", "control", "experiment")


@check("c14_stack_funnel", "impressions matched_installs app_events", f"""
SELECT campaign_id, CAST(sum(impressions) AS BIGINT) AS impressions, CAST(sum(installs) AS BIGINT) AS installs,
  CAST(sum(revenue) AS BIGINT) AS revenue FROM (
  SELECT bid__campaign_id AS campaign_id, 1 AS impressions, 0 AS installs, 0 AS revenue FROM impressions
  UNION ALL SELECT ad_click__impression__bid__campaign_id, 0, 1, 0 FROM matched_installs
  UNION ALL SELECT {first_of('bid__campaign_id')}, 0, 0, customer_revenue_micros FROM app_events) AS d GROUP BY 1""")
def _(c):
    stages = [
        c.wh.impressions.select(F.col("bid__campaign_id").alias("campaign_id"), F.lit(1).alias("impressions")),
        c.wh.matched_installs.select(
            F.col("ad_click__impression__bid__campaign_id").alias("campaign_id"), F.lit(1).alias("installs")
        ),
        c.wh.app_events.select(
            nested.first_path(dataset.BID_PREFIXES, "bid__campaign_id").alias("campaign_id"),
            F.col("customer_revenue_micros").alias("revenue"),
        ),
    ]
    kinds = {m: "bigint" for m in ("impressions", "installs", "revenue")}
    return funnel.stack_funnel(stages, {"campaign_id": "bigint"}, kinds)


@check("c14_stack_stages", "supply_hourly", """
SELECT campaign_id, day, CAST(sum(spend) AS BIGINT) AS spend, CAST(sum(events) AS BIGINT) AS events FROM (
  SELECT campaign_id, substr(dt, 1, 10) AS day, spend_micros AS spend, 0 AS events FROM supply_hourly
  UNION ALL SELECT campaign_id, substr(install_at, 1, 10), 0, target_events FROM supply_hourly WHERE install_at IS NOT NULL) AS d
GROUP BY 1, 2""")
def _(c):
    rows = funnel.stack_stages(
        c.wh.supply_hourly,
        [
            (F.lit(True), {"campaign_id": F.col("campaign_id"), "day": F.substring("dt", 1, 10),
                           "spend": F.col("spend_micros")}),
            (F.col("install_at").isNotNull(),
             {"campaign_id": F.col("campaign_id"), "day": F.substring("install_at", 1, 10),
              "events": F.col("target_events")}),
        ],
        {"campaign_id": "bigint", "day": "string"}, {"spend": "bigint", "events": "bigint"},
    )
    return rows.groupBy("campaign_id", "day").agg(
        F.sum("spend").alias("spend"), F.sum("events").alias("events")
    )


@check("c15_net_revenue_by_rate", "supply_hourly", f"""
SELECT campaign_id, sum({rate('spend_micros', 'pptype', "exchange = 'NETWORK'")}) AS net,
  sum(CASE WHEN exchange = 'NETWORK' THEN CASE pptype WHEN 1 THEN spend_micros * 0.3526 * 0.9
    WHEN 2 THEN spend_micros * 0.4437 * 0.9 WHEN 3 THEN spend_micros * 0.3016 * 0.9 END END) AS scaled
FROM supply_hourly GROUP BY 1""", rounded="net:3 scaled:3")
def _(c):
    on = F.col("exchange") == CFG.network_exchange
    args = ("spend_micros", "pptype", on, CFG.network_rates)
    net = money.net_revenue_by_rate(*args, CFG.other_network_rate)
    scaled = money.net_revenue_by_rate(*args, None, CFG.throttle_rate_scale, otherwise=None)
    return c.wh.supply_hourly.groupBy("campaign_id").agg(
        F.sum(net).alias("net"),
        F.sum(scaled).alias("scaled"),
    )


@check("c16_net_revenue_by_payout", "impressions", f"""
SELECT bid__campaign_id AS campaign_id,
  sum({payout('spend_micros', 'mediation_price_micros')}) AS net,
  sum({payout('spend_micros', 'mediation_price_micros', "bid__bid_request__exchange = 'NETWORK'")}) AS on_network
FROM impressions GROUP BY 1""", rounded="net:4 on_network:4")
def _(c):
    terms = nested.first_item("bid__bid_request__impressions")["network_revenue"]
    on = F.col("bid__bid_request__exchange") == CFG.network_exchange
    args = ("spend_micros", terms, "mediation_price_micros")
    return c.wh.impressions.groupBy(F.col("bid__campaign_id").alias("campaign_id")).agg(
        F.sum(money.net_revenue_by_payout(*args)).alias("net"),
        F.sum(money.net_revenue_by_payout(*args, on)).alias("on_network"),
    )


@check("c17_net_margin", "margins", """
SELECT id, round(network_gross_margin / (1 + network_gross_margin), 6) AS net,
  round(network_gross_margin / (1 + network_gross_margin), 3) AS net_3 FROM margins""")
def _(c):
    g = "network_gross_margin"
    return c.wh.margins.select("id", money.net_margin(g).alias("net"), money.net_margin(g, 3).alias("net_3"))


@check("c18_latest_snapshot", "crm_campaign_daily campaigns", f"""
WITH {CRM_NEWEST} SELECT campaign_id, sales_region, service_level FROM crm_new""")
def _(c):
    return dims.crm_fields(c.wh.crm_campaign_daily, c.wh.campaigns, AS_OF, CFG)


@check("c19_micros", "daily_fact", """
SELECT campaign_id, sum(revenue_micros / 1e6) AS revenue FROM daily_fact GROUP BY 1""", rounded="revenue")
def _(c):
    return c.wh.daily_fact.groupBy("campaign_id").agg(
        F.sum(money.micros("revenue_micros")).alias("revenue")
    )


@check("c20_num_values_per_key", "campaign_configs change_log", """
WITH d AS (SELECT row_id AS campaign_id, json_extract_string(new_values, '$.target') AS target
  FROM change_log WHERE table_name = 'campaign_configs'),
n AS (SELECT campaign_id, count(DISTINCT target) AS num_target FROM d GROUP BY 1)
SELECT d.*, n.num_target FROM d LEFT JOIN n ON n.campaign_id = d.campaign_id""")
def _(c):
    rows = c.wh.change_log.filter(F.col("table_name") == CFG.log_configs).select(
        F.col("row_id").alias("campaign_id"), nested.json_scalar("new_values", "target").alias("target")
    )
    return dims.num_values_per_key(rows, "campaign_id", "target", "num_target")


@check("c21_exclude_keys", EVENT_TABLES, """
SELECT id, state, target FROM campaigns JOIN campaign_configs USING (id) WHERE id NOT IN (
  SELECT row_id FROM change_log WHERE table_name = 'campaigns' AND operation = 'update'
    AND json_extract_string(new_values, '$.state') = 'paused'
    AND json_extract_string(new_values, '$.state_last_changed_at') > '1997-01-01')""")
def _(c):
    both = c.wh.campaigns.select("id", "state").join(c.wh.campaign_configs.select("id", "target"), "id")
    return dims.exclude_keys(both, "id", updates.paused_campaigns(c.wh, CFG, "1997-01-01"))


@check("c22_last_update_filter", "margins", """
SELECT campaign_id, margin_type, max(updated_at) AS max_update FROM margins GROUP BY 1, 2
HAVING CAST(max(updated_at) AS DATE) >= DATE '1998-06-01'""", times="max_update")
def _(c):
    return dims.last_update_filter(
        c.wh.margins, ["campaign_id", "margin_type"], "updated_at", ">=", "1998-06-01"
    )


@check("c23_eligible_campaigns", "campaigns", """
SELECT id, daily_revenue_limit, final_optimization_state FROM campaigns
WHERE date_sub('day', created_at, TIMESTAMP '2000-01-01') >= 33 AND daily_revenue_limit > 1000
  AND campaign_type_id = 1 AND state = 'enabled' AND final_optimization_state IN ('cpi', 'cpi-vt')
  AND id NOT IN (3, 9, 27, 81)""")
def _(c):
    return dims.eligible_campaigns(
        c.wh.campaigns, "2000-01-01", CFG, opt_states=CFG.install_opt_states, exclude=[3, 9, 27, 81]
    ).select("id", "daily_revenue_limit", "final_optimization_state")


@check("c24_ratio_metrics", "supply_hourly", """
WITH m AS (SELECT campaign_id, platform, CAST(revenue_micros AS DOUBLE) AS revenue, installs, target_events AS events_d7,
    CAST(customer_revenue_micros AS DOUBLE) AS customer_revenue_d7, spend_micros / 2 AS long_net, spend_micros / 4 AS net
  FROM supply_hourly)
SELECT campaign_id, platform, sum(revenue) / nullif(CAST(sum(installs) AS DOUBLE), 0) AS rpi,
  CASE WHEN campaign_id % 3 = 0 THEN sum(revenue) / nullif(CAST(sum(events_d7) AS DOUBLE), 0) END AS rpa_7d,
  CASE WHEN campaign_id % 3 <> 0 THEN sum(customer_revenue_d7) / nullif(sum(revenue), 0) END AS roas_7d,
  sum(long_net) / nullif(sum(revenue), 0) AS long_net_margin, sum(net) / nullif(sum(revenue), 0) AS net_margin
FROM m GROUP BY 1, 2""", rounded="rpi:2 rpa_7d:2 roas_7d long_net_margin net_margin")
def _(c):
    rows = c.wh.supply_hourly.select(
        "campaign_id", "platform", F.col("revenue_micros").cast("double").alias("revenue"), "installs",
        F.col("target_events").alias("events_d7"),
        F.col("customer_revenue_micros").cast("double").alias("customer_revenue_d7"),
        (F.col("spend_micros") / 2).alias("long_net"), (F.col("spend_micros") / 4).alias("net"),
    )
    return metrics.ratio_metrics(rows, ["campaign_id", "platform"], F.col("campaign_id") % 3 == 0)


@check("c25_reconcile", "daily_fact published_dataset", """
WITH e AS (SELECT dt, campaign_id, sum(revenue_micros / 1e6) AS r FROM daily_fact GROUP BY 1, 2),
a AS (SELECT dt, campaign_id, sum(test_revenue_micros / 1e6) AS r FROM published_dataset GROUP BY 1, 2)
SELECT e.dt, e.campaign_id, e.r AS expected_revenue, a.r AS actual_revenue, e.r / nullif(a.r, 0) - 1 AS delta_revenue
FROM e JOIN a ON e.dt = a.dt AND e.campaign_id = a.campaign_id
WHERE abs(e.r / nullif(a.r, 0) - 1) >= 0.001 OR (a.r = 0 AND e.r <> 0)""",
       rounded="expected_revenue actual_revenue delta_revenue")
def _(c):
    keys = ["dt", "campaign_id"]
    e = c.wh.daily_fact.groupBy(*keys).agg(F.sum(money.micros("revenue_micros")).alias("revenue"))
    a = c.wh.published_dataset.groupBy(*keys).agg(
        F.sum(money.micros("test_revenue_micros")).alias("revenue")
    )
    return quality.reconcile(e, a, keys, ["revenue"])


@check("c25_reconcile_both", "daily_fact published_dataset", """
WITH e AS (SELECT dt, campaign_id, CAST(sum(revenue_micros) AS BIGINT) AS r FROM daily_fact WHERE campaign_id % 7 <> 3 GROUP BY ALL),
a AS (SELECT dt, campaign_id, CAST(sum(test_revenue_micros) AS BIGINT) AS r FROM published_dataset WHERE campaign_id % 11 <> 5 GROUP BY ALL)
SELECT coalesce(e.dt, a.dt) AS dt, coalesce(e.campaign_id, a.campaign_id) AS campaign_id,
  CASE WHEN a.dt IS NULL THEN 'missing' WHEN e.dt IS NULL THEN 'unexpected' ELSE 'changed' END AS finding,
  e.r AS expected_revenue, a.r AS actual_revenue, e.r / nullif(a.r, 0) - 1 AS delta_revenue
FROM e FULL JOIN a ON e.dt = a.dt AND e.campaign_id = a.campaign_id
WHERE a.dt IS NULL OR e.dt IS NULL OR abs(e.r / nullif(a.r, 0) - 1) >= 0.001 OR (a.r = 0 AND e.r <> 0)""", rounded="delta_revenue")
def _(c):
    keys = ["dt", "campaign_id"]
    e = c.wh.daily_fact.filter("campaign_id % 7 <> 3").groupBy(*keys).agg(F.sum("revenue_micros").alias("revenue"))
    a = c.wh.published_dataset.filter("campaign_id % 11 <> 5").groupBy(*keys).agg(F.sum("test_revenue_micros").alias("revenue"))
    return quality.reconcile_both(e, a, keys, ["revenue"])


@check("c26_previous_period", "daily_fact", """
WITH d AS (SELECT campaign_id, dt, CAST(sum(revenue_micros) AS BIGINT) AS revenue, CAST(sum(installs) AS BIGINT) AS installs
  FROM daily_fact GROUP BY 1, 2)
SELECT *, lag(revenue) OVER w AS previous_revenue, lag(installs) OVER w AS previous_installs FROM d
WINDOW w AS (PARTITION BY campaign_id ORDER BY dt)""")
def _(c):
    daily = c.wh.daily_fact.groupBy("campaign_id", "dt").agg(
        F.sum("revenue_micros").alias("revenue"), F.sum("installs").alias("installs")
    )
    return metrics.previous_period(
        daily, ["campaign_id"], "dt", {"previous_revenue": "revenue", "previous_installs": "installs"}
    )


_SIDES = [f"{s}_{a}_{p}_gross_margin" for s in ("control", "experiment")
          for a in ("old", "new") for p in ("network", "other")]


def pair_columns() -> str:
    parts = []
    for p in ("network", "other"):
        parts.append(f"coalesce(c.old_{p}_gross_margin, e.old_{p}_gross_margin) AS control_old_{p}_gross_margin")
        parts.append(f"c.new_{p}_gross_margin AS control_new_{p}_gross_margin")
        parts.append(f"e.old_{p}_gross_margin AS experiment_old_{p}_gross_margin")
        parts.append(f"e.new_{p}_gross_margin AS experiment_new_{p}_gross_margin")
    return ", ".join(parts)


@check("c27_control_vs_experiment", EVENT_TABLES, f"""
WITH {MARGIN_EVENTS}, {side('control', '0')}, {side('experiment', None)}
SELECT e.campaign_id, e.updated_date, e.target, {pair_columns()}
FROM c_side c JOIN e_side e ON c.campaign_id = e.campaign_id AND c.updated_date = e.updated_date""",
       times="updated_date")
def _(c):
    return track.margin_pairs(c.wh, CFG, AFTER, BEFORE, "inner", "experiment")


def _in_force(name: str) -> str:
    return f"last_value(CASE WHEN side = '{name}' THEN own END IGNORE NULLS) OVER upto AS {name[0]}"


@check("c27_nearest_pairing", EVENT_TABLES, f"""
WITH {MARGIN_EVENTS},
sides AS (
  SELECT campaign_id, logged_at, change_id, margin_type AS side, target, {{'n': net_m, 'o': oth_m,
    'pn': coalesce(lag(net_m) OVER w, if(margin_type = 'control', 0, NULL)), 'po': coalesce(lag(oth_m) OVER w, if(margin_type = 'control', 0, NULL))}} AS own
  FROM mev WHERE {IN_TYPES} AND {LOG_DAYS} WINDOW w AS (PARTITION BY campaign_id, margin_type ORDER BY logged_at, change_id)),
timeline AS (
  SELECT campaign_id, logged_at, change_id, side, {_in_force('control')}, {_in_force('experiment')},
    last_value(CASE WHEN side = 'experiment' THEN {{'t': target}} END IGNORE NULLS) OVER upto AS t
  FROM sides WHERE campaign_id IS NOT NULL
  WINDOW upto AS (PARTITION BY campaign_id ORDER BY logged_at, change_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))
SELECT campaign_id, logged_at, change_id, side, coalesce(c.pn, e.pn) AS control_old_network_gross_margin,
  coalesce(c.po, e.po) AS control_old_other_gross_margin, c.n AS control_new_network_gross_margin, c.o AS control_new_other_gross_margin,
  e.pn AS experiment_old_network_gross_margin, e.po AS experiment_old_other_gross_margin, e.n AS experiment_new_network_gross_margin,
  e.o AS experiment_new_other_gross_margin, t.t AS target FROM timeline""", times="logged_at")
def _(c):
    return track.margin_pairs(c.wh, CFG, AFTER, BEFORE, "inner", "experiment", pairing="nearest")


UPDATE_PERIOD = Period("1996-04-05", "2000-12-30")
_PLACE = (("control", "network"), ("control", "other"), ("experiment", "network"), ("experiment", "other"))


def update_branches() -> str:
    model = ", ".join(
        f"max(d.new_{s}_gross_margin_{p} / (1 + d.new_{s}_gross_margin_{p})) AS new_{s}_{p}_net_margin"
        for s, p in _PLACE
    )
    short = {"network": "net_m", "other": "oth_m"}
    manual = ", ".join(
        f"max(CASE WHEN margin_type {'=' if s == 'control' else '<>'} 'control' THEN {short[p]} / (1 + {short[p]}) END)"
        for s, p in _PLACE
    )
    span = f"logged_at >= TIMESTAMP '{UPDATE_PERIOD.start}' AND logged_at < TIMESTAMP '{UPDATE_PERIOD.end}'"
    return f"""
merged AS (
  SELECT g.campaign_id, d.target AS model_target, g.target_reasons, 'model' AS update_source, d.margin_reason,
    d.margin_exploration_algorithm, {model}, min(d.updated_at) AS min_update_at
  FROM campaign_configs g LEFT JOIN daily_analysis d ON d.campaign_id = g.campaign_id
  WHERE EXISTS (SELECT 1 FROM change_log l JOIN campaign_configs g2 ON g2.id = l.row_id
    WHERE l.table_name = 'campaign_configs' AND g2.campaign_id = g.campaign_id AND {span})
  GROUP BY 1, 2, 3, 4, 5, 6
  UNION ALL
  SELECT campaign_id, NULL, NULL, source, NULL, NULL, {manual}, min(logged_at)
  FROM mev WHERE {IN_TYPES} AND source <> 'model' AND {span} GROUP BY campaign_id, source
  UNION ALL
  SELECT g.campaign_id, json_extract_string(l.new_values, '$.target'), g.target_reasons, 'target_switch', NULL, NULL,
    NULL, NULL, NULL, NULL, l.logged_at
  FROM change_log l LEFT JOIN campaign_configs g ON g.id = l.row_id
  WHERE l.table_name = 'campaign_configs' AND json_extract(l.new_values, '$.target') IS NOT NULL
)"""


NET_COLUMNS = " ".join(f"new_{s}_{p}_net_margin" for s, p in _PLACE)


@check("s7_publish_in_one_step", "daily_fact", """
SELECT substr(dt, 1, 4) AS dt, campaign_id, CAST(sum(revenue_micros) AS BIGINT) AS revenue_micros FROM daily_fact
WHERE substr(dt, 1, 4) <> '1997' GROUP BY ALL""")
def _(c):
    yearly = c.wh.daily_fact.groupBy(F.substring("dt", 1, 4).alias("dt"), "campaign_id").agg(
        F.sum("revenue_micros").alias("revenue_micros")
    )
    path = new_shared_path(c.spark, "published")
    years = [str(y) for y in range(1992, 2003)]
    sink.publish_partitions(yearly.withColumn("revenue_micros", F.lit(0).cast("bigint")), path, years)
    sink.publish_partitions(yearly, path, years)
    # A year that is published without rows is empty, not missing.
    sink.publish_partitions(yearly.limit(0), path, ["1997"])
    return sink.read_published(c.spark, path, "campaign_id bigint, revenue_micros bigint")


@check("c28_merge_update_sources", f"{EVENT_TABLES} daily_analysis", f"""
WITH {MARGIN_EVENTS}, {update_branches()} SELECT * FROM merged""", times="min_update_at", rounded=NET_COLUMNS)
def _(c):
    return history.merge_update_sources(
        [
            updates._model_branch(c.wh, CFG, UPDATE_PERIOD),
            updates._manual_branch(c.wh, CFG, UPDATE_PERIOD),
            updates._switch_branch(c.wh, CFG),
        ],
        updates._TIMELINE,
    )


@check("c29_enrich_dims", "daily_fact customers campaigns crm_campaign_daily", f"""
WITH {CRM_NEWEST},
d AS (SELECT campaign_id, customer_id, CAST(sum(revenue_micros) AS BIGINT) AS revenue FROM daily_fact GROUP BY 1, 2)
SELECT d.*, cu.company AS customer_name, s.sales_region, s.service_level, p.current_optimization_state
FROM d LEFT JOIN customers cu ON cu.id = d.customer_id LEFT JOIN crm_new s ON s.campaign_id = d.campaign_id
LEFT JOIN campaigns p ON p.id = d.campaign_id""")
def _(c):
    sums = c.wh.daily_fact.groupBy("campaign_id", "customer_id").agg(
        F.sum("revenue_micros").alias("revenue")
    )
    return dims.enrich_dims(
        sums, c.wh.customers, dims.crm_fields(c.wh.crm_campaign_daily, c.wh.campaigns, AS_OF, CFG),
        c.wh.campaigns,
    )
