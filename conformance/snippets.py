"""SQL parts that several oracle queries share, in DuckDB's dialect."""

from conformance.registry import AFTER, AS_OF, BEFORE, LIMIT_DAYS

AB = 'list_filter(ab_test_assignments, lambda a: a.id = 916)[1]."group".name'

# Margin changes with the current margin row, config and limit beside them.
MARGIN_EVENTS = """
mev AS (
  SELECT l.change_id, l.logged_at, l.source,
    json_extract_string(l.new_values, '$.margin_type') AS margin_type,
    json_extract_string(l.old_values, '$.margin_type') AS previous_margin_type,
    json_extract_string(l.new_values, '$.network_gross_margin') AS logged_network,
    json_extract_string(l.new_values, '$.other_gross_margin') AS logged_other,
    m.campaign_id, m.margin_type AS base_margin_type,
    m.network_gross_margin AS net_m, m.other_gross_margin AS oth_m, m.updated_at,
    g.target, g.threshold, p.daily_revenue_limit
  FROM change_log l
  LEFT JOIN margins m ON m.id = l.row_id
  LEFT JOIN campaign_configs g ON g.campaign_id = m.campaign_id
  LEFT JOIN campaigns p ON p.id = g.campaign_id
  WHERE l.table_name = 'margins'
)"""
IN_TYPES = "margin_type IN ('control', 'experiment')"
EVENT_TABLES = "change_log margins campaign_configs campaigns"

_BY_TYPE = "(PARTITION BY campaign_id, margin_type ORDER BY logged_at, change_id)"


def old_new(default: str) -> str:
    return f"""coalesce(lag(net_m) OVER {_BY_TYPE}, {default}) AS old_network_gross_margin,
    coalesce(lag(oth_m) OVER {_BY_TYPE}, {default}) AS old_other_gross_margin,
    net_m AS new_network_gross_margin, oth_m AS new_other_gross_margin"""


def margin_history(trunc: str | None) -> str:
    start = "logged_at"
    end = (
        "coalesce(lead(logged_at, 2) OVER (PARTITION BY campaign_id, previous_margin_type "
        f"ORDER BY logged_at, change_id), TIMESTAMP '{AS_OF}')"
    )
    if trunc:
        start, end = f"date_trunc('{trunc}', {start})", f"date_trunc('{trunc}', {end})"
    return f"""
mhist AS (
  SELECT campaign_id, {start} AS valid_from, {end} AS valid_to, margin_type,
    {old_new('999999')}, target, threshold, daily_revenue_limit
  FROM mev WHERE {IN_TYPES}
)"""


def setting(name: str, table: str, log_table: str, campaign: str, key: str, extra: str = "") -> str:
    return f"""
{name} AS (
  SELECT b.{campaign} AS campaign_id, date_trunc('hour', l.logged_at) AS valid_from,
    date_trunc('hour', coalesce(lead(l.logged_at) OVER (PARTITION BY b.{campaign} ORDER BY l.logged_at, l.change_id),
      TIMESTAMP '{AS_OF}')) AS valid_to,
    json_extract_string(l.new_values, '$.{key}') AS val
  FROM change_log l JOIN {table} b ON b.id = l.row_id
  WHERE l.table_name = '{log_table}' AND json_extract(l.new_values, '$.{key}') IS NOT NULL {extra}
)"""


TARGETS = setting("thist", "campaign_configs", "campaign_configs", "campaign_id", "target")
THRESHOLDS = setting("hhist", "campaign_configs", "campaign_configs", "campaign_id", "threshold")
LIMITS = setting(
    "dhist", "campaigns", "campaigns", "id", "daily_revenue_limit",
    f"AND l.operation = 'update' AND CAST(l.logged_at AS DATE) BETWEEN DATE '{LIMIT_DAYS[0]}' AND DATE '{LIMIT_DAYS[1]}'",
)

CRM_NEWEST = f"""
crm_new AS (
  SELECT p.id AS campaign_id, s.sales_region, s.sales_sub_region, s.service_level
  FROM crm_campaign_daily s JOIN campaigns p ON p.crm_campaign_id = s.crm_campaign_id
  WHERE s.dt = (SELECT max(dt) FROM crm_campaign_daily
                WHERE CAST(dt AS TIMESTAMP) >= TIMESTAMP '{AS_OF}' - INTERVAL 2 DAY)
)"""

LOG_DAYS = (
    f"CAST(logged_at AS DATE) > DATE '{AFTER}' AND CAST(logged_at AS DATE) < DATE '{BEFORE}'"
)


def side(kind: str, default: str | None) -> str:
    """Changes of one margin type; lag over the rows of the log days only."""
    old = (
        old_new(default) if default is not None
        else old_new("NULL")
    )
    return f"""
{kind[0]}_side AS (
  SELECT campaign_id, CAST(logged_at AS DATE) AS updated_date, target, daily_revenue_limit,
    {old}
  FROM mev WHERE margin_type = '{kind}' AND {LOG_DAYS}
)"""


# Hour text of an epoch-millisecond column.
def hour_text(ms: str) -> str:
    return f"strftime(date_trunc('hour', make_timestamp(({ms}) * 1000)), '%Y-%m-%dT%H:%M:%SZ')"


def first_of(suffix: str) -> str:
    return (
        f"coalesce(attribution_event__click__impression__{suffix}, "
        f"reeng_click__impression__{suffix}, install__ad_click__impression__{suffix})"
    )


def first_size() -> str:
    s = "bid__bid_request__impressions[1].logical_size"
    return first_of(s)


COUNTRY = (
    "coalesce(attribution_event__click__geo__country, reeng_click__geo__country, "
    "install__geo__country)"
)


def pptype(raw: str) -> str:
    return f"TRY_CAST(json_extract_string(decode({raw}), '$.imp[0].ext.pptype') AS INTEGER)"


def payout(spend: str, price: str, network: str = "TRUE") -> str:
    terms = "bid__bid_request__impressions[1].network_revenue"
    return f"""CASE
      WHEN NOT coalesce({network}, FALSE) THEN 0.0
      WHEN {terms}.payout_type = 'FLAT_CPM' THEN CAST({spend} AS DOUBLE) - {terms}.publisher_flat_cpm_micros // 1000
      WHEN {terms}.payout_type = 'REVENUE_SHARE' THEN {spend} * (1.0::DOUBLE - {terms}.publisher_revenue_share)
      WHEN {terms}.payout_type = 'HEADER_BIDDING' THEN CAST({spend} - {price} AS DOUBLE)
      ELSE 0.0 END"""


def rate(spend: str, kind: str, network: str) -> str:
    return f"""CASE WHEN {network} THEN CASE
      WHEN {kind} = 1 THEN {spend} * 0.3526 WHEN {kind} = 2 THEN {spend} * 0.4437
      WHEN {kind} = 3 THEN {spend} * 0.3016 WHEN {kind} IS NOT NULL THEN {spend} * 0.3319
      ELSE 0 END ELSE 0 END"""
