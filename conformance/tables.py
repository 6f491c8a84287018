"""Ad tables derived from the driver's tables, for Spark and for DuckDB.

The driver has no ad data, so the input tables are expressions over orders,
lineitem, customer, nation and region, over all of their rows. One text serves
both engines: what differs between them goes through a dialect. Only inputs are
shared in this way; each oracle query is written on its own.
"""

from __future__ import annotations

from functools import cache

from pyspark.sql import DataFrame, SparkSession

from marginlab import Warehouse

SOURCES = ("region", "nation", "customer", "orders", "lineitem", "events", "part", "supplier")


class Spark:
    int_ = "int"

    def ms(self, ts): return f"unix_millis({ts})"
    def iso(self, ts): return f"date_format({ts}, \"yyyy-MM-dd'T'HH:mm:ss'Z'\")"
    def add(self, ts, n, unit): return f"timestampadd({unit}, cast({n} as int), {ts})"
    def div(self, a, b): return f"(({a}) div ({b}))"
    def struct(self, **f): return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in f.items()) + ")"
    def arr(self, *x): return "array(" + ", ".join(x) + ")"
    def empty(self, a): return f"slice({a}, 1, 0)"
    def blob(self, x): return f"encode({x}, 'UTF-8')"
    def q(self, name): return f"`{name}`"


class Duck:
    int_ = "integer"

    def ms(self, ts): return f"epoch_ms({ts})"
    def iso(self, ts): return f"strftime({ts}, '%Y-%m-%dT%H:%M:%SZ')"
    def add(self, ts, n, unit): return f"({ts} + ({n}) * INTERVAL 1 {unit})"
    def div(self, a, b): return f"(({a}) // ({b}))"
    def struct(self, **f): return "{" + ", ".join(f"'{k}': {v}" for k, v in f.items()) + "}"
    def arr(self, *x): return "[" + ", ".join(x) + "]"
    def empty(self, a): return f"({a})[1:0]"
    def blob(self, x): return f"encode({x})"
    def q(self, name): return f'"{name}"'


def _select(columns: dict[str, str], source: str, d) -> str:
    cols = ",\n  ".join(f"{e} AS {d.q(n)}" for n, e in columns.items())
    return f"SELECT\n  {cols}\nFROM {source}"


def _pick(value: str, *cases: str) -> str:
    """The cases by value modulo their number; NULL may be one of them."""
    body = " ".join(f"WHEN {i} THEN {c}" for i, c in enumerate(cases))
    return f"CASE ({value}) % {len(cases)} {body} END"


def table_sql(d, src) -> dict[str, str]:
    """SELECT text of each table. ``src(name)`` names a driver table."""
    hour = lambda ts: f"date_trunc('hour', {ts})"
    day = lambda ts: f"date_trunc('day', {ts})"
    ship = "cast(l_shipdate as timestamp)"
    at_ts = d.add(d.add(ship, "l_orderkey % 24", "HOUR"), "l_linenumber * 7", "MINUTE")
    at_ms = d.ms(at_ts)
    cents = "cast(round(l_extendedprice * 100) as bigint)"
    disc = "cast(round(l_discount * 100) as bigint)"
    revenue = f"({cents} * 10000)"
    spend = f"({cents} * 100 * (100 - {disc}))"
    exchange = "CASE l_returnflag WHEN 'R' THEN 'NETWORK' WHEN 'A' THEN 'HOUSE' ELSE 'EX_N' END"
    platform = _pick("l_linenumber", "'IOS'", "'ANDROID'")
    test_group = d.struct(
        id="cast(2063 + l_orderkey % 4 as int)",
        name=_pick("l_orderkey", "'holdout'", "'control'", "'experiment'", "'spare'"),
    )
    other_test = d.struct(id="917", group=d.struct(id="3001", name="'other'"))
    this_test = d.struct(id="916", group=test_group)
    both = d.arr(other_test, this_test)
    assignments = (
        f"CASE WHEN l_orderkey % 11 = 0 THEN {d.empty(both)} WHEN l_orderkey % 13 = 0 THEN NULL "
        f"WHEN l_orderkey % 17 = 0 THEN {d.arr(other_test)} ELSE {both} END"
    )
    raw = d.blob(
        "CASE WHEN l_linenumber % 5 = 0 THEN '{\"imp\":[]}' ELSE "
        "concat('{\"imp\":[{\"ext\":{\"pptype\":', cast(l_linenumber % 5 as string), '}}]}') END"
    )
    slots = d.arr(
        d.struct(
            logical_size=_pick(
                "l_suppkey", "'L0x0'", "'L300x250'", "'L320x50'", "'L728x90'",
                "'UNKNOWN_LOGICAL_SIZE'", "NULL", "'L480x320'",
            ),
            network_revenue=d.struct(
                payout_type=_pick(
                    "l_suppkey", "'FLAT_CPM'", "'REVENUE_SHARE'", "'HEADER_BIDDING'", "'NONE'", "NULL"
                ),
                publisher_flat_cpm_micros="cast(l_partkey * 1234 as bigint)",
                publisher_revenue_share="cast(l_linenumber as double) / 16",
            ),
        )
    )
    slots = f"CASE WHEN l_orderkey % 19 = 0 THEN {d.empty(slots)} ELSE {slots} END"
    t = {}

    t["supply_hourly"] = _select({
        "dt": d.iso(hour(at_ts)),
        "event_at": d.iso(hour(at_ts)),
        "impression_at": d.iso(hour(at_ts)),
        "install_at": f"CASE WHEN l_linenumber % 7 = 0 THEN NULL ELSE {d.iso(hour(d.add(at_ts, '1 - l_orderkey % 12', 'DAY')))} END",
        "campaign_id": "cast(l_partkey as bigint)",
        "platform": platform,
        "exchange": exchange,
        "country": _pick("l_suppkey", "'US'", "'DE'", "NULL"),
        "customer_name": "concat('NATION_', cast(l_partkey % 25 as string))",
        "customer_id": "cast(l_partkey % 25 as bigint)",
        "dest_app_id": "cast(l_suppkey as bigint)",
        "ad_format": _pick("l_suppkey", "'native'", "'mrec'", "'banner'"),
        "current_optimization_state": _pick(
            "l_partkey", "'cpr'", "'cprv3-vt'", "'cpa-vt'", "'cpi'", "'cpm'", "NULL"
        ),
        "pptype": f"cast(nullif(l_linenumber % 5, 0) as {d.int_})",
        "ab_test_assignments": assignments,
        "impressions": "cast(l_linenumber + 1 as bigint)",
        "clicks": "cast(l_linenumber % 3 as bigint)",
        "installs": "cast(l_linenumber % 2 as bigint)",
        "spend_micros": spend,
        "revenue_micros": revenue,
        "customer_revenue_micros": f"CASE WHEN l_linenumber % 3 = 0 THEN NULL ELSE {cents} * 5000 END",
        "target_events": "cast(l_linenumber % 4 as bigint)",
    }, src("lineitem"), d)

    t["impressions"] = _select({
        "dt": f"CASE WHEN l_linenumber = 4 THEN {d.iso(hour(d.add(at_ts, '1', 'HOUR')))} ELSE {d.iso(hour(at_ts))} END",
        "at": at_ms,
        "bid__campaign_id": "cast(l_partkey as bigint)",
        "bid__customer_id": "cast(l_suppkey % 30 as bigint)",
        "bid__app_platform": platform,
        "bid__bid_request__exchange": exchange,
        "exchange": exchange,
        "bid__bid_request__raw": raw,
        "bid__bid_request__impressions": slots,
        "bid__bid_request__ab_test_assignments": assignments,
        "bid__margin_data__base_gross_margin": "nullif(l_tax, 0)",
        "spend_micros": spend,
        "revenue_micros": revenue,
        "mediation_price_micros": d.div(spend, "3"),
    }, src("lineitem"), d)

    install = {
        "dt": d.iso(hour(at_ts)),
        "event_timestamp": at_ms,
        "ad_click__impression__at": f"{at_ms} - (l_orderkey % 48) * 3600000",
        "ad_click__impression__bid__bid_request__raw": raw,
        "ad_click__impression__bid__bid_request__ab_test_assignments": assignments,
        "for_reporting": "l_linenumber <> 5",
        "is_uncredited": "l_orderkey % 23 = 0",
    }
    t["matched_installs"] = _select({
        **install,
        "ad_click__impression__bid__campaign_id": "cast(l_partkey as bigint)",
        "ad_click__impression__bid__customer_id": "cast(l_suppkey % 30 as bigint)",
        "ad_click__impression__bid__bid_request__exchange": exchange,
        "ad_click__impression__bid__bid_request__device__platform": platform,
    }, src("lineitem"), d)
    t["unmatched_installs"] = _select({
        **install,
        "tracker_params__campaign_id": "cast(l_partkey as bigint)",
        "tracker_params__platform": platform,
    }, src("lineitem"), d)

    def event_bid(prefix: str, present: str, campaign: str) -> dict[str, str]:
        when = lambda e: f"CASE WHEN {present} THEN {e} END"
        return {
            f"{prefix}at": when(f"{at_ms} - (l_orderkey % 48) * 3600000"),
            f"{prefix}bid__campaign_id": when(f"cast({campaign} as bigint)"),
            f"{prefix}bid__customer_id": when("cast(l_suppkey % 30 as bigint)"),
            f"{prefix}bid__app_id": when("cast(l_suppkey as bigint)"),
            f"{prefix}bid__app_platform": when(platform),
            f"{prefix}bid__creative__type": when(
                "CASE l_suppkey % 10 WHEN 0 THEN 'NATIVE' WHEN 1 THEN 'UNMATCHED' ELSE 'VIDEO' END"
            ),
            f"{prefix}bid__bid_request__exchange": when(exchange),
            f"{prefix}bid__bid_request__raw": when(raw),
            f"{prefix}bid__bid_request__impressions": when(slots),
        }

    first = "l_linenumber % 3 = 0"
    second = "l_linenumber % 3 = 1"
    event = {
        "dt": d.iso(hour(at_ts)),
        "at": at_ms,
        "event_timestamp": at_ms,
        "install__at": f"{at_ms} - (l_orderkey % 12 - 1) * 86400000",
        "custom_event_id": "cast(l_suppkey % 5 as bigint)",
        "customer_revenue_micros": (
            f"CASE WHEN l_orderkey % 101 = 0 THEN 200000000000 WHEN l_linenumber % 6 = 0 "
            f"THEN -{cents} * 100 ELSE {cents} * 100 END"
        ),
        "for_reporting": "l_linenumber <> 5",
        "is_uncredited": "l_orderkey % 23 = 0",
        **event_bid("attribution_event__click__impression__", first, "l_partkey"),
        **event_bid("reeng_click__impression__", second, "l_partkey"),
        **event_bid("install__ad_click__impression__", "l_orderkey % 29 <> 0", "l_partkey + 1"),
        "attribution_event__click__geo__country": f"CASE WHEN {first} THEN 'US' END",
        "reeng_click__geo__country": f"CASE WHEN {second} THEN 'DE' END",
        "install__geo__country": _pick("l_suppkey", "'US'", "'FR'", "NULL"),
        "install__ad_click__impression__auction_id": "concat('a', cast(l_orderkey as string))",
        "install__ad_click__impression__channel_id": "concat('c', cast(l_linenumber % 2 as string))",
        "install__ad_click__impression__bid__price_data__model_type":
            "CASE WHEN l_linenumber = 4 THEN 'cpi' ELSE 'first_revenue_v2' END",
        "install__ad_click__impression__bid__bid_request__ab_test_assignments": assignments,
    }
    tracker = {
        "tracker_params__campaign_id": "cast(l_partkey as bigint)",
        "tracker_params__platform": platform,
    }
    t["app_events"] = _select(event, src("lineitem"), d)
    t["matched_app_events"] = t["app_events"]
    t["unmatched_app_events"] = _select({**event, **tracker}, src("lineitem"), d)

    daily = {
        "campaign_id": "cast(l_partkey as bigint)",
        "campaign_name": "concat('campaign ', cast(l_partkey as string))",
        "customer_id": "cast(l_partkey % 25 as bigint)",
        "customer_name": "concat('NATION_', cast(l_partkey % 25 as string))",
        "ae_email": "concat('ae', cast(l_suppkey % 9 as string), '@example.com')",
        "csm_email": "concat('csm', cast(l_suppkey % 4 as string), '@example.com')",
        "is_uncredited": "CASE WHEN l_orderkey % 23 = 0 THEN 'true' ELSE 'false' END",
    }
    t["daily_fact"] = _select({
        "dt": d.iso(day(at_ts)),
        **daily,
        "campaign_type": _pick("l_partkey", "'UA'", "'RE'"),
        "dest_app_id": "cast(l_partkey % 7 as bigint)",
        "dest_app_name": "concat('app ', cast(l_partkey % 7 as string))",
        "platform": platform,
        "exchange": exchange,
        "installs": "cast(l_linenumber % 2 as bigint)",
        "revenue_micros": revenue,
        "spend_micros": spend,
    }, src("lineitem"), d)
    attributed = {
        "target_events_d7": "cast(l_linenumber % 4 as bigint)",
        "customer_revenue_micros_d7": f"{cents} * 5000",
    }
    t["daily_attr_d7"] = _select({
        "dt": d.iso(day(at_ts)),
        **daily,
        "revenue_micros_d1": revenue,
        "installs_d1": "cast(l_linenumber % 2 as bigint)",
        **attributed,
    }, src("lineitem"), d)
    t["daily_credited_d7"] = _select({
        "dt": d.iso(day(d.add(at_ts, "l_orderkey % 2", "DAY"))),
        **daily,
        **attributed,
    }, src("lineitem"), d)
    t["published_dataset"] = _select({
        "dt": d.iso(day(at_ts)),
        "impression_at": d.iso(hour(at_ts)),
        "campaign_id": "cast(l_partkey as bigint)",
        "exchange_group": "CASE l_returnflag WHEN 'R' THEN 'Network' ELSE 'Non-Network' END",
        "test_revenue_micros": (
            f"CASE WHEN l_partkey % 50 = 0 AND l_linenumber < 4 THEN {d.div(revenue, '2')} ELSE {revenue} END"
        ),
    }, src("lineitem"), d)

    ordered = "cast(o_orderdate as timestamp)"

    def logged(minutes: str) -> str:
        return d.add(d.add(ordered, "o_orderkey % 24", "HOUR"), minutes, "MINUTE")

    margins = [
        f"cast((o_orderkey * {k}) % 40 as double) / 100" for k in (1, 3, 7, 9)
    ]
    same = "o_orderkey % 4 = 0"
    analysis = {
        "campaign_id": "cast(o_custkey as bigint)",
        "updated_at": logged("o_orderkey % 50"),
        "target": _pick("o_orderkey", "'NR'", "'RPI'", "'disabled'"),
        "threshold": "cast(o_orderkey % 50 as double) / 100",
        "margin_reason": "o_orderpriority",
        "margin_exploration_algorithm": _pick("o_custkey", "'greedy'", "'bandit'"),
    }
    names = [f"{s}_gross_margin_{p}" for s in ("control", "experiment") for p in ("network", "other")]
    for n, m in zip(names, margins):
        analysis[f"old_{n}"] = m
        analysis[f"new_{n}"] = f"CASE WHEN {same} THEN {m} ELSE {m} + 0.25 END"
    for n, k in (("measured_control_nrm", 3), ("measured_experiment_nrm", 5), ("predicted_best_nrm", 7),
                 ("predicted_best_rpi", 11), ("measured_control_rpi", 6), ("measured_experiment_rpi", 9)):
        analysis[n] = f"CASE WHEN o_orderkey % {k} = 0 THEN NULL ELSE cast(o_orderkey % 100 as double) / 8 END"
    total = "cast(round(o_totalprice * 100) as bigint) * 10000"
    analysis |= {
        "control_gross_revenue": f"CASE WHEN o_orderstatus = 'P' THEN NULL ELSE {total} END",
        "control_installs": "cast(o_orderkey % 91 as bigint)",
        "experiment_gross_revenue": f"CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE {total} END",
        "experiment_installs": "cast(o_orderkey % 87 as bigint)",
    }
    t["daily_analysis"] = _select(analysis, src("orders"), d)

    def log_rows(kind: int, row_id: str, table: str, new: str, old: str, orders: str = src("orders")) -> str:
        return _select({
            "change_id": f"cast(o_orderkey * 4 + {kind} as bigint)",
            "row_id": f"cast({row_id} as bigint)",
            "table_name": f"'{table}'",
            "operation": "CASE WHEN o_orderkey % 8 = 0 THEN 'insert' ELSE 'update' END",
            "source": _pick("o_orderkey", "'model'", "'manual'", "'adhoc'", "'model'", "NULL"),
            "logged_at": logged(f"(o_orderkey % 7) * 8 + {kind}"),
            "new_values": new,
            "old_values": old,
        }, orders, d)

    text = lambda e: f"cast({e} as string)"
    kinds = _pick("o_orderkey", "'control'", "'control'", "'experiment'", "'experiment'", "'base'")
    side = _pick(d.div("o_orderkey", "2"), "'control'", "'experiment'")
    goal = "CASE WHEN o_orderkey % 29 = 0 THEN 'null' ELSE concat('\"', " + _pick(
        "o_orderkey", "'NR'", "'RPI'", "'disabled'", "'NR'"
    ) + ", '\"') END"
    # Every other change of one type has a change of the other type on its day.
    paired = f"CASE {kinds} WHEN 'control' THEN 'experiment' ELSE 'control' END"
    every_other = f"(SELECT * FROM {src('orders')} WHERE o_orderkey % 2 = 0) AS every_other"
    t["change_log"] = "\nUNION ALL\n".join([
        log_rows(
            3, "2 * o_custkey + o_orderkey % 3", "margins",
            f"concat('{{\"margin_type\":\"', {paired}, '\",\"other_gross_margin\":\"0.', {text('10 + o_orderkey % 30')}, '\"}}')",
            f"concat('{{\"margin_type\":\"', {side}, '\"}}')", every_other,
        ),
        log_rows(
            0, "2 * o_custkey + o_orderkey % 3", "margins",
            f"concat('{{\"margin_type\":\"', {kinds}, '\"', CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE "
            f"concat(',\"network_gross_margin\":\"0.', {text('10 + o_orderkey % 50')}, '\"') END, "
            f"',\"other_gross_margin\":\"0.', {text('10 + o_orderkey % 60')}, '\"}}')",
            f"concat('{{\"margin_type\":\"', {side}, '\"}}')",
        ),
        log_rows(
            1, "o_custkey + o_orderkey % 2", "campaign_configs",
            f"concat('{{\"id\":', {text('o_custkey')}, CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE "
            f"concat(',\"target\":', {goal}) END, CASE WHEN o_orderkey % 2 = 0 THEN '' ELSE "
            f"concat(',\"threshold\":\"', {text('o_orderkey % 50')}, '\"') END, '}}')",
            f"CASE WHEN o_orderkey % 5 = 0 THEN '{{}}' ELSE concat('{{\"threshold\":\"', {text('o_orderkey % 40')}, '\"}}') END",
        ),
        log_rows(
            2, "o_custkey", "campaigns",
            f"concat('{{\"state\":\"', CASE WHEN o_orderkey % 40 = 1 THEN 'paused' ELSE 'enabled' END, '\"', "
            f"CASE WHEN o_orderkey % 3 = 1 THEN '' ELSE concat(',\"daily_revenue_limit\":', {text('o_orderkey % 5000')}) END, "
            f"',\"state_last_changed_at\":\"', {d.iso(ordered)}, '\"}}')",
            "'{}'",
        ),
    ])

    def margin_rows(k: int, kind: str) -> str:
        made = "cast(timestamp '1996-01-01 00:00:00' as timestamp)"
        return _select({
            "id": f"cast(2 * c_custkey + {k} as bigint)",
            "campaign_id": "cast(c_custkey as bigint)",
            "margin_type": f"CASE WHEN c_custkey % 37 = 0 THEN NULL ELSE '{kind}' END",
            "network_gross_margin": f"CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE cast((c_custkey * 7 + {k} * 3) % 60 as double) / 100 END",
            "other_gross_margin": f"cast((c_custkey * 11 + {k} * 5) % 60 as double) / 100",
            "updated_at": d.add(made, f"c_custkey * 13 % 1800 + {k}", "DAY"),
        }, src("customer"), d)

    t["margins"] = margin_rows(0, "control") + "\nUNION ALL\n" + margin_rows(1, "experiment")
    t["campaign_configs"] = _select({
        "id": "cast(c_custkey as bigint)",
        "campaign_id": "cast(c_custkey as bigint)",
        "target": _pick("c_custkey", "'NR'", "'RPI'", "'disabled'", "NULL"),
        "threshold": text("c_custkey % 50"),
        "target_reasons": f"concat('reason ', {text('c_custkey % 6')})",
    }, src("customer"), d)
    created = "cast(timestamp '1995-01-01 00:00:00' as timestamp)"
    t["campaigns"] = _select({
        "id": "cast(c_custkey as bigint)",
        "customer_id": "cast(c_nationkey as bigint)",
        "crm_campaign_id": f"concat('S', {text('c_custkey')})",
        "daily_revenue_limit": "c_acctbal",
        "state": _pick("c_custkey", "'enabled'", "'paused'", "'enabled'"),
        "created_at": d.add(d.add(created, "c_custkey % 2500", "DAY"), "c_custkey % 24", "HOUR"),
        "campaign_type_id": f"cast(CASE WHEN c_custkey % 5 = 0 THEN 2 ELSE 1 END as {d.int_})",
        "current_optimization_state": _pick("c_custkey", "'cpr'", "'cpa'", "'cpi'"),
        "final_optimization_state": "CASE c_mktsegment WHEN 'BUILDING' THEN 'cpi' WHEN 'MACHINERY' THEN 'cpi-vt' ELSE 'cpa' END",
        "cpa_target_event_id": "cast(c_custkey % 5 as bigint)",
    }, src("customer"), d)
    t["customers"] = _select(
        {"id": "cast(n_nationkey as bigint)", "company": "n_name"}, src("nation"), d
    )
    located = (
        f"{src('customer')} JOIN {src('nation')} ON c_nationkey = n_nationkey "
        f"JOIN {src('region')} ON n_regionkey = r_regionkey"
    )
    t["crm_campaign_daily"] = "\nUNION ALL\n".join(
        _select({
            "dt": f"'{dt}'",
            "crm_campaign_id": f"concat('S', {text('c_custkey')})",
            "sales_region": region,
            "sales_sub_region": "n_name",
            "service_level": level,
        }, located, d)
        for dt, region, level in (
            ("2001-12-10T00:00:00Z", "'OLD'", "'old'"),
            ("2001-12-30T00:00:00Z", "r_name", "'old'"),
            ("2001-12-31T00:00:00Z", "r_name", "c_mktsegment"),
        )
    )
    return t


def warehouse(spark: SparkSession, sf_dir: str) -> Warehouse:
    """The derived tables as lazy DataFrames."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # The derived columns make long rows of code; longer methods than these the JVM never compiles.
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", "8000")

    @cache
    def source(name: str) -> DataFrame:
        return spark.read.parquet(f"{sf_dir}/{name}.parquet")

    def build(text: str) -> DataFrame:
        used = {n: source(n) for n in SOURCES if "{" + n + "}" in text}
        return spark.sql(_escape(text), **used)

    def _escape(text: str) -> str:
        # spark.sql fills {name}; braces of JSON text are doubled.
        out = text.replace("{", "{{").replace("}", "}}")
        for n in SOURCES:
            out = out.replace("{{" + n + "}}", "{" + n + "}")
        return out

    texts = table_sql(Spark(), lambda n: "{" + n + "}")
    return Warehouse({n: (lambda s=s: build(s)) for n, s in texts.items()})


@cache
def duck_tables() -> dict[str, str]:
    return table_sql(Duck(), lambda n: n)


def with_tables(names: list[str], body: str) -> str:
    """Oracle text: the named tables as CTEs before the query."""
    ctes = ",\n".join(f"{n} AS (\n{duck_tables()[n]}\n)" for n in names)
    body = body.strip()
    if body[:5].upper() == "WITH ":
        return f"WITH {ctes},\n{body[5:]}"
    return f"WITH {ctes}\n{body}"
