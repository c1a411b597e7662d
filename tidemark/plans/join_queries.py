"""Queries of window joins, table joins, state lookups and dimensions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import dimensions as D
from tidemark.operators import enrich as E
from tidemark.operators import joins as J
from tidemark.operators import windows as W
from tidemark.plans.registry import query

EV = "(SELECT event_id, epoch_us(ts) AS us, user_id, event_type, value FROM events)"


def typed(t, kind: str):
    return t.events.filter(F.col("event_type") == kind).select("event_id", "ts", "seq", "user_id", "value")


def _ids(df):
    return df.select("l_event_id", "r_event_id")


H2, H6 = 2 * 3_600_000_000, 6 * 3_600_000_000


def _pairs_sql(extra: str, select: str = "a.event_id AS l_event_id, b.event_id AS r_event_id", a="view", b="purchase", join="JOIN", key="a.user_id = b.user_id"):
    return f"""SELECT {select} FROM (SELECT * FROM {EV} WHERE event_type = '{a}') a {join}
    (SELECT * FROM {EV} WHERE event_type = '{b}') b ON {key} AND {extra}"""


WINDOWED = f"b.us - a.us < {H2} AND a.us - b.us < {H6}"
USER = [("user_id", "user_id")]


@query("jn_time", _pairs_sql(WINDOWED, "a.event_id AS l_event_id, b.event_id AS r_event_id, CASE WHEN a.us > b.us THEN 'left' ELSE 'right' END AS trigger"))
def jn_time(t):
    out = J.time_join(typed(t, "view"), typed(t, "purchase"), 2 * W.HOUR, 6 * W.HOUR, equal=USER)
    return out.select("l_event_id", "r_event_id", F.col("_trigger").alias("trigger"))


@query(
    "jn_length",
    f"""WITH m AS (SELECT *, count(*) FILTER (event_type = 'view') OVER w AS nl, count(*) FILTER (event_type = 'purchase') OVER w AS nr
    FROM {EV} WHERE event_type IN ('view', 'purchase') WINDOW w AS (ORDER BY us, event_id ROWS UNBOUNDED PRECEDING))
    SELECT a.event_id AS l_event_id, b.event_id AS r_event_id FROM m a JOIN m b ON a.event_type = 'view' AND b.event_type = 'purchase'
    AND a.user_id = b.user_id AND ((b.nr BETWEEN a.nr - 199 AND a.nr) OR (a.nl BETWEEN b.nl - 99 AND b.nl))""",
)
def jn_length(t):
    return _ids(J.length_join(typed(t, "view"), typed(t, "purchase"), 100, 200, equal=USER))


@query(
    "jn_unbounded",
    _pairs_sql("a.event_id % 50 = b.event_id % 50", "a.event_id AS l_event_id, b.event_id AS r_event_id, CASE WHEN a.us > b.us THEN 'left' ELSE 'right' END AS trigger"),
)
def jn_unbounded(t):
    """Pairs of rows with equal keys, however far apart: the second key bounds how many a row has."""
    slot = F.col("event_id") % 50
    out = J.unbounded_join(
        typed(t, "view").withColumn("slot", slot), typed(t, "purchase").withColumn("slot", slot), [*USER, ("slot", "slot")]
    )
    return out.select("l_event_id", "r_event_id", F.col("_trigger").alias("trigger"))


@query(
    "jn_partner_counts",
    _pairs_sql("true", "a.user_id AS user_id, count(*) AS n, count(*) FILTER (a.us > b.us) AS by_view") + " GROUP BY a.user_id",
)
def jn_partner_counts(t):
    """Pairs of an unbounded join grow with the square of a key's rows, so they are counted, not built."""
    found = J.partner_counts(typed(t, "view"), typed(t, "purchase"), USER)
    n, by_view = F.sum("n_partners").alias("n"), F.sum(F.when(F.col("_side") == "left", F.col("n_partners")).otherwise(0)).alias("by_view")
    out = found.groupBy(F.col("_key._k0").alias("user_id")).agg(n, by_view)
    return out.filter(F.col("n") > 0)


@query("jn_theta", _pairs_sql("abs(a.us - b.us) < 3600000000 AND a.value > b.value * 3", key="true"))
def jn_theta(t):
    return _ids(
        J.time_join(
            typed(t, "view"), typed(t, "purchase"), W.HOUR, W.HOUR,
            on=lambda left, right: left("value") > right("value") * 3,
        )
    )


@query("jn_within", _pairs_sql(f"{WINDOWED} AND abs(a.us - b.us) <= 1800000000"))
def jn_within(t):
    return _ids(
        J.time_join(typed(t, "view"), typed(t, "purchase"), 2 * W.HOUR, 6 * W.HOUR, equal=USER, within_ms=W.HOUR // 2)
    )


@query("jn_unidirectional", _pairs_sql(f"{WINDOWED} AND b.us > a.us"))
def jn_unidirectional(t):
    return _ids(
        J.time_join(typed(t, "view"), typed(t, "purchase"), 2 * W.HOUR, 6 * W.HOUR, equal=USER, unidirectional="right")
    )


@query(
    "jn_expired",
    _pairs_sql(f"b.us < a.us + {H2} AND b.us + {H6} > a.us + {H2}", f"a.event_id AS l_event_id, b.event_id AS r_event_id, 'left' AS leaving, a.us + {H2} AS at")
    + " UNION ALL "
    + _pairs_sql(f"a.us < b.us + {H6} AND a.us + {H2} > b.us + {H6}", f"a.event_id, b.event_id, 'right', b.us + {H6}"),
)
def jn_expired(t):
    out = J.expired_pairs(typed(t, "view"), typed(t, "purchase"), 2 * W.HOUR, 6 * W.HOUR, equal=USER)
    return out.select("l_event_id", "r_event_id", F.col("_leaving").alias("leaving"), F.col("_at").alias("at"))


@query("jn_outer_left", _pairs_sql(WINDOWED, join="LEFT JOIN"))
def jn_outer_left(t):
    return _ids(J.time_join(typed(t, "view"), typed(t, "purchase"), 2 * W.HOUR, 6 * W.HOUR, equal=USER, how="left"))


@query("jn_outer_right", _pairs_sql(WINDOWED, join="RIGHT JOIN"))
def jn_outer_right(t):
    return _ids(J.time_join(typed(t, "view"), typed(t, "purchase"), 2 * W.HOUR, 6 * W.HOUR, equal=USER, how="right"))


@query("jn_outer", _pairs_sql(WINDOWED, join="FULL JOIN"))
def jn_outer(t):
    return _ids(J.time_join(typed(t, "view"), typed(t, "purchase"), 2 * W.HOUR, 6 * W.HOUR, equal=USER, how="full"))


@query("jn_outer_unidirectional", _pairs_sql(f"{WINDOWED} AND (b.us > a.us OR (b.us = a.us AND b.event_id > a.event_id))", join="LEFT JOIN"))
def jn_outer_unidirectional(t):
    args = {"equal": USER, "how": "left", "unidirectional": "right"}
    return _ids(J.time_join(typed(t, "view"), typed(t, "purchase"), 2 * W.HOUR, 6 * W.HOUR, **args))


@query(
    "jn_table",
    """SELECT event_id AS l_event_id, c_name AS r_c_name FROM events JOIN customer ON user_id = c_custkey
    WHERE event_type = 'purchase' AND value * 100 > c_acctbal""",
)
def jn_table(t):
    table = t.customer.select("c_custkey", "c_name", "c_acctbal")
    out = J.table_join(
        typed(t, "purchase"), table, [("user_id", "c_custkey")],
        on=lambda s, c: s("value") * 100 > c("c_acctbal"),
    )
    return out.select("l_event_id", "r_c_name")


@query("jn_self", _pairs_sql("b.us > a.us AND b.us - a.us < 7200000000", a="error", b="error"))
def jn_self(t):
    errors = typed(t, "error")
    out = J.time_join(errors, errors, 2 * W.HOUR, 2 * W.HOUR, equal=USER, on=lambda a, b: b("event_id") > a("event_id"))
    return _ids(out)


# --- lookups ------------------------------------------------------------------------------

ASOF = f"""(SELECT a.event_id, a.user_id, a.us, CASE WHEN b.us > a.us - 86400000000 THEN b.event_id END AS s_id,
 CASE WHEN b.us > a.us - 86400000000 THEN b.value END AS s_value FROM (SELECT * FROM {EV} WHERE event_type = 'view') a
 ASOF LEFT JOIN (SELECT * FROM {EV} WHERE event_type = 'signup') b ON a.user_id = b.user_id AND a.us >= b.us)"""


def signup_state(t):
    return typed(t, "signup").select("ts", "seq", F.col("user_id").alias("client_mac"), F.col("event_id").alias("s_id"), F.col("value").alias("s_value"))


@query("jn_enrich", f"SELECT event_id, s_id, s_value FROM {ASOF}")
def jn_enrich(t):
    out = E.lookup(typed(t, "view"), signup_state(t), "user_id", "client_mac", ["s_id", "s_value"], ttl_ms=W.DAY)
    return out.select("event_id", "s_id", "s_value")


@query(
    "jn_enrich_default",
    f"""SELECT event_id, coalesce(CASE WHEN s_value > 20 THEN 'good' WHEN s_id IS NOT NULL THEN 'bad' END, 'unknown') AS client_rssi,
    coalesce(CAST(s_id AS INTEGER), 0) AS client_rssi_num FROM {ASOF}""",
)
def jn_enrich_default(t):
    state = signup_state(t).select(
        "ts", "seq", "client_mac",
        F.when(F.col("s_value") > 20, "good").otherwise("bad").alias("client_rssi"),
        F.col("s_id").cast("int").alias("client_rssi_num"),
        F.lit("good").alias("client_snr"),
        F.lit(30).alias("client_snr_num"),
    )
    out = E.trap_lookup(typed(t, "view"), state, key="user_id", ttl_ms=W.DAY)
    return out.select("event_id", "client_rssi", "client_rssi_num")


@query(
    "jn_enrich_status",
    f"SELECT event_id, s_id, CASE WHEN s_id IS NULL THEN 'PROBING' ELSE 'POWERSAVE' END AS v10, CASE WHEN s_id IS NOT NULL THEN 'ASSOCIATED' END AS v8 FROM {ASOF}",
)
def jn_enrich_status(t):
    state = signup_state(t).withColumn("dot11_status", F.lit("POWERSAVE"))
    views = typed(t, "view")
    ten = E.location_lookup(views, state, ["s_id", "dot11_status"], key="user_id", v10=True, ttl_ms=W.DAY)
    ten = ten.select("event_id", "ts", "seq", "user_id", F.col("dot11_status").alias("v10"))
    eight = E.location_lookup(ten, state, ["s_id"], key="user_id", ttl_ms=W.DAY)
    return eight.select("event_id", "s_id", "v10", F.col("dot11_status").alias("v8"))


@query(
    "jn_enrich_project",
    f"""WITH s AS (SELECT us, user_id, 'ap' || event_id AS wireless_station FROM {EV} WHERE event_type = 'signup'),
    v AS (SELECT event_id, us, user_id AS ethsrc, (user_id * 7) % 100 AS ethdst FROM {EV} WHERE event_type = 'view')
    SELECT v.event_id, coalesce(CASE WHEN d.us > v.us - 86400000000 THEN d.wireless_station END, CASE WHEN c.us > v.us - 86400000000 THEN c.wireless_station END) AS wireless_station
    FROM v ASOF LEFT JOIN s c ON v.ethsrc = c.user_id AND v.us >= c.us ASOF LEFT JOIN s d ON v.ethdst = d.user_id AND v.us >= d.us""",
)
def jn_enrich_project(t):
    state = signup_state(t).withColumn("wireless_station", F.concat(F.lit("ap"), F.col("s_id")))
    rows = typed(t, "view").select("event_id", "ts", "seq", F.col("user_id").alias("ethsrc"), ((F.col("user_id") * 7) % 100).alias("ethdst"))
    out = E.endpoint_lookup(rows, state, ["wireless_station"], ttl_ms=W.DAY)
    return out.select("event_id", "wireless_station")


MOBILE_SQL = f"""s AS (SELECT us, CASE event_type WHEN 'signup' THEN 'ip' || user_id WHEN 'click' THEN 'id' || (user_id % 40) ELSE '/p' || (user_id % 20) END AS key,
    CASE WHEN event_type = 'signup' THEN 'id' || (event_id % 40) END AS client_id, CASE WHEN event_type = 'click' THEN '/p' || (event_id % 20) END AS path,
    CASE WHEN event_type = 'error' THEN 'cell' || event_id END AS wireless_station FROM {EV} WHERE event_type IN ('signup', 'click', 'error')),
    f AS (SELECT event_id, us, 'ip' || user_id AS src, 'ip' || ((user_id * 3) % 100) AS dst FROM {EV} WHERE event_type = 'view')"""


@query(
    "jn_enrich_chain",
    f"""WITH {MOBILE_SQL}, g AS (SELECT f.event_id, f.us, coalesce(CASE WHEN d.us > f.us - 86400000000 THEN d.client_id END, CASE WHEN c.us > f.us - 86400000000 THEN c.client_id END) AS client_id
    FROM f ASOF LEFT JOIN s c ON f.src = c.key AND f.us >= c.us ASOF LEFT JOIN s d ON f.dst = d.key AND f.us >= d.us),
    h AS (SELECT g.*, CASE WHEN s.us > g.us - 86400000000 THEN s.path END AS path FROM g ASOF LEFT JOIN s ON g.client_id = s.key AND g.us >= s.us)
    SELECT h.event_id, h.client_id, h.path, CASE WHEN s.us > h.us - 86400000000 THEN s.wireless_station END AS wireless_station FROM h ASOF LEFT JOIN s ON h.path = s.key AND h.us >= s.us""",
)
def jn_enrich_chain(t):
    e, kind, uid = t.events, F.col("event_type"), F.col("user_id")
    key = (
        F.when(kind == "signup", F.concat(F.lit("ip"), uid))
        .when(kind == "click", F.concat(F.lit("id"), uid % 40))
        .otherwise(F.concat(F.lit("/p"), uid % 20))
    )
    none = F.lit(None).cast("string")
    state = e.filter(kind.isin("signup", "click", "error")).select(
        "ts", "seq", key.alias("key"),
        F.when(kind == "signup", F.concat(F.lit("id"), F.col("event_id") % 40)).alias("client_id"),
        F.when(kind == "click", F.concat(F.lit("/p"), F.col("event_id") % 20)).alias("path"),
        F.when(kind == "error", F.concat(F.lit("cell"), F.col("event_id"))).alias("wireless_station"),
        *[none.alias(c) for c in ("wireless_id", "rat", "msisdn", "hnblocation", "hnbgeolocation")],
    )
    flows = typed(t, "view").select(
        "event_id", "ts", "seq", F.concat(F.lit("ip"), uid).alias("src"), F.concat(F.lit("ip"), (uid * 3) % 100).alias("dst")
    )
    out = E.mobile_chain(flows, state, ttl_ms=W.DAY)
    return out.select("event_id", "client_id", "path", "wireless_station")


# --- dimensions ---------------------------------------------------------------------------


@query(
    "jn_dim_mac",
    """SELECT event_id, n_name AS client_mac_vendor FROM events LEFT JOIN nation ON n_nationkey = user_id % 64""",
)
def jn_dim_mac(t):
    vendors = t.nation.select(
        F.concat(F.lit("00AB"), F.lpad(F.hex("n_nationkey"), 2, "0")).alias("oui"), F.col("n_name").alias("vendor")
    )
    mac = F.concat(F.lit("00-ab-"), F.lpad(F.lower(F.hex(F.col("user_id") % 64)), 2, "0"), F.lit("-01-02-03"))
    return D.mac_vendor(t.events.select("event_id", mac.alias("client_mac")), vendors).select("event_id", "client_mac_vendor")


@query(
    "jn_dim_geoip",
    """SELECT event_id, s.n_name AS src_country_code, d.n_name AS dst_country_code, CASE WHEN s.n_nationkey IS NOT NULL THEN 'Net ' || s.n_nationkey END AS src_as_name
    FROM events LEFT JOIN nation s ON s.n_nationkey = user_id % 30 LEFT JOIN nation d ON d.n_nationkey = event_id % 40""",
)
def jn_dim_geoip(t):
    key = F.col("n_nationkey")
    v4 = t.nation.select(
        F.concat_ws(".", key + 10, F.lit("0.0.0")).alias("first"), F.concat_ws(".", key + 10, F.lit("255.255.255")).alias("last"),
        F.col("n_name").alias("country"), F.concat(F.lit("AS"), key, F.lit(" Net "), key).alias("info"),
    )
    v6 = t.nation.select(
        F.concat(F.lit("2001:"), F.lower(F.hex(key + 16)), F.lit("::")).alias("first"),
        F.concat(F.lit("2001:"), F.lower(F.hex(key + 16)), F.lit(":ffff:ffff:ffff:ffff:ffff:ffff")).alias("last"),
        F.col("n_name").alias("country"), F.concat(F.lit("AS"), key, F.lit(" Net "), key).alias("info"),
    )
    both = v4.unionByName(v6)
    flows = t.events.select(
        "event_id",
        F.concat_ws(".", F.col("user_id") % 30 + 10, F.lit(3), F.col("event_id") % 256, F.lit(9)).alias("src"),
        F.concat(F.lit("2001:"), F.lower(F.hex(F.col("event_id") % 40 + 16)), F.lit(":0:0:1::7")).alias("dst"),
    )
    out = D.geoip(flows, both.select("first", "last", "country"), both.select("first", "last", "info"))
    return out.select("event_id", "src_country_code", "dst_country_code", "src_as_name")


AP_SQL = """(SELECT s_suppkey AS id, CASE WHEN s_suppkey % 9 <> 0 THEN 'ap' || s_suppkey END AS mac_address, s_acctbal, s_suppkey % 40 AS sensor_id FROM supplier)"""


def ap_tables(t):
    points = t.supplier.select(
        F.col("s_suppkey").alias("id"),
        F.when(F.col("s_suppkey") % 9 != 0, F.concat(F.lit("ap"), F.col("s_suppkey"))).alias("mac_address"),
        F.when(F.col("s_acctbal") > 0, F.floor(F.col("s_acctbal")) + 0.25).cast("string").alias("latitude"),
        F.lit("1.5").alias("longitude"),
        (F.col("s_suppkey") % 40).alias("sensor_id"),
    )
    floors = t.nation.select(F.col("n_nationkey").alias("id"), (F.col("n_regionkey") + 100).alias("parent_id"), F.col("n_name").alias("name"))
    buildings = t.region.select((F.col("r_regionkey") + 100).alias("id"), F.lit(200).alias("parent_id"), F.col("r_name").alias("name"))
    campus = t.region.filter("r_regionkey = 0").select(F.lit(200).alias("id"), F.lit(None).cast("int").alias("parent_id"), F.lit("main").alias("name"))
    point_zones = t.customer.select((F.col("c_custkey") % 150).alias("access_point_id"), F.col("c_nationkey").alias("zone_id"))
    zones = t.nation.select(F.col("n_nationkey").alias("id"), F.concat(F.lit("zone "), F.col("n_name")).alias("name"))
    return points, floors.unionByName(buildings).unionByName(campus), point_zones, zones


AP_LOCATIONS = f"""(SELECT mac_address, CASE WHEN s_acctbal > 0 THEN CAST(floor(s_acctbal) + 0.25 AS VARCHAR) || ',1.5' END AS client_latlong,
    CASE WHEN r_name IS NULL THEN 'unknown' ELSE 'main' END AS client_campus, coalesce(r_name, 'unknown') AS client_building,
    coalesce(f.n_name, 'unknown') AS client_floor, coalesce('zone ' || z.n_name, 'unknown') AS client_zone
    FROM {AP_SQL} p LEFT JOIN nation f ON f.n_nationkey = p.sensor_id LEFT JOIN region ON r_regionkey = f.n_regionkey
    LEFT JOIN (SELECT c_custkey % 150 AS ap, min(c_nationkey) AS z FROM customer GROUP BY 1) pz ON pz.ap = p.id
    LEFT JOIN nation z ON z.n_nationkey = pz.z WHERE mac_address IS NOT NULL)"""


@query("src_jdbc_lookup", f"SELECT * FROM {AP_LOCATIONS}")
def src_jdbc_lookup(t):
    return D.access_points(*ap_tables(t))


@query(
    "jn_dim_ap",
    f"SELECT event_id, client_building, client_zone FROM events LEFT JOIN {AP_LOCATIONS} a ON a.mac_address = 'ap' || (user_id % 200)",
)
def jn_dim_ap(t):
    rows = t.events.select("event_id", F.concat(F.lit("ap"), F.col("user_id") % 200).alias("wireless_station"))
    return D.access_point(rows, D.access_points(*ap_tables(t))).select("event_id", "client_building", "client_zone")


@query(
    "jn_darklist",
    """WITH d AS (SELECT s_suppkey AS ip, CAST(trunc(s_acctbal / 100) AS INTEGER) AS score, 'n' || s_nationkey AS name, 'c' || (s_suppkey % 5) AS category, 'p' || (s_suppkey % 3) AS protocol FROM supplier),
    e AS (SELECT event_id, user_id AS src, event_id % 120 AS dst FROM events)
    SELECT event_id, coalesce(a.score, 0) AS darklist_score_src, coalesce(b.score, 0) AS darklist_score_dst,
    CASE WHEN a.ip IS NOT NULL AND (b.ip IS NULL OR a.score > b.score) THEN a.score WHEN b.ip IS NOT NULL THEN b.score ELSE 0 END AS darklist_score,
    CASE WHEN a.ip IS NOT NULL AND (b.ip IS NULL OR a.score > b.score) THEN a.name WHEN b.ip IS NOT NULL THEN b.name ELSE 'clean' END AS darklist_score_name,
    CASE WHEN a.ip IS NOT NULL AND b.ip IS NOT NULL THEN a.category || '/' || b.category ELSE coalesce(a.category, b.category, 'clean') END AS darklist_category,
    CASE WHEN a.ip IS NOT NULL AND b.ip IS NOT NULL THEN a.protocol || '/' || b.protocol ELSE coalesce(a.protocol, b.protocol, 'clean') END AS darklist_protocol,
    coalesce(a.category, 'clean') AS darklist_category_src, coalesce(b.category, 'clean') AS darklist_category_dst,
    CASE WHEN a.ip IS NOT NULL AND b.ip IS NOT NULL THEN 'both' WHEN a.ip IS NOT NULL THEN 'source' WHEN b.ip IS NOT NULL THEN 'destination' ELSE 'clean' END AS darklist_direction
    FROM e LEFT JOIN d a ON e.src = a.ip LEFT JOIN d b ON e.dst = b.ip""",
)
def jn_darklist(t):
    key = F.col("s_suppkey")
    table = t.supplier.select(
        key.cast("string").alias("ip"), (F.col("s_acctbal") / 100).cast("string").cast("double").alias("darklist_score"),
        F.concat(F.lit("n"), F.col("s_nationkey")).alias("darklist_score_name"),
        F.concat(F.lit("c"), key % 5).alias("darklist_category"), F.concat(F.lit("p"), key % 3).alias("darklist_protocol"),
    )
    rows = t.events.select("event_id", F.col("user_id").cast("string").alias("src"), (F.col("event_id") % 120).cast("string").alias("dst"))
    return E.reputation(rows, table).drop("src", "dst", "darklist_protocol_src", "darklist_protocol_dst")
