"""Queries of message sources, record transforms, roll-ups and message sinks.

Messages are built by Spark from the rows of the given tables, then parsed and
transformed like messages from a topic; the SQL twin computes the result from
the same rows directly.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import records as R
from tidemark.operators import rollup as U
from tidemark.plans.registry import query
from tidemark.sources import messages as msg
from tidemark.sources import schemas

C = F.col


def now():
    return F.lit(1_706_745_600).cast("bigint")


NOW_SQL = "1706745600"
SEC = "CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT)"


def text(template: str, *cols):
    return F.format_string(template, *cols)


# --- sources and sinks ----------------------------------------------------------------------


def props_messages(t):
    broken = F.substring("props", 1, 5)
    return t.events.select(
        "event_id",
        F.when(C("event_id") % 10 == 0, broken).when(C("event_id") % 10 == 1, F.lit("")).otherwise(C("props")).alias("value"),
    )


@query("src_json", "SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events WHERE event_id % 10 > 1")
def src_json(t):
    good, _ = msg.parse_json(props_messages(t), "value", "struct<k:bigint>")
    return good.select("event_id", "record.k")


@query("src_json_rejected", "SELECT event_id, substr(props, 1, 5) AS value FROM events WHERE event_id % 10 = 0")
def src_json_rejected(t):
    _, rejected = msg.parse_json(props_messages(t), "value", "struct<k:bigint>")
    return rejected.select("event_id", "value")


def xml_messages(t):
    kind, uid, eid = C("event_type"), C("user_id"), C("event_id")
    feed = (
        "<feed path='/s/%s' type='add' id='1'><segment><imsi>9%s</imsi><apn>web</apn><msisdn>5%s</msisdn>"
        "<ipAddress>10.0.0.%s</ipAddress><rat>EUTRAN</rat></segment></feed>"
    )
    cell = "<feed path='/h/%s' type='add'><hnb><hnbid>cell%s</hnbid><location>room %s</location></hnb></feed>"
    note = "<notify path='/n/%s' type='add'><imsi>9%s</imsi></notify>"
    gone = "<feed path='/s/%s' type='remove'><segment><ipAddress>10.0.0.1</ipAddress></segment></feed>"
    value = (
        F.when(kind == "signup", text(feed, eid, uid, uid, uid))
        .when(kind == "view", text(cell, eid, uid, uid))
        .when(kind == "click", text(note, eid, uid))
        .when(kind == "error", text(gone, eid))
        .otherwise(F.lit("<feed path='x' type='add'><segment>"))
    )
    return t.events.select("event_id", value.alias("value"))


@query(
    "src_xml_mobile",
    """SELECT event_id, CASE event_type WHEN 'signup' THEN '10.0.0.' || user_id WHEN 'view' THEN '/h/' || event_id ELSE '9' || user_id END AS key,
    CASE WHEN event_type = 'signup' THEN '9' || user_id END AS client_id, CASE WHEN event_type = 'view' THEN 'cell' || user_id END AS wireless_station,
    CASE WHEN event_type = 'view' THEN 'room ' || user_id END AS hnblocation, CASE WHEN event_type = 'click' THEN '/n/' || event_id END AS path,
    CASE WHEN event_type = 'signup' THEN 'EUTRAN' END AS rat FROM events WHERE event_type IN ('signup', 'view', 'click')""",
)
def src_xml_mobile(t):
    return msg.parse_mobile(xml_messages(t)).select("event_id", "key", "client_id", "wireless_station", "hnblocation", "path", "rat")


@query(
    "src_kafka_kv",
    "SELECT event_id, map([CAST(user_id AS VARCHAR)], [event_type])::VARCHAR AS entry FROM events",
)
def src_kafka_kv(t):
    from tidemark.sources.kafka import key_value_map

    raw = t.events.select("event_id", C("user_id").cast("string").cast("binary").alias("key"), C("event_type").cast("binary").alias("value"))
    entry = key_value_map(raw, keep=["event_id"])
    pairs = F.map_entries("entry")
    return entry.select("event_id", F.concat(F.lit("{"), pairs[0]["key"], F.lit("="), pairs[0]["value"], F.lit("}")).alias("entry"))


@query(
    "snk_json",
    """SELECT '{"event_id":' || event_id || ',"event_type":"' || event_type || '","user_id":' || user_id || '}' AS value FROM events""",
)
def snk_json(t):
    return msg.to_messages(t.events.select("event_id", "event_type", "user_id"))


@query(
    "snk_kafka",
    """SELECT 'flow_post' AS topic, '{"event_id":' || event_id || '}' AS value FROM events""",
)
def snk_kafka(t):
    return msg.to_messages(t.events.select("event_id"), "flow_post")


@query(
    "snk_kafka_route",
    """SELECT 'alarm_' || event_type AS topic, '{"event_id":' || event_id || '}' AS value FROM events WHERE event_type IN ('error', 'purchase')""",
)
def snk_kafka_route(t):
    own = F.when(C("event_type").isin("error", "purchase"), F.concat(F.lit("alarm_"), C("event_type")))
    return msg.to_messages(t.events.select("event_id", own.alias("topic")), route="topic")


# --- records --------------------------------------------------------------------------------


def trap_messages(t):
    uid, eid = C("user_id"), C("event_id")
    record = F.struct(
        F.concat(F.lit("x/00:"), uid).alias(schemas.TRAP_CLIENT),
        (-(uid % 100)).cast("int").alias(schemas.TRAP_RSSI),
        F.when(eid % 3 != 0, eid % 50).cast("int").alias(schemas.TRAP_SNR),
        F.lit("net").alias(schemas.TRAP_SSID),
        F.concat(F.lit(" AA BB "), uid, F.lit(" ")).alias(schemas.TRAP_STATION),
        F.when(eid % 4 == 0, F.lit("Campus - House - Floor 1")).when(eid % 4 == 1, F.lit("House-Floor 2"))
        .when(eid % 4 == 2, F.lit(" House ")).alias(schemas.TRAP_LOCATION),
        F.concat(F.lit("UDP: [10.0.0."), uid, F.lit("]:162")).alias("host"),
        F.when(eid % 2 == 0, F.unix_seconds("ts").cast("string")).alias("timestamp"),
    )
    return t.events.select("event_id", F.to_json(record).alias("value"))


@query(
    "trf_trap",
    f"""WITH e AS (SELECT *, -(user_id % 100) AS rssi, CASE WHEN event_id % 3 <> 0 THEN event_id % 50 END AS snr FROM events)
    SELECT event_id, '00:' || user_id AS client_mac,
    CASE WHEN rssi = 0 THEN 'unknown' WHEN rssi <= -85 THEN 'bad' WHEN rssi <= -80 THEN 'low' WHEN rssi <= -70 THEN 'medium' WHEN rssi <= -60 THEN 'good' ELSE 'excelent' END AS client_rssi,
    CAST(coalesce(snr, 0) AS INTEGER) AS client_snr_num, 'aa:bb:' || user_id AS wireless_station,
    CASE WHEN event_id % 4 = 0 THEN 'Campus' END AS client_campus, CASE WHEN event_id % 4 <> 3 THEN 'House' END AS client_building,
    CASE event_id % 4 WHEN 0 THEN 'Floor 1' WHEN 1 THEN 'Floor 2' END AS client_floor, 'trap:10.0.0.' || user_id AS sensor_name,
    CASE WHEN event_id % 2 = 0 THEN {SEC} ELSE {NOW_SQL} END AS timestamp FROM e""",
)
def trf_trap(t):
    good, _ = msg.parse_json(trap_messages(t), "value", schemas.TRAP)
    return R.trap(good, now()).select(
        "event_id", "client_mac", "client_rssi", "client_snr_num", "wireless_station", "client_campus",
        "client_building", "client_floor", "sensor_name", "timestamp",
    )


def location_messages(t):
    uid, eid = C("user_id"), C("event_id")
    value = text(
        '{"StreamingNotification":{"subscriptionName":"wlc","timestamp":"%s","location":{"macAddress":"m%s",'
        '"%s":{"mapHierarchyString":"C%s>B>%s"},"dot11Status":"%s","ssId":"net","apMacAddress":"ap%s",'
        '"ipAddress":["10.0.0.%s"],"geoCoordinate":{"lattitude":%s.123456,"longitude":2.5}}}}',
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'"), uid, F.when(eid % 2 == 0, "MapInfo").otherwise("mapInfo"),
        uid % 4, C("event_type"), F.when(eid % 3 == 0, "ASSOCIATED").otherwise("PROBING"), uid, uid, uid % 50,
    )
    return t.events.select("event_id", "ts", "seq", value.alias("value"))


@query(
    "trf_mse",
    f"""SELECT event_id, 'm' || user_id AS client_mac, 'C' || (user_id % 4) AS client_campus, 'B' AS client_building, event_type AS client_floor,
    CASE WHEN event_id % 3 = 0 THEN 'ap' || user_id END AS wireless_station, CASE WHEN event_id % 3 = 0 THEN '10.0.0.' || user_id END AS src,
    CAST(user_id % 50 AS VARCHAR) || '.12346,2.5' AS client_latlong, {SEC} AS timestamp, 'mse' AS type FROM events""",
)
def trf_mse(t):
    good, _ = msg.parse_json(location_messages(t), "value", schemas.LOCATION)
    return R.location(good, now()).select(
        "event_id", "client_mac", "client_campus", "client_building", "client_floor", "wireless_station", "src",
        "client_latlong", "timestamp", "type",
    )


def v10_messages(t):
    uid, eid = C("user_id"), C("event_id")
    value = text(
        '{"notifications":[{"notificationType":"association","deviceId":"m%s","subscriptionName":"wlc","timestamp":%s,"ssid":"net",'
        '"band":"b","status":%s,"apMacAddress":"ap%s","username":"%s"},{"notificationType":"locationupdate","deviceId":"m%s",'
        '"subscriptionName":"wlc","timestamp":%s,"locationMapHierarchy":"C>B%s>F"},{"notificationType":"other","deviceId":"z"}]}',
        uid, F.unix_millis("ts"), F.when(eid % 12 == 9, 256).when(eid % 12 == 10, 257).otherwise(eid % 12), uid,
        F.when(uid % 2 == 0, F.concat(F.lit("u"), uid)).otherwise(""), uid, F.unix_millis("ts"), uid % 3,
    )
    return msg.parse_json(t.events.select("event_id", value.alias("value")), "value", schemas.LOCATION)[0]


@query(
    "trf_mse10_split",
    "SELECT event_id, k AS kind, 'm' || user_id AS device FROM events CROSS JOIN (VALUES ('association'), ('locationupdate')) v(k)",
)
def trf_mse10_split(t):
    parts = R.v10_split(v10_messages(t))
    return parts[0].unionByName(parts[1]).select(
        "event_id", C("record.notificationType").alias("kind"), C("record.deviceId").alias("device")
    )


@query(
    "trf_mse10_assoc",
    f"""SELECT event_id, 'm' || user_id AS client_mac, CASE WHEN user_id % 2 = 0 THEN 'u' || user_id END AS client_id,
    CASE event_id % 12 WHEN 0 THEN 'IDLE' WHEN 1 THEN 'AAA_PENDING' WHEN 2 THEN 'AUTHENTICATED' WHEN 3 THEN 'ASSOCIATED' WHEN 4 THEN 'POWERSAVE'
    WHEN 5 THEN 'DISASSOCIATED' WHEN 6 THEN 'TO_BE_DELETED' WHEN 7 THEN 'PROBING' WHEN 8 THEN 'BLACK_LISTED' WHEN 9 THEN 'WAIT_AUTHENTICATED'
    WHEN 10 THEN 'WAIT_ASSOCIATED' END AS dot11_status, {SEC} AS timestamp, 'mse10' AS type FROM events""",
)
def trf_mse10_assoc(t):
    rows, _ = R.v10_split(v10_messages(t))
    return R.v10_association(rows).select("event_id", "client_mac", "client_id", "dot11_status", "timestamp", "type")


@query(
    "trf_mse10_update",
    f"""SELECT event_id, 'm' || user_id AS client_mac, 'C' AS client_campus, 'B' || (user_id % 3) AS client_building, 'F' AS client_floor,
    CAST(NULL AS VARCHAR) AS client_zone, {SEC} AS timestamp FROM events""",
)
def trf_mse10_update(t):
    _, rows = R.v10_split(v10_messages(t))
    return R.v10_update(rows, now()).select(
        "event_id", "client_mac", "client_campus", "client_building", "client_floor", "client_zone", "timestamp"
    )


def radius_messages(t):
    uid, eid = C("user_id"), C("event_id")
    value = text(
        '{%s"Calling-Station-Id":"aa-%s","Called-Station-Id":"%s","NAS-Identifier":"nas"%s}',
        F.when(eid % 13 != 0, F.concat(F.lit('"timestamp":'), F.unix_seconds("ts"), F.lit(","))).otherwise(""),
        uid,
        F.when(eid % 2 == 0, F.concat(F.lit("bb-"), eid % 9, F.lit(":net"))).otherwise("bad"),
        F.when(eid % 3 == 0, F.concat(F.lit(',"User-Name":"u'), eid % 5, F.lit('"'))).otherwise(""),
    )
    return msg.parse_json(t.events.select("event_id", "ts", "seq", value.alias("value")), "value", schemas.RADIUS)[0]


RADIUS_SQL = f"""(SELECT event_id, epoch_us(ts) AS us, 'aa:' || user_id AS client_mac, CASE WHEN event_id % 2 = 0 THEN 'bb:' || (event_id % 9) END AS wireless_station,
    CASE WHEN event_id % 2 = 0 THEN 'net' END AS wireless_id, CASE WHEN event_id % 3 = 0 THEN 'u' || (event_id % 5) END AS client_id, {SEC} AS timestamp
    FROM events WHERE event_id % 13 <> 0)"""


@query("trf_radius", f"SELECT event_id, client_mac, wireless_station, wireless_id, client_id, timestamp FROM {RADIUS_SQL}")
def trf_radius(t):
    return R.radius(radius_messages(t)).select(
        "event_id", "client_mac", "wireless_station", "wireless_id", "client_id", "timestamp"
    )


@query(
    "trf_radius_merge",
    f"""WITH g AS (SELECT *, CASE WHEN us - lag(us) OVER (PARTITION BY client_mac ORDER BY us) < 43200000000 THEN 0 ELSE 1 END AS opens FROM {RADIUS_SQL}),
    s AS (SELECT *, sum(opens) OVER (PARTITION BY client_mac ORDER BY us ROWS UNBOUNDED PRECEDING) AS spell FROM g)
    SELECT event_id, last_value(wireless_station IGNORE NULLS) OVER w AS wireless_station, last_value(client_id IGNORE NULLS) OVER w AS client_id
    FROM s WINDOW w AS (PARTITION BY client_mac, spell ORDER BY us ROWS UNBOUNDED PRECEDING)""",
)
def trf_radius_merge(t):
    rows = R.radius(radius_messages(t))
    out = R.fill_from_state(rows, ["wireless_station", "wireless_id", "client_id"], ttl_ms=43_200_000)
    return out.select("event_id", "wireless_station", "client_id")


@query(
    "trf_key",
    "SELECT event_id, 'aa:' || user_id AS radius_key, 'm' || user_id AS location_key FROM events WHERE event_id % 13 <> 0",
)
def trf_key(t):
    loc, _ = msg.parse_json(location_messages(t), "value", schemas.LOCATION)
    location = R.location(loc, now()).select("event_id", C("client_mac").alias("location_key"))
    own = radius_messages(t).filter(C("record.timestamp").isNotNull())
    keys = own.select("event_id", R.client_key(C("record.Calling-Station-Id")).alias("radius_key"))
    return keys.join(location, "event_id")


def nmsp_messages(t):
    uid, eid = C("user_id"), C("event_id")
    value = text(
        '{"sensor_name":"s","type":"%s","enrichment":{"e":"x"},"data":[{"client_mac":"m%s","ap_mac":["ap0","ap%s","ap5"],'
        '"rssi":[%s,%s,-70],"vlan_id":%s,"wireless_station":"ap%s"}]}',
        F.when(C("event_type") == "signup", "Info").otherwise("measure"), uid, eid % 4 + 1, -(eid % 90), -(uid % 90),
        uid % 7, eid % 6,
    )
    return msg.parse_json(t.events.select("event_id", "ts", "seq", value.alias("value")), "value", schemas.NMSP)[0]


@query(
    "trf_nmsp_data",
    """SELECT event_id, 'm' || user_id AS client_mac, CASE WHEN event_type = 'signup' THEN 'nmsp-info' ELSE 'nmsp-measure' END AS type FROM events""",
)
def trf_nmsp_data(t):
    measures, infos = R.nmsp_rows(nmsp_messages(t))
    return measures.unionByName(infos).select("event_id", "client_mac", "type")


@query(
    "trf_nmsp_info",
    f"""SELECT event_id, 'm' || user_id AS client_mac, CAST(user_id % 7 AS INTEGER) AS src_vlan, 'ap' || (event_id % 6) AS wireless_station, CAST({NOW_SQL} AS BIGINT) AS timestamp
    FROM events WHERE event_type = 'signup'""",
)
def trf_nmsp_info(t):
    _, infos = R.nmsp_rows(nmsp_messages(t))
    return R.nmsp_info(infos, now()).select("event_id", "client_mac", "src_vlan", "wireless_station", "timestamp")


@query(
    "trf_nmsp_measure",
    """WITH s AS (SELECT epoch_us(ts) AS us, user_id, 'ap' || (event_id % 6) AS known FROM events WHERE event_type = 'signup'),
    m AS (SELECT event_id, epoch_us(ts) AS us, user_id, ['ap0', 'ap' || (event_id % 4 + 1), 'ap5'] AS ap, [-(event_id % 90), -(user_id % 90), -70] AS rssi FROM events WHERE event_type <> 'signup'),
    j AS (SELECT m.*, CASE WHEN s.us > m.us - 86400000000 THEN known END AS known FROM m ASOF LEFT JOIN s ON m.user_id = s.user_id AND m.us >= s.us),
    k AS (SELECT *, list_max(rssi) AS best, known IS NOT NULL AND list_contains(ap, known) AS kept FROM j)
    SELECT event_id, CASE WHEN kept THEN known ELSE ap[list_position(rssi, best)] END AS wireless_station,
    CAST(CASE WHEN kept THEN rssi[list_position(ap, known)] ELSE best END AS INTEGER) AS client_rssi_num,
    CASE WHEN kept THEN 'ASSOCIATED' ELSE 'PROBING' END AS dot11_status FROM k""",
)
def trf_nmsp_measure(t):
    from tidemark.operators import enrich as E

    measures, infos = R.nmsp_rows(nmsp_messages(t))
    state = infos.select("ts", "seq", "client_mac", "wireless_station").withColumn("dot11_status", F.lit("ASSOCIATED"))
    rows = measures.select("event_id", "ts", "seq", "client_mac", "ap_mac", "rssi", "sensor_name", "enrichment", "type")
    known = {"known_wireless_station": "wireless_station", "known_dot11_status": "dot11_status"}
    seen = E.lookup(rows, state, "client_mac", "client_mac", known, ttl_ms=86_400_000)
    out = R.nmsp_measure(seen, now(), list(known))
    return out.select("event_id", "wireless_station", "client_rssi_num", "dot11_status")


def placed(t):
    uid, eid = C("user_id"), C("event_id")
    return t.events.select(
        "event_id", "ts", "seq", uid.alias("client_mac"), C("event_type").alias("client_floor"), F.lit("B").alias("client_building"),
        F.concat(F.lit("C"), F.floor(eid / 1000) % 3).alias("client_campus"),
        F.when(eid % 4 != 0, F.concat(F.lit("ap"), eid % 2)).alias("wireless_station"),
    )


@query(
    "trf_move_mse",
    """WITH p AS (SELECT event_id, user_id, epoch_us(ts) AS us, event_type AS floor, 'C' || ((event_id // 1000) % 3) AS campus,
    coalesce(CASE WHEN event_id % 4 <> 0 THEN 'ap' || (event_id % 2) END, 'unknown') AS ap FROM events),
    q AS (SELECT *, lag(floor) OVER w AS of, lag(campus) OVER w AS oc, lag(ap) OVER w AS oa, coalesce(us - lag(us) OVER w < 86400000000, false) AS known FROM p WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
    SELECT event_id, CASE WHEN known AND of <> floor THEN of END AS client_floor_old, CASE WHEN NOT known OR of <> floor THEN floor END AS client_floor_new,
    CASE WHEN known AND of = floor THEN floor END AS client_floor, CASE WHEN known AND oc <> campus THEN oc END AS client_campus_old,
    CASE WHEN known AND oa <> ap THEN oa END AS wireless_station_old, CASE WHEN known AND oa = ap THEN ap END AS wireless_station FROM q""",
)
def trf_move_mse(t):
    return R.movement(placed(t), ttl_ms=86_400_000).select(
        "event_id", "client_floor_old", "client_floor_new", "client_floor", "client_campus_old",
        "wireless_station_old", "wireless_station",
    )


@query(
    "trf_move_nmsp",
    f"""WITH RECURSIVE p AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) AS rn FROM (SELECT event_id, user_id, ({SEC} - 1704067200) // 90 AS t,
      event_type AS floor, 'C' || ((event_id // 1000) % 3) AS campus, CASE WHEN event_id % 4 <> 0 THEN 'ap' || (event_id % 2) END AS ap FROM events)),
    r AS (SELECT user_id, rn, t, floor, ap, true AS told, t AS st, floor AS sf, campus AS sc, ap AS sa, CAST(NULL AS BIGINT) AS ot, CAST(NULL AS VARCHAR) AS of, CAST(NULL AS VARCHAR) AS oa FROM p WHERE rn = 1
      UNION ALL SELECT user_id, rn, t, floor, ap, told, CASE WHEN told THEN t ELSE st END, CASE WHEN told THEN floor ELSE sf END, CASE WHEN told THEN campus ELSE sc END,
        CASE WHEN told THEN ap ELSE sa END, st, sf, sa
      FROM (SELECT p.*, r.st, r.sf, r.sc, r.sa, p.t - r.st > 60 OR p.floor <> r.sf OR p.campus <> r.sc OR (r.sa IS NOT NULL AND p.ap IS DISTINCT FROM r.sa) AS told
        FROM r JOIN p ON p.user_id = r.user_id AND p.rn = r.rn + 1)),
    k AS (SELECT *, ot IS NOT NULL AND t - ot <= 3600 AS known FROM r WHERE told)
    SELECT user_id AS client_mac, t AS timestamp, CASE WHEN known AND of <> floor THEN of END AS client_floor_old, CASE WHEN NOT known OR of <> floor THEN floor END AS client_floor_new,
      CASE WHEN known AND of = floor THEN floor END AS client_floor, ap AS wireless_station FROM k
    UNION ALL SELECT user_id, ot + i * 60, NULL, NULL, of, oa FROM (SELECT *, unnest(range(1, greatest(CAST(ceil((t - ot - 120) / 60.0) AS BIGINT), 1))) AS i FROM k
      WHERE known AND t - ot > 60 AND t - ot <= 1800)""",
)
def trf_move_nmsp(t):
    # A month of events is squeezed to about eight hours so that reports fall within minutes.
    rows = placed(t).withColumns(
        {
            "timestamp": F.floor((F.unix_seconds("ts") - 1_704_067_200) / 90).cast("bigint"),
            "client_zone": F.lit(None).cast("string"),
            "sensor_name": F.lit("s"),
        }
    )
    out = R.dwell(rows.drop("ts"))
    return out.select("client_mac", "timestamp", "client_floor_old", "client_floor_new", "client_floor", "wireless_station")


@query(
    "trf_merge",
    """SELECT event_id, CASE WHEN event_id % 2 = 0 THEN 'flow' WHEN event_id % 3 = 0 THEN 'ap' WHEN event_id % 5 = 0 THEN 'mse' ELSE 'trap' END AS client_floor,
    CASE WHEN event_id % 5 = 0 THEN 'b-mse' ELSE 'b-trap' END AS client_building, CAST(event_id AS BIGINT) AS bytes FROM events""",
)
def trf_merge(t):
    eid = C("event_id")
    layers = t.events.select(
        "event_id",
        F.struct(F.lit("trap").alias("client_floor"), F.lit("b-trap").alias("client_building")).alias("trap"),
        F.struct(F.when(eid % 5 == 0, "mse").alias("client_floor"), F.when(eid % 5 == 0, "b-mse").alias("client_building")).alias("mse"),
        F.struct(F.when(eid % 3 == 0, "ap").alias("client_floor")).alias("ap"),
        F.struct(F.when(eid % 2 == 0, "flow").alias("client_floor"), eid.alias("bytes")).alias("flow"),
    )
    return R.merge_layers(layers, ["trap", "mse", "ap", "flow"])


def flow_rows(t):
    end = F.unix_seconds("ts")
    return t.events.select(
        "event_id", F.when(C("event_id") % 17 != 0, end - F.floor(C("value") * 30)).alias("first_switched"),
        end.alias("timestamp"), (C("event_id") * 97).alias("bytes"), (C("event_id") % 50).alias("pkts"),
    )


FLOWS_SQL = f"""(SELECT event_id, CASE WHEN event_id % 17 <> 0 THEN {SEC} - CAST(floor(value * 30) AS BIGINT) END AS first_switched, {SEC} AS timestamp,
    event_id * 97 AS bytes, event_id % 50 AS pkts FROM events)"""
# The clock stands at 12:10:05 on 20 January 2024, ten minutes past the hour.
AT = 1_705_752_605


@query("st_late_drop", f"""SELECT event_id FROM {FLOWS_SQL} WHERE NOT ({AT} - timestamp > 3600
    OR ((timestamp // 3600) % 24 = ({AT} // 3600) % 24 - 1 AND ({AT} // 60) % 60 > 15))""")
def st_late_drop(t):
    return flow_rows(t).filter(R.not_late(C("timestamp"), F.lit(AT).cast("bigint"))).select("event_id")


@query(
    "trf_split_flow",
    f"""WITH RECURSIVE f AS (SELECT event_id, bytes, pkts, greatest(first_switched, {AT} - 10 * 60 - 3600) AS s, timestamp AS e0 FROM {FLOWS_SQL}
      WHERE first_switched IS NOT NULL AND NOT ({AT} - timestamp > 3600)),
    g AS (SELECT event_id, bytes, pkts, s AS s0, CASE WHEN e0 > {AT} AND ((e0 // 3600) % 24 <> (s // 3600) % 24 OR e0 - {AT} > 3600) THEN {AT} ELSE e0 END AS e FROM f),
    h AS (SELECT event_id, bytes, pkts, CASE WHEN e = {AT} AND e <= s0 THEN {AT} ELSE s0 END AS s, e FROM g),
    r AS (SELECT event_id, bytes, pkts, s, e, s AS a, least(s + 60 - s % 60, e) AS b, 0 AS i FROM h
      UNION ALL SELECT event_id, bytes, pkts, s, e, b, least(b + 60 - b % 60, e), i + 1 FROM r WHERE b < e),
    v AS (SELECT *, CASE WHEN e = s THEN bytes ELSE bytes * (b - a) // (e - s) END AS vb, CASE WHEN e = s THEN pkts ELSE pkts * (b - a) // (e - s) END AS vp FROM r),
    x AS (SELECT *, bytes - sum(vb) OVER (PARTITION BY event_id) AS rb, pkts - sum(vp) OVER (PARTITION BY event_id) AS rp, b >= e AS final FROM v)
    SELECT event_id, b AS timestamp, CAST(CASE WHEN final AND vb + rb > 0 THEN vb + rb ELSE vb END AS BIGINT) AS bytes,
    CAST(CASE WHEN final AND vp + rp > 0 THEN vp + rp ELSE vp END AS BIGINT) AS pkts FROM x
    UNION ALL SELECT event_id, timestamp, bytes, pkts FROM {FLOWS_SQL} WHERE first_switched IS NULL""",
)
def trf_split_flow(t):
    return R.split_flow(flow_rows(t), F.lit(AT).cast("bigint"))


@query(
    "trf_state_upsert",
    """SELECT user_id AS client_mac, max_by(event_type, (ts, event_id)) AS place, max(epoch_us(ts)) AS at FROM events GROUP BY user_id""",
)
def trf_state_upsert(t):
    rows = t.events.select("ts", "seq", C("user_id").alias("client_mac"), C("event_type").alias("place"))
    return R.state_upsert(rows, "client_mac", ["place"]).select("client_mac", "place", F.unix_micros("ts").alias("at"))


# --- roll-ups ---------------------------------------------------------------------------------


def measured(t):
    return t.events.select(
        F.unix_seconds("ts").alias("timestamp"), C("event_type").alias("application_id_name"), (C("user_id") % 3).alias("l4_proto"),
        C("user_id"), (C("event_id") * 97).alias("bytes"), (C("event_id") % 50).alias("pkts"), C("event_type").alias("action"),
    )


ROLL = f"(SELECT ({SEC} // 60) * 60 AS minute, event_type, user_id % 3 AS p, event_id FROM events)"


@query(
    "agg_rollup_flow",
    f"""SELECT minute, event_type AS application_id_name, p AS l4_proto, count(*) AS events, CAST(sum(event_id * 97) AS BIGINT) AS sum_bytes,
    CAST(sum(event_id % 50) AS BIGINT) AS sum_pkts FROM {ROLL} GROUP BY ALL""",
)
def agg_rollup_flow(t):
    return U.flows(measured(t))


@query("agg_rollup_event", f"SELECT minute, event_type AS action, p AS l4_proto, count(*) AS events FROM {ROLL} GROUP BY ALL")
def agg_rollup_event(t):
    return U.events(measured(t))


@query(
    "agg_rollup_monitor",
    f"""SELECT ({SEC} // 60) * 60 AS minute, event_type AS monitor, user_id % 3 AS sensor, count(*) AS events, round(sum(value), 4) AS sum_value,
    max(value) AS max_value, min(value) AS min_value FROM events GROUP BY 1, 2, 3""",
)
def agg_rollup_monitor(t):
    rows = t.events.select(
        F.unix_seconds("ts").alias("timestamp"), C("event_type").alias("monitor"), (C("user_id") % 3).alias("sensor"),
        C("value").cast("string").alias("value"), F.lit("u").alias("unit"), F.lit("x").alias("type"),
    )
    return U.monitor(rows).withColumn("sum_value", F.round("sum_value", 4))


@query(
    "agg_throughput",
    f"""SELECT (s // 60) * 60 AS minute, event_type AS sensor_name, round(avg(n / 50.0), 6) AS mean_value FROM
    (SELECT ({SEC} // 50) * 50 AS s, event_type, CAST(count(*) AS DOUBLE) AS n FROM events GROUP BY 1, 2) GROUP BY 1, 2""",
)
def agg_throughput(t):
    rates = U.throughput(t.events.select(F.unix_seconds("ts").alias("timestamp"), "event_type"), "event_type")
    return U.minute_mean(rates).withColumn("mean_value", F.round("mean_value", 6))


@query(
    "snk_rollup",
    f"""SELECT (minute // 3600) * 3600 AS hour, minute, event_type AS action, p AS l4_proto, count(*) AS events FROM {ROLL} GROUP BY ALL""",
)
def snk_rollup(t):
    return U.by_hour(U.events(measured(t)))
