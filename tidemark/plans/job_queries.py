"""The telemetry job end to end over the given tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import dimensions as D
from tidemark.plans import flow_job
from tidemark.plans.join_queries import AP_LOCATIONS, EV, ap_tables
from tidemark.plans.registry import query


@query(
    "flow_job_minutes",
    f"""WITH s AS (SELECT us, user_id, CASE WHEN value > 20 THEN 'good' ELSE 'bad' END AS rssi, 'ap' || (event_id % 100) AS ap FROM {EV} WHERE event_type = 'signup'),
    f AS (SELECT event_id, (us // 1000000) * 1000000 AS us, user_id, event_id % 120 AS dst FROM {EV} WHERE event_type = 'view'),
    j AS (SELECT f.*, CASE WHEN s.us > f.us - 86400000000 THEN rssi END AS rssi, CASE WHEN s.us > f.us - 86400000000 THEN ap END AS ap
      FROM f ASOF LEFT JOIN s ON f.user_id = s.user_id AND f.us >= s.us)
    SELECT (j.us // 60000000) * 60 AS minute, v.n_name AS client_mac_vendor, coalesce(rssi, 'unknown') AS client_rssi, a.client_building,
      CASE WHEN d.s_suppkey IS NULL THEN 'clean' ELSE 'destination' END AS darklist_direction, count(*) AS events, CAST(sum(event_id * 97) AS BIGINT) AS sum_bytes
    FROM j LEFT JOIN nation v ON v.n_nationkey = j.user_id % 64 LEFT JOIN {AP_LOCATIONS} a ON a.mac_address = j.ap
    LEFT JOIN supplier d ON d.s_suppkey = j.dst GROUP BY ALL""",
)
def flow_job_minutes(t):
    uid, eid = F.col("user_id"), F.col("event_id")
    mac = F.concat(F.lit("00:ab:"), F.lpad(F.lower(F.hex(uid % 64)), 2, "0"), F.lit(":"), uid)
    flows = t.events.filter("event_type = 'view'").select(
        F.unix_seconds("ts").alias("timestamp"), "seq", mac.alias("client_mac"), F.concat(F.lit("c"), uid).alias("src"),
        (eid % 120).cast("string").alias("dst"), (eid * 97).alias("bytes"), F.lit(1).alias("pkts"),
        F.lit(None).cast("bigint").alias("first_switched"),
    )
    signups = t.events.filter("event_type = 'signup'").select("ts", "seq", mac.alias("client_mac"), "value", "event_id")
    trap = signups.select(
        "ts", "seq", "client_mac", F.when(F.col("value") > 20, "good").otherwise("bad").alias("client_rssi"),
        F.lit(-50).alias("client_rssi_num"), F.lit("good").alias("client_snr"), F.lit(30).alias("client_snr_num"),
    )
    none = F.lit(None).cast("string")
    location = signups.select(
        "ts", "seq", "client_mac", F.concat(F.lit("ap"), eid % 100).alias("wireless_station"),
        *[none.alias(c) for c in ("client_campus", "client_building", "client_floor", "client_latlong", "wireless_id")],
    )
    vendors = t.nation.select(F.concat(F.lit("00AB"), F.lpad(F.hex("n_nationkey"), 2, "0")).alias("oui"), F.col("n_name").alias("vendor"))
    key = F.col("s_suppkey")
    table = t.supplier.select(
        key.cast("string").alias("ip"), F.lit(1.0).alias("darklist_score"), F.lit("n").alias("darklist_score_name"),
        F.lit("c").alias("darklist_category"), F.lit("p").alias("darklist_protocol"),
    )
    sources = flow_job.Sources(
        vendors=vendors, trap=trap, location=location, access_points=D.access_points(*ap_tables(t)), reputation=table
    )
    out = flow_job.minute_flows(flows, sources, F.lit(1_704_067_200).cast("bigint"), ttl_ms=86_400_000)
    dims = ["minute", "client_mac_vendor", "client_rssi", "client_building", "darklist_direction"]
    return out.groupBy(*dims).agg(F.sum("events").alias("events"), F.sum("sum_bytes").alias("sum_bytes"))
