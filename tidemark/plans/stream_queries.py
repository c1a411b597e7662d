"""Queries that run as streams over the given tables and are read back when done."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import patterns as P
from tidemark.operators import rollup as U
from tidemark.operators import windows as W
from tidemark.plans.pattern_queries import DAY_US, EV
from tidemark.plans.registry import ORACLES, query
from tidemark.session import new_folder
from tidemark.streaming import operators as S
from tidemark.streaming.sinks import run_available


def events(t):
    """The event table as a file stream."""
    schema = t.events.drop("seq").withColumn("ts", F.col("ts").cast("timestamp_ntz")).schema
    raw = t.spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(t.folder)
    return raw.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("seq", F.col("event_id"))


def finished(t, df, name: str):
    root = new_folder(t.spark, name)
    return run_available(df, f"{root}/data", f"{root}/checkpoint")


def typed(df, kind: str):
    return df.filter(F.col("event_type") == kind).select("event_id", "ts", "seq", "user_id", "value")


@query("src_replay", "SELECT event_id, user_id, value FROM events")
def src_replay(t):
    rows = events(t).select("event_id", "user_id", "value")
    return finished(t, rows, "replay")


@query(
    "stream_time_batch",
    f"""SELECT us // {DAY_US} AS batch, event_type, count(*) AS n FROM {EV} WHERE (us // {DAY_US} + 1) * {DAY_US} <= (SELECT max(us) FROM {EV}) - 3600000000
    GROUP BY ALL""",
)
def stream_time_batch(t):
    out = S.time_batches(events(t), W.DAY, {"n": F.count(F.lit(1))}, ["event_type"])
    return finished(t, out, "batches").withColumnRenamed("_batch", "batch")


@query("stream_first_unique", "SELECT DISTINCT user_id FROM events")
def stream_first_unique(t):
    return finished(t, S.first_unique(events(t), ["user_id"]), "unique").select("user_id")


@query(
    "stream_jn_time",
    ORACLES["jn_time"].replace(", CASE WHEN a.us > b.us THEN 'left' ELSE 'right' END AS trigger", ""),
)
def stream_jn_time(t):
    e = events(t)
    out = S.time_join(typed(e, "view"), typed(e, "purchase"), 2 * W.HOUR, 6 * W.HOUR, [("user_id", "user_id")])
    return finished(t, out.select("l_event_id", "r_event_id"), "join")


@query("stream_enrich", ORACLES["jn_enrich"])
def stream_enrich(t):
    e = events(t)
    state = typed(e, "signup").select(
        "ts", "seq", F.col("user_id").alias("k"), F.col("event_id").alias("s_id"), F.col("value").alias("s_value")
    )
    out = S.lookup(typed(e, "view"), state, "user_id", "k", ["s_id", "s_value"], ttl_ms=W.DAY)
    return finished(t, out.select("event_id", "s_id", "s_value"), "lookup")


@query("stream_pattern", ORACLES["pat_cross_ref"])
def stream_pattern(t):
    kind = F.col("event_type")
    parts = [
        P.step("e1", kind == "error"),
        P.step("e2", kind == "purchase", lambda event, match: event["value"] > match["e1"]["value"]),
    ]
    rows = events(t).select("event_id", "ts", "seq", "user_id", "event_type", "value")
    out = S.pattern(rows, parts, ["event_id", "value"], keys=["user_id"], every=True, within_ms=3 * W.DAY)
    return finished(t, out, "pattern").select("user_id", F.col("e1.event_id").alias("e1"), F.col("e2.event_id").alias("e2"))


@query(
    "stream_win_length",
    f"""SELECT event_id, 'current' AS kind FROM events UNION ALL
    SELECT event_id, 'expired' FROM {EV} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us DESC, event_id DESC) > 5""",
)
def stream_win_length(t):
    rows = events(t).select("event_id", "ts", "seq", "user_id")
    out = finished(t, S.window_changes(rows, keys=["user_id"], length=5), "length")
    return out.select("event_id", F.col("_kind").alias("kind"))


@query(
    "stream_rollup_flow",
    f"""SELECT minute, event_type AS application_id_name, count(*) AS events, CAST(sum(event_id * 97) AS BIGINT) AS sum_bytes, CAST(sum(event_id % 50) AS BIGINT) AS sum_pkts
    FROM (SELECT ((us // 1000000) // 60) * 60 AS minute, * FROM {EV}) WHERE minute + 60 <= (SELECT max(us // 1000000) FROM {EV}) - 900 GROUP BY ALL""",
)
def stream_rollup_flow(t):
    rows = events(t).select(
        F.unix_seconds("ts").alias("timestamp"), F.col("event_type").alias("application_id_name"),
        (F.col("event_id") * 97).alias("bytes"), (F.col("event_id") % 50).alias("pkts"),
    )
    return finished(t, U.flows(rows), "rollup")


def _passed(sql: str, kinds: str) -> str:
    """The rows that the watermark has passed when the input ends: one hour behind the newest."""
    newest = f"SELECT max(us) // 1000 - 3600000 FROM {EV} WHERE event_type IN ({kinds})"
    return f"SELECT * FROM ({sql}) WHERE event_id IN (SELECT event_id FROM {EV} WHERE us // 1000 < ({newest}))"


@query("stream_enrich_ordered", _passed(ORACLES["jn_enrich"], "'view', 'signup'"))
def stream_enrich_ordered(t):
    e = events(t)
    state = typed(e, "signup").select(
        "ts", "seq", F.col("user_id").alias("k"), F.col("event_id").alias("s_id"), F.col("value").alias("s_value")
    )
    out = S.lookup(typed(e, "view"), state, "user_id", "k", ["s_id", "s_value"], ttl_ms=W.DAY, ordered=True)
    return finished(t, out.select("event_id", "s_id", "s_value"), "lookup-ordered")


@query(
    "stream_win_length_ordered",
    f"""WITH e AS (SELECT event_id, user_id, us FROM {EV} WHERE us // 1000 < (SELECT max(us) // 1000 - 3600000 FROM {EV}))
    SELECT event_id, 'current' AS kind FROM e UNION ALL
    SELECT event_id, 'expired' FROM e QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us DESC, event_id DESC) > 5""",
)
def stream_win_length_ordered(t):
    rows = events(t).select("event_id", "ts", "seq", "user_id")
    out = finished(t, S.window_changes(rows, keys=["user_id"], length=5, ordered=True), "length-ordered")
    return out.select("event_id", F.col("_kind").alias("kind"))
