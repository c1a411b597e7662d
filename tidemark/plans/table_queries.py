"""Queries of partitions, event tables, output rates, rules and extensions."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import extensions as X
from tidemark.operators import intervals as I
from tidemark.operators import partitions as Q
from tidemark.operators import rates as R
from tidemark.operators import select as sel
from tidemark.operators import tables as T
from tidemark.operators import windows as W
from tidemark.operators.intervals import Mergeable
from tidemark.ordering import Run
from tidemark.plans.registry import query
from tidemark.plans.rules import Rule, alerts
from tidemark.plans.window_queries import CENTS, cents

DAY_US = 86_400_000_000

# --- partitions -------------------------------------------------------------------------------


@query(
    "par_by_value",
    f"""SELECT event_id, count(*) OVER (PARTITION BY user_id, event_type ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS n FROM {CENTS}""",
)
def par_by_value(t):
    keyed = Q.by_value(cents(t), ["user_id", "event_type"])
    return A.running_stream(keyed, {"n": Run("count")}, group=["partition_key"]).select("event_id", "n")


@query(
    "par_by_range",
    """SELECT k AS partition_key, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM
    (SELECT event_id, unnest(list_filter([CASE WHEN value < 10 THEN 'low' END, CASE WHEN value > 5 AND value < 50 THEN 'mid' END, CASE WHEN value >= 40 AND value < 90 THEN 'high' END],
    lambda x: x IS NOT NULL)) AS k FROM events) GROUP BY k""",
)
def par_by_range(t):
    v = F.col("value")
    ranges = [("low", v < 10), ("mid", (v > 5) & (v < 50)), ("high", (v >= 40) & (v < 90))]
    return Q.by_range(t.events, ranges).groupBy("partition_key").agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


# --- tables -----------------------------------------------------------------------------------

LAST_ORDER = """(SELECT o_custkey, max_by(o_totalprice, (o_orderdate, o_orderkey)) AS price, max_by(o_orderstatus, (o_orderdate, o_orderkey)) AS status FROM orders GROUP BY o_custkey)"""


def order_events(t):
    return t.orders.select(
        F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("seq"), "o_custkey",
        F.col("o_totalprice").alias("c_acctbal"), F.col("o_orderstatus").alias("c_mktsegment"),
    )


@query("tbl_define", "SELECT c_custkey, c_name FROM customer")
def tbl_define(t):
    table = T.define(t.spark, "c_custkey bigint, c_name string")
    return T.insert(table, t.customer.select("c_custkey", "c_name"))


@query(
    "tbl_insert",
    "SELECT c_custkey, c_name FROM customer UNION ALL SELECT s_suppkey, s_name FROM supplier",
)
def tbl_insert(t):
    return T.insert(t.customer.select("c_custkey", "c_name"), t.supplier.select("s_suppkey", "s_name"))


@query("snk_table", "SELECT c_custkey, c_name FROM customer UNION ALL SELECT o_orderkey, o_orderstatus FROM orders")
def snk_table(t):
    return T.insert(t.customer.select("c_custkey", "c_name"), t.orders.select("o_orderkey", "o_orderstatus"))


@query(
    "tbl_update",
    f"""SELECT c_custkey, CASE WHEN o_custkey IS NULL THEN c_acctbal ELSE price END AS c_acctbal, CASE WHEN o_custkey IS NULL THEN c_mktsegment ELSE status END AS c_mktsegment
    FROM customer LEFT JOIN {LAST_ORDER} ON o_custkey = c_custkey""",
)
def tbl_update(t):
    return T.update(t.customer, order_events(t), [("c_custkey", "o_custkey")]).select("c_custkey", "c_acctbal", "c_mktsegment")


@query(
    "tbl_update_all",
    "SELECT c_custkey, (SELECT max_by(o_orderstatus, (o_orderdate, o_orderkey)) FROM orders) AS c_mktsegment FROM customer",
)
def tbl_update_all(t):
    return T.update(t.customer.select("c_custkey", "c_mktsegment"), order_events(t), [])


@query(
    "tbl_delete",
    "SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_totalprice > 450000)",
)
def tbl_delete(t):
    big = t.orders.filter(F.col("o_totalprice") > 450000)
    return T.delete(t.customer, big, [("c_custkey", "o_custkey")]).select("c_custkey")


@query(
    "tbl_delete_theta",
    "SELECT c_custkey FROM customer WHERE NOT coalesce(c_acctbal < (SELECT max(s_acctbal / 2) FROM supplier), false)",
)
def tbl_delete_theta(t):
    events = t.supplier.withColumn("half", F.col("s_acctbal") / 2)
    return T.delete_theta(t.customer, events, "c_acctbal", "<", "half").select("c_custkey")


@query(
    "tbl_delete_mixed",
    """SELECT c_custkey FROM customer WHERE NOT EXISTS
    (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND c_acctbal < o_totalprice / 64)""",
)
def tbl_delete_mixed(t):
    events = t.orders.withColumn("bound", F.col("o_totalprice") / 64)
    return T.delete_theta(t.customer, events, "c_acctbal", "<", "bound", [("c_custkey", "o_custkey")]).select("c_custkey")


@query(
    "tbl_update_theta",
    """SELECT c_custkey, coalesce(s, c_mktsegment) AS c_mktsegment FROM customer LEFT JOIN
    (SELECT c_custkey AS k, max_by(o_orderstatus || o_orderkey, (o_orderdate, o_orderkey)) AS s FROM customer JOIN orders
     ON o_custkey = c_custkey AND c_acctbal < o_totalprice / 64 GROUP BY c_custkey) ON k = c_custkey""",
)
def tbl_update_theta(t):
    events = t.orders.select(
        "o_custkey", (F.col("o_totalprice") / 64).alias("bound"), F.col("o_orderdate").alias("ts"), F.col("o_orderkey").alias("seq"),
        F.concat("o_orderstatus", F.col("o_orderkey")).alias("c_mktsegment"),
    )
    out = T.update_theta(t.customer, events, [("c_custkey", "o_custkey")], "c_acctbal", "<", "bound")
    return out.select("c_custkey", "c_mktsegment")


@query(
    "prd_in_table_mixed",
    "SELECT event_id FROM events WHERE EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND value * 64 > c_acctbal)",
)
def prd_in_table_mixed(t):
    rows = t.events.withColumn("scaled", F.col("value") * 64)
    return sel.in_table_theta(rows, t.customer, "scaled", ">", "c_acctbal", [("user_id", "c_custkey")]).select("event_id")


@query("tbl_contains", "SELECT event_id FROM events WHERE user_id IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)")
def tbl_contains(t):
    rich = t.customer.filter(F.col("c_acctbal") > 5000)
    return sel.in_table(t.events, rich, [("user_id", "c_custkey")]).select("event_id")


def account_log(t):
    """Users sign up (a row), purchases change the row's value, errors remove the user's rows."""
    e = cents(t).withColumnRenamed("user_id", "k")
    kind = F.col("event_type")
    inserts = e.filter(kind == "signup").select("ts", "seq", "k", F.col("event_id").alias("row_id"), "cents")
    updates = e.filter(kind == "purchase").select("ts", "seq", "k", "cents")
    return T.change_log(inserts, ["k"], updates=updates, deletes=e.filter(kind == "error").select("ts", "seq", "k"))


ALIVE = f"""e AS {CENTS}, p AS (SELECT *, (us, event_id) AS o FROM e),
    v AS (SELECT v.event_id, v.user_id, v.o AS o, i.event_id AS row_id, i.o AS born, i.cents AS cents FROM p v JOIN p i
      ON v.event_type = 'view' AND i.event_type = 'signup' AND i.user_id = v.user_id AND i.o < v.o
      WHERE NOT EXISTS (SELECT 1 FROM p d WHERE d.event_type = 'error' AND d.user_id = v.user_id AND d.o > i.o AND d.o < v.o))"""


@query(
    "tbl_as_of_join",
    f"""WITH {ALIVE}, u AS (SELECT v.event_id, v.row_id, max_by(u.cents, u.o) AS cents FROM v JOIN p u
      ON u.event_type = 'purchase' AND u.user_id = v.user_id AND u.o > v.born AND u.o < v.o GROUP BY ALL)
    SELECT v.event_id, v.row_id, coalesce(u.cents, v.cents) AS cents FROM v LEFT JOIN u ON u.event_id = v.event_id AND u.row_id = v.row_id""",
)
def tbl_as_of_join(t):
    views = t.events.filter("event_type = 'view'").select("event_id", "ts", "seq", "user_id")
    out = T.as_of_join(views, account_log(t), [("user_id", "k")])
    return out.select("event_id", F.col("t_row_id").alias("row_id"), F.col("t_cents").alias("cents"))


@query("tbl_as_of_in", f"WITH {ALIVE} SELECT DISTINCT event_id FROM v")
def tbl_as_of_in(t):
    views = t.events.filter("event_type = 'view'").select("event_id", "ts", "seq", "user_id")
    return T.as_of_in(views, account_log(t), [("user_id", "k")]).select("event_id")


@query(
    "tbl_as_of_not_in",
    f"WITH {ALIVE} SELECT event_id FROM e WHERE event_type = 'view' AND event_id NOT IN (SELECT event_id FROM v)",
)
def tbl_as_of_not_in(t):
    views = t.events.filter("event_type = 'view'").select("event_id", "ts", "seq", "user_id")
    return T.as_of_in(views, account_log(t), [("user_id", "k")], negate=True).select("event_id")


# --- output rates -----------------------------------------------------------------------------

SLOTS = f"(SELECT *, (row_number() OVER (ORDER BY us, event_id) - 1) // 60 AS slot, (row_number() OVER (ORDER BY us, event_id) - 1) % 60 AS place, count(*) OVER () AS total FROM {CENTS})"


@query("rate_events_all", f"SELECT event_id, slot FROM {SLOTS} WHERE (slot + 1) * 60 <= total")
def rate_events_all(t):
    return R.every_events(cents(t), 60).select("event_id", F.col("_slot").alias("slot"))


@query("rate_events_first", f"SELECT event_id, slot FROM {SLOTS} WHERE place = 0")
def rate_events_first(t):
    return R.every_events(cents(t), 60, "first").select("event_id", F.col("_slot").alias("slot"))


@query("rate_events_last", f"SELECT event_id, slot FROM {SLOTS} WHERE place = 59")
def rate_events_last(t):
    return R.every_events(cents(t), 60, "last").select("event_id", F.col("_slot").alias("slot"))


@query(
    "rate_events_group",
    f"""SELECT slot, event_type, min_by(event_id, us) AS event_id, 'first' AS what FROM {SLOTS} GROUP BY slot, event_type
    UNION ALL SELECT slot, event_type, max_by(event_id, us), 'last' FROM {SLOTS} WHERE (slot + 1) * 60 <= total GROUP BY slot, event_type""",
)
def rate_events_group(t):
    parts = [
        R.every_events_grouped(cents(t), 60, what, ["event_type"]).select(
            F.col("_slot").alias("slot"), "event_type", "event_id", F.lit(what).alias("what")
        )
        for what in ("first", "last")
    ]
    return parts[0].unionByName(parts[1])


@query("rate_time_all", f"SELECT event_id, us // {DAY_US} + 1 AS tick FROM {CENTS}")
def rate_time_all(t):
    return R.every_time(cents(t), W.DAY).select("event_id", F.col("_tick").alias("tick"))


@query("rate_time_first", f"SELECT us // {DAY_US} + 1 AS tick, min_by(event_id, us) AS event_id FROM {CENTS} GROUP BY 1")
def rate_time_first(t):
    return R.every_time(cents(t), W.DAY, "first").select(F.col("_tick").alias("tick"), "event_id")


@query("rate_time_last", f"SELECT us // {DAY_US} + 1 AS tick, max_by(event_id, us) AS event_id FROM {CENTS} GROUP BY 1")
def rate_time_last(t):
    return R.every_time(cents(t), W.DAY, "last").select(F.col("_tick").alias("tick"), "event_id")


@query(
    "rate_time_group",
    f"""SELECT us // {DAY_US} + 1 AS tick, user_id, min_by(event_id, us) AS event_id, 'first' AS what FROM {CENTS} GROUP BY 1, 2
    UNION ALL SELECT us // {DAY_US} + 1, user_id, max_by(event_id, us), 'last' FROM {CENTS} GROUP BY 1, 2""",
)
def rate_time_group(t):
    parts = [
        R.every_time_grouped(cents(t), W.DAY, what, ["user_id"]).select(
            F.col("_tick").alias("tick"), "user_id", "event_id", F.lit(what).alias("what")
        )
        for what in ("first", "last")
    ]
    return parts[0].unionByName(parts[1])


HOUR_US = 3_600_000_000
TICKS = f"(SELECT unnest(range((SELECT min((us + {HOUR_US - 1}) // {HOUR_US}) FROM {CENTS}), (SELECT max((us + {HOUR_US - 1}) // {HOUR_US}) FROM {CENTS}) + 1)) AS tick)"


@query("rate_snapshot", f"SELECT tick, e.event_id FROM {TICKS} t ASOF JOIN {CENTS} e ON t.tick * {HOUR_US} >= e.us")
def rate_snapshot(t):
    return R.last_event(cents(t), W.HOUR).select(F.col("_tick").alias("tick"), "event_id")


@query(
    "rate_snapshot_group",
    f"""SELECT tick, g.event_type, e.event_id FROM {TICKS} t JOIN (SELECT DISTINCT event_type FROM events) g ON true
    ASOF JOIN {CENTS} e ON g.event_type = e.event_type AND t.tick * {HOUR_US} >= e.us""",
)
def rate_snapshot_group(t):
    return R.last_event(cents(t), W.HOUR, group=["event_type"]).select(F.col("_tick").alias("tick"), "event_type", "event_id")


@query(
    "rate_snapshot_window",
    f"SELECT tick, e.event_id FROM {TICKS} t JOIN {CENTS} e ON e.us <= tick * {HOUR_US} AND tick * {HOUR_US} < e.us + 3 * {HOUR_US}",
)
def rate_snapshot_window(t):
    live = R.live_time(cents(t), 3 * W.HOUR)
    return R.window_content(live, W.HOUR, ["event_id"]).select(F.col("_tick").alias("tick"), "event_id")


@query(
    "rate_snapshot_length",
    f"""WITH n AS (SELECT *, lead(us, 20) OVER (ORDER BY us, event_id) AS gone FROM {CENTS})
    SELECT tick, e.event_id FROM {TICKS} t JOIN n e ON e.us <= tick * {HOUR_US} AND (gone IS NULL OR tick * {HOUR_US} < gone)""",
)
def rate_snapshot_length(t):
    live = R.live_length(cents(t), 20)
    return R.window_content(live, W.HOUR, ["event_id"], source=cents(t)).select(F.col("_tick").alias("tick"), "event_id")


@query(
    "rate_snapshot_agg",
    f"""SELECT tick, event_type, CAST(sum(cents) AS BIGINT) AS total, count(*) AS n, min(cents) AS low, max(cents) AS high FROM {TICKS} t
    JOIN {CENTS} e ON e.us <= tick * {HOUR_US} AND tick * {HOUR_US} < e.us + {DAY_US} GROUP BY tick, event_type""",
)
def rate_snapshot_agg(t):
    live = R.live_time(cents(t), W.DAY)
    out = R.window_aggregates(
        live, W.HOUR, sums={"total": "cents"}, low={"low": "cents"}, high={"high": "cents"}, count="n", group=["event_type"]
    )
    return out.withColumnRenamed("_tick", "tick")


@query(
    "rate_snapshot_agg_rows",
    f"""SELECT tick, e.event_id, CAST(sum(cents) OVER (PARTITION BY tick) AS BIGINT) AS total FROM {TICKS} t
    JOIN {CENTS} e ON e.us <= tick * {HOUR_US} AND tick * {HOUR_US} < e.us + 3 * {HOUR_US}""",
)
def rate_snapshot_agg_rows(t):
    live = R.live_time(cents(t), 3 * W.HOUR)
    out = R.window_rows_with_aggregates(live, W.HOUR, ["event_id"], sums={"total": "cents"})
    return out.withColumnRenamed("_tick", "tick")


# --- state, rules, extensions -----------------------------------------------------------------


@query(
    "st_ttl",
    f"""SELECT a.event_id, b.us IS NOT NULL AND b.us > a.us - {HOUR_US} AS known FROM (SELECT * FROM {CENTS} WHERE event_type = 'view') a
    ASOF LEFT JOIN (SELECT * FROM {CENTS} WHERE event_type = 'click') b ON a.user_id = b.user_id AND a.us >= b.us""",
)
def st_ttl(t):
    from tidemark.operators import enrich as E

    rows = cents(t)
    state = rows.filter("event_type = 'click'").select("ts", "seq", F.col("user_id").alias("key"), F.col("event_id").alias("click_id"))
    out = E.lookup(rows.filter("event_type = 'view'"), state, "user_id", "key", ["click_id"], hit="known")
    return out.select("event_id", "known")


@query(
    "st_rule_alerts",
    """SELECT 'dear' AS alert, '{"event_id":' || event_id || ',"alert":"dear","timestamp":1706745600}' AS value FROM events WHERE value > 90
    UNION ALL SELECT 'busy', '{"user_id":' || user_id || ',"n":' || count(*) || ',"alert":"busy","timestamp":1706745600}' FROM events WHERE event_type = 'error' GROUP BY user_id HAVING count(*) > 15""",
)
def st_rule_alerts(t):
    dear = Rule("dear", lambda d: d.filter(F.col("value") > 90), ["event_id"])
    busy = Rule(
        "busy",
        lambda d: d.filter("section = 'errors'").groupBy("user_id").agg(F.count(F.lit(1)).alias("n")).filter("n > 15"),
        ["user_id", "n"],
    )
    merged = sel.merge(
        sel.section(t.events.filter("event_type = 'error'"), "errors"),
        sel.section(t.events.filter("event_type <> 'error'"), "flows"),
    )
    return alerts(merged, [dear, busy], F.lit(1_706_745_600))


@X.extension("scalar", "demo:discount")
def discount(price, rate):
    """Built-in expressions stay in the JVM."""
    return price * (F.lit(1) - rate)


@X.extension("mergeable", "demo:spread")
class Spread(Mergeable):
    """Distance between the largest and the smallest value."""

    width = 2

    def lift(self, values):
        return np.stack([values, values], 1)

    def merge(self, a, b):
        return np.stack([np.minimum(a[:, 0], b[:, 0]), np.maximum(a[:, 1], b[:, 1])], 1)

    def finish(self, states):
        return states[:, 1] - states[:, 0]


@X.extension("transform", "demo:widen")
def widen(df, column, by):
    return df.withColumn(f"{column}_wide", F.col(column) + F.lit(by))


@X.extension("window", "demo:pairs")
def pairs_window(df, *, keys=(), ts="ts", seq="seq", split=None):
    return W.length(df, 2, keys=keys, ts=ts, seq=seq, split=split)



@query("udf_scalar", "SELECT l_orderkey, l_partkey, l_linenumber, round(l_extendedprice * (1 - l_discount), 4) AS net FROM lineitem")
def udf_scalar(t):
    net = X.call("scalar", "demo:discount", F.col("l_extendedprice"), F.col("l_discount"))
    return t.lineitem.select("l_orderkey", "l_partkey", "l_linenumber", F.round(net, 4).alias("net"))


@query("udf_agg", "SELECT event_type, round(max(value) - min(value), 4) AS spread FROM events GROUP BY event_type")
def udf_agg(t):
    out = I.user_aggregate(t.events, ["event_type"], "value", "spread", X.call("mergeable", "demo:spread"))
    return out.withColumn("spread", F.round("spread", 4))


@query(
    "udf_agg_window",
    f"""SELECT event_id, CAST(max(cents) OVER w - min(cents) OVER w AS DOUBLE) AS spread FROM {CENTS}
    WINDOW w AS (PARTITION BY event_type ORDER BY us, event_id ROWS BETWEEN 19 PRECEDING AND CURRENT ROW)""",
)
def udf_agg_window(t):
    changes = W.length(cents(t), 20, keys=["event_type"])
    out = I.user_over_changes(changes, ["event_type"], "cents", "spread", X.call("mergeable", "demo:spread"))
    return W.output(out, "current").select("event_id", "spread")


@query("udf_transform", "SELECT event_id, user_id + 1000 AS user_id_wide FROM events")
def udf_transform(t):
    return X.transform(t.events, "demo:widen", "user_id", 1000).select("event_id", "user_id_wide")


@query(
    "udf_window",
    f"SELECT event_id, CAST(sum(cents) OVER (PARTITION BY user_id ORDER BY us ROWS BETWEEN 1 PRECEDING AND CURRENT ROW) AS BIGINT) AS total FROM {CENTS}",
)
def udf_window(t):
    pairs = X.lookup("window", "demo:pairs")
    out = A.over_window(cents(t), pairs, keys=["user_id"], sums={"total": "cents"})
    return W.output(out, "current").select("event_id", "total")
