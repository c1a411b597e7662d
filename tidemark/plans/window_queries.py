"""Queries of event windows and aggregates."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import windows as W
from tidemark.ordering import Run
from tidemark.plans.registry import query

KEY = ["user_id"]


def cents(t):
    """Events with the value in whole cents, so sums are exact."""
    return t.events.select("event_id", "ts", "seq", "user_id", "event_type", "value",
                           F.round(F.col("value") * 100).cast("bigint").alias("cents"))


CENTS = """(SELECT event_id, ts, user_id, event_type, value, CAST(round(value * 100) AS BIGINT) AS cents,
 epoch_us(ts) AS us FROM events)"""


def _live_sql(frame: str, partition: str) -> str:
    return f"""SELECT event_id, CAST(sum(cents) OVER w AS BIGINT) AS total, count(*) OVER w AS n,
    round(avg(cents) OVER w, 4) AS mean FROM {CENTS}
    WINDOW w AS ({partition} ORDER BY us, event_id {frame})"""


def _live(t, window, *args, **options):
    aggs = {"sums": {"total": "cents"}, "averages": {"mean": "cents"}, "count": "n"}
    out = A.over_window(cents(t), window, *args, **aggs, **options)
    return W.output(out, "current").select("event_id", "total", "n", F.round("mean", 4).alias("mean"))


@query("win_length", _live_sql("ROWS BETWEEN 49 PRECEDING AND CURRENT ROW", ""))
def win_length(t):
    return _live(t, W.length, 50)


@query("win_length_keyed", _live_sql("ROWS BETWEEN 4 PRECEDING AND CURRENT ROW", "PARTITION BY user_id"))
def win_length_keyed(t):
    return _live(t, W.length, 5, keys=KEY)


@query(
    "win_length_expired",
    f"""SELECT event_id, lead(event_id, 50) OVER w AS evicted_by FROM {CENTS}
    WINDOW w AS (ORDER BY us, event_id) QUALIFY evicted_by IS NOT NULL""",
)
def win_length_expired(t):
    gone = W.output(W.length(cents(t), 50), "expired")
    return gone.select("event_id", F.col("_by").alias("evicted_by"))


TIME_SQL = f"""SELECT event_id, CAST(sum(cents) OVER w AS BIGINT) AS total, count(*) OVER w AS n,
    round(avg(cents) OVER w, 4) AS mean FROM {CENTS}
    WINDOW w AS (%s ORDER BY us RANGE BETWEEN %s PRECEDING AND CURRENT ROW)"""


@query("win_time", TIME_SQL % ("", 86_400_000_000 - 1))
def win_time(t):
    return _live(t, W.time, W.DAY)


@query("win_time_keyed", TIME_SQL % ("PARTITION BY user_id", 86_400_000_000 - 1))
def win_time_keyed(t):
    return _live(t, W.time, W.DAY, keys=KEY)


@query(
    "win_time_step",
    f"""SELECT a.event_id, CAST(sum(b.cents) AS BIGINT) AS total, count(*) AS n, round(avg(b.cents), 4) AS mean
    FROM {CENTS} a JOIN {CENTS} b ON a.user_id = b.user_id AND b.us <= a.us
    AND ((b.us + 86400000000 + 3599999999) // 3600000000) * 3600000000 > a.us GROUP BY a.event_id""",
)
def win_time_step(t):
    return _live(t, W.time, W.DAY, step=W.HOUR, keys=KEY)


@query("win_external_time", TIME_SQL % ("PARTITION BY event_type", 3_600_000_000))
def win_external_time(t):
    return _live(t, W.external_time, W.HOUR, keys=["event_type"])


@query(
    "win_external_time_expired",
    f"""SELECT a.event_id, min(b.us) AS left_at FROM {CENTS} a
    ASOF JOIN (SELECT event_type, us FROM {CENTS}) b
    ON a.event_type = b.event_type AND a.us + 3600000000 < b.us GROUP BY a.event_id""",
)
def win_external_time_expired(t):
    gone = W.output(W.external_time(cents(t), W.HOUR, keys=["event_type"]), "expired")
    return gone.select("event_id", F.col("_at").alias("left_at"))


@query(
    "win_length_batch",
    f"""SELECT batch, CAST(sum(cents) AS BIGINT) AS total, count(*) AS n, max_by(event_id, us) AS last_id FROM
    (SELECT *, (row_number() OVER (ORDER BY us, event_id) - 1) // 50 AS batch FROM {CENTS})
    GROUP BY batch HAVING count(*) = 50""",
)
def win_length_batch(t):
    rows = W.batches_by_length(cents(t), 50)
    out = A.batch_rows(rows, {"total": F.sum("cents"), "n": A.count_rows()}, ["event_id"])
    return out.select(F.col("_batch").alias("batch"), "total", "n", F.col("event_id").alias("last_id"))


@query(
    "win_length_batch_changes",
    f"""WITH b AS (SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY us, event_id) - 1) // 50 AS batch FROM {CENTS}),
    f AS (SELECT event_type, batch, max(us) AS done FROM b GROUP BY ALL HAVING count(*) = 50)
    SELECT b.event_id, 'current' AS kind, f.done AS at FROM b JOIN f ON b.event_type = f.event_type AND b.batch = f.batch
    UNION ALL SELECT b.event_id, 'expired', f.done FROM b JOIN f ON b.event_type = f.event_type AND b.batch + 1 = f.batch""",
)
def win_length_batch_changes(t):
    changes = W.length_batch(cents(t), 50, keys=["event_type"])
    return W.output(changes, "all").select("event_id", F.col("_kind").alias("kind"), F.col("_at").alias("at"))


@query(
    "win_time_batch",
    f"""SELECT us // 86400000000 AS batch, event_type, CAST(sum(cents) AS BIGINT) AS total, count(*) AS n
    FROM {CENTS} GROUP BY ALL""",
)
def win_time_batch(t):
    rows = W.batches_by_time(cents(t), W.DAY)
    out = A.batch_rows(rows, {"total": F.sum("cents"), "n": A.count_rows()}, [], ["event_type"])
    return out.withColumnRenamed("_batch", "batch")


@query(
    "win_sort",
    """SELECT event_id, value FROM events ORDER BY value DESC, ts, event_id LIMIT 100""",
)
def win_sort(t):
    return W.smallest(t.events, 100, [("value", False)]).select("event_id", "value")


@query(
    "win_sort_keyed",
    """SELECT user_id, event_id, value FROM events
    QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY value, ts, event_id) <= 3""",
)
def win_sort_keyed(t):
    return W.smallest_per_key(t.events, 3, [("value", True)], KEY).select("user_id", "event_id", "value")


@query(
    "win_sort_changes",
    f"""SELECT event_id, 'current' AS kind, us AS at FROM {CENTS} UNION ALL
    SELECT a.event_id, 'expired', greatest(a.us, b.us) FROM {CENTS} a JOIN {CENTS} b
    ON a.event_type = b.event_type AND (b.value < a.value OR (b.value = a.value AND b.us < a.us))
    QUALIFY row_number() OVER (PARTITION BY a.event_id ORDER BY b.us) = 10""",
)
def win_sort_changes(t):
    changes = W.sort_window(cents(t), 10, [("value", True)], keys=["event_type"])
    return changes.select("event_id", F.col("_kind").alias("kind"), F.col("_at").alias("at"))


@query(
    "win_sort_text",
    f"""SELECT event_id, ts, 'current' AS kind, us AS at FROM {CENTS} UNION ALL
    SELECT a.event_id, a.ts, 'expired', greatest(a.us, b.us) FROM {CENTS} a JOIN {CENTS} b
    ON a.user_id = b.user_id AND (b.event_type > a.event_type OR (b.event_type = a.event_type AND b.us < a.us))
    QUALIFY row_number() OVER (PARTITION BY a.event_id ORDER BY b.us) = 7""",
)
def win_sort_text(t):
    """Text, descending; the rows keep their own types."""
    changes = W.sort_window(t.events.drop("props"), 7, [("event_type", False)], keys=["user_id"])
    return changes.select("event_id", F.col("ts").cast("timestamp_ntz").alias("ts"), F.col("_kind").alias("kind"), F.col("_at").alias("at"))


@query(
    "win_unique",
    """SELECT user_id, max_by(event_id, ts) AS event_id, max_by(value, ts) AS value FROM events GROUP BY user_id""",
)
def win_unique(t):
    return W.latest(t.events, KEY).select("user_id", "event_id", "value")


@query(
    "win_unique_expired",
    """SELECT event_id, lead(event_id) OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS replaced_by
    FROM events QUALIFY replaced_by IS NOT NULL""",
)
def win_unique_expired(t):
    gone = W.output(W.unique(cents(t), ["user_id", "event_type"]), "expired")
    return gone.select("event_id", F.col("_by").alias("replaced_by"))


@query(
    "win_unique_total",
    f"""SELECT event_id, CAST(sum(d) OVER (ORDER BY us, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS total FROM
    (SELECT event_id, us, cents - coalesce(lag(cents) OVER (PARTITION BY user_id ORDER BY us, event_id), 0) AS d FROM {CENTS})""",
)
def win_unique_total(t):
    out = A.over_window(cents(t), W.unique, KEY, sums={"total": "cents"})
    return W.output(out, "current").select("event_id", "total")


@query(
    "win_first_unique",
    """SELECT user_id, event_type, min_by(event_id, ts) AS event_id FROM events GROUP BY user_id, event_type""",
)
def win_first_unique(t):
    return W.first_unique(t.events, ["user_id", "event_type"]).select("user_id", "event_type", "event_id")


@query(
    "win_frequent",
    """SELECT event_type, count(*) AS n_rows FROM events GROUP BY event_type
    HAVING count(*) * 6 > (SELECT count(*) FROM events)""",
)
def win_frequent(t):
    return W.frequent_items(t.events, 5, ["event_type"])


_COUNTED = """WITH RECURSIVE p AS (SELECT event_id, user_id, event_type, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM events),
    r AS (SELECT user_id, rn, event_id, [{'t': event_type, 'c': 1, 'b': 0, 'id': event_id}] AS held, true AS cur, CAST([] AS BIGINT[]) AS gone FROM p WHERE rn = 1
    UNION ALL %s)
    SELECT event_id, user_id, 'current' AS _kind FROM r WHERE cur UNION ALL SELECT unnest(gone), user_id, 'expired' FROM r"""


@query(
    "win_frequent_trace",
    _COUNTED % """SELECT user_id, rn, event_id,
      CASE WHEN hit THEN list_transform(held, lambda h: CASE WHEN h.t = event_type THEN {'t': h.t, 'c': h.c + 1, 'b': 0, 'id': event_id} ELSE h END)
        WHEN len(held) < 2 THEN list_append(held, {'t': event_type, 'c': 1, 'b': 0, 'id': event_id})
        WHEN len(kept) < 2 THEN list_append(kept, {'t': event_type, 'c': 1, 'b': 0, 'id': event_id}) ELSE kept END,
      hit OR len(held) < 2 OR len(kept) < 2,
      CASE WHEN hit OR len(held) < 2 THEN CAST([] AS BIGINT[]) ELSE list_transform(list_filter(held, lambda h: h.c = 1), lambda h: h.id) END
      FROM (SELECT p.*, held, list_contains(list_transform(held, lambda h: h.t), p.event_type) AS hit,
        list_filter(list_transform(held, lambda h: {'t': h.t, 'c': h.c - 1, 'b': 0, 'id': h.id}), lambda h: h.c > 0) AS kept
        FROM r JOIN p ON p.user_id = r.user_id AND p.rn = r.rn + 1)""",
)
def win_frequent_trace(t):
    rows = t.events.select("event_id", "ts", "seq", "user_id", "event_type")
    return W.frequent(rows, 2, ["event_type"], keys=KEY).select("event_id", "user_id", "_kind")


@query(
    "win_lossy_frequent",
    """SELECT user_id, count(*) AS n_rows FROM events GROUP BY user_id
    HAVING count(*) >= CAST(0.0072 AS DOUBLE) * (SELECT count(*) FROM events)""",
)
def win_lossy_frequent(t):
    return W.lossy_frequent_items(t.events, 0.008, KEY)


# The first row of a key counts 1 of 1 and is current; pruning happens every 34 rows (1 / 0.03).
@query(
    "win_lossy_frequent_trace",
    _COUNTED % """SELECT user_id, rn, event_id,
      CASE WHEN rn % 34 = 0 THEN list_filter(added, lambda h: h.c + h.b > bucket) ELSE added END,
      list_filter(added, lambda h: h.t = event_type)[1].c >= (CAST(0.3 AS DOUBLE) - CAST(0.3 AS DOUBLE) / 10) * rn,
      CASE WHEN rn % 34 = 0 THEN list_transform(list_filter(added, lambda h: h.c + h.b <= bucket), lambda h: h.id) ELSE CAST([] AS BIGINT[]) END
      FROM (SELECT *, CASE WHEN hit THEN list_transform(held, lambda h: CASE WHEN h.t = event_type THEN {'t': h.t, 'c': h.c + 1, 'b': h.b, 'id': event_id} ELSE h END)
          ELSE list_append(held, {'t': event_type, 'c': 1, 'b': CAST(bucket - 1 AS INTEGER), 'id': event_id}) END AS added
        FROM (SELECT p.*, (p.rn + 33) // 34 AS bucket, held, list_contains(list_transform(held, lambda h: h.t), p.event_type) AS hit
          FROM r JOIN p ON p.user_id = r.user_id AND p.rn = r.rn + 1))""",
)
def win_lossy_frequent_trace(t):
    rows = t.events.select("event_id", "ts", "seq", "user_id", "event_type")
    return W.lossy_frequent(rows, 0.3, ["event_type"], keys=KEY).select("event_id", "user_id", "_kind")


@query(
    "win_expired_out",
    f"""SELECT 'current' AS kind, event_id FROM {CENTS}
    UNION ALL SELECT 'expired', event_id FROM
    (SELECT event_id FROM {CENTS} QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY us DESC, event_id DESC) > 5)""",
)
def win_expired_out(t):
    changes = W.output(W.length(cents(t), 5, keys=KEY), "all")
    return changes.select(F.col("_kind").alias("kind"), "event_id")


# --- aggregates ---------------------------------------------------------------------------


def _shipped(t):
    return t.lineitem.groupBy("l_returnflag", "l_linestatus")


@query(
    "agg_sum",
    """SELECT l_returnflag, l_linestatus, CAST(sum(l_linenumber) AS BIGINT) AS sum_int,
    round(sum(l_quantity), 2) AS sum_double FROM lineitem GROUP BY ALL""",
)
def agg_sum(t):
    return _shipped(t).agg(
        A.checked_sum(t.lineitem, "l_linenumber").alias("sum_int"),
        F.round(A.checked_sum(t.lineitem, "l_quantity"), 2).alias("sum_double"),
    )


@query(
    "agg_avg",
    """SELECT l_suppkey, round(coalesce(avg(CASE WHEN l_discount > 0.099 THEN l_quantity END), 0), 6) AS mean
    FROM lineitem GROUP BY l_suppkey""",
)
def agg_avg(t):
    some = F.when(F.col("l_discount") > 0.099, F.col("l_quantity"))
    return t.lineitem.groupBy("l_suppkey").agg(F.round(A.average(some), 6).alias("mean"))


_SLIDE = f"""SELECT event_id, min(cents) OVER w AS low, max(cents) OVER w AS high FROM {CENTS}
    WINDOW w AS (PARTITION BY user_id ORDER BY us RANGE BETWEEN {86_400_000_000 - 1} PRECEDING AND CURRENT ROW)"""


def _extremes(t, keys):
    rows = W.arrivals(cents(t))
    low = A.sliding_extreme(rows, "min", "cents", "low", axis="_t", span=W.DAY * 1000, keys=keys, tie="_s")
    return A.sliding_extreme(low, "max", "cents", "high", axis="_t", span=W.DAY * 1000, keys=keys, tie="_s")


@query("agg_min", f"SELECT event_id, low FROM ({_SLIDE})")
def agg_min(t):
    rows = W.arrivals(cents(t))
    return A.sliding_extreme(rows, "min", "cents", "low", axis="_t", span=W.DAY * 1000, keys=KEY, tie="_s").select("event_id", "low")


@query("agg_max", f"SELECT event_id, high FROM ({_SLIDE})")
def agg_max(t):
    rows = W.arrivals(cents(t))
    return A.sliding_extreme(rows, "max", "cents", "high", axis="_t", span=W.DAY * 1000, keys=KEY, tie="_s").select("event_id", "high")


@query(
    "agg_max_length",
    f"""SELECT event_id, max(cents) OVER (ORDER BY us, event_id ROWS BETWEEN 199 PRECEDING AND CURRENT ROW) AS high FROM {CENTS}""",
)
def agg_max_length(t):
    rows = A.with_positions(cents(t))
    return A.sliding_extreme(rows, "max", "cents", "high", axis="_rn", span=200, tie="_s").select("event_id", "high")


@query(
    "agg_count",
    "SELECT event_type, count(*) AS n FROM events GROUP BY event_type",
)
def agg_count(t):
    return t.events.groupBy("event_type").agg(A.count_rows().alias("n"))


@query(
    "agg_group_by",
    f"""SELECT event_id, CAST(sum(cents) OVER w AS BIGINT) AS total, count(*) OVER w AS n FROM {CENTS}
    WINDOW w AS (PARTITION BY user_id, event_type ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)""",
)
def agg_group_by(t):
    runs = {"total": Run("sum", F.col("cents")), "n": Run("count")}
    return A.running_stream(cents(t), runs, group=["user_id", "event_type"]).select("event_id", "total", "n")


@query(
    "agg_having",
    """SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY user_id HAVING sum(value) > 1300""",
)
def agg_having(t):
    out = t.events.groupBy("user_id").agg(A.count_rows().alias("n"), F.sum("value").alias("total"))
    return out.filter(F.col("total") > 1300).withColumn("total", F.round("total", 2))


@query(
    "agg_running",
    f"""SELECT event_id, CAST(sum(cents) OVER w AS BIGINT) AS total, min(cents) OVER w AS low, max(cents) OVER w AS high,
    count(*) OVER w AS n FROM {CENTS} WINDOW w AS (ORDER BY us, event_id ROWS UNBOUNDED PRECEDING)""",
)
def agg_running(t):
    c = F.col("cents")
    runs = {"total": Run("sum", c), "low": Run("min", c), "high": Run("max", c), "n": Run("count")}
    return A.running_stream(cents(t), runs).select("event_id", "total", "low", "high", "n")


@query(
    "agg_batch_row",
    f"""SELECT batch, user_id, CAST(sum(cents) AS BIGINT) AS total, max_by(event_type, us) AS event_type FROM
    (SELECT *, us // 86400000000 AS batch FROM {CENTS}) GROUP BY batch, user_id""",
)
def agg_batch_row(t):
    rows = W.batches_by_time(cents(t), W.DAY)
    out = A.batch_rows(rows, {"total": F.sum("cents")}, ["event_type"], KEY)
    return out.withColumnRenamed("_batch", "batch")


# --- extremes over windows that are not first-in-first-out ------------------------------------

ORDERED = f"(SELECT *, row_number() OVER (ORDER BY us, event_id) AS p FROM {CENTS})"


@query(
    "agg_max_unique",
    f"""WITH r AS (SELECT *, coalesce(lead(p) OVER (PARTITION BY user_id ORDER BY p), 1000000000000) AS gone FROM {ORDERED})
    SELECT a.event_id, max(b.cents) AS high, min(b.cents) AS low, count(*) AS n FROM r a JOIN r b ON b.p <= a.p AND b.gone > a.p GROUP BY a.event_id""",
)
def agg_max_unique(t):
    out = A.over_window(cents(t), W.unique, KEY, group=[], highs={"high": "cents"}, lows={"low": "cents"}, count="n")
    return W.output(out, "current").select("event_id", "high", "low", "n")


@query(
    "agg_min_sort",
    f"""WITH k AS (SELECT a.event_id, b.cents, row_number() OVER (PARTITION BY a.event_id ORDER BY b.value DESC, b.p) AS place
      FROM {ORDERED} a JOIN {ORDERED} b ON a.user_id = b.user_id AND b.p <= a.p)
    SELECT event_id, min(cents) AS low, max(cents) AS high FROM k WHERE place <= 5 GROUP BY event_id""",
)
def agg_min_sort(t):
    out = A.over_window(cents(t), W.sort_window, 5, [("value", False)], keys=KEY, lows={"low": "cents"}, highs={"high": "cents"})
    # One arrival may change the window twice; what counts is the content after its last change.
    last = W.output(out, "all").groupBy(F.col("_by").alias("event_id")).agg(F.max_by(F.struct("low", "high"), F.struct("_tie")).alias("x"))
    return last.select("event_id", "x.low", "x.high")


@query(
    "agg_max_batch",
    f"""WITH b AS (SELECT *, (row_number() OVER (PARTITION BY event_type ORDER BY us, event_id) - 1) // 50 AS batch FROM {CENTS}),
    f AS (SELECT event_type, batch, max(cents) AS high FROM b GROUP BY ALL HAVING count(*) = 50)
    SELECT event_type, batch, high FROM f""",
)
def agg_max_batch(t):
    changes = W.length_batch(cents(t), 50, keys=["event_type"])
    out = A.over_changes(changes, ["event_type"], highs={"high": "cents"}, count="n")
    return W.output(out, "current").filter("n = 50").select("event_type", F.col("_batch").alias("batch"), "high")
