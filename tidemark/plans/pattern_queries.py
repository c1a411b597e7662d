"""Queries of patterns and sequences."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import scalar as S
from tidemark.operators import patterns as P
from tidemark.operators import windows as W
from tidemark.plans.registry import query

KEY = ["user_id"]
FIELDS = ["event_id", "value"]
EV = "(SELECT event_id, epoch_us(ts) AS us, user_id, event_type, value FROM events)"
DAY_US = 86_400_000_000


def is_(kind: str):
    return F.col("event_type") == kind


def rows(t):
    return t.events.select("event_id", "ts", "seq", "user_id", "event_type", "value")


def ids(df, *names):
    return df.select("user_id", *[F.col(f"{n}.event_id").alias(n) for n in names])


def listed(name: str):
    """Ids of a counted slot as text."""
    return F.array_join(F.transform(F.col(name), lambda e: e["event_id"].cast("string")), ",").alias(name)


FIRST_ERROR = f"(SELECT user_id, min_by(event_id, us) AS e1, min(us) AS us FROM {EV} WHERE event_type = 'error' GROUP BY user_id)"


@query(
    "pat_followed_by",
    f"""SELECT a.user_id, a.e1, min_by(b.event_id, b.us) AS e2 FROM {FIRST_ERROR} a JOIN {EV} b
    ON a.user_id = b.user_id AND b.event_type = 'purchase' AND b.us > a.us GROUP BY a.user_id, a.e1""",
)
def pat_followed_by(t):
    return ids(P.chain(rows(t), [("e1", is_("error")), ("e2", is_("purchase"))], FIELDS, keys=KEY), "e1", "e2")


EVERY = f"""(SELECT a.user_id, a.event_id AS e1, a.us AS us1, b.event_id AS e2, b.us AS us2 FROM (SELECT * FROM {EV} WHERE event_type = 'error') a
    ASOF JOIN (SELECT * FROM {EV} WHERE event_type = 'purchase') b ON a.user_id = b.user_id AND a.us < b.us)"""


@query("pat_every", f"SELECT user_id, e1, e2 FROM {EVERY}")
def pat_every(t):
    steps = [("e1", is_("error")), ("e2", is_("purchase"))]
    return ids(P.chain(rows(t), steps, FIELDS, keys=KEY, every=True), "e1", "e2")


@query(
    "pat_every_keyless",
    f"""SELECT a.event_id AS e1, b.event_id AS e2, c.event_id AS e3 FROM (SELECT * FROM {EV} WHERE event_type = 'error') a
    ASOF JOIN (SELECT * FROM {EV} WHERE event_type = 'purchase') b ON a.us < b.us ASOF JOIN (SELECT * FROM {EV} WHERE event_type = 'view') c ON b.us < c.us""",
)
def pat_every_keyless(t):
    steps = [("e1", is_("error")), ("e2", is_("purchase")), ("e3", is_("view"))]
    out = P.chain(rows(t), steps, FIELDS, every=True)
    return out.select(*[F.col(f"{n}.event_id").alias(n) for n in ("e1", "e2", "e3")])


@query(
    "pat_every_group",
    f"""WITH RECURSIVE l AS (SELECT user_id, list(us ORDER BY us) FILTER (event_type = 'error') AS es, list(us ORDER BY us) FILTER (event_type = 'click') AS cs,
      list(us ORDER BY us) FILTER (event_type = 'purchase') AS ps FROM {EV} GROUP BY user_id),
    g AS (SELECT user_id, es, cs, ps, list_min(es) AS e, list_min(list_filter(cs, lambda x: x > list_min(es))) AS c FROM l
      UNION ALL SELECT user_id, es, cs, ps, list_min(list_filter(es, lambda x: x > c)), list_min(list_filter(cs, lambda x: x > list_min(list_filter(es, lambda y: y > c)))) FROM g
      WHERE c IS NOT NULL)
    SELECT g.user_id, a.event_id AS e1, b.event_id AS e3, p.event_id AS e2 FROM g JOIN {EV} a ON a.user_id = g.user_id AND a.us = g.e
    JOIN {EV} b ON b.user_id = g.user_id AND b.us = g.c JOIN {EV} p ON p.user_id = g.user_id AND p.us = list_min(list_filter(g.ps, lambda x: x > g.c))""",
)
def pat_every_group(t):
    parts = [P.step("e1", is_("error")), P.step("e3", is_("click")), P.step("e2", is_("purchase"))]
    return ids(P.pattern(rows(t), parts, FIELDS, keys=KEY, every=(0, 1)), "e1", "e3", "e2")


@query(
    "pat_count",
    f"""WITH e AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us) AS rn FROM {EV} WHERE event_type = 'error'),
    q AS (SELECT e.user_id, min(p.us) AS us, min_by(p.event_id, p.us) AS e2 FROM e JOIN {EV} p ON p.user_id = e.user_id AND p.event_type = 'purchase' AND p.us > e.us WHERE e.rn = 2 GROUP BY e.user_id)
    SELECT q.user_id, string_agg(CAST(e.event_id AS VARCHAR), ',' ORDER BY e.us) AS e1, q.e2 FROM q JOIN e ON e.user_id = q.user_id AND e.us < q.us AND e.rn <= 5 GROUP BY q.user_id, q.e2""",
)
def pat_count(t):
    parts = [P.count(P.step("e1", is_("error")), 2, 5), P.step("e2", is_("purchase"))]
    out = P.pattern(rows(t), parts, FIELDS, keys=KEY)
    return out.select("user_id", listed("e1"), F.col("e2.event_id").alias("e2"))


FIRST_SIGNUP = f"(SELECT user_id, min_by(event_id, us) AS e1, min(us) AS us FROM {EV} WHERE event_type = 'signup' GROUP BY user_id)"


@query(
    "pat_and",
    f"""SELECT a.user_id, a.e1, min_by(b.event_id, b.us) FILTER (b.event_type = 'error') AS e2, min_by(b.event_id, b.us) FILTER (b.event_type = 'click') AS e3
    FROM {FIRST_SIGNUP} a JOIN {EV} b ON a.user_id = b.user_id AND b.us > a.us GROUP BY a.user_id, a.e1 HAVING e2 IS NOT NULL AND e3 IS NOT NULL""",
)
def pat_and(t):
    parts = [P.step("e1", is_("signup")), P.both(P.step("e2", is_("error")), P.step("e3", is_("click")))]
    return ids(P.pattern(rows(t), parts, FIELDS, keys=KEY), "e1", "e2", "e3")


@query(
    "pat_and_within",
    f"""SELECT a.user_id, a.event_id AS e1, min_by(b.event_id, b.us) FILTER (b.event_type = 'purchase') AS e2, min_by(b.event_id, b.us) FILTER (b.event_type = 'click') AS e3
    FROM {EV} a JOIN {EV} b ON a.user_id = b.user_id AND b.us > a.us AND a.event_type = 'error'
    GROUP BY a.user_id, a.event_id HAVING e2 IS NOT NULL AND e3 IS NOT NULL""",
)
def pat_and_within(t):
    """The two events of a pair are not under the bound, wherever they lie."""
    parts = [P.step("e1", is_("error")), P.both(P.step("e2", is_("purchase")), P.step("e3", is_("click")))]
    return ids(P.pattern(rows(t), parts, FIELDS, keys=KEY, every=True, within_ms=W.HOUR), "e1", "e2", "e3")


@query(
    "pat_or",
    f"""SELECT user_id, e1, CASE WHEN kind = 'error' THEN id END AS e2, CASE WHEN kind = 'click' THEN id END AS e3 FROM
    (SELECT a.user_id, a.e1, min_by(b.event_id, b.us) AS id, min_by(b.event_type, b.us) AS kind FROM {FIRST_SIGNUP} a JOIN {EV} b
    ON a.user_id = b.user_id AND b.us > a.us AND b.event_type IN ('error', 'click') GROUP BY a.user_id, a.e1)""",
)
def pat_or(t):
    parts = [P.step("e1", is_("signup")), P.either(P.step("e2", is_("error")), P.step("e3", is_("click")))]
    return ids(P.pattern(rows(t), parts, FIELDS, keys=KEY), "e1", "e2", "e3")


@query("pat_within", f"SELECT user_id, e1, e2 FROM {EVERY} WHERE us2 - us1 <= {DAY_US}")
def pat_within(t):
    steps = [("e1", is_("error")), ("e2", is_("purchase"))]
    return ids(P.chain(rows(t), steps, FIELDS, keys=KEY, every=True, within_ms=W.DAY), "e1", "e2")


@query(
    "pat_cross_ref",
    f"""SELECT a.user_id, a.event_id AS e1, min_by(b.event_id, b.us) AS e2 FROM {EV} a JOIN {EV} b ON a.user_id = b.user_id AND a.event_type = 'error'
    AND b.event_type = 'purchase' AND b.us > a.us AND b.us - a.us <= {3 * DAY_US} AND b.value > a.value GROUP BY a.user_id, a.event_id""",
)
def pat_cross_ref(t):
    parts = [
        P.step("e1", is_("error")),
        P.step("e2", is_("purchase"), lambda event, match: event["value"] > match["e1"]["value"]),
    ]
    return ids(P.pattern(rows(t), parts, FIELDS, keys=KEY, every=True, within_ms=3 * W.DAY), "e1", "e2")


@query(
    "pat_fold",
    f"""SELECT a.user_id, a.event_id AS e1, b.event_id AS e2 FROM (SELECT * FROM {EV} WHERE value > 20) a
    ASOF JOIN (SELECT * FROM {EV} WHERE value > 10) b ON a.user_id = b.user_id AND a.us < b.us WHERE b.us - a.us <= {3 * DAY_US}""",
)
def pat_fold(t):
    parts = [P.step("e1", F.col("value") > 20), P.step("e2", F.col("value") > 10)]
    return ids(P.pattern(rows(t), parts, FIELDS, keys=KEY, every=True, within_ms=3 * W.DAY), "e1", "e2")


@query(
    "seq_next",
    f"""SELECT user_id, event_id AS e1, n AS e2 FROM (SELECT *, lead(event_id) OVER w AS n, lead(event_type) OVER w AS k FROM {EV}
    WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)) WHERE event_type = 'error' AND k = 'purchase'""",
)
def seq_next(t):
    return ids(P.strict(rows(t), [("e1", is_("error")), ("e2", is_("purchase"))], FIELDS, keys=KEY), "e1", "e2")


@query(
    "seq_next_keyless",
    f"""SELECT event_id AS e1, n AS e2, m AS e3 FROM (SELECT *, lead(event_id) OVER w AS n, lead(event_type) OVER w AS k,
    lead(event_id, 2) OVER w AS m, lead(event_type, 2) OVER w AS j FROM {EV} WINDOW w AS (ORDER BY us, event_id))
    WHERE event_type = 'error' AND k = 'purchase' AND j = 'view'""",
)
def seq_next_keyless(t):
    steps = [("e1", is_("error")), ("e2", is_("purchase")), ("e3", is_("view"))]
    out = P.strict(rows(t), steps, FIELDS)
    return out.select(*[F.col(f"{n}.event_id").alias(n) for n in ("e1", "e2", "e3")])


RUNS = """(SELECT *, sum(CASE WHEN event_type = '%s' THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS island FROM """ + EV + ")"


@query(
    "seq_regex",
    f"""WITH r AS {RUNS % 'error'}, p AS (SELECT user_id, island - 1 AS island, event_id AS e2 FROM r WHERE event_type = 'purchase'),
    s AS (SELECT r.user_id, r.event_id, r.us, p.e2, p.island FROM r JOIN p ON r.user_id = p.user_id AND r.island = p.island AND r.event_type = 'error')
    SELECT a.user_id, string_agg(CAST(b.event_id AS VARCHAR), ',' ORDER BY b.us) AS e1, a.e2 FROM s a JOIN s b ON a.user_id = b.user_id AND a.e2 = b.e2 AND b.us >= a.us
    GROUP BY a.user_id, a.event_id, a.e2""",
)
def seq_regex(t):
    parts = [P.plus(P.step("e1", is_("error"))), P.step("e2", is_("purchase"))]
    out = P.sequence(rows(t), parts, FIELDS, keys=KEY)
    return out.select("user_id", listed("e1"), F.col("e2.event_id").alias("e2"))


@query(
    "seq_regex_star",
    f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY us) AS rn, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END)
    OVER (PARTITION BY user_id ORDER BY us ROWS UNBOUNDED PRECEDING) AS clicks FROM {EV})
    SELECT a.user_id, a.event_id AS e1, CAST(b.rn - a.rn - 1 AS INTEGER) AS n_clicks, b.event_id AS e3 FROM r a JOIN r b ON a.user_id = b.user_id AND a.event_type = 'error'
    AND b.event_type = 'purchase' AND b.rn > a.rn AND b.clicks - a.clicks = b.rn - a.rn - 1""",
)
def seq_regex_star(t):
    parts = [P.step("e1", is_("error")), P.star(P.step("e2", is_("click"))), P.step("e3", is_("purchase"))]
    out = P.sequence(rows(t), parts, FIELDS, keys=KEY)
    return out.select("user_id", F.col("e1.event_id").alias("e1"), F.size("e2").alias("n_clicks"), F.col("e3.event_id").alias("e3"))


@query(
    "seq_or",
    f"""SELECT user_id, event_id AS e1, CASE WHEN k = 'purchase' THEN n END AS e2, CASE WHEN k = 'click' THEN n END AS e3 FROM
    (SELECT *, lead(event_id) OVER w AS n, lead(event_type) OVER w AS k FROM {EV} WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id))
    WHERE event_type = 'error' AND k IN ('purchase', 'click')""",
)
def seq_or(t):
    parts = [P.step("e1", is_("error")), P.either(P.step("e2", is_("purchase")), P.step("e3", is_("click")))]
    return ids(P.sequence(rows(t), parts, FIELDS, keys=KEY), "e1", "e2", "e3")


@query(
    "seq_within",
    f"""SELECT user_id, event_id AS e1, n AS e2 FROM (SELECT *, lead(event_id) OVER w AS n, lead(event_type) OVER w AS k, lead(us) OVER w AS u FROM {EV}
    WINDOW w AS (PARTITION BY user_id ORDER BY us, event_id)) WHERE event_type = 'error' AND k = 'purchase' AND u - us <= {DAY_US // 4}""",
)
def seq_within(t):
    parts = [P.step("e1", is_("error")), P.step("e2", is_("purchase"))]
    return ids(P.sequence(rows(t), parts, FIELDS, keys=KEY, within_ms=W.DAY // 4), "e1", "e2")


@query(
    "fn_position",
    f"""WITH r AS {RUNS % 'error'}, g AS (SELECT user_id, island, list(event_id ORDER BY us) AS es FROM r WHERE event_type = 'error' GROUP BY user_id, island),
    p AS (SELECT g.user_id, es, r.event_id AS e2 FROM g JOIN r ON r.user_id = g.user_id AND r.island = g.island + 1 AND r.event_type = 'purchase')
    SELECT user_id, es[i] AS first_id, es[i + 1] AS second_id, es[-1] AS last_id, e2 FROM (SELECT *, unnest(range(1, len(es) + 1)) AS i FROM p)""",
)
def fn_position(t):
    parts = [P.plus(P.step("e1", is_("error"))), P.step("e2", is_("purchase"))]
    out = P.sequence(rows(t), parts, FIELDS, keys=KEY)
    e1 = F.col("e1")
    return out.select(
        "user_id", S.item_at(e1, 0)["event_id"].alias("first_id"), S.item_at(e1, 1)["event_id"].alias("second_id"),
        S.item_at(e1)["event_id"].alias("last_id"), F.col("e2.event_id").alias("e2"),
    )
