"""Queries of projection, filters, predicates, scalar functions and unions."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import predicates as P
from tidemark.functions import scalar as S
from tidemark.functions import telemetry as M
from tidemark.operators import select as sel
from tidemark.plans.registry import query

# Two-valued logic is visible only with nulls: both sides make the same ones from real values.
NULLED_SQL = """(SELECT *, CASE WHEN event_type = 'error' THEN NULL ELSE value END AS v,
 CASE WHEN user_id % 5 = 0 THEN NULL ELSE CAST(user_id AS DOUBLE) END AS w,
 CASE WHEN event_type = 'view' THEN NULL ELSE value > 20 END AS b FROM events)"""


def nulled(t):
    return t.events.withColumns(
        {
            "v": F.when(F.col("event_type") != "error", F.col("value")),
            "w": F.when(F.col("user_id") % 5 != 0, F.col("user_id").cast("double")),
            "b": F.when(F.col("event_type") != "view", F.col("value") > 20),
        }
    )


@query("prj_select", "SELECT event_id AS id, value * 2 AS doubled, event_type FROM events")
def prj_select(t):
    return t.events.select(F.col("event_id").alias("id"), (F.col("value") * 2).alias("doubled"), "event_type")


@query(
    "prj_rename_source",
    """SELECT c.c_custkey AS c_c_custkey, c.c_name AS c_c_name, n.n_nationkey AS n_n_nationkey,
    n.n_name AS n_n_name FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey""",
)
def prj_rename_source(t):
    c = sel.prefixed(t.customer.select("c_custkey", "c_name", "c_nationkey"), "c")
    n = sel.prefixed(t.nation.select("n_nationkey", "n_name"), "n")
    joined = c.join(n, F.col("c_c_nationkey") == F.col("n_n_nationkey"))
    return joined.drop("c_c_nationkey")


@query("flt_condition", "SELECT event_id, value FROM events WHERE value > 40 AND event_type = 'purchase'")
def flt_condition(t):
    return t.events.filter(P.and_(P.gt(F.col("value"), F.lit(40)), P.eq(F.col("event_type"), F.lit("purchase")))).select(
        "event_id", "value"
    )


@query("flt_pass", "SELECT event_id, user_id FROM events")
def flt_pass(t):
    return sel.passthrough(t.events).select("event_id", "user_id")


def _compare(name: str, op: str, make):
    @query(name, f"SELECT event_id FROM {NULLED_SQL} WHERE v {op} w")
    def run(t):
        return nulled(t).filter(make(F.col("v"), F.col("w"))).select("event_id")

    return run


for _name, _op, _make in (
    ("prd_eq", "=", lambda a, b: P.eq(F.floor(a).cast("double"), b)),
    ("prd_ne", "<>", P.ne),
    ("prd_lt", "<", P.lt),
    ("prd_le", "<=", P.le),
    ("prd_gt", ">", P.gt),
    ("prd_ge", ">=", P.ge),
):
    if _name == "prd_eq":
        query("prd_eq", f"SELECT event_id FROM {NULLED_SQL} WHERE floor(v) = w")(
            lambda t, m=_make: nulled(t).filter(m(F.col("v"), F.col("w"))).select("event_id")
        )
    else:
        _compare(_name, _op, _make)


@query("prd_and", f"SELECT event_id FROM {NULLED_SQL} WHERE coalesce(v > 10, false) AND coalesce(w < 60, false)")
def prd_and(t):
    return nulled(t).filter(P.and_(F.col("v") > 10, F.col("w") < 60)).select("event_id")


@query("prd_or", f"SELECT event_id FROM {NULLED_SQL} WHERE coalesce(v > 90, false) OR coalesce(w < 10, false)")
def prd_or(t):
    return nulled(t).filter(P.or_(F.col("v") > 90, F.col("w") < 10)).select("event_id")


@query("prd_not", f"SELECT event_id FROM {NULLED_SQL} WHERE NOT coalesce(v > 5, false)")
def prd_not(t):
    return nulled(t).filter(P.not_(F.col("v") > 5)).select("event_id")


@query("prd_bool", f"SELECT event_id FROM {NULLED_SQL} WHERE coalesce(b, false)")
def prd_bool(t):
    return nulled(t).filter(P.truth(F.col("b"))).select("event_id")


@query("prd_contains", "SELECT event_id, event_type FROM events WHERE event_type LIKE '%i%' AND props LIKE '%7%'")
def prd_contains(t):
    return t.events.filter(
        P.and_(P.contains(F.col("event_type"), F.lit("i")), P.contains(F.col("props"), F.lit("7")))
    ).select("event_id", "event_type")


@query(
    "prd_instanceof",
    f"SELECT event_id, v IS NOT NULL AS v_is_double, false AS v_is_string FROM {NULLED_SQL}",
)
def prd_instanceof(t):
    n = nulled(t)
    return n.select(
        "event_id",
        P.instance_of(n, "v", "double").alias("v_is_double"),
        P.instance_of(n, "v", "string").alias("v_is_string"),
    )


@query(
    "flt_field",
    "SELECT event_id, user_id FROM events WHERE event_type = 'signup'",
)
def flt_field(t):
    return t.events.filter(P.equals_field("event_type", "signup")).select("event_id", "user_id")


@query("flt_null", f"SELECT event_id FROM {NULLED_SQL} WHERE v IS NOT NULL AND w IS NOT NULL")
def flt_null(t):
    return nulled(t).dropna(subset=["v", "w"]).select("event_id")


MAC_SQL = """(SELECT event_id, user_id, CASE WHEN user_id % 7 = 0 THEN NULL ELSE
 lower(printf('%02x:%02x:00:00:00:01', CAST(user_id % 256 AS INT), CAST(event_id % 256 AS INT))) END AS src_mac FROM events)"""


def with_mac(t):
    octet = lambda c: F.lpad(F.lower(F.hex(c % 256)), 2, "0")
    mac = F.concat_ws(":", octet(F.col("user_id")), octet(F.col("event_id")), F.lit("00:00:00:01"))
    return t.events.select("event_id", "user_id", F.when(F.col("user_id") % 7 != 0, mac).alias("src_mac"))


@query(
    "flt_mac_local",
    f"SELECT event_id, src_mac FROM {MAC_SQL} WHERE src_mac IS NULL OR (user_id % 256) & 2 = 0",
)
def flt_mac_local(t):
    return with_mac(t).filter(P.universal_mac(F.col("src_mac"))).select("event_id", "src_mac")


@query(
    "prd_in_table",
    """SELECT event_id FROM events WHERE event_type = 'purchase' AND user_id IN
    (SELECT c_custkey FROM customer WHERE c_mktsegment = 'BUILDING')""",
)
def prd_in_table(t):
    rows = t.events.filter(F.col("event_type") == "purchase")
    table = t.customer.filter(F.col("c_mktsegment") == "BUILDING")
    return sel.in_table(rows, table, [("user_id", "c_custkey")]).select("event_id")


@query(
    "prd_in_table_theta",
    """SELECT s_suppkey FROM supplier s WHERE EXISTS (SELECT 1 FROM customer c WHERE s.s_acctbal >= c.c_acctbal
    AND c.c_nationkey = s.s_nationkey)""",
)
def prd_in_table_theta(t):
    return sel.in_table_theta(
        t.supplier, t.customer, "s_acctbal", ">=", "c_acctbal", [("s_nationkey", "c_nationkey")]
    ).select("s_suppkey")


@query(
    "prd_not_in_table",
    "SELECT c_custkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')",
)
def prd_not_in_table(t):
    table = t.orders.filter(F.col("o_orderstatus") == "F")
    return sel.in_table(t.customer, table, [("c_custkey", "o_custkey")], negate=True).select("c_custkey")


def _arith(name: str, op: str, sql: str):
    @query(name, f"SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, round({sql}, 6) AS r, l_orderkey {op} l_linenumber AS i FROM lineitem")
    def run(t):
        li = t.lineitem
        return li.select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
            F.round(S.arithmetic(li, "l_extendedprice", op, "l_quantity"), 6).alias("r"),
            S.arithmetic(li, "l_orderkey", op, "l_linenumber").alias("i"),
        )

    return run


_arith("fn_add", "+", "l_extendedprice + l_quantity")
_arith("fn_sub", "-", "l_extendedprice - l_quantity")
_arith("fn_mul", "*", "l_extendedprice * l_quantity")
_arith("fn_mod", "%", "l_extendedprice % l_quantity")


@query(
    "fn_div",
    """SELECT event_id, CASE WHEN user_id % 3 = 0 THEN CASE WHEN event_id > 0 THEN 'Infinity' ELSE 'NaN' END
    ELSE CAST(CAST(floor(CAST(event_id AS DOUBLE) / (user_id % 3) * 1000) AS BIGINT) AS VARCHAR) END AS ratio FROM events""",
)
def fn_div(t):
    ratio = S.divide(F.col("event_id"), F.col("user_id") % 3)
    whole = F.floor(F.when(~F.isnan(ratio) & (ratio < float("inf")), ratio) * 1000).cast("string")
    return t.events.select("event_id", F.coalesce(whole, ratio.cast("string")).alias("ratio"))


@query(
    "fn_convert",
    """SELECT event_id, CAST(trunc(value) AS INTEGER) AS v_int, CAST(user_id AS VARCHAR) AS u_text,
    TRY_CAST(json_extract_string(props, '$.k') AS INTEGER) AS k_int,
    TRY_CAST(event_type AS INTEGER) AS bad, CAST(value > 20 AS INTEGER) AS b_int,
    strftime(date_trunc('second', ts), '%Y-%m-%d %H:%M:%S') AS t_text,
    epoch_ms(date_trunc('second', ts)) AS t_back, strftime(ts, '%m') AS month FROM events""",
)
def fn_convert(t):
    e = t.events.withColumns(
        {
            "k": F.get_json_object("props", "$.k"),
            "flag": F.col("value") > 20,
            "ms": F.unix_millis("ts"),
        }
    )
    e = e.withColumn("t_text", S.convert(e, "ms", "string", "yyyy-MM-dd HH:mm:ss"))
    return e.select(
        "event_id",
        S.convert(e, "value", "int").alias("v_int"),
        S.convert(e, "user_id", "string").alias("u_text"),
        S.convert(e, "k", "int").alias("k_int"),
        S.convert(e, "event_type", "int").alias("bad"),
        S.convert(e, "flag", "int").alias("b_int"),
        "t_text",
        S.convert(e, "t_text", "long", "yyyy-MM-dd HH:mm:ss").alias("t_back"),
        S.convert(e, "t_text", "string", "yyyy-MM-dd HH:mm:ss", "MM").alias("month"),
    )


@query("fn_coalesce", f"SELECT event_id, coalesce(v, w) AS c FROM {NULLED_SQL}")
def fn_coalesce(t):
    n = nulled(t)
    return n.select("event_id", S.coalesce(n, "v", "w").alias("c"))


@query(
    "fn_concat",
    f"""SELECT event_id, event_type || coalesce(CAST(CAST(w AS BIGINT) AS VARCHAR), 'null') ||
    CAST(user_id AS VARCHAR) AS c FROM {NULLED_SQL}""",
)
def fn_concat(t):
    return nulled(t).select(
        "event_id", S.concat(F.col("event_type"), F.col("w").cast("bigint"), F.col("user_id")).alias("c")
    )


@query("fn_is_match", "SELECT page_id, regexp_full_match(url, 'https?://(www|blog)[.].*/[0-9]+/?') AS m FROM pages")
def fn_is_match(t):
    return t.pages.select("page_id", S.is_match("https?://(www|blog)[.].*/[0-9]+/?", F.col("url")).alias("m"))


@query("fn_sin", "SELECT event_id, round(sin(value), 6) AS s FROM events")
def fn_sin(t):
    return t.events.select("event_id", F.round(S.sine(F.col("value")), 6).alias("s"))


@query(
    "fn_timestamp_default",
    f"SELECT event_id, coalesce(CASE WHEN v IS NOT NULL THEN CAST(floor(epoch_us(ts) / 1000000.0) AS BIGINT) END, 1706745600) AS timestamp FROM {NULLED_SQL}",
)
def fn_timestamp_default(t):
    n = nulled(t)
    own = F.when(F.col("v").isNotNull(), F.unix_seconds("ts"))
    return n.select("event_id", M.with_default_time(own, F.lit(1706745600).cast("bigint")).alias("timestamp"))


SIGNAL_SQL = "(SELECT event_id, -CAST(user_id % 100 AS INT) AS rssi, CASE WHEN event_id % 11 = 0 THEN NULL ELSE CAST(event_id % 50 AS INT) END AS snr FROM events)"


def signals(t):
    return t.events.select(
        "event_id",
        (-(F.col("user_id") % 100)).cast("int").alias("rssi"),
        F.when(F.col("event_id") % 11 != 0, F.col("event_id") % 50).cast("int").alias("snr"),
    )


@query(
    "fn_signal_class",
    f"""SELECT event_id, CASE WHEN rssi = 0 THEN 'unknown' WHEN rssi <= -85 THEN 'bad' WHEN rssi <= -80 THEN 'low'
    WHEN rssi <= -70 THEN 'medium' WHEN rssi <= -60 THEN 'good' ELSE 'excelent' END AS client_rssi,
    CASE WHEN snr IS NULL THEN 'unknown' WHEN snr <= 10 THEN 'bad' WHEN snr <= 15 THEN 'low' WHEN snr <= 25 THEN 'medium'
    WHEN snr < 40 THEN 'good' ELSE 'excelent' END AS client_snr FROM {SIGNAL_SQL}""",
)
def fn_signal_class(t):
    return signals(t).select(
        "event_id", M.rssi_class(F.col("rssi")).alias("client_rssi"), M.snr_class(F.col("snr")).alias("client_snr")
    )


@query(
    "fn_signal_quality",
    f"""SELECT event_id, CASE WHEN snr IS NOT NULL AND snr <> 0 THEN CAST(trunc(floor(((least(greatest(rssi, -85), -50) + 85) / CAST(35.0 AS DOUBLE)
    + (least(greatest(snr, 10), 40) - 10) / CAST(30.0 AS DOUBLE)) / CAST(2.0 AS DOUBLE) * 100 + 0.5) / CAST(100.0 AS DOUBLE) * 100.0) AS INTEGER) END AS quality FROM {SIGNAL_SQL}""",
)
def fn_signal_quality(t):
    return signals(t).select("event_id", M.signal_quality(F.col("rssi"), F.col("snr")).alias("quality"))


@query(
    "fn_java_hash",
    f"""SELECT event_id, CAST(CASE WHEN src_mac IS NULL THEN NULL WHEN h >= 2147483648 THEN h - 4294967296 ELSE h END AS INTEGER) AS client_mac FROM (
    SELECT event_id, src_mac, list_reduce(list_prepend(CAST(0 AS BIGINT), list_transform(string_split(src_mac, ''), lambda c: CAST(ascii(c) AS BIGINT))),
    lambda a, c: (a * 31 + c) % 4294967296) AS h FROM {MAC_SQL})""",
)
def fn_java_hash(t):
    return with_mac(t).select("event_id", M.text_hash(F.col("src_mac")).alias("client_mac"))


@query(
    "fn_url_analyze",
    r"""SELECT page_id, CASE WHEN host LIKE '%.example.%' AND regexp_matches(right(path, 5), '[.](jpg|gif|png|mp4|avi|mp3)')
    AND length(path) > 5 THEN 'http://' || host || path END AS http_social_media,
    CAST(NULL AS VARCHAR) AS http_social_user FROM (SELECT page_id, regexp_extract(url, '^https?://([^/]*)', 1) AS host,
    regexp_replace(regexp_extract(url, '^https?://[^/]*(/.*)$', 1), '[.]html$', '.png') AS path FROM pages)""",
)
def fn_url_analyze(t):
    parts = t.pages.select(
        "page_id",
        F.regexp_extract("url", "^https?://([^/]*)", 1).alias("http_host"),
        F.regexp_replace(F.regexp_extract("url", "^https?://[^/]*(/.*)$", 1), "[.]html$", ".png").alias("http_url"),
    )
    found = M.url_fields(F.col("http_host"), F.col("http_url"))
    return parts.select("page_id", found["http_social_media"].alias("http_social_media"), found["http_social_user"].alias("http_social_user"))


@query(
    "set_union",
    """SELECT event_id AS id, value, CAST(NULL AS VARCHAR) AS label FROM events WHERE event_type = 'view'
    UNION ALL SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders""",
)
def set_union(t):
    views = t.events.filter(F.col("event_type") == "view").select(F.col("event_id").alias("id"), "value")
    orders = t.orders.select(
        F.col("o_orderkey").alias("id"), F.col("o_totalprice").alias("value"), F.col("o_orderstatus").alias("label")
    )
    return sel.merge(views, orders)


@query(
    "set_section",
    """SELECT event_id AS id, 'traffics' AS section FROM events WHERE event_type = 'view'
    UNION ALL SELECT event_id, 'events' FROM events WHERE event_type = 'error'""",
)
def set_section(t):
    flows = sel.section(t.events.filter(F.col("event_type") == "view"), "traffics")
    alarms = sel.section(t.events.filter(F.col("event_type") == "error"), "events")
    return sel.merge(flows, alarms).select(F.col("event_id").alias("id"), "section")
