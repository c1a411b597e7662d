"""Operators on small literal inputs with known results."""

import math
import os
import random
import sys
import tempfile

import numpy as np
import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.functions import predicates as P
from tidemark.functions import scalar as S
from tidemark.functions import telemetry as M
from tidemark.operators import aggregates as A
from tidemark.operators import dimensions as D
from tidemark.operators import enrich as E
from tidemark.operators import joins as J
from tidemark.operators import rates as RT
from tidemark.operators import records as R
from tidemark.operators import regression as G
from tidemark.operators import tables as T
from tidemark.operators import windows as W
from tidemark.ordering import plan_split
from tidemark.sources import kafka, messages

cloudpickle.register_pickle_by_value(sys.modules[__name__])


def kinds(changes):
    got = [r[0] for r in changes.select("_kind").collect()]
    return got.count("current"), got.count("expired")


def test_external_time(spark):
    times = [1366335804341, 1366335804342, 1366335814341, 1366335814345, 1366335824341]
    df = spark.createDataFrame([(t, i) for i, t in enumerate(times)], "ms bigint, seq bigint")
    df = df.withColumn("ts", F.timestamp_millis("ms"))
    assert kinds(W.external_time(df, 5000)) == (5, 4)


def cards(spark, rows):
    df = messages.replay(spark, rows, "cardNo string, price double")
    return df.withColumn("all", F.lit(1))


def test_frequent_all_columns(spark):
    once = [("3234", 73.36), ("1234", 46.36), ("5768", 48.36), ("9853", 78.36)]
    out = W.frequent(cards(spark, once * 2), 2, ["cardNo", "price"], keys=["all"])
    assert kinds(out) == (8, 6)
    seen = brute_frequent([(c, p) for c, p in once * 2], 2)
    assert kinds(out) == (sum(k == "current" for k, _ in seen), sum(k == "expired" for k, _ in seen))


def test_frequent_by_card(spark):
    rows = [("3234", 73.36), ("1234", 46.36), ("3234", 78.36), ("1234", 86.36), ("5768", 48.36)] * 2
    assert kinds(W.frequent(cards(spark, rows), 2, ["cardNo"], keys=["all"])) == (8, 0)


def brute_frequent(items, k):
    held, out = {}, []
    for item in items:
        if item in held:
            held[item] += 1
            out.append(("current", item))
            continue
        if len(held) == k:
            for other in list(held):
                held[other] -= 1
                if not held[other]:
                    del held[other]
                    out.append(("expired", other))
        if len(held) < k:
            held[item] = 1
            out.append(("current", item))
    return out


def test_lossy_frequent(spark):
    rows = [("3224", 73.36)] + [("3234", 73.36), ("1234", 46.36), ("5768", 48.36), ("3234", 78.36)] * 25
    out = W.lossy_frequent(cards(spark, rows), 0.3, ["cardNo"], keys=["all"], error=0.05)
    current, expired = kinds(out)
    assert (current, expired) == (101, 1)
    assert current == brute_lossy([c for c, _ in rows], 0.3, 0.05)


def brute_lossy(items, support, error):
    width, held, current = math.ceil(1 / error), {}, 0
    for n, item in enumerate(items, 1):
        bucket = 1 if n == 1 else math.ceil(n / width)
        count, first = held.get(item, (0, bucket - 1))
        held[item] = (count + 1, first)
        current += held[item][0] >= (support - error) * n
        if n % width == 0:
            held = {k: v for k, v in held.items() if v[0] + v[1] > bucket}
    return current


def test_frequent_items_find_every_heavy_value(spark):
    random.seed(3)
    rows = [(random.choice("aaaabbbcccdefghijkl"), 1.0) for _ in range(3000)]
    df = cards(spark, rows).repartition(6)
    counts = {v: sum(r[0] == v for r in rows) for v in "abcdefghijkl"}
    got = {r[0]: r[1] for r in W.frequent_items(df, 6, ["cardNo"]).collect()}
    assert got == {v: n for v, n in counts.items() if n * 7 > len(rows)}


def test_length_batch_average_and_sum(spark):
    df = messages.replay(spark, [("a", 100.0), ("b", 200.0), ("c", 300.0), ("d", 400.0), ("e", 1.0)], "s string, price double")
    out = A.over_window(df, W.length_batch, 2, sums={"total": "price"}, averages={"mean": "price"})
    current = [tuple(r) for r in W.output(out).orderBy("_at", "_seq").select("s", "total", "mean").collect()]
    assert current[1] == ("b", 300.0, 150.0) and current[3] == ("d", 700.0, 350.0) and len(current) == 4
    gone = [tuple(r) for r in W.output(out, "expired").orderBy("_seq").select("s", "total", "mean").collect()]
    assert gone[-1] == ("b", 0.0, 0.0)


def test_sum_checks_types(spark):
    df = spark.createDataFrame([(1, 1.5, "a")], "i int, d double, s string")
    out = df.agg(A.checked_sum(df, "i").alias("i"), A.checked_sum(df, "d").alias("d"))
    assert [f.dataType.simpleString() for f in out.schema.fields] == ["bigint", "double"]
    none = df.filter("i > 5").agg(A.checked_sum(df, "i").alias("i"), A.average(F.col("d")).alias("m")).first()
    assert tuple(none) == (0, 0.0)
    with pytest.raises(TypeError):
        A.checked_sum(df, "s")


def test_comparisons_are_checked_and_two_valued(spark):
    df = spark.createDataFrame([(1, None, "a"), (2, 1, "b")], "a int, b int, s string")
    assert [r.a for r in df.filter(P.not_(P.gt(F.col("a"), F.col("b")))).collect()] == [1]
    P.check_comparable(df, "a", "<", "b")
    for args in (("a", "==", "s"), ("s", "<", "s")):
        with pytest.raises(TypeError):
            P.check_comparable(df, *args)


def test_coalesce_and_concat(spark):
    df = spark.createDataFrame([(50, 60), (70, None), (None, 44), (None, None)], "a int, b int")
    assert [r[0] for r in df.select(S.coalesce(df, "a", "b")).collect()] == [50, 70, 44, None]
    assert [r[0] for r in df.select(S.concat(F.col("a"), F.lit("-"), F.col("b"))).collect()][1] == "70-null"


def test_division_and_convert(spark):
    df = spark.createDataFrame([(1, 2), (1, 0), (0, 0), (-1, 0)], "a int, b int")
    got = [r[0] for r in df.select(S.arithmetic(df, "a", "/", "b")).collect()]
    assert got[0] == 0.5 and got[1] == math.inf and math.isnan(got[2]) and got[3] == -math.inf
    t = spark.createDataFrame([("12", "x", True, 3.9)], "n string, bad string, f boolean, d double")
    row = t.select(S.convert(t, "n", "long"), S.convert(t, "bad", "double"), S.convert(t, "f", "int"), S.convert(t, "d", "int")).first()
    assert tuple(row) == (12, None, 1, 3)


def test_url_rules(spark):
    rows = [
        ("www.dropbox.com", "/x?user_id=77&y"), ("www.facebook.com", "/plugins/like.php?href=http%3A%2F%2Fa.com&x=1"),
        ("www.facebook.com", "/plugins/share_button.php?href=http%3A%2F%2Fb.com&x"), ("x.akamaihd.net", "/a_123_b.jpg"),
        ("maps.google.com", "/maps/api/staticmap?center=1.5,2.5&z"), ("www.linkedin.com", "/share?url=http%3A%2F%2Fc.com"),
        ("api.twitter.com", "/1?screen_name=bob&x"), ("twitter.com", "bob/status/1"), ("gdata.youtube.com", "/feeds/api/users/amy?x"),
        ("cdn.example.com", "/pic.jpg"), ("cdn.example.com", "/page.html"), (None, "/a.png"),
    ]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, h string, u string")
    found = M.url_fields(F.col("h"), F.col("u"))
    got = df.select("i", *[c.alias(n) for n, c in found.items()]).orderBy("i").collect()
    assert [r.http_social_user for r in got][:1] == ["Dropbox id: 77"]
    assert got[1].facebook_like == "http://a.com" and got[2].facebook_share == "http://b.com"
    assert got[3].http_social_user.endswith("id=123") and got[4].google_maps_location == "1.5%2C2.5"
    assert got[5].linkedin_share == "http://c.com" and got[6].http_social_user.endswith("/bob")
    assert got[7].http_social_user.endswith("/bob") and got[8].http_social_user.endswith("/amy")
    assert [r.http_social_media for r in got[9:]] == ["http://cdn.example.com/pic.jpg", None, None]


def test_text_hash(spark):
    def reference(text):
        h = 0
        for c in text:
            h = (h * 31 + ord(c)) & 0xFFFFFFFF
        return h - (1 << 32) if h >= 1 << 31 else h

    words = ["00:11:22:33:44:55", "", "z", "ff:ff:ff:ff:ff:ff"]
    got = spark.createDataFrame([(w,) for w in words], "w string").select(M.text_hash(F.col("w"))).collect()
    assert [r[0] for r in got] == [reference(w) for w in words]


def test_addresses(spark):
    words = ["10.0.0.1", "255.255.0.3", "2001:db8::1", "::1", "fe80:0:0:0:1:2:3:4", "nonsense"]
    got = [r[0] for r in spark.createDataFrame([(w,) for w in words], "w string").select(D.ip_key(F.col("w"))).collect()]
    assert got[:2] == ["0A000001", "FFFF0003"]
    assert got[2] == "20010DB8" + "0" * 23 + "1" and got[3] == "0" * 31 + "1"
    assert got[4] == "FE80000000000000" + "0001000200030004" and got[5] is None


def test_wide_and_narrow_address_ranges(spark):
    ranges = spark.createDataFrame(
        [("10.0.0.0", "10.0.3.255", "a"), ("11.0.0.0", "13.255.255.255", "b"), ("2001:db8::", "2001:db8:ffff:ffff:ffff:ffff:ffff:ffff", "c"),
         ("2a00::", "2bff:ffff:ffff:ffff:ffff:ffff:ffff:ffff", "d")],
        "first string, last string, c string",
    )
    ips = spark.createDataFrame([("10.0.3.9",), ("10.0.4.0",), ("12.1.1.1",), ("2001:db8:5::1",), ("2b11::1",), ("2c00::",), (None,)], "ip string")
    got = D.ip_ranges(ips, ranges, "ip", {"c": "c"})
    assert [r.c for r in got.collect()].count(None) == 3
    assert {(r.ip, r.c) for r in got.filter("c is not null").collect()} == {("10.0.3.9", "a"), ("12.1.1.1", "b"), ("2001:db8:5::1", "c"), ("2b11::1", "d")}


def test_rejected_mobile_messages(spark):
    texts = [
        "<feed path='/s' type='add'><segment><imsi>1</imsi><apn>web</apn><msisdn>5</msisdn><ipAddress>1.2.3.4</ipAddress><rat>E</rat></segment></feed>",
        "<feed path='/h' type='add'><hnbid>c1</hnbid></feed>", "<notify path='/n' type='add'><imsi>7</imsi></notify>",
        "<feed path='/s' type='remove'><ipAddress>1</ipAddress></feed>", "not xml", "<feed path='/s' type='add'><seg", "<other path='x' type='add'/>",
    ]
    got = messages.parse_mobile(spark.createDataFrame([(x,) for x in texts], "value string")).collect()
    assert [(r.key, r.client_id, r.wireless_station, r.path) for r in got] == [
        ("1.2.3.4", "1", None, None), ("/h", None, "c1", None), ("7", None, None, "/n")
    ]


def test_dwell_against_a_plain_loop(spark):
    random.seed(5)
    data, now = [], 1_700_000_000
    for i in range(600):
        now += random.choice([1, 5, 30, 59, 60, 61, 130, 200, 700, 2500, 4000])
        data.append((i, random.choice("ab"), now, random.choice(["f1", "f2", None]), random.choice(["p1", "p2", None])))
    df = spark.createDataFrame(data, "seq bigint, client_mac string, timestamp bigint, client_floor string, wireless_station string")
    df = df.withColumns({c: F.lit("x") for c in ("client_zone", "client_building", "client_campus")})
    got = R.dwell(df).select("client_mac", "timestamp", "client_floor", "client_floor_old", "client_floor_new", "wireless_station").collect()
    want, state = [], {}
    for _, mac, t, floor, ap in data:
        floor = floor or "unknown"
        old = state.get(mac)
        if old is not None and t - old[0] > 3600:
            old = None
        if old is None:
            want.append((mac, t, None, None, floor, ap))
            state[mac] = (t, floor, ap)
            continue
        gap = t - old[0]
        moved = old[1] != floor or (old[2] is not None and old[2] != ap)
        if 60 < gap <= 1800:
            want += [(mac, old[0] + i * 60, old[1], None, None, old[2]) for i in range(1, 40) if i * 60 < gap - 120]
        if gap > 60 or moved:
            same = old[1] == floor
            want.append((mac, t, floor if same else None, None if same else old[1], None if same else floor, ap))
            state[mac] = (t, floor, ap)
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_late_flows(spark):
    at = 1_705_752_605 + 600  # 12:20:05, past the fifteenth minute
    ends = [at, at - 1800, at - 3599, at - 3700, at + 5000]
    df = spark.createDataFrame([(e,) for e in ends], "timestamp bigint")
    kept = [r[0] for r in df.filter(R.not_late(F.col("timestamp"), F.lit(at).cast("bigint"))).collect()]
    assert kept == [at, at + 5000]


def test_lookup_time_to_live_and_null_keys(spark):
    rows = spark.createDataFrame([(1, "a", 100), (2, "a", 4000), (3, None, 100), (4, "b", 100)], "seq bigint, k string, s bigint")
    state = spark.createDataFrame([(9, "a", 50, "x"), (10, None, 1, "z")], "seq bigint, c string, s bigint, v string")
    timed = lambda d: d.withColumn("ts", F.timestamp_seconds("s"))
    for ttl in (3_600_000, None):
        out = E.lookup(timed(rows), timed(state), "k", "c", ["v"], ttl_ms=ttl).orderBy("seq")
        assert [r.v for r in out.collect()] == ["x", None if ttl else "x", None, None]


def test_lookup_equals_plain_pass(spark):
    df = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("seq", F.col("event_id"))
    left = df.filter("event_type = 'view'")
    right = df.filter("event_type = 'click'").select("ts", "seq", F.col("user_id").alias("u"), F.col("event_id").alias("c"))
    cells = E.lookup(left, right, "user_id", "u", ["c"], ttl_ms=10**12)
    plain = E.lookup(left, right, "user_id", "u", ["c"], ttl_ms=None)
    key = lambda d: sorted(map(str, d.select("event_id", "c").collect()))
    assert key(cells) == key(plain)


def test_unbounded_pairs_and_their_counts(spark):
    left = messages.replay(spark, [("a", 1), ("b", 2), ("a", 3)], "k string, v int").withColumn("seq", F.col("seq") * 2)
    right = messages.replay(spark, [("a", 9), ("a", 8), ("c", 7)], "k string, v int").withColumn("seq", F.col("seq") * 2 + 1)
    timed = lambda d: d.withColumn("ts", F.timestamp_seconds("seq"))
    pairs = J.unbounded_join(timed(left), timed(right), [("k", "k")])
    triggers = pairs.groupBy("_trigger").count().collect()
    counts = J.partner_counts(timed(left), timed(right), [("k", "k")]).groupBy("_side").agg(F.sum("n_partners")).collect()
    assert {tuple(r) for r in triggers} == {tuple(r) for r in counts} == {("left", 2), ("right", 2)}


def test_table_join_without_condition_column(spark):
    check = messages.replay(spark, [("ACME", 1), ("IBM", 2)], "symbol string, v int")
    table = spark.createDataFrame([("ACME", 55), ("IBM", 10)], "s string, volume int")
    assert J.table_join(check, table, [("symbol", "s")]).count() == 2


def test_output_rates_on_five_events(spark):
    df = messages.replay(spark, [("a",), ("b",), ("c",), ("d",), ("e",)], "ip string")
    assert RT.every_events(df, 2, "first").count() == 3
    assert RT.every_events(df, 2, "last").count() == 2
    assert RT.every_events(df, 2).count() == 4


def test_table_versions(spark):
    root = tempfile.mkdtemp(prefix="tidemark-table-")
    table = T.insert(T.define(spark, "k bigint, v string"), spark.createDataFrame([(1, "a"), (2, "b")], "k bigint, v string"))
    T.save(table, root, 0)
    now, version = T.current(spark, root)
    events = messages.replay(spark, [(1, "x"), (1, None), (7, "y")], "k bigint, v string")
    T.save(T.update(now, events, [("k", "k")]), root, version + 1)
    now, version = T.current(spark, root)
    assert version == 1 and {tuple(r) for r in now.collect()} == {(1, None), (2, "b")}
    assert [tuple(r) for r in T.delete(now, events, [("k", "k")]).collect()] == [(2, "b")]
    assert T.delete(now, events, []).count() == 0
    with pytest.raises(TypeError):
        T.insert(now, events)


def test_replay_checks_width(spark):
    with pytest.raises(ValueError):
        messages.replay(spark, [(1, 2)], "a int")


def test_topic_options():
    options = kafka.source_options("h:9092", ["a", "b"], from_start=True, per_trigger=10)
    assert options["subscribe"] == "a,b" and options["startingOffsets"] == "earliest"
    assert options["failOnDataLoss"] == "false" and options["maxOffsetsPerTrigger"] == "10"
    assert kafka.source_options("h:9092", ["a"])["startingOffsets"] == "latest"


def test_student_probability():
    known = [(2.0, 10, 0.07338803477074037), (12.706204736432095, 1, 0.05), (1.959963985, 1e7, 0.05), (0.0, 5, 1.0)]
    got = G.two_sided_p(np.array([k[0] for k in known]), np.array([float(k[1]) for k in known]))
    assert np.allclose(got, [k[2] for k in known], atol=1e-8)


SERIES = (
    "3300,31 2600,18 2500,17 2475,12 2313,8 2175,26 600,14 460,3 240,1 200,10 177,0 140,6 117,1 115,0 2600,19 1907,13 1190,3 "
    "990,16 925,6 365,0 302,10 300,6 129,2 111,1 6100,18 4125,19 3213,1 2319,38 2000,10 1600,0 1394,4 935,4 850,0 775,5 760,6 "
    "629,1 275,6 120,0 2567,12 2500,28 2350,21 2317,3 2000,12 715,1 660,9 650,0 260,0 250,1 200,13 180,6"
)
WAVE = "5.49 6.79 6.46 6.24 5.05 4.92 5.64 7.33 7.55 6.87 6.20 5.79 6.56 6.71 7.41 7.97 6.51 5.95 6.40 7.88 7.92"
MONTHS = "3439 3264 3437 3523 3545 3611 3637 3986 3797 3758 4428 8566 3801 3204 3686 3827 3770 3923 3839 4270 3988 3920 4853 9010"


def test_regression_on_known_series(spark):
    pairs = [tuple(map(float, p.split(","))) for p in SERIES.split()]
    df = messages.replay(spark, pairs, "y double, x double")
    last = G.forecast(df, F.col("x") + 2, "y", "x").orderBy(F.desc("seq")).first()
    assert abs(last.beta0 - 573.1418421169493) < 1e-6
    marked = G.outlier(df, 1.0, "y", "x").orderBy("seq").collect()
    assert marked[2].outlier is None and marked[3].outlier is not None
    assert abs(marked[-1].beta0 - 573.1418421169493) < 1e-6


def test_regression_seasons(spark):
    wave = messages.replay(spark, [(float(v), float(i)) for i, v in enumerate(WAVE.split())], "y double, x double")
    fit = G.regress(wave.withColumn("z", S.sine(F.col("x"))), "y", ["x", "z"], batch=1000).orderBy(F.desc("seq")).first()
    assert abs(fit.beta0 - 5.661764084669217) < 1e-6
    months = messages.replay(spark, [(float(v), float(i % 12 == 11)) for i, v in enumerate(MONTHS.split())], "y double, x double")
    fit = G.regress(months, "y", ["x"], batch=1000).orderBy(F.desc("seq")).first()
    assert abs(fit.beta0 - 3795.7272727272725) < 1e-6


def test_regression_refreshes_every_interval(spark):
    pairs = [tuple(map(float, p.split(","))) for p in SERIES.split()]
    df = messages.replay(spark, pairs, "y double, x double")
    got = [r.stdError for r in G.regress(df, "y", ["x"], interval=7).orderBy("seq").collect()]
    full = [r.stdError for r in G.regress(df, "y", ["x"]).orderBy("seq").collect()]
    assert got[:6] == [None] * 6
    assert np.allclose(got[6:], [full[i - i % 7 - 1] for i in range(7, 51)])


@pytest.mark.parametrize("side", [None, "left", "right"])
def test_length_join_against_a_plain_loop(spark, side):
    random.seed(9)
    rows = [(i, random.choice("lr"), random.choice("ab")) for i in range(120)]
    df = spark.createDataFrame(rows, "seq bigint, s string, k string").withColumn("ts", F.timestamp_seconds("seq"))
    left, right = df.filter("s = 'l'"), df.filter("s = 'r'")
    out = J.length_join(left, right, 4, 7, equal=[("k", "k")], unidirectional=side)
    want, seen = [], {"l": [], "r": []}
    for i, s, k in rows:
        live = seen["r"][-7:] if s == "l" else seen["l"][-4:]
        if side is None or side[0] == s:
            want += [(i, j, "left") if s == "l" else (j, i, "right") for j, k2 in live if k2 == k]
        seen[s].append((i, k))
    assert sorted(map(tuple, out.select("l_seq", "r_seq", "_trigger").collect())) == sorted(want)


@pytest.mark.parametrize("how", ["inner", "left", "right", "full"])
@pytest.mark.parametrize("side", ["left", "right"])
def test_unidirectional_outer_joins_at_equal_times(spark, side, how):
    """Three rows share every time, so the sequence number decides which of two is the trigger."""
    rng = random.Random(12)
    rows = [(i, rng.choice("lr"), rng.choice("ab")) for i in range(90)]
    df = spark.createDataFrame(rows, "seq bigint, s string, k string").withColumn("ts", F.timestamp_seconds(F.floor(F.col("seq") / 3)))
    out = J.time_join(df.filter("s = 'l'"), df.filter("s = 'r'"), 3000, 5000, equal=[("k", "k")], unidirectional=side, how=how)
    lefts, rights = [r for r in rows if r[1] == "l"], [r for r in rows if r[1] == "r"]
    apart = lambda a, b: b[0] // 3 - a[0] // 3
    near = [(a[0], b[0]) for a in lefts for b in rights if a[2] == b[2] and -5 < apart(a, b) < 3]
    want = [(a, b) for a, b in near if (a > b) == (side == "left")]
    if how in ("left", "full"):
        want += [(a[0], None) for a in lefts if a[0] not in {p for p, _ in want}]
    if how in ("right", "full"):
        want += [(None, b[0]) for b in rights if b[0] not in {q for p, q in want if p is not None}]
    assert sorted(map(tuple, out.select("l_seq", "r_seq").collect()), key=str) == sorted(want, key=str)


def test_shared_lookups_equal_single_ones(spark):
    df = spark.read.parquet(f"{SF}/events.parquet").withColumn("ts", F.col("ts").cast("timestamp")).withColumn("seq", F.col("event_id"))
    pick = lambda kind, out: df.filter(F.col("event_type") == kind).select("ts", "seq", "user_id", F.col("event_id").alias(out))
    a, b = pick("click", "a"), pick("signup", "b")
    rows = df.filter("event_type = 'view'").select("event_id", "ts", "seq", "user_id")
    both = E.lookups(rows, "user_id", [E.State(a, "user_id", {"a": "a"}), E.State(b, "user_id", {"b": "b"}, "hit")], ttl_ms=3 * W.DAY)
    one = E.lookup(E.lookup(rows, a, "user_id", "user_id", ["a"], ttl_ms=3 * W.DAY), b, "user_id", "user_id", ["b"], ttl_ms=3 * W.DAY)
    assert sorted(map(str, both.select("event_id", "a", "b").collect())) == sorted(map(str, one.select("event_id", "a", "b").collect()))
    assert both.filter("hit <> (b is not null)").count() == 0


def test_a_half_written_version_is_not_read(spark):
    root = tempfile.mkdtemp(prefix="tidemark-table-")
    with pytest.raises(FileNotFoundError):
        T.current(spark, root)
    table = spark.createDataFrame([(1, "a")], "k bigint, v string")
    T.save(table, root, 0)
    T.save(spark.createDataFrame([(2, "b")], "k bigint, v string"), root, 3)
    os.remove(f"{root}/version=3/_SUCCESS")
    now, version = T.current(spark, root)
    assert version == 0 and [tuple(r) for r in now.collect()] == [(1, "a")]


def test_overlapping_ranges_have_one_rule(spark):
    ranges = spark.createDataFrame(
        [("2001::", "2001:ffff::", "wide"), ("2001:5::", "2001:6::", "narrow"), ("2002:5::", "2002:6::", "before"), ("2002:5:1::", "2003::", "after")],
        "first string, last string, name string",
    )
    rows = spark.createDataFrame([("2001:5::1",), ("2001:9::1",), ("2002:5:2::",)], "ip string")
    found = {r["ip"]: r["name"] for r in D.ip_ranges(rows, ranges, "ip", {"name": "name"}).collect()}
    assert found == {"2001:5::1": "narrow", "2001:9::1": "wide", "2002:5:2::": "after"}


def test_regression_batches_are_taken_as_asked(spark):
    rows = [(float(i * i % 17), float(i), i) for i in range(40)]
    df = spark.createDataFrame(rows, "y double, x double, seq long").withColumn("ts", F.timestamp_seconds("seq"))
    whole = [r["beta1"] for r in G.regress(df, "y", ["x"], ci=0.0).orderBy("seq").collect()]
    large = [r["beta1"] for r in G.regress(df, "y", ["x"], ci=0.0, batch=2_000_000_000).orderBy("seq").collect()]
    assert np.allclose(whole, large)


def _sorted_changes(rows, n, by):
    """The sort window, one row after another."""
    kept, out = [], []
    for row in sorted(rows, key=lambda r: (r["us"], r["seq"])):
        kept.append(row)
        key = lambda r: ([(r[c] is None, r[c] if up or r[c] is None else W._Falling(r[c])) for c, up in by], r["us"], r["seq"])
        kept.sort(key=key)
        if len(kept) > n:
            out.append(("expired", kept.pop()["seq"]))
        out.append(("current", row["seq"]))
    return sorted(out)


@pytest.mark.parametrize("by", [[("name", False), ("big", True)], [("big", False)], [("at", True)], [("name", True)]])
@pytest.mark.parametrize("ranges", [1, 6])
def test_sort_window_of_any_type(spark, by, ranges):
    import datetime

    rng = random.Random(7)
    rows = []
    for i in range(60):
        us = (i - 30) * 1_000_000 + 123_456  # before and after 1970
        big = None if i % 9 == 0 else 9_007_199_254_740_990 + rng.randint(0, 5)
        name = None if i % 7 == 0 else rng.choice(["ant", "Bee", "cat", "ému"])
        at = None if i % 11 == 0 else datetime.datetime(1969, 12, 31, 23, 59, 59, rng.randint(0, 999_999))
        rows.append({"us": us, "seq": i, "big": big, "name": name, "at": at, "tags": ["x", None], "amount": i / 7})
    schema = "us long, seq long, big long, name string, at timestamp_ntz, tags array<string>, amount double"
    df = spark.createDataFrame([tuple(r.values()) for r in rows], schema).withColumn("ts", F.timestamp_micros("us"))
    split = None
    if ranges > 1:
        split = plan_split(W.arrivals(df), [], W.ARRIVAL_ORDER, rows_per_range=10)
    found = W.sort_window(df, 4, by, split=split).collect()
    assert sorted((r["_kind"], r["seq"]) for r in found) == _sorted_changes(rows, 4, by)
    same = {r["seq"]: r for r in rows}
    assert all(r["at"] == same[r["seq"]]["at"] and r["big"] == same[r["seq"]]["big"] and r["tags"] == ["x", None] for r in found)
    assert {r["ts"].microsecond for r in found} == {123_456}


@pytest.mark.parametrize("op", ["<", "<=", ">", ">="])
def test_update_and_delete_with_an_inequality(spark, op):
    rng = random.Random(3)
    table_rows = [(k, a, "old") for k in range(6) for a in [*range(0, 12, 2), None]]
    event_rows = [(rng.randrange(5), rng.choice([None, *range(12)]), f"new{i}", i) for i in range(40)]
    table = spark.createDataFrame(table_rows, "k long, a long, v string")
    events = spark.createDataFrame(event_rows, "ek long, b long, v string, seq long").withColumn("ts", F.timestamp_seconds("seq"))
    holds = {"<": lambda a, b: a < b, "<=": lambda a, b: a <= b, ">": lambda a, b: a > b, ">=": lambda a, b: a >= b}[op]
    hits = lambda k, a: [e for e in event_rows if e[0] == k and a is not None and e[1] is not None and holds(a, e[1])]
    want = sorted(((k, a, hits(k, a)[-1][2] if hits(k, a) else v) for k, a, v in table_rows), key=str)
    found = T.update_theta(table, events, [("k", "ek")], "a", op, "b")
    assert sorted((tuple(r) for r in found.collect()), key=str) == want
    left = T.delete_theta(table, events, "a", op, "b", [("k", "ek")])
    assert sorted((tuple(r) for r in left.collect()), key=str) == sorted((r for r in table_rows if not hits(*r[:2])), key=str)
    with pytest.raises(ValueError):
        T.update_theta(table, events, [], "a", op, "b")
    with pytest.raises(ValueError):
        J.table_join(table, events, [])


def test_message_keys(spark):
    rows = spark.createDataFrame([(1, "a", "t1"), (2, None, None)], "id int, name string, topic string")
    plain = messages.to_messages(rows.drop("topic"), "all", key="id").collect()
    assert [tuple(r) for r in plain] == [("all", "1", '{"id":1,"name":"a"}'), ("all", "2", '{"id":2}')]
    routed = messages.to_messages(rows, route="topic", key="name").collect()
    assert [tuple(r) for r in routed] == [("t1", "a", '{"id":1,"name":"a"}')]


def test_flow_slices_against_a_loop(spark):
    """Whole parts of every minute, the rest in the last slice; flows of one second, of no time and without a start."""
    rng, now = random.Random(4), 1_700_000_000
    data = [(i, now - rng.randrange(40, 900), rng.randrange(0, 700), rng.randrange(5000), rng.randrange(9)) for i in range(150)]
    flows = [(i, s, s + d if i % 10 else s, b, p) for i, s, d, b, p in data]
    flows += [(900, None, now, 7, None), (901, now - 50, now - 20, None, 3), (902, now - 100, now - 160, 50, 5)]
    df = spark.createDataFrame(flows, "id long, first_switched long, timestamp long, bytes long, pkts long")
    limit = now - now // 60 % 60 * 60 - (3600 if now // 60 % 60 < R.LATE_MINUTES else 0)
    want = []
    for i, start, end, *counters in flows:
        if start is None:
            want.append((i, end, *counters))
            continue
        start, counters = max(start, limit), [c or 0 for c in counters]
        if end > now and (end // 3600 % 24 != start // 3600 % 24 or end - now > 3600):
            start, end = min(start, now), now
        total, base = end - start, start // 60 * 60
        cuts = [start, *range(base + 60, end, 60), end]
        parts = [[c if not total else int(c * (b - a) / total) for a, b in zip(cuts, cuts[1:])] for c in counters]
        for got, c in zip(parts, counters):
            full = c - sum(got[:-1])
            got[-1] = full if full > 0 else got[-1]
        want += [(i, stop, *both) for stop, *both in zip(cuts[1:], *parts)]
    got = [tuple(r) for r in R.split_flow(df, F.lit(now).cast("bigint")).select("id", "timestamp", "bytes", "pkts").collect()]
    assert sorted(got, key=str) == sorted(want, key=str)
