"""Streams give the batch results: the same rows replayed in several micro-batches."""

import sys
import tempfile
import time
from pathlib import Path

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.operators import enrich as E
from tidemark.operators import joins as J
from tidemark.operators import patterns as P
from tidemark.operators import records as R
from tidemark.operators import rollup as U
from tidemark.operators import tables as T
from tidemark.operators import windows as W
from tidemark.streaming import operators as S
from tidemark.streaming import sinks

cloudpickle.register_pickle_by_value(sys.modules[__name__])


@pytest.fixture(scope="module")
def events(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    return df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("seq", F.col("event_id"))


@pytest.fixture(scope="module")
def folder(spark, events):
    """Events in five files, in time order."""
    root = tempfile.mkdtemp(prefix="tidemark-stream-")
    for i in range(5):
        events.filter((F.col("event_id") >= i * 200) & (F.col("event_id") < (i + 1) * 200)).coalesce(1).write.mode(
            "append"
        ).parquet(root)
        time.sleep(1.1)
    return root


@pytest.fixture
def stream(spark, events, folder):
    def open_stream():
        return (
            spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(folder)
        )

    return open_stream


def run(df):
    root = Path(tempfile.mkdtemp(prefix="tidemark-out-"))
    return sinks.run_available(df, str(root / "data"), str(root / "ckpt"))


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


def test_time_batches(stream, events):
    out = run(S.time_batches(stream(), W.DAY, {"n": F.count(F.lit(1))}, ["event_type"], delay="1 minute"))
    whole = W.batches_by_time(events, W.DAY).groupBy("_batch", "event_type").agg(F.count(F.lit(1)).alias("n"))
    last = whole.agg(F.max("_batch")).first()[0]
    assert rows(out, "_batch", "event_type", "n") == rows(whole.filter(F.col("_batch") < last), "_batch", "event_type", "n")


def test_first_unique(stream, events):
    out = run(S.first_unique(stream(), ["user_id"]))
    assert rows(out, "user_id", "event_id") == rows(W.first_unique(events, ["user_id"]), "user_id", "event_id")


def test_time_join(stream, events):
    kinds = lambda d, k: d.filter(F.col("event_type") == k).select("event_id", "ts", "seq", "user_id")
    pair = [("user_id", "user_id")]
    out = run(S.time_join(kinds(stream(), "view"), kinds(stream(), "purchase"), 6 * W.HOUR, 12 * W.HOUR, pair, delay="10 days"))
    batch = J.time_join(kinds(events, "view"), kinds(events, "purchase"), 6 * W.HOUR, 12 * W.HOUR, equal=pair)
    found = rows(out, "l_event_id", "r_event_id")
    assert found == rows(batch, "l_event_id", "r_event_id") and found


def test_lookup(stream, events):
    def parts(d):
        left = d.filter("event_type = 'view'").select("event_id", "ts", "seq", F.when(F.col("event_id") % 7 > 0, F.col("user_id")).alias("user_id"))
        right = d.filter("event_type = 'signup'").select("ts", "seq", F.col("user_id").alias("k"), F.col("event_id").alias("s_id"))
        return left, right

    left, right = parts(stream())
    out = run(S.lookup(left, right, "user_id", "k", ["s_id"], ttl_ms=2 * W.DAY, delay="30 days"))
    l, r = parts(events)
    batch = E.lookup(l, r, "user_id", "k", ["s_id"], ttl_ms=2 * W.DAY)
    assert rows(out, "event_id", "s_id") == rows(batch, "event_id", "s_id")


def steps():
    kind = F.col("event_type")
    return [
        P.step("e1", kind == "error"),
        P.step("e2", kind == "purchase", lambda e, m: e["value"] > m["e1"]["value"]),
    ]


def test_pattern(stream, events):
    options = {"keys": ["user_id"], "within_ms": 3 * W.DAY}
    out = run(S.pattern(stream(), steps(), ["event_id", "value"], every=True, delay="10 days", **options))
    batch = P.pattern(events, steps(), ["event_id", "value"], every=True, **options)
    found = rows(out, "e1.event_id", "e2.event_id")
    assert found == rows(batch, "e1.event_id", "e2.event_id") and found
    with pytest.raises(ValueError):
        S.pattern(stream(), steps(), ["event_id"], keys=["user_id"], within_ms=None)


def test_sequence(stream, events):
    kind = F.col("event_type")
    parts = [P.plus(P.step("e1", kind == "error")), P.step("e2", kind == "purchase")]
    options = {"keys": ["user_id"], "within_ms": 30 * W.DAY}
    out = run(S.sequence(stream(), parts, ["event_id"], delay="10 days", **options))
    batch = P.sequence(events, parts, ["event_id"], **options)
    found = rows(out, F.size("e1"), "e2.event_id")
    assert found == rows(batch, F.size("e1"), "e2.event_id") and found


def test_length_changes(stream, events):
    cols = ["event_id", "ts", "seq", "user_id"]
    out = run(S.window_changes(stream().select(*cols), keys=["user_id"], length=3))
    batch = W.length(events.select(*cols), 3, keys=["user_id"])
    assert rows(out, "event_id", "_kind", "_at") == rows(batch, "event_id", "_kind", "_at")


def test_time_changes(stream, events):
    cols = ["event_id", "ts", "seq", "user_id"]
    out = run(S.window_changes(stream().select(*cols), keys=["user_id"], millis=W.DAY, delay="1 minute"))
    batch = {tuple(r) for r in W.time(events.select(*cols), W.DAY).select("event_id", "_kind", "_at").collect()}
    found = rows(out, "event_id", "_kind", "_at")
    assert len(found) == len(set(found)) and set(found) <= batch
    current = [r for r in found if r[1] == "current"]
    gone = [r for r in found if r[1] == "expired"]
    assert len(current) == 1000 and len(gone) > 900


def moves(d):
    return d.select(
        "event_id", "seq", F.col("user_id").alias("client_mac"), F.col("event_type").alias("client_floor"),
        F.lit("z").alias("client_zone"), F.lit("b").alias("client_building"), F.lit("c").alias("client_campus"),
        F.concat(F.lit("ap"), F.col("event_id") % 2).alias("wireless_station"), F.lit("s").alias("sensor_name"),
        (F.floor((F.unix_seconds("ts") - 1_704_067_200) / 900) + 1_700_000_000).cast("bigint").alias("timestamp"),
    )


def test_dwell(stream, events):
    out = run(S.dwell(moves(stream()), delay="30 days"))
    batch = R.dwell(moves(events))
    cols = ("client_mac", "timestamp", "client_floor_old", "client_floor_new", "client_floor", "wireless_station")
    found = rows(out, *cols)
    assert found == rows(batch, *cols)
    assert len(found) > 300


def test_rollup(stream, events):
    def flows(d):
        return d.select(
            F.unix_seconds("ts").alias("timestamp"), F.col("event_type").alias("application_id_name"),
            F.col("event_id").alias("bytes"), F.lit(1).alias("pkts"),
        )

    out = run(U.flows(flows(stream())))
    batch = U.flows(flows(events))
    end = out.agg(F.max("minute")).first()[0]
    cols = ("minute", "application_id_name", "events", "sum_bytes", "sum_pkts")
    assert rows(out, *cols) == rows(batch.filter(F.col("minute") <= end), *cols)
    assert out.count() > 900


def test_upsert_latest(spark, stream, events):
    root = tempfile.mkdtemp(prefix="tidemark-upsert-")
    sinks.upsert_latest(stream(), "user_id", ["event_type"], f"{root}/t", f"{root}/c").awaitTermination()
    table, version = T.current(spark, f"{root}/t")
    assert version == 4
    assert rows(table, "user_id", "event_type") == rows(W.latest(events, ["user_id"]), "user_id", "event_type")


def test_write_section_batch(spark, events):
    root = tempfile.mkdtemp(prefix="tidemark-section-")
    rowset = events.select(F.unix_seconds("ts").alias("timestamp"), F.col("event_type").alias("action"))
    sinks.write_section(rowset, "event", path=root)
    back = spark.read.parquet(root)
    assert back.agg(F.sum("events")).first()[0] == 1000
    assert back.filter("hour = floor(minute / 3600) * 3600").count() == back.count()


# --- rows that arrive out of order --------------------------------------------------------------

DELAY_DAYS = 12


@pytest.fixture(scope="module")
def shuffled(spark, events):
    """Events in five files; a row lies up to 150 places from where its time puts it. Returns an opener and the last watermark."""
    root = tempfile.mkdtemp(prefix="tidemark-shuffled-")
    place = F.col("event_id") + F.pmod(F.xxhash64("event_id"), F.lit(300)) - 150
    cell = F.least(F.greatest(F.floor(place / 200), F.lit(0)), F.lit(4))
    for i in range(5):
        events.filter(cell == i).orderBy(F.xxhash64("seq")).coalesce(1).write.mode("append").parquet(root)
        time.sleep(1.1)

    def open_stream():
        return spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(root)

    return open_stream


def passed(rows, of):
    """Rows older than the watermark when the input ends."""
    newest = of.agg(F.max(F.unix_millis("ts"))).first()[0] - DELAY_DAYS * W.DAY
    return rows.filter(F.unix_millis("ts") < newest)


OPTIONS = {"delay": f"{DELAY_DAYS} days", "ordered": True}


def test_shuffled_lookup(shuffled, events):
    def parts(d):
        left = d.filter("event_type = 'view'").select("event_id", "ts", "seq", "user_id")
        right = d.filter("event_type = 'signup'").select("ts", "seq", F.col("user_id").alias("k"), F.col("event_id").alias("s_id"))
        return left, right

    left, right = parts(shuffled())
    out = run(S.lookup(left, right, "user_id", "k", ["s_id"], ttl_ms=2 * W.DAY, **OPTIONS))
    l, r = parts(events)
    batch = passed(E.lookup(l, r, "user_id", "k", ["s_id"], ttl_ms=2 * W.DAY), events.filter("event_type in ('view', 'signup')"))
    found = rows(out, "event_id", "s_id", "ts")
    assert found == rows(batch, "event_id", "s_id", "ts") and len(found) > 50


def test_shuffled_pattern_and_sequence(shuffled, events):
    options = {"keys": ["user_id"], "within_ms": 3 * W.DAY}
    out = run(S.pattern(shuffled(), steps(), ["event_id", "value"], every=True, **OPTIONS, **options))
    kinds = events.filter("event_type in ('error', 'purchase')")
    batch = P.pattern(passed(events, kinds), steps(), ["event_id", "value"], every=True, **options)
    found = rows(out, "e1.event_id", "e2.event_id")
    assert found == rows(batch, "e1.event_id", "e2.event_id") and found
    kind = F.col("event_type")
    parts = [P.plus(P.step("e1", kind == "error")), P.step("e2", kind == "purchase")]
    options = {"keys": ["user_id"], "within_ms": 30 * W.DAY}
    out = run(S.sequence(shuffled(), parts, ["event_id"], **OPTIONS, **options))
    batch = P.sequence(passed(events, events), parts, ["event_id"], **options)
    found = rows(out, F.size("e1"), "e2.event_id")
    assert found == rows(batch, F.size("e1"), "e2.event_id") and found


def test_shuffled_changes(shuffled, events):
    cols = ["event_id", "ts", "seq", "user_id"]
    out = run(S.window_changes(shuffled().select(*cols), keys=["user_id"], length=3, **OPTIONS))
    batch = W.length(passed(events, events).select(*cols), 3, keys=["user_id"])
    assert rows(out, "event_id", "_kind", "_at") == rows(batch, "event_id", "_kind", "_at")
    out = run(S.window_changes(shuffled().select(*cols), keys=["user_id"], millis=W.DAY, **OPTIONS))
    kept = passed(events, events).select(*cols)
    found = rows(out, "event_id", "_kind", "_at")
    whole = {tuple(r) for r in W.time(kept, W.DAY).select("event_id", "_kind", "_at").collect()}
    assert len(found) == len(set(found)) and set(found) <= whole
    assert sum(r[1] == "current" for r in found) == kept.count()


def test_shuffled_dwell(shuffled, events):
    stamped = lambda d: moves(d.withColumn("ts", F.col("ts")))
    # A quarter of an hour of events is a second there: the delay shrinks with it.
    out = run(S.dwell(stamped(shuffled()), delay=f"{DELAY_DAYS * 96} seconds", ordered=True))
    source = stamped(events)
    newest = source.agg(F.max("timestamp")).first()[0] - DELAY_DAYS * 96
    batch = R.dwell(source.filter(F.col("timestamp") < newest))
    cols = ("client_mac", "timestamp", "client_floor_old", "client_floor_new", "client_floor", "wireless_station")
    found = rows(out, *cols)
    assert found == rows(batch, *cols) and len(found) > 100
