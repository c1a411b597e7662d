"""Patterns and sequences on small literal streams with known results."""

import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from tidemark.operators import patterns as P

cloudpickle.register_pickle_by_value(sys.modules[__name__])

STOCK = "stream string, symbol string, price double, volume int"


def feed(spark, rows):
    data = [(*r, i) for i, r in enumerate(rows)]
    return spark.createDataFrame(data, STOCK + ", seq bigint").withColumn(
        "ts", F.timestamp_millis(F.col("seq") * 500 + 1_700_000_000_000)
    )


def s(stream, cond=None):
    base = F.col("stream") == stream
    return base if cond is None else base & cond


def got(df, *names):
    def value(v):
        if isinstance(v, list):
            return [x["price"] for x in v]
        return None if v is None else v["price"]

    return sorted(([value(r[n]) for n in names] for r in df.collect()), key=str)




def price(low):
    return F.col("price") > low


def above_e1(event, match):
    return event["price"] > match["e1"]["price"]


def test_followed_by_matches_once(spark):
    df = feed(spark, [("1", "ACME", 55.6, 100), ("1", "GOOG", 55.6, 100), ("2", "IBM", 55.7, 100)])
    parts = [P.step("e1", s("1", price(20))), P.step("e2", s("2"), above_e1)]
    out = P.pattern(df, parts, ["symbol", "price"]).collect()
    assert [(r.e1.symbol, r.e2.symbol) for r in out] == [("ACME", "IBM")]


def test_every_start_is_closed_by_one_event(spark):
    df = feed(spark, [("1", "ACME", 55.6, 100), ("1", "GOOG", 54.0, 100), ("2", "IBM", 57.7, 100)])
    parts = [P.step("e1", s("1", price(20))), P.step("e2", s("2"), above_e1)]
    out = P.pattern(df, parts, ["price"], every=True, within_ms=60_000)
    assert got(out, "e1", "e2") == [[54.0, 57.7], [55.6, 57.7]]
    plain = P.chain(df, [("e1", s("1")), ("e2", s("2"))], ["price"], every=True)
    assert got(plain, "e1", "e2") == [[54.0, 57.7], [55.6, 57.7]]


def test_every_group(spark):
    rows = [("1", "W", 55.6, 100), ("1", "G", 54.0, 100), ("1", "W", 53.6, 100), ("1", "G", 53.0, 100), ("2", "I", 57.7, 100)]
    df = feed(spark, rows).withColumn("k", F.lit(1))
    parts = [P.step("e1", s("1", price(20))), P.step("e3", s("1", price(20))), P.step("e2", s("2"), above_e1)]
    out = P.pattern(df, parts, ["price"], keys=["k"], every=(0, 1))
    assert got(out, "e1", "e3", "e2") == [[53.6, 53.0, 57.7], [55.6, 54.0, 57.7]]
    with pytest.raises(ValueError):
        P.pattern(df, parts, ["price"], every=(0, 1))


def test_count(spark):
    rows = [("1", "W", 25.6, 1), ("1", "G", 47.6, 1), ("1", "G", 13.7, 1), ("1", "G", 47.8, 1), ("2", "I", 45.7, 1), ("2", "I", 55.7, 1)]
    parts = [P.count(P.step("e1", s("1", price(20))), 2, 5), P.step("e2", s("2", price(20)))]
    assert got(P.pattern(feed(spark, rows), parts, ["price"]), "e1", "e2") == [[[25.6, 47.6, 47.8], 45.7]]


def test_count_zero_passes_through(spark):
    rows = [("2", "I", 45.7, 1), ("1", "W", 25.6, 1)]
    parts = [P.count(P.step("e1", s("1", price(20))), 0, 5), P.step("e2", s("2", price(20)))]
    assert got(P.pattern(feed(spark, rows), parts, ["price"]), "e1", "e2") == [[[], 45.7]]


def test_count_condition_on_second_event(spark):
    rows = [("1", "W", 25.6, 1), ("1", "G", 47.6, 1), ("2", "I", 45.7, 1), ("2", "I", 55.7, 1)]
    second = lambda e, m: len(m["e1"]) > 1 and e["price"] > m["e1"][1]["price"]
    parts = [P.count(P.step("e1", s("1", price(20))), 2, 5), P.step("e2", s("2"), second)]
    assert got(P.pattern(feed(spark, rows), parts, ["price"]), "e1", "e2") == [[[25.6, 47.6], 55.7]]


def test_logic(spark):
    one = [("1", "W", 55.6, 1), ("2", "I", 72.7, 1)]
    e1, e2, e3 = P.step("e1", s("1")), P.step("e2", s("2"), above_e1), P.step("e3", s("2"))
    assert got(P.pattern(feed(spark, one), [e1, P.either(e2, e3)], ["price"]), "e1", "e2", "e3") == [[55.6, None, 72.7]]
    assert got(P.pattern(feed(spark, one), [e1, P.both(e2, e3)], ["price"]), "e1", "e2", "e3") == [[55.6, 72.7, 72.7]]
    two = [("1", "W", 55.6, 1), ("2", "G", 72.7, 1), ("2", "I", 4.7, 1)]
    low = P.step("e3", s("2", F.col("symbol") == "I"))
    assert got(P.pattern(feed(spark, two), [e1, P.both(e2, low)], ["price"]), "e1", "e2", "e3") == [[55.6, 72.7, 4.7]]


def test_within_drops_old_starts(spark):
    df = feed(spark, [("1", "ACME", 55.6, 1), ("x", "X", 1.0, 1), ("x", "X", 1.0, 1), ("1", "GOOG", 54.0, 1), ("2", "IBM", 57.7, 1)])
    parts = [P.step("e1", s("1")), P.step("e2", s("2"), above_e1)]
    out = P.pattern(df, parts, ["symbol", "price"], every=True, within_ms=1000).collect()
    assert [(r.e1.symbol, r.e2.symbol) for r in out] == [("GOOG", "IBM")]


def test_sequence_star_first(spark):
    rows = [("1", "W", 59.6, 1), ("2", "G", 55.6, 1), ("2", "G", 55.7, 1), ("1", "W", 57.6, 1)]
    later = lambda e, m: bool(m["e1"]) and e["price"] > m["e1"][0]["price"]
    parts = [P.star(P.step("e1", s("2", price(20)))), P.step("e2", s("1"), later)]
    assert got(P.sequence(feed(spark, rows), parts, ["price"]), "e1", "e2") == [[[55.6, 55.7], 57.6], [[55.7], 57.6]]
    parts = [P.optional(P.step("e1", s("2", price(20)))), P.step("e2", s("1"), later)]
    assert got(P.sequence(feed(spark, rows), parts, ["price"]), "e1", "e2") == [[[55.7], 57.6]]


def test_sequence_star_last(spark):
    rows = [("1", "W", 55.6, 1), ("1", "I", 55.7, 1)]
    parts = [P.step("e1", s("1", price(20))), P.star(P.step("e2", s("2")))]
    assert got(P.sequence(feed(spark, rows), parts, ["price"]), "e1", "e2") == [[55.6, []], [55.7, []]]


def test_sequence_plus(spark):
    rows = [("1", "W", 59.6, 1), ("2", "G", 55.6, 1), ("1", "W", 57.6, 1)]
    later = lambda e, m: e["price"] > m["e1"][0]["price"]
    parts = [P.plus(P.step("e1", s("2", price(20)))), P.step("e2", s("1"), later)]
    assert got(P.sequence(feed(spark, rows), parts, ["price"]), "e1", "e2") == [[[55.6], 57.6]]


def test_sequence_or(spark):
    rows = [("1", "W", 59.6, 1), ("2", "G", 55.6, 1), ("2", "IBM", 55.7, 1), ("2", "W", 57.6, 1)]
    e2 = P.step("e2", s("2"), above_e1)
    parts = [P.step("e1", s("2", price(20))), P.either(e2, P.step("e3", s("2", F.col("symbol") == "IBM")))]
    assert got(P.sequence(feed(spark, rows), parts, ["price"]), "e1", "e2", "e3") == [[55.6, None, 55.7], [55.7, 57.6, None]]


def test_sequence_rising_run(spark):
    rows = [("1", "W", 29.6, 1), ("1", "W", 35.6, 1), ("1", "W", 57.6, 1), ("1", "W", 47.6, 1)]

    def rising(e, m):
        run = m["e2"][:-1]
        return e["price"] > (run[-1] if run else m["e1"])["price"]

    parts = [
        P.step("e1", s("1", price(20))),
        P.plus(P.step("e2", s("1"), rising)),
        P.step("e3", s("1"), lambda e, m: e["price"] <= m["e2"][-1]["price"]),
    ]
    out = got(P.sequence(feed(spark, rows), parts, ["price"]), "e1", "e2", "e3")
    assert [29.6, [35.6, 57.6], 47.6] in out


def test_strict_equals_sequence(spark):
    rows = [("1", "a", 1.0, 1), ("2", "b", 2.0, 1), ("2", "c", 3.0, 1), ("1", "d", 4.0, 1), ("2", "e", 5.0, 1), ("2", "f", 6.0, 1)]
    df = feed(spark, rows)
    quick = P.strict(df, [("e1", s("1")), ("e2", s("2")), ("e3", s("2"))], ["price"])
    slow = P.sequence(df, [P.step("e1", s("1")), P.step("e2", s("2")), P.step("e3", s("2"))], ["price"])
    assert got(quick, "e1", "e2", "e3") == got(slow, "e1", "e2", "e3") == [[1.0, 2.0, 3.0], [4.0, 5.0, 6.0]]


def test_partitioned_sequence(spark):
    rows = [("1", "IBM", 75.6, 105), ("1", "GOOG", 51.0, 101), ("1", "IBM", 76.6, 111), ("2", "IBM", 20.0, 0), ("2", "GOOG", 20.0, 0)]
    parts = [P.step("e1", s("1", price(20))), P.step("e2", s("2"))]
    assert got(P.sequence(feed(spark, rows), parts, ["price"], keys=["symbol"]), "e1", "e2") == [[51.0, 20.0], [76.6, 20.0]]


@pytest.mark.parametrize("every", [True, False])
def test_pair_under_a_bound_does_not_depend_on_where_the_rows_lie(spark, every):
    """The pair is not under the bound; shifting all rows gives the same matches."""
    steps = [("a", 0), ("b", 1), ("c", 25), ("a", 26), ("x", 27), ("c", 28), ("b", 70)]
    found = set()
    for shift in range(0, 50, 7):
        rows = [(1, kind, 1_700_000_000_000_000 + (shift + s) * 1_000_000, i) for i, (kind, s) in enumerate(steps)]
        df = spark.createDataFrame(rows, "k int, kind string, us long, seq long").withColumn("ts", F.timestamp_micros("us"))
        is_ = lambda kind: F.col("kind") == kind
        parts = [P.step("e1", is_("a")), P.both(P.step("e2", is_("b")), P.step("e3", is_("c")))]
        out = P.pattern(df, parts, ["seq"], keys=["k"], every=every, within_ms=10_000)
        found.add(tuple(sorted((r["e1"]["seq"], r["e2"]["seq"], r["e3"]["seq"]) for r in out.collect())))
    assert found == {((0, 1, 2), (3, 6, 5)) if every else ((0, 1, 2),)}
