"""Ranges of hot groups give the same results as plain windows, and plans stay distributed."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import SF
from tidemark.operators import aggregates as A
from tidemark.operators import patterns as P
from tidemark.operators import windows as W
from tidemark.ordering import Run, Split, neighbour, plan_split, running

ORDER = ("_t", "_s")


@pytest.fixture(scope="module")
def events(spark):
    """Two thirds of the rows belong to one key; some rows share one time."""
    df = spark.read.parquet(f"{SF}/events.parquet")
    df = df.withColumn("ts", F.col("ts").cast("timestamp")).withColumn("seq", F.col("event_id"))
    key = F.when(F.col("event_id") % 3 > 0, F.lit("hot")).when(F.col("event_id") % 30 == 0, None).otherwise(F.col("event_type"))
    same = F.when(F.col("event_id").between(300, 420), F.lit("2024-01-10").cast("timestamp")).otherwise(F.col("ts"))
    return df.withColumns({"k": key, "ts": same, "cents": F.round(F.col("value") * 100).cast("bigint")})


@pytest.fixture(scope="module")
def base(events):
    return W.arrivals(events)


def rows(df, *cols):
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=str)


RUNS = {
    "n": ("count", None), "total": ("sum", "cents"), "low": ("min", "cents"), "high": ("max", "cents"),
    "seen": ("last", "signup"),
}


@pytest.mark.parametrize("keys", [(), ("k",)])
@pytest.mark.parametrize("reverse", [False, True])
@pytest.mark.parametrize("inclusive", [False, True])
def test_running_in_ranges_equals_one_window(base, keys, reverse, inclusive):
    df = base.withColumn("signup", F.when(F.col("event_type") == "signup", F.col("event_id")))
    runs = {n: Run(k, None if c is None else F.col(c)) for n, (k, c) in RUNS.items()}
    split = plan_split(df, keys, ORDER, rows_per_range=60)
    assert split.active and split.widest >= 8
    args = {"reverse": reverse, "inclusive": inclusive}
    got = running(df, keys, ORDER, runs, split=split, **args)
    want = running(df, keys, ORDER, runs, split=Split(keys, ORDER), **args)
    assert rows(got, "event_id", *RUNS) == rows(want, "event_id", *RUNS)


@pytest.mark.parametrize("keys", [(), ("k",)])
@pytest.mark.parametrize("offset", [-7, -1, 1, 2, 40])
def test_neighbour_in_ranges_equals_lead(base, keys, offset):
    split = plan_split(base, keys, ORDER, rows_per_range=60)
    got = neighbour(base, keys, ORDER, offset, {"o": F.col("event_id")}, split=split, block_rows=50)
    window = Window.partitionBy(*keys).orderBy(*ORDER)
    want = base.withColumn("o", F.lead("event_id", offset).over(window))
    assert rows(got, "event_id", "o") == rows(want, "event_id", "o")


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_many_ranges(base, keys):
    split = plan_split(base, keys, ORDER, rows_per_range=12)
    assert split.widest > 40
    got = running(base, keys, ORDER, {"n": Run("count")}, split=split)
    want = running(base, keys, ORDER, {"n": Run("count")}, split=Split(keys, ORDER))
    assert rows(got, "event_id", "n") == rows(want, "event_id", "n")


def test_only_hot_keys_are_cut(base):
    split = plan_split(base, ("k",), ORDER, rows_per_range=300)
    cut = {r[0] for r in split.assign(base).filter("_range > 0").select("k").distinct().collect()}
    assert cut == {"hot"}
    assert not plan_split(base, ("k",), ORDER).active


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_window_aggregates_with_hot_keys(events, base, keys):
    split = plan_split(base, keys, ORDER, rows_per_range=60)
    aggs = {"sums": {"total": "cents"}, "averages": {"mean": "cents"}, "count": "n"}
    for window, args in ((W.length, (5,)), (W.time, (W.DAY,)), (W.external_time, (W.HOUR,)), (W.length_batch, (10,))):
        got = A.over_window(events, window, *args, keys=keys, split=split, **aggs)
        want = A.over_window(events, window, *args, keys=keys, split=Split(tuple(keys), ORDER), **aggs)
        cols = ("event_id", "_kind", "_at", "total", "n")
        assert rows(got, *cols) == rows(want, *cols)


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_sort_window_with_hot_keys(events, base, keys):
    by = [("value", False)]
    got = W.sort_window(events, 4, by, keys=keys, split=plan_split(base, keys, ORDER, rows_per_range=60))
    want = W.sort_window(events, 4, by, keys=keys, split=Split(tuple(keys), ORDER))
    assert rows(got, "event_id", "_kind", "_at") == rows(want, "event_id", "_kind", "_at")


@pytest.mark.parametrize("keys", [(), ("k",)])
def test_sort_window_over_blocks_of_ranges(events, base, keys, monkeypatch):
    """More blocks of ranges than one: content comes from the ranges of the block and from the blocks before it."""
    monkeypatch.setattr(W, "SEED_BLOCK", 3)
    split = plan_split(base, keys, ORDER, rows_per_range=40)
    assert split.widest >= 10
    by = [("value", False)]
    got = W.sort_window(events, 5, by, keys=keys, split=split)
    want = W.sort_window(events, 5, by, keys=keys, split=Split(tuple(keys), ORDER))
    assert rows(got, "event_id", "_kind", "_at") == rows(want, "event_id", "_kind", "_at")


@pytest.mark.parametrize("block", [3, 128])
def test_ranges_start_from_the_smallest_rows_before(spark, block, monkeypatch):
    """Every range gets the n smallest rows of all ranges before it, however many of those are empty."""
    monkeypatch.setattr(W, "SEED_BLOCK", block)
    n, ranges, values = 3, 20, {}
    data = [(r, (r * 37 + i * 11) % 101, i) for r in range(ranges) if r % 7 != 4 for i in range(r % 5 + 1)]
    frame = spark.createDataFrame(data, "_range int, v long, _s long").withColumn("_t", F.lit(0).cast("bigint"))
    split = Split((), ORDER, cuts=tuple((i, 0) for i in range(1, ranges)))
    for r in W._before_ranges(frame, n, [F.col("v"), "_t", "_s"], split, []).collect():
        values.setdefault(r["_range"], []).append((r["v"], r["_s"]))
    want = {r: sorted((v, i) for q, v, i in data if q < r)[:n] for r in range(1, ranges)}
    assert {r: sorted(v) for r, v in values.items()} == want


def test_sliding_extreme_counts_only_earlier_rows_of_one_time(events):
    rowset = W.arrivals(events)
    got = A.sliding_extreme(rowset, "max", "cents", "m", axis="_t", span=W.DAY * 1000, tie="_s", keys=["k"])
    data = [tuple(r) for r in rowset.select("event_id", "k", "_t", "_s", "cents").collect()]
    want = []
    for i, k, t, s, _ in data:
        want.append((i, max(c for _, k2, t2, s2, c in data if k2 == k and (t2, s2) <= (t, s) and t - t2 < W.DAY * 1000)))
    assert rows(got, "event_id", "m") == sorted(want, key=str)


def test_change_sums_count_only_earlier_rows_of_one_time(events):
    out = A.over_window(events, W.time, W.DAY, sums={"total": "cents"}, count="n")
    data = [tuple(r) for r in W.arrivals(events).select("event_id", "_t", "_s", "cents").collect()]
    want = []
    for i, t, s, _ in data:
        live = [c for _, t2, s2, c in data if (t2, s2) <= (t, s) and t - t2 < W.DAY * 1000]
        want.append((i, sum(live), len(live)))
    assert rows(W.output(out), "event_id", "total", "n") == sorted(want, key=str)


def test_pattern_cells_equal_whole_key(events):
    parts = [P.step("a", F.col("event_type") == "error"), P.step("b", F.col("event_type") == "purchase")]
    options = {"every": True, "within_ms": W.DAY}
    cells = P.pattern(events, parts, ["event_id"], keys=["k"], **options)
    chain = P.chain(events, [(p.name, p.when) for p in parts], ["event_id"], keys=["k"], **options)
    assert rows(cells, "a.event_id", "b.event_id") == rows(chain, "a.event_id", "b.event_id")
    alone = P.pattern(events, parts, ["event_id"], **options)
    plain = P.chain(events, [(p.name, p.when) for p in parts], ["event_id"], **options)
    assert rows(alone, "a.event_id", "b.event_id") == rows(plain, "a.event_id", "b.event_id")


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_stream_wide_operators_do_not_sort_in_one_task(events):
    """The only single-task steps handle the bounded totals of the ranges."""
    aggs = A.over_window(events, W.time, W.DAY, sums={"total": "cents"})
    for df in (aggs, A.running_stream(events, {"n": Run("count")}), W.length(events, 3)):
        for block in plan_of(df).split("Exchange SinglePartition")[1:]:
            head = block.strip().split("\n")[1]
            assert "_range" in head and "HashAggregate" in head, block[:400]


def test_filters_and_columns_reach_the_scan(spark):
    df = spark.read.parquet(f"{SF}/events.parquet").filter(F.col("event_type") == "view").select("event_id")
    plan = plan_of(df)
    assert "PushedFilters: [IsNotNull(event_type), EqualTo(event_type,view)]" in plan
    assert "ReadSchema: struct<event_id:bigint,event_type:string>" in plan


def test_a_key_of_many_changes_is_cut(spark):
    """Both changes of all rows of a range are sorted in one task, so memory must not follow the key."""
    events = spark.range(300_000).select(F.col("id").alias("seq"), (F.col("id") * 1_000_000).alias("ts"), F.lit("a").alias("k"))
    seen = []

    def window(df, *, keys, ts, seq, split):
        seen.append(split)
        return W.external_time(df, 2_500, keys=keys, ts=ts, seq=seq, split=split)

    live = A.over_window(events, window, keys=["k"], count="n").filter("_sign > 0")
    assert seen[0].active
    assert sorted(map(tuple, live.groupBy("n").count().collect())) == [(1, 1), (2, 1), (3, 299_998)]
    alone = W.external_time(events, 2_500, keys=["k"])
    assert "_cuts" in alone._jdf.queryExecution().analyzed().toString()
