"""Last-known-value enrichment: as-of lookups in keyed state, in event time."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.telemetry import SIGNAL_NONE
from tidemark.operators.windows import arrivals
from tidemark.ordering import Run, Split, running

TTL_MS = 3_600_000


CELLS_PER_TTL = 8
NULL_SPREAD = 4096


@dataclass(frozen=True)
class State:
    """A keyed state stream: ``fields`` maps the added column to the state's column."""

    frame: DataFrame
    key: str
    fields: dict[str, str]
    hit: str | None = None


def _latest_known(left: DataFrame, rights: Sequence[DataFrame], ttl_ms: int) -> DataFrame:
    """Rows of ``left`` with the last ``_known<i>`` of their key, by time cells.

    Nothing older than the time to live counts, so time is cut into cells of a
    fraction of it and each (key, cell) is read on its own: a key with most of
    the rows is spread over its cells. What a cell needs from earlier cells is
    only the last state of each, which is combined before the shuffle and copied
    to the cells it can still reach (one, where a key has a state in every cell).
    """
    width = F.lit(max(ttl_ms * 1000 // CELLS_PER_TTL, 1))
    cell = F.floor(F.col("_t") / width).cast("bigint")
    merged = left.withColumn("_cell", cell)
    for i, right in enumerate(rights):
        known = f"_known{i}"
        own = right.withColumn("_cell", cell)
        place = F.struct("_t", "_s")
        last = own.groupBy("_key", "_cell").agg(
            F.max("_t").alias("_t"), F.max_by("_s", place).alias("_s"), F.max_by(known, place).alias(known)
        )
        # The last state of a cell is needed up to the key's next cell with a state of its own.
        following = F.lead("_cell").over(Window.partitionBy("_key").orderBy("_cell"))
        until = F.least(F.col("_cell") + CELLS_PER_TTL, F.col("_until"))
        ahead = last.withColumn("_until", following).select(
            "_key", F.lit(0).alias("_spread"), F.explode(F.sequence(F.col("_cell") + 1, until)).alias("_cell"),
            "_t", F.lit(0).alias("_o"), "_s", known,
        )
        merged = merged.unionByName(own, allowMissingColumns=True).unionByName(ahead, allowMissingColumns=True)
    window = (
        Window.partitionBy("_key", "_spread", "_cell").orderBy("_t", "_o", "_s")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = {f"_last{i}": F.last(f"_known{i}", ignorenulls=True).over(window) for i in range(len(rights))}
    return merged.withColumns(seen).filter("_o = 1")


def lookups(
    df: DataFrame,
    key: str,
    states: Sequence[State],
    *,
    ttl_ms: int | None = TTL_MS,
    ts="ts",
    seq="seq",
    split: Split | None = None,
) -> DataFrame:
    """Add the fields that several states know for ``df[key]`` at each row's time.

    The latest state row with ``ts - ttl < state.ts <= ts`` counts; without one
    the fields are null. The rows and all states meet in one ordered pass per
    key, so the rows are shuffled once however many states there are. Rows with
    a null key find nothing and are spread over many groups.
    """
    a = arrivals(df, ts, seq)
    spread = F.when(F.col(key).isNull(), F.pmod(F.hash("_s"), F.lit(NULL_SPREAD))).otherwise(0)
    left = a.select(
        F.col(key).alias("_key"), spread.alias("_spread"), "_t", F.lit(1).alias("_o"), "_s",
        F.struct(*df.columns).alias("_row"),
    )
    rights = []
    for i, state in enumerate(states):
        known = F.struct(F.col("_t").alias("_kt"), *[F.col(c).alias(o) for o, c in state.fields.items()])
        rights.append(
            arrivals(state.frame, ts, seq)
            .filter(F.col(state.key).isNotNull())
            .select(
                F.col(state.key).alias("_key"), F.lit(0).alias("_spread"), "_t", F.lit(0).alias("_o"), "_s",
                known.alias(f"_known{i}"),
            )
        )
    if ttl_ms is not None:
        seen = _latest_known(left, rights, ttl_ms)
    else:
        merged = left
        for right in rights:
            merged = merged.unionByName(right, allowMissingColumns=True)
        runs = {f"_last{i}": Run("last", F.col(f"_known{i}")) for i in range(len(rights))}
        seen = running(merged, ("_key", "_spread"), ("_t", "_o", "_s"), runs, split=split).filter("_o = 1")
    added, replaced = [], set()
    for i, state in enumerate(states):
        last = f"_last{i}"
        fresh = F.col(last).isNotNull()
        if ttl_ms is not None:
            fresh = fresh & (F.col(f"{last}._kt") > F.col("_t") - F.lit(ttl_ms * 1000))
        added += [F.when(fresh, F.col(f"{last}.{o}")).alias(o) for o in state.fields]
        added += [F.coalesce(fresh, F.lit(False)).alias(state.hit)] if state.hit else []
        replaced |= set(state.fields)
    kept = [F.col(f"_row.{c}").alias(c) for c in df.columns if c not in replaced]
    return seen.select(*kept, *added)


def lookup(
    df: DataFrame,
    state: DataFrame,
    key: str,
    state_key: str,
    fields: Sequence[str] | dict[str, str],
    *,
    ttl_ms: int | None = TTL_MS,
    hit: str | None = None,
    ts="ts",
    seq="seq",
    split: Split | None = None,
) -> DataFrame:
    """``lookups`` in one state."""
    names = dict(fields) if isinstance(fields, dict) else {f: f for f in fields}
    return lookups(df, key, [State(state, state_key, names, hit)], ttl_ms=ttl_ms, ts=ts, seq=seq, split=split)


def with_defaults(df: DataFrame, hit: str, missing: dict[str, Column], found: dict[str, Column] | None = None) -> DataFrame:
    """Fields to set when nothing was found, and fields to set when something was."""
    cols = {}
    for name, value in missing.items():
        here = F.col(name) if name in df.columns else F.lit(None)
        cols[name] = F.when(~F.col(hit), value).otherwise(here)
    for name, value in (found or {}).items():
        here = cols.get(name, F.col(name) if name in df.columns else F.lit(None))
        cols[name] = F.when(F.col(hit), value).otherwise(here)
    return df.withColumns(cols).drop(hit)


TRAP_FIELDS = ("client_rssi", "client_rssi_num", "client_snr", "client_snr_num")


def trap_defaults(df: DataFrame, hit: str) -> DataFrame:
    """Nothing known about the radio gives ``unknown``/0."""
    none = {
        "client_rssi": F.lit(SIGNAL_NONE), "client_rssi_num": F.lit(0),
        "client_snr": F.lit(SIGNAL_NONE), "client_snr_num": F.lit(0),
    }
    return with_defaults(df, hit, none)


def trap_lookup(df, state, *, key="client_mac", **options) -> DataFrame:
    """Radio state of a client."""
    return trap_defaults(lookup(df, state, key, "client_mac", list(TRAP_FIELDS), hit="_hit", **options), "_hit")


def location_defaults(df: DataFrame, hit: str, *, v10: bool = False) -> DataFrame:
    """A hit is ASSOCIATED; with v10 a miss is PROBING and a hit keeps its status."""
    if v10:
        return with_defaults(df, hit, {"dot11_status": F.lit("PROBING")})
    return with_defaults(df, hit, {}, {"dot11_status": F.lit("ASSOCIATED")})


def location_lookup(df, state, fields, *, key="client_mac", v10: bool = False, **options) -> DataFrame:
    """Location of a client."""
    out = lookup(df, state, key, "client_mac", fields, hit="_hit", **options)
    return location_defaults(out, "_hit", v10=v10)


def endpoint_lookup(df, state, fields, *, source="ethsrc", target="ethdst", **options) -> DataFrame:
    """Events: look up both ends and let the target's fields win over the source's."""
    one = lookup(df, state, source, "client_mac", {f"_src_{f}": f for f in fields}, **options)
    two = lookup(one, state, target, "client_mac", {f"_dst_{f}": f for f in fields}, **options)
    merged = two.withColumns({f: F.coalesce(f"_dst_{f}", f"_src_{f}") for f in fields})
    return merged.drop(*[f"_{e}_{f}" for e in ("src", "dst") for f in fields])


def mobile_chain(df, state, *, ts="ts", seq="seq", ttl_ms=TTL_MS) -> DataFrame:
    """Address assignment by source then target, subscriber by client id, cell by path."""
    assigned = ["client_id", "wireless_id", "rat", "msisdn"]
    options = {"ts": ts, "seq": seq, "ttl_ms": ttl_ms}
    one = lookup(df, state, "src", "key", {f"_a_{f}": f for f in assigned}, **options)
    two = lookup(one, state, "dst", "key", {f"_b_{f}": f for f in assigned}, **options)
    merged = two.withColumns({f: F.coalesce(f"_b_{f}", f"_a_{f}") for f in assigned})
    merged = merged.drop(*[f"_{e}_{f}" for e in "ab" for f in assigned])
    three = lookup(merged, state, "client_id", "key", ["path"], **options)
    return lookup(three, state, "path", "key", ["wireless_station", "hnblocation", "hnbgeolocation"], **options)


def reputation(df: DataFrame, table: DataFrame, *, protocol: bool = True) -> DataFrame:
    """Two-sided reputation lookup with a combined score, category and direction.

    ``table`` has ``ip, darklist_score, darklist_score_name, darklist_category``
    and ``darklist_protocol`` when ``protocol`` is on.
    """
    fields = ["darklist_score", "darklist_score_name", "darklist_category"]
    fields += ["darklist_protocol"] if protocol else []

    def side(name: str) -> DataFrame:
        return table.select(F.col("ip").alias(f"_{name}_ip"), *[F.col(f).alias(f"_{name}_{f}") for f in fields])

    out = df.join(side("s"), F.col("src") == F.col("_s_ip"), "left").join(
        side("d"), F.col("dst") == F.col("_d_ip"), "left"
    )
    s, d = F.col("_s_ip").isNotNull(), F.col("_d_ip").isNotNull()
    ss = F.coalesce(F.col("_s_darklist_score").cast("int"), F.lit(0))
    ds = F.coalesce(F.col("_d_darklist_score").cast("int"), F.lit(0))
    clean = F.lit("clean")

    def joined(name: str) -> Column:
        a, b = F.col(f"_s_{name}"), F.col(f"_d_{name}")
        return F.when(s & d, F.concat_ws("/", a, b)).when(s, a).when(d, b).otherwise(clean)

    def one_side(prefix: str, present: Column, name: str) -> Column:
        return F.when(present, F.col(f"_{prefix}_{name}")).otherwise(clean)

    first = s & (~d | (ss > ds))
    cols = {
        "darklist_score_src": ss,
        "darklist_score_dst": ds,
        "darklist_score": F.when(first, ss).when(d, ds).otherwise(F.lit(0)),
        "darklist_score_name": F.when(first, F.col("_s_darklist_score_name"))
        .when(d, F.col("_d_darklist_score_name")).otherwise(clean),
        "darklist_category": joined("darklist_category"),
        "darklist_category_src": one_side("s", s, "darklist_category"),
        "darklist_category_dst": one_side("d", d, "darklist_category"),
        "darklist_direction": F.when(s & d, "both").when(s, "source").when(d, "destination").otherwise("clean"),
    }
    if protocol:
        cols["darklist_protocol"] = joined("darklist_protocol")
        cols["darklist_protocol_src"] = one_side("s", s, "darklist_protocol")
        cols["darklist_protocol_dst"] = one_side("d", d, "darklist_protocol")
    return out.withColumns(cols).select(*df.columns, *cols)
