"""Telemetry record transforms. Records are struct columns; outputs are plain columns.

``now`` (epoch seconds) is always an argument, so results do not depend on the clock.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import telemetry as M
from tidemark.operators.windows import ARRIVAL_ORDER, arrivals, ordered_scan
from tidemark.ordering import Run, Split, neighbour, plan_split, running
from tidemark.sources import schemas

UNKNOWN = M.SIGNAL_NONE
MINUTE = 60
LEAVE_TIME = 30 * MINUTE

# Association status codes.
DOT11_STATUS = {
    0: "IDLE",
    1: "AAA_PENDING",
    2: "AUTHENTICATED",
    3: "ASSOCIATED",
    4: "POWERSAVE",
    5: "DISASSOCIATED",
    6: "TO_BE_DELETED",
    7: "PROBING",
    8: "BLACK_LISTED",
    256: "WAIT_AUTHENTICATED",
    257: "WAIT_ASSOCIATED",
}


def _carry(df: DataFrame, record: str) -> list[Column]:
    return [F.col(c) for c in df.columns if c != record]


def _zero_counters() -> list[Column]:
    return [F.lit(0).alias("bytes"), F.lit(0).alias("pkts")]


def _part(text: Column, separator: str, place: int) -> Column:
    return F.get(F.split(text, separator), F.lit(place))


def trap(df: DataFrame, now: Column, record: str = "record") -> DataFrame:
    """Wireless trap to client record; rows without a client address are dropped."""
    r = lambda name: F.col(record).getField(name)
    rssi, snr, place = r(schemas.TRAP_RSSI), r(schemas.TRAP_SNR), r(schemas.TRAP_LOCATION)
    parts = F.split(place, "-")
    n = F.size(parts)
    sensor = F.regexp_extract(r("host"), r"\[([^\]]*)\]", 1)
    out = df.select(
        *_carry(df, record),
        _part(r(schemas.TRAP_CLIENT), "/", 1).alias("client_mac"),
        M.rssi_class(rssi).alias("client_rssi"),
        F.coalesce(rssi, F.lit(0)).alias("client_rssi_num"),
        M.snr_class(snr).alias("client_snr"),
        F.coalesce(snr, F.lit(0)).alias("client_snr_num"),
        r(schemas.TRAP_SSID).alias("wireless_id"),
        F.replace(F.lower(F.trim(r(schemas.TRAP_STATION))), F.lit(" "), F.lit(":")).alias("wireless_station"),
        F.when(n == 3, F.trim(parts[0])).alias("client_campus"),
        F.when(n == 3, F.trim(parts[1])).otherwise(F.trim(parts[0])).alias("client_building"),
        F.when(n == 3, F.trim(F.get(parts, F.lit(2)))).when(n > 1, F.trim(F.get(parts, F.lit(1)))).alias("client_floor"),
        M.signal_quality(rssi, snr).alias("quality"),
        F.when(r("host").isNotNull(), F.concat(F.lit("trap:"), sensor)).alias("sensor_name"),
        F.when(r("host").isNotNull(), sensor).alias("sensor_ip"),
        F.coalesce(r("timestamp").try_cast("bigint"), now).alias("timestamp"),
        *_zero_counters(),
    )
    return out.filter(F.col("client_mac").isNotNull())


def _rounded(value: Column) -> Column:
    return (F.floor(value * 100000 + 0.5) / 100000).cast("string")


def location(df: DataFrame, now: Column, record: str = "record") -> DataFrame:
    """Location notification to client record; newer-format messages are left out (see ``v10_split``)."""
    n = F.col(f"{record}.StreamingNotification")
    loc = F.from_json(n.getField("location"), T.DataType.fromDDL(schemas.LOCATION_BODY))
    upper = F.from_json(n.getField("location"), T.DataType.fromDDL(schemas.LOCATION_BODY_UPPER))
    hierarchy = F.coalesce(upper.getField("MapInfo"), loc.getField("mapInfo")).getField("mapHierarchyString")
    geo = F.coalesce(upper.getField("GeoCoordinate"), loc.getField("geoCoordinate"))
    latitude = F.coalesce(geo.getField("latitude"), geo.getField("lattitude"))
    status = loc.getField("dot11Status")
    joined = status == "ASSOCIATED"
    zone = F.split(hierarchy, ">")
    client = loc.getField("macAddress")
    seconds = F.unix_seconds(F.try_to_timestamp(n.getField("timestamp")))
    return df.filter(n.isNotNull()).select(
        *_carry(df, record),
        client.alias("client_mac"),
        F.get(zone, F.lit(0)).alias("client_campus"),
        F.get(zone, F.lit(1)).alias("client_building"),
        F.get(zone, F.lit(2)).alias("client_floor"),
        status.alias("dot11_status"),
        F.when(joined, loc.getField("ssId")).alias("wireless_id"),
        F.when(joined, loc.getField("apMacAddress")).alias("wireless_station"),
        F.when(joined, F.get(loc.getField("ipAddress"), F.lit(0))).alias("src"),
        F.when(geo.isNotNull(), F.concat_ws(",", _rounded(latitude), _rounded(geo.getField("longitude")))).alias(
            "client_latlong"
        ),
        n.getField("subscriptionName").alias("sensor_name"),
        F.lit(UNKNOWN).alias("client_rssi"),
        F.lit(0).alias("client_rssi_num"),
        F.lit(UNKNOWN).alias("client_snr"),
        F.lit(0).alias("client_snr_num"),
        *_zero_counters(),
        F.lit("mse").alias("type"),
        F.when(client.isNotNull(), F.coalesce(seconds, now)).otherwise(now).alias("timestamp"),
    )


def v10_split(df: DataFrame, record: str = "record") -> tuple[DataFrame, DataFrame]:
    """Notifications as one row each, split into associations and location updates."""
    rows = df.withColumn(record, F.explode(f"{record}.notifications"))
    kind = F.col(f"{record}.notificationType")
    return rows.filter(kind == "association"), rows.filter(kind == "locationupdate")


def v10_association(df: DataFrame, record: str = "record") -> DataFrame:
    """Association to client record; milliseconds become seconds. Without a user name
    or a time the message is dropped, as an empty user name is not the same as none."""
    r = lambda name: F.col(f"{record}.{name}")
    codes = F.create_map(*[F.lit(x) for kv in DOT11_STATUS.items() for x in kv])
    return df.filter(r("username").isNotNull() & r("timestamp").isNotNull()).select(
        *_carry(df, record),
        r("deviceId").alias("client_mac"),
        r("ssid").alias("wireless_id"),
        r("band").alias("dot11_protocol"),
        F.try_element_at(codes, r("status")).alias("dot11_status"),
        r("apMacAddress").alias("wireless_station"),
        F.when(r("username") != "", r("username")).alias("client_id"),
        r("subscriptionName").alias("sensor_name"),
        F.floor(r("timestamp") / 1000).alias("timestamp"),
        *_zero_counters(),
        F.lit("mse10").alias("type"),
    )


def v10_update(df: DataFrame, now: Column, record: str = "record") -> DataFrame:
    """Location update to campus, building, floor and zone."""
    r = lambda name: F.col(f"{record}.{name}")
    zone = F.split(r("locationMapHierarchy"), ">")
    places = [F.get(zone, F.lit(i)).alias(f"client_{n}") for i, n in enumerate(("campus", "building", "floor", "zone"))]
    return df.select(
        *_carry(df, record),
        r("deviceId").alias("client_mac"),
        *places,
        r("subscriptionName").alias("sensor_name"),
        F.coalesce(F.floor(r("timestamp") / 1000), now).alias("timestamp"),
        *_zero_counters(),
        F.lit("mse10").alias("type"),
    )


def client_key(mac: Column) -> Column:
    """Client address with colons."""
    return F.replace(mac, F.lit("-"), F.lit(":"))


def radius(df: DataFrame, record: str = "record") -> DataFrame:
    """Accounting message to client record; without time or client address it is dropped."""
    r = lambda name: F.col(record).getField(name)
    called = F.split(r("Called-Station-Id"), ":")
    whole = F.size(called) == 2
    return df.filter(r("timestamp").isNotNull() & r("Calling-Station-Id").isNotNull()).select(
        *_carry(df, record),
        client_key(r("Calling-Station-Id")).alias("client_mac"),
        F.when(whole, client_key(called[0])).alias("wireless_station"),
        F.when(whole, F.get(called, F.lit(1))).alias("wireless_id"),
        r("User-Name").alias("client_id"),
        r("Framed-IP-Address").alias("src"),
        r("NAS-Identifier").alias("sensor_name"),
        r("NAS-IP-Address").alias("sensor_ip"),
        r("timestamp").try_cast("bigint").alias("timestamp"),
        F.lit(UNKNOWN).alias("client_rssi"),
        F.lit(0).alias("client_rssi_num"),
        F.lit(UNKNOWN).alias("client_snr"),
        F.lit(0).alias("client_snr_num"),
        *_zero_counters(),
    )


def fill_from_state(
    df: DataFrame, fields: Sequence[str], *, key="client_mac", ttl_ms: int = 3_600_000, ts="ts", seq="seq"
) -> DataFrame:
    """Merge each message over what is remembered of its key (``overwrite`` off).

    A field keeps its last value as long as messages of the key arrive within
    the time to live of each other.
    """
    a = arrivals(df, ts, seq)
    split = plan_split(a, (key,), ARRIVAL_ORDER)
    timed = neighbour(a, (key,), ARRIVAL_ORDER, -1, {"_before": F.col("_t")}, split=split)
    fresh = F.col("_before").isNull() | (F.col("_t") - F.col("_before") >= ttl_ms * 1000)
    spells = running(timed, (key,), ARRIVAL_ORDER, {"_spell": Run("sum", fresh.cast("bigint"))}, split=split)
    known = {
        f"_f_{f}": Run("last", F.when(F.col(f).isNotNull(), F.struct(F.col("_spell").alias("s"), F.col(f).alias("v"))))
        for f in fields
    }
    filled = running(spells, (key,), ARRIVAL_ORDER, known, split=split)
    same = {f: F.when(F.col(f"_f_{f}.s") == F.col("_spell"), F.col(f"_f_{f}.v")) for f in fields}
    return filled.withColumns(same).select(*df.columns)


def nmsp_rows(df: DataFrame, record: str = "record") -> tuple[DataFrame, DataFrame]:
    """Positioning messages as one row per entry: (measures, infos)."""
    rows = df.select(
        *_carry(df, record),
        F.col(f"{record}.sensor_name").alias("sensor_name"),
        F.lower(f"{record}.type").alias("_kind"),
        F.col(f"{record}.enrichment").alias("enrichment"),
        F.explode(f"{record}.data").alias("_d"),
    )
    flat = rows.select(*[c for c in rows.columns if c != "_d"], "_d.*")
    measures = flat.filter("_kind = 'measure'").drop("_kind").withColumn("type", F.lit("nmsp-measure"))
    infos = flat.filter("_kind = 'info'").drop("_kind").withColumn("type", F.lit("nmsp-info"))
    return measures, infos


def nmsp_info(df: DataFrame, now: Column) -> DataFrame:
    """Info entry to client record: the network id becomes the source network id."""
    out = df.withColumnRenamed("vlan_id", "src_vlan").withColumns({"bytes": F.lit(0), "pkts": F.lit(0)})
    own = F.col("timestamp") if "timestamp" in df.columns else F.lit(None).cast("bigint")
    return out.withColumn("timestamp", F.coalesce(own, now))


def nmsp_measure(df: DataFrame, now: Column, state_fields: Sequence[str]) -> DataFrame:
    """Strongest access point of a measure, or the associated one when it is heard.

    ``state_fields`` are columns already looked up for the client, prefixed
    ``known_`` and including ``known_wireless_station``; they win over the measure.
    """
    heard = df.filter(
        F.col("ap_mac").isNotNull() & F.col("rssi").isNotNull() & (F.size("ap_mac") > 0) & (F.size("rssi") > 0)
    )
    best = F.array_max("rssi")
    nearest = F.get("ap_mac", (F.array_position("rssi", best) - 1).cast("int"))
    known = F.col("known_wireless_station")
    kept = F.coalesce(F.array_contains("ap_mac", known), F.lit(False)) & known.isNotNull()
    own = F.get("rssi", (F.array_position("ap_mac", known) - 1).cast("int"))
    cols = {
        "client_rssi": M.rssi_class(best),
        "client_rssi_num": F.when(kept, own).otherwise(best),
        "wireless_station": F.when(kept, known).otherwise(nearest),
        "dot11_status": F.lit("PROBING"),
    }
    for f in state_fields:
        name = f.removeprefix("known_")
        if name in ("wireless_station",):
            continue
        base = cols.get(name, F.lit(None))
        if name == "dot11_status":
            cols[name] = F.when(kept, F.col(f)).otherwise(base)
        else:
            cols[name] = F.when(kept, F.coalesce(F.col(f), base)).otherwise(base)
    out = heard.withColumns(cols).withColumns({"bytes": F.lit(0), "pkts": F.lit(0), "timestamp": now})
    return out.drop("ap_mac", "rssi", *state_fields)


PLACES = ("client_floor", "client_building", "client_campus")


def _moves(places: Sequence[str], known: Column) -> dict[str, Column]:
    """``*_old``/``*_new`` when a place changed, the place itself when it did not."""
    out = {}
    for p in places:
        old, new = F.col(f"_old_{p}"), F.col(p)
        changed = known & old.isNotNull() & ~old.eqNullSafe(new)
        out[f"{p}_old"] = F.when(changed, old)
        out[f"{p}_new"] = F.when(changed, new)
        out[f"_same_{p}"] = F.when(known & old.isNotNull() & ~changed, new)
    return out


def movement(df: DataFrame, *, key="client_mac", ttl_ms: int = 3_600_000, ts="ts", seq="seq") -> DataFrame:
    """Movement against the client's last location: old/new, unchanged, or first sight (new only)."""
    a = arrivals(df, ts, seq).withColumn("wireless_station", F.coalesce("wireless_station", F.lit(UNKNOWN)))
    places = (*PLACES, "wireless_station")
    before = neighbour(
        a, (key,), ARRIVAL_ORDER, -1, {"_old_t": F.col("_t"), **{f"_old_{p}": F.col(p) for p in places}}
    )
    known = F.coalesce(F.col("_t") - F.col("_old_t") < ttl_ms * 1000, F.lit(False))
    moved = before.withColumns(_moves(places, known))
    first = {f"{p}_new": F.when(known, F.col(f"{p}_new")).otherwise(F.col(p)) for p in PLACES}
    same = {p: F.col(f"_same_{p}") for p in places}
    drop = ["_t", "_s", "_old_t", *[f"_old_{p}" for p in places], *[f"_same_{p}" for p in places]]
    return moved.withColumns(first).withColumns(same).drop(*drop)


def _debounce(df: DataFrame, key: str, places: Sequence[str], split: Split) -> DataFrame:
    """Keep the rows that are reported: a changed place, or more than a minute since the last report.

    What was last reported depends on the path, but a row more than a minute
    after the previous *row* is reported whatever came before. Such rows start
    independent segments, and only inside a segment rows are read in sequence.
    """
    order = ("timestamp", "_s")
    timed = neighbour(df, (key,), order, -1, {"_prev": F.col("timestamp")}, split=split)
    opens = F.col("_prev").isNull() | (F.col("timestamp") - F.col("_prev") > MINUTE)
    marked = running(timed, (key,), order, {"_segment": Run("sum", opens.cast("bigint"))}, split=split)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields])
    make = reporter(places, len(df.columns))
    return ordered_scan(marked.select(*df.columns, "_segment"), [key, "_segment"], list(order), make, schema)


def reporter(places: Sequence[str], width: int, with_old: bool = False):
    """Step that passes the reported rows on, with the last report behind them if asked."""
    places = tuple(places)

    def make(columns: list[str], memory: dict):
        time_at = columns.index("timestamp")
        place_at = [columns.index(p) for p in places]

        def step(row: tuple) -> list[tuple]:
            now, here = row[time_at], [row[i] for i in place_at]
            then, before = memory.get("last", (None, [None] * len(place_at)))
            if then is not None and now - then <= MINUTE:
                if not any(old is not None and old != new for old, new in zip(before, here)):
                    return []
            memory["last"] = (now, here)
            return [(*row[:width], then, *before)] if with_old else [row[:width]]

        return step

    return make


def dwell(df: DataFrame, *, key="client_mac", ttl_s: int = 3600, seq="seq") -> DataFrame:
    """Movement with a minute debounce; gaps of 1 to 30 minutes are filled with the old place.

    ``df`` has ``timestamp`` (seconds), the four places and ``wireless_station``.
    """
    places = ("client_floor", "client_zone", "client_building", "client_campus")
    named = df.withColumns({p: F.coalesce(p, F.lit(UNKNOWN)) for p in places}).withColumn("_s", F.col(seq).cast("bigint"))
    every = (*places, "wireless_station")
    split = plan_split(named, (key,), ("timestamp", "_s"))
    reported = _debounce(named, key, every, split)
    before = neighbour(
        reported, (key,), ("timestamp", "_s"), -1,
        {"_old_t": F.col("timestamp"), **{f"_old_{p}": F.col(p) for p in every}}, split=split,
    )
    return dwell_rows(before, df.columns, ttl_s)


def dwell_rows(before: DataFrame, columns: Sequence[str], ttl_s: int) -> DataFrame:
    """Reports with their previous report (``_old_*``) to movement rows and filled minutes."""
    places = ("client_floor", "client_zone", "client_building", "client_campus")
    every = (*places, "wireless_station")
    gap = F.col("timestamp") - F.col("_old_t")
    known = F.coalesce(gap <= ttl_s, F.lit(False))
    moves = _moves(every, known)
    minutes = F.ceil((gap - 2 * MINUTE) / F.lit(MINUTE)).cast("int") - 1
    gaps = F.when(known & (gap > MINUTE) & (gap <= LEAVE_TIME), F.greatest(minutes, F.lit(0))).otherwise(0)
    # Copy 0 is the report itself, copies 1, 2, ... are the missing minutes before it.
    copies = before.withColumn("_i", F.explode(F.sequence(F.lit(0), gaps)))
    report = F.col("_i") == 0
    out = {"timestamp": F.when(report, F.col("timestamp")).otherwise(F.col("_old_t") + F.col("_i") * MINUTE)}
    for p in every:
        here = F.col(p) if p == "wireless_station" else moves[f"_same_{p}"]
        out[p] = F.when(report, here).otherwise(F.col(f"_old_{p}"))
        fresh = moves[f"{p}_new"] if p == "wireless_station" else F.when(known, moves[f"{p}_new"]).otherwise(F.col(p))
        out[f"{p}_old"] = F.when(report, moves[f"{p}_old"])
        out[f"{p}_new"] = F.when(report, fresh)
    rest = [c for c in columns if c not in out]
    return copies.select(*rest, *[v.alias(n) for n, v in out.items()], F.lit("nmsp").alias("type"))


def merge_layers(df: DataFrame, layers: Sequence[str], *, hash_mac: bool = False) -> DataFrame:
    """Flatten struct columns into one record; a later layer's value wins over an earlier one's."""
    names: dict[str, list[Column]] = {}
    for layer in layers:
        for f in df.schema[layer].dataType.fieldNames():
            names.setdefault(f, []).insert(0, F.col(f"{layer}.{f}"))
    rest = [c for c in df.columns if c not in layers]
    out = df.select(*rest, *[F.coalesce(*v).alias(n) for n, v in names.items()])
    if hash_mac:
        out = out.withColumn("client_mac", M.text_hash(F.col("client_mac")))
    return out


LATE_MINUTES = 15


def not_late(end: Column, now: Column) -> Column:
    """False for flows that ended over an hour ago, or in the hour that is already closed."""
    hour = lambda s: F.pmod(F.floor(s / 3600), F.lit(24))
    minute = F.pmod(F.floor(now / 60), F.lit(60))
    closed = (hour(end) == hour(now) - 1) & (minute > LATE_MINUTES)
    return ~(closed | (now - end > 3600))


def split_flow(df: DataFrame, now: Column) -> DataFrame:
    """Cut flows into minute slices with proportional counters; late flows are dropped.

    ``first_switched`` and ``timestamp`` are seconds. Slices take the integer part
    of their share and the last slice takes the rest. Records without a start
    pass unchanged.
    """
    cols = [c for c in df.columns if c != "first_switched"]
    both = F.col("first_switched").isNotNull() & F.col("timestamp").isNotNull()
    hour = lambda s: F.pmod(F.floor(s / 3600), F.lit(24))
    minute = F.pmod(F.floor(now / 60), F.lit(60))
    limit = now - minute * 60 - F.when(minute < LATE_MINUTES, 3600).otherwise(0)
    end = F.col("timestamp").cast("bigint")
    start = F.when(both, F.greatest(F.col("first_switched").cast("bigint"), limit)).otherwise(end)
    timed = df.filter(~both | not_late(F.col("timestamp"), now)).withColumns({"_from": start, "_to": end})
    ahead = both & (F.col("_to") > now) & (
        (hour(F.col("_to")) != hour(F.col("_from"))) | (F.col("_to") - now > 3600)
    )
    timed = timed.withColumns(
        {
            "_to": F.when(ahead, now).otherwise(F.col("_to")),
            "_from": F.when(ahead, F.least(F.col("_from"), now)).otherwise(F.col("_from")),
        }
    )
    base = F.floor(F.col("_from") / 60) * 60
    count = F.coalesce(F.greatest(F.ceil((F.col("_to") - base) / 60), F.lit(1)), F.lit(1))
    total = F.coalesce(F.col("_to") - F.col("_from"), F.lit(0))
    cut = timed.withColumns({"_base": base, "_total": total, "_count": count.cast("bigint")})
    slices = cut.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("_count"))))
    stop = F.least(F.col("_base") + F.col("_k") * 60, F.col("_to"))
    begin = F.when(F.col("_k") == 1, F.col("_from")).otherwise(F.col("_base") + (F.col("_k") - 1) * 60)
    is_last = F.col("_k") == F.col("_count")

    def amount(counter: str) -> Column:
        return F.coalesce(F.col(counter).cast("bigint"), F.when(both, F.lit(0)))

    def share(counter: str, seconds: Column) -> Column:
        part = F.call_function("div", amount(counter) * seconds, F.when(F.col("_total") == 0, 1).otherwise(F.col("_total")))
        return F.when(F.col("_total") == 0, amount(counter)).otherwise(part)

    def value(counter: str) -> Column:
        own = share(counter, stop - begin)
        # All slices between the first and the last are whole minutes, so what the others got has a closed form.
        others = share(counter, F.col("_base") + 60 - F.col("_from")) + (F.col("_count") - 2) * share(counter, F.lit(60))
        full = amount(counter) - F.when(F.col("_count") > 1, others).otherwise(0)
        return F.when(is_last & both & (full > 0), full).otherwise(own)

    done = slices.select(
        *[
            value(c).alias(c) if c in ("bytes", "pkts") else stop.alias(c) if c == "timestamp" else F.col(c)
            for c in cols
        ]
    )
    return done


def state_upsert(df: DataFrame, key: str, fields: Sequence[str], *, ts="ts", seq="seq") -> DataFrame:
    """Latest value of each key; partial maxima are combined before the shuffle."""
    a = arrivals(df, ts, seq).filter(F.col(key).isNotNull())
    best = F.max_by(F.struct(ts, *fields), F.struct("_t", "_s")).alias("_r")
    return a.groupBy(key).agg(best).select(key, "_r.*")
