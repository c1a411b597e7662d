"""Joins with reference dimensions: vendors, address ranges, access points."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UNKNOWN = "unknown"


def oui(mac: Column) -> Column:
    """First six hexadecimal digits of a hardware address, upper case."""
    return F.upper(F.substring(F.regexp_replace(F.trim(mac), "[-:]", ""), 1, 6))


def mac_vendor(df: DataFrame, vendors: DataFrame, *, mac="client_mac", out="client_mac_vendor") -> DataFrame:
    """Vendor by address prefix; ``vendors`` has ``oui, vendor``."""
    dim = vendors.select(F.col("oui").alias("_oui"), F.col("vendor").alias(out))
    return df.join(dim, oui(F.col(mac)) == F.col("_oui"), "left").drop("_oui")


def vendor_lines(lines: DataFrame) -> DataFrame:
    """Parse ``0xAABBCC|Vendor`` text lines (column ``value``) into ``oui, vendor``."""
    parts = F.split("value", r"\|")
    return lines.select(F.substring(parts[0], 3, 6).alias("oui"), F.get(parts, F.lit(1)).alias("vendor")).dropna()


def ip_key(ip: Column) -> Column:
    """Fixed-width hexadecimal form of an address: 8 digits for v4, 32 for v6, else null.

    Text order of the key is address order, so ranges compare as text.
    """
    parts = F.split(ip, r"\.")
    octets = [F.lpad(F.hex(F.get(parts, F.lit(i)).try_cast("bigint")), 2, "0") for i in range(4)]
    halves = F.split(ip, "::")
    groups = lambda text: F.filter(F.split(text, ":"), lambda g: g != "")
    head, tail = groups(F.get(halves, F.lit(0))), groups(F.coalesce(F.get(halves, F.lit(1)), F.lit("")))
    missing = F.greatest(F.lit(8) - F.size(head) - F.size(tail), F.lit(0))
    full = F.concat(head, F.array_repeat(F.lit("0"), missing), tail)
    v6 = F.concat_ws("", F.transform(full, lambda g: F.lpad(F.upper(g), 4, "0")))
    return F.when(ip.contains("."), F.when(F.size(parts) == 4, F.concat(*octets))).when(ip.contains(":"), v6)


# A range is listed under every prefix it touches: 16 bits for v4, 32 for v6. A v6 range
# wider than 16 bits would touch too many and is kept under 16-bit prefixes of its own.
_WIDE = 1 << 16


def _prefix(key: Column, digits: int) -> Column:
    return F.conv(F.substring(key, 1, digits), 16, 10).cast("bigint")


def _bucket(key: Column) -> Column:
    """v4: the first 16 bits as a negative number; v6: the first 32 bits."""
    return F.when(F.length(key) == 8, -1 - _prefix(key, 4)).otherwise(_prefix(key, 8))


def _range_tables(ranges: DataFrame, fields: dict[str, str]) -> tuple[DataFrame, DataFrame]:
    # The keys pass through a one-element explode, so that they are computed once per range
    # and not again inside every expression that uses them.
    keys = F.array(F.struct(ip_key(F.col("first")).alias("lo"), ip_key(F.col("last")).alias("hi")))
    keyed = ranges.select(*fields.values(), F.explode(keys).alias("_k")).select(
        *fields.values(), F.col("_k.lo").alias("_lo"), F.col("_k.hi").alias("_hi")
    )
    kept = ["_lo", "_hi", *[F.col(c).alias(o) for o, c in fields.items()]]
    span = F.abs(_bucket(F.col("_hi")) - _bucket(F.col("_lo")))
    ends = F.sort_array(F.array(_bucket(F.col("_lo")), _bucket(F.col("_hi"))))
    narrow = keyed.filter(span < _WIDE).select(F.explode(F.sequence(ends[0], ends[1])).alias("_bucket"), *kept)
    wide = keyed.filter(span >= _WIDE).select(
        F.explode(F.sequence(_prefix(F.col("_lo"), 4), _prefix(F.col("_hi"), 4))).alias("_bucket"), *kept
    )
    return narrow, wide


def _range_lookup(df: DataFrame, ranges: DataFrame, key: str, fields: dict[str, str]) -> DataFrame:
    narrow, wide = _range_tables(ranges, {f"_n_{o}": c for o, c in fields.items()})
    cols = df.columns

    def holds(bucket: Column) -> Column:
        return (
            (bucket == F.col("_bucket"))
            & (F.length(key) == F.length("_lo"))
            & F.col(key).between(F.col("_lo"), F.col("_hi"))
        )

    one = df.join(narrow, holds(_bucket(F.col(key))), "left").withColumnRenamed("_lo", "_n_lo").drop("_bucket", "_hi")
    wide = wide.select("_bucket", "_lo", "_hi", *[F.col(f"_n_{o}").alias(f"_w_{o}") for o in fields])
    wide_bucket = F.when(F.length(key) > 8, _prefix(F.col(key), 4))
    two = one.join(wide, holds(wide_bucket), "left")
    # Where a narrow and a wide range hold the address, the later start wins.
    narrower = F.col("_n_lo").isNotNull() & (F.col("_lo").isNull() | (F.col("_n_lo") >= F.col("_lo")))
    return two.select(*cols, *[F.when(narrower, F.col(f"_n_{o}")).otherwise(F.col(f"_w_{o}")).alias(o) for o in fields])


def ip_ranges(df: DataFrame, ranges: DataFrame, ip: str, fields: dict[str, str]) -> DataFrame:
    """Fields of the (non-overlapping) range ``first .. last`` that holds ``df[ip]``:
    an equi join on an address prefix plus a bound check."""
    keyed = df.withColumn("_ip", ip_key(F.col(ip)))
    return _range_lookup(keyed, ranges, "_ip", fields).drop("_ip")


def as_name(info: Column) -> Column:
    """Text after the first space of ``AS123 Name``, or the whole text without a space."""
    return F.when(info.contains(" "), F.regexp_replace(info, "^[^ ]* ", "")).otherwise(info)


def geoip(df: DataFrame, countries: DataFrame, networks: DataFrame) -> DataFrame:
    """Country and network owner of both ends.

    ``countries`` has ``first, last, country``; ``networks`` has ``first, last, info``.
    """
    owners = networks.withColumn("info", as_name(F.col("info")))
    ends = F.array(F.struct(ip_key(F.col("src")).alias("s"), ip_key(F.col("dst")).alias("d")))
    keyed = df.select(*df.columns, F.explode(ends).alias("_e"))
    out = keyed.select(*df.columns, F.col("_e.s").alias("_src_ip"), F.col("_e.d").alias("_dst_ip"))
    for end in ("src", "dst"):
        out = _range_lookup(out, countries, f"_{end}_ip", {f"{end}_country_code": "country"})
        out = _range_lookup(out, owners, f"_{end}_ip", {f"{end}_as_name": "info"})
    return out.drop("_src_ip", "_dst_ip")


def access_points(
    points: DataFrame, sensors: DataFrame, point_zones: DataFrame, zones: DataFrame
) -> DataFrame:
    """Location of each access point from its floor, building, campus and first zone.

    ``points``: id, mac_address, latitude, longitude, sensor_id; ``sensors``: id,
    parent_id, name; ``point_zones``: access_point_id, zone_id; ``zones``: id, name.
    Rows without an access point are of no use, so the access points are the left side
    of every join.
    """

    def level(name: str) -> DataFrame:
        return sensors.select(
            F.col("id").alias(f"_{name}_id"), F.col("parent_id").alias(f"_{name}_up"), F.col("name").alias(f"_{name}")
        )

    first_zone = point_zones.groupBy(F.col("access_point_id").alias("_zp")).agg(F.min("zone_id").alias("_zone_id"))
    named = zones.select(F.col("id").alias("_zid"), F.col("name").alias("_zone"))
    out = (
        points.filter(F.col("mac_address").isNotNull())
        .join(level("floor"), F.col("sensor_id") == F.col("_floor_id"), "left")
        .join(level("building"), F.col("_floor_up") == F.col("_building_id"), "left")
        .join(level("campus"), F.col("_building_up") == F.col("_campus_id"), "left")
        .join(first_zone, F.col("id") == F.col("_zp"), "left")
        .join(named, F.col("_zone_id") == F.col("_zid"), "left")
    )
    place = lambda c: (F.floor(F.col(c).cast("double") * 100000 + 0.5) / 100000).cast("string")
    return out.select(
        "mac_address",
        F.when(
            F.col("latitude").isNotNull() & F.col("longitude").isNotNull(),
            F.concat_ws(",", place("latitude"), place("longitude")),
        ).alias("client_latlong"),
        *[F.coalesce(F.col(f"_{n}"), F.lit(UNKNOWN)).alias(f"client_{n}") for n in ("campus", "building", "floor", "zone")],
    )


def access_point(df: DataFrame, locations: DataFrame, *, station="wireless_station") -> DataFrame:
    """Attach the location of the record's access point (null without one)."""
    dim = locations.withColumnRenamed("mac_address", "_ap")
    taken = [c for c in dim.columns if c in df.columns]
    return df.drop(*taken).join(dim, F.col(station) == F.col("_ap"), "left").drop("_ap")

