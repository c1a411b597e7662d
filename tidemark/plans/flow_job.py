"""The telemetry flow pipeline end to end: parsed flows and state streams to minute roll-ups."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.telemetry import url_fields, with_default_time
from tidemark.operators import dimensions as D
from tidemark.operators import enrich as E
from tidemark.operators import records as R
from tidemark.operators import rollup as U


@dataclass
class Sources:
    """State streams and dimensions; those left out are skipped."""

    vendors: DataFrame | None = None
    countries: DataFrame | None = None
    networks: DataFrame | None = None
    trap: DataFrame | None = None
    location: DataFrame | None = None
    radius: DataFrame | None = None
    mobile: DataFrame | None = None
    access_points: DataFrame | None = None
    reputation: DataFrame | None = None


LOCATION_FIELDS = ["client_campus", "client_building", "client_floor", "client_latlong", "wireless_id", "wireless_station"]
RADIUS_FIELDS = ["client_id"]


def enriched(flows: DataFrame, sources: Sources, now: Column, *, ttl_ms: int = E.TTL_MS) -> DataFrame:
    """Flows with every configured enrichment. A field the flow already has wins."""
    own = set(flows.columns)
    out = flows.withColumn("timestamp", with_default_time(F.col("timestamp"), now))
    out = out.withColumn("ts", F.timestamp_seconds("timestamp"))
    if sources.vendors is not None:
        out = D.mac_vendor(out, sources.vendors)
    if sources.countries is not None and sources.networks is not None:
        out = D.geoip(out, sources.countries, sources.networks)
    if {"http_host", "http_url"} <= own:
        out = out.withColumns(url_fields(F.col("http_host"), F.col("http_url")))
    if sources.mobile is not None:
        out = E.mobile_chain(out, sources.mobile, ttl_ms=ttl_ms)
    states = []
    for frame, fields, hit in (
        (sources.trap, E.TRAP_FIELDS, "_trap"),
        (sources.location, LOCATION_FIELDS, "_location"),
        (sources.radius, RADIUS_FIELDS, None),
    ):
        if frame is not None:
            states.append(E.State(frame, "client_mac", {f: f for f in fields if f not in out.columns}, hit))
    if states:
        out = E.lookups(out, "client_mac", states, ttl_ms=ttl_ms)
    if sources.trap is not None:
        out = E.trap_defaults(out, "_trap")
    if sources.location is not None:
        out = E.location_defaults(out, "_location")
    if sources.access_points is not None:
        out = D.access_point(out, sources.access_points)
    if sources.reputation is not None:
        out = E.reputation(out, sources.reputation)
    return out


def minute_flows(flows: DataFrame, sources: Sources, now: Column, **options) -> DataFrame:
    """Enrich, cut into minute slices, roll up."""
    return U.flows(R.split_flow(enriched(flows, sources, now, **options).drop("ts"), now))
