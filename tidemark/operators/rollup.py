"""Minute roll-ups of flows, events and monitor values, and throughput."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Dimensions of the flow roll-up.
FLOW_DIMENSIONS = (
    "application_id_name biflow_direction conversation direction engine_id_name http_user_agent_os http_host "
    "http_social_media http_social_user http_referer_l1 l4_proto ip_protocol_version sensor_name scatterplot src "
    "src_country_code src_net_name src_port src_as_name client_mac client_id client_mac_vendor dot11_status src_vlan "
    "src_map srv_port dst dst_country_code dst_net_name dst_port dst_as_name dst_vlan dst_map input_snmp output_snmp "
    "tos client_latlong coordinates_map client_campus client_building client_floor wireless_id client_rssi "
    "client_rssi_num client_snr client_snr_num wireless_station hnblocation hnbgeolocation rat darklist_score_name "
    "darklist_category darklist_protocol darklist_direction darklist_score"
).split()

# Dimensions of the event roll-up.
EVENT_DIMENSIONS = (
    "action classification conversation domain_name ethlength_range group_name sig_generator icmptype iplen_range "
    "l4_proto rev sensor_name priority msg sig_id scatterplot ethsrc ethsrc_vendor src src_country_code src_net_name "
    "src_port src_as_name src_map ethdst ethdst_vendor dst dst_country_code dst_net_name dst_port dst_as_name dst_map "
    "tos ttl vlan darklist_score_name darklist_category darklist_protocol darklist_direction darklist_score"
).split()

# Columns that are not dimensions of the monitor roll-up.
MONITOR_EXCLUDED = ("unit", "type", "timestamp", "value")

WATERMARK = "15 minutes"


def _minute(df: DataFrame, timestamp: str) -> DataFrame:
    """Start of the record's minute, epoch seconds."""
    return df.withColumn("minute", F.floor(F.col(timestamp) / 60) * 60)


def _grouped(df: DataFrame, dims: Sequence[str], timestamp: str):
    present = [d for d in dims if d in df.columns]
    if df.isStreaming:
        timed = df.withColumn("_event_time", F.timestamp_seconds(timestamp)).withWatermark("_event_time", WATERMARK)
        return timed.groupBy(F.window("_event_time", "1 minute").alias("_w"), *present), present
    return _minute(df, timestamp).groupBy("minute", *present), present


def _finish(df: DataFrame) -> DataFrame:
    if "_w" in df.columns:
        return df.withColumn("minute", F.unix_seconds("_w.start")).drop("_w")
    return df


def flows(df: DataFrame, *, dims: Sequence[str] = FLOW_DIMENSIONS, timestamp="timestamp") -> DataFrame:
    """Flows per minute and dimensions: ``events``, ``sum_bytes``, ``sum_pkts``."""
    grouped, _ = _grouped(df, dims, timestamp)
    return _finish(
        grouped.agg(
            F.count(F.lit(1)).alias("events"),
            F.sum(F.col("bytes").cast("bigint")).alias("sum_bytes"),
            F.sum(F.col("pkts").cast("bigint")).alias("sum_pkts"),
        )
    )


def events(df: DataFrame, *, dims: Sequence[str] = EVENT_DIMENSIONS, timestamp="timestamp") -> DataFrame:
    """Security events per minute and dimensions: ``events``."""
    grouped, _ = _grouped(df, dims, timestamp)
    return _finish(grouped.agg(F.count(F.lit(1)).alias("events")))


def monitor(df: DataFrame, *, timestamp="timestamp") -> DataFrame:
    """Monitor values per minute and every column that is not excluded."""
    dims = [c for c in df.columns if c not in (*MONITOR_EXCLUDED, timestamp)]
    grouped, _ = _grouped(df, dims, timestamp)
    value = F.col("value").cast("double")
    return _finish(
        grouped.agg(
            F.count(F.lit(1)).alias("events"),
            F.sum(value).alias("sum_value"),
            F.max(value).alias("max_value"),
            F.min(value).alias("min_value"),
        )
    )


def throughput(df: DataFrame, source: str, *, seconds: int = 50, timestamp="timestamp") -> DataFrame:
    """Messages per second of each source over fixed periods, as monitor rows."""
    period = F.floor(F.col(timestamp) / seconds) * seconds
    counts = df.groupBy(period.alias("timestamp"), F.col(source).alias("sensor_name")).agg(
        (F.count(F.lit(1)) / F.lit(seconds)).alias("value")
    )
    return counts.withColumns({"monitor": F.lit("throughput"), "unit": F.lit("msg/s")})


def minute_mean(rates: DataFrame) -> DataFrame:
    """Mean of the period rates inside each minute."""
    return _minute(rates, "timestamp").groupBy("minute", "sensor_name").agg(F.avg("value").alias("mean_value"))


def by_hour(rolled: DataFrame) -> DataFrame:
    """Add the hour the stored roll-up is partitioned by."""
    return rolled.withColumn("hour", F.floor(F.col("minute") / 3600) * 3600)
