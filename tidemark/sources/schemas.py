"""Declared schemas of the telemetry messages."""

from pyspark.sql import types as T

# Object identifiers of the wireless trap message.
TRAP_CLIENT = ".1.3.6.1.4.1.9.9.599.1.2.32.0"
TRAP_RSSI = ".1.3.6.1.4.1.9.9.599.1.2.1.0"
TRAP_SNR = ".1.3.6.1.4.1.9.9.599.1.2.2.0"
TRAP_SSID = ".1.3.6.1.4.1.9.9.599.1.3.1.1.28.0"
TRAP_STATION = ".1.3.6.1.4.1.9.9.599.1.3.1.1.8.0"
TRAP_LOCATION = ".1.3.6.1.4.1.9.9.513.1.1.1.1.49.0"

TRAP = T.StructType(
    [
        T.StructField(TRAP_CLIENT, T.StringType()),
        T.StructField(TRAP_RSSI, T.IntegerType()),
        T.StructField(TRAP_SNR, T.IntegerType()),
        T.StructField(TRAP_SSID, T.StringType()),
        T.StructField(TRAP_STATION, T.StringType()),
        T.StructField(TRAP_LOCATION, T.StringType()),
        T.StructField("host", T.StringType()),
        T.StructField("timestamp", T.StringType()),
    ]
)

# Field names that differ only in case cannot share one struct, so ``location`` stays text
# and is read once per spelling.
LOCATION = (
    "struct<StreamingNotification:struct<subscriptionName:string,entity:string,deviceId:string,timestamp:string,"
    "location:string>,notifications:array<struct<notificationType:string,deviceId:string,subscriptionName:string,"
    "timestamp:bigint,locationMapHierarchy:string,ssid:string,band:string,status:int,apMacAddress:string,"
    "username:string>>>"
)
_GEO = "struct<latitude:double,lattitude:double,longitude:double>"
LOCATION_BODY = (
    f"struct<macAddress:string,mapInfo:struct<mapHierarchyString:string>,geoCoordinate:{_GEO},dot11Status:string,"
    "band:string,ssId:string,apMacAddress:string,ipAddress:array<string>>"
)
LOCATION_BODY_UPPER = f"struct<MapInfo:struct<mapHierarchyString:string>,GeoCoordinate:{_GEO}>"

RADIUS = (
    "struct<timestamp:string,`User-Name`:string,`NAS-IP-Address`:string,`NAS-Identifier`:string,"
    "`Framed-IP-Address`:string,`Calling-Station-Id`:string,`Called-Station-Id`:string>"
)

NMSP = (
    "struct<sensor_name:string,type:string,enrichment:map<string,string>,data:array<struct<client_mac:string,"
    "ap_mac:array<string>,rssi:array<int>,vlan_id:int,ip:string,wireless_station:string,wireless_id:string,"
    "dot11_status:string>>>"
)
