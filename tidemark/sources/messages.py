"""Message text to records and back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_CORRUPT = "_corrupt_record"
MOBILE_TAGS = ("hnbid", "ipAddress", "imsi", "apn", "rat", "msisdn", "location", "hnbGeoLocation")
#: Not a character of any XML text, so it parts the texts of tags without doubt.
_APART = "\uffff"


def _once(df: DataFrame, name: str, value) -> DataFrame:
    """``withColumn`` for costly values: Spark evaluates them once a row, not again in every filter and column that uses them."""
    return df.select("*", F.explode(F.array(value)).alias(name))


def parse_json(df: DataFrame, column: str, schema: T.DataType | str, out: str = "record") -> tuple[DataFrame, DataFrame]:
    """Split messages into parsed records and rejected texts; null and empty texts are dropped."""
    if isinstance(schema, str):
        schema = T.DataType.fromDDL(schema)
    fields = list(schema.fields) + [T.StructField(_CORRUPT, T.StringType())]
    parsed = F.from_json(
        F.col(column), T.StructType(fields), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    present = df.filter(F.col(column).isNotNull() & (F.trim(F.col(column)) != "")).withColumn(out, parsed)
    broken = F.col(out).isNull() | F.col(f"{out}.{_CORRUPT}").isNotNull()
    good = present.filter(~broken).withColumn(out, F.col(out).dropFields(_CORRUPT)).drop(column)
    rejected = present.filter(broken).drop(out)
    return good, rejected


def parse_mobile(df: DataFrame, column: str = "value") -> DataFrame:
    """Mobile-session XML to ``key`` plus record fields; texts without a key are dropped.

    ``feed``/``add`` with a cell id is keyed by path, any other ``feed``/``add`` by
    address, and ``notify``/``add`` by subscriber. The texts of all tags come from one reading of the document.
    """
    probe = F.from_xml(
        F.col(column),
        T.StructType([T.StructField("_type", T.StringType()), T.StructField("_path", T.StringType()),
                      T.StructField(_CORRUPT, T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT},
    )
    good = _once(df, "_p", probe).filter(
        F.col("_p").isNotNull() & F.col(f"_p.{_CORRUPT}").isNull() & (F.col("_p._type") == "add")
    )
    xml = F.col(column)
    parts = f", '{_APART}', ".join(f"boolean(//{tag}), '{_APART}', //{tag}" for tag in MOBILE_TAGS)
    good = _once(good, "_tags", F.split(F.xpath_string(xml, F.lit(f"concat({parts})")), _APART))

    def text(tag: str):
        at = 2 * MOBILE_TAGS.index(tag)
        return F.when(F.col("_tags")[at] == "true", F.col("_tags")[at + 1])

    root = F.regexp_extract(xml, r"^\s*(?:<\?[^>]*\?>)?\s*<([A-Za-z]+)", 1)
    cell = (root == "feed") & text("hnbid").isNotNull()
    session = (root == "feed") & text("hnbid").isNull()
    notice = root == "notify"
    path = F.col("_p._path")
    return good.select(
        *[c for c in df.columns if c != column],
        F.when(cell, path).when(session, text("ipAddress")).when(notice, text("imsi")).alias("key"),
        F.when(session, text("imsi")).alias("client_id"),
        F.when(session, text("apn")).alias("wireless_id"),
        F.when(session, text("rat")).alias("rat"),
        F.when(session, text("msisdn")).alias("msisdn"),
        F.when(cell, text("hnbid")).alias("wireless_station"),
        F.when(cell, text("location")).alias("hnblocation"),
        F.when(cell, text("hnbGeoLocation")).alias("hnbgeolocation"),
        F.when(notice, path).alias("path"),
    ).filter(F.col("key").isNotNull())


def to_messages(
    df: DataFrame, topic: str | None = None, *, route: str | None = None, key: str | None = None
) -> DataFrame:
    """Rows as JSON text in ``value``, with a ``topic`` and a ``key`` column for the sink where asked.

    ``route`` names a column that holds each row's own topic; rows without one are skipped.
    ``key`` names the column whose text becomes the message key; it stays in the message.
    """
    body = [c for c in df.columns if c != route]
    rows = df if route is None else df.filter(F.col(route).isNotNull())
    out = [F.to_json(F.struct(*body)).alias("value")]
    if key is not None:
        out.insert(0, F.col(key).cast("string").alias("key"))
    if route is not None or topic is not None:
        out.insert(0, (F.col(route) if route is not None else F.lit(topic)).alias("topic"))
    return rows.select(*out)


def replay(spark, rows: list[tuple], schema: str) -> DataFrame:
    """Literal rows as a stream in arrival order, with ``ts`` (one second apart) and ``seq``."""
    width = len(T.StructType.fromDDL(schema).fields)
    timed = [(*r, i) for i, r in enumerate(rows) if len(r) == width]
    if len(timed) != len(rows):
        raise ValueError("every row needs as many values as the schema has fields")
    df = spark.createDataFrame(timed, f"{schema}, seq bigint")
    return df.withColumn("ts", F.timestamp_seconds(F.col("seq") + 1_700_000_000))
