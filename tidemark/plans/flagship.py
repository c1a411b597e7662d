"""The first end-to-end query: filter, tumbling batch, aggregates, having."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import predicates as P
from tidemark.operators import aggregates as A
from tidemark.operators import windows as W
from tidemark.plans.registry import QUERIES, query


@query(
    "flagship_daily_activity",
    """SELECT epoch_us(ts) // 86400000000 AS batch, user_id, count(*) AS n, CAST(sum(round(value * 100)) AS BIGINT) AS total, round(avg(value), 6) AS mean
    FROM events WHERE event_type <> 'view' AND value > 1 GROUP BY 1, 2 HAVING count(*) > 1""",
)
def flagship(t):
    live = t.events.filter(P.and_(P.ne(F.col("event_type"), F.lit("view")), P.gt(F.col("value"), F.lit(1))))
    batches = W.batches_by_time(live, W.DAY)
    aggs = {
        "n": A.count_rows(),
        "total": F.sum(F.round(F.col("value") * 100).cast("bigint")),
        "mean": F.round(A.average(F.col("value")), 6),
    }
    return A.batch_rows(batches, aggs, [], ["user_id"]).filter(F.col("n") > 1).withColumnRenamed("_batch", "batch")


def daily_activity(spark: SparkSession, folder: str) -> DataFrame:
    return QUERIES["flagship_daily_activity"](spark, folder)
