"""Streaming harvests over the event table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.plans.bindings import table
from canopy.sources.files import own_dir
from canopy.streaming import harvest


def stream_latest(spark: SparkSession, sf: str) -> DataFrame:
    """The latest event of each user, by a stream that upserts its micro-batches."""
    at = own_dir(spark, "stream")
    got = harvest.harvest_stream(spark, sf, table(spark, sf, "events").schema, f"{at}/target", f"{at}/checkpoint", ["user_id"], "ts", "events.parquet")
    return got.select("user_id", "ts", "event_id", "event_type")


def stream_windows(spark: SparkSession, sf: str) -> DataFrame:
    at = own_dir(spark, "stream")
    return harvest.windowed_counts(spark, sf, table(spark, sf, "events").schema, "events.parquet", f"{at}/checkpoint", f"{at}/out").withColumn("most", F.round("most", 6))


QUERIES = {f.__name__: f for f in (stream_latest, stream_windows)}
ORACLE = {
    "stream_latest": "SELECT user_id, ts, event_id, event_type FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1",
    "stream_windows": "SELECT ts::DATE AS day, event_type, count(*) AS n, round(max(value), 6) AS most FROM events GROUP BY 1, 2",
}
