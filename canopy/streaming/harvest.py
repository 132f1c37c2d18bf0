"""The incremental harvest as a stream: cursor, late arrivals and stateful periods.

A file stream finds new arrivals; each micro-batch is deduplicated against what
is known by (id, content) and upserted, and the mark moves only when the batch
is written, so a failed batch is read again.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.functions.dates import FLOOR, OVERLAP_DAYS, since
from canopy.sources.files import Files

BUCKETS = 64


class Cursor:
    """A high-water mark in a one-row JSON file on any store; missing or empty means the floor."""

    def __init__(self, path: str, floor: str = FLOOR):
        self.path, self.floor = path, floor

    def read(self) -> str:
        content = (Files().read(self.path) or b"").strip()
        return json.loads(content)["high_water_mark"] if content else self.floor

    def write(self, mark: str) -> None:
        Files().write(self.path, json.dumps({"high_water_mark": mark}).encode())

    def since(self, spark: SparkSession) -> str:
        """Where the next harvest starts."""
        return str(spark.range(1).select(since(F.lit(self.read()).cast("date"), self.floor, OVERLAP_DAYS)).first()[0])

    def advance(self, arrived: DataFrame, column: str = "available") -> str:
        """Moves to the latest date that parses, never back."""
        seen = arrived.agg(F.max(F.try_to_date(F.col(column), "yyyy-MM-dd")).alias("m")).first()["m"]
        mark = max(self.read(), str(seen)) if seen is not None else self.read()
        self.write(mark)
        return mark


def harvest_stream(spark: SparkSession, folder: str, schema, target: str, checkpoint: str, keys: list[str], order: str, glob: str = "*.parquet") -> DataFrame:
    """Reads what is new in a folder, keeps the latest row by key in the target, and gives the target.

    Keys are dealt to BUCKETS buckets. A micro-batch writes new versions of the
    buckets it touches, under its own number, so a repeated batch overwrites its own,
    an unfinished one isn't seen, and the other buckets stay as they are.
    """
    files = Files(spark)
    bucket = F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")

    def current(before: int | None = None) -> dict[int, str]:
        """By bucket its latest finished version, or the latest one before a batch."""
        done = sorted(int(n[1:]) for n in files.names(target) if files.exists(f"{target}/{n}/_SUCCESS"))
        return {int(n.partition("=")[2]): f"{target}/v{v}/{n}" for v in done if before is None or v < before for n in files.names(f"{target}/v{v}") if n.startswith("__bucket=")}

    def merge(batch: DataFrame, batch_id: int) -> None:
        touched = {r[0] for r in batch.select(bucket).distinct().collect()}  # at most BUCKETS
        prior = [path for k, path in current(batch_id).items() if k in touched]
        rows = batch.unionByName(spark.read.schema(batch.schema).parquet(*prior)) if prior else batch
        others = [c for c in batch.columns if c not in keys]
        latest = rows.groupBy(*keys).agg(F.max(F.struct(order, *[c for c in others if c != order])).alias("_r"))
        latest.select(*keys, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*batch.columns, bucket.alias("__bucket")).write.mode("overwrite").partitionBy("__bucket").parquet(f"{target}/v{batch_id}")

    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)
    query = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    found = current()
    return spark.read.schema(schema).parquet(*found.values()) if found else spark.createDataFrame([], schema)


def windowed_counts(spark: SparkSession, folder: str, schema, glob: str, checkpoint: str, out: str, late: str = "7 days") -> DataFrame:
    """Arrivals by day and type, with a watermark as long as the harvest's overlap."""
    stream = spark.readStream.schema(schema).option("pathGlobFilter", glob).parquet(folder)
    counts = stream.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("w"), "event_type").agg(F.count("*").alias("n"), F.max("value").alias("most"))

    def put(batch: DataFrame, batch_id: int) -> None:
        batch.select(F.col("w.start").cast("date").alias("day"), "event_type", "n", "most").write.mode("append").parquet(out)

    query = counts.writeStream.outputMode("update").foreachBatch(put).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    rows = spark.read.schema("day date, event_type string, n long, most double").parquet(out)
    return rows.groupBy("day", "event_type").agg(F.max("n").alias("n"), F.max("most").alias("most"))
