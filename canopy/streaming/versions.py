"""Graph versions as a stream: each micro-batch of staged facts is one run.

Periods are opened and closed by the batch operators; a batch writes a whole
new version of the store under its own number, so a repeated batch gives what
it gave before and an unfinished one is not seen.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.operators import graph as g

QUADS = "graph string, s string, p string, o string"
NOTES = "graph string, s string, p string, o string, ap string, av string"
STAGED = f"{NOTES}, at timestamp"  # a null ap is a quad, else an annotation


def _versions(spark: SparkSession, store: str) -> list[int]:
    """Numbers of finished versions, through Spark's file system, so that any store will do."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(store)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    done = [s.getPath().getParent().getParent().getName() for s in fs.globStatus(jvm.org.apache.hadoop.fs.Path(f"{store}/v*/notes/_SUCCESS"))]
    return sorted(int(n[1:]) for n in done)


def current(spark: SparkSession, store: str, before: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Quads and annotations of the latest finished version, or of the latest one before a number."""
    found = [v for v in _versions(spark, store) if before is None or v < before]
    if not found:
        return spark.createDataFrame([], QUADS), spark.createDataFrame([], NOTES)
    at = f"{store}/v{found[-1]}"
    return spark.read.schema(QUADS).parquet(f"{at}/quads"), spark.read.schema(NOTES).parquet(f"{at}/notes")


def version_stream(spark: SparkSession, folder: str, store: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """Applies every staged file that is new as runs and gives the store as it is then."""

    def apply(batch: DataFrame, batch_id: int) -> None:
        live, notes = current(spark, store, batch_id)
        when = batch.agg(F.max("at").alias("at")).first()["at"]
        staged = batch.filter("ap IS NULL").select("graph", "s", "p", "o")
        staged_notes = batch.filter("ap IS NOT NULL").select(notes.columns)
        quads, after, _ = g.upsert_run(spark, live, notes, staged, staged_notes, F.lit(when))
        quads.write.mode("overwrite").parquet(f"{store}/v{batch_id}/quads")
        after.write.mode("overwrite").parquet(f"{store}/v{batch_id}/notes")

    stream = spark.readStream.schema(STAGED).option("maxFilesPerTrigger", 1).parquet(folder)
    stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
    return current(spark, store)
