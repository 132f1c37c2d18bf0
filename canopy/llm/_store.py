"""Where intermediate tables go, and how they are freed.

Every table an operator cuts its lineage with is written under the folder
named by ``spark.checkpoint.dir``; only a local-mode session that has none
gets a folder of its own.
"""

from __future__ import annotations

import atexit
import gc
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OPEN: list[tuple[SparkSession, str]] = []


def base_dir(spark: SparkSession) -> str:
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="canopy-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


class Work:
    """The intermediate tables of one call of an operator."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.path = f"{base_dir(spark)}/canopy-{name}-{uuid.uuid4().hex}"
        _OPEN.append((spark, self.path))
        # Rows with long texts: small Arrow batches bound a worker's memory.
        for key, value in (("spark.sql.execution.arrow.maxRecordsPerBatch", "2000"), ("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))):
            spark.conf.set(key, value)

    def save(self, df: DataFrame, name: str) -> DataFrame:
        """Writes df, forgets its lineage and the shuffle files behind it, reads it again."""
        at = f"{self.path}/{name}"
        df.write.mode("overwrite").option("compression", "snappy").parquet(at)
        out = self.spark.read.schema(df.schema).parquet(at)
        del df
        gc.collect()
        self.spark.sparkContext._jvm.System.gc()
        return out

    def drop(self, *names: str) -> None:
        """Deletes tables that nothing reads any more."""
        for name in names:
            _delete(self.spark, f"{self.path}/{name}")


def opened() -> int:
    return len(_OPEN)


def release(mark: int) -> None:
    """Deletes what was opened after a mark, once its results are written elsewhere."""
    while len(_OPEN) > mark:
        _delete(*_OPEN.pop())


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


@atexit.register
def _close() -> None:
    for spark, path in _OPEN:
        try:
            if spark.sparkContext._jsc is not None:
                _delete(spark, path)
        except Exception:  # the session is gone; the folder's owner clears it
            return


KEY = ["doc", "sig"]


def keyed(docs: DataFrame, *keep: Column) -> DataFrame:
    """doc, sig and keep of docs(doc_id, text): rows with different identifiers or texts differ in doc or sig; sig is odd where there is no identifier."""
    own = F.col("doc_id").cast("long")
    sig = F.shiftleft(F.xxhash64(F.col("text").cast("string")), 1).bitwiseOR(own.isNull().cast("long"))
    return docs.select(F.coalesce(own, F.lit(0)).alias("doc"), sig.alias("sig"), *keep)


def doc_id() -> Column:
    """The identifier that doc and sig stand for."""
    return F.when(F.col("sig").bitwiseAND(F.lit(1)) == 0, F.col("doc")).alias("doc_id")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
