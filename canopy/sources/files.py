"""Files and written tables through Spark's own file system, so that any store Spark can reach will do."""

from __future__ import annotations

import atexit
import tempfile
import uuid
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

_WRITTEN: list[tuple[SparkSession, str]] = []


class Files:
    """Small driver-side payloads by path or URI."""

    def __init__(self, spark: SparkSession | None = None):
        self.spark = spark or SparkSession.getActiveSession() or SparkSession.builder.getOrCreate()

    def _at(self, path: str):
        at = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        return at.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()), at

    def exists(self, path: str) -> bool:
        fs, at = self._at(path)
        return fs.exists(at)

    def names(self, path: str) -> list[str]:
        """What a folder holds, without hidden files; an absent one holds nothing."""
        fs, at = self._at(path)
        return sorted(n for s in (fs.listStatus(at) if fs.exists(at) else []) if not (n := s.getPath().getName()).startswith("."))

    def empty(self, path: str) -> list[str]:
        """Files of a folder that hold nothing, which Spark's readers pass over."""
        fs, at = self._at(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(at) if s.isFile() and s.getLen() == 0)

    def read(self, path: str) -> bytes | None:
        """The content, or None if there is no such file."""
        fs, at = self._at(path)
        if not fs.exists(at):
            return None
        stream = fs.open(at)
        try:
            return bytes(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toByteArray(stream))
        finally:
            stream.close()

    def write(self, path: str, blocks: bytes | Iterable[bytes]) -> None:
        """The file appears whole or not at all."""
        fs, part = self._at(f"{path}.part")
        out = fs.create(part, True)
        try:
            for block in [blocks] if isinstance(blocks, bytes) else blocks:
                out.write(block, 0, len(block))
        except BaseException:
            out.close()
            fs.delete(part, False)
            raise
        out.close()
        self.move(f"{path}.part", path)

    def move(self, source: str, target: str) -> None:
        fs, to = self._at(target)
        fs.delete(to, True)
        if not fs.rename(self._at(source)[1], to):
            raise OSError(f"can't move {source} to {target}")

    def delete(self, path: str) -> None:
        fs, at = self._at(path)
        fs.delete(at, True)


def small_tasks(spark: SparkSession, mb: int = 4) -> None:
    """Lets Spark merge shuffle partitions up to so many MB only.

    It goes by compressed bytes, and tables of identifiers shrink to a fiftieth: tasks of the usual 64 MB would need gigabytes.
    """
    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(key)) > mb << 20:
        spark.conf.set(key, f"{mb}m")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share; only a local session without one gets its own."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        found = "file://" + tempfile.mkdtemp(prefix="canopy-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def own_dir(spark: SparkSession, name: str) -> str:
    """A fresh folder of one call there, deleted with the session."""
    path = f"{shared_dir(spark)}/canopy-{name}-{uuid.uuid4().hex}"
    _WRITTEN.append((spark, path))
    return path


def written(df: DataFrame, name: str = "table") -> DataFrame:
    """df as a table on the shared store: worked out once however often it is read, and the end of its lineage."""
    path = own_dir(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@atexit.register
def _close() -> None:
    for spark, path in _WRITTEN:
        try:
            if spark.sparkContext._jsc is not None:
                Files(spark).delete(path)
        except Exception:  # the session is gone; the folder's owner clears it
            return
