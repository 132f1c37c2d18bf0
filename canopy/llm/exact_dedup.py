"""Exact dedup by content sort.

Texts are normalised, dealt by sampled range splitters and sorted within each
partition, so equal texts lie side by side; neighbours are compared in full.
The splitters look at a short prefix, a hash and the identifier, so their
sample stays small however long the texts are, and a group that holds a third
of all rows spreads over many partitions. Only the first and last run of a
partition can go on in another one: those (at most two a partition) are merged
by their SHA-256 in a table bounded by the number of partitions.

Defined cases: a null text counts as empty; rows with a null identifier come
after all others of their text; of repeated rows with one identifier one
stays; an empty table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.llm._store import Work, table

SPACE = r"[\x20\x09-\x0D]+"
PREFIX = 32
_MARKS = T.StructType([
    T.StructField("keep_id", T.LongType()),
    T.StructField("group_size", T.LongType()),
    T.StructField("text_sha256", T.StringType()),
    T.StructField("_head", T.BooleanType()),
    T.StructField("_edge", T.BooleanType()),
    T.StructField("_part", T.IntegerType()),
])


def normalised(column) -> F.Column:
    return F.regexp_replace(F.coalesce(column, F.lit("")), SPACE, " ")


def _marker(heads_only: bool, payload: list[str]):
    """A mapInArrow function: sorted rows in, rows with their run's marks out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        held: list[pa.RecordBatch] = []  # of the run that may go on
        text: str | None = None
        size, lead, first = 0, None, True

        def marked(batch: pa.RecordBatch, keep, count, sha, head, edge) -> pa.RecordBatch:
            n = batch.num_rows
            full = lambda v, t: pa.array(v, t) if isinstance(v, (list, np.ndarray)) else pa.repeat(pa.scalar(v, t), n)
            cols = [batch.column(c) for c in payload]
            cols += [full(keep, pa.int64()), full(count, pa.int64()), full(sha, pa.string()), full(head, pa.bool_()), full(edge, pa.bool_()), full(part, pa.int32())]
            return pa.RecordBatch.from_arrays(cols, names=[*payload, *_MARKS.names])

        def close(edge: bool) -> Iterator[pa.RecordBatch]:
            sha = hashlib.sha256(text.encode()).hexdigest()
            for k, batch in enumerate(held):
                head = np.zeros(batch.num_rows, bool)
                head[:1] = k == 0
                yield marked(batch, lead, size, sha, head, edge)

        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            norm = batch.column("_norm")
            same = np.zeros(n, bool)
            same[0] = text is not None and norm[0].as_py() == text
            if n > 1:
                same[1:] = pc.equal(norm.slice(1), norm.slice(0, n - 1)).to_numpy(zero_copy_only=False)
            starts = np.flatnonzero(~same)
            slim = batch.select(payload)
            until = starts[0] if len(starts) else n
            if until:  # the held run goes on
                size += int(until)
                if not heads_only:
                    held.append(slim.slice(0, until))
            if not len(starts):
                continue
            if text is not None:
                yield from close(first)
                first = False
            ends = np.append(starts[1:], n)
            whole = len(starts) - 1
            if whole:
                ids = batch.column("doc_id")
                shas = [hashlib.sha256(norm[int(s)].as_py().encode()).hexdigest() for s in starts[:-1]]
                sizes = (ends - starts)[:-1]
                rows = starts[:-1] if heads_only else np.arange(starts[0], starts[-1])
                of = np.arange(whole) if heads_only else np.repeat(np.arange(whole), sizes)
                head = np.ones(whole, bool) if heads_only else np.isin(rows, starts)
                edge = np.zeros(len(rows), bool)
                if first:
                    edge[of == 0] = True
                    first = False
                keep = ids.take(pa.array(starts[:-1])).take(pa.array(of))
                out = slim.take(pa.array(rows))
                cols = [out.column(c) for c in payload]
                cols += [keep, pa.array(sizes[of], pa.int64()), pa.array(shas, pa.string()).take(pa.array(of)), pa.array(head), pa.array(edge), pa.repeat(pa.scalar(part, pa.int32()), len(rows))]
                yield pa.RecordBatch.from_arrays(cols, names=[*payload, *_MARKS.names])
            s = int(starts[-1])
            text, size, lead = norm[s].as_py(), n - s, batch.column("doc_id")[s].as_py()
            held = [slim.slice(s, 1 if heads_only else n - s)]
        if text is not None:
            yield from close(True)

    return run


def _sorted_runs(work: Work, docs: DataFrame, payload: list[str], heads_only: bool) -> tuple[DataFrame, DataFrame]:
    keyed = (
        docs.withColumn("_norm", normalised(F.col("text")))
        .withColumn("_prefix", F.substring("_norm", 1, PREFIX))
        .withColumn("_hash", F.xxhash64("_norm"))
    )
    order = [F.col("_prefix"), F.col("_hash")]
    dealt = keyed.repartitionByRange(*order, F.col("doc_id").asc_nulls_last())
    lined = dealt.sortWithinPartitions(*order, F.col("_norm"), F.col("doc_id").asc_nulls_last()).select(*payload, "_norm")
    schema = T.StructType([f for f in lined.schema.fields if f.name != "_norm"] + _MARKS.fields)
    runs = work.save(lined.mapInArrow(_marker(heads_only, payload), schema), "runs")
    edges = runs.filter("_edge AND _head").groupBy("text_sha256").agg(
        F.min_by(F.struct("keep_id", "_part"), F.struct(F.col("keep_id").isNull(), "keep_id", "_part")).alias("_lead"),
        F.sum("group_size").alias("_size"),
    )
    return runs, edges


def exact_dedup(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """A row per row of docs(doc_id, text): doc_id, keep_id, group_size, kept, text_sha256."""
    runs, edges = _sorted_runs(Work(spark, "exact"), docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), ["doc_id"], False)
    # At most two edge runs a partition: bounded by the partition count, not the data.
    joined = runs.join(F.broadcast(edges), "text_sha256", "left")
    return joined.select(
        "doc_id",
        F.when(F.col("_size").isNull(), F.col("keep_id")).otherwise(F.col("_lead.keep_id")).alias("keep_id"),
        F.coalesce("_size", "group_size").alias("group_size"),
        (F.col("_head") & F.coalesce(F.col("_lead._part") == F.col("_part"), F.lit(True))).alias("kept"),
        "text_sha256",
    )


def keep_first(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """The rows of docs that stay, with docs' columns as they are."""
    names = docs.columns
    whole = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct("*").alias("_row"))
    runs, edges = _sorted_runs(Work(spark, "exact"), whole, ["doc_id", "_row"], True)
    joined = runs.join(F.broadcast(edges), "text_sha256", "left")
    kept = joined.filter(F.coalesce(F.col("_lead._part") == F.col("_part"), F.lit(True)))
    return kept.select([F.col("_row").getField(c).alias(c) for c in names])


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op2_exact_dedup": op2_exact_dedup}
ORACLE = {
    "op2_exact_dedup": r"""
        WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents),
        g AS (SELECT t, min(doc_id) AS keep_id, count(*) AS group_size FROM n GROUP BY t)
        SELECT n.doc_id, g.keep_id, g.group_size, n.doc_id = g.keep_id AS kept, sha256(n.t) AS text_sha256
        FROM n JOIN g USING (t)"""
}
