"""Case selection and deduplication."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def audited_decisions(publications: DataFrame) -> DataFrame:
    """By case, the decision to audit: a final one before a draft, the latest first, then the smallest id.

    Cases without a decision are pending; rows without a case number are left to the caller.
    A struct maximum takes the place of a sort, so each task sums up before the shuffle.
    """
    rank = F.when(F.col("kind") == "besluit", 2).when(F.col("kind") == "ontwerpbesluit", 1)
    order = F.struct(-rank, F.date_diff(F.lit("9999-12-31").cast("date"), F.col("available")), "id")
    best = F.min(F.when(rank.isNotNull(), F.struct(order.alias("order"), F.col("id"))))
    keyed = publications.filter("zaaknummer IS NOT NULL AND zaaknummer <> ''")
    cases = keyed.groupBy("zaaknummer").agg(F.count("*").alias("n_publications"), best.alias("best"))
    return cases.select("zaaknummer", "n_publications", F.col("best.id").alias("decision"), F.col("best").isNull().alias("pending"))


def first_by(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """The first row of each key in a total order; each task hands on one row a key at most."""
    return df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).filter("_rn = 1").drop("_rn")


def unseen_content(arrived: DataFrame, known: DataFrame) -> DataFrame:
    """Arrivals whose (id, content hash) isn't known."""
    hashed = arrived.withColumn("content_sha256", F.sha2("content", 256))
    return hashed.join(known.select("id", "content_sha256").distinct(), ["id", "content_sha256"], "left_anti")


def landed_versions(rows: DataFrame, key: str, version: str, content: str, tie: str, bucket: F.Column) -> DataFrame:
    """By key, how often the content differs from the version before, the latest version and its content.

    bucket must not decrease with the version: versions are compared within buckets,
    and each bucket's first with the last of the bucket before, so no task orders all
    versions of a key.
    """
    at = F.struct(version, tie)
    own = rows.withColumn("_b", bucket)
    prior = F.lag(content).over(Window.partitionBy(key, "_b").orderBy(version, tie))
    changed = own.withColumn("_prior", prior).withColumn("_new", F.col("_prior").isNotNull() & (F.col("_prior") != F.col(content)))
    buckets = changed.groupBy(key, "_b").agg(F.count_if("_new").alias("n"), F.min_by(content, at).alias("first"), F.max_by(content, at).alias("last"), F.max(version).alias("latest"))
    before = F.lag("last").over(Window.partitionBy(key).orderBy("_b"))  # a row a bucket
    edges = buckets.withColumn("before", before).withColumn("n", F.col("n") + F.when(F.col("before").isNull() | (F.col("before") != F.col("first")), 1).otherwise(0))
    return edges.groupBy(key).agg(F.sum("n").alias("landed"), F.max("latest").alias("latest"), F.max_by("last", "_b").alias(content))


def ordered_union(buckets: list[DataFrame], key: str, order: str) -> DataFrame:
    """Rows of several buckets, each key once, at its place in the earliest bucket."""
    whole = None
    for k, b in enumerate(buckets):
        part = b.select(key, order).withColumn("bucket", F.lit(k))
        whole = part if whole is None else whole.unionByName(part)
    return whole.groupBy(key).agg(F.min(F.struct("bucket", order)).alias("_at")).select(key, F.col("_at.bucket").alias("bucket"), F.col(f"_at.{order}").alias(order))


def unique_interventions(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Interventions by identifier, the earliest date winning, and how many rows had none."""
    keyed = rows.filter("iri IS NOT NULL AND iri <> ''")
    return keyed.groupBy("iri").agg(F.min("pub").alias("pub")), rows.agg(F.count_if(F.col("iri").isNull() | (F.col("iri") == "")).alias("skipped"))
