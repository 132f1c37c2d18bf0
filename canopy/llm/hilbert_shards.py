"""Sharding by Hilbert-curve order.

Language, source, size and identifier are quantised to a grid, rows are sorted
by their index on the Hilbert curve through it, and the order is cut into runs
of equal row counts. Rows near each other in any of these dimensions tend to
share a shard, so a shard's minima and maxima let a reader skip it.

Equal texts take the place of the one with the smallest identifier and are
neighbours in the order, so a cut parts a group only where the law `rows`
(shard counts at most one apart) leaves no choice.

The grid's bounds are exact quantiles of all rows, found by rank, so the same
rows give the same shards however they are dealt.

Only built-in column functions are used. Texts are read once, for size,
checksum and hash; what is shuffled is a narrow row per document. A hot group
spreads over range partitions because the identifier is part of the key.

Defined cases: a null text has size 1 and checksum 0 and is grouped with
empty ones; null language, source or identifier take grid cell 0; ties are
ordered by text hash and identifier, rows with null identifiers before others;
rows that repeat each get a place of their own; very long texts are read
whole; other columns aren't looked at, and written shards hold them as they
are, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopy.llm._store import Work, table

BITS = 6


def hilbert_index(axes: list[Column], bits: int) -> Column:
    """The Hilbert index of a grid point, by axes-to-transpose and bit interleaving.

    The point is folded through as one array, so the expression stays small.
    """
    n = len(axes)
    point = F.array(*[a.cast("long") for a in axes])
    at = lambda x, i: F.element_at(x, F.lit(i + 1) if isinstance(i, int) else (i + 1).cast("int"))
    shift = lambda k: F.expr(f"shiftleft(1L, {k})")

    def undo(x: Column, step: Column) -> Column:
        q, i = step["q"], step["i"]
        p = q - 1
        xi, x0 = F.element_at(x, i + 1), F.element_at(x, 1)
        t = x0.bitwiseXOR(xi).bitwiseAND(p)
        hit = xi.bitwiseAND(q) != 0
        return F.transform(
            x,
            lambda v, j: F.when(hit, F.when(j == 0, v.bitwiseXOR(p)).otherwise(v)).otherwise(
                F.when((j == 0) & (i == 0), v).when((j == 0) | (j == i), v.bitwiseXOR(t)).otherwise(v)
            ),
        )

    steps = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i).alias("i")) for b in range(bits - 1, 0, -1) for i in range(n)])
    x = F.aggregate(steps, point, undo)
    gray = F.aggregate(
        F.sequence(F.lit(2), F.lit(n)), x, lambda y, i: F.transform(y, lambda v, j: F.when(j == i - 1, v.bitwiseXOR(F.element_at(y, i - 1))).otherwise(v))
    )
    turned = F.transform(
        F.array(gray),
        lambda y: F.transform(
            y,
            lambda v: v.bitwiseXOR(
                F.aggregate(F.array(*[F.lit(1 << b).cast("long") for b in range(bits - 1, 0, -1)]), F.lit(0).cast("long"), lambda t, q: F.when(at(y, n - 1).bitwiseAND(q) != 0, t.bitwiseXOR(q - 1)).otherwise(t))
            ),
        ),
    )
    bit_order = F.array(*[F.struct(F.lit(1 << b).cast("long").alias("q"), F.lit(i + 1).alias("i")) for b in range(bits - 1, -1, -1) for i in range(n)])
    return F.element_at(
        F.transform(
            turned,
            lambda y: F.aggregate(bit_order, F.lit(0).cast("long"), lambda h, s: h * 2 + F.when(F.element_at(y, s["i"]).bitwiseAND(s["q"]) != 0, F.lit(1)).otherwise(F.lit(0)).cast("long")),
        ),
        1,
    )


def _cell(column: str, bounds: list, bits: int) -> Column:
    """The number of quantile bounds below a value."""
    inner = sorted({b for b in bounds or [] if b is not None})[: (1 << bits) - 1]
    if not inner:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(b).cast("long") for b in inner]), lambda b: b < F.col(column))), F.lit(0))


def _ranked(work: Work, df: DataFrame, key: list[str], name: str) -> tuple[DataFrame, int]:
    """df with the place of each row in key's order, as _rank from 0, and the number of rows."""
    lined = work.save(df.repartitionByRange(*key).sortWithinPartitions(*key).withColumn("_at", F.monotonically_increasing_id()), name)
    part = F.shiftrightunsigned("_at", 33)
    parts = lined.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = parts.select("_part", (F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")).alias("_before"))
    # A row for each range partition: bounded by the partition count.
    ranked = lined.withColumn("_part", part).join(F.broadcast(before), "_part")
    return ranked.withColumn("_rank", F.col("_before") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))), lined.count()


def _bounds(work: Work, df: DataFrame, column: str, bits: int) -> list[int]:
    """The values at the whole 2**bits-ths of column's order."""
    ranked, n = _ranked(work, df.select(column).filter(F.col(column).isNotNull()), [column], f"by-{column}")
    marks = sorted({k * n >> bits for k in range(1, 1 << bits)} - {n})
    found = [r[0] for r in ranked.filter(F.col("_rank").isin(marks)).select(column).collect()] if n else []  # at most 2**bits rows
    work.drop(f"by-{column}")
    return found


def hilbert_order(spark: SparkSession, docs: DataFrame, bits: int = BITS, keep: tuple[str, ...] = ()) -> tuple[DataFrame, int]:
    """A row per document with its place in the curve's order, and the number of rows; columns in keep go along."""
    work = Work(spark, "hilbert")
    text = F.coalesce("text", F.lit(""))
    meta = work.save(
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            (F.octet_length(text).cast("long") + 1).alias("size"),
            F.crc32(text.cast("binary")).alias("text_crc32"),
            F.xxhash64(text).alias("_text"),
            F.struct(F.xxhash64("lang").alias("lang"), F.xxhash64("source").alias("source")).alias("_meta"),
            F.col("lang").isNull().alias("_nolang"),
            F.col("source").isNull().alias("_nosource"),
            *keep,
        ),
        "meta",
    )
    same = ["_text", "size", "text_crc32"]
    lead = meta.groupBy(*same).agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "_nolang", "_nosource", "_meta")).alias("_lead"))
    bounds = {c: _bounds(work, meta, c, bits) for c in ("size", "doc_id")}
    hashed = lambda c, none: F.when(F.col(none), F.lit(0)).otherwise(F.pmod(F.shiftright(F.col(c), 7), F.lit(1 << bits)))
    axes = [hashed("_lead._meta.lang", "_lead._nolang"), hashed("_lead._meta.source", "_lead._nosource"), _cell("size", bounds["size"], bits), _cell("_lead.doc_id", bounds["doc_id"], bits)]
    # Written first, so that the join below is one of two plain shuffles, which adaptive execution splits where a text is hot.
    curve = work.save(lead.withColumn("_curve", hilbert_index(axes, bits)).select(*same, "_curve"), "curve")
    placed = meta.select(*same, "doc_id", *keep).join(curve, same)
    return _ranked(work, placed, ["_curve", "_text", "size", "text_crc32", "doc_id"], "lined")


def shard_by_hilbert(spark: SparkSession, docs: DataFrame, shards: int = 16, keep: tuple[str, ...] = ()) -> DataFrame:
    """doc_id, size, text_crc32, law `rows`, shard, slot, grown_shard (null), curve index and the columns in keep for each row."""
    ranked, n = hilbert_order(spark, docs, keep=keep)
    shard = F.expr(f"(_rank * {shards}) div {max(n, 1)}")
    first = F.expr(f"(_shard * {n} + {shards - 1}) div {shards}")
    return ranked.withColumn("_shard", shard).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("rows").alias("law"),
        F.col("_shard").cast("int").alias("shard"),
        (F.col("_rank") - first).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
        F.col("_curve").alias("hilbert"),
        *keep,
    )


def write_shards(spark: SparkSession, docs: DataFrame, path: str, shards: int = 16) -> str:
    """docs as one folder a shard, each shard's rows in curve order within its files; gives the shard column's name.

    Rows are numbered and written first, so each meets its own place. The column
    is `_shard`, with more underscores before it where docs has one of that name.
    """
    work = Work(spark, "shards")
    name = "_shard"
    while name.lower() in [c.lower() for c in docs.columns]:
        name = "_" + name
    whole = work.save(docs.select(F.monotonically_increasing_id().alias("_row"), F.struct("*").alias("_whole")), "whole")
    rows = whole.select("_row", *[F.col(f"_whole.{c}") for c in ("doc_id", "text", "lang", "source")])
    plan = shard_by_hilbert(spark, rows, shards, ("_row",)).select("_row", "shard", "slot")
    lined = whole.join(plan, "_row").repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot")
    lined.select("_whole.*", F.col("shard").alias(name)).write.mode("overwrite").partitionBy(name).parquet(path)
    return name


def op10_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_by_hilbert(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op10_hilbert_shards": op10_hilbert_shards}
ORACLE: dict[str, str] = {}
