"""SimHash near-dedup by covering locality-sensitive hashing.

Each bit of a fingerprint has a label of r + 1 bits, and each non-zero vector
of r + 1 bits gives one table: its mask keeps the fingerprint bits whose label
has odd parity with it. Any r labels leave a non-zero vector orthogonal to
them all, so every pair within r bits agrees on some mask and meets there
(Pagh's construction); with r = 3 there are 15 tables of about 34 bits.

Equal fingerprints are one node from the start, so groups of copies cost one
row. A bucket above MOST is hashed again by covering masks over its remaining
bits, up to LEVELS times, then compared block against block: nothing is
dropped, and no task gets more than two blocks. A bucket gives a spanning
forest of its links, never all pairs.

Rows are nodes by their fingerprints, whatever their identifiers; a component
is named after the smallest identifier of its rows.

Defined cases: null and empty texts have fingerprint zero and are linked like
any other; texts under three words are one shingle; very long texts are read
whole, shingles in blocks; rows that share an identifier but not a component
get one each of their own; a component without any identifier has a null
name, and still keeps one row only; of several rows with a component's
smallest identifier the one with the smallest text hash stays; other columns
pass through, whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from canopy.llm._graph import components
from canopy.llm._store import Work, table

RADIUS = 3
SEED = 42
SHINGLE = 3
MOST = 4096
LEVELS = 3


def fingerprint(text: bytes) -> int:
    import xxhash

    digest = xxhash.xxh64_digest
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    k = min(SHINGLE, len(words))
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    n = len(words) - k + 1
    counts = np.zeros(64, np.int64)
    for at in range(0, n, 1 << 17):
        to = min(n, at + (1 << 17))
        pairs = zip(starts[at:to].tolist(), ends[at + k - 1 : to + k - 1].tolist(), strict=True)
        hashes = b"".join([digest(joined[a:b], SEED) for a, b in pairs])
        counts += np.unpackbits(np.frombuffer(hashes, np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int("".join("1" if 2 * c > n else "0" for c in counts), 2)


def _printer(keep: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(t.as_py() or b"") for t in batch.column("text").cast(pa.binary())]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(np.array(prints, np.uint64).view(np.int64))], names=[*keep, "fp"])

    return run


def covering_masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """One mask over these bits for each non-zero vector."""
    labels = {b: i % ((1 << (radius + 1)) - 1) + 1 for i, b in enumerate(bits)}
    return [sum(1 << b for b in bits if (labels[b] & v).bit_count() % 2) for v in range(1, 1 << (radius + 1))]


def mask_levels(levels: int, radius: int = RADIUS) -> list[list[int]]:
    """By level, the bits that a bucket agrees on: each mask of a level has its own 15 at the next."""
    out = [covering_masks(list(range(64)), radius)]
    for _ in range(levels - 1):
        out.append([m | more for m in out[-1] for more in covering_masks([b for b in range(64) if not m >> b & 1], radius)])
    return out


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def forest(fp: np.ndarray, group: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Indices (member, root) of spanning stars of the links within each group; group is sorted."""
    n = len(fp)
    parent = np.arange(n)

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    last = np.searchsorted(group, group, "right")
    left = np.arange(n)
    step = 1
    while len(left := left[left + step < last[left]]):
        near = left[np.bitwise_count(fp[left] ^ fp[left + step]) <= radius]
        for i in near[parent[near] != parent[near + step]].tolist():
            a, b = find(i), find(i + step)
            if a != b:
                parent[max(a, b)] = min(a, b)
        step += 1
        if len(near):
            while len(np.flatnonzero(parent != (up := parent[parent]))):
                parent = up
    member = np.flatnonzero(parent != np.arange(n))
    return member, parent[member]


def _linker(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def links(rows: pa.RecordBatch) -> pa.RecordBatch:
            t, key, fp, rep = (rows.column(c).to_numpy() for c in ("t", "key", "fp", "rep"))
            group = np.concatenate(([0], np.cumsum((t[1:] != t[:-1]) | (key[1:] != key[:-1]))))
            size = np.bincount(group)
            several = size[group] > 1
            a, b = forest(fp[several].view(np.uint64), group[several], radius)
            rep = rep[several]
            return pa.RecordBatch.from_arrays([pa.array(rep[a]), pa.array(rep[b])], names=["a", "b"])

        for batch in batches:  # only whole groups are worked on; the last one waits
            if not batch.num_rows:
                continue
            t, key = batch.column("t").to_numpy(), batch.column("key").to_numpy()
            cut = np.flatnonzero((t != t[-1]) | (key != key[-1]))
            cut = int(cut[-1]) + 1 if len(cut) else 0
            if cut or held and (held[-1].column("t")[0].as_py(), held[-1].column("key")[0].as_py()) != (t[0], key[0]):
                yield links(_joined([*held, batch.slice(0, cut)]))
                held = []
            held.append(batch.slice(cut))
        if held:
            yield links(_joined(held))

    return run


def _joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    return pa.Table.from_batches(batches).combine_chunks().to_batches()[0]


def near_links(work: Work, prints: DataFrame, radius: int = RADIUS, most: int = MOST, levels: int = LEVELS) -> DataFrame:
    """Edges (a, b) between rep of prints(fp, rep), which connect exactly the prints within radius of one another."""
    masks = mask_levels(levels, radius)
    many = len(masks[0])
    fan = lambda df, level: df.withColumn("_j", F.explode(F.sequence(F.lit(0), F.lit(many - 1)))).select(
        (F.col("t") * many + F.col("_j")).alias("t"), "fp", "rep"
    ).withColumn("key", F.col("fp").bitwiseAND(F.element_at(F.array(*[F.lit(signed(m)) for m in masks[level]]), F.col("t") + 1)))
    link = lambda df: df.repartition("t", "key").sortWithinPartitions("t", "key").select("t", "key", "fp", "rep").mapInArrow(_linker(radius), "a long, b long")
    rows, found = prints.withColumn("t", F.lit(0)), []
    for level in range(levels):
        rows = fan(rows, level)
        big = work.save(rows.groupBy("t", "key").agg(F.count("*").alias("n")).filter(F.col("n") > most), f"big{level}")
        if big.isEmpty():
            found.append(link(rows))
            break
        found.append(link(rows.join(big, ["t", "key"], "left_anti")))
        rows = work.save(rows.join(big, ["t", "key"]), f"rows{level}")
    else:  # every bucket still too large: block against block
        blocks = F.ceil(F.col("n") * 2 / most).cast("int")
        rows = rows.withColumn("_b", F.pmod(F.xxhash64("fp"), blocks).cast("long")).withColumn("_o", F.explode(F.sequence(F.lit(0).cast("long"), blocks.cast("long") - 1)))
        paired = rows.withColumn("key", F.xxhash64("key", F.least("_b", "_o"), F.greatest("_b", "_o")))
        found.append(link(paired))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def _components_of(work: Work, marked: DataFrame, radius: int, most: int, levels: int) -> DataFrame:
    """(fp, root, component_id): by fingerprint, its component's smallest fingerprint and identifier."""
    prints = work.save(marked.groupBy("fp").agg(F.min("doc_id").alias("least")), "prints")
    roots = components(work, near_links(work, prints.select("fp", F.col("fp").alias("rep")), radius, most, levels))
    placed = prints.join(roots, F.col("fp") == F.col("node"), "left").select("fp", F.coalesce("root", "fp").alias("root"), "least")
    return placed.join(placed.groupBy("root").agg(F.min("least").alias("component_id")), "root").select("fp", "root", "component_id")


def simhash_components(spark: SparkSession, docs: DataFrame, radius: int = RADIUS, most: int = MOST, levels: int = LEVELS) -> DataFrame:
    """A row per row of docs(doc_id, text): doc_id, fingerprint, component_id."""
    work = Work(spark, "simhash")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    marked = work.save(rows.mapInArrow(_printer(["doc_id"]), "doc_id long, fp long"), "marked")
    placed = _components_of(work, marked, radius, most, levels)
    return marked.join(placed, "fp", "left").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def keep_representatives(spark: SparkSession, docs: DataFrame, radius: int = RADIUS, most: int = MOST, levels: int = LEVELS) -> DataFrame:
    """Of each component the row of docs with the smallest identifier, as it is."""
    work = Work(spark, "simhash")
    text = F.col("text").cast("string")
    # The rows are numbered and written, so that one of several with the same identifier can be told from the others.
    whole = docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("whole"), F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("hash"), text.alias("text"))
    keep = ["row", "doc_id", "hash", "whole"]
    schema = T.StructType([whole.schema[c] for c in keep] + [T.StructField("fp", T.LongType())])
    marked = work.save(whole.mapInArrow(_printer(keep), schema), "marked")
    placed = _components_of(work, marked.select("doc_id", "fp"), radius, most, levels)
    first = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "hash", "row")).alias("first")
    kept = marked.select("row", "doc_id", "hash", "fp").join(placed, "fp").groupBy("root").agg(first).select("first.row")
    return marked.select("row", "whole").join(kept, "row", "left_semi").select("whole.*")


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(spark, table(spark, sf_dir, "documents"))


QUERIES = {"op8_simhash": op8_simhash}
ORACLE: dict[str, str] = {}
