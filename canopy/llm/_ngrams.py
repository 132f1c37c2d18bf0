"""N-grams of whole corpora: counts, and sums of values over each text's n-grams.

A coder gives (the code of the n-gram that ends at each byte, each text's
offset) for an array of texts. The table of values has a row for each n-gram
of the corpus and grows with it: the most frequent ones, a bounded number, are
broadcast and found where the texts lie; the others are sent to their shards
of the table, and their sums come back by row. Values are whole numbers, so
sums are the same in any order and wherever an n-gram is found.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from canopy.llm import _text
from canopy.llm._store import Work

HEAD = 1 << 20
SCALE = 1 << 24  # values are whole multiples of 1 / SCALE
PENDING = 4 << 20  # codes held in a task before they are summed up
Coder = Callable[[pa.Array], tuple[np.ndarray, np.ndarray]]


def _counter(coder: Coder, flags: list[str]):
    """Counts of codes with their flags in the lowest bits, so that a plain sort finds both."""
    bits = len(flags)

    def counted(held: list[np.ndarray], n: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        seen, where = np.unique(np.concatenate(held), return_inverse=True)
        return seen, np.bincount(where, np.concatenate(n), len(seen)).astype(np.int64)

    def rows(seen: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        cols = [seen >> bits, n, *(n * (seen >> k & 1) for k in range(bits))]
        return pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["code", "n_all", *(f"n_{f}" for f in flags)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], []
        for whole in batches:
            for batch in _text.chunks(whole):
                code, offsets = coder(batch.column("text"))
                marks = np.zeros(batch.num_rows, np.int64)
                for k, f in enumerate(flags):
                    marks |= batch.column(f).to_numpy(zero_copy_only=False).astype(np.int64) << k
                seen, own = np.unique(code << bits | np.repeat(marks, np.diff(offsets)) if bits else code, return_counts=True)
                held.append(seen)
                n.append(own)
            if sum(map(len, held)) > PENDING:
                seen, own = counted(held, n)
                held, n = [seen], [own]
                if len(seen) > PENDING // 2:
                    yield rows(seen, own)
                    held, n = [], []
        if held:
            yield rows(*counted(held, n))

    return run


def count_ngrams(texts: DataFrame, coder: Coder, *flags: str) -> DataFrame:
    """(code, n_all, n_<flag>...) over texts(text, flags...): summed up within each task before the shuffle."""
    names = ["n_all", *(f"n_{f}" for f in flags)]
    schema = ", ".join(f"{c} long" for c in ["code", *names])
    return texts.select("text", *flags).mapInArrow(_counter(coder, list(flags)), schema).groupBy("code").agg(*[F.sum(c).alias(c) for c in names])


def fixed(log: str) -> F.Column:
    return F.round(F.col(log) * SCALE).cast("long")


def least_of_head(model: DataFrame, most: int) -> int:
    """The least count for which at most so many n-grams occur as often; counts are told apart by 64 bit lengths and 64 steps within each."""
    step = F.floor(F.log2("n_all") * 64)
    bins = model.groupBy(step.alias("step")).agg(F.count("*").alias("n"), F.min("n_all").alias("least")).collect()  # at most 64 * 64 rows
    least, held = (1 << 63) - 1, 0
    for r in sorted(bins, key=lambda r: -r["step"]):
        held += r["n"]
        if held > most:
            break
        least = r["least"]
    return least


def _finder(shared, coder: Coder, keep: list[str], values: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, *models = shared.value
        for whole in batches:
            for batch in _text.chunks(whole):
                code, offsets = coder(batch.column("text"))
                at = np.minimum(np.searchsorted(keys, code), max(len(keys) - 1, 0))
                found = keys[at] == code if len(keys) else np.zeros(len(code), bool)
                cols = []
                for model in models:
                    own = np.where(found, model[at], 0) if len(keys) else np.zeros(len(code), np.int64)
                    total = np.concatenate(([0], np.cumsum(own)))
                    cols.append(pa.array(total[offsets[1:]] - total[offsets[:-1]]))
                missed = np.concatenate(([0], np.cumsum(~found)))[offsets]
                tail = pa.ListArray.from_arrays(pa.array(missed, pa.int32()), pa.array(code[~found]))
                yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(np.diff(offsets), pa.int64()), *cols, tail], names=[*keep, "n_tokens", *values, "tail"])

    return run


def sums_by_row(work: Work, docs: DataFrame, model: DataFrame, coder: Coder, values: list[str], head: int = HEAD) -> DataFrame:
    """docs without text, with n_tokens and the sum of each value over the text's n-grams, all of which are in model(code, n_all, values...)."""
    least = least_of_head(model, head)
    got = model.filter(F.col("n_all") >= least).select("code", *values).toArrow().sort_by("code")  # at most head rows
    shared = work.spark.sparkContext.broadcast(tuple(got.column(c).to_numpy() for c in ("code", *values)))
    keep = [c for c in docs.columns if c != "text"]
    numbered = docs.withColumn("row", F.monotonically_increasing_id())
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in numbered.schema if f.name != "text")
    found = numbered.mapInArrow(_finder(shared, coder, [*keep, "row"], values), f"{kinds}, n_tokens long, {', '.join(f'{v} long' for v in values)}, tail array<long>")
    scored = work.save(found, "scored")
    shared.unpersist()  # a task that runs again fetches it anew
    rest = model.filter(F.col("n_all") < least)
    if not rest.isEmpty():
        # Dealt by n-gram, each of which is rarer than any broadcast.
        sought = scored.select("row", F.explode("tail").alias("code")).join(rest.select("code", *values).hint("shuffle_hash"), "code")
        sums = sought.groupBy("row").agg(*[F.sum(v).alias(f"_{v}") for v in values])
        scored = scored.join(sums.hint("merge"), "row", "left").withColumns({v: F.col(v) + F.coalesce(f"_{v}", F.lit(0)) for v in values})
    return scored.select(*keep, "n_tokens", *values)
