"""LM scoring by cross-entropy difference.

A target model learns from the trusted documents (quality 1, not toxic) and a
background model from all documents; both are n-gram models of ORDER over all
256 bytes and one symbol for the start of a text. N-grams are counted within
each chunk before they are shuffled, and summed into a distributed table that
has a row for each n-gram of the corpus and grows with it. Probabilities are
interpolated down to uniform by Witten and Bell's rule, by joins and
aggregates over that table.

Every n-gram of a document is in the table. The most frequent ones, HEAD at
most, are broadcast and found where the documents lie; the others are sent to
their shards of the table, and their sums come back by row. Log probabilities
are whole multiples of 1 / SCALE, so sums are the same in any order and
wherever an n-gram is found.

A document's score is the mean over its bytes of target loss minus background
loss, in nats: the lower, the more it is like the target.

Callers may ask for fewer symbols: then the most frequent bytes keep their own
and all others share one.

Defined cases: null and empty texts have no losses and a null score; without
any target document both models are the background's and scores are zero;
conflicting labels leave a document out of the target; repeated rows each
count and get a row; equally frequent n-grams are all in the head or all out
of it; very long texts are read whole; other columns are not looked at; an
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from canopy.llm import _text
from canopy.llm._ngrams import HEAD, SCALE, count_ngrams, sums_by_row
from canopy.llm._store import Work, table

ORDER = 4
SYMBOLS = 258  # a text's start, 256 bytes, and one for other bytes where there are fewer


def _frequencies(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = np.zeros(256, np.int64)
    for whole in batches:
        for batch in _text.chunks(whole):
            counts += np.bincount(_text.raw(batch.column("text"))[0], minlength=256)
    seen = np.flatnonzero(counts)
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int32()), pa.array(counts[seen])], names=["byte", "n"])


def codes(texts: pa.Array, symbol: np.ndarray, order: int, symbols: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram code that ends at each byte, and each text's offset; symbol 0 stands before a text."""
    buf, offsets = _text.raw(texts)
    n, pad = len(offsets) - 1, order - 1
    padded = np.zeros(len(buf) + n * pad, np.int64)
    place = np.arange(len(buf)) + (np.repeat(np.arange(n), np.diff(offsets)) + 1) * pad
    padded[place] = symbol[buf]
    code = np.zeros(len(buf), np.int64)
    for k in range(order):
        code = code * symbols + padded[place - pad + k]
    return code, offsets


def log_probabilities(work: Work, counts: DataFrame, order: int, symbols: int) -> DataFrame:
    """(code, n_all, target, background): log p(last symbol | the ones before) times SCALE, with Witten-Bell interpolation."""
    level = {order: counts}
    for k in range(order - 1, 0, -1):
        level[k] = work.save(level[k + 1].groupBy((F.col("code") % symbols**k).alias("code")).agg(F.sum("n_all").alias("n_all"), F.sum("n_target").alias("n_target")), f"count{k}")
    below = None
    for k in range(1, order + 1):
        own = level[k].withColumn("context", F.expr(f"code div {symbols}")).withColumn("low", F.col("code") % symbols ** (k - 1))
        sums = [x for c in ("all", "target") for x in (F.sum(f"n_{c}").alias(f"total_{c}"), F.count_if(F.col(f"n_{c}") > 0).alias(f"kinds_{c}"))]
        joined = own.join(own.groupBy("context").agg(*sums), "context")
        if below is None:
            joined = joined.withColumns({f"low_{c}": F.lit(1.0 / symbols) for c in ("all", "target")})
        else:
            joined = joined.join(below.select(F.col("code").alias("low"), F.col("p_all").alias("low_all"), F.col("p_target").alias("low_target")), "low")
        p = [F.when(F.col(f"total_{c}") > 0, (F.col(f"n_{c}") + F.col(f"kinds_{c}") * F.col(f"low_{c}")) / (F.col(f"total_{c}") + F.col(f"kinds_{c}"))).otherwise(F.col(f"low_{c}")).alias(f"p_{c}") for c in ("all", "target")]
        below = work.save(joined.select("code", "n_all", *p), f"p{k}")
        work.drop(f"p{k - 1}", f"count{k}")
    log = lambda c: F.round(F.log(c) * SCALE).cast("long")
    return below.select("code", "n_all", log("p_target").alias("target"), log("p_all").alias("background"))


def cross_entropy_difference(spark: SparkSession, docs: DataFrame, labels: DataFrame, order: int = ORDER, symbols: int = SYMBOLS, head: int = HEAD) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score for each row of docs(doc_id, text)."""
    work = Work(spark, "lm")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    symbol = np.arange(1, 257)
    if symbols < SYMBOLS:
        frequent = docs.select("text").mapInArrow(_frequencies, "byte int, n long").groupBy("byte").agg(F.sum("n").alias("n"))
        frequent = sorted(frequent.collect(), key=lambda r: (-r["n"], r["byte"]))  # at most 256 rows
        symbol = np.full(256, symbols - 1, np.int64)
        for k, r in enumerate(frequent[: symbols - 2]):
            symbol[r["byte"]] = k + 1
    good = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min((F.col("quality") == 1) & (F.coalesce("toxic", F.lit(0)) == 0)).alias("target"))
    coder = lambda texts: codes(texts, symbol, order, symbols)
    # Labels grow with the documents: the join is dealt by key at every size, never broadcast.
    marked = docs.join(good.hint("merge"), "doc_id", "left").select("text", F.coalesce("target", F.lit(False)).alias("target"))
    counts = work.save(count_ngrams(marked, coder, "target"), f"count{order}")
    if not counts.agg(F.sum("n_target")).first()[0]:
        counts = counts.withColumn("n_target", F.col("n_all"))
    model = work.save(log_probabilities(work, counts, order, symbols), "model")
    work.drop(f"p{order}")
    scored = sums_by_row(work, docs, model, coder, ["target", "background"], head)
    loss = lambda c: F.when(F.col("n_tokens") > 0, -F.col(c) / SCALE / F.col("n_tokens"))
    return scored.select("doc_id", "n_tokens", loss("target").alias("target_loss"), loss("background").alias("background_loss"), (loss("target") - loss("background")).alias("score"))


def op7_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cross_entropy_difference(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


QUERIES = {"op7_lm_score": op7_lm_score}
ORACLE: dict[str, str] = {}
