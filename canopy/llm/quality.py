"""Quality classifier: perplexity under an interpolated modified Kneser-Ney n-gram model.

The model is one of bytes, ORDER long, so that it also knows unseen words. It
learns from trusted texts (quality 1, not toxic); a second one like it learns
from texts labelled toxic. Each learns from every different text whose hash
falls into the first TRAIN_SHARE, however many there are; the other trusted
texts, all of them, set the thresholds. Copies stay on one side. Counts,
continuation counts, context totals and the discounts of Chen and Goodman are
DataFrame aggregates and joins over n-grams packed into integers.

The n-grams of the whole corpus are counted into a distributed table and meet
the models' probabilities and back-off weights by joins of sharded tables,
order by order. Each document's sums over its n-grams come from that table:
the commonest n-grams, a bounded number, where the document lies, the others
by a join with their shards.

A document is kept if its perplexity and its toxicity are at most their
thresholds. Toxicity is what the toxic model finds more likely than the
trusted one by more than a factor of e, byte by byte, over the root of the
length: an insult counts, a slightly different style doesn't. A language's
thresholds are quantiles over all its trusted texts that the model has not
seen; languages without any use the quantiles over all languages.

Defined cases: null and empty texts have no perplexity and are not kept; null
languages are one language; without trusted texts to set a threshold all
texts that aren't empty are kept; without toxic ones toxicity is zero;
conflicting labels of one document leave it untrusted, and toxic if one says
so; texts labelled both ways train both models; repeated rows are judged alike
and train once; very long texts are read whole; other columns pass through,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from canopy.llm import _text
from canopy.llm._ngrams import HEAD, SCALE, count_ngrams, fixed, sums_by_row
from canopy.llm._store import KEY, Work, keyed, table

ORDER = 4
TRAIN_SHARE = 0.8
QUANTILE = 0.993
GRAIN = 1_000
SLACK = 1.0  # nats by which a byte may be likelier in toxic text
BITS, START = 9, 256  # bits of a symbol; what stands before a text


def codes(texts: pa.Array, order: int) -> tuple[np.ndarray, np.ndarray]:
    """The n-gram that ends at each byte, its last byte in the lowest bits, and each text's offset."""
    buf, offsets = _text.raw(texts)
    n, pad = len(offsets) - 1, order - 1
    padded = np.full(len(buf) + n * pad, START, np.int64)
    place = np.arange(len(buf)) + (np.repeat(np.arange(n), np.diff(offsets)) + 1) * pad
    padded[place] = buf
    code = np.zeros(len(padded) - pad if len(padded) else 0, np.int64)
    for k in range(order if len(padded) else 0):
        code = code << BITS | padded[k : k + len(code)]
    return code[place - pad], offsets


def coder(order: int):
    return lambda texts: codes(texts, order)


def _discounts(df: DataFrame) -> list[float]:
    n = df.agg(*[F.count_if(F.col("c") == k) for k in (1, 2, 3, 4)]).first()
    if not all(n):
        return [0.5, 0.75, 0.9]
    y = n[0] / (n[0] + 2 * n[1])
    return [min(max(k + 1 - (k + 2) * y * n[k + 1] / n[k], 0.05), k + 0.95) for k in range(3)]


class KneserNey:
    """By order, tables of probabilities (code, p) and of back-off weights (context, g)."""

    def __init__(self, work: Work, texts: DataFrame | None, order: int = ORDER, name: str = "model", counted: DataFrame | None = None):
        """Learns from texts(text), or from their n-grams (code, c) if these are counted already."""
        counts = {order: work.save(count_ngrams(texts, coder(order)).withColumnRenamed("n_all", "c"), f"{name}-count{order}") if counted is None else counted}
        for k in range(order - 1, 0, -1):  # how many different symbols stand before each
            low = F.col("code").bitwiseAND(F.lit((1 << BITS * k) - 1)).alias("code")
            counts[k] = work.save(counts[k + 1].groupBy(low).agg(F.count("*").alias("c")), f"{name}-count{k}")
        self.p: dict[int, DataFrame] = {}
        self.g: dict[int, DataFrame] = {}
        for k in range(1, order + 1):
            d = _discounts(counts[k])
            own = counts[k].select("code", "c", F.shiftright("code", BITS).alias("context"), F.col("code").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1)).alias("low"))
            kinds = [F.count_if(F.col("c") == 1), F.count_if(F.col("c") == 2), F.count_if(F.col("c") > 2)]
            mass = sum((F.lit(x) * n for x, n in zip(d[1:], kinds[1:], strict=True)), F.lit(d[0]) * kinds[0])  # whole counts: the same in any order
            stats = own.groupBy("context").agg(F.sum("c").alias("total"), (mass / F.sum("c")).alias("g"))
            less = (F.col("c") - F.when(F.col("c") == 1, d[0]).when(F.col("c") == 2, d[1]).otherwise(d[2])) / F.col("total")
            joined = own.join(stats, "context")
            if k == 1:
                joined = joined.withColumn("p_low", F.lit(1.0 / START))
            else:
                joined = joined.join(self.p[k - 1].select(F.col("code").alias("low"), F.col("p").alias("p_low")), "low")
            self.p[k] = work.save(joined.select("code", (less + F.col("g") * F.col("p_low")).alias("p")), f"{name}-p{k}")
            self.g[k] = work.save(stats.select("context", "g"), f"{name}-g{k}")


def log_probabilities(work: Work, corpus: DataFrame, models: dict[str, KneserNey], order: int) -> DataFrame:
    """corpus(code, n_all) with the log probability of each n-gram under each model, by joins from the lowest order up."""
    seen = {order: corpus.select("code")}
    for k in range(order - 1, 0, -1):
        seen[k] = work.save(seen[k + 1].select(F.col("code").bitwiseAND(F.lit((1 << BITS * k) - 1)).alias("code")).distinct(), f"seen{k}")
    below = None
    for k in range(1, order + 1):
        now = seen[k].select("code", F.shiftright("code", BITS).alias("context"), F.col("code").bitwiseAND(F.lit((1 << BITS * (k - 1)) - 1)).alias("low"))
        now = now.withColumns({m: F.lit(-float(np.log(START))) for m in models}) if below is None else now.join(below.withColumnRenamed("code", "low"), "low")
        for m, model in models.items():
            now = now.join(model.p[k].withColumnRenamed("p", "_p"), "code", "left").join(model.g[k].withColumnRenamed("g", "_g"), "context", "left")
            # What this order hasn't seen goes on to the lower one, with its context's weight.
            now = now.withColumn(m, F.coalesce(F.log("_p"), F.col(m) + F.coalesce(F.log("_g"), F.lit(0.0)))).drop("_p", "_g")
        below = work.save(now.select("code", *models), f"log{k}")
        work.drop(f"log{k - 1}", f"seen{k}")
    return corpus.join(below, "code")


def _training(docs: DataFrame, marked: DataFrame) -> DataFrame:
    """(text, good, bad): every different text of marked rows in the fold to learn from, once."""
    of = marked.filter(F.col("fold") < TRAIN_SHARE).groupBy("text_hash").agg(F.min("doc_id").alias("doc"), F.max("good").alias("good"), F.max("bad").alias("bad"))
    chosen = of.select("doc", F.shiftleft("text_hash", 1).alias("sig"), "good", "bad")  # marked rows have identifiers
    # Dealt by identifier and text, so no group of copies is a hot key, and texts move once, however many are learnt from.
    own = keyed(docs, "text").join(chosen.hint("merge"), KEY)
    return own.groupBy(*KEY).agg(F.first("text").alias("text"), F.first("good").alias("good"), F.first("bad").alias("bad")).drop(*KEY)


def _thresholds(df: DataFrame, keys: list[str], values: dict[str, F.Column], share: float) -> DataFrame:
    """(keys, name, threshold): quantiles of values of at least zero, to one part in GRAIN, the same in every run.

    Values are counted by the whole GRAINths of their logarithm (plus one); a key
    has at most a few tens of thousands of those, however many rows there are.
    """
    bins = F.explode(F.array(*[F.struct(F.lit(k).alias("name"), F.floor(F.log1p(v) * GRAIN).alias("bin")) for k, v in values.items()])).alias("b")
    counts = df.select(*keys, bins).select(*keys, "b.*").groupBy(*keys, "name", "bin").agg(F.count("*").alias("n"))
    rows = Window.partitionBy(*keys, "name")
    upto = counts.withColumn("upto", F.sum("n").over(rows.orderBy("bin"))).withColumn("whole", F.sum("n").over(rows))
    return upto.filter(F.col("upto") >= share * F.col("whole")).groupBy(*keys, "name").agg(F.expm1((F.min("bin") + 1) / GRAIN).alias("threshold"))


def judge_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, order: int = ORDER, head: int = HEAD) -> DataFrame:
    """doc_id, lang, n_bytes, perplexity, toxicity, their thresholds, kept and the text's hash for each row of docs(doc_id, text, lang)."""
    work = Work(spark, "quality")
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), F.col("lang").cast("string").alias("lang"), F.xxhash64("text").alias("text_hash"))
    fold = (F.pmod(F.xxhash64("text_hash", F.lit("fold")), F.lit(1 << 20)) / (1 << 20)).alias("fold")
    hashes = work.save(docs.filter("text IS NOT NULL").select("doc_id", "text_hash", fold), "hashes")
    toxic = F.coalesce(F.col("toxic") == 1, F.lit(False))
    told = labels.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(F.coalesce(F.col("quality") == 1, F.lit(False)) & ~toxic).alias("good"), F.max(toxic).alias("bad"))
    marked = work.save(hashes.join(told.filter("good OR bad"), "doc_id"), "marked")
    learnt = work.save(count_ngrams(_training(docs, marked), coder(order), "good", "bad"), "learnt")
    models = {m: KneserNey(work, None, order, m, learnt.filter(F.col(n) > 0).select("code", F.col(n).alias("c"))) for m, n in (("trusted", "n_good"), ("toxic", "n_bad"))}
    corpus = work.save(count_ngrams(docs, coder(order)), "corpus")
    logs = log_probabilities(work, corpus, models, order)
    knows = not models["toxic"].p[1].isEmpty()
    excess = F.greatest(F.col("toxic") - F.col("trusted") - SLACK, F.lit(0.0)) if knows else F.lit(0.0)
    table_ = work.save(logs.withColumn("excess", excess).select("code", "n_all", fixed("trusted").alias("log"), fixed("excess").alias("excess")), "table")
    work.drop("corpus", f"log{order}")
    sums = sums_by_row(work, docs, table_, coder(order), ["log", "excess"], head)
    has = F.col("n_tokens") > 0
    perplexity = F.when(has, F.exp(F.least(-F.col("log") / SCALE / F.col("n_tokens"), F.lit(60.0))))
    toxicity = F.when(has, F.col("excess") / SCALE / F.sqrt("n_tokens"))
    scored = work.save(sums.select("doc_id", "lang", "text_hash", F.col("n_tokens").alias("n_bytes"), perplexity.alias("perplexity"), toxicity.alias("toxicity")), "judged")
    unseen = marked.filter("good").filter(F.col("fold") >= TRAIN_SHARE).select("doc_id", "text_hash").distinct()
    measured = scored.filter("perplexity IS NOT NULL").join(unseen, ["doc_id", "text_hash"], "left_semi")
    values = {c: F.col(c) for c in ("perplexity", "toxicity")}
    of = lambda df, k: df.filter(F.col("name") == k).drop("name")
    by_lang = work.save(_thresholds(measured, ["lang"], values, quantile), "thresholds")
    overall = {r["name"]: r["threshold"] for r in _thresholds(measured.withColumn("_all", F.lit(1)), ["_all"], values, quantile).collect()}
    joined = scored
    for k in values:
        own = of(by_lang, k).select(F.col("lang").alias("_lang"), F.col("threshold").alias("_own"))
        joined = joined.join(own, F.col("lang").eqNullSafe(F.col("_lang")), "left").withColumn(f"{k}_threshold", F.coalesce("_own", F.lit(overall.get(k)).cast("double"))).drop("_lang", "_own")
    fits = reduce(lambda a, b: a & b, [F.col(k) <= F.coalesce(f"{k}_threshold", F.lit(float("inf"))) for k in values])
    return joined.withColumn("kept", F.coalesce(fits, F.lit(False)))


def keep_quality(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of docs that the classifier keeps, as they are."""
    judged = judge_quality(spark, docs, labels).filter("kept")
    sig = F.shiftleft("text_hash", 1).bitwiseOR(F.col("doc_id").isNull().cast("long"))
    kept = judged.select(F.coalesce("doc_id", F.lit(0)).alias("doc"), sig.alias("sig"))
    return keyed(docs, F.struct("*").alias("whole")).join(kept, KEY, "left_semi").select("whole.*")


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_quality(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")).drop("text_hash")


QUERIES = {"op1_quality": op1_quality}
ORACLE: dict[str, str] = {}
