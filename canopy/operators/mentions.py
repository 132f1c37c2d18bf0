"""Mentions in text: vocabulary phrases, and runs of mentions made one."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def phrase_matches(texts: DataFrame, forms: DataFrame, longest: int) -> DataFrame:
    """(id, pos, words, concept) wherever a surface form occurs, whatever its case.

    texts(id, text), forms(form, concept) with forms of at most longest words; word
    sequences of each length are joined with the forms on their lower-cased text.
    """
    words = F.array_remove(F.split(F.lower("text"), r"[^\p{L}\p{N}]+"), "")
    tokens = texts.select("id", words.alias("w"))

    def spans(k: int):
        """Each word with the k - 1 after it; at most one word is copied at a time, no slice of the text."""
        starts = F.slice("w", F.lit(1), F.greatest(F.size("w") - (k - 1), F.lit(0)))
        form = lambda w, i: w if k == 1 else F.concat_ws(" ", w, *[F.get("w", i + j) for j in range(1, k)])
        return F.transform(starts, lambda w, i: F.struct(i.alias("pos"), F.lit(k).alias("words"), form(w, i).alias("form")))

    spans = F.concat(*[spans(k) for k in range(1, longest + 1)])
    rows = tokens.select("id", F.explode(spans).alias("x")).select("id", "x.pos", "x.words", "x.form")
    known = forms.select(F.lower("form").alias("form"), "concept").distinct()
    return rows.join(known, "form").select("id", "pos", "words", "concept")


def merge_adjacent(mentions: DataFrame, key: str, order: list[str], kind: str, gap) -> DataFrame:
    """Runs of neighbouring mentions of one kind with no gap between them, numbered by key."""
    w = Window.partitionBy(key).orderBy(*order)
    starts = F.when(F.lag(kind).over(w).eqNullSafe(F.col(kind)) & ~gap(w), 0).otherwise(1)
    return mentions.withColumn("_s", starts).withColumn("run", F.sum("_s").over(w.rowsBetween(Window.unboundedPreceding, 0))).drop("_s")


def bind_left(mentions: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Each noun gets the nearest activity to its left, and a count of one if it is a bare singular.

    mentions(key, order..., activity, noun, number, singular): activity is null on nouns, noun on activities.
    """
    w = Window.partitionBy(key).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    bound = mentions.withColumn("activity", F.last("activity", ignorenulls=True).over(w)).filter("noun IS NOT NULL")
    return bound.withColumn("number", F.coalesce("number", F.when(F.col("singular"), 1)))
