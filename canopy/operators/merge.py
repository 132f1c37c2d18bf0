"""Reconciling a staging snapshot with a target, under four policies.

Each is one full outer join on the key, so unmatched rows of either side are
seen in the same pass. Plain files have no MERGE; the result is the whole new
target, written beside the old one and swapped in by the caller.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DELETED, LOADED = "source_deleted_at", "loaded_at"


def _aligned(target: DataFrame, staging: DataFrame, keys: list[str]) -> DataFrame:
    t = target.select(F.struct("*").alias("t"), *[F.col(k).alias(f"_t_{k}") for k in keys])
    s = staging.select(F.struct("*").alias("s"), *[F.col(k).alias(f"_s_{k}") for k in keys])
    return t.join(s, [F.col(f"_t_{k}") == F.col(f"_s_{k}") for k in keys], "full_outer")


def _differs(columns: list[str]) -> Column:
    return reduce(lambda a, c: a | ~F.col(f"t.{c}").eqNullSafe(F.col(f"s.{c}")), columns, F.lit(False))


def _new() -> Column:
    return F.col("t").isNull()


def _gone() -> Column:
    return F.col("s").isNull()


def keep_first_load(target: DataFrame, staging: DataFrame, keys: list[str], now: Column) -> DataFrame:
    """Insert new rows; never refresh known ones; revive what reappears; stamp what is gone, once."""
    cols = [c for c in staging.columns]
    deleted = F.when(_new() | ~_gone(), F.lit(None).cast("timestamp_ntz")).otherwise(F.coalesce(F.col(f"t.{DELETED}"), now))
    return _aligned(target, staging, keys).select(*[F.when(_new(), F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in cols], deleted.alias(DELETED))


def refresh(target: DataFrame, staging: DataFrame, keys: list[str], compare: str, owned: list[str], now: Column) -> DataFrame:
    """As above, but a known row whose compared column changed takes all staged columns; owned columns stay the target's."""
    changed = ~_gone() & ~_new() & ~F.col(f"t.{compare}").eqNullSafe(F.col(f"s.{compare}"))
    deleted = F.when(_new() | ~_gone(), F.lit(None).cast("timestamp_ntz")).otherwise(F.coalesce(F.col(f"t.{DELETED}"), now))
    return _aligned(target, staging, keys).select(
        *[F.when(_new() | changed, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in staging.columns], *[F.col(f"t.{c}").alias(c) for c in owned], deleted.alias(DELETED)
    )


def upsert(target: DataFrame, staging: DataFrame, keys: list[str], stamp: str, now: Column, ignored: tuple[str, ...] = ()) -> DataFrame:
    """Insert or, where a compared column changed, update with a new stamp; nothing is ever removed."""
    compared = [c for c in staging.columns if c not in (*keys, stamp, *ignored)]
    takes = _new() | (~_gone() & _differs(compared))
    return _aligned(target, staging, keys).select(
        *[F.when(takes, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in staging.columns if c != stamp], F.when(takes, now).otherwise(F.col(f"t.{stamp}")).alias(stamp)
    )


def upsert_metrics(target: DataFrame, staging: DataFrame, keys: list[str], run: str = "run_id") -> DataFrame:
    """An unchanged row keeps its old run; a changed or new one takes the staged row whole."""
    compared = [c for c in staging.columns if c not in (*keys, run)]
    takes = _new() | (~_gone() & _differs(compared))
    return _aligned(target, staging, keys).select(*[F.when(takes, F.col(f"s.{c}")).otherwise(F.col(f"t.{c}")).alias(c) for c in staging.columns])


def changes(target: DataFrame, staging: DataFrame, keys: list[str]) -> DataFrame:
    """How a merge would see each key: new, gone, changed or same."""
    compared = [c for c in staging.columns if c not in keys and c in target.columns]
    state = F.when(_new(), "new").when(_gone(), "gone").when(_differs(compared), "changed").otherwise("same")
    return _aligned(target, staging, keys).select(*[F.coalesce(f"_t_{k}", f"_s_{k}").alias(k) for k in keys], state.alias("state"))
