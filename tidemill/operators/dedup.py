"""Keeping one row per key.

A ``row_number() = 1`` filter is planned with a limit before the shuffle as well, so each task
sends at most one row per key: a key that holds a third of the table costs no more than another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

GAP_MS = 5_000     # fixed value: a copy this soon after the one before it is dropped
SLICE_MS = 300_000

_RANK = "_rank"


def _one_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)


def keep_last(df: DataFrame, keys: Sequence[str | Column], ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the greatest ``ts`` per key; among equals the greatest ``ties``."""
    return _one_per_key(df, keys, [F.desc_nulls_last(c) for c in (ts, *ties)])


def keep_first(df: DataFrame, keys: Sequence[str | Column], ts: str, ties: Sequence[str] = ()) -> DataFrame:
    """The row with the smallest ``ts`` per key; among equals the smallest ``ties``."""
    return _one_per_key(df, keys, [F.asc_nulls_last(c) for c in (ts, *ties)])


def keep_first_sliding(
    df: DataFrame, keys: Sequence[str], time: Column, ties: Sequence[str] = (), gap_ms: int = GAP_MS,
    slice_ms: int = SLICE_MS,
) -> DataFrame:
    """Rows with no copy of their key in the ``gap_ms`` before them: every copy renews the time to wait.

    Time is cut into slices and rows are spread by key and slice; the end of a slice is shown to the next one, so
    a busy key is many tasks. Among equal times the smallest ``ties`` is kept. Rows without a time or a whole key
    are left out.
    """
    if slice_ms < gap_ms:
        raise ValueError("a slice must be at least as long as the gap")
    whole = df.withColumn("_ms", F.unix_millis(time)).dropna(subset=["_ms", *keys])
    slot = F.floor(F.col("_ms") / F.lit(slice_ms))
    near_end = (slot + 1) * slice_ms - F.col("_ms") <= gap_ms
    spread = whole.withColumn("_slot", F.explode(F.when(near_end, F.array(slot, slot + 1)).otherwise(F.array(slot))))
    before = F.lag("_ms").over(Window.partitionBy(*keys, "_slot").orderBy("_ms", *ties))
    alone = F.col("_before").isNull() | (F.col("_ms") - F.col("_before") > gap_ms)
    kept = spread.withColumn("_before", before).where((F.col("_slot") == slot) & alone)
    return kept.drop("_ms", "_slot", "_before")
