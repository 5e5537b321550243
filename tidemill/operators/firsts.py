"""First visit of a day, first ever, and returning after a pause.

All are built from per-(key, day) minima, which combine before the shuffle. What remains per key
is at most one row per day, and only that is ordered per key.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemill.operators.dedup import keep_first

RETURN_DAYS = 8  # fixed value: a pause this long makes a user a returning one


def first_rows_of_day(
    df: DataFrame, key: Column | str, time: Column, order: str, ties: Sequence[str] = ()
) -> DataFrame:
    """The whole first row of each key and day."""
    named = df.withColumn("_key", F.col(key) if isinstance(key, str) else key).withColumn("_day", F.to_date(time))
    return keep_first(named, ["_key", "_day"], order, ties).drop("_key", "_day")


def day_firsts(df: DataFrame, key: Column, time: Column) -> DataFrame:
    """``key, day, first_time`` per key and day; rows without a key are nobody's."""
    return (
        df.select(key.alias("key"), time.alias("time")).where(F.col("key").isNotNull())
        .groupBy("key", F.to_date("time").alias("day"))
        .agg(F.min("time").alias("first_time"))
    )


def with_previous_day(firsts: DataFrame) -> DataFrame:
    """Adds ``prev_day``, the key's previous active day: null means never seen before."""
    return firsts.withColumn("prev_day", F.lag("day").over(Window.partitionBy("key").orderBy("day")))


def first_of_day_and_ever(df: DataFrame, key: Column, time: Column) -> DataFrame:
    """Day-first rows with ``is_new`` = 1 on the key's first day of all."""
    return with_previous_day(day_firsts(df, key, time)).select(
        "key", "day", "first_time", F.col("prev_day").isNull().cast("long").alias("is_new")
    )


def returning(df: DataFrame, key: Column, time: Column, days: int = RETURN_DAYS) -> DataFrame:
    """Day-first rows with ``is_back`` = 1 when the previous active day is ``days`` or more ago."""
    back = F.coalesce(F.datediff("day", "prev_day") >= days, F.lit(False))
    return with_previous_day(day_firsts(df, key, time)).select(
        "key", "day", "first_time", back.cast("long").alias("is_back")
    )
