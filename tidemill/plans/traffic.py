"""Log jobs: cleaning and splitting the raw log, unique visitors, jumps."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.operators.clean import drop_blank, parse_json, parse_json_or_dirty
from tidemill.operators.split import pages, split_log
from tidemill.operators.visits import fix_is_new, unique_visitor, user_jump
from tidemill.schemas import RAW_LOG


def clean_log(records: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(value, offset)`` records to typed rows with a corrected new-visitor flag, and dirty text."""
    rows, dirty = parse_json_or_dirty(records, RAW_LOG, carry=("offset",))
    return fix_is_new(rows), dirty


def base_log(records: DataFrame) -> DataFrame:
    """``(topic, value)`` rows of the five detail topics and the dirty topic.

    Dirty records stay in the flow as text, so that the log is not parsed once more for them.
    """
    parsed = parse_json(drop_blank(records), RAW_LOG, carry=("offset",))
    rows = parsed.select(
        *[F.when(~F.col("dirty"), F.col(f"row.{n}")).alias(n) for n in RAW_LOG.names], "offset",
        F.when(F.col("dirty"), F.col("value")).alias("dirty_text"),
    )
    return split_log(fix_is_new(rows))


def page_rows(records: DataFrame) -> DataFrame:
    rows, _ = clean_log(records)
    return pages(rows)


__all__ = ["base_log", "clean_log", "page_rows", "unique_visitor", "user_jump"]
