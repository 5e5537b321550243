"""Parsing and filtering of topic records."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemill.schemas import CONTROL_TYPES, ENVELOPE, RAW_LOG, TOPICS

CORRUPT = "_corrupt_record"


def drop_blank(records: DataFrame, value: str = "value") -> DataFrame:
    """Drop null and empty records."""
    return records.where(F.col(value).isNotNull() & (F.col(value) != ""))


def parse_json(records: DataFrame, schema: T.StructType, value: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    """Parse every record once into ``row``; ``dirty`` tells that the text is no JSON of that shape."""
    with_corrupt = T.StructType(schema.fields + [T.StructField(CORRUPT, T.StringType())])
    parsed = F.from_json(F.col(value), with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT})
    # Exploding a one-element array pins the parse: a filter on its result is not pushed below it,
    # where the text would be parsed a second time.
    rows = records.select(value, *carry, F.explode(F.array(parsed)).alias("row"))
    return rows.withColumn("dirty", F.col("row").isNull() | F.col(f"row.{CORRUPT}").isNotNull())


def clean_rows(parsed: DataFrame, schema: T.StructType, carry: tuple[str, ...] = ()) -> DataFrame:
    return parsed.where(~F.col("dirty")).select(*carry, *[F.col(f"row.{n}").alias(n) for n in schema.names])


def dirty_records(parsed: DataFrame, value: str = "value") -> DataFrame:
    return parsed.where("dirty").select(F.lit(TOPICS["dirty"]).alias("topic"), F.col(value).alias("value"))


def needed(schema: T.StructType, columns: Sequence[str]) -> T.StructType:
    """The row type for readers of some columns: these, and all that can make a record dirty. Any JSON value passes as text."""
    return T.StructType([f for f in schema.fields if f.name in columns or not isinstance(f.dataType, T.StringType)])


def parse_json_or_dirty(
    records: DataFrame, schema: T.StructType, value: str = "value", carry: tuple[str, ...] = (),
    columns: Sequence[str] | None = None,
) -> tuple[DataFrame, DataFrame]:
    """Well-formed rows, and the raw text of the others. With ``columns`` rows have only these; the same records are dirty."""
    if columns is not None:
        rows, dirty = parse_json_or_dirty(records, needed(schema, columns), value, carry)
        return rows.select(*carry, *columns), dirty
    parsed = parse_json(drop_blank(records, value), schema, value, carry)
    return clean_rows(parsed, schema, carry), dirty_records(parsed, value)


def is_control(kind: Column | str = "type") -> Column:
    # a record without a type cannot be judged and counts as dirty too
    kind = F.col(kind) if isinstance(kind, str) else kind
    return kind.isNull() | kind.isin(*CONTROL_TYPES)


def drop_control_rows(envelope: DataFrame) -> DataFrame:
    return envelope.where(~is_control())


def parse_change_log(
    records: DataFrame, value: str = "value", carry: tuple[str, ...] = (), keys: Sequence[str] | None = None
) -> DataFrame:
    """Change-log records to envelope columns; malformed and control records are left out.

    For readers that name the ``keys`` they take, ``data`` is a struct of these and no map of all is made.
    """
    schema = ENVELOPE
    if keys is not None:
        data = T.StructType([T.StructField(k, T.StringType()) for k in keys])
        schema = T.StructType([T.StructField("data", data) if f.name == "data" else f for f in ENVELOPE.fields])
    rows, _ = parse_json_or_dirty(records, schema, value, carry)
    return drop_control_rows(rows)


def parse_page_log(records: DataFrame, value: str = "value", carry: tuple[str, ...] = ()) -> DataFrame:
    rows, _ = parse_json_or_dirty(records, RAW_LOG, value, carry)
    return rows


def keep_insert(wide: DataFrame) -> DataFrame:
    return wide.where(F.col("type") == "insert")


def drop_empty_and_keep_insert(
    records: DataFrame, schema: T.StructType, value: str = "value", columns: Sequence[str] | None = None
) -> DataFrame:
    """Order-detail records: tombstones dropped, versions from an order insert kept; ``columns``: ``type`` and what is read.

    A record can only be such a version where its text holds the word, as it is or with escaped letters: others are not parsed.
    """
    text = F.col(value)
    rows, _ = parse_json_or_dirty(records.where(text.contains("insert") | text.contains("\\u")), schema, value, columns=columns)
    return keep_insert(rows)


def made_once(records: DataFrame, value: str = "value") -> DataFrame:
    """Text that was just made from columns: filters on it stay above, or it would be made again for each of them."""
    return records.withColumn(value, F.explode(F.array(value)))


# ---- page-log filters ------------------------------------------------------------

def session_start() -> Column:
    return F.col("page.last_page_id").isNull()


def filter_session_start(page: DataFrame) -> DataFrame:
    return page.where(session_start())


def filter_home_detail(page: DataFrame) -> DataFrame:
    return page.where(F.col("page.page_id").isin("home", "good_detail"))


def filter_login(page: DataFrame) -> DataFrame:
    return page.where(F.col("common.uid").isNotNull() & session_start())


def filter_search_keyword(page: DataFrame) -> DataFrame:
    return page.where(
        F.col("page.item").isNotNull()
        & (F.col("page.last_page_id") == "search")
        & (F.col("page.item_type") == "keyword")
    )
