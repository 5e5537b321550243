"""Splitting a cleaned log into its five detail topics in one pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.schemas import TOPICS


def _json(**parts: Column) -> Column:
    return F.to_json(F.struct(*[c.alias(n) for n, c in parts.items()]))


def is_start() -> Column:
    return F.col("start").isNotNull()


def pages(log: DataFrame) -> DataFrame:
    """Page rows: neither start logs nor the per-element and error parts."""
    return log.where(~is_start()).drop("start", "displays", "actions", "err")


def starts(log: DataFrame) -> DataFrame:
    return log.where(is_start()).drop("err")


def errors(log: DataFrame) -> DataFrame:
    return log.where(F.col("err").isNotNull())


def _explode(log: DataFrame, array: str, name: str) -> DataFrame:
    keep = [c for c in log.columns if c not in ("start", "displays", "actions", "err", "ts")]
    return log.where(~is_start()).select(F.explode(array).alias(name), *keep, "ts")


def explode_displays(log: DataFrame) -> DataFrame:
    """One row per display, with the common, page and time parts of its log."""
    return _explode(log, "displays", "display")


def explode_actions(log: DataFrame) -> DataFrame:
    return _explode(log, "actions", "action")


def split_log(log: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """``(topic, value)`` rows for the page, start, display, action and error topics.

    Every log row is expanded where it stands: one scan, no shuffle, no cached batch. First the
    topics of a row are listed (with the display or action element), then each is written as JSON.
    Sent to a topic sink the ``topic`` column routes each row; in files it is the partition column.
    Rows with a ``dirty_text`` (if there is such a column) go to the dirty topic as that text. Columns to ``carry`` follow.
    """
    kind = "array<struct<topic: string, part: map<string, string>>>"
    none = F.array().cast(kind)
    no_part = F.lit(None).cast("map<string,string>")

    def one(topic: str) -> Column:
        return F.array(F.struct(F.lit(TOPICS[topic]).alias("topic"), no_part.alias("part"))).cast(kind)

    def each(array: str, topic: str) -> Column:
        parts = F.transform(array, lambda x: F.struct(F.lit(TOPICS[topic]).alias("topic"), x.alias("part")))
        return F.coalesce(parts.cast(kind), none)

    page_topics = F.concat(one("page"), each("displays", "display"), each("actions", "action"))
    listed = F.concat(
        F.when(F.col("err").isNotNull(), one("error")).otherwise(none),
        F.when(is_start(), one("start")).otherwise(page_topics),
    )
    full = ["common", "page", "start", "displays", "actions", "err", "ts"]
    dirty = F.col("dirty_text") if "dirty_text" in log.columns else F.lit(None).cast("string")
    listed = F.when(dirty.isNotNull(), one("dirty")).otherwise(listed)
    rows = log.select(*full, dirty.alias("dirty_text"), *carry, F.explode(listed).alias("out"))
    rows = rows.select(*full, "dirty_text", *carry, "out.topic", "out.part")
    common, page, ts, part = (F.col(c) for c in ("common", "page", "ts", "part"))
    topic = F.col("topic")
    value = (
        F.when(topic == TOPICS["dirty"], F.col("dirty_text"))
        .when(topic == TOPICS["page"], _json(common=common, page=page, ts=ts))
        .when(topic == TOPICS["display"], _json(display=part, common=common, page=page, ts=ts))
        .when(topic == TOPICS["action"], _json(action=part, common=common, page=page, ts=ts))
        .when(topic == TOPICS["start"], _json(**{n: F.col(n) for n in full if n != "err"}))
        .otherwise(_json(**{n: F.col(n) for n in full}))
    )
    return rows.select("topic", value.alias("value"), *carry)
