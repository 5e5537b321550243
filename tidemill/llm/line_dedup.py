"""Site-relative line de-duplication.

A line of a host is boilerplate when the share of the host's pages that contain it is above a ratio. Only
hashes of distinct lines per page are shuffled, combined before the shuffle, so a hot host or a very common
line sends one row per task. What is left per host is at most (distinct lines of a mean page) / ratio hashes,
however large the host; it meets the pages as one small row per host, and no text is shuffled for it.
DataFrame functions only.

Defined results: a null text stays null with no lines; lines without a word are never dropped; pages without a
host are left as they are; a page whose lines all go keeps its row with an empty text; repeated rows are
pages of their own; an empty table gives no rows.

So three copies of a document on a small host make all its lines boilerplate, and the text goes from every copy.
With ``distinct_texts`` rows of equal text on a host are one page, in the share and in ``min_pages``: exact copies
keep their lines, for a later stage that removes copies. Copies with edits are still pages of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemill.llm.common import has_word, written

RATIO = 0.1
MIN_PAGES = 3


def _hash(line: Column) -> Column:
    """128 bits of a line as two longs."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit("line"), line).alias("b"))


def _lines(text: Column) -> Column:
    return F.split(text, "\n")


def boilerplate(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                min_pages: int = MIN_PAGES, distinct_texts: bool = False) -> DataFrame:
    """host and ``lines``: hashes of the lines on more than ``ratio`` of its pages, and on ``min_pages`` or more."""
    pages = docs.where(F.col(host).isNotNull()).select(F.col(host).alias("host"), F.col(text).alias("text"))
    hashes = F.array_distinct(F.transform(F.filter(_lines(F.col("text")), has_word), _hash))
    held = pages.select("host", hashes.alias("lines"))
    if distinct_texts:
        # Copies are combined before the shuffle, which carries line hashes and no text.
        pages = pages.withColumn("page", _hash(F.col("text")))
        held = pages.select("host", "page", hashes.alias("lines")).groupBy("host", "page").agg(F.first("lines").alias("lines"))
        pages = pages.select("host", "page").distinct()
    totals = pages.groupBy("host").agg(F.count(F.lit(1)).alias("pages"))
    counts = (
        held.select("host", F.explode("lines").alias("line")).select("host", "line.a", "line.b")
        .groupBy("host", "a", "b").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_pages)
    )
    common = counts.join(totals, "host").where(F.col("n") > ratio * F.col("pages"))
    return common.groupBy("host").agg(F.collect_set(F.struct("a", "b")).alias("lines"))


def drop_boilerplate(docs: DataFrame, text: str = "text", host: str = "source", ratio: float = RATIO,
                     min_pages: int = MIN_PAGES, distinct_texts: bool = False) -> DataFrame:
    """``docs`` as a struct ``row``, with ``clean`` (the text that is left), ``n_lines`` and ``n_dropped``."""
    found = written(boilerplate(docs, text, host, ratio, min_pages, distinct_texts), "boilerplate")
    rows = docs.select(
        F.struct(*docs.columns).alias("row"), F.col(host).alias("host"), _lines(F.col(text)).alias("all")
    ).join(found, "host", "left")
    left = F.when(F.col("lines").isNull(), F.col("all")).otherwise(
        F.filter("all", lambda x: ~has_word(x) | ~F.array_contains(F.col("lines"), _hash(x)))
    )
    return rows.withColumn("left", left).select(
        "row", F.array_join("left", "\n").alias("clean"),
        F.coalesce(F.size("all"), F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size("all") - F.size("left"), F.lit(0)).cast("long").alias("n_dropped"),
    )
