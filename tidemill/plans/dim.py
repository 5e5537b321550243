"""Routing dimension changes to their tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tidemill.functions.changes import prune_map
from tidemill.operators.lookups import config_join
from tidemill.schemas import ROUTED_TYPES


def dim_route(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Changes of configured tables with their sink table, key and kept columns.

    The config has a handful of rows and is attached as a checked broadcast, so the change log is
    neither shuffled nor repeated.
    """
    routed = config_join(changes.where(F.col("type").isin(*ROUTED_TYPES)), config)
    pk = F.when(F.coalesce("sink_pk", F.lit("")) == "", "id").otherwise(F.col("sink_pk"))
    return routed.select(
        "sink_table", "type", "ts",
        F.try_element_at("data", pk).alias("pk"),
        prune_map("data", "sink_columns").alias("data"),
    )
