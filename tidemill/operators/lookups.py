"""Joins against dictionaries and dimension tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

SMALL_ROWS = 100_000


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """Mark for broadcast only after counting that at most ``max_rows`` rows are there.

    Beyond that the frame is returned as it is, and the join is planned by size as any other.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def lookup_join(
    df: DataFrame, dic: DataFrame, code: str, name: str, how: str = "inner", checked: bool = False
) -> DataFrame:
    """Add the dictionary name of ``code`` as ``name``; ``inner`` drops unknown codes."""
    codes = dic.select(F.col("dic_code").alias("_code"), F.col("dic_name").alias(name))
    codes = codes if checked else small_side(codes)
    return df.join(codes, F.col(code) == F.col("_code"), how).drop("_code")


def dim_join(df: DataFrame, dim: DataFrame, on: Column | str, take: dict[str, str], key: str = "id") -> DataFrame:
    """Add columns of one dimension by its id; rows without a match stay, with nulls.

    No broadcast hint: the planner picks one when the dimension is measured to be small, and a
    shuffled join (split when skewed) when it has grown.
    """
    on = F.col(on) if isinstance(on, str) else on
    cols = dim.select(F.col(key).alias("_dim_key"), *[F.col(c).alias(n) for c, n in take.items()])
    return df.join(cols, on == F.col("_dim_key"), "left").drop("_dim_key")


def sku_dimension(dims: dict[str, DataFrame], with_spu: bool = True) -> DataFrame:
    """One flat row per sku: spu, trademark and the three category levels with their names.

    The chain is resolved once on the dimension side, so facts need a single join.
    """
    return sku_names(sku_ids(dims, with_spu), dims, with_spu)


def sku_ids(dims: dict[str, DataFrame], with_spu: bool = True) -> DataFrame:
    """What a sku itself names: spu, trademark and third category."""
    return dims["sku"].select(
        F.col("id").alias("sku_id"),
        *([F.col("spu_id")] if with_spu else []),
        F.col("tm_id").alias("trademark_id"),
        F.col("category3_id"),
    )


def sku_names(flat: DataFrame, dims: dict[str, DataFrame], with_spu: bool = True) -> DataFrame:
    """Rows with the ids of ``sku_ids``, and the names and upper categories that belong to these."""
    if with_spu:
        flat = dim_join(flat, dims["spu"], "spu_id", {"spu_name": "spu_name"})
    flat = dim_join(flat, dims["trademark"], "trademark_id", {"tm_name": "trademark_name"})
    flat = dim_join(flat, dims["category3"], "category3_id", {"name": "category3_name", "category2_id": "category2_id"})
    flat = dim_join(flat, dims["category2"], "category2_id", {"name": "category2_name", "category1_id": "category1_id"})
    return dim_join(flat, dims["category1"], "category1_id", {"name": "category1_name"})


def with_sku(df: DataFrame, sku_dim: DataFrame, columns: Sequence[str]) -> DataFrame:
    return dim_join(df, sku_dim, "sku_id", {c: c for c in columns}, key="sku_id")


def config_join(changes: DataFrame, config: DataFrame) -> DataFrame:
    """Attach the routing row of each change's table; tables without one are dropped.

    The routing table has one row per source table.
    """
    conf = small_side(config)
    return changes.join(conf, F.col("table") == F.col("source_table"), "inner")


def reduced_join(df: DataFrame, one: DataFrame, key: str, how: str = "left") -> DataFrame:
    """Join a side that was just reduced to one row per key, keeping hot keys of ``df`` splittable.

    The adaptive skew join only splits between two shuffles, but a side fresh from an aggregation or
    ranking by the key is joined where it lies. Null-safe equality asks for a partitioning of its
    own, so the reduced side, the smaller one, is shuffled once more and a hot key can be
    split. Rows without a key match nothing.
    """
    side = one.where(F.col(key).isNotNull()).withColumnRenamed(key, "_one")
    return df.join(side, F.col(key).eqNullSafe(F.col("_one")), how).drop("_one")
