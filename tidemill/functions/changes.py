"""Expressions over the change-log envelope."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def field(name: str) -> Column:
    """``data['name']``, null when absent."""
    return F.col("data").getItem(name)


def changed_key_not_null(name: str) -> Column:
    """The previous value is present and not null."""
    return F.col("old").getItem(name).isNotNull()


def changed_key_exists(name: str) -> Column:
    """The key was among the changed ones, even when its previous value was null."""
    return F.coalesce(F.map_contains_key("old", name), F.lit(False))


def pick_change(
    log: DataFrame,
    table: str,
    types: Iterable[str],
    keys: dict[str, str] | Iterable[str],
    *extra: Column | str,
    database: str | None = None,
    where: Column | None = None,
) -> DataFrame:
    """Rows of one source table, projected to plain columns.

    ``keys`` is either a list of names or ``{data key: column name}``; ``extra`` passes envelope
    columns or expressions on.
    """
    names = keys if isinstance(keys, dict) else {k: k for k in keys}
    cond = (F.col("table") == table) & F.col("type").isin(*types)
    if database is not None:
        cond &= F.col("database") == database
    if where is not None:
        cond &= where
    return log.where(cond).select(*[field(k).alias(n) for k, n in names.items()], *extra)


def prune_map(data: Column | str, columns: Column | str) -> Column:
    """Keep only the keys named in a comma-separated list."""
    data = F.col(data) if isinstance(data, str) else data
    columns = F.col(columns) if isinstance(columns, str) else columns
    wanted = F.split(columns, ",")
    return F.map_filter(data, lambda k, v: F.array_contains(wanted, k))


def money(text: Column | str) -> Column:
    """Amount text as a decimal; null where it is no number."""
    c = F.col(text) if isinstance(text, str) else text
    return c.try_cast("decimal(16,2)")
