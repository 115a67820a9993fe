"""Group totals put back on rows.

A window over the total's keys would pull each group through one task. Aggregating first lets
every task shrink its share of a hot group, and the join that brings the totals back can be
broadcast or split by adaptive execution.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DAY_KEYS = ("submission_date", "chan", "os")
BROADCAST_ROWS = 500_000


def bounded(summary: DataFrame, max_rows: int | None) -> DataFrame:
    """Asks for a broadcast when the caller can prove a row bound that is small enough.

    Without a bound, or beyond it, the choice is left to Spark and its measured sizes. Only the way of joining
    depends on the bound, never a row of the result.
    """
    return F.broadcast(summary) if max_rows is not None and max_rows <= BROADCAST_ROWS else summary


def join_back(
    df: DataFrame, summary: DataFrame, keys: Sequence[str], max_rows: int | None = None, how: str = "inner"
) -> DataFrame:
    """Puts a summary of ``df``, one row per key, on its rows. NULL keys match like any other.

    The null-safe join also keeps both inputs alike: a plain one would add a not-NULL filter to one
    side, and then Spark could not reuse the shuffle they share and would read the source twice.
    """
    summary = summary.withColumnsRenamed({k: f"_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
    return df.join(bounded(summary, max_rows), same, how).drop(*[f"_{k}" for k in keys])


def with_group(
    df: DataFrame, keys: Sequence[str], max_groups: int | None = None, **aggregates: Column
) -> DataFrame:
    """Adds aggregates over ``keys`` to every row; NULL keys form a group like any other."""
    summary = df.groupBy(*keys).agg(*[value.alias(name) for name, value in aggregates.items()])
    return join_back(df, summary, keys, max_groups)


def with_total(
    df: DataFrame,
    keys: Sequence[str] = DAY_KEYS,
    value: str = "n",
    name: str = "total",
    max_groups: int | None = None,
) -> DataFrame:
    return with_group(df, keys, max_groups, **{name: F.sum(value)})


def with_share(
    df: DataFrame,
    keys: Sequence[str] = DAY_KEYS,
    value: str = "n",
    total: str = "total",
    share: str = "share",
    max_groups: int | None = None,
) -> DataFrame:
    """Adds the group total and each row's share of it."""
    return with_total(df, keys, value, total, max_groups).withColumn(share, F.try_divide(F.col(value), F.col(total)))


def with_grand_share(df: DataFrame, value: str, name: str, of: DataFrame | None = None, of_value: str | None = None) -> DataFrame:
    """Each row's share of the whole frame; the total is a scalar subquery.

    ``of`` names a frame with the same total (in ``of_value``) that is cheaper to sum, as the rows before a join.
    """
    whole = df.agg(F.sum(value)).scalar() if of is None else of.agg(F.sum(of_value or value)).scalar()
    return df.withColumn(name, F.try_divide(F.col(value), whole))
