"""Positions and running sums within a group, in two steps so that no group passes through one task.

Rows are ranked or summed inside small buckets that follow the order (a build day, a date), and then over one
count per bucket. A bucket that is itself too large, such as the one of rows without a date, is cut into parts: split
points are taken from a sample of its rows, every row finds its part by binary search, and parts are counted like
buckets.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators.totals import join_back

#: Rows of a part, about. A bucket is cut into at most ``MOST_PARTS`` parts.
PART_ROWS = 200_000
MOST_PARTS = 1024
#: Rows sampled for each part; a part's size is off by about one in the root of it.
SAMPLED = 16


def with_parts(df: DataFrame, keys: Sequence[str], key: Column, part_rows: int = PART_ROWS, name: str = "_part") -> DataFrame:
    """Adds the number of the part a row lies in, from 0 and along ``key``; equal keys share a part.

    Groups of at most ``part_rows`` rows are part 0 as a whole. The sample follows from a hash of the keys, so a row gets the
    same part whenever it is computed. Groups and their split points (at most ``MOST_PARTS`` each) are one small row each.
    """
    keys = list(keys)
    marked = df.withColumn("_key", key)
    sizes = marked.groupBy(*keys).agg(F.count("*").alias("_rows")).where(F.col("_rows") > part_rows)
    parts = F.least(F.ceil(F.col("_rows") / part_rows), F.lit(MOST_PARTS))
    one_in = F.greatest(F.lit(1), F.floor(F.col("_rows") / (parts * SAMPLED)))
    sampled = join_back(marked.select(*keys, "_key"), sizes, keys).where(F.pmod(F.xxhash64("_key"), one_in) == 0)
    # Every so many of the sampled keys, in order; the number of sampled keys is bounded like the parts are.
    drawn = sampled.groupBy(*keys).agg(F.sort_array(F.collect_set("_key")).alias("_drawn"), F.max(parts).cast("int").alias("_parts"))
    step = F.size("_drawn") / F.col("_parts")
    at = F.sequence(F.lit(1), F.greatest(F.col("_parts") - 1, F.lit(1)))
    splits = drawn.select(*keys, F.transform(at, lambda i: F.get("_drawn", F.floor(i * step).cast("int"))).alias("_splits"))
    halves = F.array(*[F.lit(1 << i) for i in reversed(range(MOST_PARTS.bit_length() - 1))])
    found = F.aggregate(
        halves, F.lit(0), lambda low, half: low + F.when(F.get("_splits", low + half - 1) <= F.col("_key"), half).otherwise(0)
    )
    whole = F.col("_splits").isNull()
    return (
        join_back(marked, splits, keys, how="left").withColumn(name, F.when(whole, F.lit(0)).otherwise(found)).drop("_key", "_splits")
    )


def position_by(
    df: DataFrame,
    keys: Sequence[str],
    bucket: Column,
    order: Sequence[Column],
    name: str,
    ties: bool = False,
    along: str | None = None,
    part_rows: int = PART_ROWS,
) -> DataFrame:
    """Numbers the rows of each group from 1, newest bucket first and NULL buckets last.

    ``order`` sorts inside a bucket and must agree with the bucket order. With ``ties`` equal
    rows share a rank and the next rank skips. ``along`` names the column that ``order`` begins with, ascending: then buckets of
    more than ``part_rows`` rows are cut into parts along it.
    """
    keys = list(keys)
    marked = df.withColumn("_bucket", bucket)
    if along is None:
        marked = marked.withColumn("_part", F.lit(0))
    else:
        marked = with_parts(marked, [*keys, "_bucket"], F.col(along), part_rows)
    in_part = W.partitionBy(*keys, "_bucket", "_part").orderBy(*order)
    over_parts = W.partitionBy(*keys).orderBy(F.desc_nulls_last("_bucket"), F.asc("_part"))
    before = (
        marked.groupBy(*keys, "_bucket", "_part")
        .agg(F.count("*").alias("_rows"))
        .withColumn("_before", F.sum("_rows").over(over_parts) - F.col("_rows"))
        .drop("_rows")
    )
    number = F.rank() if ties else F.row_number()
    ranked = join_back(marked.withColumn("_number", number.over(in_part)), before, [*keys, "_bucket", "_part"])
    return ranked.select(*df.columns, (F.col("_number") + F.col("_before")).cast("int").alias(name))


def running_sum(
    df: DataFrame, keys: Sequence[str], step: str, value: str, name: str, total: str, part_rows: int = PART_ROWS
) -> DataFrame:
    """Adds the sum of ``value`` up to each step, NULL steps first, and the group's total. One row per key and step goes in.

    Sums run inside parts of a group's steps, then over the parts' totals, of which a group has ``MOST_PARTS`` at most.
    """
    keys = list(keys)
    # NULL sorts before all else in the parts too: as a part of its own key.
    parted = with_parts(df, keys, F.struct(F.col(step).isNotNull(), F.col(step)), part_rows)
    inside = W.partitionBy(*keys, "_part").orderBy(step).rowsBetween(W.unboundedPreceding, W.currentRow)
    earlier = W.partitionBy(*keys).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sums = parted.groupBy(*keys, "_part").agg(F.sum(value).alias("_sum")).select(
        *keys, "_part", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"), F.sum("_sum").over(W.partitionBy(*keys)).alias(total)
    )
    summed = join_back(parted.withColumn("_inside", F.sum(value).over(inside)), sums, [*keys, "_part"])
    return summed.withColumn(name, F.col("_inside") + F.col("_before")).select(*df.columns, name, total)


def running_share(df: DataFrame, keys: Sequence[str], step: str, value: str, name: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Cumulative share of ``value`` along ``step``, one row per key and step.

    Rows are summed per step first, so the running sum sees at most one row per step.
    """
    steps = df.groupBy(*keys, step).agg(F.sum(value).alias(value))
    summed = running_sum(steps, keys, step, value, "_upto", "_all", part_rows)
    return summed.select(*steps.columns, F.try_divide(F.col("_upto"), F.col("_all")).alias(name))


def first_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The first row of each group, as an aggregate that shrinks before the shuffle."""
    return _edge_row(df, keys, order, F.min_by)


def last_per(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each group."""
    return _edge_row(df, keys, order, F.max_by)


def _edge_row(df: DataFrame, keys: Sequence[str], order: Sequence[str], pick) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    row = pick(F.struct(*rest), F.struct(*order)).alias("row")
    return df.groupBy(*keys).agg(row).select(*keys, "row.*").select(*df.columns)
