"""Joins. All are equi-joins without broadcast hints: Spark broadcasts a side only when its
measured size is under ``spark.sql.autoBroadcastJoinThreshold`` and otherwise shuffles, splitting
skewed partitions.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.totals import join_back


def release_date_lookup(dates: DataFrame) -> DataFrame:
    """One date per (chan, version): the row with the greatest ordinal."""
    return dates.groupBy("chan", "version").agg(F.max_by("date", F.struct("ordinal", "date")).alias("rls_date"))


def join_release_date(counts: DataFrame, dates: DataFrame, version: str = "dvers") -> DataFrame:
    """Adds ``rls_date``, NULL for versions without one. Never adds rows."""
    lookup = release_date_lookup(dates).withColumnRenamed("version", version)
    return counts.join(lookup, ["chan", version], "left").select(*counts.columns, "rls_date")


def with_first_release(counts: DataFrame, dates: DataFrame, keys: Sequence[str] = ("chan", "os", "vers")) -> DataFrame:
    """Adds ``vers_pub_date``, the earliest release date among a version's display versions.

    Dates are looked up once per version and display version, not per row, and the earliest is joined back.
    """
    seen = counts.select(*keys, "dvers").distinct()
    firsts = join_release_date(seen, dates).groupBy(*keys).agg(F.min("rls_date").alias("vers_pub_date"))
    return join_back(counts, firsts, keys)


def join_ranks(curves: DataFrame, ranks: DataFrame) -> DataFrame:
    """Curve rows with the rank of their version; unranked versions are dropped."""
    return curves.join(ranks, ["os", "vers", "channel"], "left").where(F.col("nth_recent_release").isNotNull())


def join_channel_order(curves: DataFrame, order: DataFrame) -> DataFrame:
    """Curve rows with the position of their version, NULL for old builds. All rows stay."""
    return curves.join(order.select("os", "vers", "recent_version_order"), ["os", "vers"], "left").select(
        *curves.columns, "recent_version_order"
    )


def join_registry(counts: DataFrame, builds: DataFrame) -> DataFrame:
    """Counts with the registry's version and date for their build, and whether versions agree."""
    lookup = builds.select(
        "chan",
        F.col("build_id").alias("bid"),
        F.col("version").alias("reg_dvers"),
        F.col("date").alias("reg_pub_date"),
    )
    joined = counts.join(lookup, ["chan", "bid"], "left")
    return joined.select(
        *counts.columns,
        "reg_dvers",
        "reg_pub_date",
        F.coalesce(F.col("dvers") == F.col("reg_dvers"), F.lit(False)).alias("same_dv"),
    )


def with_presence(df: DataFrame, other: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Adds a boolean telling whether ``keys`` occur in ``other``."""
    seen = other.select(*keys).distinct().withColumn("_seen", F.lit(True))
    return df.join(seen, list(keys), "left").withColumn(flag, F.col("_seen").isNotNull()).drop("_seen")


def full_compare(prod: DataFrame, test: DataFrame, keys: Sequence[str]) -> DataFrame:
    """All key combinations of both tables with a flag for each side (``p`` and ``t``).

    Sides are joined null-safe, since the compared keys may be NULL.
    """
    left = prod.select(*keys, F.lit(True).alias("_p")).alias("l")
    right = test.select(*keys, F.lit(True).alias("_t")).alias("r")
    same: list[Column] = [F.col(f"l.{k}").eqNullSafe(F.col(f"r.{k}")) for k in keys]
    return left.join(right, same, "full_outer").select(
        *[F.coalesce(F.col(f"l.{k}"), F.col(f"r.{k}")).alias(k) for k in keys],
        F.col("_p").isNotNull().alias("p"),
        F.col("_t").isNotNull().alias("t"),
    )


def compare_counts(prod: DataFrame, test: DataFrame, keys: Sequence[str], more_than: float = 1) -> DataFrame:
    """Keys of ``prod`` whose count differs from ``test`` by more than a percentage.

    A NULL key is a key like any other and matches itself.
    """
    np_ = prod.groupBy(*keys).agg(F.sum("n").alias("np"))
    nt_ = test.groupBy(*keys).agg(F.sum("n").alias("nt"))
    percent = F.round(F.try_divide(F.col("df"), F.col("np")) * 100, 1)
    return (
        join_back(np_, nt_, keys, how="left")
        .withColumn("nt", F.coalesce("nt", F.lit(0)))
        .withColumn("df", F.col("nt") - F.col("np"))
        .withColumn("dfp", percent)
        .withColumn("dfpa", F.abs("dfp"))
        .where(F.col("dfpa") > more_than)
    )


def mark_new_rows(today: DataFrame, yesterday: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Today's rows with yesterday's count, ``new`` when there was no such row. NULL keys match like any other."""
    before = yesterday.select(*keys, F.col("n").alias("n2"), F.lit(True).alias("_seen"))
    joined = join_back(today.select(*keys, "n"), before, keys, how="left")
    return joined.withColumn("new", F.col("_seen").isNull()).drop("_seen")


def not_loaded(rows: DataFrame, loaded_dates: DataFrame, day: str = "submission_date") -> DataFrame:
    """Rows whose date is not in the loaded dates."""
    return rows.join(loaded_dates.select(day).distinct(), day, "left_anti")


def versions_without_date(counts: DataFrame, dates: DataFrame, version: str = "dvers") -> DataFrame:
    """Distinct versions seen in counts that have no release date."""
    known = dates.select(F.col("version").alias(version))
    return counts.select(version).distinct().join(known, version, "left_anti")
