"""Serving: rank versions by recency and hand out the newest ones for display."""

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions.builds import is_old_build
from tidemark.operators.aggregates import min_builds
from tidemark.operators.filters import any_of, display_window
from tidemark.operators.joins import join_ranks
from tidemark.operators.ranks import PART_ROWS, position_by
from tidemark.operators.totals import join_back
from tidemark.sources.tables import read_curves

Day = dt.date | str


def rank_versions(curves: DataFrame) -> DataFrame:
    """(os, vers, channel, nth_recent_release): rank by smallest build list, newest first.

    Works on one row per version. Equal lists share a rank and the next rank skips.
    """
    oldest = min_builds(curves, "os", "vers", "channel")
    return position_by(
        oldest,
        ["os", "channel"],
        F.substring("build_ids", 1, 8),
        [F.desc("build_ids")],
        "nth_recent_release",
        ties=True,
    ).drop("build_ids")


def top_ranks(curves: DataFrame, n_versions: Mapping[str, int] = config.TOP_VERSIONS_PRODUCTION) -> DataFrame:
    """Ranks of the newest versions only.

    The constant bound lets Spark keep just the best rows of each task before the shuffle; the
    per-channel bound then trims the rest.
    """
    oldest = min_builds(curves, "os", "vers", "channel")
    newest_first = W.partitionBy("os", "channel").orderBy(F.desc("build_ids"))
    rank, channel = F.col("nth_recent_release"), F.col("channel")
    return (
        oldest.withColumn("nth_recent_release", F.rank().over(newest_first))
        .where(rank <= max(n_versions.values()))
        .where(any_of([(channel == c) & (rank <= n) for c, n in n_versions.items()]))
        .drop("build_ids")
    )


def version_ranks(curves: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """(channel, os, vers, n, nth_recent_release, rank): clients of each version, its number by first day and its rank by builds.

    Both orders and the sum come from one grouping by version. A version's days (as many as the lookback has, at most) are
    kept as one list, which Spark cannot prune differently for each use, so all uses share its shuffle and its scan.
    """
    real = (F.col("vers") != config.FOLD_LABEL) & ~is_old_build(F.col("build_ids"))
    day = F.struct(
        "n", F.when(real, F.col("vers_min_date_above_npct")).alias("first_day"), real.alias("real"),
        F.when(~F.col("old_build"), F.col("build_ids")).alias("builds"),
    )
    listed = curves.groupBy("channel", "os", "vers").agg(F.collect_list(day).alias("days"))
    each = listed.select(
        "channel", "os", "vers", F.aggregate("days", F.lit(0).cast("long"), lambda total, d: total + d["n"]).alias("n"),
        F.array_min(F.transform("days", lambda d: d["first_day"])).alias("first_day"),
        F.exists("days", lambda d: d["real"]).alias("real"),
        F.array_min(F.transform("days", lambda d: d["builds"])).alias("builds"),
    )
    keys = ["channel", "os"]
    numbered = position_by(
        each.where("real").select(*keys, "vers", "first_day"), keys, F.col("first_day"), [F.asc("vers")], "nth_recent_release",
        along="vers", part_rows=part_rows,
    )
    built = each.where("builds is not null").select(*keys, "vers", "builds")
    ranked = position_by(built, keys, F.substring("builds", 1, 8), [F.desc("builds")], "rank", ties=True)
    both = join_back(each.select(*keys, "vers", "n"), numbered.drop("first_day"), [*keys, "vers"], how="left")
    return join_back(both, ranked.drop("builds"), [*keys, "vers"], how="left")


def order_versions(curves: DataFrame) -> DataFrame:
    """(os, vers, build_ids, recent_version_order): 1..n per system, ties in version order."""
    oldest = min_builds(curves, "os", "vers")
    return position_by(
        oldest,
        ["os"],
        F.substring("build_ids", 1, 8),
        [F.desc("build_ids"), F.asc("vers")],
        "recent_version_order",
    )


def top_versions(
    curves: DataFrame, before: Day, n_versions: Mapping[str, int] = config.TOP_VERSIONS_PRODUCTION
) -> DataFrame:
    """Curve rows of the newest versions per channel and system, with their rank."""
    rows = read_curves(curves, before, tuple(n_versions))
    return join_ranks(rows, top_ranks(rows, n_versions))


def sort_for_display(ranked: DataFrame) -> DataFrame:
    return ranked.orderBy("os", "channel", "nth_recent_release")


def display_columns(ranked: DataFrame) -> DataFrame:
    """The columns a chart labels its points with."""
    return ranked.withColumns(
        {
            "show_n": F.col("nth_recent_release"),
            "version": F.col("vers"),
            "week_day": F.date_format("submission_date", "E"),
            "days_after_release": F.col("days_post_pub"),
            "release_day": F.col("vers_min_date_above_npct"),
        }
    )


def chart_feed(
    curves: DataFrame,
    before: Day,
    n_versions: Mapping[str, int] = config.TOP_VERSIONS_PRODUCTION,
    days: Mapping[str, int] = config.DISPLAY_DAYS,
) -> DataFrame:
    """The rows each channel's charts draw."""
    return display_columns(display_window(top_versions(curves, before, n_versions), days))
