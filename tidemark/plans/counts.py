"""Daily counts: sample, floor old builds, count, and fold rare versions together."""

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions.builds import floor_build, min_build_id
from tidemark.functions.dates import days_between
from tidemark.operators.filters import stratified_sample
from tidemark.operators.totals import DAY_KEYS, with_share
from tidemark.sources.tables import scan_clients

Day = dt.date | str
COUNT_KEYS = ("submission_date", "chan", "os", "dvers", "vers", "bid")


def floored_clients(sampled: DataFrame) -> DataFrame:
    """The count keys of each client day, builds floored to the oldest tracked day."""
    chan, os, day = F.col("normalized_channel"), F.col("os"), F.col("submission_date")
    return sampled.select(
        "submission_date",
        chan.alias("chan"),
        "os",
        F.col("app_display_version").alias("dvers"),
        F.col("app_version").alias("vers"),
        floor_build(F.col("app_build_id"), min_build_id(chan, os, day)).alias("bid"),
    )


def count_versions(sampled: DataFrame) -> DataFrame:
    """Clients per day, channel, system, version and floored build."""
    return floored_clients(sampled).groupBy(*COUNT_KEYS).agg(F.count("*").alias("n"))


def count_versions_const(clients: DataFrame, floor: str) -> DataFrame:
    """The same with one floor for all rows."""
    keys = floored_clients(clients).drop("bid").columns
    raw = clients.select(
        "submission_date",
        F.col("channel").alias("chan"),
        "os",
        F.col("app_display_version").alias("dvers"),
        F.col("app_version").alias("vers"),
        floor_build(F.col("app_build_id"), floor).alias("bid"),
    )
    return raw.groupBy(*keys, "bid").agg(F.count("*").alias("n"))


def fold_rare(
    counts: DataFrame,
    threshold: float = config.FOLD_SHARE,
    label: str = config.FOLD_LABEL,
    max_groups: int | None = None,
) -> DataFrame:
    """Renames rows at or under the share of their day, one row at a time; sums are not redone.

    ``max_groups`` bounds how many (day, channel, system) groups there can be.
    """
    shared = with_share(counts, DAY_KEYS, total="os_chan_n", max_groups=max_groups)
    keep = F.col("share") > threshold
    folded_bid = min_build_id(F.col("chan"), F.col("os"), F.col("submission_date"), config.FOLD_OFFSET_DAYS)
    return shared.select(
        "submission_date",
        "chan",
        "os",
        F.when(keep, F.col("dvers")).otherwise(label).alias("dvers"),
        F.when(keep, F.col("vers")).otherwise(label).alias("vers"),
        F.when(keep, F.col("bid")).otherwise(folded_bid).alias("bid"),
        "n",
    )


def reduce_counts(counts: DataFrame) -> DataFrame:
    return counts.groupBy(*COUNT_KEYS).agg(F.sum("n").alias("n"))


def version_counts(
    clients: DataFrame,
    first: Day,
    last: Day | None = None,
    app_name: str | None = None,
    bounds: Mapping = config.SAMPLE_BOUNDS,
    threshold: float = config.FOLD_SHARE,
) -> DataFrame:
    """The counts table for a range of days.

    The fact is scanned once. Its count is partially aggregated before the only large shuffle;
    the day totals reuse that shuffle's output. There is one total per day, sampled channel and
    tracked system, so their number is known beforehand.
    """
    sampled = stratified_sample(scan_clients(clients, first, last, app_name), bounds)
    groups = days_between(first, last or first) * len(bounds) * len(config.OSES)
    return reduce_counts(fold_rare(count_versions(sampled), threshold, max_groups=groups))
