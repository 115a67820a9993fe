"""Row filters. Each is a plain predicate, so it reaches the scan."""

import datetime as dt
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions.dates import as_date, days_before

Day = dt.date | str


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions)


def in_sample(channel: Column, sample_id: Column, bounds: Mapping = config.SAMPLE_BOUNDS) -> Column:
    """Per-channel sampling as one predicate: the fact is read once, not once per channel."""

    def rule(name: str, low: int | None, high: int | None) -> Column:
        keep = channel == name
        if low is not None and low == high:
            return keep & (sample_id == low)
        if low is not None:
            keep = keep & (sample_id >= low)
        return keep & (sample_id <= high) if high is not None else keep

    return any_of([rule(name, low, high) for name, (low, high) in bounds.items()])


def stratified_sample(clients: DataFrame, bounds: Mapping = config.SAMPLE_BOUNDS) -> DataFrame:
    return clients.where(in_sample(F.col("normalized_channel"), F.col("sample_id"), bounds))


def fixed_windows(
    clients: DataFrame,
    windows: Sequence[tuple[Day, Day]],
    min_build: str,
    channel: str = "release",
    os: str = "Windows_NT",
    sample_id: int = 1,
    app_name: str | None = None,
) -> DataFrame:
    """Rows of a few date ranges on one channel and system, from a build id on."""
    day = F.col("submission_date")
    keep = any_of([day.between(as_date(a), as_date(b)) for a, b in windows])
    keep = keep & (F.col("sample_id") == sample_id) & (F.col("os") == os) & (F.col("channel") == channel)
    if app_name:
        keep = keep & (F.col("app_name") == app_name)
    return clients.where(keep & (F.col("app_build_id") >= min_build))


def channel_window(curves: DataFrame, as_of: Day, months: Mapping[str, int] = config.CURVE_MONTHS) -> DataFrame:
    """The newest months of each channel. Runs after the curve, which needs the older days."""
    day, channel = F.col("submission_date"), F.col("channel")
    return curves.where(any_of([(channel == c) & (day > days_before(as_of, 30 * m)) for c, m in months.items()]))


def display_window(curves: DataFrame, days: Mapping[str, int] = config.DISPLAY_DAYS) -> DataFrame:
    """Days around the release that a chart shows; rows without a start day are dropped."""
    age, channel = F.col("days_post_pub"), F.col("channel")
    return curves.where(
        (age > config.DISPLAY_FLOOR) & any_of([(channel == c) & (age <= d) for c, d in days.items()])
    )


def recent_versions(ranked: DataFrame, n: int = config.SLIDER_VERSIONS, rank: str = "nth_recent_release") -> DataFrame:
    return ranked.where(F.col(rank) <= n)


def at_least_build(counts: DataFrame, builds: DataFrame) -> DataFrame:
    """Counts from the earliest build of ``builds`` on; the bound is a scalar subquery."""
    return counts.where(F.col("bid") >= builds.agg(F.min("build_id")).scalar())


def frequent_rows(counts: DataFrame, chan: str, more_than: int) -> DataFrame:
    return counts.where((F.col("chan") == chan) & (F.col("n") > more_than)).orderBy("n")
