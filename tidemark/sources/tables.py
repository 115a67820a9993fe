"""Reading the fact and the stored tables. Bounds are literals, so partitions are pruned."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions.dates import as_date, days_before

Day = dt.date | str


def is_path(name: str) -> bool:
    """Tables are named; anything with a slash is a folder of Parquet files."""
    return "/" in name


def read_table(spark: SparkSession, source: str) -> DataFrame:
    return spark.read.parquet(source) if is_path(source) else spark.table(source)


def between_days(df: DataFrame, first: Day, last: Day | None = None) -> DataFrame:
    """Rows of ``first`` to ``last``, both included; one day when ``last`` is not given."""
    first = as_date(first)
    return df.where(F.col("submission_date").between(first, as_date(last) if last else first))


def scan_clients(
    clients: DataFrame,
    first: Day,
    last: Day | None = None,
    app_name: str | None = None,
    oses: Sequence[str] = config.OSES,
) -> DataFrame:
    """Client days of one application on the tracked systems."""
    rows = between_days(clients, first, last).where(F.col("os").isin(*oses))
    return rows.where(F.col("app_name") == app_name) if app_name else rows


def read_counts(counts: DataFrame, as_of: Day, lookback_days: int = config.LOOKBACK_DAYS) -> DataFrame:
    """The counts the curve job works on: the as-of date and the days before it."""
    return between_days(counts, days_before(as_of, lookback_days), as_of)


def read_curves(curves: DataFrame, before: Day, channels: Sequence[str] = config.CURVE_CHANNELS) -> DataFrame:
    """Curve rows of the given channels strictly before a date."""
    return curves.where((F.col("submission_date") < as_date(before)) & F.col("channel").isin(*channels))
