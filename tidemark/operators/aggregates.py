"""Aggregations. All shrink on the map side before they shuffle."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions.builds import build_day, clamp_nightly_day, nearest_build_day
from tidemark.functions.dates import as_date, days_since
from tidemark.operators.ranks import PART_ROWS, running_sum
from tidemark.operators.totals import join_back, with_grand_share, with_group, with_share

Day = dt.date | str


def daily_by_version(clients: DataFrame) -> DataFrame:
    return clients.groupBy("submission_date", "app_version").agg(F.count("*").alias("n"))


def sum_by(df: DataFrame, *keys: str, value: str = "n") -> DataFrame:
    return df.groupBy(*keys).agg(F.sum(value).alias(value))


def rows_per_date(table: DataFrame) -> DataFrame:
    return table.groupBy("submission_date").agg(F.count("*").alias("n_rows"))


def latest_date(table: DataFrame) -> DataFrame:
    """One row: the last loaded date and the next one to load. Both NULL for an empty table."""
    last = F.max("submission_date")
    return table.agg(last.alias("latest_date"), F.date_add(last, 1).alias("next_date"))


def distinct_dates(table: DataFrame, first: Day) -> DataFrame:
    return table.where(F.col("submission_date") >= as_date(first)).select("submission_date").distinct()


def argmax(df: DataFrame, keys: Sequence[str], x: str, y: str, tie: str | None = None) -> DataFrame:
    """Per group, ``y`` of the row with the greatest ``x``; the smallest ``tie`` wins ties."""
    return df.groupBy(*keys).agg(F.min_by(y, F.struct((-F.col(x)).alias("x"), F.col(tie or y).alias("tie"))).alias(y))


def argmax_back(df: DataFrame, keys: Sequence[str], x: str, y: str, name: str, tie: str | None = None) -> DataFrame:
    """``argmax`` put back on every row of its group."""
    best = argmax(df, keys, x, y, tie).withColumnRenamed(y, name)
    return join_back(df, best, keys)


def nightly_display_version(nightly: DataFrame) -> DataFrame:
    """Per version, the display version with the largest single count."""
    largest = nightly.where(F.col("dvers").isNotNull()).groupBy("os", "vers", "dvers").agg(F.max("n").alias("n"))
    return argmax(largest, ["os", "vers"], "n", "dvers")


def min_builds(curves: DataFrame, *keys: str) -> DataFrame:
    """Smallest build list of each version that is not an old build."""
    return curves.where(~F.col("old_build")).groupBy(*keys).agg(F.min("build_ids").alias("build_ids"))


def version_share_of_day(counts: DataFrame, chan: str, os: str, more_than: float = 1) -> DataFrame:
    """Versions above a percentage of the day on one channel and system."""
    rows = sum_by(counts.where((F.col("chan") == chan) & (F.col("os") == os)), "submission_date", "vers")
    return with_share(rows, ["submission_date"], total="dayn", share="n_perc").withColumn(
        "n_perc", F.col("n_perc") * 100
    ).where(F.col("n_perc") > more_than)


def current_against_other(daily: DataFrame, versions: Sequence[tuple[str, Day]], days: int = 10) -> DataFrame:
    """The first days of each listed version: its share of all clients, by day index.

    One grouping by date sums everything and each listed version; the sums of the versions that had started
    by then become rows.
    """
    own = [F.coalesce(F.sum(F.when(F.col("app_version") == v, F.col("n"))), F.lit(0)).alias(f"own_{i}") for i, (v, _) in enumerate(versions)]
    sums = daily.groupBy("submission_date").agg(F.sum("n").alias("all_n"), *own)
    listed = F.array(*[
        F.struct(F.lit(v).alias("vers"), F.lit(as_date(d)).alias("start"), F.col(f"own_{i}").alias("cur"))
        for i, (v, d) in enumerate(versions)
    ])
    started = F.filter(listed, lambda s: s["start"] <= F.col("submission_date"))
    in_order = W.partitionBy("vers").orderBy("submission_date")
    share = F.try_divide(F.col("cur"), F.col("all_n"))
    return (
        sums.select("submission_date", "all_n", F.inline(started))
        .withColumn("day", F.row_number().over(in_order) - 1)
        .where(F.col("day") < days)
        .select("vers", "submission_date", "day", "cur", "all_n", share.alias("perc"), F.round(share * 100, 1).alias("percent"))
    )


def other_share(counts: DataFrame, chan: str) -> DataFrame:
    """Daily share of a channel's clients that were folded."""
    folded = F.when(F.col("dvers") == config.FOLD_LABEL, F.col("n")).otherwise(0)
    return (
        counts.where(F.col("chan") == chan)
        .groupBy("submission_date")
        .agg(F.sum(folded).alias("othern"), F.sum("n").alias("n"))
        .withColumn("othnp", F.try_divide("othern", "n"))
    )


def match_rate(rows: DataFrame, keys: Sequence[str], flag: str, counts: DataFrame | None = None) -> DataFrame:
    """Counts per key split by a flag, the percentage true and the share of everything.

    ``counts``: the rows before the join that gave the flag, to take the total from.
    """
    split = rows.groupBy(*keys).agg(
        F.sum(F.when(F.col(flag), F.col("n")).otherwise(0)).alias("n_true"),
        F.sum(F.when(~F.col(flag), F.col("n")).otherwise(0)).alias("n_false"),
        F.sum("n").alias("tot"),
    )
    rated = split.withColumn("perc_true", F.round(F.try_divide("n_true", "tot") * 100, 2))
    return with_grand_share(rated, "tot", "perc", counts, "n").withColumn("perc", F.round(F.col("perc") * 100, 2))


def top_rows(df: DataFrame, n: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(n)


def earliest_build_day(counts: DataFrame, oses: Sequence[str] = config.OSES) -> DataFrame:
    """First build day per channel, one column per system; absent pairs stay NULL."""
    day = nearest_build_day(F.col("bid"))
    return counts.groupBy("chan").pivot("os", list(oses)).agg(F.min(day))


def peak_build(nightly: DataFrame) -> DataFrame:
    """Per system and date, the build day with the most clients, its share and its age in days."""
    per_day = nightly.where(F.substring("bid", 1, 8) > config.NIGHTLY_FIRST_DAY).withColumn(
        "bidd", clamp_nightly_day(F.col("bid"))
    )
    peak = per_day.groupBy("os", "submission_date").agg(
        F.min_by("bidd", F.struct((-F.col("n")).alias("n"), "bidd")).alias("max_bid"),
        F.try_divide(F.max("n"), F.sum("n")).alias("pct"),
    )
    return peak.withColumn("dif", days_since(F.col("submission_date"), build_day(F.col("max_bid"))))


def value_distribution(df: DataFrame, keys: Sequence[str], value: str, part_rows: int = PART_ROWS) -> DataFrame:
    """Relative frequency of a value per group and its running sum, for values of any number.

    Rows are counted per value first; the counts are then summed up in two levels.
    """
    counted = df.groupBy(*keys, value).agg(F.count("*").alias("n"))
    summed = running_sum(counted, keys, value, "n", "_upto", "_all", part_rows)
    return summed.select(
        *counted.columns, (F.col("n") / F.col("_all")).alias("freq"), (F.col("_upto") / F.col("_all")).alias("cum_freq")
    )


def top_mismatches(rows: DataFrame, chan: str, more_than: int, counts: DataFrame | None = None) -> DataFrame:
    """Builds of a channel above its smallest id that often disagree with the registry.

    ``counts``: the rows before the join that gave the flag, to take the smallest id from.
    """
    of_channel = rows.where(F.col("chan") == chan)
    smallest = (of_channel if counts is None else counts.where(F.col("chan") == chan)).agg(F.min("bid")).scalar()
    return (
        of_channel.where((F.col("bid") > smallest) & ~F.col("same_dv"))
        .groupBy("bid")
        .agg(F.sum("n").alias("n"))
        .where(F.col("n") > more_than)
    )


def column_profile(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, column_name, data_type, n_rows, filled, n_distinct) of every other column, in one pass.

    Each row becomes one array with a value per column. Equal values of a column are counted first and columns are summed over
    these counts, so no task holds the values of a column, however many there are. Types are those of the schema.
    """
    columns = [f for f in df.schema.fields if f.name not in keys]
    cells = F.array(*[
        F.struct(F.lit(f.name).alias("column_name"), F.lit(f.dataType.simpleString()).alias("data_type"), F.col(f.name).cast("string").alias("value"))
        for f in columns
    ])
    values = df.select(*keys, F.explode(cells).alias("_cell")).select(*keys, "_cell.*")
    counted = values.groupBy(*keys, "column_name", "data_type", "value").agg(F.count("*").alias("n"))
    return counted.groupBy(*keys, "column_name", "data_type").agg(
        F.sum("n").alias("n_rows"),
        F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("filled"),
        F.count("value").alias("n_distinct"),
    )


def null_profile(curves: DataFrame, keys: Sequence[str] = ("channel",)) -> DataFrame:
    """Filled share of each column per channel, leaving out columns that never differ."""
    rates = column_profile(curves, keys).select(*keys, "column_name", (F.col("filled") / F.col("n_rows")).alias("share"))
    each = F.struct(*keys, "share")
    # One row per column, with one entry per channel.
    varied = rates.groupBy("column_name").agg(F.collect_list(each).alias("_each"), F.max("share").alias("_most"), F.min("share").alias("_least"))
    return (
        varied.where("_most <> _least").select("column_name", F.explode("_each").alias("_of"))
        .select(*[F.col(f"_of.{k}").alias(k) for k in keys], "column_name", F.round("_of.share", 1).alias("filled"))
    )


def distinct_profile(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Distinct values per key column."""
    return column_profile(df.select(*keys)).select("column_name", "n_distinct")


def group_sizes(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many groups there are of each size."""
    sizes = df.groupBy(*keys).agg(F.count("*").alias("group_size"))
    return sizes.groupBy("group_size").agg(F.count("*").alias("n_groups"))


def rank_agreement(rows: DataFrame, first: str, second: str) -> DataFrame:
    """Counts by pair of ranks, and the share of everything where the two agree."""
    pairs = (
        rows.where(F.col(first).isNotNull())
        .groupBy(F.col(first).eqNullSafe(F.col(second)).alias("eq"), first, second)
        .agg(F.sum("n").alias("n"))
    )
    by_eq = pairs.groupBy("eq").agg(F.sum("n").alias("eq_n"))
    shares = with_grand_share(by_eq, "eq_n", "eq_share")
    return pairs.join(shares, "eq")


def log_histogram(counts: DataFrame, chan: str, bins: int = 100) -> DataFrame:
    """Equal-width histogram of log10(n); the last bin includes the maximum."""
    logs = counts.where(F.col("chan") == chan).select(F.log10("n").alias("x"))
    low, high = logs.agg(F.min("x")).scalar(), logs.agg(F.max("x")).scalar()
    position = F.floor(F.try_divide(F.col("x") - low, high - low) * bins)
    last = F.lit(bins - 1)
    binned = logs.select(F.least(F.coalesce(position, F.lit(0)), last).cast("int").alias("bin"))
    return binned.groupBy("bin").agg(F.count("*").alias("n"))
