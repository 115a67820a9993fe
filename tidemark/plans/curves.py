"""Adoption curves: the share of each day's clients a version has, from its first real day on."""

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, WindowSpec
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import config, schemas
from tidemark.functions import versions as V
from tidemark.functions.builds import build_day, is_old_build
from tidemark.functions.dates import as_date, days_before, days_between, days_since
from tidemark.operators.filters import channel_window
from tidemark.operators.joins import join_release_date
from tidemark.operators.ranks import PART_ROWS, position_by
from tidemark.operators.totals import join_back
from tidemark.sources.tables import between_days, read_counts

Day = dt.date | str
Span = tuple[Day, Day] | None
CURVE_KEYS = ("channel", "os", "vers")
DAY_KEYS = ("submission_date", "channel", "os")
SERIES = len(config.CURVE_CHANNELS) * len(config.OSES)   # channels times systems, at most


def version_key(chan: Column, vers: Column, dvers: Column, bid: Column) -> Column:
    """What a channel calls a version: the release version, the display version or the build day."""
    return (
        F.when(chan == "release", vers)
        .when(chan.isin("beta", "aurora"), dvers)
        .when(chan == "nightly", F.substring(bid, 1, 8))
    )


def of_curve_channels(counts: DataFrame, channels: Sequence[str] = config.CURVE_CHANNELS) -> DataFrame:
    """Rows of the given channels. Channels without curves are left out by name; any other fails the job."""
    chan = F.col("chan")
    unknown = F.raise_error(F.concat(F.lit("no curve is defined for channel "), F.coalesce(chan, F.lit("NULL"))))
    known = F.coalesce(chan.isin(*config.CURVE_CHANNELS, *config.UNCURVED_CHANNELS), F.lit(False))
    return counts.where(F.when(known, chan.isin(*channels)).otherwise(unknown.cast("boolean")))


def unify_channels(counts: DataFrame, channels: Sequence[str] = config.CURVE_CHANNELS) -> DataFrame:
    """Counts of the tracked channels in one shape: one projection, not a frame per channel."""
    key = version_key(F.col("chan"), F.col("vers"), F.col("dvers"), F.col("bid"))
    return of_curve_channels(counts, channels).where(F.col("os").isin(*config.OSES)).select(
        "submission_date", F.col("chan").alias("channel"), "os", key.alias("vers"), "dvers", "bid", "n"
    )


def unify_with_release_dates(counts: DataFrame, dates: DataFrame) -> DataFrame:
    """``unify_channels`` with ``rls_date``: looked up by display version, or the nightly's day."""
    dated = join_release_date(of_curve_channels(counts), dates)
    chan = F.col("chan")
    return dated.select(
        "submission_date",
        chan.alias("channel"),
        "os",
        version_key(chan, F.col("vers"), F.col("dvers"), F.col("bid")).alias("vers"),
        "dvers",
        "bid",
        "n",
        F.when(chan == "nightly", build_day(F.col("bid"))).otherwise(F.col("rls_date")).alias("rls_date"),
    )


def by_version(unified: DataFrame, span: Span = None) -> DataFrame:
    """(channel, os, vers, submission_date, entries): the counts of each version and day as one list.

    The counts were folded, so a day has less than 1 / FOLD_SHARE of them per channel and system, and a list is
    short. Versions, day totals and newest builds are all derived from this one aggregate: what they need is
    in one column, so Spark cannot prune it differently for each, and they share its shuffle and scan. ``span`` keeps some of
    the days; the day is asked of the list too, so that runs over different spans still share the aggregate below.
    """
    day = F.col("submission_date").alias("day")
    listed = unified.groupBy(*CURVE_KEYS, "submission_date").agg(
        F.collect_list(F.struct("bid", "n", "dvers", "vers", day)).alias("entries")
    )
    return listed if span is None else listed.where(F.col("entries")[0]["day"].between(*map(as_date, span)))


def _clients() -> Column:
    return F.aggregate("entries", F.lit(0).cast("long"), lambda total, e: total + e["n"])


def collapse_builds(unified: DataFrame, span: Span = None) -> DataFrame:
    """One row per version and day: its build ids as one sorted text, and its clients.

    ``top`` (the largest single count with its display version) is carried along so that nightly's
    display version needs no second aggregation.
    """
    bids = F.filter(F.transform("entries", lambda e: e["bid"]), lambda b: b.isNotNull())
    shown = F.filter("entries", lambda e: e["dvers"].isNotNull())
    top = F.array_min(F.transform(shown, lambda e: F.struct((-e["n"]).alias("neg_n"), e["dvers"].alias("dvers"))))
    # Asked of the list, not of the key: a filter on the key would move below the shared aggregate.
    named = by_version(unified, span).where(F.col("entries")[0]["vers"].isNotNull())
    return named.select(
        *CURVE_KEYS,
        "submission_date",
        F.nullif(F.array_join(F.array_sort(bids), "\n"), F.lit("")).alias("build_ids"),
        F.array_min(bids).alias("min_build_id"),
        _clients().alias("n"),
        top.alias("top"),
    )


def with_denominator(collapsed: DataFrame, unified: DataFrame, days: int | None = None, span: Span = None) -> DataFrame:
    """Adds the day's total (as largest and smallest, which must agree) and the share of it.

    Rows without a version count towards the total but have no curve of their own. ``days`` bounds how many
    dates the counts have, and with them the number of totals.
    """
    totals = by_version(unified, span).groupBy(*DAY_KEYS).agg(F.sum(_clients()).alias("day_chan_os_sum"))
    # Null-safe: a plain join on the date would let Spark prune dates by these totals, with a second scan for nothing.
    return join_back(collapsed, totals, DAY_KEYS, days and days * SERIES).withColumns(
        {
            "day_chan_os_sum_min": F.col("day_chan_os_sum"),
            "n_pct": F.col("n") / F.col("day_chan_os_sum"),
        }
    )


def _newest() -> Column:
    """The version with the greatest build id, as a (bid, vers) pair."""
    built = F.filter("entries", lambda e: e["bid"].isNotNull())
    return F.max(F.array_max(F.transform(built, lambda e: F.struct(e["bid"].alias("bid"), e["vers"].alias("vers")))))


def with_latest_flag(collapsed: DataFrame, unified: DataFrame, span: Span = None) -> DataFrame:
    """Marks the version that has the greatest build id of its channel and system."""
    newest = by_version(unified, span).groupBy("channel", "os").agg(_newest().alias("newest"))
    return _flag_latest(join_back(collapsed, newest, ["channel", "os"], SERIES))


def _flag_latest(df: DataFrame) -> DataFrame:
    is_newest = F.coalesce(F.col("vers") == F.col("newest.vers"), F.lit(False))
    return df.withColumn("latest_vers", is_newest).drop("newest")


def _all_days() -> WindowSpec:
    """One version's days: at most one row per day of the lookback."""
    return W.partitionBy(*CURVE_KEYS)


def _days_up_to_each(keys: Sequence[str], lookback_days: int) -> WindowSpec:
    """For each day, the lookback that a run as of that day would have read."""
    return W.partitionBy(*keys).orderBy(F.unix_date("submission_date")).rangeBetween(-lookback_days, 0)


def with_first_day(
    shares: DataFrame, min_share: float = config.FIRST_DAY_SHARE, version: WindowSpec | None = None
) -> DataFrame:
    """Adds the first day above the share, and days since then.

    A curve whose earliest day is exactly one before its first day moves by one.
    """
    version = version or _all_days()
    first = F.min(F.when(F.col("n_pct") > min_share, F.col("submission_date"))).over(version)
    earliest = F.min("submission_date").over(version)
    return (
        shares.withColumn("vers_min_date_above_npct", first)
        .withColumn("_earliest", earliest)
        .withColumn("days_post_pub", unoffset_days("submission_date", "vers_min_date_above_npct", "_earliest"))
        .drop("_earliest")
    )


def unoffset_days(day: str, first: str, earliest: str) -> Column:
    """Days since ``first``, plus one for curves that begin exactly one day before it."""
    shift = F.when(days_since(F.col(earliest), F.col(first)) == -1, 1).otherwise(0)
    return days_since(F.col(day), F.col(first)) + shift


def with_channel_flags(curves: DataFrame, version: WindowSpec | None = None) -> DataFrame:
    """Flags that only one channel has: major release, release candidate, nightly's version.

    A channel outside the tracked ones fails the job.
    """
    channel, vers = F.col("channel"), F.col("vers")
    top = F.min("top").over(version or _all_days())
    unknown = F.raise_error(F.concat(F.lit("no curve is defined for channel "), channel))
    return curves.withColumns(
        {
            "is_major": F.when(~channel.isin(*config.CURVE_CHANNELS), unknown).when(
                channel == "release", V.is_major(vers)
            ),
            "RC": F.when(channel == "beta", V.is_rc(vers)),
            "dvers": F.when(channel == "nightly", top["dvers"]),
        }
    )


def fill_flags(curves: DataFrame) -> DataFrame:
    return curves.fillna(False, ["is_major", "RC"]).drop("nth_recent_release")


def adoption_curves(
    counts: DataFrame,
    as_of: Day,
    months: Mapping[str, int] = config.CURVE_MONTHS,
    min_share: float = config.FIRST_DAY_SHARE,
    lookback_days: int = config.LOOKBACK_DAYS,
) -> DataFrame:
    """The curve table for one as-of date, all channels and systems in one pass."""
    return _curves_as_of(unify_channels(read_counts(counts, as_of, lookback_days)), as_of, months, min_share, lookback_days)


def _curves_as_of(
    unified: DataFrame, as_of: Day, months: Mapping[str, int], min_share: float, lookback_days: int, span: Span = None
) -> DataFrame:
    flagged = with_latest_flag(collapse_builds(unified, span), unified, span)
    shares = with_denominator(flagged, unified, lookback_days + 1, span)
    curves = _finish(shares, min_share)
    return channel_window(curves, as_of, months).select(*schemas.CURVES.fieldNames())


def _finish(shares: DataFrame, min_share: float, version: WindowSpec | None = None) -> DataFrame:
    dated = with_first_day(shares.withColumn("old_build", is_old_build(F.col("build_ids"))), min_share, version)
    return fill_flags(with_channel_flags(dated, version))


def daily_curves(
    counts: DataFrame,
    first: Day,
    last: Day,
    min_share: float = config.FIRST_DAY_SHARE,
    lookback_days: int = config.LOOKBACK_DAYS,
) -> DataFrame:
    """For each day of a range, the rows of that day as a run as of that day gives them.

    One pass with sliding frames over each version's days replaces a job per day, each of which
    would read its whole lookback again.
    """
    unified = unify_channels(between_days(counts, days_before(first, lookback_days), last))
    return _daily_curves(unified, first, last, min_share, lookback_days)


def _daily_curves(unified: DataFrame, first: Day, last: Day, min_share: float, lookback_days: int, span: Span = None) -> DataFrame:
    first, last = as_date(first), as_date(last)
    # Newest build per day first, then up to each day: one row per day, channel and system.
    per_day = by_version(unified, span).groupBy(*DAY_KEYS).agg(_newest().alias("newest_of_day"))
    newest = per_day.select(
        "channel",
        "os",
        "submission_date",
        F.max("newest_of_day").over(_days_up_to_each(("channel", "os"), lookback_days)).alias("newest"),
    )
    days = days_between(first, last) + lookback_days
    flagged = _flag_latest(join_back(collapse_builds(unified, span), newest, DAY_KEYS, days * SERIES))
    curves = _finish(with_denominator(flagged, unified, days, span), min_share, _days_up_to_each(CURVE_KEYS, lookback_days))
    return between_days(curves, first, last).select(*schemas.CURVES.fieldNames())


def backfill_curves(
    counts: DataFrame,
    first: Day,
    last: Day,
    months: Mapping[str, int] = config.CURVE_MONTHS,
    min_share: float = config.FIRST_DAY_SHARE,
    lookback_days: int = config.LOOKBACK_DAYS,
) -> DataFrame:
    """What running the curve job for every date of a range, first date on, leaves in its table.

    The first date's curves and the days after it come from one aggregate over all days either of them reads.
    """
    if as_date(first) >= as_date(last):
        return adoption_curves(counts, first, months, min_share, lookback_days)
    begin, next_day = days_before(first, lookback_days), days_before(first, -1)
    unified = unify_channels(between_days(counts, begin, last))
    start = _curves_as_of(unified, first, months, min_share, lookback_days, (begin, first))
    later = _daily_curves(unified, next_day, last, min_share, lookback_days, (days_before(next_day, lookback_days), last))
    return start.unionByName(later)


def nth_release(curves: DataFrame, part_rows: int = PART_ROWS) -> DataFrame:
    """Numbers versions per channel and system by first day, newest first, undated last.

    The fold label and old builds get no number. Where very many versions have no first day they are numbered in parts.
    """
    real = curves.where((F.col("vers") != config.FOLD_LABEL) & ~is_old_build(F.col("build_ids")))
    firsts = real.groupBy(*CURVE_KEYS).agg(F.min("vers_min_date_above_npct").alias("first_day"))
    numbered = position_by(firsts, ["channel", "os"], F.col("first_day"), [F.asc("vers")], "nth_recent_release", along="vers", part_rows=part_rows)
    return curves.join(numbered.drop("first_day"), list(CURVE_KEYS), "left")
