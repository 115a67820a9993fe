"""The three daily batch jobs and the version dimension."""

import datetime as dt
import uuid
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions import versions as V
from tidemark.functions.dates import as_date, days_before
from tidemark.operators.aggregates import latest_date
from tidemark.operators.quality import QualityError, duplicate_dates
from tidemark.plans.counts import version_counts
from tidemark.plans.curves import adoption_curves, backfill_curves
from tidemark.plans.serve import chart_feed
from tidemark.sources import claims, sinks
from tidemark.sources.tables import read_table

Day = dt.date | str


def increment_range(table: DataFrame, as_of: Day, first: Day | None = None, last: Day | int = 1) -> tuple[dt.date, dt.date]:
    """First and last date to load: the day after the newest loaded one, up to ``last``.

    An integer ``last`` means that many days before ``as_of``.
    """
    end = days_before(as_of, last) if isinstance(last, int) else as_date(last)
    if first is not None:
        return as_date(first), end
    start = latest_date(table).first()["next_date"]
    if start is None:
        raise QualityError("the table is empty: name the first date to load")
    return start, end


def check_not_loaded(table: DataFrame, first: Day, last: Day) -> None:
    """Stops when the table already holds dates of the range."""
    held = [str(row["submission_date"]) for row in duplicate_dates(table, first, last).orderBy("submission_date").collect()]
    if held:
        raise QualityError(f"dates already loaded: {', '.join(held)}")


def run_counts(
    clients: DataFrame,
    target: str,
    as_of: Day,
    first: Day | None = None,
    last: Day | int = 1,
    drop_first: bool = False,
    check_dates: bool = True,
    target_exists: bool = True,
    stale_after: dt.timedelta | None = None,
    **options,
) -> tuple[dt.date, dt.date] | None:
    """Step 1: counts of the missing dates, appended. None when there is nothing to load.

    Each date is claimed before it is counted, so of runs at once one loads it, and written as a whole. Dates that an
    earlier run claimed and failed on are loaded again; those of a run that died are, once they are held longer than
    ``stale_after``. Without ``check_dates`` rows are added whatever the table holds.
    """
    spark = clients.sparkSession
    if target_exists:
        start, end = increment_range(read_table(spark, target), as_of, first, last)
    elif first is None:
        raise QualityError("a new table needs a first date")
    else:
        start, end = as_date(first), days_before(as_of, last) if isinstance(last, int) else as_date(last)
    if not check_dates:
        if start > end:
            return None
        write = sinks.replace_counts if drop_first else sinks.append_counts
        write(version_counts(clients, start, end, **options), target)
        return start, end
    if drop_first:
        claims.clear(spark, target)
    elif target_exists and start <= end:
        check_not_loaded(read_table(spark, target), start, end)
    wanted = {start + dt.timedelta(days=i) for i in range((end - start).days + 1)}
    wanted |= {day for day in claims.failed(spark, target) if day <= end}
    if stale_after is not None:
        held = claims.states(spark, target)
        wanted |= {day for day, (word, *_) in held.items() if word == claims.HELD and day <= end}
    owner = uuid.uuid4().hex
    won = claims.claim(spark, target, sorted(wanted), owner, stale_after)
    if not won:
        return None
    try:
        counts = version_counts(clients, won[0], won[-1], **options)
        if len(won) <= (won[-1] - won[0]).days:
            counts = counts.where(F.col("submission_date").isin(won))
        write = sinks.replace_counts if drop_first else sinks.load_dates
        write(counts, target)
    except BaseException:
        claims.settle(spark, target, won, owner, claims.FAILED)
        raise
    claims.settle(spark, target, won, owner, claims.DONE)
    return won[0], won[-1]


def run_curves(
    counts: DataFrame,
    target: str,
    as_of: Day,
    target_exists: bool = True,
    returns: str | None = None,
    months: Mapping[str, int] = config.CURVE_MONTHS,
) -> DataFrame | None:
    """Step 2: curve rows of the dates the target does not hold yet."""
    curves = adoption_curves(counts, as_of, months)
    return sinks.append_new_dates(curves, target, _window_start(as_of, months), target_exists, returns)


def run_backfill(
    counts: DataFrame, target: str, first: Day, last: Day, months: Mapping[str, int] = config.CURVE_MONTHS
) -> None:
    """Step 2 for every date of a range, as one job into a new table."""
    curves = backfill_curves(counts, first, last, months)
    sinks.append_new_dates(curves, target, _window_start(first, months), target_exists=False, returns=None)


def run_serve(curves: DataFrame, target: str, before: Day, **options) -> None:
    """Step 3: the chart rows of the newest versions."""
    sinks.write_chart_feed(chart_feed(curves, before, **options), target, before)


def run_daily(
    clients: DataFrame, counts: str, curves: str, feed: str, as_of: Day, app_name: str | None = None, **options
) -> tuple[dt.date, dt.date] | None:
    """The three steps of a day, one after the other. An error in one keeps the later ones from running.

    Curves are those as of the last full day, and the feed shows what lies before ``as_of``. Returns the dates loaded.
    """
    spark = clients.sparkSession
    loaded = run_counts(clients, counts, as_of, app_name=app_name)
    run_curves(read_table(spark, counts), curves, days_before(as_of, 1))
    run_serve(read_table(spark, curves), feed, as_of, **options)
    return loaded


def _window_start(as_of: Day, months: Mapping[str, int]) -> dt.date:
    return days_before(as_of, 30 * max(months.values()))


def version_dimension(*sources: DataFrame) -> DataFrame:
    """One row per version text seen in any source, with everything derived from it.

    Each source is a frame with a ``version`` column; duplicates go before the shuffle. Versions with
    ``rc``, which some channels of the registry keep, have no sortable form.
    """
    versions = sources[0].select("version")
    for source in sources[1:]:
        versions = versions.unionByName(source.select("version"))
    v = F.col("version")
    return versions.where(v.isNotNull()).distinct().select(
        "version",
        V.is_major(v).alias("is_major"),
        V.is_rc(v).alias("is_rc"),
        F.when(~v.contains("rc"), V.sortable_beta(v)).alias("sortable"),
        V.major(v).alias("major"),
        V.release_major(v).alias("release_major"),
        V.rc_major(v).alias("rc_major"),
    )
