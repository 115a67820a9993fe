"""Build id columns. Build ids are strings and compare as strings."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import config


def build_lag_days(chan: Column, os: Column) -> Column:
    """Days a build is tracked under its own id; the first matching case wins."""
    return (
        F.when(chan == "esr", config.LAG_DAYS_ESR)
        .when((chan == "release") & (os == "Linux"), config.LAG_DAYS_RELEASE_LINUX)
        .when(chan == "beta", config.LAG_DAYS_BETA)
        .otherwise(config.LAG_DAYS_OTHER)
    )


def compact_day(day: Column) -> Column:
    """``yyyyMMdd`` of a date (years from 1000 on). Runs once per fact row; measured at about half
    the time of ``date_format`` and of cutting the dashes out of the date's text.
    """
    return (F.year(day) * 10000 + F.month(day) * 100 + F.day(day)).cast("string")


def min_build_id(chan: Column, os: Column, day: Column, offset_days: int = 0) -> Column:
    """The oldest build day tracked on ``day``, as an 8-character id."""
    return compact_day(F.date_sub(day, build_lag_days(chan, os) + offset_days))


def floor_build(build_id: Column, floor: Column | str) -> Column:
    """Raises older ids to ``floor``. NULL stays NULL, which ``greatest`` would not do."""
    floor = F.lit(floor) if isinstance(floor, str) else floor
    return F.when(build_id < floor, floor).otherwise(build_id)


def build_day(build_id: Column) -> Column:
    """The calendar day in the first eight characters, NULL when there is none."""
    return F.try_to_date(F.substring(build_id, 1, 8), "yyyyMMdd")


def nearest_build_day(build_id: Column) -> Column:
    """Build time rounded to the nearest day; exactly noon goes to the even day."""

    def part(start: int) -> Column:
        return F.coalesce(F.substring(build_id, start, 2).try_cast("int"), F.lit(0))

    day, seconds = build_day(build_id), part(9) * 3600 + part(11) * 60 + part(13)
    odd = F.pmod(F.unix_date(day), F.lit(2)) == 1
    up = (seconds > 43200) | ((seconds == 43200) & odd)
    return F.when(up, F.date_add(day, 1)).otherwise(day)


def is_old_build(build_ids: Column) -> Column:
    """Only a floored id is this short; two joined ids are longer."""
    return F.length(build_ids) <= config.OLD_BUILD_LENGTH


def clamp_nightly_day(build_id: Column) -> Column:
    """Build day as text, with floored ids moved to one fixed early day."""
    return F.when(F.length(build_id) == config.OLD_BUILD_LENGTH, F.lit(config.NIGHTLY_CLAMP_DAY)).otherwise(
        F.substring(build_id, 1, 8)
    )
