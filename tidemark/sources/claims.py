"""Exclusive claims of dates, so that of several loading runs at once each date is loaded by one.

A claim is a marker file per date beside the table, created by one run only. It says ``held`` while its run is at work,
``done`` once the date's rows are in, and ``failed`` where the run stopped with an error: the next run takes such dates
up again. A run whose driver died leaves ``held`` markers; they can be taken over after a time the caller names.
"""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.sources import files
from tidemark.sources.tables import is_path

HELD, DONE, FAILED = "held", "done", "failed"


def folder(spark: SparkSession, target: str) -> str:
    """Where a table's markers are: beside a folder, or in the warehouse for a catalog table."""
    if is_path(target):
        return f"{target.rstrip('/')}.claims"
    return f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/{target}.claims"


def _marker(spark: SparkSession, target: str, day: dt.date) -> str:
    return f"{folder(spark, target)}/{day}"


def _text(state: str, owner: str) -> str:
    return f"{state} {owner} {dt.datetime.now(dt.timezone.utc).isoformat()}"


def state(spark: SparkSession, target: str, day: dt.date) -> tuple[str, str, dt.datetime] | None:
    """(state, owner, since) of a date's marker."""
    held = files.read(spark, _marker(spark, target, day))
    if not held:
        return None
    word, owner, since = held.split(" ")
    return word, owner, dt.datetime.fromisoformat(since)


def states(spark: SparkSession, target: str) -> dict[dt.date, tuple[str, str, dt.datetime]]:
    """The markers of a table: one small file per calendar day."""
    days = [dt.date.fromisoformat(n) for n in files.names(spark, folder(spark, target)) if len(n) == 10 and n[0] != "."]
    return {day: found for day in days if (found := state(spark, target, day))}


def claim(
    spark: SparkSession, target: str, days: Sequence[dt.date], owner: str, stale_after: dt.timedelta | None = None
) -> list[dt.date]:
    """The dates this run now owns: those without a marker, with a failed one, or with one held longer than ``stale_after``."""
    won = []
    for day in days:
        marker = _marker(spark, target, day)
        if not files.create_new(spark, marker, _text(HELD, owner)):
            found = state(spark, target, day)
            old = stale_after is not None and found and dt.datetime.now(dt.timezone.utc) - found[2] > stale_after
            if not found or not (found[0] == FAILED or found[0] == HELD and old):
                continue
            # Of several runs that want the marker one moves it away; a new one is created as ever.
            if not files.move(spark, marker, f"{marker}.left-{owner}"):
                continue
            files.delete(spark, f"{marker}.left-{owner}")
            if not files.create_new(spark, marker, _text(HELD, owner)):
                continue
        won.append(day)
    return won


def settle(spark: SparkSession, target: str, days: Sequence[dt.date], owner: str, word: str) -> None:
    """Marks the run's dates as done or failed. Dates that another run has taken over meanwhile stay as they are."""
    for day in days:
        found = state(spark, target, day)
        if found and found[1] == owner:
            files.replace(spark, _marker(spark, target, day), _text(word, owner))


def failed(spark: SparkSession, target: str) -> list[dt.date]:
    return sorted(day for day, (word, *_) in states(spark, target).items() if word == FAILED)


def clear(spark: SparkSession, target: str) -> None:
    """Forgets all claims, for a table that is dropped and loaded anew."""
    files.delete(spark, folder(spark, target))
