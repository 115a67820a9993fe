"""Build registry: which versions were published under which build id, and when."""

import datetime as dt
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config, schemas
from tidemark.functions import versions as V
from tidemark.functions.dates import days_before, epoch_ms
from tidemark.operators.totals import join_back


def build_registry(
    records: DataFrame,
    min_build: str,
    channels: Sequence[str],
    product: str | None = None,
    platform: str = config.REGISTRY_PLATFORM,
    locale: str = config.REGISTRY_LOCALE,
) -> DataFrame:
    """One row per (channel, build id) with its versions and the times they were first published."""
    wanted = (
        (F.col("platform") == platform)
        & (F.col("locale") == locale)
        & F.col("channel").isin(*channels)
        & (F.col("build_id") >= min_build)
    )
    if product:
        wanted = wanted & (F.col("product") == product)
    # Earliest time per version first, so that a build with very many records is small before its
    # versions meet. One list of pairs, not two lists: consumers that need only part of it still
    # share the shuffle.
    first_seen = records.where(wanted).groupBy("channel", "build_id", "version").agg(F.min("pub_ms").alias("pub_ms"))
    builds = first_seen.groupBy("channel", "build_id").agg(
        F.collect_list(F.struct("version", "pub_ms")).alias("published")
    )
    values = lambda field: F.array_sort(F.array_distinct(F.transform("published", lambda p: p[field])))
    return builds.select("channel", "build_id", values("version").alias("versions"), values("pub_ms").alias("pub_dates"))


def buckets_to_registry(dump: DataFrame, channel: str) -> DataFrame:
    """A registry dump in bucket form as (channel, build_id, versions, pub_dates)."""
    keys = lambda field: F.array_sort(F.transform(F.col(f"{field}.buckets"), lambda b: b["key"]))
    return dump.select(
        F.lit(channel).alias("channel"),
        F.array_min(keys("buildid")).alias("build_id"),
        keys("version").alias("versions"),
        keys("pub_date").alias("pub_dates"),
    )


def read_registry_dump(spark: SparkSession, path: str, channel: str) -> DataFrame:
    """A dump of one JSON bucket per line; the schema is given, never inferred. A broken line fails the job."""
    return buckets_to_registry(spark.read.schema(schemas.REGISTRY_BUCKET).json(path, mode="FAILFAST"), channel)


def unreadable_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Lines of a dump that are no JSON bucket of the schema."""
    with_rest = T.StructType([*schemas.REGISTRY_BUCKET.fields, T.StructField("_broken", T.StringType())])
    parsed = F.from_json(F.col(line), with_rest, {"columnNameOfCorruptRecord": "_broken"})
    return lines.where((F.trim(line) != "") & F.coalesce(parsed["_broken"].isNotNull(), F.lit(True)))


Choice = Callable[[Column], Column]


def smallest_text(versions: Column) -> Column:
    """The smallest version string: ``70.0b10`` comes before ``70.0b3``."""
    return F.array_min(versions)


def latest_release(versions: Column) -> Column:
    """The last version in release order: numbers compare as numbers, and a beta comes before its release."""
    def order(v: Column) -> Column:
        numbers = F.transform(F.split(F.split_part(v, F.lit("b"), F.lit(1)), r"\."), lambda x: F.coalesce(x.try_cast("int"), F.lit(-1)))
        beta = F.when(v.contains("b"), F.split_part(v, F.lit("b"), F.lit(2)).try_cast("int")).otherwise(F.lit(2**31 - 1))
        return F.struct(numbers.alias("numbers"), beta.alias("beta"), v.alias("version"))

    return F.array_max(F.transform(versions, order))["version"]


def registry_triplets(
    registry: DataFrame,
    wanted_major: V.MajorSpec = None,
    keep_rc: bool | Column = False,
    keep_release: bool = False,
    choose: Choice = smallest_text,
) -> DataFrame:
    """(channel, version, build_id, pub_ms): one of the kept versions of each build, and the earliest time.

    ``choose`` picks the version from the array of kept ones. Builds left without a version are dropped.
    """
    kept = F.filter("versions", lambda v: V.version_kind(v, keep_rc, keep_release) & V.major_version(v, wanted_major))
    return registry.select(
        "channel",
        choose(kept).alias("version"),
        "build_id",
        F.array_min("pub_dates").alias("pub_ms"),
    ).where(F.col("version").isNotNull())


def last_runs(triplets: DataFrame, keep_all_runs: bool = False) -> DataFrame:
    """Walking each channel's builds from newest to oldest, the last run of each version.

    A run is a stretch of neighbouring builds with the same version, and its head is its newest
    build. The last run of a version is everything up to the oldest of its heads.

    Neighbours are found without sorting a whole channel in one task: inside each build day, and
    for the newest build of a day through one row per day, of which there are only as many as the
    calendar has.
    """
    if keep_all_runs:
        return triplets
    day = F.substring("build_id", 1, 8).alias("day")
    in_day = W.partitionBy("channel", "day").orderBy(F.desc("build_id"))
    days = W.partitionBy("channel").orderBy(F.desc("day"))

    builds = triplets.select("*", day)
    newer_days = (
        builds.groupBy("channel", "day")
        .agg(F.min_by("version", "build_id").alias("oldest"))
        .select("channel", "day", F.lag("oldest").over(days).alias("newer_day"))
    )
    newer = F.coalesce(F.lag("version").over(in_day), F.col("newer_day"))
    heads = (
        join_back(builds, newer_days, ["channel", "day"])
        .withColumn("newer", newer)
        .where(F.col("newer").isNull() | (F.col("newer") != F.col("version")))
        .groupBy("channel", "version")
        .agg(F.min("build_id").alias("last_head"))
    )
    return (
        join_back(triplets, heads, ["channel", "version"])
        .where(F.col("build_id") <= F.col("last_head"))
        .select("channel", "version", "build_id", "pub_ms")
    )


def channel_builds(
    records: DataFrame,
    min_build: str,
    channels: Sequence[str] = ("release", "beta", "aurora"),
    product: str | None = None,
    wanted_major: V.MajorSpec = None,
    keep_rc_on: Sequence[str] = ("aurora",),
    keep_release: bool = True,
    keep_all_runs: bool = False,
    choose: Choice = smallest_text,
) -> DataFrame:
    """Builds as (version, build_id, date, chan), all channels from one read of the registry."""
    registry = build_registry(records, min_build, channels, product)
    triplets = registry_triplets(registry, wanted_major, F.col("channel").isin(*keep_rc_on), keep_release, choose)
    return last_runs(triplets, keep_all_runs).select(
        "version",
        "build_id",
        epoch_ms(F.col("pub_ms"), whole_seconds=True).alias("date"),
        F.col("channel").alias("chan"),
    )


def of_channel(builds: DataFrame, channel: str) -> DataFrame:
    """One channel's builds. Release builds get the major number of plain major releases."""
    chosen = builds.where(F.col("chan") == channel)
    if channel != "release":
        return chosen
    number = V.release_major(F.col("version"))
    return chosen.withColumns({"major": number, "is_major": number.isNotNull()})


def recent_builds(
    records: DataFrame,
    channel: str,
    as_of: dt.date | str,
    wanted_major: V.MajorSpec = None,
    product: str | None = None,
    window_days: int = config.REGISTRY_WINDOW_DAYS,
) -> DataFrame:
    """Builds of any channel in the months before ``as_of``."""
    min_build = days_before(as_of, window_days).strftime("%Y%m%d")
    return channel_builds(records, min_build, [channel], product, wanted_major)


def label_rc_builds(builds: DataFrame) -> DataFrame:
    """Builds with release candidates told apart by build id."""
    version, build_id = F.col("version"), F.col("build_id")
    return builds.withColumns(
        {
            "rc_major": V.rc_major(version),
            "is_rc": V.rc_major(version).isNotNull(),
            "label": V.rc_label(version, build_id),
        }
    )


def version_build_list(builds: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Each version with its quoted build ids, newest first, as one comma list; per ``keys``, such as the channel."""
    quoted = F.transform(
        F.reverse(F.array_sort(F.collect_list("build_id"))),
        lambda b: F.concat(F.lit("'"), b, F.lit("'")),
    )
    return builds.groupBy(*keys, "version").agg(F.array_join(quoted, ", ").alias("build_ids"))

