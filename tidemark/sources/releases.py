"""Release dates: published release lists (JSON maps) joined up with the build registry."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import config, schemas
from tidemark.functions import versions as V
from tidemark.functions.dates import as_date

Day = dt.date | str


FAIL_FAST = {"mode": "FAILFAST"}


def strict_date(text: Column) -> Column:
    """The date of a ``yyyy-MM-dd`` text. Any other text fails the job; NULL stays NULL."""
    day = F.try_to_date(text, "yyyy-MM-dd")
    return F.when(text.isNotNull() & day.isNull(), F.raise_error(F.concat(F.lit("not a date: "), text))).otherwise(day)


def unreadable_documents(documents: DataFrame, schema: T.DataType, day: str, json: str = "json") -> DataFrame:
    """(document, label, problem): documents that are no JSON map of the schema, and entries without a readable date.

    ``day`` is the field of an entry that holds its date; empty if the entry is the date.
    """
    text = F.col(json)
    parsed = documents.select(text.alias("document"), F.from_json(text, schema).alias("entries"))
    whole = F.col("entries").isNotNull() & F.forall(F.map_values("entries"), lambda e: e.isNotNull())
    broken = parsed.where(~F.coalesce(whole, F.lit(False))).select("document", F.lit(None).cast("string").alias("label"), F.lit("document").alias("problem"))
    entries = parsed.where(whole).select("document", F.explode("entries").alias("label", "entry"))
    date = F.col(f"entry.{day}") if day else F.col("entry")
    undated = entries.where(F.try_to_date(date, "yyyy-MM-dd").isNull())
    return broken.unionByName(undated.select("document", "label", F.lit("date").alias("problem")))


def product_releases(documents: DataFrame, json: str = "json") -> DataFrame:
    """One row per release label from documents that map labels to release records.

    A document that cannot be read, or a date that is none, fails the job; ``unreadable_documents`` lists them.
    """
    entries = documents.select(
        F.explode(F.from_json(F.col(json), schemas.PRODUCT_RELEASES, FAIL_FAST)).alias("release_label", "release")
    )
    return entries.select("release_label", "release.*").withColumn("date", strict_date(F.col("date")))


def major_releases(
    documents: DataFrame, after: Day = "2018-01-01", json: str = "json", strict: bool = True
) -> DataFrame:
    """(date, version, vers) of major releases after a date, ``vers`` as an integer.

    Text that is not a whole number fails the job, as do unreadable documents and dates. With ``strict`` off
    it gives NULL, for ``quality.non_integer_majors`` to list.
    """
    entries = documents.select(
        F.explode(F.from_json(F.col(json), schemas.MAJOR_RELEASES, FAIL_FAST)).alias("version", "day")
    )
    number = F.col("version").try_cast("double")
    whole = F.when(number == F.floor(number), number.cast("int"))
    if strict:
        said = F.concat(F.lit("not a whole number: "), F.col("version"))
        whole = F.coalesce(whole, F.raise_error(said).cast("int"))
    return entries.select(
        strict_date(F.col("day")).alias("date"), "version", whole.alias("vers")
    ).where(F.col("date") > as_date(after))


def tracked_release(date: Column, category: Column, label: Column, after: Day = "2019-01-01") -> Column:
    """Major and stability releases after a date, extended support left out."""
    return (
        (date > as_date(after))
        & category.isin(*config.RELEASE_CATEGORIES)
        & ~label.endswith(config.ESR_SUFFIX)
    )


def release_rows(releases: DataFrame, after: Day = "2019-01-01") -> DataFrame:
    return releases.where(tracked_release(F.col("date"), F.col("category"), F.col("release_label"), after))


def first_rc_builds(beta_builds: DataFrame) -> DataFrame:
    """Earliest build of each release candidate on the beta channel."""
    return (
        beta_builds.where(V.is_rc(F.col("version")))
        .groupBy("version")
        .agg(F.min("date").cast("date").alias("date"))
    )


def beta_release_dates(
    releases: DataFrame,
    beta_builds: DataFrame,
    after: Day = "2019-01-01",
    release_src: str = "releases",
    registry_src: str = "registry",
) -> DataFrame:
    """(date, version, src, maj_vers): development releases together with first RC builds."""
    dev = releases.where((F.col("category") == config.DEV_CATEGORY) & (F.col("date") > as_date(after))).select(
        "date", "version", F.lit(release_src).alias("src")
    )
    rc = first_rc_builds(beta_builds).select("date", "version", F.lit(registry_src).alias("src"))
    return dev.unionByName(rc).withColumn("maj_vers", V.major(F.col("version"), strict=True))


def latest_releases(release_dates: DataFrame, before: Day, n: int = 1) -> DataFrame:
    """The last ``n`` releases strictly before a date, oldest first."""
    newest = (
        release_dates.where(F.col("date") < as_date(before))
        .orderBy(F.desc("date"), F.desc("version"), F.desc("src"))
        .limit(n)
    )
    return newest.orderBy("date", "version", "src")


def current_major(majors: DataFrame) -> DataFrame:
    """Major number of the latest release, as a one-row frame."""
    latest = F.max_by("version", F.struct("date", "version"))
    return majors.agg(V.major(latest).alias("current_major"))


def channel_release_dates(releases: DataFrame, beta_dates: DataFrame, aurora_builds: DataFrame) -> DataFrame:
    """(chan, version, date, ordinal) lookup for the channels that have published dates.

    When a version occurs twice the row with the greatest ordinal wins. Ordinals are dates for
    beta and aurora, whose lists run in date order, and labels for release.
    """
    release = release_rows(releases).select(
        F.lit("release").alias("chan"), "version", "date", F.col("release_label").alias("ordinal")
    )
    beta = beta_dates.select(F.lit("beta").alias("chan"), "version", "date", F.col("date").cast("string").alias("ordinal"))
    aurora = aurora_builds.select(
        F.lit("aurora").alias("chan"),
        "version",
        F.col("date").cast("date").alias("date"),
        F.col("date").cast("string").alias("ordinal"),
    )
    return release.unionByName(beta).unionByName(aurora)
