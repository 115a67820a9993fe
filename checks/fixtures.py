"""Entities of the pipeline as views over the given tables: one line item is one client day.

The jobs hand over through tables, and so do these: the registry, the release lists, the counts and
the curves are written once per session and folder, and later steps read what was written.
"""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark import config, schemas
from tidemark.plans import jobs
from tidemark.plans.counts import version_counts
from tidemark.session import scratch_path
from tidemark.sources import registry, releases, sinks

APP = "desktop"
FIRST, LAST = "2024-01-01", "2024-01-30"
REGISTRY_FROM = "2023"
#: Channels times systems, and those times the days: how many groups there can be.
SERIES = len(config.SAMPLE_BOUNDS) * len(config.OSES)
DAY_GROUPS = 30 * SERIES
DISPLAY_BEFORE = "2024-01-31"

#: Numbers go through the join; texts are made from them behind it, and channels are told apart by number.
CLIENTS_SQL = """
WITH items AS (
  SELECT l_orderkey, l_linenumber, l_partkey, CAST(l_suppkey % 8 AS INT) AS supplier,
    CAST((l_orderkey * 7 + l_linenumber * 3) % 30 AS INT) AS d,
    CAST(l_quantity AS INT) % 4 AS lag
  FROM {lineitem}
), channels AS (
  SELECT o_orderkey,
    CASE o_orderpriority WHEN '1-URGENT' THEN 1 WHEN '2-HIGH' THEN 2
      WHEN '3-MEDIUM' THEN 3 WHEN '4-NOT SPECIFIED' THEN 4 ELSE 5 END AS priority
  FROM {orders}
), cycles AS (
  SELECT *, 70 + (d - lag + 6) DIV 6 AS vnum, (d - lag + 6) % 6 AS cyc
  FROM items JOIN channels ON l_orderkey = o_orderkey
), versions AS (
  SELECT *,
    CASE priority WHEN 1 THEN 'release' WHEN 2 THEN 'beta'
      WHEN 3 THEN 'nightly' WHEN 4 THEN 'aurora' ELSE 'esr' END AS chan,
    CASE WHEN l_partkey % 10 < 7 THEN 'Windows_NT' WHEN l_partkey % 10 = 7 THEN 'Darwin'
      WHEN l_partkey % 10 = 8 THEN 'Linux' WHEN l_partkey % 20 = 9 THEN 'Android' END AS os,
    CASE supplier WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 25 WHEN 3 THEN 26
      WHEN 4 THEN 50 WHEN 5 THEN 51 WHEN 6 THEN 75 ELSE 1 END AS sample_id,
    CASE WHEN l_partkey % 97 = 0 THEN concat('60.0.', CAST(l_partkey % 7 AS STRING))
      WHEN priority = 1 AND cyc >= 3 THEN concat(CAST(vnum AS STRING), '.0.1')
      WHEN priority = 3 THEN concat(CAST(vnum AS STRING), '.0a1')
      ELSE concat(CAST(vnum AS STRING), '.0') END AS app_version,
    CASE priority WHEN 3 THEN d - lag
      WHEN 1 THEN 6 * (vnum - 71) - 2 + (CASE WHEN cyc < 3 THEN 0 ELSE 3 END)
      WHEN 5 THEN 6 * (vnum - 71) - 40
      ELSE 6 * (vnum - 71) + cyc - CASE WHEN l_partkey % 83 = 0 THEN 0 ELSE 1 END END AS build_offset
  FROM cycles
), dated AS (
  SELECT *, date_add(DATE '2024-01-01', CAST(build_offset AS INT)) AS build_date FROM versions
)
SELECT
  date_add(DATE '2024-01-01', d) AS submission_date,
  'desktop' AS app_name,
  os,
  chan AS normalized_channel,
  chan AS channel,
  sample_id,
  app_version,
  CASE WHEN l_partkey % 73 = 0 THEN NULL
    WHEN priority IN (2, 4) AND cyc < 5
    THEN concat(CAST(vnum AS STRING), '.0b', CAST(cyc + 1 AS STRING)) ELSE app_version END AS app_display_version,
  CASE WHEN l_partkey % 79 = 0 THEN NULL
    WHEN l_partkey % 89 = 0 THEN '20150101000000'
    WHEN l_partkey % 97 = 0 AND priority = 1 THEN '20171110100000'
    ELSE concat(CAST(year(build_date) * 10000 + month(build_date) * 100 + day(build_date) AS STRING),
      CASE pmod(build_offset, 4) WHEN 0 THEN '100000' WHEN 3 THEN '183000' ELSE '120000' END)
  END AS app_build_id,
  l_linenumber AS shard
FROM dated
"""


def clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``clients_daily``: channel, system, version and build of one client on one day."""
    paths = {name: spark.read.parquet(f"{sf_dir}/{name}.parquet") for name in ("lineitem", "orders")}
    return spark.sql(CLIENTS_SQL, **paths)


def stored_clients(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The client days as a job finds them: a table partitioned by date."""
    columns = schemas.CLIENTS_DAILY.fieldNames()
    path = stored(spark, sf_dir, "clients", lambda p: sinks.load_clients(clients(spark, sf_dir).select(*columns), p))
    return spark.read.parquet(path).select(*columns)


_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark: SparkSession, sf_dir: str, name: str, write: Callable[[str], None]) -> str:
    """Path of a table derived from ``sf_dir``, written on first use."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _STORED:
        path = scratch_path(spark, name)
        write(path)
        _STORED[key] = path
    return _STORED[key]


def fresh_counts(spark: SparkSession, sf_dir: str, **options) -> DataFrame:
    """The counts of all days, computed from the client days."""
    return version_counts(clients(spark, sf_dir), FIRST, LAST, APP, **options)


def counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored counts table."""
    path = stored(spark, sf_dir, "counts", lambda p: sinks.append_counts(fresh_counts(spark, sf_dir), p))
    return spark.read.parquet(path).select(*schemas.VERSION_COUNTS.fieldNames())


def test_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts with a smaller beta sample: the table to compare with."""
    bounds = config.SAMPLE_BOUNDS | {"beta": (None, 25)}
    write = lambda p: sinks.append_counts(fresh_counts(spark, sf_dir, bounds=bounds), p)
    path = stored(spark, sf_dir, "test_counts", write)
    return spark.read.parquet(path).select(*schemas.VERSION_COUNTS.fieldNames())


def curves(spark: SparkSession, sf_dir: str, as_of: str = LAST) -> DataFrame:
    """The stored curve table of a run as of a date."""
    write = lambda p: jobs.run_curves(counts(spark, sf_dir), p, as_of, target_exists=False)
    path = stored(spark, sf_dir, f"curves-{as_of}", write)
    return spark.read.parquet(path).select(*schemas.CURVES.fieldNames())


def builds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored build dimension of the release, beta and aurora channels."""
    build = lambda p: registry.channel_builds(registry_records(spark, sf_dir), REGISTRY_FROM, product=APP).write.parquet(p)
    return spark.read.parquet(stored(spark, sf_dir, "builds", build))


def product_releases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product releases parsed from the stored JSON documents."""
    path = stored(spark, sf_dir, "releases", lambda p: release_documents(spark, sf_dir).write.text(p))
    return releases.product_releases(spark.read.text(path), "value")


def major_list(spark: SparkSession, sf_dir: str, after: str) -> DataFrame:
    path = stored(spark, sf_dir, "majors", lambda p: major_documents(spark, sf_dir).write.text(p))
    return releases.major_releases(spark.read.text(path), after, "value", strict=False)


def registry_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored flat build registry."""
    path = stored(spark, sf_dir, "registry", lambda p: _registry_records(spark, sf_dir).write.parquet(p))
    return spark.read.schema(schemas.REGISTRY_RECORDS).parquet(path)


def release_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Development releases together with the first release-candidate builds."""
    beta = registry.of_channel(builds(spark, sf_dir), "beta")
    return releases.beta_release_dates(product_releases(spark, sf_dir), beta)


def date_lookup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored table of release dates by channel and version."""
    def write(path: str) -> None:
        aurora = registry.of_channel(builds(spark, sf_dir), "aurora")
        dates = releases.channel_release_dates(product_releases(spark, sf_dir), release_dates(spark, sf_dir), aurora)
        dates.write.parquet(path)

    return spark.read.parquet(stored(spark, sf_dir, "date-lookup", write))


def _registry_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A flat build registry: one record per build, version, platform, locale and time.

    Client days are reduced to what they differ in first, so that days are parsed and versions matched once for each such row.
    They are counted for that: Spark takes a plain distinct below another one away. Every group has days, so none is left out.
    """
    seen = clients(spark, sf_dir).groupBy("app_build_id", "app_display_version", "shard", "os", "normalized_channel")
    seen = seen.agg(F.count("*").alias("days")).where("days > 0")
    build_day = F.to_date(F.substring("app_build_id", 1, 8), "yyyyMMdd")
    published = F.unix_date(build_day).cast("long") * 86_400_000 + (10 + F.col("shard") % 3) * 3_600_000 + F.col("shard") * 7
    platform = F.when(F.col("os") == "Windows_NT", "win64").when(F.col("os") == "Darwin", "macosx64").otherwise("linux64")
    # Beta releases of the fourth line are also published as candidates, an aurora release as nothing else.
    chan, version = F.col("normalized_channel"), F.col("app_display_version")
    candidate = F.concat(version, F.lit("b6rc"))
    also = (chan == "beta") & version.rlike(r"^\d+\.0$") & (F.col("shard") == 4)
    version = F.when(also | ((chan == "aurora") & (version == "73.0")), candidate).otherwise(version)
    return seen.select(
        F.col("app_build_id").alias("build_id"),
        version.alias("version"),
        published.alias("pub_ms"),
        platform.alias("platform"),
        F.when(F.col("shard") <= 5, "en-US").otherwise("de").alias("locale"),
        F.col("normalized_channel").alias("channel"),
        F.lit(APP).alias("product"),
    ).distinct()


def _release_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(chan, version, day): first build day of the release, beta and esr versions."""
    c = clients(spark, sf_dir)
    chan = F.col("normalized_channel")
    version = F.when(chan == "beta", F.col("app_display_version")).otherwise(F.col("app_version"))
    day = F.to_date(F.substring("app_build_id", 1, 8), "yyyyMMdd")
    current = F.when(F.col("app_build_id") > "2016", day)
    return (
        c.where(chan.isin("release", "beta", "esr"))
        .select(chan.alias("chan"), version.alias("version"), current.alias("day"))
        .groupBy("chan", "version")
        .agg(F.min("day").alias("day"))
        .select(
            "chan",
            "version",
            F.when(F.col("version").startswith("60."), F.lit("2017-11-14"))
            .otherwise(F.coalesce(F.col("day").cast("string"), F.lit("2015-01-01")))
            .alias("day"),
        )
    )


def release_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON maps from release label to release record, one document per channel and major version."""
    rows = _release_list(spark, sf_dir).where((F.col("chan") != "beta") | F.col("version").contains("b"))
    suffix = F.when(F.col("chan") == "esr", "esr").otherwise("")
    dots = F.length("version") - F.length(F.replace("version", F.lit("."), F.lit("")))
    category = F.when(F.col("chan") == "beta", "dev").when(dots == 1, "major").otherwise("stability")
    record = F.struct(F.col("day").alias("date"), category.alias("category"), "version", F.lit(APP).alias("product"))
    label = F.concat(F.lit("app-"), "version", suffix)
    major = F.split_part("version", F.lit("."), F.lit(1))
    return (
        rows.groupBy("chan", major.alias("major"))
        .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(label, record)))).alias("json"))
        .select("json")
    )


def major_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """JSON maps from version to date: plain majors as ``71``, others as they are."""
    rows = _release_list(spark, sf_dir).where("chan = 'release'")
    version = F.when(F.col("version").rlike(r"^\d+\.0$"), F.split_part("version", F.lit("."), F.lit(1))).otherwise(F.col("version"))
    rows = rows.where(F.col("version").rlike(r"^\d+\.0$") | F.col("version").startswith("60."))
    return (
        rows.groupBy(F.split_part("version", F.lit("."), F.lit(1)).alias("major"))
        .agg(F.to_json(F.map_from_entries(F.collect_list(F.struct(version, "day")))).alias("json"))
        .select("json")
    )
