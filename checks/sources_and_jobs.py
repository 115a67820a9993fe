"""Registered queries: sources, sinks and jobs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registered import check
from checks.sql import OSES, PUB_TEXT, RELEASE_MAJOR, nearest_day
from tidemark import schemas
from tidemark.functions import dates as D
from tidemark.functions.builds import build_day, nearest_build_day
from tidemark.operators import quality
from tidemark.plans import jobs
from tidemark.plans.counts import version_counts
from tidemark.plans.curves import adoption_curves
from tidemark.session import scratch_path
from tidemark.sources import registry, sinks, tables

CHANNELS = ["release", "esr", "beta", "aurora", "nightly"]
CURVE_COLUMNS = ", ".join(schemas.CURVES.fieldNames())


@check("src_fact_scan", f"""
SELECT submission_date, app_name, os, normalized_channel, sample_id, app_version, app_display_version, app_build_id
FROM clients WHERE app_name = 'desktop' AND os IN {OSES}
  AND submission_date BETWEEN DATE '2024-01-05' AND DATE '2024-01-20'
""")
def _(spark, sf_dir):
    return tables.scan_clients(fx.stored_clients(spark, sf_dir), "2024-01-05", "2024-01-20", fx.APP).drop("channel")


def _flat_registry(df: DataFrame) -> DataFrame:
    return df.select(
        "channel",
        "build_id",
        F.array_join("versions", "|").alias("versions"),
        F.size("pub_dates").alias("n_dates"),
        F.array_min("pub_dates").alias("first_ms"),
    )


@check("src_build_registry", """
SELECT channel, build_id, array_to_string(versions, '|') AS versions, CAST(len(pub_dates) AS INTEGER) AS n_dates,
  CAST(list_min(pub_dates) AS BIGINT) AS first_ms
FROM registry WHERE build_id >= '2023'
""")
def _(spark, sf_dir):
    records = fx.registry_records(spark, sf_dir)
    return _flat_registry(registry.build_registry(records, "2023", CHANNELS, fx.APP))


@check("src_build_registry_json", """
SELECT channel, build_id, array_to_string(versions, '|') AS versions, CAST(len(pub_dates) AS INTEGER) AS n_dates,
  CAST(list_min(pub_dates) AS BIGINT) AS first_ms
FROM registry WHERE channel = 'beta'
""")
def _(spark, sf_dir):
    """The bucket form of the registry, written as JSON lines and read back with its schema."""
    flat = registry.build_registry(fx.registry_records(spark, sf_dir), "2015", ["beta"], fx.APP)
    bucket = lambda values: F.struct(F.transform(values, lambda v: F.struct(v.alias("key"))).alias("buckets"))
    path = scratch_path(spark, "registry")
    flat.select(
        bucket(F.col("versions")).alias("version"),
        bucket(F.col("pub_dates")).alias("pub_date"),
        bucket(F.array("build_id")).alias("buildid"),
    ).write.json(path)
    return _flat_registry(registry.read_registry_dump(spark, path, "beta"))


@check("src_product_releases", "SELECT release_label, date, category, version FROM releases")
def _(spark, sf_dir):
    return fx.product_releases(spark, sf_dir).select("release_label", "date", "category", "version")


@check("src_channel_builds", f"""
SELECT version, build_id, {PUB_TEXT} AS date, channel AS chan, NULL::INTEGER AS major, NULL::BOOLEAN AS is_major
FROM norc_builds WHERE channel = 'beta'
UNION ALL SELECT version, build_id, {PUB_TEXT}, channel, NULL, NULL FROM any_builds WHERE channel = 'aurora'
UNION ALL SELECT version, build_id, {PUB_TEXT}, channel, {RELEASE_MAJOR}, {RELEASE_MAJOR} IS NOT NULL
FROM norc_builds WHERE channel = 'release'
""")
def _(spark, sf_dir):
    every = registry.channel_builds(fx.registry_records(spark, sf_dir), fx.REGISTRY_FROM, product=fx.APP)
    release = registry.of_channel(every, "release")
    others = every.where("chan <> 'release'")
    builds = release.unionByName(others, allowMissingColumns=True)
    return builds.withColumn("date", F.col("date").cast("string"))


@check("src_channel_builds_recent", f"""
SELECT version, build_id, {PUB_TEXT} AS date, channel AS chan FROM recent_builds WHERE channel = 'release'
""")
def _(spark, sf_dir):
    records = fx.registry_records(spark, sf_dir)
    builds = registry.recent_builds(records, "release", "2024-12-20", product=fx.APP)
    return builds.withColumn("date", F.col("date").cast("string"))


@check("src_major_releases", """
SELECT date, version, TRY_CAST(version AS INTEGER) AS vers FROM majors WHERE date > DATE '2018-01-01'
""")
def _(spark, sf_dir):
    return fx.major_list(spark, sf_dir, "2018-01-01")


@check("src_counts_read", """
SELECT * FROM counts WHERE submission_date BETWEEN DATE '2024-12-10' - 330 AND DATE '2024-12-10'
""")
def _(spark, sf_dir):
    return tables.read_counts(fx.counts(spark, sf_dir), "2024-12-10")


@check("src_mart_read", f"""
SELECT {CURVE_COLUMNS} FROM curves WHERE channel = 'release' AND submission_date < DATE '2024-01-25'
""")
def _(spark, sf_dir):
    return tables.read_curves(fx.curves(spark, sf_dir), "2024-01-25", ["release"])


def _stored_counts(spark: SparkSession, sf_dir: str, first: str = fx.FIRST, last: str = fx.LAST) -> str:
    path = scratch_path(spark, "counts")
    sinks.append_counts(version_counts(fx.clients(spark, sf_dir), first, last, fx.APP), path)
    return path


def _count_columns(df: DataFrame) -> DataFrame:
    return df.select(*schemas.VERSION_COUNTS.fieldNames())


@check("src_version_counts_all", "SELECT * FROM counts")
def _(spark, sf_dir):
    return fx.counts(spark, sf_dir)


@check("sink_counts_append", "SELECT * FROM counts")
def _(spark, sf_dir):
    path = _stored_counts(spark, sf_dir, last="2024-01-20")
    sinks.append_counts(version_counts(fx.clients(spark, sf_dir), "2024-01-21", fx.LAST, fx.APP), path)
    return _count_columns(tables.read_table(spark, path))


@check("sink_counts_csv", """
SELECT submission_date, chan, os, dvers, nullif(vers, 'other') AS vers, bid, n FROM counts
""")
def _(spark, sf_dir):
    path = scratch_path(spark, "csv")
    counts = fx.counts(spark, sf_dir).withColumn("vers", F.nullif("vers", F.lit("other")))
    sinks.export_csv(counts, path)
    return sinks.import_csv(spark, path)


@check("sink_drop_first", "SELECT * FROM counts WHERE submission_date <= DATE '2024-01-10'")
def _(spark, sf_dir):
    path = _stored_counts(spark, sf_dir)
    sinks.replace_counts(version_counts(fx.clients(spark, sf_dir), fx.FIRST, "2024-01-10", fx.APP), path)
    return _count_columns(tables.read_table(spark, path))


@check("sink_mart_append_new", f"""
SELECT {CURVE_COLUMNS} FROM curves20
UNION ALL SELECT {CURVE_COLUMNS} FROM curves WHERE submission_date > DATE '2024-01-20'
""")
def _(spark, sf_dir):
    counts = fx.counts(spark, sf_dir)
    target = scratch_path(spark, "curves")
    jobs.run_curves(counts, target, "2024-01-20", target_exists=False)
    for _ in range(2):  # the second run finds nothing new
        jobs.run_curves(counts, target, fx.LAST)
    return tables.read_table(spark, target).select(*schemas.CURVES.fieldNames())


@check("sink_chart_feed", """
SELECT channel, os, vers, submission_date, n, n_pct, build_ids, show_n, version, week_day, days_after_release, release_day
FROM shown
""")
def _(spark, sf_dir):
    """The current copy after a second run: nothing of the first, which showed other rows, is left."""
    target = scratch_path(spark, "feed")
    curves = fx.curves(spark, sf_dir)
    jobs.run_serve(curves, target, "2024-01-20")
    jobs.run_serve(curves.where("channel <> 'beta'"), target, fx.DISPLAY_BEFORE)
    jobs.run_serve(curves, target, fx.DISPLAY_BEFORE)
    return sinks.read_chart_feed(spark, target)


@check("job_increment", "SELECT * FROM counts")
def _(spark, sf_dir):
    clients, path = fx.clients(spark, sf_dir), scratch_path(spark, "counts")
    jobs.run_counts(clients, path, "2024-01-21", first=fx.FIRST, target_exists=False, app_name=fx.APP)
    for _ in range(2):  # loads the last ten days, then finds nothing missing
        jobs.run_counts(clients, path, "2024-01-31", app_name=fx.APP)
    return _count_columns(tables.read_table(spark, path))


_BACKFILL_SQL = f"""
WITH runs AS (SELECT CAST(unnest(range(DATE '2024-01-21', DATE '2024-01-31', INTERVAL 1 DAY)) AS DATE) AS as_of),
seen AS (SELECT a.as_of, c.* FROM runs a JOIN curves_unified c ON c.submission_date <= a.as_of),
r AS (SELECT as_of, channel, os, vers, submission_date, string_agg(bid, chr(10) ORDER BY bid) AS build_ids,
    min(bid) AS min_build_id, max(bid) AS max_bid, CAST(sum(n) AS BIGINT) AS n FROM seen GROUP BY ALL),
d AS (SELECT as_of, channel, os, submission_date, CAST(sum(n) AS BIGINT) AS total FROM seen GROUP BY ALL),
w AS (SELECT DISTINCT ON (as_of, channel, os) as_of, channel, os, vers AS newest FROM r
  ORDER BY as_of, channel, os, max_bid DESC, vers DESC),
t AS (SELECT DISTINCT ON (as_of, channel, os, vers) as_of, channel, os, vers, dvers AS top_dvers FROM seen
  ORDER BY as_of, channel, os, vers, n DESC, dvers),
s AS (SELECT r.*, d.total, r.n / d.total AS n_pct, w.newest, t.top_dvers,
    min(CASE WHEN r.n / d.total > 0.01 THEN submission_date END) OVER v AS first_day,
    min(submission_date) OVER v AS earliest
  FROM r JOIN d USING (as_of, channel, os, submission_date) JOIN w USING (as_of, channel, os)
    JOIN t USING (as_of, channel, os, vers) WINDOW v AS (PARTITION BY as_of, channel, os, vers))
SELECT {CURVE_COLUMNS} FROM curves20
UNION ALL SELECT vers, submission_date, build_ids, min_build_id, n, total, total, n_pct, vers = newest,
  length(build_ids) <= 8, first_day,
  CAST(submission_date - first_day + CASE WHEN earliest - first_day = -1 THEN 1 ELSE 0 END AS INTEGER),
  os, channel, channel = 'release' AND length(vers) - length(replace(vers, '.', '')) = 1,
  channel = 'beta' AND NOT contains(vers, 'b'), CASE WHEN channel = 'nightly' THEN top_dvers END
FROM s WHERE submission_date = as_of
"""


@check("job_backfill", _BACKFILL_SQL)
def _(spark, sf_dir):
    target = scratch_path(spark, "curves")
    jobs.run_backfill(fx.counts(spark, sf_dir), target, "2024-01-20", fx.LAST)
    return tables.read_table(spark, target).select(*schemas.CURVES.fieldNames())


@check("job_version_dim", f"""
WITH v AS (
  SELECT vers AS version FROM counts UNION SELECT dvers FROM counts
  UNION SELECT version FROM every_build UNION SELECT version FROM releases
)
SELECT version, length(version) - length(replace(version, '.', '')) = 1 AS is_major, NOT contains(version, 'b') AS is_rc,
  CASE WHEN contains(version, 'rc') THEN NULL WHEN contains(version, 'b') THEN split_part(version, 'b', 1) || 'b'
    || lpad(split_part(version, 'b', 2), CAST(greatest(2, length(split_part(version, 'b', 2))) AS INTEGER), '0') ELSE version END AS sortable,
  TRY_CAST(split_part(version, '.', 1) AS INTEGER) AS major,
  {RELEASE_MAJOR} AS release_major,
  TRY_CAST(nullif(regexp_extract(version, '^(\\d\\d+)(\\.\\d)+$', 1), '') AS INTEGER) AS rc_major
FROM v WHERE version IS NOT NULL
""")
def _(spark, sf_dir):
    counts = fx.counts(spark, sf_dir)
    return jobs.version_dimension(
        counts.select(F.col("vers").alias("version")),
        counts.select(F.col("dvers").alias("version")),
        fx.builds(spark, sf_dir),
        fx.product_releases(spark, sf_dir),
    )


@check("job_build_dim", f"""
SELECT channel AS chan, version, build_id, strftime(epoch_ms(pub_ms), '%Y-%m-%d %H:%M:%S') AS published,
  CAST(strptime(substr(build_id, 1, 8), '%Y%m%d') AS DATE) AS build_day,
  {nearest_day('build_id')} AS nearest_day,
  CAST(DATE '2024-01-30' - CAST(epoch_ms(pub_ms) AS DATE) AS INTEGER) AS days_since,
  strftime(CAST(epoch_ms(pub_ms) AS DATE) - 90, '%Y%m%d') AS build_bound,
  strftime(CAST(epoch_ms(pub_ms) AS DATE) - 330, '%Y-%m-%d') AS date_bound,
  strftime(epoch_ms(pub_ms), '%Y-%m-%d') AS sql_date,
  CASE WHEN channel = 'beta' AND regexp_matches(version, '^\\d\\d+(\\.\\d)+$')
    THEN regexp_extract(version, '^(\\d\\d+)(\\.\\d)+$', 1) || 'rc' || build_id ELSE version END AS label
FROM every_build
""")
def _(spark, sf_dir):
    """Registry builds with every date column derived from them. Only beta has candidates that go by their build."""
    builds = registry.label_rc_builds(fx.builds(spark, sf_dir))
    builds = builds.withColumn("label", F.when(F.col("chan") == "beta", F.col("label")).otherwise(F.col("version")))
    day = F.col("date").cast("date")
    return builds.select(
        "chan",
        "version",
        "build_id",
        F.col("date").cast("string").alias("published"),
        build_day(F.col("build_id")).alias("build_day"),
        nearest_build_day(F.col("build_id")).alias("nearest_day"),
        D.days_since(F.lit(D.as_date(fx.LAST)), day).alias("days_since"),
        D.days_ago(day, 90).alias("build_bound"),
        D.days_ago(day, 330, compact=False).alias("date_bound"),
        D.sql_date(F.col("date")).alias("sql_date"),
        "label",
    )


@check("job_curves", f"SELECT {CURVE_COLUMNS} FROM curves")
def _(spark, sf_dir):
    return adoption_curves(fx.counts(spark, sf_dir), fx.LAST)


def _text_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = fx.counts(spark, sf_dir)
    text = counts.select(*[F.col(c).cast("string").alias(c) for c in counts.columns])
    return text.withColumn("n", F.when(F.col("dvers") == "other", F.concat(F.col("n"), F.lit(" clients"))).otherwise(F.col("n")))


@check("schema_map", """
SELECT submission_date, chan, os, dvers, vers, bid, CASE WHEN dvers IS DISTINCT FROM 'other' THEN CAST(n AS INTEGER) END AS n FROM counts
""")
def _(spark, sf_dir):
    return quality.conform(_text_counts(spark, sf_dir), schemas.VERSION_COUNTS, {"n": T.IntegerType()}, strict=False)


@check("schema_map_lost", """
SELECT 'n' AS column_name, count(*) AS n_lost FROM counts WHERE dvers = 'other' HAVING count(*) > 0
""")
def _(spark, sf_dir):
    return quality.lost_casts(_text_counts(spark, sf_dir), schemas.VERSION_COUNTS)
