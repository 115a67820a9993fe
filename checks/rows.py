"""Registered queries: filters, projections and set operations."""

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registered import check
from checks.sql import OSES, floored, lag_days, min_build, unified
from tidemark.functions import versions as V
from tidemark.functions.builds import build_lag_days, clamp_nightly_day, is_old_build, min_build_id
from tidemark.operators import filters
from tidemark.plans import counts as C
from tidemark.plans import curves as K
from tidemark.plans import serve
from tidemark.sources import registry, releases, tables

CLIENT_COLUMNS = ["submission_date", "os", "normalized_channel", "sample_id", "app_version", "app_display_version", "app_build_id"]


def scanned(spark, sf_dir):
    return tables.scan_clients(fx.clients(spark, sf_dir), fx.FIRST, fx.LAST, fx.APP)


def sampled(spark, sf_dir):
    return filters.stratified_sample(scanned(spark, sf_dir))


@check("flt_stratified_sample", f"SELECT {', '.join(CLIENT_COLUMNS)} FROM sampled")
def _(spark, sf_dir):
    return sampled(spark, sf_dir).select(*CLIENT_COLUMNS)


@check("set_union_samples", " UNION ALL ".join(
    f"SELECT {', '.join(CLIENT_COLUMNS)} FROM clients WHERE app_name = 'desktop' AND os IN {OSES} AND {rule}"
    for rule in (
        "normalized_channel = 'release' AND sample_id = 1",
        "normalized_channel = 'esr' AND sample_id <= 25",
        "normalized_channel = 'beta' AND sample_id <= 50",
        "normalized_channel IN ('aurora', 'nightly')",
    )
))
def _(spark, sf_dir):
    """The union of the channel samples, read in one pass."""
    return sampled(spark, sf_dir).select(*CLIENT_COLUMNS)


WINDOWS = [("2024-01-02", "2024-01-05"), ("2024-01-08", "2024-01-12"), ("2024-01-15", "2024-01-20"), ("2024-01-25", "2024-01-27")]
WINDOW_SQL = f"""
  sample_id = 1 AND os = 'Windows_NT' AND channel = 'release' AND app_name = 'desktop' AND app_build_id >= '20231215'
  AND ({' OR '.join(f"submission_date BETWEEN DATE '{a}' AND DATE '{b}'" for a, b in WINDOWS)})
"""


def windowed(spark, sf_dir):
    return filters.fixed_windows(fx.clients(spark, sf_dir), WINDOWS, "20231215", app_name=fx.APP)


@check("flt_fixed_windows", f"SELECT {', '.join(CLIENT_COLUMNS)} FROM clients WHERE {WINDOW_SQL}")
def _(spark, sf_dir):
    return windowed(spark, sf_dir).select(*CLIENT_COLUMNS)


@check("prj_build_lag_days", f"SELECT DISTINCT chan, os, CAST({lag_days()} AS INTEGER) AS lag_days FROM counts")
def _(spark, sf_dir):
    pairs = fx.counts(spark, sf_dir).select("chan", "os").distinct()
    return pairs.withColumn("lag_days", build_lag_days(F.col("chan"), F.col("os")))


@check("prj_min_build_id", f"""
SELECT DISTINCT submission_date, chan, os, {min_build()} AS min_build_id, {min_build(1)} AS min_build_id_offset FROM counts
""")
def _(spark, sf_dir):
    chan, os, day = F.col("chan"), F.col("os"), F.col("submission_date")
    keys = fx.counts(spark, sf_dir).select("submission_date", "chan", "os").distinct()
    return keys.withColumns({"min_build_id": min_build_id(chan, os, day), "min_build_id_offset": min_build_id(chan, os, day, 1)})


@check("prj_build_floor", f"""
SELECT submission_date, normalized_channel AS chan, os, app_display_version AS dvers, app_version AS vers, {floored()} AS bid
FROM sampled
""")
def _(spark, sf_dir):
    return C.floored_clients(sampled(spark, sf_dir))


@check("prj_build_floor_const", f"""
SELECT submission_date, channel AS chan, os, app_version AS vers, app_display_version AS dvers,
  CASE WHEN app_build_id < '20240105' THEN '20240105' ELSE app_build_id END AS bid, count(*) AS n
FROM clients WHERE sample_id = 1 AND os IN {OSES} AND channel IN ('release', 'beta', 'nightly', 'esr')
  AND app_name = 'desktop' AND submission_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30' GROUP BY ALL
""")
def _(spark, sf_dir):
    chosen = scanned(spark, sf_dir).where((F.col("sample_id") == 1) & F.col("channel").isin("release", "beta", "nightly", "esr"))
    return C.count_versions_const(chosen, "20240105")


@check("prj_fold_rare", "SELECT * FROM folded")
def _(spark, sf_dir):
    return C.fold_rare(C.count_versions(sampled(spark, sf_dir)), max_groups=fx.DAY_GROUPS)


RELEASE_SQL = "category IN ('major', 'stability') AND date > DATE '2019-01-01' AND release_label NOT LIKE '%esr'"


@check("flt_release_rows", f"SELECT release_label, date, category, version FROM releases WHERE {RELEASE_SQL}")
def _(spark, sf_dir):
    return releases.release_rows(fx.product_releases(spark, sf_dir)).select("release_label", "date", "category", "version")


@check("prj_channel_unify", """
SELECT submission_date, c.chan AS channel, os,
  CASE WHEN c.chan = 'release' THEN vers WHEN c.chan = 'nightly' THEN substr(bid, 1, 8) ELSE dvers END AS vers,
  dvers, bid, n,
  CASE WHEN c.chan = 'nightly' THEN CAST(strptime(substr(bid, 1, 8), '%Y%m%d') AS DATE) ELSE rls_date END AS rls_date
FROM counts c LEFT JOIN date_lookup l ON c.chan = l.chan AND c.dvers = l.version
WHERE c.chan IN ('release', 'beta', 'aurora', 'nightly')
""")
def _(spark, sf_dir):
    return K.unify_with_release_dates(fx.counts(spark, sf_dir), fx.date_lookup(spark, sf_dir))


CURVE_KEYS = ["channel", "os", "vers", "submission_date"]


@check("flt_channel_window", """
SELECT channel, os, vers, submission_date, n FROM curves
WHERE submission_date > DATE '2024-03-10' - CASE channel WHEN 'release' THEN 90 ELSE 60 END
""")
def _(spark, sf_dir):
    months = {"release": 3, "beta": 2, "aurora": 2, "nightly": 2}
    return filters.channel_window(fx.curves(spark, sf_dir), "2024-03-10", months).select(*CURVE_KEYS, "n")


FLAGGED_SQL = """
SELECT channel, os, vers, submission_date, {major} AS is_major, {rc} AS RC, dvers FROM curves
"""


def flagged(spark, sf_dir):
    return K.with_channel_flags(K.collapse_builds(K.unify_channels(fx.counts(spark, sf_dir))))


@check("prj_channel_flags", FLAGGED_SQL.format(
    major="CASE WHEN channel = 'release' THEN is_major END", rc="CASE WHEN channel = 'beta' THEN RC END"))
def _(spark, sf_dir):
    return flagged(spark, sf_dir).select(*CURVE_KEYS, "is_major", "RC", "dvers")


@check("prj_fill_flags", FLAGGED_SQL.format(major="is_major", rc="RC"))
def _(spark, sf_dir):
    return K.fill_flags(flagged(spark, sf_dir)).select(*CURVE_KEYS, "is_major", "RC", "dvers")


@check("prj_old_build", "SELECT channel, os, vers, submission_date, build_ids, length(build_ids) <= 8 AS old_build FROM curves")
def _(spark, sf_dir):
    collapsed = K.collapse_builds(K.unify_channels(fx.counts(spark, sf_dir)))
    return collapsed.select(*CURVE_KEYS, "build_ids", is_old_build(F.col("build_ids")).alias("old_build"))


@check("flt_display_window", """
SELECT channel, os, vers, submission_date, days_post_pub FROM curves
WHERE days_post_pub > -2 AND days_post_pub <= CASE channel WHEN 'release' THEN 30 WHEN 'nightly' THEN 7 ELSE 10 END
""")
def _(spark, sf_dir):
    return filters.display_window(fx.curves(spark, sf_dir)).select(*CURVE_KEYS, "days_post_pub")


SHOWN = ["channel", "os", "vers", "submission_date", "show_n", "version", "week_day", "days_after_release", "release_day"]


@check("prj_display_cols", f"SELECT {', '.join(SHOWN)} FROM shown")
def _(spark, sf_dir):
    return serve.chart_feed(fx.curves(spark, sf_dir), fx.DISPLAY_BEFORE).select(*SHOWN)


@check("flt_recent_slider", "SELECT channel, os, vers, submission_date, nth_recent_release FROM top_curves WHERE nth_recent_release <= 10")
def _(spark, sf_dir):
    ranked = serve.top_versions(fx.curves(spark, sf_dir), fx.DISPLAY_BEFORE)
    return filters.recent_versions(ranked).select(*CURVE_KEYS, "nth_recent_release")


@check("flt_version_kind", """
SELECT DISTINCT dvers, contains(dvers, 'b') AND NOT contains(dvers, 'rc') AS beta_only, NOT contains(dvers, 'rc') AS with_release,
  contains(dvers, 'b') AS with_rc, true AS everything
FROM (SELECT dvers FROM counts UNION SELECT version FROM records)
""")
def _(spark, sf_dir):
    v = F.col("dvers")
    published = fx.registry_records(spark, sf_dir).select(F.col("version").alias("dvers"))
    return fx.counts(spark, sf_dir).select(v).union(published).distinct().select(
        v,
        V.version_kind(v).alias("beta_only"),
        V.version_kind(v, keep_release=True).alias("with_release"),
        V.version_kind(v, keep_rc=True).alias("with_rc"),
        V.version_kind(v, True, True).alias("everything"),
    )


@check("flt_major_version", """
SELECT channel, build_id, version, 'one' AS rule FROM (SELECT channel, build_id,
  list_min(list_filter(versions, lambda v: NOT contains(v, 'rc') AND TRY_CAST(split_part(v, '.', 1) AS INTEGER) = 72)) AS version FROM registry)
WHERE version IS NOT NULL
UNION ALL SELECT channel, build_id, version, 'set' FROM (SELECT channel, build_id,
  list_min(list_filter(versions, lambda v: NOT contains(v, 'rc') AND TRY_CAST(split_part(v, '.', 1) AS INTEGER) IN (71, 73))) AS version FROM registry)
WHERE version IS NOT NULL
UNION ALL SELECT channel, build_id, version, 'predicate' FROM (SELECT channel, build_id,
  list_min(list_filter(versions, lambda v: NOT contains(v, 'rc') AND v > '73')) AS version FROM registry)
WHERE version IS NOT NULL
""")
def _(spark, sf_dir):
    docs = registry.build_registry(fx.registry_records(spark, sf_dir), "2015", list(fx.config.SAMPLE_BOUNDS), fx.APP)
    rules = {"one": 72, "set": (71, 73), "predicate": lambda v: v > "73"}
    parts = [
        registry.registry_triplets(docs, wanted, keep_release=True).select("channel", "build_id", "version", F.lit(name).alias("rule"))
        for name, wanted in rules.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


@check("flt_min_bid", "SELECT * FROM counts WHERE bid >= (SELECT min(build_id) FROM norc_builds WHERE channel = 'release')")
def _(spark, sf_dir):
    builds = registry.of_channel(fx.builds(spark, sf_dir), "release")
    return filters.at_least_build(fx.counts(spark, sf_dir), builds)


@check("flt_min_count", "SELECT * FROM counts WHERE chan = 'beta' AND n > 20")
def _(spark, sf_dir):
    return filters.frequent_rows(fx.counts(spark, sf_dir), "beta", 20)


@check("prj_nightly_clamp", """
SELECT submission_date, os, bid, n, length(bid) = 8 AS old, CASE WHEN length(bid) = 8 THEN '20190101' ELSE substr(bid, 1, 8) END AS bidd
FROM counts WHERE chan = 'nightly' AND substr(bid, 1, 8) > '201909'
""")
def _(spark, sf_dir):
    bid = F.col("bid")
    nightly = fx.counts(spark, sf_dir).where((F.col("chan") == "nightly") & (F.substring(bid, 1, 8) > fx.config.NIGHTLY_FIRST_DAY))
    return nightly.select("submission_date", "os", "bid", "n", is_old_build(bid).alias("old"), clamp_nightly_day(bid).alias("bidd"))


@check("set_union_releases", "SELECT date, version, src, maj_vers FROM release_dates")
def _(spark, sf_dir):
    return fx.release_dates(spark, sf_dir)


@check("set_union_channels", unified("counts").replace("dvers, bid, n", "bid, n, CASE WHEN chan = 'nightly' THEN dvers END AS dvers"))
def _(spark, sf_dir):
    """Channel frames with differing columns, stacked by name."""
    rows = K.unify_channels(fx.counts(spark, sf_dir))
    nightly = rows.where("channel = 'nightly'")
    others = rows.where("channel <> 'nightly'").drop("dvers")
    return others.unionByName(nightly, allowMissingColumns=True)


@check("set_distinct", "SELECT DISTINCT bid, vers FROM counts")
def _(spark, sf_dir):
    return fx.counts(spark, sf_dir).select("bid", "vers").dropDuplicates()
