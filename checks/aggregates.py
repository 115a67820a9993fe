"""Registered queries: aggregations, windows, sorts and limits."""

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.joins_and_quality import CURVE_KEYS, ORDER_SQL, matched, shares
from checks.registered import check
from checks.rows import WINDOW_SQL, sampled, windowed
from checks.sql import PUB_DAY, PUB_TEXT, RELEASE_MAJOR, nearest_day, rounded
from tidemark import schemas
from tidemark.functions.builds import nearest_build_day
from tidemark.operators import aggregates as A
from tidemark.operators import joins as J
from tidemark.operators import ranks as R
from tidemark.operators.totals import with_share
from tidemark.plans import counts as C
from tidemark.plans import curves as K
from tidemark.plans import serve
from tidemark.sources import registry, releases

ALL_CHANNELS = list(fx.config.SAMPLE_BOUNDS)


@check("agg_version_counts", "SELECT submission_date, chan, os, dvers, vers, bid, n FROM raw_counts")
def _(spark, sf_dir):
    return C.count_versions(sampled(spark, sf_dir))


@check("agg_day_totals", "SELECT submission_date, chan, os, CAST(sum(n) AS BIGINT) AS n FROM raw_counts GROUP BY ALL")
def _(spark, sf_dir):
    return A.sum_by(C.count_versions(sampled(spark, sf_dir)), "submission_date", "chan", "os")


@check("agg_reduced_counts", "SELECT * FROM counts")
def _(spark, sf_dir):
    return C.reduce_counts(C.fold_rare(C.count_versions(sampled(spark, sf_dir)), max_groups=fx.DAY_GROUPS))


DAILY_SQL = f"SELECT submission_date, app_version, count(*) AS n FROM clients WHERE {WINDOW_SQL} GROUP BY ALL"


@check("agg_daily_by_version", DAILY_SQL)
def _(spark, sf_dir):
    return A.daily_by_version(windowed(spark, sf_dir))


@check("agg_existing_dates", "SELECT submission_date, count(*) AS n_rows FROM counts GROUP BY ALL")
def _(spark, sf_dir):
    return A.rows_per_date(fx.counts(spark, sf_dir))


@check("agg_latest_date", "SELECT max(submission_date) AS latest_date, max(submission_date) + 1 AS next_date FROM counts")
def _(spark, sf_dir):
    return A.latest_date(fx.counts(spark, sf_dir))


@check("agg_distinct_dates", "SELECT DISTINCT submission_date FROM counts WHERE submission_date >= DATE '2024-01-11'")
def _(spark, sf_dir):
    return A.distinct_dates(fx.counts(spark, sf_dir), "2024-01-11")


@check("agg_collapse_builds", """
SELECT channel, os, vers, submission_date, build_ids, min_build_id, n FROM curves_rows
""")
def _(spark, sf_dir):
    collapsed = K.collapse_builds(K.unify_channels(fx.counts(spark, sf_dir)))
    return collapsed.select(*CURVE_KEYS, "build_ids", "min_build_id", "n")


@check("agg_first_day_above", """
SELECT channel, os, vers, min(submission_date) AS first_day FROM curves WHERE n_pct > 0.01 GROUP BY ALL
""")
def _(spark, sf_dir):
    above = shares(spark, sf_dir).where(F.col("n_pct") > fx.config.FIRST_DAY_SHARE)
    return above.groupBy("channel", "os", "vers").agg(F.min("submission_date").alias("first_day"))


@check("agg_argmax", """
SELECT chan, os, submission_date, vers, bid, n,
  first_value(vers) OVER (PARTITION BY chan, os, submission_date ORDER BY n DESC, vers) AS top_vers
FROM (SELECT chan, os, submission_date, vers, bid, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY ALL)
""")
def _(spark, sf_dir):
    rows = A.sum_by(fx.counts(spark, sf_dir), "chan", "os", "submission_date", "vers", "bid")
    return A.argmax_back(rows, ["chan", "os", "submission_date"], "n", "vers", "top_vers")


@check("agg_nightly_dvers", "SELECT os, vers, top_dvers AS dvers FROM curves_top WHERE channel = 'nightly'")
def _(spark, sf_dir):
    nightly = K.unify_channels(fx.counts(spark, sf_dir)).where("channel = 'nightly'")
    return A.nightly_display_version(nightly)


@check("agg_min_builds", "SELECT channel, os, vers, min(build_ids) AS build_ids FROM curves WHERE NOT old_build GROUP BY ALL")
def _(spark, sf_dir):
    return A.min_builds(fx.curves(spark, sf_dir), "channel", "os", "vers")


def registry_docs(spark, sf_dir, since="2015"):
    return registry.build_registry(fx.registry_records(spark, sf_dir), since, ALL_CHANNELS, fx.APP)


@check("agg_registry_triplet", "SELECT channel, version, build_id, CAST(pub_ms AS BIGINT) AS pub_ms FROM beta_only_triplets")
def _(spark, sf_dir):
    return registry.registry_triplets(registry_docs(spark, sf_dir))


@check("agg_last_run", "SELECT channel, version, build_id, CAST(pub_ms AS BIGINT) AS pub_ms FROM all_time_builds")
def _(spark, sf_dir):
    return registry.last_runs(registry.registry_triplets(registry_docs(spark, sf_dir), keep_release=True))


@check("agg_last_run_all", "SELECT channel, version, build_id, CAST(pub_ms AS BIGINT) AS pub_ms FROM all_time_triplets")
def _(spark, sf_dir):
    triplets = registry.registry_triplets(registry_docs(spark, sf_dir), keep_release=True)
    return registry.last_runs(triplets, keep_all_runs=True)


@check("agg_version_build_list", """
SELECT channel AS chan, version, string_agg('''' || build_id || '''', ', ' ORDER BY build_id DESC) AS build_ids
FROM every_build GROUP BY channel, version
""")
def _(spark, sf_dir):
    return registry.version_build_list(fx.builds(spark, sf_dir), ["chan"])


@check("agg_daily_share_gt1", """
SELECT submission_date, vers, n, dayn, n / dayn * 100 AS n_perc FROM (
  SELECT *, CAST(sum(n) OVER (PARTITION BY submission_date) AS BIGINT) AS dayn FROM (
    SELECT submission_date, vers, CAST(sum(n) AS BIGINT) AS n
    FROM counts WHERE chan = 'release' AND os = 'Windows_NT' GROUP BY submission_date, vers)
) WHERE n / dayn * 100 > 1
""")
def _(spark, sf_dir):
    return A.version_share_of_day(fx.counts(spark, sf_dir), "release", "Windows_NT")


STARTS = [("71.0", "2024-01-05"), ("71.0.1", "2024-01-08"), ("72.0", "2024-01-11"), ("72.0.1", "2024-01-17")]


@check("agg_current_vs_other", f"""
WITH daily AS ({DAILY_SQL}),
targets(vers, start) AS (VALUES {', '.join(f"('{v}', DATE '{d}')" for v, d in STARTS)}),
r AS (
  SELECT t.vers, d.submission_date, CAST(sum(CASE WHEN d.app_version = t.vers THEN n ELSE 0 END) AS BIGINT) AS cur,
    CAST(sum(n) AS BIGINT) AS all_n,
    CAST(row_number() OVER (PARTITION BY t.vers ORDER BY d.submission_date) - 1 AS INTEGER) AS day
  FROM targets t JOIN daily d ON d.submission_date >= t.start GROUP BY t.vers, d.submission_date
)
SELECT vers, submission_date, day, cur, all_n, cur / all_n AS perc, {rounded('cur / all_n * 100', 1)} AS percent FROM r WHERE day < 10
""")
def _(spark, sf_dir):
    return A.current_against_other(A.daily_by_version(windowed(spark, sf_dir)), STARTS)


@check("agg_other_share", """
SELECT submission_date, CAST(sum(CASE WHEN dvers = 'other' THEN n ELSE 0 END) AS BIGINT) AS othern, CAST(sum(n) AS BIGINT) AS n,
  sum(CASE WHEN dvers = 'other' THEN n ELSE 0 END) / sum(n) AS othnp
FROM counts WHERE chan = 'beta' GROUP BY ALL
""")
def _(spark, sf_dir):
    return A.other_share(fx.counts(spark, sf_dir), "beta")


def match_sql(keys: str, flag: str, source: str) -> str:
    return f"""
    SELECT {keys}, CAST(sum(CASE WHEN {flag} THEN n ELSE 0 END) AS BIGINT) AS n_true,
      CAST(sum(CASE WHEN {flag} THEN 0 ELSE n END) AS BIGINT) AS n_false, CAST(sum(n) AS BIGINT) AS tot,
      {rounded(f'sum(CASE WHEN {flag} THEN n ELSE 0 END) / sum(n) * 100', 2)} AS perc_true,
      {rounded(f'sum(n) / (SELECT sum(n) FROM {source}) * 100', 2)} AS perc
    FROM {source} GROUP BY {keys}
    """


@check("agg_match_rate", match_sql("chan, os", "same_dv", "matched"))
def _(spark, sf_dir):
    return A.match_rate(matched(spark, sf_dir), ["chan", "os"], "same_dv", fx.counts(spark, sf_dir))


@check("agg_match_rate_null_date", match_sql("os", "rls_date IS NULL", """(
  SELECT os, n, rls_date FROM counts c LEFT JOIN date_lookup l ON c.chan = l.chan AND c.dvers = l.version
  WHERE c.chan = 'aurora' AND length(bid) > 8)"""))
def _(spark, sf_dir):
    """Counts with and without a release date, old builds left out."""
    aurora = fx.counts(spark, sf_dir).where("chan = 'aurora' AND length(bid) > 8")
    dated = J.join_release_date(aurora, fx.date_lookup(spark, sf_dir)).withColumn("undated", F.col("rls_date").isNull())
    return A.match_rate(dated, ["os"], "undated", aurora)


@check("top_k_rows", match_sql("os, vers, dvers, bid", "same_dv", "matched") + "ORDER BY tot DESC, os, vers, dvers, bid LIMIT 30")
def _(spark, sf_dir):
    keys = ["os", "vers", "dvers", "bid"]
    rated = A.match_rate(matched(spark, sf_dir), keys, "same_dv", fx.counts(spark, sf_dir))
    return A.top_rows(rated, 30, F.desc("tot"), *[F.asc(k) for k in keys])


@check("agg_pivot_min", f"""
SELECT chan, min(CASE WHEN os = 'Windows_NT' THEN day END) AS Windows_NT, min(CASE WHEN os = 'Darwin' THEN day END) AS Darwin,
  min(CASE WHEN os = 'Linux' THEN day END) AS Linux
FROM (SELECT chan, os, {nearest_day('bid')} AS day FROM counts WHERE length(bid) > 8) GROUP BY chan
""")
def _(spark, sf_dir):
    return A.earliest_build_day(fx.counts(spark, sf_dir).where("length(bid) > 8"))


@check("agg_pivot_min_first_day", """
SELECT vers, min(CASE WHEN os = 'Windows_NT' THEN d END) AS Windows_NT, min(CASE WHEN os = 'Darwin' THEN d END) AS Darwin,
  min(CASE WHEN os = 'Linux' THEN d END) AS Linux
FROM (SELECT vers, os, vers_min_date_above_npct AS d FROM curves WHERE channel = 'release') GROUP BY vers
""")
def _(spark, sf_dir):
    release = fx.curves(spark, sf_dir).where("channel = 'release'")
    return release.groupBy("vers").pivot("os", list(fx.config.OSES)).agg(F.min("vers_min_date_above_npct"))


PEAK_SQL = """
SELECT os, submission_date, bidd AS max_bid, n / total AS pct,
  CAST(submission_date - CAST(strptime(bidd, '%Y%m%d') AS DATE) AS INTEGER) AS dif
FROM (
  SELECT *, sum(n) OVER w AS total, row_number() OVER (w ORDER BY n DESC, bidd) AS k FROM (
    SELECT os, submission_date, n, CASE WHEN length(bid) = 8 THEN '20190101' ELSE substr(bid, 1, 8) END AS bidd
    FROM counts WHERE chan = 'nightly' AND substr(bid, 1, 8) > '201909')
  WINDOW w AS (PARTITION BY os, submission_date)
) WHERE k = 1
"""


def peaks(spark, sf_dir):
    return A.peak_build(fx.counts(spark, sf_dir).where("chan = 'nightly'"))


@check("agg_peak_build", PEAK_SQL)
def _(spark, sf_dir):
    return peaks(spark, sf_dir)


@check("agg_value_dist", f"""
WITH peak AS ({PEAK_SQL}), c AS (SELECT os, dif, count(*) AS n FROM peak GROUP BY ALL)
SELECT os, dif, n, n / sum(n) OVER (PARTITION BY os) AS freq,
  sum(n) OVER (PARTITION BY os ORDER BY dif) / sum(n) OVER (PARTITION BY os) AS cum_freq
FROM c
""")
def _(spark, sf_dir):
    return A.value_distribution(peaks(spark, sf_dir), ["os"], "dif")


@check("agg_top_mismatch", """
SELECT bid, CAST(sum(n) AS BIGINT) AS n FROM matched
WHERE chan = 'beta' AND bid > (SELECT min(bid) FROM matched WHERE chan = 'beta') AND NOT same_dv
GROUP BY bid HAVING sum(n) > 5
""")
def _(spark, sf_dir):
    return A.top_mismatches(matched(spark, sf_dir), "beta", 5, fx.counts(spark, sf_dir))


PROFILED = [f for f in schemas.CURVES.fields if f.name != "channel"]
_RATES = ", ".join(f"avg(CAST({f.name} IS NOT NULL AS INTEGER)) AS {f.name}" for f in PROFILED)


@check("agg_null_profile", f"""
WITH rates AS (SELECT channel, {_RATES} FROM curves GROUP BY channel),
long AS (UNPIVOT rates ON {", ".join(f.name for f in PROFILED)} INTO NAME column_name VALUE filled)
SELECT channel, column_name, CAST(round(CAST(filled AS DECIMAL(38, 12)), 1) AS DOUBLE) AS filled FROM long
QUALIFY max(filled) OVER (PARTITION BY column_name) <> min(filled) OVER (PARTITION BY column_name)
""")
def _(spark, sf_dir):
    """Every column of the curve table."""
    return A.null_profile(fx.curves(spark, sf_dir))


@check("agg_column_profile", " UNION ALL ".join(
    f"SELECT channel, '{f.name}' AS column_name, '{f.dataType.simpleString()}' AS data_type, count(*) AS n_rows, "
    f"count({f.name}) AS filled, count(DISTINCT {f.name}) AS n_distinct FROM curves GROUP BY channel" for f in PROFILED
))
def _(spark, sf_dir):
    return A.column_profile(fx.curves(spark, sf_dir), ["channel"])


@check("agg_key_profile", """
SELECT 'vers' AS column_name, count(DISTINCT vers) AS n_distinct FROM curves
UNION ALL SELECT 'submission_date', count(DISTINCT submission_date) FROM curves
UNION ALL SELECT 'os', count(DISTINCT os) FROM curves
UNION ALL SELECT 'channel', count(DISTINCT channel) FROM curves
""")
def _(spark, sf_dir):
    return A.distinct_profile(fx.curves(spark, sf_dir), ["vers", "submission_date", "os", "channel"])


@check("agg_key_profile_sizes", """
SELECT group_size, count(*) AS n_groups FROM (SELECT count(*) AS group_size FROM curves GROUP BY vers, submission_date, os) GROUP BY group_size
""")
def _(spark, sf_dir):
    return A.group_sizes(fx.curves(spark, sf_dir), ["vers", "submission_date", "os"])


NTH_SQL = """
SELECT channel, os, vers, CAST(row_number() OVER (PARTITION BY channel, os ORDER BY min(vers_min_date_above_npct) DESC NULLS LAST, vers) AS INTEGER) AS nth_recent_release
FROM curves WHERE vers <> 'other' AND length(build_ids) > 8 GROUP BY channel, os, vers
"""


@check("agg_rank_agreement", f"""
WITH pairs AS (
  SELECT t.nth_recent_release, r.nth_recent_release AS rank, CAST(sum(n) AS BIGINT) AS n
  FROM curves c JOIN ({NTH_SQL}) t USING (channel, os, vers) LEFT JOIN ranks r USING (channel, os, vers) GROUP BY ALL
), e AS (SELECT *, nth_recent_release IS NOT DISTINCT FROM rank AS eq FROM pairs)
SELECT eq, nth_recent_release, rank, n, CAST(sum(n) OVER (PARTITION BY eq) AS BIGINT) AS eq_n,
  sum(n) OVER (PARTITION BY eq) / sum(n) OVER () AS eq_share FROM e
""")
def _(spark, sf_dir):
    return A.rank_agreement(serve.version_ranks(fx.curves(spark, sf_dir)), "nth_recent_release", "rank")


@check("agg_build_totals", "SELECT chan, bid, CAST(sum(n) AS BIGINT) AS n FROM counts GROUP BY ALL")
def _(spark, sf_dir):
    return A.sum_by(fx.counts(spark, sf_dir), "chan", "bid")


@check("agg_log_hist", """
WITH x AS (SELECT log10(n) AS x FROM counts WHERE chan = 'nightly'), e AS (SELECT min(x) AS lo, max(x) AS hi FROM x)
SELECT CAST(least(coalesce(floor((x - lo) / nullif(hi - lo, 0) * 100), 0), 99) AS INTEGER) AS bin, count(*) AS n FROM x, e GROUP BY ALL
""")
def _(spark, sf_dir):
    return A.log_histogram(fx.counts(spark, sf_dir), "nightly")


# ---- Windows ----


@check("win_day_total", "SELECT channel, os, vers, submission_date, n, day_chan_os_sum, n_pct FROM curves")
def _(spark, sf_dir):
    return shares(spark, sf_dir).select(*CURVE_KEYS, "n", "day_chan_os_sum", "n_pct")


@check("win_vers_pub_date", """
SELECT c.chan, c.os, c.vers, c.dvers, c.submission_date, c.bid, min(rls_date) OVER (PARTITION BY c.chan, c.os, c.vers) AS vers_pub_date
FROM counts c LEFT JOIN date_lookup l ON c.chan = l.chan AND c.dvers = l.version
""")
def _(spark, sf_dir):
    with_first = J.with_first_release(fx.counts(spark, sf_dir), fx.date_lookup(spark, sf_dir))
    return with_first.select("chan", "os", "vers", "dvers", "submission_date", "bid", "vers_pub_date")


@check("win_unoffset_days", "SELECT channel, os, vers, submission_date, days_post_pub FROM curves")
def _(spark, sf_dir):
    return K.with_first_day(shares(spark, sf_dir)).select(*CURVE_KEYS, "days_post_pub")


@check("win_latest_flag", "SELECT channel, os, vers, submission_date, latest_vers FROM curves")
def _(spark, sf_dir):
    unified = K.unify_channels(fx.counts(spark, sf_dir))
    return K.with_latest_flag(K.collapse_builds(unified), unified).select(*CURVE_KEYS, "latest_vers")


@check("win_rank_recent", "SELECT os, vers, channel, nth_recent_release FROM ranks")
def _(spark, sf_dir):
    return serve.rank_versions(fx.curves(spark, sf_dir))


@check("win_order_versions", ORDER_SQL)
def _(spark, sf_dir):
    return serve.order_versions(fx.curves(spark, sf_dir).where("channel = 'beta'"))


@check("win_nth_release", f"""
SELECT channel, os, vers, submission_date, nth_recent_release FROM curves LEFT JOIN ({NTH_SQL}) t USING (channel, os, vers)
""")
def _(spark, sf_dir):
    return K.nth_release(fx.curves(spark, sf_dir)).select(*CURVE_KEYS, "nth_recent_release")


@check("win_top_n", "SELECT channel, os, vers, submission_date, n, n_pct, nth_recent_release FROM top_curves")
def _(spark, sf_dir):
    top = serve.top_versions(fx.curves(spark, sf_dir), fx.DISPLAY_BEFORE)
    return top.select(*CURVE_KEYS, "n", "n_pct", "nth_recent_release")


@check("win_cdf", f"""
SELECT chan, os, bidd, n, sum(n) OVER (PARTITION BY chan, os ORDER BY bidd) / sum(n) OVER (PARTITION BY chan, os) AS cdf FROM (
  SELECT chan, os, {nearest_day('bid')} AS bidd, CAST(sum(n) AS BIGINT) AS n FROM counts WHERE bid IS NOT NULL GROUP BY ALL)
""")
def _(spark, sf_dir):
    counts = fx.counts(spark, sf_dir).withColumn("bidd", nearest_build_day(F.col("bid")))
    # Clients without a build have no place on this axis.
    return R.running_share(counts.where(F.col("bidd").isNotNull()), ["chan", "os"], "bidd", "n", "cdf")


@check("win_group_share", """
SELECT submission_date, chan, os, dvers, vers, bid, n, CAST(sum(n) OVER (PARTITION BY chan, os) AS BIGINT) AS chan_os_bid_n,
  n / sum(n) OVER (PARTITION BY chan, os) AS share FROM counts
""")
def _(spark, sf_dir):
    return with_share(fx.counts(spark, sf_dir), ["chan", "os"], total="chan_os_bid_n", max_groups=fx.SERIES)


@check("win_dedupe_first", f"""
SELECT version, min({PUB_DAY}) AS date FROM norc_builds WHERE channel = 'beta' AND NOT contains(version, 'b') GROUP BY version
""")
def _(spark, sf_dir):
    builds = registry.of_channel(fx.builds(spark, sf_dir), "beta")
    rc = builds.where(~F.col("version").contains("b")).select("version", "date")
    return R.first_per(rc, ["version"], ["date"]).withColumn("date", F.col("date").cast("date"))


@check("win_dedupe_last", f"""
SELECT version, arg_max(build_id, pub_ms) AS build_id, strftime(epoch_ms(max(pub_ms)), '%Y-%m-%d %H:%M:%S') AS date
FROM norc_builds WHERE channel = 'release' AND {RELEASE_MAJOR} IS NOT NULL GROUP BY version
""")
def _(spark, sf_dir):
    builds = registry.of_channel(fx.builds(spark, sf_dir), "release").where("is_major")
    last = R.last_per(builds.select("version", "build_id", "date"), ["version"], ["date", "build_id"])
    return last.withColumn("date", F.col("date").cast("string"))


# ---- Sorts and limits ----


@check("top_latest_releases", """
SELECT date, version, src, maj_vers FROM (
  SELECT * FROM release_dates WHERE date < DATE '2024-01-20' ORDER BY date DESC, version DESC, src DESC LIMIT 3)
""")
def _(spark, sf_dir):
    return releases.latest_releases(fx.release_dates(spark, sf_dir), "2024-01-20", 3)


@check("top_current_major", """
SELECT CAST(split_part(version, '.', 1) AS INTEGER) AS current_major FROM majors ORDER BY date DESC, version DESC LIMIT 1
""")
def _(spark, sf_dir):
    return releases.current_major(fx.major_list(spark, sf_dir, "2010-01-01"))


@check("sort_output", "SELECT os, channel, vers, submission_date, nth_recent_release FROM top_curves ORDER BY os, channel, nth_recent_release")
def _(spark, sf_dir):
    ranked = serve.top_versions(fx.curves(spark, sf_dir), fx.DISPLAY_BEFORE)
    return serve.sort_for_display(ranked.select("os", "channel", "vers", "submission_date", "nth_recent_release"))


@check("sort_registry", f"SELECT channel AS chan, version, build_id, {PUB_TEXT} AS date FROM every_build ORDER BY channel, pub_ms")
def _(spark, sf_dir):
    builds = fx.builds(spark, sf_dir)
    return builds.orderBy("chan", "date").select("chan", "version", "build_id", F.col("date").cast("string").alias("date"))
