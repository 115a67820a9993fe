"""Registered queries: joins and data checks."""

from pyspark.sql import functions as F

from checks import fixtures as fx
from checks.registered import check
from checks.rows import sampled
from checks.sql import rounded
from tidemark import schemas
from tidemark.operators import joins as J
from tidemark.operators import quality as Q
from tidemark.operators.totals import with_share
from tidemark.plans import curves as K
from tidemark.plans import serve
from tidemark.plans.counts import count_versions
from tidemark.sources import registry, releases

CURVE_KEYS = ["channel", "os", "vers", "submission_date"]
COUNT_KEYS = ["submission_date", "chan", "os", "dvers", "vers", "bid", "n"]


def dated_builds(spark, sf_dir):
    """Release and beta builds, as (chan, build_id, version, date)."""
    return fx.builds(spark, sf_dir).where(F.col("chan").isin("release", "beta"))


def matched(spark, sf_dir):
    return J.join_registry(fx.counts(spark, sf_dir), dated_builds(spark, sf_dir))


@check("join_denominator", "SELECT submission_date, chan, os, dvers, vers, bid, n, total, share FROM shared")
def _(spark, sf_dir):
    return with_share(count_versions(sampled(spark, sf_dir)), max_groups=fx.DAY_GROUPS)


@check("join_release_date", """
SELECT c.*, rls_date FROM counts c LEFT JOIN date_lookup l ON c.chan = l.chan AND c.dvers = l.version
""")
def _(spark, sf_dir):
    return J.join_release_date(fx.counts(spark, sf_dir), fx.date_lookup(spark, sf_dir))


def shares(spark, sf_dir):
    unified = K.unify_channels(fx.counts(spark, sf_dir))
    return K.with_denominator(K.collapse_builds(unified), unified)


@check("join_first_day", "SELECT channel, os, vers, submission_date, vers_min_date_above_npct FROM curves")
def _(spark, sf_dir):
    return K.with_first_day(shares(spark, sf_dir)).select(*CURVE_KEYS, "vers_min_date_above_npct")


@check("join_rank_using", """
SELECT channel, os, vers, submission_date, n, nth_recent_release FROM curves JOIN ranks USING (os, vers, channel)
""")
def _(spark, sf_dir):
    curves = fx.curves(spark, sf_dir)
    return J.join_ranks(curves, serve.rank_versions(curves)).select(*CURVE_KEYS, "n", "nth_recent_release")


ORDER_SQL = """
SELECT os, vers, min(build_ids) AS build_ids,
  CAST(row_number() OVER (PARTITION BY os ORDER BY min(build_ids) DESC, vers) AS INTEGER) AS recent_version_order
FROM curves WHERE channel = 'beta' AND NOT old_build GROUP BY os, vers
"""


@check("join_channel_order", f"""
SELECT submission_date, os, vers, n, recent_version_order
FROM curves LEFT JOIN ({ORDER_SQL}) o USING (os, vers) WHERE channel = 'beta'
""")
def _(spark, sf_dir):
    beta = fx.curves(spark, sf_dir).where("channel = 'beta'")
    ordered = J.join_channel_order(beta, serve.order_versions(beta))
    return ordered.select("submission_date", "os", "vers", "n", "recent_version_order")


@check("join_build_registry", """
SELECT submission_date, chan, os, dvers, vers, bid, n, reg_dvers, strftime(pub_day, '%Y-%m-%d') AS reg_day, same_dv FROM matched
""")
def _(spark, sf_dir):
    return matched(spark, sf_dir).withColumn("reg_day", F.col("reg_pub_date").cast("date").cast("string")).drop("reg_pub_date")


@check("join_full_compare", """
SELECT coalesce(p.submission_date, t.submission_date) AS submission_date, coalesce(p.chan, t.chan) AS chan,
  coalesce(p.os, t.os) AS os, coalesce(p.dvers, t.dvers) AS dvers, coalesce(p.vers, t.vers) AS vers,
  coalesce(p.bid, t.bid) AS bid, coalesce(p.n, t.n) AS n, p.n IS NOT NULL AS p, t.n IS NOT NULL AS t
FROM counts p FULL JOIN test_counts t ON p.submission_date = t.submission_date AND p.chan = t.chan AND p.os = t.os
  AND p.dvers IS NOT DISTINCT FROM t.dvers AND p.vers = t.vers AND p.bid IS NOT DISTINCT FROM t.bid AND p.n = t.n
""")
def _(spark, sf_dir):
    return J.full_compare(fx.counts(spark, sf_dir), fx.test_counts(spark, sf_dir), COUNT_KEYS)


@check("join_compare_counts", f"""
SELECT chan, os, vers, np, nt, nt - np AS df, {rounded('(nt - np) / np * 100', 1)} AS dfp, abs({rounded('(nt - np) / np * 100', 1)}) AS dfpa
FROM (SELECT chan, os, vers, CAST(sum(n) AS BIGINT) AS np FROM counts GROUP BY ALL) p
LEFT JOIN (SELECT chan, os, vers, CAST(sum(n) AS BIGINT) AS nt0 FROM test_counts GROUP BY ALL) t USING (chan, os, vers),
LATERAL (SELECT coalesce(nt0, 0) AS nt) WHERE abs({rounded('(nt - np) / np * 100', 1)}) > 1
""")
def _(spark, sf_dir):
    return J.compare_counts(fx.counts(spark, sf_dir), fx.test_counts(spark, sf_dir), ["chan", "os", "vers"])


@check("join_new_rows", """
SELECT a.vers, a.submission_date, a.os, a.channel, a.n, b.n AS n2, b.n IS NULL AS new
FROM curves a LEFT JOIN curves20 b USING (vers, submission_date, os, channel)
""")
def _(spark, sf_dir):
    today, yesterday = fx.curves(spark, sf_dir), fx.curves(spark, sf_dir, "2024-01-20")
    return J.mark_new_rows(today, yesterday, ["vers", "submission_date", "os", "channel"])


@check("join_anti_dates", "SELECT * FROM counts WHERE submission_date > DATE '2024-01-20'")
def _(spark, sf_dir):
    counts = fx.counts(spark, sf_dir)
    return J.not_loaded(counts, counts.where("submission_date <= DATE '2024-01-20'"))


DUPLICATE_SQL = """
SELECT submission_date, count(*) AS n_rows FROM counts
WHERE submission_date BETWEEN DATE '2024-01-25' AND DATE '2024-02-05' GROUP BY ALL
"""


@check("join_semi_dates", DUPLICATE_SQL)
def _(spark, sf_dir):
    return Q.duplicate_dates(fx.counts(spark, sf_dir), "2024-01-25", "2024-02-05")


@check("join_exists_flag", """
SELECT c.*, coalesce(bid IN (SELECT build_id FROM dated_builds WHERE chan = 'release'), false) AS rls_bid FROM counts c
""")
def _(spark, sf_dir):
    builds = dated_builds(spark, sf_dir).where("chan = 'release'").select(F.col("build_id").alias("bid"))
    return J.with_presence(fx.counts(spark, sf_dir), builds, ["bid"], "rls_bid")


@check("join_anti_versions", "SELECT DISTINCT dvers FROM counts WHERE NOT coalesce(dvers IN (SELECT version FROM release_dates), false)")
def _(spark, sf_dir):
    return J.versions_without_date(fx.counts(spark, sf_dir), fx.release_dates(spark, sf_dir))


# ---- Data checks ----


@check("dq_date_format", """
SELECT DISTINCT CASE WHEN chan = 'esr' THEN strftime(submission_date, '%d-%m-%Y') END AS day_text
FROM counts WHERE chan IN ('esr', 'aurora')
""")
def _(spark, sf_dir):
    """Good, reordered and missing date texts; the last two are violations."""
    chan, day = F.col("chan"), F.col("submission_date")
    text = F.when(chan == "esr", F.date_format(day, "dd-MM-yyyy")).when(chan != "aurora", day.cast("string"))
    return Q.malformed_dates(fx.counts(spark, sf_dir).select(text.alias("day_text")), "day_text").distinct()


@check("dq_duplicate_dates", DUPLICATE_SQL)
def _(spark, sf_dir):
    return Q.duplicate_dates(fx.counts(spark, sf_dir), "2024-01-25", "2024-02-05")


@check("dq_single_denominator", """
SELECT channel, os, vers, submission_date, day_chan_os_sum, day_chan_os_sum + 1 AS day_chan_os_sum_min
FROM curves WHERE latest_vers
""")
def _(spark, sf_dir):
    """The denominator of the latest version's rows is put wrong on purpose."""
    curves = fx.curves(spark, sf_dir)
    seeded = curves.withColumn("day_chan_os_sum_min", F.col("day_chan_os_sum_min") + F.col("latest_vers").cast("int"))
    return Q.uneven_denominators(seeded).select(*CURVE_KEYS, "day_chan_os_sum", "day_chan_os_sum_min")


@check("dq_one_to_one", """
SELECT version, count(DISTINCT build_id) AS n_values FROM any_builds GROUP BY version HAVING count(DISTINCT build_id) > 1
""")
def _(spark, sf_dir):
    """Versions published under more than one build id."""
    docs = registry.build_registry(fx.registry_records(spark, sf_dir), "2023", list(fx.config.SAMPLE_BOUNDS), fx.APP)
    builds = registry.last_runs(registry.registry_triplets(docs, keep_rc=True, keep_release=True))
    return Q.not_one_to_one(builds, "version", "build_id")


@check("dq_row_preserving", """
SELECT submission_date, chan, os, dvers, vers, bid, n, 'lost' AS problem FROM matched WHERE pub_day IS NULL
""")
def _(spark, sf_dir):
    """A join that drops unmatched counts, reported row by row."""
    counts = fx.counts(spark, sf_dir)
    lossy = matched(spark, sf_dir).where(F.col("reg_pub_date").isNotNull())
    return Q.changed_rows(counts, lossy)


@check("dq_min_days", """
SELECT submission_date, chan, os, bid, n, CAST(submission_date - pub_day AS INTEGER) AS days_post_pub
FROM matched WHERE submission_date - pub_day < 1
""")
def _(spark, sf_dir):
    """Counts on or before the build's publication day (a stricter bound than the default)."""
    rows = Q.early_submissions(matched(spark, sf_dir), "reg_pub_date", min_days=1)
    return rows.select("submission_date", "chan", "os", "bid", "n", "days_post_pub")


@check("dq_integer_major", "SELECT version FROM majors WHERE TRY_CAST(version AS INTEGER) IS NULL")
def _(spark, sf_dir):
    every = fx.major_list(spark, sf_dir, "2000-01-01")
    return Q.non_integer_majors(every).select("version")


@check("dq_value_diff", """
SELECT *, 'first' AS side FROM (SELECT * FROM counts EXCEPT ALL SELECT * FROM test_counts)
UNION ALL SELECT *, 'second' FROM (SELECT * FROM test_counts EXCEPT ALL SELECT * FROM counts)
""")
def _(spark, sf_dir):
    return Q.value_differences(fx.counts(spark, sf_dir), fx.test_counts(spark, sf_dir))


@check("dq_unreadable_documents", """
SELECT NULL::VARCHAR AS label, 'document' AS problem FROM (
  SELECT DISTINCT chan, CAST(split_part(version, '.', 1) AS INTEGER) AS major FROM release_list
  WHERE chan <> 'beta' OR contains(version, 'b')
) WHERE major % 7 = 0
UNION ALL SELECT release_label, 'date' FROM releases WHERE version LIKE '60.%'
""")
def _(spark, sf_dir):
    """Release documents of which some are cut short and some hold text in place of a date."""
    documents = fx.release_documents(spark, sf_dir)
    major = F.regexp_extract("json", r'"app-(\d+)\.', 1).cast("int")
    undated = F.replace("json", F.lit("2017-11-14"), F.lit("soon"))
    broken = documents.select(F.when(major % 7 == 0, F.substring("json", 1, 40)).otherwise(undated).alias("json"))
    return releases.unreadable_documents(broken, schemas.PRODUCT_RELEASES, "date").select("label", "problem")
