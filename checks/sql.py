"""The pipeline's entities once more, as plain SQL over the given tables, to check results with.

``query(body)`` puts the common table expressions a body names in front of it.
"""

import re

OSES = "('Windows_NT', 'Darwin', 'Linux')"

CTES: dict[str, str] = {}


def define(name: str, sql: str) -> None:
    CTES[name] = sql.strip()


def _named(sql: str) -> list[str]:
    words = set(re.findall(r"\w+", sql))
    return [name for name in CTES if name in words]


def query(body: str) -> str:
    needed: set[str] = set()
    todo = _named(body)
    while todo:
        name = todo.pop()
        if name not in needed:
            needed.add(name)
            todo += _named(CTES[name])
    if not needed:
        return body.strip()
    parts = ",\n".join(f"{name} AS (\n{sql}\n)" for name, sql in CTES.items() if name in needed)
    body = body.strip()
    return f"WITH {parts},\n{body[5:]}" if body.upper().startswith("WITH ") else f"WITH {parts}\n{body}"


def rounded(value: str, places: int) -> str:
    """Decimal rounding, half away from zero."""
    return f"CAST(round(CAST({value} AS DECIMAL(38, 12)), {places}) AS DOUBLE)"


def lag_days(chan: str = "chan", os: str = "os") -> str:
    return (
        f"CASE WHEN {chan} = 'esr' THEN 1095 WHEN {chan} = 'release' AND {os} = 'Linux' THEN 730 "
        f"WHEN {chan} = 'beta' THEN 100 ELSE 60 END"
    )


def min_build(offset: int = 0, chan: str = "chan") -> str:
    return f"strftime(submission_date - CAST({lag_days(chan)} + {offset} AS INTEGER), '%Y%m%d')"


def floored(bid: str = "app_build_id", chan: str = "normalized_channel") -> str:
    floor = min_build(0, chan)
    return f"CASE WHEN {bid} < {floor} THEN {floor} ELSE {bid} END"


define("view_base", """
  SELECT *, CAST((l_orderkey * 7 + l_linenumber * 3) % 30 AS INTEGER) AS d,
    CAST(l_quantity AS INTEGER) % 4 AS lag,
    CASE o_orderpriority WHEN '1-URGENT' THEN 'release' WHEN '2-HIGH' THEN 'beta'
      WHEN '3-MEDIUM' THEN 'nightly' WHEN '4-NOT SPECIFIED' THEN 'aurora' ELSE 'esr' END AS chan
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
""")
define("view_cycles", """
  SELECT *, 70 + CAST(floor((d - lag + 6) / 6.0) AS INTEGER) AS vnum, (d - lag + 6) % 6 AS cyc FROM view_base
""")
define("view_versions", """
  SELECT *,
    CASE WHEN l_partkey % 97 = 0 THEN '60.0.' || CAST(l_partkey % 7 AS VARCHAR)
      WHEN chan = 'release' AND cyc >= 3 THEN CAST(vnum AS VARCHAR) || '.0.1'
      WHEN chan = 'nightly' THEN CAST(vnum AS VARCHAR) || '.0a1'
      ELSE CAST(vnum AS VARCHAR) || '.0' END AS app_version,
    CASE WHEN chan = 'nightly' THEN d - lag
      WHEN chan = 'release' THEN 6 * (vnum - 71) - 2 + (CASE WHEN cyc < 3 THEN 0 ELSE 3 END)
      WHEN chan = 'esr' THEN 6 * (vnum - 71) - 40
      ELSE 6 * (vnum - 71) + cyc - (CASE WHEN l_partkey % 83 = 0 THEN 0 ELSE 1 END) END AS build_offset
  FROM view_cycles
""")
define("clients", """
  SELECT DATE '2024-01-01' + d AS submission_date, 'desktop' AS app_name,
    CASE WHEN l_partkey % 10 < 7 THEN 'Windows_NT' WHEN l_partkey % 10 = 7 THEN 'Darwin'
      WHEN l_partkey % 10 = 8 THEN 'Linux' WHEN l_partkey % 20 = 9 THEN 'Android' END AS os,
    chan AS normalized_channel, chan AS channel,
    CASE l_suppkey % 8 WHEN 0 THEN 0 WHEN 1 THEN 1 WHEN 2 THEN 25 WHEN 3 THEN 26
      WHEN 4 THEN 50 WHEN 5 THEN 51 WHEN 6 THEN 75 ELSE 1 END AS sample_id,
    app_version,
    CASE WHEN l_partkey % 73 = 0 THEN NULL
      WHEN chan IN ('beta', 'aurora') AND cyc < 5
      THEN CAST(vnum AS VARCHAR) || '.0b' || CAST(cyc + 1 AS VARCHAR) ELSE app_version END AS app_display_version,
    CASE WHEN l_partkey % 79 = 0 THEN NULL
      WHEN l_partkey % 89 = 0 THEN '20150101000000'
      WHEN l_partkey % 97 = 0 AND chan = 'release' THEN '20171110100000'
      ELSE strftime(DATE '2024-01-01' + CAST(build_offset AS INTEGER), '%Y%m%d')
        || CASE WHEN (build_offset + 400) % 4 = 0 THEN '100000' WHEN (build_offset + 400) % 4 = 3 THEN '183000' ELSE '120000' END
      END AS app_build_id,
    l_linenumber AS shard
  FROM view_versions
""")


def sample(beta: int = 50) -> str:
    return (
        f"(normalized_channel = 'release' AND sample_id = 1 OR normalized_channel = 'esr' AND sample_id <= 25 "
        f"OR normalized_channel = 'beta' AND sample_id <= {beta} OR normalized_channel IN ('aurora', 'nightly'))"
    )


def _counts(prefix: str, beta: int) -> None:
    define(f"{prefix}sampled", f"""
      SELECT * FROM clients WHERE app_name = 'desktop' AND os IN {OSES} AND {sample(beta)}
        AND submission_date BETWEEN DATE '2024-01-01' AND DATE '2024-01-30'
    """)
    define(f"{prefix}raw_counts", f"""
      SELECT submission_date, normalized_channel AS chan, os, app_version AS vers, {floored()} AS bid,
        app_display_version AS dvers, count(*) AS n
      FROM {prefix}sampled GROUP BY ALL
    """)
    define(f"{prefix}shared", f"""
      SELECT r.*, t.total, r.n / t.total AS share FROM {prefix}raw_counts r JOIN (
        SELECT submission_date, chan, os, CAST(sum(n) AS BIGINT) AS total FROM {prefix}raw_counts GROUP BY ALL
      ) t USING (submission_date, chan, os)
    """)
    define(f"{prefix}folded", f"""
      SELECT submission_date, chan, os, CASE WHEN share > 0.005 THEN dvers ELSE 'other' END AS dvers,
        CASE WHEN share > 0.005 THEN vers ELSE 'other' END AS vers,
        CASE WHEN share > 0.005 THEN bid ELSE {min_build(1)} END AS bid, n
      FROM {prefix}shared
    """)
    define(f"{prefix}counts", f"""
      SELECT submission_date, chan, os, dvers, vers, bid, CAST(sum(n) AS BIGINT) AS n
      FROM {prefix}folded GROUP BY ALL
    """)


_counts("", 50)
_counts("test_", 25)

# ---- Build registry and release dates ----

define("records", """
  SELECT DISTINCT app_build_id AS build_id,
    CASE WHEN normalized_channel = 'beta' AND regexp_matches(app_display_version, '^\\d+\\.0$') AND shard = 4
        OR normalized_channel = 'aurora' AND app_display_version = '73.0'
      THEN app_display_version || 'b6rc' ELSE app_display_version END AS version,
    CAST(strptime(substr(app_build_id, 1, 8), '%Y%m%d') AS DATE) - DATE '1970-01-01' AS day_no,
    (CAST(strptime(substr(app_build_id, 1, 8), '%Y%m%d') AS DATE) - DATE '1970-01-01') * 86400000
      + (10 + shard % 3) * 3600000 + shard * 7 AS pub_ms,
    CASE os WHEN 'Windows_NT' THEN 'win64' WHEN 'Darwin' THEN 'macosx64' ELSE 'linux64' END AS platform,
    CASE WHEN shard <= 5 THEN 'en-US' ELSE 'de' END AS locale,
    normalized_channel AS channel, 'desktop' AS product
  FROM clients
""")
define("registry", """
  SELECT channel, build_id, list_sort(list(version)) AS versions, list_sort(list(DISTINCT first_ms)) AS pub_dates
  FROM (
    SELECT channel, build_id, version, min(pub_ms) AS first_ms FROM records
    WHERE platform = 'win64' AND locale = 'en-US' AND product = 'desktop' AND build_id >= '2015'
    GROUP BY channel, build_id, version
  ) GROUP BY channel, build_id
""")


def nearest_day(bid: str) -> str:
    """Build time rounded to the day; noon goes to the even day since 1970, as rounding half to even does."""
    day = f"CAST(strptime(substr({bid}, 1, 8), '%Y%m%d') AS DATE)"
    seconds = " + ".join(f"{unit} * coalesce(TRY_CAST(substr({bid}, {at}, 2) AS INTEGER), 0)" for at, unit in ((9, 3600), (11, 60), (13, 1)))
    odd = f"({day} - DATE '1970-01-01') % 2 = 1"
    return f"{day} + CASE WHEN {seconds} > 43200 OR ({seconds} = 43200 AND {odd}) THEN 1 ELSE 0 END"


def _runs(name: str, keep: str, since: str) -> None:
    """(channel, version, build_id, pub_ms): smallest kept version and the last run of each."""
    define(f"{name}_triplets", f"""
      SELECT channel, list_min(list_filter(versions, lambda v: {keep})) AS version, build_id, list_min(pub_dates) AS pub_ms
      FROM registry
      WHERE len(list_filter(versions, lambda v: {keep})) > 0 AND build_id >= '{since}'
    """)
    define(f"{name}_marked", f"""
      SELECT *, CASE WHEN version = lag(version) OVER (PARTITION BY channel ORDER BY build_id DESC) THEN 0 ELSE 1 END AS brk
      FROM {name}_triplets
    """)
    define(f"{name}_runs", f"""
      SELECT *, sum(brk) OVER (PARTITION BY channel ORDER BY build_id DESC) AS run FROM {name}_marked
    """)
    define(f"{name}_builds", f"""
      SELECT channel, version, build_id, pub_ms FROM {name}_runs
      QUALIFY run = max(run) OVER (PARTITION BY channel, version)
    """)


_runs("norc", "NOT contains(v, 'rc')", "2023")
_runs("any", "true", "2023")
_runs("all_time", "NOT contains(v, 'rc')", "2015")
_runs("recent", "NOT contains(v, 'rc')", "20231226")
_runs("beta_only", "NOT contains(v, 'rc') AND contains(v, 'b')", "2015")

PUB_TEXT = "strftime(epoch_ms(pub_ms), '%Y-%m-%d %H:%M:%S')"
PUB_DAY = "CAST(epoch_ms(pub_ms) AS DATE)"
RELEASE_MAJOR = "TRY_CAST(nullif(regexp_extract(version, '^(\\d+)\\.\\d+$', 1), '') AS INTEGER)"

define("every_build", """
  SELECT * FROM norc_builds WHERE channel IN ('release', 'beta') UNION ALL SELECT * FROM any_builds WHERE channel = 'aurora'
""")
define("release_list", """
  SELECT chan, version, CASE WHEN version LIKE '60.%' THEN '2017-11-14'
    ELSE coalesce(strftime(min(day), '%Y-%m-%d'), '2015-01-01') END AS day
  FROM (
    SELECT normalized_channel AS chan,
      CASE WHEN normalized_channel = 'beta' THEN app_display_version ELSE app_version END AS version,
      CASE WHEN app_build_id > '2016' THEN CAST(strptime(substr(app_build_id, 1, 8), '%Y%m%d') AS DATE) END AS day
    FROM clients WHERE normalized_channel IN ('release', 'beta', 'esr')
  ) GROUP BY chan, version
""")
define("releases", """
  SELECT 'app-' || version || (CASE WHEN chan = 'esr' THEN 'esr' ELSE '' END) AS release_label,
    CAST(day AS DATE) AS date,
    CASE WHEN chan = 'beta' THEN 'dev'
      WHEN length(version) - length(replace(version, '.', '')) = 1 THEN 'major' ELSE 'stability' END AS category,
    version
  FROM release_list WHERE chan <> 'beta' OR contains(version, 'b')
""")
define("majors", """
  SELECT CASE WHEN regexp_matches(version, '^\\d+\\.0$') THEN split_part(version, '.', 1) ELSE version END AS version,
    CAST(day AS DATE) AS date
  FROM release_list
  WHERE chan = 'release' AND (regexp_matches(version, '^\\d+\\.0$') OR version LIKE '60.%')
""")
define("release_dates", f"""
  SELECT date, version, 'releases' AS src, CAST(split_part(version, '.', 1) AS INTEGER) AS maj_vers
  FROM releases WHERE category = 'dev' AND date > DATE '2019-01-01'
  UNION ALL
  SELECT min({PUB_DAY}) AS date, version, 'registry' AS src, CAST(split_part(version, '.', 1) AS INTEGER) AS maj_vers
  FROM norc_builds WHERE channel = 'beta' AND NOT contains(version, 'b') GROUP BY version
""")
define("date_lookup", f"""
  SELECT 'release' AS chan, version, arg_max(date, release_label) AS rls_date FROM releases
  WHERE category IN ('major', 'stability') AND date > DATE '2019-01-01' AND release_label NOT LIKE '%esr' GROUP BY version
  UNION ALL SELECT 'beta', version, max(date) FROM release_dates GROUP BY version
  UNION ALL SELECT 'aurora', version, max({PUB_DAY}) FROM any_builds WHERE channel = 'aurora' GROUP BY version
""")
define("dated_builds", f"""
  SELECT channel AS chan, build_id, version, {PUB_DAY} AS pub_day FROM norc_builds WHERE channel IN ('release', 'beta')
""")
define("matched", """
  SELECT c.*, b.version AS reg_dvers, b.pub_day, coalesce(c.dvers = b.version, false) AS same_dv
  FROM counts c LEFT JOIN dated_builds b ON c.chan = b.chan AND c.bid = b.build_id
""")

# ---- Curves ----


def unified(source: str) -> str:
    return f"""
      SELECT submission_date, chan AS channel, os,
        CASE WHEN chan = 'release' THEN vers WHEN chan = 'nightly' THEN substr(bid, 1, 8) ELSE dvers END AS vers,
        dvers, bid, n
      FROM {source} WHERE chan IN ('release', 'beta', 'aurora', 'nightly')
    """


def curves_as_of(name: str, as_of: str) -> None:
    """The curve table a run as of a date computes."""
    define(f"{name}_unified", unified("counts") + f" AND submission_date <= DATE '{as_of}' AND submission_date >= DATE '{as_of}' - 330")
    define(f"{name}_newest", f"""
      SELECT channel, os, arg_max(vers, bid || vers) AS newest FROM {name}_unified
      WHERE (channel, os, bid) IN (SELECT (channel, os, max(bid)) FROM {name}_unified GROUP BY channel, os)
      GROUP BY channel, os
    """)
    define(f"{name}_top_n", f"""
      SELECT channel, os, vers, dvers, max(n) AS n FROM {name}_unified WHERE dvers IS NOT NULL GROUP BY ALL
    """)
    define(f"{name}_top", f"""
      SELECT channel, os, vers, dvers AS top_dvers FROM {name}_top_n
      QUALIFY row_number() OVER (PARTITION BY channel, os, vers ORDER BY n DESC, dvers) = 1
    """)
    define(f"{name}_days", f"""
      SELECT channel, os, submission_date, CAST(sum(n) AS BIGINT) AS total FROM {name}_unified GROUP BY ALL
    """)
    define(f"{name}_rows", f"""
      SELECT channel, os, vers, submission_date, string_agg(bid, chr(10) ORDER BY bid) AS build_ids,
        min(bid) AS min_build_id, CAST(sum(n) AS BIGINT) AS n
      FROM {name}_unified WHERE vers IS NOT NULL GROUP BY channel, os, vers, submission_date
    """)
    define(f"{name}_shares", f"""
      SELECT r.*, d.total AS day_chan_os_sum, r.n / d.total AS n_pct, r.vers = w.newest AS latest_vers,
        length(build_ids) <= 8 AS old_build, t.top_dvers
      FROM {name}_rows r JOIN {name}_days d USING (channel, os, submission_date)
        JOIN {name}_newest w USING (channel, os) LEFT JOIN {name}_top t USING (channel, os, vers)
    """)
    define(f"{name}_first", f"""
      SELECT *, min(CASE WHEN n_pct > 0.01 THEN submission_date END) OVER v AS first_day,
        min(submission_date) OVER v AS earliest
      FROM {name}_shares WINDOW v AS (PARTITION BY channel, os, vers)
    """)
    define(name, f"""
      SELECT vers, submission_date, build_ids, min_build_id, n, day_chan_os_sum,
        day_chan_os_sum AS day_chan_os_sum_min, n_pct, latest_vers, old_build,
        first_day AS vers_min_date_above_npct,
        CAST(submission_date - first_day + CASE WHEN earliest - first_day = -1 THEN 1 ELSE 0 END AS INTEGER) AS days_post_pub,
        os, channel,
        channel = 'release' AND length(vers) - length(replace(vers, '.', '')) = 1 AS is_major,
        channel = 'beta' AND NOT contains(vers, 'b') AS RC,
        CASE WHEN channel = 'nightly' THEN top_dvers END AS dvers
      FROM {name}_first
      WHERE submission_date > DATE '{as_of}' - CASE channel WHEN 'release' THEN 210 ELSE 90 END
    """)


curves_as_of("curves", "2024-01-30")
curves_as_of("curves20", "2024-01-20")

define("ranks", """
  SELECT os, vers, channel, CAST(rank() OVER (PARTITION BY os, channel ORDER BY min(build_ids) DESC) AS INTEGER)
    AS nth_recent_release
  FROM curves WHERE NOT old_build GROUP BY os, vers, channel
""")
define("top_curves", """
  SELECT c.*, r.nth_recent_release FROM curves c JOIN ranks r USING (os, vers, channel)
  WHERE nth_recent_release <= CASE channel WHEN 'release' THEN 12 WHEN 'nightly' THEN 30 ELSE 18 END
""")
define("shown", """
  SELECT *, nth_recent_release AS show_n, vers AS version, strftime(submission_date, '%a') AS week_day,
    days_post_pub AS days_after_release, vers_min_date_above_npct AS release_day
  FROM top_curves
  WHERE days_post_pub > -2
    AND days_post_pub <= CASE channel WHEN 'release' THEN 30 WHEN 'nightly' THEN 7 ELSE 10 END
""")
