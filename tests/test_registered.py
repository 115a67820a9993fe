"""Every registered query against its SQL, and what its plan must not contain."""

import pytest
from plans import metric, scans

import __spark_entry__ as entry
from checks import fixtures
from checks.compare import compare, connect
from checks.registered import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"

#: Scans of a query's final plan, at most, where it is not one (none is left of an input found empty). The client days are a join of two tables.
CLIENTS = dict.fromkeys((
    "flt_stratified_sample set_union_samples flt_fixed_windows prj_build_floor prj_build_floor_const prj_fold_rare join_denominator "
    "agg_version_counts agg_day_totals agg_reduced_counts agg_daily_by_version agg_current_vs_other"
).split(), 2)
#: Rows and their ranks or flags, two tables, or a table and a bound of it taken beforehand.
BOTH_SIDES = dict.fromkeys((
    "set_union_channels prj_channel_unify prj_display_cols flt_recent_slider flt_min_bid set_union_releases join_release_date join_build_registry "
    "join_full_compare join_compare_counts join_new_rows join_anti_dates join_exists_flag dq_min_days dq_value_diff "
    "dq_unreadable_documents agg_log_hist flt_version_kind win_nth_release win_top_n win_group_share top_latest_releases sort_output"
).split(), 2)
MORE = dict.fromkeys((
    "join_rank_using join_channel_order join_anti_versions dq_row_preserving agg_match_rate agg_match_rate_null_date top_k_rows "
    "agg_top_mismatch win_vers_pub_date src_channel_builds"
).split(), 3) | {"job_version_dim": 4}
SCANS = CLIENTS | BOTH_SIDES | MORE


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_sql():
    assert set(QUERIES) <= set(entry.queries()) and set(QUERIES) == set(ORACLES)


def test_entry(spark):
    assert entry.entry(spark).count() == 1151


@pytest.mark.parametrize("key, column", [
    ("src_channel_builds", "is_major"), ("join_build_registry", "same_dv"), ("agg_match_rate", "n_true"), ("win_dedupe_last", None),
    ("dq_min_days", None),
])
def test_the_data_reaches_both_branches(spark, key, column):
    rows = entry.queries()[key](spark, "/root/testdata/sf0.01").collect()
    assert rows and (column is None or len({bool(r[column]) for r in rows}) == 2)


def test_the_data_holds_odd_rows(spark):
    sf = "/root/testdata/sf0.01"
    counts, run = fixtures.counts(spark, sf), lambda key: entry.queries()[key](spark, sf)
    assert not counts.where("bid IS NULL").isEmpty() and not counts.where("dvers IS NULL").isEmpty()
    assert not fixtures.clients(spark, sf).where("os IS NULL").isEmpty()
    kinds = {(r.beta_only, r.with_release, r.with_rc) for r in run("flt_version_kind").collect()}
    assert {(True, True, True), (False, True, False), (False, False, True)} <= kinds
    builds = run("job_build_dim").collect()
    assert {r.chan for r in builds} == {"release", "beta", "aurora"} and any("rc" in r.version for r in builds)
    noon = {(r.nearest_day - r.build_day).days for r in builds if r.build_id.endswith("120000")}
    assert noon == {0, 1} and {(r.nearest_day - r.build_day).days for r in builds} == {0, 1}


@pytest.mark.parametrize("key", list(QUERIES))
def test_query_matches_sql(spark, con, key):
    frames = []

    def run(session, sf_dir):
        frames.append(entry.queries()[key](session, sf_dir))
        return frames[0]

    verdict, _ = compare(spark, con, SF, run, entry.oracle_sql()[key])
    assert verdict.startswith("ok"), verdict
    assert len(scans(frames[0])) <= SCANS.get(key, 1)
    plan = frames[0]._jdf.queryExecution().executedPlan().toString()
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "MapInPandas", "ExistingRDD"):
        assert operator not in plan


def test_the_fact_scan_reads_the_files_of_its_dates(spark):
    df = entry.queries()["src_fact_scan"](spark, SF)
    assert df.count() > 0
    df.collect()
    (scan,) = scans(df)
    assert "submission_date" in scan.partitionFilters().toString()
    assert metric(scan, "numPartitions") == 16 and metric(scan, "numFiles") >= 16
    whole = spark.read.parquet(fixtures.stored(spark, SF, "clients", None))
    whole.collect()
    (every,) = scans(whole)
    assert metric(every, "numPartitions") == 30 and metric(every, "numFiles") > metric(scan, "numFiles")
