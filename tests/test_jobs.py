"""The jobs: increments, guards, repeated runs, hand-over through tables."""

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

import run_job
from checks import fixtures as fx
from tidemark import schemas
from tidemark.operators.quality import QualityError
from tidemark.plans import jobs
from tidemark.session import scratch_path
from tidemark.sources import claims, files, sinks, tables

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def clients(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("facts") / "clients")
    fx.clients(spark, SF).write.parquet(path)
    return spark.read.parquet(path)


@pytest.fixture
def target(tmp_path):
    return str(tmp_path / "table")


def test_increment_then_nothing_missing(spark, clients, target):
    assert jobs.run_counts(clients, target, "2024-01-11", "2024-01-01", target_exists=False) == (dt.date(2024, 1, 1), dt.date(2024, 1, 10))
    assert jobs.run_counts(clients, target, "2024-01-31") == (dt.date(2024, 1, 11), dt.date(2024, 1, 30))
    loaded = tables.read_table(spark, target)
    n, rows = loaded.agg(F.sum("n")).first()[0], loaded.count()
    assert n == 3971 and rows == 1151
    assert jobs.run_counts(clients, target, "2024-01-31") is None
    assert tables.read_table(spark, target).count() == rows


def test_loaded_dates_are_refused_unless_told_otherwise(spark, clients, target):
    jobs.run_counts(clients, target, "2024-01-05", "2024-01-01", last="2024-01-03", target_exists=False)
    with pytest.raises(QualityError, match="2024-01-02, 2024-01-03"):
        jobs.run_counts(clients, target, "2024-01-05", "2024-01-02", last="2024-01-04")
    before = tables.read_table(spark, target).agg(F.sum("n")).first()[0]
    jobs.run_counts(clients, target, "2024-01-05", "2024-01-01", last="2024-01-03", check_dates=False)
    assert tables.read_table(spark, target).agg(F.sum("n")).first()[0] == 2 * before
    jobs.run_counts(clients, target, "2024-01-05", "2024-01-01", last="2024-01-03", check_dates=False, drop_first=True)
    assert tables.read_table(spark, target).agg(F.sum("n")).first()[0] == before


def test_first_date_must_be_known(spark, clients, target):
    with pytest.raises(QualityError, match="first date"):
        jobs.run_counts(clients, target, "2024-01-05", target_exists=False)
    spark.createDataFrame([], schemas.VERSION_COUNTS).write.parquet(target)
    with pytest.raises(QualityError, match="empty"):
        jobs.run_counts(clients, target, "2024-01-05")


def test_curves_append_only_new_dates(spark, target):
    counts = fx.counts(spark, SF)
    first = jobs.run_curves(counts, target, "2024-01-20", target_exists=False, returns="upload").count()
    stored = tables.read_table(spark, target)
    assert stored.count() == first and stored.agg(F.max("submission_date")).first()[0] == dt.date(2024, 1, 20)
    before = stored.select(*schemas.CURVES.fieldNames()).collect()

    upload = jobs.run_curves(counts, target, "2024-01-30", returns="upload")
    every = jobs.run_curves(counts, target, "2024-01-30", returns="all")
    assert upload.agg(F.min("submission_date")).first()[0] == dt.date(2024, 1, 21)
    assert jobs.run_curves(counts, target, "2024-01-30") is None
    stored = tables.read_table(spark, target).select(*schemas.CURVES.fieldNames())
    assert stored.count() == first + upload.count() == every.count()
    kept = stored.where("submission_date <= DATE '2024-01-20'")
    assert sorted(map(str, kept.collect())) == sorted(map(str, before))
    with pytest.raises(ValueError, match="returns"):
        jobs.run_curves(counts, target, "2024-01-30", returns="some")


def test_catalog_tables_as_targets(spark, clients):
    jobs.run_counts(clients, "daily_counts", "2024-01-11", "2024-01-01", target_exists=False)
    jobs.run_counts(clients, "daily_counts", "2024-01-31")
    assert jobs.run_counts(clients, "daily_counts", "2024-01-31") is None
    counts = tables.read_table(spark, "daily_counts")
    assert counts.agg(F.sum("n")).first()[0] == 3971
    jobs.run_curves(counts, "daily_curves", "2024-01-20", target_exists=False)
    for _ in range(2):
        jobs.run_curves(counts, "daily_curves", "2024-01-30")
    curves = tables.read_table(spark, "daily_curves")
    want = jobs.adoption_curves(fx.counts(spark, SF), "2024-01-30")
    assert curves.count() == want.count()
    assert curves.where("submission_date > DATE '2024-01-20'").select(*want.columns).exceptAll(want).isEmpty()
    jobs.run_counts(clients, "daily_counts", "2024-01-05", "2024-01-01", last="2024-01-03", check_dates=False, drop_first=True)
    assert tables.read_table(spark, "daily_counts").select("submission_date").distinct().count() == 3


def test_backfill_table_equals_daily_runs(spark, tmp_path):
    counts = fx.counts(spark, SF)
    daily, once = str(tmp_path / "daily"), str(tmp_path / "once")
    jobs.run_curves(counts, daily, "2024-01-27", target_exists=False)
    for day in ("2024-01-28", "2024-01-29", "2024-01-30"):
        jobs.run_curves(counts, daily, day)
    jobs.run_backfill(counts, once, "2024-01-27", "2024-01-30")
    a, b = (tables.read_table(spark, p).select(*schemas.CURVES.fieldNames()) for p in (daily, once))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() > 0


def test_chart_feed_folders(spark, tmp_path):
    feed = str(tmp_path / "feed")
    jobs.run_serve(fx.curves(spark, SF), feed, "2024-01-31", n_versions={"release": 3, "nightly": 2})
    (run,) = (tmp_path / "feed" / "runs").iterdir()
    folders = {p.parent.relative_to(run).as_posix() for p in run.rglob("*.json")}
    assert folders == {f"channel={c}/os={o}" for c in ("release", "nightly") for o in ("Windows_NT", "Darwin", "Linux")}
    assert {p.name: p.read_text() for p in (tmp_path / "feed" / "feeds").iterdir()} == {"2024-01-31": run.name, "current": run.name}
    assert sinks.read_chart_feed(spark, feed).where("show_n > 3").isEmpty()


@pytest.mark.parametrize("mode", ["dynamic", "static"])
def test_a_second_feed_leaves_nothing_of_the_first(spark, tmp_path, mode):
    feed, curves = str(tmp_path / "feed"), fx.curves(spark, SF)
    before = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    spark.conf.set("spark.sql.sources.partitionOverwriteMode", mode)
    try:
        jobs.run_serve(curves, feed, "2024-01-30")
        jobs.run_serve(curves.where("channel <> 'beta'"), feed, "2024-01-31")
        assert sinks.read_chart_feed(spark, feed).where("channel = 'beta'").isEmpty()
        assert not sinks.read_chart_feed(spark, feed, "2024-01-30").where("channel = 'beta'").isEmpty()
        jobs.run_serve(curves.where("channel <> 'beta'"), feed, "2024-01-30")
        assert sinks.read_chart_feed(spark, feed, "2024-01-30").where("channel = 'beta'").isEmpty()
    finally:
        spark.conf.set("spark.sql.sources.partitionOverwriteMode", before)


def test_a_reader_between_two_writes_sees_one_whole_feed(spark, tmp_path):
    """A reader that came before the switch, one that comes while the new rows are written, and one after."""
    feed, curves = str(tmp_path / "feed"), fx.curves(spark, SF)
    jobs.run_serve(curves, feed, "2024-01-30")
    early = sinks.read_chart_feed(spark, feed)
    before = sorted(map(str, early.collect()))
    seen, switch = [], files.replace

    def slow(session, path, text):
        seen.append(sorted(map(str, sinks.read_chart_feed(spark, feed).collect())))
        switch(session, path, text)

    sinks.files.replace = slow
    try:
        jobs.run_serve(curves.where("channel <> 'beta'"), feed, "2024-01-31")
    finally:
        sinks.files.replace = switch
    after = sorted(map(str, sinks.read_chart_feed(spark, feed).collect()))
    assert seen == [before, before] and after != before and after
    assert sorted(map(str, early.collect())) == before
    assert sinks.read_chart_feed(spark, feed, "2024-01-30").count() == len(before)
    for _ in range(3):
        jobs.run_serve(curves, feed, "2024-01-31")
    assert len(list((tmp_path / "feed" / "runs").iterdir())) == 3  # two that are named, and the one just replaced
    with pytest.raises(FileNotFoundError, match="2024-01-01"):
        sinks.read_chart_feed(spark, feed, "2024-01-01")


def by_date(spark, target) -> dict:
    return dict(tables.read_table(spark, target).groupBy("submission_date").agg(F.sum("n")).collect())


@pytest.mark.parametrize("catalog", [False, True])
def test_two_count_runs_at_once_load_each_date_once(spark, clients, tmp_path, monkeypatch, catalog):
    """The second run starts when the first has checked and claimed its dates, and before it writes."""
    once = str(tmp_path / "once")
    target = "counts_at_once" if catalog else str(tmp_path / "table")
    for name in (once, target):
        jobs.run_counts(clients, name, "2024-01-06", "2024-01-01", target_exists=False)
    jobs.run_counts(clients, once, "2024-01-21")
    write, inner = sinks.load_dates, []

    def interleaved(counts, to):
        monkeypatch.setattr(sinks, "load_dates", write)
        inner.append(jobs.run_counts(clients, to, "2024-01-11"))                      # all its dates are taken
        inner.append(jobs.run_counts(clients, to, "2024-01-26", last="2024-01-24"))   # some of them are
        write(counts, to)

    monkeypatch.setattr(sinks, "load_dates", interleaved)
    assert jobs.run_counts(clients, target, "2024-01-21") == (dt.date(2024, 1, 6), dt.date(2024, 1, 20))
    assert inner == [None, (dt.date(2024, 1, 21), dt.date(2024, 1, 24))]
    jobs.run_counts(clients, once, "2024-01-25")
    assert by_date(spark, target) == by_date(spark, once) and len(by_date(spark, once)) == 24


def test_count_runs_in_threads(spark, clients, target, tmp_path):
    once = str(tmp_path / "once")
    jobs.run_counts(clients, once, "2024-01-31", "2024-01-01", target_exists=False)
    with ThreadPoolExecutor(4) as pool:
        runs = [pool.submit(jobs.run_counts, clients, target, "2024-01-31", f"2024-01-{1 + 7 * i:02d}", target_exists=False) for i in range(4)]
        loaded = [run.result() for run in runs]
    assert any(loaded) and by_date(spark, target) == by_date(spark, once)


def test_dates_of_a_failed_run_are_loaded_by_the_next(spark, clients, target, monkeypatch):
    jobs.run_counts(clients, target, "2024-01-04", "2024-01-01", target_exists=False)
    monkeypatch.setattr(sinks, "load_dates", lambda *_: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        jobs.run_counts(clients, target, "2024-01-07")
    monkeypatch.undo()
    assert claims.failed(spark, target) == [dt.date(2024, 1, d) for d in (4, 5, 6)]
    assert jobs.run_counts(clients, target, "2024-01-10", "2024-01-08") == (dt.date(2024, 1, 4), dt.date(2024, 1, 9))
    assert sorted(d.day for d in by_date(spark, target)) == [1, 2, 3, 4, 5, 6, 8, 9]
    assert {word for word, *_ in claims.states(spark, target).values()} == {claims.DONE}


def test_dates_of_a_run_that_died_are_taken_over_once(spark, clients, target):
    jobs.run_counts(clients, target, "2024-01-04", "2024-01-01", target_exists=False)
    assert claims.claim(spark, target, [dt.date(2024, 1, 4), dt.date(2024, 1, 5)], "dead")
    assert jobs.run_counts(clients, target, "2024-01-06") is None
    assert jobs.run_counts(clients, target, "2024-01-06", stale_after=dt.timedelta(hours=1)) is None
    assert jobs.run_counts(clients, target, "2024-01-06", stale_after=dt.timedelta(0)) == (dt.date(2024, 1, 4), dt.date(2024, 1, 5))
    claims.settle(spark, target, [dt.date(2024, 1, 4)], "dead", claims.FAILED)  # it was not dead, but owns nothing now
    assert claims.failed(spark, target) == []
    with ThreadPoolExecutor(8) as pool:
        day = [dt.date(2024, 2, 1)]
        won = [*pool.map(lambda i: claims.claim(spark, target, day, str(i)), range(16))]
        taken = [*pool.map(lambda i: claims.claim(spark, target, day, f"next{i}", dt.timedelta(0)), range(1))]
    assert sum(map(len, won)) == 1 and taken == [day]


def test_csv_interchange_keeps_nulls(spark, tmp_path, rows):
    data = [(dt.date(2024, 1, 1), "beta", "Linux", None, "70.0", "20240101", 5)]
    path = str(tmp_path / "csv")
    sinks.export_csv(spark.createDataFrame(data, schemas.VERSION_COUNTS).coalesce(1), path)
    text = next((tmp_path / "csv").glob("part-*")).read_text().splitlines()
    assert text == ["submission_date,chan,os,dvers,vers,bid,n", "2024-01-01,beta,Linux,NA,70.0,20240101,5"]
    assert rows(sinks.import_csv(spark, path)) == data


def session_stub(master, **conf):
    """``spark.checkpoint.dir`` is fixed once a session runs, so these cases use a stand-in."""
    get = lambda key, default=None: conf.get(key.replace(".", "_"), default)
    return SimpleNamespace(conf=SimpleNamespace(get=get), sparkContext=SimpleNamespace(master=master))


def test_scratch_path_is_the_shared_folder(spark):
    cluster = session_stub("spark://host:7077", spark_checkpoint_dir="hdfs://shared/cut/")
    assert scratch_path(cluster, "x").startswith("hdfs://shared/cut/x-")
    assert scratch_path(cluster, "x") != scratch_path(cluster, "x")
    unset = session_stub("spark://host:7077", spark_sql_warehouse_dir="hdfs://warehouse")
    assert scratch_path(unset, "x").startswith("hdfs://warehouse/scratch/x-")
    assert scratch_path(spark, "x")


def test_version_dimension(spark, rows):
    versions = spark.createDataFrame([("70.0b3",), ("70.0",), (None,)], "version string")
    got = jobs.version_dimension(versions, versions)
    assert rows(got, "version", "is_major", "is_rc", "sortable", "major", "rc_major") == [
        ("70.0", True, True, "70.0", 70, 70), ("70.0b3", True, False, "70.0b03", 70, None)]


def test_command_line_runs_the_three_steps(spark, clients, tmp_path, capsys):
    facts, counts, curves, feed = (str(tmp_path / name) for name in ("facts", "counts", "curves", "feed"))
    clients.write.parquet(facts)
    run_job.main(["--as-of", "2024-01-11", "counts", facts, counts, "--first", "2024-01-01", "--new", "--app-name", fx.APP])
    run_job.main(["--as-of", "2024-01-31", "counts", facts, counts])
    assert capsys.readouterr().out.splitlines() == ["loaded 2024-01-01 to 2024-01-10", "loaded 2024-01-11 to 2024-01-30"]
    run_job.main(["--as-of", "2024-01-30", "curves", counts, curves, "--new"])
    run_job.main(["--as-of", "2024-01-31", "serve", curves, feed, "--versions", "12", "18", "18", "30"])
    shown = sinks.read_chart_feed(spark, feed)
    assert shown.count() > 0 and shown.where("channel = 'release' AND show_n > 12").isEmpty()


def test_text_that_is_no_number_stops_the_writer(spark, tmp_path):
    row = spark.createDataFrame([("2024-01-01", "beta", "Linux", "70.0b1", "70.0", "20240101", "12 clients")],
                                "submission_date string, chan string, os string, dvers string, vers string, bid string, n string")
    with pytest.raises(Exception, match="column n cannot hold 12 clients"):
        sinks.append_counts(row, str(tmp_path / "counts"))


def test_an_unknown_channel_stops_the_curve_job(spark, tmp_path):
    counts = fx.counts(spark, SF).limit(5)
    odd = counts.unionByName(counts.limit(1).withColumn("chan", F.lit("mystery")))
    with pytest.raises(Exception, match="no curve is defined for channel mystery"):
        jobs.run_curves(odd, str(tmp_path / "curves"), "2024-01-30", target_exists=False)


def test_a_table_started_twice_holds_each_date_once(spark):
    counts = fx.counts(spark, SF)
    for _ in range(2):  # neither run sees the other's dates
        jobs.run_curves(counts, "curves_twice", "2024-01-30", target_exists=False)
    assert tables.read_table(spark, "curves_twice").count() == jobs.adoption_curves(counts, "2024-01-30").count()


def test_the_daily_command(spark, clients, tmp_path, capsys):
    facts, counts, curves, feed = (str(tmp_path / name) for name in ("facts", "counts", "curves", "feed"))
    clients.write.parquet(facts)
    jobs.run_counts(clients, counts, "2024-01-29", "2024-01-01", target_exists=False)
    jobs.run_curves(tables.read_table(spark, counts), curves, "2024-01-28", target_exists=False)
    run_job.main(["--as-of", "2024-01-31", "daily", facts, counts, curves, feed])
    assert capsys.readouterr().out.splitlines() == ["loaded 2024-01-29 to 2024-01-30"]
    assert tables.read_table(spark, curves).agg(F.max("submission_date")).first()[0] == dt.date(2024, 1, 30)
    assert not sinks.read_chart_feed(spark, feed, "2024-01-31").isEmpty()
