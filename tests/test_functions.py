"""Literal cases of the column functions."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.functions import builds as B
from tidemark.functions import dates as D
from tidemark.functions import versions as V


def evaluate(spark, fn, *values, schema=None):
    names = [f"c{i}" for i in range(len(values))]
    schema = schema or ", ".join(f"{n} string" for n in names)
    df = spark.createDataFrame([values], schema)
    return df.select(fn(*[F.col(n) for n in names]).alias("v")).first()["v"]


@pytest.mark.parametrize("version, want", [
    ("70.0b4", "70.0b04"), ("70.0", "70.0"), ("67.0b14", "67.0b14"), ("70.0b104", "70.0b104"),
    ("70.0b007", "70.0b07"), ("70.0b0", "70.0b00"), (None, None),
])
def test_sortable_beta(spark, version, want):
    assert evaluate(spark, V.sortable_beta, version) == want


def test_sortable_beta_needs_a_number(spark):
    with pytest.raises(Exception, match="no beta number: 70.0b3x"):
        evaluate(spark, V.sortable_beta, "70.0b3x")


@pytest.mark.parametrize("version, keep_rc, keep_release, want", [
    ("65.0b6rc", False, False, False), ("65.0b6rc", True, False, True),
    ("65.0", False, True, True), ("65.0", False, False, False),
    ("65.0b6", False, True, True), ("65.0b6", False, False, True),
])
def test_version_kind(spark, version, keep_rc, keep_release, want):
    assert evaluate(spark, lambda v: V.version_kind(v, keep_rc, keep_release), version) is want


@pytest.mark.parametrize("version, want", [("69.0", True), ("69.0b3", False), ("other", True)])
def test_is_rc(spark, version, want):
    assert evaluate(spark, V.is_rc, version) is want


@pytest.mark.parametrize("version, want", [("70.0", True), ("70.0.1", False), ("other", False), (None, None)])
def test_is_major(spark, version, want):
    assert evaluate(spark, V.is_major, version) is want


@pytest.mark.parametrize("version, want", [("70.0", 70), ("69.0.1", 69), ("70.0b3", None), ("68.10", None), ("9.0", None)])
def test_rc_major(spark, version, want):
    assert evaluate(spark, V.rc_major, version) == want


@pytest.mark.parametrize("version, want", [("70.0", 70), ("68.10", 68), ("69.0.1", None), ("70.0b3", None)])
def test_release_major(spark, version, want):
    assert evaluate(spark, V.release_major, version) == want


@pytest.mark.parametrize("version, want", [("71.0.2", 71), ("71", 71), ("other", None), (None, None)])
def test_major(spark, version, want):
    assert evaluate(spark, V.major, version) == want


def test_strict_major_fails_on_text(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        evaluate(spark, lambda v: V.major(v, strict=True), "other")


@pytest.mark.parametrize("version, want", [("70.0", "70rc20191020"), ("70.0b3", "70.0b3")])
def test_rc_label(spark, version, want):
    assert evaluate(spark, V.rc_label, version, "20191020") == want


@pytest.mark.parametrize("wanted, want", [(None, True), (71, False), ((70, 71), True), (lambda v: v > "7", True)])
def test_major_version(spark, wanted, want):
    assert evaluate(spark, lambda v: V.major_version(v, wanted), "70.0b3") is want


@pytest.mark.parametrize("chan, os, want", [
    ("esr", "Linux", 1095), ("release", "Linux", 730), ("release", "Darwin", 60), ("beta", "Linux", 100), ("nightly", "Linux", 60),
])
def test_build_lag_days(spark, chan, os, want):
    assert evaluate(spark, B.build_lag_days, chan, os) == want


@pytest.mark.parametrize("bid, want", [
    ("20190101000000", "20191102"), ("20191215093000", "20191215093000"), (None, None), ("20191102", "20191102"),
])
def test_floor_build(spark, bid, want):
    day = F.lit(dt.date(2020, 1, 1))
    floor = lambda b: B.floor_build(b, B.min_build_id(F.lit("nightly"), F.lit("Darwin"), day))
    assert evaluate(spark, floor, bid) == want
    assert evaluate(spark, lambda b: B.floor_build(b, "20191102"), bid) == want


def test_min_build_id_offset(spark):
    day = F.lit(dt.date(2020, 3, 1))
    assert evaluate(spark, lambda c: B.min_build_id(c, F.lit("Linux"), day, 1), "beta") == "20191121"


@pytest.mark.parametrize("ids, want", [("20190101", True), ("20190101\n20190101", False), ("20190101000000", False)])
def test_is_old_build(spark, ids, want):
    assert evaluate(spark, B.is_old_build, ids) is want


@pytest.mark.parametrize("bid, want", [
    ("20240101115959", "2024-01-01"), ("20240101120001", "2024-01-02"), ("20240101", "2024-01-01"),
    # unix days 19723 (odd) and 19724 (even): noon goes to the even one
    ("20240101120000", "2024-01-02"), ("20240102120000", "2024-01-02"), ("other", None), (None, None),
])
def test_nearest_build_day(spark, bid, want):
    got = evaluate(spark, B.nearest_build_day, bid)
    assert got == (want and dt.date.fromisoformat(want))


@pytest.mark.parametrize("bid, want", [("20200101", "20190101"), ("20200102093000", "20200102")])
def test_clamp_nightly_day(spark, bid, want):
    assert evaluate(spark, B.clamp_nightly_day, bid) == want


def test_dates(spark):
    day = F.lit(dt.date(2020, 3, 1))
    assert evaluate(spark, lambda d: D.days_ago(day, 90), "x") == "20191202"
    assert evaluate(spark, lambda d: D.days_ago(day, 330, compact=False), "x") == "2019-04-06"
    assert evaluate(spark, lambda d: D.sql_date(d), "2020-03-01") == "2020-03-01"
    assert evaluate(spark, lambda d: D.days_since(day, d.cast("date")), "2020-02-28") == 2
    assert evaluate(spark, lambda d: D.days_since(day, d.cast("date")), None) is None


@pytest.mark.parametrize("zone", ["UTC", "America/Los_Angeles", "Asia/Kolkata"])
def test_epoch_ms_ignores_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        exact = evaluate(spark, D.epoch_ms, 1567468867123, schema="c0 long")
        whole = evaluate(spark, lambda m: D.epoch_ms(m, whole_seconds=True), 1567468867123, schema="c0 long")
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert exact == dt.datetime(2019, 9, 3, 0, 1, 7, 123000)
    assert whole == dt.datetime(2019, 9, 3, 0, 1, 7)
