"""Build registry and release dates."""

import datetime as dt
import itertools
import json
import random

import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.sources import registry as R
from tidemark.sources import releases as L


def triplets(spark, builds):
    return spark.createDataFrame([("beta", v, b, 0) for b, v in builds], "channel string, version string, build_id string, pub_ms long")


def brute_last_runs(builds):
    newest_first = sorted(builds, reverse=True)
    runs = {v: {b for b, _ in group} for v, group in itertools.groupby(newest_first, key=lambda x: x[1])}
    return sorted((v, b) for v, ids in runs.items() for b in ids)


def test_last_run_of_the_literal_case(spark, rows):
    builds = [(f"2024010{9 - i}000000", v) for i, v in enumerate(["71", "70", "71", "71", "70"])]
    got = rows(R.last_runs(triplets(spark, builds)), "version", "build_id")
    assert got == [("70", "20240105000000"), ("71", "20240106000000"), ("71", "20240107000000")]
    assert R.last_runs(triplets(spark, builds), keep_all_runs=True).count() == 5


@pytest.mark.parametrize("seed, days", [(1, 1), (2, 3), (3, 30), (4, 200)])
def test_last_runs_match_brute_force(spark, rows, seed, days):
    """From all builds on one day to about one build a day."""
    rng = random.Random(seed)
    ids = {f"{dt.date(2024, 1, 1) + dt.timedelta(days=rng.randrange(days)):%Y%m%d}{rng.randrange(24):02}{rng.randrange(60):02}00" for _ in range(300)}
    builds = [(b, rng.choice(["70", "71", "72"])) for b in ids]
    assert rows(R.last_runs(triplets(spark, builds)), "version", "build_id") == brute_last_runs(builds)


def records(spark, data):
    defaults = {"pub_ms": 0, "platform": "win64", "locale": "en-US", "channel": "beta", "product": "desktop"}
    names = schemas.REGISTRY_RECORDS.fieldNames()
    return spark.createDataFrame([tuple({**defaults, **d}[n] for n in names) for d in data], schemas.REGISTRY_RECORDS)


def test_registry_filters_and_string_minimum(spark, rows):
    data = [
        {"build_id": "20240102", "version": "70.0b3", "pub_ms": 5},
        {"build_id": "20240102", "version": "70.0b10", "pub_ms": 3},
        {"build_id": "20240102", "version": "70.0b10", "pub_ms": 3},
        {"build_id": "20240102", "version": "1.0b1", "platform": "linux64"},
        {"build_id": "20240102", "version": "1.0b1", "locale": "de"},
        {"build_id": "20240102", "version": "1.0b1", "product": "other"},
        {"build_id": "20240102", "version": "1.0b1", "channel": "esr"},
        {"build_id": "20230101", "version": "69.0b1"},
        {"build_id": "20240103", "version": "70.0"},
    ]
    docs = R.build_registry(records(spark, data), "2024", ["beta"], "desktop")
    assert rows(R.registry_triplets(docs), "version", "build_id", "pub_ms") == [("70.0b10", "20240102", 3)]
    with_release = R.registry_triplets(docs, keep_release=True)
    assert rows(with_release, "version") == [("70.0",), ("70.0b10",)]
    only = R.registry_triplets(docs, wanted_major=71, keep_release=True)
    assert only.isEmpty()


def test_registry_dump(spark, rows, tmp_path):
    bucket = lambda *keys: {"buckets": [{"key": k, "doc_count": 1} for k in keys]}
    lines = [
        {"key": "x", "version": bucket("70.0b3"), "pub_date": bucket(1567468867000, 1567468800000), "buildid": bucket("20190902191027")},
        {"key": "y", "version": bucket("70.0", "70.0b4"), "pub_date": bucket(1567641600000), "buildid": bucket("20190905000000")},
    ]
    (tmp_path / "dump.json").write_text("\n".join(json.dumps(line) for line in lines))
    dump = R.read_registry_dump(spark, str(tmp_path / "dump.json"), "beta")
    got = rows(R.registry_triplets(dump))
    assert got == [("beta", "70.0b3", "20190902191027", 1567468800000), ("beta", "70.0b4", "20190905000000", 1567641600000)]


def test_version_build_list(spark, rows):
    builds = spark.createDataFrame(
        [("70.0b3", b) for b in ("20190902120346", "20190902191027", "20190902160204")], "version string, build_id string"
    )
    assert rows(R.version_build_list(builds)) == [("70.0b3", "'20190902191027', '20190902160204', '20190902120346'")]
    named = builds.withColumn("chan", F.when(F.col("build_id") < "20190902150000", "aurora").otherwise("beta"))
    assert rows(R.version_build_list(named, ["chan"])) == [
        ("aurora", "70.0b3", "'20190902120346'"), ("beta", "70.0b3", "'20190902191027', '20190902160204'")]


def test_channel_rules_in_one_pass(spark, rows):
    data = [
        {"build_id": "20240102000000", "version": v, "channel": c, "pub_ms": 1704153600000}
        for c in ("beta", "aurora", "release") for v in ("70.0", "70.0b6rc")
    ]
    data += [{"build_id": "20240104000000", "version": "70.0.1", "channel": "release"}]
    data += [{"build_id": "20240105000000", "version": "70.0b6rc", "channel": c} for c in ("beta", "aurora")]
    builds = R.channel_builds(records(spark, data), "2024", product="desktop")
    assert rows(builds, "chan", "version", "build_id") == [
        ("aurora", "70.0", "20240102000000"), ("aurora", "70.0b6rc", "20240105000000"),
        ("beta", "70.0", "20240102000000"),
        ("release", "70.0", "20240102000000"), ("release", "70.0.1", "20240104000000"),
    ]
    assert rows(R.of_channel(builds, "release"), "version", "major", "is_major") == [("70.0", 70, True), ("70.0.1", None, False)]
    assert "major" not in R.of_channel(builds, "beta").columns


def test_recent_builds_use_the_as_of_date(spark, rows):
    data = [{"build_id": b, "version": "70.0b1"} for b in ("20230105000000", "20230107000000")]
    assert rows(R.recent_builds(records(spark, data), "beta", "2024-01-01"), "build_id") == [("20230107000000",)]


def release_table(spark, data):
    document = json.dumps({label: {"date": d, "category": c, "version": v} for label, d, c, v in data})
    return L.product_releases(spark.createDataFrame([(document,)], "json string"))


def test_product_and_tracked_releases(spark, rows):
    listed = release_table(spark, [
        ("a-70.0", "2019-10-22", "major", "70.0"), ("a-70.0.1", "2019-10-31", "stability", "70.0.1"),
        ("a-68.2.0esr", "2019-10-22", "stability", "68.2.0"), ("a-64.0", "2018-12-11", "major", "64.0"),
        ("a-71.0b3", "2019-10-25", "dev", "71.0b3"), ("a-y", "2019-01-01", "major", "63.9"),
    ])
    assert listed.count() == 6
    assert rows(L.release_rows(listed), "version") == [("70.0",), ("70.0.1",)]


def builds_at(spark, data, chan="beta"):
    stamp = lambda s: dt.datetime.fromisoformat(s)
    return spark.createDataFrame([(v, b, stamp(d), chan) for v, b, d in data], "version string, build_id string, date timestamp_ntz, chan string")


def test_beta_release_dates(spark, rows):
    listed = release_table(spark, [("a", "2019-10-25", "dev", "71.0b3"), ("b", "2018-10-25", "dev", "64.0b3"), ("c", "2019-10-22", "major", "70.0")])
    beta = builds_at(spark, [("71.0", "b2", "2019-12-03 18:00:00"), ("71.0", "b1", "2019-11-28 23:59:59"), ("71.0b3", "b0", "2019-10-25 01:00:00")])
    dates = L.beta_release_dates(listed, beta)
    assert rows(dates) == [
        (dt.date(2019, 10, 25), "71.0b3", "releases", 71), (dt.date(2019, 11, 28), "71.0", "registry", 71),
    ]
    assert [r["version"] for r in L.latest_releases(dates, "2019-11-28", 5).collect()] == ["71.0b3"]
    assert [r["version"] for r in L.latest_releases(dates, "2020-01-01", 2).collect()] == ["71.0b3", "71.0"]


def test_major_releases(spark, rows):
    majors = spark.createDataFrame([(json.dumps({"70": "2019-10-22", "14.0.1": "2012-07-17", "71": "2019-12-03"}),)], "json string")
    got = L.major_releases(majors)
    assert rows(got) == [(dt.date(2019, 10, 22), "70", 70), (dt.date(2019, 12, 3), "71", 71)]
    assert L.current_major(got).first()[0] == 71


def test_latest_release_chooses_by_number(spark):
    frame = spark.createDataFrame([(["60.0.4", "71.0", "9.0"],), (["70.0b3", "70.0b10"],), (["70.0b3", "70.0"],), ([],)], "v array<string>")
    chosen = [r[0] for r in frame.select(R.latest_release(F.col("v"))).collect()]
    assert chosen == ["71.0", "70.0b10", "70.0", None]


def test_a_broken_line_of_a_dump_fails_the_job(spark, tmp_path):
    line = '{"version":{"buckets":[{"key":"70.0b3"}]},"pub_date":{"buckets":[{"key":1}]},"buildid":{"buckets":[{"key":"20240102"}]}}'
    path = tmp_path / "dump.json"
    path.write_text(line + "\n")
    assert R.read_registry_dump(spark, str(path), "beta").count() == 1
    path.write_text(line + "\n" + line[:40] + "\n")
    with pytest.raises(Exception, match="MALFORMED_RECORD|Malformed"):
        R.read_registry_dump(spark, str(path), "beta").collect()
    assert [r.value for r in R.unreadable_lines(spark.read.text(str(path))).collect()] == [line[:40]]


def test_an_unreadable_release_document_fails_the_job(spark, rows):
    good = '{"app-70.0": {"date": "2024-01-02", "category": "major", "version": "70.0", "product": "app"}}'
    undated = good.replace("2024-01-02", "soon")
    documents = spark.createDataFrame([(good,), (good[:30],), (undated,)], "json string")
    for broken, said in ((good[:30], "MALFORMED_RECORD|Malformed"), (undated, "not a date: soon")):
        with pytest.raises(Exception, match=said):
            L.product_releases(documents.where(F.col("json").isin(good, broken))).collect()
    listed = L.unreadable_documents(documents, schemas.PRODUCT_RELEASES, "date")
    assert rows(listed, "label", "problem") == [("app-70.0", "date"), (None, "document")]
    majors = spark.createDataFrame([('{"70": "2024-01-02", "14.0.1": "2024-01-03"}',)], "json string")
    with pytest.raises(Exception, match="not a whole number: 14.0.1"):
        L.major_releases(majors).collect()
    assert rows(L.major_releases(majors, strict=False), "vers") == [(70,), (None,)]
