"""Sampling, folding and totals: literal cases and properties."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark import config, schemas
from tidemark.operators.filters import stratified_sample
from tidemark.operators.totals import with_share, with_total
from tidemark.plans import counts as C

DAY = dt.date(2024, 1, 5)


def client(channel="release", sample_id=1, os="Linux", version="70.0", build="20240101100000", day=DAY, shown=None, app="desktop"):
    return (day, app, os, channel, channel, sample_id, version, shown or version, build)


def clients(spark, data):
    return spark.createDataFrame(data, schemas.CLIENTS_DAILY)


@pytest.mark.parametrize("channel, kept", [
    ("release", [1]), ("esr", [0, 1, 25]), ("beta", [0, 1, 25, 26, 50]),
    ("aurora", [0, 1, 25, 26, 50, 51, 99, None]), ("nightly", [0, 1, 25, 26, 50, 51, 99, None]), ("default", []),
])
def test_sample_bounds(spark, channel, kept):
    ids = [0, 1, 25, 26, 50, 51, 99, None]
    got = stratified_sample(clients(spark, [client(channel, i) for i in ids])).select("sample_id").collect()
    assert [r[0] for r in got] == kept


def test_share_exactly_at_the_threshold_is_folded(spark, rows):
    data = [(DAY, "nightly", "Linux", "70.0a1", "70.0a1", "20240104100000", 199), (DAY, "nightly", "Linux", "60.0a1", "60.0a1", "20240103100000", 1)]
    counts = spark.createDataFrame(data, "submission_date date, chan string, os string, dvers string, vers string, bid string, n long")
    assert rows(C.fold_rare(counts), "vers", "bid", "n") == [("70.0a1", "20240104100000", 199), ("other", "20231105", 1)]
    kept = C.fold_rare(counts, threshold=0.004)
    assert rows(kept, "vers") == [("60.0a1",), ("70.0a1",)]


def random_clients(seed, n):
    rng = random.Random(seed)
    hot = client("nightly", 5, "Windows_NT", "75.0a1", "20240104100000")
    out = []
    for _ in range(n):
        if rng.random() < 0.4:  # one key holds a large part of all rows
            out.append(hot)
            continue
        channel = rng.choice(list(config.SAMPLE_BOUNDS))
        version = rng.choice([None, "70.0", "70.0.1", "71.0b3"])
        build = rng.choice([None, "20150101000000", "20231230100000", "20240102100000"])
        out.append(client(channel, rng.randrange(60), rng.choice(["Linux", "Darwin", "Android", None]), version, build,
                          DAY + dt.timedelta(days=rng.randrange(3)), rng.choice([None, version])))
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_counts_keep_every_sampled_client(spark, seed):
    data = random_clients(seed, 4000)
    sampled = [
        r for r in data
        if r[2] in config.OSES and (
            r[3] == "release" and r[5] == 1 or r[3] == "esr" and r[5] <= 25 or r[3] == "beta" and r[5] <= 50 or r[3] in ("aurora", "nightly")
        )
    ]
    counts = C.version_counts(clients(spark, data), DAY, "2024-01-07", "desktop", threshold=0.02)
    assert counts.agg(F.sum("n")).first()[0] == len(sampled)
    keys = counts.groupBy(*C.COUNT_KEYS).count()
    assert keys.where("count > 1").isEmpty()


def test_counts_match_brute_force(spark, rows):
    data = random_clients(7, 3000)
    got = {tuple(r[:6]): r[6] for r in C.version_counts(clients(spark, data), DAY, "2024-01-07", "desktop", threshold=0.02)
           .select(*C.COUNT_KEYS, "n").collect()}

    def lag(chan, os):
        return 1095 if chan == "esr" else 730 if (chan, os) == ("release", "Linux") else 100 if chan == "beta" else 60

    first: dict = {}
    for day, _, os, chan, _, sample_id, vers, dvers, bid in data:
        low, high = config.SAMPLE_BOUNDS[chan]
        if os not in config.OSES or (low is not None and sample_id < low) or (high is not None and sample_id > high):
            continue
        floor = (day - dt.timedelta(days=lag(chan, os))).strftime("%Y%m%d")
        bid = floor if bid is not None and bid < floor else bid
        first[day, chan, os, dvers, vers, bid] = first.get((day, chan, os, dvers, vers, bid), 0) + 1
    totals: dict = {}
    for key, n in first.items():
        totals[key[:3]] = totals.get(key[:3], 0) + n
    want: dict = {}
    for key, n in first.items():
        day, chan, os = key[:3]
        if not n / totals[key[:3]] > 0.02:
            key = (day, chan, os, "other", "other", (day - dt.timedelta(days=lag(chan, os) + 1)).strftime("%Y%m%d"))
        want[key] = want.get(key, 0) + n
    assert got == want


def test_shares_of_a_day_sum_to_one(spark):
    counts = C.count_versions(stratified_sample(clients(spark, random_clients(3, 2000)).where(F.col("os").isNotNull())))
    sums = with_share(counts).groupBy("submission_date", "chan", "os").agg(F.sum("share").alias("s"))
    assert sums.where(F.abs(F.col("s") - 1) > 1e-9).isEmpty()


def test_null_keys_form_a_group(spark, rows):
    df = spark.createDataFrame([("a", 1), ("a", 2), (None, 5)], "k string, n long")
    assert rows(with_total(df, ["k"])) == [("a", 1, 3), ("a", 2, 3), (None, 5, 5)]


def test_counts_scan_the_fact_once_and_prune_days(spark, tmp_path):
    path = str(tmp_path / "clients")
    clients(spark, random_clients(5, 500)).write.partitionBy("submission_date").parquet(path)
    counts = C.version_counts(spark.read.parquet(path), DAY, "2024-01-06", "desktop")
    counts.collect()
    plan = counts._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert plan.count("FileScan") == 1 and "ReusedExchange" in plan
    assert "PartitionFilters: [isnotnull(submission_date" in plan
    assert "channel#" not in plan.split("ReadSchema")[1].split("\n")[0]
