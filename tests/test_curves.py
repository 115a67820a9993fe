"""The curve table against a plain Python version of the same rules, and its special cases."""

import datetime as dt
import random

import pytest
from plans import executed, scans
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark import config, schemas
from tidemark.operators.ranks import with_parts
from tidemark.plans import curves as K

START = dt.date(2024, 1, 1)


def counts(spark, data):
    return spark.createDataFrame(data, schemas.VERSION_COUNTS)


def brute_curves(data, as_of, months=config.CURVE_MONTHS, lookback=330):
    """Rows as dicts keyed like the table, computed for one as-of date."""
    as_of = dt.date.fromisoformat(as_of)
    unified = []
    for day, chan, os, dvers, vers, bid, n in data:
        if chan not in config.CURVE_CHANNELS or not as_of - dt.timedelta(days=lookback) <= day <= as_of:
            continue
        key = vers if chan == "release" else bid[:8] if chan == "nightly" else dvers
        unified.append((day, chan, os, key, dvers, bid, n))
    out = []
    for chan in config.CURVE_CHANNELS:
        for os in config.OSES:
            part = [r for r in unified if r[1] == chan and r[2] == os]
            if not part:
                continue
            latest = max((r[5], r[3] or "") for r in part)[1]
            totals: dict = {}
            for r in part:
                totals[r[0]] = totals.get(r[0], 0) + r[6]
            groups: dict = {}
            for r in part:
                if r[3] is not None:
                    groups.setdefault((r[3], r[0]), []).append(r)
            for vers in {v for v, _ in groups}:
                days = {d: g for (v, d), g in groups.items() if v == vers}
                share = {d: sum(r[6] for r in g) / totals[d] for d, g in days.items()}
                above = [d for d in days if share[d] > 0.01]
                first = min(above) if above else None
                ages = {d: (d - first).days if first else None for d in days}
                if first and min(ages.values()) == -1:
                    ages = {d: a + 1 for d, a in ages.items()}
                top = min(((-r[6], r[4]) for g in days.values() for r in g if r[4] is not None), default=(0, None))[1]
                for d, g in days.items():
                    if d <= as_of - dt.timedelta(days=30 * months[chan]):
                        continue
                    ids = sorted(r[5] for r in g)
                    out.append((
                        vers, d, "\n".join(ids), ids[0], sum(r[6] for r in g), totals[d], totals[d], share[d], vers == latest,
                        len("\n".join(ids)) <= 8, first, ages[d], os, chan,
                        chan == "release" and vers.count(".") == 1, chan == "beta" and "b" not in vers,
                        top if chan == "nightly" else None,
                    ))
    return sorted(out, key=str)


def random_counts(seed, days=40, versions=6):
    rng = random.Random(seed)
    rows: dict = {}
    for _ in range(2500):
        day = START + dt.timedelta(days=rng.randrange(days))
        chan = rng.choice([*config.CURVE_CHANNELS, "esr"])
        number = 70 + rng.randrange(versions)
        vers = rng.choice([f"{number}.0", f"{number}.0.1", "other"])
        dvers = rng.choice([vers, f"{number}.0b{rng.randrange(12)}", None]) if chan in ("beta", "aurora") else rng.choice([vers, f"{number}.0a1"])
        build = f"{START + dt.timedelta(days=rng.randrange(days)):%Y%m%d}"
        bid = build if vers == "other" or rng.random() < 0.1 else build + rng.choice(["093000", "213000"])
        n = rng.choice([1, 1, 1, 2, 5, 100])
        key = (day, chan, rng.choice(config.OSES), dvers, vers, bid)
        rows[key] = rows.get(key, 0) + n
    return [(*k, n) for k, n in rows.items()]


@pytest.mark.parametrize("seed", [1, 2])
def test_curves_match_brute_force(spark, seed):
    data = random_counts(seed)
    months = {"release": 1, "beta": 1, "aurora": 2, "nightly": 1}
    got = K.adoption_curves(counts(spark, data), "2024-02-05", months)
    assert got.columns == schemas.CURVES.fieldNames()
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute_curves(data, "2024-02-05", months)


def test_backfill_equals_a_run_per_date(spark):
    """Short windows, so that days and versions really leave them during the range."""
    data = random_counts(3)
    months = {"release": 1, "beta": 1, "aurora": 1, "nightly": 1}
    first, last, lookback = dt.date(2024, 1, 25), dt.date(2024, 2, 8), 9
    got = K.backfill_curves(counts(spark, data), first, last, months, lookback_days=lookback)
    want, loaded = [], set()
    for i in range((last - first).days + 1):
        rows = brute_curves(data, str(first + dt.timedelta(days=i)), months, lookback)
        want += [r for r in rows if r[1] not in loaded]
        loaded |= {r[1] for r in rows}
    assert sorted((tuple(r) for r in got.collect()), key=str) == sorted(want, key=str)


def one_version(spark, small, large):
    """One version on consecutive days: 0.5% of clients on ``small`` days, half on ``large`` days."""
    data = []
    for i in range(small + large):
        day = START + dt.timedelta(days=i)
        n = 1 if i < small else 100
        data += [(day, "release", "Linux", "70.0", "70.0", "20231230100000", n), (day, "release", "Linux", "60.0", "60.0", "20230101100000", 200 - n)]
    return counts(spark, data)


@pytest.mark.parametrize("small, large, want", [(1, 2, [0, 1, 2]), (2, 1, [-2, -1, 0]), (2, 0, [None, None]), (0, 2, [0, 1])])
def test_unoffset_days(spark, small, large, want):
    got = K.adoption_curves(one_version(spark, small, large), "2024-01-10").where("vers = '70.0'").orderBy("submission_date")
    assert [r["days_post_pub"] for r in got.collect()] == want


def test_unknown_channel_fails(spark):
    data = counts(spark, [(START, "esr", "Linux", "70.0", "70.0", "20231230100000", 1)])
    unified = K.unify_channels(data, ["esr"]).withColumn("vers", F.lit("70.0"))
    with pytest.raises(Exception, match="no curve is defined for channel esr"):
        K.with_channel_flags(K.collapse_builds(unified)).collect()


def test_versionless_rows_count_towards_the_day(spark, rows):
    data = [(START, "beta", "Linux", None, "70.0", "20231230100000", 3), (START, "beta", "Linux", "71.0b1", "71.0", "20231231100000", 1)]
    got = K.adoption_curves(counts(spark, data), "2024-01-10")
    assert rows(got, "vers", "n", "day_chan_os_sum", "n_pct") == [("71.0b1", 1, 4, 0.25)]


def test_nth_release(spark, rows):
    day = lambda i: START + dt.timedelta(days=i)
    data = [
        ("70.0", "20231201100000", day(1)), ("71.0", "20231202100000", day(3)), ("71.0", "20231202100000", day(3)),
        ("72.0", "20231203100000", None), ("73.0", "20231204100000", day(3)), ("other", "20231205100000", day(9)), ("60.0", "20231101", day(9)),
    ]
    frame = spark.createDataFrame([("release", "Linux", *r) for r in data], "channel string, os string, vers string, build_ids string, vers_min_date_above_npct date")
    got = rows(K.nth_release(frame).distinct(), "vers", "nth_recent_release")
    assert got == [("60.0", None), ("70.0", 3), ("71.0", 1), ("72.0", 4), ("73.0", 2), ("other", None)]


def test_sharing_builds_across_display_versions_keeps_duplicates(spark, rows):
    data = [(START, "release", "Linux", d, "70.0", "20231230100000", 1) for d in ("70.0", "70.0rc")]
    got = K.adoption_curves(counts(spark, data), "2024-01-10")
    assert rows(got, "build_ids", "n") == [("20231230100000\n20231230100000", 2)]


def test_curve_jobs_read_their_counts_once(spark, tmp_path):
    """One scan in the plan that ran, whole: no second one for pruning, and none for the other half of a backfill."""
    path = str(tmp_path / "counts")
    counts(spark, [
        (START + dt.timedelta(days=i), "release", "Linux", "70.0", "70.0", "20231230100000", 1) for i in range(29)
    ]).write.partitionBy("submission_date").parquet(path)
    stored = spark.read.parquet(path)
    for curves in (
        K.adoption_curves(stored, "2024-01-30"), K.daily_curves(stored, "2024-01-20", "2024-01-30"),
        K.backfill_curves(stored, "2024-01-20", "2024-01-30"),
    ):
        curves.collect()
        assert len(scans(curves)) == 1
        assert any(n.getClass().getSimpleName() == "ReusedExchangeExec" for n in executed(curves))


def test_many_undated_versions_are_numbered_in_parts(spark):
    """90 % of the versions of one channel and system have no first day: they are numbered as one window would, in parts."""
    data = spark.range(20_000).select(
        F.lit("release").alias("channel"), F.when(F.col("id") % 50 == 0, "Darwin").otherwise("Linux").alias("os"),
        F.concat(F.pmod(F.xxhash64("id"), F.lit(997)).cast("string"), F.lit("."), F.col("id").cast("string")).alias("vers"),
        F.lit("20231201100000").alias("build_ids"),
        F.when(F.col("id") % 10 == 0, F.date_add(F.lit(START), (F.col("id") % 7).cast("int"))).alias("vers_min_date_above_npct"),
    )
    order = W.partitionBy("channel", "os").orderBy(F.desc_nulls_last("vers_min_date_above_npct"), "vers")
    want = data.withColumn("nth_recent_release", F.row_number().over(order))
    got = K.nth_release(data, part_rows=500).select(*want.columns)
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
    parts = with_parts(data.where("vers_min_date_above_npct is null"), ["channel", "os"], F.col("vers"), 500)
    sizes = [r["count"] for r in parts.groupBy("os", "_part").count().collect()]
    assert len(sizes) > 30 and max(sizes) < 2000 and sum(sizes) == 18_000
