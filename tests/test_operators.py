"""Ranks, joins, filters and aggregates."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from tidemark.operators import aggregates as A
from tidemark.operators import filters
from tidemark.operators import joins as J
from tidemark.operators import ranks as R
from tidemark.plans import serve

DAY = dt.date(2024, 1, 1)


@pytest.mark.parametrize("ties", [True, False])
def test_position_matches_a_plain_window(spark, ties):
    rng = random.Random(4)
    bid = lambda: None if rng.random() < 0.05 else f"202401{rng.randrange(1, 29):02}{rng.randrange(3):02}"
    # one group holds most rows
    data = [("hot" if rng.random() < 0.7 else rng.choice("abc"), bid(), i) for i in range(1500)]
    df = spark.createDataFrame(data, "k string, bid string, id int")
    order = [F.desc_nulls_last("bid")] if ties else [F.desc_nulls_last("bid"), F.asc("id")]
    number = F.rank() if ties else F.row_number()
    want = df.withColumn("pos", number.over(W.partitionBy("k").orderBy(*order)))
    got = R.position_by(df, ["k"], F.substring("bid", 1, 8), order, "pos", ties)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()


def curves(spark, data):
    return spark.createDataFrame(data, "os string, vers string, channel string, build_ids string, old_build boolean, submission_date date, days_post_pub int")


def test_rank_recent_shares_ranks_and_skips(spark, rows):
    data = [("Linux", v, "release", b, old, DAY, 0) for v, b, old in [
        ("72.0", "20240103100000", False), ("71.0", "20240102100000", False), ("71.0.1", "20240102100000", False),
        ("71.0.1", "20240104100000", False), ("70.0", "20240101100000", False), ("other", "20231001", True)]]
    got = rows(serve.rank_versions(curves(spark, data)), "vers", "nth_recent_release")
    assert got == [("70.0", 4), ("71.0", 2), ("71.0.1", 2), ("72.0", 1)]
    top = serve.top_ranks(curves(spark, data), {"release": 2})
    assert rows(top, "vers", "nth_recent_release") == [("71.0", 2), ("71.0.1", 2), ("72.0", 1)]


def test_top_n_limits_rows_before_the_shuffle(spark):
    data = [("Linux", f"{i}.0", "release", f"202401011{i:05}", False, DAY, 0) for i in range(50)]
    top = serve.top_ranks(curves(spark, data), {"release": 12, "beta": 18})
    assert top.count() == 12
    assert "WindowGroupLimit" in top._jdf.queryExecution().optimizedPlan().toString()


def test_top_versions_reads_strictly_before(spark, rows):
    data = [("Linux", "70.0", "release", "20240101100000", False, DAY + dt.timedelta(days=i), i) for i in range(3)]
    assert serve.top_versions(curves(spark, data), "2024-01-02").count() == 1


def test_order_versions_breaks_ties_by_version(spark, rows):
    data = [("Linux", v, "beta", "20240101100000", False, DAY, 0) for v in ("b", "a")] + [("Darwin", "a", "beta", "1", True, DAY, 0)]
    order = serve.order_versions(curves(spark, data))
    assert rows(order, "os", "vers", "recent_version_order") == [("Linux", "a", 1), ("Linux", "b", 2)]
    joined = J.join_channel_order(curves(spark, data), order)
    assert rows(joined, "os", "vers", "recent_version_order") == [("Darwin", "a", None), ("Linux", "a", 1), ("Linux", "b", 2)]


def test_display_window_bounds(spark, rows):
    data = [("Linux", str(d), c, "x", False, DAY, d) for c, limit in [("release", 30), ("beta", 10), ("aurora", 10), ("nightly", 7)]
            for d in (-2, -1, limit, limit + 1, None)]
    got = filters.display_window(curves(spark, data))
    assert rows(got, "channel", "days_post_pub") == [
        ("aurora", -1), ("aurora", 10), ("beta", -1), ("beta", 10), ("nightly", -1), ("nightly", 7), ("release", -1), ("release", 30)]


def test_channel_window_is_strict(spark, rows):
    days = [DAY - dt.timedelta(days=k) for k in (90, 89)]
    data = [("Linux", "70.0", c, "x", False, d, 0) for c in ("beta", "release", "esr") for d in days]
    got = filters.channel_window(curves(spark, data), DAY)
    assert rows(got, "channel", "submission_date") == [("beta", days[1]), ("release", days[0]), ("release", days[1])]


def test_release_date_last_duplicate_wins(spark, rows):
    dates = spark.createDataFrame([("beta", "70.0b3", DAY, "1"), ("beta", "70.0b3", dt.date(2023, 1, 1), "2"), ("aurora", "70.0b4", DAY, "1")],
                                  "chan string, version string, date date, ordinal string")
    counts = spark.createDataFrame([("beta", "70.0b3", 1), ("beta", "70.0b4", 2), ("beta", None, 3)], "chan string, dvers string, n int")
    assert rows(J.join_release_date(counts, dates), "n", "rls_date") == [(1, dt.date(2023, 1, 1)), (2, None), (3, None)]


def test_full_compare_with_null_keys(spark, rows):
    prod = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, n int")
    test = spark.createDataFrame([("a", 1), (None, 2), ("b", 4)], "k string, n int")
    assert rows(J.full_compare(prod, test, ["k", "n"])) == [("a", 1, True, True), ("b", 3, True, False), ("b", 4, False, True), (None, 2, True, True)]


def test_compare_counts(spark, rows):
    prod = spark.createDataFrame([("a", 1000), ("b", 100), ("c", 7), ("d", 0)], "k string, n long")
    test = spark.createDataFrame([("a", 1005), ("b", 110), ("e", 1), ("d", 3)], "k string, n long")
    got = J.compare_counts(prod, test, ["k"])
    assert rows(got, "k", "np", "nt", "df", "dfp", "dfpa") == [("b", 100, 110, 10, 10.0, 10.0), ("c", 7, 0, -7, -100.0, 100.0)]


def test_mark_new_rows_and_presence(spark, rows):
    today = spark.createDataFrame([("a", 1), ("b", 2)], "k string, n long")
    yesterday = spark.createDataFrame([("a", 9)], "k string, n long")
    assert rows(J.mark_new_rows(today, yesterday, ["k"])) == [("a", 1, 9, False), ("b", 2, None, True)]
    assert rows(J.with_presence(today, yesterday.union(yesterday), ["k"], "seen")) == [("a", 1, True), ("b", 2, False)]


def test_current_against_other(spark, rows):
    starts = [("68.0", "2019-07-09"), ("69.0", "2019-09-03"), ("69.0.1", "2019-09-18"), ("69.0.2", "2019-10-03")]
    day = lambda s, i=0: dt.date.fromisoformat(s) + dt.timedelta(days=i)
    data = [(day("2019-07-09", i), "67.0", 90) for i in range(12)] + [(day("2019-07-09", i), "68.0", 10 * i) for i in range(1, 12)]
    data += [(day("2019-10-03"), "69.0.2", 1), (day("2019-10-03"), "69.0.1", 2)]
    got = A.current_against_other(spark.createDataFrame(data, "submission_date date, app_version string, n long"), starts)
    first = [r for r in rows(got, "vers", "day", "cur", "all_n", "percent") if r[0] == "68.0"]
    assert sorted(first)[:3] == [("68.0", 0, 0, 90, 0.0), ("68.0", 1, 10, 100, 10.0), ("68.0", 2, 20, 110, 18.2)]
    assert len(first) == 10
    assert ("69.0.2", 0, 1, 3, 33.3) in rows(got, "vers", "day", "cur", "all_n", "percent")
    assert ("69.0", 0, 0, 3, 0.0) in rows(got, "vers", "day", "cur", "all_n", "percent")


def test_argmax_ties_take_the_smallest(spark, rows):
    df = spark.createDataFrame([("a", "y", 5), ("a", "x", 5), ("a", "z", 1), ("b", None, 2)], "k string, v string, n int")
    assert rows(A.argmax(df, ["k"], "n", "v")) == [("a", "x"), ("b", None)]
    assert rows(A.argmax_back(df, ["k"], "n", "v", "top").select("k", "v", "top")) == [("a", "x", "x"), ("a", "y", "x"), ("a", "z", "x"), ("b", None, None)]


def test_latest_date_of_an_empty_table(spark):
    empty = spark.createDataFrame([], "submission_date date")
    assert tuple(A.latest_date(empty).first()) == (None, None)


def test_log_histogram(spark, rows):
    df = spark.createDataFrame([("beta", n) for n in (1, 10, 100, 1000)] + [("esr", 5)], "chan string, n long")
    assert rows(A.log_histogram(df, "beta", bins=3)) == [(0, 1), (1, 1), (2, 2)]
    assert rows(A.log_histogram(df, "esr")) == [(0, 1)]


def test_peak_and_distribution(spark, rows):
    data = [("Linux", DAY, "20231231093000", 5), ("Linux", DAY, "20231230093000", 5), ("Linux", DAY, "20231101", 2), ("Linux", DAY, "20180101093000", 99)]
    peak = A.peak_build(spark.createDataFrame(data, "os string, submission_date date, bid string, n long"))
    assert rows(peak) == [("Linux", DAY, "20231230", 5 / 12, 2)]
    dist = spark.createDataFrame([("a", 1), ("a", 1), ("a", 3), ("b", 2)], "os string, dif int")
    assert rows(A.value_distribution(dist, ["os"], "dif"), "os", "dif", "n", "cum_freq") == [("a", 1, 2, 2 / 3), ("a", 3, 1, 1.0), ("b", 2, 1, 1.0)]


def test_running_share_ends_at_one(spark, rows):
    df = spark.createDataFrame([("a", 1, 2), ("a", 1, 2), ("a", 2, 4)], "k string, d int, n long")
    assert rows(R.running_share(df, ["k"], "d", "n", "cdf")) == [("a", 1, 4, 0.5), ("a", 2, 4, 1.0)]


def test_first_and_last_per(spark, rows):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z")], "k string, d int, v string")
    assert rows(R.first_per(df, ["k"], ["d"])) == [("a", 1, "y"), ("b", 5, "z")]
    assert rows(R.last_per(df, ["k"], ["d"])) == [("a", 2, "x"), ("b", 5, "z")]


def test_a_table_with_null_keys_equals_itself(spark, rows):
    df = spark.createDataFrame([(None, "x", 5), ("a", None, 7), ("a", "x", 1)], "k string, v string, n long")
    assert J.compare_counts(df, df, ["k", "v"]).isEmpty()
    assert rows(J.mark_new_rows(df, df.where("k is null"), ["k", "v"]), "n", "n2", "new") == [(1, None, True), (5, 5, False), (7, None, True)]
    assert rows(A.argmax_back(df, ["k"], "n", "v", "best"), "n", "best") == [(1, None), (5, "x"), (7, None)]


def test_sums_of_many_values_run_in_parts(spark):
    """One hot group with as many values as rows, NULL and repeated ones among them, against one plain window."""
    rows = spark.range(12_000).select(
        F.when(F.col("id") % 40 == 0, "b").otherwise("a").alias("k"),
        F.when(F.col("id") % 11 != 0, F.pmod(F.xxhash64("id"), F.lit(9000))).alias("v"), (F.col("id") % 5).alias("n"),
    )
    got = A.value_distribution(rows, ["k"], "v", part_rows=300)
    along = W.partitionBy("k").orderBy("v").rowsBetween(W.unboundedPreceding, W.currentRow)
    whole = W.partitionBy("k")
    want = rows.groupBy("k", "v").agg(F.count("*").alias("n")).select(
        "k", "v", "n", (F.col("n") / F.sum("n").over(whole)).alias("freq"), (F.sum("n").over(along) / F.sum("n").over(whole)).alias("cum_freq")
    )
    assert got.exceptAll(want).isEmpty() and got.count() == want.count()
    share = R.running_share(rows, ["k"], "v", "n", "cdf", part_rows=300)
    steps = rows.groupBy("k", "v").agg(F.sum("n").alias("n"))
    want = steps.withColumn("cdf", F.try_divide(F.sum("n").over(along), F.sum("n").over(whole)))
    assert share.exceptAll(want).isEmpty() and share.count() == want.count()
    parts = R.with_parts(steps, ["k"], F.col("v"), 300).groupBy("k", "_part").agg(
        F.count("*").alias("n"), F.min("v").alias("low"), F.max("v").alias("high")
    ).orderBy("k", "_part").collect()
    hot = [r for r in parts if r.k == "a" and r.low is not None]
    assert len(hot) > 10 and max(r.n for r in parts) < 1200
    assert all(x.high < y.low for x, y in zip(hot, hot[1:]))


def test_column_profile(spark, rows):
    data = [("a", 1, None, True), ("a", 1, 2.5, None), ("b", None, 2.5, True), (None, 3, None, False)]
    frame = spark.createDataFrame(data, "k string, x int, y double, z boolean")
    assert rows(A.column_profile(frame)) == sorted([
        ("k", "string", 4, 3, 2), ("x", "int", 4, 3, 2), ("y", "double", 4, 2, 1), ("z", "boolean", 4, 3, 2)])
    assert ("a", "x", "int", 2, 2, 1) in rows(A.column_profile(frame, ["k"])) and A.column_profile(frame.limit(0)).isEmpty()
    assert rows(A.null_profile(frame, ["k"]), "k", "column_name", "filled") == rows(spark.createDataFrame(
        [("a", "x", 1.0), ("b", "x", 0.0), (None, "x", 1.0), ("a", "y", 0.5), ("b", "y", 1.0), (None, "y", 0.0),
         ("a", "z", 0.5), ("b", "z", 1.0), (None, "z", 1.0)], "k string, c string, f double"))


def test_first_release_is_looked_up_once_per_version(spark, rows):
    counts = spark.createDataFrame(
        [("beta", "Linux", "70.0", "70.0b1", 1), ("beta", "Linux", "70.0", "70.0b2", 2), ("beta", "Linux", None, None, 3), ("beta", "Linux", "71.0", "x", 4)],
        "chan string, os string, vers string, dvers string, n long")
    dates = spark.createDataFrame([("beta", "70.0b1", "2024-01-05", 1), ("beta", "70.0b2", "2024-01-03", 1)], "chan string, version string, date string, ordinal int")
    assert rows(J.with_first_release(counts, dates), "n", "vers_pub_date") == [(1, "2024-01-03"), (2, "2024-01-03"), (3, None), (4, None)]
