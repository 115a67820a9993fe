"""Times the headline jobs and prints one JSON line: median of three warm runs each, in seconds."""

import json
import os
import statistics
import time

from checks import fixtures as fx
from tidemark.plans import jobs, serve
from tidemark.plans.counts import version_counts
from tidemark.plans.curves import adoption_curves, backfill_curves
from tidemark.session import build_session, scratch_path
from tidemark.sources import registry, tables

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
WARMUPS, RUNS = 2, 3


def consume(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def stored_clients(spark):
    """The client days as a job finds them: stored by date, in several files a date."""
    def write(path):
        fx.clients(spark, SF_DIR).repartition(2 * int(CPUS)).write.partitionBy("submission_date").parquet(path)

    return spark.read.parquet(fx.stored(spark, SF_DIR, "clients", write))


def pipeline(spark) -> None:
    """All three steps, handing over through tables on disk."""
    counts, curves, feed = (scratch_path(spark, name) for name in ("counts", "curves", "feed"))
    jobs.run_counts(fx.clients(spark, SF_DIR), counts, "2024-01-31", fx.FIRST, target_exists=False, app_name=fx.APP)
    jobs.run_curves(tables.read_table(spark, counts), curves, fx.LAST, target_exists=False)
    jobs.run_serve(tables.read_table(spark, curves), feed, fx.DISPLAY_BEFORE)


QUERIES = {
    "counts_job": lambda s: consume(fx.fresh_counts(s, SF_DIR)),
    "counts_job_stored": lambda s: consume(version_counts(stored_clients(s), fx.FIRST, fx.LAST, fx.APP)),
    "curve_job": lambda s: consume(adoption_curves(fx.counts(s, SF_DIR), fx.LAST)),
    "backfill_10_days": lambda s: consume(backfill_curves(fx.counts(s, SF_DIR), "2024-01-20", fx.LAST)),
    "serve_top_n": lambda s: consume(serve.chart_feed(fx.curves(s, SF_DIR), fx.DISPLAY_BEFORE)),
    "build_dimension": lambda s: consume(
        registry.channel_builds(fx.registry_records(s, SF_DIR), fx.REGISTRY_FROM, product=fx.APP)
    ),
    "pipeline": pipeline,
}


def main() -> None:
    spark = build_session("bench", f"local[{CPUS}]", spark__sql__shuffle__partitions=CPUS, spark__ui__enabled="false",
                          spark__driver__memory="8g")
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name, run in QUERIES.items():
        for _ in range(WARMUPS):
            run(spark)
        times = []
        for _ in range(RUNS):
            start = time.perf_counter()
            run(spark)
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times), 3)
    scale = os.path.basename(SF_DIR.rstrip("/"))
    print(json.dumps({
        "metric": "sum of median seconds, headline jobs",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(scale.removeprefix("sf")) if scale.removeprefix("sf").replace(".", "").isdigit() else scale,
    }))


if __name__ == "__main__":
    main()
