"""Command line of the batch jobs, for ``spark-submit run_job.py <step> ...``.

``daily`` runs ``counts``, ``curves`` and ``serve`` one after the other, and stops at the first error. Each
step stops with an error rather than pass on bad input.
"""

import argparse
import datetime as dt

from tidemark import config
from tidemark.plans import jobs
from tidemark.session import build_session
from tidemark.sources.tables import read_table


def parse(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--as-of", default=str(dt.date.today()), help="date of the run, yyyy-MM-dd")
    steps = parser.add_subparsers(dest="step", required=True)

    def step(name: str, text: str) -> argparse.ArgumentParser:
        sub = steps.add_parser(name, help=text)
        sub.add_argument("source", help="table name or folder")
        sub.add_argument("target", help="table name or folder")
        return sub

    counts = step("counts", "append the daily counts of dates not loaded yet")
    counts.add_argument("--first", help="first date; the day after the newest loaded one by default")
    counts.add_argument("--last", default="1", help="last date, or how many days before --as-of")
    counts.add_argument("--app-name")
    counts.add_argument("--drop-first", action="store_true", help="replace the table")
    counts.add_argument("--no-check-dates", action="store_true", help="load dates again that are loaded")
    counts.add_argument("--stale-hours", type=float, help="take over dates that a run has held for longer")
    counts.add_argument("--new", action="store_true", help="the target does not exist yet")

    curves = step("curves", "append the curve rows of dates not loaded yet")
    curves.add_argument("--new", action="store_true", help="the target does not exist yet")

    backfill = step("backfill", "curves of every date of a range, into a new target")
    backfill.add_argument("first")
    backfill.add_argument("last")

    serve = step("serve", "write the chart rows of the newest versions")
    daily = steps.add_parser("daily", help="all three steps for one day, with tables that exist")
    for name in ("clients", "counts", "curves", "feed"):
        daily.add_argument(name, help="table name or folder")
    daily.add_argument("--app-name")
    for sub in (serve, daily):
        sub.add_argument(
            "--versions", type=int, nargs=4, metavar=("RELEASE", "BETA", "AURORA", "NIGHTLY"),
            default=[config.TOP_VERSIONS[c] for c in config.CURVE_CHANNELS],
        )
    return parser.parse_args(argv)


def main(argv: list[str] | None = None) -> None:
    args = parse(argv)
    spark = build_session(f"tidemark {args.step}")
    if args.step == "daily":
        loaded = jobs.run_daily(
            read_table(spark, args.clients), args.counts, args.curves, args.feed, args.as_of,
            app_name=args.app_name, n_versions=dict(zip(config.CURVE_CHANNELS, args.versions)),
        )
        print("nothing to load" if loaded is None else f"loaded {loaded[0]} to {loaded[1]}")
        return
    source = read_table(spark, args.source)
    if args.step == "counts":
        last = int(args.last) if args.last.isdigit() else args.last
        loaded = jobs.run_counts(
            source, args.target, args.as_of, args.first, last, args.drop_first, not args.no_check_dates,
            target_exists=not args.new, app_name=args.app_name,
            stale_after=None if args.stale_hours is None else dt.timedelta(hours=args.stale_hours),
        )
        print("nothing to load" if loaded is None else f"loaded {loaded[0]} to {loaded[1]}")
    elif args.step == "curves":
        jobs.run_curves(source, args.target, args.as_of, target_exists=not args.new)
    elif args.step == "backfill":
        jobs.run_backfill(source, args.target, args.first, args.last)
    else:
        jobs.run_serve(source, args.target, args.as_of, n_versions=dict(zip(config.CURVE_CHANNELS, args.versions)))


if __name__ == "__main__":
    main()
