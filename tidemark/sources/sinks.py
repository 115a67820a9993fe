"""Writers. Tables are partitioned by date and conformed to their schema before each write."""

import datetime as dt
import uuid

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import types as T
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions.dates import as_date
from tidemark.operators.aggregates import distinct_dates
from tidemark.operators.joins import not_loaded
from tidemark.operators.quality import conform
from tidemark.sources import files
from tidemark.sources.tables import is_path, read_table

Day = dt.date | str
CSV_NULL = "NA"
CURRENT = "current"


def _by_date(df: DataFrame) -> DataFrameWriter:
    """A writer with one file per date where dates are small; adaptive execution splits big ones."""
    return df.hint("rebalance", "submission_date").write.partitionBy("submission_date")


def _append_to_table(df: DataFrame, target: str) -> None:
    """Adds rows to a catalog table, creating it on first use. Inserts go by the table's column order."""
    spark = df.sparkSession
    if spark.catalog.tableExists(target):
        df.hint("rebalance", "submission_date").select(*spark.table(target).columns).write.insertInto(target)
    else:
        _by_date(df).saveAsTable(target)


def load_clients(clients: DataFrame, target: str) -> None:
    """Client days, partitioned by date so that a scan of some dates reads their files only. Each date is written whole."""
    rows = conform(clients, schemas.CLIENTS_DAILY)
    if is_path(target):
        _by_date(rows).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(target)
    else:
        _replace_dates_in_table(rows, target)


def append_counts(counts: DataFrame, target: str) -> None:
    """Adds rows; nothing already in the table is replaced."""
    rows = conform(counts, schemas.VERSION_COUNTS)
    if is_path(target):
        _by_date(rows).mode("append").parquet(target)
    else:
        _append_to_table(rows, target)


def load_dates(counts: DataFrame, target: str) -> None:
    """Writes the rows' dates, each as a whole: set aside first and moved in when the job commits.

    Only to be used for dates that the run has claimed. Other dates stay, and so does what other runs write meanwhile.
    """
    rows = conform(counts, schemas.VERSION_COUNTS)
    if is_path(target):
        _by_date(rows).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(target)
    else:
        _replace_dates_in_table(rows, target)


def replace_counts(counts: DataFrame, target: str) -> None:
    """Full replace: drops what the table holds before loading."""
    writer = _by_date(conform(counts, schemas.VERSION_COUNTS)).option("partitionOverwriteMode", "static").mode("overwrite")
    if is_path(target):
        writer.parquet(target)
    else:
        writer.saveAsTable(target)


def export_csv(counts: DataFrame, target: str) -> None:
    """Interchange files with a header line and ``NA`` for NULL."""
    conform(counts, schemas.VERSION_COUNTS).write.mode("errorifexists").csv(target, header=True, nullValue=CSV_NULL)


def import_csv(spark: SparkSession, source: str, schema: T.StructType = schemas.VERSION_COUNTS) -> DataFrame:
    return spark.read.schema(schema).csv(source, header=True, nullValue=CSV_NULL)


def loaded_dates(spark: SparkSession, target: str, first: Day) -> DataFrame:
    """Dates a table holds from ``first`` on, as a literal list.

    The list is read before the write so that the write does not depend on its own target; it has
    at most one entry per calendar day.
    """
    days = [row[0] for row in distinct_dates(read_table(spark, target), first).collect()]
    return spark.createDataFrame([(d,) for d in days], T.StructType([T.StructField("submission_date", T.DateType())]))


def _replace_dates_in_table(df: DataFrame, target: str) -> None:
    """Writes the dates of ``df`` into a catalog table, each as a whole; other dates stay."""
    spark = df.sparkSession
    if not spark.catalog.tableExists(target):
        _by_date(df).saveAsTable(target)
        return
    setting = "spark.sql.sources.partitionOverwriteMode"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "dynamic")  # inserts into tables heed the session only
    try:
        rows = df.hint("rebalance", "submission_date").select(*spark.table(target).columns)
        rows.write.insertInto(target, overwrite=True)
    finally:
        spark.conf.set(setting, before)


def append_new_dates(
    curves: DataFrame, target: str, first: Day, target_exists: bool = True, returns: str | None = "all"
) -> DataFrame | None:
    """Appends the rows whose date the table does not hold yet.

    Only partitions of new dates are written, each as a whole, so a repeated or restarted run, or two at
    once, leave the same table. ``returns``: ``"all"`` rows, the ``"upload"`` ones, or None.
    """
    if returns not in ("all", "upload", None):
        raise ValueError(f"returns must be 'all', 'upload' or None, not {returns!r}")
    rows = conform(curves, schemas.CURVES)
    fresh = rows.where(F.col("submission_date") >= as_date(first))
    if target_exists:
        fresh = not_loaded(fresh, loaded_dates(curves.sparkSession, target, first))
    if is_path(target):
        _by_date(fresh).option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(target)
    else:
        _replace_dates_in_table(fresh, target)
    return {"all": rows, "upload": fresh, None: None}[returns]


def write_chart_feed(feed: DataFrame, target: str, run_date: Day) -> None:
    """Chart rows as JSON lines, in a new folder per run with one folder per channel and system inside.

    A small file under ``feeds`` names the folder of each run date, and of the current run. It is replaced in one step after
    all rows are written, so a reader finds one whole feed, the old one or the new one. The folders just replaced stay
    for readers that are at work; older ones that no file names any more are removed.
    """
    spark, target = feed.sparkSession, target.rstrip("/")
    name = f"{as_date(run_date)}-{uuid.uuid4().hex}"
    feed.hint("rebalance", "channel", "os").write.partitionBy("channel", "os").json(f"{target}/runs/{name}")
    replaced = set()
    for which in (str(as_date(run_date)), CURRENT):
        replaced.add(files.read(spark, f"{target}/feeds/{which}"))
        files.replace(spark, f"{target}/feeds/{which}", name)
    named = {files.read(spark, f"{target}/feeds/{which}") for which in files.names(spark, f"{target}/feeds") if which[0] != "."}
    for folder in files.names(spark, f"{target}/runs"):
        # Unfinished folders of other runs carry no success mark yet.
        if folder not in named | replaced and files.read(spark, f"{target}/runs/{folder}/_SUCCESS") is not None:
            files.delete(spark, f"{target}/runs/{folder}")


def read_chart_feed(spark: SparkSession, target: str, run_date: Day | None = None) -> DataFrame:
    """The feed of one run date, or the current one."""
    which, target = CURRENT if run_date is None else str(as_date(run_date)), target.rstrip("/")
    name = files.read(spark, f"{target}/feeds/{which}")
    if name is None:
        raise FileNotFoundError(f"no chart feed {which} under {target}")
    return spark.read.schema(schemas.CHART_FEED).json(f"{target}/runs/{name}")
