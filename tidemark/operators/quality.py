"""Data checks. Each returns the violating rows, so an empty result means clean data."""

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import types as T
from pyspark.sql import functions as F

from tidemark import config
from tidemark.functions.dates import as_date

Day = dt.date | str


class QualityError(ValueError):
    """Raised by jobs that must not go on with bad input."""


def malformed_dates(df: DataFrame, column: str) -> DataFrame:
    """Rows whose date text does not start with ``yyyy-MM-dd`` digits, NULL included."""
    return df.where(~F.coalesce(F.col(column).rlike(config.DATE_PREFIX_PATTERN), F.lit(False)))


def duplicate_dates(table: DataFrame, first: Day, last: Day) -> DataFrame:
    """Dates of a requested range that the table already has, with their row counts."""
    loaded = table.where(F.col("submission_date").between(as_date(first), as_date(last)))
    return loaded.groupBy("submission_date").agg(F.count("*").alias("n_rows"))


def loaded_of(table: DataFrame, requested: DataFrame) -> DataFrame:
    """Dates of a list, which need not be a range, that the table already has, with their row counts."""
    loaded = table.groupBy("submission_date").agg(F.count("*").alias("n_rows"))
    return loaded.join(requested.select("submission_date").distinct(), "submission_date", "left_semi")


def uneven_denominators(curves: DataFrame) -> DataFrame:
    """Curve rows whose smallest and largest denominator differ."""
    return curves.where(~F.col("day_chan_os_sum").eqNullSafe(F.col("day_chan_os_sum_min")))


def not_one_to_one(df: DataFrame, a: str, b: str) -> DataFrame:
    """Values of ``a`` that occur with more than one value of ``b``.

    Pairs are deduplicated first, so a value with very many rows stays cheap.
    """
    return df.select(a, b).distinct().groupBy(a).agg(F.count(b).alias("n_values")).where("n_values > 1")


def changed_rows(before: DataFrame, after: DataFrame) -> DataFrame:
    """Rows of ``before`` that an added-column join lost or altered, and rows it added."""
    return _unmatched(before, after.select(*before.columns), "problem", "lost", "added")


def early_submissions(counts: DataFrame, published: str, min_days: int = -1) -> DataFrame:
    """Counts submitted earlier than ``min_days`` relative to their build's publication."""
    days = F.date_diff(F.col("submission_date"), F.col(published))
    return counts.withColumn("days_post_pub", days).where(F.col("days_post_pub") < min_days)


def non_integer_majors(majors: DataFrame, version: str = "version") -> DataFrame:
    """Versions of the major list that are not whole numbers."""
    number = F.col(version).try_cast("double")
    return majors.where(number.isNull() | (number != F.floor(number)))


def value_differences(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows found in only one of two tables, told apart by ``side``."""
    return _unmatched(first, second.select(*first.columns), "side", "first", "second")


def _unmatched(one: DataFrame, other: DataFrame, name: str, in_one: str, in_other: str) -> DataFrame:
    """Rows that one frame has more often than the other, as often as it has more, each frame read once."""
    signed = one.withColumn("_n", F.lit(1)).unionAll(other.withColumn("_n", F.lit(-1)))
    surplus = signed.groupBy(*one.columns).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    return surplus.select(
        *one.columns,
        F.when(F.col("_n") > 0, in_one).otherwise(in_other).alias(name),
        F.explode(F.array_repeat(F.lit(1), F.abs("_n").cast("int"))).alias("_n"),
    ).drop("_n")


def lost_casts(df: DataFrame, schema: T.StructType, overrides: dict[str, T.DataType] | None = None) -> DataFrame:
    """Per column, how many values a conforming cast would turn into NULL."""
    target = target_types(df, schema, overrides)
    lost = [
        F.count(F.when(F.col(c).isNotNull() & F.col(c).cast("string").try_cast(kind).isNull(), 1)).alias(c)
        for c, kind in target.items()
    ]
    counts = df.agg(*lost)
    return counts.unpivot([], list(target), "column_name", "n_lost").where("n_lost > 0")


def target_types(
    df: DataFrame, schema: T.StructType, overrides: dict[str, T.DataType] | None = None
) -> dict[str, T.DataType]:
    """Declared type of each column of ``df``; unknown columns and bad overrides are errors."""
    overrides = overrides or {}
    unknown = set(overrides) - set(df.columns)
    if unknown:
        raise QualityError(f"overrides name unknown columns: {sorted(unknown)}")
    wrong = {c: kind for c, kind in overrides.items() if not isinstance(kind, T.DataType)}
    if wrong:
        raise QualityError(f"overrides must be Spark types: {wrong}")
    declared = {f.name: f.dataType for f in schema.fields} | overrides
    missing = [c for c in df.columns if c not in declared]
    if missing:
        raise QualityError(f"columns without a declared type: {missing}")
    return {c: declared[c] for c in df.columns}


def _cast(name: str, kind: T.DataType, strict: bool) -> Column:
    """A cast that fails, or gives NULL, whatever the session's ANSI setting says."""
    value = F.col(name).try_cast(kind)
    if not strict:
        return value.alias(name)
    said = F.concat(F.lit(f"column {name} cannot hold "), F.col(name).cast("string"))
    return F.when(F.col(name).isNotNull() & value.isNull(), F.raise_error(said)).otherwise(value).alias(name)


def conform(
    df: DataFrame, schema: T.StructType, overrides: dict[str, T.DataType] | None = None, strict: bool = True
) -> DataFrame:
    """Casts to the declared types, in schema order. An unreadable value fails the job; ``lost_casts`` counts them.

    With ``strict`` off it becomes NULL, for looking at data only: no writer uses that.
    """
    target = target_types(df, schema, overrides)
    absent = [f.name for f in schema.fields if f.name not in target]
    if absent:
        raise QualityError(f"declared columns are missing: {absent}")
    return df.select(
        *[
            F.col(f.name) if df.schema[f.name].dataType == target[f.name] else _cast(f.name, target[f.name], strict)
            for f in schema.fields
        ]
    )
