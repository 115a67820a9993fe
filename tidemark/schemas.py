"""Table schemas. Every write is conformed to one of these first."""

from pyspark.sql import types as T

_STR, _LONG, _INT = T.StringType(), T.LongType(), T.IntegerType()
_DATE, _BOOL, _DOUBLE = T.DateType(), T.BooleanType(), T.DoubleType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in fields.items()])


CLIENTS_DAILY = _struct(
    submission_date=_DATE,
    app_name=_STR,
    os=_STR,
    normalized_channel=_STR,
    channel=_STR,
    sample_id=_INT,
    app_version=_STR,
    app_display_version=_STR,
    app_build_id=_STR,
)

VERSION_COUNTS = _struct(
    submission_date=_DATE,
    chan=_STR,
    os=_STR,
    dvers=_STR,
    vers=_STR,
    bid=_STR,
    n=_LONG,
)

CURVES = _struct(
    vers=_STR,
    submission_date=_DATE,
    build_ids=_STR,
    min_build_id=_STR,
    n=_LONG,
    day_chan_os_sum=_LONG,
    day_chan_os_sum_min=_LONG,
    n_pct=_DOUBLE,
    latest_vers=_BOOL,
    old_build=_BOOL,
    vers_min_date_above_npct=_DATE,
    days_post_pub=_INT,
    os=_STR,
    channel=_STR,
    is_major=_BOOL,
    RC=_BOOL,
    dvers=_STR,
)

REGISTRY_RECORDS = _struct(
    build_id=_STR,
    version=_STR,
    pub_ms=_LONG,
    platform=_STR,
    locale=_STR,
    channel=_STR,
    product=_STR,
)


def _buckets(key: T.DataType) -> T.StructType:
    return _struct(buckets=T.ArrayType(_struct(key=key)))


# One bucket of a registry dump: the distinct versions, dates and ids seen under a build id.
REGISTRY_BUCKET = _struct(version=_buckets(_STR), pub_date=_buckets(_LONG), buildid=_buckets(_STR))

PRODUCT_RELEASE = _struct(
    date=_STR,
    category=_STR,
    version=_STR,
    product=_STR,
    build_number=_INT,
    is_security_driven=_BOOL,
    description=_STR,
)
PRODUCT_RELEASES = T.MapType(_STR, PRODUCT_RELEASE)
MAJOR_RELEASES = T.MapType(_STR, _STR)

CHART_FEED = _struct(
    vers=_STR,
    submission_date=_DATE,
    n=_LONG,
    n_pct=_DOUBLE,
    build_ids=_STR,
    show_n=_INT,
    version=_STR,
    week_day=_STR,
    days_after_release=_INT,
    release_day=_DATE,
    channel=_STR,
    os=_STR,
)
