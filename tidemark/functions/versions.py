"""Version string columns. All are built-in expressions, so they stay inside codegen."""

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from tidemark import config


def is_major(version: Column) -> Column:
    """A release with exactly one dot, such as ``70.0``."""
    return F.length(version) - F.length(F.replace(version, F.lit("."), F.lit(""))) == 1


def is_rc(version: Column) -> Column:
    """No ``b`` in the version. The fold label has none either, so it counts as one."""
    return ~version.contains("b")


def major(version: Column, strict: bool = False) -> Column:
    """Leading integer; NULL for text, or an error when ``strict``."""
    lead = F.split_part(version, F.lit("."), F.lit(1))
    return lead.cast("int") if strict else lead.try_cast("int")


def release_major(version: Column) -> Column:
    """Major number of a plain ``major.minor`` version, else NULL."""
    return F.nullif(F.regexp_extract(version, config.RELEASE_PATTERN, 1), F.lit("")).cast("int")


def rc_major(version: Column) -> Column:
    """Major number of a release-candidate form, else NULL."""
    return F.nullif(F.regexp_extract(version, config.RC_PATTERN, 1), F.lit("")).cast("int")


def rc_label(version: Column, build_id: Column) -> Column:
    """``{major}rc{build id}`` for release candidates, the version itself otherwise."""
    return F.coalesce(F.concat(rc_major(version).cast("string"), F.lit("rc"), build_id), version)


def sortable_beta(version: Column) -> Column:
    """The beta number in two digits at least, so that strings sort in release order; ``b007`` is 7.

    What follows ``b`` must be a number: other text fails the job.
    """
    text = F.split_part(version, F.lit("b"), F.lit(2))
    whole = text.rlike(r"^\d+$")
    said = F.concat(F.lit("no beta number: "), version)
    number = F.when(whole, F.regexp_replace(text, r"^0+(?=\d)", "")).otherwise(F.raise_error(said))
    padded = F.lpad(number, F.greatest(F.length(number), F.lit(2)), F.lit("0"))
    return F.when(version.contains("b"), F.concat(F.split_part(version, F.lit("b"), F.lit(1)), F.lit("b"), padded)).otherwise(version)


def version_kind(version: Column, keep_rc: bool | Column = False, keep_release: bool | Column = False) -> Column:
    """True for versions to keep: no ``rc`` and a ``b`` in it, unless told otherwise."""
    keep_rc, keep_release = (k if isinstance(k, Column) else F.lit(k) for k in (keep_rc, keep_release))
    return (keep_rc | ~version.contains("rc")) & (keep_release | version.contains("b"))


MajorSpec = None | int | Iterable[int] | Callable[[Column], Column]


def major_version(version: Column, wanted: MajorSpec = None) -> Column:
    """Keeps all versions, one major, a set of majors, or those a predicate accepts."""
    if wanted is None:
        return F.lit(True)
    if callable(wanted):
        return wanted(version)
    if isinstance(wanted, int):
        return major(version) == wanted
    return major(version).isin(*wanted)
