"""Names and keys of jobs, tasks and documents."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poolscope.functions.casting import text_to_long


def is_analysis(job_class: Column, job_type: Column) -> Column:
    """User analysis, as opposed to central production."""
    return (F.lower(F.coalesce(job_class, F.lit("unknown"))) == "analysis") | (
        F.coalesce(job_type, F.lit("unknown")) == "Analysis"
    )


def source_name(global_job_id: Column) -> Column:
    """Scheduler that issued a global job id."""
    return F.coalesce(F.substring_index(global_job_id, "#", 1), F.lit("UNKNOWN"))


def document_id(global_job_id: Column, record_time: Column) -> Column:
    """Key of one observation of a job; NULL when either part is missing."""
    return F.concat(global_job_id, F.lit("#"), record_time.cast("string"))


def last_path_part(path: Column) -> Column:
    """Text after the last slash (the whole text without one)."""
    return F.substring_index(path, "/", -1)


def sortable_task_index(index: Column) -> Column:
    """Zero-padded task index so that text order is submission order.

    ``a-b`` becomes ``a.00000b``, digits are padded to six places, anything else is ``000000``.
    Longer numbers keep all their digits. A dashed index with a non-number part is NULL.
    """
    parts = F.transform(F.split(index, "-"), text_to_long)
    dashed = F.when(
        F.forall(parts, lambda n: n.isNotNull()),
        F.concat(
            F.get(parts, F.lit(0)).cast("string"), F.lit("."), _padded(F.get(parts, F.lit(1)))
        ),
    )
    return (
        F.when(index.contains("-"), dashed)
        .when(index.rlike(r"^\d+$"), _padded(index.try_cast("bigint")))
        .when(index.isNotNull(), F.lit("000000"))
    )


def _padded(number: Column) -> Column:
    """At least six digits; ``lpad`` alone would cut longer numbers."""
    text = number.cast("string")
    return F.when(F.length(text) < 6, F.lpad(text, 6, "0")).otherwise(text)


def bad_task_index(index: Column) -> Column:
    """A dashed task index with a part that is not a number."""
    return index.contains("-") & F.exists(
        F.split(index, "-"), lambda part: text_to_long(part).isNull()
    )


def dataset_part(dataset: Column, position: int) -> Column:
    """Part of a ``/primary/processed/.../tier`` name; Unknown for names with fewer parts."""
    parts = F.split(dataset, "/")
    part = F.element_at(parts, -1) if position < 0 else F.get(parts, F.lit(position))
    return F.when(F.size(parts) > 3, part).otherwise(F.lit("Unknown"))


# Fixed value: release names.
_RELEASE = r"^CMSSW_((\d*)_(\d*)_.*)"


def _release_number(release: Column, group: int) -> Column:
    """A version number without leading zeros."""
    return text_to_long(F.regexp_extract(release, _RELEASE, group)).cast("string")


def release_version(release: Column) -> Column:
    """Version text of a software release name, else Unknown."""
    return F.coalesce(
        F.nullif(F.regexp_extract(release, _RELEASE, 1), F.lit("")), F.lit("Unknown")
    )


def release_major(release: Column) -> Column:
    """``12_X_X`` for a release of major version 12, else Unknown."""
    return F.coalesce(F.concat(_release_number(release, 2), F.lit("_X_X")), F.lit("Unknown"))


def release_series(release: Column) -> Column:
    """``12_4_X`` for a release of the 12.4 series, else Unknown."""
    major, minor = _release_number(release, 2), _release_number(release, 3)
    return F.coalesce(F.concat(major, F.lit("_"), minor, F.lit("_X")), F.lit("Unknown"))


def bad_release(release: Column) -> Column:
    """A release name of the right shape whose version numbers are empty."""
    return release.rlike(r"^CMSSW_(_\d*_|\d+__)")
