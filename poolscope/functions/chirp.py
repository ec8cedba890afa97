"""Application I/O statistics, delivered as one map of ``ChirpCMSSW*`` numbers per job.

Everything is done inside the row with higher-order functions, so no statistic is ever
exploded and shuffled back together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# Naming scheme of the statistics.
PREFIX = "ChirpCMSSW"
_SITE_MARK = "IOSite"
_SITE_KEY = r"^ChirpCMSSW(.*?)IOSite_(.*)_(ReadBytes|ReadTimeMS)"
_KEPT_MAXIMUM = r"(LastUpdate|Events|MaxLumis|MaxFiles)$"
_BEFORE_NAME = r"^ChirpCMSSW(?:_(?:[^_]*_)?)?"


def _is_site_key(key: Column) -> Column:
    return key.startswith(PREFIX) & key.contains(_SITE_MARK)


def _base(key: Column) -> Column:
    return F.regexp_replace(key, r"_[^_]*$", "")


def malformed_site_key(stats: Column) -> Column:
    """Some per-site statistic has a name that does not follow the scheme."""
    return F.coalesce(
        F.exists(F.map_keys(stats), lambda k: _is_site_key(k) & ~k.rlike(_SITE_KEY)), F.lit(False)
    )


def site_io(stats: Column) -> Column:
    """Per-site reads that have both volume and time, ordered by site (an empty list for none)."""
    value = lambda base, kind: F.try_element_at(stats, F.concat(base, F.lit(kind)))
    bases = F.array_distinct(F.transform(F.filter(F.map_keys(stats), _is_site_key), _base))
    complete = F.filter(
        bases,
        lambda b: value(b, "_ReadBytes").isNotNull() & value(b, "_ReadTimeMS").isNotNull(),
    )
    part = lambda base, group: F.regexp_extract(
        F.concat(base, F.lit("_ReadBytes")), _SITE_KEY, group
    )
    reads = F.transform(
        complete,
        lambda b: F.struct(
            part(b, 2).alias("SiteName"),
            F.btrim(part(b, 1), F.lit("_")).alias("ChirpString"),
            value(b, "_ReadBytes").alias("ReadBytes"),
            value(b, "_ReadTimeMS").alias("ReadTimeMS"),
        ),
    )
    return F.sort_array(reads)


def without_site_io(stats: Column) -> Column:
    """Statistics that stay: per-site volumes leave, times leave together with their volume."""

    def leaves(key: Column) -> Column:
        paired = F.try_element_at(stats, F.concat(_base(key), F.lit("_ReadBytes"))).isNotNull()
        return _is_site_key(key) & (
            key.endswith("_ReadBytes") | (key.endswith("_ReadTimeMS") & paired)
        )

    per_site = F.exists(F.map_keys(stats), _is_site_key)
    return F.when(per_site, F.map_filter(stats, lambda key, _: ~leaves(key))).otherwise(stats)


def fold_steps(stats: Column) -> Column:
    """One total per statistic over the steps of a job and the total it already had.

    Counts of events and limits keep the maximum, everything else adds up. The statistics are
    sorted by name and folded in one pass, so the work grows with their number and not with
    its square.
    """
    entries = F.filter(F.map_entries(stats), lambda e: ~_is_site_key(e["key"]))
    pairs = F.transform(
        entries,
        lambda e: F.struct(
            F.regexp_replace(e["key"], _BEFORE_NAME, "").alias("name"),
            e["value"].cast("double").alias("value"),
            e["key"].startswith(PREFIX + "_").alias("of_step"),
        ),
    )
    start = F.struct(
        F.array().cast("array<struct<key:string,value:double>>").alias("done"),
        F.lit(None).cast("string").alias("name"),
        F.lit(0.0).alias("value"),
        F.lit(False).alias("of_step"),
    )

    def closed(open_total: Column) -> Column:
        """Totals so far, with the open one if a step contributed to it."""
        entry = F.struct(
            F.concat(F.lit(PREFIX), open_total["name"]).alias("key"),
            open_total["value"].alias("value"),
        )
        return F.when(open_total["of_step"], F.array_append(open_total["done"], entry)).otherwise(
            open_total["done"]
        )

    def add(total: Column, pair: Column) -> Column:
        combined = F.when(
            pair["name"].rlike(_KEPT_MAXIMUM), F.greatest(total["value"], pair["value"])
        ).otherwise(total["value"] + pair["value"])
        same = total["name"].eqNullSafe(pair["name"])
        return F.when(
            same,
            F.struct(
                total["done"].alias("done"),
                total["name"].alias("name"),
                combined.alias("value"),
                (total["of_step"] | pair["of_step"]).alias("of_step"),
            ),
        ).otherwise(
            F.struct(
                closed(total).alias("done"),
                pair["name"].alias("name"),
                pair["value"].alias("value"),
                pair["of_step"].alias("of_step"),
            )
        )

    return F.map_from_entries(F.aggregate(F.sort_array(pairs), start, add, closed))


def with_totals(stats: Column, totals: Column) -> Column:
    """Statistics with the folded totals put in place of the totals they started from."""
    return F.map_zip_with(stats, totals, lambda _, old, new: F.coalesce(new, old))


def statistic(stats: Column, name: str) -> Column:
    """A total by its short name."""
    return F.try_element_at(stats, F.lit(PREFIX + name))


def derived_metrics(
    stats: Callable[[], Column],
    record_time: Callable[[], Column],
    status: Callable[[], Column],
    cpus: Callable[[], Column],
    core_hours: Callable[[], Column],
) -> dict[str, Callable[[], Column]]:
    """Recipes of the fields in handy units and of the rates, out of the totals of a job."""

    def get(name: str) -> Column:
        return statistic(stats(), name)

    def scaled(name: str, unit: float) -> Callable[[], Column]:
        return lambda: get(name) / F.lit(unit)

    def since_update() -> Column:
        # greatest() ignores nulls, so a missing update has to stay missing
        elapsed = record_time() - get("LastUpdate")
        return F.when(elapsed.isNotNull(), F.greatest(elapsed, F.lit(0.0)) / F.lit(3600.0))

    def count() -> Column:
        return F.coalesce(get("Events"), F.lit(0.0))

    def program_rate() -> Column:
        elapsed = get("Elapsed")
        return F.when(
            (get("Done") != 0) & (elapsed > 0), F.try_divide(count(), elapsed * cpus())
        )

    def rate() -> Column:
        return F.when(core_hours() > 0, F.try_divide(count(), core_hours() * F.lit(3600.0)))

    def inverse(value: Column) -> Column:
        return F.when(value > 0, F.try_divide(F.lit(1.0), value))

    def share(name: str, other: str) -> Column:
        whole = get(name) + get(other)
        return F.when(whole != 0, F.try_divide(get(name), whole) * F.lit(100))

    return {
        "CompletedFiles": lambda: get("Files"),
        "MaxFiles": lambda: F.when(get("MaxFiles") > 0, get("MaxFiles")),
        "CMSSWDone": lambda: get("Done") != 0,
        "CMSSWWallHrs": scaled("Elapsed", 3600.0),
        "KEvents": scaled("Events", 1000.0),
        "MegaEvents": scaled("Events", 1e6),
        "SinceLastCMSSWUpdateHrs": since_update,
        "StageOutHrs": lambda: F.when(status() == "Completed", since_update()),
        "CMSSWKLumis": scaled("Lumis", 1000.0),
        "InputGB": scaled("ReadBytes", 1e9),
        "ReadTimeHrs": scaled("ReadTimeMsecs", 3600000.0),
        "ReadTimeMins": scaled("ReadTimeMsecs", 60000.0),
        "OutputGB": scaled("WriteBytes", 1e9),
        "WriteTimeHrs": scaled("WriteTimeMsecs", 3600000.0),
        "WriteTimeMins": scaled("WriteTimeMsecs", 60000.0),
        "CMSSWEventRate": program_rate,
        "CMSSWTimePerEvent": lambda: inverse(program_rate()),
        "EventRate": rate,
        "TimePerEvent": lambda: inverse(rate()),
        "ReadOpSegmentPercent": lambda: share("ReadOps", "ReadSegments"),
        "ReadOpsPercent": lambda: share("ReadOps", "ReadVOps"),
    }
