"""Where a job ran and where its data is."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def site_name(declared: Column) -> Column:
    """Site without its storage ending.

    The ending is taken off as a set of characters, from both ends, so ``Helsinki_Disk``
    becomes ``Helsin``. Stored documents rely on these names.
    """
    stripped = F.btrim(declared, F.lit("_Disk"))
    return F.when(declared.endswith("_Disk"), stripped).otherwise(declared)


# Entry names of resources.
_ENTRY_CMS = r"^CMS[A-Za-z]*_(.*)_"
_ENTRY_GENERIC = r"^[A-Za-z0-9]+_[A-Za-z0-9]+_(.*)_"


def site_from_entry(entry: Column, resource: Column) -> Column:
    """Site of a job outside the main collaboration: from its entry name, else its resource."""
    by_entry = (
        F.when(entry.rlike(_ENTRY_CMS), F.regexp_extract(entry, _ENTRY_CMS, 1))
        .when(entry.rlike(_ENTRY_GENERIC), F.regexp_extract(entry, _ENTRY_GENERIC, 1))
        .otherwise(F.lit("UNKNOWN"))
    )
    return F.when(entry.isNotNull() & resource.isNull(), by_entry).otherwise(
        F.coalesce(resource, F.lit("UNKNOWN"))
    )


def named_by_entry(entry: Column, resource: Column) -> Column:
    """True when the site comes from an entry name that carries tier and country."""
    return F.coalesce(entry.rlike(_ENTRY_CMS) & resource.isNull(), F.lit(False))


def site_part(site: Column, position: int) -> Column:
    """Tier (0) or country (1) of a ``tier_country_name`` site, else Unknown."""
    parts = F.split(site, "_", 3)
    return F.when(F.size(parts) == 3, F.get(parts, F.lit(position))).otherwise(F.lit("Unknown"))


def _is_remote(site: Column, locations: Column, status: Column) -> Column:
    at_data = locations.isNull() | locations.contains(site)
    return ~at_data & (site != "UNKNOWN") & ~F.coalesce(status == 1, F.lit(False))


def input_locality(site: Column, locations: Column, status: Column) -> Column:
    """Onsite or Offsite; nothing for idle jobs that are not at their data.

    A site counts as onsite when its name is contained in the text of locations, not only
    when it equals one of them.
    """
    return F.when(locations.isNull() | locations.contains(site), F.lit("Onsite")).when(
        _is_remote(site, locations, status), F.lit("Offsite")
    )


def overflow_type(
    site: Column, locations: Column, status: Column, analysis: Column, wanted_sites: Column
) -> Column:
    """Why a job runs away from its data."""
    by_choice = F.when(F.array_contains(wanted_sites, site), F.lit("IgnoreLocality")).otherwise(
        F.lit("FrontendOverflow")
    )
    return F.when(
        _is_remote(site, locations, status),
        F.when(analysis, by_choice).otherwise(F.lit("Unified")),
    )
