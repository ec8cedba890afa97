"""Job records: schema, readers and staging.

A record set is a DataFrame with one column per attribute the library computes on, a map
``chirp`` of application statistics and a map ``extra`` of all other attributes as text.
Attributes a source does not deliver may be left out.
"""

from __future__ import annotations

from collections.abc import Container, Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolscope import catalog
from poolscope.functions import casting
from poolscope.functions import chirp as chirp_fn

_AD_DDL = """
GlobalJobId string, CMS_Type string, CMS_JobType string, Owner string, TaskType string,
JobStatus bigint, JobUniverse bigint, LastJobStatus bigint,
QDate bigint, JobCurrentStartDate bigint, EnteredCurrentStatus bigint, CompletionDate bigint,
JobFinishedHookDone bigint, LastMatchTime bigint, MATCH_GLIDEIN_ToDie bigint,
CRAB_PostJobLastUpdate double,
ExitCode bigint, JobExitCode bigint, Chirp_CRAB3_Job_ExitCode bigint,
Chirp_WMCore_cmsRun_ExitCode bigint,
RequestCpus bigint, RemoteWallClockTime bigint, CommittedTime bigint, RemoteUserCpu bigint,
RemoteSysCpu bigint, DiskUsage_RAW bigint, ResidentSetSize_RAW bigint, xcount bigint,
RequestMemory string, CreamAttributes string, NordugridRSL string,
MATCH_EXP_JOB_GLIDEIN_CMSSite string, MATCH_EXP_JOBGLIDEIN_CMSSite string,
MATCH_GLIDEIN_CMSSite string, MachineAttrGLIDEIN_CMSSite0 string,
MachineAttrCMSProcessingSiteName0 string, GlideinEntryName string,
MATCH_EXP_JOBGLIDEIN_ResourceName string,
DESIRED_CMSDataLocations string, DESIRED_Sites string, ExtDESIRED_Sites string,
DESIRED_CMSDataset string, CMSGroups string,
WMAgent_RequestName string, WMAgent_SubTaskName string, CMS_CampaignName string,
CMS_TaskType string, CMS_extendedJobType string, CMS_WMTool string, CMS_SubmissionTool string,
CRAB_Id string, CRAB_Workflow string, CRAB_UserHN string, CRAB_JobSW string,
CRAB_PostJobStatus string, CRAB_AsyncDest string, x509userproxysubject string,
x509UserProxyFQAN string, x509UserProxyVOName string,
CRAB_AdditionalOutputFiles array<string>, CRAB_TFileOutputFiles array<string>,
CRAB_EDMOutputFiles array<string>,
CRAB_SaveLogsFlag boolean, HasBeenTimingTuned boolean, MachineAttrHAS_SINGULARITY0 boolean,
MATCH_EXP_JOB_GLIDEIN_Cpus double, MachineAttrMJF_JOB_HS06_JOB0 double,
MachineAttrDIRACBenchmark0 double, CpuEventRate double, CpuTimePerEvent double,
ChirpCMSSWCPUModels string, MachineAttrCPUModel0 string,
chirp map<string,double>, extra map<string,string>
"""

_TYPES: dict[str, T.DataType] = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "array<string>": T.ArrayType(T.StringType()),
    "map<string,double>": T.MapType(T.StringType(), T.DoubleType()),
    "map<string,string>": T.MapType(T.StringType(), T.StringType()),
}

AD_SCHEMA = T.StructType(
    [
        T.StructField(name, _TYPES[dtype])
        for name, dtype in (column.split() for column in _AD_DDL.replace(",\n", ", ").split(", "))
    ]
)
MAP_COLUMNS = ("chirp", "extra")
_BY_LOWER_NAME = {f.name.lower(): f for f in AD_SCHEMA.fields}

PREFIX = "ad_"

# Attributes whose own conversion rule needs the value as the source delivers it.
AS_DELIVERED = ("RequestCpus",)


def attribute(name: str) -> Column:
    """A staged attribute."""
    return F.col(PREFIX + name)


def stage(ads: DataFrame, wanted: Container[str], carry: Iterable[str] = ()) -> DataFrame:
    """Rename the wanted attributes to ``ad_*``; attributes that are not delivered are null.

    Staged names cannot collide with document fields. Only columns that are missing or of
    another type are computed; the others are plain references, so filters and pruning still
    reach the scan. Columns to ``carry`` stay as they are.
    """
    present = {f.name.lower(): f for f in ads.schema.fields}
    columns = []
    for field in AD_SCHEMA.fields:
        if PREFIX + field.name not in wanted:
            continue
        found = present.get(field.name.lower())
        if found is None:
            value = F.lit(None).cast(field.dataType)
        elif found.dataType == field.dataType or field.name in AS_DELIVERED:
            value = F.col(f"`{found.name}`")
        else:
            value = _converted(F.col(f"`{found.name}`"), found.dataType, field.dataType)
        columns.append(value.alias(PREFIX + field.name))
    for lower, field in present.items():
        if lower not in _BY_LOWER_NAME and PREFIX + field.name in wanted:
            columns.append(F.col(f"`{field.name}`").alias(PREFIX + field.name))
    return ads.select(*columns, *carry)


def _converted(value: Column, found: T.DataType, wanted: T.DataType) -> Column:
    """Bring an attribute to its type; what does not convert is null."""
    if isinstance(wanted, T.LongType):
        return casting.to_long(value, found)
    if isinstance(wanted, T.DoubleType) and isinstance(found, T.StringType):
        return casting.text_to_double(value)
    if isinstance(wanted, T.StringType):
        return casting.to_text(value, found)
    return value.try_cast(wanted)


def infinite_attributes(ads: DataFrame) -> Column | None:
    """Names of integer attributes that are infinite in a record, if a source has such columns."""
    checks = []
    for field in ads.schema.fields:
        known = _BY_LOWER_NAME.get(field.name.lower())
        integer = isinstance(known.dataType, T.LongType) if known else False
        if integer or catalog.kind_of(field.name) in ("long", "date"):
            infinite = casting.is_unconvertible(F.col(f"`{field.name}`"), field.dataType)
            if infinite is not None:
                checks.append(F.when(infinite, F.lit(f"{field.name} is infinite")))
    return F.array_compact(F.array(*checks)) if checks else None


def delivered(ads: DataFrame) -> list[T.StructField]:
    """Attributes a record set really has, under their catalogue spelling."""
    fields = []
    for field in ads.schema.fields:
        known = _BY_LOWER_NAME.get(field.name.lower())
        if known is None:
            fields.append(field)
        elif known.name in AS_DELIVERED:
            fields.append(T.StructField(known.name, field.dataType))
        else:
            fields.append(known)
    return [f for f in fields if f.name not in MAP_COLUMNS]


def read_ads(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """All attributes of all records below a path (``parquet``, ``orc`` or ``json`` lines)."""
    if fmt == "json":
        return ads_from_json(spark.read.text(path), "value")
    return spark.read.format(fmt).load(path)


def read_ads_stream(
    spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet", files_per_batch: int | None = None
) -> DataFrame:
    """The same for a folder that keeps growing."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.load(path)


def ads_from_json(lines: DataFrame, column: str) -> DataFrame:
    """Records in JSON text, one object per line.

    Known attributes become typed columns, ``ChirpCMSSW*`` numbers go to ``chirp``, the rest
    to ``extra``. A line is read twice by the JSON reader (columns, map), whatever its width.
    """
    scalar = [
        f for f in AD_SCHEMA.fields if f.name not in MAP_COLUMNS
    ]
    text_ddl = ", ".join(
        f"`{f.name}` {'array<string>' if isinstance(f.dataType, T.ArrayType) else 'string'}" for f in scalar
    )
    parsed = lines.select(
        F.from_json(column, text_ddl).alias("_known"),
        F.from_json(column, "map<string,string>").alias("_all"),
    )
    known = [
        (
            F.col(f"_known.{f.name}")
            if isinstance(f.dataType, (T.StringType, T.ArrayType))
            else _converted(F.col(f"_known.{f.name}"), T.StringType(), f.dataType)
        ).alias(f.name)
        for f in scalar
    ]
    names = [f.name for f in scalar]
    is_statistic = lambda k: k.startswith(chirp_fn.PREFIX) & ~k.isin(names)
    chirp = F.transform_values(
        F.map_filter("_all", lambda k, v: is_statistic(k) & _number(v).isNotNull()),
        lambda _, v: _number(v),
    )
    extra = F.map_filter("_all", lambda k, _: ~is_statistic(k) & ~k.isin(names))
    return parsed.select(*known, chirp.alias("chirp"), extra.alias("extra"))


def _number(text: Column) -> Column:
    """A statistic as a number; booleans count as 0 and 1."""
    flag = F.when(text == "true", F.lit(1.0)).when(text == "false", F.lit(0.0))
    return F.coalesce(casting.text_to_double(text), flag)
