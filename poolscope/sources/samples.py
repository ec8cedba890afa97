"""Job records derived from the driver's tables, for tests, examples and measurements.

The same expressions run on Spark and on DuckDB; where the dialects differ a placeholder is
filled in. Attributes that are lists or maps exist on the Spark side only.
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

LAUNCH_TIME = 1706659200  # 2024-01-31 00:00:00 UTC

_DIALECTS = {
    "spark": {
        "text": "STRING",
        "epoch": "timestampdiff(SECOND, timestamp_ntz'1970-01-01 00:00:00', {0})",
    },
    "duckdb": {"text": "VARCHAR", "epoch": "CAST(floor(epoch({0})) AS BIGINT)"},
}

# What each table calls the number, user, type, amount and time of an observation.
_BASES = {
    "events": {
        "event_id": "event_id",
        "user_id": "user_id",
        "g": "CASE event_type WHEN 'click' THEN 0 WHEN 'error' THEN 1 WHEN 'purchase' THEN 2"
        " WHEN 'signup' THEN 3 ELSE 4 END",
        "amount": "value",
        "k": "CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT)",
        "ts": "ts",
    },
    "lineitem": {
        "event_id": "l_orderkey * 10 + l_linenumber",
        "user_id": "l_suppkey",
        "g": "l_orderkey % 5",
        "amount": "l_quantity",
        "k": "l_partkey % 100",
        "ts": "l_shipdate",
    },
}

_ANALYSIS = "event_id % 3 = 0"

# (attribute, expression over event_id, user_id, g, amount, k, e). {S} is the text type.
_ATTRIBUTES: list[tuple[str, str]] = [
    (
        "GlobalJobId",
        "'crab3@sched' || CAST(user_id % 7 AS {S}) || '.example.org#' || CAST(event_id AS {S})"
        " || '.0#' || CAST(e AS {S})",
    ),
    ("JobStatus", "CAST(CASE g WHEN 0 THEN 2 WHEN 1 THEN 3 WHEN 2 THEN 4 WHEN 3 THEN 5 ELSE 1 END AS BIGINT)"),
    ("JobUniverse", "CAST(CASE WHEN event_id % 89 = 3 THEN 7 ELSE 5 END AS BIGINT)"),
    (
        "CMS_Type",
        f"CASE WHEN {_ANALYSIS} THEN 'Analysis' WHEN event_id % 50 = 1 THEN 'DONOTMONIT' ELSE 'production' END",
    ),
    (
        "CMS_JobType",
        f"CASE WHEN {_ANALYSIS} THEN 'Analysis' WHEN k % 2 = 0 THEN 'Production' WHEN k % 14 = 1 THEN NULL"
        " ELSE 'Processing' END",
    ),
    ("TaskType", "CASE WHEN event_id % 97 = 5 THEN 'ROOT' END"),
    ("Owner", "'owner' || CAST(user_id % 11 AS {S})"),
    ("QDate", "e - 3600"),
    ("JobCurrentStartDate", "CASE WHEN g <> 4 THEN e - 1800 END"),
    ("EnteredCurrentStatus", "e"),
    ("CompletionDate", "CASE WHEN g = 2 AND k % 10 <> 7 THEN e END"),
    ("JobFinishedHookDone", "CASE WHEN g IN (1, 2) AND k % 2 = 0 THEN e + 60 END"),
    ("LastMatchTime", "CASE WHEN k % 4 <> 1 THEN e - 1700 END"),
    ("MATCH_GLIDEIN_ToDie", "CASE WHEN k % 5 <> 2 THEN e + k * 613 END"),
    ("CRAB_PostJobLastUpdate", f"CASE WHEN {_ANALYSIS} AND k % 7 = 0 THEN CAST(e + 864000 AS DOUBLE) END"),
    (
        "ExitCode",
        "CASE WHEN g = 1 AND k % 4 <> 0 THEN 7900 + k * 701 WHEN g = 2 THEN CAST(0 AS BIGINT) END",
    ),
    ("JobExitCode", f"CASE WHEN {_ANALYSIS} AND k % 12 = 1 THEN 50660 + k % 20 END"),
    ("Chirp_CRAB3_Job_ExitCode", f"CASE WHEN {_ANALYSIS} AND k % 5 = 0 THEN 8020 + k % 12 END"),
    ("Chirp_WMCore_cmsRun_ExitCode", "CASE WHEN event_id % 3 <> 0 AND k % 9 = 0 THEN k END"),
    ("RequestCpus", "CASE WHEN k % 10 <> 9 THEN 1 + k % 8 END"),
    ("CreamAttributes", "CASE WHEN k IN (9, 19) THEN 'Type = x; CPUNumber = 4; Name = y' WHEN k = 29 THEN 'none' END"),
    ("NordugridRSL", "CASE WHEN k IN (19, 29, 39) THEN '&(executable=x)(count=6)(name=y)' END"),
    ("xcount", "CASE WHEN k IN (39, 49, 59) THEN CAST(3 AS BIGINT) END"),
    ("RemoteWallClockTime", "k * 97"),
    ("CommittedTime", "CASE WHEN k % 15 = 4 THEN CAST(0 AS BIGINT) ELSE k * 89 END"),
    ("RemoteUserCpu", "k * 50 + user_id"),
    ("RemoteSysCpu", "k"),
    ("DiskUsage_RAW", "CAST(floor(amount * 1000) AS BIGINT)"),
    ("ResidentSetSize_RAW", "CASE WHEN k % 21 <> 20 THEN k * 3072 + user_id END"),
    ("RequestMemory", "CASE k % 3 WHEN 0 THEN '2048' WHEN 1 THEN 'ifthenelse(x, 1, 2)' ELSE '1500.5' END"),
    (
        "MATCH_EXP_JOB_GLIDEIN_CMSSite",
        "CASE WHEN k % 16 = 15 THEN NULL ELSE CASE user_id % 5 WHEN 0 THEN 'T1_US_Alpha_Disk' WHEN 1 THEN 'T2_CH_Beta'"
        " WHEN 2 THEN 'T2_FI_Helsinki_Disk' WHEN 3 THEN 'T3_XX_A_B' ELSE 'Unlisted' END END",
    ),
    ("MATCH_GLIDEIN_CMSSite", "CASE WHEN k % 32 = 15 THEN 'T2_CH_B' END"),
    (
        "GlideinEntryName",
        "CASE k % 5 WHEN 0 THEN 'CMSHTPC_T2_US_Foo_gw1' WHEN 1 THEN 'CMS_Short_gw1' WHEN 2 THEN 'OSG_US_Site-A_gw'"
        " WHEN 3 THEN 'plain' END",
    ),
    ("MATCH_EXP_JOBGLIDEIN_ResourceName", "CASE WHEN k % 4 = 3 THEN 'Resource' || CAST(k % 8 AS {S}) END"),
    (
        "DESIRED_CMSDataLocations",
        "CASE k % 3 WHEN 0 THEN 'T2_CH_Beta, T1_US_Alpha' WHEN 1 THEN 'T2_FI_Helsinki' END",
    ),
    ("DESIRED_Sites", "CASE WHEN k % 2 = 0 THEN 'T2_CH_Beta,T3_XX_A_B' ELSE 'T1_US_Alpha' END"),
    ("ExtDESIRED_Sites", "CASE WHEN k % 4 = 2 THEN 'T2_CH_Beta  T3_XX_A_B' END"),
    (
        "DESIRED_CMSDataset",
        "CASE k % 4 WHEN 0 THEN '/Primary' || CAST(k AS {S}) || '/Run2016B-v2/AODSIM' WHEN 1 THEN '/short/name'"
        " WHEN 2 THEN '/A/B/C/USER' END",
    ),
    ("CMSGroups", "CASE k % 3 WHEN 0 THEN 'HIG, EXO' WHEN 1 THEN 'SMP' END"),
    (
        "WMAgent_RequestName",
        "CASE k % 11 WHEN 0 THEN 'user_task_HIG-RunIISummer20UL16-01026__v1_T_160530_083522_4482'"
        " WHEN 1 THEN 'PromptReco_Run3_Muon' WHEN 2 THEN 'user_RVCMSSW_12_0_1Foo__x'"
        " WHEN 3 THEN 'op_Run2016B-v2-JetHT-23Sep2016_8020_160923' WHEN 4 THEN 'op_task_TSG-Phase2HLT-00229__v1'"
        " WHEN 5 THEN 'op_task_TSG-SnowmassWinter21wmLHEGEN-00229__v1' WHEN 6 THEN 'Express_Run9_Stream1_MiniAOD'"
        " WHEN 7 THEN 'pd_SMP-RunIISpring16DR80-7' WHEN 8 THEN 'Repack_RunIII' WHEN 9 THEN 'x_UltraLegacy' ELSE NULL END",
    ),
    (
        "WMAgent_SubTaskName",
        "CASE k % 10 WHEN 0 THEN '/req/Step/CleanupUnmergedX' WHEN 1 THEN '/req/DataProcessing'"
        " WHEN 2 THEN '/req/DataProcessing/ProdMergeLog' WHEN 3 THEN '/req/StepLogCollect' WHEN 4 THEN '/req/StepOneProc'"
        " WHEN 5 THEN '/req/HIG-RunIISummer20GS-0001_0' WHEN 6 THEN '/req/x-y_0' WHEN 7 THEN '/req/step_1'"
        " WHEN 8 THEN CASE WHEN k % 20 = 8 THEN 'Reco' ELSE '/req/MonteCarloFromGEN' END ELSE NULL END",
    ),
    ("CMS_CampaignName", "CASE k % 23 WHEN 0 THEN 'Declared' || CAST(k AS {S}) WHEN 1 THEN '' END"),
    ("CMS_TaskType", "CASE WHEN k % 17 = 0 THEN 'DIGI-RECO' END"),
    ("CMS_extendedJobType", "CASE k % 13 WHEN 0 THEN 'UNKNOWN' WHEN 1 THEN 'Skim' END"),
    ("CMS_WMTool", "CASE k % 6 WHEN 0 THEN 'user' WHEN 1 THEN 'WMAgent' WHEN 2 THEN 'CRAB3' END"),
    ("CMS_SubmissionTool", "CASE WHEN k % 4 = 0 THEN 'InstitutionalSchedd' ELSE 'CRAB' END"),
    (
        "CRAB_Id",
        f"CASE WHEN {_ANALYSIS} THEN CASE WHEN k % 2 = 0 THEN CAST(k AS {{S}})"
        " ELSE CAST(k % 3 AS {S}) || '-' || CAST(k AS {S}) END WHEN k = 98 THEN 'x' END",
    ),
    (
        "CRAB_Workflow",
        f"CASE WHEN {_ANALYSIS} THEN CASE WHEN k % 20 = 19 THEN 'no_stamp_' || CAST(k AS {{S}}) ELSE '240101_0000'"
        " || lpad(CAST(k % 60 AS {S}), 2, '0') || ':user' || CAST(user_id AS {S}) || '_crab_t' || CAST(k AS {S})"
        " END END",
    ),
    ("CRAB_UserHN", f"CASE WHEN {_ANALYSIS} THEN 'user' || CAST(user_id AS {{S}}) END"),
    (
        "CRAB_JobSW",
        f"CASE WHEN {_ANALYSIS} THEN CASE WHEN k % 5 = 4 THEN 'private' ELSE 'CMSSW_' || CAST(10 + k % 4 AS {{S}})"
        " || '_' || lpad(CAST(k % 7 AS {S}), 2, '0') || '_' || CAST(k % 9 AS {S}) END END",
    ),
    (
        "CRAB_PostJobStatus",
        f"CASE WHEN {_ANALYSIS} THEN CASE k % 7 WHEN 0 THEN 'NOT RUN' WHEN 1 THEN 'TRANSFERRING' WHEN 2 THEN ' cooloff '"
        " WHEN 3 THEN 'FAILED' WHEN 4 THEN 'Odd state' WHEN 5 THEN 'finished' END END",
    ),
    ("CRAB_AsyncDest", f"CASE WHEN {_ANALYSIS} AND k % 2 = 0 THEN 'T2_CH_Beta' END"),
    ("x509userproxysubject", "'/CN=Customer#' || lpad(CAST(user_id AS {S}), 9, '0')"),
    ("x509UserProxyFQAN", "CASE k % 3 WHEN 0 THEN '/cms/Role=a,/cms/Role=b,/cms' WHEN 1 THEN '/cms' END"),
    ("x509UserProxyVOName", "CASE WHEN k % 3 < 2 THEN 'cms' END"),
    ("CRAB_SaveLogsFlag", f"CASE WHEN {_ANALYSIS} AND k % 6 < 4 THEN k % 2 = 0 END"),
    ("HasBeenTimingTuned", "CASE k % 4 WHEN 0 THEN k % 8 = 0 END"),
    ("MachineAttrHAS_SINGULARITY0", "CASE k % 3 WHEN 0 THEN k % 2 = 0 WHEN 1 THEN k % 2 = 1 END"),
    ("MATCH_EXP_JOB_GLIDEIN_Cpus", "CASE WHEN k % 12 <> 11 THEN CAST(1 + k % 8 AS DOUBLE) END"),
    ("MachineAttrMJF_JOB_HS06_JOB0", "CASE WHEN k % 4 <> 0 THEN CAST(80 + k AS DOUBLE) END"),
    ("MachineAttrDIRACBenchmark0", "CASE WHEN k % 5 <> 0 THEN CAST(10 + k AS DOUBLE) / 4 END"),
    ("CpuEventRate", "CASE WHEN k % 6 = 1 THEN CAST(k AS DOUBLE) / 8 WHEN k % 6 = 2 THEN CAST(0 AS DOUBLE) END"),
    ("CpuTimePerEvent", "CASE WHEN k % 6 = 1 THEN CAST(k + 1 AS DOUBLE) / 16 END"),
    ("ChirpCMSSWCPUModels", "CASE WHEN k % 4 = 1 THEN 'Xeon ' || CAST(k AS {S}) END"),
    ("MachineAttrCPUModel0", "CASE WHEN k % 4 < 3 THEN 'EPYC ' || CAST(k AS {S}) END"),
]


def base_columns(table: str, dialect: str) -> list[str]:
    """Observation columns of a table: event_id, user_id, g, amount, k, e."""
    names, words = _BASES[table], _DIALECTS[dialect]
    columns = [f"{names[c]} AS {c}" for c in ("event_id", "user_id", "g", "amount", "k")]
    return [*columns, words["epoch"].format(names["ts"]) + " AS e"]


def base_sql(table: str, dialect: str) -> str:
    """The same as a select list."""
    return ", ".join(base_columns(table, dialect))


def attribute_sql(dialect: str) -> list[str]:
    """Attribute expressions over the observation columns."""
    text = _DIALECTS[dialect]["text"]
    return [f"{expression.replace('{S}', text)} AS {name}" for name, expression in _ATTRIBUTES]


def ads_cte(table: str = "events") -> str:
    """The records as common table expressions for DuckDB, to be followed by a query."""
    return (
        f"WITH base AS (SELECT {base_sql(table, 'duckdb')} FROM {table}), "
        f"job_ads AS (SELECT event_id, user_id, g, amount, k, e, {', '.join(attribute_sql('duckdb'))} FROM base)"
    )


def table_path(sf_dir: str, name: str) -> str:
    """Where a table is: a file, or a folder of files."""
    return os.path.join(sf_dir, f"{name}.parquet")


def table_glob(sf_dir: str, name: str) -> str:
    """The same as a pattern: streams take a single file only by pattern."""
    return os.path.join(sf_dir, f"{{{name}}}.parquet")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's tables."""
    return spark.read.parquet(table_path(sf_dir, name))


def sample_base(spark: SparkSession, sf_dir: str, source: str = "events") -> DataFrame:
    """Observation columns of a table."""
    return observations(table(spark, sf_dir, source), source)


def observations(rows: DataFrame, source: str = "events") -> DataFrame:
    """Observation columns of rows of a table (batch or stream)."""
    return rows.selectExpr(*base_columns(source, "spark"))


def sample_ads(spark: SparkSession, sf_dir: str, source: str = "events", *, maps: bool = False) -> DataFrame:
    """Records over ``events`` or ``lineitem``; ``maps`` adds the map attributes."""
    return ads_of(sample_base(spark, sf_dir, source), maps=maps)


def ads_of(base: DataFrame, *, maps: bool = False) -> DataFrame:
    """Records over observation columns. ``event_id`` stays as an attribute of its own."""
    lists = [
        "CASE WHEN k % 3 > 0 THEN array_repeat('a.root', CAST(k % 3 AS INT)) END AS CRAB_AdditionalOutputFiles",
        "CASE WHEN k % 4 > 0 THEN array('t.root') END AS CRAB_TFileOutputFiles",
        "array_repeat('e.root', CAST(k % 2 AS INT)) AS CRAB_EDMOutputFiles",
    ]
    extra = [STATISTICS_SQL, EXTRA_SQL] if maps else []
    return base.selectExpr(*attribute_sql("spark"), *lists, *extra, "event_id")


# Application statistics of two steps, on the Spark side.
STATISTICS_SQL = """
CASE WHEN k % 10 <> 3 THEN map_filter(map(
  'ChirpCMSSW_cmsRun1_Events', CAST(k * 10 AS DOUBLE),
  'ChirpCMSSW_cmsRun2_Events', CAST(k * 7 + user_id AS DOUBLE),
  'ChirpCMSSW_cmsRun1_Elapsed', CAST(k * 30 AS DOUBLE),
  'ChirpCMSSW_cmsRun2_Elapsed', CAST(user_id AS DOUBLE),
  'ChirpCMSSWElapsed', CASE WHEN k % 4 = 0 THEN CAST(5 AS DOUBLE) END,
  'ChirpCMSSW_cmsRun1_Done', CAST(k % 2 AS DOUBLE),
  'ChirpCMSSW_LastUpdate', CAST(e - k AS DOUBLE),
  'ChirpCMSSW_cmsRun1_Lumis', CAST(k AS DOUBLE),
  'ChirpCMSSW_cmsRun1_Files', CAST(k % 6 AS DOUBLE),
  'ChirpCMSSW_cmsRun1_MaxFiles', CAST(k % 3 - 1 AS DOUBLE),
  'ChirpCMSSW_cmsRun1_ReadBytes', CAST(k * 1000003 AS DOUBLE),
  'ChirpCMSSW_cmsRun1_ReadTimeMsecs', CAST(k * 1700 AS DOUBLE),
  'ChirpCMSSW_cmsRun1_WriteBytes', CAST(k * 500009 AS DOUBLE),
  'ChirpCMSSW_cmsRun1_WriteTimeMsecs', CAST(k * 900 AS DOUBLE),
  'ChirpCMSSW_cmsRun1_ReadOps', CAST(k AS DOUBLE),
  'ChirpCMSSW_cmsRun1_ReadSegments', CAST(k * 3 AS DOUBLE),
  'ChirpCMSSW_cmsRun1_ReadVOps', CASE WHEN k % 2 = 0 THEN CAST(user_id AS DOUBLE) END,
  'ChirpCMSSW_cmsRun1_IOSite_T2_CH_Beta_ReadBytes', CAST(k AS DOUBLE),
  'ChirpCMSSW_cmsRun1_IOSite_T2_CH_Beta_ReadTimeMS', CASE WHEN k % 3 > 0 THEN CAST(k + 1 AS DOUBLE) END,
  'ChirpCMSSWIOSite_CACHE_ReadBytes', CASE WHEN k % 5 = 0 THEN CAST(k + 2 AS DOUBLE) END,
  'ChirpCMSSWIOSite_CACHE_ReadTimeMS', CAST(k + 3 AS DOUBLE)
), (key, val) -> val IS NOT NULL) END AS chirp
"""

# Attributes without a column of their own, on the Spark side.
EXTRA_SQL = """
map_filter(map(
  'MATCH_EXP_JOB_GLIDEIN_Job_Max_Time', CAST(k * 60 AS STRING),
  'MATCH_EXP_JOB_GLIDEIN_MaxMemMBs', CASE k % 3 WHEN 0 THEN 'GLIDEIN_MaxMemMBs' WHEN 1 THEN 'Unknown' ELSE '2500' END,
  'MATCH_EXP_JOB_GLIDEIN_Memory', CASE WHEN k % 2 = 0 THEN CAST(k AS STRING) END,
  'GLIDEIN_Memory', CAST(k + 1 AS STRING),
  'ImageSize_RAW', CAST(k * 11 AS STRING),
  'ImageSize', 'ignored',
  'MaxWallTimeMins_RAW', CASE WHEN k % 5 = 0 THEN '1.5' ELSE CAST(k AS STRING) END,
  'MaxWallTimeMins', 'plain',
  'JobStartDate', CASE k % 4 WHEN 0 THEN '0' WHEN 1 THEN 'UNKNOWN' ELSE CAST(e AS STRING) END,
  'TransferQueued', CASE k % 3 WHEN 0 THEN 'true' WHEN 1 THEN 'false' ELSE '0' END,
  'HasBeenRouted', 'true',
  'HasBeenSomething', 'true',
  'Environment', 'ignored',
  'NiceUser', 'true',
  'DESIRED_SITES', 'T2_X',
  'SomethingElse', 'text ' || CAST(k AS STRING)
), (key, val) -> val IS NOT NULL) AS extra
"""
