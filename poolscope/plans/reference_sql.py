"""DuckDB SQL with the results the registered queries must have, written on its own terms."""

from __future__ import annotations

from poolscope.plans.queries import LOG_LINE_SQL, LOG_MESSAGE_SQL
from poolscope.sources.samples import LAUNCH_TIME, ads_cte, base_sql

L = f"{LAUNCH_TIME}::BIGINT"
# Codes of the scheduler, stated here once more.
STATUSES = {0: "Unexpanded", 1: "Idle", 2: "Running", 3: "Removed", 4: "Completed", 5: "Held", 6: "Error"}
UNIVERSES = {5: "Vanilla", 7: "Scheduler"}  # those that the sample records have
H = "3600::DOUBLE"


def _case(column: str, table: dict) -> str:
    arms = " ".join(f"WHEN {key!r} THEN '{value}'" for key, value in table.items())
    return f"CASE {column} {arms} ELSE 'Unknown' END"


def _list(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN ['UNKNOWN'] ELSE regexp_split_to_array({column}, '[\\s,]+\\s*') END"


def docs(table: str = "events", where: str = "JobUniverse = 5 AND CMS_Type <> 'DONOTMONIT'") -> str:
    """Common table expressions up to ``d``: monitored records with shared values."""
    return f"""{ads_cte(table)},
sel AS (SELECT * FROM job_ads WHERE ({where}) AND TaskType IS DISTINCT FROM 'ROOT'),
d0 AS (SELECT *,
  lower(coalesce(CMS_Type, 'unknown')) = 'analysis' OR coalesce(CMS_JobType, '') = 'Analysis' AS an,
  CASE WHEN JobStatus IN (3, 4, 6) THEN coalesce(nullif(CompletionDate, 0), nullif(JobFinishedHookDone, 0), {L})
    ELSE {L} END AS rt,
  {_case("JobStatus", STATUSES)} AS st,
  CASE WHEN JobStatus = 2 AND EnteredCurrentStatus < {L} THEN {L} - EnteredCurrentStatus
    ELSE coalesce(RemoteWallClockTime, 0) END AS wall,
  CASE WHEN JobStatus = 2 AND EnteredCurrentStatus < {L} THEN {L} - EnteredCurrentStatus
    ELSE coalesce(CommittedTime, 0) END AS committed,
  coalesce(RequestCpus,
    TRY_CAST(nullif(regexp_extract(CreamAttributes, 'CPUNumber = (\\d+)', 1), '') AS BIGINT),
    TRY_CAST(nullif(regexp_extract(NordugridRSL, '\\(count=(\\d+)\\)', 1), '') AS BIGINT), xcount, 1) AS cpus,
  coalesce(MATCH_EXP_JOB_GLIDEIN_CMSSite, MATCH_GLIDEIN_CMSSite, 'Unknown') AS csite,
  coalesce(WMAgent_RequestName, 'UNKNOWN') AS rq,
  coalesce(WMAgent_SubTaskName, '/UNKNOWN') AS sub
  FROM sel),
d AS (SELECT *,
  CASE WHEN ExitCode IS NULL THEN 50666 WHEN an THEN coalesce(JobExitCode, Chirp_CRAB3_Job_ExitCode, ExitCode)
    WHEN Chirp_WMCore_cmsRun_ExitCode > 0 THEN Chirp_WMCore_cmsRun_ExitCode ELSE ExitCode END AS code,
  CASE WHEN suffix(csite, '_Disk') THEN trim(csite, '_Disk') ELSE csite END AS site,
  wall / {H} AS wall_hr, cpus * wall / {H} AS core_hr, cpus * committed / {H} AS committed_core_hr,
  (coalesce(RemoteSysCpu, 0) + coalesce(RemoteUserCpu, 0)) / {H} AS cpu_hr,
  split_part(GlobalJobId, '#', 1) AS schedd,
  {_list("DESIRED_Sites")} AS wanted, {_list("DESIRED_CMSDataLocations")} AS located,
  string_split(sub, '/')[-1] AS step
  FROM d0)
"""


ERROR_TYPE = """CASE WHEN code = 0 THEN 'Success'
  WHEN code BETWEEN 10000 AND 19999 OR code = 50513 THEN 'Environment'
  WHEN code BETWEEN 60000 AND 69999 THEN CASE WHEN code >= 69000 THEN 'Publication' ELSE 'StageOut' END
  WHEN code BETWEEN 80000 AND 89999 THEN 'JobWrapper'
  WHEN code IN (8020, 8028) THEN 'FileOpen' WHEN code = 8021 THEN 'FileRead'
  WHEN code IN (8030, 8031, 8032, 9000) OR code BETWEEN 50660 AND 50669 THEN 'OutOfBounds'
  WHEN code BETWEEN 7000 AND 9000 OR code = 139 THEN 'Executable' ELSE 'Other' END"""

ERROR_CLASS = f"""CASE WHEN ({ERROR_TYPE}) IN ('Environment', 'Publication', 'StageOut') THEN 'System'
  WHEN ({ERROR_TYPE}) IN ('FileOpen', 'FileRead') THEN 'DataAccess'
  WHEN ({ERROR_TYPE}) IN ('JobWrapper', 'OutOfBounds', 'Executable') THEN 'Application'
  WHEN code <> 0 THEN 'Other' ELSE 'Success' END"""

CPU_EFF = "CASE WHEN wall_hr = 0 THEN 0::DOUBLE ELSE 100 * cpu_hr / wall_hr / cpus::DOUBLE END"

FAMILY = """CASE WHEN an THEN 'Analysis'
  WHEN regexp_matches(rq, 'RunIISummer[12][0-9]UL') OR regexp_matches(rq, '_UL[0-9]+') THEN 'MC Ultralegacy'
  WHEN contains(rq, 'UltraLegacy') THEN 'Data Ultralegacy' WHEN contains(rq, 'Phase2') THEN 'Phase2 requests'
  WHEN contains(rq, 'Run3') OR contains(rq, 'RunIII') THEN 'Run3 requests' WHEN contains(rq, 'RVCMSSW') THEN 'RelVal'
  WHEN contains(rq, 'RunII') OR regexp_matches(rq, '(Summer|Fall|Autumn|Winter|Spring)(15|16|17|18|19|20)')
    THEN 'Run2 requests'
  WHEN contains(rq, 'SnowmassWinter21') THEN 'SnowmassWinter21' ELSE 'UNKNOWN' END"""

CAMPAIGN = f"""CASE WHEN coalesce(CMS_CampaignName, '') <> '' THEN CMS_CampaignName
  WHEN an THEN 'crab_' || coalesce(CRAB_UserHN, 'UNKNOWN')
  WHEN prefix(rq, 'PromptReco') THEN 'PromptReco' WHEN prefix(rq, 'Repack') THEN 'Repack'
  WHEN prefix(rq, 'Express') THEN 'Express' WHEN contains(rq, 'RVCMSSW') THEN 'RelVal'
  WHEN regexp_extract(rq, '^[A-Za-z0-9_]+_[A-Z0-9]+-([A-Za-z0-9]+)-', 1) <> ''
    THEN regexp_extract(rq, '^[A-Za-z0-9_]+_[A-Z0-9]+-([A-Za-z0-9]+)-', 1)
  WHEN contains(coalesce(WMAgent_SubTaskName, ''), 'DataProcessing')
    AND regexp_extract(rq, '^[A-Za-z0-9_]+_Run20[A-Za-z0-9_-]+-([A-Za-z0-9]+)', 1) <> ''
    THEN regexp_extract(rq, '^[A-Za-z0-9_]+_Run20[A-Za-z0-9_-]+-([A-Za-z0-9]+)', 1) || 'Reprocessing'
  ELSE {FAMILY} END"""

_C2 = "CASE WHEN contains(step, '-') THEN string_split(step, '-')[2] ELSE step END"
TASK_GUESS = f"""CASE WHEN CMS_JobType = 'Processing' THEN 'DataProcessing' WHEN CMS_JobType = 'Production' THEN
  CASE WHEN contains(step, 'CleanupUnmerged') THEN 'Cleanup' WHEN contains(step, 'Merge') THEN 'Merge'
    WHEN contains(step, 'LogCollect') THEN 'LogCollect'
    WHEN contains(rq, 'MiniAOD') AND step = 'StepOneProc' THEN 'MINIAOD' WHEN contains(step, 'MiniAOD') THEN 'MINIAOD'
    WHEN step = 'StepOneProc' AND regexp_matches({_C2}, '[1-9][0-9]DR') THEN 'DIGIRECO'
    WHEN regexp_matches({_C2}, '[1-9][0-9]GS') AND suffix(step, '_0') THEN 'GENSIM'
    WHEN suffix(step, '_0') THEN 'DIGI' WHEN suffix(step, '_1') OR lower(step) = 'reco' THEN 'RECO'
    WHEN step = 'MonteCarloFromGEN' THEN 'GENSIM' ELSE 'UNKNOWN' END
  ELSE coalesce(CMS_JobType, 'UNKNOWN') END"""

WORKFLOW = """CASE WHEN an THEN CASE WHEN contains(CRAB_Workflow, ':')
    THEN substr(CRAB_Workflow, strpos(CRAB_Workflow, ':') + 1) ELSE coalesce(CRAB_Workflow, 'UNKNOWN') END
  WHEN regexp_extract(rq, '^[A-Za-z0-9_]+_([A-Z]+-[A-Za-z0-9]+-[0-9]+)', 1) <> ''
    THEN regexp_extract(rq, '^[A-Za-z0-9_]+_([A-Z]+-[A-Za-z0-9]+-[0-9]+)', 1)
  WHEN regexp_matches(rq, '^(PromptReco|Repack|Express)_[A-Za-z0-9]+_[A-Za-z0-9]+')
    THEN regexp_extract(rq, '^(PromptReco|Repack|Express)_[A-Za-z0-9]+_([A-Za-z0-9]+)', 1) || '_' ||
         regexp_extract(rq, '^(PromptReco|Repack|Express)_[A-Za-z0-9]+_([A-Za-z0-9]+)', 2)
  WHEN regexp_extract(rq, '^[A-Za-z0-9]+_(RVCMSSW_[0-9]+_[0-9]+_[0-9]+)', 1) <> ''
    THEN regexp_extract(rq, '^[A-Za-z0-9]+_(RVCMSSW_[0-9]+_[0-9]+_[0-9]+)', 1)
  ELSE rq END"""

JOB_TYPE = "coalesce(CMS_JobType, CASE WHEN an THEN 'Analysis' ELSE 'Unknown' END)"
TASK_TYPE = f"""CASE WHEN CMS_extendedJobType IS NOT NULL AND CMS_extendedJobType <> 'UNKNOWN' THEN CMS_extendedJobType
  WHEN CMS_TaskType IS NOT NULL THEN CMS_TaskType WHEN an THEN {JOB_TYPE} ELSE {TASK_GUESS} END"""

LOCALITY = """CASE WHEN DESIRED_CMSDataLocations IS NULL OR contains(DESIRED_CMSDataLocations, site) THEN 'Onsite'
  WHEN site <> 'UNKNOWN' AND JobStatus <> 1 THEN 'Offsite' END"""

# Applications statistics out of the observation columns: totals over steps.
STATS = f"""{docs()},
c AS (SELECT *, k % 10 <> 3 AS has,
  greatest(k * 10, k * 7 + user_id)::DOUBLE AS t_events,
  (k * 30 + user_id + CASE WHEN k % 4 = 0 THEN 5 ELSE 0 END)::DOUBLE AS t_elapsed,
  (k % 2)::DOUBLE AS t_done, (e - k)::DOUBLE AS t_update, k::DOUBLE AS t_lumis, (k % 6)::DOUBLE AS t_files,
  (k % 3 - 1)::DOUBLE AS t_max_files, (k * 1000003)::DOUBLE AS t_read, (k * 1700)::DOUBLE AS t_read_ms,
  (k * 500009)::DOUBLE AS t_write, (k * 900)::DOUBLE AS t_write_ms, k::DOUBLE AS t_ops, (k * 3)::DOUBLE AS t_segments,
  CASE WHEN k % 2 = 0 THEN user_id::DOUBLE END AS t_vops FROM d),
r AS (SELECT *,
  CASE WHEN core_hr > 0 THEN CASE WHEN has THEN t_events ELSE 0 END / (core_hr * {H}) END AS rate,
  CASE WHEN has AND t_done <> 0 AND t_elapsed > 0 THEN t_events / (t_elapsed * cpus) END AS program_rate FROM c)
"""


def _when_stats(value: str, name: str) -> str:
    return f"round(CASE WHEN has THEN {value} END, 6) AS {name}"


def _weighted(prefix: str, score: str, usable: str) -> str:
    parts = []
    rates = [
        ("EventRate", "rate"),
        ("CpuEventRate", "CpuEventRate"),
        ("CpuTimePerEvent", "CpuTimePerEvent"),
        ("TimePerEvent", "CASE WHEN rate > 0 THEN 1 / rate END"),
        ("CoreHr", "core_hr"),
        ("CommittedCoreHr", "committed_core_hr"),
        ("CpuTimeHr", "cpu_hr"),
    ]
    for name, value in rates:
        if name.endswith("EventRate"):
            result = f"CASE WHEN ({value}) > 0 THEN ({value}) / ({score}) END"
        elif name.endswith("PerEvent"):
            result = f"CASE WHEN ({value}) > 0 THEN ({value}) * ({score}) END"
        else:
            result = f"({value}) * ({score})"
        parts.append(f"round(CASE WHEN {usable} THEN {result} END, 6) AS {prefix}{name}")
    return ", ".join(parts)


POST = "CASE WHEN trim(CRAB_PostJobStatus) <> '' THEN upper(trim(CRAB_PostJobStatus)) END"
FINAL = f"coalesce((st = 'Removed' AND ({POST}) <> 'NOT RUN') OR (st = 'Completed' AND ({POST}) IS NOT NULL), false)"

BASE = f"WITH base AS (SELECT {base_sql('events', 'duckdb')} FROM events)"

_HASHED = "CASE WHEN event_id % 2 = 1 THEN substr(GlobalJobId, 7) ELSE GlobalJobId END"
HISTORY = f"""{ads_cte()},
state0 AS (SELECT user_id % 7 AS s, min(e) AS first FROM base WHERE user_id % 7 <> 3 GROUP BY 1),
state1 AS (SELECT 'sched' || s::VARCHAR || '.example.org' AS schedd,
  CASE s WHEN 0 THEN {L} - 30000 WHEN 1 THEN {L} - 20000 ELSE first + s * 86400 END AS last_completion FROM state0),
state AS (SELECT * FROM state1 UNION ALL SELECT 'crab3@' || schedd, last_completion FROM state1),
ads AS (SELECT {_HASHED} AS gid, JobUniverse, CMS_Type, EnteredCurrentStatus, CRAB_PostJobLastUpdate FROM job_ads),
started0 AS (SELECT ads.*, split_part(gid, '#', 1) AS schedd,
  greatest(coalesce(last_completion, {L} - 43200), {L} - 39 * 86400) AS start0
  FROM ads LEFT JOIN state ON split_part(gid, '#', 1) = state.schedd),
started AS (SELECT *, CASE WHEN prefix(schedd, 'crab') AND start0 < {L} - 43200 THEN {L} - 43200 ELSE start0 END AS start
  FROM started0),
read AS (SELECT * FROM started WHERE JobUniverse = 5 AND CMS_Type <> 'DONOTMONIT'
  AND (EnteredCurrentStatus >= start - 720 OR CRAB_PostJobLastUpdate >= start - 720))
"""

DIRECTORY = """WITH people AS (SELECT c_custkey, CASE WHEN c_custkey % 9 <> 5 THEN c_mktsegment END AS institute,
  n_name AS country, '/CN=' || c_name AS dn,
  CASE c_custkey % 4 WHEN 0 THEN NULL WHEN 1 THEN 'user' || c_custkey ELSE 'user' || (c_custkey - c_custkey % 3) END AS login
  FROM customer JOIN nation ON c_nationkey = n_nationkey),
directory AS (SELECT login, institute, country, dn FROM people WHERE login IS NOT NULL AND institute IS NOT NULL
  QUALIFY row_number() OVER (PARTITION BY login ORDER BY c_custkey DESC) = 1)
"""

AFFILIATED = f"""{DIRECTORY}, {docs().removeprefix("WITH ")}
SELECT GlobalJobId, CRAB_UserHN, x509userproxysubject,
  coalesce(a.institute, b.institute) AS AffiliationInstitute, coalesce(a.country, b.country) AS AffiliationCountry
FROM d LEFT JOIN directory a ON a.login = CRAB_UserHN
LEFT JOIN directory b ON CRAB_UserHN IS NULL AND b.dn = x509userproxysubject"""

REGISTRY = """WITH reg AS (SELECT 'crab3@sched' || (s_suppkey % 40)::VARCHAR || '.example.org' AS Name,
  '<10.0.0.' || s_suppkey::VARCHAR || '>' AS MyAddress, '10.0.0.' || s_suppkey::VARCHAR AS ScheddIpAddr,
  s_nationkey FROM supplier WHERE s_suppkey % 10 <> 9 AND s_suppkey % 8 <> 7),
placed AS (SELECT reg.*, r_name AS CMS_Pool, r_regionkey, n_nationkey FROM reg JOIN nation ON s_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey),
schedulers AS (SELECT Name, MyAddress, ScheddIpAddr, CMS_Pool FROM placed
  QUALIFY row_number() OVER (PARTITION BY Name ORDER BY r_regionkey, n_nationkey DESC, MyAddress DESC) = 1)
"""

_COUNTED = f"counted AS (SELECT GlobalJobId, rt, st, coalesce(ResidentSetSize_RAW, 0) / 1024::DOUBLE AS mem FROM d)"
_LO = f"({L} - 31 * 86400)"


def _spine(step: int) -> str:
    return (
        f"SELECT unnest(range({_LO} - {_LO} % {step}, {L} + 1, {step})) AS bucket, st FROM "
        "(VALUES ('Completed'), ('Running'), ('Idle')) AS s(st)"
    )


HISTOGRAM = f"""{docs()}, {_COUNTED},
spine AS ({_spine(300)}),
hist AS (SELECT st, rt - rt % 300 AS bucket, count(*) AS documents, count(DISTINCT GlobalJobId) AS jobs FROM counted
  WHERE rt BETWEEN {_LO} AND {L} GROUP BY ALL)
"""

GAPS = f"""{docs()}, {_COUNTED},
inside AS (SELECT * FROM counted WHERE rt BETWEEN {_LO} AND {L} AND st IN ('Completed', 'Running', 'Idle')),
own AS (SELECT st, count(*) AS own_total FROM inside GROUP BY st),
idx AS (SELECT st, count(*) AS index_total FROM inside WHERE NOT prefix(GlobalJobId, 'crab3@sched0') GROUP BY st),
ser AS (SELECT st, count(*) AS series_total FROM inside WHERE st <> 'Running' OR mem > 180 GROUP BY st),
g0 AS (SELECT s.st, coalesce(own_total, 0) AS own_total, coalesce(index_total, 0) AS index_total, series_total FROM
  (VALUES ('Completed'), ('Running'), ('Idle')) AS s(st) LEFT JOIN own USING (st) LEFT JOIN idx USING (st)
  LEFT JOIN ser USING (st)),
g1 AS (SELECT *, trunc((index_total - series_total)::DOUBLE / nullif(index_total, 0) * 10000) / 10000 AS gap,
  CASE WHEN st = 'Completed' THEN trunc((own_total - index_total)::DOUBLE / nullif(own_total, 0) * 10000) / 10000 END
  AS index_gap FROM g0),
g AS (SELECT *, CASE WHEN abs(gap) > 0.5 THEN 3 WHEN abs(gap) > 0.05 THEN 2 ELSE 0 END::BIGINT AS severity FROM g1)
"""

CHECKED = f"""{BASE},
v AS (SELECT event_id::VARCHAR AS doc_id, 'JobStatus' AS field, 'incorrect_type' AS violation FROM base WHERE k % 5 < 2
UNION ALL SELECT event_id::VARCHAR, 'HasSingularity', 'incorrect_type' FROM base WHERE k % 7 = 0
UNION ALL SELECT event_id::VARCHAR, 'CMSGroups', 'inconsistent_list' FROM base WHERE k % 6 = 0
UNION ALL SELECT event_id::VARCHAR, 'CMSGroups', 'incorrect_type_in_list' FROM base WHERE k % 6 = 1
UNION ALL SELECT event_id::VARCHAR, 'Surprise', 'unknown_key' FROM base WHERE k % 4 = 0
UNION ALL SELECT event_id::VARCHAR, 'ToE', 'invalid_nested' FROM base WHERE k % 8 = 0)
"""

# What each condition of the nested documents means, on its own terms. site: the site is an object.
NESTED = f"""{BASE}, n AS (SELECT event_id, event_id::VARCHAR AS doc_id, k, k % 17 <> 8 AS site FROM base),
nested AS (
  SELECT doc_id, 'Site' AS path, 'incorrect_type' AS violation FROM n WHERE NOT site
  UNION ALL SELECT doc_id, 'Site.Name', 'missing_nested_key' FROM n WHERE site AND k % 7 = 0
  UNION ALL SELECT doc_id, 'Site.Tier', 'incorrect_type' FROM n WHERE site AND k % 5 = 0
  UNION ALL SELECT doc_id, 'Site.Extra', 'unknown_key' FROM n WHERE site AND k % 4 = 1
  UNION ALL SELECT doc_id, 'Steps[].Name', 'missing_nested_key' FROM n WHERE k % 8 = 3
  UNION ALL SELECT doc_id, 'Steps[].Events', 'incorrect_type' FROM n WHERE k % 6 = 2
  UNION ALL SELECT doc_id, 'Steps[]', 'inconsistent_list' FROM n WHERE k % 9 = 4
  UNION ALL SELECT doc_id, 'Tags[]', 'incorrect_type_in_list' FROM n WHERE k % 11 = 5
  UNION ALL SELECT doc_id, 'Surprise', 'unknown_key' FROM n WHERE k % 13 = 6),
paths AS (
  SELECT event_id, 'GlobalJobId' AS path, 'str' AS kind FROM n
  UNION ALL SELECT event_id, 'Site', CASE WHEN site THEN 'dict' ELSE 'str' END FROM n
  UNION ALL SELECT event_id, 'Site.Name', 'str' FROM n WHERE site AND k % 7 <> 0
  UNION ALL SELECT event_id, 'Site.Tier', CASE WHEN k % 5 = 0 THEN 'str' ELSE 'int' END FROM n WHERE site
  UNION ALL SELECT event_id, 'Site.Extra', 'dict' FROM n WHERE site AND k % 4 = 1
  UNION ALL SELECT event_id, 'Site.Extra.deep', 'int' FROM n WHERE site AND k % 4 = 1
  UNION ALL SELECT event_id, 'Steps', 'list' FROM n
  UNION ALL SELECT event_id, 'Steps[]', 'dict' FROM n
  UNION ALL SELECT event_id, 'Steps[]', 'int' FROM n WHERE k % 9 = 4
  UNION ALL SELECT event_id, 'Steps[].Name', 'str' FROM n
  UNION ALL SELECT event_id, 'Steps[].Events', 'float' FROM n
  UNION ALL SELECT event_id, 'Steps[].Events', 'str' FROM n WHERE k % 6 = 2
  UNION ALL SELECT event_id, 'Tags', 'list' FROM n
  UNION ALL SELECT event_id, 'Tags[]', CASE WHEN k % 11 = 5 THEN 'int' ELSE 'str' END FROM n WHERE k % 11 <> 6
  UNION ALL SELECT event_id, 'Surprise', 'dict' FROM n WHERE k % 13 = 6
  UNION ALL SELECT event_id, 'Surprise.a', 'list' FROM n WHERE k % 13 = 6
  UNION ALL SELECT event_id, 'Surprise.a[]', 'dict' FROM n WHERE k % 13 = 6
  UNION ALL SELECT event_id, 'Surprise.a[].b', 'int' FROM n WHERE k % 13 = 6),
inferred AS (
  SELECT path, string_agg(DISTINCT kind, '|' ORDER BY kind) AS kinds, count(DISTINCT event_id) AS documents,
    round(count(DISTINCT event_id) / (SELECT count(*) FROM n), 6) AS share FROM paths GROUP BY path),
clean(path, kinds) AS (VALUES ('GlobalJobId', 'str'), ('Site', 'dict'), ('Site.Name', 'str'), ('Site.Tier', 'int'), ('Steps', 'list'),
  ('Steps[]', 'dict'), ('Steps[].Name', 'str'), ('Steps[].Events', 'float'), ('Tags', 'list'), ('Tags[]', 'str'))
"""

_LINES = f"""{BASE},
lines AS (SELECT event_id, {LOG_LINE_SQL.replace("{S}", "VARCHAR")} AS value,
  CASE WHEN k % 2 = 0 THEN 'condor_queue' ELSE 'condor_history' END AS spider_source FROM base)"""

# What the planted log lines must give, by their number: types, and values as SQL. Stated here once more, not taken from the parser.
_SCHEDD, _KEY = "'sched' || user_id::VARCHAR", "'Key' || k::VARCHAR"
_LOCAL_SCHEMA, _JOB = "'/data/schema' || k::VARCHAR || '.json'", "'job#' || event_id::VARCHAR"
LOG_TYPES = {
    0: "history_schedd_response", 1: "queue_schedd_response", 2: "queue_end", 3: "history_end", 5: "failed_to_query",
    6: "failed_to_process_history", 7: "failed_to_query", 8: "failed_to_convert", 9: "schedd_history_timeout", 10: "schedd_queue_outoftime",
    11: "schedd_queue_nostart", 12: "schedd_queue_timeout", 14: "es_timeout_error", 15: "load_local_validation_schema",
    16: "invalid_local_validation", 17: "validation_schema_not_found", 18: "validation_fail_unknown_key", 19: "validation_fail_conflict",
    21: "validator_invalid_nested", 22: "validator_inconsistent_list", 23: "validator_incorrect_type_in_list", 24: "validator_incorrect_type",
    25: "amq_bunching", 27: "script_end", 28: "inconsistent_doc_number", 29: "listener_premature_close", 30: "listener_abort",
    31: "es_failed_to_index|failed_to_process_history",
}
#: Counts are only read from these if they are above zero.
COUNTED_TYPES = {4: "es_failed_to_index", 13: "listener_end", 26: "script_start"}
LOG_VALUES = {
    "schedd_name": ("VARCHAR", {n: _SCHEDD for n in (0, 1, 6, 7, 8, 9, 10, 11, 12)} | {31: "'sched1'"}),
    "response_count": ("BIGINT", {0: "k", 1: "k"}),
    "query_time": ("DOUBLE", {0: "1.25", 1: "2.75"}),
    "queue_processing_time": ("DOUBLE", {2: "3.5"}),
    "total_sent": ("BIGINT", {2: "k"}),
    "total_received": ("BIGINT", {2: "k + 1"}),
    "total_upload_time": ("DOUBLE", {2: "1.25"}),
    "history_processing_time": ("DOUBLE", {3: "4.75"}),
    "n_failed_to_index": ("BIGINT", {4: "nullif(k, 0)", 31: "5"}),
    "es_error_message": ("VARCHAR", {4: "CASE WHEN k > 0 THEN '[(reason, 3)]' END", 14: "'read timed out'", 31: "'[x]'"}),
    "error_message": ("VARCHAR", {6: "'broken: pipe'", 7: "'no route'", 8: "'KeyError QDate'", 31: "'Failed to index 5 documents to ES: [x]'"}),
    "timelimit": ("BIGINT", {10: "60"}),
    "listener_total_received": ("BIGINT", {13: "nullif(k, 0)"}),
    "validation_schema": ("VARCHAR", {15: _LOCAL_SCHEMA, 16: _LOCAL_SCHEMA, 17: """'"schema' || k::VARCHAR || '.json"'"""}),
    "globaljobid": ("VARCHAR", {18: _JOB, 19: _JOB}),
    "schema": ("VARCHAR", {18: """'"jobs.json"'""", 19: """'"jobs.json"'"""}),
    "unknown_key": ("VARCHAR", {}),
    "unknown_key_value": ("VARCHAR", {}),
    "offending_key": ("VARCHAR", {22: _KEY, 23: _KEY, 24: _KEY}),
    "offending_value": ("VARCHAR", {22: "'[1]'", 23: "'[1]'", 24: "'1'"}),
    "amq_bunch_size": ("BIGINT", {25: "5000"}),
    "n_schedds": ("BIGINT", {26: "nullif(k, 0)"}),
    "total_processing_time": ("DOUBLE", {27: "12.5"}),
}


def _of_line(kind: str, values: dict[int, str]) -> str:
    arms = " ".join(f"WHEN {n} THEN {value}" for n, value in values.items())
    return f"CAST(CASE event_id % 36 {arms} ELSE NULL END AS {kind})" if values else f"CAST(NULL AS {kind})"


_TYPES = {n: f"'{name}'" for n, name in LOG_TYPES.items()} | {n: f"CASE WHEN k > 0 THEN '{name}' END" for n, name in COUNTED_TYPES.items()}
_LOG_COLUMNS = ", ".join(f"{_of_line(kind, values)} AS {name}" for name, (kind, values) in LOG_VALUES.items())

# Lines 20 and 33 are noise; 35 has no header.
LOGS = f"""{_LINES},
heads AS (SELECT base.*, spider_source, event_id % 36 <> 35 AS headed, value FROM base JOIN lines USING (event_id)
  WHERE event_id % 36 NOT IN (20, 33)),
parsed AS (SELECT event_id, spider_source,
  CASE WHEN headed THEN floor(epoch(make_timestamp(2024, 1, 1 + k % 30, 9, 48, (user_id % 60)::DOUBLE)))::BIGINT END AS logged_at,
  CASE WHEN headed THEN 'root' END AS log_source, CASE WHEN headed THEN CASE WHEN k % 3 = 0 THEN 'ERROR' ELSE 'WARNING' END END AS log_level,
  CASE WHEN headed THEN {LOG_MESSAGE_SQL.replace("{S}", "VARCHAR")} ELSE value END AS message,
  coalesce({_of_line("VARCHAR", _TYPES)}, '') AS message_types, nullif(split_part(coalesce({_of_line("VARCHAR", _TYPES)}, ''), '|', 1), '') AS message_type,
  {_LOG_COLUMNS} FROM heads)
"""

# a line without a time belongs to the day it arrived
_LOG_DAY = "coalesce(strftime(make_timestamp(logged_at * 1000000), '%Y-%m-%d'), '2024-02-01')"

_EXTRA = f"""{docs()},
x AS (SELECT GlobalJobId, unnest([
  {{'field': 'GLIDEIN_Job_Max_Time', 'value': (k * 60)::VARCHAR}},
  {{'field': 'GLIDEIN_MaxMemMBs', 'value': CASE WHEN k % 3 = 2 THEN '2500' END}},
  {{'field': 'GLIDEIN_Memory', 'value': CASE WHEN k % 2 = 0 THEN k::VARCHAR ELSE (k + 1)::VARCHAR END}},
  {{'field': 'ImageSize', 'value': (k * 11)::VARCHAR}},
  {{'field': 'MaxWallTimeMins', 'value': CASE WHEN k % 5 = 0 THEN 'plain' ELSE k::VARCHAR END}},
  {{'field': 'JobStartDate', 'value': CASE WHEN k % 4 > 1 THEN e::VARCHAR END}},
  {{'field': 'TransferQueued', 'value': CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END}},
  {{'field': 'HasBeenRouted', 'value': 'true'}},
  {{'field': 'DESIRED_Sites', 'value': 'T2_X'}},
  {{'field': 'SomethingElse', 'value': 'text ' || k::VARCHAR}}]) AS pair FROM d)
SELECT GlobalJobId, pair.field AS field, pair.value AS value FROM x WHERE pair.value IS NOT NULL"""

_PART = "CASE WHEN len(string_split(DESIRED_CMSDataset, '/')) > 3 THEN string_split(DESIRED_CMSDataset, '/')[{}] ELSE 'Unknown' END"
_RELEASE = "'^CMSSW_((\\d*)_(\\d*)_.*)'"
_RELEASED = f"regexp_matches(CRAB_JobSW, {_RELEASE})"
_ENTRY = "MATCH_EXP_JOBGLIDEIN_ResourceName IS NULL AND GlideinEntryName IS NOT NULL"
_ENTRY_SITE = f"""CASE WHEN {_ENTRY} THEN
  CASE WHEN regexp_matches(GlideinEntryName, '^CMS[A-Za-z]*_(.*)_') THEN regexp_extract(GlideinEntryName, '^CMS[A-Za-z]*_(.*)_', 1)
    WHEN regexp_matches(GlideinEntryName, '^[A-Za-z0-9]+_[A-Za-z0-9]+_(.*)_')
    THEN regexp_extract(GlideinEntryName, '^[A-Za-z0-9]+_[A-Za-z0-9]+_(.*)_', 1) ELSE 'UNKNOWN' END
  ELSE coalesce(MATCH_EXP_JOBGLIDEIN_ResourceName, 'UNKNOWN') END"""
_ACTIVE = "st IN ('Running', 'Idle', 'Held')"

_MONITORED = "JobUniverse = 5 AND CMS_Type <> 'DONOTMONIT'"
_FINISHED = f"""{_MONITORED} AND (EnteredCurrentStatus >= {L} - 39 * 86400 - 720
  OR CRAB_PostJobLastUpdate >= {L} - 39 * 86400 - 720)"""
_QUEUED = f"""{_MONITORED} AND (JobStatus NOT IN (3, 4) OR EnteredCurrentStatus >= {L} - 3660
  OR CRAB_PostJobLastUpdate >= {L} - 3660)"""
_LISTED = "split_part(GlobalJobId, '#', 1) IN ('crab3@sched1.example.org', 'crab3@sched4.example.org')"
_CAPPED = "QUALIFY row_number() OVER (PARTITION BY schedd ORDER BY EnteredCurrentStatus, GlobalJobId) <= 101"
_IN_FEED = f"{docs(where='{}')} SELECT GlobalJobId || '#' || rt::VARCHAR AS doc_id, schedd, EnteredCurrentStatus FROM d {_CAPPED}"


REFERENCE_SQL: dict[str, str] = {
    "job_status_docs": f"""{docs()} SELECT GlobalJobId, GlobalJobId || '#' || rt::VARCHAR AS doc_id, rt AS RecordTime,
  coalesce(nullif(CompletionDate, 0), {L}) AS DataCollection, rt AS DataCollectionDate, schedd AS ScheddName,
  'Unknown' AS CMS_Pool, lower(CMS_Type) AS Type, st AS Status, {_case("JobUniverse", UNIVERSES)} AS Universe,
  code AS ExitCode, ExitCode AS CondorExitCode, (code <> 0)::BIGINT AS JobFailed, {ERROR_TYPE} AS ErrorType,
  {ERROR_CLASS} AS ErrorClass FROM d""",
    "exit_code_summary": f"""{docs()} SELECT lower(CMS_Type) AS Type, st AS Status, {ERROR_CLASS} AS ErrorClass,
  {ERROR_TYPE} AS ErrorType, count(*) AS jobs, sum((code <> 0)::BIGINT)::BIGINT AS failed FROM d GROUP BY 1, 2, 3, 4""",
    "core_hour_metrics": f"""{docs()} SELECT GlobalJobId, cpus AS RequestCpus, round(wall_hr, 6) AS WallClockHr,
  round(core_hr, 6) AS CoreHr, round(committed_core_hr, 6) AS CommittedCoreHr,
  round(committed / {H}, 6) AS CommittedWallClockHr, round(cpu_hr, 6) AS CpuTimeHr,
  round(coalesce(DiskUsage_RAW, 0) / 1000000::DOUBLE, 6) AS DiskUsageGB,
  round(coalesce(ResidentSetSize_RAW, 0) / 1024::DOUBLE, 6) AS MemoryMB, round({CPU_EFF}, 6) AS CpuEff,
  (({CPU_EFF}) >= 100)::BIGINT AS CpuEffOutlier, round(greatest(core_hr - committed_core_hr, 0), 6) AS Badput,
  round(greatest(core_hr - cpu_hr, 0), 6) AS CpuBadput,
  round((coalesce(JobCurrentStartDate, {L}) - QDate) / {H}, 6) AS QueueHrs,
  CASE WHEN an AND JobStatus = 2 AND LastMatchTime IS NOT NULL
    THEN coalesce(trunc((MATCH_GLIDEIN_ToDie - EnteredCurrentStatus) / 60::DOUBLE)::BIGINT, -4320) ELSE -1 END::BIGINT
    AS PilotRestLifeTimeMins,
  RemoteWallClockTime, round(TRY_CAST(RequestMemory AS DOUBLE), 6) AS RequestMemory_Eval,
  coalesce(HasBeenTimingTuned, false) AS HasBeenTimingTuned FROM d""",
    "site_locality": f"""{docs()} SELECT GlobalJobId, csite AS GLIDEIN_CMSSite, site AS Site,
  CASE WHEN len(string_split(site, '_')) >= 3 THEN string_split(site, '_')[1] ELSE 'Unknown' END AS Tier,
  CASE WHEN len(string_split(site, '_')) >= 3 THEN string_split(site, '_')[2] ELSE 'Unknown' END AS Country,
  {LOCALITY} AS InputData, CASE WHEN ({LOCALITY}) = 'Offsite' THEN CASE WHEN NOT an THEN 'Unified'
    WHEN list_contains(wanted, site) THEN 'IgnoreLocality' ELSE 'FrontendOverflow' END END AS OverflowType,
  array_to_string(located, '|') AS DataLocations, array_to_string(wanted, '|') AS DESIRED_Sites,
  array_to_string({_list("ExtDESIRED_Sites")}, '|') AS Original_DESIRED_Sites, len(wanted)::BIGINT AS DesiredSiteCount,
  len(located)::BIGINT AS DataLocationsCount, array_to_string({_list("CMSGroups")}, '|') AS CMSGroups FROM d""",
    "entry_name_sites": f"""{docs()}, s AS (SELECT *, {_ENTRY_SITE} AS esite,
  coalesce({_ENTRY} AND regexp_matches(GlideinEntryName, '^CMS[A-Za-z]*_(.*)_'), false) AS by_entry FROM d)
SELECT GlobalJobId, esite AS Site, CASE WHEN by_entry THEN CASE WHEN len(string_split(esite, '_')) >= 3
    THEN string_split(esite, '_')[1] ELSE 'Unknown' END END AS Tier,
  CASE WHEN by_entry THEN CASE WHEN len(string_split(esite, '_')) >= 3
    THEN string_split(esite, '_')[2] ELSE 'Unknown' END END AS Country FROM s""",
    "campaign_workflow": f"""{docs()} SELECT GlobalJobId, {TASK_TYPE} AS TaskType, {CAMPAIGN} AS Campaign,
  {FAMILY} AS CMS_CampaignType, {WORKFLOW} AS Workflow, WMAgent_SubTaskName AS task, {JOB_TYPE} AS CMS_JobType,
  coalesce(CRAB_AsyncDest, 'Unknown') AS CRAB_AsyncDest, step AS WMAgent_TaskType,
  CASE WHEN an THEN k % 3 + (k % 4 > 0)::BIGINT + k % 2 + coalesce(CRAB_SaveLogsFlag, false)::BIGINT END AS OutputFiles
  FROM d""",
    "crab_ids": f"""{docs()} SELECT GlobalJobId, CRAB_Id, CASE WHEN contains(CRAB_Id, '-')
    THEN split_part(CRAB_Id, '-', 1) || '.' || lpad(split_part(CRAB_Id, '-', 2), 6, '0')
    WHEN regexp_full_match(CRAB_Id, '[0-9]+') THEN lpad(CRAB_Id, 6, '0') ELSE '000000' END AS FormattedCrabId,
  coalesce(floor(epoch(try_strptime(split_part(CRAB_Workflow, ':', 1), '%y%m%d_%H%M%S')))::BIGINT, rt)
    AS CRAB_TaskCreationDate FROM d WHERE CRAB_Id IS NOT NULL""",
    "post_job_states": f"""{docs()} SELECT GlobalJobId, st AS Status, CASE WHEN {FINAL} THEN CASE {POST}
    WHEN 'NOT RUN' THEN 'postProc' WHEN 'TRANSFERRING' THEN 'transferring' WHEN 'COOLOFF' THEN 'toRetry'
    WHEN 'FAILED' THEN 'failed' WHEN 'FINISHED' THEN 'finished' ELSE {POST} END
    WHEN CRAB_Id IS NOT NULL THEN st ELSE CRAB_PostJobStatus END AS CRAB_PostJobStatus,
  CASE WHEN {FINAL} AND CompletionDate IS NULL THEN EnteredCurrentStatus ELSE nullif(CompletionDate, 0) END AS CompletionDate,
  CASE WHEN {FINAL} AND coalesce(CommittedTime, 0) = 0 THEN RemoteWallClockTime ELSE CommittedTime END AS CommittedTime,
  CASE WHEN lower(tool) = 'user' THEN 'User' ELSE tool END AS CMS_WMTool FROM (SELECT *, coalesce(CMS_WMTool,
    CASE WHEN CMS_SubmissionTool = 'InstitutionalSchedd' THEN 'User' ELSE 'UNKNOWN' END) AS tool FROM d)""",
    "software_and_identity": f"""{docs()} SELECT GlobalJobId, {_PART.format(2)} AS CMSPrimaryPrimaryDataset,
  {_PART.format(3)} AS CMSPrimaryProcessedDataset, {_PART.format(-1)} AS CMSPrimaryDataTier,
  array_to_string(string_split(x509UserProxyFQAN, ','), '|') AS x509UserProxyFQAN, x509UserProxyVOName AS VO,
  CASE WHEN {_RELEASED} THEN regexp_extract(CRAB_JobSW, {_RELEASE}, 1) ELSE 'Unknown' END AS CMSSWVersion,
  CASE WHEN {_RELEASED} THEN regexp_extract(CRAB_JobSW, {_RELEASE}, 2)::BIGINT::VARCHAR || '_X_X' ELSE 'Unknown' END
    AS CMSSWMajorVersion,
  CASE WHEN {_RELEASED} THEN regexp_extract(CRAB_JobSW, {_RELEASE}, 2)::BIGINT::VARCHAR || '_' ||
    regexp_extract(CRAB_JobSW, {_RELEASE}, 3)::BIGINT::VARCHAR || '_X' ELSE 'Unknown' END AS CMSSWReleaseSeries,
  coalesce(ChirpCMSSWCPUModels, MachineAttrCPUModel0) AS CPUModel,
  coalesce(ChirpCMSSWCPUModels, MachineAttrCPUModel0) AS CPUModelName,
  coalesce(ChirpCMSSWCPUModels, MachineAttrCPUModel0) AS Processor,
  coalesce(MachineAttrHAS_SINGULARITY0, false) AS HasSingularity FROM d""",
    "benchmark_scores": f"""{STATS} SELECT GlobalJobId,
  round(MachineAttrMJF_JOB_HS06_JOB0 / MATCH_EXP_JOB_GLIDEIN_Cpus, 6) AS BenchmarkJobHS06,
  round(MachineAttrDIRACBenchmark0, 6) AS BenchmarkJobDB12,
  {_weighted("HS06", "MachineAttrMJF_JOB_HS06_JOB0 / MATCH_EXP_JOB_GLIDEIN_Cpus",
             "MachineAttrMJF_JOB_HS06_JOB0 / MATCH_EXP_JOB_GLIDEIN_Cpus IS NOT NULL")},
  {_weighted("DB12", "MachineAttrDIRACBenchmark0", "MachineAttrDIRACBenchmark0 IS NOT NULL")} FROM r""",
    "chirp_totals": f"""{STATS} SELECT GlobalJobId,
  CASE WHEN has THEN 28 + 2 * (k % 2 = 0)::BIGINT + (k % 5 <> 0)::BIGINT END AS statistics,
  {_when_stats("t_events", "total_Events")}, {_when_stats("t_elapsed", "total_Elapsed")},
  {_when_stats("t_done", "total_Done")}, {_when_stats("t_update", "total_LastUpdate")},
  {_when_stats("t_lumis", "total_Lumis")}, {_when_stats("t_files", "total_Files")},
  {_when_stats("t_max_files", "total_MaxFiles")}, {_when_stats("t_read", "total_ReadBytes")},
  {_when_stats("t_ops", "total_ReadOps")}, {_when_stats("t_vops", "total_ReadVOps")} FROM r""",
    "chirp_metrics": f"""{STATS} SELECT GlobalJobId, {_when_stats("t_files", "CompletedFiles")},
  {_when_stats("CASE WHEN t_max_files > 0 THEN t_max_files END", "MaxFiles")},
  CASE WHEN has THEN t_done <> 0 END AS CMSSWDone, {_when_stats(f"t_elapsed / {H}", "CMSSWWallHrs")},
  {_when_stats("t_events / 1000::DOUBLE", "KEvents")}, {_when_stats("t_events / 1000000::DOUBLE", "MegaEvents")},
  {_when_stats(f"greatest(rt - t_update, 0) / {H}", "SinceLastCMSSWUpdateHrs")},
  {_when_stats(f"CASE WHEN st = 'Completed' THEN greatest(rt - t_update, 0) / {H} END", "StageOutHrs")},
  {_when_stats("t_lumis / 1000::DOUBLE", "CMSSWKLumis")}, {_when_stats("t_read / 1e9", "InputGB")},
  {_when_stats("t_read_ms / 3600000::DOUBLE", "ReadTimeHrs")}, {_when_stats("t_read_ms / 60000::DOUBLE", "ReadTimeMins")},
  {_when_stats("t_write / 1e9", "OutputGB")}, {_when_stats("t_write_ms / 3600000::DOUBLE", "WriteTimeHrs")},
  {_when_stats("t_write_ms / 60000::DOUBLE", "WriteTimeMins")}, round(program_rate, 6) AS CMSSWEventRate,
  round(CASE WHEN program_rate > 0 THEN 1 / program_rate END, 6) AS CMSSWTimePerEvent, round(rate, 6) AS EventRate,
  round(CASE WHEN rate > 0 THEN 1 / rate END, 6) AS TimePerEvent,
  {_when_stats("CASE WHEN t_ops + t_segments <> 0 THEN t_ops / (t_ops + t_segments) * 100 END", "ReadOpSegmentPercent")},
  {_when_stats("CASE WHEN t_ops + t_vops <> 0 THEN t_ops / (t_ops + t_vops) * 100 END", "ReadOpsPercent")} FROM r""",
    "chirp_site_reads": f"""{docs()}
SELECT GlobalJobId, 'T2_CH_Beta' AS SiteName, 'cmsRun1' AS ChirpString, k::DOUBLE AS ReadBytes, (k + 1)::DOUBLE AS ReadTimeMS
FROM d WHERE k % 10 <> 3 AND k % 3 > 0 UNION ALL
SELECT GlobalJobId, 'CACHE', '', (k + 2)::DOUBLE, (k + 3)::DOUBLE FROM d WHERE k % 10 <> 3 AND k % 5 = 0""",
    "untyped_attributes": _EXTRA,
    "typed_casts": f"""{BASE} SELECT event_id, (k % 4) <> 3 AS text_bool, CASE WHEN k % 4 = 0 THEN k END AS text_long,
  CASE WHEN k % 4 = 0 THEN nullif(k, 0) END AS text_date, k <> 35 AS number_bool,
  trunc(k::DOUBLE / 7 - 5)::BIGINT AS number_long, nullif(trunc(k::DOUBLE / 7 - 5)::BIGINT, 0) AS number_date,
  CASE WHEN k % 3 > 0 THEN k % 2 = 0 END AS flag_bool,
  CASE WHEN k % 3 > 0 THEN CASE WHEN k % 2 = 0 THEN 'True' ELSE 'False' END END AS flag_string FROM base""",
    "active_skim": f"""{docs()} SELECT GlobalJobId, st AS Status, round({CPU_EFF}, 6) AS CpuEff,
  (({CPU_EFF}) >= 100)::BIGINT AS CpuEffOutlier, round(core_hr, 6) AS CoreHr,
  CASE WHEN NOT {_ACTIVE} THEN {ERROR_TYPE} END AS ErrorType, CASE WHEN NOT {_ACTIVE} THEN code END AS ExitCode,
  CASE WHEN {_RELEASED} THEN regexp_extract(CRAB_JobSW, {_RELEASE}, 1) ELSE 'Unknown' END AS CMSSWVersion,
  CASE WHEN NOT {_ACTIVE} THEN round(greatest(core_hr - committed_core_hr, 0), 6) END AS Badput,
  CASE WHEN NOT {_ACTIVE} THEN Owner END AS Owner, DESIRED_CMSDataset FROM d""",
    "decoded_messages": "SELECT doc_id, text FROM documents",
    "history_select": f"{HISTORY} SELECT gid AS GlobalJobId, EnteredCurrentStatus, start FROM read",
    "queue_select": f"""{ads_cte()} SELECT GlobalJobId, JobStatus FROM job_ads
WHERE JobUniverse = 5 AND CMS_Type <> 'DONOTMONIT' AND (JobStatus NOT IN (3, 4)
  OR EnteredCurrentStatus >= {L} - 5 * 86400 - 3660 OR CRAB_PostJobLastUpdate >= {L} - 5 * 86400 - 3660)""",
    "checkpoint_update": f"""{HISTORY}, fresh AS (SELECT schedd, greatest(max(EnteredCurrentStatus), max(start)) AS lc
  FROM read GROUP BY schedd)
SELECT schedd, max(lc) AS last_completion FROM (SELECT schedd, lc FROM fresh UNION ALL SELECT schedd, last_completion FROM state)
GROUP BY schedd""",
    "ad_hoc_lookup": f"""{ads_cte()} SELECT GlobalJobId, RequestCpus, JobStatus FROM job_ads
WHERE JobUniverse = 5 AND CMS_Type <> 'DONOTMONIT' AND (EnteredCurrentStatus >= {L} - 43201 * 60
  OR CRAB_PostJobLastUpdate >= {L} - 43201 * 60) AND RequestCpus > 2 AND CMS_JobType = 'Analysis'
  AND split_part(GlobalJobId, '#', 1) IN ('crab3@sched1.example.org', 'crab3@sched4.example.org')""",
    "capped_scan": f"""{docs()} SELECT GlobalJobId, schedd AS ScheddName FROM d
QUALIFY row_number() OVER (PARTITION BY schedd ORDER BY GlobalJobId) <= 251""",
    "latest_docs": f"""{docs("lineitem")} SELECT event_id, GlobalJobId, EnteredCurrentStatus, st AS Status, code AS ExitCode,
  round(core_hr, 6) AS CoreHr FROM d
QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY EnteredCurrentStatus DESC, GlobalJobId DESC) = 1""",
    "repeated_run": f"""{docs()} SELECT GlobalJobId || '#' || rt::VARCHAR AS doc_id, GlobalJobId, st AS Status,
  EnteredCurrentStatus, 'condor_queue' AS spider_source FROM d""",
    "daily_index_counts": f"""{docs()} SELECT 'jobs-' || strftime(make_timestamp(QDate * 1000000), '%Y-%m-%d') AS index,
  st AS Status, count(*) AS documents FROM d GROUP BY 1, 2""",
    "index_bodies": f"""{docs()} SELECT GlobalJobId || '#' || rt::VARCHAR AS doc_id,
  'jobs-' || strftime(make_timestamp(QDate * 1000000), '%Y-%m-%d') AS index,
  '{{"index":{{"_id":"' || GlobalJobId || '#' || rt::VARCHAR || '"}}}}' AS action, st AS status, code AS exit_code,
  {L} * 1000 AS runtime, 'condor_history' AS source FROM d""",
    "broker_messages": f"""{docs()} SELECT GlobalJobId || '#' || rt::VARCHAR AS key, rt * 1000 AS ts,
  QDate * 1000 AS queued_ms, CASE WHEN {FINAL} AND CompletionDate IS NULL THEN EnteredCurrentStatus
    ELSE nullif(CompletionDate, 0) END * 1000 AS completed_ms, st AS status, 'condor_queue' AS source FROM d""",
    "failure_summary": f"""{BASE}, f AS (SELECT CASE WHEN g = 1 THEN 'mapper error ' || (k % 6)::VARCHAR
    WHEN k = 7 THEN 'timeout' END AS reason FROM base),
t AS (SELECT reason, count(*) AS failures FROM f WHERE reason IS NOT NULL GROUP BY reason ORDER BY 2 DESC, 1 LIMIT 3)
SELECT reason, failures FROM t UNION ALL SELECT NULL, count(reason) FROM f""",
    "scheduler_counts": f"""{docs()} SELECT schedd AS ScheddName, count(*) AS queried, count(*) AS processed,
  true AS consistent FROM d GROUP BY schedd""",
    "documents_per_scheduler": f"{docs()} SELECT schedd AS ScheddName, count(*) AS documents FROM d GROUP BY schedd",
    "upload_totals": f"""{BASE}, u AS (SELECT k + 5 AS received, k + 5 - CASE WHEN k % 9 = 0 THEN 3 ELSE 0 END AS sent,
  user_id AS elapsed FROM base)
SELECT sum(sent)::BIGINT AS total_sent, sum(received)::BIGINT AS total_received,
  round(sum(sent)::DOUBLE / sum(received), 6) AS send_ratio, round(sum(elapsed)::DOUBLE / 60, 6) AS upload_minutes FROM u""",
    "quarantined_records": f"""{docs()}, f AS (SELECT GlobalJobId, [x FOR x IN [
  CASE WHEN event_id % 23 = 0 THEN 'JobStatus is missing' END, CASE WHEN event_id % 11 = 0 THEN 'QDate is missing' END,
  CASE WHEN event_id % 13 = 0 THEN 'CRAB_Id is malformed' END, CASE WHEN event_id % 17 = 0 THEN 'CRAB_JobSW is malformed' END,
  CASE WHEN event_id % 19 = 0 AND (CASE WHEN event_id % 23 <> 0 THEN wall ELSE RemoteWallClockTime END) <> 0
    THEN 'RequestCpus is zero' END] IF x IS NOT NULL] AS errors FROM d)
SELECT GlobalJobId, array_to_string(errors, '; ') AS errors FROM f WHERE len(errors) > 0""",
    "json_records": f"""{STATS} SELECT GlobalJobId, st AS Status, code AS ExitCode, site AS Site, round(core_hr, 6) AS CoreHr,
  round(rate, 6) AS EventRate, coalesce(MachineAttrHAS_SINGULARITY0, false) AS HasSingularity,
  CASE WHEN contains(CRAB_Id, '-') THEN split_part(CRAB_Id, '-', 1) || '.' || lpad(split_part(CRAB_Id, '-', 2), 6, '0')
    WHEN regexp_full_match(CRAB_Id, '[0-9]+') THEN lpad(CRAB_Id, 6, '0') WHEN CRAB_Id IS NOT NULL THEN '000000' END
    AS FormattedCrabId,
  CASE WHEN an THEN k % 3 + (k % 4 > 0)::BIGINT + k % 2 + coalesce(CRAB_SaveLogsFlag, false)::BIGINT END AS OutputFiles
  FROM r""",
    "affiliation_directory": f"{DIRECTORY} SELECT login, institute, country, dn FROM directory",
    "affiliation_join": AFFILIATED,
    "affiliation_join_shuffled": AFFILIATED,
    "registry_schedulers": f"{REGISTRY} SELECT Name, MyAddress, ScheddIpAddr, CMS_Pool FROM schedulers",
    "pool_of_jobs": f"""{REGISTRY}, {ads_cte().removeprefix("WITH ")},
placed_jobs AS (SELECT coalesce(CMS_Pool, 'Unknown') AS CMS_Pool FROM job_ads LEFT JOIN schedulers
  ON split_part(GlobalJobId, '#', 1) = Name AND Name IN ('crab3@sched1.example.org', 'crab3@sched2.example.org',
  'crab3@sched5.example.org') WHERE JobUniverse = 5 AND CMS_Type <> 'DONOTMONIT')
SELECT CMS_Pool, count(*) AS jobs FROM placed_jobs GROUP BY CMS_Pool""",
    "index_histogram": f"""{HISTOGRAM} SELECT spine.st AS Status, spine.bucket, coalesce(documents, 0) AS documents,
  coalesce(jobs, 0) AS jobs FROM spine LEFT JOIN hist ON hist.st = spine.st AND hist.bucket = spine.bucket""",
    "series_histogram": f"""{docs()}, {_COUNTED}, spine AS ({_spine(720)}),
hist AS (SELECT st, rt - rt % 720 AS bucket, count(nullif(mem, 0)) AS points FROM counted
  WHERE rt BETWEEN {_LO} AND {L} GROUP BY ALL)
SELECT spine.st AS Status, spine.bucket, points FROM spine LEFT JOIN hist ON hist.st = spine.st AND hist.bucket = spine.bucket""",
    "source_gaps": f"""{GAPS} SELECT st AS Status, own_total::BIGINT AS own_total, index_total::BIGINT AS index_total,
  series_total::BIGINT AS series_total, round(gap, 6) AS gap, round(index_gap, 6) AS index_gap,
  coalesce(abs(index_gap) > 0.05, false) AS index_differs, severity FROM g""",
    "alert_records": f"""{GAPS} SELECT severity AS case,
  CASE severity WHEN 3 THEN 'email|ticket' ELSE 'email' END AS targets, 'notifier' AS source, 'validation' AS alert_name,
  CASE severity WHEN 3 THEN 'ERROR' ELSE 'WARNING' END AS status,
  CASE severity WHEN 3 THEN 'jobs|index|series' ELSE 'jobs' END AS entities, 'comparison' AS summary,
  'values differ for ' || st AS description, {L} AS timestamp FROM g WHERE severity > 0""",
    "schema_violations": f"{CHECKED} SELECT doc_id, field, violation FROM v",
    "conflicting_documents": f"""{CHECKED} SELECT doc_id, count(*) FILTER (violation = 'unknown_key') AS unknown_keys,
  count(*) FILTER (violation <> 'unknown_key') AS conflicts FROM v GROUP BY doc_id""",
    "nested_violations": f"{NESTED} SELECT doc_id, path, violation FROM nested",
    "example_schema": f"{NESTED} SELECT path, kinds, documents, share FROM inferred",
    "stored_schema": f"""{NESTED} SELECT path, coalesce(i.kinds, c.kinds) AS kinds,
  CASE WHEN c.kinds IS NULL THEN 'added' WHEN i.kinds = c.kinds THEN 'same' ELSE 'conflict' END AS change
FROM inferred i FULL JOIN clean c USING (path)""",
    "own_schema_violations": f"""{NESTED} SELECT 'missing_nested_key' AS violation, path, count(*) AS documents FROM (
  SELECT 'Site.Name' AS path FROM n WHERE site AND k % 7 = 0
  UNION ALL SELECT 'Site.Extra' FROM n WHERE site AND k % 4 <> 1
  UNION ALL SELECT 'Steps[].Name' FROM n WHERE k % 8 = 3) GROUP BY path""",
    "log_events": f"""{LOGS} SELECT event_id, spider_source, logged_at, log_source, log_level, message,
  message_type, message_types, {", ".join(LOG_VALUES)} FROM parsed""",
    "log_index_counts": f"""{LOGS} SELECT 'run-logs-' || {_LOG_DAY} AS index, message_type,
  count(*) AS events FROM parsed GROUP BY 1, 2""",
    "missing_fields": f"""{_LINES} SELECT DISTINCT unnest(regexp_extract_all(value, 'key=([^,]*)', 1)) AS field FROM lines
WHERE contains(value, 'key=') AND regexp_extract(value, 'key=([^,]*)', 1) NOT IN ('', 'Owner')""",
    "frequent_values": f"""{docs()}, n AS (SELECT st, site, count(*) AS c FROM d GROUP BY ALL)
SELECT st AS Status, site AS Site, c AS occurrences FROM n QUALIFY row_number() OVER (PARTITION BY st ORDER BY c DESC, site) = 1""",
    "line_item_documents": f"""{docs("lineitem")} SELECT st AS Status, {ERROR_TYPE} AS ErrorType, lower(CMS_Type) AS Type,
  count(*) AS jobs, sum(cpus)::BIGINT AS cpus, count({CAMPAIGN}) AS campaigns, count(DISTINCT {WORKFLOW}) AS workflows,
  sum(len(wanted))::BIGINT AS wanted_sites, round(max({CPU_EFF}), 6) AS best_efficiency,
  count(*) FILTER (({LOCALITY}) = 'Offsite') AS offsite FROM d GROUP BY 1, 2, 3""",
    "streamed_incremental": f"""{HISTORY}, fresh AS (SELECT schedd, greatest(max(EnteredCurrentStatus), max(start)) AS lc
  FROM read GROUP BY schedd)
SELECT 'read' AS kind, gid AS name, EnteredCurrentStatus AS at, start FROM read
UNION ALL SELECT 'place', schedd, max(lc), NULL FROM (SELECT schedd, lc FROM fresh UNION ALL SELECT schedd, last_completion FROM state)
GROUP BY schedd""",
    "streamed_documents": f"""{docs()} SELECT GlobalJobId || '#' || rt::VARCHAR AS doc_id,
  'jobs-' || strftime(make_timestamp(QDate * 1000000), '%Y-%m-%d') AS index, st AS Status, code AS ExitCode, site AS Site,
  round(core_hr, 6) AS CoreHr FROM d""",
    "streamed_logs": f"""{LOGS} SELECT event_id, message_type, schedd_name,
  'run-logs-' || {_LOG_DAY} AS index FROM parsed""",
    "history_run": f"""{docs(where=_FINISHED)} SELECT GlobalJobId || '#' || rt::VARCHAR AS doc_id,
  'jobs-' || strftime(make_timestamp(QDate * 1000000), '%Y-%m-%d') AS index, 'Unknown' AS CMS_Pool, st AS Status,
  code AS ExitCode, site AS Site, round(core_hr, 6) AS CoreHr FROM d""",
    "queue_run": f"""{REGISTRY}, {DIRECTORY.removeprefix("WITH ")}, {docs(where=_QUEUED).removeprefix("WITH ")}
SELECT GlobalJobId || '#' || rt::VARCHAR AS doc_id,
  CASE WHEN event_id % 9 = 0 THEN 'Own' ELSE coalesce(CMS_Pool, 'Unknown') END AS CMS_Pool, st AS Status,
  round(core_hr, 6) AS CoreHr, coalesce(a.institute, b.institute) AS AffiliationInstitute,
  coalesce(a.country, b.country) AS AffiliationCountry
FROM d LEFT JOIN schedulers ON Name = schedd LEFT JOIN directory a ON a.login = CRAB_UserHN
LEFT JOIN directory b ON CRAB_UserHN IS NULL AND b.dn = x509userproxysubject""",
    "run_then_state": f"""WITH history AS ({_IN_FEED.format(_FINISHED + " AND " + _LISTED)}),
queue AS ({_IN_FEED.format(_QUEUED + " AND " + _LISTED)}),
written AS (SELECT doc_id, schedd FROM history UNION SELECT doc_id, schedd FROM queue)
SELECT schedd, greatest(max(EnteredCurrentStatus), {L} - 39 * 86400) AS last_completion,
  (SELECT count(*) FROM written w WHERE w.schedd = history.schedd) AS documents FROM history GROUP BY schedd""",
}

# A stream's closed buckets are those of the batch: the document a day later is in an open one, the late one is refused.
REFERENCE_SQL["streamed_index_histogram"] = REFERENCE_SQL["index_histogram"]
REFERENCE_SQL["streamed_series_histogram"] = REFERENCE_SQL["series_histogram"]

REFERENCE_SQL |= {
    "upserted_index": f"""{docs()}, t AS (SELECT *, CAST(split_part(split_part(GlobalJobId, '#', 2), '.', 1) AS BIGINT) % 3 = 0 AS newer FROM d)
SELECT GlobalJobId || '#' || rt::VARCHAR AS doc_id, 'jobs-' || strftime(make_timestamp(QDate * 1000000), '%Y-%m-%d') AS index,
  CASE WHEN newer THEN 'Newer' ELSE st END AS Status, code AS ExitCode,
  CASE WHEN newer THEN 'history' ELSE 'queue' END AS feed, CAST(CASE WHEN newer THEN 200 ELSE 100 END AS BIGINT) AS written FROM t""",
    "sketched_jobs": f"""{docs()}, {_COUNTED} SELECT st AS Status, rt - rt % 86400 AS bucket, count(DISTINCT GlobalJobId) AS jobs, true AS within
FROM counted WHERE rt BETWEEN {_LO} AND {L} GROUP BY 1, 2""",
    "sketched_failures": f"""{BASE}, f AS (SELECT g, CASE WHEN g = 1 THEN 'mapper error ' || (k % 6)::VARCHAR
    WHEN k % 7 = 3 THEN 'reason ' || (event_id % 5000)::VARCHAR WHEN k % 7 = 4 THEN 'timeout ' || (k % 4)::VARCHAR END AS reason FROM base),
t AS (SELECT g, reason, count(*) AS occurrences FROM f WHERE reason IS NOT NULL GROUP BY g, reason)
SELECT CAST(g AS BIGINT) AS g, reason, occurrences FROM t QUALIFY row_number() OVER (PARTITION BY g ORDER BY occurrences DESC, reason) <= 3""",
    "sketched_frequent_values": REFERENCE_SQL["frequent_values"],
    "bunched_messages": f"{docs()} SELECT GlobalJobId || '#' || rt::VARCHAR AS key, rt * 1000 AS ts, true AS fits FROM d",
    "bunch_totals": f"""{docs()}, m AS (SELECT GlobalJobId || '#' || rt::VARCHAR AS key FROM d),
t AS (SELECT count(*) FILTER (length(key) % 2 = 1) AS s, count(*) AS r FROM m)
SELECT s AS total_sent, r AS total_received, round(s / r, 6) AS send_ratio, true AS timed FROM t""",
    "run_counts": f"""{docs()}, r AS (SELECT 'condor_history' AS feed, event_id % 11 = 5 AS bad FROM d
  WHERE EnteredCurrentStatus >= {L} - 39 * 86400 - 720 OR CRAB_PostJobLastUpdate >= {L} - 39 * 86400 - 720
  UNION ALL SELECT 'condor_queue', event_id % 11 = 5 FROM d
  WHERE JobStatus NOT IN (3, 4) OR EnteredCurrentStatus >= {L} - 3660 OR CRAB_PostJobLastUpdate >= {L} - 3660)
SELECT feed, count(*) AS queried, count(*) FILTER (NOT bad) AS processed, count(*) FILTER (bad) AS quarantined, true AS consistent,
  count(*) FILTER (bad) AS stored FROM r GROUP BY feed""",
}

REFERENCE_SQL |= {
    "pools_from_file": REFERENCE_SQL["registry_schedulers"],
    "stored_directory": REFERENCE_SQL["affiliation_directory"],
    "streamed_log_files": f"""{LOGS} SELECT spider_source, message_type, 'run-logs-' || {_LOG_DAY} AS index, count(*) AS events
FROM parsed GROUP BY 1, 2, 3""",
    "offline_documents": f"""{STATS} SELECT GlobalJobId, st AS Status, code AS ExitCode, CASE WHEN k % 2 = 0 THEN k ELSE k + 1 END AS GLIDEIN_Memory,
  CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END AS TransferQueued, 'text ' || k::VARCHAR AS SomethingElse,
  round(CASE WHEN has THEN t_elapsed END, 6) AS ChirpCMSSWElapsed, true AS flat FROM r""",
    "fed_stores": f"""{docs(where=_FINISHED)} SELECT store, count(*) AS documents, count(DISTINCT GlobalJobId || '#' || rt::VARCHAR) AS ids
FROM d, (VALUES ('one'), ('two'), ('broker')) AS s(store) GROUP BY store""",
    "limited_lookup": f"""{ads_cte()} SELECT split_part(GlobalJobId, '#', 1) AS schedd, least(count(*), 7) AS records, true AS fitting FROM job_ads
WHERE {_MONITORED} AND (EnteredCurrentStatus >= {L} - 43201 * 60 OR CRAB_PostJobLastUpdate >= {L} - 43201 * 60) AND RequestCpus > 2
  AND split_part(GlobalJobId, '#', 1) = 'crab3@sched1.example.org' GROUP BY 1""",
    "micro_batches": f"""{ads_cte()} SELECT event_id % 3 AS batch, count(*) AS records, count(DISTINCT GlobalJobId) AS jobs FROM job_ads GROUP BY 1""",
    "decoded_literals": f"""{BASE} SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'Job killed' WHEN 1 THEN 'Fehler: über 2 GB' || chr(10) || 'Ende'
  WHEN 2 THEN '' WHEN 3 THEN 'plain words' ELSE 'eJzzyk9SyM7M' END AS text FROM base""",
    "typed_bodies": f"""{STATS}, b AS (SELECT *, unnest([
    {{'store': 'index', 'ms': 1}}, {{'store': 'broker', 'ms': 1000}}]) AS s FROM r),
x AS (SELECT GlobalJobId, s.store AS store, unnest([
  {{'field': 'QDate', 'kind': 'int', 'value': (QDate * s.ms)::VARCHAR}},
  {{'field': 'GLIDEIN_Job_Max_Time', 'kind': 'int', 'value': (k * 60)::VARCHAR}},
  {{'field': 'GLIDEIN_Memory', 'kind': 'int', 'value': CASE WHEN k % 2 = 0 THEN k::VARCHAR ELSE (k + 1)::VARCHAR END}},
  {{'field': 'ImageSize', 'kind': 'int', 'value': (k * 11)::VARCHAR}},
  {{'field': 'JobStartDate', 'kind': 'int', 'value': CASE WHEN k % 4 > 1 THEN (e * s.ms)::VARCHAR END}},
  {{'field': 'TransferQueued', 'kind': 'bool', 'value': CASE WHEN k % 3 = 0 THEN 'true' ELSE 'false' END}},
  {{'field': 'SomethingElse', 'kind': 'str', 'value': 'text ' || k::VARCHAR}},
  {{'field': 'ChirpCMSSWElapsed', 'kind': 'float', 'value': CASE WHEN has THEN t_elapsed::BIGINT::VARCHAR END}},
  {{'field': 'ChirpCMSSWLastUpdate', 'kind': 'float', 'value': CASE WHEN has THEN (t_update::BIGINT * s.ms)::VARCHAR END}}]) AS p FROM b)
SELECT store, GlobalJobId, p.field AS field, p.kind AS kind, p.value AS value FROM x WHERE p.value IS NOT NULL""",
    "mapped_fields": f"""{docs()}, n AS (SELECT count(*) AS documents FROM d)
SELECT field, documents, type, format FROM n, (VALUES ('GlobalJobId', NULL, NULL), ('Status', NULL, NULL), ('CoreHr', NULL, NULL),
  ('ExitCode', NULL, NULL), ('RequestCpus', 'long', NULL), ('HasSingularity', 'boolean', NULL), ('QDate', 'date', 'epoch_second'),
  ('RecordTime', 'date', 'epoch_second')) AS m(field, type, format)""",
}
