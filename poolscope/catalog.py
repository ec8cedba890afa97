"""Attribute catalogue: which attributes exist, how they are typed and which are kept.

The catalogue drives three things: the casts of the bulk copy, the output pruning and
the field descriptors (index mapping, ``StructType``) of the document store.
"""

from __future__ import annotations

import json
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

# --------------------------------------------------------------------------------------
# Fixed values. Attribute names are an external contract, so they are stated literally.
# --------------------------------------------------------------------------------------

# Attributes delivered as text.
STRING_ATTRS = """
    AutoClusterId AffiliationInstitute AffiliationCountry Processor ChirpCMSSWCPUModels CPUModel
    CPUModelName CMSPrimaryPrimaryDataset CMSPrimaryProcessedDataset CMSPrimaryDataTier
    CMSSWVersion CMSSWMajorVersion CMSSWReleaseSeries CRAB_JobType CRAB_JobSW CRAB_JobArch CRAB_Id
    CRAB_ISB CRAB_PostJobStatus CRAB_Workflow CRAB_UserRole CMSGroups CRAB_UserHN CRAB_UserGroup
    CRAB_TaskWorker CRAB_SiteWhitelist CRAB_SiteBlacklist CRAB_SplitAlgo CRAB_PrimaryDataset Args
    AccountingGroup Cmd CMS_JobType CMS_WMTool DESIRED_Archs DESIRED_CMSDataLocations
    DESIRED_CMSDataset DESIRED_Sites ExtDESIRED_Sites FormattedCrabId GlobalJobId GlideinClient
    GlideinEntryName GlideinFactory GlideinFrontendName GlideinName GLIDECLIENT_Name
    GLIDEIN_Entry_Name GLIDEIN_Factory GlobusRSL GridJobId LastRemoteHost
    MachineAttrCMSSubSiteName0 MATCH_EXP_JOB_GLIDECLIENT_Name MATCH_EXP_JOB_GLIDEIN_ClusterId
    MATCH_EXP_JOB_GLIDEIN_CMSSite MATCH_EXP_JOB_GLIDEIN_Entry_Name MATCH_EXP_JOB_GLIDEIN_Factory
    MATCH_EXP_JOB_GLIDEIN_Name MATCH_EXP_JOB_GLIDEIN_Schedd MATCH_EXP_JOB_GLIDEIN_SEs
    MATCH_EXP_JOB_GLIDEIN_Site MATCH_EXP_JOB_GLIDEIN_SiteWMS MATCH_EXP_JOB_GLIDEIN_SiteWMS_JobId
    MATCH_EXP_JOB_GLIDEIN_SiteWMS_Queue MATCH_EXP_JOB_GLIDEIN_SiteWMS_Slot
    MachineAttrCUDACapability0 MachineAttrCUDADeviceName0 MachineAttrCUDADriverVersion0 Owner Rank
    RemoteHost REQUIRED_OS ShouldTransferFiles StartdIpAddr StartdPrincipal User
    WhenToTransferOutput WMAgent_AgentName WMAgent_RequestName WMAgent_SubTaskName
    x509UserProxyEmail x509UserProxyFirstFQAN x509UserProxyFQAN x509userproxysubject
    x509UserProxyVOName InputData Original_DESIRED_Sites WMAgent_TaskType NordugridRSL Campaign
    TaskType DataLocations Workflow Site Tier Country Status Universe ExitReason LastHoldReason
    RemoveReason DESIRED_Overflow_Region DESIRED_OpSysMajorVers DAGNodeName DAGParentNodeNames
    OverflowType ScheddName
""".split()

# Attributes delivered as 64-bit integers. "NumGlobusSubmitsNumJobMatches" is one name: neither of
# the two attributes it looks like is cast.
LONG_ATTRS = """
    CRAB_Retry BytesRecvd BytesSent ClusterId CommittedSlotTime CumulativeSlotTime
    CumulativeSuspensionTime CurrentHosts CRAB_JobCount DelegatedProxyExpiration DiskUsage_RAW
    ExecutableSize_RAW ExitStatus GlobusStatus ImageSize_RAW JobPrio JobRunCount JobStatus
    JobFailed JobUniverse LastJobStatus LocalSysCpu LocalUserCpu MachineAttrCpus0
    MachineAttrSlotWeight0 MachineAttrCUDAComputeUnits0 MachineAttrCUDACoresPerCU0
    MachineAttrCUDAGlobalMemoryMb0 MATCH_EXP_JOB_GLIDEIN_Job_Max_Time
    MATCH_EXP_JOB_GLIDEIN_MaxMemMBs MATCH_EXP_JOB_GLIDEIN_Max_Walltime MATCH_EXP_JOB_GLIDEIN_Memory
    MATCH_EXP_JOB_GLIDEIN_ProcId MATCH_EXP_JOB_GLIDEIN_ToDie MATCH_EXP_JOB_GLIDEIN_ToRetire
    MaxHosts MaxWallTimeMins_RAW MemoryUsage MinHosts NumGlobusSubmitsNumJobMatches NumJobStarts
    NumRestarts NumShadowStarts NumSystemHolds PilotRestLifeTimeMins PostJobPrio1 PostJobPrio2
    ProcId RecentBlockReadKbytes RecentBlockReads RecentBlockWriteKbytes RecentBlockWrites
    RemoteSlotID RemoteSysCpu RemoteUserCpu RemoteWallClockTime RequestCpus RequestDisk_RAW
    RequestMemory_RAW ResidentSetSize_RAW StatsLifetimeStarter TotalSuspensions TransferInputSizeMB
    WallClockCheckpoint WMAgent_JobID DesiredSiteCount DataLocationsCount
""".split()

# Attributes delivered as epoch seconds.
DATE_ATTRS = """
    CompletionDate CRAB_TaskCreationDate EnteredCurrentStatus JobCurrentStartDate
    JobCurrentStartExecutingDate JobCurrentStartTransferOutputDate JobLastStartDate JobStartDate
    LastMatchTime LastSuspensionTime LastVacateTime_RAW MATCH_GLIDEIN_ToDie MATCH_GLIDEIN_ToRetire
    QDate ShadowBday StageInFinish StageInStart JobFinishedHookDone LastJobLeaseRenewal
    LastRemoteStatusUpdate GLIDEIN_ToDie GLIDEIN_ToRetire DataCollectionDate RecordTime
    ChirpCMSSWLastUpdate
""".split()

# Attributes delivered as booleans.
BOOL_ATTRS = """
    CurrentStatusUnknown CRAB_Publish CRAB_SaveLogsFlag CRAB_TransferOutputs GlobusResubmit
    TransferQueued TransferringInput HasSingularity NiceUser ExitBySignal CMSSWDone HasBeenRouted
    HasBeenOverflowRouted HasBeenTimingTuned MachineAttrCUDAECCEnabled0
""".split()

# Attributes that may be read as inputs but never reach a document.
IGNORED_ATTRS = """
    Arguments CmdHash CRAB_UserDN CRAB_Destination CRAB_DBSURL CRAB_ASOURL CRAB_ASODB
    CRAB_AdditionalOutputFiles CRAB_EDMOutputFiles CRAB_TFileOutputFiles CRAB_oneEventMode
    CRAB_NumAutomJobRetries CRAB_localOutputFiles CRAB_ASOTimeout CRAB_OutTempLFNDir
    CRAB_PublishDBSURL CRAB_PublishGroupName CRAB_RestURInoAPI CRAB_RestHost CRAB_ReqName
    CRAB_RetryOnASOFailures CRAB_StageoutPolicy SubmitEventNotes DAGManNodesMask DAGManNodesLog
    DAGManJobId accounting_group AcctGroup AcctGroupUser AllowOpportunistic AutoClusterAttrs
    BufferBlockSize BufferSize CondorPlatform CondorVersion DiskUsage Err Environment EnvDelim Env
    ExecutableSize HasPrioCorrection GlideinCredentialIdentifier GlideinLogNr GlideinSecurityClass
    GlideinSlotsLayout GlideinWebBase GlideinWorkDir ImageSize In Iwd JobAdInformationAttrs
    job_ad_information_attrs JOB_GLIDECLIENT_Name JOB_GLIDEIN_ClusterId JOB_GLIDEIN_CMSSite
    JOBGLIDEIN_CMSSite JOB_GLIDEIN_Entry_Name JOB_GLIDEIN_Factory JOB_GLIDEIN_Job_Max_Time
    JOB_GLIDEIN_MaxMemMBs JOB_GLIDEIN_Max_Walltime JOB_GLIDEIN_Memory JOB_GLIDEIN_Name
    JOB_GLIDEIN_ProcId JOB_GLIDEIN_Schedd JOB_GLIDEIN_SEs JOB_GLIDEIN_Site JOB_GLIDEIN_SiteWMS
    JOB_GLIDEIN_SiteWMS_JobId JOB_GLIDEIN_SiteWMS_Queue JOB_GLIDEIN_SiteWMS_Slot JOB_GLIDEIN_ToDie
    JOB_GLIDEIN_ToRetire JobLeaseDuration JobNotification JOB_Site Managed
    MATCH_EXP_JOBGLIDEIN_CMSSite MATCH_EXP_JOB_Site MATCH_GLIDECLIENT_Name MATCH_GLIDEIN_ClusterId
    MATCH_GLIDEIN_CMSSite MATCH_GLIDEIN_Entry_Name MATCH_GLIDEIN_Factory MATCH_GLIDEIN_Job_Max_Time
    MATCH_GLIDEIN_MaxMemMBs MATCH_GLIDEIN_Max_Walltime MATCH_GLIDEIN_Name MATCH_GLIDEIN_ProcId
    MATCH_GLIDEIN_Schedd MATCH_GLIDEIN_SEs MATCH_GLIDEIN_Site MATCH_GLIDEIN_SiteWMS
    MATCH_GLIDEIN_SiteWMS_JobId MATCH_GLIDEIN_SiteWMS_Queue MATCH_GLIDEIN_SiteWMS_Slot MATCH_Memory
    MyType NiceUser NumCkpts NumCkpts_RAW OnExitHold OnExitRemove OrigMaxHosts Out PeriodicHold
    PeriodicRelease PeriodicRemove Prev_DESIRED_Sites PublicClaimId RequestDisk RequestMemory
    ResidentSetSize REQUIRES_LOCAL_DATA RecentBlockReadKbytes RecentBlockReads
    RecentBlockWriteKbytes RecentBlockWrites RootDir ServerTime SpooledOutputFiles StreamErr
    StreamOut TargetType TransferIn TransferInput TransferOutput UserLog UserLogUseXML
    use_x509userproxy x509userproxy x509UserProxyExpiration WantCheckpoint WantRemoteIO
    WantRemoteSyscalls BlockReadKbytes BlockReads BlockWriteKbytes BlockWrites LocalSysCpu
    LeaveJobInQueue LocalUserCpu JobMachineAttrs LastRejMatchReason MachineAttrGLIDEIN_CMSSite0
    CMS_ALLOW_OVERFLOW LastPublicClaimId LastRemotePool Used_Gatekeeper DESIRED_OpSyses
""".split()

# Attributes stored but not searchable.
NOT_INDEXED_ATTRS = """
    CRAB_OutLFNDir Args Cmd BytesRecvd CoreSize DelegatedProxyExpiration Environment
    RecentBlockReadKbytes RecentBlockReads RecentBlockWriteKbytes RecentBlockWrites
    RecentStatsLifetimeStarter CurrentHosts MachineAttrCpus0 MachineAttrSlotWeight0 LocalSysCpu
    LocalUserCpu MaxHosts MinHosts StartdIpAddr StartdPrincipal LastRemoteHost
""".split()

# Attributes matched only as whole values.
KEYWORD_ATTRS = """
    CRAB_PublishName CRAB_PublishGroupName CondorPlatform CondorVersion CurrentHosts DESIRED_Archs
    ShouldTransferFiles TotalSuspensions REQUIRED_OS WhenToTransferOutput DAGParentNodeNames
""".split()

# Fields kept for jobs that are still in the queue when documents are skimmed.
ACTIVE_JOB_FIELDS = """
    AccountingGroup AutoClusterId AffiliationInstitute AffiliationCountry BenchmarkJobDB12 Campaign
    CMS_CampaignType CMS_JobType CMS_JobRetryCount CMS_Pool CMSGroups CMSPrimaryDataTier
    CMSSWKLumis CMSSWWallHrs CMSSWVersion CMSSWMajorVersion CMSSWReleaseSeries CommittedCoreHr
    CommittedTime CoreHr Country CpuBadput CpuEff CpuEffOutlier CpuEventRate CpuTimeHr
    CpuTimePerEvent CRAB_AsyncDest CRAB_DataBlock CRAB_Id CRAB_JobCount CRAB_PostJobStatus
    CRAB_Retry CRAB_TaskCreationDate CRAB_UserHN CRAB_Workflow CRAB_SplitAlgo CMS_SubmissionTool
    CMS_WMTool DESIRED_CMSDataset EnteredCurrentStatus EventRate FormattedCrabId GlobalJobId
    GLIDECLIENT_Name GLIDEIN_ClusterId GLIDEIN_Entry_Name GLIDEIN_Factory GLIDEIN_ProcId
    HasSingularity InputData InputGB JobPrio JobCurrentStartDate JobLastStartDate JobUniverse
    KEvents MachineAttrCMSSF_ResourceType0 MachineAttrCMSSubSiteName0
    MachineAttrGLIDEIN_OVERLOAD_ENABLED0 MaxWallTimeMins MegaEvents MemoryMB OutputGB QueueHrs
    QDate ReadTimeMins RecordTime RemoteHost RequestCpus RequestMemory RequestMemory_Eval
    ScheddName Site Status TaskType Tier TimePerEvent Type WallClockHr WMAgent_JobID
    WMAgent_RequestName WMAgent_SubTaskName Workflow DESIRED_Sites DESIRED_SITES_Diff
    DESIRED_SITES_Orig EstimatedWallTimeMins EstimatedWallTimeJobCount PilotRestLifeTimeMins
    LastRouted LastTimingTuned LPCRouted MemoryUsage PeriodicHoldReason RouteType
    HasBeenOverflowRouted HasBeenRouted HasBeenTimingTuned
""".split()

# Scheduler state codes.
JOB_STATUS = {
    0: "Unexpanded",
    1: "Idle",
    2: "Running",
    3: "Removed",
    4: "Completed",
    5: "Held",
    6: "Error",
}

# Scheduler execution environment codes.
JOB_UNIVERSE = {
    1: "Standard",
    2: "Pipe",
    3: "Linda",
    4: "PVM",
    5: "Vanilla",
    6: "PVMD",
    7: "Scheduler",
    8: "MPI",
    9: "Grid",
    10: "Java",
    11: "Parallel",
    12: "Local",
}

# Post-job states of analysis tasks.
POST_JOB_STATUS = {
    "NOT RUN": "postProc",
    "TRANSFERRING": "transferring",
    "COOLOFF": "toRetry",
    "FAILED": "failed",
    "FINISHED": "finished",
}

# Name decorations that are removed from attribute names.
MATCH_PREFIX = "MATCH_EXP_JOB_"
RAW_SUFFIX = "_RAW"

# Searchable strings longer than this are not indexed.
KEYWORD_IGNORE_ABOVE = 256
FIELD_LIMIT = 2000
ALWAYS_UNINDEXED = ["Args", "Cmd", "StartdPrincipal", "StartdIpAddr"]

# --------------------------------------------------------------------------------------
# Typing rules
# --------------------------------------------------------------------------------------

KIND_TO_SPARK: dict[str, T.DataType] = {
    "string": T.StringType(),
    "long": T.LongType(),
    "date": T.LongType(),
    "bool": T.BooleanType(),
}

_KINDS: dict[str, str] = {}
for _kind, _names in (
    # the first kind that lists a name wins
    ("bool", BOOL_ATTRS),
    ("long", LONG_ATTRS),
    ("string", STRING_ATTRS),
    ("date", DATE_ATTRS),
):
    for _name in _names:
        _KINDS.setdefault(_name, _kind)

_IGNORED = frozenset(IGNORED_ATTRS)
_BOOL = frozenset(BOOL_ATTRS)


def kind_of(attribute: str) -> str | None:
    """Return ``string``/``long``/``date``/``bool``, or None when the value passes through."""
    return _KINDS.get(attribute)


def typed_attributes() -> dict[str, str]:
    """All attributes with a declared kind."""
    return dict(_KINDS)


def is_dropped(attribute: str) -> bool:
    """True for attributes that never reach a document."""
    if attribute in _IGNORED:
        return True
    return attribute.startswith("HasBeen") and attribute not in _BOOL


def field_name(attribute: str) -> str:
    """Document field that carries an attribute: decorations off, one alias resolved."""
    if attribute == "DESIRED_SITES":
        return "DESIRED_Sites"
    return attribute.removeprefix(MATCH_PREFIX).removesuffix(RAW_SUFFIX)


# --------------------------------------------------------------------------------------
# Field descriptors
# --------------------------------------------------------------------------------------


def field_descriptors() -> list[tuple[str, str, str, bool, bool]]:
    """(field, kind, index type, indexed, keyword) for every typed field of a document."""
    fields: dict[str, tuple[str, str, bool, bool]] = {}
    for name in LONG_ATTRS:
        fields[field_name(name)] = ("long", "long", True, False)
    for name in STRING_ATTRS:
        field = field_name(name)
        if field in NOT_INDEXED_ATTRS or field in ALWAYS_UNINDEXED:
            fields[field] = ("string", "text", False, False)
        else:
            fields[field] = ("string", "keyword", True, True)
    for name in DATE_ATTRS:
        fields[field_name(name)] = ("date", "date", True, False)
    for name in BOOL_ATTRS:
        fields[field_name(name)] = ("bool", "boolean", True, False)
    return [(field, *fields[field]) for field in sorted(fields)]


def field_catalog(spark: SparkSession) -> DataFrame:
    """The field descriptors as a (fixed-size) dimension table."""
    return spark.createDataFrame(
        field_descriptors(),
        "name string, kind string, index_type string, indexed boolean, keyword boolean",
    )


def index_mapping() -> dict:
    """Index mapping document for a search store; whole-value strings beyond the limit are skipped."""
    properties: dict[str, dict] = {}
    for field, kind, index_type, indexed, _ in field_descriptors():
        if kind == "string" and indexed and field not in KEYWORD_ATTRS:
            continue  # covered by the dynamic string rule
        entry: dict = {"type": index_type}
        if kind == "date":
            entry["format"] = "epoch_second"
        if not indexed:
            entry["index"] = "false"
        properties[field] = entry
    properties["metadata"] = {
        "properties": {"spider_runtime": {"type": "date", "format": "epoch_millis"}}
    }
    whole_value = {"type": "keyword", "norms": "false", "ignore_above": KEYWORD_IGNORE_ABOVE}
    return {
        "dynamic_templates": [
            {"strings_as_keywords": {"match_mapping_type": "string", "mapping": whole_value}}
        ],
        "properties": properties,
    }


def dump_mapping() -> str:
    """The mapping as canonical JSON, to be stored next to the documents it describes."""
    body = {
        "mappings": index_mapping(),
        "settings": {"index": {"mapping.total_fields.limit": FIELD_LIMIT}},
    }
    return json.dumps(body, indent=2, sort_keys=True)


def document_struct(names: Iterable[str] | None = None) -> T.StructType:
    """StructType of the typed fields (all of them, or the given ones)."""
    wanted = None if names is None else set(names)
    fields = [
        T.StructField(name, KIND_TO_SPARK[kind])
        for name, kind, *_ in field_descriptors()
        if wanted is None or name in wanted
    ]
    return T.StructType(fields)
