"""Job records to job documents.

The work is four projections over one scan, without a shuffle. The projections follow the
dependencies: effective inputs, values that several fields share, values made of those, and
the output. Inside the stages record attributes are called ``ad_*`` and helper values start
with an underscore, so neither can collide with a document field.

Fields are stated as recipes. Only the recipes of the wanted fields, and of the helper values
those refer to, become part of the plan.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from poolscope import catalog
from poolscope.functions import casting, chirp, classify, identity, resources, sites, times
from poolscope.functions.decode import MESSAGE_ATTRIBUTE, decode_messages
from poolscope.sources import ads as ad_source

ERRORS = "_error"
ACTIVE_STATES = ("Running", "Idle", "Held")

Recipes = dict[str, Callable[[], Column]]


def drop_root_tasks(ads: DataFrame) -> DataFrame:
    """Records of task roots make no documents."""
    if "TaskType" not in ads.columns:
        return ads
    return ads.filter(~F.col("TaskType").eqNullSafe("ROOT"))


def build_documents(
    ads: DataFrame,
    launch_time: int,
    now: int | None = None,
    *,
    fields: Iterable[str] | None = None,
    cms: bool = True,
    reduce_active: bool = False,
    pool: Column | str | None = None,
    decode: bool = True,
    carry: Iterable[str] = (),
) -> DataFrame:
    """Derive the job documents of a record set.

    ``launch_time`` stands in for missing record times and ``now`` (default: the same) for the
    clock of running jobs, so a run can be repeated. ``fields`` names the wanted fields
    (default: all). ``cms=False`` is for records of other user communities.
    ``reduce_active`` keeps only the active-job fields of jobs in the queue. ``pool`` is the
    name of the pool, or a column over the records that gives it. ``decode`` inflates
    compressed messages among the attributes without a column. ``carry`` names columns that are no
    attributes; they are handed on as they are. Their names start with ``_run_``.

    The field ``_error`` lists what makes a record unusable; see
    :func:`poolscope.operators.quality.split_bad_records`.
    """
    now = launch_time if now is None else now
    pool_name = F.coalesce(pool if isinstance(pool, Column) else F.lit(pool), F.lit("Unknown"))
    carry = list(carry)
    builder = _Builder(ads.drop(*carry), launch_time, now, cms, decode and "extra" in ads.columns)
    recipes = builder.output(reduce_active)
    wanted = list(recipes) if fields is None else list(fields)
    unknown = [name for name in wanted if name not in recipes]
    if unknown:
        raise ValueError(f"no such document fields: {unknown}")

    # from the output back to the inputs, so that each stage knows what is asked of it
    output = _made(recipes, wanted)
    rates = _made(builder.rates(), builder.used)
    shared = _made(builder.shared(), builder.used)
    messages = _made(builder.messages(), builder.used)
    inputs = _made(builder.inputs(), builder.used)

    records = drop_root_tasks(ads)
    if "ad__pool" in builder.used:
        records = records.withColumn("_pool", pool_name)
    if "ad__infinite" in builder.used:
        records = records.withColumn("_infinite", builder.infinite)
    rows = ad_source.stage(records, builder.used, carry)
    for stage in (inputs, messages, shared, rates):
        if stage:
            rows = rows.select("*", *_aliased(stage))
    return rows.select(*_aliased(output), *carry)


def _made(recipes: Recipes, wanted: Iterable[str]) -> dict[str, Column]:
    wanted = list(wanted)
    return {name: recipes[name]() for name in wanted if name in recipes}


def _aliased(columns: dict[str, Column]) -> list[Column]:
    return [value.alias(name) for name, value in columns.items()]


# Names of the application metrics, in the order they are made.
CHIRP_FIELDS = """
CompletedFiles MaxFiles CMSSWDone CMSSWWallHrs KEvents MegaEvents SinceLastCMSSWUpdateHrs
StageOutHrs CMSSWKLumis InputGB ReadTimeHrs ReadTimeMins OutputGB WriteTimeHrs WriteTimeMins
CMSSWEventRate CMSSWTimePerEvent EventRate TimePerEvent ReadOpSegmentPercent ReadOpsPercent
""".split()


class _Builder:
    """Recipes of all document fields; remembers which inputs were asked for."""

    def __init__(self, ads: DataFrame, launch_time: int, now: int, cms: bool, decode: bool):
        self.fields = ad_source.delivered(ads)
        self.types = {f.name: f.dataType for f in self.fields}
        self.has_extra = "extra" in ads.columns
        self.launch_time, self.now, self.cms, self.decode = launch_time, now, cms, decode
        self.used: set[str] = set()
        self.infinite = ad_source.infinite_attributes(ads)
        self.copies = self._bulk_copies()

    def ad(self, name: str) -> Column:
        """An attribute of the record."""
        self.used.add(ad_source.PREFIX + name)
        return ad_source.attribute(name)

    def own(self, name: str) -> Column:
        """A value of an earlier stage."""
        self.used.add(name)
        return F.col(name)

    # ------------------------------------------------------------------------- stages

    def inputs(self) -> Recipes:
        """Effective inputs: record time, site, clocks and processors of a job."""
        ad = self.ad

        def running() -> Column:
            return resources.running_since(ad("JobStatus"), ad("EnteredCurrentStatus"), self.now)

        return {
            "_analysis": lambda: identity.is_analysis(ad("CMS_Type"), ad("CMS_JobType")),
            "_derived_time": lambda: times.record_time(
                ad("JobStatus"), ad("CompletionDate"), ad("JobFinishedHookDone"), self.launch_time
            ),
            "_declared_site": lambda: F.coalesce(
                ad("MATCH_EXP_JOB_GLIDEIN_CMSSite"),
                ad("MATCH_EXP_JOBGLIDEIN_CMSSite"),
                ad("MATCH_GLIDEIN_CMSSite"),
                ad("MachineAttrGLIDEIN_CMSSite0"),
                ad("MachineAttrCMSProcessingSiteName0"),
                F.lit("Unknown"),
            ),
            "_wall": lambda: F.coalesce(running(), ad("RemoteWallClockTime"), F.lit(0)),
            "_committed": lambda: F.coalesce(running(), ad("CommittedTime"), F.lit(0)),
            "_cpus": lambda: resources.requested_cpus(
                resources.stated_cpus(ad("RequestCpus"), self.types.get("RequestCpus", T.LongType())),
                ad("CreamAttributes"),
                ad("NordugridRSL"),
                ad("xcount"),
            ),
            "_state": lambda: casting.decode(ad("JobStatus"), catalog.JOB_STATUS),
            "_kept_stats": lambda: chirp.without_site_io(ad("chirp")),
        }

    def messages(self) -> Recipes:
        def texts() -> Column:
            coded = lambda k, v: k.rlike(MESSAGE_ATTRIBUTE) & v.isNotNull()
            return decode_messages(F.map_values(F.map_filter(self.ad("extra"), coded)))

        return {"_messages": texts}

    def shared(self) -> Recipes:
        """Values that several fields use, so that each is computed once per row."""
        ad, own = self.ad, self.own

        def site() -> Column:
            if self.cms:
                return sites.site_name(own("_declared_site"))
            return sites.site_from_entry(
                ad("GlideinEntryName"), ad("MATCH_EXP_JOBGLIDEIN_ResourceName")
            )

        return {
            "_time": lambda: self._copied_or("RecordTime", own("_derived_time")),
            "_exit": lambda: classify.exit_code(
                own("_analysis"),
                ad("ExitCode"),
                ad("JobExitCode"),
                ad("Chirp_CRAB3_Job_ExitCode"),
                ad("Chirp_WMCore_cmsRun_ExitCode"),
            ),
            "_wall_hr": lambda: resources.hours(own("_wall")),
            "_core_hr": lambda: resources.hours(own("_cpus") * own("_wall")),
            "_committed_core_hr": lambda: resources.hours(own("_cpus") * own("_committed")),
            "_cpu_hr": lambda: resources.hours(
                F.coalesce(ad("RemoteSysCpu"), F.lit(0)) + F.coalesce(ad("RemoteUserCpu"), F.lit(0))
            ),
            "_wanted_sites": lambda: casting.text_to_list(ad("DESIRED_Sites")),
            "_data_sites": lambda: casting.text_to_list(ad("DESIRED_CMSDataLocations")),
            "_site": site,
            "_family": lambda: classify.campaign_type(ad("WMAgent_RequestName"), own("_analysis")),
            "_job_type": lambda: F.coalesce(
                ad("CMS_JobType"),
                F.when(own("_analysis"), F.lit("Analysis")).otherwise(F.lit("Unknown")),
            ),
            "_statistics": lambda: chirp.with_totals(
                own("_kept_stats"), chirp.fold_steps(ad("chirp"))
            ),
            "_site_reads": lambda: chirp.site_io(ad("chirp")),
            "_typed_extra": lambda: typed_extra(
                ad("extra"), own("_messages") if self.decode else None
            ),
        }

    def rates(self) -> Recipes:
        """Efficiency, application metrics and benchmark scores."""
        ad, own = self.ad, self.own

        def passed_through(name: str) -> Column:
            if not self.has_extra:
                return ad(name)
            text = F.try_element_at(ad("extra"), F.lit(name))
            return F.coalesce(ad(name), casting.text_to_double(text))

        metrics = chirp.derived_metrics(
            lambda: own("_statistics"),
            lambda: own("_time"),
            lambda: own("_state"),
            lambda: own("_cpus"),
            lambda: own("_core_hr"),
        )
        return {
            **metrics,
            "_cpu_eff": lambda: resources.cpu_efficiency(
                own("_wall_hr"), own("_cpu_hr"), own("_cpus")
            ),
            "_error_type": lambda: classify.error_type(own("_exit")),
            "_hs06": lambda: F.try_divide(
                ad("MachineAttrMJF_JOB_HS06_JOB0"), ad("MATCH_EXP_JOB_GLIDEIN_Cpus")
            ),
            "_cpu_event_rate": lambda: passed_through("CpuEventRate"),
            "_cpu_time_per_event": lambda: passed_through("CpuTimePerEvent"),
        }

    # ------------------------------------------------------------------- output fields

    def output(self, reduce_active: bool) -> Recipes:
        out: Recipes = dict(self.copies)
        out.update(self._identity_fields())
        out.update(self._time_fields())
        out.update(self._resource_fields())
        out.update(self._locality_fields())
        if self.cms:
            out.update(self._production_fields())
        out.update(self._analysis_fields())
        for name in CHIRP_FIELDS:
            out[name] = lambda name=name: self.own(name)
        out["chirp"] = lambda: self.own("_statistics")
        out["ChirpCMSSW_SiteIO"] = lambda: F.when(
            F.size(self.own("_site_reads")) > 0, self.own("_site_reads")
        )
        out.update(self._benchmark_fields())
        if self.has_extra:
            out["extra"] = lambda: rename_extra(self.own("_typed_extra"))
        if reduce_active:
            out = self._skim(out)
        out["CpuEffOutlier"] = lambda: F.when(self.own("_cpu_eff") >= 100, 1).otherwise(0)
        out[ERRORS] = self._errors
        return out

    def _copied_or(self, name: str, value: Column) -> Column:
        """An attribute of the same name wins over a value derived before the bulk copy."""
        return F.coalesce(self.copies[name](), value) if name in self.copies else value

    def _copied(self, name: str) -> Column:
        return self.copies[name]() if name in self.copies else F.lit(None).cast("string")

    def _bulk_copies(self) -> Recipes:
        """Attributes copied to documents, cast to their kind, under their field name.

        Where several attributes feed a field the matched one comes before the raw one and
        the raw one before the plain one.
        """

        def rank(name: str) -> int:
            if name.startswith(catalog.MATCH_PREFIX):
                return 0
            return 1 if name.endswith(catalog.RAW_SUFFIX) else 2

        candidates: dict[str, list[T.StructField]] = {}
        for field in sorted(self.fields, key=lambda f: rank(f.name)):
            if not catalog.is_dropped(field.name):
                candidates.setdefault(catalog.field_name(field.name), []).append(field)

        def copy(group: list[T.StructField]) -> Column:
            values = [
                casting.cast_attribute(self.ad(f.name), f.dataType, catalog.kind_of(f.name))
                for f in group
            ]
            return values[0] if len(values) == 1 else F.coalesce(*values)

        copies: Recipes = {
            name: (lambda group=group: copy(group)) for name, group in candidates.items()
        }
        if self.cms:
            copies["GLIDEIN_CMSSite"] = lambda: self.own("_declared_site")
        if "RequestMemory" in self.types:
            copies["RequestMemory_Eval"] = lambda: casting.text_to_double(self.ad("RequestMemory"))
        return copies

    def _identity_fields(self) -> Recipes:
        ad, own = self.ad, self.own

        def failed() -> Column:
            return (own("_exit") != 0).cast("int")

        def model(name: str) -> Callable[[], Column]:
            return lambda: F.coalesce(
                ad("ChirpCMSSWCPUModels"), ad("MachineAttrCPUModel0"), self._copied(name)
            )

        out: Recipes = {
            "RecordTime": lambda: own("_time"),
            "ScheddName": lambda: self._copied_or(
                "ScheddName", identity.source_name(ad("GlobalJobId"))
            ),
            "CMS_Pool": lambda: self._copied_or("CMS_Pool", ad("_pool")),
            "JobFailed": failed,
            "ErrorType": lambda: own("_error_type"),
            "ErrorClass": lambda: classify.error_class(own("_error_type"), failed()),
            "ExitCode": lambda: own("_exit"),
            "CondorExitCode": lambda: ad("ExitCode"),
            "Status": lambda: own("_state"),
            "Universe": lambda: casting.decode(ad("JobUniverse"), catalog.JOB_UNIVERSE),
            "CMSPrimaryPrimaryDataset": lambda: identity.dataset_part(ad("DESIRED_CMSDataset"), 1),
            "CMSPrimaryProcessedDataset": lambda: identity.dataset_part(
                ad("DESIRED_CMSDataset"), 2
            ),
            "CMSPrimaryDataTier": lambda: identity.dataset_part(ad("DESIRED_CMSDataset"), -1),
            "x509UserProxyFQAN": lambda: F.split(ad("x509UserProxyFQAN"), ","),
            "VO": lambda: ad("x509UserProxyVOName"),
            "CMSSWVersion": lambda: identity.release_version(ad("CRAB_JobSW")),
            "CMSSWMajorVersion": lambda: identity.release_major(ad("CRAB_JobSW")),
            "CMSSWReleaseSeries": lambda: identity.release_series(ad("CRAB_JobSW")),
            "CPUModel": model("CPUModel"),
            "CPUModelName": model("CPUModelName"),
            "Processor": model("Processor"),
            "HasSingularity": lambda: F.coalesce(ad("MachineAttrHAS_SINGULARITY0"), F.lit(False)),
            "doc_id": lambda: identity.document_id(ad("GlobalJobId"), own("_time")),
        }
        if self.cms:
            out["Type"] = lambda: self._copied_or(
                "Type", F.lower(F.coalesce(ad("CMS_Type"), F.lit("unknown")))
            )
            out["CMSGroups"] = lambda: casting.text_to_list(ad("CMSGroups"))
        return out

    def _time_fields(self) -> Recipes:
        ad, own = self.ad, self.own
        return {
            "DataCollection": lambda: self._copied_or(
                "DataCollection",
                F.coalesce(F.nullif(ad("CompletionDate"), F.lit(0)), F.lit(self.launch_time)),
            ),
            "DataCollectionDate": lambda: self._copied_or(
                "DataCollectionDate", own("_derived_time")
            ),
            "CRAB_TaskCreationDate": lambda: F.coalesce(
                times.task_creation_time(ad("CRAB_Workflow")), own("_derived_time")
            ),
            "QueueHrs": lambda: (F.coalesce(ad("JobCurrentStartDate"), F.lit(self.now)) - ad("QDate"))
            / F.lit(3600.0),
            "PilotRestLifeTimeMins": lambda: resources.pilot_minutes_left(
                own("_analysis"),
                ad("JobStatus"),
                ad("LastMatchTime"),
                ad("MATCH_GLIDEIN_ToDie"),
                ad("EnteredCurrentStatus"),
            ),
            "HasBeenTimingTuned": lambda: F.coalesce(ad("HasBeenTimingTuned"), F.lit(False)),
        }

    def _resource_fields(self) -> Recipes:
        ad, own = self.ad, self.own
        return {
            "WallClockHr": lambda: own("_wall_hr"),
            "RequestCpus": lambda: own("_cpus"),
            "CoreHr": lambda: own("_core_hr"),
            "CommittedCoreHr": lambda: own("_committed_core_hr"),
            "CommittedWallClockHr": lambda: resources.hours(own("_committed")),
            "CpuTimeHr": lambda: own("_cpu_hr"),
            "DiskUsageGB": lambda: F.coalesce(ad("DiskUsage_RAW"), F.lit(0)) / F.lit(1000000.0),
            "MemoryMB": lambda: F.coalesce(ad("ResidentSetSize_RAW"), F.lit(0)) / F.lit(1024.0),
            "CpuEff": lambda: own("_cpu_eff"),
            "Badput": lambda: resources.lost_hours(own("_core_hr"), own("_committed_core_hr")),
            "CpuBadput": lambda: resources.lost_hours(own("_core_hr"), own("_cpu_hr")),
        }

    def _locality_fields(self) -> Recipes:
        ad, own = self.ad, self.own
        out: Recipes = {
            "Site": lambda: own("_site"),
            "DataLocations": lambda: own("_data_sites"),
            "DESIRED_Sites": lambda: own("_wanted_sites"),
            "Original_DESIRED_Sites": lambda: casting.text_to_list(ad("ExtDESIRED_Sites")),
            "DesiredSiteCount": lambda: F.size(own("_wanted_sites")),
            "DataLocationsCount": lambda: F.size(own("_data_sites")),
        }
        if self.cms:
            where = lambda: (own("_site"), ad("DESIRED_CMSDataLocations"), ad("JobStatus"))
            out["Tier"] = lambda: sites.site_part(own("_site"), 0)
            out["Country"] = lambda: sites.site_part(own("_site"), 1)
            out["InputData"] = lambda: sites.input_locality(*where())
            out["OverflowType"] = lambda: F.coalesce(
                sites.overflow_type(*where(), own("_analysis"), own("_wanted_sites")),
                self._copied("OverflowType"),
            )
            return out

        def part(name: str, position: int) -> Callable[[], Column]:
            return lambda: F.when(
                sites.named_by_entry(
                    ad("GlideinEntryName"), ad("MATCH_EXP_JOBGLIDEIN_ResourceName")
                ),
                sites.site_part(own("_site"), position),
            ).otherwise(self._copied(name))

        out["Tier"], out["Country"] = part("Tier", 0), part("Country", 1)
        return out

    def _production_fields(self) -> Recipes:
        ad, own = self.ad, self.own

        def list_size(name: str) -> Column:
            return F.coalesce(F.array_size(ad(name)), F.lit(0))

        return {
            "task": lambda: ad("WMAgent_SubTaskName"),
            "CMS_JobType": lambda: own("_job_type"),
            "CRAB_AsyncDest": lambda: F.coalesce(ad("CRAB_AsyncDest"), F.lit("Unknown")),
            "WMAgent_TaskType": lambda: identity.last_path_part(
                F.coalesce(ad("WMAgent_SubTaskName"), F.lit("/UNKNOWN"))
            ),
            "CMS_CampaignType": lambda: own("_family"),
            "Campaign": lambda: classify.campaign(
                ad("CMS_CampaignName"),
                own("_analysis"),
                ad("CRAB_UserHN"),
                ad("WMAgent_RequestName"),
                ad("WMAgent_SubTaskName"),
                own("_family"),
            ),
            "TaskType": lambda: classify.task_type(
                ad("CMS_extendedJobType"),
                ad("CMS_TaskType"),
                own("_analysis"),
                own("_job_type"),
                classify.guessed_task_type(
                    ad("CMS_JobType"), ad("WMAgent_SubTaskName"), ad("WMAgent_RequestName")
                ),
            ),
            "Workflow": lambda: classify.workflow(
                ad("WMAgent_RequestName"), ad("CRAB_Workflow"), own("_analysis")
            ),
            "OutputFiles": lambda: F.when(
                own("_analysis"),
                list_size("CRAB_AdditionalOutputFiles")
                + list_size("CRAB_TFileOutputFiles")
                + list_size("CRAB_EDMOutputFiles")
                + F.coalesce(ad("CRAB_SaveLogsFlag").cast("int"), F.lit(0)),
            ),
        }

    def _analysis_fields(self) -> Recipes:
        ad, own = self.ad, self.own

        def final() -> Column:
            return classify.has_final_state(ad("CRAB_PostJobStatus"), own("_state"))

        def post_state() -> Column:
            normal = classify.normal_post_state(ad("CRAB_PostJobStatus"))
            decoded = F.coalesce(casting.decode(normal, catalog.POST_JOB_STATUS, None), normal)
            return classify.post_job_status(
                ad("CRAB_PostJobStatus"), own("_state"), ad("CRAB_Id"), decoded
            )

        return {
            "FormattedCrabId": lambda: self._copied_or(
                "FormattedCrabId", identity.sortable_task_index(ad("CRAB_Id"))
            ),
            "CRAB_PostJobStatus": post_state,
            "CompletionDate": lambda: F.when(
                final() & ad("CompletionDate").isNull(),
                F.nullif(ad("EnteredCurrentStatus"), F.lit(0)),
            ).otherwise(F.nullif(ad("CompletionDate"), F.lit(0))),
            "CommittedTime": lambda: F.when(
                final() & (F.coalesce(ad("CommittedTime"), F.lit(0)) == 0),
                ad("RemoteWallClockTime"),
            ).otherwise(ad("CommittedTime")),
            "CMS_WMTool": lambda: classify.submission_tool(
                ad("CMS_WMTool"), ad("CMS_SubmissionTool")
            ),
        }

    def _benchmark_fields(self) -> Recipes:
        ad, own = self.ad, self.own
        rates = {
            "EventRate": lambda: own("EventRate"),
            "CpuEventRate": lambda: own("_cpu_event_rate"),
            "CpuTimePerEvent": lambda: own("_cpu_time_per_event"),
            "TimePerEvent": lambda: own("TimePerEvent"),
            "CoreHr": lambda: own("_core_hr"),
            "CommittedCoreHr": lambda: own("_committed_core_hr"),
            "CpuTimeHr": lambda: own("_cpu_hr"),
        }

        def hs06_usable() -> Column:
            # a zero score ends the weighting as soon as a rate would be divided by it
            return own("_hs06").isNotNull() & ~((own("_hs06") == 0) & self._any_rate())

        def weighted(name: str, score, usable) -> Callable[[], Column]:
            return lambda: F.when(
                usable(), resources.weighted_by_score(name, rates[name](), score())
            )

        out: Recipes = {
            "BenchmarkJobHS06": lambda: own("_hs06"),
            "BenchmarkJobDB12": lambda: ad("MachineAttrDIRACBenchmark0"),
        }
        db12 = lambda: ad("MachineAttrDIRACBenchmark0")
        for name in rates:
            out["HS06" + name] = weighted(name, lambda: own("_hs06"), hs06_usable)
            out["DB12" + name] = weighted(name, db12, lambda: db12().isNotNull())
        return out

    def _any_rate(self) -> Column:
        return F.coalesce(self.own("EventRate") > 0, F.lit(False)) | F.coalesce(
            self.own("_cpu_event_rate") > 0, F.lit(False)
        )

    # -------------------------------------------------------------------- skim and errors

    def _skim(self, out: Recipes) -> Recipes:
        """Keep only the active-job fields of jobs in the queue."""
        kept = frozenset(catalog.ACTIVE_JOB_FIELDS) | {"doc_id"}

        def active() -> Column:
            return self.own("_state").isin(*ACTIVE_STATES)

        def fewer(value: Column) -> Column:
            return F.map_filter(value, lambda k, _: k.isin(catalog.ACTIVE_JOB_FIELDS))

        skimmed: Recipes = {}
        for name, make in out.items():
            if name == "extra":
                skimmed[name] = lambda make=make: F.when(active(), fewer(make())).otherwise(make())
            elif name in kept:
                skimmed[name] = make
            else:
                skimmed[name] = lambda make=make: F.when(~active(), make())
        return skimmed

    def _errors(self) -> Column:
        """What makes a record unusable; an empty list for good records."""
        ad, own = self.ad, self.own
        checks = {
            "GlobalJobId is missing": ad("GlobalJobId").isNull(),
            "JobStatus is missing": ad("JobStatus").isNull(),
            "QDate is missing": ad("QDate").isNull(),
            "CRAB_Id is malformed": identity.bad_task_index(ad("CRAB_Id")),
            "CRAB_JobSW is malformed": identity.bad_release(ad("CRAB_JobSW")),
            "MachineAttrDIRACBenchmark0 is zero": (ad("MachineAttrDIRACBenchmark0") == 0)
            & self._any_rate(),
            "statistic name is malformed": chirp.malformed_site_key(ad("chirp")),
        }
        timed = F.coalesce(
            (chirp.statistic(own("_statistics"), "Done") != 0)
            & (chirp.statistic(own("_statistics"), "Elapsed") > 0),
            F.lit(False),
        )
        checks["RequestCpus is zero"] = (own("_cpus") == 0) & ((own("_wall") != 0) | timed)
        found = F.array_compact(
            F.array(*[F.when(bad, F.lit(text)) for text, bad in checks.items()])
        )
        return found if self.infinite is None else F.concat(found, ad("_infinite"))


def typed_extra(extra: Column, messages: Column | None = None) -> Column:
    """Attributes without a column of their own, as far as they belong in documents.

    Ignored attributes leave and declared kinds are applied; values that do not convert leave.
    Text ``false``, ``0`` and the empty text are false. ``messages`` holds the decoded texts of
    the compressed messages in map order.
    """
    booleans = catalog.BOOL_ATTRS
    kept = F.map_filter(
        extra,
        lambda k, _: ~k.isin(catalog.IGNORED_ATTRS)
        & (~k.startswith("HasBeen") | k.isin(booleans)),
    )
    typed = F.transform_values(
        kept,
        lambda k, v: F.when(
            k.isin(booleans), (~F.lower(v).isin("false", "0", "")).cast("string")
        )
        .when(k.isin(catalog.LONG_ATTRS), casting.text_to_long(v).cast("string"))
        .when(
            k.isin(catalog.DATE_ATTRS),
            F.nullif(casting.text_to_long(v), F.lit(0)).cast("string"),
        )
        .otherwise(v),
    )
    present = F.map_filter(typed, lambda _, v: v.isNotNull())
    if messages is None:
        return present
    coded = F.map_filter(extra, lambda k, v: k.rlike(MESSAGE_ATTRIBUTE) & v.isNotNull())
    decoded = F.map_from_arrays(F.map_keys(coded), messages)
    replaced = F.map_zip_with(present, decoded, lambda _, old, new: F.coalesce(new, old))
    return F.when(F.size(messages) > 0, replaced).otherwise(present)


def rename_extra(typed: Column) -> Column:
    """Put attributes under their field name.

    A matched attribute beats a raw one, a raw one a plain one. ``typed`` must be a plain
    column, so that it is computed once per row.
    """
    prefix, suffix = catalog.MATCH_PREFIX, catalog.RAW_SUFFIX
    matched = lambda k: k.startswith(prefix)
    raw = lambda k: k.endswith(suffix)
    alias = lambda k: k == "DESIRED_SITES"
    off_front = lambda k: F.substring(k, F.lit(len(prefix) + 1), F.length(k))
    off_back = lambda k: F.left(k, F.length(k) - F.lit(len(suffix)))

    def group(belongs: Callable, rename: Callable) -> Column:
        chosen = F.map_filter(typed, lambda k, _: belongs(k))
        return F.transform_keys(chosen, lambda k, _: rename(k))

    by_rank = [
        group(lambda k: matched(k) & ~raw(k), off_front),
        group(lambda k: matched(k) & raw(k), lambda k: off_back(off_front(k))),
        group(lambda k: ~matched(k) & raw(k), off_back),
        F.map_filter(typed, lambda k, _: ~matched(k) & ~raw(k) & ~alias(k)),
        group(alias, lambda _: F.lit("DESIRED_Sites")),
    ]
    merged = by_rank[0]
    for lower in by_rank[1:]:
        merged = F.map_zip_with(merged, lower, lambda _, a, b: F.coalesce(a, b))
    return merged
