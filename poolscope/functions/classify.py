"""Classification of exits, campaigns, workflows and task types."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from poolscope.functions.identity import last_path_part

# Fixed value: exit code of jobs that were removed before their program ended.
NO_EXIT = 50666


def exit_code(
    analysis: Column, scheduler_exit: Column, job_exit: Column, task_exit: Column, step_exit: Column
) -> Column:
    """One exit code per job out of the scheduler's, the wrapper's and the program's."""
    return (
        F.when(scheduler_exit.isNull(), F.lit(NO_EXIT).cast("bigint"))
        .when(analysis, F.coalesce(job_exit, task_exit, scheduler_exit))
        .when(step_exit > 0, step_exit)
        .otherwise(scheduler_exit)
    )


def error_type(code: Column) -> Column:
    """Readable error type of an exit code. The order of the tests matters."""
    return (
        F.when(code == 0, "Success")
        .when(code.between(10000, 19999) | (code == 50513), "Environment")
        .when(code.between(69000, 69999), "Publication")
        .when(code.between(60000, 68999), "StageOut")
        .when(code.between(80000, 89999), "JobWrapper")
        .when(code.isin(8020, 8028), "FileOpen")
        .when(code == 8021, "FileRead")
        .when(code.isin(8030, 8031, 8032, 9000) | code.between(50660, 50669), "OutOfBounds")
        .when(code.between(7000, 9000) | (code == 139), "Executable")
        .otherwise("Other")
    )


def error_class(kind: Column, failed: Column) -> Column:
    """Broad failure class of an error type."""
    return (
        F.when(kind.isin("Environment", "Publication", "StageOut", "AsyncStageOut"), "System")
        .when(kind.isin("FileOpen", "FileRead"), "DataAccess")
        .when(kind.isin("JobWrapper", "OutOfBounds", "Executable"), "Application")
        .when(failed != 0, "Other")
        .otherwise("Success")
    )


def guessed_task_type(job_type: Column, subtask: Column, request: Column) -> Column:
    """Task type of a production job from the last part of its subtask name."""
    step = last_path_part(F.coalesce(subtask, F.lit("/UNKNOWN")))
    pieces = F.split(step, "-")
    campaign = F.coalesce(F.get(pieces, F.lit(1)), step)
    one_step = step == "StepOneProc"
    production = (
        F.when(step.contains("CleanupUnmerged"), "Cleanup")
        .when(step.contains("Merge"), "Merge")
        .when(step.contains("LogCollect"), "LogCollect")
        .when(one_step & F.coalesce(request, F.lit("UNKNOWN")).contains("MiniAOD"), "MINIAOD")
        .when(step.contains("MiniAOD"), "MINIAOD")
        .when(one_step & campaign.rlike("[1-9][0-9]DR"), "DIGIRECO")
        .when(campaign.rlike("[1-9][0-9]GS") & step.endswith("_0"), "GENSIM")
        .when(step.endswith("_0"), "DIGI")
        .when(step.endswith("_1") | (F.lower(step) == "reco"), "RECO")
        .when(step == "MonteCarloFromGEN", "GENSIM")
        .otherwise("UNKNOWN")
    )
    return (
        F.when(job_type == "Processing", "DataProcessing")
        .when(job_type == "Production", production)
        .otherwise(F.coalesce(job_type, F.lit("UNKNOWN")))
    )


def task_type(
    extended: Column, declared: Column, analysis: Column, effective_job_type: Column, guess: Column
) -> Column:
    """Declared task type if there is one, else the job type of analyses or a guess."""
    return F.coalesce(
        F.nullif(extended, F.lit("UNKNOWN")),
        declared,
        F.when(analysis, effective_job_type).otherwise(guess),
    )


# Patterns of request names. All are anchored at the start only.
_CAMPAIGN = r"^[A-Za-z0-9_]+_[A-Z0-9]+-([A-Za-z0-9]+)-"
_REPROCESSING = r"^[A-Za-z0-9_]+_Run20[A-Za-z0-9_-]+-([A-Za-z0-9]+)"
_PREP_ID = r"^[A-Za-z0-9_]+_([A-Z]+-([A-Za-z0-9]+)-[0-9]+)"
_PROMPT = r"^(PromptReco|Repack|Express)_[A-Za-z0-9]+_([A-Za-z0-9]+)"
_RELEASE_VALIDATION = r"^[A-Za-z0-9]+_(RVCMSSW_[0-9]+_[0-9]+_[0-9]+)"
_ULTRA_MC = r"RunIISummer([12])[0-9]UL|_UL[0-9]+"
_ULTRA_DATA = r"UltraLegacy"
_PHASE2 = r"Phase2"
_RUN3 = r"Run3|RunIII"
_RUN2 = r"RunII|(Summer|Fall|Autumn|Winter|Spring)(1[5-9]|20)"


def _group(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def campaign_type(request: Column, analysis: Column) -> Column:
    """Campaign family of a request name. The ultra-legacy tests must come before Run 2."""
    name = F.coalesce(request, F.lit("UNKNOWN"))
    return (
        F.when(analysis, "Analysis")
        .when(name.rlike(_ULTRA_MC), "MC Ultralegacy")
        .when(name.rlike(_ULTRA_DATA), "Data Ultralegacy")
        .when(name.rlike(_PHASE2), "Phase2 requests")
        .when(name.rlike(_RUN3), "Run3 requests")
        .when(name.contains("RVCMSSW"), "RelVal")
        .when(name.rlike(_RUN2), "Run2 requests")
        .when(name.contains("SnowmassWinter21"), "SnowmassWinter21")
        .otherwise("UNKNOWN")
    )


def campaign(
    declared: Column, analysis: Column, user: Column, request: Column, subtask: Column, family: Column
) -> Column:
    """Campaign: declared, per user for analyses, else from the request name, else its family."""
    name = F.coalesce(request, F.lit("UNKNOWN"))
    reprocessing = F.when(
        subtask.contains("DataProcessing"),
        F.concat(_group(name, _REPROCESSING, 1), F.lit("Reprocessing")),
    )
    by_name = (
        F.when(name.startswith("PromptReco"), "PromptReco")
        .when(name.startswith("Repack"), "Repack")
        .when(name.startswith("Express"), "Express")
        .when(name.contains("RVCMSSW"), "RelVal")
        .otherwise(F.coalesce(_group(name, _CAMPAIGN, 1), reprocessing, family))
    )
    by_user = F.concat(F.lit("crab_"), F.coalesce(user, F.lit("UNKNOWN")))
    return F.coalesce(
        F.nullif(declared, F.lit("")), F.when(analysis, by_user).otherwise(by_name)
    )


def workflow(request: Column, task_name: Column, analysis: Column) -> Column:
    """Short workflow name: the task name after its time stamp, or the id inside a request name."""
    name = F.coalesce(request, F.lit("UNKNOWN"))
    task = F.coalesce(task_name, F.lit("UNKNOWN"))
    # instr is 0 without a colon, so the whole name is kept then
    after_colon = F.substring(task, F.instr(task, ":") + F.lit(1), F.length(task))
    prompt = F.when(
        name.rlike(_PROMPT),
        F.concat(F.regexp_extract(name, _PROMPT, 1), F.lit("_"), F.regexp_extract(name, _PROMPT, 2)),
    )
    by_name = F.coalesce(_group(name, _PREP_ID, 1), prompt, _group(name, _RELEASE_VALIDATION, 1), name)
    return F.when(analysis, after_colon).otherwise(by_name)


def post_job_status(
    raw: Column, status: Column, task_index: Column, decoded: Column
) -> Column:
    """State of an analysis job after post-processing: decoded when final, else the queue state."""
    return (
        F.when(has_final_state(raw, status), decoded)
        .when(task_index.isNotNull(), status)
        .otherwise(raw)
    )


def normal_post_state(raw: Column) -> Column:
    """Post-job state without blanks, in upper case; NULL when there is nothing in it."""
    return F.nullif(F.upper(F.btrim(raw, F.lit(" \t\n\r\f\v"))), F.lit(""))


def has_final_state(raw: Column, status: Column) -> Column:
    """The post-job state counts: the job is completed, or removed after it was run."""
    state = normal_post_state(raw)
    return F.coalesce(
        state.isNotNull()
        & (((status == "Removed") & (state != "NOT RUN")) | (status == "Completed")),
        F.lit(False),
    )


def submission_tool(declared: Column, channel: Column) -> Column:
    """Workload tool with one spelling of "User"."""
    tool = F.coalesce(
        declared,
        F.when(channel == "InstitutionalSchedd", F.lit("User")).otherwise(F.lit("UNKNOWN")),
    )
    return F.when(F.lower(tool) == "user", F.lit("User")).otherwise(tool)
