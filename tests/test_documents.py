"""Documents out of hand-made records."""

import pytest
from pyspark.sql import Row

from poolscope.operators.documents import build_documents
from poolscope.operators.quality import split_bad_records
from poolscope.operators.sinks import document_json

NOW = 1706659200
BASE = dict(GlobalJobId="s#1#2", JobStatus=4, JobUniverse=5, CMS_Type="production", QDate=NOW - 3600)
SCHEMA = {
    "GlobalJobId": "string",
    "JobStatus": "bigint",
    "JobUniverse": "bigint",
    "CMS_Type": "string",
    "QDate": "bigint",
    "EnteredCurrentStatus": "bigint",
    "RemoteWallClockTime": "bigint",
    "CommittedTime": "bigint",
    "CompletionDate": "bigint",
    "CRAB_Id": "string",
    "CRAB_PostJobStatus": "string",
    "TaskType": "string",
    "RequestCpus": "string",
    "chirp": "map<string,double>",
    "extra": "map<string,string>",
    "MachineAttrMJF_JOB_HS06_JOB0": "double",
    "MATCH_EXP_JOB_GLIDEIN_Cpus": "double",
    "CpuEventRate": "double",
    "MachineAttrDIRACBenchmark0": "double",
    "RecordTime": "bigint",
    "ImageSize_RAW": "string",
    "GLIDEIN_Cpus": "double",
    "ExitCode": "double",
    "JobPrio": "double",
    "JobRunCount": "string",
}


def document(spark, record, fields, **options):
    record = {**BASE, **record}
    schema = ", ".join(f"{name} {SCHEMA[name]}" for name in record)
    ads = spark.createDataFrame([tuple(record.values())], schema)
    return build_documents(ads, NOW, fields=fields.split(), **options).first()


def test_running_clock_keeps_the_raw_value(spark):
    got = document(
        spark,
        dict(JobStatus=2, EnteredCurrentStatus=NOW - 7200, RemoteWallClockTime=5, CommittedTime=6),
        "WallClockHr CommittedWallClockHr RemoteWallClockTime CommittedTime",
    )
    assert (got.WallClockHr, got.CommittedWallClockHr, got.RemoteWallClockTime, got.CommittedTime) == (2.0, 2.0, 5, 6)


def test_root_tasks_make_no_document(spark):
    assert document(spark, dict(TaskType="ROOT"), "Status") is None


def test_step_fold(spark):
    stats = {
        "ChirpCMSSW_cmsRun1_Events": 5.0,
        "ChirpCMSSW_cmsRun2_Events": 9.0,
        "ChirpCMSSW_cmsRun1_Elapsed": 2.0,
        "ChirpCMSSW_cmsRun2_Elapsed": 3.0,
        "ChirpCMSSW_Lumis": 4.0,
        "ChirpCMSSWLumis": 1.0,
        "ChirpCMSSWFiles": 7.0,
    }
    got = document(spark, dict(chirp=stats), "chirp").chirp
    assert got["ChirpCMSSWEvents"] == 9.0
    assert got["ChirpCMSSWElapsed"] == 5.0
    assert got["ChirpCMSSWLumis"] == 5.0
    assert got["ChirpCMSSWFiles"] == 7.0
    assert got["ChirpCMSSW_cmsRun1_Events"] == 5.0


def test_fold_of_many_statistics_matches_a_plain_loop(spark):
    import random

    rng = random.Random(7)
    stats = {f"ChirpCMSSW_step{s}_{n}": float(rng.randint(0, 99)) for s in range(6) for n in ("A", "B_c", "Events", "XMaxFiles")}
    stats["ChirpCMSSWB_c"] = 3.0
    expected = {}
    for key, value in stats.items():
        if key.startswith("ChirpCMSSW_"):
            name = key.split("_", 2)[2]
            expected.setdefault(name, [stats.get("ChirpCMSSW" + name)] if "ChirpCMSSW" + name in stats else []).append(value)
    got = document(spark, dict(chirp=stats), "chirp").chirp
    for name, parts in expected.items():
        assert got["ChirpCMSSW" + name] == (max(parts) if name.endswith(("Events", "MaxFiles")) else sum(parts))


def test_site_reads(spark):
    stats = {
        "ChirpCMSSWAIOSite_T2_X_ReadBytes": 1.0,
        "ChirpCMSSWAIOSite_T2_X_ReadTimeMS": 2.0,
        "ChirpCMSSW_B_IOSite_T2_Y_ReadBytes": 3.0,
        "ChirpCMSSWIOSite_T2_Z_ReadTimeMS": 4.0,
    }
    got = document(spark, dict(chirp=stats), "chirp ChirpCMSSW_SiteIO")
    assert got.ChirpCMSSW_SiteIO == [Row(SiteName="T2_X", ChirpString="A", ReadBytes=1.0, ReadTimeMS=2.0)]
    assert got.chirp == {"ChirpCMSSWIOSite_T2_Z_ReadTimeMS": 4.0}


def test_zero_benchmark_score_stops_the_weighting(spark):
    record = dict(MachineAttrMJF_JOB_HS06_JOB0=0.0, MATCH_EXP_JOB_GLIDEIN_Cpus=2.0, CpuEventRate=1.0)
    got = document(spark, record, "BenchmarkJobHS06 HS06CoreHr")
    assert got.BenchmarkJobHS06 == 0.0 and got.HS06CoreHr is None
    got = document(spark, {**record, "CpuEventRate": 0.0}, "HS06CoreHr")
    assert got.HS06CoreHr == 0.0


@pytest.mark.parametrize(
    "record, reason",
    [
        (dict(JobStatus=None), "JobStatus is missing"),
        (dict(QDate=None), "QDate is missing"),
        (dict(GlobalJobId=None), "GlobalJobId is missing"),
        (dict(CRAB_Id="1-x"), "CRAB_Id is malformed"),
        (dict(RequestCpus="0", RemoteWallClockTime=5), "RequestCpus is zero"),
        (dict(MachineAttrDIRACBenchmark0=0.0, CpuEventRate=1.0), "MachineAttrDIRACBenchmark0 is zero"),
        (dict(chirp={"ChirpCMSSWIOSite_bad": 1.0}), "statistic name is malformed"),
        (dict(ExitCode=float("inf")), "ExitCode is infinite"),
        (dict(JobPrio=float("inf")), "JobPrio is infinite"),
    ],
)
def test_bad_records(spark, record, reason):
    assert reason in document(spark, record, "_error")["_error"]


def test_bad_records_do_not_stop_the_others(spark):
    rows = [("a#1", 4, NOW, None), ("b#1", 4, NOW, "1-x"), ("c#1", None, NOW, None)]
    ads = spark.createDataFrame(rows, "GlobalJobId string, JobStatus bigint, QDate bigint, CRAB_Id string")
    good, bad = split_bad_records(build_documents(ads, NOW, fields=["GlobalJobId", "_error"]))
    assert [r.GlobalJobId for r in good.collect()] == ["a#1"]
    assert {r.GlobalJobId for r in bad.collect()} == {"b#1", "c#1"}


def test_text_cpus_count_as_one(spark):
    assert document(spark, dict(RequestCpus="many"), "RequestCpus").RequestCpus == 1
    assert document(spark, dict(RequestCpus="8"), "RequestCpus").RequestCpus == 8


def test_text_attributes_are_converted(spark):
    got = document(spark, dict(JobRunCount="12", ExitCode=3.7), "JobRunCount ExitCode _error")
    assert (got.JobRunCount, got.ExitCode, got["_error"]) == (12, 3, [])
    assert document(spark, dict(JobRunCount="1.5"), "JobRunCount").JobRunCount is None


def test_attributes_win_over_early_fields(spark):
    got = document(spark, dict(RecordTime=123), "RecordTime doc_id")
    assert got.RecordTime == 123 and got.doc_id == "s#1#2#123"


def test_matched_beats_plain(spark):
    got = document(spark, {"MATCH_EXP_JOB_GLIDEIN_Cpus": 4.0, "GLIDEIN_Cpus": 2.0}, "GLIDEIN_Cpus")
    assert got.GLIDEIN_Cpus == 4.0
    assert document(spark, {"GLIDEIN_Cpus": 2.0}, "GLIDEIN_Cpus").GLIDEIN_Cpus == 2.0


def test_skim_keeps_only_active_fields(spark):
    record = dict(JobStatus=2, EnteredCurrentStatus=NOW, extra={"JobPrio": "1", "Other": "x"})
    got = document(spark, record, "Status ErrorType ExitCode extra", reduce_active=True)
    assert got.Status == "Running" and got.ErrorType is None and got.ExitCode is None
    assert got.extra == {"JobPrio": "1"}
    got = document(spark, {**record, "JobStatus": 4}, "ErrorType extra", reduce_active=True)
    assert got.ErrorType == "OutOfBounds" and "Other" in got.extra


def test_compressed_messages_among_other_attributes(spark):
    import base64
    import zlib

    name = "Chirp_WMCore_cmsRun1_Exception_Message"
    coded = base64.b64encode(zlib.compress(b"broken")).decode()
    got = document(spark, dict(extra={name: coded, "X": "y"}), "extra")
    assert got.extra == {name: "broken", "X": "y"}
    got = document(spark, dict(extra={name: coded}), "extra", decode=False)
    assert got.extra == {name: coded}


def test_flat_json(spark):
    import json

    ads = spark.createDataFrame(
        [("s#1", 4, NOW, {"ChirpCMSSW_a_Events": 2.0}, {"Brace": "{x}"})],
        "GlobalJobId string, JobStatus bigint, QDate bigint, chirp map<string,double>, extra map<string,string>",
    )
    docs = build_documents(ads, NOW)
    text = docs.select(document_json(docs)).first()[0]
    got = json.loads(text)
    assert got["ChirpCMSSWEvents"] == 2.0 and got["Brace"] == "{x}" and got["Status"] == "Completed"
    assert "CompletionDate" not in got and "doc_id" not in got


def test_json_values_have_their_kind(spark):
    import json

    from poolscope.operators.sinks import broker_messages, stamp

    extra = {
        "BytesSent": "12", "TransferQueued": "true", "SomeFloat": "1.5", "JobStartDate": "150", "Odd": "007",
        "DAG_Stats": '{"a": 1}', "DESIRED_Sites": "T2_X", "Owner": "extra", "Globus": "12x", "Nothing": None,
    }
    ads = spark.createDataFrame(
        [("s#1", 4, NOW, "o", "T1_A", {"ChirpCMSSWLastUpdate": 7.0}, extra)],
        "GlobalJobId string, JobStatus bigint, QDate bigint, Owner string, DESIRED_Sites string,"
        " chirp map<string,double>, extra map<string,string>",
    )
    docs = build_documents(ads, NOW)
    pairs = json.loads(docs.select(document_json(docs)).first()[0], object_pairs_hook=list)
    names = [name for name, _ in pairs]
    assert len(names) == len(set(names))
    got = dict(pairs)
    assert (got["BytesSent"], got["TransferQueued"], got["SomeFloat"], got["JobStartDate"]) == (12, True, 1.5, 150)
    assert got["Odd"] == "007" and got["Globus"] == "12x" and got["DAG_Stats"] == [("a", 1)]
    assert got["Owner"] == "o" and "Nothing" not in got
    sent = broker_messages(stamp(docs, {"m": 1})).first().value
    payload = json.loads(json.loads(sent)["payload"])
    assert payload["JobStartDate"] == 150000 and payload["QDate"] == NOW * 1000


def test_json_of_maps_alone(spark):
    import json

    docs = spark.createDataFrame([(None, {"a": "1"}), (None, None)], "x string, extra map<string,string>")
    assert [json.loads(r[0]) for r in docs.select(document_json(docs)).collect()] == [{"a": 1}, {}]


def test_unknown_field_is_an_error(spark):
    ads = spark.createDataFrame([("s#1",)], "GlobalJobId string")
    with pytest.raises(ValueError):
        build_documents(ads, NOW, fields=["NoSuchField"])


def test_only_asked_columns_reach_the_scan(spark, sf, capsys):
    from poolscope.sources.samples import table

    ads = table(spark, sf, "events").withColumnsRenamed({"event_type": "GlobalJobId", "event_id": "JobStatus"})
    build_documents(ads, NOW, fields=["Status"]).explain()
    plan = capsys.readouterr().out
    assert "ReadSchema: struct<event_id:bigint>" in plan


def test_all_fields_have_one_name(spark):
    ads = spark.createDataFrame([("s#1",)], "GlobalJobId string")
    names = [c.lower() for c in build_documents(ads, NOW).columns]
    assert len(names) == len(set(names))
