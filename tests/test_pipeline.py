"""Sources, sinks, runs and streams, end to end on small inputs."""

import json

import pytest
from pyspark.sql import functions as F

from poolscope import catalog
from poolscope.operators import incremental, logparse, notify, quality, reconcile, select, sinks
from poolscope.operators.enrich import add_affiliation, left_lookup
from poolscope.plans.runs import Dimensions, RunConfig, convert_offline, run
from poolscope.sources import ads as ad_source
from poolscope.sources import affiliations, checkpoints, registry
from poolscope.sources.loglines import read_logs, tail_logs
from poolscope.streaming.documents import dedupe_stream, document_stream, write_stream
from poolscope.streaming.logs import log_stream, write_log_stream

NOW = 1706659200


# ------------------------------------------------------------------------------- sources


def test_pools_and_registry(spark, tmp_path):
    (tmp_path / "pools.json").write_text('{"Global": ["c1", "c2"], "Volunteer": ["c3"]}')
    (tmp_path / "bad.json").write_text("not json")
    pools = registry.read_pools(spark, str(tmp_path / "pools.json"))
    assert pools.count() == 3
    assert registry.read_pools(spark, str(tmp_path / "bad.json")).count() == 0
    rows = [
        ("s1", "a1", "i1", "prod", "c1"),
        ("s1", "a2", "i2", "prod", "c2"),
        ("s1", "a3", "i3", "prod", "c3"),
        ("s2", "a4", "i4", None, "c1"),
        ("s3", "a5", "i5", "prod", "c3"),
        (None, "a6", "i6", "prod", "c3"),
    ]
    known = spark.createDataFrame(
        rows, "Name string, MyAddress string, ScheddIpAddr string, CMSGWMS_Type string, collector string"
    )
    got = {r.Name: (r.MyAddress, r.CMS_Pool) for r in registry.schedulers(known, pools).collect()}
    assert got == {"s1": ("a2", "Global"), "s3": ("a5", "Volunteer")}
    alone = registry.schedulers(known, None, "s3").collect()
    assert [(r.Name, r.CMS_Pool) for r in alone] == [("s3", "Unknown")]


PEOPLE = {
    "1": {"institute": "A", "institute_country": "X", "dn": "/1", "profiles": [{}, {"login": "ann"}, {"login": "b"}]},
    "2": {"institute": "B", "institute_country": "Y", "dn": "/2", "profiles": [{"login": "ann"}]},
    "3": {"institute_country": "Y", "dn": "/3", "profiles": [{"login": "cid"}]},
    "4": {"institute": "D", "institute_country": "Z", "dn": "/4", "profiles": [{}]},
    "5": {"institute": "E", "institute_country": "Z", "dn": "/5", "profiles": [{"login": "eva"}]},
}


def test_affiliation_directory_and_refresh(spark, tmp_path):
    (tmp_path / "people.json").write_text(json.dumps(PEOPLE))
    directory = affiliations.directory_from_people(
        affiliations.read_people(spark, str(tmp_path / "people.json")), "position"
    )
    assert sorted(tuple(r) for r in directory.collect()) == [("ann", "B", "Y", "/2"), ("eva", "E", "Z", "/5")]
    path = str(tmp_path / "directory")
    refresh = lambda frame, now: affiliations.refresh_directory(spark, frame, path, now)
    assert refresh(directory.limit(0), NOW) is False
    assert refresh(directory, NOW) is True
    assert refresh(directory.filter("login = 'eva'"), NOW + 3600) is False
    assert refresh(directory.limit(0), NOW + 90000) is False
    assert affiliations.read_directory(spark, path).count() == 2
    assert refresh(directory.filter("login = 'eva'"), NOW + 90000) is True
    assert affiliations.read_directory(spark, path).count() == 1


@pytest.mark.parametrize("broadcast_rows", [10, 0])
def test_affiliation_keys(spark, broadcast_rows):
    directory = spark.createDataFrame(
        [("ann", "B", "Y", "/2"), ("eva", "E", "Z", "/5")], "login string, institute string, country string, dn string"
    )
    docs = spark.createDataFrame(
        [(1, "ann", "/5"), (2, "nobody", "/5"), (3, None, "/5"), (4, None, None)],
        "n int, CRAB_UserHN string, x509userproxysubject string",
    )
    got = add_affiliation(docs, directory, 2, broadcast_rows).orderBy("n").collect()
    assert [r.AffiliationInstitute for r in got] == ["B", None, "E", None]


def test_large_lookup_keeps_every_row_of_a_hot_key(spark):
    facts = spark.range(3000).select(
        F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 2 == 0, F.lit("cold")).alias("k"), "id"
    )
    dimension = spark.createDataFrame([("hot", 1), ("cold", 2), ("other", 3)], "key string, v int")
    got = left_lookup(facts, dimension, F.col("k"), "key", ["v"], max_rows=10, broadcast_rows=0)
    counts = {r.v: r["count"] for r in got.groupBy("v").count().collect()}
    assert counts == {1: 2000, 2: 500, None: 500}


def test_checkpoints(spark, tmp_path):
    path = str(tmp_path / "state")
    assert checkpoints.read_checkpoints(spark, path).count() == 0
    state = lambda rows: spark.createDataFrame(rows, checkpoints.SCHEMA)
    checkpoints.write_checkpoints(spark, state([("a", 5), ("b", 6)]), path, 1)
    checkpoints.write_checkpoints(spark, state([("a", 4), ("c", 9)]), path, 2)
    checkpoints.write_checkpoints(spark, state([("a", 4), ("c", 9)]), path, 2)
    got = {r.schedd: r.last_completion for r in checkpoints.read_checkpoints(spark, path).collect()}
    assert got == {"a": 5, "b": 6, "c": 9}
    (tmp_path / "old.json").write_text('{"a": 7, "b": 8.5}')
    old = checkpoints.read_checkpoint_json(spark, str(tmp_path / "old.json"))
    assert {tuple(r) for r in old.collect()} == {("a", 7), ("b", 8)}
    assert checkpoints.read_checkpoint_json(spark, str(tmp_path / "none.json")).count() == 0


def test_checkpoint_clamps(spark):
    rows = [
        ("vo", None, NOW - 43200),
        ("vo", NOW - 50 * 86400, NOW - 39 * 86400),
        ("crab3", NOW - 13 * 3600, NOW - 43200),
        ("crab3", NOW - 3600, NOW - 3600),
        ("vo", NOW - 13 * 3600, NOW - 13 * 3600),
    ]
    frame = spark.createDataFrame(rows, "s string, c bigint, want bigint")
    got = frame.select("want", incremental.start_of(F.col("c"), F.col("s"), NOW).alias("got")).collect()
    assert [r.got for r in got] == [r.want for r in got]


def test_json_records_keep_unknown_attributes(spark, tmp_path):
    line = {
        "GlobalJobId": "s#1",
        "JobStatus": 4,
        "QDate": "5",
        "CRAB_SaveLogsFlag": True,
        "CRAB_EDMOutputFiles": ["a"],
        "ChirpCMSSW_a_Events": 3,
        "ChirpCMSSW_a_Done": True,
        "JobPrio": 4,
        "jobprio": 5,
    }
    (tmp_path / "ads.json").write_text(json.dumps(line))
    got = ad_source.read_ads(spark, str(tmp_path / "ads.json"), "json").first()
    assert (got.JobStatus, got.QDate, got.CRAB_SaveLogsFlag, got.CRAB_EDMOutputFiles) == (4, 5, True, ["a"])
    assert got.chirp == {"ChirpCMSSW_a_Events": 3.0, "ChirpCMSSW_a_Done": 1.0}
    assert got.extra == {"JobPrio": "4", "jobprio": "5"}


def test_example_schema(spark, tmp_path):
    (tmp_path / "example.json").write_text('{"A": 1, "a": "x", "L": ["x"], "N": {"q": 1}, "F": 1.5}')
    got = dict(quality.schema_of_example(spark, str(tmp_path / "example.json")).collect())
    assert got["A"] == "BIGINT" and got["a"] == "STRING" and got["L"] == "ARRAY<STRING>"
    assert got["N"] == "OBJECT<q: BIGINT>"


# --------------------------------------------------------------------------------- sinks


def ads(spark, rows):
    """Records (id, status, queued, entered)."""
    return spark.createDataFrame(
        rows, "GlobalJobId string, JobStatus bigint, QDate bigint, EnteredCurrentStatus bigint"
    ).selectExpr("*", "5L AS JobUniverse", "'production' AS CMS_Type")


def test_runs_are_repeatable(spark, tmp_path):
    records = ads(
        spark,
        [
            ("vo@a#1", 4, NOW - 90000, NOW - 100),
            ("vo@a#1", 4, NOW - 90000, NOW - 100),
            ("vo@a#2", 3, NOW - 10, NOW - 50),
            ("vo@b#3", 4, NOW - 10, NOW - 60 * 86400),
            ("vo@b#4", None, NOW - 10, NOW - 5),
        ],
    )
    index, broker, state = (str(tmp_path / name) for name in ("index", "broker", "state"))
    config = RunConfig(
        launch_time=NOW,
        index_paths=(index,),
        broker_path=broker,
        state_path=state,
        feed_index=True,
        feed_broker=True,
        process_queue=True,
        metadata={"spider_hostname": "h"},
    )
    known = spark.createDataFrame([("vo@a", "Global")], "Name string, CMS_Pool string")
    people = spark.createDataFrame(
        [("ann", "B", "Y", "/2")], "login string, institute string, country string, dn string"
    )
    for attempt in range(2):
        run(spark, records.withColumn("CRAB_UserHN", F.lit("ann")), None, config, Dimensions(known, people))
    stored = sinks.read_index(spark, index)
    assert sorted((r.GlobalJobId, r.CMS_Pool, r.AffiliationInstitute) for r in stored.collect()) == [
        ("vo@a#1", "Global", "B"),
        ("vo@a#2", "Global", "B"),
    ]
    assert stored.select("metadata.spider_source").first()[0] == "condor_history"
    assert {str(r.idx_date) for r in stored.collect()} == {"2024-01-29", "2024-01-30"}
    assert spark.read.json(broker).count() == 2
    marks = {r.schedd: r.last_completion for r in checkpoints.read_checkpoints(spark, state).collect()}
    assert marks == {"vo@a": NOW - 50, "vo@b": NOW - 12 * 3600}  # the unusable record does not count


def test_both_feeds_of_a_run_stay(spark, tmp_path):
    done = ads(spark, [("vo@a#1", 4, NOW - 10, NOW - 100), ("vo@a#9", None, NOW - 10, NOW - 1)])
    queued = ads(spark, [("vo@a#2", 2, NOW - 10, NOW - 100), ("vo@b#3", 2, NOW - 10, NOW - 100)])
    queued = queued.withColumn("x509userproxysubject", F.lit("/2")).withColumn(
        "CMS_Pool", F.when(F.col("GlobalJobId") == "vo@b#3", "Own")
    )
    known = spark.createDataFrame([("vo@a", "Global")], "Name string, CMS_Pool string")
    people = spark.createDataFrame(
        [("ann", "B", "Y", "/2")], "login string, institute string, country string, dn string"
    )
    index, broker, bad = (str(tmp_path / name) for name in ("index", "broker", "bad"))
    config = RunConfig(
        launch_time=NOW, index_paths=(index,), broker_path=broker, quarantine_path=bad,
        feed_index=True, feed_index_for_queue=True, feed_broker=True, process_queue=True,
    )
    run(spark, done, queued, config, Dimensions(known, people))
    stored = {r.GlobalJobId: (r.CMS_Pool, r.AffiliationInstitute) for r in sinks.read_index(spark, index).collect()}
    assert stored == {"vo@a#1": ("Global", None), "vo@a#2": ("Global", "B"), "vo@b#3": ("Own", "B")}
    assert spark.read.json(broker).count() == 3
    kept = spark.read.parquet(bad)
    assert [(r.GlobalJobId, r.reasons, r.feed) for r in kept.collect()] == [
        ("vo@a#9", ["JobStatus is missing"], "condor_history")
    ]


def test_state_moves_over_written_documents_only(spark, tmp_path):
    rows = [(f"vo@a#{i}", 4, NOW - 10, NOW - 5000 + i * 1000) for i in range(5)]
    records = ads(spark, [*rows, ("vo@b#1", 4, NOW - 10, NOW - 7)])
    index, state = str(tmp_path / "index"), str(tmp_path / "state")
    common = dict(index_paths=(index,), state_path=state, feed_index=True, schedulers="vo@a", max_documents=1)
    run(spark, records, None, RunConfig(launch_time=NOW, **common))
    marks = lambda: {r.schedd: r.last_completion for r in checkpoints.read_checkpoints(spark, state).collect()}
    assert marks() == {"vo@a": NOW - 4000}
    for later in range(1, 4):
        run(spark, records, None, RunConfig(launch_time=NOW + later, **common))
    assert marks() == {"vo@a": NOW - 1000}
    assert {r.GlobalJobId for r in sinks.read_index(spark, index).collect()} == {f"vo@a#{i}" for i in range(5)}


def test_full_records_run_in_time(spark, sf, tmp_path):
    """A run over records with all attributes gets through the optimizer."""
    import time

    from poolscope.sources.samples import LAUNCH_TIME, sample_ads

    records = sample_ads(spark, sf, maps=True).limit(20)
    config = RunConfig(
        launch_time=LAUNCH_TIME, index_paths=(str(tmp_path / "index"),), feed_index=True,
        feed_index_for_queue=True, process_queue=True, history_minutes=39 * 1440,
    )
    started = time.time()
    done = run(spark, records, records, config)
    assert set(done) == {"history", "queue"} and time.time() - started < 90


def test_dry_and_read_only_runs_write_nothing(spark, tmp_path):
    records = ads(spark, [("vo@a#1", 2, NOW - 10, NOW - 100)])
    for flags, count in ((dict(dry_run=True), 0), (dict(read_only=True), 1)):
        config = RunConfig(
            launch_time=NOW, index_paths=(str(tmp_path / "i"),), feed_index=True, feed_index_for_queue=True,
            process_queue=True, skip_history=True, **flags,
        )
        done = run(spark, records, records, config)
        assert list(done) == ["queue"]
        assert done["queue"].select("doc_id", "Status").count() == count
    assert not (tmp_path / "i").exists()


def test_caps_and_filters(spark):
    records = ads(spark, [(f"vo@a#{i}", 2, NOW, NOW) for i in range(9)] + [("vo@b#1", 2, NOW, NOW)])
    named = records.withColumn("ScheddName", F.substring_index("GlobalJobId", "#", 1))
    got = select.capped_per_scheduler(named, 3)
    assert {r.ScheddName: r["count"] for r in got.groupBy("ScheddName").count().collect()} == {"vo@a": 4, "vo@b": 1}
    assert select.capped_per_scheduler(named, None) is named
    assert select.only_schedulers(named, "vo@b,vo@c", "ScheddName").count() == 1
    assert select.lookup(records, NOW, constraint="GlobalJobId LIKE '%3'").count() == 1
    assert select.lookup(records, NOW, projection="GlobalJobId, QDate", limit=2).columns == ["GlobalJobId", "QDate"]


def test_missing_type_is_not_selected(spark):
    records = ads(spark, [("vo@a#1", 2, NOW, NOW)]).withColumn("CMS_Type", F.lit(None).cast("string"))
    assert select.monitored(records).count() == 0


def test_offline_conversion(spark, tmp_path):
    records = ads(spark, [("vo@a#1", 4, NOW, NOW), ("vo@a#2", None, NOW, NOW)])
    convert_offline(records, str(tmp_path / "docs"), NOW)
    stored = spark.read.json(str(tmp_path / "docs"))
    assert [r.Status for r in stored.select("Status").collect()] == ["Completed"]


def test_later_batches_replace_documents_and_compaction_keeps_them(spark, tmp_path):
    path, target = str(tmp_path / "index"), str(tmp_path / "compact")
    docs = lambda status: spark.createDataFrame(
        [("a", NOW, status), ("b", NOW + 86400, status)], "doc_id string, QDate bigint, Status string"
    )
    sinks.write_index(sinks.route(docs("Running"), "jobs"), path, 1)
    sinks.write_index(sinks.route(docs("Completed").limit(1), "jobs"), path, 2)
    got = {r.doc_id: r.Status for r in sinks.read_index(spark, path).collect()}
    assert got == {"a": "Completed", "b": "Running"}
    sinks.compact_index(spark, path, target)
    assert {r.doc_id: r.Status for r in spark.read.parquet(target).collect()} == got


def test_mapping_dump():
    dumped = json.loads(catalog.dump_mapping())
    assert dumped["mappings"]["properties"]["metadata"]["properties"]["spider_runtime"]["format"] == "epoch_millis"
    assert dumped["settings"]["index"]["mapping.total_fields.limit"] == 2000


# ----------------------------------------------------------------------- reconcile, alert


@pytest.mark.parametrize("series, severity", [(96, 0), (94, 2), (40, 3), (160, 3)])
def test_gap_severity(spark, series, severity):
    one = lambda name, n: spark.createDataFrame([("Completed", n)], f"Status string, {name} bigint")
    gaps = reconcile.source_gaps(one("index_total", 100), one("own_total", 100), one("series_total", series))
    assert reconcile.overall_severity(gaps).first().severity == severity


def test_alerts(spark):
    config = notify.parse_config(
        spark.createDataFrame(
            [('{"cases": {"exit_0": {"targets": []}, "exit_3": {"targets": ["t"]}}, "default_case": {"targets": ["d"]}}',)],
            "value string",
        )
    )
    results = spark.createDataFrame([(0, "x"), (3, "  y"), (2, "")], "case int, description string")
    got = sorted((r.case, r.targets, r.description) for r in notify.alerts(results, config, NOW, "s").collect())
    assert got == [(2, ["d"], "No message provided"), (3, ["t"], "y")]


# ----------------------------------------------------------------------------------- logs


def test_log_lines(spark, tmp_path):
    (tmp_path / "queue.log").write_text(
        "2019-03-26 09:48:02,689 : root:WARNING - &&& There are 61 schedds to query.\n"
        "2019-03-26 09:48:02,689 : root:WARNING - SCHEMA_VALIDATOR: unknown key=Abc, val=1\n"
    )
    (tmp_path / "history.log").write_text("no header but @@@ Total processing time: 3.5 mins\n")
    lines = read_logs(spark, str(tmp_path / "queue.log"), str(tmp_path / "history.log"))
    events = {r.spider_source: r for r in logparse.parse_logs(lines).collect()}
    first = events["condor_queue"]
    assert (first.message_type, first.n_schedds, first.log_source, first.log_level) == ("script_start", 61, "root", "WARNING")
    assert str(first.timestamp) == "2019-03-26 09:48:02.689000"
    second = events["condor_history"]
    assert (second.message_type, second.total_processing_time, second.timestamp) == ("script_end", 3.5, None)
    missing = quality.missing_fields(lines, quality.schema_of_catalog(spark))
    assert [r.field for r in missing.collect()] == ["Abc"]


# -------------------------------------------------------------------------------- streams


def test_log_stream_equals_batch(spark, tmp_path):
    for name in ("queue", "history"):
        (tmp_path / name).mkdir()
        (tmp_path / name / "a.log").write_text("2024-01-01 00:00:00,000 : root:ERROR - Processing time for history: 1.0 mins\n")
    events = log_stream(tail_logs(spark, str(tmp_path / "queue"), str(tmp_path / "history")), "run-logs")
    write_log_stream(events, str(tmp_path / "out"), str(tmp_path / "state")).awaitTermination()
    got = spark.read.parquet(str(tmp_path / "out")).collect()
    assert {(r.spider_source, r.message_type) for r in got} == {
        ("condor_queue", "history_end"),
        ("condor_history", "history_end"),
    }


def test_document_stream_adds_only_new_documents(spark, tmp_path):
    folder, index, state = (str(tmp_path / name) for name in ("in", "index", "state"))
    records = ads(spark, [("vo@a#1", 3, NOW, NOW), ("vo@a#1", 3, NOW, NOW), ("vo@a#2", 3, NOW, NOW)])
    fields = "doc_id GlobalJobId QDate RecordTime EnteredCurrentStatus Status _error".split()

    def consume():
        source = ad_source.read_ads_stream(spark, folder, records.schema, files_per_batch=1)
        docs = document_stream(source, NOW, fields=fields)
        write_stream(docs, state, template="jobs", index_paths=[index]).awaitTermination()
        return sorted(r.GlobalJobId for r in sinks.read_index(spark, index).collect())

    records.coalesce(1).write.parquet(folder)
    assert consume() == ["vo@a#1", "vo@a#2"]
    ads(spark, [("vo@a#2", 3, NOW, NOW), ("vo@a#3", 3, NOW, NOW)]).coalesce(1).write.mode("append").parquet(folder)
    assert consume() == ["vo@a#1", "vo@a#2", "vo@a#3"]


def test_stream_quarantine(spark, tmp_path):
    folder, index, state, bad = (str(tmp_path / name) for name in ("in", "index", "state", "bad"))
    records = ads(spark, [("vo@a#1", 3, NOW, NOW), ("vo@a#2", None, NOW, NOW)])
    records.coalesce(1).write.parquet(folder)
    source = ad_source.read_ads_stream(spark, folder, records.schema)
    fields = "doc_id GlobalJobId QDate RecordTime EnteredCurrentStatus Status _error".split()
    docs = document_stream(source, NOW, keep_unusable=True, fields=fields)
    write_stream(docs, state, template="jobs", index_paths=[index], quarantine_path=bad).awaitTermination()
    assert [r.GlobalJobId for r in sinks.read_index(spark, index).collect()] == ["vo@a#1"]
    kept = spark.read.parquet(bad).collect()
    assert [(r.GlobalJobId, r.reasons) for r in kept] == [("vo@a#2", ["JobStatus is missing"])]


def test_stateful_dedupe(spark, tmp_path):
    folder = str(tmp_path / "in")
    ads(spark, [("vo@a#1", 3, NOW, NOW)] * 3).coalesce(1).write.parquet(folder)
    source = ad_source.read_ads_stream(spark, folder, ads(spark, [("x", 1, 1, 1)]).schema)
    docs = document_stream(source, NOW, fields=["doc_id", "RecordTime", "_error"])
    unique = dedupe_stream(docs.withColumn("at", F.timestamp_seconds("RecordTime")), "at")
    query = (
        unique.writeStream.format("parquet")
        .option("path", str(tmp_path / "out"))
        .option("checkpointLocation", str(tmp_path / "state"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


# ---------------------------------------------------------------------------------- plans


def plan_of(frame, capsys):
    frame.explain()
    return capsys.readouterr().out


def test_dedupe_is_limited_before_the_shuffle(spark, sf, capsys):
    from poolscope.plans.queries import QUERIES

    plan = plan_of(QUERIES["latest_docs"](spark, sf), capsys)
    assert plan.index("WindowGroupLimit") < plan.index("Exchange") < plan.rindex("WindowGroupLimit")


@pytest.mark.parametrize("name", ["alert_records", "failure_summary", "index_histogram", "affiliation_join_shuffled", "schema_violations"])
def test_no_cross_joins(spark, sf, capsys, name):
    from poolscope.plans.queries import QUERIES

    plan = plan_of(QUERIES[name](spark, sf), capsys)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_selection_reaches_the_scan(spark, tmp_path, capsys):
    ads(spark, [("vo@a#1", 2, NOW, NOW)]).write.parquet(str(tmp_path / "ads"))
    stored = ad_source.read_ads(spark, str(tmp_path / "ads"))
    spark.conf.set("spark.sql.maxMetadataStringLength", "5000")
    plan = plan_of(select.select_history(stored, NOW), capsys)
    spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "EqualTo(JobUniverse,5)" in plan and "GreaterThanOrEqual(EnteredCurrentStatus" in plan
