"""Kept state: schedulers' places, closed buckets, replaced documents, stored schemas, sketches, bunches and counts of runs."""

import json
import os
import uuid
from pathlib import Path

import pandas as pd
import pytest
from pyspark.sql import functions as F

from poolscope.operators import bunches, incremental, schema, sketches, upsert
from poolscope.operators.quality import most_frequent_value
from poolscope.plans.runs import RunConfig, run, spread
from poolscope.sources.samples import LAUNCH_TIME, sample_ads
from poolscope.streaming import histograms
from poolscope.streaming import incremental as stream

DAY = 86400


@pytest.fixture
def folder(tmp_path):
    return str(tmp_path)


def exchanges(frame) -> int:
    return frame._jdf.queryExecution().executedPlan().toString().count("Exchange")


# ------------------------------------------------------------------------- replaced documents


def documents(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id string, Status string, day string")
    return docs.withColumn("idx_date", F.col("day").cast("date")).drop("day")


def current(spark, path):
    return sorted((r.doc_id, r.Status) for r in upsert.read_current(spark, path).collect())


def test_upsert_replaces_by_id(spark, folder):
    upsert.upsert(documents(spark, [("a", "1", "2024-01-01"), ("b", "1", "2024-01-01"), ("c", "1", "2024-01-02"), ("c", "1", "2024-01-02")]), folder, 1)
    upsert.upsert(documents(spark, [("a", "2", "2024-01-01"), ("d", "2", "2024-01-03")]), folder, 2)
    assert current(spark, folder) == [("a", "2"), ("b", "1"), ("c", "1"), ("d", "2")]
    # an older batch that comes late, and a batch that is repeated, change nothing that is newer
    upsert.upsert(documents(spark, [("a", "0", "2024-01-01"), ("e", "0", "2024-01-01")]), folder, 0)
    upsert.upsert(documents(spark, [("a", "2", "2024-01-01"), ("d", "2", "2024-01-03")]), folder, 2)
    assert current(spark, folder) == [("a", "2"), ("b", "1"), ("c", "1"), ("d", "2"), ("e", "0")]
    some = upsert.read_current(spark, folder, "2024-01-02", "2024-01-02")
    assert [r.doc_id for r in some.collect()] == ["c"]


def test_reading_an_upserted_index_needs_no_exchange(spark, folder):
    for k in range(3):
        upsert.upsert(documents(spark, [(f"{k}-{n}", str(k), "2024-01-01") for n in range(20)]), folder, k, buckets=4)
    assert exchanges(upsert.read_current(spark, folder).filter("Status = '1'").select("doc_id")) == 0


def test_only_touched_buckets_are_written(spark, folder):
    upsert.upsert(documents(spark, [(str(n), "1", f"2024-01-0{1 + n % 3}") for n in range(60)]), folder, 1, buckets=4)
    upsert.upsert(documents(spark, [("0", "2", "2024-01-01")]), folder, 2, buckets=4)
    written = list(Path(folder, "version=2").glob("idx_date=*/bucket=*"))
    assert len(written) == 1
    _, snapshot = upsert.current_snapshot(spark, folder)
    assert snapshot.filter("folder = 'version=2'").count() == 1 and snapshot.filter("folder = 'version=1'").count() == 11


def test_a_write_that_breaks_off_leaves_the_old_state(spark, folder, monkeypatch):
    upsert.upsert(documents(spark, [("a", "1", "2024-01-01")]), folder, 1)

    def crash(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patched:
        patched.setattr(upsert, "_commit", crash)
        with pytest.raises(RuntimeError):
            upsert.upsert(documents(spark, [("a", "2", "2024-01-01"), ("z", "2", "2024-01-01")]), folder, 2)
    assert current(spark, folder) == [("a", "1")]
    upsert.upsert(documents(spark, [("a", "3", "2024-01-01")]), folder, 3)  # takes the same folder
    assert current(spark, folder) == [("a", "3")]


def test_overlapping_writers_are_noticed(spark, folder, monkeypatch):
    upsert.upsert(documents(spark, [("a", "1", "2024-01-01")]), folder, 1)
    before = upsert.current_snapshot(spark, folder)
    upsert.upsert(documents(spark, [("a", "2", "2024-01-01")]), folder, 2)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        upsert._commit(spark, folder, before[0], before[1], "version=2")
    assert current(spark, folder) == [("a", "2")]


def test_unused_folders_can_be_removed(spark, folder):
    upsert.upsert(documents(spark, [("a", "1", "2024-01-01"), ("b", "1", "2024-01-02")]), folder, 1)
    upsert.upsert(documents(spark, [("a", "2", "2024-01-01")]), folder, 2)
    gone = upsert.remove_unused(spark, folder)
    assert "snapshots/snapshot=1" in gone and len([g for g in gone if g.startswith("version=1/idx_date=2024-01-01")]) == 1
    assert current(spark, folder) == [("a", "2"), ("b", "1")] and upsert.remove_unused(spark, folder) == []


def test_an_index_without_documents(spark, folder):
    assert upsert.read_current(spark, folder) is None and upsert.remove_unused(spark, folder) == []
    upsert.upsert(documents(spark, []), folder, 1)
    assert upsert.read_current(spark, folder) is None
    upsert.upsert(documents(spark, [("a", "1", "2024-01-01")]).withColumn("more", F.lit(1)), folder, 2)
    upsert.upsert(documents(spark, [("b", "1", "2024-01-01")]), folder, 3)
    assert sorted((r.doc_id, r.more) for r in upsert.read_current(spark, folder).collect()) == [("a", 1), ("b", None)]


# ------------------------------------------------------------------------- schedulers' places


class Handle:
    """The state and timers of one key."""

    def __init__(self):
        self.value, self.timers = None, []

    def getValueState(self, name, schema):
        return self

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, value):
        self.value = value

    def registerTimer(self, at):
        self.timers.append(at)

    def deleteTimer(self, at):
        self.timers.remove(at)

    def listTimers(self):
        return iter(self.timers)


class Watermark:
    def __init__(self, seconds):
        self.seconds = seconds

    def getCurrentWatermarkInMs(self):
        return self.seconds * 1000


def moved(rows):
    return [(r.last_completion, r.records, bool(r.expired)) for part in rows for r in part.itertuples()]


def test_a_place_never_moves_back_and_is_taken_up_by_its_timer():
    handle, place = Handle(), stream.SchedulerPlace()
    place.init(handle)
    place.handleInitialState(("s",), pd.DataFrame({"schedd": ["s"], "last_completion": [1000.0]}), None)
    part = lambda latest, start: iter([pd.DataFrame({"records": [2], "latest": [latest], "start": [start]})])
    assert moved(place.handleInputRows(("s",), part(900, 800), None)) == [(1000, 2, False)]
    assert moved(place.handleInputRows(("s",), part(5000, 1000), None)) == [(5000, 2, False)]
    assert moved(place.handleInputRows(("s",), part(None, 1000), None)) == [(5000, 2, False)]
    assert handle.timers == [(5000 + incremental.RETENTION + 1) * 1000]
    late = 5000 + incremental.RETENTION + 700
    assert moved(place.handleExpiredTimer(("s",), Watermark(late), None)) == [(5700, 0, True)]
    assert handle.value == (5700,) and handle.timers == [(5700 + incremental.RETENTION + 1) * 1000]


def feed(spark, folder, rows):
    ads = spark.createDataFrame(rows, "GlobalJobId string, EnteredCurrentStatus long, CRAB_PostJobLastUpdate double")
    ads.withColumns({"JobUniverse": F.lit(5), "CMS_Type": F.lit("x")}).coalesce(1).write.mode("append").parquet(folder + "/in")
    return spark.read.parquet(folder + "/in").schema


def test_places_of_two_runs_in_one_stream(spark, folder):
    """Late records and updates within a run; a second run takes up what the first one stored; a silent scheduler's timer."""
    now, later = 40 * DAY * 3, 40 * DAY * 3 + 90 * DAY
    known = spark.createDataFrame([("a", now - 5000), ("quiet", now - 100), ("crab1", now - 20 * DAY)], "schedd string, last_completion long")
    schema_ = feed(spark, folder, [("a#1", now - 400, None), ("a#2", now - 5600, None), ("a#3", now - 9000, None), ("new#1", now - 100, None),
                                   ("new#2", now - 30 * DAY, None), ("crab1#1", now - 15 * DAY, None), ("crab1#2", now - 15 * DAY, now - 60.0)])

    def go(time, places):
        rows = spark.readStream.schema(schema_).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
        read = stream.history_stream(rows, places, time)
        stream.write_place_stream(stream.place_stream(read, places, time), folder + "/places", folder + "/c1", time).awaitTermination()
        stream.write_history_stream(read.select("GlobalJobId", "_start"), folder + "/read", folder + "/c2").awaitTermination()
        return {r.GlobalJobId for r in spark.read.parquet(folder + "/read").collect()}

    assert go(now, known) == {"a#1", "a#2", "new#1", "crab1#2"}
    first = {r.schedd: r.last_completion for r in stream.read_places(spark, folder + "/places").collect()}
    # the late update moves the place to the start of the run, not to the old change
    assert first == {"a": now - 400, "new": now - 100, "crab1": now - 12 * 3600}
    feed(spark, folder, [("a#4", now - 450, None), ("a#5", now - 5000, None), ("new#3", now - 200, None)])
    places = incremental.merge_checkpoints(known, stream.read_places(spark, folder + "/places", before=now + 1))
    assert go(now, known) - {"a#1", "a#2", "new#1", "crab1#2"} == {"a#4", "a#5", "new#3"}  # the same run again: its own places do not count
    feed(spark, folder, [("a#6", later - 10, None)])
    feed(spark, folder, [("a#7", later - 5, None)])
    assert "a#7" in go(later, places)
    last = {r.schedd: r.last_completion for r in stream.read_places(spark, folder + "/places").collect()}
    # the watermark has left the silent ones behind by more than the retention time
    assert last["a"] == later - 5 and last["new"] > now and last["quiet"] > now


def test_places_of_empty_input(spark, folder):
    assert stream.read_places(spark, folder + "/none").count() == 0


# ------------------------------------------------------------------------- closed buckets


def test_a_late_document_is_refused(spark, folder):
    def add(*rows):
        docs = spark.createDataFrame(rows, "GlobalJobId string, RecordTime long, Status string, MemoryMB double")
        docs.coalesce(1).write.mode("append").parquet(folder + "/in")
        return docs.schema

    def go():
        rows = spark.readStream.schema(kind).option("maxFilesPerTrigger", 1).parquet(folder + "/in")
        histograms.write_buckets(histograms.index_buckets(rows), folder + "/out", folder + "/c").awaitTermination()
        found = histograms.read_buckets(spark, folder + "/out", histograms.INDEX_BUCKETS, 0, 900, 300)
        return {(r.Status, r.bucket): (r.documents, r.jobs) for r in found.collect() if r.documents}

    kind = add(("a", 10, "Running", 1.0), ("a", 20, "Running", None), ("b", 30, "Running", 1.0), ("c", 310, "Idle", 1.0), ("x", 15, "Held", 1.0))
    assert go() == {}  # still open
    add(("d", 299, "Running", 1.0), ("e", 1100, "Idle", 1.0))  # late, but within the delay
    assert go() == {("Running", 0): (4, 3)}
    add(("f", 100, "Running", 1.0), ("g", 5000, "Idle", 1.0))  # the bucket is closed: refused
    assert go() == {("Running", 0): (4, 3), ("Idle", 300): (1, 1), ("Idle", 900): (1, 1)}
    gaps = histograms.read_buckets(spark, folder + "/out", histograms.INDEX_BUCKETS, 0, 900, 300)
    assert gaps.count() == 12 and gaps.filter("documents = 0").count() == 9


# ------------------------------------------------------------------------- nested schemas


def bodies(spark, *texts):
    return spark.createDataFrame([(str(k), t) for k, t in enumerate(texts)], "doc_id string, document string")


def paths(frame, *names):
    return {tuple(r[n] if not isinstance(r[n], list) else "|".join(r[n]) for n in names) for r in frame.collect()}


def test_inferred_schemas(spark):
    found = schema.infer_schema(bodies(
        spark, '{"a":1,"b":{"c":"x","d":[1,2.5]},"L":[{"n":"q"},{"n":null}]}', '{"a":null,"b":{},"e":[]}', "no json", None, "[1]", "{}"))
    assert paths(found, "path", "kinds", "documents") == {
        ("a", "int", 2), ("b", "dict", 2), ("b.c", "str", 1), ("b.d", "list", 1), ("b.d[]", "float", 1), ("L", "list", 1), ("L[]", "dict", 1),
        ("L[].n", "str", 1), ("e", "list", 1)}
    assert {r.share for r in found.filter("path = 'a'").collect()} == {2 / 3}
    assert schema.infer_schema(bodies(spark, None)).count() == 0


def test_violations_at_every_level(spark):
    known = schema.infer_schema(bodies(spark, '{"a":1,"f":1.5,"b":{"c":"x","d":[1,2]},"L":[{"n":"q","v":1.5,"in":{"k":true}}],"z":null}'))
    docs = bodies(
        spark,
        '{"a":1.5,"b":{"c":7,"d":[1,"x"],"e":{"z":1}},"L":[{"n":"q","in":{}},{"v":"t","n":"a","in":{"k":1}}]}',
        '{"zz":[1,{"k":2}],"b":"str","L":[1,2],"f":3,"z":"any"}',
        '{"b":{"d":["s"],"c":null},"L":[{"n":"q","v":1,"in":{"k":false,"m":[[1]]}},[2]]}',
        '{"b":{"c":"x","d":[]},"L":[],"a":null}', "no json", None)
    assert paths(schema.nested_violations(docs, known), "doc_id", "path", "violation") == {
        ("0", "a", "incorrect_type"), ("0", "b.c", "incorrect_type"), ("0", "b.d[]", "inconsistent_list"), ("0", "b.e", "unknown_key"),
        ("0", "L[].v", "incorrect_type"), ("0", "L[].in.k", "incorrect_type"),
        ("1", "zz", "unknown_key"), ("1", "b", "incorrect_type"), ("1", "L[]", "incorrect_type_in_list"),
        ("2", "b.d[]", "incorrect_type_in_list"), ("2", "L[]", "inconsistent_list"), ("2", "L[].in.m", "unknown_key")}


def test_checking_documents_is_not_shuffled_before_violations(spark):
    known = schema.infer_schema(bodies(spark, '{"a":1}'))
    plan = schema.nested_violations(bodies(spark, '{"a":1}'), known)._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "SortMergeJoin" not in plan


def test_widening_and_versions(spark, folder):
    first = schema.infer_schema(bodies(spark, '{"a":1,"b":null,"c":"x","d":1}'))
    second = schema.infer_schema(bodies(spark, '{"a":1.5,"b":true,"c":5,"e":{"f":1}}'))
    assert schema.read_schema(spark, folder + "/s").count() == 0
    schema.store_schema(spark, first, folder + "/s", 1)
    schema.store_schema(spark, second, folder + "/s", 2)
    assert paths(schema.read_schema(spark, folder + "/s"), "path", "kinds", "change") == {
        ("a", "float", "widened"), ("b", "bool", "widened"), ("c", "int|str", "conflict"), ("d", "int", "same"), ("e", "dict", "added"), ("e.f", "int", "added")}
    schema.store_schema(spark, second, folder + "/s", 2)  # the same version again
    assert paths(schema.read_schema(spark, folder + "/s", before=2), "path", "change") == {(p, "added") for p in "abcd"}
    either = bodies(spark, '{"c":"x"}', '{"c":1}', '{"a":1}', '{"b":null}')
    assert schema.nested_violations(either, schema.read_schema(spark, folder + "/s")).count() == 0


# ------------------------------------------------------------------------- sketches


def test_distinct_jobs_within_the_error(spark, folder):
    docs = spark.range(120_000).selectExpr("'Running' AS Status", "id % 3 * 300 AS RecordTime", "CAST(id % 90000 AS STRING) AS GlobalJobId")
    for k, part in enumerate((docs.filter("id < 70000"), docs.filter("id >= 50000"))):
        sketches.store_run(sketches.job_sketches(part), folder, k)
    sketches.store_run(sketches.job_sketches(docs.filter("id >= 50000")), folder, 1)  # the same run again
    total = sketches.estimated_jobs(spark, folder, "Status").first().jobs
    assert abs(total - 90_000) <= 3 * sketches.ERROR * 90_000
    for row in sketches.estimated_jobs(spark, folder, "Status", "bucket").collect():
        assert abs(row.jobs - 30_000) <= 3 * sketches.ERROR * 30_000


@pytest.mark.parametrize("frequent", [True, False])
def test_frequent_values_are_exact(spark, folder, frequent):
    # many values: the sketch loses most of them; without a frequent one all values of the key are counted
    value = "CASE WHEN id % 5 = 0 THEN 'often' WHEN id % 7 = 0 THEN 'also' ELSE CAST(id AS STRING) END" if frequent else "CAST(id DIV 2 AS STRING)"
    rows = spark.range(30_000).selectExpr("IF(id % 2 = 0, 'x', NULL) AS key", f"{value} AS v")
    sketches.store_run(sketches.value_sketches(rows, ["key"], "v"), folder, 1)
    found = {(r.key, r.v, r.occurrences) for r in sketches.top_values(rows, ["key"], "v", folder).collect()}
    assert found == {(r.key, r.v, r.occurrences) for r in most_frequent_value(rows, ["key"], "v").collect()}
    two = sketches.top_values(rows, ["key"], "v", folder, 2)
    exact = rows.groupBy("key", "v").count().collect()
    for key in ("x", None):
        best = sorted(((-r["count"], r.v) for r in exact if r.key == key))[:2]
        assert sorted((-r.occurrences, r.v) for r in two.collect() if r.key == key) == best


# ------------------------------------------------------------------------- bunches


def test_bunches_are_cut_by_count(spark, folder):
    messages = spark.range(1050).selectExpr("CAST(id AS STRING) AS key", "id AS value").repartition(3)
    bunches.write_bunches(messages, folder, 1, 100)
    reports = bunches.read_reports(spark, folder).collect()
    sizes = [b.messages for r in reports for b in r.bunches]
    assert sum(sizes) == 1050 and max(sizes) == 100 and sum(s < 100 for s in sizes) <= 3
    assert sum(r.received for r in reports) == sum(r.sent for r in reports) == 1050 and all(r.elapsed >= 0 for r in reports)
    for row in bunches.read_bunches(spark, folder, "key string, value long").groupBy("bunch").count().collect():
        assert row["count"] <= 100


def test_a_retried_task_and_a_repeated_batch_add_nothing(spark, folder):
    messages = spark.range(30).selectExpr("CAST(id AS STRING) AS key")
    bunches.write_bunches(messages, folder, 1, 10)
    # what a first try of a task left behind: a file that no report names
    Path(folder, "bunches", f"bunch-{uuid.uuid4().hex}.json").write_text('{"key":"ghost"}\n')
    bunches.write_bunches(messages, folder, 1, 10)
    bunches.write_bunches(spark.range(5).selectExpr("'m' || id AS key"), folder, 2, 10)
    read = sorted(r.key for r in bunches.read_bunches(spark, folder, "key string").collect())
    assert read == sorted([str(k) for k in range(30)] + [f"m{k}" for k in range(5)])


def test_refused_messages_are_received_but_not_sent(spark, folder):
    messages = spark.createDataFrame([("short",), ("x" * 500,), ("é" * 10,)], "key string")
    bunches.write_bunches(messages.coalesce(1), folder, 1, 10, most_bytes=100)
    assert [(r.received, r.sent) for r in bunches.read_reports(spark, folder).filter("received > 0").collect()] == [(3, 2)]
    bunches.write_bunches(messages.limit(0), folder, 2)
    assert bunches.read_reports(spark, folder).agg(F.sum("sent")).first()[0] == 2


# ------------------------------------------------------------------------- runs


def test_runs_count_in_the_job_that_writes(spark, sf, folder):
    ads = sample_ads(spark, sf).withColumn("QDate", F.when(F.col("event_id") % 10 != 0, F.col("QDate")))
    report = {}
    config = RunConfig(launch_time=LAUNCH_TIME, history_minutes=39 * 24 * 60, feed_index=True, index_paths=(folder + "/index",))
    done = run(spark, ads, None, config, report=report)
    counts = report["history"]
    assert counts["consistent"] and counts["quarantined"] > 0 and counts["queried"] == counts["processed"] + counts["quarantined"]
    ids = done["history"].select("doc_id").collect()
    assert len({r.doc_id for r in ids}) == len(ids) <= counts["processed"]


def test_derived_rows_go_when_the_index_is_written(spark, sf, folder):
    shared = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(shared))
    config = RunConfig(launch_time=LAUNCH_TIME, history_minutes=39 * 24 * 60, feed_index=True, index_paths=(folder + "/index",))
    docs = run(spark, sample_ads(spark, sf), None, config)["history"]
    left = [p for name in set(os.listdir(shared)) - before for p in Path(shared, name).rglob("*.parquet")]
    assert not left and docs.count() > 0
    kept = run(spark, sample_ads(spark, sf), None, RunConfig(launch_time=LAUNCH_TIME, read_only=True, history_minutes=39 * 24 * 60))["history"]
    assert kept.columns == docs.columns and kept.count() == docs.count()


def test_small_sources_are_spread(spark):
    assert spread(spark.range(10).coalesce(1)).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    many = spark.range(0, 100, 1, 20)
    assert spread(many) is many
    assert json.dumps({})  # reports are plain values
