"""Work that must not be done twice, or by few tasks, or on wide rows."""

import json
from dataclasses import replace

from pyspark.sql import functions as F

from poolscope.operators import schema, sinks
from poolscope.operators.sinks import document_json
from poolscope.plans import queries, runs
from poolscope.plans.runs import RunConfig, run
from poolscope.sources.samples import LAUNCH_TIME, ads_of


def base(spark, rows):
    return spark.range(rows).selectExpr(
        "id AS event_id", "id % 14 AS user_id", "CAST(2 AS INT) AS g", "CAST(id AS DOUBLE) AS amount", "id % 100 AS k", f"{LAUNCH_TIME} - id AS e")


def plan(frame):
    return frame._jdf.queryExecution().optimizedPlan().toString()


def test_attributes_do_not_mention_the_text_of_a_document(spark):
    docs = spark.createDataFrame(
        [(1, None, {"a": "9", "b": "2", "c": "3"}, {"c": 1.5}), (None, "x", None, None)], "a int, b string, extra map<string,string>, chirp map<string,double>")
    made = docs.select(document_json(docs).alias("value"))
    assert [json.loads(r.value) for r in made.collect()] == [{"a": 1, "b": 2, "c": 1.5}, {"b": "x"}]
    assert "json_object_keys" not in plan(made) and plan(made).count("StructsToJsonEvaluator") == 3


def test_offline_texts_are_made_once(spark, tmp_path, monkeypatch):
    calls = spark.sparkContext.accumulator(0)

    def counted(docs):
        count = F.udf(lambda text: (calls.add(1), text)[1], "string")
        return count(F.col("GlobalJobId"))

    monkeypatch.setattr(runs, "document_json", counted)
    lines = runs.convert_offline(ads_of(base(spark, 40)), str(tmp_path / "docs"), LAUNCH_TIME)
    assert calls.value == lines.count() > 0


def test_capped_runs_rank_narrow_rows(spark, tmp_path):
    config = RunConfig(launch_time=LAUNCH_TIME, max_documents=3, read_only=True, history_minutes=39 * 24 * 60, work_path=str(tmp_path / "work"))
    docs = run(spark, ads_of(base(spark, 300)), None, config)["history"]
    found = docs.groupBy("ScheddName").agg(F.count("*").alias("n"), F.max("EnteredCurrentStatus").alias("newest")).collect()
    assert {r.n for r in found} == {4} and len(found) == 7
    kept = spark.read.parquet(str(tmp_path / "work/history-first"))
    assert kept.columns == [runs._ROW] and kept.count() == 28
    assert "Window" not in plan(docs)


def test_queries_deal_narrow_rows(spark, sf):
    assert queries._dealt_base(spark, sf).rdd.getNumPartitions() >= 3 * spark.sparkContext.defaultParallelism


def test_documents_are_walked_once(spark):
    rows = [("1", '{"a":{"b":1},"c":[1,"x"]}'), ("1", '{"a":{},"c":[1]}'), ("2", None), ("3", "no json")]
    docs = spark.createDataFrame(rows, "doc_id string, document string")
    known = schema.infer_schema(docs.limit(1))
    assert "isnotnull(transform" not in plan(known) and plan(known).count("from_json") == 1
    found = schema.nested_violations(docs, known)
    assert {tuple(r) for r in found.collect()} == {("1", "a.b", "missing_nested_key")}
    assert plan(found).count("from_json") == 1
    mistaken = schema.nested_violations(docs.selectExpr("doc_id", """'{"a":[],"c":["y"],"d":{"e":1}}' AS document"""), known)
    assert {(r.path, r.violation) for r in mistaken.collect()} == {("a", "incorrect_type"), ("d", "unknown_key")}


def test_messages_are_stored_compressed(spark, tmp_path, monkeypatch):
    monkeypatch.setitem(sinks.LINES, "maxRecordsPerFile", 40)
    messages = spark.range(100).selectExpr("CAST(id AS STRING) AS key", "repeat('x', 50) AS value").coalesce(1)
    sinks.write_messages(messages, str(tmp_path), 1)
    assert sorted(spark.read.json(str(tmp_path)).select("key", "value").collect()) == sorted(messages.collect())
    assert len(list(tmp_path.rglob("part-*.json.gz"))) == 3 and not list(tmp_path.rglob("part-*.json"))


def test_large_runs_do_not_shuffle_documents_for_their_index(spark, tmp_path, monkeypatch):
    found, files = [], []
    for most in (runs.REBALANCED_ROWS, 10):
        monkeypatch.setattr(runs, "REBALANCED_ROWS", most)
        target = tmp_path / f"index-{most}"
        config = RunConfig(launch_time=LAUNCH_TIME, feed_index=True, index_paths=(str(target),), history_minutes=39 * 24 * 60)
        run(spark, ads_of(base(spark, 300).repartition(24)), None, config)
        found.append(sorted(sinks.read_index(spark, str(target)).select("doc_id", "idx_date", "Status", "CoreHr").collect()))
        files.append(len(list(target.rglob("part-*.parquet"))))
    assert found[0] == found[1] and len(found[0]) > 200
    assert files[0] == 1 < files[1]  # of one day, and one of each task


def test_many_replaced_rows_do_not_shuffle_documents(spark, tmp_path, monkeypatch):
    twice = base(spark, 300).unionByName(base(spark, 100)).repartition(5)
    config = RunConfig(launch_time=LAUNCH_TIME, read_only=True, history_minutes=39 * 24 * 60, max_documents=40)
    names, found = ["doc_id", "Status", "CoreHr"], []
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        for most in (runs.BROADCAST_ROWS, 0):
            monkeypatch.setattr(runs, "BROADCAST_ROWS", most)
            config = replace(config, work_path=str(tmp_path / f"work-{most}"))
            docs = run(spark, ads_of(twice), None, config)["history"]
            assert "hashpartitioning" not in docs._jdf.queryExecution().executedPlan().toString()
            found.append(sorted(docs.select(names).collect()))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert found[0] == found[1] and len(found[0]) == len({r.doc_id for r in found[0]}) > 150
    assert spark.read.parquet(str(tmp_path / "work-0/history-replaced")).count() > 20
    assert spark.read.parquet(str(tmp_path / "work-0/history-first")).count() > len(found[0])


def test_offline_documents_are_compressed_and_nothing_else_is_stored(spark, tmp_path, monkeypatch):
    asked = []
    monkeypatch.setattr(runs, "scratch_path", lambda _, label: asked.append(label) or str(tmp_path / "scratch"))
    ads = ads_of(base(spark, 20)).withColumn("JobStatus", F.when(F.col("event_id") % 4 > 0, F.col("JobStatus")))
    lines = runs.convert_offline(ads, str(tmp_path / "docs"), LAUNCH_TIME)
    numbers = sorted(int(json.loads(r.value)["GlobalJobId"].split("#")[1].split(".")[0]) for r in lines.collect())
    assert numbers == [n for n in range(20) if n % 4 > 0 and n != 5]  # 5 is a root task
    assert not asked and not list((tmp_path / "docs").glob("part-*.txt")) and list((tmp_path / "docs").glob("part-*.txt.gz"))
