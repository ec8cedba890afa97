"""Times the registered queries and the full document build; prints one JSON line.

BENCH_SF_DIR (tables, default sf0.1) and BENCH_CPUS (threads, default 8) choose the setting.
The tables are single files with one row group, which only one task can read, so they are first
copied to folders with one file per thread; large tables have many files anyway. Every query is
planned anew and written to the no-op sink; the best of two runs counts.
"""

from __future__ import annotations

import json
import os
import time

from poolscope.operators import select
from poolscope.operators.documents import build_documents
from poolscope.plans.queries import QUERIES
from poolscope.session import build_session, scratch_path
from poolscope.sources.samples import LAUNCH_TIME, sample_ads

HEADLINE = """
job_status_docs exit_code_summary core_hour_metrics site_locality campaign_workflow crab_ids post_job_states
software_and_identity benchmark_scores chirp_metrics chirp_site_reads untyped_attributes active_skim decoded_messages
history_select checkpoint_update capped_scan latest_docs repeated_run daily_index_counts index_bodies broker_messages
scheduler_counts quarantined_records json_records affiliation_join affiliation_join_shuffled pool_of_jobs
index_histogram series_histogram source_gaps schema_violations log_events missing_fields frequent_values
line_item_documents streamed_documents streamed_logs streamed_incremental streamed_index_histogram nested_violations
example_schema upserted_index sketched_jobs bunched_messages history_run queue_run run_then_state
""".split()


TABLES = "events lineitem customer nation supplier region documents".split()


def split_tables(spark, sf_dir: str, files: int) -> str:
    """Copy the tables to folders of several files; returns the new table folder."""
    target = scratch_path(spark, "tables")
    for name in TABLES:
        rows = spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
        rows.repartition(files).write.parquet(os.path.join(target, f"{name}.parquet"))
    return target


def timed(action) -> float:
    best = float("inf")
    for _ in range(2):
        start = time.perf_counter()
        action()
        best = min(best, time.perf_counter() - start)
    return round(best, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        f"local[{cpus}]",
        "poolscope-bench",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    scale = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    sf_dir = split_tables(spark, sf_dir, int(cpus))

    def sink(frame) -> None:
        frame.write.format("noop").mode("overwrite").save()

    timings = {name: timed(lambda: sink(QUERIES[name](spark, sf_dir))) for name in HEADLINE}

    rates = {}
    for source, maps in (("events", True), ("lineitem", False)):
        ads = select.monitored(sample_ads(spark, sf_dir, source, maps=maps))
        docs = build_documents(ads, LAUNCH_TIME)
        count = docs.count()
        seconds = timed(lambda: sink(docs))
        timings[f"full_documents_{source}"] = seconds
        rates[f"{source}_docs_per_sec"] = round(count / seconds)

    print(
        json.dumps(
            {
                "metric": "total_query_time",
                "value": round(sum(timings.values()), 3),
                "unit": "sec",
                "queries": timings,
                "rates": rates,
                "sf": scale,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
