"""An index whose documents are replaced when they are written, so that readers need no shuffle.

Days are split into buckets by document id. A write reads the buckets that its documents fall into, merges, and writes these buckets
anew into a folder of its own; nothing that is referred to is ever overwritten. The *snapshot* is one small table that names the
folder of every bucket. It is written last: until then readers see the old state, and a write that broke off leaves folders that
no snapshot names, which its repetition replaces.

Writes of one index follow one another (as feeds of a run do). Two that overlap are noticed: the second finds its snapshot taken.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.utils import AnalysisException

from poolscope.operators.dedupe import first_per_key

#: Buckets of a day; a bucket should be some hundred MB at most.
BUCKETS = 16
_PARTS = ["idx_date", "bucket"]


def _snapshots(path: str) -> str:
    return f"{path}/snapshots"


def current_snapshot(spark: SparkSession, path: str) -> tuple[int, DataFrame | None]:
    """Number of the newest snapshot and its rows (``idx_date``, ``bucket``, ``folder``); 0 and nothing of a new index."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    place = hadoop.Path(f"{_snapshots(path)}/snapshot=*/*.parquet")
    files = place.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(place) or []
    newest = max((int(f.getPath().getParent().getName().removeprefix("snapshot=")) for f in files), default=0)
    if not newest:
        return 0, None
    return newest, spark.read.schema("idx_date date, bucket int, folder string").parquet(f"{_snapshots(path)}/snapshot={newest}")


def _read_buckets(spark: SparkSession, path: str, wanted: DataFrame) -> DataFrame | None:
    """Documents of the buckets that snapshot rows name: a plain scan of their folders."""
    folders = [f"{path}/{r.folder}/idx_date={r.idx_date}/bucket={r.bucket}" for r in wanted.collect()]  # days x buckets
    if not folders:
        return None
    read = spark.read.option("basePath", path).option("mergeSchema", "true").parquet(*folders)
    return read.drop("version")


def upsert(
    docs: DataFrame, path: str, batch: int, feed: str = "run", written: int | None = None, buckets: int = BUCKETS
) -> int:
    """Replace documents by id with the routed ``docs`` of one batch; returns the number of the snapshot.

    ``written`` (default: the batch number) orders batches of all feeds: of the copies of a document the last written stays, so a late or repeated
    older batch replaces nothing newer. Only buckets with new documents are read and written.
    """
    spark = docs.sparkSession
    number, before = current_snapshot(spark, path)
    time = F.lit(batch if written is None else written).cast("bigint")
    new = docs.withColumns({
        "written": time, "feed": F.lit(feed), "batch": F.lit(batch).cast("bigint"),
        "idx_date": F.col("idx_date").cast("date"),
        "bucket": F.pmod(F.xxhash64("doc_id"), F.lit(buckets)).cast("int")})
    rows = new
    if before is not None:
        # a row per day and bucket that the batch touches
        touched = new.select(*_PARTS).distinct()
        old = _read_buckets(spark, path, before.join(F.broadcast(touched), _PARTS, "left_semi"))
        if old is not None:
            rows = new.unionByName(old, allowMissingColumns=True)
    merged = first_per_key(rows, ["idx_date", "bucket", "doc_id"], [F.desc("written"), F.asc("feed"), F.desc("batch")])
    folder = f"version={number + 1}"
    merged.hint("rebalance", *_PARTS).write.mode("overwrite").partitionBy(*_PARTS).parquet(f"{path}/{folder}")
    _commit(spark, path, number, before, folder)
    return number + 1


def _commit(spark: SparkSession, path: str, number: int, before: DataFrame | None, folder: str) -> None:
    """Name the written buckets in a new snapshot; one that exists already is another writer's."""
    try:
        written = spark.read.option("basePath", f"{path}/{folder}").parquet(f"{path}/{folder}").select(*_PARTS).distinct()
    except AnalysisException:  # a batch without documents writes no bucket
        written = spark.createDataFrame([], "idx_date date, bucket int")
    rows = written.select(F.col("idx_date").cast("date").alias("idx_date"), F.col("bucket").cast("int").alias("bucket"), F.lit(folder).alias("folder"))
    if before is not None:
        rows = before.join(F.broadcast(rows), _PARTS, "left_anti").unionByName(rows)
    rows.coalesce(1).write.mode("errorifexists").parquet(f"{_snapshots(path)}/snapshot={number + 1}")


def read_current(spark: SparkSession, path: str, first_day: str | None = None, last_day: str | None = None) -> DataFrame | None:
    """Current documents of an index, of a range of days: scans without an exchange. None of an index without documents."""
    _, snapshot = current_snapshot(spark, path)
    if snapshot is None:
        return None
    if first_day is not None:
        snapshot = snapshot.filter(F.col("idx_date") >= F.lit(first_day).cast("date"))
    if last_day is not None:
        snapshot = snapshot.filter(F.col("idx_date") <= F.lit(last_day).cast("date"))
    found = _read_buckets(spark, path, snapshot)
    return None if found is None else found.drop("bucket")


def remove_unused(spark: SparkSession, path: str) -> list[str]:
    """Delete bucket folders that the newest snapshot does not name, and older snapshots; returns what went.

    Not to be called while others still read an older snapshot.
    """
    number, snapshot = current_snapshot(spark, path)
    if snapshot is None:
        return []
    used = {f"{r.folder}/idx_date={r.idx_date}/bucket={r.bucket}" for r in snapshot.collect()}
    hadoop, conf = spark._jvm.org.apache.hadoop.fs, spark._jsc.hadoopConfiguration()
    root = hadoop.Path(path)
    files = root.getFileSystem(conf)
    stored = files.globStatus(hadoop.Path(f"{path}/version=*/idx_date=*/bucket=*")) or []
    kept = files.makeQualified(root).toString().rstrip("/") + "/"
    gone = [name for s in stored if (name := s.getPath().toString().removeprefix(kept)) not in used]
    old = files.globStatus(hadoop.Path(f"{_snapshots(path)}/snapshot=*")) or []
    gone += [f"snapshots/{s.getPath().getName()}" for s in old if s.getPath().getName() != f"snapshot={number}"]
    for name in gone:
        files.delete(hadoop.Path(f"{path}/{name}"), True)
    return sorted(gone)
