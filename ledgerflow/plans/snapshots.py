"""The latest row of each key, kept ready in folders by the hash of the key.

A snapshot holds the latest rows of all batches up to one. The next one rewrites only the
buckets that later batches have keys of; its commit names the folders of the others
as they are. A reader takes the snapshot's rows as they lie, without a shuffle, and ranks
only the keys of later batches. Reading all batches instead costs as much as the
table has history.
"""

import time
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession, functions as F

from ledgerflow.operators.checks import latest_per_key
from ledgerflow.operators.evolution import merged_schema, read_folders, shaped
from ledgerflow.operators.merge import merge_latest
from ledgerflow.plans.incremental import SequenceTaken, commit_path, live_commits, read_if_present, read_marks
from ledgerflow.plans.loads import DAY, STAMP, WATERMARKS, Load, committed, current_rows, read_table
from ledgerflow.schemas import SNAPSHOT
from ledgerflow.sinks.lake import write_parquet
from ledgerflow.sources.lake import lake_path
from ledgerflow.sources.paths import exists

SNAPSHOTS = "banking/snapshots"
COMMITS = "banking/metadata/snapshots"
BUCKETS = 64
BUCKET = "_bucket"


def bucket_of(load: Load, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*load.keys), F.lit(buckets)).cast("int")


def _batches(spark: SparkSession, load: Load, base_uri: str, upto: str) -> str:
    """A digest of the committed attempts up to a batch: another one where any was replaced."""
    marks = read_marks(spark, lake_path(base_uri, WATERMARKS)).filter(F.col("entity") == load.entity)
    live = live_commits(marks).filter((F.col("batch") <= upto) & F.col("folder").isNotNull())
    names = F.array_sort(F.collect_list(F.concat_ws("-", "batch", F.col("attempt").cast("string"))))
    return live.agg(F.sha2(F.concat_ws(",", names), 256).alias("batches")).first()["batches"]


def _upto(spark: SparkSession, load: Load, base_uri: str) -> str | None:
    """The last committed batch."""
    table = read_marks(spark, lake_path(base_uri, WATERMARKS))
    if table is None:
        return None
    live = live_commits(table.filter(F.col("entity") == load.entity)).filter("folder IS NOT NULL")
    return live.agg(F.max("batch").alias("upto")).first()["upto"]


def _last(spark: SparkSession, load: Load, base_uri: str) -> Row | None:
    """The newest snapshot of which no batch has been replaced since."""
    table = read_if_present(spark, lake_path(base_uri, COMMITS), SNAPSHOT, recursiveFileLookup="true")
    if table is None:
        return None
    own = table.filter(F.col("entity") == load.entity)
    for row in own.select("sequence", "upto", "batches").sort(F.desc("sequence")).toLocalIterator():
        if row["batches"] == _batches(spark, load, base_uri, row["upto"]):
            return own.filter(F.col("sequence") == row["sequence"]).first()
    return None


def _next_sequence(spark: SparkSession, load: Load, base_uri: str) -> int:
    table = read_if_present(spark, lake_path(base_uri, COMMITS), SNAPSHOT, recursiveFileLookup="true")
    last = None if table is None else table.filter(F.col("entity") == load.entity).agg(F.max("sequence").alias("n")).first()["n"]
    return (last or 0) + 1


def _stored(spark: SparkSession, load: Load, base_uri: str, folders) -> DataFrame:
    """Rows of some of a snapshot's folders, with their bucket."""
    base = lake_path(base_uri, f"{SNAPSHOTS}/{load.entity}")
    return read_folders(spark, base, [(lake_path(base_uri, f["folder"]), f["schema"]) for f in folders]).drop("snapshot")


def _together(frames: list[DataFrame]) -> list[DataFrame]:
    """The frames with the columns of all."""
    whole = merged_schema([frame.schema for frame in frames])
    return [shaped(frame, whole) for frame in frames]


def take_snapshot(spark: SparkSession, load: Load, base_uri: str, buckets: int = BUCKETS) -> list[int] | None:
    """Bring the snapshot up to the last committed batch; the buckets that were written, or ``None`` if none.

    The number of buckets is that of the first snapshot. Of two snapshots taken at the same
    time one ends in ``SequenceTaken``. Where a batch that a snapshot holds was run
    again since, the newest snapshot before it is the base, or the whole table.
    """
    last = _last(spark, load, base_uri)
    sequence = _next_sequence(spark, load, base_uri)
    upto = _upto(spark, load, base_uri)
    if upto is None or (last and upto <= last["upto"]):
        return None
    batches = _batches(spark, load, base_uri, upto)
    later = committed(spark, base_uri, load.entity, load.path, f"batch <= '{upto}'" + (f" AND batch > '{last['upto']}'" if last else ""))
    buckets = last["buckets"] if last else buckets
    later = later.withColumn(BUCKET, bucket_of(load, buckets))
    touched = sorted(row[BUCKET] for row in later.select(BUCKET).distinct().collect())  # at most all buckets
    old = [f for f in last["folders"] if f["bucket"] in set(touched)] if last else []
    parts = _together([_stored(spark, load, base_uri, old), later]) if old else [later]
    rows = latest_per_key(reduce(DataFrame.unionByName, parts), load.keys, [load.updated, STAMP])
    folder = f"{SNAPSHOTS}/{load.entity}/snapshot={sequence}-{time.time_ns()}"
    write_parquet(rows, base_uri, folder, partition_by=[BUCKET], mode="errorifexists")

    schema = rows.drop(BUCKET).schema.json()
    kept = [f for f in last["folders"] if f["bucket"] not in set(touched)] if last else []
    folders = [(f["bucket"], f["folder"], f["schema"]) for f in kept] + [(k, f"{folder}/{BUCKET}={k}", schema) for k in touched]
    if batches != _batches(spark, load, base_uri, upto):  # a batch was run again meanwhile
        return take_snapshot(spark, load, base_uri, buckets)
    own = commit_path(lake_path(base_uri, COMMITS), load.entity, sequence)
    if exists(spark, own):
        raise SequenceTaken(own)
    commit = spark.createDataFrame([(load.entity, sequence, buckets, upto, batches, sorted(folders))], SNAPSHOT)
    commit.coalesce(1).write.mode("errorifexists").parquet(own)
    return touched


def read_current(spark: SparkSession, base_uri: str, load: Load) -> DataFrame:
    """The latest row of each key: those of the snapshot and of the batches after it.

    Without a snapshot all batches are ranked. Buckets without keys of later batches are read
    as they are. In the others the later batches' keys are broadcast where they measure small, so
    that rows of other keys aren't shuffled there either.
    """
    last = _last(spark, load, base_uri)
    if last is None:
        return current_rows(read_table(spark, base_uri, load), load.keys, load.updated)
    later = committed(spark, base_uri, load.entity, load.path, f"batch > '{last['upto']}'")
    if later is None:
        return _ordered(_stored(spark, load, base_uri, last["folders"]).drop(BUCKET))
    touched = {row[BUCKET] for row in later.select(bucket_of(load, last["buckets"]).alias(BUCKET)).distinct().collect()}
    beside = [f for f in last["folders"] if f["bucket"] not in touched]
    below = [f for f in last["folders"] if f["bucket"] in touched]
    frames = [later] + [_stored(spark, load, base_uri, part).drop(BUCKET) for part in (below, beside) if part]
    later, *stored = _together(frames)
    ready = stored.pop() if beside else None
    newest = [load.updated, STAMP]
    if below:
        later = merge_latest(stored[0], later, load.keys, newest)
    else:
        later = latest_per_key(later, load.keys, newest)
    return _ordered(later if ready is None else ready.unionByName(later))


def _ordered(rows: DataFrame) -> DataFrame:
    """The ingestion day last, as in the table."""
    return rows.select(*(c for c in rows.columns if c != DAY), DAY)
