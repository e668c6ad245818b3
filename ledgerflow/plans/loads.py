"""Extract, transform, load and validate one entity, repeatably.

Each run reads its source once, writes its rows into a folder of its own, checks them as
read back, and then commits: one row, in a path that one run only can write, names the
folders, their schemas and the new high-water mark. Readers take committed folders only,
so a run that dies or fails leaves nothing to be seen, and nothing that was published is
ever deleted or rewritten. A run with the time stamp of an earlier one extracts what that
one did and takes its place. The latest row of each key is picked on reading.
"""

import json
import logging
import re
import threading
import time
from collections.abc import Callable, Iterable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor, wait
from dataclasses import dataclass, field
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession, functions as F
from pyspark.sql.types import StringType, StructField, StructType

from ledgerflow.functions.dates import as_timestamp
from ledgerflow.operators.checks import (
    LOSSY, MISSING, apply_standard_checks, conform, has_null, latest_per_key, lossy_cast, named,
    rejected_rows, require_schema,
)
from ledgerflow.operators.currency import missing_rates
from ledgerflow.operators.evolution import SchemaChanged, changed_types, merged_schema, read_folders
from ledgerflow.operators.merge import unknown_rows
from ledgerflow.operators.quality import quality_report
from ledgerflow.plans.account import transform_account_data
from ledgerflow.plans.customer import transform_customer_data, with_vip
from ledgerflow.plans.incremental import (
    SequenceTaken, changed_since, commit_path, live_commits, read_marks, update_watermark,
)
from ledgerflow.schemas import (
    ACCOUNT, ACCOUNT_KEYS, ACCOUNT_REQUIRED, CUSTOMER, CUSTOMER_KEYS, CUSTOMER_REQUIRED, WATERMARK,
)
from ledgerflow.sinks.lake import write_parquet
from ledgerflow.sources.lake import lake_path
from ledgerflow.sources.paths import exists, remove

log = logging.getLogger(__name__)

DAY = "ingestion_date"
STAMP = "ingestion_timestamp"
WATERMARKS = "banking/metadata/watermarks"
REJECTED = "banking/rejected"
DIGESTS = "banking/metadata/digests"
GRACE = 60  # seconds that a commit path without a mark is waited for


class ValidationFailed(RuntimeError):
    """Loaded rows failed a check; they were not committed."""


@dataclass(frozen=True)
class Load:
    """What one entity needs; everything else is the same for all.

    ``source`` builds a lazy scan with the source's own names and types.
    ``transform`` takes the rows in ``schema``, the run's timestamp and the tables
    named in ``sides``, and adds an ``ingestion_timestamp``. The side tables are read
    once a run and written to shared storage. ``facts`` takes the loaded rows and the
    side tables and returns further numbers for the report.

    With ``changed_only`` a batch holds only rows whose contents are not those that were
    committed last for their key and change date, so reading a day again writes nothing
    again, and a batch may be empty. ``lookback_days`` before the mark are extracted as
    well, for rows that arrive late; it goes with ``changed_only``, or those days' rows
    are written with each batch.

    ``most_rejected`` is the share of the extracted rows that may be left out. With
    ``check_table`` the latest rows of all batches are checked as well. With
    ``raise_on_failure`` off a failed check is only logged: the rows are committed,
    the high-water mark stays.
    """

    entity: str
    path: str
    schema: StructType
    keys: Sequence[str]
    required: Sequence[str]
    source: Callable[[], DataFrame]
    transform: Callable[..., DataFrame]
    updated: str = "last_updated"
    max_age_hours: int = 24
    raise_on_failure: bool = True
    most_rejected: float = 1.0
    check_table: bool = False
    changed_only: bool = False
    lookback_days: int = 0
    sides: Mapping[str, Callable[[], DataFrame]] = field(default_factory=dict)
    facts: Callable[..., dict] | None = None


def customer_load(source: Callable[[], DataFrame], as_of=None, path="banking/customers") -> Load:
    """``as_of`` defaults to the day of the run, as for accounts."""
    def transform(raw, stamp):
        today = day_of(stamp) if as_of is None else as_of
        return with_vip(transform_customer_data(raw, today, stamp))

    return Load("customers", path, CUSTOMER, CUSTOMER_KEYS, CUSTOMER_REQUIRED, source, transform)


def account_load(
    source: Callable[[], DataFrame],
    exchange_rates: Callable[[], DataFrame],
    as_of=None,
    path="banking/accounts",
) -> Load:
    """The report counts the foreign balances that no dollar quote converts."""
    def transform(raw, stamp, rates):
        today = day_of(stamp) if as_of is None else as_of
        return transform_account_data(raw, rates, today, stamp)

    def facts(rows, rates):
        return {"missing_rates": missing_rates(rows, rates).count()}

    return Load(
        "accounts", path, ACCOUNT, ACCOUNT_KEYS, ACCOUNT_REQUIRED, source, transform,
        sides={"rates": exchange_rates}, facts=facts,
    )


def transaction_load(
    source: Callable[[], DataFrame],
    schema: StructType,
    keys: Sequence[str],
    required: Sequence[str],
    updated: str,
    transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    path="banking/transactions",
) -> Load:
    """The caller brings schema, keys and columns; only the row checks are added."""
    def checked(raw, stamp):
        rows = require_schema(raw, schema, "transaction")
        rows = apply_standard_checks(rows, keys, required, updated)
        return transform(rows).withColumn(STAMP, as_timestamp(stamp))

    return Load("transactions", path, schema, keys, required, source, checked, updated)


def day_of(stamp: str) -> str:
    return stamp[:10]


def batch_of(stamp: str) -> str:
    """Names a run; in the order of the stamps."""
    return re.sub(r"\D", "", stamp).ljust(20, "0")


def staging(spark: SparkSession, base_uri: str) -> str:
    """The folder on shared storage for what a run needs on its way."""
    return (spark.conf.get("spark.checkpoint.dir", None) or lake_path(base_uri, "banking/staging")).rstrip("/")


def stage(spark: SparkSession, rows: DataFrame, path: str) -> DataFrame:
    """Rows written to and read back from shared storage."""
    rows.write.parquet(path)
    return spark.read.schema(rows.schema).parquet(path)


def _live(spark: SparkSession, base_uri: str, entity: str) -> DataFrame | None:
    """The commits of an entity that hold, or ``None`` before any mark was written."""
    table = read_marks(spark, lake_path(base_uri, WATERMARKS))
    return None if table is None else live_commits(table.filter(F.col("entity") == entity))


def _folders(
    spark: SparkSession, base_uri: str, entity: str, folder: str, schema: str | None, where: str = "true",
) -> list[tuple[str, str | None]]:
    """Paths and schemas that commits name, in the order of their batches; one a run."""
    live = _live(spark, base_uri, entity)
    if live is None:
        return []
    named_ = F.col(schema) if schema else F.lit(None).cast("string")
    rows = live.filter(f"{folder} IS NOT NULL").filter(where).select("batch", F.col(folder).alias("folder"), named_.alias("schema")).sort("batch").collect()
    return [(lake_path(base_uri, row["folder"]), row["schema"]) for row in rows]


def committed(spark: SparkSession, base_uri: str, entity: str, path: str, where: str = "true") -> DataFrame | None:
    """All committed rows with their ingestion day, or ``None`` before the first commit.

    Batches may have unlike columns: the table has those of all, null where a batch has
    none. ``where`` picks commits. The driver reads the names of the committed folders, one a run.
    """
    folders = _folders(spark, base_uri, entity, "folder", "schema", where)
    if not folders:
        return None
    return read_folders(spark, lake_path(base_uri, path), folders).drop("batch")


def read_table(spark: SparkSession, base_uri: str, load: Load) -> DataFrame:
    """The committed rows of a load, or ``LookupError`` before its first commit."""
    table = committed(spark, base_uri, load.entity, load.path)
    if table is None:
        raise LookupError(f"nothing is committed for {load.entity}")
    return table


def read_rejected(spark: SparkSession, base_uri: str, entity: str) -> DataFrame | None:
    """What the committed runs of an entity left out, with reasons; ``None`` if nothing.

    Rows are kept in the source's own types; a column that changed its type is text.
    """
    folders = _folders(spark, base_uri, entity, "rejected_folder", "rejected_schema")
    if not folders:
        return None
    return read_folders(spark, lake_path(base_uri, f"{REJECTED}/{entity}"), folders, as_text=True)


def current_report(table: DataFrame, load: Load, stamp: str) -> DataFrame:
    """The checks over the latest rows of all batches, one row."""
    return quality_report(
        current_rows(table, load.keys, load.updated), load.keys, load.required, STAMP,
        load.max_age_hours, stamp, load.updated,
    )


OUTCOME = "_outcome"
SOUND = "sound"


def routed(given: DataFrame, load: Load) -> DataFrame:
    """The extracted rows with what becomes of each, as far as the row itself says."""
    lossy, missing = lossy_cast(given, load.schema), has_null(load.required)
    return given.withColumn(OUTCOME, F.when(lossy, LOSSY).when(missing, MISSING).otherwise(SOUND))


def left_out(extracted: DataFrame, load: Load, not_latest: bool) -> DataFrame:
    """The extracted rows that a load leaves out, in the source's own types, with reasons.

    Those known row by row come from their own folders. Those that aren't the latest of
    their key are the sound rows minus the kept ones.
    """
    names = [c for c in extracted.columns if c != OUTCOME]
    alone = extracted.filter(F.col(OUTCOME) != SOUND).withColumnRenamed(OUTCOME, "reason")
    out = alone.groupBy(*names, "reason").agg(F.count(F.lit(1)).alias("copies"))
    if not_latest:
        sound = extracted.filter(F.col(OUTCOME) == SOUND).select(*names)
        out = rejected_rows(sound, load.keys, [], load.updated).unionByName(out)
    return out


def _begun(spark: SparkSession, base_uri: str, entity: str, batch: str) -> dict:
    """What a run has to know of earlier ones: the mark, its own place, the table's columns."""
    table = read_marks(spark, lake_path(base_uri, WATERMARKS))
    if table is None:
        return {"mark": None, "sequence": 1, "schema": StructType(), "again": False}
    last = F.max_by(F.struct("high_water", "schema"), F.coalesce("attempt", F.lit(0)))
    batches = table.filter(F.col("entity") == entity).groupBy("batch").agg(
        last.alias("last"), F.max("high_water").alias("mark"), F.max("sequence").alias("sequence"))
    own, mark = F.col("batch") == batch, F.when(F.col("batch").isNull(), F.col("mark")).otherwise(F.col("last.high_water"))
    found = batches.agg(
        F.coalesce(F.max(own), F.lit(False)).alias("again"),
        F.max(mark).cast("string").alias("mark"),
        F.max(F.when(F.col("batch").isNull() | (F.col("batch") < batch), mark)).cast("string").alias("before"),
        F.coalesce(F.max("sequence"), F.lit(0)).alias("sequence"),
        F.collect_set(F.when(~own, F.col("last.schema"))).alias("schemas"),
    ).first()
    return {
        "mark": found["before"] if found["again"] else found["mark"], "sequence": found["sequence"] + 1,
        "schema": merged_schema([StructType.fromJson(json.loads(schema)) for schema in found["schemas"]]), "again": found["again"],
    }


def _free_sequence(spark: SparkSession, base_uri: str, entity: str, sequence: int) -> int:
    """``sequence``, or the next one whose path no run that died has left without a mark.

    A path without a mark may be one that a living run is writing now; it gets GRACE seconds.
    """
    own = commit_path(lake_path(base_uri, WATERMARKS), entity, sequence)
    until = time.monotonic() + GRACE
    while exists(spark, own):
        if spark.read.schema(WATERMARK).parquet(own).count():
            raise SequenceTaken(own)
        if time.monotonic() >= until:
            return _free_sequence(spark, base_uri, entity, sequence + 1)
        time.sleep(1)
    return sequence


def run_load(
    spark: SparkSession, load: Load, base_uri: str, ingested_at: str | None = None
) -> Row:
    """Run one load and return its quality report.

    ``ingested_at`` ("yyyy-MM-dd HH:mm:ss", session time zone) is taken once
    per run, so a run crossing midnight stays within one day's partition.

    The source is read once, into a table on shared storage with a folder for each
    outcome that a row shows by itself: sound, a null in a required column, a value that its
    declared type can't hold. Loaded and rejected rows, and all counts, come from that table,
    so they agree whatever the source does meanwhile. The table is removed at the end.

    Two runs of one entity may overlap. Commits are numbered, and the path of each
    number can be written once; the run that finds its number taken starts again from the
    new mark. Each number's write is preceded by a look for its path; on a file system
    where two writers can both find nothing, runs of one entity have to be kept apart.
    """
    stamp = ingested_at or spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]
    while True:
        try:
            return _run(spark, load, base_uri, stamp)
        except SequenceTaken:
            log.warning("%s: another run committed first; starting again", load.entity)


def _run(spark: SparkSession, load: Load, base_uri: str, stamp: str) -> Row:
    day, batch = day_of(stamp), batch_of(stamp)
    attempt = time.time_ns()
    name = f"{batch}-{attempt}"
    folder = f"{load.path}/{DAY}={day}/batch={name}"
    commits = lake_path(base_uri, WATERMARKS)
    begun = _begun(spark, base_uri, load.entity, batch)
    sequence = _free_sequence(spark, base_uri, load.entity, begun["sequence"])

    mark = begun["mark"]
    log.info("%s: %s", load.entity, f"changes since {mark}" if mark else "full load")
    given = changed_since(named(load.source(), load.schema, load.entity), load.updated, mark, load.lookback_days)
    scratch = f"{staging(spark, base_uri)}/{load.entity}-load-{name}"
    try:
        routed(given, load).write.partitionBy(OUTCOME).parquet(f"{scratch}/all")
        extracted = spark.read.schema(StructType([*given.schema, StructField(OUTCOME, StringType())])).parquet(f"{scratch}/all")
        seen = {row[OUTCOME]: row["count"] for row in extracted.groupBy(OUTCOME).count().collect()}
        counts = {"source_rows": sum(seen.values()), "rejected_lossy": seen.get(LOSSY, 0), "rejected_missing": seen.get(MISSING, 0)}
        sides = {side: stage(spark, build(), f"{scratch}/side-{side}") for side, build in load.sides.items()}
        sound = conform(extracted.filter(F.col(OUTCOME) == SOUND).drop(OUTCOME), load.schema)
        digest_folder, unchanged = None, 0
        if load.changed_only:
            digest_folder = f"{DIGESTS}/{load.entity}/batch={name}"
            sound, unchanged = _changed(spark, load, base_uri, sound, digest_folder, f"{scratch}/kept", batch if begun["again"] else None)
        rows = load.transform(sound, stamp, **sides)
        if changed := changed_types(begun["schema"], rows.schema):
            raise SchemaChanged(f"{load.entity}: columns of another type than in committed batches: {', '.join(changed)}")
        write_parquet(rows, base_uri, folder, mode="errorifexists")
        written = spark.read.schema(rows.schema).parquet(lake_path(base_uri, folder))

        report = quality_report(
            written, load.keys, load.required, STAMP, load.max_age_hours, stamp, load.updated
        ).withColumn("high_water", F.col("high_water").cast("string")).first().asDict()
        rest = seen.get(SOUND, 0) - unchanged - report["row_count"]
        report |= counts | {"rejected_not_latest": rest, "unchanged": unchanged}
        if unchanged and not report["row_count"]:
            report |= {"passed": True, "is_fresh": True}  # the source was read, and nothing is new
        if load.facts:
            report |= load.facts(written, **sides)
        rejected = counts["source_rows"] - unchanged - report["row_count"]
        rejected_folder = rejected_schema = None
        if rejected:
            log.warning(
                "%s: %d of %d rows rejected: %d with nulls, %d not the latest of their key, %d with values of another type",
                load.entity, rejected, counts["source_rows"], counts["rejected_missing"], rest, counts["rejected_lossy"],
            )
            rejected_folder = f"{REJECTED}/{load.entity}/batch={name}"
            out = left_out(extracted, load, rest > 0)
            write_parquet(out, base_uri, rejected_folder, mode="errorifexists")
            rejected_schema = out.schema.json()
    finally:
        remove(spark, scratch)
    report["passed"] = report["passed"] and rejected <= load.most_rejected * counts["source_rows"]
    if load.check_table:
        earlier = committed(spark, base_uri, load.entity, load.path)
        both = written if earlier is None else earlier.drop(DAY).unionByName(written, allowMissingColumns=True)
        table = current_report(both, load, stamp).first()
        report |= {"table_rows": table["row_count"], "table_null_cells": table["null_cells"]}
        report["passed"] = report["passed"] and table["passed"]
    if not report["passed"]:
        log.warning(
            "%s: %d duplicate rows, %d nulls in required columns, fresh: %s",
            load.entity, report["duplicate_rows"], report["null_cells"], report["is_fresh"],
        )
        if load.raise_on_failure:
            where = f"; what it rejected is in {rejected_folder}" if rejected else ""
            raise ValidationFailed(f"{load.entity}: rows of {stamp} failed their checks{where}")
    update_watermark(
        spark, commits, load.entity, report["high_water"] if report["passed"] else None, stamp,
        sequence=sequence, batch=batch, attempt=attempt, folder=folder, schema=rows.schema.json(),
        row_count=report["row_count"], **counts, rejected_not_latest=rest, unchanged=unchanged,
        rejected_folder=rejected_folder, rejected_schema=rejected_schema, digest_folder=digest_folder,
    )
    return Row(**report)


DIGEST = "_digest"


def _changed(spark: SparkSession, load: Load, base_uri: str, sound: DataFrame, folder: str, scratch: str, before: str | None):
    """The latest row of each key where its contents are new, and how many are not.

    A row is known where the last batch that committed its key with its change date committed
    the same contents. Digests are kept in tables of their own: key, change date, digest.
    """
    kept = apply_standard_checks(sound, load.keys, load.required, load.updated)
    text = F.to_json(F.struct(*(F.col(c) for c in kept.columns)))
    kept = kept.withColumn(DIGEST, F.unhex(F.sha2(text, 256)))
    own = list(dict.fromkeys([*load.keys, load.updated]))
    kept = stage(spark, kept, f"{scratch}/all")
    new = kept
    where = "true" if before is None else f"batch < '{before}'"
    folders = _folders(spark, base_uri, load.entity, "digest_folder", None, where)
    if folders:
        kind = StructType([kept.schema[c] for c in (*own, DIGEST)])
        known = spark.read.schema(kind.add("batch", "string")).option("basePath", lake_path(base_uri, f"{DIGESTS}/{load.entity}")).parquet(*(path for path, _ in folders))
        new = unknown_rows(kept, known, own, DIGEST, "batch")
    new = stage(spark, new, f"{scratch}/new")
    write_parquet(new.select(*own, DIGEST), base_uri, folder, mode="errorifexists")
    return new.drop(DIGEST), kept.count() - new.count()


def _commit_of(spark: SparkSession, base_uri: str, entity: str, batch: str) -> Row | None:
    live = _live(spark, base_uri, entity)
    return None if live is None else live.filter(F.col("batch") == batch).first()


def run_all(
    spark: SparkSession, loads: Iterable[Load], base_uri: str, ingested_at: str | None = None,
    at_once: int = 1, skip_committed: bool = False,
) -> dict[str, Row]:
    """All loads, ``at_once`` of them side by side; the first failure stops the rest.

    Loads that wait are not begun after a failure, and the jobs of those that run are
    cancelled by their tag; what they had not committed is not seen, and the first
    failure is raised once all have ended. With ``skip_committed`` an entity that has a
    commit of this time stamp is left as it is, and its commit row stands for its report: so a
    run that failed is repeated for the entities that failed.
    """
    stamp = ingested_at or spark.sql("SELECT CAST(current_timestamp() AS STRING)").first()[0]
    tag = f"ledgerflow-loads-{uuid4().hex}"
    context = spark.sparkContext
    stop = threading.Event()
    failures: list[BaseException] = []

    def one(load: Load) -> Row | None:
        if stop.is_set():
            return None
        context.addJobTag(tag)
        context.setInterruptOnCancel(True)
        try:
            done = _commit_of(spark, base_uri, load.entity, batch_of(stamp)) if skip_committed else None
            return done or run_load(spark, load, base_uri, stamp)
        except BaseException as error:
            if not stop.is_set():
                failures.append(error)
                stop.set()
                log.error("%s failed; stopping the other loads", load.entity)
                context.cancelJobsWithTag(tag)
            raise
        finally:
            context.removeJobTag(tag)

    every = list(loads)
    with ThreadPoolExecutor(max_workers=max(1, at_once)) as pool:
        running = [(load.entity, pool.submit(inheritable_thread_target(spark)(one), load)) for load in every]
        wait([future for _, future in running])
    if failures:
        raise failures[0]
    return {entity: future.result() for entity, future in running}


def current_rows(table: DataFrame, keys: Sequence[str], updated: str = "last_updated") -> DataFrame:
    """Latest row of each key over all batches; of equally new ones, that of the last run."""
    return latest_per_key(table, keys, [updated, STAMP])
