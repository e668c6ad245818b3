"""High-water marks: how far each entity has been loaded."""

from datetime import datetime

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerflow.functions.dates import as_timestamp
from ledgerflow.schemas import WATERMARK
from ledgerflow.sources.paths import exists


class SequenceTaken(RuntimeError):
    """Another run of the entity committed first."""


def read_if_present(spark: SparkSession, path: str, schema, **options) -> DataFrame | None:
    """The Parquet table, or ``None`` where no such path exists.

    Any other failure is raised: taking an unreadable table for a missing one
    would load everything again.
    """
    if not exists(spark, path):
        return None
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.options(**options).parquet(path)


def read_marks(spark: SparkSession, path: str) -> DataFrame | None:
    """All marks: those appended to the table, and the commits, each in a folder of its own."""
    return read_if_present(spark, path, WATERMARK, recursiveFileLookup="true")


def live_commits(table: DataFrame) -> DataFrame:
    """Marks that hold: of the commits of one batch, the last attempt's only."""
    last = F.max_by(F.struct(*table.columns), "attempt").alias("last")
    commits = table.filter("batch IS NOT NULL").groupBy("entity", "batch").agg(last).select("last.*")
    return table.filter("batch IS NULL").unionByName(commits)


def high_waters(table: DataFrame) -> DataFrame:
    """The greatest mark of each entity."""
    return live_commits(table).groupBy("entity").agg(F.max("high_water").alias("high_water"))


def read_watermark(spark: SparkSession, path: str, entity: str, before: str | None = None) -> str | None:
    """Mark of ``entity`` as text in the session time zone; ``None`` for a first load.

    With ``before`` only the marks of earlier batches count, so that a batch that
    runs again extracts what it did the first time.
    """
    table = read_marks(spark, path)
    if table is None:
        return None
    marks = live_commits(table.filter(F.col("entity") == entity))
    if before is not None:
        marks = marks.filter(F.col("batch").isNull() | (F.col("batch") < before))
    mark = F.max("high_water").cast("string").alias("mark")
    return marks.agg(mark).first()["mark"]


def commit_path(path: str, entity: str, sequence: int) -> str:
    return f"{path}/{entity}-{sequence:09d}"


def update_watermark(
    spark: SparkSession,
    path: str,
    entity: str,
    high_water: datetime | str | None,
    updated_at: datetime | str | None = None,
    sequence: int | None = None,
    **facts,
) -> None:
    """Append one mark. Readers take the greatest, so a mark never moves back.

    ``facts`` are further columns of the table: with a batch the row is a commit. With
    a ``sequence`` the mark has a path of its own that only one run can write;
    ``SequenceTaken`` if another has.
    """
    known = {
        "entity": F.lit(entity),
        "high_water": F.lit(None) if high_water is None else as_timestamp(high_water),
        "updated_at": as_timestamp(updated_at),
    } | {name: F.lit(value) for name, value in (facts | {"sequence": sequence}).items() if value is not None}
    # Columns that aren't written are null to readers, who name all.
    row = spark.range(1, numPartitions=1).select(
        *(known[f.name].cast(f.dataType).alias(f.name) for f in WATERMARK if f.name in known)
    )
    if sequence is None:
        row.write.mode("append").parquet(path)
        return
    own = commit_path(path, entity, sequence)
    if exists(spark, own):
        raise SequenceTaken(own)
    try:
        row.write.mode("errorifexists").parquet(own)
    except AnalysisException as error:
        if error.getCondition() == "PATH_ALREADY_EXISTS":
            raise SequenceTaken(own) from error
        raise


def changed_since(source: DataFrame, column: str, watermark: datetime | str | None, lookback_days: int = 0) -> DataFrame:
    """Rows at or after the mark, or the whole source without one.

    ``lookback_days`` before the mark are read again, for rows that arrive late with an
    older change date. The mark is cast to the type of the column, not the column to the type of
    the mark, so the filter reaches the Parquet or JDBC scan. Rows with no
    change date come with every batch.
    """
    if watermark is None:
        return source
    own_type = source.select(column).schema[0].dataType
    first = as_timestamp(watermark) - F.make_dt_interval(F.lit(lookback_days)) if lookback_days else as_timestamp(watermark)
    return source.filter((F.col(column) >= first.cast(own_type)) | F.col(column).isNull())
