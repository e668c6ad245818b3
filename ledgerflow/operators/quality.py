"""Checks of a published table. Each is one aggregation, combined map-side."""

from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, functions as F

from ledgerflow.functions.dates import as_timestamp


def _null_cells(columns: Sequence[str]) -> Column:
    return sum((F.count_if(F.col(c).isNull()) for c in columns), F.lit(0).cast("bigint"))


def _fresh(latest: Column, hours: int, as_of) -> Column:
    oldest = as_timestamp(as_of) - F.make_dt_interval(hours=F.lit(hours))
    return F.coalesce(latest >= oldest, F.lit(False))


def duplicates(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: rows beyond the first of each key; null keys form a group."""
    surplus = F.coalesce(F.sum(F.col("count") - 1), F.lit(0))
    return df.groupBy(*columns).count().agg(surplus.alias("duplicate_rows"))


def nulls(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row: null cells over all ``columns``."""
    return df.agg(_null_cells(columns).alias("null_cells"))


def freshness(
    df: DataFrame, column: str, hours: int, as_of: datetime | str | None = None
) -> DataFrame:
    """One row: newest stamp, and whether it is at most ``hours`` old."""
    return df.agg(F.max(column).alias("latest")).select(
        "latest", _fresh(F.col("latest"), hours, as_of).alias("is_fresh")
    )


def check_for_duplicates(df: DataFrame, columns: Sequence[str]) -> int:
    return duplicates(df, columns).first()["duplicate_rows"]


def check_for_nulls(df: DataFrame, columns: Sequence[str]) -> int:
    return nulls(df, columns).first()["null_cells"]


def check_data_freshness(
    df: DataFrame, column: str, hours: int, as_of: datetime | str | None = None
) -> bool:
    """False for an empty table."""
    return freshness(df, column, hours, as_of).first()["is_fresh"]


def quality_report(
    df: DataFrame,
    keys: Sequence[str],
    required: Sequence[str],
    stamp: str = "ingestion_timestamp",
    hours: int = 24,
    as_of: datetime | str | None = None,
    updated: str = "last_updated",
) -> DataFrame:
    """One row with all checks and their verdict, in one scan and one shuffle.

    Counting per key first serves the duplicate check, and what is shuffled is
    only the keys with a few counters. ``high_water`` is the newest source
    change among the rows.
    """
    per_key = df.groupBy(*keys).agg(
        F.count("*").alias("n"),
        _null_cells(required).alias("empty"),
        F.max(stamp).alias("latest"),
        F.max(updated).alias("high_water"),
    )
    zero = F.lit(0).cast("bigint")
    return (
        per_key.agg(
            F.coalesce(F.sum("n"), zero).alias("row_count"),
            F.coalesce(F.sum(F.col("n") - 1), zero).alias("duplicate_rows"),
            F.coalesce(F.sum("empty"), zero).alias("null_cells"),
            F.max("latest").alias("latest"),
            F.max("high_water").alias("high_water"),
        )
        .withColumn("is_fresh", _fresh(F.col("latest"), hours, as_of))
        .withColumn(
            "passed",
            (F.col("duplicate_rows") == 0) & (F.col("null_cells") == 0) & F.col("is_fresh"),
        )
    )
