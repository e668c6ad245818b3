"""Schema check and the standard row checks of every transform.

The definitions are this project's own: a row with a null in a required column
is rejected, and of the rows sharing a key only the latest is kept.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import DecimalType, StringType, StructType

from ledgerflow.operators.size import BROADCAST_BYTES, broadcast_bytes, kept_aside

MISSING = "missing_required"
NOT_LATEST = "not_latest"
LOSSY = "lossy_cast"


def validate_schema(df: DataFrame, required: StructType) -> bool:
    """Every required field is there with its type; extra columns are fine."""
    return not unmatched_fields(df, required)


def unmatched_fields(df: DataFrame, required: StructType) -> list[str]:
    """Names that are missing or of another type."""
    present = {field.name: field.dataType for field in df.schema}
    return [field.name for field in required if present.get(field.name) != field.dataType]


def require_schema(df: DataFrame, required: StructType, entity: str) -> DataFrame:
    """The declared columns of ``df`` in declared order, or ``ValueError``."""
    unmatched = unmatched_fields(df, required)
    if unmatched:
        raise ValueError(f"{entity} columns missing or of another type: {', '.join(unmatched)}")
    return df.select(*required.fieldNames())


def named(df: DataFrame, schema: StructType, entity: str) -> DataFrame:
    """The columns of ``schema`` with its names and the source's types, or ``ValueError``.

    Names match whatever their case, as Spark resolves them.
    """
    there = {name.lower() for name in df.columns}
    absent = [name for name in schema.fieldNames() if name.lower() not in there]
    if absent:
        raise ValueError(f"{entity} columns missing: {', '.join(absent)}")
    return df.select(*(F.col(name).alias(name) for name in schema.fieldNames()))


def lossy_cast(df: DataFrame, schema: StructType) -> Column:
    """Whether some value of a row doesn't survive the cast to its declared type."""
    def lost(field) -> Column:
        own, value = df.schema[field.name].dataType, F.col(field.name)
        cast = value.try_cast(field.dataType)
        if isinstance(own, StringType):  # other spellings of a value are no loss
            exact = value.try_cast("decimal(38,18)") if isinstance(field.dataType, DecimalType) else cast
            return value.isNotNull() & (cast.isNull() | (cast != exact))
        return ~cast.try_cast(own).eqNullSafe(value)

    changed = [f for f in schema if df.schema[f.name].dataType != f.dataType]
    return reduce(or_, map(lost, changed), F.lit(False))


def conform(df: DataFrame, schema: StructType) -> DataFrame:
    """Rename and cast a source frame (say, upper-case names) to ``schema``."""
    return df.select(
        *(F.col(f.name).cast(f.dataType).alias(f.name) for f in schema)
    )


def has_null(columns: Sequence[str]) -> Column:
    return reduce(or_, (F.col(c).isNull() for c in columns), F.lit(False))


def latest_per_key(
    df: DataFrame, keys: Sequence[str], newest_first: Sequence[str]
) -> DataFrame:
    """One row per key: greatest ``newest_first``, ties by the other columns.

    Filtering on the first row number lets Spark cut every key to one row in
    each map task before the shuffle, so a key with a third of all rows still
    sends at most one row per task.
    """
    rest = [c for c in df.columns if c not in keys and c not in newest_first]
    order = [F.col(c).desc_nulls_last() for c in newest_first]
    order += [F.col(c).asc_nulls_last() for c in rest]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def apply_standard_checks(
    df: DataFrame,
    id_columns: Sequence[str],
    not_null_columns: Sequence[str],
    updated: str = "last_updated",
) -> DataFrame:
    """Complete rows only, the latest of each key."""
    complete = df.filter(~has_null(not_null_columns))
    return latest_per_key(complete, id_columns, [updated])


def same_key(keys: Sequence[str]) -> Column:
    """Null-safe match of ``keys`` with columns made by ``prefixed``."""
    return reduce(and_, (F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys))


def prefixed(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.select(*(F.col(k).alias(f"_{k}") for k in keys))


def rejected_rows(
    df: DataFrame,
    id_columns: Sequence[str],
    not_null_columns: Sequence[str],
    updated: str = "last_updated",
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """What ``apply_standard_checks`` leaves out, with a ``reason``.

    Equal rows come back once with their number in ``copies``. It is the input
    minus the kept rows, counted per whole row: the shuffle spreads over row
    contents and is combined map-side, so neither a hot key nor a row repeated
    a thousand million times gathers in one task.

    The keys with several rows are counted first, once, into a table on shared
    storage. Where they measure within ``limit`` bytes they are broadcast, and all
    other rows stay out of the shuffles. ``df`` is read several times, so it should
    be a written table.
    """
    incomplete = has_null(not_null_columns)
    missing, rivals = df.filter(incomplete), df.filter(~incomplete)
    repeated = prefixed(rivals.groupBy(*id_columns).count().filter("count > 1"), id_columns)
    repeated = kept_aside(repeated, "repeated-keys")
    if broadcast_bytes(repeated) <= limit:
        rivals = rivals.join(F.broadcast(repeated), same_key(id_columns), "left_semi")
    kept = latest_per_key(rivals, id_columns, [updated])

    def counted(rows, reason, copies):
        return rows.withColumns({"reason": F.lit(reason), "copies": F.lit(copies)})

    return (
        counted(missing, MISSING, 1)
        .unionByName(counted(rivals, NOT_LATEST, 1))
        .unionByName(counted(kept, NOT_LATEST, -1))
        .groupBy(*df.columns, "reason")
        .agg(F.sum("copies").alias("copies"))
        .filter("copies > 0")
    )
