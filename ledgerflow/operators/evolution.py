"""Tables whose columns change over time: folders written with unlike schemas, read as one."""

import json
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.types import DataType, StringType, StructField, StructType


class SchemaChanged(ValueError):
    """A column has another type than in rows that are committed already."""


def _named(fields: Iterable[StructField]) -> dict[str, StructField]:
    return {field.name.lower(): field for field in fields}


def changed_types(old: StructType, new: StructType) -> list[str]:
    """Columns that both have, with unlike types."""
    known = _named(old)
    return [f.name for f in new if f.name.lower() in known and not _same(known[f.name.lower()].dataType, f.dataType)]


def _same(a: DataType, b: DataType) -> bool:
    """Whether two types hold the same values, nullable or not."""
    return a.simpleString() == b.simpleString()


def merged_schema(schemas: Sequence[StructType], as_text: bool = False) -> StructType:
    """All columns in the order of their first appearance, each nullable.

    A column of unlike types is refused, or, ``as_text``, becomes a string.
    """
    fields: dict[str, StructField] = {}
    for schema in schemas:
        for field in schema:
            key = field.name.lower()
            known = fields.setdefault(key, StructField(field.name, field.dataType))
            if not _same(known.dataType, field.dataType):
                if not as_text:
                    raise SchemaChanged(f"column {field.name}: {known.dataType.simpleString()} became {field.dataType.simpleString()}")
                fields[key] = StructField(known.name, StringType())
    return StructType(list(fields.values()))


def shaped(rows: DataFrame, schema: StructType) -> DataFrame:
    """``rows`` with the columns of ``schema``: missing ones null, further ones kept behind."""
    there = _named(rows.schema)

    def column(field: StructField):
        if field.name.lower() not in there:
            return F.lit(None).cast(field.dataType).alias(field.name)
        value = F.col(there[field.name.lower()].name)
        return (value if _same(there[field.name.lower()].dataType, field.dataType) else value.cast(field.dataType)).alias(field.name)

    known = _named(schema)
    return rows.select(*map(column, schema), *(F.col(f.name) for key, f in there.items() if key not in known))


def read_folders(spark: SparkSession, base: str, folders: Sequence[tuple[str, str | None]], as_text: bool = False) -> DataFrame:
    """Folders below ``base``, each with the JSON of the schema it was written with, as one table.

    Folders of one schema are one scan; their partition columns come last. Without a
    JSON, the schema is that of one of the folder's files.
    """
    groups: dict[str | None, list[str]] = {}
    for folder, schema in folders:
        groups.setdefault(schema, []).append(folder)
    scans, schemas = [], []
    for text, paths in groups.items():
        reader = spark.read.option("basePath", base)
        own = StructType.fromJson(json.loads(text)) if text else None
        scans.append((reader.schema(own) if own else reader).parquet(*paths))
        schemas.append(own or scans[-1].schema)
    if len(scans) == 1:
        return scans[0]
    whole = merged_schema(schemas, as_text)
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (shaped(scan, whole) for scan in scans))

