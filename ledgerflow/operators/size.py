"""How large a side of a join is, measured before it is broadcast."""

import tempfile
from functools import cache, reduce
from operator import add
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_BYTES = 8 * 1024 * 1024
ROW_BYTES = 64  # row header and hash entry
VALUE_BYTES = 16  # a fixed-width value, or the header of a text


NESTED = ("array", "map", "struct", "variant")


def broadcast_bytes(df: DataFrame) -> int:
    """Upper estimate of the size in memory of the rows, as one aggregated number.

    A nested value counts as twice its JSON text, which is no shorter than what it
    holds. Texts of any collation are measured.
    """
    def extra(name: str, kind: str):
        if kind.startswith(NESTED):
            return 2 * F.octet_length(F.to_json(F.struct(name)))
        return F.octet_length(F.col(name).cast("binary" if kind == "binary" else "string"))

    measured = [
        F.coalesce(extra(c, kind), F.lit(0))
        for c, kind in df.dtypes if kind.startswith(("string", "binary", "varchar", "char", *NESTED))
    ]
    row = reduce(add, measured, F.lit(ROW_BYTES + VALUE_BYTES * len(df.columns)))
    return df.agg(F.coalesce(F.sum(row.cast("bigint")), F.lit(0)).alias("total")).first()["total"]


@cache
def _own_folder() -> str:
    return tempfile.mkdtemp(prefix="ledgerflow-")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share; a new one of this machine in a local session without."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.conf.get("spark.master", "local").startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = _own_folder()
    return shared.rstrip("/")


def kept_aside(df: DataFrame, name: str) -> DataFrame:
    """``df`` evaluated once, as a table on shared storage read back."""
    path = f"{shared_folder(df.sparkSession)}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
