"""Tables written to the storage that all executors share.

A written table cuts the lineage and outlives lost executors. Its folder lies
below ``spark.checkpoint.dir``; only a local session that names none gets a folder
of this machine.
"""

from collections.abc import Callable
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ledgerflow.operators.size import broadcast_bytes, shared_folder
from ledgerflow.sources.paths import remove

ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
BATCH_ROWS = 1000
SALTS = 32  # tasks over which the rows of one group are spread
# Rows that are broadcast at most: with one long key 16 MB of keys, under 100 MB
# as a hash table. Beyond that, or beyond these bytes, the join is shuffled.
MOST_BROADCAST_KEYS = 1_000_000
MOST_BROADCAST_BYTES = 128 << 20
FIXED_WIDTH = ("boolean", "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz")

_folders: list[str] = []  # made by this process, in their order


def folder(spark: SparkSession, name: str) -> str:
    """A new folder on the storage all executors share."""
    _folders.append(f"{shared_folder(spark)}/{name}-{uuid4().hex}")
    return _folders[-1]


def small_batches(spark: SparkSession, rows: int = BATCH_ROWS) -> None:
    """From now on Python tasks of the session get at most ``rows`` rows at once.

    Whole documents are long; ten thousand of them, Spark's default, take much memory
    in both the JVM and Python. A smaller setting of the caller's stays.
    """
    now = int(spark.conf.get(ARROW_ROWS))
    if not 0 < now <= rows:
        spark.conf.set(ARROW_ROWS, str(rows))


def row_number(column: str | None) -> Column:
    """The numbers stored in ``column``, or such as hold within this one scan."""
    return F.col(column).cast("long") if column else F.monotonically_increasing_id()


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` evaluated once, as a Parquet table read back."""
    path = folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def settled(spark: SparkSession, build: Callable[[], DataFrame], name: str) -> DataFrame:
    """What ``build`` describes, as a written table; the tables that led there are removed.

    Nothing else that reads tables written meanwhile may be in use; one operator or stage
    after the other is what this is for.
    """
    began = len(_folders)
    out = written(build(), name)
    for path in _folders[began:-1]:
        remove(spark, path)
    del _folders[began:-1]
    return out


def bounded_sample(rows: DataFrame, group: str, key: str, most: int) -> DataFrame:
    """At most ``most`` rows of each of a few groups: those whose keys have the smallest hashes.

    Groups are counted first, and only about as many rows as are wanted are ranked.
    """
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("_n"))
    place = F.pmod(F.xxhash64(key), F.lit(1 << 40)) / float(1 << 40)
    near = rows.join(F.broadcast(counts), group).where(place * F.col("_n") < 1.2 * most + 20).drop("_n")
    order = Window.partitionBy(group).orderBy(F.xxhash64(key), key)
    return near.withColumn("_place", F.row_number().over(order)).where(F.col("_place") <= most).drop("_place")


def checked_broadcast(keys: DataFrame) -> DataFrame:
    """``keys`` (narrow rows of a written table) marked for broadcast where few and small enough."""
    if keys.limit(MOST_BROADCAST_KEYS + 1).count() > MOST_BROADCAST_KEYS:
        return keys
    fixed = all(kind in FIXED_WIDTH for _, kind in keys.dtypes)
    return F.broadcast(keys) if fixed or broadcast_bytes(keys) <= MOST_BROADCAST_BYTES else keys


def without(rows: DataFrame, dropped: DataFrame, key: str) -> DataFrame:
    """Rows whose non-null ``key`` isn't in ``dropped``; their text isn't shuffled
    unless the dropped keys are too many to broadcast."""
    return rows.join(checked_broadcast(dropped.select(key)), key, "left_anti")


