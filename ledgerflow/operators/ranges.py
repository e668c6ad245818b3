"""Bounds of ranges that hold equally many rows, found without one task that sees all rows."""

from bisect import bisect_right
from itertools import accumulate
from uuid import uuid4

from pyspark.sql import DataFrame, Window, functions as F

from ledgerflow.operators.size import shared_folder
from ledgerflow.sources.paths import remove


def equal_row_bounds(rows: DataFrame, column: str, parts: int) -> list:
    """The least value of each of ``parts`` pieces with as many rows, exactly as ``NTILE`` cuts them.

    Values are counted, and the counts sorted by range over the shuffle partitions. The driver
    gets one number a range and so knows in which range, and at which place there, a piece
    starts; only the ranges in which one does are ranked, each in a task of its own.
    Nulls belong to no piece; with fewer rows than pieces there is a piece a row.
    """
    spark = rows.sparkSession
    path = f"{shared_folder(spark)}/value-ranges-{uuid4().hex}"
    counts = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n"))
    try:
        counts.repartitionByRange("value").withColumn("range", F.spark_partition_id()).write.parquet(path)
        ranged = spark.read.parquet(path)
        sizes = sorted(ranged.groupBy("range").agg(F.sum("n").alias("n")).collect())
        *starts, total = accumulate((n for _, n in sizes), initial=0)
        most, longer = divmod(total, parts)  # the first pieces have one row more
        wanted = []
        for rank in (i * most + min(i, longer) for i in range(min(parts, total))):
            at = bisect_right(starts, rank) - 1
            wanted.append((sizes[at][0], rank - starts[at]))
        if not wanted:
            return []
        upto = F.sum("n").over(Window.partitionBy("range").orderBy("value").rowsBetween(Window.unboundedPreceding, 0))
        found = (
            ranged.filter(F.col("range").isin(sorted({place for place, _ in wanted})))
            .withColumn("upto", upto)
            .join(F.broadcast(spark.createDataFrame(wanted, "range int, rank long")), "range")
            .filter("rank < upto AND rank >= upto - n")
        )
        return [value for _, _, value in sorted(found.select("range", "rank", "value").collect(), key=lambda row: row[:2])]
    finally:
        remove(spark, path)
