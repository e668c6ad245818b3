from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from ledgerflow.plans.session import session_options
from ledgerflow.sinks.lake import write_clustered, write_delta, write_parquet
from ledgerflow.sources.lake import read_parquet


def days(spark, rows=100, days=4):
    day = F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % days).cast("int"))
    return spark.range(rows).withColumn("day", day)


def files(folder):
    return sorted(p for p in Path(folder).rglob("*.parquet"))


def test_overwrite_is_the_default(spark, lake):
    for rows in (10, 3):
        write_parquet(spark.range(rows), lake, "t")
    assert read_parquet(spark, lake, "t").count() == 3
    assert all(f.name.endswith(".snappy.parquet") for f in files(lake))


def test_append(spark, lake):
    for _ in range(2):
        write_parquet(spark.range(5), lake, "t", mode="append")
    assert read_parquet(spark, lake, "t").count() == 10


def test_one_file_per_small_folder(spark, lake):
    write_parquet(days(spark).repartition(8), lake, "t", partition_by=["day"])
    assert len(files(lake)) == 4
    write_parquet(days(spark).repartition(8), lake, "loose", partition_by=["day"], rebalance=False)
    assert len(files(f"{lake}/loose")) > 4


def test_a_folder_with_most_rows_is_written_by_several_tasks(spark, lake):
    day = F.when(F.col("id") % 10 == 0, "2024-01-02").otherwise("2024-01-01").cast("date")
    rows = spark.range(400_000, numPartitions=8).select("id", F.sha2(F.col("id").cast("string"), 256).alias("text"), day.alias("day"))
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", str(1024 * 1024))
    try:
        write_parquet(rows, lake, "t", partition_by=["day"])
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    assert len(files(f"{lake}/t/day=2024-01-01")) > 4
    assert read_parquet(spark, lake, "t").count() == 400_000


def test_dynamic_overwrite_leaves_other_days(spark, lake):
    write_parquet(days(spark), lake, "t", ["day"])
    again = days(spark).filter("day = DATE '2024-01-02'").withColumn("id", -F.col("id"))
    for _ in range(2):
        write_parquet(again, lake, "t", ["day"], dynamic=True)
    table = read_parquet(spark, lake, "t")
    assert table.count() == 100
    assert {r.day.day for r in table.filter("id < 0").collect()} == {2}


def test_day_filter_prunes_folders(spark, lake):
    from conftest import plan_text

    write_parquet(days(spark), lake, "t", ["day"])
    plan = plan_text(read_parquet(spark, lake, "t").filter("day = DATE '2024-01-02'"))
    assert "PartitionFilters: [isnotnull(day" in plan


def test_missing_delta_package_is_named(spark, lake):
    with pytest.raises(Exception, match="data source: delta"):
        write_delta(spark.range(1), lake, "t")


def test_delta_call_with_another_format(spark, lake):
    write_delta(spark.range(3), lake, "t", fmt="parquet")
    write_delta(spark.range(2), lake, "t", mode="append", fmt="parquet")
    assert read_parquet(spark, lake, "t").count() == 5


def test_tasks_follow_the_data_up_to_a_limit():
    assert "spark.sql.shuffle.partitions" not in session_options()
    small, large, huge = (session_options(n) for n in (1, 10**12, 100 * 10**12))
    assert small["spark.sql.shuffle.partitions"] == "200"
    assert large["spark.sql.shuffle.partitions"] == str(-(-(10**12) // 2**28))
    assert huge["spark.sql.shuffle.partitions"] == "40000"
    assert int(huge["spark.sql.files.maxPartitionBytes"]) * 40000 >= 100 * 10**12


def row_groups(folder, column, value):
    """All row groups of a table, and those whose statistics leave a value possible."""
    found = []
    for file in files(folder):
        meta = pq.ParquetFile(file).metadata
        index = [meta.schema.column(k).name for k in range(meta.num_columns)].index(column)
        found += [meta.row_group(g).column(index).statistics for g in range(meta.num_row_groups)]
    return len(found), sum(s.min <= value <= s.max for s in found)


def test_a_lookup_in_a_clustered_table_reads_few_row_groups(spark, lake):
    rows = spark.range(200_000).select((F.xxhash64("id") % 5000).alias("key"), F.md5(F.col("id").cast("string")).alias("rest"))
    write_parquet(rows.repartition(8), lake, "plain")
    write_clustered(rows, lake, "clustered", ["key"], files=8, row_group_bytes=256 * 1024)
    plain, clustered = row_groups(f"{lake}/plain", "key", 17), row_groups(f"{lake}/clustered", "key", 17)
    assert plain[1] == plain[0] >= 8
    assert clustered[0] >= 24 and clustered[1] <= 2
    found = read_parquet(spark, lake, "clustered")
    assert found.exceptAll(rows).count() == 0 == rows.exceptAll(found).count()


def test_a_value_with_most_rows_is_spread_over_files(spark, lake):
    rows = spark.range(80_000).select(F.when(F.col("id") % 10 < 7, 5).otherwise(F.col("id") % 100).alias("key"), "id")
    write_clustered(rows, lake, "hot", ["key"], files=8)
    sizes = [pq.ParquetFile(f).metadata.num_rows for f in files(f"{lake}/hot")]
    assert len(sizes) == 8 and max(sizes) < 2 * 80_000 / 8
    write_clustered(rows.limit(0), lake, "none", ["key"], files=8)
    assert read_parquet(spark, lake, "none").count() == 0
