"""Parquet and Delta tables below one base URI."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerflow.sources.lake import lake_path

ROW_GROUP_BYTES = 256 * 1024 * 1024


def write_parquet(
    df: DataFrame,
    base_uri: str,
    path: str,
    partition_by: Sequence[str] = (),
    mode: str = "overwrite",
    dynamic: bool = False,
    rebalance: bool = True,
) -> None:
    """Snappy Parquet with 256 MB row groups.

    ``dynamic`` overwrites only the partitions present in ``df``. Rows of a
    partitioned table are regrouped by its columns first, so that not every
    task writes a file into every folder; it is the rebalance hint rather than
    a plain repartition, because adaptive execution splits a folder holding
    most of the rows over many tasks. Turn it off when each task already
    writes to few folders.
    """
    if partition_by and rebalance:
        df = df.hint("rebalance", *partition_by)
    writer = (
        df.write.mode(mode)
        .option("compression", "snappy")
        .option("parquet.block.size", ROW_GROUP_BYTES)
    )
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(lake_path(base_uri, path))


def write_clustered(
    df: DataFrame,
    base_uri: str,
    path: str,
    cluster_by: Sequence[str],
    files: int,
    mode: str = "overwrite",
    row_group_bytes: int = ROW_GROUP_BYTES,
) -> None:
    """Parquet in about ``files`` files, each a range of ``cluster_by`` and sorted by it.

    The row groups' least and greatest values then rule out all but a few of them for a
    lookup or a range. Spark finds the ranges from a sample, for which ``df`` is
    evaluated once more, so it should be a written table. Rows of one value are told
    apart by a hash, so a value with most of the rows is spread over many files.
    """
    plain = [name for name, kind in df.dtypes if "map<" not in kind and "variant" not in kind]
    spread = df.repartitionByRange(files, *cluster_by, F.xxhash64(*plain))
    sorted_rows = spread.sortWithinPartitions(*cluster_by)
    sorted_rows.write.mode(mode).option("compression", "snappy").option(
        "parquet.block.size", row_group_bytes
    ).parquet(lake_path(base_uri, path))


def write_delta(
    df: DataFrame, base_uri: str, path: str, mode: str = "overwrite", fmt: str = "delta"
) -> None:
    """Needs the Delta package on the cluster; Spark names the missing format."""
    df.write.format(fmt).mode(mode).option("compression", "snappy").save(lake_path(base_uri, path))
