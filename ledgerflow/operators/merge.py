"""A small batch compared with or merged into a large table."""

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ledgerflow.operators.checks import latest_per_key, prefixed, same_key
from ledgerflow.operators.size import BROADCAST_BYTES, broadcast_bytes


def merge_latest(
    table: DataFrame,
    batch: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str],
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """The latest row per key of both; ``table`` has one row per key already.

    Where the keys of the batch are measured within ``limit`` bytes they are
    broadcast: rows of other keys pass through unshuffled, and only those of
    the batch's keys are ranked. A larger batch is ranked with the whole table.
    ``batch`` is read several times, so it should be a written table.
    """
    changed = prefixed(batch, keys).distinct()
    if broadcast_bytes(changed) > limit:
        return latest_per_key(table.unionByName(batch), keys, newest_first)
    kept = table.join(F.broadcast(changed), same_key(keys), "left_anti")
    rivals = table.join(F.broadcast(changed), same_key(keys), "left_semi")
    return kept.unionByName(latest_per_key(rivals.unionByName(batch), keys, newest_first))


def unknown_rows(
    batch: DataFrame,
    known: DataFrame,
    keys: Sequence[str],
    digest: str,
    order: str,
    limit: int = BROADCAST_BYTES,
) -> DataFrame:
    """Rows of ``batch``, one a key, whose digest isn't that of their key's last row in ``known``.

    The last row is that with the greatest ``order``. Where the batch's keys measure within
    ``limit`` bytes they are broadcast, and only those keys' rows of ``known`` are shuffled.
    ``batch`` is read several times, so it should be a written table.
    """
    own = prefixed(batch, keys)
    if broadcast_bytes(own) <= limit:
        known = known.join(F.broadcast(own), same_key(keys), "left_semi")
    last = known.groupBy(*keys).agg(F.max_by(digest, order).alias("_last"))
    last = last.select(*(F.col(k).alias(f"_{k}") for k in keys), "_last")
    return batch.join(last, same_key(keys) & (F.col(digest) == F.col("_last")), "left_anti")
