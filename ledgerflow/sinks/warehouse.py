"""Writes to a cloud warehouse through its Spark connector."""

import logging

from pyspark.sql import DataFrame

from ledgerflow.sources.warehouse import SNOWFLAKE

log = logging.getLogger(__name__)


def write_warehouse_table(
    df: DataFrame, options: dict, table: str, mode: str = "append", fmt: str = SNOWFLAKE
) -> None:
    log.info("warehouse write to %s, mode %s", table, mode)
    df.write.format(fmt).options(**options, dbtable=table).mode(mode).save()
