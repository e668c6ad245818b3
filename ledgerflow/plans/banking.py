"""The loads wired to their production sources.

``config`` has the sections ``oracle``, ``snowflake`` and ``aws``; their keys
are those of the option builders.
"""

from collections.abc import Sequence
from dataclasses import replace

from pyspark.sql import Row, SparkSession

from ledgerflow.operators.checks import conform
from ledgerflow.plans.loads import Load, account_load, customer_load, run_all
from ledgerflow.schemas import EXCHANGE_RATE
from ledgerflow.sources.jdbc import (
    DEFAULT_PARTITIONS, modulo_predicates, oracle_options, read_jdbc_table,
)
from ledgerflow.sources.lake import bucket_uri
from ledgerflow.sources.warehouse import SNOWFLAKE, read_warehouse_table, snowflake_options

LOOKBACK_DAYS = 3  # how late rows may arrive with an older change date


def customers_from_oracle(
    spark: SparkSession,
    config: dict,
    table: str = "customers",
    predicates: Sequence[str] | None = None,
    partition_column: str | None = None,
    partitions: int = DEFAULT_PARTITIONS,
    equal_rows: bool = False,
) -> Load:
    """The scan is split by ``predicates``, best one for each physical piece of the
    table (a partition, a range of row ids), or by ranges of ``partition_column``, an
    indexed number or date; with ``equal_rows`` these hold as many rows each. Without either it is split by the hash of the id: that
    always works, but the database reads the whole table once for each part.
    """
    options = oracle_options(config["oracle"])
    if predicates is None and partition_column is None:
        predicates = modulo_predicates("ORA_HASH(customer_id)", partitions)
    return customer_load(lambda: read_jdbc_table(
        spark, options, table, predicates=predicates,
        partition_column=partition_column, num_partitions=partitions, **({"equal_rows": True} if equal_rows else {}),
    ))


def accounts_from_snowflake(
    spark: SparkSession,
    config: dict,
    accounts: str = "accounts",
    exchange_rates: str = "exchange_rates",
    fmt: str = SNOWFLAKE,
) -> Load:
    options = snowflake_options(config["snowflake"])

    def read(table):
        return read_warehouse_table(spark, options, table, fmt=fmt)

    return account_load(
        lambda: read(accounts), lambda: conform(read(exchange_rates), EXCHANGE_RATE)
    )


def run_banking(
    spark: SparkSession,
    config: dict,
    *further: Load,
    customers: dict | None = None,
    accounts: dict | None = None,
    ingested_at: str | None = None,
    at_once: int = 3,
    skip_committed: bool = False,
) -> dict[str, Row]:
    """Customers, accounts and any ``further`` loads, into the bucket of ``aws``, ``at_once`` side by side.

    ``customers`` and ``accounts`` are arguments of ``customers_from_oracle`` and
    ``accounts_from_snowflake``: tables, how to split the scan, the connector's format.
    Both read LOOKBACK_DAYS before their mark again and write changed rows only.
    """
    loads = [
        customers_from_oracle(spark, config, **(customers or {})),
        accounts_from_snowflake(spark, config, **(accounts or {})),
        *further,
    ]
    loads[:2] = [replace(load, changed_only=True, lookback_days=LOOKBACK_DAYS) for load in loads[:2]]
    return run_all(spark, loads, bucket_uri(config["aws"]), ingested_at, at_once=at_once, skip_committed=skip_committed)
