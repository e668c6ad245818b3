"""Scans of a cloud warehouse through its Spark connector."""

import logging

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# Fixed value: the name of the connector.
SNOWFLAKE = "net.snowflake.spark.snowflake"
# The settings that must be given.
REQUIRED = ("account", "username", "password", "database", "schema", "warehouse")


def snowflake_options(config: dict) -> dict[str, str]:
    missing = [key for key in REQUIRED if key not in config]
    if missing:
        raise ValueError(f"missing Snowflake settings: {', '.join(missing)}")
    # Option names of the connector.
    return {
        "sfURL": f"{config['account']}.snowflakecomputing.com",
        "sfUser": config["username"],
        "sfPassword": config["password"],
        "sfDatabase": config["database"],
        "sfSchema": config["schema"],
        "sfWarehouse": config["warehouse"],
        "sfRole": config.get("role", ""),
        "sfCompress": "on",
        "sfSSL": "on",
    }


def read_warehouse_table(
    spark: SparkSession,
    options: dict,
    table: str | None = None,
    query: str | None = None,
    fmt: str = SNOWFLAKE,
) -> DataFrame:
    """A query wins over a table name."""
    log.info("warehouse scan of %s", "a query" if query else table)
    wanted = {"query": query} if query else {"dbtable": table}
    return spark.read.format(fmt).options(**options, **wanted).load()
