"""Scans of a relational database through Spark's JDBC reader."""

import logging
from collections.abc import Sequence
from datetime import date, datetime
from decimal import ROUND_CEILING, ROUND_FLOOR, Decimal

from pyspark.sql import DataFrame, SparkSession

log = logging.getLogger(__name__)

# The required settings and the default number of range partitions.
REQUIRED = ("host", "port", "service_name", "username", "password")
DEFAULT_PARTITIONS = 10


def oracle_options(config: dict) -> dict[str, str]:
    """Flat reader options for an Oracle service.

    ``options`` in ``config`` adds or replaces reader options, for instance a
    ``sessionInitStatement`` with the date formats of a date range scan.
    """
    missing = [key for key in REQUIRED if key not in config]
    if missing:
        raise ValueError(f"missing Oracle settings: {', '.join(missing)}")
    # Option names and defaults of the JDBC reader and the driver.
    return {
        "url": f"jdbc:oracle:thin:@{config['host']}:{config['port']}/{config['service_name']}",
        "user": config["username"],
        "password": config["password"],
        "driver": "oracle.jdbc.OracleDriver",
        "oracle.jdbc.readTimeout": str(config.get("read_timeout", 60000)),
        "oracle.net.CONNECT_TIMEOUT": str(config.get("connect_timeout", 10000)),
        # The driver's own default of ten rows per round trip is far too small.
        "fetchsize": "10000",
        **config.get("options", {}),
    }


def subquery(query: str) -> str:
    """A query in the place of a table name."""
    return f"({query}) tmp"


def bounds_query(table: str, column: str) -> str:
    """Both bounds in one round trip."""
    return f"SELECT MIN({column}) AS min_val, MAX({column}) AS max_val FROM {table}"


def modulo_predicates(expression: str, parts: int) -> list[str]:
    """Disjoint predicates covering every row, nulls included.

    ``expression`` is a whole number in the database's own SQL. It serves
    columns the range scan refuses, for instance a hash of a text key.
    """
    split = [f"ABS(MOD({expression}, {parts})) = {i}" for i in range(parts)]
    return [f"{split[0]} OR {expression} IS NULL", *split[1:]]


def quantile_query(table: str, column: str, parts: int) -> str:
    """The least value of each of ``parts`` pieces with as many rows, in one round trip."""
    ranked = f"SELECT {column} AS bound, NTILE({parts}) OVER (ORDER BY {column}) AS piece FROM {table} WHERE {column} IS NOT NULL"
    return f"SELECT piece, MIN(bound) AS bound FROM ({ranked}) ranked GROUP BY piece"


def literal(value) -> str:
    """A number, date, timestamp or text in standard SQL."""
    if isinstance(value, datetime):
        return f"TIMESTAMP '{value.isoformat(sep=' ')}'"
    if isinstance(value, date):
        return f"DATE '{value.isoformat()}'"
    if isinstance(value, str):
        return "'" + value.replace("'", "''") + "'"
    return format(value, "f") if isinstance(value, Decimal) else str(value)


def range_predicates(column: str, bounds: Sequence) -> list[str]:
    """Disjoint predicates covering every row, nulls included, cut at the distinct ``bounds``.

    With the bounds of ``quantile_query`` a part holds at most one piece's rows besides those of
    its first value: a value with more rows than a piece has them in one part.
    """
    cuts = [literal(bound) for bound in sorted({b for b in bounds if b is not None})[1:]]
    if not cuts:
        return ["1 = 1"]
    inner = [f"{column} >= {low} AND {column} < {high}" for low, high in zip(cuts, cuts[1:], strict=False)]
    return [f"{column} < {cuts[0]} OR {column} IS NULL", *inner, f"{column} >= {cuts[-1]}"]


def read_quantiles(spark: SparkSession, options: dict, table: str, column: str, parts: int) -> list:
    """The bounds of ``parts`` pieces with as many rows; so many values come to the driver."""
    reader = spark.read.format("jdbc").options(**options)
    return [row[1] for row in reader.option("query", quantile_query(table, column, parts)).load().collect()]


def read_bounds(spark: SparkSession, options: dict, table: str, column: str) -> tuple | None:
    """Least and greatest value of ``column``; ``None`` if there is none."""
    reader = spark.read.format("jdbc").options(**options)
    low, high = reader.option("query", bounds_query(table, column)).load().first()
    return None if low is None else (low, high)


def _bound(value, rounding: str) -> str:
    """Text the reader accepts: whole numbers, dates and timestamps."""
    if isinstance(value, (Decimal, float)):
        return str(int(Decimal(value).to_integral_value(rounding)))
    return str(value)


def read_jdbc_table(
    spark: SparkSession,
    options: dict,
    table: str | None = None,
    query: str | None = None,
    predicates: Sequence[str] | None = None,
    partition_column: str | None = None,
    num_partitions: int = DEFAULT_PARTITIONS,
    equal_rows: bool = False,
) -> DataFrame:
    """Scan a table or a query, in one of three ways.

    By ``predicates``, one task each; by ranges of ``partition_column`` (a
    number, date or timestamp), whose outer ranges are open so no row is lost;
    else in one task. Ranges are equally wide, or, with ``equal_rows``, hold as many
    rows, whatever the column's values: the database ranks them first, once, and
    texts will do as well. Further filters on the result reach the database.
    """
    if (table is None) == (query is None):
        raise ValueError("give either a table or a query")
    if predicates and partition_column:
        raise ValueError("give either predicates or a partition column")
    relation = table if query is None else subquery(query)
    log.info("JDBC scan of %s", table or "a query")
    if partition_column and equal_rows:
        bounds = read_quantiles(spark, options, relation, partition_column, num_partitions)
        predicates = range_predicates(partition_column, bounds)

    if predicates:
        properties = {key: value for key, value in options.items() if key != "url"}
        return spark.read.jdbc(
            options["url"], relation, predicates=list(predicates), properties=properties
        )
    reader = spark.read.format("jdbc").options(**options).option("dbtable", relation)
    bounds = partition_column and read_bounds(spark, options, relation, partition_column)
    if bounds:
        reader = reader.options(
            partitionColumn=partition_column,
            lowerBound=_bound(bounds[0], ROUND_FLOOR),
            upperBound=_bound(bounds[1], ROUND_CEILING),
            numPartitions=str(num_partitions),
        )
    return reader.load()
