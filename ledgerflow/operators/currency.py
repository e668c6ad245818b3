"""Accounts joined with exchange quotes."""

from pyspark.sql import DataFrame, functions as F

from ledgerflow.functions.account import HOME_CURRENCY
from ledgerflow.operators.checks import require_schema
from ledgerflow.operators.size import BROADCAST_BYTES, broadcast_bytes, kept_aside
from ledgerflow.schemas import EXCHANGE_RATE


def usd_quotes(rates: DataFrame) -> DataFrame:
    """One dollar quote per currency; a second one fails the query."""
    quotes = require_schema(rates, EXCHANGE_RATE, "exchange rate")
    clash = F.concat(F.lit("several dollar quotes for "), "from_currency")
    return (
        quotes.filter((F.col("to_currency") == HOME_CURRENCY) & F.col("from_currency").isNotNull())
        .groupBy("from_currency")
        .agg(F.count("*").alias("n"), F.max("exchange_rate").alias("rate"))
        .select(
            "from_currency",
            F.lit(HOME_CURRENCY).alias("to_currency"),
            F.when(F.col("n") == 1, F.col("rate")).otherwise(F.raise_error(clash)).alias("exchange_rate"),
        )
    )


def hot_currencies(accounts: DataFrame, parts: int) -> DataFrame:
    """``_hot, _salts``: currencies with more than one of ``parts`` equal shares of the accounts.

    There are fewer than ``parts`` of them, whatever the data. Each comes with the
    number of parts its accounts should be spread over. The counts are taken once, on
    shared storage, so that all readers agree on them; the driver sees their sum.
    """
    counts = accounts.groupBy("currency_code").agg(F.count("*").alias("n"))
    counts = kept_aside(counts, "currency-counts")
    total = counts.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total")).first()["total"]
    hot = counts.filter(F.col("currency_code").isNotNull() & (F.col("n") * parts > total))
    return hot.select(
        F.col("currency_code").alias("_hot"),
        F.ceil(F.col("n") * parts / F.lit(max(total, 1))).cast("int").alias("_salts"),
    )


def spread_join(
    accounts: DataFrame, quotes: DataFrame, how: str, counted: DataFrame | None = None
) -> DataFrame:
    """Shuffled join on (currency, salt).

    Few currencies hold most accounts. Each hot one is spread over as many
    salts as its share of the shuffle partitions and its quotes are repeated
    for each; all others keep one salt, so the quotes hardly grow. The salt
    of an account follows from its task and key, hence is the same on a retry.

    ``counted`` are rows with at least the currencies of ``accounts``, for instance
    the scan they come from, to count without running the plan of ``accounts``.
    """
    spark = accounts.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    # Fewer rows than shuffle partitions.
    hot = F.broadcast(hot_currencies(accounts if counted is None else counted, parts))
    nowhere = F.when(F.col("currency_code").isNull(), parts)  # matches no quote anyway
    salts = F.coalesce(F.col("_salts"), nowhere, F.lit(1))
    row_salt = F.pmod(F.xxhash64(F.spark_partition_id(), "account_id"), salts)
    every_salt = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)

    salted = (
        accounts.join(hot, F.col("currency_code") == F.col("_hot"), "left")
        .select(accounts["*"], row_salt.cast("int").alias("_salt"))
    )
    repeated = (
        quotes.join(hot, F.col("from_currency") == F.col("_hot"), "left")
        .select(quotes["*"], F.explode(every_salt).alias("_quote_salt"))
    )
    same = (F.col("currency_code") == F.col("from_currency")) & (F.col("_salt") == F.col("_quote_salt"))
    return salted.join(repeated, same, how).drop("_salt", "_quote_salt")


def join_quotes(
    accounts: DataFrame,
    quotes: DataFrame,
    how: str = "left",
    limit: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Equi-join on the account currency.

    Quotes measured within ``limit`` bytes are broadcast and the accounts stay
    where they are; beyond it both sides are shuffled.
    """
    if broadcast_bytes(quotes) > limit:
        return spread_join(accounts, quotes, how, counted)
    same_currency = F.col("currency_code") == F.col("from_currency")
    return accounts.join(F.broadcast(quotes), same_currency, how)


def join_rates(
    accounts: DataFrame,
    rates: DataFrame,
    all_quotes: bool = False,
    limit: int = BROADCAST_BYTES,
    counted: DataFrame | None = None,
) -> DataFrame:
    """Every account with its dollar quote, or null where there is none.

    ``all_quotes`` joins every quote of the currency instead, so an account
    comes back once per quote.
    """
    quotes = require_schema(rates, EXCHANGE_RATE, "exchange rate") if all_quotes else usd_quotes(rates)
    return join_quotes(accounts, quotes, "left", limit, counted)


def missing_rates(
    accounts: DataFrame, rates: DataFrame, limit: int = BROADCAST_BYTES
) -> DataFrame:
    """Accounts whose balances stay unconverted although they are not dollars."""
    foreign = accounts.filter(F.col("currency_code") != HOME_CURRENCY)
    return join_quotes(foreign, usd_quotes(rates), "left_anti", limit)
