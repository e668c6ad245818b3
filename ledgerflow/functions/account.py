"""Account rules: one column expression each, all inside whole-stage codegen."""

from pyspark.sql import Column, functions as F

# The reporting currency and the status of a running account.
HOME_CURRENCY = "USD"
RUNNING = "ACTIVE"

# (20,4) x (17,8) needs exactly 38 digits, so the product is never rounded on
# the way; a quote of a thousand million or more raises instead.
EXACT_RATE = "decimal(17,8)"
USD_AMOUNT = "decimal(38,8)"


def is_active() -> Column:
    return F.col("status") == RUNNING


def is_closed() -> Column:
    return F.col("close_date").isNotNull()


def in_usd(balance: str) -> Column:
    """The balance at its dollar quote, unchanged where there is none."""
    converted = F.col(balance) * F.col("exchange_rate").cast(EXACT_RATE)
    quoted = F.col("to_currency") == HOME_CURRENCY
    return F.when(quoted, converted).otherwise(F.col(balance)).cast(USD_AMOUNT)


def balance_diff() -> Column:
    return F.col("current_balance") - F.col("available_balance")


def is_overdrawn() -> Column:
    return F.col("available_balance") < 0


def has_overdraft_protection() -> Column:
    return F.col("overdraft_limit") > 0
