"""The account transform with currency conversion."""

from pyspark.sql import DataFrame, functions as F

from ledgerflow.functions import account as rule
from ledgerflow.functions.dates import as_date, as_timestamp, days_since, years_since
from ledgerflow.operators.checks import apply_standard_checks, require_schema
from ledgerflow.operators.currency import join_rates
from ledgerflow.schemas import ACCOUNT, ACCOUNT_KEYS, ACCOUNT_OUTPUT, ACCOUNT_REQUIRED

# Fixed value.
RECORD_SOURCE = "SNOWFLAKE_ACCOUNTS"


def transform_account_data(
    raw: DataFrame,
    exchange_rates: DataFrame,
    as_of=None,
    ingested_at=None,
    record_source: str = RECORD_SOURCE,
) -> DataFrame:
    """Checked, derived and published columns, balances also in dollars.

    A foreign balance without a dollar quote is published unconverted;
    ``operators.currency.missing_rates`` lists those accounts.
    """
    accounts = apply_standard_checks(
        require_schema(raw, ACCOUNT, "account"), ACCOUNT_KEYS, ACCOUNT_REQUIRED
    )
    today = as_date(as_of)
    # Currencies are counted on the scan: no fewer than in the checked rows.
    return join_rates(accounts, exchange_rates, counted=raw).withColumns({
        "is_active": rule.is_active(),
        "is_closed": rule.is_closed(),
        "account_age_days": days_since("open_date", today),
        "account_age_years": years_since("open_date", today),
        "usd_current_balance": rule.in_usd("current_balance"),
        "usd_available_balance": rule.in_usd("available_balance"),
        "balance_diff": rule.balance_diff(),
        "is_overdrawn": rule.is_overdrawn(),
        "has_overdraft_protection": rule.has_overdraft_protection(),
        "record_source": F.lit(record_source),
        "ingestion_timestamp": as_timestamp(ingested_at),
    }).select(*ACCOUNT_OUTPUT)
