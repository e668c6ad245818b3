"""Currency conversion, account rules, and the whole profile."""

from ledgerflow.functions import account as rule
from ledgerflow.functions.dates import as_date, days_since, years_since
from ledgerflow.operators.currency import join_rates, missing_rates
from ledgerflow.plans.account import transform_account_data
from ledgerflow.queries.inputs import AS_OF, STAMP, derived, oracle

QUOTED = ("account_id", "currency_code", "to_currency", "exchange_rate")


def _accounts(spark, sf_dir):
    return derived(spark, sf_dir, "accounts_raw")


def _fx_join(spark, sf_dir):
    rates = derived(spark, sf_dir, "exchange_rates")
    return join_rates(_accounts(spark, sf_dir), rates).select(*QUOTED)


def _fx_join_all_quotes(spark, sf_dir):
    quotes = derived(spark, sf_dir, "all_quotes")
    return join_rates(_accounts(spark, sf_dir), quotes, all_quotes=True).select(*QUOTED)


def _usd_balance(spark, sf_dir):
    rates = derived(spark, sf_dir, "exchange_rates")
    return join_rates(_accounts(spark, sf_dir), rates).select(
        "account_id", "currency_code",
        rule.in_usd("current_balance").alias("usd_current_balance"),
        rule.in_usd("available_balance").alias("usd_available_balance"),
    )


def _flags(spark, sf_dir):
    return _accounts(spark, sf_dir).select(
        "account_id", "status", "close_date", "available_balance", "overdraft_limit",
        rule.is_active().alias("is_active"),
        rule.is_closed().alias("is_closed"),
        rule.is_overdrawn().alias("is_overdrawn"),
        rule.has_overdraft_protection().alias("has_overdraft_protection"),
    )


def _age(spark, sf_dir):
    today = as_date(AS_OF)
    return _accounts(spark, sf_dir).select(
        "account_id", "open_date",
        days_since("open_date", today).alias("account_age_days"),
        years_since("open_date", today).alias("account_age_years"),
    )


def _balance_diff(spark, sf_dir):
    return _accounts(spark, sf_dir).select("account_id", rule.balance_diff().alias("balance_diff"))


def _missing_rate(spark, sf_dir):
    rates = derived(spark, sf_dir, "exchange_rates")
    return missing_rates(_accounts(spark, sf_dir), rates).select(
        "account_id", "currency_code", "current_balance"
    )


def profile(spark, sf_dir):
    rates = derived(spark, sf_dir, "exchange_rates")
    return transform_account_data(_accounts(spark, sf_dir), rates, AS_OF, STAMP)


USD_QUOTES_SQL = "(SELECT * FROM exchange_rates WHERE to_currency = 'USD') q"
JOIN_SQL = f"FROM accounts_raw LEFT JOIN {USD_QUOTES_SQL} ON currency_code = from_currency"
FLAGS_SQL = """status = 'ACTIVE' AS is_active, close_date IS NOT NULL AS is_closed,
  available_balance < 0 AS is_overdrawn, overdraft_limit > 0 AS has_overdraft_protection"""
DAYS_SQL = f"CAST(date_diff('day', open_date, DATE '{AS_OF}') AS INTEGER)"
AGE_SQL = f"{DAYS_SQL} AS account_age_days, {DAYS_SQL} / CAST(365.25 AS DOUBLE) AS account_age_years"
DIFF_SQL = "current_balance - available_balance AS balance_diff"


def _usd_sql(balance):
    return f"""CAST(CASE WHEN to_currency = 'USD' THEN CAST({balance} * exchange_rate AS DECIMAL(38,8))
    ELSE {balance} END AS DECIMAL(38,8)) AS usd_{balance}"""


USD_SQL = f"{_usd_sql('current_balance')}, {_usd_sql('available_balance')}"

PROFILE_SQL = f"""
SELECT account_id, customer_id, account_type, account_subtype, open_date, close_date,
  status, currency_code, current_balance, available_balance, hold_balance,
  interest_rate, overdraft_limit, last_activity_date, branch_id, primary_holder,
  secondary_holders, account_manager, last_updated,
  {FLAGS_SQL}, {AGE_SQL}, {USD_SQL}, {DIFF_SQL},
  'SNOWFLAKE_ACCOUNTS' AS record_source, TIMESTAMP '{STAMP}' AS ingestion_timestamp
{JOIN_SQL}"""

QUERIES = {
    "account_fx_join": (
        _fx_join,
        oracle(f"SELECT account_id, currency_code, to_currency, exchange_rate {JOIN_SQL}"),
    ),
    "account_fx_join_all_quotes": (
        _fx_join_all_quotes,
        oracle("""SELECT account_id, currency_code, to_currency, exchange_rate
FROM accounts_raw LEFT JOIN all_quotes ON currency_code = from_currency"""),
    ),
    "account_usd_balance": (
        _usd_balance,
        oracle(f"SELECT account_id, currency_code, {USD_SQL} {JOIN_SQL}"),
    ),
    "account_flags": (
        _flags,
        oracle(f"""SELECT account_id, status, close_date, available_balance, overdraft_limit,
  {FLAGS_SQL} FROM accounts_raw"""),
    ),
    "account_age": (_age, oracle(f"SELECT account_id, open_date, {AGE_SQL} FROM accounts_raw")),
    "account_balance_diff": (
        _balance_diff,
        oracle(f"SELECT account_id, {DIFF_SQL} FROM accounts_raw"),
    ),
    "account_missing_rate": (
        _missing_rate,
        oracle("""SELECT account_id, currency_code, current_balance FROM accounts_raw
WHERE currency_code <> 'USD' AND currency_code NOT IN
  (SELECT from_currency FROM exchange_rates WHERE to_currency = 'USD')"""),
    ),
    "account_profile": (profile, oracle(PROFILE_SQL)),
}
