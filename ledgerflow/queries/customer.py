"""Customer rules one by one, and the whole profile."""

from ledgerflow.functions import customer as rule
from ledgerflow.functions.dates import as_date, whole_years_since
from ledgerflow.plans.customer import transform_customer_data, with_vip
from ledgerflow.queries.inputs import AS_OF, STAMP, derived, oracle


def _column(name, expression, *inputs):
    """A query giving the customer, the inputs of one rule and its result."""
    def run(spark, sf_dir):
        customers = derived(spark, sf_dir, "customers_raw")
        return customers.select("customer_id", *inputs, expression().alias(name))

    return run


def profile(spark, sf_dir):
    return transform_customer_data(derived(spark, sf_dir, "customers_raw"), AS_OF, STAMP)


def vip_profile(spark, sf_dir):
    return with_vip(profile(spark, sf_dir))


def _vip(spark, sf_dir):
    return vip_profile(spark, sf_dir).select(
        "customer_id", "total_assets", "credit_rating", "is_vip"
    )


RATING_SQL = """CASE WHEN credit_score >= 800 THEN 'Excellent'
    WHEN credit_score >= 740 THEN 'Very Good'
    WHEN credit_score >= 670 THEN 'Good'
    WHEN credit_score >= 580 THEN 'Fair' ELSE 'Poor' END"""


def _years_sql(column):
    return f"CAST(floor(date_diff('day', {column}, DATE '{AS_OF}') / 365.25) AS BIGINT)"


NAME_SQL = "first_name || ' ' || last_name"
ADDRESS_SQL = "concat_ws(', ', address_line1, address_line2, city, state, zip_code, country)"
VIP_SQL = f"coalesce(total_assets >= 500000 AND ({RATING_SQL}) IN ('Excellent', 'Very Good'), false)"

PROFILE_SQL = f"""
SELECT customer_id, {NAME_SQL} AS full_name, date_of_birth,
  {_years_sql('date_of_birth')} AS current_age, email, phone_number,
  {ADDRESS_SQL} AS address, customer_since,
  {_years_sql('customer_since')} AS customer_tenure_years, segment, credit_score,
  {RATING_SQL} AS credit_rating, total_assets,
  coalesce(total_assets >= 1000000, false) AS is_high_value, kyc_status,
  kyc_status = 'COMPLETE' AS is_kyc_complete, last_updated,
  'ORACLE_CUSTOMERS' AS record_source, TIMESTAMP '{STAMP}' AS ingestion_timestamp
FROM customers_raw"""

VIP_PROFILE_SQL = PROFILE_SQL.replace("FROM customers_raw", f", {VIP_SQL} AS is_vip FROM customers_raw")


def _select(columns):
    return oracle(f"SELECT customer_id, {columns} FROM customers_raw")


QUERIES = {
    "customer_full_name": (
        _column("full_name", rule.full_name, "first_name", "last_name"),
        _select(f"first_name, last_name, {NAME_SQL} AS full_name"),
    ),
    "customer_age": (
        _column("current_age", lambda: whole_years_since("date_of_birth", as_date(AS_OF)), "date_of_birth"),
        _select(f"date_of_birth, {_years_sql('date_of_birth')} AS current_age"),
    ),
    "customer_address": (
        _column("address", rule.address),
        _select(f"{ADDRESS_SQL} AS address"),
    ),
    "customer_high_value": (
        _column("is_high_value", rule.is_high_value, "total_assets"),
        _select("total_assets, coalesce(total_assets >= 1000000, false) AS is_high_value"),
    ),
    "customer_credit_rating": (
        _column("credit_rating", rule.credit_rating, "credit_score"),
        _select(f"credit_score, {RATING_SQL} AS credit_rating"),
    ),
    "customer_tenure": (
        _column(
            "customer_tenure_years",
            lambda: whole_years_since("customer_since", as_date(AS_OF)),
            "customer_since",
        ),
        _select(f"customer_since, {_years_sql('customer_since')} AS customer_tenure_years"),
    ),
    "customer_kyc": (
        _column("is_kyc_complete", rule.is_kyc_complete, "kyc_status"),
        _select("kyc_status, kyc_status = 'COMPLETE' AS is_kyc_complete"),
    ),
    "customer_vip": (
        _vip,
        _select(f"total_assets, {RATING_SQL} AS credit_rating, {VIP_SQL} AS is_vip"),
    ),
    "customer_profile": (profile, oracle(PROFILE_SQL)),
}
