"""The customer transform."""

from pyspark.sql import DataFrame, functions as F

from ledgerflow.functions import customer as rule
from ledgerflow.functions.dates import as_date, as_timestamp, whole_years_since
from ledgerflow.operators.checks import apply_standard_checks, require_schema
from ledgerflow.schemas import (
    CUSTOMER, CUSTOMER_KEYS, CUSTOMER_OUTPUT, CUSTOMER_REQUIRED,
)

# Fixed value.
RECORD_SOURCE = "ORACLE_CUSTOMERS"


def transform_customer_data(
    raw: DataFrame, as_of=None, ingested_at=None, record_source: str = RECORD_SOURCE
) -> DataFrame:
    """Checked, derived and published columns; raw personal fields are dropped.

    ``ValueError`` on a frame that does not match the declared schema. The
    row checks run on the declared columns before anything is derived.
    """
    customers = apply_standard_checks(
        require_schema(raw, CUSTOMER, "customer"), CUSTOMER_KEYS, CUSTOMER_REQUIRED
    )
    today = as_date(as_of)
    return customers.withColumns({
        "full_name": rule.full_name(),
        "current_age": whole_years_since("date_of_birth", today),
        "address": rule.address(),
        "is_high_value": rule.is_high_value(),
        "credit_rating": rule.credit_rating(),
        "customer_tenure_years": whole_years_since("customer_since", today),
        "is_kyc_complete": rule.is_kyc_complete(),
        "record_source": F.lit(record_source),
        "ingestion_timestamp": as_timestamp(ingested_at),
    }).select(*CUSTOMER_OUTPUT)


def with_vip(customers: DataFrame) -> DataFrame:
    """The job's own last column, from the transformed ones."""
    return customers.withColumn("is_vip", rule.is_vip())
