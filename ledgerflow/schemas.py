"""Declared schemas, keys and required columns of each entity.

A reader can never promise "not null", so nullability is checked as data (see
``operators.checks``) and the schemas here only fix names, order and types.
"""

from pyspark.sql.types import ArrayType, StructType


# The input contract of the customer transform.
CUSTOMER = (
    StructType()
    .add("customer_id", "string")
    .add("first_name", "string")
    .add("last_name", "string")
    .add("date_of_birth", "date")
    .add("ssn", "string")
    .add("email", "string")
    .add("phone_number", "string")
    .add("address_line1", "string")
    .add("address_line2", "string")
    .add("city", "string")
    .add("state", "string")
    .add("zip_code", "string")
    .add("country", "string")
    .add("customer_since", "date")
    .add("segment", "string")
    .add("credit_score", "decimal(5,0)")
    .add("total_assets", "decimal(15,2)")
    .add("kyc_status", "string")
    .add("last_updated", "date")
)

# The input contract of the account transform.
ACCOUNT = (
    StructType()
    .add("account_id", "string")
    .add("customer_id", "string")
    .add("account_type", "string")
    .add("account_subtype", "string")
    .add("open_date", "date")
    .add("close_date", "date")
    .add("status", "string")
    .add("currency_code", "string")
    .add("current_balance", "decimal(20,4)")
    .add("available_balance", "decimal(20,4)")
    .add("hold_balance", "decimal(20,4)")
    .add("interest_rate", "decimal(10,4)")
    .add("overdraft_limit", "decimal(15,2)")
    .add("last_activity_date", "date")
    .add("branch_id", "string")
    .add("primary_holder", "string")
    .add("secondary_holders", "string")
    .add("account_manager", "string")
    .add("last_updated", "timestamp")
)

# The input contract of the currency join.
EXCHANGE_RATE = (
    StructType()
    .add("from_currency", "string")
    .add("to_currency", "string")
    .add("exchange_rate", "decimal(18,8)")
)

# High-water marks; a row with a batch is the commit of a run.
WATERMARK = (
    StructType()
    .add("entity", "string")
    .add("high_water", "timestamp")
    .add("updated_at", "timestamp")
    .add("batch", "string")
    .add("attempt", "long")
    .add("folder", "string")
    .add("source_rows", "long")
    .add("row_count", "long")
    .add("rejected_missing", "long")
    .add("rejected_not_latest", "long")
    .add("rejected_lossy", "long")
    .add("unchanged", "long")
    .add("sequence", "long")
    .add("schema", "string")
    .add("rejected_folder", "string")
    .add("rejected_schema", "string")
    .add("digest_folder", "string")
)

# Commits of snapshots: which batches each holds, and its folders with their schemas.
SNAPSHOT = (
    StructType()
    .add("entity", "string")
    .add("sequence", "long")
    .add("buckets", "integer")
    .add("upto", "string")
    .add("batches", "string")
    .add("folders", ArrayType(StructType().add("bucket", "integer").add("folder", "string").add("schema", "string")))
)

CUSTOMER_KEYS = ["customer_id"]
CUSTOMER_REQUIRED = ["customer_id"]

ACCOUNT_KEYS = ["account_id"]
ACCOUNT_REQUIRED = [
    "account_id", "customer_id", "account_type", "open_date", "status",
    "currency_code", "current_balance", "available_balance",
]

# Names and order of the published columns.
CUSTOMER_OUTPUT = """
    customer_id full_name date_of_birth current_age email phone_number address
    customer_since customer_tenure_years segment credit_score credit_rating
    total_assets is_high_value kyc_status is_kyc_complete last_updated
    record_source ingestion_timestamp
""".split()

ACCOUNT_OUTPUT = """
    account_id customer_id account_type account_subtype open_date close_date
    is_active is_closed account_age_days account_age_years status currency_code
    current_balance available_balance hold_balance usd_current_balance
    usd_available_balance balance_diff interest_rate overdraft_limit
    is_overdrawn has_overdraft_protection last_activity_date branch_id
    primary_holder secondary_holders account_manager last_updated
    record_source ingestion_timestamp
""".split()
