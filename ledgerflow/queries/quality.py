"""Row checks and table checks over customers with repeated and null keys."""

from pyspark.sql import functions as F

from ledgerflow.operators import checks, quality
from ledgerflow.queries.inputs import derived, oracle

KEYS = ["customer_id"]
REQUIRED = ["customer_id", "kyc_status"]
# A newest change on 2024-01-01 against this hour: 23 hours old.
AS_OF = "2024-01-01 23:00:00"
HOURS = 24


def _dirty(spark, sf_dir):
    return derived(spark, sf_dir, "customers_dirty")


def _valid(spark, sf_dir):
    return checks.apply_standard_checks(_dirty(spark, sf_dir), KEYS, REQUIRED)


def _rejected(spark, sf_dir):
    return checks.rejected_rows(_dirty(spark, sf_dir), KEYS, REQUIRED)


def _duplicates(spark, sf_dir):
    return quality.duplicates(_dirty(spark, sf_dir), KEYS)


def _nulls(spark, sf_dir):
    return quality.nulls(_dirty(spark, sf_dir), REQUIRED)


def _freshness(spark, sf_dir):
    changed = _dirty(spark, sf_dir).select(F.col("last_updated").cast("timestamp").alias("ts"))
    return quality.freshness(changed, "ts", HOURS, AS_OF)


def report(spark, sf_dir):
    rows = _dirty(spark, sf_dir).withColumn("ts", F.col("last_updated").cast("timestamp"))
    return quality.quality_report(rows, KEYS, REQUIRED, "ts", HOURS, AS_OF)


MARKED_SQL = """marked AS (
  SELECT *, CASE WHEN customer_id IS NULL OR kyc_status IS NULL THEN 'missing_required'
    WHEN row_number() OVER (
      PARTITION BY customer_id IS NULL OR kyc_status IS NULL, customer_id
      ORDER BY last_updated DESC NULLS LAST, segment NULLS LAST, kyc_status NULLS LAST) > 1
    THEN 'not_latest' END AS reason
  FROM customers_dirty)"""

DUPLICATES_SQL = """(SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM
  (SELECT count(*) AS n FROM customers_dirty GROUP BY customer_id))"""
NULLS_SQL = """CAST(count(*) FILTER (customer_id IS NULL)
  + count(*) FILTER (kyc_status IS NULL) AS BIGINT)"""
LATEST_SQL = "CAST(max(last_updated) AS TIMESTAMP)"
FRESH_SQL = f"coalesce({LATEST_SQL} >= TIMESTAMP '{AS_OF}' - INTERVAL {HOURS} HOUR, false)"


QUERIES = {
    "dq_standard_valid": (
        _valid,
        oracle(f"""SELECT customer_id, segment, kyc_status, last_updated
FROM (WITH {MARKED_SQL} SELECT * FROM marked) WHERE reason IS NULL"""),
    ),
    "dq_standard_rejected": (
        _rejected,
        oracle(f"""SELECT customer_id, segment, kyc_status, last_updated, reason, count(*) AS copies
FROM (WITH {MARKED_SQL} SELECT * FROM marked) WHERE reason IS NOT NULL
GROUP BY customer_id, segment, kyc_status, last_updated, reason"""),
    ),
    "dq_duplicates": (_duplicates, oracle(f"SELECT {DUPLICATES_SQL} AS duplicate_rows")),
    "dq_nulls": (_nulls, oracle(f"SELECT {NULLS_SQL} AS null_cells FROM customers_dirty")),
    "dq_freshness": (
        _freshness,
        oracle(f"SELECT {LATEST_SQL} AS latest, {FRESH_SQL} AS is_fresh FROM customers_dirty"),
    ),
    "dq_report": (
        report,
        oracle(f"""SELECT *, duplicate_rows = 0 AND null_cells = 0 AND is_fresh AS passed FROM (
  SELECT count(*) AS row_count, {DUPLICATES_SQL} AS duplicate_rows, {NULLS_SQL} AS null_cells,
    {LATEST_SQL} AS latest, max(last_updated) AS high_water, {FRESH_SQL} AS is_fresh
  FROM customers_dirty)"""),
    ),
}
