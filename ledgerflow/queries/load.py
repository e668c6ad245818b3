"""Incremental loads into a new lake on the shared storage."""

from dataclasses import replace

from pyspark.sql import functions as F

from ledgerflow.plans import loads
from ledgerflow.plans.incremental import (
    changed_since, high_waters, read_marks, read_watermark, update_watermark,
)
from ledgerflow.plans.snapshots import read_current, take_snapshot
from ledgerflow.queries import account, customer
from ledgerflow.queries.inputs import AS_OF, LATER, NEXT_DAY, STAMP, derived, oracle, scratch, table

SINCE = "2023-12-25"
THIRD_DAY = "2024-01-03 00:00:00"
LOOKBACK = 10


def _customers(spark, sf_dir, block="customers_raw"):
    return loads.customer_load(lambda: derived(spark, sf_dir, block), AS_OF)


def _accounts(spark, sf_dir):
    return loads.account_load(
        lambda: derived(spark, sf_dir, "accounts_raw"),
        lambda: derived(spark, sf_dir, "exchange_rates"),
        AS_OF,
    )


def _transactions(spark, sf_dir):
    events = table(spark, sf_dir, "events")
    return loads.transaction_load(
        lambda: events, events.schema, keys=["event_id"], required=["event_id", "ts"], updated="ts"
    )


def _load(spark, name, load):
    base = scratch(spark, name)
    loads.run_load(spark, load, base, STAMP)
    return loads.read_table(spark, base, load)


def load_customers(spark, sf_dir):
    return _load(spark, "load_customers", _customers(spark, sf_dir))


def load_accounts(spark, sf_dir):
    return _load(spark, "load_accounts", _accounts(spark, sf_dir))


def _load_transactions(spark, sf_dir):
    return _load(spark, "load_transactions", _transactions(spark, sf_dir))


def _two_batches(spark, sf_dir, name, second, between=lambda spark, load, base: None):
    """A first batch, then one of the same source some time later, when rows have moved."""
    base = scratch(spark, name)
    loads.run_load(spark, _customers(spark, sf_dir), base, STAMP)
    between(spark, _customers(spark, sf_dir), base)
    load = _customers(spark, sf_dir, "customers_second")
    report = loads.run_load(spark, load, base, second)
    return base, load, report


def _load_twice(spark, sf_dir):
    """A second batch on the same day with changed rows, seen as latest rows."""
    base, load, _ = _two_batches(spark, sf_dir, "load_customers_twice", LATER)
    return loads.current_rows(loads.read_table(spark, base, load), load.keys)


def _current(spark, sf_dir):
    """Two ingestion days, the second one incremental, seen as latest rows."""
    base, load, _ = _two_batches(spark, sf_dir, "customer_current", NEXT_DAY)
    return loads.current_rows(loads.read_table(spark, base, load), load.keys)


def _current_report(spark, sf_dir):
    """The checks over the latest rows of two batches."""
    base, load, _ = _two_batches(spark, sf_dir, "dq_current_report", LATER)
    return loads.current_report(loads.read_table(spark, base, load), load, LATER)


def _load_again(spark, sf_dir):
    """A run repeated with its time stamp after the source changed: the second one holds."""
    base = scratch(spark, "load_customers_again")
    loads.run_load(spark, _customers(spark, sf_dir), base, STAMP)
    load = _customers(spark, sf_dir, "customers_second")
    loads.run_load(spark, load, base, STAMP)
    return loads.read_table(spark, base, load)


def _schema_change(spark, sf_dir):
    """Three batches, the second one with a column more, the third one with a column less."""
    base = scratch(spark, "load_schema_change")
    first, second = _customers(spark, sf_dir), _customers(spark, sf_dir, "customers_second")
    loads.run_load(spark, first, base, STAMP)
    wider = lambda rows, stamp: second.transform(rows, stamp).withColumn("is_risk", F.col("credit_rating") == "Poor")
    loads.run_load(spark, replace(second, transform=wider), base, NEXT_DAY)
    narrower = lambda rows, stamp: second.transform(rows, stamp).drop("segment")
    loads.run_load(spark, replace(second, transform=narrower), base, THIRD_DAY)
    return loads.read_table(spark, base, first)


def _unchanged(spark, sf_dir):
    """A batch, the same source again, which writes nothing, and the source with moved rows."""
    base = scratch(spark, "load_unchanged")
    for stamp, block in ((STAMP, "customers_raw"), (LATER, "customers_raw"), (NEXT_DAY, "customers_second")):
        load = replace(_customers(spark, sf_dir, block), changed_only=True, lookback_days=LOOKBACK)
        loads.run_load(spark, load, base, stamp)
    return loads.read_table(spark, base, load)


def _late(spark, sf_dir):
    """A batch without every thirteenth customer, who then arrive with their old change dates."""
    base = scratch(spark, "incremental_late")
    for stamp, late in ((STAMP, 0), (LATER, 1)):
        load = _customers(spark, sf_dir)
        rows = load.source().filter((F.col("customer_id").cast("bigint") % 13 != 0) | F.lit(bool(late)))
        loads.run_load(spark, replace(load, source=lambda rows=rows: rows, changed_only=True, lookback_days=LOOKBACK), base, stamp)
    return loads.read_table(spark, base, load)


def _snapshot(spark, sf_dir):
    """The latest rows from a snapshot of the first batch and the second batch."""
    base, load, _ = _two_batches(spark, sf_dir, "customer_snapshot", NEXT_DAY, take_snapshot)
    return read_current(spark, base, load)


def _snapshot_again(spark, sf_dir):
    """The latest rows of two batches from the second of two snapshots alone."""
    base, load, _ = _two_batches(spark, sf_dir, "customer_snapshot_again", NEXT_DAY, take_snapshot)
    take_snapshot(spark, load, base)
    return read_current(spark, base, load)


def _bad(spark, sf_dir, name):
    base = scratch(spark, name)
    load = _customers(spark, sf_dir, "customers_bad")
    return base, load, loads.run_load(spark, load, base, STAMP)


def _load_rejected(spark, sf_dir):
    """What a load of bad rows leaves out, as it keeps them."""
    base, load, _ = _bad(spark, sf_dir, "load_customers_rejected")
    return loads.read_rejected(spark, base, load.entity).drop("batch")


COUNTS = ["row_count", "source_rows", "rejected_missing", "rejected_not_latest", "rejected_lossy", "duplicate_rows", "null_cells"]


def _report_row(spark, report, columns):
    """The numbers of a report, which a load returns to the driver, as one row."""
    numbers = [F.lit(report[c]).cast("bigint").alias(c) for c in columns]
    return spark.range(1).select(*numbers, F.lit(report["passed"]).alias("passed"))


def _load_report(spark, sf_dir):
    return _report_row(spark, _bad(spark, sf_dir, "load_report")[2], COUNTS)


def _accounts_report(spark, sf_dir):
    """Missing rates beside the counts of an account load."""
    report = loads.run_load(spark, _accounts(spark, sf_dir), scratch(spark, "load_accounts_report"), STAMP)
    return _report_row(spark, report, [*COUNTS, "missing_rates"])


# What of each entity's rows the joint result shows.
SHOWN = {
    "customers": ("customer_id", "segment", "total_assets"),
    "accounts": ("account_id", "currency_code", "usd_current_balance"),
    "transactions": ("event_id", "event_type", "value"),
}


def _run_all(spark, sf_dir):
    base = scratch(spark, "run_all_loads")
    every = [build(spark, sf_dir) for build in (_customers, _accounts, _transactions)]
    loads.run_all(spark, every, base, STAMP, at_once=3)
    rows = [
        loads.read_table(spark, base, load).select(
            F.lit(load.entity).alias("entity"), F.col(key).cast("string").alias("key"), F.col(kind).alias("kind"),
            F.col(amount).cast("decimal(38,4)").alias("amount"), "ingestion_timestamp", "ingestion_date")
        for load in every for key, kind, amount in [SHOWN[load.entity]]
    ]
    return rows[0].union(rows[1]).union(rows[2])


def _watermark_update(spark, sf_dir):
    """The table after one load of each entity, read back as a table."""
    base = scratch(spark, "watermark_update")
    for build in (_customers, _accounts):
        loads.run_load(spark, build(spark, sf_dir), base, STAMP)
    return high_waters(read_marks(spark, f"{base}/{loads.WATERMARKS}"))


def _watermark_read(spark, sf_dir):
    """The rows at or after a mark that two updates, the later one older, left."""
    path = f"""{scratch(spark, "watermark_read")}/watermarks"""
    for mark in (SINCE, "2023-12-05"):
        update_watermark(spark, path, "customers", mark, STAMP)
    mark = read_watermark(spark, path, "customers")
    customers = derived(spark, sf_dir, "customers_raw")
    return changed_since(customers, "last_updated", mark).select(
        "customer_id", "last_updated", F.lit(mark).cast("timestamp").alias("high_water")
    )


def _incremental(spark, sf_dir):
    return changed_since(derived(spark, sf_dir, "customers_raw"), "last_updated", SINCE)


def _full(spark, sf_dir):
    return changed_since(derived(spark, sf_dir, "customers_raw"), "last_updated", None)


DAY_SQL = f", DATE '{AS_OF}' AS ingestion_date "
CUSTOMERS_SQL = customer.VIP_PROFILE_SQL.replace("FROM customers_raw", DAY_SQL + "FROM customers_raw")

SECOND_SQL = CUSTOMERS_SQL.replace("FROM customers_raw", "FROM customers_second")


def _second_batch_sql(stamp):
    """The second batch holds the moved rows and those of the day of the first one's mark."""
    return f"""SELECT * EXCLUDE (newest) REPLACE (
  CASE WHEN last_updated >= newest THEN TIMESTAMP '{stamp}' ELSE ingestion_timestamp END AS ingestion_timestamp,
  CASE WHEN last_updated >= newest THEN DATE '{stamp[:10]}' ELSE ingestion_date END AS ingestion_date)
FROM ({SECOND_SQL}), (SELECT max(last_updated) AS newest FROM customers_raw)"""


SCHEMA_CHANGE_SQL = f"""SELECT *, CAST(NULL AS BOOLEAN) AS is_risk FROM ({CUSTOMERS_SQL})
UNION ALL SELECT * REPLACE (TIMESTAMP '{NEXT_DAY}' AS ingestion_timestamp, DATE '{NEXT_DAY[:10]}' AS ingestion_date), credit_rating = 'Poor' AS is_risk
FROM ({SECOND_SQL}) WHERE last_updated >= (SELECT max(last_updated) FROM customers_raw)
UNION ALL SELECT * REPLACE (TIMESTAMP '{THIRD_DAY}' AS ingestion_timestamp, DATE '{THIRD_DAY[:10]}' AS ingestion_date, NULL AS segment), NULL AS is_risk
FROM ({SECOND_SQL}) WHERE last_updated >= (SELECT max(last_updated) FROM customers_second)"""
UNCHANGED_SQL = f"""SELECT * FROM ({CUSTOMERS_SQL})
UNION ALL SELECT * REPLACE (TIMESTAMP '{NEXT_DAY}' AS ingestion_timestamp, DATE '{NEXT_DAY[:10]}' AS ingestion_date)
FROM ({SECOND_SQL}) WHERE CAST(customer_id AS BIGINT) % 10 = 0"""
LATE_SQL = f"""SELECT * FROM ({CUSTOMERS_SQL}) WHERE CAST(customer_id AS BIGINT) % 13 <> 0
UNION ALL SELECT * REPLACE (TIMESTAMP '{LATER}' AS ingestion_timestamp, DATE '{LATER[:10]}' AS ingestion_date)
FROM ({CUSTOMERS_SQL}) WHERE CAST(customer_id AS BIGINT) % 13 = 0 AND last_updated >= (
  SELECT max(last_updated) - {LOOKBACK} FROM customers_raw WHERE CAST(customer_id AS BIGINT) % 13 <> 0)"""

MARKED_SQL = """SELECT *, CASE WHEN customer_id IS NULL THEN 'missing_required'
  WHEN row_number() OVER (PARTITION BY customer_id ORDER BY last_updated DESC, segment) > 1 THEN 'not_latest' END AS reason
FROM customers_bad"""
REJECTED_SQL = f"SELECT *, count(*) AS copies FROM ({MARKED_SQL}) WHERE reason IS NOT NULL GROUP BY ALL"
REPORT_SQL = f"""SELECT count(*) FILTER (reason IS NULL) AS row_count, count(*) AS source_rows,
  count(*) FILTER (reason = 'missing_required') AS rejected_missing, count(*) FILTER (reason = 'not_latest') AS rejected_not_latest,
  CAST(0 AS BIGINT) AS rejected_lossy, CAST(0 AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS null_cells, true AS passed
FROM ({MARKED_SQL})"""
ACCOUNTS_REPORT_SQL = """SELECT count(*) AS row_count, count(*) AS source_rows, CAST(0 AS BIGINT) AS rejected_missing,
  CAST(0 AS BIGINT) AS rejected_not_latest, CAST(0 AS BIGINT) AS rejected_lossy, CAST(0 AS BIGINT) AS duplicate_rows,
  CAST(0 AS BIGINT) AS null_cells, count(*) FILTER (currency_code <> 'USD' AND currency_code NOT IN (
    SELECT from_currency FROM exchange_rates WHERE to_currency = 'USD')) AS missing_rates, true AS passed
FROM accounts_raw"""

QUERIES = {
    "watermark_read": (
        _watermark_read,
        oracle(f"""SELECT customer_id, last_updated, TIMESTAMP '{SINCE} 00:00:00' AS high_water
FROM customers_raw WHERE last_updated >= DATE '{SINCE}'"""),
    ),
    "watermark_update": (
        _watermark_update,
        oracle("""SELECT 'customers' AS entity, CAST(max(last_updated) AS TIMESTAMP) AS high_water
FROM customers_raw UNION ALL
SELECT 'accounts', max(last_updated) FROM accounts_raw"""),
    ),
    "incremental_extract": (
        _incremental,
        oracle(f"SELECT * FROM customers_raw WHERE last_updated >= DATE '{SINCE}'"),
    ),
    "full_extract": (_full, oracle("SELECT * FROM customers_raw")),
    "load_customers": (load_customers, oracle(CUSTOMERS_SQL)),
    "load_customers_twice": (_load_twice, oracle(_second_batch_sql(LATER))),
    "load_customers_again": (_load_again, oracle(SECOND_SQL)),
    "load_schema_change": (_schema_change, oracle(SCHEMA_CHANGE_SQL)),
    "load_unchanged": (_unchanged, oracle(UNCHANGED_SQL)),
    "incremental_late": (_late, oracle(LATE_SQL)),
    "customer_snapshot": (_snapshot, oracle(_second_batch_sql(NEXT_DAY))),
    "customer_snapshot_again": (_snapshot_again, oracle(_second_batch_sql(NEXT_DAY))),
    "load_customers_rejected": (_load_rejected, oracle(REJECTED_SQL)),
    "load_report": (_load_report, oracle(REPORT_SQL)),
    "load_accounts_report": (_accounts_report, oracle(ACCOUNTS_REPORT_SQL)),
    "dq_current_report": (
        _current_report,
        oracle(f"""SELECT count(*) AS row_count, CAST(0 AS BIGINT) AS duplicate_rows, CAST(0 AS BIGINT) AS null_cells,
  TIMESTAMP '{LATER}' AS latest, DATE '2024-01-01' AS high_water, true AS is_fresh, true AS passed FROM customers_second"""),
    ),
    "customer_current": (_current, oracle(_second_batch_sql(NEXT_DAY))),
    "load_accounts": (
        load_accounts,
        oracle(account.PROFILE_SQL.replace(account.JOIN_SQL, DAY_SQL + account.JOIN_SQL)),
    ),
    "load_transactions": (
        _load_transactions,
        f"SELECT *, TIMESTAMP '{STAMP}' AS ingestion_timestamp{DAY_SQL}FROM events",
    ),
    "run_all_loads": (
        _run_all,
        oracle(f"""SELECT entity, key, kind, CAST(amount AS DECIMAL(38,4)) AS amount,
  TIMESTAMP '{STAMP}' AS ingestion_timestamp, DATE '{AS_OF}' AS ingestion_date FROM (
SELECT 'customers' AS entity, customer_id AS key, segment AS kind, CAST(total_assets AS DECIMAL(38,4)) AS amount FROM customers_raw
UNION ALL SELECT 'accounts', account_id, currency_code, usd_current_balance FROM ({account.PROFILE_SQL})
UNION ALL SELECT 'transactions', CAST(event_id AS VARCHAR), event_type, value FROM events)"""),
    ),
}
