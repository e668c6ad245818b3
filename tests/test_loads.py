from dataclasses import replace
from datetime import date, datetime
from decimal import Decimal
from unittest.mock import patch

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import plan_text
from ledgerflow.plans import loads
from ledgerflow.plans.incremental import changed_since, read_watermark, update_watermark
from ledgerflow.plans.loads import (
    WATERMARKS, ValidationFailed, account_load, batch_of, committed, current_rows, customer_load,
    read_rejected, read_table, run_all, run_load, transaction_load,
)
from ledgerflow.schemas import ACCOUNT, CUSTOMER, EXCHANGE_RATE
from ledgerflow.sources.lake import lake_path
from test_account import BASE as ACCOUNT_ROW, RATES
from test_customer import BASE as CUSTOMER_ROW

FIRST = "2024-01-01 08:00:00"
LATER = "2024-01-01 20:00:00"
NEXT = "2024-01-02 08:00:00"


def customers(spark, days, segment="OLD"):
    rows = [
        tuple({**CUSTOMER_ROW, "customer_id": f"C{d}", "segment": segment, "last_updated": date(2023, 12, d)}.values())
        for d in days
    ]
    return spark.createDataFrame(rows, CUSTOMER)


def mark(spark, lake, entity="customers"):
    return read_watermark(spark, lake_path(lake, WATERMARKS), entity)


def published(spark, lake, entity="customers"):
    """What readers of a table see."""
    return committed(spark, lake, entity, f"banking/{entity}")


def test_first_load(spark, lake):
    load = customer_load(lambda: customers(spark, range(1, 11)))
    assert mark(spark, lake) is None
    report = run_load(spark, load, lake, FIRST)
    assert (report.row_count, report.passed) == (10, True)
    assert mark(spark, lake) == "2023-12-10 00:00:00"
    table = published(spark, lake)
    assert table.columns[-2:] == ["is_vip", "ingestion_date"]
    row = table.first()
    assert row.ingestion_date == date(2024, 1, 1)
    assert row.ingestion_timestamp == datetime(2024, 1, 1, 8)
    assert row.current_age == 43


def test_running_twice_changes_nothing(spark, lake):
    load = customer_load(lambda: customers(spark, range(1, 11)))
    def rows():
        latest = current_rows(published(spark, lake), ["customer_id"])
        return sorted(map(str, latest.drop("ingestion_timestamp").collect()))

    run_load(spark, load, lake, FIRST)
    before = rows()
    run_load(spark, load, lake, FIRST)
    assert published(spark, lake).count() == 10
    report = run_load(spark, load, lake, LATER)
    assert report.passed and rows() == before


def test_two_batches_on_one_day_are_merged(spark, lake):
    run_load(spark, customer_load(lambda: customers(spark, range(1, 11))), lake, FIRST)
    more = customers(spark, [10, 11, 12], "NEW").union(
        customers(spark, [13], "NEW").withColumn("customer_id", F.lit("C3"))
    )
    report = run_load(spark, customer_load(lambda: more), lake, LATER)
    latest = current_rows(published(spark, lake), ["customer_id"])
    segments = {r.customer_id: r.segment for r in latest.collect()}
    assert report.row_count == 4 and len(segments) == 12
    assert [segments[c] for c in ("C1", "C3", "C10", "C11", "C12")] == ["OLD", "NEW", "NEW", "NEW", "NEW"]
    assert mark(spark, lake) == "2023-12-13 00:00:00"


def test_incremental_load_on_another_day(spark, lake):
    run_load(spark, customer_load(lambda: customers(spark, range(1, 11))), lake, FIRST)
    report = run_load(spark, customer_load(lambda: customers(spark, range(1, 13), "NEW")), lake, NEXT)
    assert report.row_count == 3  # the day of the mark is read again
    table = published(spark, lake)
    assert table.count() == 13
    current = {r.customer_id: r.segment for r in current_rows(table, ["customer_id"]).collect()}
    assert len(current) == 12
    assert {c for c, s in current.items() if s == "NEW"} == {"C10", "C11", "C12"}


EVENT = StructType().add("id", "long").add("kind", "string").add("ts", "timestamp")


def events(spark, n):
    ts = F.timestamp_seconds(F.lit(1_700_000_000) + F.col("id"))
    return spark.range(n).select("id", F.lit("k").alias("kind"), ts.alias("ts"))


def event_load(spark, n=5, broken=False):
    blank = lambda rows: rows.withColumn("kind", F.lit(None).cast("string"))
    extra = {"transform": blank} if broken else {}
    return transaction_load(lambda: events(spark, n), EVENT, ["id"], ["id", "kind"], "ts", **extra)


def test_failed_check_leaves_the_mark(spark, lake):
    with pytest.raises(ValidationFailed):
        run_load(spark, event_load(spark, broken=True), lake, FIRST)
    assert mark(spark, lake, "transactions") is None
    assert run_load(spark, event_load(spark), lake, LATER).passed
    assert mark(spark, lake, "transactions") is not None
    assert published(spark, lake, "transactions").filter("kind IS NULL").count() == 0


def test_failed_merge_leaves_the_day(spark, lake):
    run_load(spark, event_load(spark), lake, FIRST)
    before = mark(spark, lake, "transactions")
    with pytest.raises(ValidationFailed):
        run_load(spark, event_load(spark, 9, broken=True), lake, LATER)
    table = published(spark, lake, "transactions")
    assert table.count() == 5 and table.filter("kind IS NULL").count() == 0
    assert mark(spark, lake, "transactions") == before


def test_nothing_that_fails_is_seen(spark, lake):
    with pytest.raises(ValidationFailed):
        run_load(spark, event_load(spark, 9, broken=True), lake, FIRST)
    assert published(spark, lake, "transactions") is None
    with pytest.raises(LookupError):
        read_table(spark, lake, event_load(spark))
    # A corrected batch without some of the failed one's keys.
    assert run_load(spark, event_load(spark, 5), lake, LATER).row_count == 5
    assert published(spark, lake, "transactions").count() == 5


def test_a_run_that_dies_before_its_commit_loses_nothing(spark, lake):
    run_load(spark, customer_load(lambda: customers(spark, range(1, 11))), lake, FIRST)
    more = customer_load(lambda: customers(spark, range(1, 13), "NEW"))
    with patch.object(loads, "update_watermark", side_effect=RuntimeError("lost driver")), pytest.raises(RuntimeError):
        run_load(spark, more, lake, LATER)
    assert published(spark, lake).count() == 10
    assert mark(spark, lake) == "2023-12-10 00:00:00"
    assert run_load(spark, more, lake, LATER).row_count == 3
    assert published(spark, lake).count() == 13


def test_a_rerun_with_the_same_stamp_takes_the_place_of_the_first(spark, lake):
    run_load(spark, customer_load(lambda: customers(spark, range(1, 11))), lake, FIRST)
    run_load(spark, customer_load(lambda: customers(spark, range(1, 11), "NEW")), lake, FIRST)
    assert {r.segment for r in published(spark, lake).collect()} == {"NEW"}
    assert published(spark, lake).count() == 10
    # Also when a later batch has moved the mark.
    run_load(spark, customer_load(lambda: customers(spark, range(1, 13))), lake, LATER)
    run_load(spark, customer_load(lambda: customers(spark, range(1, 11), "AGAIN")), lake, FIRST)
    segments = {r.customer_id: r.segment for r in current_rows(published(spark, lake), ["customer_id"]).collect()}
    assert (segments["C1"], segments["C10"], segments["C12"]) == ("AGAIN", "OLD", "OLD")


def test_rejected_rows_are_counted_and_kept(spark, lake):
    nameless = customers(spark, [3, 4]).withColumn("customer_id", F.lit(None).cast("string"))
    rows = customers(spark, [1, 2]).union(customers(spark, [1, 2])).union(nameless)
    report = run_load(spark, customer_load(lambda: rows), lake, FIRST)
    assert (report.source_rows, report.row_count, report.rejected_missing, report.rejected_not_latest) == (6, 2, 2, 2)
    kept = read_rejected(spark, lake, "customers").groupBy("reason").agg(F.sum("copies").alias("n")).collect()
    assert {r.reason: r.n for r in kept} == {"missing_required": 2, "not_latest": 2}


def test_clean_rows_leave_no_rejected_table(spark, lake):
    run_load(spark, customer_load(lambda: customers(spark, [1, 2])), lake, FIRST)
    assert read_rejected(spark, lake, "customers") is None


def test_too_many_rejected_rows_fail_the_load(spark, lake):
    rows = customers(spark, [1, 2]).union(customers(spark, [3]).withColumn("customer_id", F.lit(None).cast("string")))
    load = replace(customer_load(lambda: rows), most_rejected=0.1)
    with pytest.raises(ValidationFailed, match="banking/rejected/customers/batch=") as failed:
        run_load(spark, load, lake, FIRST)
    assert published(spark, lake) is None
    assert read_rejected(spark, lake, "customers") is None  # nothing was committed
    folder = str(failed.value).rsplit(" ", 1)[1]
    assert spark.read.parquet(lake_path(lake, folder)).count() == 1


def test_values_that_do_not_fit_are_rejected(spark, lake):
    rows = customers(spark, [1, 2, 3]).withColumn("total_assets", F.lit("999999.996").cast("decimal(20,6)"))
    rows = rows.withColumn("total_assets", F.when(F.col("customer_id") == "C1", F.col("total_assets")).otherwise(F.lit(10)).cast("decimal(20,6)"))
    report = run_load(spark, customer_load(lambda: rows), lake, FIRST)
    assert (report.row_count, report.rejected_lossy) == (2, 1)
    kept, = read_rejected(spark, lake, "customers").collect()
    assert kept.reason == "lossy_cast" and kept.total_assets == Decimal("999999.996000")


def test_a_missing_column_is_named(spark, lake):
    with pytest.raises(ValueError, match="segment"):
        run_load(spark, customer_load(lambda: customers(spark, [1]).drop("segment")), lake, FIRST)


def test_rows_without_a_change_date_come_with_every_batch(spark, lake):
    undated = customers(spark, [3]).withColumn("last_updated", F.lit(None).cast("date"))
    run_load(spark, customer_load(lambda: customers(spark, [1, 2])), lake, FIRST)
    report = run_load(spark, customer_load(lambda: customers(spark, [1, 2]).union(undated)), lake, LATER)
    assert report.row_count == 2  # the day of the mark, and the undated row
    assert current_rows(published(spark, lake), ["customer_id"]).count() == 3


def test_the_whole_table_is_checked_on_demand(spark, lake):
    load = replace(customer_load(lambda: customers(spark, [1, 2])), check_table=True)
    assert run_load(spark, load, lake, FIRST).table_rows == 2
    more = replace(customer_load(lambda: customers(spark, [2, 3])), check_table=True)
    assert run_load(spark, more, lake, LATER).table_rows == 3


def test_missing_rates_are_reported(spark, lake):
    account = spark.createDataFrame([tuple({**ACCOUNT_ROW, "currency_code": "XXX"}.values())], ACCOUNT)
    rates = spark.createDataFrame(RATES, EXCHANGE_RATE)
    assert run_load(spark, account_load(lambda: account, lambda: rates), lake, FIRST).missing_rates == 1


def test_batches_are_in_the_order_of_their_stamps():
    stamps = ["2024-01-01 08:00:00", "2024-01-01 08:00:00.5", "2024-01-01 20:00:00", "2024-01-02 00:00:00"]
    assert sorted(map(batch_of, stamps)) == list(map(batch_of, stamps))


def test_warning_instead_of_failure(spark, lake, caplog):
    load = replace(event_load(spark, broken=True), raise_on_failure=False)
    assert run_load(spark, load, lake, FIRST).null_cells == 5
    assert mark(spark, lake, "transactions") is None
    assert "5 nulls in required columns" in caplog.text


def test_empty_batch_is_not_fresh(spark, lake):
    with pytest.raises(ValidationFailed):
        run_load(spark, event_load(spark, 0), lake, FIRST)
    assert mark(spark, lake, "transactions") is None


def test_accounts_and_the_order_of_all_loads(spark, lake):
    account = spark.createDataFrame([tuple(ACCOUNT_ROW.values())], ACCOUNT)
    rates = spark.createDataFrame(RATES, EXCHANGE_RATE)
    every = [
        customer_load(lambda: customers(spark, [1])),
        account_load(lambda: account, lambda: rates),
        event_load(spark),
    ]
    reports = run_all(spark, every, lake, FIRST)
    assert list(reports) == ["customers", "accounts", "transactions"]
    assert published(spark, lake, "accounts").first().usd_current_balance == Decimal(110)


def test_first_failure_stops_the_rest(spark, lake):
    with pytest.raises(ValidationFailed):
        run_all(spark, [event_load(spark, broken=True), customer_load(lambda: customers(spark, [1]))], lake, FIRST)
    assert mark(spark, lake) is None


def test_source_names_and_types_are_conformed(spark, lake):
    upper = customers(spark, [1, 2]).withColumn("last_updated", F.col("last_updated").cast("timestamp"))
    upper = upper.select(*(F.col(c).alias(c.upper()) for c in upper.columns))
    assert run_load(spark, customer_load(lambda: upper), lake, FIRST).row_count == 2


def test_mark_is_the_greatest_and_per_entity(spark, tmp_path):
    path = str(tmp_path / "marks")
    assert read_watermark(spark, path, "a") is None
    for entity, value in (("a", "2024-01-05"), ("a", "2024-01-03 12:00:00.5"), ("b", "2024-01-03 12:00:00.5")):
        update_watermark(spark, path, entity, value)
    assert read_watermark(spark, path, "a") == "2024-01-05 00:00:00"
    assert read_watermark(spark, path, "b") == "2024-01-03 12:00:00.5"
    assert read_watermark(spark, path, "c") is None


def test_unreadable_marks_are_not_a_first_load(spark, tmp_path):
    path = tmp_path / "marks"
    path.mkdir()
    (path / "part.parquet").write_text("not parquet")
    with pytest.raises(Exception):
        read_watermark(spark, str(path), "a")


@pytest.mark.parametrize("kind, value", [("date", "2024-01-05"), ("timestamp", "2024-01-05 00:00:00")])
def test_change_filter_is_inclusive_and_reaches_the_scan(spark, tmp_path, kind, value):
    path = str(tmp_path / "t")
    day = F.date_add(F.lit("2024-01-01").cast("date"), F.col("id").cast("int"))
    spark.range(10).select("id", day.cast(kind).alias("changed")).write.parquet(path)
    source = spark.read.parquet(path)
    result = changed_since(source, "changed", value)
    assert sorted(r.id for r in result.collect()) == list(range(4, 10))
    assert "GreaterThanOrEqual(changed,2024-01-05" in plan_text(result)
    assert changed_since(source, "changed", None).count() == 10


def test_marks_and_days_follow_the_session_time_zone(spark, lake):
    zone = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        load = event_load(spark)
        run_load(spark, load, lake, "2024-01-01 23:30:00")
        # 1_700_000_004 seconds after the epoch, five hours west of Greenwich.
        assert mark(spark, lake, "transactions") == "2023-11-14 17:13:24"
        assert run_load(spark, load, lake, "2024-01-02 00:30:00").row_count == 1
        days = published(spark, lake, load.entity).groupBy("ingestion_date").count()
        counts = {str(r.ingestion_date): r["count"] for r in days.collect()}
        assert counts == {"2024-01-01": 5, "2024-01-02": 1}
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)


def test_run_time_defaults_to_now(spark, lake):
    report = run_load(spark, event_load(spark), lake)
    assert report.passed
    row = published(spark, lake, "transactions").first()
    assert row.ingestion_date == row.ingestion_timestamp.date()
