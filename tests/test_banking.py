from unittest.mock import patch

import pytest

from ledgerflow.plans import banking
from ledgerflow.plans.loads import read_table, run_load
from test_account import RATES, accounts, rates
from test_sources import ORACLE, S3, SNOWFLAKE, RecordingSession

CONFIG = {"oracle": ORACLE, "snowflake": SNOWFLAKE, "aws": S3}


def test_customers_are_split_by_the_hash_of_their_id():
    session = RecordingSession()
    banking.customers_from_oracle(session, CONFIG, partitions=4).source()
    call, = session.calls
    assert call["table"] == "customers" and len(call["predicates"]) == 4
    assert all("ORA_HASH(customer_id)" in p for p in call["predicates"])


def test_customers_are_split_as_the_caller_says():
    session = RecordingSession()
    pieces = ["created < DATE '2020-01-01'", "created >= DATE '2020-01-01'"]
    banking.customers_from_oracle(session, CONFIG, table="crm.customers", predicates=pieces).source()
    call, = session.calls
    assert (call["table"], call["predicates"]) == ("crm.customers", pieces)
    with patch.object(banking, "read_jdbc_table") as read:
        banking.customers_from_oracle(session, CONFIG, partition_column="created", partitions=40).source()
    assert read.call_args.kwargs == {"predicates": None, "partition_column": "created", "num_partitions": 40}


def test_settings_reach_both_loads():
    with patch.object(banking, "run_all") as run_all, patch.object(banking, "read_jdbc_table") as jdbc, \
            patch.object(banking, "read_warehouse_table") as warehouse:
        banking.run_banking(
            None, CONFIG, customers={"table": "c", "partitions": 3}, accounts={"accounts": "a", "fmt": "f"},
            ingested_at="2024-01-01 08:00:00",
        )
        customers, accounts = run_all.call_args.args[1]
        customers.source()
        accounts.source()
    assert run_all.call_args.args[3] == "2024-01-01 08:00:00"
    assert jdbc.call_args.args[2] == "c" and len(jdbc.call_args.kwargs["predicates"]) == 3
    assert warehouse.call_args.args[2] == "a" and warehouse.call_args.kwargs == {"fmt": "f"}


def test_accounts_and_rates_come_from_the_warehouse(spark, lake):
    tables = {"accounts": accounts(spark, {}), "exchange_rates": rates(spark, RATES)}
    with patch.object(banking, "read_warehouse_table", lambda spark, options, table, fmt: tables[table]):
        load = banking.accounts_from_snowflake(spark, CONFIG)
        run_load(spark, load, lake, "2024-01-01 08:00:00")
    assert read_table(spark, lake, load).first().usd_current_balance == 110


def test_all_loads_run_in_order_into_the_bucket(spark):
    with patch.object(banking, "run_all") as run_all:
        banking.run_banking(spark, CONFIG, "further")
    _, loads, base_uri, _ = run_all.call_args.args
    assert [getattr(load, "entity", load) for load in loads] == ["customers", "accounts", "further"]
    assert base_uri == "s3a://b"


def test_missing_settings_stop_before_any_load(spark):
    with pytest.raises(ValueError):
        banking.run_banking(spark, {**CONFIG, "oracle": {}})
