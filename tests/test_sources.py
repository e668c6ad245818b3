"""Options and reader calls; no database is started.

The database scans are checked against a recording reader and, as far as it
goes without a driver on the class path, against Spark's own.
"""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import (
    DataSource, DataSourceReader, DataSourceWriter, InputPartition, WriterCommitMessage,
)

from conftest import plan_text
from ledgerflow.operators.ranges import equal_row_bounds
from ledgerflow.queries import QUERIES
from ledgerflow.sinks.warehouse import write_warehouse_table
from ledgerflow.sources.jdbc import (
    bounds_query, modulo_predicates, oracle_options, quantile_query, range_predicates, read_bounds,
    read_jdbc_table, subquery,
)
from ledgerflow.sources.lake import bucket_uri, lake_path, s3a_options
from ledgerflow.sources.warehouse import read_warehouse_table, snowflake_options

# Settings as the loads are given them.
ORACLE = {
    "host": "test-host", "port": "1521", "service_name": "test_service",
    "username": "test_user", "password": "test_pass",
    "read_timeout": 60000, "connect_timeout": 10000,
}
SNOWFLAKE = {
    "account": "acme", "username": "u", "password": "p",
    "database": "d", "schema": "s", "warehouse": "w",
}
S3 = {"s3_bucket": "b", "aws_access_key_id": "k", "aws_secret_access_key": "s"}


class RecordingSession:
    """Stands in for a session; keeps what its readers were asked for."""

    def __init__(self, bounds=None):
        self.bounds, self.calls = bounds, []

    @property
    def read(self):
        return RecordingReader(self)


class RecordingReader:
    def __init__(self, session):
        self.session, self.asked = session, {}

    def format(self, name):
        return self.option("format", name)

    def option(self, key, value):
        self.asked[key] = value
        return self

    def options(self, **options):
        self.asked.update(options)
        return self

    def load(self):
        self.session.calls.append(self.asked)
        return self

    def jdbc(self, url, table, **arguments):
        properties = arguments.pop("properties")
        return self.options(url=url, table=table, **arguments, **properties).load()

    def first(self):
        return self.session.bounds

    def collect(self):
        return [(k, bound) for k, bound in enumerate(self.session.bounds, start=1)]


def test_oracle_options():
    options = oracle_options(ORACLE)
    assert options["url"] == "jdbc:oracle:thin:@test-host:1521/test_service"
    assert (options["user"], options["password"]) == ("test_user", "test_pass")
    assert options["oracle.jdbc.readTimeout"] == "60000"
    assert options["oracle.net.CONNECT_TIMEOUT"] == "10000"
    assert int(options["fetchsize"]) > 10
    more = oracle_options({**ORACLE, "options": {"fetchsize": "500", "sessionInitStatement": "x"}})
    assert (more["fetchsize"], more["sessionInitStatement"]) == ("500", "x")


def test_snowflake_options():
    options = snowflake_options(SNOWFLAKE)
    assert options["sfURL"] == "acme.snowflakecomputing.com"
    assert (options["sfRole"], options["sfCompress"], options["sfSSL"]) == ("", "on", "on")
    assert snowflake_options({**SNOWFLAKE, "role": "r"})["sfRole"] == "r"


def test_s3a_options():
    options = s3a_options(S3)
    assert options["spark.hadoop.fs.s3a.access.key"] == "k"
    assert options["spark.hadoop.fs.s3a.multipart.size"] == "104857600"
    assert options["spark.hadoop.fs.s3a.fast.upload.buffer"] == "disk"
    assert bucket_uri(S3) == "s3a://b"
    keyless = s3a_options({"s3_bucket": "b", "credentials_provider": "x.Y"})
    assert keyless["spark.hadoop.fs.s3a.aws.credentials.provider"] == "x.Y"
    assert not any("key" in option for option in keyless)


@pytest.mark.parametrize("build, config", [
    (oracle_options, ORACLE), (snowflake_options, SNOWFLAKE), (s3a_options, S3),
])
def test_each_required_setting(build, config):
    with pytest.raises(ValueError):
        build({})
    for key in set(config) - {"read_timeout", "connect_timeout"}:
        with pytest.raises(ValueError, match=key):
            build({k: v for k, v in config.items() if k != key})


def test_paths_join_with_one_slash():
    assert lake_path("s3a://b/", "/banking/customers/") == "s3a://b/banking/customers"


def test_full_scan():
    session = RecordingSession()
    read_jdbc_table(session, oracle_options(ORACLE), "customers")
    call, = session.calls
    assert call["format"] == "jdbc" and call["dbtable"] == "customers"
    assert "partitionColumn" not in call


@pytest.mark.parametrize("bounds, texts", [
    ((1, 100), ("1", "100")),
    ((Decimal("1.5000000000"), Decimal("99.0000000001")), ("1", "100")),
    ((date(2023, 1, 1), date(2024, 1, 1)), ("2023-01-01", "2024-01-01")),
    ((datetime(2023, 1, 1), datetime(2024, 1, 1, 1)), ("2023-01-01 00:00:00", "2024-01-01 01:00:00")),
])
def test_range_scan(bounds, texts):
    session = RecordingSession(bounds)
    read_jdbc_table(session, oracle_options(ORACLE), "t", partition_column="id")
    lookup, scan = session.calls
    assert lookup["query"] == "SELECT MIN(id) AS min_val, MAX(id) AS max_val FROM t"
    assert scan["partitionColumn"] == "id" and scan["numPartitions"] == "10"
    assert (scan["lowerBound"], scan["upperBound"]) == texts
    assert "query" not in scan


def test_range_scan_of_an_empty_table_is_not_partitioned():
    session = RecordingSession((None, None))
    read_jdbc_table(session, oracle_options(ORACLE), "t", partition_column="id")
    assert "partitionColumn" not in session.calls[-1]
    assert read_bounds(session, {}, "t", "id") is None


def test_query_scan_in_ranges():
    session = RecordingSession((1, 9))
    read_jdbc_table(session, oracle_options(ORACLE), query="SELECT * FROM t", partition_column="id", num_partitions=3)
    lookup, scan = session.calls
    assert scan["dbtable"] == "(SELECT * FROM t) tmp" and scan["numPartitions"] == "3"
    assert lookup["query"].endswith("FROM (SELECT * FROM t) tmp")


def test_predicate_scan():
    session = RecordingSession()
    read_jdbc_table(session, oracle_options(ORACLE), "t", predicates=["a = 1", "a <> 1"])
    call, = session.calls
    assert call["predicates"] == ["a = 1", "a <> 1"]
    assert call["url"].startswith("jdbc:oracle") and call["user"] == "test_user"


@pytest.mark.parametrize("arguments", [
    {}, {"table": "t", "query": "q"}, {"table": "t", "predicates": ["p"], "partition_column": "c"},
])
def test_contradicting_arguments(arguments):
    with pytest.raises(ValueError):
        read_jdbc_table(RecordingSession(), oracle_options(ORACLE), **arguments)


def test_predicates_cover_every_row_once(spark):
    rows = spark.range(-50, 51).withColumn("k", F.when(F.col("id") % 7 != 0, F.col("id")))
    parts = [rows.filter(p).select("id") for p in modulo_predicates("k", 4)]
    ids = [r.id for part in parts for r in part.collect()]
    assert sorted(ids) == list(range(-50, 51))


def test_secrets_are_not_logged(caplog):
    caplog.set_level("DEBUG")
    read_jdbc_table(RecordingSession((1, 2)), oracle_options(ORACLE), "t", partition_column="id")
    assert "test_pass" not in caplog.text and "t" in caplog.text


@pytest.mark.parametrize("arguments", [
    {"table": "t"}, {"query": "SELECT 1 FROM t"}, {"table": "t", "predicates": ["a = 1"]},
])
def test_spark_takes_the_options_up_to_the_missing_driver(spark, arguments):
    with pytest.raises(Exception, match="oracle.jdbc.OracleDriver"):
        read_jdbc_table(spark, oracle_options(ORACLE), **arguments)


def test_missing_warehouse_connector_is_named(spark):
    with pytest.raises(Exception, match="net.snowflake.spark.snowflake"):
        read_warehouse_table(spark, snowflake_options(SNOWFLAKE), "t")


def stub_warehouse(folder):
    """A data source that answers like a warehouse, one text file per write task."""

    class Reader(DataSourceReader):
        def __init__(self, options):
            self.wanted = options.get("query") or options.get("dbtable")

        def partitions(self):
            return [InputPartition(i) for i in range(2)]

        def read(self, partition):
            yield (self.wanted, partition.value)

    class Writer(DataSourceWriter):
        def __init__(self, options):
            self.table = options["dbtable"]

        def write(self, rows):
            import os, uuid
            os.makedirs(f"{folder}/{self.table}", exist_ok=True)
            with open(f"{folder}/{self.table}/{uuid.uuid4().hex}", "w") as file:
                file.writelines(f"{row.id}\n" for row in rows)
            return WriterCommitMessage()

    class Warehouse(DataSource):
        @classmethod
        def name(cls):
            return "stub_warehouse"

        def schema(self):
            return "wanted string, part int"

        def reader(self, schema):
            return Reader(self.options)

        def writer(self, schema, overwrite):
            return Writer(self.options)

    return Warehouse


def test_warehouse_scans_and_writes_go_through_the_format(spark, tmp_path):
    spark.dataSource.register(stub_warehouse(str(tmp_path)))
    options = snowflake_options(SNOWFLAKE)

    by_table = read_warehouse_table(spark, options, "accounts", fmt="stub_warehouse").collect()
    assert sorted(map(tuple, by_table)) == [("accounts", 0), ("accounts", 1)]
    query = "SELECT * FROM accounts"
    by_query = read_warehouse_table(spark, options, "accounts", query, fmt="stub_warehouse").collect()
    assert {r.wanted for r in by_query} == {query}

    for _ in range(2):
        write_warehouse_table(spark.range(10, numPartitions=3), options, "out", fmt="stub_warehouse")
    lines = [line for file in (tmp_path / "out").iterdir() for line in file.read_text().split()]
    assert sorted(map(int, lines)) == sorted([*range(10)] * 2)


def test_subquery_and_bounds_text():
    assert bounds_query(subquery("SELECT 1"), "c") == "SELECT MIN(c) AS min_val, MAX(c) AS max_val FROM (SELECT 1) tmp"


def test_ranges_of_equally_many_rows(spark):
    """Disjoint and exhaustive over nulls and ties; no part has more than a piece besides one value's rows."""
    keys = [None] * 30 + [5] * 400 + [k * k for k in range(400)] + [10**12] * 3
    rows = spark.createDataFrame([(k,) for k in keys], "k long")
    for parts in (1, 2, 7, 40):
        bounds = [r["bound"] for r in spark.sql(quantile_query("{t}", "k", parts), t=rows).collect()]
        predicates = range_predicates("k", bounds)
        assert sum(rows.filter(p).count() for p in predicates) == len(keys)
        for predicate in predicates:
            held = [r.k for r in rows.filter(predicate).collect() if r.k is not None]
            assert len(held) - held.count(min(held)) <= -(-803 // parts)
    assert range_predicates("k", []) == range_predicates("k", [None]) == range_predicates("k", [3, 3]) == ["1 = 1"]


def test_bounds_by_ranges_are_those_of_the_pushed_ranking(spark):
    """Nulls, ties over several pieces, more pieces than rows; whole numbers, texts and days."""
    keys = [None] * 30 + [5] * 400 + [k * k % 997 - 99 for k in range(700)] + [10**12] * 3
    rows = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    for kind in ("k", "CAST(k AS STRING)", "DATE '2020-01-01' + CAST(k % 5000 AS INT)"):
        typed = rows.select(F.expr(kind).alias("k")).cache()
        for parts in (1, 2, 7, 40, 3000):
            ranked = spark.sql(f"{quantile_query('{t}', 'k', parts)} ORDER BY piece", t=typed).collect()
            assert equal_row_bounds(typed, "k", parts) == [r["bound"] for r in ranked]
    assert equal_row_bounds(rows.filter("k IS NULL"), "k", 4) == []


def test_no_task_ranks_all_rows(spark, monkeypatch):
    plans = []
    frame = type(spark.range(1))
    collect = frame.collect
    monkeypatch.setattr(frame, "collect", lambda df: plans.append(plan_text(df)) or collect(df))
    QUERIES["jdbc_quantile_predicates"][0](spark, "/root/testdata/sf0.001").collect()
    assert any("Window" in p for p in plans) and not any("SinglePartition" in p for p in plans)


def test_literals_of_ranges():
    cuts = [Decimal("1E+3"), Decimal("0.10")]
    assert range_predicates("c", cuts) == ["c < 1000 OR c IS NULL", "c >= 1000"]
    assert range_predicates("c", ["a", "o'b"])[1] == "c >= 'o''b'"
    assert range_predicates("c", [date(2024, 1, 1), date(2024, 2, 1)])[1] == "c >= DATE '2024-02-01'"
    assert range_predicates("c", [datetime(2024, 1, 1), datetime(2024, 2, 1, 3)])[1] == "c >= TIMESTAMP '2024-02-01 03:00:00'"


def test_a_scan_by_equally_many_rows_ranks_once():
    session = RecordingSession(bounds=[1, 4, 4, 9])
    read_jdbc_table(session, oracle_options(ORACLE), "t", partition_column="id", num_partitions=4, equal_rows=True)
    ranked, scan = session.calls
    assert ranked["query"] == quantile_query("t", "id", 4) and "NTILE(4)" in ranked["query"]
    assert scan["predicates"] == ["id < 4 OR id IS NULL", "id >= 4 AND id < 9", "id >= 9"]
