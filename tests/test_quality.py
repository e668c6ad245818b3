from collections import Counter
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from conftest import plan_text
from ledgerflow.operators.checks import (
    apply_standard_checks, conform, latest_per_key, rejected_rows, validate_schema,
)
from ledgerflow.operators.merge import merge_latest
from ledgerflow.operators.size import shared_folder
from ledgerflow.operators.quality import (
    check_data_freshness, check_for_duplicates, check_for_nulls, quality_report,
)

SCHEMA = "id string, name string, last_updated date"


def frame(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def day(n):
    return date(2024, 1, n)


def test_schema_ignores_nullability_order_and_extra_columns(spark):
    required = StructType().add("b", "string", False).add("a", "integer", False)
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    assert validate_schema(df, required)
    assert not validate_schema(df.drop("b"), required)
    assert not validate_schema(df.withColumn("a", F.lit(1).cast("bigint")), required)


def test_conform_renames_and_casts(spark):
    source = spark.createDataFrame([(7, datetime(2024, 1, 5, 10))], "ID bigint, LAST_UPDATED timestamp")
    schema = StructType().add("id", "string").add("last_updated", "date")
    result = conform(source, schema)
    assert result.schema.fieldNames() == ["id", "last_updated"]
    assert tuple(result.first()) == ("7", day(5))


def test_latest_row_per_key_and_ties(spark):
    df = frame(
        spark, ("a", "x", day(1)), ("a", "y", day(2)), ("a", "x", day(2)), ("a", None, day(2)),
        ("b", "z", None), ("b", "q", day(1)), (None, "n", day(1)),
    )
    kept = {tuple(r) for r in apply_standard_checks(df, ["id"], ["id"]).collect()}
    assert kept == {("a", "x", day(2)), ("b", "q", day(1))}


def test_latest_per_key_keeps_null_keys_as_one(spark):
    df = frame(spark, (None, "n", day(1)), (None, "m", day(2)))
    assert [r.name for r in latest_per_key(df, ["id"], ["last_updated"]).collect()] == ["m"]


def test_each_key_is_cut_to_one_row_before_the_shuffle(spark):
    plan = latest_per_key(frame(spark, ("a", "x", day(1))), ["id"], ["last_updated"])
    text = plan_text(plan)
    before_shuffle = text[text.index("Exchange"):]
    assert "WindowGroupLimit" in before_shuffle and "Partial" in before_shuffle


def brute_force(rows, id_of, complete):
    """Kept and rejected rows, one group at a time."""
    groups = {}
    for row in rows:
        if complete(row):
            groups.setdefault(id_of(row), []).append(row)
    last = lambda r: ((r[2] is None, -(r[2].toordinal() if r[2] else 0)), (r[1] is None, r[1] or ""))
    kept = [min(group, key=last) for group in groups.values()]
    return Counter(kept), Counter(rows) - Counter(kept)


@pytest.mark.parametrize("limit", [10**6, 0])
@pytest.mark.parametrize("required", [["id"], []])
def test_kept_and_rejected_rows_make_up_the_input(spark, limit, required):
    from random import Random

    random = Random(3)
    rows = [
        (
            "hot" if random.random() < 0.4 else random.choice([None, *"abcdefgh"]),
            random.choice([None, "x", "y", "z"]),
            random.choice([None, day(1), day(2), day(3)]),
        )
        for _ in range(600)
    ]
    rows += [("hot", "copy", day(4))] * 50
    df = frame(spark, *rows).repartition(5)
    kept = Counter(tuple(r) for r in apply_standard_checks(df, ["id"], required).collect())
    rejected = Counter()
    for r in rejected_rows(df, ["id"], required, limit=limit).collect():
        rejected[tuple(r)[:3]] += r.copies
        assert r.reason == ("missing_required" if required and r.id is None else "not_latest")
    wanted_kept, wanted_rejected = brute_force(rows, lambda r: r[0], lambda r: not required or r[0] is not None)
    assert kept == wanted_kept
    assert rejected == wanted_rejected
    assert kept + rejected == Counter(rows)
    assert rejected[("hot", "copy", day(4))] == 49


def test_nothing_rejected(spark):
    assert rejected_rows(frame(spark, ("a", "x", day(1))), ["id"], ["id"]).count() == 0


@pytest.mark.parametrize("limit", [10**6, 0])
def test_merge_keeps_the_latest_of_table_and_batch(spark, limit):
    from random import Random

    random = Random(5)

    def some_rows(ids):
        return [(i, random.choice([None, "x", "y"]), random.choice([None, day(1), day(2)])) for i in ids]

    table = some_rows([*map(str, range(60)), None])
    batch = some_rows([*map(str, range(40, 80)), None]) + some_rows(map(str, range(40, 50)))
    merged = merge_latest(frame(spark, *table), frame(spark, *batch), ["id"], ["last_updated"], limit)
    wanted, _ = brute_force(table + batch, lambda r: r[0], lambda r: True)
    assert Counter(tuple(r) for r in merged.collect()) == wanted


def test_merge_of_a_small_batch_leaves_the_table_unshuffled(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, *((str(i), "x", day(1)) for i in range(50))).write.parquet(path)
    table = spark.read.parquet(path)
    plan = plan_text(merge_latest(table, table.limit(3), ["id"], ["last_updated"]))
    kept = plan[plan.index("LeftAnti"):plan.index("Window")]
    assert "BroadcastHashJoin" in plan[:plan.index("LeftAnti")]
    assert "hashpartitioning" not in kept.split("BroadcastExchange")[0]


def test_duplicates_and_nulls(spark):
    df = frame(spark, ("a", "x", day(1)), ("a", "y", None), (None, None, day(1)), (None, "z", day(1)))
    assert check_for_duplicates(df, ["id"]) == 2
    assert check_for_duplicates(df, ["id", "name"]) == 0
    assert check_for_nulls(df, ["id", "name"]) == 3
    assert check_for_nulls(df, []) == 0
    empty = frame(spark)
    assert check_for_duplicates(empty, ["id"]) == check_for_nulls(empty, ["id"]) == 0


@pytest.mark.parametrize("as_of, fresh", [("2024-01-02 00:00:00", True), ("2024-01-02 00:00:01", False)])
def test_freshness_limit_is_inclusive(spark, as_of, fresh):
    df = spark.sql("SELECT TIMESTAMP '2024-01-01 00:00:00' AS ts")
    assert check_data_freshness(df, "ts", 24, as_of) is fresh
    assert check_data_freshness(df.filter("false"), "ts", 24, as_of) is False


def test_report(spark):
    df = frame(spark, ("a", "x", day(1)), ("b", "y", day(2))).withColumn("ts", F.lit("2024-01-03").cast("timestamp"))

    def report(rows):
        return quality_report(rows, ["id"], ["id", "name"], "ts", 24, "2024-01-03 12:00:00").first()

    good = report(df)
    assert good.passed and good.row_count == 2 and good.high_water == day(2)
    assert not report(df.union(df)).passed
    assert report(df.union(df)).duplicate_rows == 2
    assert not report(df.withColumn("name", F.lit(None).cast("string"))).passed
    empty = report(df.filter("false"))
    assert (empty.row_count, empty.duplicate_rows, empty.null_cells, empty.passed) == (0, 0, 0, False)


def test_report_is_one_scan_and_one_keyed_shuffle(spark, tmp_path):
    path = str(tmp_path / "t")
    frame(spark, ("a", "x", day(1))).withColumn("ts", F.lit("2024-01-03").cast("timestamp")).write.parquet(path)
    plan = quality_report(spark.read.parquet(path), ["id"], ["id"], "ts")
    text = plan_text(plan)
    assert text.count("FileScan") == 1
    assert text.count("hashpartitioning") == 1


class Settings:
    """As much of a session as names a shared folder."""

    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_a_cluster_has_to_name_its_shared_folder():
    with pytest.raises(ValueError):
        shared_folder(Settings(spark_master="yarn"))
    assert shared_folder(Settings(spark_master="yarn", spark_checkpoint_dir="s3a://b/c/")) == "s3a://b/c"
    own = shared_folder(Settings(spark_master="local[2]"))
    assert own == shared_folder(Settings(spark_master="local[2]"))
