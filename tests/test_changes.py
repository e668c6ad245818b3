"""Loads over time: new columns, rejected rows, unchanged and late rows, overlapping runs."""

import random
import threading
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import plan_text
from ledgerflow.operators.evolution import SchemaChanged, merged_schema, shaped
from ledgerflow.plans import loads
from ledgerflow.plans.incremental import SequenceTaken, changed_since, commit_path, update_watermark
from ledgerflow.plans.loads import (
    WATERMARKS, ValidationFailed, current_rows, customer_load, read_rejected, read_table, run_all, run_load,
)
from ledgerflow.plans.snapshots import bucket_of, read_current, take_snapshot
from ledgerflow.plans import snapshots
from ledgerflow.sources.lake import lake_path
from test_loads import FIRST, LATER, NEXT, customers, event_load, events, mark, published

THIRD = "2024-01-03 08:00:00"


def with_column(load, name, value):
    inner = load.transform
    return replace(load, transform=lambda rows, stamp: inner(rows, stamp).withColumn(name, value))


def without_column(load, name):
    inner = load.transform
    return replace(load, transform=lambda rows, stamp: inner(rows, stamp).drop(name))


# Columns that come and go

def test_new_and_missing_columns_lose_nothing(spark, lake):
    def load(days):
        return replace(customer_load(lambda: customers(spark, days)), check_table=True)

    run_load(spark, load([1, 2]), lake, FIRST)
    report = run_load(spark, with_column(load([3, 4]), "risk", F.lit(7)), lake, LATER)
    assert report.table_rows == 4
    report = run_load(spark, without_column(load([5]), "segment"), lake, NEXT)
    assert report.table_rows == 5
    rows = {r.customer_id: (r.segment, r.risk, str(r.ingestion_date)) for r in read_table(spark, lake, load([])).collect()}
    first, second = (None, "2024-01-01"), (7, "2024-01-01")
    assert rows == {"C1": ("OLD", *first), "C2": ("OLD", *first), "C3": ("OLD", *second), "C4": ("OLD", *second), "C5": (None, None, "2024-01-02")}
    assert current_rows(read_table(spark, lake, load([])), ["customer_id"]).count() == 5


def test_a_changed_type_is_refused_before_anything_is_written(spark, lake):
    load = customer_load(lambda: customers(spark, [1, 2]))
    run_load(spark, load, lake, FIRST)
    with pytest.raises(SchemaChanged, match="segment"):
        run_load(spark, with_column(load, "segment", F.lit(1)), lake, LATER)
    assert published(spark, lake).count() == 2
    # A run that takes the place of the only batch with the old type may change it.
    run_load(spark, with_column(load, "segment", F.lit(1)), lake, FIRST)
    assert {r.segment for r in published(spark, lake).collect()} == {1}


def test_merged_schemas(spark):
    a = spark.createDataFrame([(1, "x")], "k int, T string")
    b = spark.createDataFrame([(2, 3.0)], "K int, u double")
    whole = merged_schema([a.schema, b.schema])
    assert whole.simpleString() == "struct<k:int,T:string,u:double>"
    assert [tuple(r) for r in shaped(b, whole).collect()] == [(2, None, 3.0)]
    with pytest.raises(SchemaChanged):
        merged_schema([a.schema, b.withColumn("t", F.lit(1)).schema])
    assert merged_schema([a.schema, b.withColumn("t", F.lit(1)).schema], as_text=True)["T"].dataType.simpleString() == "string"


# Rejected rows

def dirty(spark, days, nameless=2):
    blank = customers(spark, [9] * nameless).withColumn("customer_id", F.lit(None).cast("string"))
    return customers(spark, days).union(customers(spark, days)).union(blank)


def copies(spark, lake):
    return {r.reason: r.n for r in read_rejected(spark, lake, "customers").groupBy("reason").agg(F.sum("copies").alias("n")).collect()}


def test_rejected_rows_are_those_of_runs_that_count(spark, lake):
    load = customer_load(lambda: dirty(spark, [1, 2, 3]))
    run_load(spark, load, lake, FIRST)
    run_load(spark, load, lake, FIRST)
    assert copies(spark, lake) == {"not_latest": 3, "missing_required": 2}
    with pytest.raises(ValidationFailed):
        run_load(spark, replace(load, most_rejected=0.1), lake, LATER)
    assert copies(spark, lake) == {"not_latest": 3, "missing_required": 2}
    run_load(spark, customer_load(lambda: dirty(spark, [4], 0)), lake, LATER)
    assert copies(spark, lake) == {"not_latest": 4, "missing_required": 2}


def test_rejected_columns_of_unlike_types_are_text(spark, lake):
    run_load(spark, customer_load(lambda: dirty(spark, [1])), lake, FIRST)
    other = customer_load(lambda: dirty(spark, [2]).withColumn("credit_score", F.col("credit_score").cast("int")))
    run_load(spark, other, lake, LATER)
    assert dict(read_rejected(spark, lake, "customers").dtypes)["credit_score"] == "string"


def test_the_source_is_read_once(spark, lake):
    read = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield batch

    source = dirty(spark, [1, 2, 3])
    report = run_load(spark, customer_load(lambda: source.mapInArrow(counted, source.schema)), lake, FIRST)
    assert read.value == report.source_rows == 8


def test_a_source_that_changes_with_every_scan_is_divided(spark, lake):
    """Loaded and rejected rows together are one extraction, and the counts are theirs."""
    base = customers(spark, [1]).drop("customer_id", "segment")
    draw = F.floor(F.rand() * 40)
    rows = spark.range(400).crossJoin(F.broadcast(base)).withColumn("customer_id", F.when(draw > 3, F.concat(F.lit("C"), draw.cast("string"))))
    rows = rows.withColumn("segment", F.col("id").cast("string")).drop("id")
    report = run_load(spark, customer_load(lambda: rows), lake, FIRST)
    loaded = [r.segment for r in published(spark, lake).collect()]
    rejected = [r.segment for r in read_rejected(spark, lake, "customers").collect()]
    assert sorted(loaded + rejected, key=int) == list(map(str, range(400)))
    assert copies(spark, lake) == {"not_latest": report.rejected_not_latest, "missing_required": report.rejected_missing}
    assert len(loaded) == report.row_count


def test_nothing_of_the_way_is_left_behind(spark, lake):
    shared = spark.conf.get("spark.checkpoint.dir")
    run_load(spark, replace(customer_load(lambda: dirty(spark, [1])), changed_only=True), lake, FIRST)
    import os
    assert not [name for name in os.listdir(shared) if name.startswith("customers-load-")]


# Unchanged and late rows

def changed_load(spark, rows, **options):
    return replace(customer_load(lambda: rows), changed_only=True, **options)


def test_an_unchanged_run_writes_nothing(spark, lake):
    rows = dirty(spark, [1, 2, 3])
    run_load(spark, changed_load(spark, rows), lake, FIRST)
    report = run_load(spark, changed_load(spark, rows, lookback_days=30), lake, LATER)
    assert (report.row_count, report.unchanged, report.passed) == (0, 3, True)
    assert (report.source_rows, report.rejected_not_latest, report.rejected_missing) == (8, 3, 2)
    assert published(spark, lake).count() == 3
    assert mark(spark, lake) == "2023-12-03 00:00:00"


def test_contents_that_change_back_are_new_each_time(spark, lake):
    for stamp, segment in ((FIRST, "A"), (LATER, "B"), (NEXT, "A"), (THIRD, "A")):
        report = run_load(spark, changed_load(spark, customers(spark, [5], segment)), lake, stamp)
        assert report.row_count == (stamp != THIRD)
        assert [r.segment for r in current_rows(published(spark, lake), ["customer_id"]).collect()] == [segment]


def test_nulls_tell_rows_apart(spark, lake):
    old = customers(spark, [5]).withColumns({"email": F.lit("x"), "phone_number": F.lit(None).cast("string")})
    new = customers(spark, [5]).withColumns({"email": F.lit(None).cast("string"), "phone_number": F.lit("x")})
    run_load(spark, changed_load(spark, old), lake, FIRST)
    assert run_load(spark, changed_load(spark, new), lake, LATER).row_count == 1


def test_a_run_again_compares_with_the_batches_before_it(spark, lake):
    run_load(spark, changed_load(spark, customers(spark, [1, 2])), lake, FIRST)
    run_load(spark, changed_load(spark, customers(spark, [2, 3])), lake, LATER)
    assert run_load(spark, changed_load(spark, customers(spark, [1, 2])), lake, FIRST).row_count == 2
    assert run_load(spark, changed_load(spark, customers(spark, [2, 3])), lake, LATER).row_count == 1
    assert published(spark, lake).count() == 3


def test_late_rows_within_the_window_are_loaded_once(spark, lake):
    run_load(spark, changed_load(spark, customers(spark, [1, 9, 20]), lookback_days=5), lake, FIRST)
    late = customers(spark, [1, 2, 9, 16, 20])
    assert run_load(spark, changed_load(spark, late, lookback_days=5), lake, LATER).row_count == 1
    assert run_load(spark, changed_load(spark, late, lookback_days=5), lake, NEXT).row_count == 0
    assert {r.customer_id for r in published(spark, lake).collect()} == {"C1", "C9", "C16", "C20"}


def test_a_late_row_does_not_hide_a_newer_one(spark, lake):
    run_load(spark, changed_load(spark, customers(spark, [20], "NEW").withColumn("customer_id", F.lit("C"))), lake, FIRST)
    late = customers(spark, [18], "LATE").withColumn("customer_id", F.lit("C"))
    assert run_load(spark, changed_load(spark, late, lookback_days=5), lake, LATER).row_count == 1
    assert [r.segment for r in current_rows(published(spark, lake), ["customer_id"]).collect()] == ["NEW"]


def test_the_window_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "t")
    customers(spark, range(1, 20)).write.parquet(path)
    found = changed_since(spark.read.parquet(path), "last_updated", "2023-12-15", lookback_days=4)
    assert found.count() == 9
    assert "GreaterThanOrEqual(last_updated,2023-12-11" in plan_text(found)


# Overlapping runs

def test_the_second_of_two_overlapping_runs_starts_again(spark, lake):
    """Whichever stamp it has: nothing is lost, nothing comes twice."""
    for k, (outer, inner) in enumerate([(FIRST, LATER), (LATER, FIRST)]):
        base = f"{lake}{k}"
        begun = []

        def source():
            if not begun:
                begun.append(1)
                run_load(spark, customer_load(lambda: customers(spark, [1, 2, 3])), base, inner)
            return customers(spark, [1, 2, 4, 5])

        report = run_load(spark, customer_load(source), base, outer)
        assert report.row_count == 2  # from the new mark on
        rows = sorted(r.customer_id for r in published(spark, base).collect())
        assert rows == ["C1", "C2", "C3", "C4", "C5"]


def test_many_runs_at_once(spark, lake):
    """Each loads what is new to it; all rows are there, those of the marks' days at most once a batch."""
    days = list(range(1, 9))
    random.Random(3).shuffle(days)

    def one(k):
        load = replace(customer_load(lambda: customers(spark, range(1, days[k] + 1))), changed_only=True, lookback_days=31)
        run_load(spark, load, lake, f"2024-01-01 08:00:0{k}")

    threads = [threading.Thread(target=one, args=(k,)) for k in range(4)]
    for thread in threads:
        thread.start()
    for thread in threads:
        thread.join()
    rows = sorted(r.customer_id for r in published(spark, lake).collect())
    assert rows == [f"C{d}" for d in range(1, max(days[:4]) + 1)]


def test_a_number_is_written_once(spark, tmp_path):
    path = str(tmp_path / "marks")
    update_watermark(spark, path, "a", "2024-01-05", sequence=1, batch="1", attempt=1)
    with pytest.raises(SequenceTaken):
        update_watermark(spark, path, "a", "2024-01-06", sequence=1, batch="2", attempt=2)
    update_watermark(spark, path, "b", "2024-01-06", sequence=1, batch="2", attempt=2)


def test_a_commit_that_died_is_stepped_over(spark, lake, monkeypatch):
    monkeypatch.setattr(loads, "GRACE", 0)
    spark.range(0).write.parquet(commit_path(lake_path(lake, WATERMARKS), "customers", 1))
    assert run_load(spark, customer_load(lambda: customers(spark, [1])), lake, FIRST).passed
    assert run_load(spark, customer_load(lambda: customers(spark, [1, 2])), lake, LATER).row_count == 2
    assert published(spark, lake).count() == 3


# All loads

def test_loads_run_side_by_side(spark, lake):
    meet = threading.Barrier(2, timeout=60)

    def source(rows):
        def build():
            meet.wait()
            return rows
        return build

    both = [customer_load(source(customers(spark, [1]))), replace(event_load(spark), source=source(events(spark, 5)))]
    reports = run_all(spark, both, lake, FIRST, at_once=2)
    assert {entity: r.row_count for entity, r in reports.items()} == {"customers": 1, "transactions": 5}


def test_a_failure_cancels_the_others_and_a_repeat_skips_what_is_committed(spark, lake):
    def slow(batches):
        import time
        for batch in batches:
            time.sleep(40)
            yield batch

    quick = replace(event_load(spark), entity="quick", path="banking/quick")
    rows = customers(spark, [1])
    stuck = customer_load(lambda: rows.mapInArrow(slow, rows.schema))
    started = threading.Event()

    def source():
        started.wait(60)
        return events(spark, 5)

    broken = replace(event_load(spark, broken=True), source=source)
    threading.Timer(3, started.set).start()
    import time
    begun = time.monotonic()
    with pytest.raises(ValidationFailed):
        run_all(spark, [quick, stuck, broken], lake, FIRST, at_once=3)
    assert time.monotonic() - begun < 30
    assert published(spark, lake) is None and published(spark, lake, "quick").count() == 5

    unread = replace(quick, source=lambda: pytest.fail("read again"))
    good = [unread, customer_load(lambda: rows), event_load(spark)]
    reports = run_all(spark, good, lake, FIRST, at_once=3, skip_committed=True)
    assert {entity: r.row_count for entity, r in reports.items()} == {"quick": 5, "customers": 1, "transactions": 5}


# Snapshots

def current(spark, lake, load):
    return sorted(map(str, current_rows(read_table(spark, lake, load), load.keys).collect()))


def test_a_snapshot_holds_the_latest_rows(spark, lake):
    load = customer_load(lambda: customers(spark, range(1, 11)))
    with pytest.raises(LookupError):
        read_current(spark, lake, load)
    assert take_snapshot(spark, load, lake, buckets=8) is None
    run_load(spark, load, lake, FIRST)
    assert sorted(map(str, read_current(spark, lake, load).collect())) == current(spark, lake, load)
    written = take_snapshot(spark, load, lake, buckets=8)
    assert 1 < len(written) <= 8
    assert take_snapshot(spark, load, lake) is None
    assert sorted(map(str, read_current(spark, lake, load).collect())) == current(spark, lake, load)
    assert "Exchange" not in plan_text(read_current(spark, lake, load))


def test_only_touched_buckets_are_written(spark, lake):
    load = customer_load(lambda: customers(spark, range(1, 21)))
    run_load(spark, load, lake, FIRST)
    take_snapshot(spark, load, lake, buckets=16)
    before = {f["bucket"]: f["folder"] for f in snapshots._last(spark, load, lake)["folders"]}
    more = customer_load(lambda: customers(spark, [20], "NEW").union(customers(spark, [21])))
    run_load(spark, more, lake, LATER)
    assert sorted(map(str, read_current(spark, lake, load).collect())) == current(spark, lake, load)
    keys = spark.createDataFrame([("C20",), ("C21",)], "customer_id string")
    touched = sorted({r.b for r in keys.select(bucket_of(load, 16).alias("b")).collect()})
    assert take_snapshot(spark, load, lake) == touched
    after = {f["bucket"]: f["folder"] for f in snapshots._last(spark, load, lake)["folders"]}
    assert all(after[k] == folder for k, folder in before.items() if k not in touched)
    assert sorted(map(str, read_current(spark, lake, load).collect())) == current(spark, lake, load)


def test_rows_of_untouched_buckets_and_keys_are_not_shuffled(spark, lake):
    load = customer_load(lambda: customers(spark, range(1, 21)))
    run_load(spark, load, lake, FIRST)
    take_snapshot(spark, load, lake, buckets=2)
    run_load(spark, customer_load(lambda: customers(spark, [20], "NEW")), lake, LATER)
    plan = plan_text(read_current(spark, lake, load))
    assert plan.count("Exchange hashpartitioning(customer_id") == 1
    assert "LeftAnti" in plan and "LeftSemi" in plan and "BroadcastHashJoin" in plan


def test_late_rows_replaced_batches_and_new_columns(spark, lake):
    load = replace(customer_load(lambda: customers(spark, range(1, 21))), changed_only=True, lookback_days=20)
    run_load(spark, load, lake, FIRST)
    take_snapshot(spark, load, lake, buckets=4)
    late = customers(spark, [15], "LATE").withColumn("customer_id", F.lit("C20")).union(customers(spark, [3], "NEW").withColumn("last_updated", F.lit("2023-12-19").cast("date")))
    wider = with_column(replace(load, source=lambda: late), "risk", F.lit(1))
    run_load(spark, wider, lake, LATER)
    for _ in range(2):
        assert sorted(map(str, read_current(spark, lake, load).collect())) == current(spark, lake, load)
        rows = {r.customer_id: (r.segment, r.risk) for r in read_current(spark, lake, load).collect()}
        assert (rows["C20"], rows["C3"], rows["C4"]) == (("OLD", None), ("NEW", 1), ("OLD", None))
        take_snapshot(spark, load, lake)
    # A batch that both snapshots hold is run again: neither is used.
    run_load(spark, replace(load, source=lambda: customers(spark, range(1, 19), "AGAIN")), lake, FIRST)
    assert snapshots._last(spark, load, lake) is None
    assert sorted(map(str, read_current(spark, lake, load).collect())) == current(spark, lake, load)
    take_snapshot(spark, load, lake, buckets=4)
    assert sorted(map(str, read_current(spark, lake, load).collect())) == current(spark, lake, load)
