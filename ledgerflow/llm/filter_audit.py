"""How filters interact: which filter removes what, in every order they could run in.

Each document becomes a 32-bit survival word: bit S, of the 32 subsets S of five filters,
says whether the document passes all filters in S. Carry-save adders sum the words of a
part by bit position, so one pass gives the survivors of every subset, of all documents
and of the labelled ones. Every figure of every order is a difference of such numbers.

The filters see whole texts. A document fails
A with under 50 words, B where distinct words are under 65 % of its words, C where capitals A-Z are
over 5 % of its code points, D where it holds one of # $ % & * |, and
E where a row with a smaller id has the identical text, removed or not.
"""

import json
from collections import defaultdict
from hashlib import sha256
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from ledgerflow.llm.store import checked_broadcast, small_batches, written
from ledgerflow.llm.words import binary, flat, located_words, slices

FILTERS = "ABCDE"
ALL = (1 << len(FILTERS)) - 1
SUBSETS = ALL + 1
REPEATED = 1 << FILTERS.index("E")
# The survival word of each set of failed filters.
WORDS = np.array([sum(1 << s for s in range(SUBSETS) if not s & failed) for failed in range(SUBSETS)], dtype=np.uint32)

MOST_HOT = 50_000  # texts that are broadcast at most: those with over a 50,000th of all rows
MOST_PARTS = 10_000  # parts whose counters a task holds at once

_IS_CAPITAL = np.zeros(256, dtype=bool)
_IS_CAPITAL[ord("A"):ord("Z") + 1] = True
_IS_MARK = np.zeros(256, dtype=bool)
_IS_MARK[[ord(c) for c in "#$%&*|"]] = True
_STARTS_POINT = (np.arange(256) & 0xC0) != 0x80


def _totals(flags: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """How many flags are set in each row."""
    sums = np.zeros(len(flags) + 1, dtype=np.int64)
    np.cumsum(flags, out=sums[1:])
    return sums[starts[1:]] - sums[starts[:-1]]


def failures(data: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """The filters among A to D that each text fails, as bits."""
    hashes, first, _ = located_words(data, starts, lower=False)
    edges = np.searchsorted(first, starts)
    words = np.diff(edges)
    distinct = np.array([len(np.unique(hashes[a:b])) for a, b in zip(edges[:-1], edges[1:])], dtype=np.int64)
    failed = [
        words < 50,
        100 * distinct < 65 * words,
        100 * _totals(_IS_CAPITAL[data], starts) > 5 * _totals(_STARTS_POINT[data], starts),
        _totals(_IS_MARK[data], starts) > 0,
    ]
    return sum(flag.astype(np.int32) << k for k, flag in enumerate(failed))


def _judge(batches):
    for batch in batches:
        for part in slices(batch):
            data, starts = flat(part.column("text"))
            text = memoryview(data)
            prints = [sha256(text[a:b]).digest() for a, b in zip(starts[:-1], starts[1:])]
            yield pa.record_batch(
                [part.column("id"), part.column("part"), binary(prints), pa.array(failures(data, starts), type=pa.int32())],
                names=["id", "part", "print", "failed"],
            )


def _repeats(judged: DataFrame) -> DataFrame:
    """``judged`` with E among the failed filters of each row whose text a smaller id has.

    Texts with a large share of the rows are few and are broadcast; their rows don't meet
    in the join that looks for the others.
    """
    total = judged.count()
    shared = judged.groupBy("print").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first")).where("n > 1 and first is not null")
    shared = written(shared, "shared")
    hot = F.col("n") * MOST_HOT > total
    often = F.broadcast(shared.where(hot).select(F.col("print").alias("often"), F.col("first").alias("often_first")))
    seldom = checked_broadcast(shared.where(~hot).select(F.col("print").alias("seldom"), F.col("first").alias("seldom_first")))
    rows = judged.join(often, judged["print"] == F.col("often"), "left")
    # Rows that are done go on by their ids: the digits of a number equal no print.
    onward = F.when(F.col("often").isNull(), F.col("print")).otherwise(F.xxhash64("id").cast("string").cast("binary"))
    rows = rows.withColumn("onward", onward).join(seldom, F.col("onward") == F.col("seldom"), "left")
    first = F.coalesce("often_first", "seldom_first")
    later = first.isNotNull() & (F.col("id").isNull() | (F.col("id") > first))
    return rows.select("id", "part", F.when(later, F.col("failed") + REPEATED).otherwise(F.col("failed")).alias("failed"))


def positional_counts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit ``words`` have each bit set, by carry-save addition.

    Three words of one weight become a sum word of that weight and a carry word of twice
    it, so a third of the words goes in each pass; the few that are left are unpacked.
    """
    counts = np.zeros(32, dtype=np.int64)
    weight = 1
    while len(words):
        carries = []
        while len(words) > 2:
            third = len(words) // 3
            x, y, z, rest = words[:third], words[third:2 * third], words[2 * third:3 * third], words[3 * third:]
            either = x ^ y
            carries.append((x & y) | (z & either))
            words = np.concatenate([either ^ z, rest])
        bits = (words[:, None] >> np.arange(32, dtype=np.uint32)) & np.uint32(1)
        counts += weight * bits.sum(axis=0, dtype=np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def _count(batches):
    """Survivors of each subset by part: of all rows, of good and of toxic ones."""
    found = defaultdict(lambda: np.zeros((3, 32), dtype=np.int64))

    def out():
        parts = pa.array(list(found), type=pa.string())
        kinds = [pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate([c[k] for c in found.values()])), 32).cast(pa.list_(pa.int64())) for k in range(3)]
        found.clear()
        return pa.record_batch([parts, *kinds], names=["part", "every", "good", "toxic"])

    for batch in batches:
        parts = batch.column("part").dictionary_encode()
        code = parts.indices.to_numpy(zero_copy_only=False)
        words = WORDS[batch.column("failed").to_numpy()]
        good, toxic = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("good", "toxic"))
        order = np.argsort(code, kind="stable")
        edges = np.searchsorted(code[order], np.arange(len(parts.dictionary) + 1))
        for k, name in enumerate(parts.dictionary.to_pylist()):
            own = order[edges[k]:edges[k + 1]]
            found[name] += np.stack([positional_counts(w) for w in (words[own], words[own[good[own]]], words[own[toxic[own]]])])
        if len(found) > MOST_PARTS:
            yield out()
    if found:
        yield out()


def survivors(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source",
) -> DataFrame:
    """``part, subset, every, good, toxic``: rows of a part that pass all filters of each subset.

    ``subset`` has bit k for the k-th filter. ``labels(doc_id, quality, toxic)`` may name an
    id repeatedly: one quality of 1 makes its rows good, one toxic of 1 makes them toxic.
    A null text is empty, a null part the empty string; a null id counts as larger than
    any other and has no labels; rows of one id don't repeat each other. Other columns
    of ``docs`` may have any names. No row gives no part. Lowers the session's Arrow batches.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), F.col(text_col).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    judged = written(rows.mapInArrow(_judge, f"id {kind}, part string, print binary, failed int"), "judged")
    known = labels.groupBy(F.col("doc_id").alias("known")).agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")).where("known is not null and (good or toxic)")
    found = _repeats(judged)
    found = found.join(checked_broadcast(written(known, "known")), F.col("id") == F.col("known"), "left")
    flags = [F.coalesce(F.col(c), F.lit(False)).alias(c) for c in ("good", "toxic")]
    counted = found.select("part", "failed", *flags).mapInArrow(
        _count, "part string, every array<long>, good array<long>, toxic array<long>")
    each = counted.select("part", F.posexplode(F.arrays_zip("every", "good", "toxic")).alias("subset", "n"))
    return each.groupBy("part", "subset").agg(*[F.sum(f"n.{c}").alias(c) for c in ("every", "good", "toxic")])


def steps() -> list[dict]:
    """Every step of every order: its filter's bit and the bits of the filters before it."""
    out = []
    for order in permutations(FILTERS):
        before = 0
        for step, letter in enumerate(order, start=1):
            bit = 1 << FILTERS.index(letter)
            out.append({"filter_order": "".join(order), "step": step, "before": before, "bit": bit})
            before |= bit
    return out


def audit(counts: DataFrame) -> DataFrame:
    """What each step of each order of the filters does, by part, from ``survivors``.

    ``part, filter_order, step`` and the documents: ``kept`` after the step, ``removed``
    in it, ``redundant`` (fail its filter, removed before), ``unique_fails`` (fail its
    filter only), ``good_lost`` and ``toxic_lost`` (removed in it), ``shapley`` (what its
    filter removes, summed over all orders).
    """
    given = F.struct("every", "good", "toxic")
    parts = counts.groupBy("part").agg(F.map_from_entries(F.collect_list(F.struct("subset", given))).alias("at"))  # 32 entries
    every = F.from_json(F.lit(json.dumps(steps())), "array<struct<filter_order:string,step:int,before:int,bit:int>>")
    rows = parts.select("part", "at", F.inline(every))
    at = lambda subset, kind: F.col("at")[subset][kind]
    before, bit = F.col("before"), F.col("bit")
    after = before.bitwiseOR(bit)
    lost = lambda kind: at(before, kind) - at(after, kind)
    rows = rows.select(
        "part", "filter_order", "step", "bit", at(after, "every").alias("kept"), lost("every").alias("removed"),
        (at(F.lit(0), "every") - at(bit, "every") - lost("every")).alias("redundant"),
        (at(F.lit(ALL) - bit, "every") - at(F.lit(ALL), "every")).alias("unique_fails"),
        lost("good").alias("good_lost"), lost("toxic").alias("toxic_lost"),
    )
    return rows.withColumn("shapley", F.sum("removed").over(Window.partitionBy("part", "bit"))).drop("bit")
