"""Near duplicates by circulant MinHash, banding and exact Jaccard verification.

A document is its set of distinct word shingles, as 64-bit hashes. Its signature
takes two permutations of the 32-bit numbers: one scatters the shingles, the other,
shifted by k around its circle, ranks them for coordinate k. Documents that agree
in all rows of a band are candidates, and a link needs its similarity confirmed on
both full sets.

Only components are asked for, so a bucket's pairs are not all tried. Documents
with equal sets are collapsed first. Then each bucket's members are compared with
one leader. Only a bucket whose members are still in several components goes on,
with all its pairs: of a small bucket those between different components, of a large
one blocks against blocks inside of a task, which returns a spanning set of the links
it finds. A pair inside of one component can't change the result, so no link of any
bucket is lost, and a group of m documents never makes m * m rows.
"""

from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerflow.llm.graph import components, labelled
from ledgerflow.llm.store import checked_broadcast, row_number, small_batches, written
from ledgerflow.llm.words import flat, mix, shingle_hashes, slices, word_hashes

BANDS, ROWS = 24, 6  # at a similarity of 0.8 a pair shares a band with probability 0.999, at 0.85 with 0.99998
SMALL = 64  # members up to which a bucket's pairs are rows
BLOCK_ROWS, BLOCK_SHINGLES = 1000, 400_000  # about as much of a large bucket is compared with as much at a time
TILE = 4096  # shingles counted at a time


def permutation(x: np.ndarray, seed: int) -> np.ndarray:
    """A bijection of the 32-bit numbers, in place."""
    x ^= np.uint32(seed)
    spare = np.empty_like(x)
    for shift, factor in ((16, 0x85EBCA6B), (13, 0xC2B2AE35)):
        np.right_shift(x, np.uint32(shift), out=spare)
        x ^= spare
        x *= np.uint32(factor)
    np.right_shift(x, np.uint32(16), out=spare)
    x ^= spare
    return x


def signatures(sets: np.ndarray, starts: np.ndarray, size: int) -> np.ndarray:
    """``size`` coordinates for each of the non-empty sets that begin at ``starts``."""
    scattered = permutation((sets >> np.uint64(32)).astype(np.uint32), 0x2545F491)
    out = np.empty((len(starts), size), dtype=np.uint32)
    moved = np.empty_like(scattered)
    for k in range(size):
        np.subtract(scattered, np.uint32(k), out=moved)
        out[:, k] = np.minimum.reduceat(permutation(moved, 0x6C8E9CF5), starts)
    return out


def band_keys(signature: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.empty((len(signature), bands), dtype=np.uint64)
    for b in range(bands):
        key = np.full(len(signature), b + 1, dtype=np.uint64)
        for k in range(b * rows, (b + 1) * rows):
            key = mix(key * np.uint64(0x9FB21C651E98DF25) + signature[:, k])
        keys[:, b] = key
    return keys


def shingle_sets(part: pa.RecordBatch, n: int) -> list[np.ndarray]:
    words, at = word_hashes(*flat(part.column("text")))
    at = at.tolist()
    return [np.unique(shingle_hashes(words[lo:hi], n)) for lo, hi in zip(at, at[1:], strict=False)]


def _print(s: np.ndarray) -> bytes | None:
    return blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None


def _sketches(n: int, bands: int, rows: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part, n)
                sizes = np.array([len(s) for s in sets], dtype=np.int64)
                full = np.flatnonzero(sizes)
                keys: list = [None] * len(sets)
                if len(full):
                    starts = np.cumsum(sizes[full]) - sizes[full]
                    for k, row in zip(full.tolist(), band_keys(signatures(np.concatenate(sets), starts, bands * rows), bands, rows).view(np.int64), strict=True):
                        keys[k] = row
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(sizes), pa.array([_print(s) for s in sets], pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                    names=["row", "doc_id", "n_shingles", "print", "bands"])
    return run


def _sets(n: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                sets = shingle_sets(part, n)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_print(s) for s in sets], pa.binary()), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64()))], names=["print", "shingles"])
    return run


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those ``pairs(a, b)`` with 100 * intersection >= percent * union on their full sets."""
    a = sets.select(F.col("row").alias("a"), F.col("shingles").alias("left_set"))
    b = sets.select(F.col("row").alias("b"), F.col("shingles").alias("right_set"))
    shared = F.size(F.array_intersect("left_set", "right_set"))
    union = F.size("left_set") + F.size("right_set") - F.col("shared")
    return pairs.join(a, "a").join(b, "b").withColumn("shared", shared).where(F.col("shared") * 100 >= union * percent).select("a", "b")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, percent: int = 80, bands: int = BANDS, rows: int = ROWS,
    row_col: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``row, doc_id, n_shingles, component_id, kept``.

    ``n_shingles`` counts the distinct runs of ``shingle`` words; a text with fewer
    words is one shingle, and one without words or null has none and links with
    nothing. ``component_id`` is the smallest id reachable by links, null ids last;
    the row that has it stays, exactly one of repeated rows. Other columns are not read.
    ``row`` is the column ``row_col``, whole numbers of which no two are equal, or else
    ``monotonically_increasing_id`` of this scan, which another scan needn't give again.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    known = written(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_number(row_col).alias("row"))
        .mapInArrow(_sketches(shingle, bands, rows), f"row long, doc_id {kind}, n_shingles long, print binary, bands array<long>"),
        "sketches",
    )
    # One row of each set of equal sets goes on.
    heads = written(known.where("n_shingles > 0").groupBy("print").agg(F.min("row").alias("head"), F.count(F.lit(1)).alias("copies")), "heads")
    unique = known.join(heads.select(F.col("head").alias("row")), "row", "left_semi")
    entries = unique.select("row", "n_shingles", F.explode("bands").alias("bucket"))
    buckets = entries.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1").drop("members")
    entries = written(entries.join(buckets, "bucket", "left_semi"), "buckets")

    wanted = known.join(entries.select("row").distinct(), "row", "left_semi").select("row", "doc_id", "print")
    wanted = written(wanted, "wanted")
    ids = checked_broadcast(wanted.select("doc_id").where("doc_id is not null").distinct())
    found = texts.join(ids, "doc_id", "left_semi").union(texts.where("doc_id is null"))
    sets = written(
        found.select("text").mapInArrow(_sets(shingle), "print binary, shingles array<long>")
        .join(wanted.select("print", "row"), "print").dropDuplicates(["row"]).select("row", "shingles"),
        "sets",
    )

    def close(pairs: DataFrame) -> DataFrame:
        """Distinct pairs whose sizes alone don't rule the similarity out."""
        small, large = F.least("size_a", "size_b"), F.greatest("size_a", "size_b")
        return pairs.where(small * 100 >= large * percent).select("a", "b").distinct()

    nodes = entries.select("row").distinct()

    def grouped(links: DataFrame) -> DataFrame:
        found = nodes.join(components(links).withColumnRenamed("node", "row"), "row", "left")
        return written(found.select("row", F.coalesce("component", "row").alias("component")), "groups")

    lead = entries.groupBy("bucket").agg(F.min(F.struct("row", "n_shingles")).alias("lead"))
    lead = lead.select("bucket", F.col("lead.row").alias("a"), F.col("lead.n_shingles").alias("size_a"))
    member = entries.select("bucket", F.col("row").alias("b"), F.col("n_shingles").alias("size_b"))
    links = written(confirmed(close(member.join(lead, "bucket").where("a <> b")), sets, percent), "links")

    member = member.join(grouped(links).select(F.col("row").alias("b"), F.col("component").alias("of_b")), "b")
    still = member.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("members"), F.sum("size_b").alias("shingles"), F.min("of_b").alias("low"), F.max("of_b").alias("high"),
    ).where("low <> high and members > 2")  # a bucket of two has been compared with its leader
    member = written(member.join(still.drop("low", "high"), "bucket"), "unresolved")
    small = member.where(F.col("members") <= SMALL)
    other = small.select("bucket", F.col("b").alias("a"), F.col("size_b").alias("size_a"), F.col("of_b").alias("of_a"))
    found = confirmed(close(small.join(other, "bucket").where("of_a <> of_b and a < b")), sets, percent)
    links = links.union(found).union(_in_blocks(member.where(F.col("members") > SMALL), sets, percent))
    found = labelled(known.select("row", "doc_id", "n_shingles", "print"), heads, grouped(written(links, "links")))
    return found.select("row", "doc_id", "n_shingles", "component_id", "kept")


def _in_blocks(member: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a, b`` that span those of each large bucket, found block against block."""
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK_ROWS, F.col("shingles") / BLOCK_SHINGLES)).cast("int")
    placed = member.withColumn("blocks", blocks).withColumn("block", F.pmod(F.xxhash64("b"), "blocks").cast("int"))
    each = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other")
    pairs = placed.select("bucket", F.col("b").alias("row"), "block", each)
    pairs = pairs.select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "row")
    return pairs.join(sets, "row").groupBy("bucket", "i", "j").applyInArrow(_compare(percent), "a long, b long")


def spanning(linked: np.ndarray) -> np.ndarray:
    """For each node of a symmetric boolean matrix the smallest one it is connected with."""
    labels = np.arange(len(linked))
    while True:
        new = np.minimum(labels, np.where(linked, labels[None, :], len(labels)).min(axis=1, initial=len(labels)))
        new = new[new]
        if (new == labels).all():
            return labels
        labels = new


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Sizes of the intersections of all sets on the left with all on the right."""
    values, codes = np.unique(np.concatenate([*left, *right]), return_inverse=True)
    owner = np.repeat(np.arange(len(left) + len(right)), [len(s) for s in [*left, *right]])
    twice = np.bincount(codes) > 1  # others are in no intersection
    column = np.cumsum(twice) - 1
    keep = twice[codes]
    owner, codes = owner[keep], column[codes[keep]]
    order = np.argsort(codes, kind="stable")
    owner, codes, out = owner[order], codes[order], np.zeros((len(left), len(right)), dtype=np.float32)
    for low in range(0, int(twice.sum()), TILE):
        lo, hi = np.searchsorted(codes, [low, low + TILE])
        tile = np.zeros((len(left) + len(right), TILE), dtype=np.float32)
        tile[owner[lo:hi], codes[lo:hi] - low] = 1
        out += tile[:len(left)] @ tile[len(left):].T
    return out


def _compare(percent: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        i, j = key[1].as_py(), key[2].as_py()
        table = table.combine_chunks().sort_by("row")
        rows, block = table["row"].to_numpy(), table["block"].to_numpy()
        column = table["shingles"].combine_chunks()
        ends = column.offsets.to_numpy()
        sets = [column.values.to_numpy()[lo:hi] for lo, hi in zip(ends[:-1], ends[1:], strict=True)]
        left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
        if not len(left) or not len(right):
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        size = np.array([len(s) for s in sets])
        shared = overlaps([sets[k] for k in left], [sets[k] for k in right]).astype(np.int64)
        near = 100 * shared >= percent * (size[left][:, None] + size[right][None, :] - shared)
        linked = np.zeros((len(rows), len(rows)), dtype=bool)
        linked[np.ix_(left, right)] = near
        labels = spanning(linked | linked.T)
        moved = labels != np.arange(len(rows))
        return pa.table({"a": rows[labels[moved]], "b": rows[moved]})
    return run
