"""Exact duplicates by content-defined chunk recipes.

A text is normalised (each run of 0x20 and 0x09 to 0x0D becomes one space) and cut
where a rolling hash of its last 32 bytes says so. A chunk's identifier is the
128-bit digest of its bytes; that equal digests mean equal bytes is verified over
all distinct chunks, each of which is moved once, however many documents hold it.
A document is then the ordered list of its identifiers, its recipe, and documents
are equal when their recipes are. No document moves as a whole.
"""

from hashlib import blake2b, sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerflow.llm.store import SALTS, row_number, small_batches, written
from ledgerflow.llm.words import IS_SPACE, flat, mix, slices

REACH = 32  # bytes that decide on a cut
MEAN_CHUNK = 2048
MOST_CHUNK = 1 << 16
WINDOW = 1 << 20
DIGEST_BYTES = 16

GEAR = (mix(np.arange(1, 257, dtype=np.uint64)) >> np.uint64(32)).astype(np.uint32)


def normalised(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows with each run of white space replaced by one space."""
    space = IS_SPACE[data]
    again = np.zeros_like(space)
    again[1:] = space[1:] & space[:-1]
    again[starts[starts < len(data)]] = False
    keep = ~again
    places = np.zeros(len(data) + 1, dtype=np.int64)
    np.cumsum(keep, out=places[1:])
    return np.where(space, np.uint8(0x20), data)[keep], places[starts]


def cuts(data: np.ndarray) -> np.ndarray:
    """Ends of chunks within the bytes, from the hash of the REACH bytes before each."""
    found = []
    level = np.uint32((1 << 32) // MEAN_CHUNK)
    for lo in range(0, len(data), WINDOW):
        first = max(0, lo - REACH + 1)
        h = GEAR[data[first:lo + WINDOW]]
        for step in (1, 2, 4, 8, 16):
            h[step:] = h[step:] + (h[:-step] << np.uint32(step))
        found.append(np.flatnonzero(h[lo - first:] < level) + lo + 1)
    return np.concatenate(found) if found else np.zeros(0, dtype=np.int64)


def chunk_bounds(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ends of all chunks of all rows, ascending, and how many each row has.

    Depends on each row's own bytes only: no cut within the first REACH bytes of
    a row, a cut after every MOST_CHUNK bytes without one.
    """
    inner = cuts(data)
    row = np.searchsorted(starts, inner, side="right") - 1
    inner = inner[inner - starts[row] >= REACH]
    ends = np.union1d(inner, starts[1:][np.diff(starts) > 0])
    before = np.concatenate([[0], ends[:-1]])
    long = np.flatnonzero(ends - before > MOST_CHUNK)
    if len(long):
        ends = np.union1d(ends, np.concatenate([np.arange(before[k] + MOST_CHUNK, ends[k], MOST_CHUNK) for k in long]))
    return ends, np.diff(np.searchsorted(ends, starts, side="right"))


def _digest(chunk, bits: int) -> bytes:
    out = blake2b(chunk, digest_size=DIGEST_BYTES).digest()
    return out if bits >= 8 * DIGEST_BYTES else (int.from_bytes(out[:8], "big") >> (64 - bits)).to_bytes(8, "big")


def _recipes(bits: int):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                data, starts = normalised(*flat(part.column("text")))
                ends, counts = chunk_bounds(data, starts)
                view, recipes, digests, at, k = memoryview(data), [], [], 0, 0
                for n, lo, hi in zip(counts.tolist(), starts[:-1].tolist(), starts[1:].tolist(), strict=True):
                    digests.append(sha256(view[lo:hi]).hexdigest())
                    parts = []
                    for end in ends[k:k + n].tolist():
                        parts.append(_digest(view[at:end], bits))
                        at = end
                    k += n
                    recipes.append(b"".join(parts))
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), pa.array(recipes, pa.binary()), pa.array(digests, pa.string()), pa.array(np.diff(starts))],
                    names=["row", "doc_id", "recipe", "text_sha256", "n_bytes"],
                )
    return run


def _chunks(bits: int):
    """The distinct chunks of each slice with their digests."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                data, starts = normalised(*flat(part.column("text")))
                ends, _ = chunk_bounds(data, starts)
                begins = np.concatenate([[0], ends[:-1]]).tolist()
                own = list({data[lo:hi].tobytes() for lo, hi in zip(begins, ends.tolist(), strict=True)})
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_digest(c, bits) for c in own], pa.binary()), pa.array(own, pa.binary())], names=["digest", "content"])
    return run


def _places(bits: int):
    """Every chunk with its text's digest and its place there."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                data, starts = normalised(*flat(part.column("text")))
                ends, counts = chunk_bounds(data, starts)
                texts = [sha256(memoryview(data)[lo:hi]).hexdigest() for lo, hi in zip(starts[:-1].tolist(), starts[1:].tolist(), strict=True)]
                begins = np.concatenate([[0], ends[:-1]]).tolist()
                own = [data[lo:hi].tobytes() for lo, hi in zip(begins, ends.tolist(), strict=True)]
                place = np.arange(len(ends)) - np.repeat(np.cumsum(counts) - counts, counts)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.repeat(np.array(texts, dtype=object), counts), pa.string()), pa.array(place),
                     pa.array([_digest(c, bits) for c in own], pa.binary()), pa.array(own, pa.binary())],
                    names=["text_sha256", "place", "digest", "content"])
    return run


def distinct_chunks(texts: DataFrame, digest_bits: int = 8 * DIGEST_BYTES) -> DataFrame:
    """``digest, content`` of all distinct chunks; copies go before the shuffle."""
    chunks = texts.select("text").mapInArrow(_chunks(digest_bits), "digest binary, content binary")
    return chunks.groupBy("digest", "content").agg(F.lit(True).alias("seen")).drop("seen")


def _ordinals(texts: DataFrame, clashing: DataFrame, digest_bits: int) -> DataFrame:
    """For texts with chunks whose digest stands for several contents: those chunks'
    ordinals among the contents of their digest, in order of their places."""
    contents = distinct_chunks(texts, digest_bits).join(clashing, "digest", "left_semi")
    ranked = contents.withColumn("ordinal", F.row_number().over(Window.partitionBy("digest").orderBy("content")))
    places = texts.select("text").mapInArrow(_places(digest_bits), "text_sha256 string, place long, digest binary, content binary")
    return (
        places.join(ranked, ["digest", "content"]).groupBy("text_sha256", "place").agg(F.min("ordinal").alias("ordinal"))
        .groupBy("text_sha256").agg(F.sort_array(F.collect_list(F.struct("place", "ordinal"))).alias("ordinals"))
    )


def exact_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", digest_bits: int = 8 * DIGEST_BYTES, row_col: str | None = None,
) -> DataFrame:
    """One row per row of ``docs``: ``row, doc_id, keep_id, group_size, kept, text_sha256, n_bytes, n_chunks``.

    Of equal normalised texts the row with the smallest id stays, null ids last;
    of rows with that same id, exactly one stays. Null texts count as empty, and
    all empty texts are equal. A table without rows gives none. Other columns are
    not read, so their names can't clash. ``row`` is the column ``row_col``, whole
    numbers of which no two are equal, or else ``monotonically_increasing_id`` of this
    scan, which another scan needn't give again. ``digest_bits`` shortens the digests,
    for tests of clashes.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    recipes = written(
        docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), row_number(row_col).alias("row"))
        .mapInArrow(_recipes(digest_bits), f"row long, doc_id {kind}, recipe binary, text_sha256 string, n_bytes long"),
        "recipes",
    )
    clashing = written(distinct_chunks(texts, digest_bits).groupBy("digest").count().where("count > 1").select("digest"), "clashes")
    equal: list[str] = ["recipe"]
    if not clashing.isEmpty():
        recipes = written(recipes.join(_ordinals(texts, clashing, digest_bits), "text_sha256", "left"), "recipes")
        equal.append("ordinals")
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")
    groups = recipes.groupBy(*equal).agg(F.min(first).alias("best"), F.count(F.lit(1)).alias("group_size"))
    return attach(recipes, groups.where("group_size > 1"), equal).select(
        "row", "doc_id",
        F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("best.doc_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
        (F.col("group_size").isNull() | (F.col("best.row") == F.col("row"))).alias("kept"),
        "text_sha256", "n_bytes", (F.octet_length("recipe") / min(DIGEST_BYTES, 16 if digest_bits >= 128 else 8)).cast("long").alias("n_chunks"),
    )


def attach(rows: DataFrame, groups: DataFrame, keys: list[str]) -> DataFrame:
    """``rows`` left joined with the few large ``groups``; a group's rows meet it in SALTS tasks."""
    salt = "_salt"
    spread = groups.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = rows.withColumn(salt, F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    right = spread.select(*[F.col(k).alias(f"_{k}") for k in keys], F.col(salt).alias("_spread"), "best", "group_size")
    on: Column = salted[salt] == right["_spread"]
    for k in keys:
        on = on & salted[k].eqNullSafe(right[f"_{k}"])
    return salted.join(right, on, "left").drop(salt, "_spread", *[f"_{k}" for k in keys])
