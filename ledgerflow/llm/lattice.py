"""Near duplicates of embeddings by lattice hashing.

Several random projections to eight dimensions are decoded to points of the E8
lattice, whose cells are the buckets of one table each. A vector is stored in its own
cell and looks into that and the neighbouring cells it is nearest to; a pair is a
candidate where one's own cell is among the other's. Candidates are verified by their
cosine in double precision, inside of the task that has the bucket: it returns for
each vector how many links it found and a spanning set of them, not the pairs. What goes to
the buckets are sketches of a byte a component, which bound the cosine from above;
whole vectors follow only where that bound reaches the threshold.

A pair may meet in several buckets. It counts in one, which both vectors' cells tell.
Equal vectors are collapsed first and weigh as many as they are. A large bucket is
compared block against block in many tasks.
"""

from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerflow.llm.graph import components, labelled
from ledgerflow.llm.minhash import spanning
from ledgerflow.llm.store import checked_broadcast, small_batches, written
from ledgerflow.llm.words import binary, mix

TABLES, PROBES, SCALE = 4, 6, 0.6  # a pair with a cosine of 0.9 is found with probability 0.996, one of 0.95 with 0.99999
BLOCK = 1024  # vectors of a bucket that are compared with as many at a time
STORED, ASKING, OWN = 1, 2, 4  # roles of a row in a block; OWN: the bucket is the vector's own cell
SKETCHED = 4096  # vectors whose cells are found at a time

# The 240 shortest vectors of the lattice: from a cell to its nearest neighbours.
NEIGHBOURS = np.array(
    [[x * (k == i) + y * (k == j) for k in range(8)] for i, j in combinations(range(8), 2) for x, y in product((1, -1), repeat=2)]
    + [[s / 2 for s in signs] for signs in product((1, -1), repeat=8) if signs.count(-1) % 2 == 0], dtype=np.float64)


def _even(x: np.ndarray) -> np.ndarray:
    """The nearest points with whole coordinates of even sum."""
    near = np.rint(x)
    odd = np.flatnonzero(near.sum(axis=1) % 2 != 0)
    off = x[odd] - near[odd]
    worst = np.abs(off).argmax(axis=1)
    near[odd, worst] += np.where(off[np.arange(len(odd)), worst] >= 0, 1, -1)
    return near


def decode(x: np.ndarray) -> np.ndarray:
    """The nearest lattice points: whole coordinates of even sum, or all moved by one half."""
    whole, half = _even(x), _even(x - 0.5) + 0.5
    nearer = ((x - whole) ** 2).sum(axis=1) <= ((x - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


def cells(vectors: np.ndarray, tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, seed: int = 5) -> np.ndarray:
    """For each unit vector and table the numbers of its own cell and of those it looks into."""
    random, out = np.random.default_rng((seed, vectors.shape[1])), np.empty((len(vectors), tables, 1 + probes), dtype=np.int64)
    for t in range(tables):
        x = vectors @ (random.normal(size=(vectors.shape[1], 8)) * scale)
        point = decode(x)
        nearest = np.argpartition(-(x - point) @ NEIGHBOURS.T, probes, axis=1)[:, :probes]
        points = np.concatenate([point[:, None], point[:, None] + NEIGHBOURS[nearest]], axis=1)
        number = np.full(points.shape[:2], t + 1, dtype=np.uint64)
        for k in range(8):
            number = mix(number * np.uint64(0x9FB21C651E98DF25) + (2 * points[:, :, k]).astype(np.int64).astype(np.uint64))
        out[:, t] = number.view(np.int64)
    return out


def matrix(column) -> np.ndarray:
    """Unit vectors in double precision from a list column whose lists are of one length."""
    values, at = np.asarray(column.values.to_numpy(zero_copy_only=False), dtype=np.float64), column.offsets.to_numpy()
    x = values[at[0]:at[-1]].reshape(len(column), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)  # no square over- or underflows
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _by_length(batch: pa.RecordBatch):
    """Parts of the batch whose vectors have the same number of components."""
    sizes = np.diff(batch.column("embedding").offsets.to_numpy())
    for size in np.unique(sizes):
        part = batch.filter(pa.array(sizes == size))
        for low in range(0, part.num_rows, SKETCHED):
            yield part.slice(low, SKETCHED)


def sketches(x: np.ndarray) -> np.ndarray:
    """Each unit vector as bytes: its scale, the length of what rounding leaves out, a byte a component."""
    scale = np.abs(x).max(axis=1) / 127
    rounded = np.rint(x / scale[:, None]).astype(np.int8)
    scale = scale.astype(np.float32)
    rest = np.linalg.norm(x - rounded * scale[:, None].astype(np.float64), axis=1) * (1 + 1e-6)
    head = np.stack([scale, rest.astype(np.float32) + np.float32(1e-7)], axis=1)
    return np.concatenate([head.view(np.int8), rounded], axis=1)


def most_alike(sketched: np.ndarray, left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Upper bounds of the cosines of the rows ``left`` with the rows ``right``."""
    scale, rest = np.ascontiguousarray(sketched[:, :8]).view(np.float32).T
    x = sketched[:, 8:].astype(np.float32) * scale[:, None]
    # Beside the rounded vectors' product: each rest with the other vector, whose length is at most one more than its rest.
    slack = rest[left][:, None] + rest[right] + 3 * rest[left][:, None] * rest[right]
    return x[left] @ x[right].T + slack + np.float32(1e-4)


def _cells(with_sketches: bool, settings: tuple):
    def run(batches):
        for batch in batches:
            for part in _by_length(batch):
                x = matrix(pa.concat_arrays([part.column("embedding")]))
                found = cells(x, *settings)
                n, _, each = found.shape
                own = np.zeros(found.shape, dtype=bool)
                own[:, :, 0] = True
                source = pa.array(np.repeat(np.arange(n), found.shape[1] * each))
                columns = {"bucket": pa.array(found.ravel()), "own": pa.array(own.ravel()), "head": part.column("head").take(source)}
                if with_sketches:
                    columns["sketch"] = binary([row.tobytes() for row in sketches(x)]).take(source)
                yield pa.RecordBatch.from_pydict(columns)
    return run


def _canonical(bucket: int, a: np.ndarray, b: np.ndarray, own_cells: np.ndarray) -> np.ndarray:
    """Whether the pairs of rows (a, b), a's head below b's, count in this bucket: the first
    table that finds a pair has it, in the first one's own cell if the other looks there."""
    first, undecided = np.zeros(len(a), dtype=np.int64), np.ones(len(a), dtype=bool)
    for t in range(own_cells.shape[1]):
        at_a, at_b = own_cells[a, t, 0], own_cells[b, t, 0]
        in_a = (own_cells[b, t] == at_a[:, None]).any(axis=1)
        in_b = (own_cells[a, t] == at_b[:, None]).any(axis=1)
        first = np.where(undecided & in_a, at_a, np.where(undecided & in_b, at_b, first))
        undecided &= ~(in_a | in_b)
    return first == bucket


def linked(bucket: int, heads: np.ndarray, copies: np.ndarray, stored: np.ndarray, asking: np.ndarray, own: np.ndarray, x: np.ndarray, least: float, settings: tuple):
    """Rows with links in one block of a bucket: heads, copies of linked vectors that count here, smallest connected head."""
    left, right = np.flatnonzero(stored), np.flatnonzero(asking)
    i, j = np.nonzero(x[left] @ x[right].T >= least)
    i, j = left[i], right[j]
    # Of two stored vectors, which ask for each other, the one with the smaller head is asked.
    once = np.where(own[j], heads[i] < heads[j], heads[i] != heads[j])
    i, j = i[once], j[once]
    if not len(i):
        return None
    here, back = np.unique(np.concatenate([i, j]), return_inverse=True)
    i, j = back[:len(i)], back[len(i):]
    # A head may be here as a stored and as an asking row.
    names, number = np.unique(heads[here], return_inverse=True)
    example = np.zeros(len(names), dtype=np.int64)
    example[number] = here
    i, j = number[i], number[j]
    pairs = np.unique(np.minimum(i, j) * len(names) + np.maximum(i, j))
    i, j = pairs // len(names), pairs % len(names)
    near = np.zeros((len(names), len(names)), dtype=bool)
    near[i, j] = near[j, i] = True
    counts = _canonical(bucket, i, j, cells(x[example], *settings))
    i, j, weight = i[counts], j[counts], copies[example]
    links = np.bincount(i, weight[j], minlength=len(names)) + np.bincount(j, weight[i], minlength=len(names))
    return names, links.astype(np.int64), names[spanning(near)]


KEYS = ("bucket", "i", "j")


def _by_block(batches, of_block):
    """What ``of_block`` yields for each block of a partition sorted by block; a block may reach over batches."""
    kept = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if kept is None else pa.concat_tables([kept, table])
        columns = [table[k].to_numpy() for k in KEYS]
        ends = np.flatnonzero(np.any([c[1:] != c[:-1] for c in columns], axis=0)) + 1
        for low, high in zip([0, *ends.tolist()], ends.tolist(), strict=False):
            yield from of_block(table.slice(low, high - low))
        kept = table.slice(int(ends[-1]) if len(ends) else 0).combine_chunks()
    if kept is not None and kept.num_rows:
        yield from of_block(kept)


def _hopeful(least: float):
    """The rows of all blocks that may have a link there, as far as sketches tell."""
    def of_block(table: pa.Table):
        if table.num_rows < 2:
            return
        role = table["role"].to_numpy()
        sketch = table["sketch"].combine_chunks()
        sizes = np.diff(np.frombuffer(sketch.buffers()[1], dtype=np.int32)[sketch.offset:sketch.offset + len(sketch) + 1])
        heads = table["head"].to_numpy()
        for size in np.unique(sizes):
            mine = np.flatnonzero(sizes == size)
            left, right = mine[(role[mine] & STORED) > 0], mine[(role[mine] & ASKING) > 0]
            if not len(left) or not len(right):
                continue
            own = np.frombuffer(b"".join(sketch.take(pa.array(mine)).to_pylist()), dtype=np.int8).reshape(len(mine), -1)
            at = lambda rows: np.searchsorted(mine, rows)
            near = most_alike(own, at(left), at(right)) >= least
            near &= heads[left][:, None] != heads[right]
            some = np.unique(np.concatenate([left[near.any(axis=1)], right[near.any(axis=0)]]))
            if len(some):
                yield from table.select([*KEYS, "role", "head"]).take(pa.array(some)).to_batches()

    return lambda batches: _by_block(batches, of_block)


def _verify(least: float, settings: tuple):
    """Links of all blocks."""
    def of_block(table: pa.Table):
        role = table["role"].to_numpy()
        embedding = table["embedding"].combine_chunks()
        sizes = np.diff(embedding.offsets.to_numpy())
        for size in np.unique(sizes):
            mine = sizes == size
            part = table.filter(pa.array(mine)) if not mine.all() else table
            x, roles = matrix(part["embedding"].combine_chunks()), role[mine]
            stored, asking, own = ((roles & bit) > 0 for bit in (STORED, ASKING, OWN))
            found = linked(part["bucket"][0].as_py(), part["head"].to_numpy(), part["copies"].to_numpy(), stored, asking, own, x, least, settings)
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in found], names=["head", "links", "least"])

    return lambda batches: _by_block(batches, of_block)


def near_vectors(
    vectors: DataFrame, id_col: str = "vec_id", embedding_col: str = "embedding", least: float = 0.9,
    tables: int = TABLES, probes: int = PROBES, scale: float = SCALE, block: int = BLOCK,
) -> DataFrame:
    """One row per row of ``vectors``: ``row, vec_id, n_links, component_id, kept``.

    ``n_links`` counts the other rows with a cosine of at least ``least`` that are found;
    ``component_id`` is the smallest id reachable by links, null ids last; the row
    that has it stays, one of repeated rows. A vector that is null, empty, zero or
    holds null or non-finite components links with nothing, and vectors of different
    lengths don't link. Other columns are not read.
    """
    small_batches(vectors.sparkSession)
    settings = (tables, probes, scale)
    given = vectors.select(F.col(id_col).alias("doc_id"), F.col(embedding_col).alias("embedding")).withColumn("row", F.monotonically_increasing_id())
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.size("embedding") > 0, F.lit(False)) & finite & F.exists("embedding", lambda x: x != 0)
    rows = written(given.select("row", "doc_id", F.when(usable, F.col("embedding")).alias("print")), "vectors")
    heads = rows.where("print is not null").groupBy("print").agg(F.min("row").alias("head"), F.count(F.lit(1)).alias("copies"))
    heads = written(heads, "heads")
    unique = heads.select("head", "copies", F.col("print").alias("embedding"))

    narrow = unique.mapInArrow(_cells(False, settings), "bucket long, own boolean, head long")
    large = narrow.groupBy("bucket").agg(F.sum(F.col("own").cast("long")).alias("stored"), F.count(F.lit(1)).alias("entries"))
    large = written(large.where(F.col("entries") > block), "large")
    entries = unique.mapInArrow(_cells(True, settings), "bucket long, own boolean, head long, sketch binary")
    entries = entries.join(checked_broadcast(large), "bucket", "left")
    across, down = (F.greatest(F.lit(1), F.ceil(F.coalesce(c, F.lit(1)) / block)).cast("int") for c in ("stored", "entries"))
    mine = lambda n: F.pmod(F.xxhash64("head"), n).cast("int")
    role = F.when(F.col("own"), ASKING | OWN).otherwise(ASKING)
    place = lambda i, j, role: F.struct(F.lit(i).cast("int").alias("i"), F.lit(j).cast("int").alias("j"), F.lit(role).cast("int").alias("role"))
    asking = F.transform(F.sequence(F.lit(0), across - 1), lambda i: place(i, mine(down), role))
    stored = F.transform(F.sequence(F.lit(0), down - 1), lambda j: place(mine(across), j, STORED))
    alone = F.array(place(0, 0, F.when(F.col("own"), STORED | ASKING | OWN).otherwise(ASKING)))
    places = F.when(F.col("entries").isNull(), alone).when(F.col("own"), F.concat(stored, asking)).otherwise(asking)
    entries = entries.select("bucket", F.explode(places).alias("place"), "head", "sketch")
    blocks = entries.select("bucket", "place.*", "head", "sketch").repartition(*KEYS).sortWithinPartitions(*KEYS)
    hopeful = written(blocks.mapInArrow(_hopeful(least), "bucket long, i int, j int, role int, head long"), "hopeful")
    blocks = hopeful.join(unique, "head").repartition(*KEYS).sortWithinPartitions(*KEYS)
    found = written(blocks.mapInArrow(_verify(least, settings), "head long, links long, least long"), "found")

    links = found.groupBy("head").agg(F.sum("links").alias("links"))
    groups = written(components(found.select(F.col("head").alias("a"), F.col("least").alias("b"))).withColumnRenamed("node", "row"), "groups")
    heads = heads.join(links, "head", "left").select("print", "head", "copies", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    out = labelled(rows, written(heads, "heads"), groups)
    return out.select("row", F.col("doc_id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "component_id", "kept")
