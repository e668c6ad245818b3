"""Harmonic packing of tokenised documents into sequences of fixed capacity.

A piece of length n belongs to class k when k such pieces fill a sequence:
k = capacity // n. A class's sequences take exactly k pieces, so a worker fills
them on its own, piece by piece, without looking at any other class or worker. As
documents may be cut, a length that would leave too much of its class's sequence
empty is cut at the nearest reciprocal of the capacity below it, and the rest is
classed again.

What a worker can't complete (fewer than k pieces a class) is numbered across
workers from counts a worker and class, and completes sequences there. What then
remains is less than one sequence a class, a bounded number of tokens, and is laid
end to end.
"""

import os
import re
import zlib
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from ledgerflow.llm.store import small_batches, written
from ledgerflow.llm.words import IS_SPACE, LOWER, flat, located_words, run_hashes, slices

CAPACITY = 2048
SLACK = 64  # tokens that a class may leave empty in a sequence
END_ID = 1

# Fixed value: the split pattern of word-end BPE tokenizers.
SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
WORD_END = "</w>"  # fixed value: marks a word's last token in the vocabulary
PLAIN = re.compile("[\t\n\r -~¡-įı-ňŊ-ſ]*")  # lower case and composition are the same in all libraries
# Of these, texts without apostrophes and symbols beyond ASCII: a pre-token there is a run of
# letters, a run of marks, or a digit.
SIMPLE = re.compile("[\t\n\r -&(-~À-ÖØ-öø-įı-ňŊ-ſ]*")
KIND = np.full(256, 3, dtype=np.uint8)
KIND[[*range(ord("A"), ord("Z") + 1), *range(ord("a"), ord("z") + 1), *range(0x80, 256)]] = 1
KIND[ord("0"):ord("9") + 1] = 2
KIND[IS_SPACE] = 0
MOST_KNOWN = 1_000_000  # words whose ids a worker remembers at a time, in about 35 MB
MERGE_FROM = 100_000
FLUSH_TOKENS = 1 << 19


class _Memory:
    """Ids of words by the words' 64-bit hashes, in a few arrays.

    Hashes are kept sorted; new ones are kept apart until there are enough to merge.
    """

    def __init__(self):
        self.old = self.new = (np.zeros(0, dtype=np.uint64), np.zeros(0, dtype=np.int64))
        self.starts, self.ids = np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        """The number of each hash, -1 for unknown ones."""
        out = np.full(len(hashes), -1, dtype=np.int64)
        for keys, numbers in (self.old, self.new):
            if len(keys):
                at = np.minimum(np.searchsorted(keys, hashes), len(keys) - 1)
                out = np.where(keys[at] == hashes, numbers[at], out)
        return out

    def add(self, hashes: np.ndarray, ids: np.ndarray, bounds: np.ndarray) -> None:
        numbers = np.arange(len(self.starts) - 1, len(self.starts) - 1 + len(hashes))
        self.new = self._merged(self.new, (hashes, numbers))
        if len(self.new[0]) > MERGE_FROM:
            self.old, self.new = self._merged(self.old, self.new), (self.new[0][:0], self.new[1][:0])
        self.starts = np.concatenate([self.starts, self.starts[-1] + bounds[1:]])
        self.ids = np.concatenate([self.ids, ids])

    @staticmethod
    def _merged(a: tuple, b: tuple) -> tuple:
        keys = np.concatenate([a[0], b[0]])
        order = np.argsort(keys, kind="stable")
        return keys[order], np.concatenate([a[1], b[1]])[order]


class Encoder:
    """Token ids of lower-casing word-end BPE tokenizers, remembered word by word.

    No pre-token crosses white space, so a text's ids are those of its words, and in a
    simple text those of its runs of letters, marks or single digits. Texts with other
    characters than ASCII and Latin letters, or with a special token's string, are
    encoded whole by the tokenizer.
    """

    def __init__(self, tokenizer_json: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.ends_word = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.ends_word[[number for token, number in vocabulary.items() if token.endswith(WORD_END)]] = True
        if self.tokenizer.model.end_of_word_suffix != WORD_END:
            raise ValueError("a BPE tokenizer with marked word ends is expected")
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.split = regex.compile(SPLIT).findall
        self.memory = _Memory()

    def _whole(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=np.int32)

    def _parts(self, pretokens: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of pre-tokens, encoded in one text and told apart by word ends, and where each starts."""
        ids = self._whole(" ".join(pretokens))
        ends = np.flatnonzero(self.ends_word[ids]) + 1 if len(ids) else np.zeros(0, dtype=np.int64)
        if len(ends) != len(pretokens):
            pieces = [self._whole(p) for p in pretokens]
            ids, ends = np.concatenate(pieces), np.cumsum([len(p) for p in pieces])
        return ids, np.concatenate([[0], ends])

    def _learn(self, hashes: np.ndarray, new: list[str], whole: bool) -> None:
        """Ids of new strings from those of their distinct pre-tokens, or of pre-tokens (``whole``)."""
        if whole:
            self.memory.add(hashes, *self._parts(new))
            return
        parts = [self.split(word) for word in new]
        own = list(set(chain.from_iterable(parts)))
        ids, starts = self._parts(own)
        number = dict(zip(own, range(len(own)), strict=True))
        order = np.fromiter(map(number.__getitem__, chain.from_iterable(parts)), np.int64)
        counts = np.fromiter(map(len, parts), np.int64, len(parts))
        bounds = np.concatenate([[0], np.cumsum(starts[order + 1] - starts[order])])[np.concatenate([[0], np.cumsum(counts)])]
        self.memory.add(hashes, gathered(ids, starts, order), bounds)

    def _plain(self, column, simple: bool) -> list[np.ndarray]:
        data, starts = flat(column)
        if simple:
            data = LOWER[data]
            first, end = runs(data, starts)
            hashes = run_hashes(data, first, end)
        else:
            hashes, first, end = located_words(data, starts)
        distinct, example, back = np.unique(hashes, return_index=True, return_inverse=True)
        if len(self.memory.starts) > MOST_KNOWN:
            self.memory = _Memory()
        numbers = self.memory.find(distinct)
        unknown = np.flatnonzero(numbers < 0)
        if len(unknown):
            raw, at = data.tobytes(), example[unknown]
            new = [raw[lo:hi].decode().lower() for lo, hi in zip(first[at].tolist(), end[at].tolist(), strict=True)]
            self._learn(distinct[unknown], new, simple)
            numbers[unknown] = np.arange(len(self.memory.starts) - 1 - len(unknown), len(self.memory.starts) - 1)
        order = numbers[back]
        ids = gathered(self.memory.ids, self.memory.starts, order)
        upto = np.concatenate([[0], np.cumsum(self.memory.starts[order + 1] - self.memory.starts[order])])
        return np.split(ids, upto[np.searchsorted(first, starts[1:-1])]) if len(starts) > 1 else []

    def encode(self, column) -> list[np.ndarray]:
        """The ids of each text of an Arrow column; none for null."""
        texts = [t or "" for t in column.to_pylist()]
        plain = [PLAIN.fullmatch(t) is not None and not any(s in t for s in self.special) for t in texts]
        simple = [p and SIMPLE.fullmatch(t) is not None for p, t in zip(plain, texts, strict=True)]
        by_run = iter(self._plain(column.filter(pa.array(simple, pa.bool_())), True))
        by_word = iter(self._plain(column.filter(pa.array([p and not s for p, s in zip(plain, simple, strict=True)], pa.bool_())), False))
        return [next(by_run) if s else next(by_word) if p else self._whole(t) for t, p, s in zip(texts, plain, simple, strict=True)]


def runs(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First bytes and ends of the pre-tokens of simple texts."""
    kind = KIND[data]
    begins = np.empty(len(data), dtype=bool)
    begins[:1] = True
    begins[1:] = (kind[1:] != kind[:-1]) | (kind[1:] == 2)
    begins[starts[starts < len(data)]] = True
    first = np.flatnonzero(begins)
    end = np.append(first[1:], len(data))
    own = kind[first] > 0
    return first[own], end[own]


def gathered(values: np.ndarray, bounds: np.ndarray, order: np.ndarray) -> np.ndarray:
    """The runs of ``values`` between bounds[k] and bounds[k + 1] for each k of ``order``."""
    sizes = bounds[order + 1] - bounds[order]
    ends = np.cumsum(sizes)
    if not len(order) or not ends[-1]:
        return values[:0]
    return values[np.arange(ends[-1]) + np.repeat(bounds[order] - ends + sizes, sizes)]


def harmonic_cuts(capacity: int, slack: int) -> list[list[tuple[int, int]]]:
    """For each length up to the capacity its pieces, as lengths with their class."""
    cuts: list[list[tuple[int, int]]] = [[]]
    fits = [0, *(capacity // k for k in range(1, capacity + 1))]
    for n in range(1, capacity + 1):
        k = capacity // n
        if capacity - k * n <= slack:
            cuts.append([(n, k)])
            continue
        j = next(j for j in range(k + 1, capacity + 1) if capacity - j * fits[j] <= slack)
        cuts.append([(fits[j], j), *cuts[n - fits[j]]])
    return cuts


FIELDS = ("doc_id", "start", "length", "doc_tokens", "part", "class_size", "place", "offset", "complete", "ids")


class _Rows:
    """Finished pieces on their way to an Arrow batch."""

    def __init__(self, ids_type):
        self.types = {"doc_id": ids_type, "complete": pa.bool_(), "ids": pa.list_(pa.int32()), "part": pa.int32(), "class_size": pa.int32()}
        self.columns: dict[str, list] = {f: [] for f in FIELDS}
        self.tokens = 0

    def add(self, *values) -> None:
        for field, value in zip(FIELDS, values, strict=True):
            self.columns[field].append(value)
        self.tokens += len(values[-1])

    def batch(self) -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(v, self.types.get(f, pa.int64())) for f, v in self.columns.items()], names=list(FIELDS))
        self.columns, self.tokens = {f: [] for f in FIELDS}, 0
        return out


_encoders: dict[str, Encoder] = {}


def _fill(shared, capacity: int, slack: int, end_id: int):
    def run(batches):
        if shared.value not in _encoders:
            _encoders.clear()
            _encoders[shared.value] = Encoder(shared.value)
        encoder, cuts, part = _encoders[shared.value], harmonic_cuts(capacity, slack), TaskContext.get().partitionId()
        waiting: dict[int, list] = {}
        rows, sequences = None, 0
        for batch in batches:
            for some in slices(batch):
                rows = rows or _Rows(some.column("doc_id").type)
                for doc_id, ids in zip(some.column("doc_id").to_pylist(), encoder.encode(some.column("text")), strict=True):
                    ids, at = np.append(ids, np.int32(end_id)), 0
                    total = len(ids)
                    pieces = [(capacity, 1)] * (total // capacity) + cuts[total % capacity]
                    for length, k in pieces:
                        bin_ = waiting.setdefault(k, [])
                        bin_.append((doc_id, at, ids[at:at + length], total))
                        at += length
                        if len(bin_) == k:
                            offset = 0
                            for own, start, piece, tokens in bin_:
                                rows.add(own, start, len(piece), tokens, part, k, sequences, offset, True, piece)
                                offset += len(piece)
                            sequences += 1
                            waiting[k] = []
                    if rows.tokens >= FLUSH_TOKENS:
                        yield rows.batch()
        for k, bin_ in sorted(waiting.items()):
            for place, (own, start, piece, tokens) in enumerate(bin_):
                rows.add(own, start, len(piece), tokens, part, k, place, None, False, piece)
        if rows is not None:
            yield rows.batch()
    return run


OUTPUT = ("doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids")
ACROSS, REST = 1 << 61, 1 << 62  # sequence ids of the two later rounds start here


def _lay(capacity: int):
    """All rows end to end, cut at the capacity; the last sequence in powers of two."""
    def run(batches):
        table = pa.Table.from_batches(batches)
        if not table.num_rows:
            return
        total, bounds = sum(table["length"].to_pylist()), [0]
        while bounds[-1] < total:
            left = total - bounds[-1]
            bounds.append(bounds[-1] + (capacity if left >= capacity else 1 << (left.bit_length() - 1)))
        out: list = [[] for _ in OUTPUT]
        at = k = 0
        for row in table.to_pylist():
            used = 0
            while used < row["length"]:
                take = min(row["length"] - used, bounds[k + 1] - at)
                values = (row["doc_id"], row["start"] + used, take, row["doc_tokens"], REST + k, at - bounds[k], row["ids"][used:used + take])
                for column, value in zip(out, values, strict=True):
                    column.append(value)
                used, at = used + take, at + take
                k += at == bounds[k + 1]
        types = [table.schema.field("doc_id").type, *[pa.int64()] * 5, pa.list_(pa.int32())]
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types, strict=True)], names=list(OUTPUT))
    return run


def pack(
    docs: DataFrame, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text",
    capacity: int = CAPACITY, slack: int = SLACK, end_id: int = END_ID,
) -> DataFrame:
    """``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` for each piece.

    A row's tokens are those of its text, then ``end_id``; a null text is empty, so
    it has that one token. Each token is in one piece. A sequence leaves at most
    ``slack`` tokens empty; the last few of all, fewer than the bits of the capacity,
    hold a power of two instead. Ids may be null or repeated, rows are never
    joined by them. Other columns are not read. No rows give no pieces.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = file.read()
    Encoder(tokenizer)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(tokenizer)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    shape = f"doc_id {kind}, start long, length long, doc_tokens long, part int, class_size int, place long, offset long, complete boolean, ids array<int>"
    pieces = written(texts.mapInArrow(_fill(shared, capacity, slack, end_id), shape), "pieces")
    complete = pieces.where("complete").withColumn("sequence_id", F.col("part").cast("long") * F.lit(1 << 38) + F.col("place"))

    # Left over: at most k - 1 pieces of class k from each worker.
    left = pieces.where("not complete")
    before = Window.partitionBy("class_size").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    counts = left.groupBy("part", "class_size").agg(F.count(F.lit(1)).alias("n"))
    counts = written(counts.select("part", "class_size", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"), F.sum("n").over(Window.partitionBy("class_size")).alias("all")), "counts")
    numbered = left.drop("offset").join(counts, ["part", "class_size"]).withColumn("number", F.col("first") + F.col("place"))
    sequence = F.expr("number div class_size")
    numbered = numbered.withColumn("sequence", sequence).withColumn("whole", (F.col("sequence") + 1) * F.col("class_size") <= F.col("all"))
    inside = Window.partitionBy("class_size", "sequence").orderBy("number").rowsBetween(Window.unboundedPreceding, -1)
    across = numbered.where("whole").withColumn("offset", F.coalesce(F.sum("length").over(inside), F.lit(0)))
    across = across.withColumn("sequence_id", F.lit(ACROSS) + F.col("class_size").cast("long") * F.lit(1 << 38) + F.col("sequence"))
    # Less than a sequence of each class: as many tokens at most, whatever the input.
    rest = numbered.where("not whole").select("class_size", "number", "doc_id", "start", "length", "doc_tokens", "ids")
    rest = rest.repartition(1).sortWithinPartitions("class_size", "number").drop("class_size", "number")
    rest = rest.mapInArrow(_lay(capacity), f"doc_id {kind}, start long, length long, doc_tokens long, sequence_id long, offset long, ids array<int>")
    return complete.select(*OUTPUT).union(across.select(*OUTPUT)).union(rest)


def _crc32(batches):
    for batch in batches:
        ids = batch.column("ids")
        values, ends = ids.values.to_numpy(zero_copy_only=False).astype("<u4"), ids.offsets.to_pylist()
        sums = [zlib.crc32(values[lo:hi].tobytes()) for lo, hi in zip(ends, ends[1:], strict=False)]
        rest = [batch.column(name) for name in OUTPUT[:-1]]
        yield pa.RecordBatch.from_arrays([*rest, pa.array(sums, pa.int64())], names=[*OUTPUT[:-1], "ids_crc32"])


def checksums(pieces: DataFrame) -> DataFrame:
    """``pieces`` with ``ids_crc32``, the unsigned CRC-32 of the little-endian ids, instead of ``ids``."""
    kinds = {name: pieces.schema[name].dataType.simpleString() for name in OUTPUT[:-1]}
    return pieces.select(*OUTPUT).mapInArrow(_crc32, ", ".join(f"{n} {k}" for n, k in kinds.items()) + ", ids_crc32 long")
