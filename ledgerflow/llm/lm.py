"""Language-model scores from a log-frequency Bloom filter of quantised n-gram counts.

Counting: tasks count word and word-pair hashes locally, sort them into hash ranges
and send whole arrays; a range is merged by one task. Ranges are sized by the input,
so none grows with it, and a frequent n-gram is one entry of a task's array.

Model: a count c becomes the level 1 + floor(log c); an n-gram of level q is in the
filter q times, once for each level up to its own. A lookup probes levels upwards until
one is missing. The filter is broadcast up to a bounded size. A larger one stays in its
segments, a hash range each: tasks ask for the distinct n-grams of some million tokens,
the questions meet their segment in a shuffled join and the answers meet the texts in
another. The filter's bits, and so the scores, are the same either way.

Score: P(w | h) = D * C(h w) / C(h) + g * (C(w) + 1) / (N + V + 1) with quantised counts
C; g is what the pairs in the filter leave, measured over all training texts for each
level of the context. The exact base score takes the counts of the most frequent words
from a bounded broadcast table and those of all other words from a shuffled join.
"""

from types import SimpleNamespace

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerflow.llm.store import small_batches, written
from ledgerflow.llm.words import flat, mix, slices, word_hashes

END, START = np.uint64(0x1D8E4E27C47D124F), np.uint64(0x5851F42D4C957F2D)  # tokens that are no word
STEP = 1.5  # ratio of two levels' counts
LEVELS = 80
PAIR_FROM = 1  # least count of a pair in the filter: all of them
PROBES, BITS_AN_ENTRY = 4, 12
MOST_FILTER_BYTES = 128 << 20  # broadcast; a larger filter is joined
MOST_FREQUENT = 1 << 20  # words whose exact counts are broadcast
DISCOUNT = 0.5
TOKENS_A_RANGE = 1 << 20
ROWS_A_PART = 1 << 14
TOKENS_HELD = 1 << 21  # tokens that a task counts before it sends


def levels_of(counts: np.ndarray, first: int) -> np.ndarray:
    return np.minimum(1 + np.floor(np.log(np.maximum(counts, first) / first) / np.log(STEP) + 1e-9), LEVELS - 1).astype(np.int64)


def level_counts(first: int) -> np.ndarray:
    """The count that each level stands for: the mean of its whole numbers, 0 for level 0."""
    edges = first * STEP ** np.arange(LEVELS)
    low, high = np.ceil(edges - 1e-6), np.ceil(edges * STEP - 1e-6) - 1
    middle = np.where(high >= low, (low + high) / 2, edges)
    return np.concatenate([[0.0], middle[:-1]])


def tokens_of(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Token hashes of all texts with an end after each, the token before each, and where texts start."""
    words, at = word_hashes(*flat(column))
    starts = at + np.arange(len(at))
    tokens = np.empty(len(words) + len(at) - 1, dtype=np.uint64)
    ends = starts[1:] - 1
    inner = np.ones(len(tokens), dtype=bool)
    inner[ends] = False
    tokens[inner], tokens[ends] = words, END
    before = np.empty_like(tokens)
    before[1:] = tokens[:-1]
    before[starts[:-1]] = START
    return tokens, before, starts


def pairs_of(before: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    return mix(before * np.uint64(0x9FB21C651E98DF25) + tokens)


def _ranges(hashes: np.ndarray, bits: int) -> np.ndarray:
    return (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), dtype=np.int64)


def _tail(hashes: np.ndarray, bits: int) -> np.ndarray:
    """The 32 bits after a pair's range: enough to tell the pairs of one range apart."""
    return ((hashes << np.uint64(bits)) >> np.uint64(32)).astype(np.uint32)


COUNTS = "kind string, range long, keys binary, counts binary"


def _count(word_bits: int, pair_bits: int):
    def sent(kind: str, parts: list, bits: int):
        keys, counts = np.unique(np.concatenate(parts), return_counts=True)
        ends = np.searchsorted(_ranges(keys, bits), np.arange((1 << bits) + 1))
        held = [k for k in range(1 << bits) if ends[k] < ends[k + 1]]
        stored = keys if kind == "word" else _tail(keys, bits)
        return pa.RecordBatch.from_arrays(
            [pa.array([kind] * len(held)), pa.array(held, pa.int64()), pa.array([stored[ends[k]:ends[k + 1]].tobytes() for k in held], pa.binary()),
             pa.array([counts[ends[k]:ends[k + 1]].astype(np.uint32).tobytes() for k in held], pa.binary())], names=["kind", "range", "keys", "counts"])

    def run(batches):
        words, pairs, held = [], [], 0
        for batch in batches:
            for part in slices(batch):
                tokens, before, _ = tokens_of(part.column("text"))
                words.append(tokens)
                pairs.append(pairs_of(before, tokens))
                held += len(tokens)
                if held >= TOKENS_HELD:
                    yield sent("word", words, word_bits)
                    yield sent("pair", pairs, pair_bits)
                    words, pairs, held = [], [], 0
        if held:
            yield sent("word", words, word_bits)
            yield sent("pair", pairs, pair_bits)
    return run


def _joined(column, kind) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype=kind)


def _merge(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
    """One range: distinct keys with their summed counts, those seen at least as often as the filter takes them."""
    kind, number = key[0].as_py(), key[1].as_py()
    keys, back = np.unique(_joined(table["keys"], np.uint64 if kind == "word" else np.uint32), return_inverse=True)
    counts = np.bincount(back, _joined(table["counts"], np.uint32)).astype(np.int64)
    first = 1 if kind == "word" else PAIR_FROM
    all_, total = len(keys), int(counts.sum())
    keys, counts = keys[counts >= first], counts[counts >= first]
    sizes = np.bincount(levels_of(counts, first), minlength=LEVELS)
    return pa.table({
        "kind": [kind], "range": [number], "keys": pa.array([keys.tobytes()], pa.binary()), "counts": pa.array([counts.tobytes()], pa.binary()),
        "distinct": [all_], "total": [total], "sizes": pa.array([sizes.tolist()], pa.list_(pa.int64()))})


class Filter:
    """A Bloom filter in equal segments, one for each range of hashes.

    All bits of an entry lie in one 64-bit word, so a probe reads memory once.
    """

    def __init__(self, bits: int, segment_words: int, least: dict[str, int]):
        self.bits, self.segment_words, self.least = bits, segment_words, least
        self.words = np.zeros(0, dtype=np.uint64)

    def places(self, hashes: np.ndarray, level: int) -> tuple[np.ndarray, np.ndarray]:
        """The word within its segment, and the bits there, of each entry (hash, level)."""
        a = mix(hashes + np.uint64(0xA0761D6478BD642F * level & (1 << 64) - 1))
        word, mask = ((a >> np.uint64(32)) * np.uint64(self.segment_words)) >> np.uint64(32), np.zeros_like(a)
        for probe in range(PROBES):
            mask |= np.uint64(1) << ((a >> np.uint64(6 * probe)) & np.uint64(63))
        return word, mask

    def levels(self, hashes: np.ndarray, first: int) -> np.ndarray:
        """The level of each hash by repeated probes, 0 where even the least is missing."""
        out = np.zeros(len(hashes), dtype=np.int64)
        base = _ranges(hashes, self.bits).astype(np.uint64) * np.uint64(self.segment_words)
        left = np.arange(len(hashes))
        for level in range(first, LEVELS):
            word, mask = self.places(hashes[left], level)
            left = left[(self.words[base[left] + word] & mask) == mask]
            if not len(left):
                break
            out[left] = level
        return out


class Answers:
    """The levels that a filter gave for the hashes of some texts."""

    def __init__(self, table: pa.Table, least: dict[str, int]):
        self.least = least
        self.hashes, first = np.unique(_joined(table["keys"], np.uint64), return_index=True)
        self.found = _joined(table["levels"], np.uint8)[first].astype(np.int64)

    def levels(self, hashes: np.ndarray, first: int) -> np.ndarray:
        return self.found[np.searchsorted(self.hashes, hashes)]


def pair_entries(tails: np.ndarray, number, bits: int) -> np.ndarray:
    """The hashes under which the pairs of a range, or of a range each, are in the filter;
    they begin with the range. A word is there under its own hash."""
    number = np.asarray(number).astype(np.uint64)
    return number << np.uint64(64 - bits) | (mix(tails.astype(np.uint64) + np.uint64(0x2545F4914F6CDD1D) * number) >> np.uint64(bits))


def _fill(empty: Filter, pair_bits: int):
    def run(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        segment = np.zeros(empty.segment_words, dtype=np.uint64)
        for kind, number, keys, counts in zip(*(table[c].to_pylist() for c in ("kind", "range", "keys", "counts")), strict=True):
            pair = kind == "pair"
            hashes = pair_entries(np.frombuffer(keys, np.uint32), number, pair_bits) if pair else np.frombuffer(keys, np.uint64)
            own = levels_of(np.frombuffer(counts, np.int64), PAIR_FROM if pair else 1)
            for level in range(empty.least[kind], int(own.max(initial=0)) + 1):
                np.bitwise_or.at(segment, *empty.places(hashes[own >= level], level))
        return pa.table({"segment": [key[0].as_py()], "bits": pa.array([segment.tobytes()], pa.binary())})
    return run


def _lookup(model: dict, tokens: np.ndarray, before: np.ndarray, words: np.ndarray, back: np.ndarray):
    """Levels of each token, of the word before it, and of both together.

    ``words`` are the distinct tokens, ``back`` the place of each token among them.
    """
    of_words = model["filter"].levels(words, model["filter"].least["word"])
    of_token = of_words[back]
    of_before = np.empty_like(of_token)
    of_before[1:] = of_token[:-1]
    of_before[before == START] = model["start_level"]
    # A kept pair's words occur as often at least; others need no probes.
    maybe = np.flatnonzero((of_token >= model["pair_level"]) & (of_before >= model["pair_level"]))
    hashes, back = np.unique(pairs_of(before[maybe], tokens[maybe]), return_inverse=True)
    bits = model["pair_bits"]
    found = model["filter"].levels(pair_entries(_tail(hashes, bits), _ranges(hashes, bits), bits), model["filter"].least["pair"])
    of_pair = np.zeros_like(of_token)
    of_pair[maybe] = found[back]
    return of_token, of_before, of_pair


CHUNKS = "chunk long, row long, doc_id {kind}, held_out boolean, text string, segment long, keys binary"


def _ask(word_bits: int, pair_bits: int, tokens_a_chunk: int, id_type: pa.DataType):
    """The rows with the number of their chunk, and the distinct hashes that each chunk asks of each segment."""
    def asked(chunk: int, hashes: list):
        keys = np.unique(np.concatenate(hashes))
        ends = np.searchsorted(_ranges(keys, word_bits), np.arange((1 << word_bits) + 1))
        held = [k for k in range(1 << word_bits) if ends[k] < ends[k + 1]]
        n = len(held)
        return pa.RecordBatch.from_arrays(
            [pa.array([chunk] * n, pa.int64()), *(pa.nulls(n, t) for t in (pa.int64(), id_type, pa.bool_(), pa.string())),
             pa.array(held, pa.int64()), pa.array([keys[ends[k]:ends[k + 1]].tobytes() for k in held], pa.binary())],
            names=[f.split()[0] for f in CHUNKS.split(", ")])

    def run(batches):
        chunk, hashes, held = None, [], 0
        for batch in batches:
            for part in slices(batch):
                tokens, before, _ = tokens_of(part.column("text"))
                pairs = np.unique(pairs_of(before, tokens))
                hashes += [np.unique(tokens), pair_entries(_tail(pairs, pair_bits), _ranges(pairs, pair_bits), pair_bits)]
                held += len(tokens)
                chunk = part.column("row")[0].as_py() if chunk is None else chunk
                n = part.num_rows
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk] * n, pa.int64()), *(part.column(c) for c in ("row", "doc_id", "held_out", "text")), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary())],
                    names=[f.split()[0] for f in CHUNKS.split(", ")])
                if held >= tokens_a_chunk:
                    yield asked(chunk, hashes)
                    chunk, hashes, held = None, [], 0
        if held:
            yield asked(chunk, hashes)
    return run


def _answer(filled: Filter):
    """One segment: the levels of all hashes that chunks ask of it."""
    def run(key: tuple[pa.Scalar, ...], asked: pa.Table, segment: pa.Table) -> pa.Table:
        alone = Filter(0, filled.segment_words, filled.least)
        alone.words = _joined(segment["bits"], np.uint64)
        chunks, keys, levels = asked["chunk"], asked["keys"], []
        for k in keys.to_pylist():
            hashes = np.frombuffer(k, np.uint64)
            found = alone.levels(hashes, 1) if len(alone.words) else np.zeros(len(hashes), dtype=np.int64)
            levels.append(found.astype(np.uint8).tobytes())
        return pa.table({"chunk": chunks, "keys": keys, "levels": pa.array(levels, pa.binary())})
    return run


def _with_answers(shared, step):
    """``step``, a function of a shared model that reads batches, over one chunk with its answers."""
    def run(key: tuple[pa.Scalar, ...], rows: pa.Table, answers: pa.Table) -> pa.Table:
        own = shared.value | {"filter": Answers(answers, shared.value["filter"].least)}
        return pa.Table.from_batches(step(SimpleNamespace(value=own))(rows.to_batches()))
    return run


def _known(model: dict, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Whether a word is among the most frequent, and the logarithm of its count plus one."""
    if not len(model["keys"]):
        return np.zeros(len(words), dtype=bool), np.zeros(len(words))
    at = np.minimum(np.searchsorted(model["keys"], words), len(model["keys"]) - 1)
    exact = model["keys"][at] == words
    return exact, np.where(exact, np.log10(model["counts"][at] + 1.0), 0.0)


def _measure(shared):
    """For each level of the context: tokens, and the share of them that the filter's pairs predict."""
    def run(batches):
        all_, paired = np.zeros(LEVELS), np.zeros(LEVELS)
        for batch in batches:
            for part in slices(batch):
                tokens, before, _ = tokens_of(part.column("text"))
                _, of_before, of_pair = _lookup(shared.value, tokens, before, *np.unique(tokens, return_inverse=True))
                all_ += np.bincount(of_before, minlength=LEVELS)
                paired += np.bincount(of_before, of_pair > 0, minlength=LEVELS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(LEVELS)), pa.array(all_), pa.array(paired)], names=["level", "tokens", "paired"])
    return run


SCORED = "row long, doc_id {kind}, held_out boolean, n_tokens long, n_known long, base double, score double, range long, rows binary, keys binary"


def _score(shared, word_bits: int, id_type: pa.DataType):
    def run(batches):
        model = shared.value
        count, pair_count = level_counts(1), level_counts(PAIR_FROM)
        left: dict[str, list] = {"rows": [], "keys": []}

        def rest():
            """Words without an exact count here, by the range that has them."""
            keys, rows = np.concatenate(left["keys"]), np.concatenate(left["rows"])
            order = np.argsort(keys, kind="stable")
            keys, rows = keys[order], rows[order]
            ends = np.searchsorted(_ranges(keys, word_bits), np.arange((1 << word_bits) + 1))
            held = [k for k in range(1 << word_bits) if ends[k] < ends[k + 1]]
            left["rows"], left["keys"] = [], []
            n, cut = len(held), [(ends[k], ends[k + 1]) for k in held]
            return pa.RecordBatch.from_arrays(
                [pa.nulls(n, t) for t in (pa.int64(), id_type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64())]
                + [pa.array(held, pa.int64()), pa.array([rows[a:b].tobytes() for a, b in cut], pa.binary()), pa.array([keys[a:b].tobytes() for a, b in cut], pa.binary())],
                names=[f.split()[0] for f in SCORED.split(", ")])

        for batch in batches:
            for part in slices(batch):
                tokens, before, starts = tokens_of(part.column("text"))
                n = part.num_rows
                owner = np.repeat(np.arange(n), np.diff(starts))
                words, back = np.unique(tokens, return_inverse=True)
                of_token, of_before, of_pair = _lookup(model, tokens, before, words, back)
                exact, logs = _known(model, words)
                exact, base = exact[back], (logs - np.log10(model["denominator"]))[back]
                context = np.where(before == START, model["starts"], count[of_before])
                paired = np.minimum(1.0, pair_count[of_pair] / np.maximum(np.maximum(context, pair_count[of_pair]), 1))
                p = DISCOUNT * paired + model["rest"][of_before] * (count[of_token] + 1) / model["denominator"]
                if not model["complete"]:
                    rows = part.column("row").to_numpy()
                    left["rows"].append(rows[owner[~exact]])
                    left["keys"].append(tokens[~exact])
                    if sum(map(len, left["keys"])) >= TOKENS_HELD:
                        yield rest()
                sums = [np.bincount(owner, x, minlength=n) for x in (exact, base, np.log10(np.minimum(p, 1.0)))]
                none = pa.nulls(n, pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column("row"), part.column("doc_id"), part.column("held_out"), pa.array(np.diff(starts)), pa.array(sums[0].astype(np.int64)),
                     pa.array(sums[1]), pa.array(sums[2]), pa.nulls(n, pa.int64()), none, none], names=[f.split()[0] for f in SCORED.split(", ")])
        if left["keys"]:
            yield rest()
    return run


SUMS = "part long, rows binary, more binary, known binary"


def _exact(row_bits: int):
    def run(key: tuple[pa.Scalar, ...], asked: pa.Table, known: pa.Table) -> pa.Table:
        """For each row the summed logarithms and the number of its words in one range that
        training has, as arrays for each of several parts of the rows."""
        rows, keys = _joined(asked["rows"], np.int64), _joined(asked["keys"], np.uint64)
        have, counts = _joined(known["keys"], np.uint64), _joined(known["counts"], np.int64)
        found = np.zeros(len(keys), dtype=bool)
        if len(have):
            at = np.minimum(np.searchsorted(have, keys), len(have) - 1)
            found = have[at] == keys
        own, back = np.unique(rows[found], return_inverse=True)
        more = np.bincount(back, np.log10(counts[at[found]] + 1.0), minlength=len(own)) if len(own) else np.zeros(0)
        part = _ranges(mix(own.view(np.uint64)), row_bits)
        order = np.argsort(part, kind="stable")
        own, more, times = own[order], more[order], np.bincount(back, minlength=len(own))[order]
        ends = np.searchsorted(part[order], np.arange((1 << row_bits) + 1))
        cut = [(k, ends[k], ends[k + 1]) for k in range(1 << row_bits) if ends[k] < ends[k + 1]]
        arrays = [pa.array([x[a:b].tobytes() for _, a, b in cut], pa.binary()) for x in (own, more, times.astype(np.int64))]
        return pa.Table.from_arrays([pa.array([k for k, _, _ in cut], pa.int64()), *arrays], names=["part", "rows", "more", "known"])
    return run


def _summed(table: pa.Table) -> pa.Table:
    """The sums of each row over all ranges."""
    rows, back = np.unique(_joined(table["rows"], np.int64), return_inverse=True)
    return pa.table({
        "row": rows, "more": np.bincount(back, _joined(table["more"], np.float64), minlength=len(rows)),
        "known": np.bincount(back, _joined(table["known"], np.int64), minlength=len(rows)).astype(np.int64)})


def _bits(n: float, least: int = 3) -> int:
    return max(least, int(np.ceil(np.log2(max(1.0, n)))))


def fit_counts(texts: DataFrame, n_bytes: int, tokens_a_range: int = TOKENS_A_RANGE) -> tuple[DataFrame, int, int]:
    """Merged counts of words and pairs by range, and the bits of a word's and a pair's range."""
    expected = n_bytes / 5
    word_bits, pair_bits = _bits(expected / tokens_a_range / 4), _bits(expected / tokens_a_range)
    parts = texts.select("text").mapInArrow(_count(word_bits, pair_bits), COUNTS)
    merged = parts.groupBy("kind", "range").applyInArrow(_merge, COUNTS + ", distinct long, total long, sizes array<long>")
    return written(merged, "counts"), word_bits, pair_bits


def build(counts: DataFrame, word_bits: int, pair_bits: int, most_bytes: int, most_frequent: int) -> tuple[dict, DataFrame | None]:
    """The filter, the most frequent words' exact counts and the totals, all of bounded size.

    A filter beyond ``most_bytes`` is not in the model but comes as a table of its segments.
    """
    totals = counts.where("kind = 'word'").agg(F.sum("distinct").alias("v"), F.sum("total").alias("n")).first()
    sizes = {"word": np.zeros(LEVELS, dtype=np.int64), "pair": np.zeros(LEVELS, dtype=np.int64)}
    for r in counts.select("kind", F.posexplode("sizes").alias("level", "size")).groupBy("kind", "level").agg(F.sum("size").alias("size")).collect():
        sizes[r["kind"]][r["level"]] = r["size"]
    above = {k: np.cumsum(s[::-1])[::-1] for k, s in sizes.items()}  # n-grams of each level or higher
    entries = sum(int(a[1:].sum()) for a in above.values())
    segment_words = max(8, -(-entries * BITS_AN_ENTRY // 64 >> word_bits))
    filled = Filter(word_bits, segment_words, {"word": 1, "pair": 1})
    segment = F.when(F.col("kind") == "word", F.col("range")).otherwise(F.floor(F.col("range") / (1 << (pair_bits - word_bits)))).cast("long")
    segments = counts.select(segment.alias("segment"), "kind", "range", "keys", "counts").groupBy("segment").applyInArrow(_fill(filled, pair_bits), "segment long, bits binary")
    joined = entries * BITS_AN_ENTRY > most_bytes * 8
    if joined:
        segments = written(segments, "segments")
    else:
        built = segments.toArrow()
        filled.words = np.zeros(segment_words << word_bits, dtype=np.uint64)
        for number, bits in zip(built["segment"].to_pylist(), built["bits"].to_pylist(), strict=True):
            filled.words[number * segment_words:(number + 1) * segment_words] = np.frombuffer(bits, np.uint64)
    from_level = next(q for q in range(1, LEVELS) if above["word"][q] <= most_frequent)
    keys, exact = _frequent(counts, from_level)
    return {
        "filter": filled, "word_bits": word_bits, "pair_bits": pair_bits, "n": int(totals["n"] or 0), "v": int(totals["v"] or 0), "keys": keys, "counts": exact,
        "complete": from_level == 1, "denominator": float((totals["n"] or 0) + (totals["v"] or 0) + 1),
        "pair_level": int(levels_of(np.array([PAIR_FROM]), 1)[0]),
    }, segments if joined else None


def _frequent(counts: DataFrame, from_level: int) -> tuple[np.ndarray, np.ndarray]:
    """Exact counts of the words of a level or higher: no more than the level was chosen for."""
    def run(batches):
        for batch in batches:
            for keys, counts_ in zip(batch.column("keys").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                k, c = np.frombuffer(keys, np.uint64), np.frombuffer(counts_, np.int64)
                own = levels_of(c, 1) >= from_level
                yield pa.RecordBatch.from_arrays([pa.array([k[own].tobytes()], pa.binary()), pa.array([c[own].tobytes()], pa.binary())], names=["keys", "counts"])
    table = counts.where("kind = 'word'").select("keys", "counts").mapInArrow(run, "keys binary, counts binary").toArrow()
    keys, exact = _joined(table["keys"], np.uint64), _joined(table["counts"], np.int64)
    order = np.argsort(keys)
    return keys[order], exact[order]


def score(
    docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
    most_filter_bytes: int = MOST_FILTER_BYTES, most_frequent: int = MOST_FREQUENT, tokens_a_range: int = TOKENS_A_RANGE,
) -> DataFrame:
    """``row, doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` for every row.

    Rows where the boolean column expression ``held_out`` is false train the model. A
    null text is empty and has one token, its end. Without training rows nothing is
    known and every token has probability 1 there. Ids may be null or repeated. Other
    columns are not read. Word counts are exact up to equal 64-bit hashes.
    """
    small_batches(docs.sparkSession)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    training = texts.where("not held_out")
    facts = training.agg(F.sum(F.octet_length("text") + 1).alias("bytes"), F.count(F.lit(1)).alias("texts")).first()
    counts, word_bits, pair_bits = fit_counts(training, facts["bytes"] or 0, tokens_a_range)
    model, segments = build(counts, word_bits, pair_bits, most_filter_bytes, most_frequent)
    model["starts"] = max(1, facts["texts"])
    model["start_level"] = int(levels_of(np.array([model["starts"]]), 1)[0])
    context = docs.sparkSession.sparkContext
    rows = texts.withColumn("row", F.monotonically_increasing_id()).select("row", "doc_id", "held_out", "text")
    id_type = texts.select("doc_id").limit(0).toArrow().schema.field("doc_id").type
    measured, shape = "level long, tokens double, paired double", SCORED.format(kind=kind)
    if segments is None:
        parts = training.select("text").mapInArrow(_measure(context.broadcast(model)), measured)
    else:
        chunks = written(rows.mapInArrow(_ask(word_bits, pair_bits, TOKENS_HELD, id_type), CHUNKS.format(kind=kind)), "chunks")
        asked = chunks.where("segment is not null").select("segment", "chunk", "keys").groupBy("segment")
        answers = asked.cogroup(segments.groupBy("segment")).applyInArrow(_answer(model["filter"]), "chunk long, keys binary, levels binary")
        answers = written(answers, "answers").groupBy("chunk")
        by_chunk = chunks.where("segment is null").select("chunk", "row", "doc_id", "held_out", "text")
        parts = by_chunk.where("not held_out").groupBy("chunk").cogroup(answers).applyInArrow(_with_answers(context.broadcast(model), _measure), measured)
    seen = np.zeros((LEVELS, 2))
    for r in parts.groupBy("level").agg(F.sum("tokens").alias("t"), F.sum("paired").alias("p")).collect():
        seen[r["level"]] = r["t"], r["p"]
    model["rest"] = 1 - DISCOUNT * np.where(seen[:, 0] > 0, seen[:, 1] / np.maximum(seen[:, 0], 1), 0.0)
    if segments is None:
        found = rows.mapInArrow(_score(context.broadcast(model), word_bits, id_type), shape)
    else:
        step = lambda shared: _score(shared, word_bits, id_type)
        found = by_chunk.groupBy("chunk").cogroup(answers).applyInArrow(_with_answers(context.broadcast(model), step), shape)
    found = written(found, "scores")
    scored = found.where("n_tokens is not null").select("row", "doc_id", "held_out", "n_tokens", "n_known", "base", "score")
    if not model["complete"]:
        asked = found.where("n_tokens is null").select("range", "rows", "keys")
        known = counts.where("kind = 'word'").select("range", "keys", "counts")
        row_bits = _bits((facts["texts"] or 0) / ROWS_A_PART)
        more = asked.groupBy("range").cogroup(known.groupBy("range")).applyInArrow(_exact(row_bits), SUMS)
        more = more.groupBy("part").applyInArrow(_summed, "row long, more double, known long")
        scored = scored.join(more, "row", "left").withColumns({
            "base": F.col("base") + F.coalesce("more", F.lit(0.0)), "n_known": F.col("n_known") + F.coalesce("known", F.lit(0))})
    return scored.select("row", "doc_id", "held_out", "n_tokens", "n_known", F.lit(model["n"]).cast("long").alias("train_tokens"), F.col("base").alias("base_score"), "score")
