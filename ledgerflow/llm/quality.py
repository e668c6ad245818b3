"""Quality classifier: ordinal cumulative-link regression on graded ratings.

One vector of weights over hashed text features is shared by all grades; ordered
thresholds cut its score: P(grade >= k) = sigmoid(score - threshold_k). From these
follow the expected grade and the tail probability by which documents are selected.

Features are shares of a whole text's words, of word beginnings and of word
shapes (capitals, marks, digits, repetition), hashed, as square roots, so that each
of the three groups has length one whatever the text's length.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerflow.llm.store import bounded_sample, small_batches
from ledgerflow.llm.words import IS_MARK, IS_SPACE, flat, mix, slices, word_bounds, word_hashes

BITS = 18  # of a hashed feature
SHAPES = 1 << 10
BEGINNING = 4  # bytes of a word's beginning
MOST_RATED = 3_000  # rated documents of each grade that the fit reads at most
EPOCHS = 12
RATE, DECAY = 0.5, 2e-6
RELEVANT = 5  # standard errors at which a feature counts as it is
GRADES = 3
GROUPS = 3  # of features, each of length one


def _beginnings(data: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A hash of the first bytes of each word."""
    out = np.full(len(first), 0x51, dtype=np.uint64)
    for k in range(BEGINNING):
        at = first + k
        byte = np.where(at < end, data[np.minimum(at, len(data) - 1)], 0).astype(np.uint64)
        out = out * np.uint64(257) + byte
    return mix(out)


def _shapes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A number below SHAPES for each white-space word, and where each row's words start."""
    first, end = word_bounds(data, starts)
    at = np.searchsorted(first, starts)

    def among(mask: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(data) + 1, dtype=np.int64)
        np.cumsum(mask, out=sums[1:])
        return sums[end] - sums[first]

    size = end - first
    capitals = among((data >= ord("A")) & (data <= ord("Z")))
    marks, digits = among(IS_MARK[data] & ~IS_SPACE[data]), among((data >= ord("0")) & (data <= ord("9")))
    words, _ = word_hashes(data, starts)
    again = np.zeros(len(first), dtype=np.int64)
    again[1:] = words[1:] == words[:-1]
    again[at[at < len(first)]] = 0
    shape = np.minimum(capitals, 2) + 3 * np.minimum(marks, 3) + 12 * (marks == size) + 24 * (digits > 0) + 48 * again + 96 * np.minimum(size // 6, 4)
    return shape, at


def features(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers, their values, and the n + 1 places where the rows' features start."""
    data, starts = flat(column)
    n = len(starts) - 1
    if not len(data):
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.float32), np.zeros(n + 1, dtype=np.int64)
    lower = np.where((data >= ord("A")) & (data <= ord("Z")), data + np.uint8(32), data).astype(np.uint8)
    first, end = word_bounds(lower, starts, IS_MARK)
    words, at = word_hashes(data, starts, separators=IS_MARK)
    shapes, shape_at = _shapes(data, starts)
    width = np.uint64(64 - BITS)
    groups = (
        ((words >> width).astype(np.int64), at),
        ((_beginnings(lower, first, end) >> width).astype(np.int64) + (1 << BITS), at),
        (shapes + (2 << BITS), shape_at),
    )
    numbers, values = [], []
    for codes, begins in groups:
        counts = np.diff(begins)
        rows = np.repeat(np.arange(n), counts)
        keys, times = np.unique(rows << 24 | codes, return_counts=True)
        numbers.append(keys)
        values.append(np.sqrt(times / counts[keys >> 24]))
    keys, order = np.concatenate(numbers), None
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    return keys & ((1 << 24) - 1), np.concatenate(values)[order].astype(np.float32), np.searchsorted(keys >> 24, np.arange(n + 1))


DIMENSION = (2 << BITS) + SHAPES


def scores(weights: np.ndarray, numbers: np.ndarray, values: np.ndarray, at: np.ndarray) -> np.ndarray:
    sums = np.zeros(len(numbers) + 1)
    np.cumsum(weights[numbers] * values, out=sums[1:])
    return sums[at[1:]] - sums[at[:-1]]


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def relevance(numbers: np.ndarray, at: np.ndarray, grades: np.ndarray, n_grades: int = GRADES) -> np.ndarray:
    """How far the shares of documents with a feature lie apart in two neighbouring grades,
    the greatest of all, in standard errors; squared and scaled, so that chance differences
    of a large vocabulary weigh next to nothing."""
    grade = np.repeat(grades, np.diff(at))
    there = [np.bincount(numbers[grade == k], minlength=DIMENSION).astype(float) for k in range(n_grades)]
    rated = [k for k in range(n_grades) if (grades == k).any()]
    out = np.full(DIMENSION, 0.0 if len(rated) > 1 else 1.0)
    for a, b in zip(rated, rated[1:], strict=False):
        n, m = (grades == a).sum(), (grades == b).sum()
        share = (there[a] + there[b] + 1) / (n + m + 2)
        apart = np.abs(there[a] / n - there[b] / m) / np.sqrt(share * (1 - share) * (1 / n + 1 / m))
        out = np.maximum(out, (apart / RELEVANT) ** 2)
    return out


def fit(numbers: np.ndarray, values: np.ndarray, at: np.ndarray, grades: np.ndarray, importance: np.ndarray, n_grades: int = GRADES, seed: int = 7):
    """Weights and ascending thresholds by stochastic gradient descent on the likelihood of the grades.

    The likelihood of grade g is P(grade >= g) - P(grade >= g + 1). Without rated
    rows the weights are 0 and all grades equally likely. Features are scaled by their
    ``relevance`` while they are fitted, and no less than to the length that texts have
    without: few ratings show small differences only.
    """
    scale = np.ones(DIMENSION)
    if len(grades):
        scale = relevance(numbers, at, grades, n_grades)
        rows = np.repeat(np.arange(len(grades)), np.diff(at))
        scaled = values * scale.astype(np.float32)[numbers]
        length = np.sqrt(np.bincount(rows, scaled * scaled, minlength=len(grades))).mean()
        scale = scale * max(1.0, GROUPS**0.5 / length) if length else np.ones(DIMENSION)
        del rows, scaled
    values = values * scale.astype(np.float32)[numbers]
    weights, squares = np.zeros(DIMENSION), np.full(DIMENSION, 1e-3)
    total = importance.sum()
    tail = [(importance[grades >= k].sum() + 1) / (total + n_grades) * (1 if total else n_grades - k) for k in range(1, n_grades)]
    cuts = np.sort(-np.log(np.clip(tail, 1e-6, 1 - 1e-6) / (1 - np.clip(tail, 1e-6, 1 - 1e-6))))
    cut_squares, random = np.full(n_grades - 1, 1e-3), np.random.default_rng(seed)
    edges = lambda: np.concatenate([[-np.inf], cuts, [np.inf]])
    for _ in range(EPOCHS if len(grades) else 0):
        for rows in np.array_split(random.permutation(len(grades)), max(1, len(grades) // 64)):
            sizes = at[rows + 1] - at[rows]
            own = np.repeat(at[rows] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
            x, v, where = numbers[own], values[own], np.repeat(np.arange(len(rows)), sizes)
            score = np.bincount(where, weights[x] * v, minlength=len(rows))
            e, g = edges(), grades[rows]
            low, high = sigmoid(score - e[g]), sigmoid(score - e[g + 1])
            slope = importance[rows] / np.maximum(low - high, 1e-9)
            from_low, from_high = slope * low * (1 - low), slope * high * (1 - high)
            pull = (from_high - from_low) / len(rows)  # gradient of the loss by the score
            unique, back = np.unique(x, return_inverse=True)
            gradient = np.bincount(back, pull[where] * v) + DECAY * weights[unique]
            squares[unique] += gradient**2
            weights[unique] -= RATE * gradient / np.sqrt(squares[unique])
            by_cut = (np.bincount(g, from_low, minlength=n_grades)[1:] - np.bincount(g + 1, from_high, minlength=n_grades + 1)[1:-1]) / len(rows)
            cut_squares += by_cut**2
            cuts = np.maximum.accumulate(cuts - RATE * 0.2 * by_cut / np.sqrt(cut_squares))
    return (weights * scale).astype(np.float32), cuts


def _rows_of_features(grade: str):
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                numbers, values, at = features(part.column("text"))
                at = pa.array(at, pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), part.column(grade), pa.ListArray.from_arrays(at, pa.array(numbers, pa.int32())), pa.ListArray.from_arrays(at, pa.array(values, pa.float32()))],
                    names=["doc_id", grade, "numbers", "values"])
    return run


def fit_ratings(docs: DataFrame, ratings: DataFrame, id_col: str = "doc_id", text_col: str = "text", most_rated: int = MOST_RATED, n_grades: int = GRADES):
    """Weights and thresholds from ``ratings(doc_id, grade)`` with grades from 0 to n_grades - 1.

    The fit reads at most ``most_rated`` documents of each grade, those whose ids have
    the smallest hashes; all grades weigh the same, however rare. Of documents with the
    same id one is read, the same each time. Their features, not their texts, come to
    the driver. Ratings with a null or of unknown documents don't
    count; without any the model rates all texts alike.
    """
    small_batches(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()
    rated = ratings.select(F.col("doc_id"), F.col("grade").cast("int").alias("grade")).where(F.col("doc_id").isNotNull() & F.col("grade").between(0, n_grades - 1))
    chosen = bounded_sample(rated, "grade", "doc_id", most_rated)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")).join(F.broadcast(chosen), "doc_id")
    rows = texts.mapInArrow(_rows_of_features("grade"), f"doc_id {kind}, grade int, numbers array<int>, values array<float>")
    rows = rows.groupBy("doc_id", "grade").agg(F.min(F.struct("numbers", "values")).alias("f")).select("doc_id", "grade", "f.*")
    table = rows.sort("doc_id", "grade").toArrow().combine_chunks()
    grades = table["grade"].to_numpy()
    if not len(grades):
        return fit(np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0), n_grades)
    numbers, values = table["numbers"].combine_chunks(), table["values"].combine_chunks()
    counts = np.bincount(grades, minlength=n_grades)
    importance = (len(grades) / np.maximum(counts, 1) / np.count_nonzero(counts))[grades]
    return fit(numbers.values.to_numpy().astype(np.int64), values.values.to_numpy(), numbers.offsets.to_numpy().astype(np.int64), grades, importance, n_grades)


def tails(column, weights: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """P(grade >= k) for k from 1 for each text."""
    score = scores(weights, *features(column))
    return sigmoid(score[:, None] - cuts[None, :])


def _rate(shared, least: float):
    def run(batches):
        weights, cuts = shared.value
        for batch in batches:
            for part in slices(batch):
                p = tails(part.column("text"), weights, cuts)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(p.sum(axis=1)), pa.array(p[:, -1]), pa.array(p[:, -1] >= least)],
                    names=["doc_id", "expected_grade", "tail_probability", "selected"])
    return run


def rate(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text", least: float = 0.5) -> DataFrame:
    """``doc_id, expected_grade, tail_probability, selected`` for every row, without a shuffle.

    ``tail_probability`` is that of the highest grade; a row is selected from ``least``
    on. A null text or one without words has no features, so thresholds alone rate it.
    Ids may be null or repeated. Other columns are not read.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_rate(shared, least), f"doc_id {kind}, expected_grade double, tail_probability double, selected boolean")


def selected(docs: DataFrame, model, text_col: str = "text", least: float = 0.5) -> DataFrame:
    """The rows of ``docs`` that ``rate`` selects, with all their columns, in the same pass."""
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        weights, cuts = shared.value
        for batch in batches:
            for part in slices(batch, text_col):
                yield part.filter(pa.array(tails(part.column(text_col), weights, cuts)[:, -1] >= least))
    return docs.mapInArrow(run, docs.schema)


def grades_of(labels: DataFrame) -> DataFrame:
    """Graded ratings from two labels: 0 for low quality, 1 for good but toxic, 2 for good and clean."""
    grade = F.when(F.col("quality") == 0, 0).when(F.col("toxic") == 1, 1).when((F.col("quality") == 1) & (F.col("toxic") == 0), 2)
    return labels.select("doc_id", grade.alias("grade"))
