"""Language identification by averaged hashed subword embeddings and a linear softmax.

Subwords are the runs of 2, 3 and 4 bytes of a lower-cased text whose marks count as
spaces. Each has a hashed embedding; a text is the mean of all of its embeddings,
and a linear softmax over it gives the languages. Both are trained in numpy by
stochastic gradient descent on a bounded sample. A temperature fitted on a part of
the sample that the training doesn't see calibrates the scores, and the rejection
level is the score that all but a given share of its right answers reach.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from ledgerflow.llm.store import bounded_sample, small_batches
from ledgerflow.llm.words import IS_MARK, LOWER, WINDOW, flat, slices

SIZES = (2, 3, 4)
BITS = 16  # of a hashed subword, one table for each size
WIDTH = 16  # numbers in an embedding
MOST_SAMPLED = 8_000  # training texts at most, divided among the languages
MOST_LANGUAGES = 200
EPOCHS = 5
RATE = 8.0
REJECTED = 0.01  # share of right answers below the rejection level
UNKNOWN = "und"

_CLEAN = np.where(IS_MARK, np.uint8(0x20), LOWER)


def subwords(data: np.ndarray, starts: np.ndarray):
    """For windows of the bytes: the codes of all subwords that begin there and their rows."""
    row_of = np.searchsorted(starts, np.arange(0, len(data), 1), side="right") - 1 if len(data) <= WINDOW else None
    for lo in range(0, len(data), WINDOW):
        part = _CLEAN[data[lo:lo + WINDOW + max(SIZES) - 1]].astype(np.uint32)
        here = min(WINDOW, len(data) - lo)
        rows = row_of if row_of is not None else np.searchsorted(starts, np.arange(lo, lo + here), side="right") - 1
        left = starts[rows + 1] - np.arange(lo, lo + here)  # bytes up to the row's end
        for k, size in enumerate(SIZES):
            code = np.zeros(max(0, len(part) - size + 1), dtype=np.uint32)
            for j in range(size):
                code = code * np.uint32(0x01000193) + part[j:len(part) - size + 1 + j]
            code = (code * np.uint32(0x9E3779B1)) >> np.uint32(32 - BITS)
            code = code[:here]
            fits = left[:len(code)] >= size
            yield code[fits].astype(np.int64) + (k << BITS), rows[:len(code)][fits]


def features(column) -> list[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct subwords and their shares."""
    data, starts = flat(column)
    keys = [np.zeros(0, dtype=np.int64)] + [rows << 20 | codes for codes, rows in subwords(data, starts)]
    keys, counts = np.unique(np.concatenate(keys), return_counts=True)
    at = np.searchsorted(keys >> 20, np.arange(len(starts)))
    return [(keys[lo:hi] & ((1 << 20) - 1), counts[lo:hi] / max(1, counts[lo:hi].sum())) for lo, hi in zip(at[:-1], at[1:], strict=True)]


def softmax(x: np.ndarray) -> np.ndarray:
    e = np.exp(x - x.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def train(texts: list[tuple[np.ndarray, np.ndarray]], labels: np.ndarray, n_labels: int, seed: int = 11):
    """A table of each subword's contribution to each label, the temperature and the rejection level."""
    random = np.random.default_rng(seed)
    embedding = (random.random((len(SIZES) << BITS, WIDTH)) - 0.5) / WIDTH
    softener, bias = np.zeros((WIDTH, n_labels)), np.zeros(n_labels)
    unseen = random.random(len(texts)) < 0.1
    order = np.flatnonzero(~unseen)
    steps, step = EPOCHS * max(1, len(order)), 0
    for _ in range(EPOCHS):
        for k in random.permutation(order):
            codes, shares = texts[k]
            rate, step = RATE * (1 - step / steps), step + 1
            hidden = shares @ embedding[codes]
            error = softmax(hidden @ softener + bias)
            error[labels[k]] -= 1
            back = softener @ error
            softener -= rate * 0.2 * np.outer(hidden, error)
            bias -= rate * 0.002 * error
            embedding[codes] -= rate * shares[:, None] * back[None, :]
    table = embedding @ softener
    held = [k for k in np.flatnonzero(unseen if unseen.any() else ~unseen)]
    logits = np.array([texts[k][1] @ table[texts[k][0]] + bias for k in held]).reshape(len(held), n_labels)
    right = labels[held]
    temperature = min(np.geomspace(0.05, 5, 60), key=lambda t: -np.log(softmax(logits / t)[np.arange(len(held)), right] + 1e-12).sum() if len(held) else abs(t - 1))
    scores = softmax(logits / temperature)
    good = scores.max(axis=1)[scores.argmax(axis=1) == right] if len(held) else scores[:0, 0]
    level = float(np.quantile(good, REJECTED)) if len(good) else 0.0
    return (table / temperature).astype(np.float32), bias / temperature, level


def _sampled(batches):
    for batch in batches:
        for part in slices(batch):
            own = features(part.column("text"))
            yield pa.RecordBatch.from_arrays(
                [part.column("doc_id"), part.column("lang"), pa.array([c for c, _ in own], pa.list_(pa.int32())), pa.array([s for _, s in own], pa.list_(pa.float32()))],
                names=["doc_id", "lang", "codes", "shares"])


def fit_languages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", most_sampled: int = MOST_SAMPLED):
    """A model from the rows of ``docs`` with a text, a language and an id.

    The MOST_LANGUAGES most frequent languages are learned, of equally frequent ones the first
    by name; rarer values are never predicted. At most ``most_sampled`` texts are read, as
    many of each language, those whose ids have the smallest hashes. Of texts with the same
    id and language one is read, the same each time. Their features, not their texts,
    come to the driver.
    """
    small_batches(docs.sparkSession)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(lang_col).alias("lang"), F.col(text_col).alias("text"))
    rows = rows.where("doc_id is not null and lang is not null and text is not null")
    often = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").limit(MOST_LANGUAGES)
    langs = [r["lang"] for r in often.collect()]
    if not langs:
        return [], None
    rows = rows.where(F.col("lang").isin(langs))
    chosen = bounded_sample(rows.select("doc_id", "lang"), "lang", "doc_id", max(1, most_sampled // len(langs)))
    kinds = ", ".join(f"{n} {rows.schema[n].dataType.simpleString()}" for n in ("doc_id", "lang"))
    texts = rows.join(F.broadcast(chosen.distinct()), ["doc_id", "lang"]).select("doc_id", "lang", "text")
    found = texts.mapInArrow(_sampled, f"{kinds}, codes array<int>, shares array<float>")
    found = found.groupBy("doc_id", "lang").agg(F.min(F.struct("codes", "shares")).alias("f")).select("doc_id", "lang", "f.*")
    table = found.sort("doc_id", "lang").toArrow()
    langs.sort()
    number = {lang: k for k, lang in enumerate(langs)}
    own = []
    for batch in table.to_batches():
        codes, shares = batch.column("codes"), batch.column("shares")
        own += [(codes.values.to_numpy()[lo:hi], shares.values.to_numpy()[lo:hi]) for lo, hi in zip(codes.offsets.to_pylist(), codes.offsets.to_pylist()[1:], strict=False)]
    return langs, train(own, np.array([number[v] for v in table["lang"].to_pylist()]), len(langs))


def scores(column, model) -> np.ndarray:
    """The probability of each language for each text."""
    table, bias, _ = model
    data, starts = flat(column)
    n = len(starts) - 1
    sums, counts = np.zeros((n, len(bias))), np.zeros(n)
    for codes, rows in subwords(data, starts):
        for k in range(len(bias)):
            sums[:, k] += np.bincount(rows, table[codes, k], minlength=n)
        counts += np.bincount(rows, minlength=n)
    return softmax(sums / np.maximum(counts, 1)[:, None] + bias)


def _lettered(column) -> np.ndarray:
    return np.array([t is not None and any(map(str.isalpha, t)) for t in column.to_pylist()], dtype=bool)


def _identify(shared):
    def run(batches):
        langs, model = shared.value
        names = np.array([*langs, UNKNOWN], dtype=object)
        for batch in batches:
            for part in slices(batch):
                text = part.column("text")
                known = _lettered(text) if langs else np.zeros(part.num_rows, dtype=bool)
                best, score, level = np.full(part.num_rows, len(langs)), np.zeros(part.num_rows), 0.0
                if langs:
                    p, level = scores(text, model), model[2]
                    best, score = np.where(known, p.argmax(axis=1), best), np.where(known, p.max(axis=1), 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(names[best], pa.string()), pa.array(score), pa.array(~known | (score < level))],
                    names=["doc_id", "lang_pred", "score", "rejected"])
    return run


def identify(docs: DataFrame, model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, lang_pred, score, rejected`` for every row, in one pass without a shuffle.

    A null text, or one without a letter, is ``und`` with score 0 and rejected, and so
    is every text for a model without languages. Ids may be null or repeated. Other
    columns are not read. The model is broadcast: three tables of a fixed number of
    subwords for at most MOST_LANGUAGES languages.
    """
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    kind = texts.schema["doc_id"].dataType.simpleString()
    return texts.mapInArrow(_identify(shared), f"doc_id {kind}, lang_pred string, score double, rejected boolean")


def held_out(id_col: str = "doc_id"):
    """Whether a row is kept from training; so is a row without an id."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit(""))) % 5 == 0
