"""Language identification, quality classifier and language model."""

import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from llm_corpus import DOCS, clashing, corpus, docs, no_docs, prose, split  # noqa: F401
from pyspark.sql import functions as F

from ledgerflow.llm import langid, lm, quality

SF = "/root/testdata/sf0.01"


def crc(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode())


def test_languages_of_held_out_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = langid.fit_languages(docs.where(~langid.held_out()))
    rows = langid.identify(docs, model).join(docs.select("doc_id", "lang"), "doc_id").where(langid.held_out()).collect()
    assert len(rows) > 150 and np.mean([r.lang_pred == r.lang for r in rows]) > 0.95
    assert all(0 <= r.score <= 1 for r in rows)
    right = [r for r in rows if r.lang_pred == r.lang]
    assert np.mean([r.rejected for r in right]) < 0.15


def test_texts_without_letters_are_undetermined(docs, no_docs):
    model = langid.fit_languages(docs)
    rows = {(r.doc_id, r.lang_pred, r.score) for r in langid.identify(docs, model).collect()}
    for i, text, *_ in corpus():
        found = {x for x in rows if x[0] == i}
        lettered = bool(text) and any(map(str.isalpha, text))
        assert any((x[1] != "und") == lettered and (lettered or x[2] == 0.0) for x in found)
    assert langid.identify(no_docs, model).count() == 0
    assert langid.identify(clashing(docs), model).count() == docs.count()
    nothing = langid.fit_languages(no_docs)
    assert {r.lang_pred for r in langid.identify(docs, nothing).collect()} == {"und"}


def test_prediction_reads_whole_texts_and_nothing_else(docs):
    texts = [prose(1, 50_000), prose(1, 50_000) + " ñandú" * 50_000]
    model = langid.fit_languages(docs)[1]
    one, two = langid.scores(pa.array(texts), model)
    assert abs(one - two).max() > 0
    assert np.allclose(langid.scores(pa.array([texts[0], "x", texts[1]]), model)[[0, 2]], [one, two])


def test_grades():
    rows = quality.fit(np.zeros(0, dtype=np.int64), np.zeros(0), np.zeros(1, dtype=np.int64), np.zeros(0, dtype=np.int64), np.zeros(0))
    assert (np.diff(rows[1]) >= 0).all()
    numbers, values, at = quality.features(pa.array(["", None, "a a a b!", "A"]))
    assert at[:3].tolist() == [0, 0, 0] and len(at) == 5
    for lo, hi in zip(at[2:], at[3:], strict=False):
        assert math.isclose((values[lo:hi] ** 2).sum(), 3, rel_tol=1e-5)
    assert numbers.max() < quality.DIMENSION


def test_features_do_not_depend_on_other_rows():
    texts = ["same same word.", "TWO!! words!!", "", "| a | b |"]
    together = quality.features(pa.array(texts))
    for k, text in enumerate(texts):
        alone = quality.features(pa.array([text]))
        lo, hi = together[2][k:k + 2]
        assert together[0][lo:hi].tolist() == alone[0].tolist() and np.allclose(together[1][lo:hi], alone[1])


def test_more_languages_than_are_learned(spark, monkeypatch):
    """The most frequent ones are; each text is still answered, and rows in any order give one model."""
    monkeypatch.setattr(langid, "MOST_LANGUAGES", 3)
    rows = [(k, f"wort{k % 4} " * 20 + "abc", f"l{k % 4}") for k in range(80)] + [(100 + k, "dirty", f"rare {k}") for k in range(300)]
    rows += [(0, "other text of the same row", "l0"), (0, "wort0 " * 3, "l0")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    langs, model = langid.fit_languages(frame)
    assert langs == ["l0", "l1", "l2"]
    again = langid.fit_languages(frame.orderBy(F.desc("text")).repartition(7))
    assert again[0] == langs and all(np.array_equal(a, b) for a, b in zip(model, again[1]))
    assert langid.identify(frame, (langs, model)).count() == len(rows)


def test_probabilities_are_those_of_the_model(spark):
    """A plain re-computation, subword by subword, over whole texts."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    langs, (table, bias, level) = langid.fit_languages(docs.where(~langid.held_out()))
    some = docs.where("doc_id < 120").select("doc_id", "text")
    found = {r.doc_id: r for r in langid.identify(some, (langs, (table, bias, level))).collect()}
    for r in some.collect():
        (codes, shares), = langid.features(pa.array([r.text]))
        logits = sum((s * table[c].astype(float) for c, s in zip(codes, shares)), np.zeros(len(langs))) + bias
        p = np.exp(logits - logits.max()) / np.exp(logits - logits.max()).sum()
        assert abs(found[r.doc_id].score - p.max()) < 1e-6 and found[r.doc_id].lang_pred == langs[p.argmax()]
        assert found[r.doc_id].rejected == (p.max() < level)


def test_quality_on_unseen_labels(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    graded = quality.grades_of(labels)
    model = quality.fit_ratings(docs, graded.where(F.crc32(F.col("doc_id").cast("string")) % 4 != 0))
    assert (np.diff(model[1]) >= 0).all()
    unseen = graded.where(F.crc32(F.col("doc_id").cast("string")) % 4 == 0)
    rows = quality.rate(docs, model).join(unseen, "doc_id").collect()
    share = {g: np.mean([r.selected for r in rows if r.grade == g]) for g in range(3)}
    assert share[2] > 0.97 and share[0] < 0.03 and share[1] < 0.1
    mean = [np.mean([r.expected_grade for r in rows if r.grade == g]) for g in range(3)]
    assert mean[0] < mean[1] < mean[2]


def test_ratings_are_those_of_the_model(spark, docs):
    """A plain re-computation, feature by feature, and ordered tails."""
    ratings = spark.createDataFrame([(k, k % 3) for k in range(40)], "doc_id long, grade int")
    weights, cuts = quality.fit_ratings(docs, ratings)
    rows = {r.doc_id: r for r in quality.rate(docs.where("doc_id is not null"), (weights, cuts), least=0.4).collect()}
    for r in docs.where("doc_id is not null").collect():
        numbers, values, _ = quality.features(pa.array([r.text], pa.string()))
        score = sum(float(weights[k]) * float(v) for k, v in zip(numbers, values))
        tail = [1 / (1 + math.exp(cut - score)) for cut in cuts]
        assert tail == sorted(tail, reverse=True)
        found = rows[r.doc_id]
        assert abs(found.tail_probability - tail[-1]) < 1e-4 and abs(found.expected_grade - sum(tail)) < 1e-4
        assert found.selected == (found.tail_probability >= 0.4)


def test_rating_all_rows(spark, docs, no_docs):
    ratings = spark.createDataFrame([(k, k % 3) for k in range(40)] + [(None, 1), (3, None), (999, 2), (4, 7)], "doc_id long, grade int")
    model = quality.fit_ratings(docs, ratings)
    rows = quality.rate(clashing(docs), model).collect()
    assert len(rows) == docs.count() and all(0 <= r.expected_grade <= 2 and 0 <= r.tail_probability <= 1 for r in rows)
    kept = quality.selected(docs, model)
    assert kept.columns == docs.columns and kept.count() == sum(r.selected for r in rows)
    assert quality.rate(no_docs, model).count() == 0
    assert quality.selected(docs, quality.fit_ratings(docs, ratings.limit(0))).count() <= docs.count()


def expected(rows, training):
    tokens = [[*split(t), None] for _, t, *_ in rows]
    counts = Counter(w for own, train in zip(tokens, training, strict=True) if train for w in own)
    n, v = sum(counts.values()), len(counts)
    return sorted(
        (str(i), not train, len(own), sum(w in counts for w in own), n, round(sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own), 6))
        for (i, *_), own, train in zip(rows, tokens, training, strict=True))


@pytest.mark.parametrize("frequent", [1 << 20, 4])
def test_base_scores(docs, frequent):
    """With all counts broadcast, and with most of them joined."""
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    rows = lm.score(docs, held, most_frequent=frequent, tokens_a_range=100).collect()
    got = sorted((str(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in rows)
    want = expected(corpus(), [crc(i) % 7 != 2 for i, *_ in corpus()])
    for a, b in zip(got, want, strict=True):
        assert a[:5] == b[:5] and abs(a[5] - b[5]) < 1e-5
    assert all(r.score <= 0 and math.isfinite(r.score) for r in rows)


def test_filter_gives_levels_back():
    random = np.random.default_rng(3)
    hashes = random.integers(0, 1 << 63, 20_000, dtype=np.uint64) * np.uint64(2)
    counts = random.integers(1, 1000, 10_000)
    own = lm.levels_of(counts, 1)
    made = lm.Filter(3, -(-int(own.sum()) * lm.BITS_AN_ENTRY // 64 >> 3), {"word": 1, "pair": 1})
    made.words = np.zeros(made.segment_words << 3, dtype=np.uint64)
    base = lm._ranges(hashes, 3).astype(np.uint64) * np.uint64(made.segment_words)
    for level in range(1, own.max() + 1):
        mine = np.flatnonzero(own >= level)
        word, mask = made.places(hashes[mine], level)
        np.bitwise_or.at(made.words, base[mine] + word, mask)
    found = made.levels(hashes, 1)
    assert (found[:10_000] >= own).all() and (found[:10_000] == own).mean() > 0.97
    assert (found[10_000:] > 0).mean() < 0.03


def test_levels_stand_for_their_counts():
    for first in (1, 2):
        counts = np.arange(first, 5000)
        stands = lm.level_counts(first)[lm.levels_of(counts, first)]
        assert (np.abs(stands - counts) / counts).max() < 0.3


def test_small_filters_hold_the_frequent(docs):
    everything, little = (lm.score(docs, F.lit(False), most_filter_bytes=n).toPandas() for n in (1 << 20, 2000))
    assert np.isfinite(little.score).all() and (everything.base_score.sum() - little.base_score.sum()) == pytest.approx(0)


@pytest.mark.parametrize("frequent", [1 << 20, 4])
def test_filters_of_any_size_give_the_same_scores(docs, frequent):
    """Broadcast, and joined by segments because it is beyond the bound."""
    held = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7 == 2
    broadcast, joined = (
        lm.score(docs, held, most_filter_bytes=n, most_frequent=frequent, tokens_a_range=100).toPandas().sort_values("row", ignore_index=True) for n in (1 << 20, 100))
    assert len(joined) == len(broadcast) == docs.count()
    for c in ("row", "held_out", "n_tokens", "n_known"):
        assert (joined[c] == broadcast[c]).all()
    assert np.allclose(joined.base_score, broadcast.base_score, rtol=0, atol=1e-9) and np.allclose(joined.score, broadcast.score, rtol=0, atol=1e-9)


def test_pairs_predict_unseen_texts(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = lm.score(docs, F.crc32(F.col("doc_id").cast("string")) % 7 == 2).where("held_out").toPandas()
    assert rows.score.sum() > rows.base_score.sum() and (rows.score > rows.base_score).mean() > 0.8


def test_scores_without_training_or_rows(docs, no_docs):
    rows = lm.score(clashing(docs), F.lit(True)).collect()
    assert len(rows) == docs.count() and all(r.train_tokens == 0 and r.n_known == 0 and r.base_score == 0 for r in rows)
    assert lm.score(no_docs, F.lit(False)).count() == 0


def scores_by_hand(rows, training):
    """The model of the docstring over exact counts: quantised, without a filter's false hits."""
    def level(count):
        return int(lm.levels_of(np.array([count]), 1)[0]) if count else 0

    tokens = [[*split(t), "</s>"] for _, t, *_ in rows]
    before = [["<s>", *own[:-1]] for own in tokens]
    words, pairs = Counter(), Counter()
    for own, prior, train in zip(tokens, before, training, strict=True):
        if train:
            words.update(own)
            pairs.update(zip(prior, own))
    count = lm.level_counts(1)
    n, v, texts = sum(words.values()), len(words), max(1, sum(training))
    level_of = {w: level(c) for w, c in words.items()} | {"<s>": level(texts)}
    seen, paired = Counter(), Counter()
    for own, prior, train in zip(tokens, before, training, strict=True):
        for b, w in zip(prior, own) if train else ():
            seen[level_of[b]] += 1
            paired[level_of[b]] += (b, w) in pairs
    out = []
    for own, prior in zip(tokens, before, strict=True):
        total = 0.0
        for b, w in zip(prior, own):
            at = level_of.get(b, 0)
            both = count[level(pairs[b, w])]
            context = texts if b == "<s>" else count[at]
            rest = 1 - lm.DISCOUNT * (paired[at] / seen[at] if seen[at] else 0)
            total += math.log10(lm.DISCOUNT * min(1, both / max(context, both, 1)) + rest * (count[level_of.get(w, 0)] + 1) / (n + v + 1))
        out.append(total)
    return out


@pytest.mark.parametrize("most", [lm.MOST_FILTER_BYTES, 1])
def test_scores_are_those_of_exact_counts(spark, docs, monkeypatch, most):
    """With a filter so sparse that it has no false hits, broadcast and joined; pairs seen once count."""
    monkeypatch.setattr(lm, "BITS_AN_ENTRY", 4096)
    rows = [r for r in corpus() if r[0] is not None]
    given = docs.where("doc_id is not null")
    training = [crc(r[0]) % 7 != 2 for r in rows]
    held = F.crc32(F.col("doc_id").cast("string")) % 7 == 2
    found = lm.score(given, held, most_filter_bytes=most).collect()
    want = sorted((r[0], s) for r, s in zip(rows, scores_by_hand(rows, training), strict=True))
    got = sorted((r.doc_id, r.score) for r in found)
    assert [d for d, _ in got] == [d for d, _ in want]
    assert all(abs(a - b) < 1e-6 * max(1, abs(b)) for (_, a), (_, b) in zip(got, want))
