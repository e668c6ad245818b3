"""Exact and near duplicates of documents against plain Python."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest
from conftest import plan_text
from llm_corpus import ODD, clashing, corpus, docs, no_docs, prose, split  # noqa: F401

from ledgerflow.llm import minhash
from ledgerflow.llm.exact_dedup import MOST_CHUNK, chunk_bounds, exact_duplicates, normalised
from ledgerflow.llm.graph import components
from ledgerflow.llm.minhash import band_keys, near_duplicates, overlaps, permutation, signatures, spanning
from ledgerflow.llm.words import flat, slices, word_hashes


def order(doc_id):
    return (doc_id is None, doc_id if doc_id is not None else 0)


def kept_per_group(rows, group):
    """Every group keeps one row, one of those with its smallest id."""
    groups = defaultdict(list)
    for r in rows:
        groups[group(r)].append(r)
    for members in groups.values():
        kept = [r for r in members if r.kept]
        assert len(kept) == 1 and order(kept[0].doc_id) == min(order(r.doc_id) for r in members)
    return groups


@pytest.mark.parametrize("bits", [128, 5])
def test_exact_duplicates(docs, bits):
    """Also where digests of different chunks are equal."""
    plain = lambda t: re.sub(r"[\x20\x09-\x0D]+", " ", t or "")
    sha = lambda t: hashlib.sha256(plain(t).encode()).hexdigest()
    rows = exact_duplicates(docs, digest_bits=bits).collect()
    assert sorted((str(r.doc_id), r.text_sha256) for r in rows) == sorted((str(i), sha(t)) for i, t, *_ in corpus())
    for text, members in kept_per_group(rows, lambda r: r.text_sha256).items():
        assert {r.group_size for r in members} == {len(members)}, text
        assert len({r.keep_id for r in members}) == 1


def test_other_columns_and_empty_tables(docs, no_docs):
    assert exact_duplicates(clashing(docs)).count() == docs.count() == near_duplicates(clashing(docs)).count()
    assert exact_duplicates(no_docs).count() == 0 == near_duplicates(no_docs).count()


def test_chunks_depend_on_their_own_text_only():
    random = np.random.default_rng(0)
    texts = [bytes(random.integers(97, 123, n, dtype=np.uint8)).decode() for n in (0, 10, 5000, 1_200_000, 33)] + ["z" * 200_000]
    alone = {}
    for text in texts:
        data, starts = normalised(*flat(pa.array([text])))
        ends, counts = chunk_bounds(data, starts)
        assert counts.sum() == len(ends) and (ends[-1] if len(ends) else 0) == len(text)
        assert not len(ends) or np.diff(ends, prepend=0).max() <= MOST_CHUNK
        alone[text] = ends.tolist()
    data, starts = normalised(*flat(pa.array(texts)))
    ends, counts = chunk_bounds(data, starts)
    at = 0
    for text, start, n in zip(texts, starts, counts, strict=False):
        assert (ends[at:at + n] - start).tolist() == alone[text]
        at += n


def brute_components(rows, n, percent):
    sets = []
    for _, text, *_ in rows:
        words = split(text)
        k = min(n, len(words))
        sets.append({tuple(words[i:i + k]) for i in range(len(words) - k + 1)} if words else set())
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                parent[root(i)] = root(j)
    groups = defaultdict(list)
    for i in range(len(rows)):
        groups[root(i)].append(rows[i][0])
    low = {g: min(ids, key=order) for g, ids in groups.items()}
    return sorted((str(rows[i][0]), len(sets[i]), str(low[root(i)])) for i in range(len(rows)))


@pytest.mark.parametrize("n, percent, small, block", [(3, 85, 64, 1000), (5, 80, 64, 1000), (3, 85, 2, 3)])
def test_near_duplicates(docs, monkeypatch, n, percent, small, block):
    """With small buckets compared as pairs, and with all compared in blocks."""
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "BLOCK_ROWS", block)
    rows = near_duplicates(docs, shingle=n, percent=percent).collect()
    assert sorted((str(r.doc_id), r.n_shingles, str(r.component_id)) for r in rows) == brute_components(corpus(), n, percent)


def test_near_duplicates_keep_one_of_a_group(docs):
    rows = near_duplicates(docs, shingle=3, percent=85).collect()
    for r in rows:
        assert not r.kept or r.doc_id == r.component_id
    linked = [r for r in rows if r.component_id is not None and r.n_shingles]
    assert len({r.component_id for r in linked}) == sum(r.kept for r in linked)


def test_circulant_signature_estimates_similarity():
    random = np.random.default_rng(1)
    a = random.integers(0, 1 << 63, 1000, dtype=np.uint64)
    b = np.concatenate([a[:700], random.integers(0, 1 << 63, 300, dtype=np.uint64)])
    sign = signatures(np.concatenate([a, b]), np.array([0, 1000]), 1024)
    assert abs((sign[0] == sign[1]).mean() - 700 / 1300) < 0.06
    assert len(np.unique(permutation(np.arange(1 << 16, dtype=np.uint32), 5))) == 1 << 16
    assert (band_keys(sign, 4, 6) == band_keys(sign[[0, 0]], 4, 6))[0].all()


def test_overlaps_and_spanning_labels():
    random = np.random.default_rng(2)
    sets = [np.unique(random.integers(0, 9000, n)) for n in (5, 800, 3000, 1, 4000)]
    got = overlaps(sets[:2], sets[2:])
    assert [[len(np.intersect1d(a, b)) for b in sets[2:]] for a in sets[:2]] == got.tolist()
    linked = np.zeros((6, 6), dtype=bool)
    for a, b in ((5, 4), (4, 2), (1, 3)):
        linked[a, b] = linked[b, a] = True
    assert spanning(linked).tolist() == [0, 1, 2, 1, 2, 2]


def test_components_of_chains_stars_and_loops(spark):
    links = [(k, k + 1) for k in range(1, 40)] + [(100, k) for k in range(101, 160)] + [(300, 200), (200, 300), (7, 7), (500, 500)]
    found = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    want = {**{k: 1 for k in range(1, 41)}, **{k: 100 for k in range(100, 160)}, 200: 200, 300: 200, 500: 500}
    assert found == want
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_words_are_hashed_alike_wherever_they_stand():
    texts = [t or "" for t in ODD] + [prose(1, 5000), "x " * 400_000 + "y" * 700_000 + " x"]
    data, starts = flat(pa.array(texts))
    hashes, at = word_hashes(data, starts)
    seen, words = {}, 0
    for k, text in enumerate(texts):
        own = split(text)
        words += len(own)
        assert at[k + 1] - at[k] == len(own)
        for word, h in zip(own, hashes[at[k]:at[k + 1]].tolist(), strict=True):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(seen) and words == len(hashes)


def test_slices_hold_all_rows():
    batch = pa.RecordBatch.from_pydict({"text": ["a" * n for n in (10, 0, 600_000, 900_000, 5, 0)] + [None]})
    parts = list(slices(batch))
    assert sum(p.num_rows for p in parts) == 7 and len(parts) > 2


def test_no_cross_join(docs):
    for found in (exact_duplicates(docs), near_duplicates(docs)):
        plan = plan_text(found)
        assert "Cartesian" not in plan and "NestedLoop" not in plan
