"""Ranked lexical search by blocks of similar documents within each term's postings.

A first pass over the corpus keeps, of each document, its length and the counts of the
terms that queries use. Documents are then dealt into shards, the rows of one task at a
time. In a shard, a term's posting list is clustered by the similarity of its documents,
and each block of neighbours has a summary: the greatest impact of every coordinate.
A block is skipped for a query only if the summary, summed over the query's terms, stays below
a score that ten documents are known to reach; otherwise its documents are scored whole.
So the result is that of scoring everything.

Rare terms go first. A document that is still unseen when a list's turn comes holds
none of the query's terms before it, so bounds need the remaining terms only, and a query whose
remaining terms can't reach the score is done. The score to reach starts from a search
of a part of the documents: any ten of them give a lower bound for the tenth best.

Terms are 64-bit hashes. Weights and scores are whole numbers below 2**53, which doubles hold exactly.
"""

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window, functions as F

from ledgerflow.llm.store import row_number, small_batches, written
from ledgerflow.llm.words import IS_MARK, flat, located_words, slices

TOP = 10
BLOCK = 64  # documents of one block at most
SHARD_ROWS, SHARD_ENTRIES = 4096, 2_000_000  # a shard ends at the first that it reaches
SKETCH = 16  # coordinates of the sketches by which documents are clustered
MOST_ENTRIES = 1_000_000  # query terms searched at once: 16 MB; more queries go in further passes
SAMPLE = 16  # the scores to reach come from a search of one document in so many
PART = 32  # queries whose coordinates are laid out at once


def _terms(column) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every term, and the row it is in."""
    data, starts = flat(column)
    hashes, first, _ = located_words(data, starts, separators=IS_MARK)
    return hashes, np.searchsorted(starts, first, side="right") - 1


def _lists(values: np.ndarray, rows: np.ndarray, n: int, kind) -> pa.ListArray:
    offsets = np.searchsorted(rows, np.arange(n + 1)).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def _query_terms(batches):
    for batch in batches:
        for part in slices(batch):
            hashes, rows = _terms(part.column("text"))
            order = np.lexsort((hashes, rows))
            hashes, rows = hashes[order].view(np.int64), rows[order]
            new = np.ones(len(rows), dtype=bool)
            new[1:] = (rows[1:] != rows[:-1]) | (hashes[1:] != hashes[:-1])
            first = np.flatnonzero(new)
            times = np.diff(np.append(first, len(rows)))
            n = part.num_rows
            yield pa.record_batch(
                [part.column("item"), _lists(hashes[first], rows[first], n, pa.int64()), _lists(times, rows[first], n, pa.int32())],
                names=["item", "terms", "times"])


def _vectors(vocabulary: np.ndarray):
    """Rows with a term: how many terms, and which of the vocabulary how often."""
    def run(batches):
        for batch in batches:
            for part in slices(batch):
                hashes, rows = _terms(part.column("text"))
                n = part.num_rows
                place = np.searchsorted(vocabulary, hashes)
                place[place == len(vocabulary)] = 0
                hit = vocabulary[place] == hashes
                keys, times = np.unique(rows[hit] * len(vocabulary) + place[hit], return_counts=True)
                of = keys // len(vocabulary)
                out = pa.record_batch([
                    part.column("doc_id"), pa.array(np.bincount(rows, minlength=n), type=pa.int64()),
                    _lists(keys % len(vocabulary), of, n, pa.int32()), _lists(times, of, n, pa.int32()),
                ], names=["doc_id", "n", "terms", "times"])
                yield out.filter(pc.greater(out.column("n"), 0))
    return run


def _holders(size: int):
    """In how many documents of a task each term occurs."""
    def run(batches):
        counts = np.zeros(size, dtype=np.int64)
        for batch in batches:
            counts += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        there = np.flatnonzero(counts)
        yield pa.record_batch([pa.array(there, type=pa.int32()), pa.array(counts[there])], names=["term", "df"])
    return run


def weights(holders: np.ndarray, n_docs: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * int(df) + 1))) for df in holders], dtype=np.int64)


class Queries:
    """Some queries over one vocabulary: terms and times of each, by query and by term."""

    def __init__(self, offsets: np.ndarray, terms: np.ndarray, times: np.ndarray, size: int):
        self.offsets, self.terms, self.times = offsets, terms, times
        self.of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        self.by_term = np.argsort(terms, kind="stable")
        self.edges = np.searchsorted(terms[self.by_term], np.arange(size + 1))

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def own(self, query: int) -> tuple[np.ndarray, np.ndarray]:
        a, b = self.offsets[query:query + 2]
        return self.terms[a:b], self.times[a:b]

    def with_term(self, term: int) -> tuple[np.ndarray, np.ndarray]:
        """Queries with the term, and its times in each."""
        found = self.by_term[self.edges[term]:self.edges[term + 1]]
        return self.of[found], self.times[found]


def _spans(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of several runs, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


class Shard:
    """The impacts of some documents' terms, by document and by term."""

    def __init__(self, n: np.ndarray, offsets: np.ndarray, terms: np.ndarray, times: np.ndarray, weight: np.ndarray, n_docs: int, length: int):
        if len(n) and int(n.max()) * 75 * n_docs >= 1 << 63:
            scaled = np.array([75 * int(x) * n_docs // length for x in n], dtype=np.int64)
        else:
            scaled = 75 * n * n_docs // length
        m = np.repeat(25 + scaled, np.diff(offsets))
        times = times.astype(np.int64)
        impact = weight[terms] * (1_000_000_000 * times // (1000 * times + 8 * m))
        row = np.repeat(np.arange(len(n)), np.diff(offsets))
        kept = impact > 0
        self.rows = len(n)
        self.terms, self.impact, self.row = terms[kept], impact[kept].astype(np.float64), row[kept]
        self.offsets = np.searchsorted(self.row, np.arange(len(n) + 1))
        self.by_term = np.argsort(self.terms, kind="stable")
        self.edges = np.searchsorted(self.terms[self.by_term], np.arange(len(weight) + 1))
        signs = np.random.default_rng(1).standard_normal((len(weight), SKETCH), dtype=np.float32)
        sketch = np.stack([np.bincount(self.row, self.impact * signs[self.terms, k], minlength=self.rows) for k in range(SKETCH)], axis=1)
        self.sketch = sketch / np.maximum(np.linalg.norm(sketch, axis=1, keepdims=True), 1e-30)

    def postings(self, term: int) -> np.ndarray:
        """Documents with the term, and the greatest of its impacts."""
        found = self.by_term[self.edges[term]:self.edges[term + 1]]
        return self.row[found], self.impact[found].max(initial=0.0)

    def blocks(self, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """``docs`` with similar ones side by side, and where each block begins."""
        if len(docs) <= BLOCK:
            return docs, np.zeros(1, dtype=np.int64)
        leaders = docs[::BLOCK]
        nearest = (self.sketch[docs] @ self.sketch[leaders].T).argmax(axis=1)
        order = np.argsort(nearest, kind="stable")
        nearest = nearest[order]
        first = np.searchsorted(nearest, nearest)  # of the document's cluster
        return docs[order], np.flatnonzero((np.arange(len(docs)) - first) % BLOCK == 0)

    def laid_out(self, docs: np.ndarray, column: np.ndarray, width: int) -> np.ndarray:
        """Impacts of ``docs`` as a matrix of the terms that ``column`` places at 0 or above."""
        sizes = self.offsets[docs + 1] - self.offsets[docs]
        at = _spans(self.offsets[docs], sizes)
        place = column[self.terms[at]]
        used = place >= 0
        out = np.zeros((len(docs), width))
        out[np.repeat(np.arange(len(docs)), sizes)[used], place[used]] = self.impact[at[used]]
        return out


def best_of(shard: Shard, queries: Queries, weight: np.ndarray, reach: np.ndarray, rank: np.ndarray, top: int = TOP):
    """For each query its best documents in the shard with a score of ``reach`` or more.

    ``rank`` orders documents of equal scores. Gives a list of (scores, documents), and how many
    (block, query) pairs there were and how many of them were skipped.
    """
    reach = np.maximum(reach, 1.0)
    best = [(np.zeros(0), np.zeros(0, dtype=np.int64)) for _ in range(len(queries))]
    left = np.zeros(len(queries))  # what the terms to come can add up to
    lists = {}
    for term in np.flatnonzero((np.diff(shard.edges) > 0) & (np.diff(queries.edges) > 0)):
        docs, most = shard.postings(term)
        lists[term] = docs, most
        asked, times = queries.with_term(term)
        np.add.at(left, asked, most * times)
    seen = np.zeros((len(queries), shard.rows), dtype=bool)
    to_come = np.zeros(len(weight), dtype=bool)
    to_come[list(lists)] = True
    column = np.full(len(weight), -1, dtype=np.int64)
    tried = skipped = 0
    for term in sorted(lists, key=lambda t: (-weight[t], t)):
        docs, most = lists[term]
        asked, times = queries.with_term(term)
        alive = asked[left[asked] >= reach[asked]]
        if len(alive):
            docs, starts = shard.blocks(docs)
            sizes = np.diff(np.append(starts, len(docs)))
        for some in (alive[k:k + PART] for k in range(0, len(alive), PART)):
            own = [queries.own(q) for q in some]
            terms = np.unique(np.concatenate([t for t, _ in own]))
            terms = terms[to_come[terms]]
            column[terms] = np.arange(len(terms))
            impacts = shard.laid_out(docs, column, len(terms))
            asks = np.zeros((len(terms), len(some)))
            for k, (t, n) in enumerate(own):
                there = to_come[t]
                asks[column[t[there]], k] = n[there]
            column[terms] = -1
            summary = np.maximum.reduceat(impacts, starts, axis=0)
            open_ = summary @ asks >= reach[some]
            tried, skipped = tried + open_.size, skipped + open_.size - int(open_.sum())
            for k, q in enumerate(some):
                at = _spans(starts[open_[:, k]], sizes[open_[:, k]])
                at = at[~seen[q, docs[at]]]
                if not len(at):
                    continue
                seen[q, docs[at]] = True
                used = np.flatnonzero(asks[:, k])
                found = impacts[np.ix_(at, used)] @ asks[used, k]
                good = found >= reach[q]
                score, doc = np.append(best[q][0], found[good]), np.append(best[q][1], docs[at[good]])
                first = np.lexsort((rank[doc], -score))[:top]
                best[q] = score[first], doc[first]
                if len(first) == top:
                    reach[q] = max(reach[q], score[first[-1]])
        np.subtract.at(left, asked, most * times)
        to_come[term] = False
    return best, tried, skipped


def _search(shared):
    def run(batches):
        queries, weight, reach, n_docs, length, top = shared.value

        def done(held):
            table = pa.Table.from_batches(held).combine_chunks()
            terms, times = table["terms"].combine_chunks(), table["times"].combine_chunks()
            offsets = terms.offsets.to_numpy()
            shard = Shard(table["n"].to_numpy(), offsets - offsets[0], terms.flatten().to_numpy(), times.flatten().to_numpy(), weight, n_docs, length)
            ids = table["doc_id"].combine_chunks()
            rank = pc.rank(ids, sort_keys="ascending", null_placement="at_end", tiebreaker="first").to_numpy().astype(np.int64)
            best, tried, skipped = best_of(shard, queries, weight, reach.copy(), rank, top)
            found = np.repeat(np.arange(len(best)), [len(s) for s, _ in best])
            score, doc = (np.concatenate([pair[k] for pair in best]) for k in range(2))
            return pa.record_batch(
                [pa.array(found, type=pa.int32()), ids.take(pa.array(doc)), pa.array(score.astype(np.int64))], names=["query", "doc_id", "score"])

        held, rows, entries = [], 0, 0
        for batch in batches:
            held.append(batch)
            rows, entries = rows + batch.num_rows, entries + len(batch.column("terms").flatten())
            if rows >= SHARD_ROWS or entries >= SHARD_ENTRIES:
                yield done(held)
                held, rows, entries = [], 0, 0
        if rows:
            yield done(held)
    return run


def _top(found: DataFrame, top: int) -> DataFrame:
    """The best ``top`` rows of each query; each task sends at most so many on."""
    order = Window.partitionBy("query").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def _pass(texts: DataFrame, asked, top: int) -> DataFrame:
    """``query, rank, doc_id, score`` for the queries of one Arrow table."""
    spark = texts.sparkSession
    terms, times = asked["terms"].combine_chunks(), asked["times"].combine_chunks()
    offsets = terms.offsets.to_numpy()
    hashes = terms.flatten().to_numpy().view(np.uint64)
    vocabulary, codes = np.unique(hashes, return_inverse=True)
    kind = texts.schema["doc_id"].dataType.simpleString()
    if not len(vocabulary):
        return spark.createDataFrame([], f"query int, doc_id {kind}, score bigint, rank int")
    queries = Queries(offsets - offsets[0], codes, times.flatten().to_numpy(), len(vocabulary))
    vectors = written(texts.mapInArrow(_vectors(vocabulary), f"doc_id {kind}, n bigint, terms array<int>, times array<int>"), "vectors")
    n_docs, length = vectors.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    held = vectors.select("terms").mapInArrow(_holders(len(vocabulary)), "term int, df bigint").groupBy("term").agg(F.sum("df").alias("df")).toArrow()
    holders = np.zeros(len(vocabulary), dtype=np.int64)
    holders[held["term"].to_numpy()] = held["df"].to_numpy()
    weight = weights(holders, n_docs)

    def search(rows: DataFrame, reach: np.ndarray) -> DataFrame:
        shared = spark.sparkContext.broadcast((queries, weight, reach, n_docs, length, top))
        return _top(rows.mapInArrow(_search(shared), f"query int, doc_id {kind}, score bigint"), top)

    reach = np.zeros(len(queries))
    some = vectors.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SAMPLE)) == 0)
    for row in search(some, reach).where(F.col("rank") == top).select("query", "score").collect():  # one a query
        reach[row["query"]] = row["score"]
    return search(vectors, reach)


def ranked(
    docs: DataFrame, queries: DataFrame, top: int = TOP, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", query_col: str = "text", most_entries: int = MOST_ENTRIES,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` best rows of ``docs`` for each row of ``queries``.

    Terms are runs of ASCII letters, digits and characters beyond ASCII, A-Z lower-cased. Only
    documents with a score above 0 are ranked; equal scores go by ascending id, nulls last.
    Null and empty texts have no terms: such documents are not counted, such queries have no
    row. Rows of ``docs`` with equal ids are documents of their own. Of queries with equal or
    null ids each is answered, under that id. Other columns may have any names. Lowers the
    session's Arrow batches.

    Queries are answered in passes of about ``most_entries`` distinct terms, which the driver reads
    and broadcasts; documents are spread over all tasks and only ``top`` rows a query leave
    a shard.
    """
    spark = docs.sparkSession
    small_batches(spark)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    items = queries.select(F.col(item_col).alias("item"), F.col(query_col).alias("text"))
    kind = items.schema["item"].dataType.simpleString()
    items = items.mapInArrow(_query_terms, f"item {kind}, terms array<bigint>, times array<int>").where("size(terms) > 0")
    items = written(items.withColumn("number", row_number(None)), "queries")
    entries = items.agg(F.coalesce(F.sum(F.size("terms")), F.lit(0))).first()[0]
    passes = max(1, -(-entries // most_entries))
    found = None
    for k in range(passes):
        asked = items.where(F.pmod(F.xxhash64("number"), F.lit(passes)) == k)
        table = asked.select("number", "terms", "times").sort("number").toArrow()
        names = spark.createDataFrame(
            pa.table({"query": pa.array(range(table.num_rows), pa.int32()), "of": table["number"].cast(pa.int64())}))
        named = asked.select("number", "item").join(F.broadcast(names), F.col("number") == F.col("of")).select("query", "item")
        rows = _pass(texts, table, top).join(F.broadcast(named), "query").select(F.col("item").alias(item_col), "rank", F.col("doc_id").alias(id_col), "score")
        found = rows if found is None else found.unionByName(rows)
    return found
