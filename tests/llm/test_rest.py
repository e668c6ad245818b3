"""Mixing, archives, embeddings and the pipeline."""

import hashlib
import json
import math
import sys
from base64 import b32encode
from collections import Counter
from pathlib import Path

import duckdb
import numpy as np
import pytest
from conftest import plan_text
from llm_corpus import clashing, corpus, docs, no_docs, split  # noqa: F401
from pyspark.sql import functions as F

from ledgerflow.llm import lattice, mixing, queries, warc
from ledgerflow.llm.store import written

SF = "/root/testdata/sf0.01"
TARGETS = {"source": {"src0": 0.5, "src1": 0.3, "absent": 0.2}, "lang": {"en": 0.5, "de": 0.5}, "topic": {"brief": 0.4, "article": 0.4, "long": 0.2}}


# Mixing

def test_fitted_cells_have_the_target_shares(docs):
    found = mixing.mixed(docs, TARGETS).select("_mix.*")
    cells = mixing.fitted_cells(found, TARGETS).collect()
    natural = {n: Counter() for n in mixing.CELL}
    fitted = {n: Counter() for n in mixing.CELL}
    for c in cells:
        for n in mixing.CELL:
            natural[n][c[n]] += c.natural
            fitted[n][c[n]] += c.fitted
    for n in mixing.CELL:
        rest = natural[n][mixing.OTHER]
        given = sum(t for v, t in TARGETS[n].items() if v in natural[n])
        for v, share in fitted[n].items():
            want = rest if v == mixing.OTHER else TARGETS[n][v] / given * (1 - rest)
            assert math.isclose(share, want, abs_tol=2e-3), (n, v)
    kept = sum(c.natural * c.probability for c in cells)
    assert math.isclose(kept, mixing.KEPT_ONCE, rel_tol=1e-9)
    # In proportion to the ratios but where a cell is kept whole.
    scales = {round(c.probability * c.natural / c.fitted, 9) for c in cells if c.probability < 1}
    assert len(scales) == 1
    few = mixing.fitted_cells(found, TARGETS, kept=0.01).collect()
    assert math.isclose(sum(c.natural * c.probability for c in few), 0.01, rel_tol=1e-9)
    assert {c.probability for c in mixing.fitted_cells(found, TARGETS, kept=1.0).collect()} == {1.0}


def test_sampling_follows_the_probabilities(spark):
    many = spark.range(40_000).select(
        F.col("id").alias("doc_id"), F.lit("four words of text").alias("text"), F.when(F.col("id") % 4 == 0, "en").otherwise("de").alias("lang"), F.lit("src0").alias("source"))
    kept = mixing.sampled(many, TARGETS, kept=0.5)
    shares = {r.lang: r["count"] for r in kept.groupBy("lang").count().collect()}
    assert abs(shares["en"] - 10_000) < 300 and abs(shares["de"] - 10_000) < 300
    assert kept.columns == many.columns


def realised(sample):
    """The token shares of a sample's sources, languages and topics."""
    tokens = sample.select("source", "lang", mixing.words(F.col("text")).alias("n")).withColumn("topic", F.expr(mixing.TOPICS.format(words="n")))
    total = tokens.agg(F.sum("n")).first()[0]
    return {c: {r[c]: r.n / total for r in tokens.groupBy(c).agg(F.sum("n").alias("n")).collect()} for c in mixing.CELL}


def near_targets(shares):
    for name, own in shares.items():
        for value, target in queries.TARGETS[name].items():
            assert abs(own[value] - target) < 0.02, (name, value, own[value])


def test_the_query_and_the_stage_have_the_target_shares(spark):
    """Also where targets are far above the natural shares: source src0, 0.05 of the tokens here."""
    import corpus_pipeline as pipeline

    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    rows = queries.op3_mixing(spark, "/root/testdata/sf0.1").collect()
    total = sum(r.tokens * r.copies for r in rows)
    found = {n: Counter() for n in mixing.CELL}
    for r in rows:
        for n in mixing.CELL:
            found[n][r[n]] += r.tokens * r.copies / total
    near_targets(found)
    assert len(rows) == docs.count()
    assert abs(total / sum(r.tokens for r in rows) - mixing.KEPT) < 0.02
    sample = pipeline.mixing(spark, docs, "/root/testdata/sf0.1")
    assert sample.columns == docs.columns and sample.count() == sum(r.copies for r in rows)
    near_targets(realised(sample))


def test_copies_follow_the_expected_numbers(docs):
    """The whole part always, one more by a draw that a row's id fixes."""
    for r in mixing.mixed(clashing(docs), TARGETS, repeats=True, kept=3.0).select("_mix.*").collect():
        assert r.copies - math.floor(r.expected) in (0, 1) and r.expected >= 0
    rows = mixing.repeated(docs, TARGETS, kept=3.0)
    again = mixing.repeated(docs.repartition(5), TARGETS, kept=3.0)
    assert rows.columns == docs.columns and rows.exceptAll(again).count() == 0 == again.exceptAll(rows).count()


def test_every_row_is_mixed(docs, no_docs):
    rows = mixing.mixed(clashing(docs), TARGETS).select("doc_id", "text", "_mix.*").collect()
    assert len(rows) == docs.count()
    assert all(0 < r.probability <= 1 and r.tokens == len(split(r.text)) for r in rows)
    assert mixing.mixed(no_docs, TARGETS).count() == 0 == mixing.sampled(no_docs, TARGETS).count()
    with pytest.raises(ValueError):
        mixing.fitted_cells(no_docs, {n: dict.fromkeys(map(str, range(60)), 1.0) for n in mixing.CELL})


def test_mixing_is_native(docs):
    plan = plan_text(mixing.mixed(docs, TARGETS))
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# Archives

PAGES = [None, "", "", "WARC/1.1\r\n\r\nx\r\n\r\nWARC/1.1", "a\nb 5\nfiledesc: 3\n", "é\r\n", "x", "x", "x", "y" * 100_000, "y" * 100_000, "HTTP/1.1 200 OK\r\n\r\nagain"]


def pages(spark):
    rows = [(k, [f"http://a.example/{k % 4}", "http://b c/ü?q", None][k % 3], html) for k, html in enumerate(PAGES)] + [(None, "http://n", "x"), (50, "http://a", "x")]
    return spark.createDataFrame(rows, "page_id long, url string, html string"), rows


@pytest.mark.parametrize("a_file, least", [(1000, 0), (3, 0), (1000, 2)])
def test_round_trip_of_pages(spark, a_file, least):
    frame, rows = pages(spark)
    found = warc.read_warc(spark, warc.convert(spark, warc.write_arc(clashing(frame), records_a_file=a_file), least, a_file)).collect()
    same = {}
    for i, _, html in rows:
        same.setdefault((html or "").encode(), []).append(i)
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        best = max(same[data], key=lambda k: (k is not None, k or 0))
        revisit = len(data) >= least and i != best
        want.append((str(i), len(data), b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", best if revisit else None))
    assert sorted(want, key=str) == sorted(((str(r.page_id), r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in found), key=str)
    assert len({r.record_id for r in found}) == len(rows)


def test_no_pages(spark):
    frame, _ = pages(spark)
    assert warc.read_warc(spark, warc.convert(spark, warc.write_arc(frame.limit(0)))).count() == 0


@pytest.mark.parametrize("version", [1, 2])
def test_header_lines_of_both_versions(version):
    body = b"HTTP/1.0 200 OK\r\nX: y\r\n\r\nhello\nworld 12\n"
    data = warc.version_block("x.arc", version) + b"".join(
        warc.arc_header({"URL": url, "IP-address": "1.2.3.4", "Archive-date": "20010203", "Content-type": kind}, len(block), version) + block + b"\n"
        for url, kind, block in (("http://a/", "text/html", body), ("dns:a", "text/dns", b"a 1.2.3.4")))
    (one, first), (two, second) = warc.parse_arc(data)
    assert (one["URL"], one["IP-address"], one["Content-type"], first) == ("http://a/", "1.2.3.4", "text/html", body)
    assert (two["URL"], second) == ("dns:a", b"a 1.2.3.4")
    assert warc.warc_date(one["Archive-date"]) == "2001-02-03T00:00:00Z"
    (cut, part), = warc.parse_arc(data[:data.index(b"hello") + 2])
    assert cut["truncated"] == "length" and part.endswith(b"he")
    with pytest.raises(ValueError):
        list(warc.parse_arc(b"no header here\n"))


def test_records_of_many_kinds():
    block = b"a\r\n\r\nWARC/1.1\r\n"
    data = b"".join(warc.warc_record(kind, {"A": "b"}, block) + b"\n" for kind in ("response", "resource"))
    found = list(warc.parse_warc(data))
    assert [(h["warc-type"], b) for h, b in found] == [("response", block), ("resource", block)]


# Embeddings

def test_decoding_finds_the_nearest_point():
    random = np.random.default_rng(0)
    x = random.normal(size=(300, 8)) * 2
    near = lattice.decode(x)
    doubled = np.rint(near * 2).astype(int)
    assert ((doubled % 2 == 0).all(axis=1) | (doubled % 2 != 0).all(axis=1)).all() and (near.sum(axis=1) % 2 == 0).all()
    own = ((x - near) ** 2).sum(axis=1)
    assert len(np.unique(lattice.NEIGHBOURS, axis=0)) == 240
    others = ((x[:, None] - near[:, None] - lattice.NEIGHBOURS[None]) ** 2).sum(axis=2)
    assert (own[:, None] <= others + 1e-9).all()


def vectors(spark):
    random = np.random.default_rng(4)
    base = random.normal(size=(40, 16))
    rows = [base[k] for k in range(40)]
    rows += [base[k % 5] + random.normal(size=16) * s for k, s in enumerate(np.linspace(0.01, 0.6, 120))]
    rows += [base[0]] * 30 + [base[1] * 3]
    rows = [[float(np.float32(v)) for v in r] for r in rows]
    odd = [None, [], [0.0] * 16, [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1e-30] * 16, [1e30] * 16, [1.0] * 16, [1.0, 2.0], [2.0, 4.0]]
    rows = list(enumerate(rows + odd)) + [(None, rows[3]), (7, rows[7])]
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>"), rows


def linked_by_hand(rows, least):
    x = []
    for _, v in rows:
        good = v and all(c is not None and math.isfinite(np.float32(c)) for c in v) and any(v)
        v = np.array([np.float32(c) for c in v], dtype=np.float64) if good else None
        x.append(v / np.linalg.norm(v) if good else None)
    near = [[i != j and a is not None and b is not None and len(a) == len(b) and a @ b >= least for j, b in enumerate(x)] for i, a in enumerate(x)]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i in range(len(rows)):
            for j in range(len(rows)):
                if near[i][j] and label[j] < label[i]:
                    label[i], changed = label[j], True
    order = lambda k: (k is None, k or 0)
    low = {c: min((rows[i][0] for i in range(len(rows)) if label[i] == c), key=order) for c in set(label)}
    return Counter((rows[i][0], sum(near[i]), low[label[i]]) for i in range(len(rows)))


@pytest.mark.parametrize("block", [1024, 8])
def test_near_vectors(spark, block):
    """In few buckets of any size, so that all pairs are found; with large ones split."""
    frame, rows = vectors(spark)
    found = lattice.near_vectors(clashing(frame), probes=40, tables=6, block=block).collect()
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in found) == linked_by_hand(rows, 0.9)
    assert all(r.component_id == r.vec_id for r in found if r.kept)
    assert lattice.near_vectors(frame.limit(0)).count() == 0


def test_recall_at_the_threshold(spark):
    """Pairs just above the threshold, with the production parameters."""
    random = np.random.default_rng(6)
    a = random.normal(size=(600, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = random.normal(size=(600, 64))
    b -= (b * a).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    rows = [(k, v.tolist()) for k, v in enumerate(np.concatenate([a, 0.901 * a + math.sqrt(1 - 0.901**2) * b]))]
    found = lattice.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>")).agg(F.sum("n_links")).first()[0]
    assert found >= 2 * 600 * 0.97


# Queries and pipeline

@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "labels", "benchmark"):
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_sketches_bound_the_cosine():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 48)) ** 3
    x[200:] = x[:200] + 0.3 * rng.normal(size=(200, 48))
    x[5], x[6] = np.eye(48)[0], -np.eye(48)[0] * 1e-9
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    rows = np.arange(400)
    bound = lattice.most_alike(lattice.sketches(x), rows, rows)
    cosine = x @ x.T
    assert (bound >= cosine).all() and (bound - cosine).max() < 0.1


def test_many_linked_and_chained_vectors(spark):
    """Thousands of links: groups of near copies, equal rows and chains, against all pairs."""
    rng = np.random.default_rng(8)
    rows = []
    for k in range(150):  # copies of one vector, close to each other
        centre = rng.normal(size=64)
        rows += [centre + 0.06 * rng.normal(size=64) for _ in range(1 + k % 12)]
    for _ in range(40):  # each vector is near the next one only
        a, b = np.linalg.qr(rng.normal(size=(64, 2)))[0].T
        rows += [np.cos(0.3 * j) * a + np.sin(0.3 * j) * b for j in range(9)]
    rows += [rows[7]] * 30
    order = rng.permutation(len(rows))
    x = np.array(rows)[order]
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = unit @ unit.T >= 0.9
    np.fill_diagonal(near, False)
    least, links = np.arange(len(x)), near.sum(axis=1)
    while True:
        lower = np.minimum(least, np.where(near, least[None, :], len(x)).min(axis=1))
        if (lower == least).all():
            break
        least = lower
    frame = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)], "vec_id long, embedding array<double>").repartition(4)
    found = {r.vec_id: r for r in lattice.near_vectors(frame).collect()}
    assert links.sum() > 3000 and len(found) == len(x)
    assert {k: (r.n_links, r.component_id, r.kept) for k, r in found.items()} == {k: (links[k], least[k], least[k] == k) for k in range(len(x))}


@pytest.mark.parametrize("name", sorted(k for k, (_, sql) in queries.QUERIES.items() if sql))
def test_same_rows_as_duckdb(spark, duck, name):
    run, sql = queries.QUERIES[name]
    result, want = run(spark, SF), duck.sql(sql)
    columns = sorted(want.columns)
    assert sorted(result.columns) == columns
    rows = Counter(tuple(r[c] for c in columns) for r in result.collect())
    assert rows == Counter(duck.sql(f"SELECT {', '.join(columns)} FROM ({sql})").fetchall())


def test_urls_that_look_like_a_version_record(spark, tmp_path):
    rows = [(1, "http://a", "x"), (2, "filedesc://b", "one\nURL two 3\n"), (3, "filedesc:", "y"), (4, "http://c d\te", "x"), (5, "filedesc://b 0 1 2", "")]
    given = spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1)
    for records in (1, 2, 1000):
        found = warc.read_warc(spark, warc.convert(spark, warc.write_arc(given, records_a_file=records), records_a_file=records))
        got = {(r.page_id, r.payload_bytes, r.payload_digest, r.refers_to) for r in found.collect()}
        assert got == {(k, len(h), warc.sha1(h.encode()), 4 if k == 1 else None) for k, _, h in rows}


def test_large_pages_have_files_of_their_own(spark, monkeypatch):
    monkeypatch.setattr(warc, "LARGE", 2000)
    rows = [(k, "http://a", ("z" * 5000 if k % 10 == 0 else "w") + str(k % 40)) for k in range(200)] + [(900, None, None)]
    given = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    arc = warc.write_arc(given)
    found = warc.convert(spark, arc)
    for path in (arc, found):
        sizes = [len(warc._plain(f["content"])) for f in warc._files(spark, path).collect()]
        assert max(sizes) < 8000 + 200 * 600 and sum(s > 5000 for s in sizes) >= (20 if path == arc else 4)
        large = [warc._plain(f["content"]) for f in warc._files(spark, f"{path}/large").collect()]
        assert all(content.count(b"zzzzz0") <= 1 and len(content) < 8000 for content in large)
    last = {html: max(k for k, _, h in rows if h == html) for _, _, html in rows}
    got = {(r.page_id, r.payload_bytes, r.refers_to) for r in warc.read_warc(spark, found).collect()}
    assert got == {(k, len(h or ""), None if last[h] == k else last[h]) for k, _, h in rows}


def test_archives_of_repeated_pages(spark, tmp_path):
    """A table with large groups of equal pages: one response each, all others revisit it."""
    rows = [(k, f"http://a/{k}", f"<p>{k % 5 if k % 3 else 'all the same'}</p>" * (1 + k % 2)) for k in range(3000)]
    spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4).write.parquet(str(tmp_path / "pages.parquet"))
    last = {}
    for k, _, html in rows:
        last[html] = max(k, last.get(html, 0))
    found = queries.op6_warc(spark, str(tmp_path)).collect()
    assert {(r.page_id, r.record_type, r.refers_to) for r in found} == {
        (k, *(("response", None) if last[html] == k else ("revisit", last[html]))) for k, _, html in rows}
    assert len(found) == 3000


def test_archives_of_all_pages(spark, duck):
    rows = {r.page_id: r for r in queries.op6_warc(spark, SF).collect()}
    given = duck.sql("SELECT page_id, html FROM pages").fetchall()
    assert len(rows) == len(given)
    for i, html in given:
        assert rows[i].payload_digest == b32encode(hashlib.sha1(html.encode()).digest()).decode()
        assert rows[i].payload_bytes == len(html.encode())


def test_broadcasts_are_bounded_by_bytes(spark, monkeypatch):
    from ledgerflow.llm import store

    long_ids = written(spark.range(100).select(F.repeat(F.lit("x"), 10_000).alias("k"), "id"), "keys")
    assert "broadcast" in store.checked_broadcast(long_ids)._jdf.queryExecution().logical().toString()
    monkeypatch.setattr(store, "MOST_BROADCAST_BYTES", 100_000)
    assert "broadcast" not in store.checked_broadcast(long_ids)._jdf.queryExecution().logical().toString()
    assert "broadcast" in store.checked_broadcast(long_ids.select("id"))._jdf.queryExecution().logical().toString()
    monkeypatch.setattr(store, "MOST_BROADCAST_KEYS", 99)
    assert "broadcast" not in store.checked_broadcast(long_ids.select("id"))._jdf.queryExecution().logical().toString()


def test_tables_on_the_way_are_removed(spark, tmp_path):
    from ledgerflow.llm import store
    from ledgerflow.sources.paths import exists

    made = []

    def build():
        first = written(spark.range(5), "first")
        made.append(store._folders[-1])
        return first.withColumn("x", F.lit(1))

    out = store.settled(spark, build, "out")
    assert out.count() == 5 and not exists(spark, made[0]) and exists(spark, store._folders[-1])


def test_pipeline_leaves_its_stages_only(spark):
    import corpus_pipeline as pipeline
    from ledgerflow.llm import store

    began = len(store._folders)
    assert pipeline.run(spark, "/root/testdata/sf0.001").count() > 0
    assert len(store._folders) - began == len(pipeline.STAGES)


def test_pipeline(spark):
    """Each stage on what its predecessor kept, against its operator's own decisions."""
    import corpus_pipeline as pipeline

    assert [name for name, _ in pipeline.STAGES] == ["quality", "exact_dedup", "near_dedup", "mixing", "packing"]
    docs, kept = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in pipeline.STAGES:
        before, docs = docs, written(stage(spark, docs, SF), f"test-{name}")
        if name != "packing":
            assert docs.columns == before.columns
            kept_rows = docs.distinct() if name == "mixing" else docs  # mixing repeats rows
            assert kept_rows.exceptAll(before).count() == 0
        kept.append(docs)
    quality, exact, near, mixed, packed = kept
    texts = [" ".join(r.text.split()) for r in exact.select("text").collect()]
    assert len(set(texts)) == len(texts) == len({" ".join(r.text.split()) for r in quality.select("text").collect()})
    assert near.count() < exact.count() and 0.4 * near.count() < mixed.distinct().count() < near.count()
    tokens = [frame.agg(F.sum(mixing.words(F.col("text")))).first()[0] for frame in (near, mixed)]
    assert abs(tokens[1] / tokens[0] - mixing.KEPT) < 0.1
    assert {r.doc_id for r in packed.select("doc_id").collect()} == {r.doc_id for r in mixed.select("doc_id").collect()}
    copies = {r.doc_id: r["count"] for r in mixed.groupBy("doc_id").count().collect()}
    assert packed.agg(F.sum("length")).first()[0] == sum(r.doc_tokens * copies[r.doc_id] for r in packed.select("doc_id", "doc_tokens").distinct().collect())


def test_pipeline_stages_on_odd_rows(docs, no_docs, spark):
    import corpus_pipeline as pipeline

    for name, stage in pipeline.STAGES:
        for frame in (docs, no_docs):
            stored = written(frame, "odd")
            out = written(stage(spark, stored, SF), "odd")
            assert name == "packing" or (out.columns == frame.columns and out.distinct().count() <= frame.count())
            assert name in ("mixing", "packing") or out.count() <= frame.count()


@pytest.mark.parametrize("stage", ["exact", "near"])
def test_a_column_named_like_the_number_stays(spark, stage):
    import corpus_pipeline as pipeline

    texts = [" ".join(f"w{k % 7}x{j}" for j in range(40)) for k in range(12)]
    frame = spark.createDataFrame([(k, t, "mine", "too") for k, t in enumerate(texts)], "doc_id long, text string, _row string, _ROW_ string")
    rows = getattr(pipeline, f"{stage}_dedup")(spark, frame, SF)
    assert rows.columns == frame.columns and {(r._row, r._ROW_) for r in rows.collect()} == {("mine", "too")} and rows.count() == 7


@pytest.mark.parametrize("stage", ["exact", "near"])
def test_rows_are_found_again_in_a_scan_split_anew(spark, monkeypatch, stage):
    """As when executors come or go between the operator's scan and the one that drops its rows."""
    import corpus_pipeline as pipeline

    texts = [f"{k} " * 20 + " ".join(f"w{k}x{j}" for j in range(40)) for k in range(40)]
    rows = [(k, texts[k % 40], "en", "src0", 1) for k in range(60)]
    stored = written(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(12), "split")
    operator, names = getattr(pipeline, f"{stage}_duplicates"), ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n) for n in names}

    def then_split_anew(*args, **options):
        found = operator(*args, **options)
        found = written(found, "found")
        for n in names:
            spark.conf.set(n, "16k")
        return found

    spark.conf.set(names[0], "1g")
    spark.conf.set(names[1], "64m")
    monkeypatch.setattr(pipeline, f"{stage}_duplicates", then_split_anew)
    try:
        kept = [r.doc_id for r in getattr(pipeline, f"{stage}_dedup")(spark, stored, SF).collect()]
    finally:
        for n, value in before.items():
            spark.conf.set(n, value)
    assert sorted(kept) == list(range(40))


def test_the_library_stands_without_this_subpackage():
    """No module outside names it, and the entry module imports where it is absent."""
    home = Path(queries.HOME)
    for file in (home / "ledgerflow").rglob("*.py"):
        if "llm" not in file.parts:
            assert "ledgerflow.llm" not in file.read_text()
    code = (
        "import sys, importlib.abc\n"
        "class Absent(importlib.abc.MetaPathFinder):\n"
        "    def find_spec(self, name, path=None, target=None):\n"
        "        if name in ('ledgerflow.llm', 'corpus_pipeline'):\n"
        "            raise ModuleNotFoundError(name, name=name)\n"
        "sys.meta_path.insert(0, Absent())\n"
        "import json, __spark_entry__ as e\n"
        "print(json.dumps(sorted(e.queries())))\n"
    )
    import subprocess

    said = subprocess.run([sys.executable, "-c", code], cwd=home, capture_output=True, text=True, check=True)
    names = json.loads(said.stdout.strip().splitlines()[-1])
    assert "load_customers" in names and not [n for n in names if n.startswith("op")]
