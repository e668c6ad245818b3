"""Url rules, the filter audit and ranked search, against plain Python and SQL."""

import math
import re
from collections import Counter
from itertools import combinations, permutations

import numpy as np
import pytest
from llm_corpus import clashing, corpus, docs, lower, no_docs, prose  # noqa: F401

from ledgerflow.llm import filter_audit, search, url_rules

SF = "/root/testdata/sf0.01"


# Url rules

GIVEN = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}

ODD_URLS = [
    None, "", "no scheme", "http://", "://", "http://net", "http://net/", "http://NET/x", "http://a.NET/x", "http://anet/x", "http://example.net/en", "http://example.net/en/",
    "HTTP://X.Example.NET/en/1", "http://x.example.net/EN/1", "http://example.com/de/", "http://notexample.com/de/1", "http://a.b.org/fr/?q#f", "http://org?x/fr/",
    "http://a.org#/fr/", "http://a.net/x://b.org/fr/", "a\nb://c.net/\nd?e", "http://ü.net/ß", "http://a.net/" + "long/" * 20_000, "x://y.net/%zz?a=b&a=c&&=d#?e",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.split(r"[/?#]", rest, maxsplit=1)[0]
    return lower(host), re.split(r"[?#]", rest[len(host):], maxsplit=1)[0]


def fitting(url, given=GIVEN):
    host, path = parts(url)
    fits = []
    for rule in given:
        own, _, rest = rule.partition("/")
        if (host == own or host.endswith("." + own)) and path.startswith("/" + rest):
            fits.append(rule)
    return max(fits, key=len, default=None)


def tokens(url):
    if url is None:
        return set()
    host, path = parts(url)
    plain = lower(url)
    words = [("s:", [plain.split("://", 1)[0]] if "://" in plain else []), ("h:", re.split("[.-]", host)), ("p:", re.split("[/._-]", lower(path))),
             ("q:", re.findall("[?&]([^=&#]*)", plain)), ("f:", ["fragment"] if "#" in plain else [])]
    return {kind + ("#" if re.fullmatch("[0-9]+", w) else w) for kind, own in words for w in own if w}


def mined(labelled, min_support, min_confidence, tokens_a_url):
    """Association rules by trying every combination of each url's tokens."""
    least = math.ceil(min_support * len(labelled))
    blocked = sum(label == "block" for _, label in labelled)
    n, b = Counter(), Counter()
    for url, label in labelled:
        n.update(tokens(url))
        b.update(tokens(url) if label == "block" else ())
    tells = {t: abs(b[t] * len(labelled) - n[t] * blocked) for t in n if n[t] >= least}
    both, alone = Counter(), Counter()
    for url, label in labelled:
        own = sorted((t for t in tokens(url) if tells.get(t)), key=lambda t: (-tells[t], t))[:tokens_a_url]
        for size in range(1, len(own) + 1):
            for items in combinations(sorted(own), size):
                both[items, label] += 1
                alone[items] += 1
    rules = {(items, label): (m / alone[items], m / len(labelled)) for (items, label), m in both.items() if m >= least and m / alone[items] >= min_confidence}
    return {k: v for k, v in rules.items() if not any(
        q != k[0] and label == k[1] and set(q) < set(k[0]) and conf >= v[0] for (q, label), (conf, _) in rules.items())}


def test_odd_urls_are_judged(spark):
    rows = [(k, u, "html") for k, u in enumerate(ODD_URLS)] + [(None, "http://a.org/fr/", None), (0, "http://a.net/", None), (0, "http://a.net/", None)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    found = url_rules.judged(pages, GIVEN, min_support=0.3)
    got = Counter((r.page_id, r.host, r.path, r.rule) for r in found.collect())
    assert got == Counter((k, *parts(u), fitting(u)) for k, u, _ in rows)
    assert {r.verdict for r in found.where("rule is not null").collect()} == {"allow", "block"}
    assert all(r.verdict == GIVEN[r.rule] for r in found.where("rule is not null").collect())


def test_no_urls_no_labels_one_label(spark):
    none = spark.createDataFrame([], "page_id long, url string, html string")
    assert url_rules.judged(none, GIVEN).count() == 0
    free = spark.createDataFrame([(1, "http://a.com/x"), (2, None)], "page_id long, url string")
    assert {(r.page_id, r.verdict, r.rule) for r in url_rules.judged(free, GIVEN).collect()} == {(1, "allow", None), (2, "allow", None)}
    one = spark.createDataFrame([(k, f"http://{h}/x") for k, h in enumerate(["a.net", "b.net", "c.com"])], "page_id long, url string")
    assert {r.verdict for r in url_rules.judged(one, GIVEN).where("page_id < 2").collect()} == {"block"}


@pytest.mark.parametrize("support, confidence, most", [(0.02, 0.8, 8), (0.1, 0.6, 4), (0.05, 1.0, 3)])
def test_rules_are_those_of_all_combinations(spark, support, confidence, most):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id < 700")
    labelled = [(r.page_id, r.url, GIVEN[fitting(r.url)] if r.page_id % 9 else "block") for r in pages.collect() if fitting(r.url)]
    frame = spark.createDataFrame(labelled, "id long, url string, label string")
    found = {(tuple(r["items"]), r.label): (r.confidence, r.support) for r in url_rules.mined_rules(frame, support, confidence, tokens_a_url=most).collect()}
    want = mined([(u, label) for _, u, label in labelled], support, confidence, most)
    assert found == want and len(want) > 1


def test_the_surest_mined_rule_decides(spark):
    """Against a search of all rules; with rules of several tokens."""
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet").where("page_id < 900")
    given = {"example.net/en/": "allow", "example.net/fr/": "block", "example.org/en/": "block", "example.org/fr/": "allow", "example.com/es/": "block"}
    rows = pages.collect()
    rules = mined([(r.url, given[fitting(r.url, given)]) for r in rows if fitting(r.url, given)], 0.01, 0.8, 8)
    assert any(len(items) > 1 for items, _ in rules)

    def verdict(url):
        if rule := fitting(url, given):
            return given[rule]
        holding = [(-c, -s, len(items), list(items), label) for (items, label), (c, s) in rules.items() if set(items) <= tokens(url)]
        return min(holding)[4] if holding else "allow"

    got = {r.page_id: r.verdict for r in url_rules.judged(pages, given).collect()}
    assert got == {r.page_id: verdict(r.url) for r in rows}


# Filter audit

def test_positional_counts():
    rng = np.random.default_rng(5)
    for n in (0, 1, 2, 3, 4, 7, 100, 12_345):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint64).astype(np.uint32)
        want = [int(((words >> np.uint32(k)) & np.uint32(1)).sum()) for k in range(32)]
        assert filter_audit.positional_counts(words).tolist() == want


def failed(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return "".join(letter for letter, bad in zip("ABCD", [
        len(words) < 50, 100 * len(set(words)) < 65 * len(words),
        100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text))]) if bad)


def audited(rows, labels):
    """Every order run one filter after the other."""
    ids = {}
    for doc_id, text, *_ in rows:
        if doc_id is not None:
            ids.setdefault(text or "", set()).add(doc_id)
    good = {d for d, q, _ in labels if q == 1 and d is not None}
    toxic = {d for d, _, t in labels if t == 1 and d is not None}
    own = []
    for doc_id, text, _, source, _ in rows:
        least = min(ids.get(text or "", ()), default=None)
        again = least is not None and (doc_id is None or least < doc_id)
        own.append((source or "", set(failed(text or "")) | ({"E"} if again else set()), doc_id in good, doc_id in toxic))
    out, totals = {}, Counter()
    for part in {o[0] for o in own}:
        mine = [o for o in own if o[0] == part]
        for order in permutations("ABCDE"):
            kept = mine
            for step, letter in enumerate(order, start=1):
                gone = [o for o in kept if letter in o[1]]
                kept = [o for o in kept if letter not in o[1]]
                fails = sum(letter in o[1] for o in mine)
                out[part, "".join(order), step] = (
                    len(kept), len(gone), fails - len(gone), sum(o[1] == {letter} for o in mine), sum(o[2] for o in gone), sum(o[3] for o in gone))
                totals[part, letter] += len(gone)
    return {k: (*v, totals[k[0], k[1][k[2] - 1]]) for k, v in out.items()}


MORE = [
    (900, "Many Capital Words " * 40, "en", "src1", 1), (901, " ".join(f"w{k}" for k in range(60)), "en", "src1", 1), (899, " ".join(f"w{k}" for k in range(60)), "en", "src2", 1),
    (902, " ".join(f"w{k}" for k in range(60)) + " 5 %", "en", "src1", 1), (902, " ".join(f"w{k}" for k in range(60)), "en", "src1", 1), (903, " ".join(f"É{k} ü" for k in range(90)), "en", None, 1),
    (904, "x" * 600_000 + " y" * 400_000, "en", "src1", 1),
]


def test_audit_of_odd_texts(spark, docs):
    rows = corpus() + MORE
    labels = [(k, k % 2, int(k % 3 == 0)) for k in range(60)] + [(901, 0, 0), (901, 1, None), (902, 1, 1), (None, 1, 1), (899, None, 1)]
    given = clashing(spark.createDataFrame(rows, docs.schema))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = filter_audit.audit(filter_audit.survivors(given, clashing(table)))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    got = {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in found.collect()}
    assert got == audited(rows, labels)


def test_audit_of_nothing(no_docs, spark):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert filter_audit.audit(filter_audit.survivors(no_docs, labels)).count() == 0


def test_audit_of_frequent_and_rare_copies(spark, monkeypatch):
    """With the bounds of broadcasts lowered, so that copies go through the joins."""
    from ledgerflow.llm import store
    monkeypatch.setattr(filter_audit, "MOST_HOT", 4)
    monkeypatch.setattr(store, "MOST_BROADCAST_KEYS", 3)
    rows = [(k if k % 50 else None, "the same text" if k % 3 == 0 else f"text {k % 40}", "en", f"src{k % 3}", 1) for k in range(300)]
    given = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").repartition(5)
    labels = [(k, 1, int(k % 4 == 0)) for k in range(0, 300, 2)]
    found = filter_audit.audit(filter_audit.survivors(given, spark.createDataFrame(labels, "doc_id long, quality int, toxic int")))
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    assert {(r.part, r.filter_order, r.step): tuple(r[n] for n in names) for r in found.collect()} == audited(rows, labels)


# Search

def terms(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def best(rows, items, top=10):
    """(item, rank, doc_id, score) by scoring every document."""
    held = [(doc_id, Counter(terms(text))) for doc_id, text in rows]
    held = [(doc_id, c, sum(c.values())) for doc_id, c in held if c]
    n_docs, length = len(held), sum(n for *_, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    weight = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * k + 1))) for t, k in df.items()}
    out = []
    for item, text in items:
        scored = []
        for doc_id, c, n in held:
            m = 100 - 75 + (75 * n * n_docs) // length
            score = sum(times * weight[t] * ((1_000_000_000 * c[t]) // (1000 * c[t] + 8 * m)) for t, times in Counter(terms(text)).items() if t in c)
            if score > 0:
                scored.append((-score, doc_id is None, doc_id or 0, doc_id))
        out += [(item, k, s[3], -s[0]) for k, s in enumerate(sorted(scored)[:top], start=1)]
    return Counter(out)


def got(found):
    return Counter((r.item_id, r["rank"], r.doc_id, r.score) for r in found.collect())


ITEMS = [(1, prose(3, 30)), (1, "horse river"), (2, None), (3, ""), (4, "%%% ---"), (None, "NIGHT naïve 日本語 İstanbul"), (5, "absent terms only"), (6, "the the the " + prose(9, 60)), (7, "word " * 50), (8, "é combining")]


def test_search_of_odd_texts(spark, docs):
    rows = [(r[0], r[1]) for r in corpus()]
    items = clashing(spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert got(search.ranked(clashing(docs), items)) == best(rows, ITEMS)
    assert got(search.ranked(docs, items, top=3)) == best(rows, ITEMS, 3)


def test_search_in_several_passes(spark, docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    assert got(search.ranked(docs, items, most_entries=20)) == best([(r[0], r[1]) for r in corpus()], ITEMS)


def test_search_of_nothing(spark, docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert search.ranked(no_docs, items).count() == 0 == search.ranked(docs, none).count()
    assert search.ranked(docs, none).columns == ["item_id", "rank", "doc_id", "score"]


def test_ties_and_large_blocks(spark, monkeypatch):
    """Thousands of documents, many equal ones, small blocks and shards; whole texts count."""
    monkeypatch.setattr(search, "BLOCK", 8)
    rows = [(k, prose(k % 700, 10 + k % 40) + (" rare" if k % 97 == 0 else "")) for k in range(3000)] + [(5000, "filler " * 200_000 + "rare")]
    items = [(k, prose(k, 12)) for k in range(20)] + [(99, "rare"), (98, "rare horse rare")]
    given = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = search.ranked(given, spark.createDataFrame(items, "item_id long, text string"))
    assert got(found) == best(rows, items)


def test_blocks_are_skipped_and_nothing_is_lost(spark):
    """In a shard of real documents: each skipped block holds no better document."""
    texts = [r.text for r in spark.read.parquet(f"{SF}/documents.parquet").sort("doc_id").collect()]
    asked = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    codes = {t: k for k, t in enumerate(sorted({t for a in asked for t in terms(a)}))}
    own = [Counter(codes[t] for t in terms(text or "") if t in codes) for text in texts]
    n = np.array([len(terms(text or "")) for text in texts])
    offsets = np.cumsum([0, *map(len, own)])
    flat = [pair for c in own for pair in sorted(c.items())]
    holders = np.bincount([t for t, _ in flat], minlength=len(codes))
    weight = search.weights(holders, len(texts))
    shard = search.Shard(n, offsets, np.array([t for t, _ in flat]), np.array([x for _, x in flat]), weight, len(texts), int(n.sum()))
    counts = [Counter(codes[t] for t in terms(a)) for a in asked]
    pairs = [pair for c in counts for pair in sorted(c.items())]
    given = search.Queries(np.cumsum([0, *map(len, counts)]), np.array([t for t, _ in pairs]), np.array([x for _, x in pairs]), len(codes))
    whole, _, _ = search.best_of(shard, given, weight, np.zeros(len(asked)), np.arange(len(texts)), top=len(texts))
    reach = np.array([s[9] for s, _ in whole])
    found, tried, skipped = search.best_of(shard, given, weight, reach, np.arange(len(texts)))
    assert skipped > tried / 10
    for (score, doc), (every, of) in zip(found, whole):
        assert score.tolist() == every[:10].tolist() and doc.tolist() == of[:10].tolist()
