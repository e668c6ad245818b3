"""The operators over their whole tables, and the SQL that must give the same rows.

Each query is a thin call: it runs its operator with production parameters and
derives the columns of its contract. ``None`` stands where SQL can't express it.
"""

from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from ledgerflow.llm.exact_dedup import exact_duplicates
from ledgerflow.llm.filter_audit import audit, survivors
from ledgerflow.llm.langid import fit_languages, held_out, identify
from ledgerflow.llm.lattice import near_vectors
from ledgerflow.llm.lm import score
from ledgerflow.llm.minhash import near_duplicates
from ledgerflow.llm.mixing import fitting_sql, mixed
from ledgerflow.llm.packing import checksums, pack
from ledgerflow.llm.quality import fit_ratings, grades_of, rate
from ledgerflow.llm.search import ranked
from ledgerflow.llm.token_counts import token_counts
from ledgerflow.llm.url_rules import MIN_CONFIDENCE, MIN_SUPPORT, TOKENS_A_URL, judged
from ledgerflow.llm.warc import convert, read_warc, write_arc

HOME = str(Path(__file__).resolve().parents[2])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; Python workers started from now on find this package."""
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if HOME not in known.split(":"):
        spark.sparkContext.environment["PYTHONPATH"] = f"{HOME}:{known}".rstrip(":")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return checksums(pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")))


def op2_lattice(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors(table(spark, sf_dir, "embeddings")).select("vec_id", "n_links", "component_id", "kept")


# Shares of the training mix: smaller languages and long texts gain, short ones lose.
TARGETS = {
    "source": {"src0": 0.30} | {f"src{k}": 0.70 / 19 for k in range(1, 20)},
    "lang": {"en": 0.56, "de": 0.17, "fr": 0.16, "es": 0.11},
    "topic": {"brief": 0.03, "article": 0.47, "long": 0.50},
}


def op3_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = mixed(table(spark, sf_dir, "documents"), TARGETS, repeats=True).select("doc_id", "_mix.*")
    return found.select("doc_id", "source", "lang", "topic", "tokens", F.round("expected", 9).alias("expected"), "copies")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = identify(docs, fit_languages(docs.where(~held_out())))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score", "rejected")


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    warc = convert(spark, write_arc(table(spark, sf_dir, "pages")))
    return read_warc(spark, warc).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_duplicates(table(spark, sf_dir, "documents")).select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    remainder = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 7
    found = score(table(spark, sf_dir, "documents"), remainder == 2)
    return found.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


def quality_model(docs: DataFrame, spark: SparkSession, sf_dir: str):
    return fit_ratings(docs, grades_of(table(spark, sf_dir, "labels")))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return rate(docs, quality_model(docs, spark, sf_dir)).withColumn("kept", F.col("selected"))


OP2_SQL = """
with recursive vectors as (
  select vec_id, list_transform(embedding, lambda x: cast(x as double)) as e from embeddings
),
links as (
  select a.vec_id as a, b.vec_id as b from vectors a join vectors b on a.vec_id <> b.vec_id
  where list_cosine_similarity(a.e, b.e) >= 0.9
),
reached as (
  select vec_id, vec_id as other from embeddings
  union
  select vec_id, b as other from reached join links on other = a
)
select v.vec_id, coalesce(n, 0) as n_links, low as component_id, v.vec_id = low as kept
from embeddings v left join (select a, count(*) as n from links group by a) on a = v.vec_id
join (select vec_id, min(other) as low from reached group by vec_id) using (vec_id)
"""

OP7_SQL = r"""
with texts as (
  select doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') as plain from documents
)
select doc_id, min(doc_id) over same as keep_id, count(*) over same as group_size,
  doc_id = min(doc_id) over same as kept, sha256(plain) as text_sha256
from texts window same as (partition by plain)
"""

def op8_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


OP8_SQL = r"""
with recursive words as (
  select doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') as w
  from documents
),
shingles as (
  select distinct doc_id, unnest(case when len(w) = 0 then [] when len(w) < 3 then [array_to_string(w, ' ')]
    else list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) end) as g
  from words
),
sizes as (select doc_id, count(*) as n from shingles group by doc_id),
shared as (
  select x.doc_id as a, y.doc_id as b, count(*) as n
  from shingles x join shingles y on x.g = y.g and x.doc_id <> y.doc_id group by x.doc_id, y.doc_id
),
links as (
  select a, b from shared s join sizes p on a = p.doc_id join sizes q on b = q.doc_id
  where 100 * s.n >= 85 * (p.n + q.n - s.n)
),
reached as (
  select doc_id, doc_id as other from documents
  union
  select doc_id, b as other from reached join links on other = a
)
select d.doc_id, coalesce(n, 0) as n_shingles, low as component_id, d.doc_id = low as kept
from documents d left join sizes using (doc_id)
join (select doc_id, min(other) as low from reached group by doc_id) using (doc_id)
"""

# The longest rule that fits decides.
URL_RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}


def op11_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judged(table(spark, sf_dir, "pages"), URL_RULES).select("page_id", "host", "path", "rule", "verdict")


# Holds while the bounded sample takes all labelled urls: up to 100,000 of each label.
OP11_SQL = rf"""
with recursive parts as (
  select page_id, row_number() over () as id, translate(coalesce(url, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as plain,
    translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) as path
  from pages
),
given as (select unnest(['net', 'example.net', 'example.com', 'org']) as h, unnest(['/', '/en/', '/de/', '/fr/']) as p, unnest(['block', 'allow', 'block', 'allow']) as said),
ruled as (
  select id, max_by(h || p, length(h || p)) as rule, max_by(said, length(h || p)) as label
  from parts join given on (host = h or ends_with(host, '.' || h)) and starts_with(path, p) group by id
),
words as (
  select id, 's:' as kind, unnest([regexp_extract(plain, '(?s)^(.*?)://', 1)]) as word from parts
  union all select id, 'h:', unnest(regexp_split_to_array(host, '[.-]')) from parts
  union all select id, 'p:', unnest(regexp_split_to_array(translate(path, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[/._-]')) from parts
  union all select id, 'q:', unnest(regexp_extract_all(plain, '[?&]([^=&#]*)', 1)) from parts
  union all select id, 'f:', 'fragment' from parts where contains(plain, '#')
),
tokens as (select distinct id, kind || case when regexp_matches(word, '^[0-9]+$') then '#' else word end as token from words where word <> ''),
totals as (select count(*) as n, count(*) filter (label = 'block') as b from ruled),
least_count as (select cast(ceil({MIN_SUPPORT!r} * cast(n as double)) as bigint) as least from totals),
held as (
  select token, count(*) as n, abs(count(*) filter (label = 'block') * max(t.n) - count(*) * max(t.b)) as tells
  from tokens join ruled using (id), totals t group by token
),
telling as (select token, n, tells from held, least_count where tells > 0 and n >= least),
mined as (
  select id, token, label from tokens join ruled using (id) join telling using (token)
  qualify row_number() over (partition by id order by tells desc, token) <= {TOKENS_A_URL}
),
sets as (
  select [token] as items, list(id) as ids from mined group by token having count(*) >= (select least from least_count)
  union all
  select list_append(items, token), list_intersect(ids, own)
  from sets join (select token, list(id) as own from mined group by token) on token > items[-1]
  where len(list_intersect(ids, own)) >= (select least from least_count)
),
said as (select items, len(ids) as n, label, len(list_filter(ids, lambda i: list_contains(named, i))) as m
  from sets, (select label, list(id) as named from ruled group by label)),
rules as (
  select items, label, cast(m as double) / n as confidence, cast(m as double) / (select n from totals) as support
  from said where m >= (select least from least_count) and cast(m as double) / n >= {MIN_CONFIDENCE!r}
),
pruned as (
  select * from rules r where not exists (select 1 from rules q where q.label = r.label and len(q.items) < len(r.items)
    and list_has_all(r.items, q.items) and q.confidence >= r.confidence)
),
sets_of as (select id, list(token) as own from tokens group by id),
decided as (
  select id, label from sets_of s join pruned r on list_has_all(own, items)
  qualify row_number() over (partition by id order by confidence desc, support desc, len(items), items) = 1
)
select page_id, host, path, rule, coalesce(r.label, d.label, 'allow') as verdict
from parts left join ruled r using (id) left join decided d using (id)
"""


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(survivors(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")))


OP12_SQL = r"""
with texts as (
  select doc_id, coalesce(source, '') as part, coalesce(text, '') as t,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w,
    doc_id > min(doc_id) over (partition by coalesce(text, '')) as repeated
  from documents
),
failures as (
  select part, doc_id in (select doc_id from labels where quality = 1) as good, doc_id in (select doc_id from labels where toxic = 1) as toxic,
    cast(len(w) < 50 as int) + 2 * cast(100 * len(list_distinct(w)) < 65 * len(w) as int)
    + 4 * cast(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) as int)
    + 8 * cast(regexp_matches(t, '[#$%&*|]') as int) + 16 * cast(repeated as int) as f
  from texts
),
counts as (select part, f, count(*) as n, count(*) filter (good) as g, count(*) filter (toxic) as x from failures group by all),
filters as (select unnest(['A', 'B', 'C', 'D', 'E']) as letter, unnest([1, 2, 4, 8, 16]) as bit),
steps as (
  select a.letter || b.letter || c.letter || d.letter || e.letter as filter_order, unnest([1, 2, 3, 4, 5]) as step,
    unnest([a.bit, b.bit, c.bit, d.bit, e.bit]) as bit,
    unnest([0, a.bit, a.bit + b.bit, a.bit + b.bit + c.bit, a.bit + b.bit + c.bit + d.bit]) as before
  from filters a, filters b, filters c, filters d, filters e where a.bit | b.bit | c.bit | d.bit | e.bit = 31
),
found as (
  select part, filter_order, step, bit, coalesce(sum(n) filter (f & (before | bit) = 0), 0) as kept,
    coalesce(sum(n) filter (f & before = 0 and f & bit > 0), 0) as removed,
    coalesce(sum(n) filter (f & before > 0 and f & bit > 0), 0) as redundant,
    coalesce(sum(n) filter (f = bit), 0) as unique_fails,
    coalesce(sum(g) filter (f & before = 0 and f & bit > 0), 0) as good_lost,
    coalesce(sum(x) filter (f & before = 0 and f & bit > 0), 0) as toxic_lost
  from counts, steps group by all
)
select part, filter_order, step, cast(kept as bigint) as kept, cast(removed as bigint) as removed, cast(redundant as bigint) as redundant,
  cast(unique_fails as bigint) as unique_fails, cast(good_lost as bigint) as good_lost, cast(toxic_lost as bigint) as toxic_lost,
  cast(sum(removed) over (partition by part, bit) as bigint) as shapley
from found
"""


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP13_SQL = r"""
with words as (
  select doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
  from documents
),
asked as (
  select item_id, term, count(*) as times from (
    select item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) as term
    from benchmark
  ) group by all
),
sizes as (select doc_id, count(*) as n from words group by doc_id),
whole as (select count(*) as docs, cast(sum(n) as bigint) as length from sizes),
postings as (select term, doc_id, count(*) as tf from words where term in (select term from asked) group by all),
weights as (select term, cast(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) as bigint) as w from postings, whole group by term),
scored as (
  select item_id, doc_id, cast(sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * docs) // length)))) as bigint) as score
  from asked join postings using (term) join weights using (term) join sizes using (doc_id), whole group by all
),
placed as (select *, cast(row_number() over (partition by item_id order by score desc, doc_id) as int) as rank from scored where score > 0)
select item_id, rank, doc_id, score from placed where rank <= 10
"""

QUERIES: dict[str, tuple[Callable[[SparkSession, str], DataFrame], str | None]] = {
    "op1_packing": (op1_packing, None),
    "op2_lattice": (op2_lattice, OP2_SQL),
    "op3_mixing": (op3_mixing, fitting_sql(TARGETS)),
    "op4_language_id": (op4_language_id, None),
    "op5_token_counts": (op5_token_counts, None),
    "op6_warc": (op6_warc, None),
    "op7_exact_dedup": (op7_exact_dedup, OP7_SQL),
    "op8_minhash": (op8_minhash, OP8_SQL),
    "op9_lm_scoring": (op9_lm_scoring, None),
    "op10_quality": (op10_quality, None),
    "op11_url_rules": (op11_url_rules, OP11_SQL),
    "op12_filter_audit": (op12_filter_audit, OP12_SQL),
    "op13_search": (op13_search, OP13_SQL),
}
