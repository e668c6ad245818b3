"""URL filter: given rules first, association rules mined from labelled urls for the rest.

A url is the set of its tokens: scheme, host labels, path words, query keys. Spark's
FP-growth finds the token combinations that are frequent among labelled urls. A
combination with enough support that says one label with enough confidence is a rule; it goes
where a part of it says the same label no less surely. Each rule is indexed under its rarest token
alone: a url looks its tokens up in the index and checks the few rules found there. The
surest rule that holds decides; of equally sure ones that with more support, then
the shorter, then the first by its tokens.

Mining takes a bounded sample of the labelled urls and, of each, its few most telling
tokens, so there are at most 2**TOKENS_A_URL / MIN_SUPPORT rules whatever the corpus holds.
Every url is judged, by all its tokens.
"""

from collections.abc import Sequence

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerflow.llm.store import bounded_sample, checked_broadcast, row_number, written

ALLOW, BLOCK = "allow", "block"
MOST_LABELLED = 100_000  # urls of each label that are mined
TOKENS_A_URL = 8  # tokens of a labelled url that are mined
MIN_SUPPORT = 0.01
MIN_CONFIDENCE = 0.8
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
HOST, PATH = r"(?s)^.*?://([^/?#]*)", r"(?s)^.*?://[^/?#]*([^?#]*)"


def host_of(url: Column) -> Column:
    """What is between the first ``://`` and the path, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, HOST, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PATH, 1), F.lit(""))


def given_rule(host: Column, path: Column, rules: Sequence[str]) -> Column:
    """The longest of ``rules`` ("host/path") that fits: its host or a subdomain, its path a prefix."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r), r)):
        own, slash, rest = rule.partition("/")
        fits = ((host == own) | F.endswith(host, F.lit("." + own))) & F.startswith(path, F.lit(slash + rest))
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def tokens_of(url: Column) -> Column:
    """The distinct tokens of a url; numbers are one token, a null url has none."""
    url = F.coalesce(url, F.lit(""))
    plain = F.translate(url, UPPER, LOWER)

    def marked(kind: str, words: Column) -> Column:
        named = F.filter(words, lambda w: w != "")
        return F.transform(named, lambda w: F.concat(F.lit(kind), F.when(F.regexp_like(w, F.lit("^[0-9]+$")), "#").otherwise(w)))

    return F.array_distinct(F.concat(
        marked("s:", F.array(F.regexp_extract(plain, r"(?s)^(.*?)://", 1))),
        marked("h:", F.split(host_of(url), "[.-]")),
        marked("p:", F.split(F.translate(path_of(url), UPPER, LOWER), "[/._-]")),
        marked("q:", F.regexp_extract_all(plain, F.lit(r"[?&]([^=&#]*)"), F.lit(1))),
        marked("f:", F.when(F.contains(plain, F.lit("#")), F.array(F.lit("fragment"))).otherwise(F.array().cast("array<string>"))),
    ))


RULES = "items array<string>, label string, confidence double, support double, key string"


def mined_rules(
    labelled: DataFrame, min_support: float = MIN_SUPPORT, min_confidence: float = MIN_CONFIDENCE,
    most_labelled: int = MOST_LABELLED, tokens_a_url: int = TOKENS_A_URL,
) -> DataFrame:
    """``items, label, confidence, support, key`` from ``labelled(id, url, label)``, a written table.

    At most ``most_labelled`` urls of each label are mined, those whose rows have the smallest
    hashes. A token that says nothing by itself, such as one that all urls have, is left out; of the
    others each url gives the ``tokens_a_url`` whose numbers in blocked urls differ most from the
    expected. Rows without a url or a label are not mined; no labelled row gives no rule.
    """
    spark = labelled.sparkSession
    rows = labelled.where("url is not null and label is not null").select("url", "label", F.xxhash64("id", "url").alias("print"))
    chosen = bounded_sample(rows, "label", "print", most_labelled).select(tokens_of(F.col("url")).alias("tokens"), "label")
    chosen = written(chosen.withColumn("row", row_number(None)), "labelled")
    total, blocked = chosen.agg(F.count(F.lit(1)), F.count_if(F.col("label") == BLOCK)).first()
    if not total:
        return spark.createDataFrame([], RULES)
    each = chosen.select("row", "label", F.explode("tokens").alias("token"))
    held = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("label") == BLOCK).alias("blocked"))
    telling = held.withColumn("tells", F.abs(F.col("blocked") * total - F.col("n") * blocked)).where("tells > 0")
    telling = written(telling.where(F.col("n") >= F.ceil(F.lit(min_support * total))), "tokens")
    order = Window.partitionBy("row").orderBy(F.desc("tells"), "token")
    mined = each.join(checked_broadcast(telling), "token").withColumn("place", F.row_number().over(order)).where(F.col("place") <= tokens_a_url)
    items = mined.groupBy("row", "label").agg(F.collect_list("token").alias("items"))
    # Urls without a telling token count as well, so support is a share of all.
    baskets = chosen.select("row", "label").join(items, ["row", "label"], "left").select(
        F.array_append(F.coalesce("items", F.array().cast("array<string>")), F.concat(F.lit("="), "label")).alias("items"))
    model = FPGrowth(minSupport=min_support, minConfidence=min_confidence).fit(written(baskets, "baskets"))
    found = model.associationRules.where("consequent[0] like '=%'").select(
        F.array_sort("antecedent").alias("items"), F.substring(F.col("consequent")[0], 2, 1000).alias("label"), "confidence", "support")
    found = written(found, "rules")
    return written(_indexed(_pruned(found), telling), "rules")


def _pruned(rules: DataFrame) -> DataFrame:
    """``rules`` without those of which a part says the same label no less surely."""
    part = rules.select(
        F.col("items").alias("part"), F.col("label").alias("part_label"), F.col("confidence").alias("part_confidence"),
        F.col("items")[0].alias("token"))
    inside = (F.size("part") < F.size("items")) & (F.size(F.array_except("part", "items")) == 0)
    surer = (F.col("part_label") == F.col("label")) & (F.col("part_confidence") >= F.col("confidence"))
    needless = rules.select("items", "label", "confidence", F.explode("items").alias("token")).join(part, "token").where(inside & surer)
    return rules.join(needless.select("items", "label").distinct(), ["items", "label"], "left_anti")


def _indexed(rules: DataFrame, held: DataFrame) -> DataFrame:
    """``rules`` with the rarest of their tokens as ``key``; ``held(token, n)``."""
    tokens = rules.select("items", "label", F.explode("items").alias("token")).join(held.select("token", "n"), "token")
    keys = tokens.groupBy("items", "label").agg(F.min(F.struct("n", "token"))["token"].alias("key"))
    return rules.join(keys, ["items", "label"]).select("items", "label", "confidence", "support", "key")


def judged(
    pages: DataFrame, given: dict[str, str], id_col: str = "page_id", url_col: str = "url", default: str = ALLOW, **mining,
) -> DataFrame:
    """``page_id, host, path, rule, verdict, confidence, items`` for every row of ``pages``.

    ``given`` maps a rule, "host/path", to its verdict. The urls that one fits are the labelled
    ones from which rules for all others are mined (``mining``: see ``mined_rules``). ``rule`` is the
    given rule that decided, else null; ``items`` the tokens of the mined one, else null. A url
    that neither fits gets ``default``, with null confidence. A null url, or one without
    ``://``, has an empty host and path; repeated rows and null ids are judged each by itself.
    Other columns may have any names.
    """
    rows = pages.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    rows = rows.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    rows = rows.withColumn("rule", given_rule(F.col("host"), F.col("path"), list(given)))
    label = F.lit(None).cast("string")
    for rule, verdict in given.items():
        label = F.when(F.col("rule") == rule, verdict).otherwise(label)
    rows = written(rows.withColumns({"label": label, "row": row_number(None)}), "urls")
    rules = checked_broadcast(mined_rules(rows.select("id", "url", "label"), **mining))

    open_ = F.when(F.col("rule").isNull(), tokens_of(F.col("url")))
    asked = rows.withColumn("tokens", open_).select("row", "id", "host", "path", "rule", F.col("label").alias("said"), "tokens", F.explode_outer("tokens").alias("key"))
    holds = F.size(F.array_except("items", "tokens")) == 0
    best = F.struct((-F.col("confidence")).alias("c"), (-F.col("support")).alias("s"), F.size("items").alias("n"), "items", "label", "confidence")
    found = asked.join(rules, "key", "left").groupBy("row", "id", "host", "path", "rule", "said").agg(F.min(F.when(holds, best)).alias("best"))
    return found.select(
        F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("said", "best.label", F.lit(default)).alias("verdict"),
        "best.confidence", "best.items")
