"""Mixing to target weights by iterative proportional fitting, in DataFrame functions only.

Token weights of the cells source x language x topic are raked to the target shares of
each of the three marginals in turn, until all hold. A document's expected copies are its
cell's ratio of fitted to natural weight, calibrated so that the sample has a given share of
all tokens: as many copies as the whole part says, and one more with the probability of the
rest. So the sample has the target shares, also where a cell would have to give more than
it has. Without repeats a document is kept at most once: such a cell is kept whole, the
others make up for it, and it stays below its target. A document's draw depends on its id alone.

Values without a target of their own form one group that keeps its natural share, so
the number of cells is bounded by the targets given, whatever the corpus holds.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from ledgerflow.llm.store import written

OTHER = "(other)"
ROUNDS = 10
KEPT = 1.0  # tokens in the sample, as a share of all: what is at its target share comes once
KEPT_ONCE = 0.75  # the same without repeats, where it has to be less than all
ROUNDS_A_TABLE = 5  # the plan of so many rounds is run before the next is built on its result
MOST_CELLS = 100_000
WORD = r"[^\x20\x09-\x0D]+"

# The tables hold no topic; the form of a text stands for it.
TOPICS = "case when {words} < 100 then 'brief' when {words} < 1000 then 'article' else 'long' end"


def words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def listed(value: Column, targets: dict[str, float]) -> Column:
    return F.when(value.isin(*targets), value).otherwise(OTHER)


CELL = ("source", "lang", "topic")


def with_share(cells: DataFrame, name: str, targets: dict[str, float]) -> DataFrame:
    """``cells`` with the target share of each cell's value of ``name``.

    Listed values that occur divide what the others leave, in proportion.
    """
    everything = Window.partitionBy(F.lit(0))
    target = F.create_map(*[F.lit(x) for item in targets.items() for x in (item[0], float(item[1]))])[F.col(name)]
    rest = F.coalesce(F.sum(F.when(F.col(name) == OTHER, F.col("natural"))).over(everything), F.lit(0.0))
    first = F.row_number().over(Window.partitionBy(name).orderBy(*CELL)) == 1  # each value's target counts once
    cells = cells.withColumns({"_target": target, "_rest": rest, "_first": first})
    given = F.sum(F.when(F.col("_first"), F.col("_target"))).over(everything)
    share = F.when(F.col(name) == OTHER, F.col("_rest")).otherwise(F.try_divide("_target", given) * (1 - F.col("_rest")))
    return cells.withColumn(f"{name}_share", share).drop("_target", "_rest", "_first")


def calibrated(cells: DataFrame, kept: float) -> DataFrame:
    """``cells`` with the probability min(1, k * ratio), k such that ``kept`` of all weight is kept.

    In descending order of the ratios, each cell says what k would be if exactly those
    before it were kept whole; the first that k doesn't take beyond 1 is right.
    """
    cells = cells.withColumn("_ratio", F.col("fitted") / F.col("natural"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("_ratio"), *CELL)
    everything = Window.partitionBy(F.lit(0))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    whole, taken = (F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in ("natural", "fitted"))
    cells = cells.withColumn("_scale", F.try_divide(kept - whole, F.sum("fitted").over(everything) - taken))
    cells = cells.withColumn("_scale", F.when(F.col("_scale") * F.col("_ratio") <= 1, F.col("_scale")))
    cells = cells.withColumn("_rank", F.when(F.col("_scale").isNotNull(), F.row_number().over(order)))
    first = F.min_by("_scale", "_rank").over(everything)
    chance = F.least(F.lit(1.0), F.coalesce(first * F.col("_ratio"), F.lit(1.0)))
    return cells.withColumn("probability", chance).drop("_ratio", "_scale", "_rank")


def fitted_cells(tokens: DataFrame, targets: dict[str, dict[str, float]], rounds: int = ROUNDS, kept: float = KEPT_ONCE) -> DataFrame:
    """``source, lang, topic, natural, fitted, probability`` from ``source, lang, topic, tokens``.

    The number of cells is at most the product of the targets' sizes, so the rounds
    run in one task on the summed cells.
    """
    bound = 1
    for name in CELL:
        bound *= len(targets[name]) + 1
    if bound > MOST_CELLS:
        raise ValueError(f"targets make up to {bound} cells, more than {MOST_CELLS}")
    everything = Window.partitionBy(F.lit(0))
    cells = tokens.groupBy(*CELL).agg(F.sum("tokens").alias("tokens")).where("tokens > 0").repartition(1)
    cells = cells.withColumn("natural", F.col("tokens") / F.sum("tokens").over(everything))
    for name in CELL:
        cells = with_share(cells, name, targets[name])
    cells = written(cells.withColumn("fitted", F.col("natural")), "cells").repartition(1)
    for round_ in range(1, rounds + 1):
        for name in CELL:
            now = F.sum("fitted").over(Window.partitionBy(name))
            cells = cells.withColumn("fitted", F.when(now > 0, F.col("fitted") * F.col(f"{name}_share") / now).otherwise(F.lit(0.0)))
        if round_ % ROUNDS_A_TABLE == 0 or round_ == rounds:
            cells = written(cells, "cells").repartition(1)
    return calibrated(cells, kept).select(*CELL, "natural", "fitted", "probability")


def draw(key: Column) -> Column:
    """A number from 0 to below 1 that depends on the key alone."""
    return F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") / float(1 << 52)


def mixed(
    docs: DataFrame, targets: dict[str, dict[str, float]], id_col: str = "doc_id", text_col: str = "text",
    source: str = "source", lang: str = "lang", topic: str = TOPICS, rounds: int = ROUNDS, kept: float | None = None,
    repeats: bool = False,
) -> DataFrame:
    """All rows and columns of ``docs`` and a struct ``_mix(source, lang, topic, tokens, probability, sampled)``.

    ``tokens`` counts a text's words. Null values and values without target count as
    ``(other)``; a null text has no words. A document without words belongs to its cell
    all the same; in a cell without any words it is kept. Rows with the same id are
    kept or dropped together; a null id draws by its text. ``docs`` may hold columns
    of any names but ``_mix`` and such as begin with ``_cell_``.

    With ``repeats`` the struct also has ``expected``, which is ``kept`` times the cell's ratio of
    fitted to natural weight, and ``copies``: how often the row is in a sample of ``kept``
    of all tokens in which the target shares hold, a whole number with that expectation.
    ``kept`` is KEPT with repeats and KEPT_ONCE without, if not given.
    """
    kept = (KEPT if repeats else KEPT_ONCE) if kept is None else kept
    text = F.col(text_col)
    with_words = docs.withColumn("_mix", F.struct(words(text).alias("tokens")))
    topic_value = F.expr(topic.format(words="_mix.tokens"))
    keyed = with_words.withColumn("_mix", F.struct(
        listed(F.col(source), targets["source"]).alias("source"), listed(F.col(lang), targets["lang"]).alias("lang"),
        listed(topic_value, targets["topic"]).alias("topic"), F.col("_mix.tokens").alias("tokens"),
    ))
    cells = fitted_cells(keyed.select("_mix.*"), targets, rounds, kept)
    cell = cells.select(*[F.col(c).alias(f"_cell_{c}") for c in CELL], F.col("probability").alias("_cell_probability"),
                         (F.col("fitted") / F.col("natural") * kept).alias("_cell_expected"))
    on = reduce(lambda a, b: a & b, [F.col(f"_mix.{c}") == F.col(f"_cell_{c}") for c in CELL])
    joined = keyed.join(F.broadcast(cell), on, "left")  # at most MOST_CELLS rows
    chance = F.coalesce("_cell_probability", F.lit(1.0))
    key = F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("text:"), F.coalesce(text, F.lit(""))))
    drawn = [chance.alias("probability"), (draw(key) < chance).alias("sampled")]
    if repeats:
        expected = F.coalesce("_cell_expected", F.lit(1.0))
        more = draw(key) < expected - F.floor(expected)
        drawn += [expected.alias("expected"), (F.floor(expected) + more.cast("long")).alias("copies")]
    return joined.withColumn("_mix", F.struct("_mix.*", *drawn)).drop(*cell.columns)


def sampled(docs: DataFrame, targets: dict[str, dict[str, float]], **columns) -> DataFrame:
    """The rows that ``mixed`` keeps, with the columns of ``docs``."""
    return mixed(docs, targets, **columns).where("_mix.sampled").drop("_mix")


def repeated(docs: DataFrame, targets: dict[str, dict[str, float]], **columns) -> DataFrame:
    """Each row of ``docs`` as often as ``mixed`` says with ``repeats``, with the columns of ``docs``."""
    found = mixed(docs, targets, repeats=True, **columns).where("_mix.copies > 0")
    return found.withColumn("_mix", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_mix.copies")))).drop("_mix")


def fitting_sql(targets: dict[str, dict[str, float]], rounds: int = ROUNDS, kept: float = KEPT) -> str:
    """DuckDB SQL for the expected and drawn copies of ``mixed`` over ``documents``."""
    def quoted(values) -> str:
        return ", ".join(f"'{v}'" for v in values)

    def share(name: str) -> str:
        whens = " ".join(f"when '{v}' then cast({float(t)!r} as double)" for v, t in targets[name].items())
        return f"""(with v as (select {name} as value, sum(weight) as own, case {name} {whens} end as target from cells group by {name}),
          r as (select coalesce(sum(own) filter (value = '{OTHER}'), 0) as rest, sum(target) as given from v)
          select value, case when value = '{OTHER}' then rest else target / given * (1 - rest) end as share from v, r)"""

    keys = ", ".join(f"case when {n} in ({quoted(targets[n])}) then {n} else '{OTHER}' end as {n}" for n in CELL)
    steps, last = [], "started"
    for k in range(rounds):
        for name in CELL:
            steps.append(f"f{k}_{name} as (select * replace (case when sum(fitted) over w > 0 then fitted * {name}_share / sum(fitted) over w else 0 end as fitted) from {last} window w as (partition by {name}))")
            last = f"f{k}_{name}"
    return f"""
with counted as (
  select doc_id, source, lang, len(regexp_extract_all(coalesce(text, ''), '{WORD}')) as tokens from documents
),
topical as (select *, {TOPICS.format(words='tokens')} as topic from counted),
keyed as (select doc_id, tokens, {keys} from topical),
cells as (
  select {", ".join(CELL)}, sum(tokens) / sum(sum(tokens)) over () as weight from keyed group by all having sum(tokens) > 0
),
started as (
  select c.*, s.share as source_share, l.share as lang_share, t.share as topic_share, weight as fitted
  from cells c join {share('source')} s on source = s.value join {share('lang')} l on lang = l.value join {share('topic')} t on topic = t.value
),
{", ".join(steps)},
final as (select {", ".join(CELL)}, {kept!r} * fitted / weight as expected from {last}),
drawn as (
  select doc_id, source, lang, topic, tokens, coalesce(expected, 1) as e,
    cast(('0x' || substr(md5(cast(doc_id as varchar)), 1, 13)) as bigint) / 4503599627370496 as draw
  from keyed left join final using (source, lang, topic)
)
select doc_id, source, lang, topic, tokens, round(e, 9) as expected, cast(floor(e) as bigint) + cast(draw < e - floor(e) as bigint) as copies
from drawn
"""
