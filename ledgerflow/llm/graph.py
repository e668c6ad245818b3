"""Connected components of a table of links."""

from pyspark.sql import DataFrame, functions as F

from ledgerflow.llm.store import SALTS, written


def components(links: DataFrame) -> DataFrame:
    """``node, component`` for every node of ``links(a, b)``; the component is its smallest node.

    Each round points every node at its smallest neighbour, follows the pointers
    twice and replaces the links by those between the nodes pointed at, until none
    is left: a logarithmic number of rounds in practice, each written to shared
    storage. Links of a node to itself count as nodes without partners.
    """
    named = written(links.select("a", "b").distinct(), "links")
    labels = named.select(F.explode(F.array("a", "b")).alias("node")).distinct().withColumn("component", F.col("node"))
    left = named.where("a <> b")
    while not left.isEmpty():
        both = left.select("a", "b").union(left.select("b", "a"))
        parents = written(both.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("b")), "parents")
        for _ in range(2):
            onward = parents.select(F.col("a").alias("b"), F.col("b").alias("c"))
            parents = written(parents.join(onward, "b").select("a", F.col("c").alias("b")), "parents")
        new = parents.select(F.col("a").alias("component"), F.col("b").alias("new"))
        labels = written(labels.join(new, "component", "left").select("node", F.coalesce("new", "component").alias("component")), "labels")
        a, b = (parents.select(F.col("a").alias(k), F.col("b").alias(f"new_{k}")) for k in ("a", "b"))
        left = written(
            left.join(a, "a").join(b, "b")
            .select(F.least("new_a", "new_b").alias("a"), F.greatest("new_a", "new_b").alias("b")).where("a <> b").distinct(),
            "links",
        )
    return labels


def labelled(rows: DataFrame, heads: DataFrame, groups: DataFrame) -> DataFrame:
    """Every row with its component's smallest id and whether it stays.

    ``rows(row, doc_id, print, ...)`` are equal where their prints are; a null print
    is equal to none. ``heads(print, head, copies, ...)`` names one row of each print,
    ``groups(row, component)`` the components of heads that have links. The result has
    the columns of ``rows`` but the print, further columns of ``heads`` where a row isn't
    alone, ``component_id`` and ``kept``: true for the row with the smallest id, null ids
    last, and for one row of several with that id. Rows of one group are spread.
    """
    further = [c for c in heads.columns if c not in ("print", "head", "copies")]
    of_head = heads.join(groups.withColumnRenamed("row", "head"), "head", "left").select(
        "print", F.coalesce("component", "head").alias("component"), "copies", *further)
    sizes = of_head.groupBy("component").agg(F.sum("copies").alias("size")).where("size > 1")
    joined = of_head.join(sizes, "component").select(F.col("print").alias("of"), "component", *further)
    salts = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt_of")
    spread = joined.select("*", salts)
    salted = rows.withColumn("salt", F.pmod(F.xxhash64("row"), F.lit(SALTS)).cast("int"))
    found = written(
        salted.join(spread, (salted["print"] == spread["of"]) & (salted["salt"] == spread["salt_of"]), "left").drop("print", "of", "salt_of"),
        "rows",
    )
    first = F.struct(F.col("doc_id").isNull().alias("missing"), "doc_id", "row")
    best = found.where("component is not null").groupBy("component").agg(F.min(first).alias("best"))
    spread = best.select(F.col("component").alias("of"), "best", salts)
    out = found.join(spread, (found["component"] == spread["of"]) & (found["salt"] == spread["salt_of"]), "left")
    alone = F.col("best").isNull()
    return out.withColumns({
        "component_id": F.when(alone, F.col("doc_id")).otherwise(F.col("best.doc_id")), "kept": alone | (F.col("best.row") == F.col("row")),
    }).drop("component", "of", "salt_of", "salt", "best")
