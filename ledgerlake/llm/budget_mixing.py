"""Mixing sources to target weights: hierarchical budgeting over a tree of domains, languages and sources.

A node's budget goes to its children by weight. A child that cannot use its share (its tokens times the epochs allowed)
gets what it can use, and the rest goes to its siblings by weight; since no node is given more than all its leaves can
use, a shortage reaches the siblings of an ancestor only when the whole subtree is used up. A leaf then takes whole
epochs, and of the next epoch the documents in an order seeded by the epoch, as long as the sum of tokens fits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from ledgerlake.llm.shared import settle

WORD = r"[^\x20\x09-\x0D]+"
DIGITS = 3  # hex digits of the hash by which a leaf's order is cut into buckets
CUTS = 2  # times that the bucket where a leaf's budget ends is cut


def _shares(children: DataFrame, parent: list[str], name: str) -> DataFrame:
    """Budgets of children (name, weight, room) from ``given``, the parent's budget, by filling all to one level."""
    of = W.partitionBy(*parent) if parent else W.partitionBy(F.lit(0))
    line = of.orderBy(F.col("room") / F.col("weight"), name).rowsBetween(W.unboundedPreceding, -1)
    rows = children.withColumns(
        {"all_weight": F.sum("weight").over(of), "room_before": F.coalesce(F.sum("room").over(line), F.lit(0)), "weight_before": F.coalesce(F.sum("weight").over(line), F.lit(0))}
    )
    full = (F.col("room").cast("double") * (F.col("all_weight") - F.col("weight_before"))) <= ((F.col("given") - F.col("room_before")).cast("double") * F.col("weight"))
    rows = rows.withColumn("full", full)
    rows = rows.withColumns(
        {"full_room": F.sum(F.when(F.col("full"), F.col("room")).otherwise(0)).over(of), "full_weight": F.sum(F.when(F.col("full"), F.col("weight")).otherwise(0)).over(of)}
    )
    share = F.floor((F.col("given") - F.col("full_room")).cast("double") * F.col("weight") / (F.col("all_weight") - F.col("full_weight")))
    return rows.withColumn("budget", F.when(F.col("full"), F.col("room")).otherwise(F.least(share, "room"))).drop("all_weight", "room_before", "weight_before", "full", "full_room", "full_weight", "given")


def budgets(leaves: DataFrame, levels: list[tuple[str, Column]], total: Column, epochs: int) -> DataFrame:
    """Leaf rows (level columns, tokens) with their budget. ``levels``: column and integer weight, from the top down."""
    names = [name for name, _ in levels]
    leaves = leaves.withColumn("leaf_room", F.col("tokens") * epochs)
    given = F.lit(leaves.agg(total.cast("long")).first()[0]).cast("long")
    above: list[str] = []
    for i, (name, weight) in enumerate(levels):
        nodes = leaves.groupBy(*names[: i + 1]).agg(F.sum("leaf_room").alias("room")).withColumn("weight", weight.cast("long")).where("weight > 0")
        nodes = nodes.join(given, above) if above else nodes.withColumn("given", given)
        given = _shares(nodes, above, name).select(*names[: i + 1], F.col("budget").alias("given"))
        above = names[: i + 1]
    return leaves.join(given, names).select(*names, "tokens", F.col("given").alias("budget"))


def mixture(docs: DataFrame, levels: list[tuple[str, Column, Column]], share: float = 1.0, epochs: int = 1, seed: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, the levels, epoch, n_tokens): what the mixture takes, a document once for each epoch that takes it.

    ``levels``: (name, value, integer weight) from the top down; ``share``: the budget as a part of all tokens (words).
    Null level values are a node named ``none``; a weight of 0 leaves a subtree out. Null and empty texts have no tokens
    and are taken in whole epochs, or where they stand in the order. Rows without an id are left out; repeated rows count
    each. An empty table gives no rows.
    """
    names = [name for name, _, _ in levels]
    facts = docs.where(F.col(doc_id).isNotNull()).select(
        F.col(doc_id).cast("long").alias("doc_id"), *[F.coalesce(value.cast("string"), F.lit("none")).alias(name) for name, value, _ in levels],
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("n_tokens"),
    )
    facts = settle(facts, "mixture-facts")
    leaves = facts.groupBy(*names).agg(F.sum("n_tokens").alias("tokens"))
    total = F.floor(F.sum("tokens") * F.lit(float(share)))
    plan = settle(budgets(leaves, [(name, weight) for name, _, weight in levels], total, epochs), "mixture-plan")
    plan = plan.withColumn("whole", F.expr("if(tokens > 0, budget div tokens, 0)")).withColumn("rest", F.expr("budget - whole * tokens"))
    rows = facts.join(plan, names)
    place = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col("whole") + 1, F.col("doc_id")).cast("binary"))
    columns = ["doc_id", *names, "epoch", "n_tokens"]
    last = (F.col("whole") + 1).alias("epoch")
    taken = rows.where("whole > 0").withColumn("epoch", F.explode(F.expr("sequence(1L, whole)"))).select(columns)
    # a leaf's order is summed by buckets, and again within the one bucket where the budget ends, which is a small part
    edge = rows.where("rest > 0").select("doc_id", *names, "n_tokens", "whole", "rest", place.alias("place"), F.lit(0).cast("long").alias("before"))
    for cut in range(CUTS):
        edge = edge.withColumn("bucket", F.substring("place", 1 + cut * DIGITS, DIGITS))
        sums = edge.groupBy(*names, "bucket", "rest", "before").agg(F.sum("n_tokens").alias("held"))
        reach = sums.withColumn("upto", F.col("before") + F.sum("held").over(W.partitionBy(*names).orderBy("bucket")))
        cuts = reach.withColumn("start", F.col("upto") - F.col("held")).where("start <= rest").select(*names, "bucket", "start", (F.col("upto") <= F.col("rest")).alias("inside"))
        partial = edge.join(cuts, [*names, "bucket"])
        taken = taken.unionByName(partial.where("inside").select("doc_id", *names, last, "n_tokens"))
        edge = settle(partial.where("not inside").withColumn("before", F.col("start")).drop("bucket", "start", "inside"), "mixture-edge")
    line = W.partitionBy(*names).orderBy("place", "doc_id", "n_tokens").rowsBetween(W.unboundedPreceding, 0)
    ends = edge.withColumn("sum", F.col("before") + F.sum("n_tokens").over(line))
    return taken.unionByName(ends.where("sum <= rest").select("doc_id", *names, last, "n_tokens"))


DOMAIN = "concat('domain', cast(cast(regexp_extract(source, '[0-9]+', 0) as int) % 4 as string))"
LANG_WEIGHTS = {"en": 5, "de": 2, "fr": 2, "es": 1}


def standard_levels() -> list[tuple[str, Column, Column]]:
    """Four domains by source number with weights 4 to 1, languages by LANG_WEIGHTS (others 1), sources alike."""
    domain = F.expr(f"case when source rlike '[0-9]' then {DOMAIN} end")
    weight = F.expr("case domain when 'domain0' then 4 when 'domain1' then 3 when 'domain2' then 2 else 1 end")
    language = F.expr("case lang " + " ".join(f"when '{k}' then {v}" for k, v in LANG_WEIGHTS.items()) + " else 1 end")
    return [("domain", domain, weight), ("lang", F.col("lang"), language), ("source", F.col("source"), F.lit(1))]


def sql(share: float, epochs: int, seed: int) -> str:
    """The mixture by ``standard_levels`` in SQL, with one running sum for each leaf."""

    def filled(name: str, parent: str) -> str:
        of = f"PARTITION BY {parent}" if parent else ""
        keys = f"{parent}, {name}" if parent else name
        source = f"n_{name} n JOIN g_{parent.split(', ')[-1]} g USING ({parent})" if parent else f"n_{name} n, total g"
        return f"""
, a_{name} AS (
    SELECT n.*, g.given, sum(weight) OVER ({of}) AS all_weight,
        coalesce(sum(room) OVER ({of} ORDER BY room / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS room_before,
        coalesce(sum(weight) OVER ({of} ORDER BY room / weight, {name} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS weight_before
    FROM {source}
), b_{name} AS (
    SELECT *, room::DOUBLE * (all_weight - weight_before)::DOUBLE <= (given - room_before)::DOUBLE * weight::DOUBLE AS is_full FROM a_{name}
), c_{name} AS (
    SELECT *, sum(CASE WHEN is_full THEN room ELSE 0 END) OVER ({of}) AS full_room, sum(CASE WHEN is_full THEN weight ELSE 0 END) OVER ({of}) AS full_weight FROM b_{name}
), g_{name} AS (
    SELECT {keys}, CASE WHEN is_full THEN room
        ELSE least(floor((given - full_room)::DOUBLE * weight::DOUBLE / (all_weight - full_weight)::DOUBLE)::BIGINT, room) END AS given FROM c_{name}
)"""

    languages = " ".join(f"WHEN '{k}' THEN {v}" for k, v in LANG_WEIGHTS.items())
    return f"""
WITH facts AS (
    SELECT doc_id, coalesce(CASE WHEN regexp_matches(source, '[0-9]') THEN concat('domain', CAST(CAST(regexp_extract(source, '[0-9]+') AS INT) % 4 AS VARCHAR)) END, 'none') AS domain,
        coalesce(lang, 'none') AS lang, coalesce(source, 'none') AS source,
        coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0) AS n_tokens
    FROM documents WHERE doc_id IS NOT NULL
), leaves AS (
    SELECT domain, lang, source, sum(n_tokens)::BIGINT AS tokens, sum(n_tokens)::BIGINT * {epochs} AS leaf_room FROM facts GROUP BY ALL
), total AS (
    SELECT floor(sum(tokens)::DOUBLE * {float(share)})::BIGINT AS given FROM leaves
), n_domain AS (
    SELECT domain, sum(leaf_room)::BIGINT AS room, CASE domain WHEN 'domain0' THEN 4 WHEN 'domain1' THEN 3 WHEN 'domain2' THEN 2 ELSE 1 END AS weight FROM leaves GROUP BY ALL
), n_lang AS (
    SELECT domain, lang, sum(leaf_room)::BIGINT AS room, CASE lang {languages} ELSE 1 END AS weight FROM leaves GROUP BY ALL
), n_source AS (
    SELECT domain, lang, source, sum(leaf_room)::BIGINT AS room, 1 AS weight FROM leaves GROUP BY ALL
){filled("domain", "")}{filled("lang", "domain")}{filled("source", "domain, lang")}, plan AS (
    SELECT l.*, g.given AS budget, CASE WHEN tokens > 0 THEN g.given // tokens ELSE 0 END AS whole FROM leaves l JOIN g_source g USING (domain, lang, source)
), placed AS (
    SELECT f.*, p.whole, p.budget - p.whole * p.tokens AS rest, md5(concat('{seed}', ':', p.whole + 1, ':', f.doc_id)) AS place
    FROM facts f JOIN plan p USING (domain, lang, source)
), summed AS (
    SELECT *, sum(n_tokens) OVER (PARTITION BY domain, lang, source ORDER BY place, doc_id ROWS UNBOUNDED PRECEDING) AS upto FROM placed
)
SELECT doc_id, domain, lang, source, unnest(range(1, whole + 1)) AS epoch, n_tokens::BIGINT AS n_tokens FROM placed WHERE whole > 0
UNION ALL
SELECT doc_id, domain, lang, source, whole + 1, n_tokens::BIGINT FROM summed WHERE rest > 0 AND upto <= rest
"""
