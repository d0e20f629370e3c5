"""What rules find and what they cost: hits, profiles, ranking, ablation.

Aggregations run over the match table with map-side partials. Ranking works on
the per-rule table that results, whose size is the number of rules.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def hits_per_rule(matches: DataFrame, keys: Sequence[str] = ("doc_id",)) -> DataFrame:
    """Events and haystacks with an event, per rule.

    Counting per haystack first keeps the distinct count out of the final
    grouping, where a frequent rule would gather all its haystacks.
    """
    per_doc = matches.groupBy("pattern_id", *keys).agg(F.count("*").alias("n"))
    return per_doc.groupBy("pattern_id").agg(F.sum("n").alias("hits"), F.count("*").alias("docs"))


def rule_profile(matches: DataFrame, length: str = "n_bytes") -> DataFrame:
    """Observed widths per rule, and whether it matches at / only at the end of data.

    ``length`` is the haystack's size, carried through the scan as a key column.
    """
    width = F.col("to") - F.col("from")
    at_end = F.col("to") == F.col(length)
    return matches.groupBy("pattern_id").agg(
        F.min(width).alias("min_width"), F.max(width).alias("max_width"),
        F.bool_or(at_end).alias("at_end"), F.bool_and(at_end).alias("only_at_end"))


CRITERIA = ("hits", "docs", "bytes")


def rule_costs(matches: DataFrame, by: str = "hits", *, keys: Sequence[str] = ("doc_id",), length: str = "n_bytes") -> DataFrame:
    """What a rule costs: its events, the haystacks it matches in, or the bytes of those: ``(pattern_id, cost)``.

    ``length`` is the haystack's size, carried through the scan as a key column; it is only needed for ``bytes``.
    """
    if by not in CRITERIA:
        raise ValueError(f"the criterion is one of {CRITERIA}")
    sizes = [F.max(length).alias("size")] if by == "bytes" else []
    per_doc = matches.groupBy("pattern_id", *keys).agg(F.count("*").alias("n"), *sizes)
    cost = {"hits": F.sum("n"), "docs": F.count("*")}.get(by)
    return per_doc.groupBy("pattern_id").agg((F.sum("size") if cost is None else cost).cast("bigint").alias("cost"))


def rule_ranking(costs: DataFrame, factor: int = 1, generations: int = 10, *, descending: bool = True) -> DataFrame:
    """Cut the ``factor`` most expensive rules per generation, cumulatively.

    Per cut rule: its rank, its generation, what is left of the total after the
    generation, and the ratio to the total. At least one rule always stays.
    """
    best = F.col("cost").desc() if descending else F.col("cost").asc()
    order = Window.orderBy(best, "pattern_id")
    n, base = F.count("*").over(Window.partitionBy()), F.sum("cost").over(Window.partitionBy())
    ranked = costs.select("pattern_id", "cost", F.row_number().over(order).alias("rank"), n.alias("n"), base.alias("base"))
    ranked = ranked.withColumn("generation", F.floor((F.col("rank") - 1) / factor).cast("int"))
    limit = F.least(F.lit(generations), F.floor((F.col("n") - 1) / factor))
    kept = ranked.where(F.col("generation") < limit)
    upto = Window.orderBy("generation").rangeBetween(Window.unboundedPreceding, 0)
    left = F.col("base") - F.sum("cost").over(upto)
    return kept.select(
        "pattern_id", "cost", "rank", "generation", left.alias("score"), (left / F.col("base")).alias("ratio"))


def rule_groups(rules: DataFrame, factor: int, order: Column) -> DataFrame:
    """Deal rules, in the given order, into ``factor + 1`` groups of equal size."""
    groups = factor + 1
    placed = rules.withColumn("__i", F.row_number().over(Window.orderBy(order, "pattern_id")))
    placed = placed.withColumn("__n", F.count("*").over(Window.partitionBy()))
    group = F.floor((F.col("__i") * groups - 1) / F.col("__n")).cast("int")
    return placed.withColumn("group_no", group).drop("__i", "__n")


def group_ablation(costs: DataFrame, factor: int, order: Column) -> DataFrame:
    """Score of the rule set without each group in turn."""
    grouped = rule_groups(costs, factor, order).groupBy("group_no").agg(
        F.count("*").alias("rules"), F.sum("cost").alias("dropped"))
    total = F.sum("dropped").over(Window.partitionBy())
    left = total - F.col("dropped")
    return grouped.select("group_no", "rules", "dropped", left.alias("score"), (left / total).alias("ratio"))
