"""Behaviour rules: a user's previous and current action against (action1, action2) rules."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.ordered import Run, over_rows, running


def action_pairs(df: DataFrame, key: str, order: Sequence[str], action: str = "action") -> DataFrame:
    """Each action next to the one before it, per user."""
    slim = df.select(*dict.fromkeys([key, *order, action]))
    pairs = over_rows(slim, [key], order, 1, lambda w: {"action1": F.lag(action).over(w)})
    return pairs.where(F.col("action1").isNotNull()).withColumnRenamed(action, "action2")


def match_rules(pairs: DataFrame, rules: DataFrame, mode: str = "all") -> DataFrame:
    """Pairs that meet a rule. ``latest`` keeps only the rule with the highest ``rule_seq``.

    Spark picks the join strategy from the size of ``rules``; the single latest rule is broadcast.
    """
    if mode == "latest":
        rules = F.broadcast(
            rules.agg(F.max_by(F.struct("action1", "action2"), "rule_seq").alias("_r")).select("_r.action1", "_r.action2")
        )
    elif mode == "all":
        rules = rules.select("action1", "action2").distinct()
    else:
        raise ValueError(f"unknown mode {mode!r}")
    return pairs.join(rules, ["action1", "action2"])


def behavior_pattern(
    df: DataFrame, rules: DataFrame, key: str, order: Sequence[str], action: str = "action", mode: str = "all"
) -> DataFrame:
    matched = match_rules(action_pairs(df, key, order, action), rules, mode)
    return matched.select(key, *[c for c in order if c != key], "action1", "action2")


def match_rules_at(pairs: DataFrame, rules: DataFrame, order: Sequence[str]) -> DataFrame:
    """Pairs that meet the rule that is valid at their second action: the last one at or before it in ``order``.

    Both inputs have the ``order`` columns; of rules at the same place the one of the larger (action1, action2) is valid.
    Before the first rule nothing matches; a NULL action equals none. Both inputs are merged into one order, in which the
    last rule is a running maximum: slices of it are walked by themselves and get the rule before them as their carry.
    """
    rule = F.struct(*order, F.col("action1").alias("r1"), F.col("action2").alias("r2"))
    tagged = rules.select(*order, rule.alias("_rule"), F.lit(0).alias("_side"), F.struct("action1", "action2").alias("_tie"))
    slim = pairs.select(
        *pairs.columns, F.lit(None).cast(tagged.schema["_rule"].dataType).alias("_rule"), F.lit(1).alias("_side"), F.struct("action1", "action2").alias("_tie")
    )
    merged = slim.unionByName(tagged, allowMissingColumns=True)
    valid = running(merged, [], [*order, "_side", "_tie"], {"_valid": Run("max", F.col("_rule"))})
    met = (F.col("_side") == 1) & (F.col("action1") == F.col("_valid.r1")) & (F.col("action2") == F.col("_valid.r2"))
    return valid.where(met).select(*pairs.columns)


def behavior_pattern_at(
    df: DataFrame, rules: DataFrame, key: str, order: Sequence[str], action: str = "action"
) -> DataFrame:
    """Pairs of actions that meet the rule valid at the second one; ``rules`` are ``action1, action2`` with the order columns."""
    matched = match_rules_at(action_pairs(df, key, order, action), rules, order)
    return matched.select(key, *[c for c in order if c != key], "action1", "action2")
