"""Declarative quality rules."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

# The rules of the post table.
POST_DROP_RULES = {
    "valid_id": "tweet_id IS NOT NULL",
    "valid_text": "text IS NOT NULL AND length(text) > 0",
    "valid_username": "username IS NOT NULL",
    "valid_type": "type IN ('tweet', 'reply')",
}
POST_WARN_RULES = {"valid_date": "created_at IS NOT NULL"}


def _failing(rule: str) -> Column:
    return ~F.coalesce(F.expr(rule), F.lit(False))


def _row_counts(drop: Mapping[str, str]) -> list[Column]:
    dropped = F.lit(False)
    for rule in drop.values():
        dropped = dropped | _failing(rule)
    return [F.count(F.lit(1)).alias("rows_in"), F.count_if(~dropped).alias("rows_out")]


def apply_rules(
    df: DataFrame,
    drop: Mapping[str, str],
    warn: Mapping[str, str] | None = None,
    observe: str | Observation | None = None,
) -> DataFrame:
    """Rows that meet every ``drop`` rule; a rule that is null for a row is not met.

    ``observe`` names a metric set (rows in and out, violations per rule) that is gathered while the
    data passes, on batches and on streams.
    """
    if observe is not None:
        metrics = [
            F.count_if(_failing(rule)).alias(name) for name, rule in {**drop, **(warn or {})}.items()
        ]
        df = df.observe(observe, *_row_counts(drop), *metrics)
    for rule in drop.values():
        df = df.filter(rule)
    return df


def rule_counts(df: DataFrame, drop: Mapping[str, str], warn: Mapping[str, str] | None = None) -> DataFrame:
    """One row per rule: ``rule, action, violations, rows_in, rows_out``.

    One pass; each task sends one row of counters.
    """
    rules = [(name, "drop", rule) for name, rule in drop.items()]
    rules += [(name, "warn", rule) for name, rule in (warn or {}).items()]
    counted = df.agg(
        *_row_counts(drop),
        *[F.count_if(_failing(rule)).alias(f"_{name}") for name, _, rule in rules],
    )
    per_rule = F.array(
        *[
            F.struct(F.lit(name).alias("rule"), F.lit(action).alias("action"), F.col(f"_{name}").alias("violations"))
            for name, action, _ in rules
        ]
    )
    return counted.select(F.explode(per_rule).alias("v"), "rows_in", "rows_out").select("v.*", "rows_in", "rows_out")


def violations(df: DataFrame, drop: Mapping[str, str], warn: Mapping[str, str] | None = None) -> DataFrame:
    """Violations of each rule: ``rule, action, violations, rows``."""
    return rule_counts(df, drop, warn).select("rule", "action", "violations", F.col("rows_in").alias("rows"))
