"""Data-quality report: key uniqueness, NOT NULL, length / range limits, enumerated domains.

All row-level rules are evaluated in one aggregation pass (``count_if`` per rule, partial per task);
key uniqueness is one more aggregation by key. The result is one row per rule with its violation
count — never the violating rows themselves, so its size does not grow with the data.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskflow.constants import ACTIONS, REVIEW_STATUSES, RISK_LEVELS, SCORE_DECIMAL_LIMIT, VARCHAR_LIMITS


@dataclass(frozen=True)
class Rule:
    name: str  # not_null | max_length | abs_below | in_set
    column: str
    arg: object = None

    def violation(self) -> Column:
        c = F.col(self.column)
        if self.name == "not_null":
            return c.isNull()
        if self.name == "max_length":
            return F.length(c) > F.lit(int(self.arg))
        if self.name == "abs_below":
            # Checked as stored: DECIMAL(5,2) columns receive the value rounded to 2 places.
            return F.abs(F.round(c, 2)) >= F.lit(float(self.arg))
        if self.name == "in_set":
            return c.isNotNull() & ~c.isin(*self.arg)
        raise ValueError(f"unknown rule {self.name!r}")


def triage_rules() -> list[Rule]:
    """The operational table's constraints (NOT NULL columns, VARCHAR(n), DECIMAL(5,2)) and the
    domains of level, action and review status."""
    rules = [Rule("not_null", c) for c in ("transaction_id", "user_id", "risk_score", "risk_level", "automated_action")]
    rules += [Rule("max_length", c, n) for c, n in VARCHAR_LIMITS]
    rules += [Rule("abs_below", "risk_score", SCORE_DECIMAL_LIMIT)]
    rules += [
        Rule("in_set", "risk_level", tuple(RISK_LEVELS)),
        Rule("in_set", "automated_action", tuple(ACTIONS)),
        Rule("in_set", "review_status", tuple(REVIEW_STATUSES)),
    ]
    return rules


def quality_report(df: DataFrame, rules: list[Rule], key: str | None = None) -> DataFrame:
    """One row per rule: rule, column_name, violations (bigint). With ``key``, also
    ``unique_key``: the number of key values that occur more than once.

    One pass over ``df``: with a key, rows are first aggregated per key (rule counts and row count
    per key, combined map-side), then summed globally; without one, a single global aggregate."""
    counts = [F.count_if(r.violation()).alias(f"v{i}") for i, r in enumerate(rules)]
    if key:
        per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("__n"), *counts)
        wide = per_key.agg(
            *[F.sum(f"v{i}").alias(f"v{i}") for i in range(len(rules))],
            F.count_if((F.col("__n") > 1) & F.col(key).isNotNull()).alias("v_key"),
        )
    else:
        wide = df.agg(*counts)
    entries = [(r.name, r.column, f"v{i}") for i, r in enumerate(rules)]
    if key:
        entries.append(("unique_key", key, "v_key"))
    stack = ", ".join(f"'{name}', '{col}', {v}" for name, col, v in entries)
    report = wide.selectExpr(f"stack({len(entries)}, {stack}) AS (rule, column_name, violations)")
    return report.withColumn("violations", F.coalesce(F.col("violations").cast("long"), F.lit(0).cast("long")))
