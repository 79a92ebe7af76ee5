"""Rules as data: routing rows, counting them and repairing them."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oreflow.functions import magnitude, whole
from oreflow.settings import BUDGET_FLOOR

CLEAN, QUARANTINE, UNROUTED = "clean", "quarantine", "unrouted"


@dataclass(frozen=True)
class Rule:
    """What a clean row has to satisfy. The predicate may be null: then the rule cannot decide."""

    name: str
    predicate: Column


def budget_only(floor: float = BUDGET_FLOOR, budget: str = "Budget") -> list[Rule]:
    return [Rule("budget_at_floor", F.col(budget) >= F.lit(float(floor)))]


def strict(floor: float = BUDGET_FLOOR, budget: str = "Budget", runtime: str = "RunTime") -> list[Rule]:
    return [Rule("runtime_not_negative", F.col(runtime) >= 0), *budget_only(floor, budget)]


def passed(rules: Sequence[Rule]) -> Column:
    """True: every rule holds. False: one is broken. Null: no rule is broken and one cannot tell."""
    return reduce(and_, [rule.predicate for rule in rules])


def verdict(rules: Sequence[Rule], unrouted: str = "quarantine") -> Column:
    """``clean``, ``quarantine`` or, only with ``unrouted="keep"``, ``unrouted``."""
    if unrouted not in ("quarantine", "keep"):
        raise ValueError(f"unrouted must be 'quarantine' or 'keep', not {unrouted!r}")
    undecided = UNROUTED if unrouted == "keep" else QUARANTINE
    ok = passed(rules)
    return F.when(ok, CLEAN).when(~ok, QUARANTINE).otherwise(undecided)


def route(df: DataFrame, rules: Sequence[Rule], unrouted: str = "quarantine") -> DataFrame:
    return df.withColumn("route", verdict(rules, unrouted))


def clean(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Plain predicates rather than a test of the route, so they reach the Parquet scan."""
    return df.filter(passed(rules))


def split(
    df: DataFrame, rules: Sequence[Rule], unrouted: str = "quarantine"
) -> tuple[DataFrame, DataFrame]:
    """The clean and the quarantined rows. Null-safe: by default the two add up to the input."""
    ok = passed(rules)
    bad = ~ok if unrouted == "keep" else ~ok | ok.isNull()
    return clean(df, rules), df.filter(bad)


def counts(rules: Sequence[Rule]) -> list[Column]:
    """Row counts by route, and of rows broken by each rule."""
    ok = passed(rules)
    return [
        F.count(F.lit(1)).alias("n"),
        F.count_if(ok).alias(CLEAN),
        F.count_if(~ok).alias(QUARANTINE),
        F.count_if(ok.isNull()).alias(UNROUTED),
        *[F.count_if(~rule.predicate).alias(f"broken_{rule.name}") for rule in rules],
    ]


def profile(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """One row: total, rows with any value at all, and the route counts, in a single pass."""
    any_value = reduce(lambda a, b: a | b, [F.col(c).isNotNull() for c in df.columns])
    return df.agg(*counts(rules), F.count_if(any_value).alias("n_with_values"))


def repair(
    df: DataFrame,
    abs_cols: Sequence[str] = (),
    floors: Mapping[str, float] | None = None,
    whole_cols: Sequence[str] = (),
) -> DataFrame:
    """Make negative numbers positive and raise low or missing ones to a floor.

    ``whole_cols`` lose their fraction first. The floor is applied to the double, so a value too
    large for an integer survives.
    """
    for name in whole_cols:
        df = df.withColumn(name, whole(F.col(name)))
    for name in abs_cols:
        df = df.withColumn(name, magnitude(F.col(name)))
    for name, floor in (floors or {}).items():
        low = F.lit(float(floor))
        df = df.withColumn(name, F.when(F.col(name) >= low, F.col(name)).otherwise(low))
    return df
