"""Column contracts: failing rows per rule, from a scan or counted while a model is written."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from prevascope.config import INCOMPLETE, SMALL, STATE_CODES, VALID
from prevascope.operators.quality import count_if_true


@dataclass(frozen=True)
class NotNull:
    column: str
    rule = "not_null"

    def broken(self) -> Column:
        return F.col(self.column).isNull()


@dataclass(frozen=True)
class AcceptedValues:
    """Null passes."""

    column: str
    values: tuple
    rule = "accepted_values"

    def broken(self) -> Column:
        return F.col(self.column).isNotNull() & ~F.col(self.column).isin(list(self.values))


Rule = NotNull | AcceptedValues

#: rules of the default models
MODEL_RULES: dict[str, tuple[Rule, ...]] = {
    "staging": (NotNull("state_code"), NotNull("county_name")),
    "ranking": (NotNull("state_code"), NotNull("county_name")),
    "profile": (NotNull("state_code"), AcceptedValues("state_code", tuple(STATE_CODES))),
    "mart": (
        NotNull("state_code"),
        NotNull("county_fips"),
        AcceptedValues("data_quality_status", (VALID, INCOMPLETE, SMALL)),
    ),
}


def failure_counts(rules: Sequence[Rule]) -> list[Column]:
    """An aggregate for each rule, in order: the rows that break it."""
    return [count_if_true(r.broken()).alias(f"_{i}") for i, r in enumerate(rules)]


def contract_failures(df: DataFrame, model: str, rules: Sequence[Rule]) -> DataFrame:
    """``model, column_name, rule, failures, status`` for each rule, from one scan."""
    return failures_of_counts(df.agg(*failure_counts(rules)), model, rules)


def noted_failures(spark: SparkSession, model: str, rules: Sequence[Rule], counts: Mapping[str, int]) -> DataFrame:
    """:func:`contract_failures` from :func:`failure_counts` taken before."""
    known = spark.range(1).select(*[F.lit(counts[f"_{i}"]).cast("bigint").alias(f"_{i}") for i in range(len(rules))])
    return failures_of_counts(known, model, rules)


def failures_of_counts(counts: DataFrame, model: str, rules: Sequence[Rule]) -> DataFrame:
    """``model, column_name, rule, failures, status`` for each rule from the one row of ``counts``."""
    rows = [
        F.struct(
            F.lit(model).alias("model"),
            F.lit(r.column).alias("column_name"),
            F.lit(r.rule).alias("rule"),
            F.col(f"_{i}").alias("failures"),
            F.when(F.col(f"_{i}") == 0, "PASS").otherwise("FAIL").alias("status"),
        )
        for i, r in enumerate(rules)
    ]
    return counts.select(F.inline(F.array(*rows)))


def contract_report(models: dict[str, DataFrame], rules: dict[str, tuple[Rule, ...]] | None = None) -> DataFrame:
    """Contract failures of all given models."""
    rules = MODEL_RULES if rules is None else rules
    return reduce(DataFrame.union, [contract_failures(df, name, rules[name]) for name, df in models.items()])
