"""Row rules, their rejection funnel, volume gates and mart contracts."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from larder.functions import percent_of
from larder.functions.text import as_column
from larder.operators.predicates import all_of


@dataclass(frozen=True)
class Rule:
    """A named condition that a row must meet; NULL counts as not met."""

    name: str
    keep: Column

    def met(self) -> Column:
        return F.coalesce(self.keep, F.lit(False))


def apply_rules(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    return df.where(all_of(rule.keep for rule in rules))


def first_failure(rules: Sequence[Rule]) -> Column:
    """Name of the first rule a row fails, NULL when it passes all."""
    return F.coalesce(*(F.when(~rule.met(), F.lit(rule.name)) for rule in rules))


def rule_funnel(df: DataFrame, rules: Sequence[Rule], unique_keys: Sequence[str]) -> DataFrame:
    """Rows removed by each rule in turn, then by duplicate keys, and rows left after each.

    One pass: each row is charged to its first failing rule, and the duplicates are the
    passing rows less the distinct keys among them, which combine before the shuffle.
    """
    failure = first_failure(rules)
    key = F.struct(*(as_column(k) for k in unique_keys))
    counts = df.select(failure.alias("_failure"), key.alias("_key")).agg(
        F.count("*").alias("_total"),
        *(
            F.count(F.when(F.col("_failure") == rule.name, True)).alias(f"_removed{i}")
            for i, rule in enumerate(rules)
        ),
        F.count_distinct(F.when(F.col("_failure").isNull(), F.col("_key"))).alias("_kept"),
    )
    removed = [F.col(f"_removed{i}") for i in range(len(rules))]
    passing = reduce(lambda left, gone: left - gone, removed, F.col("_total"))
    steps = [(rule.name, gone) for rule, gone in zip(rules, removed)]
    steps.append(("duplicate_key", passing - F.col("_kept")))

    rows, remaining = [], F.col("_total")
    for number, (name, gone) in enumerate(steps, start=1):
        remaining = remaining - gone
        rows.append(
            F.struct(
                F.lit(number).alias("step"),
                F.lit(name).alias("rule"),
                gone.alias("removed"),
                remaining.alias("remaining"),
                percent_of(F.col("_total") - remaining, F.col("_total"), 4).alias("rejected_pct"),
            )
        )
    return counts.select(F.inline(F.array(*rows)))


def volume_gate(sources: Mapping[str, tuple[DataFrame, int]]) -> DataFrame:
    """One row per source: its rows, the minimum wanted and whether it is met."""
    verdicts = [
        df.agg(F.count("*").alias("rows")).select(
            F.lit(name).alias("source"),
            "rows",
            F.lit(least).cast("bigint").alias("min_rows"),
            (F.col("rows") >= least).alias("ok"),
        )
        for name, (df, least) in sources.items()
    ]
    return reduce(DataFrame.unionByName, verdicts)


def schema_problems(df: DataFrame, schema: T.StructType) -> list[str]:
    """Differences in column names, order or types from the contract."""
    found = [(f.name, f.dataType.simpleString()) for f in df.schema.fields]
    wanted = [(f.name, f.dataType.simpleString()) for f in schema.fields]
    if found == wanted:
        return []
    missing = [f"missing {n}: {t}" for n, t in wanted if (n, t) not in found]
    surplus = [f"unexpected {n}: {t}" for n, t in found if (n, t) not in wanted]
    return (missing + surplus) or ["columns out of order"]


def contract_report(
    marts: Mapping[str, DataFrame],
    schemas: Mapping[str, T.StructType],
    unique_keys: Mapping[str, Sequence[str]],
) -> DataFrame:
    """One row per mart: rows, rows beyond the first of a key, and whether the schema holds."""
    def report(name: str, df: DataFrame) -> DataFrame:
        keys = unique_keys.get(name, ())
        repeated = (
            F.count("*") - F.count_distinct(F.struct(*(as_column(k) for k in keys)))
            if keys
            else F.lit(0).cast("bigint")
        )
        return df.agg(
            F.lit(name).alias("mart"),
            F.count("*").alias("rows"),
            repeated.alias("repeated_keys"),
            F.lit(not schema_problems(df, schemas[name])).alias("schema_ok"),
        ).select("mart", "rows", "repeated_keys", "schema_ok")

    return reduce(DataFrame.unionByName, (report(n, d) for n, d in marts.items()))
