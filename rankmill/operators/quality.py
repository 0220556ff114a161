"""Declared data-quality checks, evaluated as one small report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The domains of the event and segment columns.
SKIN_TYPES = ("dry", "oily", "combination", "sensitive", "normal")
EVENT_TYPES = ("view", "like", "purchase", "rating")

NOT_NULL, UNIQUE, ACCEPTED = "not_null", "unique", "accepted_values"


@dataclass(frozen=True)
class Check:
    model: str
    column: str
    kind: str
    values: tuple[str, ...] = field(default=())


# Which column of which model carries which check.
CHECKS = (
    Check("stg_ingredient", "ingredient_name_kr", NOT_NULL),
    Check("stg_ingredient", "ingredient_name_kr", UNIQUE),
    Check("stg_regulation", "ingredient_std_name", NOT_NULL),
    Check("stg_manufacturer", "company_seq", NOT_NULL),
    Check("stg_manufacturer", "company_seq", UNIQUE),
    Check("stg_products", "product_id", NOT_NULL),
    Check("stg_products", "product_id", UNIQUE),
    Check("stg_events", "event_id", NOT_NULL),
    Check("stg_events", "event_id", UNIQUE),
    Check("stg_events", "event_type", ACCEPTED, EVENT_TYPES),
    Check("recommendations", "rec_key", NOT_NULL),
    Check("recommendations", "rec_key", UNIQUE),
    Check("recommendations", "skin_type", ACCEPTED, SKIN_TYPES),
    Check("recommendations", "score", NOT_NULL),
    Check("recommendations", "rank", NOT_NULL),
    Check("dashboard_events_daily", "event_date", NOT_NULL),
    Check("dashboard_events_daily", "event_type", ACCEPTED, EVENT_TYPES),
)


class DataQualityError(RuntimeError):
    """At least one declared check found violations."""


def violating(df: DataFrame, check: Check) -> DataFrame:
    """The rows (or, for uniqueness, the keys with their counts) that violate a check."""
    if check.kind == UNIQUE:
        return (
            df.where(F.col(check.column).isNotNull())
            .groupBy(check.column)
            .agg(F.count(F.lit(1)).alias("copies"))
            .where("copies > 1")
        )
    return df.where(breaks(check))


def breaks(check: Check) -> Column:
    """Whether a row violates a check of single rows."""
    column = F.col(check.column)
    if check.kind == NOT_NULL:
        return column.isNull()
    if check.kind == ACCEPTED:
        return column.isNotNull() & ~column.isin(*check.values)
    raise ValueError(f"unknown check {check.kind}")


def _count_row(df: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row with one violation count per check, from one pass over the model.

    With a uniqueness check the pass first counts rows per key (combined in the map
    tasks, so a much repeated key stays cheap) and carries the other counts along.
    """
    names = [f"v{i}" for i in range(len(checks))]
    keyed = next((c for c in checks if c.kind == UNIQUE), None)
    if keyed is None:
        return df.agg(*[F.count_if(breaks(c)).alias(n) for n, c in zip(names, checks, strict=True)])
    key = F.col(keyed.column)
    # A NOT NULL check of the key itself falls out of the per-key counts.
    on_key = [c.kind == NOT_NULL and c.column == keyed.column for c in checks]
    carried = [
        F.count_if(breaks(c)).alias(n)
        for n, c, k in zip(names, checks, on_key, strict=True)
        if c.kind != UNIQUE and not k
    ]
    per_key = df.groupBy(keyed.column).agg(F.count(F.lit(1)).alias("copies"), *carried)
    totals = []
    for name, check, is_key in zip(names, checks, on_key, strict=True):
        if check.kind == UNIQUE:
            total = F.count_if(key.isNotNull() & (F.col("copies") > 1))
        elif is_key:
            total = F.coalesce(F.sum(F.when(key.isNull(), F.col("copies"))), F.lit(0))
        else:
            total = F.coalesce(F.sum(name), F.lit(0))
        totals.append(total.cast("bigint").alias(name))
    return per_key.agg(*totals)


def report_line(check: Check, violations: Column) -> Column:
    """The report's line of a check, as a struct."""
    return F.struct(
        F.lit(check.model).alias("model"),
        F.lit(check.column).alias("column_name"),
        F.lit(check.kind).alias("check_name"),
        violations.alias("violations"),
    )


def quality_report(models: Mapping[str, DataFrame], checks: Sequence[Check] = CHECKS) -> DataFrame:
    """`(model, column_name, check_name, violations)` for each check on a given model.

    Violations are rows for NOT NULL and accepted values, and repeated keys for
    uniqueness. NULL passes the accepted-values and uniqueness checks.
    """
    parts = []
    for model in dict.fromkeys(c.model for c in checks if c.model in models):
        own = [c for c in checks if c.model == model]
        if len({c.column for c in own if c.kind == UNIQUE}) > 1:
            raise ValueError(f"{model}: one uniqueness column per model is supported")
        lines = F.array(*[report_line(c, F.col(f"v{i}")) for i, c in enumerate(own)])
        parts.append(_count_row(models[model], own).select(F.inline(lines)))
    return reduce(DataFrame.unionAll, parts)


def enforce(report: DataFrame) -> None:
    """Raise if any check has violations. The report has one row per declared check."""
    failed = report.where("violations > 0").collect()
    if failed:
        lines = [f"{r.model}.{r.column_name} {r.check_name}: {r.violations}" for r in failed]
        raise DataQualityError("; ".join(lines))
