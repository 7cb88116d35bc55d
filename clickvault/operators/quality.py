"""Declarative data-quality rules, evaluated in one pass, and the gate.

A suite is a list of ``Expectation``. ``run_suite`` returns a DataFrame
with one row per rule (position, expectation, column, kwargs as JSON,
element_count, unexpected_count, success); ``enforce`` collects that small
result (one row per rule, never data rows) and raises before anything is
written.

Row-level rules (not-null, conditional not-null, between) all become
``count_if`` terms of a single aggregate. A uniqueness rule needs the rows
grouped by its column, so the row-level terms ride along in that same
group-by: one shuffle for the whole suite, with map-side combine, so a hot
value cannot pile up in one task.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NAMES = {
    "unique": "expect_column_values_to_be_unique",
    "not_null": "expect_column_values_to_not_be_null",
    "between": "expect_column_values_to_be_between",
}


@dataclass(frozen=True)
class Expectation:
    kind: str
    column: str
    row_condition: str | None = None
    min_value: float | None = None
    max_value: float | None = None

    @property
    def name(self) -> str:
        return NAMES[self.kind]

    @property
    def kwargs(self) -> str:
        """The rule's parameters as JSON text (keys sorted, unset ones left out)."""
        args = {"column": self.column, "row_condition": self.row_condition,
                "min_value": self.min_value, "max_value": self.max_value}
        return json.dumps({k: v for k, v in args.items() if v is not None}, sort_keys=True)

    def domain(self) -> Column:
        """Rows the rule applies to (a NULL condition result excludes the row)."""
        if self.row_condition is None:
            return F.lit(True)
        return F.coalesce(F.expr(self.row_condition), F.lit(False))

    def unexpected(self) -> Column:
        c = F.col(self.column)
        if self.kind == "not_null":
            return self.domain() & c.isNull()
        if self.kind == "between":
            bad = F.lit(False)
            if self.min_value is not None:
                bad = bad | (c < F.lit(self.min_value))
            if self.max_value is not None:
                bad = bad | (c > F.lit(self.max_value))
            # NULLs are not judged by a range rule
            return self.domain() & c.isNotNull() & bad
        raise ValueError(f"{self.kind} is not a row-level rule")


def expect_unique(column, row_condition=None):
    return Expectation("unique", column, row_condition)


def expect_not_null(column, row_condition=None):
    return Expectation("not_null", column, row_condition)


def expect_between(column, min_value=None, max_value=None, row_condition=None):
    return Expectation("between", column, row_condition, min_value, max_value)


RESULT_COLUMNS = [
    "rule_index",
    "expectation",
    "column_name",
    "kwargs",
    "element_count",
    "unexpected_count",
    "success",
]


def _result_row(i: int, rule: Expectation, element: Column, unexpected: Column) -> Column:
    return F.struct(
        F.lit(i).alias("rule_index"),
        F.lit(rule.name).alias("expectation"),
        F.lit(rule.column).alias("column_name"),
        F.lit(rule.kwargs).alias("kwargs"),
        element.cast("bigint").alias("element_count"),
        unexpected.cast("bigint").alias("unexpected_count"),
    )


def run_suite(df: DataFrame, rules: list[Expectation]) -> DataFrame:
    """Evaluate all rules; one result row per rule, in rule order."""
    rows = list(enumerate(rules))
    unique = [(i, r) for i, r in rows if r.kind == "unique"]
    plain = [(i, r) for i, r in rows if r.kind != "unique"]
    parts: list[DataFrame] = []

    def row_terms(pairs):
        terms = []
        for i, r in pairs:
            terms.append(F.count_if(r.domain()).alias(f"_d{i}"))
            terms.append(F.count_if(r.unexpected()).alias(f"_u{i}"))
        return terms

    # The first unique column carries all row-level rules in its group-by;
    # further unique columns (if any) need a group-by each.
    for j, (i, r) in enumerate(unique):
        carried = plain if j == 0 else []
        per_value = df.groupBy(r.column).agg(
            F.count_if(r.domain()).alias("_n"), *row_terms(carried)
        )
        dup = F.col(r.column).isNotNull() & (F.col("_n") > 1)
        summary = per_value.agg(
            F.sum("_n").alias(f"_d{i}"),
            F.coalesce(F.sum(F.when(dup, F.col("_n"))), F.lit(0)).alias(f"_u{i}"),
            *[F.sum(f"_{k}{p}").alias(f"_{k}{p}") for p, _ in carried for k in "du"],
        )
        parts.append(_to_rows(summary, [(i, r), *carried]))
    if plain and not unique:
        parts.append(_to_rows(df.agg(*row_terms(plain)), plain))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.withColumn("success", F.col("unexpected_count") == 0).select(*RESULT_COLUMNS)


def _to_rows(summary: DataFrame, pairs) -> DataFrame:
    zero = F.lit(0)
    structs = [
        _result_row(i, r, F.coalesce(F.col(f"_d{i}"), zero), F.coalesce(F.col(f"_u{i}"), zero))
        for i, r in pairs
    ]
    return summary.select(F.inline(F.array(*structs)))


class DataQualityError(Exception):
    """A suite failed; nothing of the batch may be written."""

    def __init__(self, suite_name: str, failures: list, rows: list | None = None):
        self.suite_name = suite_name
        self.failures = failures
        self.rows = rows or failures  # results of all rules, the passed ones too
        lines = ", ".join(
            f"{f['expectation']}({f['column_name']}): {f['unexpected_count']} unexpected"
            for f in failures
        )
        super().__init__(f"data validation failed for {suite_name}: {lines}")


def enforce(result: DataFrame, suite_name: str) -> list[dict]:
    """Raise ``DataQualityError`` unless every rule succeeded; return the rows."""
    rows = [r.asDict() for r in result.orderBy("rule_index").collect()]
    failures = [r for r in rows if not r["success"]]
    if failures:
        raise DataQualityError(suite_name, failures, rows)
    return rows


# The five suites of the pipeline (fixed values of the reference).
SILVER_SUITE = [
    expect_unique("event_id"),
    expect_not_null("event_id"),
    expect_not_null("event_timestamp"),
    expect_not_null("event_type"),
    expect_not_null("user_id"),
    expect_not_null("session_id"),
    expect_not_null("product_id", row_condition='event_type != "page_view"'),
]
BUSINESS_SUITE = [
    expect_not_null("event_date"),
    expect_not_null("country"),
    expect_between("view_to_cart_rate", 0, 100),
    expect_between("cart_to_checkout_rate", 0, 100),
    expect_between("checkout_to_purchase_rate", 0, 100),
]
FUNNEL_SUITE = [
    expect_not_null("event_date"),
    expect_not_null("country"),
    expect_between("view_to_cart_rate", 0, 100),
    expect_between("cart_to_checkout_rate", 0, 100),
    expect_between("view_to_purchase_rate", 0, 100),
    expect_between("checkout_to_purchase_rate", 0, 100),
]
CHANNEL_SUITE = [
    expect_not_null("event_date"),
    expect_not_null("country"),
    expect_not_null("traffic_source"),
    expect_between("purchase_conversion_rate", 0, 100),
    expect_between("events_per_session", 0, None),
]
PRODUCT_SUITE = [
    expect_not_null("event_date"),
    expect_not_null("product_id"),
    expect_not_null("country"),
]
SUITES = {
    "silver": SILVER_SUITE,
    "business_metrics": BUSINESS_SUITE,
    "marketing_funnel": FUNNEL_SUITE,
    "marketing_channel": CHANNEL_SUITE,
    "product_performance": PRODUCT_SUITE,
}
