"""A rule-driven data-quality gate: rules as data, compiled to columns, judged by thresholds."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from decimal import ROUND_HALF_EVEN, Context, Decimal
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.session import utc

COLUMN_WISE = ("not_null", "range", "accepted_values", "expression", "freshness")
KINDS = (*COLUMN_WISE, "unique", "referential", "row_count_delta")
POLICIES, SEVERITIES, THRESHOLDS = ("violation", "pass", "ignore"), ("FAIL", "WARN"), ("fraction", "count")


class RuleError(ValueError):
    """A rule that can't be compiled or doesn't fit the data."""


@dataclass(frozen=True)
class Rule:
    """One check of a dataset; params depend on the kind."""

    name: str
    kind: str
    column: str | None = None
    params: Mapping[str, Any] = field(default_factory=dict)
    severity: str = "FAIL"
    threshold: float = 0.0
    threshold_kind: str = "fraction"
    null_policy: str = "violation"

    def __post_init__(self):
        for what, value, known in (
            ("kind", self.kind, KINDS), ("severity", self.severity, SEVERITIES),
            ("threshold kind", self.threshold_kind, THRESHOLDS), ("null policy", self.null_policy, POLICIES),
        ):
            if value not in known:
                raise RuleError(f"{self.name}: unknown {what} {value!r}")
        if self.kind == "not_null" and self.null_policy == "ignore":
            raise RuleError(f"{self.name}: not_null can't ignore nulls")
        if self.kind not in ("expression", "row_count_delta") and not self.column:
            raise RuleError(f"{self.name}: needs a column")
        if self.kind == "accepted_values" and not self.params.get("values"):
            raise RuleError(f"{self.name}: no accepted values")
        if self.kind == "expression" and not self.params.get("expression"):
            raise RuleError(f"{self.name}: no expression")

    @staticmethod
    def from_row(row: Mapping[str, Any]) -> Rule:
        """From a stored row whose params are JSON text."""
        params = row["params"]
        return Rule(row["name"], row["kind"], row["column"], json.loads(params) if isinstance(params, str) else dict(params or {}),
                    row["severity"], row["threshold"], row["threshold_kind"], row["null_policy"])

    def breached(self, violated: int, evaluated: int) -> bool:
        """Strictly over the threshold; nothing evaluated never breaches. Fractions have 16 digits."""
        if evaluated == 0:
            return False
        if self.threshold_kind == "count":
            return violated > int(self.threshold)
        rate = Context(prec=16, rounding=ROUND_HALF_EVEN).divide(Decimal(violated), Decimal(evaluated))
        return rate > Decimal(str(self.threshold))


@dataclass(frozen=True)
class Result:
    rule: Rule
    evaluated: int
    violated: int

    @property
    def rate(self) -> float:
        return min(1.0, max(0.0, self.violated / self.evaluated)) if self.evaluated else 0.0

    @property
    def breached(self) -> bool:
        return self.rule.breached(self.violated, self.evaluated)

    @property
    def blocks(self) -> bool:
        return self.breached and self.rule.severity == "FAIL"


@dataclass(frozen=True)
class Report:
    results: tuple[Result, ...]

    @property
    def blocked(self) -> bool:
        return any(r.blocks for r in self.results)

    @property
    def warnings(self) -> tuple[Result, ...]:
        return tuple(r for r in self.results if r.breached and r.rule.severity == "WARN")


class GateFailure(RuntimeError):
    """A FAIL rule was breached."""

    def __init__(self, report: Report):
        self.report = report
        super().__init__("; ".join(f"{r.rule.name}: {r.violated} of {r.evaluated}" for r in report.results if r.blocks))


def violation(rule: Rule, as_of: dt.datetime | None = None) -> Column:
    """The three-valued violation of a column-wise rule; null where the tested value is null."""
    c = F.col(rule.column) if rule.column else None
    p = rule.params
    if rule.kind == "not_null":
        return c.isNull()
    if rule.kind == "range":
        bounds = ((c.__lt__, p.get("min")), (c.__gt__, p.get("max")))
        tests = [beyond(F.lit(bound)) for beyond, bound in bounds if bound is not None]
        return tests[0] | tests[-1] if tests else F.when(c.isNotNull(), F.lit(False))
    if rule.kind == "accepted_values":
        return ~c.isin(*p["values"])
    if rule.kind == "expression":
        return ~F.expr(p["expression"])
    days = int(p["days"])
    now = F.lit(utc(as_of)) if as_of is not None else F.current_timestamp()
    return c < now - F.make_dt_interval(F.lit(days))


def counts(rule: Rule, as_of: dt.datetime | None = None) -> tuple[Column, Column]:
    """Violated and evaluated of a column-wise rule, as aggregates."""
    bad = violation(rule, as_of)
    null = F.lit(False) if rule.kind == "not_null" else bad.isNull()
    violated = F.coalesce(bad, F.lit(rule.null_policy == "violation"))
    evaluated = ~null if rule.null_policy == "ignore" else F.lit(True)
    one = lambda test: F.coalesce(F.sum(F.when(test, 1).otherwise(0)), F.lit(0)).cast("bigint")
    return one(violated), one(evaluated)


def single_pass(df: DataFrame, rules: Sequence[Rule], as_of: dt.datetime | None = None) -> DataFrame:
    """One row with v0, e0, v1, e1, ... for column-wise and unique rules: one aggregate over one scan."""
    out = []
    for i, r in enumerate(rules):
        if r.kind == "unique":
            filled = F.count(F.col(r.column))
            v, e = filled - F.countDistinct(F.col(r.column)), filled
        else:
            v, e = counts(r, as_of)
        out += [v.alias(f"v{i}"), e.alias(f"e{i}")]
    return df.agg(*out)


def orphans(df: DataFrame, column: str, reference: DataFrame, key: str) -> tuple[DataFrame, Column]:
    """Rows whose value isn't null and isn't a key of the reference."""
    keys = reference.select(F.col(key).alias("__key")).distinct()
    rows = df.where(F.col(column).isNotNull())
    return rows.join(keys, F.col(column) == F.col("__key"), "left_anti"), F.count("*")


def row_count_delta(now: int, before: int | None, max_drop: float = 0.25) -> tuple[int, int]:
    """Evaluated and violated of a row count against the former one: the rows lost, if they are over the share allowed."""
    before = before or 0
    lost = before - now if before and (before - now) / before > max_drop else 0
    return before or now, max(0, lost)


def evaluate(df: DataFrame, rules: Sequence[Rule], references: Mapping[str, DataFrame] | None = None, previous_count: int | None = None,
             as_of: dt.datetime | None = None) -> Report:
    """Judges all rules, in their order.

    Column-wise rules share one aggregate, with the row count and the counts of values that
    referential rules look up. Rules of distinct counts make one aggregate more (each distinct
    expands the rows, so they aren't mixed with the others), and all anti joins one job.
    """
    absent = [r.name for r in rules if r.column and r.column not in df.columns]
    if absent:
        raise RuleError(f"rules on absent columns: {', '.join(absent)}")
    got: dict[int, Result] = {}
    plain = [(i, r) for i, r in enumerate(rules) if r.kind in COLUMN_WISE]
    cols = [c.alias(f"{n}{i}") for i, r in plain for n, c in zip("ve", counts(r, as_of), strict=True)]
    looked_up = [(i, r) for i, r in enumerate(rules) if r.kind == "referential"]
    cols += [F.count(F.col(r.column)).alias(f"e{i}") for i, r in looked_up]
    row = df.agg(F.count("*").alias("rows"), *cols).first()
    for i, r in plain:
        got[i] = Result(r, row[f"e{i}"], row[f"v{i}"])
    distinct = [(i, r) for i, r in enumerate(rules) if r.kind == "unique"]
    if distinct:
        found = single_pass(df, [r for _, r in distinct]).first()
        for at, (i, r) in enumerate(distinct):
            got[i] = Result(r, found[f"e{at}"], found[f"v{at}"])
    unknown = [f"{r.name}: no reference {r.params['reference']!r}" for _, r in looked_up if r.params["reference"] not in (references or {})]
    if unknown:
        raise RuleError("; ".join(unknown))
    counted = None
    for i, r in looked_up:
        lost, n = orphans(df.select(r.column), r.column, references[r.params["reference"]], r.params["key"])
        one = lost.agg(F.lit(i).alias("i"), n.alias("n"))
        counted = one if counted is None else counted.unionByName(one)
    for found in counted.collect() if counted is not None else ():
        got[found["i"]] = Result(rules[found["i"]], row[f"e{found['i']}"], found["n"])
    for i, r in enumerate(rules):
        if r.kind == "row_count_delta":
            got[i] = Result(r, *row_count_delta(row["rows"], previous_count, r.params.get("max_drop_pct", 0.25)))
    return Report(tuple(got[i] for i in range(len(rules))))


def as_dataframe(spark, report: Report) -> DataFrame:
    """A row for each rule of a report, in its order."""
    rows = [(r.rule.name, r.rule.kind, r.rule.severity, r.evaluated, r.violated, r.rate, r.breached, r.blocks) for r in report.results]
    return spark.createDataFrame(rows, "rule string, kind string, severity string, evaluated long, violated long, rate double, breached boolean, blocks boolean")


def gate(df: DataFrame, rules: Sequence[Rule], require: bool = True, record=None, **known) -> Report:
    """Evaluates, records (before deciding), and raises GateFailure if a FAIL rule is breached."""
    if require and not rules:
        raise RuleError("no rules for this dataset")
    report = evaluate(df, rules, **known)
    if record:
        record(report)
    if report.blocked:
        raise GateFailure(report)
    return report


def _rule(name: str, kind: str, column: str | None = None, severity: str = "FAIL", threshold: float = 0.0, unit: str = "fraction", nulls: str = "violation", **params) -> Rule:
    return Rule(name, kind, column, params, severity, threshold, unit, nulls)


# The production rules by dataset, with their bounds.
RULES: dict[str, tuple[Rule, ...]] = {
    "bronze": (
        _rule("bronze_pickup_ts_not_null", "not_null", "pickup_ts"),
        _rule("bronze_dropoff_ts_not_null", "not_null", "dropoff_ts"),
        _rule("bronze_source_accepted", "accepted_values", "source", values=["yellow", "green"]),
    ),
    "silver": (
        _rule("silver_trip_key_unique", "unique", "trip_key"),
        _rule("silver_fare_non_negative", "range", "fare_amount", min=0, max=10000),
        _rule("silver_total_non_negative", "range", "total_amount", min=0, max=10000),
        _rule("silver_distance_plausible", "range", "trip_distance_mi", min=0, max=300),
        _rule("silver_duration_plausible", "range", "trip_duration_min", min=0.5, max=1440),
        _rule("silver_speed_plausible", "range", "avg_speed_mph", "WARN", 0.005, min=0, max=100),
        _rule("silver_passenger_count_sane", "range", "passenger_count", "WARN", 1000, "count", "ignore", min=0, max=9),
        _rule("silver_pickup_zone_known", "referential", "pickup_location_id", "WARN", 0.02, reference="zones", key="LocationID"),
        _rule("silver_dropoff_zone_known", "referential", "dropoff_location_id", "WARN", 0.02, reference="zones", key="LocationID"),
        _rule("silver_dropoff_after_pickup", "expression", expression="dropoff_ts > pickup_ts"),
        _rule("silver_total_covers_fare", "expression", None, "WARN", 0.01, expression="total_amount >= fare_amount - 0.01"),
        _rule("silver_tip_pct_bounded", "expression", None, "WARN", 0.005, "fraction", "ignore", expression="tip_pct >= 0 AND tip_pct <= 2"),
        _rule("silver_row_count_stable", "row_count_delta", None, "WARN", max_drop_pct=0.25),
        _rule("silver_freshness", "freshness", "pickup_ts", "WARN", days=3650),
    ),
    "agg_zone_hourly": (
        _rule("gold_revenue_non_negative", "range", "total_revenue", min=0, max=100_000_000),
        _rule("gold_trip_count_positive", "range", "trip_count", min=1, max=10_000_000),
    ),
}
