"""A benchmark that checks results before it reports times."""

from __future__ import annotations

import statistics
import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tessera.operators.content_hash import ContentHash, content_hash

STATIC = ("spark.master", "spark.executor.memory", "spark.driver.memory", "spark.serializer", "spark.executor.cores")
MEANINGFUL = 5


@dataclass(frozen=True)
class Variant:
    """A labelled set of session settings, and whether the query is written with its hints."""

    label: str
    settings: Mapping[str, str] = field(default_factory=dict)
    hint: bool = False

    def __post_init__(self):
        static = [k for k in self.settings if k in STATIC]
        if static:
            raise ValueError(f"{self.label}: static settings {static}")
        if "spark.sql.parquet.compression.codec" in self.settings:
            raise ValueError(f"{self.label}: the codec would change the input")


PLAIN = Variant("plain", {"spark.sql.shuffle.partitions": "200", "spark.sql.adaptive.enabled": "true"})
CONTROL = Variant("plain_again", dict(PLAIN.settings))
TUNED = Variant("tuned", {"spark.sql.shuffle.partitions": "12", "spark.sql.adaptive.enabled": "true", "spark.sql.adaptive.skewJoin.enabled": "true", "spark.sql.files.maxPartitionBytes": "64m"}, True)


def ladder(base: Variant, full: Variant) -> list[Variant]:
    """base, then the settings of full one after the other, then its hint."""
    out, held = [base], dict(base.settings)
    for i, (k, v) in enumerate(x for x in full.settings.items() if base.settings.get(x[0]) != x[1]):
        held = held | {k: v}
        out.append(Variant(f"B{i + 1}_{k.rsplit('.', 1)[-1]}", dict(held)))
    return [*out, Variant(full.label, dict(full.settings), full.hint)]


def leave_one_out(base: Variant, full: Variant) -> list[Variant]:
    """full with each of its settings set back to the base's."""
    changed = [k for k, v in full.settings.items() if base.settings.get(k) != v]
    back = lambda k: {n: v for n, v in full.settings.items() if n != k} | ({k: base.settings[k]} if k in base.settings else {})
    return [Variant(f"L_{k.rsplit('.', 1)[-1]}", back(k), full.hint) for k in changed] + ([Variant("L_hint", dict(full.settings), False)] if full.hint else [])


@dataclass(frozen=True)
class Observation:
    label: str
    iteration: int
    ms: float
    result: ContentHash
    source: ContentHash
    correct: bool = False


@dataclass(frozen=True)
class Statistics:
    n: int
    median: float
    mean: float
    low: float
    high: float
    deviation: float

    @staticmethod
    def of(values: Sequence[float]) -> Statistics:
        if not values:
            raise ValueError("no observations")
        return Statistics(len(values), statistics.median(values), statistics.fmean(values), min(values), max(values), statistics.stdev(values) if len(values) > 1 else 0.0)

    @property
    def variation(self) -> float:
        return self.deviation / self.mean if self.mean else 0.0

    @property
    def meaningful(self) -> bool:
        return self.n >= MEANINGFUL


def improvement(base: Statistics, other: Statistics) -> float:
    """How much less the median is, as a share of the base's."""
    return (base.median - other.median) / base.median if base.median else 0.0


def run(spark: SparkSession, variants: Sequence[Variant], source: DataFrame, query: Callable[[bool], DataFrame], iterations: int = 5, warmups: int = 1) -> list[Observation]:
    """Warm-ups, then iterations whose order alternates; settings are put back after each run.

    The input is hashed before every iteration. The first variant's result is the oracle.
    """
    seen: list[Observation] = []
    for i in range(-warmups, iterations):
        given = content_hash(source)
        for v in variants if i % 2 == 0 else reversed(variants):
            before = {k: spark.conf.get(k, None) for k in v.settings}
            try:
                for k, x in v.settings.items():
                    spark.conf.set(k, x)
                began = time.perf_counter()
                result = content_hash(query(v.hint))
                took = (time.perf_counter() - began) * 1000
            finally:
                for k, x in before.items():
                    spark.conf.unset(k) if x is None else spark.conf.set(k, x)
            if i >= 0:
                seen.append(Observation(v.label, i, took, result, given))
    oracle = next(o.result for o in seen if o.label == variants[0].label)
    return [Observation(o.label, o.iteration, o.ms, o.result, o.source, o.result == oracle) for o in seen]


@dataclass(frozen=True)
class Report:
    observations: tuple[Observation, ...]

    @property
    def labels(self) -> list[str]:
        return list(dict.fromkeys(sorted((o.label for o in self.observations), key=[o.label for o in self.observations].index)))

    def stats(self, label: str) -> Statistics:
        return Statistics.of([o.ms for o in self.observations if o.label == label])

    @property
    def problems(self) -> list[str]:
        out = [f"{o.label} #{o.iteration} gave another result" for o in self.observations if not o.correct]
        if len({o.source for o in self.observations}) > 1:
            out.append("the input changed between runs")
        return out

    def steps(self) -> list[tuple[str, str, float]]:
        """(previous, label, improvement over it) along the labels."""
        return [(a, b, improvement(self.stats(a), self.stats(b))) for a, b in zip(self.labels, self.labels[1:], strict=False)]

    def markdown(self) -> str:
        """A table, and a headline only if every result was right and the input stayed the same."""
        lines = ["| label | n | median ms | mean | min | max | sd | cv |", "|-|-|-|-|-|-|-|-|"]
        for label in self.labels:
            s = self.stats(label)
            lines.append(f"| {label} | {s.n} | {s.median:.0f} | {s.mean:.0f} | {s.low:.0f} | {s.high:.0f} | {s.deviation:.1f} | {s.variation:.1%} |")
        if self.problems:
            return "\n".join(["No headline: the run isn't valid.", *[f"- {p}" for p in self.problems], "", *lines])
        first, last = self.labels[0], self.labels[-1]
        change = improvement(self.stats(first), self.stats(last))
        note = "" if min(self.stats(x).n for x in (first, last)) >= MEANINGFUL else f" (fewer than {MEANINGFUL} observations: not meaningful)"
        return "\n".join([f"{last} against {first}: {change:+.1%} in medians{note}", "", *lines])


def uses_broadcast(df: DataFrame) -> bool:
    """Whether the executed plan has a broadcast hash join."""
    return "BroadcastHashJoin" in df._jdf.queryExecution().executedPlan().toString()


def save(control, experiment: str, report: Report, variants: Sequence[Variant]) -> int:
    """Stores a report's observations in the control plane; the number of rows."""
    import json

    from tessera.governance.control import now

    of = {v.label: (i, json.dumps(dict(v.settings))) for i, v in enumerate(variants)}
    rows = [
        (experiment, o.label, of[o.label][0], o.iteration, o.ms, f"{o.result.rows}:{o.result.total}:{o.result.mixed}", f"{o.source.rows}:{o.source.total}:{o.source.mixed}", int(o.correct), of[o.label][1], now())
        for o in report.observations
    ]
    with control.transaction() as c:
        c.executemany("INSERT INTO benchmark_run VALUES (?, ?, ?, ?, ?, ?, ?, ?, ?, ?)", rows)
    return len(rows)


def summary(spark: SparkSession, control, experiment: str) -> DataFrame:
    """Per label and step: n, exact median, mean, min, max, sample deviation, distinct inputs, all correct."""
    from pyspark.sql import functions as F

    rows = [tuple(r) for r in control.rows("SELECT label, step, runtime_ms, input_hash, correct FROM benchmark_run WHERE experiment = ?", experiment)]
    df = spark.createDataFrame(rows, "label string, step int, ms double, source string, correct int")
    return df.groupBy("label", "step").agg(
        F.count("*").alias("n"), F.percentile("ms", 0.5).alias("median_ms"), F.avg("ms").alias("mean_ms"), F.min("ms").alias("min_ms"), F.max("ms").alias("max_ms"),
        F.stddev_samp("ms").alias("sd_ms"), F.countDistinct("source").alias("inputs"), F.bool_and(F.col("correct") == 1).alias("all_correct"),
    )
