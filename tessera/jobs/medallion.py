"""The batch jobs: raw to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import contextlib
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from tessera.governance import lineage, metrics, schema_registry
from tessera.governance.control import ControlPlane, Run, run
from tessera.governance.publish import Published, Publisher, Unit, fingerprint, source_hash
from tessera.operators import enrich, gold, quality_rules, rejects, sinks
from tessera.sources import conform
from tessera.sources.schemas import BRONZE, SILVER


@dataclass
class Jobs:
    """Jobs on one control plane and one data root. A unit that is committed costs a lookup.

    block_bronze: whether a breached bronze rule stops the ingest; otherwise it is recorded
    as a warning, as raw files do have rows that silver rejects.
    """

    spark: SparkSession
    control: ControlPlane
    publisher: Publisher
    require_rules: bool = True
    block_bronze: bool = False
    commit_id: str | None = None

    @contextlib.contextmanager
    def _run(self, job: str, **config) -> Iterator[Run]:
        """A run with its configuration; the task metrics of its jobs are kept, whatever its end."""
        with run(self.control, job, config, self.commit_id) as r, metrics.job_group(self.spark, r.run_id):
            try:
                yield r
            except BaseException as error:
                try:
                    self.control.metrics(r.run_id, metrics.of_group(self.spark, r.run_id))
                except Exception as late:  # the run's own error is the one to tell
                    error.add_note(f"the task metrics couldn't be kept: {late}")
                raise
            self.control.metrics(r.run_id, metrics.of_group(self.spark, r.run_id))

    def bronze(self, raw: DataFrame, source: str, unit: str) -> Published | None:
        """Conforms a raw source and publishes it as a unit; source is a known name in lower case."""
        if source not in conform.SOURCES:
            raise ValueError(f"unknown source {source!r}")
        key = Unit(f"bronze_{source}", "raw_to_bronze", unit)
        with self._run("BronzeIngestJob", source=source, unit=unit) as r:
            schema_registry.register(self.control, key.dataset, BRONZE, r.run_id)
            rules = self.control.load_rules("bronze")
            rules = rules if self.block_bronze else [replace(x, severity="WARN") for x in rules]

            def validate(staged: DataFrame) -> None:
                quality_rules.gate(staged, rules, False, lambda report: self.control.record_report(r.run_id, report, key.dataset))

            out = self.publisher.publish(key, r.run_id, lambda: conform.conform(raw, source), validate if rules else None, source=source_hash(raw))
            if out and not out.skipped:
                lost = conform.malformed(raw, source).first().asDict()
                self.control.metrics(r.run_id, {"rows": out.rows, "malformed_values": sum(lost.values())})
                r.rows(read=out.rows, written=out.rows)
                named = {n: c for n, c in conform.spec(source).columns.items() if c in raw.columns}
                lineage.record(self.control, r.run_id, "BronzeIngestJob", [f"raw_{source}"], key.dataset, {f"raw_{source}": named})
            r.succeeded()
        return out

    def silver(self, bronze: DataFrame, zones: DataFrame, unit: str, sources: Sequence[str] = ("bronze_yellow", "bronze_green")) -> Published | None:
        """Publishes a silver unit, if the staged rows pass the rules of the dataset, and a unit of the rejected rows with their reasons."""
        key, refused = Unit("silver_trips", "bronze_to_silver", unit), Unit("silver_rejects", "bronze_to_silver", unit)
        with self._run("SilverTransformJob", unit=unit, sources=list(sources)) as r:
            schema_registry.register(self.control, key.dataset, SILVER, r.run_id)
            rules = self.control.load_rules("silver")

            def validate(staged: DataFrame) -> None:
                before = self.control.previous_count(key.dataset, key.stage)
                quality_rules.gate(
                    staged, rules, self.require_rules, lambda report: self.control.record_report(r.run_id, report, key.dataset), references={"zones": zones}, previous_count=before
                )

            given = source_hash(bronze)
            out = self.publisher.publish(key, r.run_id, lambda: enrich.silver(bronze, zones), validate, source=given)
            if out:
                listing = rejects.rejected(bronze, rejects.trip_reasons(), "source", "pickup_ts")
                schema_registry.register(self.control, refused.dataset, listing.schema, r.run_id)
                lost = self.publisher.publish(refused, r.run_id, lambda: listing, source=given)
                if not out.skipped:
                    r.rows(written=out.rows)
                    lineage.record(self.control, r.run_id, "SilverTransformJob", [*sources, "taxi_zones"], key.dataset)
                if lost and not lost.skipped:
                    r.rows(rejected=lost.rows)
                    lineage.record(self.control, r.run_id, "SilverTransformJob", sources, refused.dataset)
                if not out.skipped:
                    self.control.metrics(r.run_id, {"rows": out.rows, "rejected": lost.rows if lost else 0})
            r.succeeded()
        return out

    def gold(self, silver: DataFrame, zones: DataFrame, folder: str, run_id: str | None = None) -> Mapping[str, int]:
        """Writes the four aggregates and the fact, each as a run's partition, once they add up.

        Each output is computed once, to a hidden folder beside the others; reconciliation
        and the rules read what was written there. Only then do the partitions take their
        places, each with a manifest; lineage follows when all have. A rerun of the same
        run_id replaces its rows. The result has the trips of each output.
        """
        units = self.publisher.units
        with self._run("GoldAggregateJob", folder=folder, run_id=run_id) as r:
            stamp = run_id or r.run_id
            staging = f"{folder}/.staging-{r.run_id}"
            frames = gold.build(silver)
            outputs = {f"agg_{n}": df for n, df in frames.items()} | {"fact_trip": gold.fact(silver, stamp)}
            try:
                for name, df in outputs.items():
                    schema_registry.register(self.control, name, df.drop("etl_run_id").schema, r.run_id)
                    sinks.write_run(df, f"{staging}/{name}", stamp)
                staged = {n: self.spark.read.schema(df.drop("etl_run_id").schema).parquet(f"{staging}/{n}/etl_run_id={stamp}") for n, df in outputs.items()}
                checked = gold.reconcile(staged["fact_trip"], {n: staged[f"agg_{n}"] for n in frames})
                rules = quality_rules.RULES["agg_zone_hourly"]
                quality_rules.gate(staged["agg_zone_hourly"], rules, record=lambda report: self.control.record_report(r.run_id, report, "agg_zone_hourly"))
                rows = {n: df.count() for n, df in staged.items()}
                for name, df in staged.items():
                    unit = Unit(name, "silver_to_gold", stamp)
                    units.force_rebuild(unit)
                    if not units.claim(unit, r.run_id):
                        raise RuntimeError(f"{unit} is being written by another run")
                    sinks.promote_run(self.spark, f"{staging}/{name}", f"{folder}/{name}", stamp)
                    target = f"{folder}/{name}/etl_run_id={stamp}"
                    units.commit(unit, r.run_id, r.run_id, target, fingerprint(target, rows[name], df.schema))
                    units.complete(unit, r.run_id)
            finally:
                sinks.remove(self.spark, staging)
            for name in outputs:
                lineage.record(self.control, r.run_id, "GoldAggregateJob", ["silver_trips"], name)
            written = {n: self.spark.read.parquet(f"{folder}/{n}/etl_run_id={stamp}") for n in ("agg_daily_kpi",)}
            sinks.upsert_sqlite(self.control, "daily_kpi", ("kpi_date", "vendor_name"), gold.serving_kpi(written["agg_daily_kpi"]))
            sinks.upsert_sqlite(self.control, "dim_taxi_zone", ("location_id",), gold.zone_dimension(zones))
            r.rows(written=sum(rows.values()))
            r.succeeded()
        return {n: trips for n, (trips, _) in checked.items()}
