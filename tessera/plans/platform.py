"""Queries whose rows are the records of publishing, runs, rules, schemas, lineage and the benchmark.

Each works on a control plane and folders of its own, over the star-schema tables.
"""

from __future__ import annotations

import os
import time

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.benchmark import harness
from tessera.config import Config, ConfigError
from tessera.governance import invariants, lineage, metrics, publish
from tessera.governance import schema_registry as schemas
from tessera.governance.control import ControlPlane, NotClaimed, run
from tessera.governance.publish import Crash, FailPoint, Publisher, Unit, Units, clean_staging
from tessera.jobs.medallion import Jobs
from tessera.operators.content_hash import content_hash
from tessera.operators.quality_rules import RULES, GateFailure
from tessera.plans.registry import query
from tessera.plans.trips import SILVER_SQL, raw_trips, work_folder, zones
from tessera.session import table


def _values(rows: list[tuple], *names: str) -> str:
    """SQL that gives the rows."""
    text = ", ".join("(" + ", ".join("NULL" if v is None else str(v).lower() if isinstance(v, bool) else f"'{v}'" if isinstance(v, str) else f"{v!r}" for v in r) + ")" for r in rows)
    return f"SELECT * FROM (VALUES {text}) r({', '.join(names)})"


def _plane(spark, name: str) -> tuple[str, ControlPlane, Publisher]:
    folder = work_folder(spark, name)
    control = ControlPlane(f"{folder}/control.db")
    return folder, control, Publisher(control, f"{folder}/data", f"{folder}/staging")


LATER = 2 * publish.LEASE_S


@query("""SELECT o_orderstatus AS unit, count(*) AS rows, 'COMPLETE' AS status, CAST(1 AS BIGINT) AS attempts, true AS skipped_again, true AS readable FROM orders GROUP BY 1""")
def published_units(spark, d):
    """Units published, published again (skipped by their manifest), and read back."""
    _, control, publisher = _plane(spark, "publish")
    orders = table(spark, d, "orders").select("o_orderkey", "o_orderstatus")
    run_id, rows = control.start_run("publish"), []
    for status in [r[0] for r in orders.select("o_orderstatus").distinct().collect()]:
        unit = Unit("orders", "raw_to_bronze", status)
        build = lambda status=status: orders.where(F.col("o_orderstatus") == status)
        first, again = publisher.publish(unit, run_id, build), publisher.publish(unit, run_id, build)
        state = Units(control).state(unit)
        rows.append((status, again.rows, state["status"], state["attempts"], again.skipped and not first.skipped, spark.read.parquet(first.target).count() == first.rows))
    return spark.createDataFrame(rows, "unit string, rows long, status string, attempts long, skipped_again boolean, readable boolean")


@query("SELECT point, 'COMPLETE' AS status, n AS rows, CAST(2 AS BIGINT) AS attempts, false AS litter FROM (" + _values([(p.value,) for p in FailPoint], "point") + "), (SELECT count(*) AS n FROM nation)")
def crash_recovery(spark, d):
    """A crash at each point of the protocol, and the attempt after it, once the lease has run out."""
    rows = []
    for point in FailPoint:
        folder, control, publisher = _plane(spark, "crash")
        unit, run_id, build = Unit("nation", "raw_to_bronze", "u"), control.start_run("crash"), lambda: table(spark, d, "nation")
        publisher.crash_at = point
        try:
            publisher.publish(unit, run_id, build)
        except Crash:
            pass
        late = Publisher(control, f"{folder}/data", f"{folder}/staging", clock=lambda: time.time() + LATER)
        done = late.publish(unit, run_id, build)
        state = Units(control).state(unit)
        rows.append((point.value, state["status"], done.rows, state["attempts"], os.listdir(os.path.dirname(done.target)) != ["unit=u"]))
    return spark.createDataFrame(rows, "point string, status string, rows long, attempts long, litter boolean")


OUTCOMES = [("nothing", "FRESH"), ("committed", "COMMITTED"), ("files alone", "ORPHANED"), ("files differ", "INCONSISTENT")]


@query(_values(OUTCOMES, "found", "outcome"))
def reconcile_outcomes(spark, d):
    """What an attempt finds of earlier ones: manifest and files, either, neither."""
    rows = []
    for found, _ in OUTCOMES:
        _, control, publisher = _plane(spark, "outcome")
        unit, run_id = Unit("nation", "raw_to_bronze", "u"), control.start_run("outcome")
        if found in ("committed", "files differ"):
            target = publisher.publish(unit, run_id, lambda: table(spark, d, "nation")).target
            if found == "files differ":
                next(os.path.join(target, f) for f in os.listdir(target) if f.endswith(".parquet"))
                table(spark, d, "region").write.mode("overwrite").parquet(target)
            with control.transaction() as c:
                c.execute("UPDATE processing_unit SET status = 'FAILED'")
        elif found == "files alone":
            table(spark, d, "nation").write.parquet(publisher.target(unit))
        publisher.units.claim(unit, "w")
        rows.append((found, publisher.reconcile(unit, "w").name))
    return spark.createDataFrame(rows, "found string, outcome string")


@query("SELECT state, event, outcome FROM (" + _values(
    [(s, e, publish.TRANSITIONS.get((s, e), "refused")) for s in ("PENDING", "RUNNING", "COMPLETE", "FAILED") for e in ("CLAIM", "COMMIT", "FAIL", "EXPIRE", "FORCE_REBUILD")], "state", "event", "outcome") + ")")
def unit_states(spark, d):
    """Each event in each state of a unit, as the records of units take it."""
    rows = []
    for state in ("PENDING", "RUNNING", "COMPLETE", "FAILED"):
        for event in ("CLAIM", "COMMIT", "FAIL", "EXPIRE", "FORCE_REBUILD"):
            try:
                rows.append((state, event, publish.next_state(state, event)))
            except ValueError:
                rows.append((state, event, "refused"))
    return spark.createDataFrame(rows, "state string, event string, outcome string")


LEASES = [("first claim", True), ("claim while held", False), ("late failure of the first", False), ("claim of an expired lease", True), ("rebuild while held", False), ("failure by the holder", True),
          ("claim of a failed unit", True), ("completion without a manifest", False)]


@query(_values(LEASES, "step", "done"))
def unit_leases(spark, d):
    """Claims, failures, rebuilds and completions of one unit by two workers."""
    at = [0.0]
    control = ControlPlane(":memory:")
    units, unit = Units(control, lambda: at[0]), Unit("d", "raw_to_bronze", "u")
    out = [units.claim(unit, "a", 10), units.claim(unit, "b", 10)]
    at[0] = 11.0
    won = units.claim(unit, "b", 10)
    out += [units.fail(unit, "a", "late"), won, units.force_rebuild(unit), units.fail(unit, "b", "mine"), units.claim(unit, "a", 10)]
    try:
        units.complete(unit, "a")
        out.append(True)
    except publish.LeaseLost:
        out.append(False)
    return spark.createDataFrame([(step, bool(x)) for (step, _), x in zip(LEASES, out, strict=True)], "step string, done boolean")


@query("SELECT 'nation' AS name, count(*) AS rows, CAST(1 AS BIGINT) AS files, CAST(64 AS BIGINT) AS digits, true AS repeatable FROM nation")
def folder_fingerprint(spark, d):
    """Rows, files, and the hashes of schema and names of a written folder; markers don't count."""
    folder = work_folder(spark, "print")
    rows = table(spark, d, "nation").coalesce(1)
    rows.write.parquet(f"{folder}/n")
    first, again = (publish.fingerprint(f"{folder}/n", rows.count(), rows.schema) for _ in range(2))
    return spark.createDataFrame([("nation", first.rows, first.files, len(first.content_hash), first == again and first.bytes > 0)], "name string, rows long, files long, digits long, repeatable boolean")


@query(_values([("live",), ("young",)], "kept"))
def staging_cleaner(spark, d):
    """Attempt folders that stay when old ones without a lease are cleaned; unsafe roots are refused."""
    folder, control, publisher = _plane(spark, "clean")
    publisher.units.claim(Unit("d", "raw_to_bronze", "u"), "live", 10 * LATER)
    for owner in ("live", "old", "young"):
        os.makedirs(f"{folder}/staging/d/raw_to_bronze/u/{owner}")
    for owner in ("live", "old"):
        os.utime(f"{folder}/staging/d/raw_to_bronze/u/{owner}", (time.time() - LATER,) * 2)
    clean_staging(control, f"{folder}/staging", f"{folder}/data", LATER / 2)
    for bad in ("/", f"{folder}/data", folder):
        try:
            clean_staging(control, bad, f"{folder}/data")
            raise AssertionError(f"{bad} was cleaned")
        except ValueError:
            pass
    return spark.createDataFrame([(x,) for x in os.listdir(f"{folder}/staging/d/raw_to_bronze/u")], "kept string")


# -- jobs ------------------------------------------------------------------------------


def _run_jobs(spark, d):
    """Raw trips of two sources through bronze, silver and gold; twice, so that the second run skips what is committed."""
    folder, control, publisher = _plane(spark, "jobs")
    for dataset in ("bronze", "silver"):
        control.save_rules(dataset, RULES[dataset])
    jobs, raw = Jobs(spark, control, publisher, commit_id="c0"), raw_trips(spark, d).where("trip_distance IS NOT NULL")
    given = {}
    for source, prefix, test in (("yellow", "tpep", "o_orderstatus = 'F'"), ("green", "lpep", "o_orderstatus <> 'F'")):
        raw.where(test).withColumnsRenamed({"start": f"{prefix}_pickup_datetime", "end": f"{prefix}_dropoff_datetime"}).drop("o_orderstatus").write.parquet(f"{folder}/raw_{source}")
        given[source] = spark.read.parquet(f"{folder}/raw_{source}")
    for _ in range(2):
        units = [jobs.bronze(df, source, "all") for source, df in given.items()]
        out = jobs.silver(spark.read.parquet(*[u.target for u in units]), zones(spark, d), "all")
        jobs.gold(spark.read.parquet(out.target), zones(spark, d), f"{folder}/gold", "g1")
    return folder, control


@query(f"""WITH {SILVER_SQL.replace("FROM lineitem JOIN orders ON l_orderkey = o_orderkey", "FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE NOT l_partkey % 50 = 3")}, n AS (SELECT (SELECT count(*) FROM bronze WHERE source = 'yellow') AS y, (SELECT count(*) FROM bronze WHERE source = 'green') AS g,
  (SELECT count(*) FROM silver) AS s, (SELECT count(*) FROM judged WHERE reason IS NOT NULL) AS r)
SELECT dataset, stage, CAST(rows AS BIGINT) AS rows, status FROM (
  SELECT 'bronze_yellow' AS dataset, 'raw_to_bronze' AS stage, y AS rows, 'COMPLETE' AS status FROM n UNION ALL SELECT 'bronze_green', 'raw_to_bronze', g, 'COMPLETE' FROM n
  UNION ALL SELECT 'silver_trips', 'bronze_to_silver', s, 'COMPLETE' FROM n UNION ALL SELECT 'silver_rejects', 'bronze_to_silver', r, 'COMPLETE' FROM n UNION ALL SELECT 'fact_trip', 'silver_to_gold', s, 'COMPLETE' FROM n)""")
def job_manifests(spark, d):
    """The committed units of the batch jobs, run twice, with their rows; the hourly aggregates are left to their own queries."""
    _, control = _run_jobs(spark, d)
    assert not invariants.broken(control), invariants.broken(control)
    rows = control.rows("SELECT dataset, stage, rows, status FROM committed_unit WHERE dataset NOT LIKE 'agg%'")
    return spark.createDataFrame([tuple(r) for r in rows], "dataset string, stage string, rows long, status string")


EDGES = [("dataset", f"raw_{s}", "reads", "job", "BronzeIngestJob") for s in ("yellow", "green")] + [("job", "BronzeIngestJob", "writes", "dataset", f"bronze_{s}") for s in ("yellow", "green")]
EDGES += [("dataset", f"raw_{s}", "derives", "dataset", f"bronze_{s}") for s in ("yellow", "green")]
for _target, _sources in (("silver_trips", ("bronze_yellow", "bronze_green", "taxi_zones")), ("silver_rejects", ("bronze_yellow", "bronze_green"))):
    EDGES += [("dataset", s, "derives", "dataset", _target) for s in _sources] + [("job", "SilverTransformJob", "writes", "dataset", _target)]
EDGES += [("dataset", s, "reads", "job", "SilverTransformJob") for s in ("bronze_yellow", "bronze_green", "taxi_zones")] + [("dataset", "silver_trips", "reads", "job", "GoldAggregateJob")]
for _target in ("agg_zone_hourly", "agg_borough_od", "agg_payment_daily", "agg_daily_kpi", "fact_trip"):
    EDGES += [("dataset", "silver_trips", "derives", "dataset", _target), ("job", "GoldAggregateJob", "writes", "dataset", _target)]


@query(_values(EDGES, "source_kind", "source", "edge", "target_kind", "target"))
def job_lineage(spark, d):
    """The lineage that the batch jobs record, each edge once."""
    _, control = _run_jobs(spark, d)
    return lineage.as_dataframe(spark, control).drop("run_id").distinct()


@query(_values([(job, "SUCCESS", 2 if job != "BronzeIngestJob" else 4, "c0", True, True) for job in ("BronzeIngestJob", "SilverTransformJob", "GoldAggregateJob")], "job_name", "status", "runs", "commit_id", "configured", "measured"))
def job_runs(spark, d):
    """The run registry after the batch jobs: states, configuration, version of the code, task metrics."""
    _, control = _run_jobs(spark, d)
    rows = control.rows("""SELECT job_name, status, count(*) AS runs, max(commit_id) AS commit_id, min(config IS NOT NULL) AS configured,
      min(EXISTS (SELECT 1 FROM etl_run_metric m WHERE m.run_id = r.run_id AND m.name = 'tasks')) AS measured FROM etl_run r GROUP BY 1, 2""")
    return spark.createDataFrame([(*tuple(r)[:4], bool(r["configured"]), bool(r["measured"])) for r in rows], "job_name string, status string, runs int, commit_id string, configured boolean, measured boolean")


@query(_values([(n, 0) for n in invariants.INVARIANTS], "invariant", "broken"))
def global_invariants(spark, d):
    """Each invariant of the control plane after the batch jobs: how many records break it."""
    _, control = _run_jobs(spark, d)
    return spark.createDataFrame([(n, len(control.rows(sql))) for n, sql in invariants.INVARIANTS.items()], "invariant string, broken int")


@query(_values([("claimed", "SUCCESS", None), ("not claimed", "FAILED", "NotClaimed"), ("raised", "FAILED", "KeyError"), ("blocked", "FAILED", "GateFailure"), ("left", "ABORTED", None)], "ended", "status", "error_class"))
def run_brackets(spark, d):
    """How runs end: by claiming success, without it, by an error, by a blocking rule, by a driver that went away."""
    from tessera.operators.quality_rules import Rule, gate

    control = ControlPlane(":memory:")

    def raised(r):
        r.succeeded()
        raise KeyError("x")

    def blocked(r):
        gate(table(spark, d, "nation"), [Rule("none", "range", "n_nationkey", {"max": -1})], record=lambda report: control.record_report(r.run_id, report, "nation"))

    for name, body in (("claimed", lambda r: r.succeeded()), ("not claimed", lambda r: None), ("raised", raised), ("blocked", blocked)):
        try:
            with run(control, name) as r:
                body(r)
        except (NotClaimed, KeyError, GateFailure):
            pass
    control.start_run("left")
    control.abort_stale_runs(0)
    assert control.rows("SELECT dq_checks, dq_failed FROM latest_run WHERE job_name = 'blocked'")[0]["dq_failed"] == 1
    return spark.createDataFrame([tuple(r) for r in control.rows("SELECT job_name, status, error_class FROM etl_run")], "ended string, status string, error_class string")


@query("SELECT CAST(1 AS BIGINT) AS groups, true AS read_all_rows, true AS has_tasks")
def run_metrics(spark, d):
    """Task metrics of a group of jobs, from the session's status store."""
    rows = table(spark, d, "lineitem")
    with metrics.job_group(spark, name := f"metrics-{time.time_ns()}"):
        n = rows.groupBy("l_returnflag").agg(F.sum("l_tax")).collect() and rows.count()
    told = metrics.of_group(spark, name)
    return spark.createDataFrame([(1, told["input_rows"] >= n, told["tasks"] > 0 and told["run_time_ms"] > 0)], "groups long, read_all_rows boolean, has_tasks boolean")


# -- schemas ---------------------------------------------------------------------------

_I, _L, _D, _S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()
_of = lambda *fields: T.StructType([T.StructField(n, t, null) for n, t, null in fields])
CHANGES = {
    "same": (_of(("a", _I, True)), _of(("A", _I, True)), "NONE"), "int to long": (_of(("a", _I, True)), _of(("a", _L, True)), "WIDENING"), "long to int": (_of(("a", _L, True)), _of(("a", _I, True)), "BREAKING"),
    "int to double": (_of(("a", _I, True)), _of(("a", _D, True)), "BREAKING"), "float to double": (_of(("a", T.FloatType(), True)), _of(("a", _D, True)), "WIDENING"),
    "decimal grows": (_of(("a", T.DecimalType(10, 2), True)), _of(("a", T.DecimalType(12, 3), True)), "WIDENING"), "decimal loses digits": (_of(("a", T.DecimalType(10, 2), True)), _of(("a", T.DecimalType(10, 3), True)), "BREAKING"),
    "required to optional": (_of(("a", _I, False)), _of(("a", _I, True)), "WIDENING"), "optional to required": (_of(("a", _I, True)), _of(("a", _I, False)), "BREAKING"),
    "optional added": (_of(("a", _I, True)), _of(("a", _I, True), ("b", _S, True)), "ADDITIVE"), "required added": (_of(("a", _I, True)), _of(("a", _I, True), ("b", _S, False)), "BREAKING"),
    "removed": (_of(("a", _I, True), ("b", _S, True)), _of(("a", _I, True)), "BREAKING"), "array element": (_of(("a", T.ArrayType(_I), True)), _of(("a", T.ArrayType(_L), True)), "WIDENING"),
    "map key": (_of(("a", T.MapType(_I, _I), True)), _of(("a", T.MapType(_L, _I), True)), "BREAKING"), "map value": (_of(("a", T.MapType(_S, _I), True)), _of(("a", T.MapType(_S, _L), True)), "WIDENING"),
    "in a struct": (_of(("a", _of(("x", _I, True)), True)), _of(("a", _of(("x", _I, True), ("y", _S, True)), True)), "ADDITIVE"),
}


@query(_values([(n, x[2]) for n, x in CHANGES.items()], "change", "kind"))
def schema_changes(spark, d):
    """Kinds of schema changes, as the registry classes them."""
    return spark.createDataFrame([(n, schemas.compare(old, new).name) for n, (old, new, _) in CHANGES.items()], "change string, kind string")


@query(_values([(1, "INITIAL"), (2, "ADDITIVE"), (3, "WIDENING")], "version", "change"))
def schema_versions(spark, d):
    """A dataset's history in the registry: equal schemas make no version, breaking ones and, if it is strict, any others are refused."""
    control = ControlPlane(":memory:")
    first, more, wider = _of(("a", _I, True)), _of(("a", _I, True), ("b", _I, True)), _of(("a", _I, True), ("b", _L, True))
    for schema in (first, first, more, wider, wider):
        schemas.register(control, "d", schema)
    for refused, strict in ((first, False), (_of(("a", _I, True), ("b", _L, True), ("c", _S, True)), True)):
        try:
            schemas.register(control, "d", refused, strict=strict)
            raise AssertionError("a refused schema was registered")
        except schemas.SchemaRefused:
            pass
    rows = control.rows("SELECT version, change FROM schema_version ORDER BY version")
    return spark.createDataFrame([tuple(r) for r in rows], "version int, change string")


@query(_values([("c1", 1), ("c2", 2), ("c1", 1)], "checkpoint", "epoch"))
def stream_epochs(spark, d):
    """Epochs of checkpoints: allocated once, the same ever after."""
    control = ControlPlane(":memory:")
    return spark.createDataFrame([(c, control.epoch(c)) for c in ("c1", "c2", "c1")], "checkpoint string, epoch int")


@query(_values([("problems", "3"), ("password", "***"), ("partitions", "12")], "name", "value"))
def configuration(spark, d):
    """All problems of a configuration at once, its defaults, and its form without secrets."""
    try:
        Config.load({"TESSERA_DATA_ROOT": "/x", "TESSERA_STAGING_ROOT": "/x/y", "TESSERA_SHUFFLE_PARTITIONS": "no"})
        raise AssertionError("a wrong configuration was taken")
    except ConfigError as e:
        problems = len(e.problems)
    c = Config.load({"TESSERA_DATA_ROOT": "/x", "TESSERA_STAGING_ROOT": "/y", "TESSERA_CONTROL_DB": "/z", "TESSERA_KAFKA_PASSWORD": "p"})
    return spark.createDataFrame([("problems", str(problems)), ("password", c.redacted()["kafka_password"]), ("partitions", str(c.shuffle_partitions))], "name string, value string")


# -- benchmark -------------------------------------------------------------------------

STEPS = [v.label for v in harness.ladder(harness.PLAIN, harness.TUNED)]
LEFT_OUT = [v.label for v in harness.leave_one_out(harness.PLAIN, harness.TUNED)]


@query(_values([("ladder", i, n) for i, n in enumerate(["plain", "B1_partitions", "B2_enabled", "B3_maxPartitionBytes", "tuned"])] + [("without", i, n) for i, n in enumerate(["L_partitions", "L_enabled", "L_maxPartitionBytes", "L_hint"])], "kind", "step", "label"))
def benchmark_variants(spark, d):
    """The steps from the plain to the tuned configuration, and the tuned one without each of its settings."""
    rows = [("ladder", i, n) for i, n in enumerate(STEPS)] + [("without", i, n) for i, n in enumerate(LEFT_OUT)]
    return spark.createDataFrame(rows, "kind string, step int, label string")


@query("""
WITH o AS (SELECT n_nationkey % 2 AS k, n_nationkey + 10.0::DOUBLE AS ms FROM nation)
SELECT CASE k WHEN 0 THEN 'base' ELSE 'other' END AS label, CAST(k AS INT) AS step, count(*) AS n, round(quantile_cont(ms, 0.5), 6) AS median_ms, round(avg(ms), 6) AS mean_ms, min(ms) AS min_ms, max(ms) AS max_ms,
  round(stddev_samp(ms), 6) AS sd_ms, CAST(1 AS BIGINT) AS inputs, true AS all_correct FROM o GROUP BY k""")
def benchmark_summary(spark, d):
    """Observations kept in the control plane, summarised by label: exact medians, sample deviations, distinct inputs."""
    control, nation = ControlPlane(":memory:"), table(spark, d, "nation")
    h = content_hash(nation)
    ms = [(r[0] % 2, float(r[0]) + 10) for r in nation.select("n_nationkey").collect()]
    seen = [harness.Observation(("base", "other")[k], i, x, h, h, True) for i, (k, x) in enumerate(ms)]
    harness.save(control, "e", harness.Report(tuple(seen)), [harness.Variant("base"), harness.Variant("other")])
    out = harness.summary(spark, control, "e")
    stats = {n: harness.Report(tuple(seen)).stats(n) for n in ("base", "other")}
    assert all(abs(r.median_ms - stats[r.label].median) < 1e-9 and abs(r.sd_ms - stats[r.label].deviation) < 1e-9 for r in out.collect())
    return out.withColumns({n: F.round(n, 6) for n in ("median_ms", "mean_ms", "sd_ms")})


@query(_values([("valid run", True, False), ("another result", False, True), ("another input", False, True)], "what", "headline", "refused"))
def benchmark_reports(spark, d):
    """Reports that have a headline, and those that are refused one: a wrong result, an input that changed."""
    a, b = content_hash(table(spark, d, "nation")), content_hash(table(spark, d, "region"))
    see = lambda label, i, ms, source=a, good=True: harness.Observation(label, i, ms, a, source, good)
    base = [see("base", i, 10.0 + i) for i in range(5)]
    cases = {"valid run": [see("other", i, 5.0 + i) for i in range(5)], "another result": [see("other", 0, 5.0, good=False)], "another input": [see("other", 0, 5.0, source=b)]}
    rows = []
    for what, more in cases.items():
        text = harness.Report((*base, *more)).markdown()
        rows.append((what, "in medians" in text, text.startswith("No headline")))
    step = harness.Report((*base, *cases["valid run"])).steps()
    assert len(step) == 1 and step[0][:2] == ("base", "other") and abs(step[0][2] - 5 / 12) < 1e-9
    return spark.createDataFrame(rows, "what string, headline boolean, refused boolean")


@query("SELECT label, n AS iterations, true AS correct, true AS broadcast FROM (" + _values([("plain",), ("tuned",)], "label") + "), (SELECT CAST(2 AS INT) AS n)")
def benchmark_run(spark, d):
    """The harness over trips: warm-up, alternating runs, results and input checked, and the plan's evidence of its hint."""
    from tessera.operators import gold
    from tessera.plans.trips import silver

    source, places = silver(spark, d).persist(), zones(spark, d)
    try:
        work = lambda hint: gold.workload(source, places, (1995, 1996), hint)
        seen = harness.run(spark, [harness.PLAIN, harness.TUNED], source, work, iterations=2)
        used = harness.uses_broadcast(work(True))
    finally:
        source.unpersist()
    report = harness.Report(tuple(seen))
    assert not report.problems
    return spark.createDataFrame([(n, report.stats(n).n, all(o.correct for o in seen if o.label == n), used) for n in report.labels], "label string, iterations int, correct boolean, broadcast boolean")
