import sqlite3
import threading

import pytest
from fixtures import GOOD, bronze, zones
from hypothesis import given
from hypothesis import strategies as st
from pyspark.sql import types as T

from tessera.config import Config, ConfigError
from tessera.governance import invariants, lineage, metrics, publish
from tessera.governance import schema_registry as sr
from tessera.governance.control import ControlPlane, NotClaimed, run
from tessera.governance.publish import Crash, FailPoint, LeaseLost, Publisher, Unit, Units
from tessera.jobs.medallion import Jobs
from tessera.operators import quality_rules

UNIT = Unit("d", "raw_to_bronze", "2024-01")


@pytest.fixture
def control(tmp_path):
    return ControlPlane(str(tmp_path / "control.db"))


@pytest.fixture
def place(tmp_path):
    return str(tmp_path / "data"), str(tmp_path / "staging")


def struct(*fields):
    return T.StructType([T.StructField(n, t, null) for n, t, null in fields])


I, L, D, S = T.IntegerType(), T.LongType(), T.DoubleType(), T.StringType()


@pytest.mark.parametrize(("old", "new", "change"), [
    (("a", I, True), ("a", L, True), sr.Change.WIDENING),
    (("a", L, True), ("a", I, True), sr.Change.BREAKING),
    (("a", T.FloatType(), True), ("a", D, True), sr.Change.WIDENING),
    (("a", I, True), ("a", D, True), sr.Change.BREAKING),
    (("a", I, False), ("a", I, True), sr.Change.WIDENING),
    (("a", I, True), ("a", I, False), sr.Change.BREAKING),
    (("A", I, True), ("a", I, True), sr.Change.NONE),
    (("a", T.DecimalType(10, 2), True), ("a", T.DecimalType(12, 3), True), sr.Change.WIDENING),
    (("a", T.DecimalType(10, 2), True), ("a", T.DecimalType(10, 3), True), sr.Change.BREAKING),
    (("a", T.ArrayType(I, False), True), ("a", T.ArrayType(I, True), True), sr.Change.WIDENING),
    (("a", T.MapType(I, I), True), ("a", T.MapType(L, I), True), sr.Change.BREAKING),
    (("a", T.MapType(S, I), True), ("a", T.MapType(S, L), True), sr.Change.WIDENING),
    (("a", struct(("x", I, True)), True), ("a", struct(("x", I, True), ("y", S, True)), True), sr.Change.ADDITIVE),
])
def test_type_changes(old, new, change):
    assert sr.compare(struct(old), struct(new)) is change


def test_field_changes():
    base = struct(("a", I, True))
    assert sr.compare(base, struct(("a", I, True), ("b", S, True))) is sr.Change.ADDITIVE
    assert sr.compare(base, struct(("a", I, True), ("b", S, False))) is sr.Change.BREAKING
    assert sr.compare(struct(("a", I, True), ("b", S, True)), base) is sr.Change.BREAKING
    with pytest.raises(ValueError, match="case"):
        sr.canonical(struct(("a", I, True), ("A", I, True)))


TYPES = st.sampled_from([I, L, D, S, T.BooleanType(), T.DecimalType(8, 2), T.ArrayType(I), T.MapType(S, D)])
SCHEMAS = st.dictionaries(st.sampled_from("abcdef"), st.tuples(TYPES, st.booleans()), min_size=1).map(lambda d: struct(*((n, t, x) for n, (t, x) in d.items())))


@given(SCHEMAS)
def test_schema_equals_itself_in_any_order(schema):
    back = T.StructType(list(reversed(schema.fields)))
    assert sr.schema_hash(schema) == sr.schema_hash(back) and sr.compare(schema, back) is sr.Change.NONE


@given(SCHEMAS, SCHEMAS)
def test_hash_differs_just_if_something_changed(a, b):
    assert (sr.schema_hash(a) == sr.schema_hash(b)) == (sr.compare(a, b) is sr.Change.NONE)


def test_registry(control):
    first = struct(("a", I, True))
    assert sr.register(control, "d", first) == sr.Registered(1, sr.Change.NONE, True)
    assert sr.register(control, "d", first).new is False
    assert sr.register(control, "d", struct(("a", L, True), ("b", S, True))).change is sr.Change.WIDENING
    with pytest.raises(sr.SchemaRefused):
        sr.register(control, "d", first)
    with pytest.raises(sr.SchemaRefused):
        sr.register(control, "d", struct(("a", L, True), ("b", S, True), ("c", S, True)), strict=True)
    assert not invariants.broken(control)


def test_registry_names_what_changed(control):
    sr.register(control, "d", struct(("a", I, True), ("b", S, True)))
    sr.register(control, "d", struct(("a", L, True), ("b", S, True), ("c", S, True)))
    assert [tuple(r) for r in control.rows("SELECT added, retyped FROM schema_version ORDER BY version")] == [("[]", "[]"), ('["c"]', '["a"]')]


def test_catalogue(control):
    control.describe("silver_trips", "silver", path="/s", partition_keys=["year", "month"], retention_days=30)
    control.describe("silver_trips", "silver", owner="o")
    row = control.rows("SELECT layer, path, partition_keys, owner, pii, retention_days FROM dataset_catalog")[0]
    assert tuple(row) == ("silver", "/s", '["year", "month"]', "o", "none", 30)


def test_run_bracket(control):
    with run(control, "job") as r:
        r.succeeded()
    with pytest.raises(NotClaimed), run(control, "job"):
        pass
    with pytest.raises(KeyError), run(control, "job") as r:
        r.succeeded()
        raise KeyError("x")
    assert [x["status"] for x in control.rows("SELECT status FROM etl_run ORDER BY rowid")] == ["SUCCESS", "FAILED", "FAILED"]
    assert control.rows("SELECT error_class FROM latest_run")[0][0] == "KeyError"
    assert control.finish_run(r.run_id) is False


@pytest.mark.parametrize("sql", [
    "INSERT INTO etl_run (run_id, job_name, status, started_at) VALUES ('x', 'j', 'FAILED', 't')",
    "INSERT INTO etl_run (run_id, job_name, status, started_at, finished_at, error_class) VALUES ('x', 'j', 'SUCCESS', 't', 't', 'E')",
    "INSERT INTO processing_unit (dataset, stage, unit, status) VALUES ('d', 'raw_to_bronze', 'u', 'RUNNING')",
    "INSERT INTO processing_unit (dataset, stage, unit, status) VALUES ('d', 'elsewhere', 'u', 'PENDING')",
    "INSERT INTO dq_rule (dataset, name, kind, severity, threshold, threshold_kind, null_policy) VALUES ('d', 'n', 'not_null', 'FAIL', 0, 'fraction', 'ignore')",
    "INSERT INTO dq_rule (dataset, name, kind, params, severity, threshold, threshold_kind, null_policy) VALUES ('d', 'n', 'range', '{', 'FAIL', 0, 'fraction', 'pass')",
    "INSERT INTO dq_result VALUES ('absent', 'r', 1, 0, 0, 0, 'd', 'FAIL')",
    "INSERT INTO lineage_edge VALUES (1, 1, 'reads', 'r', NULL)",
    "INSERT INTO dq_rule (dataset, name, kind, severity, threshold, threshold_kind, null_policy) VALUES ('d', 'n', 'not_null', 'FAIL', 1.5, 'count', 'pass')",
    "INSERT INTO dataset_catalog (name, layer) VALUES ('d', 'elsewhere')",
    "INSERT INTO dataset_catalog (name, layer, retention_days) VALUES ('d', 'gold', 0)",
    "INSERT INTO benchmark_run VALUES ('e', 'l', 0, 0, 0.0, 'r', 'i', 1, '{}', 't')",
])
def test_constraints(control, sql):
    with pytest.raises(sqlite3.IntegrityError), control.transaction() as c:
        c.execute(sql)


def test_rules_round_trip(control):
    rules = quality_rules.RULES["silver"]
    control.save_rules("silver", rules)
    control.save_rules("silver", rules)
    assert control.load_rules("silver") == list(rules)


def test_epoch_is_stable(control):
    assert control.epoch("c1") == 1 and control.epoch("c2") == 2 and control.epoch("c1") == 1


def test_lineage(control, spark):
    run_id = control.start_run("job")
    assert lineage.record(control, run_id, "job", ["a", "b"], "c") == 5
    assert lineage.record(control, run_id, "job", ["a", "b"], "c") == 0
    lineage.record(control, run_id, "job2", ["c"], "e")
    assert invariants.broken(control) == ["lineage_of_nothing_committed"]
    assert lineage.upstream(control, "e") == {"a", "b", "c"}
    assert lineage.as_dataframe(spark, control).where("edge = 'derives'").count() == 3
    with pytest.raises(ValueError, match="itself"):
        lineage.record(control, run_id, "job", ["a"], "a")


def publisher(control, place, **more):
    return Publisher(control, *place, **more)


def test_publish_and_skip(control, place, spark):
    p, run_id = publisher(control, place), control.start_run("j")
    first = p.publish(UNIT, run_id, lambda: spark.range(10))
    assert (first.rows, first.skipped) == (10, False) and spark.read.parquet(first.target).count() == 10
    again = p.publish(UNIT, run_id, lambda: pytest.fail("nothing to build"))
    assert again.skipped and again.rows == 10 and invariants.broken(control) == ["published_without_schema"]
    sr.register(control, UNIT.dataset, spark.range(1).schema, run_id)
    assert not invariants.broken(control)


@pytest.mark.parametrize("point", list(FailPoint))
def test_recovers_from_each_crash(control, place, spark, point):
    run_id = control.start_run("j")
    with pytest.raises(Crash):
        publisher(control, place, crash_at=point).publish(UNIT, run_id, lambda: spark.range(10))
    late = publisher(control, place, clock=lambda: __import__("time").time() + 2 * publish.LEASE_S)
    assert publisher(control, place).publish(UNIT, run_id, lambda: spark.range(10)) is None  # the lease still holds
    done = late.publish(UNIT, run_id, lambda: spark.range(10))
    assert done.rows == 10 and spark.read.parquet(done.target).count() == 10
    assert Units(control).state(UNIT)["status"] == "COMPLETE" and invariants.broken(control) == ["published_without_schema"]


@pytest.mark.parametrize("copy", [False, True])
@pytest.mark.parametrize("point", [FailPoint.DURING_PROMOTE, FailPoint.AFTER_PROMOTE])
def test_promotion_leaves_nothing_beside_the_target(control, place, spark, point, copy):
    import os

    run_id = control.start_run("j")
    with pytest.raises(Crash):
        publisher(control, place, crash_at=point, copy=copy).publish(UNIT, run_id, lambda: spark.range(10))
    late = publisher(control, place, clock=lambda: __import__("time").time() + 2 * publish.LEASE_S, copy=copy)
    target = late.publish(UNIT, run_id, lambda: spark.range(10)).target
    os.makedirs(f"{target}/x")  # a target that no longer agrees is replaced, not kept beside
    assert late.publish(Unit("d", "raw_to_bronze", "other"), run_id, lambda: spark.range(5)).rows == 5
    shown = os.path.dirname(target)
    assert sorted(os.listdir(shown)) == ["unit=2024-01", "unit=other"] and spark.read.parquet(shown).count() == 15
    assert not [f for _, _, names in os.walk(place[0] + "/.promote-d") for f in names]


def test_a_worker_that_lost_its_lease_does_not_promote(control, place, spark):
    at = [0.0]
    run_id = control.start_run("j")
    mine, other = (publisher(control, place, clock=lambda: at[0]) for _ in range(2))

    def slow(_):
        at[0] = 11.0
        assert other.publish(UNIT, run_id, lambda: spark.range(7)).rows == 7

    with pytest.raises(LeaseLost):
        mine.publish(UNIT, run_id, lambda: spark.range(10), slow, lease_s=10)
    assert spark.read.parquet(mine.target(UNIT)).count() == 7 and Units(control).state(UNIT)["status"] == "COMPLETE"


def test_a_changed_input_is_published_again(control, place, spark, tmp_path):
    p, run_id, raw = publisher(control, place), control.start_run("j"), str(tmp_path / "raw")
    spark.range(10).write.parquet(raw)
    given = lambda: publish.source_hash(spark.read.parquet(raw))
    before = given()
    assert p.publish(UNIT, run_id, lambda: spark.read.parquet(raw), source=before).rows == 10
    assert p.publish(UNIT, run_id, lambda: pytest.fail("the input is the same"), source=given()).skipped
    spark.range(12).write.mode("overwrite").parquet(raw)
    assert given() != before and p.publish(UNIT, run_id, lambda: spark.read.parquet(raw), source=given()).rows == 12
    assert publish.source_hash(spark.createDataFrame([(1,)], "a int")) is None


def test_runs_that_never_ended_are_aborted(control):
    control.start_run("j", config={"a": 1}, commit_id="abc")
    assert control.abort_stale_runs(3600) == 0 and control.abort_stale_runs(0) == 1
    row = control.rows("SELECT status, config, commit_id FROM etl_run")[0]
    assert tuple(row) == ("ABORTED", '{"a": 1}', "abc") and not invariants.broken(control)


def test_a_blocking_breach_beside_a_commit_is_found(control, place, spark):
    run_id = control.start_run("j")
    publisher(control, place).publish(UNIT, run_id, lambda: spark.range(3))
    sr.register(control, UNIT.dataset, spark.range(1).schema, run_id)
    rule = quality_rules.Rule("r", "range", "id", {"max": 0})
    control.record_report(run_id, quality_rules.evaluate(spark.range(3), [rule]), "d")
    assert invariants.broken(control) == ["committed_despite_blocking_rule"]


def test_corrupt_target_is_rebuilt(control, place, spark):
    p, run_id = publisher(control, place), control.start_run("j")
    target = p.publish(UNIT, run_id, lambda: spark.range(10)).target
    from pathlib import Path

    next(Path(target).glob("*.parquet")).unlink()
    assert p.publish(UNIT, run_id, lambda: spark.range(11)).rows == 11 and spark.read.parquet(target).count() == 11


def test_failed_validation_leaves_no_trace(control, place, spark):
    p, run_id = publisher(control, place), control.start_run("j")

    def refuse(_):
        raise ValueError("no")

    with pytest.raises(ValueError, match="no"):
        p.publish(UNIT, run_id, lambda: spark.range(3), refuse)
    assert Units(control).state(UNIT)["status"] == "FAILED" and Units(control).manifest(UNIT) is None
    assert p.publish(UNIT, run_id, lambda: spark.range(3)).rows == 3
    assert Units(control).state(UNIT)["attempts"] == 2


def test_lost_lease_can_neither_commit_nor_fail(control):
    at = [0.0]
    u, run_id = Units(control, lambda: at[0]), control.start_run("j")
    assert u.claim(UNIT, "a", 10) and not u.claim(UNIT, "b", 10)
    at[0] = 11.0
    assert u.claim(UNIT, "b", 10)
    with pytest.raises(LeaseLost):
        u.commit(UNIT, "a", run_id, "t", publish.Fingerprint(1, 1, 1, "0" * 64, "0" * 64))
    assert u.fail(UNIT, "a", "late") is False and u.force_rebuild(UNIT) is False


def test_one_of_many_claims(control):
    won = []

    def go(i):
        if Units(control).claim(UNIT, f"w{i}"):
            won.append(i)

    threads = [threading.Thread(target=go, args=(i,)) for i in range(8)]
    [t.start() for t in threads]
    [t.join() for t in threads]
    assert len(won) == 1


@given(st.lists(st.sampled_from(["CLAIM", "COMMIT", "FAIL", "EXPIRE", "FORCE_REBUILD"]), max_size=12))
def test_states(events):
    state = "PENDING"
    for e in events:
        try:
            new = publish.next_state(state, e)
        except ValueError:
            continue
        assert not (e == "COMMIT" and state != "RUNNING") and not (state == "RUNNING" and e == "FORCE_REBUILD")
        state = new


def test_staging_cleaner(control, tmp_path, place):
    data, staging = place
    u = Units(control)
    u.claim(UNIT, "live")
    for owner in ("live", "dead"):
        (tmp_path / "staging" / "d" / "s" / "u" / owner).mkdir(parents=True)
    late = lambda: __import__("time").time() + 1000
    assert [g.rsplit("/", 1)[1] for g in publish.clean_staging(control, staging, data, 500, late)] == ["dead"]
    for bad in ("/", str(tmp_path / "data"), str(tmp_path)):
        with pytest.raises(ValueError, match="safe"):
            publish.clean_staging(control, bad, data)


def test_config():
    with pytest.raises(ConfigError) as e:
        Config.load({"TESSERA_DATA_ROOT": "/x", "TESSERA_STAGING_ROOT": "/x/y", "TESSERA_SHUFFLE_PARTITIONS": "no"})
    assert len(e.value.problems) == 3
    c = Config.load({"TESSERA_DATA_ROOT": "/x", "TESSERA_STAGING_ROOT": "/y", "TESSERA_CONTROL_DB": "/z", "TESSERA_KAFKA_PASSWORD": "p"})
    assert c.redacted()["kafka_password"] == "***" and c.shuffle_partitions == 12


def test_task_metrics():
    line = '{"Event":"SparkListenerTaskEnd","Task End Reason":{"Reason":"%s"},"Task Metrics":{"Executor Run Time":5,"Peak Execution Memory":%d,"Shuffle Read Metrics":{"Local Bytes Read":1,"Remote Bytes Read":2}}}'
    got = metrics.task_metrics([line % ("Success", 7), line % ("ExceptionFailure", 9), "broken"])
    assert got["all"]["run_time_ms"] == 10 and got["successful"]["run_time_ms"] == 5
    assert got["all"]["peak_memory_bytes"] == 9 and got["successful"]["shuffle_read_bytes"] == 3


def test_lost_metrics_dont_hide_the_error(control, place, spark, monkeypatch):
    def broken(*_):
        raise OSError("gone")

    monkeypatch.setattr(metrics, "of_group", broken)
    jobs = Jobs(spark, control, publisher(control, place))
    with pytest.raises(KeyError) as e, jobs._run("j"):
        raise KeyError("x")
    assert "gone" in e.value.__notes__[0]
    with pytest.raises(OSError), jobs._run("j") as r:
        r.succeeded()


def test_batch_jobs_end_to_end(control, place, spark, tmp_path):
    for dataset in ("bronze", "silver"):
        control.save_rules(dataset, quality_rules.RULES[dataset])
    jobs = Jobs(spark, control, publisher(control, place), commit_id="c0")
    raw = spark.createDataFrame([("1", "x"), ("?", "2.5")], "VendorID string, fare_amount string")
    assert jobs.bronze(raw, "yellow", "u").rows == 2 and jobs.bronze(raw, "yellow", "u").skipped
    first = control.rows("SELECT run_id, rows_written, config, commit_id FROM etl_run ORDER BY rowid")[0]
    assert (first["rows_written"], first["commit_id"]) == (2, "c0") and '"source": "yellow"' in first["config"]
    told = {m["name"]: m["value"] for m in control.rows("SELECT name, value FROM etl_run_metric WHERE run_id = ?", first["run_id"])}
    assert lineage.columns_of(control, "bronze_yellow")["raw_yellow"]["vendor_id"] == "VendorID"
    assert told["malformed_values"] == 2 and told["tasks"] > 0 and told["run_time_ms"] > 0
    assert {d["severity"] for d in control.rows("SELECT severity FROM dq_result WHERE dataset = 'bronze_yellow'")} == {"WARN"}
    with pytest.raises(quality_rules.GateFailure, match="pickup_ts"):
        Jobs(spark, control, publisher(control, place), block_bronze=True).bronze(raw, "green", "u")
    with pytest.raises(ValueError, match="unknown"):
        jobs.bronze(raw, "Yellow", "u")
    z = zones(spark)
    with pytest.raises(quality_rules.GateFailure, match="silver_distance_plausible"):
        jobs.silver(bronze(spark), z, "u")  # the null distance passes the reasons and blocks here
    rows = bronze(spark).where("trip_distance_mi IS NOT NULL")
    out = jobs.silver(rows, z, "u")
    assert out.rows == len(GOOD) - 1
    silver = spark.read.parquet(out.target)
    lost = spark.read.parquet(f"{place[0]}/silver_rejects/unit=u")
    assert lost.count() == control.rows("SELECT rows_rejected FROM latest_run WHERE job_name = 'SilverTransformJob'")[0][0] > 0
    folder = str(tmp_path / "gold")
    for _ in range(2):  # a rerun replaces its rows
        jobs.gold(silver, z, folder, "run1")
    assert spark.read.parquet(f"{folder}/fact_trip").count() == len(GOOD) - 1
    assert control.rows("SELECT count(*) FROM dim_taxi_zone")[0][0] == 3
    gold_run = control.rows("SELECT run_id FROM latest_run WHERE job_name = 'GoldAggregateJob'")[0][0]
    kinds = [r["edge"] for r in control.rows("SELECT edge FROM lineage WHERE run_id = ?", gold_run)]
    assert (kinds.count("reads"), kinds.count("writes"), kinds.count("derives")) == (1, 5, 5)
    assert not invariants.broken(control)
