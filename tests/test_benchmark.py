import pytest
from pyspark.sql import functions as F

from tessera.benchmark import harness as h
from tessera.governance.control import ControlPlane
from tessera.operators.content_hash import ContentHash


def seen(label, ms, correct=True, source=ContentHash(1, "1", 1)):
    return h.Observation(label, 0, ms, ContentHash(1, "1", 1), source, correct)


def test_statistics():
    s = h.Statistics.of([3, 1, 2])
    assert (s.median, s.mean, s.low, s.high, s.deviation) == (2, 2, 1, 3, 1) and not s.meaningful
    assert h.Statistics.of([5]).deviation == 0
    assert h.improvement(h.Statistics.of([10]), h.Statistics.of([8])) == pytest.approx(0.2)
    with pytest.raises(ValueError):
        h.Statistics.of([])


def test_variants():
    with pytest.raises(ValueError, match="static"):
        h.Variant("x", {"spark.driver.memory": "1g"})
    with pytest.raises(ValueError, match="codec"):
        h.Variant("x", {"spark.sql.parquet.compression.codec": "gzip"})
    steps = h.ladder(h.PLAIN, h.TUNED)
    assert steps[0] is h.PLAIN and dict(steps[-1].settings) == dict(h.TUNED.settings) and len(steps) == 5
    assert len(h.leave_one_out(h.PLAIN, h.TUNED)) == 4


def test_headline_only_if_valid():
    good = h.Report(tuple(seen(x, ms) for x, ms in (("a", 10), ("b", 8)) for _ in range(5)))
    assert good.markdown().startswith("b against a: +20.0%") and good.steps() == [("a", "b", pytest.approx(0.2))]
    assert h.Report((seen("a", 10), seen("b", 8, False))).markdown().startswith("No headline")
    assert "input changed" in h.Report((seen("a", 10), seen("b", 8, True, ContentHash(2, "2", 2)))).markdown()
    assert "not meaningful" in h.Report((seen("a", 10), seen("b", 8))).markdown()


def test_run_resets_settings_and_catches_wrong_results(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    df = spark.range(100).withColumn("k", F.col("id") % 5)
    out = h.run(spark, [h.PLAIN, h.TUNED], df, lambda hint: df.groupBy("k").agg(F.sum("id").alias("s")), iterations=1)
    assert [o.correct for o in out] == [True, True] and spark.conf.get("spark.sql.shuffle.partitions") == before
    out = h.run(spark, [h.PLAIN, h.TUNED], df, lambda hint: df.where(F.lit(not hint)), iterations=1, warmups=0)
    assert {o.label: o.correct for o in out} == {"plain": True, "tuned": False}
    assert h.uses_broadcast(df.join(F.broadcast(df.limit(3)), "k"))


def test_stored_and_summarised(spark, tmp_path):
    control = ControlPlane(str(tmp_path / "c.db"))
    report = h.Report(tuple(seen(h.PLAIN.label, ms) for ms in (1, 2, 4)) + (seen(h.TUNED.label, 1, False),))
    assert h.save(control, "x", report, [h.PLAIN, h.TUNED]) == 4
    got = {r.label: r for r in h.summary(spark, control, "x").collect()}
    assert (got["plain"].median_ms, got["plain"].inputs, got["plain"].all_correct, got["tuned"].all_correct) == (2, 1, True, False)
