import datetime as dt

import pytest

from tessera.operators import quality_rules as q
from tessera.operators.quality_rules import Rule


@pytest.fixture(scope="module")
def df(spark):
    rows = [(1, 5.0, "a", dt.datetime(2024, 1, 10)), (1, None, "b", dt.datetime(2020, 1, 1)), (2, 50.0, None, None), (None, -1.0, "z", dt.datetime(2024, 1, 1)), (1, 7.0, "a", dt.datetime(2024, 1, 2))]
    return spark.createDataFrame(rows, "k int, x double, s string, t timestamp").cache()


AS_OF = dt.datetime(2024, 1, 11)


def judged(df, *rules, **more):
    return [(r.evaluated, r.violated) for r in q.evaluate(df, rules, as_of=AS_OF, **more).results]


@pytest.mark.parametrize(("policy", "expected"), [("violation", (5, 3)), ("pass", (5, 2)), ("ignore", (4, 2))])
def test_range_under_each_policy(df, policy, expected):
    assert judged(df, Rule("r", "range", "x", {"min": 0, "max": 10}, null_policy=policy)) == [expected]


@pytest.mark.parametrize(("policy", "expected"), [("violation", (5, 2)), ("pass", (5, 1)), ("ignore", (4, 1))])
def test_values_expression_freshness(df, policy, expected):
    rules = [
        Rule("v", "accepted_values", "s", {"values": ["a", "b"]}, null_policy=policy),
        Rule("e", "expression", None, {"expression": "s <> 'z'"}, null_policy=policy),
        Rule("f", "freshness", "t", {"days": 30.9}, null_policy=policy),
    ]
    assert judged(df, *rules) == [expected] * 3


def test_other_kinds(df, spark):
    ref = spark.createDataFrame([(1,), (1,)], "id int")
    rules = [
        Rule("n", "not_null", "x"), Rule("u", "unique", "k"), Rule("r", "referential", "k", {"reference": "ref", "key": "id"}),
        Rule("d", "row_count_delta", None, {"max_drop_pct": 0.25}),
    ]
    assert judged(df, *rules, references={"ref": ref}, previous_count=10) == [(5, 1), (4, 2), (4, 1), (10, 5)]
    assert judged(df, rules[3], previous_count=6) == [(6, 0)]
    assert judged(df, rules[3]) == [(5, 0)]


def test_together_as_alone(df):
    rules = [Rule("n", "not_null", "s"), Rule("x", "range", "x", {"max": 10}), Rule("u", "unique", "s"), Rule("e", "expression", None, {"expression": "k = 1"})]
    assert judged(df, *rules) == [judged(df, r)[0] for r in rules]


def test_empty_input(df):
    rules = [Rule("n", "not_null", "s"), Rule("u", "unique", "s")]
    report = q.evaluate(df.limit(0), rules)
    assert [(r.evaluated, r.violated, r.breached) for r in report.results] == [(0, 0, False)] * 2


@pytest.mark.parametrize(("kind", "limit", "bad", "of", "breach"), [
    ("fraction", 0.1, 10, 100, False), ("fraction", 0.1, 11, 100, True), ("count", 3.9, 3, 10, False), ("count", 3, 4, 10, True), ("fraction", 0, 0, 0, False),
    ("fraction", 0.3333333333333333, 1, 3, False),
])
def test_thresholds(kind, limit, bad, of, breach):
    assert Rule("r", "range", "x", threshold=limit, threshold_kind=kind).breached(bad, of) is breach


def test_gate(df):
    recorded = []
    with pytest.raises(q.GateFailure, match="n: 1 of 5"):
        q.gate(df, [Rule("n", "not_null", "x")], record=recorded.append)
    assert recorded and recorded[0].blocked
    assert q.gate(df, [Rule("n", "not_null", "x", severity="WARN")]).warnings
    with pytest.raises(q.RuleError, match="no rules"):
        q.gate(df, [])
    assert q.gate(df, [], require=False).results == ()
    with pytest.raises(q.RuleError, match="absent"):
        q.evaluate(df, [Rule("m", "not_null", "missing")])


@pytest.mark.parametrize("bad", [dict(kind="nope"), dict(kind="not_null", null_policy="ignore"), dict(kind="accepted_values"), dict(kind="expression"), dict(kind="range", column=None), dict(kind="range", severity="BAD")])
def test_bad_rules(bad):
    with pytest.raises(q.RuleError):
        Rule(**({"name": "r", "column": "x"} | bad))


def test_rate_is_clamped():
    assert q.Result(Rule("r", "range", "x"), 2, 5).rate == 1.0
    assert sum(map(len, q.RULES.values())) == 19
