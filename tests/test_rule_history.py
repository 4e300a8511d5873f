import random
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from vigil.operators import rule_history as history
from vigil.operators import rules

START = datetime(2024, 1, 1)


def _rule(name, at, **more):
    rule = rules.create_rule("orders", name, "custom", more.pop("constraint", "x > 0"), now=at)
    return {**rule, **more}


def _replay(states, at):
    """One pass in order of time."""
    held = {}
    for moment, name, constraint, enabled, kind in sorted(states):
        if moment <= at:
            held[name] = None if kind == "delete" or not enabled else constraint
    return {(n, c) for n, c in held.items() if c is not None}


def _log(spark, states):
    named = [_rule(n, at, constraint=c, is_enabled=e) for at, n, c, e, _ in states]
    stated = history.versions(rules.as_rows(spark, named))
    gone = {(at, n) for at, n, _, _, kind in states if kind == "delete"}
    for at, name in gone:
        ends = (stated.changed_at == at) & (stated.expectation_name == name)
        stated = stated.withColumn(
            "change_type",
            F.when(ends, "delete").otherwise(F.col("change_type")),
        )
    return stated


def _states(seed):
    rng = random.Random(seed)
    moments = rng.sample(range(200), 24)
    return [
        (
            START + timedelta(days=day, hours=day % 5),
            rng.choice(["hot", "hot", "a", "b"]),
            f"x > {i}",
            rng.random() < 0.8,
            "delete" if i in (7, 15) else "upsert",
        )
        for i, day in enumerate(moments)
    ]


def test_any_order_of_upserts_equals_a_replay(spark):
    states = _states(1)
    shuffled = random.Random(2).sample(states, len(states)) + states[:5]
    log = _log(spark, shuffled).cache()
    for day in (0, 40, 111, 300):
        at = START + timedelta(days=day, hours=3)
        got = history.in_force(log, at).select("expectation_name", "constraint_expression")
        assert {tuple(r) for r in got.collect()} == _replay(states, at)


def test_facts_are_judged_by_the_rules_of_their_own_time(spark):
    states = _states(3)
    log = _log(spark, states + states[:3])
    facts = [
        (i, "orders", name, START + timedelta(days=day, hours=4), "kept")
        for i, (day, name) in enumerate((d, n) for d in range(0, 230, 7) for n in ("hot", "a", "c"))
    ] + [(900, None, None, START, "kept"), (901, "orders", "hot", None, "kept")]
    schema = "id int, dataset_name string, expectation_name string, at timestamp_ntz, valid_to string"
    got = history.judged(spark.createDataFrame(facts, schema), log, "at").collect()
    assert len(got) == len(facts)
    want = {
        i: dict(_replay(states, at)).get(name) if name and at else None
        for i, _, name, at, _ in facts
    }
    assert {r.id: r.rule and r.rule.constraint_expression for r in got} == want
    assert {r.valid_to for r in got} == {"kept"}
    assert any(want.values()) and not all(want.values())


def test_intervals_meet_without_gap_or_overlap(spark):
    states = _states(5)
    spans = history.intervals(_log(spark, states)).collect()
    of = {}
    for span in spans:
        ends = span.valid_to or datetime.max
        of.setdefault(span.expectation_name, []).append((span.valid_from, ends))
    assert sum(map(len, of.values())) == len(states)
    for ordered in map(sorted, of.values()):
        assert [to for _, to in ordered] == [start for start, _ in ordered[1:]] + [datetime.max]


def test_snapshots_become_changes_and_the_audit_period_keeps_what_holds(spark):
    first = rules.as_rows(spark, [_rule("a", START), _rule("b", START)])
    second = rules.as_rows(spark, [_rule("a", START, severity="low"), _rule("c", START)])
    later = START + timedelta(days=500)
    log = history.versions(first).unionByName(history.changes(first, second, later))
    assert {(r.expectation_name, r.severity) for r in history.in_force(log, later).collect()} == {
        ("a", "low"), ("c", "medium"),
    }
    kept = history.trimmed(log, later + timedelta(days=100), days=365)
    assert kept.count() == log.count()
    kept = history.trimmed(log, later + timedelta(days=400), days=365)
    assert {(r.expectation_name, r.severity) for r in kept.collect()} == {("a", "low"), ("c", "medium")}


def test_an_empty_log_judges_nothing(spark):
    log = history.versions(rules.as_rows(spark, []))
    facts = spark.sql("SELECT 'orders' dataset_name, 'a' expectation_name, timestamp_ntz'2024-01-01' at")
    assert history.in_force(log, START).count() == 0
    assert [r.rule for r in history.judged(facts, log, "at").collect()] == [None]
