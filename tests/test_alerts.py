import random
from datetime import datetime, timedelta

import pytest

from vigil.operators import alerts
from vigil.schemas import ALERT_HISTORY
from vigil.settings import DEFAULTS, Channel, Delivery

START = datetime(2024, 1, 1)


def _history(spark, raised):
    data = [
        (f"a{i:05d}", kind, severity, f"m{i}", {}, at, None, "active", [])
        for i, (kind, severity, at) in enumerate(raised)
    ]
    return spark.createDataFrame(data, ALERT_HISTORY)


def _fold(raised, cooldown, per_hour):
    """One pass in order, as a person would send."""
    rows = sorted(
        (at.replace(microsecond=0), kind, at, f"a{i:05d}")
        for i, (kind, severity, at) in enumerate(raised)
        if severity == "critical"
    )
    last, cooled = {}, []
    for second, kind, at, name in rows:
        if kind not in last or second - last[kind] >= cooldown:
            last[kind] = second
            cooled.append((second, kind, name))
    used, sent = {}, set()
    for second, kind, name in sorted(cooled):
        hour = second.replace(minute=0, second=0)
        if used.get(hour, 0) < per_hour:
            used[hour] = used.get(hour, 0) + 1
            sent.add(name)
    return sent


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_outbox_equals_the_fold(spark, seed):
    rng = random.Random(seed)
    raised = [
        (
            "hot" if i % 3 == 0 else f"t{rng.randrange(6)}",
            rng.choice(["critical", "critical", "warning"]),
            START + timedelta(seconds=rng.randrange(6 * 3600), microseconds=rng.randrange(10**6)),
        )
        for i in range(600)
    ]
    delivery = Delivery(
        (Channel("email", True), Channel("slack", False)), max_per_hour=3, cooldown_minutes=25
    )
    got = alerts.outbox(_history(spark, raised), delivery).collect()
    short = alerts.outbox(_history(spark, raised), delivery, walk_seconds=5000).collect()
    assert sorted(short) == sorted(got)
    assert {r.channel for r in got} == {"email"}
    assert {r.alert_id for r in got} == _fold(raised, timedelta(minutes=25), 3)


def test_history_ids_are_stable(spark):
    df = spark.createDataFrame(
        [("cost", "critical", "m", {}, START)],
        "alert_type string, severity string, message string, details map<string,string>, "
        "triggered_at timestamp_ntz",
    )
    one = alerts.history_rows(df, ["email"]).first()
    assert one == alerts.history_rows(df, ["email"]).first()
    assert one.status == "active" and one.notified_channels == ["email"]


def test_no_runs_means_no_failure_alert(spark):
    runs = spark.createDataFrame([], "start_time timestamp_ntz, result_state string")
    assert alerts.job_failure_rate(runs, START).collect() == []


def test_settings_overlay():
    changed = DEFAULTS.overlay({"cost": {"absolute_cost": 5.0}, "drift_threshold": 0.3})
    assert changed.cost.absolute_cost == 5.0 and DEFAULTS.cost.absolute_cost == 1000.0
    assert changed.table("alerts") == "main.monitoring.alerts"
    with pytest.raises(ValueError):
        DEFAULTS.overlay({"costs": {}})


def test_cooldown_is_kept_per_subject_and_between_runs(spark):
    def raised(minutes):
        return [
            (f"a{p}{m}", "stale", "critical", "m", {"pipeline": p}, START + timedelta(minutes=m),
             None, "active", [])
            for p in "ABC" for m in minutes
        ]

    delivery = Delivery((Channel("email", True),), max_per_hour=5, cooldown_minutes=60)
    first = alerts.outcomes(spark.createDataFrame(raised([0, 10]), ALERT_HISTORY), delivery)
    fate = {r.alert_id: r.outcome for r in first.collect()}
    assert fate == {f"a{p}0": "sent" for p in "ABC"} | {f"a{p}10": "cooled_down" for p in "ABC"}

    sent = first.filter("outcome = 'sent'")
    later = spark.createDataFrame(raised([20, 59, 61]), ALERT_HISTORY)
    second = {r.alert_id: r.outcome for r in alerts.outcomes(later, delivery, sent=sent).collect()}
    assert {k: v for k, v in second.items() if v == "sent"} == {f"a{p}61": "sent" for p in "ABC"}
    assert set(second.values()) == {"sent", "cooled_down"}

    narrow = Delivery((Channel("email", True),), max_per_hour=4, cooldown_minutes=5)
    third = alerts.outcomes(
        spark.createDataFrame(raised([30]), ALERT_HISTORY), narrow, sent=sent
    )
    assert sorted(r.outcome for r in third.collect()) == ["over_limit", "over_limit", "sent"]


def test_one_recovered_pipeline_is_resolved(spark):
    def stale(names):
        return spark.createDataFrame(
            [(n, "stale", "critical", "m", {"pipeline": n}, START, None, "active", [])
             for n in names], ALERT_HISTORY,
        )

    got = {r.alert_id: r.status for r in alerts.resolved(stale("AB"), stale("B"), START).collect()}
    assert got == {"A": "resolved", "B": "active"}


def test_a_run_that_never_ends_is_late(spark):
    runs = spark.createDataFrame(
        [(1, "j", 7, START, None, None), (2, "k", 8, START, START + timedelta(minutes=5), 300)],
        "job_id long, job_name string, run_id long, start_time timestamp_ntz, "
        "end_time timestamp_ntz, duration_seconds long",
    )
    got = alerts.sla(runs, START + timedelta(hours=24)).collect()
    assert [r.message for r in got] == ["j run 7 took 1440 minutes (limit 120)"]


def test_an_hour_of_many_subjects_is_ranked_in_parts(spark):
    """Every subject raises one alert in the same hour; no task ranks more than its share."""
    n = 40_000
    raised = spark.range(n).selectExpr(
        "concat('a', lpad(id, 7, '0')) AS alert_id", "'stale' AS alert_type",
        "'critical' AS severity", "'m' AS message", "map('dataset_name', 'd' || id) AS details",
        "timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, (n0 % 3000)) AS triggered_at"
        .replace("n0", "id"),
        "CAST(NULL AS timestamp_ntz) AS resolved_at", "'active' AS status",
        "CAST(array() AS array<string>) AS channels",
    ).toDF(*ALERT_HISTORY.fieldNames())
    delivery = Delivery((Channel("email", True),), max_per_hour=5, cooldown_minutes=60)
    got = alerts.outcomes(raised, delivery)
    counts = {r.outcome: r["count"] for r in got.groupBy("outcome").count().collect()}
    assert counts == {"sent": 5, "over_limit": n - 5}
    sent = {r.alert_id for r in got.filter("outcome = 'sent'").collect()}
    assert sent == {f"a{i:07d}" for i in (0, 3000, 6000, 9000, 12000)}
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan
