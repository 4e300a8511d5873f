"""Stored update health: late, repeated and null batches against the health of the whole log."""

import re
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from vigil.operators import event_log, stored_health

AS_OF = datetime(2024, 1, 20)
SCHEMA = (
    "pipeline_id string, pipeline_name string, update_id string, timestamp timestamp_ntz, "
    "event_type string, level string, details string"
)


def event(update, day, hour, state=None, flow=None, failed=0, level="INFO", name="flow"):
    at = datetime(2024, 1, day, hour)
    if state:
        return ("p", name, update, at, "update_progress", level, f'{{"state": "{state}"}}')
    checks = f'[{{"name": "x", "passed_records": 5, "failed_records": {failed}}}]'
    details = f'{{"flow_name": "{flow}", "data_quality": {{"expectations": {checks}}}}}'
    return ("p", name, update, at, "flow_progress", level, details)


FIRST = [
    event("u1", 3, 1, "RUNNING"), event("u1", 3, 2, flow="a"), event("u1", 3, 5, "COMPLETED"),
    event("u2", 4, 1, "RUNNING"), event("u2", 4, 2, flow="a", failed=3, level="ERROR"),
    event("u3", 5, 2, flow="a"),  # no progress yet
    event("u4", 5, 2, "RUNNING", name=None),
]
SECOND = [event("u5", 12, 1, "RUNNING"), event("u5", 13, 4, "FAILED", level="WARN")]
# u1 turns out to have begun the day before, u3 has begun, u2 and the one without a name end.
LATE = [
    event("u1", 2, 23, "QUEUED"), event("u2", 4, 9, "CANCELED"), event("u2", 4, 3, flow="b"),
    event("u3", 5, 1, "RUNNING"), event("u4", 6, 1, "COMPLETED", name=None),
]


def log(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def days_of(path):
    """Day folders with the files in them."""
    return {p.name: sorted(f.name for f in p.glob("*.parquet")) for p in path.glob("*=*")}


def test_any_order_and_repeats_equal_the_whole_log(spark, tmp_path):
    want = rows(event_log.update_health(log(spark, FIRST + SECOND + LATE), AS_OF))
    batches = {0: FIRST, 1: SECOND, 2: LATE}
    for turn, order in enumerate([(0, 1, 2), (2, 0, 1, 0), (1, 2, 2, 0, 1)]):
        root = str(tmp_path / str(turn))
        for number in order:
            stored_health.refresh(log(spark, batches[number]), root, number, AS_OF)
        assert rows(stored_health.health(spark, root)) == want


def test_a_late_event_changes_only_its_update(spark, tmp_path):
    root = str(tmp_path)
    stored_health.refresh(log(spark, FIRST), root, 0, AS_OF)
    stored_health.refresh(log(spark, SECOND), root, 1, AS_OF)
    before, table = days_of(tmp_path / "health"), rows(stored_health.health(spark, root))
    stored_health.refresh(log(spark, [event("u2", 4, 9, "CANCELED")]), root, 2, AS_OF)
    after = days_of(tmp_path / "health")
    changed = {day for day in after if after[day] != before.get(day)}
    assert changed == {"home_day=2024-01-04"}
    now = rows(stored_health.health(spark, root))
    assert now != table and len(now) == len(table)
    assert [r for r in now if r[2] != "u2"] == [r for r in table if r[2] != "u2"]


def test_reports_read_only_their_days(spark, tmp_path):
    root = str(tmp_path)
    for number, batch in enumerate([FIRST, SECOND, LATE]):
        stored_health.refresh(log(spark, batch), root, number, AS_OF)
    week = stored_health.health(spark, root, AS_OF, 10, span_days=1)
    plan = week._jdf.queryExecution().executedPlan().toString()
    filters = re.search(r"PartitionFilters: .*", plan)[0]
    assert "home_day" in filters
    assert {r.update_id for r in week.collect()} == {"u5"}
    whole = event_log.update_health(log(spark, FIRST + SECOND + LATE), AS_OF)
    assert rows(event_log.executions_by_status(week, AS_OF, 10)) == rows(
        event_log.executions_by_status(whole, AS_OF, 10)
    )


@pytest.mark.parametrize("first", [True, False])
def test_empty_batches(spark, tmp_path, first):
    root = str(tmp_path)
    if not first:
        stored_health.refresh(log(spark, FIRST), root, 0, AS_OF)
    stored_health.refresh(log(spark, FIRST).filter(F.lit(False)), root, 1, AS_OF)
    if first:
        stored_health.refresh(log(spark, FIRST), root, 0, AS_OF)
    want = rows(event_log.update_health(log(spark, FIRST), AS_OF))
    assert rows(stored_health.health(spark, root)) == want
