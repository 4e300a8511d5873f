from datetime import datetime

import pytest

from vigil import schemas
from vigil.operators import privacy, rules
from vigil.plans import scratch
from vigil.sources import collectors, inline, sinks

AS_OF = datetime(2024, 1, 10)
EVENT = "event_id string, timestamp timestamp_ntz, level string"


def _events(spark, days, level="INFO"):
    return spark.createDataFrame(
        [(f"e{d}", datetime(2024, 1, d, 3), level) for d in days], EVENT
    )


def test_append_is_repeatable(spark, tmp_path):
    path = str(tmp_path / "log")
    for days in ([1, 2, 3], [3, 4], [3, 4], []):
        batch = _events(spark, days)
        sinks.append_new(batch.union(batch), path, "event_logs", ["event_id", "timestamp"])
    got = spark.read.parquet(path)
    assert sorted(r.event_id for r in got.collect()) == ["e1", "e2", "e3", "e4"]


def test_append_reads_only_the_touched_days(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "log")
    sinks.append_new(_events(spark, [1, 2, 3]), path, "event_logs", ["event_id", "timestamp"])
    stored = sinks.read_table(spark, path)
    day = stored.filter("event_date BETWEEN DATE'2024-01-03' AND DATE'2024-01-04'")
    assert "PartitionFilters: [isnotnull(event_date" in (
        day._jdf.queryExecution().executedPlan().toString()
    )


def test_overwrite_replaces_only_its_days(spark, tmp_path):
    path = str(tmp_path / "log")
    sinks.overwrite_days(_events(spark, [1, 2], "INFO"), path, "event_logs", sort=["level"])
    sinks.overwrite_days(_events(spark, [2, 3], "WARN"), path, "event_logs")
    got = {r.event_id: r.level for r in spark.read.parquet(path).collect()}
    assert got == {"e1": "INFO", "e2": "WARN", "e3": "WARN"}


def test_dry_run_writes_nothing(spark, tmp_path):
    path = tmp_path / "log"
    sinks.append_new(
        _events(spark, [1]), str(path), "event_logs", ["event_id", "timestamp"], dry_run=True
    )
    sinks.overwrite_days(_events(spark, [1]), str(path), "event_logs", dry_run=True)
    assert not path.exists()


def test_expired_days_are_removed(spark, tmp_path):
    path = str(tmp_path / "log")
    sinks.overwrite_days(_events(spark, [1, 2, 3]), path, "event_logs")
    days = sorted(r[0] for r in spark.read.parquet(path).select("event_date").distinct().collect())
    as_of = datetime.combine(days[-1], datetime.min.time())
    old = sinks.expire(spark, path, "event_logs", as_of, days=1, dry_run=True)
    assert old == days[:-2] and spark.read.parquet(path).count() == 3
    assert sinks.expire(spark, path, "event_logs", as_of, days=1) == old
    assert spark.read.parquet(path).count() == 3 - len(old)
    assert sinks.expire(spark, path, "event_logs", as_of, days=1) == []


def test_generated_rows_do_not_depend_on_partitions(spark):
    few = inline.generated_runs(spark, AS_OF, rows=50)
    again = spark.createDataFrame(few.collect(), few.schema)
    assert sorted(map(tuple, few.collect()), key=repr) == sorted(map(tuple, again.collect()), key=repr)
    first = {r.run_id: tuple(r) for r in inline.generated_runs(spark, AS_OF, rows=10).collect()}
    assert all(tuple(r) == first[r.run_id] for r in few.collect() if r.run_id < 10)
    assert {tuple(r) for r in inline.generated_runs(spark, AS_OF, 50, seed=1).collect()} != {
        tuple(r) for r in few.collect()
    }


def test_missing_source_becomes_an_empty_table(spark):
    df = collectors.optional(
        spark, lambda: spark.read.parquet("/nowhere/at/all"), schemas.JOB_RUNS
    )
    assert df.count() == 0
    assert collectors.job_metrics(df, AS_OF).columns == schemas.JOB_METRICS.fieldNames()


def test_collectors_match_their_schemas(spark):
    for collect, raw, stored in (
        (collectors.cost_metrics, schemas.BILLING_USAGE, schemas.COST_METRICS),
        (collectors.job_metrics, schemas.JOB_RUNS, schemas.JOB_METRICS),
        (collectors.cluster_metrics, schemas.CLUSTERS, schemas.CLUSTER_METRICS),
        (collectors.query_metrics, schemas.QUERY_HISTORY, schemas.QUERY_METRICS),
        (collectors.event_logs, schemas.EVENT_LOG, schemas.EVENTS),
        (collectors.table_lineage, schemas.TABLE_LINEAGE, schemas.LINEAGE),
    ):
        got = collect(spark.createDataFrame([], raw), AS_OF).schema
        assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in stored]


def test_running_job_has_no_cost(spark):
    runs = spark.createDataFrame(
        [(1, datetime(2024, 1, 9), None), (2, datetime(2024, 1, 9), datetime(2024, 1, 9, 1))],
        "job_id bigint, start_time timestamp_ntz, end_time timestamp_ntz",
    )
    got = {r.job_id: r for r in collectors.with_run_cost(runs).collect()}
    assert got[1].total_cost is None
    assert float(got[2].total_dbu_usage) == 2.0 and float(got[2].total_cost) == 0.3


def test_rules_round_trip(spark):
    T, now = rules.Templates, AS_OF
    own = [
        T.not_null("c", "id", action="fail", now=now), T.not_null("c", "email", now=now),
        T.valid_values("c", "status", ["a", "b"], now=now), T.unique_values("c", "id", now=now),
        T.referential_integrity("c", "fk", "ref", "key", now=now),
    ]
    table = rules.as_rows(spark, own)
    twice = rules.upsert(table, rules.as_rows(spark, own))
    assert twice.count() == 5
    assert rules.generated(table, "c")["id_not_null"]["action"] == "expect_or_fail"
    loaded = {e.name: e for e in rules.load(table, "c")}
    assert loaded["id_unique"].unique == ("id",)
    assert loaded["fk_fk_check"].fk == ("fk", "ref", "key")
    order = [r.severity for r in rules.active(table).collect()]
    assert order == ["critical", "critical", "high", "high", "high"]


def test_rules_keep_typed_arguments(spark):
    T, now = rules.Templates, AS_OF
    own = [
        T.unique_values("c", ["a", "b"], now=now),
        T.date_freshness("c", "day", 2, now=now),
        T.valid_values("c", "n", [1, 2.5, True], now=now),
    ]
    table = rules.as_rows(spark, own)
    loaded = {e.name: e for e in rules.load(table, "c", as_of=datetime(2024, 3, 10))}
    assert loaded["a_b_unique"].unique == ("a", "b")
    assert loaded["day_freshness"].constraint == "day >= DATE'2024-03-08'"
    later = {e.name: e for e in rules.load(table, "c", as_of=datetime(2024, 3, 11))}
    assert later["day_freshness"].constraint == "day >= DATE'2024-03-09'"
    assert loaded["n_valid_values"].constraint == "n IN (1, 2.5, TRUE)"
    with pytest.raises(ValueError):
        rules.load(table, "c")
    named = rules.create_rule(
        "c", "no_dupes", "unique", "a is unique", now=now, arguments={"columns": ["a"]}
    )
    assert rules.to_expectation(named).unique == ("a",)


def test_created_again_wins_and_tags_are_changes(spark):
    def version(limit, **tags):
        rule = rules.Templates.numeric_range("c", "v", limit, now=AS_OF, tags=tags)
        return rules.as_rows(spark, [rule])

    merged = rules.upsert(version(1), version(2))
    assert merged.first().constraint_expression == "v >= 2"
    feed = rules.change_feed(version(1, owner="x"), version(1, owner="y")).collect()
    assert [(r.change_type, r.tags["owner"]) for r in feed] == [("update", "y")]
    assert rules.change_feed(version(1, owner="x"), version(1, owner="x")).isEmpty()


def test_author_and_safe_names(spark):
    from pyspark.sql import functions as F

    from vigil.functions.exprs import safe_name

    row = rules.as_rows(spark, [rules.Templates.not_null("c", "id", now=AS_OF)]).first()
    assert row.created_by == spark.range(1).select(F.current_user()).first()[0]
    assert row.tags == {"template": "not_null"}
    assert spark.range(1).select(safe_name(F.lit("a.b-c d"))).first()[0] == "a_b_c_d"


def test_row_filter_denies_unknown_principals(spark):
    df = inline.sample_customers(spark)
    assert privacy.visible_rows(df, {"x": "age > 40"}, "x").count() == 2
    assert privacy.visible_rows(df, {"x": "age > 40"}, "y").count() == 0


def test_schema_listing(spark):
    inline.sample_orders(spark).createOrReplaceTempView("sample_orders_view")
    assert "sample_orders_view" in inline.schema_tables(spark)


def test_cluster_needs_a_shared_folder(spark, monkeypatch):
    class Remote:
        class conf:  # noqa: N801
            @staticmethod
            def get(key, default=None):
                return default

        class sparkContext:  # noqa: N801
            master = "spark://somewhere:7077"

    with pytest.raises(RuntimeError):
        scratch.scratch_root(Remote)
