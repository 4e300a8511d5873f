from datetime import datetime

from vigil.operators import bulk_profile, profile


def test_a_broken_table_fails_alone(spark):
    good = spark.createDataFrame([(1, "a"), (2, None)], "id int, name string")
    timed = spark.createDataFrame(
        [(datetime(2024, 1, d), d) for d in (1, 1, 2)], "at timestamp_ntz, n int"
    )

    def unreadable():
        return spark.read.parquet("/no/such/folder")

    broken = spark.range(3).selectExpr("id", "CAST(raise_error('bad row') AS string) AS name")
    out = bulk_profile.run(
        spark,
        {"good": good, "gone": unreadable, "timed": timed, "broken": broken, "no_stamp": good,
         "left_out": good, "empty": good.limit(0)},
        {"timed": "at", "no_stamp": "missing"},
        exclude=["left_out"],
    )
    got = {r.table_name: r for r in out.outcomes.collect()}
    assert {n: r.status for n, r in got.items()} == {
        "good": "created_snapshot", "gone": "failed", "timed": "created_timeseries",
        "broken": "failed", "no_stamp": "failed", "left_out": "excluded",
        "empty": "created_snapshot",
    }
    assert got["gone"].error_class == "PATH_NOT_FOUND" and "/no/such/folder" in got["gone"].reason
    assert got["no_stamp"].error_class.startswith("UNRESOLVED_COLUMN")
    assert got["broken"].reason
    assert (got["good"].profiled_columns, got["good"].profiled_rows) == (2, 2)
    assert got["timed"].profiled_rows == 3 and got["empty"].profiled_rows == 0
    together = profile.all_tables({"good": good, "timed": timed, "empty": good.limit(0)}, {"timed": "at"})
    assert sorted(map(repr, out.profiles.collect())) == sorted(map(repr, together.collect()))


def test_nothing_to_profile(spark):
    out = bulk_profile.run(spark, {})
    assert out.profiles is None and out.outcomes.count() == 0
