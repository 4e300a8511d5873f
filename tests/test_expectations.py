from collections import Counter

from datetime import datetime

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from vigil.operators.expectations import Expectation, check, counts
from vigil.operators.rules import Templates, create_rule, sql_text, to_expectation

NOW = datetime(2024, 1, 1)
SCHEMA = "id bigint, k string, v int"
values = st.lists(
    st.tuples(st.sampled_from(["a", "b", "c", None]), st.one_of(st.none(), st.integers(-5, 5))),
    max_size=12,
)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(values)
def test_null_counts_as_violation_and_nothing_is_lost(spark, pairs):
    data = [(i, k, v) for i, (k, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, SCHEMA)
    rules = [Expectation("pos", "v > 0", "drop"), Expectation("known", "k IN ('a', 'b')", "drop")]
    checked = check(df, rules)
    good = {i for i, k, v in data if v is not None and v > 0 and k in ("a", "b")}
    assert {r.id for r in checked.valid.collect()} == good
    assert {r.id for r in checked.quarantine.collect()} == {i for i, *_ in data} - good
    for r in checked.counts().collect():
        assert r.passed_records + r.failed_records == len(data)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(values)
def test_unique_rule_counts_like_a_window(spark, pairs):
    data = [(i, k, v) for i, (k, v) in enumerate(pairs)]
    df = spark.createDataFrame(data, SCHEMA)
    rule = Expectation("k_unique", "k is unique", "drop", unique=("k",))
    seen = Counter(k for _, k, _ in data)
    once = {i for i, k, _ in data if seen[k] == 1}
    assert {r.id for r in check(df, [rule]).valid.collect()} == once
    (row,) = counts(df, [rule]).collect()
    assert (row.passed_records, row.failed_records) == (len(once), len(data) - len(once))


def test_unique_rule_by_group_looks_at_the_whole_table(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 2), (3, "b", 2)], SCHEMA)
    rule = Expectation("k_unique", "", "warn", unique=("k",))
    got = {r.v: r.passed_records for r in counts(df, [rule], by={"v": F.col("v")}).collect()}
    assert got == {1: 0, 2: 1}


def test_reference_rule_with_nulls_and_duplicates(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "x", 1), (3, None, 1)], SCHEMA)
    known = spark.createDataFrame([("a",), ("a",), (None,)], "name string")
    rule = Expectation("k_known", "", "drop", fk=("k", "names", "name"))
    checked = check(df, [rule], {"names": known})
    assert [r.id for r in checked.valid.collect()] == [1]
    assert [r.failed_records for r in checked.counts().collect()] == [2]


def test_one_scan_serves_all_row_rules(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(100).withColumn("v", F.col("id") % 7).write.parquet(path)
    rules = [Expectation(f"r{i}", f"v <> {i}") for i in range(6)]
    plan = counts(spark.read.parquet(path), rules)._jdf.queryExecution().toString()
    assert plan.split("== Physical Plan ==")[1].count("FileScan") == 1


def test_hot_key_is_split_when_joining_references(spark, conf):
    """A key that holds a third of the rows does not end up in one task."""
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "64KB")
    conf("spark.sql.adaptive.skewJoin.skewedPartitionFactor", "2")
    conf("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64KB")
    df = spark.range(0, 300_000, 1, 8).select(
        "id",
        F.when(F.col("id") % 3 == 0, F.lit(7)).otherwise(F.col("id")).alias("fk"),
        F.sha2(F.col("id").cast("string"), 256).alias("load"),
    )
    known = spark.range(0, 300_000, 2).select(F.col("id").alias("key"))
    rule = Expectation("known", "", "drop", fk=("fk", "known", "key"))
    valid = check(df, [rule], {"known": known}).valid.select("id", "load")
    assert len(valid.collect()) == 100_000
    assert "skew=true" in valid._jdf.queryExecution().executedPlan().toString()


def test_template_constraints(spark):
    assert Templates.numeric_range("d", "v", 0, now=NOW)["constraint_expression"] == "v >= 0"
    assert Templates.numeric_range("d", "v", 0, now=NOW)["description"] == "Ensure v is >= 0"
    with pytest.raises(ValueError):
        Templates.numeric_range("d", "v", now=NOW)
    with pytest.raises(ValueError):
        create_rule("d", "n", "custom", "true", action="ignore", now=NOW)
    with pytest.raises(ValueError):
        create_rule("d", "n", "custom", "true", severity="urgent", now=NOW)
    df = spark.createDataFrame([(1, "it's", 1), (2, "a.b", 2), (3, "aXb", 3)], SCHEMA)
    quoted = to_expectation(Templates.valid_values("d", "k", ["it's"], now=NOW))
    assert [r.id for r in check(df, [quoted]).valid.collect()] == [1]
    dotted = to_expectation(Templates.regex_match("d", "k", r"^a\.b$", now=NOW))
    assert [r.id for r in check(df, [dotted]).valid.collect()] == [2]


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.text(alphabet="ab'\\\"% ", max_size=6))
def test_sql_text_reads_back(spark, text):
    assert spark.sql(f"SELECT {sql_text(text)} AS t").first().t == text
