"""The sample rows of the bronze layer against hand-derived results."""

from datetime import date, datetime

import pytest

from vigil.operators import medallion
from vigil.operators.expectations import Expectation, ExpectationFailed, check, inline_fail
from vigil.sources import inline

AS_OF = datetime(2024, 2, 1)


@pytest.fixture(scope="module")
def layers(spark):
    return medallion.build(
        inline.sample_customers(spark), inline.sample_orders(spark), AS_OF
    )


def test_silver_customers(layers):
    assert sorted(r.customer_id for r in layers.customers.valid.collect()) == [1, 2, 4, 5]


def test_quarantine_names_every_violated_rule(layers):
    (row,) = layers.customers.quarantine.collect()
    assert row.customer_id == 3
    assert row.quarantine_reasons == ["email_not_null", "valid_email_format", "valid_age_range"]


def test_warn_rule_keeps_rows_and_counts(layers):
    counts = {r.expectation_name: r.failed_records for r in layers.customers.counts().collect()}
    assert counts["valid_phone_length"] == 5
    assert counts["email_not_null"] == 1


def test_silver_orders(layers):
    kept = {r.order_id: r.days_to_ship for r in layers.orders.valid.collect()}
    assert kept == {101: 0, 102: 0, 103: None}
    assert sorted(r.order_id for r in layers.orders.quarantine.collect()) == [104, 105]


def test_gold_customer_metrics(layers):
    got = {
        r.customer_id: (r.total_orders, round(r.total_revenue, 2), r.customer_segment,
                        r.days_since_last_order)
        for r in layers.metrics.collect()
    }
    assert got == {1: (2, 239.99, "Regular", 10), 2: (1, 225.5, "Regular", 11)}


def test_gold_daily_revenue(layers):
    got = [(r.order_date, r.daily_revenue, r.order_count) for r in layers.revenue.collect()]
    assert got == [(date(2024, 1, 20), 150.0, 1), (date(2024, 1, 21), 225.5, 1)]


def test_status_summary(spark):
    silver = medallion.silver_customers(inline.sample_customers(spark))
    got = {
        r.status: (r.customer_count, r.avg_age, r.percentage)
        for r in medallion.status_summary(silver).totals.collect()
    }
    assert got == {
        "active": (2, 31.5, 50.0), "inactive": (1, 42.0, 25.0), "suspended": (1, 31.0, 25.0),
    }


def test_quality_summary_is_computed(spark):
    got = {
        r.table_name: (r.records_passed, r.records_failed)
        for r in medallion.quality_summary(
            inline.sample_customers(spark), inline.sample_orders(spark), AS_OF
        ).collect()
    }
    # Customers: 5 rows x 6 rules, with 3 drop violations and 5 short phones.
    assert got["silver_customers"] == (22, 8)
    assert got["bronze_orders"] == (5, 0)


def test_fail_rule_stops_before_writing(spark):
    rules = [Expectation("positive", "order_amount > 0", "fail")]
    with pytest.raises(ExpectationFailed) as caught:
        check(inline.sample_orders(spark), rules).enforce()
    assert caught.value.violations == {"positive": 1}
    with pytest.raises(Exception, match="violated: positive"):
        inline_fail(inline.sample_orders(spark), rules).collect()


def test_generated_runs_are_repeatable(spark):
    first = inline.generated_runs(spark, AS_OF, 200).collect()
    assert first == inline.generated_runs(spark, AS_OF, 200).collect()
    assert len(first) == 200
