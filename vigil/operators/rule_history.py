"""History of the rules registry: a change log, validity intervals and as-of joins.

A log row is a whole rule with ``change_type`` (``delete`` ends the rule, everything else states
it) and ``changed_at``. Rows may come in any order and more than once. Of changes of one rule at
the same moment a delete counts last, among the others the greater (is_enabled,
constraint_expression, action, severity).
"""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vigil import schemas
from vigil.functions.exprs import ts_lit
from vigil.operators.rules import KEY, change_feed
from vigil.settings import DEFAULTS

_NAMES = schemas.RULES.fieldNames()
_LOG = [*_NAMES, "change_type", "changed_at"]


def _last() -> Column:
    """The order of changes at one moment. Maps do not compare, so they stay out of it."""
    gone = F.col("change_type") == "delete"
    return F.struct(gone, "is_enabled", "constraint_expression", "action", "severity")


def changes(before: DataFrame, after: DataFrame, at: datetime) -> DataFrame:
    """Log rows of what differs between two snapshots of the registry, made at ``at``."""
    feed = change_feed(before, after).withColumn("changed_at", ts_lit(at))
    return feed.select(*_LOG)


def versions(delivery: DataFrame) -> DataFrame:
    """Log rows of delivered rules, each stamped with its ``updated_at``."""
    stated = delivery.withColumn("change_type", F.lit("upsert"))
    return stated.withColumn("changed_at", F.col("updated_at")).select(*_LOG)


def _newest(log: DataFrame, order: Column) -> DataFrame:
    """One log row per rule: the one of greatest ``order``."""
    chosen = log.groupBy("rule_id").agg(F.max_by(F.struct(*_LOG), order).alias("_row"))
    return chosen.select("_row.*")


def in_force(log: DataFrame, at: datetime) -> DataFrame:
    """Rules that were stated, enabled and not deleted at ``at``: one aggregate, no sort."""
    known = log.filter(F.col("changed_at") <= ts_lit(at))
    newest = _newest(known, F.struct("changed_at", _last()))
    return newest.filter("change_type <> 'delete' AND is_enabled").select(*_NAMES)


def intervals(log: DataFrame) -> DataFrame:
    """Versions with ``valid_from`` (included) and ``valid_to`` (excluded, null while it holds).

    Changes are ordered inside (rule, month); from one month to the next only its first change
    is carried, so a rule that changes all the time is not one task's work.
    """
    single = log.groupBy("rule_id", "changed_at").agg(
        F.max_by(F.struct(*_LOG), _last()).alias("_row")
    )
    single = single.withColumn("_month", F.trunc("changed_at", "month"))
    first = single.groupBy("rule_id", "_month").agg(F.min("changed_at").alias("_first"))
    later = F.lead("_first").over(Window.partitionBy("rule_id").orderBy("_month"))
    following = first.select("rule_id", "_month", later.alias("_later"))
    order = Window.partitionBy("rule_id", "_month").orderBy("changed_at")
    placed = single.withColumn("_next", F.lead("changed_at").over(order))
    return placed.join(following, ["rule_id", "_month"]).select(
        *[F.col(f"_row.{name}").alias(name) for name in _NAMES],
        "_row.change_type",
        F.col("changed_at").alias("valid_from"),
        F.coalesce("_next", "_later").alias("valid_to"),
    )


def judged(facts: DataFrame, log: DataFrame, at: str) -> DataFrame:
    """``facts`` with the ``rule`` (a struct) that was in force at their own time ``at``.

    ``facts`` name their rule by dataset_name and expectation_name and need no other column. A
    fact without a rule in force, a name or a time keeps a null rule. Versions are dealt to the
    months in which facts of their rule lie, so a fact meets the versions of one month only and
    a hot rule is split by month.
    """
    month = F.trunc(F.col(at), "month")
    needed = facts.select(*KEY, month.alias("_month")).distinct()
    holds = intervals(log).filter("change_type <> 'delete' AND is_enabled")
    starts = F.col("_month").cast("timestamp_ntz")
    ends = F.add_months("_month", 1).cast("timestamp_ntz")
    touches = (F.col("valid_from") < ends) & (
        F.col("valid_to").isNull() | (F.col("valid_to") > starts)
    )
    dealt = needed.join(holds, list(KEY)).filter(touches).select(
        *[F.col(name).alias(f"_{name}") for name in KEY],
        F.col("_month").alias("_in"),
        "valid_from",
        "valid_to",
        F.struct(*_NAMES, "valid_from", "valid_to").alias("rule"),
    )
    time = F.col("_fact").getField(at)
    same = F.trunc(time, "month") == F.col("_in")
    for name in KEY:
        same = same & (F.col("_fact").getField(name) == F.col(f"_{name}"))
    during = (F.col("valid_from") <= time) & (
        F.col("valid_to").isNull() | (time < F.col("valid_to"))
    )
    packed = facts.select(F.struct(*[F.col(f"`{name}`") for name in facts.columns]).alias("_fact"))
    return packed.join(dealt, same & during, "left").select("_fact.*", "rule")


def trimmed(
    log: DataFrame, as_of: datetime, days: int = DEFAULTS.retention.audit_days
) -> DataFrame:
    """The log after the audit period: changes of the last ``days``, and of older ones the newest
    of every rule, so that what held since is still known. Rules deleted before are gone."""
    edge = ts_lit(as_of - timedelta(days=days))
    old = _newest(log.filter(F.col("changed_at") < edge), F.struct("changed_at", _last()))
    recent = log.filter(F.col("changed_at") >= edge).select(*_LOG)
    return recent.unionByName(old.filter("change_type <> 'delete'"))
