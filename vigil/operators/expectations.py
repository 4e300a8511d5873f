"""Data-quality expectations evaluated together over one DataFrame.

A rule is a name, a SQL predicate and an action. All row rules of a table are
counted in one scan. Two kinds need other rows: uniqueness and references. Their
counts work on pre-aggregated keys; their row verdicts come from a left join, which
adaptive execution can split when one key dominates.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from functools import reduce
from typing import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.exprs import holds

ACTIONS = ("warn", "drop", "fail")


@dataclass(frozen=True)
class Expectation:
    """A rule to evaluate. ``unique`` or ``fk`` rules carry columns instead of a predicate."""

    name: str
    constraint: str
    action: str = "warn"
    unique: tuple[str, ...] = ()
    fk: tuple[str, str, str] | None = None  # (column, reference name, reference column)

    def __post_init__(self):
        if self.action not in ACTIONS:
            raise ValueError(f"action must be one of {ACTIONS}, not {self.action!r}")

    @property
    def by_row(self) -> bool:
        return not self.unique and self.fk is None


class ExpectationFailed(Exception):
    """Raised before anything is written when a ``fail`` rule is violated."""

    def __init__(self, violations: Mapping[str, int]):
        self.violations = dict(violations)
        super().__init__(f"violated: {self.violations}")


def _flag(position: int) -> str:
    return f"_ok_{position}"


def _keys_seen_twice(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).count().filter("count > 1").drop("count")


def flagged(
    df: DataFrame, rules: Sequence[Expectation], references: Mapping[str, DataFrame] | None = None
) -> DataFrame:
    """``df`` with one boolean column per rule: true when the row satisfies it."""
    references = references or {}
    out = df
    for position, rule in enumerate(rules):
        if rule.unique:
            twice = _keys_seen_twice(df, rule.unique).select(
                *[F.col(c).alias(f"_u_{c}") for c in rule.unique], F.lit(True).alias("_twice")
            )
            same = reduce(
                Column.__and__, [F.col(c).eqNullSafe(F.col(f"_u_{c}")) for c in rule.unique]
            )
            out = (
                out.join(twice, same, "left")
                .withColumn(_flag(position), F.col("_twice").isNull())
                .drop("_twice", *[f"_u_{c}" for c in rule.unique])
            )
        elif rule.fk:
            column, name, key = rule.fk
            known = (
                references[name]
                .select(F.col(key).alias("_ref"))
                .filter(F.col("_ref").isNotNull())
                .distinct()
            )
            out = (
                out.join(known, F.col(column) == F.col("_ref"), "left")
                .withColumn(_flag(position), F.col("_ref").isNotNull())
                .drop("_ref")
            )
    plain = {
        _flag(i): holds(rule.constraint) for i, rule in enumerate(rules) if rule.by_row
    }
    return out.withColumns(plain) if plain else out


def _all_of(flags: Iterable[str]) -> Column:
    return reduce(Column.__and__, [F.col(f) for f in flags], F.lit(True))


@dataclass(frozen=True)
class Checked:
    """Lazy outcome of a rule set: kept rows, quarantined rows, violation counts."""

    source: DataFrame
    rules: tuple[Expectation, ...]
    references: Mapping[str, DataFrame]

    def _flags(self, *actions: str) -> list[str]:
        return [_flag(i) for i, r in enumerate(self.rules) if r.action in actions]

    def _relevant(self, *actions: str) -> DataFrame:
        """Flags of the rules that matter for ``actions``; positions stay the same."""
        kept = [
            r if r.action in actions else replace(r, constraint="true", unique=(), fk=None)
            for r in self.rules
        ]
        return flagged(self.source, kept, self.references)

    @property
    def flagged(self) -> DataFrame:
        return flagged(self.source, self.rules, self.references)

    @property
    def valid(self) -> DataFrame:
        """Rows that satisfy every ``drop`` rule."""
        return (
            self._relevant("drop")
            .filter(_all_of(self._flags("drop")))
            .select(*self.source.columns)
        )

    @property
    def quarantine(self) -> DataFrame:
        """Exact complement of ``valid``, with the names of the violated rules."""
        reasons = [
            F.when(~F.col(_flag(i)), F.lit(r.name))
            for i, r in enumerate(self.rules)
            if r.action == "drop"
        ]
        if not reasons:
            return self.source.limit(0).withColumn(
                "quarantine_reasons", F.array().cast("array<string>")
            )
        return (
            self._relevant("drop")
            .filter(~_all_of(self._flags("drop")))
            .withColumn("quarantine_reasons", F.array_compact(F.array(*reasons)))
            .select(*self.source.columns, "quarantine_reasons")
        )

    def counts(self, by: Mapping[str, Column] | None = None) -> DataFrame:
        return counts(self.source, self.rules, self.references, by)

    def enforce(self) -> "Checked":
        """Raise when a ``fail`` rule is violated; call before writing."""
        fatal = tuple(r for r in self.rules if r.action == "fail")
        if fatal:
            rows = counts(self.source, fatal, self.references).filter("failed_records > 0")
            violations = {r.expectation_name: r.failed_records for r in rows.collect()}
            if violations:
                raise ExpectationFailed(violations)
        return self


def check(
    df: DataFrame,
    rules: Iterable[Expectation],
    references: Mapping[str, DataFrame] | None = None,
) -> Checked:
    return Checked(df, tuple(rules), references or {})


def _total(col: str | Column) -> Column:
    return F.coalesce(F.sum(col), F.lit(0))


def _unpivoted(totals: DataFrame, by: Sequence[str], rules: Sequence[Expectation]) -> DataFrame:
    """One row per rule from one row of counters, without another shuffle."""
    entry = [
        F.struct(
            F.lit(r.name).alias("expectation_name"),
            F.lit(r.constraint).alias("expectation_query"),
            F.lit(r.action).alias("expectation_action"),
            F.col(f"_n_{i}").alias("passed_records"),
            (F.col("_rows") - F.col(f"_n_{i}")).alias("failed_records"),
        )
        for i, r in enumerate(rules)
    ]
    return totals.select(*by, F.inline(F.array(*entry)))


def counts(
    df: DataFrame,
    rules: Sequence[Expectation],
    references: Mapping[str, DataFrame] | None = None,
    by: Mapping[str, Column] | None = None,
) -> DataFrame:
    """Passed and failed records per rule (and per group of ``by``).

    Row rules share one scan and one aggregate. Uniqueness and reference rules first
    count rows per key, so a dominating key is a single row after the map side.
    """
    references = references or {}
    by = dict(by or {})
    names = list(by)
    parts = []

    row_rules = [r for r in rules if r.by_row]
    if row_rules:
        sums = [F.count_if(holds(r.constraint)).alias(f"_n_{i}") for i, r in enumerate(row_rules)]
        totals = df.groupBy(*[e.alias(n) for n, e in by.items()]).agg(
            F.count("*").alias("_rows"), *sums
        )
        parts.append(_unpivoted(totals, names, row_rules))

    for rule in rules:
        if rule.unique:
            per_key = df.groupBy(*rule.unique, *[e.alias(f"_g_{n}") for n, e in by.items()]).agg(
                F.count("*").alias("_in_group")
            )
            if by:
                # A key is unique only when it occurs once in the whole table.
                whole = per_key.groupBy(*rule.unique).agg(F.sum("_in_group").alias("_in_all"))
                same = reduce(
                    Column.__and__, [per_key[c].eqNullSafe(whole[c]) for c in rule.unique]
                )
                per_key = per_key.join(whole, same)
                once = F.col("_in_all") == 1
            else:
                once = F.col("_in_group") == 1
            totals = per_key.groupBy(*[F.col(f"_g_{n}").alias(n) for n in names]).agg(
                _total("_in_group").alias("_rows"), F.count_if(once).alias("_n_0")
            )
        elif rule.fk:
            column, name, key = rule.fk
            known = (
                references[name]
                .select(F.col(key).alias("_ref"))
                .filter(F.col("_ref").isNotNull())
                .distinct()
            )
            per_key = df.groupBy(
                F.col(column).alias("_fk"), *[e.alias(f"_g_{n}") for n, e in by.items()]
            ).agg(F.count("*").alias("_in_group"))
            hit = F.when(F.col("_ref").isNotNull(), F.col("_in_group")).otherwise(0)
            totals = (
                per_key.join(known, F.col("_fk") == F.col("_ref"), "left")
                .groupBy(*[F.col(f"_g_{n}").alias(n) for n in names])
                .agg(_total("_in_group").alias("_rows"), _total(hit).alias("_n_0"))
            )
        else:
            continue
        parts.append(_unpivoted(totals, names, [rule]))
    result = reduce(DataFrame.unionByName, parts)
    checked = F.col("passed_records") + F.col("failed_records")
    rate = F.when(checked > 0, F.col("passed_records") / checked).otherwise(F.lit(1.0))
    return result.withColumn("pass_rate", rate)


def inline_fail(df: DataFrame, rules: Sequence[Expectation]) -> DataFrame:
    """Rows pass through; the first violation of a ``fail`` row rule stops the job."""
    fatal = [r for r in rules if r.action == "fail" and r.by_row]
    if not fatal:
        return df
    broken = reduce(
        lambda acc, r: F.when(~holds(r.constraint), F.lit(r.name)).otherwise(acc),
        reversed(fatal),
        F.lit(None).cast("string"),
    )
    stop = F.raise_error(F.concat(F.lit("violated: "), F.col("_broken"))).cast("boolean")
    return (
        df.withColumn("_broken", broken)
        .filter(F.when(F.col("_broken").isNull(), F.lit(True)).otherwise(stop))
        .drop("_broken")
    )
