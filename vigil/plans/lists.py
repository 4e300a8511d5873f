"""Values per key, one row each: no task and no cell ever gathers the values of a key."""

from __future__ import annotations

from functools import reduce
from typing import Mapping, NamedTuple, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.plans.scratch import stored


class Listed(NamedTuple):
    """Totals, one row per key, and values, one row per key and value that is not null."""

    totals: DataFrame
    values: DataFrame


def listed(
    pairs: DataFrame,
    keys: Sequence[str],
    value: str,
    name: str,
    totals: Mapping[str, Column],
    order: Sequence[Column] = (),
    limit: int | None = None,
) -> Listed:
    """Totals per key and its values, from rows that are one per (key, value).

    The shape is the same however many values a key has. With ``limit``, the first ``limit``
    keys in ``order`` are reported. ``pairs`` is computed once and stored.
    """
    keys = list(keys)
    kept = stored(pairs, "pairs")
    heads = kept.groupBy(*keys).agg(*[total.alias(n) for n, total in totals.items()])
    values = kept.filter(F.col(value).isNotNull()).select(*keys, F.col(value).alias(name))
    if limit is not None:
        heads = heads.orderBy(*order).limit(limit)
        # The limit is also the proof that this side is small.
        chosen = F.broadcast(heads.select(*[F.col(k).alias(f"_head_{k}") for k in keys]))
        same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_head_{k}")) for k in keys])
        values = values.join(chosen, same, "left_semi")
    return Listed(heads, values)
