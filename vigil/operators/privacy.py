"""Column masking and row-level visibility as DataFrame transformations."""

from __future__ import annotations

from dataclasses import dataclass, field
from hashlib import sha256
from typing import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vigil.functions.exprs import masked, pseudonym
from vigil.settings import DEFAULTS


def masked_columns(
    df: DataFrame, columns: Sequence[str] = DEFAULTS.pii_columns, digests: bool = False
) -> DataFrame:
    """Mask the personal columns ``df`` has; optionally add ``<column>_digest`` to join on."""
    present = [c for c in columns if c in df.columns]
    extra = {f"{c}_digest": pseudonym(c) for c in present} if digests else {}
    return df.withColumns(extra).withColumns({c: masked(c) for c in present})


@dataclass(frozen=True)
class Key:
    """A secret with a version; it is never shown."""

    version: str
    secret: bytes = field(repr=False)

    def pads(self) -> tuple[bytes, bytes]:
        """The inner and outer block of HMAC-SHA256."""
        block = self.secret if len(self.secret) <= 64 else sha256(self.secret).digest()
        block = block.ljust(64, b"\0")
        return bytes(b ^ 0x36 for b in block), bytes(b ^ 0x5C for b in block)


def _keyed(value: Column, pads: Column) -> Column:
    inner = F.sha2(F.concat(pads["inner"], value.cast("string").cast("binary")), 256)
    return F.sha2(F.concat(pads["outer"], F.unhex(inner)), 256)


def keyed_digests(df: DataFrame, columns: Sequence[str], key: Key) -> DataFrame:
    """``df`` with ``<column>_pseudonym``: the key's version, a colon, and the HMAC-SHA256 of the
    value as text. Equal values join under one key and under no other; without the key a value
    cannot be found by trying all of them. Null stays null.

    The key is read from a one-row table, so that no plan that is shown or logged prints it.
    """
    spark = df.sparkSession
    table = spark.createDataFrame([key.pads()], "inner binary, outer binary")
    pads = table.select(F.struct("inner", "outer")).scalar()
    version = F.lit(f"{key.version}:")
    return df.withColumns(
        {f"{c}_pseudonym": F.concat(version, _keyed(F.col(f"`{c}`"), pads)) for c in columns}
    )


def visible_rows(df: DataFrame, policies: Mapping[str, str], principal: str) -> DataFrame:
    """Rows a principal may read: its own predicate, or none at all without a policy."""
    return df.filter(F.expr(policies.get(principal, "false")))
