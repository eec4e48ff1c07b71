"""Join rows to a table of facts that is unique per key, whatever the size of the facts and the skew of the rows.

Facts are written to the shared folder and measured. Small ones are broadcast. Larger ones meet the rows in one shuffle join, if no
key holds more than 1/1024 of the rows. Otherwise the facts of the heavy keys, of which there can be at most 1,023, are
broadcast, and the rows that find theirs are spread evenly in the shuffle join that brings the others to their facts. Rows
are read once. No row is salted at random, so a lost task recomputes the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.session import materialize

MAX_ROWS = 500_000
MAX_BYTES = 32 << 20
HEAVY = 1024
HEAVY_BYTES = 128 << 20
PLACES = 1 << 16


@dataclass(frozen=True)
class Facts:
    """Facts about the keys of a table, NULL being a key like any other. `weight` counts the rows that carry the key.
    `row_keys` are the expressions that give the keys on the side of the rows, if they are not columns of the same name.

    Every key that holds more than 1/1024 of the rows must be present, or its rows would meet in one shuffle partition.
    """

    df: DataFrame
    keys: tuple[str, ...]
    values: tuple[str, ...]
    weight: str = "_n"
    row_keys: tuple[Column, ...] | None = None
    size: dict[str, int] | None = None

    def materialized(self) -> Facts:
        """The facts written to the shared folder, and measured there."""
        written = materialize(self.df)
        size = written.agg(
            F.count(F.lit(1)).alias("rows"),
            F.coalesce(F.sum(self._width()), F.lit(0)).alias("bytes"),
            F.coalesce(F.sum(self.weight), F.lit(0)).alias("weight"),
            F.coalesce(F.max(self.weight), F.lit(0)).alias("heaviest"),
        )
        return replace(self, df=written, size=size.first().asDict())

    def _width(self) -> Column:
        return sum((F.coalesce(F.octet_length(F.col(k).cast("string")), F.lit(0)) for k in self.keys), F.lit(64))

    def is_heavy(self) -> Column:
        return F.col(self.weight) * HEAVY > F.lit(self.size["weight"])

    def heavy_bytes(self) -> int:
        return self.df.filter(self.is_heavy()).agg(F.coalesce(F.sum(self._width()), F.lit(0))).first()[0]

    def fits(self, max_rows: int, max_bytes: int) -> bool:
        return self.size["rows"] <= max_rows and self.size["bytes"] <= max_bytes

    def has_heavy_keys(self) -> bool:
        return self.size["heaviest"] * HEAVY > self.size["weight"]

    def _on(self) -> list[Column]:
        rows = self.row_keys or tuple(F.col(f"`{key}`") for key in self.keys)
        return [row.eqNullSafe(F.col(f"_k{i}")) for i, row in enumerate(rows)]

    def _side(self, where: Column | None = None, *extra: Column) -> DataFrame:
        df = self.df if where is None else self.df.filter(where)
        return df.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(self.keys)], *self.values, *extra)


def attach(rows: DataFrame, facts: Facts, max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """rows left join facts on the keys, adding the value columns."""
    if facts.size is None:
        facts = facts.materialized()
    wanted = [*rows.columns, *facts.values]
    if facts.fits(max_rows, max_bytes):
        return rows.join(F.broadcast(facts._side()), facts._on(), "left").select(*wanted)
    if not facts.has_heavy_keys() or facts.heavy_bytes() > HEAVY_BYTES:
        # Heavy keys too long to broadcast are left to Spark's own splitting of skewed partitions.
        return rows.join(facts._side(), facts._on(), "left").select(*wanted)
    marked = rows.join(F.broadcast(facts._side(facts.is_heavy(), F.lit(True).alias("_heavy"))), facts._on(), "left")
    values = {v: f"_heavy__{v}" for v in facts.values}
    marked = marked.withColumnsRenamed(values).drop(*[f"_k{i}" for i in range(len(facts.keys))])
    # rows whose facts are found already go to places of their own, where they meet nothing
    plain = [F.col(f"`{f.name}`") for f in rows.schema if not _has_map(f.dataType)]
    place = F.when(F.col("_heavy"), F.pmod(F.xxhash64(*plain), F.lit(PLACES)) + 1).otherwise(F.lit(0)).cast("long")
    rest = facts._side(~facts.is_heavy(), F.lit(0).cast("long").alias("_at"))
    joined = marked.withColumn("_place", place).join(rest, [*facts._on(), F.col("_place") == F.col("_at")], "left")
    found = {v: F.when(F.col("_heavy"), F.col(f"`{old}`")).otherwise(F.col(f"`{v}`")) for v, old in values.items()}
    return joined.select(*[found[c].alias(c) if c in found else F.col(f"`{c}`") for c in wanted])


def _has_map(kind: T.DataType) -> bool:
    """Maps have no hash."""
    return "map<" in kind.simpleString()


def attach_all(
    rows: DataFrame, many: Sequence[Facts], max_rows: int = MAX_ROWS, max_bytes: int = MAX_BYTES
) -> DataFrame:
    """Attach several facts to rows that are read once."""
    for facts in [f if f.size else f.materialized() for f in many]:
        rows = attach(rows, facts, max_rows, max_bytes)
    return rows
