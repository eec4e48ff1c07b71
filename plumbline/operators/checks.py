"""The checks a rule can use. Each is a plain column expression; the three that need a second look at the table (group
statistics, grain counts, a reference table) say which facts they need and leave the join to the run."""

from __future__ import annotations

import operator
from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plumbline.operators.lookup import HEAVY, Facts, attach
from plumbline.operators.rule import Check, GroupCheck, Scope

COMPARISONS: dict[str, Callable] = {
    "<": operator.lt, "<=": operator.le, ">": operator.gt, ">=": operator.ge, "=": operator.eq, "<>": operator.ne,
}


@dataclass(frozen=True)
class NotNull(Check):
    column: str
    unless: tuple[str, Any] | None = None  # (column, value): a null is allowed on rows where column = value
    defaults: Mapping[str, Any] = field(default_factory=dict)

    @property
    def columns(self):
        return (self.column,) if self.unless is None else (self.column, self.unless[0])

    def fails(self, scope: Scope) -> Column:
        null = scope.missing(self.column)
        if self.unless is None:
            return null
        name, value = self.unless
        return null & ~scope.col(name).eqNullSafe(F.lit(value))


@dataclass(frozen=True)
class Bounds(Check):
    """Fails below `low` or above `high`; with `strict`, also at the bound itself. Null passes."""

    column: str
    low: float | None = None
    high: float | None = None
    strict: bool = False

    @property
    def columns(self):
        return (self.column,)

    def fails(self, scope: Scope) -> Column:
        # The comparison comes first and stands alone, so that it reaches the scan as a pushed filter; a NaN is
        # above everything in Spark and is let through as missing.
        value = scope.raw(self.column)
        low = high = None
        if self.low is not None:
            low = value <= self.low if self.strict else value < self.low
        if self.high is not None:
            high = value >= self.high if self.strict else value > self.high
            high = high & ~scope.missing(self.column)
        return low if high is None else high if low is None else low | high


@dataclass(frozen=True)
class InDomain(Check):
    """Fails outside the allowed values. A null fails, unless it stands for the value `null_as` or may pass."""

    column: str
    values: tuple
    null_as: Any = None
    null_passes: bool = False
    defaults: Mapping[str, Any] = field(default_factory=dict)

    @property
    def columns(self):
        return (self.column,)

    def fails(self, scope: Scope) -> Column:
        value = scope.col(self.column)
        if self.null_as is not None:
            value = F.coalesce(value, F.lit(self.null_as))
        outside = ~value.isin(list(self.values))
        return outside if self.null_passes else value.isNull() | outside


@dataclass(frozen=True)
class Matches(Check):
    """Fails where the text form does not match the pattern; a null fails unless it may pass."""

    column: str
    pattern: str
    null_passes: bool = False

    @property
    def columns(self):
        return (self.column,)

    def fails(self, scope: Scope) -> Column:
        wrong = ~scope.raw(self.column).cast("string").rlike(self.pattern)
        return wrong if self.null_passes else scope.missing(self.column) | wrong


@dataclass(frozen=True)
class NotAfter(Check):
    """Fails where the text form sorts after the current month of the run, or after `limit`."""

    column: str
    limit: str | None = None
    null_fails: bool = True

    @property
    def columns(self):
        return (self.column,)

    def fails(self, scope: Scope) -> Column:
        limit = self.limit or scope.as_of
        if limit is None:
            raise ValueError(f"{self.column}: give as_of to the run, or a limit to the check")
        after = scope.raw(self.column).cast("string") > limit
        return scope.missing(self.column) | after if self.null_fails else after


@dataclass(frozen=True)
class MapsTo(Check):
    """Fails where `source` is a known name and `target` is not the value mapped to it. Unknown names pass."""

    source: str
    target: str
    mapping: Mapping[str, str]

    @property
    def columns(self):
        return (self.source, self.target)

    def expected(self, scope: Scope) -> Column:
        lookup = F.create_map(*[F.lit(x) for pair in self.mapping.items() for x in pair])
        return lookup[scope.col(self.source)]

    def fails(self, scope: Scope) -> Column:
        expected = self.expected(scope)
        return expected.isNotNull() & ~scope.col(self.target).eqNullSafe(expected)

    def failed_value(self, scope: Scope) -> Column:
        return scope.raw(self.target)


@dataclass(frozen=True)
class Compare(Check):
    """Fails where both columns are set and `left op right` does not hold."""

    left: str
    op: str
    right: str

    @property
    def columns(self):
        return (self.left, self.right)

    def fails(self, scope: Scope) -> Column:
        return ~COMPARISONS[self.op](scope.col(self.left), scope.col(self.right))


@dataclass(frozen=True)
class Where(Check):
    """Fails where a SQL expression, or a function of the scope, is true. The way to add a rule of one's own."""

    predicate: str | Callable[[Scope], Column]
    columns: tuple[str, ...]

    def fails(self, scope: Scope) -> Column:
        return F.expr(self.predicate) if isinstance(self.predicate, str) else self.predicate(scope)


@dataclass(frozen=True)
class SigmaOutlier(Check):
    """Fails below `low`, above `high`, or above mean + k * stddev_samp of its group.

    Rows without a group, or alone in it, are held to the bounds only. `two_sided` also fails below mean - k * stddev.
    """

    column: str
    by: str
    k: float = 3
    low: float | None = None
    high: float | None = None
    two_sided: bool = False
    reasons: tuple[str, str, str] = ("below the minimum", "above the maximum", "above mean + k * stddev of its group")
    places: int = 2

    @property
    def columns(self):
        return (self.column, self.by)

    @property
    def mean(self) -> str:
        return f"_mean__{self.column}__by__{self.by}"

    @property
    def std(self) -> str:
        return f"_std__{self.column}__by__{self.by}"

    def upper(self) -> Column:
        return F.col(f"`{self.mean}`") + F.lit(float(self.k)) * F.col(f"`{self.std}`")

    def fails(self, scope: Scope) -> Column:
        value = scope.col(self.column)
        parts = [] if self.low is None else [value < self.low]
        if self.high is not None:
            parts.append(value > self.high)
        parts.append(value > self.upper())
        if self.two_sided:
            parts.append(value < F.col(f"`{self.mean}`") - F.lit(float(self.k)) * F.col(f"`{self.std}`"))
        expr = F.coalesce(parts[0], F.lit(False))
        for part in parts[1:]:
            expr = expr | F.coalesce(part, F.lit(False))
        return expr

    def reason(self, scope: Scope) -> Column:
        value, (low, high, sigma) = scope.col(self.column), self.reasons
        expr = F.lit(sigma)
        if self.high is not None:
            expr = F.when(value > self.high, high).otherwise(expr)
        if self.low is not None:
            expr = F.when(value < self.low, low).otherwise(expr)
        return expr


@dataclass(frozen=True)
class Unique(GroupCheck):
    """Fails every row whose key occurs more than once; nulls count as equal.

    With `digest`, text keys are compared by their SHA-256, so that long texts are neither shuffled nor broadcast. With
    `candidates`, keys are first counted by a hash of eight bytes, and only rows whose hash occurs more than once are grouped
    by the keys themselves: for wide keys of which few repeat. The result is exact either way.
    """

    keys: tuple[str, ...]
    digest: bool = False
    candidates: bool = False

    @property
    def columns(self):
        return self.keys

    @property
    def flag(self) -> str:
        return "_copies__" + "__".join(self.keys)

    def runnable(self, scope: Scope) -> bool:
        return any(scope.has(k) for k in self.keys)

    def present(self, scope: Scope) -> list[str]:
        return [k for k in self.keys if scope.has(k)]

    def key(self, name: str, scope: Scope) -> Column:
        if self.digest and isinstance(scope.dtype(name), T.StringType):
            return F.sha2(scope.col(name), 256)
        return scope.col(name)

    def possible(self, df: DataFrame, scope: Scope) -> DataFrame:
        """The keys of the rows that may have an equal; with `candidates`, few others than those that have."""
        keys = self.present(scope)
        rows = df.select(*[self.key(k, scope).alias(k) for k in keys])
        if not self.candidates:
            return rows
        hashed = F.xxhash64(*keys)
        twice = rows.groupBy(hashed.alias("_hash")).agg(F.count(F.lit(1)).alias("_n")).filter("_n > 1").withColumn("_maybe", F.lit(True))
        found = attach(rows, Facts(twice, ("_hash",), ("_maybe",), row_keys=(hashed,)))
        return found.filter("_maybe").select(*keys)

    def groups(self, df: DataFrame, scope: Scope) -> DataFrame:
        """Keys with their number of rows (`_n`); with `candidates`, those that occur once may be absent."""
        keys = self.present(scope)
        return self.possible(df, scope).groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))

    def facts(self, df: DataFrame, scope: Scope) -> Facts:
        groups = self.groups(df, scope).filter("_n > 1").withColumn(self.flag, F.col("_n"))
        keys = self.present(scope)
        return Facts(groups, tuple(keys), (self.flag,), row_keys=tuple(self.key(k, scope) for k in keys))

    def tally(self, df: DataFrame, scope: Scope) -> DataFrame:
        copies = F.sum(F.when(F.col("_n") > 1, F.col("_n")))
        total = F.lit(df.count()) if self.candidates else F.coalesce(F.sum("_n"), F.lit(0))
        return self.groups(df, scope).agg(total.cast("long").alias("total"), F.coalesce(copies, F.lit(0)).alias("failed"))

    def tally_by(self, df: DataFrame, scope: Scope, slices: Sequence[str]) -> DataFrame:
        keys = [F.col(f"_k{i}") for i in range(len(self.present(scope)))]
        own = [self.key(k, scope).alias(f"_k{i}") for i, k in enumerate(self.present(scope))]
        counts = df.select(*own, *_slices(slices)).groupBy(*keys, *_slices(slices)).agg(F.count(F.lit(1)).alias("_n"))
        # a key has at most one row per slice here
        copies = F.sum("_n").over(Window.partitionBy(*keys))
        return _sums(counts.withColumn("_bad", copies > 1), slices)

    def fails(self, scope: Scope) -> Column:
        return F.col(f"`{self.flag}`").isNotNull()


def _slices(slices: Sequence[str]) -> list[Column]:
    return [F.col(f"`{s}`") for s in slices]


def _sums(counts: DataFrame, slices: Sequence[str]) -> DataFrame:
    """Rows (slices, _n, _bad) as one row per slice: total, failed."""
    failed = F.coalesce(F.sum(F.when(F.col("_bad"), F.col("_n"))), F.lit(0))
    return counts.groupBy(*_slices(slices)).agg(F.sum("_n").alias("total"), failed.alias("failed"))


@dataclass(frozen=True)
class InReference(GroupCheck):
    """Fails where the value is not found in `ref_column` of a reference table of any size."""

    column: str
    reference: DataFrame
    ref_column: str
    null_passes: bool = False

    @property
    def columns(self):
        return (self.column,)

    @property
    def flag(self) -> str:
        return f"_unknown__{self.column}"

    def counts(self, df: DataFrame, scope: Scope, slices: Sequence[str] = ()) -> DataFrame:
        # Both sides are unique per key before they meet, so a hot value weighs no more than any other.
        own = [F.col("_v"), *_slices(slices)]
        values = df.select(scope.col(self.column).alias("_v"), *own[1:]).groupBy(*own).agg(F.count(F.lit(1)).alias("_n"))
        known = self.reference.select(F.col(self.ref_column).alias("_r")).distinct()
        missing = F.col("_r").isNull()
        if self.null_passes:
            missing = missing & F.col("_v").isNotNull()
        return values.join(known, F.col("_v") == F.col("_r"), "left").select(*own, "_n", missing.alias("_missing"))

    def facts(self, df: DataFrame, scope: Scope) -> Facts:
        # Heavy values stay in the facts even when they are known, as attach() needs them to spread their rows. The total is
        # known first, so that the known light values, nearly all there are, are never written.
        heavy = F.col("_n") * HEAVY > F.lit(df.count())
        flag = F.when(F.col("_missing"), F.lit(True)).alias(self.flag)
        kept = self.counts(df, scope).filter(F.col("_missing") | heavy).select(F.col("_v").alias(self.column), "_n", flag)
        return Facts(kept, (self.column,), (self.flag,))

    def tally(self, df: DataFrame, scope: Scope) -> DataFrame:
        return self.counts(df, scope).agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total"),
            F.coalesce(F.sum(F.when(F.col("_missing"), F.col("_n"))), F.lit(0)).alias("failed"),
        )

    def tally_by(self, df: DataFrame, scope: Scope, slices: Sequence[str]) -> DataFrame:
        return _sums(self.counts(df, scope, slices).withColumn("_bad", F.col("_missing")), slices)

    def fails(self, scope: Scope) -> Column:
        return F.col(f"`{self.flag}`").isNotNull()


@dataclass(frozen=True)
class MapsToTable(GroupCheck):
    """Like MapsTo, with a mapping of any size in a table: `known` names and the value `expected` of each. The smallest value
    of a name that the table has several times counts. Unknown names pass."""

    source: str
    target: str
    mapping: DataFrame
    known: str
    expected: str

    @property
    def columns(self):
        return (self.source, self.target)

    @property
    def flag(self) -> str:
        return f"_mapped__{self.source}__{self.target}"

    def _named(self) -> DataFrame:
        names = self.mapping.filter(F.col(self.known).isNotNull() & F.col(self.expected).isNotNull())
        return names.groupBy(F.col(self.known).alias("_k")).agg(F.min(self.expected).alias("_e"))

    def _wrong(self, scope: Scope) -> Column:
        return F.col("_e").isNotNull() & ~F.col("_v").eqNullSafe(F.col("_e"))

    def _pairs(self, df: DataFrame, scope: Scope, slices: Sequence[str] = ()) -> DataFrame:
        """Each name and value that occur together, once, with the value expected and the number of rows."""
        pairs = df.select(scope.col(self.source).alias("_s"), scope.col(self.target).alias("_v"), *_slices(slices))
        pairs = pairs.groupBy("_s", "_v", *_slices(slices)).agg(F.count(F.lit(1)).alias("_n"))
        return pairs.join(self._named(), F.col("_s") == F.col("_k"), "left")

    def facts(self, df: DataFrame, scope: Scope) -> Facts:
        heavy = F.col("_n") * HEAVY > F.lit(df.count())
        wrong = self._wrong(scope)
        kept = self._pairs(df, scope).filter(wrong | heavy)
        kept = kept.select(F.col("_s").alias(self.source), F.col("_v").alias(self.target), "_n", F.when(wrong, F.lit(True)).alias(self.flag))
        return Facts(kept, (self.source, self.target), (self.flag,))

    def tally(self, df: DataFrame, scope: Scope) -> DataFrame:
        return self._pairs(df, scope).agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total"), F.coalesce(F.sum(F.when(self._wrong(scope), F.col("_n"))), F.lit(0)).alias("failed")
        )

    def tally_by(self, df: DataFrame, scope: Scope, slices: Sequence[str]) -> DataFrame:
        return _sums(self._pairs(df, scope, slices).withColumn("_bad", self._wrong(scope)), slices)

    def fails(self, scope: Scope) -> Column:
        return F.col(f"`{self.flag}`").isNotNull()

    def failed_value(self, scope: Scope) -> Column:
        return scope.raw(self.target)


# The short names rules are written with.


def not_null(column: str, unless: tuple[str, Any] | None = None, **defaults: Any) -> NotNull:
    return NotNull(column, unless, defaults)


def non_negative(column: str) -> Bounds:
    return Bounds(column, low=0)


def max_value(column: str, limit: float) -> Bounds:
    return Bounds(column, high=limit)


def min_value(column: str, limit: float) -> Bounds:
    return Bounds(column, low=limit)


def in_domain(column: str, values: Iterable, null_as: Any = None, null_passes: bool = False, **defaults: Any) -> InDomain:
    return InDomain(column, tuple(values), null_as, null_passes, defaults)


def in_reference(column: str, reference: DataFrame, ref_column: str, null_passes: bool = False) -> InReference:
    return InReference(column, reference, ref_column, null_passes)


def matches(column: str, pattern: str, null_passes: bool = False) -> Matches:
    return Matches(column, pattern, null_passes)


def not_after(column: str, limit: str | None = None, null_fails: bool = True) -> NotAfter:
    return NotAfter(column, limit, null_fails)


def maps_to(source: str, target: str, mapping: Mapping[str, str]) -> MapsTo:
    return MapsTo(source, target, mapping)


def maps_to_table(source: str, target: str, mapping: DataFrame, known: str, expected: str) -> MapsToTable:
    return MapsToTable(source, target, mapping, known, expected)


def compare(left: str, op: str, right: str) -> Compare:
    return Compare(left, op, right)


def where(predicate: str | Callable[[Scope], Column], columns: Sequence[str] = ()) -> Where:
    return Where(predicate, tuple(columns))


def sigma_outlier(column: str, by: str, **options: Any) -> SigmaOutlier:
    return SigmaOutlier(column, by, **options)


def unique(*keys: str, digest: bool = False, candidates: bool = False) -> Unique:
    return Unique(tuple(keys), digest, candidates)
