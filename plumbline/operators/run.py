"""Run a pack of rules over a table.

Scorecard: all row rules in one aggregate over one scan; group rules from their own grouped counts, which need only the
key columns and never go back to the rows. Exceptions: one boolean per rule on each row, gathered into `_failed_rules`
and exploded, so the table is read once however many rules there are.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.ladders import status
from plumbline.functions.rates import basis_points, share
from plumbline.operators.checks import SigmaOutlier, Unique
from plumbline.operators.lookup import Facts, attach, attach_all
from plumbline.operators.rule import GroupCheck, Rule, Scope, rule_table
from plumbline.session import materialize

SCORECARD_COLUMNS = (
    "Rule_ID", "Rule_Name", "DQ_Dimension", "CDE_Affected", "Description", "Severity", "Total_Records",
    "Records_Passed", "Records_Failed", "Pass_Rate_Pct", "Status", "Remediation_Action",
)
FAILED = "_failed_rules"


def finish_scorecard(counts: DataFrame, strict_pass: bool = False, before: Sequence[str] = ()) -> DataFrame:
    """Rule metadata, Total_Records and Records_Failed become the twelve scorecard columns, `before` put ahead of them."""
    total, failed = F.col("Total_Records"), F.col("Records_Failed")
    rated = counts.withColumn("Records_Passed", total - failed)
    rated = rated.withColumn("Pass_Rate_Pct", basis_points(F.col("Records_Passed"), total) / F.lit(100.0))
    rate = F.col("Pass_Rate_Pct")
    return rated.withColumn("Status", status(rate, failed if strict_pass else None)).select(*before, *SCORECARD_COLUMNS)


def group_stats(df: DataFrame, scope: Scope, by: str, checks: Sequence[SigmaOutlier]) -> Facts:
    """Mean and sample deviation of every metric asked of one grouping, in one aggregation."""
    # Rows without a group keep their place in the counts, but get no statistics to be compared with.
    grouped = F.col(by).isNotNull()
    wanted = {}
    for check in checks:
        value = scope.col(check.column).cast("double")
        wanted[check.mean] = F.when(grouped, F.avg(value)).alias(check.mean)
        wanted[check.std] = F.when(grouped, F.stddev_samp(value)).alias(check.std)
    stats = df.withColumn(by, scope.col(by)).groupBy(by).agg(F.count(F.lit(1)).alias("_n"), *wanted.values())
    return Facts(stats, (by,), tuple(wanted))


class Run:
    """One evaluation of a pack over a table. Tables it returns are lazy; statistics that several of them need are
    computed once and kept in the shared checkpoint folder.

    as_of    current month YYYY-MM, for rules about the future
    run_ts   text put into `_flagged_at`
    lenient  run on an incomplete table: absent optional columns take the default the check names, uniqueness uses the
             key columns that exist, and a rule that cannot run passes every row
    stats    facts from an earlier run per grouping column, instead of new ones (used by streams)
    """

    def __init__(
        self,
        df: DataFrame,
        rules: Sequence[Rule],
        as_of: str | None = None,
        run_ts: str | None = None,
        lenient: bool = False,
        strict_pass: bool = False,
        stats: dict[str, Facts] | None = None,
    ):
        self.df = df
        self.rules = list(rules)
        self.run_ts = run_ts
        self.lenient = lenient
        self.strict_pass = strict_pass
        self.as_of = as_of
        self.schema = df.schema
        if any("," in r.rule_id for r in self.rules):
            raise ValueError("rule ids must not contain a comma")
        self._stats = dict(stats or {})
        if not lenient:
            absent = sorted({c for r in self.rules for c in r.check.columns} - set(self.schema.names))
            if absent:
                raise ValueError(f"columns not in the table: {', '.join(absent)}")

    def _scope(self, rule: Rule) -> Scope:
        defaults = getattr(rule.check, "defaults", {}) if self.lenient else {}
        return Scope(self.schema, self.as_of, defaults)

    def _runs(self, rule: Rule) -> bool:
        return rule.check.runnable(self._scope(rule))

    def mask(self, rule: Rule) -> Column:
        """Never null: true on failing rows."""
        if not self._runs(rule):
            return F.lit(False)
        return F.coalesce(rule.check.fails(self._scope(rule)), F.lit(False))

    @property
    def row_rules(self) -> list[Rule]:
        return [r for r in self.rules if not isinstance(r.check, GroupCheck)]

    @property
    def group_rules(self) -> list[Rule]:
        return [r for r in self.rules if isinstance(r.check, GroupCheck)]

    @cached_property
    def stats(self) -> dict[str, Facts]:
        groups: dict[str, list[SigmaOutlier]] = {}
        for rule in self.rules:
            if isinstance(rule.check, SigmaOutlier) and self._runs(rule) and rule.check.by not in self._stats:
                groups.setdefault(rule.check.by, []).append(rule.check)
        scope = Scope(self.schema)
        fresh = {by: group_stats(self.df, scope, by, checks).materialized() for by, checks in groups.items()}
        return {**self._stats, **fresh}

    def _stat_facts(self, rules: Sequence[Rule]) -> list[Facts]:
        wanted = {r.check.by for r in rules if isinstance(r.check, SigmaOutlier) and self._runs(r)}
        return [self.stats[by] for by in sorted(wanted)]

    def with_stats(self, rules: Sequence[Rule] | None = None) -> DataFrame:
        """The rows with the group statistics their rules compare with."""
        return attach_all(self.df, self._stat_facts(rules or self.rules))

    @cached_property
    def prepared(self) -> DataFrame:
        """The rows with everything the checks look up: group statistics, copy counts, unknown references."""
        facts = [r.check.facts(self.df, self._scope(r)) for r in self.group_rules if self._runs(r)]
        return attach_all(self.df, [*self._stat_facts(self.rules), *facts])

    @cached_property
    def rule_table(self) -> DataFrame:
        return rule_table(self.df.sparkSession, self.rules)

    def scorecard(self) -> DataFrame:
        """One row per rule."""
        parts = []
        local = [r for r in self.rules if not isinstance(r.check, GroupCheck) or not self._runs(r)]
        if local:
            counts = self.with_stats().agg(
                F.count(F.lit(1)).alias("total"), *[F.count_if(self.mask(r)).alias(f"f{i}") for i, r in enumerate(local)]
            )
            pairs = ", ".join(f"'{r.rule_id}', f{i}" for i, r in enumerate(local))
            parts.append(counts.selectExpr("total", f"stack({len(local)}, {pairs}) AS (Rule_ID, failed)"))
        for rule in self.group_rules:
            if self._runs(rule):
                tally = rule.check.tally(self.df, self._scope(rule))
                parts.append(tally.selectExpr("total", f"'{rule.rule_id}' AS Rule_ID", "failed"))
        counts = parts[0]
        for part in parts[1:]:
            counts = counts.unionByName(part)
        # One row per rule on both sides, so the broadcast has a known size.
        counts = counts.withColumnsRenamed({"total": "Total_Records", "failed": "Records_Failed"})
        return finish_scorecard(counts.join(F.broadcast(self.rule_table), "Rule_ID"), self.strict_pass)

    def scorecard_by(self, *slices: str, totals: bool = False) -> DataFrame:
        """One row per slice and rule, all slices from the scans that one scorecard takes. Rules that look at several rows
        (uniqueness, references, group statistics) judge them within the whole table, so the counts of the slices add up to
        the table's. A NULL is a slice of its own. With `totals`, also rows for all values of the last slice columns, for those
        of the last but one, and so on; `Slice_Level` tells how many slice columns a row is about."""
        taken = {c.lower() for c in SCORECARD_COLUMNS} | {"slice_level", "total", "failed"}
        clash = [s for s in slices if s.lower() in taken]
        if clash or not slices:
            raise ValueError(f"rename slice columns that the scorecard has itself: {', '.join(clash)}" if clash else "no slice columns")
        own = [F.col(f"`{s}`") for s in slices]
        parts = []
        local = [r for r in self.rules if not isinstance(r.check, GroupCheck) or not self._runs(r)]
        if local:
            masks = [F.count_if(self.mask(r)).alias(f"_f{i}") for i, r in enumerate(local)]
            counts = self.with_stats().groupBy(*own).agg(F.count(F.lit(1)).alias("total"), *masks)
            pairs = ", ".join(f"'{r.rule_id}', _f{i}" for i, r in enumerate(local))
            parts.append(counts.selectExpr(*[f"`{s}`" for s in slices], "total", f"stack({len(local)}, {pairs}) AS (Rule_ID, failed)"))
        for rule in self.group_rules:
            if self._runs(rule):
                tally = rule.check.tally_by(self.df, self._scope(rule), slices)
                parts.append(tally.select(*own, "total", F.lit(rule.rule_id).alias("Rule_ID"), "failed"))
        counts = parts[0]
        for part in parts[1:]:
            counts = counts.unionByName(part)
        sums = [F.sum("total").alias("Total_Records"), F.sum("failed").alias("Records_Failed")]
        before = list(slices)
        if totals:  # added up from the counts, which are few, not from the rows
            sets = [[*own[:n], F.col("Rule_ID")] for n in range(len(own), -1, -1)]
            level = F.lit(len(own))
            for s in own:
                level = level - F.grouping(s)
            counts = counts.groupingSets(sets, *own, F.col("Rule_ID")).agg(*sums, level.cast("int").alias("Slice_Level"))
            before.append("Slice_Level")
        else:
            counts = counts.withColumnsRenamed({"total": "Total_Records", "failed": "Records_Failed"})
        return finish_scorecard(counts.join(F.broadcast(self.rule_table), "Rule_ID"), self.strict_pass, [f"`{b}`" for b in before])

    def _joined_ids(self) -> Column:
        # Built as text and split afterwards: unlike a filtered array, this stays in generated code with all the masks.
        return F.concat_ws(",", *[F.when(self.mask(r), F.lit(r.rule_id)) for r in self.rules])

    def annotated(self) -> DataFrame:
        """The table with `_failed_rules`, the ids of the rules each row fails, in pack order."""
        record = [F.col(f"`{c}`") for c in self.schema.names]
        rows = self.prepared.select(*record, self._joined_ids().alias("_ids"))
        ids = F.when(F.col("_ids") == "", F.array().cast("array<string>")).otherwise(F.split("_ids", ","))
        return rows.select(*record, ids.alias(FAILED))

    def failures_per_record(self) -> DataFrame:
        """Rows (rules_failed, records): how many records fail so many rules. With one uniqueness rule, records are counted per
        key and number of other failed rules, so repeated keys need not be joined back to the rows."""
        unique = [r for r in self.group_rules if self._runs(r) and isinstance(r.check, Unique)]
        alone = unique[0] if len(unique) == 1 else None
        counted = [r for r in self.rules if r is not alone]
        failed = F.lit(0)
        for rule in counted:
            failed = failed + self.mask(rule).cast("int")
        if alone is None:
            return self.prepared.select(failed.alias("rules_failed")).groupBy("rules_failed").agg(F.count(F.lit(1)).alias("records"))
        scope = self._scope(alone)
        facts = [r.check.facts(self.df, self._scope(r)) for r in self.group_rules if self._runs(r) and r is not alone]
        keys = [f"_k{i}" for i in range(len(alone.check.present(scope)))]
        own = [alone.check.key(c, scope).alias(k) for c, k in zip(alone.check.present(scope), keys, strict=True)]
        rows = attach_all(self.df, [*self._stat_facts(counted), *facts]).select(*own, failed.alias("_failed"))
        shares = [F.count_if(F.col("_failed") == n).alias(f"_f{n}") for n in range(len(counted) + 1)]
        groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), *shares)
        zero = F.lit(0).cast("long")
        sums = []
        for n in range(len(counted) + 2):  # records of a repeated key fail one rule more
            here = F.col(f"_f{n}") if n <= len(counted) else zero
            below = F.col(f"_f{n - 1}") if n else zero
            sums.append(F.sum(F.when(F.col("_n") > 1, below).otherwise(here)).alias(f"_s{n}"))
        pairs = ", ".join(f"{n}, _s{n}" for n in range(len(counted) + 2))
        return groups.agg(*sums).selectExpr(f"stack({len(counted) + 2}, {pairs}) AS (rules_failed, records)").filter("records > 0")

    def only(self, rule_ids: Sequence[str]) -> Run:
        """The run of some of the rules, for results that need no others."""
        some = [r for r in self.rules if r.rule_id in set(rule_ids)]
        return Run(self.df, some, self.as_of, self.run_ts, self.lenient, self.strict_pass, self._stats)

    def exceptions(self) -> DataFrame:
        """One row per record and failed rule: the record, then the eight columns about the failure."""
        record = [f"`{c}`" for c in self.schema.names]
        rows = self.prepared.select(*[F.col(c) for c in record], self._joined_ids().alias("_ids"))
        rows = rows.filter("_ids <> ''").selectExpr(*record, "explode(split(_ids, ',')) AS Rule_ID")
        # As many rows as the pack has rules, so the broadcast has a known size.
        return rows.join(F.broadcast(self.rule_table), "Rule_ID").selectExpr(
            *record,
            "Rule_ID AS _rule_id",
            "Rule_Name AS _rule_name",
            "DQ_Dimension AS _dimension",
            "CDE_Affected AS _cde",
            "Severity AS _severity",
            "Description AS _failure_reason",
            "Remediation_Action AS _remediation",
        ).withColumn("_flagged_at", F.lit(self.run_ts).cast("string"))

    def failing_rows(self, rule_id: str) -> DataFrame:
        """The rows that fail one rule, read with the filter pushed into the scan where its form allows."""
        rule = self.rule(rule_id)
        if not self._runs(rule):
            return self.df.limit(0)
        rows = self.with_stats([rule])
        if isinstance(rule.check, GroupCheck):
            rows = attach(rows, rule.check.facts(self.df, self._scope(rule)))
        return rows.filter(rule.check.fails(self._scope(rule)))

    def rule(self, rule_id: str) -> Rule:
        return next(r for r in self.rules if r.rule_id == rule_id)

    def violations(self, rule_id: str, keys: Sequence[str], inner: bool = False) -> DataFrame:
        """The failing rows of one rule in listing form: rule, key columns, failed value and reason. Statistical rules
        add the group's mean, deviation and upper limit; with `inner` they list rows that have them only, so not those without a
        group or in one without values."""
        rule, check = self.rule(rule_id), self.rule(rule_id).check
        scope = self._scope(rule)
        head = [
            F.lit(rule.rule_id).alias("rule_id"),
            F.lit(rule.name).alias("rule_name"),
            F.lit(rule.dimension).alias("dq_dimension"),
            *[F.col(f"`{k}`") for k in keys],
        ]
        rows, reason = self.failing_rows(rule_id), F.lit(rule.reason or rule.description)
        if inner and isinstance(check, SigmaOutlier):
            rows = rows.filter(F.col(f"`{check.mean}`").isNotNull())
        if isinstance(check, SigmaOutlier):
            detail = [
                scope.raw(check.column).alias("failed_value"),
                F.col(f"`{check.mean}`").alias("group_mean"),
                F.col(f"`{check.std}`").alias("group_std"),
                F.round(check.upper(), check.places).alias("upper_threshold"),
            ]
            reason = F.lit(rule.reason) if rule.reason else check.reason(scope)
        elif isinstance(check, Unique):
            detail = [F.col(f"`{check.flag}`").alias("duplicate_count")]
        else:
            detail = [check.failed_value(scope).alias("failed_value")]
        return rows.select(*head, *detail, reason.alias("failure_reason"))

    def duplicate_groups(self, rule_id: str) -> DataFrame:
        """The keys of a uniqueness rule that occur more than once, one row per key."""
        rule = self.rule(rule_id)
        scope = self._scope(rule)
        groups = rule.check.groups(self.df, scope).filter("_n > 1")
        return groups.select(
            F.lit(rule.rule_id).alias("rule_id"),
            F.lit(rule.name).alias("rule_name"),
            F.lit(rule.dimension).alias("dq_dimension"),
            *rule.check.present(scope),
            F.col("_n").alias("duplicate_count"),
            F.lit(rule.reason or rule.description).alias("failure_reason"),
        )

    def unique_failed(self) -> DataFrame:
        """One row: records, records that fail at least one rule, and the share of clean records."""
        group_rules = [r for r in self.group_rules if self._runs(r)]
        if len(group_rules) == 1 and isinstance(group_rules[0].check, Unique):
            counts = self._failed_by_grain(group_rules[0])
        else:
            counts = self.annotated().agg(
                F.count(F.lit(1)).alias("total_records"), F.count_if(F.size(FAILED) > 0).alias("failed_records")
            )
        total, failed = F.col("total_records"), F.col("failed_records")
        return counts.withColumn("clean_pct", share(total - failed, total))

    def scorecard_and_unique_failed(self) -> tuple[DataFrame, DataFrame]:
        """Both results. With one uniqueness rule they come from one grouping by its key, which is stored as one row."""
        group_rules = [r for r in self.group_rules if self._runs(r)]
        if len(group_rules) != 1 or not isinstance(group_rules[0].check, Unique):
            return self.scorecard(), self.unique_failed()
        rule = group_rules[0]
        scope = self._scope(rule)
        local = [r for r in self.rules if r is not rule]
        other = F.lit(False)
        for i in range(len(local)):
            other = other | F.col(f"_f{i}")
        keys = rule.check.present(scope)
        rows = self.with_stats().select(
            *[rule.check.key(k, scope).alias(k) for k in keys], *[self.mask(r).alias(f"_f{i}") for i, r in enumerate(local)]
        )
        groups = rows.groupBy(*keys).agg(
            F.count(F.lit(1)).alias("_n"), F.count_if(other).alias("_m"), *[F.count_if(f"_f{i}").alias(f"_f{i}") for i in range(len(local))]
        )
        copies = F.sum(F.when(F.col("_n") > 1, F.col("_n")))
        failed = F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(F.col("_m")))
        sums = {"total": F.sum("_n"), "copies": copies, "failed_records": failed} | {f"f{i}": F.sum(f"_f{i}") for i in range(len(local))}
        one = materialize(groups.agg(*[F.coalesce(v, F.lit(0)).alias(k) for k, v in sums.items()]))
        pairs = ", ".join([*(f"'{r.rule_id}', f{i}" for i, r in enumerate(local)), f"'{rule.rule_id}', copies"])
        counts = one.selectExpr("total AS Total_Records", f"stack({len(self.rules)}, {pairs}) AS (Rule_ID, Records_Failed)")
        score = finish_scorecard(counts.join(F.broadcast(self.rule_table), "Rule_ID"), self.strict_pass)
        total, bad = F.col("total_records"), F.col("failed_records")
        found = one.select(F.col("total").alias("total_records"), "failed_records").withColumn("clean_pct", share(total - bad, total))
        return score, found

    def _failed_by_grain(self, rule: Rule) -> DataFrame:
        """With one uniqueness rule, the distinct failing records follow from counts per key: all of a repeated key,
        else the rows that fail another rule. That saves the join back to the rows."""
        scope = self._scope(rule)
        other = F.lit(False)
        for r in self.row_rules:
            other = other | self.mask(r)
        keys = rule.check.present(scope)
        rows = self.with_stats().select(*[rule.check.key(k, scope).alias(k) for k in keys], other.alias("_other"))
        groups = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.count_if("_other").alias("_m"))
        failed = F.sum(F.when(F.col("_n") > 1, F.col("_n")).otherwise(F.col("_m")))
        return groups.agg(
            F.coalesce(F.sum("_n"), F.lit(0)).alias("total_records"),
            F.coalesce(failed, F.lit(0)).alias("failed_records"),
        )


def scorecard(df: DataFrame, rules: Sequence[Rule], **options) -> DataFrame:
    return Run(df, rules, **options).scorecard()


def exceptions(df: DataFrame, rules: Sequence[Rule], **options) -> DataFrame:
    return Run(df, rules, **options).exceptions()


def annotate(df: DataFrame, rules: Sequence[Rule], **options) -> DataFrame:
    return Run(df, rules, **options).annotated()


__all__ = ["Run", "annotate", "exceptions", "finish_scorecard", "group_stats", "scorecard"]
