"""Governance tables joined to results: severity bands, steward routing, thresholds, dictionary conformance, lineage,
coverage of critical data elements.

The governance tables themselves are handed in as DataFrames or small lists; rules and elements are few, so routing is
worked out per rule and only then meets the exceptions.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from plumbline.functions.rates import percent
from plumbline.operators.bands import BOUND, bands, in_band
from plumbline.operators.rule import Scope
from plumbline.session import materialize

# Severity, from which failure percentage on, responder, target, escalation. High takes in 15 itself.
ESCALATION = (
    ("Low", 0, "Data Steward", "5 business days", "Data Owner (if unresolved after 5 days)"),
    ("Medium", 1, "Data Steward", "2 business days", "Data Owner within 2 days"),
    ("High", 5, "Data Owner + Data Steward", "Same business day", "CDO if not resolved within 24 hours"),
    ("Critical", 15, "CDO + Data Owner + IT Custodian", "Immediate (within 4 hours)",
     "Executive Leadership / CISO if breach risk"),
)


def _band() -> Column:
    """The place of a rule's failure rate in ESCALATION, compared in whole numbers. A band begins at its percentage, the last
    one beyond it."""
    failed, total = F.col("Records_Failed").cast("decimal(38,0)") * 100, F.col("Total_Records").cast("decimal(38,0)")
    place = F.lit(0)
    for i, (_, begin, *_) in enumerate(ESCALATION[1:], 1):
        reached = failed > total * begin if i == len(ESCALATION) - 1 else failed >= total * begin
        place = F.when(reached, i).otherwise(place)
    return place


#: The columns of an escalation table beside its bounds, in percent.
ESCALATION_COLUMNS = ("Issue_Severity", "First_Responder", "Resolution_Target", "Escalate_To")


def escalation_bands(table: DataFrame) -> DataFrame:
    """A table of bands from a file: From_Pct, To_Pct (empty: no end), To_Included, and who responds by when."""
    below = F.coalesce(F.col("To_Included").cast("boolean"), F.lit(False))
    named = table.select(*ESCALATION_COLUMNS, "From_Pct", "To_Pct", below.alias("To_Included"))
    # a bound belongs to one side only: a band begins at its bound unless the one below takes it in
    taken = named.filter("To_Included").select(F.col("To_Pct").cast(BOUND).alias("_taken")).distinct()
    begins = F.col("From_Pct").cast(BOUND) == F.col("_taken")
    marked = named.join(taken, begins, "left").withColumn("From_Included", F.col("_taken").isNull()).drop("_taken")
    return bands(marked, "From_Pct", "To_Pct", "From_Included", "To_Included").drop("From_Pct", "To_Pct", "From_Included", "To_Included")


def escalation(scorecard: DataFrame, checked: DataFrame | None = None) -> DataFrame:
    """One row per rule with failures: its failure rate, severity, and who responds by when; by ESCALATION, or by a checked
    table of bands."""
    issues = scorecard.filter("Records_Failed > 0")
    if checked is None:
        listed = F.array(
            *[
                F.struct(*[F.lit(x).alias(n) for x, n in zip((s, who, target, to), ESCALATION_COLUMNS, strict=True)])
                for s, _, who, target, to in ESCALATION
            ]
        )
        issues = issues.withColumn("_b", F.element_at(listed, _band() + 1)).select("*", *[f"_b.{c}" for c in ESCALATION_COLUMNS])
    else:
        issues = in_band(issues, checked, F.col("Records_Failed").cast("decimal(20,0)") * 100, F.col("Total_Records"))
    rate = percent(F.col("Records_Failed"), F.col("Total_Records")).alias("Failure_Rate_Pct")
    return issues.select("Rule_ID", "CDE_Affected", "Records_Failed", rate, *ESCALATION_COLUMNS)


#: So many rows of rules and assignments at most are broadcast to the exceptions.
BROADCAST_ROUTES = 100_000


def _tokens(column: str) -> Column:
    return F.explode(F.transform(F.split(F.col(column), "[+/]"), lambda t: F.trim(t)))


def routes(rule_table: DataFrame, assignments: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """Which assignments each rule belongs to: (Rule_ID, CDE and the other assignment columns). Elements written together
    ("A + B", "A / B") match on each part; a rule reaches an assignment once."""
    rules = rule_table.select("Rule_ID", *keep, _tokens("CDE_Affected").alias("_part"))
    parts = assignments.select("*", _tokens("CDE").alias("_part"))
    return rules.join(parts, "_part").drop("_part").distinct()


def route_exceptions(exceptions: DataFrame, rule_table: DataFrame, assignments: DataFrame) -> DataFrame:
    """Each exception with its owner, steward and custodian."""
    # A row per rule and assignment; assignments are handed in, so their number is looked at.
    by_rule = materialize(routes(rule_table, assignments).withColumnRenamed("Rule_ID", "_rule_id"))
    return exceptions.join(F.broadcast(by_rule) if by_rule.count() <= BROADCAST_ROUTES else by_rule, "_rule_id")


def steward_load(scorecard: DataFrame, assignments: DataFrame) -> DataFrame:
    """Failures per assignment and rule. The scorecard has the counts already; no exception is touched."""
    counts = scorecard.filter("Records_Failed > 0").select("Rule_ID", "CDE_Affected", "Records_Failed")
    routed = routes(counts, assignments, keep=["Records_Failed"])
    return routed.select(
        "Rule_ID", "CDE", "Data_Owner", "Data_Steward", "Data_Custodian", "Review_Cycle", F.col("Records_Failed").alias("Failures")
    )


@dataclass(frozen=True)
class Limit:
    """At most (or, with `strict`, less than) `max_pct` percent of the rows may satisfy the predicate of bad rows."""

    cde: str
    label: str
    bad: object  # Callable[[Scope], Column]
    max_pct: int = 0
    strict: bool = False


def threshold_compliance(df: DataFrame, limits: Sequence[Limit]) -> DataFrame:
    """Rows (CDE, Threshold, Bad_Records, Bad_Pct, Within_Limit, CDE_Status), from one aggregate. An element is compliant
    when all its limits hold."""
    scope = Scope(df.schema)
    counts = df.agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(F.coalesce(x.bad(scope), F.lit(False))).alias(f"c{i}") for i, x in enumerate(limits)],
    )
    total = F.col("total")
    lines, held = [], {}
    for i, x in enumerate(limits):
        bad = F.col(f"c{i}") * 100
        ok = (bad < total * x.max_pct) | (F.col(f"c{i}") == 0) if x.strict else bad <= total * x.max_pct
        held.setdefault(x.cde, []).append(ok)
        lines.append((x, F.col(f"c{i}"), ok))
    status = {}
    for cde, oks in held.items():
        every = oks[0]
        for ok in oks[1:]:
            every = every & ok
        status[cde] = F.when(every, "Compliant").otherwise("Requires remediation")
    return counts.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(x.cde).alias("CDE"),
                        F.lit(x.label).alias("Threshold"),
                        n.alias("Bad_Records"),
                        percent(n, total).alias("Bad_Pct"),
                        ok.alias("Within_Limit"),
                        status[x.cde].alias("CDE_Status"),
                    )
                    for x, n, ok in lines
                ]
            )
        )
    )


def conformance(df: DataFrame, dictionary: Sequence[tuple[str, str, bool]]) -> DataFrame:
    """The table against a dictionary of (column, type family, nullable). Rows (Column, Expected_Type, Actual_Type,
    Nullable, Null_Count, Conforms). Columns the dictionary lacks appear with a null expected type."""
    schema = df.schema
    scope = Scope(schema)
    known = [name for name, *_ in dictionary]
    lines = [(name, family, nullable) for name, family, nullable in dictionary]
    lines += [(name, None, None) for name in schema.names if name not in known]
    present = [name for name, *_ in lines if scope.has(name)]
    counts = df.agg(*[F.count_if(scope.missing(c)).alias(f"n{present.index(c)}") for c in present])

    def line(name: str, family: str | None, nullable: bool | None) -> Column:
        actual = type_family(schema[name].dataType.simpleString()) if scope.has(name) else None
        nulls = F.col(f"n{present.index(name)}") if scope.has(name) else F.lit(None).cast("long")
        fits = F.lit(False)
        if family is not None and actual == family:
            fits = F.lit(True) if nullable else nulls == 0
        return F.struct(
            F.lit(name).alias("Column"),
            F.lit(family).cast("string").alias("Expected_Type"),
            F.lit(actual).cast("string").alias("Actual_Type"),
            F.lit(nullable).cast("boolean").alias("Nullable"),
            nulls.alias("Null_Count"),
            fits.alias("Conforms"),
        )

    return counts.select(F.inline(F.array(*[line(*x) for x in lines])))


def catalog_conformance(df: DataFrame, declared_rows: int, declared_columns: int) -> DataFrame:
    """The size of a table against its catalog entry. Rows (Measure, Declared, Actual, Conforms)."""
    lines = [(F.lit("Row_Count"), declared_rows, F.col("n")), (F.lit("Column_Count"), declared_columns, F.lit(len(df.columns)).cast("long"))]
    parts = [
        F.struct(m.alias("Measure"), F.lit(d).cast("long").alias("Declared"), a.alias("Actual"), (a == d).alias("Conforms"))
        for m, d, a in lines
    ]
    return df.agg(F.count(F.lit(1)).alias("n")).select(F.inline(F.array(*parts)))


def size_conformance(df: DataFrame, sizes: Sequence[tuple[str, int, int | None]]) -> DataFrame:
    """Values against declared sizes: (column, characters, None) for a text, (column, digits, places) for a decimal. Rows
    (Column, Declared, Too_Large, Conforms), from one aggregate. Columns that the table lacks are left out."""
    present = [x for x in sizes if x[0] in df.columns]

    def beyond(column: str, size: int, places: int | None) -> Column:
        value = F.col(f"`{column}`")
        if places is None:
            return F.length(value.cast("string")) > size
        return (F.abs(value) >= F.lit(10 ** (size - places))) | (F.round(value, places) != value)

    counts = df.agg(*[F.count_if(beyond(*x)).alias(f"n{i}") for i, x in enumerate(present)])
    declared = [f"VARCHAR({size})" if places is None else f"DECIMAL({size},{places})" for _, size, places in present]
    parts = [
        F.struct(
            F.lit(x[0]).alias("Column"), F.lit(d).alias("Declared"), F.col(f"n{i}").alias("Too_Large"), (F.col(f"n{i}") == 0).alias("Conforms")
        )
        for i, (x, d) in enumerate(zip(present, declared, strict=True))
    ]
    return counts.select(F.inline(F.array(*parts)))


def type_family(spark_type: str) -> str:
    if spark_type.startswith(("string", "varchar", "char")):
        return "text"
    if spark_type in ("tinyint", "smallint", "int", "bigint"):
        return "integer"
    if spark_type in ("float", "double") or spark_type.startswith("decimal"):
        return "decimal"
    return spark_type


def trace(edges: DataFrame, roots: DataFrame, max_depth: int | None = None) -> DataFrame:
    """All upstream hops of the root fields. `edges`: (cde, src_system, src_field, dst_system, dst_field), `roots`: (cde,
    system, field). Rows (cde, hop, src_system, src_field, dst_system, dst_field): an edge is walked once per element, at the
    least number of hops, so cycles end. `max_depth` asks for fewer hops.

    Fields with one edge upstream make chains. Along these, pointers are doubled: the n-th table of pointers leads 2**n hops
    up, and the distances of the fields reached are carried over all tables in turn. A chain of n hops thus takes about
    2 * log2(n) small joins; a further round is needed only where a walk goes on behind a field with several edges."""
    columns = ["cde", "src_system", "src_field", "dst_system", "dst_field"]
    edges = edges.select(*columns).distinct()
    field = lambda side: F.struct(F.col(f"{side}_system").alias("system"), F.col(f"{side}_field").alias("field"))
    steps = materialize(edges.filter("dst_system IS NOT NULL AND dst_field IS NOT NULL").select("cde", field("dst").alias("at"), field("src").alias("to")))
    ways = steps.groupBy("cde", "at").agg(F.count(F.lit(1)).alias("ways"), F.min("to").alias("to"))
    pointers = [materialize(ways.filter("ways = 1").select("cde", "at", "to"))]
    limit = pointers[0].count()
    forks = materialize(steps.join(ways.filter("ways > 1").select("cde", "at"), ["cde", "at"], "left_semi"))
    while 2 ** len(pointers) <= limit:  # a walk without a fork or a cycle has no more hops than there are pointers
        last = pointers[-1]
        on = last.select("cde", F.col("at").alias("to"), F.col("to").alias("beyond"))
        doubled = materialize(last.join(on, ["cde", "to"]).select("cde", "at", F.col("beyond").alias("to")))
        if doubled.isEmpty():
            break
        pointers.append(doubled)
    fresh = materialize(roots.select("cde", F.struct("system", "field").alias("at"), F.lit(0).alias("hops")).distinct())
    known = fresh.limit(0)
    while not fresh.isEmpty():
        for n, table in enumerate(pointers):
            up = fresh.join(table, ["cde", "at"]).select("cde", F.col("to").alias("at"), (F.col("hops") + 2**n).alias("hops"))
            fresh = materialize(fresh.union(up).groupBy("cde", "at").agg(F.min("hops").alias("hops")))
        before = known.withColumnRenamed("hops", "known_hops")
        nearer = fresh.join(before, ["cde", "at"], "left").filter(F.col("known_hops").isNull() | (F.col("hops") < F.col("known_hops"))).drop("known_hops")
        nearer = materialize(nearer)
        known = materialize(known.union(nearer).groupBy("cde", "at").agg(F.min("hops").alias("hops")))
        fresh = nearer.join(forks, ["cde", "at"]).select("cde", F.col("to").alias("at"), (F.col("hops") + 1).alias("hops"))
        fresh = materialize(fresh.groupBy("cde", "at").agg(F.min("hops").alias("hops")))
    found = steps.join(known, ["cde", "at"]).withColumn("hop", F.col("hops") + 1)
    found = found if max_depth is None else found.filter(F.col("hop") <= max_depth)
    ends = [F.col(f"{side}.{part}").alias(f"{name}_{part}") for side, name in (("to", "src"), ("at", "dst")) for part in ("system", "field")]
    return found.select("cde", F.col("hop").cast("int").alias("hop"), *ends)


def cde_coverage(scorecard: DataFrame, cdes: DataFrame) -> DataFrame:
    """Per critical data element (column `CDE`): the rules on it, those that do not pass, and their failures. Elements
    without a rule are kept with zero rules."""
    rules = scorecard.select(_tokens("CDE_Affected").alias("CDE"), "Rule_ID", "Status", "Records_Failed")
    joined = cdes.select("CDE").join(rules, "CDE", "left")
    return joined.groupBy("CDE").agg(
        F.count("Rule_ID").alias("Rules"),
        F.count_if(F.col("Status") != "PASS").alias("Rules_Not_Passing"),
        F.coalesce(F.sum("Records_Failed"), F.lit(0)).alias("Failures"),
    )


def uncovered_columns(columns: Sequence[str], rule_table: DataFrame) -> DataFrame:
    """Columns that no rule is about."""
    spark = rule_table.sparkSession
    table = spark.createDataFrame([(c,) for c in columns], "column string")
    ruled = rule_table.select(_tokens("CDE_Affected").alias("column")).distinct()
    return table.join(ruled, "column", "left_anti")


