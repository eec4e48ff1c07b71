"""Column profiles, domain checks and the profile scorecard.

Nulls, extremes, moments and signs come from one aggregate over one scan. Distinct values, the most frequent one, quartiles
and outliers need every value counted, which is one grouping of (column, value) for all columns together, stored once.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.ladders import grade, status
from plumbline.functions.nulls import drop_nan
from plumbline.functions.rates import basis_points, percent
from plumbline.operators.checks import Check
from plumbline.operators.quantiles import frequency_quantiles
from plumbline.operators.rule import Scope
from plumbline.session import materialize, write_rows

QUARTILES = (0.25, 0.5, 0.75)
IQR_FENCE = 1.5
LONG_TEXT = 128


def _clean(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    schema = df.schema
    return df.select(*[drop_nan(F.col(f"`{c}`"), schema[c].dataType).alias(c) for c in columns])


def _is_number(dtype: T.DataType) -> bool:
    return isinstance(dtype, T.NumericType)


def _brief(text: Column) -> Column:
    """A text as it is, or if it is long, its beginning and its digest."""
    return F.when(F.length(text) <= LONG_TEXT, text).otherwise(F.concat(F.left(text, F.lit(LONG_TEXT)), F.lit("\0"), F.sha2(text, 256)))


def value_frequencies(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows (place, value, number, n): how often each non-null value of the column at that place in `columns` occurs.
    `number` carries numeric order. Long texts stand as beginning and digest, so that they are not shuffled whole."""
    schema = df.schema
    lines = []
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        number = col if _is_number(schema[c].dataType) else F.lit(None)
        lines.append(F.struct(F.lit(i).alias("place"), _brief(col.cast("string")).alias("value"), number.cast("double").alias("number")))
    values = df.select(F.inline(F.array(*lines))).filter("value IS NOT NULL")
    return values.groupBy("place", "value", "number").agg(F.count(F.lit(1)).alias("n"))


def _from_frequencies(frequencies: DataFrame, columns: Sequence[str], fences: dict[str, tuple[float, float]]) -> DataFrame:
    """One row per column: distinct values, the most frequent value, its count, rows outside the fences. One aggregate
    without grouping keys, as a smallest-of-text aggregate with keys would sort all the values first."""
    best = F.struct((-F.col("n")).alias("n"), F.col("number"), F.col("value"))
    here = [F.col("place") == i for i in range(len(columns))]

    def outside(c: str) -> Column:
        if c not in fences:
            return F.lit(False)
        return (F.col("number") < F.lit(fences[c][0])) | (F.col("number") > F.lit(fences[c][1]))

    found = frequencies.agg(
        *[F.count_if(cond).alias(f"d{i}") for i, cond in enumerate(here)],
        *[F.min(F.when(cond, best)).alias(f"b{i}") for i, cond in enumerate(here)],
        *[F.coalesce(F.sum(F.when(cond & outside(c), F.col("n"))), F.lit(0)).alias(f"o{i}") for i, (c, cond) in enumerate(zip(columns, here, strict=True))],
    )
    lines = ", ".join(
        f"named_struct('Column', '{c}', 'distinct_values', d{i}, 'top', b{i}.value, 'top_n', -b{i}.n, 'outliers', o{i})"
        for i, c in enumerate(columns)
    )
    return found.selectExpr(f"inline(array({lines}))")


def _whole(table: DataFrame, top: DataFrame) -> DataFrame:
    """Long top values in full, looked up in the table by their digest. At most one for each column."""
    found = {r["Column"]: r["top"] for r in top.filter("instr(top, char(0)) > 0").collect()}
    for c, value in found.items():
        text = table.filter(_brief(F.col(f"`{c}`").cast("string")) == value).select(F.col(f"`{c}`").cast("string")).first()[0]
        top = top.withColumn("top", F.when(F.col("Column") == c, F.lit(text)).otherwise(F.col("top")))
    return top


def _roughly(table: DataFrame, columns: Sequence[str], numeric: Sequence[str]) -> tuple[dict, dict]:
    """Quartiles, and (distinct values, most frequent value, its count), from sketches in one scan. Where no value is frequent
    enough for the sketch to name one, there is none."""
    aggs = [F.percentile_approx(c, list(QUARTILES), 10_000).alias(f"q{columns.index(c)}") for c in numeric]
    aggs += [F.approx_count_distinct(f"`{c}`").alias(f"d{i}") for i, c in enumerate(columns)]
    aggs += [F.expr(f"get(approx_top_k(CAST(`{c}` AS STRING), 1), 0)").alias(f"t{i}") for i, c in enumerate(columns)]
    row = table.agg(*aggs).first()
    quartiles = {c: row[f"q{columns.index(c)}"] or [None] * 3 for c in numeric}
    return quartiles, {c: (row[f"d{i}"], *(row[f"t{i}"] or (None, None))) for i, c in enumerate(columns)}


def column_profile(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    cdes: Sequence[str] = (),
    approximate: bool = False,
    places: int = 2,
) -> DataFrame:
    """One row per column with the 24 profile fields. Number fields are null for columns that hold no numbers, and the
    smallest of equally frequent values is the top value; of long texts with the same beginning, the one with the
    smallest digest.

    The table is read twice: once to count every value, which is stored and gives quartiles, distinct values, modes and
    outliers, and once for the rest. `approximate` takes quartiles, distinct values and modes from sketches, which saves the
    shuffle of all values of a very large table.
    """
    schema = df.schema
    columns = list(columns or schema.names)
    table = _clean(df, columns)
    numeric = [c for c in columns if _is_number(schema[c].dataType)]
    if approximate:
        quartiles, rough = _roughly(table, columns, numeric)
    else:
        frequencies = write_rows(value_frequencies(table, columns))
        found = frequency_quantiles(frequencies, [columns.index(c) for c in numeric], QUARTILES) if numeric else {}
        quartiles = {c: found[columns.index(c)] for c in numeric}
    fences = {c: (q[0] - IQR_FENCE * (q[2] - q[0]), q[2] + IQR_FENCE * (q[2] - q[0])) for c, q in quartiles.items() if q[0] is not None}

    aggs = [F.count(F.lit(1)).alias("total")]
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        aggs.append(F.count_if(col.isNull()).alias(f"null{i}"))
        if c in quartiles:
            aggs += [
                F.min(col).cast("double").alias(f"min{i}"),
                F.max(col).cast("double").alias(f"max{i}"),
                F.avg(col).cast("double").alias(f"mean{i}"),
                F.stddev_samp(col.cast("double")).alias(f"std{i}"),
                F.count_if(col < 0).alias(f"neg{i}"),
                F.count_if(col == 0).alias(f"zero{i}"),
                F.count_if(col > 0).alias(f"pos{i}"),
            ]
        if approximate and c in fences:
            low, high = fences[c]
            aggs.append(F.count_if((col < F.lit(low)) | (col > F.lit(high))).alias(f"out{i}"))
    lines = []
    for i, c in enumerate(columns):
        q1, median, q3 = quartiles.get(c, (None, None, None))
        has = c in quartiles
        none, zero = "CAST(NULL AS DOUBLE)", "0L"
        number = lambda x: none if x is None else f"CAST('{x!r}' AS DOUBLE)"
        lines.append(
            f"named_struct('Column', '{c}', 'Is_CDE', '{'Yes' if c in cdes else 'No'}',"
            f" 'Data_Type', '{schema[c].dataType.simpleString()}', 'nulls', null{i},"
            f" 'min', {f'min{i}' if has else none}, 'max', {f'max{i}' if has else none},"
            f" 'mean', {f'mean{i}' if has else none}, 'std', {f'std{i}' if has else none},"
            f" 'median', {number(median)}, 'q1', {number(q1)}, 'q3', {number(q3)},"
            f" 'neg', {f'neg{i}' if has else zero}, 'zero', {f'zero{i}' if has else zero},"
            f" 'pos', {f'pos{i}' if has else zero}, 'beyond', {f'out{i}' if approximate and c in fences else zero})"
        )
    facts = table.agg(*aggs).selectExpr("total", f"inline(array({', '.join(lines)}))")
    if approximate:
        kind = "Column string, distinct_values long, top string, top_n long"
        counted = df.sparkSession.createDataFrame([(c, *rough[c]) for c in columns], kind)
    else:
        counted = _whole(table, materialize(_from_frequencies(frequencies, columns, fences)))
        facts = facts.drop("beyond")
        counted = counted.withColumnRenamed("outliers", "beyond")
    # One row per column on both sides.
    joined = facts.join(F.broadcast(counted), "Column", "left")
    total, nulls = F.col("total"), F.col("nulls")
    distinct = F.coalesce(F.col("distinct_values"), F.lit(0))
    rounded = {name: F.round(name, places) for name in ("min", "max", "mean", "median", "std", "q1", "q3")}
    return joined.select(
        "Column",
        "Is_CDE",
        "Data_Type",
        total.alias("Total_Records"),
        nulls.alias("Null_Count"),
        percent(nulls, total).alias("Null_Pct"),
        (total - nulls).alias("Not_Null_Count"),
        percent(total - nulls, total).alias("Completeness_Pct"),
        distinct.alias("Unique_Values"),
        percent(distinct, total).alias("Unique_Pct"),
        F.col("top").alias("Top_Value"),
        F.col("top_n").alias("Top_Value_Freq"),
        rounded["min"].alias("Min"),
        rounded["max"].alias("Max"),
        rounded["mean"].alias("Mean"),
        rounded["median"].alias("Median"),
        rounded["std"].alias("Std_Dev"),
        F.col("neg").alias("Negative_Count"),
        F.col("zero").alias("Zero_Count"),
        F.col("pos").alias("Positive_Count"),
        rounded["q1"].alias("Q1"),
        rounded["q3"].alias("Q3"),
        F.col("beyond").alias("Outlier_Count_IQR"),
        percent(F.col("beyond"), total).alias("Outlier_Pct_IQR"),
    )


#: What the sketches of `column_profile(approximate=True)` promise: quartiles within this share of the ranks, numbers of distinct
#: values within this share (three times the sketch's standard error).
RANK_ERROR, DISTINCT_ERROR = 0.001, 0.15


def sketch_error(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """How far the approximate profile of number columns is off: rows (Column, Not_Null_Count, Unique_Values, Rank_Error,
    Distinct_Error), the exact counts and the largest errors as shares. A quartile among equal values is off by the ranks
    between it and them. It costs what the exact profile costs, and is meant for trying the sketches on a part."""
    columns = [c for c in columns or df.columns if _is_number(df.schema[c].dataType)]
    table = _clean(df, columns)
    quartiles, rough = _roughly(table, columns, columns)
    aggs, lines = [], []
    for i, c in enumerate(columns):
        col = F.col(f"`{c}`")
        aggs += [F.count(col).alias(f"n{i}"), F.count_distinct(col).alias(f"d{i}")]
        worst = F.lit(0.0)
        for k, (share, q) in enumerate(zip(QUARTILES, quartiles[c], strict=True)):
            if q is not None:
                aggs += [F.count_if(col <= F.lit(q)).alias(f"le{i}_{k}"), F.count_if(col < F.lit(q)).alias(f"lt{i}_{k}")]
                wanted = F.col(f"n{i}") * share
                off = F.greatest(F.lit(0.0), F.col(f"lt{i}_{k}") - wanted, wanted - F.col(f"le{i}_{k}"))
                worst = F.greatest(worst, F.try_divide(off, F.col(f"n{i}")))
        apart = F.abs(F.lit(rough[c][0]) - F.col(f"d{i}"))
        fields = {"Column": F.lit(c), "Not_Null_Count": F.col(f"n{i}"), "Unique_Values": F.col(f"d{i}"), "Rank_Error": worst}
        fields["Distinct_Error"] = F.coalesce(F.try_divide(apart.cast("double"), F.col(f"d{i}")), F.lit(0.0))
        lines.append(F.struct(*[v.alias(k) for k, v in fields.items()]))
    return table.agg(*aggs).select(F.inline(F.array(*lines)))


@dataclass(frozen=True)
class DomainCheck:
    column: str
    label: str
    check: Check


def domain_validation(df: DataFrame, checks: Sequence[DomainCheck]) -> DataFrame:
    """Rows (Column, Check, Failed_Records, Failed_Pct, Status), all from one aggregate."""
    scope = Scope(df.schema)
    counted = [
        F.count_if(F.coalesce(c.check.fails(scope), F.lit(False))).alias(f"f{i}") for i, c in enumerate(checks)
    ]
    counts = df.agg(F.count(F.lit(1)).alias("total"), *counted)
    lines = [
        F.struct(F.lit(c.column).alias("Column"), F.lit(c.label).alias("Check"), F.col(f"f{i}").alias("failed"))
        for i, c in enumerate(checks)
    ]
    total, failed = F.col("total"), F.col("failed")
    return counts.select("total", F.inline(F.array(*lines))).select(
        "Column",
        "Check",
        failed.alias("Failed_Records"),
        percent(failed, total).alias("Failed_Pct"),
        status(percent(total - failed, total)).alias("Status"),
    )


def profile_scorecard(
    df: DataFrame, checks: Sequence[DomainCheck], keys: Sequence[str], cdes: Sequence[str], dataset: str, date: str
) -> DataFrame:
    """One row: completeness over all cells, mean pass rate of the domain checks, uniqueness of the grain, their mean."""
    schema = df.schema
    columns = schema.names
    table = _clean(df, columns)
    scope = Scope(schema)
    counts = df.select(
        *[drop_nan(F.col(f"`{c}`"), schema[c].dataType).isNull().alias(f"n{i}") for i, c in enumerate(columns)],
        *[F.coalesce(c.check.fails(scope), F.lit(False)).alias(f"f{i}") for i, c in enumerate(checks)],
    ).agg(
        F.count(F.lit(1)).alias("total"),
        *[F.count_if(f"n{i}").alias(f"n{i}") for i in range(len(columns))],
        *[F.count_if(f"f{i}").alias(f"f{i}") for i in range(len(checks))],
    )
    cells, with_nulls = F.lit(0).cast("long"), F.lit(0)
    for i in range(len(columns)):
        cells, with_nulls = cells + F.col(f"n{i}"), with_nulls + (F.col(f"n{i}") > 0).cast("int")
    failed_bp, bad = F.lit(0).cast("long"), F.lit(0).cast("long")
    for i in range(len(checks)):
        failed_bp, bad = failed_bp + basis_points(F.col(f"f{i}"), F.col("total")), bad + (F.col(f"f{i}") > 0).cast("long")
    counts = counts.select("total", cells.alias("null_cells"), with_nulls.alias("with_nulls"), failed_bp.alias("_bp_failed"), bad.alias("_bad"))
    groups = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    copies = groups.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("_copies"))
    n_checks, n_columns = len(checks), len(columns)
    one = counts.join(F.broadcast(copies))  # one row each
    total = F.col("total")
    cell_count = total * n_columns
    completeness = basis_points(cell_count - F.col("null_cells"), cell_count)
    validity = F.call_function("div", (F.lit(n_checks * 10000) - F.col("_bp_failed")) * 2 + n_checks, F.lit(2 * n_checks))
    uniqueness = basis_points(total - F.col("_copies"), total)
    scored = one.select(
        "*", completeness.alias("_c"), validity.cast("long").alias("_v"), uniqueness.cast("long").alias("_u")
    )
    overall = F.call_function("div", (F.col("_c") + F.col("_v") + F.col("_u")) * 2 + 3, F.lit(6)) / F.lit(100.0)
    return scored.select(
        F.lit(dataset).alias("Dataset"),
        F.lit(date).alias("Profile_Date"),
        total.alias("Total_Records"),
        F.lit(n_columns).alias("Total_Columns"),
        F.lit(len(cdes)).alias("CDE_Count"),
        (F.col("_c") / F.lit(100.0)).alias("Completeness_Score"),
        (F.col("_v") / F.lit(100.0)).alias("Validity_Score"),
        (F.col("_u") / F.lit(100.0)).alias("Uniqueness_Score"),
        overall.alias("Overall_DQ_Score"),
        grade(overall).alias("Overall_Grade"),
        F.col("null_cells").alias("Total_Null_Cells"),
        F.col("with_nulls").alias("Columns_With_Nulls"),
        F.lit(n_checks).alias("Domain_Checks_Run"),
        F.col("_bad").alias("Domain_Checks_Failed"),
    )
