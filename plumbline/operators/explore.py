"""Look into rule results and exceptions: filters, options, counts, pages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from plumbline.session import write_rows

ALL = "All"
PAGE_SIZE = 100

# The columns of the rule list and of the exception list.
RULE_COLUMNS = ("Rule_ID", "Rule_Name", "DQ_Dimension", "Severity", "Pass_Rate_Pct", "Records_Failed", "Status")
EXCEPTION_COLUMNS = (
    "REF_DATE", "GEO_CODE", "DWELLING_TYPE", "INTENDED_MARKET", "HOUSING_STARTS", "AVERAGE_PRICE_CAD",
    "_rule_id", "_dimension", "_severity", "_failure_reason",
)


def _where(df: DataFrame, wanted: dict[str, str | None]) -> DataFrame:
    for column, value in wanted.items():
        if value not in (None, ALL) and column in df.columns:
            df = df.filter(F.col(f"`{column}`") == value)
    return df


def filter_rules(scorecard: DataFrame, dimension: str = ALL, severity: str = ALL, status: str = ALL) -> DataFrame:
    return _where(scorecard, {"DQ_Dimension": dimension, "Severity": severity, "Status": status})


def filter_exceptions(
    exceptions: DataFrame, dimension: str = ALL, rule: str = ALL, geo: str = ALL, dwelling: str = ALL
) -> DataFrame:
    """A filter on a column that the exceptions lack is skipped."""
    wanted = {"_dimension": dimension, "_rule_id": rule, "GEO_CODE": geo, "DWELLING_TYPE": dwelling}
    return _where(exceptions, wanted)


def project_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[F.col(f"`{c}`") for c in columns if c in df.columns])


def options(df: DataFrame, column: str) -> DataFrame:
    """The distinct values of a column, sorted, without null."""
    return df.select(F.col(f"`{column}`").alias("option")).distinct().filter("option IS NOT NULL").orderBy("option")


def exception_counts(exceptions: DataFrame) -> DataFrame:
    """One row: exceptions and the number of rules they come from. Counted per rule first, which is a short list."""
    per_rule = exceptions.groupBy("_rule_id").agg(F.count(F.lit(1)).alias("n"))
    return per_rule.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("exceptions"), F.count("_rule_id").alias("rules")
    )


def value_counts(df: DataFrame, column: str) -> DataFrame:
    """Non-null values with their number of rows."""
    value = F.col(f"`{column}`").alias("value")
    return df.select(value).filter("value IS NOT NULL").groupBy("value").agg(F.count(F.lit(1)).alias("failures"))


def top_values(df: DataFrame, column: str, n: int | None = 10) -> DataFrame:
    """Most frequent values first, the smaller value first among equals; all of them when n is None."""
    counts = value_counts(df, column).orderBy(F.desc("failures"), "value")
    return counts if n is None else counts.limit(n)


def page_count(n_rows: int, size: int = PAGE_SIZE) -> int:
    return max(1, -(-n_rows // size))


def pages(df: DataFrame, size: int = PAGE_SIZE) -> DataFrame:
    """One row: the number of pages, one at least, and of rows."""
    counted = df.agg(F.count(F.lit(1)).alias("rows"))
    return counted.select(F.greatest(F.lit(1), F.ceil(F.col("rows") / size)).cast("long").alias("pages"), "rows")


def page(df: DataFrame, order: Sequence[str], number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page `number` (from 1) in the given order. Spark keeps only the rows up to that page, so this suits early pages."""
    return df.orderBy(*order).offset((number - 1) * size).limit(size)


def page_after(df: DataFrame, order: Sequence[str], last: Sequence, size: int = PAGE_SIZE) -> DataFrame:
    """The page after the row whose order columns equal `last`. The cost does not grow with the page number. The order
    columns must identify a row and must not be null."""
    beyond = F.lit(False)
    for column, value in reversed(list(zip(order, last, strict=True))):
        beyond = (F.col(column) > value) | ((F.col(column) == value) & beyond)
    return df.filter((F.col(order[0]) >= last[0]) & beyond).orderBy(*order).limit(size)


#: Rows of a range of a stored order.
RANGE_ROWS = 100_000
RANGE = "_range"
#: Rows of a stored part, which one task sorts and writes and which holds many ranges; about so many, as parts are cut by a sample.
PART_ROWS = 500_000
PART = "_part"
#: Rows of a Parquet page at most: what a filter on the range reads at least.
PARQUET_PAGE_ROWS = 20_000


def store_pages(df: DataFrame, order: Sequence[str], path: str, range_rows: int = RANGE_ROWS) -> None:
    """Keep the rows in an order, to be shown page by page at any number: cut into parts by the order columns, a folder for each
    part, sorted and numbered by ranges of `range_rows` rows, and a table of the parts' numbers of rows. There are as many tasks,
    folders and counts as parts, however short the ranges are. The order columns must identify a row."""
    taken = {c.lower() for c in df.columns}
    if clash := [c for c in (RANGE, PART) if c in taken]:
        raise ValueError(f"rename the column {', '.join(clash)}")
    df = write_rows(df)  # it is counted, sampled and cut
    rows = df.count()
    keys = [F.col(f"`{c}`") for c in order]
    columns = [F.col(f"`{c}`") for c in df.columns]
    length = F.lit(range_rows).alias("range_rows")
    if not rows:  # no part, so no folder that would tell the columns
        df.withColumns({RANGE: F.lit(0), PART: F.lit(0)}).coalesce(1).write.mode("overwrite").parquet(f"{path}/rows")
        df.select(F.lit(0).alias(PART), F.lit(0).cast("long").alias("n"), length).coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")
        return
    cut = df.repartitionByRange(-(-rows // max(range_rows, PART_ROWS)), *keys).withColumn(PART, F.spark_partition_id()).sortWithinPartitions(PART, *keys)
    # the lower 33 bits of an id are the row's place in its partition
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    numbered = cut.select(*columns, PART, F.floor(place / range_rows).cast("int").alias(RANGE))
    writer = numbered.write.mode("overwrite").option("parquet.page.row.count.limit", min(range_rows, PARQUET_PAGE_ROWS))
    writer.partitionBy(PART).parquet(f"{path}/rows")
    counts = df.sparkSession.read.parquet(f"{path}/rows").groupBy(PART).agg(F.count(F.lit(1)).alias("n"))
    counts.select(PART, "n", length).coalesce(1).write.mode("overwrite").parquet(f"{path}/parts")


def stored_page(spark: SparkSession, path: str, order: Sequence[str], number: int, size: int = PAGE_SIZE) -> DataFrame:
    """Page `number` (from 1) of stored rows. Only the ranges that the page lies in, one or two for a page no longer than a range,
    are read and sorted, so a far page costs what the first one costs."""
    counts = sorted((r[PART], r["n"], r["range_rows"]) for r in spark.read.parquet(f"{path}/parts").collect())  # a row for each part
    begin, end, at, wanted, skip = (number - 1) * size, number * size, 0, F.lit(False), None
    for part, n, length in counts:
        if at < end and at + n > begin:
            first, last = max(begin - at, 0) // length, (min(end - at, n) - 1) // length
            skip = begin - at - first * length if skip is None else skip
            wanted = wanted | ((F.col(PART) == part) & F.col(RANGE).isin(list(range(first, last + 1))))
        at += n
    rows = spark.read.parquet(f"{path}/rows").filter(wanted).drop(RANGE, PART)
    return rows.orderBy(*[F.col(f"`{c}`") for c in order]).offset(skip or 0).limit(size)


def executive_view(
    scorecard: DataFrame, summary: DataFrame, by_dimension: DataFrame, by_cde: DataFrame, unique_failed: DataFrame
) -> DataFrame:
    """All parts of the executive view as rows (section, name, rate, records, grade): the overall score, clean records,
    rules by status, dimensions, rules, critical elements, and the recommended action. All tables are a few rows."""

    def part(df: DataFrame, section: str, name: str, rate: str | None, records: str | None, mark: str | None) -> DataFrame:
        pick = lambda c, kind: (F.lit(None) if c is None else F.col(c)).cast(kind)
        return df.select(
            F.lit(section).alias("section"),
            F.col(name).cast("string").alias("name"),
            pick(rate, "double").alias("rate"),
            pick(records, "long").alias("records"),
            pick(mark, "string").alias("grade"),
        )

    clean = unique_failed.select(
        F.lit("Clean records").alias("name"), "clean_pct", (F.col("total_records") - F.col("failed_records")).alias("clean")
    )
    by_status = scorecard.groupBy("Status").agg(F.count(F.lit(1)).alias("n"))
    parts = [
        part(summary, "overall", "Dataset", "Overall_DQ_Score_Pct", "Total_Rule_Failures", "Overall_Grade"),
        part(clean, "clean", "name", "clean_pct", "clean", None),
        part(by_status, "status", "Status", None, "n", None),
        part(by_dimension, "dimension", "DQ_Dimension", "Avg_Pass_Rate", "Total_Failed", "Dimension_Grade"),
        part(scorecard, "rule", "Rule_ID", "Pass_Rate_Pct", "Records_Failed", "Status"),
        part(by_cde, "element", "CDE", "Avg_Pass_Rate", "Total_Failed_Records", "CDE_Grade"),
        part(summary, "action", "Recommended_Action", None, None, None),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def executive(summary: DataFrame, unique_failed: DataFrame) -> DataFrame:
    """The one-row head of the executive view: the summary with the share of records that fail no rule."""
    found = unique_failed.select(F.col("failed_records").alias("Unique_Failed_Records"), F.col("clean_pct").alias("Clean_Records_Pct"))
    return summary.join(F.broadcast(found))  # one row each
