"""Read tables: delimited files with a declared schema, Parquet, earlier outputs, contracts."""

from __future__ import annotations

import json
from collections.abc import Sequence
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from plumbline.functions.nulls import drop_nan
from plumbline.session import write_rows

RECORD_ID = "_record_id"

HOUSING_SCHEMA = T.StructType(
    [
        T.StructField("REF_DATE", T.StringType()),
        T.StructField("GEO", T.StringType()),
        T.StructField("GEO_CODE", T.StringType()),
        T.StructField("DWELLING_TYPE", T.StringType()),
        T.StructField("INTENDED_MARKET", T.StringType()),
        T.StructField("HOUSING_STARTS", T.DoubleType()),
        T.StructField("AVERAGE_PRICE_CAD", T.DoubleType()),
        T.StructField("DATA_SOURCE", T.StringType()),
        T.StructField("REPORTING_AGENCY", T.StringType()),
        T.StructField("LAST_UPDATED", T.StringType()),
        T.StructField("SURVEY_METHOD", T.StringType()),
        T.StructField("GEOGRAPHY_TYPE", T.StringType()),
        T.StructField("UOM", T.StringType()),
        T.StructField("SCALAR_FACTOR", T.StringType()),
        T.StructField("STATUS", T.StringType()),
        T.StructField("DECIMALS", T.IntegerType()),
    ]
)

# The texts that stand for a missing value in a delimited file.
NULL_TEXTS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
    "NULL", "NaN", "None", "n/a", "nan", "null",
)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, null_texts: Sequence[str] = NULL_TEXTS, **options: Any
) -> DataFrame:
    """A delimited file with a header row, or a folder of such files. Columns are matched by header name and may come in
    any order, which must be the same in all files of a folder: a file with another header raises. The table has the
    columns the files have. Quotes within a quoted cell are doubled; pass multiLine=True for cells that hold line ends.
    Cells are read as text, so that every null text counts, and then cast; a cell that cannot be cast raises, as a wrong
    type should."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').options(**options)
    header = reader.csv(path).columns  # reads the first line only
    types = {f.name: f.dataType for f in schema}
    # enforceSchema=False compares the header of every file with the columns
    named = T.StructType([T.StructField(c, T.StringType()) for c in header])
    text = reader.option("enforceSchema", False).schema(named).csv(path)
    cells = {c: F.when(~F.col(f"`{c}`").isin(list(null_texts)), F.col(f"`{c}`")) for c in header}
    return text.select(*[cells[c].cast(types.get(c, T.StringType())).alias(c) for c in header])


CORRUPT = "_corrupt"


def read_csv_lenient(
    spark: SparkSession, path: str, schema: T.StructType, null_texts: Sequence[str] = NULL_TEXTS, **options: Any
) -> tuple[DataFrame, DataFrame]:
    """As `read_csv`, but rows that cannot be read are set aside instead of ending the read. Returns the good rows and the
    rejects: (file, row, reason, columns, line), `row` counting a file's rows of data from 1, `columns` those whose cells
    cannot be cast, `line` the row's text as far as it has been read. A row is rejected if a cell cannot be cast (reason
    `cell`) or if it has too many or too few cells (reason `cells`). The files are read once and written to the shared
    folder, so good rows and rejects are of the same read. Files whose header differs from the first one's raise still."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').options(**options)
    header = reader.csv(path).columns  # reads the first line only
    types = {f.name: f.dataType for f in schema}
    clash = [c for c in (CORRUPT, "_file", "_split", "_place") if c in header]
    if clash:
        raise ValueError(f"rename columns: {', '.join(clash)}")
    named = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
    reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", CORRUPT).option("enforceSchema", False)
    text = reader.schema(named).csv(path)
    cells = {c: F.when(~F.col(f"`{c}`").isin(list(null_texts)), F.col(f"`{c}`")) for c in header}
    cast = {c: cells[c].try_cast(types.get(c, T.StringType())) for c in header}
    bad = F.concat_ws(",", *[F.when(cells[c].isNotNull() & cast[c].isNull(), F.lit(c)) for c in header])
    place = F.monotonically_increasing_id()
    kept = text.select(
        *[cast[c].alias(c) for c in header],
        F.col(CORRUPT),
        bad.alias("_bad"),
        F.when((bad != "") | F.col(CORRUPT).isNotNull(), F.to_json(F.struct(*[F.col(f"`{c}`") for c in header]))).alias("_cells"),
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        place.alias("_place"),
    )
    rows = write_rows(kept)
    rejected = (F.col("_bad") != "") | F.col(CORRUPT).isNotNull()
    good = rows.filter(~rejected).select(*[F.col(f"`{c}`") for c in header])
    # a row's number: the rows of its file's earlier splits, and its place in its own split
    splits = rows.groupBy("_file", "_split").agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
    earlier = F.sum("_rows").over(W.partitionBy("_file").orderBy("_split").rowsBetween(W.unboundedPreceding, -1))
    splits = splits.select("_file", "_split", "_first", F.coalesce(earlier, F.lit(0)).alias("_before"))
    broken = F.col(CORRUPT).isNotNull()
    # a row for each split is broadcast, as by a shuffle the rejects of a split would meet in one task
    rejects = rows.filter(rejected).join(F.broadcast(splits), ["_file", "_split"]).select(
        F.col("_file").alias("file"),
        (F.col("_before") + F.col("_place") - F.col("_first") + 1).alias("row"),
        F.when(broken, F.lit("cells")).otherwise(F.lit("cell")).alias("reason"),
        F.when(~broken, F.split("_bad", ",")).otherwise(F.array().cast("array<string>")).alias("columns"),
        F.coalesce(F.col(CORRUPT), F.col("_cells")).alias("line"),
    )
    return good, rejects


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet") -> DataFrame:
    """A table in any format. Delimited text needs a schema, as nothing is guessed from data; Parquet and ORC carry one."""
    if fmt == "csv":
        if schema is None:
            raise ValueError("a delimited file needs a schema")
        return read_csv(spark, path, schema)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.format(fmt).load(path)


def read_optional(
    spark: SparkSession, path: str, schema: T.StructType | None = None, fmt: str = "parquet"
) -> DataFrame | None:
    """The table, or None where nothing has been written yet."""
    try:
        return read_table(spark, path, schema, fmt)
    except AnalysisException as error:
        # a folder may have been written without any row, and so without any file
        if error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return None
        raise


def without_nan(df: DataFrame) -> DataFrame:
    """NaN turned into NULL in every floating column."""
    return df.select(*[drop_nan(F.col(f"`{f.name}`"), f.dataType).alias(f.name) for f in df.schema])


def require_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Raise with the names of all required columns that are missing. Looks at the schema only."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {', '.join(missing)}")


def column_gate(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """The gate as a table, for showing what is missing instead of raising: one row per required column (Column, Present,
    Filled), `Filled` being the rows in which it is set, NULL for an absent column. One aggregate over the columns there are."""
    have = [c for c in required if c in df.columns]
    counts = df.agg(F.count(F.lit(1)).alias("_rows"), *[F.count(F.col(f"`{c}`")).alias(f"_n{i}") for i, c in enumerate(have)])
    lines = [
        F.struct(
            F.lit(c).alias("Column"),
            F.lit(c in have).alias("Present"),
            (F.col(f"_n{have.index(c)}") if c in have else F.lit(None).cast("long")).alias("Filled"),
        )
        for c in required
    ]
    return counts.select(F.inline(F.array(*lines)))


def empty_template(spark: SparkSession, columns: Sequence[str], schema: T.StructType = HOUSING_SCHEMA) -> DataFrame:
    """An empty table with the given columns, to be filled in and handed back."""
    return spark.createDataFrame([], T.StructType([schema[c] for c in columns]))


def with_record_id(df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add `_record_id`: the key of the table, if it has one (one column as it is, several as text), which costs nothing
    and is the choice for large tables. Without keys, ids 1..n by file path and the row's place in its file. A Parquet
    table tells a row's place, so one count per file is all that is needed beside the rows, which are not shuffled. Of
    other files the place is the file's split and the row's place in it, and the table is written to the shared folder
    once, as a row must not change its place between counting and numbering. A table that comes from no file is numbered
    as it is read."""
    if keys:
        parts = [F.col(f"`{k}`") for k in keys]
        return df.withColumn(RECORD_ID, parts[0] if len(parts) == 1 else F.to_json(F.struct(*parts)))
    columns = [F.col(f"`{c}`") for c in df.columns]
    if _has(df, "_metadata.row_index"):
        file = F.col("_metadata.file_path").alias("_file")
        numbered = df.select(*columns, file, F.col("_metadata.row_index").alias("_within"))
        sizes = df.select(file).groupBy("_file").agg(F.count(F.lit(1)).alias("_rows"))
        keys = ["_file"]
    else:
        place = F.monotonically_increasing_id()
        # The upper bits of an id are the partition, the lower 33 the row within it; a split lies in one partition.
        split = [F.col("_metadata.file_path"), F.col("_metadata.file_block_start")] if _has(df, "_metadata.file_path") else [F.lit(""), F.shiftright(place, 33)]
        placed = write_rows(df.select(*columns, place.alias("_place"), split[0].alias("_file"), split[1].alias("_split")))
        keys = ["_file", "_split"]
        sizes = placed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_rows"), F.min("_place").alias("_first"))
        numbered = placed
    # One row per file or split of the scan.
    before = F.sum("_rows").over(W.orderBy(*keys).rowsBetween(W.unboundedPreceding, -1))
    first = [] if "_first" not in sizes.columns else ["_first"]
    offsets = sizes.select(*keys, *first, F.coalesce(before, F.lit(0)).alias("_before"))
    # as few rows as files or splits are broadcast; by a shuffle all rows of a file would meet in one task
    numbered = numbered.join(F.broadcast(offsets), keys)
    within = F.col("_place") - F.col("_first") if first else F.col("_within")
    return numbered.select(*columns, (F.col("_before") + within + 1).alias(RECORD_ID))


def _has(df: DataFrame, column: str) -> bool:
    try:
        df.select(column)
    except AnalysisException:
        return False
    return True


def read_contract(spark: SparkSession, path: str) -> dict[str, Any]:
    """A contract file, YAML or JSON, as a dict. It is one small document; it is read through Spark so that it may lie
    wherever tables lie."""
    text = spark.read.text(path, wholetext=True).first()["value"]
    if path.endswith(".json"):
        return json.loads(text)
    try:
        import yaml
    except ImportError as error:
        raise RuntimeError("reading YAML contracts needs PyYAML; JSON contracts work without it") from error
    return yaml.safe_load(text)


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    """A governance table (catalog, dictionary, lineage, assignments): delimited, quoted, all text."""
    return spark.read.option("header", True).option("quote", '"').option("escape", '"').csv(path)
