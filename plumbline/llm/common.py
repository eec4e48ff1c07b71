"""What the operators of this subpackage share: tables settled in the shared folder, and order without one large task."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from plumbline.session import configure, shared_dir

CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"

#: Characters that separate words, as a Java and RE2 character class.
SPACE = r"\x20\x09-\x0D"
WORD = f"[^{SPACE}]+"

#: Hexadecimal digits that name a slice of a hash order.
SLICE = 3


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SHIPPED: set[str] = set()


def _ship(spark: SparkSession) -> None:
    """Sends this package to the executors, which may not have it installed."""
    sc = spark.sparkContext
    if sc.applicationId in _SHIPPED:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp()) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    sc.addPyFile(str(archive))
    _SHIPPED.add(sc.applicationId)


def prepared(spark: SparkSession) -> SparkSession:
    """A session with this package on its executors, and settings for rows that hold whole texts: few at a time go to Python."""
    configure(spark)
    _ship(spark)
    spark.conf.set(BATCH, "1000")
    return spark


@contextlib.contextmanager
def _shuffles_removed(spark: SparkSession):
    """Within, the shuffle files of an action go when it ends, not when the driver happens to collect its garbage."""
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before)


@contextlib.contextmanager
def few_rows(spark: SparkSession, rows: int):
    """Within, an action passes so many rows of a table to Python at a time: for rows of a megabyte and more."""
    before = spark.conf.get(BATCH)
    spark.conf.set(BATCH, str(rows))
    try:
        yield
    finally:
        spark.conf.set(BATCH, before)


#: Tables without texts are written by so many times fewer tasks than there are shuffle partitions.
LIGHTER = 16


def settle(df: DataFrame, light: bool = False) -> DataFrame:
    """The table written to the shared folder and read back from there: its lineage is cut, a lost executor loses none of
    it, and later steps read only the columns they need. `light`: what comes out of a shuffle is ids and numbers, which
    go into fewer files."""
    spark = df.sparkSession
    if light:
        df = df.coalesce(max(1, int(spark.conf.get("spark.sql.shuffle.partitions")) // LIGHTER))
    path = f"{shared_dir(spark)}/rows-{uuid.uuid4().hex}"
    kept = df.withColumns({f.name: F.col(f"`{f.name}`").cast("string") for f in df.schema if f.dataType == T.NullType()})
    with _shuffles_removed(spark):
        kept.write.parquet(path)
    written = spark.read.schema(kept.schema).parquet(path)
    written.settled_at = path
    return written


def forget(settled: DataFrame) -> None:
    """Deletes the files of a settled table that nothing will read again."""
    sc = settled.sparkSession.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(settled.settled_at)
    place.getFileSystem(sc._jsc.hadoopConfiguration()).delete(place, True)


def digest64(*columns: Column | str) -> Column:
    return F.xxhash64(*columns)


def free_name(df: DataFrame, name: str) -> str:
    """The name, lengthened until no column of the table has it (names differ by more than case)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def running_total(df: DataFrame, groups: list[str], order: list[Column], fine: Column, value: Column, name: str) -> DataFrame:
    """Adds the sum of `value` over the rows of the same groups that come before a row, in the order of `fine` (a string of
    hexadecimal digits spread evenly, such as md5) and then `order`.

    The first three digits cut a group into 4,096 slices. Their sums are added up by a window over at most that many rows;
    within a slice a second window has 1/4,096 of the group's rows. No task holds a whole group.
    """
    cut, at, before = (free_name(df, f"{name}_{x}") for x in ("slice", "at", "ahead"))
    rows = df.withColumns({at: fine, cut: F.substring(fine, 1, SLICE)})
    keys = [F.col(g) for g in groups]
    sums = rows.groupBy(*keys, cut).agg(F.sum(value).alias(before))
    ahead = Window.partitionBy(*groups).orderBy(cut).rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(*keys, cut, F.coalesce(F.sum(before).over(ahead), F.lit(0)).cast("long").alias(before))
    inner = Window.partitionBy(*groups, cut).orderBy(at, *order).rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(name, F.coalesce(F.sum(value).over(inner), F.lit(0)).cast("long"))
    right = sums.select(*[F.col(g).alias(f"{g}__r") for g in groups], F.col(cut).alias(f"{cut}__r"), before)
    same = [F.col(g).eqNullSafe(F.col(f"{g}__r")) for g in groups] + [F.col(cut) == F.col(f"{cut}__r")]
    joined = rows.join(right, on=same, how="left")
    return joined.withColumn(name, F.col(name) + F.col(before)).drop(at, cut, before, f"{cut}__r", *[f"{g}__r" for g in groups])
