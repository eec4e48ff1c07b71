"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


# Runtime settings for large packs. Rules over one row are compiled into one method; beyond 8,000 bytes of bytecode the
# JVM would interpret it, so Spark is told to compile expression by expression from there on.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session that someone else made."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", shuffle_partitions: int = 8) -> SparkSession:
    """A session for tests and the benchmark. On a cluster, use the session the cluster gives."""
    return configure(
        SparkSession.builder.master(f"local[{cores}]")
        .appName("plumbline")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints, as the session names it. One is made only where driver and executors are one
    process (`local[...]`) and the session names none."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured is None:
            if sc.master != "local" and not sc.master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
            configured = tempfile.mkdtemp(prefix="run-")
        sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def is_there(spark: SparkSession, path: str) -> bool:
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(sc._jsc.hadoopConfiguration()).exists(place)


def file_states(spark: SparkSession, path: str) -> tuple:
    """Names, sizes and times of the files of a table, by which a changed table is told from the same one."""
    sc = spark.sparkContext
    place = sc._jvm.org.apache.hadoop.fs.Path(path)
    found = place.getFileSystem(sc._jsc.hadoopConfiguration()).listStatus(place)
    return tuple(sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in found))


def release(spark: SparkSession) -> None:
    """Delete what this application wrote between steps: rows, checkpoints, streams. Results read from there must have been
    used or written elsewhere before."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        place = sc._jvm.org.apache.hadoop.fs.Path(sc.getCheckpointDir())  # a folder of this application alone
        files = place.getFileSystem(sc._jsc.hadoopConfiguration())
        for entry in files.listStatus(place) if files.exists(place) else []:
            files.delete(entry.getPath(), True)


def materialize(df: DataFrame) -> DataFrame:
    """Checkpoint a table of facts, so that it is neither computed twice nor lost."""
    shared_dir(df.sparkSession)
    return df.checkpoint()


def write_rows(df: DataFrame) -> DataFrame:
    """The same for a table of rows: written to the shared folder as Parquet and read back from there, so that later
    steps read only the columns they need."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/rows-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
