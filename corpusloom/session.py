"""Session settings the operators rely on, and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the runtime options every job here expects."""
    # JSON-LD in the wild repeats keys; the last one counts.
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    # Batches sent to Python are cut by bytes, so long texts and pages do not multiply by the rows of a batch.
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach, as named in ``spark.checkpoint.dir``."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder and spark.sparkContext.master.startswith("local"):
        folder = tempfile.mkdtemp(prefix="corpusloom-")  # one machine: driver and executors share it
        spark.conf.set("spark.checkpoint.dir", folder)
    if not folder:
        raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
    return folder.rstrip("/")


def new_work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/corpusloom/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str, path: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder, in folders ``by`` columns if given, and read it back.

    Several consumers then share one computation, each reads only its columns,
    and a lost executor costs a re-read, not a re-parse.
    """
    spark = df.sparkSession
    path = path or new_work_path(spark, name)
    df.write.mode("errorifexists").partitionBy(*by).parquet(path)
    _STAGED.append(path)
    return spark.read.schema(df.schema).parquet(path).select(*df.columns)


_STAGED: list[str] = []


def clear_staged(spark: SparkSession) -> int:
    """Remove the tables that this process has staged, once nothing reads them any more; tells how many there were."""
    conf, removed = spark.sparkContext._jsc.hadoopConfiguration(), 0
    while _STAGED:
        path = spark._jvm.org.apache.hadoop.fs.Path(_STAGED.pop())
        removed += path.getFileSystem(conf).delete(path, True)
    return removed
