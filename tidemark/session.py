"""Session construction: what every job needs whatever its size.

Partition counts are left to AQE: it coalesces small shuffles and splits skewed
joins, so one setting serves 60,000 and 60 billion rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

BASE = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.parquet.filterPushdown": "true",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(master: str | None = None, **conf: str) -> SparkSession:
    """``build_session("local[8]", **{"spark.driver.memory": "8g"})``."""
    builder = SparkSession.builder.appName("tidemark").config(map=BASE | conf)
    if master:
        builder = builder.master(master)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """A folder that driver and executors share: ``spark.checkpoint.dir``; only on a single machine one by the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
    return (named or f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}-shared").rstrip("/")


def remove_folder(spark: SparkSession, uri: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(uri)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def settled(frame: DataFrame) -> DataFrame:
    """``frame`` computed once into the shared folder, so that what was decided by it holds even if executors are lost later."""
    context = frame.sparkSession.sparkContext
    if not context.getCheckpointDir():
        context.setCheckpointDir(shared_folder(frame.sparkSession))
    return frame.checkpoint(eager=True)


def written_batches(spark: SparkSession, folder: str) -> dict[int, str]:
    """Batch number to folder, as the shared folder has them: what earlier runs wrote counts too."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in fs.listStatus(path)] if fs.exists(path) else []
    return {int(n): f"{folder}/{n}" for n in sorted(names, key=lambda n: n.zfill(20)) if n.isdigit()}
