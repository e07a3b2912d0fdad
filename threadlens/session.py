"""Session builder and the one place that decides about checkpoint storage."""

from __future__ import annotations

import gc
import os
import tempfile
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "threadlens", cores: int | None = None, **extra: str) -> SparkSession:
    """Local session for tests and the benchmark; on a cluster, pass the session you were given."""
    cores = cores or os.cpu_count() or 4
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the shared folder named by ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a
    cluster a machine-local folder would lose data with its machine.
    """
    context = spark.sparkContext
    if context.getCheckpointDir():
        return
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        context.setCheckpointDir(configured)
    elif context.master.startswith("local"):
        context.setCheckpointDir(tempfile.mkdtemp(prefix="threadlens-checkpoint-"))
    else:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all machines share")


def materialise(df: DataFrame) -> DataFrame:
    """Write ``df`` to reliable checkpoint storage and continue from the written copy."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet to a fresh folder of the checkpoint storage and continue from the written table.

    Unlike a checkpoint the table has statistics and is read column by column, so it suits tables with a row per message.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Delete the files of ``written`` tables that nothing reads any more, and let Spark drop the exchanges that are not in use.

    Spark deletes an exchange's files after the driver has collected the plan as garbage, which a driver with free memory puts off.
    """
    for table in tables:
        jvm, conf = table.sparkSession._jvm, table.sparkSession._jsc.hadoopConfiguration()
        for folder in {name.rpartition("/")[0] for name in table.inputFiles()}:
            path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
            path.getFileSystem(conf).delete(path, True)
    gc.collect()
    tables[0].sparkSession._jvm.System.gc()
