"""Session settings and the shared folder for checkpoints and tables."""

from __future__ import annotations

import tempfile
from functools import cache

from pyspark.sql import SparkSession


def local_session(cpus: int | str = "*", shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """Session for tests and the benchmark; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("quaystar")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "12g")
    )
    for name, value in settings.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors see: spark.checkpoint.dir. Only a local session may go without that setting."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
        folder = _local_folder(context.applicationId)
    if not context.getCheckpointDir():
        context.setCheckpointDir(folder)
    return folder


@cache
def _local_folder(application: str) -> str:
    return tempfile.mkdtemp(prefix=f"quaystar-{application}-")


def table_files(spark: SparkSession, folder: str, tables: tuple[str, ...]) -> str:
    """Path, size and time of the files behind the tables: a text that changes when they do."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    configuration = spark.sparkContext._jsc.hadoopConfiguration()
    found = []
    for table in tables:
        path = hadoop.Path(f"{folder.rstrip('/')}/{table}.parquet")
        status = path.getFileSystem(configuration).getFileStatus(path)
        found.append(f"{status.getPath()} {status.getLen()} {status.getModificationTime()}")
    return "\n".join(found)
