"""Session settings for local runs; on a cluster the given session is used as it is."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"
BATCH_CONF = "spark.sql.execution.arrow.maxBytesPerBatch"
# Folders of local sessions that name none, by application.
_LOCAL_FOLDERS: dict[str, str] = {}


def local_session(cores: int | str = 8, memory: str = "8g", **confs: str) -> SparkSession:
    """A ``local[cores]`` session with adaptive execution and UTC time."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("martloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        # call sites of column expressions are for debugging and cost a round trip each
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in confs.items():
        builder = builder.config(key.replace("__", "."), value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder for written intermediate tables and checkpoints.

    A cluster names a folder every executor sees in ``spark.checkpoint.dir``. A
    machine-local folder is used only where the master is local and none is named.
    """
    named = spark.conf.get(CHECKPOINT_CONF, None)
    if named:
        return named
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise ValueError(f"{CHECKPOINT_CONF} must name a shared folder on a cluster")
    # the setting cannot be changed in a running session, so the folder is remembered here
    app = context.applicationId
    if app not in _LOCAL_FOLDERS:
        _LOCAL_FOLDERS[app] = tempfile.mkdtemp(prefix="martloom-", dir=os.environ.get("TMPDIR", "/tmp"))
    return _LOCAL_FOLDERS[app]


def new_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the shared folder, under the application's own name for clean-up."""
    app = spark.sparkContext.applicationId
    return f"{shared_folder(spark).rstrip('/')}/{app}/{name}-{uuid.uuid4().hex}.parquet"


def stage(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame that several branches read to the shared folder and read it back.

    Cuts the lineage, so that the branches neither repeat the work nor lose it with an
    executor, and gives the planner real sizes.
    """
    spark = frame.sparkSession
    path = new_path(spark, name)
    frame.write.parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def discard(frame: DataFrame) -> None:
    """Delete the staged tables that a frame reads, once nothing else reads them; other files stay."""
    spark = frame.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    ours = f"/{spark.sparkContext.applicationId}/"
    for folder in {name.rpartition("/")[0] for name in frame.inputFiles()}:
        if ours in folder:
            path = jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(conf).delete(path, True)


@contextmanager
def arrow_batches(spark: SparkSession, most: int) -> Iterator[None]:
    """Rows that are run within go to Python in batches of about ``most`` bytes; the setting is put back."""
    before = spark.conf.get(BATCH_CONF, None)
    spark.conf.set(BATCH_CONF, most)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(BATCH_CONF)
        else:
            spark.conf.set(BATCH_CONF, before)


def clean_up(spark: SparkSession) -> None:
    """Delete what this application has staged in the shared folder, and nothing else there.

    For the end of a job: frames read back from staged tables are no longer readable.
    """
    context = spark.sparkContext
    folder = context._jvm.org.apache.hadoop.fs.Path(f"{shared_folder(spark).rstrip('/')}/{context.applicationId}")
    folder.getFileSystem(context._jsc.hadoopConfiguration()).delete(folder, True)
