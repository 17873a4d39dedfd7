"""Session set-up and the shared folder for data that must outlive a task."""

import atexit
import functools
import os
import tempfile

from pyspark.sql import SparkSession


def build_session(app_name="mendlake", master=None, **conf):
    """A session in UTC with adaptive execution; ``conf`` keys use ``__`` for dots."""
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
    )
    if master:
        builder = builder.master(master)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), str(value))
    return builder.getOrCreate()


def shared_dir(spark, name):
    """A new folder under ``spark.checkpoint.dir`` that every executor can reach.

    Only a local session may go without that setting: it gets a temporary
    folder, since driver and executors then share one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return f"{root.rstrip('/')}/{name}-{os.urandom(8).hex()}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    return tempfile.mkdtemp(prefix=f"{name}-", dir=_local_root())


def settle(df, name):
    """``df`` written as a table in the shared folder and read back: it is computed once, whoever reads it and however often."""
    path = shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@functools.cache
def _local_root():
    """The folder of this process for local sessions; it goes when the process ends."""
    folder = tempfile.TemporaryDirectory(prefix="mendlake-", ignore_cleanup_errors=True)
    atexit.register(folder.cleanup)
    return folder.name
