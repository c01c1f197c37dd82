"""Staged tables: intermediate results written to the cluster's shared checkpoint folder.

A staged table cuts lineage, survives lost executors and is computed once however often it is
read. The folder is the session's `spark.checkpoint.dir`; where that is unset, it lies in the
warehouse, if that is shared. clear_stages() removes what a session has staged.
"""

import uuid

from pyspark.sql import SparkSession

_staged = {}


def stage_root(spark):
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    local = root.startswith("/") or root.startswith("file:")
    if local and not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return root + "/stages"


def clear_stages(spark):
    """Remove the stages this process has written in the session; results read from them are gone."""
    context = spark.sparkContext
    for path in _staged.pop(context.applicationId, []):
        target = context._jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(context._jsc.hadoopConfiguration()).delete(target, True)


def scratch(spark, name):
    """A new path below the shared folder, removed by clear_stages()."""
    path = f"{stage_root(spark)}/shelfcast-{name}-{uuid.uuid4().hex}"
    _staged.setdefault(spark.sparkContext.applicationId, []).append(path)
    return path


def stage(df, name="stage"):
    """Write `df` once and return a DataFrame that reads the written files."""
    spark = SparkSession.active()
    path = scratch(spark, name)
    df.write.mode("errorifexists").parquet(path)
    return spark.read.schema(df.schema).parquet(path)
