"""A Spark session with the settings the library is tuned for."""

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Many-to-one lookups on a hot goods_id are split at run time, also below an aggregate.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # HotSpot never compiles a longer method, so wide rows would be computed by its interpreter.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def get_session(app_name="shelfcast", master=None, partitions=None, **extra):
    """Build (or reuse) a session; `extra` keys use `__` for the dots of a setting name.

    `partitions` is the number of shuffle partitions before adaptive execution merges small ones,
    which it never splits: take the largest shuffle's size divided by about 200 MB.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    if partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(partitions))
        key = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
        builder = builder.config(key, str(partitions))
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def compiled_only(spark):
    """Let a session of another origin run no generated method that the JVM leaves to its interpreter.

    Steps whose generated method would be longer run operator by operator, in small methods. Results
    are the same.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    spark.conf.set(name, SETTINGS[name])


_shipped = set()


def ship_package(spark):
    """Send this package to the Python workers of the session, once, so that tasks can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="package-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
