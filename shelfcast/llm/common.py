"""Helpers the operators share: reading tables, Arrow batches of bounded size, kept tables."""

import tempfile
import uuid
import zipfile
from pathlib import Path

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql.pandas.types import to_arrow_type

# Text bytes of one slice of an Arrow batch; a longer text forms a slice of its own.
SLICE_BYTES = 8 << 20


def table(spark, sf_dir, name, *columns):
    """The named columns of a Parquet table of the data folder."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet").select(*columns)


def documents(spark, sf_dir, *columns):
    return table(spark, sf_dir, "documents", *(columns or ("doc_id", "text")))


_shipped = set()


def ship(spark):
    """Send this package to the Python workers of the session, once, so they can import it."""
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = Path(tempfile.mkdtemp(prefix="ship-")) / f"{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for file in sorted(package.rglob("*.py")):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)


def slices(batches, column="text", limit=SLICE_BYTES):
    """Cut record batches so that the texts of one slice hold about `limit` bytes."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        start = total = 0
        for row, size in enumerate(sizes):
            if total and total + size > limit:
                yield batch.slice(start, row - start)
                start, total = row, 0
            total += size
        yield batch.slice(start)


def texts(batch, column="text"):
    """The texts of a batch as Python strings; a missing text is empty."""
    return [t or "" for t in batch.column(column).to_pylist()]


def arrow_type(df, column):
    return to_arrow_type(df.schema[column].dataType)


def record_batch(schema, **columns):
    """A record batch with the columns in the order of an Arrow schema."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], type=f.type) for f in schema], schema=schema
    )


def keep(df, name, compression="snappy"):
    """Write `df` to the shared checkpoint folder once and read it back.

    The folder is `spark.checkpoint.dir`. Where it is unset the folder `checkpoints` of the warehouse
    is used, as long as it is shared: a local one serves a local session only.
    """
    spark = df.sparkSession
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        root = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/checkpoints"
        local = root.startswith("/") or root.startswith("file:")
        if local and not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    path = f"{root.rstrip('/')}/llm-{name}-{uuid.uuid4().hex}"
    df.write.parquet(path, compression=compression)
    kept = spark.read.schema(df.schema).parquet(path)
    kept.kept_path = path
    return kept


def discard(*kept):
    """Remove tables of keep() that no later step reads."""
    for df in kept:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.kept_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)
