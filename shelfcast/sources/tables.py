"""Reading and writing the model tables."""

from dataclasses import dataclass, replace
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.functions.prices import parse_price, parse_price_const
from shelfcast.sources.schemas import SCHEMAS


@dataclass(frozen=True)
class ModelTables:
    """The input tables of a forecast; calendars are optional."""

    goodsale: DataFrame
    goods_sku_relation: DataFrame
    submit_example: DataFrame
    goodsdaily: DataFrame | None = None
    goodsinfo: DataFrame | None = None
    marketing: DataFrame | None = None
    holiday: DataFrame | None = None
    weather: DataFrame | None = None


# Tables that write_fact() stores in monthly folders.
FACTS = ("goodsale", "goodsdaily")


def read_table(spark, name, path, fmt="csv"):
    """Scan one table; columns are picked by name and typed, whatever else the file holds.

    fmt="months" reads Parquet with monthly folders for the fact tables, whose `month` column stays
    until prune_months().
    """
    months = fmt == "months"
    reader = spark.read.format("parquet" if months else fmt)
    if fmt == "csv":
        reader = reader.option("header", True)
    raw = reader.load(path)
    kept = ["month"] if months and name in FACTS else []
    return raw.select(*[_typed(f).alias(f.name) for f in SCHEMAS[name].fields], *kept)


def _typed(field):
    c = F.col(field.name)
    if field.dataType.typeName() in ("integer", "long"):
        # Whole numbers may be written with a decimal point where a column has gaps.
        text = c.cast("string")
        return F.coalesce(
            text.try_cast(field.dataType), text.try_cast("double").try_cast(field.dataType)
        )
    return c.try_cast(field.dataType)


def append_editions(*editions):
    """Stack several editions of one table, by column name."""
    return reduce(DataFrame.unionByName, editions)


def parse_sale_prices(goodsale, mode="strip"):
    """Turn both price columns into DOUBLE; mode="const" is the constant-value variant."""
    parse = parse_price_const if mode == "const" else parse_price
    return goodsale.withColumns(
        {c: parse(c) for c in ("goods_price", "orginal_shop_price") if c in goodsale.columns}
    )


def target_skus(submit_example):
    """The variants to forecast; the example's week columns are dropped."""
    return submit_example.select("sku_id")


# File names of the input tables below the data folder.
FILES = {
    "goodsale": "goodsale",
    "goodsdaily": "goodsdaily",
    "goodsinfo": "goodsinfo",
    "goods_sku_relation": "goods_sku_relation",
    "marketing": "marketing",
    "submit_example": "submit_example_2",
    "holiday": "holiday",
    "weather": "weather_ariba",
}


def read_model_tables(spark, folder, fmt="csv", editions=(), price_mode="strip", names=None):
    """All tables of a folder; `editions` are more folders whose sales are appended."""
    suffix = ".csv" if fmt == "csv" else ""
    names = names or tuple(FILES)
    found = {n: read_table(spark, n, f"{folder}/{FILES[n]}{suffix}", fmt) for n in names}
    more = [read_table(spark, "goodsale", f"{e}/goodsale{suffix}", fmt) for e in editions]
    sales = append_editions(found["goodsale"], *more)
    found["goodsale"] = parse_sale_prices(sales, price_mode)
    return ModelTables(**found)


def write_result(df, path, fmt="parquet", mode="overwrite", order=()):
    """Write a forecast or feature table; text files get a header.

    Rows are not sorted, unless `order` names keys: then see write_ordered() (text files only).
    """
    writer = df.write.mode(mode)
    if order:
        write_ordered(df, path, order)
    elif fmt == "csv":
        writer.option("header", True).csv(path)
    else:
        writer.format(fmt).save(path)


def write_ordered(df, path, keys, partitions=None):
    """Write CSV whose files, read in the order of their names, are the rows sorted by `keys`.

    Rows are cut into ranges of the keys and sorted inside each; the first file holds the header
    alone, so the files can simply be joined. `partitions` is the number of ranges.
    """
    ranged = df.repartitionByRange(*([partitions] if partitions else []), *keys)
    lines = ranged.sortWithinPartitions(*keys).select(F.to_csv(F.struct(*df.columns)).alias("value"))
    header = df.sparkSession.range(0, 1, 1, 1).select(F.lit(",".join(df.columns)).alias("value"))
    header.union(lines).write.mode("overwrite").text(path)


def read_ordered(spark, path, name):
    """Read a table of write_ordered(): typed by the schema of `name`, the header left out.

    The columns are those of the header, in any order; what the schema does not name is dropped.
    """
    lines = spark.read.text(path)
    names = [f.name for f in SCHEMAS[name].fields]
    # Only the header names a column; no line of values equals it.
    header = lines.where(F.col("value").contains(names[0]) & F.col("value").contains(names[-1])).first()
    found = header["value"].split(",")
    kind = T.StructType([T.StructField(c, T.StringType()) for c in found])
    rows = lines.where(F.col("value") != header["value"]).select(
        F.from_csv("value", kind.simpleString()[len("struct<") : -1].replace(":", " ")).alias("row")
    )
    return rows.select("row.*").select(*[_typed(f).alias(f.name) for f in SCHEMAS[name].fields])


def prune_months(tables, ranges):
    """The model tables with facts cut to the months of the date ranges, without `month`.

    The predicate is on the partition column, so other months' folders are not listed or read.
    """
    cut = {}
    for name in FACTS:
        facts = getattr(tables, name)
        if facts is not None and "month" in facts.columns:
            months = " OR ".join(f"month BETWEEN {lo // 100} AND {hi // 100}" for lo, hi in ranges)
            cut[name] = facts.filter(months).drop("month")
    return replace(tables, **cut)


def write_fact(df, path, mode="overwrite"):
    """Store a fact table as Parquet in monthly folders, so date ranges prune files.

    Each task sorts its rows by month and writes one file per month it holds; repartition `df` first
    where its tasks are many and small.
    """
    (
        df.withColumn("month", (F.col("data_date") / 100).cast("int"))
        .sortWithinPartitions("month")
        .write.mode(mode)
        .partitionBy("month")
        .parquet(path)
    )


def read_fact(spark, path, lo=None, hi=None):
    """Read a table of write_fact; the range prunes month folders and pushes to the scan."""
    df = spark.read.parquet(path)
    if lo is not None:
        df = df.filter((F.col("month") >= lo // 100) & (F.col("data_date") >= lo))
    if hi is not None:
        df = df.filter((F.col("month") <= hi // 100) & (F.col("data_date") <= hi))
    return df.drop("month")
