"""Adapters: the star-schema test tables as model tables.

sales <- lineitem (part for list prices), relation, attributes and targets <- part,
behaviour <- events, calendars <- orders. Every adapter reads its whole table.
"""

from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfcast.functions.dates import parse, to_int
from shelfcast.sources.schemas import CATEGORY_COLUMNS
from shelfcast.sources.tables import ModelTables

# Variants per goods, and the days that move the events into the sales calendar.
SKUS_PER_GOODS = 4
EVENT_SHIFT = 8706
# The category columns are codes derived from the part size; 0 stands for the size itself.
CATEGORY_MODULI = (0, 25, 12, 8, 5, 3, 2)
EVENT_COLUMNS = {
    "goods_click": "click",
    "cart_click": "view",
    "favorites_click": "signup",
    "sales_uv": "purchase",
}


def _read(spark, folder, name):
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _goods(key):
    return F.floor(F.col(key) / SKUS_PER_GOODS).cast("bigint")


def goodsale(spark, folder, list_price=False, lo=None, hi=None):
    """Sales rows; list_price adds orginal_shop_price, which needs a join with part.

    A range lo..hi of dates is applied to the stored ship date, so it reaches the scan.
    """
    lines = _read(spark, folder, "lineitem")
    kind = lines.schema["l_shipdate"].dataType
    if lo is not None:
        lines = lines.filter(F.col("l_shipdate") >= F.lit(parse(lo)).cast(kind))
    if hi is not None:
        lines = lines.filter(F.col("l_shipdate") <= F.lit(parse(hi)).cast(kind))
    # The generator keeps date filters above it: pushed below, each comparison of a filter would
    # repeat the conversion. Tables that store data_date do not need this.
    lines = lines.withColumn(
        "data_date", F.explode(F.array(to_int("l_shipdate")))
    )
    sales = lines.select(
        "data_date",
        _goods("l_partkey").alias("goods_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_quantity").alias("goods_num"),
        (F.col("l_extendedprice") / F.col("l_quantity")).alias("goods_price"),
    )
    if not list_price:
        return sales
    parts = _read(spark, folder, "part").select(
        F.col("p_partkey").alias("sku_id"), F.col("p_retailprice").alias("orginal_shop_price")
    )
    return sales.join(parts, "sku_id", "left").select(*sales.columns, "orginal_shop_price")


def relation(spark, folder):
    return _read(spark, folder, "part").select(
        _goods("p_partkey").alias("goods_id"), F.col("p_partkey").alias("sku_id")
    )


def goodsinfo(spark, folder):
    """Attributes of a goods are those of its first part."""
    first = F.min(F.struct("p_partkey", "p_brand", "p_size"))
    parts = (
        _read(spark, folder, "part")
        .groupBy(_goods("p_partkey").alias("goods_id"))
        .agg(first.alias("first"))
    )
    size = F.col("first.p_size")
    codes = {
        name: (size % m if m else size).cast("bigint")
        for name, m in zip(CATEGORY_COLUMNS, CATEGORY_MODULI)
    }
    brand = F.substring(F.col("first.p_brand"), 7, 10).cast("bigint")
    return parts.select(
        "goods_id", brand.alias("brand_id"), *[c.alias(name) for name, c in codes.items()]
    )


def goodsdaily(spark, folder):
    """Behaviour counts per goods and day."""
    events = _read(spark, folder, "events")
    day = F.date_sub(F.col("ts").cast("date"), EVENT_SHIFT)
    daily = events.groupBy(F.col("user_id").alias("goods_id"), day.alias("day")).agg(
        *[
            F.count_if(F.col("event_type") == kind).cast("double").alias(name)
            for name, kind in EVENT_COLUMNS.items()
        ]
    )
    # One row per goods and day: the window holds at most one row per calendar day.
    started = F.min("day").over(Window.partitionBy("goods_id"))
    return daily.select(
        to_int("day").alias("data_date"),
        "goods_id",
        *EVENT_COLUMNS,
        (F.datediff("day", started) + 1).cast("double").alias("onsale_days"),
    )


def submit_example(spark, folder):
    return _read(spark, folder, "part").select(F.col("p_partkey").alias("sku_id"))


def marketing(spark, folder):
    """Activity type and rhythm per order date."""
    return (
        _read(spark, folder, "orders")
        .groupBy(to_int("o_orderdate").alias("data_date"))
        .agg(
            F.substring(F.min("o_orderpriority"), 1, 1).cast("int").alias("marketing"),
            F.min(F.month("o_orderdate")).alias("plan"),
        )
    )


def holiday(spark, folder):
    """Holidays on the first days of the months seen in orders; the 29th of May is listed twice."""
    dates = (
        _read(spark, folder, "orders").select(F.col("o_orderdate").cast("date").alias("d")).distinct()
    )
    month, day = F.month("d"), F.dayofmonth("d")
    twice = (month == 5) & (day == 29)
    codes = F.when(twice, F.array(F.lit(9), F.lit(10))).when(day <= 2, F.array(month))
    return dates.select(
        to_int("d").alias("data_date"), F.explode(codes).alias("holiday_code")
    )


def weather(spark, folder):
    """One row of weather-like measures per order date."""
    price = F.col("o_totalprice")
    return (
        _read(spark, folder, "orders")
        .groupBy(to_int("o_orderdate").alias("data_date"))
        .agg(
            F.avg(price / 10000).alias("temp_mean"),
            F.max(price / 10000).alias("temp_max"),
            F.min(price / 10000).alias("temp_min"),
            F.avg(F.col("o_custkey") % 12).alias("uv_index_mean"),
            F.max(F.col("o_custkey") % 12).cast("int").alias("uv_index_max"),
        )
    )


def model_tables(spark, folder, list_price=False, lo=None, hi=None):
    return ModelTables(
        goodsale=goodsale(spark, folder, list_price, lo, hi),
        goods_sku_relation=relation(spark, folder),
        submit_example=submit_example(spark, folder),
        goodsdaily=goodsdaily(spark, folder),
        goodsinfo=goodsinfo(spark, folder),
        marketing=marketing(spark, folder),
        holiday=holiday(spark, folder),
        weather=weather(spark, folder),
    )
