"""Statistics of the day-grain model: behaviour per goods, sales at three keys, categories."""

from pyspark.sql import functions as F

from shelfcast.functions.dates import weekday
from shelfcast.functions.numeric import sql_ratio
from shelfcast.operators.ordered import exact_medians, many_values, middle_values, running_counts
from shelfcast.sources.schemas import BEHAVIOUR_MEASURES, CATEGORY_COLUMNS
from shelfcast.sources.staging import stage

GOODS = ("goods_id",)
SKU = ("sku_id",)
GOODS_SKU = ("goods_id", "sku_id")
THREE_KEYS = (GOODS, SKU, GOODS_SKU)


def goods_behaviour_stats(tagged):
    """f1-f4 sums and f6-f9 means of the behaviour measures, f5 mean days on sale."""
    sums = [F.sum(c).cast("double").alias(f"f{i}") for i, c in enumerate(BEHAVIOUR_MEASURES, 1)]
    means = [F.avg(c).alias(f"f{i}") for i, c in enumerate(("onsale_days", *BEHAVIOUR_MEASURES), 5)]
    return tagged.groupBy("window_id", "goods_id").agg(*sums, *means)


def goods_behaviour_moments(tagged):
    """f10-f13: std, and with suffix _1 median, _2 max, _3 min, _4 skewness, _5 kurtosis."""
    exprs = []
    for i, c in enumerate(BEHAVIOUR_MEASURES, 10):
        exprs += [
            F.stddev_samp(c).alias(f"f{i}"),
            F.max(c).cast("double").alias(f"f{i}_2"),
            F.min(c).cast("double").alias(f"f{i}_3"),
            F.skewness(c).alias(f"f{i}_4"),
            F.kurtosis(c).alias(f"f{i}_5"),
        ]
    keys = ["window_id", "goods_id"]
    stats = tagged.groupBy(*keys).agg(*exprs)
    medians = _behaviour_medians(tagged, keys)
    names = [f"f{i}{s}" for s in ("", "_1", "_2", "_3", "_4", "_5") for i in range(10, 14)]
    return stats.join(medians, keys, "left").select(*keys, *names)


def _behaviour_medians(tagged, keys):
    """All four medians in one ordered step: the measure number is part of the group."""
    entries = [
        F.struct(F.lit(i).alias("measure"), F.col(c).cast("double").alias("value"))
        for i, c in enumerate(BEHAVIOUR_MEASURES, 10)
    ]
    counts = (
        tagged.select(*keys, F.inline(F.array(*entries)))
        .filter("value is not null")
        .groupBy(*keys, "measure", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    medians = exact_medians(
        counts, [*keys, "measure"], ["n"], many_values(tagged, *BEHAVIOUR_MEASURES)
    )
    return medians.groupBy(*keys).agg(
        *[F.max(F.when(F.col("measure") == i, F.col("n"))).alias(f"f{i}_1") for i in range(10, 14)]
    )


def weekday_sums(tagged):
    """f14-f41: behaviour sums per weekday, Monday first, NULL for weekdays without rows."""
    day = weekday("data_date")
    exprs = [
        F.sum(F.when(day == d, F.col(c))).cast("double").alias(f"f{14 + 4 * d + i}")
        for d in range(7)
        for i, c in enumerate(BEHAVIOUR_MEASURES)
    ]
    return tagged.groupBy("window_id", "goods_id").agg(*exprs)


def last_week_behaviour(recent):
    """Behaviour of the last calendar week: fw1-4 sums, fw6-9 means, fw10-13 std."""
    exprs = [
        maker(c).cast("double").alias(f"fw{i}_1")
        for first, maker in ((1, F.sum), (6, F.avg), (10, F.stddev_samp))
        for i, c in enumerate(BEHAVIOUR_MEASURES, first)
    ]
    return recent.groupBy("window_id", "goods_id").agg(*exprs)


# Order in which the statistics are numbered, each at (goods), (sku), (goods, sku).
FULL_ORDER = ("sum", "mean", "skew", "kurt", "std", "max", "min", "median")


def value_counts(tagged):
    """How often each quantity occurs per (window_id, goods_id, sku_id), staged.

    One scan of the sales; all statistics of quantity_by_key and the pairs themselves come from this
    table. A pair without any quantity has a row with a missing value.
    """
    counted = tagged.groupBy(
        "window_id", "goods_id", "sku_id", F.col("goods_num").cast("double").alias("value")
    ).agg(F.count(F.lit(1)).alias("n"))
    return stage(counted, "counts")


def pairs_of(counted):
    """The distinct (window_id, goods_id, sku_id) of value_counts()."""
    return counted.select("window_id", "goods_id", "sku_id").distinct()


def _quantities(counted, key, sliced):
    """Statistics of the quantities of each (window_id, *key), from value_counts().

    A row knows its place and its group's totals after one ordered step, so the median and the
    moments around the group's own mean come from the same rows.
    """
    keys = ["window_id", *key]
    counts = counted.dropna(subset=["value", *key])
    if key != GOODS_SKU:
        counts = counts.groupBy(*keys, "value").agg(F.sum("n").alias("n"))
    counts = counts.withColumn("units", F.col("n") * F.col("value"))
    ranked = running_counts(counts, keys, ["value"], ["n", "units"], sliced)
    away = "(value - units_total / n_total)"
    placed = ranked.selectExpr(
        *keys, "value", "n", "n_total", "units_total", f"{away} AS away", *middle_values("n")
    )
    powers = [f"sum(n * pow(away, {k})) AS p{k}" for k in (2, 3, 4)]
    uneven = "max > min"
    return (
        placed.groupBy(*keys)
        .agg(
            F.expr("max(n_total) AS count"),
            F.expr("max(units_total) AS sum"),
            F.max("value").alias("max"),
            F.min("value").alias("min"),
            *[F.expr(p) for p in powers],
            F.expr("(max(n_low) + max(n_high)) / 2 AS median"),
        )
        .selectExpr(
            *keys,
            "sum",
            "sum / count AS mean",
            f"CASE WHEN {uneven} THEN p3 / count / pow(p2 / count, 1.5) END AS skew",
            f"CASE WHEN {uneven} THEN p4 * count / (p2 * p2) - 3 END AS kurt",
            "CASE WHEN count > 1 THEN sqrt(p2 / (count - 1)) END AS std",
            "max",
            "min",
            "median",
        )
    )


def quantity_by_key(counted, naming):
    """Quantity statistics at goods, variant and (goods, variant) level, from value_counts().

    Returns one DataFrame per key of THREE_KEYS. naming(statistic, key index) gives the column
    name. The rows of a key are ordered once, for the median and the moments together.
    """
    sliced = many_values(counted, "value")
    return [
        _quantities(counted, key, sliced).select(
            "window_id", *key, *[F.col(s).alias(naming(s, i)) for s in FULL_ORDER]
        )
        for i, key in enumerate(THREE_KEYS)
    ]


def history_name(stat, key_index):
    """s1-s6 and s11-s28: two statistics, four price columns between, then six statistics."""
    place = FULL_ORDER.index(stat)
    first = 1 + 3 * place if place < 2 else 11 + 3 * (place - 2)
    return f"s{first + key_index}"


def last_week_name(stat, key_index):
    """sw_1-sw_24, the same statistics over the last week."""
    return f"sw_{1 + 3 * FULL_ORDER.index(stat) + key_index}"


def price_means_by_key(tagged):
    """Mean sale (s7, s8) and list price (s9, s10) per goods and per (goods, variant).

    Sums per pair serve both keys; they are staged, so the sales are read once.
    """
    prices = {7: "goods_price", 9: "orginal_shop_price"}
    sums = [f(c).alias(f"{n}_{c}") for c in prices.values() for n, f in (("s", F.sum), ("n", F.count))]
    per_pair = stage(tagged.groupBy("window_id", *GOODS_SKU).agg(*sums), "prices")
    blocks = []
    for i, key in enumerate((GOODS, GOODS_SKU)):
        means = [
            F.expr(sql_ratio(f"sum(s_{c})", f"sum(n_{c})")).alias(f"s{first + i}")
            for first, c in prices.items()
        ]
        blocks.append(per_pair.groupBy("window_id", *key).agg(*means))
    return blocks


LEVELS = (*CATEGORY_COLUMNS, "brand_id")


def category_rollup(sales, behaviour, goodsinfo):
    """Behaviour and sales sums per category level (1-7) and brand (8), as long rows.

    Facts shrink to one row per goods before they meet the attributes, and each goods row feeds
    all eight levels.
    """
    keys = ["window_id", "goods_id"]
    daily = behaviour.groupBy(*keys).agg(
        *[F.sum(c).cast("double").alias(c) for c in BEHAVIOUR_MEASURES]
    )
    sold = sales.groupBy(*keys).agg(F.sum("goods_num").cast("double").alias("goods_num"))
    both = daily.unionByName(sold, allowMissingColumns=True)
    levels = [
        F.struct(F.lit(i).alias("level"), F.col(c).cast("bigint").alias("category_id"))
        for i, c in enumerate(LEVELS, 1)
    ]
    measures = (*BEHAVIOUR_MEASURES, "goods_num")
    return (
        both.join(goodsinfo.select("goods_id", *LEVELS), "goods_id")
        .select("window_id", *measures, F.inline(F.array(*levels)))
        .filter("category_id is not null")
        .groupBy("window_id", "level", "category_id")
        .agg(*[F.sum(c).alias(c) for c in measures])
    )


def last_day_sums(tagged, index):
    """Units sold on the last date of the window, per variant and per goods."""
    final = tagged.filter(f"data_date >= {index.since(1)}")
    per_sku = final.groupBy("window_id", "sku_id").agg(
        F.sum("goods_num").cast("double").alias("last_day_sku_sale_num_sum")
    )
    per_goods = final.groupBy("window_id", "goods_id").agg(
        F.sum("goods_num").cast("double").alias("last_day_goods_sale_num_sum")
    )
    return per_sku, per_goods


# The positions of the largest-day features.
LARGEST_DAYS = (1, 2, 3, 5, 7, 10, 14)


def nth_largest_days(tagged, places=LARGEST_DAYS, missing=-999.0):
    """The n-th largest daily sale per variant; `missing` with fewer sale days.

    The list per variant has one entry per date of the window.
    """
    daily = tagged.groupBy("window_id", "sku_id", "data_date").agg(
        F.sum("goods_num").cast("double").alias("units")
    )
    ranked = daily.groupBy("window_id", "sku_id").agg(
        F.sort_array(F.collect_list("units"), asc=False).alias("units")
    )
    return ranked.select(
        "window_id",
        "sku_id",
        *[
            F.coalesce(F.try_element_at("units", F.lit(n)), F.lit(missing)).alias(
                f"sku_last_{n}_day_goods_num"
            )
            for n in places
        ],
    )
