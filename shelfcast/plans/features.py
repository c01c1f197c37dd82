"""The feature sets: one row per (window_id, sku_id), columns in alphabetical order.

Each set names its measures; aggregates over all spans of one key share one pass, blocks join at
variant grain, and rank columns are computed together on a staged table.
"""

from pyspark.sql import functions as F

from shelfcast.functions.dates import distance
from shelfcast.functions.numeric import fill_missing, ratio, sql_ratio
from shelfcast.operators import statistics as st
from shelfcast.operators.calendar import calendar_features, label_days
from shelfcast.operators.lookups import (
    attach_attributes,
    attach_by_goods,
    attach_by_sku,
    attach_goods,
    first_per_key,
    skus_per_goods,
)
from shelfcast.operators.ranks import RankSpec, rank_columns
from shelfcast.operators.segments import WindowedFacts
from shelfcast.operators.spans import Measure
from shelfcast.operators.windows import assign_windows
from shelfcast.plans import presets as p
from shelfcast.sources.schemas import BEHAVIOUR_MEASURES, CATEGORY_COLUMNS, WEATHER_COLUMNS

SKU_KEYS = ("window_id", "sku_id")
GOODS_KEYS = ("window_id", "goods_id")

SLIDE_STATS = ("max", "min", "mean", "median", "sum")
SKU_SLIDE = "goodsale_sku_{stat}_slide_{span}"
GOODS_SLIDE = "goodsale_goods_{stat}_slide_{span}"


def sales_in_windows(tables, windows, columns=("goods_num", "goods_price")):
    return WindowedFacts.of(
        tables.goodsale.select("data_date", "goods_id", "sku_id", *columns), windows
    )


def behaviour_in_windows(tables, windows):
    return WindowedFacts.of(tables.goodsdaily, windows)


def _finish(features, names):
    return features.select(*SKU_KEYS, *sorted(names))


def _names(measures):
    return [name for m in measures for _, _, name in m.outputs()]


def behaviour_measures(spans, stats, total=()):
    return [Measure(c, stats, spans, total) for c in BEHAVIOUR_MEASURES]


def slide_rank(tables, windows, universe, spans=p.RANKED_SPANS, fill=-999.0):
    """Behaviour and sales slides, prices, categories, global ranks and ranks inside the goods."""
    sales = sales_in_windows(tables, windows)
    sku_measures = [
        Measure("goods_num", SLIDE_STATS, spans, span_name=SKU_SLIDE),
        Measure("goods_price", total=("max", "min", "mean", "var"), total_name="sku_price_{stat}"),
    ]
    goods_measures = [
        Measure("goods_num", ("max", "min", "mean", "sum"), spans, span_name=GOODS_SLIDE)
    ]
    daily_measures = behaviour_measures(spans, ("max", "min", "mean", "sum"))
    based = attach_by_sku(
        attach_goods(universe, tables.goods_sku_relation),
        sales.stats("sku_id", sku_measures),
    )
    ranks = global_slide_ranks(spans, fill) + in_goods_ranks(spans, fill)
    ranked = rank_columns(based, ranks)
    categories = CATEGORY_COLUMNS[:5]
    full = attach_by_goods(ranked, sales.stats("goods_id", goods_measures))
    daily = behaviour_in_windows(tables, windows)
    full = attach_by_goods(full, daily.stats("goods_id", daily_measures))
    full = attach_attributes(full, tables.goodsinfo, categories)
    names = _names(goods_measures) + _names(daily_measures) + _names(sku_measures)
    names += categories
    return _finish(fill_missing(full, fill, names), names + [r.target for r in ranks])


def global_slide_ranks(spans, fill):
    """Minimum ranks of every slide statistic over the window: _rank_0 rising, _rank_1 falling."""
    return [
        RankSpec(
            f"goodsale_sku_{s}_slide_{i}",
            f"goodsale_sku_{s}_slide_{i}_rank_{d}",
            "min",
            d == 0,
            fill=fill,
        )
        for i in spans
        for s in SLIDE_STATS
        for d in (0, 1)
    ]


def in_goods_ranks(spans, fill):
    """Minimum ranks inside the goods: _rank_0 falling, _rank_1 rising."""
    sources = {"sku_price_mean": "sku_price_mean_rank_{d}"} | {
        f"goodsale_sku_sum_slide_{i}": f"same_goods_sku_slide_sum_{i}_rank_{{d}}" for i in spans
    }
    return [
        RankSpec(source, target.format(d=d), "min", d == 1, "goods_id", fill)
        for source, target in sources.items()
        for d in (0, 1)
    ]


def linear(tables, windows, universe, spans=p.RANKED_SPANS):
    """Behaviour and sales slides, prices and ascending ranks; gaps are 0, also in the ranks."""
    sales = sales_in_windows(tables, windows)
    sku_measures = [
        Measure("goods_num", SLIDE_STATS, spans, span_name=SKU_SLIDE),
        Measure("goods_price", total=("max", "min", "mean", "var"), total_name="sku_price_{stat}"),
    ]
    daily_measures = behaviour_measures(spans, ("max", "min", "mean", "sum"))
    based = attach_by_sku(
        attach_goods(universe, tables.goods_sku_relation),
        sales.stats("sku_id", sku_measures),
    )
    ranks = [
        RankSpec(
            f"goodsale_sku_{s}_slide_{i}", f"goodsale_sku_{s}_slide_{i}_rank", "min", fill=0.0
        )
        for i in spans
        for s in SLIDE_STATS
    ]
    daily = behaviour_in_windows(tables, windows)
    full = attach_by_goods(
        rank_columns(based, ranks), daily.stats("goods_id", daily_measures)
    )
    names = _names(sku_measures) + _names(daily_measures)
    return _finish(fill_missing(full, 0.0, names), names + [r.target for r in ranks])


# Statistics of the sale price that are also ranked; the names speak of sale numbers.
SALE_NUM_STATS = ("max", "min", "mean", "median", "sum")


def price_measures(measure="goods_price"):
    """Price and amount totals, and the sale-number block over `measure`."""
    return [
        Measure("amount", total=("sum",), total_name="amount_sum"),
        Measure("goods_price", total=("max", "min", "mean", "std"), total_name="sku_price_{stat}"),
        Measure(measure, total=(*SALE_NUM_STATS, "count"), total_name="sku_sale_num_{stat}"),
    ]


def sale_ranks(spans):
    """Average ranks of the sale-number, last-day and slide columns."""
    ranks = [RankSpec(f"sku_sale_num_{s}", f"sku_sale_num_{s}_rank") for s in SALE_NUM_STATS]
    ranks.append(RankSpec("last_day_sku_sale_num_sum", "last_day_sku_sale_num_sum_rank"))
    ranks += [
        RankSpec(f"goodsale_sku_{s}_slide_{i}", f"goodsale_sku_{s}_slide_{i}_rank_0")
        for i in spans
        for s in SLIDE_STATS
    ]
    return ranks


def _sales_block(tables, windows, universe, spans):
    """Variant-grain columns shared by the sales-only and the goods-context set, with ranks."""
    sales = sales_in_windows(tables, windows)
    sales = sales.with_column("amount", F.col("goods_num") * F.col("goods_price"))
    measures = [
        *price_measures(),
        Measure("goods_num", SLIDE_STATS, spans, span_name=SKU_SLIDE),
        Measure(
            "goods_num", ("sum",), (1,), span_name="last_day_sku_sale_num_sum"
        ),
    ]
    based = attach_by_sku(universe, sales.stats("sku_id", measures))
    ranks = sale_ranks(spans)
    return sales, rank_columns(based, ranks), _names(measures) + [r.target for r in ranks]


def sales_only(tables, windows, universe, spans=p.SALES_SPANS):
    """Prices, sale numbers, last day and slides with average ranks; gaps are 0 afterwards."""
    *_, full, names = _sales_block(tables, windows, universe, spans)
    return _finish(fill_missing(full, 0.0, names), names)


def goods_context(tables, windows, universe, spans=p.CONTEXT_SPANS):
    """The sales-only columns plus variants per goods, first category and goods sums."""
    based = attach_goods(universe, tables.goods_sku_relation)
    sales, full, names = _sales_block(tables, windows, based, spans)
    goods_measures = [
        Measure("goods_num", ("sum",), spans, span_name=GOODS_SLIDE),
        Measure("goods_num", ("sum",), (1,), span_name="last_day_goods_sale_num_sum"),
    ]
    full = attach_by_goods(full, sales.stats("goods_id", goods_measures))
    full = attach_by_goods(full, skus_per_goods(sales.present("goods_id", "sku_id")))
    full = attach_attributes(full, tables.goodsinfo, ["cat_level1_id"])
    names = names + _names(goods_measures) + ["sku_num", "cat_level1_id"]
    return _finish(fill_missing(full, 0.0, names), names)


def short_slide(
    tables,
    windows,
    universe,
    daily_spans=p.SHORT_DAILY_SPANS,
    sale_spans=p.SHORT_SALE_SPANS,
):
    """Behaviour slides with counts and totals, short sales slides with average ranks."""
    sales = sales_in_windows(tables, windows, ("goods_num",))
    daily_measures = behaviour_measures(
        daily_spans, ("max", "min", "mean", "count", "sum"), ("max", "min", "mean", "sum")
    )
    sku_measures = [
        Measure(
            "goods_num",
            ("max", "mean", "sum"),
            sale_spans,
            ("max", "mean", "sum"),
            SKU_SLIDE,
            "goodsale_sku_{stat}",
        )
    ]
    goods_measures = [
        Measure("goods_num", ("sum",), sale_spans, ("sum",), GOODS_SLIDE, "goodsale_goods_{stat}")
    ]
    based = attach_goods(universe, tables.goods_sku_relation)
    based = attach_by_goods(based, sales.stats("goods_id", goods_measures))
    based = attach_by_sku(based, sales.stats("sku_id", sku_measures))
    ranks = [
        RankSpec(f"{block}_slide_{i}", f"{block}_slide_{i}_rank")
        for i in sale_spans
        for block in ("goodsale_sku_sum", "goodsale_sku_mean", "goodsale_goods_sum")
    ]
    daily = behaviour_in_windows(tables, windows)
    full = attach_by_goods(
        rank_columns(based, ranks), daily.stats("goods_id", daily_measures)
    )
    names = _names(sku_measures) + _names(goods_measures) + _names(daily_measures)
    names += [r.target for r in ranks]
    return _finish(fill_missing(full, 0.0, names), names)


GRANULAR_STATS = ("max", "min", "mean", "var", "sum")
RATES = {
    "sale_click_rate": "goods_click_sum",
    "sale_cart_rate": "cart_click_sum",
    "sale_favorites_rate": "favorites_click_sum",
}


def granular_behaviour(daily, granularities=p.GRANULARITIES):
    """Behaviour totals, the same per calendar granularity, conversion rates, days on sale."""
    measures = [
        Measure(c, GRANULAR_STATS, granularities, GRANULAR_STATS, "{column}_{stat}{span}")
        for c in BEHAVIOUR_MEASURES
    ]
    measures.append(Measure("onsale_days", total=("first",), total_name="onsale_days"))
    stats = daily.stats("goods_id", measures, calendar=True)
    return stats.selectExpr("*", *conversion_rates(("", *granularities)))


def conversion_rates(suffixes):
    """Buyers per click, cart and favourite; NULL without any."""
    return [
        f"{sql_ratio(f'sales_uv_sum{i}', f'{base}{i}')} AS {rate}{i}"
        for i in suffixes
        for rate, base in RATES.items()
    ]


def sale_day_measures():
    four = ("max", "min", "mean", "var")
    return [
        Measure("goods_num", total=four),
        Measure("goods_price", total=four),
        Measure("data_date", total=("max", "rows"), total_name="data_date_{stat}"),
    ]


def sale_distance(windows, mode="calendar"):
    """Days from the last sale to the end of the feature range."""
    end = F.coalesce(
        *[F.when(F.col("window_id") == w.window_id, F.lit(w.feature[1])) for w in windows]
    )
    return distance(end, F.col("data_date_max"), mode)


def granularity(
    tables,
    windows,
    universe,
    granularities=p.GRANULARITIES,
    distance_mode="calendar",
    rank_by="sku_id",
    goods_from_sales=False,
):
    """Brand, behaviour per calendar granularity, rates, sale days, prices; gaps stay NULL.

    rank_by is the column ranked inside the goods ("sku_id" or "sku_sale_day_num").
    goods_from_sales takes goods_id from a variant's first sale instead of the relation table.
    """
    sales = sales_in_windows(tables, windows)
    if goods_from_sales:
        first = first_per_key(sales.tagged(), SKU_KEYS, ["data_date"], ["data_date", "goods_id"])
        based = attach_by_sku(universe, first.drop("data_date"))
    else:
        based = attach_goods(universe, tables.goods_sku_relation)
    sold = sales.stats("sku_id", sale_day_measures()).withColumnRenamed(
        "data_date_rows", "sku_sale_day_num"
    )
    daily = granular_behaviour(behaviour_in_windows(tables, windows), granularities)
    full = attach_attributes(attach_by_sku(based, sold), tables.goodsinfo, ["brand_id"])
    full = full.withColumn("max_sub_last", sale_distance(windows, distance_mode)).drop("data_date_max")
    ranks = [
        RankSpec(rank_by, "rank_sku_sale_day_num_asc", "min", False, "goods_id"),
        RankSpec(rank_by, "rank_sku_sale_day_num_dec", "min", True, "goods_id"),
    ]
    # The many behaviour columns come last, so that no task sorts rows that hold them per variant.
    ranked = attach_by_goods(rank_columns(full, ranks), daily)
    ranked = ranked.withColumn("days_rate", ratio("sku_sale_day_num", "onsale_days")).drop("onsale_days")
    names = [c for c in ranked.columns if c not in ("window_id", "sku_id", "goods_id")]
    return _finish(ranked, names)


# Inputs of the day-grain regression; marketing and plan are carried but not used for fitting.
DAY_INPUTS = (
    "week",
    "day_rank",
    "holiday_code",
    *WEATHER_COLUMNS,
    *CATEGORY_COLUMNS,
    "brand_id",
    *[f"f{i}" for i in range(1, 10)],
    *[f"s{i}" for i in range(1, 29)],
)


def day_history(tables, windows, relation_universe):
    """History columns f1-f9 and s1-s28 with attributes, one row per (window, variant)."""
    sales = assign_windows(
        tables.goodsale.select(
            "data_date", "goods_id", "sku_id", "goods_num", "goods_price", "orginal_shop_price"
        ),
        windows,
    )
    behaviour = assign_windows(tables.goodsdaily, windows)
    by_goods, by_sku, by_both = st.quantity_by_key(st.value_counts(sales), st.history_name)
    price_goods, price_both = st.price_means_by_key(sales)
    both = ["window_id", "goods_id", "sku_id"]
    per_pair = by_both.join(price_both, both, "left")
    per_goods = by_goods.join(price_goods, ["window_id", "goods_id"], "left")
    full = attach_by_goods(relation_universe, per_goods)
    full = attach_by_goods(full, st.goods_behaviour_stats(behaviour))
    full = attach_attributes(full, tables.goodsinfo, [*CATEGORY_COLUMNS, "brand_id"])
    full = attach_by_sku(full, by_sku)
    return full.join(per_pair, both, "left")


def day_level(tables, windows, targets, dedupe=True, finish=None):
    """The day-grain table: history per variant, exploded to label days with calendars.

    All joins by variant and goods happen before the explosion to days. `finish` is applied to the
    history and the weather before their rows are repeated for the days.
    """
    finish = finish or (lambda df: df)
    ids = F.explode(F.array(*[F.lit(w.window_id) for w in windows]))
    universe = attach_goods(
        targets.select("sku_id").withColumn("window_id", ids), tables.goods_sku_relation
    )
    history = finish(day_history(tables, windows, universe))
    days = label_days(history, tables.goodsale, windows)
    weather = None if tables.weather is None else finish(tables.weather)
    full = calendar_features(days, windows, tables.marketing, tables.holiday, weather, dedupe)
    extra = [c for c in ("marketing", "plan") if c in full.columns]
    inputs = [c for c in DAY_INPUTS if c in full.columns]
    return full.select(
        "window_id", "sku_id", "goods_id", "data_date", "goods_num", *extra, *inputs
    )


FEATURE_SETS = {
    "slide_rank": slide_rank,
    "sales_only": sales_only,
    "short_slide": short_slide,
    "goods_context": goods_context,
    "linear": linear,
    "granularity": granularity,
}
