"""One query per operator, over the whole test tables.

Seven windows cover all sales: six training years with labels and the last part as the forecast
window, whose universe is the submission list. Computed DOUBLE columns are snapped to four
decimals (away from decimal ties), as in the SQL twins.
"""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfcast.catalog import NULLABLE_INTEGERS
from shelfcast.functions.dates import distance, shift
from shelfcast.functions.numeric import (
    WEEKS,
    clamp,
    minmax_scale,
    ratio,
    reverse_weeks,
)
from shelfcast.functions.prices import parse_price, parse_price_const
from shelfcast.operators import calendar as cal
from shelfcast.operators import lookups as lk
from shelfcast.operators import statistics as st
from shelfcast.operators.labels import days_to_weeks, resum_weeks, weekly_label
from shelfcast.operators.ranks import RankSpec, fuse_ranks, rank_columns
from shelfcast.operators.segments import WindowedFacts
from shelfcast.operators.spans import Measure, span_stats
from shelfcast.operators.windows import (
    WindowSpec,
    assign_windows,
    date_index,
    date_positions,
    date_range,
)
from shelfcast.plans import features as ft
from shelfcast.plans import models, presets
from shelfcast.plans.boosting import fit_boosted
from shelfcast.plans.forecasts import assemble_forecast, share_of_total
from shelfcast.plans.linear import fit_linear
from shelfcast.plans.training import feature_columns, joint_set, training_universe
from shelfcast.session import compiled_only
from shelfcast.sources import testdata as td
from shelfcast.sources.staging import scratch
from shelfcast.sources.tables import (
    append_editions,
    parse_sale_prices,
    read_ordered,
    target_skus,
    write_ordered,
)

YEARS = tuple(
    WindowSpec(i, feature, label)
    for i, (feature, label) in enumerate(
        [
            ((19950101, 19960330), (19960515, 19960618)),
            ((19960331, 19970330), (19970515, 19970618)),
            ((19970331, 19980330), (19980515, 19980618)),
            ((19980331, 19990330), (19990515, 19990618)),
            ((19990331, 20000330), (20000515, 20000618)),
            ((20000331, 20010330), (20010515, 20010618)),
        ]
    )
)
FORECAST = WindowSpec(6, (20010331, 20011231))
ALL = (*YEARS, FORECAST)
DAYS = (
    WindowSpec(0, (19950101, 19980330), (19980515, 19980618)),
    WindowSpec(1, (19980331, 20010930), (20011001, 20011104)),
)
EVERYTHING = (19950101, 20011231)

SNAP = 0.500731


def _snap(c):
    fine, coarse = (F.floor(c.cast("double") * s + SNAP) / s for s in (1e4, 1e1))
    return F.when(F.abs(c) < 1e6, fine).otherwise(coarse)


def _snapped_doubles(df):
    """Snap every DOUBLE column, see snapped()."""
    doubles = (T.DoubleType, T.FloatType)
    return df.select(
        *[_snap(F.col(f.name)).alias(f.name) if isinstance(f.dataType, doubles) else f.name for f in df.schema]
    )


def snapped(df, done=()):
    """Snap every DOUBLE column to four decimals; integers of all widths become BIGINT.

    From a million up one decimal is kept, since the fourth lies below the precision of a sum. Columns
    in `done` are snapped already.
    """
    columns = []
    for field in df.schema.fields:
        c = F.col(field.name)
        if isinstance(field.dataType, (T.DoubleType, T.FloatType)) and field.name not in done:
            c = _snap(c)
        elif isinstance(field.dataType, (T.IntegerType, T.ShortType)):
            c = c.cast("bigint")
        columns.append(c.alias(field.name))
    return df.select(*columns)


def _sales(spark, folder, windows=ALL, list_price=False):
    return assign_windows(td.goodsale(spark, folder, list_price), windows)


def _behaviour(spark, folder):
    return assign_windows(td.goodsdaily(spark, folder), ALL)


def _universe(tables):
    """Sold variants of the training years plus the submission list."""
    return training_universe(tables, YEARS).unionByName(
        lk.forecast_universe(tables.submit_example, FORECAST.window_id)
    )


def _sku_stats(spark, folder, measures):
    sales = _sales(spark, folder)
    sales = sales.withColumn("amount", F.col("goods_num") * F.col("goods_price"))
    return span_stats(sales, ft.SKU_KEYS, measures, date_index(sales, ALL).since)


def _goods_stats(spark, folder, measures):
    sales = _sales(spark, folder)
    return span_stats(sales, ft.GOODS_KEYS, measures, date_index(sales, ALL).since)


def _daily_stats(spark, folder, measures):
    daily = _behaviour(spark, folder)
    return span_stats(daily, ft.GOODS_KEYS, measures, date_index(daily, ALL).since)


# Sources, filters, scalar expressions -----------------------------------------------------------


def scan_goodsale(spark, folder):
    return td.goodsale(spark, folder, list_price=True)


def union_editions(spark, folder):
    sales = td.goodsale(spark, folder)
    return append_editions(
        date_range(sales, EVERYTHING[0], 19981231), date_range(sales, 19990101, EVERYTHING[1])
    )


def csv_round_trip(spark, folder):
    """All sales written as ordered CSV and read back, prices as text with separators."""
    sales = td.goodsale(spark, folder, list_price=True)
    text = sales.withColumns(
        {c: F.col(c).cast("string") for c in ("goods_price", "orginal_shop_price")}
    )
    path = scratch(spark, "csv")
    write_ordered(text, path, ["data_date", "sku_id"])
    return parse_sale_prices(read_ordered(spark, path, "goodsale"))


def _price_text(spark, folder):
    lines = spark.read.parquet(f"{folder}/lineitem.parquet")
    return lines.select(
        "l_orderkey", "l_linenumber", F.format_number("l_extendedprice", 2).alias("text")
    )


def parse_price_query(spark, folder):
    return _price_text(spark, folder).select(
        "l_orderkey", "l_linenumber", parse_price("text").alias("price")
    )


def parse_price_const_query(spark, folder):
    return _price_text(spark, folder).select(
        "l_orderkey", "l_linenumber", parse_price_const("text").alias("price")
    )


def window_filter(spark, folder):
    lo, hi = 19960229, 20001231
    return date_range(td.goodsale(spark, folder, lo=lo, hi=hi), lo, hi)


def sku_universe(spark, folder):
    return lk.sku_universe(_sales(spark, folder))


def date_index_query(spark, folder):
    return date_positions(_sales(spark, folder))


def first_per_key(spark, folder):
    return lk.first_per_key(
        _behaviour(spark, folder), ft.GOODS_KEYS, ["data_date"], ["data_date", "onsale_days"]
    )


# Forecast assembly ------------------------------------------------------------------------------


def rule_forecast(spark, folder):
    return share_of_total(
        td.goodsale(spark, folder), td.submit_example(spark, folder), EVERYTHING
    )


def sku_window_sum(spark, folder):
    return _sku_stats(
        spark, folder, [Measure("goods_num", total=("sum",), total_name="sale_num")]
    )


def _stand_in(spark, folder):
    """Sales of five label weeks as a stand-in forecast; unsold variants stay NULL."""
    start = YEARS[4].label[0]
    sales = td.goodsale(spark, folder, lo=start, hi=shift(start, 34))
    return days_to_weeks(sales, start)


def assemble_forecast_query(spark, folder):
    return assemble_forecast(td.submit_example(spark, folder), _stand_in(spark, folder))


def clamp_modes(spark, folder):
    lowered = assemble_forecast_query(spark, folder).select(
        "sku_id", *[(F.col(w) / 4 - 5.0).alias(w) for w in WEEKS]
    )
    return lowered.select(
        "sku_id",
        *[
            clamp(w, mode).alias(f"{w}_{mode}")
            for w in WEEKS
            for mode in ("keep_null", "zero_null", "round")
        ],
    )


def reverse_weeks_query(spark, folder):
    return reverse_weeks(assemble_forecast_query(spark, folder))


# Sales aggregates -------------------------------------------------------------------------------


def sku_slide(spark, folder):
    return _sku_stats(
        spark,
        folder,
        [Measure("goods_num", ft.SLIDE_STATS, presets.RANKED_SPANS, span_name=ft.SKU_SLIDE)],
    )


def sku_slide_short(spark, folder):
    three = ("max", "mean", "sum")
    measure = Measure(
        "goods_num", three, presets.SHORT_SALE_SPANS, three, ft.SKU_SLIDE, "goodsale_sku_{stat}"
    )
    return _sku_stats(spark, folder, [measure])


def sku_price_var(spark, folder):
    four = ("max", "min", "mean", "var")
    return _sku_stats(
        spark, folder, [Measure("goods_price", total=four, total_name="sku_price_{stat}")]
    )


def sku_price_stats(spark, folder):
    return _sku_stats(spark, folder, ft.price_measures()[:2])


def sku_sale_num_stats(spark, folder):
    return _sku_stats(spark, folder, ft.price_measures()[2:])


def sku_quantity_stats(spark, folder):
    return _sku_stats(spark, folder, ft.sale_day_measures()[:1])


def sku_sale_days(spark, folder):
    measure = Measure("data_date", total=("rows",), total_name="sku_sale_day_num")
    return _sku_stats(spark, folder, [measure])


def last_sale_distance(spark, folder):
    last = _sku_stats(spark, folder, [Measure("data_date", total=("max",))])
    return last.select(
        *ft.SKU_KEYS,
        "data_date_max",
        ft.sale_distance(ALL).alias("max_sub_last"),
        distance(F.lit(EVERYTHING[1]), F.col("data_date_max"), "int").alias("integer_distance"),
    )


def last_day(spark, folder):
    sales = _sales(spark, folder)
    per_sku, per_goods = st.last_day_sums(sales, date_index(sales, ALL))
    tables = td.model_tables(spark, folder)
    full = lk.attach_goods(lk.sku_universe(sales), tables.goods_sku_relation)
    return lk.attach_by_goods(lk.attach_by_sku(full, per_sku), per_goods)


def nth_largest_day(spark, folder):
    return st.nth_largest_days(_sales(spark, folder))


def goods_slide(spark, folder):
    four = ("max", "min", "mean", "sum")
    measure = Measure("goods_num", four, presets.RANKED_SPANS, span_name=ft.GOODS_SLIDE)
    return _goods_stats(spark, folder, [measure])


def goods_slide_sum(spark, folder):
    measure = Measure(
        "goods_num",
        ("sum",),
        presets.SHORT_SALE_SPANS,
        ("sum",),
        ft.GOODS_SLIDE,
        "goodsale_goods_{stat}",
    )
    return _goods_stats(spark, folder, [measure])


def goods_to_sku(spark, folder):
    tables = td.model_tables(spark, folder)
    return lk.attach_by_goods(
        lk.attach_goods(_universe(tables), tables.goods_sku_relation),
        goods_slide_sum(spark, folder),
    )


def sku_per_goods(spark, folder):
    return lk.skus_per_goods(_sales(spark, folder))


# Behaviour aggregates ---------------------------------------------------------------------------


def goodsdaily_slide(spark, folder):
    four = ("max", "min", "mean", "sum")
    return _daily_stats(spark, folder, ft.behaviour_measures(presets.RANKED_SPANS, four))


def goodsdaily_slide_count(spark, folder):
    five = ("max", "min", "mean", "count", "sum")
    return _daily_stats(spark, folder, ft.behaviour_measures(presets.SHORT_DAILY_SPANS, five))


def goodsdaily_total(spark, folder):
    four = ("max", "min", "mean", "sum")
    return _daily_stats(spark, folder, ft.behaviour_measures((), (), four))


def goodsdaily_var(spark, folder):
    return _daily_stats(spark, folder, ft.behaviour_measures((), (), ft.GRANULAR_STATS))


def _granular(spark, folder):
    return ft.granular_behaviour(WindowedFacts.of(td.goodsdaily(spark, folder), ALL))


def goodsdaily_granularity(spark, folder):
    wide = _granular(spark, folder)
    spans = tuple(str(i) for i in presets.GRANULARITIES)
    kept = [c for c in wide.columns if c.endswith(spans) and "_rate" not in c]
    return wide.select(*ft.GOODS_KEYS, *kept)


def conversion_rates(spark, folder):
    wide = _granular(spark, folder)
    return wide.select(*ft.GOODS_KEYS, *[c for c in wide.columns if "_rate" in c])


def sale_day_rate(spark, folder):
    tables = td.model_tables(spark, folder)
    days = sku_sale_days(spark, folder)
    first = first_per_key(spark, folder).drop("data_date")
    joined = lk.attach_by_goods(lk.attach_goods(days, tables.goods_sku_relation), first)
    return lk.attach_by_sku(joined, days).select(
        *ft.SKU_KEYS, ratio("sku_sale_day_num", "onsale_days").alias("days_rate")
    )


def goods_behaviour_stats(spark, folder):
    return st.goods_behaviour_stats(_behaviour(spark, folder))


def goods_behaviour_moments(spark, folder):
    return st.goods_behaviour_moments(_behaviour(spark, folder))


def weekday_sums(spark, folder):
    return st.weekday_sums(_behaviour(spark, folder))


def last_week_behaviour(spark, folder):
    daily = _behaviour(spark, folder)
    recent = daily.filter(f"data_date >= {date_index(daily, ALL).since_days(6)}")
    return st.last_week_behaviour(recent)


# Sales at three keys, categories ----------------------------------------------------------------


def _at_pairs(pairs, blocks, keys):
    # The finest block needs no move of the pairs; the rows that move later are narrower so.
    result = pairs
    for block, key in sorted(zip(blocks, keys), key=lambda found: -len(found[1])):
        result = result.join(block, ["window_id", *key], "left")
    names = [c for block, key in zip(blocks, keys) for c in block.columns[1 + len(key) :]]
    return result.select(*pairs.columns, *names)


def sale_stats_multi_key(spark, folder):
    counted = st.value_counts(_sales(spark, folder))
    blocks = st.quantity_by_key(counted, st.history_name)
    return _at_pairs(st.pairs_of(counted), blocks, st.THREE_KEYS)


def price_means_multi_key(spark, folder):
    sales = _sales(spark, folder, list_price=True)
    by_goods, by_pair = st.price_means_by_key(sales)
    return by_pair.join(by_goods, ["window_id", "goods_id"], "left")


def last_week_stats(spark, folder):
    sales = _sales(spark, folder)
    recent = sales.filter(f"data_date >= {date_index(sales, ALL).since_days(6)}")
    counted = st.value_counts(recent)
    blocks = st.quantity_by_key(counted, st.last_week_name)
    return _at_pairs(st.pairs_of(counted), blocks, st.THREE_KEYS)


def category_rollup(spark, folder):
    return st.category_rollup(
        _sales(spark, folder), _behaviour(spark, folder), td.goodsinfo(spark, folder)
    )


def goods_attributes(spark, folder):
    tables = td.model_tables(spark, folder)
    universe = lk.attach_goods(_universe(tables), tables.goods_sku_relation)
    return lk.attach_attributes(
        universe, tables.goodsinfo, ["brand_id", *[f"cat_level{i}_id" for i in range(1, 8)]]
    )


# Ranks ------------------------------------------------------------------------------------------


def _rank_base(spark, folder):
    tables = td.model_tables(spark, folder)
    measures = [
        Measure("goods_num", ("mean", "sum"), (7, 27), span_name=ft.SKU_SLIDE),
        Measure("goods_price", total=("mean",), total_name="sku_price_{stat}"),
    ]
    universe = lk.attach_goods(_universe(tables), tables.goods_sku_relation)
    return lk.attach_by_sku(universe, _sku_stats(spark, folder, measures))


def _global_min(spark, folder, by_value):
    ranks = [
        RankSpec(f"goodsale_sku_{s}_slide_{i}", f"{s}_{i}_rank_{d}", "min", d == 0, None, -999.0)
        for s in ("mean", "sum")
        for i in (7, 27)
        for d in (0, 1)
    ]
    ranked = rank_columns(_rank_base(spark, folder), ranks, by_value=by_value)
    return ranked.select(*ft.SKU_KEYS, *[r.target for r in ranks])


def _global_avg(spark, folder, by_value):
    sources = [f"goodsale_sku_{s}_slide_{i}" for s in ("mean", "sum") for i in (7, 27)]
    ranks = [RankSpec(c, f"{c}_rank") for c in (*sources, "sku_price_mean")]
    ranked = rank_columns(_rank_base(spark, folder), ranks, by_value=by_value)
    return ranked.select(*ft.SKU_KEYS, *[r.target for r in ranks])


def global_rank_min(spark, folder):
    return _global_min(spark, folder, None)


def global_rank_avg(spark, folder):
    return _global_avg(spark, folder, None)


def global_rank_min_sliced(spark, folder):
    """The same ranks from ordered slices of distinct values, as for tables of any size."""
    return _global_min(spark, folder, True)


def global_rank_avg_sliced(spark, folder):
    return _global_avg(spark, folder, True)


def price_rank_in_goods(spark, folder):
    ranks = ft.in_goods_ranks((), -999.0)
    ranked = rank_columns(_rank_base(spark, folder), ranks)
    return ranked.select(*ft.SKU_KEYS, "goods_id", *[r.target for r in ranks])


def slide_rank_in_goods(spark, folder):
    ranks = ft.in_goods_ranks((7, 27), -999.0)[2:]
    ranked = rank_columns(_rank_base(spark, folder), ranks)
    return ranked.select(*ft.SKU_KEYS, "goods_id", *[r.target for r in ranks])


def sku_rank_in_goods(spark, folder):
    ranks = [
        RankSpec("sku_id", "rank_sku_sale_day_num_asc", "min", False, "goods_id"),
        RankSpec("sku_id", "rank_sku_sale_day_num_dec", "min", True, "goods_id"),
    ]
    ranked = rank_columns(_rank_base(spark, folder), ranks)
    return ranked.select(*ft.SKU_KEYS, "goods_id", *[r.target for r in ranks])


def rank_fusion(spark, folder):
    scores = td.goodsale(spark, folder).groupBy("goods_id", "sku_id").agg(
        F.sum("goods_num").alias("score1"), F.avg("goods_price").alias("score2")
    )
    return fuse_ranks(scores, "goods_id", "sku_id", "score1", "score2")


# Labels, skeletons, calendars -------------------------------------------------------------------


def weekly_label_query(spark, folder):
    labelled = [w for w in YEARS if w.label]
    first = min(min(w.feature[0], w.label[0]) for w in labelled)
    last = max(max(w.feature[1], w.label[1]) for w in labelled)
    tables = td.model_tables(spark, folder, lo=first, hi=last)
    return weekly_label(tables.goodsale, YEARS, training_universe(tables, YEARS))


def day_skeleton(spark, folder):
    return cal.day_skeleton(
        target_skus(td.submit_example(spark, folder)), td.relation(spark, folder), DAYS
    )


def day_skeleton_label(spark, folder):
    tables = td.model_tables(spark, folder)
    ids = F.explode(F.array(*[F.lit(w.window_id) for w in DAYS]))
    universe = lk.attach_goods(
        tables.submit_example.withColumn("window_id", ids), tables.goods_sku_relation
    )
    return cal.label_days(universe, tables.goodsale, DAYS)


def calendar_features(spark, folder):
    tables = td.model_tables(spark, folder)
    return cal.calendar_features(
        day_skeleton(spark, folder), DAYS, tables.marketing, tables.holiday, tables.weather
    )


def calendar_features_repeated(spark, folder):
    """Repeated holiday dates are kept, so the rows of those dates repeat."""
    return cal.calendar_features(
        day_skeleton(spark, folder), DAYS, holiday=td.holiday(spark, folder), dedupe=False
    )


def day_to_week(spark, folder):
    return _stand_in(spark, folder)


def resum_weeks_query(spark, folder):
    tables = td.model_tables(spark, folder)
    labels = weekly_label(tables.goodsale, YEARS, training_universe(tables, YEARS))
    return resum_weeks(labels)


def minmax_scale_query(spark, folder):
    stats = sku_slide_short(spark, folder)
    columns = [c for c in stats.columns if c not in ft.SKU_KEYS]
    last = FORECAST.window_id
    return minmax_scale(
        stats.filter(F.col("window_id") != last), stats.filter(F.col("window_id") == last), columns
    )


# Feature sets and training sets -----------------------------------------------------------------


def _feature_query(name):
    def build(spark, folder):
        tables = td.model_tables(spark, folder)
        return ft.FEATURE_SETS[name](tables, ALL, _universe(tables))

    return build


def features_day_level(spark, folder, finish=None):
    tables = td.model_tables(spark, folder, list_price=True)
    return ft.day_level(tables, DAYS, target_skus(tables.submit_example), finish=finish)


def _day_level_snapped(spark, folder):
    """The day-grain table with its inputs snapped before each row is repeated for 35 days."""
    days = features_day_level(spark, folder, _snapped_doubles)
    return snapped(days, [c for c in days.columns if c != "goods_num"])


# Windows that share most of their dates, and one inside of another.
OVERLAP = (
    WindowSpec(0, (19950101, 19981231)),
    WindowSpec(1, (19950701, 19990630)),
    WindowSpec(2, (19960101, 20011231)),
    WindowSpec(3, (19970101, 19970331)),
    WindowSpec(4, (19970315, 20000229)),
)


def multi_window_overlap(spark, folder):
    """Slides, prices and variants per goods of five windows that overlap."""
    facts = td.goodsale(spark, folder)
    sales = WindowedFacts.of(facts, OVERLAP)
    measures = [
        Measure("goods_num", ft.SLIDE_STATS, presets.RANKED_SPANS, span_name=ft.SKU_SLIDE),
        Measure("goods_num", ("count", "var"), (7, 90), ("median", "first"), ft.SKU_SLIDE, "whole_{stat}"),
        Measure("goods_price", total=("max", "min", "mean", "var"), total_name="sku_price_{stat}"),
    ]
    stats = sales.stats("sku_id", measures)
    held = sales.present("goods_id", "sku_id")
    # Narrow rows meet by goods, so the statistics move once, by variant.
    counted = held.join(lk.skus_per_goods(held), ["window_id", "goods_id"])
    names = [c for c in stats.columns if c not in ft.SKU_KEYS]
    return stats.join(counted, ["window_id", "sku_id"]).select(
        "window_id", "goods_id", "sku_id", *names, "sku_num"
    )


def multi_window_training(spark, folder):
    tables = td.model_tables(spark, folder)
    return joint_set(tables, YEARS, FORECAST, "short_slide")


# Models -----------------------------------------------------------------------------------------


def ols_simple(spark, folder):
    """Week 1 units against the units of the feature window, over all training windows."""
    sold = sku_window_sum(spark, folder)
    rows = sold.join(weekly_label_query(spark, folder), ["window_id", "sku_id"])
    model = fit_linear(rows, ["sale_num"], ["week1"], 0.0)
    return spark.createDataFrame(
        [(float(model.coefficients[0, 0]), float(model.intercepts[0]))],
        "slope double, intercept double",
    )


# Few inputs, so that the twin can solve them in closed form.
FEW = ("goods_num_sum", "goods_price_mean")


def _few_inputs(spark, folder):
    return _sku_stats(
        spark, folder, [Measure("goods_num", total=("sum",)), Measure("goods_price", total=("mean",))]
    )


def ols_week_two_inputs(spark, folder):
    """All weeks on units and mean price, and on copies of both, which must not matter."""
    stats = _few_inputs(spark, folder).withColumns(
        {"copied": F.col("goods_num_sum") * 2, "mixed": F.col("goods_num_sum") - F.col("goods_price_mean")}
    )
    train = stats.join(weekly_label_query(spark, folder), ["window_id", "sku_id"])
    test = stats.where(F.col("window_id") == FORECAST.window_id)
    columns = [*FEW, "copied", "mixed"]
    return models.linear_weeks(train, test, 0.0, "zero_null", columns=columns)


def ols_day_two_inputs(spark, folder):
    """Units per day on weekday and day index, added up to weeks and rounded."""
    days = cal.calendar_features(day_skeleton_label(spark, folder), DAYS)
    train, test = days.filter("window_id = 0"), days.filter("window_id = 1")
    forecast = models.linear_days(train, test, ["week", "day_rank"], DAYS[1].label[0])
    return forecast.select("sku_id", *[clamp(w, "keep_null").alias(w) for w in WEEKS])


def _joint(spark, folder, name):
    tables = td.model_tables(spark, folder)
    joint = joint_set(tables, YEARS, FORECAST, name)
    last = F.col("window_id") == FORECAST.window_id
    return joint.filter(~last), joint.filter(last)


def ols_week_forecast(spark, folder):
    train, test = _joint(spark, folder, "linear")
    return models.linear_weeks(train, test, 0.0)


BRIEF = presets.Boosting(0.1, 4, 5, min_child=25)


def gbt_week_forecast(spark, folder):
    """All trees of the published model, for every week."""
    train, test = _joint(spark, folder, "sales_only")
    return models.boosted_weeks(train, test, presets.PRESETS["boosted_sales_only"].boosting)


def ols_day_forecast(spark, folder):
    days = features_day_level(spark, folder)
    columns = [c for c in ft.DAY_INPUTS if c in days.columns]
    train, test = days.filter("window_id = 0"), days.filter("window_id = 1")
    forecast = models.linear_days(train, test, columns, DAYS[1].label[0])
    return forecast.select("sku_id", *[clamp(w, "round").alias(w) for w in WEEKS])


def select_by_importance(spark, folder):
    """Inputs with positive importance in a first fit on week 1."""
    train, _ = _joint(spark, folder, "sales_only")
    model = fit_boosted(train, feature_columns(train), [["week1"]], BRIEF)
    return spark.createDataFrame(model.importances(), "feature string, importance double")


def select_by_gain(spark, folder):
    """Gain of a single split of the units per day, with a copied and a constant input."""
    days = cal.calendar_features(day_skeleton_label(spark, folder), DAYS).withColumns(
        {"copied": F.col("day_rank"), "constant": F.lit(1)}
    )
    stump = presets.Boosting(1.0, 1, 1)
    model = fit_boosted(days, ["constant", "week", "day_rank", "copied"], [["goods_num"]], stump)
    gains = [(c, float(g)) for c, g in zip(model.columns, model.gains[0])]
    return spark.createDataFrame(gains, "feature string, gain double")


PLAIN = {
    "scan_goodsale": scan_goodsale,
    "union_editions": union_editions,
    "csv_round_trip": csv_round_trip,
    "parse_price": parse_price_query,
    "parse_price_const": parse_price_const_query,
    "window_filter": window_filter,
    "sku_universe": sku_universe,
    "date_index": date_index_query,
    "first_per_key": first_per_key,
    "rule_forecast": rule_forecast,
    "sku_window_sum": sku_window_sum,
    "assemble_forecast": assemble_forecast_query,
    "clamp_modes": clamp_modes,
    "reverse_weeks": reverse_weeks_query,
    "sku_slide": sku_slide,
    "sku_slide_short": sku_slide_short,
    "sku_price_var": sku_price_var,
    "sku_price_stats": sku_price_stats,
    "sku_sale_num_stats": sku_sale_num_stats,
    "sku_quantity_stats": sku_quantity_stats,
    "sku_sale_days": sku_sale_days,
    "last_sale_distance": last_sale_distance,
    "last_day": last_day,
    "nth_largest_day": nth_largest_day,
    "goods_slide": goods_slide,
    "goods_slide_sum": goods_slide_sum,
    "goods_to_sku": goods_to_sku,
    "sku_per_goods": sku_per_goods,
    "goodsdaily_slide": goodsdaily_slide,
    "goodsdaily_slide_count": goodsdaily_slide_count,
    "goodsdaily_total": goodsdaily_total,
    "goodsdaily_var": goodsdaily_var,
    "goodsdaily_granularity": goodsdaily_granularity,
    "conversion_rates": conversion_rates,
    "sale_day_rate": sale_day_rate,
    "goods_behaviour_stats": goods_behaviour_stats,
    "goods_behaviour_moments": goods_behaviour_moments,
    "weekday_sums": weekday_sums,
    "last_week_behaviour": last_week_behaviour,
    "sale_stats_multi_key": sale_stats_multi_key,
    "price_means_multi_key": price_means_multi_key,
    "last_week_stats": last_week_stats,
    "category_rollup": category_rollup,
    "goods_attributes": goods_attributes,
    "global_rank_min": global_rank_min,
    "global_rank_avg": global_rank_avg,
    "global_rank_min_sliced": global_rank_min_sliced,
    "global_rank_avg_sliced": global_rank_avg_sliced,
    "price_rank_in_goods": price_rank_in_goods,
    "slide_rank_in_goods": slide_rank_in_goods,
    "sku_rank_in_goods": sku_rank_in_goods,
    "rank_fusion": rank_fusion,
    "weekly_label": weekly_label_query,
    "day_skeleton": day_skeleton,
    "day_skeleton_label": day_skeleton_label,
    "calendar_features": calendar_features,
    "calendar_features_repeated": calendar_features_repeated,
    "day_to_week": day_to_week,
    "resum_weeks": resum_weeks_query,
    "minmax_scale": minmax_scale_query,
    "features_slide_rank": _feature_query("slide_rank"),
    "features_sales_only": _feature_query("sales_only"),
    "features_short_slide": _feature_query("short_slide"),
    "features_goods_context": _feature_query("goods_context"),
    "features_linear": _feature_query("linear"),
    "features_granularity": _feature_query("granularity"),
    "features_day_level": features_day_level,
    "multi_window_training": multi_window_training,
    "multi_window_overlap": multi_window_overlap,
    "ols_simple": ols_simple,
    "ols_week_two_inputs": ols_week_two_inputs,
    "ols_day_two_inputs": ols_day_two_inputs,
    "ols_week_forecast": ols_week_forecast,
    "ols_day_forecast": ols_day_forecast,
    "gbt_week_forecast": gbt_week_forecast,
    "select_by_importance": select_by_importance,
    "select_by_gain": select_by_gain,
}


def _with_snap(name, query):
    doubles = NULLABLE_INTEGERS.get(name, ())
    early = {"features_day_level": _day_level_snapped}

    def run(spark, folder):
        compiled_only(spark)
        found = early[name](spark, folder) if name in early else snapped(query(spark, folder))
        return found.withColumns(
            {c: F.col(c).cast("double") for c in doubles}
        )

    run.__name__ = query.__name__
    run.__doc__ = query.__doc__
    return run


QUERIES = {name: _with_snap(name, query) for name, query in PLAIN.items()}
