"""Training and scoring sets: features of several windows, stacked, with their labels."""

from pyspark.sql import functions as F

from shelfcast.functions.numeric import WEEKS
from shelfcast.operators.labels import weekly_label
from shelfcast.operators.lookups import forecast_universe, sku_universe
from shelfcast.operators.segments import WindowedFacts
from shelfcast.operators.windows import assign_windows, disjoint
from shelfcast.plans.features import FEATURE_SETS, granularity


def training_universe(tables, windows):
    """Variants sold in each feature window."""
    if disjoint(windows):
        return sku_universe(assign_windows(tables.goodsale.select("data_date", "sku_id"), windows))
    return WindowedFacts.of(tables.goodsale.select("data_date", "sku_id"), windows).present("sku_id")


def training_set(tables, windows, feature_set, **options):
    """Features and week1..week5 of all windows in one plan, told apart by window_id."""
    build = FEATURE_SETS[feature_set]
    universe = training_universe(tables, windows)
    features = build(tables, windows, universe, **options)
    labels = weekly_label(tables.goodsale, windows, universe)
    return features.join(labels, ["window_id", "sku_id"])


def scoring_set(tables, window, feature_set, **options):
    """Features of the forecast window.

    The universe is the submission list; the granularity set takes the variants sold in the
    window and their goods_id from the first sale.
    """
    if feature_set == "granularity":
        universe = training_universe(tables, [window])
        return granularity(tables, [window], universe, goods_from_sales=True, **options)
    universe = forecast_universe(tables.submit_example, window.window_id)
    return FEATURE_SETS[feature_set](tables, [window], universe, **options)


def joint_set(tables, windows, test, feature_set, **options):
    """Training and scoring features from one pass over the facts, labels NULL for scoring."""
    universe = training_universe(tables, windows).unionByName(
        forecast_universe(tables.submit_example, test.window_id)
    )
    features = FEATURE_SETS[feature_set](tables, [*windows, test], universe, **options)
    labels = weekly_label(
        tables.goodsale, windows, universe.filter(F.col("window_id") != test.window_id)
    )
    return features.join(labels, ["window_id", "sku_id"], "left")


def feature_columns(df):
    """Model inputs: everything but the keys and the labels."""
    keys = {"window_id", "sku_id", "goods_id", "data_date", "goods_num", *WEEKS}
    return [c for c in df.columns if c not in keys]
