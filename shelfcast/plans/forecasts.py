"""Whole forecasts: from the model tables to sku_id, week1..week5."""

from dataclasses import replace

from pyspark.sql import functions as F

from shelfcast.functions.numeric import WEEKS, clamp_weeks, ratio, reverse_weeks
from shelfcast.operators.labels import resum_weeks
from shelfcast.operators.windows import WindowSpec, date_range
from shelfcast.plans import models
from shelfcast.plans import presets as p
from shelfcast.plans.features import DAY_INPUTS, day_level
from shelfcast.plans.training import joint_set, scoring_set, training_set
from shelfcast.sources.tables import prune_months, target_skus


def window_units(goodsale, lo, hi):
    """Units sold per variant between two dates."""
    sold = date_range(goodsale.select("data_date", "sku_id", "goods_num"), lo, hi)
    return sold.groupBy("sku_id").agg(F.sum("goods_num").cast("double").alias("sale_num"))


def share_of_total(
    goodsale, targets, span=p.RULE_RANGE, totals=p.RULE_TOTALS, factors=p.RULE_FACTORS
):
    """Split fixed weekly totals by each target variant's share of recent sales.

    Unsold targets stay NULL and do not count in the sum, which is read as a scalar subquery.
    """
    sold = targets.select("sku_id").join(window_units(goodsale, *span), "sku_id", "left")
    everything = sold.agg(F.sum("sale_num")).scalar()
    shared = sold.withColumn("share", ratio(F.col("sale_num"), everything))
    return shared.select(
        "sku_id",
        *[
            (F.lit(total) * factor * F.col("share")).alias(week)
            for week, total, factor in zip(WEEKS, totals, factors)
        ],
    )


def assemble_forecast(targets, forecast):
    """The target list with its weeks; targets without a forecast stay NULL."""
    return targets.select("sku_id").join(forecast.select("sku_id", *WEEKS), "sku_id", "left")


def day_forecast(tables, preset):
    """Fit on the label days of the training windows, score the forecast days, add up weeks."""
    windows, _ = p.numbered_windows(preset.pairs, preset.test[0])
    test = WindowSpec(p.TEST_WINDOW, *preset.test)
    targets = target_skus(tables.submit_example)
    days = day_level(tables, [*windows, test], targets)
    train = days.filter(F.col("window_id") != p.TEST_WINDOW)
    future = days.filter(F.col("window_id") == p.TEST_WINDOW)
    columns = [c for c in DAY_INPUTS if c in days.columns]
    if preset.boosting is None:
        weeks = models.linear_days(train, future, columns, test.label[0])
    else:
        select = preset.model == "day_selected"
        weeks = models.boosted_days(
            train, future, preset.boosting, columns, test.label[0], select=select
        )
    return weeks if preset.clamp == "none" else clamp_weeks(weeks, preset.clamp)


def week_forecast(tables, preset):
    """Fit one model per week on the training windows and score the forecast window."""
    windows, test = preset.windows()
    if preset.feature_set == "granularity":
        train = training_set(tables, windows, preset.feature_set, **preset.options)
        future = scoring_set(tables, test, preset.feature_set, **preset.options)
    else:
        joint = joint_set(tables, windows, test, preset.feature_set, **preset.options)
        train = joint.filter(F.col("window_id") != test.window_id)
        future = joint.filter(F.col("window_id") == test.window_id)
    if preset.model == "ols":
        forecast = models.linear_weeks(train, future, 0.0, preset.clamp)
    else:
        shared = preset.model == "multi_output"
        forecast = models.boosted_weeks(
            train, future, preset.boosting, -999.0, preset.clamp, shared=shared
        )
    if preset.model == "multi_output":
        forecast = resum_weeks(forecast)
    return forecast


def date_ranges(preset):
    """All date ranges of the facts that a preset reads."""
    if preset.model == "rule":
        return [p.RULE_RANGE]
    if preset.model.startswith("day"):
        return [r for pair in (*preset.pairs, preset.test) for r in pair]
    return [r for pair in preset.pairs for r in pair] + [preset.test]


def run_preset(tables, name, rounds=None, reverse=None):
    """Forecast of one preset; `rounds` overrides the number of boosting rounds.

    `reverse` swaps the weeks end to end; by default the preset decides. Tables from files are to be
    read with the preset's price mode.
    """
    preset = p.PRESETS[name]
    reverse = preset.reverse if reverse is None else reverse
    if rounds and preset.boosting:
        preset = replace(preset, boosting=replace(preset.boosting, rounds=rounds))
    tables = prune_months(tables, date_ranges(preset))
    targets = target_skus(tables.submit_example)
    if preset.model == "rule":
        forecast = share_of_total(tables.goodsale, targets)
    elif preset.model.startswith("day"):
        forecast = day_forecast(tables, preset)
    else:
        forecast = week_forecast(tables, preset)
    whole = assemble_forecast(targets, forecast)
    return reverse_weeks(whole) if reverse else whole
