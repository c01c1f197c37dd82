"""Day skeletons (variant x day) and calendar columns."""

from functools import reduce

from pyspark.sql import functions as F

from shelfcast.functions.dates import parse, shift, to_day, weekday
from shelfcast.operators.windows import assign_windows, date_range, small_calendar
from shelfcast.sources.schemas import WEATHER_COLUMNS

SKELETON_DAYS = 35


def _label_start(windows):
    """First label day of the row's window, as a DATE."""
    return F.coalesce(
        *[
            F.when(F.col("window_id") == w.window_id, F.lit(parse(w.label[0])))
            for w in windows
        ]
    )


def explode_days(rows, windows, days=SKELETON_DAYS):
    """Repeat each row of a window for `days` days from the window's label start.

    The days are literal arrays, generated inside the row: nothing is computed per row, joined or
    shuffled.
    """
    dates = None
    for w in windows:
        labels = F.lit([shift(w.label[0], i) for i in range(days)]).cast("array<int>")
        here = F.col("window_id") == w.window_id
        dates = F.when(here, labels) if dates is None else dates.when(here, labels)
    unknown = F.array_repeat(F.lit(None).cast("int"), days)
    return rows.withColumn("data_date", F.explode(dates.otherwise(unknown)))


def day_skeleton(targets, relation, windows, days=SKELETON_DAYS):
    """One row per (window, variant, label day) with the variant's goods_id."""
    base = targets.select("sku_id").join(relation.select("sku_id", "goods_id"), "sku_id", "left")
    tagged = base.withColumn(
        "window_id", F.explode(F.array(*[F.lit(w.window_id) for w in windows]))
    )
    return explode_days(tagged, windows, days).select(
        "window_id", "sku_id", "goods_id", "data_date"
    )


def daily_sales(goodsale, windows, part="label"):
    """Units per (window, variant) as a map from date to units; one entry per day at most."""
    tagged = assign_windows(goodsale.select("data_date", "sku_id", "goods_num"), windows, part)
    daily = tagged.groupBy("window_id", "sku_id", "data_date").agg(
        F.sum("goods_num").cast("double").alias("units")
    )
    return daily.groupBy("window_id", "sku_id").agg(
        F.map_from_entries(F.collect_list(F.struct("data_date", "units"))).alias("units_by_day")
    )


def label_days(rows, goodsale, windows, days=SKELETON_DAYS):
    """Explode rows at variant grain to label days with their units sold (0 without sales).

    Labels join before the explosion, so the shuffle moves one row per variant, not one per day.
    """
    labelled = rows.join(daily_sales(goodsale, windows), ["window_id", "sku_id"], "left")
    by_day = F.try_element_at("units_by_day", F.col("data_date"))
    return (
        explode_days(labelled, windows, days)
        .withColumn("goods_num", F.coalesce(by_day, F.lit(0.0)))
        .drop("units_by_day")
    )


def one_per_date(holiday):
    """Keep the smallest code where a date is listed twice."""
    return holiday.groupBy("data_date").agg(F.min("holiday_code").alias("holiday_code"))


def calendar_features(rows, windows, marketing=None, holiday=None, weather=None, dedupe=True):
    """Weekday, day index, marketing plan, holiday code and weather of each row's date.

    Calendars are cut to the label range and to one row per date (the smallest one) before their
    broadcast.
    dedupe=False keeps repeated holiday dates, which repeats the rows of those dates.
    """
    result = rows.withColumns(
        {
            "week": weekday("data_date"),
            "day_rank": F.datediff(to_day("data_date"), _label_start(windows)),
        }
    )
    lo = min(w.label[0] for w in windows)
    hi = max(shift(w.label[0], SKELETON_DAYS - 1) for w in windows)
    plan = None if marketing is None else marketing.select("data_date", "marketing", "plan")
    measured = None if weather is None else weather.select("data_date", *WEATHER_COLUMNS)
    if holiday is None or dedupe:
        single = None if holiday is None else one_per_date(holiday)
        return _join_calendars(result, [plan, single, measured], lo, hi, windows)
    result = _join_calendars(result, [plan], lo, hi, windows)
    result = result.join(
        date_range(holiday.select("data_date", "holiday_code"), lo, hi), "data_date", "left"
    )
    return _join_calendars(result, [measured], lo, hi, windows)


def _first_per_date(calendar):
    """One row per date of any calendar: of several, the smallest as a whole."""
    others = [c for c in calendar.columns if c != "data_date"]
    first = calendar.groupBy("data_date").agg(F.min(F.struct(*others)).alias("first"))
    return first.select("data_date", "first.*")


def _join_calendars(rows, calendars, lo, hi, windows):
    # One row per date, so that the days of the windows bound what is broadcast. Rows of any number meet
    # all calendars in one join.
    cuts = [_first_per_date(date_range(c, lo, hi)) for c in calendars if c is not None]
    if not cuts:
        return rows
    whole = reduce(lambda a, b: a.join(b, "data_date", "full"), cuts)
    return rows.join(small_calendar(whole, windows, "label"), "data_date", "left")
