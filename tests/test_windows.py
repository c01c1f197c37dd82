from support import rows
from pyspark.sql import functions as F

from shelfcast.functions import dates as d
from shelfcast.operators.labels import days_to_weeks, resum_weeks, weekly_label
from shelfcast.operators.lookups import first_per_key, sku_universe, skus_per_goods
from shelfcast.operators.windows import (
    DateIndex,
    WindowSpec,
    assign_windows,
    date_index,
    date_positions,
)

ONE = [WindowSpec(0, (20170301, 20170430), (20170515, 20170618))]


def test_date_arithmetic(spark):
    got = spark.range(1).select(
        d.weekday(F.lit(20170509)),
        d.weekday_name(F.lit(20170507)),
        d.add_days(F.lit(20170228), 1),
        d.distance(F.lit(20170401), F.lit(20170331)),
        d.distance(F.lit(20170401), F.lit(20170331), "int"),
    )
    assert tuple(got.first()) == (1, "week6", 20170301, 1, 70)
    assert d.shift(20161231, 1) == 20170101
    assert d.days_between(20170301, 20170303) == 3


def test_overlapping_windows_repeat_rows(sales):
    windows = [WindowSpec(1, (20170301, 20170331)), WindowSpec(2, (20170302, 20170405))]
    got = assign_windows(sales, windows).groupBy("window_id").count()
    assert rows(got, "window_id") == [(1, 5), (2, 6)]


def test_disjoint_windows_leave_gaps_out(sales):
    windows = [WindowSpec(1, (20170301, 20170301)), WindowSpec(2, (20170331, 20170405))]
    got = assign_windows(sales, windows).groupBy("window_id").count()
    assert rows(got, "window_id") == [(1, 1), (2, 4)]


def test_filter_reaches_the_scan(spark, sales, tmp_path):
    sales.write.parquet(str(tmp_path / "s"))
    tagged = assign_windows(spark.read.parquet(str(tmp_path / "s")), ONE)
    plan = tagged.select("sku_id")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(data_date,20170301)" in plan
    assert "goods_price" not in plan.split("ReadSchema")[1]


def test_spans_count_dates_that_occur(sales):
    index = date_index(assign_windows(sales, ONE), ONE)
    assert index.dates == {0: [20170301, 20170302, 20170331, 20170405]}
    tagged = assign_windows(sales, ONE)
    # The last two dates with sales, not the last two calendar days.
    assert tagged.filter(f"data_date >= {index.since(2)}").count() == 4
    # Fewer dates than the span: all rows.
    assert tagged.filter(f"data_date >= {index.since(27)}").count() == 7
    # Calendar span of i days covers i + 1 days.
    assert tagged.filter(f"data_date >= {index.since_days(5)}").count() == 4
    assert tagged.filter(f"data_date >= {index.since_days(4)}").count() == 2


def test_empty_index():
    index = DateIndex({})
    assert index.since(3) == "NULL"


def test_date_positions(sales):
    got = date_positions(assign_windows(sales, ONE)).drop("window_id")
    assert rows(got, "data_date") == [
        (20170301, 0, 4, 35),
        (20170302, 1, 3, 34),
        (20170331, 2, 2, 5),
        (20170405, 3, 1, 0),
    ]


def test_weekly_label_uses_seven_distinct_dates_and_stops_at_35(spark, sales):
    # 36 label dates; the last one must not count.
    label = WindowSpec(0, (20170301, 20170430), (20170501, 20170605))
    days = [d.shift(20170501, i) for i in range(36)]
    fact = sales.unionByName(
        spark.createDataFrame([(day, 1, 11, 1.0, 1.0) for day in days], sales.schema)
    )
    universe = sku_universe(assign_windows(sales, [label]))
    got = weekly_label(fact, [label], universe).drop("window_id")
    assert rows(got, "sku_id") == [
        (11, 7.0, 7.0, 7.0, 7.0, 7.0),
        (12, 0.0, 0.0, 0.0, 0.0, 0.0),
        (13, 0.0, 0.0, 0.0, 0.0, 0.0),
        (21, 0.0, 0.0, 0.0, 0.0, 0.0),
    ]


def test_short_label_range_leaves_weeks_zero(spark, sales):
    fact = spark.createDataFrame([(20170515, 1, 11, 3.0, 1.0)], sales.schema)
    universe = spark.createDataFrame([(0, 11)], "window_id int, sku_id long")
    assert rows(weekly_label(fact, ONE, universe), "sku_id") == [(0, 11, 3.0, 0.0, 0.0, 0.0, 0.0)]


def test_days_to_weeks_and_resum(spark):
    daily = spark.createDataFrame(
        [(1, 20180501, 1.0), (1, 20180507, 2.0), (1, 20180508, 4.0), (1, 20180605, 9.0)],
        "sku_id long, data_date int, goods_num double",
    )
    weeks = days_to_weeks(daily, 20180501)
    assert rows(weeks, "sku_id") == [(1, 3.0, 4.0, None, None, None)]
    assert rows(resum_weeks(weeks.unionByName(weeks)), "sku_id") == [
        (1, 6.0, 8.0, None, None, None)
    ]


def test_first_per_key_is_ordered_not_positional(spark):
    df = spark.createDataFrame(
        [(1, 20170303, 5), (1, 20170301, 7), (1, 20170301, 6), (2, 20170302, 1)],
        "goods_id long, data_date int, onsale_days int",
    )
    got = first_per_key(df, "goods_id", ["data_date"], ["data_date", "onsale_days"])
    assert rows(got, "goods_id") == [(1, 20170301, 6), (2, 20170302, 1)]


def test_skus_per_goods(sales):
    got = skus_per_goods(assign_windows(sales, ONE)).drop("window_id")
    assert rows(got, "goods_id") == [(1, 3), (2, 1)]
