import pytest
from pyspark.sql import functions as F
from support import rows

from shelfcast.operators import calendar as cal
from shelfcast.operators.windows import WindowSpec

DAYS = [WindowSpec(0, (20170301, 20170401), (20170515, 20170618))]


@pytest.fixture(scope="module")
def targets(spark):
    return spark.createDataFrame([(11,), (31,)], "sku_id long")


def test_skeleton_spans_35_days(targets, relation):
    got = cal.day_skeleton(targets, relation, DAYS)
    assert got.count() == 70
    assert rows(got.groupBy("sku_id", "goods_id").agg({"data_date": "max"}), "sku_id") == [
        (11, 1, 20170618),
        (31, 3, 20170618),
    ]


def test_label_days_sum_several_sales_and_fill_zero(spark, targets, relation, sales):
    fact = spark.createDataFrame(
        [(20170520, 1, 11, 2.0, 1.0), (20170520, 1, 11, 3.0, 1.0)], sales.schema
    )
    skus = targets.selectExpr("0 AS window_id", "sku_id")
    got = cal.label_days(skus, fact, DAYS)
    assert got.count() == 70
    assert rows(got.filter("goods_num > 0"), "sku_id") == [(0, 11, 20170520, 5.0)]


def test_calendar_columns_and_repeated_holidays(spark, targets, relation):
    holiday = spark.createDataFrame(
        [(20170516, 9), (20170516, 10), (20170517, 3)], "data_date int, holiday_code int"
    )
    plan = spark.createDataFrame([(20170515, 2, 5)], "data_date int, marketing int, plan int")
    weather = spark.createDataFrame(
        [(20170515, 60.0, 70.0, 50.0, 1.0, 9)],
        "data_date int, temp_mean double, temp_max double, temp_min double,"
        " uv_index_mean double, uv_index_max int",
    )
    skeleton = cal.day_skeleton(targets, relation, DAYS)
    got = cal.calendar_features(skeleton, DAYS, plan, holiday, weather)
    assert got.count() == 70
    first = got.filter("sku_id = 11").orderBy("data_date").limit(3)
    columns = ["week", "day_rank", "marketing", "holiday_code", "temp_max"]
    assert [tuple(r) for r in first.select(*columns).collect()] == [
        (0, 0, 2, None, 70.0),
        (1, 1, None, 9, None),
        (2, 2, None, 3, None),
    ]
    repeated = cal.calendar_features(skeleton, DAYS, holiday=holiday, dedupe=False)
    assert repeated.count() == 72


def test_a_repeated_date_keeps_one_whole_row(spark, targets, relation):
    plan = spark.createDataFrame(
        [(20170515, 1, 9), (20170515, 3, 2)], "data_date int, marketing int, plan int"
    )
    got = cal.calendar_features(cal.day_skeleton(targets, relation, DAYS), DAYS, plan)
    met = got.filter("data_date = 20170515").select("marketing", "plan").distinct()
    assert [tuple(r) for r in met.collect()] == [(1, 9)]


def test_label_days_are_literals(spark):
    """No date is computed per row; rows of no known window keep their days, without a date."""
    windows = [WindowSpec(0, (20170101, 20170131), (20170220, 20170326)), WindowSpec(1, (20170301, 20170331), (20171220, 20180123))]
    rows = spark.createDataFrame([(0, 11), (1, 11), (7, 12), (None, 13)], "window_id int, sku_id long")
    days = cal.explode_days(rows, windows)
    plan = days._jdf.queryExecution().optimizedPlan().toString()
    assert "lambda" not in plan and "date_add" not in plan
    got = days.groupBy("window_id").agg(F.count(F.lit(1)), F.min("data_date"), F.max("data_date"), F.count_distinct("data_date"))
    assert {tuple(r) for r in got.collect()} == {
        (0, 35, 20170220, 20170326, 35),
        (1, 35, 20171220, 20180123, 35),
        (7, 35, None, None, 0),
        (None, 35, None, None, 0),
    }
