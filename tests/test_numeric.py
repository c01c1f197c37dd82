from support import rows

from shelfcast.functions import numeric as nm
from shelfcast.functions.prices import parse_price, parse_price_const
from shelfcast.plans.forecasts import share_of_total


def test_prices(spark):
    df = spark.createDataFrame(
        [(1, "1,332.00"), (2, "99.5"), (3, "x"), (4, None), (5, "12,345.60")], "id int, p string"
    )
    got = df.select("id", parse_price("p").alias("a"), parse_price_const("p").alias("b"))
    assert rows(got, "id") == [
        (1, 1332.0, 11.0),
        (2, 99.5, 99.5),
        (3, None, None),
        (4, None, None),
        (5, 12345.6, None),
    ]


def test_ratio_by_zero_is_null(spark):
    df = spark.createDataFrame([(1, 4.0, 2.0), (2, 4.0, 0.0)], "id int, a double, b double")
    assert rows(df.select("id", nm.ratio("a", "b").alias("r")), "id") == [(1, 2.0), (2, None)]


def test_clamp_modes(spark):
    df = spark.createDataFrame(
        [(1, -1.5), (2, 2.5), (3, 3.5), (4, None)], "id int, v double"
    )
    got = df.select("id", *[nm.clamp("v", m).alias(m) for m in ("keep_null", "zero_null", "round")])
    assert rows(got, "id") == [
        (1, 0.0, 0.0, 0.0),
        (2, 2.5, 2.5, 2.0),
        (3, 3.5, 3.5, 4.0),
        (4, None, 0.0, None),
    ]


def test_clamping_spares_the_key(spark):
    df = spark.createDataFrame([(-7, -1.0, 1.0, 1.0, 1.0, 1.0)], ["sku_id", *nm.WEEKS])
    assert rows(nm.clamp_weeks(df), "sku_id") == [(-7, 0.0, 1.0, 1.0, 1.0, 1.0)]


def test_reverse_weeks(spark):
    df = spark.createDataFrame([(7, 1.0, 2.0, 3.0, 4.0, 5.0)], ["sku_id", *nm.WEEKS])
    assert rows(nm.reverse_weeks(df), "sku_id") == [(7, 5.0, 4.0, 3.0, 2.0, 1.0)]


def test_minmax_over_both_sets(spark):
    train = spark.createDataFrame([(1, 2.0, 5.0), (2, 4.0, 5.0)], "id int, a double, b double")
    test = spark.createDataFrame([(3, 10.0, 5.0)], "id int, a double, b double")
    got = nm.minmax_scale(train, test, ["a", "b"]).select("id", "a", "b", "is_train")
    assert rows(got, "id") == [(1, 0.0, None, True), (2, 0.25, None, True), (3, 1.0, None, False)]


def test_fill_and_float(spark):
    df = spark.createDataFrame([(1, None), (2, 0.1)], "sku_id long, a double")
    assert rows(nm.fill_missing(df, -999), "sku_id") == [(1, -999.0), (2, 0.1)]
    assert dict(nm.fill_missing(df, 0, as_float=True).dtypes)["a"] == "float"


def test_rule_totals(spark, sales):
    targets = spark.createDataFrame([(11,), (21,), (99,)], "sku_id long")
    got = share_of_total(sales, targets, (20170301, 20170430))
    values = {r.sku_id: r for r in got.collect()}
    assert values[99].week1 is None
    sums = [sum(r[w] for r in values.values() if r[w] is not None) for w in nm.WEEKS]
    expected = [290000, 400000 * 1.02, 550000 * 1.02, 600000 * 1.12, 240000 * 1.04]
    assert all(abs(a - b) < 1e-6 for a, b in zip(sums, expected))
    assert abs(values[11].week1 / values[21].week1 - 16 / 7) < 1e-9
