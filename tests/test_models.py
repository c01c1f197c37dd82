import numpy as np
import pandas as pd
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import DecisionTreeRegressor
from pyspark.sql import functions as F

from shelfcast.catalog import queries
from shelfcast.functions.numeric import WEEKS
from shelfcast.plans import boosting, models
from shelfcast.plans.boosting import fit_boosted
from shelfcast.plans.linear import fit_linear
from shelfcast.plans.presets import PRESETS, Boosting

QUICK = Boosting(0.3, 3, 8)


@pytest.fixture(scope="module")
def table(spark):
    """Labels that depend on a and b, and a column that never matters."""
    df = spark.range(200).select(
        F.lit(0).alias("window_id"),
        F.col("id").alias("sku_id"),
        (F.col("id") % 10).cast("double").alias("a"),
        (F.col("id") % 7).cast("double").alias("b"),
        F.lit(1.0).alias("flat"),
    )
    return df.withColumns({w: F.expr(f"{k} + 2 * a - b") for k, w in enumerate(WEEKS)})


def test_least_squares_recovers_the_plane(table):
    got = models.linear_weeks(table, table, 0.0, "keep_null").toPandas()
    want = table.toPandas().set_index("sku_id").loc[got.sku_id]
    for w in WEEKS:
        np.testing.assert_allclose(got[w], np.maximum(want[w], 0), atol=1e-6)


def lstsq(pdf, columns, labels):
    """The solver's answer on centred inputs: smallest coefficients, intercepts."""
    x, y = pdf[columns].to_numpy(float), pdf[labels].to_numpy(float)
    slopes = np.linalg.lstsq(x - x.mean(0), y - y.mean(0), rcond=1e-9)[0]
    return slopes.T, y.mean(0) - x.mean(0) @ slopes


@pytest.mark.parametrize("parts", [1, 7])
def test_collinear_inputs_have_the_smallest_solution(spark, parts):
    rng = np.random.default_rng(parts)
    a, b, c = rng.normal(size=(3, 300))
    pdf = pd.DataFrame(
        {
            "a": a, "b": 1e6 + 1e3 * b, "copy": a, "twice": 2 * a, "sum": a + c, "c": c,
            "flat": 1e5, "tiny": 1e-6 * (b - a), "year": 2017.0 + (a > 0),
            "week1": 3 * a - b + rng.normal(size=300), "week2": c * 1e4, "week3": 7.0,
        }
    )
    columns = [k for k in pdf if not k.startswith("week")]
    labels = ["week1", "week2", "week3"]
    df = spark.createDataFrame(pdf).repartition(parts)
    got = fit_linear(df, columns, labels, 0.0)
    slopes, intercepts = lstsq(pdf, columns, labels)
    # The spreads of the inputs are nine orders of magnitude apart.
    np.testing.assert_allclose(got.coefficients, slopes, rtol=1e-6, atol=1e-7)
    np.testing.assert_allclose(got.intercepts, intercepts, rtol=1e-6, atol=1e-6)
    hats = got.predict(df.select(*columns), 0.0).toPandas()
    wanted = pdf[columns].to_numpy() @ slopes.T + intercepts
    np.testing.assert_allclose(np.sort(hats[labels], 0), np.sort(wanted, 0), rtol=1e-6, atol=1e-5)


def test_linear_fits_without_rows_or_spread(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0), (None, None)], "x double, week1 double")
    flat = fit_linear(df, ["x"], ["week1"], 1.0)
    assert flat.coefficients.tolist() == [[0.0]] and flat.intercepts.tolist() == [3.0]
    none = fit_linear(df.limit(0), ["x"], ["week1"], 0.0)
    assert none.coefficients.tolist() == [[0.0]] and none.intercepts.tolist() == [0.0]


def test_boosted_trees_beat_the_mean(table):
    got = models.boosted_weeks(table, table, QUICK, labels=("week5",)).toPandas()
    want = table.toPandas().set_index("sku_id").loc[got.sku_id].week5.to_numpy()
    assert ((got.week5 - want) ** 2).mean() < 0.5 * want.var()
    assert got.week5.min() >= 0


def test_selection_keeps_what_matters(table):
    wide = table.withColumn("again", F.col("a"))
    model = fit_boosted(wide, ["flat", "a", "again", "b"], [["week1"]], QUICK)
    assert [c for c, _ in model.importances()] == ["a", "b"]
    kept = models.fit_selected(wide, ["flat", "b", "again", "a"], ["week1"], QUICK, -999.0)
    assert kept == ["b", "again"]
    assert models.fit_selected(wide, ["flat"], ["week1"], QUICK, -999.0) == ["flat"]


@pytest.fixture(scope="module")
def noisy():
    rng = np.random.default_rng(6)
    pdf = pd.DataFrame({c: rng.integers(0, 9, 240).astype(float) for c in "abc"})
    for k, w in enumerate(("week1", "week2", "week3")):
        pdf[w] = pdf.a * (k + 1) - (pdf.b > 4) * 7 + pdf.c * pdf.b / 5 + rng.normal(size=240)
    return pdf


def test_a_tree_of_limited_depth_equals_the_one_of_spark(spark, noisy):
    df = spark.createDataFrame(noisy)
    model = fit_boosted(df, list("abc"), [["week1"]], Boosting(1.0, 3, 1, min_child=5))
    vectors = VectorAssembler(inputCols=list("abc"), outputCol="x").transform(df)
    tree = DecisionTreeRegressor(
        featuresCol="x", labelCol="week1", maxDepth=3, minInstancesPerNode=5, maxBins=64
    ).fit(vectors)
    want = tree.transform(vectors).select("a", "b", "c", "prediction").toPandas()
    got = model.predict(df, list("abc"), -999.0).toPandas()
    order = ["a", "b", "c"]
    np.testing.assert_allclose(
        got.sort_values(order).week1, want.sort_values(order).prediction, rtol=1e-9
    )


def brute_boosting(pdf, columns, labels, params):
    """Best-first trees by trying every cut of every leaf, one split after the other."""
    x, y = pdf[columns].to_numpy(), pdf[labels].to_numpy()
    hat = np.tile(y.mean(0), (len(y), 1))

    def worth(rows):
        sums = (y - hat)[rows].sum(0)
        return (np.maximum(np.abs(sums) - params.l1, 0) ** 2).sum() / (len(rows) + params.l2)

    sizes = []
    for _ in range(params.rounds):
        leaves = [(np.arange(len(x)), 0)]
        while len(leaves) < (params.leaves or 1 << params.depth):
            tries = []
            for k, (rows, depth) in enumerate(leaves):
                for f in range(len(columns)) if depth < params.depth else ():
                    for cut in np.unique(x[rows, f])[:-1]:
                        left, right = rows[x[rows, f] <= cut], rows[x[rows, f] > cut]
                        if min(len(left), len(right)) >= params.min_child:
                            gain = worth(left) + worth(right) - worth(rows)
                            tries.append((round(gain, 9), -f, -cut, k, left, right))
            best = max(tries, key=lambda t: t[:3], default=None)
            if best is None or best[0] <= 2 * params.gamma:
                break
            k = best[3]
            depth = leaves[k][1] + 1
            leaves[k : k + 1] = [(best[4], depth), (best[5], depth)]
        step = np.zeros_like(hat)
        for rows, _ in leaves:
            sums = (y - hat)[rows].sum(0)
            step[rows] = np.sign(sums) * np.maximum(np.abs(sums) - params.l1, 0) / (len(rows) + params.l2)
        hat = hat + params.rate * step
        sizes.append(len(leaves))
    return hat, sizes


@pytest.mark.parametrize(
    "params",
    [
        Boosting(0.3, 4, 3, leaves=6, min_child=8, l1=2.0, l2=3.0),
        Boosting(0.5, 9, 2, leaves=7, min_child=3, gamma=1.0),
        Boosting(0.2, 2, 18, l2=1.0),
    ],
)
@pytest.mark.parametrize("labels", [["week1"], ["week1", "week2", "week3"]])
def test_leaves_and_shrinkage_equal_trying_every_split(spark, noisy, params, labels):
    """Also with vector-valued leaves, and across a rewriting of the forecasts."""
    columns = list("abc")
    df = spark.createDataFrame(noisy).repartition(3)
    model = fit_boosted(df, columns, [labels], params)
    want, sizes = brute_boosting(noisy, columns, labels, params)
    assert [t.feature.count(-1) for t in model.trees[0]] == sizes
    got = model.predict(df, [*columns], -999.0).toPandas()
    brute = noisy[columns].assign(**dict(zip(labels, want.T)))
    for w in labels:
        np.testing.assert_allclose(
            got.sort_values([*columns, w])[w], brute.sort_values([*columns, w])[w], rtol=1e-7
        )


def test_groups_do_not_depend_on_each_other(spark, noisy):
    params = Boosting(0.3, 3, 2, row_share=0.7, column_share=0.99)
    df = spark.createDataFrame(noisy)
    both = fit_boosted(df, list("abc"), [["week1"], ["week2"]], params)
    one = fit_boosted(df.limit(0), list("abc"), [["week1"]], params)
    assert one.predict(df, ["a"], 0.0).select("week1").distinct().collect() == [(0.0,)]
    assert [len(t) for t in both.trees] == [2, 2]
    sample = both.trees[0][0].value
    assert sample.shape[1] == 1 and np.isfinite(sample).all()


def test_day_forecast_adds_up_to_weeks(spark):
    days = spark.sql(
        "SELECT sku_id, 20180501 + k AS data_date, double(sku_id) AS x, double(sku_id) AS goods_num"
        " FROM (SELECT explode(sequence(1, 3)) AS sku_id) CROSS JOIN"
        " (SELECT explode(sequence(0, 13)) AS k)"
    )
    got = models.linear_days(days, days, ["x"], 20180501)
    for row in got.collect():
        assert row.week1 == pytest.approx(7 * row.sku_id)
        assert row.week3 is None


def test_presets_are_complete():
    for preset in PRESETS.values():
        if preset.model.startswith(("boosted", "day_b", "day_s", "multi")):
            assert preset.boosting is not None
        if preset.pairs and not preset.model.startswith("day"):
            windows, test = preset.windows()
            assert len(windows) == len(preset.pairs) and test.label is None


def test_the_week_forecast_grows_all_published_trees(monkeypatch):
    published = PRESETS["boosted_sales_only"].boosting
    used = []
    monkeypatch.setattr(queries, "_joint", lambda *_: (None, None))
    monkeypatch.setattr(models, "boosted_weeks", lambda train, test, boosting: used.append(boosting))
    queries.gbt_week_forecast(None, None)
    assert used == [published]
    assert (published.rounds, published.leaves, published.depth) == (2500, 127, 7)


@pytest.mark.parametrize("share", [1.0, 0.7])
def test_trees_of_a_task_equal_those_of_passes(spark, noisy, monkeypatch, share):
    """Thousands of trees over a small table need no job each."""
    params = Boosting(0.3, 4, 18, leaves=6, min_child=4, l1=0.5, row_share=share, column_share=share)
    df = spark.createDataFrame(noisy).repartition(3)
    groups = [["week1", "week2"], ["week3"]]
    passes = []
    real = boosting._histograms
    monkeypatch.setattr(boosting, "_histograms", lambda *a: passes.append(1) or real(*a))
    held = fit_boosted(df, list("abc"), groups, params)
    assert not passes
    monkeypatch.setattr(boosting, "HELD_BYTES", 0)
    passed = fit_boosted(df, list("abc"), groups, params)
    assert len(passes) >= 18
    for one, other in zip(held.trees, passed.trees):
        assert len(one) == len(other) == 18
        for a, b in zip(one, other):
            assert (a.feature, a.cut, a.left, a.right) == (b.feature, b.cut, b.left, b.right)
            np.testing.assert_allclose(a.value, b.value, rtol=1e-9, atol=1e-12)
    np.testing.assert_allclose(held.gains, passed.gains, rtol=1e-9)
    assert held.predict(df.limit(0), ["a"], 0.0).count() == 0
