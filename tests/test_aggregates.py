import numpy as np
import pandas as pd
import pytest
from support import rows
from pyspark.sql import functions as F

from shelfcast.operators import ordered, ranks, segments, spans
from shelfcast.operators import statistics as st
from shelfcast.operators.ordered import exact_medians, running_counts
from shelfcast.operators.ranks import RankSpec, fuse_ranks, rank_columns
from shelfcast.operators.segments import Segments, WindowedFacts
from shelfcast.operators.spans import Measure, span_stats
from shelfcast.operators.windows import WindowSpec, assign_windows, date_index

TWO = [WindowSpec(0, (20170101, 20170228)), WindowSpec(1, (20170201, 20170331))]
KEYS = ["window_id", "sku_id"]


@pytest.fixture(scope="module")
def skewed(spark):
    """600 sales in two overlapping windows; variant 1 owns about a third of them."""
    rng = np.random.default_rng(5)
    days = [int(x.strftime("%Y%m%d")) for x in pd.date_range("2017-01-01", "2017-03-31")]
    sku = np.where(rng.random(600) < 0.34, 1, rng.integers(2, 30, 600))
    pdf = pd.DataFrame(
        {
            "data_date": rng.choice(days, 600),
            "goods_id": sku // 4,
            "sku_id": sku,
            "goods_num": rng.integers(1, 9, 600).astype(float),
            "goods_price": np.round(rng.random(600) * 1e6, 2) + 1e6,
        }
    )
    return spark.createDataFrame(pdf), pdf


def naive(pdf, spans, column, stats):
    """Filter and group once per window and span."""
    parts = []
    for w in TWO:
        part = pdf[pdf.data_date.between(*w.feature)]
        dates = sorted(set(part.data_date))
        wide = pd.DataFrame({"sku_id": sorted(set(part.sku_id))})
        for i in spans:
            cut = part[part.data_date >= dates[-i]]
            agg = cut.groupby("sku_id")[column].agg(list(stats)).reset_index()
            agg.columns = ["sku_id", *[f"{column}_{s}_slide_{i}" for s in stats]]
            wide = wide.merge(agg, on="sku_id", how="left")
        wide["window_id"] = w.window_id
        parts.append(wide)
    return pd.concat(parts).sort_values(KEYS).reset_index(drop=True)


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_one_pass_spans_equal_filtering_per_span(skewed, monkeypatch, limit):
    monkeypatch.setattr(ordered, "MAX_GROUP_ROWS", limit)
    df, pdf = skewed
    stats = ("max", "min", "mean", "median", "sum", "count", "var", "std")
    tagged = assign_windows(df, TWO)
    for column in ("goods_num", "goods_price"):
        measures = [Measure(column, stats, (3, 14, 40))]
        got = span_stats(tagged, KEYS, measures, date_index(tagged, TWO).since).toPandas()
        want = naive(pdf, (3, 14, 40), column, stats)
        got = got.sort_values(KEYS).reset_index(drop=True)[want.columns]
        pd.testing.assert_frame_equal(
            got.astype(float), want.astype(float), rtol=1e-9, check_dtype=False
        )


def test_segments_of_overlapping_windows_equal_filtering_per_span(skewed):
    df, pdf = skewed
    stats = ("max", "min", "mean", "median", "sum", "count", "var", "std")
    for column in ("goods_num", "goods_price"):
        got = WindowedFacts.of(df, TWO).stats("sku_id", [Measure(column, stats, (3, 14, 40))])
        want = naive(pdf, (3, 14, 40), column, stats)
        got = got.toPandas().sort_values(KEYS).reset_index(drop=True)[want.columns]
        pd.testing.assert_frame_equal(
            got.astype(float), want.astype(float), rtol=1e-9, check_dtype=False
        )
    present = WindowedFacts.of(df, TWO).present("sku_id")
    wanted = {(w.window_id, k) for w in TWO for k in pdf[pdf.data_date.between(*w.feature)].sku_id}
    assert set(rows(present, "window_id")) == wanted and present.count() == len(wanted)


def test_ranges_are_unions_of_dyadic_nodes():
    bounds = {k: (1 + k, [17 - k, 9 + k], 20 + k) for k in range(6)}
    cuts = Segments(bounds)
    held = {}
    for (level, node), users in cuts.cover().items():
        for user in users:
            held.setdefault(user, []).extend(range(node << level, (node + 1) << level))
    for window_id, band, start, end in cuts.ranges():
        assert sorted(held.pop((window_id, band))) == list(range(start, end + 1))
    assert not held


def test_windows_do_not_multiply_the_rows_of_the_scan(skewed):
    """What leaves the first aggregate grows with keys and segments, not with windows."""
    df, _ = skewed
    many = [WindowSpec(k, (20170101 + k, 20170320)) for k in range(12)]
    plan = WindowedFacts.of(df, many).stats("sku_id", [Measure("goods_num", total=("sum",))])
    text = plan._jdf.queryExecution().optimizedPlan().toString()
    assert "Generate" in text
    for line in text[text.rindex("Generate") :].splitlines()[1:]:
        if "Aggregate" in line:
            break
    else:
        raise AssertionError("rows are repeated before they are aggregated")


def test_missing_values_and_singletons(spark):
    df = spark.createDataFrame(
        [(0, 1, 20170101, None), (0, 2, 20170101, 3.0), (0, 2, 20170102, None)],
        "window_id int, sku_id long, data_date int, v double",
    )
    total = ("sum", "mean", "count", "rows", "var", "first", "median")
    got = span_stats(df, KEYS, [Measure("v", total=total)]).drop("window_id")
    # A group of missing values sums to 0; a single value has no variance.
    assert rows(got, "sku_id") == [
        (1, 0.0, None, 0, 1, None, None, None),
        (2, 3.0, 3.0, 1, 2, None, 3.0, 3.0),
    ]


def test_calendar_granularities(skewed):
    df, pdf = skewed
    tagged = assign_windows(df, TWO)
    measures = [Measure("goods_num", ("sum",), (7, 1), span_name="{column}_{stat}{span}")]
    got = span_stats(tagged, KEYS, measures, date_index(tagged, TWO).since_days)
    for w in TWO:
        part = pdf[pdf.data_date.between(*w.feature)]
        day = pd.to_datetime(part.data_date.astype(str))
        for i in (7, 1):
            want = part[day >= day.max() - pd.Timedelta(days=i)].goods_num.sum()
            have = got.filter(f"window_id = {w.window_id}").agg(F.sum(f"goods_num_sum{i}"))
            assert have.first()[0] == want


def test_sliced_running_counts_equal_plain_windows(spark):
    rng = np.random.default_rng(3)
    pdf = pd.DataFrame({"g": np.where(rng.random(4000) < 0.5, 0, rng.integers(1, 40, 4000)),
                        "v": rng.integers(0, 100000, 4000)})
    pdf = pdf.drop_duplicates()
    pdf["n"], pdf["m"] = rng.integers(1, 5, len(pdf)), rng.integers(0, 3, len(pdf))
    counts = spark.createDataFrame(pdf)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sliced = running_counts(counts, ["g"], ["v"], ["n", "m"], sliced=True).toPandas()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    whole = running_counts(counts, ["g"], ["v"], ["n", "m"], sliced=False).toPandas()
    order = ["g", "v"]
    pd.testing.assert_frame_equal(
        sliced.sort_values(order).reset_index(drop=True),
        whole.sort_values(order).reset_index(drop=True),
    )


def test_exact_medians(spark):
    counts = spark.createDataFrame(
        [(1, 1.0, 1), (1, 2.0, 1), (2, 5.0, 3), (2, 9.0, 2), (3, 1.0, 0)], "k int, value double, n int"
    )
    for sliced in (False, True):
        got = exact_medians(counts, ["k"], ["n"], sliced)
        assert rows(got, "k") == [(1, 1.5), (2, 5.0)]


@pytest.mark.parametrize("limit", [1_000_000, 0])
def test_ranks_match_definition(spark, monkeypatch, limit):
    monkeypatch.setattr(ordered, "MAX_GROUP_ROWS", limit)
    rng = np.random.default_rng(9)
    pdf = pd.DataFrame(
        {
            "window_id": np.repeat([0, 1], 150),
            "sku_id": np.tile(np.arange(150), 2),
            "goods_id": rng.integers(0, 6, 300).astype(float),
            "v": rng.integers(0, 12, 300).astype(float),
        }
    )
    pdf.loc[rng.random(300) < 0.3, "v"] = np.nan
    pdf.loc[:3, "goods_id"] = np.nan
    df = spark.createDataFrame(pdf).selectExpr(
        "window_id", "sku_id", "cast(nullif(goods_id, double('NaN')) as long) goods_id",
        "nullif(v, double('NaN')) v",
    )
    specs = [
        RankSpec("v", "average"),
        RankSpec("v", "filled_up", "min", True, None, -999.0),
        RankSpec("v", "filled_down", "min", False, None, 0.0),
        RankSpec("v", "inside", "min", False, "goods_id", -999.0),
    ]
    got = rank_columns(df, specs).toPandas().sort_values(KEYS).reset_index(drop=True)
    by = pdf.groupby("window_id")
    want = {
        "average": by.v.rank(),
        "filled_up": pdf.fillna({"v": -999}).groupby("window_id").v.rank(method="min"),
        "filled_down": pdf.fillna({"v": 0}).groupby("window_id").v.rank(
            method="min", ascending=False
        ),
        "inside": pdf.fillna({"v": -999})
        .groupby(["window_id", "goods_id"])
        .v.rank(method="min", ascending=False),
    }
    for name, series in want.items():
        np.testing.assert_array_equal(got[name].to_numpy(float), series.to_numpy(float), name)


def test_ranks_where_half_of_all_rows_are_tied(spark, monkeypatch):
    monkeypatch.setattr(ranks, "HOT_VALUES", 8)
    rng = np.random.default_rng(4)
    value = np.where(rng.random(3000) < 0.5, 5.0, rng.integers(0, 900, 3000))
    pdf = pd.DataFrame({"window_id": 0, "sku_id": np.arange(3000), "v": value.astype(float)})
    specs = [RankSpec("v", "average"), RankSpec("v", "falling", "min", False)]
    ranked = rank_columns(spark.createDataFrame(pdf), specs, by_value=True)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "strategy=broadcast" in plan
    got = ranked.toPandas().sort_values("sku_id")
    np.testing.assert_array_equal(got.average, pdf.v.rank())
    np.testing.assert_array_equal(got.falling, pdf.v.rank(method="min", ascending=False))


def test_ranks_of_few_values_move_no_rows(spark):
    """Series with few values are looked up in place; gaps, NaN and rows without key as in a join."""
    rows = [(k % 2, k, float(k % 5) if k % 3 else None, float(k)) for k in range(60)]
    rows += [(0, 60, float("nan"), 1.0), (0, 61, float("nan"), 2.0), (0, None, 3.0, 5.0), (None, 62, 2.0, 1.0)]
    df = spark.createDataFrame(rows, "window_id int, sku_id long, v double, w double").coalesce(3)
    specs = [
        RankSpec("v", "average"),
        RankSpec("v", "falling", "min", False),
        RankSpec("v", "filled", "min", True, None, 0.5),
        RankSpec("w", "other"),
    ]
    ranked = rank_columns(df, specs, by_value=True)
    plan = ranked.drop("filled")._jdf.queryExecution().optimizedPlan().toString()
    assert "MapInArrow" in plan and "Generate" not in plan and "Aggregate" not in plan.split("MapInArrow")[0]
    want = rank_columns(df, specs, by_value=False)
    got, rows = (r.where("sku_id IS NOT NULL") for r in (ranked, want))
    assert got.columns == rows.columns and got.exceptAll(rows).count() == rows.exceptAll(got).count() == 0
    assert [*ranked.where("sku_id IS NULL").select("average", "falling", "other").first()] == [None] * 3


def test_rank_fusion(spark):
    scores = spark.createDataFrame(
        [(1, 1, 0.1, 0.9), (1, 2, 0.5, 0.5), (1, 3, 0.9, 0.1), (2, 4, 1.0, 1.0)],
        "goods_id long, sku_id long, a double, b double",
    )
    got = fuse_ranks(scores, "goods_id", "sku_id", "a", "b").select("sku_id", "fused_rank")
    # 1 and 3 fuse to the same score; the key breaks the tie.
    assert rows(got, "sku_id") == [(1, 1), (2, 3), (3, 2), (4, 1)]


def test_missing_scores_take_no_place(spark):
    scores = spark.createDataFrame(
        [(1, 1, 0.1, 0.9), (1, 2, None, 0.5), (1, 3, 0.9, 0.1), (1, 4, None, None)],
        "goods_id long, sku_id long, a double, b double",
    )
    got = fuse_ranks(scores, "goods_id", "sku_id", "a", "b").select("sku_id", "fused_rank")
    assert rows(got, "sku_id") == [(1, 2), (2, None), (3, 1), (4, None)]


def test_moments_are_population_and_null_without_spread(spark):
    values = [1.0, 2.0, 2.0, 9.0]
    data = [(0, 1, 1, v) for v in values] + [(0, 1, 2, 4.0), (0, 1, 2, 4.0)]
    df = spark.createDataFrame(data, "window_id int, goods_id long, sku_id long, goods_num double")
    _, by_sku, _ = st.quantity_by_key(st.value_counts(df), st.history_name)
    got = {r.sku_id: r for r in by_sku.collect()}
    x = np.array(values) - np.mean(values)
    assert got[1].s12 == pytest.approx((x**3).mean() / (x**2).mean() ** 1.5)
    assert got[1].s15 == pytest.approx((x**4).mean() / (x**2).mean() ** 2 - 3)
    assert got[1].s27 == 2.0
    assert got[2].s12 is None and got[2].s15 is None and got[2].s18 == 0.0


def test_column_numbering():
    names = [st.history_name(s, i) for s in st.FULL_ORDER for i in range(3)]
    assert sorted(names, key=lambda n: int(n[1:])) == [
        f"s{i}" for i in [*range(1, 7), *range(11, 29)]
    ]
    assert st.last_week_name("median", 2) == "sw_24"


def test_nth_largest_days(spark):
    df = spark.createDataFrame(
        [(0, 1, 20170101, 2.0), (0, 1, 20170101, 3.0), (0, 1, 20170102, 4.0)],
        "window_id int, sku_id long, data_date int, goods_num double",
    )
    assert rows(st.nth_largest_days(df, (1, 2, 3)), "sku_id") == [(0, 1, 5.0, 4.0, -999.0)]


@pytest.mark.parametrize("limit", [1_000_000, 2])
def test_quantities_at_three_keys_are_ordered_once(spark, monkeypatch, limit):
    monkeypatch.setattr(ordered, "MAX_GROUP_ROWS", limit)
    values = [1.0, 1.0, 2.0, 5.0, 5.0, 9.0, 4.0, None]
    rows_in = [(w, g, 10 * g + k % 3, v) for w in (0, 1) for g in (1, 2) for k, v in enumerate(values[: 6 + g])]
    rows_in += [(0, None, 31, 3.0), (0, 4, None, 6.0), (1, 5, 51, 7.0), (1, 5, 51, None)]
    names = ["window_id", "goods_id", "sku_id", "goods_num"]
    pdf = pd.DataFrame(rows_in, columns=names)
    df = spark.createDataFrame(rows_in, "window_id int, goods_id long, sku_id long, goods_num double")
    blocks = st.quantity_by_key(st.value_counts(df.repartition(3)), lambda stat, key: stat)
    for key, block in zip(st.THREE_KEYS, blocks):
        keys = ["window_id", *key]
        got = block.toPandas().set_index(keys).sort_index()
        groups = pdf.dropna(subset=["goods_num", *key]).groupby(keys)["goods_num"]
        want = groups.agg(["sum", "mean", "std", "max", "min", "median"]).sort_index()
        pd.testing.assert_frame_equal(got[list(want)], want, check_index_type=False)
        away = groups.apply(lambda x: ((x - x.mean()) ** 3).mean() / ((x - x.mean()) ** 2).mean() ** 1.5)
        np.testing.assert_allclose(got["skew"].astype(float), away.sort_index().astype(float))
        if limit > 2:
            plan = block._jdf.queryExecution().executedPlan().toString()
            plan = plan.split("== Initial Plan")[0]
            assert plan.count("Exchange") <= 2 and "Join" not in plan


@pytest.mark.parametrize("windows", [TWO, TWO[:1]])
def test_medians_of_one_column_share_an_ordered_step(skewed, monkeypatch, windows):
    steps = []

    def counting(counts, group, names, *rest):
        steps.append(list(names))
        return exact_medians(counts, group, names, *rest)

    for module in (segments, spans):
        monkeypatch.setattr(module, "exact_medians", counting)
    measures = [
        Measure("goods_num", ("median",), (3, 14)),
        Measure("goods_num", total=("median", "count"), total_name="whole_{stat}"),
    ]
    facts = WindowedFacts.of(skewed[0], windows)
    got = facts.stats("sku_id", measures).toPandas().set_index(["window_id", "sku_id"]).sort_index()
    assert len(steps) == 1
    want = facts.tagged().toPandas().groupby(["window_id", "sku_id"])["goods_num"].median()
    np.testing.assert_allclose(got["whole_median"], want.sort_index())
