"""What the physical plans must and must not contain."""

import pytest
from pyspark.sql import functions as F

from shelfcast.catalog.queries import PLAIN, QUERIES
from shelfcast.operators import ordered, ranks, spans, statistics
from shelfcast.operators.lookups import attach_by_goods
from shelfcast.plans import features
from shelfcast.sources import staging
from shelfcast.sources import testdata as td

FOLDER = "/root/testdata/sf0.001"


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize(
    "name", ["rule_forecast", "sku_slide", "goods_to_sku", "day_skeleton_label", "global_rank_avg",
             "weekly_label", "minmax_scale", "category_rollup", "calendar_features"]
)
def test_no_cross_join_and_no_single_partition(spark, name):
    plan = plan_of(PLAIN[name](spark, FOLDER))
    assert "CartesianProduct" not in plan
    assert "BroadcastNestedLoopJoin" not in plan
    main = plan.split("Subquery")[0]
    assert "Exchange SinglePartition" not in main


def test_only_used_columns_are_read(spark):
    plan = plan_of(PLAIN["sku_quantity_stats"](spark, FOLDER))
    read = plan.split("ReadSchema")[1]
    assert "l_quantity" in read and "l_discount" not in read and "l_extendedprice" not in read


def test_hot_goods_are_split_at_run_time(spark):
    """A lookup where one goods owns most variants runs as a skew join."""
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16k",
        "spark.sql.adaptive.coalescePartitions.enabled": "false",
    }
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        universe = spark.range(0, 40000, 1, 8).selectExpr(
            "0 AS window_id", "id AS sku_id", "if(id % 3 < 2, 7, id % 500) AS goods_id"
        )
        block = spark.range(500).selectExpr("0 AS window_id", "id AS goods_id", "id * 2 AS x")
        joined = attach_by_goods(universe, block)
        assert joined.agg(F.count("x")).first()[0] == 40000
        joined.write.format("noop").mode("overwrite").save()
        got = joined.select("x")
        got.collect()
        assert "SortMergeJoin(skew=true)" in plan_of(got)
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_adapters_read_every_row(spark):
    lines = spark.read.parquet(f"{FOLDER}/lineitem.parquet")
    assert td.goodsale(spark, FOLDER).count() == lines.count()
    assert td.goodsinfo(spark, FOLDER).count() == 50


@pytest.mark.parametrize("name", ["window_filter", "day_to_week", "weekly_label"])
def test_date_ranges_reach_the_scan(spark, name):
    plan = plan_of(PLAIN[name](spark, FOLDER))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "l_shipdate" in line]
    assert pushed and all("GreaterThanOrEqual(l_shipdate" in line for line in pushed)


@pytest.mark.parametrize(
    "name, most", [("sale_stats_multi_key", 2), ("last_week_stats", 2), ("features_day_level", 3)]
)
def test_statistics_at_three_keys_scan_the_sales_few_times(spark, monkeypatch, name, most):
    """Scans of the sales by all staged tables and by the result."""
    scans = []
    real = staging.stage

    def counting(df, label="stage"):
        scans.append(plan_of(df).count("lineitem.parquet"))
        return real(df, label)

    for module in (statistics, ordered, ranks):
        monkeypatch.setattr(module, "stage", counting, raising=False)
    df = PLAIN[name](spark, FOLDER)
    scans.append(plan_of(df).split("== Initial Plan")[0].count("lineitem.parquet"))
    assert 0 < sum(scans) <= most


def test_granular_behaviour_is_not_sorted_per_variant(spark, monkeypatch):
    """Ranks and attributes are found on narrow rows; the behaviour columns are joined last."""
    ranked = []
    real = features.rank_columns

    def watching(df, *rest):
        ranked.append(df.columns)
        return real(df, *rest)

    monkeypatch.setattr(features, "rank_columns", watching)
    df = PLAIN["features_granularity"](spark, FOLDER)
    assert len(df.columns) > 100 and len(ranked) == 1
    assert len(ranked[0]) < 20 and "brand_id" in ranked[0]


def test_inputs_of_a_day_are_computed_before_days_repeat(spark):
    """Above the explosion to days are one join with the calendars and the snap of the units."""
    name = "spark.sql.debug.maxToStringFields"
    spark.conf.set(name, "1000")
    try:
        df = QUERIES["features_day_level"](spark, FOLDER)
        plan = df._jdf.queryExecution().optimizedPlan().toString()
    finally:
        spark.conf.unset(name)
    above = plan[: plan.index("Generate explode(CASE WHEN")]
    assert above.count("Join ") == 1
    assert "FLOOR(" in above and above.count("FLOOR(") <= 2


def test_no_method_is_longer_than_the_jvm_compiles(spark):
    """Sessions of other origins, too, run no generated method that stays interpreted."""
    name = "spark.sql.codegen.hugeMethodLimit"
    before = spark.conf.get(name)
    spark.conf.unset(name)
    try:
        QUERIES["sku_universe"](spark, FOLDER)
        assert int(spark.conf.get(name)) <= 8000
    finally:
        spark.conf.set(name, before)


def test_rows_before_the_longest_span_are_not_ordered_for_medians(spark, monkeypatch):
    facts = spark.sql(
        "SELECT 0 AS window_id, id % 3 AS sku_id, int(20170101 + id % 20) AS data_date,"
        " double(id) AS v FROM range(600)"
    )
    ordered_rows = []
    real = spans.exact_medians

    def watching(counts, *rest):
        ordered_rows.append(counts.count())
        return real(counts, *rest)

    monkeypatch.setattr(spans, "exact_medians", watching)
    since = {2: "20170119", 5: "20170116"}.get
    slide = spans.Measure("v", ("sum", "median"), (2, 5))
    got = spans.span_stats(facts, ["window_id", "sku_id"], [slide], since)
    want = facts.groupBy("sku_id").agg(
        *[F.expr(f"median(v) FILTER (WHERE data_date >= {since(i)}) AS v_median_slide_{i}") for i in (2, 5)]
    )
    names = ["sku_id", "v_median_slide_2", "v_median_slide_5"]
    assert sorted(got.select(names).collect()) == sorted(want.select(names).collect())
    whole = spans.Measure("v", ("sum", "median"), (2,), ("median",))
    spans.span_stats(facts, ["window_id", "sku_id"], [whole], since)
    assert ordered_rows == [150, 600]


def test_medians_of_short_groups_are_not_sliced(spark, monkeypatch):
    """Many distinct values in the table are no reason to cut groups that a task holds easily."""
    facts = spark.sql("SELECT 0 AS window_id, id % 40 AS sku_id, double(id) AS v FROM range(2000)")
    monkeypatch.setattr(ordered, "MAX_GROUP_ROWS", 100)
    asked = []
    real = spans.exact_medians
    monkeypatch.setattr(spans, "exact_medians", lambda *a: asked.append(a[3]) or real(*a))
    measure = spans.Measure("v", total=("sum", "median"))
    got = spans.span_stats(facts, ["window_id", "sku_id"], [measure])
    long = facts.withColumn("sku_id", F.col("sku_id") % 2)
    sliced = spans.span_stats(long, ["window_id", "sku_id"], [measure])
    assert asked == [False, True]
    for found, df in ((got, facts), (sliced, long)):
        want = df.groupBy("sku_id").agg(F.median("v"))
        assert sorted(found.select("sku_id", "v_median").collect()) == sorted(want.collect())


@pytest.mark.parametrize("few", [0, 12])
def test_few_ranks_need_no_lists_per_variant(spark, monkeypatch, few):
    table = spark.sql(
        "SELECT 0 AS window_id, id AS sku_id, double(id % 37) AS a, if(id % 5 = 0, null, double(id % 11)) AS b"
        " FROM range(400)"
    )
    monkeypatch.setattr(ranks, "HELD_SHARE", 0)
    monkeypatch.setattr(ranks, "FEW_RANKS", few)
    specs = [ranks.RankSpec("a", "ra"), ranks.RankSpec("b", "rb", "min", False)]
    df = ranks.rank_columns(table, specs, by_value=True)
    assert ("collect_list" in plan_of(df)) == (few == 0)
    got = df.toPandas().sort_values("sku_id").reset_index()
    assert (got.ra == got.a.rank()).all()
    assert got.rb.equals(got.b.rank(method="min", ascending=False))
    with pytest.raises(Exception, match="several rows|DUPLICATED_MAP_KEY"):
        ranks.rank_columns(table.union(table), specs, by_value=True).toPandas()
