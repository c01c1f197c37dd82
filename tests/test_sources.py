import pytest
from support import rows

from shelfcast.plans.forecasts import date_ranges, run_preset
from shelfcast.plans.presets import PRESETS
from shelfcast.sources import tables as tb
from shelfcast.sources.staging import stage, stage_root


def test_csv_columns_are_found_by_name(spark, tmp_path):
    path = tmp_path / "goodsale.csv"
    path.write_text(
        "sku_id,extra,data_date,goods_id,goods_num,goods_price,orginal_shop_price\n"
        '11,x,20170301,1,2.0,"1,332.00",99.5\n12,y,20170302,1.0,,7,8\n'
    )
    got = tb.parse_sale_prices(tb.read_table(spark, "goodsale", str(path)))
    assert rows(got, "sku_id") == [
        (20170301, 1, 11, 2.0, 1332.0, 99.5),
        (20170302, 1, 12, None, 7.0, 8.0),
    ]


def test_editions_are_stacked(sales):
    assert tb.append_editions(sales, sales).count() == 2 * sales.count()


def test_result_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(11, 1.5, 2.0, 0.0, 4.0, 5.0)], tb.SCHEMAS["submit_example"])
    for fmt in ("csv", "parquet"):
        path = str(tmp_path / fmt)
        tb.write_result(df, path, fmt)
        assert rows(tb.read_table(spark, "submit_example", path, fmt), "sku_id") == rows(df, "sku_id")
    assert tb.target_skus(df).columns == ["sku_id"]


def test_ordered_files_joined_by_name_are_the_whole_order(spark, tmp_path):
    df = spark.createDataFrame(
        [(k * 7919 % 1000, 1, k, 1.0, f'a "{k}", b' if k % 3 else None, "") for k in range(400)],
        tb.SCHEMAS["goodsale"],
    )
    path = tmp_path / "ordered"
    tb.write_result(df, str(path), "csv", order=["data_date", "sku_id"])
    lines = [x for f in sorted(path.glob("part-*")) for x in f.read_text().splitlines()]
    assert lines[0] == ",".join(df.columns) and lines.count(lines[0]) == 1
    keys = [(int(x.split(",")[0]), int(x.split(",")[2])) for x in lines[1:]]
    assert keys == sorted(keys) and len(keys) == 400
    back = tb.read_ordered(spark, str(path), "goodsale")
    assert back.schema == df.schema
    got = rows(back.select("sku_id", "data_date", "goods_price"), "sku_id")
    assert got == rows(df.select("sku_id", "data_date", "goods_price"), "sku_id")


def test_other_months_are_not_read(spark, csv_folder, tmp_path):
    """Windows become predicates on the monthly folders of both fact tables."""
    plain = tb.read_model_tables(spark, csv_folder)
    for name, file in tb.FILES.items():
        table = tb.read_table(spark, name, f"{csv_folder}/{file}.csv")
        target = str(tmp_path / file)
        tb.write_fact(table, target) if name in tb.FACTS else table.write.parquet(target)
    monthly = tb.read_model_tables(spark, str(tmp_path), fmt="months")
    preset = PRESETS["linear_slides"]
    pruned = tb.prune_months(monthly, date_ranges(preset))
    for facts in (pruned.goodsale, pruned.goodsdaily):
        plan = facts._jdf.queryExecution().executedPlan().toString()
        assert "month#" in plan.split("PartitionFilters")[1].split("PushedFilters")[0]
        assert {f.split("month=")[1][:6] for f in facts.inputFiles()} >= {"201703", "201802"}
        assert "month" not in facts.columns
    kept = rows(run_preset(monthly, "linear_slides"), "sku_id")
    for got, want in zip(kept, rows(run_preset(plain, "linear_slides"), "sku_id")):
        assert got == pytest.approx(want, rel=1e-6)


def test_stages_need_a_shared_folder(spark, monkeypatch):
    class Cluster:
        conf = type("Conf", (), {"get": staticmethod(lambda k, d=None: d if "checkpoint" in k else "file:/x")})
        sparkContext = type("Context", (), {"master": "spark://host:7077"})

    with pytest.raises(ValueError):
        stage_root(Cluster)


def test_monthly_facts_prune(spark, sales, tmp_path):
    path = str(tmp_path / "fact")
    tb.write_fact(sales, path)
    got = tb.read_fact(spark, path, 20170302, 20170331)
    assert got.count() == 4
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "month#" in plan.split("PartitionFilters")[1]


def test_stage_uses_the_configured_folder(spark, sales):
    staged = stage(sales, "probe")
    assert rows(staged, "sku_id", "data_date") == rows(sales, "sku_id", "data_date")
    root = stage_root(spark)
    assert root == spark.conf.get("spark.checkpoint.dir").rstrip("/")
    assert all(root in f for f in staged.inputFiles())


@pytest.fixture(scope="session")
def csv_folder(tmp_path_factory):
    """A small complete input folder in the original file layout."""
    folder = tmp_path_factory.mktemp("input")
    from shelfcast.functions.dates import shift

    sale, daily, plan, weather = [], [], [], []
    for i in range(520):
        day = shift(20170301, i)
        plan.append(f"{day},{i % 3},{i % 2}")
        weather.append(f"{day},{60 + i % 7},70,50,1.5,{i % 9}")
        if day > 20180316:
            continue
        for sku in range(11, 17):
            goods = sku // 2
            if (i + sku) % 3:
                sale.append(f'{day},{goods},{sku},{1 + (i * sku) % 5},"1,{100 + sku}.00",99')
            if sku % 2:
                daily.append(f"{day},{goods},{i % 9},{i % 4},{i % 3},{i % 5},{i + 1}")
    files = {
        "goodsale": ("data_date,goods_id,sku_id,goods_num,goods_price,orginal_shop_price", sale),
        "goodsdaily": (
            "data_date,goods_id,goods_click,cart_click,favorites_click,sales_uv,onsale_days",
            daily,
        ),
        "goodsinfo": (
            "goods_id,brand_id," + ",".join(f"cat_level{i}_id" for i in range(1, 8)),
            [f"{g},{g % 2},1,2,3,4,5,6,{g}" for g in range(5, 9)],
        ),
        "goods_sku_relation": ("goods_id,sku_id", [f"{s // 2},{s}" for s in range(11, 18)]),
        "marketing": ("data_date,marketing,plan", plan),
        "submit_example_2": (
            "sku_id,week1,week2,week3,week4,week5",
            [f"{s},0,0,0,0,0" for s in range(11, 18)],
        ),
        "holiday": ("data_date,holiday_code", ["20171130,9", "20171130,10", "20180501,4"]),
        "weather_ariba": (
            "data_date,temp_mean,temp_max,temp_min,uv_index_mean,uv_index_max",
            weather,
        ),
    }
    for name, (header, lines) in files.items():
        (folder / f"{name}.csv").write_text("\n".join([header, *lines]) + "\n")
    return str(folder)


@pytest.mark.parametrize("preset", sorted(PRESETS))
def test_presets_run_from_files_to_forecast(spark, csv_folder, preset):
    mode = PRESETS[preset].price_mode
    tables = tb.read_model_tables(spark, csv_folder, price_mode=mode)
    got = run_preset(tables, preset, rounds=2)
    found = {r.sku_id: r for r in got.collect()}
    assert sorted(found) == list(range(11, 18))
    sold = [v for s, r in found.items() if s != 17 for v in tuple(r)[1:]]
    assert all(v is not None and v >= 0 for v in sold)


def test_weeks_can_be_reversed(spark, csv_folder):
    tables = tb.read_model_tables(spark, csv_folder)
    plain = {r.sku_id: tuple(r)[1:] for r in run_preset(tables, "share_of_total").collect()}
    swapped = run_preset(tables, "share_of_total", reverse=True).collect()
    assert {r.sku_id: tuple(r)[:0:-1] for r in swapped} == plain


@pytest.mark.parametrize(
    "lo, hi, found",
    [(None, None, 4), (20170115, None, 3), (None, 20170201, 3), (20170115, 20170201, 2)],
)
def test_fact_ranges_may_be_open(spark, tmp_path, lo, hi, found):
    days = [(20170101,), (20170131,), (20170201,), (20170228,)]
    tb.write_fact(spark.createDataFrame(days, "data_date int"), str(tmp_path / "fact"))
    assert tb.read_fact(spark, str(tmp_path / "fact"), lo, hi).count() == found
