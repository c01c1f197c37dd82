"""SQL twins of the queries, on the same tables.

Statements share common table expressions for the model tables and windows; wide select lists are
generated. Computed DOUBLE columns are snapped as in the queries.
"""

from shelfcast.catalog import NULLABLE_INTEGERS

WEEKS = ("week1", "week2", "week3", "week4", "week5")
MEASURES = ("goods_click", "cart_click", "favorites_click", "sales_uv")
CATEGORIES = tuple(f"cat_level{i}_id" for i in range(1, 8))
WEATHER = ("temp_mean", "temp_max", "temp_min", "uv_index_mean", "uv_index_max")

FEATURE_RANGES = (
    (19950101, 19960330),
    (19960331, 19970330),
    (19970331, 19980330),
    (19980331, 19990330),
    (19990331, 20000330),
    (20000331, 20010330),
    (20010331, 20011231),
)
LABEL_RANGES = tuple((y * 10000 + 515, y * 10000 + 618) for y in range(1996, 2002))
DAY_RANGES = ((19950101, 19980330), (19980331, 20010930))
DAY_LABELS = ((19980515, 19980618), (20011001, 20011104))


def snap(sql):
    """Four decimals, one for numbers from a million up, where the fourth is below precision."""
    fine, coarse = (f"floor(({sql}) * {scale} + 0.500731e0) / {scale}" for scale in ("1e4", "1e1"))
    return f"CASE WHEN abs({sql}) < 1e6 THEN {fine} ELSE {coarse} END"


def day(column):
    """yyyymmdd integer as DATE."""
    return f"CAST(strptime(CAST({column} AS VARCHAR), '%Y%m%d') AS DATE)"


def stat(name, value, condition=None):
    """One aggregate, optionally over the rows of a condition."""
    only = f" FILTER (WHERE {condition})" if condition else ""
    function = {"mean": "avg", "var": "var_samp", "std": "stddev_samp"}.get(name, name)
    if name == "rows":
        return f"count(*){only}"
    return f"{function}({value}){only}"


def tagged(source, name, ranges, id_name="window_id"):
    cases = " ".join(
        f"WHEN data_date BETWEEN {lo} AND {hi} THEN {i}" for i, (lo, hi) in enumerate(ranges)
    )
    return (
        f"{name} AS (SELECT * FROM (SELECT *, CAST(CASE {cases} END AS BIGINT) AS {id_name} FROM {source})"
        f" WHERE {id_name} IS NOT NULL)"
    )


def dated(source, name):
    """Rows with their place among the distinct dates of the window."""
    return f"""{name}_dates AS (
  SELECT window_id, data_date,
         dense_rank() OVER (PARTITION BY window_id ORDER BY data_date) - 1 AS day_pos,
         dense_rank() OVER (PARTITION BY window_id ORDER BY data_date DESC) AS recency,
         date_diff('day', {day('data_date')},
                   max({day('data_date')}) OVER (PARTITION BY window_id)) AS age_days
  FROM (SELECT DISTINCT window_id, data_date FROM {source})),
{name} AS (SELECT s.*, d.day_pos, d.recency, d.age_days
  FROM {source} s JOIN {name}_dates d USING (window_id, data_date))"""


SALES = """sales AS (
  SELECT CAST(strftime(l_shipdate, '%Y%m%d') AS BIGINT) AS data_date,
         CAST(l_partkey // 4 AS BIGINT) AS goods_id, l_partkey AS sku_id,
         l_quantity AS goods_num, l_extendedprice / l_quantity AS goods_price,
         p_retailprice AS orginal_shop_price
  FROM lineitem LEFT JOIN part ON p_partkey = l_partkey)"""
RELATION = """relation AS (
  SELECT CAST(p_partkey // 4 AS BIGINT) AS goods_id, p_partkey AS sku_id FROM part)"""
INFO = """info AS (
  SELECT goods_id, CAST(substr(brand, 7) AS BIGINT) AS brand_id,
         CAST(size AS BIGINT) AS cat_level1_id, CAST(size % 25 AS BIGINT) AS cat_level2_id,
         CAST(size % 12 AS BIGINT) AS cat_level3_id, CAST(size % 8 AS BIGINT) AS cat_level4_id,
         CAST(size % 5 AS BIGINT) AS cat_level5_id, CAST(size % 3 AS BIGINT) AS cat_level6_id,
         CAST(size % 2 AS BIGINT) AS cat_level7_id
  FROM (SELECT CAST(p_partkey // 4 AS BIGINT) AS goods_id, arg_min(p_brand, p_partkey) AS brand,
               arg_min(p_size, p_partkey) AS size FROM part GROUP BY 1))"""
DAILY = """daily AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS data_date, goods_id, goods_click, cart_click,
         favorites_click, sales_uv,
         CAST(1 + date_diff('day', min(d) OVER (PARTITION BY goods_id), d) AS DOUBLE)
           AS onsale_days
  FROM (SELECT user_id AS goods_id, CAST(ts AS DATE) - 8706 AS d,
               CAST(count(*) FILTER (WHERE event_type = 'click') AS DOUBLE) AS goods_click,
               CAST(count(*) FILTER (WHERE event_type = 'view') AS DOUBLE) AS cart_click,
               CAST(count(*) FILTER (WHERE event_type = 'signup') AS DOUBLE) AS favorites_click,
               CAST(count(*) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS sales_uv
        FROM events GROUP BY 1, 2))"""
WINDOWED = tagged("sales", "wsales", FEATURE_RANGES)
RECENT = dated("wsales", "rsales")
WDAILY = tagged("daily", "wdaily", FEATURE_RANGES)
RDAILY = dated("wdaily", "rdaily")
UNIVERSE = """universe AS (
  SELECT DISTINCT window_id, sku_id FROM wsales WHERE window_id < 6
  UNION ALL SELECT 6, p_partkey FROM part)"""
LABELS = f"""{tagged('sales', 'lsales', LABEL_RANGES)},
{dated('lsales', 'placed')},
label_sums AS (SELECT window_id, sku_id, {', '.join(
    f"sum(goods_num) FILTER (WHERE day_pos // 7 = {k}) AS {w}" for k, w in enumerate(WEEKS))}
  FROM placed GROUP BY 1, 2),
labels_of AS (SELECT u.window_id, u.sku_id, {', '.join(f'coalesce({w}, 0.0) AS {w}' for w in WEEKS)}
  FROM (SELECT DISTINCT window_id, sku_id FROM wsales WHERE window_id < 6) u
  LEFT JOIN label_sums USING (window_id, sku_id))"""


def statement(select, *tables):
    return f"WITH {', '.join(tables)}\n{select}" if tables else select


def listed(columns):
    """Select list from {name: sql}."""
    return ", ".join(f"{sql} AS {name}" for name, sql in columns.items())


def snapped(columns):
    return {name: snap(sql) for name, sql in columns.items()}


def spans(value, stats, widths, name, condition="recency <= {}"):
    """{column: aggregate} for each statistic and span."""
    return {
        name.format(stat=s, span=i): stat(s, value, condition.format(i))
        for i in widths
        for s in stats
    }


def totals(value, stats, name):
    return {name.format(stat=s): stat(s, value) for s in stats}


def typed(columns):
    """Snap everything but counts."""
    return {
        n: f"CAST({sql} AS BIGINT)" if sql.startswith("count(") else snap(sql)
        for n, sql in columns.items()
    }


SKU_SLIDE = "goodsale_sku_{stat}_slide_{span}"
GOODS_SLIDE = "goodsale_goods_{stat}_slide_{span}"
FIVE = ("max", "min", "mean", "median", "sum")
FOUR = ("max", "min", "mean", "sum")
VARS = ("max", "min", "mean", "var")
RANKED = (3, 5, 7, 14, 21, 27)
SALE_SPANS = (2, 3, 5, 7, 9, 12, 14)
SHORT = (1, 2, 3, 5, 7, 9, 12)
DAILY_SHORT = (1, 3, 7, 9, 12)
CONTEXT = (3, 5, 7, 14, 21, 35)
GRANULARITIES = (24, 21, 14, 7, 5, 3, 1)


def grouped(source, key, columns, *tables):
    """A GROUP BY (window_id, key) over one source, as a full statement."""
    select = (
        f"SELECT window_id, {key}, {listed(typed(columns))} FROM {source} GROUP BY window_id, {key}"
    )
    return statement(select, *tables)


def sku_query(columns):
    return grouped("rsales", "sku_id", columns, SALES, WINDOWED, RECENT)


def goods_query(columns):
    return grouped("rsales", "goods_id", columns, SALES, WINDOWED, RECENT)


def daily_query(columns):
    return grouped("rdaily", "goods_id", columns, DAILY, WDAILY, RDAILY)


def block(name, source, key, columns):
    """The same grouping as a named table, not snapped."""
    return (
        f"{name} AS (SELECT window_id, {key}, {listed(columns)} FROM {source}"
        f" GROUP BY window_id, {key})"
    )


def measure_columns(stats, widths, pattern, condition="recency <= {}"):
    out = {}
    for m in MEASURES:
        out |= spans(m, stats, widths, m + pattern, condition)
    return out


def rate(top, bottom):
    return f"{top} / nullif({bottom}, 0)"


RATES = {
    "sale_click_rate": "goods_click_sum",
    "sale_cart_rate": "cart_click_sum",
    "sale_favorites_rate": "favorites_click_sum",
}


def min_rank(value, falling=False, within=""):
    order = " DESC" if falling else ""
    return (
        f"CAST(rank() OVER (PARTITION BY window_id{within} ORDER BY {value}{order}) AS DOUBLE)"
    )


def avg_rank(value):
    return (
        f"CASE WHEN {value} IS NOT NULL THEN"
        f" rank() OVER (PARTITION BY window_id ORDER BY {value} NULLS LAST)"
        f" + (count(*) OVER (PARTITION BY window_id, {value}) - 1) / 2.0e0 END"
    )


# Statistics at three keys -----------------------------------------------------------------------

NUMBERED = ("sum", "mean", "skew", "kurt", "std", "max", "min", "median")


def moment(name, value="goods_num"):
    """Population skewness and excess kurtosis from raw moments; NULL without spread."""
    m = f"avg({value})"
    second = f"(avg({value} * {value}) - {m} * {m})"
    third = f"(avg(pow({value}, 3)) - 3 * {m} * avg({value} * {value}) + 2 * pow({m}, 3))"
    fourth = (
        f"(avg(pow({value}, 4)) - 4 * {m} * avg(pow({value}, 3))"
        f" + 6 * {m} * {m} * avg({value} * {value}) - 3 * pow({m}, 4))"
    )
    ratio = f"{third} / pow({second}, 1.5)" if name == "skew" else f"{fourth} / pow({second}, 2) - 3"
    return f"CASE WHEN max({value}) > min({value}) THEN {ratio} END"


def numbered_stats(naming, key_index):
    return {
        naming(s, key_index): moment(s) if s in ("skew", "kurt") else stat(s, "goods_num")
        for s in NUMBERED
    }


def history_name(s, key_index):
    place = NUMBERED.index(s)
    first = 1 + 3 * place if place < 2 else 11 + 3 * (place - 2)
    return f"s{first + key_index}"


def week_name(s, key_index):
    return f"sw_{1 + 3 * NUMBERED.index(s) + key_index}"


KEYS = ("goods_id", "sku_id", "goods_id, sku_id")


def three_blocks(source, naming):
    return [block(f"k{i}", source, key, numbered_stats(naming, i)) for i, key in enumerate(KEYS)]


THREE_JOINS = (
    " LEFT JOIN k0 USING (window_id, goods_id) LEFT JOIN k1 USING (window_id, sku_id)"
    " LEFT JOIN k2 USING (window_id, goods_id, sku_id)"
)


def three_key_query(source, naming, *tables):
    names = [naming(s, i) for s in NUMBERED for i in range(3)]
    select = (
        f"SELECT window_id, goods_id, sku_id, {listed(snapped({n: n for n in names}))}"
        f" FROM (SELECT DISTINCT window_id, goods_id, sku_id FROM {source}) u{THREE_JOINS}"
    )
    return statement(select, *tables, *three_blocks(source, naming))


# Feature sets -----------------------------------------------------------------------------------


def feature_table(parts, columns, ranks):
    """fea: the universe with its blocks joined; ranks are computed on it."""
    joins = " ".join(f"LEFT JOIN {name} USING ({keys})" for name, keys in parts)
    return (
        f"fea AS (SELECT window_id, sku_id, goods_id, {listed(columns)}"
        f" FROM universe LEFT JOIN relation USING (sku_id) {joins}),"
        f" ranked AS (SELECT window_id, sku_id, goods_id, {', '.join(columns)}"
        f"{', ' if ranks else ''}{listed(ranks)} FROM fea)"
    )


BY_SKU, BY_GOODS = "window_id, sku_id", "window_id, goods_id"
PRICE_COLUMNS = totals("goods_price", VARS, "sku_price_{stat}")


def fill(columns, value):
    return {c: f"coalesce({c}, {value})" for c in columns}


def features(columns, ranks, parts, fill_value, final_fill, *blocks):
    """A whole feature-set statement. fill_value: before ranking (None: only at the end)."""
    source = fill(columns, fill_value) if fill_value is not None else {c: c for c in columns}
    out = {c: c if final_fill is None else f"coalesce({c}, {final_fill})" for c in columns}
    out |= {r: r if final_fill is None or fill_value is not None else f"coalesce({r}, {final_fill})"
            for r in ranks}
    select = f"SELECT window_id, sku_id, {listed(snapped(out))} FROM ranked"
    return statement(
        select,
        SALES, WINDOWED, RECENT, RELATION, INFO, DAILY, WDAILY, RDAILY, UNIVERSE,
        *blocks,
        feature_table(parts, source, ranks),
    )


def slide_rank_sql():
    sku = spans("goods_num", FIVE, RANKED, SKU_SLIDE) | PRICE_COLUMNS
    goods = spans("goods_num", FOUR, RANKED, GOODS_SLIDE)
    daily = measure_columns(FOUR, RANKED, "_{stat}_slide_{span}")
    ranks = {}
    for i in RANKED:
        for s in FIVE:
            c = f"goodsale_sku_{s}_slide_{i}"
            ranks[f"{c}_rank_0"] = min_rank(c)
            ranks[f"{c}_rank_1"] = min_rank(c, True)
        c = f"goodsale_sku_sum_slide_{i}"
        ranks[f"same_goods_sku_slide_sum_{i}_rank_0"] = min_rank(c, True, ", goods_id")
        ranks[f"same_goods_sku_slide_sum_{i}_rank_1"] = min_rank(c, False, ", goods_id")
    ranks["sku_price_mean_rank_0"] = min_rank("sku_price_mean", True, ", goods_id")
    ranks["sku_price_mean_rank_1"] = min_rank("sku_price_mean", False, ", goods_id")
    columns = [*sku, *goods, *daily, *CATEGORIES[:5]]
    parts = (("a", BY_SKU), ("g", BY_GOODS), ("b", BY_GOODS), ("info", "goods_id"))
    return features(
        columns, ranks, parts, -999, None,
        block("a", "rsales", "sku_id", sku),
        block("g", "rsales", "goods_id", goods),
        block("b", "rdaily", "goods_id", daily),
    )


def linear_sql():
    sku = spans("goods_num", FIVE, RANKED, SKU_SLIDE) | PRICE_COLUMNS
    daily = measure_columns(FOUR, RANKED, "_{stat}_slide_{span}")
    ranks = {
        f"goodsale_sku_{s}_slide_{i}_rank": min_rank(f"goodsale_sku_{s}_slide_{i}")
        for i in RANKED
        for s in FIVE
    }
    return features(
        [*sku, *daily], ranks, (("a", BY_SKU), ("b", BY_GOODS)), 0, None,
        block("a", "rsales", "sku_id", sku),
        block("b", "rdaily", "goods_id", daily),
    )


def price_columns():
    return (
        {"amount_sum": "sum(goods_num * goods_price)"}
        | totals("goods_price", ("max", "min", "mean", "std"), "sku_price_{stat}")
    )


def sale_num_columns():
    return totals("goods_price", (*FIVE, "count"), "sku_sale_num_{stat}")


def sales_block(widths):
    sku = price_columns() | sale_num_columns()
    sku |= {"last_day_sku_sale_num_sum": stat("sum", "goods_num", "recency = 1")}
    sku |= spans("goods_num", FIVE, widths, SKU_SLIDE)
    ranked = [f"sku_sale_num_{s}" for s in FIVE] + ["last_day_sku_sale_num_sum"]
    ranks = {f"{c}_rank": avg_rank(c) for c in ranked}
    for i in widths:
        for s in FIVE:
            c = f"goodsale_sku_{s}_slide_{i}"
            ranks[f"{c}_rank_0"] = avg_rank(c)
    return sku, ranks


def sales_only_sql():
    sku, ranks = sales_block(SALE_SPANS)
    return features(
        [*sku], ranks, (("a", BY_SKU),), None, 0, block("a", "rsales", "sku_id", sku)
    )


def goods_context_sql():
    sku, ranks = sales_block(CONTEXT)
    goods = spans("goods_num", ("sum",), CONTEXT, GOODS_SLIDE)
    goods |= {
        "last_day_goods_sale_num_sum": stat("sum", "goods_num", "recency = 1"),
        "sku_num": "count(DISTINCT sku_id)",
    }
    parts = (("a", BY_SKU), ("g", BY_GOODS), ("info", "goods_id"))
    return features(
        [*sku, *goods, "cat_level1_id"], ranks, parts, None, 0,
        block("a", "rsales", "sku_id", sku),
        block("g", "rsales", "goods_id", goods),
    )


def short_slide_parts():
    three = ("max", "mean", "sum")
    sku = spans("goods_num", three, SHORT, SKU_SLIDE)
    sku |= totals("goods_num", three, "goodsale_sku_{stat}")
    goods = spans("goods_num", ("sum",), SHORT, GOODS_SLIDE)
    goods |= totals("goods_num", ("sum",), "goodsale_goods_{stat}")
    daily = measure_columns((*FOUR, "count"), DAILY_SHORT, "_{stat}_slide_{span}")
    # A span without rows has no count: it is NULL, then filled.
    for m in MEASURES:
        daily |= totals(m, FOUR, m + "_{stat}")
    ranks = {}
    for i in SHORT:
        for c in ("goodsale_sku_sum", "goodsale_sku_mean", "goodsale_goods_sum"):
            ranks[f"{c}_slide_{i}_rank"] = avg_rank(f"{c}_slide_{i}")
    return sku, goods, daily, ranks


def short_slide_sql():
    sku, goods, daily, ranks = short_slide_parts()
    parts = (("a", BY_SKU), ("g", BY_GOODS), ("b", BY_GOODS))
    return features(
        [*sku, *goods, *daily], ranks, parts, None, 0,
        block("a", "rsales", "sku_id", sku),
        block("g", "rsales", "goods_id", goods),
        block("b", "rdaily", "goods_id", daily),
    )


def training_sql():
    inner = short_slide_sql()
    start = inner.rindex("SELECT window_id, sku_id, ")
    weeks = ", ".join(f"{snap(w)} AS {w}" for w in WEEKS)
    return (
        f"{inner[:start].rstrip()}, featured AS ({inner[start:]}), {LABELS}"
        f" SELECT featured.*, {weeks} FROM featured LEFT JOIN labels_of USING (window_id, sku_id)"
    )


OVERLAP = (
    (19950101, 19981231),
    (19950701, 19990630),
    (19960101, 20011231),
    (19970101, 19970331),
    (19970315, 20000229),
)


def overlap_sql():
    bounds = ", ".join(f"({i}, {lo}, {hi})" for i, (lo, hi) in enumerate(OVERLAP))
    columns = spans("goods_num", FIVE, RANKED, SKU_SLIDE)
    columns |= spans("goods_num", ("var",), (7, 90), SKU_SLIDE)
    counts = spans("goods_num", ("count",), (7, 90), SKU_SLIDE)
    columns |= PRICE_COLUMNS | {"whole_median": "median(goods_num)"}
    out = snapped({c: c for c in columns}) | {c: f"CAST({c} AS DOUBLE)" for c in counts}
    return statement(
        f"SELECT a.window_id, a.sku_id, goods_id, {listed(out)}, {snap('whole_first')} AS whole_first,"
        " sku_num FROM a JOIN (SELECT DISTINCT window_id, goods_id, sku_id FROM osales) USING"
        " (window_id, sku_id) JOIN (SELECT window_id, goods_id, count(DISTINCT sku_id) AS sku_num"
        " FROM osales GROUP BY 1, 2) USING (window_id, goods_id) JOIN"
        " (SELECT window_id, sku_id, min(goods_num) AS whole_first FROM osales"
        " JOIN (SELECT window_id, sku_id, min(data_date) AS data_date FROM osales GROUP BY 1, 2)"
        " USING (window_id, sku_id, data_date) GROUP BY 1, 2) USING (window_id, sku_id)",
        SALES,
        f"osales AS (SELECT sales.*, CAST(window_id AS BIGINT) AS window_id FROM sales JOIN"
        f" (VALUES {bounds}) AS w(window_id, lo, hi) ON data_date BETWEEN lo AND hi)",
        dated("osales", "orsales"),
        block("a", "orsales", "sku_id", {n: f"nullif({c}, 0)" for n, c in counts.items()} | columns),
    )


def granular_columns():
    out = {}
    five = ("max", "min", "mean", "var", "sum")
    for m in MEASURES:
        out |= totals(m, five, m + "_{stat}")
        out |= spans(m, five, GRANULARITIES, m + "_{stat}{span}", "age_days <= {}")
    return out


def rate_columns():
    return {
        f"{name}{i}": rate(f"sales_uv_sum{i}", f"{bottom}{i}")
        for i in ("", *GRANULARITIES)
        for name, bottom in RATES.items()
    }


def window_end():
    cases = " ".join(f"WHEN {i} THEN {hi}" for i, (_, hi) in enumerate(FEATURE_RANGES))
    return f"CASE window_id {cases} END"


def granularity_sql():
    daily = granular_columns()
    sku = totals("goods_num", VARS, "goods_num_{stat}")
    sku |= totals("goods_price", VARS, "goods_price_{stat}")
    sku |= {"last_date": "max(data_date)", "sku_sale_day_num": "count(*)"}
    out = snapped({c: c for c in [*daily, *sku] if c not in ("last_date", "sku_sale_day_num")})
    out |= snapped(rate_columns())
    out |= {
        "sku_sale_day_num": "sku_sale_day_num",
        "days_rate": snap("sku_sale_day_num / onsale_days"),
        "max_sub_last": f"CAST(date_diff('day', {day('last_date')}, {day(window_end())}) AS BIGINT)",
        "brand_id": "brand_id",
        "rank_sku_sale_day_num_asc": snap(min_rank("sku_id", True, ", goods_id")),
        "rank_sku_sale_day_num_dec": snap(min_rank("sku_id", False, ", goods_id")),
    }
    select = (
        f"SELECT window_id, sku_id, {listed(out)} FROM universe LEFT JOIN relation USING (sku_id)"
        " LEFT JOIN a USING (window_id, sku_id) LEFT JOIN b USING (window_id, goods_id)"
        " LEFT JOIN first_daily USING (window_id, goods_id) LEFT JOIN info USING (goods_id)"
    )
    return statement(
        select,
        SALES, WINDOWED, RECENT, RELATION, INFO, DAILY, WDAILY, RDAILY, UNIVERSE, FIRST_DAILY,
        block("a", "rsales", "sku_id", sku),
        block("b", "rdaily", "goods_id", daily),
    )


FIRST_DAILY = """first_daily AS (
  SELECT window_id, goods_id, min(data_date) AS data_date,
         arg_min(onsale_days, data_date) AS onsale_days
  FROM wdaily GROUP BY 1, 2)"""

# Calendars --------------------------------------------------------------------------------------

MARKETING = """marketing AS (
  SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS data_date,
         CAST(left(min(o_orderpriority), 1) AS BIGINT) AS marketing,
         CAST(min(month(o_orderdate)) AS BIGINT) AS plan
  FROM orders GROUP BY 1)"""
HOLIDAY = """holiday_rows AS (
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS data_date, CAST(code AS BIGINT) AS holiday_code
  FROM (SELECT d, unnest(CASE WHEN month(d) = 5 AND day(d) = 29 THEN [9, 10]
                              WHEN day(d) <= 2 THEN [month(d)] END) AS code
        FROM (SELECT DISTINCT CAST(o_orderdate AS DATE) AS d FROM orders)))"""
WEATHER_SQL = """weather AS (
  SELECT CAST(strftime(o_orderdate, '%Y%m%d') AS BIGINT) AS data_date,
         avg(o_totalprice / 10000) AS temp_mean, max(o_totalprice / 10000) AS temp_max,
         min(o_totalprice / 10000) AS temp_min, avg(o_custkey % 12) AS uv_index_mean,
         CAST(max(o_custkey % 12) AS BIGINT) AS uv_index_max
  FROM orders GROUP BY 1)"""


def skeleton():
    starts = ", ".join(f"({i}, DATE '{str(lo)[:4]}-{str(lo)[4:6]}-{str(lo)[6:]}')"
                       for i, (lo, _) in enumerate(DAY_LABELS))
    return f"""skeleton AS (
  SELECT CAST(window_id AS BIGINT) AS window_id, sku_id, goods_id,
         CAST(strftime(start + CAST(k AS INTEGER), '%Y%m%d') AS BIGINT) AS data_date, k
  FROM relation CROSS JOIN (VALUES {starts}) AS w(window_id, start)
  CROSS JOIN (SELECT unnest(range(35)) AS k))"""


CALENDAR_COLUMNS = {
    "week": f"CAST(isodow({day('data_date')}) - 1 AS BIGINT)",
    "day_rank": "CAST(k AS BIGINT)",
}
DAY_UNITS = """units AS (
  SELECT data_date, sku_id, sum(goods_num) AS goods_num FROM sales GROUP BY 1, 2)"""


def weather_columns():
    return {c: c if c == "uv_index_max" else snap(c) for c in WEATHER}


def behaviour_stats():
    out = {f"f{i}": f"sum({c})" for i, c in enumerate(MEASURES, 1)}
    return out | {f"f{i}": f"avg({c})" for i, c in enumerate(("onsale_days", *MEASURES), 5)}


def price_means(i):
    return {f"s{7 + i}": "avg(goods_price)", f"s{9 + i}": "avg(orginal_shop_price)"}


def day_level_sql():
    names = [f"f{i}" for i in range(1, 10)] + [f"s{i}" for i in range(1, 29)]
    out = {"goods_num": snap("coalesce(u.goods_num, 0)")}
    out |= {"marketing": "marketing", "plan": "plan", "holiday_code": "holiday_code"}
    out |= CALENDAR_COLUMNS | weather_columns()
    out |= {c: c for c in (*CATEGORIES, "brand_id")} | snapped({n: n for n in names})
    select = (
        f"SELECT s.window_id, s.sku_id, s.goods_id, s.data_date, {listed(out)} FROM skeleton s"
        " LEFT JOIN units u USING (sku_id, data_date) LEFT JOIN marketing USING (data_date)"
        " LEFT JOIN holiday USING (data_date) LEFT JOIN weather USING (data_date)"
        f" LEFT JOIN info USING (goods_id){THREE_JOINS}"
        " LEFT JOIN p0 USING (window_id, goods_id) LEFT JOIN p1 USING (window_id, goods_id, sku_id)"
        " LEFT JOIN b USING (window_id, goods_id)"
    )
    return statement(
        select.replace("isodow(CAST(strptime(CAST(data_date", "isodow(CAST(strptime(CAST(s.data_date"),
        SALES, RELATION, INFO, DAILY, MARKETING, HOLIDAY, HOLIDAYS, WEATHER_SQL, DAY_UNITS,
        skeleton(),
        tagged("sales", "hsales", DAY_RANGES),
        tagged("daily", "hdaily", DAY_RANGES),
        *three_blocks("hsales", history_name),
        block("p0", "hsales", "goods_id", price_means(0)),
        block("p1", "hsales", "goods_id, sku_id", price_means(1)),
        block("b", "hdaily", "goods_id", behaviour_stats()),
    )


HOLIDAYS = """holiday AS (
  SELECT data_date, min(holiday_code) AS holiday_code FROM holiday_rows GROUP BY 1)"""

# Forecast assembly ------------------------------------------------------------------------------

STAND_IN = f"""stand_in AS (SELECT sku_id, {', '.join(
    f"sum(goods_num) FILTER (WHERE floor(date_diff('day', DATE '2000-05-15', "
    f"{day('data_date')}) / 7.0) = {k}) AS {w}" for k, w in enumerate(WEEKS))}
  FROM sales WHERE data_date BETWEEN 20000515 AND 20000618 GROUP BY 1),
assembled AS (SELECT p_partkey AS sku_id, {', '.join(WEEKS)}
  FROM part LEFT JOIN stand_in ON sku_id = p_partkey)"""


def clamp_sql():
    out = {}
    for w in WEEKS:
        v = f"({w} / 4 - 5.0)"
        out[f"{w}_keep_null"] = f"CASE WHEN {v} < 0 THEN 0 ELSE {v} END"
        out[f"{w}_zero_null"] = f"CASE WHEN {v} > 0 THEN {v} ELSE 0 END"
        out[f"{w}_round"] = f"CASE WHEN {v} < 0 THEN 0 ELSE round_even({v}, 0) END"
    return statement(f"SELECT sku_id, {listed(snapped(out))} FROM assembled", SALES, STAND_IN)


def rule_sql():
    totals_of = (290000, 400000, 550000, 600000, 240000)
    factors = ("1.0", "1.02", "1.02", "1.12", "1.04")
    out = {
        w: snap(f"{t}.0e0 * {f}e0 * (sale_num / total)")
        for w, t, f in zip(WEEKS, totals_of, factors)
    }
    return statement(
        f"SELECT sku_id, {listed(out)} FROM sold, (SELECT sum(sale_num) AS total FROM sold)",
        SALES,
        """sold AS (SELECT p_partkey AS sku_id, sale_num FROM part LEFT JOIN (
             SELECT sku_id, sum(goods_num) AS sale_num FROM sales GROUP BY 1)
           ON sku_id = p_partkey)""",
    )


# Ranks ------------------------------------------------------------------------------------------

RANK_SOURCES = [f"goodsale_sku_{s}_slide_{i}" for s in ("mean", "sum") for i in (7, 27)]


def rank_query(out, filled, *keys):
    columns = spans("goods_num", ("mean", "sum"), (7, 27), SKU_SLIDE)
    columns |= totals("goods_price", ("mean",), "sku_price_{stat}")
    source = fill(columns, -999) if filled else {c: c for c in columns}
    chosen = ", ".join(("window_id", "sku_id", *keys))
    return statement(
        f"SELECT {chosen}, {listed(snapped(out))} FROM fea",
        SALES, WINDOWED, RECENT, RELATION, UNIVERSE,
        block("a", "rsales", "sku_id", columns),
        f"fea AS (SELECT window_id, sku_id, goods_id, {listed(source)} FROM universe"
        " LEFT JOIN relation USING (sku_id) LEFT JOIN a USING (window_id, sku_id))",
    )


def fusion_sql():
    def grouped_rank(v):
        return (
            f"(rank() OVER (PARTITION BY goods_id ORDER BY {v})"
            f" + (count(*) OVER (PARTITION BY goods_id, {v}) - 1) / 2.0e0)"
        )

    return f"""WITH {SALES},
scores AS (SELECT goods_id, sku_id, sum(goods_num) AS score1, avg(goods_price) AS score2
  FROM sales GROUP BY 1, 2),
fusing AS (SELECT goods_id, sku_id,
  0.5e0 / {grouped_rank('score1')} + 0.5e0 / {grouped_rank('score2')} AS fused FROM scores)
SELECT goods_id, sku_id, {snap('fused')} AS fused, CAST(row_number() OVER (
  PARTITION BY goods_id ORDER BY fused DESC, sku_id) AS BIGINT) AS fused_rank FROM fusing"""


def category_sql():
    levels = [*CATEGORIES, "brand_id"]
    parts = " UNION ALL ".join(
        f"SELECT window_id, {i} AS level, {c} AS category_id, {', '.join(MEASURES)}, goods_num"
        f" FROM facts JOIN info USING (goods_id)"
        for i, c in enumerate(levels, 1)
    )
    none = ", ".join(f"NULL AS {m}" for m in MEASURES)
    out = snapped({m: f"sum({m})" for m in (*MEASURES, "goods_num")})
    return statement(
        f"SELECT window_id, CAST(level AS BIGINT) AS level, category_id, {listed(out)}"
        " FROM levels GROUP BY window_id, level, category_id",
        SALES, WINDOWED, INFO, DAILY, WDAILY,
        f"facts AS (SELECT window_id, goods_id, {', '.join(MEASURES)}, NULL AS goods_num"
        f" FROM wdaily UNION ALL SELECT window_id, goods_id, {none}, goods_num FROM wsales)",
        f"levels AS ({parts})",
    )


def moments_sql():
    out = {}
    for i, c in enumerate(MEASURES, 10):
        out |= {
            f"f{i}": f"stddev_samp({c})",
            f"f{i}_1": f"median({c})",
            f"f{i}_2": f"max({c})",
            f"f{i}_3": f"min({c})",
            f"f{i}_4": moment("skew", c),
            f"f{i}_5": moment("kurt", c),
        }
    return grouped("wdaily", "goods_id", out, DAILY, WDAILY)


def weekday_sql():
    out = {
        f"f{14 + 4 * d + i}": f"sum({c}) FILTER (WHERE isodow({day('data_date')}) - 1 = {d})"
        for d in range(7)
        for i, c in enumerate(MEASURES)
    }
    return grouped("wdaily", "goods_id", out, DAILY, WDAILY)


def last_week_sql():
    out = {}
    for first, f in ((1, "sum"), (6, "avg"), (10, "stddev_samp")):
        out |= {f"fw{i}_1": f"{f}({c})" for i, c in enumerate(MEASURES, first)}
    return grouped(
        "(SELECT * FROM rdaily WHERE age_days <= 6)", "goods_id", out, DAILY, WDAILY, RDAILY
    )


def minmax_sql():
    three = ("max", "mean", "sum")
    columns = spans("goods_num", three, SHORT, SKU_SLIDE)
    columns |= totals("goods_num", three, "goodsale_sku_{stat}")
    out = snapped(
        {c: f"({c} - min({c}) OVER ()) / nullif(max({c}) OVER () - min({c}) OVER (), 0)"
         for c in columns}
    )
    return statement(
        f"SELECT window_id, sku_id, {listed(out)}, window_id < 6 AS is_train FROM a",
        SALES, WINDOWED, RECENT, block("a", "rsales", "sku_id", columns),
    )


def slide_count_sql():
    columns = measure_columns((*FOUR, "count"), DAILY_SHORT, "_{stat}_slide_{span}")
    out = {
        n: f"CAST(nullif({sql}, 0) AS BIGINT)" if sql.startswith("count(") else snap(sql)
        for n, sql in columns.items()
    }
    return statement(
        f"SELECT window_id, goods_id, {listed(out)} FROM rdaily GROUP BY window_id, goods_id",
        DAILY, WDAILY, RDAILY,
    )


def plane(label, one, two):
    """Closed form of least squares on two inputs: slopes and intercept as aggregates."""
    a, b, c = f"var_pop({one})", f"var_pop({two})", f"covar_pop({one}, {two})"
    p, q = f"covar_pop({one}, {label})", f"covar_pop({two}, {label})"
    det = f"nullif({a} * {b} - {c} * {c}, 0)"
    first, second = f"(({p} * {b} - {q} * {c}) / {det})", f"(({q} * {a} - {p} * {c}) / {det})"
    return {
        f"{label}_1": first,
        f"{label}_2": second,
        f"{label}_0": f"avg({label}) - {first} * avg({one}) - {second} * avg({two})",
    }


def week_plane_sql():
    fits, out = {}, {}
    for w in WEEKS:
        fits |= plane(w, "units", "price")
        value = f"({w}_0 + {w}_1 * units + {w}_2 * price)"
        out[w] = f"CASE WHEN {value} > 0 THEN {value} ELSE 0.0 END"
    return statement(
        f"SELECT sku_id, {listed(snapped(out))} FROM a CROSS JOIN fitted WHERE window_id = 6",
        SALES, WINDOWED, LABELS,
        block("a", "wsales", "sku_id", {"units": "sum(goods_num)", "price": "avg(goods_price)"}),
        f"fitted AS (SELECT {listed(fits)} FROM a JOIN labels_of USING (window_id, sku_id))",
    )


def day_plane_sql():
    week = "floor(k / 7)"
    value = "y_0 + y_1 * weekday + y_2 * k"
    out = {
        w: f"CASE WHEN sum(hat) FILTER (WHERE {week} = {i}) < 0 THEN 0.0"
        f" ELSE sum(hat) FILTER (WHERE {week} = {i}) END"
        for i, w in enumerate(WEEKS)
    }
    return statement(
        f"SELECT sku_id, {listed(snapped(out))} FROM scored GROUP BY sku_id",
        SALES, RELATION, skeleton(), DAY_UNITS,
        f"days AS (SELECT window_id, sku_id, CAST(k AS DOUBLE) AS k,"
        f" CAST(isodow({day('s.data_date')}) - 1 AS DOUBLE) AS weekday,"
        " coalesce(u.goods_num, 0) AS y FROM skeleton s LEFT JOIN units u USING (sku_id, data_date))",
        f"fitted AS (SELECT {listed(plane('y', 'weekday', 'k'))} FROM days WHERE window_id = 0)",
        f"scored AS (SELECT sku_id, k, {value} AS hat FROM days CROSS JOIN fitted WHERE window_id = 1)",
    )


def stump_sql():
    """The best cut of each input; the first input with the highest gain takes it, the others 0."""
    inputs = {"week": f"isodow({day('s.data_date')}) - 1", "day_rank": "k"}
    cuts = " UNION ALL ".join(
        f"SELECT {i} AS place, '{name}' AS feature, a.v AS cut, sum(b.y) FILTER (WHERE b.v <= a.v) AS ls,"
        " sum(b.n) FILTER (WHERE b.v <= a.v) AS ln, sum(b.y) FILTER (WHERE b.v > a.v) AS rs,"
        f" sum(b.n) FILTER (WHERE b.v > a.v) AS rn FROM {name}_bins a, {name}_bins b GROUP BY a.v"
        for i, name in enumerate(inputs)
    )
    bins = [
        f"{name}_bins AS (SELECT CAST({sql} AS BIGINT) AS v, sum(y) AS y, count(*) AS n FROM away s"
        " GROUP BY 1)"
        for name, sql in inputs.items()
    ]
    return statement(
        f"SELECT feature, {snap('CASE WHEN feature = winner THEN top ELSE 0.0 END')} AS gain FROM"
        " (SELECT unnest(['constant', 'week', 'day_rank', 'copied']) AS feature), (SELECT feature AS"
        " winner, gain AS top FROM gains ORDER BY gain DESC, place LIMIT 1)",
        SALES, RELATION, skeleton(), DAY_UNITS,
        "raw AS (SELECT s.*, coalesce(u.goods_num, 0) AS units FROM skeleton s LEFT JOIN units u"
        " USING (sku_id, data_date))",
        "away AS (SELECT *, units - avg(units) OVER () AS y FROM raw)",
        *bins,
        f"cuts AS ({cuts})",
        "gains AS (SELECT place, feature, max(ls * ls / ln + rs * rs / rn) AS gain FROM cuts"
        " WHERE rn > 0 GROUP BY 1, 2)",
    )


SALES_COLUMNS = "data_date, goods_id, sku_id, goods_num, " + snap("goods_price") + " AS goods_price"
UNIVERSE_TABLES = (SALES, WINDOWED, RELATION, UNIVERSE)

ORACLES = {
    "scan_goodsale": statement(
        f"SELECT {SALES_COLUMNS}, {snap('orginal_shop_price')} AS orginal_shop_price FROM sales",
        SALES,
    ),
    "union_editions": statement(f"SELECT {SALES_COLUMNS} FROM sales", SALES),
    "parse_price": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
    f"{snap('l_extendedprice')} AS price FROM lineitem",
    "parse_price_const": "SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, "
    + snap(
        "CASE WHEN l_extendedprice < 1000 THEN l_extendedprice"
        " WHEN l_extendedprice < 10000 THEN 11.0 END"
    )
    + " AS price FROM lineitem",
    "window_filter": statement(
        f"SELECT {SALES_COLUMNS} FROM sales WHERE data_date >= 19960229 AND data_date <= 20001231",
        SALES,
    ),
    "sku_universe": statement("SELECT DISTINCT window_id, sku_id FROM wsales", SALES, WINDOWED),
    "date_index": statement(
        "SELECT window_id, data_date, day_pos, recency, age_days FROM rsales_dates",
        SALES,
        WINDOWED,
        RECENT,
    ),
    "first_per_key": statement(
        f"SELECT window_id, goods_id, data_date, {snap('onsale_days')} AS onsale_days"
        " FROM first_daily",
        DAILY,
        WDAILY,
        FIRST_DAILY,
    ),
    "rule_forecast": rule_sql(),
    "sku_window_sum": sku_query({"sale_num": "sum(goods_num)"}),
    "assemble_forecast": statement(
        f"SELECT sku_id, {listed(snapped({w: w for w in WEEKS}))} FROM assembled", SALES, STAND_IN
    ),
    "clamp_modes": clamp_sql(),
    "reverse_weeks": statement(
        f"SELECT sku_id, {listed(snapped(dict(zip(WEEKS, reversed(WEEKS)))))} FROM assembled",
        SALES,
        STAND_IN,
    ),
    "sku_slide": sku_query(spans("goods_num", FIVE, RANKED, SKU_SLIDE)),
    "sku_slide_short": sku_query(
        spans("goods_num", ("max", "mean", "sum"), SHORT, SKU_SLIDE)
        | totals("goods_num", ("max", "mean", "sum"), "goodsale_sku_{stat}")
    ),
    "sku_price_var": sku_query(PRICE_COLUMNS),
    "sku_price_stats": sku_query(price_columns()),
    "sku_sale_num_stats": sku_query(sale_num_columns()),
    "sku_quantity_stats": sku_query(totals("goods_num", VARS, "goods_num_{stat}")),
    "sku_sale_days": sku_query({"sku_sale_day_num": "count(*)"}),
    "last_sale_distance": statement(
        "SELECT window_id, sku_id, data_date_max, "
        f"CAST(date_diff('day', {day('data_date_max')}, {day(window_end())}) AS BIGINT)"
        " AS max_sub_last, 20011231 - data_date_max AS integer_distance FROM"
        " (SELECT window_id, sku_id, max(data_date) AS data_date_max FROM wsales GROUP BY 1, 2)",
        SALES,
        WINDOWED,
    ),
    "last_day": statement(
        f"""SELECT window_id, sku_id, goods_id,
  {snap('last_day_sku_sale_num_sum')} AS last_day_sku_sale_num_sum,
  {snap('last_day_goods_sale_num_sum')} AS last_day_goods_sale_num_sum
FROM (SELECT DISTINCT window_id, sku_id FROM wsales) LEFT JOIN relation USING (sku_id)
LEFT JOIN a USING (window_id, sku_id) LEFT JOIN g USING (window_id, goods_id)""",
        SALES,
        WINDOWED,
        RECENT,
        RELATION,
        block("a", "rsales", "sku_id",
              {"last_day_sku_sale_num_sum": stat("sum", "goods_num", "recency = 1")}),
        block("g", "rsales", "goods_id",
              {"last_day_goods_sale_num_sum": stat("sum", "goods_num", "recency = 1")}),
    ),
    "nth_largest_day": statement(
        "SELECT window_id, sku_id, "
        + listed(
            snapped(
                {f"sku_last_{n}_day_goods_num": f"coalesce(units[{n}], -999)"
                 for n in (1, 2, 3, 5, 7, 10, 14)}
            )
        )
        + " FROM (SELECT window_id, sku_id, list(units ORDER BY units DESC) AS units FROM"
        " (SELECT window_id, sku_id, data_date, sum(goods_num) AS units FROM wsales"
        " GROUP BY 1, 2, 3) GROUP BY 1, 2)",
        SALES,
        WINDOWED,
    ),
    "goods_slide": goods_query(spans("goods_num", FOUR, RANKED, GOODS_SLIDE)),
    "goods_slide_sum": goods_query(short_slide_parts()[1]),
    "goods_to_sku": statement(
        "SELECT window_id, sku_id, goods_id, "
        + listed(snapped({c: c for c in short_slide_parts()[1]}))
        + " FROM universe LEFT JOIN relation USING (sku_id) LEFT JOIN g USING (window_id, goods_id)",
        *UNIVERSE_TABLES,
        RECENT,
        block("g", "rsales", "goods_id", short_slide_parts()[1]),
    ),
    "sku_per_goods": grouped(
        "wsales", "goods_id", {"sku_num": "count(DISTINCT sku_id)"}, SALES, WINDOWED
    ),
    "goodsdaily_slide": daily_query(measure_columns(FOUR, RANKED, "_{stat}_slide_{span}")),
    "goodsdaily_slide_count": slide_count_sql(),
    "goodsdaily_total": daily_query(
        {k: v for m in MEASURES for k, v in totals(m, FOUR, m + "_{stat}").items()}
    ),
    "goodsdaily_var": daily_query(
        {
            k: v
            for m in MEASURES
            for k, v in totals(m, ("max", "min", "mean", "var", "sum"), m + "_{stat}").items()
        }
    ),
    "goodsdaily_granularity": daily_query(
        measure_columns(
            ("max", "min", "mean", "var", "sum"), GRANULARITIES, "_{stat}{span}", "age_days <= {}"
        )
    ),
    "conversion_rates": statement(
        f"SELECT window_id, goods_id, {listed(snapped(rate_columns()))} FROM b",
        DAILY,
        WDAILY,
        RDAILY,
        block("b", "rdaily", "goods_id", granular_columns()),
    ),
    "sale_day_rate": statement(
        f"SELECT window_id, sku_id, {snap('n / onsale_days')} AS days_rate FROM"
        " (SELECT window_id, sku_id, count(*) AS n FROM wsales GROUP BY 1, 2)"
        " LEFT JOIN relation USING (sku_id) LEFT JOIN first_daily USING (window_id, goods_id)",
        SALES,
        WINDOWED,
        RELATION,
        DAILY,
        WDAILY,
        FIRST_DAILY,
    ),
    "goods_behaviour_stats": grouped("wdaily", "goods_id", behaviour_stats(), DAILY, WDAILY),
    "goods_behaviour_moments": moments_sql(),
    "weekday_sums": weekday_sql(),
    "last_week_behaviour": last_week_sql(),
    "sale_stats_multi_key": three_key_query("wsales", history_name, SALES, WINDOWED),
    "price_means_multi_key": statement(
        "SELECT window_id, goods_id, sku_id, "
        + listed(snapped({f"s{i}": f"s{i}" for i in range(7, 11)}))
        + " FROM p1 JOIN p0 USING (window_id, goods_id)",
        SALES,
        WINDOWED,
        block("p0", "wsales", "goods_id", price_means(0)),
        block("p1", "wsales", "goods_id, sku_id", price_means(1)),
    ),
    "last_week_stats": three_key_query(
        "lastweek",
        week_name,
        SALES,
        WINDOWED,
        RECENT,
        "lastweek AS (SELECT * FROM rsales WHERE age_days <= 6)",
    ),
    "category_rollup": category_sql(),
    "goods_attributes": statement(
        f"SELECT window_id, sku_id, goods_id, brand_id, {', '.join(CATEGORIES)} FROM universe"
        " LEFT JOIN relation USING (sku_id) LEFT JOIN info USING (goods_id)",
        *UNIVERSE_TABLES,
        INFO,
    ),
    "global_rank_min": rank_query(
        {
            f"{s}_{i}_rank_{d}": min_rank(f"goodsale_sku_{s}_slide_{i}", d == 1)
            for s in ("mean", "sum")
            for i in (7, 27)
            for d in (0, 1)
        },
        True,
    ),
    "global_rank_avg": rank_query(
        {f"{c}_rank": avg_rank(c) for c in (*RANK_SOURCES, "sku_price_mean")}, False
    ),
    "price_rank_in_goods": rank_query(
        {
            f"sku_price_mean_rank_{d}": min_rank("sku_price_mean", d == 0, ", goods_id")
            for d in (0, 1)
        },
        True,
        "goods_id",
    ),
    "slide_rank_in_goods": rank_query(
        {
            f"same_goods_sku_slide_sum_{i}_rank_{d}": min_rank(
                f"goodsale_sku_sum_slide_{i}", d == 0, ", goods_id"
            )
            for i in (7, 27)
            for d in (0, 1)
        },
        True,
        "goods_id",
    ),
    "sku_rank_in_goods": rank_query(
        {
            "rank_sku_sale_day_num_asc": min_rank("sku_id", True, ", goods_id"),
            "rank_sku_sale_day_num_dec": min_rank("sku_id", False, ", goods_id"),
        },
        False,
        "goods_id",
    ),
    "rank_fusion": fusion_sql(),
    "weekly_label": statement(
        f"SELECT window_id, sku_id, {listed(snapped({w: w for w in WEEKS}))} FROM labels_of",
        SALES,
        WINDOWED,
        LABELS,
    ),
    "day_skeleton": statement(
        "SELECT window_id, sku_id, goods_id, data_date FROM skeleton", RELATION, skeleton()
    ),
    "day_skeleton_label": statement(
        f"SELECT window_id, sku_id, goods_id, data_date, {snap('coalesce(u.goods_num, 0)')}"
        " AS goods_num FROM skeleton LEFT JOIN units u USING (sku_id, data_date)",
        SALES,
        RELATION,
        skeleton(),
        DAY_UNITS,
    ),
    "calendar_features": statement(
        "SELECT window_id, sku_id, goods_id, data_date, marketing, plan, holiday_code, "
        f"{listed(CALENDAR_COLUMNS | weather_columns())} FROM skeleton"
        " LEFT JOIN marketing USING (data_date) LEFT JOIN holiday USING (data_date)"
        " LEFT JOIN weather USING (data_date)",
        RELATION,
        skeleton(),
        MARKETING,
        HOLIDAY,
        HOLIDAYS,
        WEATHER_SQL,
    ),
    "calendar_features_repeated": statement(
        f"SELECT window_id, sku_id, goods_id, data_date, holiday_code, {listed(CALENDAR_COLUMNS)}"
        " FROM skeleton LEFT JOIN holiday_rows USING (data_date)",
        RELATION,
        skeleton(),
        HOLIDAY,
    ),
    "day_to_week": statement(
        f"SELECT sku_id, {listed(snapped({w: w for w in WEEKS}))} FROM stand_in", SALES, STAND_IN
    ),
    "resum_weeks": statement(
        f"SELECT sku_id, {listed(snapped({w: f'sum({w})' for w in WEEKS}))} FROM labels_of"
        " GROUP BY sku_id",
        SALES,
        WINDOWED,
        LABELS,
    ),
    "minmax_scale": minmax_sql(),
    "features_slide_rank": slide_rank_sql(),
    "features_sales_only": sales_only_sql(),
    "features_short_slide": short_slide_sql(),
    "features_goods_context": goods_context_sql(),
    "features_linear": linear_sql(),
    "features_granularity": granularity_sql(),
    "features_day_level": day_level_sql(),
    "multi_window_training": training_sql(),
    "multi_window_overlap": overlap_sql(),
    "select_by_gain": stump_sql(),
    "ols_week_two_inputs": week_plane_sql(),
    "ols_day_two_inputs": day_plane_sql(),
    "ols_simple": statement(
        f"SELECT {snap('regr_slope(week1, sale_num)')} AS slope,"
        f" {snap('regr_intercept(week1, sale_num)')} AS intercept FROM labels_of JOIN"
        " (SELECT window_id, sku_id, sum(goods_num) AS sale_num FROM wsales GROUP BY 1, 2)"
        " USING (window_id, sku_id)",
        SALES,
        WINDOWED,
        LABELS,
    ),
}

ORACLES["csv_round_trip"] = ORACLES["scan_goodsale"]
for _rank in ("global_rank_min", "global_rank_avg"):
    ORACLES[f"{_rank}_sliced"] = ORACLES[_rank]

for _name, _columns in NULLABLE_INTEGERS.items():
    _casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _columns)
    ORACLES[_name] = f"SELECT * REPLACE ({_casts}) FROM ({ORACLES[_name]})"
