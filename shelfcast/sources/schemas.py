"""Explicit schemas of the model tables, so no scan has to infer types."""

from pyspark.sql import types as T


def _struct(fields):
    return T.StructType([T.StructField(name, kind) for name, kind in fields])


_INT, _LONG = T.IntegerType(), T.LongType()
_FLOAT, _DOUBLE, _TEXT = T.FloatType(), T.DoubleType(), T.StringType()

CATEGORY_COLUMNS = tuple(f"cat_level{i}_id" for i in range(1, 8))
BEHAVIOUR_MEASURES = ("goods_click", "cart_click", "favorites_click", "sales_uv")
WEATHER_COLUMNS = ("temp_mean", "temp_max", "temp_min", "uv_index_mean", "uv_index_max")

# The column names of the input files.
SCHEMAS = {
    "goodsale": _struct(
        [
            ("data_date", _INT),
            ("goods_id", _LONG),
            ("sku_id", _LONG),
            ("goods_num", _FLOAT),
            ("goods_price", _TEXT),
            ("orginal_shop_price", _TEXT),
        ]
    ),
    "goodsdaily": _struct(
        [("data_date", _INT), ("goods_id", _LONG)]
        + [(c, _FLOAT) for c in (*BEHAVIOUR_MEASURES, "onsale_days")]
    ),
    "goodsinfo": _struct(
        [("goods_id", _LONG), ("brand_id", _LONG)] + [(c, _LONG) for c in CATEGORY_COLUMNS]
    ),
    "goods_sku_relation": _struct([("goods_id", _LONG), ("sku_id", _LONG)]),
    "marketing": _struct([("data_date", _INT), ("marketing", _INT), ("plan", _INT)]),
    "submit_example": _struct(
        [("sku_id", _LONG)] + [(f"week{i}", _DOUBLE) for i in range(1, 6)]
    ),
    "holiday": _struct([("data_date", _INT), ("holiday_code", _INT)]),
    "weather": _struct(
        [("data_date", _INT)]
        + [(c, _INT if c == "uv_index_max" else _DOUBLE) for c in WEATHER_COLUMNS]
    ),
}
