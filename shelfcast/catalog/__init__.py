"""Every operator as a query over the test tables, with its SQL twin."""

_CALENDAR = ("marketing", "plan", "holiday_code", "uv_index_max")

# Integer columns with gaps, compared as DOUBLE, the type that clients give them.
NULLABLE_INTEGERS = {
    "goodsdaily_slide_count": tuple(
        f"{measure}_count_slide_{i}"
        for measure in ("goods_click", "cart_click", "favorites_click", "sales_uv")
        for i in (1, 3, 7, 9, 12)
    ),
    "multi_window_overlap": ("goodsale_sku_count_slide_7", "goodsale_sku_count_slide_90"),
    "calendar_features": _CALENDAR,
    "calendar_features_repeated": ("holiday_code",),
    "features_granularity": ("max_sub_last", "sku_sale_day_num"),
    "features_day_level": _CALENDAR,
}
