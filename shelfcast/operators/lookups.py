"""Universes, many-to-one lookups and keep-first de-duplication.

Lookups carry no broadcast hint: relation and goods tables grow with the assortment, so the
join strategy is left to run-time sizes, and a hot goods_id to the adaptive skew-join split.
"""

from pyspark.sql import functions as F


def sku_universe(tagged):
    """Distinct variants with a row in each window."""
    return tagged.select("window_id", "sku_id").distinct()


def forecast_universe(targets, window_id):
    """The submission list as the universe of one window."""
    return targets.select(F.lit(window_id).alias("window_id"), "sku_id")


def attach_goods(universe, relation):
    """Add goods_id by the relation table; unknown variants keep NULL."""
    return universe.join(relation.select("sku_id", "goods_id"), "sku_id", "left").select(
        "window_id", "sku_id", "goods_id"
    )


def attach_by_sku(universe, block):
    return universe.join(block, ["window_id", "sku_id"], "left")


def attach_by_goods(universe, block):
    return universe.join(block, ["window_id", "goods_id"], "left")


def attach_attributes(universe, goodsinfo, columns):
    """Goods attributes (brand, category levels) by goods_id."""
    return universe.join(goodsinfo.select("goods_id", *columns), "goods_id", "left")


def first_per_key(df, key, order, columns):
    """First row per key by `order`, ties by the remaining columns.

    A minimum over structs aggregates before the shuffle, so a hot key needs no window.
    """
    keys = [key] if isinstance(key, str) else list(key)
    picked = F.min(F.struct(*order, *[c for c in columns if c not in order])).alias("first")
    return df.groupBy(*keys).agg(picked).select(*keys, *[f"first.{c}" for c in columns])


def skus_per_goods(tagged):
    """Number of distinct variants sold per goods."""
    return tagged.groupBy("window_id", "goods_id").agg(
        F.count_distinct("sku_id").alias("sku_num")
    )
