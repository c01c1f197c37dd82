"""Ratios, fills, clamps and rounding of forecasts."""

from pyspark.sql import functions as F

WEEKS = ("week1", "week2", "week3", "week4", "week5")


def ratio(top, bottom):
    """Quotient, NULL where the divisor is zero or missing."""
    top = F.col(top) if isinstance(top, str) else top
    bottom = F.col(bottom) if isinstance(bottom, str) else bottom
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def sql_ratio(top, bottom):
    """The quotient as SQL text, for expressions built in bulk."""
    return f"try_divide(cast({top} AS double), cast({bottom} AS double))"


def clamp(column, mode="zero_null"):
    """Raise negative forecasts to zero.

    keep_null  NULL stays NULL;  zero_null  NULL becomes 0;
    round      NULL stays NULL, other values are rounded half to even.
    """
    c = F.col(column) if isinstance(column, str) else column
    if mode == "keep_null":
        return F.when(c < 0, F.lit(0.0)).otherwise(c)
    if mode == "zero_null":
        return F.when(c > 0, c).otherwise(F.lit(0.0))
    if mode == "round":
        return F.when(c < 0, F.lit(0.0)).otherwise(F.bround(c, 0))
    raise ValueError(f"unknown clamp mode {mode!r}")


def clamp_weeks(forecast, mode="zero_null", weeks=WEEKS):
    """Clamp the week columns only; keys are left alone."""
    return forecast.withColumns({w: clamp(w, mode) for w in weeks})


def reverse_weeks(forecast, weeks=WEEKS):
    """Swap the week columns end to end (1 with 5, 2 with 4)."""
    mirrored = dict(zip(weeks, reversed(weeks)))
    return forecast.select(
        *[F.col(mirrored[c]).alias(c) if c in mirrored else F.col(c) for c in forecast.columns]
    )


def fill_missing(df, value, columns=None, as_float=False):
    """Fill the given columns (all but the keys by default); as_float narrows them to FLOAT."""
    keys = {"window_id", "sku_id", "goods_id", "data_date"}
    chosen = set(df.columns) - keys if columns is None else set(columns)
    kind = "float" if as_float else "double"
    return df.selectExpr(
        *[
            f"coalesce(cast({c} AS {kind}), cast({value} AS {kind})) AS {c}" if c in chosen else c
            for c in df.columns
        ]
    )


def minmax_scale(train, test, columns):
    """Min-max scaling over the union of both sets; constant columns become NULL.

    The bounds are one aggregate row, injected as a scalar subquery, so no rows are shuffled.
    """
    both = train.withColumn("is_train", F.lit(True)).unionByName(
        test.withColumn("is_train", F.lit(False)), allowMissingColumns=True
    )
    bounds = both.agg(
        F.struct(
            *[F.min(c).cast("double").alias(f"lo_{c}") for c in columns],
            *[F.max(c).cast("double").alias(f"hi_{c}") for c in columns],
        ).alias("bounds")
    ).scalar()
    return both.withColumn("bounds", bounds).select(
        *[
            ratio(
                F.col(c).cast("double") - F.col(f"bounds.lo_{c}"),
                F.col(f"bounds.hi_{c}") - F.col(f"bounds.lo_{c}"),
            ).alias(c)
            if c in columns
            else F.col(c)
            for c in both.columns
        ]
    )
