"""Helpers of the tests."""


def rows(df, *order):
    return [tuple(r) for r in df.orderBy(*order).collect()]
