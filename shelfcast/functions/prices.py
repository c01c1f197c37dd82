"""Prices arrive as text with thousands commas, e.g. "1,332.00"."""

from pyspark.sql import functions as F

# Fixed value: what the constant-mode parser yields for prices with a comma in second place.
COMMA_PRICE = 11.0


def parse_price(column):
    """Strip the commas and read a DOUBLE; unreadable text becomes NULL."""
    c = F.col(column) if isinstance(column, str) else column
    return F.replace(c.cast("string"), F.lit(","), F.lit("")).try_cast("double")


def parse_price_const(column):
    """As parse_price, but a comma in the second place yields COMMA_PRICE."""
    c = F.col(column) if isinstance(column, str) else column
    text = c.cast("string")
    return F.when(F.substring(text, 2, 1) == ",", F.lit(COMMA_PRICE)).otherwise(
        text.try_cast("double")
    )
