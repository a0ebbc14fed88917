"""Small text expressions shared by the other modules."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters a JVM string trim removes: code points 0 to 32.
_CONTROLS_AND_SPACE = "".join(map(chr, range(33)))


def flatten_whitespace(text: Column) -> Column:
    """Line feed, carriage return and tab become one space each."""
    return F.translate(text, "\n\r\t", "   ")


def trim_controls(text: Column) -> Column:
    """Cut control characters and spaces off both ends."""
    return F.btrim(text, F.lit(_CONTROLS_AND_SPACE))
