"""Small text helpers shared by the column functions."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The code points with the Unicode White_Space property.
WHITE_SPACE = (
    "\t\n\x0b\x0c\r \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def trimmed(value: Column | str) -> Column:
    """Strip every kind of white space from both ends.

    Text that starts and ends with visible ASCII, nearly all of it, is passed through unsearched.
    """
    text = as_column(value)
    clean = text.rlike(r"(?s)^[!-~](?:.*[!-~])?$")
    return F.when(clean, text).otherwise(F.btrim(text, F.lit(WHITE_SPACE)))


def is_blank(value: Column | str) -> Column:
    """True for null, empty and all-white-space text."""
    text = as_column(value)
    empty = ~text.rlike("[!-~]") & (F.btrim(text, F.lit(WHITE_SPACE)) == "")
    return F.coalesce(empty, F.lit(True))


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` applied to a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def once(df: DataFrame, name: str, value: Column) -> DataFrame:
    """Adds a column that is worked out once per row, however often later steps name it.

    A plain projection would be copied into every later filter and expression that uses it. The
    one-element generator is the built-in operator the optimizer does not look through.
    """
    return df.select("*", F.explode_outer(F.array(value)).alias(name))


def non_empty(value: Column | str) -> Column:
    """The text itself, or null when it is empty."""
    return F.nullif(as_column(value), F.lit(""))
