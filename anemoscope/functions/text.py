"""Missing-value tokens and column references."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from anemoscope import config


def col(name: str) -> Column:
    """Column by its exact name, whatever characters it holds."""
    return F.col("`" + name.replace("`", "``") + "`")


def na_to_null(text: Column) -> Column:
    """NULL for every token that stands for a missing value."""
    return F.when(~text.isin(config.NA_TOKENS), text)
