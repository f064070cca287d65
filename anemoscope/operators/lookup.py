"""Adding the columns of a small per-group table to a large one."""

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.functions.text import col


def with_values(rows: DataFrame, values: Row) -> DataFrame:
    """Add one row of values, the lookup of a table without groups."""
    named = [F.lit(value).alias(name) for name, value in values.asDict().items()]
    return rows.select("*", *named)


def attach(
    rows: DataFrame,
    lookup: DataFrame,
    keys: list[str],
    how: str = "left",
    lookup_rows: int | None = None,
    weight: str | None = None,
    per_salt: int | None = None,
) -> DataFrame:
    """Join a staged one-row-per-group table to the rows of its groups.

    The table is broadcast only if its rows, counted here unless the caller
    already has an upper bound of them, stay within the limit. Beyond it both
    sides are shuffled. A column ``weight`` of the table, which is not joined, says how much
    a group holds; groups are spread over a task for each ``per_salt`` of it. Without
    weights all groups are spread alike.
    """
    if lookup_rows is None:
        lookup_rows = lookup.count()
    if lookup_rows <= config.BROADCAST_ROWS:
        return rows.join(F.broadcast(lookup.drop(*[weight] if weight else [])), keys, how)
    spread = F.xxhash64(*[col(c) for c in rows.columns])
    if weight is None:
        salted = rows.withColumn("__salts", F.lit(config.SALTS))
        lookup = lookup.withColumn("__salts", F.lit(config.SALTS))
    else:
        lookup = _with_salts(lookup, weight, per_salt or config.ROWS_PER_SALT)
        # Only so few groups have more than one salt that they can be broadcast.
        heavy = lookup.filter("__salts > 1").select(*keys, "__salts")
        salted = rows.join(F.broadcast(heavy), keys, "left").fillna(1, ["__salts"])
    salted = salted.withColumn("__salt", F.pmod(spread, F.col("__salts")).cast("int")).drop("__salts")
    salts = F.explode(F.sequence(F.lit(0), F.col("__salts").cast("int") - 1))
    return salted.join(lookup.withColumn("__salt", salts).drop("__salts"), [*keys, "__salt"], how).drop("__salt")


def _with_salts(lookup: DataFrame, weight: str, per_salt: int) -> DataFrame:
    """As many salts for a group as it has units, with units large enough for few such groups."""
    total = lookup.agg(F.sum(weight)).first()[0] or 0
    unit = max(per_salt, -(-total // config.SPREAD_GROUPS))
    salts = F.greatest(F.lit(1), F.ceil(F.col(weight) / unit)).cast("bigint")
    return lookup.withColumn("__salts", salts).drop(weight)
