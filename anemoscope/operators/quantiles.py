"""Exact quantiles of groups of any size.

Spark's ``percentile`` keeps every distinct value of a group in one buffer.
That is used while the largest group is small. For larger groups a sketch gives
a narrow bracket around each wanted rank, one scan counts the values below and
inside it, and only the values inside are ranked. Brackets that still hold many
distinct values are cut into pieces until the piece with the rank is small, so
no task ever holds a whole group and the result stays exact.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from anemoscope import config
from anemoscope.functions.text import col
from anemoscope.operators.lookup import attach, with_values
from anemoscope.sources.storage import Workspace

SKETCH_ACCURACY = 10_000
BRACKET_HALF_WIDTH = 2 / SKETCH_ACCURACY
PIECES = 64
SMALL_BRACKET = 100_000


def exact_quantiles(
    table: DataFrame,
    keys: list[str],
    columns: list[str],
    probabilities: list[float],
    largest_group: int | None = None,
    groups: int | None = None,
    workspace: Workspace | None = None,
    buffer_rows: int | None = None,
) -> DataFrame:
    """Linearly interpolated quantiles: per group, one array per column.

    ``largest_group`` and ``groups`` save their counts when the caller knows an
    upper bound of the rows in any group and of the number of groups.
    A column without values has a NULL array.
    """
    buffer_rows = config.QUANTILE_BUFFER_ROWS if buffer_rows is None else buffer_rows
    if largest_group is None:
        largest_group = _largest_group(table, keys)
    if largest_group <= buffer_rows:
        return table.groupBy(*keys).agg(*buffered(columns, probabilities))
    workspace = workspace or Workspace(table.sparkSession)
    targets = [
        _Target(column, index, probability, i * len(probabilities) + index)
        for i, column in enumerate(columns)
        for index, probability in enumerate(probabilities)
    ]
    if keys:
        return _of_groups(table, keys, columns, targets, groups, workspace, buffer_rows)
    return _of_all(table, columns, targets, workspace, buffer_rows)


def buffered(columns: list[str], probabilities: list[float]) -> list[Column]:
    """The aggregates for groups that fit one buffer."""
    wanted = F.array(*[F.lit(p) for p in probabilities])
    return [F.percentile(col(c), wanted).alias(c) for c in columns]


def _largest_group(table: DataFrame, keys: list[str]) -> int:
    if not keys:
        return table.count()
    sizes = table.groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    return sizes.agg(F.max("rows")).first()[0] or 0


class _Target:
    """One quantile of one column, and the names of its helper columns."""

    def __init__(self, column: str, index: int, probability: float, sequence: int):
        self.column, self.index, self.probability = column, index, probability
        self.id = sequence
        self.low, self.high = f"__low{sequence}", f"__high{sequence}"
        self.below, self.position = f"__below{sequence}", f"__position{sequence}"
        self.inside = f"__inside{sequence}"

    def holds(self) -> Column:
        return col(self.column).between(F.col(self.low), F.col(self.high))


def _of_groups(table, keys, columns, targets, groups, workspace, buffer_rows):
    # Staged, because evaluating a sketch again may give another bracket.
    sketch = workspace.stage(_sketch(table, keys, columns, targets), "sketch")
    groups = sketch.count() if groups is None else groups
    counted = _checked_brackets(attach(table, sketch, keys, "left", groups), keys, targets)
    brackets = workspace.stage(counted, "brackets")
    most = F.greatest(*[F.coalesce(t.inside, F.lit(0)) for t in targets], F.lit(0))
    most_inside = brackets.agg(F.max(most)).first()[0] or 0
    values = _values_inside(attach(table, brackets, keys, "left", groups), keys, targets)
    values = _small_brackets(values, keys, most_inside, workspace, buffer_rows)
    picked = workspace.stage(_picked(values, keys, targets, columns), "picked")
    return attach(brackets.select(*[col(k) for k in keys]), picked, keys, "left", groups)


def _of_all(table, columns, targets, workspace, buffer_rows):
    sketch: Row = _sketch(table, [], columns, targets).first()
    brackets: Row = _checked_brackets(with_values(table, sketch), [], targets).first()
    most_inside = max(brackets[t.inside] or 0 for t in targets)
    values = _values_inside(with_values(table, brackets), [], targets)
    values = _small_brackets(values, [], most_inside, workspace, buffer_rows)
    return _picked(values, [], targets, columns)


def _small_brackets(values, keys, most_inside, workspace, buffer_rows):
    """Cut brackets until the distinct values of each fit one task."""
    limit = max(buffer_rows, SMALL_BRACKET)
    if most_inside <= limit:  # its rows bound its distinct values
        return values
    values = workspace.stage(values, "values")
    while _largest_bracket(values, keys) > limit:
        values = workspace.stage(_narrowed(values, keys, workspace), "values")
    return values


def _sketch(table, keys, columns, targets):
    aggregates = []
    for i, column in enumerate(columns):
        aggregates += [
            F.count(col(column)).alias(f"__count{i}"),
            F.min(col(column)).alias(f"__min{i}"),
            F.max(col(column)).alias(f"__max{i}"),
        ]
        ends = []
        for target in (t for t in targets if t.column == column):
            ends.append(max(0.0, target.probability - BRACKET_HALF_WIDTH))
            ends.append(min(1.0, target.probability + BRACKET_HALF_WIDTH))
        aggregates.append(
            F.percentile_approx(
                col(column), [float(end) for end in ends], SKETCH_ACCURACY
            ).alias(f"__ends{i}")
        )
    sketched = table.groupBy(*keys).agg(*aggregates)
    kept = [col(k) for k in keys]
    for target in targets:
        i = columns.index(target.column)
        position = F.lit(target.probability) * (F.col(f"__count{i}") - 1)
        kept += [
            F.col(f"__ends{i}")[2 * target.index].alias(target.low),
            F.col(f"__ends{i}")[2 * target.index + 1].alias(target.high),
            position.alias(target.position),
        ]
    for i in range(len(columns)):
        kept += [F.col(f"__min{i}"), F.col(f"__max{i}")]
    return sketched.select(*kept)


def _checked_brackets(rows, keys, targets):
    """Count around each bracket; widen an end that misses its rank."""
    columns = list(dict.fromkeys(t.column for t in targets))
    aggregates = []
    for target in targets:
        below = F.count_if(col(target.column) < F.col(target.low))
        aggregates += [
            below.alias(target.below),
            F.count_if(target.holds()).alias(target.inside),
            F.count(col(target.column)).alias(f"__rows{target.id}"),
        ]
        aggregates += [
            F.max(name).alias(name)
            for name in (target.low, target.high, target.position)
        ]
    for i in range(len(columns)):
        aggregates += [F.max(f"__{end}{i}").alias(f"__{end}{i}") for end in ("min", "max")]
    counted = rows.groupBy(*keys).agg(*aggregates)
    kept = [col(k) for k in keys]
    for target in targets:
        i = columns.index(target.column)
        below, position = F.col(target.below), F.col(target.position)
        covered = below + F.col(target.inside)
        missed = F.col(f"__rows{target.id}")
        starts = below <= F.floor(position)
        ends = covered > F.ceil(position)
        kept += [
            F.when(starts, F.col(target.low)).otherwise(F.col(f"__min{i}")).alias(target.low),
            F.when(ends, F.col(target.high)).otherwise(F.col(f"__max{i}")).alias(target.high),
            F.when(starts, below).otherwise(F.lit(0)).cast("bigint").alias(target.below),
            F.when(starts & ends, F.col(target.inside)).otherwise(missed).alias(target.inside),
            position.alias(target.position),
        ]
    return counted.select(*kept)


_BRACKET = ["__target", "__below", "__position"]


def _values_inside(rows, keys, targets):
    """Distinct values inside each bracket, with how often they occur."""
    entries = [
        F.when(
            target.holds(),
            F.struct(
                F.lit(target.id).alias("__target"),
                F.col(target.below).alias("__below"),
                F.col(target.position).alias("__position"),
                col(target.column).alias("__value"),
            ),
        )
        for target in targets
    ]
    inside = rows.filter(reduce(lambda a, b: a | b, [t.holds() for t in targets]))
    entry = F.explode(F.array_compact(F.array(*entries))).alias("__entry")
    exploded = inside.select(*[col(k) for k in keys], entry).select(
        *[col(k) for k in keys], "__entry.*"
    )
    grouped = exploded.groupBy(*[col(k) for k in keys], *_BRACKET, "__value")
    return grouped.agg(F.count(F.lit(1)).alias("__times"))


def _largest_bracket(values, keys) -> int:
    sizes = values.groupBy(*[col(k) for k in keys], "__target").agg(
        F.count(F.lit(1)).alias("__distinct")
    )
    return sizes.agg(F.max("__distinct")).first()[0] or 0


def _narrowed(values, keys, workspace):
    """Keep, of each bracket, the piece or two that hold the wanted rank."""
    bracket = [*keys, "__target"]
    cuts = [i / PIECES for i in range(1, PIECES)]
    bounds = values.groupBy(*[col(k) for k in bracket]).agg(
        F.percentile_approx("__value", cuts, SKETCH_ACCURACY).alias("__cuts")
    )
    bounds = workspace.stage(bounds, "cuts")
    piece = F.size(F.filter("__cuts", lambda cut: cut < F.col("__value")))
    cut = attach(values, bounds, bracket).withColumn("__piece", piece).drop("__cuts")
    cut = workspace.stage(cut, "pieces")
    sizes = cut.groupBy(*[col(k) for k in [*keys, *_BRACKET]], "__piece").agg(
        F.sum("__times").alias("__size")
    )
    along = Window.partitionBy(*[col(k) for k in bracket]).orderBy("__piece")
    end = F.col("__below") + F.sum("__size").over(along)
    wanted = sizes.withColumn("__end", end).filter(
        (F.col("__end") > F.floor("__position"))
        & (F.col("__end") - F.col("__size") <= F.ceil("__position"))
    )
    start = F.min(F.col("__end") - F.col("__size")).over(
        Window.partitionBy(*[col(k) for k in bracket])
    )
    wanted = wanted.withColumn("__start", start).select(
        *[col(k) for k in bracket], "__piece", "__start"
    )
    kept = attach(
        cut, workspace.stage(wanted, "wanted"), [*bracket, "__piece"], "inner"
    )
    return kept.select(
        *[col(k) for k in keys],
        "__target",
        F.col("__start").alias("__below"),
        "__position",
        "__value",
        "__times",
    )


def _picked(values, keys, targets, columns):
    """Interpolate between the two neighbouring ranks of each target."""
    along = Window.partitionBy(*[col(k) for k in keys], "__target").orderBy("__value")
    upto = F.col("__below") + F.sum("__times").over(along)
    ranked = values.withColumn("__upto", upto)
    low, high = F.floor("__position"), F.ceil("__position")
    ends = ranked.groupBy(*[col(k) for k in keys], "__target", "__position").agg(
        F.min(F.when(F.col("__upto") > low, F.col("__value"))).alias("__first"),
        F.min(F.when(F.col("__upto") > high, F.col("__value"))).alias("__second"),
    )
    between = (high - F.col("__position")) * F.col("__first") + (
        F.col("__position") - low
    ) * F.col("__second")
    value = F.when(low == high, F.col("__first")).otherwise(between)
    arrays = []
    for column in columns:
        quantiles = [
            F.max(F.when(F.col("__target") == target.id, F.col("__quantile")))
            for target in targets
            if target.column == column
        ]
        found = quantiles[0].isNotNull()
        arrays.append(F.when(found, F.array(*quantiles)).alias(column))
    quantile = ends.withColumn("__quantile", value)
    return quantile.groupBy(*[col(k) for k in keys]).agg(*arrays)
