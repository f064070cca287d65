"""How quality filters interact, counted on sorted lists of failing documents.

Rows are sorted by part and id and cut into id ranges of one part. A range keeps, per filter,
the sorted list of the rows that fail it, and the lists of labelled rows. Lists are walked
together by galloping: every step takes the ids up to the nearest end of a window, found by
probing with doubled strides and then searching between the last two probes. What a filter
removes after others is the difference of its list and theirs; only sizes leave the range
and are summed over ranges.
"""

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from anemoscope.llm import common

FILTERS = "ABCDE"
#: Rows of one part in an id range at most.
RANGE_ROWS = 65_536
#: Ids of a list taken in one step of a merge at most.
WINDOW = 2_048
#: A text with this share of all rows or more is looked up in a broadcast table, which so
#: has at most as many rows; others are joined.
HOT_TEXTS = 1_000
LEAST_WORDS = 50
BLANK = r"[\x20\x09-\x0D]+"
SIZES_DDL = "part string, before int, filter int, removed bigint, good bigint, toxic bigint, union bigint"
SIZES = pa.schema([
    ("part", pa.string()), ("before", pa.int32()), ("filter", pa.int32()), ("removed", pa.int64()),
    ("good", pa.int64()), ("toxic", pa.int64()), ("union", pa.int64()),
])


# --- Sorted lists ------------------------------------------------------------------------


def gallop(ids: np.ndarray, start: int, bound: int) -> int:
    """The first place from ``start`` on whose id is above ``bound``."""
    stride, low = 1, start
    while low + stride <= len(ids) and ids[low + stride - 1] <= bound:
        low += stride
        stride *= 2
    return low + int(np.searchsorted(ids[low : low + stride], bound, "right"))


def windows(lists: list[np.ndarray]) -> Iterator[list[np.ndarray]]:
    """Slices of all lists by common id ranges, with at most ``WINDOW`` ids of each list."""
    at = [0] * len(lists)
    while any(place < len(ids) for place, ids in zip(at, lists)):
        bound = min(
            ids[min(place + WINDOW, len(ids)) - 1] for place, ids in zip(at, lists) if place < len(ids)
        )
        ends = [gallop(ids, place, bound) for place, ids in zip(at, lists)]
        yield [ids[a:b] for a, b, ids in zip(at, ends, lists)]
        at = ends


def union(lists: list[np.ndarray]) -> np.ndarray:
    """Ids in any of the sorted lists."""
    found = [np.unique(np.concatenate(part)) for part in windows(lists)]
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def difference(first: np.ndarray, others: list[np.ndarray]) -> np.ndarray:
    """Ids of a sorted list that are in none of the others."""
    found = []
    for mine, *theirs in windows([first, *others]):
        left = mine
        for ids in theirs:
            if len(left) and len(ids):
                place = np.minimum(np.searchsorted(ids, left), len(ids) - 1)
                left = left[ids[place] != left]
        found.append(left)
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def common_size(first: np.ndarray, other: np.ndarray) -> int:
    return len(first) - len(difference(first, [other]))


def sizes(lists: list[np.ndarray], good: np.ndarray, toxic: np.ndarray):
    """For every set of filters and a filter outside it: what the filter removes after them."""
    joined = {0: np.zeros(0, np.int64)}
    for before in range(1, 1 << len(lists)):
        joined[before] = union([ids for f, ids in enumerate(lists) if before >> f & 1])
    for before in range(1 << len(lists)):
        for f, ids in enumerate(lists):
            if not before >> f & 1:
                gone = difference(ids, [joined[before]])
                yield (
                    before, f, len(gone), common_size(gone, good), common_size(gone, toxic),
                    len(joined[before | 1 << f]),
                )


def _count_ranges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sizes of every id range, from rows sorted by part and id."""

    def flush(part, failed):
        failed = np.concatenate(failed)
        place = np.arange(len(failed))  # ids in their order, so that equal ids stay apart
        lists = [place[failed >> f & 1 == 1] for f in range(len(FILTERS) + 2)]
        rows = [(part, *row) for row in sizes(lists[:-2], *lists[-2:])]
        return common.batch(SIZES, *map(list, zip(*rows)))

    part, held, count = None, [], 0
    for batch in batches:
        names = batch.column(0).to_pylist()
        failed = batch.column(1).to_numpy(zero_copy_only=False)
        start = 0
        while start < len(names):
            if held and (names[start] != part or count == RANGE_ROWS):
                yield flush(part, held)
                held, count = [], 0
            part, end = names[start], start
            most = min(len(names), start + RANGE_ROWS - count)
            while end < most and names[end] == part:
                end += 1
            held.append(failed[start:end])
            count += end - start
            start = end
    if held:
        yield flush(part, held)


# --- Filters -----------------------------------------------------------------------------


def with_own_failures(rows: DataFrame) -> DataFrame:
    """``failed``: bits of the filters A to D that the column ``text`` fails by itself."""
    capitals = F.char_length("text") - F.char_length(
        F.translate("text", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "")
    )
    # Words are used twice, so they are a step of their own.
    stepwise = (
        rows.withColumn("trimmed", F.btrim("text", F.lit(common.BLANKS)))
        .withColumn("words", F.split("trimmed", BLANK))
        .withColumn("n", F.when(F.col("trimmed") == "", 0).otherwise(F.size("words")))
    )
    fails = [
        F.col("n") < LEAST_WORDS,
        100 * F.size(F.array_distinct("words")) < 65 * F.col("n"),
        100 * capitals > 5 * F.char_length("text"),
        F.col("text").rlike("[#$%&*|]"),
    ]
    bits = [F.when(fail, 1 << f).otherwise(0) for f, fail in enumerate(fails)]
    failed = bits[0].bitwiseOR(bits[1]).bitwiseOR(bits[2]).bitwiseOR(bits[3])
    return stepwise.withColumn("failed", failed).drop("trimmed", "words", "n")


def failures(docs: DataFrame, staging: common.Staging) -> DataFrame:
    """Part, id and failed filters of every row, and whether an earlier row has its text.

    A text is known by its SHA-256 and length. Texts that hold a thousandth of all rows or
    more are looked up in a broadcast table of at most ``HOT_TEXTS`` rows, so no task of the
    join of the others gets more than that share of one text.
    """
    texts = docs.select(
        F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), "doc_id",
        F.coalesce("text", F.lit("")).alias("text"),
    )
    key = F.concat_ws("-", F.sha2(F.col("text").cast("binary"), 256), F.octet_length("text"))
    rows = staging.stage(
        with_own_failures(texts).withColumn("text_key", key).drop("text"), "failures"
    )
    copies = rows.groupBy("text_key").agg(
        F.min("doc_id").alias("first_id"), F.count(F.lit(1)).alias("rows")
    )
    copies = staging.stage(copies.where("rows > 1"), "copies")
    least = max(2, -(-rows.count() // HOT_TEXTS))
    hot = copies.where(F.col("rows") >= least).select("text_key", F.col("first_id").alias("hot_id"))
    others = copies.where(F.col("rows") < least).drop("rows")
    looked = rows.join(F.broadcast(hot), "text_key", "left")
    # Rows of hot texts have their answer: without a key they stay out of the join's tasks.
    is_hot = F.col("hot_id").isNotNull()
    done = looked.where(is_hot).withColumnRenamed("hot_id", "first_id")
    rest = looked.where(~is_hot).drop("hot_id").join(others, "text_key", "left")
    # A null id comes after all others.
    later = F.coalesce(
        F.col("first_id").isNotNull() & (F.col("doc_id").isNull() | (F.col("doc_id") > F.col("first_id"))),
        F.lit(False),
    )
    failed = F.col("failed").bitwiseOR(F.when(later, 1 << FILTERS.index("E")).otherwise(0))
    return done.unionByName(rest).select("part", "doc_id", failed.alias("failed"))


def _never_hot_null(table: DataFrame, name: str) -> DataFrame:
    """Rows without an id match no label; they needn't meet in one task."""
    return table.where(F.col(name).isNotNull())


# --- All orders ----------------------------------------------------------------------------


def _orders() -> Column:
    """Every order of the filters with, at each step, the filter and the set before it."""
    steps = []
    for order in permutations(range(len(FILTERS))):
        name = "".join(FILTERS[f] for f in order)
        for step, f in enumerate(order):
            before = sum(1 << g for g in order[:step])
            steps.append(F.struct(
                F.lit(name).alias("filter_order"), F.lit(step + 1).alias("step"),
                F.lit(f).alias("filter"), F.lit(before).alias("before"),
            ))
    return F.array(*steps)


def audit(docs: DataFrame, labels: DataFrame, staging: common.Staging) -> DataFrame:
    """What each filter does at each step of every order, per part.

    ``docs`` needs ``doc_id``, ``text`` and ``source``, ``labels`` needs ``doc_id``,
    ``quality`` and ``toxic``; other columns are ignored, whatever their names. A null text is
    empty, a null source the part ``''``; a null id is after all others and has no label.
    A document is good or toxic if any label row of its id says so. Rows that share an id
    count one by one, and are no copies of each other. An empty table gives no rows.
    """
    found = staging.stage(failures(docs, staging), "failed")
    totals = found.groupBy("part").agg(F.count(F.lit(1)).alias("rows"))
    flags = _never_hot_null(labels, "doc_id").groupBy("doc_id").agg(
        F.max(F.when(F.col("quality") == 1, 1 << 5).otherwise(0)).alias("good"),
        F.max(F.when(F.col("toxic") == 1, 1 << 6).otherwise(0)).alias("toxic"),
    )
    failing = found.where("failed > 0")
    labelled = _never_hot_null(failing, "doc_id").join(flags, "doc_id", "left")
    unlabelled = failing.where(F.col("doc_id").isNull()).withColumns(
        {"good": F.lit(0), "toxic": F.lit(0)}
    )
    bits = F.col("failed") + F.coalesce("good", F.lit(0)) + F.coalesce("toxic", F.lit(0))
    marked = staging.stage(
        labelled.unionByName(unlabelled).select("part", "doc_id", bits.cast("int").alias("failed")),
        "marked",
    )
    ranges = marked.repartitionByRange("part", "doc_id").sortWithinPartitions("part", "doc_id")
    counted = ranges.select("part", "failed").mapInArrow(_count_ranges, SIZES_DDL)
    sums = counted.groupBy("part", "before", "filter").agg(
        *[F.sum(n).alias(n) for n in ("removed", "good", "toxic", "union")]
    )
    return _by_order(totals, sums)


def _by_order(totals: DataFrame, sums: DataFrame) -> DataFrame:
    """600 rows per part out of the sizes of its 80 pairs of a set and a filter."""
    count = len(FILTERS)
    weight = F.element_at(
        F.array(*[F.lit(factorial(n) * factorial(count - 1 - n)) for n in range(count)]),
        (F.bit_count("before") + 1).cast("int"),
    )
    whole = F.expr(f"{(1 << count) - 1} - shiftleft(1, filter)")
    per_filter = sums.groupBy("part", "filter").agg(
        F.sum(F.when(F.col("before") == 0, F.col("removed"))).alias("failing"),
        F.sum(F.when(F.col("before") == whole, F.col("removed"))).alias("unique_fails"),
        F.sum(weight * F.col("removed")).alias("shapley"),
    )
    steps = totals.select("part", "rows", F.explode(_orders()).alias("s")).select("part", "rows", "s.*")
    joined = steps.join(sums, ["part", "before", "filter"], "left").join(
        per_filter, ["part", "filter"], "left"
    )
    zero = F.lit(0).cast("bigint")

    def or_zero(name):
        return F.coalesce(F.col(name), zero)

    letter = F.substr(F.lit(FILTERS), F.col("filter") + 1, F.lit(1))
    return joined.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"), letter.alias("filter"),
        (F.col("rows") - or_zero("union")).alias("kept"), or_zero("removed").alias("removed"),
        (or_zero("failing") - or_zero("removed")).alias("redundant"),
        or_zero("unique_fails").alias("unique_fails"), or_zero("good").alias("good_lost"),
        or_zero("toxic").alias("toxic_lost"), or_zero("shapley").alias("shapley"),
    )


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The audit of five filters in all 120 orders, for every source."""
    return audit(
        common.table(spark, sf_dir, "documents"), common.table(spark, sf_dir, "labels"),
        common.Staging(spark),
    )
