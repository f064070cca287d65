"""CSV records that go over several lines, cut so that a file can still be read in splits.

A line takes the reader from outside or inside a quoted field to one of the two. Lines
without quotes change nothing; any other line either sets the state, whatever it was, or
turns it round. So the state at a line follows from the last line that set it and the number
of turns since, first within a block of the file, then over its blocks, one row each.

The task that reads a block meets its lines in their order. So the blocks' effects are found in
one reading of the files and their records in the next, and staged once; only the pieces of
records that go from one block into another are shuffled.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from anemoscope import config

PATH = "__path"
#: What a line does to the state, and what a text is: a record, the beginning of one that goes
#: on in the next block, or lines at the start of a block that belong to an earlier one.
NOTHING, INSIDE, OUTSIDE, TURN = 0, 1, 2, 3
RECORD, BEGUN, CARRIED = 0, 1, 2
#: A quoted field from its start, once doubled quotes are taken out.
QUOTED = r'(^|,)"[^"]*"'
OPEN = r'(^|,)"'
#: Stands for a doubled quote; no character of any text.
DOUBLED = "\uffff"
FIELD = f',({DOUBLED}*"[^"]*"[^,]*|[^,]*)'


def _bare(text: Column) -> Column:
    """A record without its doubled quotes and closed quoted fields."""
    return F.regexp_replace(F.replace(text, F.lit('""'), F.lit("")), QUOTED, "$1")


def ends_inside(line: Column) -> Column:
    """Whether a line that starts outside quotes ends inside a quoted field."""
    return F.contains(line, F.lit('"')) & _bare(line).rlike(OPEN)


def fields(record: Column) -> Column:
    """The fields of a record, however many, cut at commas outside quotes.

    A field that begins with a quote goes to the quote that closes it, with doubled quotes
    for one; what follows it up to the comma belongs to the field as it is, as do quotes
    within other fields.
    """
    single = F.replace(F.concat(F.lit(","), record), F.lit('""'), F.lit(DOUBLED))
    cut = F.regexp_extract_all(single, F.lit(FIELD), 1)
    quoted = F.transform(cut, _value)
    return F.when(F.contains(record, F.lit('"')), quoted).otherwise(F.split(record, ","))


def _value(field: Column) -> Column:
    """The value of a field in which doubled quotes are marked from the field's left end."""
    doubled, two = F.lit(DOUBLED), F.lit('""')
    written = F.replace(field, doubled, two)
    # From behind the opening quote on, the first quote that is not doubled closes the field.
    after = F.replace(F.substr(written, F.lit(2)), two, doubled)
    inner = F.substring_index(after, '"', 1)
    rest = F.substr(after, F.length(inner) + 2)
    closed = F.concat(F.replace(inner, doubled, F.lit('"')), F.replace(rest, doubled, two))
    return F.when(F.startswith(written, F.lit('"')), closed).otherwise(written)


def without_return(line: Column) -> Column:
    """A line without the carriage return before its end."""
    return F.when(F.endswith(line, F.lit("\r")), F.substr(line, F.lit(1), F.length(line) - 1)).otherwise(line)


def _state(window, start: Column) -> Column:
    """Inside or outside before each row of a window, from what rows set and turn.

    ``start`` is the state before the first row.
    """
    turns = F.coalesce(F.sum("turns").over(window), F.lit(0))
    last = F.last("set_at", ignorenulls=True).over(window)
    since = F.when(last.isNull(), turns).otherwise(turns - last["turns"])
    return F.coalesce(last["inside"], start) != (since % 2 == 1)


def _effect(value: Column) -> Column:
    """What a line does to the state."""
    from_outside = ends_inside(value)
    from_inside = _bare(F.concat(F.lit('"x'), value)).rlike(OPEN)
    kind = (
        F.when(~F.contains(value, F.lit('"')), NOTHING)
        .when(from_outside & from_inside, INSIDE).when(~from_outside & ~from_inside, OUTSIDE)
        .when(from_outside, TURN).otherwise(NOTHING)
    )
    return kind.cast("byte").alias("effect")


def _states(effects: np.ndarray, inside: bool) -> np.ndarray:
    """Whether each line starts inside a quoted field, and whether the line behind the last would."""
    sets = (effects == INSIDE) | (effects == OUTSIDE)
    turns = np.concatenate(([0], np.cumsum(effects == TURN)))
    last = np.concatenate(([-1], np.maximum.accumulate(np.where(sets, np.arange(len(effects)), -1))))
    base = np.where(last < 0, inside, effects[last] == INSIDE)
    since = turns - np.where(last < 0, 0, turns[last])
    return base ^ (since % 2 == 1)


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], int, int]]:
    """Path and block of lines that follow each other, and where they begin and end."""
    path, block = batch.column(0), batch.column(1).to_numpy(zero_copy_only=False)
    if not len(block):
        return
    other = pc.not_equal(path.slice(1), path.slice(0, len(path) - 1)).to_numpy(zero_copy_only=False)
    bounds = [0, *(np.flatnonzero(other | (np.diff(block) != 0)) + 1).tolist(), len(block)]
    for start, end in zip(bounds[:-1], bounds[1:], strict=True):
        yield (path[start].as_py(), int(block[start])), start, end


def _blocks_of(batches: Iterator[pa.RecordBatch]):
    """What whole blocks do: the state they end in, or else whether they turn it round."""
    at, sets, odd = None, None, 0

    def row():
        columns = [pa.array([at[0]]), pa.array([at[1]], pa.int64()), pa.array([sets], pa.bool_()), pa.array([odd], pa.int64())]
        return pa.RecordBatch.from_arrays(columns, [PATH, "__block", "sets", "turns"])

    for batch in batches:
        effects = batch.column(2).to_numpy(zero_copy_only=False)
        for key, start, end in _runs(batch):
            if key != at:
                if at:
                    yield row()
                at, sets, odd = key, None, 0
            part = effects[start:end]
            known = sets is not None or bool(((part == INSIDE) | (part == OUTSIDE)).any())
            state = bool(_states(part, bool(sets) if sets is not None else odd == 1)[-1])
            sets, odd = (state, 0) if known else (None, int(state))
    if at:
        yield row()


def _records_of(batches: Iterator[pa.RecordBatch]):
    """The records of blocks, and the pieces of those that go from one block into another."""
    at, inside, kind, waiting = None, False, CARRIED, []

    def texts(found, what):
        columns = [pa.repeat(pa.scalar(at[0]), len(found)), pa.repeat(pa.scalar(at[1], pa.int64()), len(found))]
        columns += [pa.repeat(pa.scalar(what, pa.int8()), len(found)), found]
        return pa.RecordBatch.from_arrays(columns, [PATH, "__block", "kind", "value"])

    def ended():
        """The lines that wait, as what they are."""
        if waiting:
            what = CARRIED if kind == CARRIED else BEGUN if inside else RECORD
            yield texts(pa.array(["\n".join(waiting)]), what)
        waiting.clear()

    for batch in batches:
        effects = batch.column(2).to_numpy(zero_copy_only=False)
        values, starts_inside = batch.column(3), batch.column(4)
        for key, start, end in _runs(batch):
            if key != at:
                yield from ended()
                at, inside, kind = key, starts_inside[start].as_py(), CARRIED
            states = _states(effects[start:end], inside)
            begins = np.flatnonzero(~states[:-1])
            first = int(begins[0]) if len(begins) else end - start
            waiting += values.slice(start, first).to_pylist()
            if len(begins):
                inside = False
                yield from ended()
                kind = RECORD
                # The last one may go on with the next lines.
                last = int(begins[-1])
                if len(begins) > 1:
                    lists = pa.ListArray.from_arrays(
                        pa.array(begins - first, pa.int32()), values.slice(start + first, last - first)
                    )
                    yield texts(pc.binary_join(lists, "\n"), RECORD)
                waiting += values.slice(start + last, end - start - last).to_pylist()
            inside = bool(states[-1])
    yield from ended()


def assemble(lines: DataFrame, workspace) -> tuple[DataFrame, DataFrame]:
    """The records of files, and the files that end inside a quoted field.

    ``lines`` has a path, the start of the block it lies in, a number that grows within the
    block, and a text; the lines of a block follow each other in one partition. Line ends
    inside a record come out as line feeds. A record that begins in one block and ends in
    another belongs to the first. No more than the lines of one record, and one row per block
    of a file, meet in one place beside the lines of a block.
    """
    steps = lines.select(PATH, "__block", _effect(F.col("value")), "value", "__line")
    ends = steps.select(PATH, "__block", "effect").mapInArrow(
        _blocks_of, f"{PATH} string, __block bigint, sets boolean, turns bigint"
    )
    by_file = Window.partitionBy(PATH).orderBy("__block")
    total = F.sum("turns").over(by_file.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    ends = ends.withColumn("total", total).withColumn(
        "set_at", F.when(F.col("sets").isNotNull(), F.struct(F.col("sets").alias("inside"), F.col("total").alias("turns")))
    )
    started = _state(by_file.rowsBetween(Window.unboundedPreceding, -1), F.lit(False))
    ends = ends.withColumn("starts_inside", started)
    after = F.when(F.col("sets").isNotNull(), F.col("sets")).otherwise(
        F.col("starts_inside") != (F.col("turns") % 2 == 1)
    )
    ends = workspace.stage(ends.withColumn("ends_inside", after), "blocks")
    unclosed = ends.groupBy(PATH).agg(F.max_by("ends_inside", "__block").alias("unclosed"))

    inside = ends.where("starts_inside").select(PATH, "__block", "starts_inside")
    if inside.count() <= config.BROADCAST_ROWS:
        steps = steps.join(F.broadcast(inside), [PATH, "__block"], "left")
    else:
        steps = in_order(steps.join(inside, [PATH, "__block"], "left"))
    steps = steps.select(PATH, "__block", "effect", "value", F.coalesce("starts_inside", F.lit(False)))
    schema = f"{PATH} string, __block bigint, kind byte, value string"
    columns = [PATH, "__block", "value"]
    found = workspace.stage(steps.mapInArrow(_records_of, schema), "found")
    pieces = found.where(F.col("kind") != RECORD)
    # Carried lines belong to the last record begun before them, if that ever ends.
    begun = F.last(F.when(F.col("kind") == BEGUN, F.col("__block")), ignorenulls=True).over(
        Window.partitionBy(PATH).orderBy("__block", F.desc("kind"))
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    places = pieces.select(PATH, "__block", "kind", begun.alias("at"))
    places = places.join(unclosed.where("unclosed").select(PATH), PATH, "left_anti")
    placed = pieces.join(places, [PATH, "__block", "kind"])
    whole = placed.groupBy(PATH, "at").agg(F.array_sort(F.collect_list(F.struct("__block", "value"))).alias("pieces"))
    text = F.array_join(F.transform("pieces", lambda piece: piece["value"]), "\n")
    whole = whole.select(PATH, F.col("at").alias("__block"), text.alias("value"))
    return found.where(F.col("kind") == RECORD).select(*columns).unionByName(whole), unclosed


def in_order(lines: DataFrame) -> DataFrame:
    """Lines that were shuffled, as their blocks have them."""
    return lines.repartition(PATH, "__block").sortWithinPartitions(PATH, "__block", "__line")
