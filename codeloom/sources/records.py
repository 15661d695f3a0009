"""Records of delimited text whose quoted fields may hold line breaks, found by many tasks at once.

Whether a line break ends a record depends on all text before it, but a line can only be entered in two ways: outside quotes or
inside a quoted field. Each line is therefore a map of two entries to two exits. The maps of a byte range compose to one map, a prefix
scan over the ranges of a file tells how each range is entered, and then every range cuts its own lines into records. What is left
open at the end of a range and closed in a later one is put together from those pieces; they are few, one or two a range.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codeloom.session import settle

# Ranges that begin inside a quoted field are sent to all tasks up to this number (each a path and an offset); beyond, lines are shuffled.
BROADCAST_RANGES = 50_000

# From outside: whole fields, then one that opens a quote and does not close it. Possessive repeats: linear, no recursion.
_INSIDE = r'[^"]*+(?:""[^"]*+)*+'
_OPENS = rf'(?:(?:"{_INSIDE}"[^,]*+|[^",][^,]*+|),)*+"{_INSIDE}'

_WHOLE, _END, _MIDDLE, _BEGIN = range(4)


def exits(line: Column) -> tuple[Column, Column]:
    """How a line is left (0 outside, 1 inside quotes) if it is entered outside, and if it is entered inside."""
    outside = line.rlike(rf"^{_OPENS}\z")
    inside = line.rlike(rf'^{_INSIDE}(?:"[^,]*+,{_OPENS})?+\z')
    return outside.cast("int"), inside.cast("int")


def lines_of(spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8") -> DataFrame:
    """Lines with their file, the start of their byte range and both exits; files are split as Spark splits text.

    Any encoding that writes quotes, commas and line breaks as ASCII does.
    """
    text = F.make_valid_utf8("value") if encoding == "UTF-8" else F.decode(F.col("value").cast("binary"), encoding)
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range"),
        F.monotonically_increasing_id().alias("line"), text.alias("value"),
    )
    outside, inside = exits(F.col("value"))
    return lines.withColumns({"outside": outside, "inside": inside})


def _states(outside: np.ndarray, inside: np.ndarray, entered: int) -> np.ndarray:
    """How each line is entered, and at last how the lines are left. A line keeps the state, turns it, or sets it."""
    turns = np.r_[0, np.cumsum((outside == 1) & (inside == 0))]
    sets = np.flatnonzero(outside == inside)
    last = np.searchsorted(sets, np.arange(len(outside) + 1)) - 1
    at = sets[last] if len(sets) else last
    value = np.where(last >= 0, outside[at] if len(sets) else 0, entered)
    return (value + turns - np.where(last >= 0, turns[at], 0)) % 2


def _runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Parts of a batch that lie in one byte range."""
    if not batch.num_rows:
        return
    files, ranges = batch.column("file").dictionary_encode().indices.to_numpy(), batch.column("range").to_numpy()
    cuts = np.flatnonzero((files[1:] != files[:-1]) | (ranges[1:] != ranges[:-1])) + 1
    for low, high in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows]):
        yield (batch.column("file")[low].as_py(), batch.column("range")[low].as_py()), batch.slice(low, high - low)


def _composed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One map for each byte range."""
    def row() -> pa.RecordBatch:
        values = ([key[0]], pa.string()), ([key[1]], pa.int64()), ([left[0]], pa.int32()), ([left[1]], pa.int32())
        return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in values], names=["file", "range", "outside", "inside"])

    key, left = None, [0, 1]
    for batch in batches:
        for own, part in _runs(batch):
            if own != key:
                if key is not None:
                    yield row()
                key, left = own, [0, 1]
            lines = part.column("outside").to_numpy(), part.column("inside").to_numpy()
            left = [int(_states(*lines, s)[-1]) for s in left]
    if key is not None:
        yield row()


def entered_inside(ranges: DataFrame) -> DataFrame:
    """The ranges (file, range) that begin inside quotes: a prefix scan over the maps of a file's ranges."""
    before = Window.partitionBy("file").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    turn = ((F.col("outside") == 1) & (F.col("inside") == 0)).cast("int")
    counted = ranges.withColumn("turns", F.coalesce(F.sum(turn).over(before), F.lit(0)))
    fixed = F.when(F.col("outside") == F.col("inside"), F.struct("outside", "turns"))
    placed = counted.withColumn("fixed", F.last(fixed, ignorenulls=True).over(before))
    state = F.when(F.col("fixed").isNull(), F.col("turns")).otherwise(F.col("fixed.outside") + F.col("turns") - F.col("fixed.turns"))
    return placed.filter(state % 2 == 1).select("file", "range")


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records of each byte range, and the pieces of records at its ends."""
    names = ["file", "range", "line", "part", "value"]
    types = pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.string()
    key, first, state, begun, held = None, 0, 0, False, []

    def made(own: tuple[str, int], rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
        columns = [[own[0]] * len(rows), [own[1]] * len(rows), *map(list, zip(*rows))]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    def rest() -> list[tuple[int, int, str]]:
        return [(held[0][0], _BEGIN if begun else _MIDDLE, "\n".join(v for _, v in held))] if held else []

    for batch in batches:
        for own, part in _runs(batch):
            if own != key:
                if key is not None and held:
                    yield made(key, rest())
                key, first, state, begun, held = own, part.column("line")[0].as_py(), int(part.column("entered")[0].as_py()), False, []
            # From here on lines are numbered within their range.
            part = part.set_column(part.schema.get_field_index("line"), "line", pc.subtract(part.column("line"), first))
            states = _states(part.column("outside").to_numpy(), part.column("inside").to_numpy(), state)
            state = int(states[-1])
            single = (states[:-1] == 0) & (states[1:] == 0)
            # Lines that are a record each pass on as they are.
            whole = part.filter(pa.array(single))
            if whole.num_rows:
                parts = pa.array(np.full(whole.num_rows, _WHOLE, np.int32))
                yield pa.RecordBatch.from_arrays([*(whole.column(c) for c in names[:3]), parts, whole.column("value")], names=names)
            several = np.flatnonzero(~single)
            rows = []
            if len(several):
                pieces = part.take(pa.array(several))
                for line, value, enters, leaves in zip(
                    pieces.column("line").to_pylist(), pieces.column("value").to_pylist(), states[several].tolist(), states[several + 1].tolist(),
                ):
                    if enters == 0:
                        begun = True
                    held.append((line, value))
                    if leaves == 0:
                        rows.append((held[0][0], _WHOLE if begun else _END, "\n".join(v for _, v in held)))
                        begun, held = False, []
            if rows:
                yield made(own, rows)
    if held:
        yield made(key, rest())


def read_records(
    spark: SparkSession, path: str | Sequence[str], encoding: str = "UTF-8", broadcast_ranges: int = BROADCAST_RANGES
) -> DataFrame:
    """Columns file, range, line and value, one row per record of delimited text files.

    ``range`` is the byte where the range of the record's first line begins, ``line`` that line's number in it; their sum grows with the
    records of a file.

    A record ends at a line break outside quotes. A field is quoted if it begins with a quote; in other fields quotes are text, as is
    what follows a closing quote up to the next comma. A quote that is never closed reaches to the end of its file. Blank records
    are left out, bytes that are no UTF-8 become the replacement character, and the records are written to the shared folder once.
    """
    lines = lines_of(spark, path, encoding)
    ranges = lines.select("file", "range", "outside", "inside").mapInArrow(_composed, "file string, range long, outside int, inside int")
    inside = settle(entered_inside(ranges)).select(F.col("file").alias("_file"), F.col("range").alias("_range"), F.lit(1).alias("entered"))
    few = inside.count() <= broadcast_ranges
    same = (F.col("file") == F.col("_file")) & (F.col("range") == F.col("_range"))
    known = lines.join(F.broadcast(inside) if few else inside, same, "left").drop("_file", "_range").fillna(0, ["entered"])
    if not few:
        known = known.repartition("file", "range").sortWithinPartitions("file", "range", "line")
    cut = settle(known.mapInArrow(_cut, "file string, range long, line long, part int, value string"))
    pieces = cut.filter(F.col("part") != _WHOLE)
    order = Window.partitionBy("file").orderBy("range", "line")
    numbered = pieces.withColumn("record", F.sum((F.col("part") == _BEGIN).cast("int")).over(order))
    joined = numbered.groupBy("file", "record").agg(F.array_sort(F.collect_list(F.struct("range", "line", "value"))).alias("p")).select(
        "file", F.col("p")[0]["range"].alias("range"), F.col("p")[0]["line"].alias("line"),
        F.array_join(F.transform("p", lambda x: x["value"]), "\n").alias("value"),
    )
    records = cut.filter(F.col("part") == _WHOLE).select("file", "range", "line", "value").unionByName(joined)
    return records.filter(F.length(F.rtrim(F.regexp_replace("value", r"\r$", ""))) > 0)
