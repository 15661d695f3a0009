"""Comma-separated lines whose two description fields may hold unquoted commas."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from codeloom.functions.text import as_col
from codeloom.sources import records

# The first six fields are always sound, two descriptions follow, the rest is sound again.
FRONT = 6
DESCRIPTIONS = 2

# A field after a comma: a fully quoted one (doubled quotes inside) or anything up to the next comma.
# Possessive repeats keep the match linear and free of recursion on long fields.
_FIELD = r',("[^"]*+(?:""[^"]*+)*+"(?=,|$)|[^,]*)'


def clean_line(value: Column | str) -> Column:
    """Without NUL characters and without the carriage return of a DOS line end."""
    return F.regexp_replace(F.replace(as_col(value), F.lit("\x00"), F.lit("")), r"\r$", "")


def split_line(value: Column | str) -> Column:
    """Fields of a line; quoted fields lose their quotes."""
    fields = F.regexp_extract_all(F.concat(F.lit(","), as_col(value)), F.lit(_FIELD), F.lit(1))
    return F.transform(
        fields,
        lambda f: F.when(
            (F.length(f) >= 2) & f.startswith('"') & f.endswith('"'),
            F.replace(f.substr(F.lit(2), F.length(f) - 2), F.lit('""'), F.lit('"')),
        ).otherwise(f),
    )


def _split_once(lines: DataFrame, line: str, carry: Sequence[str]) -> DataFrame:
    """Fields as ``_f`` and their number as ``_n``. Going through a generator keeps later filters on the
    fields from being pushed into the scan, which would split every line a second time."""
    fields = F.explode(F.array(split_line(clean_line(line))))
    return lines.select(*carry, F.col(line).alias("_line"), fields.alias("_f")).withColumn("_n", F.size("_f"))


def _parts(lines: DataFrame, names: Sequence[str], line: str, carry: Sequence[str], skip_header: bool) -> DataFrame:
    parts = _split_once(lines, line, carry)
    if skip_header:
        heading = F.array(*[F.lit(n) for n in names])
        parts = parts.filter(~((F.col("_n") == len(names)) & (F.transform("_f", lambda f: F.trim(f)) == heading)))
    return parts


def _cells(names: Sequence[str]) -> dict[str, Column]:
    """The columns of a line with enough fields."""
    tail = len(names) - FRONT - DESCRIPTIONS
    cells = [F.col("_f")[i] for i in range(FRONT)]
    cells.append(F.array_join(F.slice("_f", F.lit(FRONT + 1), F.col("_n") - tail - FRONT - 1), ","))
    cells.append(F.element_at("_f", -(tail + 1)))
    cells.extend(F.element_at("_f", -(tail - i)) for i in range(tail))
    return dict(zip(names, cells))


def repair(
    lines: DataFrame, header: Sequence[str], line: str = "value", carry: Sequence[str] = (), skip_header: bool = False
) -> tuple[DataFrame, DataFrame]:
    """Split lines into the header's columns, and give back (rows, rejects).

    Surplus fields belong to the descriptions: all but the last of the middle are joined again into
    description 1. Lines with too few fields go to the rejects with their field count. With
    ``skip_header``, lines that repeat the header are dropped.
    """
    names = [c.strip() for c in header]
    parts, n = _parts(lines, names, line, carry, skip_header), F.col("_n")
    rows = parts.filter(n >= len(names)).select(
        *carry, *[c.alias(name) for name, c in _cells(names).items()], (n > len(names)).alias("_repaired")
    )
    rejects = parts.filter(n < len(names)).select(*carry, F.col("_line").alias("line"), n.alias("fields"))
    return rows, rejects


def repair_marked(
    lines: DataFrame, header: Sequence[str], line: str = "value", carry: Sequence[str] = (), skip_header: bool = False
) -> DataFrame:
    """Rows and rejects of ``repair`` in one frame, for a source that is to be read once.

    ``_rejected`` tells them apart. Rejects have their ``_line`` and ``_fields`` and null cells; rows have ``_repaired`` and neither.
    """
    names = [c.strip() for c in header]
    parts, n = _parts(lines, names, line, carry, skip_header), F.col("_n")
    short = n < len(names)
    return parts.select(
        *carry, *[F.when(~short, c).alias(name) for name, c in _cells(names).items()], F.when(~short, n > len(names)).alias("_repaired"),
        F.when(short, F.col("_line")).alias("_line"), F.when(short, n).alias("_fields"), short.alias("_rejected"),
    )


def repair_counts(lines: DataFrame, width: int, line: str = "value") -> DataFrame:
    """Lines taken as they are, repaired and rejected."""
    n = F.col("_n")
    return _split_once(lines, line, ()).agg(
        F.count_if(n == width).alias("sound"),
        F.count_if(n > width).alias("repaired"),
        F.count_if(n < width).alias("rejected"),
    )


def read_lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """Lines of text files; bytes that are no UTF-8 become the replacement character."""
    return spark.read.text(path)


def header_of(spark: SparkSession, path: str | Sequence[str], multiline: bool = False) -> list[str]:
    """Column names from the first line, or the first record."""
    first_line = read_lines(spark, path).first()
    if multiline and first_line is not None and first_line["value"].count('"') % 2:
        lines = records.read_records(spark, path).orderBy("file", "range", "line").select("value")
    else:
        lines = read_lines(spark, path)
    first = lines.select(split_line(clean_line("value")).alias("f")).first()
    if first is None:
        raise ValueError(f"no lines in {path}")
    return [c.strip() for c in first["f"]]


def read_ragged(
    spark: SparkSession, path: str | Sequence[str], header: Sequence[str] | None = None, multiline: bool = False
) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects) of ragged files. Header lines are recognised by their content, so every file of
    a pattern may carry one and files stay splittable. With ``multiline``, quoted fields may hold line breaks; records are found
    as described in ``records``, a large file by many tasks."""
    names = list(header) if header else header_of(spark, path, multiline)
    return repair(records.read_records(spark, path).select("value") if multiline else read_lines(spark, path), names, skip_header=True)
