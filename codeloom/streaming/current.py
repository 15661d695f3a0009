"""Current record per key out of a snapshot and a stream of changes."""

from __future__ import annotations

import re
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from codeloom.session import children, remove


def last_change(df: DataFrame, key: Sequence[str], order: Sequence[str]) -> DataFrame:
    """Last record per key. The map-side combine keeps one candidate per key and task.

    ``order`` (change time first) must be total, so that equal times resolve the same way everywhere.
    """
    others = [c for c in df.columns if c not in key]
    newest = F.max_by(F.struct(*others), F.struct(*[F.col(c).alias(f"o{i}") for i, c in enumerate(order)]))
    return df.groupBy(*key).agg(newest.alias("_r")).select(*key, *[F.col(f"_r.{c}").alias(c) for c in others]).select(*df.columns)


def _write_batch(path: str, key: Sequence[str], order: Sequence[str]) -> Callable[[DataFrame, int], None]:
    def write(delta: DataFrame, batch: int) -> None:
        # Overwriting the folder of this batch makes a replay harmless.
        last_change(delta, key, order).write.mode("overwrite").parquet(f"{path}/batch_id={batch}")

    return write


def upsert_stream(
    changes: DataFrame, path: str, checkpoint: str, key: Sequence[str], order: Sequence[str]
) -> StreamingQuery:
    """Append the reduced delta of every micro-batch: the cost follows the delta, not the snapshot."""
    query = (
        changes.writeStream.foreachBatch(_write_batch(path, key, order))
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return query


def _numbers(spark: SparkSession, path: str, name: str) -> list[int]:
    found = (re.fullmatch(rf"{name}=(\d+)", child) for child in children(spark, path))
    return sorted(int(m[1]) for m in found if m)


def current_records(
    spark: SparkSession, path: str, key: Sequence[str], order: Sequence[str], snapshot: DataFrame | None = None,
    target: str | None = None,
) -> DataFrame:
    """Snapshot and deltas merged when read. With ``target``, its last snapshot, and only deltas later than that, are read."""
    upto = _numbers(spark, target, "upto")[-1:] if target else []
    rows = [] if snapshot is None else [snapshot]
    if upto:
        rows.append(spark.read.parquet(f"{target}/upto={upto[0]}"))
    late = [n for n in _numbers(spark, path, "batch_id") if not upto or n > upto[0]]
    if late:
        rows.append(spark.read.parquet(*[f"{path}/batch_id={n}" for n in late]))
    if not rows:
        raise ValueError(f"no records below {path}")
    return last_change(reduce(DataFrame.unionByName, rows), key, order)


def compact(
    spark: SparkSession, path: str, target: str, key: Sequence[str], order: Sequence[str], snapshot: DataFrame | None = None
) -> DataFrame:
    """Write the merged state as the next snapshot below ``target`` and retire what went into it.

    A snapshot is named by the last batch it holds, in a folder of its own, so nothing is overwritten that is still read; a batch
    that is replayed later is known to be merged. ``snapshot`` is what the first compaction starts from.
    """
    before, batches = _numbers(spark, target, "upto"), _numbers(spark, path, "batch_id")
    upto = max([*before, *batches], default=0)
    if not before or upto > before[-1]:
        current_records(spark, path, key, order, snapshot if not before else None, target).write.mode("overwrite").parquet(f"{target}/upto={upto}")
    for n in batches:
        remove(spark, f"{path}/batch_id={n}")
    for n in before:
        if n != upto:
            remove(spark, f"{target}/upto={n}")
    return spark.read.parquet(f"{target}/upto={upto}")
