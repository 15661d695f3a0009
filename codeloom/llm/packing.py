"""Best-fit packing of tokenized documents into sequences, improved by exchanges between underfull sequences.

Only lengths are packed; texts stay where they are. Pieces are dealt into shards of bounded size, each is packed on its own, and
sequences that are not full are opened again and dealt together in the next round, until one shard is left or nothing is gained.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from codeloom.llm.arrowtext import pieces
from codeloom.llm.tables import Store, read_table
from codeloom.llm.tokens import Encoder, default_vocabulary

CAPACITY = 2048
END_ID = 0
# Pieces that one task packs together.
SHARD_PIECES = 8_000
# The most tasks that shards are dealt to. The number is given, as the few bytes of a shard hide how long packing it takes.
SHARD_TASKS = 4_000
# A further round must save this share of the sequences that were opened.
LEAST_GAIN = 0.002


def best_fit(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece goes into the open bin with the least room that holds it. Bins are lists of positions."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    rooms = 0  # bit r is set if a bin has room r
    for item in np.argsort(-lengths, kind="stable"):
        size = int(lengths[item])
        fitting = rooms >> size
        if fitting:
            room = (fitting & -fitting).bit_length() - 1 + size
            at = by_room[room].pop()
            if not by_room[room]:
                rooms &= ~(1 << room)
            bins[at].append(int(item))
        else:
            room, at = capacity, len(bins)
            bins.append([int(item)])
        left = room - size
        if left:
            by_room[left].append(at)
            rooms |= 1 << left
    return bins


class Exchange:
    """Local search on bins: the emptiest bin hands pieces to fuller ones, which raises the sum of squared fills, until it is empty.

    One step moves one piece, or swaps one or two pieces of the emptiest bin for a smaller one of another bin; of all steps the
    one that hands over most is taken. A bin is tried only if the room of all others could hold it at all.
    """

    def __init__(self, bins: list[list[int]], lengths: np.ndarray, capacity: int):
        self.lengths, self.capacity = lengths, capacity
        self.bins = bins
        self.fills = np.array([int(lengths[b].sum()) for b in bins], np.int64)
        # Only bins with room take part in exchanges, and full ones never get room again.
        at = [i for i in np.flatnonzero(self.fills < capacity).tolist()]
        self.pieces = np.array([p for i in at for p in bins[i]], np.int64)
        self.owner = np.repeat(at, [len(bins[i]) for i in at]).astype(np.int64)
        self.sizes = lengths[self.pieces]
        self.place = {p: n for n, p in enumerate(self.pieces.tolist())}

    def run(self) -> list[list[int]]:
        stuck = np.zeros(len(self.fills), bool)
        while True:
            rooms = np.where(self.fills > 0, self.capacity - self.fills, 0)
            able = np.flatnonzero((self.fills > 0) & (self.fills <= rooms.sum() - rooms) & ~stuck)
            if not len(able):
                return [b for b in self.bins if b]
            source = int(able[np.argmin(self.fills[able])])
            if self._empty(source):
                stuck[:] = False
            else:
                stuck[source] = True

    def _empty(self, source: int) -> bool:
        while self.bins[source]:
            if not self._step(source):
                return False
        return True

    def _step(self, source: int) -> bool:
        """Hand over as much as one exchange can. Zero length stands for no piece in return."""
        rooms = self.capacity - self.fills
        able = (rooms > 0) & (self.fills >= self.fills[source]) & (self.fills > 0)
        able[source] = False
        others = np.flatnonzero(able)
        if not len(others):
            return False
        taking = np.flatnonzero(able[self.owner])
        held, owner, sizes = self.pieces[taking], self.owner[taking], self.sizes[taking]
        room = rooms[owner]
        best = np.full(self.capacity + 1, -1, np.int64)
        np.maximum.at(best, sizes, room)
        best[0] = rooms[others].max()
        reach = np.maximum.accumulate(np.where(best >= 0, np.arange(self.capacity + 1) + best, -1))
        own = self.bins[source]
        offers = [(int(self.lengths[p]), (p,)) for p in own]
        seen: dict[int, tuple[int, ...]] = {}
        for i, p in enumerate(own):
            for q in own[i + 1:]:
                seen.setdefault(int(self.lengths[p] + self.lengths[q]), (p, q))
        gain, chosen = 0, None
        for total, given in offers + list(seen.items()):
            back = int(np.searchsorted(reach, total))
            if back < total and back <= self.capacity and total - back > gain and not (back == 0 and len(given) == 2):
                gain, chosen = total - back, (given, back)
        if chosen is None:
            return False
        given, back = chosen
        if back == 0:
            wide = others[rooms[others] >= gain]
            target = int(wide[np.argmin(rooms[wide])])
        else:
            fits = np.flatnonzero((sizes == back) & (room >= gain))
            at = fits[np.argmin(room[fits])]
            target = int(owner[at])
            self._move(int(held[at]), target, source)
        for p in given:
            self._move(p, source, target)
        self.fills[source] -= gain
        self.fills[target] += gain
        return True

    def _move(self, piece: int, source: int, target: int) -> None:
        self.bins[source].remove(piece)
        self.bins[target].append(piece)
        self.owner[self.place[piece]] = target


def pack(lengths: np.ndarray, capacity: int) -> list[list[int]]:
    return Exchange(best_fit(lengths, capacity), lengths, capacity).run()


def token_pieces(
    docs: DataFrame, vocabulary: str | None = None, capacity: int = CAPACITY, with_ids: bool = False, special_as_text: bool = False,
) -> DataFrame:
    """Columns doc_id, piece, start, length, ids_crc32 and, if asked for, ids: the documents' tokens, each ended by END_ID.

    Only documents longer than a sequence are cut, into full sequences; their first piece is what is left over. A null or empty
    text is its end token alone. Every row of ``docs`` is a document; other columns than doc_id and text are ignored. Strings of
    special tokens in a text become their ids, or are ordinary text if ``special_as_text``.
    """
    with open(vocabulary or default_vocabulary(), encoding="utf-8") as file:
        shared = docs.sparkSession.sparkContext.broadcast(file.read())
    fields = "doc_id long, piece int, start long, length long, ids_crc32 long" + ", ids array<long>" * with_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = Encoder(shared.value, special_as_text)
        for batch in batches:
            for part in pieces(batch, "text"):
                rows: list[tuple] = []
                for doc, text in zip(part.column("doc_id").to_pylist(), part.column("text").to_pylist()):
                    ids = np.append(encoder.ids(text), np.array([END_ID], "<u4"))
                    first = (len(ids) - 1) % capacity + 1
                    cuts = [0, *range(first, len(ids) + 1, capacity)]
                    for n, (low, high) in enumerate(zip(cuts, cuts[1:])):
                        rows.append((doc, n, low, high - low, zlib.crc32(ids[low:high].tobytes()), ids[low:high]))
                arrays = [pa.array([r[i] for r in rows], kind) for i, kind in enumerate((pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))]
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                if with_ids:
                    arrays.append(pa.array([r[5].astype(np.int64) for r in rows], pa.list_(pa.int64())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(arrays, names=names)

    return docs.select("doc_id", "text").mapInArrow(run, fields)


def _pack_shard(capacity: int, rounds: int):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["doc_id", "piece", "start"], kind="stable", ignore_index=True)
        lengths = group["length"].to_numpy(np.int64)
        sequence, offset, fill = (np.zeros(len(group), np.int64) for _ in range(3))
        shard = int(group["_shard"].iloc[0])
        for n, members in enumerate(pack(lengths, capacity)):
            sequence[members] = (rounds << 56) | (shard << 20) | n
            offset[members] = np.cumsum(lengths[members]) - lengths[members]
            fill[members] = lengths[members].sum()
        return group.drop(columns="_shard").assign(sequence_id=sequence, offset=offset, _fill=fill)

    return run


def pack_pieces(found: DataFrame, capacity: int = CAPACITY, shard_pieces: int = SHARD_PIECES) -> DataFrame:
    """The rows of ``found`` (columns doc_id, piece, start, length and others) with sequence_id and offset.

    Pieces of one sequence lie one after the other from offset 0; none is longer than ``capacity``. Sequence numbers have no order
    and may leave gaps. An empty table gives an empty result.
    """
    store = Store(found.sparkSession, "packing")
    fields = T.StructType([*found.schema.fields, *(T.StructField(n, T.LongType()) for n in ("_row", "sequence_id", "offset", "_fill"))])
    # Written with the rows: deals out rows without a doc_id, and repeats of one, as evenly as all others.
    todo, done, rounds = store.keep(found.withColumn("_row", F.monotonically_increasing_id())), [], 0
    count, opened = todo.count(), None
    while True:
        shards = max(1, -(-count // shard_pieces))
        shard = F.pmod(F.xxhash64("_row", F.lit(rounds)), F.lit(shards)).cast("int")
        sharded = todo.withColumn("_shard", shard)
        # A task for each shard, or as many as there may be.
        dealt = sharded.repartitionById(shards, "_shard") if shards <= SHARD_TASKS else sharded.repartition(SHARD_TASKS, "_shard")
        packed = store.keep(dealt.groupBy("_shard").applyInPandas(_pack_shard(capacity, rounds), fields))
        full = packed.filter(F.col("_fill") == capacity)
        loose = packed.filter(F.col("_fill") < capacity)
        left, sequences = loose.agg(F.count("*"), F.count_distinct("sequence_id")).first()
        if shards == 1 or not left or (opened is not None and sequences > (1 - LEAST_GAIN) * opened):
            done.append(packed)
            break
        done.append(full)
        todo, count, opened, rounds = loose.select(*found.columns, "_row"), left, sequences, rounds + 1
    whole = done[0]
    for more in done[1:]:
        whole = whole.unionByName(more)
    return whole.drop("_fill", "_row")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents as pieces of packed sequences. Rows without a doc_id and repeated rows are documents of their own, null texts empty ones."""
    return pack_pieces(token_pieces(docs))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack_pieces(token_pieces(read_table(spark, sf_dir, "documents")))
