"""Merkle manifest of a table: every row is a leaf, every source a tree of ternary runs, the sources' roots another such tree.

A node is labelled with the interval of leaf ranks that it covers; at level L intervals begin at multiples of 3 ** L. The ancestor
of a node is the one whose interval contains its own, found by an equality join on the interval's bucket at that level. What a parent's
interval holds besides a node's own are the node's siblings. Nodes are kept in storeys of ``LEVELS`` levels: a block is one node's subtree of
so many levels, so a join is needed once a storey and no leaf's path is ever shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codeloom.llm.tables import Store, bounded_side, read_table

FAN = 3
LEVELS = 6

# A path goes upwards: at each level the digests left of the node in its run and those right of it, both as one string.
_PATH = "path array<string>, subroot string, root string"


def digest_of(*parts: Column) -> Column:
    return F.sha2(F.concat(*parts), 256)


def field(value: Column) -> Column:
    """A value with its length in bytes before it, so that no two rows write the same text; ``-`` for null."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(text: Column) -> Column:
    return digest_of(*[field(F.col(c)) for c in ("doc_id", "source", "lang", "n_chars")], field(text))


def ranked(store: Store, rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """``rows`` with rank (from 0) in their group and the group's size, nulls first, without gathering a group in one task.

    Rows are dealt by ranges of (group, order) and numbered as they are written; a task's share of a group is shifted by what
    earlier tasks hold of it, which is one row for each task and group.
    """
    tied = rows.withColumn("_tie", F.monotonically_increasing_id())
    by = [F.asc_nulls_first(c) for c in (group, *order)] + [F.asc("_tie")]
    placed = store.keep(tied.repartitionByRange(*by).sortWithinPartitions(*by).drop("_tie").withColumn("_at", F.monotonically_increasing_id()))
    task = F.shiftright("_at", 33)
    shares = placed.groupBy(task.alias("_task"), F.col(group).alias("_of")).agg(F.min("_at").alias("_from"), F.count("*").alias("_n"))
    earlier = Window.partitionBy("_of").orderBy("_task").rowsBetween(Window.unboundedPreceding, -1)
    shifts = store.keep(shares.select(
        "_task", "_of", (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_from")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy("_of")).alias("size"),
    ))
    joined = placed.join(bounded_side(shifts), (task == F.col("_task")) & F.col(group).eqNullSafe(F.col("_of")))
    return joined.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("rank"), "size")


def _height(size: int) -> int:
    height, width = 0, 1
    while width < size:
        height, width = height + 1, width * FAN
    return height


def hashed(text: str) -> str:
    return sha256(text.encode()).hexdigest()


class Block:
    """Up to ``LEVELS`` levels above consecutive nodes: ``levels[k][i]`` is the digest of the i-th node of level k of the block."""

    def __init__(self, digests: list[str], size: int, levels: int):
        self.levels = [digests]
        for _ in range(min(levels, _height(size))):
            below = self.levels[-1]
            self.levels.append([hashed("".join(below[i:i + FAN])) for i in range(0, len(below), FAN)])

    def paths(self, above: list[str]) -> list[list[str]]:
        """The path of every node of the lowest level, from the path of the block's top."""
        found = [above]
        for k in range(len(self.levels) - 2, -1, -1):
            nodes, upper = self.levels[k], found
            found = []
            for lo in range(len(nodes)):
                # The parent's interval without the node's own.
                parent = lo // FAN
                begin, end = parent * FAN, min((parent + 1) * FAN, len(nodes))
                found.append(["".join(nodes[begin:lo]), "".join(nodes[lo + 1:end]), *upper[parent]])
        return found


def fold(digest: str, path: list[str]) -> str:
    """The root that a leaf leads to along a path."""
    for i in range(0, len(path), 2):
        digest = hashed(path[i] + digest + path[i + 1])
    return digest


class Tree:
    """The trees of all groups. ``leaves``: columns _group, rank, size, digest and any others, which stay with their leaf."""

    def __init__(self, store: Store, leaves: DataFrame, levels: int = LEVELS):
        self.store, self.levels, self.width = store, levels, FAN ** levels
        self.kind = leaves.schema["_group"].dataType.simpleString()
        self.storeys: list[DataFrame] = []
        tops: DataFrame | None = None
        nodes = leaves.withColumn("total", F.col("size"))
        while True:
            # ``size`` counts the group's nodes at this storey's lowest level, ``total`` its leaves; a block is a bucket of ``width`` nodes.
            carried = [c for c in nodes.columns if c not in ("_group", "size", "total")]
            blocks = store.keep(
                nodes.groupBy("_group", "size", "total", F.expr(f"rank div {self.width}").alias("bucket"))
                .agg(F.array_sort(F.collect_list(F.struct(*carried))).alias("nodes"))
            )
            self.storeys.append(blocks)
            done = blocks.mapInArrow(self._tops(), f"_group {self.kind}, size long, total long, rank long, digest string")
            found = store.keep(done)
            ended = found.filter(F.col("size") <= self.width).select("_group", F.col("digest").alias("subroot"))
            tops = ended if tops is None else tops.unionByName(ended)
            open_ = found.filter(F.col("size") > self.width)
            if open_.isEmpty():
                break
            nodes = open_.withColumn("size", F.expr(f"(size + {self.width - 1}) div {self.width}"))
        self.tops = tops

    def _tops(self) -> Callable:
        levels = self.levels

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                sizes = batch.column("size").to_pylist()
                nodes = batch.column("nodes")
                digests = nodes.flatten().field("digest").to_pylist()
                ends = nodes.value_lengths().to_numpy().cumsum().tolist()
                made = [Block(digests[b:e], n, levels).levels[-1][0] for b, e, n in zip([0, *ends], ends, sizes)]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c) for c in ("_group", "size", "total", "bucket")), pa.array(made, pa.string())],
                    names=["_group", "size", "total", "rank", "digest"],
                )

        return run

    def attach(self, above: DataFrame, emit: Callable, schema: str) -> DataFrame:
        """Rows for all leaves, made by ``emit`` (the block's nodes as an Arrow struct, their paths, subroot, root) in the schema's order.

        ``above``: the path of each group's top, with its subroot and the root: _group, path, subroot, root.
        """
        down: DataFrame | None = None
        for number in range(len(self.storeys) - 1, -1, -1):
            blocks = self.storeys[number]
            heads = blocks.filter(F.col("size") <= self.width).join(
                above.withColumnRenamed("_group", "_of"), F.col("_group").eqNullSafe(F.col("_of")),
            ).drop("_of")
            if down is None:
                open_ = heads
            else:
                # Containment: the interval of a block's top node lies in that of the ancestor it is bucketed with.
                inner = blocks.filter(F.col("size") > self.width).withColumn("lo", F.col("bucket") * self.width)
                ancestors = down.select(F.col("_group").alias("_of"), F.col("bucket").alias("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), "path", "subroot", "root")
                inside = (F.col("bucket") == F.col("_bucket")) & F.col("lo").between(F.col("_lo"), F.col("_hi"))
                joined = inner.join(ancestors, F.col("_group").eqNullSafe(F.col("_of")) & inside)
                open_ = heads.unionByName(joined.select(*heads.columns))
            if number == 0:
                return open_.mapInArrow(self._emitted(emit), schema)
            down = self.store.keep(open_.mapInArrow(self._inner(), f"_group {self.kind}, bucket long, lo long, hi long, {_PATH}"))
        raise AssertionError("a tree has at least one storey")

    def _emitted(self, emit: Callable) -> Callable:
        levels = self.levels

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, (size, above, subroot, root) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("size", "path", "subroot", "root")))):
                    nodes = batch.column("nodes").slice(i, 1).flatten()
                    paths = Block(nodes.field("digest").to_pylist(), size, levels).paths(above)
                    yield emit(batch.column("_group").slice(i, 1), nodes, paths, subroot, root)

        return run

    def _inner(self) -> Callable:
        width = self.width
        types = pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.string()

        def emit(group: pa.Array, nodes: pa.Array, paths: list, subroot: str, root: str) -> pa.RecordBatch:
            at = nodes.field("rank").to_pylist()
            values = at, [i * width for i in at], [i * width + width - 1 for i in at], paths, [subroot] * len(at), [root] * len(at)
            arrays = [group.take(pa.array([0] * len(at))), *(pa.array(v, t) for v, t in zip(values, types))]
            return pa.RecordBatch.from_arrays(arrays, names=["_group", "bucket", "lo", "hi", "path", "subroot", "root"])

        return self._emitted(emit)

    def nodes(self) -> DataFrame:
        """All nodes: _group, level, lo and hi (the leaf ranks they cover) and digest. A storey's top is the next one's lowest level."""
        parts = []
        for number, blocks in enumerate(self.storeys):
            part = blocks.mapInArrow(self._labelled(number), f"_group {self.kind}, level int, lo long, hi long, digest string")
            parts.append(part)
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part)
        return out

    def _labelled(self, number: int) -> Callable:
        levels, width = self.levels, self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            scale = width ** number
            for batch in batches:
                for i, (size, total, bucket) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("size", "total", "bucket")))):
                    nodes = batch.column("nodes").slice(i, 1).flatten()
                    block = Block(nodes.field("digest").to_pylist(), size, levels)
                    rows = []
                    for k, level in enumerate(block.levels):
                        # A storey's lowest level is the top of the one below, which has listed it.
                        if k or not number:
                            covers, low = scale * FAN ** k, bucket * width * scale
                            rows += [(number * levels + k, low + j * covers, min(low + (j + 1) * covers, total) - 1, d) for j, d in enumerate(level)]
                    names = ("level", "lo", "hi", "digest")
                    types = pa.int32(), pa.int64(), pa.int64(), pa.string()
                    arrays = [pa.array(list(v), t) for v, t in zip(zip(*rows), types)] if rows else [pa.array([], t) for t in types]
                    group = batch.column("_group").slice(i, 1).take(pa.array([0] * len(rows), pa.int64()))
                    yield pa.RecordBatch.from_arrays([group, *arrays], names=["_group", *names])

        return run


class Manifest:
    """The manifest of ``docs`` (columns doc_id, source, lang, n_chars, text; others are ignored).

    A leaf is the digest of a row's five fields. Leaves of a source stand in the order of doc_id, nulls first, ties by digest; repeated
    rows are leaves each. While a source has several nodes, every three consecutive ones (a last run of fewer, even of one) become the
    digest of theirs; a single leaf is its source's root itself. The sources' roots, a null source first and the others in the
    order of their bytes, become the root in the same way. An empty table has no nodes. ``present``: a leaf that may differ from the
    recorded one, as a column over ``docs``, is kept beside it and folded along the recorded siblings.
    """

    def __init__(self, docs: DataFrame, present: Column | None = None, levels: int = LEVELS):
        self.store = store = Store(docs.sparkSession, "manifest")
        recorded = leaf(F.col("text"))
        slim = docs.select("doc_id", F.col("source").alias("_group"), recorded.alias("digest"), (present if present is not None else recorded).alias("present"))
        # Written before it is dealt by ranges, which looks at its rows twice: texts are read and hashed once.
        self.sources = Tree(store, ranked(store, store.keep(slim), "_group", ["doc_id", "digest"]), levels)
        tops = self.sources.tops.select(F.lit(0).alias("_group"), F.col("_group").alias("source"), F.col("subroot").alias("digest"))
        self.top = Tree(store, ranked(store, tops, "_group", ["source"]), levels)
        self.doc_kind, self.source_kind = (docs.schema[c].dataType.simpleString() for c in ("doc_id", "source"))

    def proofs(self) -> DataFrame:
        """doc_id, leaf, subroot, root, proof_sha256 (digest of all siblings, upwards, left to right) and folded_root, one row per row."""
        root = self.top.tops.select("_group", F.array().cast("array<string>").alias("path"), "subroot", F.col("subroot").alias("root"))

        def sources(group: pa.Array, nodes: pa.Array, paths: list, subroot: str, root: str) -> pa.RecordBatch:
            arrays = [nodes.field("source"), pa.array(paths, pa.list_(pa.string())), nodes.field("digest"), pa.array([root] * len(paths), pa.string())]
            return pa.RecordBatch.from_arrays(arrays, names=["_group", "path", "subroot", "root"])

        def leaves(group: pa.Array, nodes: pa.Array, paths: list, subroot: str, root: str) -> pa.RecordBatch:
            n = len(paths)
            made = [hashed("".join(p)) for p in paths], [fold(d, p) for d, p in zip(nodes.field("present").to_pylist(), paths)]
            arrays = [nodes.field("doc_id"), nodes.field("digest"), pa.array([subroot] * n), pa.array([root] * n), *map(pa.array, made)]
            return pa.RecordBatch.from_arrays(arrays, names=["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root"])

        above = self.store.keep(self.top.attach(root, sources, f"_group {self.source_kind}, {_PATH}"))
        return self.sources.attach(
            above, leaves, f"doc_id {self.doc_kind}, leaf string, subroot string, root string, proof_sha256 string, folded_root string",
        ).withColumn("verified", F.col("folded_root") == F.col("root"))

    def nodes(self) -> DataFrame:
        """The manifest itself: source, level (0: leaves), lo, hi (ranks of the leaves covered) and digest."""
        return self.sources.nodes().withColumnRenamed("_group", "source")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, with the line breaks of every other document deleted after the manifest was made."""
    docs = read_table(spark, sf_dir, "documents")
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    tampered = F.when(chosen, F.replace(F.col("text"), F.lit("\n"), F.lit(""))).otherwise(F.col("text"))
    return Manifest(docs, leaf(tampered)).proofs()


SQL = r"""
WITH RECURSIVE fields AS (
  SELECT doc_id, source, text, CAST(doc_id AS VARCHAR) AS k,
    coalesce(octet_length(encode(CAST(doc_id AS VARCHAR))) || ':' || doc_id, '-') || coalesce(octet_length(encode(source)) || ':' || source, '-')
      || coalesce(octet_length(encode(lang)) || ':' || lang, '-') || coalesce(octet_length(encode(CAST(n_chars AS VARCHAR))) || ':' || n_chars, '-') AS h
  FROM documents),
chosen AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 2 = 0 AS tampered FROM fields),
texts AS (SELECT *, CASE WHEN tampered THEN replace(text, chr(10), '') ELSE text END AS now FROM chosen),
leaves AS (
  SELECT doc_id, source, sha256(h || coalesce(octet_length(encode(text)) || ':' || text, '-')) AS leaf,
    sha256(h || coalesce(octet_length(encode(now)) || ':' || now, '-')) AS present FROM texts),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS spot, count(*) OVER (PARTITION BY source) AS n,
    row_number() OVER (ORDER BY source NULLS FIRST, doc_id NULLS FIRST, leaf) AS id FROM leaves),
tree(source, level, spot, digest, n) AS (
  SELECT source, 0, spot, leaf, n FROM placed
  UNION ALL SELECT source, level + 1, spot // 3, sha256(string_agg(digest, '' ORDER BY spot)), (n + 2) // 3 FROM tree WHERE n > 1 GROUP BY source, level, spot // 3, n),
subroots AS (SELECT source, digest AS subroot, level AS height, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS spot, count(*) OVER () AS n FROM tree WHERE n = 1),
top(level, spot, digest, n) AS (
  SELECT 0, spot, subroot, n FROM subroots
  UNION ALL SELECT level + 1, spot // 3, sha256(string_agg(digest, '' ORDER BY spot)), (n + 2) // 3 FROM top WHERE n > 1 GROUP BY level, spot // 3, n),
around AS (
  SELECT a.source, a.level, a.spot, string_agg(b.digest, '' ORDER BY b.spot) FILTER (b.spot < a.spot) AS l, string_agg(b.digest, '' ORDER BY b.spot) FILTER (b.spot > a.spot) AS r
  FROM tree a JOIN tree b ON a.source IS NOT DISTINCT FROM b.source AND a.level = b.level AND a.spot // 3 = b.spot // 3 WHERE a.n > 1 GROUP BY ALL),
around_top AS (
  SELECT a.level, a.spot, string_agg(b.digest, '' ORDER BY b.spot) FILTER (b.spot < a.spot) AS l, string_agg(b.digest, '' ORDER BY b.spot) FILTER (b.spot > a.spot) AS r
  FROM top a JOIN top b ON a.level = b.level AND a.spot // 3 = b.spot // 3 WHERE a.n > 1 GROUP BY ALL),
climb(id, source, level, spot, folded, proof) AS (
  SELECT id, source, 0, spot, present, '' FROM placed
  UNION ALL
  SELECT id, c.source, c.level + 1, c.spot // 3, sha256(coalesce(l, '') || folded || coalesce(r, '')), proof || coalesce(l, '') || coalesce(r, '')
  FROM climb c JOIN around s ON c.source IS NOT DISTINCT FROM s.source AND c.level = s.level AND c.spot = s.spot),
reached AS (SELECT c.*, s.spot AS place FROM climb c JOIN subroots s ON c.source IS NOT DISTINCT FROM s.source AND c.level = s.height),
rise(id, level, spot, folded, proof) AS (
  SELECT id, 0, place, folded, proof FROM reached
  UNION ALL
  SELECT id, c.level + 1, c.spot // 3, sha256(coalesce(l, '') || folded || coalesce(r, '')), proof || coalesce(l, '') || coalesce(r, '')
  FROM rise c JOIN around_top s ON c.level = s.level AND c.spot = s.spot),
root AS (SELECT digest AS root, level AS height FROM top WHERE n = 1)
SELECT doc_id, leaf, subroot, root, sha256(proof) AS proof_sha256, folded AS folded_root, folded = root AS verified
FROM placed d JOIN rise x USING (id) JOIN root ON x.level = root.height JOIN subroots s ON d.source IS NOT DISTINCT FROM s.source
"""
