"""Conversation structure repair: the cheapest edits that give a conversation the roles ``(s?(ua)+)?``.

Every row becomes one symbol: its role's initial and its fault. Re-Pair finds frequent runs of symbols over all conversations. A symbol
is a matrix over the states of the role automaton: for each way from one state to another the least cost and, as a rope, the
ASCII-least audit of that cost. A rule's matrix is the min-plus product of its two halves', computed once on the driver and shared by all
conversations; a conversation multiplies a row vector by the few symbols that are left of it. Costs follow from the audit and
the rows alone, so of two audits of equal cost none is a beginning of the other, and the least of a product comes from the least parts.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from codeloom.llm.grammar import compressed, repair_rules, rule_symbol
from codeloom.llm.ropes import Cell, Matrix, Ropes
from codeloom.llm.tables import Store, read_table

# States of the automaton: nothing yet, after s, after u, after a. Ends are nothing and after a.
_NEXT = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
_STATES, _ENDS = 4, (0, 3)
_GIVEN = {"u": "user", "a": "assistant"}
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 1, 2, 5, 5

# One letter a row: the role's initial (x for any other), upper case if the text is cut off; d if the row has to go.
ROW_SYMBOLS = "suaxSUAXd"
_SPACES = " \t\n\x0b\x0c\r"

_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal")


class Solver:
    """Matrices of all symbols, made once and used for every conversation. Plain lists and dictionaries inside."""

    def __init__(self, rules: list[str]):
        self.ropes = Ropes()
        letters = {c: self.ropes.leaf(c) for c in "KRDI"}
        inserts: Matrix = [[None] * _STATES for _ in range(_STATES)]
        for (state, role), then in _NEXT.items():
            if role in _GIVEN:
                inserts[state][then] = (INSERT, letters["I"])
        self.inserts = self.ropes.closure(inserts)
        self.matrices = {c: self.ropes.times(self.inserts, self._row(c, letters)) for c in ROW_SYMBOLS}
        for n, (left, right) in enumerate(rules):
            self.matrices[rule_symbol(n)] = self.ropes.times(self.matrices[left], self.matrices[right])
        self.nodes = len(self.ropes.size)

    def _row(self, symbol: str, letters: dict[str, int]) -> Matrix:
        out: Matrix = [[None] * _STATES for _ in range(_STATES)]

        def offer(state: int, then: int, cell: Cell) -> None:
            out[state][then] = self.ropes.better(out[state][then], cell)

        more = TRUNCATED if symbol.isupper() else 0
        for state in range(_STATES):
            offer(state, state, (DELETE, letters["D"]))
        for (state, role), then in _NEXT.items():
            if symbol != "d" and role == symbol.lower():
                offer(state, then, (KEEP + more, letters["K"]))
            if symbol != "d" and role in _GIVEN:
                offer(state, then, (REROLE + more, letters["R"]))
        return out

    def solve(self, symbols: str) -> tuple[int, str]:
        """Cost and audit of a conversation given as symbols of rows and rules."""
        row: list[Cell | None] = [(0, 0)] + [None] * (_STATES - 1)
        for symbol in symbols:
            row = self.ropes.times_row(row, self.matrices[symbol])
        row = self.ropes.times_row(row, self.inserts)
        best = None
        for state in _ENDS:
            best = self.ropes.better(best, row[state])
        found = best[0], self.ropes.text(best[1])
        self.ropes.keep(self.nodes)
        return found


def marked(rows: DataFrame) -> DataFrame:
    """Rows with their number n in the conversation, their symbol and what they add to the counts (see ``repairs``)."""
    text, role = F.coalesce("text", F.lit(" ")), F.coalesce("role", F.lit(" "))
    present = F.col("present") if "present" in rows.columns else F.lit(True)
    plain = rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), present.alias("present"))
    # Present rows first, so that the numbers of the others, which only name their conversation, come after them.
    order = Window.partitionBy("conv_id").orderBy(F.desc("present"), F.asc_nulls_first("turn"), "role", "text")
    before = F.substring("role", 1, 1)
    placed = plain.select(
        "*", F.row_number().over(order).alias("n"), F.lag("turn").over(order).alias("turn_before"), F.lag(before).over(order).alias("initial_before"),
    )
    same = Window.partitionBy("conv_id", "present", "role", "text").orderBy("n")
    trimmed, initial = F.rtrim("text", F.lit(_SPACES)), F.substring("role", 1, 1)
    seen = placed.withColumn("again", F.row_number().over(same) > 1).withColumn("trimmed", trimmed)
    blank = F.length("trimmed") == 0
    duplicate = ~blank & F.col("again")
    cut = ~blank & ~duplicate & ~F.right("trimmed", F.lit(1)).isin(".", "!", "?")
    letter = F.when(initial.isin("s", "u", "a"), initial).otherwise("x")
    legal = F.concat("initial_before", initial).isin("su", "ua", "au")
    return seen.select(
        "conv_id", "n", "turn", "role", "text", "present", blank.alias("blank"), duplicate.alias("duplicate"), cut.alias("truncated"),
        ((F.col("n") > 1) & ~legal).alias("illegal"), (F.col("turn").isNotNull() & ~F.col("turn").eqNullSafe(F.col("turn_before"))).alias("new_turn"),
        F.when(blank | duplicate, "d").when(cut, F.upper(letter)).otherwise(letter).alias("symbol"),
    )


def _solved(rules: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        solver = Solver(rules)
        for batch in batches:
            found = [solver.solve(s) for s in batch.column("symbols").to_pylist()]
            arrays = [batch.column(c) for c in ("conv_id", *_COUNTS)]
            arrays += [pa.array([c for c, _ in found], pa.int64()), pa.array([a for _, a in found], pa.string())]
            yield pa.RecordBatch.from_arrays(arrays, names=["conv_id", *_COUNTS, "cost", "audit"])

    return run


def repairs(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The cheapest repair of each conversation, and the numbered rows it applies to.

    ``rows`` has conv_id, turn, role and text; if there is a boolean column present, rows without it only name their conversation.
    Rows stand in the order of turn, nulls first, ties by role and text. A null role or text counts as one space. The first
    table has one row per conv_id (rows without one are one conversation): gaps, blank, duplicate, truncated and illegal, the cost
    and the audit, one letter an edit (K keep, R rerole, D delete, I insert). Blank rows and those whose role and text were seen earlier have to
    go. A role whose initial is not s, u or a (an empty one too) can only be given another or go. Of audits of equal cost the
    ASCII-least counts. Repeated rows are duplicates, an empty table gives no rows, other columns are ignored. An audit is one value, so a
    conversation's audit has to fit in a row; its texts are sorted and streamed, never gathered.
    """
    store = Store(rows.sparkSession, "repair")
    kept = store.keep(marked(rows))
    there = F.col("present")

    def number(name: str) -> Column:
        return F.coalesce(F.count_if(there & F.col(name)), F.lit(0)).alias(name)

    turn = F.when(there, F.col("turn"))
    symbols = F.array_sort(F.collect_list(F.when(there, F.struct("n", "symbol"))))
    gaps = F.coalesce(F.max(turn) - F.min(turn) + 1 - F.count_if(there & F.col("new_turn")), F.lit(0))
    whole = store.keep(kept.groupBy("conv_id").agg(
        gaps.alias("gaps"), *[number(c) for c in _COUNTS[1:]], F.array_join(F.transform(symbols, lambda s: s["symbol"]), "").alias("symbols"),
    ))
    distinct = store.keep(whole.groupBy("symbols").agg(F.count("*").alias("weight")))
    rules = repair_rules(distinct, "symbols", "weight")
    short = whole.withColumn("symbols", compressed(F.col("symbols"), rules))
    kind = rows.schema["conv_id"].dataType.simpleString()
    audits = short.select("conv_id", *_COUNTS, "symbols").mapInArrow(
        _solved(rules), f"conv_id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, cost long, audit string",
    )
    return audits, kept.filter("present").select("conv_id", "n", "role", "text")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, list | None, str | None, str | None]]:
    """Per conversation first (row 0) its audit's row of values, then role and text of each row of the repaired conversation.

    Rows come sorted by conversation and n; the audit's row stands first with n = 0.
    """
    audit, at, state = "", 0, 0

    def given() -> Iterator[str]:
        nonlocal at, state
        while at < len(audit) and audit[at] == "I":
            role = "a" if state == 2 else "u"
            at, state = at + 1, _NEXT[state, role]
            yield _GIVEN[role]

    for batch in batches:
        columns = [batch.column(c).to_pylist() for c in ("n", "role", "text", "audit")]
        for i, (n, role, text, own) in enumerate(zip(*columns)):
            if n == 0:
                yield from ((None, None, r, "") for r in given())
                audit, at, state = own, 0, 0
                yield i, batch, None, None
                continue
            yield from ((None, None, r, "") for r in given())
            edit = audit[at]
            at += 1
            if edit == "D":
                continue
            initial = role[:1] if edit == "K" else "a" if state == 2 else "u"
            state = _NEXT[state, initial]
            yield None, None, role if edit == "K" else _GIVEN[initial], text
    yield from ((None, None, r, "") for r in given())


def _sorted(audits: DataFrame, numbered: DataFrame) -> DataFrame:
    """Each conversation's audit and then its rows, in one stream per task."""
    heads = audits.withColumns({"n": F.lit(0), "role": F.lit(None).cast("string"), "text": F.lit(None).cast("string")})
    both = heads.unionByName(numbered, allowMissingColumns=True)
    return both.repartition("conv_id").sortWithinPartitions("conv_id", "n")


def repaired(audits: DataFrame, numbered: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, turn (from 0), role and text, from what ``repairs`` returned."""
    kind = audits.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        conv, turn, out = None, 0, []
        names = ["conv_id", "turn", "role", "text"]

        def flush() -> pa.RecordBatch:
            types = [types_of["conv_id"], pa.int64(), pa.string(), pa.string()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names=names)

        types_of: dict[str, pa.DataType] = {}
        for i, batch, role, text in _edited(batches):
            if role is None:
                conv, turn = batch.column("conv_id")[i].as_py(), 0
                types_of["conv_id"] = batch.column("conv_id").type
                continue
            out.append((conv, turn, role, text))
            turn += 1
            if len(out) == 1000:
                yield flush()
                out.clear()
        if out:
            yield flush()

    return _sorted(audits, numbered).mapInArrow(run, f"conv_id {kind}, turn long, role string, text string")


def _digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["conv_id", *_COUNTS, "cost", "audit"]
    heads: list[pa.RecordBatch] = []
    digests: list[str] = []
    digest, first = None, True

    def flush() -> pa.RecordBatch:
        whole = pa.Table.from_batches(heads).combine_chunks()
        return pa.RecordBatch.from_arrays([*(whole.column(c).combine_chunks() for c in names), pa.array(digests)], names=[*names, "repaired_sha256"])

    for i, batch, role, text in _edited(batches):
        if role is None:
            if digest is not None:
                digests.append(digest.hexdigest())
                if len(digests) >= 1000:
                    yield flush()
                    heads.clear()
                    digests.clear()
            heads.append(batch.slice(i, 1).select(names))
            digest, first = hashlib.sha256(), True
        else:
            digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
            first = False
    if digest is not None:
        digests.append(digest.hexdigest())
        yield flush()


def digests(audits: DataFrame, numbered: DataFrame) -> DataFrame:
    """The audits with the SHA-256 of each repaired conversation, its rows written ``role:text`` and joined by line breaks."""
    kind = audits.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {kind}, {', '.join(f'{c} long' for c in _COUNTS)}, cost long, audit string, repaired_sha256 string"
    return _sorted(audits, numbered).mapInArrow(_digested, schema)


def damaged(rows: DataFrame) -> DataFrame:
    """Conversations with a twentieth each of their rows dropped (present is false), emptied, cut off, repeated and given to the user."""
    def plain(name: str) -> Column:
        return F.coalesce(F.col(name).cast("string"), F.lit(" "))

    act = F.crc32(F.concat(plain("conv_id"), F.lit(":"), plain("turn")).cast("binary")) % 20
    acted = rows.select("conv_id", "turn", plain("role").alias("role"), plain("text").alias("text"), act.alias("act"))
    text = F.when(F.col("act") == 1, "").when(F.col("act") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    copies = F.array_repeat(F.col("act") != 0, F.when(F.col("act") == 3, 2).otherwise(1))
    return acted.select(
        "conv_id", "turn", F.when(F.col("act") == 4, "user").otherwise(F.col("role")).alias("role"), text.alias("text"), F.explode(copies).alias("present"),
    )


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(*repairs(damaged(read_table(spark, sf_dir, "conversations"))))


SQL = r"""
WITH RECURSIVE t AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations),
c AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295, list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(k[i]) AS BIGINT))),
    lambda crc, b: list_reduce(list_prepend(xor(crc, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda x, y: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384 ELSE 0 END))), 4294967295) % 20 AS act FROM t),
live AS (
  SELECT conv_id, turn, CASE WHEN act = 4 THEN 'user' ELSE role END AS role,
    CASE act WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text
  FROM c, range(CASE act WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS n,
    rtrim(text, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS trimmed FROM live),
seen AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY n) > 1 AS again,
    lag(role[1:1]) OVER (PARTITION BY conv_id ORDER BY n) AS before FROM placed),
faults AS (
  SELECT *, trimmed = '' AS blank, trimmed <> '' AND again AS duplicate,
    trimmed <> '' AND NOT again AND right(trimmed, 1) NOT IN ('.', '!', '?') AS cut,
    n > 1 AND (before || role[1:1]) NOT IN ('su', 'ua', 'au') AS illegal FROM seen),
counts AS (
  SELECT conv_id, count(*) AS n, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps, count(*) FILTER (WHERE blank) AS blank,
    count(*) FILTER (WHERE duplicate) AS duplicate, count(*) FILTER (WHERE cut) AS truncated, count(*) FILTER (WHERE illegal) AS illegal FROM faults GROUP BY conv_id),
step(state, role, given, goal) AS (VALUES
  (0, 's', '', 1), (0, 'u', 'user', 2), (1, 'u', 'user', 2), (2, 'a', 'assistant', 3), (3, 'u', 'user', 2)),
ins(state, goal, letters, price, out) AS (
  SELECT s, s, '', 0, []::VARCHAR[] FROM range(4) r(s)
  UNION ALL SELECT state, goal, 'I', 5, [given || ':'] FROM step WHERE given <> ''
  UNION ALL SELECT a.state, b.goal, 'II', 10, [a.given || ':', b.given || ':'] FROM step a JOIN step b ON a.goal = b.state WHERE a.given <> '' AND b.given <> ''),
edits AS (
  SELECT conv_id, n, state, state AS goal, 'D' AS letter, 2 AS price, []::VARCHAR[] AS out FROM faults, (SELECT DISTINCT state FROM ins)
  UNION ALL SELECT conv_id, n, s.state, s.goal, 'K', CASE WHEN cut THEN 5 ELSE 0 END, [f.role || ':' || text]
    FROM faults f JOIN step s ON f.role[1:1] = s.role WHERE NOT blank AND NOT duplicate
  UNION ALL SELECT conv_id, n, state, goal, 'R', CASE WHEN cut THEN 6 ELSE 1 END, [given || ':' || text]
    FROM faults, step WHERE NOT blank AND NOT duplicate AND given <> ''),
walk(conv_id, n, state, cost, audit, out) AS (
  SELECT DISTINCT conv_id, CAST(0 AS BIGINT), 0, 0, '', []::VARCHAR[] FROM conversations
  UNION ALL
  SELECT conv_id, n, state, cost, audit, out FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, state ORDER BY cost, audit) AS place FROM (
      SELECT w.conv_id, e.n, e.goal AS state, w.cost + i.price + e.price AS cost, w.audit || i.letters || e.letter AS audit,
        list_concat(w.out, list_concat(i.out, e.out)) AS out
      FROM walk w JOIN ins i ON i.state = w.state
      JOIN edits e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.n = w.n + 1 AND e.state = i.goal))
  WHERE place = 1),
done AS (
  SELECT w.conv_id, w.cost + i.price AS cost, w.audit || i.letters AS audit, list_concat(w.out, i.out) AS out,
    coalesce(c.gaps, 0) AS gaps, coalesce(c.blank, 0) AS blank, coalesce(c.duplicate, 0) AS duplicate, coalesce(c.truncated, 0) AS truncated,
    coalesce(c.illegal, 0) AS illegal,
    row_number() OVER (PARTITION BY w.conv_id ORDER BY w.cost + i.price, w.audit || i.letters) AS place
  FROM walk w JOIN ins i ON i.state = w.state LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM w.conv_id
  WHERE w.n = coalesce(c.n, 0) AND i.goal IN (0, 3))
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, CAST(cost AS BIGINT) AS cost, audit,
  sha256(array_to_string(out, chr(10))) AS repaired_sha256 FROM done WHERE place = 1
"""
