"""Repair of conversations: the cheapest edits that make the roles alternate.

Each row is kept, given another role, or deleted, and rows with an empty text may be inserted.
The roles' first letters must then read ``(s?(ua)+)?``. The grammar over spans is in Chomsky normal
form with a nonterminal for each pair of states of that pattern: ``[i,k]`` derives a span that
leads from state i to state k, by ``[i,k] -> [i,j] [j,k]`` or, for one row, by an edit between
insertions (their closure is computed once). A cell holds the least (cost, audit) of its span.

Every derivation of ``[i,k]`` passes some state at any given place, so one cut of a span gives
the same cell as all cuts. Hence cells are combined bottom-up by doubling lengths, and a long
conversation can be cut anywhere: tasks hold contiguous runs of the sorted rows, reduce each to
chunks of bounded length, and only the chunks' cells of a conversation meet.

Equal costs with audits of which one begins with the other cannot occur in a cell (the longer one
would have more insertions, hence a higher cost), so the least audits of parts make the least whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import written

# Faults by crc32 of "conversation:turn" modulo 20, and the costs of the edits.
FAULTS = 20
DROP, EMPTY, UNPUNCTUATED, REPEATED, AS_USER = range(5)
COST = {"K": 0, "R": 3, "D": 4, "I": 3}
TRUNCATED_COST = 3

#: Rows of a conversation that are reduced to one chunk.
CHUNK = 512
# States: nothing yet, after s, after u, after a; the pattern may end in the first and the last.
STATES = range(4)
STEP = {(0, "s"): 1, (0, "u"): 2, (1, "u"): 2, (2, "a"): 3, (3, "u"): 2}
ENDS = (0, 3)
TEXT = r"[^\x20\x09-\x0D]"

Cell = tuple[int, str]
Cells = tuple[tuple[Cell | None, ...], ...]


def _least(a: Cell | None, b: Cell | None) -> Cell | None:
    return b if a is None else a if b is None else min(a, b)


def joined(left: Cells, right: Cells) -> Cells:
    """Cells of a span from those of its two parts."""
    out = []
    for i in STATES:
        row: list[Cell | None] = [None] * len(STATES)
        for j in STATES:
            x = left[i][j]
            if x is not None:
                for k in STATES:
                    y = right[j][k]
                    if y is not None and (row[k] is None or x[0] + y[0] <= row[k][0]):
                        row[k] = _least(row[k], (x[0] + y[0], x[1] + y[1]))
        out.append(tuple(row))
    return tuple(out)


def _cells(moves: list[tuple[int, int, Cell]]) -> Cells:
    table: list[list[Cell | None]] = [[None] * len(STATES) for _ in STATES]
    for i, k, cell in moves:
        table[i][k] = _least(table[i][k], cell)
    return tuple(tuple(row) for row in table)


def _insertions() -> Cells:
    """Closure of inserting user and assistant rows."""
    one = _cells(
        [(i, i, (0, "")) for i in STATES] + [(i, k, (COST["I"], "I")) for (i, role), k in STEP.items() if role != "s"]
    )
    closed = one
    for _ in STATES:
        closed = joined(closed, one)
    return closed


EMPTY_SPAN = _insertions()


@lru_cache(maxsize=64)
def row_cells(initial: str, doomed: bool, truncated: bool) -> Cells:
    """Cells of one row: deleted, kept if its role's first letter allows, or given the other role."""
    moves = [(i, i, (COST["D"], "D")) for i in STATES]
    if not doomed:
        extra = TRUNCATED_COST if truncated else 0
        for (i, role), k in STEP.items():
            if role == initial:
                moves.append((i, k, (COST["K"] + extra, "K")))
            if role != "s":
                moves.append((i, k, (COST["R"] + extra, "R")))
    return joined(joined(EMPTY_SPAN, _cells(moves)), EMPTY_SPAN)


def span_cells(parts: list[Cells]) -> Cells:
    """Cells of the whole from those of adjacent spans, bottom-up by doubling lengths."""
    while len(parts) > 1:
        pairs = [joined(a, b) for a, b in zip(parts[::2], parts[1::2])]
        parts = pairs + parts[len(parts) & ~1 :]
    return parts[0] if parts else EMPTY_SPAN


class Row(NamedTuple):
    """What the grammar sees of a row: first letter of the role, whether it must go, whether it is cut off."""

    initial: str
    doomed: bool
    truncated: bool


@lru_cache(maxsize=1 << 16)
def _stretch(rows: tuple[Row, ...]) -> Cells:
    """Cells of a few rows; the same stretches come up again and again."""
    return span_cells([row_cells(*r) for r in rows])


def run_cells(rows: list[Row], stretch: int = 8) -> Cells:
    return span_cells([_stretch(tuple(rows[i : i + stretch])) for i in range(0, len(rows), stretch)])


def cheapest(cells: Cells) -> Cell:
    """(cost, audit) of a whole conversation; deleting all rows is always possible."""
    return min(cells[0][k] for k in ENDS if cells[0][k] is not None)


def repaired(roles_and_texts: Iterator[tuple[str, str]], audit: str) -> Iterator[str]:
    """``role:text`` of the rows that remain or are added; the audit fixes all new roles."""
    state, rows = 0, iter(roles_and_texts)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(rows)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == 2 else "user"
        state = STEP[state, role[:1]]
        yield f"{role}:{text}"


def damaged(conversations: DataFrame) -> DataFrame:
    """The rows (conv_id, turn, role, text) after the damage that ``conv_id:turn`` decides; a null is one space."""
    blank = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        blank("role").alias("role"), blank("text").alias("text"),
        F.pmod(F.crc32(F.concat(blank("conv_id"), F.lit(":"), blank("turn"))), F.lit(FAULTS)).alias("fault"),
    )
    fault = F.col("fault")
    text = (
        F.when(fault == EMPTY, "").when(fault == UNPUNCTUATED, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    )
    role = F.when(fault == AS_USER, "user").otherwise(F.col("role"))
    copies = F.when(fault == DROP, 0).when(fault == REPEATED, 2).otherwise(1)
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(F.array_repeat(F.lit(0), copies))).drop("col")


def _place() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text_hash"), F.col("seen")]


def _judged(rows: DataFrame) -> DataFrame:
    """A narrow row per run of equal rows: (conv_id, turn, role, text_hash, k copies, blank, truncated, seen earlier).

    Equal rows of a turn are counted first and the first place of a (role, text) is an
    aggregate, so neither a copied row nor a copied conversation meets in one task.
    """
    last = F.regexp_extract("text", rf"({TEXT})[\x20\x09-\x0D]*\z", 1)
    narrow = rows.select(
        "conv_id", "turn", "role", F.sha2("text", 256).alias("text_hash"), (~F.col("text").rlike(TEXT)).alias("blank"),
        ((last != "") & ~last.isin(".", "!", "?")).alias("truncated"),
    )
    runs = narrow.groupBy("conv_id", "turn", "role", "text_hash", "blank", "truncated").agg(F.count(F.lit(1)).alias("k"))
    turn = F.struct(F.col("turn").isNotNull(), "turn")
    first = runs.groupBy(
        F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("text_hash").alias("h")
    ).agg(F.min(turn).alias("first"), F.count(F.lit(1)).alias("runs"))
    repeats = first.where("runs > 1").drop("runs")
    return runs.join(
        repeats, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("role") == F.col("r")) & (F.col("text_hash") == F.col("h")), "left"
    ).select(
        "conv_id", "turn", "role", "text_hash", "k", "blank", "truncated",
        (F.col("first").isNotNull() & (F.col("first") < turn)).alias("seen"),
    )


_CELLS = "array<struct<cost:long,audit:string>>"
_CHUNKS = (
    "conv_id long, part int, number int, rows long, blank long, duplicate long, truncated long, illegal long, "
    f"turns long, low long, high long, first string, last string, cells {_CELLS}"
)
_LEGAL = ("su", "ua", "au")


class _Chunk:
    """Rows of one conversation as they come, in order."""

    def __init__(self, conv):
        self.conv, self.rows = conv, []
        self.blank = self.duplicate = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.first = self.last = None

    def add(self, turn, role: str, blank: bool, duplicate: bool, truncated: bool) -> None:
        initial = role[:1]
        duplicate, truncated = duplicate and not blank, truncated and not (blank or duplicate)
        self.blank += blank
        self.duplicate += duplicate
        self.truncated += truncated
        if self.rows:
            self.illegal += self.last + initial not in _LEGAL
        else:
            self.first = initial
        self.last = initial
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        self.rows.append(Row(initial, blank or duplicate, truncated))

    def figures(self) -> tuple:
        return (len(self.rows), self.blank, self.duplicate, self.truncated, self.illegal, self.turns, self.low, self.high, self.first, self.last)

    def cells(self) -> list:
        return [{"cost": None, "audit": None} if c is None else {"cost": c[0], "audit": c[1]} for r in run_cells(self.rows) for c in r]


def _chunks(rows: DataFrame) -> DataFrame:
    """A row per chunk: its place, its figures and its cells."""

    def reduce(parts: Iterator) -> Iterator:
        import pyarrow as pa
        from pyspark import TaskContext

        names = [c.split()[0] for c in _CHUNKS.split(f", cells {_CELLS}")[0].split(", ")] + ["cells"]
        kinds = [
            pa.int64(), pa.int32(), pa.int32(), *[pa.int64()] * 8, pa.string(), pa.string(),
            pa.list_(pa.struct([("cost", pa.int64()), ("audit", pa.string())])),
        ]
        part, number, now = TaskContext.get().partitionId(), 0, None
        out: list[tuple] = []

        def rows_of():
            nonlocal out
            done, out = out, []
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), kinds)], names=names)

        for batch in parts:
            columns = [batch.column(c).to_pylist() for c in ("conv_id", "turn", "role", "blank", "seen", "truncated", "k")]
            for conv, turn, role, blank, seen, truncated, k in zip(*columns):
                for copy in range(k):
                    if now is None or now.conv != conv or len(now.rows) == CHUNK:
                        if now is not None:
                            out.append((now.conv, part, number, *now.figures(), now.cells()))
                            number += 1
                        now = _Chunk(conv)
                    now.add(turn, role, blank, seen or copy > 0, truncated)
                    if len(out) >= 256:
                        yield rows_of()
        if now is not None:
            out.append((now.conv, part, number, *now.figures(), now.cells()))
        if out:
            yield rows_of()

    order = [F.col("conv_id").asc_nulls_first(), *_place()]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(reduce, _CHUNKS)


_WHOLE = "conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string"


def _conversations(chunks: DataFrame) -> DataFrame:
    """A row per conversation from its chunks, of which there is one per CHUNK rows or task."""

    names = [c.split()[0] for c in _WHOLE.split(", ")]

    def whole(parts: list[dict]) -> tuple:
        unpacked = [
            tuple(tuple(None if c["cost"] is None else (c["cost"], c["audit"]) for c in p["cells"][4 * i : 4 * i + 4]) for i in STATES)
            for p in parts
        ]
        cost, audit = cheapest(span_cells(unpacked))
        known = [p for p in parts if p["high"] is not None]
        distinct = sum(p["turns"] for p in known) - sum(a["high"] == b["low"] for a, b in zip(known, known[1:]))
        gaps = known[-1]["high"] - known[0]["low"] + 1 - distinct if known else 0
        illegal = sum(p["illegal"] for p in parts) + sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(parts, parts[1:]))
        sums = [sum(p[c] for p in parts) for c in ("blank", "duplicate", "truncated")]
        return (parts[0]["conv_id"], gaps, *sums, illegal, cost, audit)

    def fold(batches: Iterator) -> Iterator:
        import pyarrow as pa

        held: list[dict] = []
        for batch in batches:
            done = []
            for row in batch.to_pylist():
                if held and held[0]["conv_id"] != row["conv_id"]:
                    done.append(whole(held))
                    held = []
                held.append(row)
            if done:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.string() if n == "audit" else pa.int64()) for n, c in zip(names, zip(*done))], names=names
                )
        if held:
            yield pa.RecordBatch.from_arrays(
                [pa.array([v], pa.string() if n == "audit" else pa.int64()) for n, v in zip(names, whole(held))], names=names
            )

    return chunks.repartition("conv_id").sortWithinPartitions(F.col("conv_id").asc_nulls_first(), "part", "number").mapInArrow(fold, _WHOLE)


def _hashes(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(conv_id, repaired_sha256): the rows of a conversation pass in order behind its audit, none is held."""
    stream = audits.select(
        "conv_id", F.lit(0).alias("kind"), F.lit(None).cast("long").alias("turn"), F.lit("").alias("role"),
        F.lit("").alias("text_hash"), F.col("audit").alias("text"),
    ).unionByName(
        rows.select("conv_id", F.lit(1).alias("kind"), "turn", "role", F.sha2("text", 256).alias("text_hash"), "text")
    )

    def digest(parts: Iterator) -> Iterator:
        import pyarrow as pa

        def rest(batches):
            for batch in batches:
                yield from zip(*[batch.column(c).to_pylist() for c in ("conv_id", "kind", "role", "text")])

        stream = rest(parts)
        head = next(stream, None)
        found: list[tuple] = []
        while head is not None:
            conv, _, _, audit = head
            head = None

            def own():
                nonlocal head
                for row in stream:
                    if row[1] == 0:
                        head = row
                        return
                    yield row[2], row[3]

            left = own()
            total = hashlib.sha256()
            for i, line in enumerate(repaired(left, audit)):
                total.update(line.encode() if i == 0 else b"\n" + line.encode())
            for _ in left:  # moves on to the next conversation
                pass
            found.append((conv, total.hexdigest()))
            if len(found) == 4096 or head is None:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([c for c, _ in found], pa.int64()), pa.array([h for _, h in found])], names=["conv_id", "repaired_sha256"]
                )
                found = []

    order = [F.col("conv_id").asc_nulls_first(), F.col("kind"), F.col("turn").asc_nulls_first(), F.col("role"), F.col("text_hash")]
    return stream.repartition("conv_id").sortWithinPartitions(*order).mapInArrow(digest, "conv_id long, repaired_sha256 string")


def repair(rows: DataFrame) -> DataFrame:
    """Faults, cheapest edits and the hash of the repaired text, per conversation of ``rows`` (conv_id, turn, role, text).

    Rows are taken by turn, nulls first; equal turns by role, then by the text's hash. Roles and texts are not null.
    Equal rows of a turn count as often as they come. A null conv_id is a conversation of its own.
    The digest of a conversation is made by one task, as a hash of a sequence must be, which reads its
    rows as a stream. An empty table gives no rows.
    """
    chunks = written(_chunks(_judged(rows)), "chunks")
    found = written(_conversations(chunks), "repairs")
    hashes = _hashes(rows, found.select("conv_id", "audit"))
    return found.join(hashes.withColumnRenamed("conv_id", "_c"), F.col("conv_id").eqNullSafe(F.col("_c"))).drop("_c")


def damage_and_repair(conversations: DataFrame) -> DataFrame:
    """A row per original conv_id; one without rows after the damage has zeros, an empty audit and the hash of nothing."""
    mended = repair(damaged(conversations))
    names = conversations.select(F.col("conv_id").cast("long").alias("_name")).distinct()
    none = hashlib.sha256(b"").hexdigest()
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    return names.join(mended, F.col("_name").eqNullSafe(F.col("conv_id")), "left").select(
        F.col("_name").alias("conv_id"), *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in counts],
        F.coalesce("audit", F.lit("")).alias("audit"), F.coalesce("repaired_sha256", F.lit(none)).alias("repaired_sha256"),
    )
