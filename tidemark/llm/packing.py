"""Packing documents into sequences of fixed length with few sequences.

1. Texts become ids, an end id is added, and only documents longer than a sequence are
   cut. Each piece gets its rank among pieces of its length: a counter inside the task
   and, per (task, length), the count in earlier tasks.
2. The histogram of lengths (at most ``capacity`` numbers) goes to the driver. There a
   linear program over configurations (multisets of length classes that fit) is solved by
   multiplicative weights: prices of classes grow by factors where they are covered too
   little, uses of configurations where they earn more than a sequence costs. A knapsack
   dynamic program finds the configuration of the highest total price, which joins the
   known ones. Prices over its value are a feasible dual, so every round also bounds the
   optimum from below (as the sum of lengths does); rounds end when use and bound are GAP
   apart, or after ROUNDS. Lengths up to a sixteenth of the capacity are no items of the
   program: they fill gaps.
3. Rounding: each configuration is used the whole number of times below its use, then, by
   falling remainder, once more. All but its last two classes get the largest real lengths
   of the class; the rest of the sequence is filled, exactly where one or two lengths that
   are left do so. What no configuration takes is begun with the largest length left and
   filled in the same way.
4. The plan is a table of (length, range of ranks) -> (sequences, offset). Its size depends
   on ``capacity`` only, so it is broadcast; pieces find their place by binary search.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.tokens import WordEncoder, slices, tokenizer_path
from tidemark.session import written

CAPACITY = 4096
END_ID = 1
CLASSES = 64
ROUNDS = 200
STEPS = 300
SMALL = 16
GAP = 0.002

_PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, part int, local long"
_PLACED = "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """Pieces of every document, with the task they were made in and their rank there by length.

    A null text counts as empty and is one piece with the end id alone; rows that repeat
    are packed as often as they come; a null id stays null.
    """

    def cut(parts: Iterator) -> Iterator:
        import zlib

        import pyarrow as pa
        from pyspark import TaskContext

        encoder = WordEncoder(tokenizer_path(tokenizer))
        part, seen = TaskContext.get().partitionId(), [0] * (capacity + 1)
        end = np.asarray([end_id], dtype="<u4").tobytes()
        for batch in parts:
            for some in slices(batch, "text"):
                out: list[list] = [[] for _ in range(7)]
                for doc, ids in zip(some.column("doc_id").to_pylist(), encoder.encode(some.column("text"))):
                    ids += end
                    for i, at in enumerate(range(0, len(ids), 4 * capacity)):
                        piece = ids[at : at + 4 * capacity]
                        n = len(piece) // 4
                        for column, v in zip(out, (doc, i, at // 4, n, zlib.crc32(piece), part, seen[n])):
                            column.append(v)
                        seen[n] += 1
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int32(), *[pa.int64()] * 3, pa.int32(), pa.int64()))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32", "part", "local"],
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(cut, _PIECES)


def price_configuration(weights: np.ndarray, values: np.ndarray, most: np.ndarray, capacity: int) -> np.ndarray:
    """Counts per item kind of the most valuable multiset that fits (bounded knapsack, binary splitting)."""
    items = []
    for kind, (w, m) in enumerate(zip(weights, most)):
        left, k = int(min(m, capacity // w)), 1
        while left > 0:
            k = min(k, left)
            items.append((kind, k, int(w) * k))
            left -= k
            k *= 2
    best = np.zeros(capacity + 1)
    took = np.zeros((len(items), capacity + 1), dtype=bool)
    for row, (kind, k, w) in enumerate(items):
        better = best[: capacity + 1 - w] + k * values[kind]
        took[row, w:] = better > best[w:]
        np.maximum(best[w:], better, out=best[w:])
    counts, room = np.zeros(len(weights), dtype=np.int64), capacity
    for row in range(len(items) - 1, -1, -1):
        if took[row, room]:
            kind, k, w = items[row]
            counts[kind] += k
            room -= w
    return counts


class Solution(NamedTuple):
    """Uses of configurations over length classes that cover every class, and a lower bound of their sum."""

    grain: int
    kinds: np.ndarray
    used: dict[tuple[int, ...], float]
    bound: float

    @property
    def gap(self) -> float:
        total = sum(self.used.values())
        return total / self.bound - 1 if self.bound else 0.0


def fractional_solution(histogram: dict[int, int], capacity: int, classes: int = CLASSES, rounds: int = ROUNDS) -> Solution:
    """The linear program's solution; a class holds lengths up to a multiple of ``capacity / classes``, counted in those units."""
    grain = max(1, math.ceil(capacity / classes))
    units = capacity // grain
    sums: dict[int, int] = {}
    for length, n in histogram.items():
        k = math.ceil(length / grain)
        if length * SMALL > capacity and k <= units:
            sums[k] = sums.get(k, 0) + n
    kinds = np.array(sorted(sums), dtype=np.int64)
    if not len(kinds):
        return Solution(grain, kinds, {}, 0.0)
    need = np.array([sums[k] for k in kinds], dtype=float)
    most = np.minimum(need, units)
    # To begin with, each class has a configuration of its own.
    configs = np.diag(np.minimum(units // kinds, need))
    uses = need / np.diag(configs)
    known = {tuple(c) for c in configs.T}
    bound = float((kinds * need).sum()) / units
    best, best_uses = float(uses.sum()), uses
    for r in range(rounds):
        width, rate = max(0.004, 0.3 * 0.95**r), max(0.02, 0.5 * 0.97**r)
        share = configs / need[:, None]
        prices = mean = np.zeros(len(kinds))
        for step in range(STEPS):
            prices = np.exp(np.clip((1 - share @ uses) / width, -60, 6))
            earned = best * (prices @ share)
            uses = np.maximum(uses * np.exp(rate * np.clip(earned - 1, -1, 1)), 1e-6 * best / len(uses))
            mean = mean + prices if 2 * step >= STEPS else mean
        least = float((share @ uses).min())
        if least > 0 and uses.sum() / least < best:
            best, best_uses = float(uses.sum()) / least, uses / least
        for y in (prices / need, mean / need):
            config = price_configuration(kinds, y, most, units)
            worth = float((config * y).sum())
            bound = max(bound, float((need * y).sum()) / worth if worth > 0 else 0.0)
            if worth > 0 and tuple(config) not in known:
                known.add(tuple(config))
                configs = np.hstack([configs, config[:, None].astype(float)])
                uses = np.append(uses, best / 200)
        if best <= (1 + GAP) * bound:
            break
    used = {tuple(int(v) for v in c): float(x) for c, x in zip(configs.T, best_uses) if x > 1e-9}
    return Solution(grain, kinds, used, bound)


def plan(histogram: dict[int, int], capacity: int = CAPACITY, classes: int = CLASSES, rounds: int = ROUNDS):
    """Patterns (counts by length) with the number of sequences that use each; all pieces are used."""
    return rounded(histogram, capacity, fractional_solution(histogram, capacity, classes, rounds))


def rounded(histogram: dict[int, int], capacity: int, solution: Solution):
    """Whole uses of the configurations in real lengths that fill their sequences, then sequences for what is left."""
    left = np.zeros(capacity + 1, dtype=np.int64)
    for s, n in histogram.items():
        left[s] = n
    out: list[tuple[dict[int, int], int]] = []

    def largest(high: int, low: int = 0) -> int:
        """The largest length above ``low`` and up to ``high`` that is left, else 0."""
        found = np.flatnonzero(left[low + 1 : high + 1])
        return low + 1 + int(found[-1]) if len(found) else 0

    def fill(pattern: dict[int, int], room: int, near: int) -> None:
        """Lengths for ``room``: one or two that fill it (the larger one close to ``near``), or the largest that fits and so on."""
        while room > 0:
            pick = room if left[room] else 0
            if not pick:
                have = left[1:room] > 0
                both = have & have[::-1]
                if room % 2 == 0 and left[room // 2] < 2:
                    both[room // 2 - 1] = False
                pairs = np.flatnonzero(both[room // 2 - 1 + room % 2 :]) + room // 2 + room % 2
                pick = int(pairs[np.abs(pairs - near).argmin()]) if len(pairs) else largest(room)
            if not pick:
                return
            left[pick] -= 1
            pattern[pick] = pattern.get(pick, 0) + 1
            room -= pick

    def emit(pattern: dict[int, int], at_most: int) -> int:
        """Use a pattern whose lengths have been taken once, as often as they are left."""
        times = 1 + min([at_most - 1, *[int(left[s]) // m for s, m in pattern.items()]])
        for s, m in pattern.items():
            left[s] -= m * (times - 1)
        out.append((pattern, times))
        return times

    def use(config: tuple[int, ...], times: int) -> None:
        items = [k for k, m in zip(solution.kinds.tolist(), config) for _ in range(m)][::-1]
        head, near = items[: max(1, len(items) - 2)], items[-2] * solution.grain if len(items) > 2 else capacity
        while times > 0:
            pattern: dict[int, int] = {}
            room = capacity
            for k in head:
                s = largest(min(room, k * solution.grain), (k - 1) * solution.grain)
                if not s:  # the class has run out: what is left of its share is packed below
                    for t, m in pattern.items():
                        left[t] += m
                    return
                left[s] -= 1
                pattern[s] = pattern.get(s, 0) + 1
                room -= s
            fill(pattern, room, near)
            times -= emit(pattern, times)

    ranked = sorted(solution.used.items(), key=lambda c: (-c[1], c[0]))
    for config, x in ranked:
        use(config, int(x))
    for config, _ in sorted(ranked, key=lambda c: int(c[1]) - c[1]):
        use(config, 1)
    while first := largest(capacity):
        left[first] -= 1
        pattern = {first: 1}
        fill(pattern, capacity - first, capacity)
        emit(pattern, 1 << 62)
    return out


def place_table(patterns) -> np.ndarray:
    """Rows (length, first rank, per sequence, first sequence, offset), sorted by the first two."""
    rows, ranks, sequence = [], {}, 0
    for pattern, copies in patterns:
        offset = 0
        for s, m in sorted(pattern.items(), reverse=True):
            rows.append((s, ranks.get(s, 0), m, sequence, offset))
            ranks[s] = ranks.get(s, 0) + m * copies
            offset += s * m
        sequence += copies
    rows.sort()
    return np.array(rows, dtype=np.int64).reshape(-1, 5)


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """A row per piece with its sequence and its offset there; see the contract of ``pieces``.

    The table must be non-empty for any sequence to exist; empty input gives no rows.
    """
    spark = docs.sparkSession
    made = written(pieces(docs, tokenizer, capacity, end_id), "pieces")
    counts = made.groupBy("part", "length").agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counts.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("part", "length", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    ranked = made.join(before, ["part", "length"]).select(
        "doc_id", "piece", "start", "length", "ids_crc32", (F.col("before") + F.col("local")).alias("rank")
    )
    table = spark.sparkContext.broadcast(place_table(plan(histogram, capacity)))

    def place(parts: Iterator) -> Iterator:
        import pyarrow as pa

        rows = table.value
        starts: dict[int, tuple[int, int]] = {}
        lengths, first = np.unique(rows[:, 0], return_index=True)
        ends = np.append(first[1:], len(rows))
        for s, a, b in zip(lengths.tolist(), first.tolist(), ends.tolist()):
            starts[s] = (a, b)
        for batch in parts:
            length = batch.column("length").to_numpy()
            rank = batch.column("rank").to_numpy()
            at = np.zeros(len(rank), dtype=np.int64)
            for s in np.unique(length).tolist():
                a, b = starts[s]
                mine = length == s
                at[mine] = a + np.searchsorted(rows[a:b, 1], rank[mine], side="right") - 1
            inside = rank - rows[at, 1]
            per = rows[at, 2]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in ("doc_id", "piece", "start", "length", "ids_crc32")],
                 pa.array(rows[at, 3] + inside // per), pa.array(rows[at, 4] + (inside % per) * length)],
                names=["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    return ranked.mapInArrow(place, _PLACED)
