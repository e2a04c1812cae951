"""License mentions: ordered signature rules over the words of a text.

Texts are reduced to lower-case words with single spaces, where rules are regular
expressions on whole words: forms around license names, and signatures of license texts,
headers, places and abbreviations. SPDX expressions give a label per id. A rule runs only
where its keyword occurs. Detections
are sorted by priority and length; one that lies inside a kept detection of the same
or higher priority is suppressed. Word positions are counted only for the base
phrases, which are reported wherever their words stand in a row.

One pass in Arrow batches; no shuffle.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from itertools import accumulate

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.license_rules import BASE, SPDX_PRIORITY, SPDX_WEIGHT, rules, spdx_ids, spdx_pattern

# Bytes between words (ASCII characters that are neither letters nor digits).
_GAPS = bytes(c for c in range(128) if not (48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122))
_TABLE = bytes.maketrans(_GAPS, b" " * len(_GAPS))

_OUT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, "
    "base_labels string, labels string, score double, "
    "detections array<struct<label:string,first_word:long,last_word:long,priority:int>>"
)


class RuleSet:
    """Compiled rules behind their keywords."""

    def __init__(self) -> None:
        by_keyword: dict[bytes, list] = {}
        for label, keyword, pattern, weight, priority in rules():
            compiled = re.compile(rb"(?<= )" + pattern.encode() + rb"(?= )")
            by_keyword.setdefault(keyword.encode(), []).append((label, compiled, weight, priority))
        self._rules = by_keyword
        tag, one = spdx_pattern()
        self._tag, self._id = re.compile(tag.encode()), re.compile(one.encode())
        self._ids = {i.encode(): label for i, label in spdx_ids().items()}
        # Every keyword holds one of these words' letters; most texts stop here.
        self._roots = sorted({max(k.split(), key=len) for k in by_keyword})
        self._root = re.compile(b"|".join(sorted(map(re.escape, self._roots), key=len, reverse=True)))

    def base_places(self, norm: bytes) -> list[tuple[int, str]]:
        """(word position, label) of every place of a base phrase."""
        found = []
        for phrase, label in BASE:
            needle = b" " + phrase.encode() + b" "
            at = norm.find(needle)
            while at >= 0:
                found.append((norm.count(b" ", 0, at), label))
                at = norm.find(needle, at + 1)
        return found

    def detections(self, norm: bytes) -> list[tuple[int, int, str, float, int]]:
        """Kept (start, end, label, weight, priority) in ``norm``, which starts and ends with a space."""
        if not self._root.search(norm):
            return []
        found = []
        for keyword, group in self._rules.items():
            if keyword in norm:
                for label, pattern, weight, priority in group:
                    found += [(m.start(), m.end(), label, weight, priority) for m in pattern.finditer(norm)]
        for m in self._tag.finditer(norm) if b" spdx license identifier " in norm else ():
            found += [
                (i.start(), i.end(), self._ids[i[0]], SPDX_WEIGHT, SPDX_PRIORITY) for i in self._id.finditer(norm, m.start(1), m.end(1) + 1)
            ]
        kept: list[tuple[int, int, str, float, int]] = []
        for level in sorted({d[4] for d in found}, reverse=True):
            kept.sort()
            starts = [k[0] for k in kept]
            reach = list(accumulate((k[1] for k in kept), max))
            furthest = -1
            for d in sorted((d for d in found if d[4] == level), key=lambda d: (d[0], -d[1], d[2])):
                at = bisect_right(starts, d[0])
                if d[1] > max(furthest, reach[at - 1] if at else -1):
                    kept.append(d)
                    furthest = d[1]
        return kept


def normalised(text: str | None) -> tuple[bytes, int]:
    """The words of a text between single spaces (one before and after), and their number."""
    ws = (text or "").encode().translate(_TABLE).lower().split()
    return b" " + b" ".join(ws) + b" ", len(ws)


def scan_licenses(docs: DataFrame) -> DataFrame:
    """A row per document: base places, labels of all rules, a score, and the kept detections.

    ``score`` is 1 minus the product of (1 - weight) over the kept detections, 0 without
    any. Null and empty texts have no words. Rows are judged one by one.
    """

    def scan(parts: Iterator) -> Iterator:
        import pyarrow as pa

        known = RuleSet()
        kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()]
        kinds.append(pa.list_(pa.struct([
            ("label", pa.string()), ("first_word", pa.int64()), ("last_word", pa.int64()), ("priority", pa.int32())])))
        names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "detections"]
        for batch in parts:
            out: list[list] = [[] for _ in names]
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                norm, n = normalised(text.as_py())
                base, kept = known.base_places(norm), known.detections(norm)
                miss = 1.0
                for d in kept:
                    miss *= 1 - d[3]
                labels = {label for _, label in base}
                row = (
                    doc, n, len(base), min(base)[0] if base else None, max(base)[0] if base else None,
                    ",".join(sorted(labels)), ",".join(sorted(labels | {d[2] for d in kept})), 1 - miss,
                    [{"label": d[2], "first_word": norm.count(b" ", 0, d[0]) - 1,
                      "last_word": norm.count(b" ", 0, d[1]) - 1, "priority": d[4]} for d in sorted(kept)],
                )
                for column, v in zip(out, row):
                    column.append(v)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, kinds)], names=names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(scan, _OUT)
