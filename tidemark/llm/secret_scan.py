"""Secrets in texts: fixed forms, and strings whose characters look random.

The random ones are runs of key characters. A window slides over each run, per
character class (hexadecimal, base 36, base 32, base 64); counts of the characters in it are
updated by the one that enters and the one that leaves, and with them the sum of
``c * log2(c)``, so a step never recounts the window. A run is reported when the
largest window entropy of its class reaches the class limit, unless an allow-list
entry matches it or the text just before it, or a fixed form covers it. In URLs the candidates
are whole parts (user info, path segments, parameters), as a path is not one value.

Built-in functions only; no shuffle.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import evaluated_once
from tidemark.llm.text import SPAN, joined, let, shield, spans, tagged

# The forms that are always reported.
ASSIGN = r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ASSIGN_VALUE = r"""^(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]{8,})$"""
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"

RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}={0,2}"
# In a URL only a whole part of it is a candidate: user info, a path segment, a parameter.
URL_PART = r"""(?<=[/:=])(?=[A-Za-z0-9_+-]*[A-Za-z0-9]{16})[A-Za-z0-9_+-]{20,}={0,2}(?=[/?&@#;,\s"'<>)\]]|$)"""
IN_URL = r"""[A-Za-z][A-Za-z0-9+.-]*://[^\s"'<>]*$"""
URL_REACH = 400
WINDOW = 20


@dataclass(frozen=True)
class CharacterClass:
    """A class: its alphabet, the form of a candidate, and the entropy (bits) that makes it a finding."""

    kind: str
    rank: int
    alphabet: str
    form: str
    limit: float


_PREFIX = r"(?:[a-z]{2,8}[_-]){0,3}"
#: A candidate belongs to the first class whose form and limit it meets.
CLASSES = (
    CharacterClass(
        "entropy_hex", 3, "0123456789abcdef",
        r"^(?=(?:[^0-9]*[0-9]){4})(?=(?:[^A-Fa-f]*[A-Fa-f]){4})(?:[0-9a-f]+|[0-9A-F]+)$", 3.0,
    ),
    CharacterClass(
        "entropy_base36", 5, "abcdefghijklmnopqrstuvwxyz0123456789",
        rf"^{_PREFIX}(?=(?:[a-z]*[0-9]){{4}})(?=(?:[0-9]*[a-z]){{4}})[a-z0-9]{{20,}}$", 3.5,
    ),
    CharacterClass(
        "entropy_base32", 6, "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567=",
        r"^(?=(?:[A-Z]*[2-7]){2})(?=(?:[2-7]*[A-Z]){4})[A-Z2-7]{20,}={0,2}$", 3.5,
    ),
    CharacterClass(
        "entropy_base64", 4, "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_-=",
        r"^(?=(?:[^0-9]*[0-9]){2})(?=(?:[^a-z]*[a-z]){2})(?=(?:[^A-Z]*[A-Z]){2}).+$", 3.6,
    ),
)
#: Suppressed values: checksums that say so, placeholders by a whole part of the value, and series.
ALLOWED_VALUES = (
    r"(?i)^(?:(?:sha(?:1|224|256|384|512)|md5)[-_]|example|sample|dummy|placeholder|changeme|your[_-])|(?:^|[_/-])(?:example|sample|dummy|placeholder|changeme|your|xxxx+)(?:[_/-]|$)"
    r"|example(?:key|token)?$|(.)\1{7}|0123456789|123456789|abcdefghij"
)
#: Suppressed places: right behind a word, on its line, that announces something else than a secret.
ALLOWED_BEFORE = r"(?i)(?:sha-?(?:1|224|256|384|512)|md5|crc32|commit|checksum|digest|integrity|uuid|guid)[\x20\t:=_\"'/-]{0,4}$"
# Prefixes of issued keys, which no place excuses.
ISSUED = r"^(?:gh[opsur]_|github_pat_|glpat-|xox[abeprs]-|sk_live_|rk_live_|AIza)"


def window_entropy(value: Column, alphabet: str, width: int = WINDOW) -> Column:
    """Largest Shannon entropy (bits) of the windows of ``width`` characters; 0 for shorter values.

    Characters outside ``alphabet`` share one more symbol.
    """
    weight = F.array(*[F.lit(c * math.log2(c) if c else 0.0) for c in range(width + 2)])
    size = len(alphabet) + 1

    def slide(codes: Column, table: Column) -> Column:
        start = F.struct(
            F.array_repeat(F.lit(0), size).alias("counts"), F.lit(0.0).alias("sum"), F.lit(0.0).alias("best")
        )

        def step(acc: Column, i: Column) -> Column:
            enters = F.element_at(codes, i)
            leaves = F.when(i > width, F.element_at(codes, F.greatest(i - width, F.lit(1)))).otherwise(F.lit(-1))
            same = enters == leaves
            more, fewer = F.element_at(acc["counts"], enters + 1), F.get(acc["counts"], leaves)
            total = acc["sum"] + F.when(same, 0.0).otherwise(
                F.element_at(table, more + 2) - F.element_at(table, more + 1)
                + F.when(leaves >= 0, F.get(table, fewer - 1) - F.get(table, fewer)).otherwise(0.0)
            )
            counts = F.when(same, acc["counts"]).otherwise(
                F.transform(
                    acc["counts"],
                    lambda c, k: c + F.when(k == enters, 1).otherwise(0) - F.when(k == leaves, 1).otherwise(0),
                )
            )
            entropy = F.when(i >= width, F.lit(math.log2(width)) - total / width).otherwise(0.0)
            return F.struct(
                counts.alias("counts"), total.alias("sum"), F.greatest(acc["best"], entropy).alias("best")
            )

        return F.aggregate(F.sequence(F.lit(1), F.size(codes)), start, step, lambda acc: acc["best"])

    chars = F.transform(
        F.filter(F.split(value, ""), lambda c: c != ""),
        lambda c: F.when(F.instr(F.lit(alphabet), c) > 0, F.instr(F.lit(alphabet), c) - 1).otherwise(size - 1),
    )
    return let(
        chars, lambda codes: F.when(F.size(codes) >= width, let(weight, lambda w: slide(codes, w))).otherwise(0.0)
    )


def base_spans(text: Column) -> Column:
    """Tagged spans of the fixed forms."""
    assign = F.filter(spans(text, ASSIGN, text.rlike(ASSIGN)), lambda s: s["value"].rlike(ASSIGN_VALUE))
    return F.concat(
        tagged(assign, "assign", 0),
        tagged(spans(text, ACCESS, text.contains("AKIA")), "access", 1),
        tagged(spans(text, HEX, text.rlike(HEX)), "hex", 2),
    )


def _before(text: Column, start: Column, reach: int) -> Column:
    """Up to ``reach`` characters before a place."""
    return F.substring(text, F.greatest(start - reach + 1, F.lit(1)), F.least(start, F.lit(reach)))


def candidates(text: Column) -> Column:
    """Spans of runs of key characters outside URLs and of key-like parts of URLs."""
    in_url = lambda s: _before(text, s["start"], URL_REACH).rlike(IN_URL)
    linked = text.contains("://")
    runs = let(
        spans(text, RUN, text.rlike(RUN)),
        lambda found: F.when(linked, F.filter(found, lambda s: ~in_url(s))).otherwise(found),
    )
    return F.concat(runs, F.filter(spans(text, URL_PART, linked), in_url))


def entropy_spans(text: Column, base: Column) -> Column:
    """Tagged spans of random-looking runs that no base span covers and no allow-list entry excuses."""

    def open_to_question(s: Column) -> Column:
        excused = s["value"].rlike(ALLOWED_VALUES) | (
            ~s["value"].rlike(ISSUED) & _before(text, s["start"], 40).rlike(ALLOWED_BEFORE)
        )
        return ~excused & ~F.exists(base, lambda b: (b["start"] <= s["start"]) & (s["end"] <= b["end"]))

    def random(kind: CharacterClass, s: Column) -> Column:
        value = F.lower(s["value"]) if kind.kind == "entropy_hex" else s["value"]
        return s["value"].rlike(kind.form) & (window_entropy(value, kind.alphabet) >= kind.limit)

    def named(s: Column) -> Column:
        order = F.lit(None).cast("int")
        for i, kind in reversed(list(enumerate(CLASSES))):
            order = F.when(random(kind, s), i).otherwise(order)
        return F.struct(s["start"].alias("start"), s["end"].alias("end"), order.alias("of"))

    ranks, kinds = F.array(*[F.lit(c.rank) for c in CLASSES]), F.array(*[F.lit(c.kind) for c in CLASSES])
    judged = let(
        candidates(text), lambda runs: F.filter(F.transform(F.filter(runs, open_to_question), named), lambda c: c["of"].isNotNull())
    )
    return F.transform(
        judged,
        lambda c: F.struct(
            c["start"].alias("start"), F.get(ranks, c["of"]).alias("rank"), c["end"].alias("end"), F.get(kinds, c["of"]).alias("kind")
        ),
    )


def scan_secrets(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add ``base`` and ``found``: arrays of (start, rank, end, kind) of fixed forms and of random runs.

    A null or empty text has neither. Every row is judged by itself, so repeated rows,
    repeated or null ids and empty tables need no care; other columns pass through, whatever their
    names, but ``base`` and ``found`` are replaced.
    """
    docs, named = shield(docs, [text], ["base", "found"])

    def both(t: Column) -> Column:
        return let(
            base_spans(t), lambda base: F.struct(base.alias("base"), entropy_spans(t, base).alias("found"))
        )

    scanned = evaluated_once(docs, _s=let(F.coalesce(F.col(f"`{text}`"), F.lit("")), both))
    return named(scanned.select(*docs.columns, "_s.base", "_s.found"))


def digest(scanned: DataFrame) -> DataFrame:
    """Counts, hash and list of the spans per document."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    return scanned.select(
        "doc_id",
        count("assign").alias("n_assign"),
        count("access").alias("n_access"),
        count("hex").alias("n_hex"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "found")).alias("spans"),
    )


__all__ = ["SPAN", "base_spans", "digest", "entropy_spans", "scan_secrets", "window_entropy"]
