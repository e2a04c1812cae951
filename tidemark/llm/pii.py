"""Personal data: proposed spans, scored by boosted trees, selected by calibrated thresholds.

Generators with high recall propose spans that may overlap. Spans of the strict
forms (email, ip, card, phone) are always reported. Every other kind has a validator
of its own (numbering plan, number ranges, IBAN sum, letters in the top domain; no word
right before it that names another kind), and what it rejects is never reported. What it passes is reported where the value speaks
for itself (IBAN, spoken e-mail) or a word of its kind stands before it, and else by
the score of gradient-boosted trees over format and context features.

The trees learn the validators' verdicts, which are not features, on strict spans,
their near misses and the further candidates outside strict spans. A validator also
passes some look-alikes by chance (``CHANCE``), so each kind has a threshold of its own:
the lowest score whose held-out share of passes, less that chance, reaches ``precision``.
A kind without enough held-out examples has no threshold.

Built-in functions only: the trees become one SQL expression, evaluated inside the
row. The fit reads every document: equal examples are counted first, and the trees learn
from the different ones by weight. Every document is searched.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import evaluated_once
from tidemark.llm.text import joined, let, shield, spans, tagged

# Strict forms. Possessive quantifiers and look-behinds change no match; they
# keep the matcher from trying the inside of a run again, so cost stays linear.
EMAIL = r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
IP_PARTS = r"^0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})(?:\.0*(?:25[0-5]|2[0-4][0-9]|[01]?[0-9]{1,2})){3}$"
DIGITS = r"[0-9]++(?:[\x20-][0-9]++)*+"
DIGITS_GATE = r"[0-9](?:[\x20-]?[0-9]){11}"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"

# Lengths of IBANs by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FK FO GL NL SD", 19: "MK SI", 20: "AT BA EE KZ LT LU MN XK", 21: "CH HR LI LV",
    22: "BG BH CR DE GB GE IE ME RS VA", 23: "AE GI IL IQ OM SO TL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "LY PT ST",
    26: "IS TR", 27: "BI DJ FR GR IT MC MR SM", 28: "AL AZ BY CY DO GT HN HU LB NI PL SV", 29: "BR EG PS QA UA",
    30: "JO KW MU YE", 31: "MT SC", 32: "LC", 33: "RU",
}
_IBANS = "|".join(
    f"(?:{'|'.join(names.split())})[0-9]{{2}}(?:\\x20?[A-Z0-9]){{{n - 4}}}" for n, names in IBAN_LENGTHS.items()
)
# High-recall generators beyond the strict forms.
GENERATORS = (
    ("phone_local", 4, r"(?<![0-9.+-])\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}(?![0-9])"),
    ("id_number", 5, r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])"),
    ("iban", 6, rf"(?<![A-Za-z0-9])(?:{_IBANS})(?![A-Za-z0-9])"),
    ("email_spoken", 7,
     r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]++\x20?[\[(](?:at|AT)[\])]\x20?[A-Za-z0-9-]++(?:\x20?(?:[\[(](?:dot|DOT)[\])]|\.)\x20?[A-Za-z0-9-]++)++"),
)
# What the validators of the generators pass (numbering plan; issued ranges of SSN and ITIN;
# an address whose dots are spoken too, or whose top domain is a lower-case word right after a dot).
PLAN = r"^\(?[2-9](?!11)[0-8][0-9]\)?[\x20.-][2-9](?!11)[0-9]{2}[\x20.-][0-9]{4}$"
ISSUED = r"^(?:(?!000|666|9)[0-9]{3}-(?!00)[0-9]{2}|9[0-9]{2}-(?:5[0-9]|6[0-5]|7[0-9]|8[0-8]|9[0-24-9]))-(?!0000)[0-9]{4}$"
SPOKEN = r"(?:[\[(](?:dot|DOT)[\])]\x20?[A-Za-z]{2,24}|\.[a-z]{2,24})$"
# Share of look-alikes that a validator passes: 712 of 1000 areas and 792 exchanges; issued ranges; one of 97 sums.
CHANCE = {"phone_local": 0.712 * 0.792, "id_number": 0.898 * 0.99 + 0.1 * 0.44, "iban": 1 / 97}
# Words before a value that name its kind, and words right before it that name another.
OWN_WORDS = {
    "phone": r"(?i)call|phone|\btel\b|t[eé]l[eé]f|mobile|m[oó]vil|\bcell|handy|\bfax|dial|whatsapp|reach|appel|llam|\b(?:an)?ruf",
    "id_number": r"(?i)\bssn|social|security|\bitin\b|\btax|passport|s[eé]curit[eé]|seguro|sozialv",
}
OWN_WORDS["phone_local"] = OWN_WORDS["phone"]
OTHER_WORDS = (
    r"(?i)(?:\b(?:version|order|invoice|isbn|ticket|part|serial|tracking|model|case|ref|reference|item|sku|batch|bestellung|"
    r"rechnung|commande|facture|pedido|factura)\b[^A-Za-z0-9]*(?:(?:no|nr|number|id|is|code)\b[^A-Za-z0-9]*)*|\#\x20?)$"
)
GATES = {
    "phone_local": r"[0-9]{3}[\x20.-][0-9]{4}", "id_number": r"[0-9]{3}-[0-9]{2}-[0-9]{4}",
    "iban": r"[A-Z]{2}[0-9]{2}", "email_spoken": r"[\[(](?:at|AT)[\])]",
}
CONTEXT_WORDS = (
    r"(?i)call|phone|tel\b|mobile|fax|dial", r"(?i)mail|contact|write", r"(?i)card|visa|credit|account|pay|iban|bank",
    r"(?i)\bip\b|host|server|address|from", r"(?i)ssn|social|passport|born", r"(?i)version|order|invoice|isbn|ticket|\bno\b|#$",
)
CONTEXT = 24
TREES, DEPTH, BINS = 12, 3, 20
# MLlib looks for limits of features in all rows only up to the larger of 10,000 and the square of its bins.
SPLIT_BINS, SPLIT_ROWS = 32, 10_000
MIN_EXAMPLES, PRECISION = 30, 0.95


def luhn(value: Column) -> Column:
    """Whether the digits of ``value`` fulfil the Luhn sum."""

    def total(ds: Column) -> Column:
        n = F.size(ds)
        return F.aggregate(
            F.transform(
                ds,
                lambda d, i: let(
                    F.when((n - i) % 2 == 0, d * 2).otherwise(d), lambda x: F.when(x > 9, x - 9).otherwise(x)
                ),
            ),
            F.lit(0),
            lambda a, x: a + x,
        )

    digits = F.transform(
        F.filter(F.split(F.regexp_replace(value, "[^0-9]", ""), ""), lambda c: c != ""), lambda c: c.cast("int")
    )
    return let(digits, total) % 10 == 0


def iban_sum(value: Column) -> Column:
    """Whether the characters of ``value`` fulfil the IBAN sum (remainder 1 of 97)."""
    plain = F.replace(value, F.lit(" "), F.lit(""))
    turned = F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))

    def step(acc: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), acc * 10 + F.ascii(c) - 48).otherwise(acc * 100 + F.ascii(c) - 55) % 97

    return F.aggregate(F.filter(F.split(turned, ""), lambda c: c != ""), F.lit(0), step) == 1


def _digit_count(value: Column) -> Column:
    return F.length(F.regexp_replace(value, "[^0-9]", ""))


def _before(text: Column, s: Column) -> Column:
    return F.substring(text, F.greatest(s["start"] - CONTEXT + 1, F.lit(1)), F.least(s["start"], F.lit(CONTEXT)))


def _sure(text: Column, s: Column, kind: str) -> Column:
    """Whether a value that its validator passes needs no score."""
    return _before(text, s).rlike(OWN_WORDS[kind]) if kind in OWN_WORDS else F.lit(True)


def _other(text: Column, s: Column, kind: str) -> Column:
    """Whether the words right before a value say that it is of another kind."""
    return _before(text, s).rlike(OTHER_WORDS) if kind in OWN_WORDS else F.lit(False)


def _features(text: Column, s: Column, kind: str) -> Column:
    """Kind, format and context of a span; nothing that a validator decides."""
    value = s["value"]
    before = _before(text, s)
    after = F.substring(text, s["end"] + 1, F.lit(1))
    n = lambda p: F.regexp_count(value, F.lit(p)).cast("double")
    yes = lambda c: F.when(c, 1.0).otherwise(0.0)
    return F.array(
        F.length(value).cast("double"), n("[0-9]"), n("[A-Za-z]"), n(r"\."), n("-"), n(" "), n("[()]"), n("@"),
        yes(value.startswith("+")), yes(before.rlike(r"[A-Za-z0-9]$")), yes(after.rlike("[A-Za-z0-9]")),
        yes(before.rlike(r"[#$%&*|:=]\x20?$")), yes(value.rlike(r"([0-9])\1{4}")),
        *[yes(before.rlike(w)) for w in CONTEXT_WORDS],
        *[F.lit(float(kind == k)) for k, _, _ in GENERATORS],
    )


VALIDATORS = {
    "phone_local": lambda v: v.rlike(PLAN), "id_number": lambda v: v.rlike(ISSUED), "iban": iban_sum,
    "email_spoken": lambda v: v.rlike(SPOKEN),
}


def _candidates(text: Column) -> Column:
    """All proposed spans of a text with kind, verdicts and features.

    ``valid``: a strict span. ``passed``: the verdict of the kind's validator, null where it
    has none. ``sure``: reported without a score unless the verdict is no.
    """

    def form(found: Column, kind: str, rank: int, valid, passed=None, sure=None) -> Column:
        return F.transform(
            found,
            lambda s: F.struct(
                s["start"].alias("start"), F.lit(rank).alias("rank"), s["end"].alias("end"), F.lit(kind).alias("kind"),
                valid(s["value"]).alias("valid"), (passed(s) if passed else valid(s["value"])).alias("passed"),
                (sure(s) if sure else F.lit(False)).alias("sure"), _features(text, s, kind).alias("f"),
            ),
        )

    long_digits = F.filter(
        spans(text, DIGITS, text.rlike(DIGITS_GATE)), lambda s: _digit_count(s["value"]).between(12, 19)
    )
    phones = spans(text, PHONE, text.contains("+"))
    parts = [
        form(spans(text, EMAIL, text.contains("@")), "email", 0, lambda v: F.lit(True)),
        form(spans(text, IP, text.rlike(IP)), "ip", 1, lambda v: v.rlike(IP_PARTS)),
        form(long_digits, "card", 2, luhn),
        # 7 or 8 digits are a number in few countries only: no verdict, but open to the score.
        form(
            phones, "phone", 3, lambda v: _digit_count(v).between(9, 15),
            lambda s: F.when(_digit_count(s["value"]).between(7, 8) & ~_other(text, s, "phone"), None).otherwise(
                _digit_count(s["value"]).between(9, 15)
            ),
            lambda s: _digit_count(s["value"]).between(7, 8) & _sure(text, s, "phone"),
        ),
    ]
    for kind, rank, pattern in GENERATORS:
        parts.append(form(
            spans(text, pattern, text.rlike(GATES[kind])), kind, rank, lambda v: F.lit(False),
            lambda s, kind=kind: VALIDATORS[kind](s["value"]) & ~_other(text, s, kind),
            lambda s, kind=kind: _sure(text, s, kind),
        ))
    return F.concat(*parts)


def _apart(c: Column, spans_: Column) -> Column:
    """Whether a candidate touches none of the spans."""
    return ~F.exists(spans_, lambda x: (x["start"] < c["end"]) & (c["start"] < x["end"]))


@dataclass(frozen=True)
class SpanModel:
    """Trees as (feature, limit, left, right) tuples or leaf values, and the scores that select, by kind."""

    trees: tuple
    thresholds: tuple = ()

    @property
    def threshold(self) -> float:
        """The lowest score that selects any kind; above 1 if none does."""
        return min((t for _, t in self.thresholds), default=2.0)

    def limit(self, kind: Column) -> Column:
        """The score that selects a kind; 1.5, which no score reaches, if it has none."""
        out = F.lit(1.5)
        for name, t in self.thresholds:
            out = F.when(kind == name, F.lit(t)).otherwise(out)
        return out

    def score(self, f: Column) -> Column:
        def value(node) -> Column:
            if not isinstance(node, tuple):
                return F.lit(float(node))
            feature, limit, left, right = node
            return F.when(F.get(f, F.lit(feature)) <= F.lit(limit), value(left)).otherwise(value(right))

        margin = F.lit(0.0)
        for weight, tree in self.trees:
            margin = margin + F.lit(weight) * value(tree)
        return 1 / (1 + F.exp(-2 * margin))


NO_MODEL = SpanModel(())


def _parse_trees(text: str) -> tuple:
    lines = [x.strip() for x in text.splitlines()]

    def node(i: int):
        if lines[i].startswith("Predict"):
            return float(lines[i].split(":")[1]), i + 1
        feature, limit = re.match(r"If \(feature (\d+) <= ([-\d.eE]+)\)", lines[i]).groups()
        left, i = node(i + 1)
        right, i = node(i + 1)
        return (int(feature), float(limit), left, right), i

    out = []
    for i, line in enumerate(lines):
        found = re.match(r"Tree \d+ \(weight ([-\d.eE]+)\)", line)
        if found:
            out.append((float(found[1]), node(i + 1)[0]))
    return tuple(out)


def calibrated_threshold(bins: list[tuple[float, int, int]], precision: float = PRECISION, chance: float = 0.0) -> float:
    """Lowest score whose pooled held-out precision reaches ``precision``; above 1 if none does.

    Of look-alikes the share ``chance`` counts as positive; a pool must be so large that it
    is not all positive by that chance more than once in a hundred times. ``bins`` holds (lowest score, positives, negatives). Neighbouring bins are pooled
    until precision rises with the score, which is isotonic regression.
    """
    pools: list[list[float]] = []
    for low, pos, neg in sorted(bins):
        pools.append([low, pos, neg])
        while len(pools) > 1 and pools[-2][1] * (pools[-1][1] + pools[-1][2]) >= pools[-1][1] * (pools[-2][1] + pools[-2][2]):
            low2, pos2, neg2 = pools.pop()
            pools[-1][1] += pos2
            pools[-1][2] += neg2
    least = max(10.0, math.log(0.01) / math.log(chance) if chance else 0.0)
    for low, pos, neg in pools:
        if pos + neg >= least and pos >= (chance + (1 - chance) * precision) * (pos + neg):
            return low
    return 2.0


def examples(docs: DataFrame) -> DataFrame:
    """(held, label, kind, f, n): the different examples of all of ``docs`` and how often each occurs."""
    place = F.pmod(F.xxhash64(F.lit("pii"), "doc_id", "text"), F.lit(1_000_000)) / 1_000_000
    text = F.coalesce(F.col("text"), F.lit(""))
    labelled = lambda cands: let(
        F.filter(cands, lambda c: c["valid"]),
        lambda base: F.filter(cands, lambda c: c["passed"].isNotNull() & (c["valid"] | _apart(c, base))),
    )
    return (
        docs.select(place.alias("place"), F.explode(let(let(text, _candidates), labelled)).alias("c"))
        .groupBy(
            (F.pmod(F.floor(F.col("place") * 1_000_000), F.lit(10)) < 3).alias("held"),
            F.when(F.col("c.passed"), 1.0).otherwise(0.0).alias("label"),
            F.col("c.kind").alias("kind"), F.col("c.f").alias("f"),
        )
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fit(docs: DataFrame, precision: float = PRECISION) -> SpanModel:
    """Fit the trees and the thresholds on all of ``docs``."""
    rows = examples(docs).withColumn("features", array_to_vector("f")).persist()
    try:
        seen = rows.groupBy("held", "label", "kind").agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("rows")).collect()
        if min(sum(r["n"] for r in seen if not r["held"] and r["label"] == v) for v in (0.0, 1.0)) < MIN_EXAMPLES:
            return NO_MODEL
        # Kinds with enough examples weigh the same, so that frequent ones do not shape all trees.
        size = {k: sum(r["n"] for r in seen if not r["held"] and r["kind"] == k) for k in sorted({r["kind"] for r in seen})}
        weight = F.lit(1.0)
        for k, n in size.items():
            if n >= MIN_EXAMPLES:
                weight = F.when(F.col("kind") == k, F.lit(max(size.values()) / n)).otherwise(weight)
        different = sum(r["rows"] for r in seen if not r["held"])
        gbt = GBTClassifier(
            maxIter=TREES, maxDepth=DEPTH, seed=7, featuresCol="features", labelCol="label", weightCol="weight",
            maxBins=SPLIT_BINS if different <= SPLIT_ROWS else math.isqrt(different) + 1,
        )
        train = rows.where(~F.col("held")).withColumn("weight", weight * F.col("n")).coalesce(different // SPLIT_ROWS + 1)
        trees = _parse_trees(gbt.fit(train).toDebugString)
        score = F.floor(SpanModel(trees).score(F.col("f")) * BINS) / BINS
        bins: dict[str, list] = {}
        for r in (
            rows.where("held").groupBy("kind", score.alias("low"))
            .agg(F.sum(F.col("label") * F.col("n")).cast("long").alias("pos"), F.sum((1 - F.col("label")) * F.col("n")).cast("long").alias("neg"))
            .collect()
        ):
            bins.setdefault(r["kind"], []).append((r["low"], r["pos"], r["neg"]))
        limits = {k: calibrated_threshold(v, precision, CHANCE.get(k, 0.0)) for k, v in sorted(bins.items())}
        return SpanModel(trees, tuple((k, t) for k, t in limits.items() if t <= 1))
    finally:
        rows.unpersist()


def find_personal_data(docs: DataFrame, model: SpanModel, text: str = "text") -> DataFrame:
    """Add ``base`` (strict spans) and ``found`` (selected further spans).

    Of overlapping further spans a sure one stays before a scored one, then the one with the
    higher score, then the earlier;
    spans that touch a strict one are left out. Null and empty texts have neither.
    Rows are judged one by one; other columns pass through, whatever their names, but ``base`` and
    ``found`` are replaced.
    """
    docs, named = shield(docs, [text], ["base", "found"])

    def choose(cands: Column) -> Column:
        base = F.filter(cands, lambda c: c["valid"])

        def best(b: Column) -> Column:
            scored = F.filter(
                F.transform(
                    F.filter(
                        cands,
                        lambda c: ~c["valid"] & F.coalesce(c["passed"], F.lit(True)) & _apart(c, b),
                    ),
                    lambda c: F.struct(
                        F.when(c["sure"], -2.0).otherwise(-model.score(c["f"])).alias("order"), c["start"].alias("start"), c["rank"].alias("rank"),
                        c["end"].alias("end"), c["kind"].alias("kind"),
                    ),
                ),
                lambda c: c["order"] <= -model.limit(c["kind"]),
            )
            picked = F.aggregate(
                F.sort_array(scored),
                F.array().cast("array<struct<order:double,start:int,rank:int,end:int,kind:string>>"),
                lambda acc, c: F.when(
                    F.exists(acc, lambda x: (x["start"] < c["end"]) & (c["start"] < x["end"])), acc
                ).otherwise(F.concat(acc, F.array(c))),
            )
            tag = lambda c: F.struct(c["start"].alias("start"), c["rank"].alias("rank"), c["end"].alias("end"), c["kind"].alias("kind"))
            return F.struct(F.transform(b, tag).alias("base"), F.transform(picked, tag).alias("found"))

        return let(base, best)

    t = F.coalesce(F.col(f"`{text}`"), F.lit(""))
    scanned = evaluated_once(docs, _s=let(t, lambda x: let(_candidates(x), choose)))
    return named(scanned.select(*docs.columns, "_s.base", "_s.found"))


def redact(found: DataFrame, text: str = "text") -> DataFrame:
    """Add ``redacted``: the text with every span replaced by its kind in brackets.

    Where spans overlap, the later start is cut to what the earlier one leaves.
    """

    def build(t: Column, all_spans: Column) -> Column:
        start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

        def add(acc: Column, s: Column) -> Column:
            gap = F.substring(t, acc["at"] + 1, F.greatest(s["start"] - acc["at"], F.lit(0)))
            return F.when(s["end"] <= acc["at"], acc).otherwise(
                F.struct(F.concat(acc["out"], gap, F.lit("["), s["kind"], F.lit("]")).alias("out"), s["end"].alias("at"))
            )

        return F.aggregate(all_spans, start, add, lambda acc: F.concat(acc["out"], F.substring(t, acc["at"] + 1, F.length(t))))

    t = F.coalesce(F.col(text), F.lit(""))
    return found.withColumn("redacted", let(F.sort_array(F.concat("base", "found")), lambda s: build(t, s)))


def digest(found: DataFrame) -> DataFrame:
    """Counts, hash and list of the spans per document."""
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select(
        "doc_id", count("email"), count("ip"), count("card"), count("phone"),
        F.sha2(joined(F.col("base")), 256).alias("base_sha256"),
        joined(F.concat("base", "found")).alias("spans"),
    )


__all__ = ["SpanModel", "calibrated_threshold", "digest", "examples", "find_personal_data", "fit", "luhn", "redact", "tagged"]
