"""Quality rules with cutoffs whose false rejections are bounded (risk-controlled thresholds).

Every document gets a few statistics. For each statistic and stratum (language) the
labelled documents of good quality give, for each cutoff of a grid, how many of them
that cutoff would reject; the exact (Clopper-Pearson) upper bound of that rate must
stay below ``risk`` divided by the number of rules, so all rules together reject
at most ``risk`` of a stratum's good documents. The error probability ``delta`` is
shared equally by all strata and rules (Bonferroni), and cutoffs of one rule are
tried from the mildest on until one fails (fixed-sequence testing), so no further
correction is needed along the grid. Among the safe cutoffs the one is taken that
rejects most labelled bad documents, less PRICE for each good one; at a tie the
mildest. A stratum with too few labels gets no cutoff and loses nothing.

Built-in functions only, one statistics pass. The count table has one row per (stratum, rule, grid step).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.rows import evaluated_once
from tidemark.llm.text import let, shield, words
from tidemark.session import written

GRID = 50
RISK = 0.1
DELTA = 0.1
PRICE = 5
MIN_WORDS = 50
SMALL_ROWS = 100_000
RULES = ("symbol_share", "duplicate_line_share", "repeat_share", "shout_share", "bare_share")


def _counts(text: Column) -> Column:
    """Struct of word and line counts of one text, each word array computed once."""

    def windows(ws: Column) -> Column:
        n = F.size(ws)
        zipped = F.arrays_zip(
            F.slice(ws, 1, n - 2).alias("a"), F.slice(ws, 2, n - 2).alias("b"), F.slice(ws, 3, n - 2).alias("c")
        )
        return F.when(n >= 3, F.transform(zipped, lambda w: F.concat_ws(" ", w["a"], w["b"], w["c"]))).otherwise(
            F.array().cast("array<string>")
        )

    def covered(grams: Column) -> Column:
        """Words inside windows that occur twice or more: sort, compare neighbours, merge overlaps."""
        placed = F.sort_array(F.transform(grams, lambda g, i: F.struct(g.alias("g"), i.alias("i"))))
        n = F.size(grams)

        def repeated(p: Column) -> Column:
            hit = F.filter(
                F.transform(
                    p,
                    lambda x, k: F.when(
                        (F.get(p, k - 1)["g"] == x["g"]) | (F.get(p, k + 1)["g"] == x["g"]), x["i"]
                    ),
                ),
                lambda i: i.isNotNull(),
            )
            return let(
                F.sort_array(hit),
                lambda at: F.aggregate(
                    at,
                    F.struct(F.lit(0).alias("n"), F.lit(-3).alias("last")),
                    lambda acc, i: F.struct(
                        (acc["n"] + F.least(F.lit(3), i - acc["last"])).alias("n"), i.alias("last")
                    ),
                    lambda acc: acc["n"],
                ),
            )

        return F.when(F.size(F.array_distinct(grams)) == n, F.lit(0)).otherwise(let(placed, repeated))

    def stats(t: Column) -> Column:
        lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
        return let(
            words(t),
            lambda ws: F.struct(
                F.size(ws).cast("long").alias("n_words"),
                F.length(F.array_join(ws, "")).cast("long").alias("word_chars"),
                F.regexp_count(t, F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
                let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
                let(lines, F.size).cast("long").alias("n_lines"),
                let(windows(ws), covered).cast("long").alias("n_repeat_words"),
                F.regexp_count(t, F.lit(r"[A-Z]{2}")).cast("long").alias("n_shouts"),
                F.size(F.filter(ws, lambda w: ~w.rlike(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]"))).cast("long").alias("n_bare"),
            ),
        )

    return let(F.coalesce(text, F.lit("")), stats)


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, F.least(F.lit(1.0), part / whole)).otherwise(F.lit(0.0))


def with_statistics(docs: DataFrame, name: str = "_q") -> DataFrame:
    """Add the statistics of ``text`` as one struct; a null text counts as empty.

    Other columns pass through, whatever their names, but a column ``name`` is replaced.
    """
    docs, named = shield(docs, ["text"], [name])
    return named(evaluated_once(docs, **{name: _counts(F.col("text"))}))


def steps(q: Column) -> dict[str, Column]:
    """Grid step of each rule, 0 (best) to GRID; a rule rejects steps at or above its cutoff."""
    shares = {
        "symbol_share": _share(2 * q["n_symbols"], q["n_words"]),
        "duplicate_line_share": _share(q["n_dup_lines"], q["n_lines"]),
        "repeat_share": _share(q["n_repeat_words"], q["n_words"]),
        "shout_share": _share(3 * q["n_shouts"], q["word_chars"]),
        "bare_share": _share(q["n_bare"], q["n_words"]),
    }
    return {k: F.floor(v * GRID).cast("int") for k, v in shares.items()}


def base_failed(q: Column) -> Column:
    return (q["n_words"] < MIN_WORDS) | (100 * q["n_repeat_words"] > 50 * q["n_words"])


def allowed(n: Column, error: Column, risk: float) -> Column:
    """Most rejections out of ``n`` whose exact upper confidence bound is at most ``risk``; -1 if none.

    That is the largest k with P(at most k of n) <= error at rate ``risk``. Terms are
    summed as logarithms; beyond ``risk * n`` the probability is too large anyway.
    """
    odds = math.log(risk / (1 - risk))
    none = n * math.log1p(-risk)
    first = F.struct(
        none.alias("term"), none.alias("sum"), F.when(none <= F.log(error), 0).otherwise(-1).alias("k")
    )

    def add(acc: Column, i: Column) -> Column:
        term = acc["term"] + F.log((n - i + 1) / i) + odds
        high, low = F.greatest(term, acc["sum"]), F.least(term, acc["sum"])
        total = high + F.log1p(F.exp(low - high))
        return F.struct(
            term.alias("term"), total.alias("sum"), F.when(total <= F.log(error), i).otherwise(acc["k"]).alias("k")
        )

    last = F.floor(n * risk).cast("int")
    return F.when(
        last > 0, F.aggregate(F.sequence(F.lit(1), F.greatest(last, F.lit(1))), first, add, lambda acc: acc["k"])
    ).otherwise(first["k"])


def cutoffs(
    stats: DataFrame, labels: DataFrame, stratum: str = "lang", risk: float = RISK, delta: float = DELTA, name: str = "_q"
) -> DataFrame:
    """(stratum, rule, cutoff, n, rejected, caught): the chosen cutoffs and what they do to the labelled rows.

    ``stats`` are documents with their statistics; only those with labels count. Labels with a null id or quality
    are ignored, as are labels of absent documents; a document labelled twice counts twice. A null stratum is a
    stratum of its own.
    """
    known = labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_id"), "quality")
    rows = (
        stats.select("doc_id", F.col(name).alias("q"), F.coalesce(F.col(stratum).cast("string"), F.lit("\0")).alias("stratum"))
        .where(~base_failed(F.col("q")))
        .join(known, F.col("doc_id") == F.col("_id"))
    )
    kinds = steps(F.col("q"))
    pairs = F.array(*[F.struct(F.lit(k).alias("rule"), v.alias("step")) for k, v in kinds.items()])
    counts = (
        rows.select("stratum", "quality", F.explode(pairs).alias("p"))
        .groupBy("stratum", "p.rule", "p.step")
        .agg(F.sum("quality").alias("good"), F.sum(1 - F.col("quality")).alias("bad"))
    )
    upward = lambda c: F.array(*[F.sum(F.when(F.col("step") >= s, F.col(c)).otherwise(0)) for s in range(GRID + 1)])
    cells = counts.groupBy("stratum", "rule").agg(
        F.sum("good").alias("n"), upward("good").alias("rejected"), upward("bad").alias("caught")
    )
    cells = written(cells, "quality-cells")
    error = F.lit(delta / max(cells.count(), 1))
    judged = cells.withColumn("most", allowed(F.col("n"), error, risk / len(RULES)))
    # Cutoffs run from GRID down; the first unsafe one ends the sequence. Step 0 is where clean texts lie.
    choice = F.aggregate(
        F.sequence(F.lit(GRID), F.lit(1)),
        F.struct(F.lit(GRID + 1).alias("at"), F.lit(0).cast("long").alias("gain"), F.lit(True).alias("open")),
        lambda acc, s: let(
            F.struct(
                (acc["open"] & (F.get("rejected", s) <= F.col("most"))).alias("open"),
                (F.get("caught", s) - PRICE * F.get("rejected", s)).alias("gain"),
            ),
            lambda new: F.when(
                new["open"] & (new["gain"] > acc["gain"]),
                F.struct(s.alias("at"), new["gain"].alias("gain"), F.lit(True).alias("open")),
            ).otherwise(F.struct(acc["at"].alias("at"), acc["gain"].alias("gain"), new["open"].alias("open"))),
        ),
        lambda acc: acc["at"],
    )
    return judged.withColumn("cutoff", choice).where(F.col("cutoff") <= GRID).select(
        "stratum", "rule", "cutoff", "n",
        F.get("rejected", F.col("cutoff")).alias("rejected"), F.get("caught", F.col("cutoff")).alias("caught"),
    )


def judge(docs: DataFrame, found: DataFrame, stratum: str = "lang", name: str = "_q") -> DataFrame:
    """Add ``base_failed`` and ``kept`` to documents that carry their statistics.

    ``found`` has a row per stratum and rule; it is broadcast while it has at most
    SMALL_ROWS rows, and joined by shuffle beyond that. Other columns pass through, whatever their
    names, but the two named above are replaced.
    """
    docs, named = shield(docs, [stratum, name], ["base_failed", "kept"])
    limits = found.groupBy("stratum").agg(
        *[F.max(F.when(F.col("rule") == r, F.col("cutoff"))).alias(f"_c_{r}") for r in RULES]
    ).withColumnRenamed("stratum", "_stratum")
    if limits.count() <= SMALL_ROWS:
        limits = F.broadcast(limits)
    key = F.coalesce(F.col(stratum).cast("string"), F.lit("\0"))
    q = F.col(name)
    over = F.lit(False)
    for rule, step in steps(q).items():
        over = over | F.coalesce(step >= F.col(f"_c_{rule}"), F.lit(False))
    return named(
        docs.join(limits, key == F.col("_stratum"), "left")
        .withColumn("base_failed", base_failed(q))
        .withColumn("kept", ~F.col("base_failed") & ~over)
        .drop("_stratum", *[f"_c_{r}" for r in RULES])
    )
